"""Plain versions of what the operators compute, one text at a time."""

import hashlib
import re

import numpy as np
import xxhash

GAP = "\x20\t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ANY_CASE = "(%s)" % "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    for w in ("password", "passwd", "secret", "token", "api_?key")
)
BASE_SECRETS = {
    "assign": (ANY_CASE + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
}


def words(text):
    return WORD.findall(text or "")


def quality(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {x for x in windows if windows.count(x) > 1} if len(windows) < 400 else None
    if again is None:
        seen = {}
        for x in windows:
            seen[x] = seen.get(x, 0) + 1
        again = {x for x, n in seen.items() if n > 1}
    covered = {i + k for i, x in enumerate(windows) if x in again for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
    )


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    out = []
    for kind, pattern in BASE_PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def secrets(text):
    out = []
    for k, (kind, (pattern, group, least)) in enumerate(BASE_SECRETS.items()):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def fingerprint(text, size=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(n, linked):
    """Smallest index reachable, from a boolean matrix of links."""
    root = np.arange(n)
    while True:
        new = np.array([min(root[i], root[linked[i]].min(initial=n)) for i in range(n)])
        if (new == root).all():
            return root
        root = new


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()

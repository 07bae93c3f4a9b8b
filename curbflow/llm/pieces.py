"""Words of texts of any length, a bounded slice at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Bytes that are split at once: a word list takes some fifteen times its text.
SLICE = 1 << 22
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(text: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in order, in lists of about ``size`` bytes.

    Words are cut at ASCII white space, as ``bytes.split`` does; a slice ends at
    white space, so no word is cut. No words give no list, or an empty one.
    """
    at, n = 0, len(text)
    while at < n:
        gap = _GAP.search(text, at + size) if at + size < n else None
        end = gap.start() if gap else n
        yield text[at:end].split() if at or end < n else text.split()
        at = end

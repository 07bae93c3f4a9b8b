"""Repeated passages, filter interactions and conversation repair against plain versions."""

import itertools
import re
from collections import defaultdict

import pytest
from brute import words
from compare import differences, duck
from conftest import LONG

import __spark_entry__
from curbflow.llm import audit, pieces, repair, repeats

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_substring_dedup", "op12_filter_audit", "op13_structure_repair"])
def test_query_against_sql(spark, name):
    assert not differences(__spark_entry__.queries()[name](spark, SF), duck(SF), __spark_entry__.oracle_sql()[name])


def test_word_lists_cut_no_word():
    text = ("ab  cé\n\x0b d" * 50 + "x" * 99).encode()
    for size in (1, 2, 7, 1000):
        assert [w for part in pieces.word_lists(text, size) for w in part] == text.split()
    assert [w for part in pieces.word_lists(b"") for w in part] == []


def removed(rows):
    """What is left of each (id, text), by every window of every document."""
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    first, left = {}, {}
    for doc in docs:
        w = words(doc[2])
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s : s + 20]), (doc, s))
    for doc in docs:
        w = words(doc[2])
        gone = {s + k for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] != (doc, s) for k in range(20)}
        left[doc] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return left


def planted(n=60):
    common = " ".join(f"p{i}" for i in range(47))
    rows = []
    for i in range(n):
        own = " ".join(f"w{i}x{k}" for k in range(i))
        rows.append((i, f"{own} {common[: 150 + i % 4 * 20]} {own}\n{common if i % 3 else 'a b ' * 40}"))
    return rows + [rows[3], (99, rows[5][1]), (None, rows[7][1]), (None, None), (7, ""), (8, "few words")]


@pytest.mark.parametrize("most, batch", [(repeats.MOST, repeats.BATCH), (repeats.MOST, 700), (5, 700), (5, repeats.BATCH)])
def test_repeats_by_every_way(spark, most, batch):
    rows = planted()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, id int, digest int").repartition(5)
    got = repeats.deduplicated(docs, "left", most=most, batch=batch).collect()
    want = removed(rows)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r["left"]) == want[(r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")]


@pytest.mark.parametrize("most, batch", [(repeats.MOST, repeats.BATCH), (60, 700), (400, 5000)])
def test_repeats_across_gaps(spark, most, batch):
    rows = []
    for i in range(50):
        gaps = itertools.cycle([" ", "\n", " \t", " "][: 1 + i % 4])
        rows.append((i, "".join(w + next(gaps) for w in [f"o{i}", *(f"c{k // 2}" for k in range(i % 7, 90)), f"o{i}"] * 2)))
    got = repeats.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "left", most=most, batch=batch)
    want = removed(rows)
    assert {r["doc_id"]: tuple(r["left"]) for r in got.collect()} == {i: want[True, i, t] for i, t in rows}


def test_rows_shipped_do_not_follow_groups(spark, monkeypatch):
    """Batches of texts times groups would be rows that grow with the square of the input."""
    rows = [(i, " ".join(f"w{i * 1000 + k if k % 90 > 40 else k}" for k in range(1500))) for i in range(60)]
    shipped, made = spark.sparkContext.accumulator(0), repeats._segments

    def counted(*args):
        found = made(*args)

        def frames(batches):
            for frame in found(batches):
                shipped.add(len(frame))
                yield frame

        return frames

    monkeypatch.setattr(repeats, "_segments", counted)
    monkeypatch.setattr(repeats, "GROUP", 450)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: tuple(r["left"]) for r in repeats.deduplicated(docs, "left", batch=20_000).collect()}
    want = removed(rows)
    assert got == {i: want[True, i, t] for i, t in rows}
    size = sum(len(t) for _, t in rows)
    groups, batches = size // (repeats.WORD_BYTES * 450), size // 20_000
    assert 0 < shipped.value < groups * batches // 6


def test_window_hashes_of_long_texts():
    import numpy as np

    words = [b"w%d" % (k % 1000) for k in range(repeats._REACH + 5000)]
    data = b" ".join(words)
    whole, phrase = repeats._chained(repeats._hashes(data, *repeats._tokens(data)), 20, 5)
    assert len(whole) == len(words) - 19 and len(phrase) == len(words) - 4
    assert (whole[1000:] == whole[:-1000]).all() and (phrase[1000:] == phrase[:-1000]).all()
    assert len(set(whole[:1000].tolist())) == len(set(phrase[:1000].tolist())) == 1000
    assert repeats._twins(np.array([7 << 40, 3 << 40, 7 << 40, 1 << 40], np.uint64)).tolist() == [0, 2]
    assert repeats._twins(np.zeros(0, np.uint64)).tolist() == []


def test_repeats_of_odd_rows(odd, none):
    got = repeats.deduplicated(odd, "left")
    assert got.columns == [*odd.columns, "left"] and got.count() == odd.count()
    r = got.where("doc_id = 8").first()["left"]
    assert r.n_words == len(words(LONG)) and r.n_removed == 30_000 - 1  # a window of one word starts again at every word but the first
    assert repeats.deduplicated(none, "left").collect() == []
    with pytest.raises(ValueError):
        repeats.deduplicated(odd, "LANG")


def brute_audit(docs, labels):
    least = {}
    for r in docs:
        if r["doc_id"] is not None:
            least[r["text"] or ""] = min(least.get(r["text"] or "", r["doc_id"]), r["doc_id"])
    fails = []
    for r in docs:
        t, w = r["text"] or "", words(r["text"])
        f = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": t in least and r["doc_id"] != least[t],
        }
        fails.append((r["source"] or "", {k for k, v in f.items() if v}, labels.get(r["doc_id"], (0, 0))))
    out, shapley = {}, defaultdict(int)
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            alive = own
            for step, k in enumerate(order, 1):
                hit = [f for f in alive if k in f[1]]
                alive = [f for f in alive if k not in f[1]]
                shapley[part, k] += len(hit)
                out[part, "".join(order), step] = (
                    len(alive), len(hit), sum(k in f[1] for f in own) - len(hit), sum(f[1] == {k} for f in own),
                    sum(f[2][0] for f in hit), sum(f[2][1] for f in hit),
                )
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def test_audit_of_odd_rows(spark, odd, none):
    marks = [(4, 1, 0, "x"), (4, 0, 1, "y"), (6, None, 1, "z"), (8, 1, 0, "x"), (None, 1, 1, "n"), (77, 1, 1, "n")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int, part string")
    got = audit.interactions(audit.failures(odd, labels)).collect()
    want = brute_audit(odd.collect(), {4: (1, 1), 6: (0, 1), 8: (1, 0)})
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == want and len(got) == len(want)
    assert audit.interactions(audit.failures(none, labels)).collect() == []
    assert audit.interactions(audit.failures(odd, labels.where("false"))).agg({"good_lost": "sum"}).first()[0] == 0


def test_paths_count_orders():
    reach, leave = audit._paths(5)
    assert reach[31] == leave[0] == 120 and all(r * x in (120, 24, 12) for r, x in zip(reach, leave))


def cheapest(turns):
    """(cost, audit, lines) of a conversation by trying every edit of every turn."""
    grammar, best = re.compile(r"(s?(ua)+)?\Z"), None
    names = {"u": "user", "a": "assistant"}
    inserts = [(3 * n, "I" * n, [(x, "") for x in combo]) for n in range(3) for combo in itertools.product("ua", repeat=n)]
    options = []
    for role, text, fault in turns:
        own = [(4, "D", [])]
        if fault in "t-":
            more = 3 * (fault == "t")
            own += [(more, "K", [(role, text)]), *((3 + more, "R", [(x, text)]) for x in "ua")]
        options += [inserts, own]
    for way in itertools.product(*options, inserts):
        out = [x for w in way for x in w[2]]
        if grammar.match("".join(r[:1] or "?" for r, _ in out)):
            key = (sum(w[0] for w in way), "".join(w[1] for w in way))
            if best is None or key < best[0]:
                best = (key, [f"{names.get(r, r)}:{t}" for r, t in out])
    return (*best[0], best[1])


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "b" if not last else "d" if (role, text) in seen else "-" if last[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


CONVERSATIONS = {
    1: ["user:Hi.", "assistant:Yes."],
    2: ["assistant:Yes.", "assistant:No."],
    3: ["system:Be.", "system:Be!", "user:x"],
    4: ["system:Only."],
    5: ["user:Hi.", "user:Hi.", "assistant: "],
    6: ["tool:Data.", "user:Q?", "assistant:cut"],
    7: ["user:a", "user:b", "user:c"],
    8: ["assistant:A.", "user:U.", "system:S."],
    9: [" : ", "user:."],
    10: ["assistant:cut", "assistant:A."],
    11: [":Nobody.", "user:Hi."],
}


@pytest.mark.parametrize("bits", [0, 1, repair.BLOCK_BITS])
def test_repair_against_every_edit(spark, bits):
    rows = [(c, k, *t.split(":", 1), 0) for c, ts in CONVERSATIONS.items() for k, t in enumerate(ts)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int").repartition(3)
    rows = repair.ordered(turns, block_bits=bits)
    found = repair.reports(rows)
    lines = defaultdict(list)
    for r in repair.repaired(rows, found).orderBy("conv_id", "place", "part").collect():
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in found.collect():
        turns = faults([t.split(":", 1) for t in CONVERSATIONS[r["conv_id"]]])
        initials = [t[0][:1] for t in turns]
        assert (r["cost"], r["audit"], lines[r["conv_id"]]) == cheapest(turns), CONVERSATIONS[r["conv_id"]]
        assert [r["blank"], r["duplicate"], r["truncated"]] == [sum(t[2] == f for t in turns) for f in "bdt"]
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    assert found.count() == len(CONVERSATIONS)


def test_repair_of_odd_rows(spark):
    long = "word " * 200_000 + "end."
    rows = [
        (None, None, "user", "a."), (None, 3, None, "b."), (None, 3, None, "b."), (5, None, "user", None), (5, 7, "user", long),
        (5, 7, "user", long), (5, 9, "assistant", "ok."), (6, 2, "user", "q."), (6, 2, "assistant", "a."), (6, 5, "user", ""),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rows = repair.ordered(turns)
    found = {r["conv_id"]: r for r in repair.reports(rows).collect()}
    assert [found[5][k] for k in ("gaps", "blank", "duplicate", "cost", "audit")] == [1, 1, 1, 8, "DKDK"]
    assert [found[None][k] for k in ("gaps", "duplicate", "audit")] == [0, 1, "KRD"]
    assert [found[6][k] for k in ("gaps", "illegal", "audit")] == [2, 1, "IKKDI"]  # equal numbers by role
    texts = repair.repaired(rows, repair.reports(rows)).where("conv_id = 5").orderBy("place", "part").collect()
    assert [(r["role"], r["text"]) for r in texts] == [("user", long), ("assistant", "ok.")]
    empty = repair.ordered(turns.where("false"))
    assert repair.reports(empty).collect() == [] and repair.repaired(empty, repair.reports(empty)).collect() == []


def test_damage_by_checksum(spark):
    import zlib

    rows = [(c, t, "assistant", f"Text {c}. No {t}!") for c in range(40) for t in range(4)] + [(None, 1, None, None), (3, None, "user", "x?")]
    got = defaultdict(list)
    for r in repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got[r["conv_id"], r["turn"]].append((r["role"], r["text"]))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        one = ("user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        assert got[c, t] == [one] * (0 if kind == 0 else 2 if kind == 3 else 1)

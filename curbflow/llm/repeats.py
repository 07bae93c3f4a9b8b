"""Substring dedup: passages that documents share, by prefix-partitioned suffix trees.

The suffixes of all texts, as sequences of words, are split by a prefix of variable
length: the words of a suffix up to the end of its anchor, the phrase with the least hash
among its first ``WINDOW`` words. Equal beginnings have equal prefixes, so a subtree never
needs another group's suffixes; and neighbouring suffixes share their anchor, so a group gets
them as one segment, some three words a suffix in place of ``WINDOW``. A group is a set of
anchors that fits a task's memory. Where an anchor is too common for that, the prefixes
of its suffixes are extended to the whole window. Groups travel in bundles, a row a bundle
from several batches of texts, so that rows and their bytes grow little with the number of groups.

A group's subtree is its sorted suffixes with the lengths that neighbours have in
common. Nodes of depth ``WINDOW`` or more are the repeats: in each, all occurrences but the first
(smallest document, earliest start) go. Runs of such windows are the maximal repeats.

Copies within a batch of texts are found before anything is shuffled, so a passage of very
many documents reaches its group at most once a batch.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import stored
from curbflow.llm.pieces import word_lists

#: Words of a window, the least length of a repeat, and of an anchor.
WINDOW, PHRASE = 20, 5
#: Bytes of a batch of texts, suffixes a group aims at, suffixes it may hold.
BATCH, GROUP, MOST = 1 << 22, 1 << 18, 1 << 21
#: Groups of a bundle, batches that leave together, segments at which they leave before.
BUNDLE, BATCHES, SEGMENTS = 2, 4, 1 << 20
#: Windows or spans of a frame.
FRAME = 1 << 15
#: Bytes of a word with its gap, to choose the number of groups.
WORD_BYTES = 6

_SHIPPED = "bundle long, meta binary, words binary"
_SPAN = "numbered boolean, id long, digest long, start long, n long"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes over which powers of _A are at hand.
_REACH = 1 << 18


class _Numbers(dict):
    """Numbers words as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of _A modulo 2^64, and of its inverse."""
    inverse = np.uint64(pow(int(_A), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(_REACH, x)]), dtype=np.uint64) for x in (_A, inverse))


def _tokens(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end, cut at ASCII white space."""
    raw = np.frombuffer(data, np.uint8)
    word = np.concatenate([[False], (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D)), [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[::2], edges[1::2]


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of every word, by sums of bytes times powers."""
    raw, out = np.frombuffer(data, np.uint8), np.zeros(len(starts), np.uint64)
    power, inverse = _powers()
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _REACH, side="right")))
        first, last = int(starts[at]), int(ends[to - 1])
        if last - first > _REACH:  # one very long word
            out[at] = xxhash.xxh64_intdigest(data[first:last])
        else:
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum((raw[first:last].astype(np.uint64) + np.uint64(1)) * power[: last - first], out=sums[1:])
            a, b = starts[at:to] - first, ends[at:to] - first
            out[at:to] = _pair((sums[b] - sums[a]) * inverse[a], (b - a).astype(np.uint64))
        at = to
    return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A + b * _B
    x ^= x >> np.uint64(32)
    x *= _A
    return x ^ (x >> np.uint64(29))


def _chained(hashes: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Per place a hash of the next words, for each length; the last places have none."""
    power, inverse = _powers()
    out = [np.zeros(max(0, len(hashes) - length + 1), np.uint64) for length in lengths]
    step = _REACH - max(lengths)
    for at in range(0, len(hashes), step):
        part = hashes[at : at + _REACH]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[: len(part)], out=sums[1:])
        for length, got in zip(lengths, out):
            n = max(0, min(step, len(part) - length + 1))
            got[at : at + n] = (sums[length : length + n] - sums[:n]) * inverse[:n]
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    out, n = values, 1
    while n < width:
        step = min(n, width - n)
        out, n = np.minimum(out[: len(out) - step], out[step:]), n + step
    return out


def _runs(at: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of neighbouring places with the same values."""
    cut = np.diff(at) != 1
    for values in same:
        cut |= values[1:] != values[:-1]
    first = np.flatnonzero(np.concatenate([[True], cut])) if len(at) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(at)))


class _Batch:
    """Pieces of texts with their key: whether the document has an id, the id, its text's digest, the first word's number."""

    def __init__(self) -> None:
        self.pieces, self.size = [], 0

    def add(self, key: tuple, data: bytes) -> None:
        self.pieces.append((key, data))
        self.size += len(data)

    def taken(self) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The batch's text, its segments: first and last byte, anchor, span, and spans of what repeats within the batch."""
        pieces = sorted(self.pieces, key=lambda p: p[0])  # in document order
        self.__init__()
        sizes = np.array([len(p[1]) + 1 for p in pieces], np.int64)
        keys = [np.array(column, np.int64) for column in zip(*(p[0] for p in pieces))]
        data = b" ".join(p[1] for p in pieces)
        del pieces
        starts, ends = _tokens(data)
        owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
        count = np.bincount(owner, minlength=len(sizes))
        begins = np.cumsum(count) - count
        if len(starts) < WINDOW:
            none = np.zeros(0, np.int64)
            return b"", none, none, none.astype(np.uint64), none.reshape(5, 0), none.reshape(5, 0)
        whole, phrase = _chained(_hashes(data, starts, ends), WINDOW, PHRASE)
        anchor = _least(phrase, WINDOW - PHRASE + 1)
        at = np.flatnonzero(owner[: len(whole)] == owner[WINDOW - 1 :])
        repeats = at[_repeated(data, starts, ends, at, whole[at], owner[at], keys, begins)]
        shipped = np.setdiff1d(at, repeats, assume_unique=True)

        def spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
            piece = owner[start]
            return np.stack([*(k[piece] for k in keys[:3]), keys[3][piece] + start - begins[piece], n]).astype(np.int64)

        repeats = np.sort(repeats)
        first, n = _runs(repeats, owner[repeats])
        local = spans(repeats[first], n)
        first, n = _runs(shipped, owner[shipped], anchor[shipped])
        start = shipped[first]
        return data, starts[start], ends[start + n + WINDOW - 2], anchor[start], spans(start, n), local


class _Bundles:
    """Segments of several batches by bundle, which is a set of groups."""

    def __init__(self, slots: int, bundles: int) -> None:
        self.slots, self.bundles = slots, bundles
        self.held, self.local, self.size, self.segments = [], [], 0, 0

    def add(self, data: bytes, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, meta: np.ndarray, local: np.ndarray) -> None:
        slot = (_pair(anchor, np.full(len(anchor), _B)) % np.uint64(self.slots)).astype(np.int64)
        self.held.append((data, low + self.size, high + self.size, slot, meta))
        self.local.append(local)
        self.size += len(data)
        self.segments += len(low)

    def taken(self) -> Iterator[dict]:
        """A row a bundle, its groups one after another, and the spans that need no group."""
        if not self.held:
            return
        texts, *columns = zip(*self.held)
        low, high, slot = (np.concatenate(c) for c in columns[:3])
        meta, local, data = np.concatenate(columns[3], axis=1), np.concatenate(self.local, axis=1), b"".join(texts)
        self.__init__(self.slots, self.bundles)
        del texts, columns
        bundle = slot % self.bundles
        order = np.lexsort([slot, bundle])
        low, high, slot, bundle, meta = low[order], high[order], slot[order], bundle[order], meta[:, order]
        place = np.concatenate([[0], np.cumsum(high - low + 1)])
        group, cut = _changes(slot), _changes(bundle)
        inside = np.append(np.searchsorted(group, cut), len(group))
        edge = np.append(group, len(slot))
        head = np.stack([slot[group], np.diff(edge), np.diff(place[edge])])
        for k, (a, b) in enumerate(zip(cut.tolist(), [*cut[1:].tolist(), len(slot)])):
            own = head[:, inside[k] : inside[k + 1]]
            yield {
                "bundle": int(bundle[a]),
                "meta": _packed(np.concatenate([[own.shape[1]], own.ravel(), meta[:, a:b].ravel()]).tobytes()),
                "words": _packed(b" ".join([data[i:j] for i, j in zip(low[a:b].tolist(), high[a:b].tolist())])),
            }
        for a in range(0, local.shape[1], FRAME):
            some = local[:, a : a + FRAME]
            yield {"bundle": (int(some[2, 0]) + int(some[3, 0])) % self.bundles, "meta": _packed(some.tobytes()), "words": None}


def _changes(values: np.ndarray) -> np.ndarray:
    """Places where a run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


@functools.cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=2), zstandard.ZstdDecompressor()


def _packed(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def _unpacked(data: bytes) -> bytes:
    return _zstd()[1].decompress(data)


def _twins(hashes: np.ndarray) -> np.ndarray:
    """Indices, sorted, of the hashes that are not alone, by all bits but the few that give way to the index."""
    low = np.uint64((1 << len(hashes).bit_length()) - 1)
    both = np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64))
    twin = (both[1:] & ~low) == (both[:-1] & ~low)
    near = np.concatenate([[False], twin]) | np.concatenate([twin, [False]]) if len(both) else twin
    return np.sort((both[near] & low).astype(np.int64))


def _ranks(data: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of the windows at words ``at`` (sorted): equal for equal windows only, ordered as their first words' numbers are.

    Prefix doubling: ranks of two neighbouring stretches make the rank of both.
    """
    change = np.zeros(len(starts) + 1, np.int32)
    change[at] += 1
    change[at + WINDOW] -= 1
    place = np.flatnonzero(np.cumsum(change) > 0)
    own = np.searchsorted(place, at)
    words = [data[i:j] for i, j in zip(starts[place].tolist(), ends[place].tolist())]
    rank = np.fromiter(map(_Numbers().__getitem__, words), np.uint64, len(words))
    done, got, n = 0, None, 1
    powers = []
    while True:
        powers.append((n, rank))
        if 2 * n > WINDOW:
            break
        whole = np.flatnonzero(place[2 * n - 1 :] - place[: 1 - 2 * n] == 2 * n - 1)
        both = (rank[whole] << np.uint64(32)) | rank[whole + n]
        rank = np.zeros(len(place), np.uint64)
        rank[whole] = np.unique(both, return_inverse=True)[1]
        n *= 2
    for n, rank in reversed(powers):
        if WINDOW & n:
            part = rank[own + done]
            got = part if got is None else np.unique((got << np.uint64(32)) | part, return_inverse=True)[1].astype(np.uint64)
            done += n
    return got


def _copies(data: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether the windows at words ``at`` (sorted) have the same bytes, gaps too, as those at ``other``, by runs of both."""
    first, n = _runs(at, at - other)
    low, high = starts[at[first]].tolist(), ends[at[first] + n + WINDOW - 2].tolist()
    low_other, high_other = starts[other[first]].tolist(), ends[other[first] + n + WINDOW - 2].tolist()
    same = [data[i:j] == data[k:m] for i, j, k, m in zip(low, high, low_other, high_other)]
    return np.repeat(np.array(same, bool), n)


def _repeated(
    data: bytes, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, hashes: np.ndarray,
    owner: np.ndarray, keys: list[np.ndarray], begins: np.ndarray,
) -> np.ndarray:
    """Indices of the suffixes ``at`` whose window stands earlier: all of each deep node but its first.

    Suffixes whose window's hash is alone hang from above the depth asked for, as leaves; of the others, byte for byte
    copies of the first with their hash share its node, and the rest are sorted by their words, exactly. ``owner`` has
    each suffix's row in ``keys``, ``begins`` the first word of that row.
    """
    near = _twins(hashes)
    if not len(near):
        return near
    _, first, which = np.unique(hashes[near], return_index=True, return_inverse=True)
    leader = first[which]
    rest = leader == np.arange(len(near))
    copy = np.flatnonzero(~rest)
    rest[copy] = ~_copies(data, starts, ends, at[near[copy]], at[near[leader[copy]]])
    node = np.zeros(len(near), np.uint64)
    node[rest] = _ranks(data, starts, ends, at[near[rest]])
    node[~rest] = node[leader[~rest]]
    own = owner[near]
    place = [keys[k][own] for k in range(3)] + [keys[3][own] + at[near] - begins[own]]
    order = np.lexsort([*reversed(place), node])
    near, node, place = near[order], node[order], [p[order] for p in place]
    first = np.concatenate([[True], node[1:] != node[:-1]])
    leader = np.flatnonzero(first)[np.cumsum(first) - 1]
    itself = np.logical_and.reduce([p == p[leader] for p in place])  # rows that repeat a document
    return near[~itself]


def _slices(text: bytes, size: int) -> Iterator[tuple[int, bytes]]:
    """A text in slices of about ``size`` bytes with their first word's number; each window lies in one slice."""
    at, first = 0, 0
    while at < len(text):
        to, step = at, size
        while True:  # up to a gap, and on if the slice has no window that is its own
            gap = _GAP.search(text, to + step)
            to, step = gap.start() if gap else len(text), 2 * step
            data = text[at:to] if at or to < len(text) else text
            starts = _tokens(data)[0] if to < len(text) else ()
            if to == len(text) or len(starts) >= WINDOW:
                break
        yield first, data
        if to == len(text):
            return
        kept = len(starts) - WINDOW + 1
        at, first = at + int(starts[kept]), first + kept


def _segments(slots: int, bundles: int, size: int):
    def shipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch, bundled = _Batch(), _Bundles(slots, bundles)

        def rows() -> Iterator[dict]:
            for frame in batches:
                for *key, text in zip(frame["numbered"], frame["id"], frame["digest"], frame["text"]):
                    for start, data in _slices(text, size):
                        batch.add((*key, start), data)
                        if batch.size >= size:
                            bundled.add(*batch.taken())
                        if bundled.size >= BATCHES * size or bundled.segments >= SEGMENTS:
                            yield from bundled.taken()
            if batch.size:
                bundled.add(*batch.taken())
            yield from bundled.taken()

        out, held = [], 0
        for row in rows():
            out.append(row)
            held += len(row["meta"]) + len(row["words"] or b"")
            if held > 1 << 23:
                yield pd.DataFrame(out)
                out, held = [], 0
        if out:
            yield pd.DataFrame(out)

    return shipped


def _spans(meta: np.ndarray) -> dict:
    names = ("numbered", "id", "digest", "start", "n")
    return {k: meta[i].astype(bool) if k == "numbered" else meta[i] for i, k in enumerate(names)}


def _subtree(blobs: list[tuple[np.ndarray, bytes]]) -> np.ndarray:
    """Spans of repeated windows of one group: rows of document key, start and number of windows."""
    data = b" ".join(words for _, words in blobs)
    meta = np.concatenate([m for m, _ in blobs], axis=1)
    starts, ends = _tokens(data)
    n = meta[4]
    begins = np.cumsum(n + WINDOW - 1) - (n + WINDOW - 1)
    owner = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) + np.repeat(begins - (np.cumsum(n) - n), n)
    (whole,) = _chained(_hashes(data, starts, ends), WINDOW)
    repeats = np.sort(_repeated(data, starts, ends, at, whole[at], owner, list(meta[:4]), begins))
    first, length = _runs(at[repeats], owner[repeats])
    own = owner[repeats[first]]
    return np.stack([*(meta[k][own] for k in range(3)), meta[3][own] + at[repeats[first]] - begins[own], length])


def _sections(meta: bytes, words: bytes) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """The groups of a bundle's row: slot, spans and words of each."""
    numbers, data = np.frombuffer(_unpacked(meta), np.int64), _unpacked(words)
    k = int(numbers[0])
    head, spans = numbers[1 : 1 + 3 * k].reshape(3, k), numbers[1 + 3 * k :].reshape(5, -1)
    at, place = 0, 0
    for slot, segments, size in head.T.tolist():
        yield slot, spans[:, at : at + segments], data[place : place + size]
        at, place = at + segments, place + size


def _passed(meta: np.ndarray, words: bytes) -> Iterator[pd.DataFrame]:
    """A window a row, its words whole."""
    each = np.repeat(meta, meta[4], axis=1)
    inside = np.arange(each.shape[1]) - np.repeat(np.cumsum(meta[4]) - meta[4], meta[4])
    each[3] += inside
    each[4] = 1
    at = np.repeat(np.cumsum(meta[4] + WINDOW - 1) - (meta[4] + WINDOW - 1), meta[4]) + inside
    every = words.split()
    for a in range(0, each.shape[1], FRAME):
        windows = [b" ".join(every[i : i + WINDOW]) for i in at[a : a + FRAME].tolist()]
        yield pd.DataFrame(_spans(each[:, a : a + FRAME]) | {"words": windows})


def _groups(most: int):
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Subtrees of the groups of each bundle, which arrive one after another; those too large pass through."""
        now, held, count, large = None, defaultdict(list), Counter(), set()
        out, size = [], 0

        def spans(meta: np.ndarray, least: int = FRAME) -> Iterator[pd.DataFrame]:
            nonlocal out, size
            out.append(meta)
            size += meta.shape[1]
            if size >= least:
                yield pd.DataFrame(_spans(np.concatenate(out, axis=1)) | {"words": None})
                out, size = [], 0

        def closed() -> Iterator[pd.DataFrame]:
            while held:
                yield from spans(_subtree(held.popitem()[1]))
            count.clear()
            large.clear()

        for frame in batches:
            for bundle, meta, words in zip(frame["bundle"], frame["meta"], frame["words"]):
                if words is None:
                    yield from spans(np.frombuffer(_unpacked(meta), np.int64).reshape(5, -1))
                    continue
                if bundle != now:
                    yield from closed()
                    now = bundle
                for slot, own, text in _sections(meta, words):
                    if slot in large:
                        yield from _passed(own, text)
                        continue
                    held[slot].append((own, text))
                    count[slot] += int(own[4].sum())
                    while count and (max(count.values()) > most or count.total() > 2 * most):
                        slot = max(count, key=count.get)
                        large.add(slot)
                        del count[slot]
                        for blob in held.pop(slot):
                            yield from _passed(*blob)
        yield from closed()
        if size:
            yield from spans(np.zeros((5, 0), np.int64), 0)

    return found


def repeated_windows(docs: DataFrame, text: str = "text", most: int = MOST, batch: int = BATCH) -> DataFrame:
    """Runs of windows that stand earlier: ``numbered, id, digest, start, n`` with ``n`` windows from word ``start``.

    ``docs`` needs ``doc_id`` and a text; see :func:`deduplicated` for how rows are told apart.
    ``most`` bounds the suffixes that a group holds in memory, and twice as many those of a bundle; ``batch`` is the bytes of text that a task
    does. The number of groups grows with the input; a group beyond the bound is found by an aggregate on whole windows, so none is left out.
    """
    number, digest = _identity(docs, text)
    rows = docs.select(
        number.isNotNull().alias("numbered"), F.coalesce(number, F.lit(0)).alias("id"), digest.alias("digest"),
        F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"),
    )
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    slots = max(64, size // (WORD_BYTES * GROUP))
    bundles = max(64, slots // BUNDLE)
    shipped = rows.mapInPandas(_segments(slots, bundles, batch), _SHIPPED).repartition("bundle").sortWithinPartitions("bundle")
    found = stored(shipped.mapInPandas(_groups(most), f"{_SPAN}, words binary"), "windows")
    spans, single = found.where("words IS NULL").drop("words"), found.where("words IS NOT NULL")
    if not single.take(1):
        return spans
    first = single.groupBy("words").agg(F.min(F.struct("numbered", "id", "digest", "start")).alias("f")).select("words", "f.*")
    later = single.join(first, ["words", "numbered", "id", "digest", "start"], "left_anti")
    return spans.union(later.select(*spans.columns))


def _identity(docs: DataFrame, text: str) -> tuple[Column, Column]:
    """What tells rows apart: the id, and a digest of the text."""
    return docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs[text], F.lit("")))


def _kept(texts: pd.Series, starts: pd.Series, counts: pd.Series) -> pd.DataFrame:
    """Words of each text, how many the spans cover, and the others with one space between."""
    out = []
    for text, start, count in zip(texts, starts, counts):
        words = [w for part in word_lists(text) for w in part]
        if start is None or not len(start):
            out.append((len(words), 0, b" ".join(words).decode()))
            continue
        gone = np.zeros(len(words) + 1, np.int32)
        np.add.at(gone, start, 1)
        np.add.at(gone, np.asarray(start) + count + WINDOW - 1, -1)
        keep = np.cumsum(gone)[:-1] == 0
        out.append((len(words), int((~keep).sum()), b" ".join([w for w, k in zip(words, keep.tolist()) if k]).decode()))
    return pd.DataFrame(out, columns=["n_words", "n_removed", "text"])


def deduplicated(
    docs: DataFrame, name: str = "deduplicated", text: str = "text", most: int = MOST, batch: int = BATCH
) -> DataFrame:
    """All rows and columns of ``docs``, with a struct ``name`` of ``n_words, n_removed, text``: what is left of each text.

    Words are cut at ASCII white space and compared unchanged. A word goes if a window of ``WINDOW`` words
    that covers it also starts earlier, in a smaller document or before in the same one; windows are judged on
    the input. What stays is joined by one space. Null and empty texts, and those below ``WINDOW`` words,
    lose nothing; a null text leaves an empty one.

    Rows are told apart by id and text. Rows without an id come before all others; among rows of one id
    that with the smaller text digest is earlier, and rows that repeat both id and text are one document, so
    they fare alike and none is the other's copy. Texts of any length are read in slices. An empty table
    gives no rows. ``name`` must be no column of ``docs``, else this raises.
    """
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"column {name} is there already")
    spans = repeated_windows(docs, text, most, batch).groupBy("numbered", "id", "digest").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    found = spans.select(
        F.when(F.col("numbered"), F.col("id")).alias("id"), "digest", F.col("spans.start").alias("starts"), F.col("spans.n").alias("counts")
    )
    number, digest = _identity(docs, text)
    joined = docs.join(found, (digest == found["digest"]) & number.eqNullSafe(found["id"]), "left")
    kept = F.pandas_udf(_kept, "n_words long, n_removed long, text string")(
        F.coalesce(docs[text], F.lit("")).cast("binary"), found["starts"], found["counts"]
    )
    return joined.select(*(docs[c] for c in docs.columns), kept.alias(name))

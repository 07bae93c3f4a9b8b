"""Packing documents into fixed-length token sequences by reciprocal-capacity classes.

A document is cut into whole sequences first. Its rest is cut greedily at lengths
``capacity // j``: the largest such length that fits, then the next, down to 64
tokens, where the remainder is a piece of its own. Each length is a class, and a
bin of a class holds exactly ``capacity // length`` pieces, so a bin wastes less
than 64 of 4096 tokens. Tasks number their pieces of each class; one exclusive
sum over (class, task) counts then tells every task which bins it fills, without
pieces meeting anywhere. What does not fill a bin at the end, fewer pieces per
class than one bin holds, is cut anew into whole sequences and, at the very end,
sequences whose length is a power of two.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.llm.common import session, stored, text_of

CAPACITY = 4096
END_ID = 2
#: Rests up to this length are not cut further.
SMALL = 64
#: Distinct words that a Python worker remembers the ids of.
WORDS_KEPT = 800_000
#: A capital that may join a combining mark: it must not be lower-cased before normalising.
_MARKED_CAPITAL = re.compile("[A-Z][\u0300-\U0010ffff]*?[\u0300-\u036f]")
_MARKS = b"!#$%&()*,-./:;<=>?@[]^_`{|}~"
#: Bytes of ids handed back to Spark at once.
BATCH_BYTES = 16 << 20

CUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("worker", T.IntegerType()),
        T.StructField("nth", T.LongType()),
    ]
)
PIECE = T.StructType([*CUT.fields[:6], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as a letter: itself if printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: 256 + i for i, b in enumerate(others)}


def _stays_letter(char: str) -> bool:
    """A letter that normalising and lower-casing leave without a combining mark, as dotted I is not."""
    return char.lower().isalpha() and is_normalized("NFC", char)


class WordEncoder(dict):
    """Token ids of texts for a byte-level tokenizer that lower-cases and drops white space.

    No token of such a tokenizer spans white space, so words are encoded once and
    remembered. A lower-case word of Latin letters is one piece, which goes to
    the vocabulary's merges directly; any other word goes through the whole
    tokenizer, as do texts that hold one of its special strings or a capital that
    a combining mark follows.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.letters = _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        letters = word.rstrip(_MARKS)
        if word.isalpha():
            ids = self._merged(text)
        elif letters and letters != word and _stays_letter(text[-1 - len(word) + len(letters)]):
            # marks after a letter are a token run of their own
            ids = self[letters] + self[word[len(letters) :]]
        elif max(text) < "\u0250" and is_normalized("NFC", text) and text.isalpha() and text.lower().isalpha():
            ids = self._merged(text.lower().encode().decode("latin-1").translate(self.letters))
        else:
            ids = self._plain(text)
        self[word] = ids
        return ids

    def _merged(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.merges.tokenize(piece)]).tobytes()

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, one after another."""
        if any(s in text for s in self.special) or not text.isascii() and _MARKED_CAPITAL.search(text):
            return self._plain(text)
        if len(self) > WORDS_KEPT:
            self.clear()
        return b"".join(map(self.__getitem__, text.encode().lower().split()))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    out = [(s, capacity) for s in range(0, n - n % capacity, capacity)]
    at = n - n % capacity
    while at < n:
        rest = n - at
        size = rest if rest <= SMALL else capacity // -(-capacity // rest)
        out.append((at, size))
        at += size
    return out


def _cut(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, worker = encoder(path), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        rows: list[tuple] = []
        held = 0

        def batch() -> pd.DataFrame:
            frame = pd.DataFrame(rows, columns=CUT.names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            return frame

        for frame in batches:
            for doc_id, text in zip(frame["doc_id"].astype("Int64"), frame["text"]):
                ids = encode(text) + end
                n = len(ids) // 4
                for start, length in cuts(n, capacity):
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, n, crc32(piece), piece, worker, nth))
                held += len(ids)
                if held > BATCH_BYTES:
                    yield batch()
                    rows, held = [], 0
        yield batch()

    return run


def _recut(capacity: int):
    """Pieces laid end to end into whole sequences, then ever smaller powers of two."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "rank"], ascending=[False, True])
        left = int(frame["length"].sum())
        sequence, offset = int(frame["free_id"].iloc[0]), 0

        def room_for(tokens: int) -> int:
            return capacity if tokens >= capacity else 1 << (tokens.bit_length() - 1)

        room, out = room_for(left), []
        for row in frame.itertuples():
            at = 0
            while at < row.length:
                take = min(row.length - at, room - offset)
                ids = row.ids[4 * at : 4 * (at + take)]
                out.append((row.doc_id, row.start + at, take, row.doc_tokens, crc32(ids), ids, sequence, offset))
                at, offset, left = at + take, offset + take, left - take
                if offset == room and left:
                    sequence, offset, room = sequence + 1, 0, room_for(left)
        result = pd.DataFrame(out, columns=PIECE.names)
        result["doc_id"] = result["doc_id"].astype("Int64")
        return result

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces ``(doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset)``.

    ``ids`` are the piece's tokens, little-endian unsigned 32-bit, and
    ``ids_crc32`` their checksum; ``offset`` is its place in its sequence. Every document ends with ``end_id``; a null or
    empty text is that token alone. Repeated rows are packed as often as they
    stand there, a null doc_id stays null, other columns are not read, an empty
    table gives no pieces. ``capacity`` must be a power of two.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spark = session(docs.sparkSession)
    pieces = stored(
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInPandas(
            _cut(tokenizer, capacity, end_id), CUT
        ),
        "pieces",
    )
    counts = stored(pieces.groupBy("length", "worker").agg(F.count("*").alias("n")), "piece-counts")
    # a row per class: its number is bounded by the lengths a piece can have
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("length")).collect()
    rows, base = [], 0
    for length, n in totals:
        per_bin = capacity // length
        rows.append((length, per_bin, n - n % per_bin, base))
        base += n // per_bin
    classes = spark.createDataFrame(rows, "length long, per_bin long, in_full long, base long")
    earlier = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.join(F.broadcast(classes), "length").select(  # a row per class
        "length", "worker", "n", "per_bin", "in_full", "base",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    whole = places.where(F.col("before") < F.col("in_full"))
    rank = (F.col("before") + F.col("nth")).alias("rank")
    full = (
        pieces.join(whole, ["length", "worker"])
        .select("*", rank)
        .where(F.col("rank") < F.col("in_full"))
        .select(
            "doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids",
            (F.col("base") + F.expr("rank div per_bin")).alias("sequence_id"),
            (F.col("rank") % F.col("per_bin") * F.col("length")).alias("offset"),
        )
    )
    # less than one bin of each class is left: a number that capacity bounds, whatever the input
    tail = F.broadcast(places.where(F.col("before") + F.col("n") > F.col("in_full")))
    last = (
        pieces.join(tail, ["length", "worker"])
        .select("*", rank)
        .where(F.col("rank") >= F.col("in_full"))
        .select("doc_id", "start", "length", "doc_tokens", "ids", "rank", F.lit(base).cast("long").alias("free_id"))
        .groupBy("free_id")
        .applyInPandas(_recut(capacity), PIECE)
    )
    return full.unionByName(last)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, n_tokens, ids)``: pieces joined in order, padded except at a power of two."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("offset")
        ids = b"".join(frame["ids"])
        n = len(ids) // 4
        if n & (n - 1):
            ids += np.full(capacity - n, pad_id, "<u4").tobytes()
        return pd.DataFrame({"sequence_id": [frame["sequence_id"].iloc[0]], "n_tokens": [n], "ids": [ids]})

    return pieces.groupBy("sequence_id").applyInPandas(join, "sequence_id long, n_tokens long, ids binary")

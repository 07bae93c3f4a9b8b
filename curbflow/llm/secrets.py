"""Secret scanning through a trigram inverted index.

Texts are indexed in segments: for every trigram of the lower-cased bytes, the
documents of the segment that hold it. Each rule's pattern gives a Boolean
trigram query; intersecting and uniting postings leaves the candidates, and only
those are searched with the pattern. A rule without mandatory trigrams searches
every document. Segments live within a task, so no text is moved, and their size
bounds the memory; ``postings`` gives the same index as a table, for rules that
come later.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.llm.common import session
from curbflow.llm.trigrams import Query, query_of, trigrams_in

SEGMENT_DOCS = 256
#: Bytes indexed at once; a longer text is indexed piece by piece.
PIECE_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 0
    group: int = 0

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        for m in re.finditer(self.pattern, text, re.ASCII):
            if len(m[self.group]) >= self.least:
                yield m.start(), m.end()


# The patterns of the base kinds, then common credential formats.
RULES = [
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_hook", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
]
BASE = ("assign", "access", "hex")

SPANS = T.ArrayType(
    T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ])
)


def _keys(data: bytes, ends: np.ndarray, first: int) -> np.ndarray:
    """Sorted trigram << 8 | document for the bytes of several texts laid end to end."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    doc = np.searchsorted(ends, np.arange(len(b)), side="right").astype(np.uint32)
    inside = doc[:-2] == doc[2:]
    codes = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    return np.unique((codes << 8 | (doc[:-2] + np.uint32(first)))[inside])


def _index(texts: list[bytes]) -> np.ndarray:
    """Postings of a segment of at most 256 texts, as sorted keys."""
    out, held, ends, first = [], [], [], 0

    def flush() -> None:
        if held:
            out.append(_keys(b"".join(held), np.cumsum(ends), first))

    for i, text in enumerate(texts):
        if sum(ends) + len(text) > PIECE_BYTES:
            flush()
            held, ends, first = [], [], i
        while len(text) > PIECE_BYTES:  # pieces overlap by two bytes, so no trigram is lost
            out.append(_keys(text[:PIECE_BYTES], np.array([PIECE_BYTES]), i))
            text = text[PIECE_BYTES - 2 :]
        held.append(text)
        ends.append(len(text))
    flush()
    return np.unique(np.concatenate(out)) if len(out) > 1 else out[0] if out else np.zeros(0, np.uint32)


def _candidates(query: Query, keys: np.ndarray, n: int) -> np.ndarray:
    """Which of a segment's ``n`` documents the query leaves."""
    if isinstance(query, bool):
        return np.full(n, query)
    if isinstance(query, int):
        lo, hi = np.searchsorted(keys, [query << 8, (query + 1) << 8])
        found = np.zeros(n, bool)
        found[keys[lo:hi] & 255] = True
        return found
    kind, parts = query
    combine = np.logical_and if kind == "and" else np.logical_or
    return combine.reduce([_candidates(q, keys, n) for q in parts])


def _scan(texts: list[str], rules: list[Rule], queries: list[Query]) -> list[list[tuple[str, int, int]]]:
    keys = _index([t.encode().lower() for t in texts])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries)):
        for i in np.flatnonzero(_candidates(query, keys, len(texts))):
            found[i] += [(start, k, end) for start, end in rule.spans(texts[i])]
    return [[(rules[k].kind, start, end) for start, k, end in sorted(f)] for f in found]


def secret_spans(text: Column, rules: list[Rule] = RULES) -> Column:
    """Array of ``(kind, start, end)`` in code points, by start, then rules in order."""
    queries = [query_of(r.pattern) for r in rules]

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        whole, out = [t or "" for t in texts], []
        for at in range(0, len(whole), SEGMENT_DOCS):
            for spans in _scan(whole[at : at + SEGMENT_DOCS], rules, queries):
                out.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
        return pd.Series(out)

    return scan(text)


def scanned(docs: DataFrame, name: str = "secrets", rules: list[Rule] = RULES) -> DataFrame:
    """``docs`` with an array column ``name`` of secret spans.

    A null or empty text has none, repeated rows have the same, matches of one
    rule do not overlap, those of several may. An empty table gives no rows;
    other columns pass through (``name`` must not be among them).
    """
    session(docs.sparkSession)
    return docs.withColumn(name, secret_spans(F.col("text"), rules))


def postings(docs: DataFrame) -> DataFrame:
    """``(trigram, doc_ids)``: the index as a table, a row per trigram and segment."""
    session(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for at in range(0, len(frame), SEGMENT_DOCS):
                part = frame.iloc[at : at + SEGMENT_DOCS]
                ids = part["doc_id"].to_numpy()
                keys = _index([(t or "").encode().lower() for t in part["text"]])
                if not len(keys):
                    continue
                groups = np.split(keys, np.flatnonzero(np.diff(keys >> 8)) + 1)
                yield pd.DataFrame(
                    {"trigram": [int(g[0] >> 8) for g in groups], "doc_ids": [ids[g & 255].tolist() for g in groups]}
                )

    rows = docs.select("doc_id", "text").where("doc_id is not null")
    return rows.mapInPandas(run, "trigram int, doc_ids array<long>")


def candidates(index: DataFrame, pattern: str) -> DataFrame | None:
    """``(doc_id)`` of the documents that may match; None if the pattern must search all."""
    query = query_of(pattern)
    if query is True:
        return None
    needed = sorted(trigrams_in(query))
    hits = index.where(F.col("trigram").isin(needed)).select("trigram", F.explode("doc_ids").alias("doc_id"))
    has = hits.groupBy("doc_id").agg(F.collect_set("trigram").alias("has"))  # at most the query's trigrams

    def holds(q: Query) -> Column:
        if isinstance(q, int):
            return F.array_contains("has", q)
        combine: Callable = (lambda a, b: a & b) if q[0] == "and" else (lambda a, b: a | b)
        out = holds(q[1][0])
        for x in q[1][1:]:
            out = combine(out, holds(x))
        return out

    return has.where(holds(query)).select("doc_id")

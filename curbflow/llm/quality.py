"""Quality rules: counting rules and a hashed n-gram likelihood ratio for every document.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials
over the buckets are fitted, one to trusted documents and one to the whole
corpus; a document's score is the mean of log p(trusted) - log p(corpus) over
its n-grams, so that length does not matter. The trusted side is smoothed towards the
corpus, so an n-gram without evidence scores about zero. Documents below a fixed threshold
are rejected. The corpus is counted in full; the trusted side is fitted on a
bounded sample of labelled rows (``target_rows``, smallest hashes first).
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.llm.common import fresh, session

BUCKETS = 1 << 16
#: Labelled documents that the trusted multinomial is fitted on, at most.
TARGET_ROWS = 20_000
#: Added to every bucket of the corpus.
SMOOTHING = 1.0
#: n-grams that the corpus lends the trusted side, by its shares: little trusted text says little against a document.
PRIOR = 1e6
#: Mean log ratio per n-gram below which a document is rejected.
THRESHOLD = -0.05
MIN_WORDS = 50
MAX_REPEATED = 0.5
SYMBOLS = "#*$%&|<>"
GAPS = " \t\n\x0b\x0c\r"

_WORD_SALT, _FIRST, _SECOND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

VERDICT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def _ids(words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int]]:
    """Each word's number within the text."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)), seen


def _grams(ids: np.ndarray, seen: dict[bytes, int], buckets: int) -> np.ndarray:
    """Bucket of every word and of every pair of neighbours."""
    shift = np.uint64(64 - buckets.bit_length() + 1)
    h = np.fromiter(map(crc32, seen), np.uint64, len(seen))[ids] + np.uint64(1)
    return np.concatenate([h * _WORD_SALT, h[:-1] * _FIRST ^ h[1:] * _SECOND]) >> shift


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that stand twice or more in the text."""
    if len(ids) < 4:
        return 0
    first = ids[:-2] * distinct + ids[1:-1]
    if distinct >= 1 << 20:  # three numbers would not fit into 63 bits
        first = np.unique(first, return_inverse=True)[1]
    _, which, counts = np.unique(first * distinct + ids[2:], return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : len(ids) - 2 + k] |= again
    return int(covered.sum())


def _base(text: str, ids: np.ndarray, distinct: int) -> tuple[int, int, int, int, int]:
    lines = [x for x in text.split("\n") if x.strip(GAPS)]
    return (
        len(ids),
        len(text) - sum(map(text.count, GAPS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(ids, distinct),
    )


def log_ratio(docs: DataFrame, trusted: DataFrame | None, buckets: int, target_rows: int) -> np.ndarray | None:
    """Log ratio of each bucket; None if no trusted document is found.

    Tasks send one row per bucket at most, so what reaches the driver is bounded
    by ``buckets``.
    """
    if trusted is None:
        return None
    ids = trusted.select(F.col("doc_id").alias("id")).where("id is not null").distinct()
    some = F.broadcast(ids.orderBy(F.xxhash64("id"), "id").limit(target_rows))  # at most target_rows ids
    rows = docs.select("doc_id", "text").join(some, F.col("doc_id") == F.col("id"), "left")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for frame in batches:
            for text, trust in zip(frame["text"], frame["trust"]):
                ids, seen = _ids((text or "").encode().split())
                if len(ids):
                    at, n = np.unique(_grams(ids, seen, buckets).astype(np.int64), return_counts=True)
                    raw[at] += n
                    if trust:
                        target[at] += n
        at = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": at, "raw": raw[at], "target": target[at]})

    counts = (
        rows.select("text", F.col("id").isNotNull().alias("trust"))
        .mapInPandas(count, "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()
    )
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[counts["bucket"]], target[counts["bucket"]] = counts["raw"], counts["target"]
    if not target.sum():
        return None
    share = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * buckets)
    return np.log((target + PRIOR * share) / (target.sum() + PRIOR)) - np.log(share)


def judged(
    docs: DataFrame,
    trusted: DataFrame | None,
    verdict: str = "verdict",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """All rows of ``docs`` with a struct column ``verdict`` of counts, score and ``kept``.

    ``trusted (doc_id)`` names trusted documents; with none of them in ``docs``
    the score is null and only the counting rules reject. A null or empty text
    has no words, fails the counting rules and has no score. Repeated rows are
    judged alike and each counts in the corpus. An empty table gives no rows;
    other columns pass through; a column named as ``verdict`` raises.
    """
    if verdict.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"column {verdict} is there already")
    spark = session(docs.sparkSession)
    ratio = log_ratio(docs, trusted, buckets, target_rows)
    held = spark.sparkContext.broadcast(ratio)

    @F.pandas_udf(VERDICT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        ratio, out = held.value, []
        for text in texts:
            text = text or ""
            ids, seen = _ids(text.encode().split())
            base = _base(text, ids, len(seen))
            score = None
            if ratio is not None and len(ids):
                score = float(ratio[_grams(ids, seen, buckets).astype(np.int64)].mean())
            failed = base[0] < MIN_WORDS or base[4] > MAX_REPEATED * base[0]
            out.append((*base, score, failed, not failed and (score is None or score >= threshold)))
        return pd.DataFrame(out, columns=VERDICT.names)

    return docs.withColumn(verdict, judge("text"))


def keep_good(docs: DataFrame, trusted: DataFrame | None) -> DataFrame:
    """The documents that all rules keep, with their columns as they were.

    Null and empty texts fail the counting rules and go; repeated rows stay or go together; a score at the
    threshold stays. An empty table gives no rows.
    """
    verdict = fresh(docs, "_verdict")
    return judged(docs, trusted, verdict).where(F.col(f"{verdict}.kept")).drop(verdict)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good; what is toxic is another operator's question."""
    return labels.where("quality = 1").select("doc_id")

"""What the operators share: stored intermediates, free column names, worker imports."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.session import folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: A word, as a pattern and as the bytes that ``bytes.split()`` cuts at: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"


def session(spark: SparkSession) -> SparkSession:
    """The session, with this package importable in its Python workers.

    A cluster installs the package; where driver and workers see the same
    folder (one machine), the folder itself is enough.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``)."""
    return folder(spark, "llm", f"{name}-{uuid.uuid4().hex[:10]}")


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here.

    A lost executor costs no rows, and what is read twice is computed once.
    """
    path = scratch(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of the frame has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))

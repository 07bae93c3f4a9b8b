"""Session helpers: a configured local session and the shared work folder."""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "curbflow", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    parallel = "8" if cores == "*" else cores
    settings = {
        "spark.sql.shuffle.partitions": parallel,
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A cluster must name one: executors there cannot see the driver's temporary
    folders. Only a local session falls back to one of its own.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return f"{named.rstrip('/')}/curbflow-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    own = _own_roots.get(spark.sparkContext.applicationId)
    if own is None:
        own = tempfile.mkdtemp(prefix="curbflow-")
        _own_roots[spark.sparkContext.applicationId] = own
    return own


_own_roots: dict[str, str] = {}


def folder(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_root(spark), *parts])


def digest(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()[:12]


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop)

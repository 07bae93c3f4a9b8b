"""What parquet files say of themselves: a metadata job over any number of files.

Paths are dealt to tasks, and each task opens its files' footers alone: no data page is
read, and nothing but sums and distinct states leaves the cluster. Stores that the tasks' file
layer cannot open are read through Spark, whole files then, for the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOOTER = (
    "path STRING, row_group INT, rows BIGINT, position INT, column_name STRING, type STRING, "
    "nulls BIGINT, low STRING, high STRING"
)


def _reader(by_content: bool):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq

        plain = {
            pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint", pa.float32(): "float",
            pa.float64(): "double", pa.string(): "string", pa.large_string(): "string", pa.bool_(): "boolean",
            pa.date32(): "date", pa.binary(): "binary",
        }

        def kind(t: pa.DataType) -> str:
            if pa.types.is_timestamp(t):
                return "timestamp" if t.tz else "timestamp_ntz"
            return f"decimal({t.precision},{t.scale})" if pa.types.is_decimal(t) else plain.get(t, str(t))

        def opened(path: str, content):
            if by_content:
                return pq.ParquetFile(pa.BufferReader(content))
            fs, name = pyarrow.fs.FileSystem.from_uri(path.replace(" ", "%20"))
            return pq.ParquetFile(fs.open_input_file(name))

        for frame in batches:
            rows = []
            for path, content in zip(frame["path"], frame["content"] if by_content else frame["path"]):
                with opened(path, content) as file:
                    meta, schema = file.metadata, file.schema_arrow
                # the writer's own types, where it left them
                own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                named = {f["name"]: f["type"] for f in json.loads(own)["fields"]} if own else {}
                spark_names = {"long": "bigint", "integer": "int", "short": "smallint", "byte": "tinyint"}
                for i, f in enumerate(schema):
                    said = named.get(f.name)
                    kind_of = spark_names.get(said, said) if isinstance(said, str) else kind(f.type)
                    if not meta.num_row_groups:
                        rows.append((path, 0, 0, i, f.name, kind_of, 0, None, None))
                    for g in range(meta.num_row_groups):
                        group = meta.row_group(g)
                        stats = next((group.column(k).statistics for k in range(group.num_columns) if group.column(k).path_in_schema == f.name), None)
                        known = stats is not None and stats.has_null_count
                        told = stats is not None and stats.has_min_max and stats.physical_type != "INT96"
                        limits = (str(stats.min), str(stats.max)) if told else (None, None)
                        rows.append((path, g, group.num_rows, i, f.name, kind_of, stats.null_count if known else None, *limits))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in FOOTER.split(", ")])
            yield out.astype({"nulls": "Int64"})

    return read


def footers(files: DataFrame, like: str | None = None) -> DataFrame:
    """A row per file, row group and column of ``files (path)``: rows, position, type, NULLs, least and greatest value.

    ``nulls``, ``low`` and ``high`` are null where a file does not tell. A file without rows has one row group of
    none; repeated paths are read again; no paths give no rows. ``like`` is a path in the same store, if the
    caller knows one. Paths are read where they are listed, so a listing's tasks share the work.
    """
    paths = files.select("path")
    if like is None:
        first = paths.limit(1).collect()
        like = first[0]["path"] if first else None
    if like is not None and not _reachable(like):
        spark = files.sparkSession
        whole = spark.read.format("binaryFile").load([r["path"] for r in paths.collect()]).select("path", "content")
        return whole.mapInPandas(_reader(True), FOOTER)
    return paths.mapInPandas(_reader(False), FOOTER)


def _reachable(path: str) -> bool:
    import pyarrow as pa
    import pyarrow.fs

    if "://" not in path and ":" not in path.split("/")[0]:
        return path.startswith("/")
    try:
        pyarrow.fs.FileSystem.from_uri(path.replace(" ", "%20"))
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ValueError):
        return False


def row_counts(found: DataFrame, *keys: str) -> DataFrame:
    """Rows per key of the files that :func:`footers` read; ``keys`` are columns joined to it, or none."""
    return found.where("position = 0").groupBy(*keys).agg(F.sum("rows").alias("rows"))

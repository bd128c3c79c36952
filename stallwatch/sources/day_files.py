"""Tables kept as one folder or file per day: what is there is told by names, and only the days asked for are opened."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_days(spark: SparkSession, root: str, day: str = "snapshot_date") -> list[tuple[date, str]]:
    """(day, path) of a table's days, in order: folders ``day=2024-01-31`` and files ``2024-01-31.parquet``.

    Other names are passed over, dates that do not exist among them; a root that is not there has no days. One name per
    day comes to the driver, and nothing is opened.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        text = re.fullmatch(rf"{re.escape(day)}=(\d{{4}}-\d\d-\d\d)", name) if entry.isDirectory() else re.fullmatch(r"(\d{4}-\d\d-\d\d)\.parquet", name)
        try:
            found += [(date.fromisoformat(text[1]), f"{root.rstrip('/')}/{name}")] if text else []
        except ValueError:
            continue
    return sorted(found)


def scan_days(spark: SparkSession, root: str, start: str, end: str, schema: T.StructType, day: str = "snapshot_date", defaults: dict | None = None) -> DataFrame:
    """The days from start to end as one frame of ``schema``; days that are missing are absent, and without any the frame is empty but typed.

    Columns are taken by name. Those that a file lacks, and values that are null, get their default, or null. The schema is
    given and the paths are those of the window, so that no other file is listed or opened, not even its footer.
    """
    window = [(d, p) for d, p in list_days(spark, root, day) if date.fromisoformat(start) <= d <= date.fromisoformat(end)]
    folders, files = [p for _, p in window if not p.endswith(".parquet")], [p for _, p in window if p.endswith(".parquet")]
    inside = T.StructType([f for f in schema if f.name != day])
    frames = []
    if folders:
        frames.append(spark.read.schema(T.StructType([*inside, T.StructField(day, T.DateType())])).option("basePath", root).parquet(*folders))
    if files:
        named = F.to_date(F.regexp_extract("_metadata.file_name", r"(\d{4}-\d\d-\d\d)\.parquet", 1))
        frames.append(spark.read.schema(inside).parquet(*files).withColumn(day, named))
    if not frames:
        return spark.createDataFrame([], schema)
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    return rows.select(*[F.coalesce(F.col(f.name), F.lit((defaults or {}).get(f.name)).cast(f.dataType)).cast(f.dataType).alias(f.name) for f in schema])


def depth(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """table, days, earliest, latest of tables given as name: (root, day column), from the names of their days alone."""
    rows = []
    for name, (root, day) in tables.items():
        days = sorted({d for d, _ in list_days(spark, root, day)})
        rows.append((name, len(days), days[0] if days else None, days[-1] if days else None))
    return spark.createDataFrame(rows, "table string, days long, earliest date, latest date")

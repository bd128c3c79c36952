"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def write_file(uri: str, data: bytes) -> None:
    """Writes a file from inside a task; it appears whole or not at all."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{path}.tmp", compression=None) as out:
        out.write(data)
    system.move(f"{path}.tmp", path)


def open_file(uri: str):
    """A stream of a file's bytes, inside a task."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path, compression=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Only where a single machine runs all, as in tests, an unset one gets a fresh folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="stallwatch-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: The Scratches that the innermost ``owned_tables`` of this thread has seen made.
_OWNED: ContextVar[list["Scratch"] | None] = ContextVar("owned", default=None)


class Scratch:
    """Written tables that cut lineage: a lost executor re-reads files instead of recomputing.

    Tables of one Scratch lie under one folder; ``drop`` removes those that nothing reads any more. A result that
    is still to be read keeps its tables; who writes it elsewhere makes it within ``owned_tables``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/stallwatch/{name}-{uuid.uuid4().hex}"
        owned = _OWNED.get()
        if owned is not None:
            owned.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def owned_tables() -> Iterator[None]:
    """Removes the tables that operators make within it, at its end; what they return must have been written elsewhere by then.

    Only what this thread makes is owned: other jobs of the driver keep theirs.
    """
    made: list[Scratch] = []
    token = _OWNED.set(made)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for scratch in made:
            scratch._delete(scratch.root)

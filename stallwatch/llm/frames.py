"""Helpers for operators that add columns to a table of documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwatch.llm.words import chunks


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or that with lines before it, so that it is none of ``taken``, whatever the case."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name = "_" + name
    return name


def add_columns(docs: DataFrame, text_col: str, keep: list[str] | None, added: str, compute: Callable[[pa.Array], list[pa.Array]], chunk_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with the columns of the DDL string ``added``, computed from chunks of whole texts.

    keep: columns to carry along (default: all). An input column named like an added one gives way to it.
    """
    new = T.StructType.fromDDL(added)
    names = [c for c in (docs.columns if keep is None else keep) if c not in new.names]
    text = text_col if text_col in names else free_name("text", names)
    carried = docs.select(*names) if text_col in names else docs.select(*names, F.col(text_col).alias(text))
    schema = T.StructType([docs.schema[c] for c in names] + list(new))
    at = carried.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text, chunk_bytes):
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + compute(batch.column(at)), names=schema.names)

    return carried.mapInArrow(run, schema)

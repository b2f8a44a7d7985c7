"""Column helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(text: Column) -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(whole_text(text), F.lit(WORD), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use, however it is spelt."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row, whatever reads them.

    The optimiser copies the expression of an ordinary column into every filter, and into the body of every
    lambda that reads it, where it would run once per element. It does not look into a generator.
    """
    made = F.struct(*[v.alias(k) for k, v in columns.items()])
    return df.select("*", F.inline(F.array(made)).alias(*columns))


def row_slices(batch: pa.RecordBatch, chars: int = 2_000_000, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``chars`` bytes of text, one row at least.

    Bounds the memory of a Python worker when many long documents share a batch.
    """
    column = batch.column(batch.schema.get_field_index(text))
    sizes = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.cumsum([len(v.as_buffer()) for v in sizes])
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + chars, side="right")))
        yield batch.slice(start, stop - start)
        start = stop

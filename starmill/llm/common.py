"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a Python task takes apart at once; bounds its memory whatever the Arrow batch holds.
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20


def text_of(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def pick(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `text` (null as empty) alone, so no other column can clash."""
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"))


def boxed(docs: DataFrame) -> DataFrame:
    """All columns in one struct `row`, beside which an operator's own columns cannot clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def unboxed(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def named_id(doc_id: Column) -> list[Column]:
    """An id as two columns without nulls, so that joins and grouping on them share one shuffle."""
    return [F.coalesce(doc_id.cast("long"), F.lit(0)).alias("id"), doc_id.isNull().alias("no_id")]


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus == remainder


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of at most `rows` rows and, unless it is one row, about `size` bytes.

    In the end what Arrow holds unused goes back to the system: a worker idles through later stages with what it keeps.
    """
    for batch in batches:
        open_ = [batch.slice(start, rows) for start in range(0, batch.num_rows, rows)][::-1]
        while open_:
            part = open_.pop()
            if part.nbytes > size and part.num_rows > 1:
                half = part.num_rows // 2
                open_ += [part.slice(half), part.slice(0, half)]
            else:
                yield part
    pa.default_memory_pool().release_unused()

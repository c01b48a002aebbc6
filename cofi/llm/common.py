"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: the six ASCII characters of [\x20\x09-\x0D], also what
#: ``bytes.split()`` splits at.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id BIGINT, text STRING, more...): only what an operator reads."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), *more)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a record batch to dicts of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cols in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type)
                     for c, f in ((cols[f.name], f) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, kind)


def pieces(batch: pa.RecordBatch, text_col: int = 1, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``max_bytes`` of text (one row at least), so the memory
    that a slice needs does not follow the number of rows in a batch."""
    start, size = 0, 0
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
    for i, n in enumerate(sizes):
        if size and size + n > max_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)

"""What the operators share: the columns they read, slices of Arrow batches, staged tables."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semstore.plans.workspace import new_path, remove, ship_package

#: A slice of a batch that is worked on at once holds about so many bytes of text.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that are read, as `doc_id` long and `text` string; all others are left behind."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, and `id`, `content`, which tell rows with different texts apart and order them.

    Rows with an id are told apart by it, and by 64 bits of their text where any id has several texts (else `content` is
    0, which costs nothing to carry). Rows without an id are told apart by 126 bits; they come after all ids below 2**62.
    """
    source, text = id_and_text(docs, id_col, text_col), F.col("text")
    own = F.xxhash64(text)
    texts = source.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(own).alias("a"), F.max(own).alias("b"))
    named = F.lit(0).cast("long") if texts.where("a <> b").isEmpty() else own
    last = F.lit(1 << 62) + F.xxhash64(F.lit("row"), text).bitwiseAND((1 << 62) - 1)
    content = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("no id"), text)).otherwise(named)
    return source.select("doc_id", F.coalesce("doc_id", last).alias("id"), content.alias("content"), "text")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: cuts the lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read.staged_path = path
    return read


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and let Spark's cleaner drop the shuffles that made them.

    What was made from them must be written already: then nothing is ever computed from them again.
    """
    for table_ in tables:
        remove(table_.sparkSession, table_.staged_path)
    # shuffle files go once the driver has collected the plans that refer to them, which a small driver heap rarely does
    gc.collect()
    tables[0].sparkSession.sparkContext._jvm.System.gc()


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `limit` bytes of text each; one long text is a part by itself."""
    column_data = batch.column(column)
    if not batch.num_rows:
        return
    sizes = np.array([len(x) if x is not None else 0 for x in map(_buffer, column_data)], dtype=np.int64)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(start, end - start)


def _buffer(value: pa.Scalar):
    return value.as_buffer() if value.is_valid else None


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    binary = column.cast(pa.binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary())
    return [x or b"" for x in binary.to_pylist()]


def texts_of(column: pa.Array) -> list[str]:
    """The texts; null is empty."""
    return [x or "" for x in column.to_pylist()]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of unsigned integers (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of `width` consecutive values; empty when there are fewer."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    base = ids.astype(np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mix(out * np.uint64(0x100000001B3) + base[i : i + n])
    return out

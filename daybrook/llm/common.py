"""Shared helpers: input columns, scratch tables, hashes over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybrook.session import materialize, work_path

__all__ = ["documents", "embeddings", "id_text", "materialize", "store", "texts_of", "mix64", "pack", "pack_sorted",
           "shards_for", "unpack", "unpack_sorted", "unused"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def id_text(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Only ``doc_id bigint`` and ``text`` (null text: empty); every other column, whatever its name, is left behind."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def unused(columns, name: str) -> str:
    """``name``, made longer until no column has it, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def store(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, for tables of packed bytes."""
    return materialize(df, name)


def texts_of(batch: pa.RecordBatch, name="text") -> list[bytes]:
    """UTF-8 bytes of a string column, without decoding."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def pack(values: np.ndarray) -> bytes:
    """64-bit values, compressed byte by byte: all first bytes, then all second ones; those that are alike take no room."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * count, codec="zstd", asbytes=True), np.uint8).reshape(8, count)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned values by their differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes, count: int) -> np.ndarray:
    return np.cumsum(unpack(data, count), dtype=np.uint64)


def shards_for(rows: int, per_shard: int) -> int:
    """Number of shards that hold about ``per_shard`` rows each, at any size of the input."""
    return max(1, -(-rows // per_shard))

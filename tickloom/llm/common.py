"""What the operators share: written tables, and row-wise Arrow passes over bounded pieces of text."""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

# Text bytes worked on at a time inside a task; a longer document makes a piece of its own.
PIECE_BYTES = 1 << 20


def written_at(df: DataFrame, label: str) -> str:
    """Write ``df`` to the shared scratch folder (compact); the path."""
    path = f"{scratch_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder (compact) and read it back."""
    return df.sparkSession.read.schema(df.schema).parquet(written_at(df, label))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def flat(column) -> pa.Array:
    """One contiguous string array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts back to back, and where each text begins (one more at the end)."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str | None, most: int = PIECE_BYTES):
    """Slices of whole rows with about ``most`` bytes of text each."""
    if text is None or batch.num_rows == 0:
        if batch.num_rows:
            yield batch
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def per_text(df: DataFrame, add: str, fn, keep=("doc_id",), text="text", most=PIECE_BYTES):
    """Add the columns of the schema string ``add`` row by row.

    ``fn`` gets an Arrow array of texts (nulls as empty) and returns one array per added column.
    The columns ``keep`` are carried along; one with an added column's name is replaced.
    """
    added = T._parse_datatype_string(add)
    kept = [c for c in keep if c not in added.names]
    inputs = kept if text in kept else [*kept, text]
    source = df.select(*inputs)
    schema = T.StructType([*(source.schema[c] for c in kept), *added.fields])

    def run(batches):
        for batch in batches:
            for part in pieces(batch, text, most):
                new = fn(flat(part.column(part.schema.get_field_index(text))))
                old = [part.column(part.schema.get_field_index(c)) for c in kept]
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in new]
                yield pa.RecordBatch.from_arrays([*old, *made], names=[*kept, *added.names])

    return source.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches small enough for long texts in a small executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def joined_sha(column) -> F.Column:
    """Lowercase sha-256 of the comma-joined strings of an array column."""
    return F.sha2(F.array_join(column, ","), 256)

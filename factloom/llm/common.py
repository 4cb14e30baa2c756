"""Shared Spark helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm import textvec
from factloom.sources.shared import beside, scratch, shared_dir, shared_folder


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """True where crc32 of the id as text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, keep: Column, max_rows: int) -> DataFrame:
    """(doc_id, text, y) of at most max_rows labelled ids, those with the smallest xxhash64(doc_id).

    The bound holds whatever the corpus size: several label rows of one id count as their largest label,
    several documents of one id as the one of the least text. The id list is small by its bound, hence
    broadcast.
    """
    ids = (
        labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
        .filter(keep)
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


def fit_in_one_task(sample: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """Run fit over a sample of bounded size in one task and bring the model's bytes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if got:
            yield pa.record_batch([pa.array([fit(pa.Table.from_batches(got))], pa.binary())], ["model"])

    rows = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return rows[0][0] if rows else b""


__all__ = ["beside", "bound_batches", "fit_in_one_task", "fold", "free_name", "labelled_sample", "map_texts", "scratch", "shared_dir", "shared_folder", "table"]

#: Arrow batches hold at most so many bytes of rows, or one row, unless the session says otherwise.
BATCH_BYTES = 8_000_000
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound what a task holds of a table of texts, in the executor's JVM and in its Python worker."""
    if spark.conf.get(_BATCH_KEY, None) in (None, "67108864b", "64MB"):
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def map_texts(
    df: DataFrame,
    fn: Callable[[np.ndarray, np.ndarray], dict[str, object]],
    fields: list[T.StructField],
    keep: list[str] | None = None,
    text: str | Column = "text",
    slice_bytes: int = textvec.SLICE_BYTES,
) -> DataFrame:
    """Add columns computed by fn(buffer, offsets) from whole texts, slice by slice of Arrow batches.

    keep lists the input columns to carry along (all by default). A new column takes the place of an
    input column of its name. A null text counts as empty.
    """
    names = [f.name for f in fields]
    carried = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([df.schema[c] for c in carried] + fields)
    kinds = {f.name: f.dataType for f in fields}
    bound_batches(df.sparkSession)
    whole = free_name(df, "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(whole))
            for lo, hi, buf, off in textvec.slices(column, slice_bytes):
                got = fn(buf, off)
                own = [batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in carried]
                new = [x if isinstance(x := got[n], (pa.Array, pa.ChunkedArray)) else pa.array(x, to_arrow_type(kinds[n])) for n in names]
                yield pa.record_batch(own + new, carried + names)
            pa.default_memory_pool().release_unused()

    return df.select(*carried, (F.col(text) if isinstance(text, str) else text).alias(whole)).mapInArrow(run, schema)


"""Shared storage and small helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.storage import drop, scratch, shared_root, store  # noqa: F401

#: White space of the word and equality rules: fixed values of the query contract.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def squeezed(text: Column) -> Column:
    """Text without its white space."""
    return F.translate(text, SPACE, "")


def small_batches(df: DataFrame) -> DataFrame:
    """df, in a session whose Arrow batches hold a few MB: workers keep what they once took, and whole texts are long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where its C library can do that."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def returning(fn):
    """fn for mapInArrow, whose worker gives back what its task took: workers live on beside the executor's JVM, idle or not."""

    def run(batches):
        yield from fn(batches)
        give_back()

    return run


def map_texts(docs: DataFrame, fn, schema: str, id_col: str = "doc_id", text_col: str = "text", most: int = 4 << 20) -> DataFrame:
    """mapInArrow over (id, text) in slices of about `most` bytes of text. fn(ids, texts) yields record
    batches; it gets the ids as an Arrow array and the texts as a list with None for null."""

    def run(batches):
        for batch in batches:
            text = batch.column(1)
            for a, b in _slices(text, most):
                yield from fn(batch.column(0).slice(a, b - a), text.slice(a, b - a).to_pylist())

    return small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(returning(run), schema)


def _slices(text, most: int):
    import numpy as np
    import pyarrow.compute as pc

    total = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))))
    a, n = 0, len(text)
    while a < n:
        b = max(a + 1, int(np.searchsorted(total, total[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)

"""Token counts from an exact length histogram.

Documents are aggregated by encoded length; the histogram has a row for each length that occurs. Suffix
sums over it (documents and tokens of at least a length) then answer every context limit at once:
truncated totals, dropped tokens and quantiles need no second pass over the texts.

Null text counts as empty: length 0. Repeated rows count each. Columns other than identifier and text aren't
read. An empty table has an empty histogram.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tesserae.llm.common import map_texts


def lengths(docs: DataFrame, vocabulary: str, kind: str = "byte", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens of each row."""

    def count(ids, texts):
        import numpy as np

        from tesserae.llm.tokens import encoder

        _, offset = encoder(vocabulary, kind).encode(texts)
        yield pa.record_batch([ids, pa.array(np.diff(offset))], ["id", "n_tokens"])

    return map_texts(docs, count, "id long, n_tokens long", id_col, text_col)


def histogram(lengths_: DataFrame) -> DataFrame:
    """n_tokens, n_docs."""
    return lengths_.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram_: DataFrame) -> DataFrame:
    """For each length L that occurs: docs_at_least and tokens_at_least (documents of L tokens or more),
    docs_below, and truncated_total, the tokens left when every document is cut to L. The window has a
    row for each distinct length, not for each document."""
    up = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    tokens = F.col("n_docs") * F.col("n_tokens")
    sums = histogram_.select(
        "n_tokens", "n_docs",
        F.sum("n_docs").over(down).alias("docs_at_least"), F.sum(tokens).over(down).alias("tokens_at_least"),
        F.coalesce(F.sum("n_docs").over(up), F.lit(0)).alias("docs_below"), F.coalesce(F.sum(tokens).over(up), F.lit(0)).alias("tokens_below"))
    return sums.withColumn("truncated_total", F.col("tokens_below") + F.col("docs_at_least") * F.col("n_tokens"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """limit, kept_tokens, cut_docs for any limits, from suffix sums alone."""
    wanted = sums.sparkSession.createDataFrame([(int(x),) for x in limits], "limit long")
    longer = sums.join(F.broadcast(wanted), F.col("n_tokens") > F.col("limit"), "right")
    cut = longer.groupBy("limit").agg(F.coalesce(F.max("docs_at_least"), F.lit(0)).alias("cut_docs"), F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("long_tokens"))
    total = sums.agg(F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("all_tokens"))
    return cut.join(F.broadcast(total)).select("limit", (F.col("all_tokens") - F.col("long_tokens") + F.col("cut_docs") * F.col("limit")).alias("kept_tokens"), "cut_docs")


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the smallest length with at least that share of documents at or below it."""
    wanted = sums.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    total = F.broadcast(sums.agg(F.max("docs_at_least").alias("total")))
    reached = sums.join(total).join(F.broadcast(wanted), F.col("docs_below") + F.col("n_docs") >= F.col("share") * F.col("total"))
    return reached.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))

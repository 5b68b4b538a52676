"""Exact deduplication as a stateful stream.

Rows arrive through a file stream as slim records (digest, code points, identifier, content locator).
A streaming aggregation without a watermark keeps one state entry per digest, for ever, in RocksDB on
the executors' disks, open only while its task runs: the retained row (most code points, then smallest identifier, then locator) and
the number of rows seen. The state is read back as a table. On a hit the normalised texts themselves
are compared; rows that share a digest with the retained row but not the text form classes of their own.

Everything is DataFrame work. The aggregation combines before it shuffles, so a digest that holds a
third of all rows costs one state update a task; the joins back are sort-merge joins on slim rows,
which adaptive execution can split where one key is large.

Null text counts as empty, empty texts equal each other. Rows repeated with the same identifier are
told apart by their locator: one of them stays. A null identifier sorts last. Other columns, whatever
their names, pass through `deduplicated` untouched.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import drop, scratch, squeezed, store, text_or_empty

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LAST = 2**63 - 1


def with_locator(docs: DataFrame) -> DataFrame:
    """docs with `__at`: file and row of its content. A frame that is no file scan is written first."""
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("the column hides the file's metadata")
        return docs.withColumn("__at", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))
    except AnalysisException:
        named = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
        held, _ = store(named, "content")
        at = held.withColumn("__at", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))
        return at.toDF(*docs.columns, "__at")


def _arrivals(located: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return located.select(
        F.sha2(squeezed(text), 256).alias("digest"),
        F.length(text).cast("long").alias("points"),
        F.col(id_col).cast("long").alias("id"),
        F.col("__at").alias("at"),
    )


def _run_stream(spark: SparkSession, arrivals: DataFrame, path: str, files_per_batch: int) -> DataFrame:
    """State after all files: digest, keep (points, id with its bits turned so that the least is the greatest, at), n."""
    session = spark.newSession()
    for key, value in (
        ("spark.sql.streaming.stateStore.providerClass", ROCKSDB),
        ("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"),
        ("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false"),
        ("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true"),
        ("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "64"),
        ("spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", "4"),
        ("spark.sql.streaming.stateStore.unloadOnCommit", "true"),  # else every partition's stays open on its executor
        ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
    ):
        session.conf.set(key, value)
    stream = session.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    order = F.struct("points", F.bitwise_not(F.coalesce("id", F.lit(LAST))).alias("turned_id"), F.struct("at.file", "at.row").alias("at"))
    state = stream.groupBy("digest").agg(F.max(order).alias("keep"), F.count(F.lit(1)).alias("n"))
    checkpoint = scratch(spark, "dedup-state")
    query = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    kept = session.read.format("statestore").load(checkpoint).select(F.col("key").getField("digest").alias("digest"), "value.*")
    kept, out = kept.toDF("digest", "keep", "n"), scratch(spark, "dedup-classes")
    kept.write.parquet(out)
    drop(spark, checkpoint)
    return spark.read.schema(kept.schema).parquet(out)


def classes(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", files_per_batch: int = 1000) -> DataFrame:
    """One row per input row: id, at (locator), keep_id, keep_at, group_size, digest; at = keep_at stays."""
    return _classes(spark, with_locator(docs), id_col, text_col, files_per_batch)


def _classes(spark: SparkSession, located: DataFrame, id_col: str, text_col: str, files_per_batch: int = 1000) -> DataFrame:
    arrivals, path = store(_arrivals(located, id_col, text_col), "arrivals")
    state = _run_stream(spark, arrivals, path, files_per_batch)
    state = state.select("digest", F.col("keep.at").alias("keep_at"), F.when(F.col("keep.turned_id") > -LAST - 1, F.bitwise_not(F.col("keep.turned_id"))).alias("keep_id"), F.col("n").alias("group_size"))
    out = arrivals.join(state, "digest").select("id", "at", "keep_id", "keep_at", "group_size", "digest")

    # Hits: the texts themselves decide. The least and the greatest text of a digest are combined before
    # the exchange, so copies don't travel.
    texts = located.select(F.col("__at").alias("at"), F.sha2(squeezed(text_or_empty(text_col)), 256).alias("digest"), squeezed(text_or_empty(text_col)).alias("body"))
    clash = texts.groupBy("digest").agg(F.min("body").alias("least"), F.max("body").alias("most")).where("least != most").select("digest")
    clashes, clash_path = store(clash, "clashes")
    if clashes.isEmpty():
        drop(spark, clash_path)
        return out
    kept = texts.join(clashes, "digest").join(state.select("digest", F.col("keep_at").alias("at")), ["digest", "at"]).select("digest", F.col("body").alias("kept_body"))
    other = texts.join(clashes, "digest").join(kept, "digest").where(F.col("body") != F.col("kept_body")).select("at", "digest", "body")
    own = other.join(arrivals.drop("digest"), "at")
    best = F.max(F.struct("points", F.bitwise_not(F.coalesce("id", F.lit(LAST))).alias("turned_id"), "at"))
    parts = own.groupBy("body").agg(best.alias("keep"), F.count(F.lit(1)).alias("n"))
    split = own.join(parts, "body").select(
        "at", F.col("keep.at").alias("keep_at2"), F.when(F.col("keep.turned_id") > -LAST - 1, F.bitwise_not(F.col("keep.turned_id"))).alias("keep_id2"), F.col("n").alias("n2"))
    gone = other.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
    return out.join(split, "at", "left").join(gone, "digest", "left").select(
        "id", "at", F.when(F.col("n2").isNull(), F.col("keep_id")).otherwise(F.col("keep_id2")).alias("keep_id"),
        F.coalesce("keep_at2", "keep_at").alias("keep_at"), F.coalesce("n2", F.col("group_size") - F.coalesce("gone", F.lit(0))).alias("group_size"), "digest")


def deduplicated(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with the columns of docs."""
    aside, taken = "__at_", {c.lower() for c in docs.columns}
    while aside in taken:
        aside += "_"
    located = with_locator(docs.withColumnRenamed("__at", aside))  # a column of that name waits under another
    stay = _classes(spark, located, id_col, text_col).where("at = keep_at").select(F.col("at").alias("__at"))
    kept = located.join(stay, "__at", "left_semi")
    return kept.select(*(F.col(aside).alias(c) if c.lower() == "__at" else F.col(f"`{c}`") for c in docs.columns))

"""The corpus pipeline: toxic documents go, copies and near copies go, long repeats are cut out of what
is left, and the rest is packed into training sequences. Each stage works on what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm import exact_dedup, near_dedup, packing, suffix_dedup, toxicity
from tesserae.llm.common import drop, store, table, text_or_empty
from tesserae.llm.queries import vocabulary

#: Five-word shingles, linked from a similarity of 0.8; repeated runs of more than 50 words, found as strings
#: of 150 bytes, which a run of so many words hardly ever falls short of; windows of 1024 ids.
SHINGLE, PERCENT, REPEAT, WORDS, WIDTH = 5, 80, 150, 51, 1024


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    return toxicity.without_toxic(spark, docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without their white space, the longest in code points."""
    return exact_dedup.deduplicated(spark, docs)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest identifier. Documents without words stay.
    Rows are told apart by identifier and text, so those that share an identifier go each by its own text."""
    gone_id, gone_at = _free(docs, "__gone"), _free(docs, "__at")
    found = near_dedup.components(spark, docs, SHINGLE, PERCENT)
    gone = found.where("NOT kept").select(near_dedup.label("id").alias(gone_id), F.col("at").alias(gone_at)).distinct()
    return docs.join(gone, (near_dedup.label() == F.col(gone_id)) & (near_dedup.text_hash() == F.col(gone_at)), "left_anti")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their runs of WORDS or more words whose every byte lies in a repeated string of REPEAT
    bytes; n_chars follows. Every row stays."""
    of, key, kept = (_free(docs, n) for n in ("__of", "__key", "__kept"))
    found = suffix_dedup.cleaned(spark, docs, REPEAT, with_text=True, words=WORDS)
    changed = found.where("kept_text IS NOT NULL").select(F.col("key").alias(key), F.col("kept_text").alias(kept)).dropDuplicates([key])
    keyed = docs.withColumn(of, F.unhex(F.sha2(F.encode(text_or_empty(), "utf-8"), 256)))
    joined = keyed.join(changed, F.col(of) == F.col(key), "left")
    new = {"text": F.coalesce(kept, "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept).cast(dict(docs.dtypes)["n_chars"]))
    return joined.withColumns(new).select(*(F.col(f"`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece: its document, start, length, checksum, sequence, offset and token ids."""
    return packing.packed(spark, docs, vocabulary("byte_bpe_50k.json"), width=WIDTH).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("suffix_dedup", cut_repeats), ("packing", pack)]

#: No SQL: the stages learn, hash and pack. tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's rows stored before the next, whose input goes then."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = store(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:
            drop(spark, before)
        before = path
    return docs


def queries():
    return {"pipeline": run}, ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})

import hashlib
import re
from collections import defaultdict

from tesserae.llm import exact_dedup

SPACE = re.compile("[\x20\x09-\x0d]")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r[1] or "")].append(r)
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda r: (-len(r[1] or ""), r[0]))[0]
        out += [(r[0], keep, len(members), hashlib.sha256(body.encode()).hexdigest()) for r in members]
    return sorted(out)


def test_classes(spark, docs, rows):
    got = exact_dedup.classes(spark, docs, files_per_batch=1)
    assert sorted((r["id"], r["keep_id"], r["group_size"], r["digest"]) for r in got.collect()) == brute(rows)
    kept = [r for r in got.collect() if r["at"] == r["keep_at"]]
    assert len(kept) == len({r["digest"] for r in kept}) == len({b[3] for b in brute(rows)})


def test_kept_rows_have_the_input_columns(spark, docs, rows, no_docs):
    kept = exact_dedup.deduplicated(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({b[1] for b in brute(rows)})
    memory = exact_dedup.deduplicated(spark, spark.createDataFrame(docs.toPandas(), docs.schema))
    assert sorted(r["doc_id"] for r in memory.collect()) == sorted({b[1] for b in brute(rows)})
    assert exact_dedup.classes(spark, no_docs).count() == 0


def test_digests_that_collide_are_told_apart_by_their_texts(spark, docs, rows, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "sha2", lambda col, bits: F.substring(F.md5(col), 1, 1))
    got = exact_dedup.classes(spark, docs).collect()
    assert sorted((r["id"], r["keep_id"], r["group_size"]) for r in got) == [b[:3] for b in brute(rows)]


def test_state_is_closed_as_tasks_end(spark, docs):
    """Each partition's state takes native memory while it is open; an executor holds one for each task that runs."""
    exact_dedup.classes(spark, docs).count()
    module = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.execution.streaming.state.StateStore$")
    held = module.getDeclaredField("loadedProviders")
    held.setAccessible(True)
    assert held.get(module.getField("MODULE$").get(None)).size() == 0

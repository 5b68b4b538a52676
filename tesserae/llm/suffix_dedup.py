"""Removal of long repeated byte strings with sharded suffix arrays.

A byte goes if it lies in a string of `length` bytes that also starts anywhere else, in another document
or the same one, as the input stands.

1. Equal texts are one text with a count; a text with copies goes whole if it has `length` bytes.
2. Winnowing (`tesserae.llm.winnow`) leaves the stretches that can hold a repeated string. It loses none.
   Equal stretches are one stretch with a count.
3. Stretches are range-partitioned by their least winnowed hash, so that repeats tend to meet, and cut
   into shards of bounded size. A passage that a third of all documents share is spread over many
   shards. Each shard gets a suffix array and common prefixes (`tesserae.llm.suffix`); neighbours that
   share `length` bytes are repeats within the shard, and each class keeps one place to stand for it.
4. Repeats across shards: coarse hashes of the standing places that occur in two shards or more name the
   candidates. Each shard sends the sorted 128-bit digests of its candidates to ranges of the digest
   space; a range merges the shards' sorted runs by binary search, and answers which are in two.
5. Ranges found by shards, by merging and by counts are united per text and cut out.

Null text counts as empty. Texts shorter than `length` lose nothing. Matches never cross documents.
Kept bytes that are no longer valid UTF-8 are dropped from `kept_text`, but not from the digest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.llm.common import drop, map_texts, returning, store
from tesserae.llm.winnow import among, gram_hashes, selected, stretches, widths

#: Bytes of a shard, and of a stretch, at most (longer stretches are cut with overlap); bytes of the
#: digests that one task merges at a time, about.
SHARD_BYTES, STRETCH_BYTES, MERGE_BYTES = 1_500_000, 1 << 20, 16 << 20
#: Bytes of stretches that one task cuts into shards, at most about; shorter strings than LEAST aren't told apart
#: from chance.
TASK_BYTES, LEAST = 64 << 20, 50
#: Rows of a text with more copies than OFTEN and than this part of all rows (so at most OFTEN_KEYS texts, whose keys
#: every task gets) don't travel to their text.
OFTEN, OFTEN_KEYS = 64, 10_000


def _profiles(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """id, key (text digest), n_bytes, n_words, hashes: the distinct hashes selected in the text, and those
    of them selected at two places of it."""
    widths_ = widths(length)

    def run(ids, texts):
        import hashlib

        keys, sizes, words, hashes, twice = [], [], [], [], []
        for t in texts:
            raw = (t or "").encode()
            keys.append(hashlib.sha256(raw).digest())
            sizes.append(len(raw))
            words.append(len(raw.split()))
            if len(raw) >= length:
                h, n = np.unique(selected(np.frombuffer(raw, np.uint8), *widths_)[1], return_counts=True)
                hashes.append(h.view(np.int64))
                twice.append(h[n > 1].view(np.int64))
            else:
                hashes.append(np.empty(0, np.int64))
                twice.append(np.empty(0, np.int64))
        yield pa.record_batch([ids, pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(words, pa.int64()), pa.array(hashes, pa.list_(pa.int64())), pa.array(twice, pa.list_(pa.int64()))], ["id", "key", "n_bytes", "n_words", "hashes", "twice"])

    return map_texts(docs, run, "id long, key binary, n_bytes long, n_words long, hashes array<long>, twice array<long>", id_col, text_col, 1 << 20)


def _stretches(docs: DataFrame, wanted: DataFrame, length: int, text_col: str) -> DataFrame:
    """key, body, starts and ends of the stretches of each wanted text (key, known: its hashes that repeat).
    Copies of a text become one before they travel."""
    widths_ = widths(length)
    texts = docs.select(F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("body")).where(F.length("body") >= length).withColumn("key", F.unhex(F.sha2("body", 256)))
    found = texts.groupBy("key").agg(F.first("body").alias("body")).join(wanted, "key")

    def run(batches):
        for b in batches:
            keys, bodies, starts, ends = [], [], [], []
            for k, body, known in zip(*(b.column(c) for c in ("key", "body", "known"))):
                k, raw = k.as_py(), body.as_py()
                known = np.sort(known.values.to_numpy().view(np.uint64))
                least, _ = selected(np.frombuffer(raw, np.uint8), *widths_)
                cut = np.flatnonzero(np.concatenate((np.ones(1, bool), least[1:] != least[:-1])))
                ok = np.repeat(among(least[cut], known), np.diff(np.append(cut, len(least))))
                parts = []
                for x, y in stretches(ok, length, *widths_):
                    while y - x > STRETCH_BYTES:
                        parts.append((x, x + STRETCH_BYTES))
                        x += STRETCH_BYTES - length + 1
                    parts.append((x, y))
                if parts:
                    keys.append(k)
                    bodies.append(raw)
                    starts.append([p[0] for p in parts])
                    ends.append([p[1] for p in parts])
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(bodies, pa.binary()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))], ["key", "body", "starts", "ends"])

    return found.mapInArrow(returning(run), "key binary, body binary, starts array<long>, ends array<long>")


def _slot(key: str):
    """The first eight bytes of a key as a number: short to send."""
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long")


def _pieces(texts: DataFrame, length: int) -> DataFrame:
    """piece (digest), bytes, least (hash that orders shards), key, start: a row per stretch."""
    widths_ = widths(length)

    def run(batches):
        import hashlib

        for b in batches:
            for key, body, starts, ends in zip(*(b.column(c) for c in ("key", "body", "starts", "ends"))):
                raw = body.as_py()
                parts = [raw[x:y] for x, y in zip(starts.as_py(), ends.as_py())]
                least = [int(selected(np.frombuffer(p, np.uint8), *widths_)[0].min().view(np.int64)) for p in parts]
                yield pa.record_batch(
                    [pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in parts], pa.binary()), pa.array(parts, pa.binary()), pa.array(least, pa.int64()), pa.array([key.as_py()] * len(parts), pa.binary()), starts.values],
                    ["piece", "bytes", "least", "key", "start"])

    return texts.mapInArrow(returning(run), "piece binary, bytes binary, least long, key binary, start long")


class _Shard:
    """Distinct stretches end to end, with a zero byte after each."""

    def __init__(self, pieces: list[bytes], bodies: list[bytes], length: int):
        self.pieces = pieces
        self.size = np.array([len(b) for b in bodies], np.int64)
        self.begin = np.cumsum(self.size + 1) - self.size - 1
        self.data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
        self.length = length
        self.valid = np.zeros(len(self.data), bool)
        for a, n in zip(self.begin.tolist(), self.size.tolist()):
            self.valid[a : a + n - length + 1] = True

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts that repeat within the shard, and one start for each class of equal strings."""
        from tesserae.llm.suffix import common_prefixes, suffix_array

        order = suffix_array(self.data)
        same = common_prefixes(self.data, order) >= self.length
        repeated = np.zeros(len(self.data), bool)
        repeated[order[same]] = True
        repeated[order[np.flatnonzero(same) - 1]] = True
        stands = np.zeros(len(self.data), bool)
        stands[order[~same]] = True
        return repeated & self.valid, stands & self.valid

    def coarse(self, stands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start the coarse hash of its string, and the distinct ones of the standing starts.
        The hash is the least of the grams that lie within the string, so equal strings agree."""
        gram = self.length * 3 // 4
        h = gram_hashes(self.data, gram)
        from tesserae.llm.winnow import sliding

        least = sliding(h, self.length - gram + 1, np.minimum, np.iinfo(np.uint64).max)
        least = np.concatenate((least, np.zeros(len(self.data) - len(least), np.uint64)))
        return least, np.unique(least[stands])

    def digests(self, starts: np.ndarray) -> np.ndarray:
        """128 bits of the string at each start, as two columns."""
        a = gram_hashes(self.data, self.length)[starts]
        b = gram_hashes(_SHUFFLED[self.data], self.length, other=True)[starts]
        return np.stack((a, b), 1)

    def ranges(self, marked: np.ndarray) -> pa.RecordBatch:
        """piece, starts, ends: united ranges of the strings at the marked starts, within each stretch."""
        pieces, starts, ends = [], [], []
        edge = np.flatnonzero(np.diff(np.concatenate((np.zeros(1, np.int8), marked.astype(np.int8), np.zeros(1, np.int8)))))
        a, b = edge[::2], edge[1::2] + self.length - 1
        owner = np.searchsorted(self.begin, a, "right") - 1
        for k in np.unique(owner).tolist():
            pieces.append(self.pieces[k])
            starts.append((a[owner == k] - self.begin[k]).tolist())
            ends.append((b[owner == k] - self.begin[k]).tolist())
        return pa.record_batch([pa.array(pieces, pa.binary()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))], ["piece", "starts", "ends"])


_SHUFFLED = np.random.default_rng(20).permutation(256).astype(np.uint8)


def _shards(distinct: DataFrame, length: int, tasks: int) -> DataFrame:
    """A row per shard: shard, pieces, sizes, body (its stretches end to end), stands (packed bits),
    coarse, and the repeats within it (hit, starts, ends: one list for each stretch that has any)."""

    def run(batches):
        task, n, pieces, bodies, held = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            s = _Shard(pieces, bodies, length)
            repeated, stands = s.repeats()
            hit = s.ranges(repeated)
            wrap = lambda x, t: pa.array([x], pa.list_(t))
            return pa.record_batch(
                [[task << 24 | n], wrap(pieces, pa.binary()), wrap([len(b) for b in bodies], pa.int64()), pa.array([b"".join(bodies)], pa.large_binary()).cast(pa.binary()), pa.array([np.packbits(stands).tobytes()], pa.binary()), wrap(s.coarse(stands)[1].view(np.int64), pa.int64()), wrap(hit.column("piece").to_pylist(), pa.binary()), wrap(hit.column("starts").to_pylist(), pa.list_(pa.int64())), wrap(hit.column("ends").to_pylist(), pa.list_(pa.int64()))],
                ["shard", "pieces", "sizes", "body", "stands", "coarse", "hit", "starts", "ends"])

        for b in batches:
            for piece, body in zip(b.column("piece"), b.column("bytes")):
                if pieces and held + len(body.as_buffer()) > SHARD_BYTES:
                    yield close()
                    n, pieces, bodies, held = n + 1, [], [], 0
                pieces.append(piece.as_py())
                bodies.append(body.as_py())
                held += len(bodies[-1]) + 1
        if pieces:
            yield close()

    ordered = distinct.select("least", "piece", "bytes").repartitionByRange(tasks, "least", "piece").sortWithinPartitions("least", "piece")
    return ordered.mapInArrow(returning(run), "shard long, pieces array<binary>, sizes array<long>, body binary, stands binary, coarse array<long>, hit array<binary>, starts array<array<long>>, ends array<array<long>>")


def _rebuilt(row, length: int) -> _Shard:
    sizes, body = row["sizes"].as_py(), row["body"].as_py()
    at = np.concatenate(([0], np.cumsum(sizes))).tolist()
    return _Shard(row["pieces"].as_py(), [body[a:b] for a, b in zip(at, at[1:])], length)


def _rows(batch: pa.RecordBatch):
    for i in range(len(batch)):
        yield {c: batch.column(c)[i] for c in batch.schema.names}


def _runs(shards: DataFrame, shared: DataFrame, length: int, ranges: int) -> DataFrame:
    """range, shard, digests: each shard's sorted digests of the strings that may stand elsewhere too."""

    def run(batches):
        for b in batches:
            for row in _rows(b):
                s = _rebuilt(row, length)
                stands = np.unpackbits(np.frombuffer(row["stands"].as_buffer(), np.uint8), count=len(s.data)).astype(bool)
                known = np.sort(row["shared"].values.to_numpy().view(np.uint64))
                least, _ = s.coarse(stands)
                starts = np.flatnonzero(stands & among(least, known))
                d = s.digests(starts)
                d = d[np.lexsort((d[:, 1], d[:, 0]))]
                part = (d[:, 0] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
                cut = np.searchsorted(part, np.arange(ranges + 1))
                full = [k for k in range(ranges) if cut[k] < cut[k + 1]]
                yield pa.record_batch([pa.array(full, pa.int64()), pa.array([row["shard"].as_py()] * len(full), pa.int64()), pa.array([d[cut[k] : cut[k + 1]].astype(">u8").tobytes() for k in full], pa.binary())], ["range", "shard", "digests"])

    return shards.select("shard", "pieces", "sizes", "body", "stands").join(shared, "shard").mapInArrow(returning(run), "range long, shard long, digests binary")


def _merged(runs: DataFrame) -> DataFrame:
    """shard, digests: those that another shard has too."""

    def merge(x, y):
        at = np.searchsorted(x[0], y[0])
        return np.insert(x[0], at, y[0]), np.insert(x[1], at, y[1])

    def answer(group):
        level = [(np.frombuffer(d, "S16"), np.full(len(d) // 16, shard)) for shard, d in group]
        while len(level) > 1:
            level = [merge(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        if not level:
            return []
        keys, owner = level[0]
        same = np.concatenate(([False], keys[1:] == keys[:-1], [False]))  # a shard sends a digest once
        hit = same[1:] | same[:-1]
        keys, owner = keys[hit], owner[hit]
        order = np.argsort(owner, kind="stable")
        cut = np.flatnonzero(np.diff(owner[order])) + 1
        return [(int(owner[part[0]]), keys[part].tobytes()) for part in np.split(order, cut) if len(part)]

    def sent(out):
        return pa.record_batch([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["shard", "digests"])

    def run(batches):
        now, group = None, []
        for b in batches:
            out = []
            for r, shard, d in zip(b.column("range").to_pylist(), b.column("shard").to_pylist(), b.column("digests").to_pylist()):
                if r != now:
                    out += answer(group)
                    now, group = r, []
                group.append((shard, d))
            yield sent(out)
        yield sent(answer(group))

    return runs.repartition("range").sortWithinPartitions("range", "shard").mapInArrow(returning(run), "shard long, digests binary")


def _across(shards: DataFrame, merged: DataFrame, length: int) -> DataFrame:
    """piece, starts, ends: ranges of the strings that another shard has too. All starts of a class are
    found again by their digest, so those within the shard are among them."""
    answers = merged.groupBy("shard").agg(F.collect_list("digests").alias("digests"))  # within a shard's own size

    def run(batches):
        for b in batches:
            for row in _rows(b):
                s = _rebuilt(row, length)
                known = np.frombuffer(b"".join(row["digests"].as_py()), ">u8").astype(np.uint64).reshape(-1, 2)
                first = np.unique(known[:, 0])
                starts = np.flatnonzero(s.valid)
                starts = starts[among(gram_hashes(s.data, length)[starts], first)]
                d = s.digests(starts)
                whole = np.ascontiguousarray(d).view("V16").ravel()
                marked = np.zeros(len(s.data), bool)
                marked[starts[np.isin(whole, np.ascontiguousarray(known).view("V16").ravel())]] = True
                yield s.ranges(marked)

    return shards.select("shard", "pieces", "sizes", "body").join(answers, "shard").mapInArrow(returning(run), "piece binary, starts array<long>, ends array<long>")


def _cut(texts: DataFrame, ranges: DataFrame, with_text: bool, words: int) -> DataFrame:
    """key, n_removed, n_spans, kept_sha256[, kept_text] of the texts that have ranges (key, spans). Spans of
    fewer words stay."""

    def run(batches):
        import hashlib

        for b in batches:
            removed, spans, digests, kept_texts = [], [], [], []
            for body, parts in zip(b.column("body"), b.column("spans")):
                raw, gone, at, kept = body.as_py(), [], 0, []
                for p in sorted((x["start"], x["end"]) for x in parts.as_py()):
                    if gone and p[0] <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], p[1])
                    else:
                        gone.append([*p])
                gone = [g for g in gone if not words or len(raw[g[0] : g[1]].split()) >= words]
                for x, y in gone:
                    kept.append(raw[at:x])
                    at = y
                left = b"".join([*kept, raw[at:]])
                removed.append(len(raw) - len(left))
                spans.append(len(gone))
                digests.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept_texts.append(left.decode("utf-8", "ignore"))
            cols = [b.column("key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            names = ["key", "n_removed", "n_spans", "kept_sha256"]
            yield pa.record_batch(cols + [pa.array(kept_texts, pa.string())] * with_text, names + ["kept_text"] * with_text)

    schema = "key binary, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    return texts.select("key", "body").join(ranges, "key").select("key", "body", "spans").mapInArrow(returning(run), schema)


def cleaned(spark: SparkSession, docs: DataFrame, length: int = 400, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text", words: int = 0) -> DataFrame:
    """id, key, n_bytes, n_removed, n_spans, kept_sha256[, kept_text: null where nothing was removed] of
    each row. With `words`, removed runs of fewer words (or parts of words, at the ends) stay."""
    if length < LEAST:
        raise ValueError(f"length is at least {LEAST}")
    profiles, _ = store(_profiles(docs, length, id_col, text_col), "profiles")
    texts, texts_path = store(profiles.groupBy("key").agg(F.min(F.struct("hashes", "twice")).alias("p")).select("key", _slot("key").alias("slot"), "p.*"), "texts")
    each = texts.select("slot", F.explode("hashes").alias("hash"))
    counted = texts.select(F.explode("hashes").alias("hash")).union(texts.select(F.explode("twice").alias("hash"))).groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    known = each.join(counted, "hash", "left_semi").groupBy("slot").agg(F.collect_list("hash").alias("known"))  # at most a text's own hashes
    wanted = texts.select("slot", "key").join(known, "slot").select("key", "known")  # texts that share a slot are tried with the hashes of both
    stretched, stretched_path = store(_stretches(docs, wanted, length, text_col), "stretches")
    drop(spark, texts_path)

    pieces, pieces_path = store(_pieces(stretched, length), "pieces")
    distinct = pieces.groupBy("piece").agg(F.first("least").alias("least"), F.first("bytes").alias("bytes"))
    volume = pieces.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    tasks = 1 + max(volume // TASK_BYTES, min(32 * spark.sparkContext.defaultParallelism, 2 * volume // SHARD_BYTES))
    shards, shards_path = store(_shards(distinct, length, int(tasks)), "shards")
    coarse = shards.select("shard", F.explode("coarse").alias("hash"))
    several = coarse.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    shared = coarse.join(several, "hash", "left_semi").groupBy("shard").agg(F.collect_list("hash").alias("shared"))  # within a shard's own size
    merged, merged_path = store(_merged(_runs(shards, shared, length, int(max(8, volume * 4 // MERGE_BYTES)))), "merged")

    within = shards.select(F.explode(F.arrays_zip("hit", "starts", "ends")).alias("r")).select(F.col("r.hit").alias("piece"), "r.starts", "r.ends")
    found, found_path = store(within.union(_across(shards, merged, length)), "found")
    spans = found.select("piece", F.explode(F.arrays_zip("starts", "ends")).alias("r")).select("piece", F.struct(F.col("r.starts").alias("start"), F.col("r.ends").alias("end")).alias("span"))
    slim = pieces.select("piece", "key", "start", F.length("bytes").alias("n"))
    copied = slim.groupBy("piece").agg(F.count(F.lit(1)).alias("copies"), F.max("n").alias("n")).where("copies > 1")
    spans = spans.union(copied.select("piece", F.struct(F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end")).alias("span")))
    placed = slim.join(spans.groupBy("piece").agg(F.collect_set("span").alias("spans")), "piece")
    ranges = placed.select("key", F.explode(F.transform("spans", lambda s: F.struct((s["start"] + F.col("start")).alias("start"), (s["end"] + F.col("start")).alias("end")))).alias("span")).groupBy("key").agg(F.collect_list("span").alias("spans"))
    done, _ = store(_cut(stretched, ranges, with_text, words), "cut")
    drop(spark, pieces_path, shards_path, merged_path, found_path, stretched_path)

    copies = profiles.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    often = F.broadcast(copies.where(F.col("copies") > max(OFTEN, profiles.count() // OFTEN_KEYS)))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length) & (F.col("n_words") >= words)
    empty = F.sha2(F.lit(""), 256)
    rows = profiles.select("id", "key", "n_bytes", "n_words")
    # a text with copies goes whole or not at all, so rows of texts with many are answered where they lie
    out = rows.join(often, "key", "left_anti").join(copies.join(done, "key", "left"), "key").unionByName(rows.join(often, "key"), allowMissingColumns=True)
    out = out.withColumn("n_removed", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))).withColumn("n_spans", F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long")).withColumn("kept_sha256", F.when(whole, empty).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("key")))))
    if with_text:
        out = out.withColumn("kept_text", F.when(whole, "").otherwise(F.when(F.col("n_removed") > 0, F.col("kept_text"))))
    return out.drop("copies", "n_words")

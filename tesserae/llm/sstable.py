"""Token ids in sorted-string tables.

A file holds documents in ascending order of their key (null first, then the identifier), and consists
of data blocks, an index, a Bloom filter and a footer:

* entry: varints for the bytes shared with the previous key, the other key bytes, and twice the number
  of ids, plus one if they are wide; then the key bytes that aren't shared, then the ids as
  little-endian unsigned integers of 16 bits, or of 32 bits if they are wide. The first entry of a block
  shares nothing;
* block: entries compressed by zstd, then the CRC-32 of the compressed bytes. A block is closed when
  its entries reach `BLOCK_BYTES`;
* index: for each block its last key's length and bytes, offset and size;
* filter: bits set at (h1 + i * h2) mod size for seven i, from the halves of the key's 128-bit xxHash;
* footer, 56 bytes: offset and size of index and filter, documents, ids (six 64-bit), then the magic.

A lookup reads the footer, asks the filter, finds its block by binary search in the index and reads that
block alone. Writing: rows are range-partitioned by identifier, and a task writes files of bounded size
under names made from its number, by way of a temporary name. The order is total, so a repeated or
speculative attempt writes the same bytes; files are complete or absent.

Null text counts as empty: its end id alone. Rows that repeat an identifier are ordered by their text's
hash and all kept. An empty table gives no files.
"""

from __future__ import annotations

import bisect
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesserae.llm.common import scratch, store

MAGIC, FOOTER = b"TESSST01", struct.Struct("<6Q8s")
BLOCK_BYTES, FILE_BYTES = 64 << 10, 8 << 20
BITS_PER_KEY, PROBES = 10, 7


def key_of(doc_id: int | None) -> bytes:
    return b"\0" * 9 if doc_id is None else b"\1" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:])[0] - (1 << 63) if key[0] else None


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        n, at, shift = n | (byte & 127) << shift, at + 1, shift + 7
        if byte < 128:
            return n, at


def _probes(key: bytes, size: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % size for i in range(PROBES)]


class Writer:
    """Builds one file in memory, bounded by FILE_BYTES and its longest document."""

    def __init__(self, block_bytes: int = BLOCK_BYTES):
        self.block_bytes = block_bytes
        self.data, self.block, self.index, self.keys, self.last, self.ids = bytearray(), bytearray(), [], [], b"", 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        wide = bool(ids.size and ids.max() > 0xFFFF)
        shared = 0
        if self.block:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        self.block += varint(shared) + varint(len(key) - shared) + varint(2 * len(ids) + wide) + key[shared:] + ids.astype("<u4" if wide else "<u2").tobytes()
        self.last, self.ids = key, self.ids + len(ids)
        self.keys.append(key)
        if len(self.block) >= self.block_bytes:
            self._close_block()

    def _close_block(self) -> None:
        if self.block:
            packed = zstandard.compress(bytes(self.block), 1)
            self.index.append((self.last, len(self.data), len(packed) + 4))
            self.data += packed + struct.pack("<I", zlib.crc32(packed))
            self.block = bytearray()

    def finish(self) -> bytes:
        self._close_block()
        index = b"".join(varint(len(k)) + k + struct.pack("<QQ", at, n) for k, at, n in self.index)
        size = max(64, BITS_PER_KEY * len(self.keys))
        bits = bytearray(-(-size // 8))
        for key in self.keys:
            for p in _probes(key, 8 * len(bits)):
                bits[p >> 3] |= 1 << (p & 7)
        at = len(self.data)
        return bytes(self.data) + index + bytes(bits) + FOOTER.pack(at, len(index), at + len(index), len(bits), len(self.keys), self.ids, MAGIC)


class Table:
    """A file read back, from its bytes or, with open(), by ranges: footer, then index and filter, then the
    data blocks that get() or scan() need. Each block's checksum is verified."""

    def __init__(self, data: bytes | None = None, fetch=None, size: int | None = None):
        self.bytes_read = 0
        if fetch is None:
            data = memoryview(data).cast("B")
            fetch, size = lambda at, n: data[at : at + n], len(data)
        self._fetch = fetch
        index_at, index_n, bloom_at, bloom_n, self.n_docs, self.n_ids, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token table")
        both = self._read(index_at, index_n + bloom_n)  # they stand side by side
        self.bloom, self.last, self.blocks, at = both[index_n:], [], [], 0
        while at < index_n:
            n, at = read_varint(both, at)
            self.last.append(bytes(both[at : at + n]))
            self.blocks.append(struct.unpack("<QQ", both[at + n : at + n + 16]))
            at += n + 16

    @classmethod
    def open(cls, path: str) -> Table:
        """The file at a path of any file system that pyarrow knows; data blocks are read when they are needed."""
        from pyarrow.fs import FileSystem

        fs, p = FileSystem.from_uri(path)
        file = fs.open_input_file(p)
        return cls(fetch=lambda at, n: memoryview(file.read_at(n, at)), size=file.size())

    def _read(self, at: int, n: int):
        self.bytes_read += n
        return self._fetch(at, n)

    def _entries(self, block: int):
        at, n = self.blocks[block]
        whole = self._read(at, n)
        body = whole[: n - 4]
        if zlib.crc32(body) != struct.unpack("<I", whole[n - 4 :])[0]:
            raise ValueError(f"block {block} is damaged")
        body, p, key = memoryview(zstandard.decompress(bytes(body))), 0, b""
        while p < len(body):
            shared, p = read_varint(body, p)
            own, p = read_varint(body, p)
            size, p = read_varint(body, p)
            key = key[:shared] + bytes(body[p : p + own])
            n, p = (size >> 1) * (4 if size & 1 else 2), p + own
            yield key, np.frombuffer(body[p : p + n], "<u4" if size & 1 else "<u2").astype("<u4")
            p += n

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """Ids of every document with this identifier."""
        key = key_of(doc_id)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, 8 * len(self.bloom))):
            return []
        out, block = [], bisect.bisect_left(self.last, key)
        while block < len(self.blocks):
            out += [v for k, v in self._entries(block) if k == key]
            if self.last[block] != key:
                break
            block += 1
        return out

    def scan(self):
        for block in range(len(self.blocks)):
            for key, value in self._entries(block):
                yield id_of(key), value


def _put(folder: str, name: str, data: bytes) -> None:
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(folder)
    with fs.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files and returns their list, stored: file, task, part, n_docs, n_ids, first_id, last_id. Every
    attempt of a task names its files anew, and only those of the list count: what a lost attempt left
    behind is in no result."""
    from pyspark.sql import types as T

    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    in_order = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))

    def run(batches):
        from tesserae.llm.common import _slices
        from tesserae.llm.tokens import encoder

        enc, task, part, writer = encoder(vocabulary), TaskContext.get().partitionId(), 0, Writer(BLOCK_BYTES)
        attempt = uuid.uuid4().hex[:12]

        def close():
            name = f"part-{task:06d}-{part:04d}-{attempt}.sst"
            _put(folder, name, writer.finish())
            ends = [pa.array([id_of(writer.keys[k])], pa.int64()) for k in (0, -1)]
            return pa.record_batch([pa.array([x]) for x in (name, task, part, len(writer.keys), writer.ids)] + ends, ["file", "task", "part", "n_docs", "n_ids", "first_id", "last_id"])

        for batch in batches:
            text = batch.column(1)
            for a, b in _slices(text, 4 << 20):
                flat, offset = enc.encode(text.slice(a, b - a).to_pylist())
                flat, offset = np.insert(flat, offset[1:], np.uint32(end_id)), offset + np.arange(len(offset))
                for doc_id, x, y in zip(batch.column(0).slice(a, b - a).to_pylist(), offset.tolist(), offset.tolist()[1:]):
                    writer.add(key_of(doc_id), flat[x:y])
                    if len(writer.data) >= FILE_BYTES:
                        yield close()
                        part, writer = part + 1, Writer(BLOCK_BYTES)
        if writer.keys:
            yield close()

    schema = T.StructType().add("file", "string").add("task", "long").add("part", "long").add("n_docs", "long").add("n_ids", "long").add("first_id", "long").add("last_id", "long")
    return store(in_order.mapInArrow(run, schema), "sst-list")[0]


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """file, at (place in the file), id, start (ids before it in the file), n_tokens, ids_crc32[, ids]."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.sst").load(folder).select("path", "content")

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                table, start = Table(content.as_buffer()), 0
                ids, sizes, crcs, values = [], [], [], []
                for doc_id, value in table.scan():
                    ids.append(doc_id)
                    sizes.append(len(value))
                    crcs.append(zlib.crc32(value))
                    if with_ids:
                        values.append(value)
                size = np.array(sizes, np.int64)
                cols = [pa.array([path.as_py().rpartition("/")[2]] * len(ids), pa.string()), pa.array(np.arange(len(ids))), pa.array(ids, pa.int64()), pa.array(np.cumsum(size) - size), pa.array(size), pa.array(crcs, pa.int64())]
                names = ["file", "at", "id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    flat = np.concatenate(values) if values else np.empty(0, np.uint32)
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(flat.astype(np.int64))))
                    names.append("ids")
                yield pa.record_batch(cols, names)

    return files.mapInArrow(run, "file string, at long, id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def with_global_start(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """rows of read() with start counted from the first file. The window has a row for each file."""
    upto = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    base = listed.select("file", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)).alias("base"))
    return rows.join(base, "file").withColumn("start", F.col("start") + F.col("base")).drop("base")


def lookup(folder: str, listed: DataFrame, doc_id: int | None) -> tuple[list[np.ndarray], int]:
    """The ids of every document with this identifier, and the bytes read for them. The list names the files
    whose range holds it, in all but odd cases one; of each the footer, index and filter are read, and one block
    (more where a document's copies go over its end)."""
    if doc_id is None:  # nulls sort first
        holds = F.col("first_id").isNull()
    else:
        holds = (F.col("first_id").isNull() | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id)
    out, read_ = [], 0
    for r in listed.where(holds).select("file", "task", "part").orderBy("task", "part").collect():  # the files that hold one identifier
        table = Table.open(f"{folder}/{r['file']}")
        out += table.get(doc_id)
        read_ += table.bytes_read
    return out, read_


def written(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes docs as tables into the shared folder and reads them back: id, start, n_tokens, ids_crc32."""
    folder = scratch(spark, "sst")
    listed = write(docs, folder, vocabulary, end_id, id_col, text_col)
    return with_global_start(read(spark, folder, with_ids=False), listed)

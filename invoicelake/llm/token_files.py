"""Token-id files: a concatenated id array with Elias-Fano encoded document boundaries.

The documents are range-partitioned and sorted by doc_id (a missing one first, ties by a hash of the text); each task
encodes its range and writes it as files of at most about ``SHARD_IDS`` ids into the shared folder, under a temporary
name that is renamed when the file is whole, so a task that is run again leaves the same files. A manifest row per
file carries what the files before it hold.

File (little-endian): magic, id width in bytes (2 where every id fits), number of missing doc_ids (they come first),
smallest doc_id, the Elias-Fano lists of boundaries and of doc_ids less the smallest, and the ids.

Defined results: a missing or empty text holds the end id alone. Repeated doc_ids keep one entry per row. Other
columns are ignored. An empty table writes no file and reads back as no rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from invoicelake.llm.tokens import by_size, encoder
from invoicelake.session import stage, staging_path

END_ID = 2
SHARD_IDS = 4_000_000
MAGIC = b"EFIDS001"
SUFFIX = ".efids"
BLOCK_BITS = 512


class EliasFano:
    """A non-decreasing list of whole numbers from 0 on: low bits packed, high bits in unary with rank samples."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        words = np.frombuffer(high, np.uint8)
        blocks = np.pad(words, (0, -len(words) % (BLOCK_BITS // 8))).reshape(-1, BLOCK_BITS // 8)
        ones = np.bitwise_count(blocks).sum(axis=1, dtype=np.uint32)
        self.blocks, self.before = blocks, np.concatenate([[0], np.cumsum(ones[:-1], dtype=np.uint32)])

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"\0")
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes())

    def select(self, ranks: np.ndarray, step: int = 4096) -> np.ndarray:
        """The values of the given ranks."""
        ranks = np.asarray(ranks, np.int64)
        out = np.empty(len(ranks), np.uint64)
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        for at in range(0, len(ranks), step):
            part = ranks[at:at + step]
            block = np.searchsorted(self.before, part, side="right") - 1
            bits = np.unpackbits(self.blocks[block], axis=1, bitorder="little")
            inside = np.argmax(np.cumsum(bits, axis=1, dtype=np.int16) > (part - self.before[block])[:, None], axis=1)
            value = (block * BLOCK_BITS + inside - part).astype(np.uint64) << np.uint64(self.low_bits)
            if self.low_bits:
                where = part[:, None] * self.low_bits + np.arange(self.low_bits)
                value += (low[where].astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
            out[at:at + step] = value
        return out

    def to_bytes(self) -> bytes:
        return struct.pack("<QBQQ", self.n, self.low_bits, len(self.low), len(self.high)) + self.low + self.high

    @classmethod
    def read(cls, raw: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, low, high = struct.unpack_from("<QBQQ", raw, at)
        at += struct.calcsize("<QBQQ")
        return cls(n, low_bits, bytes(raw[at:at + low]), bytes(raw[at + low:at + low + high])), at + low + high


def to_shard(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One file: doc_ids ascending, missing ones first; ids of each document as 32-bit numbers."""
    missing = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[missing:], np.int64)
    first = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.uint64)
    flat = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(flat) or int(flat.max()) < 65536 else 4
    return b"".join([
        MAGIC, struct.pack("<BQq", width, missing, first), EliasFano.of(ends).to_bytes(),
        EliasFano.of(known.view(np.uint64) - np.int64(first).view(np.uint64)).to_bytes(),
        flat.astype(f"<u{width}").tobytes()])


class Shard:
    """A file that was read: ``doc_ids``, ``ends`` (by select) and the ids of any document."""

    def __init__(self, content: bytes):
        raw = memoryview(content)
        if bytes(raw[:8]) != MAGIC:
            raise ValueError("not a token-id file")
        self.width, missing, first = struct.unpack_from("<BQq", raw, 8)
        self.boundaries, at = EliasFano.read(raw, 8 + struct.calcsize("<BQq"))
        above, at = EliasFano.read(raw, at)
        known = (above.select(np.arange(above.n)) + np.int64(first).view(np.uint64)).view(np.int64)
        self.doc_ids = [None] * missing + known.tolist()
        self.ids = np.frombuffer(raw, f"<u{self.width}", offset=at)
        self.ends = self.boundaries.select(np.arange(self.boundaries.n)).astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i - 1] if i else 0:self.ends[i]]


def _open(folder: str):
    from pyarrow import fs
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, content: bytes) -> None:
    files, path = _open(folder)
    part = f"{path}/_{name}.{os.getpid()}-{TaskContext.get().taskAttemptId()}"
    with files.open_output_stream(part) as out:
        out.write(content)
    if files.get_file_info(f"{path}/{name}").is_file:
        files.delete_file(part)
    else:
        files.move(part, f"{path}/{name}")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, drops_space: bool = False,
                      end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the files into a folder all executors reach; the manifest: task, shard, n_docs, n_ids."""
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, task = encoder(tokenizer, drops_space), TaskContext.get().partitionId()
        doc_ids, ids, size, shard = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            _put(folder, f"{task:07d}-{shard:07d}{SUFFIX}", to_shard(doc_ids, ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64()) for v in (task, shard, len(ids), size)],
                names=["task", "shard", "n_docs", "n_ids"])

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in by_size(texts):
                for key, found in zip(keys[lo:hi], code.encode(texts[lo:hi])):
                    doc_ids.append(key)
                    ids.append(found + end)
                    size += len(found) // 4 + 1
                    if size >= shard_ids:
                        yield flush()
                        doc_ids, ids, size, shard = [], [], 0, shard + 1
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.withColumn("__tie", F.xxhash64("text"))
        .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "__tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "__tie")
        .select("doc_id", "text").mapInArrow(write, "task long, shard long, n_docs long, n_ids long")
    )


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                task, shard = map(int, path.rsplit("/", 1)[1].removesuffix(SUFFIX).split("-"))
                file = Shard(content.as_py())
                n, ends = len(file.doc_ids), file.ends
                starts = np.concatenate([[0], ends[:-1]]) if n else ends
                sums = [zlib.crc32(file.document(i).astype("<u4").tobytes()) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(np.full(n, task)), pa.array(np.full(n, shard)),
                     pa.array(starts), pa.array(ends - starts), pa.array(sums, pa.int64())],
                    names=["doc_id", "task", "shard", "inside", "n_tokens", "ids_crc32"])

    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", f"[!_]*{SUFFIX}").load(folder)
        .select("path", "content")
        .mapInArrow(read, "doc_id long, task long, shard long, inside long, n_tokens long, ids_crc32 long"))
    # one row per task in the second window: as many as the shuffle has partitions
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = manifest.groupBy("task").agg(F.sum("n_ids").alias("n_ids")).select(
        "task", earlier(Window.orderBy("task")).alias("before_task"))
    shards = manifest.select("task", "shard", earlier(
        Window.partitionBy("task").orderBy("shard")).alias("before_shard")).join(tasks, "task")
    return found.join(shards, ["task", "shard"]).select(
        "doc_id", (F.col("before_task") + F.col("before_shard") + F.col("inside")).alias("start"),
        "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, drops_space: bool = False, end_id: int = END_ID) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = staging_path(spark, "token-files")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    manifest = stage(write_token_files(docs, folder, tokenizer, drops_space, end_id), "manifest")
    return read_token_files(spark, folder, manifest)

"""Shards cut from a Hilbert curve over several metadata dimensions, so that files can be left out by any of them.

Every dimension is quantised to 2**BITS cells of about equally many rows, by exact counts over a fixed grid of at most
2**GRID_BITS places: numbers linearly or by their logarithm between the smallest and the largest value, names by the
bytes that follow what all of them begin with. Cells keep the order of values. The cells of a row are a point, its place on the
Hilbert curve is the first sorting key, and runs of the sorted rows are the shards: the law is ``rows``, so counts are
at most one apart. Rows that are equal in all columns are counted before they are shuffled and dealt out by number
afterwards; nothing but the totals of the sorted ranges is added up in one place.

Defined results: a missing text has no bytes and the checksum of an empty one; missing doc_ids, languages and sources
are in the first cell; equal rows are interchangeable; other columns only make rows different. An empty table gives no
rows. The key law's ``grown_shard`` is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from invoicelake.session import stage

SHARDS = 24
BITS = 5
GRID_BITS = 16
COPIES_TOGETHER = 10_000   # copies of a row in one array
DIMENSIONS = ("doc_id", "size", "lang", "source")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The places of points (dimensions x points, below 2**bits) on the Hilbert curve; Skilling's transposed form."""
    x = cells.astype(np.int64)
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:                                   # undo excess work, from the highest bit down
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):                          # Gray code
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def _common_prefix(a: str | None, b: str | None) -> int:
    """Bytes that the smallest and the largest name, and so all names, begin with."""
    a, b = (a or "").encode(), (b or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _places(rows: DataFrame) -> dict[str, Column]:
    """The place of a row on each dimension's grid; a missing value has none. One aggregate gives the borders."""
    row = rows.agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max("size").alias("size"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("lang", "source") for f in (F.min, F.max)]).first()
    last = (1 << GRID_BITS) - 1

    def spread(value: Column, low: float, high: float) -> Column:
        share = (value - F.lit(low)) / F.lit(max(high - low, 1e-300))
        return F.least(F.lit(last), F.floor(share * (last + 1)).cast("int"))

    def named(name: str) -> Column:
        begin = _common_prefix(row[f"min_{name}"], row[f"max_{name}"])
        after = F.substring(F.hex(F.col(name).cast("binary")), 2 * begin + 1, 4)
        return F.conv(F.rpad(after, 4, "0"), 16, 10).cast("int")

    return {
        "doc_id": spread(F.col("doc_id").cast("double"), float(row.low or 0), float(row.high or 0)),
        "size": spread(F.log2(F.col("size").cast("double")), 0.0, float(np.log2(row["size"] or 2))),
        "lang": named("lang"), "source": named("source"),
    }


def _cells(rows: DataFrame, bits: int) -> dict[str, Column]:
    """Cells of about equally many rows, by exact counts of the rows at each place."""
    places = _places(rows)
    hits = F.array(*[F.struct(F.lit(k).alias("dimension"), place.alias("place")) for k, place in places.items()])
    counts = rows.select(F.inline(hits)).groupBy("dimension", "place").agg(F.count("*").alias("n")).collect()
    out = {}
    for name, place in places.items():
        mine = sorted((r.place, r.n) for r in counts if r.dimension == name and r.place is not None)
        at, n = np.array([r[0] for r in mine], np.int64), np.array([r[1] for r in mine], np.int64)
        missing = sum(r.n for r in counts if r.dimension == name and r.place is None)
        cell = (missing + np.cumsum(n) - n) * (1 << bits) // max(missing + n.sum(), 1)
        first = np.searchsorted(cell, np.arange(1, 1 << bits))     # where each further cell begins
        out[name] = sum((F.when(place >= F.lit(int(at[i])), 1).otherwise(0) for i in first if i < len(at)), F.lit(0))
    return out


def _row_key(docs: DataFrame) -> Column:
    """96 bits of all columns; which of them are missing is hashed too, as a hash passes over missing values."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    columns.append(F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns]))
    return F.concat_ws("-", F.xxhash64(*columns), F.hash(*columns))


def curve(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, lang, source, row_key (a hash of all columns) and curve, the place on the Hilbert curve."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        _row_key(docs).alias("row_key"))

    @F.pandas_udf("long")
    def place(*cells: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in cells]), bits))

    cells = _cells(rows, bits)
    return rows.withColumn("curve", place(*[cells[k] for k in DIMENSIONS]))


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and the keys lang, source, row_key and curve."""
    keys = ["curve", "doc_id", "text_crc32", "size", "lang", "source", "row_key"]
    counted = curve(docs, bits).groupBy(*keys).agg(F.count("*").alias("n"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Positions from the start of the range; copies beyond COPIES_TOGETHER go on in further rows."""
        before, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.column("n").to_numpy()
            pieces = -(-n // COPIES_TOGETHER)
            row = np.repeat(np.arange(len(n)), pieces)
            at = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.minimum(COPIES_TOGETHER, n[row] - at * COPIES_TOGETHER)
            start = before + np.cumsum(size) - size
            before += int(n.sum())
            taken = batch.take(pa.array(row)).drop_columns(["n"])
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(size), pa.array(start), pa.array(np.full(len(row), part))],
                names=[*keys, "n", "start", "part"])

    kinds = dict(counted.dtypes)
    ranged = counted.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        number, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", n long, start long, part long")
    ranged = stage(ranged, "curve")
    # one row per sorted range, not per document
    totals = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("start")
    rows = ranged.join(F.broadcast(offsets), "part").withColumn(
        "place", F.explode(F.sequence(place, place + F.col("n") - 1)))
    k = F.expr(f"(place * {shards}L) div {max(total, 1)}L")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return rows.withColumn("shard", k.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "lang", "source", "row_key", "curve")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Writes whole documents, one folder per shard in the order of slots, and returns the manifest.

    Rows that are equal in all columns are joined once each and then repeated."""
    assigned = shard_documents(docs, shards, bits).select(
        "row_key", F.col("size").alias("__size"), F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    single = docs.withColumn("__key", _row_key(docs)).dropDuplicates(["__key"])
    rows = assigned.join(single, F.col("__key") == F.col("row_key")).drop("__key", "row_key")
    rows.repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot").write.partitionBy(
        "__shard").parquet(path)
    return manifest(docs.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per shard: rows, bytes, and the smallest and largest value of every dimension."""
    rows = spark.read.parquet(path)
    values = {"doc_id": F.col("doc_id"), "size": F.col("__size"), "lang": F.col("lang"), "source": F.col("source")}
    return rows.groupBy(F.col("__shard").alias("shard")).agg(
        F.count("*").alias("rows"), F.sum("__size").alias("bytes"),
        *[f(v).alias(f"{f.__name__}_{k}") for k, v in values.items() for f in (F.min, F.max)])


def read_shards(spark: SparkSession, path: str, dimension: str, low=None, high=None) -> DataFrame:
    """The documents whose value is between two borders (None: open); shards without such values are not read."""
    value = {"size": F.col("__size")}.get(dimension, F.col(dimension))
    borders = [(F.col(f"max_{dimension}") >= low, value >= low)] if low is not None else []
    borders += [(F.col(f"min_{dimension}") <= high, value <= high)] if high is not None else []
    kept, rows = manifest(spark, path), spark.read.parquet(path)
    for shard_has, row_has in borders:
        kept, rows = kept.filter(shard_has), rows.filter(row_has)
    return rows.filter(F.col("__shard").isin([r.shard for r in kept.select("shard").collect()]))   # a row per shard

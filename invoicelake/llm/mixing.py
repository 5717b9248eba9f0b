"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words.

The words of a source, its documents in shuffled order, run twice past the mix and are cut into blocks of
``BLOCK_WORDS``. Slot i of the schedule belongs to the source whose share of the cumulative targets holds the i-th
golden-ratio point; its rank among the slots of that source is the block it takes. So every stretch of the schedule
is close to the targets. The last block a source may take is trimmed to its target; the few blocks the points leave out
fill the slots they give to sources without a block left, so a source gives its target to the word. The mix is the
pieces of documents in the order of their slots (``scheduled_mix``); what a document gives is counted from them.

Targets: a source asks for its weight's share of the total and stops at twice its own size; what is over is shared
out again by weight until no source is above. All steps are DataFrame expressions. Running totals over a source go
level by level over the digits of the shuffle key, so no window holds more than 4,096 totals or the distinct sizes of
the doc_ids in one of 16 million buckets.

Defined results: a missing text has 0 words and is never taken. A missing source is a source of its own, last in
order. Missing doc_ids and repeated rows count as documents of their own. Other columns are ignored. An empty table
gives no rows. The shuffle key depends on doc_id alone (equal ids: then on the size), so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from invoicelake.session import stage

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 512
GOLDEN = 2654435769      # 2**32 over the golden ratio
ROW = "__row"            # tells rows apart whose doc_id, source and size are equal
CELLS = 4096             # equal parts of [0, 1) in which slots look up their source


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    spaced = F.regexp_extract_all(text, F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0))
    return F.array_join(F.slice(spaced, F.lit(1), n), "")


def _row(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c == ROW]


def _before(what: str, window) -> Column:
    return F.coalesce(F.sum(what).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def positions(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, and ``at``: the words of its source that come before it in shuffled order.

    A row number of the caller, ``ROW``, is passed on. Rows of equal source, doc_id and size are counted per partition of
    the stored sizes first, so no window holds more rows than a partition, the partitions, or the distinct sizes of a
    doc_id, however many rows share a doc_id or have none."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        words(F.col("text")).alias("size"), *_row(docs)).withColumn("key", key)
    # row numbers of a stored table: partition above, row below, the same on every attempt
    rows = stage(rows, "sizes").withColumn("number", F.monotonically_increasing_id()).withColumns({
        "k1": F.substring("key", 1, 3), "k2": F.substring("key", 4, 3), "task": F.shiftright("number", 33)})
    same, bucket = ["source", "doc_id", "size"], ["source", "k1", "k2"]
    counts = rows.groupBy(*bucket, "key", "doc_id", "size", "task").agg(F.count("*").alias("rows"))
    piles = counts.groupBy(*bucket, "key", "doc_id", "size").agg((F.sum("rows") * F.col("size")).alias("n"))
    two = piles.groupBy(*bucket).agg(F.sum("n").alias("n"))
    one = two.groupBy("source", "k1").agg(F.sum("n").alias("n"))
    one = one.select(F.col("source").alias("s1"), F.col("k1").alias("j1"),
                     _before("n", Window.partitionBy("source").orderBy("k1")).alias("b1"))
    two = two.select(F.col("source").alias("s2"), F.col("k1").alias("i1"), F.col("k2").alias("i2"),
                     _before("n", Window.partitionBy("source", "k1").orderBy("k2")).alias("b2"))
    before = two.join(one, F.col("s1").eqNullSafe(F.col("s2")) & (F.col("i1") == F.col("j1"))).select(
        "s2", "i1", "i2", (F.col("b1") + F.col("b2")).alias("before"))
    inside = Window.partitionBy(*bucket).orderBy("key", "doc_id", "size")
    piles = piles.withColumn("inside", _before("n", inside)).join(
        before, F.col("source").eqNullSafe(F.col("s2")) & (F.col("k1") == F.col("i1")) & (F.col("k2") == F.col("i2"))
    ).selectExpr("source", "doc_id", "size", "before + inside AS start")
    earlier = _before("rows", Window.partitionBy(*same).orderBy("task"))
    counts = counts.select(*same, "task", earlier.alias("earlier")).alias("c").join(
        piles.alias("p"), F.expr("c.source <=> p.source AND c.doc_id <=> p.doc_id AND c.size = p.size")).selectExpr(
        "c.source", "c.doc_id", "c.size", "c.task", "p.start + c.earlier * c.size AS start")
    place = F.row_number().over(Window.partitionBy(*same, "task").orderBy("number")) - 1
    own = [f"r.{c}" for c in _row(docs)]
    return rows.withColumn("place", place).alias("r").join(counts.alias("c"), F.expr(
        "r.source <=> c.source AND r.doc_id <=> c.doc_id AND r.size = c.size AND r.task = c.task")).selectExpr(
        "r.doc_id", "r.source", "r.size", *own, "c.start + r.place * r.size AS at")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """source, source_size, target, quota (whole words). One row per source goes in: a catalogue, not a corpus."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(order) - 1) % len(weights)
    rows = sizes.withColumn("weight", F.get(kinds, place.cast("int")))
    # the source with the smallest limit for its weight stops first; ``level`` is then the words per weight
    # if it and all after it share what those before leave
    limit = F.lit(float(REPEATS)) * F.col("source_size")
    rows = rows.withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    rows = rows.withColumns({
        "total": F.sum("source_size").over(every) * F.lit(share),
        "left": F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        "used": F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
    }).withColumn("level", (F.col("total") - F.col("used")) / F.col("left"))
    # the first source in that order that does not stop sets the level; later ones give lower levels
    level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(every)
    rows = rows.withColumn("target", F.least("limit", F.coalesce(level, F.lit(float("inf"))) * F.col("weight")))
    return rows.select("source", "source_size", "target",
                       F.least(F.round("target"), F.col("limit")).cast("long").alias("quota"))


def schedule(quotas: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, source, block, words: the order of the mix. Slots are numbered without a gap from 0, and each block a source
    may take stands in exactly one.

    The points may give a source a few slots more than it has blocks, and another as many fewer: the blocks left out
    take the slots left over, in the order of both."""
    spark = quotas.sparkSession
    blocks = quotas.filter(F.col("quota") > 0).withColumn(
        "blocks", F.ceil(F.col("quota") / F.lit(block_words)).cast("long"))
    stored = stage(blocks, "quotas")
    slots = stored.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    line, every = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy(F.lit(0))
    total = F.sum("quota").over(every)
    shares = stored.select(
        "source", "quota", "blocks", (_before("quota", line) / total).alias("low"),
        (F.sum("quota").over(line.rowsBetween(Window.unboundedPreceding, 0)) / total).alias("high"))
    cells = shares.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))))
    # golden-ratio points modulo 2**32 in two halves, so that no product leaves a long
    i = F.col("id") % F.lit(2 ** 32)
    high, low = F.floor(i / F.lit(65536)).cast("long"), i % F.lit(65536)
    point = ((high * F.lit(GOLDEN % 65536)) % 65536 * 65536 + low * F.lit(GOLDEN)) % F.lit(2 ** 32)
    points = spark.range(slots).select(F.col("id").alias("slot"), (point / F.lit(2.0 ** 32)).alias("u")).withColumn(
        "cell", F.floor(F.col("u") * CELLS))
    owned = points.join(cells, "cell").filter((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    # ranks within a source by stretches of the schedule
    owned = owned.select("slot", "source").withColumn("stretch", F.floor(F.col("slot") / 4096))
    counted = owned.groupBy("source", "stretch").agg(F.count("*").alias("n"))
    outer = counted.select("source", F.floor(F.col("stretch") / 4096).alias("era"), "n").groupBy("source", "era").agg(
        F.sum("n").alias("n")).withColumn("era_before", _before("n", Window.partitionBy("source").orderBy("era")))
    counted = counted.withColumn("era", F.floor(F.col("stretch") / 4096)).withColumn(
        "before", _before("n", Window.partitionBy("source", "era").orderBy("stretch")))
    counted = counted.alias("c").join(outer.alias("o"), F.expr("c.source <=> o.source AND c.era = o.era")).selectExpr(
        "c.source AS source", "c.stretch AS stretch", "c.before + o.era_before AS before")
    inside = F.row_number().over(Window.partitionBy("source", "stretch").orderBy("slot")) - 1
    ranked = owned.withColumn("inside", inside).alias("s").join(
        counted.alias("c"), F.expr("s.source <=> c.source AND s.stretch = c.stretch")).selectExpr(
        "s.slot AS slot", "s.source AS source", "c.before + s.inside AS block")
    quota = stored.select("source", "quota", "blocks")
    ranked = stage(ranked, "ranks").alias("r").join(quota.alias("q"), F.expr("r.source <=> q.source")).selectExpr(
        "r.slot AS slot", "r.source AS source", "r.block AS block", "q.quota AS quota", "q.blocks AS blocks")
    taken = ranked.groupBy("source").agg(F.count("*").alias("n"))
    short = quota.alias("q").join(taken.alias("t"), F.expr("q.source <=> t.source"), "left").selectExpr(
        "q.source AS source", "q.quota AS quota", "coalesce(t.n, 0L) AS n", "q.blocks AS blocks").filter("n < blocks")
    # as many as the points stray from the shares: about the logarithm of the slots, per source
    out = short.select("source", F.explode(F.sequence(F.col("n"), F.col("blocks") - 1)).alias("block"), "quota").withColumn(
        "k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last(), "block")))
    over = ranked.filter("block >= blocks").select("slot", F.row_number().over(Window.orderBy("slot")).alias("k"))
    rest = over.join(out, "k").select("slot", "source", "block", "quota")
    return ranked.filter("block < blocks").select("slot", "source", "block", "quota").unionByName(rest).select(
        "slot", "source", "block",
        F.least(F.lit(block_words), F.col("quota") - F.col("block") * block_words).cast("long").alias("words"))


def scheduled_pieces(placed: DataFrame, quotas: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as pieces of documents: slot, place (words before it in the slot), run (0 for the first pass over its
    source), from_word and to_word (end exclusive), with the columns of ``placed``. Slots and places give the order."""
    slots = schedule(quotas.select("source", "quota"), block_words)
    sizes = quotas.select(F.col("source").alias("__s"), "source_size")      # one row per source: Spark broadcasts it
    own = [c for c in placed.columns]
    # a document meets the mix once in each run over its source
    runs = F.array(*[F.col("at") + F.lit(r) * F.col("source_size") for r in range(REPEATS)])
    begun = placed.filter("size > 0").join(sizes, F.col("source").eqNullSafe(F.col("__s"))).select(
        *own, F.posexplode(runs).alias("run", "begin"))
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    parts = begun.withColumn("__block", F.explode(F.sequence(F.floor(F.col("begin") / block_words), last)))
    slots = slots.select("slot", F.col("source").alias("__s"), F.col("block").alias("__b"), "words")
    joined = parts.join(slots, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")))
    low = F.greatest(F.col("begin"), F.col("__block") * block_words)
    high = F.least(F.col("begin") + F.col("size"), F.col("__block") * block_words + F.col("words"))
    return joined.select(
        "slot", (low - F.col("__block") * block_words).alias("place"), "run", *own,
        (low - F.col("begin")).alias("from_word"), (high - F.col("begin")).alias("to_word")).filter("to_word > from_word")


def _planned(docs: DataFrame, weights: tuple[int, ...], share: float) -> tuple[DataFrame, DataFrame]:
    placed = stage(positions(docs), "positions")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    return placed, stage(targets(sizes, weights, share), "targets")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words of its pieces in the schedule, repeats
    counted) and first_slot (where its first piece stands; missing if none does)."""
    placed, quotas = _planned(docs.drop(ROW).withColumn(ROW, F.monotonically_increasing_id()), weights, share)
    pieces = scheduled_pieces(placed, quotas, block_words)
    # at is unique among the documents of a source that have words
    taken = pieces.groupBy("source", "at").agg(
        F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("slot").alias("first_slot"))
    rows = placed.alias("p").join(quotas.alias("q"), F.expr("p.source <=> q.source")).selectExpr(
        "p.doc_id", "p.source", "p.size", "p.at", "q.source_size", "q.target").alias("d")
    return rows.join(taken.alias("t"), F.expr("d.source <=> t.source AND d.at = t.at AND d.size > 0"), "left").selectExpr(
        "d.doc_id", "d.source", "d.size", "d.source_size", "d.target", "coalesce(t.taken, 0L) AS taken", "t.first_slot")


def scheduled_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself, in order: slot, place, source, doc_id, from_word, to_word and the text of these words, each with
    the blanks before it; the last word of a document brings the blanks after it.

    The words of a document are taken apart once, and its pieces cut from them."""
    rows = stage(docs.drop(ROW).withColumn(ROW, F.monotonically_increasing_id()), "mix-rows")
    placed, quotas = _planned(rows, weights, share)
    cuts = scheduled_pieces(placed, quotas, block_words).groupBy(ROW).agg(F.collect_list(F.struct(
        "slot", "place", "from_word", "to_word")).alias("cuts"))       # two per 512 words of one document at most
    spaced = F.regexp_extract_all("text", F.lit(f"[\\x20\\x09-\\x0D]*{WORD}(?:[\\x20\\x09-\\x0D]+$)?"), F.lit(0))
    split = rows.join(cuts, ROW).select("doc_id", F.col("source").cast("string").alias("source"), "cuts", spaced.alias("spaced"))
    # the number of words is read beside the cuts, so that the words are not taken apart again for each cut
    cut = split.select("doc_id", "source", F.size("spaced").alias("n"), F.transform("cuts", lambda c: F.struct(
        c["slot"].alias("slot"), c["place"].alias("place"), c["from_word"].alias("from_word"),
        c["to_word"].alias("to_word"), F.array_join(F.slice(
            "spaced", (c["from_word"] + 1).cast("int"), (c["to_word"] - c["from_word"]).cast("int")), "").alias("text"))
    ).alias("cuts")).filter("n > 0")
    return cut.select("doc_id", "source", F.explode("cuts").alias("c")).select(
        "c.slot", "c.place", "source", "doc_id", "c.from_word", "c.to_word", "c.text").orderBy("slot", "place")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The words the mix takes, as documents in the order of the schedule: each 0 to 2 times, at the slot of its first
    word, and cut after its last word taken where a source ends.

    ``n_chars`` is that of the cut text. Rows are told apart by a number of their own."""
    rows = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "mix-rows")
    placed, quotas = _planned(rows, weights, share)
    copies = scheduled_pieces(placed, quotas).groupBy(ROW, "run", "size").agg(
        F.max("to_word").alias("__end"), F.min_by(F.struct("slot", "place"), "from_word").alias("__at"))
    copies = copies.select(ROW, "__at", "__end", (F.col("__end") < F.col("size")).alias("__cut"))
    taken = rows.join(copies, ROW)
    cut = F.col("__cut")
    taken = taken.withColumn(
        "text", F.when(cut, first_words(F.col("text"), F.col("__end").cast("int"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        taken = taken.withColumn("n_chars", F.when(cut, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return taken.orderBy("__at.slot", "__at.place").select(*docs.columns)

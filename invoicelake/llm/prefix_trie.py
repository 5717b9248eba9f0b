"""The trie of conversation prefixes: members, children, leaves and saved tokens of every node.

A turn is two hashes, a prefix the polynomial of its turns (modulo 2**61 - 1, twice), so prefixes of a conversation
that fills many blocks are continued from the sums of the blocks before. Nodes are counted by prefix, combined before
the shuffle. Nodes in a row with the same members form one chain; it is known by its smallest member and its number of
members, so the trie of chains is found by grouping. A conversation is the list of its chains (its length is at most the
square root of twice the rows: each further chain needs another conversation as long as the chain is deep).

These lists are sorted over the cluster and cut into shards of neighbours. Each shard writes its part of the trie of
chains as balanced parentheses: closing places delimit subtrees, ranks of () count leaves, and cumulative arrays
give savings. Only chains on the first or last list of a shard can go on in another shard. These spines (at most twice the
depth in chains per shard) carry what hangs below them besides spines, are added up over the shards, and are solved as one
more tree of the same kind. Members that end at a node lie together in the sorted order, in ascending order.

Defined results: missing roles and texts are empty; turns are ordered by turn (missing first), then role, then text;
repeated rows are turns of their own. Rows without a conv_id belong to no conversation. ``c - c % 20`` is never above c.
Other columns are ignored; an empty table gives no rows, as then there is no root either.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from invoicelake.llm.parentheses import Parentheses
from invoicelake.llm.turns import blocks, in_order
from invoicelake.session import stage

MODULUS = (1 << 61) - 1
BASES = (1_234_567_890_123_456_789, 987_654_321_987_654_321)
HEAD = 3                # turns that another conversation can lend
REPEATS = 1024          # repeats of a turn in one block
IDS_TOGETHER = 10_000
SENT_TOGETHER = 256

_WORD = re.compile(r"[^\x20\x09-\x0D]+")

TURN = "struct<a:bigint,b:bigint,words:bigint,times:bigint>"
BLOCK = f"conv_id long, number long, sub long, n long, a long, b long, words long, turns array<{TURN}>"
OFFSET = f"conv_id long, number long, sub long, n long, a long, b long, words long, head array<{TURN}>"
STEP = "conv_id long, depth long, a long, b long, words long, upto long, ends boolean"


def _schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _sent(rows: Iterator[dict], schema: pa.Schema, together: int = SENT_TOGETHER) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, together)):
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, SENT_TOGETHER):
            yield from batch.slice(at, SENT_TOGETHER).to_pylist()


class _Prefix:
    """Length, hashes and words of a prefix."""

    def __init__(self, n: int = 0, a: int = 0, b: int = 0, words: int = 0):
        self.n, self.a, self.b, self.words = n, a, b, words

    def add(self, turn: dict) -> None:
        self.n, self.words = self.n + 1, self.words + turn["words"]
        self.a, self.b = (self.a * BASES[0] + turn["a"]) % MODULUS, (self.b * BASES[1] + turn["b"]) % MODULUS

    def join(self, other: _Prefix) -> _Prefix:
        """This prefix and then the turns of the other."""
        return _Prefix(
            self.n + other.n, (self.a * pow(BASES[0], other.n, MODULUS) + other.a) % MODULUS,
            (self.b * pow(BASES[1], other.n, MODULUS) + other.b) % MODULUS, self.words + other.words)

    def without(self, first: _Prefix) -> _Prefix:
        """What follows ``first`` in this prefix."""
        n = self.n - first.n
        return _Prefix(n, (self.a - first.a * pow(BASES[0], n, MODULUS)) % MODULUS,
                       (self.b - first.b * pow(BASES[1], n, MODULUS)) % MODULUS, self.words - first.words)

    @classmethod
    def of(cls, turns: list[dict]) -> _Prefix:
        out = cls()
        for turn in turns:
            for _ in range(turn["times"]):
                out.add(turn)
        return out


def _turn(role: str, text: str, times: int) -> dict:
    key = f"{len(role)}:{role}{text}".encode()
    return {"a": 1 + xxhash.xxh3_64_intdigest(key, 1) % (MODULUS - 1), "b": 1 + xxhash.xxh3_64_intdigest(key, 2) % (MODULUS - 1),
            "words": len(_WORD.findall(text)), "times": times}


def _first(turns: list[dict], n: int) -> list[dict]:
    """The first n turns one by one."""
    out = []
    for turn in turns:
        out += [{**turn, "times": 1}] * min(turn["times"], n - len(out))
    return out


def turn_blocks(conversations: DataFrame) -> DataFrame:
    """Hashed turns in order, in blocks with the hashes and words of their own turns."""
    schema = _schema(BLOCK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(conv: int, number: int, sub: int, turns: list[dict]) -> dict:
            p = _Prefix.of(turns)
            return {"conv_id": conv, "number": number, "sub": sub, "n": p.n, "a": p.a, "b": p.b, "words": p.words, "turns": turns}

        def rows() -> Iterator[dict]:
            for conv, number, _, found in blocks(batches):
                sub, turns, size = 0, [], 0
                for _, role, text, copies in found:
                    while copies:
                        times = min(copies, REPEATS)
                        turns.append(_turn(role, text, times))
                        copies, size = copies - times, size + times
                        if size >= REPEATS:
                            yield row(conv, number, sub, turns)
                            sub, turns, size = sub + 1, [], 0
                if turns:
                    yield row(conv, number, sub, turns)

        return _sent(rows(), schema)

    known = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
        F.lit(1).alias("copies")).filter("conv_id IS NOT NULL")
    return in_order(known).mapInArrow(cut, BLOCK)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation: conv_id, depth, the hashes a and b, words of the last turn and of all,
    and whether the conversation ends here. The first h turns come from conversation c - c % 20. The root is depth 0."""
    offset, step = _schema(OFFSET), _schema(STEP)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What comes before each block, and per conversation one row without a number: its length and first turns."""
        def rows() -> Iterator[dict]:
            for conv, group in groupby(_read(batches), key=lambda row: row["conv_id"]):
                before, head = _Prefix(), []
                for row in group:
                    yield {"conv_id": conv, "number": row["number"], "sub": row["sub"], **vars(before), "head": None}
                    head += _first(row["head"], HEAD - len(head))
                    before = before.join(_Prefix(row["n"], row["a"], row["b"], row["words"]))
                yield {"conv_id": conv, "number": None, "sub": None, **vars(before), "head": head}

        return _sent(rows(), offset)

    def borrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The root and the lent turns, one row per prefix and conversation."""
        def rows() -> Iterator[dict]:
            for row in _read(batches):
                lent, path = (row["lent"] or [])[:row["h"]], _Prefix()
                length = len(lent) + max(0, row["n"] - row["h"])
                for turn in [None, *lent]:
                    if turn:
                        path.add(turn)
                    yield {"conv_id": row["conv_id"], "depth": path.n, "a": path.a, "b": path.b,
                           "words": turn["words"] if turn else 0, "upto": path.words, "ends": path.n == length}

        return _sent(rows(), step, 4096)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The conversation's own turns after the first h."""
        def rows() -> Iterator[dict]:
            for row in _read(batches):
                h, own = row["h"], _first(row["head"], row["h"])
                lent, skipped = _Prefix.of((row["lent"] or [])[:h]), _Prefix.of(own)
                length = lent.n + max(0, row["total"] - h)
                before = _Prefix(row["before_n"], row["before_a"], row["before_b"], row["before_words"])
                path = lent.join(before.without(skipped)) if before.n >= h else None
                at = before.n
                for turn in row["turns"]:
                    for _ in range(turn["times"]):
                        at += 1
                        if at <= h:
                            continue
                        path = path or _Prefix(*vars(lent).values())
                        path.add(turn)
                        yield {"conv_id": row["conv_id"], "depth": path.n, "a": path.a, "b": path.b,
                               "words": turn["words"], "upto": path.words, "ends": path.n == length}

        return _sent(rows(), step, 4096)

    cut = stage(turn_blocks(conversations), "turn-blocks")
    slim = cut.select("conv_id", "number", "sub", "n", "a", "b", "words", F.slice("turns", 1, HEAD).alias("head"))
    added = stage(slim.repartition("conv_id").sortWithinPartitions("conv_id", "number", "sub").mapInArrow(add_up, OFFSET), "offsets")
    heads = added.filter("number IS NULL").select("conv_id", "n", "head")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    lender = heads.select(F.col("conv_id").alias("lender"), F.col("head").alias("lent"))
    plans = heads.withColumns({"h": h, "lender": F.col("conv_id") - F.pmod("conv_id", F.lit(20))}).join(
        lender, "lender", "left").select("conv_id", "n", "head", "h", "lent")
    plans = stage(plans, "plans")
    own = cut.select("conv_id", "number", "sub", "turns").join(
        added.filter("number IS NOT NULL").select(
            "number", "sub", *[F.col(c).alias(f"before_{c}") for c in ("n", "a", "b", "words")]), ["number", "sub"])
    own = own.join(plans.withColumnRenamed("n", "total"), "conv_id")
    return plans.mapInArrow(borrow, STEP).union(own.mapInArrow(go_on, STEP))


def _solve_shard(paths: Iterator[tuple[list[dict], list[int]]], number: int) -> Iterator[dict]:
    """Rows of kind ends, node (final) and spine (to be added up) of one shard; equal paths come together.

    A path has the chains c, m with their gain; the root is above all of them."""
    bits, nodes, above, stack = [1], [(None, None, 0)], [None], [0]
    first = last = None
    path = []
    for chains, ids in paths:
        keys = [(x["c"], x["m"]) for x in chains]
        same = next((i for i, (x, y) in enumerate(zip(keys, path)) if x != y), min(len(keys), len(path)))
        bits += [0] * (len(stack) - 1 - same)
        del stack[same + 1:]
        for x in chains[same:]:
            bits.append(1)
            above.append(stack[-1])
            stack.append(len(nodes))
            nodes.append((x["c"], x["m"], x["gain"]))
        path, last = keys, list(stack)
        first = first or last
        c, m, _ = nodes[stack[-1]]
        for piece, some in enumerate(iter(lambda ids=iter(ids): list(islice(ids, IDS_TOGETHER)), [])):
            yield {"kind": "ends", "c": c, "m": m, "shard": number, "piece": piece, "ids": ",".join(map(str, some))}
    if first is None:
        return
    bits += [0] * len(stack)
    tree = Parentheses(np.array(bits, bool))
    closes = tree.subtrees()
    leaves, saved = tree.leaf_counts(closes), tree.sums(closes, np.array([n[2] for n in nodes], np.int64))
    spine = {*first, *last}
    for i, (c, m, gain) in enumerate(nodes):
        children = tree.children(closes, i)
        out = {"c": c, "m": m, "up_c": nodes[above[i]][0] if i else None, "up_m": nodes[above[i]][1] if i else None}
        if i in spine:
            own = [k for k in children if k not in spine]
            yield out | {"kind": "spine", "root": i == 0, "gain": gain, "children": len(own),
                         "leaves": int(leaves[own].sum()), "saved": int(saved[own].sum())}
        else:
            yield out | {"kind": "node", "children": len(children), "leaves": int(leaves[i]), "saved": int(saved[i])}


def _solve_spine(rows: list[dict]) -> Iterator[dict]:
    """The spines of all shards as one tree; each node counts once what hangs below it in any shard."""
    below, top = {}, None
    for i, row in enumerate(rows):
        if row["root"]:
            top = i
        else:
            below.setdefault((row["up_c"], row["up_m"]), []).append(i)
    order, bits, todo = [], [], [top]
    while todo:
        i = todo.pop()
        bits.append(i is not None)
        if i is not None:
            order.append(i)
            todo.append(None)
            todo += below.get((rows[i]["c"], rows[i]["m"]), ())
    tree = Parentheses(np.array(bits, bool))
    closes = tree.subtrees()
    children = [len(tree.children(closes, k)) + rows[i]["children"] for k, i in enumerate(order)]
    leaves = tree.sums(closes, np.array([rows[i]["leaves"] + (not n) for i, n in zip(order, children)], np.int64))
    saved = tree.sums(closes, np.array([rows[i]["gain"] + rows[i]["saved"] for i in order], np.int64))
    for k, i in enumerate(order):
        yield {"c": rows[i]["c"], "m": rows[i]["m"], "up_c": rows[i]["up_c"], "children": children[k],
               "leaves": int(leaves[k]), "saved": int(saved[k])}


def prefix_trie(steps: DataFrame) -> DataFrame:
    """One row per node, from the prefixes of conversations (``rebuilt``)."""
    steps = stage(steps, "steps")
    nodes = stage(steps.groupBy("a", "b", "depth").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        F.max("upto").alias("upto")), "nodes")
    inner = nodes.filter("depth > 0")
    chains = stage(inner.groupBy("conv_id", "n_convs").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.min(F.col("upto") - F.col("words")).alias("before"),
        F.max("upto").alias("upto"), F.min_by(F.struct("a", "b"), "depth").alias("at")), "chains")
    gain = (F.col("n_convs") - 1) * (F.col("upto") - F.col("before"))
    tops = chains.select(F.col("at.a"), F.col("at.b"), F.struct(
        F.col("top").alias("depth"), F.col("conv_id").alias("c"), F.col("n_convs").alias("m"), gain.alias("gain")).alias("chain"))
    # chains along each conversation; one that ends at the root has none
    along = steps.filter("depth > 0").select("conv_id", "a", "b").join(tops, ["a", "b"]).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("chain")).alias("chains"))
    turnless = steps.filter("depth = 0 AND ends").select("conv_id", F.array().cast(along.schema["chains"].dataType).alias("chains"))
    lists = along.union(turnless).withColumn("chains", F.transform("chains", lambda x: x.dropFields("depth")))

    solved_type = ("kind string, c long, m long, up_c long, up_m long, root boolean, gain long, children long, leaves long, "
                   "saved long, shard long, piece long, ids string")
    node_type = "c long, m long, up_c long, children long, leaves long, saved long"
    digest_type = "c long, m long, ends string"
    solved_schema, node_schema, digest_schema = _schema(solved_type), _schema(node_type), _schema(digest_type)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = ((chains, (row["conv_id"] for row in group)) for chains, group in groupby(
            _read(batches), key=lambda row: row["chains"]))
        return _sent(_solve_shard(paths, TaskContext.get().partitionId()), solved_schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(_read(batches))
        return _sent(_solve_spine(rows) if rows else iter(()), node_schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for (c, m), group in groupby(_read(batches), key=lambda row: (row["c"], row["m"])):
                found = hashlib.sha256()
                for i, row in enumerate(group):
                    found.update(("," if i else "").encode() + row["ids"].encode())
                yield {"c": c, "m": m, "ends": found.hexdigest()}

        return _sent(rows(), digest_schema)

    solved = stage(lists.repartitionByRange("chains", "conv_id").sortWithinPartitions("chains", "conv_id").mapInArrow(
        solve, solved_type), "solved")
    # a few rows per shard: what its first and its last list share with others
    spine = solved.filter("kind = 'spine'").groupBy("root", "c", "m", "up_c", "up_m").agg(
        F.max("gain").alias("gain"), *[F.sum(k).alias(k) for k in ("children", "leaves", "saved")])
    merged = spine.coalesce(1).mapInArrow(merge, node_type)
    ends = solved.filter("kind = 'ends'").select("c", "m", "shard", "piece", "ids").repartition("c", "m").sortWithinPartitions(
        "c", "m", "shard", "piece").mapInArrow(digest, digest_type)
    values = stage(solved.filter("kind = 'node'").select("c", "m", "up_c", "children", "leaves", "saved").union(merged).join(
        ends.withColumnsRenamed({"c": "ec", "m": "em"}), F.col("c").eqNullSafe(F.col("ec")) & F.col("m").eqNullSafe(F.col("em")),
        "left").drop("ec", "em"), "values")

    none = F.lit(hashlib.sha256().hexdigest())
    root = nodes.filter("depth = 0")
    smallest = F.lit(root.agg(F.min("conv_id")).first()[0]).cast("long")
    shared = chains.join(
        values.filter("c IS NOT NULL").withColumnsRenamed({"c": "conv_id", "m": "n_convs"}), ["conv_id", "n_convs"]).select(
        "conv_id", "n_convs", "top", "bottom", "before", "up_c", "children", "leaves", "saved", "ends")
    at_top, at_bottom = F.col("depth") == F.col("top"), F.col("depth") == F.col("bottom")
    above_here = (F.col("n_convs") - 1) * (F.col("upto") - F.col("words") - F.col("before"))
    below = inner.join(shared, ["conv_id", "n_convs"]).select(
        "conv_id", "depth", F.when(at_top, F.coalesce("up_c", smallest)).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(at_bottom, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") - above_here).alias("saved_tokens"),
        F.when(at_bottom, F.coalesce("ends", none)).otherwise(none).alias("ends_sha256"))
    found = values.filter("c IS NULL").first()      # of the root: one row, or none if there are no conversations
    at_root = [F.lit(found[k] if found else None).cast("long") for k in ("children", "leaves", "saved")]
    return root.select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        *[c.alias(name) for c, name in zip(at_root, ("n_children", "n_leaves", "saved_tokens"))],
        F.lit(found and found.ends or hashlib.sha256().hexdigest()).alias("ends_sha256")).union(below)

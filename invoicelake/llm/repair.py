"""Repair of the structure of conversations: the cheapest edits that make roles read system? (user assistant)*.

Every row is kept (0), given the role user or assistant (3) or deleted (4), and empty turns can be inserted (3). Blank
rows (no character that is not white space) and duplicates (role and text seen earlier in the conversation) must be
deleted; a row whose last visible character ends no sentence is truncated and costs 3 more unless it is deleted. The
edits are paths through a lattice of (rows consumed, role last written). A forward search from the start and a reverse
search from the goals (Dijkstra's, each with its heap) meet; both go on until no path as cheap as the best can be
missing, and of all edges where they cross at least cost the least concatenated audit is taken. Labels carry the least audit
of their node: heaps are ordered by cost and then by row, so all that lead to a node at equal cost come before it.

A conversation is searched in blocks of bounded size. Where it has several, each block is searched from every state to
every state, the costs and the order of the audits (a few numbers per block) are chained, and each block then takes the
path between its two states. Audits of one block never begin with one another, so the chain compares whole audits.
What one task reads of a conversation in the end is its pieces in order, for the digest, which has no other way.

Defined results: missing roles and texts are one space. Rows are ordered by turn (missing first), then role, then text;
equal rows stay adjacent. A missing conv_id is a conversation. Initials are case-sensitive; a role that begins with none
of s, u, a is illegal. A conversation without rows after the damage has zeros, an empty audit and the digest of nothing.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from invoicelake.llm.turns import blocks, in_order
from invoicelake.session import stage

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)                       # the role that is written after each state
ROLES = {USER: "user", ASSISTANT: "assistant"}
# what the end of a conversation costs in every state, and the insertions that reach a whole pair
ENDINGS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}

SENT_TOGETHER = 64    # blocks

_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
_LEGAL = {"su", "ua", "au"}

ITEM = "struct<role:string,text:string,forced:boolean,truncated:boolean,times:bigint>"
COUNTS = "blank long, duplicate long, truncated long, illegal long"
SPAN = "low long, high long, turns long, first_role string, last_role string"


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after the damage that the checksum of ``conv_id:turn`` chooses.

    Dropped rows stay with no copies, so that every conversation is still there."""
    def known(c: str) -> F.Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(code == 0, "").when(code == 4, "user").otherwise(known("role")).alias("role"),
        F.when(code.isin(0, 1), "").when(code == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(
            known("text")).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def _identity(role: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())


def _items(rows: list[tuple], seen: set[bytes]) -> tuple[list[tuple], list[int]]:
    """Rows as (role, text, must be deleted, truncated, times), and the counts of faults and illegal neighbours."""
    items, blank, duplicate, truncated, illegal, last = [], 0, 0, 0, 0, None
    seen = set(seen)
    for _, role, text, copies in rows:
        if not copies:
            continue
        visible = _VISIBLE.search(text)
        known = _identity(role, text)
        if not visible or known in seen:
            items.append((role, text, True, False, copies))
            blank, duplicate = (blank, duplicate + copies) if visible else (blank + copies, duplicate)
        else:
            cut = text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?"
            truncated, duplicate = truncated + cut, duplicate + copies - 1
            items.append((role, text, False, cut, 1))
            if copies > 1:
                items.append((role, text, True, False, copies - 1))
        seen.add(known)
        illegal += copies - 1 + (last is not None and last + role[:1] not in _LEGAL)
        last = role[:1]
    return items, [blank, duplicate, truncated, illegal]


def _lattice(items: list[tuple], insert_at_end: bool) -> tuple[list[list], list[list]]:
    """Edges (cost, edit, other node) out of and into every node 4 * rows consumed + state."""
    n = len(items)
    out, into = [[] for _ in range(4 * n + 4)], [[] for _ in range(4 * n + 4)]

    def edge(a: int, cost: int, edit: str, b: int) -> None:
        out[a].append((cost, edit, b))
        into[b].append((cost, edit, a))

    for i in range(n + 1):
        for state in range(4):
            node, turned = 4 * i + state, NEXT[state]
            if i < n or insert_at_end:
                edge(node, INSERT, "I", 4 * i + turned)
            if i == n:
                continue
            role, _, forced, cut, times = items[i]
            edge(node, DELETE * times, "D", node + 4)
            if forced:
                continue
            extra = TRUNCATED if cut else 0
            if role[:1] == "s" and state == START:
                edge(node, extra, "K", 4 * i + 4 + SYSTEM)
            elif role[:1] == ROLES[turned][0]:
                edge(node, extra, "K", 4 * i + 4 + turned)
            edge(node, REROLE + extra, "R", 4 * i + 4 + turned)
    return out, into


def cheapest(out: list[list], into: list[list], source: int, goals: list[int]) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest paths from the source to a goal; None if there is none."""
    ahead, back, ends = {}, {}, set(goals)                    # settled: node -> (cost, audit up to it or from it on)
    forward, reverse = [(0, source >> 2, "", source)], [(0, -(g >> 2), "", g) for g in goals]
    heapq.heapify(reverse)
    best = None
    while forward and reverse and (best is None or forward[0][0] + reverse[0][0] <= best):
        if forward[0][0] <= reverse[0][0]:
            heap, settled, others, edges, sign = forward, ahead, back, out, 1
        else:
            heap, settled, others, edges, sign = reverse, back, ahead, into, -1
        cost, _, audit, node = heapq.heappop(heap)
        if node in settled:
            continue
        settled[node] = cost, audit
        rest = 0 if heap is forward and node in ends else others[node][0] if node in others else None
        if rest is not None and (best is None or cost + rest < best):
            best = cost + rest
        for step, edit, other in edges[node]:
            if other in others and (best is None or cost + step + others[other][0] < best):
                best = cost + step + others[other][0]
            if other not in settled:
                heapq.heappush(heap, (
                    cost + step, sign * (other >> 2), audit + edit if sign > 0 else edit + audit, other))
    if best is None:
        return None
    # a goal needs no reverse search; one of the heaps may be empty by then
    crossings = [ahead[goal][1] for goal in goals if goal in ahead and ahead[goal][0] == best]
    crossings += [audit + back[node][1] for node, (cost, audit) in ahead.items()
                 if node in back and cost + back[node][0] == best]
    crossings += [audit + edit + back[other][1] for node, (cost, audit) in ahead.items()
                  for step, edit, other in out[node] if other in back and cost + step + back[other][0] == best]
    return best, min(crossings)


def _solved(items: list[tuple], whole: bool) -> tuple[int | None, str | None, list[dict] | None]:
    """Cost and audit of a whole conversation, or the paths between all states of a block."""
    n = len(items)
    out, into = _lattice(items, whole)
    if whole:
        return *cheapest(out, into, START, [4 * n + START, 4 * n + ASSISTANT]), None
    paths = []
    for entry in range(4):
        found = {leave: cheapest(out, into, entry, [4 * n + leave]) for leave in range(4)}
        order = sorted(path[1] for path in found.values() if path)
        paths += [{"entry": entry, "leave": leave, "cost": path[0], "place": order.index(path[1]), "audit": path[1]}
                  for leave, path in found.items() if path]
    return None, None, paths


def _chain(group: list[tuple[int, list[dict]]]) -> list[tuple[int, int, int, int]]:
    """Number, entry, leave and cost of every block of a conversation; the blocks come in order."""
    after = {state: cost for state, (cost, _) in ENDINGS.items()}
    chosen = []
    for _, paths in reversed(group):
        best = {}
        for p in paths:
            if p["leave"] in after:
                key = (p["cost"] + after[p["leave"]], p["place"])
                if p["entry"] not in best or key < best[p["entry"]][0]:
                    best[p["entry"]] = key, p["leave"], p["cost"]
        after = {entry: key[0] for entry, (key, _, _) in best.items()}
        chosen.append(best)
    state, out = START, []
    for (number, _), best in zip(group, reversed(chosen)):
        _, leave, cost = best[state]
        out.append((number, state, leave, cost))
        state = leave
    number, entry, leave, cost = out[-1]
    out[-1] = number, entry, leave, cost + ENDINGS[leave][0]
    return out


def _edits(items: list[dict], audit: str, state: int) -> Iterator[tuple[str, str | None, str | None, int]]:
    """Edit, role and text (None for a deletion) and times."""
    rows = iter(items)
    for edit in audit:
        item = None if edit == "I" else next(rows)
        if edit == "D":
            yield edit, None, None, item["times"]
            continue
        keeps_system = edit == "K" and state == START and item["role"][:1] == "s"
        state = SYSTEM if keeps_system else NEXT[state]
        yield edit, item["role"] if edit == "K" else ROLES[state], "" if edit == "I" else item["text"], 1


def _in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Rows of sorted batches by conversation, one after the other; nothing is held."""
    return ((conv, group) for (conv,), group in groupby(_read(batches), key=lambda row: (row["conv_id"],)))


def _sent(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A few rows (blocks of bounded size) at a time."""
    while some := list(islice(rows, SENT_TOGETHER)):
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, SENT_TOGETHER):
            yield from batch.slice(at, SENT_TOGETHER).to_pylist()


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, number, whole, the counts, the span of turns, cost, audit and edits (edit, role, text, times): one row
    per block of a conversation. ``rows`` has conv_id, turn, role, text, copies."""
    block_type = (f"conv_id long, number long, whole boolean, {SPAN}, "
                  "rows array<struct<turn:bigint,role:string,text:string,copies:bigint>>, known array<binary>")
    path = "struct<entry:int,leave:int,cost:bigint,place:int,audit:string>"
    solved_type = (f"conv_id long, number long, whole boolean, {SPAN}, {COUNTS}, cost long, audit string, "
                   f"paths array<{path}>, items array<{ITEM}>")
    edit = "struct<edit:string,role:string,text:string,times:bigint>"
    done_type = f"conv_id long, number long, whole boolean, {SPAN}, {COUNTS}, cost long, audit string, edits array<{edit}>"
    chain_type = "number long, entry int, leave int, chained long"
    schemas = {t: _arrow(t) for t in (block_type, solved_type, done_type, chain_type)}
    span = ("low", "high", "turns", "first_role", "last_role")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for conv, number, whole, found in blocks(batches):
                there = [row for row in found if row[3]]
                turns = {row[0] for row in there if row[0] is not None}
                yield {
                    "conv_id": conv, "number": number, "whole": whole, "low": min(turns, default=None),
                    "high": max(turns, default=None), "turns": len(turns),
                    "first_role": there[0][1] if there else None, "last_role": there[-1][1] if there else None,
                    "rows": [dict(zip(("turn", "role", "text", "copies"), row)) for row in there],
                    "known": None if whole else sorted({_identity(row[1], row[2]) for row in there})}

        return _sent(rows(), schemas[block_type])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(row: dict) -> dict:
            turns = [(r["turn"], r["role"], r["text"], r["copies"]) for r in row["rows"]]
            items, counts = _items(turns, set(row["seen"] or ()))
            cost, audit, paths = _solved(items, row["whole"])
            return {
                **{k: row[k] for k in ("conv_id", "number", "whole", *span)},
                **dict(zip(("blank", "duplicate", "truncated", "illegal"), counts)), "cost": cost, "audit": audit,
                "paths": paths, "items": [dict(zip(("role", "text", "forced", "truncated", "times"), i)) for i in items]}

        return _sent(map(one, _read(batches)), schemas[solved_type])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _in_groups(batches):
            chosen = _chain([(row["number"], row["paths"]) for row in group])
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schemas[chain_type].names, c)) for c in chosen], schema=schemas[chain_type])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(row: dict) -> dict:
            edits = list(_edits(row["items"], row["audit"], row["entry"]))
            return {
                **{k: row[k] for k in schemas[done_type].names if k in row},
                "edits": [dict(zip(("edit", "role", "text", "times"), e)) for e in edits],
                "audit": "".join(e[0] * e[3] for e in edits)}

        return _sent(map(one, _read(batches)), schemas[done_type])

    cut_up = stage(in_order(rows).mapInArrow(cut, block_type), "blocks")
    parts = cut_up.filter("NOT whole")
    known = parts.select("conv_id", "number", F.explode("known").alias("known"))
    first = known.groupBy(F.col("conv_id").alias("c"), F.col("known").alias("k")).agg(
        F.min("number").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = known.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("known") == F.col("k")))
    seen = again.filter("number > first").groupBy("number").agg(F.collect_list("known").alias("seen"))
    parts = parts.join(seen, "number", "left").select(*cut_up.columns, "seen")
    nothing = F.lit(None).cast("array<binary>").alias("seen")
    solved = stage(cut_up.filter("whole").select("*", nothing).union(parts).mapInArrow(solve, solved_type), "solved")
    # costs and places only; one task has a row per block of a conversation
    slim = solved.filter("NOT whole").select("conv_id", "number", F.transform(
        "paths", lambda p: p.dropFields("audit")).alias("paths"))
    chosen = slim.repartition("conv_id").sortWithinPartitions("conv_id", "number").mapInArrow(chain, chain_type)
    last = F.col("leave").isNotNull() & (F.col("chained") > F.col("path.cost"))
    ending = F.when(last & (F.col("leave") == SYSTEM), "II").when(last & (F.col("leave") == USER), "I").otherwise("")
    pieces = solved.filter("NOT whole").join(chosen, "number").withColumn("path", F.filter(
        "paths", lambda p: (p.entry == F.col("entry")) & (p.leave == F.col("leave")))[0]).withColumns({
            "cost": F.col("chained"), "audit": F.concat(F.col("path.audit"), ending)})
    wanted = [c for c in solved.columns if c != "paths"]
    both = solved.filter("whole").select(*wanted, F.lit(START).alias("entry")).union(pieces.select(*wanted, "entry"))
    return both.mapInArrow(apply, done_type)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, number (of the block), position (in it), role, text of the repaired conversations."""
    return repair(rows).select("conv_id", "number", F.posexplode(F.filter(
        "edits", lambda e: e.edit != "D")).alias("position", "e")).select("conv_id", "number", "position", "e.role", "e.text")


def summaries(repaired: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, the counts, cost, audit and repaired_sha256, from its edited blocks."""
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kept = F.filter("edits", lambda e: e.edit != "D")
    written = F.concat_ws("\n", F.transform(kept, lambda e: F.concat(e.role, F.lit(":"), e.text)))
    rows = repaired.withColumns({"written": written, "kept": F.size(kept)}).drop("edits")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    whole = rows.filter("whole").select(
        "conv_id", gaps.alias("gaps"), *columns[2:8], F.sha2("written", 256).alias("repaired_sha256"))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, group in _in_groups(batches):
            total = dict.fromkeys(columns[2:7], 0)
            digest, audits, low, high, turns, last, begun = hashlib.sha256(), [], None, None, 0, None, False
            for row in group:
                for k in total:
                    total[k] += row[k]
                audits.append(row["audit"])
                if row["kept"]:
                    digest.update(("\n" if begun else "").encode() + row["written"].encode())
                    begun = True
                if row["low"] is not None:
                    turns += row["turns"] - (row["low"] == high)      # a turn that the cut goes through
                    low, high = row["low"] if low is None else low, row["high"]
                if row["first_role"] is not None:
                    total["illegal"] += last is not None and last[:1] + row["first_role"][:1] not in _LEGAL
                    last = row["last_role"]
            out = {"conv_id": conv, "gaps": 0 if low is None else high - low + 1 - turns, **total,
                   "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string() if isinstance(v, str) else pa.int64())
                                              for v in out.values()], names=list(out))

    pieces = rows.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "number").mapInArrow(
        join_up, ", ".join(f"{c} {'string' if c in ('audit', 'repaired_sha256') else 'long'}" for c in columns))
    return whole.select(*columns).union(pieces)

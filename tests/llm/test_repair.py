"""Repair of conversations against a plain search, on hard conversations: ties, repeats, nulls and one that fills many blocks."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import types as T

from invoicelake.llm import repair
from invoicelake.llm.queries import op13_conversation_repair, reach_workers

CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("copies", T.StringType()), T.StructField("number", T.StringType())])


@pytest.fixture(autouse=True, scope="module")
def workers(spark):
    reach_workers(spark)


def damaged(rows):
    """Python's own reading of the damage: rows by conversation."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        known = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        code = zlib.crc32(f"{known[0]}:{known[1]}".encode()) % 20
        role, text = known[2:]
        found = out.setdefault(conv, [])
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        found += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def plain(rows):
    """The answer by trying every edit, without heaps, blocks or meeting searches."""
    sys.setrecursionlimit(20_000)
    seen, kinds = set(), []
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        kinds.append("b" if not visible else "d" if (role, text) in seen else "t" if visible[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def rest(i, state, inserted):
        turned = "a" if state == "u" else "u"
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def add(cost, edit, written, at, to, n):
            tail = rest(at, to, n)
            if tail:
                found.append((cost + tail[0], edit + tail[1], (written, *tail[2]) if written else tail[2]))

        names = {"u": "user", "a": "assistant"}
        if inserted < 3:
            add(3, "I", names[turned] + ":", i, turned, inserted + 1)
        if i < len(rows):
            _, role, text = rows[i]
            add(4, "D", None, i + 1, state, 0)
            if kinds[i] not in ("b", "d"):
                more = 3 if kinds[i] == "t" else 0
                if role[:1] == turned or role[:1] == "s" and state == "":
                    add(more, "K", f"{role}:{text}", i + 1, role[:1], 0)
                add(3 + more, "R", f"{names[turned]}:{text}", i + 1, turned, 0)
        return min(found, default=None)

    cost, audit, written = rest(0, "", 0) if rows else (0, "", ())
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(kinds.count(k) for k in "bdt"), illegal, cost, audit,
            hashlib.sha256("\n".join(written).encode()).hexdigest())


def hard_rows():
    chance = random.Random(11)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?\n", "\x1c", "é", ". x", None, "Yes."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ua"]
    rows = [(c, chance.choice([None, *range(12)]), chance.choice(roles), chance.choice(texts))
            for c in [None, -3, *range(120)] for _ in range(chance.randint(1, 9))]
    rows += [(c, i, "user" if i % 2 else "assistant", chance.choice(["Same.", f"Text {i}."])) for c in (500, 501)
             for i in range(280) if chance.random() < 0.9]
    rows += [(600, 1, "user", "All the same.")] * 300 + [(601, t, "tool", None) for t in (1, 2)]
    return [(*r, "x", "y") for r in rows]


def answers(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_repair_is_the_cheapest(spark, tmp_path):
    rows = hard_rows()
    spark.createDataFrame(rows, CONVERSATIONS).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = op13_conversation_repair(spark, str(tmp_path))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    mine = found.collect()
    assert len(mine) == len({r[0] for r in rows})
    assert {r.conv_id: tuple(r)[1:] for r in mine} == {c: plain(r) for c, r in damaged(rows).items()}


def test_repaired_turns_alternate(spark):
    rows = repair.damage(spark.createDataFrame(hard_rows(), CONVERSATIONS))
    roles = {}
    for r in sorted(repair.repaired_turns(rows).collect(), key=lambda r: (r.number, r.position)):
        roles.setdefault(r.conv_id, []).append(r.role[:1])
    assert roles and all(re.fullmatch("s?(ua)+", "".join(x)) for x in roles.values())


def test_no_conversations(spark):
    rows = repair.damage(spark.createDataFrame([], CONVERSATIONS))
    assert repair.summaries(repair.repair(rows)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_meeting_searches_find_the_least_audit(seed):
    """Long lattices in one block, and cut anywhere, give the same audit."""
    chance = random.Random(seed)
    rows = [(i, chance.choice(["user", "assistant", "system"]), chance.choice(["a.", "b", "", f"{i}."]), 1) for i in range(60)]
    items, _ = repair._items(rows, set())
    cost, audit, _ = repair._solved(items, True)
    assert (cost, audit) == plain([r[:3] for r in rows])[5:7]
    at = chance.randint(1, 59)
    paths = [repair._solved(part, False)[2] for part in (items[:at], items[at:])]
    chosen = repair._chain(list(enumerate(paths)))
    audits = [next(p["audit"] for p in paths[k] if (p["entry"], p["leave"]) == (a, b)) for k, a, b, _ in chosen]
    assert sum(c[3] for c in chosen) == cost
    assert "".join(audits) + repair.ENDINGS[chosen[-1][2]][1] == audit


def test_a_block_without_rows_leads_every_state_to_itself():
    paths = repair._solved([], False)[2]
    assert [(p["entry"], p["leave"], p["cost"], p["audit"]) for p in paths] == [(s, s, 0, "") for s in range(4)]
    assert repair._solved([], True)[:2] == (0, "")
    item, _ = repair._items([(1, "user", "a.", 1), (2, "assistant", "b.", 1)], set())
    parts = [repair._solved(x, False)[2] for x in ([], item[:1], [], [], item[1:], [])]
    assert sum(c[3] for c in repair._chain(list(enumerate(parts)))) == 0

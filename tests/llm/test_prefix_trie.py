"""The trie of conversation prefixes against one built in plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from invoicelake.llm.parentheses import Parentheses
from invoicelake.llm.queries import op11_prefix_trie, reach_workers

CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("n", T.StringType())])


@pytest.fixture(autouse=True, scope="module")
def workers(spark):
    reach_workers(spark)


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(r)] for c, r in turns.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
            if d:
                children[built[c][:d - 1]].add(built[c][:d])
        ends[built[c]].append(c)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[x] for x in children[p])
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def found(spark, rows, folder):
    spark.createDataFrame(rows, CONVERSATIONS).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    out = op11_prefix_trie(spark, str(folder))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


def test_trie(spark, tmp_path):
    chance = random.Random(5)
    texts = ["a b", "c", "", None, "d e f", "a\x1cb\n c"]
    rows = [(c, chance.choice([None, 0, 1, 2, 3]), chance.choice(["user", "assistant", None]), chance.choice(texts), "x", "y")
            for c in [None, -7, 2 ** 62, *range(0, 300), 1000] for _ in range(chance.randint(1, 5))]
    # a third of all conversations are the same; long ones, with and without copies; one turn repeated
    rows += [(c, i, "user", f"same {i}", "x", "y") for c in range(2000, 2300) for i in range(3)]
    rows += [(c, i, "user", f"long {i % 7}", "x", "y") for c in (3000, 3001, 3020, 3041) for i in range(300 + c % 3)]
    rows += [(4000, 0, "user", "again", "x", "y")] * 2500
    assert found(spark, rows, tmp_path) == plain(rows)


def test_all_in_one_place(spark, tmp_path):
    """Every conversation is one and the same; the shards share all their nodes."""
    rows = [(c, 1, "user", "hello there", "x", "y") for c in range(0, 2000, 20)]
    assert found(spark, rows, tmp_path / "a") == plain(rows)
    assert found(spark, [], tmp_path / "b") == []
    assert found(spark, rows[:1], tmp_path / "c") == plain(rows[:1])


@pytest.mark.parametrize("seed", range(3))
def test_parentheses(seed):
    chance, bits, stack, closes = random.Random(seed), [1], [0], {}
    while len(bits) < 3000:
        if len(stack) == 1 or chance.random() < 0.55:
            stack.append(len(bits))
            bits.append(1)
        else:
            closes[stack.pop()] = len(bits)
            bits.append(0)
    while stack:
        closes[stack.pop()] = len(bits)
        bits.append(0)
    tree = Parentheses(np.array(bits))
    assert dict(zip(tree.open_at.tolist(), tree.subtrees().tolist())) == closes

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from mixlab.llm import prefix_trie as pt
from mixlab.llm.prefix_trie import TernaryTree, prefix_trie, shard_nodes

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain(rows):
    """Every prefix of every rebuilt conversation, in dictionaries."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            found[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest(), role, text))
    original = {c: [(v[3], v[4]) for v in sorted(vs)] for c, vs in found.items()}
    kids, members, ends = defaultdict(set), defaultdict(list), defaultdict(list)
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        sequence = tuple(original.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:])
        for d in range(len(sequence) + 1):
            members[sequence[:d]].append(c)
            if d:
                kids[sequence[: d - 1]].add(sequence[:d])
        ends[sequence].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(who) - 1) * words
    return sorted(
        (
            min(members[v]), len(v), min(members[v[:-1]]) if v else None, len(members[v]), len(kids.get(v, ())), leaves[v], saved[v],
            hashlib.sha256(",".join(map(str, sorted(ends.get(v, [])))).encode()).hexdigest(),
        )
        for v in members
    )


def run(spark, rows, **options):
    return sorted(tuple(r) for r in prefix_trie(spark.createDataFrame(rows, SCHEMA), **options).collect())


def talks(seed, convs=120, kinds=3, longest=6):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"say {rng.randrange(kinds)} " * rng.randrange(3)) for c in range(convs) for t in range(rng.randrange(1, longest))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [10**6, 40, 3])
def test_matches_brute_force_for_any_shards(spark, size):
    rows = talks(size)
    assert run(spark, rows, turns_per_shard=size) == plain(rows)


def test_long_shared_prefixes_across_shards(spark):
    """Conversations that differ in their last turns only: every shard's boundary runs through long paths."""
    rows = [(c * 20, t, "user", f"t{t}" if t < 30 + c % 7 else f"own {c}") for c in range(60) for t in range(30 + c % 9)]
    assert run(spark, rows, turns_per_shard=150) == plain(rows)


def test_given_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = talks(7, 30) + [
        (None, 1, "user", "nobody"), (100, None, None, None), (100, 2, "user", ""), (100, 2, "user", ""), (100, 2, "assistant", "tie"),
        (101, 1, "user", "x" * 100000), (102, 1, None, "x y\u000bz"), (103, 1, "", "x y\u000bz"), (-3, 1, "user", "minus"), (-20, 0, "user", "minus"),
    ]
    assert run(spark, rows) == plain(rows) == run(spark, rows, turns_per_shard=5)
    assert run(spark, []) == []


def test_turnless_conversations(spark):
    rows = [(c, 0, "user", "one") for c in range(21, 40)]
    got = run(spark, rows)
    assert got == plain(rows)
    assert any(r[1] == 0 and r[7] != pt.EMPTY for r in got)


def test_copies_are_chained_in_chunks(spark, monkeypatch):
    rows = [(c * 20, t, "user", f"{t}") for c in range(500) for t in range(3)]
    monkeypatch.setattr(pt, "IDS_PER_CHUNK", 7)
    got = run(spark, rows)
    assert got == plain(rows)
    parts = list(pt._chunks([pt._rows([(1, m) for m in range(20)] + [(2, 5)], id=pt.pa.int64(), member=pt.pa.int64())]))
    texts = [t for b in parts for t in b.column("text").to_pylist()]
    assert texts == ["0,1,2,3,4,5,6", "7,8,9,10,11,12,13", "14,15,16,17,18,19", "5"]


def test_clashing_columns(spark):
    rows = talks(3, 20)
    names = ("conv", "digest", "words", "shard", "key", "n", "ids")
    wide = T.StructType([*SCHEMA, *[T.StructField(n, T.StringType()) for n in names]])
    df = spark.createDataFrame([(*r, *names) for r in rows], wide)
    assert sorted(tuple(r) for r in prefix_trie(df).collect()) == plain(rows)


def test_median_insertion_balances_the_tree():
    tree = TernaryTree()
    ends = tree.insert_balanced([[k] for k in range(1023)])
    assert len(set(ends)) == 1023

    def depth(node):
        return 0 if not node else 1 + max(depth(tree.low[node]), depth(tree.high[node]))

    assert depth(tree.equal[0]) == 10
    assert [d for _, _, d in tree.walk()].count(1) == 1023


def test_nodes_of_one_shard():
    rows = shard_nodes([[1], [1, 2], [1, 3]], [[5], [5, 2], [5, 1]], [2, 1, 1], [4, 9, 7], -1, -1)
    by = {(r[0], r[1]): r for r in rows}
    assert by[(4, 0)][3:8] == (4, 1, 2, 4 * 5 + 3, 8)
    assert by[(4, 1)][3:9] == (4, 2, 2, 23, 8, 4) and by[(9, 2)][2] == 4

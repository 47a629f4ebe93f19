import zlib
from collections import defaultdict

import numpy as np

from mixlab.llm.sharding import jump, shard


def plain_jump(key, shards):
    """One key, in plain integers."""
    at, ahead, state = -1, 0, key % 2**64
    while ahead < shards:
        at = ahead
        state = (state * 2862933555777941757 + 1) % 2**64
        ahead = int((at + 1) * (2**31 / ((state >> 33) + 1)))
    return at


def test_jump_moves_only_into_the_new_shard():
    keys = np.concatenate([np.arange(3000), [-1, 2**63 - 1, -(2**63)]])
    before = jump(keys, 1)
    assert (before == 0).all()
    for shards in range(2, 14):
        now = jump(keys, shards)
        assert now[:200].tolist() == [plain_jump(int(k), shards) for k in keys[:200]]
        assert ((now == before) | (now == shards - 1)).all()
        assert abs((now == shards - 1).mean() - 1 / shards) < 0.03
        before = now


def test_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, "é" * 9), (4, "a" * 100000), (4, "a" * 100000), (None, "x"), (0, "x"), *[(i, "same") for i in range(10, 200)]]
    slots = defaultdict(list)
    for r in shard(documents(rows)).collect():
        key = r["doc_id"] or 0
        assert r["law"] == "key"
        assert r["shard"] == plain_jump(key, 8) and r["grown_shard"] == plain_jump(key, 9)
        slots[r["shard"]].append(r["slot"])
        texts = {t or "" for k, t in rows if k == r["doc_id"]}
        assert any(r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode()) for t in texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(map(len, slots.values())) == len(rows)
    assert shard(documents([])).collect() == []


def test_slots_are_gapless_over_many_buckets(corpus, monkeypatch):
    from mixlab.llm import sharding

    monkeypatch.setattr(sharding, "bucket_count", lambda rows: 7)
    first = {(r["doc_id"], r["shard"], r["slot"]) for r in shard(corpus).collect()}
    assert first == {(r["doc_id"], r["shard"], r["slot"]) for r in shard(corpus.repartition(3)).collect()}
    slots = defaultdict(list)
    for _, s, slot in first:
        slots[s].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())

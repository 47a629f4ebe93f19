import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mixlab.llm import mixing
from mixlab.llm.mixing import mix


def targets(sizes, epochs=3):
    """Caps and shares again, round by round."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    free, left, out = set(sizes), sum(sizes.values()), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > epochs * sizes[s]}
        if not over:
            return out | {s: share * weight[s] for s in free}
        for s in over:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        free -= over
    return out


def check(rows, docs, weights=None):
    sizes, taken, size_of = defaultdict(int), defaultdict(int), {}
    for i, (k, t, s) in enumerate(rows):
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    result = mix(docs, weights).collect()
    assert len(result) == len(rows)
    largest = defaultdict(int)
    for r in result:
        s = r["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        whole = int(r["target"] // sizes[s]) if sizes[s] else 0
        assert r["taken"] - whole * r["size"] in (0, r["size"])
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    return sorted((str(r["doc_id"]), str(r["source"]), r["taken"]) for r in result)


def test_odd_rows(documents, spark):
    rows = [(1, None, "b"), (2, "", "a"), (3, "one", "a"), (4, "x " * 4000, "big"), (5, "y", None), (6, "z z", "Z"), (7, "q", "é"), (None, "w w w", "a"), (8, "t", "a"), (8, "t", "a")]
    docs = documents(rows)
    first = check(rows, docs)
    assert first == check(rows, docs.repartition(5))
    assert mix(documents([])).collect() == []
    assert [r["taken"] for r in mix(documents([(1, None, "a"), (2, " ", None)])).collect()] == [0, 0]
    weights = spark.createDataFrame([(3, 2.0), (8, None), (77, 1.0)], "doc_id long, weight double")
    check(rows, docs, weights)


def test_hot_source_in_many_buckets(documents, monkeypatch):
    monkeypatch.setattr(mixing, "bucket_count", lambda rows: 9)
    rows = [(i, "w " * (i % 17 + 1), "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    check(rows, documents(rows))


def test_heavier_documents_are_taken_first(documents, spark):
    rows = [(i, "w " * 10, "a" if i < 400 else "b") for i in range(1600)]
    weights = spark.createDataFrame([(i, 4.0 if i % 2 else 0.25) for i in range(1600)], "doc_id long, weight double")
    taken = {r["doc_id"]: r["taken"] for r in mix(documents(rows), weights).collect() if r["source"] == "b"}
    assert 0 < sum(taken.values())
    assert sum(v for k, v in taken.items() if k % 2) > 1.2 * sum(v for k, v in taken.items() if k % 2 == 0)


@pytest.mark.parametrize("weights", [[1.0], [0.5], [2.0, 0.5, 1.0], [1e-3, 1e3]])
def test_buckets_stay_even_for_any_weights(spark, weights):
    """The largest bucket grows with the bound on its rows, not with the input."""
    from mixlab.llm.mixing import key_buckets, sampling_key

    choose = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("id") % len(weights) + 1).cast("int"))
    rows = spark.range(40_000).withColumn("w", choose).withColumn("key", sampling_key(F.col("id"), F.col("w"), 7))
    placed = rows.withColumn("part", key_buckets(rows, "w", "key", per_bucket=200))
    sizes = [r["count"] for r in placed.groupBy("part").count().collect()]
    assert max(sizes) < 400 and len(sizes) > 150
    ordered = [r["part"] for r in placed.orderBy("key").select("part").collect()]
    assert ordered == sorted(ordered)

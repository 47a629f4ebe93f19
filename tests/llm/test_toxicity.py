import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlab.llm import toxicity as tox
from mixlab.llm.text import chunks, string_buffers


def data(spark, number=900, seed=1):
    """Clean texts of common words; toxic ones hold one of a few bad stems with any ending."""
    draw = np.random.default_rng(seed)
    common = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(number):
        words = draw.choice(common, draw.integers(3, 60)).tolist()
        bad = i % 4 == 0
        if bad:
            words.insert(int(draw.integers(len(words))), f"{draw.choice(['brumm', 'Krach', 'zonk'])}{draw.integers(99)}!")
        rows.append((i, " ".join(words), "xy" if i % 3 else "zz"))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_rows_are_learnt_and_not_read(spark):
    docs, labels = data(spark)
    scored = tox.toxicity(docs, labels).withColumn("out", tox.held_out()).join(labels, "doc_id").collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in scored)
    out = [r for r in scored if r["out"]]
    assert np.mean([(r["score"] >= 0.3) == r["toxic"] for r in out]) > 0.95
    assert np.mean([r["rejected"] == bool(r["toxic"]) for r in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in scored)
    turned = labels.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in tox.toxicity(docs.withColumn("lang", F.lit("q")), turned).collect()}
    assert again == {r["doc_id"]: r["score"] for r in scored}


def test_odd_rows(spark):
    docs, labels = data(spark, 300)
    odd = spark.createDataFrame(
        [(None, None, None), (9001, "", "xy"), (9002, "...", None), (9003, "zonk5 " * 30000, "xy"), (9003, "zonk5 " * 30000, "xy"), (9004, "x" * 100000, "zz")],
        docs.schema,
    )
    nulls = spark.createDataFrame([(None, 1), (9001, None), (5, 7)], labels.schema)
    scored = tox.toxicity(docs.unionByName(odd), labels.unionByName(nulls)).collect()
    assert len(scored) == 306 and all(r["score"] is not None and r["rejected"] is not None for r in scored)
    by = {}
    for r in scored:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[9001] == by[9002] == by[None] == [0.0] and by[9003][0] == by[9003][1] > 0.5
    assert tox.toxicity(docs.limit(0), labels).collect() == []
    for few in (labels.limit(0), labels.where("toxic = 0")):
        assert {r["score"] >= 0.3 for r in tox.toxicity(docs, few).collect()} == {False}


def test_padding_and_slices_do_not_change_scores():
    texts = ["", "a", "b c", None, "a b c d e f g"] * 5
    model = tox.train(["bad a b", "a b c", "bad", "c"] * 20, np.array([1, 0, 1, 0] * 20))
    import pyarrow as pa

    whole = model.scores(tox.Letters(*string_buffers(pa.array(texts)), lower=True))
    single = [model.scores(tox.Letters(*string_buffers(pa.array([t], pa.string())), lower=True))[0] for t in texts]
    assert whole == pytest.approx(single, abs=1e-6)


def test_threshold_lies_in_the_gap():
    scores, labels = np.array([0.9, 0.8, 0.4, 0.1]), np.array([1.0, 1, 0, 0])
    assert tox.best_threshold(scores, labels, np.ones(4)) == pytest.approx(0.6)
    assert tox.thresholds(scores, labels, ["a", None, "a", "b"], 0.5) == {None: pytest.approx(0.6)}


def test_given_labels(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = tox.toxicity(docs, labels).withColumn("out", tox.held_out()).join(labels, "doc_id").collect()
    assert len(rows) == labels.count()
    assert np.mean([(r["score"] >= 0.3) == r["toxic"] for r in rows if not r["out"]]) > 0.9


def test_thresholds_cover_all_labelled_rows(spark, monkeypatch):
    """A small training sample leaves no labelled row out of the calibration, and rare languages get a threshold."""
    seen = {}
    whole = tox.thresholds

    def spy(scores, labels, langs, share, counts=None):
        seen["rows"] = (np.ones(len(scores)) if counts is None else counts).sum()
        return seen.setdefault("limits", whole(scores, labels, langs, share, counts))

    monkeypatch.setattr(tox, "thresholds", spy)
    docs, labels = data(spark)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 32 < 5, "rare").otherwise("much"))
    usable = labels.where(~tox.held_out())
    for sample in ({}, {"toxic": 60, "clean": 120}):
        seen.clear()
        tox.toxicity(docs, labels, **sample)
        assert seen["rows"] == usable.count()
        assert set(seen["limits"]) == {None, "rare", "much"}


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    """Very long labelled texts are scored but not fitted, and the fitted ones stay below the bound."""
    docs, labels = data(spark, 600)
    long = docs.withColumn("text", F.when(F.col("doc_id") % 40 == 0, F.repeat(F.concat("text", F.lit(" ")), 2000)).otherwise(F.col("text")))
    seen = []
    train = tox.train
    monkeypatch.setattr(tox, "train", lambda texts, marks: seen.append((texts, marks)) or train(texts, marks))
    bound = dict(toxic_bytes=16_000, clean_bytes=24_000)
    scored = tox.toxicity(long, labels, **bound).join(labels, "doc_id").collect()
    texts, marks = seen[0]
    for mark, most in ((1, 16_000), (0, 24_000)):
        own = [len(t) for t, m in zip(texts, marks) if m == mark]
        assert own and max(own) * 16 <= most and most * 0.8 < sum(own) <= most
    assert len(scored) == 600 and np.mean([(r["score"] >= 0.3) == r["toxic"] for r in scored]) > 0.9


def test_logits_equal_plain_loops():
    """Embedding, filters over every place, maximum, bias and output, one word and filter at a time."""
    import pyarrow as pa

    texts = ["", "bad a b", "c", "a b c bad bad é", "one two three four five six"]
    model = tox.train(["bad a b", "a b c", "bad", "c d"] * 20, np.array([1, 0, 1, 0] * 20))
    words = tox.Letters(*string_buffers(pa.array(texts, pa.large_string())), lower=True)
    codes, rows = tox.features(words)
    want = []
    for i in range(len(texts)):
        vectors = [sum(model.table[b].astype(float) for b in rows[c]) for c in codes[words.first[i] : words.first[i + 1]]]
        total, filter_number, column = float(model.output[-1]), 0, 0
        for width in tox.WIDTHS:
            for f in range(tox.FILTERS):
                best = -np.inf
                # Padding is zero: a filter may hang over the end, and start right after the last word.
                for start in range(len(vectors) + 1):
                    response = 0.0
                    for k in range(width):
                        if start + k < len(vectors):
                            response += float(vectors[start + k] @ model.filters[:, column + k * tox.FILTERS + f].astype(float))
                    best = max(best, response)
                total += max(best + float(model.bias[filter_number]), 0.0) * float(model.output[filter_number])
                filter_number += 1
            column += width * tox.FILTERS
        want.append(total)
    assert model.logits(words) == pytest.approx(want, abs=1e-4)


def test_word_order_alone_is_learnt():
    """Both classes hold the same words; only which of two stands first tells them apart."""
    import pyarrow as pa

    draw = np.random.default_rng(3)
    texts, marks = [], []
    for i in range(800):
        words = [f"w{j}" for j in draw.integers(0, 30, 6)]
        at = int(draw.integers(len(words)))
        texts.append(" ".join(words[:at] + (["left", "right"] if i % 2 else ["right", "left"]) + words[at:]))
        marks.append(i % 2)
    model = tox.train(texts[:600], np.array(marks[:600]))
    words = tox.Letters(*string_buffers(pa.array(texts[600:], pa.large_string())), lower=True)
    assert np.mean((model.logits(words) > 0) == (np.array(marks[600:]) == 1)) > 0.95


def test_encoding_by_chunks_equals_that_of_all_texts(monkeypatch):
    import pyarrow as pa

    texts = ["", "a", "b c a", "...", "krach1 krach2 é a"] + [f"w{i % 7} x{i} common" for i in range(200)] + ["y " * 3000, ""]
    whole = tox.Letters(*string_buffers(pa.array(texts, pa.large_string())), lower=True)
    codes, rows = tox.features(whole)
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(tox, "chunks", lambda batch, text, size=size: chunks(batch, text, size))
        got = tox.encoded(texts)
        assert [x.tolist() for x in got] == [codes.tolist(), rows.tolist(), whole.first.tolist()]
    assert [len(x) for x in tox.encoded([])] == [0, 0, 1]
    assert [len(x) for x in tox.encoded(["", "."])] == [0, 0, 3]


def test_fitting_holds_little_beside_the_texts(monkeypatch):
    """The driver fits: no temporary array over all words of the sample."""
    monkeypatch.setattr(tox, "LEAST_STEPS", 1)
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{j}" for j in draw.integers(0, 5000, 1200)) for _ in range(1200)]
    tracemalloc.start()
    try:
        tox.train(texts, np.arange(1200) % 3 == 0, epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 * sum(map(len, texts))


def test_driver_keeps_nothing_of_the_fit(spark, monkeypatch):
    """What fitting took is given back before the corpus is scored."""
    docs, labels = data(spark, 200)
    order = []
    monkeypatch.setattr(tox, "train", lambda texts, marks, plain=tox.train: order.append("train") or plain(texts, marks))
    monkeypatch.setattr(tox, "give_back", lambda plain=tox.give_back: order.append("give_back") or plain())
    monkeypatch.setattr(tox.bitmaps, "mark", lambda *a, plain=tox.bitmaps.mark: order.append("score") or plain(*a))
    tox.fit(docs, labels)
    assert order == ["train", "give_back", "score"]

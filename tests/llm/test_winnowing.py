import hashlib
import re
import zlib

import pytest
from pyspark.sql import types as T

from mixlab.llm import winnowing
from mixlab.llm.winnowing import BASES, PRIMES, edited_fingerprints, fingerprints


def plain(text, k=4, window=8):
    tokens = re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")
    if not tokens:
        return [], []
    values = [zlib.crc32(t.encode()) % PRIMES[0] for t in tokens] + [0] * (k - len(tokens))

    def rolled(at, which):
        total = 0
        for v in values[at : at + k]:
            total = (total * BASES[which] + v) % PRIMES[which]
        return total

    grams = max(1, len(tokens) - k + 1)
    first = [rolled(i, 0) for i in range(grams)]
    chosen = sorted({min(range(s, min(s + window, grams)), key=lambda i: (first[i], -i)) for s in range(max(1, grams - window + 1))})
    return chosen, [first[p] * 2**30 + rolled(p, 1) for p in chosen]


def alike(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0


def plain_rows(rows):
    """Every document beside its edited text; repeats follow each other."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out = []
    for at, (i, text) in enumerate(rows):
        after = rows[(at + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, other, near = plain(text), plain(edited), plain(after)
        marks = [",".join(f"{p}:{h:x}" for p, h in zip(*m)) for m in (own, other)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *marks, alike(own[1], other[1]), alike(own[1], near[1])))
    return sorted(out, key=str)


def run(df, **options):
    return sorted((tuple(r) for r in edited_fingerprints(df, **options).collect()), key=str)


TEXTS = ["", None, " \t\n", "one", "one two three", "a b c d e f g h i j k l m n o", "same " * 60, "x" * 9000, "x" * 8192 + " y" * 30, "é😀 " * 40, "漢字" * 200]


@pytest.mark.parametrize("k,window", [(4, 8), (1, 1), (3, 5), (5, 12), (7, 20)])
def test_fingerprints_match_brute_force(documents, k, window):
    words = "the cat sat on a mat and the dog ran off".split()
    texts = [*TEXTS, " ".join(words[(i * i + i // 7) % 11] for i in range(3000))]
    got = {r["doc_id"]: (r["positions"], r["hashes"]) for r in fingerprints(documents(list(enumerate(texts))), k=k, window=window).collect()}
    assert got == {i: plain(t, k, window) for i, t in enumerate(texts)}


def test_pieces_and_runs_do_not_show(corpus, monkeypatch):
    want = {r["doc_id"]: tuple(r) for r in fingerprints(corpus).collect()}
    monkeypatch.setattr(winnowing, "PIECE", 32)
    monkeypatch.setattr(winnowing, "RUN", 5)
    assert {r["doc_id"]: tuple(r) for r in fingerprints(corpus).collect()} == want


def test_shared_passages_share_a_fingerprint(documents):
    """The guarantee: window + k - 1 equal tokens in a row are enough, at known positions."""
    passage = " ".join(f"p{i}" for i in range(11))
    texts = [" ".join(f"{d}-{i}" for i in range(13 * d)) + " " + passage + " " + " ".join(f"{d}+{i}" for i in range(40 - d)) for d in range(6)]
    rows = fingerprints(documents(list(enumerate(texts)))).collect()
    marks = {r["doc_id"]: dict(zip(r["hashes"], r["positions"])) for r in rows}
    for d in range(1, 6):
        common = set(marks[0]) & set(marks[d])
        assert common and all(texts[0].split()[marks[0][h]] == texts[d].split()[marks[d][h]] for h in common)


def test_edits_match_brute_force(corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert run(corpus) == plain_rows(rows)
    assert run(corpus, rows_per_range=13) == plain_rows(rows)


def test_odd_rows(documents):
    rows = list(enumerate(TEXTS)) + [(3, "one"), (3, "one"), (3, "another one here " * 9), (None, "nobody"), (None, None)]
    got = run(documents(rows))
    # Texts under one id follow each other by hash, so only rows with an id of their own have a set follower.
    assert len(got) == len(rows)
    single = [r for r in plain_rows(rows) if r[0] not in (2, 3, 10, None)]
    assert [r for r in got if r[0] not in (2, 3, 10, None)] == single
    assert [r for r in run(documents([(1, "a b")]))] == plain_rows([(1, "a b")])
    assert run(documents([])) == []


def test_repeated_rows_follow_each_other(documents, monkeypatch):
    monkeypatch.setattr(winnowing, "REPEAT", 3)
    rows = [(1, "first text of all " * 20)] + [(2, "repeated words over and over " * 9)] * 10 + [(3, "the end of it " * 9)]
    assert run(documents(rows)) == plain_rows(rows)


def test_clashing_columns(spark, documents):
    rows = [(i, f"words of {i} " * 30) for i in range(9)]
    names = ["id", "g", "z", "h", "doc", "times", "start", "mark", "edited", "range"]
    df = documents(rows).selectExpr("*", *[f"'{n}' as `{n}`" for n in names])
    assert run(df) == plain_rows(rows)


def test_no_python_and_one_shuffle_of_texts(corpus):
    df = edited_fingerprints(corpus)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan
    assert "ReusedExchange" in plan or plan.count("BroadcastHashJoin") > 1


def test_schema_types(corpus):
    kinds = {f.name: f.dataType for f in edited_fingerprints(corpus).schema}
    assert kinds["n_chars"] == T.LongType() and kinds["near_next"] == T.DoubleType() and kinds["fingerprint"] == T.StringType()

from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check_queries import compare, connect
from mixlab.llm import queries as llm
from mixlab.llm.ngram_join import Rule
from mixlab.llm.tokens import tokenizer_path
import test_exact_dedup
import test_mixing
import test_ngram_join
import test_packing

STEPS = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_matches_sql(spark, folder, name):
    got = llm.QUERIES[name](spark, folder).toArrow()
    assert got.num_rows > 0
    assert compare(got, connect(folder).sql(llm.ORACLE[name]).to_arrow_table()) == []


def test_all_are_registered():
    names = queries()
    assert {n.split("_")[0] for n in llm.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(llm.QUERIES) | {"pipeline"} <= set(names) and set(llm.ORACLE) <= set(oracle_sql())


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """Input and output rows of each stage."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        step(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.dtypes == docs.dtypes
        out[name] = (docs.collect(), after.collect())
        docs = after
    return out


def texts(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


def test_stages_take_effect(stages):
    before, after = stages["toxicity"]
    assert set(texts(after)) <= set(texts(before)) and 0.6 * len(before) < len(after) < len(before)
    before, after = stages["exact_dedup"]
    kept = [k for k, _, _, keep, _ in test_exact_dedup.brute(texts(before)) if keep]
    assert sorted(kept) == sorted(str(r["doc_id"]) for r in after)
    before, after = stages["ngram_jaccard"]
    kept = [k for k, _, c in test_ngram_join.brute(texts(before), Rule(5, corpus_pipeline.drop_near_copies.__defaults__[0].threshold)) if k == c]
    assert sorted(kept) == sorted(str(r["doc_id"]) for r in after)
    before, after = stages["mixing"]
    words = Counter()
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += len((r["text"] or "").split())
    for r in after:
        words[r["source"]] += len((r["text"] or "").split())
    want = test_mixing.targets(sizes)
    longest = max(len((r["text"] or "").split()) for r in before)
    assert all(abs(words[s] - want[s]) <= longest / 2 + 1e-6 for s in sizes)
    assert max(Counter(r["doc_id"] for r in after).values()) <= 3
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    test_packing.check(after, texts(before), lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids, 4096)


def test_run_gives_the_last_stage(spark, folder, stages):
    assert corpus_pipeline.run(spark, folder).count() == len(stages["packing"][1])


def test_odd_rows_pass_every_stage(spark, folder, documents):
    odd = documents([(None, None, None), (1, "", "a"), (1, "", "a"), (2, "x " * 30000, None), (3, "a b", "a"), (3, "a b", "a")])
    clash = odd.selectExpr("*", "1 AS score", "2 AS rejected", "'d' AS digest", "3 AS _id", "4 AS taken", "5 AS key")
    for name, step in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0), clash):
            result = step(spark, docs, folder)
            rows = result.collect()
            assert len(rows) <= 3 * 6 + 60
            if name != "packing":
                assert result.columns == docs.columns


def test_repeated_rows_are_one_document(spark, folder, documents):
    long = "one two three four five six seven eight nine ten"
    rows = [(1, long)] * 3 + [(2, "a  b"), (2, "ab"), (2, "other"), (None, long + " "), (None, "lone"), (None, "lone"), (3, "clean text of its own")]
    after = STEPS["exact_dedup"](spark, documents(rows), folder).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in after if r["text"] != long + " ") == sorted(
        [("2", "a  b"), ("2", "other"), ("None", "lone"), ("3", "clean text of its own")]
    )
    assert [r["doc_id"] for r in after if r["text"] == long + " "] == [None]


def test_one_row_of_each_component_stays(spark, folder, documents):
    words = [f"w{i}" for i in range(60)]
    base, near = " ".join(words), " ".join([*words[:-1], "changed"])
    rows = [(1, base)] * 3 + [(1, near), (2, near), (None, base), (1, "something else entirely under the same id as above")]
    after = STEPS["ngram_jaccard"](spark, documents(rows), folder).collect()
    assert sorted((r["doc_id"], len(r["text"].split())) for r in after) == [(1, 9), (1, 60)]
    nameless = [(None, base), (None, base), (None, near), (None, "nothing like the others at all here")]
    after = STEPS["ngram_jaccard"](spark, documents(nameless), folder).collect()
    assert sorted(len(r["text"].split()) for r in after) == [7, 60]


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: i // 4, lambda i: 7])
def test_the_mix_goes_by_rows_not_ids(spark, folder, documents, ids):
    """Nameless rows, repeated ids and different texts under one id meet the target like any others."""
    rows = [(ids(i), " ".join(["word"] * (3 + i % 9) + [str(i // 2)]), "big" if i % 4 else "small") for i in range(80)]
    before = documents(rows)
    after = STEPS["mixing"](spark, before, folder).collect()
    sizes, words = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    for r in after:
        words[r["source"]] += len(r["text"].split())
    want = test_mixing.targets(sizes)
    assert all(abs(words[s] - want[s]) <= 13 / 2 for s in sizes)
    assert {(r["doc_id"], r["text"]) for r in after} <= {(i, t) for i, t, _ in rows}

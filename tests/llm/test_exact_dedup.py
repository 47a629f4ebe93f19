import hashlib
import re
from collections import defaultdict

from mixlab.llm.exact_dedup import drop_copies, exact_dedup

ODD = [
    (5, "a b"), (3, "ab"), (4, " a\tb\n"), (9, None), (8, ""), (7, " \r\x0b\x0c"), (6, "é" * 5000), (2, "é" * 5000 + " "), (None, "ab"), (1, "ab"), (1, "ab"),
    (10, "a\xa0b"), (11, "long " * 40000), (12, "long " * 39999 + "lon g"), (13, "x" * 64 + "1"), (14, "x" * 64 + "2"), (15, "x" * 64 + "1"),
]


def brute(rows):
    groups = defaultdict(list)
    for k, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), k is None, k or 0, k))
    out = []
    for content, held in groups.items():
        keep = min(held)[3]
        digest = hashlib.sha256(content.encode()).hexdigest()
        out += [(str(h[3]), str(keep), len(held), h[3] == keep, digest) for h in held]
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["digest"]) for r in df.collect())


def test_odd_rows(documents):
    docs = documents(ODD)
    assert got(exact_dedup(docs, digest_all=True)) == brute(ODD)
    assert got(exact_dedup(documents([]))) == []
    clash = docs.withColumnRenamed("lang", "digest").withColumnRenamed("source", "kept").withColumnRenamed("n_chars", "_id")
    assert got(exact_dedup(clash, digest_all=True)) == brute(ODD)


def test_full_content_is_read_of_groups_only(documents):
    rows = got(exact_dedup(documents(ODD)))
    want = {(k, d) for k, _, size, _, d in brute(ODD) if size > 1}
    have = {(k, d) for k, _, _, _, d in rows if d is not None}
    assert want <= have and len(have - want) <= 4


def test_no_python_on_the_path(documents):
    plan = exact_dedup(documents(ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_dropping_keeps_columns_and_one_text(corpus):
    left = drop_copies(corpus)
    assert left.columns == corpus.columns
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(k for k, _, _, kept, _ in brute(rows) if kept)

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from mixlab.llm import vector_codes as vc
from mixlab.llm.vector_codes import Codebooks, fits, sequency_rows, vector_codes

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def plain(rows, parts=8, entries=16, rounds=6):
    """The whole job in Python integers: (vec_id, code, error, label_error, digest) per row."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // parts)
    whole = []
    for i, v, label in kept:
        numbers = [math.floor(4096 * float(np.float32(x))) for x in v] + [0] * (parts * width - len(v))
        whole.append((i, label, [numbers[p * width : (p + 1) * width] for p in range(parts)]))
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    books = [[r[2][p] for r in whole[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            drawn = defaultdict(list)
            for r in whole:
                drawn[near(r[2][p], books[p])[1]].append(r[2][p])
            books[p] = [[sum(c) // len(c) for c in zip(*drawn[k])] if k in drawn else e for k, e in enumerate(books[p])]
    coded, by_label = [], defaultdict(int)
    for i, label, cut in whole:
        found = [near(part, books[p]) for p, part in enumerate(cut)]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        by_label[label] += coded[-1][3]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], digest) for i, label, c, e in coded), key=str)


def run(spark, rows, **options):
    return sorted((tuple(r) for r in vector_codes(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=str)


@given(st.integers(1, 9), st.sampled_from([3, 4096, 1 << 40]), st.integers(0, 10**6))
@settings(max_examples=30, deadline=None)
def test_nearest_is_exact(width, largest, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-largest, largest + 1, (40, 2, width))
    entries = rng.integers(-largest, largest + 1, (2, 9, width))
    entries[:, 5] = entries[:, 2]
    index, error = Codebooks(entries).assign(vectors)
    for part in range(2):
        far = ((vectors[:, part].astype(object)[:, None] - entries[part].astype(object)[None]) ** 2).sum(axis=2)
        assert index[:, part].tolist() == [min(range(9), key=lambda k: (row[k], k)) for row in far]
        assert [int(e) for e in error[:, part]] == [min(row) for row in far]


def test_rows_are_orthogonal_and_in_sequency_order():
    for size in (1, 2, 8, 64):
        rows = sequency_rows(size)
        assert (rows @ rows.T == size * np.eye(size, dtype=np.int64)).all()
        assert (rows[:, 1:] != rows[:, :-1]).sum(axis=1).tolist() == list(range(size))


def test_bound_of_plain_arithmetic():
    assert fits(1 << 27, 8) and not fits(1 << 31, 8)


def test_entries_leave_early():
    """Far entries are given up after the leading coefficients."""
    rng = np.random.default_rng(5)
    entries = (rng.integers(-10, 10, (16, 8)) + 1000 * np.arange(16)[:, None]).astype(np.int64)
    rows = entries[rng.integers(0, 16, 500)] + rng.integers(-5, 5, (500, 8))
    matrix = sequency_rows(8)
    have, want = vc.transform(rows, matrix), vc.transform(entries, matrix)
    partial = sum((have[:, c, None] - want[None, :, c]) ** 2 for c in range(vc.LEAD))
    whole = ((have[:, None] - want[None]) ** 2).sum(axis=2).min(axis=1)
    assert (partial <= whole[:, None]).sum() < 600


def test_matches_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").limit(120).collect()]
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None], 1), (3, [nan, 0.0], 1), (4, [0.0, -inf], None), (None, [0.5] * 16, 2)]
    rows += [(i, [((i * 7 + j * 3) % 11) / 8 - 0.6 for j in range(16)], None if i % 3 else 5) for i in range(10, 60)]
    rows += [(10, [0.1] * 16, 5), (10, [0.1] * 16, 5), (70, [0.25, -0.25], 5), (71, [], 5), (72, [-1e-9] * 16, 7)]
    got = run(spark, rows)
    assert got == plain(rows) and len(got) == len(rows) - 4
    assert run(spark, []) == [] and run(spark, rows[:4]) == []


def test_few_rows_and_ragged_parts(spark):
    rows = [(3, [0.5, 0.25, -0.125], 1), (9, [0.5, 0.25, -0.5], 1)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, parts=2, entries=1, rounds=2) == plain(rows, 2, 1, 2)
    with pytest.raises(ValueError):
        run(spark, rows, entries=257)


def test_large_numbers(spark):
    rows = [(i, [float((i * 13 + j) % 7 - 3) * 1e5 for j in range(8)], 1) for i in range(30)]
    assert run(spark, rows) == plain(rows)
    huge = run(spark, [*rows, (99, [3e38] * 8, 1)])
    assert len(huge) == 31 and all(0 <= r[2] <= r[3] <= 2**63 - 1 for r in huge)


def test_clashing_columns(spark):
    rows = [(i, [float(i % 5)] * 8, i % 2) for i in range(20)]
    wide = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], T.StructType([*SCHEMA, *[T.StructField(n, t) for n, t in (("code", T.StringType()), ("id", T.IntegerType()), ("numbers", T.IntegerType()))]]))
    assert sorted((tuple(r) for r in vector_codes(wide).collect()), key=str) == run(spark, rows)


def test_parts_decode_to_their_entries():
    books = Codebooks(np.arange(2 * 3 * 2).reshape(2, 3, 2))
    assert vc.decode(["0001", "0200"], books).tolist() == [[0, 1, 8, 9], [4, 5, 6, 7]]

import numpy as np

from mixlab.llm import embedding_dedup
from mixlab.llm.embedding_dedup import vector_components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    usable = []
    for k, v in rows:
        ok = k is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        usable.append(np.array(v, np.float32).astype(float) if ok else None)
    n = len(rows)
    links, label = [0] * n, list(range(n))
    near = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            a, b = usable[i], usable[j]
            if i != j and a is not None and b is not None and len(a) == len(b):
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                    links[i] += 1
                    near[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((str(rows[i][0]), links[i], str(least), rows[i][0] == least))
    return sorted(out)


def got(df):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in df.collect())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0]),
        (9, [1.0, 0.0]), (10, [1.0, 0.1]), (11, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (12, [-1.0, 0.0]), (13, [-0.0, 1.0]), (14, [0.0, 1.0]), (14, [-1.0, -1.0]), (14, [-1.0, -1.01]), (15, [3e38, 0.0]), (16, [1e-38, 0.0]),
    ]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)
    assert got(vector_components(df)) == brute(rows)
    assert got(vector_components(df.limit(0))) == []


def test_clusters_larger_than_window_and_block(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    draw = np.random.default_rng(1)
    rows = []
    for size in (150, 30, 5, 2, 2, 1, 1):
        center = draw.standard_normal(16)
        rows += [(len(rows) + i, (center + 0.05 * draw.standard_normal(16)).tolist()) for i in range(size)]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)
    assert got(vector_components(df, window=8)) == brute(rows)


def test_recall_on_given_vectors(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = {k: (n, c) for k, n, c, _ in brute(rows)}
    found = {k: (n, c) for k, n, c, _ in got(vector_components(df))}
    assert all(found[k][0] <= want[k][0] for k in want)
    assert sum(n for n, _ in found.values()) >= 0.9 * sum(n for n, _ in want.values())
    assert sum(found[k][1] == want[k][1] for k in want) >= 0.95 * len(want)


def test_spread_recall(spark):
    """Pairs spread from 0.95 to 1 among many unrelated vectors."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(1200):
        a = draw.standard_normal(32)
        a /= np.linalg.norm(a)
        b = draw.standard_normal(32)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = draw.uniform(0.951, 1)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + np.sqrt(1 - c * c) * b).tolist())]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)
    assert sum(n for _, n, _, _ in got(vector_components(df))) >= 0.9 * len(rows)


def test_dense_recall(spark):
    """Pairs in a crowd with a common direction, where unrelated vectors have a cosine of 0.8."""
    draw = np.random.default_rng(6)
    common, dim, rows = np.zeros(64), 64, []
    common[0] = np.sqrt(0.8)
    for i in range(10000):
        # One of the pair, and the other at an exact cosine, both with the same share of the common direction.
        a, b = (draw.standard_normal(dim) for _ in range(2))
        a[0] = b[0] = 0
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = 1 - (1 - draw.uniform(0.951, 0.96)) / 0.2
        s = np.sqrt(0.2)
        rows += [(2 * i, (common + s * a).tolist()), (2 * i + 1, (common + s * (c * a + np.sqrt(1 - c * c) * b)).tolist())]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)
    least = {r["vec_id"]: r["component_id"] for r in vector_components(df).collect()}
    assert np.mean([least[2 * i] == least[2 * i + 1] for i in range(10000)]) >= 0.95


def test_all_pairs_in_blocks_when_rounds_do_not_suffice(spark, monkeypatch):
    """Two neighbours in two passes miss most links; blocks of a few vectors each find them all."""
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((40, 16))
    rows = [(i, (centres[i % 40] + 0.12 * draw.standard_normal(16)).tolist()) for i in range(400)]
    rows += [(400 + i, draw.standard_normal(8).tolist()) for i in range(20)] + [(500, None), (501, [0.0] * 16), (502, rows[0][1])]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)
    want = brute(rows)
    few = dict(passes=2, window=1, recall=0.0)
    assert got(vector_components(df, **few)) != want
    monkeypatch.setattr("mixlab.llm.embedding_dedup.BLOCK_BYTES", 16 * 8 * 50)
    assert got(vector_components(df, passes=200, window=1, recall=1.1)) == want


def test_blocks_alone_join_what_pairs_join(spark, monkeypatch):
    draw = np.random.default_rng(9)
    centres = draw.standard_normal((30, 16))
    rows = [(i, centres[i % 30] + 0.12 * draw.standard_normal(16)) for i in range(300)]
    units = [(k, 16, (v / np.linalg.norm(v)).tobytes()) for k, v in rows]
    nodes = spark.createDataFrame(units, "node long, dim int, unit binary")
    roots = spark.createDataFrame([(0, 0), (0, 30)], "root long, node long")
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 16 * 8 * 40)
    links = embedding_dedup._all_links(nodes, roots, 0.95).unionByName(roots.toDF("a", "b"))
    least = {r["node"]: r["root"] for r in embedding_dedup.components(links).collect()}
    groups = {}
    for k, _, c, _ in brute([(k, v.tolist()) for k, v in rows]):
        groups.setdefault(c, set()).add(int(k))
    mine = {}
    for k, _ in rows:
        mine.setdefault(least.get(k, k), set()).add(k)
    together = [g | next((h for h in groups.values() if 30 in h), set()) if 0 in g else g for g in groups.values()]
    together = [g for g in together if not (30 in g and 0 not in g)]
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, together))

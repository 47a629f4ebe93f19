import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from mixlab.llm.substring_dedup import Sketch, cells, merge_parts, remove_repeats, windows
from mixlab.llm.text import Words, string_buffers


def brute(rows, width):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    key = [(k is None, k or 0) for k, _ in rows]
    first = {}
    for k, w in zip(key, split):
        for i in range(len(w) - width + 1):
            at = tuple(w[i : i + width])
            first[at] = min(first.get(at, k), k)
    out = []
    for (doc, _), k, w in zip(rows, key, split):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < k:
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(doc), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got(df):
    rows = df.collect()
    assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in rows)
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows)


def test_odd_rows(documents):
    long = " ".join(f"é{i}" for i in range(400))
    rows = [
        (5, long), (2, None), (3, ""), (4, " \n\t"), (6, long.replace(" ", " \n ")), (6, long), (7, "w " * 3000), (8, "w " * 49), (9, "w " * 70),
        (None, long), (10, "x " + long + " y"), (11, long[:300] + " z " + long[300:]), (1, "short text"), (12, "a\x1cb c " * 60),
    ]
    assert got(remove_repeats(documents(rows))) == brute(rows, 50)
    assert got(remove_repeats(documents([]))) == []


@pytest.mark.parametrize("hot_runs,cells_used", [(1000, 1 << 18), (3, 1 << 15)])
def test_shared_passages(documents, hot_runs, cells_used):
    draw = random.Random(1)
    text = lambda n: [f"w{draw.randrange(300)}" for _ in range(n)]
    passages = [text(draw.choice([10, 12, 15, 40])) for _ in range(12)]
    rows = []
    for i in range(150):
        words = text(draw.randrange(30))
        for _ in range(draw.randrange(4)):
            words += draw.choice(passages) + text(draw.randrange(12))
        rows.append((i, " ".join(words)))
    draw.shuffle(rows)
    assert got(remove_repeats(documents(rows), width=10, gram=3, size=cells_used, hot_runs=hot_runs)) == brute(rows, 10)


def test_corpus(corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert got(remove_repeats(corpus)) == brute(rows, 50)


def test_sketch_never_underestimates():
    draw = np.random.default_rng(2)
    lots = [draw.integers(0, 3000, 2000).astype(np.uint64) for _ in range(4)]
    parts = []
    for lot in lots:
        sketch = Sketch(2, 1 << 16)
        sketch.add(lot[:1000])
        sketch.add(lot[1000:])
        i, one, two = zip(*sketch.parts())
        parts.append(pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(one), pa.array(two)], names=["part", "one", "two"]))
    import zlib

    two = np.zeros((4, (1 << 15) // 8), np.uint8)
    for b in merge_parts(iter(parts)):
        two[b.column(0)[0].as_py()] = np.frombuffer(zlib.decompress(b.column(2)[0].as_py()), np.uint8)
    two = two.reshape(2, -1)
    values, times = np.unique(np.concatenate(lots), return_counts=True)
    for row in range(2):
        spots = cells(values, row, 1 << 16)
        again = two[row][spots >> 3] >> (spots & 7) & 1
        assert again[times > 1].all()


def test_equal_windows_have_equal_anchors():
    words = Words(*string_buffers(pa.array(["a b c d e f g h", "x b c d e f y", None, "b c"])))
    first, hashes, anchors = windows(words, 5, 2)
    assert len(first) == 4 + 3
    assert hashes[1] == hashes[5] and anchors[1] == anchors[5]
    assert len(set(hashes.tolist())) == 6


def test_ranges_stay_with_their_text(documents):
    """Rows without an id, or with the same one, whose other texts repeat nothing."""
    shared, own = " ".join(f"s{i}" for i in range(80)), lambda c: " ".join(f"{c}{i}" for i in range(90))
    rows = [(1, shared), (None, shared + " a"), (None, own("b")), (None, own("c")), (5, "x " + shared), (5, own("d")), (5, "x " + shared)]
    assert got(remove_repeats(documents(rows))) == brute(rows, 50)

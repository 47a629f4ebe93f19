import random
import re
from fractions import Fraction

import pytest

from mixlab.llm.ngram_join import LEAST_SKETCH, Rule, _least_keys, _open_pairs, allocate, drop_near_copies, ngram_components

ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\ttwo"), (6, "one two three"), (7, "a b c d"), (8, "A  b C d"),
    (8, "A  b C d"), (9, "b c d a"), (10, "w " * 5000), (11, "w w w w w"), (None, "a b c d"), (12, "ÄB c d e"), (13, "äb c d e"),
]


def sets(text, n):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, rule):
    made = [sets(t, rule.n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    p, q = rule.threshold.numerator, rule.threshold.denominator
    for i in range(len(rows)):
        for j in range(i):
            a, b = made[i], made[j]
            if a and b and min(len(a), len(b)) * q >= p * max(len(a), len(b)):
                common = len(a & b)
                if common * q >= p * (len(a) + len(b) - common):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = root(i)
        if k is not None:
            least[r] = min(least.get(r, k), k)
    return sorted((str(k), len(made[i]), str(least.get(root(i)))) for i, (k, _) in enumerate(rows))


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def test_odd_rows(documents):
    assert got(ngram_components(documents(ODD))) == brute(ODD, Rule())
    assert got(ngram_components(documents([]))) == []


@pytest.mark.parametrize("rule", [Rule(), Rule(5, Fraction(8, 10)), Rule(1, Fraction(6, 10))])
def test_against_all_pairs(documents, rule):
    draw = random.Random(3)
    rows, number = [], 0
    for size in [3, 7, 8, 9, 12, 20, 33, 60, 140, 400] * 3:
        base = [f"w{draw.randrange(5000)}" for _ in range(size)]
        for _ in range(7):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, size // 30])):
                at = draw.randrange(len(copy))
                copy[at : at + draw.choice([0, 1])] = [f"x{draw.randrange(9)}"] * draw.choice([0, 1])
            rows.append((number, " ".join(copy)))
            number += 1
    draw.shuffle(rows)
    assert got(ngram_components(documents(rows), rule)) == brute(rows, rule)


def test_near_copy_cluster_with_shared_passage(documents):
    """A star whose leaves are too far from each other, and many texts around one passage."""
    draw = random.Random(5)
    word = lambda: f"w{draw.randrange(10**6)}"
    center, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    rows = [(500, " ".join(center))]
    for i in range(40):
        copy = list(center)
        for at in draw.sample(range(0, 120, 6), 2):
            copy[at] = word()
        rows.append((i, " ".join(copy)))
        rows.append((100 + i, " ".join(passage + [word() for _ in range(draw.choice([3, 5, 9, 40]))])))
    assert got(ngram_components(documents(rows))) == brute(rows, Rule())


def test_corpus(corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    assert got(ngram_components(corpus)) == brute(rows, Rule())
    rule = Rule(5, Fraction(8, 10))
    kept = {k for k, _, c in brute(rows, rule) if k == c}
    left = drop_near_copies(corpus)
    assert left.columns == corpus.columns
    assert {str(r["doc_id"]) for r in left.collect()} == kept


def test_allowances_cover_the_bound():
    rule = Rule()
    edges = rule.bands(5000)
    for many in (10, 10**5, 10**8):
        schemes = allocate(rule, edges, {g: (many, float(edges[g])) for g in range(len(edges) - 1)})
        for g, s in schemes.items():
            worst = max(int(rule.most_apart(a + b)) for a in range(max(edges[g], edges[g + 1] - 40), edges[g + 1]) for b in range(a, int(a / rule.threshold) + 1))
            assert 2 * s.twos + s.ones >= worst + 1 + s.slack
    few, many = (allocate(rule, edges, {30: (n, 300.0)}) for n in (10, 10**9))
    assert sum(s.twos for s in few.values()) < sum(s.twos for s in many.values())


@pytest.mark.parametrize("part,largest", [(85, 118), (85, 50), (80, 113)])
def test_largest_sets_have_a_scheme(documents, part, largest):
    """Pairs at the exact limit, both in the band of the largest sets."""
    rule = Rule(1, Fraction(part, 100))
    edges = rule.bands(largest)
    band = max(g for g, first in enumerate(edges) if first <= largest)
    scheme = allocate(rule, edges, {band: (10, float(largest))})[band]
    apart = int(rule.most_apart(2 * largest))
    assert 2 * scheme.twos + scheme.ones >= apart + 1 + scheme.slack
    rows = []
    for i in range(40):
        words = [f"w{i}x{k}" for k in range(largest + apart // 2)]
        rows += [(2 * i, " ".join(words[:largest])), (2 * i + 1, " ".join(words[apart // 2 :]))]
    assert got(ngram_components(documents(rows), rule)) == brute(rows, rule)
    assert len({c for _, _, c in brute(rows, rule)}) == 40


def test_near_copies_go_by_id_and_set(documents):
    near = " ".join(f"a{i}" for i in range(60))
    other, lone, pair, clean = (" ".join(f"{c}{i}" for i in range(60)) for c in "bcde")
    rows = [
        (1, near), (None, near + " z"), (None, other), (None, lone), (2, near + " y"), (2, clean),
        (None, pair), (None, pair + " x"), (None, pair), (None, pair.upper()), (None, None), (None, ""),
    ]
    left = sorted((str(r["doc_id"]), r["text"] or "") for r in drop_near_copies(documents(rows)).collect())
    rest = [x for x in left if not x[1].lower().startswith("d0 ")]
    assert rest == sorted((str(k), t or "") for k, t in [(1, near), (None, other), (None, lone), (2, clean), (None, None), (None, "")])
    assert len(left) == len(rest) + 1


def test_pairs_are_left_to_the_least_key_they_share(spark):
    """30 sets in 60 keys make each pair once; sets that share one key, far up in their lists, make theirs there."""
    rows = [(k, i) for k in range(60) for i in range(30)] + [(100 + i, 100 + i // 60) for i in range(120)] + [(500, 100), (500, 101)]
    held = spark.createDataFrame(rows, "key long, node long")
    rest = held.join(_least_keys(held), "node").selectExpr(
        "key", "count(*) over (partition by key) as size", "node", "node as rep", "node as root", "100L as n",
        f"cast(repeat('a', {LEAST_SKETCH // 8}) as binary) as sketch", "least",
    )
    made = [(r["a"], r["b"]) for r in _open_pairs(rest, Rule()).collect()]
    assert sorted(made) == sorted([(i, j) for i in range(30) for j in range(i + 1, 30)] + [(100, 101)])

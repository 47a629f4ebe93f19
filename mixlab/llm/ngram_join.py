"""Exact Jaccard self-join of word n-gram sets by universe partitioning and the pigeonhole principle.

Two sets that reach the threshold differ in at most H elements, where H follows from
their sizes. The universe of hashed n-grams is parted into m segments; if the segments'
allowances b (0, 1 or 2) sum to more than H, one segment differs in fewer than b
elements: it is equal (b >= 1) or one element apart (b = 2). So the subsets of the
segments are indexed, for b = 2 with their one-deletion neighbourhoods, and only sets
that meet in an index entry are compared.

Sizes fall into bands as wide as the threshold allows, so a set can only match its own
and the two adjacent bands. Entries exist per scheme: scheme g serves pairs within band g
and between g and g + 1, with m and the allowances chosen for it from the corpus's own
counts per band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.llm import bitmaps
from mixlab.llm.components import components
from mixlab.llm.text import Words, chunks, give_back, mix, rolling, signed, string_buffers
from mixlab.session import stage

LEAST_SKETCH = 256
# Stands for a null id while sets are compared.
NO_ID = (1 << 63) - 1
BLOCK = 2000
# Least keys that a set carries while pairs are compared, and what fills shorter lists up; keys are below it.
LEAST_KEYS = 16
NO_KEY = (1 << 63) - 1
_CELLS = 1 << 20
# The allocation's model: a comparison's cost in index entries, and the share of pairs taken to have half their content in common.
COMPARE_COST = 0.2
SHARED_PAIRS = 1e-3
SHARED_PART = 0.5


@dataclass(frozen=True)
class Rule:
    """Words per n-gram and the threshold as a fraction."""

    n: int = 4
    threshold: Fraction = Fraction(85, 100)

    def least_common(self, total: np.ndarray | int):
        """The least intersection that reaches the threshold, given the sum of both sizes."""
        p, q = self.threshold.numerator, self.threshold.denominator
        return -(-p * total // (p + q))

    def most_apart(self, total: np.ndarray | int):
        """H: the most elements that may be in only one of the sets."""
        return total - 2 * self.least_common(total)

    def bands(self, largest: int) -> list[int]:
        """First size of each band, up to one above ``largest``; each reaches to its first size over the threshold."""
        edges = [1]
        while edges[-1] <= largest + 1:
            edges.append(int(edges[-1] / self.threshold) + 1)
        return edges


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each document, and their offsets. With fewer than n words: one for all of them."""
    hashes, counts = words.hashes(), words.counts()
    # Every position's n-gram; those that would run over the end of a document are left out.
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    first = np.repeat(words.first[:-1] - offsets[:-1], sizes) + np.arange(offsets[-1])
    spans = np.repeat(np.minimum(counts, n), sizes)
    grams = mix(rolling(hashes, first, first + spans) + spans.astype(np.uint64)) if len(first) else np.zeros(0, np.uint64)
    for low, high in zip(offsets[:-1], offsets[1:]):
        grams[low:high].sort()
    keep = np.ones(len(grams), bool)
    keep[1:] = grams[1:] != grams[:-1]
    keep[offsets[:-1][sizes > 0]] = True
    kept = np.zeros(len(grams) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return grams[keep], kept[offsets]


def fingerprints(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One hash per set, of its size and elements."""
    sums = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) ^ np.diff(offsets).astype(np.uint64))


def sketches(grams: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Parity sketches: every bit in which two sketches differ is an element that only one of the sets has.

    A sketch has at least four bits per element, a power of two; the larger of two is
    folded onto the smaller.
    """
    out = []
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        bits = max(LEAST_SKETCH, 1 << (4 * (high - low) - 1).bit_length()) if high > low else LEAST_SKETCH
        odd = np.bincount((grams[low:high] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8)).tobytes())
    return out


@dataclass(frozen=True)
class Scheme:
    """m segments; the first ``twos`` have allowance 2, the next ``ones`` 1.

    The allowances sum to H + 1 + ``slack``. A set whose empty segments have allowances of
    no more than half the slack leaves their entries out: what two sets can lose that way
    is never all that makes them meet, and empty segments, in which unrelated sets meet
    by chance, are not compared.
    """

    twos: int
    ones: int
    slack: int = 0


def allocate(rule: Rule, edges: list[int], counts: dict[int, tuple[int, float]]) -> dict[int, Scheme]:
    """The cheapest allowances of every scheme, from the number of sets and their mean size per band.

    A segment of allowance 1 costs one entry per set, one of allowance 2 its size more; a
    larger segment is met by chance less often. Two sets meet by chance where both miss
    the segment (or all but one element); for a few pairs, which share a part of their
    content, it is enough that the rest misses it.
    """
    period = rule.threshold.numerator + rule.threshold.denominator
    schemes = {}
    for g in range(len(edges) - 1):
        most = edges[g + 1] - 1
        total = most + int(most / rule.threshold)
        apart = int(rule.most_apart(np.arange(max(2 * edges[g], total - 2 * period), total + 1)).max())
        sets = [counts[b] for b in (g, g + 1) if b in counts]
        number = sum(c for c, _ in sets)
        if not apart or not number:
            continue
        size = sum(c * s for c, s in sets) / number
        best = None
        for twos in sorted({(apart + 1) * k // 32 for k in range(16)} | {apart // 2 + 1}):
            slack = 0
            for _ in range(2 if apart >= 20 else 0):
                m = max(1, twos + apart + 1 + slack - 2 * twos)
                empty = m * np.exp(-0.9 * size / m)
                slack = 2 * int(np.ceil(empty + 3 * np.sqrt(empty) + 1))
            ones = max(0, apart + 1 + slack - 2 * twos)
            inside = size / (twos + ones)
            cost = number * (ones + twos * (1 + inside))
            everyone = () if slack else ((1.0, inside),)
            for part, left in (*everyone, (SHARED_PAIRS, inside * (1 - SHARED_PART))):
                meet = np.exp(-2 * left)
                cost += COMPARE_COST * part * number * number / 2 * meet * (ones + twos * (1 + 2 * left))
            if best is None or cost < best[0]:
                best = (cost, Scheme(twos, ones, slack))
        schemes[g] = best[1]
    return schemes


def entries(grams: np.ndarray, offsets: np.ndarray, sets: np.ndarray, scheme_id: np.ndarray, schemes: dict[int, Scheme]) -> tuple[np.ndarray, np.ndarray]:
    """Index entries (key, position in ``sets``) of the given sets under one scheme each.

    Segments are equal ranges of the hash values, so the elements of one stand together.
    The key's last bit is 0 for a whole subset and 1 for one with an element deleted:
    entries of a key meet only if one of them is whole.
    """
    sizes = np.diff(offsets)[sets]
    twos = np.array([schemes[s].twos for s in scheme_id], np.int64)
    m = twos + np.array([schemes[s].ones for s in scheme_id], np.int64)
    start = np.zeros(len(sets) + 1, np.int64)
    np.cumsum(sizes, out=start[1:])
    el = grams[np.repeat(offsets[sets] - start[:-1], sizes) + np.arange(start[-1])]
    base = np.zeros(len(sets) + 1, np.int64)
    np.cumsum(m, out=base[1:])
    segment = ((el >> np.uint64(32)) * np.repeat(m, sizes).astype(np.uint64) >> np.uint64(32)).astype(np.int64) + np.repeat(base[:-1], sizes)
    values = mix(el ^ np.uint64(0x2545F4914F6CDD1D))
    sums = np.zeros(len(el) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    cuts = np.searchsorted(segment, np.arange(base[-1] + 1))
    subset = sums[cuts[1:]] - sums[cuts[:-1]]
    owner = np.repeat(np.arange(len(sets)), m)
    inside = np.arange(base[-1]) - base[:-1][owner]
    salt = mix((scheme_id[owner].astype(np.uint64) << np.uint64(40)) + inside.astype(np.uint64) + np.uint64(1))
    whole = mix(subset ^ salt) & ~np.uint64(1)
    bare = cuts[1:] == cuts[:-1]
    weight = np.where(inside < twos[owner], 2, 1) * bare
    slack = np.array([schemes[s].slack for s in scheme_id], np.int64)
    stays = ~bare | (2 * np.bincount(owner, weight, len(sets)) > slack)[owner]
    double = np.flatnonzero(inside < twos[owner])
    counts = np.diff(cuts)[double]
    at = np.repeat(double, counts)
    from_el = np.repeat(cuts[double] - np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64), counts) + np.arange(len(at)) if len(at) else np.zeros(0, np.int64)
    deleted = mix((subset[at] - values[from_el]) ^ salt[at]) | np.uint64(1)
    return np.concatenate([whole[stays], deleted]), np.concatenate([owner[stays], owner[at]])


def _sets(batches: Iterator[pa.RecordBatch], n: int):
    give_back()
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            grams, cuts = ngrams(Words(data, offsets, lower=True), n)
            yield part, grams, cuts, fingerprints(grams, cuts)
    give_back()


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From entries in the order of keys: (key, center, node) of every node that meets another one.

    The center is the first whole entry of the key. Keys without a whole entry and keys
    with one node only are dropped; a run of any length is passed through batch by batch.
    """
    names = ["key", "center", "node"]

    def out(keys, centers, nodes):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(centers), pa.array(nodes)], names=names)

    last, center, waiting = None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keys = raw >> 1
        starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
        run = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(keys)]])))
        whole = (raw[starts] & 1) == 0
        lead = nodes[starts].copy()
        carried = last is not None and keys[0] == last
        if carried:
            whole[0], lead[0] = center is not None, center if center is not None else 0
        other = whole[run] & (nodes != lead[run])
        meets = np.zeros(len(starts), bool)
        meets[run[other]] = True
        own = starts[meets & whole]
        if carried and meets[0]:
            own = own[own != 0]
            if waiting:
                yield out(np.array([last]), np.array([center]), np.array([center]))
                waiting = False
        if len(own):
            yield out(keys[own], nodes[own], nodes[own])
        if other.any():
            yield out(keys[other], lead[run[other]], nodes[other])
        if not (carried and len(starts) == 1):
            last, center = keys[-1], int(lead[-1]) if whole[-1] else None
            waiting = bool(whole[-1]) and not meets[-1]


def _folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches of ``size`` bytes or more, folded to that size, as rows of 64-bit words."""
    out = np.empty((len(sketches), size // 8), np.uint64)
    lengths = np.fromiter(map(len, sketches), np.int64, len(sketches))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        words = np.frombuffer(b"".join([sketches[i] for i in rows]), np.uint64).reshape(len(rows), -1, size // 8)
        out[rows] = np.bitwise_xor.reduce(words, axis=1)
    return out


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which the rows differ; never more than the sets do."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def similar_sets(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(one row per document: id, n, node), (node, root) of all sets that are linked with another set."""
    n = rule.n
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))

    def describe(batches):
        for part, grams, cuts, prints in _sets(batches, n):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(cuts)), pa.array(signed(prints)), pa.array(sketches(grams, cuts), pa.binary())],
                names=["id", "n", "node", "sketch"],
            )

    found = stage(source.mapInArrow(describe, "id long, n long, node long, sketch binary"), "sets")

    # Sets per band: one row per band, and there are as many bands as the logarithm of the largest size.
    largest = found.agg(F.max("n")).first()[0] or 0
    edges = rule.bands(largest)
    sized = found.where("n > 0").groupBy("n").agg(F.approx_count_distinct("node").alias("sets"))
    number = F.lit(0)
    for first in edges[1:]:
        number = number + (F.col("n") >= first).cast("int")
    per_band = sized.groupBy(number.alias("band")).agg(F.sum("sets").alias("sets"), (F.sum(F.col("sets") * F.col("n")) / F.sum("sets")).alias("size"))
    counts = {r["band"]: (r["sets"], r["size"]) for r in per_band.collect()}
    schemes = allocate(rule, edges, counts)
    limits = np.array(edges[1:], np.int64)

    def index(batches):
        done = np.zeros(0, np.uint64)
        for _, grams, cuts, prints in _sets(batches, n):
            # Copies of a set within this task are indexed once; eight bytes remember a set.
            _, one = np.unique(prints, return_index=True)
            one = one[(np.diff(cuts)[one] > 0) & ~np.isin(prints[one], done)]
            done = np.union1d(done, prints[one])
            own = np.searchsorted(limits, np.diff(cuts)[one], "right")
            sets, scheme = np.concatenate([one, one]), np.concatenate([own, own - 1])
            used = np.isin(scheme, list(schemes))
            if used.any():
                keys, owner = entries(grams, cuts, sets[used], scheme[used], schemes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(keys)), pa.array(signed(prints)[sets[used][owner]])], names=["key", "node"]
                )

    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = source.select("text").mapInArrow(index, "key long, node long")
    sorted_rows = rows.repartition(width, F.shiftright("key", 1)).sortWithinPartitions("key")
    met = stage(sorted_rows.mapInArrow(_meetings, "key long, center long, node long"), "meetings")

    facts = found.groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    involved = met.select("node").distinct()
    facts = stage(facts.join(involved, "node"), "facts")
    links = _verified(_sifted(met.where("center <> node").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct(), facts, rule), source, rule)
    roots = components(links)

    # Sets that met in a key but are in different components so far: compare them all, in
    # blocks, by sketch, and those that may be similar exactly.
    named = met.select("key", "node").distinct().join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_keys = named.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
    open_keys = open_keys.where("low <> high and size > 2").select("key", "size")
    held = stage(named.join(open_keys, "key").select("key", "size", "node", "root"), "open")
    rest = held.join(facts, "node").join(_least_keys(held), "node").select("key", "size", "node", "rep", "root", "n", "sketch", "least")
    more = _verified(_open_pairs(rest, rule).distinct(), source, rule)
    more = stage(more, "links")
    if more.take(1):
        roots = components(links.unionByName(more))
    return found.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "n", "node"), roots


def _sifted(pairs: DataFrame, facts: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the threshold."""
    p, q = rule.threshold.numerator, rule.threshold.denominator
    left = facts.select(F.col("node").alias("a"), F.col("rep").alias("ra"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = facts.select(F.col("node").alias("b"), F.col("rep").alias("rb"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def sift(batches):
        for batch in batches:
            if batch.num_rows:
                total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
                left, right = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
                sizes = np.array([min(len(x), len(y)) for x, y in zip(left, right)])
                near = np.zeros(len(sizes), bool)
                for size in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == size)
                    apart = _apart(_folded([left[i] for i in rows], size), _folded([right[i] for i in rows], size))
                    near[rows] = apart <= rule.most_apart(total[rows])
                yield batch.filter(pa.array(near)).select(["a", "b", "ra", "rb"])
        give_back()

    joined = pairs.join(left, "a").join(right, "b")
    joined = joined.where((F.col("na") * q >= F.col("nb") * p) & (F.col("nb") * q >= F.col("na") * p))
    return joined.select("a", "b", "ra", "rb", "na", "nb", "sa", "sb").mapInArrow(sift, "a long, b long, ra long, rb long")


def _least_keys(held: DataFrame) -> DataFrame:
    """(node, least): the ``LEAST_KEYS`` least of a node's keys, ascending, filled up with ``NO_KEY``.

    A node has no more keys than index entries, so a list grows with one set only.
    """
    least = F.slice(F.sort_array(F.collect_list("key")), 1, LEAST_KEYS)
    filled = F.slice(F.concat(least, F.array_repeat(F.lit(NO_KEY), LEAST_KEYS)), 1, LEAST_KEYS)
    return held.groupBy("node").agg(filled.alias("least"))


def _met_before(key: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the rows' least keys have one in common that is less than ``key``."""
    out = np.zeros(len(left), bool)
    step = max(1, _CELLS // LEAST_KEYS**2)
    for low in range(0, len(left), step):
        own = slice(low, low + step)
        x, y = left[own, :, None], right[own, None, :]
        out[own] = ((x == y) & (x < key)).any(axis=(1, 2))
    return out


def _open_pairs(rest: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of different components within each key of ``rest`` that sketches allow.

    A key's nodes are dealt into blocks of about ``BLOCK``; every pair of blocks is a
    group of its own, so no task holds a whole key. Only pairs that pass are emitted. Near copies
    share most of their keys: a key leaves a pair to a lesser one that it finds among the least
    keys of both. The least key of all that a pair shares always emits it; where that is not among
    them, others do too, so pairs may still repeat.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = rest.withColumn("_own", own).withColumn(
        "_pair", F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.struct(F.least(i, F.col("_own")).alias("i"), F.greatest(i, F.col("_own")).alias("j"))))
    )

    def compare(table: pa.Table) -> pa.Table:
        node, rep, root, size = (table.column(c).to_numpy() for c in ("node", "rep", "root", "n"))
        block = table.column("_own").to_numpy()
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        key = table.column("key")[0].as_py()
        least = table.column("least").combine_chunks().flatten().to_numpy().reshape(-1, LEAST_KEYS)
        raw = table.column("sketch").to_pylist()
        # Sizes that meet in a key differ little: all are compared at the length of the shortest sketch.
        sketch = _folded(raw, min(map(len, raw)))
        step = max(1, _CELLS // (len(raw) * sketch.shape[1]))
        found = []
        for low in range(0, len(raw), step):
            own = slice(low, low + step)
            total = size[own, None] + size[None, :]
            open_ = (root[own, None] != root[None, :]) & (np.arange(len(raw))[own, None] < np.arange(len(raw))[None, :])
            open_ &= rule.least_common(total) <= np.minimum(size[own, None], size[None, :])
            if not same:
                open_ &= block[own, None] != block[None, :]
            if open_.any():
                apart = np.bitwise_count(sketch[own, None, :] ^ sketch[None, :, :]).sum(axis=2, dtype=np.int64)
                x, y = np.nonzero(open_ & (apart <= rule.most_apart(total)))
                x += low
                new = ~_met_before(key, least[x], least[y])
                found += zip(x[new].tolist(), y[new].tolist())
        found = [(x, y) if node[x] < node[y] else (y, x) for x, y in found]
        x, y = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": node[x], "b": node[y], "ra": rep[x], "rb": rep[y]})

    pairs = dealt.select("key", F.col("_pair.i").alias("i"), F.col("_pair.j").alias("j"), "_own", "node", "rep", "root", "n", "sketch", "least")
    return pairs.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long, ra long, rb long")


def _verified(pairs: DataFrame, source: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b, their representatives' ids ra, rb) that reach the threshold, by merging the whole sets.

    Only representatives of the pairs' nodes are read out, found by a bitmap of fixed size
    and then by the join; what moves is their compressed text, which is smaller than the set.
    """
    pairs = stage(pairs, "pairs")
    if not pairs.take(1):
        return pairs.select("a", "b")
    wanted = pairs.select(F.explode(F.array(F.struct("a", "ra"), F.struct(F.col("b").alias("a"), F.col("rb").alias("ra")))).alias("w")).select("w.*").distinct()
    packed = source.sparkSession.sparkContext.broadcast(bitmaps.to_array(bitmaps.bitmap(wanted, F.col("a").bitwiseXOR(F.col("ra")))))
    n = rule.n

    def read(batches):
        coder = zstandard.ZstdCompressor(level=1)
        for part, grams, cuts, prints in _sets(batches, n):
            nodes = signed(prints)
            one = np.flatnonzero(bitmaps.contains(packed.value, nodes ^ part.column(0).to_numpy()))
            texts = part.column(1).take(pa.array(one))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[one]), part.column(0).take(pa.array(one)), pa.array([coder.compress(t.as_buffer() if t.is_valid else b"") for t in texts], pa.binary())],
                names=["node", "rep", "content"],
            )

    content = source.mapInArrow(read, "node long, rep long, content binary")

    def merge(batches):
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for low in range(0, batch.num_rows, 64):
                part = batch.slice(low, 64)
                texts: dict[int, bytes] = {}
                ends = [part.column(i).to_pylist() for i in (0, 1)]
                for nodes, column in zip(ends, (part.column(2), part.column(3))):
                    for node, packed_text in zip(nodes, column):
                        if node not in texts:
                            texts[node] = coder.decompress(packed_text.as_buffer())
                place = {node: i for i, node in enumerate(texts)}
                grams, cuts = ngrams(Words(*string_buffers(pa.array(list(texts.values()), pa.large_binary()).view(pa.large_string())), lower=True), n)
                for i, (x, y) in enumerate(zip(*ends)):
                    x, y = (grams[cuts[place[v]] : cuts[place[v] + 1]] for v in (x, y))
                    both = np.concatenate([x, y])
                    both.sort()
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep[low + i] = common >= rule.least_common(len(both))
            yield batch.filter(pa.array(keep)).select(["a", "b"])
        give_back()

    left = content.select(F.col("node").alias("a"), F.col("rep").alias("ra"), F.col("content").alias("ca"))
    right = content.select(F.col("node").alias("b"), F.col("rep").alias("rb"), F.col("content").alias("cb"))
    joined = pairs.join(left, ["a", "ra"]).join(right, ["b", "rb"]).select("a", "b", "ca", "cb")
    return stage(joined.mapInArrow(merge, "a long, b long").distinct(), "verified")


def _members(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows (id, n, node, component_id, first) whose sets are not empty, and those (id, n) of empty sets; first is the least node of the component's least id."""
    found, roots = similar_sets(docs, rule, id_col, text_col)
    filled = found.where("n > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "node")).alias("best")
    least = stage(filled.groupBy("root").agg(best).select("root", F.col("best.id").alias("component_id"), F.col("best.node").alias("first")), "least")
    return filled.join(least, "root"), found.where("n = 0")


def ngram_components(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (the least id reachable by links, its own included).

    Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``, A-Z in lower case. Documents with
    fewer words than an n-gram are one n-gram; null texts and texts without words have an
    empty set, are linked with nothing and keep their own id. Rows with equal sets are one
    node and always in one component. A null id takes part, and is the least id only where
    no other is there (component_id is then null). Repeated rows repeat the result. An
    empty table gives an empty result.
    """
    filled, empty = _members(docs, rule, id_col, text_col)
    empty = empty.withColumn("component_id", F.col("id"))
    both = filled.select("id", "n", "component_id").unionByName(empty.select("id", "n", "component_id"))
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, rule: Rule = Rule(5, Fraction(8, 10)), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the least id, a null one last, and then the least set, with all its columns.

    Rows go by id and set, so other texts of the same id, or without an id, stay if they are
    like nothing else. Of rows that repeat both the id and the set that stay, one stays, with the least text.
    Rows with an empty set (null texts, texts without words) stay. Extra columns stay, whatever they are called.
    """
    filled, _ = _members(docs, rule, id_col, text_col)
    first = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("node") == F.col("first"))
    gone = filled.where(~first)
    gone = gone.select(F.col("id").alias("__gone"), F.col("node").alias("__node"), F.lit(False).alias("__one")).distinct()
    several = filled.where(first).groupBy("id", "node").count().where("count > 1")
    gone = stage(gone.unionByName(several.select(F.col("id").alias("__gone"), F.col("node").alias("__node"), F.lit(True).alias("__one"))), "gone")

    def nodes(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], names=["text"])
            parts = [signed(prints) for *_, prints in _sets([batch], rule.n)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    number = F.col(id_col).cast("long")
    marked = bitmaps.mark(docs, F.xxhash64(number), bitmaps.bitmap(gone, F.xxhash64("__gone")), "__maybe")
    unsure = marked.where("__maybe").select(*[docs[c] for c in docs.columns]).withColumn("__own", F.pandas_udf(nodes, "long")(F.col(text_col)))
    same = number.eqNullSafe(F.col("__gone")) & (F.col("__own") == F.col("__node"))
    stay = marked.where(~F.col("__maybe")).select(*[docs[c] for c in docs.columns])
    stay = stay.unionAll(unsure.join(gone, same, "left_anti").select(*[unsure[c] for c in docs.columns]))
    if gone.where("__one").take(1):
        copies = unsure.join(gone.where("__one"), same, "left_semi")
        one = copies.groupBy("__own").agg(F.min_by(F.struct(*[copies[c] for c in docs.columns]), F.col(text_col)).alias("__row"))
        stay = stay.unionAll(one.select("__row.*"))
    return stay

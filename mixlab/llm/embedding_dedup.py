"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlab.llm.components import components
from mixlab.session import stage

THRESHOLD = 0.95
# Passes of a round and the neighbours of the first; each further round doubles the neighbours, until the recall is reached.
PASSES = 20
WINDOW = 24
RECALL = 0.98
# Queries that measure the recall: the first number, the number up to which more are drawn while they have
# fewer neighbours than LEAST_FOUND, and the bound of their vectors in bytes.
QUERIES, MOST_QUERIES, LEAST_FOUND = 1024, 16384, 200
QUERY_BYTES = 16 << 20
_CELLS = 1 << 20
BITS = 62
BLOCK = 2000
ROWS_PER_PREFIX = 4096
# Bytes of the vectors on one side of a comparison in which nothing is parted.
BLOCK_BYTES = 8 << 20


def _planes(number: int, dim: int, seed: int) -> np.ndarray:
    """The random hyperplanes of one pass; the same in every task."""
    return np.random.default_rng([seed, number, dim]).standard_normal((dim, BITS))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of packed doubles of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _linked(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows reach the threshold; both sides have length 1."""
    return np.einsum("ij,ij->i", left, right) >= threshold


def _joined_up(pairs: tuple[np.ndarray, np.ndarray], count: int) -> np.ndarray:
    """For each of ``count`` places the least place it is linked with, over any number of links."""
    label = np.arange(count)
    a, b = pairs
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def neighbour_links(batches: Iterator[pa.RecordBatch], window: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """From rows (group, dim, node, unit) in sorted order: links (a, b) that join up all pairs
    of one group that are at most ``window`` places apart and reach the threshold."""
    held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups, dims, nodes = (batch.column(i).to_numpy() for i in range(3))
        found_a, found_b = [], []
        cuts = np.concatenate([[0], np.flatnonzero((groups[1:] != groups[:-1]) | (dims[1:] != dims[:-1])) + 1, [len(groups)]])
        for low, high in zip(cuts[:-1], cuts[1:]):
            units, own = _matrix(batch.column(3).slice(low, high - low)), nodes[low:high]
            key = np.array([groups[low], dims[low]])
            if held is not None and (held[0] == key).all():
                units, own = np.concatenate([held[2], units]), np.concatenate([held[1], own])
            a, b = [], []
            for d in range(1, min(window, len(own) - 1) + 1):
                at = np.flatnonzero(_linked(units[:-d], units[d:], threshold))
                a.append(at)
                b.append(at + d)
            if a:
                pairs = np.concatenate(a), np.concatenate(b)
                label = _joined_up(pairs, len(own))
                moved = np.flatnonzero(label != np.arange(len(own)))
                found_a.append(own[label[moved]])
                found_b.append(own[moved])
            held = (key, own[-window:], units[-window:])
        if found_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], names=["a", "b"])


def _means(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Mean of the unit vectors of each dimension; a task sends one sum per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                units = _matrix(batch.filter(pa.array(dims == dim)).column(1))
                total = sums.setdefault(dim, [0, np.zeros(dim)])
                total[0] += len(units)
                total[1] += units.sum(axis=0)
        for dim, (count, total) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([count], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["dim", "rows", "total"])

    counts: dict[int, int] = {}
    totals: dict[int, np.ndarray] = {}
    for r in nodes.select("dim", "unit").mapInArrow(add, "dim int, rows long, total binary").toLocalIterator():
        counts[r["dim"]] = counts.get(r["dim"], 0) + r["rows"]
        totals[r["dim"]] = totals.get(r["dim"], 0) + np.frombuffer(r["total"], np.float64)
    return {dim: totals[dim] / counts[dim] for dim in totals}


def measured_recall(nodes: DataFrame, roots: DataFrame, threshold: float) -> float:
    """The share of neighbours of some nodes, compared with all nodes, that are in the component of theirs.

    The lesser of the share of all pairs and the mean share per node, so that neither large
    nor small groups hide what is lost. Nodes are the first by a hash; 1 if none has a neighbour.
    """
    widest = nodes.agg(F.max("dim")).first()[0] or 1
    most = max(1, min(MOST_QUERIES, QUERY_BYTES // (8 * widest)))
    number, members = min(QUERIES, most), nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    while True:
        drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(number).select("node", "dim", "unit")
        asked: dict[int, list] = {}
        for r in drawn.join(roots, "node", "left").orderBy("node").collect():
            asked.setdefault(r["dim"], []).append((r["node"], r["node"] if r["root"] is None else r["root"], r["unit"]))
        packed = {}
        for dim, rows in asked.items():
            own, root, units = zip(*rows)
            packed[dim] = np.array(own, np.int64), np.array(root, np.int64), np.frombuffer(b"".join(units), np.float64).reshape(len(rows), dim)
        shared = nodes.sparkSession.sparkContext.broadcast(packed)

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            true = {dim: np.zeros(len(q[0]), np.int64) for dim, q in shared.value.items()}
            found = {dim: np.zeros(len(q[0]), np.int64) for dim, q in shared.value.items()}
            for batch in batches:
                dims = batch.column(0).to_numpy()
                for dim in np.unique(dims).tolist():
                    if dim not in true:
                        continue
                    own, root, asked = shared.value[dim]
                    part = batch.filter(pa.array(dims == dim))
                    node, group, units = part.column(1).to_numpy(), part.column(2).to_numpy(), _matrix(part.column(3))
                    step = max(1, _CELLS // len(own))
                    for low in range(0, len(node), step):
                        cut = slice(low, low + step)
                        close = (units[cut] @ asked.T >= threshold) & (node[cut, None] != own[None, :])
                        true[dim] += close.sum(axis=0)
                        found[dim] += (close & (group[cut, None] == root[None, :])).sum(axis=0)
            for dim in true:
                hit = np.flatnonzero(true[dim])
                yield pa.RecordBatch.from_arrays([pa.array(shared.value[dim][0][hit]), pa.array(true[dim][hit]), pa.array(found[dim][hit])], names=["node", "true", "found"])

        rows = members.select("dim", "node", "root", "unit").mapInArrow(near, "node long, true long, found long")
        share = F.col("found") / F.col("true")
        total, pairs, each = rows.groupBy("node").agg(F.sum("true").alias("true"), F.sum("found").alias("found")).agg(F.sum("true"), F.sum("found") / F.sum("true"), F.avg(share)).first()
        if (total or 0) >= LEAST_FOUND or number >= most or sum(map(len, asked.values())) < number:
            return 1.0 if not total else min(pairs, each)
        number = min(most, 4 * number)


def vector_components(vectors: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    1. Equal vectors are one node that carries how many rows it stands for.
    2. In each pass a node gets a code, the signs of its projections on random directions
       one after another, seen from the mean of all nodes. Nodes are sorted by code and each is compared, in double
       precision, with its ``window`` successors. The leading bits of the code, so many
       that about 4,096 nodes share them (more if the window is larger), part the sort among tasks; a pair they part
       meets in other passes. A hot prefix is streamed, never gathered.
    3. Links of all passes are united to components. Some nodes are compared with all
       others; while less than ``recall`` of their neighbours are in their components,
       a further round of other passes runs with twice the window.
    4. Within its component each node's links are counted exactly, in pairs of blocks, so
       that windows do not cut short the count in large groups. Pairs are not emitted.

    Recall: it is measured, on 1,024 nodes or more (up to 16,384 while they have few
    neighbours); that sample may be off by a few in a hundred. When a further round would
    compare as many pairs as there are, all pairs are compared instead, in pairs of blocks
    that give back a forest over the components found so far.

    Null vectors, vectors without components, with null or non-finite components or of
    length zero, and rows with a null id have no links and are their own component.
    Vectors of different dimension are not compared. Rows that repeat a vector are linked
    with each other, also if they repeat the id. An empty table gives an empty result.
    """
    value = F.col(vector_col).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col(id_col).isNotNull() & F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(usable, value).alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    good = rows.where("v is not null")

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = [], []
            for v in batch.column(2):
                v = v.values.to_numpy()
                v = v / np.abs(v).max()
                units.append((v / math.sqrt(float(v @ v))).tobytes())
                dims.append(len(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], names=["node", "rows", "dim", "unit"])

    classes = good.groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    classes = stage(classes.withColumn("node", F.xxhash64("v")), "classes")
    nodes = stage(classes.select("node", "rows", "v").mapInArrow(unit, "node long, rows long, dim int, unit binary"), "nodes")
    number_of_nodes = nodes.count()
    means = _means(nodes)

    def project(batches: Iterator[pa.RecordBatch], begin: int, prefix: int) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                units = _matrix(part.column(2))
                centred = units - means[int(dim)]
                for number in range(begin, begin + passes):
                    code = (centred @ _planes(number, int(dim), seed) > 0) @ weights
                    group = (np.int64(number) << 40) | (code >> (BITS - prefix))
                    yield pa.RecordBatch.from_arrays([pa.array(group), part.column(1), pa.array(code), part.column(0), part.column(2)], names=["group", "dim", "code", "node", "unit"])

    width = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def linked(begin: int, window: int) -> DataFrame:
        """Links of the passes from ``begin`` on."""
        per_prefix = max(ROWS_PER_PREFIX, ROWS_PER_PREFIX // WINDOW * window)
        prefix = max(0, math.ceil(math.log2(max(1, number_of_nodes) / per_prefix)))
        coded = nodes.select("node", "dim", "unit").mapInArrow(lambda it: project(it, begin, prefix), "group long, dim int, code long, node long, unit binary")
        ordered = coded.repartition(width, "group", "dim").sortWithinPartitions("group", "dim", "code", "node")
        return stage(ordered.select("group", "dim", "node", "unit").mapInArrow(lambda it: neighbour_links(it, window, threshold), "a long, b long"), "links")

    links, begin = linked(0, window), passes
    roots = stage(components(links), "roots")
    complete = window >= number_of_nodes
    while not complete and measured_recall(nodes, roots, threshold) < recall:
        window *= 2
        complete = 2 * window * passes >= number_of_nodes
        further = stage(_all_links(nodes, roots, threshold), "links") if complete else linked(begin, window)
        links, begin = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(further), begin + passes
        roots = stage(components(links), "roots")
    counted = _counted(nodes.join(roots, "node"), threshold)
    facts = classes.join(roots, "node", "left").join(counted, "node", "left").select(
        "v", "first", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links")
    )
    facts = stage(facts, "facts")
    least = stage(facts.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    known = facts.join(least, "root").select(F.col("v").alias("_v"), "component_id", "n_links")
    joined = good.join(stage(known, "known"), F.col("v") == F.col("_v")).select("id", "n_links", "component_id")
    rest = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = joined.unionByName(rest)
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _all_links(nodes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join the components of all nodes as every pair that reaches the threshold would."""
    members = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def forest(table: pa.Table) -> pa.Table:
        units = _matrix(table.column("unit"))
        known, code = np.unique(table.column("root").to_numpy(), return_inverse=True)
        label = np.arange(len(known))
        for low in range(0, len(units), 200):
            a, b = np.nonzero(units[low : low + 200] @ units.T >= threshold)
            a, b = label[code[a + low]], label[code[b]]
            a, b = a[a != b], b[a != b]
            if len(a):
                label = _joined_up((np.concatenate([a, np.arange(len(known))]), np.concatenate([b, label])), len(known))
        moved = np.flatnonzero(label != np.arange(len(known)))
        return pa.table({"a": pa.array(known[label[moved]], pa.int64()), "b": pa.array(known[moved], pa.int64())})

    wide = _in_pairs(members, "dim", F.ceil(F.count("*") * F.col("dim") * 8 / BLOCK_BYTES)).select("dim", "pair", "root", "unit")
    return wide.groupBy("dim", "pair").applyInArrow(forest, "a long, b long")


def _in_pairs(members: DataFrame, by: str, blocks: Column) -> DataFrame:
    """The members dealt to ``blocks`` per group, each repeated for every pair of blocks that holds its ``own``."""
    sizes = stage(members.groupBy(by).agg(blocks.cast("int").alias("blocks")), "sizes")
    dealt = members.join(sizes, by).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return dealt.withColumn(
        "pair",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j"))
            )
        ),
    )


def _counted(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links): rows of other nodes of the component that reach the threshold."""

    def count(table: pa.Table) -> pa.Table:
        units, rows, own = _matrix(table.column("unit")), table.column("rows").to_numpy(), table.column("own").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        links = np.zeros(len(units), np.int64)
        for low in range(0, len(units), 500):
            near = units[low : low + 500] @ units.T >= threshold
            if i != j:
                near &= own[low : low + 500, None] != own[None, :]
            near[np.arange(len(near)), np.arange(low, low + len(near))] = False
            links[low : low + 500] = near @ rows
        return pa.table({"node": table.column("node"), "links": pa.array(links)})

    dealt = _in_pairs(members, "root", F.ceil(F.count("*") / BLOCK))
    wide = dealt.select("root", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "own", "dim", "node", "rows", "unit")
    return wide.groupBy("root", "i", "j").applyInArrow(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))

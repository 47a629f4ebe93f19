"""Conversation prefix trie: what conversations share when they start with the same turns.

Conversations are sequences of dictionary ids of their turns. Distinct sequences are cut
into range shards; each shard is a ternary search tree, and only the nodes on a shard's
first and last path can lie in other shards too, so only these are merged.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlab.session import stage

WORD = r"[^\x20\x09-\x0D]+"
# Turns in one shard's tree, and so in one task's memory (some 150 bytes each).
TURNS_PER_SHARD = 100_000
# Ids that one row of a list of members holds.
IDS_PER_CHUNK = 4096
EMPTY = hashlib.sha256(b"").hexdigest()


class TernaryTree:
    """A ternary search tree over sequences of whole numbers.

    ``low`` and ``high`` lead to nodes with other ids at the same depth, ``equal`` to the
    first node of the next depth. Node 0 is the root, which has no id. Links are node
    numbers, 0 for none; plain arrays, so a node costs four numbers.
    """

    def __init__(self) -> None:
        self.ids, self.low, self.equal, self.high = (array("q", [0]) for _ in range(4))

    def insert(self, sequence: list[int]) -> int:
        """The node of the whole sequence, made with those of its prefixes if it is new."""
        ids, low, equal, high = self.ids, self.low, self.equal, self.high
        above = 0
        for turn in sequence:
            node, links, at = equal[above], equal, above
            while node and ids[node] != turn:
                links, at = (low, node) if turn < ids[node] else (high, node)
                node = links[node]
            if not node:
                node = links[at] = len(ids)
                ids.append(turn)
                low.append(0)
                equal.append(0)
                high.append(0)
            above = node
        return above

    def insert_balanced(self, sequences: list[list[int]]) -> list[int]:
        """Insert sorted sequences, the median first, then the medians of both halves and so on."""
        ends = [0] * len(sequences)
        todo = [(0, len(sequences))]
        while todo:
            start, stop = todo.pop()
            if start < stop:
                middle = (start + stop) // 2
                ends[middle] = self.insert(sequences[middle])
                todo += [(middle + 1, stop), (start, middle)]
        return ends

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, the node above it, depth), every node after the one above it; the root first, above itself."""
        yield 0, 0, 0
        todo = [(self.equal[0], 0, 1)]
        while todo:
            node, above, depth = todo.pop()
            if node:
                yield node, above, depth
                todo += [(self.low[node], above, depth), (self.high[node], above, depth), (self.equal[node], node, depth + 1)]


NODES = (
    "id bigint, depth bigint, above bigint, n bigint, children bigint, leaves bigint, gross decimal(38,0), net decimal(38,0), "
    "ended bigint, own_key binary, above_key binary"
)


def _keys(sequence: list[int], depth: int) -> list[bytes]:
    """A digest of each prefix of 0 to ``depth`` turns."""
    state, out = hashlib.sha256(), [b"root"]
    for turn in sequence[:depth]:
        state.update(int(turn).to_bytes(8, "little", signed=True))
        out.append(state.digest()[:16])
    return out


def shard_nodes(sequences: list[list[int]], words: list[list[int]], counts: list[int], first: list[int], before: int, after: int) -> list[tuple]:
    """One tuple of ``NODES`` per node of a shard's tree.

    ``before`` is the depth to which the first sequence runs along the last one of the
    shard before (-1: there is none), ``after`` that of the last sequence and the first one
    of the next shard. Nodes on these paths have keys, by which they are merged; each is
    counted as a child, and its words once, by the first shard that holds it.
    """
    tree = TernaryTree()
    ends = tree.insert_balanced(sequences)
    visits = list(tree.walk())
    size = len(tree.ids)
    above, depth = array("q", bytes(8 * size)), array("q", bytes(8 * size))
    for node, up, d in visits:
        above[node], depth[node] = up, d
    n, least, ended = [0] * size, [None] * size, [None] * size
    cost, keys = [0] * size, [None] * size
    for k, end in enumerate(ends):
        n[end] += counts[k]
        least[end] = ended[end] = first[k]
        node = end
        # Words are known from any sequence through the node; nodes that have theirs end the climb.
        for w in reversed(words[k]):
            if cost[node]:
                break
            cost[node] = w + 1
            node = above[node]
    owned = [True] * size
    for sequence, end, shared, mine in ((sequences[0], ends[0], before, False), (sequences[-1], ends[-1], after, True)):
        if shared < 0:
            continue
        path = [end]
        while path[-1]:
            path.append(above[path[-1]])
        for d, (node, key) in enumerate(zip(reversed(path), _keys(sequence, shared))):
            keys[node] = key
            owned[node] &= mine
    children, leaves, gross, net = [0] * size, [0] * size, [0] * size, [0] * size
    for node, up, d in reversed(visits):
        if tree.equal[node] == 0 and not (node == ends[-1] and d <= after):
            leaves[node] = 1
        w = max(cost[node] - 1, 0)
        gross[node] += n[node] * w
        if owned[node]:
            net[node] += w
        if node:
            n[up] += n[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            leaves[up] += leaves[node]
            gross[up] += gross[node]
            net[up] += net[node]
            children[up] += owned[node]
    return [
        (least[v], depth[v], None if not v else least[above[v]], n[v], children[v], leaves[v], gross[v], net[v], ended[v], keys[v], keys[above[v]] if v else None)
        for v in range(size)
    ]


def _nodes_of(near: dict[int, tuple[int, int]]):
    def nodes(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*[group[c].to_pylist() for c in ("ids", "words", "n", "id")]), key=lambda r: r[0])
        found = shard_nodes(*[list(c) for c in zip(*rows)], *near[group["shard"][0].as_py()])
        kinds = [pa.int64()] * 6 + [pa.decimal128(38, 0)] * 2 + [pa.int64()] + [pa.binary()] * 2
        names = [part.split()[0] for part in NODES.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    return nodes


def _shared(a: Column, b: Column) -> Column:
    """How many first items two arrays, which are not equal, have in common; -1 if one is null."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(a.isNull() | b.isNull(), -1).otherwise(differs - 1)


def _rows(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, member) rows as (id, start, text) rows of joined members."""
    kinds = {"id": pa.int64(), "start": pa.int64(), "text": pa.string()}
    key, members, out = None, [], []
    for batch in batches:
        for k, m in zip(batch.column("id").to_pylist(), batch.column("member").to_pylist()):
            if members and (k != key or len(members) == IDS_PER_CHUNK):
                out.append((key, members[0], ",".join(map(str, members))))
                members = []
            key = k
            members.append(m)
        yield _rows(out, **kinds)
        out = []
    if members:
        yield _rows([(key, members[0], ",".join(map(str, members)))], **kinds)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, start, text) rows as one (id, digest) per id; one chunk is held at a time."""
    kinds = {"id": pa.int64(), "digest": pa.string()}
    key, state, out = None, None, []
    for batch in batches:
        for k, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            if state is not None and k == key:
                state.update(b"," + text.encode())
                continue
            if state is not None:
                out.append((key, state.hexdigest()))
            key, state = k, hashlib.sha256(text.encode())
        yield _rows(out, **kinds)
        out = []
    if state is not None:
        yield _rows([(key, state.hexdigest())], **kinds)


def encoded_turns(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, turn_id, words): every row with the dictionary id of its (role, text).

    The dictionary is a written table of the distinct turns, numbered in the order of
    their SHA-256. The join back is one that adaptive execution can split, so a turn that
    a third of all conversations open with is not gathered anywhere.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    named = F.concat_ws(":", F.length(role).cast("string"), role, text)
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, 16).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    distinct = rows.groupBy("digest").agg(F.first("words").alias("words"))
    ordered = distinct.repartitionByRange("digest").sortWithinPartitions("digest")
    dictionary = stage(ordered.withColumn("turn_id", F.monotonically_increasing_id()), "turns")
    return rows.drop("words").join(dictionary, "digest").select("conv", "turn", "turn_id", "words")


def rebuilt(encoded: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv, ids, words): the first h turns of conversation ``conv - conv % group``, then the own ones from the h-th.

    h is the CRC-32 of the decimal id modulo ``heads``; all turns if the other
    conversation has fewer, none if it is absent.
    """
    item = F.struct("turn", "turn_id", "words")
    own = encoded.groupBy("conv").agg(F.sort_array(F.collect_list(item)).alias("own"))
    own = stage(own, "conversations")
    base = F.col("conv") - F.col("conv") % group
    opening = own.where(F.col("conv") == base).select(F.col("conv").alias("base"), F.slice("own", 1, max(1, heads - 1)).alias("opening"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    taken = F.slice(F.coalesce("opening", F.slice("own", 1, 0)), F.lit(1), h)
    rest = F.slice("own", h + 1, F.greatest(F.size("own"), F.lit(1)))
    joined = own.withColumn("base", base).join(opening, "base", "left").select("conv", F.concat(taken, rest).alias("all"))
    return joined.select("conv", F.col("all.turn_id").alias("ids"), F.col("all.words").alias("words"))


def trie(sequences: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv, ids, words), as of ``prefix_trie``."""
    keyed = stage(sequences.withColumn("key", F.sha2(F.array_join("ids", ",").cast("binary"), 256)), "sequences")
    groups = keyed.groupBy("key").agg(
        F.first("ids").alias("ids"), F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv").alias("id")
    )
    groups = stage(groups, "groups")
    turns = groups.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(1, -(-turns // turns_per_shard))
    dealt = stage(groups.repartitionByRange(shards, "ids").withColumn("shard", F.spark_partition_id()).drop("key"), "shards")

    # One row per shard: its first and last sequence, beside those of its neighbours.
    in_order = Window.orderBy("shard")
    ends = dealt.groupBy("shard").agg(F.min("ids").alias("least"), F.max("ids").alias("most"))
    near = ends.select(
        "shard",
        _shared(F.lag("most").over(in_order), F.col("least")).alias("before"),
        _shared(F.col("most"), F.lead("least").over(in_order)).alias("after"),
    ).collect()
    depths = {r["shard"]: (r["before"], r["after"]) for r in near}
    nodes = stage(dealt.groupBy("shard").applyInArrow(_nodes_of(depths), NODES), "nodes")

    merged = stage(
        nodes.where("own_key is not null").groupBy(F.col("own_key").alias("key"), "depth").agg(
            F.min("id").alias("id"), F.max("above_key").alias("above_key"), F.sum("n").alias("n"), F.sum("children").alias("children"),
            F.sum("leaves").alias("leaves"), F.sum("gross").alias("gross"), F.sum("net").alias("net"), F.max("ended").alias("ended"),
        ),
        "merged",
    )
    columns = ["id", "depth", "above", "n", "children", "leaves", "gross", "net", "ended"]
    found = merged.select(F.col("key").alias("at"), F.col("id").alias("found"))
    below = nodes.where("own_key is null and above_key is not null").drop("above").unionByName(
        merged.select(*[c for c in columns if c != "above"], F.lit(None).cast("binary").alias("own_key"), "above_key")
    )
    below = below.join(found, F.col("above_key") == F.col("at"), "left").withColumnRenamed("found", "above")
    alone = nodes.where("own_key is null and above_key is null")
    every = alone.select(*columns).unionByName(below.select(*columns))

    # Members that end at a node: the conversations with exactly its sequence, named by the least of them.
    several = groups.where("n > 1").select("key", "id")
    members = keyed.select("key", F.col("conv").alias("member")).join(several, "key").select("id", "member")
    chunks = members.repartitionByRange("id", "member").sortWithinPartitions("id", "member").mapInArrow(_chunks, "id bigint, start bigint, text string")
    lists = chunks.repartition("id").sortWithinPartitions("id", "start").mapInArrow(_digests, "id bigint, digest string")
    lists = lists.select(F.col("id").alias("list"), "digest")
    ending = every.where("ended is not null").join(lists, F.col("ended") == F.col("list"), "left")
    ending = ending.select(*columns, F.coalesce("digest", F.sha2(F.col("ended").cast("string").cast("binary"), 256)).alias("digest"))
    passing = every.where("ended is null").select(*columns, F.lit(EMPTY).alias("digest"))
    return ending.unionByName(passing).select(
        F.col("id").alias("conv_id"),
        "depth",
        F.col("above").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("gross") - F.col("net")).cast("long").alias("saved_tokens"),
        F.col("digest").alias("ends_sha256"),
    )


def prefix_trie(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    turns_per_shard: int = TURNS_PER_SHARD,
) -> DataFrame:
    """Per trie node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    1. Turns are dictionary-encoded; conversations become sequences of ids (``rebuilt``).
    2. Equal sequences are counted in the map tasks first, so copies of one conversation
       are one row, however many there are.
    3. Distinct sequences are cut into range shards by a counted number of turns. Each shard
       builds a ternary search tree by median insertion, and one iterative walk sums up
       members, leaves and savings from the ends to the root.
    4. Nodes on a shard's first and last path are merged by a digest of their prefix; all
       others are final as they are.
    5. Members that end at a node are listed in chunks of sorted ids and hashed chunk after
       chunk, so a list of any length is never held as a whole.

    What one task holds: a shard, and the ids (not the texts) of one conversation. Rows
    with a null id belong to no conversation and are left out. Null turn numbers come
    first; equal ones are ordered by the SHA-256 of their (role, text), and repeated rows are
    repeated turns. Null and empty roles and texts are the same; very long texts only cost
    their hashing. ``%`` is that of SQL, so for negative ids it has their sign. An empty
    table gives an empty result; extra columns are not looked at, whatever they are called.
    """
    encoded = encoded_turns(turns, id_col, turn_col, role_col, text_col)
    return trie(rebuilt(encoded), turns_per_shard)

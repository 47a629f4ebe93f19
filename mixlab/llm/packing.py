"""Best-fit decreasing packing of token sequences.

Bins with the same room left are interchangeable, so best fit needs only how many open
bins have each room, 0 to the capacity. A segment tree over the rooms finds the tightest
one; what is placed is a run of pieces of one length into a run of bins of one room. The
driver sees one number per length (at most the capacity), never a document; the pieces
find their bins by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.llm.ranks import bucket_count, total_before
from mixlab.llm.tokens import encoded, tokenizer_path
from mixlab.session import stage

CAPACITY = 4096
END_ID = 1


class RoomTree:
    """Segment tree over rooms 0..capacity that holds how many open bins have each room."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, room: int, bins: int) -> None:
        at = room + self.leaves
        while at:
            self.sums[at] += bins
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` with an open bin."""
        at = least + self.leaves
        if self.sums[at]:
            return least
        while at > 1:
            if not at & 1 and self.sums[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.sums[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, np.ndarray], int]:
    """Runs of placements per length, and the number of bins.

    A run is (first rank, first bin, pieces per bin, offset of the first piece): piece
    ``first rank + t`` goes to bin ``first bin + t // pieces`` at ``offset + t % pieces *
    length``. The outcome is that of placing the pieces one by one, longest first, each
    into the open bin with the least room that holds it: a bin keeps taking pieces of the
    length, as its room shrinks and stays the tightest.
    """
    tree, open_bins = RoomTree(capacity), [deque() for _ in range(capacity + 1)]
    runs: dict[int, np.ndarray] = {}
    made = 0

    def release(room: int, first: int, count: int) -> None:
        if count and room:
            tree.add(room, count)
            queue = open_bins[room]
            if queue and sum(queue[-1]) == first:
                queue[-1] = (queue[-1][0], queue[-1][1] + count)
            else:
                queue.append((first, count))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no piece of {length} fits {capacity}")
        left, rank, found = histogram[length], 0, []
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, made
                count = -(-left // (capacity // length))
                made += count
            else:
                first, count = open_bins[room].popleft()
                tree.add(room, -count)
            per_bin = room // length
            full = min(count, left // per_bin)
            if full:
                found.append((rank, first, per_bin, capacity - room))
                release(room - per_bin * length, first, full)
                rank, left = rank + full * per_bin, left - full * per_bin
            if full < count:
                if left and left < per_bin:
                    found.append((rank, first + full, left, capacity - room))
                    release(room - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                release(room, first + full, count - full)
        runs[length] = np.array(found, np.int64)
    return runs, made


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32. A document is its ids and then ``end_id``;
    longer ones than ``capacity`` are cut at its multiples."""
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.array([end_id], "<u4")
        for part, coder, words in encoded(batches, "text", path):
            ids, row, piece, length, crc = part.column(0), [], [], [], []
            for i, found in enumerate(coder.documents(words)):
                whole = np.concatenate([found.astype("<u4", copy=False), tail])
                for low in range(0, len(whole), capacity):
                    own = whole[low : low + capacity]
                    row.append(i)
                    piece.append(low // capacity)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
            number = np.array(piece, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(number * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    The lengths' histogram (at most ``capacity`` rows) goes to the driver, which packs it
    exactly by best fit decreasing; each piece then looks its bin up by its rank among
    the pieces of its length. Ranks count within hash buckets of bounded size, so a very
    common length is not sorted in one task. The runs that are sent to the tasks depend
    on the lengths that occur, not on the number of documents.

    Null and empty texts are one piece of the end id. Repeated rows are packed each. A
    null id is kept. An empty table gives an empty result.
    """
    pieces = stage(token_pieces(docs, capacity, end_id, path, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = best_fit_decreasing(histogram, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(runs)
    # As many buckets as a length has rows for; the list has one number per length, at most ``capacity``.
    counts = ",".join(str(bucket_count(histogram.get(length, 0))) for length in range(capacity + 1))
    buckets = F.get(F.split(F.lit(counts), ",").cast("array<bigint>"), F.col("length").cast("int"))
    ranked = total_before(
        pieces.withColumn("_part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), buckets)),
        ["length"],
        "_part",
        ["id", "piece", "ids_crc32"],
        F.lit(1).cast("long"),
        "_rank",
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                length = int(lengths[rows[0]])
                found = shared.value[length]
                run = found[np.searchsorted(found[:, 0], ranks[rows], "right") - 1]
                along = ranks[rows] - run[:, 0]
                sequence[rows] = run[:, 1] + along // run[:, 2]
                offset[rows] = run[:, 3] + along % run[:, 2] * length
            kept = [batch.column(n) for n in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    placed = ranked.select("id", "piece", "start", "length", "ids_crc32", "_rank").mapInArrow(
        place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)

"""Removal of repeated word windows: a count-min prefilter, then exact grouping.

A window is ``width`` consecutive words of one document. Every window has an anchor: the
least hash among the shorter grams in it. Equal windows have equal anchors, so the count
of an anchor is never below the count of any of its windows, and there are far fewer
anchors than windows. Partition sketches of the anchors are merged; only windows whose
anchor may occur twice go on to the exact pass, and none that does is lost.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.llm.text import Words, chunks, mix, rolling, signed
from mixlab.session import stage

WIDTH = 50
GRAM = 8
DEPTH = 3
CELLS = 1 << 24
_PART = 1 << 15
HOT_RUNS = 1000
LAST = (1 << 63) - 1


def windows(words: Words, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, window hash, anchor) of every window, document by document."""
    hashes = words.hashes()
    counts = words.counts()
    sizes = np.maximum(counts - width + 1, 0)
    ends = np.cumsum(sizes)
    first = np.repeat(words.first[:-1] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    if not len(first):
        none = np.zeros(0, np.uint64)
        return first, none, none
    grams = rolling(hashes, np.arange(len(hashes) - gram + 1), np.arange(gram, len(hashes) + 1))
    span, least, reach = width - gram + 1, grams, 1
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    anchors = np.minimum(least[first], least[first + span - reach])
    return first, rolling(hashes, first, first + width), anchors


def _runs(anchors: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where a run of consecutive windows with one anchor starts."""
    fresh = np.ones(len(anchors), bool)
    fresh[1:] = (anchors[1:] != anchors[:-1]) | (first[1:] != first[:-1] + 1)
    return np.flatnonzero(fresh)


def cells(anchors: np.ndarray, row: int, size: int) -> np.ndarray:
    return (mix(anchors + np.uint64(row + 1)) & np.uint64(size - 1)).astype(np.int64)


class Sketch:
    """A count-min sketch whose counters stop at two: one bit plane for one or more, one for two or more."""

    def __init__(self, depth: int = DEPTH, size: int = CELLS) -> None:
        self.depth, self.size = depth, size
        self.one = np.zeros((depth, size // 8), np.uint8)
        self.two = np.zeros((depth, size // 8), np.uint8)

    def add(self, anchors: np.ndarray) -> None:
        for row in range(self.depth):
            found, times = np.unique(cells(anchors, row, self.size), return_counts=True)
            once, twice = np.zeros(self.size // 8, np.uint8), np.zeros(self.size // 8, np.uint8)
            for plane, spots in ((once, found), (twice, found[times > 1])):
                np.bitwise_or.at(plane, spots >> 3, (1 << (spots & 7)).astype(np.uint8))
            self.two[row] |= twice | (self.one[row] & once)
            self.one[row] |= once

    def parts(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(part, packed plane of one, packed plane of two) where anything is set."""
        one, two = self.one.reshape(-1, _PART // 8), self.two.reshape(-1, _PART // 8)
        for i in np.flatnonzero(one.any(axis=1)).tolist():
            yield i, zlib.compress(one[i].tobytes(), 1), zlib.compress(two[i].tobytes(), 1)


def merge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up sketches part by part; holds the planes of this task's parts only."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for i, one, two in zip(*(c.to_pylist() for c in batch.columns)):
            one, two = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (one, two))
            if i in held:
                own = held[i]
                own[1] |= two | (own[0] & one)
                own[0] |= one
            else:
                held[i] = [one.copy(), two.copy()]
    for i, (one, two) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([i], pa.int32()), pa.array([zlib.compress(one.tobytes(), 1)], pa.binary()), pa.array([zlib.compress(two.tobytes(), 1)], pa.binary())],
            names=["part", "one", "two"],
        )


def repeated_anchors(source: DataFrame, width: int, gram: int, depth: int = DEPTH, size: int = CELLS) -> np.ndarray:
    """The merged sketch's plane of two or more, depth x size / 8 bytes whatever the input (6 MB by default)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketch(depth, size)
        for batch in batches:
            seen = []
            for _, data, offsets in chunks(batch, "text"):
                first, _, anchors = windows(Words(data, offsets), width, gram)
                seen.append(anchors[_runs(anchors, first)])
            if seen:
                own.add(np.concatenate(seen))
        found = list(own.parts())
        for low in range(0, len(found), 64):
            i, one, two = zip(*found[low : low + 64])
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(one, pa.binary()), pa.array(two, pa.binary())], names=["part", "one", "two"])

    schema = "part int, one binary, two binary"
    rows = source.select("text").mapInArrow(sketch, schema)
    merged = rows.repartition(min(256, depth * size // _PART), "part").mapInArrow(merge_parts, schema)
    two = np.zeros((depth * size // _PART, _PART // 8), np.uint8)
    for r in merged.select("part", "two").collect():
        two[r["part"]] = np.frombuffer(zlib.decompress(r["two"]), np.uint8)
    return two.reshape(depth, size // 8)


def _estimated_repeated(two: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    kept = np.ones(len(anchors), bool)
    for row in range(len(two)):
        spots = cells(anchors, row, two.shape[1] * 8)
        kept &= (two[row][spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 != 0
    return kept


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, depth: int = DEPTH, size: int = CELLS, id_col: str = "doc_id", text_col: str = "text", hot_runs: int = HOT_RUNS) -> DataFrame:
    """(id, print, spans): per id and hash of the text the word ranges [start, end) that a document with a smaller id holds, in order."""
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text_col).alias("print"), F.col(text_col).alias("text"))
    two = source.sparkSession.sparkContext.broadcast(repeated_anchors(source, width, gram, depth, size))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                words = Words(data, offsets)
                first, hashes, anchors = windows(words, width, gram)
                starts = _runs(anchors, first)
                stops = np.append(starts[1:], len(first))
                keep = _estimated_repeated(two.value, anchors[starts])
                starts, stops = starts[keep], stops[keep]
                if not len(starts):
                    continue
                owner = np.searchsorted(words.first, first[starts], "right") - 1
                prints = mix(rolling(hashes, starts, stops) + (stops - starts).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner)),
                        part.column(1).take(pa.array(owner)),
                        pa.array(first[starts] - words.first[owner]),
                        pa.array(signed(anchors[starts])),
                        pa.array(signed(prints)),
                        pa.array([hashes[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()),
                    ],
                    names=["id", "print", "start", "anchor", "run", "hashes"],
                )

    found = stage(source.mapInArrow(gather, "id long, print long, start long, anchor long, run long, hashes binary"), "windows")
    # One row per anchor and run of windows, with the least id that holds it: the copies of
    # a run are counted in the map tasks, and only different runs of an anchor meet.
    runs = stage(found.groupBy("anchor", "run").agg(F.min("id").alias("least"), F.min("hashes").alias("hashes")), "runs")
    busy = stage(runs.groupBy("anchor").count().where(F.col("count") > hot_runs).select("anchor"), "busy")

    def first_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of anchors; per run the least id that holds each of its windows."""
        names = ["anchor", "run", "holders"]

        def settle(rows: pa.Table) -> pa.RecordBatch:
            parts = [np.frombuffer(h.as_buffer(), np.int64) for c in rows.column("hashes").chunks for h in c]
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            hashes = np.concatenate(parts)
            anchor = np.repeat(rows.column("anchor").to_numpy(), lengths)
            ids = np.repeat(rows.column("least").to_numpy(), lengths)
            order = np.lexsort((ids, hashes, anchor))
            fresh = np.ones(len(order), bool)
            fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
            least = np.empty(len(order), np.int64)
            least[order] = ids[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            cuts = np.concatenate([[0], np.cumsum(lengths)])
            return pa.RecordBatch.from_arrays(
                [rows.column("anchor").combine_chunks(), rows.column("run").combine_chunks(), pa.array([least[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                names=names,
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchors = batch.column(0).to_numpy()
            cut = int(np.searchsorted(anchors, anchors[-1]))
            if cut:
                yield settle(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif held and held[-1].column(0)[-1].as_py() != anchors[-1]:
                yield settle(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield settle(pa.Table.from_batches(held))

    width_of = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = runs.join(busy, "anchor", "left_anti").select("anchor", "run", "least", "hashes").repartition(width_of, "anchor").sortWithinPartitions("anchor")
    holders = ordered.mapInArrow(first_holders, "anchor long, run long, holders binary")
    holders = stage(holders.unionByName(_busy_holders(runs.join(busy, "anchor", "left_semi"))), "holders")
    return _marked(found, holders, width)


def _busy_holders(runs: DataFrame) -> DataFrame:
    """The same as for other anchors, window by window: a passage that very many documents
    hold, each in other surroundings, must not gather in one task."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                hashes = [np.frombuffer(h.as_buffer(), np.int64) for h in part.column(3)]
                lengths = np.fromiter(map(len, hashes), np.int64, len(hashes))
                wide = [np.repeat(part.column(i).to_numpy(), lengths) for i in range(3)]
                place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*wide, place, np.concatenate(hashes))], names=["anchor", "run", "least", "place", "hash"])

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets, values = lists.offsets.to_numpy(), lists.flatten().field("holder").to_numpy()
            values_at = offsets - offsets[0]
            held = [values[a:b].tobytes() for a, b in zip(values_at[:-1], values_at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(held, pa.binary())], names=["anchor", "run", "holders"])

    rows = runs.select("anchor", "run", "least", "hashes").mapInArrow(explode, "anchor long, run long, least long, place long, hash long")
    least = stage(rows.groupBy("anchor", "hash").agg(F.min("least").alias("holder")), "windows")
    joined = rows.select("anchor", "run", "place", "hash").join(least, ["anchor", "hash"])
    lists = joined.groupBy("anchor", "run").agg(F.array_sort(F.collect_list(F.struct("place", "holder"))).alias("windows"))
    return lists.mapInArrow(join_up, "anchor long, run long, holders binary")


def _marked(found: DataFrame, holders: DataFrame, width: int) -> DataFrame:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints, starts = (batch.column(i).to_numpy() for i in range(3))
            rows, low, high = [], [], []
            for i, held in enumerate(batch.column(3)):
                taken = np.frombuffer(held.as_buffer(), np.int64) < ids[i]
                if taken.any():
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], taken, [False]])))
                    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        rows.append(i)
                        low.append(starts[i] + a)
                        high.append(starts[i] + b - 1 + width)
            yield pa.RecordBatch.from_arrays([pa.array(x[rows] if rows else [], pa.int64()) for x in (ids, prints)] + [pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["id", "print", "low", "high"])

    joined = found.select("id", "print", "start", "anchor", "run").join(holders, ["anchor", "run"]).select("id", "print", "start", "holders")
    spans = joined.mapInArrow(mark, "id long, print long, low long, high long")
    return spans.groupBy("id", "print").agg(F.array_sort(F.collect_set(F.struct("low", "high"))).alias("spans"))


def _spans_off(words: Words, at: int, spans: list | None) -> np.ndarray:
    """Which words of document ``at`` are left."""
    left = np.ones(words.first[at + 1] - words.first[at], bool)
    for s in spans or ():
        left[s["low"] : s["high"]] = False
    return left


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, depth: int = DEPTH, size: int = CELLS, id_col: str = "doc_id", text_col: str = "text", hot_runs: int = HOT_RUNS) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_text (the words left, joined by one space) and kept_sha256.

    Each word is removed that a window covers which also starts in a document with a
    smaller id; windows are judged on the input. Windows are compared by 64-bit hashes
    among those of one anchor. ``size`` cells of ``depth`` rows bound the sketch, in the
    tasks and on the driver; more data than it can tell apart makes the exact pass larger,
    not wrong.

    Null texts have no words; documents with fewer words than a window lose none. A null
    id counts as the largest. Rows that repeat an id do not remove each other's words; each
    loses what smaller ids hold of its own text. An empty table gives an empty result.
    """
    spans = repeated_spans(docs, width, gram, depth, size, id_col, text_col, hot_runs)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text_col).alias("print"), F.col(text_col).alias("text"))
    joined = keyed.join(spans, ["id", "print"], "left").select("doc", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                words = Words(data, offsets)
                spans, texts = part.column(2).to_pylist(), []
                for i, found in enumerate(spans):
                    left = _spans_off(words, i, found)
                    pieces = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    texts.append(b" ".join(pieces) if left.all() else b" ".join([p for p, k in zip(pieces, left.tolist()) if k]))
                counts = words.counts()
                removed = np.array([int((~_spans_off(words, i, s)).sum()) if s else 0 for i, s in enumerate(spans)], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts.astype(np.int64)),
                        pa.array(removed),
                        pa.array([t.decode() for t in texts], pa.string()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    ],
                    names=["doc", "n_words", "n_removed", "kept_text", "kept_sha256"],
                )

    return joined.mapInArrow(cut, "doc long, n_words long, n_removed long, kept_text string, kept_sha256 string").withColumnRenamed("doc", id_col)

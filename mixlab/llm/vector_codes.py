"""Vector code compression: product codes learned and assigned in whole numbers alone.

Distances are taken between Walsh-Hadamard transforms. The transform of a part padded with
zeros to a power of two P keeps squared distances up to the factor P, and gathers most of
a difference in its first coefficients when these are taken in sequency order, so that an
entry can be dropped as soon as its partial sum exceeds a distance that is already known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.session import stage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Whole numbers beyond this are clamped to it: sums of 10**19 of them fit decimal(38, 0).
MOST = 1 << 62
LONGEST = (1 << 63) - 1
# Rows transformed at a time.
BLOCK = 8192
# Coefficients summed for all entries before the first ones are dropped.
LEAD = 2


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite values as 64-bit numbers, clamped to +-MOST."""
    with np.errstate(over="ignore"):
        wide = np.floor(values.astype(np.float64) * scale)
    small = np.clip(wide, -float(MOST), float(MOST))
    return small.astype(np.int64)


def sequency_rows(size: int) -> np.ndarray:
    """The Hadamard matrix of a power of two, rows ordered by their number of sign changes."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")]


def transform(parts: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Coefficients of ``parts`` (rows of p numbers, padded with zeros), in sequency order."""
    return parts @ matrix[:, : parts.shape[1]].T.astype(parts.dtype)


def nearest(rows: np.ndarray, entries: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row (ties to the lower) and its squared distance.

    ``rows`` and ``entries`` are coefficients in sequency order, whose squared distances
    are ``scale`` times those of the parts. After ``LEAD`` coefficients the most promising
    entry of each row is summed to the end; then the pairs whose partial sum exceeds that
    bound leave, coefficient by coefficient. A pair that ties with the bound stays.
    """
    count, size = rows.shape
    lead = min(LEAD, size)
    partial = np.zeros((count, len(entries)), rows.dtype)
    for c in range(lead):
        step = rows[:, c, None] - entries[None, :, c]
        partial += step * step
    likely = partial.argmin(axis=1)
    bound = partial[np.arange(count), likely]
    rest = rows[:, lead:] - entries[likely, lead:]
    bound = bound + (rest * rest).sum(axis=1)
    row, entry = np.nonzero(partial <= bound[:, None])
    left = partial[row, entry]
    for c in range(lead, size):
        step = rows[row, c] - entries[entry, c]
        left = left + step * step
        stays = np.flatnonzero(left <= bound[row])
        row, entry, left = row[stays], entry[stays], left[stays]
    # Pairs are in the order of (row, entry) and every row has one at least.
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])[:count]
    least = np.minimum.reduceat(left, first) if count else left
    best = np.flatnonzero(left == least[row])
    best = best[np.r_[True, row[best][1:] != row[best][:-1]][: len(best)]]
    return entry[best], least // scale


def fits(largest: int, size: int) -> bool:
    """Whether squared distances of transforms of numbers up to ``largest`` fit 64 bits."""
    return 4 * size * size * largest * largest <= LONGEST


class Codebooks:
    """The entries of every part, with their transforms."""

    def __init__(self, entries: np.ndarray) -> None:
        """``entries``: (parts, entries, width) whole numbers."""
        self.entries = entries
        size = 1
        while size < entries.shape[2]:
            size *= 2
        self.size = size
        self.matrix = sequency_rows(size)
        self.largest = max((abs(int(v)) for v in (entries.max(initial=0), entries.min(initial=0))), default=0)

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) entry indices and squared distances of ``vectors`` (rows, parts, width).

        Numbers too large for 64-bit squares are handled as Python integers, row by row
        group, so results are exact at any size.
        """
        count, parts, _ = vectors.shape
        index = np.zeros((count, parts), np.int64)
        error = np.zeros((count, parts), np.int64)
        if not count or not self.entries.shape[2]:
            return index, error
        for low in range(0, count, BLOCK):
            block = vectors[low : low + BLOCK]
            peak = np.maximum(block.max(axis=(1, 2)), -block.min(axis=(1, 2)))
            plain = np.array([fits(max(int(p), self.largest), self.size) for p in np.unique(peak)])[np.unique(peak, return_inverse=True)[1]]
            for kind, rows in ((np.int64, np.flatnonzero(plain)), (object, np.flatnonzero(~plain))):
                if not len(rows):
                    continue
                if kind is object:
                    error = error.astype(object)
                matrix = self.matrix.astype(kind)
                for part in range(parts):
                    have = transform(block[rows, part].astype(kind), matrix)
                    want = transform(self.entries[part].astype(kind), matrix)
                    index[low + rows, part], error[low + rows, part] = nearest(have, want, self.size)
        return index, error

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets).astype(np.int64)
    return np.asarray(column.values), offsets


def _kept(scale: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector").cast(pa.list_(pa.float64()))
            whole = [i for i, v in enumerate(column.is_valid().to_pylist()) if v]
            batch, column = batch.take(pa.array(whole, pa.int64())), column.take(pa.array(whole, pa.int64()))
            values, offsets = column.flatten(), np.r_[0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
            numbers = values.to_numpy(zero_copy_only=False).astype(np.float64)
            bad = np.r_[0, np.cumsum(~np.isfinite(numbers))]
            good = np.flatnonzero(bad[offsets[1:]] == bad[offsets[:-1]])
            numbers = quantised(np.where(np.isfinite(numbers), numbers, 0.0), scale)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(numbers, pa.int64()))
            rows = batch.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("label"), lists.take(pa.array(good, pa.int64()))], names=["id", "label", "numbers"]
            )

    return keep


def _cut(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """(rows, parts, width): each vector continued by zeros and cut into equal parts."""
    values, offsets = _lists(column)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), parts * width), np.int64)
    if len(lengths) and (lengths == parts * width).all():
        out[:] = values[offsets[0] : offsets[-1]].reshape(out.shape)
    else:
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            out[i, : b - a] = values[a:b]
    return out.reshape(len(lengths), parts, width)


def _sums(books: Codebooks, parts: int, width: int):
    """Per task: count and component sums of the parts that each entry has drawn."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.entries.shape[1]
        counts = np.zeros((parts, entries), np.int64)
        totals = np.zeros((parts, entries, width), object)
        for batch in batches:
            vectors = _cut(batch.column("numbers"), parts, width)
            index, _ = books.assign(vectors)
            small = len(vectors) * max(int(vectors.max(initial=0)), -int(vectors.min(initial=0))) <= LONGEST
            for part in range(parts):
                counts[part] += np.bincount(index[:, part], minlength=entries)
                for entry in np.flatnonzero(np.bincount(index[:, part], minlength=entries)):
                    drawn = vectors[index[:, part] == entry, part].astype(np.int64 if small else object)
                    totals[part, entry] += drawn.sum(axis=0).astype(object)
        part, entry, place = (a.ravel() for a in np.indices(totals.shape))
        used = counts[part, entry] > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part[used], pa.int32()),
                pa.array(entry[used], pa.int32()),
                pa.array(place[used], pa.int32()),
                pa.array(counts[part, entry][used], pa.int64()),
                pa.array([int(t) for t in totals.ravel()[used]], pa.decimal128(38, 0)),
            ],
            names=["part", "entry", "place", "n", "total"],
        )

    return add


def _refined(rows: DataFrame, books: Codebooks, parts: int, width: int) -> Codebooks:
    """The next codebooks: floor(sum / count) per used entry, from one aggregate over all rows."""
    sums = rows.select("numbers").mapInArrow(_sums(books, parts, width), "part int, entry int, place int, n bigint, total decimal(38,0)")
    entries = books.entries.copy()
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        entries[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(entries)


def _codes(books: Codebooks, parts: int, width: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, error = books.assign(_cut(batch.column("numbers"), parts, width))
            text = [row.tobytes().hex() for row in index.astype(np.uint8)]
            total = [min(sum(row), LONGEST) for row in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(text, pa.string()), pa.array(total, pa.int64())],
                names=["id", "label", "code", "error"],
            )

    return code


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """Per kept vector: id, code, error, label_error, codebooks_sha256.

    1. Vectors become whole numbers floor(scale * x), written once; all later passes read these.
    2. The first codebook of a part is that part of the vectors with the least ids.
    3. Each round is one pass: tasks assign their parts and emit one count and one sum per
       (part, entry, position), which Spark adds up. The driver sees ``entries`` numbers per
       vector position, whatever the number of rows, and sends back the codebooks.
    4. A last pass writes codes and errors; errors are summed per label and joined back.

    A null vector, or one with a null, NaN or infinite component, has no row in the result.
    A vector shorter than the longest kept one counts as continued by zeros, and so does a
    length that ``parts`` does not divide; empty vectors alone have empty parts and error 0.
    Numbers beyond 2**62 count as 2**62, and an error beyond the largest long is that long.
    A null id comes after all others; rows that repeat an id are told apart by their numbers,
    and repeated rows are coded alike, each in a row of its own. Fewer rows than ``entries``
    make as many entries. Null labels are one label. An empty table gives an empty result;
    extra columns are not looked at, whatever they are called.
    """
    if not 1 <= entries <= 256 or parts < 1 or rounds < 0:
        raise ValueError("a code has two hex digits per part: 1 to 256 entries, at least one part")
    named = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    types = {f.name: f.dataType.simpleString() for f in named.schema}
    kept = stage(named.mapInArrow(_kept(scale), f"id {types['id']}, label {types['label']}, numbers array<bigint>"), "numbers")
    longest = kept.agg(F.max(F.size("numbers"))).first()[0] or 0
    width = -(-longest // parts)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "numbers").limit(entries).select("numbers").collect()
    padded = np.array([r["numbers"] + [0] * (parts * width - len(r["numbers"])) for r in first], np.int64)
    books = Codebooks(padded.reshape(len(first), parts, width).transpose(1, 0, 2).copy())
    for _ in range(rounds if first else 0):
        books = _refined(kept, books, parts, width)
    coded = stage(kept.mapInArrow(_codes(books, parts, width), f"id {types['id']}, label {types['label']}, code string, error bigint"), "codes")
    most = F.lit(LONGEST).cast("decimal(38,0)")
    total = F.sum(F.col("error").cast("decimal(19,0)")).cast("decimal(38,0)")
    labels = coded.groupBy(F.col("label").alias("_label")).agg(F.least(total, most).cast("long").alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def decode(codes: Sequence[str], books: Codebooks) -> np.ndarray:
    """The whole numbers that the codes stand for: one row of parts * width per code."""
    index = np.array([[int(c[i : i + 2], 16) for i in range(0, len(c), 2)] for c in codes], np.int64)
    return books.entries[np.arange(books.entries.shape[0]), index].reshape(len(codes), -1)

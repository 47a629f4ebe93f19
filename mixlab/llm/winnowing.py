"""Document fingerprints by winnowing, in built-in expressions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlab.session import stage

K = 4
WINDOW = 8
# A token is a word, or each 16 code points of a longer one, so that text without spaces has tokens too.
TOKEN = 16
SPACE = r"\x20\x09-\x0D"
# The two rolling hashes: primes below 2**30, so that four products fit 62 bits, and bases.
PRIMES = (1073741789, 1073741783)
BASES = (735632797, 268582165)
# A text is cut into pieces of so many code points, and its windows into runs, to bound what is held at a time.
PIECE = 8192
RUN = 512
_PLACE = 1 << 32
ROWS_PER_RANGE = 100_000
# Repeats of one row are made in two steps of so many.
REPEAT = 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def token_hashes(text: Column) -> Column:
    """The CRC-32 of each token of the text modulo the first prime, in order. Pieces end after
    white space, or within a word after a multiple of ``TOKEN``, so no token is cut."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{0,{PIECE - 1}}}[{SPACE}]|.{{1,{PIECE}}}"), F.lit(0))
    tokens = F.lit(f"[^{SPACE}]{{1,{TOKEN}}}")

    def hashed(token: Column) -> Column:
        return F.pmod(F.crc32(token.cast("binary")), F.lit(PRIMES[0]))

    return F.flatten(F.transform(pieces, lambda piece: F.transform(F.regexp_extract_all(piece, tokens, F.lit(0)), hashed)))


def _gram(tokens: Column, at: Column, k: int, which: int) -> Column:
    """The polynomial hash of the k items from ``at``; null where there are fewer."""
    prime, base = PRIMES[which], BASES[which]
    total = None
    for j in range(k):
        item = F.get(tokens, at + j) * F.lit(pow(base, k - 1 - j, prime))
        total = item if total is None else (total + item if j % 4 else F.pmod(total, F.lit(prime)) + item)
    return F.pmod(total, F.lit(prime))


def _sliding_least(values: Column, width: int) -> Column:
    """The least of each ``width`` consecutive values; fewer at the end, where nulls are passed over."""

    def widened(values: Column, cover: int) -> Column:
        if cover == width:
            return values
        reach = min(4 * cover, width)
        steps = sorted({*range(cover, reach - cover, cover), reach - cover})
        wider = F.transform(values, lambda v, i: F.least(v, *[F.get(values, i + s) for s in steps]))
        return let(wider, lambda v: widened(v, reach))

    return widened(values, 1)


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """struct(positions, hashes): the winnowed k-grams of a text's tokens, by position.

    Each k-gram has a rolling (polynomial) hash. In every window of ``window`` consecutive
    k-grams the one with the least hash is chosen, the rightmost of equal ones, and stays
    once. So two texts that share ``window + k - 1`` consecutive tokens share a
    chosen k-gram, and its position in each is known. What stays carries 60 bits, from
    two rolling hashes. A text with fewer than k tokens is one k-gram, missing tokens counting as
    0; with fewer than ``window`` k-grams it is one window. A text without
    tokens, or null, has an empty fingerprint.
    """
    if k < 1 or window < 1:
        raise ValueError("k and window start at 1")

    def chosen(tokens: Column, count: Column) -> Column:
        grams = F.greatest(count - k + 1, F.lit(1))
        windows = F.greatest(grams - window + 1, F.lit(1))

        def run(start: Column) -> Column:
            last = F.least(start + (RUN + window - 2), grams - 1)
            packed = F.transform(F.sequence(start, last), lambda i: _gram(tokens, i, k, 0) * F.lit(_PLACE) - i)
            mine = F.least(F.lit(RUN), windows - start)
            return F.array_distinct(F.slice(let(packed, lambda p: _sliding_least(p, window)), F.lit(1), mine))

        return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), windows - 1, F.lit(RUN)), run)))

    def marked(tokens: Column, picked: Column) -> Column:
        places = F.transform(picked, lambda v: F.pmod(-v, F.lit(_PLACE)).cast("int"))
        first = F.transform(picked, lambda v: F.shiftright(v + F.pmod(-v, F.lit(_PLACE)), 32))
        both = let(
            places,
            lambda p: F.struct(
                p.alias("positions"), F.zip_with(first, p, lambda a, at: a * F.lit(1 << 30) + _gram(tokens, at, k, 1)).alias("hashes")
            ),
        )
        return both

    def of_tokens(tokens: Column) -> Column:
        padded = F.concat(tokens, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(k) - F.size(tokens), F.lit(0))))
        nothing = F.struct(F.array().cast("array<int>").alias("positions"), F.array().cast("array<bigint>").alias("hashes"))
        full = let(padded, lambda p: let(chosen(p, F.size(tokens)), lambda picked: marked(p, picked)))
        return F.when(F.size(tokens) == 0, nothing).otherwise(full)

    return let(token_hashes(F.coalesce(text, F.lit(""))), of_tokens)


def likeness(a: Column, b: Column) -> Column:
    """Distinct hashes in both over those in either; two empty fingerprints are alike."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(mark: Column) -> Column:
    """``position:hash`` (decimal, hexadecimal) of each chosen k-gram, joined by commas."""
    pair = F.zip_with(mark["positions"], mark["hashes"], lambda p, h: F.concat(p.cast("string"), F.lit(":"), F.lower(F.hex(h))))
    return F.array_join(pair, ",")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """(id, n_chars, positions, hashes) per document: ``fingerprint`` of every whole text, where it is scanned.

    Null texts are empty; repeated rows and null ids have a row each; an empty table gives an
    empty result. Extra columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("n_chars"), fingerprint(text, k, window).alias("mark"))
    return marked.select(F.col("id").alias(id_col), "n_chars", "mark.positions", "mark.hashes")


def followers(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(g, z, h, n_chars, times, next_g, next_z, next_h): the document after each one in the order of (id, text hash).

    ``docs`` has (id, g, z, h, n_chars); equal keys are one document with repeats, of which
    all but the last are followed by an equal one. After the last document comes the
    first. Only keys move; they are cut into ranges, and a range's last key meets
    the first one of the next range in a table with one row per range.
    """
    keys = stage(docs.groupBy("g", "z", "h", "id").agg(F.first("n_chars").alias("n_chars"), F.count("*").alias("copies")), "keys")
    ranges = max(1, -(-keys.count() // rows_per_range))
    dealt = keys.repartitionByRange(ranges, "z", "id", "h").withColumn("range", F.spark_partition_id())
    dealt = stage(dealt.withColumn("key", F.struct("g", "z", "h")), "ranges")
    here = Window.partitionBy("range").orderBy("z", "id", "h")
    ends = dealt.groupBy("range").agg(F.min(F.struct("z", "id", "h", "g")).alias("first"))
    every = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = ends.select(
        F.col("range").alias("_range"),
        F.coalesce(F.lead("first").over(Window.orderBy("range")), F.first("first").over(every)).alias("_first"),
    )
    found = dealt.withColumn("next", F.lead("key").over(here)).join(F.broadcast(after), F.col("range") == F.col("_range"))
    following = F.coalesce("next", F.struct("_first.g", "_first.z", "_first.h"))
    last = F.struct(F.lit(1).cast("long").alias("times"), following.alias("follower"))
    same = F.struct((F.col("copies") - 1).alias("times"), F.col("key").alias("follower"))
    cases = F.when(F.col("copies") > 1, F.array(last, same)).otherwise(F.array(last))
    pairs = found.select("g", "z", "h", "n_chars", F.explode(cases).alias("case"))
    pairs = pairs.select("g", "z", "h", "n_chars", "case.times", *[F.col(f"case.follower.{c}").alias(f"next_{c}") for c in "gzh"])
    return stage(pairs, "followers")


def edited_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    window: int = WINDOW,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter (rounded down) of code points replaced by as many
    from the start of the next document by id, or by all of a shorter one; the first
    document follows the last. ``near_*`` are the ``likeness`` of fingerprints.

    Texts are shuffled once, by document, with equal documents combined before; that
    exchange is read twice, first to send each document's start and hashes to the
    one before it, then to meet what has arrived. A fingerprint is larger than what it costs
    to make it again, so the own one is made on both occasions and not shuffled with the text.

    A null text is empty. A null id comes after all others; documents with equal ids follow
    each other in the order of a hash of their text, and a repeated row is followed by its equal. What a
    text takes in its task is some five times its size, as runs of its windows are handled one after
    the other. An empty table gives an empty result; extra columns are not looked at, whatever they are called.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("g"),
        F.col(id_col).isNull().alias("z"),
        F.xxhash64(text).alias("h"),
        text.alias("text"),
    )
    pairs = followers(keyed.select("id", "g", "z", "h", F.length("text").alias("n_chars")), rows_per_range)
    whole = keyed.groupBy("g", "z", "h").agg(F.first(F.struct("id", "text")).alias("doc"))

    other = whole.select(*[F.col(c).alias(f"next_{c}") for c in "gzh"], "doc")
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    sent = pairs.join(other, ["next_g", "next_z", "next_h"]).select(
        "g", "z", "h", "times", "n_chars",
        F.substring(F.col("doc.text"), F.lit(1), cut).alias("start"),
        fingerprint(F.col("doc.text"), k, window)["hashes"].alias("next_hashes"),
    )
    met = sent.join(whole, ["g", "z", "h"])
    edited = F.concat(F.substring(F.col("doc.text"), F.lit(1), F.col("n_chars") - cut), F.col("start"))
    met = met.select("times", "n_chars", "next_hashes", F.col("doc.id").alias("id"), F.col("doc.text").alias("text"), edited.alias("edited"))
    met = met.withColumns({"mark": fingerprint(F.col("text"), k, window), "edited_mark": fingerprint(F.col("edited"), k, window)})
    rows = met.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("mark")).alias("fingerprint"),
        as_text(F.col("edited_mark")).alias("edited_fingerprint"),
        likeness(F.col("mark.hashes"), F.col("edited_mark.hashes")).alias("near_edited"),
        likeness(F.col("mark.hashes"), F.col("next_hashes")).alias("near_next"),
        "times",
    )
    return _repeated(rows)


def _repeated(rows: DataFrame) -> DataFrame:
    """Every row ``times`` times, by two explosions of bounded length each per step."""
    lots = rows.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / REPEAT))))
    left = F.least(F.lit(REPEAT).cast("long"), F.col("times") - F.col("_lot") * REPEAT)
    return lots.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("times", "_lot", "_copy")

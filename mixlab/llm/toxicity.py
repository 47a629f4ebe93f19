"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

A word's embedding is the sum of rows of one hashed table, for the word and for its
beginnings, so that inflected and unseen forms share a part of it. Filters of several
widths slide over the words; each document keeps the largest response of every filter,
and a logistic unit turns these into a score. Training is numpy on the driver over a
bounded sample of labelled rows; scoring reads every word of every text in the tasks.
Calibration and thresholds come from all labelled rows that are not held out, each scored
by a model that was not fitted on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlab.llm import bitmaps
from mixlab.llm.text import Words, chunks, give_back, mix, string_buffers, trim
from mixlab.session import stage

BUCKETS = 1 << 16
DIM = 8
FILTERS = 4
WIDTHS = (1, 2, 3)
BEGINNINGS = (4, 6, 8)
PADS = 3
# The bound of the training sample: labelled rows of each class, the first by a hash of the id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1200, 2400
# Its bound in bytes of text per class; a text of more than a sixteenth of it is not fitted (but scored and counted).
TOXIC_BYTES, CLEAN_BYTES = 8 << 20, 16 << 20
EPOCHS = 5
# Small samples are gone through more often, to so many steps.
LEAST_STEPS = 300
# Words whose temporary arrays are held at once while the sample is counted (those of one document at least).
WORDS_AT_ONCE = 1 << 18
# Parts of the sample that are scored by a model fitted on the others, and places per unit of the logit in the counts.
FOLDS = 5
CUTS, MOST_LOGIT = 64, 40

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


class Letters(Words):
    """Words of ASCII letters, digits and all other characters; punctuation parts them as space does."""

    separators = ~_LETTER


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word among the distinct ones, and the distinct words' table rows."""
    codes, _, rows = _distinct(words)
    return codes, rows


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``features`` with the distinct words' hashes in between."""
    codes, distinct = pd.factorize(words.hashes())
    first = np.zeros(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    starts, ends = words.starts[first], words.ends[first]
    rows = [distinct]
    for length in BEGINNINGS:
        stops = np.minimum(starts + length, ends)
        rows.append(_short_hash(words.data, starts, stops, length))
    salted = [mix(r + np.uint64(k)) & np.uint64(BUCKETS - 1) for k, r in enumerate(rows)]
    return codes, distinct, np.stack(salted, axis=1).astype(np.int32)


def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``features`` of all texts, and the place of each text's first word; only one chunk's words are spelt out at a time."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    codes, hashes, rows, counts = [], [np.zeros(0, np.uint64)], [np.zeros((0, 1 + len(BEGINNINGS)), np.int32)], [np.zeros(1, np.int64)]
    for _, data, offsets in chunks(batch, "text"):
        words = Letters(data, offsets, lower=True)
        own, distinct, spots = _distinct(words)
        codes.append(own.astype(np.int32))
        hashes.append(distinct)
        rows.append(spots)
        counts.append(words.counts())
    # Chunks come in order, so the distinct words keep the order of their first appearance.
    place, distinct = pd.factorize(np.concatenate(hashes))
    first = np.zeros(len(distinct), np.int64)
    first[place[::-1]] = np.arange(len(place))[::-1]
    at = 0
    for k, own in enumerate(codes):
        codes[k] = place[at + own].astype(np.int32)
        at += len(hashes[k + 1])
    return np.concatenate([np.zeros(0, np.int32), *codes]), np.concatenate(rows)[first], np.cumsum(np.concatenate(counts))


def _short_hash(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, length: int) -> np.ndarray:
    """Hash of up to ``length`` bytes from each start."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(length):
        inside = starts + k < stops
        byte = data[np.minimum(starts + k, len(data) - 1)].astype(np.uint64) + np.uint64(1) if len(data) else np.zeros(0, np.uint64)
        out = out * np.uint64(257) + np.where(inside, byte, np.uint64(0))
    return mix(out)


@dataclass
class Model:
    """Embedding table, filters (DIM x all taps of all widths), biases, output weights, and the calibration."""

    table: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    @staticmethod
    def taps() -> list[tuple[int, int]]:
        """(width, tap) of each block of FILTERS columns."""
        return [(w, k) for w in WIDTHS for k in range(w)]

    def embed(self, rows: np.ndarray) -> np.ndarray:
        found = self.table[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            found = found + self.table[rows[:, k]]
        return found

    def pooled(self, taps: np.ndarray, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest response of every filter per document; with the padded codes and the documents' starts in them.

        ``taps`` holds the responses of each distinct word to every tap; its last row is the
        padding. Every document is followed by padding, so that each filter has a place
        even in a document without words.
        """
        counts = np.diff(first)
        begins = first[:-1] + PADS * np.arange(len(counts))
        wide = np.full(len(codes) + PADS * len(counts), len(taps) - 1, np.int64)
        wide[np.arange(len(codes)) + PADS * np.repeat(np.arange(len(counts)), counts)] = codes
        edges = np.stack([begins, begins + counts + 1], axis=1).ravel()
        best, column = [], 0
        for width in WIDTHS:
            response = np.take(np.ascontiguousarray(taps[:, column : column + FILTERS]), wide, axis=0)
            column += FILTERS
            for k in range(1, width):
                response[:-k] += np.take(np.ascontiguousarray(taps[:, column : column + FILTERS]), wide[k:], axis=0)
                column += FILTERS
            best.append(np.maximum.reduceat(response, edges, axis=0)[::2])
        return np.concatenate(best, axis=1), wide, begins

    def logits(self, words: Words) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(words.first) - 1, self.constant)
        codes, rows = features(words)
        # In double precision and back, so that a text's score does not depend on the texts beside it.
        taps = (self.embed(rows).astype(np.float64) @ self.filters.astype(np.float64)).astype(np.float32)
        taps = np.concatenate([taps, np.zeros((1, taps.shape[1]), np.float32)])
        best, _, _ = self.pooled(taps, codes, words.first)
        return (np.maximum(best + self.bias, 0).astype(np.float64) * self.output[:-1]).sum(axis=1) + self.output[-1]

    def scores(self, words: Words) -> np.ndarray:
        """0 to 1; a document without words is not toxic."""
        return np.where(words.counts() > 0, self.calibrated(self.logits(words)), 0.0)

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -40, 40)))


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5, batch: int = 48, rate: float = 0.08) -> Model:
    """Fit by Adagrad on the logistic loss; one class alone gives a constant score.

    Embeddings start from the log-odds of their buckets over the sample's documents, in
    one dimension, and noise in the others.
    """
    labels = np.asarray(labels, np.float64)
    if len(set(labels.tolist())) < 2:
        return Model(*[np.zeros(0)] * 4, constant=30.0 if len(labels) and labels[0] else -30.0)
    draw = np.random.default_rng(seed)
    codes, rows, starts = encoded(texts)
    seen = np.zeros((2, BUCKETS))
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + WORDS_AT_ONCE, "right")) - 1)
        owner = np.repeat(np.arange(low, high), np.diff(starts[low : high + 1]))
        pairs = np.unique(owner * np.int64(len(rows)) + codes[starts[low] : starts[high]])
        doc, code = pairs // max(len(rows), 1), pairs % max(len(rows), 1)
        for k in range(rows.shape[1]):
            spot = np.unique(doc * np.int64(BUCKETS) + rows[code, k])
            np.add.at(seen, (labels[spot // BUCKETS].astype(int), spot % BUCKETS), 1)
        low = high
    share = (seen + 0.5) / (np.array([[np.sum(labels == 0)], [np.sum(labels == 1)]]) + 1.0)
    odds = np.log(share[1] / share[0]) * (seen.sum(axis=0) >= 3)
    table = (0.05 * draw.standard_normal((BUCKETS, DIM))).astype(np.float32)
    table[:, 0] = 0.3 * odds
    taps = Model.taps()
    filters = (0.2 * draw.standard_normal((DIM, FILTERS * len(taps)))).astype(np.float32)
    filters[0, : FILTERS // 2] = 1.0
    model = Model(table, filters, np.zeros(FILTERS * len(WIDTHS), np.float32), np.concatenate([0.3 * draw.random(FILTERS * len(WIDTHS)), [-1.0]]).astype(np.float32))
    powers = [np.zeros_like(x) for x in (model.table, model.filters, model.bias, model.output)]
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))

    def step(which: int, value: np.ndarray, gradient: np.ndarray) -> None:
        powers[which] += gradient**2
        value -= (rate * gradient / (np.sqrt(powers[which]) + 1e-6)).astype(np.float32)

    for _ in range(max(epochs, -(-LEAST_STEPS // -(-len(texts) // batch)))):
        order = draw.permutation(len(texts))
        for low in range(0, len(order), batch):
            docs = order[low : low + batch]
            parts = [codes[starts[d] : starts[d + 1]] for d in docs]
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            used, own = np.unique(np.concatenate(parts), return_inverse=True)
            embedded = model.embed(rows[used])
            responses = np.concatenate([embedded @ model.filters, np.zeros((1, model.filters.shape[1]), np.float32)])
            best, wide, begins = model.pooled(responses, own, first)
            open_ = np.maximum(best + model.bias, 0)
            score = 1 / (1 + np.exp(-np.clip(open_ @ model.output[:-1] + model.output[-1], -40, 40)))
            error = ((score - labels[docs]) * weight[docs] / len(docs)).astype(np.float32)
            back = error[:, None] * model.output[None, :-1] * (open_ > 0)
            to_output = np.concatenate([error @ open_, [error.sum()]])
            to_filters, to_words = np.zeros_like(model.filters), np.zeros((len(used), DIM), np.float32)
            column = 0
            for w, width in enumerate(WIDTHS):
                columns = [slice(column + FILTERS * k, column + FILTERS * (k + 1)) for k in range(width)]
                column += FILTERS * width
                for i in np.flatnonzero(back[:, w * FILTERS : (w + 1) * FILTERS].any(axis=1)):
                    span = wide[begins[i] : begins[i] + first[i + 1] - first[i] + 1 + width]
                    response = sum(responses[span[k : len(span) - width + k], c] for k, c in enumerate(columns))
                    at = response.argmax(axis=0)
                    flow = back[i, w * FILTERS : (w + 1) * FILTERS]
                    for k, c in enumerate(columns):
                        hit = span[at + k]
                        real = np.flatnonzero((hit < len(used)) & (flow != 0))
                        cols = np.arange(c.start, c.stop)[real]
                        to_filters[:, cols] += embedded[hit[real]].T * flow[real]
                        np.add.at(to_words, hit[real], flow[real, None] * model.filters[:, cols].T)
            touched = np.flatnonzero(to_words.any(axis=1))
            spots = rows[used[touched]]
            flat, place = np.unique(spots, return_inverse=True)
            gradient = np.zeros((len(flat), DIM), np.float32)
            place = place.reshape(spots.shape)
            for k in range(spots.shape[1]):
                np.add.at(gradient, place[:, k], to_words[touched])
            powers[0][flat] += gradient**2
            model.table[flat] -= rate * gradient / (np.sqrt(powers[0][flat]) + 1e-6)
            step(1, model.filters, to_filters)
            step(2, model.bias, back.sum(axis=0))
            step(3, model.output, to_output)
    return model


def calibrate(model: Model, raw: np.ndarray, labels: np.ndarray, toxic_share: float, counts: np.ndarray | None = None) -> None:
    """Fit scale and shift of the logit to labels of rows the logits were not fitted on, weighted to the real share of toxic rows.

    ``counts`` says how many rows each logit stands for.
    """
    if model.constant is not None or len(set(labels.tolist())) < 2:
        return
    counts = np.ones(len(raw)) if counts is None else counts
    real = np.average(labels, weights=counts)
    weight = counts * np.where(labels == 1, toxic_share / real, (1 - toxic_share) / (1 - real))
    centre = float(np.average(raw, weights=counts))
    spread = float(np.sqrt(np.average((raw - centre) ** 2, weights=counts))) or 1.0
    x = np.stack([(raw - centre) / spread, np.ones(len(raw))], axis=1)
    target = np.where(labels == 1, 0.995, 0.005)
    beta = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta -= np.clip(np.linalg.solve(hessian, gradient), -1, 1)
    model.scale = float(beta[0] / spread)
    model.shift = float(beta[1] - beta[0] * centre / spread)


def best_threshold(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the best F1, in the middle of the gap it lies in."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum((labels * weight)[order])
    taken = np.cumsum(weight[order])
    ranked = scores[order]
    ends = np.flatnonzero(np.append(ranked[1:] < ranked[:-1], True))
    value = 2 * hits[ends] / (taken[ends] + (labels * weight).sum())
    at = ends[int(np.argmax(value))]
    below = ranked[at + 1] if at + 1 < len(ranked) else 0.0
    return float((ranked[at] + below) / 2)


LEAST_PER_LANGUAGE = 20


def thresholds(scores: np.ndarray, labels: np.ndarray, langs: list, toxic_share: float, counts: np.ndarray | None = None) -> dict:
    """A threshold per language; key None holds the one for languages with few examples of either class.

    ``counts`` says how many rows each score stands for.
    """
    if len(set(labels.tolist())) < 2:
        return {None: 0.5}
    counts = np.ones(len(scores)) if counts is None else counts
    real = np.average(labels, weights=counts)
    weight = counts * np.where(labels == 1, toxic_share / real, (1 - toxic_share) / (1 - real))
    out = {None: best_threshold(scores, labels, weight)}
    names = np.array([x or "" for x in langs])
    for name in sorted(set(names.tolist()) - {""}):
        own = names == name
        if min((labels * counts)[own].sum(), ((1 - labels) * counts)[own].sum()) >= LEAST_PER_LANGUAGE:
            out[name] = best_threshold(scores[own], labels[own], weight[own])
    return out


def held_out(id_col: str = "doc_id"):
    """The rows whose labels are never read: crc32 of the id as text leaves 2 modulo 4."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _per_text(model, method: str):
    """A column function: the ``method`` ("scores" or "logits") of the broadcast model for every text."""

    def values(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        give_back()
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string(), from_pandas=True)], names=["text"])
            parts = [getattr(model.value, method)(Letters(data, offsets, lower=True)) for _, data, offsets in chunks(batch, "text")]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))
        give_back()

    return F.pandas_udf(values, "double")


def _cross_fitted(spark, texts: list[str], marks: np.ndarray) -> np.ndarray:
    """The logit of every sample row by a model fitted on the other folds, one task each; both classes are dealt to all folds."""
    folds = min(FOLDS, int(marks.sum()), int((1 - marks).sum()))
    fold = np.zeros(len(marks), np.int64)
    for mark in (0, 1):
        own = np.flatnonzero(marks == mark)
        fold[own] = np.arange(len(own)) % folds
    shared = spark.sparkContext.broadcast((texts, marks, fold))

    def out_of_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks, fold = shared.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                model = train([t for t, f in zip(texts, fold) if f != k], marks[fold != k])
                own = np.flatnonzero(fold == k)
                raw = model.logits(Letters(*string_buffers(pa.array([texts[i] for i in own], pa.large_string())), lower=True))
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(raw.astype(np.float64))], names=["at", "raw"])

    rows = spark.range(0, folds, 1, folds).mapInArrow(out_of_fold, "at long, raw double").collect()
    shared.destroy()
    out = np.zeros(len(marks))
    out[[r["at"] for r in rows]] = [r["raw"] for r in rows]
    return out


def _place(raw):
    """A logit's place in the counts."""
    return F.floor(F.greatest(F.least(raw, F.lit(float(MOST_LOGIT))), F.lit(float(-MOST_LOGIT))) * CUTS).cast("long")


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", toxic_bytes: int = TOXIC_BYTES, clean_bytes: int = CLEAN_BYTES) -> tuple[Model, dict]:
    """Model from at most ``toxic`` + ``clean`` labelled rows; calibration and thresholds by language from all of them.

    The rows fitted are the first by a hash of the id among those not held out, without texts of
    more than a sixteenth of ``toxic_bytes`` or ``clean_bytes``, and as long as the texts of
    their class have no more bytes together: these texts alone reach the driver and are
    broadcast. All rows
    not held out are then scored, those of the sample by models fitted on its other folds,
    and counted by language, label and finely cut logit; the counts alone reach the driver:
    5,121 places at most per label and language that has a threshold of its own. Rows that
    repeat an id are used once; null labels are not used. With less than two rows of a
    class there is nothing to calibrate on.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.nullif(F.col(lang_col).cast("string"), F.lit("")).alias("_lang"))
    usable = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(id_col))
    usable = usable.groupBy(F.col(id_col).cast(rows.schema["_id"].dataType).alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
    order = F.xxhash64("_id")
    chosen = usable.where("_toxic = 1").orderBy(order, "_id").limit(toxic).unionByName(usable.where("_toxic = 0").orderBy(order, "_id").limit(clean))
    chosen = stage(chosen, "sample")
    found = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_toxic").agg(F.min(F.struct("_text", "_lang")).alias("_row"))
    found = stage(found.select("_id", "_toxic", "_row.*"), "found")
    # At most the sample's number of rows per class, so one task may sum their sizes.
    sizes = found.select("_id", "_toxic", F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long").alias("_bytes"))
    bound = F.when(F.col("_toxic") == 1, F.lit(toxic_bytes)).otherwise(F.lit(clean_bytes))
    so_far = F.sum("_bytes").over(W.partitionBy("_toxic").orderBy(order, "_id").rowsBetween(W.unboundedPreceding, 0))
    fitted = sizes.where(F.col("_bytes") * 16 <= bound).withColumn("_sum", so_far).where(F.col("_sum") <= bound)
    chosen = stage(fitted.select("_id", "_toxic"), "sample")
    held = sorted(found.join(F.broadcast(chosen), ["_id", "_toxic"], "left_semi").collect(), key=lambda r: r["_id"])
    marks = np.array([r["_toxic"] for r in held], np.float64)
    texts, langs = [r["_text"] or "" for r in held], [r["_lang"] for r in held]
    del held
    model = train(texts, marks)
    trim()
    if min(marks.sum(), (1 - marks).sum()) < 2:
        return model, {None: 0.5}
    raw = _cross_fitted(spark, texts, marks)
    # The driver lives on: what fitting took goes back, or it would stay beside the later steps.
    del texts
    give_back()
    sampled = spark.createDataFrame([(lang, int(mark), float(x)) for lang, mark, x in zip(langs, marks, raw)], "_lang string, _toxic int, _raw double")

    # Texts stay where they are scanned: a bitmap picks those to score, and only logits are joined with the labels.
    others = stage(usable.join(F.broadcast(chosen.select("_id")), "_id", "left_anti"), "others")
    labelled = bitmaps.mark(rows, F.xxhash64("_id"), bitmaps.bitmap(others, F.xxhash64("_id")), "_maybe").where("_maybe")
    scored = labelled.select("_id", "_lang", _per_text(spark.sparkContext.broadcast(model), "logits")("_text").alias("_raw")).join(others, "_id")
    scored = scored.groupBy("_id", "_toxic").agg(F.min(F.struct("_raw", "_lang")).alias("_row")).select("_row._lang", "_toxic", "_row._raw")
    cut = sampled.unionByName(scored).groupBy("_lang", "_toxic", _place(F.col("_raw")).alias("_at"))
    counts = stage(cut.agg(F.count("*").alias("_rows")), "counts")
    enough = F.least(F.sum(F.col("_rows") * F.col("_toxic")), F.sum(F.col("_rows") * (1 - F.col("_toxic")))) >= LEAST_PER_LANGUAGE
    own = counts.where("_lang is not null").groupBy("_lang").agg(enough.alias("_own")).where("_own")
    seen = counts.join(own, "_lang", "left").groupBy(F.when(F.col("_own"), F.col("_lang")).alias("_lang"), "_toxic", "_at").agg(F.sum("_rows").alias("_rows")).collect()

    sums: dict[tuple[int, int], int] = {}
    for r in seen:
        sums[r["_toxic"], r["_at"]] = sums.get((r["_toxic"], r["_at"]), 0) + r["_rows"]
    keys = sorted(sums)
    flags, places = np.array(keys, np.float64).T
    number = np.array([sums[k] for k in keys], np.float64)
    share = float(np.average(flags, weights=number))
    calibrate(model, (places + 0.5) / CUTS, flags, share, number)
    seen.sort(key=lambda r: (r["_lang"] or "", r["_toxic"], r["_at"]))
    logits = (np.array([r["_at"] for r in seen]) + 0.5) / CUTS
    return model, thresholds(model.calibrated(logits), np.array([r["_toxic"] for r in seen], np.float64), [r["_lang"] for r in seen], share, np.array([r["_rows"] for r in seen], np.float64))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **sample: int) -> DataFrame:
    """The documents' rows with score (0 to 1) and rejected (whether it reaches the language's threshold).

    Only the text enters the score; the language selects the threshold. Null and empty
    texts and texts without words score 0. Labels
    of one class only, or none, give a constant score. Repeated rows get equal scores. An
    empty table gives an empty result. All columns are kept; ``score`` and ``rejected``
    must not be among them.
    """
    model, limits = fit(docs, labels, id_col=id_col, text_col=text_col, lang_col=lang_col, **sample)
    scorer = _per_text(docs.sparkSession.sparkContext.broadcast(model), "scores")
    limit = F.lit(limits[None])
    for name, value in limits.items():
        if name is not None:
            limit = F.when(F.col(lang_col) == name, value).otherwise(limit)
    return docs.withColumn("score", scorer(F.col(text_col))).withColumn("rejected", F.col("score") >= limit)

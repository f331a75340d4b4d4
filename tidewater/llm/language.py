"""Language identification with error-correcting output codes.

Every learned language gets a binary codeword; one classifier per bit tells, from
hashed byte n-grams of the lower-cased text, whether the bit is set. Decoding
sums a logistic loss over the bits, each weighted by how well it separates, and
takes the codeword of least loss; a small lead over the second one is flagged.

Learning covers every row given: n-grams are counted per language in the tasks
and summed, so only (languages x buckets) counts reach the driver.

Defined results: null text or a text without a letter is ``und`` with score 0;
no learned language at all makes every text ``und``; with a single language all
texts with letters get it; equal losses go to the first name; repeated rows
and null ids give one row each; an empty table gives none; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, joined_bytes, lowered, sliced

PAIRS, BUCKETS = 2048, 8192
#: Rows whose counts are held at once.
ROWS = 256
#: Lead in probability over the second codeword below which a result is ambiguous.
LEAD = 0.2
UNKNOWN = "und"
#: N-grams from which on an ambiguous text is rejected by ``told_apart``.
EVIDENCE = 64

#: ASCII letters and all bytes of longer characters stand; the rest is a blank.
_BYTE = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def ngram_counts(column: pa.Array) -> np.ndarray:
    """(rows x BUCKETS) counts of hashed byte pairs and triples within each text."""
    data, bounds = joined_bytes(lowered(column))
    n = len(bounds) - 1
    code = _BYTE[data]
    row = np.repeat(np.arange(n), np.diff(bounds))
    total = np.zeros(n * BUCKETS, np.int64)
    pair = code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA6B)
    for width, low, high in ((2, 0, PAIRS), (3, PAIRS, BUCKETS)):
        if len(data) < width:
            continue
        h = pair if width == 2 else pair[:-1] * np.uint32(0xC2B2AE35) + code[2:] * np.uint32(0x27D4EB2F)
        h = h ^ (h >> np.uint32(15))
        h = h * np.uint32(0x2C1B3C6D)
        bucket = low + ((h >> np.uint32(8)) % np.uint32(high - low)).astype(np.int64)
        blank = code[width // 2 : width // 2 + len(h)] == 32  # n-grams around a letter only
        ok = (row[: len(h)] == row[width - 1 :]) & ~blank
        total += np.bincount(row[: len(h)][ok] * BUCKETS + bucket[ok], minlength=n * BUCKETS)
    return total.reshape(n, BUCKETS)


def codewords(n: int) -> np.ndarray:
    """(n x bits) of -1 and 1: all distinct splits for few languages, else the
    best of seeded draws by smallest distance between two rows."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1))
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1.0, -1.0)
    rng, bits = np.random.default_rng(n), max(24, int(np.ceil(8 * np.log2(n))))
    best, most = None, -1
    for _ in range(64):
        draw = rng.choice([-1.0, 1.0], (n, bits))
        apart = (bits - draw @ draw.T) / 2 + bits * np.eye(n)
        if apart.min() > most and (np.abs(draw.sum(axis=0)) < n).all():
            best, most = draw, apart.min()
    return best


class Model:
    """Bit classifiers and codewords, from n-gram counts per language."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.names = sorted(counts)
        self.words = codewords(len(self.names))
        share = np.stack([counts[k] + 0.5 for k in self.names]) if self.names else np.ones((0, BUCKETS))
        share = share / share.sum(axis=1, keepdims=True)
        self.weights = np.zeros((BUCKETS, self.words.shape[1]))
        self.trust = np.ones(self.words.shape[1])
        if len(self.names) > 1:
            for b, bit in enumerate(self.words.T):
                one, zero = share[bit > 0].mean(axis=0), share[bit < 0].mean(axis=0)
                self.weights[:, b] = np.log(one / zero)
                self.trust[b] = ((one - zero) * self.weights[:, b]).sum()  # symmetric divergence of the two sides
            self.trust /= self.trust.mean()

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability and ambiguity of each row of counts."""
        n = counts.sum(axis=1)
        if not self.names:
            return [UNKNOWN] * len(n), np.zeros(len(n)), np.zeros(len(n), bool)
        margin = (counts @ self.weights) / np.maximum(n, 1)[:, None] * (np.minimum(n, 64) / 4)[:, None]
        loss = np.zeros((len(n), len(self.names)))
        for k, word in enumerate(self.words):
            loss[:, k] = (self.trust * np.logaddexp(0, -word * margin)).sum(axis=1)
        chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        top = np.sort(chance, axis=1)
        second = top[:, -2] if len(self.names) > 1 else np.zeros(len(n))
        return [self.names[b] for b in best], top[:, -1], top[:, -1] - second < LEAD


def fit(labelled: DataFrame) -> Model:
    """Learn from all rows of (text, lang); rows with a null in either are left out."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for part in _few(batches, "text"):
            counts = ngram_counts(part.column("text"))
            names = np.array(part.column("lang").to_pylist(), object)
            for name in set(names):
                total[name] = total.get(name, 0) + counts[names == name].sum(axis=0)
        for name, value in total.items():
            used = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used)), pa.array(used, pa.int64()), pa.array(value[used], pa.int64())], ["lang", "bucket", "n"])

    rows = labelled.select("text", "lang").where("text is not null and lang is not null").mapInArrow(count, "lang string, bucket bigint, n bigint")
    counts: dict[str, np.ndarray] = {}
    for r in rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r["lang"], np.zeros(BUCKETS))[r["bucket"]] = r["n"]
    return Model(counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of (doc_id, held_out, text) rows."""

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _few(batches, "text"):
            lang, score, unsure, _ = _told(part.column("text"), model)
            columns = [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(tell, "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean")


def told_apart(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that have a language, all columns kept.

    Those go that are ``und``, and those that stay ambiguous although at least
    ``EVIDENCE`` n-grams speak; of a shorter text doubt says little.
    """
    text_at = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _few(batches, text_at):
            lang, _, unsure, n = _told(part.column(text_at), model)
            ok = (np.array(lang, object) != UNKNOWN) & ~(unsure & (n >= EVIDENCE))
            yield part.take(pa.array(np.flatnonzero(ok)))

    return docs.mapInArrow(keep, docs.schema)


def _few(batches: Iterable[pa.RecordBatch], column: str | int) -> Iterator[pa.RecordBatch]:
    for part in sliced(batches, column):
        for at in range(0, part.num_rows, ROWS):
            yield part.slice(at, ROWS)


def _told(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    counts = ngram_counts(texts)
    lang, score, unsure = model.predict(counts)
    plain = np.array([_has_letter(t) for t in texts], bool)
    return [x if ok else UNKNOWN for x, ok in zip(lang, plain, strict=True)], np.where(plain, score, 0.0), unsure & plain, counts.sum(axis=1)


def _has_letter(value: pa.Scalar) -> bool:
    text = value.as_py()
    return bool(text) and any(map(str.isalpha, text))


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: a language, and not held out."""
    return docs.where(F.col("lang").isNotNull() & (id_remainder(4) != 2)).select("text", "lang")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) for every row of ``docs``."""
    model = fit(training_rows(docs))
    held = F.coalesce(id_remainder(4) == 2, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(rows, model)


def with_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language can be told, learned from ``docs`` itself."""
    return told_apart(docs, fit(training_rows(docs)))

"""Quality classifier: hashed word n-gram logistic regression, FTRL-proximal.

Features of a text are the relative frequencies of hashed word pairs and single
words, and of runs of one to three word shapes (letter case, digits, length,
closing punctuation, repeat of the word before). Weights come from
follow-the-regularised-leader updates over a bounded sample of labelled rows
(``SAMPLE``, the rows of smallest id hash): ``SHARDS`` shards run in parallel
from a common state, and the states are averaged after each of ``ROUNDS``
rounds. A score is the logistic of one sparse dot product.

Defined results: a null or blank text has no features, its score comes from the
intercept; a doc with several labels counts with their mean (0.5 up: 1); no
labelled row at all gives 0.5 everywhere; repeated rows and null ids give one
row each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK_BYTE, id_remainder, id_text, joined_bytes, mix, run_hashes, sliced, words, written

DIMENSIONS = 1 << 16
SAMPLE = 20_000
SHARDS = 8
ROUNDS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.05
THRESHOLD = 0.3
#: Relative frequencies are scaled so that a feature in every tenth word weighs 1.
SCALE = 10.0

_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LOWER = np.array([97 <= b <= 122 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_OTHER = ~(_UPPER | _LOWER | _DIGIT) & (np.arange(256) < 128)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, words of the row) of every n-gram occurrence; bucket 0 is the intercept's."""
    data, bounds = joined_bytes(column)
    starts, ends, rows = words(data, bounds, ~BLANK_BYTE[data])
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(bounds) - 1, np.int64)
    h = run_hashes(data, starts, ends)
    cut = np.column_stack([starts, ends]).ravel()
    cut = cut[:-1] if cut[-1] == len(data) else cut
    some = [np.minimum(np.add.reduceat(kind[data].astype(np.int64), cut)[::2], 3) for kind in (_UPPER, _LOWER, _DIGIT, _OTHER)]
    same = np.zeros(len(h), np.int64)
    same[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    last = data[ends - 1]
    shape = same
    for s in (*some, np.minimum((ends - starts) // 6, 3), np.where(_OTHER[last], last, 0)):
        shape = shape * 131 + s
    shape = mix(shape.astype(np.uint64))
    out_rows, out_hash = [rows, rows], [h, mix(shape ^ np.uint64(0x5851F42D4C957F2D))]
    for sequence, width in ((h, 2), (shape, 2), (shape, 3)):
        if len(h) < width:
            continue
        roll = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            roll = roll * np.uint64(0x9E3779B97F4A7C15) + sequence[k : k + len(roll)]
        ok = rows[: len(roll)] == rows[width - 1 :]
        out_rows.append(rows[: len(roll)][ok])
        out_hash.append(mix(roll[ok] + np.uint64(width)))
    bucket = 1 + (np.concatenate(out_hash) % np.uint64(DIMENSIONS - 1)).astype(np.int64)
    return np.concatenate(out_rows), bucket, np.bincount(rows, minlength=len(bounds) - 1)


def ftrl(examples: Iterable[tuple[np.ndarray, np.ndarray, float]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass of FTRL-proximal updates of the state (z, n), in place."""
    for index, value, label in examples:
        g = value * (1 / (1 + np.exp(-np.dot(weights(z[index], n[index]), value))) - label)
        root = np.sqrt(n[index])
        n[index] += g * g
        z[index] += g - (np.sqrt(n[index]) - root) / ALPHA * weights(z[index], n[index] - g * g)


def _learner(z: np.ndarray, n: np.ndarray):
    """One shard's pass from the common state, in the order of the id hash."""

    def learn(key, rows):
        own_z, own_n = z.copy(), n.copy()
        rows = rows.sort_values(["place", "label"], kind="stable")
        ftrl(((np.append(np.asarray(b, np.int64), 0), np.append(v, 1.0), y) for b, v, y in zip(rows["bucket"], rows["value"], rows["label"], strict=True)), own_z, own_n)
        return pd.DataFrame({"shard": [key[0]], "z": [own_z.tobytes()], "n": [own_n.tobytes()]})

    return learn


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(labelled: DataFrame) -> np.ndarray:
    """Weights from (doc_id, text, label) rows; the bound on rows is the caller's."""

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            rows, bucket, n = features(part.column("text"))
            key, count = np.unique(rows * DIMENSIONS + bucket, return_counts=True)
            row, bucket = key // DIMENSIONS, key % DIMENSIONS
            value = count / np.maximum(n[row], 1) * SCALE
            at = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x)) for x in (bucket, value)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), *lists], ["doc_id", "label", "bucket", "value"])

    made = written(labelled.select("doc_id", "text", "label").mapInArrow(extract, "doc_id bigint, label double, bucket array<bigint>, value array<double>"), "quality-features")
    sharded = made.withColumn("place", F.xxhash64("doc_id")).withColumn("shard", F.pmod(F.shiftrightunsigned("place", 7), F.lit(SHARDS)).cast("int"))
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for _ in range(ROUNDS):
        learn = _learner(z, n)
        states = sorted(sharded.groupBy("shard").applyInPandas(learn, "shard int, z binary, n binary").collect(), key=lambda r: r["shard"])
        if not states:
            break
        z, n = (np.mean([np.frombuffer(r[c]) for r in states], axis=0) for c in ("z", "n"))
    return weights(z, n)


def score(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            rows, bucket, n = features(part.column("text"))
            total = np.bincount(rows, weights=model[bucket], minlength=part.num_rows) / np.maximum(n, 1) * SCALE + model[0]
            value = 1 / (1 + np.exp(-total))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    held = F.coalesce(id_remainder(5) == 0, F.lit(False))
    return id_text(docs).withColumn("held_out", held).mapInArrow(apply, "doc_id bigint, held_out boolean, score double, predicted int")


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` labelled ids outside the held-out fold, with their texts."""
    chosen = labels.where("doc_id is not null and quality is not null").where(id_remainder(5) != 0)
    chosen = chosen.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    return id_text(docs).join(F.broadcast(chosen), "doc_id")  # SAMPLE rows of two numbers at most


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(sample(docs, labels)))

"""Benchmark decontamination by spaced-seed hashing.

A leak is a run of ``WINDOW`` consecutive words of a benchmark item (all its
words, if it has fewer) that a document holds in place with at least
``SIMILARITY`` of the words equal, substitutions anywhere. Fixed masks hash only
some word positions of each window, chosen so that every tolerated pattern of
substitutions leaves at least one mask untouched: with e substitutions the
window is cut into e + 2 blocks, and each mask is a pair of blocks. Documents
and items that share a masked hash are aligned at the hit and verified word by
word, so no leak is missed and none is reported unverified.

The items' hashes go to every task while they are at most ``BROADCAST_SEEDS``
(counted first); beyond that a bit filter of bounded size goes there, and what passes
it meets the items in a shuffled join of hashes.

Words are lower-cased runs of letters, marks and digits of any script, so typography
(quotes, dashes, spaces of any kind) doesn't count; in scripts without spaces each
character is a word. Defined results: null and
empty texts and items of fewer than ``SHORTEST`` words match nothing; repeated
documents or items each give their rows (identical ones once); null ids are
carried; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, mix, sliced, word_hashes, written

WINDOW, SHORTEST, SIMILARITY = 13, 5, 0.8
#: 16 MB of hashes and as much of positions.
BROADCAST_SEEDS = 2_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def tolerated(m: int) -> int:
    """Most substitutions that leave at least ``SIMILARITY`` of ``m`` words."""
    return m - int(np.ceil(SIMILARITY * m - 1e-9))


def masks(m: int) -> list[np.ndarray]:
    """Word positions that each mask of an ``m``-word window looks at."""
    blocks = np.array_split(np.arange(m), tolerated(m) + 2)
    return [np.concatenate(pair) for pair in combinations(blocks, 2)]


def seeds(hashes: np.ndarray, bounds: np.ndarray, m: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, masked hashes) of every ``m``-word window within a row, mask by mask."""
    total = len(hashes) - m + 1
    if total <= 0:
        return
    at = np.arange(total)
    at = at[at + m <= bounds[np.searchsorted(bounds, at, side="right")]]
    for k, mask in enumerate(masks(m)):
        h = np.full(total, 64 * m + k, np.uint64)
        for p in mask:
            h = h * _STEP + hashes[p : p + total]
        yield at, mix(h)[at]


def agreement(document: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """(start in the document, words compared, words equal) where the two, laid
    at ``shift``, agree in some window; None if nowhere."""
    m = min(WINDOW, len(item))
    low, high = max(0, -shift), min(len(item), len(document) - shift)
    if high - low < m:
        return None
    same = np.cumsum(np.concatenate([[0], document[low + shift : high + shift] == item[low:high]]))
    good = np.flatnonzero(same[m:] - same[:-m] >= m - tolerated(m))
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + m
    return low + shift + first, last - first, int(same[last] - same[first])


class Benchmark:
    """Words and masked hashes of all items."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.names = [name for name, _ in rows]
        self.words, self.bounds = word_hashes(pa.array([text for _, text in rows], pa.string()))
        sizes = np.diff(self.bounds)
        self.lengths = sorted({min(int(s), WINDOW) for s in sizes if s >= SHORTEST})
        found_hash, found_at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for m in self.lengths:
            for at, h in seeds(self.words, self.bounds, m):
                size = sizes[np.searchsorted(self.bounds, at, side="right") - 1]
                own = np.minimum(size, WINDOW) == m
                found_hash.append(h[own])
                found_at.append(at[own])
        h, at = np.concatenate(found_hash), np.concatenate(found_at)
        order = np.argsort(h, kind="stable")
        self.hash, self.at = h[order], at[order]
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.hash & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def item(self, k: int) -> np.ndarray:
        return self.words[self.bounds[k] : self.bounds[k + 1]]

    def leaks(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, start, words compared, words equal) of every leak in ``texts``."""
        words, bounds = word_hashes(texts)
        tried: set[tuple[int, int, int]] = set()
        for m in self.lengths:
            for at, h in seeds(words, bounds, m):
                maybe = self.filter[(h & np.uint64((1 << 22) - 1)).astype(np.int64)]
                at, h = at[maybe], h[maybe]
                low, high = np.searchsorted(self.hash, h, side="left"), np.searchsorted(self.hash, h, side="right")
                for k in np.flatnonzero(high > low):
                    row = int(np.searchsorted(bounds, at[k], side="right")) - 1
                    for place in self.at[low[k] : high[k]]:
                        which = int(np.searchsorted(self.bounds, place, side="right")) - 1
                        tried.add((row, which, int(at[k] - bounds[row] - (place - self.bounds[which]))))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, which, shift in sorted(tried):
            found = agreement(words[bounds[row] : bounds[row + 1]], self.item(which), shift)
            if found and (row, which) not in best or found and found[2] > best[row, which][2]:
                best[row, which] = found
        for (row, which), found in best.items():
            yield row, which, *found


LEAK_SCHEMA = "doc_id bigint, item_id bigint, start bigint, n_words bigint, n_equal bigint"


def _leak_batch(docs: pa.Array, found: list[tuple], names: list) -> pa.RecordBatch:
    columns = [docs.take(pa.array([f[0] for f in found], pa.int64())), pa.array([names[f[1]] for f in found], pa.int64())]
    columns += [pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start", "n_words", "n_equal"])


def _by_broadcast(docs: DataFrame, items: DataFrame) -> DataFrame:
    model = Benchmark([(r["item_id"], r["text"]) for r in items.collect()])  # its size was counted

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            if found := list(model.leaks(part.column("text"))):
                yield _leak_batch(part.column("doc_id"), found, model.names)

    return id_text(docs).mapInArrow(find, LEAK_SCHEMA)


class SeedFilter:
    """Two bits for each hash of the benchmark: a hash whose bits are not both set is none of them."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for shift in (0, 31):
            at = (h >> np.uint64(shift)) & np.uint64(self.size - 1)
            out &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


#: Bits of the filter: 16 for each hash, in steps of two, and no more than these (128 MB).
MOST_BITS = 1 << 30
_CHUNK = 1 << 16


def seed_filter(seeds_of_items: DataFrame) -> SeedFilter:
    """Built in the tasks, chunk by chunk; what reaches the driver has a fixed bound."""
    n = seeds_of_items.count()
    size = min(MOST_BITS, max(_CHUNK, 1 << max(0, int(np.ceil(np.log2(16 * max(1, n)))))))
    places = F.array(F.col("seed").bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned("seed", 31).bitwiseAND(F.lit(size - 1)))
    places = seeds_of_items.select(F.explode(places).alias("at")).distinct()

    def chunk(frame: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(_CHUNK, np.uint8)
        flags[(frame["at"] % _CHUNK).to_numpy()] = 1
        return pd.DataFrame({"chunk": [int(frame["at"].iloc[0]) // _CHUNK], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

    bits = np.zeros(size // 8, np.uint8)
    for r in places.groupBy(F.floor(F.col("at") / _CHUNK).alias("c")).applyInPandas(chunk, "chunk bigint, bits binary").collect():
        bits[r["chunk"] * _CHUNK // 8 : (r["chunk"] + 1) * _CHUNK // 8] = np.frombuffer(r["bits"], np.uint8)
    return SeedFilter(bits, size)


def _seed_rows(texts: DataFrame, key: str, lengths: tuple[int, ...], own_only: bool, sent=None) -> DataFrame:
    """(seed, key) rows of every masked window of (key, text); with a filter in ``sent`` only of
    the windows that may meet the benchmark."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            words, bounds = word_hashes(part.column("text"))
            sizes = np.diff(bounds)
            for m in lengths:
                for at, h in seeds(words, bounds, m):
                    if sent is not None:
                        maybe = sent.value.may_hold(h)
                        at, h = at[maybe], h[maybe]
                    row = np.searchsorted(bounds, at, side="right") - 1
                    if own_only:
                        own = np.minimum(sizes[row], WINDOW) == m
                        row, h = row[own], h[own]
                    both = np.unique(np.column_stack([row.astype(np.uint64), h]), axis=0)
                    if len(both):
                        yield pa.RecordBatch.from_arrays([pa.array(both[:, 1].view(np.int64)), part.column(key).take(pa.array(both[:, 0].astype(np.int64)))], ["seed", key])

    return texts.select(key, "text").mapInArrow(emit, f"seed bigint, {key} bigint")


def _lengths(items: DataFrame) -> tuple[int, ...]:
    """The window lengths that items have: nine at most."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            sizes = np.diff(word_hashes(part.column("text"))[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.minimum(sizes[sizes >= SHORTEST], WINDOW)), pa.int64())], ["m"])

    return tuple(sorted(r["m"] for r in items.select("text").mapInArrow(measure, "m bigint").distinct().collect()))


def _by_join(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Both sides' hashes meet in a join; pairs of texts that share one are verified.

    A filter of the items' hashes goes to the tasks first, so that only windows that may meet the
    benchmark are shuffled, and only texts that do are fetched. Seeds that very many
    documents share are split by adaptive execution; each pair is verified once.
    """
    spark = docs.sparkSession
    docs = id_text(docs).where("text is not null").withColumn("doc_key", F.xxhash64("text"))
    items = items.where("text is not null").withColumn("item_key", F.xxhash64("text"))
    item_texts = written(items.groupBy("item_key").agg(F.first("text").alias("text")), "benchmark-texts")
    lengths = _lengths(item_texts)
    right = written(_seed_rows(item_texts, "item_key", lengths, True).distinct(), "benchmark-seeds")
    sent = spark.sparkContext.broadcast(seed_filter(right))
    left = _seed_rows(docs, "doc_key", lengths, False, sent)
    pairs = written(left.join(right, "seed").select("doc_key", "item_key").distinct(), "benchmark-pairs")
    doc_texts = docs.join(pairs.select("doc_key").distinct(), "doc_key", "left_semi").select("doc_key", "text").dropDuplicates(["doc_key"])
    pairs = pairs.join(doc_texts, "doc_key").join(item_texts.withColumnRenamed("text", "item_text"), "item_key")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            keys, found = [], []
            for k in range(part.num_rows):
                model = Benchmark([(0, part.column("item_text")[k].as_py())])
                for leak in model.leaks(part.column("text").slice(k, 1)):
                    keys.append(part.column("item_key")[k].as_py())
                    found.append((k, len(keys) - 1, *leak[2:]))
            if found:
                yield _leak_batch(part.column("doc_key"), found, keys).rename_columns(["doc_key", "item_key", "start", "n_words", "n_equal"])

    found = pairs.mapInArrow(verify, "doc_key bigint, item_key bigint, start bigint, n_words bigint, n_equal bigint")
    return found.join(docs.select("doc_key", "doc_id"), "doc_key").join(items.select("item_key", "item_id"), "item_key").select("doc_id", "item_id", "start", "n_words", "n_equal")


def leaks(docs: DataFrame, benchmark: DataFrame, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(doc_id, item_id, start, n_words, n_equal): every document and item with a leak.

    ``start`` is the first word of the agreeing stretch in the document,
    ``n_words`` its length in words and ``n_equal`` how many of them are equal.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    # at least as many as there are words: a word needs a byte and a separator
    size = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    if size * len(masks(WINDOW)) <= broadcast_seeds:
        return _by_broadcast(docs, items).distinct()
    return _by_join(docs, items).distinct()


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns kept.

    The test depends on the text alone, so it runs where the row is.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    if size * len(masks(WINDOW)) > BROADCAST_SEEDS:
        keyed = docs.select(F.xxhash64("text").alias("doc_id"), "text")
        bad = leaks(keyed, benchmark).select(F.col("doc_id").alias("leak_key")).distinct()
        return docs.join(bad, F.xxhash64(docs["text"]) == bad["leak_key"], "left_anti")
    model = Benchmark([(r["item_id"], r["text"]) for r in items.collect()])
    text_at = docs.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, text_at):
            bad = {leak[0] for leak in model.leaks(part.column(text_at))}
            yield part.take(pa.array([k for k in range(part.num_rows) if k not in bad], pa.int64()))

    return docs.mapInArrow(keep, docs.schema)

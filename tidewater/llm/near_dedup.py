"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text is the set of its ``SHINGLE``-word shingles. Every shingle is a Poisson
process: its arrivals come at exponential distances divided by its weight, each
at a hashed component, and a component keeps the shingle of its earliest
arrival, so two components agree with the probability Jaccard similarity of the
weighted sets. Each shingle has weight one, however often it occurs: that is the
Jaccard similarity by which links are judged, and equal sets have equal bands. A
shingle stops as soon as its next arrival is later than the latest of all
components kept so far.

``BANDS`` bands of ``ROWS`` components name the buckets in which texts meet.
A candidate pair counts as a link if the Jaccard similarity of the two shingle
sets, computed exactly, is at least ``SIMILARITY``; classes are the connected
components. Identical sets are one node from the start. In each bucket all
members are compared with one leader first, the member that meets most others;
members that end up in one class need no more comparison, so a large group of
copies costs a row per member and bucket. Of the members of buckets that still
hold several classes, those go that can have no link at all: shingles that no
other of these members has can't be common, and too many of them bound every
similarity below ``SIMILARITY``. After ``STAR_ROUNDS`` leaders the rest is
compared pair by pair, where that bound allows a link, each pair in the first
bucket that it shares.

Defined results: a text of fewer words than a shingle is one shingle; texts
without a word (null, empty) are alone and never copies; ``class_id`` is the
smallest id of the class (null ids count after all others); equal ids with
different texts are different rows; repeated rows share a class; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, mix, rolled, sliced, word_hashes, written
from .graph import components

SHINGLE, SIMILARITY = 5, 0.8
ROWS, BANDS = 5, 24
COMPONENTS = ROWS * BANDS
STAR_ROUNDS = 2
#: Texts handled at once: their number takes the top bits of a sort key.
TEXTS = 1000
_ROW_BITS = np.uint64(10)
_HASH_MASK = np.uint64((1 << 54) - 1)
#: Nodes whose texts are looked up by broadcast (an 8-byte key each); beyond, by shuffle.
BROADCAST_NODES = 2_000_000


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 54-bit hash, count) of each distinct shingle, by row and then hash."""
    hashes, bounds = word_hashes(texts)
    value, row = rolled(hashes, bounds, SHINGLE)
    sizes = np.diff(bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    whole = np.array([mix(hashes[bounds[r] : bounds[r + 1]].sum(keepdims=True) + np.uint64(sizes[r]))[0] for r in short], np.uint64)
    for k, r in enumerate(short):  # in order: the sum alone doesn't tell "a b" from "b a"
        for h in hashes[bounds[r] : bounds[r + 1]]:
            whole[k] = mix(np.array([whole[k] ^ h]))[0]
    row, value = np.concatenate([row, short]).astype(np.uint64), np.concatenate([value, whole])
    key = np.sort((row << np.uint64(54)) | (value >> _ROW_BITS))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([first, [len(key)]]))
    key = key[first]
    return (key >> np.uint64(54)).astype(np.int64), key & _HASH_MASK, count


def prob_minhash(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """(n x COMPONENTS): in each component the shingle of the earliest arrival."""
    earliest = np.full(n * COMPONENTS, np.inf)
    kept = np.zeros(n * COMPONENTS, np.uint64)
    latest = np.full(n, np.inf)
    alone = np.bincount(row, minlength=n) == 1  # a single shingle has every component
    single = alone[row]
    kept.reshape(n, COMPONENTS)[row[single]] = shingle[single, None]
    row, shingle, weight = row[~single], shingle[~single], weight[~single]
    time, arrival = np.zeros(len(row)), 0
    while len(row):
        arrival += 1
        h = mix(shingle ^ np.uint64(arrival * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        time = time - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        live = time < latest[row]
        row, shingle, weight, time, h = row[live], shingle[live], weight[live], time[live], h[live]
        at = row * COMPONENTS + (mix(h) % np.uint64(COMPONENTS)).astype(np.int64)
        np.minimum.at(earliest, at, time)
        won = earliest[at] == time
        kept[at[won]] = shingle[won]
        latest = earliest.reshape(n, COMPONENTS).max(axis=1)
        live = time < latest[row]
        row, shingle, weight, time = row[live], shingle[live], weight[live], time[live]
    return kept.reshape(n, COMPONENTS)


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signatures), BANDS)).copy()
    part = signatures.reshape(-1, BANDS, ROWS)
    for k in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
    return out.view(np.int64)


def set_names(row: np.ndarray, shingle: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit name of each row's shingle set."""
    spread = mix(shingle + np.uint64(0x5851F42D4C957F2D))
    total = np.zeros(n, np.uint64)
    np.add.at(total, row, spread)
    return mix(total + np.bincount(row, minlength=n).astype(np.uint64)).view(np.int64)


def _by_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in sliced(batches):
        for at in range(0, part.num_rows, TEXTS):
            yield part.slice(at, TEXTS)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, n, bands): the node names the text's shingle set."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_texts(batches):
            size = part.num_rows
            row, shingle, _ = shingle_sets(part.column("text"))
            n = np.bincount(row, minlength=size)
            bands = band_hashes(prob_minhash(row, shingle, np.ones(len(row)), size))
            has = n > 0
            node = pa.array(set_names(row, shingle, size), mask=~has)
            at = np.concatenate([[0], np.cumsum(has) * BANDS]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(bands[has].ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), node, pa.array(n, pa.int64()), lists], ["doc_id", "text_key", "node", "n", "bands"]
            )

    keyed = id_text(docs).withColumn("text_key", F.xxhash64("text"))
    return keyed.mapInArrow(sign, "doc_id bigint, text_key bigint, node bigint, n bigint, bands array<bigint>")


def node_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, shingles) of the wanted nodes, from one text of each.

    ``wanted``: (node, text_key). Texts are found by their key where the list of
    keys has a checked size, else by a shuffled join.
    """

    def shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _by_texts(batches):
            row, shingle, _ = shingle_sets(part.column("text"))
            at = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(shingle.view(np.int64)))
            names = pa.array(set_names(row, shingle, part.num_rows))
            yield pa.RecordBatch.from_arrays([names, pa.array(np.diff(at).astype(np.int64)), lists], ["node", "n", "shingles"])

    texts = id_text(docs).where("text is not null").select("text", F.xxhash64("text").alias("text_key"))
    keys = wanted.select("text_key").distinct()
    if keys.count() <= BROADCAST_NODES:
        keys = F.broadcast(keys)
    texts = texts.join(keys, "text_key").dropDuplicates(["text_key"]).select("text")
    return texts.mapInArrow(shingles, "node bigint, n bigint, shingles array<bigint>").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets have a Jaccard similarity of ``SIMILARITY`` at least."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return both.where(common >= F.lit(SIMILARITY) * (F.col("n_a") + F.col("n_b") - common)).select("a", "b")


def _may_link():
    """Whether two sets of n_a and n shingles, s_a and s of them held by others, can be similar enough."""
    common = F.least("s_a", "s")
    return common >= F.lit(SIMILARITY) * (F.col("n_a") + F.col("n") - common)


def _held_by_others(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, s): how many of a member's shingles at least one other member has."""
    rows = sets.join(members.select("node").distinct(), "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    held = rows.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("shingle")
    return rows.join(held, "shingle").groupBy("node").agg(F.count("*").alias("s"))


def node_table(rows: DataFrame) -> DataFrame:
    """(node, text_key, n, bands): of each node the row of smallest text key, whatever the order of rows."""
    one = F.min(F.struct("text_key", "n", "bands")).alias("one")
    return rows.where("node is not null").groupBy("node").agg(one).select("node", "one.*")


def _of_mixed_buckets(members: DataFrame) -> DataFrame:
    mixed = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("bucket")
    return members.join(mixed, "bucket")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): the signed rows, and (node, label) of nodes linked to others."""
    rows = written(signed(docs), "signed")
    nodes = written(node_table(rows), "nodes")
    members = nodes.select("node", "n", "text_key", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("size")).where("low != high")
    members = written(members.join(shared.select("bucket", "size"), "bucket"), "members")
    sets = written(node_sets(docs, members.select("node", "text_key")), "shingle-sets")
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    members = members.select("bucket", "node", "n").join(met, "node").withColumn("s", F.col("n")).withColumn("label", F.col("node"))
    labels = None
    for turn in range(STAR_ROUNDS + 1):
        if turn:
            # only buckets that hold two classes still have something to compare
            members = members.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            members = _of_mixed_buckets(members)
            if turn == 1:
                members = members.drop("s").join(_held_by_others(members, sets), "node").where(F.col("s") >= F.lit(SIMILARITY) * F.col("n"))
                members = _of_mixed_buckets(written(members, "linkable-members"))
                members = members.join(nodes.select("node", "bands"), "node")
            members = written(members, "mixed-members")
            if members.isEmpty():
                break
        if turn < STAR_ROUNDS:
            first = F.xxhash64("node", F.lit(turn)) if turn else -F.col("met")
            order = F.struct(first.alias("at"), "node", "n", "s", "label")
            lead = members.groupBy("bucket").agg(F.min(order).alias("lead")).select("bucket", "lead.*")
        else:
            lead = members
        again = [F.col("bands").alias("bands_a")] if turn == STAR_ROUNDS else []
        lead = lead.select("bucket", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("s").alias("s_a"), F.col("label").alias("label_a"), *again)
        apart = (F.col("label") != F.col("label_a")) & _may_link()
        if turn == STAR_ROUNDS:
            earlier = F.array_position("bands", F.col("bucket")).cast("int") - 1
            apart = apart & (F.col("a") < F.col("node")) & ~F.arrays_overlap(F.slice("bands", 1, earlier), F.slice("bands_a", 1, earlier))
        pairs = members.join(lead, "bucket").where(apart).select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        links = written(verified(pairs, sets), "links")
        if labels is None:
            labels = components(links)
        else:
            # classes are the nodes of the next graph
            named = lambda side: F.coalesce(F.col(f"label_{side}"), F.col(side)).alias(side)
            joined = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("label_a")), "a", "left")
            joined = joined.join(labels.select(F.col("node").alias("b"), F.col("label").alias("label_b")), "b", "left").select(named("a"), named("b"))
            merged = components(joined.where("a != b")).select(F.col("node").alias("label"), F.col("label").alias("to"))
            known = labels.unionByName(merged.select(F.col("label").alias("node"), F.col("label"))).distinct()
            labels = written(known.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label")).groupBy("node").agg(F.min("label").alias("label")), "labels")
    return rows, labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size) of every row of ``docs``."""
    rows, labels = classes(docs)
    rows = rows.select("doc_id", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    size = rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(size, "label", "left").select(
        "doc_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size")
    )


def first_of_class(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept: texts without a word, and
    of each class one row, of smallest id (then text key)."""
    rows, labels = classes(docs)
    rows = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    best = rows.where("label is not null").groupBy("label").agg(F.min(order).alias("best"))
    same = rows.join(best, "label").where(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key") == F.col("best"))
    chosen = same.groupBy(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")).agg(F.count("*").alias("kept_copies"))
    wordless = rows.where("label is null").select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"), F.lit(1).cast("bigint").alias("kept_copies")).distinct()
    chosen = chosen.unionByName(wordless)
    columns = [docs[c].alias(f"c{k}") for k, c in enumerate(docs.columns)]
    keyed = docs.select(*columns, docs["doc_id"].cast("bigint").alias("own_id"), F.xxhash64(docs["text"].cast("string")).alias("own_key"))
    kept = keyed.join(chosen, F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_key") == F.col("kept_key")))
    back = [F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)]
    once = kept.where("kept_copies = 1").select(*back)
    repeated = kept.where("kept_copies > 1").dropDuplicates(["own_id", "own_key"]).select(*back)
    return once.unionByName(repeated)

"""Exact duplicates by content sort: sampled splitters, external sort, neighbours compared.

Texts are normalised (ASCII capitals folded) and dealt to partitions by splitters
of a sample, so that partition p holds nothing that sorts after partition p + 1.
Rows are ordered by (first ``HEAD`` bytes, SHA-256 of the whole text, doc_id): equal texts
stand side by side, and a group of any size is cut at ids like everything else, so
no task holds more of it than its share. Spark sorts each partition (spilling to
disk), and a walk compares each whole text with the one before it, byte by byte.
A group that crosses partitions is put together from the first and last runs of
each partition, whose whole texts are compared as well.

The sample (at most ``SAMPLED`` keys a partition and ``MOST_SAMPLED`` in all) only places
the cuts. What reaches the driver is that sample and, per partition, the sizes
of its first and last run.

Defined results: null text is the empty text; the row of largest ``doc_id`` stays
(null ids sort before all others); of repeated rows with one ``doc_id`` exactly one
is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, sliced, written

#: Bytes of a text that order it; beyond them its digest does.
HEAD = 256
SAMPLED, MOST_SAMPLED = 64, 200_000
#: A partition is meant to hold about so many bytes of text, if the session's partitions are too few.
PART_BYTES = 256 << 20
SAMPLE_SEED = 13

_RUN_SCHEMA = "doc_id bigint, text_sha256 string, part int, edge int, run_size bigint, run_keep bigint, run_end boolean, edge_text binary"
FIRST, LAST = 1, 2


def normalised(texts: pa.Array) -> pa.Array:
    """The texts as bytes, A-Z in lower case (null: empty)."""
    return pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.binary())


def sort_key(norm: bytes, doc_id: int | None) -> tuple:
    return norm[:HEAD], hashlib.sha256(norm).digest(), doc_id is not None, doc_id or 0


def _keys(docs: DataFrame) -> DataFrame:
    """(key_head, key_digest, key_known, key_id, size) of each row: what sort_key holds."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            norm = normalised(part.column("text")).to_pylist()
            keys = [sort_key(t, i) for t, i in zip(norm, part.column("doc_id").to_pylist(), strict=True)]
            columns = [*zip(*keys, strict=True), [len(t) for t in norm]]
            kinds = pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key_head", "key_digest", "key_known", "key_id", "size"])

    return docs.mapInArrow(make, "key_head binary, key_digest binary, key_known boolean, key_id bigint, size bigint")


def splitters(docs: DataFrame) -> list[tuple]:
    """Ascending keys that cut ``docs`` (doc_id, text) into parts of like size."""
    spark = docs.sparkSession
    rows, parts = docs.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not rows:
        return []
    wanted = min(SAMPLED * parts, MOST_SAMPLED)
    # a sample above the whole table's size takes the whole (small) table
    sample = docs if wanted >= rows else docs.sample(wanted / rows, SAMPLE_SEED)
    found = _keys(sample).collect()
    if not found:
        return []
    size = sum(r["size"] for r in found) / len(found) * rows
    parts = max(parts, int(size / PART_BYTES))
    keys = sorted((bytes(r["key_head"]), bytes(r["key_digest"]), r["key_known"], r["key_id"]) for r in found)
    return sorted({keys[len(keys) * k // parts] for k in range(1, parts)})


def _dealt(docs: DataFrame, cuts: list[tuple]) -> DataFrame:
    """(part, head, digest, doc_id, norm), each row in the partition of its key, sorted there."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            norm, ids = normalised(batch.column("text")), batch.column("doc_id")
            keys = [sort_key(t, i) for t, i in zip(norm.to_pylist(), ids.to_pylist(), strict=True)]
            part = pa.array([bisect.bisect_right(cuts, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([part, pa.array([k[1] for k in keys], pa.binary()), ids, norm], ["part", "digest", "doc_id", "norm"])

    dealt = docs.mapInArrow(deal, "part int, digest binary, doc_id bigint, norm binary").repartitionById(len(cuts) + 1, F.col("part"))
    dealt = dealt.withColumn("head", F.substring("norm", 1, HEAD))
    return dealt.sortWithinPartitions("head", "digest", F.col("doc_id").asc_nulls_first())


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the size and last id of their run of equal neighbours. The
    first and last run of the partition are marked and carry their text once."""
    names, part = [f.split()[0] for f in _RUN_SCHEMA.split(", ")], TaskContext.get().partitionId()
    text, digest, ids, first = None, b"", [], True  # the run that is still open

    def closed(edge: int) -> pa.RecordBatch:
        n = len(ids)
        columns = [ids, [digest.hex()] * n, [part] * n, [edge] * n, [n] * n, [ids[-1]] * n, [False] * (n - 1) + [True], [None] * (n - 1) + [text if edge else None]]
        kinds = pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def whole_runs(batch: pa.RecordBatch, starts: np.ndarray, to: int) -> pa.RecordBatch:
        """The runs that begin at ``starts`` and end before ``to``."""
        base, n = int(starts[0]), to - int(starts[0])
        ends = np.append(starts[1:], to) - base
        sizes = np.diff(np.append(0, ends))
        own = batch.slice(base, n)
        final = np.zeros(n, bool)
        final[ends - 1] = True
        keep = own.column("doc_id").take(pa.array(np.repeat(ends - 1, sizes)))
        digests = pa.array([d.hex() for d in own.column("digest").to_pylist()], pa.string())
        fixed = pa.array(np.full(n, part, np.int32)), pa.array(np.zeros(n, np.int32)), pa.array(np.repeat(sizes, sizes).astype(np.int64))
        return pa.RecordBatch.from_arrays([own.column("doc_id"), digests, *fixed, keep, pa.array(final), pa.nulls(n, pa.binary())], names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        norm, batch_ids = batch.column("norm"), batch.column("doc_id")
        same = np.empty(n, bool)
        same[0] = text is not None and norm[0].as_py() == text
        same[1:] = np.asarray(pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False), bool)
        starts = np.flatnonzero(~same)
        ids += batch_ids.slice(0, int(starts[0]) if len(starts) else n).to_pylist()
        if not len(starts):
            continue
        if text is None and len(starts) > 1:  # the partition's first run ends in its first batch
            text, digest, ids = norm[0].as_py(), batch.column("digest")[0].as_py(), batch_ids.slice(0, int(starts[1])).to_pylist()
            starts = starts[1:]
        if text is not None:
            yield closed(FIRST if first else 0)
            first = False
            if len(starts) > 1:
                yield whole_runs(batch, starts[:-1], int(starts[-1]))
        at = int(starts[-1])
        text, digest, ids = norm[at].as_py(), batch.column("digest")[at].as_py(), batch_ids.slice(at).to_pylist()
    if text is not None:
        yield closed(LAST | (FIRST if first else 0))


def _joined_edges(runs: DataFrame) -> DataFrame | None:
    """(part, edge, whole_size, whole_keep, tail) of the edge runs that go on in another
    partition; None if there are none. ``tail``: the group ends there."""
    spark = runs.sparkSession
    edges = runs.where("edge_text is not null")
    found = edges.select("part", "edge", "run_size", "run_keep").collect()  # at most two rows a partition
    parts = sorted({r["part"] for r in found})
    if len(parts) < 2:
        return None
    after = spark.createDataFrame(list(zip(parts, parts[1:], strict=False)), "part int, next int")
    ending = edges.where(F.col("edge").bitwiseAND(LAST) > 0).select("part", F.col("edge_text").alias("text"))
    starting = edges.where(F.col("edge").bitwiseAND(FIRST) > 0).select(F.col("part").alias("next"), F.col("edge_text").alias("next_text"))
    equal = ending.join(after, "part").join(starting, "next").where(F.col("text") == F.col("next_text"))
    goes_on = {r["part"] for r in equal.select("part").collect()}
    if not goes_on:
        return None
    first = {r["part"]: r for r in found if r["edge"] & FIRST}
    last = {r["part"]: r for r in found if r["edge"] & LAST}
    rows, chain = [], []
    for part, following in zip(parts, [*parts[1:], None], strict=True):
        chain.append(last[part])
        if part in goes_on:
            if first[following]["edge"] == FIRST | LAST:
                continue  # the next partition's only run: the chain grows there
            chain.append(first[following])
        if len(chain) > 1:
            size, end = sum(r["run_size"] for r in chain), chain[-1]
            rows += [(r["part"], r["edge"], size, end["run_keep"], r is end) for r in chain]
        chain = []
    return spark.createDataFrame(rows, "part int, edge int, whole_size bigint, whole_keep bigint, tail boolean")


def duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``."""
    own = id_text(docs)
    runs = written(_dealt(own, splitters(own)).select("digest", "doc_id", "norm").mapInArrow(_runs, _RUN_SCHEMA), "content-runs")
    crossing, rows = _joined_edges(runs), runs.drop("edge_text")
    if crossing is None:
        rows = rows.selectExpr("*", "false as crosses", "0L as whole_size", "0L as whole_keep", "false as tail")
    else:
        # at most two rows a partition
        rows = rows.join(F.broadcast(crossing.withColumn("crosses", F.lit(True))), ["part", "edge"], "left")
    crosses = F.coalesce("crosses", F.lit(False))
    return rows.select(
        "doc_id",
        F.when(crosses, F.col("whole_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.when(crosses, F.col("whole_size")).otherwise(F.col("run_size")).alias("group_size"),
        (F.col("run_end") & (~crosses | F.coalesce("tail", F.lit(False)))).alias("kept"),
        "text_sha256",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the rows that stay, the text as it came."""
    own = id_text(docs)
    stays = duplicates(own).where("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256")
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keyed = own.withColumn("own_sha256", F.sha2(lower, 256))
    kept = keyed.join(stays, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("own_sha256") == F.col("text_sha256")))
    # rows that agree in id and normalised text: one of them, the same in every run
    one = kept.groupBy("doc_id", "text_sha256").agg(F.min("text").alias("text"))
    return one.select("doc_id", "text")


#: The same rows by plain grouping (the tables hold one row per doc_id).
ORACLE_SQL = """
WITH t AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

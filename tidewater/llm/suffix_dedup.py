"""Repeated-substring removal: strings of ``LENGTH`` bytes grouped by hash names at sampled positions.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document of smaller id, or earlier in the same one) is removed; strings never
cross documents and are judged on the input. The steps follow a difference-cover
suffix sort, bounded to the ``LENGTH``-byte prefixes that matter, but groups of equal
hashes stand for its sorting, its recursion and its comparison of adjacent prefixes:

1. *Sample.* A difference cover is a set of positions that any two equal strings
   meet at one common offset. It is chosen by content: each ``LENGTH``-byte string
   is answered for by the position in it whose ``GRAM``-byte string hashes
   smallest (leftmost on ties), so equal strings pick the same offset and one
   position in about 25 is sampled. (Fixed residues need a cover of 1 in 7 at
   best and a row for each, several times the disk that is allowed.)
2. *Name triples.* A sampled position is named by what it starts with (``g``), and
   by the triple of that, the text to its left and the text to its right, as
   far as the strings reach that it answers for (``c``). A window by (g, c) brings
   equal names together; positions whose g is unique are discarded.
3. *Group names.* Names are not ranked or recursed on. Where all positions of a g share one c, their strings
   agree as a whole, and so do those of equal c elsewhere: the first keeps
   them, the others lose them. Only first ones of a g with several c stay open.
4. *Take the remaining strings.* Those that open positions answer for are taken
   one by one, named by (g, their own hash), and grouped in the same way.

A name is a pair of 64-bit hashes of the same bytes; equality of bytes rests on
them, no bytes are compared. Equal names of one task are
packed into one row before the shuffle, so a group of copies costs a row per
task. Rows of a name are streamed through a spilling window, never gathered.

Defined results: null text is the empty text; null ids come after all others;
rows that share an id are ordered by a hash of their text, and wholly equal rows
(id and text) count as one document, so neither removes the other; texts under
``LENGTH`` bytes lose nothing; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text, joined_bytes, mix, sliced, written

LENGTH, GRAM = 100, 50
#: Text bytes hashed at once, and the longest stretch of one text.
SLICE, STRETCH = 512 << 10, 8 << 20
#: Names packed at once within a task.
PACK_ROWS = 750_000
#: Bytes of (document, spans) that are sent to every task; beyond, a shuffled join.
BROADCAST_BYTES = 64 << 20

_M = np.uint64(0x9E3779B97F4A7C15)
_POSITION = np.uint64((1 << 24) - 1)
_NAME_SCHEMA = "g bigint, c bigint, place bigint, at bigint, more binary"


def _wrapped_powers(top: int) -> dict[int, np.uint64]:
    out, value, size = {}, int(_M), 1
    while size <= top:
        out[size] = np.uint64(value)
        value, size = value * value % (1 << 64), size * 2
    return out


_POWER = _wrapped_powers(64)


def window_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``GRAM`` and the ``LENGTH`` bytes from each position, by doubling."""
    n, size = len(data), 1
    blocks = {1: data.astype(np.uint64) + np.uint64(1)}
    while size < 64:
        h = blocks[size]
        blocks[2 * size] = h[: len(h) - size] * _POWER[size] + h[size:]
        size *= 2

    def whole(length: int) -> np.ndarray:
        out, done = None, 0
        for size in (64, 32, 16, 8, 4, 2, 1):
            if length & size:
                block = blocks[size]
                if out is None:
                    out = block
                else:
                    room = n - done - size + 1
                    out = out[:room] * _POWER[size] + block[done : done + room]
                done += size
        return mix(out)

    return whole(GRAM), whole(LENGTH)


def sampled(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first, last, g, c, hashes): the sampled positions of joined texts.

    ``first`` to ``last`` are the starts, within ``data``, of the strings that the
    position answers for; ``hashes`` names the string at every start.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.view(np.uint64)
    gram, string = window_hashes(data)
    key = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while width * 2 <= LENGTH - GRAM + 1:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[: len(key) - (LENGTH - GRAM + 1 - width)], key[LENGTH - GRAM + 1 - width :])
    position = (key & _POSITION).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(position)]
    inside = np.arange(len(position)) + LENGTH <= bounds[row + 1]
    same = inside[1:] & inside[:-1] & (position[1:] == position[:-1]) & (row[1:] == row[:-1])
    first = np.flatnonzero(inside & ~np.concatenate([[False], same]))
    last = np.flatnonzero(inside & ~np.concatenate([same, [False]]))
    at = position[first]
    shape = ((last - first) * 64 + (at - first)).astype(np.uint64)
    triple = mix(string[first] * _M + string[last] + shape * np.uint64(0xC2B2AE3D27D4EB4F))
    return row[first], first, last, gram[at], triple, string


def _stretches(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Joined texts as (data, bounds, places, offset); a longer text in stretches
    that overlap so that every string lies in one."""
    data, bounds = joined_bytes(part.column("text"))
    places = np.asarray(part.column("place"))
    if len(data) <= STRETCH:
        yield data, bounds, places, 0
        return
    for k in range(len(places)):
        for at in range(bounds[k], max(bounds[k] + 1, bounds[k + 1] - LENGTH + 1), STRETCH):
            some = data[at : min(at + STRETCH + LENGTH - 1, bounds[k + 1])]
            yield some, np.array([0, len(some)]), places[k : k + 1], int(at - bounds[k])


#: ``at`` holds the first start and how many more follow; entries of one name have
#: as many, so theirs are in the order of starts.
def _at(first: np.ndarray, more: np.ndarray) -> np.ndarray:
    return (first.astype(np.int64) << 7) | more.astype(np.int64)


class _Packer:
    """Collects (g, c, place, at) and gives one row for each (g, c), its earliest
    (place, at) first and the others as bytes."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.rows += len(columns[0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            g, c, place, at = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            order = np.lexsort((at, place, c, g))
            g, c, place, at = g[order], c[order], place[order], at[order]
            head = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (g[1:] != g[:-1])]))
            ends = np.concatenate([head[1:], [len(g)]])
            many = np.flatnonzero(ends - head > 1)
            more: list[bytes | None] = [None] * len(head)
            for k in many:
                rest = slice(head[k] + 1, ends[k])
                more[k] = np.column_stack([place[rest], at[rest]]).tobytes()
            columns = [pa.array(x[head].view(np.int64)) for x in (g, c, place, at)]
            whole = pa.RecordBatch.from_arrays([*columns, pa.array(more, pa.binary())], ["g", "c", "place", "at", "more"])
            for k in range(0, whole.num_rows, 100_000):
                yield whole.slice(k, 100_000)
        self.parts, self.rows = [], 0


def _names(texts: DataFrame) -> DataFrame:
    """Names of all sampled positions of (place, text)."""

    def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer()
        for part in sliced(batches, "text", SLICE):
            for data, bounds, places, offset in _stretches(part):
                row, first, last, g, c, _ = sampled(data, bounds)
                packer.add(g, c, places[row], _at(first - bounds[row] + offset, last - first))
            if packer.rows >= PACK_ROWS:
                yield from packer.flush()
        yield from packer.flush()

    return texts.mapInArrow(name, _NAME_SCHEMA)


def _string_names(texts: DataFrame) -> DataFrame:
    """Names of the single strings that the open positions of (place, text, open) answer for."""

    def name(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer()
        for part in sliced(batches, "text", SLICE):
            opened = part.column("open")
            sizes = np.asarray(pa.compute.list_value_length(opened)).astype(np.int64)
            rows = np.repeat(np.arange(part.num_rows), sizes)
            starts = np.asarray(opened.flatten()) >> 7
            wanted = np.unique(rows * (1 << 40) + starts)
            base = 0
            for data, bounds, places, offset in _stretches(part):
                row, first, last, g, _, string = sampled(data, bounds)
                which = base + row if len(places) == part.num_rows else np.full(len(row), int(np.flatnonzero(np.asarray(part.column("place")) == places[0])[0]))
                local = first - bounds[row] + offset
                mine = np.isin(which * (1 << 40) + local, wanted)
                row, first, last, g = row[mine], first[mine], last[mine], g[mine]
                count = last - first + 1
                start = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
                row, g = np.repeat(row, count), np.repeat(g, count)
                c = string[start]
                packer.add(g, c, places[row], _at(start - bounds[row] + offset, np.zeros(len(row), np.int64)))
            if packer.rows >= PACK_ROWS:
                yield from packer.flush()
        yield from packer.flush()

    return texts.mapInArrow(name, _NAME_SCHEMA)


def _judged(names: DataFrame, single: bool = False) -> DataFrame:
    """(place, at, removed): entries whose strings start earlier elsewhere
    (``removed``), and first entries of a g that holds several c (not removed).
    Earlier is a smaller (place, start) of the whole name, whichever stretch,
    task or document it comes from.

    Names of ``single`` strings leave nothing open, so they are dealt by (g, c).
    """
    by_g, by_c = Window.partitionBy("g"), Window.partitionBy("g", "c")
    several = F.lit(False) if single else F.min("c").over(by_g) != F.max("c").over(by_g)
    found = names.withColumn("earliest", F.min(F.struct("place", "at")).over(by_c)).withColumn("several", several)
    found = found.where("several or place != earliest.place or at != earliest.at or more is not null")
    found = found.select("place", "at", "more", F.col("earliest.place").alias("first_place"), F.col("earliest.at").alias("first_at"), "several")

    def later(place: np.ndarray, at: np.ndarray, first_place: np.ndarray, first_at: np.ndarray) -> np.ndarray:
        return (place > first_place) | ((place == first_place) & (at > first_at))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, at, *earliest = (np.asarray(batch.column(k)) for k in ("place", "at", "first_place", "first_at"))
            several = np.asarray(batch.column("several").to_numpy(zero_copy_only=False), bool)
            places, ats, removed = [place], [at], [later(place, at, *earliest)]
            keep = [removed[0] | several]
            more = batch.column("more")
            with_more = np.flatnonzero(~np.asarray(more.is_null()))
            if len(with_more):
                values = [np.frombuffer(more[int(k)].as_py(), np.int64).reshape(-1, 2) for k in with_more]
                first = [np.repeat(x[with_more], [len(v) for v in values]) for x in earliest]
                rest = np.concatenate(values)
                places.append(rest[:, 0])
                ats.append(rest[:, 1])
                removed.append(later(rest[:, 0], rest[:, 1], *first))
                keep.append(removed[-1])
            keep = np.concatenate(keep)
            columns = np.concatenate(places)[keep], np.concatenate(ats)[keep], np.concatenate(removed)[keep]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["place", "at", "removed"])

    return found.mapInArrow(judge, "place bigint, at bigint, removed boolean")


def _spans(removed: DataFrame) -> DataFrame:
    """(place, spans): the maximal removed byte runs of each document, as start, end pairs."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("at"):
                at = np.sort(np.asarray(value.values))
                start, end = at >> 7, (at >> 7) + (at & 127) + LENGTH
                end = np.maximum.accumulate(end)
                head = np.concatenate([[True], start[1:] > end[:-1]])
                tail = np.concatenate([head[1:], [True]])
                out.append(np.column_stack([start[head], end[tail]]).ravel())
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(out, pa.list_(pa.int64()))], ["place", "spans"])

    grouped = removed.groupBy("place").agg(F.collect_list("at").alias("at"))  # a document's own, no more than its bytes
    return grouped.mapInArrow(merge, "place bigint, spans array<bigint>")


def _joined(texts: DataFrame, lists: DataFrame, column: str, how: str) -> DataFrame:
    """Texts with their lists: sent to the texts if small (measured), else a shuffle."""
    size = lists.agg(F.sum(F.size(column) * 8 + 32)).first()[0] or 0
    return texts.join(F.broadcast(lists) if size <= BROADCAST_BYTES else lists, "place", how)


def _placed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, place): places are unique and in the order of ids."""
    rows = id_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    ids = rows.agg(F.count("*").alias("rows"), F.count("doc_id").alias("ids")).first()
    if ids["ids"] == ids["rows"] and rows.groupBy("doc_id").count().where("count > 1").isEmpty():
        return rows.withColumn("place", F.col("doc_id"))
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    order = keyed.select("doc_id", "text_key").distinct().orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
    kinds = T.StructType([*order.schema.fields, T.StructField("place", T.LongType())])
    numbered = order.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    numbered = docs.sparkSession.createDataFrame(numbered, kinds).withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key"})
    return written(keyed.join(numbered, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key"))).select("doc_id", "text", "place"), "placed")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(place, spans) of every document of (place, text) that loses bytes."""
    whole = written(_judged(_names(texts.select("place", "text"))), "judged-names")
    opened = whole.where("not removed").groupBy("place").agg(F.collect_list("at").alias("open"))
    rest = _judged(_string_names(_joined(texts.select("place", "text"), written(opened, "open-names"), "open", "inner")), single=True)
    return written(_spans(whole.where("removed").unionByName(rest.where("removed")).select("place", "at")), "removed-spans")


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans[, kept]) of every row."""
    texts = _placed(docs)
    rows = _joined(texts, repeated_spans(texts), "spans", "left").select("doc_id", "text", "spans")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            data, bounds = joined_bytes(part.column("text"))
            whole, gone, kept = data.tobytes(), [], []
            for k, spans in enumerate(part.column("spans")):
                low, high = int(bounds[k]), int(bounds[k + 1])
                pairs = np.asarray(spans.values).reshape(-1, 2).tolist() if spans.is_valid else []
                edges = [low, *(low + x for pair in pairs for x in pair), high]
                kept.append(b"".join([whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]) if pairs else whole[low:high])
                gone.append(len(pairs))
            size = np.diff(bounds)
            columns = [part.column("doc_id"), pa.array(size), pa.array(size - np.array([len(x) for x in kept], np.int64)), pa.array(gone, pa.int64())]
            columns += [pa.array([hashlib.sha256(x).hexdigest() for x in kept]), part.column("spans")]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>"
    return rows.mapInArrow(cut, schema + ", kept binary" * with_text)

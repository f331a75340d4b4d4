"""Shared pieces: written intermediates, byte-bounded batches, word hashes."""

from __future__ import annotations

import tempfile
import unicodedata
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes handled at once by the vectorised code (one longer text is handled alone).
SLICE_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none and is local (tests, one machine) is one made here.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tidewater-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage,
    survives lost executors, and is computed once however often it is read."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame) -> DataFrame:
    """Only (doc_id, text): other columns, whatever their names, stay out of the way."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def id_remainder(modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col("doc_id").cast("string")) % F.lit(modulus)


def sliced(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each slice holds at most ``limit`` bytes of
    ``column`` (always at least one row; no text is cut)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column as one byte array and its row bounds (null: empty)."""
    filled = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    bounds = np.frombuffer(filled.buffers()[1], np.int64, len(filled) + 1, filled.offset * 8)
    data = np.frombuffer(filled.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _STEP, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run ``data[start:end)`` (none empty, ascending, disjoint)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts] += 1
    keep[ends] -= 1
    inside = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    value = (data[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes where ``inside`` holds, never across rows.

    Returns the runs' starts, ends and the row that each lies in.
    """
    flag = np.zeros(len(data) + 1, bool)
    flag[: len(data)] = inside
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    before = np.concatenate([[False], flag[:-1]])
    starts = np.flatnonzero(flag & (~before | cut))
    # a run ends where the flag falls, or where the next row starts
    ends = np.flatnonzero(before & (~flag | cut))
    rows = np.searchsorted(bounds, starts, side="right") - 1
    return starts, ends, rows


#: Bytes of a word in a text of ASCII alone: letters and digits.
WORD_BYTE = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
BLANK_BYTE = np.array([b <= 32 for b in range(256)])
# Blocks of scripts that are written without spaces between words (Thai, Lao,
# Tibetan, Burmese, Khmer, Japanese syllables, Chinese characters with their extensions,
# half-width katakana).
UNSEGMENTED = (
    (0x0E00, 0x0E7F), (0x0E80, 0x0EFF), (0x0F00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x323AF),
)
_SEPARATOR, _PART, _WHOLE, _UNKNOWN = range(4)
#: What each code point is to a word; filled as code points are met.
_CODE_KIND = np.full(0x110000, _UNKNOWN, np.uint8)


def code_kinds(codes: np.ndarray) -> np.ndarray:
    """Per code point: none of a word, part of a word, or a word of its own."""
    kinds = _CODE_KIND[codes]
    if (kinds == _UNKNOWN).any():
        for c in np.unique(codes[kinds == _UNKNOWN]).tolist():
            inside = unicodedata.category(chr(c))[0] in "LMN"
            alone = any(low <= c <= high for low, high in UNSEGMENTED)
            _CODE_KIND[c] = _SEPARATOR if not inside else _WHOLE if alone else _PART
        kinds = _CODE_KIND[codes]
    return kinds


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of each text, in order, and row bounds in them.

    A word is a maximal run of letters, marks and digits of any script; in scripts
    without spaces each character is a word. Everything else separates words.
    """
    data, bounds = joined_bytes(lowered(column))
    if not (data >= 128).any():
        starts, ends, rows = words(data, bounds, WORD_BYTE[data])
    else:
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        bounds = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
        data, kinds = codes, code_kinds(codes)
        starts, ends, rows = words(data, bounds, kinds == _PART)
        alone = np.flatnonzero(kinds == _WHOLE)
        if len(alone):
            starts, ends = np.concatenate([starts, alone]), np.concatenate([ends, alone + 1])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
            rows = np.searchsorted(bounds, starts, side="right") - 1
    return run_hashes(data, starts, ends), np.searchsorted(rows, np.arange(len(bounds)))


def rolled(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words that lie in one row, and their rows."""
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(total, np.uint64)
    for k in range(n):
        out = out * _STEP + hashes[k : k + total]
    rows = np.searchsorted(bounds, np.arange(total), side="right") - 1
    ok = np.arange(total) + n <= bounds[rows + 1]
    return mix(out[ok]), rows[ok]

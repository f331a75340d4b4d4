"""Token-ID output: canonical length-limited Huffman coding in independent blocks.

Texts are tokenised once into a written table of ids; the ids are counted over
the whole corpus; one canonical code (lengths by package-merge, at most
``MAX_BITS``) serves every block. Blocks hold whole documents in ascending
``doc_id`` order and decode on their own, with a bit-offset checkpoint every
``STRIDE`` ids, so a reader can start anywhere without touching other blocks.

File format (a folder): ``blocks/`` holds one row per block
(``part, block, first, n_tokens, doc_ids, doc_tokens, checkpoints, payload``),
``code/`` one row per used id with its code length; canonical codes follow
from the lengths alone.

Defined results: ids are those of the library's plain ``encode(text,
add_special_tokens=False)``, so an added token that a text spells out has its own
id; null text is the empty text (only the end id); null ``doc_id``
sorts first; equal ``doc_id`` are all kept, ordered by a hash of their ids; an
empty table gives empty files; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, id_text, joined_bytes, sliced, written

END_ID = 0
MAX_BITS = 20
STRIDE = 128
_LENGTH_BITS = 5  # of a code length, which stands below the id or code it belongs to
_LENGTH_MASK = np.uint32((1 << _LENGTH_BITS) - 1)
#: Ids packed at once (a multiple of ``STRIDE``): their arrays stay in the processor's cache.
_CODED_AT_ONCE = 1 << 15
#: Ids of the blocks decoded side by side (one larger block is decoded alone).
DECODED_TOKENS = 1 << 20
BLOCK_TOKENS = 1 << 18
#: Pieces remembered per Python worker; beyond it the older half is forgotten.
CACHE_PIECES = 600_000
#: Text bytes encoded at once: the more, the fewer look-ups of distinct pieces.
ENCODE_BYTES = 8 << 20

#: Kinds of characters to the pre-tokenizer.
_LETTER, _DIGIT, _OTHER, _BLANK, _UNKNOWN = range(5)
_BESIDE = ((_LETTER, "a"), (_DIGIT, "1"), (_OTHER, "."))
#: Letters that an apostrophe takes with it alone.
_SHORT = np.isin(np.arange(256), list(b"stmd"))
#: A space that doesn't stand before a non-space (for the regular-expression engine of Arrow).
_IRREGULAR = r" ([\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"
_IDS_SCHEMA = "doc_id bigint, ids binary"
_BLOCK_SCHEMA = "part int, block int, first bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, checkpoints array<bigint>, payload binary"


def _byte_alphabet() -> np.ndarray:
    """The code point that the byte-level alphabet has for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.zeros(256, "<u4")
    out[shown] = shown
    out[[b for b in range(256) if b not in shown]] = np.arange(256, 512 - len(shown))
    return out


_ALPHABET = _byte_alphabet()
_ID = attrgetter("id")


class PieceEncoder:
    """Ids of texts by their pre-tokens, each distinct one encoded once by the library's model.

    Pre-tokens are cut for a whole column at once, by the byte-level rule (``'s|'t|'re|'ve|'m|'ll|'d|
    ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``): wherever the kind of the
    characters changes, but for a space that goes with what follows. What kind a character is, the
    library's own pre-tokenizer says. Equal pre-tokens are found by dictionary coding and remembered.
    Added tokens of the vocabulary are cut out before, as the library does: their ids are pieces
    of their own, and what stands between two of them is a text of its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        model = Tokenizer.from_file(path)
        self.cutter = model.pre_tokenizer
        if not isinstance(self.cutter, pre_tokenizers.ByteLevel) or self.cutter.add_prefix_space or not self.cutter.use_regex:
            raise ValueError("the tokenizer must cut texts by the byte-level rule")
        if model.normalizer is not None or model.truncation is not None or model.padding is not None:
            raise ValueError("a tokenizer that changes, cuts or pads texts can't be applied by pieces")
        self.model = model.model
        self.type = id_type(path)
        added = model.get_added_tokens_decoder()
        if any(x.lstrip or x.rstrip or x.single_word for x in added.values()):
            raise ValueError("added tokens that depend on the text beside them can't be cut out")
        self.added = {x.content.encode(): np.array([i], self.type).tobytes() for i, x in added.items()}
        self.cut_added = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))
        self.kind = np.full(0x110000, _UNKNOWN, np.uint8)
        self._ask(np.arange(128))
        self.byte_kind = np.concatenate([self.kind[:128], np.full(128, _UNKNOWN, np.uint8)])
        self.spaced: dict[bytes, bytes] = dict(self.added)  # and pre-tokens, with the space before them
        self.older: dict[bytes, bytes] = {}

    def _ask(self, codes: np.ndarray) -> None:
        """Learn the kinds of characters: each goes on with its own kind alone."""
        for code in codes.tolist():
            alike = [kind for kind, beside in _BESIDE if len(self.cutter.pre_tokenize_str(beside + chr(code))) == 1]
            self.kind[code] = alike[0] if alike else _BLANK

    def _kinds(self, data: np.ndarray) -> np.ndarray:
        """The kind of the character that each byte belongs to."""
        out = self.byte_kind[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            code = data[lead].astype(np.uint32)
            size = 2 + (code >= 0xE0) + (code >= 0xF0)
            code &= (0x7F >> size).astype(np.uint32)
            for k in (1, 2, 3):
                longer = size > k
                code[longer] = (code[longer] << 6) | (data[lead[longer] + k] & 0x3F)
            kinds = self.kind[code]
            if (kinds == _UNKNOWN).any():
                self._ask(np.unique(code[kinds == _UNKNOWN]))
                kinds = self.kind[code]
            out[lead] = kinds
            for k in (1, 2, 3):
                longer = size > k
                out[lead[longer] + k] = kinds[longer]
        return out

    def _cuts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pre-tokens start, and the end: texts lie between ``bounds``."""
        n = len(data)
        spans = self._added_spans(data, bounds)
        kinds = self._kinds(data)
        edge = np.zeros(n + 3, bool)
        edge[bounds] = True
        edge[spans.ravel()] = True
        edge[n:] = True
        cut = edge.copy()
        cut[1:n] |= kinds[1:] != kinds[:-1]
        # of white space before something else, the last character stands apart; a space goes with what follows
        blank = kinds == _BLANK
        ends = np.flatnonzero(blank[:-1] & ~blank[1:] & ~edge[1:n]) + 1
        last = ends - 1
        while (inside := (data[last] & 0xC0) == 0x80).any():
            last = last - inside
        cut[last] = True
        cut[ends[data[last] == ord(" ")]] = False
        # an apostrophe that starts a pre-token takes certain letters with it, and no more
        mark = np.flatnonzero(data == ord("'"))
        mark = mark[cut[mark] & ~edge[mark + 1]]
        if len(mark):
            one, two = data[mark + 1], data[np.minimum(mark + 2, n - 1)]
            short = _SHORT[one]
            long = ~edge[mark + 2] & ((((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
            cut[mark[short | long] + 1] = False
            cut[mark[short] + 2] = True
            cut[mark[long] + 3] = True
        for a, b in spans.tolist():
            cut[a + 1 : b] = False
        return np.flatnonzero(cut[: n + 1])

    def _added_spans(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Start and end of every added token that a text spells out."""
        whole, out = data.tobytes(), []
        if self.added and self.cut_added.search(whole):
            for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                out += [x.span() for x in self.cut_added.finditer(whole, a, b)]
        return np.array(out, np.int64).reshape(-1, 2)

    def _learn(self, missing: list[bytes]) -> None:
        spaced, older = self.spaced, self.older
        spaced.update([(p, older[p]) for p in missing if p in older])
        new = [p for p in missing if p not in spaced]
        names = _ALPHABET[np.frombuffer(b"".join(new), np.uint8)].tobytes().decode("utf-32-le")
        tokenize, ids, sizes, at = self.model.tokenize, [], [], 0
        for p in new:
            to = at + len(p)
            found = tokenize(names[at:to])
            ids += map(_ID, found)
            sizes.append(len(found))
            at = to
        data = np.array(ids, self.type).tobytes()
        edges = (np.cumsum([0, *sizes]) * np.dtype(self.type).itemsize).tolist()
        spaced.update(zip(new, [data[a:b] for a, b in zip(edges, edges[1:], strict=False)], strict=True))

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """Little-endian ids of each text (null: empty), the end id appended."""
        texts.validate(full=True)
        data, bounds = joined_bytes(texts)
        if not len(data):
            starts = np.zeros(1, np.int64)
        else:
            starts = self._cuts(data, bounds)
        narrow = len(data) < 1 << 31
        offsets = pa.py_buffer(starts.astype(np.int32) if narrow else starts)
        pieces = pa.Array.from_buffers(pa.binary() if narrow else pa.large_binary(), len(starts) - 1, [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.spaced.get, names))
        if None in found:
            gaps = [i for i, x in enumerate(found) if x is None]
            self._learn([names[i] for i in gaps])
            for i in gaps:
                found[i] = self.spaced[names[i]]
        if len(self.spaced) > CACHE_PIECES:
            self.older, self.spaced = self.spaced, dict(self.added)
        flat = np.frombuffer(b"".join(found), self.type)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // flat.itemsize
        first = np.cumsum(sizes) - sizes
        codes = np.asarray(pieces.indices)
        size = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(first[codes] - ends[:-1], size) + np.arange(ends[-1])]
        stops = ends[np.searchsorted(starts, bounds[1:])]
        ids = np.insert(ids, stops, END_ID)
        offsets = np.concatenate([[0], stops + np.arange(1, len(stops) + 1)]) * ids.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())

    def encode(self, texts: list[str], regular: list[bool] | None = None) -> list[bytes]:
        """``encode_column`` of a list; ``regular`` is no longer needed."""
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()


def id_type(tokenizer_path: str) -> str:
    """The narrowest unsigned type that holds every id of the vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(tokenizer_path).get_vocab().values()) < 1 << 16 else "<u4"


def id_type_from_task(spark: SparkSession, tokenizer_path: str) -> str:
    """``id_type``, asked in a task: the driver never loads the vocabulary."""

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([id_type(tokenizer_path)])], ["kind"])

    return spark.range(1, numPartitions=1).mapInArrow(tell, "kind string").first()["kind"]


_ENCODERS: dict[str, PieceEncoder] = {}


def tokenized(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids): every whole text as little-endian ids of ``id_type``, with the end id."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = PieceEncoder(tokenizer_path)
        encoder = _ENCODERS[tokenizer_path]
        for part in sliced(batches, limit=ENCODE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), encoder.encode_column(part.column("text"))], ["doc_id", "ids"])

    return id_text(docs).mapInArrow(encode, _IDS_SCHEMA)


def id_counts(ids: DataFrame, kind: str) -> DataFrame:
    """(id, n) over the whole corpus: counted per task, then summed."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in sliced(batches, "ids", 16 << 20):
            found = np.bincount(np.frombuffer(b"".join(part.column("ids").to_pylist()), kind))
            if len(found) > len(total):
                total, found = found, total
            total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return ids.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts (package-merge).

    Each of ``limit`` rounds merges the symbols with the pairs of the round
    before; the cheapest 2n-2 entries of the last round then say, round by
    round, how many of the rarest symbols get one bit more.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit in {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    rounds, packages = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        place = np.argsort(merged, kind="stable")
        merged = merged[place]
        rounds.append(place < n)
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_symbol in reversed(rounds):
        symbols = int(is_symbol[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class CanonicalCode:
    """Codes and the decoding table that follow from (ids, lengths) alone."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        width = np.uint64(1) << (MAX_BITS - self.lengths).astype(np.uint64)
        self.first = np.concatenate([np.zeros(1, np.uint64), np.cumsum(width, dtype=np.uint64)])[:-1]
        size = int(self.ids.max()) + 1 if len(ids) else 0
        self.coded = np.zeros(size, np.uint32)  # code and length of each id
        self.coded[self.ids] = (self.first >> (MAX_BITS - self.lengths).astype(np.uint64) << np.uint64(_LENGTH_BITS)) | self.lengths.astype(np.uint64)
        self.table: np.ndarray | None = None

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Packed bits, and the bit offset of every ``STRIDE``-th id."""
        total, out, checkpoints = 0, np.zeros(len(ids) * MAX_BITS // 64 + 2, np.uint64), []
        for start in range(0, len(ids), _CODED_AT_ONCE):
            found = self.coded[ids[start : start + _CODED_AT_ONCE]]
            if len(found) % 2:
                found = np.append(found, np.uint32(0))  # an odd last id gets a partner of no bits
            code, bits = (found >> _LENGTH_BITS).reshape(-1, 2), (found & _LENGTH_MASK).reshape(-1, 2)
            # ids go in pairs: of at most 2 * MAX_BITS bits, and STRIDE is even
            code = (code[:, 0].astype(np.uint64) << bits[:, 1]) | code[:, 1]
            bits = (bits[:, 0] + bits[:, 1]).astype(np.int64)
            at = np.cumsum(bits)
            at += total - bits
            total = int(at[-1] + bits[-1])
            word, room = at >> 6, 64 - (at & 63) - bits
            fits = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[heads]] |= np.bitwise_or.reduceat(fits, heads)
            over = np.flatnonzero(room < 0)  # at most one pair crosses each word's end
            out[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
            checkpoints.append(at[:: STRIDE // 2])
        return out[: total // 64 + 1].astype(">u8").tobytes()[: (total + 7) // 8], np.concatenate([np.zeros(0, np.int64), *checkpoints])

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All ids of a block."""
        return self.decode_blocks([payload], [checkpoints], [n])[0]

    def decode_blocks(self, payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> list[np.ndarray]:
        """All ids of each block; the runs between checkpoints advance side by side."""
        if self.table is None:
            self.table = np.zeros(1 << MAX_BITS, np.uint32)
            packed = (self.ids << _LENGTH_BITS) | self.lengths
            spread = np.repeat(packed, (1 << (MAX_BITS - self.lengths)))
            self.table[: len(spread)] = spread
        # the last run of a block may be short: what is read beyond it goes
        data = np.frombuffer(b"".join([*payloads, bytes(MAX_BITS * STRIDE // 8 + 8)]), np.uint8).astype(np.uint32)
        ahead = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]  # four bytes from each on
        bases = np.cumsum([0, *map(len, payloads)]) * 8
        at = np.concatenate([c.astype(np.int64) + base for c, base in zip(checkpoints, bases, strict=False)])
        out = np.zeros((STRIDE, len(at)), np.uint32)
        for step in range(STRIDE):
            place = (ahead[at >> 3] << (at & 7).astype(np.uint32)) >> (32 - MAX_BITS)
            entry = self.table[place.astype(np.int64)]
            out[step] = entry
            at += entry & _LENGTH_MASK
        ids = (out >> _LENGTH_BITS).T.reshape(-1)
        firsts = np.cumsum([0, *map(len, checkpoints)]) * STRIDE
        return [ids[first : first + n] for first, n in zip(firsts.tolist(), counts, strict=False)]


def write_corpus(docs: DataFrame, path: str, tokenizer_path: str) -> None:
    """Tokenise, count, code and write the corpus to the folder ``path``."""
    spark = docs.sparkSession
    kind = id_type_from_task(spark, tokenizer_path)
    ids = written(tokenized(docs, tokenizer_path), "token-ids")
    found = sorted((r["id"], r["n"]) for r in id_counts(ids, kind).collect())  # one row per vocabulary entry
    used = np.array([i for i, _ in found], np.int64)
    lengths = code_lengths(np.array([n for _, n in found], np.int64))
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(used, lengths, strict=True)], "id int, bits int").coalesce(1).write.parquet(f"{path}/code")
    code = CanonicalCode(used, lengths)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names, pieces, held, first, block = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            all_ids = np.concatenate(pieces)
            payload, checkpoints = code.encode(all_ids)
            row = [part], [block], [first], [len(all_ids)], [names], [[len(p) for p in pieces]], [checkpoints], [payload]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "block", "first", "n_tokens", "doc_ids", "doc_tokens", "checkpoints", "payload"])

        for batch in batches:
            for name, value in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                one = np.frombuffer(value.as_buffer(), kind)
                if pieces and held + len(one) > BLOCK_TOKENS:
                    yield flush()
                    first, block = first + held, block + 1
                    names, pieces, held = [], [], 0
                names.append(name)
                pieces.append(one)
                held += len(one)
        if pieces:
            yield flush()

    ordered = ids.withColumn("tie", F.xxhash64("ids")).repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "ids").select("doc_id", "ids")
    ordered.mapInArrow(pack, _BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_corpus(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) decoded from the folder ``path``.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian
    32-bit. Only the block totals of each part (one number per file) reach the driver.
    """
    code_rows = spark.read.schema("id int, bits int").parquet(f"{path}/code").collect()
    code = CanonicalCode(np.array([r["id"] for r in code_rows], np.int64), np.array([r["bits"] for r in code_rows], np.int64))
    blocks = spark.read.schema(_BLOCK_SCHEMA).parquet(f"{path}/blocks")
    totals = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    before, seen = {}, 0
    for part in sorted(totals):
        before[part], seen = seen, seen + totals[part]

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.cumsum(batch.column("n_tokens").to_numpy()) // DECODED_TOKENS
            for rows in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(group)) + 1):
                if len(rows):
                    yield from unpack_rows(batch.slice(rows[0], len(rows)))

    def unpack_rows(some: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        payloads, counts = some.column("payload").to_pylist(), some.column("n_tokens").to_pylist()
        checkpoints = [np.asarray(c.values) for c in some.column("checkpoints")]
        for row, ids in enumerate(code.decode_blocks(payloads, checkpoints, counts)):
            ids = ids.astype("<u4", copy=False)
            doc_ids, sizes = some.column("doc_ids")[row].values, np.asarray(some.column("doc_tokens")[row].values)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            each = [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            start = starts + some.column("first")[row].as_py() + before[some.column("part")[row].as_py()]
            columns = [doc_ids, pa.array(start, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x) for x in each], pa.int64())]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array([x.tobytes() for x in each], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    # blocks are large rows: a few at a time are enough for a Python task
    return blocks.mapInArrow(unpack, schema)


def coded_corpus(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """Write the corpus (to the shared folder unless ``path`` is given) and read it back."""
    path = path or fresh_path(docs.sparkSession, "token-corpus")
    write_corpus(docs, path, tokenizer_path)
    return read_corpus(docs.sparkSession, path, with_ids=False)

"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A is a byte-level BPE (``tokenizers``), B a sentencepiece BPE with byte
fallback; both read a space and the text. The libraries' own spans (character
offsets of each token) are the coarse cuts; where a character holds several tokens
(bytes of one character, byte-fallback pieces) the lengths of the decoded token bytes place the
cuts within it, and must meet the coarse cuts again behind it. Places where a token
of A and one of B both end cut a text into groups; every stretch between two
neighbouring ends of either kind is one link, the pair of tokens over it.

A space between a non-space and a non-space begins a new token in both, so a text is a
sequence of words that align on their own: each Python worker remembers the words
that it has met and encodes new ones many at a time as one text. Counts of id pairs
(documents that hold the pair linked) come from sorted distinct pairs per document,
summed in each task before the shuffle. The table of counts goes to the tasks where it
holds at most ``BROADCAST_PAIRS`` rows, else the documents' pairs are joined to it.

The installed sentencepiece no longer offers ``immutable_proto``; its successor with the
same spans, ``offset_mapping``, is read in its place.

Defined results: null and empty texts, and texts that either tokenizer doesn't give back
byte for byte behind the added space, have no tokens: zeros and an empty digest; strings of
special tokens are plain text; repeated rows are documents each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, sliced, written
from .token_output import _IRREGULAR as IRREGULAR

#: Words that a worker remembers; beyond it the older half is forgotten.
CACHE_WORDS = 400_000
#: Longer words (no space within) aren't remembered.
CACHED_LENGTH = 80
#: Words encoded as one text.
TOGETHER = 2000
#: Id pairs whose counts go to every task (9 bytes each): 72 MB at most.
BROADCAST_PAIRS = 8_000_000
#: Distinct pairs that a counting task holds before it sums them.
COUNT_BUFFER = 4_000_000
#: Bits of an id of B within a pair; ids of A take the rest of 32.
B_BITS = 15

_CUT = re.compile(r"(?<! ) (?=\S)")
_LINE = re.compile(r"(?<=\S)(\n)(?=\S)")
_CLOSING = ".,!?;:"
_BLANK = re.compile(r"\s")
#: (groups text, links as 32-bit pairs, tokens of A) of a stretch; False if it isn't given back.
Aligned = tuple[str, bytes, int]


def _byte_alphabet() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the words met so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        alphabet, names = _byte_alphabet(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(self.b_bytes) > 1 << B_BITS or len(self.a_bytes) > 1 << (32 - B_BITS):
            raise ValueError("a pair of ids needs more than 32 bits")
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces of several words can't be aligned word by word")
        # a letter and a closing mark, and a line feed and its neighbours, are tokens apart in both
        self.closes = not any("\n" in p or any(a.isalpha() and b in _CLOSING for a, b in zip(p, p[1:], strict=False)) for p in pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # decimal ids with what stands behind them in the groups text: the last of a group, and any other
        self.a_text, self.b_text = (
            np.array([f"{i}{mark}" for mark in marks for i in range(len(t))], object) for t, marks in ((self.a_bytes, "|,"), (self.b_bytes, ";,"))
        )
        self.a_width, self.b_width = (np.array([len(x) for x in t], np.int64) for t in (self.a_text, self.b_text))
        self.met: dict[str, Aligned | bool] = {}  # words, without the space before them
        self.older: dict[str, Aligned | bool] = {}
        self.bare: dict[str, Aligned | bool] = {}  # parts behind the first

    def _ends(self, offsets: list[tuple[int, int]], shift: int, ends: np.ndarray, at_byte: np.ndarray | None) -> bool:
        """Whether byte ends by the lengths of the decoded tokens meet the coarse cuts: where a token has
        characters and the next starts behind them, its last one is whole and its span says where it
        ends. (Of the bytes of one character some tokens share its span, others have an empty one.)"""
        spans = np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets)) + shift
        starts, stops = spans[::2], spans[1::2]
        whole = np.append(starts[1:] >= stops[:-1], True) & (stops > starts)
        coarse = stops if at_byte is None else at_byte[stops]
        return np.array_equal(ends[whole], coarse[whole])

    def _encoded(self, text: str) -> tuple | None:
        """(ids, byte ends) of A and B over ``text``, which begins with a space; None if it isn't given back."""
        data = text.encode()
        at_byte = None
        if len(data) != len(text):
            lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
            at_byte = np.append(np.flatnonzero(lead), len(data))
        found, spans = self.a.encode(text, add_special_tokens=False), self.b.encode(text[1:], return_type="offset_mapping")
        a_ids, b_ids = found.ids, spans["ids"]
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != data or b"".join(map(self.b_bytes.__getitem__, b_ids)) != data:
            return None
        a_ids, b_ids = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends, b_ends = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        # B's spans count from behind the space that it adds
        if not (self._ends(found.offsets, 0, a_ends, at_byte) and self._ends(spans["offsets"], 1, b_ends, at_byte)):
            raise ValueError("spans and decoded bytes of a tokenizer disagree")
        return a_ids, a_ends, b_ids, b_ends

    def _aligned(self, text: str, bounds: np.ndarray) -> list[Aligned] | None:
        """The alignment of each stretch of ``text`` that ends at the byte ``bounds``."""
        found = self._encoded(text)
        if found is None:
            return None
        a_ids, a_ends, b_ids, b_ends = found
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not np.isin(bounds, common).all():
            return None
        ends = np.union1d(a_ends, b_ends)
        links = (a_ids[np.searchsorted(a_ends, ends)] << B_BITS | b_ids[np.searchsorted(b_ends, ends)]).astype("<u4").tobytes()
        # the groups text: of each group first its tokens of A, then those of B
        a_last, b_last = np.isin(a_ends, common, assume_unique=True), np.isin(b_ends, common, assume_unique=True)
        a_at, b_at = a_ids + np.where(a_last, 0, len(self.a_bytes)), b_ids + np.where(b_last, 0, len(self.b_bytes))
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        a_cut, b_cut = np.searchsorted(a_ends, common, side="right"), np.searchsorted(b_ends, common, side="right")
        a_place = np.arange(len(a_ids)) + np.append(0, b_cut)[a_group]
        b_place = np.arange(len(b_ids)) + a_cut[b_group]
        tokens, widths = np.empty(len(a_ids) + len(b_ids), object), np.empty(len(a_ids) + len(b_ids), np.int64)
        tokens[a_place], tokens[b_place] = self.a_text[a_at], self.b_text[b_at]
        widths[a_place], widths[b_place] = self.a_width[a_at], self.b_width[b_at]
        groups, reach = "".join(tokens.tolist()), np.cumsum(widths)
        a_to, l_to = np.searchsorted(a_ends, bounds, side="right"), np.searchsorted(ends, bounds, side="right")
        t_to = reach[a_to + np.searchsorted(b_ends, bounds, side="right") - 1].tolist()
        out, t, a, l = [], 0, 0, 0
        for t2, a2, l2 in zip(t_to, a_to.tolist(), l_to.tolist(), strict=True):
            out.append((groups[t : t2 - 1], links[4 * l : 4 * l2], a2 - a))
            t, a, l = t2, a2, l2
        return out

    def _whole(self, text: str) -> Aligned | bool:
        """The alignment of a text of its own, which begins with a space."""
        found = self._aligned(text, np.array([len(text.encode())]))
        return found[0] if found else False

    def _together(self, words: list[str], between: str, lead: str) -> list[Aligned | bool]:
        """Each of ``words``, encoded as one text with ``between`` before each and ``lead`` before all."""
        text = lead + between + between.join(words)
        sizes = np.array([len(w) if w.isascii() else len(w.encode()) for w in words])
        if between == " ":
            found = self._aligned(text, np.cumsum(sizes + 1))
        else:  # a stretch for what stands before each word
            bounds = np.cumsum(np.column_stack([np.full(len(words), len(between)), sizes]).ravel()) + len(lead)
            found = self._aligned(text, np.append(len(lead), bounds))
            found = found and found[2::2]
        if found is None:  # some word isn't given back
            found = [self._together([w], between, lead)[0] for w in words] if len(words) > 1 else [False]
        return found

    def _parts(self, word: str) -> list[str]:
        """``word`` cut where it surely is in both tokenizers: around a lone line feed, and between
        a plain letter and the closing marks that end a line."""
        out = []
        for k, line in enumerate(_LINE.split(word) if "\n" in word else (word,)):
            stem = line if k % 2 else line.rstrip(_CLOSING)
            if stem != line and stem[-1:].isalpha() and stem[-1] < "\u0250":
                out += stem, line[len(stem) :]
            else:
                out.append(line)
        return out

    def _encode(self, words: Iterable[str], into: dict[str, Aligned | bool], between: str, lead: str) -> None:
        """Learn ``words``, texts of ASCII apart from others (their spans need no map to bytes)."""
        for ascii_only in (True, False):
            some = [w for w in words if w.isascii() == ascii_only]
            for at in range(0, len(some), TOGETHER):
                batch = some[at : at + TOGETHER]
                into.update(zip(batch, self._together(batch, between, lead), strict=True))

    def _learn(self, words: Iterable[str], into: dict[str, Aligned | bool]) -> None:
        """Align ``words`` (that stand behind a space), most of them as compositions of parts."""
        heads, bare, composed = set(), set(), []
        for w in words:
            parts = self._parts(w) if self.closes and (w[-1] in _CLOSING or "\n" in w) else ()
            if len(parts) > 1 and not any(_BLANK.search(p) for p in parts[1:] if p != "\n"):
                composed.append((w, parts))
                bare.update(parts[1:])
                w = parts[0]
            if w not in into:
                heads.add(w)
        self._encode([w for w in heads if w[-1] != " "], into, " ", "")
        into.update([(w, self._whole(" " + w)) for w in heads if w[-1] == " "])
        bare.difference_update(self.bare)
        self._encode([p for p in bare if p != "\n"], self.bare, "\n", " .")
        if "\n" in bare:
            self.bare["\n"] = self._aligned(" .\n", np.array([2, 3]))[1]
        for w, parts in composed:
            records = [into[parts[0]], *map(self.bare.__getitem__, parts[1:])]
            if False in records:
                into[w] = False
            else:
                groups, links, n_a = zip(*records, strict=True)
                into[w] = ";".join(groups), b"".join(links), sum(n_a)

    def align(self, texts: list[str], regular: list[bool]) -> list[list[Aligned] | None]:
        """The aligned stretches of each text; None if it has no tokens. A text is ``regular`` if
        each of its spaces stands before a non-space."""
        rows, firsts = [], []
        for text, plain in zip(texts, regular, strict=True):
            if plain and text[:1] != " ":
                rows.append(text.split(" ") if text else [])
                firsts.append("")
            else:
                row = _CUT.split(" " + text)
                firsts.append(row.pop(0))
                rows.append(row)
        found = [list(map(self.met.get, row)) for row in rows]
        gaps = {k: [i for i, r in enumerate(records) if r is None] for k, records in enumerate(found) if None in records}
        missing = {rows[k][i] for k, places in gaps.items() for i in places}
        known = [w for w in missing if w in self.older]
        self.met.update([(w, self.older[w]) for w in known])
        missing.difference_update(known)
        passing: dict[str, Aligned | bool] = {}
        self._learn([w for w in missing if len(w) <= CACHED_LENGTH], self.met)
        self._learn([w for w in missing if len(w) > CACHED_LENGTH], passing)
        for k, places in gaps.items():
            row, records = rows[k], found[k]
            for i in places:
                w = row[i]
                records[i] = self.met[w] if w in self.met else passing[w]
        out: list[list[Aligned] | None] = []
        for text, first, records in zip(texts, firsts, found, strict=True):
            if first:
                records.insert(0, self._whole(first))
            out.append(None if not text or False in records else records)
        if len(self.met) > CACHE_WORDS:
            self.older, self.met = self.met, {}
        if len(self.bare) > CACHE_WORDS:
            self.bare = {}
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}

_DOC_SCHEMA = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs binary, times binary"


def alignments(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times[, groups]) of every row.

    ``pairs`` holds the document's distinct linked id pairs as ascending little-endian
    32-bit values (id of A, then ``B_BITS`` bits of id of B), ``times`` how often each is linked;
    ``groups`` is the text behind the digest.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _ALIGNERS.get((a_path, b_path)) or _ALIGNERS.setdefault((a_path, b_path), Aligner(a_path, b_path))
        for part in sliced(batches):
            rows, texts = [], pc.fill_null(part.column("text"), "")
            odd = pc.match_substring_regex(texts, IRREGULAR)
            for found in aligner.align(texts.to_pylist(), pc.invert(odd).to_pylist()):
                if found is None:
                    rows.append((0, 0, 0, 0, "", b"", b"", ""))
                    continue
                texts, links, n_a = zip(*found, strict=True)
                groups, n_a, n_links = ";".join(texts), sum(n_a), sum(map(len, links)) // 4
                n_groups = groups.count(";") + 1
                pairs, times = np.unique(np.frombuffer(b"".join(links), "<u4"), return_counts=True)
                digest = hashlib.sha256(groups.encode()).hexdigest()
                # every end of a token is an end of A, of B, or (a group's) of both
                rows.append((n_a, n_links + n_groups - n_a, n_groups, n_links, digest, pairs.tobytes(), times.astype("<u4").tobytes(), groups))
            columns = [pa.array(c) for c in zip(*rows, strict=True)]
            names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", "groups"]
            kept = len(names) if with_groups else len(names) - 1
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns[:kept]], ["doc_id", *names[:kept]])

    return id_text(docs).mapInArrow(encode, _DOC_SCHEMA + ", groups string" * with_groups)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no other pair of its A id has more."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed() -> tuple[np.ndarray, np.ndarray]:
            pairs = np.concatenate([p for p, _ in held])
            order = np.argsort(pairs, kind="stable")
            pairs = pairs[order]
            starts = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            return pairs[starts], np.add.reduceat(np.concatenate([n for _, n in held])[order], starts)

        held, size = [], 0
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), "<u4")
            if len(pairs):
                held.append(np.unique(pairs, return_counts=True))
                size += len(held[-1][0])
            if size > COUNT_BUFFER:
                held = [summed()]
                size = len(held[0][0])
                if size > COUNT_BUFFER // 2:  # mostly distinct: handed on
                    yield batch_of(*held[0])
                    held, size = [], 0
        if held:
            yield batch_of(*summed())

    def batch_of(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"])

    counts = aligned.select("pairs").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("a", F.shiftright("pair", B_BITS)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # a row per id of A
    return counts.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with n_best and count_sum, the counts sent to every task."""
    table = counts.sort("pair").toArrow()
    pairs = table.column("pair").to_numpy().astype(np.uint32)
    sent = aligned.sparkSession.sparkContext.broadcast((pairs, table.column("n").to_numpy().astype(np.int64), table.column("best").to_numpy()))
    del table, pairs

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for part in sliced(batches, "pairs", 8 << 20):
            own, times = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4") for c in ("pairs", "times"))
            at = np.searchsorted(known, own)
            edges = np.cumsum([0, *(len(x) // 4 for x in part.column("pairs").to_pylist())])
            sums = []
            for value in (times * best[at], times * n[at]):
                running = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
                sums.append(pa.array(running[edges[1:]] - running[edges[:-1]]))
            kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *sums, part.column("groups_sha256")], [*kept, "n_best", "count_sum", "groups_sha256"])

    return aligned.mapInArrow(look, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a shuffled join of the documents' pairs."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "pairs", 8 << 20):
            pairs, times = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4").astype(np.int64) for c in ("pairs", "times"))
            rows = np.repeat(np.asarray(part.column("row")), [len(x) // 4 for x in part.column("pairs").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(pairs), pa.array(times)], ["row", "pair", "times"])

    rows = written(aligned.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    each = rows.select("row", "pairs", "times").mapInArrow(spread, "row bigint, pair bigint, times bigint").join(counts, "pair")
    sums = each.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    out = rows.drop("pairs", "times").join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def link_strengths(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    aligned = written(alignments(docs, a_path, b_path), "alignments")
    counts = written(pair_counts(aligned), "pair-table")
    return _looked_up(aligned, counts) if counts.count() <= BROADCAST_PAIRS else _joined(aligned, counts)

"""Repair of conversation structure: the cheapest edits by a DAG of big-integer weights.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Rows may be
kept (0), given another role (1) or deleted (2), and turns without text inserted (5);
blank and repeated rows must go, and a cut-off row that stays costs 5 more. The edits
are a path through a DAG of (row, grammar state, rows inserted so far); each edge
weighs one integer, whose high digits are the cost and whose low digits, of a
fixed width each, are the audit letters at their places from the left, zeros behind the
end. All paths to a node have as many letters, so weights add up, and the
smallest integer is the cheapest path of ASCII-least audit.

Two passes. The first moves light rows only (hashes, flags): range partitions by
conversation and turn, so a conversation of any size is cut where partitions
(or ``PIECE`` rows) end; each piece yields its best path between any two states, and
pieces are put together by the same integers. The second sorts the texts by
conversation and streams them past the audit, holding one row at a time. It is
sequential within a conversation, as a digest of it must be.

Defined results: a null role, text, conversation or turn counts as one space where
it is read as text; null turns come first and take no part in ``gaps``; rows of one
turn are ordered by hashes of role and text, equal rows side by side; ``copies`` 0
lists a conversation without a row of it; null conversations are one conversation;
an empty table gives no rows; other columns are ignored. Roles are judged by
their first character; one that isn't s, u or a can't be kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Rows of a conversation that are solved at once.
PIECE = 1024
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Audit letters in ASCII order: digit 0 is the padding behind the end.
LETTERS = "DIKR"
D, I, K, R = range(1, 5)
WIDTH = 3
SYSTEM, USER, ASSISTANT, OTHER = range(4)
#: Grammar states: nothing yet, behind the system turn, behind a user, behind an assistant.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = {START: {SYSTEM: AFTER_S, USER: AFTER_U}, AFTER_S: {USER: AFTER_U}, AFTER_U: {ASSISTANT: AFTER_A}, AFTER_A: {USER: AFTER_U}}
#: The one role of user and assistant that may follow a state.
TURN = {START: USER, AFTER_S: USER, AFTER_U: ASSISTANT, AFTER_A: USER}
ACCEPTED = START, AFTER_A
PLAIN, GONE, TRUNCATED = range(3)
BLANKS = " \t\n\x0b\x0c\r"

Layer = dict[tuple[int, int], int]


def _cheapest(layer: Layer, bits: int) -> Layer:
    """Without nodes that a cheaper one of the same state makes useless."""
    least: dict[int, int] = {}
    for (q, _), w in layer.items():
        cost = w >> bits
        if least.get(q, cost) >= cost:
            least[q] = cost
    return {node: w for node, w in layer.items() if w >> bits == least[node[0]]}


def _with_inserts(layer: Layer, place: int, width: int) -> Layer:
    """``layer`` (behind ``place`` rows) and what inserted turns make of it: two lead to every state."""
    bits, out, edge = WIDTH * width, dict(layer), layer
    for _ in range(2):
        more: Layer = {}
        for (q, k), w in edge.items():
            node = NEXT[q][TURN[q]], k + 1
            w += (INSERT << bits) + (I << WIDTH * (width - 1 - place - k))
            if w < more.get(node, w + 1):
                more[node] = w
        edge = {}
        for node, w in more.items():
            if w < out.get(node, w + 1):
                out[node] = edge[node] = w
    return _cheapest(out, bits)


def _after_row(layer: Layer, initial: int, kind: int, place: int, width: int) -> Layer:
    bits, out = WIDTH * width, {}

    def offer(q: int, k: int, w: int) -> None:
        if w < out.get((q, k), w + 1):
            out[q, k] = w

    extra = CUT_OFF if kind == TRUNCATED else 0
    for (q, k), w in layer.items():
        at = WIDTH * (width - 1 - place - k)
        offer(q, k, w + (DELETE << bits) + (D << at))
        if kind != GONE:
            if initial in NEXT[q]:
                offer(NEXT[q][initial], k, w + (KEEP + extra << bits) + (K << at))
            offer(NEXT[q][TURN[q]], k, w + (REROLE + extra << bits) + (R << at))
    return _cheapest(out, bits)


def letters_room(rows: int) -> int:
    """Letters that a best path can have: one a row, and inserted turns that cost no
    more than to delete all rows and reach any state by two of them."""
    return rows + (DELETE * rows + 2 * INSERT) // INSERT


def letters_of(weight: int, count: int, width: int) -> str:
    return "".join(LETTERS[(weight >> WIDTH * (width - 1 - p) & (1 << WIDTH) - 1) - 1] for p in range(count))


def best_paths(rows: list[tuple[int, int]], entry: int) -> list[tuple[int, int, int, str]]:
    """(state, rows inserted, cost, letters) of the best paths over (initial, kind)
    rows from state ``entry``, inserted turns before any row included."""
    width = letters_room(len(rows)) + 2
    layer: Layer = {(entry, 0): 0}
    for place, (initial, kind) in enumerate(rows):
        layer = _after_row(_with_inserts(layer, place, width), initial, kind, place, width)
    return [(q, k, w >> WIDTH * width, letters_of(w, len(rows) + k, width)) for (q, k), w in layer.items()]


def _digits(letters: str) -> int:
    out = 0
    for c in letters:
        out = out << WIDTH | LETTERS.index(c) + 1
    return out


def joined_paths(pieces: list[tuple[int, list]]) -> tuple[int, str]:
    """(cost, audit) of the whole conversation from its pieces in order: (rows,
    [(entry, state, rows inserted, cost, letters)])."""
    total = sum(n for n, _ in pieces)
    width = letters_room(total) + 4
    bits, layer, place = WIDTH * width, {(START, 0): 0}, 0
    for n, paths in pieces:
        weighed = [(q, to, j, cost, len(x), _digits(x)) for q, to, j, cost, x in paths]
        out: Layer = {}
        for (q, k), w in layer.items():
            for entry, to, j, cost, count, digits in weighed:
                if entry == q:
                    found = w + (cost << bits) + (digits << WIDTH * (width - place - k - count))
                    if found < out.get((to, k + j), found + 1):
                        out[to, k + j] = found
        layer, place = _cheapest(out, bits), place + n
    layer = _with_inserts(layer, place, width)
    weight, count = min((w, place + k) for (q, k), w in layer.items() if q in ACCEPTED)
    return weight >> bits, letters_of(weight, count, width)


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _shaped(rows: DataFrame) -> DataFrame:
    """(unnamed, conv_id, turn, role, text, copies, h, h2): what both passes read."""
    copies = F.col("copies").cast("int") if "copies" in rows.columns else F.lit(1)
    out = rows.select(
        F.col("conv_id").isNull().alias("unnamed"), F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"), _text("role").alias("role"), _text("text").alias("text"), copies.alias("copies"),
    )
    return out.withColumn("h", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64("text", "role", F.lit(2)))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows after the damage that a hash of
    conversation and turn decides. A dropped row has 0 copies, a repeated one 2."""
    fate = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn"))) % 20
    text, role = _text("text"), _text("role")
    return conversations.select(
        F.col("conv_id"), F.col("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, F.lit(0)).when(fate == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _light(shaped: DataFrame) -> DataFrame:
    """One row for equal rows of a turn: (unnamed, conv_id, turn, h, h2, initial, kind, blank, n, again)."""
    shown = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    kind = F.when(shown == "", GONE).when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(PLAIN)
    coded = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    keys = ["unnamed", "conv_id", "turn", "h", "h2"]
    own = shaped.select(*keys, coded.cast("int").alias("initial"), kind.cast("int").alias("kind"), "copies")
    none = F.col("copies") == 0  # only the conversation's name counts
    own = own.select("unnamed", "conv_id", F.when(~none, F.col("turn")).alias("turn"), *(F.when(none, F.lit(0)).otherwise(F.col(c)).alias(c) for c in ("h", "h2", "initial", "kind")), "copies")
    light = written(own.groupBy(*keys, "initial", "kind", (F.col("copies") > 0).alias("real")).agg(F.sum("copies").alias("n")), "light-turns")
    # a row was seen before if its role and text stand in an earlier turn
    named = ["unnamed", "conv_id", "h", "h2"]
    real = light.where("real")
    earliest = real.groupBy(*named).agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.max(F.col("turn").isNull()).alias("untimed"))
    earliest = earliest.where("first_turn < last_turn or (untimed and first_turn is not null)").drop("last_turn")
    seen = written(earliest, "repeated-turns")
    again = F.coalesce(F.col("turn").isNotNull() & (F.col("untimed") | (F.col("turn") > F.col("first_turn"))), F.lit(False))
    return light.join(seen, named, "left").select(*keys, "initial", "kind", "real", "n", again.alias("again"))


_PIECE_SCHEMA = (
    "unnamed boolean, conv_id bigint, part int, piece int, rows bigint, first_turn bigint, last_turn bigint, turns bigint, head int, tail int, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, paths array<struct<entry:int,state:int,inserted:int,cost:bigint,letters:string>>"
)
_PIECE_FIELDS = [f.split()[0] for f in _PIECE_SCHEMA.replace("entry:int,state:int,inserted:int,cost:bigint,letters:string", "").split(", ")]


class _Piece:
    """Figures of a stretch of one conversation's rows, filled row by row."""

    def __init__(self, unnamed: bool, conv_id: int):
        self.unnamed, self.conv_id, self.codes = unnamed, conv_id, []
        self.rows = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = self.head = self.tail = None

    def add(self, turn: int | None, initial: int, kind: int, again: bool) -> None:
        self.rows += 1
        if turn is not None and turn != self.last_turn:
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
            self.turns += 1
        if self.tail is None:
            self.head = initial
        else:
            self.illegal += initial not in LEGAL.get(self.tail, ())
        self.tail = initial
        if kind == GONE:
            self.blank += 1
        elif again:
            self.duplicate, kind = self.duplicate + 1, GONE
        elif kind == TRUNCATED:
            self.truncated += 1
        self.codes.append((initial, kind))

    def record(self, part: int, number: int, entries: Iterable[int]) -> tuple:
        paths = [(entry, *found) for entry in entries for found in best_paths(self.codes, entry)] if self.rows else []
        return (
            self.unnamed, self.conv_id, part, number, self.rows, self.first_turn, self.last_turn, self.turns, self.head, self.tail,
            self.blank, self.duplicate, self.truncated, self.illegal, paths,
        )


#: Initials that may stand next to each other.
LEGAL = {SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def _records(rows: list[tuple]) -> pa.RecordBatch:
    path = pa.struct([("entry", pa.int32()), ("state", pa.int32()), ("inserted", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])
    kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.list_(path)]
    named = [(*r[:-1], [dict(zip(path.names, p, strict=True)) for p in r[-1]]) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*named, strict=True), kinds, strict=True)], _PIECE_FIELDS)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted light rows as pieces. Only a partition's first piece may follow on rows
    elsewhere, so the others start from no state but the first."""
    part, number, piece, fresh, out = TaskContext.get().partitionId(), 0, None, False, []

    def close() -> None:
        nonlocal number
        out.append(piece.record(part, number, (START,) if fresh else range(4)))
        number += 1

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("unnamed", "conv_id", "turn", "initial", "kind", "real", "n", "again")]
        for unnamed, conv_id, turn, initial, kind, real, n, again in zip(*columns, strict=True):
            if piece is None or (unnamed, conv_id) != (piece.unnamed, piece.conv_id):
                if piece is not None:
                    close()
                fresh, piece = piece is not None, _Piece(unnamed, conv_id)
            for k in range(n if real else 0):
                if piece.rows == PIECE:
                    close()
                    fresh, piece = False, _Piece(unnamed, conv_id)
                piece.add(turn, initial, kind, again or k > 0)
        if len(out) >= 1000:
            yield _records(out)
            out = []
    if piece is not None:
        close()
    if out:
        yield _records(out)


_REPORT = "unnamed boolean, conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _whole(pieces: list[dict]) -> tuple:
    """The report of one conversation from its pieces in order."""
    held = [p for p in pieces if p["rows"]]
    figures = {name: sum(p[name] for p in held) for name in ("turns", "blank", "duplicate", "truncated", "illegal")}
    timed = [p for p in held if p["turns"]]
    for a, b in zip(held, held[1:], strict=False):
        figures["illegal"] += b["head"] not in LEGAL.get(a["tail"], ())
    for a, b in zip(timed, timed[1:], strict=False):
        figures["turns"] -= a["last_turn"] == b["first_turn"]
    gaps = timed[-1]["last_turn"] - timed[0]["first_turn"] + 1 - figures["turns"] if timed else 0
    paths = [(p["rows"], [(x["entry"], x["state"], x["inserted"], x["cost"], x["letters"]) for x in p["paths"]]) for p in held]
    cost, audit = joined_paths(paths)
    return gaps, figures["blank"], figures["duplicate"], figures["truncated"], figures["illegal"], cost, audit


def _reports(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports from pieces sorted by conversation and place."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.bool_(), *[pa.int64()] * 7, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _REPORT.split(", ")])

    held, name, out = [], None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["unnamed"], row["conv_id"]) != name:
                if held:
                    out.append((*name, *_whole(held)))
                held, name = [], (row["unnamed"], row["conv_id"])
            held.append(row)
        if out:
            yield batch_of(out)
            out = []
    if held:
        yield batch_of([*out, (*name, *_whole(held))])


def reports(rows: DataFrame) -> DataFrame:
    """(unnamed, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
    order = ["unnamed", "conv_id", "turn", "h", "h2"]
    light = _light(_shaped(rows)).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = written(light.mapInArrow(_pieces, _PIECE_SCHEMA), "turn-pieces")
    by_conversation = pieces.repartition("unnamed", "conv_id").sortWithinPartitions("unnamed", "conv_id", "part", "piece")
    return by_conversation.mapInArrow(_reports, _REPORT)


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, int, str, str, str, int | None]]:
    """Repaired turns in order: (report row, position, letter, role, text, turn); position -1
    stands before each conversation. One row is held at a time."""
    letters: Iterator[str] = iter(())
    report: dict = {}
    state, position, pending = START, 0, ""

    def inserted() -> Iterator[tuple]:
        nonlocal pending, state, position
        while pending == "I":
            role = "user" if TURN[state] == USER else "assistant"
            yield report, position, "I", role, "", None
            state, position, pending = NEXT[state][TURN[state]], position + 1, next(letters, "")

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield from inserted()
                report, letters, state, position = row, iter(row["audit"]), START, 0
                pending = next(letters, "")
                yield report, -1, "", "", "", None
                continue
            for _ in range(row["copies"]):
                yield from inserted()
                letter, pending = pending, next(letters, "")
                if letter == "D":
                    continue
                role, initial = row["role"], "sua".find(row["role"][:1])
                if letter == "R":
                    initial = TURN[state]
                    role = "user" if initial == USER else "assistant"
                yield report, position, letter, role, row["text"], row["turn"]
                state, position = NEXT[state][initial], position + 1
    yield from inserted()


def _texts_behind_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order, in one partition."""
    texts = _shaped(rows).where("copies > 0").withColumn("kind", F.lit(1))
    both = texts.unionByName(found.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return both.repartition("unnamed", "conv_id").sortWithinPartitions("unnamed", "conv_id", "kind", "turn", "h", "h2")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, position, edit, turn, role, text): the repaired conversations; ``edit`` is K, R or I."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            kinds = pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "position", "edit", "turn", "role", "text"])

        held = 0
        for report, position, letter, role, text, turn in _edited(batches):
            if position >= 0:
                out.append((None if report["unnamed"] else report["conv_id"], position, letter, turn, role, text))
                held += len(text)
            if held > 1 << 22 or len(out) >= 10_000:
                yield batch_of()
                out, held = [], 0
        if out:
            yield batch_of()

    found = written(reports(rows), "turn-audits")
    return _texts_behind_audits(rows, found).mapInArrow(emit, "conv_id bigint, position bigint, edit string, turn bigint, role string, text string")


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation; the digest is that of its repaired turns as ``role:text`` lines."""
    columns = [f.split()[0] for f in _REPORT.split(", ")]

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, report, digest = [], None, None
        kinds = [pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string()]

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [*columns, "repaired_sha256"])

        for own, position, _, role, text, _ in _edited(batches):
            if position < 0:
                if report is not None:
                    out.append((*(report[c] for c in columns), digest.hexdigest()))
                report, digest = own, hashlib.sha256()
                if len(out) >= 1000:
                    yield batch_of()
                    out = []
            else:
                digest.update((("\n" if position else "") + role + ":" + text).encode())
        if report is not None:
            out.append((*(report[c] for c in columns), digest.hexdigest()))
        if out:
            yield batch_of()

    found = written(reports(rows), "turn-audits")
    digests = _texts_behind_audits(rows, found).mapInArrow(emit, _REPORT + ", repaired_sha256 string")
    name = F.when(~F.col("unnamed"), F.col("conv_id")).alias("conv_id")
    return digests.select(name, *columns[2:], "repaired_sha256")

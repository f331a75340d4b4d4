from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tidewater.llm import conversations as C

COLUMNS = "conv_id bigint, turn bigint, role string, text string, copies2 string, h string, audit string, state string, kind string"


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", "h", "a", "s", "k") for r in rows], COLUMNS)

    return make


def plain_damage(rows):
    """{conv_id: [(turn, role, text)]}, every conversation listed."""
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        held, fate = out.setdefault(conv, []), zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        held += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain_repair(rows):
    """Figures of ordered rows (turn, role, text): suffixes chosen as (cost, letters), by recursion on rows and states."""
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    kinds, seen = [], set()
    for _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        kinds.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    # e: nothing yet, then the last initial
    may = {"e": "su", "s": "u", "u": "a", "a": "u"}
    after = {}
    for i in range(len(rows), -1, -1):
        base = {}
        for q in may:
            options = []
            if i == len(rows):
                options += [(0, "", ())] if q in "ea" else []
            else:
                _, role, text = rows[i]
                c, x, turns_ = after[i + 1, q]
                options.append((c + 2, "D" + x, turns_))
                if kinds[i] not in ("blank", "duplicate"):
                    more = 5 if kinds[i] == "truncated" else 0
                    if role[:1] and role[:1] in may[q]:
                        c, x, turns_ = after[i + 1, role[0]]
                        options.append((c + more, "K" + x, ((role, text), *turns_)))
                    for to in set(may[q]) & set("ua"):
                        c, x, turns_ = after[i + 1, to]
                        options.append((c + 1 + more, "R" + x, (({"u": "user", "a": "assistant"}[to], text), *turns_)))
            base[q] = min(options, default=(10**9, "", ()))
        for _ in range(3):  # inserted turns before this row
            for q in may:
                for to in set(may[q]) & set("ua"):
                    c, x, turns_ = base[to]
                    base[q] = min(base[q], (c + 5, "I" + x, (({"u": "user", "a": "assistant"}[to], ""), *turns_)))
        for q in may:
            after[i, q] = base[q]
    cost, audit, turns_ = after[0, "e"]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns_))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns_).encode()).hexdigest()
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), turns_


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(table, rows, partitions=3):
    got = {r.conv_id: tuple(r[f] for f in FIELDS) for r in C.repaired(C.damaged(table(rows).repartition(partitions))).collect()}
    want = {conv: plain_repair(ordered(held))[0] for conv, held in plain_damage(rows).items()}
    assert got == want


def made(r, conv, n):
    texts = ["Hello there.", "what now?", "cut off", "cut off ", "   ", "", "\t\n", "Yes!", "é。", "ok. ", "x\x1c", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys", "User"]
    return [(conv, t, r.choice(roles[:5]) if r.random() < 0.8 else r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"text {r.random()}.") for t in sorted(r.sample(range(3 * n), n))]


def test_random_conversations_against_plain_recursion(table):
    r = random.Random(1)
    check(table, [row for conv in range(250) for row in made(r, conv - 5, r.randrange(1, 14))])


@pytest.mark.parametrize("piece", [1, 2, 7])
def test_pieces_join_to_the_same_paths(table, monkeypatch, piece):
    monkeypatch.setattr(C, "PIECE", piece)
    r = random.Random(piece)
    check(table, [row for conv in range(60) for row in made(r, conv, r.randrange(1, 30))], 8)


def test_one_conversation_of_most_rows(table, spark):
    """It is cut into pieces and over partitions, and put together again."""
    r = random.Random(4)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        check(table, made(r, 7, 2500) + [row for conv in range(100, 150) for row in made(r, conv, 4)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_equal_rows_of_one_turn_in_great_numbers(table):
    check(table, [(1, 5, "user", "Same.")] * 700 + [(1, 6, "assistant", "Fine.")] + [(2, None, "user", "Same.")] * 300)


def test_nulls_and_dropped_conversations(table):
    gone = [(c, t) for c in range(300) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    rows = [(c, t, "user", "Gone.") for c, t in gone[:4]]
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho."), (5000, None, "user", "A."), (5000, 3, "user", "A."), (5000, 9, "assistant", "B.")]
    check(table, rows)
    report = {r.conv_id: r for r in C.repaired(C.damaged(table(rows))).collect()}
    alone = [c for c, _ in gone[:4] if sum(x == c for x, _ in gone[:4]) == 1]
    for c in alone:
        assert (report[c].gaps, report[c].cost, report[c].audit, report[c].repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_very_long_texts(table):
    assert C.repaired(C.damaged(table([]))).collect() == []
    assert C.repaired_turns(table([])).collect() == []
    check(table, [(c, t, ("user", "assistant")[t % 2], "w " * 300_000 + ".") for c in (1, 2) for t in range(4)])


def test_repaired_turns_are_the_texts_behind_the_digest(table):
    r = random.Random(9)
    rows = [row for conv in range(40) for row in made(r, conv, r.randrange(1, 9))]
    found = {}
    for t in C.repaired_turns(C.damaged(table(rows))).collect():
        found.setdefault(t.conv_id, {})[t.position] = (t.role, t.text)
    for conv, held in plain_damage(rows).items():
        turns = plain_repair(ordered(held))[1]
        assert [found.get(conv, {}).get(p) for p in range(len(found.get(conv, {})))] == list(turns)


def test_undamaged_rows_need_no_copies_column(table):
    got = C.repaired(table([(1, 1, "user", "Hi."), (1, 2, "assistant", "Ho."), (2, 1, "assistant", "Ho.")])).collect()
    assert {(r.conv_id, r.cost, r.audit) for r in got} == {(1, 0, "KK"), (2, 2, "D")}


def test_ties_are_ascii_least():
    width = C.letters_room(2) + 4
    assert C.LETTERS == "".join(sorted("KRDI")) and width > 2
    # two user turns: the second becomes the answer
    cost, audit = C.joined_paths([(2, [(C.START, *p) for p in C.best_paths([(C.USER, C.PLAIN)] * 2, C.START)])])
    assert (cost, audit) == (1, "KR")

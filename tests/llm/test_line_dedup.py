from __future__ import annotations

import duckdb
import pytest

from tidewater.llm import line_dedup as L

COLUMNS = ("doc_id", "n_lines", "n_removed", "kept_sha256")


def got(frame, **kw):
    return sorted(tuple(r[c] for c in COLUMNS) for r in L.remove_boilerplate(frame, **kw).collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_against_sql(spark, sf):
    path = f"/root/testdata/sf{sf}/documents.parquet"
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
        want = sorted(db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({L.ORACLE_SQL})").fetchall())
    assert got(spark.read.parquet(path)) == want


def test_near_and_sure_lines_by_plain_counts(frame):
    # spreads from 1 to 40 sites around a threshold of 20: some by sketch, some exactly
    rows = []
    for k in range(1, 41):
        rows += [(k * 100 + s, f"line {k}\nown {k} {s}\n line {k} ", None, f"site{s}") for s in range(k)]
    result = {r[0]: r[2] for r in got(frame(rows), sites=20)}
    assert all(result[k * 100 + s] == (2 if k >= 20 else 0) for k in range(1, 41) for s in range(k))


def test_defined_cases(frame):
    rows = [(d, "common\n\n  \nkept" if d % 2 else "common", None, f"s{d}") for d in range(8)]
    rows += [(None, "common\nx", None, None), (20, None, None, "s1"), (21, "", None, "s2"), (1, rows[1][1], None, "s1"), (1, "other", None, "s1")]
    rows += [(30, "lonely\n" * 20_000 + "common", None, "s3")]
    frame_ = frame(rows)
    out = L.remove_boilerplate(frame_, with_text=True).collect()
    assert len(out) == len(rows)
    kept = {}
    for r in out:
        kept.setdefault(r.doc_id, set()).add((r.kept, r.n_lines, r.n_removed))
    assert kept[0] == {("", 1, 1)} and kept[1] == {("\n  \nkept", 4, 1), ("other", 1, 0)}
    assert kept[None] == {("x", 2, 1)} and kept[20] == kept[21] == {("", 1, 0)}
    assert kept[30] == {("lonely\n" * 19_999 + "lonely", 20_001, 1)}
    assert L.remove_boilerplate(frame_.limit(0)).collect() == []

"""The command line drives the same functions end to end."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from tests import snippets as S
from tidewater.__main__ import main
from tidewater.sinks.runs import current_runs


def landed(tmp_path, text):
    folder = tmp_path / "landed" / "buoy_id=62107"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "62107h2016.txt").write_text(text)
    return str(tmp_path / "landed")


def test_commands_end_healthy(spark, tmp_path, capsys):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    land = landed(tmp_path, S.SENTINELS)
    assert main(["ingest", "--landed", land, "--bronze", bronze, "--silver", silver]) == 0
    assert main(["silver", "--bronze", bronze, "--silver", silver]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["years"] == {"2016": {"loaded": 2, "rejected": 0, "flagged": 0}}
    assert main(["health", "--silver", silver, "--as-of", "2016-09-22 00:00:00"]) == 0
    assert "HEALTHY" in capsys.readouterr().out
    assert main(["health", "--silver", silver, "--as-of", "2016-12-01 00:00:00"]) == 1
    assert "FRESHNESS" in capsys.readouterr().out
    assert main(["silver", "--bronze", bronze, "--silver", silver, "--force"]) == 0
    assert main(["vacuum", "--silver", silver, "--grace-hours", "0"]) == 0
    assert len(json.loads(capsys.readouterr().out.splitlines()[-1])["removed"]) == 1


def test_crashed_ingest_is_seen(spark, tmp_path, monkeypatch):
    from tidewater.plans import ingest

    def crash(*_):
        raise OSError("gone")

    monkeypatch.setattr(ingest, "ingest_landed_files", crash)
    silver = str(tmp_path / "silver")
    with pytest.raises(OSError):
        main(["ingest", "--landed", "x", "--bronze", "y", "--silver", silver])
    (row,) = current_runs(spark, silver).collect()
    assert (row["stage"], row["status"]) == ("scrape", "failed") and "gone" in row["error"]


def test_fetch_plan_command(spark, tmp_path):
    html = '<div><a id="stdmet">x</a><ul class="histfiles"><li>62107: <a href="/download_data.php?filename=62107h2016.txt.gz">2016</a></li></ul></div>'
    index, out, bronze = str(tmp_path / "index"), str(tmp_path / "out"), str(tmp_path / "bronze")
    spark.createDataFrame([("u", html)], "url string, html string").write.parquet(index)
    args = ["plan", "--index", index, "--bronze", bronze, "--year", str(dt.date(2020, 1, 1).year)]
    assert main([*args, "--out", out]) == 0
    assert sorted(r["kind"] for r in spark.read.parquet(out).collect()) == ["observations", "station_page"]
    assert main(["ingest", "--landed", landed(tmp_path, S.SENTINELS), "--bronze", bronze]) == 0
    assert main([*args, "--out", out + "2"]) == 0
    assert [r["kind"] for r in spark.read.parquet(out + "2").collect()] == ["station_page"]

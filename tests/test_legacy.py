"""Legacy per-file bronze (types drifting per file) -> bronze."""

from __future__ import annotations

import datetime as dt
import io
import os

import pandas as pd
import pytest

from tests import snippets as S
from tidewater.sources.bronze import current_sources, read_bronze_observations, read_coordinates, read_observations
from tidewater.sources.legacy import convert_legacy_bronze, convert_legacy_coordinates


def legacy_file(root, buoy_id, year, stem, text=None, frame=None):
    frame = pd.read_csv(io.StringIO(text), sep=r"\s+") if frame is None else frame
    folder = os.path.join(root, "observations", f"buoy_id={buoy_id}", f"year={year}")
    os.makedirs(folder, exist_ok=True)
    frame.to_parquet(os.path.join(folder, f"{stem}.parquet"), index=False)
    return os.path.join(folder, f"{stem}.parquet")


def test_convert_mixed_types(spark, tmp_path):
    legacy, out = str(tmp_path / "legacy"), str(tmp_path / "bronze")
    # a units row makes every column text; without one they are integers and floats
    legacy_file(legacy, "62107", "2016", "62107h2016", S.SENTINELS)
    legacy_file(legacy, "62112", "2019", "62112h2019", S.MONTH_MINUTE.replace(S.FULL_UNITS + "\n", ""))
    legacy_file(legacy, "62111", "2018", "62111h2018", S.WITH_PTDY)
    legacy_file(legacy, "62111", "2018", "no-columns", frame=pd.DataFrame([]))
    cut = legacy_file(legacy, "62111", "2018", "cut-off", S.WITH_PTDY)
    with open(cut, "r+b") as handle:
        handle.truncate(40)
    counters = convert_legacy_bronze(spark, legacy, out)
    assert (counters["files"], counters["unusable"]) == (3, 2)
    rows = {(r["buoy_id"], r["datetime"]): r for r in read_observations(spark, out).collect()}
    assert sorted(rows) == [
        ("62107", dt.datetime(2016, 9, 21, 18, 20)),
        ("62107", dt.datetime(2016, 9, 21, 18, 50)),
        ("62111", dt.datetime(2018, 4, 12, 9, 30)),
        ("62112", dt.datetime(2019, 11, 6, 14, 52)),
    ]
    assert rows["62111", dt.datetime(2018, 4, 12, 9, 30)]["pressure_tendency"] == -1.6


def test_minutes_typed_as_floats_are_kept(spark, tmp_path):
    """One short line makes the minute column a float: 50.0 is minute 50."""
    legacy, out = str(tmp_path / "legacy"), str(tmp_path / "bronze")
    frame = pd.DataFrame({"#YY": [2011, 2011, 2011], "MM": [5, 5, 5], "DD": [1.0, 2.0, 3.0], "hh": [3, 3, 3], "mm": [50.0, None, 20.0], "WSPD": [1.5, 2.0, 2.5]})
    legacy_file(legacy, "62120", "2011", "62120h2011", frame=frame)
    convert_legacy_bronze(spark, legacy, out)
    got = sorted((r["datetime"], r["wind_speed"]) for r in read_observations(spark, out).collect())
    assert got == [(dt.datetime(2011, 5, 1, 3, 50), 1.5), (dt.datetime(2011, 5, 2, 3, 0), 2.0), (dt.datetime(2011, 5, 3, 3, 20), 2.5)]


def test_storage_errors_are_not_unusable_files(spark, tmp_path, monkeypatch):
    from tidewater.sources import bronze

    def broken(path):
        raise PermissionError(path)

    monkeypatch.setattr(bronze, "open_parquet", broken)
    with pytest.raises(PermissionError):
        list(bronze._probe_footers([pd.DataFrame({"path": ["file:/x"]})]))


def test_convert_legacy_coordinates(spark, tmp_path):
    legacy = tmp_path / "legacy"
    for buoy, lat, lon in [("62107", 51.1, -2.7), ("0078", None, None)]:
        folder = legacy / "coordinates" / f"buoy_id={buoy}"
        folder.mkdir(parents=True)
        pd.DataFrame([{"latitude": lat, "longitude": lon}]).to_parquet(folder / "part.parquet", index=False)
    counters = convert_legacy_coordinates(spark, str(legacy), str(tmp_path / "bronze"))
    assert (counters["stations"], counters["coordinates_missing"]) == (2, 1)
    got = {r["buoy_id"]: (r["latitude"], r["longitude"]) for r in read_coordinates(spark, str(tmp_path / "bronze")).collect()}
    assert got == {"62107": (51.1, -2.7), "0078": (None, None)}


def test_header_only_file_counts_as_held(spark, tmp_path):
    legacy, out = str(tmp_path / "legacy"), str(tmp_path / "bronze")
    legacy_file(legacy, "62121", "2012", "62121h2012", frame=pd.DataFrame([], columns=["#YY", "MM", "DD", "hh", "ATMP"]))
    assert convert_legacy_bronze(spark, legacy, out)["rows_written"] == 1
    assert [(r["buoy_id"], r["year"], r["source_stem"]) for r in current_sources(spark, out).collect()] == [("62121", "2012", "62121h2012")]
    (header,) = read_bronze_observations(spark, out).collect()
    assert (header["line_no"], header["yy_hash"], header["minute_raw"]) == (0, "#YY", None)
    assert read_observations(spark, out).count() == 0

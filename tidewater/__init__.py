"""tidewater: station-observation pipeline built on Spark DataFrames.

Landed whitespace-delimited station files and station pages are decoded into
a bronze table, cleaned into a typed silver table, and published as yearly
Parquet snapshots tracked by an append-only ledger. Everything is expressed
with built-in DataFrame / SQL functions so Catalyst plans the work.

Main entry points::

    from tidewater import build_session, ingest_landed_files, run_silver
    from tidewater import read_observations, read_published_observations
"""

from tidewater.session import build_session, configure  # noqa: I001

from tidewater.operators.observations import clean_observations, dedup_keep_first, normalize
from tidewater.plans.ingest import ingest_landed_files, ingest_station_pages, ingest_station_text, plan_fetch
from tidewater.plans.silver_load import run_silver
from tidewater.sinks.silver import read_published_coordinates, read_published_observations, vacuum_snapshots
from tidewater.sources.bronze import read_coordinates, read_observations
from tidewater.sources.station_text import decode_station_text, landed_station_files

__all__ = [
    "build_session",
    "clean_observations",
    "configure",
    "decode_station_text",
    "dedup_keep_first",
    "ingest_landed_files",
    "ingest_station_pages",
    "ingest_station_text",
    "landed_station_files",
    "normalize",
    "plan_fetch",
    "read_coordinates",
    "read_observations",
    "read_published_coordinates",
    "read_published_observations",
    "run_silver",
    "vacuum_snapshots",
]

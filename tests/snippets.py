"""Station files for the tests. Header and units lines are the file format;
the data rows are made up here."""

from __future__ import annotations

_FIELDS = "MM DD hh mm WDIR WSPD GST WVHT DPD APD MWD PRES ATMP WTMP DEWP VIS TIDE"
_UNITS = "mo dy hr mn degT m/s m/s m sec sec degT hPa degC degC degC nmi ft"

FULL_HEADER = f"#YY {_FIELDS}"
FULL_UNITS = f"#yr {_UNITS}"


def station_file(*lines: str, header: str = FULL_HEADER, units: str | None = FULL_UNITS) -> str:
    return "\n".join([header, *([units] if units else []), *lines]) + "\n"


#: Each column's own missing-value marker, in the order of the fields.
ALL_MARKERS = "999 99.0 99.0 99.00 99.00 99.00 999 9999.0 999.0 999.0 999.0 99.0 99.00"

# 99 is a bearing and no marker, 99.0 is the marker of a speed.
SENTINELS = station_file(
    "2016 09 21 18 20 099 99.0 7.3 2.4 8.1 6.2 205 1004.6 12.7 13.9 8.8 6.1 0.7",
    f"2016 09 21 18 50 {ALL_MARKERS}",
)
FOUR_DIGIT = station_file("2008 11 30 21 10 312 9.4 12.2 3.1 9.9 7.0 300 998.7 4.2 6.6 1.9 4.4 2.2", header=f"YYYY {_FIELDS}", units=f"yr {_UNITS}")
TWO_DIGIT = station_file(
    "84 02 17 06 40 045 2.1 2.9 0.4 3.3 2.8 050 1021.4 -3.5 1.2 -7.7 8.3 0.2",
    "31 02 17 06 40 046 2.2 3.0 0.5 3.4 2.9 051 1021.5 -3.4 1.3 -7.6 8.2 0.1",
    header=f"YY {_FIELDS}", units=f"yr {_UNITS}",
)
LEADING_ZERO = station_file("07 08 08 13 00 188 6.6 8.1 1.7 6.0 4.9 190 1011.9 24.4 25.0 21.6 7.7 1.1", header=f"YY {_FIELDS}", units=f"yr {_UNITS}")
NO_MINUTE = station_file(
    "2017 10 04 22 271 3.9 5.2 0.6 4.4 3.7 265 1018.3 9.1 11.0 5.5 5.9 0.9",
    header=FULL_HEADER.replace(" mm", ""), units=FULL_UNITS.replace(" mn", ""),
)
WITH_PTDY = station_file(
    "2018 04 12 09 30 017 7.8 10.1 1.9 7.2 5.1 020 1009.4 6.3 7.5 2.2 3.8 -1.6 0.4",
    header=FULL_HEADER.replace("TIDE", "PTDY TIDE"), units=FULL_UNITS.replace(" ft", " hPa ft"),
)
DUPLICATE = station_file(
    "2014 12 03 04 10 333 1.1 1.9 0.3 2.9 2.2 330 1027.7 -1.4 3.3 -6.1 9.2 0.6",
    "2014 12 03 04 10 334 1.2 2.0 0.4 3.0 2.3 331 1027.8 -1.3 3.4 -6.0 9.1 0.5",
)
MONTH_MINUTE = station_file("2019 11 06 14 52 222 4.7 6.1 1.4 5.8 4.6 210 1002.2 8.9 10.4 7.1 2.6 1.3")
CORRUPT_HOUR = station_file("2016 09 21 ?? 20 150 5.0 6.4 1.2 5.5 4.1 140 1007.1 11.1 12.6 9.4 6.6 0.8")
MISFILED = station_file(
    "2015 12 31 23 50 080 2.8 3.6 0.7 4.8 3.9 075 1016.0 3.3 5.5 0.1 7.4 1.0",
    "2016 01 01 00 20 081 2.9 3.7 0.8 4.9 4.0 076 1015.9 3.2 5.4 0.2 7.3 0.9",
)
HEADER_ONLY = "#YY MM DD hh mm WDIR WSPD GST\n"
SHORT_ONE_ROW = station_file("2005 07 19 16 40 265 3.4 1019.8", header="#YY MM DD hh mm WDIR WSPD PRES", units=None)

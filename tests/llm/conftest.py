"""Fixtures of the training-data operator tests."""

from __future__ import annotations

import pytest


@pytest.fixture
def frame(spark):
    """Documents as a frame, with extra columns whose names clash with the operators' own."""

    def make(rows, **extra):
        extra = {"ids": "x", "start": "y", "part": "z", "score": "s", "label": "l", **extra}
        columns = ", ".join(f"{k} string" for k in extra)
        return spark.createDataFrame(
            [(*row, *extra.values()) for row in rows], f"doc_id bigint, text string, lang string, source string, {columns}"
        )

    return make

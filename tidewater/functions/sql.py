"""Helpers for writing Spark SQL expression text."""

from __future__ import annotations


def literal(text: str) -> str:
    """A Spark SQL string literal (backslashes and quotes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    """A quoted column name."""
    return "`" + name.replace("`", "``") + "`"

"""Number formats of the dashboard: SQL expressions in, SQL text expressions out.

A value is rounded half-up in DECIMAL and its exact digits are printed, so the text
never depends on a binary float. NULL stays NULL.
"""

from __future__ import annotations

from string import Formatter


def literal(value: str) -> str:
    """A string as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def money(value: str) -> str:
    """``$1,234.50``"""
    return f"CONCAT('$', FORMAT_NUMBER(CAST({value} AS DECIMAL(38,2)), 2))"


def whole(value: str) -> str:
    """``1,234``"""
    return f"FORMAT_NUMBER(CAST({value} AS BIGINT), 0)"


def percent(value: str, places: int) -> str:
    """A fraction as ``12.3%``."""
    return f"CONCAT({_fixed(f'CAST({value} AS DECIMAL(30,8)) * 100', places)}, '%')"


def times(value: str) -> str:
    """A multiple as ``4.9x``."""
    return f"CONCAT({_fixed(value, 1)}, 'x')"


def _fixed(value: str, places: int) -> str:
    return f"CAST(CAST({value} AS DECIMAL(38,{places})) AS STRING)"


def fill(template: str, fields: dict[str, str]) -> str:
    """Put text expressions into the ``{name}`` gaps of ``template``; a NULL shows as n/a."""
    parts = []
    for before, name, _, _ in Formatter().parse(template):
        if before:
            parts.append(literal(before))
        if name:
            parts.append(f"COALESCE({fields[name]}, 'n/a')")
    return f"CONCAT({', '.join(parts)})"

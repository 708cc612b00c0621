"""Fixed-layout records in SQL, spelt field by field for the twins of the register queries."""

from __future__ import annotations

from ..sinks.writers import Out

_DATE = {"d": "%d", "M": "%m", "y": "%Y"}


def _field(f: Out, columns: dict[str, str]) -> str:
    w = f.length
    if f.kind == "constant":
        return f"'{f.fmt}'"
    c = columns.get(f.name)
    if f.kind == "text":
        return f"rpad(substr(coalesce(CAST({c} AS VARCHAR), ''), 1, {w}), {w}, ' ')" if c else f"repeat(' ', {w})"
    if f.kind == "day":
        pattern = "".join(_DATE[k] for k in dict.fromkeys(f.fmt))
        return f"coalesce(strftime({c}, '{pattern}'), repeat('0', {w}))" if c else f"repeat('0', {w})"
    if f.kind == "zero":
        n = f"CAST(round({c}) AS HUGEINT)"
        return (f"CASE WHEN {c} IS NULL THEN repeat('0', {w}) WHEN {n} < 0 THEN '-' || lpad(CAST(-{n} AS VARCHAR), {w - 1}, '0') ELSE lpad(CAST({n} AS VARCHAR), {w}, '0') END"
                if c else f"repeat('0', {w})")
    if f.kind == "dec":
        return f"coalesce(lpad(CAST(CAST({c} AS DECIMAL(30,{f.decimals})) AS VARCHAR), {w}, ' '), repeat(' ', {w}))" if c else f"repeat(' ', {w})"
    return f"coalesce(lpad(CAST(CAST({c} AS BIGINT) AS VARCHAR), {w}, ' '), repeat(' ', {w}))" if c else f"repeat(' ', {w})"


def record_sql(layout: list[Out], columns: dict[str, str] | list[str]) -> str:
    """The record as a SQL expression; ``columns`` are the fields that the source has, as expressions (all others are missing)."""
    columns = columns if isinstance(columns, dict) else {c: c for c in columns}
    parts, at = [], 1
    for f in sorted(layout, key=lambda f: f.start):
        if f.start > at:
            parts.append(f"repeat(' ', {f.start - at})")
        parts.append(_field(f, columns))
        at = f.start + f.length
    return " || ".join(f"({p})" for p in parts)

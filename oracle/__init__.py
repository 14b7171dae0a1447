"""Check SQL (DuckDB) for the named queries, written independently of the Spark plans."""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    from oracle import catalog, monitoring, operators, reports

    merged: dict[str, str] = {}
    for part in (catalog, operators, reports, monitoring):
        merged.update(part.SQL)
    return merged

"""Independent ANSI SQL answers for every registered query, run by DuckDB on the same tables."""


def all_queries() -> dict[str, str]:
    """Complete statements by query id."""
    from oracle import core, feeds, reports, rules
    from oracle.base import query

    merged: dict[str, str] = {}
    for module in (core, reports, rules, feeds):
        merged |= module.QUERIES
    return {name: query(sql) for name, sql in merged.items()}

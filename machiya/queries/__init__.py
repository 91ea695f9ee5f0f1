"""Query modules: each has QUERIES (name -> function of session and folder) and SQL (name -> DuckDB text)."""


def registry() -> list:
    from machiya.queries import changes_units, extraction, market, scalars, streams

    return [changes_units, scalars, market, extraction, streams]

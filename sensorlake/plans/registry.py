"""Collects queries and the SQL that must give the same rows."""

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register a function of (spark, sf_dir); without SQL only its rows are checked."""

    def add(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add

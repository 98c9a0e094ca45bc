"""Single registry of catalogue queries and their SQL twins."""

from __future__ import annotations

from quarry.plans import oracle, tables, tables_ml, tables_stream


def all_queries() -> dict:
    out = dict(tables.QUERIES)
    out.update(tables_ml.QUERIES)
    out.update(tables_stream.QUERIES)
    return out


def all_oracle_sql() -> dict[str, str]:
    sql = dict(oracle.ORACLE_SQL)
    sql.update(tables_ml.ORACLE_SQL)
    sql.update(tables_stream.ORACLE_SQL)
    # The stream's result equals its batch twin's (complete mode keeps all).
    sql["stream_trending_tags"] = oracle.ORACLE_SQL["trending_tags"]
    sql["stream_updates"] = oracle.ORACLE_SQL["trending_tags"]
    keys = all_queries().keys()
    return {k: v for k, v in sql.items() if k in keys and v}

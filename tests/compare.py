"""Run a registered query and its SQL on the same tables and compare rows, names and types."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


# Spark type -> SQL type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def compare(query, sql: str, spark, folder: str, con) -> list[str]:
    """The list of differences; empty if the two agree."""
    df = query(spark, folder)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    theirs_rows = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        other = types[names.index(name)]
        if TYPES.get(kind) != other:
            problems.append(f"type of {name}: {kind} against {other}")
    order = sorted(names)
    ours = Counter(tuple(_plain(r[c]) for c in order) for r in df.collect())
    theirs = Counter(tuple(_plain(r[names.index(c)]) for c in order) for r in theirs_rows)
    if ours != theirs:
        extra, missing = list((ours - theirs).elements())[:3], list((theirs - ours).elements())[:3]
        problems.append(
            f"{sum(ours.values())} against {sum(theirs.values())} rows; only here {extra}; only in SQL {missing}"
        )
    return problems

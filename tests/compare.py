"""Compare a registered query with its SQL twin: same columns, same multiset of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    """Doubles must agree to the last bit; only NaN is brought to one form."""
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    theirs_rel = con.execute(sql)
    theirs_names = [c[0] for c in theirs_rel.description]
    theirs_types = {c[0]: str(c[1]) for c in theirs_rel.description}
    names, want = _rows(theirs_names, theirs_rel.fetchall())
    mine_names, have = _rows(frame.columns, frame.collect())
    if mine_names != names:
        return [f"columns: {mine_names} against {names}"]
    found = []
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}
    for field in frame.schema:
        kind = kinds[field.dataType.simpleString()]
        if theirs_types[field.name] not in (kind, "STRING" if kind == "VARCHAR" else kind, "NUMBER"):
            found.append(f"type of {field.name}: {kind} against {theirs_types[field.name]}")
    if have != want:
        found.append(f"{sum(have.values())} rows against {sum(want.values())}; only ours {list((have - want).items())[:3]}; only theirs {list((want - have).items())[:3]}")
    return found

"""Compare a registered query with its SQL: column names, types, and values in any row order."""

import decimal

import duckdb

from tallyspan.plans.registry import ORACLES, QUERIES
from tallyspan.tables import SCHEMAS

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in SCHEMAS:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, float):
        return "nan" if v != v else v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def differences(spark, con, sf_dir, key):
    """(number of rows, list of differences)."""
    df = QUERIES[key](spark, sf_dir)
    rows = df.collect()
    if key not in ORACLES:
        return len(rows), [] if rows else ["empty result"]
    cur = con.execute(ORACLES[key])
    want_types = {d[0]: str(d[1]) for d in cur.description}
    names = list(want_types)
    want = cur.fetchall()
    got_types = dict(df.dtypes)
    if set(got_types) != set(want_types):
        return len(rows), [f"columns {sorted(got_types)} != {sorted(want_types)}"]
    notes = [
        f"type {n}: {t} != {want_types[n]}" for n, t in got_types.items() if TYPES.get(t, t.upper()) != want_types[n].upper()
    ]
    order = sorted(got_types)
    got = sorted((tuple(plain(r[n]) for n in order) for r in rows), key=repr)
    exp = sorted((tuple(plain(r[names.index(n)]) for n in order) for r in want), key=repr)
    if got != exp:
        gs, es = set(got), set(exp)
        notes.append(
            f"{len(got)} rows, expected {len(exp)}; values of {order}\n   only spark {sorted(gs - es, key=repr)[:3]}\n   only sql   {sorted(es - gs, key=repr)[:3]}"
        )
    if not got:
        notes.append("empty result")
    return len(rows), notes

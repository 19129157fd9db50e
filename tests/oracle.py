"""Compare a registered query with its SQL counterpart, value by value."""

import datetime
import decimal
import math

import duckdb

from sightline.bindings.core import TABLES


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


KINDS = {"int": "tinyint smallint int integer bigint long", "float": "float double", "text": "string varchar",
         "time": "timestamp timestamp_ntz"}


def kind(name):
    """Family of a Spark or SQL type name; only members of one family compare as equal."""
    name = name.lower()
    return next((k for k, names in KINDS.items() if name in names.split()), name)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def compare(con, df, sql):
    """None when both agree, else a short account of the first difference."""
    got_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = {d[0]: kind(str(d[1])) for d in cursor.description}
    wrong = [(c, t, kinds[c]) for c, t in df.dtypes if kind(t) != kinds[c]]
    if wrong:
        return f"column kinds differ: {wrong}"
    got, want = rows_of(df.columns, got_rows), rows_of(columns, want_rows)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; got {got[:2]} want {want[:2]}"
    if not got:
        return "both empty"
    types = dict(df.dtypes)
    arrays = [c for c in df.columns if types[c].startswith(("array", "struct", "map"))]
    if arrays:
        return f"nested columns {arrays}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(columns)}: {g} != {w}"
    return None

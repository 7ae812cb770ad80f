"""Hand-made bronze rows for semantic tests."""

from __future__ import annotations

import datetime as dt

import duckdb

from shopflow import schemas

T0 = dt.datetime(2024, 1, 10)


def at(hours: float = 0, minutes: float = 0, seconds: float = 0) -> dt.datetime:
    return T0 + dt.timedelta(hours=hours, minutes=minutes, seconds=seconds)


def clicks(spark, rows):
    """rows: (product_id, user_id, view_time, ts)"""
    full = [(p, u, v, f"/product/{p}", "10.0.0.1", t, t) for p, u, v, t in rows]
    return spark.createDataFrame(full, schemas.SHOE_CLICKSTREAM)


def orders(spark, rows):
    """rows: (order_id, product_id, customer_id, ts)"""
    return spark.createDataFrame([(o, p, c, t, t) for o, p, c, t in rows], schemas.SHOE_ORDERS)


def shoes(spark, rows):
    """rows: (id, brand)"""
    full = [(i, b, f"shoe {i}", 100, 4.0, T0) for i, b in rows]
    return spark.createDataFrame(full, schemas.SHOES)


def customers(spark, ids):
    full = [(i, "F", "L", f"{i}@x", None, None, "S", "00001", "C", "CC", T0) for i in ids]
    return spark.createDataFrame(full, schemas.CUSTOMERS)


def run_sql(sql: str, **frames):
    """Run DuckDB SQL over pandas frames given as keyword arguments."""
    con = duckdb.connect()
    for name, pdf in frames.items():
        con.register(name, pdf)
    return con.execute(sql).df()


def as_set(pdf, cols):
    out = set()
    for r in pdf[cols].itertuples(index=False):
        out.add(tuple(None if (isinstance(v, float) and v != v) or v is None else v for v in r))
    return out

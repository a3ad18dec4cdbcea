"""Comparing a query with its SQL."""

from __future__ import annotations

import math


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def same(df, con, sql: str) -> None:
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(value(r[names.index(c)]) for c in order) for r in got.fetchall()), key=repr)
    have = sorted((tuple(value(r[c]) for c in order) for r in df.collect()), key=repr)
    assert have == want

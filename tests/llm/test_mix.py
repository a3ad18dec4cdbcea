from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from derlem.llm import mix


def test_apportion_is_sainte_lague():
    assert mix.apportion({"a": 0.53, "b": 0.24, "c": 0.23}, 7, dict.fromkeys("abc", 99)) == {"a": 3, "b": 2, "c": 2}
    assert mix.apportion({"a": 0.5, "b": 0.5}, 3, {"a": 9, "b": 9}) == {"a": 2, "b": 1}  # ties go to the smaller key
    assert mix.apportion({"a": 0.9, "b": 0.1}, 10, {"a": 2, "b": 99}) == {"a": 2, "b": 8}
    assert mix.apportion({"a": 1.0}, 5, {"a": 3}) == {"a": 3}
    assert mix.apportion({}, 5, {}) == {}


def test_quotas_reach_the_shares():
    q = mix.quotas({"a": 1000, "b": 100, "d": 50}, {"a": (0.6, 1), "b": (0.3, 4), "c": (0.1, 9)})
    total = sum(q.values())
    assert set(q) == {"a", "b"} and q["b"] <= 400
    assert q["a"] / total == pytest.approx(2 / 3, abs=0.01) and q["b"] == pytest.approx(400, rel=0.02)
    assert mix.quotas({}, {"a": (1.0, 1)}) == {}
    q = mix.quotas({"a": 10, "b": 1000}, {"a": (0.5, 2), "b": (0.5, 1)}, total=1000)
    assert q["a"] == 20 and q["b"] == 980


@pytest.fixture
def tables(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2500, "big").when(F.col("id") < 2990, "mid").otherwise("small").alias("source"), (F.col("id") % 50 + 1).alias("tokens"), F.lit(1).alias("copies"))
    docs = docs.unionByName(spark.createDataFrame([(9001, None, 5, 1), (9002, "other", 5, 1), (9003, "big", 0, 1)], "doc_id long, source string, tokens long, copies int"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.4, 3), ("small", 0.05, 4), ("absent", 0.05, 2), (None, 0.1, 1)], "source string, target_share double, max_repeat int")
    return docs, targets


def test_shares_and_repeats(tables, monkeypatch):
    docs, targets = tables
    monkeypatch.setattr(mix, "SHARD_ROWS", 500)
    chosen, report = mix.mix(docs, targets)
    got = {r["source"]: r for r in report.collect()}
    assert set(got) == {"big", "mid", "small", "absent", None}
    for s, want in (("big", 0.5 / 0.95), ("mid", 0.4 / 0.95), ("small", 0.05 / 0.95)):
        assert got[s]["actual_share"] == pytest.approx(want, abs=0.01)
        assert got[s]["most_copies"] <= got[s]["max_repeat"]
    assert got["absent"]["tokens"] == 0
    assert chosen.filter("source = 'other' or source is null or tokens = 0").count() == 0
    assert chosen.groupBy("doc_id").count().filter("count > 1").count() == 0


def test_same_choice_whatever_the_layout(tables):
    docs, targets = tables
    pick = lambda d: sorted(map(tuple, mix.mix(d, targets)[0].collect()))
    assert pick(docs) == pick(docs.orderBy("tokens").repartition(9))


def test_empty(spark, tables):
    docs, targets = tables
    chosen, report = mix.mix(docs.limit(0), targets)
    assert chosen.count() == 0 and report.filter("tokens > 0").count() == 0

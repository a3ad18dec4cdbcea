"""Near-duplicates, overlaps, formatting duplicates and components against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from derlem.llm import canonical, components, neardup, overlap
from derlem.llm.words import counts, similarity
from tests.conftest import rows

random.seed(5)
VOCABULARY = [f"kelime{i}" for i in range(400)]


def corpus(n=220):
    texts = []
    for i in range(n):
        if texts and random.random() < 0.5:
            w = random.choice(texts).split()
            for _ in range(random.randint(0, 9)):
                k = random.randrange(len(w))
                w[k : k + random.randint(0, 1)] = [random.choice(VOCABULARY)] * random.randint(0, 2)
            random.shuffle(w) if random.random() < 0.3 else None
            texts.append(" ".join(w) or "boş")
        else:
            texts.append(" ".join(random.choices(VOCABULARY, k=random.randint(25, 60))))
    return texts


def brute(items, threshold=0.75):
    bags = [(i, counts(t)) for i, t in items if t]
    return {(a, b): similarity(x, y) for n, (a, x) in enumerate(bags) for b, y in bags[n + 1 :] if similarity(x, y) >= threshold}


@pytest.fixture(scope="module")
def texts():
    items = list(enumerate(corpus()))
    items += [(1000 + i, items[3][1].upper()) for i in range(40)]  # a group of copies
    items += [(2000, None), (2001, ""), (2002, " ... "), (2003, "uzun " * 20000), (2004, "Uzun, " * 20000)]
    return items


def test_pairs_equal_brute_force(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], "id long, text string, rep string")  # a clashing extra column
    links, members = neardup.near_duplicates(df)
    want = brute(texts)
    got = set(rows(neardup.all_pairs(links, members)))
    sure = {p for p, s in want.items() if s >= 0.8}
    assert got <= set(want)
    assert sure <= got and len(got) >= 0.99 * len(want)
    assert (2003, 2004) in got and not any({2000, 2001, 2002} & set(p) for p in got)


def test_groups_are_the_components(spark, texts):
    df = spark.createDataFrame(texts, "id long, text string")
    links, members = neardup.near_duplicates(df)
    got = {r["id"]: r["group"] for r in neardup.groups(links, members).collect()}
    parent = {i: i for i, t in texts if t and counts(t)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in neardup.all_pairs(links, members).collect():
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert got == {i: root(i) for i in parent}


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, text string")
    links, members = neardup.near_duplicates(df)
    assert neardup.all_pairs(links, members).count() == 0 and neardup.groups(links, members).count() == 0
    assert overlap.expand(*overlap.cross_split_overlaps(df, df)).count() == 0


def test_cross_split(spark, texts):
    train, held = texts[:180] + texts[220:], [(i + 5000, t) for i, t in texts[150:240]]
    a, b = (spark.createDataFrame(x, "id long, text string") for x in (train, held))
    got = set(rows(overlap.expand(*overlap.cross_split_overlaps(a, b)).select("a", "b")))
    want = {}
    for i, t in train:
        for j, u in held:
            if t and u and (s := similarity(counts(t), counts(u))) >= 0.75:
                want[i, j] = s
    assert got <= set(want) and {p for p, s in want.items() if s >= 0.8} <= got


def chain(n):
    return [(i, i + 1) for i in range(n)]


@pytest.mark.parametrize("links", [chain(40), [(0, i) for i in range(1, 30)], [(1, 2), (3, 4), (2, 1), (5, 5)], []])
def test_components(spark, links):
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for a, b in links if a != b for x in (a, b)}
    for _ in parent:
        for a, b in links:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


def record(user, assistant, swap=False):
    m = [{"role": "user", "content": user}] + ([{"role": "assistant", "content": assistant}] if assistant != "none" else [])
    return m[::-1] if swap else m


SCHEMA = "id long, messages array<struct<role:string,content:string>>, first string"
Q = "Ağrı nedir? Cümle iki.\nA) bir\nB) iki\nC) üç\nD) dört"


def test_formatting_duplicates(spark):
    data = [
        (1, record(Q, "Yanıt. A"), None),
        (2, record("AĞRI  NEDİR; cümle İKİ\nD) Dört\nB. iki\n(A) BIR\nC - üç", "yanıt a!", True), None),
        (3, record("Ağrı nedir? Cümle iki. A) bir B) iki C) üç D) dört", "Yanıt. A"), None),
        (4, record("Cümle iki. Ağrı nedir?\nA) bir\nB) iki\nC) üç\nD) dört", "Yanıt. A"), None),  # sentence order counts
        (5, record(Q.replace("A) bir\nB) iki", "A) iki\nB) bir"), "Yanıt. A"), None),  # letters stay with their texts
        (6, record(Q, None), None),
        (7, record(Q, "none"), None),
        (8, None, None),
        (9, record("g\u0306 ğ", "x"), None),
        (10, record("Ğ ğ", "x"), None),
        (11, record("x" * 200000, "y"), None),
        (12, record("X" * 200000, "y"), None),
    ]
    got = rows(canonical.formatting_duplicates(spark.createDataFrame(data, SCHEMA)))
    assert got == [(1, 1, 3), (10, 9, 2), (11, 11, 2), (12, 11, 2), (2, 1, 3), (3, 1, 3), (6, 6, 2), (7, 6, 2), (9, 9, 2)]


def test_formatting_hot_group(spark):
    df = spark.range(600).select("id", F.array(F.struct(F.lit("user").alias("role"), F.when(F.col("id") % 3 == 0, "Aynı soru?").otherwise(F.concat(F.lit("soru "), "id")).alias("content"))).alias("messages"))
    got = canonical.formatting_duplicates(df)
    assert got.count() == 200 and got.select("first", "copies").distinct().collect() == [(0, 200)]
    assert canonical.formatting_duplicates(df.limit(0)).count() == 0


def test_digest_follows_structure():
    a, b = canonical.canonical(record(Q, "x")), canonical.canonical(record(Q, "x", True))
    assert a == b and canonical.root_digest(a) == canonical.root_digest(b)
    assert canonical.root_digest(a) != canonical.root_digest(canonical.canonical(record(Q, "y")))

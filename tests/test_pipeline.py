from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from derlem.functions import text as X
from derlem.functions.dictionary import Dictionary
from derlem.operators import decisions, pipeline
from derlem.plans.registry import QUERIES
from derlem.sources.tables import first_content, table
from tests.conftest import rows

WORDS = {w: n for n, w in enumerate("karaciğer hastalığı için hangisi doğrudur görülen bulgular aşağıdakilerden açıklama metni burada bitmiştir kalp böbrek dalak akciğer mide değildir".split(), 50)}
D = Dictionary(WORDS)
ASKED = "12. Asagidakilerden hangisi dogrudur (TUS Nisan 2010)?\nA) kalp\nB) böbrek\nC) dalak\nD) mide"


def test_clean_question():
    q = pipeline.clean_question(D, ASKED)
    assert q["govde"] == "Aşağıdakilerden hangisi doğrudur?" and q["sinav"] == ["(TUS Nisan 2010)"]
    assert [o["harf"] for o in q["siklar"]] == list("ABCD") and q["esleme"] == {k: k for k in "ABCD"} and q["sorun"] == ["eksik:E"]
    q = pipeline.clean_question(D, "Hangisi? A) kalp C) dalak D) mide E) böbrek")
    assert q["esleme"] == {"A": "A", "C": "B", "D": "C", "E": "D"} and q["onarim"] == ["yeniden_harflendi:ACDE"]


def test_clean_explanation():
    t, cut, dropped = pipeline.clean_explanation(D, "aciklama metni burada bitmistir.\nANATOMİ 449\nqwe rty asd fgh zxc.", False)
    assert t == "açıklama metni burada bitmiştir." and cut == "" and dropped == 1
    assert pipeline.clean_explanation(D, "DEGILDIR qwe rty asd fgh zxc.", True) == ("Değildir qwe rty asd fgh zxc.", "", 0)
    _, cut, _ = pipeline.clean_explanation(D, "açıklama metni.\n13. aşağıdakilerden hangisi doğrudur?\nA) kalp\nB) mide\nC) dalak", False)
    assert "hangisi" in cut


def test_cleaned_and_flagged(spark):
    told = "açıklama metni burada bitmiştir, karaciğer için görülen bulgular böbrek ve kalp."
    data = [(1, "a", ASKED, told, "B", False), (2, "b", "Hangisi?\nA) kalp\nB) böbrek", told, "E", False), (3, "c", None, told, "A", False), (4, "d", "Hangisi? A) kalp C) dalak D) mide E) böbrek", told, "C", False)]
    df = spark.createDataFrame(data, "kayit_no long, id string, soru string, aciklama string, cevap string, elle boolean")
    got = {r["id"]: r for r in pipeline.flagged_clean(pipeline.cleaned_records(df, WORDS), spark.createDataFrame([("a",)], "id string")).collect()}
    assert set(got) == {"a", "b", "d"}
    assert got["a"]["bayrak"] == ["soruda_gorsel"] and got["a"]["cevap"] == "B"
    assert {"cevap_sikki_kayip", "sik_sayisi_az"} <= set(got["b"]["bayrak"])
    assert "sik_kayip_yeniden_harf" in got["d"]["bayrak"] and got["d"]["cevap"] == "B"
    assert pipeline.cleaned_records(df.limit(0), WORDS).count() == 0


def test_built_records(spark):
    told = "Karaciğer hastalığı için görülen bulgular burada uzun uzun anlatılmıştır."
    asked = "12. Aşağıdakilerden hangisi karaciğer hastalığı için doğrudur?"
    q = [("d", "12", asked, "A) x\nB) y\nC) z", t, c, [], b, b + 3, 1, 1) for t, c, b in ((told, None, 0), (told, "A", 5), (told + " Ek.", "B", 9))] + [("e", "1", "kısa", "A) x", "", None, ["A", "B"], 0, 1, 1, 2)]
    df = spark.createDataFrame(q, pipeline.extract.QUESTION)
    got = {r["doc"]: r for r in pipeline.built_records(df, WORDS).collect()}
    assert got["d"]["sorunlar"] == [] and got["d"]["cevap"] == "B" and len(got["d"]["id"]) == 16
    assert got["e"]["sorunlar"] == ["cevap_yok", "coklu_anahtar(AB)", "sik_eksik", "soru_kisa", "aciklama_kisa"]
    built = pipeline.built_records(df, WORDS)
    assert rows(pipeline.document_summary(built)) == [("d", 1, 0, "diger"), ("e", 0, 1, "diger")]
    two = built.filter("doc = 'd'").unionByName(built.filter("doc = 'd'").withColumn("doc", F.lit("f")).withColumn("id", F.lit("zz")))
    best, clash = pipeline.settled(two)
    assert best.first()["copies"] == 2 and best.first()["sources"] == ["d", "f"] and clash.count() == 0
    best, clash = pipeline.settled(two.withColumn("cevap", F.when(F.col("doc") == "f", "C").otherwise(F.col("cevap"))))
    assert best.count() == 0 and {r["letters"] for r in clash.collect()} == {"BC"}


def test_repeats_and_review(spark):
    df = spark.createDataFrame([(1, "a", "Soru  x", "kısa", ["f"], "otomatik"), (2, "b", "soru x", "daha uzun", [], "otomatik"), (3, "c", "SORU X", "k", [], "incelendi"), (4, "d", "başka", "p1\n\np2" + "y" * 400, [], "otomatik")], "kayit_no long, id string, soru string, aciklama string, bayrak array<string>, durum string")
    kept, repeats = pipeline.unrepeated(df, F.col("durum") == "incelendi")
    assert sorted(r["kayit_no"] for r in kept.collect()) == [3, 4] and {r["elenme"] for r in repeats.collect()} == {"tekrar"}
    df = df.withColumn("siklar", F.expr("array_repeat(named_struct('harf', 'A', 'metin', 'x'), if(id = 'c', 4, 5))"))
    page = pipeline.review_view(df, df.filter("kayit_no < 3"), 1).collect()
    assert [(r["id"], r["bayrak"]) for r in page] == [("c", ["sik_sayisi=4"])]
    shown = pipeline.review_view(df, df.limit(0), 9).filter("id = 'd'").first()
    assert shown["gosterim"] == "[0] p1\n[1] p2" + "y" * 298 + " ..." and shown["bayrak"] == []
    long = df.filter("id = 'd'").withColumn("aciklama", F.expr("repeat(concat(repeat('y', 400), '\n'), 9)"))
    assert len(pipeline.review_view(long, df.limit(0), 9).first()["gosterim"].split("\n")) == 3
    assert len(pipeline.review_view(long.withColumn("bayrak", F.array(F.lit("f"))), df.limit(0), 9).first()["gosterim"].split("\n")) == 7


def test_broken_frames_are_kept_and_rejected(spark):
    data = [(1, "a", ASKED, None, None, False), (2, "b", "Hangisi?", None, None, False)]
    df = spark.createDataFrame(data, "kayit_no long, id string, soru string, aciklama string, cevap string, elle boolean")
    flagged = pipeline.flagged_clean(pipeline.cleaned_records(df, WORDS))
    log = spark.createDataFrame([(1, "b", "at", "diger", "2024"), (2, "a", "duzelt", None, "2024")], "kayit_no long, id string, karar string, neden string, zaman string")
    got = {r["id"]: r for r in decisions.route(flagged, log).collect()}
    assert got["a"]["bayrak"][0] == "cerceve_bozuk" and got["a"]["soru"].startswith("Aşağıdakilerden") and got["a"]["aciklama"] is None and got["a"]["cevap"] is None
    assert [(got[i]["yol"], got[i]["elenme"], got[i]["durum"]) for i in "ab"] == [("elenen", "cerceve_bozuk", "otomatik"), ("elenen", "diger", "incelendi")]


def test_fixes_reach_the_produced_records(spark, data):
    """Every latest fix of a training record changes what is produced, unless its options came without an answer or the frame is broken."""
    log, rec = decisions.latest(table(spark, data, "decision")), table(spark, data, "sft_record")
    fixes = log.filter("karar = 'duzelt' and (cevap is not null or siklar is null)").join(rec.select("kayit_no", "id").withColumnRenamed("kayit_no", "no"), "id")
    got = {r["kayit_no"]: r for r in QUERIES["produced_records"](spark, data).collect()}
    seen = 0
    for f in fixes.collect():
        r = got[f["no"]]
        if r["elenme"] == "cerceve_bozuk":
            continue
        seen += 1
        assert r["durum"] == "incelendi"
        if f["cevap"]:
            assert r["cevap"] == f["cevap"]
        if f["aciklama"]:
            assert r["aciklama_ozeti"] == hashlib.md5(f["aciklama"].encode()).hexdigest()
    assert seen


def test_every_record_is_listed(spark, data):
    rec, done = table(spark, data, "sft_record").select("kayit_no", "id"), table(spark, data, "decision").select("id").distinct()
    undecided = {r[0] for r in rec.join(done, "id", "left_anti").select("kayit_no").collect()}
    listed = QUERIES["priority_list"](spark, data).collect()
    assert sorted(r["kayit_no"] for r in listed) == sorted(undecided) and {r["sinif"] for r in listed} <= {1, 2, 3, 4}
    broken = {r[0] for r in table(spark, data, "sft_record").filter(X.answer_letter(first_content("assistant")).isNull()).select("kayit_no").collect()}
    assert broken and {r["sinif"] for r in listed if r["kayit_no"] in broken} == {3}
    for name in ("routed_records", "produced_records"):
        got = QUERIES[name](spark, data).collect()
        assert len(got) == rec.count() and {r["yol"] for r in got if r["kayit_no"] in broken} == {"elenen"}

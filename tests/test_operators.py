"""Decisions, dedup, sampling, quality and validation on small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from derlem.operators import decisions, dedup, quality, sampling, validate
from tests.conftest import rows

LOG = "kayit_no long, id string, karar string, neden string, not_ string, govde string, siklar map<string,string>, cevap string, aciklama string, aciklama_kes string, aciklama_paragraf string, soru string, zaman string"


def log(spark, *entries):
    names = [c.split()[0] for c in LOG.split(", ")]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], LOG)


def test_latest_decision_ties_and_missing_time(spark):
    d = log(
        spark,
        {"kayit_no": 1, "id": "a", "karar": "ok", "zaman": "2024-01-02"},
        {"kayit_no": 2, "id": "a", "karar": "at", "zaman": "2024-01-02"},
        {"kayit_no": 3, "id": "a", "karar": "duzelt", "zaman": None},
        {"kayit_no": 4, "id": "b", "karar": "ok", "zaman": None},
        {"kayit_no": 5, "id": "b", "karar": "at", "zaman": None},
    )
    assert rows(decisions.latest(d).select("id", "kayit_no")) == [("a", 2), ("b", 5)]
    assert decisions.latest(d.limit(0)).count() == 0


def test_route(spark):
    rec = spark.createDataFrame(
        [("a", ["sik_sayisi_az"]), ("b", ["sik_sayisi_az"]), ("c", ["aciklama_kisa"]), ("d", []), ("e", ["aciklama_kisa"]), ("f", []), ("g", ["x", "cevap_sikki_kayip"])], "id string, bayrak array<string>"
    )
    d = log(spark, {"kayit_no": 1, "id": "b", "karar": "ok"}, {"kayit_no": 2, "id": "a", "karar": "duzelt"}, {"kayit_no": 3, "id": "e", "karar": "ok"}, {"kayit_no": 4, "id": "f", "karar": "at"})
    got = {r["id"]: (r["yol"], r["elenme"], r["durum"]) for r in decisions.route(rec, d).collect()}
    assert got == {
        "a": ("egitim", None, "incelendi"),
        "b": ("elenen", "sik_sayisi_az", "otomatik"),  # ok does not outweigh the flag
        "c": ("kuyruk", None, "otomatik"),
        "d": ("egitim", None, "otomatik"),
        "e": ("egitim", None, "incelendi"),
        "f": ("elenen", "elle_elendi", "incelendi"),
        "g": ("elenen", "cevap_sikki_kayip", "otomatik"),
    }
    assert rows(decisions.queue(decisions.route(rec, d))) == [("aciklama_kisa", "c")]


@pytest.mark.parametrize(
    ("patch", "want"),
    [
        ({"siklar": {"B": "y", "A": "x"}, "cevap": "B"}, ("Kök?\nA) x\nB) y", "p1\np2\np3", "B", None)),
        ({"siklar": {"A": "x"}}, ("Soru", "p1\np2\np3", "A", "sik_cevapsiz")),
        ({"govde": "Yeni"}, ("Yeni\nA) eski", "p1\np2\np3", "A", None)),
        ({"soru": "S2", "govde": "Yeni"}, ("S2", "p1\np2\np3", "A", None)),
        ({"aciklama_paragraf": "1"}, ("Soru", "p1", "A", None)),
        ({"aciklama_paragraf": "1-", "aciklama_kes": "p3"}, ("Soru", "p2", "A", None)),
        ({"aciklama_kes": "yok"}, ("Soru", "p1\np2\np3", "A", "kes_bulunamadi")),
        ({"aciklama": "yeni", "cevap": "C"}, ("Soru", "yeni", "C", None)),
    ],
)
def test_patch(spark, patch, want):
    rec = spark.createDataFrame([("a", "Kök?", [("A", "eski")], "Soru", "p1\np2\np3", "A")], "id string, govde string, siklar array<struct<harf:string,metin:string>>, soru string, aciklama string, cevap string")
    out = decisions.patched(rec, log(spark, {"kayit_no": 1, "id": "a", "karar": "duzelt"} | patch)).first()
    assert (out["soru"], out["aciklama"], out["cevap"], out["hata"]) == want


def test_fixes_that_fail_wait_in_the_queue(spark):
    rec = spark.createDataFrame([(1, "a", "Kök?", [("A", "eski")], "Soru", "p1", "A", [], None), (2, "b", "Kök?", [("A", "eski")], "Soru", "p1", "A", ["aciklama_kisa"], None)], "kayit_no long, id string, govde string, siklar array<struct<harf:string,metin:string>>, soru string, aciklama string, cevap string, bayrak array<string>, x string")
    fix = log(spark, {"kayit_no": 1, "id": "a", "karar": "duzelt", "aciklama_kes": "yok"})
    routed = decisions.route(decisions.patched(rec, fix), fix)
    assert rows(decisions.queue(routed)) == [("aciklama_kisa", "b"), ("kes_bulunamadi", "a")]
    assert rows(routed.select("kayit_no", "yol", "x")) == [(1, "egitim", None), (2, "kuyruk", None)]
    assert rows(decisions.bulk_ok(rec.unionByName(rec), "2024")) == [("a", "ok", "2024"), ("b", "ok", "2024")]


def test_contradicting_keys_are_out_as_a_whole(spark):
    rec = spark.createDataFrame([(1, "k", "A", "kısa", "s"), (2, "k", "B", "uzun metin", "t"), (3, "m", "C", "x", "s"), (4, "m", "C", "xx", "t"), (5, "m", None, "x", None)], "no int, k string, harf string, t string, src string")
    assert [tuple(r) for r in dedup.settled(rec, "k", "harf", "t", "no", "src").collect()] == [("m", 4, 3, ["s", "t"])]


def test_preferred_copies(spark):
    files = spark.createDataFrame([("/r/X/a.pdf", "X/a.pdf", "1"), ("/r/T/a (1).pdf", "T/a (1).pdf", "1"), ("/r/T/b.pdf", "T/b.pdf", "1"), ("/r/X/c.pdf", "X/c.pdf", "2")], "path string, rel string, md5 string")
    assert rows(dedup.preferred_copies(files, "T")) == [("/r/T/a (1).pdf", "/r/T/b.pdf"), ("/r/X/a.pdf", "/r/T/b.pdf")]


def test_repairs_and_final_set(spark):
    flagged = spark.createDataFrame([(1, "a", "Eski soru", "B"), (2, "a", "Başka", "C"), (3, "b", "Soru b", None)], "kayit_no long, id string, soru string, cevap string")
    req = spark.createDataFrame([(10, "a", "B", "g", None), (11, "a", "C", "g", "Yeni"), (12, "b", "A", "g", ""), (13, "z", "A", "g", None)], "kayit_no long, id string, cevap string, gerekce string, soru string")
    got = {r["kayit_no"]: (r["soru"], r["tur"], r["soru_degistirildi"]) for r in decisions.merge_repairs(req, flagged).collect()}
    assert got == {
        10: ("Eski soru", "aciklama_yazildi", False),
        11: ("Yeni", "aciklama_yazildi+ocr_duzeltildi+anahtar_duzeltildi", True),
        12: ("Soru b", "aciklama_yazildi+anahtar_duzeltildi", False),
    }
    assert rows(decisions.unanswered_requests(req, flagged).select("kayit_no")) == [(13,)]
    k = "anahtar_id string, kayit_no long"
    final = decisions.final_training(spark.createDataFrame([("x", 1), ("y", 2)], k), spark.createDataFrame([("x", 8), ("z", 9), ("z", 7)], k), spark.createDataFrame([("y", 0)], k))
    assert rows(final) == [("x", 1, "otomatik"), ("z", 7, "onarilmis")]


def test_keep_longest_contradictions_and_leakage(spark):
    r = spark.createDataFrame([(1, "k", "aa", "s1", "A"), (2, "k", "bb", "s2", "B"), (3, "k", "b", None, "B"), (4, "m", "c", "s1", "A"), (5, "m", "c", "s1", None)], "n long, k string, t string, s string, a string")
    assert rows(dedup.keep_longest(r, "k", "t", "n", "s")) == [("k", 1, 3, ["s1", "s2"]), ("m", 4, 2, ["s1"])]
    assert rows(dedup.contradictions(r, "k", "a").select("n", "letters")) == [(1, "AB"), (2, "AB"), (3, "AB")]
    sets = {"a": r.filter("n < 3"), "b": r.filter("n > 2"), "c": r.limit(0)}
    assert rows(dedup.leakage(sets, "k")) == [("a", "b", 1), ("a", "c", 0), ("b", "c", 0)]
    assert rows(dedup.without(r, r.filter("k = 'm'"), on="k").select("n")) == [(1,), (2,), (3,)]
    assert [x["sebep"] for x in dedup.with_reasons(r, "k", {"p": r.filter("n = 4"), "q": r}).orderBy("n").collect()] == ["q", "q", "q", "p", "p"]


@pytest.mark.parametrize(("share", "want"), [(0.5, 5), (0.1, 1), (0.05, 10), (1.0, 10), (0.25, 2)])
def test_nearest_rank_wraps_to_the_largest(spark, share, want):
    df = spark.range(1, 11).select(F.col("id").alias("v"))
    assert sampling.nearest_rank(df, "v", [share]).first()["deger"] == want


def test_upper_median_and_shares(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, "a"), (None, None)], "v int, k string")
    assert sampling.upper_median(df, "v").first()[0] == 3
    assert {r["k"]: r["yuzde"] for r in sampling.share_of_total(df, "k").collect()} == {"a": 60.0, "b": 20.0, None: 20.0}


def test_holdout_quota_and_hot_group(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), F.md5(F.col("id").cast("string")).alias("k"))
    got = sampling.stratified_holdout(df, "g", "k", 50, salts=4).groupBy("g").count()
    assert {r["g"]: r["count"] for r in got.collect()} == {"hot": 45} | {f"g{i}": 1 for i in range(5)}
    smallest = sorted(r["k"] for r in df.filter("g = 'hot'").collect())[:45]
    assert sorted(r["k"] for r in sampling.stratified_holdout(df, "g", "k", 50).filter("g = 'hot'").collect()) == smallest


def test_round_robin(spark):
    got = sampling.round_robin(spark.range(100).repartition(5), [F.asc("id")], 8).orderBy("id").collect()
    assert [r["pay"] for r in got] == [i % 8 + 1 for i in range(100)]


def test_flag_rank(spark):
    df = spark.createDataFrame([(["aciklama_uzun", "sik_onarimi"],), ([],), (["bilinmeyen"],), (["aciklama_harf_celiskisi"],)], "f array<string>")
    assert [r[0] for r in df.select(sampling.flag_rank(F.col("f"))).collect()] == [2, 99, 99, 0]


def stage_one(spark, **x):
    base = {"soru": "Aşağıdakilerden hangisi karaciğer hastalığı için doğrudur, işaretleyiniz?", "siklar": "A) x B) y C) z", "aciklama": "Karaciğer hastalığında görülen bulgular burada uzun uzun anlatılmıştır.", "cevap": "A", "aday": []} | x
    df = spark.createDataFrame([tuple(base[k] for k in ("soru", "siklar", "aciklama", "cevap", "aday"))], "soru string, siklar string, aciklama string, cevap string, aday array<string>")
    return df.select(quality.stage_one(F.col("soru"), F.col("siklar"), F.col("aciklama"), F.col("cevap"), F.col("aday"))).first()[0]


@pytest.mark.parametrize(
    ("x", "want"),
    [
        ({}, []),
        ({"cevap": None}, ["cevap_yok"]),
        ({"cevap": ""}, ["cevap_yok"]),
        ({"aday": ["B", "A", "A"]}, ["coklu_anahtar(AB)"]),
        ({"soru": "Aşağıdaki şekilde gösterilen yapı için hangisi doğrudur?"}, ["sekle_bagli"]),
        ({"soru": "Yukarıdaki 12 numaralı olguda hangisi doğrudur acaba?"}, ["onceki_soruya_bagimli"]),
        ({"siklar": "A) x B) y"}, ["sik_eksik"]),
        ({"soru": "Kısa soru hangisidir?"}, ["soru_kisa"]),
        ({"soru": "a" * 40}, []),
        ({"soru": "a" * 39}, ["soru_kisa"]),
        ({"aciklama": None}, ["aciklama_kisa"]),
        ({"aciklama": "Kolay bir soru. Spot bilgi niteliğinde klasik bir sınav."}, ["iceriksiz_gerekce"]),
        ({"aciklama": "Karaciğer hastalığının en sık görülen nedenleri şunlardır:"}, ["yarim_gerekce"]),
        ({"aciklama": "Karaciğer | a | b | c\nKaraciğer | d | e | f hastalığı bulguları"}, ["tablo_kalintisi"]),
    ],
)
def test_stage_one(spark, x, want):
    assert stage_one(spark, **x) == want


def test_contamination(spark):
    df = spark.createDataFrame([("Karaciğer nedir?\nA) x", "12. Yeni soru\nA) a B) b C) c D) d\nDoğru cevap: B\nSORU 5 kitapçığı")], "q string, e string")
    assert df.select(quality.contamination_flags(F.col("q"), F.col("e"))).first()[0] == ["yeni_soru_basligi", "sik_blogu", "cevap_satiri", "soru_etiketi", "kitapcik_metni", "dusuk_ortusme"]


def test_decision_errors(spark):
    d = log(
        spark,
        {"kayit_no": 1, "karar": "belki"},
        {"kayit_no": 2, "karar": "at", "neden": "x"},
        {"kayit_no": 3, "karar": "duzelt", "siklar": {"A": "x"}},
        {"kayit_no": 4, "karar": "duzelt", "siklar": {"A": "x"}, "cevap": "B", "aciklama_paragraf": "a-b"},
        {"kayit_no": 5, "karar": "ok", "cevap": "AB"},
        {"kayit_no": 6, "karar": "at", "neden": "diger"},
    )
    cut = log(spark, {"kayit_no": 7, "karar": "duzelt", "aciklama_kes": "yok"}, {"kayit_no": 8, "karar": "duzelt", "aciklama_kes": "var"})
    assert [r[0] for r in cut.orderBy("kayit_no").select(quality.decision_errors(F.lit("burada var"))).collect()] == [["aciklama_kes"], []]
    assert [r[0] for r in cut.select(quality.decision_errors()).collect()] == [[], []]  # the record is not known
    got = {r["kayit_no"]: r["e"] for r in d.select("kayit_no", quality.decision_errors().alias("e")).collect()}
    assert got == {1: ["karar"], 2: ["neden"], 3: ["siklar_cevapsiz"], 4: ["cevap_siklarda_yok", "aciklama_paragraf"], 5: ["cevap"], 6: []}


def test_subject_and_pool(spark):
    df = spark.createDataFrame([("Tıbbi MİKROBİYOLOJİ",), ("kadın doğum",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(quality.subject_of(F.col("t"))).collect()] == ["Mikrobiyoloji", "Kadın Doğum", None, None]
    df = spark.createDataFrame([("1. Hangisi? A) x B) y C) z D) t", "Açıklama."), ("Hangisi? A) x B) y C) z D) t", ""), ("1. Hangisi? A) x B) y C) z D) t", "1-A, 2-B, 3-C")], "q string, e string")
    assert [r[0] for r in df.select(quality.repairable(F.col("q"), F.col("e"))).collect()] == [True, False, False]


def test_validator(spark):
    good = "Uzun bir soru kökü?\nA) x\nB) y\nC) z\nD) t"
    told = "Açıklama metni en az kırk karakter uzunluğunda olmalıdır, bu öyle."
    frame = lambda t, k="A": f"<think>\n{t}\n</think>\n\nDoğru cevap: {k}"
    both = ["user", "assistant"]
    rec = spark.createDataFrame(
        [("1", good, frame(told), both), ("1", good, frame(told, "E"), both), ("2", good, "bozuk", both), ("3", None, None, ["user"]), ("4", "A) x\nB) x\nC) z", frame("kısa &amp; $x$ Doğru cevap: A"), both),
         *[("u" + str(i), good + str(i), frame(told), both) for i in range(4)], ("5", "Bambaşka garip sözler?\nA) x\nB)   \nC) z\nD) t", frame("Zxcv qwer tyui asdf ghjk açıklama metni en az kırk karakter uzunluğunda."), both)],
        "id string, user string, assistant string, roles array<string>",
    ).withColumn("row", F.monotonically_increasing_id())
    held = spark.createDataFrame([(good.upper().replace("İ", "I"),), (good,)], "soru string")
    got = {(r["tur"], r["kod"]): r["n"] for r in validate.report(rec, held).collect()}
    assert got == {
        ("hata", "rol"): 1, ("hata", "cevap_bicimi"): 1, ("hata", "sik_harfleri"): 1, ("hata", "cevap_siklarda_yok"): 1, ("hata", "govde_yok"): 1, ("hata", "latex"): 1, ("hata", "html"): 1, ("hata", "aciklama_cok_kisa"): 1,
        ("uyari", "ayni_sik_metni"): 1, ("uyari", "aciklamada_dogru_cevap"): 1, ("hata", "tekrar_id"): 1, ("uyari", "tekrar_soru"): 1, ("hata", "eval_sizintisi"): 2,
        ("hata", "bos_sik"): 1, ("uyari", "aciklama_bozuk>0.2"): 2, ("uyari", "govde_bozuk>0.15"): 1,
    }

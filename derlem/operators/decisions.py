"""Review decisions: latest per record, patching, routing, repairs and the final training set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derlem.functions import text as X
from derlem.operators.quality import codes

UNREADABLE = "cerceve_bozuk"  # no explanation or answer letter could be read
REJECTING = (UNREADABLE, "cevap_sikki_kayip", "onceki_soruya_bagli", "sik_sayisi_az")


def latest(log: DataFrame, key: str = "id", time: str = "zaman", order: str = "kayit_no") -> DataFrame:
    """The last decision per key: latest time (missing counts as earliest), later order on ties.

    One aggregation with map-side combine, so a record with very many decisions needs no sort.
    """
    rest = [c for c in log.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(F.coalesce(F.col(time), F.lit("")), F.col(order)))
    return log.groupBy(key).agg(best.alias("_d")).select(key, *[F.col(f"_d.{c}").alias(c) for c in rest])


def effective(decision: Column, flags: Column) -> Column:
    """'ok' does not outweigh a rejecting flag; nothing but 'at' holds for a record that could not be read."""
    rejected = F.arrays_overlap(flags, F.array(*[F.lit(f) for f in REJECTING]))
    return F.when((decision == "ok") & rejected | (decision != "at") & F.array_contains(flags, UNREADABLE), None).otherwise(decision)


def route(records: DataFrame, log: DataFrame) -> DataFrame:
    """records(id, bayrak, ...) with `yol`: egitim, elenen or kuyruk, and `elenme`, the reason of rejection."""
    d = latest(log).select("id", F.col("karar").alias("_karar"), F.col("neden").alias("_neden"))
    out = records.join(d, "id", "left")
    karar = effective(F.col("_karar"), F.col("bayrak"))
    auto = F.get(F.filter("bayrak", lambda f: f.isin(*REJECTING)), F.lit(0))
    path = F.when(karar == "at", "elenen").when(karar.isNotNull(), "egitim").when(auto.isNotNull(), "elenen").when(F.size("bayrak") > 0, "kuyruk").otherwise("egitim")
    reason = F.when(karar == "at", F.coalesce("_neden", F.lit("elle_elendi"))).when(karar.isNull(), auto)
    return out.withColumn("yol", path).withColumn("elenme", reason).withColumn("durum", F.when(karar.isNull(), "otomatik").otherwise("incelendi")).drop("_karar", "_neden")


def queue(routed: DataFrame) -> DataFrame:
    """(bayrak, id): records of the review queue by flag, in long form; a flag may hold any share of them."""
    flags = routed.filter("yol = 'kuyruk'").select(F.explode("bayrak").alias("bayrak"), "id")
    if "hata" not in routed.columns:
        return flags
    return flags.unionByName(routed.filter("hata is not null").select(F.col("hata").alias("bayrak"), "id"))  # fixes that could not be made in full


def bulk_ok(ids: DataFrame, time: str) -> DataFrame:
    """Decision rows that accept every id of ids(id) at one time, once each."""
    return ids.select("id").distinct().select("id", F.lit("ok").alias("karar"), F.lit(time).alias("zaman"))


def options_from_map(options: Column) -> Column:
    entries = F.array_sort(F.map_entries(options))
    return F.transform(entries, lambda e: F.struct(e["key"].alias("harf"), e["value"].alias("metin")))


def patched(records: DataFrame, log: DataFrame) -> DataFrame:
    """records(id, govde, siklar array<struct<harf,metin>>, soru, aciklama, cevap, ...) with the patch of each latest 'duzelt' decision.

    Order: siklar (with govde), else govde; then soru; then aciklama_paragraf, aciklama_kes, aciklama; cevap.
    `hata`: sik_cevapsiz (options without an answer, nothing patched) or kes_bulunamadi (mark not found, text kept).
    """
    d = latest(log).filter("karar = 'duzelt'")
    fields = ["govde", "siklar", "soru", "aciklama", "aciklama_paragraf", "aciklama_kes", "cevap"]
    out = records.join(d.select("id", F.lit(True).alias("_on"), *[F.col(f).alias(f"_{f}") for f in fields]), "id", "left")
    bad = F.col("_siklar").isNotNull() & F.col("_cevap").isNull()
    on = F.coalesce(F.col("_on"), F.lit(False)) & ~bad
    stem = F.coalesce("_govde", "govde")
    asked = F.when(F.col("_siklar").isNotNull(), X.render_question(stem, options_from_map(F.col("_siklar")))).when(F.col("_govde").isNotNull(), X.render_question(stem, F.col("siklar"))).otherwise(F.col("soru"))
    told = X.paragraph_slice("aciklama", "_aciklama_paragraf")
    cut = X.cut_from(told, F.col("_aciklama_kes"))
    missing = on & F.col("_aciklama_kes").isNotNull() & cut.isNull()
    error = F.get(codes(("sik_cevapsiz", bad), ("kes_bulunamadi", missing)), F.lit(0))
    return out.select(
        *[c for c in records.columns if c not in ("soru", "aciklama", "cevap")],
        F.when(on, F.coalesce(F.col("_soru"), asked)).otherwise(F.col("soru")).alias("soru"),
        F.when(on, F.coalesce(F.col("_aciklama"), cut, told)).otherwise(F.col("aciklama")).alias("aciklama"),
        F.when(on, F.coalesce("_cevap", "cevap")).otherwise(F.col("cevap")).alias("cevap"),
        error.alias("hata"),
    )


def merge_repairs(requests: DataFrame, flagged: DataFrame) -> DataFrame:
    """requests joined to the flagged record they repair -> (kayit_no, id, soru, icerik, anahtar_id, tur, soru_degistirildi)."""
    f = flagged.groupBy("id").agg(F.min_by(F.struct("soru", "cevap"), "kayit_no").alias("f")).select("id", F.col("f.soru").alias("_soru"), F.col("f.cevap").alias("_cevap"))
    kind = F.concat(
        F.lit("aciklama_yazildi"),
        F.when(F.coalesce("soru", F.lit("")) != "", "+ocr_duzeltildi").otherwise(""),
        F.when(F.col("cevap").eqNullSafe(F.col("_cevap")), "").otherwise("+anahtar_duzeltildi"),
    )
    return requests.join(f, "id").select(
        "kayit_no",
        "id",
        F.coalesce(F.when(F.col("soru") != "", F.col("soru")), "_soru").alias("soru"),
        X.framed("gerekce", "cevap").alias("icerik"),
        X.short_hash(X.question_key("_soru")).alias("anahtar_id"),
        kind.alias("tur"),
        (F.coalesce("soru", F.lit("")) != "").alias("soru_degistirildi"),
    )


def unanswered_requests(requests: DataFrame, flagged: DataFrame) -> DataFrame:
    """Requests whose record is not among the flagged ones; should be none."""
    return requests.join(flagged.select("id").distinct(), "id", "left_anti")


def final_training(kept: DataFrame, repaired: DataFrame, excluded: DataFrame) -> DataFrame:
    """kept(anahtar_id, kayit_no) without the excluded keys, and repaired records whose key is not among kept, one per key."""
    auto = kept.join(excluded.select("anahtar_id").distinct(), "anahtar_id", "left_anti").select("anahtar_id", "kayit_no", F.lit("otomatik").alias("kaynak"))
    by_hand = repaired.join(kept.select("anahtar_id").distinct(), "anahtar_id", "left_anti").groupBy("anahtar_id").agg(F.min("kayit_no").alias("kayit_no")).withColumn("kaynak", F.lit("onarilmis"))
    return auto.unionByName(by_hand)

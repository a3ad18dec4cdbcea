"""The core engine's queries over the project's tables, each with its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derlem.functions import dictionary, latex
from derlem.functions import text as X
from derlem.operators import decisions, dedup, extract, pipeline, quality, sampling, validate
from derlem.session import materialize
from derlem.sources.tables import first_content, spread, table

# fixed values: reasons for which a dropped record is disputed rather than unusable
DISPUTED = ("cevap_supheli", "tibbi")
Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------------------------- shared inputs


def sft(spark: SparkSession, d: str) -> DataFrame:
    """kayit_no, id, user, assistant, source_pdf, grup of sft_record."""
    rec = table(spark, d, "sft_record").select(
        "kayit_no", "id", first_content("user").alias("soru"), first_content("assistant").alias("icerik"), F.col("meta.source_pdf").alias("source_pdf"), F.col("meta.grup").alias("grup")
    )
    return spread(rec)


def documents(spark: SparkSession, d: str) -> DataFrame:
    """The documents that have a text."""
    return spread(table(spark, d, "documents").filter("text is not null"))


def keyed(spark: SparkSession, d: str) -> DataFrame:
    return sft(spark, d).filter("soru is not null").withColumn("anahtar_id", X.short_hash(X.question_key("soru")))


def keys(spark: SparkSession, d: str) -> DataFrame:
    """kayit_no, id, grup, anahtar_id of the training records, computed once for queries that use them again and again."""
    return materialize(keyed(spark, d).select("kayit_no", "id", "grup", "anahtar_id"), "keys")


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "flagged_record").withColumn("anahtar_id", X.short_hash(X.question_key("soru")))


def held_out(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "eval_record").withColumn("anahtar_id", X.short_hash(X.question_key("soru")))


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every training record in its cleaned form with its flags (see pipeline.flagged_clean); null fields and cerceve_bozuk where the frame is broken."""
    rec = sft(spark, d).select("kayit_no", "id", "soru", X.explanation("icerik").alias("aciklama"), X.answer_letter("icerik").alias("cevap"), F.lit(False).alias("elle"))
    texts = rec.select(F.concat_ws("\n", "soru", "aciklama").alias("text"))
    words = dictionary.Vocabulary(dictionary.word_counts(texts, turkish=True))
    clean = pipeline.flagged_clean(pipeline.cleaned_records(rec.fillna("", "soru"), words))  # one without a question is kept, and flagged for its options
    return clean.withColumn("soru", F.expr("nullif(soru, '')"))


def produced(spark: SparkSession, d: str) -> DataFrame:
    """cleaned, patched by the latest fixes, routed by the latest decisions, repeats taken out: `yol`, `elenme`, `durum`, `hata`."""
    log = table(spark, d, "decision")
    routed = materialize(decisions.route(decisions.patched(cleaned(spark, d), log), log), "routed")
    kept, repeats = pipeline.unrepeated(routed.filter("yol <> 'elenen'"), F.col("durum") == "incelendi")
    return kept.unionByName(repeats.withColumn("yol", F.lit("elenen"))).unionByName(routed.filter("yol = 'elenen'"))


# ---------------------------------------------------------------------------------------------- queries


def gated(spark: SparkSession, d: str) -> DataFrame:
    """Training records that pass every gate of the first stage: kayit_no, anahtar_id, icerik, source_pdf, harf."""
    adaylar = table(spark, d, "sft_record").select("kayit_no", F.col("meta.cevap_adaylari").alias("adaylar"), first_content("user").alias("soru"), first_content("assistant").alias("icerik"), F.col("meta.source_pdf").alias("source_pdf"))
    rec = spread(adaylar.filter("soru is not null")).withColumn("aciklama", X.explanation("icerik")).withColumn("harf", X.answer_letter("icerik"))
    passes = F.size(quality.stage_one(F.col("soru"), F.col("soru"), F.col("aciklama"), F.col("harf"), F.col("adaylar"))) == 0
    # no partition has a number under 0: this only keeps the filter above the exchange of spread(), where all cores are, and the explanation computed once
    ok = rec.filter((F.spark_partition_id() < 0) | passes)
    return ok.select("kayit_no", X.short_hash(X.question_key("soru")).alias("anahtar_id"), "icerik", "source_pdf", "harf")


def train_set(spark: SparkSession, d: str) -> DataFrame:
    """Accepted training records: all gates, longest per question, none that the evaluation splits hold."""
    ok = gated(spark, d)
    best = dedup.keep_longest(ok, "anahtar_id", "icerik", "kayit_no", "source_pdf")
    return dedup.without(best, held_out(spark, d), on="anahtar_id").select("anahtar_id", "kayit_no", "copies", F.array_join("sources", ",").alias("sources"))


def question_keys(spark: SparkSession, d: str) -> DataFrame:
    return keyed(spark, d).select("kayit_no", "anahtar_id", X.content_hash("soru").alias("icerik_ozeti"))


def stale_keys(spark: SparkSession, d: str) -> DataFrame:
    """Records whose stored key differs from the key of their question."""
    rec = table(spark, d, "sft_record").select("kayit_no", first_content("user").alias("soru"), F.col("meta.anahtar_id").alias("eski"))
    return rec.filter("soru is not null").withColumn("yeni", X.short_hash(X.question_key("soru"))).filter("not (eski <=> yeni)").select("kayit_no", "eski", "yeni")


def settled_records(spark: SparkSession, d: str) -> DataFrame:
    """Accepted records, the longest per question; questions whose records contradict each other are out as a whole."""
    best = dedup.settled(gated(spark, d), "anahtar_id", "harf", "icerik", "kayit_no", "source_pdf")
    return best.select("anahtar_id", "kayit_no", "copies", F.array_join("sources", ",").alias("sources"))


def surviving_records(spark: SparkSession, d: str) -> DataFrame:
    """The records that near-exact repeats leave, in the order of the input."""
    rec = sft(spark, d).filter("soru is not null").select("kayit_no", "id")
    return rec.join(near_exact_losers(spark, d).select("kayit_no"), "kayit_no", "left_anti").orderBy("kayit_no")


def sample_record(spark: SparkSession, d: str) -> DataFrame:
    """The first record of five options and between 300 and 900 characters of answer."""
    good = (F.length("icerik") > 300) & (F.length("icerik") < 900) & F.col("soru").contains("\nE) ")
    return sft(spark, d).filter(good).select("kayit_no", "id").orderBy("kayit_no").limit(1)


def exam_chronology(spark: SparkSession, d: str) -> DataFrame:
    """Exams with their questions in order of time, April before September."""
    tags = exam_tags(spark, d).withColumn("yil", F.substring_index("sinav", " ", -1)).withColumn("sonra", ~F.col("sinav").startswith("Nisan"))
    return tags.orderBy("yil", "sonra", "sinav").select("sinav", "n")


def distinct_keys(spark: SparkSession, d: str) -> DataFrame:
    """Rows and distinct question keys of each set."""
    out = None
    for name, df in (("egitim", keyed(spark, d)), ("isaretli", flagged(spark, d)), ("degerlendirme", held_out(spark, d))):
        row = df.agg(F.lit(name).alias("kume"), F.count("anahtar_id").alias("satir"), F.count_distinct("anahtar_id").alias("tekil"))
        out = row if out is None else out.unionByName(row)
    return out


def source_shares(spark: SparkSession, d: str) -> DataFrame:
    """Training questions per source, as a share of all and of the largest."""
    n = sampling.share_of_total(sft(spark, d).filter("source_pdf is not null"), "source_pdf")
    return n.withColumn("en_buyuge", F.round(F.lit(100.0) * F.col("n") / F.max("n").over(Window.partitionBy()), 4))


def split_questions(spark: SparkSession, d: str) -> DataFrame:
    """What the plain splitter of options finds in each question."""
    split = F.pandas_udf(lambda s: s.map(lambda t: ",".join([str(len(p["siklar"])), *p["sorun"]]) if (p := extract.split_options(t)) else None), "string")
    return sft(spark, d).filter("soru is not null").select("kayit_no", split("soru").alias("sonuc"))


def duplicates_kept(spark: SparkSession, d: str) -> DataFrame:
    best = dedup.keep_longest(keyed(spark, d).filter("icerik is not null"), "anahtar_id", "icerik", "kayit_no", "source_pdf")
    return best.filter("copies > 1").select("anahtar_id", "kayit_no", "copies", F.array_join("sources", ",").alias("sources"))


def contradicting(spark: SparkSession, d: str) -> DataFrame:
    rec = materialize(keyed(spark, d).select("kayit_no", "anahtar_id", X.answer_letter("icerik").alias("harf")), "letters")
    return dedup.contradictions(rec, "anahtar_id", "harf").select("kayit_no", "anahtar_id", F.concat(F.lit("celiskili_cevap("), "letters", F.lit(")")).alias("sorun"))


def near_exact_losers(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose question, case and spacing aside, another row has: all but the reviewed, then longest, then first."""
    seen = decisions.latest(table(spark, d, "decision")).select("id", F.lit(1).alias("incelendi"))
    rec = sft(spark, d).filter("soru is not null").withColumn("k", X.content_hash("soru")).join(seen, "id", "left")
    best = rec.groupBy("k").agg(F.max_by("kayit_no", F.struct(F.coalesce("incelendi", F.lit(0)), F.length(F.coalesce("icerik", F.lit(""))), -F.col("kayit_no"))).alias("kayit_no"))
    return dedup.losers(rec.select("kayit_no", "id"), "k", best, "kayit_no").withColumn("neden", F.lit("tekrar"))


def best_in_document(spark: SparkSession, d: str) -> DataFrame:
    """Per document and question number the record with an answer and the longest explanation, first on ties."""
    rec = table(spark, d, "flagged_record").select("kayit_no", F.col("meta.source_pdf").alias("source_pdf"), F.col("meta.question_no").alias("no"), "cevap", "aciklama")
    score = F.struct((F.coalesce("cevap", F.lit("")) != "").cast("int"), F.length(F.coalesce("aciklama", F.lit(""))), -F.col("kayit_no"))
    return rec.filter("source_pdf is not null and no is not null").groupBy("source_pdf", "no").agg(F.max_by("kayit_no", score).alias("kayit_no"), F.count("*").alias("aday"))


def latest_decisions(spark: SparkSession, d: str) -> DataFrame:
    return decisions.latest(table(spark, d, "decision")).select("id", "kayit_no", "karar", "neden", "zaman")


def decision_errors(spark: SparkSession, d: str) -> DataFrame:
    """All decisions that break a rule, by rule. aciklama_kes is looked for in the explanation of the training record with that id, the first
    of several that has one."""
    told = sft(spark, d).select("id", "kayit_no", X.explanation("icerik").alias("t")).filter("t is not null").groupBy("id").agg(F.min_by("t", "kayit_no").alias("_told"))
    log = table(spark, d, "decision")
    cut = log.filter("aciklama_kes is not null").join(told, "id", "left").unionByName(log.filter("aciklama_kes is null").withColumn("_told", F.lit(None).cast("string")))
    return cut.select("kayit_no", F.explode(quality.decision_errors(F.col("_told"))).alias("hata"))


def decision_fields(spark: SparkSession, d: str) -> DataFrame:
    """How many of the latest fix decisions touch each field."""
    fields = ["soru", "govde", "siklar", "cevap", "aciklama", "aciklama_kes", "aciklama_paragraf"]
    fixes = decisions.latest(table(spark, d, "decision")).filter("karar = 'duzelt'")
    wide = fixes.agg(*[F.count(f).alias(f) for f in fields])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(f).alias("alan"), F.col(f).alias("n")) for f in fields])))


def routed_records(spark: SparkSession, d: str) -> DataFrame:
    log = table(spark, d, "decision")
    return decisions.route(decisions.patched(cleaned(spark, d), log), log).select("kayit_no", "yol", "elenme", "durum", F.array_join("bayrak", ",").alias("bayrak"))


def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """Records that wait for review, by flag; fixes that could not be made in full wait under their error."""
    log = table(spark, d, "decision")
    routed = decisions.route(decisions.patched(cleaned(spark, d), log), log)
    return decisions.queue(routed).groupBy("bayrak").agg(F.count("*").alias("n"))


def patched_records(spark: SparkSession, d: str) -> DataFrame:
    """Flagged and training records as the latest fixes leave them; a changed stem keeps the record's own options, its lines 'X) text'."""
    old = table(spark, d, "flagged_record").select("kayit_no", "id", "soru", "siklar", "aciklama", "cevap")
    rec = sft(spark, d).select("kayit_no", "id", "soru", F.col("soru").alias("siklar"), X.explanation("icerik").alias("aciklama"), X.answer_letter("icerik").alias("cevap"))
    rec = old.unionByName(rec).groupBy("id").agg(F.min_by(F.struct("soru", "siklar", "aciklama", "cevap"), "kayit_no").alias("f"))
    lines = F.filter(F.split("f.siklar", "\n"), lambda s: s.rlike(r"^[A-E]\) ."))
    opts = F.transform(lines, lambda s: F.struct(F.substring(s, 1, 1).alias("harf"), F.trim(F.substring(s, F.lit(3), F.length(s))).alias("metin")))
    rec = rec.select("id", X.stem("f.soru").alias("govde"), opts.alias("siklar"), "f.soru", "f.aciklama", "f.cevap")
    out = decisions.patched(rec, table(spark, d, "decision")).select("id", "soru", "aciklama", "cevap", "hata")
    return out.join(decisions.latest(table(spark, d, "decision")).filter("karar = 'duzelt'").select("id"), "id", "left_semi")


def repaired_records(spark: SparkSession, d: str) -> DataFrame:
    got = decisions.merge_repairs(table(spark, d, "repair_request"), table(spark, d, "flagged_record"))
    return got.select("kayit_no", "id", "tur", "soru_degistirildi", "anahtar_id", F.md5("icerik").alias("icerik_ozeti"))


def repair_kinds(spark: SparkSession, d: str) -> DataFrame:
    return repaired_records(spark, d).groupBy("tur").agg(F.count("*").alias("n"))


def orphan_requests(spark: SparkSession, d: str) -> DataFrame:
    return decisions.unanswered_requests(table(spark, d, "repair_request"), table(spark, d, "flagged_record")).select("kayit_no", "id")


def eval_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Flagged records whose only problem is a short explanation, with the reason that rules them out, if any."""
    f = flagged(spark, d).filter((F.array_join(quality.problem_set(F.col("sorunlar")), ",") == "aciklama_kisa") & (F.coalesce("cevap", F.lit("")) != ""))
    many = f.filter("size(meta.cevap_adaylari) > 1")
    out = dedup.with_reasons(f.select("kayit_no", "anahtar_id"), "anahtar_id", {"sft_sizintisi": keyed(spark, d), "elle_onarildi": repaired_records(spark, d)})
    out = out.join(many.select("kayit_no", F.lit("coklu_anahtar").alias("_m")), "kayit_no", "left")
    return out.select("kayit_no", "anahtar_id", F.coalesce("_m", "sebep").alias("sebep"))


def eval_chosen(spark: SparkSession, d: str) -> DataFrame:
    """The 50 evaluation candidates with the smallest keys."""
    good = eval_candidates(spark, d).filter("sebep is null").groupBy("anahtar_id").agg(F.min("kayit_no").alias("kayit_no"))
    return sampling.first_by_hash(good, "anahtar_id", 50)


def stratified_holdout(spark: SparkSession, d: str) -> DataFrame:
    rec = keys(spark, d).withColumn("grup", F.coalesce("grup", F.lit("?"))).withColumn("sira", F.concat("anahtar_id", F.lpad(F.col("kayit_no").cast("string"), 12, "0")))
    return sampling.stratified_holdout(rec.select("kayit_no", "grup", "sira"), "grup", "sira", 100).select("kayit_no", "grup")


def final_training(spark: SparkSession, d: str) -> DataFrame:
    """Training records outside every evaluation split, with hand-repaired ones, without those decided to be dropped."""
    rec = keys(spark, d)
    kept = dedup.without(rec, held_out(spark, d), on="anahtar_id")
    drop = decisions.latest(table(spark, d, "decision")).filter("karar = 'at'").select("id")
    excluded = rec.join(drop, "id", "left_semi")
    return decisions.final_training(kept.select("anahtar_id", "kayit_no"), repaired_records(spark, d), excluded.select("anahtar_id"))


def leakage_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Question keys that two sets share: training, the two evaluation splits, repaired, disputed (dropped for a doubtful answer or its key) and
    unusable (dropped for another reason) flagged records. The nine pairs that must be empty, and the rest."""
    held = held_out(spark, d)
    drop = decisions.latest(table(spark, d, "decision")).filter("karar = 'at'").select("id", "neden")
    dropped = flagged(spark, d).join(drop, "id").select("anahtar_id", F.coalesce(F.col("neden").isin(*DISPUTED), F.lit(False)).alias("itiraz"))
    sets = {
        "egitim": keys(spark, d), "eval": held.filter("ayrim = 'tus_mcq_eval'"), "eval_aciklamali": held.filter("ayrim = 'tus_mcq_eval_aciklamali'"), "eval_sinama": held.filter("ayrim = 'tus_mcq_sinama'"),
        "onarilmis": repaired_records(spark, d), "itiraz": dropped.filter("itiraz"), "kullanilamaz": dropped.filter("not itiraz"), "isaretli": flagged(spark, d),
    }
    return dedup.leakage(sets, "anahtar_id")


def round_robin_shards(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "flagged_record").select("kayit_no", F.size("sorunlar").alias("n"))
    return sampling.round_robin(ids, [F.desc("n"), F.asc("kayit_no")], 8).select("kayit_no", "pay")


def shard_progress(spark: SparkSession, d: str) -> DataFrame:
    """Per shard of flagged records (by key) those decided and all."""
    done = table(spark, d, "decision").select("id").distinct().withColumn("d", F.lit(1))
    rec = table(spark, d, "flagged_record").select("kayit_no", "id").withColumn("pay", (F.col("kayit_no") % 8).cast("int"))
    return rec.join(done, "id", "left").groupBy("pay").agg(F.count("d").alias("kararli"), F.count("*").alias("toplam"))


def priority_list(spark: SparkSession, d: str) -> DataFrame:
    """Undecided records in order of risk: class, then most urgent flag, then record.

    Class 1 fails the validator, 2 is flagged, 3 is not in the accepted set (rejected by its flags, or another record's repeat), 4 is the rest.
    """
    rec = produced(spark, d).join(table(spark, d, "decision").select("id").distinct(), "id", "left_anti")
    group = F.when(F.col("yol") == "elenen", 3).when(validate.hatali(F.col("soru"), F.col("aciklama"), F.col("cevap")), 1).when(F.size("bayrak") > 0, 2).otherwise(4)
    return rec.select("kayit_no", group.alias("sinif"), sampling.flag_rank(F.col("bayrak")).alias("bayrak_sirasi")).orderBy("sinif", "bayrak_sirasi", "kayit_no")


def token_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.word_counts(documents(spark, d)).filter("n >= 3")


def stage_one_gates(spark: SparkSession, d: str) -> DataFrame:
    f = spread(table(spark, d, "flagged_record"))
    got = quality.stage_one(F.col("soru"), F.col("siklar"), F.col("aciklama"), F.col("cevap"), F.col("meta.cevap_adaylari"))
    return f.select("kayit_no", F.array_join(got, ",").alias("sorunlar"))


def quality_measures(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "flagged_record")).select("kayit_no", quality.measures(F.col("soru"), F.col("aciklama")).alias("q")).select("kayit_no", "q.cop", "q.tr", "q.aciklama_uz", "q.hece")


def problem_frequency(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "flagged_record").select(F.explode(quality.problem_set(F.col("sorunlar"))).alias("sorun"))
    return sampling.share_of_total(f, "sorun")


def problem_histogram(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "flagged_record").groupBy(F.size("sorunlar").alias("sorun_sayisi")).agg(F.count("*").alias("n"))


def length_buckets(spark: SparkSession, d: str) -> DataFrame:
    n = F.length(F.coalesce("aciklama", F.lit("")))
    return table(spark, d, "flagged_record").groupBy(quality.length_bucket(n).alias("uzunluk")).agg(F.count("*").alias("n"), F.sum(n).alias("harf"), F.max(n).alias("en_uzun"), F.floor(F.sum(n) / F.count("*")).alias("ortalama"))


def nearest_rank_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return sampling.nearest_rank(table(spark, d, "documents"), "n_chars", [0.0001, 0.1, 0.25, 0.5])


def upper_median(spark: SparkSession, d: str) -> DataFrame:
    return sampling.upper_median(sft(spark, d).select(F.length("icerik").alias("n")), "n")


def topic_overlaps(spark: SparkSession, d: str) -> DataFrame:
    rec = sft(spark, d).select("kayit_no", "soru", X.explanation("icerik").alias("aciklama")).filter("soru is not null and trim(aciklama) <> ''")
    return rec.select("kayit_no", F.round(X.topic_overlap("soru", "aciklama"), 6).alias("ortusme"))


def contamination_scan(spark: SparkSession, d: str) -> DataFrame:
    """Records per sign of contamination, those without an explanation, clean ones, and records by their number of signs."""
    rec = sft(spark, d).select(F.coalesce("soru", F.lit("")).alias("soru"), X.thought("icerik").alias("aciklama"))
    told = F.col("aciklama").rlike(r"[^ \t\r\n]")
    flags = F.when(told, quality.contamination_flags(F.col("soru"), F.col("aciklama")))
    few = F.when(~told, F.array(F.lit("aciklama_bos"))).when(F.size("f") == 0, F.array(F.lit("temiz"))).otherwise(F.concat("f", F.array(F.concat(F.lit("bayrak_sayisi_"), F.size("f").cast("string")))))
    return rec.withColumn("f", flags).select(F.explode(few).alias("bayrak")).groupBy("bayrak").agg(F.count("*").alias("n"))


def overlap_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """The overlap of question and explanation at its tenth, quarter and half, of records with an explanation."""
    rec = sft(spark, d).select(F.coalesce("soru", F.lit("")).alias("soru"), X.thought("icerik").alias("aciklama")).filter(r"aciklama rlike '[^ \\t\\r\\n]'")
    return sampling.nearest_rank(rec.select(F.round(X.topic_overlap("soru", "aciklama"), 6).alias("o")), "o", [0.1, 0.25, 0.5])


def word_shares(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return docs.select("doc_id", F.round(X.vowelless_share("text"), 6).alias("cop"), F.round(X.turkish_letter_share("text"), 6).alias("tr"), F.round(X.syllable_share("text"), 6).alias("hece"))


def html_tables(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("instr(text, '<') > 0")
    return docs.select("doc_id", F.md5(X.html_table_text("text")).alias("ozet"))


def option_counts(spark: SparkSession, d: str) -> DataFrame:
    return sft(spark, d).filter("soru is not null").groupBy(X.option_count("soru").alias("sik"), quality.has_five_options(F.col("soru")).alias("bes_sik")).agg(F.count("*").alias("n"))


def boilerplate_lines(spark: SparkSession, d: str) -> DataFrame:
    n = X.boilerplate_count("text")
    return table(spark, d, "documents").filter(n > 0).select("doc_id", n.alias("n"), F.md5(X.without_boilerplate("text")).alias("ozet"))


def exam_tags(spark: SparkSession, d: str) -> DataFrame:
    tag = X.exam_tag("soru")
    return sft(spark, d).filter(tag.isNotNull()).groupBy(tag.alias("sinav")).agg(F.count("*").alias("n"))


def answer_letters(spark: SparkSession, d: str) -> DataFrame:
    return sft(spark, d).groupBy(X.answer_letter("icerik").alias("harf")).agg(F.count("*").alias("n"))


def question_stems(spark: SparkSession, d: str) -> DataFrame:
    return sft(spark, d).filter("soru is not null").select("kayit_no", F.md5(X.stem("soru")).alias("govde_ozeti"))


def repairable_pool(spark: SparkSession, d: str) -> DataFrame:
    """Flagged records worth repairing, by problem, those already done left out."""
    f = flagged(spark, d).filter(quality.repairable(F.concat(F.lit("1. "), F.col("soru")), F.col("aciklama")))
    drop = decisions.latest(table(spark, d, "decision")).filter("karar = 'at'").select("id")  # disputed and unusable ones
    f = dedup.without(f, repaired_records(spark, d), held_out(spark, d), flagged(spark, d).join(drop, "id", "left_semi"), on="anahtar_id")
    p = quality.problem_set(F.col("sorunlar"))
    pool = F.when(F.array_join(p, ",") == "cevap_yok", "cevap_yok").when(F.array_join(p, ",") == "aciklama_kisa", "aciklama_kisa").when(F.array_contains(p, "celiskili_cevap"), "celiskili").when(F.array_contains(p, "coklu_anahtar"), "coklu_anahtar")
    return f.select("kayit_no", pool.alias("havuz")).filter("havuz is not null")


def subjects_of_sources(spark: SparkSession, d: str) -> DataFrame:
    """Training questions per subject of their source's title and per kind of source."""
    title = F.coalesce(quality.subject_of(F.col("source_pdf")), F.lit("?"))
    rec = sft(spark, d).filter("source_pdf is not null")
    return rec.groupBy(title.alias("ders"), quality.source_group(F.col("source_pdf")).alias("tur")).agg(F.count("*").alias("n"))


def dimension_counts(spark: SparkSession, d: str) -> DataFrame:
    """Training questions by each derived dimension: kind of source, subject of its title, exam, answer letter; null where there is none."""
    dims = {"tur": quality.source_group(F.col("source_pdf")), "ders": quality.subject_of(F.col("source_pdf")), "sinav": X.exam_tag("soru"), "harf": X.answer_letter("icerik")}
    long = sft(spark, d).select(F.inline(F.array(*[F.struct(F.lit(k).alias("boyut"), v.alias("deger")) for k, v in dims.items()])))
    return long.groupBy("boyut", "deger").agg(F.count("*").alias("n"))


def package_questions(spark: SparkSession, d: str) -> DataFrame:
    """Every package with the questions its source really has beside the stored, stale number."""
    n = sft(spark, d).groupBy(latex.nfc(F.trim("source_pdf")).alias("drive_pdf")).agg(F.count("*").alias("n"))
    return table(spark, d, "package_map").join(n, "drive_pdf", "left").select("drive_pdf", F.coalesce("n", F.lit(0)).alias("soru"), "egitim_soru")


def validator_report(spark: SparkSession, d: str) -> DataFrame:
    rec = table(spark, d, "sft_record").select(F.col("kayit_no").alias("row"), "id", first_content("user").alias("user"), first_content("assistant").alias("assistant"), F.transform("messages", lambda m: m["role"]).alias("roles"))
    return validate.report(spread(rec), table(spark, d, "eval_record").select("soru"))


def answer_audit(spark: SparkSession, d: str) -> DataFrame:
    rec = sft(spark, d).filter("soru is not null").select(F.col("kayit_no").alias("id"), F.col("source_pdf").alias("source"), F.col("soru").alias("question"), X.answer_letter("icerik").alias("letter"))
    texts = documents(spark, d).select("source", "text")
    return extract.audit_answers(rec, texts).select(F.col("id").alias("kayit_no"), "durum", "kaynak", "farkli")


def normal_form(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", latex.nfc("text").alias("t"))
    return docs.filter("text <> t").select("doc_id", F.md5("t").alias("ozet"))


def clean_questions(spark: SparkSession, d: str) -> DataFrame:
    return sft(spark, d).filter("soru is not null").select("kayit_no", F.md5(latex.clean_text("soru")).alias("ozet"))


def parsed_options(spark: SparkSession, d: str) -> DataFrame:
    p = extract.options_of(latex.clean_text("soru"))
    return sft(spark, d).filter("soru is not null").select("kayit_no", p.alias("p")).select("kayit_no", F.size("p.siklar").alias("sik"), F.array_join("p.onarim", ",").alias("onarim"), F.array_join("p.sorun", ",").alias("sorun"))


def embedded_questions(spark: SparkSession, d: str) -> DataFrame:
    c = extract.embedded_cut(X.explanation("icerik"))
    return sft(spark, d).filter("icerik is not null").select("kayit_no", c.alias("c")).filter("c.kesilen <> ''").select("kayit_no", F.length("c.kalan").alias("kalan"), F.length("c.kesilen").alias("kesilen"))


def segmented_questions(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return extract.segment_questions(extract.line_blocks(docs)).select(F.col("doc").cast("long").alias("doc_id"), "no", X.option_count("siklar").alias("sik"), "cevap", F.length("aciklama").alias("aciklama_uz"), "ilk_blok", "son_blok")


def dictionary_repair(spark: SparkSession, d: str) -> DataFrame:
    """Explanations in Turkish spelling, glued words split, junk sentences dropped."""
    texts = sft(spark, d).select("kayit_no", X.explanation("icerik").alias("text")).filter("text is not null")
    words = dictionary.Vocabulary(dictionary.word_counts(texts, turkish=True))

    def run(t: dictionary.Dictionary, row) -> tuple:
        return row.kayit_no, row.text, t.drop_junk(t.split_glued(t.turkish(t.join_torn(row.text)[0], careful=True)))[0]

    fixed = dictionary.repaired_rows(texts, words, run, "kayit_no long, text string, yeni string")
    return fixed.filter("text <> yeni").select("kayit_no", F.length("text").alias("once"), F.length("yeni").alias("sonra"))


def built_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions segmented from the documents, repaired and gated."""
    docs = documents(spark, d)
    words = dictionary.Vocabulary(dictionary.word_counts(docs))
    got = pipeline.built_records(extract.segment_questions(extract.line_blocks(docs)), words)
    return got.select("id", "anahtar_id", F.col("doc").cast("long").alias("doc_id"), "no", "cevap", "sinav", "olcu.cop", "olcu.hece", F.array_join("sorunlar", ",").alias("sorunlar"))


def document_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Accepted and flagged questions per document."""
    built = built_questions(spark, d).select(F.col("doc_id").alias("doc"), F.filter(F.split("sorunlar", ","), lambda s: s != "").alias("sorunlar"))
    return pipeline.document_summary(built).withColumnRenamed("doc", "doc_id")


def produced_records(spark: SparkSession, d: str) -> DataFrame:
    """Every training record cleaned, flagged, patched and routed by its latest decision, repeats taken out."""
    return produced(spark, d).select("kayit_no", "yol", "elenme", "durum", "hata", F.array_join("bayrak", ",").alias("bayrak"), F.md5("soru").alias("soru_ozeti"), F.md5("aciklama").alias("aciklama_ozeti"), "cevap")


def option_repairs(spark: SparkSession, d: str) -> DataFrame:
    """How often each repair of option marks was made."""
    p = extract.options_of(latex.clean_text("soru"))
    kinds = sft(spark, d).filter("soru is not null").select(F.explode(p["onarim"]).alias("o"))
    return kinds.groupBy(F.substring_index("o", ":", -1).alias("onarim")).agg(F.count("*").alias("n"))


def review_page(spark: SparkSession, d: str) -> DataFrame:
    """The first 40 undecided records as a reviewer sees them."""
    return pipeline.review_view(cleaned(spark, d), table(spark, d, "decision"), 40).select("kayit_no", "id", "gosterim", F.array_join("bayrak", ",").alias("bayrak"))


def decision_progress(spark: SparkSession, d: str) -> DataFrame:
    return decisions.latest(table(spark, d, "decision")).groupBy("karar").agg(F.count("*").alias("n"))


def funnel(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each input, and training records at each step: with a readable frame, through the gates, one per question, none held out."""
    unique = train_set(spark, d)
    kept = dedup.keep_longest(gated(spark, d), "anahtar_id", "icerik", "kayit_no", "source_pdf")
    steps = {"cerceveli": keyed(spark, d).filter(X.answer_letter("icerik").isNotNull()), "kapidan_gecen": gated(spark, d), "tekil": kept, "sizintisiz": unique, "ham": table(spark, d, "sft_record"), "isaretli": table(spark, d, "flagged_record"), "onarim_istegi": table(spark, d, "repair_request"), "degerlendirme": table(spark, d, "eval_record"), "karar": table(spark, d, "decision")}
    out = None
    for name, df in steps.items():
        row = df.agg(F.lit(name).alias("adim"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def before_and_after(spark: SparkSession, d: str) -> DataFrame:
    """Length measures of the training records before and after repeats are taken out."""
    rec = keyed(spark, d).filter("icerik is not null").withColumn("u", F.length("icerik"))
    kept = dedup.keep_longest(rec, "anahtar_id", "icerik", "kayit_no", "source_pdf").select("kayit_no")
    stats = [F.count("*").alias("n"), F.max("u").alias("en_uzun"), F.count_if(F.col("u") >= 200).alias("uzun")]
    a = rec.agg(F.lit("once").alias("surum"), *stats)
    return a.unionByName(rec.join(kept, "kayit_no", "left_semi").agg(F.lit("sonra").alias("surum"), *stats))


SQL_READY: tuple[Query, ...] = (
    train_set, question_keys, stale_keys, duplicates_kept, contradicting, near_exact_losers, best_in_document, latest_decisions, decision_errors, decision_fields, repaired_records, repair_kinds, orphan_requests,
    eval_candidates, eval_chosen, stratified_holdout, final_training, leakage_matrix, round_robin_shards, shard_progress, token_vocabulary, problem_frequency, problem_histogram, length_buckets,
    nearest_rank_percentiles, upper_median, topic_overlaps, word_shares, html_tables, option_counts, boilerplate_lines, exam_tags, answer_letters, question_stems, subjects_of_sources, package_questions, normal_form,
    settled_records, surviving_records, sample_record, exam_chronology, distinct_keys, source_shares, dimension_counts, overlap_percentiles, answer_audit, repairable_pool,
    patched_records, quality_measures, contamination_scan, validator_report, stage_one_gates, decision_progress, funnel, before_and_after,
)
ROWS_ONLY: tuple[Query, ...] = (routed_records, review_queue, priority_list, clean_questions, parsed_options, embedded_questions, segmented_questions, dictionary_repair, built_questions, document_kinds, produced_records, option_repairs, review_page, split_questions)

QUERIES: dict[str, Query] = {q.__name__: q for q in (*SQL_READY, *ROWS_ONLY)}

from derlem.plans.oracle import ORACLE  # noqa: E402, F401

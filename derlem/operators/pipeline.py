"""The two record pipelines: parsed questions to accepted or flagged records, and records to their cleaned form."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derlem.functions import latex
from derlem.functions import text as X
from derlem.functions.dictionary import Dictionary, Vocabulary, repaired_rows
from derlem.functions.text import MONTHS, UPPER
from derlem.operators import dedup, extract, quality

# fixed values: page headers, exam labels, question numbers
PAGE_HEAD = re.compile(r"^\s*(?:ANATOM[İI]|G E N E L|TÜM TUS SORULARI)\s*\d{1,4}\s*$")
EXAM = re.compile(rf"\s*\((?=[^()]{{0,60}}\))[^()]*?(?:{MONTHS}|Nis|Eyl|TTB|TUS|Orijinal)[^()]*?(?:\d{{2,4}}|Orijinal)[^()]*\)", re.I)
NUMBER = re.compile(rf"^\s*\d{{1,3}}\s*[.)]\s*|^\s*\d{{1,3}}\s+(?=[{UPPER}])|^\s*\.\s*")


def provenance_id(source: Column, first: Column, last: Column, question: Column) -> Column:
    """Short hash of source, block range and the question's first 80 characters."""
    return X.short_hash(F.concat(source, F.lit("|["), first.cast("string"), F.lit(", "), last.cast("string"), F.lit("]|"), F.substring(question, 1, 80)))


def repaired(questions: DataFrame, words: dict[str, int] | Vocabulary) -> DataFrame:
    """questions(soru, aciklama, ...) after the mechanical repairs and those that look words up, with their counts."""
    base = questions.withColumns({c: X.mechanical_repair(latex.nfc(c)) for c in ("soru", "aciklama")})
    both = base.withColumns({f"torn_{c}": X.syllable_share(c) for c in ("soru", "aciklama")})
    columns = base.columns

    def run(d: Dictionary, row) -> tuple:
        got, kinds = row._asdict(), {"bosluk_birlestirme": 0, "hece_birlestirme": 0}
        for c in ("soru", "aciklama"):
            text, n = d.join_torn(got[c])
            kinds["bosluk_birlestirme"] += n
            if got[f"torn_{c}"] > 0.40:
                text, n = d.join_syllables(text)
                kinds["hece_birlestirme"] += n
            got[c] = text
        return (*(got[c] for c in columns), {k: n for k, n in kinds.items() if n})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return repaired_rows(both, words, run, f"{fields}, onarim map<string,int>".replace("`", ""))


def built_records(questions: DataFrame, words: dict[str, int] | Vocabulary) -> DataFrame:
    """Segmented questions -> records with id, key, measures and `sorunlar`; accepted where that is empty.

    Several records of one document and number are one: with an answer first, then the longest explanation.
    """
    score = F.struct(F.col("cevap").isNotNull().cast("int"), F.length("aciklama"), -F.col("ilk_blok"))
    best = questions.groupBy("doc", "no").agg(F.max_by(F.struct(*[c for c in questions.columns if c not in ("doc", "no")]), score).alias("q")).select("doc", "no", "q.*")
    raw = best.withColumn("soru", F.concat_ws("\n", "govde", "siklar"))
    rec = repaired(raw.drop("govde"), words).withColumn("aciklama", X.tidy_explanation("aciklama"))
    gates = quality.stage_one(F.col("soru"), F.col("siklar"), F.col("aciklama"), F.col("cevap"), F.col("cevap_adaylari"))
    return rec.select(
        provenance_id(F.col("doc"), F.col("ilk_blok"), F.col("son_blok"), F.col("soru")).alias("id"),
        X.short_hash(X.question_key("soru")).alias("anahtar_id"),
        "doc",
        "no",
        "soru",
        "aciklama",
        "cevap",
        X.exam_tag("soru").alias("sinav"),
        quality.measures(F.col("soru"), F.col("aciklama")).alias("olcu"),
        "onarim",
        F.when(quality.excluded_document(F.col("doc")), F.array(F.lit("kapsam_disi"))).otherwise(gates).alias("sorunlar"),
    )


def document_summary(records: DataFrame) -> DataFrame:
    """(doc, kabul, isaretli, tur): accepted and flagged records per document; a question bank from ten accepted ones on."""
    return records.groupBy("doc").agg(F.count_if(F.size("sorunlar") == 0).alias("kabul"), F.count_if(F.size("sorunlar") > 0).alias("isaretli")).withColumn(
        "tur", F.when(F.col("kabul") >= 10, "soru_bankasi").otherwise("diger")
    )


def settled(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted records -> (one per key, the longest, with copies and documents; all records of contradicting keys)."""
    ok = records.filter(F.size("sorunlar") == 0).withColumn("sira", F.xxhash64("id"))
    clash = dedup.contradictions(ok, "anahtar_id", "cevap")
    rest = ok.join(clash.select("anahtar_id").distinct(), "anahtar_id", "left_anti")
    return dedup.keep_longest(rest, "anahtar_id", "aciklama", "sira", "doc").join(rest.select("sira", "id"), "sira"), clash


# ------------------------------------------------------------------------------------------------ second form


def clean_question(d: Dictionary, text: str) -> dict:
    """A question's cleaned form: stem, options lettered anew where one was lost, old letter -> new, repairs, problems, exam labels."""
    t = d.split_glued(d.turkish(latex.clean(text), careful=True))
    labels = [m[0].strip() for m in EXAM.finditer(t)]
    t = NUMBER.sub("", EXAM.sub("", t), count=1)
    p = extract.parse_options(t)
    options, mapping = extract.relettered(p["siklar"], p["sorun"])
    repairs = list(p["onarim"])
    if [o["harf"] for o in options] != [o["harf"] for o in p["siklar"]]:
        repairs.append("yeniden_harflendi:" + "".join(o["harf"] for o in p["siklar"]))
    return {"metin": t, "govde": p["govde"], "siklar": options, "esleme": mapping, "onarim": repairs, "sorun": p["sorun"], "sinav": labels}


def clean_explanation(d: Dictionary, text: str, by_hand: bool) -> tuple[str, str, int]:
    """(explanation, what was cut off as a next question, junk sentences dropped). Texts written by hand are only respelled."""
    t = "\n".join(s for s in latex.clean(text).split("\n") if not PAGE_HEAD.match(s))
    t = re.sub(r"\n{3,}", "\n\n", t).strip()
    if by_hand:
        return d.turkish(t, emphasis=True), "", 0
    t, cut = extract.cut_embedded(d.split_glued(d.turkish(t, careful=True)))
    t, dropped = d.drop_junk(t)
    return t, cut, dropped


CLEAN = (
    "kayit_no long, id string, soru string, govde string, siklar array<struct<harf:string,metin:string>>, esleme map<string,string>, onarim array<string>, sorun array<string>, sinav array<string>, "
    "aciklama string, cevap string, kesilen int, atilan int, aciklama_cop double, govde_cop double"
)


def cleaned_records(records: DataFrame, words: dict[str, int] | Vocabulary) -> DataFrame:
    """records(kayit_no, id, soru, aciklama, cevap, elle boolean) -> CLEAN; a null explanation or letter stays null, records without a question are left out."""

    def run(d: Dictionary, r) -> tuple:
        q = clean_question(d, r.soru)
        text, cut, dropped = clean_explanation(d, r.aciklama, bool(r.elle)) if isinstance(r.aciklama, str) else (None, "", 0)
        rendered = extract.rendered(q["govde"], q["siklar"]) if q["siklar"] else q["metin"]
        letter = r.cevap if isinstance(r.cevap, str) else None
        shares = d.unknown_share(text or "")[0], d.unknown_share(q["govde"])[0]
        return (r.kayit_no, r.id, d.turkish(rendered, careful=True), q["govde"], q["siklar"], q["esleme"], q["onarim"], q["sorun"], q["sinav"], text, letter, len(cut), dropped, *shares)

    return repaired_rows(records.filter("soru is not null").select("kayit_no", "id", "soru", "aciklama", "cevap", "elle"), words, run, CLEAN)


def flagged_clean(clean: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """CLEAN with `bayrak`; images(id): questions with an image."""
    seen = clean.join(images.select("id").distinct().withColumn("_g", F.lit(True)), "id", "left") if images is not None else clean.withColumn("_g", F.lit(False))
    # the letter is looked up among the old letters, as the recorded answer names an old one
    old = F.transform(F.map_keys("esleme"), lambda k: F.struct(k.alias("harf"), F.lit("").alias("metin")))
    base = quality.review_flags(F.col("govde"), F.col("siklar"), F.col("aciklama"), F.col("cevap"), F.col("_g"), F.col("onarim"), F.col("sorun"))
    more = quality.codes(
        ("cerceve_bozuk", F.col("aciklama").isNull() | F.col("cevap").isNull()),
        ("gomulu_soru_kesildi", F.col("kesilen") > 0),
        ("cop_cumle_atildi", F.col("atilan") > 0),
        ("cevap_sikki_kayip", ~F.exists(old, lambda o: o["harf"] == F.col("cevap"))),
        ("sik_kayip_yeniden_harf", F.exists("onarim", lambda o: o.startswith("yeniden_harflendi"))),
        ("aciklama_bozuk", F.col("aciklama_cop") > 0.15),
        ("soru_bozuk", F.col("govde_cop") > 0.12),
    )
    rest = F.filter(base, lambda f: ~f.isin("cerceve_bozuk", "cevap_sikki_kayip"))
    return seen.withColumn("bayrak", F.concat(more, rest)).withColumn("cevap", F.coalesce(F.element_at("esleme", F.col("cevap")), "cevap")).drop("_g")


def unrepeated(records: DataFrame, reviewed: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, repeats) of records(kayit_no, soru, aciklama): per question, spacing and case aside, the reviewed, longest, first one."""
    keyed = records.withColumn("_k", X.content_hash("soru"))
    best = keyed.groupBy("_k").agg(F.max_by("kayit_no", F.struct(reviewed.cast("int"), F.length("aciklama"), -F.col("kayit_no"))).alias("kayit_no"))
    kept = records.join(best.select("kayit_no"), "kayit_no", "left_semi")
    return kept, records.join(best.select("kayit_no"), "kayit_no", "left_anti").withColumn("elenme", F.lit("tekrar"))


def review_view(clean: DataFrame, log: DataFrame, n: int, short: bool = True) -> DataFrame:
    """The first n undecided records as a reviewer sees them: numbered paragraphs, each shortened, until they come to a limit.

    short: 300 characters a paragraph and 700 in all for records without a flag to show, else 500 and 2500. Options under five are shown
    as sik_sayisi, whatever the flags say.
    """
    open_ = clean.join(log.select("id").distinct(), "id", "left_anti").orderBy("kayit_no").limit(n)
    few = F.when(F.size("siklar") < 5, F.array(F.concat(F.lit("sik_sayisi="), F.size("siklar").cast("string")))).otherwise(F.array().cast("array<string>"))
    shown = open_.withColumn("isaret", F.concat(few, F.filter("bayrak", lambda b: b != "sik_sayisi_az")))
    brief = F.lit(short) & (F.size("isaret") == 0)
    each, whole = F.when(brief, 300).otherwise(500), F.when(brief, 700).otherwise(2500)
    ps = F.transform(X.paragraphs("aciklama"), lambda p, i: F.concat(F.lit("["), i.cast("string"), F.lit("] "), F.substring(p, F.lit(1), each), F.when(F.length(p) > each, " ...").otherwise("")))
    # a paragraph is shown while those before it come to no more than the limit
    sizes = F.transform(X.paragraphs("aciklama"), lambda p: F.least(F.length(p), each))
    ps = F.filter(ps, lambda p, i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, b: a + b) <= whole)
    return shown.select("kayit_no", "id", "soru", F.array_join(ps, "\n").alias("gosterim"), F.col("isaret").alias("bayrak"))

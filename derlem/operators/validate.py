"""Validators of a finished training table: errors, warnings and contamination, as counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derlem.functions import text as X
from derlem.functions.dictionary import WIDE_LETTER
from derlem.operators.quality import codes

STRICT = r"(?s)^<think>\n(.+)\n</think>\n\nDoğru cevap: ([A-E])$"
LATEX_LEFT = r"\$[^$]{1,80}\$|\\(?:math|frac|left|right)"
ENTITY_LEFT = r"&(?:#x?[0-9a-fA-F]+|amp|lt|gt|quot|nbsp);"


def option_rows(question: Column) -> tuple[Column, Column]:
    """(letters, texts) of the option lines 'X) text'."""
    lines = F.filter(F.split(question, "\n"), lambda s: s.rlike(r"^[A-E]\) ."))
    return F.transform(lines, lambda s: F.substring(s, 1, 1)), F.transform(lines, lambda s: F.lower(F.trim(F.regexp_replace(s, r"^[A-E]\) ", ""))))


def record_findings(user: Column, assistant: Column, roles: Column) -> tuple[Column, Column]:
    """(errors, warnings) of one record. A wrong role order or frame ends the inspection, as nothing else can be read."""
    letters, texts = option_rows(user)
    framed = F.coalesce(assistant.rlike(STRICT), F.lit(False))
    told, letter = F.regexp_extract(assistant, STRICT, 1), F.regexp_extract(assistant, STRICT, 2)
    first = F.instr(user, "\nA) ")
    stem = F.when(first > 0, F.substring(user, F.lit(1), first - 1)).otherwise("")
    both = F.concat(user, told)
    complete = letters.eqNullSafe(F.array(*map(F.lit, "ABCDE"))) | letters.eqNullSafe(F.array(*map(F.lit, "ABCD")))
    order = roles.eqNullSafe(F.array(F.lit("user"), F.lit("assistant")))
    ok = order & framed & user.isNotNull()
    signs = F.length(X.only(told, "çğıöşüÇĞİÖŞÜ"))
    size = F.length(X.only(told, X.LETTER))
    errors = codes(
        ("rol", ~order),
        ("cevap_bicimi", order & ~framed),
        ("sik_harfleri", ok & ~complete),
        ("bos_sik", ok & F.exists(texts, lambda t: t.rlike(r"^\s*$"))),
        ("cevap_siklarda_yok", ok & ~F.array_contains(letters, letter)),
        ("govde_yok", ok & (F.length(F.trim(stem)) < 10)),
        ("latex", ok & both.rlike(LATEX_LEFT)),
        ("html", ok & both.rlike(ENTITY_LEFT)),
        ("aciklama_cok_kisa", ok & (F.length(told) < 40)),
    )
    warnings = codes(
        ("ayni_sik_metni", ok & (F.size(F.array_distinct(texts)) < F.size(texts))),
        ("aciklamada_dogru_cevap", ok & told.contains("Doğru cevap")),
        ("aciklama_4000+", ok & (F.length(told) > 4000)),
        ("turkce_karakter_az", ok & (size > 200) & (signs < 0.02 * size)),
    )
    return errors, warnings


def hatali(question: Column, explanation: Column, letter: Column) -> Column:
    """Whether a produced record fails the validator's tests of form: options A-D or A-E, the answer among them, an explanation of 40 and more."""
    letters, _ = option_rows(question)
    complete = letters.eqNullSafe(F.array(*map(F.lit, "ABCDE"))) | letters.eqNullSafe(F.array(*map(F.lit, "ABCD")))
    good = complete & F.array_contains(letters, letter) & (F.length(explanation) >= 40) & letter.rlike("^[A-E]$")
    return ~F.coalesce(good, F.lit(False))


def wide_words(x: Column) -> Column:
    return F.regexp_extract_all(X.turkish_lower(F.coalesce(x, F.lit(""))), F.lit(f"([{WIDE_LETTER}]{{3,}})"), F.lit(1))


def unknown_shares(records: DataFrame, parts: dict[str, Column], known: int = 5) -> DataFrame:
    """records(row, user, assistant) -> (row, a share per part): words of 3 letters and more that stand less than `known` times in all contents,
    over those of the part. Words meet the counts in a join, so their number is not bounded; 0.0 for a part without words."""
    counts = records.select(F.explode(wide_words(F.concat_ws("\n", "user", "assistant"))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") >= known)
    words = None
    for name, column in parts.items():
        rows = records.select("row", F.explode(wide_words(column)).alias("w")).groupBy("row", "w").agg(F.count("*").alias("c")).withColumn("part", F.lit(name))
        words = rows if words is None else words.unionByName(rows)
    met = words.join(counts.select("w", F.lit(1).alias("known")), "w", "left")
    sums = [(F.sum(F.when((F.col("part") == name) & F.col("known").isNull(), F.col("c"))) / F.sum(F.when(F.col("part") == name, F.col("c")))).alias(name) for name in parts]
    return met.groupBy("row").agg(*sums).fillna(0.0)


def report(records: DataFrame, held_out: DataFrame) -> DataFrame:
    """records(row unique, id, user, assistant, roles), held_out(soru) -> (tur, kod, n): all findings counted, none left out."""
    errors, warnings = record_findings(F.col("user"), F.col("assistant"), F.col("roles"))
    keyed = records.select("id", errors.alias("hata"), warnings.alias("uyari"), X.content_hash("user").alias("k"))
    single = keyed.select(F.explode(F.concat(F.transform("hata", lambda c: F.struct(F.lit("hata").alias("tur"), c.alias("kod"))), F.transform("uyari", lambda c: F.struct(F.lit("uyari").alias("tur"), c.alias("kod"))))).alias("x"))
    single = single.groupBy("x.tur", "x.kod").agg(F.count("*").alias("n"))
    # a record with a wrong role order or frame is not read further
    first = F.instr("user", "\nA) ")
    stem = F.when(first > 0, F.substring("user", F.lit(1), first - 1)).otherwise("")
    told = F.regexp_extract("assistant", STRICT, 1)
    read = records.withColumn("ok", F.col("roles").eqNullSafe(F.array(F.lit("user"), F.lit("assistant"))) & F.coalesce(F.col("assistant").rlike(STRICT), F.lit(False)) & F.col("user").isNotNull())
    shares = unknown_shares(read, {"told": F.when(F.col("ok"), told), "stem": F.when(F.col("ok"), stem)})
    strange = shares.select(F.inline(F.array(*[F.struct(F.lit("uyari").alias("tur"), F.lit(kod).alias("kod"), (F.col(c) > limit).alias("on")) for c, limit, kod in (("told", 0.2, "aciklama_bozuk>0.2"), ("stem", 0.15, "govde_bozuk>0.15"))])))
    strange = strange.filter("on").groupBy("tur", "kod").agg(F.count("*").alias("n"))
    ids = keyed.groupBy("id").count().filter("count > 1").agg(F.lit("hata").alias("tur"), F.lit("tekrar_id").alias("kod"), F.count("*").alias("n"))
    asked = keyed.groupBy("k").count().filter("count > 1").agg(F.lit("uyari").alias("tur"), F.lit("tekrar_soru").alias("kod"), F.count("*").alias("n"))
    leaked = held_out.select(X.content_hash("soru").alias("k")).join(keyed.select("k").distinct(), "k", "left_semi")
    leaked = leaked.agg(F.lit("hata").alias("tur"), F.lit("eval_sizintisi").alias("kod"), F.count("*").alias("n"))
    return single.unionByName(strange).unionByName(ids).unionByName(asked).unionByName(leaked).filter("n > 0")

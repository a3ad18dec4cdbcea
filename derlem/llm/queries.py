"""The pN_ queries over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derlem.llm import bpe, canonical, markup, mix, neardup, overlap, pairs, scan, subjects, truncation
from derlem.llm.words import fold
from derlem.sources.tables import spread, table


def contents(role: str) -> Column:
    """The contents of all messages with that role, in order."""
    return F.transform(F.filter("messages", lambda m: m["role"] == role), lambda m: m["content"])


def whole(role: str) -> Column:
    """All contents of a role as one text, a line each; null where there is none."""
    texts = F.filter(contents(role), lambda t: t.isNotNull())
    return F.when(F.size(texts) > 0, F.array_join(texts, "\n"))


def question_texts(spark: SparkSession, d: str) -> DataFrame:
    """(id, text): user contents of sft_record and soru of repair_request."""
    sft = table(spark, d, "sft_record").select(F.col("kayit_no").alias("id"), whole("user").alias("text"))
    rep = table(spark, d, "repair_request").select(F.col("kayit_no").alias("id"), F.col("soru").alias("text"))
    return spread(sft).unionByName(spread(rep)).filter("text is not null")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    links, members = neardup.near_duplicates(question_texts(spark, d))
    return neardup.all_pairs(links, members).select(F.col("a").alias("kayit_no_a"), F.col("b").alias("kayit_no_b"))


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """The links between classes of equal word multisets, by their representatives (smallest kayit_no)."""
    links, _ = neardup.near_duplicates(question_texts(spark, d))
    return links.select(F.col("a").alias("kayit_no_a"), F.col("b").alias("kayit_no_b"), F.round("similarity", 9).alias("benzerlik"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per question with its class's representative, its group (smallest kayit_no reached over links) and its class's number of links."""
    links, members = neardup.near_duplicates(question_texts(spark, d))
    return neardup.groups(links, members).select(F.col("id").alias("kayit_no"), F.col("rep").alias("temsilci"), F.col("group").alias("grup_no"), F.col("links").alias("baglanti"))


def _p3(spark: SparkSession, d: str) -> DataFrame:
    train = table(spark, d, "sft_record").select(F.col("kayit_no").alias("id"), whole("user").alias("text")).filter("text is not null")
    held = table(spark, d, "eval_record").select(F.col("kayit_no").alias("id"), F.col("soru").alias("text")).filter("text is not null")
    return overlap.expand(*overlap.cross_split_overlaps(spread(train), spread(held)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _p3(spark, d).select(F.col("a").alias("sft_kayit_no"), F.col("b").alias("eval_kayit_no"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Confirmed pairs, and the rows on either side, per split and per training source."""
    pairs = _p3(spark, d)
    ev = table(spark, d, "eval_record").select(F.col("kayit_no").alias("b"), "ayrim")
    src = table(spark, d, "sft_record").select(F.col("kayit_no").alias("a"), F.col("meta.source_pdf").alias("source_pdf"))
    return (
        pairs.join(ev, "b").join(src, "a")
        .groupBy("ayrim", "source_pdf")
        .agg(F.count("*").alias("cift"), F.count_distinct("b").alias("eval_kayit"), F.count_distinct("a").alias("sft_kayit"))
    )


def _records(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "sft_record").select(F.col("kayit_no").alias("id"), "messages"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    dup = canonical.formatting_duplicates(_records(spark, d))
    return dup.filter("id <> first").select(F.col("first").alias("ilk_kayit_no"), F.col("id").alias("kayit_no"))


def p5_collapsed(spark: SparkSession, d: str) -> DataFrame:
    """One row per set of equal records that has a copy, with the number of its rows."""
    dup = canonical.formatting_duplicates(_records(spark, d))
    return dup.filter("id = first").select(F.col("first").alias("ilk_kayit_no"), F.col("copies").alias("kopya"))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """(id, part, text, source) of the user and assistant contents of sft_record."""
    return spread(
        table(spark, d, "sft_record")
        .select(F.col("kayit_no").alias("id"), F.explode("messages").alias("m"), F.col("meta.source_pdf").alias("source"))
        .filter("m.role in ('user', 'assistant') and m.content is not null")
        .select("id", F.col("m.role").alias("part"), F.col("m.content").alias("text"), "source")
    )


def _dialogues(spark: SparkSession, d: str) -> DataFrame:
    """(id, turn, user, assistant) of sft_record: the n-th user content with the n-th assistant content, null where one is missing."""
    turns = F.arrays_zip(contents("user").alias("user"), contents("assistant").alias("assistant"))
    rows = table(spark, d, "sft_record").select(F.col("kayit_no").alias("id"), F.posexplode_outer(turns).alias("turn", "t"))
    return spread(rows).select("id", F.coalesce("turn", F.lit(0)).alias("turn"), "t.user", "t.assistant")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    got = markup.convert(_messages(spark, d), with_text=False)
    return got.select(F.col("id").alias("kayit_no"), F.col("part").alias("rol"), F.explode("kinds").alias("bicim")).distinct()


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    """The clean text of every message that held markup."""
    got = markup.convert(_messages(spark, d))
    return got.filter("size(kinds) > 0").select(F.col("id").alias("kayit_no"), F.col("part").alias("rol"), F.concat_ws(",", "kinds").alias("bicimler"), F.col("clean").alias("metin"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The first defect of each record; of records with several turns the first defective one counts."""
    others = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    found = pairs.defects(_dialogues(spark, d), others).groupBy("id").agg(F.min(F.struct("turn", "defect")).alias("d"))
    return found.select(F.col("id").alias("kayit_no"), F.col("d.defect").alias("kusur"))


def _titles(spark: SparkSession, d: str) -> frozenset[str]:
    """Folded words of book titles: publishers and subjects of package_map and subject_area, two fixed small tables."""
    rows = table(spark, d, "package_map").select(F.concat_ws(" ", "yayinevi", "ders").alias("t")).unionByName(table(spark, d, "subject_area").select(F.col("name").alias("t"))).collect()
    fixed = "Bölüm Soru Bankası Ders Notları ve"
    return frozenset(w for t in [fixed, *(r["t"] for r in rows if r["t"])] for w in scan.LETTERS.findall(fold(t)))


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    """(id, part, text, source): messages of sft_record and soru of repair_request."""
    soru = table(spark, d, "repair_request").filter("soru is not null").select(F.col("kayit_no").alias("id"), F.lit("soru").alias("part"), F.col("soru").alias("text"), F.col("source_pdf").alias("source"))
    return _messages(spark, d).unionByName(spread(soru))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    got = scan.repaired(_scanned(spark, d), _titles(spark, d), with_text=False)
    return got.select(F.col("id").alias("kayit_no"), F.col("part").alias("alan"), F.explode("kinds").alias("gurultu")).distinct()


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    """The repaired text of every field that held noise or in which a word is read otherwise; the latter without a kind."""
    got = scan.repaired(_scanned(spark, d), _titles(spark, d))
    return got.filter("size(kinds) > 0 or changed").select(F.col("id").alias("kayit_no"), F.col("part").alias("alan"), F.concat_ws(",", "kinds").alias("gurultuler"), F.col("clean").alias("metin"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(_dialogues(spark, d)).select(F.col("id").alias("kayit_no"), F.col("role").alias("rol")).distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Per source_pdf: its records, those with a cut message, and their share."""
    cut = p7_found(spark, d).groupBy("kayit_no").agg(F.count("*").alias("kesik_ileti"))
    rows = table(spark, d, "sft_record").select("kayit_no", F.col("meta.source_pdf").alias("source_pdf"))
    return (
        rows.join(cut, "kayit_no", "left").groupBy("source_pdf")
        .agg(F.count("*").alias("kayit"), F.count("kesik_ileti").alias("kesik"), F.coalesce(F.sum("kesik_ileti"), F.lit(0)).alias("kesik_ileti"))
        .withColumn("pay", F.col("kesik") / F.col("kayit"))
    )


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(spread(table(spark, d, "documents").select("doc_id", "text")))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    goal = table(spark, d, "mix_target")
    docs = table(spark, d, "documents").join(F.broadcast(goal.select("source")), "source").select("doc_id", "source", "text")
    docs = spread(docs)
    return mix.mix(bpe.encode(docs, counts_only=True, keep=("source",)), goal)


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subjects(spread(table(spark, d, "documents").select("doc_id", "text")), table(spark, d, "doc_label"))


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents and code points per subject; a document of two subjects counts in both."""
    docs = table(spark, d, "documents").select("doc_id", F.length("text").alias("n"))
    return p10_found(spark, d).join(docs, "doc_id").groupBy("subject").agg(F.count("*").alias("belge"), F.sum("n").alias("harf"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_links": p1_links,
    "p1_groups": p1_groups,
    "p2_found": p2_found,
    "p2_clean": p2_clean,
    "p3_found": p3_found,
    "p3_report": p3_report,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_collapsed": p5_collapsed,
    "p6_found": p6_found,
    "p6_repaired": p6_repaired,
    "p7_found": p7_found,
    "p7_report": p7_report,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_composition": p10_composition,
}

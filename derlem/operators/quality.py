"""Quality gates and flags: boolean Column expressions gathered into arrays of codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from derlem.functions import text as X


def codes(*pairs: tuple[str | Column, Column]) -> Column:
    """The codes whose condition holds, in order; a null condition does not hold."""
    tests = [F.when(F.coalesce(cond, F.lit(False)), F.lit(code) if isinstance(code, str) else code) for code, cond in pairs]
    return F.filter(F.array(*tests), lambda c: c.isNotNull())


# fixed values: references to a figure, to an earlier question
FIGURE = (
    r"(?iu)şekilde|şekildeki|resimde|resimdeki|grafikte|grafikteki|görüntüde|fotoğrafta|ok[ \t]*işareti[ \t]*ile|okla[ \t]*gösterilen|yukarıdaki[ \t]*şekil|aşağıdaki[ \t]*şekil|preparatta[ \t]*görülen"
    r"|(?:elektrokardiyogram|EKG|elektrokardiyografi|dalga)[ \t]*\(?[^)\n]{0,24}\)?[ \t]*trase|aşağıdaki[ \t]*elektrokardiyografi|aşağıdaki[ \t]*(?:resim|fotoğraf|şema|çizim)"
    r"|(?:radyografi|grafi|tomografi|preparat)(?:si|sı)[ \t]*aşağıda(?:ki|da)?[ \t]*(?:gibi|verilmiş|gösteril)"
)
EARLIER = (
    r"(?iu)yukarıdaki[ \t]*\(?[ \t]*[0-9]{1,3}|bir[ \t]*önceki[ \t]*soru|önceki[ \t]*soruda|yukarıdaki[ \t]*soruda|yukarıdaki[ \t]*olgu"
    r"|[0-9]{1,3}[ \t]*\.?[ \t]*soruda[ \t]*(?:tanımlanan|anlatılan|verilen|belirtilen)|yukarıda[ \t]*(?:tanımlanan|anlatılan|verilen)[ \t]*hasta"
)
EARLIER_STEM = (
    r"(?iu)bir[ \t]*önceki[ \t]*\(?[ \t]*[0-9]{0,3}[ \t]*(?:numaral[ıi])?[ \t]*\)?[ \t]*soru|önceki[ \t]*soru|\(?[ \t]*[0-9]{1,3}[ \t]*numaral[ıi][ \t]*\)?[ \t]*sorudaki|yukarıdaki[ \t]*soruda"
    r"|[0-9]{1,3}[ \t]*[.\-–]?[ \t]*(?:ve|-|–|,)[ \t]*[0-9]{1,3}[ \t]*\.?[ \t]*soruları|(?:ilk|ikinci|birinci)[ \t]*soruda[ \t]*(?:tanımlanan|verilen|anlatılan)"
)
COMMENT = r"(?iu)\b(?:kolay|zor|klasik|spot|temel bilgi|sınav|soru(?:su|dur|lardan)|kurtarıcı|vazgeçilmez|çeldirici|hatırlat|dikkat edin|bilmek yeterli)\b"


def only_comment(x: Column) -> Column:
    """Every sentence of a folded text is a remark on the exam and at most 250 characters long; no nested repetition, so no deep regex recursion."""
    parts = F.filter(F.split(x, r"[.!]|\n"), lambda s: F.trim(s) != "")
    return X.let(parts, lambda p: (F.size(p) > 0) & F.forall(p, lambda s: (F.length(s) <= 250) & s.rlike(X.folded(COMMENT))))


def stage_one(question: Column, options: Column, explanation: Column, answer: Column, candidates: Column) -> Column:
    """The gates a parsed question must pass; it is accepted if the array is empty."""
    text = F.coalesce(explanation, F.lit(""))
    low = X.fold(text)
    seen = F.struct(
        X.fold(question).alias("q"),
        text.alias("t"),
        ((F.length(text) >= 40) & only_comment(low)).alias("comment"),
        F.round(X.vowelless_share(F.concat(question, text)), 3).alias("junk"),
        X.syllable_share(F.concat_ws(" ", question, text)).alias("torn"),
        F.array_sort(F.array_distinct(F.coalesce(candidates, F.array().cast("array<string>")))).alias("keys"),
    )

    def gates(v: Column) -> Column:
        t, short = v["t"], F.length(v["t"]) < 40
        return codes(
            ("cevap_yok", F.coalesce(answer, F.lit("")) == ""),
            (F.concat(F.lit("coklu_anahtar("), F.array_join(v["keys"], ""), F.lit(")")), F.size(v["keys"]) > 1),
            ("sekle_bagli", v["q"].rlike(X.folded(FIGURE))),
            ("onceki_soruya_bagimli", v["q"].rlike(X.folded(EARLIER))),
            ("tablo_kalintisi", F.size(F.filter(F.split(t, "\n"), lambda s: s.rlike(r"\|.*\|.*\|"))) >= 2),
            ("sik_eksik", X.option_count(options) < 3),
            ("soru_kisa", F.length(question) < 40),
            ("ocr_bozuk", v["junk"] > 0.12),
            ("aciklama_kisa", short),
            ("iceriksiz_gerekce", v["comment"]),
            ("yarim_gerekce", ~short & ~v["comment"] & F.trim(t).rlike(r"[:;,\-–—][ \t\r\n]*$") & (F.length(t) < 200)),
            (F.concat(F.lit("hece_bolunmesi("), F.format_number(v["torn"], 2), F.lit(")")), v["torn"] > 0.40),
        )

    return X.let(seen, gates)


def measures(question: Column, explanation: Column) -> Column:
    """struct<cop, tr, aciklama_uz, hece> of a record, shares to three places."""
    text = F.coalesce(explanation, F.lit(""))
    both = F.concat(question, text)
    return F.struct(
        F.round(X.vowelless_share(both), 3).alias("cop"),
        F.round(X.turkish_letter_share(both), 3).alias("tr"),
        F.length(text).alias("aciklama_uz"),
        F.round(X.syllable_share(F.concat_ws(" ", question, text)), 3).alias("hece"),
    )


CITED = r"(?iu)(?:doğru[ \t]*(?:cevap|yanıt|seçenek|şık)|cevap)[ \t]*[:\-–—]?[ \t]*\(?([A-E])\)?(?![a-zçğıöşü])"
WEAK_REPAIRS = ("parantezsiz", "sahipsiz_parantez", "satir_basi", "ocr_rakam", "tekrar_harf(D)", "yapisik_harf", "satir")


def weak_option_repair(repairs: Column, problems: Column) -> Column:
    return F.exists(repairs, lambda r: F.substring_index(r, ":", -1).isin(*WEAK_REPAIRS)) | F.exists(problems, lambda p: p.contains("coklu"))


def review_flags(stem: Column, options: Column, explanation: Column, letter: Column, has_image: Column, repairs: Column, problems: Column) -> Column:
    """Flags for review of a cleaned record: options array<struct<harf,metin>>, letter the recorded answer. cerceve_bozuk: explanation or letter is null."""
    cited = F.transform(F.regexp_extract_all(X.fold(F.coalesce(explanation, F.lit(""))), F.lit(X.folded(CITED)), F.lit(1)), F.upper)
    contradicts = X.let(cited, lambda c: (F.size(c) > 0) & ~F.array_contains(c, letter))
    return codes(
        ("cerceve_bozuk", explanation.isNull() | letter.isNull()),
        ("cevap_sikki_kayip", ~F.exists(options, lambda o: o["harf"] == letter)),
        ("onceki_soruya_bagli", X.fold(stem).rlike(X.folded(EARLIER_STEM))),
        ("soruda_gorsel", has_image),
        ("sik_onarimi", weak_option_repair(repairs, problems)),
        ("sik_sayisi_az", F.size(options) < 4),
        ("aciklama_uzun", F.length(explanation) > 2500),
        ("aciklama_kisa", F.length(explanation) < 60),
        ("aciklama_harf_celiskisi", contradicts),
        ("aciklamada_cevap_satiri", explanation.contains("Doğru cevap")),
    )


# fixed values: signs of a neighbour question that ran into an explanation
NEW_HEADING = r"(?:^|\n)[ \t\r\n]*[0-9]{1,3}[ \t]*[.)][ \t\r\n]*[A-ZÇĞİÖŞÜ]"
ANSWER_ROW = r"(?iu)(?:do[ğg]ru[ \t]*)?cevap[ \t]*[:\-–—]?[ \t]*[A-Ea-e](?![a-zA-ZçğıöşüÇĞİÖŞÜ0-9_])"
OPTION_IN_TEXT = r"(?:^|[ \t\r\n])\(?([A-Ea-e])[ \t\r\n]*[).][ \t\r\n]+[^ \t\r\n]"
QUESTION_TAG = r"(?iu)(?:^|[^A-Za-z])SORU[ \t]*[0-9]{1,3}(?:[^0-9]|$)"
BOOKLET = r"(?iu)K[İI]TAP[ÇC]I[ĞG]I|DENEME SINAVI|Önce TUS|ABONE OL|www\.|Bedava"


def contamination_flags(question: Column, explanation: Column) -> Column:
    """Signs that a neighbour question ran into the explanation; explanation must not be blank."""
    letters = F.array_distinct(F.transform(F.regexp_extract_all(explanation, F.lit(OPTION_IN_TEXT), F.lit(1)), F.upper))
    overlap, low = X.topic_overlap(question, explanation), X.fold(explanation)
    return codes(
        ("yeni_soru_basligi", explanation.rlike(NEW_HEADING)),
        ("sik_blogu", F.size(letters) >= 4),
        ("cevap_satiri", low.rlike(X.folded(ANSWER_ROW))),
        ("soru_etiketi", low.rlike(X.folded(QUESTION_TAG))),
        ("kitapcik_metni", low.rlike(X.folded(BOOKLET))),
        ("dusuk_ortusme", overlap < 0.10),
    )


ASKING = r"(?iu)hangisi|hangileri|nedir|kaçtır|değildir|yanlış|doğru olan|beklenmez|görülmez|söylenebilir|düşünülür|uygundur|seçiniz|işaretleyiniz"
KEY_LIST = r"[0-9]{1,2}[ \t]*[-–][ \t]*[A-E](?:[ \t]*,[ \t]*[0-9]{1,2}[ \t]*[-–][ \t]*[A-E]){2,}"


def repairable(question: Column, explanation: Column) -> Column:
    """Worth repairing: asks something, is numbered, has four options, no key list, no options in the explanation."""
    q, e = X.squeeze(F.coalesce(question, F.lit(""))), X.squeeze(F.coalesce(explanation, F.lit("")))
    return X.fold(X.stem(q)).rlike(X.folded(ASKING)) & q.rlike(r"^[0-9]{1,3}[ \t]*[.)]") & ~e.rlike(KEY_LIST) & ~q.rlike(KEY_LIST) & (X.option_count(e) < 4) & (X.option_count(q) >= 4)


def problem_set(problems: Column) -> Column:
    """Sorted problem codes without their details."""
    return F.array_sort(F.transform(F.coalesce(problems, F.array().cast("array<string>")), lambda p: F.substring_index(p, "(", 1)))


def length_bucket(n: Column) -> Column:
    return F.when(n >= 200, "uzun").when(n >= 40, "orta").otherwise("kisa")


def has_five_options(question: Column) -> Column:
    return F.coalesce(question.contains("\nE) "), F.lit(False))


# fixed values: subject by the first pattern found in a title
SUBJECTS = (
    ("anatomi", "Anatomi"), ("biyokimya", "Biyokimya"), ("dahil", "Dahiliye"), ("farmakoloji", "Farmakoloji"), ("fizyoloji|histoloji|embriyoloji", "Fizyoloji-Histoloji-Embriyoloji"),
    ("cerrahi", "Genel Cerrahi"), ("kad[ıi]n", "Kadın Doğum"), ("sta[jl]", "Küçük Stajlar"), ("mikrobiyoloji", "Mikrobiyoloji"), ("patoloji", "Patoloji"), ("pediatri", "Pediatri"),
)


def subject_of(title: Column) -> Column:
    t, out = X.plain_lower(title), F.lit(None).cast("string")
    for pattern, name in reversed(SUBJECTS):
        out = F.when(t.rlike(pattern), name).otherwise(out)
    return out


def source_group(source: Column) -> Column:
    """First part of a source's path."""
    return F.substring_index(source, "/", 1)


def excluded_document(name: Column) -> Column:
    return F.coalesce(name.rlike("YDS|İngilizce|Ingilizce"), F.lit(False))


REASONS = ("soru_bozuk", "gorsel_gerekli", "cevap_supheli", "eksik_bilgi", "sik_kayip", "baglam_gerekli", "tekrar", "diger")


def decision_errors(explanation: Column | None = None) -> Column:
    """What is wrong with a decision row; needs its columns as stored in the log. explanation: the text aciklama_kes must stand in,
    null where the record is not known. Fields that no decision has are found where logs are read (sources.files.unknown_fields)."""
    told = F.lit(None).cast("string") if explanation is None else explanation
    return codes(
        ("karar", ~F.coalesce(F.col("karar").isin("ok", "at", "duzelt"), F.lit(False))),
        ("neden", (F.col("karar") == "at") & ~F.coalesce(F.col("neden").isin(*REASONS), F.lit(False))),
        ("siklar_cevapsiz", F.col("siklar").isNotNull() & F.col("cevap").isNull()),
        ("cevap", F.col("cevap").isNotNull() & ~F.col("cevap").rlike("^[A-E]$")),
        ("cevap_siklarda_yok", F.col("siklar").isNotNull() & F.col("cevap").isNotNull() & ~F.map_contains_key("siklar", F.coalesce("cevap", F.lit("")))),
        ("aciklama_paragraf", F.col("aciklama_paragraf").isNotNull() & ~F.col("aciklama_paragraf").rlike("^[0-9]+(-[0-9]*)?$")),
        ("aciklama_kes", F.col("aciklama_kes").isNotNull() & told.isNotNull() & ~told.contains(F.col("aciklama_kes"))),
    )

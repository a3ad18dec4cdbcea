"""Truncation, broken pairs, scan noise and subjects: cases, held-out accuracy, odd inputs."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from derlem.llm import overlap, pairs, scan, subjects, truncation
from derlem.sources.tables import first_content, table
from tests.conftest import rows


@pytest.fixture(scope="module")
def dialogues(spark, data):
    d = data.replace("sf0.001", "sf0.01")
    df = table(spark, d, "sft_record").select(F.col("kayit_no").alias("id"), first_content("user").alias("user"), first_content("assistant").alias("assistant"))
    return [tuple(r) for r in df.orderBy("id").collect()]


@pytest.fixture(scope="module")
def ends(dialogues):
    return truncation.fit([(u, a) for i, u, a in dialogues if i % 2])


@pytest.fixture(scope="module")
def judge(dialogues):
    return pairs.fit([(u, a) for i, u, a in dialogues if i % 2])


def frame(t, letter="A"):
    return f"<think>\n{t}\n</think>\n\nDoğru cevap: {letter}"


TOLD = "Buna karşılık kalp debisi genellikle zar geçirgenliğini değiştirir."


@pytest.mark.parametrize(
    "text",
    [
        frame(TOLD), frame(TOLD + "\nAranan bulgular:\n• sternum\n• patella"), frame(TOLD + "\nTablo 2: a | 111 | b"), frame(TOLD + "\n314 mg/dL"), frame(TOLD + "\nAyrıntı için bkz. sayfa 273"), frame(TOLD + "\n(kaynak kitap, bölüm 6)"),
        frame(f"<p>{TOLD}</p>"), frame('"' + TOLD + '"'), "Üzgünüm, bu konuda yardımcı olamam.", frame("—"), frame("Yanıt kalp debisi."), None, "", "  \n", frame(TOLD) + "\n",
    ],
)
def test_whole_answers(ends, text):
    assert not truncation.is_cut(ends, "assistant", text)


@pytest.mark.parametrize("text", [frame(TOLD + " Buna karşılık kalp deb"), f"<think>\n{TOLD}", f"<think>\n{TOLD} Buna", frame(TOLD) [:-12], frame(TOLD + " İzlemin 60."), frame(TOLD + " Buna karş�")])
def test_cut_answers(ends, text):
    assert truncation.is_cut(ends, "assistant", text)


Q = "Aşağıdakilerden hangisi doğrudur?\nA) Kalp debisi\nB) Ön yük\nC) Ard yük\nD) Vagal tonus"


@pytest.mark.parametrize(("text", "cut"), [(Q, False), (Q + "\nE) 343 mg zortamek", False), (Q[:-12], True), (Q[:30], True), (Q.replace("\n", " "), False), (Q.lower(), False), (None, False), ("", False)])
def test_questions(ends, text, cut):
    assert truncation.is_cut(ends, "user", text) is cut


def test_held_out_cuts_are_found(ends, dialogues):
    random.seed(1)
    whole = [truncation.explanation(a)[0].strip() for i, _, a in dialogues if i % 2 == 0 and a and not truncation.is_cut(ends, "assistant", a) and truncation.explanation(a)[1]]
    whole = [w for w in whole if w.endswith(".") and len(w) > 120 and "\n" not in w][:300]
    cuts = [w[: random.randint(60, len(w) - 2)] for w in whole]
    cuts = [c for c in cuts if c[-1].isalpha()]
    found = sum(truncation.is_cut(ends, "assistant", frame(c)) for c in cuts)
    false = sum(truncation.is_cut(ends, "assistant", frame(w)) for w in whole)
    assert found >= 0.93 * len(cuts) and false <= 0.01 * len(whole)


def test_truncated_column(spark, dialogues):
    more = [(-1, None, None), (-2, "", " "), (-3, "x" * 100000, frame("y " * 50000))]
    df = spark.createDataFrame([(*r, "z") for r in dialogues[:300] + more], "id long, user string, assistant string, role string")
    got = truncation.truncated(df)
    assert got.columns == ["id", "role"] and 0 < got.count() < 60
    assert truncation.truncated(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 150])
def test_small_tables(dialogues, n):
    """A model of few rows judges without failing, long texts and repeated rows among them."""
    rows_ = [(u, a) for _, u, a in dialogues if u and a][:n] + [(Q * 3000, frame(TOLD * 2000))] * (n > 2)
    model = pairs.fit(rows_)
    for u, a in [*rows_[:5], (None, None), ("", ""), (Q, frame(TOLD))]:
        model.defect(u, a), truncation.is_cut(model.ends, "user", u), truncation.is_cut(model.ends, "assistant", a)


@pytest.mark.parametrize(
    ("assistant", "want"),
    [
        (None, "bos"), ("", "bos"), (frame("—"), "bos"), (frame("..."), "bos"), ("<think></think>", "bos"), ("Doğru cevap: A", "bos"), (frame(" \u200b"), "bos"),
        (frame("Üzgünüm, bu konuda görüş bildiremem."), "ret"), ("I am sorry, but I cannot answer that.", "ret"), (frame("Merhaba. Bunu yanıtlamayı uygun bulmuyorum. Lütfen bir hekime danışın."), "ret"), (frame("Lo siento, no puedo responder."), "ret"),
        (frame("Soru: " + Q.split("\n")[0] + " Kan basıncı yüksek, nabız hızlı bulunuyor."), "kopya"),
        (frame("Açıklama: The cardiac output is often seen with the preload in these patients. None of the other options explains it."), "yabanci_dil"), (frame("Diese Antwort ist richtig und die anderen sind nicht richtig. Man sollte das nicht verwechseln."), "yabanci_dil"),
        (frame(TOLD + " Buna karşılık kalp deb"), "yarim"), (f"<think>\n{TOLD} Buna", "yarim"),
        (frame(TOLD), None), (frame("Yanıt kalp debisi."), None), (frame("Hekim kalp debisi konusunda yorum yapamadığını dosyaya yazmıştır. " + TOLD), None), (frame("Bu ilaç gebelere verilemez ve emziren annede önerilmez. " + TOLD), None),
        (frame('Orijinal metinde "The cavernous sinus should be checked first" cümlesi geçer. ' + TOLD), None),
    ],
)
def test_defects(judge, assistant, want):
    user = "Kan basıncı yüksek, nabız hızlı bulunuyor. " + Q
    assert judge.defect(user, assistant) == want


def test_held_out_defects(judge, dialogues):
    sound = [(u, a) for i, u, a in dialogues if i % 2 == 0 and u and a and judge.defect(u, a) is None]
    assert len(sound) > 600
    echo = sum(judge.defect(u, frame(truncation.option_spans(u)[0])) == "kopya" for u, _ in sound[:200] if not truncation.is_cut(judge.ends, "user", u))
    asked = sum(not truncation.is_cut(judge.ends, "user", u) for u, _ in sound[:200])
    assert echo >= 0.95 * asked


def test_defect_column(spark, dialogues):
    df = spark.createDataFrame([(*r, "x") for r in [*dialogues[:300], (-1, None, None), (-2, None, frame(TOLD))]], "id long, user string, assistant string, defect string")
    got = {i: d for i, _, d in rows(pairs.defects(df))}
    assert got[-1] == "bos" and -2 not in got
    assert rows(pairs.defects(df.limit(0))) == []
    assert rows(pairs.defects(spark.createDataFrame([(1, "s", None)], "id long, user string, assistant string"))) == [(1, 0, "bos")]


# ------------------------------------------------------------------------------------------------ scan noise

LEXICON = {w: (n, f) for w, n, f in [("karaciğer", 90, "karaciğer"), ("hastaliği", 80, "hastalığı"), ("bulunan", 70, "bulunan"), ("kişide", 60, "kişide"), ("ağri", 50, "ağrı"), ("sendromu", 40, "sendromu"), ("taniyi", 30, "tanıyı"), ("için", 99, "için"), ("değildir", 55, "değildir"), ("düşük", 45, "düşük"), ("kalp", 60, "kalp"), ("debisi", 50, "debisi"), ("normal", 40, "normal")]}
TITLES = frozenset("biyokimya patoloji genel cerrahi sofenon bölüm soru bankasi ders notlari ve".split())


@pytest.fixture(scope="module")
def decoder():
    return scan.Decoder(LEXICON, scan.Headers({}, TITLES))


@pytest.mark.parametrize(
    ("text", "kinds", "clean"),
    [
        ("karaci-\nğer hastalığı bulunan", ["tire"], "karaciğer hastalığı bulunan"),
        ("karaci\u00ad\r\nğer hastalığı", ["tire"], "karaciğer hastalığı"),
        ("kara¬\n~ 12 ~\nciğer hastalığı için\nson", ["tire", "sayfa_no"], "karaciğer hastalığı için son"),
        ("hasta1ığı bu1unan kişide", ["karakter"], "hastalığı bulunan kişide"),
        ("senclromu tanlyı düşük", ["karakter"], "sendromu tanıyı düşük"),
        ("kişide d€ğildir iç!n", ["karakter"], "kişide değildir için"),
        ("kalp debisi\n[611]\nnormal değildir.", ["sayfa_no"], "kalp debisi normal değildir."),
        ("kalp debisi\n188 / 704\nnormal", ["sayfa_no"], "kalp debisi normal"),
        ("kalp debisi\n| Sofenon Biyokimya |      321\nnormal", ["ustbilgi", "sayfa_no"], "kalp debisi normal"),
        ("kalp debisi\nBİYOKİMYA DERS NOTLARI\nnormal", ["ustbilgi"], "kalp debisi normal"),
        ("kalp debisi\nBölüm 3 – Genel Cerrahi\nnormal", ["ustbilgi"], "kalp debisi normal"),
        ("kalp debisi\n12   Patoloji / Soru Bankası\nnormal", ["ustbilgi", "sayfa_no"], "kalp debisi normal"),
    ],
)
def test_repair(decoder, text, kinds, clean):
    assert scan.repair(text, decoder) == (clean, kinds)


@pytest.mark.parametrize(
    "text",
    [
        "", "kalp debisi normal", "hasta1ığı bulunan kişide", "Olağan aralık 223 –\n443 g/dL olarak", "Kalp\nA) kalp\nB) debisi", "CD4 B12 HbA1c A1_5 CO2 mm3", "Değerler:\n314 mg/dL\nson", "- kalp\n- debisi\n- normal",
        "Zortamek Prelinor\nLukarnes", "Ayrıntı için bkz. sayfa 273\nson\nx", "T1 | T2 | kontrast\nx\ny", "611",
    ],
)
def test_no_noise_comes_back_as_it_is(decoder, text):
    assert scan.repair(text, decoder) == (text, [])


def test_paragraphs_are_chosen():
    text = "Uzun bir satır burada başlar ve devam\neder, sonunda biter.\nKısa.\n\nYeni paragraf burada.\nA) bir\nB) iki"
    assert scan.paragraphs(text.split("\n")) == "Uzun bir satır burada başlar ve devam eder, sonunda biter.\nKısa.\n\nYeni paragraf burada.\nA) bir\nB) iki"


@pytest.mark.parametrize(
    ("text", "moves"),
    [
        ("kalpdebisi kara ciğer normal", [("split", ("kalp", "debisi")), ("merge", "karaciğer")]),
        ("normal debi si", [("merge", "debisi")]),
        ("kalp debi\nlar", []),  # the whole is no word
        ("kalp de-\nbisi", [("hyphen", (2, None, ""))]),
        ("kalp -\ndebisi", []),  # a dash between two words
        ("kalp de-\n[12]\nbisi normal", [("hyphen", (3, None, ",sayfa_no"))]),
        ("kalpdebisl normal", [("split", ("kalp", "debisi"))]),  # one part misread
        ("hasta1i-\nği", [("hyphen", (1, "hastaliği", ""))]),  # broken and misread
    ],
)
def test_moves_of_the_decoder(decoder, text, moves):
    assert [m[2:] for m in decoder.stream(text, list(scan.TOKEN.finditer(text)))] == moves


def test_a_known_first_part_is_merged():
    d = scan.Decoder(LEXICON | {"kara": (30, "kara")})
    assert scan.repair("kara ciğer normal", d, every=True)[0] == "karaciğer normal"


def test_readings_are_complete():
    """Every word that up to CONFUSIONS letter pairs turn the token into is a candidate."""
    def brute(w, left):
        out = {w}
        if left:
            for old, new in scan.LETTER_PAIRS:
                for i in range(len(w)):
                    if w.startswith(old, i):
                        out |= {w[:i] + new + r for r in brute(w[i + len(old) :], left - 1)} | {w[:i] + new + w[i + len(old) :]}
        return out

    for w in ("clrnriil", "rnrnrnrn", "lllllll"):
        assert brute(w, 3) <= {s for s, _ in scan.candidates(w)}


def test_headers_are_known_by_coming_again_in_a_source(spark):
    page = "Bu tabloyu en iyi {0}\n{1}   Torbul Biyoloji • Sanıl\naçıklayan düzenek budur.\nSon satır burada."
    rows = [("k1", page.format(w, n)) for w, n in (("bir", 12), ("iki", 99), ("üç", 140))] + [("k2", page.format("x", 7).replace("Torbul Biyoloji", "Merdan Fizik"))] * 2
    rows += [("k1", "Bir yıldır süren\nTSH yüksekliği olan\nkişide bakılır.\nSon.")] * 3  # copies are one place
    texts = spark.createDataFrame(rows, "source string, text string")
    got = scan.header_words(texts)
    assert got == {"torbul": 3, "biyoloji": 3, "sanil": 3}
    d = scan.Decoder({}, scan.Headers(got))
    assert scan.repair(page.format("dört", 55), d)[1] == ["ustbilgi", "sayfa_no"]
    assert scan.repair(rows[-1][1], d)[1] == []


def test_doubling_the_corpus_changes_nothing(spark, data):
    d = data.replace("sf0.001", "sf0.1")
    texts = table(spark, d, "sft_record").select(F.explode("messages.content").alias("text")).filter("text is not null")
    once, twice = scan.lexicon(texts), scan.lexicon(texts.unionAll(texts))
    total = sum(n for n, _ in once.values())
    assert total * scan.RARE > scan.LEAST  # large enough for the share to decide
    assert {w: (2 * n, f) for w, (n, f) in once.items()} == twice


def test_split_and_merge_in_text(decoder):
    assert scan.repair("hasta1ığı bu1unan kara ciğer kalpdebisi", decoder)[0] == "hastalığı bulunan karaciğer kalp debisi"


@pytest.mark.parametrize(
    ("text", "kinds", "clean"),
    [
        ("hasta1ığı bulunan kişide", [], "hastalığı bulunan kişide"),
        ("kalpdebisi normal\nkara ciğer", [], "kalp debisi normal\nkaraciğer"),
        ("kara) ciğer", [], "kara) ciğer"),
        ("hba1c de\u0306ğ\u0306ri", [], "hba1c de\u0306ğ\u0306ri"),
        ("karaci-\nğer hasta1ığı kalpdebisi", ["tire"], "karaciğer hastalığı kalp debisi"),
    ],
)
def test_words_are_decoded_below_the_reporting_threshold(decoder, text, kinds, clean):
    assert scan.repair(text, decoder, every=True) == (clean, kinds)
    if kinds:
        assert scan.repair(text, decoder) == (clean, kinds)


def test_changed_column(spark):
    rows = [(i, "soru", "kalp debisi normal değildir " * 20 + ("norma1" if i == 0 else "normal"), "x") for i in range(30)]
    got = {r["id"]: r for r in scan.repaired(spark.createDataFrame(rows, "id long, part string, text string, kinds string")).collect()}
    assert got[0]["changed"] and got[0]["kinds"] == [] and got[0]["clean"] == rows[1][2] and not got[1]["changed"]


def test_lexicon_counts_all_rows_and_leaves_misread_words_out(spark):
    texts = spark.createDataFrame([("Hastalığı HASTALIĞI hastalığı",)] * 40 + [("hasta1ığı",)] + [("hastallğı",)] * 4 + [(None,), ("",)], "text string")
    lex = scan.lexicon(texts)
    assert lex["hastaliği"] == (120, "hastalığı") and "hastalliği" not in lex and len(lex) <= 1 / scan.RARE


def test_repaired_column(spark):
    df = spark.createDataFrame([(1, "user", "kalp debisi normal değildir\n" * 50, "x"), (2, "soru", None, "x"), (3, "soru", "kalp de-\nbisi\n[3]\nson", "x")], "id long, part string, text string, kinds string")
    got = {r["id"]: (r["kinds"], r["clean"]) for r in scan.repaired(df).collect()}
    assert got[2] == ([], None) and got[3][0] == ["tire", "sayfa_no"]
    assert scan.repaired(df.limit(0)).count() == 0


# ------------------------------------------------------------------------------------------------ subjects


def doc(*subject_terms, filler=0):
    return " ".join(f"Burada {t} ayrıntılı olarak anlatılmıştır." for t in subject_terms) + " Bu bölüm sınavdan önce tekrar edilmelidir." * filler


def test_subjects(spark):
    data = [
        (1, doc("kalp debisi", "tidal volüm", "vital kapasite")),
        (2, doc("kalp debisi", "tidal volüm", "sternum", "patella")),
        (3, doc("kalp debisi", "tidal volüm", "vital kapasite", "sternum")),  # one stray sentence
        (4, doc("kalp debisi", "tidal volüm", filler=9)),  # under a quarter
        (5, None), (6, ""), (7, "  \n"), (8, "KALP DEBİSİNİN artışı tidal vo-\nlümü etkiler.\n[12]\nVital kapasitenin değeri de öyle."),
        (9, "The cardiac output is low. A synapse was seen."), (10, (doc("kalp debisi") + " ") * 20000),
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, subject string")
    labels = spark.createDataFrame([(1, "fizyoloji"), (2, "anatomi"), (2, "fizyoloji"), (3, "fizyoloji"), (99, "hukuk"), (1, None)], "doc_id long, subject string")
    assert subjects.subjects(df, labels).columns == ["doc_id", "subject"] and subjects.subjects(df, labels).count() > 0
    got = rows(subjects.subjects(df))
    assert got == [(1, "fizyoloji"), (10, "fizyoloji"), (2, "anatomi"), (2, "fizyoloji"), (3, "fizyoloji"), (8, "fizyoloji"), (9, "fizyoloji")]
    assert subjects.subjects(df.limit(0)).count() == 0


def test_subject_terms_are_distinct():
    owners = {}
    for t, s in subjects.general_terms():
        assert owners.setdefault(t, s) == s, t
    assert len(set(owners.values())) == 14


def test_terms_are_learned_from_labels():
    labelled = [(doc(f"{a} {t}"), {s}) for a in ("erken", "geç", "hafif", "ağır") for t, s in (("torbul eğrisi", "hukuk"), ("sanıl payı", "spor"))]
    labelled += [(t + f" Bu konuda {s} ayrıdır.", k) for (t, k), s in zip(labelled, "abcdefgh")]
    got = dict(subjects.learn(labelled, [("ayrintili", "anatomi"), ("mahkeme", "hukuk")]))
    assert got["torbul"] == "hukuk" and got["sanil"] == "spor" and got["mahkeme"] == "hukuk"
    assert "burada" not in got and "ayrintili" not in got  # in documents of both; contradicted by the labels


def test_learned_terms_place_documents_that_were_not_labelled(spark, data):
    d = data.replace("sf0.001", "sf0.01")
    known = {}
    for i, s in table(spark, d, "doc_label").distinct().collect():
        known.setdefault(i, set()).add(s)
    texts = {r["doc_id"]: r["text"] for r in table(spark, d, "documents").filter("text is not null").collect()}
    learnt = [(texts[i], s) for i, s in sorted(known.items()) if i in texts and i % 2]
    terms = subjects.vocabulary(learnt, [t for i, t in sorted(texts.items()) if i not in known])
    a, even = subjects.automaton(terms), [1.0] * len(terms)
    held = [(set(subjects.assign(subjects.evidence(a, terms, even, texts[i]), 0.35)), s) for i, s in known.items() if i in texts and i % 2 == 0]
    assert sum(len(x & y) for x, y in held) >= 0.85 * sum(len(y) for _, y in held)


def test_agrees_with_labels(spark, data):
    d = data.replace("sf0.001", "sf0.01")
    labels = table(spark, d, "doc_label").distinct()
    got = {}
    for i, s in subjects.subjects(table(spark, d, "documents"), labels).collect():
        got.setdefault(i, set()).add(s)
    want = {}
    for i, s in labels.collect():
        want.setdefault(i, set()).add(s)
    assert sum(got.get(i, set()) == s for i, s in want.items()) >= 0.93 * len(want)  # a few labels are wrong


# ------------------------------------------------------------------------------------------------ whole tables


def test_all_rows_make_the_end_model(spark, dialogues, monkeypatch):
    """A table is judged by the counts and thresholds of all its rows, the long ones too."""
    monkeypatch.setattr(truncation, "SAMPLE", 40, raising=False)
    monkeypatch.setattr(truncation, "LONGEST", 300, raising=False)
    told = [(i, u, a) for i, (_, u, a) in enumerate(dialogues[:600])]
    schema = "id long, user string, assistant string"
    # the model of the rows in memory, with each row's own place for its made cut
    model = truncation.fit([(u, a) for _, u, a in told])
    want = sorted((i, role) for i, u, a in told for role, t in (("user", u), ("assistant", a)) if truncation.is_cut(model, role, t))
    assert len(want) > 10 and rows(truncation.truncated(spark.createDataFrame(told, schema).repartition(3))) == sorted(want, key=repr)


def test_all_documents_teach_terms(spark, monkeypatch):
    """Terms are learned from all labelled documents, long ones too, and from all others where few are labelled."""
    for name, value in (("LABELLED", 6), ("FILL", 6), ("LONGEST", 400)):
        monkeypatch.setattr(subjects, name, value, raising=False)
    words_ = ["torbul", "sanil", "merkot", "zulfen", "karpit", "dontal", "feltem", "gorzan"]
    data = [(i, doc(f"{words_[i % 8]} eğrisi", f"{words_[i % 8]} payı") + f" Bu bölüm {i} sayfadır." * (1 + 30 * (i % 8 > 3))) for i in range(48)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    names = sorted(subjects.TERMS)[:8]
    labels = spark.createDataFrame([(i, names[i % 8]) for i, _ in data], "doc_id long, subject string")
    labelled = subjects.with_labels(df, labels)
    got = subjects.learned(subjects.distinct(labelled), subjects.general_terms())
    assert {w: s for w, s in got if w in words_} == dict(zip(words_, names))
    assert got == subjects.learn([(t, {names[i % 8]}) for i, t in data], subjects.general_terms())
    some = labels.filter("doc_id < 2 or doc_id between 8 and 9 or doc_id between 16 and 17")
    other = spark.createDataFrame([(100 + i, doc("kalp debisi ve lentor", "tidal volüm ve lentor", "vital kapasite ve lentor") + f" Sayı {i}.") for i in range(30)], df.schema)
    n = subjects.with_labels(df, some).count()
    assert ("lentor", "fizyoloji") in subjects.table_vocabulary(df.unionByName(other), subjects.with_labels(df, some), n)


def test_all_rows_make_the_pair_model(spark, dialogues, monkeypatch):
    """The model of a table is of all its rows; fitted over blocks of equal sequences it is that of the rows in memory."""
    monkeypatch.setattr(truncation, "SAMPLE", 12, raising=False)
    told = [(i, u, a) for i, (_, u, a) in enumerate(dialogues[:600])]
    judge = pairs.fit([(u, a) for _, u, a in told])
    want = {(i, d) for i, u, a in told if (d := judge.defect(u, a))}
    got = {(i, d) for i, _, d in rows(pairs.defects(spark.createDataFrame(told, "id long, user string, assistant string")))}
    assert len(want) > 20 and len(want ^ got) <= 0.05 * len(want)


def test_crf_over_blocks(spark):
    xs = [[tuple(bool((i * 7 + j * 3 + d) % 5 == 0) for d in range(pairs.D)) for j in range(1 + i % 4)] for i in range(40)]
    ys = [[(i + j) % pairs.K for j in range(len(x))] for i, x in enumerate(xs)]
    want = pairs.Crf().fit(xs + xs[:9], ys + ys[:9], rounds=3)
    df = spark.createDataFrame([(pairs.packed(x), y, 2 if i < 9 else 1) for i, (x, y) in enumerate(zip(xs, ys))], "x array<int>, y array<int>, count long").repartition(3)
    got = pairs.Crf()
    monkey, pairs.Crf.climb = pairs.Crf.climb, lambda self, g, n: monkey(self, g, n, rounds=3)
    try:
        pairs.climb(got, pairs.blocks(df), 49)
    finally:
        pairs.Crf.climb = monkey
    assert abs(got.w - want.w).max() < 1e-6 and abs(got.t - want.t).max() < 1e-6 and abs(got.s - want.s).max() < 1e-6


def test_gradients_of_few_blocks_take_no_job_each(spark, monkeypatch):
    """What few blocks hold is summed in the driver, with the result of a job a gradient, as many blocks need."""
    xs = [[(i * 7 + j * 3) % 5 + 8 * (i % 3) for j in range(1 + i % 40)] for i in range(90)]
    seen = [(x, [(i + j) % pairs.K for j in range(len(x))], i % 2 == 0, 1 + i % 4) for i, x in enumerate(xs)]
    df = spark.createDataFrame(seen, "x array<int>, y array<int>, own boolean, count long").repartition(3)
    got = pairs.Crf()
    spark.sparkContext.setJobGroup("few blocks", "")
    try:
        pairs.train(got, df)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert abs(got.w).max() > 0.1 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("few blocks")) < 30
    climb, few = pairs.Crf.climb, []
    monkeypatch.setattr(pairs.Crf, "climb", lambda self, g, n: climb(self, g, n, rounds=2))
    for size in (1 << 25, 0):
        monkeypatch.setattr(pairs, "HELD", size, raising=False)
        few.append(pairs.Crf())
        pairs.climb(few[-1], pairs.blocks(df), 90)
    assert abs(few[0].w - few[1].w).max() < 1e-9 and abs(few[0].t - few[1].t).max() < 1e-9
    want = [few[0].likelihood(pairs.unpacked(x), y) for x, y, _, _ in seen]
    assert abs(pairs.likelihoods(few[0], *([r[k] for r in seen] for k in (0, 1))) - want).max() < 1e-9


def test_counting_holds_a_bounded_part(dialogues):
    """A task's memory does not follow its rows; what it passes on in parts is the count of all."""
    told = [(f"{i} {u}", f"{a} {i * 7919}") for i, (_, u, a) in enumerate(dialogues[:900] * 3)]
    wanted = np.full(1 << (overlap.FILTER_BITS - 3), 255, np.uint8)
    tracemalloc.start()
    parts, peak = [], 0
    for got in truncation.summed_parts(iter(told), wanted):
        peak = max(peak, tracemalloc.get_traced_memory()[1])
        parts.append(tuple(c.copy() for c in got))
        del got
        tracemalloc.reset_peak()
    tracemalloc.stop()
    assert len(parts) > 1 and peak < 350e6
    want = truncation.merged([c for r in truncation.parts(told, 20_000) for c in [truncation.tally(r)]])
    assert all((a == b).all() for a, b in zip(truncation.merged(parts), want))
    # with a bitmap, all that is asked for is counted
    asked = {("word", "kalp debisi"), ("sentence", "kalp debisi"), ("word", "hangisi"), ("stop", "doğrudur?")}
    keys = np.array([k for kind, context in sorted(asked) for k in truncation.context_keys(kind, context)], np.int64)
    few = np.zeros_like(wanted)
    for k in keys.astype(np.uint64) & np.uint64((1 << overlap.FILTER_BITS) - 1):
        few[int(k) >> 3] |= 1 << (int(k) & 7)
    got = truncation.merged(list(truncation.summed_parts(iter(told), few)))
    (a, b), (c, d) = ((x[0], np.isin(x[0], keys)) for x in (got, want))
    assert all((x[b] == y[d]).all() for x, y in zip(got, want)) and d.sum() > 8


def test_faster_patterns_find_the_same():
    told = [chr(c) for c in range(0x3000)] + ["ve", "ve ve-ve", "İLE", "bır", "BU", "Bu,bu", "olara\u212a", "olara", "vex", "xve", "\nve", " bir.", "bu_", "", "x" * 500 + "bu" * 9]
    told += ["x" * n + " " + t for t in told for n in (33, 36, 38, 77)]
    assert [t for t in told if (len(truncation.TURKISH.findall(t[-400:])) * 40 >= min(400, len(t))) != (truncation.language(t) == "tr")] == []
    for text, want in [("A) x (B) y", [("A", "x "), ("B", "y")]), ("(a) x", [("A", "x")]), ("xA) y", []), ("((C) x", [("C", "x")]), ("d(D) x", [("D", "x")]), ("A - x\nB. y", [("A", "x\n"), ("B", "y")])]:
        assert truncation.option_spans(text)[1] == want


def test_known_clauses_are_those_read(dialogues):
    """Training responses made of clauses that are known are not read again; what is known of them is what reading finds."""
    pieces = ["Kalp debisi artar.", "Soru: Nedir?", '"Zar geçirgenliği" değişir."', "Merhaba.", "• sternum", "<b>Önemli</b> olan budur.", "Cevap: A", "has-\nta gelir!", "— ", "Böbrek (sağ) büyür…)", "\r\n", "A) Ön yük B) Ard yük.", "debi:", "  ", "Açıklama:"]
    rng = random.Random(5)
    odd = ["".join(rng.choice(pieces) + rng.choice([" ", "\n", "  ", ""]) for _ in range(rng.randrange(1, 12))) for _ in range(1500)]
    told = [(u, a) for _, u, a in dialogues if u and a][:400] + [(rng.choice(odd), frame(t) if i % 2 else t) for i, t in enumerate(odd)]
    pool = ["The preload is often seen.", "None of these (or all) explain it!", "Man findet es,", '"It was said."', "  The end."]
    seen = known = 0
    for i, (u, a) in enumerate(told):
        body = truncation.explanation(a)[0]
        read = pairs.without_answer(body)
        own = pairs.clauses(read) if pairs.stripped(a, read) else None
        assert own is None or own == pairs.clauses(body.strip())
        asked = pairs.Question(u)
        for lesson in pairs.taught(asked, a, pool if i % 3 else [], np.random.default_rng(i), own):
            if i < 400:
                seen, known = seen + 1, known + (lesson.parts is not None)
            want = pairs.clauses(pairs.without_answer(truncation.explanation(lesson.response)[0]))
            assert lesson.parts is None or lesson.parts == want, lesson
            if lesson.last == 4 and not truncation.may_have_options(body):
                assert not truncation.option_spans(truncation.explanation(lesson.response)[0])[1]
    assert known > 0.4 * seen


def test_clauses_are_split_and_read_together_as_one_by_one(dialogues):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "İ", "?", ".", "…", '"', ")", " ", "\n", "\r", "\t", "\xa0", "_", "1", "~"]) for _ in range(rng.randrange(14))) for _ in range(20_000)]
    texts += [t for _, u, a in dialogues[:300] for t in (u, a) if t]
    assert [t for t in texts if pairs.broken(t) != [c for c in pairs.BREAK.split(t) if c]] == []
    assert [t for t in texts if "\n" not in t and pairs.ended(t) != bool(pairs.END.search(t))] == []
    told = list(dict.fromkeys(c for t in texts for c in pairs.clauses(t))) + ["Üzgünüm, yapamam", "meyecağim", "as a ai", "lütfen danişin", "The sorry of the end is", "x" * 99]
    odds = pairs.Trigrams(pairs.Trigrams.counted(texts), pairs.Trigrams.counted(["the end of it", "a b"]))
    vocabulary = frozenset(w for t in told[::3] for w in pairs.words(t))
    got = pairs.read_clauses(told, vocabulary, odds)
    assert got == [pairs.read_clauses([t], vocabulary, odds)[0] for t in told]
    for t, c in zip(told, got):
        folded = pairs.fold(t)
        w = pairs.WORD.findall(folded)
        turkish = sum(x in pairs.TURKISH_WORDS for x in w) + sum(x in "ğışİĞŞ" for x in t)
        foreign, known, n = sum(x in pairs.FOREIGN_WORDS for x in w), sum(x in vocabulary for x in w), max(1, len(w))
        want = {"bias": True, "foreign>=2": foreign >= 2, "foreign>=4": foreign >= 4, "no turkish": turkish == 0, "turkish": turkish >= 2, "vocabulary>=0.5": known / n >= 0.5, "vocabulary<0.2": known / n < 0.2}
        want |= {"short": n <= 3, "refusal": bool(pairs.REFUSAL.search(folded)), "advice": bool(pairs.ADVICE.search(folded)), "trigrams foreign": odds(w) > 0.3, "trigrams turkish": odds(w) < -0.3}
        assert c.words == w and c.bits == sum(pairs.AT[k] for k, on in want.items() if on), t
        assert (c.declines, c.advises) == tuple(any(p in folded for p in parts) for parts in (pairs.REFUSAL_PARTS, pairs.ADVICE_PARTS))


def test_trigrams_are_counted_by_word():
    texts = ["Kalp debisi a b", "", "— ", "x", "Kalp kalp"]
    want = {}
    for t in texts:
        bare = f" {' '.join(pairs.words(t))} "
        for i in range(len(bare) - 2):
            g = bare[i : i + 3]
            key = pairs.BETWEEN if g[1] == " " else g
            want[key] = want.get(key, 0) + 1
    assert pairs.Trigrams.counted(texts) == want

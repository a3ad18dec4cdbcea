"""The registry's queries as SQL for another engine over the same tables.

Building blocks are Python functions that return SQL expressions; each ORACLE entry is one statement.
"""

from __future__ import annotations

LOWER = "a-zçğıöşü"
LETTER = "A-Za-zÇĞİÖŞÜçğıöşü"
MONTHS = "Ocak|Şubat|Mart|Nisan|Mayıs|Haziran|Temmuz|Ağustos|Eylül|Ekim|Kasım|Aralık"


def content(role: str) -> str:
    return f"list_filter(messages, lambda m: m.role = '{role}')[1].content"


def low(x: str) -> str:
    return f"lower(replace({x}, 'İ', 'i'))"


def sub(x: str, pattern: str, new: str = "", flags: str = "g") -> str:
    p = pattern.replace("'", "''")
    return f"regexp_replace({x}, '{p}', '{new}'" + (f", '{flags}')" if flags else ")")


def key(x: str) -> str:
    t = sub(low(x), r"^[ \t\r\n\f]*[0-9]{1,3}[ \t\r\n\f]*[.)][ \t\r\n\f]*", "", "")
    return sub(sub(t, r"\([^)]*[0-9]{4}\)"), f"[^{LOWER}0-9]+")


def key_id(x: str) -> str:
    return f"substring(sha256({key(x)}), 1, 16)"


def squeezed(x: str) -> str:
    return f"trim({sub(x, '[ ' + chr(92) + 't' + chr(92) + 'r' + chr(92) + 'n' + chr(92) + 'f' + chr(0xA0) + ']+', ' ')})"


def content_hash(x: str) -> str:
    return f"md5({low(squeezed(x))})"


FRAME = r"(?s)<think>\n?(.*?)\n?</think>[ \t\r\n]*Doğru cevap:[ \t]*([A-E])[ \t\r\n]*$"


def told(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{FRAME}') THEN regexp_extract({x}, '{FRAME}', 1) END"


def letter(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{FRAME}') THEN regexp_extract({x}, '{FRAME}', 2) END"


def tokens(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), '[{LETTER}]{{2,}}')"


def abbreviation(w: str) -> str:
    return f"((length({w}) <= 5 AND {w} = upper(translate({w}, 'iı', 'İI'))) OR (length({w}) <= 4 AND regexp_matches({w}, '^[A-ZÇĞİÖŞÜ].*[A-ZÇĞİÖŞÜ]')) OR lower({w}) IN ('spp','sp','ssp','var','cf','ml','mg','kg'))"


def share(part: str, whole: str) -> str:
    return f"CASE WHEN len({whole}) = 0 THEN 0.0::DOUBLE ELSE len({part})::DOUBLE / len({whole}) END"


def vowelless(x: str) -> str:
    w = f"list_filter({tokens(x)}, lambda t: NOT {abbreviation('t')})"
    return share(f"list_filter({w}, lambda t: NOT regexp_matches(t, '[aeıioöuüAEIİOÖUÜ]') OR regexp_matches(t, '[bcçdfgğhjklmnprsştvyzBCÇDFGĞHJKLMNPRSŞTVYZ]{{5}}'))", w)


def turkish(x: str) -> str:
    return share(f"list_filter({tokens(x)}, lambda t: regexp_matches(t, '[ıİğĞşŞçÇöÖüÜ]'))", tokens(x))


def syllables(x: str) -> str:
    t = sub(f"coalesce({x}, '')", r"(^|[ \t\r\n])\(?[A-Ea-e][ \t\r\n]*[).]", " ")
    t = sub(t, f"(^|[^{LETTER}0-9_])[A-Za-z]{{1,4}}[-–]?[0-9]+", r"\1 ")
    w = f"list_filter({tokens(t)}, lambda v: NOT {abbreviation('v')})"
    return f"CASE WHEN len({w}) < 15 THEN 0.0::DOUBLE ELSE {share(f'list_filter({w}, lambda v: length(v) <= 3)', w)} END"


def stem(x: str) -> str:
    return sub(x, r"(?s)(^|[ \t\r\n])\(?[A-Ea-e][ \t\r\n]*[).][ \t\r\n].*$", "", "")


STOP = (
    "veya için gibi olarak olan olur oldu daha ancak fakat yani hangi hangisi aşağıdakilerden aşağıdaki değildir yanlış doğru nedir kaçtır göre sonra önce arasında içinde üzerine karşı "
    "hasta hastada hastanın tanı tedavi görülür yapılır bulunur olabilir edilir"
).split()


def topics(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOP)
    return f"list_distinct(list_transform(list_filter(regexp_extract_all({low(f'coalesce({x}, {chr(39) * 2})')}, '[{LOWER}]{{4,}}'), lambda t: t NOT IN ({stop})), lambda t: substring(t, 1, 6)))"


def overlap(q: str, t: str) -> str:
    a = topics(stem(q))
    return f"CASE WHEN len({a}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {topics(t)}))::DOUBLE / len({a}) END"


def option_letters(x: str) -> str:
    return f"len(list_distinct(list_transform(regexp_extract_all(coalesce({x}, ''), '(?:^|[ \\t\\r\\n])\\(?([A-Ea-e])[ \\t\\r\\n]*[).]', 1), lambda t: upper(t))))"


def problem_set(x: str) -> str:
    return f"list_sort(list_transform({x}, lambda p: split_part(p, '(', 1)))"


BOILER = r"(?i)K[İI]TAP[ÇC]I[ĞG]I|DENEME[ \t]*SINAVI|Önce[ \t]*TUS|ABONE[ \t]*OL|Bedava[ \t]*Haz[ıi]rl[ıi]k|www\.|http|Yar[ıi]şmalar,[ \t]*Deneme|SORU[ \t]*VE[ \t]*A[ÇC]IKLAMALARI|T[ıi]pta[ \t]*Uzmanl[ıi]k[ \t]*S[ıi]nav[ıi]na"
SFT = f"(SELECT kayit_no, id, {content('user')} AS soru, {content('assistant')} AS icerik, meta.source_pdf AS source_pdf, meta.grup AS grup FROM sft_record)"
KEYED = f"(SELECT *, {key_id('soru')} AS anahtar_id FROM {SFT} WHERE soru IS NOT NULL)"
FLAGGED = f"(SELECT *, {key_id('soru')} AS anahtar_id FROM flagged_record)"
HELD = f"(SELECT *, {key_id('soru')} AS anahtar_id FROM eval_record)"
LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(zaman, '') DESC, kayit_no DESC) AS r FROM decision) WHERE r = 1)"
FIRST_FLAGGED = "(SELECT id, arg_min({'soru': soru, 'aciklama': aciklama, 'cevap': cevap}, kayit_no) AS f FROM flagged_record GROUP BY id)"
REPAIRED = f"""(SELECT q.kayit_no, q.id, 'aciklama_yazildi' || CASE WHEN coalesce(q.soru, '') <> '' THEN '+ocr_duzeltildi' ELSE '' END
    || CASE WHEN q.cevap IS NOT DISTINCT FROM g.f.cevap THEN '' ELSE '+anahtar_duzeltildi' END AS tur, coalesce(q.soru, '') <> '' AS soru_degistirildi,
    {key_id('g.f.soru')} AS anahtar_id, md5('<think>' || chr(10) || q.gerekce || chr(10) || '</think>' || chr(10) || chr(10) || 'Doğru cevap: ' || q.cevap) AS icerik_ozeti
    FROM repair_request q JOIN {FIRST_FLAGGED} g ON q.id = g.id)"""
LONGEST = "arg_max(kayit_no, {'n': length(icerik), 'k': -kayit_no}) AS kayit_no, count(*) AS copies, coalesce(array_to_string(list_sort(list(DISTINCT source_pdf) FILTER (source_pdf IS NOT NULL)), ','), '') AS sources"
CANDIDATES = f"""(SELECT f.kayit_no, f.anahtar_id, CASE WHEN len(f.meta.cevap_adaylari) > 1 THEN 'coklu_anahtar'
    WHEN f.anahtar_id IN (SELECT anahtar_id FROM {KEYED}) THEN 'sft_sizintisi' WHEN f.anahtar_id IN (SELECT anahtar_id FROM {REPAIRED}) THEN 'elle_onarildi' END AS sebep
    FROM {FLAGGED} f WHERE array_to_string({problem_set('f.sorunlar')}, ',') = 'aciklama_kisa' AND coalesce(f.cevap, '') <> '')"""


def unpivot(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS alan, count({c}) AS n FROM {source}" for c in columns)


def html_table(x: str) -> str:
    t = sub(x, r"<[ \t]*/?[ \t]*(?:thead|tbody|table)[ \t]*>", "\n", "gi")
    t = sub(t, r"<[ \t]*/[ \t]*tr[ \t]*>", "\n", "gi")
    t = sub(t, r"<[ \t]*/[ \t]*t[dh][ \t]*>", " | ", "gi")
    t = sub(sub(t, r"<[^>]{0,80}>", " "), r"[ \t\r\f]*\|[ \t\r\f]*\n", "\n")
    return sub(t, r"[ \t]{2,}", " ")


def nearest(shares: list[float], source: str | None = None) -> str:
    sorted_ = source or "(SELECT n_chars AS v, row_number() OVER (ORDER BY n_chars) AS r, count(*) OVER () AS n FROM documents WHERE n_chars IS NOT NULL)"
    return " UNION ALL ".join(f"SELECT {s}::DOUBLE AS pay, v AS deger FROM {sorted_} WHERE r = CASE WHEN floor(n * {s}::DOUBLE) < 1 THEN n ELSE floor(n * {s}::DOUBLE) END" for s in shares)


SUBJECT = "CASE " + " ".join(
    f"WHEN regexp_matches({low('source_pdf')}, '{p}') THEN '{n}'"
    for p, n in (
        ("anatomi", "Anatomi"), ("biyokimya", "Biyokimya"), ("dahil", "Dahiliye"), ("farmakoloji", "Farmakoloji"), ("fizyoloji|histoloji|embriyoloji", "Fizyoloji-Histoloji-Embriyoloji"),
        ("cerrahi", "Genel Cerrahi"), ("kad[ıi]n", "Kadın Doğum"), ("sta[jl]", "Küçük Stajlar"), ("mikrobiyoloji", "Mikrobiyoloji"), ("patoloji", "Patoloji"), ("pediatri", "Pediatri"),
    )
) + " ELSE '?' END"
PARA = "list_filter(string_split({x}, chr(10)), lambda s: trim(s) <> '')"
REASONS = "'soru_bozuk','gorsel_gerekli','cevap_supheli','eksik_bilgi','sik_kayip','baglam_gerekli','tekrar','diger'"
STRICT = r"(?s)^<think>\n(.+)\n</think>\n\nDoğru cevap: ([A-E])$"


def findings() -> str:
    """Validator: one row per record with what its checks need."""
    rows = "list_filter(string_split(u, chr(10)), lambda s: regexp_matches(s, '^[A-E]\\) .'))"
    return f"""(SELECT *, ord AND framed AND u IS NOT NULL AS ok FROM (SELECT row, id, u, a, rows, list_transform(rows, lambda s: substring(s, 1, 1)) AS letters,
        list_transform(rows, lambda s: lower(trim(regexp_replace(s, '^[A-E]\\) ', '')))) AS texts,
        coalesce(roles = ['user', 'assistant'], false) AS ord, coalesce(regexp_matches(a, '{STRICT}'), false) AS framed,
        regexp_extract(a, '{STRICT}', 1) AS told, regexp_extract(a, '{STRICT}', 2) AS letter,
        CASE WHEN instr(u, chr(10) || 'A) ') > 0 THEN substring(u, 1, instr(u, chr(10) || 'A) ') - 1) ELSE '' END AS stem
        FROM (SELECT kayit_no AS row, id, {content('user')} AS u, {content('assistant')} AS a, list_transform(messages, lambda m: m.role) AS roles, list_filter(string_split({content('user')}, chr(10)), lambda s: regexp_matches(s, '^[A-E]\\) .')) AS rows FROM sft_record)))"""


def report() -> str:
    f = findings()
    size, signs = f"length(regexp_replace(told, '[^{LETTER}]', '', 'g'))", "length(regexp_replace(told, '[^çğıöşüÇĞİÖŞÜ]', '', 'g'))"
    tests = [
        ("hata", "rol", "NOT ord"), ("hata", "cevap_bicimi", "ord AND NOT framed"), ("hata", "bos_sik", "ok AND len(list_filter(texts, lambda x: regexp_matches(x, '^\\s*$'))) > 0"), ("hata", "sik_harfleri", "ok AND NOT (letters = ['A','B','C','D','E'] OR letters = ['A','B','C','D'])"),
        ("hata", "cevap_siklarda_yok", "ok AND NOT list_contains(letters, letter)"), ("hata", "govde_yok", "ok AND length(trim(stem)) < 10"),
        ("hata", "latex", r"ok AND regexp_matches(u || told, '\$[^$]{1,80}\$|\\(?:math|frac|left|right)')"), ("hata", "html", "ok AND regexp_matches(u || told, '&(?:#x?[0-9a-fA-F]+|amp|lt|gt|quot|nbsp);')"),
        ("hata", "aciklama_cok_kisa", "ok AND length(told) < 40"), ("uyari", "ayni_sik_metni", "ok AND len(list_distinct(texts)) < len(texts)"), ("uyari", "aciklamada_dogru_cevap", "ok AND contains(told, 'Doğru cevap')"),
        ("uyari", "aciklama_4000+", "ok AND length(told) > 4000"), ("uyari", "turkce_karakter_az", f"ok AND {size} > 200 AND {signs} < 0.02 * {size}"),
    ]
    parts = [f"SELECT '{t}' AS tur, '{k}' AS kod, count(*) AS n FROM f WHERE {c}" for t, k, c in tests]
    parts.append("SELECT 'hata', 'tekrar_id', count(*) FROM (SELECT id FROM f GROUP BY id HAVING count(*) > 1)")
    parts.append(f"SELECT 'uyari', 'tekrar_soru', count(*) FROM (SELECT {content_hash('u')} AS k FROM f GROUP BY k HAVING count(*) > 1)")
    parts.append(f"SELECT 'hata', 'eval_sizintisi', count(*) FROM eval_record WHERE {content_hash('soru')} IN (SELECT {content_hash('u')} FROM f)")
    wide = lambda x: f"regexp_extract_all(lower(replace(replace({x}, 'İ', 'i'), 'I', 'ı')), '[{LETTER}âîû]{{3,}}')"
    for column, limit, code in (("told", 0.2, "aciklama_bozuk>0.2"), ("stem", 0.15, "govde_bozuk>0.15")):
        words = f"(SELECT row, unnest({wide(column)}) AS w FROM f WHERE ok)"
        parts.append(f"SELECT 'uyari', '{code}', count(*) FROM (SELECT row FROM {words} GROUP BY row HAVING count(*) FILTER (w NOT IN (SELECT w FROM known))::DOUBLE / count(*) > {limit})")
    known = f"(SELECT w FROM (SELECT unnest({wide('concat_ws(chr(10), u, a)')}) AS w FROM f) GROUP BY w HAVING count(*) >= 5)"
    return f"WITH f AS {f}, known AS {known} SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n > 0"


FIGURE = (
    r"(?i)şekilde|şekildeki|resimde|resimdeki|grafikte|grafikteki|görüntüde|fotoğrafta|ok[ \t]*işareti[ \t]*ile|okla[ \t]*gösterilen|yukarıdaki[ \t]*şekil|aşağıdaki[ \t]*şekil|preparatta[ \t]*görülen"
    r"|(?:elektrokardiyogram|EKG|elektrokardiyografi|dalga)[ \t]*\(?[^)\n]{0,24}\)?[ \t]*trase|aşağıdaki[ \t]*elektrokardiyografi|aşağıdaki[ \t]*(?:resim|fotoğraf|şema|çizim)"
    r"|(?:radyografi|grafi|tomografi|preparat)(?:si|sı)[ \t]*aşağıda(?:ki|da)?[ \t]*(?:gibi|verilmiş|gösteril)"
)
EARLIER = (
    r"(?i)yukarıdaki[ \t]*\(?[ \t]*[0-9]{1,3}|bir[ \t]*önceki[ \t]*soru|önceki[ \t]*soruda|yukarıdaki[ \t]*soruda|yukarıdaki[ \t]*olgu"
    r"|[0-9]{1,3}[ \t]*\.?[ \t]*soruda[ \t]*(?:tanımlanan|anlatılan|verilen|belirtilen)|yukarıda[ \t]*(?:tanımlanan|anlatılan|verilen)[ \t]*hasta"
)
COMMENT = r"(?i)(?:^|[^\p{L}0-9_])(?:kolay|zor|klasik|spot|temel bilgi|sınav|soru(?:su|dur|lardan)|kurtarıcı|vazgeçilmez|çeldirici|hatırlat|dikkat edin|bilmek yeterli)(?:$|[^\p{L}0-9_])"


def gate_list(q: str, options: str, explanation: str, answer: str, candidates: str) -> str:
    """The list of gate codes that a record fails, as a SQL expression."""
    t = f"coalesce({explanation}, '')"
    keys = f"list_sort(list_distinct(coalesce({candidates}, [])))"
    sentences = f"list_filter(regexp_split_to_array({t}, '[.!]|\\n'), lambda s: trim(s) <> '')"
    comment = f"(length({t}) >= 40 AND len({sentences}) > 0 AND len(list_filter({sentences}, lambda s: NOT (length(s) <= 250 AND regexp_matches(s, '{COMMENT}')))) = 0)"
    torn = syllables(f"{q} || ' ' || {t}")
    tests = [
        ("'cevap_yok'", f"coalesce({answer}, '') = ''"), (f"'coklu_anahtar(' || array_to_string({keys}, '') || ')'", f"len({keys}) > 1"), ("'sekle_bagli'", f"regexp_matches({q}, '{FIGURE}')"),
        ("'onceki_soruya_bagimli'", f"regexp_matches({q}, '{EARLIER}')"), ("'tablo_kalintisi'", f"len(list_filter(string_split({t}, chr(10)), lambda s: regexp_matches(s, '\\|.*\\|.*\\|'))) >= 2"),
        ("'sik_eksik'", f"{option_letters(options)} < 3"), ("'soru_kisa'", f"length({q}) < 40"), ("'ocr_bozuk'", f"round({vowelless(f'{q} || {t}')}, 3) > 0.12"), ("'aciklama_kisa'", f"length({t}) < 40"),
        ("'iceriksiz_gerekce'", comment), ("'yarim_gerekce'", f"length({t}) >= 40 AND NOT {comment} AND regexp_matches(trim({t}), '[:;,\\-–—][ \\t\\r\\n]*$') AND length({t}) < 200"),
        (f"'hece_bolunmesi(' || printf('%.2f', {torn}) || ')'", f"{torn} > 0.40"),
    ]
    items = ", ".join(f"CASE WHEN {c} THEN {k} END" for k, c in tests)
    return f"list_filter([{items}], lambda c: c IS NOT NULL)"


def gates() -> str:
    return f"SELECT kayit_no, array_to_string({gate_list('soru', 'siklar', 'aciklama', 'cevap', 'meta.cevap_adaylari')}, ',') AS sorunlar FROM flagged_record"


def gated() -> str:
    rows = f"(SELECT kayit_no, soru, icerik, source_pdf, {told('icerik')} AS t, {letter('icerik')} AS harf, adaylar FROM (SELECT kayit_no, {content('user')} AS soru, {content('assistant')} AS icerik, meta.source_pdf AS source_pdf, meta.cevap_adaylari AS adaylar FROM sft_record) WHERE soru IS NOT NULL)"
    return f"(SELECT kayit_no, {key_id('soru')} AS anahtar_id, icerik, source_pdf, harf FROM {rows} WHERE len({gate_list('soru', 'soru', 't', 'harf', 'adaylar')}) = 0)"


THOUGHT = r"coalesce(regexp_extract(icerik, '(?s)<think>\n?(.*?)\n?</think>', 1), '')"


def contamination() -> str:
    letters = r"len(list_distinct(list_transform(regexp_extract_all(t, '(?:^|[ \t\r\n])\(?([A-Ea-e])[ \t\r\n]*[).][ \t\r\n]+[^ \t\r\n]', 1), lambda x: upper(x))))"
    tests = [
        ("yeni_soru_basligi", r"regexp_matches(t, '(?:^|\n)[ \t\r\n]*[0-9]{1,3}[ \t]*[.)][ \t\r\n]*[A-ZÇĞİÖŞÜ]')"), ("sik_blogu", f"{letters} >= 4"),
        ("cevap_satiri", r"regexp_matches(t, '(?i)(?:do[ğg]ru[ \t]*)?cevap[ \t]*[:\-–—]?[ \t]*[A-Ea-e](?:$|[^a-zA-ZçğıöşüÇĞİÖŞÜ0-9_])')"), ("soru_etiketi", r"regexp_matches(t, '(?i)(?:^|[^A-Za-z])SORU[ \t]*[0-9]{1,3}(?:[^0-9]|$)')"),
        ("kitapcik_metni", r"regexp_matches(t, '(?i)K[İI]TAP[ÇC]I[ĞG]I|DENEME SINAVI|Önce TUS|ABONE OL|www\.|Bedava')"), ("dusuk_ortusme", f"{overlap('soru', 't')} < 0.10"),
    ]
    items = ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in tests)
    rec = f"(SELECT coalesce(soru, '') AS soru, {THOUGHT} AS t FROM {SFT})"
    flags = f"(SELECT t, list_filter([{items}], lambda c: c IS NOT NULL) AS f FROM {rec})"
    return f"""SELECT bayrak, count(*) AS n FROM (SELECT unnest(CASE WHEN NOT regexp_matches(t, '[^ \t\r\n]') THEN ['aciklama_bos'] WHEN len(f) = 0 THEN ['temiz'] ELSE list_append(f, 'bayrak_sayisi_' || len(f)) END) AS bayrak
        FROM {flags}) GROUP BY bayrak"""


def patches() -> str:
    para = PARA.format(x="f.aciklama")
    w = "d.aciklama_paragraf"
    lo = f"CASE WHEN contains({w}, '-') THEN coalesce(TRY_CAST(regexp_extract({w}, '^([0-9]+)-', 1) AS INT), 0) ELSE 0 END"
    hi = f"coalesce(CASE WHEN contains({w}, '-') THEN TRY_CAST(regexp_extract({w}, '-([0-9]+)$', 1) AS INT) + 1 ELSE TRY_CAST({w} AS INT) END, len({para}))"
    sliced = f"CASE WHEN {w} IS NULL THEN f.aciklama ELSE array_to_string(list_slice({para}, {lo} + 1, {hi}), chr(10)) END"
    lines = "list_filter(string_split(f.siklar, chr(10)), lambda x: regexp_matches(x, '^[A-E]\\) .'))"
    own = f"array_to_string(list_transform({lines}, lambda x: substring(x, 1, 1) || ') ' || trim(substring(x, 3))), chr(10))"
    both = f"(SELECT kayit_no, id, soru, siklar, aciklama, cevap FROM flagged_record UNION ALL SELECT kayit_no, id, soru, soru, {told('icerik')}, {letter('icerik')} FROM {SFT})"
    first = f"(SELECT id, arg_min({{'soru': soru, 'siklar': siklar, 'aciklama': aciklama, 'cevap': cevap}}, kayit_no) AS f FROM {both} GROUP BY id)"
    options = "array_to_string(list_transform(list_sort(map_keys(d.siklar)), lambda k: k || ') ' || d.siklar[k]), chr(10))"
    at, flat, mark = "instr(s, d.aciklama_kes)", squeezed("s"), squeezed("d.aciklama_kes")
    cut = f"CASE WHEN d.aciklama_kes IS NULL THEN s WHEN {at} > 0 THEN regexp_replace(substring(s, 1, {at} - 1), '[ \\t\\r\\n]+$', '') WHEN instr({flat}, {mark}) > 0 THEN rtrim(substring({flat}, 1, instr({flat}, {mark}) - 1)) END"
    return f"""WITH f AS (SELECT id, f.soru AS soru, f.aciklama AS aciklama, f.cevap AS cevap, f.siklar AS siklar, {stem('f.soru')} AS govde FROM {first}),
        j AS (SELECT f.*, d, {sliced} AS s FROM f JOIN (SELECT * FROM {LATEST} WHERE karar = 'duzelt') d ON f.id = d.id)
        SELECT id, CASE WHEN bad THEN soru ELSE coalesce(d.soru, CASE WHEN d.siklar IS NOT NULL THEN trim(coalesce(d.govde, govde)) || chr(10) || {options} WHEN d.govde IS NOT NULL THEN trim(d.govde) || chr(10) || coalesce(o, '') ELSE soru END) END AS soru,
        CASE WHEN bad THEN aciklama ELSE coalesce(d.aciklama, c, s) END AS aciklama, CASE WHEN bad THEN cevap ELSE coalesce(d.cevap, cevap) END AS cevap,
        CASE WHEN bad THEN 'sik_cevapsiz' WHEN d.aciklama_kes IS NOT NULL AND c IS NULL THEN 'kes_bulunamadi' END AS hata
        FROM (SELECT *, d.siklar IS NOT NULL AND d.cevap IS NULL AS bad, {cut} AS c FROM (SELECT *, {own.replace('f.siklar', 'siklar')} AS o FROM j))"""


DROPPED = f"(SELECT x.anahtar_id, coalesce(l.neden IN ('cevap_supheli', 'tibbi'), false) AS itiraz FROM {FLAGGED} x JOIN (SELECT * FROM {LATEST} WHERE karar = 'at') l ON x.id = l.id)"
def pool() -> str:
    """Flagged records worth repairing, by problem."""
    q, e = squeezed("'1. ' || soru"), squeezed("coalesce(aciklama, '')")
    asking = "hangisi|hangileri|nedir|kaçtir|değildir|yanliş|doğru olan|beklenmez|görülmez|söylenebilir|düşünülür|uygundur|seçiniz|işaretleyiniz"
    keys = "[0-9]{1,2}[ \\t]*[-–][ \\t]*[A-E](?:[ \\t]*,[ \\t]*[0-9]{1,2}[ \\t]*[-–][ \\t]*[A-E]){2,}"
    good = f"regexp_matches(lower(translate({stem('q')}, 'Iİı', 'iii')), '{asking}') AND NOT regexp_matches(e, '{keys}') AND NOT regexp_matches(q, '{keys}') AND {option_letters('e')} < 4 AND {option_letters('q')} >= 4"
    p = problem_set("sorunlar")
    done = f"SELECT anahtar_id FROM {REPAIRED} WHERE anahtar_id IS NOT NULL UNION ALL SELECT anahtar_id FROM {HELD} WHERE anahtar_id IS NOT NULL UNION ALL SELECT anahtar_id FROM {FLAGGED} WHERE id IN (SELECT id FROM {LATEST} WHERE karar = 'at')"
    kind = f"CASE WHEN array_to_string({p}, ',') = 'cevap_yok' THEN 'cevap_yok' WHEN array_to_string({p}, ',') = 'aciklama_kisa' THEN 'aciklama_kisa' WHEN list_contains({p}, 'celiskili_cevap') THEN 'celiskili' WHEN list_contains({p}, 'coklu_anahtar') THEN 'coklu_anahtar' END"
    return f"SELECT kayit_no, havuz FROM (SELECT kayit_no, anahtar_id, {kind} AS havuz, {q} AS q, {e} AS e FROM {FLAGGED}) WHERE havuz IS NOT NULL AND {good} AND anahtar_id NOT IN ({done})"


def audit() -> str:
    """Answer audit: both lookups over all texts of the source, answer lines up to the next heading."""
    blank = "[ \\t\\r\\n\\f\\v\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{3000}]+"
    asked = f"(SELECT kayit_no, source_pdf AS source, {letter('icerik')} AS letter, trim(regexp_replace(regexp_extract(soru, '^([^\\n]*)', 1), '{blank}', ' ', 'g')) AS line FROM {SFT} WHERE soru IS NOT NULL)"
    heading = "regexp_extract(substring(win, 40), '(\\n\\s*[0-9]{1,3}\\s*[.)]\\s+\\S)', 1)"
    row = "(?m)^\\s*#?\\s*(?:Doğru\\s+)?[CcĞğ]?[Ee]vap\\s*[:.]?\\s*([A-Ea-e])\\s*[.)]?\\s*$"
    return f"""WITH q AS {asked}, p AS (SELECT DISTINCT source, line, k, CASE k WHEN 0 THEN substring(line, 1, 60) ELSE array_to_string(list_slice(string_split(line, ' '), 2, 9), ' ') END AS pattern FROM q, (VALUES (0), (1)) v(k) WHERE source IS NOT NULL),
        hit AS (SELECT p.source, p.line, p.k, substring(d.text, instr(d.text, p.pattern), 1800) AS win, row_number() OVER (PARTITION BY p.source, p.line ORDER BY p.k, md5(d.text)) AS r
            FROM p JOIN documents d ON d.source = p.source AND contains(d.text, p.pattern) WHERE p.pattern <> ''),
        cut AS (SELECT source, line, CASE WHEN h <> '' THEN substring(win, 1, 39 + instr(substring(win, 40), h)) ELSE win END AS win FROM (SELECT *, {heading} AS h FROM hit WHERE r = 1)),
        found AS (SELECT source, line, list_transform(regexp_extract_all(win, '{row}', 1), lambda x: upper(x)) AS l FROM cut),
        one AS (SELECT source, line, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '') AS keys FROM found)
        SELECT kayit_no, CASE WHEN q.source IS NULL THEN 'META_YOK' WHEN q.source NOT IN (SELECT source FROM documents WHERE source IS NOT NULL AND text IS NOT NULL) THEN 'KAYNAK_YOK' WHEN keys IS NULL THEN 'BULUNAMADI'
            WHEN length(keys) = 0 THEN 'ANAHTAR_YOK' WHEN length(keys) > 1 THEN 'COKLU_ANAHTAR' ELSE 'TEK' END AS durum, keys AS kaynak, coalesce(length(keys) = 1 AND keys <> q.letter, false) AS farkli
        FROM q LEFT JOIN one ON q.source = one.source AND q.line = one.line"""


SETS = {
    "egitim": KEYED, "eval": f"(SELECT * FROM {HELD} WHERE ayrim = 'tus_mcq_eval')", "eval_aciklamali": f"(SELECT * FROM {HELD} WHERE ayrim = 'tus_mcq_eval_aciklamali')", "eval_sinama": f"(SELECT * FROM {HELD} WHERE ayrim = 'tus_mcq_sinama')",
    "onarilmis": REPAIRED, "itiraz": f"(SELECT * FROM {DROPPED} WHERE itiraz)", "kullanilamaz": f"(SELECT * FROM {DROPPED} WHERE NOT itiraz)", "isaretli": FLAGGED,
}
NAMES = list(SETS)

ORACLE: dict[str, str] = {
    "train_set": f"SELECT anahtar_id, {LONGEST} FROM {gated()} WHERE anahtar_id NOT IN (SELECT anahtar_id FROM {HELD} WHERE anahtar_id IS NOT NULL) GROUP BY anahtar_id",
    "settled_records": f"WITH g AS {gated()} SELECT anahtar_id, {LONGEST} FROM g WHERE anahtar_id NOT IN (SELECT anahtar_id FROM g GROUP BY 1 HAVING count(DISTINCT harf) > 1) GROUP BY anahtar_id",
    "surviving_records": f"""SELECT kayit_no, id FROM (SELECT kayit_no, id, row_number() OVER (PARTITION BY {content_hash('soru')}
        ORDER BY id IN (SELECT id FROM decision) DESC, length(coalesce(icerik, '')) DESC, kayit_no) AS r FROM {SFT} WHERE soru IS NOT NULL) WHERE r = 1 ORDER BY kayit_no""",
    "sample_record": f"SELECT kayit_no, id FROM {SFT} WHERE length(icerik) > 300 AND length(icerik) < 900 AND contains(soru, chr(10) || 'E) ') ORDER BY kayit_no LIMIT 1",
    "exam_chronology": rf"SELECT m || ' ' || y AS sinav, count(*) AS n FROM (SELECT regexp_extract(soru, '\(({MONTHS})[ \t]*([0-9]{{4}})\)', 1) AS m, regexp_extract(soru, '\(({MONTHS})[ \t]*([0-9]{{4}})\)', 2) AS y FROM {SFT}) WHERE m <> '' GROUP BY m, y ORDER BY y, m <> 'Nisan', 1",
    "distinct_keys": " UNION ALL ".join(f"SELECT '{n}' AS kume, count(anahtar_id) AS satir, count(DISTINCT anahtar_id) AS tekil FROM {t}" for n, t in (("egitim", KEYED), ("isaretli", FLAGGED), ("degerlendirme", HELD))),
    "source_shares": f"SELECT source_pdf, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS yuzde, round(100.0::DOUBLE * count(*) / max(count(*)) OVER (), 4) AS en_buyuge FROM {SFT} WHERE source_pdf IS NOT NULL GROUP BY 1",
    "overlap_percentiles": nearest([0.1, 0.25, 0.5], f"(SELECT o AS v, row_number() OVER (ORDER BY o) AS r, count(*) OVER () AS n FROM (SELECT round({overlap('soru', 't')}, 6) AS o FROM (SELECT coalesce(soru, '') AS soru, {THOUGHT} AS t FROM {SFT}) WHERE regexp_matches(t, '[^ \\t\\r\\n]')))"),
    "question_keys": f"SELECT kayit_no, anahtar_id, {content_hash('soru')} AS icerik_ozeti FROM {KEYED}",
    "stale_keys": f"SELECT kayit_no, eski, yeni FROM (SELECT kayit_no, meta.anahtar_id AS eski, {key_id(content('user'))} AS yeni FROM sft_record WHERE {content('user')} IS NOT NULL) WHERE eski IS DISTINCT FROM yeni",
    "duplicates_kept": f"SELECT * FROM (SELECT anahtar_id, {LONGEST} FROM {KEYED} WHERE icerik IS NOT NULL GROUP BY anahtar_id) WHERE copies > 1",
    "contradicting": f"""WITH k AS (SELECT kayit_no, anahtar_id, {letter('icerik')} AS harf FROM {KEYED}), m AS (SELECT anahtar_id, array_to_string(list_sort(list(DISTINCT harf)), '') AS l FROM k WHERE harf IS NOT NULL GROUP BY 1)
        SELECT k.kayit_no, k.anahtar_id, 'celiskili_cevap(' || l || ')' AS sorun FROM k JOIN m USING (anahtar_id) WHERE length(l) > 1""",
    "near_exact_losers": f"""SELECT kayit_no, id, 'tekrar' AS neden FROM (SELECT kayit_no, id, row_number() OVER (PARTITION BY {content_hash('soru')}
        ORDER BY id IN (SELECT id FROM decision) DESC, length(coalesce(icerik, '')) DESC, kayit_no) AS r FROM {SFT} WHERE soru IS NOT NULL) WHERE r > 1""",
    "best_in_document": """SELECT source_pdf, no, arg_max(kayit_no, {'c': (coalesce(cevap, '') <> '')::INT, 'n': length(coalesce(aciklama, '')), 'k': -kayit_no}) AS kayit_no, count(*) AS aday
        FROM (SELECT kayit_no, meta.source_pdf AS source_pdf, meta.question_no AS no, cevap, aciklama FROM flagged_record) WHERE source_pdf IS NOT NULL AND no IS NOT NULL GROUP BY 1, 2""",
    "latest_decisions": f"SELECT id, kayit_no, karar, neden, zaman FROM {LATEST}",
    "decision_errors": f"""SELECT kayit_no, hata FROM (SELECT kayit_no, unnest(list_filter([CASE WHEN NOT coalesce(karar IN ('ok', 'at', 'duzelt'), false) THEN 'karar' END, CASE WHEN karar = 'at' AND NOT coalesce(neden IN ({REASONS}), false) THEN 'neden' END,
        CASE WHEN siklar IS NOT NULL AND cevap IS NULL THEN 'siklar_cevapsiz' END, CASE WHEN NOT regexp_matches(cevap, '^[A-E]$') THEN 'cevap' END,
        CASE WHEN siklar IS NOT NULL AND cevap IS NOT NULL AND NOT list_contains(map_keys(siklar), cevap) THEN 'cevap_siklarda_yok' END,
        CASE WHEN NOT regexp_matches(aciklama_paragraf, '^[0-9]+(-[0-9]*)?$') THEN 'aciklama_paragraf' END, CASE WHEN aciklama_kes IS NOT NULL AND t IS NOT NULL AND NOT contains(t, aciklama_kes) THEN 'aciklama_kes' END], lambda c: c IS NOT NULL)) AS hata
        FROM decision LEFT JOIN (SELECT id AS i, arg_min({told('icerik')}, kayit_no) AS t FROM {SFT} WHERE {told('icerik')} IS NOT NULL GROUP BY id) ON id = i)""",
    "decision_fields": f"WITH d AS (SELECT * FROM {LATEST} WHERE karar = 'duzelt') " + unpivot(["soru", "govde", "siklar", "cevap", "aciklama", "aciklama_kes", "aciklama_paragraf"], "d"),
    "repaired_records": f"SELECT kayit_no, id, tur, soru_degistirildi, anahtar_id, icerik_ozeti FROM {REPAIRED}",
    "repair_kinds": f"SELECT tur, count(*) AS n FROM {REPAIRED} GROUP BY tur",
    "orphan_requests": "SELECT kayit_no, id FROM repair_request WHERE id NOT IN (SELECT id FROM flagged_record WHERE id IS NOT NULL)",
    "eval_candidates": f"SELECT * FROM {CANDIDATES}",
    "eval_chosen": f"SELECT anahtar_id, min(kayit_no) AS kayit_no FROM {CANDIDATES} WHERE sebep IS NULL GROUP BY anahtar_id ORDER BY anahtar_id LIMIT 50",
    "stratified_holdout": f"""WITH k AS (SELECT kayit_no, coalesce(grup, '?') AS grup, anahtar_id || lpad(kayit_no::VARCHAR, 12, '0') AS sira FROM {KEYED}),
        q AS (SELECT grup, greatest(1, round_even(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 0)) AS q, min(sira) AS ilk FROM k GROUP BY grup),
        r AS (SELECT k.*, row_number() OVER (PARTITION BY grup ORDER BY sira) AS r FROM k)
        SELECT kayit_no, grup FROM (SELECT r.kayit_no, r.grup, q.ilk, r.r FROM r JOIN q USING (grup) WHERE r.r <= q.q ORDER BY q.ilk, r.r LIMIT 100)""",
    "final_training": f"""WITH kept AS (SELECT anahtar_id, kayit_no FROM {KEYED} WHERE anahtar_id NOT IN (SELECT anahtar_id FROM {HELD} WHERE anahtar_id IS NOT NULL)),
        gone AS (SELECT anahtar_id FROM {KEYED} WHERE id IN (SELECT id FROM {LATEST} WHERE karar = 'at'))
        SELECT anahtar_id, kayit_no, 'otomatik' AS kaynak FROM kept WHERE anahtar_id NOT IN (SELECT anahtar_id FROM gone)
        UNION ALL SELECT anahtar_id, min(kayit_no), 'onarilmis' FROM {REPAIRED} WHERE anahtar_id NOT IN (SELECT anahtar_id FROM kept) GROUP BY anahtar_id""",
    "leakage_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS sol, '{b}' AS sag, count(DISTINCT anahtar_id) AS ortak FROM {SETS[a]} WHERE anahtar_id IN (SELECT anahtar_id FROM {SETS[b]})" for i, a in enumerate(NAMES) for b in NAMES[i + 1 :]
    ),
    "round_robin_shards": "SELECT kayit_no, ((row_number() OVER (ORDER BY len(sorunlar) DESC NULLS LAST, kayit_no) - 1) % 8 + 1)::INT AS pay FROM flagged_record",
    "shard_progress": "SELECT (kayit_no % 8)::INT AS pay, count(*) FILTER (id IN (SELECT id FROM decision)) AS kararli, count(*) AS toplam FROM flagged_record GROUP BY 1",
    "token_vocabulary": f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all({low('text')}, '[{LETTER}]{{2,}}')) AS word FROM documents) GROUP BY word HAVING count(*) >= 3",
    "problem_frequency": f"SELECT sorun, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS yuzde FROM (SELECT unnest({problem_set('sorunlar')}) AS sorun FROM flagged_record) GROUP BY sorun",
    "problem_histogram": "SELECT len(sorunlar)::INT AS sorun_sayisi, count(*) AS n FROM flagged_record GROUP BY 1",
    "length_buckets": """SELECT CASE WHEN k >= 200 THEN 'uzun' WHEN k >= 40 THEN 'orta' ELSE 'kisa' END AS uzunluk, count(*) AS n, sum(k)::BIGINT AS harf, max(k)::INT AS en_uzun, floor(sum(k)::DOUBLE / count(*))::BIGINT AS ortalama
        FROM (SELECT length(coalesce(aciklama, '')) AS k FROM flagged_record) GROUP BY 1""",
    "nearest_rank_percentiles": nearest([0.0001, 0.1, 0.25, 0.5]),
    "upper_median": f"SELECT k::INT AS ortanca FROM (SELECT length(icerik) AS k, row_number() OVER (ORDER BY length(icerik)) AS r, count(*) OVER () AS n FROM {SFT} WHERE icerik IS NOT NULL) WHERE r = n // 2 + 1",
    "topic_overlaps": f"SELECT kayit_no, round({overlap('soru', 't')}, 6) AS ortusme FROM (SELECT kayit_no, soru, {told('icerik')} AS t FROM {SFT}) WHERE soru IS NOT NULL AND trim(t) <> ''",
    "contamination_scan": contamination(),
    "word_shares": f"SELECT doc_id, round({vowelless('text')}, 6) AS cop, round({turkish('text')}, 6) AS tr, round({syllables('text')}, 6) AS hece FROM documents WHERE text IS NOT NULL",
    "quality_measures": f"""SELECT kayit_no, round({vowelless("soru || coalesce(aciklama, '')")}, 3) AS cop, round({turkish("soru || coalesce(aciklama, '')")}, 3) AS tr, length(coalesce(aciklama, ''))::INT AS aciklama_uz,
        round({syllables("soru || ' ' || coalesce(aciklama, '')")}, 3) AS hece FROM flagged_record""",
    "html_tables": f"SELECT doc_id, md5({html_table('text')}) AS ozet FROM documents WHERE contains(text, '<')",
    "option_counts": f"SELECT {option_letters('soru')}::INT AS sik, coalesce(contains(soru, chr(10) || 'E) '), false) AS bes_sik, count(*) AS n FROM {SFT} WHERE soru IS NOT NULL GROUP BY 1, 2",
    "boilerplate_lines": f"""SELECT doc_id, len(list_filter(l, lambda s: regexp_matches(s, '{BOILER}')))::INT AS n, md5(array_to_string(list_filter(l, lambda s: NOT regexp_matches(s, '{BOILER}')), chr(10))) AS ozet
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL) WHERE len(list_filter(l, lambda s: regexp_matches(s, '{BOILER}'))) > 0""",
    "exam_tags": rf"SELECT m || ' ' || y AS sinav, count(*) AS n FROM (SELECT regexp_extract(soru, '\(({MONTHS})[ \t]*([0-9]{{4}})\)', 1) AS m, regexp_extract(soru, '\(({MONTHS})[ \t]*([0-9]{{4}})\)', 2) AS y FROM {SFT}) WHERE m <> '' GROUP BY 1",
    "answer_letters": f"SELECT {letter('icerik')} AS harf, count(*) AS n FROM {SFT} GROUP BY 1",
    "question_stems": f"SELECT kayit_no, md5({stem('soru')}) AS govde_ozeti FROM {SFT} WHERE soru IS NOT NULL",
    "subjects_of_sources": f"SELECT {SUBJECT} AS ders, split_part(source_pdf, '/', 1) AS tur, count(*) AS n FROM {SFT} WHERE source_pdf IS NOT NULL GROUP BY 1, 2",
    "package_questions": f"SELECT p.drive_pdf, coalesce(s.n, 0) AS soru, p.egitim_soru FROM package_map p LEFT JOIN (SELECT nfc_normalize(trim(source_pdf)) AS k, count(*) AS n FROM {SFT} GROUP BY 1) s ON p.drive_pdf = s.k",
    "normal_form": "SELECT doc_id, md5(nfc_normalize(text)) AS ozet FROM documents WHERE text <> nfc_normalize(text)",
    "validator_report": report(),
    "stage_one_gates": gates(),
    "patched_records": patches(),
    "decision_progress": f"SELECT karar, count(*) AS n FROM {LATEST} GROUP BY karar",
    "dimension_counts": " UNION ALL ".join(
        f"SELECT '{k}' AS boyut, {v} AS deger, count(*) AS n FROM {SFT} GROUP BY 2"
        for k, v in (
            ("tur", "split_part(source_pdf, '/', 1)"), ("ders", SUBJECT.replace(" ELSE '?' END", " END")), ("harf", letter("icerik")),
            ("sinav", rf"CASE WHEN regexp_matches(soru, '\(({MONTHS})[ \t]*([0-9]{{4}})\)') THEN regexp_extract(soru, '\(({MONTHS})[ \t]*([0-9]{{4}})\)', 1) || ' ' || regexp_extract(soru, '\(({MONTHS})[ \t]*([0-9]{{4}})\)', 2) END"),
        )
    ),
    "answer_audit": audit(),
    "repairable_pool": pool(),
    "funnel": f"""WITH g AS {gated()}, steps AS (SELECT 'cerceveli' AS adim, count(*) AS n FROM {KEYED} WHERE {letter('icerik')} IS NOT NULL UNION ALL SELECT 'kapidan_gecen', count(*) FROM g UNION ALL SELECT 'tekil', count(DISTINCT anahtar_id) FROM g
        UNION ALL SELECT 'sizintisiz', count(DISTINCT anahtar_id) FROM g WHERE anahtar_id NOT IN (SELECT anahtar_id FROM {HELD} WHERE anahtar_id IS NOT NULL)) SELECT * FROM steps UNION ALL """
    + " UNION ALL ".join(f"SELECT '{a}' AS adim, count(*) AS n FROM {t}" for a, t in (("ham", "sft_record"), ("isaretli", "flagged_record"), ("onarim_istegi", "repair_request"), ("degerlendirme", "eval_record"), ("karar", "decision"))),
    "before_and_after": f"""WITH r AS (SELECT kayit_no, anahtar_id, length(icerik) AS u FROM {KEYED} WHERE icerik IS NOT NULL), k AS (SELECT arg_max(kayit_no, {{'n': u, 'k': -kayit_no}}) AS kayit_no FROM r GROUP BY anahtar_id)
        SELECT 'once' AS surum, count(*) AS n, max(u)::INT AS en_uzun, count(*) FILTER (u >= 200) AS uzun FROM r UNION ALL SELECT 'sonra', count(*), max(u)::INT, count(*) FILTER (u >= 200) FROM r WHERE kayit_no IN (SELECT kayit_no FROM k)""",
}

"""SQL of those pN_ queries that another engine can state on whole tables, by brute force."""

from __future__ import annotations


def _words(texts: str) -> str:
    """w(id, word, c): the words of texts(id, text) with their counts."""
    fold = "lower(replace(replace(replace(nfc_normalize(text), 'İ', 'i'), 'ı', 'i'), 'I', 'i'))"
    return f"SELECT id, word, count(*) AS c FROM (SELECT id, unnest(regexp_extract_all({fold}, '[\\p{{L}}\\p{{N}}]+')) AS word FROM {texts}) GROUP BY id, word"


def _user(cond: str = "") -> str:
    return "SELECT kayit_no AS id, list_filter(messages, lambda m: m.role = 'user')[1].content AS text FROM sft_record"


SFT = f"(SELECT * FROM ({_user()}) WHERE text IS NOT NULL)"
ASKED = f"(SELECT * FROM {SFT} UNION ALL SELECT kayit_no, soru FROM repair_request WHERE soru IS NOT NULL)"
HELD = "(SELECT kayit_no AS id, soru AS text FROM eval_record WHERE soru IS NOT NULL)"

P1 = f"""WITH w AS ({_words(ASKED)}), n AS (SELECT id, sum(c) AS n FROM w GROUP BY id),
    s AS (SELECT a.id AS a, b.id AS b, sum(least(a.c, b.c)) AS m FROM w a JOIN w b ON a.word = b.word AND a.id < b.id GROUP BY 1, 2)
    SELECT a AS kayit_no_a, b AS kayit_no_b FROM s JOIN n x ON s.a = x.id JOIN n y ON s.b = y.id WHERE 4 * m >= 3 * (x.n + y.n - m)"""
P3 = f"""WITH w AS ({_words(SFT)}), v AS ({_words(HELD)}), n AS (SELECT id, sum(c) AS n FROM w GROUP BY id), k AS (SELECT id, sum(c) AS n FROM v GROUP BY id),
    s AS (SELECT w.id AS a, v.id AS b, sum(least(w.c, v.c)) AS m FROM w JOIN v ON w.word = v.word GROUP BY 1, 2)
    SELECT a AS sft_kayit_no, b AS eval_kayit_no FROM s JOIN n ON s.a = n.id JOIN k ON s.b = k.id WHERE 4 * m >= 3 * (n.n + k.n - m)"""

P1_LINKS = f"""WITH w AS ({_words(ASKED)}), g AS (SELECT id, string_agg(word || ' ' || c, chr(10) ORDER BY word) AS s FROM w GROUP BY id), r AS (SELECT min(id) AS id FROM g GROUP BY s),
    v AS (SELECT w.* FROM w JOIN r ON w.id = r.id), n AS (SELECT id, sum(c) AS n FROM v GROUP BY id),
    s AS (SELECT a.id AS a, b.id AS b, sum(least(a.c, b.c)) AS m FROM v a JOIN v b ON a.word = b.word AND a.id < b.id GROUP BY 1, 2)
    SELECT a AS kayit_no_a, b AS kayit_no_b, round(m::DOUBLE / (x.n + y.n - m), 9) AS benzerlik FROM s JOIN n x ON s.a = x.id JOIN n y ON s.b = y.id WHERE 4 * m >= 3 * (x.n + y.n - m)"""

ORACLE: dict[str, str] = {
    "p1_links": P1_LINKS,
    "p1_found": P1,
    "p3_found": P3,
    "p3_report": f"""SELECT e.ayrim, r.meta.source_pdf AS source_pdf, count(*) AS cift, count(DISTINCT e.kayit_no) AS eval_kayit, count(DISTINCT r.kayit_no) AS sft_kayit
        FROM ({P3}) p JOIN eval_record e ON e.kayit_no = p.eval_kayit_no JOIN sft_record r ON r.kayit_no = p.sft_kayit_no GROUP BY 1, 2""",
}

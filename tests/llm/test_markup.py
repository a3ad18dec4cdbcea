from __future__ import annotations

import random

import pytest

from derlem.llm import markup
from derlem.llm.markup import to_text
from derlem.sources.tables import table

KINDS = [
    ("<p>a</p>", ["html"]),
    ("a <!-- not --> b", ["html"]),
    ("a&nbsp;b &#231;", ["html"]),
    ("&lt;i&gt;a&lt;/i&gt;", ["html"]),
    ("## Başlık\nmetin", ["markdown"]),
    ("Başlık\n=====\nmetin", ["markdown"]),
    ("**a b** c", ["markdown"]),
    ("*Bir cümle.* iki", ["markdown"]),
    ("~~eski~~", ["markdown"]),
    ("[a](b.md)", ["markdown"]),
    ("![a](b.png)", ["markdown"]),
    ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]),
    ("> alıntı", ["markdown"]),
    ("`kod`", ["markdown"]),
    ("```\nx = 1\n```", ["markdown"]),
    ("== Başlık ==", ["wiki"]),
    ("''eğik'' ve '''kalın'''", ["wiki"]),
    ("[[Kalp|kalpte]]", ["wiki"]),
    ("{{Kutu|a=1}}", ["wiki"]),
    ('{| class="x"\n|-\n! a !! b\n|-\n| 1 || 2\n|}', ["wiki"]),
    ("$x_1$", ["latex"]),
    ("$$a + b$$", ["latex"]),
    (r"\(\beta\) x", ["latex"]),
    (r"\textbf{a}", ["latex"]),
    ("\\begin{itemize}\n\\item a\n\\end{itemize}", ["latex"]),
    ("<b>x</b> $a_1$ **k** == y", ["html", "markdown", "latex"]),
]
PLAIN = [
    "- madde\n* madde\n• madde", "HbA1c > %7 ve LDL < 100", "p<0,05", "Kit 40 $ ve 50 $ tutar.", "Yıldız (*) bir (*) iki", "5 * 66 * 7", "T1 | T2 | x", "[12] ve [14]", "hasta_no A1_5 C&D", "Olgu #4", "a = b", "~ 23 ~",
    "<think>\nx\n</think>\n\nDoğru cevap: A", "> %7", "", "don't 'x'", "a\n> 3 mm", "-----",
]


@pytest.mark.parametrize(("text", "kinds"), KINDS)
def test_kinds(text, kinds):
    assert to_text(text)[1] == kinds


@pytest.mark.parametrize("text", PLAIN)
def test_no_markup_comes_back_as_it_is(text):
    assert to_text(text) == (text, [])


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("<h2>Ad</h2><p>Bir <b>iki</b>.</p>", "Ad\n\nBir iki."),
        ("<ul><li>a</li><li>b</li></ul>", "• a\n\n• b"),
        ("<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table>", "a | 1\n\nb | 2"),
        ("x **y** z", "x y z"),
        ("a\n```\nk <b> *x*\n```\nb", "a\n    k <b> *x*\nb"),
        (r"H $\mathrm{H}_{2}$ O $\frac{a}{b}$", "H H_2 O a/b"),
        ("\\begin{tabular}{ll}\nTSH & 6 \\\\\n\\end{tabular}", "TSH | 6"),
        ("{| class=\"x\"\n|-\n! a !! b\n|-\n| 1 || 2\n|}\nson", "| a | b\n\n| 1 | 2\n\nson"),
        ("[[a|b]] {{Kutu|ad=x}}", "b Kutu; ad: x"),
        ("<think>\n<p>x</p>\n</think>", "<think>\n\nx\n\n</think>"),
    ],
)
def test_text_keeps_structure(text, clean):
    assert to_text(text)[0] == clean


def test_line_blocks_drop_what_holds_nothing():
    assert markup.line_blocks("\n\n\n\na b\nc\n\n\n\n\n***\n\n\n\n\nd") == "a b\nc\n\nd"


BARS = [
    '<div><a href="/">Ana sayfa</a> | <a href="/u">Üyelik girişi</a></div>\n<div><a href="/s">Soru arşivi</a></div>\n<div><a href="/i">İletişim</a> <a href="#">Yukarı çık</a></div>',
    "- [Ana sayfa](/)\n- [Soru arşivi](/s)\n- [Paylaş](/p) | [Yazdır](/y)\n- [İletişim](/i)",
    "[[Ana sayfa]] • [[Arşiv|Soru arşivi]]\n[[Üyelik girişi]]\n[[İletişim]]",
]


@pytest.mark.parametrize("bar", BARS)
def test_link_rows_between_texts_are_dropped(bar):
    text = f"Kalp debisi ön yükle artar ve ard yükle azalır.\n{bar}\nBu nedenle **ikinci** seçenek doğrudur, ötekiler elenir."
    clean, _ = to_text(text)
    assert clean.split() == "Kalp debisi ön yükle artar ve ard yükle azalır. Bu nedenle ikinci seçenek doğrudur, ötekiler elenir.".split()


def test_links_within_text_stay():
    text = "Ayrıntı [burada](a.md) ve [şurada](b.md).\n[Kaynak](c.md)\nSon tümce de burada durur.\n```\n{\n}\n}\n```\nbitti, sonu"
    assert to_text(text)[0] == "Ayrıntı burada ve şurada.\nKaynak\nSon tümce de burada durur.\n    {\n    }\n    }\nbitti, sonu"


def test_planted_link_rows_of_whole_messages(spark, data):
    """Link rows put between the lines of real messages go, every other word stays."""
    rng = random.Random(3)
    texts = [m["content"] for r in table(spark, data, "sft_record").orderBy("kayit_no").collect() for m in r["messages"] if m["content"] and m["content"].count("\n") > 3][:300]
    lost = kept = 0
    for t in texts:
        plain, _ = to_text(t)
        lines = plain.split("\n")
        at = rng.randrange(1, len(lines))
        clean, _ = to_text("\n".join([*lines[:at], rng.choice(BARS), *lines[at:]]))
        kept += clean.split() == plain.split()
        lost += not set(plain.split()) <= set(clean.split())
    assert lost == 0 and kept >= 0.95 * len(texts)


def test_markup_outside_limits():
    assert to_text("$x_{1} + " + "y + " * 300 + "z$")[1] == ["latex"]
    assert to_text("Uzun başlık " * 20 + "sonu\n======\nmetin")[1] == ["markdown"]
    assert to_text("&amp;amp;amp;amp;lt;b&amp;amp;amp;amp;gt;x")[0] == "x"


def test_column(spark):
    df = spark.createDataFrame([(1, "user", None, "q"), (2, "user", "<b>x</b>", "q"), (3, "user", "<i>a" * 30000, "q")], "id long, part string, text string, kinds string")
    got = {r["id"]: (r["kinds"], r["clean"]) for r in markup.convert(df).collect()}
    assert got[1] == ([], None) and got[2] == (["html"], "x") and got[3][0] == ["html"]
    assert markup.convert(df.limit(0)).count() == 0

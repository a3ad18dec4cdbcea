"""Markup residue (problem 2): HTML, Markdown, wiki and LaTeX to clean text, by line-block distribution.

Two distributions over the lines of a text are summed over sliding windows of WINDOW lines.

1. Residue: the markup signs of each line. Where the sums surge above zero markup begins, after they dive to
   zero for good it ends; the rules that strip it run between these points only, and each names the kind of
   markup it stripped, so the kinds found and the clean text come from the same stretch.
2. Text: the words of each stripped line outside links, and those within links. A text block starts where the
   words outside links surge and ends where they dive: while a window holds links, but at most WORDS words
   outside them (menus, link rows, sharing bars), its lines are between texts and are dropped, as are link-only
   lines next to them and empty lines. Text between surge and dive is kept, whatever its length.

Structure is kept as plain text: headings as lines of their own, list items with a bullet, table cells with
bars, code as it is, formulas with their commands written out; lines of code and formulas count as text.

Plain bullets, lone comparison, dollar, star or bar signs and bracketed numbers are no markup. The frame
tags <think> and </think> are no markup either and stay. Null gives null and no kinds, "" gives "".
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW, WORDS = 3, 3
KINDS = ("html", "markdown", "wiki", "latex")

TAGS = (
    "p b i u s a br hr li ol ul td th tr em dl dt dd h1 h2 h3 h4 h5 h6 div sub sup img pre tt del ins big col nav var kbd "
    "span font code table thead tbody tfoot small strong center strike cite quote blockquote section article header footer "
    "html head body title meta link script style caption label input form button iframe figure abbr mark samp main"
).split()
TAG = re.compile(rf"</?(?:{'|'.join(TAGS)})(?:\s[^<>]*|\s*)/?>", re.I)
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
ANCHOR = re.compile(r"<a\b[^<>]*>(.*?)</a\s*>", re.I | re.S)
LINK, LINK_END = "\ue004", "\ue005"  # around the text of a link, until the blocks are chosen
ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
BLOCK_TAG = re.compile(r"</?(?:p|div|tr|table|ul|ol|h[1-6]|pre|blockquote|section)\b[^<>]*>|<br\s*/?>|</li>", re.I)
ITEM_TAG = re.compile(r"<li\b[^<>]*>", re.I)
CELL_TAG = re.compile(r"</t[dh]>\s*(?=<t[dh]\b)", re.I)

FENCE = re.compile(r"^[ \t]{0,3}(```+|~~~+)[^\n`]*\n(.*?)(?:^[ \t]{0,3}\1[ \t]*$|\Z)", re.S | re.M)
CODE = re.compile(r"(?<!`)`(?!`)([^`\n]+)`(?!`)")
MD_HEAD = re.compile(r"^[ \t]{0,3}#{1,6}[ \t]+(?=\S)(.*?)[ \t]*#*[ \t]*$", re.M)
MD_SETEXT = re.compile(r"^[ \t]{0,3}([^\W_][^\n]*?[^\s.;:,])[ \t]*\n[ \t]*(?:={3,}|-{3,})[ \t]*$", re.M)
MD_STRONG = re.compile(r"(\*\*|__)(?=[^\s*_])((?:(?!\n[ \t]*\n).)+?)(?<=[^\s*])\1(?!\w)", re.S)
MD_EM = re.compile(r"(?<![\w*\\])\*(?=[^\W_]|[\"“‘(])((?:(?!\n[ \t]*\n)[^*])+?)(?<=[^\s*(])\*(?![\w*])|(?<![\w_\\])_(?=[^\W_]|[\"“‘(])((?:(?!\n[ \t]*\n)[^_])+?)(?<=[^\s_(])_(?![\w_])")
MD_STRIKE = re.compile(r"~~(?=\S)((?:(?!\n[ \t]*\n).)+?)(?<=\S)~~", re.S)
MD_IMAGE = re.compile(r"!\[([^\]\n]*)\]\([^()\n]*\)")
MD_LINK = re.compile(r"(?<!\])\[([^\[\]\n]+)\]\([^()\s][^()\n]*\)")
MD_RULE = re.compile(r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|[ \t]*(?::?-{3,}:?[ \t]*)?$", re.M)
MD_QUOTE = re.compile(r"^[ \t]{0,3}>[ \t]?(?=[^\W\d_]|[\"“*_`>])", re.M)

WIKI_HEAD = re.compile(r"^[ \t]*(={2,6})[ \t]*(?=[^\s=])(.*?[^\s=])[ \t]*\1[ \t]*$", re.M)
WIKI_EM = re.compile(r"'{2,5}(?=[^\s'])((?:(?!\n[ \t]*\n).)+?)(?<=[^\s'])'{2,5}", re.S)
WIKI_LINK = re.compile(r"\[\[([^\[\]]+)\]\]")
WIKI_TEMPLATE = re.compile(r"\{\{([^{}]+)\}\}")
WIKI_OPEN = re.compile(r"^[ \t]*\{\|[^\n]*$", re.M)
WIKI_ROW = re.compile(r"^[ \t]*\|[-}][^\n|]*$", re.M)
WIKI_CELL = re.compile(r"[ \t]*(?:\|\||!!)[ \t]*")
WIKI_FIRST = re.compile(r"^[ \t]*!(?=\s*\w)", re.M)

TEX_MATH = re.compile(r"\$\$(.+?)\$\$|\\\((.+?)\\\)|\\\[(.+?)\\\]", re.S)
TEX_INLINE = re.compile(r"(?<![\w$\\])\$(?=[^\s$])([^$\n]+?)(?<=[^\s\\])\$(?![\d$])")
TEX_BODY = re.compile(r"[\\^_={}<>+]|^[\w ]{1,3}$")
TEX_ENV = re.compile(r"\\(?:begin|end)\s*\{([a-zA-Z*]+)\}(?:\{[^{}\n]*\}|\[[^\]\n]*\])?")
TEX_HEAD = re.compile(r"\\(?:part|chapter|(?:sub)*section|paragraph)\*?\s*\{([^{}]*)\}")
TEX_COMMAND = re.compile(r"(?<![\w:\\])\\[A-Za-z]+")
TEX_ITEM = re.compile(r"\\item\b[ \t]*")
TEX_FRAC = re.compile(r"\\d?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}")
TEX_WRAP = re.compile(r"\\[A-Za-z]+\*?\s*\{([^{}]*)\}")
TEX_ROW = re.compile(r"[ \t]*\\\\[ \t]*$", re.M)
#: fixed values: command to sign
TEX_SIGNS = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "Delta": "Δ", "lambda": "λ", "mu": "μ", "pi": "π", "sigma": "σ", "omega": "ω",
    "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "pm": "±", "times": "×", "cdot": "·", "approx": "≈", "neq": "≠", "sum": "∑", "sqrt": "√",
    "rightarrow": "→", "to": "→", "leftarrow": "←", "uparrow": "↑", "downarrow": "↓", "infty": "∞", "degree": "°", "circ": "°",
}
CONTROL = re.compile(r"\\([A-Za-z]+)\*?[ \t]*")
SIGNS = re.compile(r"[&#*_~`\[>|={\\$<]|''|---")
FRAME = re.compile(r"</?think>")


def tex_plain(body: str) -> str:
    """A formula or a stretch with commands as readable text."""
    while (new := TEX_FRAC.sub(r"\1/\2", body)) != body:
        body = new
    while (new := TEX_WRAP.sub(r"\1", body)) != body:
        body = new
    body = CONTROL.sub(lambda m: TEX_SIGNS.get(m[1], "") + (" " if m[1] in TEX_SIGNS else ""), body)
    body = re.sub(r"\\([%&#_{}$])", r"\1", body)
    body = re.sub(r"[{}]", "", body)
    body = re.sub(r"\s*([_^])\s*", r"\1", body)
    body = re.sub(r"(?<=\d) (?=\d)", "", body)
    return re.sub(r"[ \t]{2,}", " ", body).strip()


def linked(text: str) -> str:
    """A link's text with its marks, line by line."""
    return "\n".join(f"{LINK}{x}{LINK_END}" if x.strip() else x for x in text.split("\n"))


def windows(sizes: list[int]) -> list[int]:
    """Sums over each line and the lines after it, WINDOW in all."""
    return [sum(sizes[i : i + WINDOW]) for i in range(len(sizes))]


def residue(text: str) -> tuple[int, int]:
    """(first line of the first surge of markup signs, line after the last dive); (0, 0) without any."""
    if not SIGNS.search(FRAME.sub("", text)):
        return 0, 0
    sums = windows([len(SIGNS.findall(FRAME.sub("", x))) for x in text.split("\n")])
    raised = [i for i, n in enumerate(sums) if n]
    return (raised[0], raised[-1] + 1) if raised else (0, 0)


def strip_markup(text: str) -> tuple[str, list[str]]:
    """(text without markup, kinds found in the order of KINDS), text between the blocks left out."""
    begin, end = residue(text)
    if begin == end:
        return text, []
    lines = text.split("\n")
    t, kinds = strip_stretch("\n".join(lines[begin:end]))
    if not kinds:
        return text, []
    return line_blocks("\n".join([*lines[:begin], t, *lines[end:]])), kinds


def strip_stretch(text: str) -> tuple[str, list[str]]:
    """(stretch without markup, links marked, code and formulas in place, kinds found)."""
    found: set[str] = set()
    kept: list[str] = []

    def keep(s: str) -> str:  # code and formulas are out of the way of the other rules
        kept.append(s)
        return f"\ue000{len(kept) - 1}\ue001"

    def sub(pattern: re.Pattern, new, kind: str, t: str) -> str:
        t, n = pattern.subn(new, t)
        if n:
            found.add(kind)
        return t

    t = text.replace("<think>", "\ue002").replace("</think>", "\ue003")
    if "`" in t or "~~~" in t:
        t = sub(FENCE, lambda m: keep("\n".join("    " + x for x in m[2].rstrip("\n").split("\n"))), "markdown", t)
        t = sub(CODE, lambda m: keep(m[1]), "markdown", t)
    if "$" in t or "\\" in t:
        t = sub(TEX_MATH, lambda m: keep(tex_plain(next(x for x in m.groups() if x))), "latex", t)

        def inline(m: re.Match) -> str:
            if not TEX_BODY.search(m[1]):
                return m[0]
            found.add("latex")
            return keep(tex_plain(m[1]))

        t = TEX_INLINE.sub(inline, t)
        if TEX_COMMAND.search(t):
            found.add("latex")
            rows = "tabular" in t or "array" in t
            t = TEX_HEAD.sub(r"\n\1\n", t)
            t = TEX_ITEM.sub("• ", TEX_ENV.sub("", t))
            if rows:
                t = TEX_ROW.sub("", t)
                t = re.sub(r"[ \t]*(?<!\\)&[ \t]+", " | ", t)
            t = "\n".join(tex_plain(x) if "\\" in x else x for x in t.split("\n"))
    if "<" in t:
        t = sub(COMMENT, "", "html", t)
        if TAG.search(t):
            found.add("html")
            t = ANCHOR.sub(lambda m: linked(m[1]), t)
            t = BLOCK_TAG.sub("\n", ITEM_TAG.sub("\n• ", CELL_TAG.sub(" | ", t)))
            t = TAG.sub("", t)
    if "&" in t and ENTITY.search(t):
        found.add("html")
        while (new := html.unescape(t)) != t:  # entities may have been escaped again and again
            t = new
        t = BLOCK_TAG.sub("\n", t)
        t = TAG.sub("", t)
    if "=" in t:
        t = sub(WIKI_HEAD, r"\2", "wiki", t)
    if "''" in t:
        t = sub(WIKI_EM, r"\1", "wiki", t)
    if "[[" in t:
        t = sub(WIKI_LINK, lambda m: linked(m[1].split("|")[-1]), "wiki", t)
    if "{{" in t:
        t = sub(WIKI_TEMPLATE, lambda m: "; ".join(x.replace("=", ": ", 1) for x in m[1].split("|")), "wiki", t)
    if "|" in t:
        wiki = WIKI_OPEN.search(t) or WIKI_ROW.search(t)
        if wiki:
            found.add("wiki")
            t = WIKI_FIRST.sub("|", WIKI_ROW.sub("", WIKI_OPEN.sub("", t)))
            t = WIKI_CELL.sub(" | ", t)
        t = sub(MD_RULE, "", "markdown", t)
    if "---" in t or "===" in t:
        t = sub(MD_SETEXT, r"\1", "markdown", t)
    if "#" in t:
        t = sub(MD_HEAD, r"\1", "markdown", t)
    if "[" in t:
        t = sub(MD_IMAGE, r"\1", "markdown", t)
        t = sub(MD_LINK, lambda m: linked(m[1]), "markdown", t)
    if "~~" in t:
        t = sub(MD_STRIKE, r"\1", "markdown", t)
    if "*" in t or "_" in t:
        t = sub(MD_STRONG, r"\2", "markdown", t)
        t = sub(MD_EM, lambda m: m[1] or m[2], "markdown", t)
    if ">" in t:
        t = sub(MD_QUOTE, "", "markdown", t)
    if not found:
        return text, []
    for i in range(len(kept) - 1, -1, -1):
        t = t.replace(f"\ue000{i}\ue001", kept[i])
    return t.replace("\ue002", "<think>").replace("\ue003", "</think>"), [k for k in KINDS if k in found]


WORD = re.compile(r"[^\W_]+")
LINKED = re.compile(f"{LINK}([^{LINK}{LINK_END}]*){LINK_END}")
KEPT_LINE = re.compile(r"^\s*</?think>\s*$|^ {4}\S")  # frame and code
MARKS = str.maketrans("", "", LINK + LINK_END)


def line_blocks(text: str) -> str:
    """Keep the text between surges and dives of the windowed sums of words outside links."""
    every = [x.rstrip() for x in text.split("\n")]
    place = [i for i, x in enumerate(every) if x]  # empty lines part blocks, but are no lines of a window
    lines = [every[i] for i in place]
    inside = [sum(len(WORD.findall(m)) for m in LINKED.findall(x)) for x in lines]
    outside = [len(WORD.findall(LINKED.sub("", x))) + bool(KEPT_LINE.match(x)) * (WORDS + 1) for x in lines]
    # a window of links dives if few words stand outside them
    sums, links = windows(outside), windows(inside)
    dive = [False] * len(lines)
    for i in range(len(lines)):
        part = range(i, min(i + WINDOW, len(lines)))
        rows = sum(inside[k] > 0 for k in part)
        if links[i] and sums[i] <= WORDS and rows == WINDOW:
            for k in part:
                dive[k] = True
        at = place[i]
        if not inside[i] and not outside[i] and not any(every[max(at - 1, 0) : at] + every[at + 1 : at + 2]):  # signs alone between empty lines
            dive[i] = True
    for order in (range(len(lines)), reversed(range(len(lines)))):  # lines of nothing but links next to a dive
        before = False
        for i in order:
            if before and inside[i] and not outside[i]:
                dive[i] = True
            before = dive[i] and inside[i] > 0
    gone = {place[i] for i, d in enumerate(dive) if d}
    out: list[str] = []
    for i, x in enumerate(every):
        if i not in gone:
            out.append(x)
        elif out and out[-1]:
            out.append("")
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).translate(MARKS).strip("\n")


def to_text(text: str | None) -> tuple[str | None, list[str]]:
    """(clean text, kinds); text without markup comes back as it is."""
    return strip_markup(text) if text is not None else (None, [])


def convert(texts: DataFrame, with_text: bool = True) -> DataFrame:
    """texts(id, part, text) -> (id, part, kinds array<string>[, clean])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [to_text(t) for t in batch.column(2).to_pylist()]
            cols = [batch.column(0), batch.column(1), pa.array([k for _, k in got], pa.list_(pa.string()))]
            if with_text:
                cols.append(pa.array([t for t, _ in got], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "part", "kinds", "clean"][: len(cols)])

    return texts.select("id", "part", "text").mapInArrow(run, "id long, part string, kinds array<string>" + ", clean string" * with_text)

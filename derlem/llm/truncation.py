"""Text cut off by field limits (problem 7): a backward n-gram model of ends.

A value's end is judged on two levels, both by how often its final context, read backwards, was followed
by an end and how often by more text.

* Characters: for the last 3 to 14 characters the model holds the ends and continuations of a word, of a
  sentence before its stop and of a sentence after it (so that "the 60." is told from "the end."). Counts of
  longer contexts are smoothed by those of shorter ones.
* Units: the units a value has so far (options of a question; opened frame, closed frame, answer line of a
  response) are a context of their own: how often a value that reached this unit ended there.

The log odds of end against continuation of both together are compared with a threshold per language and
column. It is calibrated on all values as they are and on a copy of each cut at a random place:
the share p of cut values is the share of values as low as the lowest 0.3 of the made cuts, over 0.3;
among the values around rank p (from p/2 to 2p) the threshold is the middle of the widest gap. Scores
beyond CLEAR are equally clear. Languages with under FEW values share one threshold.

What is whole by definition is no question of odds: text that ends on a list item, a table row, a measured
value or a page or source reference, or with closed markup, ends its unit; of items and rows the last word
is still judged. A value ending in a broken character or on a comma or dash is cut.

All rows are counted and all are judged. What a value's end asks of the model is known from its text (ending),
so that no model travels: the contexts asked for are joined with their counts. A bitmap of the contexts asked for
keeps others from being shuffled and changes no count. Scores have DIGITS decimals, so that the driver sees
a bounded histogram of them.

Null and blank values, and responses without a word of explanation, are not cut.
"""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cache, lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derlem.llm.overlap import FILTER_BITS, key_bitmap
from derlem.session import materialize

ORDERS = (3, 5, 7, 10, 14)
LEAST = 3
MULT = np.uint64(0x9E3779B97F4A7C15)

FRAME_OPEN, FRAME_CLOSE = "<think>", "</think>"
ANSWER = re.compile(r"^\s*(?:do[ğg]ru\s+cevap|correct answer|cevap|answer|richtige antwort|bonne réponse|respuesta correcta)\s*[:.]?\s*(?:\(?[a-e]\b.*)?\s*$", re.I | re.S)
CLOSERS = " \t\r\n\xa0\u200b\"'”’»)*_~`]"
TERMINAL = tuple(".?!…")
ORDINAL = re.compile(r"(?:^|\s)(?:[%#]?\d{1,4}|bkz|örn|no|dr|prof|vs|sf)\.$", re.I)
MARKUP_END = re.compile(r"(?:</?[A-Za-z][A-Za-z0-9]*\s*/?>|-->|\|\}|\}\}|\]\]|\\end\{[a-z]+\*?\}|`[^`\n]+`|```|\$\$?|={2,}|-{3,}|&[A-Za-z]+;|\\\\|\\\)|\}|''|\]\([^()\n]*\)|\.(?:png|jpg|md))\s*$")
ITEM = re.compile(r"^\s*(?:[•*+\-–]|\d{1,2}[.)]|[a-e]\s*[).]|<li\b[^>]*>|\\item\b)\s*\S|(?:\b\d\)\s*\S[^.]*){2,}$", re.I)
ROW = re.compile(r"\S\s+\|\s+\S|^\s*[|!]\s*\S|\S\s+&\s+\S")
VALUE = re.compile(r"^\W*\d+(?:[.,]\d+)?\s*(?:[%\w/³²°]{1,8})\s*$")
REFERENCE = re.compile(r"(?:^|\b)(?:sayfa|bölüm|bolum|s\.|page|seite|página|kaynak|şekil|tablo)\s*\.?\s*\d+\W*$|^\W*kaynak\b.*\)\s*$", re.I)
DOSE = re.compile(r"\b0+ mg \w+$")
PAGE_LINE = re.compile(r"^\W*(?:sayfa|s\.)?\s*\d{1,4}\W*(?:/\s*\d{1,4}\W*)?$", re.I)

OPTION_START = re.compile(r"([A-Ea-e])\s*(?:[).](?=\s|\xa0)|-(?=[\s\xa0]))\s*")
#: an OPTION_START that option_at() takes, but for one at the beginning; looked for first, as texts without any are told faster by it
OPTION_AFTER = re.compile(r"[\s>(\"][A-Ea-e]\s*[).\-][\s\xa0]")
BREAK = re.compile(r"(\w)[-‑\u00ad¬=–‐][ \t\r]*\n\s*(?=\w)")
BROKEN = re.compile(r"[-‑\u00ad¬=–‐][ \t\r]*\n")
SPACE = re.compile(r"\s+")
LETTER = re.compile(r"\w")
DIGIT = re.compile(r"\d")


def joined(text: str) -> str:
    """Words broken at line ends are one; what a BREAK holds is looked for first, as it is found faster."""
    return BREAK.sub(r"\1", text) if BROKEN.search(text) else text


@lru_cache(1 << 12)
def norm(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("İ", "i")
    return DIGIT.sub("0", SPACE.sub(" ", joined(text))).lower()


KINDS = ("word", "sentence", "stop")
SALT = {(kind, order): (0xD1B54A32D192ED03 * (16 * i + order + 1)) & ((1 << 64) - 1) for i, kind in enumerate(KINDS) for order in ORDERS}


def hashes(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order, a 64-bit hash of the order characters before each position p >= order, read backwards."""
    n, h, shifted = len(codes), np.zeros(len(codes) + 1, np.uint64), np.empty(len(codes), np.uint64)
    wide = codes.astype(np.uint64)
    for k in range(min(n, ORDERS[-1])):
        h = h[1:]  # in place: what is read is not behind what is written
        h ^= wide[: n - k]
        h *= MULT
        h ^= np.right_shift(h, np.uint64(31), out=shifted[: n - k])
        if k + 1 in ORDERS:
            yield k + 1, h


def context_keys(kind: str, context: str) -> list[int]:
    """The key of each order that the context is long enough for, shortest first; as tally()."""
    out = []
    mask, mult, h = (1 << 64) - 1, int(MULT), 0
    for n, c in enumerate(reversed(context[-ORDERS[-1] :]), 1):
        h = ((h ^ ord(c)) * mult) & mask
        h ^= h >> 31
        if n in ORDERS:
            out.append((h ^ SALT[kind, n]) >> 1)
    return out


CERTAIN = 9.0
PRIOR, MASS = {"stop": 0.98}, 4.0  # what contexts without counts say (else even odds), and how much it weighs against counts
KNOWN = 7
CLEAR = 8.0
FEW = 100  # a threshold of its own needs so many values
DIGITS = 3
MOST = 1 << 20  # counts that a task holds before it passes them on; more are merged or passed on in parts


class Ends:
    """Counts of ends and of all continuations per context seen at least LEAST times, and the thresholds."""

    def __init__(self) -> None:
        self.seen = NOTHING
        self.units: dict[tuple[str, str], tuple[int, int]] = {}
        self.threshold: dict[tuple[str, str], float] = {}
        self.memo: dict[tuple[str, str], tuple[float, int]] = {}

    def count_units(self, column: str, unit: str, n: int = 1) -> None:
        """n values ended at this unit and passed those before it."""
        passed = [str(k) for k in range(int(unit) + 1)] if column == "user" else PASSED[unit]
        for u in passed:
            ends, total = self.units.get((column, u), (0, 0))
            self.units[column, u] = ends + n * (u == unit), total + n

    def unit_odds(self, column: str, unit: str) -> float:
        """Log odds that a value which reached this unit has no further one; 0 for a unit never seen."""
        ends, total = self.units.get((column, unit), (0, 0))
        return math.log((ends + 0.5) / (total - ends + 0.5))

    def odds(self, kind: str, context: str) -> tuple[float, int]:
        """(log odds of an end against a continuation after the context, longer contexts smoothed by shorter ones;
        the longest known order)."""
        key = (kind, context[-ORDERS[-1] :])
        got = self.memo.get(key)
        if got is None:
            p, known = PRIOR.get(kind, 0.5), 0
            q = 1 - p  # kept beside p, which counts can bring to 1
            keys, ends, total = self.seen
            for order, k in zip(ORDERS, context_keys(*key)):
                i = int(np.searchsorted(keys, k))
                if i >= len(keys) or int(keys[i]) != k:
                    break
                n = int(total[i]) + MASS
                p, q, known = (int(ends[i]) + MASS * p) / n, (int(total[i] - ends[i]) + MASS * q) / n, order
            if len(self.memo) > 200_000:
                self.memo.clear()
            got = self.memo[key] = math.log(p) - math.log(q), known
        return got


NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
#: the units an explanation passed that ended at one
PASSED = {"free": ["free"], "open": ["open"], "closed": ["open", "closed"], "begun": ["open", "closed", "begun"], "answered": ["open", "closed", "begun", "answered"]}


def both(a: float, b: float) -> float:
    """Log odds that two independent events of these log odds both hold."""
    x = math.log1p(math.exp(-a)) + math.log1p(math.exp(-b))  # -log p
    return -math.log(math.expm1(x)) if x > 1e-12 else 25.0


TURKISH = re.compile(r"[çğışöüı]|\b(?:ve|ile|bir|bu|olarak)\b", re.I)


#: what TURKISH finds, faster: letters, the commonest first, and words without one of them (in bir and ile a letter is found already)
TURKISH_LETTERS = "iıIüşğöçİÜŞĞÖÇ"
TURKISH_WORDS = re.compile(r"[VvBbOo](?<!\w.)(?:(?<=[Vv])[Ee]|(?<=[Bb])[Uu]|(?<=[Oo])[Ll][Aa][Rr][Aa][Kk\u212a])\b", re.S)


def language(text: str) -> str:
    """"tr" where TURKISH is found once or more in 40 characters of the text's end."""
    tail, n = text[-400:], 0
    least = len(tail)
    for c in TURKISH_LETTERS:
        n += tail.count(c)
        if n * 40 >= least:
            return "tr"
    return "tr" if (n + len(TURKISH_WORDS.findall(tail))) * 40 >= least else "other"


def explanation(text: str) -> tuple[str, str | None]:
    """(explanation, what follows its frame or None without a closing tag)."""
    i = text.find(FRAME_CLOSE)
    head = text if i < 0 else text[:i]
    j = head.find(FRAME_OPEN)
    return (head[j + len(FRAME_OPEN) :] if j >= 0 else head), (None if i < 0 else text[i + len(FRAME_CLOSE) :])


def option_spans(text: str) -> tuple[str, list[tuple[str, str]]]:
    """(stem, (letter, option text) in order of appearance), on lines or run on."""
    if not may_have_options(text):
        return text, []
    found = [(m, at) for m in OPTION_START.finditer(text) if (at := option_at(text, m.start())) is not None]
    if not found:
        return text, []
    ends = [at for _, at in found[1:]] + [len(text)]
    return text[: found[0][1]], [(m[1].upper(), text[m.end() : e]) for (m, _), e in zip(found, ends)]


def may_have_options(text: str) -> bool:
    """Where it is False, neither the text nor the beginning of it has any."""
    return bool(OPTION_AFTER.search(text) or OPTION_START.match(text))


def option_at(text: str, at: int) -> int | None:
    """Where an option begins whose letter is here, its bracket included; None if something else is before it."""
    for p in (at - 1, at) if text[at - 1 : at] == "(" else (at,):
        if p == 0 or text[p - 1].isspace() or text[p - 1] in '>("':
            return p
    return None


def flat(text: str) -> str:
    """norm() without white space around it, before digits and case are folded."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("İ", "I")
    return " ".join(joined(text).split())


@cache
def _table(test: Callable[[str], bool]) -> np.ndarray:
    return np.array([test(chr(c)) for c in range(0x3000)])


def _kind(test: Callable[[str], bool], codes: np.ndarray) -> np.ndarray:
    """For each code point, whether the test holds."""
    table = _table(test)
    out, high = table[np.minimum(codes, len(table) - 1)], codes >= len(table)
    if high.any():
        out[high] = [test(chr(c)) for c in codes[high]]
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


STOPS, AFTER_STOP = ".?!…;".__contains__, "\x00 \n\"<*'_".__contains__


Counts = tuple[np.ndarray, np.ndarray, np.ndarray]


def tally(rows: list[tuple[str | None, str | None]]) -> Counts:
    """(key, ends, all continuations) of the contexts in rows of (user content, assistant content)."""
    return merged(list(contexts(rows)))


def contexts(rows: list[tuple[str | None, str | None]], wanted: np.ndarray | None = None) -> Iterator[Counts]:
    """tally() in parts, in which a key may come more than once; with a bitmap only of keys in it."""
    sentences, options = [], []
    for user, assistant in rows:
        if user and LETTER.search(user):
            stem, opts = option_spans(user)
            sentences.append(flat(stem))
            options += [flat(t) for _, t in opts[:-1]]  # the last may be cut
        if assistant and LETTER.search(explanation(assistant)[0]):
            sentences.append(flat(explanation(assistant)[0]))
    for texts, running in ((sentences, True), (options, False)):
        cased = _codes("\x00" + "\x00".join(texts) + "\x00")
        codes = np.where(cased < len(SMALL), SMALL[np.minimum(cased, len(SMALL) - 1)], cased)
        codes[_kind(str.isdecimal, codes)] = ord("0")
        nxt = np.concatenate([codes, codes[:1]])  # followed by a zero, as it begins with one
        letter = _kind(str.isalnum, nxt)
        after_letter = np.concatenate([[False], letter[:-1]])
        places = np.arange(len(codes))
        room = np.concatenate([[0], places - np.maximum.accumulate(np.where(codes == 0, places, 0))])  # characters of the text before a position
        back = {order: np.zeros(len(room), np.uint64) for order in ORDERS if order <= len(codes)}  # of the contexts before each position, 0 if it has fewer characters
        order = np.zeros(len(room), np.uint64)
        for (k, h), width in zip(hashes(codes), WIDTHS):
            np.multiply(h, room[k:] >= k, out=back[k][k:])
            order <<= np.uint64(width)
            order |= back[k] >> np.uint64(64 - width)
        if not running:
            yield from grouped(np.flatnonzero(after_letter & (room >= ORDERS[0])), back, order, {"word": ~letter}, wanted)
            continue
        after_stop = _kind(AFTER_STOP, nxt)
        at_stop = _kind(STOPS, nxt)
        stop = at_stop & np.concatenate([after_stop[1:], [True]])
        yield from grouped(np.flatnonzero(after_letter & (nxt != 0) & (room >= ORDERS[0])), back, order, {"word": ~letter, "sentence": stop}, wanted)
        # after a stop: an end unless the next word is small
        small = _kind(str.islower, cased)
        following = np.concatenate([small[1:], [False, False]]) & (nxt == 32)
        use = np.concatenate([[False], at_stop[:-1]]) & after_stop & (room >= ORDERS[0])
        yield from grouped(np.flatnonzero(use), back, order, {"stop": ~following}, wanted)


#: bits of each order's hash that positions are sorted by, so that those of equal contexts meet
WIDTHS = (16, 10, 7, 6, 5)


def grouped(at: np.ndarray, back: dict[int, np.ndarray], order: np.ndarray, ends: dict[str, np.ndarray], wanted: np.ndarray | None) -> Iterator[Counts]:
    """The contexts before the positions at, counted once for all orders and kinds. One sort brings the positions of a context together, for each order
    within those of the shorter ones; where other contexts share the sorted bits, one may come in several parts."""
    if not len(at):
        return
    digits = int(len(at) - 1).bit_length()
    order = order[at] >> np.uint64(max(0, digits + sum(WIDTHS) - 64))
    order <<= np.uint64(digits)
    order |= np.arange(len(at), dtype=np.uint64)
    order.sort()
    at = at[(order & np.uint64((1 << digits) - 1)).view(np.int64)]
    for k, hashed in back.items():
        h = hashed[at]
        first = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
        end = np.concatenate([first[1:], [len(at)]])
        h = h[first]
        further = np.zeros(len(h), bool)
        for kind, is_end in ends.items():
            upto = np.concatenate([[0], np.cumsum(is_end[at], dtype=np.int32)])
            keys, a, b = (h ^ np.uint64(SALT[kind, k])) >> np.uint64(1), first, end
            if wanted is not None:
                bit = keys & np.uint64((1 << FILTER_BITS) - 1)
                asked = (wanted[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool) & (h != 0)
                further |= asked
            else:
                asked = h != 0
            keys, a, b = keys[asked], a[asked], b[asked]
            yield keys.view(np.int64), (upto[b] - upto[a]).astype(np.int64), b - a
        if wanted is not None:  # who asks for a context asks for its shorter ones
            at = at[np.repeat(further, end - first)]
            if not len(at):
                return


def merged(counts: list[Counts]) -> Counts:
    """The sum of counts, by key."""
    keys, ends, total = (np.concatenate(c) for c in zip(*counts)) if counts else NOTHING
    order = np.argsort(keys)
    return summed(keys[order], ends[order], total[order])


def summed(keys: np.ndarray, ends: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted keys."""
    if not len(keys):
        return NOTHING
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(ends, at), np.add.reduceat(total, at)


def fit(rows: list[tuple[str | None, str | None]]) -> Ends:
    """The model of rows (user content, assistant content) in memory; as scores() has it of a table."""
    model = Ends()
    keys, ends, total = tally(rows)
    model.seen = keys[total >= LEAST], ends[total >= LEAST], total[total >= LEAST]
    for pair in rows:
        for column, text in zip(("user", "assistant"), pair):
            got = ending(column, text)
            if got and got[1]:
                model.count_units(column, got[0])
    seen: Counter[tuple[str, str, bool, float]] = Counter()
    for i, pair in enumerate(rows):
        for column, text in zip(("user", "assistant"), pair):
            score = end_score(model, column, text)
            if score is None or len(text) < 40:
                continue
            key = language(text), column
            seen[*key, False, score] += 1
            made = end_score(model, column, made_cut(column, text, f"{i} 0"))
            if made is not None:
                seen[*key, True, made] += 1
    model.threshold = thresholds((*k, n) for k, n in seen.items())
    return model


#: lower case without a change of length, so that positions stay
SMALL = np.array([ord(chr(c).lower()[0]) for c in range(0x250)], np.uint32)


def made_cut(column: str, text: str, seed: str) -> str:
    """The text cut at a random place; seed: its row."""
    rng = random.Random(f"{seed} {column}")
    keep = text[: rng.randrange(20, len(text))]
    if column == "assistant" and rng.random() < 0.5:  # only the explanation is cut, the frame is whole
        body, after = explanation(text)
        if after is not None and len(body) > 30:
            keep = f"{FRAME_OPEN}\n{body.strip()[: rng.randrange(15, len(body))]}\n{FRAME_CLOSE}{after}"
    return keep


def thresholds(seen: Iterable[tuple[str, str, bool, float, int]]) -> dict[tuple[str, str], float]:
    """seen: (language, column, made, score, its number). The thresholds per language and column, and per column ("")
    for languages with few values."""
    scores: dict[tuple[str, str], tuple[Counter[float], Counter[float]]] = defaultdict(lambda: (Counter(), Counter()))
    for lang, column, made, score, n in seen:
        for key in ((lang, column), ("", column)):
            scores[key][made][score] += n
    out = {}
    for key, both_ in scores.items():
        (f, upto), (g, below) = (ranks(c) for c in both_)
        if not len(f) or not len(g) or upto[-1] < FEW and key[0]:
            continue
        n = int(upto[-1])
        low = g[np.searchsorted(below, int(0.3 * below[-1]), "right")]
        at = int(np.searchsorted(f, low, "right"))
        share = float(np.clip((upto[at - 1] if at else 0) / n / 0.3, 0.002, 0.25))
        first, last = int(n * share / 2), min(n, int(n * share * 2) + 2) - 1
        if last <= first:
            continue
        inside = np.clip(f[np.searchsorted(upto, first, "right") : np.searchsorted(upto, last, "right") + 1], -CLEAR, CLEAR)
        gap = int(np.argmax(np.diff(inside))) if len(inside) > 1 else 0
        out[key] = float((inside[gap] + inside[min(gap + 1, len(inside) - 1)]) / 2)
    return out


def ranks(seen: Counter[float]) -> tuple[np.ndarray, np.ndarray]:
    """The values in order, and the number of those up to each."""
    return np.array(sorted(seen)), np.cumsum([seen[x] for x in sorted(seen)])


def user_units(text: str) -> tuple[list[str], list[tuple[str, str]]]:
    """(units passed: the stem "0", then "1" to "5" for its distinct options; the option spans)."""
    _, opts = option_spans(text)
    return [str(k) for k in range(min(5, len({k for k, _ in opts})) + 1)], opts


def assistant_units(text: str, after: str | None) -> list[str]:
    """free (no frame), or open, closed and answered as far as they are reached; begun: an answer line not finished. after: as explanation() has it."""
    if after is None:
        opened = FRAME_OPEN in text or "<" in text[-7:] and FRAME_OPEN.startswith(text[text.rindex("<") :])
        return ["open"] if opened else ["free"]
    if not after.strip():
        return ["open", "closed"]
    return ["open", "closed", "begun", *(["answered"] if is_answer(after) else [])]


@lru_cache(1 << 10)
def is_answer(line: str) -> bool:
    return bool(ANSWER.match(line))


class End(NamedTuple):
    """What decides whether a text ends: the least of the log odds given or asked for."""

    fixed: float | None = None
    word: str | None = None  # context
    free: bool = False
    kind: str | None = None
    rest: str | None = None  # context of that kind


def word_end(context: str, free: bool = False) -> End:
    """Whether the last word is a whole one. free: in options, items and rows, where names are made up, only
    contexts of KNOWN characters or more say anything."""
    return End(word=context[-ORDERS[-1] :], free=free) if context[-1:].isalpha() else End(CERTAIN)


def end_odds(model: Ends, end: End) -> float:
    found = [] if end.fixed is None else [end.fixed]
    if end.word is not None:
        odds, order = model.odds("word", end.word)
        found.append(CERTAIN if end.free and order < KNOWN else odds)
    if end.rest is not None:
        found.append(model.odds(end.kind, end.rest)[0])
    return min(found)


#: one of these ends what MARKUP_END finds
MARKS = tuple(">}]`$=-;\\)'gd")


def ends_in_markup(text: str) -> bool:
    """text: without white space at its end."""
    return text.endswith(MARKS) and bool(MARKUP_END.search(text))


def is_reference(line: str) -> bool:
    """line: stripped. A reference ends on a bracket or its last word on a digit."""
    last = next((c for c in reversed(line) if c.isalnum() or c == "_"), "")
    return (line.endswith(")") or last.isdecimal()) and bool(REFERENCE.search(line))


def is_row(line: str) -> bool:
    return ("|" in line or "&" in line or "!" in line) and bool(ROW.search(line))


def is_item(line: str) -> bool:
    """What ITEM finds, of which only brackets are looked for behind the beginning."""
    return bool(ITEM.match(line) or ")" in line and ITEM.search(line))


def running_end(text: str) -> End:
    """Whether running text (an explanation or stem) stops at the end of a sentence, item, row or reference."""
    t = text.rstrip()
    last = t.rsplit("\n", 1)[-1]
    if "\n" in t and PAGE_LINE.match(last) and not VALUE.match(last):  # a page number below the last line
        return running_end(t.rsplit("\n", 1)[0])
    bare = t.rstrip(CLOSERS)
    if ends_in_markup(t):
        inner = re.sub(r"(?:</?[A-Za-z][^<>]*>|\s)+$", "", t)
        judged = t.endswith(">") and not t.endswith("-->") and inner and inner != t and not ends_in_markup(inner)
        return running_end(inner) if judged else End(CERTAIN)
    if "�" in t[-2:]:
        return End(-CERTAIN)
    if bare.endswith(TERMINAL):
        if ITEM.match(last[:3] + "x"):
            return End(CERTAIN)
        return End(kind="stop", rest=norm(bare[-40:])[-ORDERS[-1] :])
    line = last.strip()
    if is_reference(line) or VALUE.match(line) or bare != t and t[-1] in ")]" and "(" not in bare[-1:]:
        return End(CERTAIN)
    context = norm(t[-60:]).rstrip(CLOSERS)
    if is_row(line) or len(line) < 120 and is_item(line):
        return word_end(context, free=True)
    if not bare[-1:].isalnum():
        return End(-CERTAIN)
    return word_end(context)._replace(kind="sentence", rest=context[-ORDERS[-1] :])


def option_end(text: str) -> End:
    """Whether the last option stops at the end of a word; what options say is free, so only that is asked."""
    last = text.rstrip(CLOSERS)
    tail = last.rsplit("\n", 1)
    if len(tail) == 2 and PAGE_LINE.match(tail[1]):
        last = tail[0].rstrip(CLOSERS)
    if not LETTER.search(last):
        return End(-CERTAIN)
    if last.endswith(TERMINAL) or ends_in_markup(text.rstrip()):
        return End(CERTAIN)
    return word_end(norm(last[-60:]), free=True)


def ending(column: str, text: str | None) -> tuple[str, End | None] | None:
    """(the unit a value reached, what is asked of its end or None without a word in an open frame); None for one without a word to judge."""
    if not text or not LETTER.search(text):
        return None
    if column == "user":
        t = text.rstrip()
        units, opts = user_units(t)
        return units[-1], End(-CERTAIN) if "�" in t[-2:] else option_end(opts[-1][1]) if opts else running_end(t)
    return response_ending(text, *explanation(text))


def response_ending(text: str, body: str, after: str | None, optionless: bool = False) -> tuple[str, End | None] | None:
    """ending() of a response, given its explanation(); optionless: this is known to have no options."""
    if not LETTER.search(text):
        return None
    units = assistant_units(text, after)
    if units == ["open"]:
        body = re.sub(r"<[a-z/]*$", "", body)
    if not LETTER.search(body):
        return None if units[-1] != "open" else ("open", None)
    opts = [] if optionless else option_spans(body)[1]
    repeats = len({k for k, _ in opts}) >= 4 and len(opts[-1][1]) < 160  # it repeats the question with its options
    return units[-1], option_end(opts[-1][1]) if repeats else running_end(body)


def end_score(model: Ends, column: str, text: str | None) -> float | None:
    """Log odds of an end against a continuation after the value; None for one without a word to judge."""
    got = ending(column, text)
    if got is None:
        return None
    unit, end = got
    odds = model.unit_odds(column, unit)
    return round(odds if end is None else both(odds, end_odds(model, end)), DIGITS)


def margin(model: Ends, role: str, text: str | None) -> float:
    """The score less the threshold of the value's language and column; CERTAIN for a value without a word."""
    score = end_score(model, role, text)
    if score is None:
        return CERTAIN
    threshold = model.threshold.get((language(text), role))
    return score - (model.threshold.get(("", role), -3.0) if threshold is None else threshold)


def is_cut(model: Ends, role: str, text: str | None) -> bool:
    return margin(model, role, text) < 0


PLAN = "id long, turn int, role string, made boolean, lang string, long boolean, unit string, fixed double, word string, free boolean, kind string, rest string"


def plans(records: DataFrame) -> DataFrame:
    """records(id, turn, user, assistant) -> the ending of each value, and of a cut made of it (made)."""
    schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}[t]) for n, t in (c.split(" ") for c in PLAN.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, k, *pair in zip(*(c.to_pylist() for c in batch.columns)):
                for role, text in zip(("user", "assistant"), pair):
                    got = ending(role, text)
                    if got is None:
                        continue
                    lang, size = language(text), len(text) >= 40
                    out.append((i, k, role, False, lang, size, got[0], *(got[1] or End())))
                    made = ending(role, made_cut(role, text, f"{i} {k}")) if size else None
                    if made:
                        out.append((i, k, role, True, lang, size, made[0], *(made[1] or End())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * len(schema), schema.types)], schema=schema)

    return records.select("id", F.col("turn").cast("int"), "user", "assistant").mapInArrow(run, PLAN)


def asked_odds(asked: DataFrame, records: DataFrame) -> DataFrame:
    """asked(kind, context), records(user, assistant) -> (kind, context, odds, known): Ends.odds counted over all records, of the contexts
    of which any order has been seen LEAST times."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [context_keys(k, c) for k, c in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.list_(pa.int64()))], names=["kind", "context", "keys"])

    needs = materialize(asked.distinct().mapInArrow(keyed, "kind string, context string, keys array<long>"), "truncation-asked")
    bitmap = records.sparkSession.sparkContext.broadcast(key_bitmap(needs))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for batch in batches for pair in zip(*(c.to_pylist() for c in batch.columns)))
        for counts in summed_parts(pairs, np.frombuffer(bitmap.value, np.uint8)):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in counts], names=["key", "ends", "total"])

    counts = records.select("user", "assistant").mapInArrow(counted, "key long, ends long, total long")
    counts = counts.groupBy("key").agg(F.sum("ends").alias("ends"), F.sum("total").alias("total")).filter(F.col("total") >= LEAST)
    met = needs.select("kind", "context", F.posexplode("keys").alias("i", "key")).join(counts, "key")
    at = [F.max(F.when(F.col("i") == i, F.struct("ends", "total"))).alias(f"c{i}") for i in range(len(ORDERS))]
    met = met.groupBy("kind", "context").agg(*at)
    p, known, on = prior(F.col("kind")), F.lit(0), F.lit(True)
    q = 1 - p
    for i, order in enumerate(ORDERS):
        on = on & F.col(f"c{i}").isNotNull()
        ends, total = F.col(f"c{i}.ends"), F.col(f"c{i}.total")
        met = met.withColumns({f"{name}{i}": F.when(on, (n + MASS * x) / (total + MASS)).otherwise(x) for name, n, x in (("p", ends, p), ("q", total - ends, q))})
        p, q, known = F.col(f"p{i}"), F.col(f"q{i}"), F.when(on, order).otherwise(known)
    return met.select("kind", "context", (F.ln(p) - F.ln(q)).alias("odds"), known.alias("known"))


def prior(kind: Column) -> Column:
    return reduce(lambda rest, k: F.when(kind == k, PRIOR[k]).otherwise(rest), PRIOR, F.lit(0.5))


def parts(rows: Iterable[tuple[str | None, str | None]], size: int = 250_000) -> Iterator[list[tuple[str | None, str | None]]]:
    """The rows in runs of about size characters."""
    run, n = [], 0
    for r in rows:
        run.append(r)
        n += len(r[0] or "") + len(r[1] or "")
        if n >= size:
            yield run
            run, n = [], 0
    if run:
        yield run


def summed_parts(rows: Iterable[tuple[str | None, str | None]], wanted: np.ndarray) -> Iterator[Counts]:
    """contexts() of any number of rows, summed as far as some MOST counts are held at a time."""
    held, size = [], 0
    for part in parts(rows):
        for got in contexts(part, wanted):
            held.append(got)
            size += len(got[0])
            if size > MOST:
                held = [merged(held)]
                size = len(held[0][0])
                if size > MOST // 2:
                    yield held.pop()
                    size = 0
    if held:
        yield merged(held)


def scored(plan: DataFrame, odds: DataFrame, units: DataFrame) -> DataFrame:
    """plan with the column score, as end_score()."""
    start = prior(F.col("kind"))
    words = odds.filter("kind = 'word'").select(F.col("context").alias("word"), F.col("odds").alias("o1"), "known")
    rest = odds.filter("kind <> 'word'").select("kind", F.col("context").alias("rest"), F.col("odds").alias("o2"))
    of_word = F.when(F.col("free") & (F.coalesce("known", F.lit(0)) < KNOWN), CERTAIN).otherwise(F.coalesce("o1", F.lit(0.0)))
    of_rest = F.coalesce("o2", F.ln(start) - F.ln(1 - start))
    end = F.least("fixed", F.when(F.col("word").isNotNull(), of_word), F.when(F.col("rest").isNotNull(), of_rest))
    x = F.log1p(F.exp(-F.col("u"))) + F.log1p(F.exp(-F.col("e")))
    score = F.when(F.col("e").isNull(), F.col("u")).otherwise(F.when(x > 1e-12, -F.ln(F.expm1(x))).otherwise(25.0))
    plan = plan.join(words, "word", "left").join(rest, ["kind", "rest"], "left").join(F.broadcast(units), ["role", "unit"], "left")
    return plan.withColumn("u", F.coalesce("u", F.lit(0.0))).withColumn("e", end).withColumn("score", F.round(score, DIGITS))


def asked_of(plan: DataFrame) -> DataFrame:
    """The (kind, context) that endings ask for."""
    return plan.filter("word is not null").select(F.lit("word").alias("kind"), F.col("word").alias("context")).unionByName(plan.filter("rest is not null").select("kind", F.col("rest").alias("context")))


def unit_table(plan: DataFrame) -> tuple[Ends, DataFrame]:
    """The unit counts of all values (a few units), and their log odds u as a table (role, unit, u)."""
    model = Ends()
    real = plan.filter("not made and coalesce(fixed, length(word), length(rest)) is not null")
    for r in real.groupBy("role", "unit").count().collect():
        model.count_units(r["role"], r["unit"], r["count"])
    rows = [(column, unit, model.unit_odds(column, unit)) for column, unit in model.units]
    return model, plan.sparkSession.createDataFrame(rows, "role string, unit string, u double")


def score_thresholds(values: DataFrame) -> dict[tuple[str, str], float]:
    """values(lang, role, made, long, score) -> thresholds(), over a histogram of at most some ten thousand scores each."""
    seen = values.filter(F.col("long")).groupBy("lang", "role", "made", "score").count().collect()
    return thresholds(tuple(r) for r in seen)


def least_score(threshold: dict[tuple[str, str], float]) -> Column:
    """The threshold of a row of (lang, role)."""
    out = F.when(F.col("role") == "user", threshold.get(("", "user"), -3.0)).otherwise(threshold.get(("", "assistant"), -3.0))
    for (lang, role), t in threshold.items():
        if lang:
            out = F.when((F.col("lang") == lang) & (F.col("role") == role), t).otherwise(out)
    return out


def truncated(records: DataFrame) -> DataFrame:
    """records(id, user, assistant[, turn]) -> (id, role) of each cut message."""
    if "turn" not in records.columns:
        records = records.withColumn("turn", F.lit(0))
    plan = materialize(plans(records), "truncation-ends")
    values = scored(plan, asked_odds(asked_of(plan), records), unit_table(plan)[1])
    values = materialize(values.select("id", "role", "made", "lang", "long", "score"), "truncation-scores")
    return values.filter(~F.col("made") & (F.col("score") < least_score(score_thresholds(values)))).select("id", "role")

"""Noise in text from scanned pages (problem 6): repair by joint decoding of words, lines and paragraphs.

The text is one stream of tokens without line ends; what stood between two tokens only decides which moves
are open there. One Viterbi pass finds the cheapest reading of the stream, in negative log probabilities:

* a token stands for itself, for a word reached by confusions of the scanner (one cost each), or for two
  words run together (split), either of which may be misread;
* two tokens with a blank or line end between are one word (merge), or one broken at a line end with a hyphen
  or similar sign (hyphen); both are weighed against the sign being a dash between two words;
* a line inside the text is no part of it (skip), being a page number or a running header, and the word broken
  before it goes on after it. A header's cost comes from HEADERS, a word model of lines that interrupt a
  sentence and come again in the same source (page numbers aside), with the book catalogue as its prior; that
  is weighed against what the line's words cost as text, and the sentence it would interrupt.

Known words with known neighbours, no break and no line to skip near them can only stand for themselves; the
pass runs over the rest with a token on either side. Then paragraph boundaries between the lines left are
chosen by dynamic programming over break and join costs.

Kinds of noise found, all of them moves of the cheapest path: tire (hyphen), karakter (at least MISREAD words
decoded through confusions), ustbilgi (header skipped), sayfa_no (page number skipped, alone or in a header).

The lexicon holds every word of the corpus whose share of all words is at least RARE, counted over all
rows. A share does not change with the size of a corpus, so repairs do not, either; and as shares add up to
one there are at most 1/RARE entries. Where that asks for fewer than LEAST occurrences (a corpus of under
LEAST/RARE words), LEAST are asked for. The header model is bounded in the same way.

Null comes back as null without noise, texts without letters as they are.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derlem.llm.words import fold
from derlem.session import materialize

RARE, HEADER_RARE = 1e-5, 1e-4
LEAST = 3
MISREAD = 2
CONFUSIONS = 3  # letter pairs misread in one word, signs aside
KINDS = ("tire", "karakter", "ustbilgi", "sayfa_no")

HYPHENS = "-‑\u00ad¬=–‐"
HYPHEN_GAP = re.compile(rf"[{HYPHENS}][ \t\r]*\n\s*")
PAGE = re.compile(r"^\s*(?:\[\s?\d{1,4}\s?\]|([-–—~•])\s?\d{1,4}\s?\1|\d{1,4}\s?/\s?\d{1,4}|(?:s\.|sf\.|sayfa|page|p\.)\s?\d{1,4}|\d{1,4})\s*$", re.I)
NUMBER_SIDE = re.compile(r"^\s*(?:\d{1,4}\s{2,}(?=\S)|(?=\S.*\S\s{2,}\d{1,4}\s*$))")
SIDE_BEFORE, SIDE_AFTER = re.compile(r"^\s*\d{1,4}\s{2,}"), re.compile(r"\s{2,}\d{1,4}\s*$")
BOXED = re.compile(r"^\|\s?([^|]{3,70}?)\s?\|$")
PARTED = re.compile(r"^([^•/|]{3,60}?)\s[•/·]\s([^•/|]{3,60})$")
CHAPTER = re.compile(r"^b[öo]l[üu]m\s+\d{1,3}\s*[–\-—:.]\s*(\D{3,60})$", re.I)
LETTERS = re.compile(r"[^\W\d_]+")
LIST_LINE = re.compile(r"^\s*(?:\W{0,2}[A-Ea-e]\s*[).]\s|[•*+>#|!\\<{=]|-\s|\d{1,2}[.)]\s|```|</?think>)")
ENDING = re.compile(r"[.?!:…][\"'”’)*_~]*\s*$")
TOKEN = re.compile(r"[^\W_]+(?:[!€¢§]+[^\W_]+)*[€¢§]?|[!€¢§][^\W\d_]+(?:[!€¢§]+[^\W_]+)*")

#: fixed values: what the scanner made of a letter (folded: ı and i are one)
SIGNS = {"€": "e", "¢": "ç", "§": "ş", "!": "i", "ɑ": "a", "0": "o", "5": "s", "6": "b", "9": "g", "1": "li"}
LETTER_PAIRS = (("rn", "m"), ("cl", "d"), ("ri", "n"), ("ii", "ü"), ("l", "i"), ("q", "ğ"), ("q", "g"), ("ô", "ö"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("vv", "w"))
SUSPECT = re.compile(r"[€¢§!ɑ015 69qôﬁﬂl]|rn|cl|ri|ii|vv")
SIGN_IN_WORD = re.compile(r"[a-zçğıöşüâîû][015 69!](?=[a-zçğıöşüâîû])|[€¢§ɑ]")
COST_CONFUSION, COST_SPLIT, COST_MERGE, COST_CHAR, COMMON = 3.5, 5.0, 3.0, 1.1, 9.0
COST_HYPHEN, COST_DASH, COST_PAGE, COST_HEADER = 0.5, 4.0, 2.0, 9.0
STRANGE, TITLE, BONUS = 9.0, 2, 2.5  # a word no header has; weight of a catalogue word; what the look of a line adds


def candidates(word: str, most: int = CONFUSIONS) -> list[tuple[str, int]]:
    """(reading, confusions) of a folded word: signs are read as letters, up to `most` letter pairs may be."""
    base = [("", 0)]
    for c in word:
        base = [(b + x, n + 1) for b, n in base for x in SIGNS[c]] if c in SIGNS else [(b + c, n) for b, n in base]
    out, seen = [], set()
    for b, n in base:
        level = {(b, 0)}
        for more in range(most + 1):
            nxt = set()
            for s, start in level:
                if s not in seen:
                    seen.add(s)
                    out.append((s, n + more))
                if more < most:
                    for old, new in LETTER_PAIRS:
                        at = s.find(old, start)
                        while at >= 0:
                            nxt.add((s[:at] + new + s[at + len(old) :], at + len(new)))
                            at = s.find(old, at + 1)
            level = nxt
    return out


class Headers:
    """Costs of words as parts of a running header: counts {folded word: occurrences in repeated lines}, titles: words of
    the book catalogue, each a pseudo-count of TITLE."""

    def __init__(self, counts: dict[str, int], titles: frozenset[str] = frozenset()):
        words = counts.keys() | titles
        total = sum(counts.values()) + TITLE * len(titles) + 1
        self.cost = {w: -math.log((counts.get(w, 0) + TITLE * (w in titles)) / total) for w in words}
        self.longest = max(map(len, words), default=0)


class Decoder:
    """Decodes texts over a lexicon {folded word: (count, form)} and a header model."""

    def __init__(self, lexicon: dict[str, tuple[int, str]], headers: Headers | None = None):
        total = sum(n for n, _ in lexicon.values()) or 1
        self.cost = {w: -math.log(n / total) for w, (n, _) in lexicon.items()}
        self.form = {w: f for w, (_, f) in lexicon.items() if f != w}
        self.longest = max(map(len, lexicon), default=0)
        self.headers = headers or Headers({})
        self.memo: dict[str, tuple[str | None, float]] = {}
        self.titled: dict[str, float | None] = {}
        self.cuts: dict[str, tuple[float, tuple[str, str] | None]] = {}

    def unknown(self, word: str) -> float:
        return 9.0 + COST_CHAR * len(word)

    def reading(self, token: str) -> tuple[str | None, float]:
        """(the lexicon word a token misreads, or the token with its signs read; None if it stands for itself; cost)."""
        got = self.memo.get(token)
        if got is None:
            if len(self.memo) > 300_000:
                self.memo.clear()
            got = self.memo[token] = self._reading(token)
        return got

    def _reading(self, token: str) -> tuple[str | None, float]:
        w = fold(token)
        if w in self.cost:
            return None, self.cost[w]
        own = self.unknown(w)
        # a reading is shorter by its confusions at most, so longer tokens than that read as no word
        if len(w) < 3 or not SUSPECT.search(w) or len(w) - CONFUSIONS > self.longest:
            return None, own
        letters = sum(c.isalpha() for c in token)
        if letters < 2 or token[0].isupper() and any(c.isdigit() for c in token) and letters <= 3:
            return None, own
        best: tuple[str | None, float] = (None, own)
        for s, n in candidates(w):
            if s in self.cost and n and self.cost[s] + n * COST_CONFUSION < best[1]:
                best = s, self.cost[s] + n * COST_CONFUSION
        if best[0] is None and len(w) >= 4 and SIGN_IN_WORD.search(token):  # a name with a sign inside
            low = token.replace("I", "ı").replace("İ", "i").lower()
            s = "".join(SIGNS[c][0] if c in SIGNS else c for c in low)
            if s.isalpha():
                best = s, self.unknown(s) + COST_CONFUSION - 2
        return best

    def split(self, w: str) -> tuple[float, tuple[str, str] | None]:
        """(cost, the two common words) that a folded token runs together; one of them may be misread."""
        got = self.cuts.get(w)
        if got is None:
            got = math.inf, None
            if len(w) >= 7 and len(w) - 2 * CONFUSIONS <= 2 * self.longest:
                for cut in range(3, len(w) - 2):
                    parts, price = [], COST_SPLIT
                    a, b = w[:cut], w[cut:]
                    known = (a in self.cost) + (b in self.cost)
                    for x in (a, b) if known else ():
                        read, c = (x, self.cost[x]) if x in self.cost else self.reading(x)
                        if read is None or read not in self.cost or self.cost[read] >= COMMON:
                            break
                        parts.append(read)
                        price += c
                    if len(parts) == 2 and price < got[0]:
                        got = price, (parts[0], parts[1])
            if len(self.cuts) > 300_000:
                self.cuts.clear()
            self.cuts[w] = got
        return got

    def word(self, token: str) -> float:
        """What a token costs where it stands, as the best of its readings."""
        return min(self.reading(token)[1], self.split(fold(token))[0])

    def header_word(self, w: str) -> float | None:
        """What a folded word costs in a header, where it may be misread, too; None if no header has it."""
        cost = self.headers.cost
        c = cost.get(w)
        if c is not None or len(w) < 4 or len(w) - CONFUSIONS > self.headers.longest:
            return c
        if w not in self.titled:
            if len(self.titled) > 300_000:
                self.titled.clear()
            c = min((cost[x] + n * COST_CONFUSION for x, n in candidates(w) if x in cost), default=None)
            if c is None:
                c = min((p + COST_CONFUSION + 2 for x, p in cost.items() if abs(len(x) - len(w)) <= 1 and (x[:2] == w[:2] or x[-3:] == w[-3:]) and near(x, w)), default=None)
            self.titled[w] = c
        return self.titled[w]

    def header(self, line: str, tokens: list[str]) -> tuple[float, bool]:
        """(cost of the line's words as a running header, infinite if no header has any; whether a page number stands at its side)."""
        core = SIDE_AFTER.sub("", SIDE_BEFORE.sub("", line.strip()))
        numbered = core != line.strip()
        price, known = COST_HEADER + numbered, False
        for t in tokens:
            if t.isdigit():
                price += 1.0
                continue
            w = fold(t)
            c = self.header_word(w)
            known |= c is not None
            price += STRANGE + COST_CHAR * len(w) if c is None else c
        return price if known else math.inf, numbered

    def skips(self, text: str, marks: list[re.Match]) -> dict[int, tuple[int, float, str]]:
        """first token of a line -> (token after it, cost of taking the line for no part of the text, kinds)."""
        out: dict[int, tuple[int, float, str]] = {}
        lines = text.split("\n")
        at = k = 0
        for i, line in enumerate(lines):
            end = at + len(line)
            first = k
            while k < len(marks) and marks[k].start() < end:
                k += 1
            s = line.strip()
            if 0 < i < len(lines) - 1 and k > first and s and first:
                if PAGE.match(s):
                    if LETTERS.search(text):
                        out[first] = k, COST_PAGE, "sayfa_no"
                elif (s[0] == "|" or s[0].isupper() or s[0].isdigit() or "•" in s or "/" in s) and not LIST_OPTION.match(s) and not (ENDING.search(s) and not NUMBER_SIDE.match(line)):
                    words = [m[0] for m in marks[first:k]]
                    price, numbered = self.header(line, words)
                    before, after = lines[i - 1].strip(), lines[i + 1].strip()
                    if price < math.inf:
                        breaks = bool(before) and not ENDING.search(before) and not before.endswith(">")
                        framed = bool(BOXED.match(SIDE_AFTER.sub("", SIDE_BEFORE.sub("", s))) or PARTED.match(s) or CHAPTER.match(SIDE_AFTER.sub("", SIDE_BEFORE.sub("", s))))
                        # capitals stand out from small letters, a number stands at the side, bars and points part titles
                        price -= BONUS * (framed + numbered + (s.isupper() and not before.isupper() and not after.isupper()) + breaks)
                        out[first] = k, price, "ustbilgi,sayfa_no" if numbered else "ustbilgi"
            at = end + 1
        return out

    def stream(self, text: str, marks: list[re.Match]) -> list[tuple[int, int, str, object]]:
        """The moves of the cheapest path that are more than a token standing for itself, as (from token, to token, move, what)."""
        n, cost = len(marks), self.cost
        low = fold(text)
        words = [low[m.start() : m.end()] for m in marks] if len(low) == len(text) and unicodedata.is_normalized("NFC", text) else [fold(m[0]) for m in marks]
        skips = self.skips(text, marks) if "\n" in text else {}
        gaps = [text[marks[k].end() : marks[k + 1].start()] for k in range(n - 1)] + [""]
        open_ = [False] * n  # tokens at which more than one move is open
        for k in range(n):
            if words[k] not in cost and not words[k].isdigit():
                open_[max(k - 1, 0)] = open_[k] = True
                if k + 1 < n:
                    open_[k + 1] = True
            elif "\n" in gaps[k] and HYPHEN_GAP.match(gaps[k]):
                open_[k] = True
                if k + 1 < n:
                    open_[k + 1] = True
        for first, (to, _, _) in skips.items():
            for k in range(first - 1, min(to + 1, n)):
                open_[k] = True
        out: list[tuple[int, int, str, object]] = []
        k = 0
        while k < n:
            if not open_[k]:
                k += 1
                continue
            end = k
            while end < n and open_[end]:
                end += 1
            out += self.viterbi(k, end, marks, words, gaps, skips)
            k = end
        return out

    def viterbi(self, begin: int, end: int, marks: list[re.Match], words: list[str], gaps: list[str], skips: dict[int, tuple[int, float, str]]) -> list[tuple[int, int, str, object]]:
        cost = self.cost
        size = end - begin
        best = [0.0] + [math.inf] * size
        back: list[tuple[int, str, object]] = [(0, "", None)] * (size + 1)

        def move(k: int, to: int, price: float, name: str, what: object) -> None:
            if to <= size and best[k] + price < best[to]:
                best[to], back[to] = best[k] + price, (k, name, what)

        for k in range(size):
            g = begin + k
            token, w, gap = marks[g][0], words[g], gaps[g]
            read, c = self.reading(token)
            dash = COST_DASH if "\n" in gap and HYPHEN_GAP.match(gap) else 0.0
            move(k, k + 1, c + dash, "read" if read is not None else "", read)
            if g in skips:
                to, price, kinds = skips[g]
                move(k, to - begin, price, "skip", kinds)
            if w not in cost and w.isalpha():
                price, parts = self.split(w)
                if parts:
                    move(k, k + 1, price + dash, "split", parts)
            if g + 1 < len(marks) and gap.isspace() and w not in cost or g + 1 < len(marks) and gap.isspace() and words[g + 1] not in cost:
                joined = w + words[g + 1]
                if joined in cost:
                    move(k, k + 2, cost[joined] + COST_MERGE, "merge", joined)
            if dash:
                nxt, price, lost = g + 1, 0.0, ""
                while nxt in skips:
                    nxt, c, kinds = skips[nxt]
                    price, lost = price + c, lost + "," + kinds
                for after, add, kinds in {(g + 1, 0.0, ""), (nxt, price, lost)}:
                    if after < len(marks) and token[-1].isalpha() and marks[after][0][0].isalpha() and not (marks[after][0][0].isupper() and not token[-1].isupper()):
                        joined = w + words[after]
                        read, c = self.reading(token + marks[after][0])
                        move(k, after + 1 - begin, c + COST_HYPHEN + add, "hyphen", (after, read, kinds))
        out = []
        k = size
        while k > 0:
            start, name, what = back[k]
            if name:
                out.append((begin + start, begin + k, name, what))
            k = start
        return out[::-1]


def near(a: str, b: str) -> bool:
    """Edit distance at most 1."""
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or len(a) == len(b) and a[i + 1 :] == b[i + 1 :]


LIST_OPTION = re.compile(r"^\W{0,2}[A-Ea-e]\s*[).]\s|^[•*<\\{!#>]")


def like(token: str, word: str) -> str:
    """The word in the token's case."""
    if token.isupper() and len(token) > 1:
        return word.replace("i", "İ").upper()
    return word[:1].replace("i", "İ").upper() + word[1:] if token[:1].isupper() else word


def paragraphs(lines: list[str]) -> str:
    """Join lines to paragraphs: the cheapest sequence of break and join decisions."""
    lines = [x.strip() if not x.startswith("    ") else x for x in lines]
    width = max((len(x) for x in lines), default=0)
    # state: 0 joined to the line before, 1 a new line, 2 a new paragraph
    best = [(0.0, [])]
    out: list[str] = []
    score = [0.0, 0.0, 0.0]
    back: list[list[int]] = []
    for prev, x in zip(lines, lines[1:]):
        if not prev or not x:
            cost = [9.0, 4.0, 0.0]
        elif LIST_LINE.match(x) or LIST_LINE.match(prev) and (ENDING.search(prev) or len(prev) < 0.7 * width):
            cost = [6.0, 0.0, 3.0]
        else:
            ended, short, capital = bool(ENDING.search(prev)), len(prev) < 0.75 * width, x[:1].isupper()
            cost = [2.0 * ended * short + 0.5 * (ended and capital), 1.0 + 2.0 * (not ended) + 1.0 * (not short) + 1.0 * (not capital), 5.0]
        row, new = [], []
        for k in range(3):
            # joining right after a lone short line costs a little, whatever came before
            options = [score[j] + cost[k] + (0.2 if j == 0 and k == 1 else 0.0) for j in range(3)]
            j = min(range(3), key=options.__getitem__)
            row.append(j)
            new.append(options[j])
        back.append(row)
        score = new
    del best
    states = []
    k = min(range(3), key=score.__getitem__)
    for row in reversed(back):
        states.append(k)
        k = row[k]
    states.reverse()
    out.append(lines[0] if lines else "")
    for x, k in zip(lines[1:], states):
        if k == 0 and x:
            out[-1] = f"{out[-1]} {x}" if out[-1] else x
        elif x or (out and out[-1]):
            out.append(x)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")


def repair(text: str | None, decoder: Decoder, with_text: bool = True, every: bool = False) -> tuple[str | None, list[str]]:
    """(repaired text, kinds of noise); a text without noise comes back as it is.

    MISREAD decides what is reported. every: words are decoded also where nothing is, lines kept as they are.
    """
    if not text:
        return text, []
    text = text.replace("\r\n", "\n") if "\r" in text else text
    marks = list(TOKEN.finditer(text))
    moves = decoder.stream(text, marks)
    found: set[str] = set()
    misread = sum(name == "read" or name == "hyphen" and what[1] is not None for _, _, name, what in moves)
    edits: list[tuple[int, int, str]] = []  # (from, to, new text) in order

    def torn(a: int, b: int) -> bool:
        """Part of a word with a combining sign in it."""
        return any(unicodedata.category(c) in ("Mn", "Cf") for c in text[max(a - 1, 0) : a] + text[b : b + 1] if c not in HYPHENS)

    def form(word: str) -> str:
        return decoder.form.get(word, word)

    for i, j, name, what in moves:
        a, b = marks[i].start(), marks[j - 1].end()
        if name == "skip":
            found.update(what.split(","))
            begin = text.rfind("\n", 0, a) + 1
            end = text.find("\n", b)
            edits.append((begin, len(text) if end < 0 else end + 1, ""))
        elif name == "hyphen":
            found.add("tire")
            after, read, kinds = what
            found.update(k for k in kinds.split(",") if k)
            whole = marks[i][0] + marks[after][0]
            edits.append((a, b, like(whole, form(read)) if read is not None else whole))
        elif torn(a, b):
            continue
        elif name == "read":
            if misread >= MISREAD or what in decoder.cost:  # a lone reading needs a word of the lexicon behind it
                edits.append((a, b, like(marks[i][0], form(what))))
        elif name == "split":
            edits.append((a, b, like(marks[i][0], form(what[0])) + " " + form(what[1])))
        elif name == "merge":
            edits.append((a, b, like(marks[i][0], form(what))))
    if misread >= MISREAD:
        found.add("karakter")
    if not found and not (every and edits):
        return text, []
    if with_text:
        out, at = [], 0
        for a, b, new in edits:
            out += (text[at:a], new)
            at = b
        text = "".join(out) + text[at:]
        if found:
            text = paragraphs(text.replace("\r", "").split("\n"))
    return text, [k for k in KINDS if k in found]


def lexicon(texts: DataFrame) -> dict[str, tuple[int, str]]:
    """Words of texts(text) with at least RARE of all words and LEAST occurrences, at most 1/RARE of them:
    folded word -> (count, commonest form). A word that a far commoner one explains as misread is left out."""
    words = texts.select(F.explode(F.split(F.lower(F.translate("text", "İI", "iı")), r"[^\p{L}]+")).alias("w")).filter("w <> ''")
    counted = materialize(words.groupBy("w").agg(F.count("*").alias("n")), "scan-words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    out: dict[str, tuple[int, str]] = {}
    most: dict[str, int] = {}
    for r in counted.filter(F.col("n") >= max(LEAST, RARE * total)).collect():
        w = fold(r["w"])
        n, form = out.get(w, (0, r["w"]))
        out[w] = n + r["n"], r["w"] if r["n"] > most.get(w, 0) else form
        most[w] = max(r["n"], most.get(w, 0))
    return without_misread(out)


def without_misread(lexicon: dict[str, tuple[int, str]], factor: int = 20) -> dict[str, tuple[int, str]]:
    out = dict(lexicon)
    for w, (n, _) in lexicon.items():
        if len(w) >= 4 and SUSPECT.search(w) and any(k and s != w and lexicon.get(s, (0,))[0] >= factor * n for s, k in candidates(w)):
            del out[w]
    return out


def skeleton(text: Column) -> Column:
    """A line in folded letters, numbers as one sign, blanks collapsed."""
    low = F.lower(F.translate(F.trim(text), "İIı", "iii"))
    return F.trim(F.regexp_replace(F.regexp_replace(low, "[0-9]+", " "), r"[ \t\r]+", " "))


def header_words(texts: DataFrame) -> dict[str, int]:
    """texts(text, source) -> {folded word: occurrences} over lines that interrupt a sentence and come at two places of one
    source or more, numbers aside; words with at least HEADER_RARE of them. Counted over all rows."""
    lines = texts.filter(F.instr("text", "\n") > 0).select("source", F.split("text", "\n").alias("l"))
    # inside the text: after a line that does not end a sentence, before one that goes on small; starting otherwise itself
    near = F.transform("l", lambda x, i: F.struct(x.alias("x"), F.get("l", i - 1).alias("b"), F.get("l", i + 1).alias("a")))
    small, ended = r"^[ \t]*[a-zçğıöşü]", r"([.?!:…>][\"'”’)*_~]*|^)[ \t\r]*$"
    inside = F.filter(near, lambda r: r["b"].isNotNull() & r["a"].rlike(small) & ~r["b"].rlike(ended) & ~r["x"].rlike(small) & ~r["x"].rlike(ended) & ~r["x"].rlike(r"^\W{0,2}[A-Ea-e]\s*[).]\s|^[•*<\\{!#>]"))
    found = lines.select("source", F.explode(inside).alias("r")).select("source", skeleton(F.col("r.x")).alias("line"), F.xxhash64("r.b", "r.a").alias("h")).filter("line <> ''")
    again = found.distinct().groupBy("source", "line").agg(F.count("*").alias("n")).filter("n >= 2")  # copies of a text are one place
    words = again.select("n", F.explode(F.split("line", r"[^\p{L}]+")).alias("w")).filter("w <> ''")
    counted = materialize(words.groupBy("w").agg(F.sum("n").alias("n")), "scan-headers")
    total = counted.agg(F.sum("n")).first()[0] or 0
    out: dict[str, int] = {}
    for r in counted.filter(F.col("n") >= max(2, HEADER_RARE * total)).collect():
        out[fold(r["w"])] = out.get(fold(r["w"]), 0) + r["n"]
    return out


def repaired(texts: DataFrame, titles: frozenset[str] = frozenset(), with_text: bool = True) -> DataFrame:
    """texts(id, part, text[, source]) -> (id, part, kinds array<string>[, clean, changed])."""
    if "source" not in texts.columns:
        texts = texts.withColumn("source", F.lit(""))
    decoder = texts.sparkSession.sparkContext.broadcast((lexicon(texts), Headers(header_words(texts), titles)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = Decoder(*decoder.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            got = [repair(t, d, with_text, every=with_text) for t in texts]
            cols = [batch.column(0), batch.column(1), pa.array([k for _, k in got], pa.list_(pa.string()))]
            if with_text:
                cols += [pa.array([t for t, _ in got], pa.string()), pa.array([t != old for (t, _), old in zip(got, texts)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "part", "kinds", "clean", "changed"][: len(cols)])

    return texts.select("id", "part", "text").mapInArrow(run, "id long, part string, kinds array<string>" + ", clean string, changed boolean" * with_text)

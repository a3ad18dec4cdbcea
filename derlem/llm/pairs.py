"""Broken prompt and response pairs (problem 4): a linear-chain CRF tags the clauses of each response.

The explanation of a response (its text within <think>, or all of it) is cut into clauses, and each is
tagged answer, refusal, echo, foreign or unfinished by a conditional random field over features of the
clause: how many of its words the question holds and how much of the question the response repeats, function
words and character trigrams of Turkish against other languages, phrases of declining, sentence end, and the
odds of truncation.py that the response ends where it does. The shares of the tags in the explanation's
characters decide the pair's defect, and nothing but them.

The CRF is fitted on all rows and on the texts of known other languages, by gradients summed over blocks of a table in
which equal sequences are one with their number, and equal clauses of a block, too. Few blocks are summed in the driver, many by a job a gradient. vocabulary, trigrams and odds of ends are counted over all rows, too. What a training sequence is called does not come from its features: a
question put as the response is an echo, a response cut at a random place ends unfinished, a text of another
language is foreign, a sentence that declines a refusal. Responses as they are count as answers in a first
fit; a second one leaves those out of whose tags the first is not sure (DOUBT). All rows are judged.

Defects, one per pair, in this order: bos (no assistant message, null, or no clause with a word), ret,
kopya, yabanci_dil, yarim. A response to a missing or null question cannot be an echo.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple
from functools import cached_property, reduce
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derlem.llm import truncation
from derlem.llm.words import WORD, fold, words
from derlem.session import materialize

GROUP, CLAUSES = 1000, 50  # records that share foreign documents, and about how many of these
BLOCK, PART = 20_000, 50_000  # places of a block of sequences; sequences of a partition of blocks
HELD = 1 << 25  # blocks of so many bytes in all are summed in the driver
TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
BREAK = re.compile(r"(?<=[.!?…;])[\"'”’)*_~]*\s+|\s*[\r\n]+\s*")
LINES = re.compile(r"[\r\n]+")
STOP = re.compile(r"[.!?…;][\"'”’)*_~]*\s+")  # a BREAK within a line and what is before it
STOPS, CLOSERS = tuple(".!?…;"), "\"'”’)*_~"
CLOSING = tuple(CLOSERS)
OPENER = re.compile(r"^\W*(?:merhaba|selam|açıklama|aciklama|yanıt|cevap|soru|çözüm|gerekçe|tabii|elbette|hello|answer|explanation|question)\s*(?:[:.,!\-–]\s+|\n)", re.I)
ANSWER_LINE = re.compile(r"\s*(?:do[ğg]ru\s+cevap|correct answer)\s*:?\s*\(?[a-e]?\)?\s*$", re.I)
MARKUP = re.compile(r"<[^<>]{1,60}>|[*_~`#|]+|&[a-zA-Z]+;")
SIGN = re.compile(r"[<*_~`#|&]")

#: fixed values: function words that Turkish does not share
FOREIGN_WORDS = frozenset(
    "the of and is are was were to in that with for as by this be been from not which should when than about because these those it its or has have can "
    "i you we they he she sorry cannot am my your but there would will while after before between also only "
    "der die das und ist sind mit von den dem nicht ein eine einer man zu dass wird werden bei auf für sich zwischen auch wie oder als nach über deshalb "
    "le la les des est une et dans que qui pour avec sur pas ce cette donc aux du au il elle nous vous ne plus sont par entre "
    "el los las una y con por del se es no como este esta su para al lo sobre cuando más porque entre "
    "il gli della che di per non sono nel alla um uma não mais com os".split()
) - {"o", "en", "de", "da", "on", "an", "a", "ya", "ne", "ay", "has"}
TURKISH_WORDS = frozenset("ve ile bir bu için olan daha ise olarak yer alan göre da de en çok gibi kadar sonra önce ya veya ancak çünkü zira her ne ki o şu değil ama ilk son".translate(str.maketrans("ı", "i")).split())
#: the first person's inability or unwillingness, and phrases of declining, in folded letters; other persons do not count
REFUSAL = re.compile(
    r"[ae]m[ae]m\b|[ae]m[iuü]yorum\b|m[ae]y[ae]ca[ğg]im\b|m[iuü]yorum\b|\b(?:yetkili|uzman|doktor|hekim) de[ğg]ilim|\büzgünüm|\bmaalesef|\bne yazik ki"
    r"|\bdil modeli|\byapay zek|\bkurallarim|\bkaçin(?:mam gerek|iyorum|aca[ğg]im)|\buygun (?:bulm|de[ğg]il)|\bdo[ğg]ru olmaz|\btercih ediyorum|\breddediyorum|\bçözümsüz birak|\bmümkün de[ğg]il\b|\banlayişiniz|\byetkimi"
    r"|\b(?:i|we)(?:'m|’m| am| are)? (?:sorry|afraid|unable|not able|cannot|can't|can’t|can not|won't|must decline)|\bsorry\b|\b(?:as|being) an? (?:ai|assistant|language model)|\bnot something i can|\bcannot (?:help|assist|provide|answer)|\bunable to\b"
    r"|\bes tut mir leid|\bleider\b.{0,80}\bnicht\b|\bich kann\b.{0,80}\bnicht\b|\bdésolée?\b|\bje ne (?:peux|suis) pas|\bje regrette|\blo siento\b|\bno puedo\b|\blamento\b"
)
#: what a refusal adds: advice and offers to the reader
ADVICE = re.compile(r"m[ae]nizi? öner|\blütfen\b|\bisterseniz\b|\bmemnuniyetle\b|\byardimci ol|\bbaşvurunuz\b|\bbakiniz\b|\bdanişin|\bplease\b|\bconsult\b|\bhappy to help\b|\bbitte\b|\bteşekkür")
#: a response declines or advises with one of these; looking for them first spares the patterns most texts
REFUSAL_PARTS = (
    "emem", "amam", "emam", "amem", "miyorum", "muyorum", "müyorum", "ayaca", "eyece", "ilim", "üzgün", "maalesef", "yazik ki", "dil modeli", "yapay zek", "kurallarim", "kaçin",
    "uygun bulm", "uygun de", "ru olmaz", "ediyorum", "çözümsüz", "mümkün de", "anlayişiniz", "yetkimi", "sorry", "cannot", "can't", "can’t", "can not", "won't", "afraid", "not able", "unable",
    "must decline", "assistant", "n ai", "language model", "not something", "leid", "ich kann", "désol", "je ne", "je regrette", "lo siento", "no puedo", "lamento",
)
ADVICE_PARTS = ("öner", "lütfen", "isterseniz", "memnuniyetle", "yardimci", "başvurunuz", "bakiniz", "danişin", "please", "consult", "happy", "bitte", "teşekkür")
END = re.compile(r"[.!?…:;][\"'”’)*_~`\s]*$")
ENDS = tuple(".!?…:;")
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
REFUSAL_OTHERS = ("yeca", "yaca", " ai")  # each match of REFUSAL holds one of these or of its parts
#: one of these is within a word of each text that holds a part, or that REFUSAL or ADVICE matches
REFUSAL_PIECES, ADVICE_PIECES = (tuple({max(WORD.findall(p), key=len) for p in parts}) for parts in ((*REFUSAL_PARTS, *REFUSAL_OTHERS), ADVICE_PARTS))
TOKEN = re.compile(rf"{WORD.pattern}|\n")


def ended(text: str) -> bool:
    """Whether END is found, looked for from behind."""
    if text.endswith(ENDS):
        return True
    return not text[-1:].isalnum() and text.rstrip("\"'”’)*_~`" + SPACES).endswith(ENDS)

FEATURES = (
    "bias", "echo>=0.9", "echo>=0.7", "echo<0.5", "foreign>=2", "foreign>=4", "no turkish", "turkish", "vocabulary>=0.5", "vocabulary<0.2",
    "refusal", "advice", "first", "last", "no end", "short", "repeats>=0.4", "repeats>=0.6", "trigrams foreign", "trigrams turkish",
    "cut", "not cut by far",
)
D, K = len(FEATURES), len(TAGS)
AT = {name: 1 << i for i, name in enumerate(FEATURES)}
ECHO_05, ECHO_07 = AT["echo<0.5"], AT["echo>=0.7"]
ECHO_09 = ECHO_07 | AT["echo>=0.9"]
FAR = 3.0
DOUBT = math.log(0.8)


class Memo(dict):
    """of(key), kept for some keys."""

    def __init__(self, of: Callable[[str], float], most: int = 200_000):
        self.of, self.most = of, most

    def __missing__(self, key: str) -> float:
        if len(self) > self.most:
            self.clear()
        got = self[key] = self.of(key)
        return got

    def __reduce__(self) -> tuple:
        return Memo, (self.of, self.most)


class Trigrams:
    """Log odds per character of other languages against Turkish, from the character trigrams of two samples."""

    def __init__(self, turkish: Counter[str], other: Counter[str]):
        counts = [turkish, other]
        sizes = [sum(c.values()) + 5000 for c in counts]
        self.odds = {g: math.log((counts[1][g] + 0.5) / sizes[1]) - math.log((counts[0][g] + 0.5) / sizes[0]) for g in counts[0] | counts[1]}
        self.memo = Memo(self.of_word)

    @staticmethod
    def counted(texts: Iterable[str]) -> Counter[str]:
        """The trigrams of the words, each between spaces, once for each distinct word; BETWEEN counts those across two words, which no word asks for."""
        seen: Counter[str] = Counter()
        between = 0
        for w in map(words, texts):
            seen.update(w)
            between += max(0, len(w) - 1)
        out: Counter[str] = Counter({BETWEEN: between} if between else {})
        for word, n in seen.items():
            for g in trigrams(word):
                out[g] += n
        return out

    def of_word(self, word: str) -> float:
        return sum(self.odds.get(g, 0.0) for g in trigrams(word))

    def __call__(self, w: list[str]) -> float:
        """w: the words of a clause."""
        return reduce(add, map(self.memo.__getitem__, w), 0.0) / n if (n := sum(map(len, w))) else 0.0


BETWEEN = "  "


def trigrams(word: str) -> list[str]:
    t = f" {word} "
    return [t[i : i + 3] for i in range(len(word))]


def plain(text: str) -> str:
    """Without line-end hyphens and the commonest markup."""
    if "\n" in text:
        text = truncation.joined(text)
    return MARKUP.sub(" ", text) if SIGN.search(text) else text


def clauses(text: str) -> list[str]:
    text = plain(text)
    for _ in range(2):
        if opener := OPENER.match(text):
            text = text[opener.end() :]
    return lettered(broken(text))


def lettered(parts: list[str]) -> list[str]:
    return [c for c in parts if c[0].isalpha() or truncation.LETTER.search(c)]


def broken(text: str) -> list[str]:
    """BREAK.split() without empty parts, faster: line by line, from one STOP to the next."""
    if "\n" not in text and "\r" not in text:
        lines = [text]
    else:
        lines = LINES.split(text)
        for i, line in enumerate(lines):
            lines[i] = line = line.lstrip() if i == len(lines) - 1 else line.strip() if i else line.rstrip()
            if i < len(lines) - 1 and line.endswith(CLOSING) and (bare := line.rstrip(CLOSERS)).endswith(STOPS):
                lines[i] = bare
    out = []
    for line in lines:
        at = 0
        for m in STOP.finditer(line):
            out.append(line[at : m.start() + 1])
            at = m.end()
        out.append(line[at:])
    return [c for c in out if c]


def without_answer(body: str) -> str:
    """Without ANSWER_LINE."""
    return ANSWER_LINE.sub("", body) if may_answer(body) else body


def may_answer(body: str) -> bool:
    """ANSWER_LINE's words are among the last three."""
    tail = body.rstrip()[-60:].casefold()
    return "cevap" in tail or "answer" in tail or len(tail.split()) < 4


class Clause(NamedTuple):
    """What a clause's features have of the clause alone."""

    words: list[str]
    size: int
    bits: int
    open: bool
    declines: bool
    advises: bool


def read_clauses(texts: list[str], vocabulary: frozenset[str], trigrams: Trigrams) -> list[Clause]:
    """Clauses without line ends, all at once."""
    folded = fold("\n".join(texts))
    tokens = TOKEN.findall(folded)
    tokens.append("\n")
    at: dict[str, int] = {}
    every = np.fromiter((at.setdefault(t, len(at)) for t in tokens), np.int64, len(tokens))
    distinct = list(at)
    last = np.flatnonzero(every == at["\n"])  # each clause has its words and one line end
    first = np.concatenate([[0], last[:-1] + 1])

    def total(of: Iterable[float], kind: type) -> np.ndarray:
        x = np.fromiter(of, kind, len(distinct))
        x[at["\n"]] = 0
        return np.add.reduceat(x[every], first)

    n = np.maximum(1, last - first)
    foreign, turkish, known = (total(map(w.__contains__, distinct), np.int64) for w in (FOREIGN_WORDS, TURKISH_WORDS, vocabulary))
    turkish += np.fromiter(map(turkish_letters, texts), np.int64, len(texts))
    strange = total(map(trigrams.memo.__getitem__, distinct), float) / np.maximum(1, total(map(len, distinct), np.int64))
    kinds = [PIECES[w] for w in distinct]
    refuses, offers = (total([k & bit for k in kinds], np.int64) > 0 for bit in (1, 2))
    x = AT["bias"] + sum(
        AT[name] * on
        for name, on in (
            ("foreign>=2", foreign >= 2), ("foreign>=4", foreign >= 4), ("no turkish", turkish == 0), ("turkish", turkish >= 2), ("vocabulary>=0.5", known / n >= 0.5),
            ("vocabulary<0.2", known / n < 0.2), ("short", n <= 3), ("trigrams foreign", strange > 0.3), ("trigrams turkish", strange < -0.3),
        )
    )
    lines = folded.split("\n")
    declines, advises = [False] * len(texts), [False] * len(texts)
    for i in np.flatnonzero(refuses):
        declines[i] = any([p in lines[i] for p in REFUSAL_PARTS])
        if declines[i] or any([p in lines[i] for p in REFUSAL_OTHERS]):
            x[i] |= AT["refusal"] * bool(REFUSAL.search(lines[i]))
    for i in np.flatnonzero(offers):
        advises[i] = any([p in lines[i] for p in ADVICE_PARTS])
        x[i] |= AT["advice"] * bool(ADVICE.search(lines[i]))
    return [
        Clause(tokens[a:b], size, bits, not ended(text), declining, advising)
        for text, a, b, size, bits, declining, advising in zip(texts, first.tolist(), last.tolist(), n.tolist(), x.tolist(), declines, advises)
    ]


def turkish_letters(text: str) -> int:
    """How many there are, from 2 on perhaps fewer."""
    n = 0
    for c in "ışğİŞĞ":
        n += text.count(c)
        if n > 1:
            break
    return n


#: 1 for a word with one of REFUSAL_PIECES, 2 for one of ADVICE_PIECES, 3 for both
PIECES = Memo(lambda word: any([p in word for p in REFUSAL_PIECES]) + 2 * any([p in word for p in ADVICE_PIECES]))
UNSAID, UNADVISED = ~AT["refusal"], ~AT["advice"]


def features(parts: list[Clause], texts: list[str], asked: Question, odds: float, structured: bool = False) -> list[int]:
    """One number per clause, with a bit for each of FEATURES. texts: the clauses'; odds: log odds of the response's end less their threshold; structured: the text ends
    with a list item, row, value or reference."""
    question = asked.words
    echoes, common = [], 0
    for c, text in zip(parts, texts):
        echo = asked.echoes.get(text)
        if echo is None:
            echo = asked.echoes[text] = sum(map(question.__contains__, c.words)) / c.size if question else 0.0
        echoes.append(echo)
    if max(echoes) >= 0.7:  # of a question that no clause repeats, nothing is repeated
        stem = asked.stem
        again = len(stem.intersection(chain.from_iterable([c.words for c in parts]))) / len(stem) if stem else 0.0
        common = AT["repeats>=0.4"] * (again >= 0.4) | AT["repeats>=0.6"] * (again >= 0.6)
    out = [c.bits | common | (ECHO_05 if echo < 0.5 else 0 if echo < 0.7 else ECHO_07 if echo < 0.9 else ECHO_09) for c, echo in zip(parts, echoes)]
    if not any([c.declines for c in parts]):  # what declines without a part counts beside one with it
        out = [x & UNSAID for x in out]
    if not any([c.advises for c in parts]):
        out = [x & UNADVISED for x in out]
    out[0] |= AT["first"]
    out[-1] |= AT["last"] | AT["no end"] * (not structured and parts[-1].open) | AT["cut"] * (odds < 0) | AT["not cut by far"] * (odds > FAR)
    return out


def padded(xs: list[list[tuple[bool, ...]]], ys: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, T = len(xs), max(map(len, xs))
    x, y, mask = np.zeros((n, T, D)), np.zeros((n, T), int), np.zeros((n, T))
    for i, (a, b) in enumerate(zip(xs, ys)):
        x[i, : len(a)], y[i, : len(b)], mask[i, : len(a)] = a, b, 1
    return x, y, mask


class Crf:
    """Linear chain over K tags: emission weights [D, K], transitions [K, K], start [K]."""

    def __init__(self) -> None:
        self.w = np.zeros((D, K))
        self.t = np.zeros((K, K))
        self.s = np.zeros(K)
        self.memo: dict[tuple, list[int]] = {}

    def fit(self, xs: list[list[tuple[bool, ...]]], ys: list[list[int]], rounds: int = 100, rate: float = 0.4, ridge: float = 2e-4) -> Crf:
        """Maximum likelihood by full-batch Adam from the present weights; sequences of like length run together."""
        order = sorted(range(len(xs)), key=lambda i: len(xs[i]))
        parts = [padded([xs[i] for i in part], [ys[i] for i in part]) for part in np.array_split(order, min(8, len(order)))]
        return self.climb(lambda: [sum(x) for x in zip(*(self.gradient(*part) for part in parts))], len(xs), rounds, rate, ridge)

    def climb(self, gradient: Callable[[], list[np.ndarray]], size: int, rounds: int = 100, rate: float = 0.4, ridge: float = 2e-4) -> Crf:
        """gradient: the sum over size sequences at the present weights."""
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (self.w, self.t, self.s)]
        for step in range(1, rounds + 1):
            sums = gradient()
            for k, (par, (m1, m2)) in enumerate(zip((self.w, self.t, self.s), moments)):
                g = sums[k] / size - ridge * par
                m1 *= 0.9
                m1 += 0.1 * g
                m2 *= 0.99
                m2 += 0.01 * g * g
                par += rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        self.memo.clear()
        return self

    def gradient(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, number: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the log likelihood, summed over the sequences, each so many times, by forward-backward."""
        n, T = mask.shape
        number = np.ones(n) if number is None else number
        onehot = np.eye(K)[y] * mask[..., None]
        e = x @ self.w
        a, b = np.zeros((n, T, K)), np.zeros((n, T, K))
        a[:, 0] = self.s + e[:, 0]
        for t in range(1, T):
            m = a[:, t - 1, :, None] + self.t[None]
            top = m.max(1)
            a[:, t] = np.where(mask[:, t, None] > 0, top + np.log(np.exp(m - top[:, None]).sum(1)) + e[:, t], a[:, t - 1])
        for t in range(T - 2, -1, -1):
            m = self.t[None] + (e[:, t + 1] + b[:, t + 1])[:, None, :]
            top = m.max(2)
            b[:, t] = np.where(mask[:, t + 1, None] > 0, top + np.log(np.exp(m - top[..., None]).sum(2)), 0.0)
        top = a[:, -1].max(1)
        z = top + np.log(np.exp(a[:, -1] - top[:, None]).sum(1))
        p = np.exp(a + b - z[:, None, None]) * mask[..., None]
        joint = np.exp(a[:, :-1, :, None] + self.t + (e[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
        pair = np.einsum("n,ntj,ntk->jk", number, onehot[:, :-1], onehot[:, 1:])
        diff = (onehot - p) * number[:, None, None]
        return x.reshape(n * T, D).T @ diff.reshape(n * T, K), pair - np.einsum("n,ntjk->jk", number, joint), diff[:, 0].sum(0)

    def likelihood(self, x: list[tuple[bool, ...]], y: list[int]) -> float:
        """Log probability of the tags, per clause."""
        e = np.array(x, float) @ self.w
        a, path = self.s + e[0], self.s[y[0]] + e[0, y[0]]
        for t in range(1, len(y)):
            m = a[:, None] + self.t
            a = m.max(0) + np.log(np.exp(m - m.max(0)).sum(0)) + e[t]
            path += self.t[y[t - 1], y[t]] + e[t, y[t]]
        return float(path - a.max() - np.log(np.exp(a - a.max()).sum())) / len(y)

    def tag(self, x: list[tuple[bool, ...]]) -> list[int]:
        """Viterbi; sequences of equal features are decoded once."""
        key = tuple(x)
        if key not in self.memo:
            if len(self.memo) > 20_000:
                self.memo.clear()
            self.memo[key] = self.viterbi(np.array(x, float))
        return self.memo[key]

    def viterbi(self, x: np.ndarray) -> list[int]:
        e = x @ self.w
        score, back = self.s + e[0], []
        for t in range(1, len(x)):
            m = score[:, None] + self.t
            back.append(m.argmax(0))
            score = m.max(0) + e[t]
        path = [int(score.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


#: seeds of the made training sequences; {} takes a term of the question
REFUSAL_SEEDS = (
    "Üzgünüm, bu soruyu yanıtlayamam.", "Maalesef {} hakkında açıklama yapamıyorum.", "Bu konuda yardımcı olamayacağım.", "Ne yazık ki bu isteği karşılayamam.",
    "Yeterli bilgim yok, yorum yapmayı uygun bulmuyorum.", "Bir yapay zekâ olarak tıbbi görüş veremem.", "{} için değerlendirme yapmaya yetkili değilim.", "Yanıt vermekten kaçınıyorum.",
    "Bu hasta için tanı koyamam.", "{} ile ilgili yorum yapamam.", "Bu olgu ile ilgili açıklama yapmaya yetkili değilim.", "{} tanısı ve tedavisi için görüş bildiremem.", "Bu soru için açıklama yazmayacağım.",
    "I'm sorry, but I can't answer this.", "As an AI assistant I am unable to discuss {}.", "Es tut mir leid, ich kann diese Frage nicht beantworten.", "Je suis désolé, je ne peux pas répondre.", "Lo siento, no puedo responder a esta pregunta.",
)
ADVICE_SEEDS = ("Lütfen bir doktora danışınız.", "İsterseniz başka bir soru sorabilirsiniz.", "Bir uzmana görünmenizi öneririm.", "Please consult a physician.")
FOREIGN_SEEDS = (
    "The {} is often seen together with other findings in these patients.", "Because of this, the second option should be rejected.", "It was described in about half of the cases by the authors.", "This answer is the only one that fits.",
    "Man findet {} häufig bei diesen Patienten und sollte es nicht verwechseln.", "Deshalb ist die zweite Antwort nicht richtig.", "Der Abschnitt über {} erklärt das genauer.",
    "Le {} est souvent associé à une autre maladie dans ce cas.", "Cette réponse est donc la seule qui convienne.", "Il ne faut pas confondre les deux signes.",
    "El {} se relaciona con la enfermedad en la mayoría de los casos.", "Por eso esta respuesta es la correcta.", "No se debe confundir con el otro signo.",
)


class Question:
    def __init__(self, text: str | None):
        self.text = text or ""
        self.plain = plain(self.text)
        self.listed = words(self.plain)
        self.words = frozenset(self.listed)
        self.echoes: dict[str, float] = {}  # share of a clause's words that the question holds

    @cached_property
    def stem_text(self) -> str:
        return truncation.option_spans(self.text)[0]

    @cached_property
    def stem_parts(self) -> list[str]:
        return clauses(self.stem_text)

    def told_stem(self) -> list[str] | None:
        """The clauses of a response of the stem, begun by an opener or not, where they are those of the stem; None where they have to be read."""
        stem = self.stem_text
        same = stem and stem[0].isalnum() and ends_alike(stem) and not SIGN.search(stem) and not truncation.BROKEN.search(f"{stem}\n")
        return self.stem_parts if same and not OPENER.match(f"{stem}\n") and not may_answer(stem) else None

    @cached_property
    def terms(self) -> list[str]:
        return [w for w in (self.listed if self.plain == self.text else words(self.text)) if len(w) > 5] or ["x"]

    @cached_property
    def stem(self) -> frozenset[str]:
        return frozenset(words(plain(self.stem_text)))


class Judge:
    """The fitted model with all that judging a pair needs."""

    def __init__(self, ends: truncation.Ends, vocabulary: frozenset[str], trigrams: Trigrams):
        self.ends, self.vocabulary, self.trigrams, self.crf = ends, vocabulary, trigrams, Crf()
        self.memo: dict[str, Clause] = {}
        self.last: tuple[str | None, Question] = None, Question(None)

    def asked(self, user: str | None) -> Question:
        """A row's question is read once for all of its responses."""
        if self.last[0] != user:
            self.last = user, Question(user)
        return self.last[1]

    def clauses(self, parts: list[str]) -> list[Clause]:
        self.learn(parts)
        return [self.memo[c] for c in parts]

    def learn(self, parts: Iterable[str]) -> None:
        """Reads what is not in memory."""
        new = list(dict.fromkeys(c for c in parts if c not in self.memo))
        if new:
            if len(self.memo) > 20_000:
                self.memo.clear()
                new = list(dict.fromkeys(parts))
            self.memo.update(zip(new, read_clauses(new, self.vocabulary, self.trigrams)))

    def read(self, user: str | None, assistant: str, odds: float | None = None) -> tuple[list[str], list[int]]:
        """The clauses of the explanation and their features; odds: in place of the model's."""
        body = without_answer(truncation.explanation(assistant)[0])
        parts = clauses(body)
        if not parts:
            return parts, []
        odds = truncation.margin(self.ends, "assistant", assistant) if odds is None else odds
        found = self.clauses(parts)
        return parts, features(found, parts, self.asked(user), odds, found[-1].open and structured(body))

    def coverage(self, user: str | None, assistant: str | None) -> dict[str, float]:
        """Share of each tag in the explanation's characters; empty without a clause."""
        parts, seen = self.read(user, assistant) if assistant else ([], [])
        size = sum(map(len, parts))
        out: dict[str, float] = {}
        for c, k in zip(parts, self.crf.tag(list(map(tuple, unpacked(seen)))) if seen else []):
            out[TAGS[k]] = out.get(TAGS[k], 0.0) + len(c) / size
        return out

    def defect(self, user: str | None, assistant: str | None) -> str | None:
        return worst(self.coverage(user, assistant))


#: least coverage of a tag that makes the pair defective, in order; an unfinished end is a defect at any length
DEFECTS = (("refusal", 0.5, "ret"), ("echo", 0.5, "kopya"), ("foreign", 0.6, "yabanci_dil"), ("unfinished", 1e-12, "yarim"))


def worst(share: dict[str, float]) -> str | None:
    if not share:
        return "bos"
    for tag, least, name in DEFECTS:
        if share.get(tag, 0.0) >= least:
            return name
    return None


def structured(body: str) -> bool:
    last = body.rstrip().rsplit("\n", 1)[-1]
    return bool(truncation.is_item(last) or truncation.is_row(last) or truncation.VALUE.search(last) or truncation.is_reference(last.strip()) or truncation.ends_in_markup(last))


class Lesson(NamedTuple):
    """A training response: the tag of its clauses, that of the last one and, at some places, another; whether made of the answer. parts: its clauses, where
    they are known without reading it."""

    response: str
    tag: int
    last: int | None
    at: range
    other: int
    own: bool
    parts: list[str] | None


def taught(asked: Question, assistant: str, pool: list[str], rng: np.random.Generator, own: list[str] | None = None) -> list[Lesson]:
    """The training responses of a row. pool: clauses of other languages; own: those of the response, where they are known."""
    out: list[Lesson] = []
    real, user = True, asked.text

    def add(response: str, tag: int, last: int | None = None, at: range = range(0), other: int = 0, parts: list[str] | None = None) -> None:
        out.append(Lesson(response, tag, last, at, other, real, parts))

    def framed(text: str) -> str:
        return f"<think>\n{text}\n</think>\n\nDoğru cevap: {'ABCDE'[int(rng.integers(5))]}"

    terms = asked.terms
    term = terms[int(rng.integers(len(terms)))]
    pick = lambda seeds: seeds[int(rng.integers(len(seeds)))].replace("{}", term)
    wrap = framed if rng.random() < 0.7 else str
    body = truncation.explanation(assistant)[0].strip()
    add(assistant, 0)
    own, stem = clauses(body) if own is None else own, asked.stem_text
    simple = bool(own) and not SIGN.search(body) and not OPENER.match(body) and not truncation.BROKEN.search(body)  # its clauses stand in it as they are
    for c in own[:1]:
        add(framed(" ".join(c.split()[: int(rng.integers(2, 5))]).rstrip(".,;:") + "."), 0)  # short, but complete
    if len(body) > 60:
        whole = assistant if rng.random() < 0.5 else f"<think>\n{body}"
        at = int(rng.integers(30, len(body)))
        cut = f"<think>\n{body[:at]}" if whole != assistant else framed(body[:at])
        if body[at - 1].isalnum() and body[at : at + 1].isalnum():  # inside a word: unfinished for certain
            add(cut, 0, 4, parts=before(own, body, at) if simple else None)
    if len(own) > 2:  # an answer may begin with a sentence of the question or quote one of another language
        told, first = " ".join(own), next(iter(asked.stem_parts), None)
        again = lettered(broken(f"\n{told}\n")) if simple and len(told) >= 60 and not may_answer(told) and not told[0].isspace() else []
        if first and ended(first):
            add(framed(f"{first} {told}"), 0, at=range(1), other=2, parts=[first, *again] if again and starts(first) else None)
        quoted = pool[int(rng.integers(len(pool)))] if pool else pick(FOREIGN_SEEDS)
        if ended(own[0]) and ended(quoted):
            known = again and starts(own[0]) and quoted.endswith(STOPS) and not quoted[0].isspace() and not SIGN.search(quoted)
            add(framed(f"{own[0]} {quoted} {' '.join(own[1:])}"), 0, at=range(1, 2), other=3, parts=[own[0], quoted, *again[1:]] if known else None)
    real = False
    begun, of_stem = rng.random() < 0.3, rng.random() < 0.6
    add(wrap(("Açıklama: " if begun else "") + (stem if of_stem else user)), 2, parts=asked.told_stem() if of_stem else None)
    said = [pick(REFUSAL_SEEDS)] + [pick(ADVICE_SEEDS)] * int(rng.integers(2))
    add(wrap(" ".join(said)), 1, parts=as_told(said))
    said = [pool[int(rng.integers(len(pool)))] if pool else pick(FOREIGN_SEEDS) for _ in range(int(rng.integers(2, 6)))]
    add(wrap(" ".join(said)), 3, parts=as_told(said))
    return out


def before(own: list[str], body: str, at: int) -> list[str] | None:
    """The clauses of body up to at, a place inside a word, where body holds its clauses own as they are; None where they have to be read."""
    head = body[:at]
    if may_answer(head) or OPENER.match(f"{head}\n"):
        return None
    p = 0
    for i, c in enumerate(own):
        p = body.index(c, p)
        if p + len(c) >= at:
            return [*own[:i], head[p:]]
        p += len(c)
    return None


def as_told(parts: list[str]) -> list[str] | None:
    """The clauses of a response that tells these one after another, where they are the same; None where they have to be read."""
    return parts if all(map(starts, parts)) and not may_answer(" ".join(parts)) else None


def starts(clause: str) -> bool:
    """Whether a text that begins with the clause and a space has it as its first one."""
    return clause.endswith(STOPS) and not clause[0].isspace() and not SIGN.search(clause) and not OPENER.match(f"{clause} ")


def tags(n: int, tag: int, last: int | None, at: range, other: int) -> list[int]:
    """Of a training response of n clauses."""
    return [other if i in at else tag for i in range(n - 1)] + [tag if last is None else last]


def told_words(texts: Iterable[str | None]) -> Counter[str]:
    """Responses per word of their explanations."""
    out: Counter[str] = Counter()
    for a in texts:
        if a:
            out.update(set(words(truncation.explanation(a)[0])))
    return out


def fit(rows: list[tuple[str | None, str | None]], foreign: list[str] = []) -> Judge:
    """The model of rows (user content, assistant content) in memory; foreign: texts of other languages, FOREIGN_SEEDS where there are none."""
    vocabulary = frozenset(w for w, n in told_words(a for _, a in rows).items() if n >= max(3, len(rows) // 200))
    others = foreign or [s.replace("{}", "") for s in FOREIGN_SEEDS]
    judge = Judge(truncation.fit(rows), vocabulary, Trigrams(Trigrams.counted(u for u, _ in rows if u), Trigrams.counted(others)))
    rng = np.random.default_rng(4)
    xs: list[list[tuple[bool, ...]]] = []
    ys: list[list[int]] = []
    real: list[tuple[int, list[int]]] = []
    pool = [c for t in foreign for c in clauses(t)]
    for user, assistant in rows:
        if not user or not assistant:
            continue
        for response, *how, own, _ in taught(judge.asked(user), assistant, pool, rng):
            x = judge.read(user, response)[1]
            if x:
                xs.append(list(map(tuple, unpacked(x))))
                ys.append(tags(len(x), *how))
                real += [(len(xs) - 1, ys[-1])] * own
    if xs:
        judge.crf.fit(xs, ys)
        wrong = {i for i, y in real if judge.crf.likelihood(xs[i], y) < DOUBT}
        if len(wrong) < 0.5 * len(real):
            judge.crf.fit([x for i, x in enumerate(xs) if i not in wrong], [y for i, y in enumerate(ys) if i not in wrong])
    return judge


def counted(rows: DataFrame, count: Callable[[list], Counter[str]], least: int = 1) -> Counter[str]:
    """The sums of count over all rows of one text column; those under least are not sent to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = count([t for t in batch.column(0).to_pylist() if t])
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["key", "n"])

    sums = rows.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return Counter({r["key"]: r["n"] for r in sums.collect()})


def packed(x: list[tuple[bool, ...]]) -> list[int]:
    return [sum(1 << i for i, on in enumerate(f) if on) for f in x]


def unpacked(x: np.ndarray) -> np.ndarray:
    return (np.asarray(x, np.int32)[..., None] >> np.arange(D) & 1).astype(float)


NO_END = truncation.End()
HELD_ROWS = 4000  # responses whose clauses are read at once


class Seen(NamedTuple):
    """What a response's row needs."""

    parts: list[str]
    body: str
    asked: Question
    got: tuple[str, truncation.End | None] | None
    lang: str


def ends_alike(text: str) -> bool:
    """Whether its last clause is the same before a line end, before none and without the white space behind it."""
    bare = text.rstrip()
    return bare[-1:] not in CLOSERS and (len(bare) == len(text) or "\n" in text[len(bare) :])


def stripped(text: str, body: str) -> bool:
    """Whether the clauses of a response's body, as it was read, are those of its explanation without white space around it."""
    bare = body.strip()
    return bool(bare) and truncation.explanation(text)[0] == body and (body[0] == "\n" or not body[0].isspace()) and ends_alike(body) and not SIGN.search(bare) and not OPENER.match(body)


SEEN = truncation.PLAN + ", n int, x array<int>, y array<int>, own boolean, sizes array<int>"


def sequences(records: DataFrame, foreign: DataFrame, judge: Judge) -> DataFrame:
    """records(id, turn, user, assistant), foreign(id, text) -> for each response (n = 0), a cut made of it (-1) and its training responses (1 and
    up) the ending and the features, the odds of its end left open."""
    shared = records.sparkSession.sparkContext.broadcast(judge)
    size, texts = records.count(), foreign.count()
    groups = max(1, size // GROUP, texts // GROUP)
    copies = min(groups, max(1, math.ceil(CLAUSES * groups / max(1, texts))))
    place = F.pmod(F.xxhash64("id"), F.lit(groups))
    left = records.withColumn("g", place).select("g", "id", F.col("turn").cast("int"), "user", "assistant")
    right = foreign.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), lambda j: F.pmod(F.xxhash64("id") + j, F.lit(groups)))).alias("g"), "id", "text")

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        judge = shared.value
        pool = [c for _, t in sorted(zip(other.column("id").to_pylist(), other.column("text").to_pylist())) for c in clauses(t)]
        out = []

        def seen(user: str | None, text: str | None, parts: list[str] | None = None, optionless: bool = False) -> Seen:
            """parts: its clauses, where they are known; optionless: it is known to have no options."""
            if not text:
                return Seen([], "", judge.asked(user), None, truncation.language(""))
            body, after = truncation.explanation(text)
            got = truncation.response_ending(text, body, after, optionless)
            if parts is None:
                body = without_answer(body)
                parts = clauses(body)
            return Seen(parts, body, judge.asked(user), got, truncation.language(text))

        held: list[tuple] = []

        def flush() -> None:
            judge.learn([c for *_, found in held for c in found.parts])
            for *head, n, how, own, found in held:
                clauses_ = [judge.memo[c] for c in found.parts]
                x = features(clauses_, found.parts, found.asked, 0.0, clauses_[-1].open and structured(found.body)) if clauses_ else []
                if n <= 0 or x:
                    unit, end = found.got or (None, None)
                    out.append((*head, unit, *(end or NO_END), n, x, tags(len(x), *how) if how and x else None, own, list(map(len, found.parts))))
            held.clear()

        for i, k, user, text in zip(*(one.column(c).to_pylist() for c in ("id", "turn", "user", "assistant"))):
            size = len(text or "") >= 40
            none = not truncation.may_have_options(truncation.explanation(text)[0]) if text else False
            real = seen(user, text, None, none)
            held.append((i, k, "assistant", False, real.lang, size, 0, [], False, real))
            if size and real.got:
                cut = seen(user, truncation.made_cut("assistant", text, f"{i} {k}"), [], none)
                if cut.got:
                    held.append((i, k, "assistant", True, real.lang, True, -1, [], False, cut))
            if user and text:
                own = real.parts if stripped(text, real.body) else None
                for n, (response, *how, of, parts) in enumerate(taught(real.asked, text, pool, np.random.default_rng([4, i & (1 << 63) - 1, k]), own), 1):
                    found = real if n == 1 else seen(user, response, parts, none and how[1] == 4)  # the first training response is the row's own
                    held.append((i, k, "assistant", False, found.lang, False, n, how, of, found))
            if len(held) > HELD_ROWS:
                flush()
        flush()
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "array<int>": pa.list_(pa.int32())}
        schema = pa.schema([(n, kinds[t]) for n, t in (c.split(" ") for c in SEEN.split(", "))])
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * len(schema), schema.types)], schema=schema)

    return left.groupBy("g").cogroup(right.groupBy("g")).applyInArrow(run, SEEN)


BLOCKS = "x binary, at binary, n binary, t int, gold array<double>"


def block(rows: list[tuple[list[int], list[int], int]]) -> tuple:
    """(x, y, number) of sequences of like length -> the distinct clauses, each sequence's places among them (-1: over), the numbers, the length, and
    the part of the gradient that no weight changes."""
    T = max(len(x) for x, _, _ in rows)
    seqs, y, number = np.full((len(rows), T), -1, np.int32), np.zeros((len(rows), T), int), np.array([n for _, _, n in rows], float)
    for i, (a, b, _) in enumerate(rows):
        seqs[i, : len(a)], y[i, : len(b)] = a, b
    live = seqs >= 0
    distinct = np.unique(seqs[live])
    at = np.where(live, np.searchsorted(distinct, seqs), -1).astype(np.int32)
    weight = number[:, None] * live
    counts = np.bincount((at * K + y)[live], weight[live], len(distinct) * K).reshape(-1, K)
    moves = np.bincount((y[:, :-1] * K + y[:, 1:])[live[:, 1:]], weight[:, 1:][live[:, 1:]], K * K)
    gold = np.concatenate([(unpacked(distinct).T @ counts).ravel(), moves, np.bincount(y[:, 0], number, K)])
    return distinct.tobytes(), at.tobytes(), number.tobytes(), T, gold.tolist()


def expected(crf: Crf, x: bytes, at: bytes, n: bytes, T: int) -> np.ndarray:
    """The other part: what the weights expect of a block, by forward-backward with each place scaled."""
    return expected_of(crf, *opened(x, at, n, T))


def opened(x: bytes, at: bytes, n: bytes, T: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray | None]]:
    """What no weight changes: the clauses, the numbers, and for each place the clauses of the sequences and which of these are as long (None: all)."""
    places = np.ascontiguousarray(np.frombuffer(at, np.int32).reshape(-1, T).T)
    live = [None if p.all() else p for p in places >= 0]
    return unpacked(np.frombuffer(x, np.int32)), np.frombuffer(n, float), list(np.maximum(places, 0).astype(np.intp)), live


def expected_of(crf: Crf, clauses_: np.ndarray, number: np.ndarray, places: list[np.ndarray], live: list[np.ndarray | None]) -> np.ndarray:
    e = clauses_ @ crf.w
    e, move, start = np.exp(e - e.max(1, keepdims=True)), np.exp(crf.t - crf.t.max()), np.exp(crf.s - crf.s.max())
    by_tag, back, T = np.ascontiguousarray(e.T), np.ascontiguousarray(move.T), len(places)
    e = [np.take(by_tag, p, axis=1) for p in places]  # by place, tag and sequence
    a, one = [start[:, None] * e[0]], np.ones(K)
    a[0] /= one @ a[0]
    for t in range(1, T):
        a.append(back @ a[-1])
        a[t] *= e[t]
        a[t] /= one @ a[t]
    b, pair, counts = np.ones(a[0].shape), np.zeros((K, K)), np.zeros((K, len(clauses_)))
    for t in range(T - 1, -1, -1):
        if t < T - 1:
            ahead = e[t + 1]
            ahead *= b
            b = move @ ahead
            if live[t + 1] is not None:
                b = np.where(live[t + 1], b, 1.0)
        p = a[t] * b
        weight = number / (one @ p)
        if t < T - 1:
            a[t] *= weight if live[t + 1] is None else weight * live[t + 1]
            pair += a[t] @ ahead.T
            b /= one @ b
        p *= weight if live[t] is None else weight * live[t]
        for k in range(K):
            counts[k] += np.bincount(places[t], p[k], len(clauses_))
    return np.concatenate([(clauses_.T @ counts.T).ravel(), (pair * move).ravel(), p.sum(1)])


def blocks(taught: DataFrame) -> DataFrame:
    """taught(x, y, count) -> blocks of about BLOCK places of sequences of like length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # by length up to an eighth

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(block(rows), types)], names=["x", "at", "n", "t", "gold"])

        types, full = (pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.float64())), 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                size = len(row[0])
                step = 1 << max(0, size.bit_length() - 4)
                key = -(-size // step) * step
                held.setdefault(key, []).append(row)
                full += size
                if len(held[key]) * key >= BLOCK:
                    full -= sum(len(r[0]) for r in held[key])
                    yield out(held.pop(key))
            if full > 20 * BLOCK:
                yield from map(out, held.values())
                held, full = {}, 0
        yield from map(out, held.values())

    few = taught.coalesce(max(1, math.ceil(taught.count() / PART)))
    return materialize(few.select("x", "y", F.col("count").cast("int")).mapInArrow(run, BLOCKS), "pairs-blocks")


def climb(crf: Crf, parts: DataFrame, size: int) -> None:
    """Crf.fit() over blocks()."""
    shapes = [crf.w.shape, crf.t.shape, crf.s.shape]
    gold = np.zeros(sum(map(math.prod, shapes)))
    for r in parts.mapInArrow(sums_of(lambda gold, **_: np.array(gold)), "g array<double>").collect():
        gold += r["g"]
    size_held = parts.agg(F.sum(F.length("at") + F.length("x"))).first()[0] or 0
    held = [opened(*tuple(r)[:4]) for r in parts.collect()] if size_held <= HELD else None

    def gradient() -> list[np.ndarray]:
        if held is None:
            got = [r["g"] for r in parts.mapInArrow(sums_of(lambda x, at, n, t, **_: expected(crf, x, at, n, t)), "g array<double>").collect()]
        else:
            got = [expected_of(crf, *b) for b in held]
        cuts = np.cumsum([math.prod(x) for x in shapes])[:-1]
        return [x.reshape(shape) for x, shape in zip(np.split(gold - np.sum(got, axis=0), cuts), shapes)]

    crf.climb(gradient, size)


def sums_of(of: Callable[..., np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over blocks: the sum of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for x, at, n, t, gold in zip(*(c.to_pylist() for c in batch.columns)):
                total = total + of(x=x, at=at, n=n, t=t, gold=gold)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["g"])

    return run


def likelihoods(crf: Crf, xs: list[list[int]], ys: list[list[int]]) -> np.ndarray:
    """Crf.likelihood() of many sequences; those of like length run together."""
    out, order = np.zeros(len(xs)), sorted(range(len(xs)), key=lambda i: len(xs[i]))
    for at in range(0, len(order), 500):
        part = order[at : at + 500]
        size = np.array([len(xs[i]) for i in part])
        x, y = np.zeros((len(part), size[-1]), np.int32), np.zeros((len(part), size[-1]), int)
        for j, i in enumerate(part):
            x[j, : size[j]], y[j, : size[j]] = xs[i], ys[i]
        e, rows = unpacked(x) @ crf.w, np.arange(len(part))
        a, path = crf.s + e[:, 0], crf.s[y[:, 0]] + e[rows, 0, y[:, 0]]
        for t in range(1, size[-1]):
            m = a[:, :, None] + crf.t
            top = m.max(1)
            live = t < size
            a = np.where(live[:, None], top + np.log(np.exp(m - top[:, None]).sum(1)) + e[:, t], a)
            path += np.where(live, crf.t[y[:, t - 1], y[:, t]] + e[rows, t, y[:, t]], 0.0)
        top = a.max(1)
        out[part] = (path - top - np.log(np.exp(a - top[:, None]).sum(1))) / size
    return out


def train(crf: Crf, seen: DataFrame) -> None:
    """seen(x, y, own, count): all training sequences, equal ones once with their number."""
    size = seen.agg(F.sum("count")).first()[0]
    if not size:
        return
    climb(crf, blocks(seen), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, own, n = (c.to_pylist() for c in batch.columns)
            wrong, at = np.zeros(len(x), bool), [i for i, o in enumerate(own) if o]
            wrong[at] = likelihoods(crf, [x[i] for i in at], [y[i] for i in at]) < DOUBT
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(wrong, pa.bool_())], names=["x", "y", "own", "count", "wrong"])

    judged = materialize(seen.select("x", "y", "own", "count").mapInArrow(run, "x array<int>, y array<int>, own boolean, count long, wrong boolean"), "pairs-doubted")
    wrong, real = judged.agg(F.sum(F.when(F.col("wrong"), F.col("count"))), F.sum(F.when(F.col("own"), F.col("count")))).first()
    if (wrong or 0) < 0.5 * (real or 0):
        climb(crf, blocks(judged.filter(~F.col("wrong"))), size - (wrong or 0))


def defects(records: DataFrame, foreign: DataFrame | None = None) -> DataFrame:
    """records(id, user, assistant[, turn]), foreign(id, text, lang) -> (id, turn, defect) of the defective pairs."""
    if "turn" not in records.columns:
        records = records.withColumn("turn", F.lit(0))
    spark = records.sparkSession
    if foreign is None:
        foreign = spark.createDataFrame([], "id long, text string, lang string")
    others = foreign.filter(F.lower("lang").isin("en", "de", "fr", "es") & F.col("text").isNotNull())
    known = counted(records.select("assistant"), told_words, max(3, records.count() // 200))
    other = counted(others.select("text"), Trigrams.counted) or Trigrams.counted(s.replace("{}", "") for s in FOREIGN_SEEDS)
    judge = Judge(truncation.Ends(), frozenset(known), Trigrams(counted(records.select("user"), Trigrams.counted), other))
    plan = materialize(sequences(records, others, judge), "pairs-seen")
    values = truncation.scored(plan, truncation.asked_odds(truncation.asked_of(plan), records), truncation.unit_table(plan.filter("n <= 0"))[1])
    values = materialize(values.select("id", "turn", "n", "role", "made", "lang", "long", "unit", "x", "y", "own", "sizes", "score"), "pairs-scores")
    odds = F.when(F.col("unit").isNull(), truncation.CERTAIN).otherwise(F.col("score") - truncation.least_score(truncation.score_thresholds(values)))
    last = F.element_at("x", -1).bitwiseOR(F.when(odds < 0, 1 << FEATURES.index("cut")).when(odds > FAR, 1 << FEATURES.index("not cut by far")).otherwise(0))
    seen = values.withColumn("x", F.when(F.size("x") > 0, F.concat(F.slice("x", F.lit(1), F.size("x") - 1), F.array(last))).otherwise(F.col("x")))
    train(judge.crf, materialize(seen.filter("n > 0").groupBy("x", "y", "own").count(), "pairs-taught"))
    model = spark.sparkContext.broadcast(judge.crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf, memo = model.value, {}
        for batch in batches:
            out = []
            for i, k, x, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                key, share = tuple(x), {}
                if x and key not in memo:
                    if len(memo) > 20_000:
                        memo.clear()
                    memo[key] = crf.viterbi(unpacked(x))
                for n, tag in zip(sizes, memo[key] if x else []):
                    share[TAGS[tag]] = share.get(TAGS[tag], 0.0) + n / sum(sizes)
                if defect := worst(share):
                    out.append((i, k, defect))
            cols = [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "turn", "defect"])

    return seen.filter("n = 0").select("id", "turn", "x", "sizes").mapInArrow(run, "id long, turn int, defect string")

"""Personal data in text, also where it is disguised, as spans of the source text.

Plain identifiers are found in the source.  Then a chain of small transducers rewrites disguises:
look-alike letters and digits, invisible characters, spelled digits, and "at" and "dot" in words or
brackets.  Each of them keeps, for every character it writes, where that came from, so that what is
detected in the rewritten text maps back to characters of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from signalweave.llm.frames import documents, map_texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit run can only match from its first digit, so that no run is scanned twice.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Each @ with the local part before it and the longest domain after it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield "email", start, done
        else:
            # What lies before this @ cannot start a later match.
            done = max(done, at + 1) if start == at else done
        at = text.find("@", max(at + 1, done))


def _byte(part: str) -> bool:
    """Whether digits of any number, zeros before them included, say 255 at most."""
    value = part.lstrip("0")
    return len(value) < 3 or (len(value) == 3 and value <= "255")


def plain_spans(text: str) -> list[Span]:
    """The plain identifiers: leftmost, non-overlapping per kind, checked, without retries."""
    found: list[Span] = list(emails(text))
    for m in _IP.finditer(text):
        if all(map(_byte, m.groups())):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


class Rewritten:
    """A text under rewriting; character i stands for source[start[i]:end[i]]."""

    def __init__(self, text: str):
        self.text = text
        self.start = self.end = None

    def _offsets(self) -> None:
        if self.start is None:
            self.start = np.arange(len(self.text))
            self.end = self.start + 1

    def replace(self, changes: list[tuple[int, int, str]]) -> None:
        """Put each new text in place of [a, b); its characters all stand for that whole stretch."""
        self._offsets()
        texts, starts, ends, at = [], [], [], 0
        for a, b, new in changes:
            texts += (self.text[at:a], new)
            starts += (self.start[at:a], np.full(len(new), self.start[a]))
            ends += (self.end[at:a], np.full(len(new), self.end[b - 1]))
            at = b
        texts.append(self.text[at:])
        self.text = "".join(texts)
        self.start = np.concatenate((*starts, self.start[at:]))
        self.end = np.concatenate((*ends, self.end[at:]))

    def source(self, a: int, b: int) -> tuple[int, int]:
        self._offsets()
        return int(self.start[a]), int(self.end[b - 1])


# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "п": "n", "г": "r", "в": "b", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "τ": "t", "ε": "e",
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "。": ".", "·": ".", "•": ".",
}
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿᠎"
# Names of the digits in English, German, French and Spanish.
DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}

_OTHER = re.compile(r"[^\x00-ɏ]|[" + INVISIBLE + r"·]")
_NAME = "|".join(sorted(DIGIT_NAMES, key=len, reverse=True))
# Spoken signs between digits.
SIGN_NAMES = {
    "plus": "+", "dot": ".", "punkt": ".", "point": ".", "punto": ".", "dash": "-", "hyphen": "-", "minus": "-",
}
_SIGN = "|".join(SIGN_NAMES)
_DOT_NAME = "(?:dot|punkt|point|punto)"
_AT_NAME = "(?:at|arroba|arobase)"
# Digit names stand in runs; single ones are ordinary words.
_LINK = rf"(?:[\s,.()-]{{1,4}}|[\s,.()-]*\b(?:{_SIGN})\b[\s,.()-]*)"
_PAIR = re.compile(rf"\b(?:{_NAME})[\s,.()-]{{1,4}}(?:{_NAME}|{_SIGN}|[0-9])")
_NAMES = re.compile(rf"(?i)\b(?:{_NAME})(?:{_LINK}(?:{_NAME}|[0-9]+)\b){{3,}}")
_ONE_NAME = re.compile(rf"(?i)\b(?:{_NAME}|{_SIGN})\b")
_PLUS = re.compile(r"(?i)\bplus[\s-]+(?=[0-9])")
# A run of blanks is looked at from its first one only.
_AT = re.compile(rf"(?i)(?:(?<!\s)\s*[\[({{<]\s*|[_-])(?:{_AT_NAME}|@)(?:\s*[\])}}>]\s*|[_-])")
_DOT = re.compile(rf"(?i)(?:(?<!\s)\s*[\[({{<]\s*|[_-])(?:{_DOT_NAME}|\.)(?:\s*[\])}}>]\s*|[_-])")
_IN_BRACKETS = rf"\s*[\[({{<]\s*{_DOT_NAME}\s*[\])}}>]\s*"
# A whole address in words: its local part, "at", and a domain whose last dot is a word, bare or in
# brackets, or a plain domain after a local part that no ordinary word looks like.
_SPELLED_DOT = rf"(?:\s+{_DOT_NAME}\s+|{_IN_BRACKETS})"
_TOKEN = re.compile(r"(?i)(?<![\w.%+-])[a-z0-9._%+-]")
_CHAIN = re.compile(rf"(?i)[a-z0-9][a-z0-9._%+-]*+(?:{_SPELLED_DOT}(?P<last>[a-z0-9_%+-]++))*+")
_SPELLED_DOMAIN = re.compile(
    rf"(?i)(?P<at>\s+{_AT_NAME}\s+|\s*@\s*)"
    rf"[a-z0-9-]+(?:(?:{_SPELLED_DOT}|\s*\.\s*)[a-z0-9-]+)*?(?:{_SPELLED_DOT}[a-z]{{2,}}\b)+"
)
_PLAIN_DOMAIN = re.compile(
    rf"(?i)[a-z]*[0-9._%+-][a-z0-9._%+-]*(?P<at>\s+{_AT_NAME}\s+|\s+@\s*|\s*@\s+)[a-z0-9-]+(?:\.[a-z0-9-]+)+"
)
_DOT_WORDS = re.compile(rf"(?i){_SPELLED_DOT}|\s*\.\s*")
# What a text must have for any of these: a bracketed word or sign, a bare "at" with a dot after it, an @
# beside a blank, or an @ and then a spelled dot.
_AT_HINT = re.compile(
    rf"[\[({{<_-]\s*(?:{_AT_NAME}|{_DOT_NAME}|[@.])\s*[\])}}>_-]"
    rf"|\s{_AT_NAME}\s+[a-z0-9-]+(?:\s+{_DOT_NAME}\s|\.[a-z0-9])|\s@|@\s|@[a-z0-9.-]+\s+{_DOT_NAME}\s"
)
_MIXED = re.compile(r"(?<=[0-9])[OoIl](?=[ ().-]{0,3}[0-9])|(?<=[0-9][ ().-])[OoIl](?=[0-9])")
_SPELLED_RUN = re.compile(r"[0-9](?:[ ,.()-]{0,4}[0-9])+")


def plain_letters(work: Rewritten) -> None:
    """Look-alikes, compatibility forms and foreign digits to ASCII; invisible characters to nothing."""
    changes = []
    for m in _OTHER.finditer(work.text):
        c = m.group()
        if c in INVISIBLE:
            new = ""
        elif c in LOOK_ALIKES:
            new = LOOK_ALIKES[c]
        else:
            new = unicodedata.normalize("NFKC", c)
            digit = unicodedata.decimal(c, None)
            new = str(digit) if digit is not None else new
            if not new.isascii():
                continue
        changes.append((m.start(), m.end(), new))
    if changes:
        work.replace(changes)


def digits(work: Rewritten, lowered: str) -> set[int]:
    """Runs of digit names to digits; returns where in the source a digit was spelled."""
    spelled, changes = set(), []
    runs = _NAMES.finditer(work.text) if _PAIR.search(lowered) else ()
    for run in runs:
        at = run.start()
        for m in _ONE_NAME.finditer(work.text, run.start(), run.end()):
            word = m.group().lower()
            new = DIGIT_NAMES.get(word) or SIGN_NAMES[word]
            # Blanks and commas between the names go with the name after them.
            blank = not work.text[at : m.start()].strip(" \t\n,")
            changes.append((at if blank and at > run.start() else m.start(), m.end(), new))
            at = m.end()
            if word in DIGIT_NAMES:
                spelled.add(work.source(m.start(), m.end())[1])
    if changes:
        work.replace(changes)
        plus = [(m.start(), m.end(), "+") for m in _PLUS.finditer(work.text)]
        if plus:
            work.replace(plus)
    mixed = [(m.start(), m.end(), "0" if m.group() in "Oo" else "1") for m in _MIXED.finditer(work.text)]
    if mixed:
        work.replace(mixed)
    return spelled


def _spelled_addresses(text: str) -> Iterator[tuple[int, tuple[int, int], int]]:
    """Start, place of the "at" and end of each whole address in words, from left to right.

    A chain of words and spelled dots is read once.  If no "at" follows it, none follows a part of it that begins
    later, but for its last word, which may hold plain dots where it comes first.
    """
    at = 0
    while token := _TOKEN.search(text, at):
        begin = token.start()
        chain = _CHAIN.match(text, begin)
        found = chain and _SPELLED_DOMAIN.match(text, chain.end()) or _PLAIN_DOMAIN.match(text, begin)
        if found:
            yield begin, found.span("at"), found.end()
            at = found.end()
        else:
            at = chain.start("last") if chain and chain["last"] else begin + 1


def _addresses(work: Rewritten) -> None:
    """Whole addresses in words to plain ones."""
    changes = []
    for begin, (a, b), end in _spelled_addresses(work.text):
        changes += [(*dot.span(), ".") for dot in _DOT_WORDS.finditer(work.text, begin, a) if dot.group() != "."]
        changes.append((a, b, "@"))
        changes += [(*dot.span(), ".") for dot in _DOT_WORDS.finditer(work.text, b, end) if dot.group() != "."]
    if changes:
        work.replace(changes)


def at_and_dot(work: Rewritten, lowered: str) -> None:
    """Bracketed "at" and "dot" anywhere; bare words only where a whole address is spelled."""
    if not _AT_HINT.search(lowered):
        return
    if _AT.search(work.text):
        work.replace([(m.start(), m.end(), "@") for m in _AT.finditer(work.text)])
    # A bracketed "dot" tells that a bare "at" before it is one of an address, so these come first.
    _addresses(work)
    if _DOT.search(work.text):
        work.replace([(m.start(), m.end(), ".") for m in _DOT.finditer(work.text)])
        _addresses(work)


def disguised_spans(text: str) -> list[Span]:
    """Identifiers that show only after rewriting, as spans of the source."""
    work = Rewritten(text)
    plain_letters(work)
    lowered = work.text.lower()
    spelled = digits(work, lowered)
    at_and_dot(work, lowered)
    if work.text == text:
        return []
    found = [(kind, *work.source(a, b)) for kind, a, b in plain_spans(work.text)]
    if spelled:
        # A long run of spelled digits is a number that someone hid, with or without a plus.
        for m in _SPELLED_RUN.finditer(work.text):
            places = [i for i in range(*m.span()) if work.text[i].isdigit()]
            hidden = sum(int(work.end[i]) in spelled for i in places)
            steps = {int(work.text[j]) - int(work.text[i]) for i, j in zip(places, places[1:])}
            # Counting up or down, or saying one digit over and over, is no number.
            if 9 <= len(places) <= 15 and 2 * hidden >= len(places) and not steps <= {1} and not steps <= {-1} and not steps <= {0}:
                found.append(("phone", *work.source(*m.span())))
    return found


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The plain spans, and these with the disguised ones that lie in no other span.

    Spans are swept from left to right, the plain one and the longer one first: what lies in another ends no later
    than the furthest end so far.
    """
    base = sorted(plain_spans(text), key=lambda s: (s[1], KINDS.index(s[0])))
    disguised = disguised_spans(text)
    if not disguised:
        return base, sorted(base, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    tagged = [(a, -b, 0, k) for k, a, b in base] + [(a, -b, 1 + KINDS.index(k), k) for k, a, b in disguised]
    every, reach = list(base), 0
    for a, minus, order, kind in sorted(tagged):
        if order and -minus > reach:
            every.append((kind, a, -minus))
        reach = max(reach, -minus)
    return base, sorted(every, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def personal_data(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns, counts of plain spans per kind, their digest, and all spans.

    Spans are code points of the source, end exclusive.  NULL counts as an empty text: no spans, the
    digest of the empty string.  Rows are independent; no other column is read.  Time and memory of a text grow with
    its length, also where it repeats one disguise over and over.
    """

    def values() -> Callable:
        def columns(texts: list[bytes]):
            found = [all_spans(t.decode("utf-8")) for t in texts]
            for kind in KINDS:
                yield pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64())
            yield pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found])
            yield pa.array([written(every) for _, every in found])
            yield pa.array([len(every) - len(base) for base, every in found], pa.int64())

        return columns

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    fields = f"{counts}, base_sha256 string, spans string, n_disguised long"
    return map_texts(df, fields, values, text, keep)


def personal_data_query(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(documents(spark, folder))

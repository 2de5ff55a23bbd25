"""Personal data in texts: plain identifiers, and those that are written in disguise.

Identifiers are found by fixed patterns in the text as it stands. After that the text runs
through three transducers, each of which rewrites stretches of its input and keeps, for every
rewritten stretch, where it came from:

1. ``homoglyphs``: letters, digits and signs that look like ASCII ones become these; marks
   without width go.
2. ``spelled_digits``: digits spelled as words (English, French, German, Spanish), with
   "double" and "triple", where another digit is next to them; "plus" before a digit.
3. ``at_and_dot``: bracketed or spelled "at" and "dot". A bare "at" counts only before a
   domain that is disguised too and ends like one ("meet me at example.com" stays as it is).

The same patterns then run over the normalised text. A span that covers something rewritten
is mapped back through the transducers, last one first, to the characters it came from, and
is added unless a plain span of the same kind covers it.

A null text is empty and an empty text has no spans. Texts are scanned whole, however long,
in time linear in their length; each row by itself, so repeated rows give repeated results,
an empty table gives an empty one, and only ``doc_id`` and ``text`` are read, whatever other
columns are called.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm.texts import slices, small_batches

#: In the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")

# The contract's patterns. Each takes a run whole, so that no start inside of
# it is tried again: a match that is possible at all is possible at the run's beginning.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, number of the kind, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    low, at = 0, text.find("@")
    while at >= 0:
        own = text[low:at]
        begin = low + len(own.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at) if begin < at else None
        if domain:
            yield begin, domain.end()
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def _is_part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or 0) <= 255


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def find_plain(text: str) -> list[Span]:
    """Spans of the fixed patterns, ascending; code points, end exclusive."""
    found = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if m[1] and all(map(_is_part, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NO_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass
class Rewritten:
    """A text with stretches replaced, and where each came from."""

    text: str
    begin: list[int] = field(default_factory=list)  # of each replacement, in ``text``
    end: list[int] = field(default_factory=list)
    from_begin: list[int] = field(default_factory=list)  # of what it replaced
    from_end: list[int] = field(default_factory=list)

    def source(self, a: int, b: int) -> tuple[int, int]:
        """The stretch of the input that gave ``text[a:b]``, which is not empty."""
        k = bisect_right(self.begin, a) - 1
        while k >= 0 and self.begin[k] == self.end[k]:  # deleted before it: not a part
            if self.end[k] < a:
                break
            k -= 1
        if k >= 0 and a < self.end[k]:
            low = self.from_begin[k]
        else:
            j = bisect_right(self.end, a) - 1
            low = a if j < 0 else self.from_end[j] + a - self.end[j]
        j = bisect_left(self.end, b) if self.end else 0
        if j < len(self.end) and self.begin[j] < b:
            high = self.from_end[j]
        else:
            j = bisect_left(self.begin, b) - 1
            high = b if j < 0 else max(self.from_end[j], self.from_end[j] + b - self.end[j])
        return low, high

    def touches(self, a: int, b: int) -> bool:
        """Whether a replacement lies in ``text[a:b]`` or leads over into it."""
        j = bisect_left(self.end, a)
        while j < len(self.begin) and self.begin[j] < b:
            if self.end[j] > a or (self.begin[j] == self.end[j] and a < self.begin[j] < b):
                return True
            j += 1
        return False


def rewrite(text: str, edits: Iterator[tuple[int, int, str]]) -> Rewritten:
    """Ascending, non-overlapping (start, end, replacement) applied to a text."""
    out, parts, at, size = Rewritten(text), [], 0, 0
    for a, b, new in edits:
        parts += (text[at:a], new)
        size += a - at
        out.begin.append(size)
        size += len(new)
        out.end.append(size)
        out.from_begin.append(a)
        out.from_end.append(b)
        at = b
    if parts:
        out.text = "".join(parts) + text[at:]
    return out


# Letters that look like ASCII ones, Cyrillic, Greek and Armenian.
_LOOKS = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "а": "a", "е": "e", "о": "o",
    "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q",
    "ԝ": "w", "һ": "h", "ӏ": "l", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I",
    "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o",
    "ν": "v", "ı": "i", "ɡ": "g", "օ": "o", "ո": "n", "ս": "u",
}
_SIGNS = dict.fromkeys("‐‑‒–−﹘﹣", "-")
_SIGNS |= dict.fromkeys("․。｡﹒", ".")
_SIGNS |= dict.fromkeys("       　", " ")
_NOTHING = "­᠎​‌‍⁠﻿"
# Full-width forms, letters and digits of mathematics, enclosed ones: their compatible form.
_COMPATIBLE = "\uff01-\uff5e\U0001d400-\U0001d7ff\u2460-\u2473\u24b6-\u24e9\ufe6b"
_ODD = re.compile(
    "[" + "".join(_LOOKS) + "".join(map(re.escape, _SIGNS)) + _NOTHING + _COMPATIBLE
    + "]|(?![0-9])\\d"
)


def _ascii(char: str) -> str:
    if char in _NOTHING:
        return ""
    known = _LOOKS.get(char) or _SIGNS.get(char)
    if known:
        return known
    if char.isdecimal():
        return str(unicodedata.decimal(char))
    plain = unicodedata.normalize("NFKC", char)
    return plain if plain.isascii() else char


def homoglyphs(text: str) -> Rewritten:
    """Characters that look like ASCII ones as these."""
    if text.isascii():
        return Rewritten(text)
    return rewrite(text, ((m.start(), m.end(), _ascii(m[0])) for m in _ODD.finditer(text)))


# The digits as words, from 0 on.
_SPELLED = (
    "zero oh zéro null cero", "one un une eins uno", "two deux zwei zwo dos",
    "three trois drei tres", "four quatre vier cuatro", "five cinq fünf cinco",
    "six sechs seis", "seven sept sieben siete", "eight huit acht ocho",
    "nine neuf neun nueve",
)
_DIGIT_OF = {word: str(d) for d, words in enumerate(_SPELLED) for word in words.split()}
_TIMES = {"double": 2, "triple": 3}
_WORDS = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
_DIGIT_WORD = re.compile(
    rf"\b(?:(double|triple)[ ]{{1,3}})?({_WORDS})\b", re.IGNORECASE
)
_DOT_WORDS = "dot|period|point|punkt|punto"
_BETWEEN = re.compile(
    rf"[ \-.,()/_\[\]{{}}]{{0,4}}(?:(?:{_DOT_WORDS})[ \-.,()/_\[\]{{}}]{{1,4}})?", re.IGNORECASE
)
_PLUS = re.compile(rf"\bplus[ ]{{1,3}}(?=[0-9]|(?:{_WORDS}|double|triple)\b)", re.IGNORECASE)
_TOKEN = re.compile(r"[^\W_]+")
_DOTS = frozenset(_DOT_WORDS.split("|"))
#: Characters that may lie between two digits of one identifier, at most.
_GAP = 16


def _may_spell(text: str) -> bool:
    """Whether any digit is spelled next to another one, or to a word for one."""
    tokens = _TOKEN.findall(text.lower())
    for k in [k for k, w in enumerate(tokens) if w in _DIGIT_OF]:
        if k and tokens[k - 1] in _TIMES:
            return True
        for step in (-1, 1):
            j = k + step
            if 0 <= j < len(tokens) and tokens[j] in _DOTS:
                j += step
            if 0 <= j < len(tokens):
                other = tokens[j]
                if other in _DIGIT_OF or other in _TIMES or other[0].isdecimal() or other[-1].isdecimal():
                    return True
    return False


def spelled_digits(text: str) -> Rewritten:
    """Digits as words become digits where another digit, spelled or not, is next to them;
    the space between two spelled digits goes with them."""
    if not _may_spell(text) and not ("plus" in text or "Plus" in text or "PLUS" in text):
        return Rewritten(text)
    words = [
        (m.start(), m.end(), _DIGIT_OF[m[2].lower()] * _TIMES.get((m[1] or "").lower(), 1))
        for m in _DIGIT_WORD.finditer(text)
    ]
    edits = [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]
    signed = {b for _, b, _ in edits}
    for k, (a, b, digits) in enumerate(words):
        before = words[k - 1][1] if k else -1
        after = words[k + 1][0] if k + 1 < len(words) else len(text) + _GAP
        joined = k > 0 and a - before <= _GAP and _BETWEEN.fullmatch(text, before, a)
        near = (
            joined
            or len(digits) > 1
            or a in signed
            or (after - b <= _GAP and _BETWEEN.fullmatch(text, b, after))
            or _digit_beside(text, a, b)
        )
        if not near:
            continue
        if joined and edits and edits[-1][1] == before and text[before:a].strip(" ") == "":
            edits[-1] = (edits[-1][0], b, edits[-1][2] + digits)
        else:
            edits.append((a, b, digits))
    return rewrite(text, iter(sorted(edits)))


def _digit_beside(text: str, a: int, b: int) -> bool:
    gap = _BETWEEN.match(text, b)
    if text[gap.end() : gap.end() + 1].isdecimal():
        return True
    low = max(0, a - _GAP)
    head = text[low:a].rstrip(" -.,()/_[]{}")
    if len(text[low:a]) - len(head) > 4:
        return False
    if head[-1:].isdecimal():
        return True
    word = re.search(rf"(?:{_DOT_WORDS})\Z", head, re.IGNORECASE)
    return bool(word) and head[: word.start()].rstrip(" -.,()/_[]{}")[-1:].isdecimal()


_AT_WORDS = "at|arobase|arroba|ät"
_BRACKETED = rf"[\[({{<][ ]{{0,3}}(?:({_AT_WORDS}|@)|(?:{_DOT_WORDS}|\.))[ ]{{0,3}}[\])}}>]"
_ENTITY = r"&\#0?(?:(64)|46);|&\#x(?:(40)|2e);"
_SIGN = re.compile(
    rf"""
      {_BRACKETED}
    | {_ENTITY}
    | (?<=[A-Za-z0-9])[ _-]{{1,3}}(?:{_DOT_WORDS})[ _-]{{1,3}}(?=[A-Za-z0-9])
    | (?<=[A-Za-z0-9])[ _-]{{1,3}}(?P<word>{_AT_WORDS})[ _-]{{1,3}}(?=[A-Za-z0-9])
    | (?<=[A-Za-z0-9])[ ]{{1,3}}(?P<spaced>@)[ ]{{0,3}}(?=[A-Za-z0-9]) | (?<=[A-Za-z0-9])@[ ]{{1,3}}(?=[A-Za-z0-9])
    """.replace("[ _-]", "[\\x20_-]").replace("[ ]", "[\\x20]"),
    re.VERBOSE | re.IGNORECASE,
)
# Common endings of domains, besides those of two letters.
_ENDINGS = frozenset("com org net edu gov mil int info biz name dev app example test invalid".split())
_REST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")


#: Text without any of these has no sign to rewrite: a bare "at" needs a spelled dot.
_HINTS = (
    "dot", "period", "point", "punkt", "punto", "arobase", "arroba", " @", "@ ", "&#",
    *(bracket + inside for bracket in "[({<" for inside in (" ", "a", "ä", "@", ".", "d", "p")),
)


def at_and_dot(text: str) -> Rewritten:
    """Disguised at and dot signs as these, with the space around them."""
    low = text.lower()
    if not any(hint in low for hint in _HINTS):
        return Rewritten(text)
    edits, bare = [], []
    for m in _SIGN.finditer(text):
        a, b = m.span()
        is_at = bool(m[1] or m[2] or m[3] or m["word"] or "@" in m[0])
        if not m["word"]:  # brackets take the space around them along
            while a > 0 and text[a - 1] == " " and m.start() - a < 3:
                a -= 1
            while b < len(text) and text[b] == " " and b - m.end() < 3:
                b += 1
            if edits and a < edits[-1][1]:
                a = edits[-1][1]
        elif m["word"].lower() not in ("arobase", "arroba"):
            bare.append(len(edits))
        edits.append((a, b, "@" if is_at else "."))
    if not bare:
        return rewrite(text, iter(edits))
    # A bare word counts if a disguised domain follows: looked up in the text without it.
    dots = rewrite(text, (e if e[2] == "." else (e[0], e[1], " ") for e in edits))
    fine = set()
    for k in bare:
        rest = _REST.match(dots.text, dots.end[k])
        ending = rest[0].rpartition(".")[2].lower() if rest else ""
        if (ending in _ENDINGS or len(ending) == 2 and ending.isalpha()) and dots.touches(*rest.span()):
            fine.add(k)
    kept = set(range(len(edits))) - set(bare) | fine
    return rewrite(text, (e for k, e in enumerate(edits) if k in kept))


TRANSDUCERS: tuple[Callable[[str], Rewritten], ...] = (homoglyphs, spelled_digits, at_and_dot)


def find_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, number of the kind, end, whether a plain span), ascending."""
    plain = find_plain(text)
    steps, now = [], text
    for step in TRANSDUCERS:
        done = step(now)
        if done.begin:
            steps.append(done)
            now = done.text
    found = [(*span, True) for span in plain]
    if not steps:
        return found
    covers: dict[int, list[tuple[int, int]]] = {}
    for a, kind, b in plain:
        covers.setdefault(kind, []).append((a, b))
    added = set()
    for a, kind, b in find_plain(now):
        low, high, odd = a, b, False
        for step in reversed(steps):
            odd = odd or step.touches(low, high)
            low, high = step.source(low, high)
        own = covers.get(kind, [])
        k = bisect_right(own, (low, len(text) + 1)) - 1
        if odd and not (k >= 0 and own[k][1] >= high):
            added.add((low, kind, high, False))
    return sorted(found + list(added))


_SCHEMA = (
    "doc_id bigint, "
    "spans array<struct<kind: string, start: bigint, end: bigint, plain: boolean>>"
)


def scan_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and all spans, by start and then kind, for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]
        )
        for batch in slices(batches, "text"):
            spans = [
                [(KINDS[kind], a, b, plain) for a, kind, b, plain in find_spans(t or "")]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(span))], ["doc_id", "spans"]
            )

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, _SCHEMA)


def redact(text: str | None) -> str:
    """The text with ``<KIND>`` in place of every span; of spans that overlap, the first and
    longest names the stretch that they cover together."""
    text = text or ""
    parts, at = [], 0
    for a, kind, b, _ in sorted(find_spans(text), key=lambda s: (s[0], -s[2])):
        if a >= at:
            parts += (text[at:a], f"<{KINDS[kind].upper()}>")
        at = max(at, b)
    return "".join(parts) + text[at:]


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id and the text without personal data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [redact(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string")

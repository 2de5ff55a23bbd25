"""Secrets in texts: known patterns, and random strings found by token efficiency.

A vocabulary of byte pairs learned from ordinary text packs ordinary strings, invented
names included, into few tokens; random strings fall apart. A run of key characters is
reported when it has less than ``MOST_RATIO`` characters a token, after digests, numbers and
UUIDs are left out and where no pattern has matched already.

A null text is empty and an empty text has no spans. Texts are scanned whole, each row
by itself, so repeated rows give repeated results and nothing is shuffled.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tarmac.llm.texts import slices, small_batches

#: Characters a token below which a string counts as random.
MOST_RATIO = 1.9
#: Shorter runs say too little.
LEAST_LENGTH = 20

#: In the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")

# The contract's patterns. Failing matches of "access" and "hex" cannot
# hide a longer one, so their least lengths are in the pattern; "assign" is tested after.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")

_RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}")
_FIXED = r"""
      (?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})
    | (?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128})
    | sha(?:1|224|256|384|512)[-=][A-Za-z0-9+/]+=*             # integrity digests
    | [0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}     # UUIDs
"""
_FIXED_SHAPES = re.compile(rf"{_FIXED} | [0-9+/_=-]+", re.VERBOSE)  # numbers, rules
#: Digests and UUIDs that are joined to other parts of a run.
_FIXED_PART = re.compile(rf"(?<![A-Za-z0-9])(?:{_FIXED})(?![A-Za-z0-9])", re.VERBOSE)
_KNOWN_SHAPES = re.compile(
    rf"""
    {_FIXED} | [0-9+/_=-]+
    | (?:[+/_=-]*+(?:[A-Z]?[a-z]++|[A-Z]++)[0-9]{{0,4}}+)++[+/_=-]*+  # words joined to a name
    """,
    re.VERBOSE,
)
_PARTS = re.compile(r"[+/_=-]*[A-Za-z0-9]+(?:=+\Z)?")
_PART = 4096
_WORD_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A name is made of words: at least so many letters a part, on average.
_NAME_PART = 3.5


@lru_cache(maxsize=1)
def _vocabulary(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)
        }
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def known_shape(run: str) -> bool:
    """Digests, identifiers, numbers and what looks like names made of words. Random strings
    of one case look alike, so ``find_spans`` leaves names to the token ratio."""
    if not _KNOWN_SHAPES.fullmatch(run):
        return False
    if not re.search("[G-Zg-z]", run) or run.startswith("sha"):
        return True
    parts = _WORD_PART.findall(run)
    return sum(map(len, parts)) >= _NAME_PART * len(parts)


def _tokens(run: str, encode) -> int:
    # Long runs are encoded in parts: encoding one string of letters may take
    # quadratic time.
    return sum(len(encode(run[k : k + _PART])) for k in range(0, len(run), _PART))


def _outside(low: int, high: int, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What ascending ``spans`` leave of a stretch."""
    for a, b in spans:
        if low < b and a < high:
            if low < a:
                yield low, a
            low = max(low, b)
    if low < high:
        yield low, high


def _random_stretches(run: str, encode) -> Iterator[tuple[int, int]]:
    """The stretches of whole parts of ``run`` that have least characters for their tokens:
    maximal ones, of which no beginning or end has more than ``MOST_RATIO`` a token."""
    parts = [(m.start(), m.end()) for m in _PARTS.finditer(run)]
    total, best = 0.0, []  # best: first part, end part, total before, total after
    for k, (a, b) in enumerate(parts):
        before = total
        total += MOST_RATIO * _tokens(run[a:b], encode) - (b - a)
        if total <= before:
            continue
        own = [k, k + 1, before, total]
        while True:
            j = len(best) - 1
            while j >= 0 and best[j][2] >= own[2]:
                j = best[j][4]
            if j < 0 or best[j][3] >= own[3]:
                best.append([*own, j])
                break
            own = [best[j][0], own[1], best[j][2], own[3]]
            del best[j:]
    for first, end, *_ in best:
        low, high = parts[first][0], parts[end - 1][1]
        low += len(run[low:high]) - len(run[low:high].lstrip("+/_=-"))
        if high - low >= LEAST_LENGTH and not _FIXED_SHAPES.fullmatch(run, low, high):
            yield low, high


def find_spans(text: str, encode) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), ascending; code points, end exclusive."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    taken, at = sorted((a, b) for a, _, b in found), 0
    for m in _RUN.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        near = []
        for span in taken[at:]:
            if span[0] >= m.end():
                break
            near.append(span)
        for low, high in _outside(*m.span(), near):
            run = text[low:high]
            if high - low < LEAST_LENGTH or _FIXED_SHAPES.fullmatch(run):
                continue
            if high - low < MOST_RATIO * _tokens(run, encode):
                found.append((low, 3, high))
                continue
            fixed = [x.span() for x in _FIXED_PART.finditer(run)]
            for a, b in _outside(0, len(run), fixed):
                found += [(low + a + x, 3, low + a + y) for x, y in _random_stretches(run[a:b], encode)]
    return sorted(found)


_SCHEMA = "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>"


def scan_secrets(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """doc_id and all spans, by start and then kind, for each row of ``docs``.

    ``vocabulary_path`` is a rank file of a byte-pair vocabulary, ``pattern`` its
    splitting pattern.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _vocabulary(vocabulary_path, pattern).encode_ordinary
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in slices(batches, "text"):
            spans = [
                [(KINDS[kind], a, b) for a, kind, b in find_spans(t or "", encode)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(span))], ["doc_id", "spans"]
            )

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, _SCHEMA)

"""Packing documents into training sequences by order-preserving dynamic programming.

Documents keep their order within an input split. Each becomes the tokens of its text
and one end mark. The stream of a split is cut into windows of at most ``LENGTH``
tokens; a cut may fall at the end of a document (free), at the end of a sentence
(``SENTENCE_CUT``) or, at multiples of ``GRID`` tokens, anywhere else (``HARD_CUT``).
The cuts minimise padding plus these penalties. With f(j) the least cost of all before j,
f(j) = cut(j) + LENGTH - j + min(f(i) + i) over the candidates i in [j - LENGTH, j), a
sliding minimum that a monotone queue gives in constant time per candidate. A window
whose length is a power of two is not padded, so it may also start at that distance for
a fixed price, ``SHORT_WINDOW``, which keeps such windows rare.

A split is worked off in blocks of documents: the windows that end well before the end
of a block are final, the rest is carried into the next block. So memory is bounded by
a block and the longest document. A null text is empty: its end mark alone. Repeated
ids and rows are separate documents.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tarmac.llm.texts import SPACED, distinct, slices, small_batches, split_words, word_hashes

LENGTH = 4096
END_ID = 2
SENTENCE_CUT = 8
HARD_CUT = 64
SHORT_WINDOW = 32
GRID = 256
#: Tokens of the stream that are decided at once.
BLOCK_TOKENS = 1 << 20

_POWERS = tuple(2**k for k in range(LENGTH.bit_length() - 1))
_CACHE_WORDS = 1_500_000
# A special token of the vocabulary, and how many words it joins.
_JOINT, _JOINED = "<|startoftext|>", 200


class WordTokens:
    """Token ids of texts by way of their distinct words.

    The vocabulary splits at white space before it merges, so the ids of a text are
    those of its words in turn. Words seen before are kept in a sorted table by their
    hash, up to a fixed number; the table only saves work.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encode = Tokenizer.from_file(path)
        self.ends = np.array(
            sorted(
                i
                for piece, i in self.encode.get_vocab().items()
                if re.fullmatch(r"[.!?][.!?\"')]*</w>", piece)
            ),
            np.uint32,
        )
        self.joint = self.encode.token_to_id(_JOINT)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has.

        A special token parts its surroundings, so words joined by one are encoded like
        words alone, in far fewer calls.
        """
        rows = [words[k : k + _JOINED] for k in range(0, len(words), _JOINED)]
        texts = [_JOINT.join(row) + _JOINT for row in rows]
        found = self.encode.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
        ends = np.flatnonzero(ids == self.joint)
        size = np.diff(ends, prepend=-1) - 1
        return np.delete(ids, ends), size

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if self.joint is None or any(_JOINT in w for w in words):
            alone = self.encode.encode_batch_fast(words, add_special_tokens=False)
            found = [np.array(e.ids, np.uint32) for e in alone]
            ids, size = np.concatenate(found), np.array([len(x) for x in found])
        else:
            ids, size = self._encoded(words)
        begin = np.cumsum(size) - size + len(self.ids)
        at = np.searchsorted(self.keys, keys)  # both are in ascending order
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin)
        self.size = np.insert(self.size, at, size)
        self.ids = np.concatenate([self.ids, ids])

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end mark, and the number per text."""
        # Other white space than ASCII may stay inside a word here: the tokenizer
        # splits there by itself.
        words = split_words(texts, SPACED)
        hashes, first_seen, which = distinct(word_hashes(words))
        if len(self.keys) > _CACHE_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(hashes[new])]
            self._learn(
                hashes[new], [words.bytes_of(k).decode("utf-8") for k in first_seen[new]]
            )
        at = np.searchsorted(self.keys, hashes)[which]
        size, begin = self.size[at], self.begin[at]
        n_texts = len(words.first) - 1
        text_of = words.text_of()
        counts = np.bincount(text_of, weights=size, minlength=n_texts).astype(np.int64) + 1
        out = np.full(int(counts.sum()), END_ID, np.uint32)
        place = np.cumsum(size) - size + text_of  # one end mark per text before
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(place, size) + step] = self.ids[np.repeat(begin, size) + step]
        return out, counts


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One table per worker process, kept from task to task."""
    return WordTokens(path)


def candidates(
    doc_end: np.ndarray, ids: np.ndarray, sentence_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, ascending, and the penalty of a cut there.
    ``doc_end``: positions behind each document, the last is the length of ``ids``."""
    n = int(doc_end[-1])
    penalty = np.full(n + 1, -1, np.int32)
    penalty[GRID:n:GRID] = HARD_CUT
    penalty[1:][np.isin(ids, sentence_ends)] = SENTENCE_CUT
    penalty[doc_end] = 0
    penalty[0] = -1
    where = np.flatnonzero(penalty >= 0)
    return where, penalty[where]


def _at_powers(spots: np.ndarray) -> tuple[list[int], list[int]]:
    """Pairs of spots a power of two apart: how many there are for the spots before
    each, and the numbers of the earlier spots, shortest distance first."""
    later, earlier = [], []
    for size in _POWERS:
        at = np.searchsorted(spots, spots - size)
        found = np.flatnonzero(spots[at] == spots - size)
        later.append(found)
        earlier.append(at[found])
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    bounds = np.searchsorted(later[order], np.arange(len(spots) + 1))
    return bounds.tolist(), earlier[order].tolist()


def best_cuts(where: np.ndarray, penalty: np.ndarray) -> tuple[np.ndarray, int]:
    """Ends of the windows of the cheapest cutting of [0, where[-1]), and its cost."""
    places = np.concatenate([[0], where])
    bounds, shorter = _at_powers(places)
    spots, price = places.tolist(), [0, *penalty.tolist()]
    cost = [0] * len(spots)
    back = [0] * len(spots)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f(i) + i, number of i), ascending
    for k in range(1, len(spots)):
        j = spots[k]
        while spots[queue[0][1]] < j - LENGTH:
            queue.popleft()
        least, source = queue[0]
        least += LENGTH - j
        for i in shorter[bounds[k] : bounds[k + 1]]:
            if cost[i] + SHORT_WINDOW < least:
                least, source = cost[i] + SHORT_WINDOW, i
        cost[k], back[k] = least + price[k], source
        entry = cost[k] + j
        while queue and queue[-1][0] >= entry:
            queue.pop()
        queue.append((entry, k))
    cuts, k = [], len(spots) - 1
    while k:
        cuts.append(spots[k])
        k = back[k]
    return np.array(cuts[::-1], np.int64), cost[-1]


class _Stream:
    """The documents of a split in order, of which a tail is still undecided."""

    def __init__(self, shard: int, sentence_ends: np.ndarray):
        self.sequence = shard << 33
        self.sentence_ends = sentence_ends
        self.doc_ids: list = []
        self.totals: list[int] = []  # tokens of each document
        self.starts: list[int] = []  # tokens of it that are already placed
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.totals += counts.tolist()
        self.starts += [0] * len(doc_ids)
        self.parts.append(ids)
        self.held += len(ids)

    def place(self, last: bool) -> dict[str, list]:
        """Pieces of all windows but the last few; of all if it is the ``last`` call."""
        ids = np.concatenate(self.parts)
        doc_end = np.cumsum(np.array(self.totals) - np.array(self.starts))
        cuts, _ = best_cuts(*candidates(doc_end, ids, self.sentence_ends))
        if not last:
            cuts = cuts[cuts <= len(ids) - 4 * LENGTH]
        out: dict[str, list] = {name: [] for name in PIECES}
        low, doc = 0, 0
        raw = ids.astype("<u4", copy=False)
        for cut in cuts.tolist():
            begin = low
            while low < cut:
                high = min(cut, int(doc_end[doc]))
                start = self.totals[doc] - int(doc_end[doc]) + low
                row = (
                    self.doc_ids[doc],
                    start,
                    high - low,
                    crc32(raw[low:high].tobytes()),
                    self.totals[doc],
                    self.sequence,
                    low - begin,
                )
                for name, value in zip(PIECES, row):
                    out[name].append(value)
                low = high
                if low == doc_end[doc]:
                    doc += 1
            self.sequence += 1
        if doc < len(self.totals):
            self.starts[doc] = self.totals[doc] - int(doc_end[doc]) + low
        for column in (self.doc_ids, self.totals, self.starts):
            del column[:doc]
        self.parts, self.held = [ids[low:]], len(ids) - low
        return out


PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
_SCHEMA = ", ".join(f"{name} bigint" for name in PIECES)


def pack(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset. ``sequence_id`` is the number of the input split times 2**33 plus the number
    of the window in it, so nothing is shuffled. An empty table has no pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer_path)
        stream = _Stream(TaskContext.get().partitionId(), tokens.ends)
        types = pa.schema([(name, pa.int64()) for name in PIECES])
        for batch in slices(batches, "text"):
            stream.add(batch.column("doc_id").to_pylist(), *tokens.of(batch.column("text")))
            if stream.held >= BLOCK_TOKENS:
                yield pa.RecordBatch.from_pydict(stream.place(last=False), types)
        if stream.held:
            yield pa.RecordBatch.from_pydict(stream.place(last=True), types)

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, _SCHEMA)

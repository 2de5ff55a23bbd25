"""Repeated passages of words, found with anchors on a difference cover.

Every window of ``WINDOW`` consecutive words that occurs anywhere else, in whatever text,
is removed, all of its occurrences. ``COVER`` is a perfect difference set modulo
``PERIOD``: of any two positions one shift below ``PERIOD`` makes both fall on it. So only
windows of ``ANCHOR`` words that begin at cover positions are hashed, a quarter of all, and
still two equal windows hold a pair of equal anchors in the same place of both.

Equal anchors are then extended: where all words around an anchor that a window could take
in are equal too, every window there repeats. Where they differ, the windows around that anchor,
and only these, are hashed and compared one by one.

Words are runs without ASCII white space, unchanged. Null and empty texts, and texts of
fewer words than a window, keep all they have. Repeated rows are texts of their own,
so both lose what they share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.repeats import (
    STRETCH,
    by_row,
    release_shuffles,
    repeats_by_row,
    settle,
    span_hashes,
    stretches,
    union_of_spans,
)
from tarmac.llm.texts import (
    BASES,
    SPACED,
    mix,
    slices,
    split_words,
    window_hashes,
    with_row,
    word_hashes,
)
from tarmac.session import ensure_checkpoint_dir

WINDOW = 35
PERIOD = 21
# A perfect difference set modulo 21.
COVER = (3, 6, 7, 12, 14)
ANCHOR = WINDOW + 1 - PERIOD
#: Words that a window may reach beyond its anchor to the left.
REACH = PERIOD - 1

_ON_COVER = np.zeros(PERIOD, bool)
_ON_COVER[list(COVER)] = True


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = split_words(batch.column("text"), SPACED)
        values = word_hashes(words)
        text, left = words.text_of(), words.left()
        base = words.first[text]
        inside = np.arange(len(values)) - base
        at = np.flatnonzero(_ON_COVER[inside % PERIOD] & (left >= ANCHOR) & (left + inside >= WINDOW))
        before = np.minimum(inside[at], REACH)
        behind = np.minimum(left[at], WINDOW)
        fits = before + behind >= WINDOW
        at, before, behind = at[fits], before[fits], behind[fits]
        whole = span_hashes(values, at - before, at + behind)
        rows = batch.column("_row").to_numpy()[text[at]]
        start = inside[at] - before
        yield from stretches(
            window_hashes(values, ANCHOR)[at],
            mix(whole + before.astype(np.uint64)),
            np.zeros(len(at), np.int64),
            rows,
            start,
            start + before + behind,
            keep_first=False,
        )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both hashes of all windows within the spans ``unsettled`` of each text."""
    for batch in slices(batches, "text"):
        words = split_words(batch.column("text"), SPACED)
        values = word_hashes(words)
        base = words.first
        wanted = np.zeros(len(values) + 1, np.int64)
        spans = batch.column("unsettled")
        text = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        pairs = spans.flatten()
        start = pairs.field("start").to_numpy() + base[text]
        end = pairs.field("end").to_numpy() + base[text]
        np.add.at(wanted, start, 1)
        np.add.at(wanted, end - WINDOW + 1, -1)
        at = np.flatnonzero(np.cumsum(wanted) > 0)
        text = words.text_of()[at]
        inside = at - base[text]
        yield from stretches(
            window_hashes(values, WINDOW)[at],
            window_hashes(values, WINDOW, BASES[1])[at],
            np.zeros(len(at), np.int64),
            batch.column("_row").to_numpy()[text],
            inside,
            inside + WINDOW,
            keep_first=False,
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the spans ``repeats`` from the words of each text."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in slices(batches, "text"):
        kept, removed, sizes = [], [], []
        repeats = batch.column("repeats").to_pylist()
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        for text, own in zip(texts, repeats):
            words = (text or b"").split()  # bytes split at the same white space as SPACED
            spans = union_of_spans([(s["start"], s["end"]) for s in own or []])
            edges = [0, *(x for s in spans for x in s), len(words)]
            parts = [words[a:b] for a, b in zip(edges[::2], edges[1::2])]
            kept.append(b" ".join(w for part in parts for w in part))
            removed.append([{"start": a, "end": b} for a, b in spans])
            sizes.append(len(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_row"),
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.list_(span)),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["_row", "doc_id", "n_words", "removed", "kept_text"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: _row, doc_id, n_words, removed (spans of words, end
    exclusive), kept_text (the remaining words, joined by one space)."""
    ensure_checkpoint_dir(docs.sparkSession)
    texts = with_row(docs, "doc_id", "text")
    found = settle(texts.select("_row", "text").mapInArrow(_anchors, STRETCH), keep_first=False)
    found = found.select("_row", "start", "end", "mixed").checkpoint()
    release_shuffles(docs.sparkSession)
    # No column is left out here, so that both uses of the texts share one shuffle.
    open_rows = texts.join(by_row(found.filter("mixed"), "unsettled"), "_row")
    more = settle(open_rows.mapInArrow(_windows, STRETCH), keep_first=False)
    return texts.join(repeats_by_row(found, more), "_row", "left").mapInArrow(
        _cut,
        "_row bigint, doc_id bigint, n_words bigint, "
        "removed array<struct<start: bigint, end: bigint>>, kept_text string",
    )

"""Repeated byte strings, found with minimizers and settled by suffix arrays.

Every byte of a ``WINDOW``-byte string that also starts earlier, in a text of smaller
doc_id or before it in the same text, is removed. The first occurrence stays.

1. Each window belongs to one anchor, the ``GRAM`` bytes in it of least hash, which is in the
   same place of every copy. Consecutive windows of one anchor are a segment, so the
   windows of a text are split into segments, one per 26 bytes on average.
2. Segments meet by anchor. A segment equal to an earlier one repeats it whole. Of each
   kind of segment the earliest remains, and kinds that are alone with their anchor
   cannot share a window with anything.
3. The remaining segments of an anchor form a string, at most ``PART`` of them. Its suffix
   array, by linear grouping construction (``gsaca``), puts equal windows side by side; all but
   the earliest of them repeat.
4. Where an anchor has more kinds than fit into one string, each string tells its
   earliest occurrence of every window and these meet by the window's hashes.

So no task holds more than a few strings, however often an anchor occurs. Texts are UTF-8
bytes, null is empty, and matches never cross texts. Rows of equal doc_id, repeated rows
included, are separate texts in the order in which they are read; a null doc_id comes last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.gsaca import suffix_arrays
from tarmac.llm.repeats import (
    PART,
    STRETCH,
    release_shuffles,
    repeats_by_row,
    settle,
    settled_spans,
    span_hashes,
    stretches,
    union_of_spans,
)
from tarmac.llm.texts import BASES, flat, mix, slices, window_hashes, with_row
from tarmac.session import ensure_checkpoint_dir

WINDOW = 100
GRAM = 50
#: Bytes of text, and of strings for suffix arrays, that are worked on at once.
PIECE_BYTES = 1 << 20
BATCH_BYTES = 2 << 20

_CHOICES = WINDOW - GRAM + 1
_PLACE_BITS = 26
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_NO_ID = 2**63 - 1
_PIECES = "anchor bigint, part bigint, rank bigint, _row bigint, start bigint, bytes binary"


def segments(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, hash of all, start, end) of the segments of texts end to end."""
    none = np.zeros(0, np.int64)
    size = np.diff(begins)
    inside = np.zeros(len(data) + 1, np.int64)
    long_enough = size >= WINDOW
    if not long_enough.any():
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    np.add.at(inside, begins[:-1][long_enough], 1)
    np.add.at(inside, begins[1:][long_enough] - WINDOW + 1, -1)
    values = _BYTE[data]
    grams = window_hashes(values, GRAM)
    # The leading bits of the hash, then the place: the least is the first least.
    low = np.uint64((1 << _PLACE_BITS) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= _CHOICES:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    rest = _CHOICES - width
    key = np.minimum(key[: len(key) - rest], key[rest:])
    starts = np.flatnonzero(np.cumsum(inside[: len(key)]) > 0)
    anchor = (key[starts] & low).astype(np.int64)
    opens = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)])
    closes = np.concatenate([opens[1:], [True]])
    start, end, anchor = starts[opens], starts[closes] + WINDOW, anchor[opens]
    whole = mix(span_hashes(values, start, end) + (anchor - start).astype(np.uint64))
    return grams[anchor], whole, start, end


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", PIECE_BYTES):
        data, begins = flat(batch.column("text"))
        row, rank = batch.column("_row").to_numpy(), batch.column("rank").to_numpy()
        if len(row) == 1:  # perhaps a long text: pieces that share all but one window byte
            for low in range(0, max(1, len(data)), PIECE_BYTES):
                part = data[low : low + PIECE_BYTES + WINDOW - 1]
                anchor, whole, start, end = segments(part, np.array([0, len(part)]))
                one = np.zeros(len(start), np.int64)
                yield from stretches(
                    anchor, whole, one + rank[0], one + row[0], start + low, end + low, True
                )
            continue
        anchor, whole, start, end = segments(data, begins)
        text = np.searchsorted(begins, start, side="right") - 1
        base = begins[text]
        yield from stretches(anchor, whole, rank[text], row[text], start - base, end - base, True)


def _bytes_of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments ``unsettled`` of each text with their bytes."""
    for batch in slices(batches, "text", PIECE_BYTES):
        data, begins = flat(batch.column("text"))
        spans = batch.column("unsettled")
        text = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        span = spans.flatten()
        start, end = (span.field(k).to_numpy() for k in ("start", "end"))
        raw = data.tobytes()
        first, last = (start + begins[text]).tolist(), (end + begins[text]).tolist()
        cut = [raw[a:b] for a, b in zip(first, last)]
        yield pa.RecordBatch.from_arrays(
            [
                span.field("anchor"),
                span.field("part"),
                batch.column("rank").take(pa.array(text)),
                batch.column("_row").take(pa.array(text)),
                span.field("start"),
                pa.array(cut, pa.binary()),
            ],
            ["anchor", "part", "rank", "_row", "start", "bytes"],
        )


def repeated_windows(group, part, rank, row, start, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Stretches for ``settle``: the windows of each group of segments that repeat an
    earlier one of the group and, where the group may be one of several for its anchor,
    the earliest of all its windows. The columns are sorted by group."""
    size = np.array([len(t) for t in texts])
    opens = np.concatenate([[True], np.diff(group) != 0])
    last = np.concatenate([opens[1:], [True]])
    # A segment and its separator; the end of a string is less than any separator.
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    symbols = raw.astype(np.int64) + 2
    ends = np.cumsum(size + 1)
    symbols[ends - 1] = np.where(last, 0, 1)
    begins = np.concatenate([[0], ends[last]])
    order = suffix_arrays(symbols, begins)

    owner = np.repeat(np.arange(len(size)), size + 1)
    inside = np.arange(len(symbols)) - np.repeat(ends - size - 1, size + 1)
    order = order[inside[order] + WINDOW <= size[owner[order]]]
    values = _BYTE[raw]
    one = window_hashes(values, WINDOW)[order]
    two = window_hashes(values, WINDOW, BASES[1])[order]
    of = owner[order]
    fresh = np.concatenate(
        [[True], (np.diff(one) != 0) | (np.diff(two) != 0) | (np.diff(group[of]) != 0)]
    )[: len(order)]
    run = np.cumsum(fresh) - 1
    at = start[of] + inside[order]
    best = np.lexsort((at, row[of], rank[of], run))
    earliest = np.zeros(len(order), bool)
    earliest[best[fresh]] = True
    yield from settled_spans(row[of][~earliest], at[~earliest], at[~earliest] + WINDOW)

    count = np.diff(np.append(np.flatnonzero(opens), len(size)))
    several = np.repeat((part[opens] > 0) | (count >= PART), count)
    tell = np.flatnonzero(earliest & several[of])
    yield from stretches(
        one[tell], two[tell], rank[of][tell], row[of][tell], at[tell], at[tell] + WINDOW, True
    )


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups of (anchor, part), as many as ``BATCH_BYTES`` hold."""

    def settle_groups(table: pa.Table) -> Iterator[pa.RecordBatch]:
        anchor, part, rank, row, start = (table.column(k).to_numpy() for k in range(5))
        group = np.cumsum(
            np.concatenate([[0], (np.diff(anchor) != 0) | (np.diff(part) != 0)])
        )
        yield from repeated_windows(group, part, rank, row, start, table.column(5).to_pylist())

    def last_group(table: pa.Table) -> int:
        anchor, part = (table.column(k).to_numpy() for k in range(2))
        same = (anchor == anchor[-1]) & (part == part[-1])
        return int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0

    held: pa.Table | None = None
    for batch in slices(batches, "bytes", BATCH_BYTES):
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        cut = last_group(table)
        if cut:
            yield from settle_groups(table.slice(0, cut))
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield from settle_groups(held)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the spans ``repeats`` from the bytes of each text."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in slices(batches, "text", PIECE_BYTES):
        kept, removed, sizes = [], [], []
        repeats = batch.column("repeats").to_pylist()
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        for text, own in zip(texts, repeats):
            text = text or b""
            spans = union_of_spans([(s["start"], s["end"]) for s in own or []])
            edges = [0, *(x for s in spans for x in s), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            removed.append([{"start": a, "end": b} for a, b in spans])
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_row"),
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.list_(span)),
                pa.array(kept, pa.binary()),
            ],
            ["_row", "doc_id", "n_bytes", "removed", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: _row, doc_id, n_bytes, removed (spans of bytes, end
    exclusive, maximal), kept (the remaining bytes end to end)."""
    ensure_checkpoint_dir(docs.sparkSession)
    texts = with_row(docs, "doc_id", "text").withColumn(
        "rank", F.coalesce("doc_id", F.lit(_NO_ID).cast("long"))
    )
    found = settle(
        texts.select("_row", "rank", "text").mapInArrow(_segments, STRETCH), keep_first=True
    ).checkpoint()
    release_shuffles(docs.sparkSession)
    mixed = found.filter("mixed").groupBy("_row").agg(
        F.collect_set(F.struct("anchor", "part", "start", "end")).alias("unsettled")
    )
    # No column is left out here, so that both uses of the texts share one shuffle.
    pieces = (
        texts.join(mixed, "_row")
        .mapInArrow(_bytes_of_segments, _PIECES)
        .repartition("anchor", "part")
        .sortWithinPartitions("anchor", "part")
    )
    more = settle(pieces.mapInArrow(_sort_suffixes, STRETCH), keep_first=True)
    return texts.join(repeats_by_row(found, more), "_row", "left").mapInArrow(
        _cut,
        "_row bigint, doc_id bigint, n_bytes bigint, "
        "removed array<struct<start: bigint, end: bigint>>, kept binary",
    )

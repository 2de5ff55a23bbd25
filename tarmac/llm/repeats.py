"""Passages that repeat, found by keys that meet in one place.

Tasks describe stretches of their texts by two hashes: ``anchor``, of a part that every
copy of a long enough match has in the same place, and ``whole``, of all of the stretch.
Stretches that agree in both are equal, those that agree in the anchor only may still
share a long enough match, and all others share none.

A task first settles what repeats among its own stretches and sends only one of each kind
on, so the rows of a key are bounded by the number of slices read, not by the copies.
What is sent is sorted by key and walked in a stream that holds two rows.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.texts import BASES, mix, signed

#: ``rank`` orders the texts, ``place`` packs (start, end - start, several, settled).
STRETCH = "anchor bigint, whole bigint, rank bigint, _row bigint, place bigint"
_NAMES = ("anchor", "whole", "rank", "_row", "place")
FOUND = (
    "_row bigint, start bigint, end bigint, mixed boolean, anchor bigint, part bigint"
)
#: Kinds of stretches with one anchor that get the same ``part`` number.
PART = 16
_LENGTH_BITS, _FLAG_BITS = 28, 2
_BASE, _INVERSE = BASES[1], np.uint64(pow(int(BASES[1]), -1, 2**64))


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``values[start:end]`` of any lengths."""
    n = len(values)
    powers, back = np.full(n + 1, _BASE), np.full(n + 1, _INVERSE)
    powers[0] = back[0] = 1
    powers, back = np.cumprod(powers), np.cumprod(back)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers[:-1], out=total[1:])
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


def _packed(start, length, several, settled) -> np.ndarray:
    return (((start << _LENGTH_BITS) | length) << _FLAG_BITS) | (several * 2) | (settled * 1)


def _start(place: np.ndarray) -> np.ndarray:
    return place >> (_LENGTH_BITS + _FLAG_BITS)


def _length(place: np.ndarray) -> np.ndarray:
    return (place >> _FLAG_BITS) & ((1 << _LENGTH_BITS) - 1)


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], list(_NAMES))


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of the spans of each row: (row, start, end)."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    number = np.cumsum(np.concatenate([[0], np.diff(row) != 0]))
    stride = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * stride)
    opens = np.concatenate([[True], (start + number * stride)[1:] > reach[:-1]])
    closes = np.concatenate([opens[1:], [True]])
    return row[opens], start[opens], (reach - number * stride)[closes]


def union_of_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def stretches(anchor, whole, rank, row, start, end, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """What a slice sends on. Equal stretches are one row; those that are settled by it
    are united to spans. With ``keep_first`` the first of them, by rank, row and start,
    is no repeat of another."""
    if not len(anchor):
        return
    order = np.lexsort((start, row, rank, whole, anchor))
    anchor, whole, rank, row, start, end = (x[order] for x in (anchor, whole, rank, row, start, end))
    first = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(whole) != 0)])
    several = np.diff(np.concatenate([np.flatnonzero(first), [len(first)]])) > 1
    yield _batch(
        [
            signed(anchor[first]),
            signed(whole[first]),
            rank[first],
            row[first],
            _packed(start[first], (end - start)[first], several & (not keep_first), False),
        ]
    )
    yield from settled_spans(row[~first], start[~first], end[~first])


def settled_spans(row, start, end) -> Iterator[pa.RecordBatch]:
    """Stretches that are known to repeat; they only pass through ``settle``."""
    row, start, end = _merged(row, start, end)
    if len(row):
        spread = signed(mix(row.astype(np.uint64) + np.uint64(1)))
        zero = np.zeros(len(row), np.int64)
        yield _batch([spread, zero, zero, row, _packed(start, end - start, False, True)])


def _walk(keep_first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Settle sorted stretches: which repeat, and which share an anchor only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passed = [np.zeros(0, np.int64)] * 5, 0
        for batch in batches:
            new = [batch.column(i).to_numpy() for i in range(5)]
            ready = (new[4] & 1) == 1
            zero = np.zeros(ready.sum(), np.int64)
            found = [(new[3][ready], new[4][ready], zero > 0, zero, zero)]
            anchor, whole, rank, row, place = (
                np.concatenate([h, x[~ready]]) for h, x in zip(held, new)
            )
            if len(anchor):
                opens = np.concatenate([[True], np.diff(anchor) != 0])
                first = opens | np.concatenate([[True], np.diff(whole) != 0])
                last = np.concatenate([first[1:], [True]])
                repeat = ~first
                if not keep_first:
                    repeat = repeat | ~last | ((place & 2) != 0)
                run_of = np.cumsum(opens) - 1
                heads = np.flatnonzero(opens)
                kind = np.cumsum(first) - 1
                kind -= kind[heads][run_of]
                kind += np.where((run_of == 0) & (kind > 0), passed, 0)
                mixed = first & (np.bincount(run_of, first)[run_of] > 1)
                for some, is_mixed in ((repeat, False), (mixed, True)):
                    flag = np.full(some.sum(), is_mixed)
                    found += [(row[some], place[some], flag, anchor[some], kind[some] // PART)]
                # The run may go on: hold its first row and that of its last kind.
                hold = sorted({int(heads[-1]), int(np.flatnonzero(first)[-1])})
                passed = max(0, int(kind[hold[-1]]) - 1)
                place = place | np.where(repeat, 2, 0)
                held = [x[hold] for x in (anchor, whole, rank, row, place)]
            row, place, mixed, anchor, part = (np.concatenate(x) for x in zip(*found))
            if len(row):
                start = _start(place)
                columns = (row, start, start + _length(place), mixed, anchor, part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns],
                    ["_row", "start", "end", "mixed", "anchor", "part"],
                )

    return run


def settle(rows: DataFrame, keep_first: bool) -> DataFrame:
    """Rows like ``FOUND`` from rows like ``STRETCH``, some of them repeatedly.

    ``mixed`` false: the stretch repeats another (an earlier one, with ``keep_first``).
    ``mixed`` true: it shares its anchor with a stretch that differs from it; of equal
    ones only the first is told. ``part`` numbers the kinds that share an anchor, in
    portions of ``PART``.
    """
    keyed = rows.repartition("anchor").sortWithinPartitions(*_NAMES)
    return keyed.mapInArrow(_walk(keep_first), FOUND)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffles removed that nothing refers to any more.

    Spark removes them when the driver's garbage is collected, which may be long after a
    checkpoint has made them useless, while the next ones already fill the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def by_row(found: DataFrame, name: str) -> DataFrame:
    """One row per text: its spans as the array ``name``."""
    return found.groupBy("_row").agg(F.collect_list(F.struct("start", "end")).alias(name))


def repeats_by_row(*found: DataFrame) -> DataFrame:
    """What repeats according to one or other result of ``settle``: one row per text with
    its spans ``repeats``. One shuffle, so that a later join fetches from two only."""
    settled = [f.filter(~F.col("mixed")).select("_row", "start", "end") for f in found]
    return by_row(reduce(DataFrame.unionByName, settled), "repeats")

"""Benchmark decontamination with suffix arrays over the training texts.

Words are lower-cased runs of letters, digits and non-ASCII characters. Each slice of
the training texts is a shard. Its suffix array is built over the words that the
benchmark knows at all, in the runs of them that are long enough for a window; every
suffix of every benchmark text is then binary-searched in it. That gives the longest
verbatim match of each suffix and all places of the matches that hold a window: 13 words
of an item, or the whole of a shorter item.

The benchmark is sent to the tasks in blocks of about ``BLOCK_BYTES`` of text, each of
them searched in a scan of its own, so its size is bounded whatever the benchmark's.

A null text has no words; an item without words has no window. Repeated items count
once by their id, a null id is named "". Repeated rows of ``docs`` are separate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.texts import (
    ALNUM,
    Words,
    slices,
    split_words,
    with_row,
    with_row_of_all,
    word_hashes,
)
from tarmac.session import ensure_checkpoint_dir

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20


@dataclass
class Probes:
    """A block of benchmark texts as word numbers, item after item; 0 ends an item."""

    items: np.ndarray  # names
    known: np.ndarray  # hashes of the words, ascending; word k + 1 has hash known[k]
    words: np.ndarray
    item_of: np.ndarray  # of each position
    left: np.ndarray  # words to the end of the item
    start: np.ndarray  # positions of the suffixes
    need: np.ndarray  # words that a match of each must have to hold its window, or a
    # number that no match has where no window starts

    @staticmethod
    def of(names: list[str], texts: list[str | None]) -> Probes:
        words = split_words(pa.array(texts, pa.string()), ALNUM, lower=True)
        hashes = word_hashes(words)
        known, number = np.unique(hashes, return_inverse=True)
        gap = words.text_of()  # one 0 after each item before
        at = np.arange(len(hashes)) + gap
        size = np.diff(words.first)
        total = len(hashes) + len(size)
        numbers, item_of, left = (np.zeros(total, np.int64) for _ in range(3))
        numbers[at], item_of[at], left[at] = number + 1, gap, words.left()
        wanted = np.minimum(size, WINDOW)[gap]
        whole = (size[gap] >= WINDOW) | (words.left() == size[gap])
        need = np.where((words.left() >= wanted) & whole, wanted, total + 1)
        return Probes(np.array(names, object), known, numbers, item_of, left, at, need)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` words."""
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    order, span = np.argsort(rank, kind="stable"), 1
    while span < depth and len(words) and rank.max() + 1 < len(words):
        after = np.zeros_like(rank)
        after[:-span] = rank[span:] + 1
        key = rank * (len(words) + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty_like(fresh)
        rank[order] = fresh
        span *= 2
    return order


def _matching(a, i, b, j, most) -> np.ndarray:
    """Common words of ``a`` from each i and ``b`` from each j, at most ``most`` each."""
    same = np.zeros(len(i), np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        x, y = i[live] + same[live], j[live] + same[live]
        live = live[(y < len(b)) & (a[x] == b[np.minimum(y, len(b) - 1)])]
        same[live] += 1
        live = live[same[live] < most[live]]
    return same


def search(probes: Probes, start, length, shard, order, upper: bool) -> np.ndarray:
    """Binary search of every probe suffix, ``length`` words of it: how many suffixes
    of the shard lie below it or, if ``upper``, below or begin with it."""
    low = np.zeros(len(start), np.int64)
    high = np.full(len(start), len(order))
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        other = order[middle]
        same = _matching(probes.words, start[live], shard, other, length[live])
        begins = same == length[live]
        x = probes.words[np.minimum(start[live] + same, len(probes.words) - 1)]
        y = np.where(other + same < len(shard), shard[np.minimum(other + same, len(shard) - 1)], -1)
        right = np.where(begins, upper, y < x)
        low[live[right]] = middle[right] + 1
        high[live[~right]] = middle[~right]


def find_matches(probes: Probes, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches that hold a window: (first word in the shard, words of the longest
    verbatim match there, item), each item's windows in each place."""
    none = np.zeros(0, np.int64)
    if not len(probes.start) or not len(words.start):
        return none, none, none
    hashes = word_hashes(words)
    at = np.minimum(np.searchsorted(probes.known, hashes), len(probes.known) - 1)
    number = np.where(probes.known[at] == hashes, at + 1, 0)
    # Runs of known words within a text, at least as long as the shortest window.
    fresh = np.zeros(len(number), bool)
    fresh[words.first[:-1][np.diff(words.first) > 0]] = True
    inside = number > 0
    opens = np.flatnonzero(inside & (fresh | ~np.concatenate([[False], inside[:-1]])))
    run = np.cumsum(inside & (fresh | ~np.concatenate([[False], inside[:-1]]))) - 1
    long_enough = np.bincount(run[inside], minlength=len(opens)) >= probes.need.min()
    chosen = np.flatnonzero(inside)[long_enough[run[inside]]]
    if not len(chosen):
        return none, none, none
    gap = np.cumsum(np.concatenate([[False], np.diff(run[chosen]) > 0]))
    shard = np.zeros(len(chosen) + gap[-1] + 1, np.int64)
    where = np.full(len(shard), -1)
    shard[np.arange(len(chosen)) + gap] = number[chosen]
    where[np.arange(len(chosen)) + gap] = chosen
    order = suffix_array(shard, int(probes.left.max()))
    order = order[where[order] >= 0]

    lengths = probes.left[probes.start]
    place = search(probes, probes.start, lengths, shard, order, upper=False)
    longest = np.zeros(len(place), np.int64)
    for side in (place - 1, place):
        fits = (side >= 0) & (side < len(order))
        beside = order[np.clip(side, 0, len(order) - 1)]
        same = _matching(probes.words, probes.start, shard, beside, np.where(fits, lengths, 0))
        longest = np.maximum(longest, same)
    hit = np.flatnonzero(longest >= probes.need)
    start, need = probes.start[hit], probes.need[hit]
    low = search(probes, start, need, shard, order, upper=False)
    count = search(probes, start, need, shard, order, upper=True) - low
    each = np.repeat(np.arange(len(hit)), count)
    place = order[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(each))]
    size = _matching(probes.words, start[each], shard, place, lengths[hit][each])
    return where[place], size, probes.item_of[start[each]]


_SCHEMA = (
    "_row bigint, doc_id bigint, n_words bigint, "
    "spans array<struct<start: bigint, end: bigint>>, items array<string>, longest bigint"
)


def _search_shards(probes) -> object:
    """A function over batches: each row with what the block ``probes`` hits in it."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = probes.value
        for batch in slices(batches, "text", SHARD_BYTES):
            words = split_words(batch.column("text"), ALNUM, lower=True)
            n = batch.num_rows
            first, size, item = find_matches(block, words)
            text = np.searchsorted(words.first, first, side="right") - 1
            longest = np.zeros(n, np.int64)
            np.maximum.at(longest, text, size)
            edge = np.zeros(len(words.start) + 1, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + size, -1)
            covered = np.cumsum(edge[:-1]) > 0
            text_of = words.text_of()
            border = np.concatenate([[True], np.diff(text_of) > 0, [True]])[: len(covered) + 1]
            before = np.concatenate([[False], covered]) & ~border
            opens = np.flatnonzero(covered & ~before[:-1])
            after = np.concatenate([covered, [False]])[1:] & ~border[1:]
            closes = np.flatnonzero(covered & ~after) + 1
            base = words.first[text_of[opens]]
            values = pa.StructArray.from_arrays(
                [pa.array(opens - base), pa.array(closes - base)], fields=list(span)
            )
            bounds = np.searchsorted(text_of[opens], np.arange(n + 1))
            pairs = np.unique(text * len(block.items) + item)
            names = pa.array(block.items[pairs % len(block.items)], pa.string())
            item_bounds = np.searchsorted(pairs // len(block.items), np.arange(n + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    batch.column("doc_id"),
                    pa.array(np.diff(words.first)),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values),
                    pa.ListArray.from_arrays(pa.array(item_bounds, pa.int32()), names),
                    pa.array(longest),
                ],
                ["_row", "doc_id", "n_words", "spans", "items", "longest"],
            )

    return run


def _covered(spans: Column) -> Column:
    """Words in the union of spans, which may overlap."""
    none = F.lit(0).cast("long")
    zero = F.struct(none.alias("n"), none.alias("end"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(none, s["end"] - F.greatest(s["start"], a["end"]))).alias("n"),
        F.greatest(a["end"], s["end"]).alias("end"),
    )
    return F.aggregate(F.array_sort(spans), zero, step)["n"]


def _blocks(benchmark: DataFrame) -> Iterator[Probes]:
    """The distinct items in blocks; each is gathered by itself and is never empty."""
    named = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    ).distinct()
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    for k in range(count):
        rows = named.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).collect()
        if rows:
            yield Probes.of([r["item"] for r in rows], [r["text"] for r in rows])


def _written_hits(rows: DataFrame, block: Broadcast) -> DataFrame:
    """What a block finds in ``rows``, in the checkpoint folder; the block is destroyed."""
    ensure_checkpoint_dir(rows.sparkSession)
    hits = rows.mapInArrow(_search_shards(block), _SCHEMA).checkpoint()
    block.destroy()
    return hits


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: _row, doc_id, n_words, n_hit (words inside an
    occurrence of a window), items (names of the items found, sorted as strings),
    spans (of hit words), longest (words of the longest verbatim match that holds a
    window), contaminated (hits in at least a twentieth of the words)."""
    context = docs.sparkSession.sparkContext
    rows = with_row(docs, "doc_id", "text")
    found, held = [], None
    for block in _blocks(benchmark):
        # Another block comes: the hits of the one before are written, and it is let go.
        if held:
            found.append(_written_hits(rows, held))
        held = context.broadcast(block)
        del block
    if found:
        found.append(_written_hits(rows, held))
    else:
        held = held or context.broadcast(Probes.of([], []))
        found.append(rows.mapInArrow(_search_shards(held), _SCHEMA))
    merged = (
        reduce(DataFrame.unionByName, found)
        .groupBy("_row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.max("longest").alias("longest"),
        )
    )
    hit = _covered(F.col("spans"))
    return merged.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns."""
    affected = contamination(docs, benchmark).filter("contaminated").select("_row")
    rows = with_row_of_all(docs)
    return rows.join(affected, "_row", "left_anti").select("doc.*")

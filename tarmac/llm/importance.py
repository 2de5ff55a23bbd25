"""Quality by importance resampling.

Two generative models over hashed n-grams of words are compared: one of the target, texts
labelled good, one of the raw table, all of it. The weight of a text is the log of
the ratio of its probabilities, summed over its n-grams. Adding Gumbel noise to the log
weights and taking the k greatest samples k texts without replacement, each in proportion
to its weight.

Counts of the raw model cover all rows; the target model is fitted on at most
``TARGET_ROWS`` good rows, those whose ids hash lowest. k is a share of all rows; unless it
is given, it is the share of good rows among the labelled.

Null texts are empty; an empty text has weight 0 (log), as has every text without a target
row. The noise depends on doc_id and seed only, so repeated rows share it; ties in the noisy
weight go to the row that is read first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.texts import (
    SPACED,
    lowest_hashes,
    signed,
    slices,
    small_batches,
    split_words,
    window_hashes,
    with_row,
    word_hashes,
)
from tarmac.session import ensure_checkpoint_dir

NGRAMS = (1, 2)
BUCKET_BITS = 14
#: Mean count of a bucket that the raw model lends to the target model beforehand.
PRIOR = 200
TARGET_ROWS = 20_000
SEED = 1


def _buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram of a batch."""
    words = split_words(column, SPACED)
    hashes, text_of, left = word_hashes(words), words.text_of(), words.left()
    texts, found = [], []
    for n in NGRAMS:
        grams = window_hashes(hashes, n)
        whole = np.flatnonzero(left[: len(grams)] >= n)
        texts.append(text_of[whole])
        found.append((grams[whole] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(found)


def _counts(docs: DataFrame) -> np.ndarray:
    """n-grams in each bucket over all rows; tasks add up before they send."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in slices(batches, "text"):
            total += np.bincount(_buckets(batch.column("text"))[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    rows = (
        small_batches(docs)
        .select("text")
        .mapInArrow(run, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    out = np.zeros(1 << BUCKET_BITS)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def log_ratios(docs: DataFrame, labels: DataFrame, label: str = "quality") -> np.ndarray:
    """Log of target over raw probability of each bucket. The raw model is smoothed by one
    count, the target model by ``PRIOR`` counts dealt out like the raw model."""
    good = labels.filter((F.col(label) == 1) & F.col("doc_id").isNotNull()).select("doc_id")
    good = lowest_hashes(good.distinct(), TARGET_ROWS, "doc_id")
    target = _counts(docs.join(F.broadcast(good), "doc_id", "left_semi"))
    if not target.any():
        return np.zeros(len(target))
    raw = _counts(docs) + 1
    raw /= raw.sum()
    lent = PRIOR * len(target)
    return np.log((target + lent * raw) / (target.sum() + lent) / raw)


def _in_order(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles."""
    bits = signed(x.astype(np.float64))
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def weigh(docs: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """_row, doc_id, log_weight, noisy (log weight plus Gumbel noise), order (noisy as
    an integer of the same order)."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text_of, bucket = _buckets(batch.column("text"))
            weight = np.bincount(text_of, sent.value[bucket], batch.num_rows)
            coin = (batch.column("coin").to_numpy().view(np.uint64) >> np.uint64(11)) + 0.5
            noisy = weight - np.log(-np.log(coin / 2.0**53))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    batch.column("doc_id"),
                    pa.array(weight),
                    pa.array(noisy),
                    pa.array(_in_order(noisy)),
                ],
                ["_row", "doc_id", "log_weight", "noisy", "order"],
            )

    rows = with_row(docs, "doc_id", "text").withColumn(
        "coin", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(seed))
    )
    return rows.mapInArrow(
        run, "_row bigint, doc_id bigint, log_weight double, noisy double, order bigint"
    )


def kth_greatest(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The k-th greatest value of a column of longs, and how many rows are greater. Four
    counts by 16 bits each; no more than 65,536 counts reach the driver at once."""
    value, greater = 0, 0
    for step in range(4):
        shift = 48 - 16 * step
        digit = F.shiftright(column, shift)
        own = rows if step == 0 else rows.filter(F.shiftright(column, shift + 16) == value)
        counted = own.groupBy(digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        counts = {r["digit"]: r["n"] for r in counted.collect()}
        for value in sorted(counts, reverse=True):
            if greater + counts[value] >= k:
                break
            greater += counts[value]
    return value, greater


def resample(
    docs: DataFrame, labels: DataFrame, share: float | None = None, label: str = "quality"
) -> DataFrame:
    """A row for each row of ``docs``: _row, doc_id, log_weight, noisy, selected."""
    ensure_checkpoint_dir(docs.sparkSession)
    weighed = weigh(docs, log_ratios(docs, labels, label)).checkpoint()
    if share is None:
        known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        share = known.agg(F.avg((F.col(label) == 1).cast("double"))).first()[0] or 0.0
    total = weighed.count()
    k = min(total, round(share * total))
    if k == 0:
        return weighed.drop("order").withColumn("selected", F.lit(False))
    bar, greater = kth_greatest(weighed, "order", k)
    level = weighed.filter(F.col("order") == bar).withColumn("early", -F.col("_row"))
    last = -kth_greatest(level, "early", k - greater)[0]
    picked = (F.col("order") > bar) | ((F.col("order") == bar) & (F.col("_row") <= last))
    return weighed.withColumn("selected", picked).drop("order")

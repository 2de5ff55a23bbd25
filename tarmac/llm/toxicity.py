"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>) over the distinct terms of a text.
The pairwise part learns what terms mean together, such as an insult and the mention of
a group, which a sum of weights misses.

The machine is fitted on a bounded sample: of the labelled rows given for learning, the
``TRAIN_ROWS`` rows of either label whose ids hash lowest. Rows of one label that agree in
their three terms of least hash, as copies do, count once. The rows of a label weigh as much
as all its labelled rows, so base rate and threshold do not depend on the sample. Only terms that set the labels apart in
the sample have weights, so the length of a text does not move its score.

A null text is empty; a text without weighted terms gets the base rate w0. Labels other
than 0 and 1 are ignored, and a row with several labels counts as toxic if one of them is 1.
Without rows of both labels the score is constant: the share of label 1, or 0. A null
``doc_id`` is never learned from and counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.texts import (
    ALNUM,
    lowest_hashes,
    mix,
    slices,
    small_batches,
    split_words,
    word_hashes,
)

#: Most rows of either label in the training sample.
TRAIN_ROWS = 4000
#: Hashed terms: words, and the first bytes of longer words, which inflections share.
BUCKETS = 1 << 20
STEMS = (4, 5)
FACTORS = 4
#: Standard errors by which a term's share must differ between the labels.
LEAST_Z = 4.0
#: Terms in more than this share of the rows of label 0 are stop words of some language.
MOST_SHARE = 0.2
EPOCHS = 40
RATE = 0.2
SHRINK = 1e-5
_BATCH = 256


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text, and where each text's begin."""
    words = split_words(column, ALNUM, lower=True)
    text_of = words.text_of()
    keys = [text_of * BUCKETS + _bucket(word_hashes(words))]
    for stem in STEMS:
        longer = np.flatnonzero(words.end - words.start > stem)
        cut = replace(words, start=words.start[longer], end=words.start[longer] + stem)
        keys.append(text_of[longer] * BUCKETS + _bucket(word_hashes(cut, seed=stem)))
    keyed = np.unique(np.concatenate(keys))
    first = np.searchsorted(keyed, np.arange(len(words.first)) * BUCKETS)
    return (keyed % BUCKETS).astype(np.int32), first


@dataclass
class Machine:
    base: float
    terms: np.ndarray  # ascending
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, terms: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The sum before the sigmoid, for each text."""
        n = len(first) - 1
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        hit = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        text_of = np.repeat(np.arange(n), np.diff(first))[hit]
        return self.base + _sums(text_of, n, at[hit], self.weight, self.factor)[0]

    def score(self, column: pa.Array) -> np.ndarray:
        return _sigmoid(self.raw(*text_terms(column)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _sums(text_of, n, at, weight, factor) -> tuple[np.ndarray, np.ndarray]:
    """Linear plus pairwise part of each text, and its summed factors."""
    total = np.zeros((n, factor.shape[1]))
    squares = np.zeros(n)
    for k in range(factor.shape[1]):
        v = factor[at, k]
        total[:, k] = np.bincount(text_of, v, n)
        squares += np.bincount(text_of, v * v, n)
    linear = np.bincount(text_of, weight[at], n)
    return linear + 0.5 * ((total**2).sum(axis=1) - squares), total


def fit_machine(
    rows: list[np.ndarray],
    labels: np.ndarray,
    seed: int = 7,
    totals: tuple[float, float] | None = None,
) -> Machine:
    """Fit on the distinct terms of each row, by adaptive gradient steps. ``totals`` are the
    rows of label 0 and 1 that the given ones stand for, by default themselves."""
    labels = labels.astype(float)
    n, toxic = len(labels), int(labels.sum())
    none = np.zeros(0)
    if not n or toxic in (0, n):
        return Machine(40.0 if n and toxic else -40.0, none, none, none.reshape(0, FACTORS))
    sizes = np.array([len(r) for r in rows])
    flat, text_of = np.concatenate(rows).astype(np.int64), np.repeat(np.arange(n), sizes)
    with_one = np.bincount(flat, labels[text_of], BUCKETS)
    with_all = np.bincount(flat, minlength=BUCKETS).astype(float)
    share1, share0 = with_one / toxic, (with_all - with_one) / (n - toxic)
    pooled = with_all / n
    spread = np.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / (n - toxic)))
    z = np.divide(share1 - share0, spread, out=np.zeros(BUCKETS), where=spread > 0)
    telling = (np.abs(z) >= LEAST_Z) & (with_all >= 3) & (share0 <= MOST_SHARE)
    terms = np.flatnonzero(telling)
    number = np.full(BUCKETS, -1)
    number[terms] = np.arange(len(terms))
    at, text_of = number[flat], text_of[number[flat] >= 0]
    at = at[at >= 0]
    first = np.searchsorted(text_of, np.arange(n + 1))

    all0, all1 = totals or (n - toxic, toxic)
    counts = np.where(labels > 0, all1 / toxic, all0 / (n - toxic)) * (n / (all0 + all1))
    rng = np.random.default_rng(seed)
    base, weight = float(np.log(all1 / all0)), np.zeros(len(terms))
    factor = rng.normal(0, 0.05, (len(terms), FACTORS))
    seen_w, seen_v, seen_b = np.full(len(terms), 1e-6), np.full(factor.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for low in range(0, n, _BATCH):
            batch = order[low : low + _BATCH]
            count = first[batch + 1] - first[batch]
            own = np.repeat(np.arange(len(batch)), count)
            picked = np.repeat(first[batch] - (np.cumsum(count) - count), count)
            ids = at[picked + np.arange(len(picked))]
            raw, total = _sums(own, len(batch), ids, weight, factor)
            error = (_sigmoid(base + raw) - labels[batch]) * counts[batch] / len(batch)
            slope_w = np.bincount(ids, error[own], len(terms)) + SHRINK * weight
            slope_v = SHRINK * factor
            for k in range(FACTORS):
                pull = error[own] * (total[own, k] - factor[ids, k])
                slope_v[:, k] += np.bincount(ids, pull, len(terms))
            seen_w += slope_w**2
            seen_v += slope_v**2
            seen_b += error.sum() ** 2
            weight -= RATE * slope_w / np.sqrt(seen_w)
            factor -= RATE * slope_v / np.sqrt(seen_v)
            base -= RATE * error.sum() / np.sqrt(seen_b)
    return Machine(base, terms, weight, factor)


def _lowest_terms(terms: np.ndarray) -> bytes:
    """The terms of least hash: alike in copies and in most near copies."""
    return np.sort(mix(np.asarray(terms).astype(np.uint64)))[:3].tobytes()


def _sample(labels: DataFrame, label: str) -> DataFrame:
    """At most ``TRAIN_ROWS`` ids of either label, with the ``total`` of ids that have it."""
    one = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    sides = [one.filter(F.col("label") == k) for k in (0, 1)]
    totals = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    picks = [
        lowest_hashes(side, TRAIN_ROWS, "doc_id").withColumn("total", F.lit(totals.get(k, 0)))
        for k, side in enumerate(sides)
    ]
    return picks[0].unionByName(picks[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Machine:
    """Fit on the rows of ``docs`` that ``labels`` (doc_id, ``label``) marks. The fit
    is one task over the sample, which ``TRAIN_ROWS`` bounds."""
    sample = F.broadcast(_sample(labels, label).select("doc_id", "label", "order", "total"))
    rows = small_batches(docs).select("doc_id", "text").join(sample, "doc_id")
    rows = rows.select("label", "order", F.col("total").cast("long").alias("total"), "text")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, first = text_terms(batch.column("text"))
            found = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label").cast(pa.int32()),
                    batch.column("order"),
                    batch.column("total"),
                    found,
                ],
                ["label", "order", "total", "terms"],
            )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "label"], kind="stable")
        alike = pd.DataFrame({"label": rows["label"], "low": rows["terms"].map(_lowest_terms)})
        rows = rows[~alike.duplicated(keep="first")]
        total = rows.groupby("label")["total"].first()
        totals = (total[0], total[1]) if len(total) == 2 else None
        machine = fit_machine(list(rows["terms"]), rows["label"].to_numpy(), totals=totals)
        parts = [np.array([machine.base]), machine.weight, machine.factor.ravel()]
        return pd.DataFrame({"terms": [machine.terms], "values": [np.concatenate(parts)]})

    fitted = (
        rows.mapInArrow(terms, "label int, order bigint, total bigint, terms array<int>")
        .withColumn("model", F.lit(0))
        .groupBy("model")
        .applyInPandas(fit, "terms array<bigint>, values array<double>")
        .collect()
    )
    if not fitted:
        return fit_machine([], np.zeros(0))
    ids = np.array(fitted[0]["terms"], np.int64)
    values = np.array(fitted[0]["values"])
    weight, factor = values[1 : 1 + len(ids)], values[1 + len(ids) :]
    return Machine(values[0], ids, weight, factor.reshape(-1, FACTORS))


def score_texts(docs: DataFrame, machine: Machine) -> DataFrame:
    """Each row of ``docs`` as the struct ``doc``, with the ``score`` of its ``text``."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    rows = small_batches(docs).select(F.struct("*").alias("doc"), "text")
    schema = rows.select("doc").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = pa.array(model.value.score(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), score], ["doc", "score"])

    return rows.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for each row; learned outside fold 0."""
    machine = train(docs, labels.filter(id_fold(F.col("doc_id"), folds) != 0))
    return score_texts(docs.select("doc_id", "text"), machine).select(
        "doc.doc_id",
        F.coalesce(id_fold(F.col("doc.doc_id"), folds) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns."""
    machine = train(docs, labels.filter(id_fold(F.col("doc_id"), folds) != 0))
    return score_texts(docs, machine).filter(F.col("score") < 0.5).select("doc.*")

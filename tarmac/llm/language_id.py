"""Language identification by segmentation-marginalised unigrams.

Every language is a distribution over the pieces of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, by the forward
algorithm; that of a text is the product over its words. Learning is expectation
maximisation with the same sums. The vocabulary's byte pieces stand for whatever else
occurs, so every word has a probability. Pieces that begin a word begin with a space here.

Learned from a bounded sample: at most ``TRAIN_ROWS`` rows a language, those whose ids hash
lowest. Every language is learned and scored, in blocks of ``BLOCK_LANGUAGES`` if there are
more. Languages are equally likely beforehand. Letters are folded to lower case; digits and punctuation say nothing.

Texts are taken whole, however long, and each row by itself: repeated rows get repeated
results, an empty table an empty one, and columns other than ``doc_id``, ``text`` and ``lang``
are not read, whatever they are called. A text that is null or has no letter is ``und`` with score 0, as is every text if
nothing could be learned. Ties go to the language that sorts first. Rows with a null doc_id
or lang are never learned from; a null doc_id counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.texts import (
    distinct,
    hash_share,
    slices,
    small_batches,
    split_words,
    with_row,
    word_hashes,
)
from tarmac.llm.toxicity import id_fold

TRAIN_ROWS = 400
#: Languages that are learned and scored at once.
BLOCK_LANGUAGES = 256
ROUNDS = 4
#: Expected count that every piece has beforehand.
PRIOR = 0.01
UNKNOWN = "und"

_LETTERS = np.zeros(256, bool)
_LETTERS[0x61:0x7B] = True
_LETTERS[0x80:] = True
# Words that a worker keeps, and their probabilities under all languages of a block.
_CACHE_WORDS, _CACHE_CELLS = 1_000_000, 1 << 26
_BLOCK = 1 << 17  # cells of the word matrix that are worked on at once
_RESCALE = 16
_PART_BYTES = 64


class Pieces:
    """The vocabulary as byte strings, found by hash in a table of two levels."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = {
            model.id_to_piece(i).replace("▁", " ").encode()
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
        found = sorted(p for p in plain if b" " not in p[1:]) + [bytes([b]) for b in range(256)]
        self.pieces = list(dict.fromkeys(found))
        self.longest = max(map(len, self.pieces))
        self.factor = np.uint64(0x9E3779B97F4A7C15)
        data = np.frombuffer(b"".join(self.pieces), np.uint8)
        size = np.array([len(p) for p in self.pieces])
        first = np.cumsum(size) - size
        hashes = np.zeros(len(size), np.uint64)
        for k in range(self.longest):
            live = np.flatnonzero(size > k)
            hashes[live] = self.extend(hashes[live], data[first[live] + k])
        self.tables = []
        rest = np.arange(len(size))
        for shift in (44, 22):
            slot = ((hashes[rest] >> np.uint64(shift)) & np.uint64(0xFFFFF)).astype(np.int64)
            table = np.full(1 << 20, -1, np.int32)
            table[slot] = rest
            self.tables.append((np.uint64(shift), table))
            rest = rest[table[slot] != rest]
        self.spare = {int(hashes[i]): int(i) for i in rest}  # a handful at most
        self.hashes = np.append(hashes, np.uint64(0))

    def extend(self, hashes: np.ndarray, following: np.ndarray) -> np.ndarray:
        h = (hashes + following.astype(np.uint64) + np.uint64(1)) * self.factor
        return h ^ (h >> np.uint64(29))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each piece, or the number of pieces where there is none."""
        out = np.full(hashes.shape, len(self.pieces), np.int32)
        for shift, table in self.tables:
            slot = table[((hashes >> shift) & np.uint64(0xFFFFF)).astype(np.int64)]
            out = np.where((slot >= 0) & (self.hashes[slot] == hashes), slot, out)
        for value, number in self.spare.items():
            out[hashes == np.uint64(value)] = number
        return out


@lru_cache(maxsize=1)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def _word_matrix(words: list[bytes]) -> np.ndarray:
    """One row per word of one length, with a space in front."""
    return np.frombuffer(b"".join(b" " + w for w in words), np.uint8).reshape(len(words), -1)


def _numbers(matrix: np.ndarray, pieces: Pieces) -> list[np.ndarray]:
    """By length - 1: numbers of the pieces that begin at each place of each word."""
    width = matrix.shape[1]
    hashes, out = np.zeros(matrix.shape, np.uint64), []
    for k in range(min(pieces.longest, width)):
        hashes = pieces.extend(hashes[:, : width - k], matrix[:, k:])
        out.append(pieces.find(hashes))
    return out


def _forward(numbers: list[np.ndarray], chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled sums over all segmentations of each beginning, and the log of the scales of
    the whole word. ``chance`` has a row per piece and one of zeros behind them."""
    words, width = numbers[0].shape
    alpha = np.zeros((width + 1, words, chance.shape[1]))
    alpha[0] = 1
    scale = np.zeros((words, 1))
    for end in range(1, width + 1):
        for k in range(min(len(numbers), end)):
            alpha[end] += alpha[end - k - 1] * chance[numbers[k][:, end - k - 1]]
        if end % _RESCALE == 0:
            top = alpha[end].max(axis=1, keepdims=True)
            top[top == 0] = 1
            alpha[max(0, end - len(numbers)) : end + 1] /= top
            scale += np.log(top)
    return alpha, scale


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Words of one length, in portions: their numbers and themselves."""
    size = np.array([len(w) for w in words])
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        own = size[order[at]]
        end = int(np.searchsorted(size[order], own, side="right"))
        end = min(end, at + max(1, _BLOCK // (own + 1)))
        yield order[at:end], [words[i] for i in order[at:end]]
        at = end


def word_logs(words: list[bytes], pieces: Pieces, chance: np.ndarray) -> np.ndarray:
    """Log probability of each word (row) in each language (column)."""
    out = np.zeros((len(words), chance.shape[1]))
    for at, own in _by_length(words):
        alpha, scale = _forward(_numbers(_word_matrix(own), pieces), chance)
        out[at] = np.log(np.maximum(alpha[-1], 1e-300)) + scale
    return out


def learn(
    words: list[bytes], counts: np.ndarray, pieces: Pieces, rounds: int = ROUNDS
) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation."""
    size = np.array([len(p) for p in pieces.pieces], float)
    chance = np.append(np.exp(-size) / np.exp(-size).sum(), 0)[:, None]
    for _ in range(rounds):
        expected = np.zeros(len(pieces.pieces) + 1)
        for at, own in _by_length(words):
            numbers = _numbers(_word_matrix(own), pieces)
            n, width = numbers[0].shape
            alpha = np.zeros((width + 1, n))
            beta = np.zeros((width + 1, n))
            alpha[0] = beta[width] = 1
            step = [chance[x, 0] for x in numbers]
            for end in range(1, width + 1):
                for k in range(min(len(numbers), end)):
                    alpha[end] += alpha[end - k - 1] * step[k][:, end - k - 1]
            for start in range(width - 1, -1, -1):
                for k in range(min(len(numbers), width - start)):
                    beta[start] += beta[start + k + 1] * step[k][:, start]
            weight = counts[at] / np.maximum(alpha[width], 1e-300)
            for k, found in enumerate(numbers):
                used = alpha[: width - k].T * step[k] * beta[k + 1 :].T * weight[:, None]
                expected += np.bincount(found.ravel(), used.ravel(), len(expected))
        share = expected[:-1] + PRIOR
        chance = np.append(share / share.sum(), 0)[:, None]
    return chance[:-1, 0]


def _letters(column: pa.Array):
    """Words of letters, in lower case."""
    return split_words(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")), _LETTERS)


def _examples(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    own = id_fold(F.col("doc_id"), folds) != held_out
    return docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & own)


def _sample(docs: DataFrame, langs: dict[str, int], folds: int, held_out: int) -> DataFrame:
    """(doc_id, lang) of the rows to learn from, for languages with their numbers of rows; its
    size is bounded by that of a block of languages."""
    counts = docs.sparkSession.createDataFrame([*langs.items()], "lang string, count bigint")
    order = Window.partitionBy("lang").orderBy(hash_share("doc_id"), "doc_id")
    # Twice as many as wanted pass by their hash, so few rows of a language meet.
    return (
        _examples(docs, folds, held_out)
        .select("doc_id", "lang")
        .join(F.broadcast(counts), "lang")
        .filter(hash_share("doc_id") <= 2.0 * TRAIN_ROWS / F.col("count"))
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= TRAIN_ROWS)
        .select("doc_id", "lang")
        .distinct()
    )


def train(
    docs: DataFrame, vocabulary_path: str, folds: int = 4, held_out: int = 2
) -> dict[str, np.ndarray]:
    """Piece probabilities of each language that the rows outside the fold ``held_out`` name.

    Languages are learned in blocks of ``BLOCK_LANGUAGES``, each from a sample of its own.
    """
    counts = _examples(docs, folds, held_out).groupBy("lang").count()
    found = sorted(map(tuple, counts.collect()))  # a row for each language
    model: dict[str, np.ndarray] = {}
    for low in range(0, len(found), BLOCK_LANGUAGES):
        block = dict(found[low : low + BLOCK_LANGUAGES])
        model |= _fit_block(docs, _sample(docs, block, folds, held_out), vocabulary_path)
    return model


def _fit_block(docs: DataFrame, sample: DataFrame, vocabulary_path: str) -> dict[str, np.ndarray]:
    """Piece probabilities of the languages in the sample (doc_id, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs = batch.column("lang").to_pylist()
            words = _letters(batch.column("text"))
            text_of = words.text_of()
            frame = pd.DataFrame(
                {
                    "lang": [langs[k] for k in text_of],
                    "word": [words.bytes_of(k) for k in range(len(text_of))],
                }
            )
            counted = frame.groupby(["lang", "word"], sort=False).size().reset_index(name="n")
            yield pa.RecordBatch.from_pandas(counted, preserve_index=False)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("word")
        words, counts = [], []
        for word, n in zip(rows["word"], rows["n"]):
            # Long strings are learned from in parts, so that no sum vanishes.
            words += [word[k : k + _PART_BYTES] for k in range(0, len(word), _PART_BYTES)]
            counts += [n] * (len(words) - len(counts))
        found = learn(words, np.array(counts, float), pieces_of(vocabulary_path))
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "chance": [found]})

    fitted = (
        small_batches(docs)
        .select("doc_id", "lang", "text")
        .join(F.broadcast(sample), ["doc_id", "lang"])
        .select("lang", "text")
        .mapInArrow(count, "lang string, word binary, n bigint")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .applyInPandas(fit, "lang string, chance array<double>")
        .collect()
    )
    return {r["lang"]: np.array(r["chance"]) for r in sorted(fitted, key=lambda r: r["lang"])}


class _WordTable:
    """Log probabilities of words by hash; kept from batch to batch to save work."""

    def __init__(self, pieces: Pieces, chance: np.ndarray):
        self.pieces, self.chance = pieces, chance
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.logs = np.zeros((0, self.chance.shape[1]), np.float32)

    def of(self, words) -> np.ndarray:
        hashes, first, which = distinct(word_hashes(words))
        if len(self.keys) > min(_CACHE_WORDS, _CACHE_CELLS // self.chance.shape[1]):
            self._forget()
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(hashes[new])]
            found = word_logs([words.bytes_of(k) for k in first[new]], self.pieces, self.chance)
            place = at[new]
            self.keys = np.insert(self.keys, place, hashes[new])
            self.logs = np.insert(self.logs, place, found.astype(np.float32), axis=0)
        return self.logs[np.searchsorted(self.keys, hashes)[which]]


_TABLES: dict = {}


def _table(key: int, path: str, chance: np.ndarray) -> _WordTable:
    """The table of a model in this worker; that of an earlier model is let go."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = _WordTable(pieces_of(path), chance)
    return _TABLES[key]


def _block_scores(
    docs: DataFrame, block: dict[str, np.ndarray], vocabulary_path: str
) -> DataFrame:
    """_row, doc_id, and of the block's languages the best, its log probability, the sum of all
    probabilities as multiples of the best's; null for texts without letters."""
    names = np.array([*block], object)
    chance = np.stack([*block.values()], axis=1)
    chance = np.vstack([chance, np.zeros((1, chance.shape[1]))])
    sent = docs.sparkSession.sparkContext.broadcast(chance)
    stamp = hash(chance.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            column = batch.column("text")
            words = _letters(column)
            n, k = batch.num_rows, len(names)
            logs = _table(stamp, vocabulary_path, sent.value).of(words)
            text_of = words.text_of()
            total = np.stack([np.bincount(text_of, logs[:, i], n) for i in range(k)], axis=1)
            best = total.argmax(axis=1)
            top = total[np.arange(n), best]
            # ASCII letters are words already; other words may be all symbols.
            letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False)
            known = np.asarray(letters) & (np.diff(words.first) > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    batch.column("doc_id"),
                    pa.array(np.where(known, names[best], None), pa.string()),
                    pa.array(top),
                    pa.array(np.exp(total - top[:, None]).sum(axis=1)),
                ],
                ["_row", "doc_id", "best", "top", "sum"],
            )

    return with_row(docs, "doc_id", "text").mapInArrow(
        run, "_row bigint, doc_id bigint, best string, top double, sum double"
    )


def identify(docs: DataFrame, model: dict[str, np.ndarray], vocabulary_path: str) -> DataFrame:
    """doc_id, lang_pred, score (probability of that language given the text).

    Up to ``BLOCK_LANGUAGES`` languages are scored in one scan without a shuffle. More are scored
    in blocks, a scan each, and the best of a text's blocks counts.
    """
    langs = sorted(model)
    blocks = [langs[k : k + BLOCK_LANGUAGES] for k in range(0, len(langs), BLOCK_LANGUAGES)]
    if not blocks:
        none = F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        return docs.select("doc_id", *none)
    scored = [_block_scores(docs, {n: model[n] for n in own}, vocabulary_path) for own in blocks]
    found = scored[0]
    if len(blocks) > 1:
        # Of languages with equal scores the first by name, as within a block.
        rows = reduce(DataFrame.union, scored).groupBy("_row").agg(
            F.first("doc_id").alias("doc_id"),
            F.collect_list(F.struct((-F.col("top")).alias("less"), "best", "sum")).alias("own"),
        )
        first = F.array_min("own")
        share = F.aggregate(
            "own", F.lit(0.0), lambda t, x: t + x["sum"] * F.exp(first["less"] - x["less"])
        )
        found = rows.select("doc_id", first["best"].alias("best"), share.alias("sum"))
    return found.select(
        "doc_id",
        F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("best").isNotNull(), 1 / F.greatest("sum", F.lit(1.0))).otherwise(0.0).alias("score"),
    )


def identify_held_out(
    docs: DataFrame, vocabulary_path: str, folds: int = 4, held_out: int = 2
) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned outside the fold ``held_out``."""
    model = train(docs, vocabulary_path, folds, held_out)
    fold = id_fold(F.col("doc_id"), folds) == held_out
    return identify(docs, model, vocabulary_path).select(
        "doc_id", F.coalesce(fold, F.lit(True)).alias("held_out"), "lang_pred", "score"
    )

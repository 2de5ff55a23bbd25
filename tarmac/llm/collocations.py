"""Phrase collocation mining: phrases of two and three words that hold together.

Texts are cut into pieces at punctuation and line ends and pieces into words at spaces.
Everything is counted per language; a null language is ``und``.

1. **Words** are counted per block of text and then over all. Those that occur often enough
   to be in a phrase at all get short numbers, as long as there are at most ``DICTIONARY``
   of them; beyond that the most frequent ones do and the others go by their hash. The
   numbers only shorten what is moved, and let suffixes with a rare word be left out.
2. **Suffixes** of up to three words, as pointers into the block, are brought to one record
   for each that is different, with its count, and routed by their two leading words: a
   record goes to the part that a hash of both names. So all suffixes with these words
   meet, however frequent either of them is. A part's share of a block is one row in
   transposed bytes under zstd. Where more than ``WAYS`` parts are needed, rows are routed in
   several passes, and equal records are joined in each.
3. **Parts** are sorted by a multikey three-way quicksort of the pointers down to the third
   word. The total of an equal partition is the count of its phrase; a partition below the least
   count is abandoned, which is right as nothing of it lies elsewhere. All partitions of a
   round are cut at once.
4. **Scores** are joins of the counted phrases, in exact decimals.

Texts are taken whole, however long; a null or empty one has no words. Repeated rows count
as often as they occur, ids are not read. An empty table has no phrases. Only ``text`` and
``lang`` are read, whatever other columns are called. Ties are ordered down to the phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.packed import squeeze, stretch
from tarmac.llm.texts import (
    Words,
    distinct,
    mix,
    signed,
    slices,
    small_batches,
    split_words,
    word_hashes,
)
from tarmac.session import ensure_checkpoint_dir

LEAST = 10
TOP = 2000
#: A phrase goes if a longer one has so many hundredths of its occurrences.
COVER = 50
SCALE = 1_000_000
NO_LANGUAGE = "und"

#: Text that is worked on at once.
BLOCK_BYTES = 8 << 20
#: Words with a short number.
DICTIONARY = 1 << 20
#: Words of the corpus for each part, and ways of one routing pass.
PART_WORDS, WAYS = 2_000_000, 1024
#: Rows of a part that are put together at once.
FAN_IN = 256
#: Buckets over which the best phrases of a language are sought first.
_SPREAD = 64

_INSIDE = np.ones(256, bool)
_INSIDE[[0x09, *range(0x0A, 0x0E), 0x20, *b".,;:!?"]] = False
_CUTS = np.zeros(256, bool)
_CUTS[[*range(0x0A, 0x0E), *b".,;:!?"]] = True
_LONG_CODE = np.uint64(1 << 63)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PACKED = np.uint64(21)  # bits of three numbers in one

Records = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # three words, count


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``BLOCK_BYTES`` of text."""
    held, size = [], 0
    for batch in slices(batches, "text", BLOCK_BYTES):
        own = batch.nbytes
        if held and size + own > BLOCK_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _split(batch: pa.RecordBatch) -> tuple[Words, np.ndarray, list[str]]:
    """Words of a block, their codes (of language and word, 63 bits), languages of the texts."""
    words = split_words(batch.column("text"), _INSIDE, lower=True)
    langs = [NO_LANGUAGE if v is None else v for v in batch.column("lang").to_pylist()]
    known = {v: xxhash.xxh3_64_intdigest(v) for v in set(langs)}
    of_text = np.array([known[v] for v in langs], np.uint64)
    codes = mix(word_hashes(words) * _STEP + of_text[words.text_of()])
    return words, codes >> np.uint64(1), langs


def _pieces(words: Words) -> np.ndarray:
    """Number of the piece that each word belongs to."""
    cuts = np.concatenate([[0], np.cumsum(_CUTS[words.data])])
    fresh = np.zeros(len(words.start), bool)
    fresh[1:] = cuts[words.start[1:]] > cuts[words.end[:-1]]
    fresh[words.first[:-1][np.diff(words.first) > 0]] = True
    return np.cumsum(fresh)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, code, n): how often each word occurs in a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            words, codes, langs = _split(block)
            values, first_seen, which = distinct(codes)
            text_of = words.text_of()
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([langs[k] for k in text_of[first_seen]], pa.string()),
                    "word": pa.array([words.bytes_of(k).decode() for k in first_seen], pa.string()),
                    "code": pa.array(signed(values), pa.int64()),
                    "n": pa.array(np.bincount(which, minlength=len(values)), pa.int64()),
                }
            )

    rows = small_batches(docs).select("lang", "text")
    counted = rows.mapInArrow(run, "lang string, word string, code bigint, n bigint")
    return counted.groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))


def combined(records: Records) -> Records:
    """Equal records as one, in ascending order."""
    a, b, c, n = records
    if not len(n):
        return records
    if max(a.max(), b.max(), c.max()) >> _PACKED == 0:
        key = (a << (2 * _PACKED)) | (b << _PACKED) | c
        order = np.argsort(key)
        key = key[order]
        fresh = np.append(True, key[1:] != key[:-1])
    else:
        order = np.lexsort((c, b, a))
        fresh = np.append(True, np.zeros(len(n) - 1, bool))
        for v in (a, b, c):
            fresh[1:] |= v[order][1:] != v[order][:-1]
    first = np.flatnonzero(fresh)
    kept = order[first]
    return a[kept], b[kept], c[kept], np.add.reduceat(n[order], first)


def _suffixes(words: Words, codes: np.ndarray, short: np.ndarray, all_short: bool) -> Records:
    """Suffixes of at least two words that may be frequent. Words of ``short``, ascending
    codes, are told by their place in it, from 1 on; 0 is none."""
    if len(short):
        at = np.minimum(np.searchsorted(short, codes), len(short) - 1)
        hit = short[at] == codes
        value = np.where(hit, (at + 1).astype(np.uint64), np.uint64(0))
    else:
        hit, value = np.zeros(len(codes), bool), np.zeros(len(codes), np.uint64)
    if not all_short:
        value = np.where(hit, value, codes | _LONG_CODE)
    piece = np.append(_pieces(words), [-1, -2])
    value = np.append(value, np.zeros(2, np.uint64))
    n = len(codes)
    here = np.flatnonzero((piece[:n] == piece[1 : n + 1]) & (value[:n] > 0) & (value[1 : n + 1] > 0))
    third = np.where(piece[here] == piece[here + 2], value[here + 2], np.uint64(0))
    return value[here], value[here + 1], third, np.ones(len(here), np.uint64)


def _route(records: Records, before: int, ways: int) -> tuple[np.ndarray, np.ndarray]:
    """The way that each record takes in a pass, after passes with ``before`` ways in all."""
    h = mix(records[0] * _STEP + mix(records[1] + _STEP))
    return ((h // np.uint64(before)) % np.uint64(ways)).astype(np.int64)


_DDL = "part bigint, run bigint, a binary, b binary, c binary, n binary"
_ROW = pa.schema(
    [("part", pa.int64()), ("run", pa.int64()), *((c, pa.binary()) for c in "abcn")]
)


def _pack(records: Records) -> dict[str, bytes]:
    a, b, c, n = records
    return {
        "a": squeeze(np.diff(a, prepend=np.uint64(0))),
        "b": squeeze(b),
        "c": squeeze(c),
        "n": squeeze(n.astype(np.uint32) if n.max(initial=0) < 1 << 32 else n),
    }


def _unpack(rows: pa.Table | pa.RecordBatch) -> Records:
    """Records of all rows, one after the other."""
    parts = [[stretch(v) for v in rows[c].to_pylist()] for c in "abcn"]
    parts[0] = [np.cumsum(v, dtype=np.uint64) for v in parts[0]]
    return tuple(np.concatenate([np.zeros(0, np.uint64), *p]).astype(np.uint64) for p in parts)


def _dealt(records: Records, part: int, run: int, before: int, ways: int) -> pa.RecordBatch:
    """A row for each way that some of the records take."""
    records = combined(records)
    way = _route(records, before, ways)
    order = np.argsort(way.astype(np.uint16) if ways <= 1 << 16 else way, kind="stable")
    way = way[order]
    cuts = np.flatnonzero(np.diff(way, prepend=-1, append=ways))
    out: dict[str, list] = {f.name: [] for f in _ROW}
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        packed = _pack(tuple(v[order[low:high]] for v in records))
        for name, value in (packed | {"part": part + before * int(way[low]), "run": run}).items():
            out[name].append(value)
    return pa.RecordBatch.from_pydict(out, _ROW)


def _passes(n_parts: int) -> list[int]:
    """Ways of each routing pass."""
    out = []
    while n_parts > WAYS:
        out.append(WAYS)
        n_parts = math.ceil(n_parts / WAYS)
    return [*out, max(1, n_parts)]


def _routed(docs: DataFrame, short: np.ndarray, all_short: bool, n_parts: int) -> DataFrame:
    """(part, run, records), checkpointed."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(short)
    ways = _passes(n_parts)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 32
        for block in _blocks(batches):
            words, codes, _ = _split(block)
            yield _dealt(_suffixes(words, codes, held.value, all_short), 0, run, 1, ways[0])
            run += 1

    rows = small_batches(docs).select("lang", "text").mapInArrow(first, _DDL)
    before = ways[0]
    for more in ways[1:]:

        def again(batches, before=before, more=more) -> Iterator[pa.RecordBatch]:
            run = TaskContext.get().partitionId() << 32
            held_rows: list[pa.RecordBatch] = []
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1)
                    if held_rows and (
                        row["part"][0] != held_rows[0]["part"][0]
                        or sum(r.nbytes for r in held_rows) > BLOCK_BYTES
                    ):
                        part = held_rows[0]["part"][0].as_py()
                        yield _dealt(_unpack(pa.Table.from_batches(held_rows)), part, run, before, more)
                        held_rows, run = [], run + 1
                    held_rows.append(row)
            if held_rows:
                part = held_rows[0]["part"][0].as_py()
                yield _dealt(_unpack(pa.Table.from_batches(held_rows)), part, run, before, more)

        packs = F.pmod(F.xxhash64("run"), F.lit(FAN_IN))
        rows = rows.checkpoint().repartition("part", packs).sortWithinPartitions("part")
        rows = rows.mapInArrow(again, _DDL)
        before *= more
    return rows.checkpoint()


def multikey_groups(
    columns: np.ndarray, weights: np.ndarray, least: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, pointers, totals): the phrases of two and three words that weigh at least
    ``least``, each by one of its pointers.

    ``columns`` are the words of each suffix by their depth, 0 where it has none.
    """
    draw = np.random.default_rng(12)
    depths = len(columns)
    at = np.arange(len(weights))
    size, depth = np.array([len(at)]), np.array([0])
    while len(at):
        segment = np.repeat(np.arange(len(size)), size)
        start = np.cumsum(size) - size
        value = columns[depth[segment], at]
        pivot = value[start + (draw.random(len(size)) * size).astype(np.int64)]
        own = pivot[segment]
        sides = []
        for side, mask in enumerate((value < own, value == own, value > own)):
            pointers, of = at[mask], segment[mask]
            deeper = depth + (side == 1)
            total = np.bincount(of, weights=weights[pointers], minlength=len(size))
            if side == 1:
                enough = np.flatnonzero((total >= least) & (pivot > 0))
                first = np.searchsorted(of, enough)
                for words in range(2, depths + 1):
                    mine = deeper[enough] == words
                    if mine.any():
                        yield words, pointers[first[mine]], total[enough[mine]].astype(np.int64)
                open_ = (total >= least) & (pivot > 0) & (deeper < depths)
                pointers, of = pointers[open_[of]], of[open_[of]]
                # a suffix that ends here belongs to no longer phrase
                goes_on = columns[np.minimum(deeper[of], depths - 1), pointers] > 0
                pointers, of = pointers[goes_on], of[goes_on]
                total = np.bincount(of, weights=weights[pointers], minlength=len(size))
            kept = total >= least
            pointers, of = pointers[kept[of]], of[kept[of]]
            sizes = np.bincount(of, minlength=len(size))
            used = sizes > 0
            sides.append((pointers, sizes[used], deeper[used]))
        at, size, depth = (np.concatenate(v) for v in zip(*sides))


def _together(table: pa.Table) -> pa.Table:
    """Rows of a part as one."""
    packed = _pack(combined(_unpack(table)))
    row = {"part": table["part"][0].as_py(), "run": table["run"][0].as_py(), **packed}
    return pa.table({f.name: pa.array([row[f.name]], f.type) for f in _ROW})


def _phrases(rows: DataFrame, short: np.ndarray, n_runs: int) -> DataFrame:
    """(words, c1, c2, c3, a): codes and counts of the frequent phrases."""
    held = rows.sparkSession.sparkContext.broadcast(short)

    def sort(table: pa.Table) -> pa.Table:
        *columns, weights = combined(_unpack(table))
        columns, codes = np.stack(columns), np.append(held.value, np.uint64(0))
        found: dict[str, list] = {c: [] for c in ("words", "c1", "c2", "c3", "a")}
        for words, pointers, total in multikey_groups(columns, weights, LEAST):
            for k, name in enumerate(("c1", "c2", "c3")):
                value = columns[k, pointers] if k < words else np.zeros(len(pointers), np.uint64)
                long = value & _LONG_CODE > 0
                number = np.where(long, np.uint64(0), value).astype(np.int64)
                code = np.where(long, value & ~_LONG_CODE, codes[number - 1])
                found[name].append(signed(code))
            found["words"].append(np.full(len(pointers), words))
            found["a"].append(total)
        return pa.table(
            {c: np.concatenate([np.zeros(0, np.int64), *v]) for c, v in found.items()}
        )

    while n_runs > FAN_IN:
        n_runs = math.ceil(n_runs / FAN_IN)
        pack = F.pmod(F.xxhash64("run"), F.lit(n_runs)).alias("pack")
        rows = rows.select("*", pack).groupBy("part", "pack").applyInArrow(_together, _DDL).checkpoint()
    schema = "words bigint, c1 bigint, c2 bigint, c3 bigint, a bigint"
    return rows.groupBy("part").applyInArrow(sort, schema)


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly."""
    wide = [F.col(c).cast("decimal(15,0)") for c in (a, left, right)]
    product = (wide[0] * wide[0] * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)")
    below = (wide[1] * wide[2]).cast("decimal(38,0)")
    return F.call_function("div", product, below)


def _best(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The first ``TOP`` rows of each language, with their rank; ``order`` ends with what is
    distinct. They are sought in buckets first."""
    bucket = F.pmod(F.xxhash64("c1", "c2", "c3"), F.lit(_SPREAD))
    for keys in ([bucket.alias("bucket")], []):
        window = Window.partitionBy("lang", *(["bucket"] if keys else [])).orderBy(*order)
        rows = rows.select("*", *keys).withColumn("rank", F.row_number().over(window))
        rows = rows.filter(F.col("rank") <= TOP)
        rows = rows.drop("rank", "bucket") if keys else rows
    return rows


def collocations(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``TOP`` best phrases of each language."""
    ensure_checkpoint_dir(docs.sparkSession)
    words = word_counts(docs).checkpoint()
    totals = words.groupBy("lang").agg(F.sum("n").alias("n")).checkpoint()
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    often = words.filter(F.col("n") >= LEAST).select("lang", "word", "code", F.col("n").alias("f"))
    often = often.checkpoint()
    all_short = often.count() <= DICTIONARY
    numbered = often if all_short else often.orderBy(F.desc("f"), "code").limit(DICTIONARY)
    short = numbered.select("code").toPandas()["code"].to_numpy(np.int64).view(np.uint64)
    short = np.sort(short)
    rows = _routed(docs, short, all_short, math.ceil(n_words / PART_WORDS))
    n_runs = rows.select("run").distinct().count()
    found = _phrases(rows, short, n_runs).checkpoint()

    two = found.filter("words = 2").select("c1", "c2", "a")
    count = often.select(F.col("code"), F.col("lang"), F.col("f"))
    first = count.select(F.col("code").alias("c1"), "lang", F.col("f").alias("f1"))
    second = count.select(F.col("code").alias("c2"), F.col("f").alias("f2"))
    two = two.join(first, "c1").join(second, "c2").checkpoint()
    head = two.select("c1", "c2", "lang", "f1", F.col("a").alias("a12"))
    tail = two.select(
        F.col("c1").alias("c2"), F.col("c2").alias("c3"), F.col("a").alias("a23"), F.col("f2").alias("f3")
    )
    three = found.filter("words = 3").join(head, ["c1", "c2"]).join(tail, ["c2", "c3"]).checkpoint()
    longer = (
        three.select("c1", "c2", "a")
        .union(three.select("c2", "c3", "a"))
        .groupBy("c1", "c2")
        .agg(F.max("a").alias("longest"))
    )
    pairs = (
        two.join(longer, ["c1", "c2"], "left")
        .filter(F.col("longest").isNull() | (100 * F.col("longest") < COVER * F.col("a")))
        .select(
            "lang", "c1", "c2", F.lit(None).cast("bigint").alias("c3"), "a",
            F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"),
        )
    )
    # The lower cut counts, of equal ones the first.
    cuts = three.withColumns({"s1": _score("a", "f1", "a23"), "s2": _score("a", "a12", "f3")})
    lower = F.col("s1") <= F.col("s2")
    triples = cuts.select(
        "lang", "c1", "c2", "c3", "a",
        F.when(lower, F.col("f1")).otherwise(F.col("a12")).alias("l"),
        F.when(lower, F.col("a23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    scored = pairs.union(triples).checkpoint()

    order = [F.desc("score"), F.desc("a")]
    ahead = _best(scored.select("lang", "c1", "c2", "c3", "score", "a"), [*order, "c1", "c2", "c3"])
    bar = ahead.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("bar"))
    near = scored.join(bar, "lang").filter(F.struct("score", "a") >= F.col("bar")).drop("bar")
    named = near
    for k in (1, 2, 3):
        name = often.select(F.col("code").alias(f"c{k}"), F.col("word").alias(f"w{k}"))
        named = named.join(name, f"c{k}", "left")
    named = named.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    ranked = _best(named.drop("w1", "w2", "w3"), [*order, F.asc("phrase")])
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )

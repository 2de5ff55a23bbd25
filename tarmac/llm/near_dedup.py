"""Near dedup by order min-hash, verified by banded alignment.

A text is the sequence of its shingles of five words. Shingles are labelled with their
occurrence, so they are distinct within a text. Each coordinate of the sketch takes the
``PICKS`` labelled shingles that are least under its permutation and keeps them in the
order of the text; texts that agree in a coordinate share a bucket. Both the shingles and
their order have to agree, which makes the sketch sensitive to edit similarity.

Similarity of two texts is m / (n1 + n2 - m), where n1, n2 count shingles and m is the
most shingles that can be aligned in order. It is at most the Jaccard similarity J of the
labelled shingles, and equal where edits leave the order alone. An alignment that reaches the
threshold never strays further from the diagonal than the shingles it may leave out,
so only matches in that band are aligned. A deleted occurrence shifts all later labels; where
labels leave common shingles out of order, those without labels are aligned.

No bucket is expanded into all its pairs:

1. Copies (equal word sequences) are one node, their least row.
2. The head of a bucket is the member that shares most buckets with others, counted with their
   sizes. A text belongs to the family of the highest of the heads of its buckets. Of a
   family all members are compared with its middle: the one whose votes, 128 bits that depend on
   few shingles each, agree best with those of most members. Near copies of one text differ
   from it less than from each other, so it is in the middle, whichever is read first. That
   is one pair a text.
3. Buckets that still hold several components hold texts that share a long passage only, or
   families whose common origin is missing. All their members go through an exact join:
   shingles have one order, about from the rarest, and the first shingle that two texts
   have in common leaves enough of both for a J of the threshold, which only holds for the
   first few of either. Texts meet by these and not by the passage, whose shingles are
   frequent, unless the passage alone makes them similar; those that differ by more shingles
   than they may do not meet, as 1,024 parity bits of either show. No two members of the largest
   component that a shingle holds meet, so a family that step 2 has joined costs nothing here.

Texts of fewer than five words are one shingle, texts without words (null included)
are copies of one another. A class is a connected component; its id is its least doc_id
and its one kept row is the first row with that id; nulls yield to any id.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.components import components
from tarmac.llm.exact_dedup import join_on_digest
from tarmac.llm.texts import (
    SPACED,
    mix,
    signed,
    slices,
    split_words,
    window_hashes,
    with_row,
    with_row_of_all,
    word_hashes,
)
from tarmac.session import ensure_checkpoint_dir

SHINGLE = 5
THRESHOLD = 0.8
#: Coordinates of the sketch and shingles a coordinate.
COORDINATES, PICKS = 16, 3
#: Counters by which shingles are put in order, from the rarest.
COUNTERS = 1 << 20
#: Times 64 bits by which texts that meet in the exact join are told apart.
PARITY_WORDS = 16
#: Occurrences from which the places of a shingle are kept as one number.
_FREQUENT = 1000
#: Places by which the band is moved on at once.
_SLIDE = 256

#: Common shingles for a J of ``THRESHOLD``, as a share of the shingles of both texts.
_SHARE = THRESHOLD / (1 + THRESHOLD)

_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 2**63, 64, dtype=np.uint64)
_TIMES = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def plain_shingles(word_values: np.ndarray) -> np.ndarray:
    """Hashes of the shingles in order."""
    return window_hashes(word_values, max(1, min(len(word_values), SHINGLE)))


def shingles(word_values: np.ndarray) -> np.ndarray:
    """Hashes of the shingles in order, each labelled with its occurrence."""
    return label_occurrences(plain_shingles(word_values))


def label_occurrences(plain: np.ndarray) -> np.ndarray:
    """The hashes, of which the first occurrence of each stays as it is."""
    if not len(plain):
        return plain
    order = np.argsort(plain, kind="stable")
    fresh = np.concatenate([[True], np.diff(plain[order]) != 0])
    if fresh.all():
        return plain
    at = np.arange(len(plain))
    label = np.empty(len(plain), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return np.where(label > 0, mix(plain + label), plain)


def sketch(labelled: np.ndarray, coordinates: int, picks: int) -> np.ndarray:
    """One hash per coordinate; nothing for a text without words."""
    n = len(labelled)
    if not n:
        return np.zeros(0, np.uint64)
    picks = min(picks, n)
    out = np.empty(coordinates, np.uint64)
    step = max(1, (1 << 20) // n)  # permutations that are held at once
    for low in range(0, coordinates, step):
        own = slice(low, min(coordinates, low + step))
        ranked = (labelled ^ _XOR[own, None]) * _TIMES[own, None]
        least = np.argpartition(ranked, picks - 1, axis=1)[:, :picks]
        least.sort(axis=1)  # back to the order of the text
        total = np.arange(own.start, own.stop, dtype=np.uint64)
        for k in range(picks):
            total = mix(total ^ labelled[least[:, k]])
        out[own] = total
    return out


def votes_of(labelled: np.ndarray) -> list[int]:
    """Two times 64 bits, each two of the least shingle among a 64th of all."""
    spread = np.sort(mix(labelled ^ _XOR[0]))[::-1]
    least = np.zeros(64, np.uint64)
    least[(spread >> np.uint64(58)).astype(np.int64)] = spread  # the last one written is the least
    bits = [(least >> np.uint64(k) & np.uint64(1)).astype(np.uint8) for k in (0, 1)]
    return [int(np.packbits(b).view(">i8")[0]) for b in bits]


def longest_common(a: np.ndarray, b: np.ndarray, band: int | None = None) -> int:
    """Most elements of ``a`` and ``b`` that can be matched in order, each with one that lies
    at most ``band`` places before or behind."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    left = n - head
    differ = np.flatnonzero(a[::-1][:left] != b[::-1][:left])
    tail = int(differ[0]) if len(differ) else left
    x, y = a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist()
    if band is None:
        band = max(len(x), len(y))
    places: dict[int, list[int]] = {}
    for j, value in enumerate(x):
        places.setdefault(value, []).append(j)
    frequent: dict[int, int] = {}
    # A row of the dynamic program as the bits of one number: its steps are the zeros. Only
    # the part from ``low`` on is held, as no match changes what lies behind the band.
    low, width, done = 0, 2 * band + _SLIDE + 1, 0
    row = every = (1 << width) - 1
    for i, value in enumerate(y):
        if i - band >= low + _SLIDE:
            step = i - band - low
            done += step - (row & ((1 << step) - 1)).bit_count()
            row = (row >> step) | (every ^ (every >> step))
            low += step
        own = places.get(value)
        if not own:
            continue
        here = frequent.get(value)
        if here is None and len(own) > _FREQUENT:
            bits = bytearray(len(x) // 8 + 1)
            for j in own:
                bits[j >> 3] |= 1 << (j & 7)
            here = frequent[value] = int.from_bytes(bits, "little")
        if here is not None:
            match = (here >> low) & every
            first, last = max(0, i - band - low), i + band - low
            match = (match >> first << first) & ((1 << (last + 1)) - 1)
        else:
            match = 0
            for j in own[bisect_left(own, i - band) : bisect_right(own, i + band)]:
                match |= 1 << (j - low)
        match &= row
        row = ((row + match) | (row - match)) & every
    return head + tail + done + width - row.bit_count()


def alignment(
    a: np.ndarray, b: np.ndarray, threshold: float, plain: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[float, float]:
    """Jaccard similarity of two labelled shingle sequences, and their similarity in
    order; the latter is 0 where it cannot reach ``threshold``. ``plain`` are the shingles
    without labels, for texts that repeat some."""
    total = len(a) + len(b)
    common, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    jaccard = len(common) / (total - len(common)) if total else 1.0
    if jaccard < threshold:
        return jaccard, 0.0
    # m / (total - m) >= threshold leaves at most so many shingles unaligned
    band = total - 2 * threshold * total / (1 + threshold)
    near = np.abs(in_a - in_b) <= band
    where = in_b[near][np.argsort(in_a[near])]
    if len(where) > 1 and (np.diff(where) < 0).any():
        tails: list[int] = []  # least last match of the alignments of each length
        for j in where.tolist():
            at = bisect_left(tails, j)
            tails[at : at + 1] = [j]
        aligned = len(tails)
    else:
        aligned = len(where)
    # Labels pair equal occurrences only; no alignment has more than the common ones.
    if aligned < len(common) and plain is not None:
        if (plain[0] != a).any() or (plain[1] != b).any():
            aligned = max(aligned, longest_common(*plain, int(band)))
    return jaccard, aligned / (total - aligned) if total else 1.0


def _prints(docs: DataFrame) -> DataFrame:
    """_row, doc_id, digest of the word sequence, sketch, votes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"), SPACED)
            values = word_hashes(words)
            digests, sketches, votes, ends = [], [], [], [0]
            for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                own = values[low:high]
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                labelled = shingles(own)
                sketches.append(sketch(labelled, COORDINATES, PICKS))
                votes.append(votes_of(labelled))
                ends.append(ends[-1] + len(sketches[-1]))
            keys = pa.array(signed(np.concatenate(sketches)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    batch.column("doc_id"),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys),
                    pa.array(votes, pa.list_(pa.int64())),
                ],
                ["_row", "doc_id", "digest", "sketch", "votes"],
            )

    schema = "_row bigint, doc_id bigint, digest binary, sketch array<bigint>, votes array<bigint>"
    return with_row(docs, "doc_id", "text").mapInArrow(run, schema)


def _word_values(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, words) for the rows ``wanted`` (node): their word hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"), SPACED)
            values = (word_hashes(words) >> np.uint64(24)).astype(np.uint64)
            raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            packed = [
                raw[low:high].tobytes()
                for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(packed, pa.binary())], ["node", "words"]
            )

    wanted = wanted.select(F.col("node").alias("_row"))
    rows = with_row(docs, "text").join(wanted, "_row", "left_semi")
    return rows.mapInArrow(run, "node bigint, words binary")


def _unpack(words: bytes) -> np.ndarray:
    """Shingles of what ``_word_values`` packs, five bytes a word."""
    raw = np.frombuffer(words, np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    return plain_shingles(mix(wide.view("<u8").ravel()))


def _compare(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b, jaccard, similarity) of the pairs (a, b); ``words`` by node."""
    left = words.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("words_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, plain, own = None, None, None
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("a", "words_a", "words_b"))
            for a, x, y in zip(*columns):
                if a != held:
                    held, plain = a, _unpack(x)
                    own = label_occurrences(plain)
                other = _unpack(y)
                found.append(
                    alignment(own, label_occurrences(other), THRESHOLD, (plain, other))
                )
            jaccard, similarity = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("a"),
                    batch.column("b"),
                    pa.array(jaccard, pa.float64()),
                    pa.array(similarity, pa.float64()),
                ],
                ["a", "b", "jaccard", "similarity"],
            )

    texts = pairs.select("a", "b").join(left, "a").join(right, "b")
    return texts.mapInArrow(run, "a bigint, b bigint, jaccard double, similarity double")


def _shared(buckets: DataFrame) -> DataFrame:
    """(key, node, score) of the buckets (key, node) that hold several nodes; the score of a
    node is the number of members of all its buckets."""
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").checkpoint()
    members = buckets.join(sizes, "key").checkpoint()  # apart, so that a hot key can be split
    scores = members.groupBy("node").agg(F.sum("n").alias("score"))
    return members.select("key", "node").join(scores, "node").checkpoint()


def _heads(members: DataFrame) -> DataFrame:
    """(key, head, head_score): of each bucket the member (key, node, score) that scores
    most, of equal ones the least."""
    first = F.max(F.struct("score", (-F.col("node")).alias("last"))).alias("first")
    return members.groupBy("key").agg(first).select(
        "key", (-F.col("first.last")).alias("head"), F.col("first.score").alias("head_score")
    )


def _undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) of the members of buckets that hold several components."""
    own = members.join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label")
    )
    ends = own.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = ends.filter("low < high").select("key").checkpoint()
    return own.join(mixed, "key").select("node", "label").distinct().checkpoint()


def _middles(nearest: DataFrame, votes: DataFrame) -> DataFrame:
    """(node, head): for the families (node, head), whose heads are nodes of them too, the member
    that agrees best with what most members vote, in place of the head. ``votes`` has
    (node, votes, score); of members that agree alike the one with the highest score counts."""
    family = nearest.union(nearest.select(F.col("head").alias("node"), "head")).distinct()
    family = family.join(votes, "node").checkpoint()
    places = [(k, i) for k in (0, 1) for i in range(64)]
    bits = [
        F.sum(F.shiftright(F.col("votes")[k], i).bitwiseAND(F.lit(1))).alias(f"bit{k}_{i}")
        for k, i in places
    ]
    counted = family.groupBy("head").agg(F.count(F.lit(1)).alias("n"), *bits)
    most = {
        k: reduce(
            Column.bitwiseOR,
            [F.shiftleft((2 * F.col(f"bit{k}_{i}") > F.col("n")).cast("bigint"), i) for i in range(64)],
        )
        for k in (0, 1)
    }
    most = counted.select("head", *[m.alias(f"most{k}") for k, m in most.items()]).checkpoint()
    off = [F.bit_count(F.col("votes")[k].bitwiseXOR(F.col(f"most{k}"))) for k in (0, 1)]
    best = F.min(F.struct((off[0] + off[1]).alias("off"), (-F.col("score")).alias("less"), "node"))
    middle = family.join(most, "head").groupBy("head").agg(best.alias("best"))
    middle = middle.select("head", F.col("best.node").alias("middle")).checkpoint()
    found = family.join(middle, "head").select("node", F.col("middle").alias("head"))
    return found.filter("node != head")


def _spokes(members: DataFrame, votes: DataFrame) -> DataFrame:
    """(a, b): each member with the middle of its family."""
    spokes = members.join(_heads(members).checkpoint(), "key").filter("head != node")
    nearest = spokes.groupBy("node").agg(
        F.max(F.struct("head_score", (-F.col("head")).alias("last"))).alias("first")
    )
    nearest = nearest.select("node", (-F.col("first.last")).alias("head")).checkpoint()
    scored = votes.join(members.select("node", "score").distinct(), "node")
    pairs = _middles(nearest, scored)
    ends = [F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")]
    return pairs.select(*ends).distinct()


def _counter(labelled: np.ndarray) -> np.ndarray:
    return (labelled >> np.uint64(44)).astype(np.int64)


def _frequencies(words: DataFrame) -> np.ndarray:
    """For each counter, the shingles of ``words`` that fall to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for packed in batch.column("words").to_pylist():
                np.add.at(total, _counter(label_occurrences(_unpack(packed))), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"counter": used, "n": total[used]})

    counted = words.mapInArrow(run, "counter bigint, n bigint").groupBy("counter")
    found = counted.agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[found["counter"].to_numpy()] = found["n"].to_numpy()
    return out


def first_shingles(
    labelled: np.ndarray, frequency: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """The shingles by which a text meets others, and their places in the order. Those that
    no other text can have are left out."""
    n = len(labelled)
    count = frequency[_counter(labelled)]
    order = np.lexsort((labelled, count))[: n - _at_least(threshold * n) + 1]
    place = np.flatnonzero(count[order] > 1)
    return labelled[order[place]], place


def parities(labelled: np.ndarray) -> np.ndarray:
    """``PARITY_WORDS`` times 64 bits: whether an odd number of shingles falls to each. Two texts
    differ by as many shingles at least as they do by bits."""
    place = (mix(labelled ^ _XOR[1]) % np.uint64(64 * PARITY_WORDS)).astype(np.int64)
    odd = (np.bincount(place, minlength=64 * PARITY_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def _parities(words: DataFrame) -> DataFrame:
    """(node, m0, m1, ...) of the words by node."""
    names = [f"m{k}" for k in range(PARITY_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [
                parities(label_occurrences(_unpack(packed))) for packed in batch.column("words").to_pylist()
            ]
            columns = np.array(own, np.int64).reshape(len(own), PARITY_WORDS).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), *(pa.array(c) for c in columns)], ["node", *names]
            )

    return words.mapInArrow(run, "node bigint, " + ", ".join(f"{n} bigint" for n in names))


def _at_least(x: float) -> int:
    """``x`` rounded up, but for what rounding may have added to it."""
    return int(np.ceil(x - 1e-9))


def _prefix_pairs(members: DataFrame, words: DataFrame) -> DataFrame:
    """(a, b): every pair of the members (node, label) with different labels that can have
    a J of ``THRESHOLD``."""
    words = words.join(members.select("node"), "node", "left_semi").checkpoint()
    frequency = words.sparkSession.sparkContext.broadcast(_frequencies(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, packed in zip(*(batch.column(c).to_pylist() for c in ("node", "words"))):
                labelled = label_occurrences(_unpack(packed))
                keys, place = first_shingles(labelled, frequency.value, THRESHOLD)
                n = np.full(len(keys), len(labelled))
                # Of the shorter text of a pair fewer shingles are enough.
                short = place <= len(labelled) - _at_least(_SHARE * 2 * len(labelled))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": signed(keys),
                        "node": np.full(len(keys), node),
                        "n": n,
                        "rest": n - place,
                        "short": short,
                    }
                )

    schema = "key bigint, node bigint, n bigint, rest bigint, short boolean"
    rows = words.mapInArrow(run, schema).join(members, "node").checkpoint()
    parts = rows.groupBy("key", "label").agg(
        F.count(F.lit(1)).alias("n"), F.max("short").alias("short")
    )
    mixed = (
        parts.groupBy("key")
        .agg(
            F.max(F.struct("n", F.col("label").alias("most"))).alias("top"),
            F.max("short").alias("short"),
            F.count(F.lit(1)).alias("parts"),
        )
        .filter("parts > 1 and short")
        .select("key", F.col("top.most").alias("most"))
        .checkpoint()
    )
    rows = rows.join(mixed, "key").join(_parities(words), "node").checkpoint()
    bits = [f"m{k}" for k in range(PARITY_WORDS)]

    def side(kept: Column, name: str) -> DataFrame:
        names = {"node": name, **{c: f"{name}_{c}" for c in ("label", "n", "rest", *bits)}}
        return rows.filter(kept).select("key", *(F.col(c).alias(to) for c, to in names.items()))

    # No two members of the largest part of a key meet.
    away, short = F.col("label") != F.col("most"), F.col("short")
    enough = _SHARE * (F.col("x_n") + F.col("y_n")) - 1e-6
    unlike = [F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in bits]
    unlike = reduce(Column.__add__, unlike)
    found = [
        side(of_x & short, "x")
        .join(side(of_y, "y"), "key")
        .filter(
            (F.col("x_label") != F.col("y_label"))
            & (F.col("x_n") <= F.col("y_n"))
            & (F.least("x_rest", "y_rest") >= enough)
            & (unlike <= F.col("x_n") + F.col("y_n") - 2 * enough)
        )
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        for of_x, of_y in ((away, F.lit(True)), (~away, away))
    ]
    return found[0].union(found[1]).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: _row, doc_id, class_id, class_size (rows), kept."""
    ensure_checkpoint_dir(docs.sparkSession)
    prints = _prints(docs).checkpoint()
    copies = (
        prints.groupBy("digest")
        .agg(
            F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "_row")).alias("first"),
            F.count(F.lit(1)).alias("group_size"),
            F.first("sketch").alias("sketch"),
            F.first("votes").alias("votes"),
        )
        .withColumn("node", F.col("first._row"))
        .checkpoint()
    )
    members = _shared(copies.select("node", F.explode("sketch").alias("key")))
    words = _word_values(docs, members.select("node").distinct()).checkpoint()

    tried = _compare(_spokes(members, copies.select("node", "votes")), words).checkpoint()
    links = tried.filter(F.col("similarity") >= THRESHOLD).select("a", "b")
    undecided = _undecided(members, components(links))
    if not undecided.isEmpty():
        rest = _prefix_pairs(undecided, words).join(tried.select("a", "b"), ["a", "b"], "left_anti")
        found = _compare(rest, words).filter(F.col("similarity") >= THRESHOLD)
        links = links.union(found.select("a", "b").checkpoint())
    labels = components(links)

    nodes = copies.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    nodes = nodes.select("digest", "first", "group_size", "label")
    whole = nodes.groupBy("label").agg(
        F.min("first").alias("keeper"), F.sum("group_size").alias("class_size")
    )
    return join_on_digest(
        prints.select("_row", "doc_id", "digest"), nodes.join(whole, "label").drop("first", "label")
    ).select(
        "_row",
        "doc_id",
        F.col("keeper.doc_id").alias("class_id"),
        "class_size",
        (F.col("_row") == F.col("keeper._row")).alias("kept"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, all columns."""
    dropped = classes(docs).filter(~F.col("kept")).select("_row")
    rows = with_row_of_all(docs)
    return rows.join(dropped, "_row", "left_anti").select("doc.*")

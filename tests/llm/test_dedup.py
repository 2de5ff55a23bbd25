"""Duplicates of all kinds against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import differences
from tarmac.llm import components, exact_dedup, near_dedup, queries, repeats, substring_dedup, suffix_dedup
from tarmac.llm.gsaca import suffix_arrays
from tests.llm.conftest import rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLE[name]) == []


def test_index_keeps_texts_of_earlier_batches(spark, table):
    index = exact_dedup.DigestIndex(spark)
    try:
        first = index.ingest(table([(5, "a b"), (3, "a\t b"), (None, "a b"), (7, None), (8, "")])).collect()
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in first} == {
            5: (3, 3, False), 3: (3, 3, True), None: (3, 3, False), 7: (7, 2, True), 8: (7, 2, False),
        }
        second = index.ingest(table([(1, "a b"), (9, "new"), (9, "new")])).collect()
        assert sorted((r.doc_id, r.keep_id, r.kept) for r in second) == [(1, 3, False), (9, 9, False), (9, 9, True)]
        assert index.rows().count() == 3
        third = index.ingest(table([(2, "new")])).collect()
        assert [(r.keep_id, r.kept) for r in third] == [(9, False)]
    finally:
        index.drop()


@pytest.mark.parametrize("appended", ["all", "some"])
def test_a_batch_may_be_ingested_again(spark, table, monkeypatch, appended):
    """As by a driver that died after the append, or that had appended a part of it only."""
    index = exact_dedup.DigestIndex(spark)
    try:
        index.ingest(table([(1, "a"), (2, "b")]), "monday")
        rows = table([(3, "b"), (4, "c"), (5, "c"), (6, "d"), (None, "e")])
        if appended == "some":
            append = exact_dedup.DigestIndex._append
            monkeypatch.setattr(
                exact_dedup.DigestIndex, "_append", lambda self, new: append(self, new.filter("keep_id = 4"))
            )
            index.ingest(rows, "tuesday")
            monkeypatch.undo()
        else:
            index.ingest(rows, "tuesday")
        again = index.ingest(rows, "tuesday").collect()
        assert {(r.doc_id, r.keep_id, r.kept) for r in again} == {
            (3, 2, False), (4, 4, True), (5, 4, False), (6, 6, True), (None, None, True),
        }
        assert index.rows().count() == 5
        assert not any(r.kept for r in index.ingest(rows, "wednesday").collect())
    finally:
        index.drop()


def test_a_batch_goes_to_the_index_and_not_the_other_way(spark, sf_dir):
    docs = queries.given(spark, sf_dir, "documents")
    index = exact_dedup.DigestIndex(spark, buckets=6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index.ingest(docs.limit(50)).count()
        again = exact_dedup.DigestIndex(spark, index.name, buckets=99)
        assert again.buckets == 6
        groups = docs.groupBy(exact_dedup.text_digest(F.col("text")).alias("digest")).count()
        novel = groups.join(again.rows().hint("merge"), "digest", "left_anti")
        plan = novel._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        index_side = plan.split("+- Sort [digest")[-1]
        assert "SelectedBucketsCount: 6 out of 6" in index_side and "Exchange" not in index_side
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        index.drop()


def test_exact_dedup_takes_awkward_rows(awkward, empty):
    kept = exact_dedup.distinct_texts(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 5, 6, 7, 8, 9, 10, None])
    assert exact_dedup.dedup_exact(empty).count() == 0


def test_exact_dedup_runs_no_python(spark, sf_dir):
    docs = queries.given(spark, sf_dir, "documents")
    plan = exact_dedup.with_row(docs, exact_dedup.text_digest(F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_suffix_arrays_match_sorting():
    random.seed(6)
    for _ in range(150):
        strings = [
            [random.randint(1, random.choice([1, 2, 3, 26])) for _ in range(random.randint(0, 40))] + [0]
            for _ in range(random.randint(1, 8))
        ]
        strings += [[1, 2] * 15 + [0], [2] * 20 + [0], [1, 2, 2, 1, 2, 2, 1, 2] * 3 + [0]]
        begins = np.cumsum([0] + [len(s) for s in strings])
        found = suffix_arrays(np.concatenate(strings), begins)
        for k, s in enumerate(strings):
            want = sorted(range(len(s)), key=lambda i: s[i:])
            assert (found[begins[k] : begins[k + 1]] - begins[k]).tolist() == want


def documents_with_shared_passages(alphabet, seed, glue, count=60):
    random.seed(seed)
    passages = [random.choices(alphabet, k=700) for _ in range(3)]

    def text():
        if random.random() < 0.15:
            return random.choice([None, ""])
        passage, at = random.choice(passages), random.randint(0, 590)
        middle = passage[at : at + random.randint(1, 250)]
        before, after = (random.choices(alphabet, k=random.randint(0, 70)) for _ in range(2))
        return glue.join(before + middle + after)

    rows = [(random.choice([None, *range(200)]), text()) for _ in range(count)]
    return rows + rows[:3]


def words_without_repeats(rows, window=35):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = Counter(tuple(w[a : a + window]) for _, w in split for a in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = {
            k
            for a in range(len(w) - window + 1)
            if seen[tuple(w[a : a + window])] > 1
            for k in range(a, a + window)
        }
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("vocabulary", [2, 3, 50])
def test_word_windows_match_brute_force(table, vocabulary):
    rows = documents_with_shared_passages([f"w{k}" for k in range(vocabulary)], vocabulary, " ")
    found = substring_dedup.remove_repeats(table(rows)).select(
        "doc_id", "n_words", queries._span_total("removed"), "kept_text"
    )
    assert rows_of(found) == words_without_repeats(rows)


def test_substring_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in queries.given(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in words_without_repeats(rows)]
    assert rows_of(queries.op3_substring_dedup(spark, sf_dir)) == sorted(want, key=repr)


def test_the_cover_aligns_all_distances():
    for distance in range(substring_dedup.PERIOD):
        assert any(
            (a + distance) % substring_dedup.PERIOD in substring_dedup.COVER for a in substring_dedup.COVER
        )


def bytes_without_repeats(rows, window=100):
    out, seen = [], set()
    order = sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0, r[0]))
    for _, (i, t) in order:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - window + 1):
            if b[a : a + window] in seen:
                gone[a : a + window] = b"\1" * window
            seen.add(b[a : a + window])
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def byte_rows(frame):
    found = frame.select("doc_id", "n_bytes", queries._span_total("removed"), F.size("removed"), "kept")
    return sorted(((*r[:4], bytes(r[4])) for r in found.collect()), key=repr)


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefgh ", "abé ñ"])
def test_byte_strings_match_brute_force(table, alphabet):
    rows = documents_with_shared_passages(list(alphabet), len(alphabet), "")
    assert byte_rows(suffix_dedup.remove_repeats(table(rows, parts=1))) == bytes_without_repeats(rows)


def test_byte_strings_with_many_kinds_of_an_anchor(table):
    random.seed(8)  # over four times as many kinds as one suffix array takes
    passage = "".join(random.choices("abcdefgh ", k=260))
    rows = [
        (k, "".join(random.choices("abcdefgh ", k=random.randint(0, 60))) + passage[random.randint(0, 90) : random.randint(150, 260)] + "".join(random.choices("xyz", k=40)))
        for k in range(150)
    ]
    assert byte_rows(suffix_dedup.remove_repeats(table(rows, parts=2))) == bytes_without_repeats(rows)


def test_suffix_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in queries.given(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in bytes_without_repeats(rows)]
    assert rows_of(queries.op7_suffix_dedup(spark, sf_dir)) == sorted(want, key=repr)


@pytest.mark.parametrize("remove", [substring_dedup.remove_repeats, suffix_dedup.remove_repeats])
def test_removal_takes_awkward_rows(awkward, empty, remove):
    assert remove(awkward).count() == awkward.count()
    assert remove(empty).count() == 0


def test_pieces_of_a_long_text_hold_every_window_once(monkeypatch):
    random.seed(9)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 1500)
    size = 7000
    text = "".join(random.choices("abcdefgh ", k=size))
    batch = pa.RecordBatch.from_pydict({"_row": [4], "rank": [9], "text": [text]})
    starts = []
    for found in suffix_dedup._segments(iter([batch])):
        place = found.column("place").to_numpy()
        for start, length in zip(repeats._start(place), repeats._length(place)):
            starts += range(start, start + length - suffix_dedup.WINDOW + 1)
    assert sorted(starts) == list(range(size - suffix_dedup.WINDOW + 1))


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 300), (300, 299)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = dict(tuple(r) for r in components.components(frame).collect())
    assert found == {k: 0 for k in [*range(41), 300, 299]} | {100: 100, 101: 100}


def labelled(words):
    seen, out = Counter(), set()
    for k in range(max(1, len(words) - 4) if words else 0):
        gram = tuple(words[k : k + 5])
        seen[gram] += 1
        out.add((gram, seen[gram]))
    return out


def test_near_copies_match_brute_force(table):
    random.seed(10)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, families = [], [random.choices(vocabulary, k=250) for _ in range(6)]
    for k in range(150):
        words = list(random.choice(families))
        for _ in range(random.choice([0, 1, 2, 8, 30])):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        rows.append((k, " ".join(words)))
    sets = {k: labelled(t.split()) for k, t in rows}
    found = {r.doc_id: r for r in near_dedup.classes(table(rows)).collect()}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    missed = 0
    for a in sets:
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                parent[root(a)] = root(b)
                missed += found[a].class_id != found[b].class_id
    assert missed == 0
    assert {k: {j for j in sets if root(j) == root(k)} for k in sets} == {
        k: {j for j in sets if found[j].class_id == found[k].class_id} for k in sets
    }
    assert all(found[k].kept == (found[k].class_id == k) for k in found)


def test_copies_within_a_template_family_are_found(table):
    random.seed(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = random.choices(vocabulary, k=150)
    rows = []
    for k in range(40):
        own = passage + random.choices(vocabulary, k=60)
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join([*own[:-1], "edit"]))]
    found = {r.doc_id: r.class_id for r in near_dedup.classes(table(rows)).collect()}
    assert [k for k in range(40) if found[2 * k + 1] != found[2 * k]] == []
    assert len(set(found.values())) == 40


def test_template_family_loses_no_pair(table):
    random.seed(15)
    vocabulary = [f"w{k}" for k in range(5000)]
    passage = random.choices(vocabulary, k=174)
    rows = []
    for k in range(120):
        own, other = random.choices(vocabulary, k=30), random.choices(vocabulary, k=19)
        rows += [(2 * k, " ".join(passage + own)), (2 * k + 1, " ".join(passage + own[:11] + other))]
    sets = {k: labelled(t.split()) for k, t in rows}
    found = {r.doc_id: r.class_id for r in near_dedup.classes(table(rows)).collect()}
    close = {(a, b) for a in sets for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert close == {(2 * k + 1, 2 * k) for k in range(120)}
    assert [(a, b) for a, b in close if found[a] != found[b]] == []
    assert len(set(found.values())) == 120


def family(n, place, seed=16):
    """A text of 100 words and n copies of it with 1 or 2 edits, at one place among them."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = draw.choices(vocabulary, k=100)
    texts = []
    for _ in range(n):
        words = list(base)
        for at in draw.sample(range(100), draw.choice([1, 2])):
            words[at] = draw.choice(vocabulary)
        texts.append(" ".join(words))
    texts.insert({"first": 0, "middle": n // 2, "last": n}[place], " ".join(base))
    return list(enumerate(texts))


@pytest.mark.parametrize("place", ["first", "middle", "last"])
def test_pairs_grow_with_a_family_and_not_with_its_square(table, monkeypatch, place):
    compared, compare = [], near_dedup._compare

    def counted(pairs, words):
        compared.append(pairs.count())
        return compare(pairs, words)

    monkeypatch.setattr(near_dedup, "_compare", counted)
    sizes = []
    for n in (200, 400):
        compared.clear()
        found = near_dedup.classes(table(family(n, place))).collect()
        sizes.append(sum(compared))
        assert max(Counter(r.class_id for r in found).values()) > 0.98 * n
        assert sizes[-1] < 5 * n, sizes
    assert sizes[1] < 2.6 * sizes[0]


def test_query_matches_brute_force(spark, table, monkeypatch):
    """The query itself over texts with edits, repeated passages, moved halves and copies."""
    draw = random.Random(17)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(30):
        base = draw.choices(vocabulary, k=draw.choice([3, 8, 60, 150]))
        texts += [" ".join(base), " ".join(base[len(base) // 2 :] + base[: len(base) // 2])]
        for _ in range(3):
            words = list(base)
            for _ in range(draw.choice([0, 1, 2])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                words = words[:20] + words[5:]
            texts.append(" ".join(words))
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    monkeypatch.setattr(queries, "given", lambda *_: table(rows))
    found = {r.doc_id: r for r in queries.op8_near_dedup(spark, "").collect()}

    def grams(text):
        words = text.split()
        return [tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))]

    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    own = [grams(t) for t in texts]
    for a in range(len(texts)):
        for b in range(a):
            total = len(own[a]) + len(own[b])
            if not set(own[a]) & set(own[b]):
                continue
            row = [0] * (len(own[b]) + 1)
            for x in own[a]:
                above, row = row, [0]
                for j, y in enumerate(own[b]):
                    row.append(above[j] + 1 if x == y else max(above[j + 1], row[j]))
            if row[-1] >= 0.8 * (total - row[-1]):
                parent[root(a)] = root(b)
    classes = {k: min(j for j in parent if root(j) == root(k)) for k in range(len(texts))}
    assert {k: r.class_id for k, r in found.items()} == classes
    sizes = Counter(classes.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (k == r.class_id) for k, r in found.items())


def test_recall_at_the_threshold(table):
    """Pairs just above 0.8 that share nothing with other texts."""
    draw = random.Random(18)
    rows = []
    for k in range(300):
        words = [f"p{k}x{j}" for j in range(94)]  # 90 shingles
        other = words[:83] + [f"q{k}x{j}" for j in range(8)]  # 79 of 87 common
        if draw.random() < 0.5:
            words, other = other, words
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    sets = {k: labelled(t.split()) for k, t in rows}
    exact = [len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) for k in range(300)]
    assert all(0.8 <= j < 0.81 for j in exact)
    found = {r.doc_id: r.class_id for r in near_dedup.classes(table(rows)).collect()}
    hit = sum(found[2 * k + 1] == found[2 * k] for k in range(300))
    assert hit >= 297


def test_first_shingles_meet_for_every_similar_pair():
    rng = np.random.default_rng(15)
    for _ in range(300):
        own = rng.integers(0, 2**63, rng.integers(1, 80)).astype(np.uint64)
        kept = own[rng.random(len(own)) < 0.93]
        other = np.concatenate([kept, rng.integers(0, 2**63, rng.integers(0, 9)).astype(np.uint64)])
        common = len(np.intersect1d(own, other))
        if not common or common < 0.8 * (len(own) + len(other) - common):
            continue
        frequency = rng.integers(2, 9, near_dedup.COUNTERS)
        (a, at), (b, to) = (near_dedup.first_shingles(x, frequency, 0.8) for x in (own, other))
        meet = set(a.tolist()) & set(b.tolist())
        assert meet
        first = min(meet, key=a.tolist().index)
        rest = min(len(own) - at[a == first][0], len(other) - to[b == first][0])
        assert rest >= common


def test_parities_never_show_more_than_the_difference():
    rng = np.random.default_rng(19)
    for n in (0, 1, 50, 3000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for share in (0, 0.1, 0.9):
            kept = a[rng.random(len(a)) >= share]
            b = np.concatenate([kept, rng.integers(0, 2**63, len(a) - len(kept)).astype(np.uint64)])
            unlike = near_dedup.parities(a) ^ near_dedup.parities(b)
            bits = sum(int(v & (2**64 - 1)).bit_count() for v in unlike.tolist())
            assert bits <= len(np.setxor1d(a, b))
            assert share == 0 or n != 50 or bits > 0.7 * len(np.setxor1d(a, b))


def test_order_counts_for_similarity():
    a = near_dedup.shingles(np.arange(1, 101, dtype=np.uint64))
    b = near_dedup.shingles(np.concatenate([np.arange(51, 101), np.arange(1, 51)]).astype(np.uint64))
    jaccard, similarity = near_dedup.alignment(a, b, 0.8)
    assert jaccard > 0.8 and similarity < 0.8
    assert near_dedup.alignment(a, a, 0.8) == (1.0, 1.0)


def paged(seed, pages=5, header=30, body=60):
    random.seed(seed)
    top = random.choices([f"h{k}" for k in range(900)], k=header)
    return [[*top, *random.choices([f"w{k}" for k in range(3000)], k=body)] for _ in range(pages)]


def test_a_header_gone_once_leaves_the_rest_in_order(table):
    pages = paged(12)
    whole, less = sum(pages, []), sum([pages[0][30:], *pages[1:]], [])
    a, b = (np.array([hash(w) & (2**63 - 1) for w in t], np.uint64) for t in (whole, less))
    plain = near_dedup.plain_shingles(a), near_dedup.plain_shingles(b)
    jaccard, similarity = near_dedup.alignment(*map(near_dedup.label_occurrences, plain), 0.8, plain)
    assert jaccard > 0.9 and similarity > 0.9
    rows = [(1, " ".join(whole)), (2, " ".join(less))]
    assert [r.class_id for r in near_dedup.classes(table(rows)).collect()] == [1, 1]


@pytest.mark.parametrize("frequent", [0, 1000])
@pytest.mark.parametrize("slide", [1, 7, 256])
def test_longest_common_matches_brute_force(monkeypatch, frequent, slide):
    monkeypatch.setattr(near_dedup, "_FREQUENT", frequent)
    monkeypatch.setattr(near_dedup, "_SLIDE", slide)
    random.seed(13)
    for _ in range(200):
        a, b = (random.choices(range(random.choice([2, 5, 30])), k=random.randint(0, 60)) for _ in range(2))
        if random.random() < 0.5:
            b = [x for x in a if random.random() < 0.9]
        for band in (None, 0, 1, 4, 15):
            best = np.zeros((len(a) + 1, len(b) + 1), int)
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    fits = x == y and (band is None or abs(i - j) <= band)
                    best[i + 1, j + 1] = max(best[i, j] + fits, best[i, j + 1], best[i + 1, j])
            own = near_dedup.longest_common(np.array(a, np.uint64), np.array(b, np.uint64), band)
            # a common end is matched whatever its shift
            assert own == best[-1, -1] or band is not None and own >= best[-1, -1] and len(a) != len(b)


def test_near_dedup_takes_awkward_rows(awkward, empty):
    found = near_dedup.classes(awkward).collect()
    classes = {}
    for r in found:
        classes.setdefault(r.class_id, Counter())[r.doc_id] += 1
    assert classes[1] == {1: 2, 2: 1}
    assert classes[3] == {3: 1, 4: 2, 5: 1}
    assert sum(r.kept for r in found) == len(classes)
    kept = near_dedup.one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(classes)
    assert near_dedup.classes(empty).count() == 0

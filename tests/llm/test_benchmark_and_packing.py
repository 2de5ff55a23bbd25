"""Decontamination and packing against brute force, and the pipeline."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import decontaminate, packing, queries
from tests.llm.conftest import rows_of
from tests.llm.test_dedup import labelled

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def contamination(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = tuple(WORD.findall((t or "").translate(LOWER)))
        k = min(13, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows[w[a : a + k]].add(str(i))
    out = []
    for i, t in docs:
        w, hit, names = tuple(WORD.findall((t or "").translate(LOWER))), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if w[a : a + k] in windows:
                    hit |= set(range(a, a + k))
                    names |= windows[w[a : a + k]]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_decontamination_query_matches_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in queries.given(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.given(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    assert rows_of(queries.op4_decontamination(spark, sf_dir).drop("longest")) == contamination(docs, items)


def test_repeated_items_do_not_fill_a_block(table, monkeypatch):
    sizes = []
    of = decontaminate.Probes.of
    monkeypatch.setattr(decontaminate.Probes, "of", lambda items, texts: sizes.append(len(items)) or of(items, texts))
    items = table([(1, "one two three four")] * 50 + [(2, "five six")], "benchmark", "item_id bigint, text string")
    assert len(list(decontaminate._blocks(items))) == 1 and sizes == [2]


@pytest.mark.parametrize("vocabulary, block", [(3, 8 << 20), (12, 8 << 20), (12, 60)])
def test_contamination_matches_brute_force(table, monkeypatch, vocabulary, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    random.seed(vocabulary + block)
    words = [f"W{k}" for k in range(vocabulary)]
    some = lambda n: ",".join(random.choices(words, k=n))
    items = [(k, random.choice([some(random.randint(0, 30)), some(13), None, "", some(4)])) for k in range(8)]
    docs = [
        (k, random.choice([some(random.randint(0, 120)), f"{random.choice(items)[1]} {some(9)}", None, ""]))
        for k in range(60)
    ]
    found = decontaminate.contamination(table(docs), table(items, "benchmark", "item_id bigint, text string"))
    names = F.sha2(F.array_join("items", ","), 256)
    got = found.select("doc_id", "n_words", "n_hit", F.size("items"), names, "contaminated")
    assert rows_of(got) == contamination(docs, items)


def test_longest_match_and_spans(table):
    item = " ".join(f"b{k}" for k in range(20))
    doc = "x " + " ".join(f"b{k}" for k in range(2, 18)) + " y"
    found = decontaminate.contamination(table([(1, doc)]), table([(9, item)], "benchmark", "item_id bigint, text string"))
    row = found.first()
    assert row.longest == 16 and [tuple(s) for s in row["spans"]] == [(1, 17)] and row["items"] == ["9"]


def test_decontamination_takes_awkward_rows(awkward, empty, table, spark):
    items = table([(1, None), (None, "seven wizards box with grumpy newts"), (2, "!"), (2, "!")], "benchmark", "item_id bigint, text string")
    kept = decontaminate.decontaminate(awkward, items)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {3, 4, 5, 6, 7, 8, 9}
    assert decontaminate.contamination(empty, items).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(awkward, none).count() == awkward.count()


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(5)
    for _ in range(30):
        words = rng.integers(0, 3, rng.integers(1, 60))
        order = decontaminate.suffix_array(words, 64).tolist()
        assert order == sorted(range(len(words)), key=lambda k: words[k:].tolist())


def test_tokens_and_pieces_round_trip(spark, sf_dir):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    docs = {r.doc_id: r.text for r in queries.given(spark, sf_dir, "documents").collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op10_packing(spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(docs)
    for i, own in pieces.items():
        ids = encode.encode(docs[i] or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == crc32(np.array(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH
        padding += packing.LENGTH - at if at & (at - 1) else 0
    assert padding <= 0.02 * sum(r.doc_tokens for own in pieces.values() for r in own[:1])


def test_tokens_of_odd_words_match_the_tokenizer():
    tokens = packing.WordTokens(queries.vocabulary("word_bpe_49k.json"))
    texts = ["plain words, isn't it?", "e\u0301 ſ ß İ\u00a0x \u2028 y", "<|startoftext|>a <|endoftext|> b<|", None, "", "\x00 \x1c z"]
    for own in (texts, texts[:2], texts):  # with and without the special token; known words
        ids, counts = tokens.of(pa.array(own, pa.string()))
        want = [tokens.encode.encode(t or "", add_special_tokens=False).ids + [2] for t in own]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_cuts_are_optimal(monkeypatch):
    monkeypatch.setattr(packing, "LENGTH", 12)
    monkeypatch.setattr(packing, "_POWERS", (1, 2, 4, 8))
    rng = np.random.default_rng(6)
    for _ in range(60):
        n = int(rng.integers(1, 60))
        where = np.unique(np.append(rng.integers(1, n + 1, 12), [*range(10, n, 10), n]))
        price = rng.integers(0, 9, len(where))
        cost = {0: 0}
        for j, p in zip(where.tolist(), price.tolist()):
            options = [cost[i] + 12 - (j - i) for i in cost if 0 < j - i <= 12]
            options += [cost[j - k] + packing.SHORT_WINDOW for k in (1, 2, 4, 8) if j - k in cost]
            cost[j] = min(options) + p
        cuts, total = packing.best_cuts(where, price)
        assert total == cost[n] and cuts[-1] == n
        assert all(0 < b - a <= 12 for a, b in zip([0, *cuts], cuts))


def test_blocks_do_not_lose_documents(awkward, empty, monkeypatch):
    path = queries.vocabulary("word_bpe_49k.json")
    whole = packing.pack(awkward, path).collect()
    assert sum(r.length for r in whole) == sum(r.doc_tokens for r in whole if r.start == 0)
    assert sum(r.start == 0 for r in whole) == awkward.count()
    assert packing.pack(empty, path).count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = queries.given(spark, sf_dir, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "near_dedup", "decontamination", "packing",
    ]
    bad = {r.doc_id for r in queries.op9_toxicity(spark, sf_dir).filter("predicted = 1").collect()}
    toxic = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert toxic.columns == docs.columns and {r.doc_id for r in toxic.collect()} == ids - bad
    exact = {r.doc_id for r in queries.op6_exact_dedup(spark, sf_dir).filter("kept").collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_exact_copies(spark, docs, sf_dir).collect()} == exact
    near = {r.class_id for r in queries.op8_near_dedup(spark, sf_dir).collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()} == near
    hit = {r.doc_id for r in queries.op4_decontamination(spark, sf_dir).filter("contaminated").collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, sf_dir).collect()} == ids - hit
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.collect()} <= ids - bad - hit


def test_run_is_the_stages_in_turn(spark, sf_dir):
    """What each stage leaves, by brute force but for the toxicity model, and all of it packed."""
    docs = queries.given(spark, sf_dir, "documents")
    bad = {r.doc_id for r in queries.op9_toxicity(spark, sf_dir).filter("predicted = 1").collect()}
    left = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id not in bad}
    first = {}
    for i in sorted(left):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", left[i]), i)
    left = {i: left[i] for i in first.values()}
    grams = {i: labelled(re.findall("[^\x20\x09-\x0d]+", t)) for i, t in left.items()}
    parent = {i: i for i in left}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in left:
        for b in left:
            common = len(grams[a] & grams[b])
            if b < a and (common >= 0.8 * (len(grams[a]) + len(grams[b]) - common)):
                high, low = sorted((root(a), root(b)), reverse=True)
                parent[high] = low
    left = {i: t for i, t in left.items() if root(i) == i}
    items = [tuple(r) for r in queries.given(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    hit = {row[0] for row in contamination(list(left.items()), items) if row[-1]}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    lengths = defaultdict(int)
    for r in packed:
        lengths[r.doc_id] += r.length
    assert bad and hit and len(left) < docs.count() - len(bad)
    assert set(lengths) == set(left) - hit
    assert all(lengths[r.doc_id] == r.doc_tokens for r in packed)


def test_pipeline_takes_awkward_rows(awkward, empty, sf_dir, spark):
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
            assert stage(spark, docs, sf_dir).count() <= docs.count()

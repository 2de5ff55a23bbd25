"""Collocations against plain counting, with every way of packing and routing at work."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarmac.llm import collocations, queries
from tests.llm.conftest import rows_of

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(rows, top=2000):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    count[lang][tuple(words[k : k + size])] += 1
    out = []
    for lang, own in count.items():
        fine = {p: a for p, a in own.items() if len(p) > 1 and a >= 10}
        found = []
        for p, a in fine.items():
            if len(p) == 2 and any(
                100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in fine.items() if len(q) == 3
            ):
                continue
            score, _, left, right = min(
                (1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]])
                for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=repr)


def documents():
    draw = random.Random(6)
    words = ["the", "of", "New", "york", "é", "É", "a-b", "x", "漢字", "'s", "Z z", "\x00"]
    weights = [30, 20, 5, 5, 3, 3, 2, 2, 2, 2, 1, 1]
    rows = []
    for k in range(120):
        text = "".join(
            w + draw.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r\n", "! "])
            for w in draw.choices(words, weights, k=draw.randint(0, 60))
        )
        rows.append((draw.choice(["en", "de", None, "und", "und"]), text))
    rows += [("en", "New York City is big. new york city") for _ in range(12)]  # hot copies
    return rows + [("en", None), ("fr", ""), ("es", " \t. "), ("en", "the of " * 3000)]


SCHEMA = "doc_id bigint, lang string, text string"
SMALL = {"DICTIONARY": 5, "PART_WORDS": 400, "WAYS": 2, "FAN_IN": 2, "BLOCK_BYTES": 900, "_SPREAD": 3}


@pytest.mark.parametrize("names", [(), ("DICTIONARY",), tuple(SMALL)])
def test_query(spark, table, monkeypatch, names):
    for name in names:
        monkeypatch.setattr(collocations, name, SMALL[name])
    rows = documents()
    docs = table([(k % 50, *row) for k, row in enumerate(rows)], schema=SCHEMA, parts=4)
    monkeypatch.setattr(queries, "given", lambda *_: docs)
    found = queries.op12_collocations(spark, "")
    assert rows_of(found) == brute_force(rows)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_top_is_cut_after_ties(spark, table, monkeypatch):
    monkeypatch.setattr(collocations, "TOP", 4)
    rows = [("en", f"w{k} v{k}") for k in range(30) for _ in range(10)]
    docs = table([(0, *row) for row in rows], schema=SCHEMA)
    assert rows_of(collocations.collocations(docs)) == brute_force(rows, 4)


def test_scores_are_exact(spark):
    big = 999_999_999_999_937
    frame = spark.createDataFrame([(big, big, big + 62), (7, 2**40, 3), (10, 10, 10)], "a bigint, l bigint, r bigint")
    rows = frame.select("a", "l", "r", collocations._score("a", "l", "r").alias("s")).collect()
    assert all(r.s == 1000000 * r.a * r.a // (r.l * r.r) for r in rows)


def test_multikey_groups():
    draw = np.random.default_rng(7)
    columns = draw.integers(1, 6, (3, 3000)).astype(np.uint64)
    columns[2][draw.random(3000) < 0.2] = 0
    weights = draw.integers(1, 4, 3000).astype(np.uint64)
    count = Counter()
    for a, b, c, n in zip(*columns.tolist(), weights.tolist()):
        count[a, b] += n
        if c:
            count[a, b, c] += n
    found = {}
    for words, pointers, totals in collocations.multikey_groups(columns, weights, 25):
        for p, total in zip(pointers.tolist(), totals.tolist()):
            phrase = tuple(columns[:words, p].tolist())
            assert phrase not in found
            found[phrase] = total
    assert found == {p: n for p, n in count.items() if n >= 25}


def test_awkward_rows(spark, awkward, empty, monkeypatch):
    for docs in (awkward, empty):
        monkeypatch.setattr(queries, "given", lambda *_, docs=docs: docs)
        rows = [(r.lang, r.text) for r in docs.collect()]
        assert rows_of(queries.op12_collocations(spark, "")) == brute_force(rows)

"""Alignment of two vocabularies against whole-text encodings and plain counting."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm import packed, queries, token_alignment
from tests.llm.conftest import rows_of

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPECIAL = [
    "", None, " ", "  ", " a", "a ", "a  b", "a \n b", "\n\n x \t y\r\n\r\nz  \n",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "x▁y z", "▁", "a ▁ b", "don't we'll I'M", "1 234 56",
    "é\u00a0è \u00a0x \u3000 y \u2003z", "漢字 かな 😀 👍🏽", "\x00 a\x01 b\x1c c", "x" * 3000,
    "\u2028 a \u0085 b", "a\u0301 ﬁ ﬀ  Ⅻ", "\t\tif x:\n\t\t\treturn  y", "\ufeffabc \u200bd",
]


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.vocabulary(A_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary(B_FILE))


def ends(parts):
    return np.cumsum([len(p) for p in parts]).tolist()


def whole(text, encoders):
    """Groups as lists of ids, by encoding the whole text."""
    if not text:
        return []
    a, b = encoders
    letters = token_alignment._byte_letters()
    of_a = a.encode(" " + text, add_special_tokens=False)
    a_parts = [bytes(letters[c] for c in t) for t in of_a.tokens]
    b_ids = b.encode(text)
    b_parts = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
        else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
        return []
    a_ids, out, i, j = of_a.ids, [], 0, 0
    a_ends, b_ends = ({end: k for k, end in enumerate(ends(p), 1)} for p in (a_parts, b_parts))
    for end in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends[end], b_ends[end]
        out.append((a_ids[i:k], b_ids[j:m]))
        i, j = k, m
    return out


def told(found):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)


def expected(texts, encoders):
    of = [whole(t, encoders) for t in texts]
    count = Counter((a[-1], b[-1]) for found in of for a, b in found)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    rows = []
    for found in of:
        own = [count[a[-1], b[-1]] for a, b in found]
        best = sum(n == most[b[-1]] for n, (_, b) in zip(own, found))
        rows.append(
            {
                "n_a": sum(len(a) for a, _ in found), "n_b": sum(len(b) for _, b in found),
                "n_groups": len(found), "n_links": len(found), "n_best": best, "count_sum": sum(own),
                "groups_sha256": hashlib.sha256(told(found).encode()).hexdigest() if found else "",
            }
        )
    return rows


def random_texts(letters, n):
    draw = random.Random(3)
    return ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(n)]


def test_atoms_encode_like_whole_texts(encoders):
    texts = [t or "" for t in SPECIAL]
    texts += random_texts(" \n\tab.,é\u00a0 x1'", 1500) + random_texts("  \r\nthe,THE_▁'s2", 500)
    atoms = token_alignment.Atoms(*map(queries.vocabulary, (A_FILE, B_FILE)))
    words = token_alignment.split_atoms(pa.array(texts, pa.string()))
    place, counts, fine = token_alignment._aligned(words, atoms)
    found = [t.decode() for t in token_alignment._told_of(words, place, atoms, fine)]
    of = [whole(t, encoders) for t in texts]
    assert found == [told(f) for f in of]
    assert counts[:, 2].tolist() == [len(f) for f in of]
    assert sum(map(bool, found)) > 1500


def test_heap_merge_and_highest():
    draw = np.random.default_rng(4)
    runs, total = [], Counter()
    for _ in range(7):
        pairs = np.unique(draw.integers(0, 5, 40).astype(np.uint64) << np.uint64(32) | draw.integers(0, 9, 40).astype(np.uint64))
        n = draw.integers(1, 5, len(pairs)).astype(np.uint64)
        runs.append((pairs, n))
        total.update(dict(zip(pairs.tolist(), n.tolist())))
    pairs, n = token_alignment.heap_merge(runs)
    assert dict(zip(pairs.tolist(), n.tolist())) == total and (np.diff(pairs.astype(np.int64)) > 0).all()
    most = defaultdict(int)
    for pair, k in total.items():
        most[pair >> 32] = max(most[pair >> 32], k)
    assert token_alignment.highest(pairs, n).tolist() == [total[p] == most[p >> 32] for p in pairs.tolist()]


@pytest.mark.parametrize("values", [[], [0], [5, 5, 2**63, 1], list(range(1000))])
def test_packed_values_come_back(values):
    for kind in (np.uint32, np.uint64):
        own = np.array([v % 2**31 for v in values], kind) if kind is np.uint32 else np.array(values, kind)
        assert packed.stretch(packed.squeeze(own)).tolist() == own.tolist()


@pytest.mark.parametrize("small", [False, True])
def test_query(spark, table, encoders, monkeypatch, small):
    """With small runs, several rounds of merging and several groups of runs."""
    if small:
        monkeypatch.setattr(token_alignment, "RUN_LINKS", 40)
        monkeypatch.setattr(token_alignment, "FAN_IN", 2)
    hot = ["the the the, the the"] * 40  # one pair holds a large share
    texts = SPECIAL + hot + random_texts("abc the,. \n", 150)
    rows = [(k // 2, t) for k, t in enumerate(texts)]  # ids repeat
    docs = table(rows)
    monkeypatch.setattr(queries, "given", lambda *_: docs)
    found = queries.op13_token_alignment(spark, "")
    wanted = [{"doc_id": i, **row} for (i, _), row in zip(rows, expected(texts, encoders))]
    assert sorted((r.asDict() for r in found.collect()), key=repr) == sorted(
        ({c: w[c] for c in found.columns} for w in wanted), key=repr
    )


def test_pair_counts_and_groups(spark, table, encoders):
    texts = ["a b, a b", "b a b", None]
    docs = table(list(enumerate(texts)))
    paths = [queries.vocabulary(name) for name in (A_FILE, B_FILE)]
    of = [whole(t, encoders) for t in texts]
    count = Counter((a[-1], b[-1]) for found in of for a, b in found)
    pairs = token_alignment.pair_counts(docs, *paths).collect()
    assert {(r.a, r.b): r.n for r in pairs} == count and any(r.best for r in pairs)
    assert rows_of(token_alignment.groups(docs, *paths)) == sorted(
        ((k, told(f)) for k, f in enumerate(of)), key=repr
    )


def test_awkward_rows(spark, awkward, empty, encoders, monkeypatch):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for docs, given_rows in ((awkward, rows), (empty, [])):
        monkeypatch.setattr(queries, "given", lambda *_, docs=docs: docs)
        found = queries.op13_token_alignment(spark, "")
        wanted = expected([t for _, t in given_rows], encoders)
        assert sorted((r.doc_id or -1, r.count_sum, r.groups_sha256) for r in found.collect()) == sorted(
            (i or -1, w["count_sum"], w["groups_sha256"]) for (i, _), w in zip(given_rows, wanted)
        )

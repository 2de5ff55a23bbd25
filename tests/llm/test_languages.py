"""Many languages: all are learned, and blocks of them give what one block gives."""

import random

import pytest

from tarmac.llm import language_id, queries
from tests.llm.conftest import rows_of

PIECES = "piece_bpe_32k.model"


def texts_of(n_langs, rows_each, seed=30):
    """Texts whose languages have words of their own."""
    draw = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for lang in range(n_langs):
        words = ["".join(draw.choices(letters, k=draw.randint(3, 8))) for _ in range(12)]
        for _ in range(rows_each):
            rows.append((f"l{lang:03d}", " ".join(draw.choices(words, k=25))))
    draw.shuffle(rows)
    return [(k, text, lang) for k, (lang, text) in enumerate(rows)]


@pytest.fixture
def docs(table):
    rows = texts_of(7, 20) + [(1000, None, "l001"), (1001, "12 !!", None), (1001, "", "l002"), (None, "abc", "l003")]
    return table(rows, schema="doc_id bigint, text string, lang string")


def test_blocks_of_languages_give_what_one_block_gives(docs, monkeypatch):
    path = queries.vocabulary(PIECES)
    whole = rows_of(language_id.identify_held_out(docs, path))
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 3)
    blocks = rows_of(language_id.identify_held_out(docs, path))
    assert len(whole) == len(blocks) == docs.count()
    for a, b in zip(whole, blocks):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)


def test_no_language_is_left_out(table, monkeypatch):
    """More languages than a block holds."""
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 16)
    rows = texts_of(40, 8)
    own = table(rows, schema="doc_id bigint, text string, lang string")
    found = language_id.identify_held_out(own, queries.vocabulary(PIECES)).collect()
    lang = {i: name for i, _, name in rows}
    right = sum(r.lang_pred == lang[r.doc_id] for r in found if r.held_out)
    assert right > 0.95 * sum(r.held_out for r in found)
    assert len({r.lang_pred for r in found}) == 40


def test_nothing_to_learn_from(table):
    own = table([(1, "abc", None), (2, None, None)], schema="doc_id bigint, text string, lang string")
    found = language_id.identify_held_out(own, queries.vocabulary(PIECES)).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in found} == {(1, "und", 0.0), (2, "und", 0.0)}

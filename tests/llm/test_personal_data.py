"""Personal data: plain patterns against brute force, disguises mapped back to the source."""

import hashlib
import random
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarmac.llm import personal_data, queries
from tarmac.llm.personal_data import KINDS, find_plain, find_spans, redact, rewrite

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute_force(text):
    """The contract's patterns as they are written."""
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                odd, even = digits[::-1][::2], digits[::-1][1::2]
                total = sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1234567890.@-+ ()%é\n", max_size=60))
def test_plain_spans_equal_the_patterns(text):
    assert find_plain(text) == brute_force(text)


def test_plain_spans_of_dense_text():
    random.seed(1)
    for _ in range(300):
        text = "".join(random.choices("0123456789  -.+@a(", k=200))
        assert find_plain(text) == brute_force(text)


def slices_of(text):
    return [(KINDS[k], text[a:b]) for a, k, b, plain in find_spans(text) if not plain]


@pytest.mark.parametrize(
    ("kind", "disguised"),
    [
        ("email", "john.doe (at) example (dot) com"),
        ("email", "john dot doe at mail dot example dot com"),
        ("email", "joe [at] example.org"),
        ("email", "amy&#64;host&#46;com"),
        ("email", "jоhn@exаmple.com"),
        ("email", "john＠example．com"),
        ("email", "name_at_host_dot_net"),
        ("email", "marie arobase exemple point fr"),
        ("ip", "one nine two dot one six eight dot one dot one zero"),
        ("ip", "127[.]0[.]0[.]1"),
        ("ip", "10 dot 0 dot 0 dot 1"),
        ("card", "four one one one one one one one one one one one one one one one"),
        ("card", "４111‑1111‑1111‑1111"),
        ("card", "4111 1111 1111 1111"),
        ("phone", "plus one seven four three five five five three eight two four"),
        ("phone", "+1 five five five triple four nine nine"),
    ],
)
def test_disguises_come_back_as_they_were_written(kind, disguised):
    text = f"Écrivez: {disguised}, \U0001f600 merci"
    assert (kind, disguised) in slices_of(text)
    assert disguised not in redact(text) and redact(text).endswith(" merci")


def test_marks_without_width_belong_to_the_span_around_them():
    text = "see hein​.19@mail5.exam­ple.com​ now"
    assert slices_of(text) == [("email", "hein​.19@mail5.exam­ple.com")]


@pytest.mark.parametrize(
    "clean",
    [
        "meet me at example.com",
        "look at polka dot dresses",
        "un deux trois quatre cinq six sept huit",
        "one or two, three at most; point 4 of 9",
        "section 1 dot 2 dot 3",
        "the price is 12 (at most) or 13 (dotted)",
    ],
)
def test_clean_text_is_left_alone(clean):
    assert find_spans(clean) == [] and redact(clean) == clean


def test_plain_spans_stay_beside_wider_ones():
    text = "mail john dot doe@example.com"
    spans = [(KINDS[k], text[a:b], plain) for a, k, b, plain in find_spans(text)]
    assert spans == [("email", "john dot doe@example.com", False), ("email", "doe@example.com", True)]
    assert redact(text) == "mail <EMAIL>"


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_rewritten_stretches_map_back(data):
    """Against a map of every single character."""
    text = data.draw(st.text(alphabet="abc", min_size=1, max_size=20))
    cuts = sorted(data.draw(st.sets(st.integers(0, len(text)), max_size=8)))
    edits = [
        (a, b, data.draw(st.text(alphabet="XY", max_size=3))) for a, b in zip(cuts[::2], cuts[1::2])
    ]
    done = rewrite(text, iter(edits))
    origin, expected, at = [], "", 0
    for a, b, new in [*edits, (len(text), len(text), "")]:
        origin += [(k, k + 1) for k in range(at, a)] + [(a, b)] * len(new)
        expected += text[at:a] + new
        at = b
    assert done.text == expected
    for a in range(len(expected)):
        for b in range(a + 1, len(expected) + 1):
            assert done.source(a, b) == (origin[a][0], origin[b - 1][1])
            inside = {k for k in range(a, b) if expected[k] in "XY"}
            if inside:
                assert done.touches(a, b)


@pytest.mark.parametrize("piece", ["x", "1 ", "(at)", " ", "a@", "1.", "+1 ", "one ", "a dot ", "а"])
def test_long_texts_take_linear_time(piece):
    text = piece * (300_000 // len(piece))
    find_spans(text)


def test_query(spark, table, monkeypatch):
    rows = [
        (1, "a@b.co 10.0.0.1 +1 (743) 555-3824 4111-1111-1111-1111"),
        (2, None),
        (3, ""),
        (4, "joe (at) example (dot) com"),
        (4, "joe (at) example (dot) com"),
    ]
    docs = table(rows)
    monkeypatch.setattr(queries, "given", lambda *_: docs)
    found = {r.doc_id: r for r in queries.op11_personal_data(spark, "").collect()}
    for i, text in dict(rows).items():
        text = text or ""
        plain = [f"{KINDS[k]}:{a}:{b}" for a, k, b in brute_force(text)]
        assert found[i].base_sha256 == hashlib.sha256(",".join(plain).encode()).hexdigest()
        assert set(plain) <= set(found[i].spans.split(","))
        for n, kind in enumerate(KINDS):
            assert found[i][f"n_{kind}"] == sum(p.startswith(kind) for p in plain)
    assert found[4].spans == "email:0:26" and found[2].spans == ""
    redacted = {r.doc_id: r.text for r in personal_data.redacted(docs).collect()}
    assert redacted[4] == "<EMAIL>" and redacted[2] == ""


def test_awkward_rows(spark, awkward, empty, monkeypatch):
    for docs in (awkward, empty):
        monkeypatch.setattr(queries, "given", lambda *_, docs=docs: docs)
        found = queries.op11_personal_data(spark, "").collect()
        assert len(found) == docs.count()
        assert all(r.spans == "" for r in found)


def test_table_of_looks():
    assert all(len(k) == 1 and not k.isascii() for k in personal_data._LOOKS)
    assert all(unicodedata.category(c) in ("Cf", "Mn", "Zs") for c in personal_data._NOTHING)

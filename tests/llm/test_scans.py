"""Secrets, toxicity, language, quality: what is found, and held-out accuracy."""

import base64
import hashlib
import random
import re
import string
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tarmac.llm import importance, language_id, queries, secret_scan, toxicity
from tests.llm.conftest import rows_of


@pytest.fixture(scope="module")
def encode():
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    return secret_scan._vocabulary(path, public_tokenizers.PATTERN).encode_ordinary


def kinds(text, encode):
    return [(secret_scan.KINDS[k], text[a:b]) for a, k, b in secret_scan.find_spans(text, encode)]


def test_patterns(encode):
    text = "é PassWord = \"hunter22222\" token=ab api_key: x.y.z-1234 AKIA1234567890AB AKIA12 " + "0a" * 16
    assert kinds(text, encode) == [
        ("assign", 'PassWord = "hunter22222'),
        ("assign", "api_key: x.y.z-1234"),
        ("access", "AKIA1234567890AB"),
        ("hex", "0a" * 16),
    ]
    # A failing match still takes its characters.
    assert kinds("token=apikey: abcdefghij", encode) == []


def test_random_strings_stand_out_and_known_shapes_do_not(encode):
    random.seed(2)
    strings = ["".join(random.choices(string.ascii_letters + string.digits, k=32)) for _ in range(50)]
    assert all(kinds(f"see {s} there", encode) == [("random", s)] for s in strings)
    digest = hashlib.sha256(b"x")
    fine = [
        str(uuid.uuid4()),
        digest.hexdigest().upper(),
        "sha256-" + base64.b64encode(digest.digest()).decode(),
        "find_all_overlapping_windows_of_text",
        "getUserAccountByIdentifier2",
        "1234567890-1234567890-123",
        "Donaudampfschifffahrtsgesellschaft",
    ]
    assert [s for s in fine if kinds(s, encode)] == []


@pytest.mark.parametrize(
    "letters",
    [string.ascii_lowercase, string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits],
)
def test_random_strings_of_one_case_are_found(encode, letters):
    random.seed(4)
    strings = ["".join(random.choices(letters, k=40)) for _ in range(100)]
    assert sum(kinds(f"see {s} there", encode) == [("random", s)] for s in strings) >= 95


def test_readable_parts_and_other_spans_do_not_hide_a_secret(encode):
    random.seed(5)
    paths = [
        "com/services/incoming/webhooks/production/notifications/",
        "internal/deployment/configuration/production/credentials/service-account/",
    ]
    for _ in range(50):
        secret = "".join(random.choices(string.ascii_letters + string.digits, k=32))
        for path in paths:
            spans = kinds(f"see {path}{secret}/settings there", encode)
            assert [k for k, s in spans if secret in s] == ["random"]
        assert ("random", f"_{secret}") in kinds("0a" * 16 + f"_{secret}", encode)
    assert [kinds(path + str(uuid.UUID(int=random.getrandbits(128))), encode) for path in paths] == [[], []]


def test_long_runs_take_linear_time(encode):
    letters = "".join(random.choices(string.ascii_lowercase, k=60_000))
    assert secret_scan.known_shape(letters) and not secret_scan.known_shape(letters + "123456")
    for text in (letters, letters + "123456", "x" * 300_000 + "99999", "aB3_" * 50_000):
        secret_scan.find_spans(text, encode)
    random.seed(3)
    noise = "".join(random.choices(string.ascii_letters + string.digits, k=100_000))
    assert kinds(noise, encode) == [("random", noise)]


def test_secret_query_matches_brute_force(spark, sf_dir):
    patterns = [
        ("assign", re.compile(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 8),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
        ("hex", re.compile("[0-9a-f]+"), 0, 32),
    ]
    docs = {r.doc_id: r.text for r in queries.given(spark, sf_dir, "documents").collect()}
    for row in queries.op1_secret_scan(spark, sf_dir).collect():
        spans = []
        for order, (kind, pattern, group, least) in enumerate(patterns):
            spans += [
                (m.start(), order, f"{kind}:{m.start()}:{m.end()}")
                for m in pattern.finditer(docs[row.doc_id] or "")
                if len(m[group]) >= least
            ]
        joined = ",".join(s for _, _, s in sorted(spans))
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert row.n_assign + row.n_access + row.n_hex == len(spans)


def test_scan_takes_awkward_rows(awkward, empty):
    path = queries.vocabulary("byte_bpe_50k.tiktoken")
    assert secret_scan.scan_secrets(awkward, path, public_tokenizers.PATTERN).count() == awkward.count()
    assert secret_scan.scan_secrets(empty, path, public_tokenizers.PATTERN).count() == 0


def test_toxicity_on_held_out_rows(spark, sf_dir):
    scored = queries.op9_toxicity(spark, "/root/testdata/sf0.1")
    labels = queries.given(spark, "/root/testdata/sf0.1", "labels")
    held = scored.filter("held_out").join(labels, "doc_id").select("doc_id", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert not [r for r in held if r.predicted and not r.toxic]


def test_machine_learns_a_pair_that_weights_cannot():
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for _ in range(3000):
        insult, group = map(bool, rng.random(2) < 0.18)
        noise = rng.integers(100, 4000, 6)
        rows.append(np.unique(np.concatenate([noise, [1] * insult, [2] * group])).astype(np.int32))
        labels.append(insult and group)
    machine = toxicity.fit_machine(rows, np.array(labels))
    tests = [np.array(t, np.int32) for t in ([1], [2], [1, 2], [])]
    first = np.concatenate([[0], np.cumsum([len(t) for t in tests])])
    raw = machine.raw(np.concatenate(tests), first)
    assert (raw > 0).tolist() == [False, False, True, False]


@pytest.mark.parametrize("clean", [1, 8])
def test_markers_and_base_rate_do_not_depend_on_the_sample(clean):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for toxic, n in ((True, 500), (False, 500 * clean)):
        for _ in range(n):
            marks = [1] * (rng.random() < (0.45 if toxic else 0)) + [2] * (rng.random() < (0.6 if toxic else 0.05))
            common = [3] * (rng.random() < (0.5 if toxic else 0.3))
            rows.append(np.unique(np.array([*rng.integers(100, 4000, 6), *marks, *common])).astype(np.int32))
            labels.append(toxic)
    machine = toxicity.fit_machine(rows, np.array(labels), totals=(8000, 1000))
    assert {1, 2} <= set(machine.terms.tolist()) and 3 not in machine.terms
    tests = [np.array(t, np.int32) for t in ([], [1], [2], [1, 2])]
    first = np.concatenate([[0], np.cumsum([len(t) for t in tests])])
    raw = machine.raw(np.concatenate(tests), first)
    assert raw[0] < -2 and raw[1] > 0 and raw[3] > 0


def test_toxicity_without_labels_or_documents(awkward, empty, spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    scored = toxicity.score_toxicity(awkward, none).collect()
    assert len(scored) == awkward.count() and {r.predicted for r in scored} == {0}
    odd = spark.createDataFrame([(1, 1, 0), (2, 0, 5), (2, 1, 5), (None, 1, 0), (5, None, 1)], "doc_id bigint, toxic int, label int")
    assert toxicity.score_toxicity(awkward, odd).count() == awkward.count()
    assert toxicity.score_toxicity(empty, odd).count() == 0
    kept = toxicity.without_toxic(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op5_language_id(spark, sf).join(queries.given(spark, sf, "documents"), "doc_id")
    held = found.filter("held_out").select("doc_id", "lang", "lang_pred", "score").collect()
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_forward_sums_all_segmentations():
    pieces = language_id.pieces_of(queries.vocabulary("piece_bpe_32k.model"))
    rng = np.random.default_rng(4)
    chance = np.vstack([rng.random((len(pieces.pieces), 2)) / 50, np.zeros((1, 2))])
    number = {p: k for k, p in enumerate(pieces.pieces)}

    def brute(text):
        if not text:
            return np.ones(2)
        return sum(
            (chance[number[text[:k]]] * brute(text[k:]) for k in range(1, len(text) + 1) if text[:k] in number),
            np.zeros(2),
        )

    words = [b"the", "été".encode(), b"ing", b"q", b"station"]
    logs = language_id.word_logs(words, pieces, chance)
    assert np.allclose(logs, [np.log(brute(b" " + w)) for w in words])


def test_language_takes_awkward_rows(awkward, empty):
    path = queries.vocabulary("piece_bpe_32k.model")
    found = language_id.identify_held_out(awkward, path, held_out=-1).collect()
    assert len(found) == awkward.count()
    unknown = {r.doc_id for r in found if r.lang_pred == "und"}
    assert unknown == {3, 4, 5, 9}
    assert language_id.identify_held_out(empty, path).count() == 0
    nothing = language_id.identify(awkward, {}, path).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_quality_sample_is_exact_and_prefers_good_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = queries.given(spark, sf, "documents"), queries.given(spark, sf, "labels")
    learn = labels.filter(toxicity.id_fold(F.col("doc_id"), 5) != 0)
    rows = importance.resample(docs, learn, share=0.86).collect()
    assert sum(r.selected for r in rows) == round(0.86 * len(rows))
    assert min(r.noisy for r in rows if r.selected) >= max(r.noisy for r in rows if not r.selected)
    quality = {r.doc_id: r.quality for r in labels.filter(toxicity.id_fold(F.col("doc_id"), 5) == 0).collect()}
    picked = {k: [r.selected for r in rows if quality.get(r.doc_id) == k] for k in (0, 1)}
    assert np.mean(picked[1]) > 0.95 and np.mean(picked[0]) < 0.15


def test_kth_greatest(spark):
    values = [5, -3, 5, 0, 2**62, -(2**62), 7, 7]
    frame = spark.createDataFrame([(v,) for v in values], "x bigint")
    for k in range(1, len(values) + 1):
        value, greater = importance.kth_greatest(frame, "x", k)
        assert value == sorted(values, reverse=True)[k - 1]
        assert greater == sum(v > value for v in values)


def test_quality_takes_awkward_rows(awkward, empty, spark):
    labels = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    rows = importance.resample(awkward, labels, share=0.5).collect()
    assert len(rows) == awkward.count() and sum(r.selected for r in rows) == round(0.5 * len(rows))
    assert {r.log_weight for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    assert importance.resample(empty, labels).count() == 0
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.selected for r in importance.resample(awkward, none).collect()} == {False}


def test_results_do_not_depend_on_the_split(awkward):
    ratios = np.linspace(-1, 1, 1 << importance.BUCKET_BITS)
    one = importance.weigh(awkward.coalesce(1), ratios).select("doc_id", "log_weight", "noisy")
    two = importance.weigh(awkward, ratios).select("doc_id", "log_weight", "noisy")
    assert rows_of(one) == rows_of(two)

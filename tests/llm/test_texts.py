import random
import re

import numpy as np
import pyarrow as pa

from tarmac.llm import texts


def test_words_and_hashes_agree_with_plain_python():
    random.seed(1)
    alphabet = ["a", "B", "é", " ", "\t", "\n", "\x0b", ".", "7", "漢", "\x00", "\x7f"]
    many = ["".join(random.choices(alphabet, k=random.randint(0, 60))) for _ in range(200)]
    many += ["z" * 700 + " " + "z" * 700, "", " "]
    words = texts.split_words(pa.array([*many, None]), texts.SPACED)
    plain = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in many] + [[]]
    assert [words.bytes_of(k).decode() for k in range(len(words.start))] == sum(plain, [])
    assert np.diff(words.first).tolist() == [len(p) for p in plain]
    hashes = texts.word_hashes(words).tolist()
    flat = sum(plain, [])
    assert len(set(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))


def test_lower_words():
    words = texts.split_words(pa.array(["Ab-cD é{1}É"]), texts.ALNUM, lower=True)
    assert [words.bytes_of(k).decode() for k in range(3)] == ["ab", "cd", "é"]


def test_window_hashes_tell_windows_apart():
    values = np.array([1, 2, 3] * 40 + [4] * 30, np.uint64)
    for width in (1, 2, 5, 13, 35, 100):
        hashes = texts.window_hashes(values, width)
        windows = [tuple(values[k : k + width]) for k in range(len(values) - width + 1)]
        assert len(hashes) == len(windows)
        assert len(set(zip(windows, hashes.tolist()))) == len(set(windows)) == len(set(hashes.tolist()))


def test_slices_keep_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * k for k in (5, 0, 50, 3, 3)] + [None]})
    parts = list(texts.slices(iter([batch]), "text", 8))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()
    assert [p.num_rows for p in parts] == [2, 1, 3]

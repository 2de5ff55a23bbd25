"""Awkward documents that every operator has to take."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, digest int, doc string, score string"

PROSE = "The quick brown fox jumps over the lazy dog while seven wizards box with grumpy newts. "


def awkward_rows():
    long_text = " ".join(f"word{k * k % 9973}" for k in range(40_000))
    texts = {
        1: PROSE * 3,
        2: PROSE * 3,
        3: None,
        4: "",
        5: " \t\n ",
        6: long_text,
        7: "x" * 50_000,
        8: "ÀÉ ñandú 漢字 \U0001f600 …",
        9: "12 34 !! ??",
        10: PROSE,
        None: PROSE + "null id",
    }
    rows = [
        (i, t, None if i in (3, 9) else "en", None if i == 4 else "s", None, "r", 7, "d", "q")
        for i, t in texts.items()
    ]
    return rows + [rows[0], rows[3], rows[-1]]


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    """Nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    spark.createDataFrame(awkward_rows(), SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(awkward, spark):
    return spark.createDataFrame([], awkward.schema)


@pytest.fixture
def table(spark, tmp_path):
    """A table of (doc_id, text) rows in a few files."""

    def make(rows, name="documents", schema="doc_id bigint, text string", parts=3):
        path = str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame(rows, schema).coalesce(parts).write.parquet(path)
        return spark.read.parquet(path)

    return make


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)

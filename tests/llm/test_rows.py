"""Rows keep their identity when the cores change between the scans of one operator."""

import itertools
import random

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from tarmac.llm import decontaminate, exact_dedup, near_dedup, substring_dedup, suffix_dedup
from tests.llm.conftest import rows_of


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """300 documents, copies and near copies among them, in 40 files."""
    draw = random.Random(21)
    words = [f"w{k}" for k in range(500)]
    texts = [" ".join(draw.choices(words, k=draw.randint(45, 90))) for _ in range(200)]
    for k in range(100):
        own = texts[k].split()
        if k % 2:
            own[draw.randrange(len(own))] = "edit"
        texts.append(" ".join(own))
    draw.shuffle(texts)
    path = str(tmp_path_factory.mktemp("rows") / "documents.parquet")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.repartition(40).write.parquet(path)
    items = [(f"i{k}", t) for k, t in enumerate(texts[:30])]
    return spark.read.parquet(path), spark.createDataFrame(items, "item_id string, text string")


OPERATORS = {
    "op3": lambda docs, items: substring_dedup.remove_repeats(docs),
    "op4": lambda docs, items: decontaminate.contamination(docs, items),
    "op6": lambda docs, items: exact_dedup.dedup_exact(docs),
    "op7": lambda docs, items: suffix_dedup.remove_repeats(docs),
    "op8": lambda docs, items: near_dedup.classes(docs).drop("_row"),
    "distinct_texts": lambda docs, items: exact_dedup.distinct_texts(docs),
    "one_of_each": lambda docs, items: near_dedup.one_of_each(docs),
    "decontaminated": lambda docs, items: decontaminate.decontaminate(docs, items),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_results_do_not_depend_on_the_cores_of_a_scan(spark, many_files, monkeypatch, name):
    if name in ("op4", "decontaminated"):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    spark.conf.unset("spark.sql.files.minPartitionNum")
    cores = "spark.sql.leafNodeDefaultParallelism"
    numbers, plain = itertools.cycle([3, 1, 7, 2]), DataFrame.checkpoint

    def checkpoint(self, *args, **more):
        out = plain(self, *args, **more)
        spark.conf.set(cores, str(next(numbers)))
        return out

    wanted = rows_of(OPERATORS[name](*many_files))
    monkeypatch.setattr(DataFrame, "checkpoint", checkpoint)
    spark.conf.unset("spark.sql.files.minPartitionNum")
    try:
        spark.conf.set(cores, "5")
        found = OPERATORS[name](*many_files)
        spark.conf.set(cores, "2")
        ours = [c for c in found.columns if c not in ("_row", "kept_text")]
        assert rows_of(found.select(*ours)) == sorted(
            (tuple(v for c, v in zip(found.columns, r) if c in ours) for r in wanted), key=repr
        )
    finally:
        spark.conf.unset(cores)

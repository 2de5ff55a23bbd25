"""Exact dedup against a persistent digest index, in DataFrame operations only.

The index is a table with one row per text ever seen, bucketed and sorted by the
digest. A batch is reduced to one row per digest on the map side, so a text that
holds a third of all rows is one row per task; a sort-merge anti-join leaves the
digests that the index lacks, and those are appended.

Null texts count as empty and empty texts are equal. Ties on ``doc_id`` go to the row
that is read first, and a null ``doc_id`` yields to any other. Exactly one row of
each group stays. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.texts import with_row, with_row_of_all
from tarmac.session import ensure_checkpoint_dir

#: At most so many digests can each hold the share of the rows that makes one hot.
HOT_DIGESTS = 10_000


def normal_text(text: Column) -> Column:
    """Each run of ASCII white space is one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(normal_text(text), 256))


class DigestIndex:
    """The index table ``name``: digest, the doc_id that stays for it, its batch.

    A new index gets ``buckets`` buckets, by default as many as the session has shuffle
    partitions. While these are no more than the buckets, a batch is shuffled to the
    index and the index, however large, is read in place.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.buckets = self._stored_buckets() or buckets
        self.buckets = self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _stored_buckets(self) -> int | None:
        if not self.spark.catalog.tableExists(self.name):
            return None
        facts = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()
        return next(int(r["data_type"]) for r in facts if r["col_name"] == "Num Buckets")

    def rows(self) -> DataFrame:
        if not self.spark.catalog.tableExists(self.name):
            return self.spark.createDataFrame([], "digest binary, keep_id bigint, batch string")
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _append(self, rows: DataFrame) -> None:
        (
            rows.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )

    def ingest(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Append the new texts of ``docs`` and return a row for each of its rows.

        ``batch`` names this batch. A driver that died may ingest the same rows under the same
        name again, whatever it had appended: texts that are in the index under this name count
        as this batch's own, so the verdicts are those of the first time.

        Returns _row, doc_id, digest, keep_id (of this batch or an earlier one),
        group_size (rows of this batch with that text), kept.
        """
        ensure_checkpoint_dir(self.spark)
        prints = with_row(docs, "doc_id", text_digest(F.col("text")).alias("digest"))
        prints = prints.checkpoint()
        groups = prints.groupBy("digest").agg(
            F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "_row")).alias("first"),
            F.count(F.lit(1)).alias("group_size"),
        )
        batch = batch or uuid.uuid4().hex
        known = self.rows().hint("merge")
        novel = groups.join(known, "digest", "left_anti")
        self._append(
            novel.select(
                "digest", F.col("first.doc_id").alias("keep_id"), F.lit(batch).alias("batch")
            )
        )
        verdicts = groups.join(self.rows().hint("merge"), "digest").select(
            "digest",
            "keep_id",
            "group_size",
            F.when(F.col("batch") == batch, F.col("first._row")).alias("keep_row"),
        )
        return join_on_digest(prints, verdicts).select(
            "_row",
            "doc_id",
            "digest",
            "keep_id",
            "group_size",
            (F.col("_row") == F.coalesce("keep_row", F.lit(-1))).alias("kept"),
        )


def join_on_digest(prints: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Inner join on ``digest`` of rows and one verdict per digest with its
    ``group_size``. The few digests that hold a 10,000th of all rows or more are
    broadcast, so none of them meets in a task."""
    share = max(1, prints.count() // HOT_DIGESTS)
    hot = verdicts.filter(F.col("group_size") > share)
    rest = verdicts.filter(F.col("group_size") <= share)
    return prints.join(F.broadcast(hot), "digest").unionByName(
        prints.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(
            rest.hint("merge"), "digest"
        )
    )


def dedup_exact(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``, judged within ``docs`` alone: what
    ``DigestIndex.ingest`` returns over an index that is new and dropped again."""
    index = DigestIndex(docs.sparkSession)
    try:
        return index.ingest(docs).checkpoint()
    finally:
        index.drop()


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; all columns."""
    dropped = dedup_exact(docs).filter(~F.col("kept")).select("_row")
    rows = with_row_of_all(docs)
    return rows.join(dropped, "_row", "left_anti").select("doc.*")

"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

Texts are equal when they are identical without white space.  New data is grouped by digest, the groups meet the
index in a sort-merge anti-join, and the digests that the index lacks are appended to it.  Only ids, digests and
lengths are shuffled, never texts.

Defined cases: a null text is the empty text; the longest original stays, then the smallest id, a null id last; rows of
one id and one digest are returned each, and one of them stays if their id does; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import keep_rows
from shelfcast.session import materialise, scratch_dir


def digest(docs: DataFrame) -> Column:
    """SHA-256 of the text without white space, as 32 bytes."""
    text = F.coalesce(docs["text"], F.lit(""))
    return F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""), 256))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` and ``n_points``, the code points of the whole text."""
    length = F.length(F.coalesce(docs["text"], F.lit("")))
    return docs.select(docs["doc_id"], digest(docs).alias("digest"), length.alias("n_points"))


class DigestIndex:
    """Digests of all texts taken in so far, each with the id that stays for it.

    The index is a table under ``path``, in ``buckets`` files sorted by digest for each append (default: as many
    as the session's shuffles have partitions).  A session that opens the same path with as many buckets sees what
    earlier ones appended.  ``kind`` is the type of the ids.
    """

    def __init__(
        self, spark: SparkSession, path: str | None = None, buckets: int | None = None, kind: str = "BIGINT"
    ):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = path or f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {kind}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def ingest(self, docs: DataFrame) -> DataFrame:
        """Appends the digests of ``docs`` that are new; returns a decision for each document.

        ``doc_id``, ``keep_id``, ``group_size`` (rows of this batch with the digest), ``kept``, ``digest`` and
        ``copies`` (rows of the batch with both this id and this digest).  Every decision is made against the
        index as it was before the batch, so a batch that is repeated after its append keeps nothing.
        """
        rows = materialise(
            digests(docs)
            .groupBy("doc_id", "digest")
            .agg(F.max("n_points").alias("n_points"), F.count(F.lit(1)).alias("copies"))
        )
        best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id"))
        groups = materialise(
            rows.groupBy("digest").agg(best["doc_id"].alias("keep_id"), F.sum("copies").alias("group_size"))
        )
        known = self.table().select("digest", F.col("keep_id").alias("known_id")).hint("merge")
        fresh = groups.join(known, "digest", "left_anti")
        seen = groups.join(known, "digest").select("digest", F.col("known_id").alias("keep_id"), "group_size")
        decided = materialise(
            fresh.withColumn("new", F.lit(True)).unionByName(seen.withColumn("new", F.lit(False)))
        )
        added = decided.filter("new").select("digest", "keep_id")
        added.repartition(self.buckets, "digest").write.insertInto(self.name)
        return rows.join(decided, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            "digest",
            "copies",
        )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row for each document, dropped ones too, with the id that stays for its text."""
    index = index or DigestIndex(docs.sparkSession, kind=docs.schema["doc_id"].dataType.simpleString())
    decided = index.ingest(docs).withColumn("text_sha256", F.lower(F.hex("digest")))
    # Rows that share id and digest come back each, some at a time, so that no array grows with their number.
    last = F.col("copies") - 1
    spread = decided.withColumn("hundreds", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(100).cast("long"))))
    first = F.col("hundreds")
    spread = spread.withColumn("copy", F.explode(F.sequence(first, F.least(first + 99, last))))
    return spread.withColumn("kept", F.col("kept") & (F.col("copy") == 0)).drop("hundreds", "copy", "copies")


def keep_first_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Rows of ``docs`` that stay, one for each text, with all their columns."""
    index = index or DigestIndex(docs.sparkSession, kind=docs.schema["doc_id"].dataType.simpleString())
    decisions = index.ingest(docs).withColumnRenamed("digest", "key")
    return keep_rows(docs, decisions, digest(docs))

"""Exact deduplication by a tree of merges over sorted digest runs, in DataFrame operations only.

Each input partition is a run of (digest, length, second hash, largest identifier, rows), merged within itself first. In every round
``fan`` neighbouring runs become one: their entries are dealt out by ranges of digests within the new run and sorted, so equal
digests lie next to each other and one ordered pass merges them; the new run is again sorted, in as many pieces as there are
ranges, and no task ever has a whole one. A digest has ``fan`` entries at most in a round,
so a text that a third of all rows share costs no more than any other. Rounds go on until one
run is left. Entries only merge when the SHA-256 digest, the length and a second hash all agree.

Defined cases: null texts are empty texts; null identifiers are the smallest; of rows tied in text and
identifier exactly one stays; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import ascii_lower, saved

#: Runs that merge at once in a round.
FAN = 8
KEY = ["_digest", "_size", "_check"]


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One entry per row: its run, a row number, identifier and verified digest."""
    texts = docs.select(
        F.spark_partition_id().cast("long").alias("_run"),
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        ascii_lower(F.col(text_col)).alias("_text"),
    )
    return texts.select(
        "_run",
        "_row",
        "_id",
        F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_digest"),
        F.octet_length("_text").alias("_size"),
        F.xxhash64("_text").alias("_check"),
    )


def merge_runs(entries: DataFrame, fan: int = FAN) -> DataFrame:
    """The kept (identifier, row) and the number of rows of every distinct text."""
    last = entries.agg(F.max("_run")).first()[0] or 0
    own = [F.max(F.struct("_id", "_row")).alias("_keep"), F.count(F.lit(1)).alias("_rows")]
    merged = entries.groupBy("_run", *KEY).agg(*own)  # partial sums within each run
    while last:
        last //= fan
        joined = merged.withColumn("_run", F.expr(f"_run div {fan}"))
        sorted_run = joined.repartitionByRange("_run", *KEY).sortWithinPartitions("_run", *KEY)
        merged = sorted_run.groupBy("_run", *KEY).agg(F.max("_keep").alias("_keep"), F.sum("_rows").alias("_rows"))
    return merged.drop("_run")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = FAN) -> DataFrame:
    """One row per document, dropped ones too: identifier, keep_id, group_size, kept, text_sha256."""
    entries = saved(digest_runs(docs, id_col, text_col), "digest-runs")
    return entries.join(merge_runs(entries, fan), KEY).select(
        F.col("_id").alias(id_col),
        F.col("_keep._id").alias("keep_id"),
        F.col("_rows").alias("group_size"),
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = FAN) -> DataFrame:
    """The documents that stay, with all their columns; of rows tied in identifier the one with the largest text."""
    entries = saved(digest_runs(docs, id_col, text_col), "digest-runs")
    stay = merge_runs(entries, fan).select(*KEY, F.col("_keep._id").alias("_id"))
    lowered = ascii_lower(F.col(text_col))
    one = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_id"), lowered.alias("_text"))
    one = one.select(
        "_doc",
        "_id",
        F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_digest"),
        F.octet_length("_text").alias("_size"),
        F.xxhash64("_text").alias("_check"),
    )
    # Tied rows are merged before the shuffle, and the join uses the same one.
    tied = one.groupBy("_id", *KEY).agg(F.max_by("_doc", F.coalesce(F.col("_doc")[text_col], F.lit(""))).alias("_doc"))
    same = tied["_id"].eqNullSafe(stay["_id"])
    for name in KEY:
        same = same & (tied[name] == stay[name])
    return tied.join(stay, same, "left_semi").select("_doc.*")

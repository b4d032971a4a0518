"""Exact dedup by a tree merge of sorted digest runs (native).

Texts are equal when they are identical after lower-casing A-Z.  Each document
becomes one row ``(digest, length, check, doc_id)``; a run is a set of such
rows, sorted by digest.  The leaves are ``leaves`` runs dealt by a hash of
``doc_id``.  In every round the runs whose numbers agree above the next
``fan_bits`` bits (a binomial exchange) meet and are merged: Spark's sort
aggregate sorts each run by digest on the map side, exchanges it by (merged
run, digest) and merges the sorted pieces.  Every level keeps, per digest, the
smallest and the largest identifier and the number of rows, so a text that a
third of all documents share never sends more than one row per task and run
into a merge.  After the last round one run is left, spread by digest over all
tasks.

An identifier is retained only under a verified digest: SHA-256, byte length
and an independent 64-bit hash must all agree before two rows count as equal.

Edge cases: a null text counts as empty (equal to the empty text); an empty
table gives an empty result; rows that repeat a ``doc_id`` with the same text
count in ``group_size`` and are all marked alike, ``deduplicate`` then returns
one of them; a null ``doc_id`` never wins against a number, and in a group
without any number ``keep_id`` is null and its rows are marked kept.  Columns
other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsdq.llm.common import ascii_lower, lookup_hot_safe, staged, text_or_empty, unused_name

KEY = ["digest", "n_bytes", "check"]


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, digest, n_bytes, check) of every row; the text is read once."""
    norm = ascii_lower(text_or_empty(text))
    return docs.select("doc_id", norm.alias("norm")).select(
        "doc_id", F.sha2(F.col("norm"), 256).alias("digest"),
        F.octet_length("norm").cast("long").alias("n_bytes"), F.xxhash64("norm").alias("check"))


def merge_tree(rows: DataFrame, leaf_bits: int = 6, fan_bits: int = 2) -> DataFrame:
    """One row per distinct digest: smallest and largest ``doc_id``, rows."""
    one = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id"))
    runs = rows.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(1 << leaf_bits)).cast("int")) \
        .groupBy("run", *KEY).agg(F.min(one).alias("low"), F.max(one).alias("high"), F.count("*").alias("n"))
    for _ in range(0, leaf_bits, fan_bits):
        runs = runs.withColumn("run", F.shiftright("run", fan_bits)) \
            .groupBy("run", *KEY).agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                      F.sum("n").alias("n"))
    return runs.select(*KEY, F.col("low.doc_id").alias("smallest_id"),
                       F.col("high.doc_id").alias("largest_id"), F.col("n").alias("group_size"))


def duplicate_groups(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep!r}")
    rows = staged(digests(docs), "exact-digests")
    groups = staged(merge_tree(rows).filter("group_size > 1")
                    .select(*KEY, F.col(f"{keep}_id").alias("winner"), "group_size"), "exact-groups")
    found = lookup_hot_safe(rows, groups, KEY, "group_size", rows.count())
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("winner"))
    return found.select("doc_id", keep_id.alias("keep_id"),
                        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
                        F.col("digest").alias("text_sha256"))


def deduplicate(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    report = staged(duplicate_groups(docs, keep), "exact-report")
    mark = unused_name(docs, "__digest")
    marked = docs.withColumn(mark, F.sha2(ascii_lower(text_or_empty()), 256))

    def is_in(keys):
        return [marked["doc_id"].eqNullSafe(keys["k_id"]), marked[mark] == keys["k_digest"]]

    k = [F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_digest")]
    dropped = report.filter(~F.col("kept")).select(*k).distinct()
    repeated = staged(report.filter((F.col("group_size") > 1) & F.col("kept")).select(*k)
                      .groupBy("k_id", "k_digest").count().filter("count > 1").drop("count"),
                      "exact-repeated")
    if repeated.isEmpty():
        return marked.join(dropped, is_in(dropped), "left_anti").drop(mark)
    # rows that repeat a doc_id and its text: one of them stays
    once = marked.join(repeated, is_in(repeated), "left_semi").dropDuplicates(["doc_id", mark])
    gone = dropped.unionByName(repeated)
    return marked.join(gone, is_in(gone), "left_anti").unionByName(once).drop(mark)

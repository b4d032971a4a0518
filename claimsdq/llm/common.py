"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsdq.session import remove_path, ship_package, staging_path

#: One or more ASCII blanks (space, \\t \\n \\v \\f \\r) separate words.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


_scratch: list[list[str]] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.  The
    written table cuts the lineage, so a lost executor costs a re-read only.

    A query's lazy result reads such tables, so they stay until the checkpoint
    folder is cleaned, unless a ``scratch`` context of the caller removes them."""
    path = staging_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    for paths in _scratch[-1:]:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """The paths of the tables staged within; those still listed at the end are
    removed.  Take a path off the list (the last one staged is the last in it) to
    keep its table."""
    paths: list[str] = []
    _scratch.append(paths)
    try:
        yield paths
    finally:
        _scratch.remove(paths)
        for path in paths:
            remove_path(spark, path)


def unused_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    name = stem
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"{stem}_{uuid.uuid4().hex[:8]}"
    return name


#: A key is hot when more than one row in HOT_SHARE has it, so there are fewer
#: than HOT_SHARE hot keys whatever the input: their lookup rows are always
#: small enough to broadcast.
HOT_SHARE = 1000


def lookup_hot_safe(big: DataFrame, small: DataFrame, keys: list[str], n: str,
                    total: int) -> DataFrame:
    """Left join of ``big`` to ``small`` (one row per key, ``n`` = the key's
    number of rows in ``big``, ``total`` = all rows of ``big``).

    Hot keys are looked up by broadcast (fewer than ``HOT_SHARE`` rows by
    arithmetic); the rest join by shuffle.  Rows already answered get a
    throw-away salt in the shuffle, so they spread over all tasks instead of
    meeting in the task of their hot key.
    """
    vals = [c for c in small.columns if c not in keys]
    is_hot = F.col(n) * F.lit(HOT_SHARE) > F.lit(total)
    hot = small.filter(is_hot).select(*[F.col(k).alias(f"__h_{k}") for k in keys],
                                      F.struct(*vals).alias("__hot"))
    cold = small.filter(~is_hot).select(*[F.col(k).alias(f"__c_{k}") for k in keys],
                                        F.lit(0).cast("long").alias("__c_salt"),
                                        F.struct(*vals).alias("__cold"))
    on_hot = [F.col(k).eqNullSafe(F.col(f"__h_{k}")) for k in keys]
    out = big.join(F.broadcast(hot), on_hot, "left").drop(*[f"__h_{k}" for k in keys])
    salt = F.when(F.col("__hot").isNull(), F.lit(0).cast("long")).otherwise(
        F.xxhash64(*[F.col(c) for c in big.columns]).bitwiseOR(F.lit(1).cast("long")))
    out = out.withColumn("__salt", salt)
    on_cold = [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys] + [F.col("__salt") == F.col("__c_salt")]
    out = out.join(cold, on_cold, "left")
    found = F.coalesce(F.col("__hot"), F.col("__cold"))
    return out.select(*big.columns, *[found.getField(v).alias(v) for v in vals])

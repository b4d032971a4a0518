"""Joins to a derived small side whose size is checked before it is broadcast.

The small side (per-code stats, a set of flagged files) is an aggregate of the
big side, so its size follows the number of distinct keys, not a constant.
``guarded_join`` writes it as a table under the shared checkpoint folder
(which cuts its lineage and makes it survive executor loss), counts its rows
and bytes, and

* broadcasts it when both are within the given bounds: the big side is not
  shuffled at all, so a hot key (a third of all rows on one code) costs
  nothing extra;
* otherwise joins by shuffle, salted: every big row gets a salt by its place in
  its input split (the same for a retried task, and different for equal rows),
  and the small side is replicated once per salt.  The number of salts follows
  the big side's size, so a key holding a third of all rows meets its small
  row in that many tasks; AQE's skew-join split handles what remains.  Each big
  row still meets exactly one copy of its small row, so left, semi and anti
  joins keep their meaning.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsdq.session import RunContext

#: The shuffled big side is meant to come in pieces of about this size.
SALT_BYTES = 4 << 30
MIN_SALTS = 8
#: More salts would replicate the small side further than it pays; AQE splits
#: the pieces from there on.
MAX_SALTS = 1024


def write_small(df: DataFrame, name: str = "small", ctx: RunContext | None = None) -> DataFrame:
    """Write an aggregate-sized ``df`` once as a Parquet table under the shared
    checkpoint folder and read it back: later plans that use it several times
    (union branches, self joins) read the table instead of recomputing it."""
    return (ctx or RunContext(df.sparkSession)).stage(df, name)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    total = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + F.lit(16)
        else:
            total = total + F.lit(8 if isinstance(f.dataType, T.AtomicType) else 64)
    return total


def materialize_small(small: DataFrame, ctx: RunContext | None = None) -> tuple[DataFrame, int, int]:
    """Write ``small`` once, read it back and count its rows and bytes."""
    written = write_small(small, ctx=ctx)
    size = written.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(written)).alias("b")).first()
    return written, size["n"], size["b"] or 0


def salt_buckets(big: DataFrame) -> int:
    """Salts by the planner's estimate of the big side's size."""
    size = int(str(big._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(MIN_SALTS, min(MAX_SALTS, size // SALT_BYTES))


def guarded_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str,
                 max_rows: int, extra: Callable[[DataFrame], Column] | None = None,
                 max_bytes: int = 64 << 20, ctx: RunContext | None = None) -> DataFrame:
    """Join ``big`` to ``small`` on equal ``keys``.

    ``extra(big)`` adds a condition on the big side (e.g. "row is clean"); the
    small side's key columns are dropped from the output.
    """
    small, n, size = materialize_small(small, ctx)
    renamed = small
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__k_{k}")

    def condition(left: DataFrame, right: DataFrame) -> Column:
        cond = F.lit(True) if extra is None else extra(left)
        for k in keys:
            cond = cond & (left[k] == right[f"__k_{k}"])
        return cond

    semi = how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti")
    if n <= max_rows and size <= max_bytes:
        out = big.join(F.broadcast(renamed), condition(big, renamed), how)
    else:
        salts = salt_buckets(big)
        big = big.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
        reps = renamed.withColumn("__r_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        out = big.join(reps, condition(big, reps) & (big["__salt"] == reps["__r_salt"]), how).drop("__salt")
        if not semi:
            out = out.drop("__r_salt")
    return out if semi else out.drop(*[f"__k_{k}" for k in keys])

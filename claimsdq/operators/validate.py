"""R15 and the classify step: one projection adds ``dq_issues``; the split into
clean and failed rows is two filters over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsdq.functions.rules import (
    RULES, issues_all_match, issues_first_match, rule_predicate)
from claimsdq.params import DEFAULT, DQParams

FIRST_MATCH = "first_match"
ALL_MATCH = "all_match"


def with_issues(claims: DataFrame, params: DQParams = DEFAULT, mode: str = FIRST_MATCH) -> DataFrame:
    """Add ``dq_issues`` (``"CODE;CODE;"``, empty when clean) and ``has_dq_issues``."""
    expr = issues_first_match(params) if mode == FIRST_MATCH else issues_all_match(params)
    return (claims.withColumn("dq_issues", expr)
            .withColumn("has_dq_issues", F.length("dq_issues") > 0))


def split_clean_failed(claims: DataFrame, params: DQParams = DEFAULT,
                       mode: str = FIRST_MATCH) -> tuple[DataFrame, DataFrame]:
    """The clean rows without the helper columns, and the failed rows with
    ``dq_issues`` and ``has_dq_issues``."""
    flagged = with_issues(claims, params, mode)
    clean = flagged.filter(~F.col("has_dq_issues")).drop("dq_issues", "has_dq_issues")
    failed = flagged.filter(F.col("has_dq_issues"))
    return clean, failed


def rule_hits(claims: DataFrame, code: str, params: DQParams = DEFAULT) -> DataFrame:
    """Rows for which one rule's predicate is true (NULL is not a hit)."""
    rule = next(r for r in RULES if r.code == code)
    return claims.filter(rule_predicate(code, params)).select("claim_id", *rule.columns)

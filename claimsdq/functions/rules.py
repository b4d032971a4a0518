"""Validation rules R1-R14 and the two issue-string builders R16, R17.

A rule is data: ``(code, group, predicate)``.  Both modes compile the same
rule list into one projection of built-in Column expressions (a single
``concat_ws`` over ``CASE WHEN`` chains), so classification stays inside
whole-stage codegen and costs one narrow pass over the claims.

* first-match (``dq_issues_first_match``, the batch job): within a group the
  first true predicate wins; groups append in order; a NULL predicate falls
  through, so NULL status, gender, zip or dates are not flagged.
* all-match (``dq_issues_all_match``, the local checker): every rule is
  independent, there is no zip rule, and a NULL status, gender or NPI counts as
  invalid; a NaN amount counts as missing, not excessive.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimsdq.params import DQParams

Pred = Callable[[DQParams], Column]


@dataclass(frozen=True)
class Rule:
    code: str
    group: int
    predicate: Pred          # first-match form: NULL means "not flagged"
    all_match: Pred | None   # all-match form (None: rule absent in that mode)
    columns: tuple[str, ...]  # claim columns the rule reads


def _c(name: str) -> Column:
    return F.col(name)


def _npi_valid(p: DQParams) -> Column:
    npi = _c("provider_npi")
    return (F.length(npi) == p.npi_length) & npi.rlike(p.npi_pattern)


def _future(p: DQParams) -> Column:
    return _c("service_date") > F.date_add(F.lit(p.need("as_of")), p.future_date_tolerance_days)


def _late(p: DQParams) -> Column:
    return F.datediff(_c("submission_date"), _c("service_date")) > p.max_days_to_submission


def _before(p: DQParams) -> Column:
    return _c("submission_date") < _c("service_date")


def _missing_diag(p: DQParams) -> Column:
    return _c("icd10_code").isNull() | (_c("icd10_code") == "")


def _null_is_true(pred: Pred) -> Pred:
    return lambda p: F.coalesce(pred(p), F.lit(True))


# Issue codes and their groups (fixed values: codes, order, grouping).
RULES: tuple[Rule, ...] = (
    Rule("MISSING_MEMBER_ID", 1, lambda p: _c("member_id").isNull(),
         lambda p: _c("member_id").isNull(), ("member_id",)),
    Rule("MISSING_NPI", 1, lambda p: _c("provider_npi").isNull(),
         lambda p: _c("provider_npi").isNull(), ("provider_npi",)),
    Rule("MISSING_CPT", 1, lambda p: _c("cpt_code").isNull(),
         lambda p: _c("cpt_code").isNull(), ("cpt_code",)),
    Rule("MISSING_DIAGNOSIS", 1, _missing_diag, _missing_diag, ("icd10_code",)),
    Rule("MISSING_AMOUNT", 1, lambda p: _c("claim_amount").isNull(),
         lambda p: _c("claim_amount").isNull() | F.isnan(_c("claim_amount")), ("claim_amount",)),
    Rule("INVALID_NPI", 2, lambda p: ~_npi_valid(p),
         _null_is_true(lambda p: ~_c("provider_npi").rlike(p.npi_pattern)), ("provider_npi",)),
    Rule("NEGATIVE_AMOUNT", 3, lambda p: _c("claim_amount") < p.min_claim_amount,
         lambda p: _c("claim_amount") < p.min_claim_amount, ("claim_amount",)),
    Rule("EXCESSIVE_AMOUNT", 3, lambda p: _c("claim_amount") > p.max_claim_amount,
         lambda p: (_c("claim_amount") > p.max_claim_amount) & ~F.isnan(_c("claim_amount")),
         ("claim_amount",)),
    Rule("FUTURE_SERVICE_DATE", 4, _future, _future, ("service_date",)),
    Rule("LATE_SUBMISSION", 4, _late, _late, ("service_date", "submission_date")),
    Rule("SUBMISSION_BEFORE_SERVICE", 4, _before, _before, ("service_date", "submission_date")),
    Rule("INVALID_STATUS", 5, lambda p: ~_c("claim_status").isin(*p.valid_statuses),
         _null_is_true(lambda p: ~_c("claim_status").isin(*p.valid_statuses)), ("claim_status",)),
    Rule("INVALID_GENDER", 6, lambda p: ~_c("patient_gender").isin(*p.valid_genders),
         _null_is_true(lambda p: ~_c("patient_gender").isin(*p.valid_genders)), ("patient_gender",)),
    Rule("INVALID_ZIP", 7, lambda p: ~_c("patient_zip").rlike(p.zip_pattern),
         None, ("patient_zip",)),
)

RULES_BY_CODE = {r.code: r for r in RULES}
ISSUE_CODES = tuple(r.code for r in RULES)


def rule_predicate(code: str, params: DQParams) -> Column:
    """The first-match predicate of one rule, for per-rule filters."""
    return RULES_BY_CODE[code].predicate(params)


def issues_first_match(params: DQParams, rules: tuple[Rule, ...] = RULES) -> Column:
    """``"CODE;CODE;"``, at most one code per group, groups in order."""
    groups: dict[int, list[Rule]] = {}
    for r in rules:
        groups.setdefault(r.group, []).append(r)
    parts = []
    for g in sorted(groups):
        chain = None
        for r in groups[g]:
            cond, val = r.predicate(params), F.lit(r.code + ";")
            chain = F.when(cond, val) if chain is None else chain.when(cond, val)
        parts.append(chain)
    return F.concat_ws("", *parts)


def issues_all_match(params: DQParams, rules: tuple[Rule, ...] = RULES) -> Column:
    """Every failing rule appends its code (local-checker semantics)."""
    parts = [F.when(r.all_match(params), F.lit(r.code + ";")) for r in rules if r.all_match]
    return F.concat_ws("", *parts)


def issue_array(issues: Column) -> Column:
    """``"A;B;"`` -> ``["A", "B"]`` (empty entries dropped)."""
    return F.filter(F.split(issues, ";"), lambda s: s != "")

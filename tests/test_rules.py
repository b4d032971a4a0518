"""R1-R17 on hand-written rows (fixture F2) and a randomized cross-check."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from claimsdq.operators.validate import ALL_MATCH, FIRST_MATCH, split_clean_failed, with_issues
from claimsdq.plans.fixtures import P as DEFAULT
from conftest import claim, claims_df

AS_OF = DEFAULT.as_of

CASES = [
    # (overrides, first-match issues, all-match issues)
    ({}, "", ""),
    ({"member_id": None}, "MISSING_MEMBER_ID;", "MISSING_MEMBER_ID;"),
    ({"provider_npi": None}, "MISSING_NPI;", "MISSING_NPI;INVALID_NPI;"),
    ({"cpt_code": None}, "MISSING_CPT;", "MISSING_CPT;"),
    ({"icd10_code": ""}, "MISSING_DIAGNOSIS;", "MISSING_DIAGNOSIS;"),
    ({"icd10_code": None}, "MISSING_DIAGNOSIS;", "MISSING_DIAGNOSIS;"),
    ({"claim_amount": None}, "MISSING_AMOUNT;", "MISSING_AMOUNT;"),
    ({"provider_npi": "12345"}, "INVALID_NPI;", "INVALID_NPI;"),
    ({"provider_npi": "123456789a"}, "INVALID_NPI;", "INVALID_NPI;"),
    ({"provider_npi": "0000000000"}, "", ""),
    ({"claim_amount": -0.01}, "NEGATIVE_AMOUNT;", "NEGATIVE_AMOUNT;"),
    ({"claim_amount": 0.0}, "", ""),
    ({"claim_amount": 100000.0}, "", ""),
    ({"claim_amount": 100000.01}, "EXCESSIVE_AMOUNT;", "EXCESSIVE_AMOUNT;"),
    ({"claim_amount": float("nan")}, "EXCESSIVE_AMOUNT;", "MISSING_AMOUNT;"),
    ({"service_date": AS_OF, "submission_date": AS_OF + dt.timedelta(days=5)}, "", ""),
    ({"service_date": AS_OF + dt.timedelta(days=1), "submission_date": AS_OF + dt.timedelta(days=5)},
     "FUTURE_SERVICE_DATE;", "FUTURE_SERVICE_DATE;"),
    ({"submission_date": dt.date(2024, 6, 1) + dt.timedelta(days=365)}, "", ""),
    ({"submission_date": dt.date(2024, 6, 1) + dt.timedelta(days=366)}, "LATE_SUBMISSION;", "LATE_SUBMISSION;"),
    ({"submission_date": dt.date(2024, 5, 31)}, "SUBMISSION_BEFORE_SERVICE;", "SUBMISSION_BEFORE_SERVICE;"),
    ({"claim_status": "VOID"}, "INVALID_STATUS;", "INVALID_STATUS;"),
    ({"patient_gender": "X"}, "INVALID_GENDER;", "INVALID_GENDER;"),
    ({"patient_zip": "1234"}, "INVALID_ZIP;", ""),
    ({"patient_zip": "12345-6789"}, "", ""),
    ({"cpt_code": "INVALID"}, "", ""),
    ({"member_id": None, "provider_npi": None}, "MISSING_MEMBER_ID;", "MISSING_MEMBER_ID;MISSING_NPI;INVALID_NPI;"),
    ({"claim_amount": -5.0, "provider_npi": "12345"}, "INVALID_NPI;NEGATIVE_AMOUNT;",
     "INVALID_NPI;NEGATIVE_AMOUNT;"),
    ({"claim_status": None, "patient_gender": None, "patient_zip": None, "service_date": None,
      "submission_date": None}, "", "INVALID_STATUS;INVALID_GENDER;"),
    ({"member_id": None, "claim_amount": -1.0, "service_date": AS_OF + dt.timedelta(days=3),
      "submission_date": AS_OF + dt.timedelta(days=4), "claim_status": "X", "patient_gender": "Q",
      "patient_zip": "abc"},
     "MISSING_MEMBER_ID;NEGATIVE_AMOUNT;FUTURE_SERVICE_DATE;INVALID_STATUS;INVALID_GENDER;INVALID_ZIP;",
     "MISSING_MEMBER_ID;NEGATIVE_AMOUNT;FUTURE_SERVICE_DATE;INVALID_STATUS;INVALID_GENDER;"),
]


def test_issue_strings_both_modes(spark):
    rows = [claim(claim_id=f"C{i}", **over) for i, (over, _, _) in enumerate(CASES)]
    df = claims_df(spark, rows)
    first = {r.claim_id: r.dq_issues for r in with_issues(df, DEFAULT, FIRST_MATCH).collect()}
    allm = {r.claim_id: r.dq_issues for r in with_issues(df, DEFAULT, ALL_MATCH).collect()}
    for i, (over, want_first, want_all) in enumerate(CASES):
        assert first[f"C{i}"] == want_first, (over, first[f"C{i}"])
        assert allm[f"C{i}"] == want_all, (over, allm[f"C{i}"])


def test_split_clean_failed(spark):
    rows = [claim(claim_id=f"C{i}", **over) for i, (over, _, _) in enumerate(CASES)]
    clean, failed = split_clean_failed(claims_df(spark, rows), DEFAULT)
    n_failed = sum(1 for _, f, _ in CASES if f)
    assert failed.count() == n_failed
    assert clean.count() == len(CASES) - n_failed
    assert "dq_issues" not in clean.columns and "has_dq_issues" in failed.columns


def _py_first_match(r: dict) -> str:
    """A plain-Python statement of the first-match rules, for cross-checking."""
    def lt(a, b):
        return None if a is None or b is None else a < b

    def gt(a, b):
        if a is None or b is None:
            return None
        if isinstance(a, float) and math.isnan(a):
            return True  # NaN sorts above every number in Spark
        return a > b
    out = []
    g1 = [("MISSING_MEMBER_ID", r["member_id"] is None), ("MISSING_NPI", r["provider_npi"] is None),
          ("MISSING_CPT", r["cpt_code"] is None),
          ("MISSING_DIAGNOSIS", r["icd10_code"] is None or r["icd10_code"] == ""),
          ("MISSING_AMOUNT", r["claim_amount"] is None)]
    for code, hit in g1:
        if hit:
            out.append(code)
            break
    npi = r["provider_npi"]
    if npi is not None and not (len(npi) == 10 and npi.isascii() and npi.isdigit()):
        out.append("INVALID_NPI")
    a = r["claim_amount"]
    neg = lt(a, 0.0) if not (isinstance(a, float) and math.isnan(a)) else False
    if neg:
        out.append("NEGATIVE_AMOUNT")
    elif gt(a, 100000.0):
        out.append("EXCESSIVE_AMOUNT")
    s, sub = r["service_date"], r["submission_date"]
    if s is not None and s > AS_OF:
        out.append("FUTURE_SERVICE_DATE")
    elif s is not None and sub is not None and (sub - s).days > 365:
        out.append("LATE_SUBMISSION")
    elif s is not None and sub is not None and sub < s:
        out.append("SUBMISSION_BEFORE_SERVICE")
    if r["claim_status"] is not None and r["claim_status"] not in DEFAULT.valid_statuses:
        out.append("INVALID_STATUS")
    if r["patient_gender"] is not None and r["patient_gender"] not in DEFAULT.valid_genders:
        out.append("INVALID_GENDER")
    z = r["patient_zip"]
    if z is not None:
        import re
        if not re.search(r"^[0-9]{5}(-[0-9]{4})?$", z):
            out.append("INVALID_ZIP")
    return "".join(c + ";" for c in out)


def test_first_match_randomized(spark):
    rnd = random.Random(7)
    pick = rnd.choice
    rows, dicts = [], []
    for i in range(400):
        svc = pick([None, AS_OF, AS_OF + dt.timedelta(days=1), dt.date(2024, 3, 1)])
        sub = None if svc is None else pick([None] + [svc + dt.timedelta(days=d) for d in (-1, 0, 365, 366, 10)])
        over = dict(
            claim_id=f"R{i}", member_id=pick([None, "M1"]), provider_npi=pick([None, "123", "1234567890", "12345678x0"]),
            cpt_code=pick([None, "A", "B"]), icd10_code=pick([None, "", "I10"]),
            claim_amount=pick([None, -1.0, 0.0, 5.0, 100000.0, 100000.5, float("nan")]),
            service_date=svc, submission_date=sub, claim_status=pick([None, "PAID", "VOID"]),
            patient_gender=pick([None, "M", "Z"]), patient_zip=pick([None, "12345", "1234", "12345-678"]))
        rows.append(claim(**over))
        over = {**__import__("conftest").VALID, **over}
        dicts.append(dict(over))
    got = {r.claim_id: r.dq_issues for r in with_issues(claims_df(spark, rows), DEFAULT).collect()}
    for d in dicts:
        assert got[d["claim_id"]] == _py_first_match(d), d


@pytest.mark.parametrize("mode", [FIRST_MATCH, ALL_MATCH])
def test_classification_is_one_projection(spark, mode):
    """No shuffle, no Python: the rules compile into codegen'd expressions."""
    df = with_issues(claims_df(spark, [claim()]), DEFAULT, mode).select("dq_issues")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_f1_issue_codes_all_seen(spark):
    from claimsdq.functions.rules import ISSUE_CODES, issue_array
    from claimsdq.plans.fixtures import load_claims
    from conftest import SF_SMALL
    f = with_issues(load_claims(spark, SF_SMALL), DEFAULT)
    seen = {r.c for r in f.select(F.explode(issue_array(F.col("dq_issues"))).alias("c")).distinct().collect()}
    assert seen == set(ISSUE_CODES)


def _py_all_match(r: dict) -> str:
    """Plain-Python all-match rules (the local checker's semantics)."""
    out = []
    a = r["claim_amount"]
    nan = isinstance(a, float) and math.isnan(a)
    s, sub = r["service_date"], r["submission_date"]
    import re
    checks = [
        ("MISSING_MEMBER_ID", r["member_id"] is None),
        ("MISSING_NPI", r["provider_npi"] is None),
        ("MISSING_CPT", r["cpt_code"] is None),
        ("MISSING_DIAGNOSIS", r["icd10_code"] in (None, "")),
        ("MISSING_AMOUNT", a is None or nan),
        ("INVALID_NPI", r["provider_npi"] is None or not re.search(r"^[0-9]{10}$", r["provider_npi"])),
        ("NEGATIVE_AMOUNT", a is not None and not nan and a < 0),
        ("EXCESSIVE_AMOUNT", a is not None and not nan and a > 100000.0),
        ("FUTURE_SERVICE_DATE", s is not None and s > AS_OF),
        ("LATE_SUBMISSION", s is not None and sub is not None and (sub - s).days > 365),
        ("SUBMISSION_BEFORE_SERVICE", s is not None and sub is not None and sub < s),
        ("INVALID_STATUS", r["claim_status"] not in DEFAULT.valid_statuses),
        ("INVALID_GENDER", r["patient_gender"] not in DEFAULT.valid_genders),
    ]
    return "".join(c + ";" for c, hit in checks if hit)


def test_all_match_randomized(spark):
    from conftest import VALID
    rnd = random.Random(11)
    pick = rnd.choice
    rows, dicts = [], []
    for i in range(400):
        svc = pick([None, AS_OF, AS_OF + dt.timedelta(days=2), dt.date(2024, 3, 1)])
        over = dict(
            claim_id=f"A{i}", member_id=pick([None, "M1"]), provider_npi=pick([None, "123", "1234567890"]),
            cpt_code=pick([None, "A"]), icd10_code=pick([None, "", "I10"]),
            claim_amount=pick([None, -1.0, 0.0, 100000.5, float("nan")]), service_date=svc,
            submission_date=None if svc is None else pick([None, svc - dt.timedelta(days=1),
                                                           svc + dt.timedelta(days=400)]),
            claim_status=pick([None, "PAID", "VOID"]), patient_gender=pick([None, "F", "Z"]),
            patient_zip=pick([None, "1"]))
        rows.append(claim(**over))
        dicts.append({**VALID, **over})
    got = {r.claim_id: r.dq_issues for r in with_issues(claims_df(spark, rows), DEFAULT, ALL_MATCH).collect()}
    for d in dicts:
        assert got[d["claim_id"]] == _py_all_match(d), d

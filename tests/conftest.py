import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimsdq.session import local_session  # noqa: E402
from claimsdq.sources.claims import CLAIMS_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="claimsdq-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


VALID = dict(
    claim_id="C1", member_id="MBR1", provider_id="PRV1", provider_npi="1234567890",
    cpt_code="99213", icd10_code="I10", claim_amount=100.0,
    service_date=dt.date(2024, 6, 1), submission_date=dt.date(2024, 6, 10),
    claim_status="PAID", denial_reason=None, patient_dob=dt.date(1980, 1, 1),
    patient_zip="12345", patient_gender="M",
)


def claim(**over):
    row = dict(VALID)
    row.update(over)
    return tuple(row[f.name] for f in CLAIMS_SCHEMA.fields)


def claims_df(spark, rows, source_file="claims/test.csv"):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, CLAIMS_SCHEMA).withColumn("source_file", F.lit(source_file))

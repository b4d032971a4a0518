"""Claims sources: the fixed-schema CSV scan (S1, S2, S3, S5) and the listing
of claim files behind arrival ingest (S4)."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsdq.sources.rescue import scan_places

# Fixed schema of a claims file; columns bind by position, header names are
# ignored (values that must equal the reference's: names, order, types).
CLAIMS_SCHEMA = T.StructType([
    T.StructField("claim_id", T.StringType(), False),
    T.StructField("member_id", T.StringType(), True),
    T.StructField("provider_id", T.StringType(), True),
    T.StructField("provider_npi", T.StringType(), True),
    T.StructField("cpt_code", T.StringType(), True),
    T.StructField("icd10_code", T.StringType(), True),
    T.StructField("claim_amount", T.DoubleType(), True),
    T.StructField("service_date", T.DateType(), True),
    T.StructField("submission_date", T.DateType(), True),
    T.StructField("claim_status", T.StringType(), True),
    T.StructField("denial_reason", T.StringType(), True),
    T.StructField("patient_dob", T.DateType(), True),
    T.StructField("patient_zip", T.StringType(), True),
    T.StructField("patient_gender", T.StringType(), True),
])

CLAIM_COLUMNS = [f.name for f in CLAIMS_SCHEMA.fields]


def read_claims_csv(spark: SparkSession, path: str | list[str], key_root: str | None = None,
                    run_ts: dt.datetime | Column | None = None, corrupt_column: str | None = None,
                    header: bool = True, only: str | None = None) -> DataFrame:
    """Read one file, a folder (with all folders in it) or a glob
    of claims CSVs; ``only`` is a pattern that file names must match.

    * The schema is given, so no inference pass; PERMISSIVE mode turns a bad
      field or a short row into NULLs.
    * ``source_file`` is each row's own file (``_metadata.file_path``), with
      ``key_root`` stripped so it reads like an object key
      (``claims/payer_claims_20240101.csv``).  A literal would label every row
      of a folder read with the folder name.
    * ``ingestion_timestamp`` is one literal per run (``run_ts``, an aware
      datetime), not ``current_timestamp()`` per action.
    """
    schema = CLAIMS_SCHEMA
    if corrupt_column:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType(), True)])
    reader = spark.read.schema(schema).option("header", str(header).lower()).option("mode", "PERMISSIVE") \
        .option("recursiveFileLookup", "true")
    if only:
        reader = reader.option("pathGlobFilter", only)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if isinstance(run_ts, dt.datetime):
        run_ts = F.lit(run_ts)
    rows = reader.csv(path)
    if corrupt_column:
        rows = rows.withColumns(scan_places())
    return rows \
        .withColumn("source_file", object_key(F.col("_metadata.file_path"), key_root)) \
        .withColumn("ingestion_timestamp", run_ts if run_ts is not None else F.current_timestamp())


def read_claims_untyped(spark: SparkSession, path: str | list[str], key_root: str | None = None,
                        run_ts: dt.datetime | None = None, only: str | None = None) -> DataFrame:
    """Claims CSVs as the local checker reads them: columns by header name,
    types brought to the fixed schema value by value (bad ones become NULL)."""
    reader = spark.read.option("header", "true").option("recursiveFileLookup", "true")
    if only:
        reader = reader.option("pathGlobFilter", only)
    return conform_to_schema(
        reader.csv(path).withColumn("source_file", object_key(F.col("_metadata.file_path"), key_root))
        .withColumn("ingestion_timestamp", F.lit(run_ts) if run_ts else F.current_timestamp()))


def list_claim_files(spark: SparkSession, path: str | list[str], key_root: str | None = None,
                     only: str | None = "*.csv") -> DataFrame:
    """Every file under ``path`` at any depth (whose name matches ``only``):
    source_file, path, modified, bytes.  Only the listing is read, never a
    file's content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.load(path).select(
        object_key(F.col("path"), key_root, encoded=False).alias("source_file"), "path",
        F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def conform_to_schema(df: DataFrame) -> DataFrame:
    """Bring an untyped or loosely typed claims frame to the fixed schema.

    Strings become dates or doubles with ``try_*`` casts, so a bad value turns
    into NULL (as the checker's ``to_datetime(errors="coerce")`` does) instead
    of failing the job under ANSI mode; other columns are cast to string."""
    cols = []
    for f in CLAIMS_SCHEMA.fields:
        if f.name not in df.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c, have = F.col(f.name), df.schema[f.name].dataType
        if have == f.dataType:
            cols.append(c)
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.try_to_date(c.cast("string")).alias(f.name) if not isinstance(have, T.TimestampType)
                        else c.cast("date").alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            cols.append(c.try_cast("double").alias(f.name))
        else:
            cols.append(c.cast("string").alias(f.name))
    rest = [F.col(c) for c in df.columns if c not in CLAIM_COLUMNS]
    return df.select(*cols, *rest)


def object_key(file_path: Column, key_root: str | None, encoded: bool = True) -> Column:
    """A file URI as an object key: scheme and authority dropped, ``key_root``
    (a folder or bucket URI) stripped, percent-escapes decoded where the path is
    ``encoded`` (as a row's file path is, and a listed one is not)."""
    if encoded:
        file_path = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    if not key_root:
        return F.regexp_replace(file_path, "^file:/+", "file:///")
    path = F.regexp_replace(file_path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")
    root = urlparse(key_root).path if "://" in key_root or key_root.startswith("file:") else key_root
    root = "/" + root.strip("/") + "/" if root.strip("/") else "/"
    return F.when(path.startswith(root), F.right(path, F.char_length(path) - F.lit(len(root)))).otherwise(path)


def exact_path(path: str) -> str:
    """A listed path as a pattern that matches nothing but itself."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def no_claims(spark: SparkSession) -> DataFrame:
    """The scan of no file at all."""
    meta = [T.StructField("source_file", T.StringType()), T.StructField("ingestion_timestamp", T.TimestampType())]
    return spark.createDataFrame([], T.StructType(CLAIMS_SCHEMA.fields + meta))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

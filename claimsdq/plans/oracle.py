"""DuckDB SQL for every query of the catalog (the correctness oracle).

The text is built from shared CTEs so that each query reads only the
pre-registered driver views (``events``, ``orders``, ``customer``).  Column
names, types and 6-digit rounding follow ``plans/queries.py``.
"""

from __future__ import annotations

from claimsdq.operators.metrics import METRICS
from claimsdq.operators.alarms import ACTION_ROUTES
from claimsdq.plans.fixtures import P

NS = P.dq_namespace
CNS = P.cost_namespace

# Fixture F1 in DuckDB's dialect.
_F1 = """
SELECT 'C' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS claim_id,
 CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'MBR' || CAST(user_id AS VARCHAR) END AS member_id,
 'PRV' || CAST(event_id % 97 AS VARCHAR) AS provider_id,
 CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN '12345' WHEN event_id % 211 = 0 THEN '0000000000' ELSE CAST(1000000000 + user_id AS VARCHAR) END AS provider_npi,
 CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 223 = 0 THEN 'INVALID' ELSE event_type END AS cpt_code,
 CASE WHEN event_id % 113 = 0 THEN '' WHEN event_id % 127 = 0 THEN NULL ELSE 'I10' END AS icd10_code,
 CASE WHEN event_id % 131 = 0 THEN NULL WHEN event_id % 137 = 0 THEN -value WHEN event_id % 139 = 0 THEN value + 200000 ELSE value END AS claim_amount,
 CASE WHEN event_id % 149 = 0 THEN DATE '2099-01-01' WHEN event_id % 227 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS service_date,
 CASE WHEN event_id % 151 = 0 THEN CAST(ts AS DATE) + 400 WHEN event_id % 157 = 0 THEN CAST(ts AS DATE) + (-5) ELSE CAST(ts AS DATE) + CAST(1 + event_id % 30 AS INTEGER) END AS submission_date,
 CASE WHEN event_id % 163 = 0 THEN 'VOID' WHEN event_id % 167 = 0 THEN NULL WHEN event_id % 20 < 3 THEN 'DENIED' WHEN event_id % 10 = 9 THEN 'PENDING' ELSE 'PAID' END AS claim_status,
 CASE WHEN event_id % 20 < 3 THEN 'Duplicate claim' END AS denial_reason,
 DATE '1960-01-01' + CAST(user_id % 15000 AS INTEGER) AS patient_dob,
 CASE WHEN event_id % 179 = 0 THEN '1234' WHEN event_id % 181 = 0 THEN '12345-6789' ELSE lpad(CAST(user_id AS VARCHAR), 5, '0') END AS patient_zip,
 CASE WHEN event_id % 173 = 0 THEN 'X' WHEN event_id % 3 = 0 THEN 'M' WHEN event_id % 3 = 1 THEN 'F' ELSE 'U' END AS patient_gender,
 ts, 'claims/payer_claims_' || strftime(ts, '%Y%m%d') || '.csv' AS source_file
FROM events"""

CLAIMS = f"claims AS ({_F1})"

CLAIM_COLS = ("claim_id, member_id, provider_id, provider_npi, cpt_code, icd10_code, claim_amount, "
              "service_date, submission_date, claim_status, denial_reason, patient_dob, patient_zip, "
              "patient_gender")

AS_OF = "DATE '2024-12-31'"

RULE_SQL = {
    "MISSING_MEMBER_ID": ("member_id IS NULL", "member_id"),
    "MISSING_NPI": ("provider_npi IS NULL", "provider_npi"),
    "MISSING_CPT": ("cpt_code IS NULL", "cpt_code"),
    "MISSING_DIAGNOSIS": ("(icd10_code IS NULL OR icd10_code = '')", "icd10_code"),
    "MISSING_AMOUNT": ("claim_amount IS NULL", "claim_amount"),
    "INVALID_NPI": ("NOT (length(provider_npi) = 10 AND regexp_matches(provider_npi, '^[0-9]{10}$'))",
                    "provider_npi"),
    "NEGATIVE_AMOUNT": ("claim_amount < 0.0", "claim_amount"),
    "EXCESSIVE_AMOUNT": ("claim_amount > 100000.0", "claim_amount"),
    "FUTURE_SERVICE_DATE": (f"service_date > {AS_OF}", "service_date"),
    "LATE_SUBMISSION": ("date_diff('day', service_date, submission_date) > 365",
                        "service_date, submission_date"),
    "SUBMISSION_BEFORE_SERVICE": ("submission_date < service_date", "service_date, submission_date"),
    "INVALID_STATUS": ("NOT claim_status IN ('PAID', 'DENIED', 'PENDING')", "claim_status"),
    "INVALID_GENDER": ("NOT patient_gender IN ('M', 'F', 'U')", "patient_gender"),
    "INVALID_ZIP": ("NOT regexp_matches(patient_zip, '^[0-9]{5}(-[0-9]{4})?$')", "patient_zip"),
}


def _w(code: str) -> str:
    return f"WHEN {RULE_SQL[code][0]} THEN '{code};'"


FIRST_MATCH = (
    "concat_ws('', "
    f"CASE {_w('MISSING_MEMBER_ID')} {_w('MISSING_NPI')} {_w('MISSING_CPT')} {_w('MISSING_DIAGNOSIS')} "
    f"{_w('MISSING_AMOUNT')} END, "
    f"CASE {_w('INVALID_NPI')} END, "
    f"CASE {_w('NEGATIVE_AMOUNT')} {_w('EXCESSIVE_AMOUNT')} END, "
    f"CASE {_w('FUTURE_SERVICE_DATE')} {_w('LATE_SUBMISSION')} {_w('SUBMISSION_BEFORE_SERVICE')} END, "
    f"CASE {_w('INVALID_STATUS')} END, CASE {_w('INVALID_GENDER')} END, CASE {_w('INVALID_ZIP')} END)"
)

ALL_MATCH = (
    "concat_ws('', "
    "CASE WHEN member_id IS NULL THEN 'MISSING_MEMBER_ID;' END, "
    "CASE WHEN provider_npi IS NULL THEN 'MISSING_NPI;' END, "
    "CASE WHEN cpt_code IS NULL THEN 'MISSING_CPT;' END, "
    "CASE WHEN icd10_code IS NULL OR icd10_code = '' THEN 'MISSING_DIAGNOSIS;' END, "
    "CASE WHEN claim_amount IS NULL OR isnan(claim_amount) THEN 'MISSING_AMOUNT;' END, "
    "CASE WHEN coalesce(NOT regexp_matches(provider_npi, '^[0-9]{10}$'), true) THEN 'INVALID_NPI;' END, "
    "CASE WHEN claim_amount < 0.0 THEN 'NEGATIVE_AMOUNT;' END, "
    "CASE WHEN claim_amount > 100000.0 AND NOT isnan(claim_amount) THEN 'EXCESSIVE_AMOUNT;' END, "
    f"CASE WHEN service_date > {AS_OF} THEN 'FUTURE_SERVICE_DATE;' END, "
    "CASE WHEN date_diff('day', service_date, submission_date) > 365 THEN 'LATE_SUBMISSION;' END, "
    "CASE WHEN submission_date < service_date THEN 'SUBMISSION_BEFORE_SERVICE;' END, "
    "CASE WHEN coalesce(NOT claim_status IN ('PAID', 'DENIED', 'PENDING'), true) THEN 'INVALID_STATUS;' END, "
    "CASE WHEN coalesce(NOT patient_gender IN ('M', 'F', 'U'), true) THEN 'INVALID_GENDER;' END)"
)

# Fixture F1 after its files were mended (plans/fixtures.py: corrected).
MENDED = f"""f1 AS ({_F1}),
f1_fixed AS (
 SELECT * REPLACE (
  CASE WHEN provider_npi = '12345' THEN '1234567890' ELSE provider_npi END AS provider_npi,
  CASE WHEN CAST(substr(claim_id, 2) AS BIGINT) % 29 = 0 THEN service_date + 31 ELSE service_date END AS service_date,
  CASE WHEN CAST(substr(claim_id, 2) AS BIGINT) % 29 = 0 THEN submission_date + 31 ELSE submission_date END
   AS submission_date) FROM f1),
claims AS (SELECT * FROM f1_fixed
 WHERE source_file <> 'claims/payer_claims_20240105.csv' OR {FIRST_MATCH} = '')"""

FLAGGED = f"""flagged AS (SELECT *, {FIRST_MATCH} AS dq_issues FROM claims),
flagged_all AS (SELECT *, {ALL_MATCH} AS dq_issues FROM claims)"""

def _tiered(*keys: str) -> str:
    """Stats per ``keys``, z-scores and tiers."""
    same = " AND ".join(f"f.{k} = s.{k}" for k in keys)
    return f"""stats AS (
 SELECT {", ".join(keys)}, avg(claim_amount) AS avg_amount, stddev_samp(claim_amount) AS stddev_amount,
        count(*) AS count
 FROM flagged WHERE dq_issues = '' GROUP BY {", ".join(keys)}),
scored AS (
 SELECT f.*, s.avg_amount, s.stddev_amount, s.count,
  CASE WHEN f.dq_issues = '' THEN
   CASE WHEN s.stddev_amount > 0 THEN (f.claim_amount - s.avg_amount) / s.stddev_amount ELSE 0.0 END
  END AS z_score
 FROM flagged f LEFT JOIN stats s ON {same} AND f.dq_issues = ''),
tiered AS (
 SELECT *, coalesce(abs(z_score) > 3.0, false) AS is_statistical_outlier,
  CASE WHEN dq_issues <> '' THEN 'silver' WHEN coalesce(abs(z_score) > 3.0, false) THEN 'quarantine'
       ELSE 'gold' END AS tier
 FROM scored)"""


BASE = f"WITH {CLAIMS},\n{FLAGGED},\n{_tiered('cpt_code')}"
# F1 with every third day's file uploaded again in its mended form.
REUPLOADED = f"""{MENDED.replace("claims AS (", "mended AS (")},
claims AS (SELECT * FROM mended WHERE CAST(substr(source_file, 27, 2) AS INTEGER) % 3 = 0
 UNION ALL SELECT * FROM f1 WHERE CAST(substr(source_file, 27, 2) AS INTEGER) % 3 <> 0)"""
REUPLOADED_BASE = f"WITH {REUPLOADED},\n{FLAGGED},\n{_tiered('source_file', 'cpt_code')}"
PER_FILE_BASE = f"WITH {CLAIMS},\n{FLAGGED},\n{_tiered('source_file', 'cpt_code')}"
MENDED_BASE = f"WITH {MENDED},\n{FLAGGED},\n{_tiered('cpt_code')}"


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * 100.0 ELSE 0.0 END"


def _counts(select: str, group_by: str = "") -> str:
    sel = f"{select}, " if select else ""
    gb = f" GROUP BY {group_by}" if group_by else ""
    return (f"SELECT {sel}count(*) AS total_records, count(*) FILTER (WHERE tier = 'gold') AS gold_records, "
            f"count(*) FILTER (WHERE tier = 'silver') AS silver_records, "
            f"count(*) FILTER (WHERE tier = 'quarantine') AS quarantine_records FROM tiered{gb}")


def _derive(src: str) -> str:
    return (f"SELECT *, silver_records + quarantine_records AS total_anomalies, "
            f"{_ratio('gold_records', 'total_records')} AS data_quality_score, "
            f"{_ratio('silver_records + quarantine_records', 'total_records')} AS anomaly_rate FROM ({src})")


FILE_METRICS = f"file_metrics AS ({_derive(_counts('source_file', 'source_file'))})"
_BY_HOUR = "source_file, date_trunc('hour', ts) AS ts"
HOURLY = f"hourly AS ({_derive(_counts(_BY_HOUR, '1, 2'))})"

FOLDER = ("CASE WHEN contains(source_file, '/') THEN split_part(source_file, '/', 1) || '/' "
          "ELSE source_file END")

HOURLY_FOLDER = (
    "hourly_folder AS (" + _derive(
        f"SELECT {FOLDER} AS source_file, ts, CAST(sum(total_records) AS BIGINT) AS total_records, "
        "CAST(sum(gold_records) AS BIGINT) AS gold_records, "
        "CAST(sum(silver_records) AS BIGINT) AS silver_records, "
        "CAST(sum(quarantine_records) AS BIGINT) AS quarantine_records FROM hourly GROUP BY 1, 2") + ")")


def _points(src: str) -> str:
    parts = []
    for name, col, unit in METRICS:
        parts.append(f"SELECT '{NS}' AS namespace, '{name}' AS metric_name, source_file, ts, "
                     f"CAST({col} AS DOUBLE) AS value, '{unit}' AS unit FROM {src}")
    return " UNION ALL ".join(parts)


POINTS = (f"{HOURLY},\n{HOURLY_FOLDER},\n"
          f"file_points AS ({_points('hourly')}),\nfolder_points AS ({_points('hourly_folder')}),\n"
          "points AS (SELECT * FROM file_points UNION ALL SELECT * FROM folder_points)")

PBASE = f"{BASE},\n{POINTS}"

COSTS = """cost_o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS period_start, sum(o_totalprice) AS price
  FROM orders GROUP BY 1, 2),
cost_bs AS (SELECT o.period_start, coalesce(c.c_mktsegment, 'unknown') AS service, sum(o.price) / 1e6 AS amount
  FROM cost_o o LEFT JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
cost_resp AS (SELECT period_start, sum(amount) AS total, count(*) AS n FROM cost_bs GROUP BY 1),
cost_points AS (
  SELECT '""" + CNS + """' AS namespace, 'DailyCost' AS metric_name,
         'Project=""" + P.project + ",Environment=" + P.environment + """' AS dimension,
         CAST(period_start AS TIMESTAMP) AS ts, total AS value, 'None' AS unit FROM cost_resp
  UNION ALL
  SELECT '""" + CNS + """', 'ServiceCost', 'Project=""" + P.project + """,Service=' || service,
         CAST(period_start AS TIMESTAMP), amount, 'None' FROM cost_bs)"""

CBASE = f"WITH {COSTS}"


def r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


ROUTED = "CASE action " + " ".join(f"WHEN '{a}' THEN '{t}'" for a, t in ACTION_ROUTES) + " END"
_STATUS = f"CAST(CASE WHEN {ROUTED} IS NOT NULL THEN 200 ELSE 400 END AS INTEGER)"
_ERROR = f"CASE WHEN {ROUTED} IS NULL THEN 'Unknown action: ' || coalesce(action, '') END"
_ACTIONS = ", ".join([*[f"'{a}'" for a, _ in ACTION_ROUTES], "'drop_tables'", "''", "NULL"])
# the driver's table, as "events" names a CTE where the alarms are
REQUESTS = (f"requests AS (SELECT 'R' || event_id AS request_id, ([{_ACTIONS}])[event_id % 9 + 1] AS action "
            "FROM main.events)")


def _alarm_sqls(anomaly_threshold: float = 4.0) -> dict[str, str]:
    an = f"{P.project}-anomaly-spike"
    sc = f"{P.project}-dq-score-low"
    co = f"{P.project}-daily-cost-spike"
    ctes = f"""anomaly_pv AS (SELECT date_trunc('hour', ts) AS period_start, sum(value) AS value FROM folder_points
   WHERE namespace = '{NS}' AND metric_name = 'AnomalyCount' AND source_file = 'claims/' GROUP BY 1),
anomaly_al AS (SELECT '{an}' AS alarm_name, period_start, value, 'ALARM' AS state FROM anomaly_pv
   WHERE value > {anomaly_threshold}),
score_pv AS (SELECT date_trunc('hour', ts) AS period_start, avg(value) AS value FROM folder_points
   WHERE namespace = '{NS}' AND metric_name = 'DataQualityScore' AND source_file = 'claims/' GROUP BY 1),
score_br AS (SELECT * FROM score_pv WHERE value < {P.score_threshold}),
score_al AS (SELECT '{sc}' AS alarm_name, period_start, value, 'ALARM' AS state FROM score_br b
   WHERE EXISTS (SELECT 1 FROM score_br p WHERE p.period_start = b.period_start - INTERVAL 1 HOUR)),
{COSTS},
cost_pv AS (SELECT date_trunc('hour', ts) AS period_start, max(value) AS value FROM cost_points
   WHERE namespace = '{CNS}' AND metric_name = 'DailyCost' GROUP BY 1),
cost_al AS (SELECT '{co}' AS alarm_name, period_start, value, 'ALARM' AS state FROM cost_pv
   WHERE value > {P.cost_threshold}),
all_al AS (SELECT * FROM anomaly_al UNION ALL SELECT * FROM score_al UNION ALL SELECT * FROM cost_al),
trans AS (SELECT a.* FROM all_al a WHERE NOT EXISTS (
   SELECT 1 FROM all_al b WHERE b.alarm_name = a.alarm_name
     AND b.period_start = a.period_start - INTERVAL 1 HOUR)),
defs AS (SELECT * FROM (VALUES
   ('{an}', 'anomaly_spike', 'handle_anomaly_spike', 1, 'greater than', CAST({anomaly_threshold} AS DOUBLE)),
   ('{co}', 'cost_spike', 'handle_cost_spike', 1, 'greater than', CAST({P.cost_threshold} AS DOUBLE)))
   AS t(alarm_name, event_type, action, periods, words, threshold)),
events AS (SELECT d.event_type, t.alarm_name, t.state,
   'Threshold Crossed: ' || CAST(d.periods AS VARCHAR) || ' consecutive period(s) were ' || d.words
     || ' the threshold (' || CAST(d.threshold AS VARCHAR) || ').' AS reason,
   t.period_start + INTERVAL 3600 SECOND AS timestamp, d.action, t.value
   FROM trans t JOIN defs d ON t.alarm_name = d.alarm_name)"""
    pre = f"{PBASE},\n{ctes}\n"
    out = "alarm_name, period_start, round(value, 8) AS value, state"
    return {
        "alarm_anomaly": f"{pre}SELECT {out} FROM anomaly_al",
        "alarm_score": f"{pre}SELECT {out} FROM score_al",
        "alarm_cost": f"{pre}SELECT {out} FROM cost_al",
        "alarm_transitions": f"{pre}SELECT {out} FROM trans",
        "alarm_events": f"{pre}SELECT event_type, alarm_name, state, reason, timestamp, action, "
                        f"round(value, 8) AS value FROM events",
        "action_routing": f"{pre}, {REQUESTS}, asked AS (SELECT alarm_name || '@' || "
                          "strftime(timestamp, '%Y%m%d%H') AS request_id, action FROM events "
                          "UNION ALL SELECT request_id, action FROM requests) "
                          f"SELECT request_id, action, {ROUTED} AS routed_action, {_STATUS} AS status_code, "
                          f"{_ERROR} AS error FROM asked",
    }


def _rule_sqls() -> dict[str, str]:
    short = {"MISSING_MEMBER_ID": "missing_member", "FUTURE_SERVICE_DATE": "future_service"}
    return {f"rule_{short.get(code, code.lower())}": f"WITH {CLAIMS} SELECT claim_id, {cols} FROM claims WHERE {pred}"
            for code, (pred, cols) in RULE_SQL.items()}


def _flag_files() -> str:
    return f"flagged_files AS (SELECT DISTINCT source_file FROM file_metrics WHERE data_quality_score < {P.quarantine_score_below})"


def oracle_sql() -> dict[str, str]:
    fm = f"{BASE},\n{FILE_METRICS}"
    clean_based = (f"{BASE},\ncb AS (SELECT source_file, count(*) AS raw_records, "
                   "count(*) FILTER (WHERE dq_issues = '') AS clean_records, "
                   "count(*) FILTER (WHERE dq_issues <> '') AS anomaly_records FROM flagged_all GROUP BY 1)\n")
    wide = ("total_records, gold_records, silver_records, quarantine_records, total_anomalies, "
            "round(data_quality_score, 6) AS data_quality_score, round(anomaly_rate, 6) AS anomaly_rate")
    pcols = "namespace, metric_name, source_file, ts, round(value, 6) AS value, unit"
    null_parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM claims"
        for c in CLAIM_COLS.split(", "))
    fs = (f"{fm},\n{_flag_files()},\nrows_pf AS (SELECT source_file, count(*) AS rows FROM claims GROUP BY 1),\n"
          "fstatus AS (SELECT r.source_file, r.rows, CASE WHEN f.source_file IS NOT NULL THEN 'Quarantined' "
          "ELSE 'Active' END AS status, CASE WHEN f.source_file IS NOT NULL THEN 'quarantine/run/' || r.source_file "
          "END AS quarantine_key FROM rows_pf r LEFT JOIN flagged_files f ON r.source_file = f.source_file)\n")
    band = (f"CASE WHEN data_quality_score < {P.score_band_low} THEN 'below_80' "
            f"WHEN data_quality_score < {P.score_target} THEN '80_to_95' ELSE '95_and_above' END")
    # F4 as its nested text says it: no Total every 7th day, no Groups every
    # 11th, no period every 13th, and a tax of 0.125 in the Total
    parsed = (f"{CBASE},\nnested AS (SELECT period_start AS day, date_diff('day', DATE '1992-01-01', period_start) AS d, "
              "sum(amount) AS total, count(*) AS n, sum(CAST(printf('%.8f', amount) AS DOUBLE)) AS groups_sum, "
              "string_agg(service || '=' || printf('%.8f', amount), ';' ORDER BY service) AS t "
              "FROM cost_bs GROUP BY 1),\n"
              "parsed AS (SELECT day, CASE WHEN d % 13 <> 0 AND d % 7 <> 0 THEN total + 0.125 END AS total, "
              "CASE WHEN d % 13 <> 0 AND d % 11 <> 0 THEN t ELSE '' END AS groups_text, "
              "CASE WHEN d % 13 <> 0 AND d % 11 <> 0 THEN groups_sum ELSE 0.0 END AS service_sum, "
              "CASE WHEN d % 13 <> 0 AND d % 11 <> 0 THEN n ELSE 0 END AS n FROM nested)\n")
    csv_cols = CLAIM_COLS.replace("icd10_code", "nullif(icd10_code, '') AS icd10_code")
    n = "CAST(substr(claim_id, 2) AS BIGINT)"
    first, rest = CLAIM_COLS.split(", ")[:3], CLAIM_COLS.split(", ")[3:]
    cut = {c: f"nullif({c}, '')" if c == "icd10_code" else c for c in rest}
    cut["service_date"] = f"CASE WHEN {n} % 19 <> 0 THEN service_date END"
    cut["claim_amount"] = f"CASE WHEN {n} % 23 <> 0 THEN claim_amount END"
    malformed = ", ".join(first + [f"CASE WHEN {n} % 31 <> 0 THEN {e} END AS {c}" for c, e in cut.items()])
    mended_files = f"{MENDED_BASE},\n{FILE_METRICS}"
    at = "TIMESTAMP '2024-12-03 00:00:00'"
    mended_points = (f"{mended_files},\nhourly AS (SELECT * EXCLUDE (source_file), source_file, {at} AS ts "
                     f"FROM file_metrics),\n{HOURLY_FOLDER}")
    audit = " ".join(f"WHEN '{t}' THEN {body}" for t, body in (
        ("quarantine_data", "(SELECT '{\"status\":\"success\",\"quarantined_count\":' || count(*) || "
                            "',\"quarantined_rows\":' || sum(rows) || '}' FROM fstatus WHERE status = 'Quarantined')"),
        ("restart_job", "'{\"status\":\"success\",\"reprocess\":\"claims/\"}'"),
        ("cost_spike_detected", "'{\"status\":\"success\",\"message\":\"cost spike recorded\"}'")))
    first_points = (f"{fm},\nhourly AS (SELECT * EXCLUDE (source_file), source_file, TIMESTAMP '2024-12-01 00:00:00' AS ts "
                    f"FROM file_metrics),\n{HOURLY_FOLDER}")
    reuploaded = f"{REUPLOADED_BASE} SELECT source_file, {wide} FROM ({_derive(_counts('source_file', 'source_file'))})"
    # the versions of each file and whether each failed: F1, one mended file judged alone, all mended
    alone = "claims/payer_claims_20240103.csv"

    def failing(base: str, where: str = "") -> str:
        return f"({base},\n{FILE_METRICS} SELECT source_file, data_quality_score < {P.quarantine_score_below} AS bad FROM file_metrics{where})"
    only_alone = MENDED_BASE.replace("claims AS (SELECT * FROM f1_fixed\n WHERE ", f"claims AS (SELECT * FROM f1_fixed\n WHERE source_file = '{alone}' AND (") \
        .replace(f"OR {FIRST_MATCH} = '')", f"OR {FIRST_MATCH} = ''))")
    status = f"""WITH all_files AS (SELECT DISTINCT 'claims/payer_claims_' || strftime(ts, '%Y%m%d') || '.csv' AS source_file FROM events),
versions AS (
 SELECT source_file, 'run0' AS version, TIMESTAMP '2024-12-01' AS since, coalesce(bad, false) AS bad
  FROM all_files LEFT JOIN {failing(BASE)} USING (source_file)
 UNION ALL SELECT '{alone}', 'run1', TIMESTAMP '2024-12-02', bool_or(bad) FROM {failing(only_alone)}
 UNION ALL SELECT source_file, 'run2', TIMESTAMP '2024-12-03', coalesce(bad, false)
  FROM all_files LEFT JOIN {failing(MENDED_BASE)} USING (source_file)),
spans AS (SELECT *, lead(since) OVER (PARTITION BY source_file ORDER BY since) AS until FROM versions),
taken AS (SELECT *, CASE WHEN bad THEN CASE WHEN since < TIMESTAMP '2024-12-01 12:00:00' THEN TIMESTAMP '2024-12-01 12:00:00'
  ELSE since + INTERVAL 12 HOUR END END AS at_noon FROM spans),
asked AS (SELECT source_file, unnest(range(TIMESTAMP '2024-11-30 06:00:00', TIMESTAMP '2024-12-04 07:00:00', INTERVAL 12 HOUR)) AS at
  FROM all_files)
SELECT a.source_file, a.at, since AS modified, CASE WHEN version IS NULL THEN NULL WHEN a.at >= at_noon THEN 'Quarantined' ELSE 'Active' END AS status
FROM asked a LEFT JOIN taken t ON a.source_file = t.source_file AND a.at >= since AND (until IS NULL OR a.at < until)"""
    spans = {"hour": 3600, "day": 86400, "30 days": 2592000}
    rollups = " UNION ALL ".join(
        f"SELECT '{level}' AS level, namespace, metric_name, {FOLDER} AS source_file, "
        f"make_timestamp((epoch_us(ts) // {s}000000) * {s}000000) AS period_start, round(sum(value), 6) AS sum, "
        "count(*) AS sample_count, round(min(value), 6) AS minimum, round(max(value), 6) AS maximum, "
        f"round(avg(value), 6) AS average FROM ({_points('hourly')}) GROUP BY 1, 2, 3, 4, 5" for level, s in spans.items())
    q: dict[str, str] = {
        "rollup_after_reruns": f"{mended_points} {rollups}",
        "arrivals_after_reupload": reuploaded,
        "arrivals_from_events": reuploaded,
        "points_as_of": f"{first_points} SELECT {pcols} FROM ({_points('hourly')} UNION ALL {_points('hourly_folder')})",
        "file_status_as_of": status,
        "csv_bad_records": f"WITH {CLAIMS} SELECT claim_id, CAST(CASE WHEN {n} % 31 = 0 THEN 3 ELSE 14 END AS INTEGER) AS fields, "
                           f"true AS placed FROM claims WHERE {n} % 31 = 0 OR {n} % 19 = 0 OR {n} % 23 = 0",
        "csv_scan": f"WITH {CLAIMS} SELECT {csv_cols}, source_file FROM claims",
        "csv_untyped": f"WITH {CLAIMS} SELECT {csv_cols}, source_file FROM claims",
        "csv_malformed": f"WITH {CLAIMS} SELECT {malformed} FROM claims",
        "gold_after_rerun": f"{MENDED_BASE} SELECT {CLAIM_COLS}, source_file, CAST(year(service_date) AS INTEGER) "
                            "AS year, CAST(month(service_date) AS INTEGER) AS month FROM tiered WHERE tier = 'gold'",
        "silver_after_rerun": f"{MENDED_BASE} SELECT claim_id, member_id, provider_id, cpt_code, claim_amount, "
                              "service_date, dq_issues, source_file FROM tiered WHERE tier = 'silver'",
        "quarantine_after_rerun": f"{MENDED_BASE} SELECT claim_id, cpt_code, claim_amount, service_date, "
                                  f"{r('z_score', 'z_score')}, 'STATISTICAL_OUTLIER' AS anomaly_type, source_file "
                                  "FROM tiered WHERE tier = 'quarantine'",
        "points_after_rerun": f"{mended_points} SELECT {pcols} FROM ({_points('hourly')} UNION ALL "
                              f"{_points('hourly_folder')})",
        "quarantine_sink": f"{fm},\n{_flag_files()}\nSELECT claim_id, source_file, 'run1' AS run_id FROM claims WHERE "
                           "source_file IN (SELECT source_file FROM flagged_files) UNION ALL "
                           "SELECT claim_id, source_file, 'run3' FROM claims WHERE "
                           "starts_with(source_file, 'claims/payer_claims_2024010') AND "
                           "source_file NOT IN (SELECT source_file FROM flagged_files)",
        "remediation_audit": f"{fs}, {REQUESTS} SELECT request_id, '2024-01-31T00:00:00' AS timestamp, "
                             f"coalesce(action, '') AS action, coalesce({ROUTED}, 'none') AS routed_action, "
                             f"CASE {ROUTED} {audit} ELSE '{{\"status\":\"error\",\"message\":\"' || {_ERROR} || "
                             f"'\"}}' END AS result, '{P.environment}' AS environment, "
                             f"CAST({_STATUS} AS BIGINT) AS status_code FROM requests",
        "metric_stream_hourly": f"{PBASE} SELECT namespace, metric_name, source_file, ts AS period_start, "
                                "round(avg(value), 6) AS average, round(sum(value), 6) AS sum, round(max(value), 6) AS "
                                "maximum, round(min(value), 6) AS minimum, count(*) AS sample_count FROM file_points "
                                "GROUP BY 1, 2, 3, 4",
        "claims_scan": f"WITH {CLAIMS} SELECT * FROM claims",
        "ingest_metadata": f"WITH {CLAIMS} SELECT claim_id, source_file, {FOLDER} AS folder FROM claims",
    }
    q.update(_rule_sqls())
    q.update({
        "dq_issues_first_match": f"{BASE} SELECT claim_id, dq_issues FROM flagged",
        "dq_issues_all_match": f"{BASE} SELECT claim_id, dq_issues FROM flagged_all",
        "dq_clean": f"{BASE} SELECT {CLAIM_COLS}, source_file FROM flagged WHERE dq_issues = ''",
        "dq_failed": f"{BASE} SELECT claim_id, dq_issues, true AS has_dq_issues, source_file FROM flagged "
                     "WHERE dq_issues <> ''",
        "amount_stats_by_code": f"{BASE} SELECT cpt_code, {r('avg_amount', 'avg_amount')}, "
                                f"{r('stddev_amount', 'stddev_amount')}, count FROM stats",
        "claims_with_stats": f"{BASE} SELECT claim_id, cpt_code, claim_amount, {r('avg_amount', 'avg_amount')}, "
                             f"{r('stddev_amount', 'stddev_amount')}, count FROM tiered WHERE tier <> 'silver'",
        "z_scores": f"{BASE} SELECT claim_id, cpt_code, claim_amount, {r('z_score', 'z_score')} FROM tiered "
                    "WHERE tier <> 'silver'",
        "outlier_flags": f"{BASE} SELECT claim_id, cpt_code, is_statistical_outlier FROM tiered "
                         "WHERE tier <> 'silver'",
        "gold_tier": f"{BASE} SELECT cpt_code, claim_id, member_id, provider_id, provider_npi, icd10_code, "
                     "claim_amount, service_date, submission_date, claim_status, denial_reason, patient_dob, "
                     "patient_zip, patient_gender, source_file, CAST(year(service_date) AS INTEGER) AS year, "
                     "CAST(month(service_date) AS INTEGER) AS month FROM tiered WHERE tier = 'gold'",
        "silver_tier": f"{BASE} SELECT claim_id, member_id, provider_id, cpt_code, claim_amount, service_date, "
                       "dq_issues, source_file FROM tiered WHERE tier = 'silver'",
        "quarantine_tier": f"{BASE} SELECT claim_id, member_id, provider_id, cpt_code, claim_amount, service_date, "
                           f"{r('z_score', 'z_score')}, {r('avg_amount', 'avg_amount')}, "
                           f"{r('stddev_amount', 'stddev_amount')}, 'STATISTICAL_OUTLIER' AS anomaly_type, "
                           "'Z-score: ' || CAST(round(z_score, 4) AS VARCHAR) || ' | Avg: ' || "
                           "CAST(round(avg_amount, 4) AS VARCHAR) || ' | StdDev: ' || "
                           "CAST(round(stddev_amount, 4) AS VARCHAR) AS anomaly_details, source_file "
                           "FROM tiered WHERE tier = 'quarantine'",
        "tier_counts": f"{BASE} SELECT count(*) AS raw_records, count(*) FILTER (WHERE tier <> 'silver') AS "
                       "clean_records, count(*) FILTER (WHERE tier = 'silver') AS failed_records, "
                       "count(*) FILTER (WHERE tier = 'quarantine') AS outlier_records, "
                       "count(*) FILTER (WHERE tier = 'gold') AS gold_records FROM tiered",
        "dq_metrics": f"{BASE} SELECT {wide} FROM ({_derive(_counts(''))})",
        "dq_metrics_clean_based": f"{clean_based}SELECT source_file, raw_records, clean_records, anomaly_records, "
                                  f"round({_ratio('clean_records', 'raw_records')}, 6) AS data_quality_score, "
                                  f"round({_ratio('anomaly_records', 'raw_records')}, 6) AS anomaly_rate FROM cb",
        "metric_points_by_file": f"{PBASE} SELECT {pcols} FROM file_points",
        "metric_points_by_folder": f"{PBASE} SELECT {pcols} FROM folder_points",
        "top_issues": f"{BASE},\nic AS (SELECT source_file, issue, count(*) AS occurrences FROM "
                      "(SELECT source_file, unnest(string_split(dq_issues, ';')) AS issue FROM flagged_all "
                      "WHERE dq_issues <> '') WHERE issue <> '' GROUP BY 1, 2)\n"
                      "SELECT * FROM (SELECT source_file, issue, occurrences, CAST(row_number() OVER "
                      "(PARTITION BY source_file ORDER BY occurrences DESC, issue ASC) AS INTEGER) AS rank FROM ic) "
                      "WHERE rank <= 5",
        "overall_summary": f"{clean_based}SELECT total_clean, total_anomalies, total_raw, "
                           f"round({_ratio('total_clean', 'total_raw')}, 6) AS data_quality_score, "
                           f"round({_ratio('total_anomalies', 'total_raw')}, 6) AS anomaly_rate FROM ("
                           "SELECT CAST(sum(clean_records) AS BIGINT) AS total_clean, "
                           "CAST(sum(anomaly_records) AS BIGINT) AS total_anomalies, "
                           "CAST(sum(clean_records) + sum(anomaly_records) AS BIGINT) AS total_raw FROM cb)",
        "null_rates": f"WITH {CLAIMS} SELECT column_name, round(null_rate, 6) AS null_rate, "
                      f"null_rate > {P.max_null_rate} AS exceeds_threshold FROM ({null_parts})",
        "metrics_json": f"{fm} SELECT source_file, to_json(struct_pack(total_records := total_records, "
                        "gold_records := gold_records, silver_records := silver_records, "
                        "quarantine_records := quarantine_records, total_anomalies := total_anomalies, "
                        "data_quality_score := round(data_quality_score, 4), "
                        "anomaly_rate := round(anomaly_rate, 4), source_file := source_file))::VARCHAR "
                        "AS metrics_json FROM file_metrics",
        "sample_failures": f"{BASE} SELECT claim_id, claim_amount, provider_npi, service_date, dq_issues "
                           "FROM flagged_all WHERE dq_issues <> '' ORDER BY claim_id LIMIT 5",
        "union_failures": f"{BASE} SELECT claim_id, source_file, 'DQ_FAILURE' AS reason_type, dq_issues AS details "
                          "FROM tiered WHERE tier = 'silver' UNION ALL SELECT claim_id, source_file, "
                          "'STATISTICAL_OUTLIER', 'STATISTICAL_OUTLIER' FROM tiered WHERE tier = 'quarantine'",
        "metric_range": f"{PBASE} SELECT {pcols} FROM points WHERE namespace = '{NS}' AND "
                        "metric_name = 'DataQualityScore' AND source_file = 'claims/' AND "
                        "ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'",
        "metric_hourly": f"{PBASE} SELECT namespace, metric_name, source_file, date_trunc('hour', ts) AS period_start, "
                         "round(avg(value), 6) AS average, round(sum(value), 6) AS sum, round(max(value), 6) AS "
                         "maximum, round(min(value), 6) AS minimum, count(*) AS sample_count FROM points "
                         "GROUP BY 1, 2, 3, 4",
        "metric_daily": f"{PBASE} SELECT namespace, metric_name, source_file, date_trunc('day', ts) AS period_start, "
                        "round(avg(value), 6) AS average, round(sum(value), 6) AS sum, round(max(value), 6) AS "
                        "maximum, round(min(value), 6) AS minimum, count(*) AS sample_count FROM points "
                        "GROUP BY 1, 2, 3, 4",
        "tiers_per_file_run": f"{PER_FILE_BASE} SELECT source_file, {wide} FROM "
                              f"({_derive(_counts('source_file', 'source_file'))})",
        "stream_tiers": f"{PER_FILE_BASE} SELECT source_file, {wide} FROM "
                        f"({_derive(_counts('source_file', 'source_file'))})",
        "batch_csv_tiers": f"{fm} SELECT source_file, {wide} FROM file_metrics",
        "metric_latest": f"{PBASE} SELECT namespace, metric_name, source_file, max(ts) AS latest_ts, "
                         "round(arg_max(value, ts), 6) AS latest_value FROM points GROUP BY 1, 2, 3",
        "metric_recent": f"{PBASE} SELECT * FROM (SELECT namespace, metric_name, source_file, ts, "
                         "round(value, 6) AS value, CAST(row_number() OVER (PARTITION BY namespace, metric_name, "
                         "source_file ORDER BY ts DESC) AS INTEGER) AS recency FROM points) WHERE recency <= 3",
        "metric_dimensions": f"{PBASE} SELECT DISTINCT namespace, metric_name, source_file FROM points "
                             "WHERE NOT ends_with(source_file, '/') AND contains(source_file, 'payer_claims')",
        "latest_file_summary": f"{PBASE},\nlp AS (SELECT * FROM points WHERE namespace = '{NS}' AND "
                               "NOT ends_with(source_file, '/') AND contains(source_file, 'payer_claims') AND "
                               "ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'),\n"
                               "lf AS (SELECT source_file FROM lp ORDER BY ts DESC, source_file DESC LIMIT 1),\n"
                               "ph AS (SELECT source_file, metric_name, date_trunc('hour', ts) AS h, max(value) AS v FROM lp WHERE "
                               "source_file IN (SELECT source_file FROM lf) AND metric_name IN ('AnomalyCount', "
                               "'SilverRecords', 'TotalRecords', 'GoldRecords') GROUP BY 1, 2, 3),\n"
                               "pm AS (SELECT source_file, metric_name, arg_max(v, h) AS v FROM ph GROUP BY 1, 2),\n"
                               "s AS (SELECT source_file, "
                               "CAST(coalesce(max(v) FILTER (WHERE metric_name = 'AnomalyCount'), 0.0) AS BIGINT) AS total_anomalies, "
                               "CAST(coalesce(max(v) FILTER (WHERE metric_name = 'SilverRecords'), 0.0) AS BIGINT) AS data_quality_issues, "
                               "CAST(coalesce(max(v) FILTER (WHERE metric_name = 'TotalRecords'), 0.0) AS BIGINT) AS total_records, "
                               "CAST(coalesce(max(v) FILTER (WHERE metric_name = 'GoldRecords'), 0.0) AS BIGINT) AS gold_records "
                               "FROM pm GROUP BY 1)\n"
                               "SELECT source_file, total_anomalies, data_quality_issues, total_records, gold_records, "
                               f"round({_ratio('gold_records', 'total_records')}, 6) AS dq_score FROM s",
        "score_bands": f"{fm} SELECT source_file, round(data_quality_score, 6) AS dq_score, "
                       f"round(data_quality_score - {P.score_target}, 6) AS delta_vs_target, "
                       f"data_quality_score >= {P.score_target} AS meets_target, {band} AS band FROM file_metrics",
        "cost_summary": f"{CBASE},\ndaily AS (SELECT date_trunc('day', ts) AS period_start, max(value) AS maximum "
                        "FROM cost_points WHERE metric_name = 'DailyCost' AND ts >= TIMESTAMP '2001-07-26 00:00:00' "
                        "AND ts < TIMESTAMP '2001-08-02 00:00:00' GROUP BY 1),\n"
                        "s AS (SELECT arg_max(maximum, period_start) AS latest, avg(maximum) AS avg_daily, "
                        "count(*) AS days_with_data FROM daily),\n"
                        f"s2 AS (SELECT coalesce(latest, {P.fallback_daily_cost}) AS cur, "
                        f"coalesce(avg_daily, coalesce(latest, {P.fallback_daily_cost})) AS av, days_with_data FROM s)\n"
                        "SELECT round(cur, 8) AS current_daily_cost, round(av, 8) AS avg_daily_cost, "
                        "round(cur * 30, 8) AS projected_monthly, days_with_data, round(cur - av, 8) AS delta_vs_avg, "
                        f"CASE WHEN cur * 30 < {P.monthly_budget} THEN 'Within budget' ELSE 'Over budget' END "
                        "AS budget_status FROM s2",
        "cost_by_service": f"{CBASE} SELECT period_start, service, round(amount, 8) AS amount FROM cost_bs",
        "cost_daily": f"{parsed} SELECT day AS period_start, coalesce(round(total, 8), 0.0) AS total_cost, "
                      "round(service_sum, 8) AS service_sum, CAST(n AS INTEGER) AS n_services FROM parsed",
        "cost_parse": f"{parsed} SELECT day, day AS period_start, round(total, 8) AS total, groups_text FROM parsed",
        "cost_spike_events": f"{CBASE}, txt AS (SELECT period_start, string_agg(service || '=' || "
                             "printf('%.8f', amount), ';' ORDER BY service) AS t FROM cost_bs GROUP BY 1) "
                             "SELECT 'Cost Spike Detected' AS detail_type, round(total, 8) AS current_cost, "
                             f"CAST({P.cost_threshold} AS DOUBLE) AS threshold, t AS service_breakdown, "
                             "strftime(r.period_start, '%Y-%m-%d') AS date, '2024-01-31T00:00:00' AS timestamp "
                             f"FROM cost_resp r JOIN txt ON r.period_start = txt.period_start "
                             f"WHERE total > {P.cost_threshold}",
        "cost_yesterday": f"{CBASE} SELECT period_start, service, round(amount, 8) AS amount FROM cost_bs "
                          "WHERE period_start >= DATE '2001-08-01' AND period_start < DATE '2001-08-02'",
        "cost_metric_points": f"{CBASE} SELECT namespace, metric_name, dimension, ts, round(value, 8) AS value, unit "
                              "FROM cost_points",
        "cost_status": f"{CBASE},\nbt AS (SELECT period_start, string_agg(service || '=' || printf('%.8f', amount), "
                       "';' ORDER BY service) AS txt FROM cost_bs GROUP BY 1)\n"
                       f"SELECT r.period_start, round(r.total, 8) AS total_cost, CAST({P.cost_threshold} AS DOUBLE) "
                       f"AS threshold, CASE WHEN r.total > {P.cost_threshold} THEN 'high' ELSE 'normal' END AS status, "
                       f"CASE WHEN r.total > {P.cost_threshold} THEN bt.txt END AS breakdown_text "
                       "FROM cost_resp r JOIN bt ON r.period_start = bt.period_start",
        "quarantine_by_file": f"{fm},\n{_flag_files()}\nSELECT claim_id, source_file FROM claims WHERE "
                              "source_file IN (SELECT source_file FROM flagged_files)",
        "retain_by_file": f"{fm},\n{_flag_files()}\nSELECT claim_id, source_file FROM claims WHERE "
                          "source_file NOT IN (SELECT source_file FROM flagged_files)",
        "file_status": f"{fs}SELECT * FROM fstatus",
        "quarantine_summary": f"{fs}SELECT {FOLDER} AS folder, count(*) AS quarantined_count, "
                              "CAST(sum(rows) AS BIGINT) AS quarantined_rows, 'success' AS status FROM fstatus "
                              "WHERE status = 'Quarantined' GROUP BY 1",
    })
    q.update(_alarm_sqls())
    q["z_scores_from_moments"], q["alarm_stream_events"] = q["z_scores"], q["alarm_events"]
    return q

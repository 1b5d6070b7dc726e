"""The SQL each registered query must agree with, row by row."""

from __future__ import annotations

from oracles.checks import MODELS, RAW, Expected
from oracles.parts import STAMP, with_parts

_SQL: dict[str, str] = {}


def _all(name: str, part: str) -> None:
    _SQL[name] = f"SELECT * FROM {part}"


for _name, _part in {
    "mrr_daily": "m_mrr",
    "stg_patients": "t_patients",
    "stg_providers": "t_providers",
    "stg_appointments": "t_appointments",
    "stg_subscriptions": "t_subscriptions",
    "stg_subscription_events": "t_events",
    "stg_touchpoints": "t_touches",
    "stg_encounters": "t_encounters",
    "stg_ehr_patients": "t_clinical_patients",
    "stg_payer_transitions": "t_cover",
    "int_appointments": "m_appointments",
    "int_subscriptions": "m_subscriptions",
    "int_attribution": "m_attribution",
    "payer_periods": "t_periods",
    "payer_periods_gap3": "t_periods_gap3",
    "dim_patients": "m_dim_patients",
    "subscription_history": "m_history",
    "clinical_encounters": "m_clinical",
    "marketing_attribution": "m_marketing",
    "plan_mix": "m_plan_mix",
    "plan_transitions": "m_transitions",
    "bi_mrr_trend": "m_mrr",
    "bi_mkt_detail": "m_marketing",
    "sync_replace": "t_providers",
}.items():
    _all(_name, _part)

_SQL["dim_providers"] = "SELECT provider_id, provider_name, specialty, created_at::DATE AS onboarded_date FROM t_providers"
_SQL["history_as_of"] = """
  SELECT * FROM m_history
  WHERE TIMESTAMP '2024-01-15' >= valid_from AND TIMESTAMP '2024-01-15' < coalesce(valid_to, TIMESTAMP '9000-01-01')"""
_SQL["fct_appointments"] = "SELECT * RENAME (signup_channel AS patient_signup_channel) FROM m_appointments"
_SQL["fct_subscriptions"] = """
  SELECT * EXCLUDE (created_at, updated_at), make_date(year(started_at), month(started_at), 1) AS start_cohort_month
  FROM m_subscriptions"""

# -- dashboards

_SQL["bi_overview"] = """
  SELECT p.*, m.*, a.*, c.*
  FROM (SELECT count(*) AS total_patients FROM customer) p,
       (SELECT active_subscriptions AS active_subs, mrr, arr FROM m_mrr
        WHERE calendar_date = (SELECT max(calendar_date) FROM m_mrr)) m,
       (SELECT avg(is_no_show::INT) AS no_show_rate FROM t_appointments WHERE status <> 'scheduled') a,
       (SELECT sum(total_spend::DECIMAL(18, 2))::DOUBLE / sum(signups) AS blended_cac FROM m_marketing) c"""
_SQL["bi_mrr_headline_trend"] = "SELECT calendar_date, mrr, active_subscriptions FROM m_mrr"
_SQL["bi_sub_stats"] = """
  SELECT sum((status = 'active')::INT)::BIGINT AS active_subs, sum((status = 'cancelled')::INT)::BIGINT AS churned_subs,
         avg((status = 'cancelled')::INT) AS churn_rate,
         sum(CASE status WHEN 'active' THEN mrr_amount END)::BIGINT AS active_mrr
  FROM t_subscriptions"""
_SQL["bi_plan_mix"] = """
  SELECT plan_id, count(*) AS subscriptions, sum(mrr_amount)::BIGINT AS mrr FROM t_subscriptions
  WHERE status = 'active' GROUP BY plan_id"""
_SQL["bi_appt_kpis"] = """
  SELECT count(*) AS total_appointments, avg(is_no_show::INT) AS no_show_rate, avg(is_completed::INT) AS completion_rate,
         sum(lead_time_days)::DOUBLE / count(lead_time_days) AS avg_lead_time_days
  FROM m_appointments WHERE status <> 'scheduled'"""
_SQL["bi_appts_week"] = """
  SELECT appointment_week, count(*) AS appointments, sum(is_no_show::INT)::BIGINT AS no_shows
  FROM m_appointments WHERE status <> 'scheduled' GROUP BY ALL"""
_SQL["bi_noshow_specialty"] = """
  SELECT provider_specialty, count(*) AS appointments, avg(is_no_show::INT) AS no_show_rate
  FROM m_appointments WHERE status <> 'scheduled' AND provider_specialty IS NOT NULL GROUP BY ALL"""
_SQL["bi_appts_type"] = """
  SELECT appointment_month, appointment_type, count(*) AS appointments
  FROM m_appointments WHERE status <> 'scheduled' GROUP BY ALL"""
_SQL["bi_channels"] = "SELECT channel FROM m_marketing GROUP BY channel"
_SQL["bi_mkt_kpis"] = """
  SELECT sum(signups)::BIGINT AS signups, sum(subscribers)::BIGINT AS subscribers,
         sum(total_spend::DECIMAL(18, 2))::DOUBLE AS total_spend,
         sum(total_spend::DECIMAL(18, 2))::DOUBLE / sum(signups) AS blended_cac, sum(active_mrr)::BIGINT AS active_mrr
  FROM m_marketing"""
_BY_CHANNEL = """
  SELECT channel, sum(signups)::BIGINT AS signups, sum(subscribers)::BIGINT AS subscribers,
         sum(total_spend::DECIMAL(18, 2))::DOUBLE AS spend,
         sum(total_spend::DECIMAL(18, 2))::DOUBLE / sum(signups) AS cac_per_signup,
         sum(active_mrr)::BIGINT AS active_mrr
  FROM m_marketing WHERE contains(channel, 'PART') GROUP BY channel"""
_SQL["bi_by_channel"] = _BY_CHANNEL.replace("PART", "")
_SQL["bi_by_channel_like"] = _BY_CHANNEL.replace("PART", "i")
_SQL["bi_enc_kpis"] = """
  SELECT count(*) AS total_encounters, count(DISTINCT patient_id) AS unique_patients,
         round(sum(total_claim_cost), 0)::DOUBLE AS total_costs,
         ((20 * sum(duration_minutes) + count(duration_minutes)) // (2 * count(duration_minutes)))::BIGINT / 10
             AS avg_duration_minutes
  FROM m_clinical"""
_SQL["bi_enc_month"] = """
  SELECT make_date(year(encounter_date), month(encounter_date), 1) AS encounter_month, count(*) AS encounters
  FROM m_clinical GROUP BY ALL"""
_SQL["bi_enc_class"] = """
  SELECT encounter_class, count(*) AS encounters, round(sum(total_claim_cost), 0)::DOUBLE AS total_cost,
         ((2 * (sum(total_claim_cost) * 100)::HUGEINT + 100 * count(*)) // (200 * count(*)))::DOUBLE AS avg_cost
  FROM m_clinical GROUP BY ALL"""
_SQL["bi_enc_demo"] = """
  SELECT age_band, gender, count(*) AS encounters FROM m_clinical WHERE age_band IS NOT NULL GROUP BY ALL"""
_SQL["bi_hist_headline"] = """
  SELECT count(*) AS subscriptions, count_if(n > 1)::BIGINT AS subs_changed, sum(n - 1)::BIGINT AS plan_changes,
         count_if(n > 1)::DOUBLE / count(*) AS pct_changed
  FROM (SELECT subscription_id, count(*) AS n FROM m_plan_sets GROUP BY ALL)"""
_SQL["bi_directions"] = """
  SELECT sum(if(direction = 'upgrade', changes, 0))::BIGINT AS upgrades,
         sum(if(direction = 'downgrade', changes, 0))::BIGINT AS downgrades
  FROM m_transitions"""
_COMPARE = """
  SELECT calendar_date, sum(x.mrr)::BIGINT AS mrr_point_in_time, any_value(d.mrr) AS mrr_current_plan
  FROM m_plan_mix x JOIN m_recent_mrr d USING (calendar_date) GROUP BY calendar_date"""
_SQL["bi_mrr_compare"] = _COMPARE
_SQL["bi_mrr_gap"] = f"""
  SELECT max(abs(mrr_current_plan - mrr_point_in_time)) AS max_gap,
         max(abs(mrr_current_plan - mrr_point_in_time)::DOUBLE / mrr_point_in_time) AS max_gap_pct
  FROM ({_COMPARE})"""
_SQL["bi_busiest"] = """
  SELECT subscription_id, version, plan_id, mrr_amount, valid_from, valid_to, is_current FROM m_history
  WHERE subscription_id IN (SELECT subscription_id FROM m_plan_sets GROUP BY ALL
                            ORDER BY count(*) DESC, subscription_id LIMIT 4)"""

# -- checks

_SQL["check_unique"] = """
  SELECT o_custkey::VARCHAR AS patient_id, count(*) AS occurrences FROM orders GROUP BY ALL HAVING count(*) > 1"""
_SQL["check_unique_combo"] = """
  SELECT o_custkey::VARCHAR AS patient_id, o_orderdate::DATE AS started_at, count(*) AS occurrences
  FROM orders GROUP BY ALL HAVING count(*) > 1"""
_SQL["check_not_null"] = "SELECT event_id::VARCHAR AS touchpoint_id, ts AS event_at FROM events WHERE event_id % 89 = 0"
_SQL["check_accepted"] = """
  SELECT event_type, count(*) AS occurrences FROM t_events WHERE event_type IN ('activated', 'reactivated') GROUP BY ALL"""
_SQL["check_relationship"] = """
  SELECT l_suppkey::VARCHAR AS provider_id, count(*) AS occurrences FROM t_lines
  WHERE NOT EXISTS (FROM t_providers p WHERE p.specialty IS NOT NULL AND p.provider_id = l_suppkey::VARCHAR) GROUP BY ALL"""
_SQL["check_expression"] = "SELECT * FROM t_cover WHERE valid_to < valid_from"
_SQL["check_expression_where"] = """
  SELECT subscription_id, version, valid_from, valid_to FROM m_history WHERE valid_from > valid_to"""
_SQL["check_overlap"] = """
  SELECT a.patient_id, a.payer_period_seq, a.valid_to, b.valid_from AS next_valid_from
  FROM t_periods a JOIN t_periods b ON b.patient_id = a.patient_id AND b.payer_period_seq = a.payer_period_seq + 1
  WHERE b.valid_from < a.valid_to"""
_SQL["check_overlap_subscriptions"] = """
  SELECT patient_id, payer_period_seq, valid_to, next_valid_from
  FROM (SELECT patient_id, cancelled_at AS valid_to,
               rank() OVER by_start AS payer_period_seq, lead(started_at) OVER by_start AS next_valid_from
        FROM t_subscriptions
        WINDOW by_start AS (PARTITION BY patient_id ORDER BY started_at, subscription_id::BIGINT))
  WHERE next_valid_from < valid_to"""
_SQL["check_k_anonymity"] = """
  SELECT age_band, gender, race, ethnicity, state, zip3, count(*) AS k
  FROM t_clinical_patients p WHERE EXISTS (FROM t_encounters e WHERE e.patient_id = p.patient_id)
  GROUP BY ALL HAVING count(*) < 5"""
_SQL["freshness"] = """
  SELECT table_name, newest, floor(epoch(TIMESTAMP '2024-02-01' - newest)) / 3600 AS age_hours,
         CASE WHEN newest < TIMESTAMP '2024-01-29' THEN 'error'
              WHEN newest < TIMESTAMP '2024-01-30 12:00:00' THEN 'warn' ELSE 'pass' END AS status
  FROM (SELECT 'patients' AS table_name, max(updated_at) AS newest FROM t_patients
        UNION ALL SELECT 'appointments', max(updated_at) FROM t_appointments
        UNION ALL SELECT 'subscriptions', max(updated_at) FROM t_subscriptions
        UNION ALL SELECT 'subscription_events', max(ts) FROM events
        UNION ALL SELECT 'marketing_touchpoints', max(ts) FROM events)"""

_SQL["check_banned_columns"] = """
  SELECT * FROM (VALUES ('direct_identifier_present', 'raw', 'synthea_patients_unfiltered', 'ssn'),
                        ('direct_identifier_present', 'raw', 'synthea_patients_unfiltered', 'last'),
                        ('quasi_identifier_in_serving_layer', 'marts', 'dim_clinical_patients', 'zip'))
  AS found(violation, table_schema, table_name, column_name)"""
# The columns of the published files, and the registered names among them.
_LANDED_COLUMNS = """['Id', 'BIRTHDATE', 'DEATHDATE', 'ZIP', 'STATE', 'MARITAL', 'RACE', 'ETHNICITY', 'GENDER',
                  'HEALTHCARE_EXPENSES', 'HEALTHCARE_COVERAGE', 'INCOME']"""
_SQL["artifact_columns"] = f"""
  SELECT artifact, unnest(names) AS column_name, rows FROM (
    SELECT 'synthea_patients' AS artifact, {_LANDED_COLUMNS} AS names, count(*) AS rows FROM t_clinical_raw
    UNION ALL SELECT 'synthea_patients_unfiltered', {_LANDED_COLUMNS} || ['SSN', 'LAST'], count(*) FROM t_clinical_raw
    UNION ALL SELECT 'dim_clinical_patients', ['patient_id', 'ZIP', 'STATE'], count(*) FROM t_clinical_raw
    UNION ALL SELECT 'dim_patients', ['patient_id', 'state', 'gender', 'age_band', 'signup_date', 'signup_cohort_month',
                     'signup_channel', 'first_touch_channel', 'last_touch_channel', 'marketing_touch_count',
                     'acquisition_cost'], count(*) FROM m_dim_patients)"""
_SQL["check_artifacts"] = f"""
  SELECT artifact, lower(column_name) AS column_name, rows FROM ({_SQL["artifact_columns"]})
  WHERE lower(column_name) IN ('birthdate', 'zip', 'ssn', 'last')"""

# -- landing

_SQL["land_text"] = f"""
  SELECT subscription_id, patient_id, upper(plan_id[1]) || plan_id[2:] AS plan_id, mrr_amount::VARCHAR AS mrr_amount,
         upper(status[1]) || status[2:] AS status, started_at::VARCHAR AS started_at,
         cancelled_at::VARCHAR AS cancelled_at, created_at::VARCHAR AS created_at,
         updated_at::VARCHAR AS updated_at, {STAMP} AS _loaded_at
  FROM t_subscriptions"""
_LANDED = """
  SELECT c_custkey::VARCHAR AS "Id", born::VARCHAR AS "BIRTHDATE", died::VARCHAR AS "DEATHDATE", zip AS "ZIP",
         'S' || c_nationkey AS "STATE", marital AS "MARITAL", 'race' || c_custkey % 4 AS "RACE",
         'eth' || c_custkey % 2 AS "ETHNICITY", if(c_custkey % 2 = 0, 'F', 'M') AS "GENDER",
         balance::VARCHAR AS "HEALTHCARE_EXPENSES",
         round(balance * 0.5, 2)::DECIMAL(18, 2)::VARCHAR AS "HEALTHCARE_COVERAGE",
         (c_custkey * 13 % 90000)::VARCHAR AS "INCOME" EXTRA
  FROM t_clinical_raw"""
_SQL["land_glob"] = _LANDED.replace("EXTRA", """, '999-' || c_custkey AS "SSN", c_name AS "LAST" """)
_SQL["land_drop_tier1"] = _LANDED.replace("EXTRA", f", {STAMP} AS _loaded_at")

# What is landed by a second full refresh of the care and clinical exports.
_SQL["land_full_refresh"] = """
  SELECT provider_id, provider_name, specialty, created_at::VARCHAR AS created_at, _loaded_at FROM t_providers"""
_SQL["land_registry"] = _SQL["land_drop_tier1"]

# -- serving views

_SQL["view_patients"] = "SELECT * EXCLUDE (last_touch_channel, marketing_touch_count) FROM m_dim_patients"
_SQL["view_appointments"] = """
  SELECT appointment_id, provider_specialty, patient_state, signup_channel AS patient_signup_channel, appointment_type,
         status, is_completed, is_no_show, is_cancelled, lead_time_days, appointment_date, appointment_week,
         appointment_month
  FROM m_appointments"""
_SQL["view_mrr"] = "SELECT calendar_date, active_subscriptions, mrr, arr, arpu FROM m_mrr"
_SQL["view_marketing"] = """
  SELECT channel, campaign, signups, subscribers, active_subscribers, total_spend, cac_per_signup, cac_per_subscriber,
         active_mrr
  FROM m_marketing"""

# -- syncs

for _name in ("sync_merge", "sync_merge_stored", "stream_merge"):
    _SQL[_name] = "SELECT * EXCLUDE (_loaded_at) FROM t_subscriptions"
_SQL["incremental_appointments"] = """
  SELECT * REPLACE (greatest(created_at, updated_at) AS updated_at) RENAME (signup_channel AS patient_signup_channel)
  FROM m_appointments"""
_SQL["sync_merge_lookback"] = """
  SELECT * EXCLUDE (_loaded_at) FROM t_subscriptions
  WHERE status <> 'paused'
     OR updated_at > (SELECT max(updated_at) FROM t_subscriptions WHERE status <> 'paused') - INTERVAL 300 DAY"""
_SQL["sync_append_recent"] = "SELECT * EXCLUDE (_loaded_at) FROM t_events WHERE event_at > TIMESTAMP '2024-01-25 00:00:00'"
for _name in ("sync_append", "sync_append_stored", "stream_append", "stream_append_lookback"):
    _SQL[_name] = "SELECT * EXCLUDE (_loaded_at) FROM t_events"
_SQL["sync_cursor_state"] = """
  SELECT 'patients' AS table_name, max(updated_at) AS last_value FROM t_patients
  UNION ALL SELECT 'appointments', max(updated_at) FROM t_appointments
  UNION ALL SELECT 'subscriptions', max(updated_at) FROM t_subscriptions
  UNION ALL SELECT 'subscription_events', max(ts) FROM events
  UNION ALL SELECT 'marketing_touchpoints', max(ts) FROM events
  UNION ALL SELECT 'empty', TIMESTAMP '1970-01-01'"""

# What each run saw; a version begins where the run before saw another status or nothing, and ends
# with the first later run that does not see it.
_SQL["snapshot_subscriptions"] = """
  WITH runs(i, day) AS (VALUES (1, DATE '1997-01-01'), (2, DATE '1999-01-01'), (3, DATE '2001-01-01')),
  seen AS (
    SELECT * REPLACE (CASE WHEN cancelled_at >= day THEN 'active' ELSE status END AS status,
                      CASE WHEN cancelled_at < day THEN cancelled_at END AS cancelled_at)
    FROM t_subscriptions, runs WHERE started_at < day AND (cancelled_at IS NULL OR cancelled_at >= day - 365))
  SELECT subscription_id, patient_id, plan_id, mrr_amount, status, started_at, cancelled_at, day::TIMESTAMP AS valid_from,
         (SELECT min(r.day) FROM runs r WHERE r.i > s.i
            AND (s.subscription_id, r.i, s.status) NOT IN (SELECT (subscription_id, i, status) FROM seen))::TIMESTAMP
           AS valid_to,
         md5(subscription_id || '-' || day::TIMESTAMP) AS version_id
  FROM seen s ANTI JOIN (SELECT subscription_id, i + 1 AS i, status FROM seen) USING (subscription_id, i, status)"""
_SQL["snapshot_stored"] = _SQL["snapshot_subscriptions"]


# -- declared checks: failures counted one check at a time

_CHECKED = {
    "stg_patients": "t_patients",
    "stg_providers": "t_providers",
    "stg_appointments": "t_appointments",
    "stg_subscriptions": "t_subscriptions",
    "stg_subscription_events": "t_events",
    "stg_marketing_touchpoints": "t_touches",
    "stg_ehr__patients": "t_clinical_patients",
    "stg_ehr__encounters": "t_encounters",
    "stg_ehr__payer_transitions": "t_cover",
    "int_ehr__payer_periods_folded": "t_periods",
    "mart_clinical_encounters": "m_clinical",
    "dim_patients": "m_dim_patients",
    "dim_providers": "t_providers",
    "fct_appointments": "m_appointments",
    "fct_mrr_daily": "m_mrr",
    "fct_subscriptions": "m_subscriptions",
    "mart_marketing_attribution": "m_marketing",
    "dim_subscription_history": "m_history",
    "raw.patients": "t_patients",
    "raw.providers": "t_providers",
    "raw.appointments": "t_appointments",
    "raw.subscriptions": "t_subscriptions",
    "raw.subscription_events": "t_events",
    "raw.marketing_touchpoints": "t_touches",
    "raw.synthea_patients": """(SELECT patient_id AS "Id" FROM t_clinical_patients)""",
    "raw.synthea_encounters": """(SELECT encounter_id AS "Id", patient_id AS "PATIENT" FROM t_encounters)""",
    "raw.synthea_payer_transitions": """(SELECT patient_id AS "PATIENT" FROM t_cover)""",
}


def _check_sql(table: str, check: Expected) -> str:
    source, columns = _CHECKED[table], ", ".join(check.columns)
    if check.kind == "not_null":
        failures = f"SELECT count(*) - count({columns}) FROM {source}"
    elif check.kind == "accepted_values":
        failures = f"SELECT count(*) FROM {source} WHERE NOT list_contains({list(check.accepted)}, {columns})"
    elif check.kind == "expression":
        failures = f"SELECT count(*) FROM {source} WHERE {check.where} AND ({check.expression}) IS FALSE"
    elif check.kind == "relationship":
        parent = f"(SELECT {check.parent_column} AS up FROM {_CHECKED[check.parent]})"
        failures = f"SELECT count(*) FROM {source} LEFT JOIN {parent} ON up = {columns} WHERE up IS NULL AND {columns} IS NOT NULL"
    else:
        known = f"WHERE {columns} IS NOT NULL" if check.kind == "unique" else ""
        failures = f"SELECT count(*) FROM (SELECT 1 FROM {source} {known} GROUP BY {columns} HAVING count(*) > 1)"
    label, severity = check.label.replace("'", "''"), check.severity
    return f"SELECT '{table}' AS table_name, '{label}' AS check_name, '{severity}' AS severity, ({failures}) AS failures"


for _name, _checks in {"check_suite": MODELS, "check_suite_raw": RAW}.items():
    _each = "\n  UNION ALL ".join(_check_sql(check.table, check) for check in _checks)
    _SQL[_name] = f"SELECT *, if(failures = 0, 'pass', severity) AS status FROM (\n  {_each})"


def oracle_sql() -> dict[str, str]:
    queries = {}
    for name, sql in _SQL.items():
        text = with_parts(sql)
        # Queries with blocks of their own join the shared list of blocks.
        queries[name] = text.replace("\nWITH runs", ",\nruns", 1) if sql.strip().startswith("WITH") else text
    return queries

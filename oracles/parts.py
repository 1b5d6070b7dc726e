"""Named SQL building blocks over the test tables, for DuckDB.

``with_parts(sql)`` prefixes a query with the blocks it mentions, in order.
"""

from __future__ import annotations

import re

STAMP = "TIMESTAMP '2024-02-01 00:00:00'"

PARTS: dict[str, str] = {}

PARTS["t_patients"] = f"""
  SELECT c_custkey::VARCHAR AS patient_id, 'anon_' || c_custkey AS anonymous_id,
         lower(replace(c_name, '#', '.') || '@' || c_mktsegment) || '.example' AS email,
         'Given' AS first_name, c_name AS last_name,
         DATE '1935-01-01' + (c_custkey * 37 % 25000)::INT AS date_of_birth,
         lower(c_mktsegment) || '.example' AS email_domain,
         2024 - year(DATE '1935-01-01' + (c_custkey * 37 % 25000)::INT) AS age,
         (['female', 'male', 'nonbinary', 'undisclosed'])[c_custkey % 4 + 1] AS gender,
         n_name AS state, lower(c_mktsegment) AS signup_channel,
         (DATE '2024-01-01' + (c_custkey % 30)::INT)::TIMESTAMP AS signed_up_at,
         (DATE '2024-01-01' + (c_custkey % 30)::INT)::TIMESTAMP AS updated_at,
         {STAMP} AS _loaded_at
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""

PARTS["t_providers"] = f"""
  SELECT s_suppkey::VARCHAR AS provider_id, s_name AS provider_name,
         (['Primary Care', 'Behavioral Health', 'Dermatology', 'Endocrinology'])[s_suppkey % 5 + 1] AS specialty,
         (DATE '2024-01-01' + (s_suppkey % 30)::INT)::TIMESTAMP AS created_at, {STAMP} AS _loaded_at
  FROM supplier"""

PARTS["t_lines"] = """
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE) AS line_id, *
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

PARTS["t_appointments"] = f"""
  SELECT *, status = 'completed' AS is_completed, status = 'no_show' AS is_no_show,
         status = 'cancelled' AS is_cancelled, {STAMP} AS _loaded_at
  FROM (SELECT line_id AS appointment_id, o_custkey::VARCHAR AS patient_id, l_suppkey::VARCHAR AS provider_id,
               (['video', 'phone', 'message'])[l_linenumber % 3 + 1] AS appointment_type,
               CASE WHEN o_orderstatus = 'P' THEN 'scheduled'
                    ELSE map {{'A': 'completed', 'N': 'no_show', 'R': 'cancelled'}}[l_returnflag] END AS status,
               l_shipdate + to_hours((l_partkey % 24)::INT) AS scheduled_at,
               o_orderdate + to_hours((l_orderkey % 24)::INT) AS created_at,
               l_shipdate + to_hours((l_partkey % 24)::INT) AS updated_at
        FROM t_lines)"""

_SUBSCRIPTIONS = f"""
  SELECT subscription_id, patient_id, plan_id,
         map {{'basic': 49, 'plus': 99, 'premium': 199}}[plan_id]::INT AS mrr_amount,
         map {{'F': 'cancelled', 'O': 'active', 'P': 'paused'}}[st] AS status, started_at,
         CASE st WHEN 'F' THEN started_at + days END AS cancelled_at, started_at::TIMESTAMP AS created_at,
         (started_at + CASE st WHEN 'F' THEN days ELSE 0 END)::TIMESTAMP AS updated_at, {STAMP} AS _loaded_at
  FROM (SELECT o_orderkey::VARCHAR AS subscription_id, o_custkey::VARCHAR AS patient_id, o_orderstatus AS st,
               (['premium', 'premium', 'plus', 'basic', 'basic'])[o_orderpriority[1]::INT] AS plan_id,
               STARTED AS started_at, (o_orderkey % 400)::INT AS days
        FROM orders)"""
PARTS["t_subscriptions"] = _SUBSCRIPTIONS.replace("STARTED", "o_orderdate::DATE")
PARTS["t_recent_subscriptions"] = _SUBSCRIPTIONS.replace("STARTED", "DATE '2024-01-01' + (o_orderkey % 30)::INT")

PARTS["t_events"] = f"""
  SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS subscription_id,
         CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'plan_changed'
                         WHEN 'view' THEN 'activated' WHEN 'click' THEN 'reactivated'
                         ELSE if(user_id % 4 = 0, 'cancelled', 'activated') END AS event_type,
         NULL::VARCHAR AS from_plan,
         CASE WHEN event_type IN ('signup', 'purchase')
              THEN (['Basic', 'Plus', 'Premium'])[event_id % 3 + 1] END AS to_plan,
         (event_id % 3 * 50)::INT AS mrr_delta, ts AS event_at, {STAMP} AS _loaded_at
  FROM events"""

PARTS["t_touches"] = f"""
  SELECT event_id::VARCHAR AS touchpoint_id, 'anon_' || user_id AS anonymous_id,
         CASE event_type WHEN 'signup' THEN user_id::VARCHAR END AS patient_id,
         CASE WHEN event_id % 89 <> 0 THEN event_type END AS channel,
         'medium' || event_id % 3 AS utm_medium, 'c' || event_id % 5 AS campaign,
         event_type, value AS cost, ts AS event_at, {STAMP} AS _loaded_at
  FROM events"""

PARTS["t_clinical_raw"] = """
  SELECT *, DATE '1935-01-01' + (c_custkey * 37 % 25000)::INT AS born,
         CASE WHEN c_custkey % 9 = 0 THEN DATE '1935-01-01' + (c_custkey * 37 % 25000)::INT + 20000 END AS died,
         lpad((c_custkey * 7 % 100000)::VARCHAR, 5, '0') AS zip, c_acctbal::DECIMAL(18, 2) AS balance,
         CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'S' END AS marital
  FROM customer"""

PARTS["t_clinical_patients"] = """
  SELECT c_custkey::VARCHAR AS patient_id, year(born) AS birth_year, year(died) AS death_year,
         died IS NOT NULL AS is_deceased,
         (SELECT max_by(label, floor) FROM (VALUES (0, '0-17'), (18, '18-34'), (35, '35-49'), (50, '50-64'),
             (65, '65-74'), (75, '75-89'), (90, '90+')) AS bands(floor, label)
          WHERE floor <= coalesce(year(died), 2002) - year(born)) AS age_band,
         -- fixed values: postal prefixes of sparse areas
         CASE WHEN zip[:3] IN ('036', '059', '063', '102', '203', '556', '692', '790', '821', '823', '830', '831',
                               '878', '879', '884', '890', '893') THEN '000' ELSE zip[:3] END AS zip3,
         'S' || c_nationkey AS state, marital AS marital_status, 'race' || c_custkey % 4 AS race,
         'eth' || c_custkey % 2 AS ethnicity, if(c_custkey % 2 = 0, 'F', 'M') AS gender,
         balance AS lifetime_healthcare_expenses,
         round(balance * 0.5, 2)::DECIMAL(18, 2) AS lifetime_healthcare_coverage,
         (c_custkey * 13 % 90000)::DECIMAL(18, 2) AS annual_income
  FROM t_clinical_raw"""

PARTS["t_encounters"] = """
  SELECT encounter_id, patient_id, organization_id, provider_id, encounter_payer_id, started_at, stopped_at,
         started_at::DATE AS encounter_date,
         (epoch(date_trunc('minute', stopped_at)) - epoch(date_trunc('minute', started_at)))::BIGINT // 60
             AS duration_minutes,
         encounter_class, encounter_class = 'virtual' AS is_virtual, 'code' || k AS encounter_code,
         'visit ' || k AS encounter_description, reason_code, reason_description,
         cost AS base_encounter_cost, claim AS total_claim_cost, covered AS payer_coverage,
         claim - covered AS patient_responsibility
  FROM (SELECT line_id AS encounter_id, o_custkey::VARCHAR AS patient_id, 'org' || l_suppkey % 10 AS organization_id,
               l_suppkey::VARCHAR AS provider_id, CASE WHEN l_partkey % 11 <> 0 THEN o_orderstatus END AS encounter_payer_id,
               l_shipdate + to_seconds(l_partkey * 61 % 86400) AS started_at,
               l_shipdate + to_seconds(l_partkey * 61 % 86400 + (l_quantity * 97)::BIGINT) AS stopped_at,
               CASE WHEN l_partkey % 97 = 0 THEN 'virtual' ELSE lower(l_returnflag || l_linestatus) END AS encounter_class,
               l_partkey % 50 AS k,
               CASE WHEN l_partkey % 3 = 0 THEN 'r' || l_partkey % 20 END AS reason_code,
               CASE WHEN l_partkey % 3 = 0 THEN 'reason ' || l_partkey % 20 END AS reason_description,
               l_extendedprice::DECIMAL(18, 2) AS cost,
               (l_extendedprice::DECIMAL(18, 2) * 1.1::DECIMAL(2, 1))::DECIMAL(18, 2) AS claim,
               (l_extendedprice::DECIMAL(18, 2) * l_discount::DECIMAL(4, 2))::DECIMAL(18, 2) AS covered
        FROM t_lines)"""

PARTS["t_cover"] = """
  SELECT patient_id, payer AS payer_id, NULL::VARCHAR AS secondary_payer_id, 'M' || key % 3 AS member_id,
         if(key % 2 = 0, 'Self', 'Guardian') AS plan_ownership, starts AS valid_from, ends AS valid_to,
         coalesce(ends < starts, false) AS is_invalid_interval
  FROM (SELECT *, lead(starts) OVER (PARTITION BY patient_id ORDER BY starts) - if(key % 7 = 0, 3, 0) AS ends
        FROM (SELECT o_custkey::VARCHAR AS patient_id, o_orderdate::DATE AS starts, min(o_orderkey) AS key,
                     min_by(o_orderstatus, o_orderkey) AS payer
              FROM orders GROUP BY ALL))"""

# Folding by the rows that open a period: every row belongs to the last opening at or before it.
_PERIODS = """
  SELECT md5(patient_id || '-' || seq) AS payer_period_key, patient_id, seq AS payer_period_seq,
         any_value(payer_id) AS payer_id, first(member_id ORDER BY valid_from) AS first_member_id,
         last(member_id ORDER BY valid_from) AS last_member_id,
         count(DISTINCT member_id) AS distinct_member_ids, min(member_id) <> max(member_id) AS member_id_was_reissued,
         min(valid_from) AS valid_from,
         if(bool_or(valid_to IS NULL), NULL, nullif(max(valid_to), DATE '9999-12-31')) AS valid_to,
         if(bool_or(valid_to IS NULL), NULL, nullif(max(valid_to), DATE '9999-12-31') - min(valid_from)) AS coverage_days,
         count(*) AS source_row_count, seq = openings AS is_current_period
  FROM (SELECT usable.*, opening.seq, opening.openings
        FROM (SELECT * FROM t_cover WHERE NOT is_invalid_interval) usable
        ASOF JOIN (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY valid_from) AS seq,
                          count(*) OVER (PARTITION BY patient_id) AS openings
                   FROM (SELECT patient_id, valid_from FROM t_cover WHERE NOT is_invalid_interval
                         WINDOW w AS (PARTITION BY patient_id ORDER BY valid_from)
                         QUALIFY coalesce(payer_id <> lag(payer_id) OVER w OR valid_from - lag(valid_to) OVER w > GAP,
                                          true))) opening
        ON usable.patient_id = opening.patient_id AND usable.valid_from >= opening.valid_from)
  GROUP BY patient_id, seq, openings"""
PARTS["t_periods"] = _PERIODS.replace("GAP", "0")
PARTS["t_periods_gap3"] = _PERIODS.replace("GAP", "3")

PARTS["m_appointments"] = """
  SELECT appointment_id, patient_id, provider_id,
         (SELECT any_value(specialty) FROM t_providers p WHERE p.provider_id = a.provider_id) AS provider_specialty,
         state AS patient_state, signup_channel, appointment_type, status, is_completed, is_no_show, is_cancelled,
         scheduled_at, scheduled_at::DATE AS appointment_date,
         (scheduled_at::DATE - (isodow(scheduled_at) - 1)::INT)::TIMESTAMP AS appointment_week,
         (scheduled_at::DATE - (day(scheduled_at) - 1)::INT)::TIMESTAMP AS appointment_month,
         scheduled_at::DATE - created_at::DATE AS lead_time_days, created_at, a.updated_at
  FROM t_appointments a LEFT JOIN (SELECT patient_id, state, signup_channel FROM t_patients) USING (patient_id)"""

PARTS["m_subscriptions"] = """
  SELECT subscription_id, patient_id, plan_id, mrr_amount, status, status = 'active' AS is_active, started_at,
         cancelled_at,
         (SELECT count(*) FROM t_events e
          WHERE e.subscription_id = s.subscription_id AND e.event_type = 'plan_changed') AS plan_change_count,
         coalesce(cancelled_at, DATE '2002-06-30') - started_at AS tenure_days, created_at, updated_at
  FROM t_subscriptions s"""

PARTS["m_attribution"] = """
  SELECT patient_id, count(*) AS touch_count, sum(cost::DECIMAL(18, 6))::DECIMAL(18, 2)::DOUBLE AS total_marketing_cost,
         min(event_at) AS first_touch_at, max(event_at) AS last_touch_at,
         (list(channel ORDER BY event_at))[1] AS first_touch_channel,
         (list(campaign ORDER BY event_at))[1] AS first_touch_campaign,
         (list(channel ORDER BY event_at DESC))[1] AS last_touch_channel,
         (list(campaign ORDER BY event_at DESC))[1] AS last_touch_campaign
  FROM (SELECT coalesce(t.patient_id, p.patient_id) AS patient_id, t.* EXCLUDE (patient_id)
        FROM t_touches t LEFT JOIN t_patients p USING (anonymous_id))
  WHERE patient_id IS NOT NULL GROUP BY patient_id"""

PARTS["m_dim_patients"] = """
  SELECT patient_id, state, gender,
         -- Fixed values: the bands and their labels.
         CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
              WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_band,
         signed_up_at::DATE AS signup_date,
         make_date(year(signed_up_at), month(signed_up_at), 1)::TIMESTAMP AS signup_cohort_month, signup_channel,
         first_touch_channel, last_touch_channel, coalesce(touch_count, 0) AS marketing_touch_count,
         coalesce(total_marketing_cost, 0) AS acquisition_cost
  FROM t_patients LEFT JOIN m_attribution USING (patient_id)"""

# Brute force: one row per subscription and active day. An exact half rounds up.
_MRR = """
  SELECT d::DATE AS calendar_date, count(day) AS active_subscriptions, coalesce(sum(mrr_amount), 0)::BIGINT AS mrr,
         12.0::DOUBLE * coalesce(sum(mrr_amount), 0) AS arr,
         coalesce((200 * sum(mrr_amount) + count(day)) // (2 * count(day)), 0)::BIGINT / 100 AS arpu
  FROM range(DATE 'FIRST', (SELECT max(started_at) + 1 FROM SUBSCRIPTIONS), INTERVAL 1 DAY) AS days(d)
  LEFT JOIN (SELECT unnest(range(started_at, coalesce(cancelled_at, DATE 'TODAY' + 1), INTERVAL 1 DAY)) AS day,
                    mrr_amount
             FROM SUBSCRIPTIONS) ON day = d
  GROUP BY d"""
PARTS["m_mrr"] = (
    _MRR.replace("FIRST", "1995-01-01").replace("TODAY", "2002-06-30").replace("SUBSCRIPTIONS", "t_subscriptions")
)
PARTS["m_recent_mrr"] = (
    _MRR.replace("FIRST", "2023-12-25")
    .replace("TODAY", "2024-02-01")
    .replace("SUBSCRIPTIONS", "t_recent_subscriptions")
)

PARTS["m_plan_sets"] = """
  SELECT subscription_id, lower(to_plan) AS plan_id, event_at FROM t_events
  WHERE to_plan <> '' AND event_type IN ('created', 'plan_changed')"""

# Version, end and current flag by looking up the later and earlier events of each one.
PARTS["m_history"] = """
  SELECT s.subscription_id, o_custkey::VARCHAR AS patient_id, plan_id,
         map {'basic': 49, 'plus': 99, 'premium': 199}[plan_id]::INT AS mrr_amount,
         (SELECT count(*) FROM m_plan_sets e WHERE e.subscription_id = s.subscription_id AND e.event_at <= s.event_at)
             AS version,
         event_at AS valid_from, coalesce(later, closed) AS valid_to, coalesce(later, closed) IS NULL AS is_current
  FROM (SELECT *, (SELECT min(e.event_at) FROM m_plan_sets e
                   WHERE e.subscription_id = m_plan_sets.subscription_id AND e.event_at > m_plan_sets.event_at) AS later
        FROM m_plan_sets) s
  LEFT JOIN (SELECT subscription_id, min(event_at) AS closed FROM t_events WHERE event_type = 'cancelled'
             GROUP BY ALL) USING (subscription_id)
  LEFT JOIN orders ON o_orderkey::VARCHAR = s.subscription_id"""

# Brute force: one row per version and day.
PARTS["m_plan_mix"] = """
  SELECT day::DATE AS calendar_date, plan_id, count(*) AS subscriptions, sum(mrr_amount)::BIGINT AS mrr
  FROM (SELECT *, unnest(range(valid_from::DATE, coalesce(valid_to::DATE, reach + 1), INTERVAL 1 DAY)) AS day
        FROM m_history, (SELECT max(coalesce(valid_to, valid_from))::DATE AS reach FROM m_history))
  WHERE day <= reach AND day IN (SELECT calendar_date FROM m_recent_mrr)
  GROUP BY day, plan_id"""

PARTS["m_transitions"] = """
  SELECT a.plan_id || ' -> ' || b.plan_id AS transition,
         if(b.mrr_amount > a.mrr_amount, 'upgrade', 'downgrade') AS direction, count(*) AS changes
  FROM m_history a JOIN m_history b ON b.subscription_id = a.subscription_id AND b.version = a.version + 1
  GROUP BY ALL"""

PARTS["m_marketing"] = """
  SELECT first_touch_channel AS channel, first_touch_campaign AS campaign, count(*) AS signups,
         count(s.patient_id) AS subscribers, count_if(is_active)::BIGINT AS active_subscribers, spend::DOUBLE AS total_spend,
         round_half(spend, count(*)) AS cac_per_signup,
         round_half(spend, count(s.patient_id)) AS cac_per_subscriber,
         sum(CASE WHEN is_active THEN mrr_amount END)::BIGINT AS active_mrr
  FROM m_attribution a LEFT JOIN m_subscriptions s USING (patient_id)
  WHERE first_touch_channel IS NOT NULL GROUP BY ALL"""
# Cents per head, an exact half rounded up, in whole numbers.
_CENTS = "sum(total_marketing_cost::DECIMAL(18, 2) * 100)::HUGEINT"
PARTS["m_marketing"] = re.sub(
    r"round_half\(spend, (count\([^)]*\))\)",
    rf"((2 * {_CENTS} + \1) // nullif(2 * \1, 0))::BIGINT / 100",
    PARTS["m_marketing"],
).replace("spend::DOUBLE", "sum(total_marketing_cost::DECIMAL(18, 2))::DOUBLE")

PARTS["m_clinical"] = """
  SELECT encounter_id, e.patient_id, encounter_date, started_at, stopped_at, duration_minutes, encounter_class,
         is_virtual, encounter_code, encounter_description, reason_code, reason_description, age_band, gender, race,
         ethnicity, marital_status, state, zip3, encounter_payer_id, payer_id AS coverage_payer_id, payer_period_key,
         coalesce(encounter_payer_id, '-') <> coalesce(payer_id, '-') AS has_payer_mismatch,
         payer_period_key IS NULL AS has_no_coverage_period, base_encounter_cost, total_claim_cost, payer_coverage,
         patient_responsibility
  FROM t_encounters e
  LEFT JOIN t_clinical_patients p USING (patient_id)
  LEFT JOIN (SELECT patient_id, payer_id, payer_period_key, valid_from, coalesce(valid_to, DATE '9000-01-01') AS ended
             FROM t_periods) c
    ON c.patient_id = e.patient_id AND encounter_date >= valid_from AND encounter_date < ended"""


def with_parts(sql: str) -> str:
    needed: set[str] = set()
    todo = [sql]
    while todo:
        for name in re.findall(r"\b[tm]_[a-z_0-9]+\b", todo.pop()):
            if name in PARTS and name not in needed:
                needed.add(name)
                todo.append(PARTS[name])
    ordered = [name for name in PARTS if name in needed]
    if not ordered:
        return sql.strip()
    blocks = ",\n".join(f"{name} AS MATERIALIZED ({PARTS[name]})" for name in ordered)
    return f"WITH {blocks}\n{sql.strip()}"

"""DuckDB texts that recompute the registered queries from the raw tables.

They share only the input tables with the library. Each text is written independently of
the Spark code and kept plain: no text here is meant to be fast.
"""

from __future__ import annotations

import re

from tallyforge.plans.inputs import INPUTS, duckdb_text

STAMP = "TIMESTAMP '2024-02-01 00:00:00'"


def r(x: str, places: int = 2) -> str:
    """Round half up, after the same settling of float noise as in the library."""
    return f"cast(round(cast({x} AS decimal(38,8)), {places}) AS double)"


def pct(part: str, whole: str, places: int = 2) -> str:
    return r(f"(cast({part} AS double) * 100e0 / nullif(cast({whole} AS double), 0))", places)


def big(x: str) -> str:
    return f"cast({x} AS bigint)"


def with_inputs(text: str) -> str:
    """Prefix the input tables that the text mentions."""
    used = [name for name in INPUTS if re.search(rf"\b{name}\b", text)]
    if not used:
        return text
    ctes = ", ".join(f"{name} AS ({duckdb_text(name)})" for name in used)
    body = text.strip()
    if body.lower().startswith("with "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


# --- fraud -----------------------------------------------------------------------------

AMT = "transaction_amount"
AGE = """CASE WHEN customer_age >= 18 AND customer_age < 26 THEN '18-25' WHEN customer_age >= 26 AND customer_age < 36
 THEN '26-35' WHEN customer_age >= 36 AND customer_age < 51 THEN '36-50' WHEN customer_age >= 51 AND customer_age < 66
 THEN '51-65' ELSE '65+' END"""
HIT = big("count(*) FILTER (is_fraud = 1)")


def fraud_rates(label: str, name: str, second: tuple[str, str] | None = None) -> str:
    extra = f", {second[0]} AS {second[1]}" if second else ""
    return f"""SELECT {label} AS {name}{extra}, count(*) AS txn_count, {HIT} AS fraud_count,
      {pct(HIT, 'count(*)')} AS fraud_rate FROM bank_txn GROUP BY ALL"""


PROFILE_COLUMNS = (
    "transaction_id customer_id transaction_date transaction_ts hour_of_day country city merchant_category "
    "payment_method device_type customer_age credit_score transaction_amount is_fraud fraud_type"
).split()

ALERTS = f"""SELECT * FROM (
  SELECT transaction_id, customer_id, {AMT}, country, merchant_category, failed_attempts, credit_score,
    is_international, is_night_transaction, is_fraud,
    CASE WHEN {AMT} > m + 3 * s THEN 'High Amount Anomaly'
         WHEN failed_attempts > 3 THEN 'Multiple Failed Attempts'
         WHEN is_international = 1 AND is_night_transaction = 1 AND failed_attempts > 2 THEN 'International Night Fraud'
         WHEN is_international = 1 AND credit_score < 600 AND {AMT} > m THEN 'High Risk International'
    END AS alert_type
  FROM bank_txn, (SELECT avg({AMT}) AS m, stddev_samp({AMT}) AS s FROM bank_txn)) WHERE alert_type IS NOT NULL"""

SPENT = f"SELECT customer_id, round(sum({AMT}), 6) AS spent FROM bank_txn GROUP BY 1"


def fraud() -> dict[str, str]:
    shares = " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, {d} AS value, count(*) AS txn_count,
        {pct('count(*)', '(SELECT count(*) FROM bank_txn)')} AS percentage FROM bank_txn GROUP BY {d}"""
        for d in ("payment_method", "device_type", "merchant_category")
    )
    profile = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values,
        count(*) - count({c}) AS null_count FROM bank_txn""" for c in PROFILE_COLUMNS
    )
    return {
        "fraud_overview": f"""SELECT count(*) AS total_transactions, count(DISTINCT customer_id) AS total_customers,
          {HIT} AS total_fraud_transactions, {pct(HIT, 'count(*)')} AS fraud_percentage FROM bank_txn""",
        "top_countries": """SELECT country, count(*) AS transaction_count FROM bank_txn GROUP BY country
          ORDER BY 2 DESC, 1 LIMIT 10""",
        "top_cities": f"SELECT city, {r(f'sum({AMT})')} AS total_value FROM bank_txn GROUP BY city ORDER BY 2 DESC, 1 LIMIT 10",
        "profile_columns": profile,
        "dimension_shares": shares,
        "top_customers": f"""SELECT customer_id, {r(f'sum({AMT})')} AS total_amount, count(*) AS txn_count
          FROM bank_txn GROUP BY customer_id ORDER BY 2 DESC, 1 LIMIT 20""",
        "amount_by_age": f"""SELECT {AGE} AS age_group, count(*) AS txn_count, {r(f'avg({AMT})')} AS avg_amount
          FROM bank_txn GROUP BY 1""",
        "fraud_by_age": fraud_rates(AGE, "age_group"),
        "dormant_accounts": f"""SELECT customer_id, {r('b')} AS avg_balance, n AS txn_count, {r('f')} AS avg_monthly_freq
          FROM (SELECT customer_id, avg(account_balance) AS b, avg(transaction_freq_monthly) AS f, count(*) AS n
            FROM bank_txn GROUP BY 1), (SELECT avg(account_balance) AS gb, avg(transaction_freq_monthly) AS gf FROM bank_txn)
          WHERE b > gb AND f < gf ORDER BY 2 DESC, 1 LIMIT 20""",
        "country_averages": f"""SELECT country, {r('avg(account_balance)')} AS avg_balance,
          {r('avg(credit_score)')} AS avg_credit_score FROM bank_txn GROUP BY country""",
        "fraud_by_merchant": fraud_rates("merchant_category", "merchant_category"),
        "fraud_by_payment": fraud_rates("payment_method", "payment_method"),
        "fraud_by_device": fraud_rates("device_type", "device_type"),
        "fraud_type_share": f"""SELECT fraud_type, count(*) AS "count",
          {pct('count(*)', '(SELECT sum(is_fraud) FROM bank_txn)')} AS percentage
          FROM bank_txn WHERE is_fraud = 1 GROUP BY fraud_type""",
        "fraud_timing": fraud_rates(
            "if(is_night_transaction = 1, 'Night', 'Day')", "time_of_day",
            ("if(is_weekend = 1, 'Weekend', 'Weekday')", "day_type"),
        ),
        "amount_anomalies": f"""WITH big AS (SELECT * FROM bank_txn
            WHERE {AMT} > (SELECT avg({AMT}) + 3 * stddev_samp({AMT}) FROM bank_txn))
          SELECT transaction_id, customer_id, {AMT}, {r(f'(SELECT avg({AMT}) FROM big)')} AS avg_amount,
            {r(f'(SELECT stddev_samp({AMT}) FROM big)')} AS stddev_amount, is_fraud,
            if(is_fraud = 1, 'Confirmed Fraud Anomaly', 'Suspicious — Not Flagged as Fraud') AS anomaly_report FROM big""",
        "repeat_failures": """SELECT customer_id, max(failed_attempts) AS max_failed_attempts, count(*) AS txn_count,
          cast(sum(is_fraud) AS bigint) AS fraud_count FROM bank_txn WHERE failed_attempts > 3 AND is_fraud = 1 GROUP BY 1""",
        "fraud_by_pin": fraud_rates("if(pin_changed_recently = 1, 'PIN Changed Recently', 'PIN Not Changed')", "pin_status"),
        "fraud_by_international": fraud_rates("if(is_international = 1, 'International', 'Domestic')", "transaction_type"),
        "risk_ranking": f"""SELECT customer_id, count(*) AS txn_count, {HIT} AS fraud_count,
            {pct(HIT, 'count(*)')} AS fraud_rate, max(failed_attempts) AS max_failed,
            rank() OVER (ORDER BY {HIT} DESC NULLS LAST) AS risk_rank
          FROM bank_txn WHERE is_international = 1 AND is_night_transaction = 1 AND failed_attempts > 2 GROUP BY customer_id""",
        "country_rank": f"""SELECT country, customer_id, {r('spent')} AS total_amount,
            rank() OVER (PARTITION BY country ORDER BY spent DESC NULLS LAST) AS country_rank
          FROM (SELECT country, customer_id, round(sum({AMT}), 6) AS spent FROM bank_txn GROUP BY ALL)""",
        "top_n_per_group": f"""SELECT merchant_category, transaction_id, customer_id, {AMT},
            row_number() OVER (PARTITION BY merchant_category ORDER BY {AMT} DESC NULLS LAST, transaction_id) AS row_num
          FROM bank_txn QUALIFY row_num <= 5""",
        "running_total": f"""SELECT transaction_id, customer_id, transaction_date, {AMT},
          {r(f'(sum({AMT}) OVER (PARTITION BY customer_id ORDER BY transaction_date RANGE UNBOUNDED PRECEDING))')}
          AS cumulative_amount FROM bank_txn""",
        "customer_deciles": f"""SELECT customer_id, {r('spent')} AS total_amount, decile,
            CASE decile WHEN 1 THEN 'Top 10%' WHEN 2 THEN 'Top 20%' WHEN 3 THEN 'Top 30%' WHEN 4 THEN 'Top 50%'
              WHEN 5 THEN 'Top 50%' ELSE 'Bottom 50%' END AS customer_tier
          FROM (SELECT *, ntile(10) OVER (ORDER BY spent DESC NULLS LAST, customer_id) AS decile FROM ({SPENT}))""",
        "executive_fraud_report": f"""WITH bad AS (SELECT * FROM bank_txn WHERE is_fraud = 1),
          worst AS (SELECT country, merchant_category, payment_method FROM bank_txn GROUP BY ALL
            ORDER BY sum(is_fraud) DESC, 1, 2, 3 LIMIT 1)
          SELECT count(*) AS total_transactions, {r(f'sum({AMT})')} AS total_transaction_value,
            {r(f'avg({AMT})')} AS avg_transaction_amount, {HIT} AS total_fraud_cases,
            {pct(HIT, 'count(*)')} AS fraud_percentage,
            (SELECT fraud_type FROM bad GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_fraud_type,
            (SELECT country FROM worst) AS highest_risk_country,
            (SELECT merchant_category FROM worst) AS highest_risk_merchant,
            (SELECT payment_method FROM worst) AS highest_risk_payment,
            (SELECT {r('avg(credit_score)')} FROM bad) AS avg_credit_score_fraudsters,
            (SELECT {r('avg(account_balance)')} FROM bad) AS avg_balance_fraudsters,
            (SELECT {r('avg(failed_attempts)')} FROM bad) AS avg_failed_attempts_fraudsters
          FROM bank_txn""",
        "high_risk_view": f"""SELECT transaction_id, customer_id, transaction_date, {AMT}, country, merchant_category,
            payment_method, failed_attempts, is_fraud
          FROM bank_txn WHERE is_international = 1 AND is_night_transaction = 1 AND failed_attempts > 2""",
        "daily_fraud_report": f"""SELECT transaction_date, count(*) AS total_transactions, {HIT} AS fraud_cases,
          {pct(HIT, 'count(*)')} AS fraud_rate, {r(f'sum({AMT})')} AS total_amount FROM bank_txn GROUP BY transaction_date""",
        "suspicious_customers": f"""SELECT customer_id, {r(f'avg({AMT})')} AS avg_transaction_amount,
            {r('avg(credit_score)')} AS avg_credit_score, max(failed_attempts) AS max_failed_attempts,
            count(*) AS txn_count, {HIT} AS confirmed_frauds
          FROM bank_txn, (SELECT avg({AMT}) AS m FROM bank_txn)
          WHERE is_international = 1 AND failed_attempts > 2 AND credit_score < 600 AND {AMT} > m GROUP BY customer_id""",
        "fraud_summary": f"""SELECT country, merchant_category, count(*) AS total_transactions, {HIT} AS total_fraud,
          {pct(HIT, 'count(*)')} AS fraud_rate_pct, {r(f'avg({AMT})')} AS avg_amount FROM bank_txn GROUP BY ALL""",
        "fraud_alerts": ALERTS,
        "fraud_daily_summary": f"""SELECT alert_type, count(*) AS total_alerts, {HIT} AS confirmed_fraud,
          {pct(HIT, 'count(*)')} AS fraud_confirmation_rate, {r(f'avg({AMT})')} AS avg_transaction_amount,
          {r(f'sum({AMT})')} AS total_amount_at_risk FROM ({ALERTS}) GROUP BY alert_type""",
        "fraud_business_report": f"""WITH bad AS (SELECT count(*) AS n, avg({AMT}) AS a FROM bank_txn WHERE is_fraud = 1)
          SELECT country, {HIT} AS fraud_count, (SELECT n FROM bad) AS total_fraud,
            (SELECT {r('a')} FROM bad) AS avg_fraud_amount
          FROM bank_txn GROUP BY country ORDER BY 2 DESC, 1 LIMIT 3""",
    }


# --- churn -----------------------------------------------------------------------------

LEFT = big("count(*) FILTER (Churn = 'Yes')")
LEFT_RATE = pct(LEFT, "count(*)")
PAID = "coalesce(try_cast(trim(TotalCharges) AS double), 0)"
SERVICES = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]
SCORE = """(CASE Contract WHEN 'Month-to-month' THEN 3 WHEN 'One year' THEN 1 ELSE 0 END
 + CASE WHEN tenure > 48 THEN 0 WHEN tenure > 24 THEN 1 WHEN tenure > 12 THEN 2 ELSE 3 END
 + if(TechSupport = 'No', 2, 0) + if(OnlineSecurity = 'No', 2, 0))"""
ENGINE = f"({SCORE} + if(PaymentMethod = 'Electronic check', 1, 0) + if(SeniorCitizen = 1, 1, 0))"
TELECOM_TYPES = {
    "customerID": "string", "gender": "string", "SeniorCitizen": "int", "Partner": "string", "Dependents": "string",
    "tenure": "int", "PhoneService": "string", "MultipleLines": "string", "PaperlessBilling": "string",
    "Contract": "string", "PaymentMethod": "string", "InternetService": "string", "OnlineSecurity": "string",
    "OnlineBackup": "string", "DeviceProtection": "string", "TechSupport": "string", "StreamingTV": "string",
    "StreamingMovies": "string", "MonthlyCharges": "double", "TotalCharges": "string", "Churn": "string",
}
STAGED = """SELECT customerID AS customer_id, gender, SeniorCitizen AS is_senior, if(Partner = 'Yes', 1, 0) AS has_partner,
  if(Dependents = 'Yes', 1, 0) AS has_dependents, tenure, Contract AS contract,
  if(PaperlessBilling = 'Yes', 1, 0) AS is_paperless, PaymentMethod AS payment_method,
  MonthlyCharges AS monthly_charges, try_cast(trim(TotalCharges) AS double) AS total_charges,
  PhoneService AS phone_service, MultipleLines AS multiple_lines, InternetService AS internet_service,
  OnlineSecurity AS online_security, OnlineBackup AS online_backup, DeviceProtection AS device_protection,
  TechSupport AS tech_support, StreamingTV AS streaming_tv, StreamingMovies AS streaming_movies,
  if(Churn = 'Yes', 1, 0) AS is_churned FROM telecom"""
FEATURES = f"""SELECT *, round(monthly_charges * tenure, 6) AS clv,
  CASE WHEN tenure > 48 THEN 'Loyal' WHEN tenure > 24 THEN 'Established' WHEN tenure > 12 THEN 'Developing'
    ELSE 'New' END AS tenure_segment,
  if(contract = 'Month-to-month', 2, 0) + cast(internet_service = 'Fiber optic' AS int)
    + cast(online_security = 'No' AS int) + cast(tech_support = 'No' AS int)
    + cast(payment_method = 'Electronic check' AS int) + cast(tenure < 12 AS int) AS risk_score FROM ({STAGED})"""
CUSTOMERS = f"""SELECT customer_id, gender, is_senior, has_partner, has_dependents, tenure, tenure_segment, contract,
  payment_method, is_paperless, monthly_charges, total_charges, clv FROM ({FEATURES})"""
SUBSCRIBED = f"""SELECT customer_id, phone_service, multiple_lines, internet_service, online_security, online_backup,
  device_protection, tech_support, streaming_tv, streaming_movies FROM ({FEATURES})"""
FACT = f"""SELECT customer_id, is_churned, monthly_charges, total_charges, clv, tenure, risk_score, tenure_segment,
  contract FROM ({FEATURES})"""
KPIS = f"""SELECT contract, count(*) AS total_customers, {big('sum(is_churned)')} AS churned_customers,
  {pct('sum(is_churned)', 'count(*)')} AS churn_rate_pct, {r('avg(monthly_charges)')} AS avg_monthly_charges,
  {r('avg(clv)')} AS avg_clv, {r('12 * sum(is_churned * monthly_charges)')} AS annual_revenue_lost,
  {r('avg(risk_score)')} AS avg_risk_score, {r('avg(tenure)', 1)} AS avg_tenure_months FROM ({FACT}) GROUP BY contract"""
LEAK = f"""SELECT customerID, Contract, InternetService, MonthlyCharges, tenure, {PAID} AS TotalCharges FROM telecom
  WHERE Churn = 'Yes' AND MonthlyCharges > (SELECT avg(MonthlyCharges) FROM telecom)
    AND tenure <= (SELECT quantile_cont(tenure, 0.25) FROM telecom)"""
LIMIT = "(SELECT avg(MonthlyCharges) + 1.5e0 * stddev_samp(MonthlyCharges) FROM telecom)"
PAYERS = f"SELECT customerID, MonthlyCharges, Contract, InternetService, Churn FROM telecom WHERE MonthlyCharges > {LIMIT}"
CURVE = f"""SELECT customerID, paid, row_number() OVER w AS rn, sum(paid) OVER w AS run, sum(paid) OVER () AS whole,
  count(*) OVER () AS n FROM (SELECT customerID, {PAID} AS paid FROM telecom) WHERE paid > 0
  WINDOW w AS (ORDER BY paid DESC, customerID ROWS UNBOUNDED PRECEDING)"""


def column_facts(column: str, kind: str) -> str:
    low, high = (f"cast({f}({column}) AS double)" if kind != "string" else "cast(NULL AS double)" for f in ("min", "max"))
    return f"""SELECT '{column}' AS column_name, '{kind}' AS data_type, count(*) - count({column}) AS null_count,
      {pct(f'count(*) - count({column})', 'count(*)')} AS null_percentage, count(DISTINCT {column}) AS distinct_count,
      (SELECT count(*) FROM telecom) - (SELECT count(*) FROM (SELECT DISTINCT * FROM telecom)) AS duplicate_count,
      {low} AS min_value, {high} AS max_value FROM telecom"""


def column_role(column: str, kind: str) -> str:
    d = f"count(DISTINCT {column})"
    plain = "Categorical" if kind == "string" else "Numerical"
    return f"""SELECT '{column}' AS column_name, {d} AS distinct_count,
      CASE WHEN {d} = count(*) THEN 'Identifier' WHEN {d} = 2 THEN 'Binary' ELSE '{plain}' END AS role FROM telecom"""


def by_each(dimensions: list[str], measure: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, cast({d} AS varchar) AS value, {measure} FROM telecom GROUP BY {d}" for d in dimensions
    )


def model_tests() -> str:
    models = [
        ("stg_churn", STAGED, "customer_id", ["customer_id", "is_churned"]),
        ("int_customer_features", FEATURES, "customer_id", ["customer_id"]),
        ("dim_customers", CUSTOMERS, "customer_id", ["customer_id"]),
        ("dim_services", SUBSCRIBED, "customer_id", ["customer_id"]),
        ("fct_churn", FACT, "customer_id", ["customer_id", "is_churned"]),
        ("mart_churn_kpis", KPIS, "contract", ["contract"]),
    ]
    parts = []
    for name, text, key, required in models:
        parts.append(f"""SELECT '{name}' AS model, '{key}' AS column_name, 'unique' AS test, count(*) AS failures
          FROM (SELECT {key} FROM ({text}) WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""")
        parts += [f"""SELECT '{name}', '{c}', 'not_null', count(*) FROM ({text}) WHERE {c} IS NULL""" for c in required]
    return " UNION ALL ".join(parts)


def churn() -> dict[str, str]:
    effect = " UNION ALL ".join(
        f"""SELECT '{s}' AS service,
        {pct(f"count(*) FILTER ({s} = 'Yes' AND Churn = 'Yes')", f"count(*) FILTER ({s} = 'Yes')")} AS churn_with,
        {pct(f"count(*) FILTER ({s} = 'No' AND Churn = 'Yes')", f"count(*) FILTER ({s} = 'No')")} AS churn_without
        FROM telecom""" for s in SERVICES
    )
    adopted = " + ".join(f"cast({s} = 'Yes' AS int)" for s in SERVICES)
    listed = ", ".join(f"if({s} = 'Yes', '{s}', NULL)" for s in SERVICES)
    bundle = f"coalesce(nullif(concat_ws('+', {listed}), ''), 'No Services')"
    yes = lambda c: f"cast({c} = 'Yes' AS int)"
    return {
        "quality_report": " UNION ALL ".join(column_facts(c, k) for c, k in TELECOM_TYPES.items()),
        "column_roles": " UNION ALL ".join(column_role(c, k) for c, k in TELECOM_TYPES.items()),
        "total_charges_fix": f"""SELECT count(*) AS total_rows,
          count(*) FILTER (try_cast(trim(TotalCharges) AS double) IS NULL) AS invalid_count,
          count(*) FILTER ({PAID} IS NULL) AS remaining_nulls, {r(f'sum({PAID})')} AS total_charges FROM telecom""",
        "charge_discrepancy": f"""SELECT customerID, tenure, MonthlyCharges, paid AS TotalCharges,
            {r('due', 6)} AS expected_total, {r('gap', 6)} AS diff_percentage
          FROM (SELECT *, abs(paid - due) / (due + 1) * 100e0 AS gap
            FROM (SELECT *, {PAID} AS paid, MonthlyCharges * tenure AS due FROM telecom)) WHERE gap > 10""",
        "churn_by_demographics": by_each(["gender", "SeniorCitizen", "Partner", "Dependents"], f"{LEFT_RATE} AS churn_rate"),
        "churn_by_segment": f"""SELECT CASE WHEN tenure <= 12 THEN 'New (0-12)' WHEN tenure <= 24 THEN 'Growing (12-24)'
            WHEN tenure <= 48 THEN 'Mature (24-48)' ELSE 'Loyal (48-72)' END AS tenure_segment,
            count(*) AS customer_count, {LEFT} AS churned, {pct(LEFT, 'count(*)', 6)} AS churn_rate
          FROM telecom WHERE tenure BETWEEN 1 AND 72 GROUP BY 1""",
        "churn_profiles": f"""SELECT Contract, PaymentMethod, InternetService, count(*) AS customer_count,
            {LEFT} AS churned, {LEFT_RATE} AS churn_rate FROM telecom GROUP BY ALL HAVING count(*) >= 30
          ORDER BY churn_rate DESC, 1, 2, 3 LIMIT 10""",
        "clv_comparison": f"""SELECT Churn, count(*) AS customer_count, {r('avg(MonthlyCharges * tenure)')} AS avg_clv,
          {r('avg(tenure)')} AS avg_tenure, {r('avg(MonthlyCharges)')} AS avg_monthly FROM telecom GROUP BY Churn""",
        "churn_by_risk_score": f"SELECT {SCORE} AS risk_score, {LEFT_RATE} AS churn_rate FROM telecom GROUP BY 1",
        "annual_loss": f"""SELECT {r('sum(MonthlyCharges)')} AS monthly_loss, {r('12 * sum(MonthlyCharges)')} AS annual_loss
          FROM telecom WHERE Churn = 'Yes'""",
        "pareto_summary": f"""SELECT count(*) AS total_customers, count(*) FILTER (rn <= floor(n * 0.2e0)) AS top_customers,
          {r('sum(paid) FILTER (rn <= floor(n * 0.2e0))')} AS top_revenue, {r('sum(paid)')} AS total_revenue,
          {pct('sum(paid) FILTER (rn <= floor(n * 0.2e0))', 'sum(paid)')} AS top_revenue_pct FROM ({CURVE})""",
        "pareto_curve": f"""SELECT customerID, paid AS TotalCharges, {r('run')} AS cumulative_revenue,
          {pct('run', 'whole', 6)} AS cumulative_pct FROM ({CURVE})""",
        "arpu": by_each(["Contract", "InternetService", "PaymentMethod"], f"{r('avg(MonthlyCharges)')} AS arpu"),
        "revenue_leakage": LEAK,
        "revenue_leakage_summary": f"""SELECT (SELECT {r('avg(MonthlyCharges)')} FROM telecom) AS high_charge_threshold,
          (SELECT {big('floor(quantile_cont(tenure, 0.25))')} FROM telecom) AS low_tenure_threshold,
          count(*) AS leakage_customers, {r('coalesce(sum(MonthlyCharges), 0)')} AS monthly_revenue_lost FROM ({LEAK})""",
        "high_payers": PAYERS,
        "high_payer_summary": f"""SELECT (SELECT {r('avg(MonthlyCharges)')} FROM telecom) AS mean_charge,
          (SELECT {r('stddev_samp(MonthlyCharges)')} FROM telecom) AS std_charge, {r(LIMIT)} AS threshold,
          count(*) AS high_paying_customers, {LEFT_RATE} AS churn_rate FROM ({PAYERS})""",
        "churn_by_combo": f"SELECT InternetService, TechSupport, {LEFT_RATE} AS churn_rate FROM telecom GROUP BY ALL",
        "service_effect": f"SELECT *, {r('churn_without - churn_with')} AS churn_reduction FROM ({effect})",
        "churn_by_adoption": f"SELECT {adopted} AS adoption_score, {LEFT_RATE} AS churn_rate FROM telecom GROUP BY 1",
        "fiber_cohort": f"""SELECT count(*) AS matching_customers, {LEFT} AS churned, {LEFT_RATE} AS churn_rate FROM telecom
          WHERE (InternetService, TechSupport, OnlineSecurity) = ('Fiber optic', 'No', 'No')""",
        "bundle_value": f"""SELECT {bundle} AS bundle, count(*) AS customer_count, {r('avg(MonthlyCharges)')} AS avg_monthly,
            {LEFT_RATE} AS churn_rate, {r(f'avg({PAID})')} AS avg_clv FROM telecom GROUP BY 1 HAVING count(*) >= 30
          ORDER BY avg_clv DESC, 1 LIMIT 10""",
        "churn_features": f"""SELECT customerID, tenure, MonthlyCharges AS monthly_charges, {PAID} AS total_charges,
          round(MonthlyCharges * tenure, 6) AS clv, SeniorCitizen AS is_senior, {yes('Partner')} AS has_partner,
          {yes('Dependents')} AS has_dependents, {yes('PhoneService')} AS has_phone, {yes('OnlineSecurity')} AS has_security,
          {yes('TechSupport')} AS has_techsupport, {yes('PaperlessBilling')} AS is_paperless,
          if(Contract = 'Month-to-month', 1, 0) AS contract_monthly, if(Contract = 'One year', 1, 0) AS contract_yearly,
          {SCORE} AS risk_score, {yes('Churn')} AS churn FROM telecom""",
        "retention_kpis": f"""SELECT Contract, count(*) AS total_customers, {LEFT} AS churned, count(*) - {LEFT} AS retained,
          {LEFT_RATE} AS churn_rate, {r('avg(tenure)')} AS avg_tenure, {r('avg(MonthlyCharges * tenure)')} AS avg_clv
          FROM telecom GROUP BY Contract""",
        "churn_by_risk_tier": f"""SELECT CASE WHEN {ENGINE} < 3 THEN 'Low' WHEN {ENGINE} < 6 THEN 'Medium'
            WHEN {ENGINE} < 9 THEN 'High' ELSE 'Critical' END AS churn_risk, count(*) AS customer_count,
            {LEFT_RATE} AS churn_rate FROM telecom GROUP BY 1""",
        "stg_churn": STAGED,
        "int_customer_features": FEATURES,
        "dim_customers": CUSTOMERS,
        "dim_services": SUBSCRIBED,
        "fct_churn": FACT,
        "mart_churn_kpis": KPIS,
        "churn_loss_total": f"SELECT {r('sum(annual_revenue_lost)')} AS total_churn_loss FROM ({KPIS})",
        "data_tests": model_tests(),
        "materialized_mart": " UNION ALL ".join(
            f"SELECT '{m}' AS source, count(*) AS row_count FROM {t}"
            for m, t in [(m, "telecom") for m in ("stg_churn", "int_customer_features", "dim_customers", "dim_services", "fct_churn")]
            + [("mart_churn_kpis", f"({KPIS})")]
        ),
    }


# --- orders, sensors, social -----------------------------------------------------------

CSV = """SELECT cast(transaction_id AS varchar) AS transaction_id, cast(customer_id AS varchar) AS customer_id,
  transaction_date, hour_of_day, is_weekend, is_night_transaction, country, city || CASE transaction_id % 4
    WHEN 0 THEN ', "x"' WHEN 1 THEN chr(92) WHEN 2 THEN <breaks> ELSE '' END AS city,
  merchant_category, payment_method, device_type, customer_age, credit_score, account_balance, transaction_amount,
  transaction_freq_monthly, is_international, failed_attempts, pin_changed_recently, is_fraud, fraud_type FROM bank_txn"""
RISK_LEVEL = """CASE WHEN amount > 10000 OR credit_score < 500 OR failed_attempts > 3 THEN 'high'
  WHEN amount > 5000 OR credit_score < 650 THEN 'medium' ELSE 'low' END"""
CITY_TOP = f"""SELECT customer_id, name, city, {r('spent')} AS total_spend, "rank" FROM (
  SELECT *, rank() OVER (PARTITION BY city ORDER BY spent DESC NULLS LAST) AS "rank" FROM (
    SELECT customer_id, name, city, round(sum(amount), 6) AS spent
    FROM customer_orders JOIN city_customers USING (customer_id) GROUP BY ALL)) WHERE "rank" <= 5"""
KINDS = "('POST_CREATED','LIKE','COMMENT','SHARE','FOLLOW','VIDEO_VIEW','PROFILE_VISIT')"
PROBLEMS = f"""nullif(concat_ws('; ', if(coalesce(event_id, '') = '', 'missing event_id', NULL),
  if(coalesce(event_type, '') IN {KINDS}, NULL, 'invalid event_type: ' || coalesce(event_type, 'None')),
  if(coalesce(user_id, '') = '', 'missing user_id', NULL),
  if(event_type IN ('LIKE','COMMENT','SHARE','VIDEO_VIEW') AND coalesce(post_id, '') = '',
     'missing post_id for event type that requires it', NULL)), '')"""
JSON_TAGS = """CASE WHEN {t} IS NULL OR len({t}) = 0 THEN '[]' ELSE '["' || array_to_string({t}, '","') || '"]' END"""
CHECKED = f"""SELECT event_id, event_type, user_id, post_id, ({PROBLEMS}) IS NULL AS is_valid,
  {PROBLEMS} AS validation_errors FROM social"""
LANDED = f"""SELECT coalesce(event_id, '') AS event_id, coalesce(event_type, '') AS event_type,
  coalesce(user_id, '') AS user_id, post_id, target_user_id, {JSON_TAGS.format(t='hashtags')} AS hashtags, comment_text,
  content_type, video_duration_sec, watch_time_sec, coalesce(ts, {STAMP}) AS event_timestamp, {STAMP} AS ingested_at,
  ({PROBLEMS}) IS NULL AS is_valid, {PROBLEMS} AS validation_errors FROM social"""
CURATED = f"""SELECT coalesce(e.event_id, '') AS event_id, coalesce(e.event_type, '') AS event_type,
  coalesce(e.user_id, '') AS user_id, coalesce(u.username, 'unknown') AS username,
  coalesce(u.user_type, 'regular') AS user_type, e.post_id, coalesce(p.content_type, e.content_type) AS content_type,
  CASE WHEN e.hashtags IS NULL THEN coalesce(p.hashtags, '[]') ELSE {JSON_TAGS.format(t='e.hashtags')} END AS hashtags,
  e.comment_text, e.video_duration_sec, e.watch_time_sec, coalesce(e.ts, {STAMP}) AS event_timestamp,
  {STAMP} AS ingested_at
  FROM social e LEFT JOIN user_dim u USING (user_id) LEFT JOIN post_dim p ON p.post_id = e.post_id"""
GOOD = "['love','great','awesome','amazing','good','excellent','fantastic','wonderful','best','happy']"
POOR = "['hate','bad','terrible','awful','worst','poor','horrible','disappointing','sad','angry']"
WORDS = "list_distinct(regexp_split_to_array(lower(comment_text), '\\s+'))"
BALANCE = f"(len(list_intersect({WORDS}, {GOOD})) - len(list_intersect({WORDS}, {POOR})))"
TONE = f"CASE WHEN {BALANCE} > 0 THEN 'positive' WHEN {BALANCE} < 0 THEN 'negative' ELSE 'neutral' END"
COMMENTS = f"""SELECT event_id, user_id, post_id, comment_text, {TONE} AS sentiment, ts AS event_timestamp
  FROM social WHERE event_type = 'COMMENT' AND comment_text IS NOT NULL"""
MENTIONS = "SELECT ts, unnest(hashtags) AS hashtag FROM social"
EPOCH = "TIMESTAMP '1970-01-01'"


def windowed(minutes: int) -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', ts, {EPOCH})"


def span(minutes: int, start: str = "s") -> str:
    return f"{start} AS window_start, {start} + INTERVAL '{minutes} minutes' AS window_end"


def trend(minutes: int, label: str) -> str:
    return f"""SELECT hashtag, '{label}' AS window_size, {span(minutes)}, n AS mention_count
      FROM (SELECT hashtag, {windowed(minutes)} AS s, count(*) AS n FROM ({MENTIONS}) GROUP BY ALL)"""


TRENDS = " UNION ALL ".join(trend(m, lab) for m, lab in ((1, "1 minute"), (5, "5 minutes"), (15, "15 minutes")))
VIEWS = f"""SELECT {span(5)}, page, views FROM (SELECT {windowed(5)} AS s, page, count(*) AS views
  FROM page_view GROUP BY ALL)"""
SENSED = f"""SELECT {span(5)}, sensor_id, {r('a', 6)} AS avg_temp, n AS reading_count FROM (
  SELECT {windowed(5)} AS s, sensor_id, avg(temperature) AS a, count(*) AS n FROM sensor GROUP BY ALL)"""
VIRAL = f"""SELECT post_id, {span(5)}, n AS like_count FROM (SELECT post_id, {windowed(5)} AS s, count(*) AS n
  FROM social WHERE event_type = 'LIKE' AND post_id IS NOT NULL GROUP BY ALL) WHERE n >= 2"""
RANKED = """SELECT *, rank() OVER (ORDER BY total_engagement DESC) AS "rank" FROM (
  SELECT target_user_id AS user_id,
    cast(sum(CASE event_type WHEN 'LIKE' THEN 1 WHEN 'COMMENT' THEN 3 WHEN 'SHARE' THEN 5 ELSE 10 END) AS bigint)
      AS total_engagement,
    count(*) FILTER (event_type = 'LIKE') AS like_count, count(*) FILTER (event_type = 'COMMENT') AS comment_count,
    count(*) FILTER (event_type = 'SHARE') AS share_count, count(*) FILTER (event_type = 'FOLLOW') AS follow_count
  FROM social WHERE event_type IN ('LIKE', 'COMMENT', 'SHARE', 'FOLLOW') AND target_user_id IS NOT NULL GROUP BY 1)"""
# Sensor readings in seven deliveries; a reading is taken unless its hour lies behind the watermark of the deliveries before.
DELIVERED = f"""WITH delivered AS (SELECT *, {windowed(60)} AS s, least(6, date_diff('day', DATE '2024-01-01', cast(ts AS date)) // 5
    + CASE WHEN reading_id % 20 = 7 THEN 2 WHEN reading_id % 10 = 3 THEN 1 ELSE 0 END) AS b FROM sensor),
  marks AS (SELECT n.b, date_trunc('milliseconds', max(ts)) - INTERVAL 6 days AS mark FROM (SELECT DISTINCT b FROM delivered) n
    JOIN delivered d ON d.b < n.b GROUP BY n.b),
  taken AS (SELECT delivered.* FROM delivered LEFT JOIN marks ON marks.b = delivered.b
    WHERE mark IS NULL OR s + INTERVAL 60 minutes > mark)"""
VERSIONS = f"""{DELIVERED}, steps AS (SELECT DISTINCT s, sensor_id, b FROM taken)
  SELECT {span(60, 'steps.s')}, steps.sensor_id, {r('avg(temperature)', 6)} AS avg_temp, count(*) AS reading_count,
    row_number() OVER (PARTITION BY steps.s, steps.sensor_id ORDER BY steps.b) AS version, version > 1 AS is_correction
  FROM steps JOIN taken ON taken.s = steps.s AND taken.sensor_id = steps.sensor_id AND taken.b <= steps.b
  GROUP BY steps.s, steps.sensor_id, steps.b"""
TOTALS = f"""SELECT customer_id, {r('run')} AS running_total, transaction_id AS latest_transaction_id,
  amount AS latest_amount, k AS transactions_counted FROM (
    SELECT *, sum(amount) OVER w AS run, count(*) OVER w AS k FROM user_txn WHERE amount > 10000
    WINDOW w AS (PARTITION BY customer_id ORDER BY transaction_id ROWS UNBOUNDED PRECEDING))"""


def events() -> dict[str, str]:
    return {
        "source_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS source, count(*) AS row_count, count(*) = 0 AS is_empty FROM {t}"
            for t in ("bank_txn", "telecom", "social", "sensor")
        ),
        "city_top_customers": CITY_TOP,
        "partitioned_write": CITY_TOP,
        "risk_classify": f"SELECT id, customer_id, amount, credit_score, failed_attempts, {RISK_LEVEL} AS risk_level FROM risk",
        "json_scan": f"SELECT id, customer_id, amount, credit_score, failed_attempts, {RISK_LEVEL} AS risk_level FROM risk",
        "risk_classify_sql": f"SELECT id, {RISK_LEVEL} AS risk_level FROM risk",
        "risk_route_counts": f"SELECT {RISK_LEVEL} AS risk_level, count(*) AS records FROM risk GROUP BY 1",
        "routed_tables": f"""SELECT 'risk_' || {RISK_LEVEL} AS source, count(*) AS row_count, false AS is_empty
          FROM risk GROUP BY 1""",
        "merge_records": """SELECT (rn - 1) // 1000 AS batch_no, count(*) AS record_count,
            min(transaction_id) AS first_record, max(transaction_id) AS last_record, count(*) AS array_length,
            string_agg(transaction_id, ',' ORDER BY transaction_id) AS record_ids
          FROM (SELECT *, row_number() OVER (ORDER BY transaction_id) AS rn FROM user_txn) GROUP BY 1""",
        "validate_events": CHECKED,
        "dead_letter": f"SELECT * EXCLUDE (is_valid) FROM ({CHECKED}) WHERE NOT is_valid",
        "raw_events": LANDED,
        "stream_landing": LANDED,
        "enrich_events": CURATED,
        "stream_enriched": CURATED,
        "comment_sentiment": COMMENTS,
        "stream_sentiment": COMMENTS,
        "sentiment_sql": f"SELECT event_id, {TONE} AS sentiment FROM social WHERE event_type = 'COMMENT'",
        "event_breakdown": f"""SELECT coalesce(event_type, 'UNKNOWN') AS event_type, count(*) AS events,
          {pct('count(*)', '(SELECT count(*) FROM social)', 1)} AS percentage FROM social GROUP BY 1""",
        "landing_kpis": f"""SELECT count(*) AS total_events, count(*) FILTER (is_valid) AS valid_events,
            {pct('count(*) FILTER (is_valid)', 'count(*)')} AS valid_pct, {r('avg(wait)')} AS avg_latency_sec,
            max(wait) AS max_latency_sec
          FROM (SELECT *, date_diff('microsecond', event_timestamp, ingested_at) // 1000000 AS wait FROM ({LANDED}))""",
        "sentiment_share": f"""SELECT sentiment, count(*) AS comments,
          {pct('count(*)', f'(SELECT count(*) FROM ({COMMENTS}))')} AS percentage FROM ({COMMENTS}) GROUP BY 1""",
        "top_hashtags": f"""SELECT hashtag, count(*) AS mention_count FROM ({MENTIONS})
          WHERE ts > (SELECT max(ts) FROM social) - INTERVAL '1 day' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "trending_hashtags": TRENDS,
        "stream_trending": TRENDS,
        "sliding_hashtags": f"""SELECT hashtag, '15 minutes' AS window_size, {span(15)}, count(*) AS mention_count
          FROM (SELECT hashtag, {windowed(5)} - to_minutes(5 * back) AS s
            FROM ({MENTIONS}), (SELECT unnest([0, 1, 2]) AS back)) GROUP BY ALL""",
        "viral_posts": VIRAL,
        "stream_viral": VIRAL,
        "influencer_ranking": RANKED,
        "stream_ranking": RANKED,
        "page_view_windows": VIEWS,
        "stream_page_views": VIEWS,
        "sensor_windows": SENSED,
        "stream_sensor_windows": SENSED,
        "window_versions": f"""WITH seen AS (SELECT {windowed(60)} AS s, sensor_id, reading_id % 3 AS b, temperature
            FROM sensor),
          steps AS (SELECT DISTINCT s, sensor_id, b FROM seen)
          SELECT {span(60, 'steps.s')}, steps.sensor_id, {r('avg(temperature)', 6)} AS avg_temp,
            count(*) AS reading_count, row_number() OVER (PARTITION BY steps.s, steps.sensor_id ORDER BY steps.b) AS version,
            version > 1 AS is_correction
          FROM steps JOIN seen ON seen.s = steps.s AND seen.sensor_id = steps.sensor_id AND seen.b <= steps.b
          GROUP BY steps.s, steps.sensor_id, steps.b""",
        "stream_late_readings": f"""SELECT window_start, window_end, sensor_id, avg_temp, reading_count, version FROM ({VERSIONS})
          QUALIFY row_number() OVER (PARTITION BY window_start, sensor_id ORDER BY version DESC) = 1""",
        "stream_window_history": VERSIONS,
        "stream_closed_windows": f"""{DELIVERED} SELECT {span(60)}, sensor_id, {r('avg(temperature)', 6)} AS avg_temp,
            count(*) AS reading_count FROM taken WHERE s + INTERVAL 60 minutes <= (SELECT max(ts) FROM sensor) - INTERVAL 6 days
          GROUP BY s, sensor_id""",
        "stream_sensor_alerts": f"""{DELIVERED},
          half AS (SELECT delivered.*, epoch_us(ts) // 1800000000 AS slot FROM delivered LEFT JOIN marks ON marks.b = delivered.b
            WHERE mark IS NULL OR ts > mark),
          reached AS (SELECT sensor_id, b, max(top) OVER (PARTITION BY sensor_id ORDER BY b) AS top
            FROM (SELECT sensor_id, b, max(slot) AS top FROM half GROUP BY ALL)),
          stats AS (SELECT reached.sensor_id, reached.b, avg(temperature) AS m, stddev_pop(temperature) AS d, count(*) AS n
            FROM reached JOIN half ON half.sensor_id = reached.sensor_id AND half.b <= reached.b AND slot <= top AND slot > top - 96
            GROUP BY ALL)
          SELECT half.sensor_id, temperature, {r('m', 3)} AS rolling_avg, {r('d', 3)} AS rolling_stddev, {r('m + 3 * d', 3)} AS threshold,
            n AS rolling_count, ts AS event_ts
          FROM half JOIN stats ON stats.sensor_id = half.sensor_id AND stats.b = half.b
          WHERE n >= 10 AND d > 0 AND temperature > m + 3 * d""",
        "reloaded_table": "SELECT * FROM user_dim",
        "appended_table": "SELECT *, cast(id % 3 AS int) AS batch_id FROM risk",
        "sensor_anomalies": f"""SELECT reading_id, sensor_id, temperature, {r('m', 3)} AS rolling_avg,
            {r('s', 3)} AS rolling_stddev, {r('m + 3 * s', 3)} AS threshold, ts AS event_ts
          FROM (SELECT *, avg(temperature) OVER w AS m, stddev_pop(temperature) OVER w AS s, count(*) OVER w AS n FROM sensor
            WINDOW w AS (PARTITION BY sensor_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW))
          WHERE n >= 10 AND s > 0 AND temperature > m + 3 * s""",
        "high_value_running_totals": TOTALS,
        "stream_running_totals": TOTALS,
        "csv_load": CSV.replace("<breaks>", "' - '"),
        "csv_load_lines": CSV.replace("<breaks>", "chr(10) || '.'"),
        "csv_rejects": "SELECT count(*) AS rejected FROM bank_txn WHERE transaction_id % 100 = 0",
        "decode_events": """SELECT event_id, event_type, user_id, post_id, target_user_id, comment_text, content_type,
          video_duration_sec, watch_time_sec, array_to_string(hashtags, ',') AS hashtags, event_id AS message_key, ts FROM social""",
        "keyed_messages": "SELECT cast(transaction_id AS varchar) AS key, transaction_id, customer_id, amount, ts FROM user_txn",
        "flatten_json_users": """SELECT cast(customer_id AS int) AS id, name, name || '@example.com' AS email, city,
          'Company ' || cast(customer_id % 10 AS varchar) AS company FROM city_customers""",
        "refreshed_daily_report": "SELECT * FROM (" + fraud()["daily_fraud_report"]
          + ") WHERE day(transaction_date) % 7 <> 3",
    }


def oracle_sql() -> dict[str, str]:
    return {name: with_inputs(text) for name, text in {**fraud(), **churn(), **events()}.items()}

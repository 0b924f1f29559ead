"""Complaint rows with every column the scoring stages read."""

BLANK = {
    "customer_repetition_count_v3": 0, "unresolved_problem_count_v3": 0, "customer_frustration_count_v3": 0,
    "agent_clarification_count_v3": 0, "potential_agent_mismatch": 0, "has_legal_risk": 0, "has_churn_risk": 0,
    "has_billing_dispute": 0, "has_technical_outage": 0, "high_frustration_flag": 0, "friction_level_v3": "low",
    "repeat_complaint_next_2m": 0, "high_value_customer": 0, "bill_shock_flag": 0, "total_revenue": 10.0,
    "customer_id": 1, "billing_year_month": "2024-01",
}


def complaint(**values):
    return BLANK | values


def frame(spark, rows):
    types = {int: "bigint", float: "double", str: "string"}
    names = list(rows[0])
    schema = ", ".join(
        f"{n} {types[next((type(r[n]) for r in rows if r[n] is not None), int)]}" for n in names
    )
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def by(df, key, *columns):
    return {row[key]: tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]] for row in df.collect()}

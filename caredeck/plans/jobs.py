"""The jobs: features, training, scoring, retrieval evaluation, replies. Each reads and writes tables.

    spark-submit --py-files caredeck.zip run_job.py features --raw ... --processed ... --out ...
"""

import argparse

from pyspark.sql import functions as F

from ..operators import (
    completions,
    customer_month,
    findings,
    friction,
    knowledge,
    metrics,
    models,
    picks,
    repeats,
    replies,
    retrieval,
    risk,
    rollups,
    signals,
)
from ..session import build_session
from ..sources.readers import exists, load_or_build, load_processed, read_table
from ..sources.sinks import save_table
from ..storage import discard_scratch, materialise
from .features import build_features

FEATURES = "complaints_final_features.parquet"
MONTHS = "customer_month_retention_modeling.parquet"
HINT = "run the features job first"
KEY = "complaint_key"


def features_job(spark, raw, processed, out, rebuild=False, nfkc=True):
    """Feature table, rollups, retrieval quality, representative rows and findings."""
    tables = load_or_build(spark, raw, processed, rebuild)
    built = build_features(tables.customer, tables.spending, tables.complaints, nfkc=nfkc)
    save_table(built.lifecycle, f"{processed}/lifecycle_v2.parquet")
    save_table(built.profile, f"{processed}/customer_profile.parquet")
    save_table(built.bills, f"{processed}/spending_bill_shock.parquet")
    # The written key tells complaint rows apart in the later jobs.
    keyed = built.features.withColumn(KEY, F.monotonically_increasing_id())
    save_table(keyed, f"{processed}/{FEATURES}")
    features = spark.read.parquet(f"{processed}/{FEATURES}")
    bills = spark.read.parquet(f"{processed}/spending_bill_shock.parquet")
    profile = spark.read.parquet(f"{processed}/customer_profile.parquet")
    index = knowledge.build_index(tables.reference, nfkc)
    evaluated = materialise(retrieval.evaluate_retrieval(index, features, KEY, nfkc=nfkc))
    quality = materialise(retrieval.retrieval_metrics(evaluated))
    for name, table in rollup_tables(tables, features, profile, bills).items():
        save_table(table, f"{out}/tables/{name}.csv")
    for name in ("rag_retrieval_readiness_summary", "rag_retrieval_metrics", "rag_retrieval_summary"):
        save_table(quality, f"{out}/tables/{name}.csv")
    save_table(replies.head_rows(evaluated, None, [KEY]), f"{out}/tables/rag_sample_results.csv")
    save_table(picks.picked_rows(features, index, KEY, nfkc=nfkc), f"{out}/demo_cases/final_demo_cases.json")
    report = findings.findings(tables.customer, tables.spending, features, bills, quality)
    save_table(report, f"{out}/final/final_executive_summary.csv")


def rollup_tables(tables, features, profile, bills):
    """Published rollups by table name."""
    levels, valued = friction.FRICTION_LEVELS, features.where(F.col("high_value_customer") == 1)

    def counts(column, name="complaint_count"):
        return rollups.value_counts(features, column, name)

    return {
        "monthly_kpi_summary": rollups.monthly_kpi(tables.spending, tables.complaints),
        "category_counts": rollups.value_counts(tables.complaints, "problem_category"),
        "subcategory_counts": rollups.value_counts(tables.complaints, "problem_subcategory"),
        "repeat_complaint_summary": repeats.repeat_summary(features),
        "repeat_complaint_by_category": repeats.repeat_by_category(features),
        "signal_distribution": signals.signal_distribution(features),
        "signal_by_category": signals.signal_by_category(features),
        "friction_v3_distribution": counts("friction_level_v3"),
        "friction_v3_summary": counts("friction_level_v3"),
        "friction_v3_by_category": rollups.crosstab(features, "problem_category", "friction_level_v3", levels, True),
        "friction_by_priority": rollups.crosstab(features, "priority_level", "friction_level_v3", levels, True),
        "potential_agent_mismatch_summary": friction.mismatch_summary(features),
        "business_risk_level_summary": counts("business_risk_level"),
        "business_risk_summary": counts("business_risk_level"),
        "priority_distribution": counts("priority_level"),
        "risk_score_band_distribution": counts("risk_score_band"),
        "risk_component_summary": risk.component_summary(features),
        "priority_by_category": rollups.crosstab(features, "problem_category", "priority_level", risk.PRIORITIES),
        "routing_distribution": counts("recommended_queue"),
        "high_value_at_risk": risk.high_value_at_risk(features),
        "high_value_at_risk_summary": risk.high_value_at_risk_summary(features),
        "high_value_priority_distribution": rollups.value_counts(valued, "priority_level"),
        "high_value_revenue_by_priority": risk.high_value_revenue_by_priority(features),
        "data_scale_summary": rollups.data_scale(tables.customer, tables.spending, features),
        "lifecycle_status_v2_summary": rollups.value_counts(profile, "lifecycle_status_v2", "customer_count"),
        "bill_shock_summary": rollups.bill_shock_summary(bills),
    }


def training_job(spark, processed, out, model_path):
    """Modelling table, three models and the baseline, the chosen model and its tables."""
    features = read_table(spark, f"{processed}/{FEATURES}", HINT)
    save_table(customer_month.customer_months(features), f"{processed}/{MONTHS}")
    months = materialise(customer_month.time_split(spark.read.parquet(f"{processed}/{MONTHS}")))
    present = {row["split"] for row in months.select("split").distinct().collect()}
    if present != {"train", "validation", "test"}:
        raise ValueError(f"not enough months to train and test; splits found: {sorted(present)}")
    train, held_out = months.where("split = 'train'"), months.where("split != 'train'")
    fitted = models.fit_models(train)
    columns = ("customer_id", "billing_year_month", "split", "total_revenue", "score")

    def measured(name, rows):
        return rows.select(F.lit(name).alias("model"), *columns, F.col(customer_month.TARGET).alias("y"))

    scored = [measured(models.BASELINE, metrics.rule_baseline(held_out))]
    scored += [measured(name, models.score_rows(model, held_out)) for name, model in fitted.items()]
    scored = materialise(metrics.union_all(scored))
    by = ("model", "split")
    table = materialise(metrics.evaluate(scored, metrics.rank_scores(scored, by), by))
    best = models.choose_model(table)
    models.save_model(fitted[best], model_path)
    chosen = scored.where(F.col("model") == best).drop("model")
    ranked = materialise(metrics.rank_scores(chosen, ("split",)))
    confusion = metrics.confusion_top(ranked)
    best_rows = table.where(F.col("model") == best)
    risky = models.top_risk(models.predict(fitted[best], months.where("split = 'test'")))
    outputs = {
        "retention_model_metrics": table,
        "retention_precision_at_k": metrics.precision_at_k(best_rows),
        "retention_revenue_capture": metrics.revenue_capture(best_rows),
        "retention_decile_lift": metrics.decile_table(ranked),
        "retention_calibration_table": metrics.calibration_table(chosen),
        "retention_top_risk_customers": risky,
        "retention_feature_importance": models.feature_importance(fitted[best], months),
        "retention_confusion_matrix_top5": confusion.where("split = 'test'").drop("split"),
    }
    for split in ("validation", "test"):
        outputs[f"retention_confusion_matrix_top5_{split}"] = confusion.where(F.col("split") == split).drop("split")
    for name, frame in outputs.items():
        save_table(frame, f"{out}/tables/{name}.csv")
    precision = best_rows.where("split = 'test'").select("precision_top_5pct").scalar()
    save_table(headline(spark, processed, out, features, precision), f"{out}/tables/kpi_strip.csv")
    return best


def headline(spark, processed, out, features, precision):
    """The strip of key figures, with the chosen model's precision on the test months and the retrieval job's hit rate, if measured."""
    quality, hit = f"{out}/tables/rag_retrieval_metrics.csv", F.lit(None).cast("double")
    if exists(spark, quality):
        hit = spark.read.csv(quality, header=True, inferSchema=True).select(F.col("hit_at_3").cast("double")).scalar()
    customer = load_processed(spark, processed, HINT).customer
    bills = read_table(spark, f"{processed}/spending_bill_shock.parquet", HINT)
    return rollups.kpi_strip(customer, bills, features, precision, hit)


def scoring_job(spark, processed, out, model_path):
    """All customer-months scored by the saved model: probability, percentile, and the split they belong to."""
    months = customer_month.time_split(read_table(spark, f"{processed}/{MONTHS}", "run the training job first"), unlabelled="unlabelled")
    scored = models.predict(models.load_model(model_path), months)
    save_table(scored, f"{out}/scores/customer_month_scores.parquet")


def replies_job(spark, processed, out, ledger, nfkc=True):
    """Prompts for every complaint, requests for those without a completion, and replies from the completions there are.

    `ledger`/completions holds what came back: (request_id, text, error) as JSON lines, any number of files. Each run
    writes `ledger`/requests, the requests still to be answered, and the replies as they are by then.
    """
    features = read_table(spark, f"{processed}/{FEATURES}", HINT)
    index = knowledge.build_index(load_processed(spark, processed, HINT).reference, nfkc)
    queries = features.withColumn("query", retrieval.complaint_query(features.columns, nfkc))
    hits = retrieval.retrieve(index, queries, 3, key=KEY, nfkc=nfkc)
    answered = materialise(queries.join(retrieval.with_documents(hits, index, KEY), KEY, "left"))
    prompts = materialise(completions.with_request_ids(replies.prompts(answered)).select(KEY, "request_id", "messages"))
    came = f"{ledger}/completions"
    schema = "request_id string, text string, error string"
    back = spark.read.schema(schema).option("mode", "FAILFAST").json(came) if exists(spark, came) else spark.createDataFrame([], schema)
    save_table(prompts, f"{ledger}/prompts.parquet")
    save_table(completions.missing_requests(prompts, back), f"{ledger}/requests.json")
    guarded = replies.citation_guard(answered, completions.with_completions(prompts, back, KEY), KEY)
    save_table(guarded.drop("retrieved_documents", "query"), f"{out}/replies/complaint_replies.parquet")


def retrieval_job(spark, processed, out, sample_size=None, nfkc=True):
    """Retrieval quality and reply quality on written features."""
    features = read_table(spark, f"{processed}/{FEATURES}", HINT)
    index = knowledge.build_index(load_processed(spark, processed, HINT).reference, nfkc)
    evaluated = materialise(retrieval.evaluate_retrieval(index, features, KEY, nfkc=nfkc))
    save_table(retrieval.retrieval_metrics(evaluated), f"{out}/tables/rag_retrieval_metrics.csv")
    sample = replies.head_rows(features, sample_size, [KEY])
    queries = sample.withColumn("query", retrieval.complaint_query(sample.columns, nfkc))
    hits = retrieval.retrieve(index, queries, 3, key=KEY, nfkc=nfkc)
    answered = sample.join(retrieval.with_documents(hits, index, KEY), KEY, "left")
    keys = (KEY, "customer_id", "problem_category")
    rows = materialise(replies.reply_rows(replies.grounded_replies(answered), keys))
    save_table(replies.reply_metrics(rows), f"{out}/tables/rag_generation_metrics.csv")
    save_table(replies.head_rows(rows, None, [KEY]), f"{out}/tables/rag_eval_sample.csv")
    save_table(replies.reply_failures(rows, keys=(KEY,)), f"{out}/tables/rag_failure_cases.csv")


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("job", choices=("features", "training", "scoring", "retrieval", "replies"))
    parser.add_argument("--raw", help="folder of the raw JSON files")
    parser.add_argument("--processed", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--model", help="folder of the saved model")
    parser.add_argument("--ledger", help="folder of prompts, requests and completions")
    parser.add_argument("--sample-size", type=int, default=None)
    parser.add_argument("--suffix", default=".json", help=".json or .json.gz")
    parser.add_argument("--rebuild", action="store_true")
    parser.add_argument("--jvm-text", action="store_true", help="leave compatibility characters as they are")
    args = parser.parse_args()
    spark = build_session(f"caredeck-{args.job}")
    try:
        _run(spark, args)
    finally:
        discard_scratch(spark)


def _run(spark, args):
    if args.job == "features":
        files = {
            "customer": "customer", "spending": "customer_spending", "complaints": "customer_complaints",
            "reference": "reference_material",
        }
        raw = {name: f"{args.raw}/{file}{args.suffix}" for name, file in files.items()}
        features_job(spark, raw, args.processed, args.out, args.rebuild, not args.jvm_text)
    elif args.job == "training":
        training_job(spark, args.processed, args.out, args.model)
    elif args.job == "scoring":
        scoring_job(spark, args.processed, args.out, args.model)
    elif args.job == "replies":
        replies_job(spark, args.processed, args.out, args.ledger, not args.jvm_text)
    else:
        retrieval_job(spark, args.processed, args.out, args.sample_size, not args.jvm_text)

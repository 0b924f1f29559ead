"""Registered queries: every operator over the driver's tables, whole tables and whole texts."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from caredeck.functions import text as tx
from caredeck.functions.lexicon import TELECOM_TR
from caredeck.functions.months import month_index
from caredeck.functions.numeric import safe_divide
from caredeck.operators import (
    billing,
    conversations,
    customer_month,
    findings,
    friction,
    knowledge,
    lifecycle,
    metrics,
    models,
    picks,
    profile,
    ranking,
    repeats,
    replies,
    retrieval,
    risk,
    rollups,
    signals,
)
from caredeck.plans import features as feature_plan
from caredeck.storage import materialise

from .views import register

DIGITS = 6
_shared = {}


def _once(name, spark, folder, build):
    """A stage's written output, made once per session and folder, as a job would find it on disk."""
    key = (name, spark.sparkContext.applicationId, folder)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def _tidy(df):
    """Doubles at six decimals, so that sums taken in another order compare equal."""
    return df.select(
        *[F.round(f.name, DIGITS).alias(f.name) if f.dataType == T.DoubleType() else F.col(f"`{f.name}`") for f in df.schema]
    )


def _feature_tables(spark, folder):
    v = register(spark, folder)
    return feature_plan.build_features(v["v_customer"], v["v_spending"], v["v_complaints"])


TEXTS = ("customer_text", "agent_text", "full_text", "first_customer_message", "last_customer_message")


def _features_and_texts(spark, folder):
    """The feature table over its written layers; its rows, with their texts, are built when asked for."""
    return _once("features and texts", spark, folder, lambda: _feature_tables(spark, folder).features)


def _features(spark, folder):
    """The written feature table that counts, customer-months and models start from: all but the texts, which no one reads there."""
    return _once("features", spark, folder, lambda: materialise(_features_and_texts(spark, folder).drop(*TEXTS)))


def _bills(spark, folder):
    v = register(spark, folder)
    return billing.bill_shock(v["v_spending"], v["v_complaints"])


def _index(spark, folder):
    return _once("index", spark, folder, lambda: knowledge.build_index(register(spark, folder)["v_reference"]))


def _english_index(spark, folder):
    return _once("english", spark, folder, lambda: knowledge.build_index(register(spark, folder)["v_reference_en"]))


def _scored(spark, folder):
    return register(spark, folder)["v_scored"]


# -- customers and billing


def lifecycle_dense(spark, folder):
    return _tidy(lifecycle.lifecycle(register(spark, folder)["v_spending"]))


def lifecycle_sparse(spark, folder):
    return _tidy(lifecycle.lifecycle(register(spark, folder)["v_spending_orders"]))


def customer_profile(spark, folder):
    v = register(spark, folder)
    cycle = materialise(lifecycle.lifecycle(v["v_spending_orders"]))
    table, threshold = profile.customer_profile(v["v_customer"], cycle)
    return _tidy(
        table.select(
            "customer_id", "city", "age", "age_band", "lifecycle_status_v2", "total_revenue", "high_value_customer",
            "customer_segment", threshold.scalar().alias("threshold"),
        )
    )


def lifecycle_counts(spark, folder):
    v = register(spark, folder)
    joined = v["v_customer"].join(lifecycle.lifecycle(v["v_spending_orders"]), "customer_id", "left")
    return rollups.value_counts(joined, "lifecycle_status_v2", "customer_count")


def monthly_kpi(spark, folder):
    v = register(spark, folder)
    return _tidy(rollups.monthly_kpi(v["v_spending"], v["v_complaints"]))


def category_counts(spark, folder):
    return rollups.value_counts(register(spark, folder)["v_complaints"], "problem_category")


def subcategory_counts(spark, folder):
    return rollups.value_counts(register(spark, folder)["v_complaints"], "problem_subcategory")


def data_scale(spark, folder):
    v = register(spark, folder)
    return rollups.data_scale(v["v_customer"], v["v_spending"], v["v_complaints"])


def bill_shock(spark, folder):
    return _tidy(_bills(spark, folder))


def bill_shock_summary(spark, folder):
    return _tidy(rollups.bill_shock_summary(_bills(spark, folder)))


def revenue_per_usage(spark, folder):
    rows = register(spark, folder)["v_spending"]
    ratio = safe_divide(F.col("bill_amount"), F.col("data_usage") - 1)
    return _tidy(rows.select("customer_id", "billing_year_month", ratio.alias("bill_per_extra_use")))


def month_indexes(spark, folder):
    rows = register(spark, folder)["v_spending_orders"]
    return rows.select("billing_year_month", month_index(F.col("billing_year_month")).alias("month_index")).distinct()


# -- complaints


def repeat_flags(spark, folder):
    flagged = repeats.repeat_flags(register(spark, folder)["v_complaints"])
    return flagged.select(
        "complaint_id", "customer_id", "billing_year_month", "month_index", "repeat_complaint_next_1m",
        "repeat_complaint_next_2m", "repeat_complaint",
    )


def repeat_summary(spark, folder):
    return _tidy(repeats.repeat_summary(repeats.repeat_flags(register(spark, folder)["v_complaints"])))


def repeat_by_category(spark, folder):
    return _tidy(repeats.repeat_by_category(repeats.repeat_flags(register(spark, folder)["v_complaints"])))


def flatten_conversations(spark, folder):
    turns = register(spark, folder)["conversations"]
    return conversations.flatten_complaints(
        conversations.turns_to_history(turns, "conv_id", "turn", "role", "text")
    )


def normalize_text(spark, folder):
    docs = register(spark, folder)["documents"]
    return docs.select("doc_id", tx.normalize(F.col("text")).alias("text_norm"), tx.word_count(F.col("text")).alias("words"))


# Function words of the languages the documents are written in, beside the complaint phrases.
DOCUMENT_PHRASES = {
    "english": ("the", "that the", "in the", "and the", "of"),
    "french": ("les", "de la", "que", "et le"),
    "spanish": ("de", "que en", "la", "en la"),
    "german": ("der", "die und", "und", "in der"),
}
COUNTED = {
    name: getattr(TELECOM_TR, name)
    for name in (
        "legal", "churn", "billing_strong", "billing_context", "technical_strong", "technical_context", "repetition",
        "unresolved", "frustration", "clarification", "billing_action", "tech_action",
    )
} | DOCUMENT_PHRASES


def phrase_counts(spark, folder):
    """Occurrences per family in whole documents and in whole complaints, all families in one pass over a text."""
    v = register(spark, folder)
    docs = v["documents"].select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    told = v["v_complaints"].select(F.lit("complaint").alias("kind"), F.col("complaint_id").alias("id"), F.col("full_text").alias("text"))
    found = tx.find_phrases(tx.normalize(F.col("text")), *COUNTED.values())
    # The test tables' documents are one file and one task; finding phrases is work for many.
    spread = docs.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = spread.unionByName(told).select("kind", "id", found.alias("found"))
    return rows.select("kind", "id", *[tx.found_count(F.col("found"), terms).alias(name) for name, terms in COUNTED.items()])


def category_terms(spark, folder):
    rows = register(spark, folder)["v_complaints"]
    return rows.select(
        "complaint_id", F.array_join(tx.category_terms(F.col("problem_category")), "|").alias("terms")
    )


SIGNAL_COLUMNS = (
    "complaint_id", "has_legal_risk", "has_churn_risk", "has_billing_dispute", "has_technical_outage",
    "legal_signal_reason", "churn_signal_reason", "billing_signal_reason", "technical_signal_reason",
    "customer_repetition_count_v3", "unresolved_problem_count_v3", "customer_frustration_count_v3",
    "agent_clarification_count_v3", "potential_agent_mismatch", "high_frustration_flag",
)


def complaint_signals(spark, folder):
    return signals.complaint_signals(register(spark, folder)["v_complaints"]).select(*SIGNAL_COLUMNS)


def signal_distribution(spark, folder):
    return _tidy(signals.signal_distribution(_features(spark, folder)))


def signal_by_category(spark, folder):
    return _tidy(signals.signal_by_category(_features(spark, folder)))


def friction_scores(spark, folder):
    scored = friction.friction(signals.complaint_signals(register(spark, folder)["v_complaints"]))
    return scored.select(
        "complaint_id", "long_conversation_flag_v3", "very_long_conversation_flag_v3", "friction_score_v3",
        "friction_level_v3",
    )


def friction_distribution(spark, folder):
    return rollups.value_counts(_features(spark, folder), "friction_level_v3")


def friction_by_category(spark, folder):
    table = rollups.crosstab(
        _features(spark, folder), "problem_category", "friction_level_v3", friction.FRICTION_LEVELS, normalise=True
    )
    return _tidy(table)


def friction_by_priority(spark, folder):
    table = rollups.crosstab(
        _features(spark, folder), "priority_level", "friction_level_v3", friction.FRICTION_LEVELS, normalise=True
    )
    return _tidy(table)


def mismatch_summary(spark, folder):
    return _tidy(friction.mismatch_summary(_features(spark, folder)))


# -- risk and routing, built from the inputs

FEATURE_COLUMNS = (
    "complaint_id", "customer_id", "billing_year_month", "lifecycle_status_v2", "total_revenue",
    "high_value_customer", "customer_segment", "previous_bill_amount", "rolling_3m_avg_bill", "bill_change_abs",
    "bill_change_pct", "bill_shock_flag", "same_month_billing_complaint", "next_month_billing_complaint",
    "no_billable_activity_next_2m", "repeat_complaint", "friction_score_v3", "friction_level_v3",
    "business_risk_score", "priority_level", "recommended_queue",
)


def feature_table(spark, folder):
    return _tidy(_feature_tables(spark, folder).features.select(*FEATURE_COLUMNS))


def risk_priority(spark, folder):
    table = _feature_tables(spark, folder).features
    parts = [c for c in table.columns if c.startswith(risk.PREFIX)]
    return table.select(
        "complaint_id", *parts, "business_risk_score", "business_risk_level", "priority_level", "risk_score_band",
        F.array_join(risk.active_signals(), "|").alias("risk_signals"),
    )


def routing_rules(spark, folder):
    return _feature_tables(spark, folder).features.select(
        "complaint_id", "recommended_queue", "recommended_business_action"
    )


# -- rollups of the written feature table


def _counts(column):
    return lambda spark, folder: rollups.value_counts(_features(spark, folder), column)


def risk_component_summary(spark, folder):
    return _tidy(risk.component_summary(_features(spark, folder)))


def priority_by_category(spark, folder):
    return rollups.crosstab(_features(spark, folder), "problem_category", "priority_level", risk.PRIORITIES)


def high_value_at_risk(spark, folder):
    table = risk.high_value_at_risk(
        _features(spark, folder), keys=("customer_id", "billing_year_month", "complaint_id")
    )
    return _tidy(table.select("complaint_id", "customer_id", "business_risk_score", "total_revenue"))


def high_value_at_risk_summary(spark, folder):
    return _tidy(risk.high_value_at_risk_summary(_features(spark, folder)))


def high_value_priority(spark, folder):
    valued = _features(spark, folder).where(F.col("high_value_customer") == 1)
    return rollups.value_counts(valued, "priority_level")


def high_value_revenue(spark, folder):
    return _tidy(risk.high_value_revenue_by_priority(_features(spark, folder)))


def executive_findings(spark, folder):
    v = register(spark, folder)
    return findings.findings(
        v["v_customer"], v["v_spending"], _features(spark, folder), _bills(spark, folder),
        retrieval.retrieval_metrics(_evaluated(spark, folder)),
    )


def kpi_strip(spark, folder):
    v = register(spark, folder)
    ranked = metrics.rank_scores(v["v_scored"])
    precision = metrics.topk_metrics(ranked).select("precision_top_5pct").scalar()
    hit = retrieval.retrieval_metrics(_evaluated(spark, folder)).select("hit_at_3").scalar()
    return _tidy(rollups.kpi_strip(v["v_customer"], _bills(spark, folder), _features(spark, folder), precision, hit))


# -- customer-month table and ranking metrics


def customer_months(spark, folder):
    return _tidy(customer_month.customer_months(_features(spark, folder)))


def time_split(spark, folder):
    table = customer_month.customer_months(_features(spark, folder))
    return customer_month.time_split(table).select("customer_id", "billing_year_month", "split")


def score_quality(spark, folder):
    return _tidy(metrics.score_quality(_scored(spark, folder)))


def topk_metrics(spark, folder):
    return _tidy(metrics.topk_metrics(metrics.rank_scores(_scored(spark, folder))))


def precision_at_k(spark, folder):
    return _tidy(metrics.precision_at_k(metrics.topk_metrics(metrics.rank_scores(_scored(spark, folder))), ()))


def revenue_capture(spark, folder):
    return _tidy(metrics.revenue_capture(metrics.topk_metrics(metrics.rank_scores(_scored(spark, folder))), ()))


def confusion_top5(spark, folder):
    return metrics.confusion_top(metrics.rank_scores(_scored(spark, folder)), ())


def decile_table(spark, folder):
    return _tidy(metrics.decile_table(metrics.rank_scores(_scored(spark, folder)), ()))


def calibration_table(spark, folder):
    return _tidy(metrics.calibration_table(_scored(spark, folder), ()))


def risk_percentile(spark, folder):
    scored = _scored(spark, folder)
    return _tidy(ranking.with_percentile(scored, "score").select("customer_id", "score", "risk_percentile"))


def baseline_metrics(spark, folder):
    scored = metrics.rule_baseline(_months(spark, folder).where("split != 'train'"))
    scored = scored.withColumn("y", F.col(customer_month.TARGET))
    return _tidy(metrics.evaluate(scored, metrics.rank_scores(scored, ("split",)), ("split",)))


# -- models


def _months(spark, folder):
    """The written modelling table with its split."""
    return _once(
        "months",
        spark,
        folder,
        lambda: materialise(customer_month.time_split(customer_month.customer_months(_features(spark, folder)))),
    )


def _fitted(spark, folder, name):
    train = _months(spark, folder).where("split = 'train'")
    return _once(name, spark, folder, lambda: models.fit_models(train, [name])[name])


def _measured(spark, folder, names):
    """Metrics per model and split."""
    held_out = _months(spark, folder).where("split != 'train'")
    scored = []
    for name in names:
        if name == models.BASELINE:
            rows = metrics.rule_baseline(held_out)
        else:
            rows = models.score_rows(_fitted(spark, folder, name), held_out)
        columns = ("customer_id", "billing_year_month", "split", "total_revenue", "score")
        scored.append(rows.select(F.lit(name).alias("model"), *columns, F.col(customer_month.TARGET).alias("y")))
    # The models are run once; three metric passes read the result.
    table = materialise(metrics.union_all(scored))
    by = ("model", "split")
    return metrics.evaluate(table, metrics.rank_scores(table, by), by)


def _train(name):
    return lambda spark, folder: _measured(spark, folder, [name])


def model_metrics(spark, folder):
    return _measured(spark, folder, [models.BASELINE, *models.MODELS])


def model_selection(spark, folder):
    table = materialise(model_metrics(spark, folder))
    return table.where(F.col("model") == models.choose_model(table))


def _best(spark, folder):
    def choose():
        return models.choose_model(_measured(spark, folder, list(models.MODELS)))

    return _fitted(spark, folder, _once("choice", spark, folder, choose))


def feature_importance(spark, folder):
    return models.feature_importance(_fitted(spark, folder, "random_forest"), _months(spark, folder))


def score_batch(spark, folder):
    """Every customer-month scored, training months and those without a label included; `split` tells which is which."""
    months = customer_month.time_split(customer_month.customer_months(_features(spark, folder)), unlabelled="unlabelled")
    scored = models.predict(_best(spark, folder), months)
    return scored.select("customer_id", "billing_year_month", "split", "risk_probability", "risk_percentile")


# -- knowledge base and replies


def kb_sections(spark, folder):
    return knowledge.parse_sections(register(spark, folder)["v_reference"]).select(
        "document_id", "title", "category", "problem", "solution", "content_norm"
    )


def _queries(spark, folder, view="v_queries"):
    rows = register(spark, folder)[view]
    return rows.withColumn("query", retrieval.complaint_query(rows.columns))


def query_texts(spark, folder):
    return _queries(spark, folder).select("query_id", "query")


def _topk(method, k):
    def run(spark, folder):
        hits = retrieval.retrieve(_index(spark, folder), _queries(spark, folder), k, method)
        return _tidy(hits.select("query_id", "rank", "document_id", "score"))

    return run


def _evaluated(spark, folder):
    return _once(
        "evaluated",
        spark,
        folder,
        lambda: materialise(retrieval.evaluate_retrieval(_index(spark, folder), register(spark, folder)["v_queries"])),
    )


def retrieval_eval(spark, folder):
    rows = register(spark, folder)["v_queries"]
    return _tidy(retrieval.evaluate_retrieval(_index(spark, folder), rows))


def retrieval_metrics(spark, folder):
    return _tidy(retrieval.retrieval_metrics(_evaluated(spark, folder)))


def _answered(spark, folder):
    """Queries with their three best documents of the knowledge base in one language; no reply reads the documents' texts."""
    queries, index = _queries(spark, folder), _english_index(spark, folder)
    hits = retrieval.retrieve(index, queries, 3)
    fields = [f for f in retrieval.DOCUMENT if f != "content_snippet"]
    return queries.join(retrieval.with_documents(hits, index, fields=fields), "query_id", "left")


def _documents_asking(spark, folder):
    """Every document as a query, the whole knowledge base, and the query's three best documents of it."""
    queries, index = _queries(spark, folder, "v_document_queries"), _index(spark, folder)
    return queries, index, retrieval.retrieve(index, queries, 3)


def template_replies(spark, folder):
    rows = replies.template_texts(_answered(spark, folder))
    return rows.select(
        "query_id", "confirmation_prompt", "conversation_summary", "suggested_agent_reply", "recommended_business_action"
    )


def grounded_replies(spark, folder):
    rows = replies.grounded_replies(_answered(spark, folder))
    return _tidy(
        rows.select(
            "query_id", "generated_agent_reply", F.array_join("used_document_ids", ",").alias("used_document_ids"),
            "fallback_used", "retrieval_confidence", "source_groundedness_flag", "llm_status",
        )
    )


def prompt_messages(spark, folder):
    """Chat messages for every document of the table, from sources of the whole knowledge base."""
    queries, index, hits = _documents_asking(spark, folder)
    rows = replies.prompts(retrieval.answered(queries.select("query_id", "query"), hits, index))
    return rows.select("query_id", F.inline("messages"))


def citation_guard(spark, folder):
    """Completions derived from the documents: some cite the document they answer, some do not."""
    queries, index, hits = _documents_asking(spark, folder)
    # No text of a document found is read.
    rows = queries.join(retrieval.with_documents(hits, index, fields=("document_id", "score")), "query_id", "left")
    docs = register(spark, folder)["documents"]
    completions = docs.select(
        F.col("doc_id").alias("query_id"),
        F.when(F.col("n_chars") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" Kaynak "), F.col("doc_id").cast("string"), F.lit(": "), F.col("source"), F.lit(" ")))
        .alias("text"),
    )
    guarded = replies.citation_guard(rows, completions)
    return guarded.select(
        "query_id", "generated_agent_reply", F.array_join("used_document_ids", ",").alias("used_document_ids"),
        "llm_status",
    )


def _reply_rows(spark, folder):
    return replies.reply_rows(
        replies.grounded_replies(_answered(spark, folder)), ("query_id", "problem_category")
    )


def reply_eval(spark, folder):
    return _tidy(_reply_rows(spark, folder))


def reply_metrics(spark, folder):
    return _tidy(replies.reply_metrics(_reply_rows(spark, folder)))


def reply_failures(spark, folder):
    return _tidy(replies.reply_failures(_reply_rows(spark, folder), keys=("query_id",)))


def picked_rows(spark, folder):
    features, written = _features_and_texts(spark, folder), _features(spark, folder)
    rows = picks.picked_rows(features, _index(spark, folder), written=written)
    flat = rows.withColumns(
        {
            "risk_signals": F.array_join("risk_signals", "|"),
            "document_ids": F.array_join("retrieved_documents.document_id", ","),
            "top_score": F.col("retrieved_documents")[0]["score"],
            "content_chars": F.aggregate("retrieved_documents", F.lit(0), lambda n, d: n + F.length(d["content"])),
        }
    )
    return _tidy(flat.drop("retrieved_documents"))


QUERIES = {
    "lifecycle_dense": lifecycle_dense,
    "lifecycle_sparse": lifecycle_sparse,
    "lifecycle_counts": lifecycle_counts,
    "customer_profile": customer_profile,
    "monthly_kpi": monthly_kpi,
    "category_counts": category_counts,
    "subcategory_counts": subcategory_counts,
    "data_scale": data_scale,
    "bill_shock": bill_shock,
    "bill_shock_summary": bill_shock_summary,
    "safe_divide": revenue_per_usage,
    "month_index": month_indexes,
    "repeat_flags": repeat_flags,
    "repeat_summary": repeat_summary,
    "repeat_by_category": repeat_by_category,
    "flatten_conversations": flatten_conversations,
    "normalize_text": normalize_text,
    "phrase_counts": phrase_counts,
    "category_terms": category_terms,
    "complaint_signals": complaint_signals,
    "signal_distribution": signal_distribution,
    "signal_by_category": signal_by_category,
    "friction": friction_scores,
    "friction_distribution": friction_distribution,
    "friction_by_category": friction_by_category,
    "friction_by_priority": friction_by_priority,
    "mismatch_summary": mismatch_summary,
    "feature_table": feature_table,
    "risk_priority": risk_priority,
    "routing": routing_rules,
    "risk_level_counts": _counts("business_risk_level"),
    "priority_counts": _counts("priority_level"),
    "risk_band_counts": _counts("risk_score_band"),
    "routing_distribution": _counts("recommended_queue"),
    "risk_component_summary": risk_component_summary,
    "priority_by_category": priority_by_category,
    "high_value_at_risk": high_value_at_risk,
    "high_value_at_risk_summary": high_value_at_risk_summary,
    "high_value_priority": high_value_priority,
    "high_value_revenue": high_value_revenue,
    "findings": executive_findings,
    "kpi_strip": kpi_strip,
    "customer_month": customer_months,
    "time_split": time_split,
    "ranking_metrics": score_quality,
    "topk_metrics": topk_metrics,
    "precision_at_k": precision_at_k,
    "revenue_capture": revenue_capture,
    "confusion_top5": confusion_top5,
    "decile_table": decile_table,
    "calibration_table": calibration_table,
    "risk_percentile": risk_percentile,
    "baseline_metrics": baseline_metrics,
    "train_lr": _train("logistic_regression"),
    "train_gbt": _train("hist_gradient_boosting"),
    "train_rf": _train("random_forest"),
    "model_metrics": model_metrics,
    "model_selection": model_selection,
    "feature_importance": feature_importance,
    "score_batch": score_batch,
    "kb_sections": kb_sections,
    "query_texts": query_texts,
    "tfidf_topk": _topk(knowledge.TFIDF, 5),
    "bm25_topk": _topk(knowledge.BM25, 5),
    "hybrid_topk": _topk(retrieval.HYBRID, 5),
    "retrieval_eval": retrieval_eval,
    "retrieval_metrics": retrieval_metrics,
    "template_replies": template_replies,
    "grounded_replies": grounded_replies,
    "prompts": prompt_messages,
    "citation_guard": citation_guard,
    "reply_eval": reply_eval,
    "reply_metrics": reply_metrics,
    "reply_failures": reply_failures,
    "picked_rows": picked_rows,
}

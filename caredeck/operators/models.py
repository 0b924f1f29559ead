"""Risk models as Spark ML pipelines: preprocessing, three classifiers, choice, scoring."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from .customer_month import TARGET, dominant
from .ranking import quantiles, with_percentile

# Names of the models' features and of the models.
CATEGORICAL = ("dominant_problem_category", "dominant_problem_subcategory", "lifecycle_status_v2")
NUMERIC = (
    "complaint_count", "unique_problem_category_count", "max_friction_score_v3", "max_business_risk_score",
    "max_priority_rank", "any_has_churn_risk", "any_has_billing_dispute", "any_has_technical_outage",
    "any_has_legal_risk", "any_potential_agent_mismatch", "any_bill_shock_flag", "any_repeat_complaint_next_2m",
    "high_value_customer", "total_revenue", "avg_bill", "avg_data_usage", "months_active", "active_month_ratio",
    "months_since_last_spending", "inactive_gap_count", "reactivation_count", "previous_bill_amount",
    "rolling_3m_avg_bill", "bill_change_abs", "bill_change_pct",
)
FEATURES = NUMERIC + CATEGORICAL
BASELINE = "business_risk_baseline"
MODELS = ("logistic_regression", "hist_gradient_boosting", "random_forest")
SEED = 42


def with_class_weights(train):
    """Training rows weighted so that both classes weigh the same; also the row count."""
    sizes = {row[TARGET]: row["n"] for row in train.groupBy(TARGET).agg(F.count("*").alias("n")).collect()}
    rows = sum(sizes.values())
    weight = F.lit(None).cast("double")
    for label, n in sizes.items():
        weight = F.when(F.col(TARGET) == label, rows / (len(sizes) * n)).otherwise(weight)
    return train.withColumn("weight", weight), rows


def fill_values(train):
    """Median per numeric and most frequent value per categorical column of the training rows."""
    medians = {row["column"]: row["value"] for row in quantiles(train, {c: [0.5] for c in NUMERIC}).collect()}
    modes = train.agg(*[dominant(c).alias(c) for c in CATEGORICAL]).first().asDict()
    return medians, modes


def preprocessing(train, rows, scale, fills=None):
    """Stages that fill gaps, one-hot the categories (unknown: all zero) and build `features`.

    A numeric column without any training value is left out.
    """
    medians, modes = fills or fill_values(train)
    numeric = [c for c in NUMERIC if c in medians]
    filled = [f"coalesce(cast(`{c}` as double), double('{medians[c]!r}')) as `{c}_filled`" for c in numeric]
    # A SQL string literal doubles its quotes and escapes its backslashes.
    quoted = {c: modes[c].replace("\\", "\\\\").replace("'", "\\'") for c in CATEGORICAL}
    filled += [f"coalesce(`{c}`, '{quoted[c]}') as `{c}_filled`" for c in CATEGORICAL]
    codes = [f"{c}_code" for c in CATEGORICAL]
    onehots = [f"{c}_onehot" for c in CATEGORICAL]
    stages = [
        SQLTransformer(statement=f"select *, {', '.join(filled)} from __THIS__"),
        VectorAssembler(inputCols=[f"{c}_filled" for c in numeric], outputCol="numbers"),
        StringIndexer(
            inputCols=[f"{c}_filled" for c in CATEGORICAL],
            outputCols=codes,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        # The one slot dropped is that of unseen values.
        OneHotEncoder(inputCols=codes, outputCols=onehots, dropLast=True),
    ]
    numbers = "numbers"
    if scale:
        # Spark divides by the sample deviation; the factor turns it into the population one.
        factor = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
        stages += [
            StandardScaler(inputCol="numbers", outputCol="standard", withMean=True, withStd=True),
            ElementwiseProduct(
                inputCol="standard", outputCol="scaled", scalingVec=Vectors.dense([factor] * len(numeric))
            ),
        ]
        numbers = "scaled"
    return [*stages, VectorAssembler(inputCols=[numbers, *onehots], outputCol="features")]


def classifier(name, rows):
    common = {"labelCol": TARGET, "featuresCol": "features", "weightCol": "weight"}
    if name == "logistic_regression":
        # C = 1 on a weighted sum equals regParam = 1/rows on Spark's weighted mean.
        return LogisticRegression(
            maxIter=1000, regParam=1.0 / rows, elasticNetParam=0.0, standardization=False, tol=1e-8, **common
        )
    if name == "hist_gradient_boosting":
        return GBTClassifier(
            maxIter=100, stepSize=0.1, maxDepth=5, maxBins=255, minInstancesPerNode=20, seed=SEED, **common
        )
    if name == "random_forest":
        return RandomForestClassifier(
            numTrees=200, maxDepth=12, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=SEED, **common
        )
    raise ValueError(f"unknown model: {name}")


def fit_models(train, names=MODELS):
    """Fitted pipelines by name. `train` is read many times: pass a written table."""
    weighted, rows = with_class_weights(train)
    fills = fill_values(train)
    fitted = {}
    for name in names:
        stages = preprocessing(train, rows, name == "logistic_regression", fills)
        fitted[name] = Pipeline(stages=[*stages, classifier(name, rows)]).fit(weighted)
    return fitted


def score_rows(model, table, name="score"):
    """Input rows with the model's probability of the target."""
    scored = model.transform(table).withColumn("_p", vector_to_array("probability")[1])
    return scored.select(*table.columns, F.col("_p").alias(name))


def predict(model, table, by=()):
    """Rows with risk_probability and the percentile of it within the batch (or each `by` group)."""
    return with_percentile(score_rows(model, table, "risk_probability"), "risk_probability", by)


def top_risk(predicted, limit=None, keys=("customer_id", "billing_year_month")):
    """The rows, riskiest first; with `limit`, a report of at most so many."""
    ordered = predicted.orderBy(F.desc("risk_probability"), *keys)
    return ordered if limit is None else ordered.limit(limit)


def choose_model(metrics):
    """Name of the best trainable model on the validation split.

    The rule baseline is measured beside the models but cannot be saved, so the best trainable
    model is taken also when the baseline ranks first.
    """
    def merit(row):
        return (
            (row["average_precision_pr_auc"] or 0.0)
            + (row["precision_top_5pct"] or 0.0)
            + (row["lift_top_5pct"] or 0.0) / 10
        )

    rows = metrics.where((F.col("split") == "validation") & (F.col("model") != BASELINE)).collect()
    return min(rows, key=lambda row: (-merit(row), row["model"]))["model"]


def feature_importance(model, table):
    """Feature and importance, largest absolute value first; null for boosted trees.

    Names and weights are model-sized, so they are read on the driver.
    """
    spark = table.sparkSession
    fitted = model.stages[-1]
    schema = "feature string, importance double"
    if hasattr(fitted, "coefficients"):
        weights = fitted.coefficients.toArray()
    elif hasattr(fitted, "getNumTrees") and type(fitted).__name__.startswith("RandomForest"):
        weights = fitted.featureImportances.toArray()
    else:
        return spark.createDataFrame([(name, None) for name in FEATURES], schema)
    names = feature_names(model)
    frame = spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)], schema)
    return frame.orderBy(F.desc(F.abs("importance")), "feature")


def feature_names(model):
    """Names of the vector's slots, from the fitted stages."""
    numbers = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    names = [f"num__{c.removesuffix('_filled')}" for c in numbers]
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    for column, labels in zip(CATEGORICAL, indexer.labelsArray):
        names += [f"cat__{column}_{label}" for label in labels]
    return names


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(path):
    return PipelineModel.load(path)

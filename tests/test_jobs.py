import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from caredeck.operators import completions, models
from caredeck.plans import jobs
from caredeck.sources.publish import prune, published
from caredeck.sources.readers import load_or_build, read_json_lines, read_reference, read_table
from caredeck.sources.sinks import save_table
from caredeck.streaming.incremental import append_signals
from caredeck.streaming.scoring import score_arrivals


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_json_lines(spark, tmp_path):
    lines = '{"customer_id": "a", "city": "x", "birth_year": 1990}\n\n{"customer_id": "b", "city": null, "birth_year": null}\n'
    assert read_json_lines(spark, write(tmp_path / "c.json", lines), "customer").count() == 2
    (tmp_path / "c.json.gz").write_bytes(gzip.compress(lines.encode()))
    packed = read_json_lines(spark, str(tmp_path / "c.json.gz"), "customer")
    assert packed.count() == 2 and packed.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_lines(spark, write(tmp_path / "bad.json", lines + "{oops\n"), "customer").collect()
    with pytest.raises(ValueError, match="birth_year"):
        read_json_lines(spark, write(tmp_path / "less.json", '{"customer_id": "a", "city": "x"}\n'), "customer")
    late = '{"customer_id": "a", "city": "x"}\n{"customer_id": "b", "birth_year": 1990}\n'
    rows = read_json_lines(spark, write(tmp_path / "late.json", late), "customer").orderBy("customer_id").collect()
    assert [tuple(r) for r in rows] == [("a", "x", None), ("b", None, 1990)]
    with pytest.raises(Exception, match="(?i)path"):
        read_json_lines(spark, str(tmp_path / "absent.json"), "customer")


def test_reference_objects(spark, tmp_path):
    objects = [{"document_id": "1", "content": "a } b { c\n} d"}, {"document_id": "2", "content": "ç"}]
    pretty = "\n".join(json.dumps(o, ensure_ascii=False, indent=2) for o in objects) + "\n"
    path = write(tmp_path / "r.json", pretty)
    expected = [(o["document_id"], o["content"]) for o in objects]
    for flag in (True, False):
        assert sorted(tuple(r) for r in read_reference(spark, path, flag).collect()) == expected
    one_line = write(tmp_path / "o.json", "".join(map(json.dumps, objects)))
    assert sorted(tuple(r) for r in read_reference(spark, one_line).collect()) == expected
    with pytest.raises(Exception, match="(?i)malformed|parse|record"):
        read_reference(spark, one_line, pretty=True).collect()


def test_csv_keeps_quotes_and_line_ends(spark, tmp_path):
    import csv

    path = save_table(spark.createDataFrame([("a \"b\", c", "x\ny")], "t string, u string").coalesce(1), str(tmp_path / "q.csv"))
    part = next((tmp_path / "q.csv").glob("part-*.csv"))
    assert list(csv.reader(part.open(newline=""))) == [["t", "u"], ["a \"b\", c", "x\ny"]] and path.endswith("q.csv")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, [("x", 2)])], "a int, b array<struct<c:string,d:int>>")
    assert spark.read.parquet(save_table(rows, str(tmp_path / "t.parquet"))).collect() == rows.collect()
    assert spark.read.json(save_table(rows, str(tmp_path / "t.json"))).first()["b"][0]["c"] == "x"
    assert spark.read.csv(save_table(rows.select("a"), str(tmp_path / "t.csv")), header=True).first()["a"] == "1"


def make_raw(folder, customers=60, months=16):
    """A small telecom: some customers stop paying, which is what the models learn."""
    rng = random.Random(1)
    texts = ["fazla ücret yazılmış", "internet yok", "hattımı taşıyacağım", "merhaba", "bıktım, yeter artık", "yine aynı sorun"]
    people, bills, complaints = [], [], []
    for c in range(customers):
        people.append({"customer_id": f"c{c}", "city": "x", "birth_year": 1950 + c % 50})
        last = months if c % 3 else rng.randint(4, months)
        for m in range(last):
            label = f"{2023 + m // 12}-{m % 12 + 1:02d}"
            bills.append({"customer_id": f"c{c}", "billing_year_month": label, "bill_amount": rng.choice([50.0, 80.0, 120.0]), "data_usage": 1.0})
            if rng.random() < 0.5:
                turns = [
                    {"history_id": 1, "site": "customer", "text": rng.choice(texts)},
                    {"history_id": 2, "site": "agent", "text": "modem"},
                ] * rng.randint(1, 3)
                complaints.append({
                    "customer_id": f"c{c}", "billing_year_month": label, "problem_category": rng.choice(["billing", "data"]),
                    "problem_subcategory": "s", "chat_history": turns,
                })
    pages = [{"document_id": f"k{i}", "content": f"# Belge {i}\nKategori: {'Faturalandırma' if i % 2 else 'Mobil İnternet'}\n{t}"} for i, t in enumerate(texts)]
    for name, rows in (("customer", people), ("spending", bills), ("complaints", complaints)):
        (folder / f"{name}.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    (folder / "reference.json").write_text("\n".join(json.dumps(p, ensure_ascii=False, indent=1) for p in pages), encoding="utf-8")
    return {n: str(folder / f"{n}.json") for n in ("customer", "spending", "complaints", "reference")}, len(complaints)


def test_jobs_end_to_end(spark, tmp_path, monkeypatch):
    raw, complaints = make_raw(tmp_path)
    processed, out = str(tmp_path / "processed"), str(tmp_path / "out")
    with pytest.raises(FileNotFoundError, match="features job"):
        jobs.training_job(spark, processed, out, str(tmp_path / "model"))
    jobs.features_job(spark, raw, processed, out)
    features = read_table(spark, f"{processed}/{jobs.FEATURES}", "")
    assert features.count() == complaints
    bad = features.where(
        (~F.col("friction_score_v3").between(0, 15)) | (~F.col("business_risk_score").between(0, 165))
    )
    assert bad.count() == 0
    assert spark.read.json(f"{out}/demo_cases/final_demo_cases.json").count() == 5
    assert spark.read.csv(f"{out}/final/final_executive_summary.csv", header=True).count() == 9
    # Existing tables are reused: the raw files may be gone.
    reused = load_or_build(spark, {name: "/nowhere" for name in raw}, processed)
    assert reused.complaints.count() == complaints

    small = {"hist_gradient_boosting": ("maxIter", 3), "random_forest": ("numTrees", 5)}
    make = models.classifier
    monkeypatch.setattr(
        models, "classifier",
        lambda name, rows: make(name, rows).setParams(**{small[name][0]: small[name][1]}) if name in small else make(name, rows),
    )
    best = jobs.training_job(spark, processed, out, str(tmp_path / "model"))
    assert best in models.MODELS
    metrics = spark.read.csv(f"{out}/tables/retention_model_metrics.csv", header=True, inferSchema=True)
    assert metrics.count() == 8
    assert metrics.where("recall_top_10pct < 0 or recall_top_10pct > 1").count() == 0
    months = read_table(spark, f"{processed}/{jobs.MONTHS}", "")
    predicted = models.predict(models.load_model(str(tmp_path / "model")), months)
    assert predicted.where("risk_probability between 0 and 1 and risk_percentile between 0 and 1").count() == months.count()

    strip = spark.read.csv(f"{out}/tables/kpi_strip.csv", header=True, inferSchema=True).first()
    chosen = metrics.where((F.col("model") == best) & (F.col("split") == "test")).first()
    assert strip["customers"] == 60 and strip["precision_top_5pct"] == pytest.approx(chosen["precision_top_5pct"])
    assert strip["hit_at_3"] is not None

    jobs.scoring_job(spark, processed, out, str(tmp_path / "model"))
    scores = spark.read.parquet(f"{out}/scores/customer_month_scores.parquet")
    assert scores.count() == months.count() and {r["split"] for r in scores.select("split").distinct().collect()} == {"train", "validation", "test", "unlabelled"}
    again = {(r["customer_id"], r["billing_year_month"]): r["risk_probability"] for r in predicted.collect()}
    for r in scores.collect():
        assert r["risk_probability"] == pytest.approx(again[r["customer_id"], r["billing_year_month"]])

    jobs.retrieval_job(spark, processed, out, sample_size=20)
    assert spark.read.csv(f"{out}/tables/rag_eval_sample.csv", header=True, multiLine=True).count() == 20

    ledger = tmp_path / "ledger"
    jobs.replies_job(spark, processed, out, str(ledger))
    prompts, asked = spark.read.parquet(f"{ledger}/prompts.parquet"), spark.read.json(f"{ledger}/requests.json")
    assert prompts.count() == complaints and asked.count() == prompts.select("request_id").distinct().count() < complaints
    ids = sorted(r["request_id"] for r in asked.select("request_id").collect())
    (ledger / "completions").mkdir()
    back = [{"request_id": ids[0], "text": " ".join(f"k{i}" for i in range(6))}, {"request_id": ids[1], "error": "Timeout"}, {"request_id": ids[2], "text": "?"}]
    write(ledger / "completions" / "a.json", "\n".join(map(json.dumps, back)))
    jobs.replies_job(spark, processed, out, str(ledger))
    left = {r["request_id"] for r in spark.read.json(f"{ledger}/requests.json").collect()}
    assert left == set(ids) - {ids[0], ids[2]}
    prompts = spark.read.parquet(f"{ledger}/prompts.parquet")
    written = spark.read.parquet(f"{out}/replies/complaint_replies.parquet").join(prompts.select(jobs.KEY, "request_id"), jobs.KEY)
    status = {(r["request_id"], r["llm_status"]) for r in written.select("request_id", "llm_status").distinct().collect()}
    assert {s for i, s in status if i == ids[0]} <= {"llm_generated", "template_fallback"}
    assert {s for i, s in status if i == ids[1]} <= {"llm_error_template_fallback:Timeout", "template_fallback"}
    assert written.count() == complaints


def test_a_rebuild_that_dies_leaves_the_old_set(spark, tmp_path, monkeypatch):
    raw, _ = make_raw(tmp_path, customers=5)
    processed = str(tmp_path / "processed")
    before = load_or_build(spark, raw, processed)
    rows = {name: getattr(before, name).count() for name in raw}
    (tmp_path / "spending.json").write_text('{"customer_id": "new", "billing_year_month": "2024-01", "bill_amount": 1.0, "data_usage": 1.0}\n')
    (tmp_path / "reference.json").write_text('{"document_id": "1", "content"')  # fails while the last table is written
    with pytest.raises(Exception, match="(?i)expecting|delimiter|json"):
        load_or_build(spark, raw, processed, rebuild=True)
    after = load_or_build(spark, {name: "/nowhere" for name in raw}, processed)
    assert {name: getattr(after, name).count() for name in raw} == rows
    (tmp_path / "reference.json").write_text('{"document_id": "1", "content": "x"}')
    rebuilt = load_or_build(spark, raw, processed, rebuild=True)
    assert rebuilt.spending.count() == 1 and rebuilt.reference.count() == 1
    assert before.spending.count() == rows["spending"]  # an open reader keeps its set
    prune(spark, processed, keep=1)
    assert load_or_build(spark, raw, processed).spending.count() == 1
    assert published(spark, processed) is not None and published(spark, str(tmp_path / "none")) is None


def test_requests_are_asked_once_until_answered(spark):
    prompts = spark.createDataFrame(
        [(i, [("system", "s"), ("user", f"q{i % 3}")]) for i in range(30)] + [(None, [("system", "s"), ("user", "q0")])],
        "k int, messages array<struct<role:string,content:string>>",
    )
    named = completions.with_request_ids(prompts)
    first, second, third = (named.where(F.col("k") == i).first()["request_id"] for i in range(3))
    back = spark.createDataFrame(
        [(first, "yes", None), (first, None, "Late"), (second, None, "Timeout"), (None, "lost", None)], "request_id string, text string, error string"
    )
    assert {r["request_id"] for r in completions.missing_requests(named, back).collect()} == {second, third}
    got = completions.with_completions(named, back, "k").collect()
    assert len(got) == 21 and {(r["text"], r["error"]) for r in got} == {("yes", None), (None, "Timeout")}
    assert completions.missing_requests(named, back.limit(0)).count() == 3


def test_arrivals_are_scored_once(spark, tmp_path):
    """A batch that is run again replaces its own folder; rows keep their probability."""
    names = [*models.NUMERIC, *models.CATEGORICAL, "no_billable_activity_next_2m"]
    rows = [tuple([float(i + j) for j in range(len(models.NUMERIC))] + ["ab"[i % 2]] * len(models.CATEGORICAL) + [i % 2]) for i in range(12)]
    schema = ", ".join([f"{c} double" for c in models.NUMERIC] + [f"{c} string" for c in models.CATEGORICAL] + [f"{names[-1]} int"])
    table = spark.createDataFrame(rows, schema)
    model = models.fit_models(table, ["logistic_regression"])["logistic_regression"]
    models.save_model(model, str(tmp_path / "model"))
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    table.limit(5).write.parquet(folder)
    args = (spark, folder, table.schema, str(tmp_path / "model"), out, checkpoint)
    score_arrivals(*args)
    table.limit(7).write.mode("append").parquet(folder)
    score_arrivals(*args)
    score_arrivals(*args)
    scored = spark.read.parquet(out)
    assert scored.count() == 12 and scored.where("risk_probability between 0 and 1").count() == 12


def test_logistic_preprocessing(spark):
    """Median filling, population deviation, and all-zero slots for an unseen category."""
    base = {c: [1.0, 2.0, 3.0, None] for c in models.NUMERIC}
    cats = {c: ["a", "b", "a", "a"] for c in models.CATEGORICAL}
    names = [*models.NUMERIC, *models.CATEGORICAL, "no_billable_activity_next_2m"]
    rows = list(zip(*base.values(), *cats.values(), [0, 1, 1, 0]))
    schema = ", ".join([f"{c} double" for c in models.NUMERIC] + [f"{c} string" for c in models.CATEGORICAL] + [f"{names[-1]} int"])
    train = spark.createDataFrame(rows, schema)
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=models.preprocessing(train, 4, scale=True)).fit(train)
    unseen = train.withColumn(models.CATEGORICAL[0], F.lit("zzz")).limit(1)
    vector = fitted.transform(unseen).first()["features"].toArray()
    assert vector[0] == pytest.approx(-1 / 0.5 ** 0.5)  # values 1, 2, 3, 2: deviation sqrt(1/2)
    assert list(vector[len(models.NUMERIC):]) == [0, 0, 1, 0, 1, 0]
    weighted, rows = models.with_class_weights(train)
    assert rows == 4 and {r["weight"] for r in weighted.collect()} == {1.0}


def test_stream_equals_batch(spark, tmp_path):
    raw, complaints = make_raw(tmp_path, customers=10)
    folder = tmp_path / "arriving"
    folder.mkdir()
    lines = (tmp_path / "complaints.json").read_text(encoding="utf-8").splitlines()
    out, checkpoint = str(tmp_path / "signals"), str(tmp_path / "checkpoint")
    for part in (0, 1):
        (folder / f"{part}.json").write_text("\n".join(lines[part::2]), encoding="utf-8")
        append_signals(spark, str(folder), out, checkpoint)
    assert spark.read.parquet(out).count() == complaints


def test_texts_do_not_move_to_their_features(spark):
    """Signals are read off the texts before any exchange of complaints."""
    from caredeck.plans.features import build_features

    complaints = spark.createDataFrame(
        [(1, 1, "2024-01", "billing", "a", 3, "iade istiyorum", "fatura", "iade istiyorum fatura")],
        "complaint_id long, customer_id long, billing_year_month string, problem_category string, problem_subcategory string,"
        " turn_count int, customer_text string, agent_text string, full_text string",
    )
    customer = spark.createDataFrame([(1, "x", 1990)], "customer_id long, city string, birth_year int")
    spending = spark.createDataFrame(
        [(1, "2024-01", 5.0, 1.0)], "customer_id long, billing_year_month string, bill_amount double, data_usage double"
    )
    table = build_features(customer, spending, complaints).features
    assert table.first()["has_billing_dispute"] == 1
    texts = ("customer_text", "agent_text", "full_text")
    plan = table.drop(*texts)._jdf.queryExecution().optimizedPlan().toString()
    joined = plan.index("Join ")
    assert "regexp_extract_all" not in plan[:joined] and "regexp_extract_all" in plan[joined:]

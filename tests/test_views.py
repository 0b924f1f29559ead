from datetime import datetime

from workload import views

TABLES = {
    "nation": "n_nationkey long, n_name string", "customer": "c_custkey long, c_nationkey long",
    "orders": "o_custkey long, o_orderdate date, o_totalprice double",
    "documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, toxic int",
}


def test_texts_too_large_for_a_broadcast_meet_complaints_in_many_tasks(spark, tmp_path):
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    events = [(i, i % 5, datetime(2024, 1, 1), "error", 1.0, f"k{i % 10}") for i in range(40)]
    schema = "event_id long, user_id long, ts timestamp, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{tmp_path}/events.parquet")
    turns = [(c, t, "user" if t % 2 else "agent", f"c{c} t{t}") for c in range(20) for t in range(3)]
    turns = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = views.register(spark, str(tmp_path))["v_complaints"].select("complaint_id", "full_text")
        assert told.rdd.getNumPartitions() >= views.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        rows = {r["complaint_id"]: r["full_text"] for r in told.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == 40
    assert all(f" c{i % 20} t1 " in f" {text.replace('.', ' ')} " for i, text in rows.items())
    assert all(f"c{i % 20} t0 c{i % 20} t2" in text for i, text in rows.items())

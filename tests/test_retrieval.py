import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caredeck.operators import knowledge, replies, retrieval
from caredeck.operators.picks import choose

from .helpers import by

PAGE = """# **Fatura İtirazı** rehberi
Kategori: **Faturalandırma**
Sorun: Yüksek fatura
## Çözüm Adımları
1. Kontrol
2. İade
## Notlar
son"""


def reference(spark, texts):
    return spark.createDataFrame(texts, "document_id string, content string")


def test_sections(spark):
    got = by(
        knowledge.parse_sections(reference(spark, [("k1", PAGE), ("k2", "düz metin"), ("k3", None)])), "document_id",
        "title", "category", "problem", "solution", "content_norm",
    )
    assert got["k1"][:4] == ("Fatura İtirazı rehberi", "faturalandirma", "Yüksek fatura", "1. Kontrol\n2. İade")
    assert got["k2"] == ("k2", "", "", "", "k2 duz metin")
    assert got["k3"][4] == ""


def bare_index(spark, texts):
    """An index whose searched text is exactly the content."""
    docs = [(i, d, t, "", t, t) for i, (d, t) in enumerate(texts)]
    schema = "doc_no long, document_id string, title string, category string, content string, content_norm string"
    return knowledge.KnowledgeIndex(spark.createDataFrame(docs, schema))


def queries(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id int, query string")


def ranked(df):
    rows = sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"]))
    return [(r["query_id"], r["document_id"], r["score"]) for r in rows]


@pytest.fixture(scope="module")
def small(spark):
    return bare_index(spark, [("D1", "fatura iade"), ("D2", "modem sinyal"), ("D3", "fatura fatura")])


def test_cosine(spark, small):
    got = ranked(retrieval.retrieve(small, queries(spark, ["iade", "fatura", "yok"]), 3))
    assert [(q, d) for q, d, _ in got] == [
        (0, "D1"), (0, "D2"), (0, "D3"), (1, "D3"), (1, "D1"), (1, "D2"), (2, "D1"), (2, "D2"), (2, "D3"),
    ]
    assert [s for *_, s in got] == pytest.approx([0.622766, 0, 0, 0.835591, 0.473630, 0, 0, 0, 0], abs=1e-6)


def test_bm25_floor(spark, small):
    idf = {round(r["idf"], 6) for r in small.vocabulary(knowledge.BM25).collect()}
    assert idf == {0.510826, round(0.25 * 0.255413, 6)}


def brute_bm25(docs, query):
    tokens = [d.split() for d in docs]
    n, mean = len(docs), sum(map(len, tokens)) / len(docs)
    df = Counter(t for doc in tokens for t in set(doc))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    return [
        sum(
            idf.get(t, 0) * doc.count(t) * 2.5 / (doc.count(t) + 1.5 * (0.25 + 0.75 * len(doc) / mean))
            for t in query.split()
        )
        for doc in tokens
    ]


def brute_cosine(docs, query):
    def terms(text):
        words = [w for w in text.split() if len(w) > 1]
        return Counter(words + [" ".join(p) for p in zip(words, words[1:])])

    bags = [terms(d) for d in docs]
    df = Counter(t for bag in bags for t in bag)

    def vector(bag):
        w = {t: c * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, c in bag.items() if t in df}
        norm = math.sqrt(sum(v * v for v in w.values())) or 1
        return {t: v / norm for t, v in w.items()}

    q = vector(terms(query))
    return [sum(q[t] * v for t, v in vector(bag).items() if t in q) for bag in bags]


@pytest.mark.parametrize("block, seeds", [(1_000_000, 2_000), (40, 3)])
@pytest.mark.parametrize("method", [knowledge.TFIDF, knowledge.BM25, retrieval.HYBRID])
def test_top_k_equals_brute_force(spark, monkeypatch, method, block, seeds):
    """All queries in one block, and several blocks with few seeds."""
    monkeypatch.setattr(retrieval, "BLOCK_TERMS", block)
    monkeypatch.setattr(retrieval, "SEED_POSTINGS", seeds)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(25)] + ["ortak"] * 8
    docs = [" ".join(rng.choices(words, k=rng.randint(1, 20))) for _ in range(30)]
    asked = [" ".join(rng.choices(words + ["yabanci"], k=rng.randint(1, 8))) for _ in range(10)] + ["yabanci", ""]
    index = bare_index(spark, [(f"d{i:02d}", d) for i, d in enumerate(docs)])
    expected = []
    for q, text in enumerate(asked):
        cosine, bm = brute_cosine(docs, text), brute_bm25(docs, text)
        scores = {"tfidf": cosine, "bm25": bm, "hybrid": cosine}[method]
        if method == retrieval.HYBRID and max(bm) > 0:
            scores = [0.5 * c + 0.5 * b / max(bm) for c, b in zip(cosine, bm)]
        order = sorted(range(len(docs)), key=lambda i: (-round(scores[i], 9), i))[:4]
        expected += [(q, f"d{i:02d}", scores[i]) for i in order]
    got = ranked(retrieval.retrieve(index, queries(spark, asked), 4, method))
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert [g[2] for g in got] == pytest.approx([e[2] for e in expected], abs=1e-9)


@pytest.mark.parametrize("method", [knowledge.TFIDF, knowledge.BM25, retrieval.HYBRID])
def test_null_and_repeated_keys_by_size(spark, monkeypatch, method):
    """Rows with a null or a shared key are queries of their own, in one block or several."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(25)]
    index = bare_index(spark, [(f"d{i:02d}", " ".join(rng.choices(words, k=12))) for i in range(30)])
    asked = [(key, " ".join(rng.choices(words, k=5))) for key in (1, 1, 1, 2, None, None, None)]
    frame = spark.createDataFrame(asked, "query_id long, query string")

    def found(block):
        monkeypatch.setattr(retrieval, "BLOCK_TERMS", block)
        rows = retrieval.retrieve(index, frame, 2, method).collect()
        return sorted(((r["query_id"] or 0, r["rank"], r["document_id"], round(r["score"], 9)) for r in rows))

    whole, cut = found(1_000_000), found(8)
    assert len(whole) == 2 * len(asked)
    assert cut == whole


def test_query_text(spark):
    row = spark.createDataFrame(
        [("data", "yavas", "ilk", "x" * 3000), (None, None, None, None)],
        "problem_category string, problem_subcategory string, first_customer_message string, customer_text string",
    )
    first, empty = [r["q"] for r in row.select(retrieval.complaint_query(row.columns).alias("q")).collect()]
    assert first.startswith("data mobil internet mobil veri internet data yavas ilk xxx") and len(first) == 3055
    assert empty.strip() == ""


def test_quality_at_depth(spark, monkeypatch):
    index = bare_index(spark, [(f"d{i}", f"ara {'fatura' if i in (1, 2) else 'baska'} {'x ' * i}") for i in range(5)])
    rows = spark.createDataFrame(
        [(0, "billing", "", "m", "t")],
        "query_id int, problem_category string, problem_subcategory string, first_customer_message string, customer_text string",
    )
    hits = spark.createDataFrame(
        [(0, r, f"d{r - 1}", 1.0 / r) for r in range(1, 6)], "query_id int, rank int, document_id string, score double"
    )
    monkeypatch.setattr(retrieval, "retrieve", lambda *a, **k: hits)
    got = retrieval.evaluate_retrieval(index, rows).first()
    assert (got["hit_at_1"], got["hit_at_3"], got["hit_at_5"]) == (0, 1, 1)
    assert (got["precision_at_1"], got["mrr_at_5"], got["top1_document_id"]) == (0, 0.5, "d0")
    assert got["precision_at_3"] == pytest.approx(2 / 3)
    assert got["ndcg_at_5"] == pytest.approx(1.130930, abs=1e-6)


def test_search_is_relational(spark):
    index = bare_index(spark, [(f"d{i}", f"w{i} w{i % 7} ortak") for i in range(40)])
    plan = retrieval.retrieve(index, queries(spark, ["w1 ortak", "w2"]), 3, retrieval.HYBRID)._jdf.queryExecution().toString()
    for name in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert name not in plan


def test_frequent_terms_are_skipped_but_counted(spark, monkeypatch):
    """A term of every document can't lift one to the bound, and still adds to the survivors' scores."""
    monkeypatch.setattr(retrieval, "SEED_POSTINGS", 1)
    monkeypatch.setattr(retrieval, "SKIPPED_SHARE", 1.0)
    docs = [f"nadir{i // 5} ortak {'dolgu ' * (i % 3)}x{i}" for i in range(200)]
    index = bare_index(spark, [(f"d{i:03d}", d) for i, d in enumerate(docs)])
    seen = []
    kept = retrieval._sums
    monkeypatch.setattr(retrieval, "_sums", lambda p, t: seen.append(t) or kept(p, t))
    got = ranked(retrieval.retrieve(index, queries(spark, ["nadir3 ortak dolgu"]), 3, knowledge.BM25))
    scores = brute_bm25(docs, "nadir3 ortak dolgu")
    order = sorted(range(200), key=lambda i: (-round(scores[i], 9), i))[:3]
    assert [(d, round(s, 9)) for _, d, s in got] == [(f"d{i:03d}", round(scores[i], 9)) for i in order]
    assert seen[-1].count() == 1  # of three terms


def test_sample(spark):
    rows = spark.range(50).select(F.col("id").alias("query_id"), F.lit("a").alias("problem_category"))
    once = {r["query_id"] for r in retrieval.sample_rows(rows, 10).collect()}
    assert len(once) == 10 and once == {r["query_id"] for r in retrieval.sample_rows(rows.repartition(3), 10).collect()}
    assert retrieval.sample_rows(rows, 50).count() == 50


def test_sample_with_a_hot_key(spark, monkeypatch):
    """The limit falls inside a key that half of the rows share: the same rows for any partitioning, equal rows included."""
    monkeypatch.setattr(retrieval, "BUCKET_ROWS", 3)
    rows = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("query_id"),
        F.when(F.col("id") % 10 != 3, "a").alias("problem_category"), (F.col("id") % 150).alias("other"),
    )
    for limit in (1, 100, 299, 401, 539):
        picked = [sorted(map(tuple, retrieval.sample_rows(rows.repartition(n), limit).collect())) for n in (1, 4)]
        assert len(picked[0]) == limit and picked[0] == picked[1]
        assert all(category == "a" for _, category, _ in picked[0])


DOCS = "array<struct<document_id:string,title:string,category:string,score:double,content_snippet:string>>"


def answered(spark):
    def docs(score):
        return [(d, "t", "c", score, "s") for d in ("D1", "D2")]

    rows = [(1, docs(0.04)), (2, docs(0.3)), (3, docs(0.3)), (4, docs(0.3)), (5, []), (6, docs(0.3))]
    return spark.createDataFrame(rows, f"query_id int, retrieved_documents {DOCS}")


def test_replies(spark):
    rows = replies.grounded_replies(answered(spark))
    got = by(rows, "query_id", "fallback_used", "used_document_ids", "source_groundedness_flag")
    assert got[1] == (True, [], False)
    assert got[2] == (False, ["D1", "D2"], True)
    assert got[5] == (True, [], False)
    cells = rows.withColumns({"customer_id": F.lit(1), "problem_category": F.lit("a")})
    low = by(replies.reply_rows(cells, ("query_id",)), "query_id", "low_confidence_routing")
    assert low == {1: True, 2: False, 3: False, 4: False, 5: True, 6: False}


def test_citation_guard(spark):
    completions = spark.createDataFrame(
        [(1, "D1", None), (2, " kaynak D2 ", None), (3, "kaynak yok", None), (4, None, "Timeout")],
        "query_id int, text string, error string",
    )
    got = by(
        replies.citation_guard(answered(spark), completions), "query_id", "llm_status", "used_document_ids",
        "fallback_used",
    )
    assert got[1] == ("template_fallback", [], True)
    assert got[2] == ("llm_generated", ["D2"], False)
    assert got[3] == ("llm_missing_citation_fallback", ["D1", "D2"], False)
    assert got[4] == ("llm_error_template_fallback:Timeout", ["D1", "D2"], False)
    assert got[6][0] == "llm_error_template_fallback:MissingCompletion"


def test_choice_prefers_new_categories_and_says_when_it_falls_back():
    def row(case, place, key, category):
        return {"case": case, "place": place, "key": key, "problem_category": category}

    rows = [
        row(0, 1, 10, "billing"),
        row(1, 1, 10, "billing"), row(1, 2, 11, "billing"), row(1, 3, 12, "data"),
        row(5, 1, 10, "billing"), row(5, 2, 11, "billing"), row(5, 3, 13, "voice"),
        row(6, 1, 13, "voice"), row(6, 2, 14, "speed"),
    ]
    got = choose(rows)
    assert got[0] == (0, 10, "exact_match")
    assert got[1] == (1, 12, "exact_match")
    assert got[2][1] == 13 and got[2][2].startswith("transparent_fallback")
    assert got[3][1] == 11
    assert got[4][1] == 14


@pytest.mark.parametrize("postings, scores, share", [(2_000_000, 4_000_000, 0.005), (30, 40, 0.0), (30, 40, 1.1)])
def test_blocks_hand_on_k_documents_per_query(spark, monkeypatch, postings, scores, share):
    """A word that all documents and queries share makes no row per pair of them, in blocks and chunks of any size."""
    monkeypatch.setattr(retrieval, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(retrieval, "BLOCK_SCORES", scores)
    monkeypatch.setattr(retrieval, "DENSE_SHARE", share)
    monkeypatch.setattr(retrieval, "BLOCK_TERMS", 30)
    docs = [f"ortak dolgu {'ortak ' * (i % 3)}w{i % 9} x{i // 2}" for i in range(60)]
    asked = [f"ortak w{i % 9} dolgu" for i in range(40)]
    index, rows = bare_index(spark, [(f"d{i:02d}", d) for i, d in enumerate(docs)]), {}
    index.postings(knowledge.BM25)
    written = retrieval.materialise

    def counted(df):
        out = written(df)
        if {"row", "doc_no"} <= set(out.columns):
            rows[len(rows)] = out.count()
        return out

    monkeypatch.setattr(retrieval, "materialise", counted)
    got = ranked(retrieval.retrieve(index, queries(spark, asked), 3, knowledge.BM25))
    expected = []
    for q, text in enumerate(asked):
        found = brute_bm25(docs, text)
        expected += [(q, f"d{i:02d}") for i in sorted(range(60), key=lambda i: (-round(found[i], 9), i))[:3]]
    assert [g[:2] for g in got] == expected
    assert max(rows.values()) <= 3 * len(asked)


def test_prompts_for_every_document(spark, tmp_path):
    """Every document asks, and documents in any language are sources."""
    from workload import queries as registered

    texts = ["fatura iade talebi", "modem sinyal kesik", "paket tarife sorusu", "fatura iade talebi yine"]
    rows = [(i, t, "de" if i else "en", "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.withColumn("n_chars", F.length("text")).write.parquet(f"{tmp_path}/documents.parquet")
    tables = {
        "nation": "n_nationkey long, n_name string", "customer": "c_custkey long, c_nationkey long",
        "orders": "o_custkey long, o_orderdate date, o_totalprice double",
        "events": "event_id long, user_id long, ts timestamp, event_type string, value double, props string",
        "labels": "doc_id long, toxic int", "conversations": "conv_id long, turn int, role string, text string",
    }
    for name, schema in tables.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = registered.prompt_messages(spark, str(tmp_path)).where("role = 'user'").collect()
    assert {r["query_id"] for r in got} == {0, 1, 2, 3}
    assert all(f"Belge {r['query_id']}" in r["content"] for r in got)
    assert {r["query_id"] for r in registered.citation_guard(spark, str(tmp_path)).collect()} == {0, 1, 2, 3}


def test_texts_stay_where_they_are(spark, tmp_path):
    """Judging and answering copy no document's text for a query, and documents without a hit are tried by term."""
    text = "ortak " + "uzun " * 50
    index = bare_index(spark, [(f"d{i:02d}", f"{text} w{i % 7} fatura") for i in range(40)])
    rows = spark.createDataFrame(
        [(1, "billing", None, "", "w1 ortak"), (1, "data", "yok", "", "w2"), (None, "billing", "", "", "w3"), (2, None, "w4", "", "w4")],
        "query_id int, problem_category string, problem_subcategory string, first_customer_message string, customer_text string",
    )
    table = retrieval.evaluate_retrieval(index, rows)
    got = {(r["query_id"], r["problem_category"]): (r["hit_at_5"], r["top1_document_id"] != "") for r in table.collect()}
    assert got == {(1, "billing"): (1, True), (1, "data"): (0, True), (None, "billing"): (0, False), (2, None): (1, True)}
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "collect_list" in line and ("_hay" in line or "content" in line)]
    hits = spark.createDataFrame([(1, 1, "d01", 0.5)], "query_id int, rank int, document_id string, score double")
    plain = retrieval.with_documents(hits, index, fields=("document_id", "score")).first()["retrieved_documents"]
    assert [d.asDict() for d in plain] == [{"document_id": "d01", "score": 0.5}]


@pytest.mark.parametrize("space", [knowledge.TFIDF, knowledge.BM25])
def test_postings_are_one_row_per_document(spark, space):
    index = bare_index(spark, [(f"d{i}", " ".join(["ortak"] * (i % 3 + 1) + [f"w{i}"])) for i in range(12)] + [("z", "")])
    packed = index.packed(space)
    assert sorted(r["doc_no"] for r in packed.collect()) == list(range(12))
    terms = {r["doc_no"]: len(r["terms"]) for r in packed.collect()}
    words = {i: 2 + (space == knowledge.TFIDF) * (1 + (i % 3 > 0)) for i in range(12)}
    assert terms == words
    assert index.postings(space).count() == sum(words.values())

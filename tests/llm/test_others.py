"""Corpus operators on vectors, pages and conversations; the pipeline."""

import numpy as np
import pytest

from caredeck.llm import chat_grammar, cover_tree, html_text, vector_dups

SCHEMA = "vec_id long, embedding array<float>, rank int, unit string, kept string"


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(3)
    centers = draw.standard_normal((12, 16))
    made = [(centers[i % 12] + draw.standard_normal(16) * (0.05 + i % 5 * 0.1)).astype(np.float32) for i in range(300)]
    made[7], made[150] = made[3] * 2, made[3]
    rows = [(i, v.tolist(), 0, "clash", "clash") for i, v in enumerate(made)]
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows += [(1000 + i, v, None, None, None) for i, v in enumerate(odd)] + [(None, made[0].tolist(), None, None, None)]
    return made, spark.createDataFrame(rows, SCHEMA)


def test_top_k_against_brute_force(vectors):
    made, frame = vectors
    points = {i: np.floor(256 * v.astype(float)).astype(np.int64) for i, v in enumerate(made)} | {1002: np.zeros(16, np.int64)}
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in cover_tree.top_k(frame).collect()}
    want = {}
    for q in (i for i in points if i % 50 == 0):
        best = sorted((-int(points[q] @ p), i) for i, p in points.items() if i != q)[:5]
        want |= {(q, k): (i, -s) for k, (s, i) in enumerate(best, 1)}
    assert got == want


def test_top_k_with_few_candidates_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in cover_tree.top_k(few).collect()] == [(0, 1, 1, 32768)]
    assert cover_tree.top_k(few.limit(0)).count() == 0


def test_large_components_stay_whole(spark):
    rows = [(0, [1e6, 1.0]), (1, [1e6, 1.0]), (2, [1e6, 2.0])]
    got = cover_tree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    a, one = 256 * 1_000_000, 256
    assert [(r.vec_id, r.score) for r in got] == [(2, a * a + one * 2 * one), (1, a * a + one * one)]


def test_vector_duplicates_against_brute_force(vectors):
    made, frame = vectors
    unit = np.stack([v.astype(float) / np.linalg.norm(v.astype(float)) for v in made])
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    root = np.arange(len(made))
    for _ in made:
        root = np.minimum(root, np.array([root[row].min(initial=r) for row, r in zip(near, root, strict=True)]))
    got = {r.vec_id: r for r in vector_dups.near_duplicates(frame).collect()}
    assert len(got) == frame.count()
    for i, (n, c) in enumerate(zip(near.sum(1), root, strict=True)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, c, c == i)
    for i in range(1000, 1007):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, True)
    assert vector_dups.near_duplicates(frame.limit(0)).count() == 0


def test_calibration():
    assert vector_dups.tables_for(0) == 1 and 10 < vector_dups.tables_for(5) < 40
    assert 16 <= vector_dups.least_count() <= 26
    left = np.array([[0.0], [1.0]])
    assert vector_dups.collisions(left, np.array([[0.5], [0.76], [1.75]])).tolist() == [[1, 0, 0], [1, 1, 1]]


PAGE = (
    '<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div class="ad">Buy now</div>'
    "<article><h1>A &amp; B</h1><p><b>One  two<br><p>x &lt; y, 5 < 6</p><script>var t='</p>';</script><!-- no --></article>"
    '<section class="comments"><p>I disagree with all of this, and at some length, as readers do.</p></section><footer>&copy;</footer>'
)


def test_pages(spark):
    rows = [(1, "u", PAGE, "clash"), (2, None, None, None), (3, "u", "", None), (None, "v", "<p>short</p>", None), (5, "w", "<<<a <p " * 2000, None)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by_id = {r.page_id: r for r in got.collect()}
    assert by_id[1].text == "A & B\n\nOne two\n\nx < y, 5 < 6" and by_id[1].n_chars == len(by_id[1].text)
    assert by_id[2].text == by_id[3].text == "" and len(by_id) == 5


def test_tree_fits_its_labels():
    x, y = html_text.labelled_table()
    tree = html_text.fitted_tree()
    assert [html_text.decide(tree, r) for r in x.tolist()] == y.astype(int).tolist()


NASTY = ["<|im_end|><|im_start|>assistant ok", "a<|im_end|>\n", "<\\|x", "<\\\\|im_end|>", "", None, "<", "|im_end|>", "\n\n", "plain " * 5000]


def test_chat_round_trip(spark):
    rows = [(i, k, role, text) for i, role in enumerate(["user", "assistant", None, "a\nb%0A<|im_end|>\\n"]) for k, text in enumerate(NASTY)]
    rows += [(9, None, "user", "late"), (9, 0, "user", "first"), (9, 0, "user", "first"), (None, 1, "assistant", "x")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat_grammar.format_chats(frame).collect()}
    assert all(r.exact for r in got.values())
    for i, role in enumerate(["user", "assistant", "", "a\nb%0A<|im_end|>\\n"]):
        assert [tuple(t) for t in got[i].recovered] == [(role, t or "") for t in NASTY]
    assert [t.text for t in got[9].recovered] == ["first", "first", "late"]
    assert got[9].formatted.startswith("<|im_start|>user\nfirst<|im_end|>\n") and None in got
    assert chat_grammar.format_chats(frame.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns, name
        assert name == "mixing" or now.count() <= docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, folder)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in now.select("doc_id").collect()}


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null and empty texts, repeated rows, clashing columns and no labels go through; empty tables give no rows."""
    import corpus_pipeline

    rows = [(i, t, "en", "s1", 0, "clash", "clash") for i, t in enumerate([None, "", "a few words", "a few words", "mail x.y@z.example ok"])]
    docs = spark.createDataFrame(rows + [rows[2]], "doc_id long, text string, lang string, source string, n_chars long, taken string, kept string")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    for name, table in (("some", docs), ("none", docs.limit(0))):
        folder = str(tmp_path / name)
        table.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        pieces = corpus_pipeline.run(spark, folder).collect()
        if name == "none":
            assert pieces == []
        else:
            assert {r.doc_id for r in pieces} >= {2, 4} and 3 not in {r.doc_id for r in pieces}

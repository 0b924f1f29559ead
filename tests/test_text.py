import random
import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caredeck.functions import text as tx
from caredeck.functions.months import month_index
from caredeck.functions.numeric import safe_divide


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t")).alias("x")).first()["x"]


def test_normalize(spark):
    assert one(spark, "  İADE ÇOK\n\tIŞIK  ", tx.normalize) == "iade cok isik"
    assert one(spark, None, tx.normalize) == ""
    assert one(spark, "a \x1c b", tx.normalize) == "a b"
    assert one(spark, "ﬁyat ½", lambda c: tx.normalize(c, nfkc=True)) == "fiyat 1⁄2"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="çÇğĞıIİöÖşŞüÜaZ é\n\t ﬁ½²é", max_size=12), min_size=200, max_size=200))
def test_normalize_equals_the_formula(spark, values):
    def formula(s):
        table = str.maketrans("çÇğĞıIİöÖşŞüÜ", "ccggiiioossuu")
        return " ".join(unicodedata.normalize("NFKC", s.translate(table).lower()).split())

    rows = spark.createDataFrame([(v,) for v in values], "t string").select("t", tx.normalize(F.col("t"), True).alias("n"))
    assert [(r["t"], r["n"]) for r in rows.collect()] == [(v, formula(v)) for v in values]


def test_phrases(spark):
    repetition = ("daha once denedim", "bunu daha once denedim", "tekrar")
    assert one(spark, "bunu daha once denedim tekrar tekrar", lambda c: tx.phrase_count(c, repetition)) == 4
    assert one(spark, "faturam", lambda c: tx.phrase_hits(c, ["fatura"])) == []
    assert one(spark, "ñfatura", lambda c: tx.phrase_hits(c, ["fatura"])) == []
    assert one(spark, "iade, fatura.", lambda c: tx.phrase_hits(c, ["fatura", "iade"])) == ["fatura", "iade"]
    six = "a1 a2 a3 a4 a5 a6"
    assert one(spark, six, lambda c: tx.reason(tx.phrase_hits(c, six.split()))) == "; ".join(
        f"keyword:a{i}" for i in range(1, 7)
    )


def test_categories_and_tokens(spark):
    assert one(spark, "**Billing** #", tx.category_terms) == [
        "billing", "faturalandirma", "fatura", "ucret", "odeme", "iade",
    ]
    assert one(spark, None, tx.category_terms) == [""]
    assert one(spark, "bir a iki_3 uc", lambda c: tx.with_bigrams(tx.word_tokens(c))) == [
        "bir", "iki_3", "uc", "bir iki_3", "iki_3 uc",
    ]
    assert one(spark, "a", lambda c: tx.with_bigrams(tx.word_tokens(c))) == []
    assert one(spark, " iki  söz ", tx.word_count) == 2
    assert one(spark, "", tx.word_count) == 0


def test_month_index(spark):
    for label in ("2024-03", "202403"):
        assert one(spark, label, month_index) == 2024 * 12 + 3


def test_strict_month_index(spark):
    import pytest

    with pytest.raises(Exception, match="bad billing month"):
        one(spark, "2024-3", lambda c: month_index(c, strict=True))


def test_safe_divide(spark):
    rows = spark.createDataFrame([(1, 6.0, 3.0), (2, 6.0, 0.0), (3, 6.0, None), (4, None, 2.0)], "i int, n double, d double")
    got = rows.select("i", safe_divide(F.col("n"), F.col("d"), -1.0).alias("x")).collect()
    assert [r["x"] for r in got] == [2.0, -1.0, -1.0, None]


def test_phrases_against_plain_patterns(spark):
    """Odd characters, accents, overlaps and phrases with punctuation: the same counts as a pattern per phrase gives."""
    draw = random.Random(1)
    parts = ["ab", "cd", "ef", " ", " ", ".", "-", "é", "ß", "́", "_", "1", "'"]
    texts = [re.sub(" +", " ", "".join(draw.choice(parts) for _ in range(draw.randrange(30))).strip()) for _ in range(1500)]
    terms = ("ab", "ab cd", "cd ef ab", "é", "ab ab", "1", "a-b", "ab.cd", "ef é", "cd_1")
    columns = [tx.phrase_count(F.col("t"), (t,)).alias(str(i)) for i, t in enumerate(terms)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", *columns, tx.phrase_count(F.col("t"), terms).alias("all"), tx.phrase_hits(F.col("t"), terms).alias("hits")).collect():
        want = [len(re.findall(rf"(?<!\w){re.escape(t)}(?!\w)", r["t"])) for t in terms]
        assert [r[str(i)] for i in range(len(terms))] == want and r["all"] == sum(want)
        assert r["hits"] == [t for t, n in zip(terms, want, strict=True) if n]


def test_phrases_equal_a_pattern_each(spark):
    """Phrases nested in one another, at any boundary, are all found, as by one pattern per phrase."""
    families = (("a", "a b", "a b c", "b c"), ("ab", "abc", "abc a", "ç d", "c"))
    rng = random.Random(3)
    texts = ["".join(rng.choices("abc   .d_é\U0001d41a", k=30)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", *[tx.found_count(tx.find_phrases(F.col("t"), *families), f).alias(f"n{i}") for i, f in enumerate(families)]
    )
    for row in rows.collect():
        for i, family in enumerate(families):
            plain = {tx._fold(p) for p in family}
            assert row[f"n{i}"] == sum(len(re.findall(rf"(?<!\w){re.escape(p)}(?!\w)", row["t"])) for p in plain), (row["t"], family)


def test_phrases_are_looked_up_without_cutting_texts(spark):
    """One pattern over the text; no array of its words is built."""
    plan = spark.createDataFrame([("x",)], "t string").select(tx.find_phrases(F.col("t"), ("iade", "iade istiyorum")))
    assert "split(" not in plan._jdf.queryExecution().optimizedPlan().toString()

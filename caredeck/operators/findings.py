"""Executive findings: topic and finding rows from the totals."""

from pyspark.sql import functions as F

from .rollups import bill_shock_summary, complaint_totals, data_scale

# Topics and sentences of the report.
POSITION = (
    "Platform tekil örnek kayıtlardan ibaret değildir; retention risk, kaynaklı çözüm, risk triage, friction azaltma "
    "ve high-value koruma kullanımlarını bir araya getirir."
)
LIMITS = (
    "Veri setinde resmi churn etiketi yoktur; çıktılar kesin churn tahmini değil, no observed billable activity / "
    "retention risk önceliklendirmesidir."
)


def findings(customer, spending, complaints, bills, retrieval=None):
    """Nine rows (topic, finding); `retrieval` is the one-row retrieval metrics, if measured."""
    totals = complaint_totals(complaints)
    scale = data_scale(customer, spending, complaints)
    shock = bill_shock_summary(bills).select("bill_shock_rate").scalar()
    hit = F.lit(None).cast("double") if retrieval is None else retrieval.select("hit_at_3").scalar()

    def pct(rate):
        return F.format_string("%.1f%%", rate * 100)

    def counts(column):
        present = F.filter(F.map_entries(column), lambda e: e["value"] > 0)
        ordered = F.array_sort(present, lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).otherwise(0))
        entries = F.transform(ordered, lambda e: F.concat(F.lit("'"), e["key"], F.lit("': "), e["value"].cast("string")))
        return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))

    def number(column, digits=0):
        return F.format_number(column, digits)

    lines = {
        "Konumlandırma": F.lit(POSITION),
        "Veri ölçeği": F.concat(
            number(F.col("scale.customer_rows")), F.lit(" müşteri, "), number(F.col("scale.spending_rows")),
            F.lit(" harcama satırı ve "), number(F.col("scale.complaint_rows")), F.lit(" şikâyet satırı işlendi."),
        ),
        "Şikâyet odağı": F.concat(
            F.lit("En büyük şikâyet kategorisi: "), F.coalesce("largest_category", F.lit("N/A")), F.lit(".")
        ),
        "Friction": F.concat(
            F.lit("Yüksek friction oranı "), pct(F.col("high_friction_rate")),
            F.lit("; bu sinyal no-repeat handoff ve agent copilot için kullanılır."),
        ),
        "Risk ve öncelik": F.concat(
            F.lit("Yüksek iş riski oranı "), pct(F.col("high_risk_rate")), F.lit(". Priority dağılımı: "),
            counts("priorities"), F.lit(". Risk dağılımı: "), counts("risk_levels"), F.lit("."),
        ),
        "Bill shock": F.concat(
            F.lit("Bill shock oranı "), pct(F.col("shock")),
            F.lit(". Bu sinyal bağlamsal risk göstergesidir; nedensellik iddiası yapılmaz."),
        ),
        "High-value koruma": F.concat(
            F.lit("Yüksek değerli ve yüksek riskli müşteri sayısı "), number(F.col("at_risk_customers")),
            F.lit("; tarihsel gelir toplamı "), number(F.col("at_risk_revenue"), 2), F.lit("."),
        ),
        "RAG": F.concat(
            F.lit("TF-IDF/BM25 uyumlu retrieval V1 hazır. Hit@3 durumu: "),
            F.when(F.col("hit").isNotNull(), pct(F.col("hit"))).otherwise("ölçüm yok"), F.lit("."),
        ),
        "Sınırlılık": F.lit(LIMITS),
    }
    row = totals.withColumns({"scale": scale.select(F.struct("*")).scalar(), "shock": shock, "hit": hit})
    return row.select(
        F.inline(F.array(*[F.struct(F.lit(t).alias("topic"), text.alias("finding")) for t, text in lines.items()]))
    )

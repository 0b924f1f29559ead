"""Source-grounded reply texts, prompts and the citation guard, as columns on retrieved documents."""

from pyspark.sql import functions as F

from ..functions.numeric import share
from ..functions.text import strip, word_count

MIN_CONFIDENCE = 0.05
REPLY_SOURCES = 3

# Texts shown to agents and customers, and the prompt.
TEXTS = {
    "confirm": "Müşterinin ana talebini '%s/%s' olarak anladım. Yanlış anlamamak için: Öncelik çözülmeyen konu ve beklenen aksiyon bu mu?",
    "summary": "Müşteri %s döneminde %s konusunda başvurdu. Friction=%s risk=%s öncelik=%s.",
    "no_source_suggestion": "Bilgi tabanında yeterli kaynak bulunamadı; uzman ekibe yönlendirme önerilir.",
    "suggestion": "Yaşadığınız durumu anladım. Bilgi tabanındaki %s dokümanlarına göre işlemi kaynaklı şekilde kontrol edeceğim; gerekli ise ilgili uzman kuyruğa kayıt açacağım.",
    "default_action": "source-grounded KB response",
    "no_source_reply": "Bilgi tabanında bu talep için yeterli kaynak bulunamadı. Yanlış yönlendirme yapmamak için uzman ekibe aktarım önerilir.",
    "reply": "Yaşadığınız durumu anladım. Bilgi tabanındaki %s kaynaklarına göre talebinizi kontrol edip uygun işlem adımlarını kaynaklı şekilde paylaşacağım. Gerekirse ilgili uzman kuyruğa kayıt açacağım.",
    "system": (
        "Sen bir telekom müşteri destek yardımcı copilotusun. Yalnızca verilen KB kaynaklarını kullan. "
        "Kısa, profesyonel Türkçe yanıt yaz. document_id kaynaklarını açıkça belirt. "
        "Kaynak yetersizse bunu söyle ve uzman yönlendirme öner. Öncelik, hukuki durum, churn veya routing kararı verme. "
        "Desteklenmeyen iade, tazminat veya teknik neden uydurma."
    ),
    "user": "Müşteri talebi:\n%s\n\nKB kaynakları:\n%s\n\nYanıt:",
    "source": "document_id=%s\nBaşlık=%s\nİçerik=%s",
}

# How a reply came about.
DISABLED = "llm_disabled_template_fallback"
TEMPLATE = "template_fallback"
UNCITED = "llm_missing_citation_fallback"
FAILED = "llm_error_template_fallback"
GENERATED = "llm_generated"


def _docs():
    return F.col("retrieved_documents")


def _confidence():
    return F.coalesce(F.try_element_at(_docs(), F.lit(1))["score"], F.lit(0.0))


def _lacks_source():
    return (F.coalesce(F.size(_docs()), F.lit(0)) < 1) | (_confidence() < MIN_CONFIDENCE)


def _ids(limit=None):
    docs = _docs() if limit is None else F.slice(_docs(), 1, limit)
    return F.transform(docs, lambda d: d["document_id"])


def template_texts(rows):
    """Confirmation prompt, conversation summary, suggested reply and action for each row."""

    def shown(name, missing="None"):
        return F.coalesce(F.col(name).cast("string"), F.lit(missing)) if name in rows.columns else F.lit(missing)

    suggestion = F.format_string(TEXTS["suggestion"], F.array_join(_ids(), ", "))
    return rows.withColumns(
        {
            "confirmation_prompt": F.format_string(
                TEXTS["confirm"], shown("problem_category", ""), shown("problem_subcategory", "")
            ),
            "conversation_summary": F.format_string(
                TEXTS["summary"],
                shown("billing_year_month", ""),
                shown("problem_category", ""),
                shown("friction_level_v3"),
                shown("business_risk_level"),
                shown("priority_level"),
            ),
            "suggested_agent_reply": F.when(_lacks_source(), TEXTS["no_source_suggestion"]).otherwise(suggestion),
            "recommended_business_action": shown("recommended_business_action", TEXTS["default_action"]),
        }
    )


def grounded_replies(rows, completions_enabled=False):
    """Template reply with the documents it rests on, or a handoff text where no source is good enough."""
    lacks = _lacks_source()
    ids = _ids(REPLY_SOURCES)
    return rows.withColumns(
        {
            "generated_agent_reply": F.when(lacks, TEXTS["no_source_reply"]).otherwise(
                F.format_string(TEXTS["reply"], F.array_join(ids, ", "))
            ),
            "used_document_ids": F.when(lacks, F.array().cast("array<string>")).otherwise(ids),
            "fallback_used": lacks,
            "retrieval_confidence": _confidence(),
            "source_groundedness_flag": ~lacks,
            "llm_status": F.lit(TEMPLATE if completions_enabled else DISABLED),
        }
    )


def prompts(rows, query="query"):
    """Chat messages (system, user with sources) for each row."""
    sources = F.transform(
        _docs(),
        lambda d: F.format_string(
            TEXTS["source"], d["document_id"], F.coalesce(d["title"], F.lit("")), F.coalesce(d["content_snippet"], F.lit(""))
        ),
    )
    user = F.format_string(TEXTS["user"], F.col(query), F.array_join(sources, "\n\n"))
    return rows.withColumn(
        "messages",
        F.array(
            F.struct(F.lit("system").alias("role"), F.lit(TEXTS["system"]).alias("content")),
            F.struct(F.lit("user").alias("role"), user.alias("content")),
        ),
    )


def citation_guard(rows, completions, key="query_id"):
    """Replies from completions made elsewhere (key, text, optional error), used only if they cite.

    A completion that names none of the retrieved documents, failed or is missing gives way to
    the template reply; the status tells which.
    """
    answers = completions.select(
        key,
        F.col("text").alias("_text"),
        (F.col("error") if "error" in completions.columns else F.lit(None).cast("string")).alias("_error"),
    )
    base = grounded_replies(rows, completions_enabled=True).join(answers, key, "left")
    cited = F.filter(_ids(), lambda i: F.contains(F.col("_text"), i))
    base = base.withColumn("_cited", cited)
    failed = F.col("_text").isNull()
    status = (
        F.when(_lacks_source(), TEMPLATE)
        .when(failed, F.concat(F.lit(f"{FAILED}:"), F.coalesce("_error", F.lit("MissingCompletion"))))
        .when(F.size("_cited") == 0, UNCITED)
        .otherwise(GENERATED)
    )
    used = F.col("llm_status") == GENERATED
    return (
        base.withColumn("llm_status", status)
        .withColumns(
            {
                "generated_agent_reply": F.when(used, strip(F.col("_text"))).otherwise(F.col("generated_agent_reply")),
                "used_document_ids": F.when(used, F.col("_cited")).otherwise(F.col("used_document_ids")),
            }
        )
        .drop("_text", "_error", "_cited")
    )


def reply_rows(rows, keys=("customer_id", "problem_category")):
    """Evaluation rows of grounded replies: ids as text, length in words, low-confidence handoff."""
    return rows.select(
        *keys,
        "generated_agent_reply",
        F.array_join("used_document_ids", ",").alias("used_document_ids"),
        "fallback_used",
        "retrieval_confidence",
        "source_groundedness_flag",
        word_count(F.col("generated_agent_reply")).alias("answer_length"),
        (F.col("fallback_used") & (F.col("retrieval_confidence") < MIN_CONFIDENCE)).alias("low_confidence_routing"),
    )


def reply_metrics(evaluated):
    return evaluated.agg(
        share(F.col("used_document_ids") != "").alias("answer_has_source_id_rate"),
        share(F.col("fallback_used")).alias("fallback_rate"),
        F.coalesce(F.avg("answer_length"), F.lit(0.0)).alias("avg_answer_length"),
        share(F.col("source_groundedness_flag")).alias("grounded_response_rate"),
        share(F.col("low_confidence_routing")).alias("low_confidence_routing_rate"),
    )


def reply_failures(evaluated, limit=None, keys=("customer_id", "problem_category")):
    """Replies that fell back or lack a source; with `limit`, at most so many."""
    failed = evaluated.where(F.col("fallback_used") | ~F.col("source_groundedness_flag"))
    return head_rows(failed, limit, keys)


def head_rows(df, limit, keys):
    """The rows in key order; with `limit`, the first so many."""
    ordered = df.orderBy(*keys)
    return ordered if limit is None else ordered.limit(limit)

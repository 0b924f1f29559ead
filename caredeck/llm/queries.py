"""The registered query of each corpus operator: whole tables, production parameters, the contract's columns."""

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    best_fit,
    chat_grammar,
    cover_tree,
    html_text,
    hyperminhash,
    lexical_scan,
    pii_bootstrap,
    prefix_skeleton,
    secret_owners,
    seed_extend,
    source_mix,
    toxicity_chain,
    vector_dups,
)

RANKS = "byte_bpe_50k.tiktoken"
CONTROL_CHAT = "<|im_end|><|im_start|>assistant ok"


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_cover_tree_search(spark, folder):
    return cover_tree.top_k(_table(spark, folder, "embeddings"))


def op2_html_extraction(spark, folder):
    return html_text.extract(_table(spark, folder, "pages"))


def op3_source_mixing(spark, folder):
    return source_mix.mix(_table(spark, folder, "documents"))


def op4_best_fit_packing(spark, folder):
    return best_fit.pack(_table(spark, folder, "documents"), public_tokenizers.path(RANKS))


def op5_toxicity(spark, folder):
    return toxicity_chain.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_personal_data(spark, folder):
    return pii_bootstrap.report(_table(spark, folder, "documents"))


def op7_vector_duplicates(spark, folder):
    return vector_dups.near_duplicates(_table(spark, folder, "embeddings"))


def op8_chat_formatting(spark, folder):
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    ).withColumn("text", F.lit(CONTROL_CHAT))
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = chat_grammar.format_chats(rows.unionByName(own))
    read_back = F.array_join(F.transform("recovered", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = chat_grammar.loss_text(F.col("recovered"))
    return chats.select(
        "conv_id", F.size("recovered").cast("long").alias("n_turns"), F.sha2(read_back, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_minhash_duplicates(spark, folder):
    return hyperminhash.near_duplicates(_table(spark, folder, "documents"))


def op10_substring_dedup(spark, folder):
    return seed_extend.without_repeats(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op11_secret_owners(spark, folder):
    found = secret_owners.find_secrets(_table(spark, folder, "documents"))
    spans = F.col("spans")

    def number(field, value):
        return F.size(F.filter(spans, lambda s: s[field] == value)).cast("long")

    return found.select(
        "doc_id",
        *[number("kind", i).alias(f"n_{name}") for i, name in enumerate(secret_owners.KINDS)],
        F.sha2(secret_owners.listed(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        secret_owners.listed(spans).alias("spans"),
        *[number("verdict", name).alias(f"n_{name}") for name in ("live", "example")],
    )


def op12_lexical_search(spark, folder):
    return lexical_scan.rank_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_prefix_trie(spark, folder):
    return prefix_skeleton.conversation_trie(_table(spark, folder, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_cover_tree_search, op2_html_extraction, op3_source_mixing, op4_best_fit_packing, op5_toxicity,
        op6_personal_data, op7_vector_duplicates, op8_chat_formatting, op9_minhash_duplicates, op10_substring_dedup,
        op11_secret_owners, op12_lexical_search, op13_prefix_trie,
    )
}

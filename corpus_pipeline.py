"""The corpus pipeline: from the documents table to packed training sequences."""

import public_tokenizers

from caredeck.llm import best_fit, hyperminhash, pii_bootstrap, source_mix, toxicity_chain
from caredeck.llm.common import materialise
from caredeck.llm.queries import RANKS


def toxicity(spark, docs, sf_dir):
    """Documents that the classifier chain does not call toxic."""
    return toxicity_chain.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return hyperminhash.keep_one_of_each(docs)


def personal_data(spark, docs, sf_dir):
    """The documents with personal data masked in their texts."""
    return pii_bootstrap.masked(docs)


def mixing(spark, docs, sf_dir):
    """Each document as often as the mix of sources takes it."""
    return source_mix.mixed_documents(docs)


def packing(spark, docs, sf_dir):
    """Pieces of the documents in sequences of 1024 tokens."""
    return best_fit.pack(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has neither the fitted chain nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents; each one's output is written and read back as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: quality, toxicity, near-duplicates, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Stages are
written to the shared folder as Parquet and read again, so each works on what its predecessor kept, and a lost executor costs
one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrier.llm import bpe, mixing, ngram_join, quality, toxicity
from terrier.llm.common import materialize, table
from terrier.llm.queries import TOKENIZERS, toxic_held_out

#: Four fifths of the tokens, each document at most once.
MIXTURE = mixing.Mixture(
    domains=mixing.PRODUCTION.domains,
    domain_weights=mixing.PRODUCTION.domain_weights,
    language_weights=mixing.PRODUCTION.language_weights,
    budget_permille=800,
    max_epochs=1,
)

#: Near copies share four fifths of their shingles of five words. (op4_ngram_join has the values of its own contract.)
NEAR = ngram_join.Jaccard(n=5, part=80, whole=100)


# Every stage takes any columns beside doc_id, text, lang and source, whatever their names, and all but the last return them as
# they were. An empty table gives an empty table. Nulls, empty texts, ties and repeated rows: as each docstring says.


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer keeps. Null and empty texts are judged by the feature for them, repeated rows each alike; scores at the threshold stay."""
    return quality.keep_good(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic. Null and empty texts have no features; documents without a label or an id are scored like all others; scores at the threshold go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), toxic_held_out())


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id. Texts without words and rows without an id stay; rows that share the smallest id stay together."""
    return ngram_join.keep_one(docs, NEAR)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture, each once at most. A null source or language is one of its own; rows alike in doc_id stay or go together; texts without words come with whole epochs and where the prefix reaches them."""
    return mixing.mix_only(docs, MIXTURE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, n_tokens) of each row. Null texts are empty: no tokens."""
    return bpe.bpe_encode(docs, f"{TOKENIZERS}/byte_bpe_50k.json")


STAGES = [("quality", good), ("toxicity", not_toxic), ("near duplicates", one_of_each), ("mixture", mixed), ("tokens", tokens)]

#: Learned stages and merges are beyond SQL. Tests hold near duplicates, mixture and tokens against brute force, SQL and the
#: vocabulary, and quality and toxicity against the labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

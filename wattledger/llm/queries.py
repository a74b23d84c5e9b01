"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattledger.llm import ann, counts, jaccard, langid, packing, prefix_trie, quality, records, runs, simhash, spm, substring, toxicity
from wattledger.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_sentencepiece(spark, sf_dir):
    """Encoded and decoded again, as digests."""
    return spm.encoding_digests(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_inverted_multi_index(spark, sf_dir):
    """Neighbours of every hundredth vector among all."""
    embeddings = table(spark, sf_dir, "embeddings")
    return ann.nearest_neighbours(embeddings, embeddings.where("vec_id % 100 = 0"))


@query
def op5_binary_records(spark, sf_dir):
    return records.write_and_digest(table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark, sf_dir):
    return substring.substring_digests(table(spark, sf_dir, "documents"))


ORACLES["op6_substring_dedup"] = substring.ORACLE_SQL


@query
def op7_bin_completion_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op8_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark, sf_dir):
    return counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark, sf_dir):
    return langid.identify_languages(table(spark, sf_dir, "documents"))


@query
def op11_ngram_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


ORACLES["op11_ngram_jaccard_join"] = jaccard.ORACLE_SQL


@query
def op12_periodic_runs(spark, sf_dir):
    """Runs in texts some of which are made periodic."""
    return runs.run_digests(table(spark, sf_dir, "documents"))


@query
def op13_prefix_trie(spark, sf_dir):
    """Beginnings of conversations that begin with turns of every hundredth."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), rebuild=True)


ORACLES["op13_prefix_trie"] = prefix_trie.ORACLE_SQL

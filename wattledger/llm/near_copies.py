"""One row of each group of near copies, for the pipeline: SimHash links and, beyond them, five-word Jaccard links.

SimHash fingerprints that differ in at most three bits find copies with few changes. Texts with a similarity of 0.8 differ in
some ten of 64 bits, and so do very many unrelated pairs of a large corpus: no error budget of a trie join finds the ones
without traversing the others. Links of 0.8 and more are therefore found by the Jaccard join on their words, and both kinds of
links make the groups together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import importable
from wattledger.llm.components import connected_components
from wattledger.llm.jaccard import jaccard_components
from wattledger.llm.simhash import near_duplicates
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import scratch_dir, written

WORDS = 5
PERCENT = 80


def near_copy_groups(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """key, root: for the hash of each text (``text_key``) that has near copies of another text, the group of both."""
    spark = importable(documents.sparkSession)
    base = scratch_dir(spark)
    keyed = documents.select(text_key(documents).alias("doc_id"), F.col("text").cast("string").alias("text"))
    links = near_duplicates(keyed).unionByName(jaccard_components(keyed, words, percent), allowMissingColumns=True)
    links = written(links.where("doc_id <> component_id").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b")).distinct(), f"{base}/links")
    return connected_components(links).withColumnRenamed("node", "key")


def text_key(documents: DataFrame):
    """64 bits of the text, null as empty: two of n texts share them by chance with a probability of n * n / 2^65."""
    return F.xxhash64(F.coalesce(documents["text"].cast("string"), F.lit("")))


def one_of_each_group(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one row of each group of near copies: of the rows with its smallest doc_id, the one of the smallest
    text hash and other columns.

    Texts link if their fingerprints differ in three bits or fewer, or if their sets of ``words``-word shingles have a
    Jaccard similarity of ``percent`` hundredths or more; groups are what links join. Rows without doc_id stay, and a null text
    is empty. Rows are decided one by one: of rows that share a doc_id, each is judged by its own text, and rows that repeat
    one that stays go. All columns stay as they are; an empty table gives no rows.
    """
    base = scratch_dir(documents.sparkSession)
    groups = written(near_copy_groups(documents, words, percent), f"{base}/groups")
    keys = documents.select(F.col("doc_id").cast("long").alias("id"), text_key(documents).alias("key")).where("id IS NOT NULL")
    rooted = keys.groupBy("id", "key").agg(F.count(F.lit(1)).alias("rows")).join(groups, "key", "left")
    rooted = written(rooted.select("id", "key", "rows", F.coalesce("root", "key").alias("root")), f"{base}/rooted")
    first = rooted.groupBy("root").agg(F.min(F.struct("id", "key")).alias("first"))
    decided = rooted.join(first, "root").select("id", "key", "rows", (F.struct("id", "key") == F.col("first")).alias("stays"))
    # rows that go, and rows of which one is added again below
    decided = written(decided.where("NOT stays OR rows > 1"), f"{base}/decided")
    mine = documents["doc_id"].cast("long"), text_key(documents)
    gone = broadcast_within(decided.select(F.col("id").alias("_id"), F.col("key").alias("_key")))
    plain = documents.join(gone, (mine[0] == F.col("_id")) & (mine[1] == F.col("_key")), "left_anti")
    again = decided.where("stays").select(F.col("id").alias("_id"), F.col("key").alias("_key"))
    if again.isEmpty():
        return plain
    row = F.struct(*(documents[c] for c in documents.columns)).alias("_row")
    repeated = documents.join(broadcast_within(again), (mine[0] == F.col("_id")) & (mine[1] == F.col("_key"))).select("_id", "_key", row)
    kept = repeated.groupBy("_id", "_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row.*")
    return plain.unionByName(kept)

"""Quality rules: base rules on words and lines, then a hashed n-gram log-likelihood ratio with a fixed threshold.

The n-grams are byte n-grams, hashed to ``buckets`` counters. Two multinomials are counted, one over the trusted
documents and one over the whole corpus; a document's score is the mean over its n-grams of the log ratio of their
probabilities, so it does not depend on the length of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import each_text, importable, map_arrow, release_memory, slices, texts_of
from wattledger.plans.sizing import broadcast_within

ORDER = 4
BUCKETS = 1 << 16
SMOOTHING = 1.0
THRESHOLD = -0.6
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def grams(text: bytes, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of each byte n-gram of the text, in order; ``buckets`` is a power of two."""
    data = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(data) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    key = np.zeros(n, np.uint64)
    for i in range(order):
        key = (key << np.uint64(8)) | data[i : i + n]
    key *= np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64)


def base_stats(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    word_chars = len(text.translate(None, _SPACE).decode())
    n_symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), _repeat_words(words)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    ordinal: dict[bytes, int] = {}
    ids = np.array([ordinal.setdefault(w, len(ordinal)) for w in words], dtype=np.int64)
    pairs = np.unique(ids[:-1] * len(ordinal) + ids[1:], return_inverse=True)[1].astype(np.int64)
    _, which, counts = np.unique(pairs[:-1] * len(ordinal) + ids[2:], return_inverse=True, return_counts=True)
    repeated = counts[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : i + len(repeated)] |= repeated
    return int(covered.sum())


def log_ratios(documents: DataFrame, trusted: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """log P(bucket | trusted) - log P(bucket | corpus), counted over all rows of ``documents`` (doc_id, text).

    trusted: the doc_ids whose documents are the trusted target. Without any trusted text all ratios are 0. Each task
    sums its counters; the driver gets ``buckets`` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for part in slices(batch, 1 << 20, "text"):
                flags = part.column(0).to_pylist()
                found = [grams(t, order, buckets) for t in texts_of(part, "text")]
                for row, keep in ((0, found), (1, [g for g, f in zip(found, flags, strict=True) if f])):
                    if keep:
                        counts[row] += np.bincount(np.concatenate(keep), minlength=buckets)
        used = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[0][used]), pa.array(counts[1][used])], ["bucket", "corpus", "target"]
        )

    ids = broadcast_within(trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id IS NOT NULL").distinct())
    flagged = documents.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("trusted_id"), "left")
    flagged = flagged.select(F.col("trusted_id").isNotNull().alias("trusted"), F.col("text").cast("string").alias("text"))
    totals = map_arrow(flagged, run, "bucket int, corpus long, target long").groupBy("bucket").agg(F.sum("corpus"), F.sum("target"))
    corpus, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, c, t in totals.collect():  # one row per bucket at most
        corpus[bucket], target[bucket] = c, t
    if not target.sum():
        return np.zeros(buckets)
    share = lambda n: np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * buckets))
    return share(target) - share(corpus)


def quality(ratios: np.ndarray, threshold: float = THRESHOLD, order: int = ORDER):
    """Column function: a struct of the base columns, base_failed, llr and kept of a text column; null text is empty.

    A text too short for an n-gram has llr 0.
    """
    table, buckets = ratios.astype(np.float32), len(ratios)

    @F.arrow_udf(", ".join(f"{c} long" for c in _STATS).join(["struct<", ", base_failed boolean, llr double, kept boolean>"]))
    def rules(texts: pa.Array) -> pa.Array:
        stats, llr = np.zeros((len(texts), 5), np.int64), np.zeros(len(texts))
        for row, text in enumerate(each_text(texts)):
            stats[row] = base_stats(text)
            found = grams(text, order, buckets)
            if len(found):
                llr[row] = table[found].mean(dtype=np.float64)
        release_memory()
        failed = (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT_PERCENT * stats[:, 0])
        columns = [*(pa.array(stats[:, i]) for i in range(5)), pa.array(failed), pa.array(llr), pa.array(~failed & (llr >= threshold))]
        return pa.StructArray.from_arrays(columns, [*_STATS, "base_failed", "llr", "kept"])

    return rules


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids that all their labels call good; rows without quality do not count."""
    return labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")


def quality_rules(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base columns, base_failed, kept and llr of every row of ``documents`` (doc_id, text).

    base_failed: fewer than 50 words, or more than half of the words inside repeated three-word windows. kept: not
    base_failed and llr >= ``threshold``. A null text has no words (base_failed); a null doc_id stays null and is never
    trusted; repeated rows are judged one by one and counted each time; other columns are ignored; an empty table gives
    no rows.
    """
    rules = quality(log_ratios(documents, trusted_ids(labels)), threshold)
    importable(documents.sparkSession)
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), rules(F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", *[f"found.{c}" for c in (*_STATS, "base_failed", "kept", "llr")])


def passes_quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> Column:
    """Whether a row of ``documents`` is kept: a condition for ``where`` that leaves all columns as they are."""
    rules = quality(log_ratios(documents, trusted_ids(labels)), threshold)
    importable(documents.sparkSession)
    return rules(documents["text"].cast("string"))["kept"]

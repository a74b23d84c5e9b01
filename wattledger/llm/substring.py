"""Removal of passages that an earlier document has, by content-defined blocks and their windows.

Every document is cut into blocks at anchors that depend on the words alone: of the eight-word grams inside a window of
50 words, the one with the smallest hash is the window's anchor, and the windows that follow each other with the same
anchor make a block. Equal passages are therefore cut into equal blocks, wherever they lie.

1. The index has each distinct block with the smallest document that holds it.
2. Each block of a document which the index knows from a smaller document is marked. It is at least 50 words long, so its
   words are duplicates.
3. Where texts part within a block, it is not known as a whole, but its anchor is known from another block. The windows
   of all distinct blocks that share their anchor with a different block are compared with each other, one by one.

Any window that occurs in two documents has the same anchor in both, so its blocks are equal (2) or share their anchor
(3): the result is exact. What is shuffled is a row per block, and a row per window only for blocks that share an anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import each_text, importable, map_arrow, release_memory
from wattledger.plans.storage import scratch_dir, written

WINDOW = 50
GRAM = 8
SEGMENT = 1 << 22  # words parsed at once
_POSITION = np.uint64((1 << 24) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < 200_000:
            self[word] = found
        return found


@lru_cache(maxsize=4)
def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers 0 to n of both bases, and of their inverses, modulo 2^64."""
    out = []
    for base in _BASES:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            powers = np.full(n + 1, b, np.uint64)
            powers[0] = 1
            both.append(np.cumprod(powers, dtype=np.uint64))
        out.append(tuple(both))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Parsed:
    """Blocks of one segment of a document: start of the first and of the last window, anchor, two hashes of the words."""

    def __init__(self, words: list[bytes], window: int, memo: _WordHashes):
        self.window = window
        n = len(words)
        hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
        powers = _powers(1 << max(12, (n + 1).bit_length()))
        self.sums, self.inverse = [], []
        for x, (power, inverse) in zip((hashes, _mixed(hashes)), powers, strict=True):
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * power[:n], dtype=np.uint64)]))
            self.inverse.append(inverse)
        gram = min(GRAM, window)
        starts = np.arange(n - gram + 1)
        grams = self._hash(0, starts, starts + gram)
        key = (_mixed(grams) & ~_POSITION) | starts.astype(np.uint64)
        span, width = window - gram + 1, 1
        low = key
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
        anchor = (low & _POSITION).astype(np.int64)  # of each window
        edges = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        self.first = np.concatenate([[0], edges])
        self.last = np.concatenate([edges - 1, [len(anchor) - 1]])
        self.anchors = grams[anchor[self.first]]
        length = (self.last - self.first).astype(np.uint64)
        self.blocks = [_mixed(self._hash(i, self.first, self.last + window) + length) for i in (0, 1)]

    def _hash(self, i: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[i][end] - self.sums[i][start]) * self.inverse[i][start]

    def windows(self, starts: np.ndarray) -> list[np.ndarray]:
        return [_mixed(self._hash(i, starts, starts + self.window)) for i in (0, 1)]

    def starts_of(self, chosen: np.ndarray) -> np.ndarray:
        """Starts of all windows of the chosen blocks."""
        counts = (self.last - self.first + 1)[chosen]
        ends = np.cumsum(counts)
        return np.repeat(self.first[chosen] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def segments(words: list[bytes], window: int, memo: _WordHashes | None = None) -> Iterator[tuple[int, Parsed]]:
    """Offset and blocks of each segment; every window lies in exactly one."""
    memo = _WordHashes() if memo is None else memo
    for offset in range(0, len(words) - window + 1, SEGMENT):
        yield offset, Parsed(words[offset : offset + SEGMENT + window - 1], window, memo)


def _key(pair: list[np.ndarray]) -> np.ndarray:
    """One comparable value of 16 bytes for each pair of hashes."""
    out = np.empty(len(pair[0]), dtype=[("a", np.uint64), ("b", np.uint64)])
    out["a"], out["b"] = pair
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _packed(data: bytes | None) -> np.ndarray:
    return np.sort(np.frombuffer(data or b"", dtype=[("a", ">u8"), ("b", ">u8")]).astype([("a", np.uint64), ("b", np.uint64)]))


def _member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def _blocks_of(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for batch in batches:
            ids, parts = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), each_text(batch.column(1)), strict=True):
                for _, parsed in segments(text.split(), window, memo):
                    _, which = np.unique(_key(parsed.blocks), return_index=True)  # a passage repeated in itself is one row
                    ids.append(np.full(len(which), doc_id, np.int64))
                    parts.append([parsed.blocks[0][which], parsed.blocks[1][which], parsed.anchors[which]])
            if ids:
                columns = [_signed(np.concatenate(x)) for x in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), *columns], ["id", "h1", "h2", "anchor"])

    return run


def _windows_of(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        for batch in batches:
            for doc_id, text, open_blocks in zip(batch.column(0).to_pylist(), each_text(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                known = _packed(open_blocks)
                for _, parsed in segments(text.split(), window, memo):
                    starts = parsed.starts_of(np.flatnonzero(_member(_key(parsed.blocks), known)))
                    unique = np.unique(_key(parsed.windows(starts)))
                    if len(unique):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(unique), doc_id, np.int64)), _signed(unique["a"]), _signed(unique["b"])], ["id", "h1", "h2"]
                        )

    return run


def _keys_by_id(rows: DataFrame, name: str) -> DataFrame:
    """One row per document with its hash pairs, 16 bytes each: no more than its own text has."""
    pair = F.concat(F.unhex(F.lpad(F.hex("h1"), 16, "0")), F.unhex(F.lpad(F.hex("h2"), 16, "0")))
    return rows.groupBy(F.col("id").alias(f"{name}_id")).agg(F.array_join(F.collect_list(F.hex(pair)), "").alias("hex")).select(f"{name}_id", F.unhex("hex").alias(name))


def _repeated(rows: DataFrame, path: str) -> DataFrame:
    """Rows (id, h1, h2) whose pair a smaller id has too. Copies meet in the aggregation, before the shuffle."""
    smallest = rows.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    known = written(smallest.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "first"), path)
    return rows.join(known, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))).where("id > first").select("id", "h1", "h2")


def duplicate_marks(documents: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(blocks_id, blocks) and (windows_id, windows): the hashes of each document's known blocks and repeated windows."""
    base = scratch_dir(documents.sparkSession)
    narrow = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("content"))
    blocks = written(map_arrow(narrow, _blocks_of(window), "id long, h1 long, h2 long, anchor long"), f"{base}/blocks")

    index = blocks.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.min("anchor").alias("anchor"))
    index = written(index, f"{base}/index")
    shared = index.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("anchor").alias("shared"))
    boundary = index.join(shared, F.col("anchor") == F.col("shared")).select("id", "h1", "h2")

    opened = narrow.join(_keys_by_id(boundary, "open"), F.col("id") == F.col("open_id")).select("id", "content", "open")
    windows = written(map_arrow(opened, _windows_of(window), "id long, h1 long, h2 long"), f"{base}/windows")
    known_blocks = _repeated(blocks.select("id", "h1", "h2"), f"{base}/known-blocks")
    known_windows = _repeated(windows, f"{base}/known-windows")
    return _keys_by_id(known_blocks, "blocks"), _keys_by_id(known_windows, "windows")


def _cut(window: int):
    @F.arrow_udf("struct<n_words long, n_removed long, kept binary>")
    def cut(texts: pa.Array, blocks: pa.Array, windows: pa.Array) -> pa.Array:
        memo = _WordHashes()
        counts, removed, kept = [], [], []
        for text, known, repeated in zip(each_text(texts), blocks.to_pylist(), windows.to_pylist(), strict=True):
            words = text.split()
            change = np.zeros(len(words) + 1, np.int64)
            if known or repeated:
                known, repeated = _packed(known), _packed(repeated)
                for offset, parsed in segments(words, window, memo):
                    inside = np.flatnonzero(_member(_key(parsed.blocks), known))
                    starts = np.arange(len(parsed.sums[0]) - window)
                    alone = np.flatnonzero(_member(_key(parsed.windows(starts)), repeated)) if len(repeated) else starts[:0]
                    np.add.at(change, offset + np.concatenate([parsed.first[inside], alone]), 1)
                    np.add.at(change, offset + window + np.concatenate([parsed.last[inside], alone]), -1)
            gone = np.cumsum(change[:-1]) > 0
            counts.append(len(words))
            removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if removed[-1] else words))
        release_memory()
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], ["n_words", "n_removed", "kept"]
        )

    return cut


def cut_repeats(documents: DataFrame, column: str, window: int = WINDOW) -> DataFrame:
    """``documents`` with a struct ``column`` of n_words, n_removed and kept: the words that stay, joined by one space.

    A word goes if a window of ``window`` consecutive words covers it that also starts in a document with a smaller
    doc_id, as the documents were given. Within one doc_id nothing repeats: rows with the same doc_id are one document in
    this. A null text has no words; rows with a null doc_id keep all words and are no reference. All other columns
    stay as they are.
    """
    importable(documents.sparkSession)
    blocks, windows = duplicate_marks(documents, window)
    marks = blocks.join(windows, F.col("blocks_id") == F.col("windows_id"), "full")
    marks = marks.select(F.coalesce("blocks_id", "windows_id").alias("marked_id"), F.struct("blocks", "windows").alias("marks"))
    marks = written(marks, f"{scratch_dir(documents.sparkSession)}/marks")
    with_marks = documents.withColumn(column, F.col("doc_id").cast("long")).alias("d").join(
        marks.alias("m"), F.col(f"d.{column}") == F.col("m.marked_id"), "left"
    )
    found = _cut(window)(F.col("d.text").cast("string"), F.col("m.marks.blocks"), F.col("m.marks.windows"))
    return with_marks.select(*[F.col(f"d.{c}") for c in documents.columns], found.alias(column))


def substring_digests(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``documents`` (doc_id, text); see ``cut_repeats``."""
    cut = cut_repeats(documents.select("doc_id", "text"), "cut", window)
    kept = F.sha2(F.col("cut.kept"), 256).alias("kept_sha256")
    return cut.select(F.col("doc_id").cast("long").alias("doc_id"), "cut.n_words", "cut.n_removed", kept)


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with repeated passages cut out of the text; texts without any stay as they are.

    n_chars, where there is such a column, becomes the length of the text that is left.
    """
    column = "cut"
    while column in documents.columns:
        column += "_"
    cut = cut_repeats(documents, column, window)
    changed = F.col(f"`{column}`.n_removed") > 0
    kept = F.col(f"`{column}`.kept").cast("string")
    new = {"text": F.when(changed, kept).otherwise(F.col("text"))}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.when(changed, F.length(kept).cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumns(new).select(*documents.columns)


# every window as its text, in DuckDB
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 49), ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d)),
firsts AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
dup AS (SELECT doc_id, s FROM win JOIN firsts USING (k) WHERE doc_id > m),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 50)) AS p FROM dup)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

"""Language identification with a string kernel.

The kernel of two texts is the number of hashed byte n-grams (1 to 4 bytes of the lower-cased text) present in both,
divided by the geometric mean of their numbers of n-grams. Nyström landmarks approximate it, and one-versus-rest kernel
ridge regression on the landmark features gives a score per language. The landmarks, their whitening and the ridge
coefficients multiply to one matrix from n-grams to languages; the intercept is added to the scores. A long text would hold
n-grams of every kind, so the kernel is taken for consecutive parts of the whole text, and their scores are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import id_crc, importable, map_arrow
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import scratch_dir, written

BUCKETS = 1 << 20
PART = 4096  # characters of a text that are one row of n-grams
ORDERS = (1, 2, 3, 4)
TRAIN_PER_LANGUAGE = 500
LANDMARKS_PER_LANGUAGE = 48
TRAIN_ROWS = 32_000  # in all, divided over the languages; each has one row at least
LANDMARKS = 3_072  # likewise
RIDGE = 1e-3
UNKNOWN = "und"
_DENSE = 1 << 24  # weights held as one matrix from buckets to languages up to this size


@dataclass
class Presence:
    """Sparse rows of presence bits: the sorted buckets of each row, one row after the other."""

    found: np.ndarray
    starts: np.ndarray  # of each row, and the end
    buckets: int

    @classmethod
    def of(cls, rows: list[np.ndarray], buckets: int) -> Presence:
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int64)
        return cls(np.concatenate([np.zeros(0, np.int32), *rows]), starts, buckets)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def row(self, i: int) -> np.ndarray:
        return self.found[self.starts[i] : self.starts[i + 1]]

    def sum(self, axis: int = 1) -> np.ndarray:
        """The number of bits of each row."""
        assert axis == 1
        return np.diff(self.starts)

    def norms(self) -> np.ndarray:
        return np.sqrt(np.maximum(self.sum(), 1))


def present(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """The sorted buckets that hold an n-gram of the text."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    key, out = np.zeros(len(data), np.uint32), []
    for order in ORDERS:
        if len(data) < order:
            break
        key = (key[: len(data) - order + 1] << np.uint32(8)) | data[order - 1 :]
        mixed = (key ^ np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
        out.append((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> shift)
    if not out:
        return np.zeros(0, np.int32)
    all_ = np.sort(np.concatenate(out))
    return all_[np.concatenate([[True], all_[1:] != all_[:-1]])].astype(np.int32)


def presence(texts: list[str], buckets: int = BUCKETS) -> Presence:
    """One row per text: the buckets that hold one of its n-grams."""
    return Presence.of([present(t, buckets) for t in texts], buckets)


def parts(text: str) -> list[tuple[int, int]]:
    """Start and end of the consecutive parts of a text, of nearly equal length and PART characters at most."""
    n = max(1, -(-len(text) // PART))
    edges = [len(text) * i // n for i in range(n + 1)]
    return list(zip(edges, edges[1:], strict=False))


class Landmarks:
    """Kernel of n-gram rows with the landmarks.

    Buckets of many landmarks are columns of a matrix; of each other bucket, the landmarks that hold it are listed.
    """

    def __init__(self, marks: Presence):
        holders = np.bincount(marks.found, minlength=marks.buckets)
        common = holders > max(8, len(marks) // 8)
        owner = np.repeat(np.arange(len(marks), dtype=np.int32), marks.sum())
        self.column = np.where(common, np.cumsum(common) - 1, -1).astype(np.int32)
        self.matrix = np.zeros((int(common.sum()), len(marks)), np.float32)
        often = common[marks.found]
        self.matrix[self.column[marks.found[often]], owner[often]] = 1
        self.owner = owner[~often][np.argsort(marks.found[~often], kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.where(common, 0, holders))])
        self.norms = marks.norms()

    def kernels(self, rows: list[np.ndarray]) -> np.ndarray:
        held = np.zeros((len(rows), len(self.matrix)), np.float32)
        rare = np.zeros((len(rows), len(self.norms)))
        for i, row in enumerate(rows):
            column = self.column[row]
            held[i, column[column >= 0]] = 1
            low, size = self.first[row], self.first[row + 1] - self.first[row]
            place = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
            rare[i] = np.bincount(self.owner[place], minlength=len(self.norms))
        sizes = np.array([max(1, len(r)) for r in rows])
        return (held @ self.matrix + rare) / (self.norms * np.sqrt(sizes)[:, None])


@dataclass
class LanguageModel:
    languages: list[str]
    marks: Landmarks | None  # only where there are too many languages for a matrix from buckets to languages
    place: np.ndarray | None  # else the row of each bucket in that matrix
    weights: np.ndarray  # rows of buckets, or landmarks, x languages
    intercept: np.ndarray
    buckets: int

    def _scores(self, rows: list[np.ndarray]) -> np.ndarray:
        if self.marks:
            return self.marks.kernels(rows) @ self.weights
        return np.stack([self.weights[self.place[r]].sum(0, dtype=np.float64) / np.sqrt(max(1, len(r))) for r in rows])

    def scores(self, texts: list[str]) -> np.ndarray:
        """Scores of each text and language: the mean over the consecutive parts of the whole text."""
        out = np.zeros((len(texts), len(self.languages)))
        for i, text in enumerate(texts):
            cuts = parts(text)
            for start in range(0, len(cuts), 64):
                out[i] += self._scores([present(text[a:b], self.buckets) for a, b in cuts[start : start + 64]]).sum(0)
            out[i] /= len(cuts)
        return out + self.intercept


def fit(found: Presence, languages: list[str], landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> LanguageModel:
    """Kernel ridge regression on the rows of ``found``; the first ``landmarks`` rows of each language are landmarks."""
    names = sorted(set(languages))
    number = {name: k for k, name in enumerate(names)}
    label = np.array([number[x] for x in languages], dtype=np.int64)
    chosen = np.concatenate([np.flatnonzero(label == k)[:landmarks] for k in range(len(names))])
    rows = Presence.of([found.row(i) for i in chosen], found.buckets)
    marks = Landmarks(rows)

    def kernels(of: Presence) -> Iterator[np.ndarray]:
        for start in range(0, len(of), 256):
            yield marks.kernels([of.row(i) for i in range(start, min(start + 256, len(of)))])

    values, vectors = np.linalg.eigh(np.vstack(list(kernels(rows))))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    share = 1 / (np.bincount(label, minlength=len(names))[label] * len(names))  # each language weighs the same
    width = whiten.shape[1] + 1
    left, right = ridge * np.eye(width), np.zeros((width, len(names)))
    start = 0
    for some in kernels(found):  # sums over rows, so that their features are never all held
        of = slice(start, start := start + len(some))
        features = np.hstack([some @ whiten, np.ones((len(some), 1))])
        weighted = features * share[of, None]
        left += features.T @ weighted
        right += weighted.T @ (2.0 * (label[of, None] == np.arange(len(names))) - 1)
    coefficients = np.linalg.solve(left, right)
    of_marks = whiten @ coefficients[:-1]
    active = np.unique(rows.found)
    if len(active) * len(names) > _DENSE:
        return LanguageModel(names, marks, None, of_marks, coefficients[-1], found.buckets)
    place = np.zeros(found.buckets, np.int32)
    place[active] = np.arange(1, len(active) + 1)
    weights = np.zeros((len(active) + 1, len(names)))  # the first for buckets that no landmark has
    for i, of_mark in enumerate(of_marks / rows.norms()[:, None]):
        weights[place[rows.row(i)]] += of_mark
    return LanguageModel(names, None, place, weights.astype(np.float32), coefficients[-1], found.buckets)


def training_rows(documents: DataFrame, per_language: int = TRAIN_PER_LANGUAGE, total: int = TRAIN_ROWS) -> DataFrame:
    """lang and n-gram buckets of about ``per_language`` rows of every language, or of fewer if that is over ``total`` in all.

    Only rows with text, doc_id and lang outside the held-out fold. The sample is chosen by a hash of the id against the
    share that the language's count asks for, so no language is gathered in one place; the row of the smallest hash is
    always in it, so no language is without rows. Of a long text, the part that the
    hash chooses is the row, so that rows are bounded.
    """
    usable = documents.where("text IS NOT NULL AND doc_id IS NOT NULL AND lang IS NOT NULL").where(id_crc(F.col("doc_id")) % 5 != 0)
    usable = usable.select(F.col("doc_id").alias("id"), F.col("lang").alias("language"), F.col("text").cast("string").alias("content"))
    usable = usable.withColumn("key", F.xxhash64("id"))
    counts = usable.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"))
    counts = written(counts, f"{scratch_dir(documents.sparkSession)}/languages")
    each = max(1, min(per_language, total // max(1, counts.count())))
    share = F.pmod("key", F.lit(1 << 20)) < F.lit(float(each << 20)) / F.col("n")
    chosen = usable.join(broadcast_within(counts), "language").where(share | (F.col("key") == F.col("least")))
    chosen = chosen.select("language", "content", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                rows = []
                for text, key in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True):
                    cuts = parts(text)
                    low, high = cuts[(key >> 20) % len(cuts)]
                    rows.append(present(text[low:high]).astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), pa.array(rows, pa.binary())], ["language", "key", "found"])

    return map_arrow(chosen, run, "language string, key long, found binary")


def train(documents: DataFrame) -> LanguageModel | None:
    """The model of ``training_rows``, which are about 32,000 rows of 10 KB, or one for each language; None if there are none."""
    rows = sorted(training_rows(documents).collect(), key=lambda r: (r["language"], r["key"], r["found"]))
    if not rows:
        return None
    languages = [r["language"] for r in rows]
    landmarks = max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS // len(set(languages))))
    return fit(Presence.of([np.frombuffer(r["found"], "<i4") for r in rows], BUCKETS), languages, landmarks)


def identify_languages(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``documents`` (doc_id, text, lang).

    held_out: crc32 of the id's text is divisible by 5; such rows are not learned from. A null doc_id is not held out and
    not learned from. lang_pred: the language of the highest kernel score, ``und`` with score 0 where the text is null or
    has no letter, and everywhere if there is nothing to learn from. score: logistic function of four times the lead over
    the second language (1 with a single language). Repeated rows are predicted one by one; other columns are ignored; an
    empty table gives no rows.
    """
    importable(documents.sparkSession)
    model = train(documents)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(texts: pa.Array) -> pa.Array:
        rows = texts.to_pylist()
        known = [i for i, t in enumerate(rows) if t and model and any(map(str.isalpha, t))]
        names, scores = [UNKNOWN] * len(rows), np.zeros(len(rows))
        for start in range(0, len(known), 256):
            some = known[start : start + 256]
            found = model.scores([rows[i] for i in some])
            best = found.argmax(1)
            ranked = np.sort(found, axis=1)
            lead = ranked[:, -1] - ranked[:, -2] if found.shape[1] > 1 else np.full(len(some), np.inf)
            for i, b in zip(some, best, strict=True):
                names[i] = model.languages[b]
            scores[some] = 1 / (1 + np.exp(-4 * lead))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    held_out = F.coalesce(id_crc(F.col("doc_id")) % 5 == 0, F.lit(False))
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), predict(F.col("text").cast("string")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")

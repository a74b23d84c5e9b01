"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features are densities of a learned lexicon, its proximity to second-person words, and rates of capitals, punctuation
and obfuscation. Lexicon, trees and calibration are fitted on a bounded sample of labelled rows; every text is scored
whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import each_text, id_crc, importable, map_arrow, release_memory, texts_of

MAX_TRAIN = 20_000  # labelled rows that lexicon and trees are fitted on
LEXICON_SIZE = 400
MIN_DOCUMENTS = 3  # toxic training texts that a lexicon entry occurs in
MIN_OCCURRENCES = 6  # and how often it does so altogether
MIN_LOG_ODDS = 3.0
STEMS = (4, 5, 6, 7, 8)  # lexicon entries are words, and word beginnings of these lengths
NEAR = 4  # words
THRESHOLD = 0.7

# fixed values: second-person words of English, German, French, Spanish
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos ti tú tus vosotros usted ustedes".split()
)
# fixed values: characters that stand for letters in disguised words
_DISGUISE = str.maketrans("013457@$!", "oieastasi")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_DISGUISED = re.compile(r"[^\W\d_][\d@$*!#+]+[^\W\d_]")
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

FEATURES = (
    "log_words lexicon_density lexicon_weight lexicon_variety lexicon_share_of_text second_person near_density nearness "
    "capital_letters capital_words exclamations questions punctuation symbols disguised_words long_runs repeated_hits"
).split()


def core(word: str) -> str:
    """The word in lower case without what surrounds it, with the letters that disguising characters stand for."""
    bare = _EDGES.sub("", word.lower())
    return bare.translate(_DISGUISE) if not bare.isalpha() else bare


def entries(word: str) -> list[str]:
    """What the lexicon may hold of a core word: itself, and its beginnings marked with a star."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


class WordClasses(dict):
    """word -> number of its class; the properties of a class, worked out once per distinct word, are in arrays.

    Words with the same properties share a class: lexicon entry (0: none), weight, second person, capitals, disguised.
    """

    def __init__(self, lexicon: dict[str, float], limit: int = 300_000):
        super().__init__()
        self.weights = lexicon
        self.number = {entry: i + 1 for i, entry in enumerate(sorted(lexicon))}
        self.limit = limit
        self.classes: dict[tuple, int] = {}
        self.properties = np.zeros((0, 5))

    def __missing__(self, word: bytes) -> int:
        text = word.decode()
        plain = text.isalpha()
        bare = text.lower() if plain else core(text)
        hit, best = None, 0.0
        for entry in entries(bare):
            weight = self.weights.get(entry, 0.0)
            if weight > best:
                hit, best = entry, weight
        shouted = len(text) > 1 and text.isupper()
        found = (self.number.get(hit, 0), best, bare in SECOND_PERSON, shouted, not plain and bool(_DISGUISED.search(text)))
        if found not in self.classes:
            self.classes[found] = len(self.classes)
            self.properties = np.vstack([self.properties, np.array([found], dtype=np.float64)])
        if len(self) < self.limit:
            self[word] = self.classes[found]
        return self.classes[found]


_ABOVE_ASCII = bytes(range(128, 256))
_CAPITALS = bytes(range(0x41, 0x5B))
_SMALL = bytes(range(0x61, 0x7B))


def _share_of(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def features(text: bytes, classes: WordClasses) -> list[float]:
    """The dense features of one text; all 0 for a text without words.

    Characters beyond ASCII count as letters.
    """
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    which = np.fromiter(map(classes.__getitem__, words), np.int64, n)
    counts = np.bincount(which, minlength=len(classes.properties)).astype(np.float64)
    number, weight, second, shouted, disguised = classes.properties.T
    hits = np.flatnonzero((number > 0)[which]) if counts[number > 0].any() else np.empty(0, np.int64)
    you = np.flatnonzero((second > 0)[which]) if counts[second > 0].any() else np.empty(0, np.int64)
    near = nearness = 0.0
    if len(hits) and len(you):
        after = np.searchsorted(you, hits)
        before = np.abs(hits - you[np.maximum(after - 1, 0)])
        gap = np.minimum(before, np.abs(you[np.minimum(after, len(you) - 1)] - hits))
        near, nearness = float((gap <= NEAR).sum()), float((1 / (1 + gap)).mean())
    per_entry = np.bincount(number.astype(np.int64), counts)[1:]
    ascii_size = len(text.translate(None, _ABOVE_ASCII))
    size = len(text) if ascii_size == len(text) else len(text.decode())
    capitals = _share_of(text, _CAPITALS)
    letters = capitals + _share_of(text, _SMALL) + size - ascii_size
    data = np.frombuffer(text, np.uint8)
    same = data[1:] == data[:-1]
    return [
        float(np.log1p(n)),
        100 * len(hits) / n,
        100 * float(counts @ weight) / n,
        float((per_entry > 0).sum()),
        100 * sum([len(words[i]) for i in hits.tolist()]) / len(text),
        100 * len(you) / n,
        100 * near / n,
        nearness,
        capitals / max(letters, 1),
        float(counts @ shouted) / n,
        100 * text.count(b"!") / size,
        100 * text.count(b"?") / size,
        _share_of(text, _PUNCTUATION) / size,
        _share_of(text, b"#*$%&|<>@~^") / size,
        100 * float(counts @ disguised) / n,
        100 * float((same[1:] & same[:-1]).sum()) / size,
        float(per_entry.max(initial=0.0)),
    ]


@dataclass
class Tree:
    """A node of a regression tree: the leaf value, or a split at ``feature`` <= ``cut``."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def add_to(self, x: np.ndarray, out: np.ndarray, rows: np.ndarray) -> None:
        if self.feature < 0:
            out[rows] += self.value
            return
        left = x[rows, self.feature] <= self.cut
        self.low.add_to(x, out, rows[left])
        self.high.add_to(x, out, rows[~left])


@dataclass
class Model:
    lexicon: dict[str, float]
    base: float
    trees: list[Tree]
    knots: tuple[np.ndarray, np.ndarray]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            tree.add_to(x, out, np.arange(len(x)))
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated; a hundredth of the plain logistic score keeps the order within one isotonic step."""
        margin = self.margins(x)
        plain = 1 / (1 + np.exp(-margin))
        return np.clip(0.99 * np.interp(margin, *self.knots) + 0.01 * plain, 0.0, 1.0) if len(self.knots[0]) else plain


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
    """(base margin, trees) of gradient boosting with the logistic loss on quantile bins."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    margin, trees = np.full(len(y), base), []

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int) -> Tree:
        g, h = grad[rows].sum(), hess[rows].sum()
        leaf = Tree(value=float(-rate * g / (h + ridge)))
        if level == depth or len(rows) < 20:
            return leaf
        best = (1e-6, -1, -1)
        for j, c in enumerate(cuts):
            if not len(c):
                continue
            gl = np.cumsum(np.bincount(binned[rows, j], grad[rows], len(c) + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, j], hess[rows], len(c) + 1))[:-1]
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(hl < 1e-3) | (h - hl < 1e-3)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), j, k)
        _, j, k = best
        if j < 0:
            return leaf
        left = binned[rows, j] <= k
        return Tree(feature=j, cut=float(cuts[j][k]), low=grow(rows[left], grad, hess, level + 1), high=grow(rows[~left], grad, hess, level + 1))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), 0)
        tree.add_to(x, margin, np.arange(len(y)))
        trees.append(tree)
    return base, trees


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (margin, probability) of the non-decreasing least-squares fit, by pooling adjacent violators."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, first margin, last margin
    for m, v in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([v, 1.0, m, m])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            mean, weight, _, last = blocks.pop()
            low = blocks[-1]
            low[0] = (low[0] * low[1] + mean * weight) / (low[1] + weight)
            low[1] += weight
            low[3] = last
    knots = sorted({(b[i], b[0]) for b in blocks for i in (2, 3)})
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def learnable(labels: DataFrame) -> DataFrame:
    """id and toxic of the labelled documents outside the held-out fold; toxic if any of a document's labels says so."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(id_crc(F.col("doc_id")) % 3 != 1)
    return usable.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic texts, clean texts and occurrences in toxic texts of each entry, per task."""
    texts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    occurrences: Counter[str] = Counter()
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), texts_of(batch, "content"), strict=True):
            own: Counter[str] = Counter()
            for word, n in Counter(text.split()).items():
                for entry in entries(core(word.decode())):
                    own[entry] += n
            own.pop("", None)
            texts[toxic].update(own.keys())
            if toxic:
                occurrences.update(own)
    names = sorted(texts[0].keys() | texts[1].keys())
    for start in range(0, len(names), 50_000):
        some = names[start : start + 50_000]
        counts = [pa.array([x[e] for e in some], pa.int64()) for x in (texts[1], texts[0], occurrences)]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), *counts], ["entry", "toxic", "clean", "occurrences"])


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> Model:
    """Fit on the labelled rows with the ``max_rows`` smallest hashes of their ids; equal texts count once.

    The driver gets the lexicon's entries and one row of features per training text, never texts.
    """
    spark = importable(documents.sparkSession)
    sample = learnable(labels).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = documents.select(F.col("doc_id").alias("document"), F.col("text").cast("string").alias("content"))
    known = texts.join(F.broadcast(sample), F.col("document") == F.col("id")).select("toxic", F.coalesce("content", F.lit("")).alias("content"))
    known = known.groupBy(F.md5("content").alias("key"), "content").agg(F.max("toxic").alias("toxic")).select("toxic", "content", "key")

    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, negative = totals.get(1, 0), totals.get(0, 0)
    odds = F.log((F.col("t") + 0.5) / (positive + 1)) - F.log((F.col("c") + 0.5) / (negative + 1))
    found = (
        map_arrow(known.select("toxic", "content"), _entry_counts, "entry string, toxic long, clean long, occurrences long")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.sum("occurrences").alias("n"))
        .where((F.col("t") >= MIN_DOCUMENTS) & (F.col("n") >= MIN_OCCURRENCES))
        .select("entry", "n", odds.alias("odds"))
        .where(F.col("odds") >= MIN_LOG_ODDS)
        .orderBy(F.desc(F.col("n") * F.col("odds")), "entry")
        .limit(LEXICON_SIZE)
    )
    lexicon = {r["entry"]: round(r["odds"], 6) for r in found.collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = WordClasses(lexicon)
        for batch in batches:
            rows = [features(t, classes) for t in texts_of(batch, "content")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "key", "x"])

    rows = sorted(map_arrow(known, run, "toxic int, key string, x array<double>").collect(), key=lambda r: r["key"])
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), len(FEATURES))
    y = np.array([r["toxic"] for r in rows], dtype=np.float64)
    fold = np.arange(len(rows)) % 4 == 3  # a quarter, in the order of the texts' hashes, is for calibration
    if len(set(y[~fold])) < 2:
        return Model(lexicon, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), [], (np.empty(0), np.empty(0)))
    base, trees = boost(x[~fold], y[~fold])
    model = Model(lexicon, base, trees, (np.empty(0), np.empty(0)))
    if len(set(y[fold])) == 2:
        model.knots = isotonic(model.margins(x[fold]), y[fold])
    return model


def score_column(model: Model, text: Column) -> Column:
    """Score of each text, null as empty."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        classes = WordClasses(model.lexicon)
        for texts in batches:
            x = np.array([features(t, classes) for t in each_text(texts)], dtype=np.float64).reshape(len(texts), len(FEATURES))
            yield pa.array(model.scores(x))
            release_memory()

    return score(text.cast("string"))


def toxicity_scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= ``threshold``) of every row of ``documents`` (doc_id, text).

    held_out: crc32 of the id's text leaves 1 when divided by 3; labels of such rows are not read. A null doc_id is not
    held out and not learned from. A null text scores as an empty one. Without labels of both kinds every row has the
    same score. Contradictory labels of a document count as toxic. Repeated rows are scored one by one; other columns are
    ignored; an empty table gives no rows.
    """
    model = train(documents, labels)
    held_out = F.coalesce(id_crc(F.col("doc_id")) % 3 == 1, F.lit(False))
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def is_clean(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> Column:
    """Whether a row of ``documents`` scores below the threshold: a condition for ``where`` that leaves all columns."""
    return score_column(train(documents, labels), documents["text"]) < threshold

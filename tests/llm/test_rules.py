"""Quality rules, toxicity and language identification against plain versions and held-out labels."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import DOCUMENTS, by_key, prose, text_of
from wattledger.llm import langid, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def plain_base(text: str):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen: set[str] = set()
    duplicates = 0
    for line in lines:
        duplicates += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered), failed


def plain_llr(texts: list[str], trusted: list[bool], order=4, buckets=1 << 16) -> list[float]:
    def found(text):
        data = text.encode()
        for i in range(len(data) - order + 1):
            key = int.from_bytes(data[i : i + order], "big") * 0x9E3779B97F4A7C15 % 2**64
            yield key >> 48

    corpus, target = Counter(), Counter()
    for text, good in zip(texts, trusted, strict=True):
        corpus.update(found(text))
        if good:
            target.update(found(text))
    n, m = sum(corpus.values()), sum(target.values())
    ratio = lambda b: np.log((target[b] + 1) / (m + buckets)) - np.log((corpus[b] + 1) / (n + buckets))
    return [float(np.mean([ratio(b) for b in found(t)])) if m and len(t.encode()) >= order else 0.0 for t in texts]


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules_and_ratio(spark, awkward, awkward_rows):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 0), (6, 1, 1), (8, None, 0), (None, 1, 1), (12, 1, None), (99, 1, 0)], LABELS)
    rows = quality.quality_rules(awkward, labels, threshold=-0.01)
    texts = [text_of(r) for r in awkward_rows]
    llr = plain_llr(texts, [r[0] in (1, 6, 12) for r in awkward_rows])
    expected = [(r[0], *plain_base(t), not plain_base(t)[-1] and x >= -0.01) for r, t, x in zip(awkward_rows, texts, llr, strict=True)]
    assert by_key(rows, "doc_id", *BASE, "kept") == sorted(expected, key=repr)
    got = sorted((r["n_words"], r["llr"]) for r in rows.collect())
    assert np.allclose([x for _, x in got], [x for _, x in sorted(zip([e[1] for e in expected], llr, strict=True))], atol=1e-5)


def test_quality_without_trusted_documents_or_rows(spark, awkward, empty):
    labels = spark.createDataFrame([], LABELS)
    rows = quality.quality_rules(awkward, labels).collect()
    assert all(r["llr"] == 0 and r["kept"] == (not r["base_failed"]) for r in rows)
    assert quality.quality_rules(empty, labels).collect() == []


def test_quality_keeps_rows_and_columns(spark, awkward, awkward_rows):
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    kept = awkward.where(quality.passes_quality(awkward, labels, threshold=-100.0))
    assert kept.columns == awkward.columns
    assert kept.count() == sum(not plain_base(text_of(r))[-1] for r in awkward_rows)


def test_quality_tells_good_from_bad_on_test_data(spark, sf_dir):
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_rules(documents, labels).join(labels, "doc_id").collect()
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    assert np.mean(bad) < 0.02
    assert np.mean(good) == 1.0


def auc(scores, labels) -> float:
    scores, labels = np.array(scores), np.array(labels)
    a, b = scores[labels == 1], scores[labels == 0]
    return float((a[:, None] > b).mean() + (a[:, None] == b).mean() / 2)


def toxic_corpus(n: int):
    """Documents of which every fifth is toxic: it has insults near second-person words."""
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 60).split()
        if i % 5 == 0:
            for k, insult in enumerate(["grumblefool", "you", "snotface", "sl0bber"]):
                words.insert(7 * k + 3, insult)
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(i % 5 == 0)))
    return rows, labels


def test_toxicity_on_unseen_documents(spark):
    rows, labels = toxic_corpus(600)
    got = toxicity.toxicity_scores(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(labels, LABELS)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert auc([r["score"] for r in held], [int(r["doc_id"] % 5 == 0) for r in held]) > 0.99
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in held]) > 0.98


def test_held_out_labels_are_not_read(spark):
    rows, labels = toxic_corpus(200)
    documents = spark.createDataFrame(rows, DOCUMENTS)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    one, other = (by_key(toxicity.toxicity_scores(documents, spark.createDataFrame(x, LABELS)), "doc_id", "score") for x in (labels, turned))
    assert one == other


def test_toxicity_of_awkward_rows(spark, awkward, awkward_rows, empty):
    rows, labels = toxic_corpus(150)
    more = spark.createDataFrame([(1000 + i, t, "en", "a", 1) for i, t, *_ in rows], DOCUMENTS)
    marks = spark.createDataFrame([(1000 + i, q, t) for i, q, t in labels] + [(1, None, None), (None, 1, 1), (1000, 1, 0)], LABELS)
    everything = awkward.unionByName(more, allowMissingColumns=True)
    got = toxicity.toxicity_scores(everything, marks).where("doc_id < 1000 OR doc_id IS NULL").collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in awkward_rows)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5)}) == 1
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert awkward.where(toxicity.is_clean(awkward, marks)).columns == awkward.columns
    nothing = spark.createDataFrame([], LABELS)
    assert len({r["score"] for r in toxicity.toxicity_scores(awkward, nothing).collect()}) == 1
    assert toxicity.toxicity_scores(empty, marks).collect() == []


def test_toxicity_on_test_data(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_scores(documents, labels).join(labels, "doc_id").where("held_out").collect()
    assert auc([r["score"] for r in rows], [r["toxic"] for r in rows]) > 0.98
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 1]) > 0.85
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 0]) < 0.01


def test_isotonic_fit_is_monotone_and_pools():
    margin = np.array([0.0, 1, 2, 3, 4, 4])
    x, y = toxicity.isotonic(margin, np.array([0.0, 1, 0, 1, 1, 0]))
    assert np.all(np.diff(y) >= 0)
    assert np.allclose(np.interp(margin, x, y), [0, 0.5, 0.5, 2 / 3, 2 / 3, 2 / 3])


def test_features_of_edge_texts():
    classes = toxicity.WordClasses({"fool": 4.0, "fool*": 3.0})
    named = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, classes), strict=True))
    assert set(named(b"").values()) == {0.0}
    assert set(named(b" \n ").values()) == {0.0}
    found = named("YOU f00l, you FOOL!!! thing".encode())
    assert found["lexicon_density"] == 40 and found["near_density"] == 40 and found["capital_words"] == 0.4
    assert found["disguised_words"] == 20 and found["exclamations"] > 0 and found["long_runs"] > 0


def languages(n: int):
    alphabets = {"aa": "alpha beta gamma delta", "bb": "uno dos tres quatro", "cc": "яблоко груша слива вишня"}
    return [(i, prose(i, 12, alphabets[k]), k, "a", 1) for i in range(n) for k in [list(alphabets)[i % 3]]]


def test_languages_of_unseen_documents(spark):
    rows = languages(300)
    got = {r["doc_id"]: r for r in langid.identify_languages(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    for i, _, lang, *_ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["lang_pred"] == lang
        assert 0.5 <= got[i]["score"] <= 1


def test_languages_are_learned_from_the_other_folds_only(spark):
    rows = languages(90)
    turned = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else k, s, n) for i, t, k, s, n in rows]
    one, other = (by_key(langid.identify_languages(spark.createDataFrame(x, DOCUMENTS)), "doc_id", "lang_pred", "score") for x in (rows, turned))
    assert one == other


def test_languages_of_awkward_rows(spark, awkward, awkward_rows, empty):
    got = langid.identify_languages(awkward).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in awkward_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert all((by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0) for i in (3, 4, 5))
    assert {r["lang_pred"] for r in got} <= {"und", "en", "de", "fr", "es"}
    assert langid.identify_languages(empty).collect() == []
    unknown = langid.identify_languages(awkward.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")).collect()
    assert {r["lang_pred"] for r in unknown} == {"und"}


def test_presence_and_one_language():
    found = langid.presence(["", "a", "A", "ab"], 1 << 10)
    assert found.sum(1).tolist() == [0, 1, 1, 3]
    model = langid.fit(langid.presence(["some text", "other text"]), ["xx", "xx"])
    assert model.scores(["more text"]).shape == (1, 1)


def test_language_accuracy_on_test_data(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = langid.identify_languages(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97


@pytest.mark.parametrize("dense", [1 << 24, 0])
def test_scores_are_kernel_ridge_with_intercept(monkeypatch, dense):
    """Against plain kernel matrices; with all rows as landmarks nothing is approximated but the rank."""
    monkeypatch.setattr(langid, "_DENSE", dense)
    texts, names = zip(*[(t, k) for _, t, k, *_ in languages(60)], strict=True)
    sets = [set(langid.present(t).tolist()) for t in texts]
    unseen = [t for _, t, *_ in languages(75)][60:]
    kernel = lambda a, b: np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])
    values, vectors = np.linalg.eigh(kernel(sets, sets))
    whiten = vectors / np.sqrt(values)
    features = np.hstack([kernel(sets, sets) @ whiten, np.ones((60, 1))])
    target = np.array([[1.0 if n == k else -1.0 for k in sorted(set(names))] for n in names])
    w = np.linalg.solve(features.T @ features / 60 + langid.RIDGE * np.eye(61), features.T @ target / 60)
    expected = kernel([set(langid.present(t).tolist()) for t in unseen], sets) @ whiten @ w[:-1] + w[-1]
    assert np.abs(w[-1]).max() > 0.01
    got = langid.fit(langid.presence(list(texts)), list(names)).scores(unseen)
    assert np.allclose(got, expected, atol=1e-3)


def test_texts_of_several_megabytes(spark):
    """Each language of the test data joined to one text, which holds nearly every n-gram of a few letters."""
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL")
    joined: dict[str, list[str]] = {}
    for r in documents.select("lang", "text").collect():
        joined.setdefault(r["lang"], []).append(r["text"])
    model = langid.train(documents)
    texts = ["\n".join(joined[k]) for k in model.languages]
    assert len(texts) > 1 and min(map(len, texts)) > 2_000_000
    assert [model.languages[i] for i in model.scores(texts).argmax(1)] == model.languages


def test_no_language_is_left_out(spark, monkeypatch):
    """More languages than 64, the later ones rarer; then a budget of less than one row and landmark each."""
    rnd = random.Random(7)
    words = {f"l{k:02}": " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(4)) for k in range(80)}
    names = [name for k, name in enumerate(words) for _ in range(12 if k < 70 else 8)]
    rows = [(i, prose(i, 12, words[name]), name, "a", 1) for i, name in enumerate(names)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_languages(df).collect()}
    assert got == {r[0]: r[2] for r in rows}
    assert {r["language"] for r in langid.training_rows(df, total=40).collect()} == words.keys()
    monkeypatch.setattr(langid, "LANDMARKS", 40)
    assert langid.train(df).languages == list(words)


@pytest.mark.parametrize("text", ["", "a", "abc"])
def test_short_texts_have_no_grams(text):
    assert len(quality.grams(text.encode())) == 0

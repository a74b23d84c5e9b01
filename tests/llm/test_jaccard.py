"""The heavy-light Jaccard join against brute force."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS, by_key, prose, text_of
from tests.llm.test_dedup import roots
from wattledger.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text: str, words: int) -> set:
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or {tuple(found)}


def plain_components(rows, words=4, percent=85):
    sets = [plain_set(text_of(r), words) for r in rows]
    links = [(i, j) for i, j in combinations(range(len(rows)), 2) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    groups: dict = {}
    of = roots(len(rows), links)
    for r, root in zip(rows, of, strict=True):
        groups.setdefault(root, []).append(r[0])
    low = {root: min((i for i in ids if i is not None), default=None) for root, ids in groups.items()}
    return sorted(((r[0], len(s), low[root] if s else r[0]) for r, s, root in zip(rows, sets, of, strict=True)), key=repr)


COLUMNS = ["doc_id", "n_shingles", "component_id"]


def near_copies(seed: int) -> list[tuple]:
    """Texts of all sizes and copies that differ in some words, close to both sides of the bound."""
    rnd = random.Random(seed)
    texts = []
    for size in [1, 2, 3, 4, 5, 8, 9, 10, 12, 15, 18, 25, 40, 70, 150, 400]:
        for k in range(3):
            words = prose(seed * 1000 + size * 10 + k, size).split()
            texts.append(words)
            for _ in range(6):
                copy = list(words)
                for _ in range(rnd.randint(0, max(1, size // 25))):
                    at = rnd.randrange(len(copy) + 1)
                    copy[at : at + rnd.randint(0, 1)] = ["new"] * rnd.randint(0, 2)
                if rnd.random() < 0.3:
                    copy = copy[rnd.randint(0, max(0, size // 12)) :]
                texts.append(copy)
    rows = [(i, " ".join(w).upper() if i % 11 == 0 else " ".join(w), "en", "a", 1) for i, w in enumerate(texts)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("boundary", [0, 5, 16, None])
def test_near_copies_of_all_sizes(spark, monkeypatch, boundary):
    rows = near_copies(3)
    if boundary is not None:
        monkeypatch.setattr(jaccard, "choose_boundary", lambda costs, percent: boundary)
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    expected = plain_components(rows)
    assert by_key(jaccard.jaccard_components(df), *COLUMNS) == expected
    sizes = [c for _, _, c in expected]
    assert 20 < len(set(sizes)) < len(rows) - 100


@pytest.mark.parametrize("words, percent", [(3, 70), (4, 100), (1, 60)])
def test_other_parameters(spark, words, percent):
    rows = near_copies(words)
    found = jaccard.jaccard_components(spark.createDataFrame(rows, DOCUMENTS), words, percent)
    assert by_key(found, *COLUMNS) == plain_components(rows, words, percent)


def test_many_buckets_two_steps_and_short_blocks(spark, monkeypatch):
    """The switches of the plan change nothing: buckets dealt out twice, lists in blocks of four, slices of a few texts."""
    rows = near_copies(5)
    df = spark.createDataFrame(rows, DOCUMENTS).coalesce(2)
    expected = plain_components(rows)
    assert by_key(jaccard.jaccard_components(df, bucket_bytes=4000, max_buckets=4, block=4), *COLUMNS) == expected


def test_one_passage_in_many_texts_and_chains(spark):
    """A list of a third of all texts; a chain whose ends do not link; near copies without a common pivot."""
    passage = prose(1, 90)
    rows = [(i, f"{passage} {prose(100 + i, 12)}", "en", "a", 1) for i in range(60)]  # about 0.7 alike: no links
    words = prose(2, 120).split()
    for i in range(25):
        rows.append((200 + i, " ".join(words[i : i + 90]), "en", "a", 1))
    for i in range(40):
        copy = prose(3, 100).split()
        copy[2 * i] = f"changed{i}"
        rows.append((300 + i, " ".join(copy), "en", "a", 1))
    expected = plain_components(rows)
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(6)
    assert by_key(jaccard.jaccard_components(df, block=7), *COLUMNS) == expected
    component = {i: c for i, _, c in expected}
    assert {component[i] for i in range(200, 225)} == {200} and {component[i] for i in range(300, 340)} == {300}
    assert all(component[i] == i for i in range(60))


def test_awkward_rows(spark, awkward, awkward_rows):
    found = jaccard.jaccard_components(awkward)
    assert found.columns == COLUMNS
    assert by_key(found, *COLUMNS) == plain_components(awkward_rows)


def test_empty_tables_and_null_ids(spark, empty):
    assert jaccard.jaccard_components(empty).collect() == []
    rows = [(None, "a b c d e", None, None, None), (None, "a b c d e", None, None, None), (None, None, None, None, None)]
    assert by_key(jaccard.jaccard_components(spark.createDataFrame(rows, DOCUMENTS)), *COLUMNS) == plain_components(rows)
    with pytest.raises(ValueError):
        jaccard.jaccard_components(empty, percent=40)


def test_long_texts_are_split_in_parts(monkeypatch):
    """A text in parts has the set of the whole, wherever the parts are cut."""
    text = "\n ".join(prose(9, 3000).split()) + " " + "y" * 500 + " \t"
    whole = jaccard.shingle_sets(pa.array([text, "other"]))[0]
    for part in (64, 100, 1000):
        monkeypatch.setattr(jaccard, "PART", part)
        assert np.array_equal(jaccard.shingle_sets(pa.array([text]))[0], whole)
    assert len(whole) == len(plain_set(text, 4))


def test_boundary_is_where_the_cost_is_least():
    costs = {7: (100, 10_000), 20: (50, 60_000), 30: (10, 10)}
    n20 = 50 * jaccard.subsets_of(20, 85)
    assert n20 > 60_000  # enumerating them costs more than scanning, what lies below costs less
    assert jaccard.choose_boundary(costs, 85) == 7
    assert jaccard.choose_boundary({}, 85) == 0
    assert jaccard.subsets_of(7, 85) == 1 + 7


def test_subset_stars_hold_all_light_links(spark):
    """Sets of different sizes under one key: only those whose sizes allow it link with the smallest."""
    rows = near_copies(8)
    sets = {r[0]: plain_set(text_of(r), 4) for r in rows}
    small = {i: s for i, s in sets.items() if 0 < len(s) <= 15}
    data = [(i, len(s), sorted(hash(x) for x in s)) for i, s in small.items()]
    df = spark.createDataFrame(data, "cid long, n long, hashes array<long>")
    found = [(r["a"], r["b"]) for r in jaccard.light_links(df, 15, 85).collect()]
    assert all(100 * len(small[a] & small[b]) >= 85 * len(small[a] | small[b]) for a, b in found)
    ids = sorted(small)
    place = {i: k for k, i in enumerate(ids)}
    every = [(place[a], place[b]) for a, b in combinations(ids, 2) if 100 * len(small[a] & small[b]) >= 85 * len(small[a] | small[b])]
    assert roots(len(ids), every) == roots(len(ids), [(place[a], place[b]) for a, b in found])
    assert df.select(F.max("n")).first()[0] > 6

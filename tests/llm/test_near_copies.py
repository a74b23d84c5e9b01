"""Groups of near copies by both kinds of links, against brute force, and what stays of them."""

from __future__ import annotations

import random
from itertools import combinations

import pytest

from tests.llm.conftest import DOCUMENTS, by_key, prose, text_of
from tests.llm.test_dedup import plain_fingerprint, roots
from tests.llm.test_jaccard import plain_set
from wattledger.llm import near_copies


def plain_groups(rows):
    """(doc_id, smallest doc_id of its group) of each row."""
    prints = [plain_fingerprint(text_of(r)) for r in rows]
    sets = [plain_set(text_of(r), 5) for r in rows]
    links = []
    for i, j in combinations(range(len(rows)), 2):
        near = (prints[i] ^ prints[j]).bit_count() <= 3
        if near or sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            links.append((i, j))
    of = roots(len(rows), links)
    low: dict = {}
    for r, root in zip(rows, of, strict=True):
        if r[0] is not None:
            low[root] = min(low.get(root, r[0]), r[0])
    return [(r[0], low.get(root)) for r, root in zip(rows, of, strict=True)]


def edited(words: list[str], share: float, seed: int) -> str:
    rnd = random.Random(seed)
    out = list(words)
    for at in rnd.sample(range(len(out)), int(share * len(out))):
        out[at] = f"edit{rnd.randint(0, 10**6)}"
    return " ".join(out)


@pytest.fixture
def copies():
    rows = []
    for k in range(6):
        words = prose(900 + k, 300).split()
        rows.append((10 * k, " ".join(words), "en", "a", 1))
        rows += [(10 * k + 1 + i, edited(words, share, 50 * k + i), "en", "a", 1) for i, share in enumerate([0.003, 0.01, 0.02, 0.035, 0.08])]
    return rows


def test_near_copies_that_fingerprints_miss(spark, copies):
    """Texts of a similarity between 0.8 and 0.9 differ in more than three bits, and go all the same."""
    kept = near_copies.one_of_each_group(spark.createDataFrame(copies, DOCUMENTS).repartition(3))
    expected = [i for i, low in plain_groups(copies) if i == low]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)
    assert set(range(0, 60, 10)) <= set(expected) and 6 < len(expected) < 20
    assert len({p for p in (plain_fingerprint(r[1]) for r in copies)}) > 12


def test_awkward_rows_and_empty_tables(awkward, awkward_rows, empty):
    kept = near_copies.one_of_each_group(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # the row 7 that is there twice is a copy of row 1
    assert ids == sorted((i for i, low in plain_groups(awkward_rows) if i is None or i == low), key=repr)
    assert near_copies.one_of_each_group(empty).collect() == []


def test_rows_are_decided_one_by_one(spark):
    copied, unique, twice, one, two = (prose(60 + i, 40) for i in range(5))
    rows = [(1, copied), (5, copied), (5, unique), (9, twice), (9, twice), (9, twice), (4, one), (4, two), (12, two), (None, one), (None, one)]
    df = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], DOCUMENTS)
    expected = [(1, copied), (5, unique), (9, twice), (4, one), (4, two), (None, one), (None, one)]
    kept = near_copies.one_of_each_group(df.repartition(3))
    assert kept.columns == df.columns and dict(kept.dtypes) == dict(df.dtypes)
    assert by_key(kept, "doc_id", "text") == sorted(expected, key=repr)


def test_of_rows_with_one_text_and_other_columns_one_stays(spark):
    text = prose(6, 200)
    df = spark.createDataFrame([(3, text, "en", "b", 1), (3, text, "en", "a", 1), (3, text, None, "a", 1)], DOCUMENTS)
    kept = [near_copies.one_of_each_group(df.repartition(n)).collect() for n in (1, 3)]
    assert len(kept[0]) == 1 and kept[0] == kept[1]

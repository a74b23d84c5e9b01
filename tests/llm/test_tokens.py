"""Encoders, token counts, binary records and packing against the tokenizers library used plainly."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import DOCUMENTS, by_key, text_of
from wattledger.llm import counts, packing, records, tokens
from wattledger.llm.tokens import Encoder, default_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def plain_ids(name: str, texts: list[str]) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(default_path(name))
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_texts(n: int) -> list[str]:
    rnd = random.Random(7)
    parts = ["a", "B", "the", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", " ", " ", "　", "'s", "'LL", "1", "23", "½", "é",
             "é", "ß", "İ", "中", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "<|", "!", "...", "_", "×", "ª", "\x00", "​", "﻿"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_units_give_the_ids_of_the_library(name):
    texts = odd_texts(3000)
    encoder = Encoder(default_path(name), limit=50)
    assert encoder.kind == ("leading" if name.startswith("byte") else "dropped")
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some)]
        assert got == plain_ids(name, some)


def test_columns_give_the_ids_of_the_library(monkeypatch):
    """Texts cut into pieces all at once, in windows of any length, with nulls and in slices of a column."""
    rnd = random.Random(3)
    words = ["a", "the", "Don't", "'tis", "we'LL", "x1", "a12b", "!!'s", "é", "ÄÖÜ×÷ß", "naïve'S", "中文", "$5.00"]
    texts = [*odd_texts(2000), *("".join(rnd.choice(words) + rnd.choice(["", " ", "  ", "\n", "\n\n ", " \t"]) for _ in range(rnd.randint(0, 40))) for _ in range(1000))]
    for name in FILES:
        expected = plain_ids(name, texts)
        for window in (16, 100, 4 << 20):
            monkeypatch.setattr(tokens, "_WINDOW", window)
            encoder = Encoder(default_path(name), limit=300)
            column = pa.array([None, *texts])
            got = [x.tolist() for start in range(1, len(texts), 7) for x in encoder.encode_column(column[start : start + 7])]
            assert got == expected, window
            assert [x.tolist() for x in encoder.encode_column(column[:3])] == [[], *expected[:2]]
            assert encoder.encode_column(pa.array([], pa.string())) == []


def test_numbers_survive_packing():
    for numbers in ([], [0, 254, 255, 256, 70_000], [255] * 3):
        assert counts.unpack(counts.pack(np.array(numbers, dtype=np.int64))).tolist() == numbers


@pytest.mark.parametrize("block_bytes", [10 << 20, 300])
def test_token_counts(awkward, awkward_rows, block_bytes):
    got = by_key(counts.token_counts(awkward, limit=20, block_bytes=block_bytes), "doc_id", "n_bytes", "n_tokens", "over_limit")
    ids = plain_ids("byte_bpe_50k.json", [text_of(r) for r in awkward_rows])
    expected = [(r[0], len(text_of(r).encode()), len(x), len(x) > 20) for r, x in zip(awkward_rows, ids, strict=True)]
    assert got == sorted(expected, key=repr)


def test_token_counts_of_nothing(empty):
    assert counts.token_counts(empty).collect() == []


def test_frames_are_checked():
    data = records.frame(-5, np.array([1, 2, 70_000], "<u4")) + b"\n" + records.frame(None, np.array([], "<u4")) + b"\n"
    first = records.parse(data)
    assert (first[0], first[1].tolist()) == (-5, [1, 2, 70_000])
    second = records.parse(data, first[2])
    assert (second[0], second[1].tolist(), second[2]) == (None, [], len(data))
    for at in range(len(data) - 1):
        damaged = bytearray(data)
        damaged[at] ^= 4
        if at in (first[2] - 1, len(data) - 1):
            continue
        with pytest.raises(ValueError):
            records.parse(bytes(damaged), records.parse(bytes(damaged))[2])
    with pytest.raises(ValueError):
        records.parse(data[:-3], first[2])


@pytest.mark.parametrize("shard_bytes", [16 << 20, 20_000])
def test_records_round_trip(spark, awkward, awkward_rows, tmp_path, shard_bytes):
    where = str(tmp_path / "records")
    records.write_records(awkward, where, shard_bytes=shard_bytes)
    ids = [[*x, 1] for x in plain_ids("word_bpe_49k.json", [text_of(r) for r in awkward_rows])]
    expected = Counter((r[0], crc(x)) for r, x in zip(awkward_rows, ids, strict=True))
    rows = sorted(records.record_digests(spark, where).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in rows) == expected
    keys = [float("-inf") if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert keys == sorted(keys)
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
    # any order, any part
    index = records.read_index(spark, where)
    assert index.select("shard").distinct().count() > (1 if shard_bytes < 1 << 20 else 0)
    some = records.shuffled(index, 3).limit(5)
    got = records.read_records(spark, where, some).collect()
    assert sorted((r["shard"], r["offset"]) for r in got) == sorted((r["shard"], r["offset"]) for r in some.collect())
    assert all((r["doc_id"], zlib.crc32(r["ids"])) in expected for r in got)


SKEWED = {
    "one id has nearly all": [(7, f"text {i} " * 20) for i in range(3000)] + [(i, "other") for i in range(100)],
    "a few long texts": [(i, "short text") for i in range(2000)] + [(37 * i, "word " * 4000) for i in range(40)],
    "many without id": [(None, f"text {i} " * 20) for i in range(1500)] + [(i, "x y") for i in range(300)],
}


@pytest.mark.parametrize("case", list(SKEWED))
def test_shards_are_of_about_equal_size(spark, tmp_path, case):
    rows = SKEWED[case]
    shard_bytes, where = 30_000, str(tmp_path / "records")
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCUMENTS).repartition(5)
    shards = records._shards(df.select("doc_id", "text"), shard_bytes)
    of = shards.of([r[0] for r in rows], [r[1].encode() for r in rows])
    sizes = np.bincount(of, [len(r[1]) + 1 for r in rows], shards.count)
    assert sizes.max() <= 2 * shard_bytes + max(len(r[1]) for r in rows) and np.count_nonzero(sizes) > sizes.sum() / shard_bytes / 2
    records.write_records(df, where, shard_bytes=shard_bytes)
    found = sorted(records.record_digests(spark, where).collect(), key=lambda r: r["start"])
    ids = [[*x, 1] for x in plain_ids("word_bpe_49k.json", [r[1] for r in rows])]
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in found) == Counter((r[0], crc(x)) for r, x in zip(rows, ids, strict=True))
    keys = [float("-inf") if r["doc_id"] is None else r["doc_id"] for r in found]
    assert keys == sorted(keys)
    start = 0
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]


def test_extreme_ids_survive(spark, tmp_path):
    ends = [2**63 - 1, -(2**63), 2**63 - 2, None, 0, -1]
    rows = [(e, f"words of {e} {i} " * 30, None, None, None) for i in range(20) for e in ends]
    where = str(tmp_path / "records")
    records.write_records(spark.createDataFrame(rows, DOCUMENTS), where, shard_bytes=2000)
    found = records.record_digests(spark, where).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in rows), key=lambda x: float("-inf") if x is None else x)
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    assert records.read_index(spark, where).where("doc_id IS NULL").count() == 20


def test_records_of_nothing(spark, empty, tmp_path):
    where = str(tmp_path / "records")
    records.write_records(empty, where)
    assert records.record_digests(spark, where).collect() == []


def check_packing(rows, documents, capacity, end_id):
    ids = [[*x, end_id] for x in plain_ids("byte_bpe_50k.json", [t or "" for _, t in documents])]
    expected = Counter()
    for (doc_id, _), x in zip(documents, ids, strict=True):
        first = len(x) % capacity or capacity
        cuts = [0, *range(first, len(x), capacity), len(x)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[doc_id, piece, a, b - a, crc(x[a:b])] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 16])
def test_packing(awkward, awkward_rows, capacity):
    rows = packing.pack_documents(awkward, capacity=capacity).collect()
    n = check_packing(rows, [r[:2] for r in awkward_rows], capacity, 2)
    assert n == packing.lower_bound(Counter(r["length"] for r in rows), capacity)


def test_packing_of_nothing_and_of_test_data(spark, sf_dir, empty):
    assert packing.pack_documents(empty).collect() == []
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack_documents(documents).collect()
    n = check_packing(rows, [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()], 1024, 2)
    lengths = Counter(r["length"] for r in rows)
    assert n <= sum(k for _, k in packing.best_fit_decreasing(lengths, 1024))


def fewest_bins(lengths: list[int], capacity: int) -> int:
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    def place(i: int, bins: list[int]) -> None:
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for room in {b for b in bins if b >= lengths[i]}:
            rest = list(bins)
            rest.remove(room)
            place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(200))
def test_solutions_are_whole_and_the_fewest(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 20, 60, 100])
    lengths = [rnd.randint(1, capacity) if rnd.random() < 0.5 else rnd.randint(max(1, capacity // 6), capacity // 2) for _ in range(rnd.randint(1, 12))]
    solution = packing.solve(Counter(lengths), capacity)
    used = Counter()
    for filling, n in solution:
        assert sum(filling) <= capacity
        used.update({x: n * k for x, k in Counter(filling).items()})
    assert used == Counter(lengths)
    fewest = fewest_bins(lengths, capacity)
    assert packing.lower_bound(Counter(lengths), capacity) <= fewest
    assert sum(n for _, n in solution) == fewest


def test_every_undominated_filling_is_found():
    """Two sequences suffice only with the filling 524, 300, 120, 80, which no greedy continuation gives."""
    lengths = Counter([524, 480, 364, 300, 180, 120, 80])
    assert (524, 300, 120, 80) in list(packing.fillings(lengths, 524, 1024))
    assert sum(n for _, n in packing.solve(lengths)) == 2
    wastes = [1024 - sum(f) for f in packing.fillings(lengths, 524, 1024)]
    assert wastes == sorted(wastes)
    # many pieces of each length
    many = Counter({x: 1000 for x in lengths})
    assert sum(n for _, n in packing.solve(many)) == packing.lower_bound(many, 1024) == 2000


def test_a_hot_length_is_ranked_across_tasks(spark):
    rows = [(i, "same text for all", None, None, None) for i in range(3000)]
    documents = spark.createDataFrame(rows, DOCUMENTS).repartition(7)
    packed = packing.pack_documents(documents).collect()
    length = packed[0]["length"]
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == 3000
    assert len({r["sequence_id"] for r in packed}) == -(-3000 // (1024 // length))

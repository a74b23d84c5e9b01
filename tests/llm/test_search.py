"""Nearest neighbours and SentencePiece against brute force and the library."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tests.llm.conftest import text_of
from wattledger.llm import ann, spm
from wattledger.llm.tokens import default_path

VECTORS = "vec_id long, embedding array<double>"


def plain_neighbours(rows, queries, k=10):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = Counter(len(v) for _, v in usable).most_common(1)[0][0]
    candidates = sorted({(i, tuple(v)) for i, v in usable if len(v) == size})
    out = {}
    for q, v in queries:
        if (q, tuple(v or ())) not in candidates:
            continue
        near = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in candidates if i != q)
        out[q] = [(rank + 1, i, d) for rank, (d, i) in enumerate(near[:k])]
    return out


def found(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def awkward_vectors(n: int = 300):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).round(3).tolist()) for i in range(n)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(100)]  # a hot vector, ties by id
    rows += [(2000, None), (2001, [0.0] * 5), (2002, [1.0, None, 1.0, 1.0, 1.0]), (2003, [1.0, float("nan"), 1.0, 1.0, 1.0]), (2004, [float("inf")] * 5)]
    rows += [(2005, [1.0, 2.0]), (2006, []), (None, [1.0] * 5), (0, rows[0][1]), (1000, [1.0, 2.0, 3.0, 4.0, 5.0]), (-0, rows[0][1])]
    return rows


@pytest.mark.parametrize("shard_rows", [2048, 7])
def test_whole_index_is_exact(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(ann, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    rows = awkward_vectors()
    queries = [r for r in rows if r[0] is not None and r[0] % 10 == 0]
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows, VECTORS), spark.createDataFrame(queries, VECTORS), share=1.0, centroids=8))
    expected = plain_neighbours(rows, queries)
    assert got.keys() == expected.keys()
    for q, near in expected.items():
        assert [x[:2] for x in got[q]] == [x[:2] for x in near]
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in near], rtol=1e-14)


def test_few_candidates_and_none(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.5, 0.0, 0.0])]
    df = spark.createDataFrame(rows, VECTORS)
    assert [(r, i) for r, i, _ in found(ann.nearest_neighbours(df, df.where("vec_id = 1")))[1]] == [(1, 3), (2, 2)]
    assert ann.nearest_neighbours(df, df.where("false")).collect() == []
    assert ann.nearest_neighbours(df.where("false"), df).collect() == []
    one = df.where("vec_id = 1")
    assert ann.nearest_neighbours(one, one).collect() == []


def test_queries_of_other_lengths_take_no_answer_away(spark):
    """The index says which length counts, however many queries have another one."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    queries = rows[:3] + [(100 + i, [1.0, 2.0]) for i in range(5)] + [(200, [1.0] * 9)]
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows, VECTORS), spark.createDataFrame(queries, VECTORS), share=1.0, centroids=4))
    expected = plain_neighbours(rows, rows[:3])
    assert {q: [x[:2] for x in near] for q, near in got.items()} == {q: [x[:2] for x in near] for q, near in expected.items()}


@pytest.mark.parametrize("offset", [1e6, -3e8])
def test_vectors_far_from_the_origin(spark, offset):
    """Small distances between large components: the whole index is still exact, ties included."""
    rng = np.random.default_rng(5)
    rows = [(i, (offset + rng.normal(size=6) * 0.01).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]
    queries = [r for r in rows if r[0] % 10 == 0 or r[0] == 7]
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows, VECTORS), spark.createDataFrame(queries, VECTORS), share=1.0, centroids=8))
    expected = plain_neighbours(rows, queries)
    assert {q: [x[:2] for x in near] for q, near in got.items()} == {q: [x[:2] for x in near] for q, near in expected.items()}


def test_queries_go_to_shards_of_visited_cells_only():
    rng = np.random.default_rng(6)
    sizes = rng.integers(0, 3, 30)
    index = ann.MultiIndex((np.zeros((6, 1)), np.zeros((5, 1))), sizes, np.arange(30) // 2, np.where(np.arange(30) % 7 == 3, 3, 1))
    for _ in range(20):
        visited = rng.random(30) < 0.2
        expected = {s for c in range(30) if visited[c] and sizes[c] for s in range(index.shard[c], index.shard[c] + index.parts[c])}
        assert index.shards_of(visited).tolist() == sorted(expected)


def test_little_more_than_the_sample_reaches_the_driver(spark, monkeypatch):
    """Rows that are sorted for the driver, each partition of which would send it a whole sample, do not grow with the table."""
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(6000)], VECTORS).repartition(20)
    sorted_, order_by = [], type(df).orderBy

    def counted(self, *by, **how):
        sorted_.append(self.count())
        return order_by(self, *by, **how)

    with monkeypatch.context() as m:
        m.setattr(type(df), "orderBy", counted)
        assert ann.nearest_neighbours(df, df.where("vec_id < 3"), centroids=4, sample=400).count() == 30
    assert 400 <= max(sorted_) < 800


@pytest.mark.parametrize("sample", [1, 40, 299, 300, 1000])
def test_sample_is_of_the_smallest_hashes(spark, sample):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(bytearray(rng.normal(size=2).tobytes()),) for _ in range(300)], "vector binary")
    rows = df.selectExpr("xxhash64(vector) AS hash", "vector").collect()
    expected = [bytes(r["vector"]) for r in sorted(rows, key=lambda r: (r["hash"], r["vector"]))][:sample]
    assert ann._sampled(df, sample) == expected


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_regions_of_several_shards_are_exact(spark, monkeypatch, span):
    """Large cells that go over the end of a region, and several vectors of the query's own id."""
    monkeypatch.setattr(ann, "SHARD_ROWS", 7)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 16)
    monkeypatch.setattr(ann, "BLOCK_CELLS", 500)
    monkeypatch.setattr(ann.MultiIndex, "span", lambda *_: span)
    rng = np.random.default_rng(9)
    rows = awkward_vectors() + [(5, [1.0, 2.0, 3.0, 4.0, 5.0 + k / 1000]) for k in range(30)]
    rows += [(3000 + i, (50 + rng.normal(size=5) / 100).tolist()) for i in range(60)]
    queries = [r for r in rows if r[0] is not None and r[0] % 10 == 0] + rows[-70:-59]
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows, VECTORS), spark.createDataFrame(queries, VECTORS), share=1.0, centroids=8))
    expected = plain_neighbours(rows, [q for q in queries if q[0] != 5])
    assert {q: [x[:2] for x in near] for q, near in got.items() if q != 5} == {q: [x[:2] for x in near] for q, near in expected.items()}
    assert len(got[5]) == 10 and [x[1] for x in got[5]] == list(range(1000, 1010))


def test_regions_hold_the_cells_of_their_shards():
    rng = np.random.default_rng(10)
    sizes = rng.integers(0, 3, 30)
    index = ann.MultiIndex((np.zeros((6, 1)), np.zeros((5, 1))), sizes, np.arange(30) // 2, np.where(np.arange(30) % 7 == 3, 3, 1))
    for span in (1, 2, 5):
        regions = index.regions(span)
        for _ in range(20):
            visited = rng.random(30) < 0.2
            expected = {r for r, cells in regions.items() if visited[cells].any()}
            assert set((index.shards_of(visited) // span).tolist()) == expected


def test_regions_are_bounded_by_bytes():
    index = ann.MultiIndex((np.zeros((1, 1)), np.zeros((1, 1))), np.array([1 << 40]), np.array([0]), np.array([1 << 29]))
    for dimension in (1, 64, 5000):
        span = index.span(dimension, 6)
        assert span == 1 or 8 * dimension * ann.SHARD_ROWS * span <= ann.REGION_BYTES
    assert ann.MultiIndex(index.books, np.array([9]), np.array([0]), np.array([1])).span(64, 6) == 1


def test_extra_columns_do_not_matter(spark):
    df = spark.createDataFrame(awkward_vectors(40), VECTORS)
    plain = found(ann.nearest_neighbours(df, df, share=1.0))
    wide = df.selectExpr("*", "1 AS id", "'x' AS vector", "2 AS cell", "3 AS score", "4 AS shard")
    assert found(ann.nearest_neighbours(wide, wide, share=1.0)) == plain


def test_recall_on_test_data(spark, sf_dir):
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in embeddings.collect()]
    queries = [r for r in rows if r[0] % 20 == 0]
    got = found(ann.nearest_neighbours(embeddings, embeddings.where("vec_id % 20 = 0")))
    expected = plain_neighbours(rows, queries)
    hits = [len({i for _, i, _ in got[q]} & {i for _, i, _ in near}) / len(near) for q, near in expected.items()]
    assert np.mean(hits) >= 0.9


def test_cells_are_visited_in_the_order_of_their_distance():
    rng = np.random.default_rng(2)
    books = rng.normal(size=(6, 2)), rng.normal(size=(5, 3))
    index = ann.MultiIndex(books, rng.integers(0, 4, 30), np.zeros(30), np.ones(30))
    for _ in range(50):
        v = rng.normal(size=5)
        distance = (((books[0] - v[:2]) ** 2).sum(1)[:, None] + ((books[1] - v[2:]) ** 2).sum(1)).ravel()
        for entries in (1, 7, 30, 10_000):
            visited = index.visited(v, entries)
            order = np.argsort(distance)
            n = int(visited.sum())
            assert set(order[:n]) == set(np.flatnonzero(visited))
            assert index.sizes[visited].sum() >= min(entries, index.sizes.sum())
            assert n == 30 or index.sizes[order[: n - 1]].sum() < entries


# SentencePiece


@pytest.fixture(scope="module")
def unigram_path(tmp_path_factory):
    """The pieces of the public model as a unigram model, whose weights are the scores."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(default_path(spm.MODEL), "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    for p in proto.pieces:
        if p.type == p.NORMAL:
            p.score = -5.0 - (zlib.crc32(p.piece.encode()) % 9973) / 1000 - p.score / 1e5  # no two paths weigh the same
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def texts(n: int) -> list[str]:
    rnd = random.Random(3)
    parts = ["a", "in", "ing", "the", " ", "  ", "\n", "\t", "é", "ß", "中", "\U0001f600", "<s>", "<0x41>", "▁", "0", "12", "!", "...", "\x00", "Q"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(n)] + ["a" * 200, "ing" * 90]


def library(path: str):
    return sentencepiece.SentencePieceProcessor(model_file=path)


@pytest.fixture(params=["bpe", "unigram"])
def model_path(request, unigram_path):
    return default_path(spm.MODEL) if request.param == "bpe" else unigram_path


def test_ids_are_those_of_the_library(model_path):
    model, plain = spm.Model(model_path), library(model_path)
    for text in texts(600):
        ids = plain.encode(text)
        assert np.frombuffer(model.encode(model.normalize(text)), "<u4").tolist() == ids, text
        assert model.decode(np.array(ids, dtype=np.uint32)) == plain.decode(ids)


@pytest.mark.parametrize("size", [1, 3, 20, 50])
def test_chunks_are_scanned_to_the_same_ids(model_path, size):
    model, plain = spm.Model(model_path), library(model_path)
    for text in texts(60):
        whole = model.normalize(text)
        around = model.longest + 1
        chunks = []
        for begin in range(0, max(len(whole), 1), size):
            low, stop = max(0, begin - around), min(begin + size, len(whole))
            chunks.append((low, begin - low, stop - low, whole[low : stop + around]))
        matrices = []
        for low, start, stop, part in chunks:
            found = model.transfer(part, start, stop)
            matrices.append({(a + low, p): {(b + low, q): w for (b, q), w in row.items()} for (a, p), row in found.items()})
        states = spm.boundary_states(matrices)
        ids = b""
        for (low, start, stop, part), (a, p), (b, q) in zip(chunks, states, states[1:], strict=False):
            ids += model.between(part, start, stop, (a - low, p), (b - low, q))
        found, expected = np.frombuffer(ids, "<u4").tolist(), plain.encode(text)
        if model.bpe:
            assert found == expected, text
        else:  # equally heavy paths may differ
            assert plain.decode(found) == plain.decode(expected)
            weight = lambda x: sum(model.score.get(plain.id_to_piece(i), 0.0) for i in x)
            assert abs(weight(found) - weight(expected)) < 1e-3


def test_products_are_associative():
    rnd = random.Random(1)
    states = [(i, "") for i in range(4)]
    a, b, c = ({s: {t: rnd.randint(-9, 0) for t in states if rnd.random() < 0.7} for s in states} for _ in range(3))
    clean = lambda m: {s: row for s, row in m.items() if row}
    assert clean(spm.product(spm.product(a, b), c)) == clean(spm.product(a, spm.product(b, c)))


@pytest.mark.parametrize("chunk", [spm.CHUNK, 64])
def test_encode_and_decode_on_spark(awkward, awkward_rows, chunk):
    plain = library(default_path(spm.MODEL))
    ids = [plain.encode(text_of(r)) for r in awkward_rows]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    expected = Counter(
        (r[0], len(x), crc(x), len(t := plain.decode(x)), zlib.crc32(t.encode())) for r, x in zip(awkward_rows, ids, strict=True)
    )
    assert Counter(tuple(r) for r in spm.encoding_digests(awkward, chunk=chunk).collect()) == expected


def test_a_giant_text_without_spaces(spark):
    rnd = random.Random(4)
    text = "".join(rnd.choice("abinger") for _ in range(6000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ids = spm.encode_documents(df, chunk=500).collect()[0]["ids"]
    assert np.frombuffer(ids, "<u4").tolist() == library(default_path(spm.MODEL)).encode(text)


def test_encoding_of_nothing(empty):
    assert spm.encoding_digests(empty).collect() == []

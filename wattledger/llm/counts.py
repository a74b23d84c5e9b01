"""Token counts: pieces are counted once per distinct pre-token and joined to per-document pre-token frequencies.

1. Documents are grouped into blocks of at most ``block_bytes`` of text, where they lie. A block keeps, for each of its
   documents, the frequencies of its distinct units (see ``tokens.Encoder.units``) and one dictionary of the units.
2. The dictionaries are dealt by a hash of the unit, in slices: all blocks' copies of a unit meet in one place and its
   pieces are counted once there. A unit as frequent as can be is one entry per block.
3. The counts of each slice return to their block, where frequencies times counts are summed per document.

No ids are kept, and what is shuffled are dictionaries and frequencies, not texts.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import map_arrow, shuffle_partitions, slices, texts_of
from wattledger.llm.tokens import default_path, encoder
from wattledger.plans.storage import scratch_dir

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
BLOCK_BYTES = 10 << 20

_BLOCK = """block long, doc_ids array<long>, n_bytes array<long>, distinct array<int>, ordinals binary, frequencies binary,
buckets binary, sizes array<int>, units array<binary>"""
_ZSTD = pa.Codec("zstd", compression_level=1)
_LARGE = 255


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative numbers, mostly below 255: a byte each, larger ones in four bytes after them, all compressed."""
    small = np.minimum(numbers, _LARGE).astype(np.uint8)
    raw = small.tobytes() + numbers[numbers >= _LARGE].astype("<u4").tobytes()
    return len(numbers).to_bytes(4, "little") + len(raw).to_bytes(4, "little") + _ZSTD.compress(raw, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    raw = _ZSTD.decompress(data[8:], size, asbytes=True)
    out = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    out[out == _LARGE] = np.frombuffer(raw, "<u4", offset=n)
    return out


def _block(block: int, ids: list, texts: list[bytes], path: str, buckets: int) -> dict:
    """Units are numbered as they first occur, so that the sorted numbers of a document lie close to each other."""
    units_of = encoder(path).units
    ordinal: defaultdict[str, int] = defaultdict(count().__next__)
    distinct, steps, frequencies = [], [], []
    for text in texts:
        found = np.fromiter(map(ordinal.__getitem__, units_of(text.decode())), dtype=np.int64)
        which, how_often = np.unique(found, return_counts=True)
        distinct.append(len(which))
        steps.append(np.diff(which, prepend=0))
        frequencies.append(how_often)
    names = [u.encode() for u in ordinal]
    bucket = np.array([zlib.crc32(u) % buckets for u in names], dtype=np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(sizes)
    packed = []
    for b in range(buckets):
        mine = [names[i] for i in order[ends[b] - sizes[b] : ends[b]]]
        joined = b"".join(mine)
        lengths = pack(np.array([len(u) for u in mine], dtype=np.int64))
        packed.append(len(lengths).to_bytes(4, "little") + len(joined).to_bytes(4, "little") + lengths + _ZSTD.compress(joined, asbytes=True))
    together = lambda parts: pack(np.concatenate(parts) if parts else np.empty(0, np.int64))
    return {
        "block": block,
        "doc_ids": ids,
        "n_bytes": [len(t) for t in texts],
        "distinct": distinct,
        "ordinals": together(steps),
        "frequencies": together(frequencies),
        "buckets": pack(bucket),
        "sizes": sizes.tolist(),
        "units": packed,
    }


def _units(packed: bytes) -> list[bytes]:
    head, size = int.from_bytes(packed[:4], "little"), int.from_bytes(packed[4:8], "little")
    joined = _ZSTD.decompress(packed[8 + head :], size, asbytes=True)
    ends = np.cumsum(unpack(packed[8 : 8 + head])).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _blocks(path: str, buckets: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 32)
        schema = pa.schema(
            [
                ("block", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())),
                ("n_bytes", pa.list_(pa.int64())),
                ("distinct", pa.list_(pa.int32())),
                ("ordinals", pa.binary()),
                ("frequencies", pa.binary()),
                ("buckets", pa.binary()),
                ("sizes", pa.list_(pa.int32())),
                ("units", pa.list_(pa.binary())),
            ]
        )
        ids: list = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for part in slices(batch, block_bytes):
                own = texts_of(part)
                if texts and held + sum(map(len, own)) > block_bytes:
                    yield pa.RecordBatch.from_pylist([_block(next(number), ids, texts, path, buckets)], schema)
                    ids, texts, held = [], [], 0
                ids += part.column(0).to_pylist()
                texts += own
                held += sum(map(len, own))
        if ids:
            yield pa.RecordBatch.from_pylist([_block(next(number), ids, texts, path, buckets)], schema)

    return run


def _count_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            counts = []
            for packed in batch.column(2).to_pylist():
                units = _units(packed)
                for u in units:
                    if u not in known:
                        known[u] = len(encoder(path).ids(u.decode()))
                counts.append(pack(np.array([known[u] for u in units], dtype=np.int64)))
                if len(known) > 1_000_000:  # bounds memory; such units are counted again when they come again
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.binary())], ["block", "bucket", "counts"])

    return run


def _sum_documents(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.concatenate([np.empty(0, np.int64), *(unpack(c) for _, c in sorted((x["bucket"], x["counts"]) for x in row["answers"] or []))])
            n = np.empty_like(counts)
            n[np.argsort(unpack(row["buckets"]), kind="stable")] = counts
            distinct = np.array(row["distinct"], dtype=np.int64)
            ends = np.cumsum(distinct)
            steps = unpack(row["ordinals"])
            summed = np.concatenate([[0], np.cumsum(steps)])  # numbers start anew with each document
            which = summed[1:] - np.repeat(summed[ends - distinct], distinct)
            total = np.concatenate([[0], np.cumsum(unpack(row["frequencies"]) * n[which])])
            tokens = total[ends] - total[ends - distinct]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )


def token_counts(documents: DataFrame, tokenizer_path: str | None = None, limit: int = LIMIT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every row of ``documents`` (doc_id, text).

    A null text counts as empty (0 bytes, 0 tokens); a null doc_id stays null; repeated rows are counted one by one;
    other columns are ignored; an empty table gives no rows. A block holds one text at least, however long it is.
    The blocks are written below ``spark.checkpoint.dir``, so that a lost executor does not bring the texts back.
    """
    spark = documents.sparkSession
    path = tokenizer_path or default_path(TOKENIZER)
    buckets = max(64, shuffle_partitions(spark))
    where = f"{scratch_dir(spark)}/blocks"
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    map_arrow(narrow, _blocks(path, buckets, block_bytes), _BLOCK).write.option("compression", "zstd").parquet(where)
    blocks = spark.read.parquet(where)

    parts = blocks.select("block", F.posexplode(F.arrays_zip("sizes", "units")).alias("bucket", "part"))
    parts = parts.where("part.sizes > 0").select("block", "bucket", F.col("part.units").alias("units"))
    counted = map_arrow(parts.repartition("bucket"), _count_pieces(path), "block long, bucket int, counts binary")
    answers = counted.groupBy("block").agg(F.collect_list(F.struct("bucket", "counts")).alias("answers"))
    per_document = blocks.select("block", "doc_ids", "n_bytes", "distinct", "ordinals", "frequencies", "buckets").join(answers, "block", "left")
    return map_arrow(
        per_document,
        lambda batches: _sum_documents(batches, limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )

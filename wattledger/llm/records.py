"""Token ids in length-delimited binary records, with masked checksums and a separate offset index.

A record is, with all numbers little-endian::

    length      unsigned 64-bit   bytes of the payload
    length_crc  unsigned 32-bit   masked CRC-32 of the eight length bytes
    payload     doc_id (signed 64-bit), id width in bytes (unsigned 8-bit: 2 or 4, with 128 added if doc_id is null), ids
    payload_crc unsigned 32-bit   masked CRC-32 of the payload
    end         one byte 0x0A

The mask rotates a checksum right by 15 bits and adds a constant, so that records which hold checksums themselves do
not look valid at a wrong offset. The end byte is not needed to read; it lets Spark's text writer write the files, so
that its commit protocol covers retried and speculative tasks on any file system that Spark knows.

Files lie in ``records/shard=K/``, ascending in doc_id within and across shards. ``index`` (Parquet) has shard, doc_id,
offset, size and n_tokens of each record, for reading records in any order without parsing what lies between.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattledger.llm.common import map_arrow, slices
from wattledger.llm.tokens import default_path, encoder
from wattledger.plans.storage import scratch_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SLICE = 2 << 20  # bytes of text encoded together
SHARD_BYTES = 16 << 20  # of text; a shard is written and read by one task

# fixed value: the customary mask of record files
_MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_INFO = struct.Struct("<qB")
_CRC = struct.Struct("<I")
_NO_ID = 0x80  # added to the width where doc_id is null


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record without its end byte, which the writer adds. Ids take two bytes each if all of them fit."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    payload = _INFO.pack(doc_id or 0, width + _NO_ID * (doc_id is None)) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + _CRC.pack(masked_crc(length)) + payload + _CRC.pack(masked_crc(payload))


def parse(data, offset: int = 0) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids as unsigned 32-bit, offset of the next record) of the record at ``offset``.

    Raises ValueError if a checksum or a length does not fit.
    """
    if offset + _HEAD.size > len(data):
        raise ValueError(f"record cut off at byte {offset}")
    length, crc = _HEAD.unpack_from(data, offset)
    start = offset + _HEAD.size
    if masked_crc(bytes(data[offset : offset + 8])) != crc or start + length + 5 > len(data):
        raise ValueError(f"damaged length at byte {offset}")
    payload = bytes(data[start : start + length])
    if masked_crc(payload) != _CRC.unpack_from(data, start + length)[0]:
        raise ValueError(f"damaged payload at byte {offset}")
    doc_id, width = _INFO.unpack_from(payload)
    ids = np.frombuffer(payload, f"<u{width & ~_NO_ID}", offset=_INFO.size).astype("<u4")
    return (None if width & _NO_ID else doc_id), ids, start + length + 5


@dataclass(frozen=True)
class Shards:
    """Which shards a document may go to: ids from one edge up to the next are a range, null ids the first; ranges make groups,
    and a group has one shard, or several if it is a single id with more bytes than a shard should have."""

    edges: np.ndarray
    group: np.ndarray  # of each range
    first: np.ndarray  # shard of each group
    parts: np.ndarray  # shards of each group

    def of(self, doc_ids: list[int | None], records: list[bytes]) -> np.ndarray:
        """Records of one id are dealt by their checksums, since their order is free."""
        group = self.group[_place(self.edges, doc_ids)]
        checks = np.array([zlib.crc32(r) for r in records], dtype=np.int64)
        return self.first[group] + (checks * self.parts[group] >> 32)

    @property
    def count(self) -> int:
        return int(self.parts.sum())


def _place(edges: np.ndarray, doc_ids: list[int | None]) -> np.ndarray:
    known = np.array([0 if d is None else d for d in doc_ids], dtype=np.int64)
    null = np.array([d is None for d in doc_ids], dtype=bool)
    return np.where(null, 0, 1 + np.searchsorted(edges, known, "right"))


def plan_shards(edges: np.ndarray, sizes: np.ndarray, shard_bytes: int) -> Shards:
    """Neighbouring ranges together up to ``shard_bytes``; sizes: bytes of each range, the null ids first."""
    single = np.zeros(len(sizes), bool)
    single[0] = True
    single[2:-1] = edges[1:] - edges[:-1] == 1
    group, parts, held = [], [], 0
    for size, alone in zip(sizes.tolist(), single.tolist(), strict=True):
        large = alone and size > shard_bytes
        if not parts or large or parts[-1] > 1 or held + size > shard_bytes:
            parts.append(-(-size // shard_bytes) if large else 1)
            held = 0
        held += size
        group.append(len(parts) - 1)
    parts = np.array(parts, dtype=np.int64)
    return Shards(edges, np.array(group), np.cumsum(parts) - parts, parts)


def _shards(narrow: DataFrame, shard_bytes: int) -> Shards:
    """Shards of about ``shard_bytes`` of text each, however bytes are spread over ids.

    Edges are quantiles of a sample in which a document is as often as its bytes come to; then the bytes of every range are
    counted. The sample decides about balance only. An id that the sample repeats becomes a range of its own.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    total = narrow.agg(F.sum(size)).first()[0] or 0
    shards = 1 + total // shard_bytes
    edges = np.zeros(0, np.int64)
    if shards > 1:
        chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
        times = F.floor(size * 8 / F.lit(float(shard_bytes)) + chance).cast("int")
        sample = narrow.where("doc_id IS NOT NULL").select("doc_id", times.alias("times")).where("times > 0")
        sample = sample.select("doc_id", F.explode(F.sequence(F.lit(1), "times")))
        probes = [i / (2 * shards) for i in range(1, 2 * shards)]
        ids = sample.agg(F.percentile_approx("doc_id", probes, min(10_000_000, 8 * len(probes)))).first()[0] or []
        twice = {a for a, b in zip(ids, ids[1:], strict=False) if a == b}
        edges = np.array(sorted({*ids, *(i + 1 for i in twice if i + 1 < 2**63)}), dtype=np.int64)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(len(edges) + 2, np.int64)
        for batch in batches:
            np.add.at(sizes, _place(edges, batch.column(0).to_pylist()), batch.column(1).to_numpy())
        used = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sizes[used])], ["place", "bytes"])

    sizes = np.zeros(len(edges) + 2, np.int64)
    summed = map_arrow(narrow.select("doc_id", size.alias("bytes")), counted, "place long, bytes long").groupBy("place").agg(F.sum("bytes"))
    for place, n in summed.collect():  # some rows for each shard
        sizes[place] = n
    return plan_shards(edges, sizes, shard_bytes)


def _frames(path: str, end_id: int, shards: Shards):
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                doc_ids = part.column(0).to_pylist()
                frames = [frame(d, np.concatenate([x, end])) for d, x in zip(doc_ids, encoder(path).encode_column(part.column(1)), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards.of(doc_ids, frames).astype(np.int32)), part.column(0), pa.array(frames, pa.binary())], ["shard", "doc_id", "record"]
                )

    return run


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = data.as_buffer()
            doc_ids, offsets, sizes, counts, offset = [], [], [], [], 0
            while offset < len(data):
                doc_id, ids, after = parse(data, offset)
                doc_ids.append(doc_id)
                offsets.append(offset)
                sizes.append(after - offset)
                counts.append(len(ids))
                offset = after
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["shard", "doc_id", "offset", "size", "n_tokens"],
            )


def _files(spark: SparkSession, where: str) -> DataFrame:
    """shard and content of every file; no row for a dataset without records."""
    files = spark.read.format("binaryFile").load(f"{where}/records")
    return files.select(F.regexp_extract("path", "shard=([0-9]+)", 1).cast("int").alias("shard"), "content")


def write_records(
    documents: DataFrame, where: str, tokenizer_path: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES
) -> None:
    """Encode ``documents`` (doc_id, text) and write records and index below the folder ``where``, which must not exist.

    Documents are dealt to shards by ranges of doc_id with about ``shard_bytes`` of text each (see ``Shards``); texts are
    encoded before they move, so that ids move and not texts. A null text is empty: only the end id. A null doc_id sorts first. Repeated
    rows give a record each. Other columns are ignored. An empty table gives an index without rows.
    """
    spark = documents.sparkSession
    path = tokenizer_path or default_path(TOKENIZER)
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = _shards(narrow, shard_bytes)
    frames = map_arrow(narrow, _frames(path, end_id, shards), "shard int, doc_id long, record binary")
    (
        frames.repartitionById(shards.count, "shard")
        .sortWithinPartitions("shard", "doc_id", "record")
        .select("shard", F.col("record").cast("string").alias("value"))
        .write.partitionBy("shard")
        .text(f"{where}/records")
    )
    schema = "shard int, doc_id long, offset long, size long, n_tokens long"
    map_arrow(_files(spark, where), _index, schema).write.parquet(f"{where}/index")


def read_index(spark: SparkSession, where: str) -> DataFrame:
    return spark.read.schema("shard int, doc_id long, offset long, size long, n_tokens long").parquet(f"{where}/index")


def _rows(shard: int, data: pa.Buffer, places: Iterator[int]) -> Iterator[pa.RecordBatch]:
    """The records at the offsets given, a thousand at a time, with the number of ids read before each."""
    before = 0
    while some := list(islice(places, 1000)):
        rows = [parse(data, offset)[:2] for offset in some]
        counts = np.array([len(ids) for _, ids in rows], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(rows), pa.int32()),
                pa.array(some, pa.int64()),
                pa.array([doc_id for doc_id, _ in rows], pa.int64()),
                pa.array(before + np.cumsum(counts) - counts),
                pa.array([ids.tobytes() for _, ids in rows], pa.binary()),
            ],
            ["shard", "offset", "doc_id", "before", "ids"],
        )
        before += int(counts.sum())


def _in_order(data: pa.Buffer) -> Iterator[int]:
    offset = 0
    while offset < len(data):
        yield offset
        offset += _HEAD.size + int.from_bytes(data.slice(offset, 8).to_pybytes(), "little") + 5


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield from _rows(shard, data.as_buffer(), _in_order(data.as_buffer()))


def read_records(spark: SparkSession, where: str, wanted: DataFrame | None = None) -> DataFrame:
    """shard, offset, doc_id, ids (binary, 4 bytes each) and before (ids of its shard read earlier) of records.

    wanted: rows of the index; each is found by its offset. Without it all files are read from end to end, each where it
    lies. Every record is checked against its checksums.
    """
    schema = "shard int, offset long, doc_id long, before long, ids binary"
    if wanted is None:
        return map_arrow(_files(spark, where), _whole, schema)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, places, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                yield from _rows(shard, data.as_buffer(), iter(places))

    offsets = wanted.groupBy("shard").agg(F.sort_array(F.collect_list("offset")).alias("places"))  # of one file's records
    both = offsets.join(_files(spark, where), "shard").select("shard", "places", "content")
    return map_arrow(both, chosen, schema)


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index in an order that ``seed`` fixes, with ``position`` in it: for one epoch of training."""
    key = F.xxhash64(F.lit(seed), "shard", "offset")
    return index.withColumn("position", key).orderBy("position", "shard", "offset")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _whole(batches):
        shard, _, doc_id, before, ids = batch.columns
        ids = ids.to_pylist()
        yield pa.RecordBatch.from_arrays(
            [shard, doc_id, before, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())],
            ["shard", "doc_id", "before", "n_tokens", "ids_crc32"],
        )


def record_digests(spark: SparkSession, where: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each record, as read back from the files.

    ``start`` counts the ids of all records before: those of the same file as they are read, those of earlier shards by a
    running sum over one row per shard of the index. Ids are digested in the task that reads them, and do not leave it.
    """
    rows = map_arrow(_files(spark, where), _digests, "shard int, doc_id long, before long, n_tokens long, ids_crc32 long")
    per_shard = read_index(spark, where).groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    earlier = per_shard.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("earlier"))
    return rows.join(earlier, "shard").select("doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def write_and_digest(documents: DataFrame) -> DataFrame:
    """Write ``documents`` as records below ``spark.checkpoint.dir`` and return ``record_digests`` of the files."""
    where = scratch_dir(documents.sparkSession)
    write_records(documents, where)
    return record_digests(documents.sparkSession, where)

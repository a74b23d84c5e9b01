"""Links between documents whose word shingles overlap, by a size-aware heavy-light join.

Small sets are enumerated, large sets scan inverted lists, and the boundary between them is where both together cost least
(Deng, Tao and Li, 2018, carried over from a fixed overlap to a Jaccard bound):

1. Screen. A shingle that only one text has links nothing. Texts send their hashes to buckets of hashes, packed, and get back
   how many of them others have too; where that is less than a link needs, the text is done.
2. Lists. What is left is one set for each different text. Its shingles are ordered by the length of their lists, shortest
   first, and only the first few can be the first one that two linked sets share: a set is in the lists of these.
3. Boundary. Sets of n elements link over subsets of c elements, c from the smallest overlap that n allows up to n. For each
   small n the number of those subsets is held against the lengths of the lists to scan.
4. Light sets, up to the boundary, go to the keys of their subsets. Under one key all sets share c elements; who links at c is
   a matter of sizes, and if any two of them do, both link with the smallest: a star holds them together.
5. Heavy sets, beyond the boundary, scan their lists. Members are first held against one pivot of their list and size class, the
   one with the fewest rarer shingles, which is the most like all others, and what links is joined to components. Then only pairs across components are left; a list is cut into blocks for them, so that
   no task has more than two blocks of it. Candidates are confirmed on their whole sets.

Links are a spanning set: every link between different texts joins documents that the result has in one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import importable, map_arrow, slices
from wattledger.llm.components import connected_components
from wattledger.llm.runs import numbered_words
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import scratch_dir, written

WORDS = 4
PERCENT = 85
SLICE = 2 << 20  # bytes of text whose hashes are packed together
PART = 1 << 20  # bytes of a longer text that are split into words together
BUCKET_BYTES = 12 << 20  # of text, for each bucket of hashes
MAX_BUCKETS = 1 << 10  # dealt out at once; more are dealt out in two steps
MAX_REPLIES = 1 << 12  # ranges of texts that counts are sent back to
BLOCK = 2_000  # members of a list in one block
LIGHT = 64  # sizes that the boundary may have
SALTED = 500  # pairs of one set that go to one key
_MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64 bits that leaves no pattern of its input."""
    x = (x ^ (x >> np.uint64(32))) * _MULTIPLIERS[seed]
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLIERS[2]
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, and where each text begins. Only A-Z are lower-cased."""
    numbers, offsets, known = numbered_words(pc.ascii_lower(pc.fill_null(texts, "")))
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in known.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    return (hashes[numbers] if len(numbers) else np.zeros(0, np.uint64)), offsets


def _parts(text: pa.Array) -> Iterator[pa.Array]:
    """A single text in parts of about a megabyte, cut where white space is."""
    data = np.frombuffer(text.cast(pa.binary())[0].as_buffer(), np.uint8)
    start = 0
    while start < len(data):
        stop, step = start + PART, PART
        while stop < len(data):
            blank = np.flatnonzero(_BLANK[data[stop : stop + step]])
            if len(blank):
                stop += int(blank[0])
                break
            stop += step
        stop = min(stop, len(data))
        yield pa.array([data[start:stop].tobytes()], pa.binary()).cast(pa.string())
        start = stop


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; of all its words, where it has fewer."""
    if len(texts) == 1 and texts[0].is_valid and texts[0].as_buffer().size > 2 * PART:
        hashes = np.concatenate([word_hashes(part)[0] for part in _parts(texts)])
        offsets = np.array([0, len(hashes)])
    else:
        hashes, offsets = word_hashes(texts)
    many = max(0, len(hashes) - words + 1)
    grams = np.full(many, words, np.uint64)
    for i in range(words):
        grams *= _MULTIPLIERS[0]
        grams += mixed(hashes[i : i + many], 1) if i == 0 else hashes[i : i + many]
        grams ^= grams >> np.uint64(31)
    grams = mixed(grams)
    out = []
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if stop - start >= words:
            out.append(np.unique(grams[start : stop - words + 1]))
        elif stop > start:
            whole = xxhash.xxh3_64_intdigest(hashes[start:stop].tobytes(), seed=stop - start)
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def least_overlap(n: int, percent: int) -> int:
    """Elements that a set of n elements shares with any set it links with."""
    return -(-percent * n // 100)


def subsets_of(n: int, percent: int) -> int:
    """How many subsets a light set of n elements goes to."""
    return sum(comb(n, c) for c in range(least_overlap(n, percent), n + 1))


def _packed(hashes: np.ndarray, owner: np.ndarray, keys: np.ndarray, bucket: np.ndarray, width: str) -> Iterator[tuple]:
    """(bucket, keys, hashes of each key, hashes): one row for each bucket."""
    order = np.argsort(bucket.astype(np.int64) * len(keys) + owner, kind="stable")
    bucket, owner, hashes = bucket[order], owner[order], hashes[order].astype(width)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
        if high > low:
            own, counts = np.unique(owner[low:high], return_counts=True)
            yield int(bucket[low]), keys[own].tobytes(), counts.astype("<u4").tobytes(), hashes[low:high].tobytes()


_SCREEN = "doc_id long, k1 long, k2 long, n long, shared long, bucket int, keys binary, counts binary, hashes binary"


def _screen_rows(rows: list[tuple], doc_ids=None, k1=None, k2=None, n=None) -> pa.RecordBatch:
    """Rows of documents, if given, and packed rows, in the columns of ``_SCREEN``."""
    names = [f.split()[0] for f in _SCREEN.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.binary()] * 3
    if doc_ids is not None:
        columns = [doc_ids, k1, k2, n, *[pa.nulls(len(doc_ids))] * 5]
    else:
        shared, bucket, keys, counts, hashes = zip(*rows, strict=True)
        own = pa.array(np.frombuffer(b"".join(keys), "<i8")) if bucket[0] is None else pa.nulls(len(rows))
        columns = [pa.nulls(len(rows)), own, *[pa.nulls(len(rows))] * 2, pa.array(shared, pa.int64()), pa.array(bucket, pa.int32()), *(pa.array(x, pa.binary()) for x in (keys, counts, hashes))]
    return pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds, strict=True)], names)


def _screened(words: int, buckets: int, width: str):
    """For each slice of texts: one row a document, the hashes for each bucket, and what the slice itself shows to be shared.

    Of a hash that several texts of the slice have, two go on, so that the bucket knows it as shared however often it
    occurs here; the others are counted at once. So a shingle of a third of all texts is sent twice a slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                sets = shingle_sets(part.column(1), words)
                k1 = part.column(2).to_numpy()
                yield _screen_rows([], part.column(0), part.column(2), part.column(3), pa.array([len(s) for s in sets], pa.int64()))
                keys, first = np.unique(k1, return_index=True)  # copies count once
                hashes = np.concatenate([sets[i] for i in first])
                owner = np.repeat(np.arange(len(keys)), [len(sets[i]) for i in first])
                del sets
                order = np.argsort(hashes)
                hashes, owner = hashes[order], owner[order].astype(np.int32)
                new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
                rank = np.arange(len(hashes)) - np.repeat(new, np.diff(np.append(new, len(hashes))))
                del order, new
                known, counts = np.unique(owner[rank > 1], return_counts=True)
                rows = [(int(c), None, keys[k : k + 1].tobytes(), b"", b"") for k, c in zip(known.tolist(), counts.tolist(), strict=True)]
                if rows:
                    yield _screen_rows(rows)
                on = rank < 2
                hashes, owner = hashes[on], owner[on]
                bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
                if rows := [(None, *r) for r in _packed(hashes, owner, keys, bucket.astype(np.int64), width)]:
                    yield _screen_rows(rows)

    return run


def _unpacked(rows: list[tuple[bytes, bytes, bytes]], width: str) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.frombuffer(b"".join(r[2] for r in rows), width)
    keys = np.frombuffer(b"".join(r[0] for r in rows), "<i8")
    return hashes, np.repeat(keys, np.frombuffer(b"".join(r[1] for r in rows), "<u4"))


def _dealt_again(coarse: int, fine: int):
    """Packed rows of one of ``coarse`` buckets, several together, dealt to its ``fine`` buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, bytes]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            hashes, keys = _unpacked(held, "<u8")
            known, owner = np.unique(keys, return_inverse=True)
            bucket = (hashes >> np.uint64(32)) // np.uint64(coarse) % np.uint64(fine)
            return pa.RecordBatch.from_pylist(
                [{"bucket": b, "keys": k, "counts": c, "hashes": h} for b, k, c, h in _packed(hashes, owner, known, bucket.astype(np.int64), "<u8")],
                pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())]),
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= 4 * SLICE:
                    yield rows()
                    held, size = [], 0
        if held:
            yield rows()

    return run


def _shared_counts(width: str, replies: int):
    """Of each text the number of hashes of one bucket that another text has too, packed for each of ``replies`` ranges of texts."""

    def counts(rows: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        hashes, keys = _unpacked(rows, width)
        order = np.argsort(hashes)
        hashes, keys = hashes[order], keys[order]
        same = hashes[1:] == hashes[:-1]
        group = np.concatenate([[0], np.cumsum(~same)])
        several = np.zeros(int(group[-1]) + 1, bool)
        several[group[1:][same & (keys[1:] != keys[:-1])]] = True
        found = several[group]
        group, keys = group[found], keys[found]
        order = np.lexsort((keys, group))
        group, keys = group[order], keys[order]
        once = np.concatenate([[True], (group[1:] != group[:-1]) | (keys[1:] != keys[:-1])])[: len(keys)]
        known, n = np.unique(keys[once], return_counts=True)
        return _replied(known, n, replies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current and held:
                    yield counts(held)
                    held = []
                current = bucket
                held.append(tuple(row))
        if held:
            yield counts(held)

    return run


def _replied(keys: np.ndarray, shared: np.ndarray, replies: int) -> pa.RecordBatch:
    """reply, keys, shared: one row for each range of texts."""
    reply = (keys.view(np.uint64) % np.uint64(replies)).astype(np.int64)
    order = np.argsort(reply, kind="stable")
    reply, keys, shared = reply[order], keys[order], shared[order].astype("<u4")
    cuts = [0, *(np.flatnonzero(np.diff(reply)) + 1).tolist(), len(reply)]
    spans = [(i, j) for i, j in zip(cuts, cuts[1:], strict=False) if j > i]
    columns = [pa.array([int(reply[i]) for i, _ in spans], pa.int32()), *(pa.array([x[i:j].tobytes() for i, j in spans], pa.binary()) for x in (keys, shared))]
    return pa.RecordBatch.from_arrays(columns, ["reply", "keys", "shared"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k1, shared: the sum of all replies to each text of a range, or of several ranges one after the other."""

    def sums(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(r[0] for r in rows), "<i8")
        known, place = np.unique(keys, return_inverse=True)
        n = np.bincount(place, np.frombuffer(b"".join(r[1] for r in rows), "<u4"), len(known)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(known), pa.array(n)], ["k1", "shared"])

    current, held, size = None, [], 0
    for batch in batches:
        for reply, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (reply != current or size > 64 << 20):
                # sums of a part: a text may then come twice, and is summed again
                yield sums(held)
                held, size = [], 0
            current = reply
            held.append(tuple(row))
            size += len(row[0])
    if held:
        yield sums(held)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                sets = shingle_sets(part.column(2), words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["k1", "k2", "n", "hashes"],
                )

    return run


def _text_keys(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return plain.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})


def candidate_sets(documents: DataFrame, words: int, percent: int, bucket_bytes: int, max_buckets: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k1, k2, n of every row; cid, k1, k2, n, hashes of each text that may link with another), both written."""
    spark = documents.sparkSession
    base = scratch_dir(spark)
    texts = _text_keys(documents)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total // bucket_bytes
    fine = -(-buckets // max_buckets)
    coarse = -(-buckets // fine)
    # 32 bits beside the bucket tell some billions of hashes apart well enough for a screen
    width = "<u4" if fine == 1 else "<u8"
    screen = written(map_arrow(texts, _screened(words, coarse, width), _SCREEN), f"{base}/screen")
    rows = screen.where("n IS NOT NULL").select("doc_id", "k1", "k2", "n")
    packed = screen.where("bucket IS NOT NULL").select("bucket", "keys", "counts", "hashes").repartitionById(coarse, "bucket")
    if fine > 1:
        dealt = map_arrow(packed, _dealt_again(coarse, fine), "bucket int, keys binary, counts binary, hashes binary")
        place = F.spark_partition_id() * fine + F.col("bucket")
        packed = dealt.withColumn("bucket", place).repartitionById(coarse * fine, "bucket")
    replies = int(min(MAX_REPLIES, 1 + buckets // 8))
    replied = map_arrow(packed, _shared_counts(width, replies), "reply int, keys binary, shared binary")
    replied = replied.repartitionById(replies, "reply")
    counts = map_arrow(replied, _summed, "k1 long, shared long").unionByName(screen.where("shared IS NOT NULL").select("k1", "shared"))
    counts = written(counts.groupBy("k1").agg(F.sum("shared").alias("shared")), f"{base}/shared")
    left = rows.where("n > 0").join(counts, "k1").where(F.col("shared") * 100 >= F.col("n") * percent).select("k1", "k2").distinct()
    left = broadcast_within(written(left, f"{base}/left"))
    again = texts.join(left, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    sets = map_arrow(again, _sets(words), "k1 long, k2 long, n long, hashes array<long>")
    return rows, written(sets.withColumn("cid", F.monotonically_increasing_id()), f"{base}/sets")


def shortest_lists(sets: DataFrame, percent: int) -> DataFrame:
    """hash, cid, n, pos, df: the places of sets in inverted lists, of the shingles that can be the first in common.

    In the order of list length, then hash, a set of n elements and one it links with share at least ``least_overlap``; the
    first they share is therefore among the first n - least_overlap + 1 of both. Shingles of one set alone come first; they
    are counted and not listed.
    """
    listed = sets.select("cid", "n", F.explode("hashes").alias("hash"))
    df = listed.groupBy("hash").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    several = listed.join(df, "hash")
    window = "PARTITION BY cid"
    placed = several.select("*", F.expr(f"n - count(1) OVER ({window}) + row_number() OVER ({window} ORDER BY df, hash) - 1").alias("pos"))
    return placed.where(F.expr(f"pos <= n - (n * {percent} + 99) div 100")).select("hash", "cid", "n", "pos", "df")


def choose_boundary(costs: dict[int, tuple[int, int]], percent: int) -> int:
    """The size up to which sets are light; costs: sets and lengths of lists to scan, by size. 0: none is."""
    best, boundary = 0, 0  # against scanning everything
    change = 0
    for n in sorted(costs):
        sets, scanned = costs[n]
        change += sets * subsets_of(n, percent) - scanned
        if change <= best:
            best, boundary = change, n
    return boundary


def _subsets(percent: int):
    """key1, key2, c, n, cid: each light set at all of its subsets, whose keys are sums over their elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, n, hashes in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2), strict=True):
                own = hashes.values.to_numpy().view(np.uint64)
                both = [mixed(own, 0), mixed(own, 1)]
                for c in range(least_overlap(n, percent), n + 1):
                    # what is left out is short
                    out = np.array(list(combinations(range(n), n - c)), dtype=np.int64).reshape(comb(n, c), n - c)
                    keys = [(x.sum(dtype=np.uint64) - x[out].sum(axis=1, dtype=np.uint64)).view(np.int64) for x in both]
                    m = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, keys), pa.array(np.full(m, c)), pa.array(np.full(m, n)), pa.array(np.full(m, cid))], ["key1", "key2", "c", "n", "cid"]
                    )

    return run


def light_links(sets: DataFrame, boundary: int, percent: int) -> DataFrame:
    """a, b: stars of light sets at the subsets they share."""
    keyed = map_arrow(sets.where(F.col("n") <= boundary).select("cid", "n", "hashes"), _subsets(percent), "key1 long, key2 long, c long, n long, cid long")
    keyed = written(keyed, f"{scratch_dir(sets.sparkSession)}/subsets")
    key = ["key1", "key2", "c"]
    least = keyed.groupBy(key).agg(F.min(F.struct("n", "cid")).alias("least"), F.count(F.lit(1)).alias("members")).where("members > 1")
    most = F.expr(f"c + c * 100 div {percent}")
    both = keyed.join(least, key).where((F.col("n") + F.col("least.n") <= most) & (F.col("cid") != F.col("least.cid")))
    return both.select(F.col("cid").alias("a"), F.col("least.cid").alias("b")).distinct()


def _may_link(n1: Column, pos1: Column, n2: Column, pos2: Column, percent: int) -> Column:
    """Whether sets may link whose first shingle in common stands at these places."""
    overlap = F.least(n1 - pos1, n2 - pos2)
    return overlap * (100 + percent) >= (n1 + n2) * percent


def _across(boundary: int, percent: int):
    """a, b: pairs across components within each group of a partition sorted by (hash, pair of blocks)."""

    def pairs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # rows: block, cid, n, pos, root; in a pair of two blocks only members of different blocks meet
        blocks = rows[:, 0]
        first = np.flatnonzero(blocks == blocks.min())
        second = first if blocks.min() == blocks.max() else np.flatnonzero(blocks != blocks.min())
        a, b = rows[first][:, None, :], rows[second][None, :, :]
        n1, n2 = a[..., 2], b[..., 2]
        overlap = np.minimum(n1 - a[..., 3], n2 - b[..., 3])
        good = (a[..., 4] != b[..., 4]) & (np.maximum(n1, n2) > boundary) & (overlap * (100 + percent) >= (n1 + n2) * percent)
        i, j = np.nonzero(good)
        return rows[first[i], 1], rows[second[j], 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found() -> pa.RecordBatch:
            rows = np.concatenate(held)
            cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            both = [pairs(group[:, 2:]) for group in np.split(rows, cuts)]
            a, b = (np.concatenate(x) for x in zip(*both, strict=True))
            a, b = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        size = 0
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(7)], 1)
            changes = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            held.append(rows)
            size += len(rows)
            if size >= 1 << 16 and len(changes):
                cut = int(changes[-1])
                held[-1], rest = rows[:cut], rows[cut:]
                yield found()
                held, size = [rest], len(rest)
        if size:
            yield found()

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b; written) whose sets link. Pairs of a set in very many go to several keys."""

    def with_set(df: DataFrame, side: str) -> DataFrame:
        other = "b" if side == "a" else "a"
        busy = pairs.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / F.lit(SALTED)).alias("salts"))
        known = busy.join(sets.select(F.col("cid").alias(side), "hashes"), side)
        known = known.select(side, "salts", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("hashes").alias(f"set_{side}"))
        salted = df.join(busy, side).withColumn("salt", F.pmod(F.xxhash64(other), "salts")).drop("salts")
        return salted.join(known.drop("salts"), [side, "salt"]).drop("salt")

    @F.arrow_udf("boolean")
    def links(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            # equal elements of two sorted sets of distinct ones stand next to each other in both together
            both = np.concatenate([x, y])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            out.append(100 * shared >= percent * (len(x) + len(y) - shared))
        return pa.array(out, pa.bool_())

    return with_set(with_set(pairs, "a"), "b").where(links("set_a", "set_b")).select("a", "b")


def heavy_links(lists: DataFrame, sets: DataFrame, light: DataFrame, boundary: int, percent: int, block: int = BLOCK) -> DataFrame:
    """a, b: the links in ``light`` and spanning ones of all pairs with a heavy set. lists: ``shortest_lists``, written."""
    base = scratch_dir(sets.sparkSession)
    size_class = F.floor(F.log("n") / F.lit(0.05)).alias("class")
    classed = lists.select("*", size_class)
    pivots = classed.groupBy("hash", "class").agg(F.min(F.struct("pos", "cid", "n")).alias("pivot"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("members"))
    pivots = pivots.where((F.col("members") > 1) & (F.col("largest") > boundary)).select("hash", "class", "pivot")
    met = classed.join(pivots, ["hash", "class"]).where((F.col("cid") != F.col("pivot.cid")) & (F.greatest("n", "pivot.n") > boundary))
    met = met.where(_may_link(F.col("n"), F.col("pos"), F.col("pivot.n"), F.col("pivot.pos"), percent))
    met = written(met.select(F.col("cid").alias("a"), F.col("pivot.cid").alias("b")).distinct(), f"{base}/pivots")
    near = written(_confirmed(met, sets, percent).unionByName(light), f"{base}/near")

    roots = connected_components(near)
    rooted = lists.join(roots, F.col("cid") == F.col("node"), "left").select("hash", "cid", "n", "pos", F.coalesce("root", "cid").alias("root"))
    rooted = written(rooted, f"{base}/rooted")
    mixed_lists = rooted.groupBy("hash").agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("low"), F.max("root").alias("high"), F.max("n").alias("largest"))
    mixed_lists = mixed_lists.where((F.col("low") != F.col("high")) & (F.col("largest") > boundary))
    blocks = mixed_lists.select("hash", F.ceil(F.col("members") / F.lit(block)).alias("blocks"))
    placed = rooted.join(blocks, "hash").withColumn("block", F.pmod(F.xxhash64("cid"), "blocks"))
    # a member meets its own block and every other one: the pair of blocks is the key
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.least(x, F.col("block")) * F.col("blocks") + F.greatest(x, F.col("block")))
    dealt = placed.select("hash", F.explode(others).alias("pair"), "block", "cid", "n", "pos", "root")
    groups = dealt.repartition("hash", "pair").sortWithinPartitions("hash", "pair")
    across = written(map_arrow(groups, _across(boundary, percent), "a long, b long").distinct(), f"{base}/across")
    return near.unionByName(_confirmed(across, sets, percent))


def jaccard_components(
    documents: DataFrame, words: int = WORDS, percent: int = PERCENT, bucket_bytes: int = BUCKET_BYTES, max_buckets: int = MAX_BUCKETS, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``documents`` (doc_id, text).

    A document's set is its distinct shingles of ``words`` words (A-Z in lower case; with fewer words, the whole sequence as
    one). Documents link if 100 times their intersection is at least ``percent`` (51 to 100) times their union; component_id is
    the smallest doc_id that a document reaches over links, itself included. A document without words, or without text, is
    linked with nothing. A null doc_id is never smallest; a component of only such rows has a null component_id. Repeated
    rows are linked as equal texts are; other columns are ignored; an empty table gives no rows.

    Shingles are 64-bit hashes: two sets of n elements are misjudged with a probability of n * n / 2^64.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be 51 to 100")
    spark = importable(documents.sparkSession)
    base = scratch_dir(spark)
    rows, sets = candidate_sets(documents, words, percent, bucket_bytes, max_buckets)
    lists = written(shortest_lists(sets, percent), f"{base}/lists")
    small = sets.where(F.col("n") <= LIGHT).groupBy("n").agg(F.count(F.lit(1)).alias("sets"))
    scanned = lists.where(F.col("n") <= LIGHT).groupBy("n").agg(F.sum("df").alias("scanned"))
    costs = {r["n"]: (r["sets"], r["scanned"] or 0) for r in small.join(scanned, "n", "left").collect()}  # LIGHT rows at most
    boundary = choose_boundary(costs, percent)
    links = written(heavy_links(lists, sets, light_links(sets, boundary, percent), boundary, percent, block), f"{base}/links")

    roots = connected_components(links)  # of all but the roots themselves
    known = sets.select("k1", "k2", "cid").join(roots, F.col("cid") == F.col("node"), "left").select("k1", "k2", F.coalesce("root", "cid").alias("root"))
    texts = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"))
    texts = written(texts.join(known, ["k1", "k2"], "left"), f"{base}/texts")
    of_root = texts.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("lowest"))
    labelled = texts.join(of_root, "root", "left").select("k1", "k2", F.coalesce("lowest", "first").alias("component_id"))
    found = rows.join(labelled, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, CASE WHEN len(w) < 4 THEN len(w) ELSE i + 3 END), ' ') AS g, len(w) < 4 AS short
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
together AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.short = y.short AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
link AS (
  SELECT a, b FROM together JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id"""

"""The prefix trie of conversations: how many share each beginning, and what sharing it saves.

A conversation is a path of turns. Paths that are equal become one row with its members first, so that thousands of copies
cost nothing further on. Distinct paths are then dealt out in ranges at splitter paths, and each shard is sorted:

* The splitters form a small trie, the skeleton, which every task gets. A node whose members lie in several shards is a
  beginning of the splitter between them, so it is in the skeleton.
* All other nodes lie in one shard. A walk over its sorted paths keeps the nodes from the root to the current path open,
  and finishes a node when the next path leaves it.
* Skeleton nodes get partial aggregates from each shard, which a grouping reduces; what lies below them in the skeleton is
  then added from the leaves up, over the rows of the skeleton alone.

Turns are 16 bytes of hashes in a path, so that texts do not take part in the sort.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.common import id_crc, map_arrow
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import scratch_dir, written

STEP = 16  # bytes of a turn in a path
SHARD_TURNS = 200_000
MAX_SHARDS = 2_048
MAX_DEPTH = 128  # turns of a splitter: with MAX_SHARDS the bound of the skeleton
SAMPLES = 8  # sampled paths for each shard
EMPTY = hashlib.sha256(b"").hexdigest()
_BATCH = 20_000

TURNS = "array<struct<n: int, a: long, b: long, chars: long>>"
PATHS = "conv_id long, path binary, sizes binary"
NODES = (
    "owner int, depth long, parent_owner int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, chars long"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def shared(one: bytes, other: bytes) -> int:
    """Turns with which both paths begin."""
    most = min(len(one), len(other)) // STEP
    if one[: most * STEP] == other[: most * STEP]:
        return most
    low = 0
    while most - low > 1:  # the first ``low`` are equal, the first ``most`` are not
        middle = (low + most) // 2
        if one[low * STEP : middle * STEP] == other[low * STEP : middle * STEP]:
            low = middle
        else:
            most = middle
    return low


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: each conversation's turns in order, as hashes of role and text and the text's length in characters."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    plain = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = plain.where("conv_id IS NOT NULL").select(
        "conv_id",
        F.row_number().over(order).alias("n"),
        F.xxhash64(F.lit(0), "role", "text").alias("a"),
        F.xxhash64(F.lit(1), "text", "role").alias("b"),
        F.char_length("text").cast("long").alias("chars"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "a", "b", "chars"))).alias("turns"))


def rebuilt(own: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """Conversations that begin with turns of the ``every``-th one: ``h`` of these, then their own after the first ``h``.

    h is the checksum of the decimal conv_id modulo ``heads``; own: ``ordered_turns``, written, since it is read twice.
    """
    first = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    both = own.join(first, F.col("conv_id") - F.col("conv_id") % every == F.col("base"), "left")
    h = (id_crc(F.col("conv_id")) % heads).cast("int")
    none = F.array().cast(TURNS)
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns")))
    return both.select("conv_id", turns.alias("turns"))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = batch.column(1)
        bounds = turns.offsets.to_numpy()
        flat = turns.flatten()
        a, b, chars = (flat.field(name).to_numpy() for name in ("a", "b", "chars"))
        path = np.stack([a, b], 1).tobytes()
        sizes = chars.astype("<i8").tobytes()
        bounds = (bounds - bounds[0]).tolist()
        spans = list(zip(bounds, bounds[1:], strict=False))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([path[STEP * i : STEP * j] for i, j in spans], pa.binary()),
                pa.array([sizes[8 * i : 8 * j] for i, j in spans], pa.binary()),
            ],
            ["conv_id", "path", "sizes"],
        )


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each group of rows sorted by (k1, k2, conv_id), one id after the other."""
    current, digest = None, None
    keys, digests = [], []

    def rows() -> pa.RecordBatch:
        columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "ends"])

    for batch in batches:
        for k1, k2, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (k1, k2) != current:
                if digest:
                    keys.append(current)
                    digests.append(digest.hexdigest())
                current, digest = (k1, k2), hashlib.sha256(str(conv_id).encode())
            else:
                digest.update(b",%d" % conv_id)
        if len(keys) >= _BATCH:
            yield rows()
            keys, digests = [], []
    if digest:
        keys.append(current)
        digests.append(digest.hexdigest())
        yield rows()


def distinct_paths(paths: DataFrame) -> DataFrame:
    """path, sizes, n (members), conv_id (the smallest) and ends (digest of all) of each different path.

    paths: conv_id, path, sizes; written, since it is read twice. Only members of repeated paths are sorted by id, as 24
    bytes each; their digest takes one id after the other, however many there are.
    """
    keyed = paths.withColumns({"k1": F.xxhash64("path"), "k2": F.xxhash64(F.lit(1), "path")})
    groups = keyed.groupBy("k1", "k2", "path", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    groups = written(groups, f"{scratch_dir(paths.sparkSession)}/groups")
    again = broadcast_within(groups.where("n > 1").select("k1", "k2"))
    members = keyed.select("k1", "k2", "conv_id").join(again, ["k1", "k2"], "left_semi")
    members = members.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv_id")
    digests = map_arrow(members, _id_digests, "k1 long, k2 long, ends string")
    ends = F.coalesce("ends", F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
    return groups.join(digests, ["k1", "k2"], "left").select("path", "sizes", "n", "conv_id", ends.alias("ends"))


def choose_splitters(sample: list[bytes], shards: int) -> list[bytes]:
    """Ascending paths that cut the sample into about ``shards`` equal parts, each as short as it may be."""
    known = sorted(set(sample))
    out = []
    for i in sorted({len(known) * k // shards for k in range(1, shards)} - {0}):
        before, path = known[i - 1], known[i]
        out.append(path[: STEP * (shared(before, path) + 1)])
    return out


def skeleton(splitters: list[bytes]) -> list[list[int]]:
    """For each splitter and each depth from 0 the number of the first splitter with that beginning: its node's owner."""
    owners: list[list[int]] = []
    for k, path in enumerate(splitters):
        depth = len(path) // STEP
        same = shared(splitters[k - 1], path) if k else -1
        owners.append([owners[k - 1][d] if d <= same else k for d in range(depth + 1)])
    return owners


def _dealt(splitters: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = [bisect_right(splitters.value, path) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns], ["shard", *batch.schema.names])

    return run


class _Walk:
    """Nodes of one shard, from its distinct paths in order. Open nodes lie on a stack, the root at the bottom."""

    def __init__(self, shard: int, splitters: list[bytes]):
        owners = skeleton(splitters)
        # the two splitters that bound the shard hold all of the skeleton that its paths can meet
        self.bounds = [(splitters[k], owners[k]) for k in (shard - 1, shard) if 0 <= k < len(splitters)]
        self.before = b""
        self.open: list[dict] = []
        self.rows: list[list] = []
        self.ready: list[list] = []  # rows whose parents are known, or hang on the skeleton
        self.loose = 0  # open nodes that are not in the skeleton

    def _push(self, depth: int, owner: int | None, chars: int) -> None:
        self.open.append({"depth": depth, "owner": owner, "chars": chars, "n": 0, "conv": None, "children": 0, "leaves": 0, "saved": 0, "ends": None, "rows": []})
        self.loose += owner is None

    def _pop(self) -> None:
        node = self.open.pop()
        above = self.open[-1] if self.open else None
        loose = node["owner"] is None
        if loose:
            self.loose -= 1
            node["saved"] += (node["n"] - 1) * node["chars"]
            node["leaves"] = node["leaves"] or 1
        for row in node["rows"]:
            self.rows[row][4] = node["conv"]
        if above:
            above["n"] += node["n"]
            above["conv"] = node["conv"] if above["conv"] is None else min(above["conv"], node["conv"])
            if loose:
                above["children"] += 1
                above["leaves"] += node["leaves"]
                above["saved"] += node["saved"]
                if above["owner"] is None:
                    above["rows"].append(len(self.rows))
        hangs = above["owner"] if loose and above else None
        ends = node["ends"] or (EMPTY if loose else None)
        self.rows.append([node["owner"], node["depth"], hangs, node["conv"], None, node["n"], node["children"], node["leaves"], node["saved"], ends, node["chars"]])

    def add(self, path: bytes, sizes: bytes, n: int, conv: int, ends: str) -> None:
        depth = len(path) // STEP
        common = shared(self.before, path)
        while len(self.open) - 1 > common:
            self._pop()
        if not self.loose:
            self.ready += self.rows
            self.rows = []
        if len(self.open) <= depth:
            bound, known = max(((shared(b, path), o) for b, o in self.bounds), default=(0, [0]), key=lambda x: x[0])
            chars = np.frombuffer(sizes, "<i8").tolist()
            for d in range(len(self.open), depth + 1):
                self._push(d, known[d] if d <= bound else None, chars[d - 1] if d else 0)
        node = self.open[-1]
        node["n"] += n
        node["conv"] = conv if node["conv"] is None else min(node["conv"], conv)
        node["ends"] = ends
        self.before = path

    def take(self, last: bool = False) -> pa.RecordBatch | None:
        """The rows that are ready, if they are many or all is over."""
        while last and self.open:
            self._pop()
        if last:
            self.ready += self.rows
        if not self.ready or not last and len(self.ready) < _BATCH:
            return None
        rows, self.ready = self.ready, []
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.string(), pa.int64()]
        names = [f.split()[0] for f in NODES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _shard_nodes(splitters: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(TaskContext.get().partitionId(), splitters.value)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                walk.add(*row)
                if found := walk.take():
                    yield found
        if found := walk.take(last=True):
            yield found

    return run


def _skeleton_nodes(splitters: Broadcast):
    """Finished rows of all skeleton nodes, from one reduced row for each: leaves and savings are added up from below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {(r["owner"], r["depth"]): r for batch in batches for r in batch.to_pylist()}
        owners = skeleton(splitters.value)
        for (owner, depth), row in sorted(rows.items(), key=lambda x: -x[0][1]):
            row["saved_tokens"] += (row["n_convs"] - 1) * row["chars"]
            row["n_leaves"] = row["n_leaves"] or 1
            row["ends_sha256"] = row["ends_sha256"] or EMPTY
            row["parent_conv_id"] = None
            if depth:
                above = rows[owners[owner][depth - 1], depth - 1]
                row["parent_conv_id"] = above["conv_id"]
                above["n_children"] += 1
                above["n_leaves"] += row["n_leaves"]
                above["saved_tokens"] += row["saved_tokens"]
        if rows:
            names = ["owner", *RESULT]
            kinds = [pa.int32(), *[pa.int64()] * 7, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows.values()], k) for n, k in zip(names, kinds, strict=True)], names)

    return run


def trie_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS, max_shards: int = MAX_SHARDS) -> DataFrame:
    """All nodes of the trie of ``paths`` (conv_id, path, sizes; written), one row each: see ``prefix_trie``."""
    spark = paths.sparkSession
    base = scratch_dir(spark)
    distinct = written(distinct_paths(paths), f"{base}/distinct")
    n, turns = distinct.agg(F.count(F.lit(1)), F.sum(F.octet_length("path"))).first()
    shards = min(max_shards, 1 + (turns or 0) // STEP // shard_turns)
    sample = []
    if shards > 1:
        some = distinct.sample(min(1.0, SAMPLES * shards / n), 0) if SAMPLES * shards < n else distinct
        sample = [bytes(r[0]) for r in some.select(F.substring("path", 1, STEP * MAX_DEPTH)).limit(2 * SAMPLES * shards).collect()]
    chosen = choose_splitters(sample, shards)
    splitters = spark.sparkContext.broadcast(chosen)
    dealt = map_arrow(distinct, _dealt(splitters), "shard int, path binary, sizes binary, n long, conv_id long, ends string")
    sorted_ = dealt.repartitionById(len(chosen) + 1, "shard").sortWithinPartitions("path")
    nodes = written(map_arrow(sorted_, _shard_nodes(splitters), NODES), f"{base}/nodes")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partial = nodes.where("owner IS NOT NULL").groupBy("owner", "depth")
    # as many rows as the skeleton has nodes: max_shards * MAX_DEPTH at most
    reduced = partial.agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"), F.max("chars").alias("chars")).coalesce(1)
    schema = "owner int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    top = written(map_arrow(reduced, _skeleton_nodes(splitters), schema), f"{base}/skeleton")
    hung = F.broadcast(top.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("hangs")))
    others = nodes.where("owner IS NULL").join(hung, ["parent_owner", "depth"], "left")
    others = others.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "hangs"))
    return others.select(RESULT).unionByName(top.select(RESULT))


def prefix_trie(conversations: DataFrame, rebuild: bool = False, shard_turns: int = SHARD_TURNS, max_shards: int = MAX_SHARDS) -> DataFrame:
    """One row for each different beginning of ``conversations`` (conv_id, turn, role, text), the empty one included.

    conv_id is the smallest of the conversations that begin so, depth its number of turns, parent_conv_id the conv_id of the
    beginning one turn shorter (null at the root), n_convs how many conversations begin so, n_children how many longer
    beginnings by one turn there are, n_leaves how many beginnings without longer ones start with it, saved_tokens the sum,
    over all that start with it, of n_convs - 1 times the characters of the last turn's text, and ends_sha256 the digest of
    the comma-joined ids, ascending, of the conversations that are this beginning. ``rebuild`` applies ``rebuilt`` before.

    Turns are ordered by turn, null first, then by role and text, so that repeated turns have a place. A null role or text
    is empty. Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of their own. Other
    columns are ignored; an empty table gives no rows. A conversation is a row of 24 bytes a turn; its texts are not held.
    """
    base = scratch_dir(conversations.sparkSession)
    turns = written(ordered_turns(conversations), f"{base}/turns")
    if rebuild:
        turns = rebuilt(turns)
    return trie_nodes(written(map_arrow(turns, _paths, PATHS), f"{base}/paths"), shard_turns, max_shards)


# crc32 of a text of ASCII characters: each byte is taken in, then eight bits are shifted out
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
  lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda x, y: xor(xor(x, y) >> 1, 3988292384 * (xor(x, y) & 1))))"""

ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, {_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
joined AS (
  SELECT c.conv_id, 0 AS part, n, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND n <= h
  UNION ALL SELECT c.conv_id, 1, n, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND n > h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, n) AS d, role, text FROM joined),
p AS (
  SELECT conv_id, d, text, list([role, text]) OVER (PARTITION BY conv_id ORDER BY d) AS k FROM r
  UNION ALL SELECT conv_id, 0, '', [] FROM c),
nodes AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n, any_value(length(text)) AS chars FROM p GROUP BY d, k),
m AS (SELECT p.conv_id AS member, p.d, nodes.conv_id, max(p.d) OVER (PARTITION BY p.conv_id) AS turns FROM p JOIN nodes USING (d, k)),
ends AS (SELECT conv_id, d, string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) AS ids FROM m WHERE d = turns GROUP BY conv_id, d),
up AS (SELECT nodes.conv_id, nodes.d, nodes.n, chars, m.conv_id AS parent FROM nodes LEFT JOIN m ON m.member = nodes.conv_id AND m.d = nodes.d - 1),
kids AS (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY ALL),
own AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids USING (conv_id, d)),
below AS (
  SELECT m.conv_id, m.d, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum((n - 1) * chars) AS saved
  FROM own JOIN m ON m.member = own.conv_id AND m.d <= own.d GROUP BY m.conv_id, m.d)
SELECT own.conv_id, CAST(own.d AS BIGINT) AS depth, parent AS parent_conv_id, CAST(n AS BIGINT) AS n_convs,
       CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM own JOIN below USING (conv_id, d) LEFT JOIN ends USING (conv_id, d)"""

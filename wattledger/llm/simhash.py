"""SimHash fingerprints of three-word shingles, linked at up to three differing bits by a binary trie self-join.

The fingerprints are the leaves of a binary trie of 64 levels, held as a sorted array in which a node is a range. Node
pairs are traversed together from the root pair: at each level a pair gives the pairs of its children, a bit that
differs is added to the pair's errors, and pairs beyond the budget are pruned.

To work on many machines, the 64 bits are cut into four blocks. With three errors at most, one block has none, so the
trie is built four times with each block rotated to the front: the traversal can then start at the diagonal pairs of
nodes below the first 16 bits, which are independent of each other. Where such a node holds more than ``split_above``
fingerprints, the next eight bits are traversed by the plan instead: a fingerprint goes to each pair of nodes that its own
forms with one within the budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import each_text, importable, map_arrow, release_memory
from wattledger.llm.components import connected_components
from wattledger.plans.sizing import broadcast_within
from wattledger.plans.storage import scratch_dir, written

SEED = 42
WORDS = 3
ERRORS = 3
SPLIT_ABOVE = 20_000
_BLOCK = 16
_SUB = 8
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_FRONTIER = 1 << 20  # node pairs held at once


def fingerprint(text: bytes) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the hashes of all three-word shingles.

    A-Z are lower-cased; with fewer words the only shingle is all of them; without words the fingerprint is 0.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[start : start + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(text: Column) -> Column:
    """Fingerprint of each text as a signed long; null as empty."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t) for t in each_text(texts)]
        release_memory()
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return of(text.cast("string"))


class Forest:
    """Union-find over positions; a union tells whether it joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def _bits_set(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def trie_links(keys: np.ndarray, pairs: np.ndarray, level: int, errors: int = ERRORS) -> list[tuple[int, int]]:
    """Positions of fingerprints that link, as a spanning forest of all links below the node pairs given.

    keys: sorted distinct fingerprints. pairs: rows (low1, high1, low2, high2, differing bits) of nodes at ``level`` as
    ranges of ``keys``, the same node twice for a diagonal pair. The frontier is worked off in portions, deepest first,
    so that memory is bounded.
    """
    forest, out = Forest(len(keys)), []

    def link(a: np.ndarray, b: np.ndarray) -> None:
        out.extend((i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if forest.union(i, j))

    stack = [(level, pairs.astype(np.int64))]
    while stack:
        level, front = stack.pop()
        if len(front) > _FRONTIER:
            half = len(front) // 2
            stack += [(level, front[:half]), (level, front[half:])]
            continue
        n1, n2 = front[:, 1] - front[:, 0], front[:, 3] - front[:, 2]
        same = front[:, 0] == front[:, 2]
        front = front[~(same & (n1 < 2))]
        n1, n2 = front[:, 1] - front[:, 0], front[:, 3] - front[:, 2]
        leaves = (n1 == 1) & (n2 == 1)  # the rest of two single paths in one step
        if leaves.any():
            a, b = front[leaves, 0], front[leaves, 2]
            close = _bits_set(keys[a] ^ keys[b]) <= errors
            link(a[close], b[close])
            front = front[~leaves]
        if not len(front):
            continue
        # all leaves below link if the levels left cannot exceed the budget: a star from the first leaf holds them together
        whole = front[:, 4] + (64 - level) <= errors
        for low1, high1, low2, high2, _ in front[whole].tolist():
            first = np.full(1, low1)
            link(np.repeat(first, high1 - low1), np.arange(low1, high1))
            link(np.repeat(first, high2 - low2), np.arange(low2, high2))
        front = front[~whole]
        if not len(front):
            continue
        # a node is split where the bit of this level turns to 1
        bit = np.uint64(1) << np.uint64(63 - level)
        mask = ~(bit - np.uint64(1))

        def middle(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            edge = np.searchsorted(keys, (keys[low] | bit) & mask)  # noqa: B023
            return np.clip(edge, low, high)

        low1, high1, low2, high2, err = front.T
        mid1, mid2 = middle(low1, high1), middle(low2, high2)
        same = low1 == low2
        children = [
            np.stack([low1, mid1, low2, mid2, err], 1),
            np.stack([mid1, high1, mid2, high2, err], 1),
            np.stack([low1, mid1, mid2, high2, err + 1], 1),
            np.stack([mid1, high1, low2, mid2, err + 1], 1)[~same],  # the mirror image of the one before on the diagonal
        ]
        children = np.concatenate(children)
        alive = (children[:, 4] <= errors) & (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3])
        stack.append((level + 1, children[alive]))
    return out


def _rotations(fp: Column) -> Column:
    turned = [F.shiftleft(fp, 16 * r).bitwiseOR(F.shiftrightunsigned(fp, 64 - 16 * r)) if r else fp for r in range(4)]
    return F.array(*turned)


def _links_of_groups(errors: int):
    """Spanning links within each group of a partition sorted by (rotation, node, pair)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def links() -> pa.RecordBatch:
            rows = np.concatenate(held)
            same = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
            starts = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(rows)]])
            a, b = [], []
            rotation = rows[starts[:-1], 0]
            for r in np.unique(rotation).tolist():
                own = np.flatnonzero(rotation == r)
                # groups with a pair of nodes one by one, all others together: their keys are sorted as a whole
                plain = own[rows[starts[own], 2] < 0]
                for group in [plain, *([g] for g in own[rows[starts[own], 2] >= 0])]:
                    if not len(group):
                        continue
                    index = np.concatenate([np.arange(starts[g], starts[g + 1]) for g in group])
                    keys = rows[index, 3].view(np.uint64)
                    order = np.argsort(keys)
                    keys = keys[order]
                    prefix = keys >> np.uint64(64 - _BLOCK)
                    level = _BLOCK
                    if rows[starts[group[0]], 2] < 0:
                        low = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
                        high = np.append(low[1:], len(keys))
                        pairs = np.stack([low, high, low, high, np.zeros_like(low)], 1)
                    else:
                        pair = int(rows[starts[group[0]], 2])
                        u, v = pair >> _SUB, pair & ((1 << _SUB) - 1)
                        sub = (keys >> np.uint64(64 - _BLOCK - _SUB)) & np.uint64((1 << _SUB) - 1)
                        low, high = np.searchsorted(sub, [u, v]), np.searchsorted(sub, [u, v], "right")
                        pairs = np.array([[low[0], high[0], low[1], high[1], bin(u ^ v).count("1")]])
                        pairs = pairs[(pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
                        level = _BLOCK + _SUB
                    found = trie_links(keys, pairs, level, errors)
                    back = (keys >> np.uint64(16 * r)) | (keys << np.uint64(64 - 16 * r)) if r else keys
                    a += [back[i] for i, _ in found]
                    b += [back[j] for _, j in found]
            columns = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)
            # up to the last change of group the groups are whole; what follows may go on in the next batch
            changes = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            held.append(rows)
            size += len(rows)
            if size >= 1 << 18 and len(changes):
                cut = int(changes[-1])
                held[-1], rest = rows[:cut], rows[cut:]
                yield links()
                held, size = [rest], len(rest)
        if size:
            yield links()

    return run


def fingerprint_links(prints: DataFrame, errors: int = ERRORS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """a, b: links that span the components of the distinct fingerprints in ``prints`` (fp, long) at ``errors`` bits or fewer."""
    if not 0 <= errors <= 3:
        raise ValueError("four blocks find up to three errors")
    rotated = prints.select(F.posexplode(_rotations(F.col("fp"))).alias("rotation", "key"))
    rotated = rotated.withColumn("node", F.shiftrightunsigned("key", 64 - _BLOCK).cast("int"))
    sizes = rotated.groupBy("rotation", "node").agg(F.count(F.lit(1)).alias("n"))
    # a node alone has no links; at most 4 x 65,536 rows however large the table
    nodes = sizes.where("n > 1").select(F.col("rotation").alias("r"), F.col("node").alias("v"), (F.col("n") > split_above).alias("hot"))
    placed = rotated.join(F.broadcast(nodes), (F.col("rotation") == F.col("r")) & (F.col("node") == F.col("v"))).drop("r", "v")
    sub = F.shiftrightunsigned("key", 64 - _BLOCK - _SUB).bitwiseAND((1 << _SUB) - 1).cast("int")
    masks = [sum(1 << i for i in c) for k in range(errors + 1) for c in combinations(range(_SUB), k)]
    other = lambda m: sub.bitwiseXOR(m)
    pair = lambda m: F.shiftleft(F.least(sub, other(m)), _SUB).bitwiseOR(F.greatest(sub, other(m)))
    pairs = F.transform(F.array(*map(F.lit, masks)), pair)
    dealt = placed.select("rotation", "node", F.explode(F.when(F.col("hot"), pairs).otherwise(F.array(F.lit(-1)))).alias("pair"), "key")
    groups = dealt.repartition("rotation", "node", "pair").sortWithinPartitions("rotation", "node", "pair")
    return map_arrow(groups, _links_of_groups(errors), "a long, b long")


def _components(documents: DataFrame, errors: int = ERRORS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """doc_id, fp, root and component_id of every row; root is the same for all of a component and for no other."""
    spark = importable(documents.sparkSession)
    base = scratch_dir(spark)
    found = documents.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprints(F.col("text")).alias("fp"))
    found = written(found, f"{base}/fingerprints")
    leaves = written(found.groupBy("fp").agg(F.min("doc_id").alias("first")), f"{base}/leaves")
    links = written(fingerprint_links(leaves.select("fp"), errors, split_above), f"{base}/links")
    roots = connected_components(links)
    # each leaf with the smallest document of its component
    rooted = leaves.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, f"{base}/rooted")
    of_root = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = rooted.select("fp", "root").join(of_root, "root")
    labelled = found.join(linked.select(F.col("fp").alias("leaf"), "root", "component_id"), F.col("fp") == F.col("leaf"))
    return labelled.select("doc_id", "fp", "root", "component_id")


def near_duplicates(documents: DataFrame, errors: int = ERRORS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of ``documents`` (doc_id, text).

    Documents link if their fingerprints differ in ``errors`` bits or fewer; component_id is the smallest doc_id that a
    document reaches over links, itself included. A null text is empty; all texts without words have fingerprint 0 and
    are linked like any other. A null doc_id is never smallest; a component of only such rows has a null component_id.
    Repeated rows are linked as equal texts are; other columns are ignored; an empty table gives no rows.

    Equal fingerprints become one leaf before any join, so copies cost a row each and no pair.
    """
    labelled = _components(documents, errors, split_above)
    return labelled.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_duplicates(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component: of the rows with its smallest doc_id, the one of the smallest
    fingerprint, text and other columns.

    All columns stay as they are. Rows without doc_id stay. Rows are decided one by one: of rows that share a doc_id, each
    is judged by its own text, and the rows that repeat one that stays go.

    An id that one row has is decided by the id alone; only rows of repeated ids are looked up by fingerprint too.
    """
    base = scratch_dir(documents.sparkSession)
    labelled = written(_components(documents).where("doc_id IS NOT NULL"), f"{base}/labelled")
    decided = labelled.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("repeated"), (F.max("component_id") != F.col("doc_id")).alias("gone"))
    # a repeated id goes here, and what stays of its rows is added below
    decided = written(decided.where("repeated OR gone").select(F.col("doc_id").alias("gone_id"), "repeated"), f"{base}/gone")
    gone = broadcast_within(decided.select("gone_id"))
    plain = documents.join(gone, documents["doc_id"] == gone["gone_id"], "left_anti")
    repeated = decided.where("repeated").select(F.col("gone_id").alias("again_id"))
    if repeated.isEmpty():
        return plain
    first = labelled.where("doc_id = component_id").join(repeated, F.col("doc_id") == F.col("again_id"), "left_semi")
    first = written(first.select(F.col("doc_id").alias("first_id"), F.col("fp").alias("leaf"), "root").distinct(), f"{base}/first")
    row = F.struct(*(documents[c] for c in documents.columns))
    again = broadcast_within(repeated)
    of_ids = documents.join(again, documents["doc_id"] == again["again_id"], "left_semi")
    rows = of_ids.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), fingerprints(F.col("text")).alias("fp"))
    rows = rows.join(broadcast_within(first), (F.col("doc_id") == F.col("first_id")) & (F.col("fp") == F.col("leaf")))
    order = F.struct("fp", F.col("row.text"), F.to_json("row"))
    kept = rows.groupBy("root").agg(F.min_by("row", order).alias("row")).select("row.*")
    return plain.unionByName(kept)

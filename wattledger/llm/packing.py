"""Packing of tokenized documents into sequences of fixed capacity, by bin completion over a histogram of lengths.

Pieces of equal length are interchangeable, so the problem is solved on the number of pieces of each length: at most
``capacity`` numbers, whatever the size of the corpus. The solution is a list of fillings (lengths that share a
sequence) with the number of sequences filled that way; pieces then find their place by their rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.common import map_arrow, slices
from wattledger.llm.tokens import default_path, encoder
from wattledger.plans.storage import scratch_dir, written

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
SLICE = 4 << 20  # bytes of text encoded together
SMALL = 64  # lengths of an instance for which the bound is worked out anew at each node
TOLERANCES = (0, 0.002, 0.008, 0.03, 0.06, 0.12)  # shares of the capacity that descents leave free

Filling = tuple[int, ...]  # lengths, descending


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by the pieces over half the capacity with those that cannot join them."""
    best = -(-sum(length * n for length, n in counts.items()) // capacity)
    for k in {0, *(x for x in counts if 2 * x <= capacity)}:
        alone = sum(n for x, n in counts.items() if x > capacity - k)
        big = [(x, n) for x, n in counts.items() if capacity // 2 < x <= capacity - k]
        pairs = sum(n for _, n in big)
        free = sum(n * (capacity - x) for x, n in big)
        small = sum(x * n for x, n in counts.items() if k <= x <= capacity // 2)
        best = max(best, alone + pairs + max(0, -(-(small - free) // capacity)))
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Every piece, longest first, into the sequence with the least room that takes it; equal sequences in one step."""
    rooms: dict[int, Counter[Filling]] = defaultdict(Counter)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in rooms if r >= length):
            fits = room // length
            for filling, n in list(rooms[room].items()):
                full = min(n, left // fits)
                for times, k in ((full, fits), (1 if full < n and left - full * fits else 0, left - full * fits)):
                    if times:
                        rooms[room][filling] -= times
                        rooms[room - k * length][filling + (length,) * k] += times
                        left -= times * k
                if not left:
                    break
            rooms[room] += Counter()  # drops what reached zero
            if not left:
                break
        fits = capacity // length
        if left // fits:
            rooms[capacity - fits * length][(length,) * fits] += left // fits
        if left % fits:
            rooms[capacity - (left % fits) * length][(length,) * (left % fits)] += 1
    return [(filling, n) for group in rooms.values() for filling, n in group.items() if n]


def _dominates(one: Filling, other: Filling) -> bool:
    """Whether the pieces of ``other`` fit into the places of ``one``: then nothing is lost by preferring ``one``."""
    rooms = list(one)
    for length in other:
        fitting = [r for r in rooms if r >= length]
        if not fitting:
            return False
        rooms.remove(min(fitting))
        rooms.append(min(fitting) - length)
    return True


def completions(counts: dict[int, int], largest: int, capacity: int, most: int = 3, tolerance: int = 0) -> list[Filling]:
    """Undominated fillings that hold one piece of length ``largest``, ``most`` at most, the most promising first.

    Each starts from another second piece and goes on with the longest piece that fits while more than ``tolerance`` is
    free. Promising are those with the least waste beyond the tolerance, and of these the ones of few pieces: short
    pieces are what later fillings need. The enumeration ends once it has enough that none to come could precede.
    """
    sizes = sorted(counts)
    found: list[tuple[tuple[int, int, int], Filling]] = []
    good = 0
    for second in reversed(sizes[: bisect_right(sizes, capacity - largest)]):
        used = Counter([largest])
        if counts[second] <= used[second]:
            continue
        filling, room = [largest, second], capacity - largest - second
        used[second] += 1
        at = bisect_right(sizes, min(room, second)) - 1
        while room > tolerance and at >= 0:
            size = sizes[at]
            if size <= room and counts[size] > used[size]:
                used[size] += 1
                filling.append(size)
                room -= size
                at = bisect_right(sizes, min(room, size)) - 1
            else:
                at -= 1
        found.append(((max(0, room - tolerance), len(filling), room), tuple(filling)))
        good += room <= tolerance
        if good >= most and (len(filling) == 2 or 2 * second < capacity - largest):
            break
    if not found:
        return [(largest,)]
    kept: list[Filling] = []
    for _, filling in sorted(found, key=lambda f: (f[0], [-x for x in f[1]])):
        if len(kept) == most:
            break
        if not any(_dominates(k, filling) for k in kept):
            kept.append(filling)
    return kept


def fillings(counts: dict[int, int], largest: int, capacity: int) -> Iterator[Filling]:
    """All undominated fillings that hold one piece of length ``largest``, those with the least waste first.

    They are found one by one as they are asked for. Only such are looked for to which no piece left could be added, along
    sums that the shorter pieces can make; of equal waste, those with the longest pieces come first. A filling that an
    earlier one dominates is left out.
    """
    room = capacity - largest
    have = {x: n - (x == largest) for x, n in counts.items() if x <= room}
    sizes = sorted((x for x, n in have.items() if n), reverse=True)
    # sums[i]: which sums of pieces sizes[i:] there are, as bits
    sums = [1]
    for size in reversed(sizes):
        made, times, left = sums[-1], 1, min(have[size], room // size)
        while left:
            step = min(times, left)
            made |= made << step * size
            left -= step
            times *= 2
        sums.append(made & (1 << room + 1) - 1)
    sums.reverse()

    def exactly(i: int, rest: int) -> Iterator[Filling]:
        if not rest:
            yield ()
            return
        if i == len(sizes) or not sums[i] >> rest & 1:
            return
        for k in range(min(have[sizes[i]], rest // sizes[i]), -1, -1):
            for tail in exactly(i + 1, rest - k * sizes[i]):
                yield (sizes[i],) * k + tail

    given: list[Filling] = []
    for waste in range(room + 1):
        for tail in exactly(0, room - waste):
            used = Counter(tail)
            if any(have[x] > used[x] for x in sizes if x <= waste):
                continue
            filling = (largest, *tail)
            if not any(_dominates(g, filling) for g in given):
                given.append(filling)
                yield filling


def dive(counts: dict[int, int], capacity: int, tolerance: int) -> list[tuple[Filling, int]]:
    """One descent of the search: the most promising filling each time, as often as the counts allow."""
    left, out = dict(counts), []
    while left:
        filling = completions(left, max(left), capacity, 1, tolerance)[0]
        need = Counter(filling)
        times = min(left[length] // k for length, k in need.items())
        out.append((filling, times))
        for length, k in need.items():
            left[length] -= times * k
            if not left[length]:
                del left[length]
    return out


def solve(counts: dict[int, int], capacity: int = CAPACITY, max_nodes: int = 5_000) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences use each, together exactly ``counts``.

    Best-fit decreasing gives the first incumbent, descents with several tolerances may give better ones. The search then
    completes a sequence around the longest piece left with each undominated filling, as often as the counts allow or once,
    and turns back where the waste so far, or the bound of what is left, rules out a better packing than the incumbent. It
    ends at the lower bound or when all is searched, and has then found the fewest sequences; or after ``max_nodes``
    fillings, which large instances reach: the result then is the best so far, never worse than best fit, and at most its
    difference from ``lower_bound`` from the fewest.
    """
    counts = {int(length): int(n) for length, n in counts.items() if n}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("lengths must be 1 to capacity")
    incumbent = best_fit_decreasing(counts, capacity)
    bins, least = sum(n for _, n in incumbent), lower_bound(counts, capacity)
    for allowed in TOLERANCES:
        if bins > least:
            found = dive(counts, capacity, int(allowed * capacity))
            if sum(n for _, n in found) < bins:
                incumbent, bins = found, sum(n for _, n in found)
    total = sum(length * n for length, n in counts.items())
    left = dict(counts)
    path: list[tuple[Filling, int]] = []
    waste = used = nodes = 0

    def choices() -> Iterator[tuple[Filling, int]]:
        for filling in fillings(left, max(left), capacity):
            most = min(left[length] // k for length, k in Counter(filling).items())
            yield filling, most
            if most > 1:
                yield filling, 1

    stack = [choices()]
    while stack and bins > least and nodes < max_nodes:
        choice = next(stack[-1], None)
        if choice is None:
            stack.pop()
            if path:
                undone, times = path.pop()
                waste -= times * (capacity - sum(undone))
                used -= times
                for length in undone:
                    left[length] = left.get(length, 0) + times
            continue
        nodes += 1
        filling, times = choice
        added = times * (capacity - sum(filling))
        if waste + added > (bins - 1) * capacity - total:
            continue
        rest = Counter(left)
        for length, k in Counter(filling).items():
            rest[length] -= times * k
        rest = {length: n for length, n in rest.items() if n}
        if rest and len(rest) <= SMALL and used + times + lower_bound(rest, capacity) >= bins:
            continue
        waste += added
        used += times
        path.append((filling, times))
        left.clear()
        left.update(rest)
        if left:
            stack.append(choices())
        else:
            stack.append(iter(()))
            bins, incumbent = used, list(path)
    return incumbent


def _pieces(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            for part in slices(batch, SLICE):
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(path).encode_column(part.column(1)), strict=True):
                    data = np.concatenate([ids, end])
                    n = len(data)
                    first = n % capacity or capacity
                    starts = [0, *range(first, n, capacity)]
                    for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                        length = stop - start
                        rows.append((task, doc_id, piece, start, length, zlib.crc32(data[start:stop]), seen[length]))
                        seen[length] += 1
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                names = ["task", "doc_id", "piece", "start", "length", "ids_crc32", "place"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _places(solution: list[tuple[Filling, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence, pieces per sequence and first offset of each filling that holds it."""
    entries: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    ranks: Counter[int] = Counter()
    sequence = 0
    for filling, times in solution:
        offset = 0
        for length, k in Counter(filling).items():
            entries[length].append((ranks[length], sequence, k, offset))
            ranks[length] += k * times
            offset += k * length
        sequence += times
    return {length: tuple(np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)) for length, rows in entries.items()}


def _assign(places: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("length", "rank"))
            sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                first, sequence, k, offset = places[length]
                at = np.searchsorted(first, ranks[own], "right") - 1
                inside = ranks[own] - first[at]
                sequences[own] = sequence[at] + inside // k[at]
                offsets[own] = offset[at] + inside % k[at] * length
            columns = [batch.column(batch.schema.get_field_index(x)) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequences), pa.array(offsets)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack_documents(
    documents: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, max_nodes: int = 5_000
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of each row of ``documents``.

    A document is its ids and ``end_id``. Longer ones than ``capacity`` are cut into full pieces after a first piece with
    the rest. Pieces of one sequence follow each other from offset 0 without gaps. A null text is empty (one piece with
    the end id); a null doc_id stays null; repeated rows are packed one by one; other columns are ignored; an empty table
    gives no rows.

    The pieces, without their ids, are written below ``spark.checkpoint.dir`` together with their place among the pieces
    of equal length of their task; only counts per task and length are shuffled to make ranks of those, so that a length
    that a third of all pieces have does not meet in one task.
    """
    spark = documents.sparkSession
    path = tokenizer_path or default_path(TOKENIZER)
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "task int, doc_id long, piece int, start long, length long, ids_crc32 long, place long"
    pieces = written(map_arrow(narrow, _pieces(path, capacity, end_id), schema), f"{scratch_dir(spark)}/pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    solution = solve(counts, capacity, max_nodes)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    ranked = pieces.join(per_task.select("task", "length", before.alias("before")), ["task", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))
    return map_arrow(
        ranked,
        _assign(_places(solution)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )

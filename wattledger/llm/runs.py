"""Periodic runs of words, by a suffix automaton whose link tree is a link-cut tree.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends keeping period q. Runs
with at least ``repeats`` times their period and ``shortest`` words are found word by word:

1. The words so far are held in a suffix automaton. Its suffix links form a tree; the path from the state of all words to
   the root stands for all suffixes, longest first.
2. The tree is kept in preferred paths (Sleator and Tarjan), each with one colour: where its strings occurred last. A
   new word recolours its path to the root, which walks over the segments of older colours. A segment of colour j whose
   longest string on the path has l words says that the last l words occurred before, d = i - j words earlier.
3. With l >= d these are squares: the last l + d words have period d, and no smaller one, for otherwise the string would
   have occurred later than j. They start where the run starts, so the longest of equal start and period is the run.

Only stretches that can hold a run go through the automaton. ``windows`` finds them exactly: within a run, every group of
``k`` words after the first period has occurred at most q words earlier, so runs lie in stretches of positions whose groups
occurred a short distance earlier, short against the stretch. In ordinary prose there are none.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import id_crc, importable, map_arrow, slices

REPEATS = 4
SHORTEST = 6
SLICE = 1 << 20  # bytes of text taken together; a longer text is taken alone
_NEVER = np.int64(1) << 62
_BASE = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period


class LastOccurrences:
    """Suffix automaton of a growing sequence, with the last occurrence of every string in it.

    ``append`` gives, for each segment of the path of suffixes, how many of the last words occurred before and where that
    occurrence ended. Numbers are held in arrays of 32 bits, 64 bytes for each word and branches besides.
    """

    def __init__(self):
        # state 0 stands for none, state 1 is the root
        self.length, self.link = array("i", [0, 0]), array("i", [0, 0])
        self.word, self.to = array("i", [-1, -1]), array("i", [0, 0])  # the first transition of a state
        self.branches: dict[int, dict[int, int]] = {}  # the others
        # a preferred path is a splay tree by depth; its root holds the colour, its parent is where the path hangs
        self.left, self.right, self.parent, self.colour = (array("i", [0, 0]) for _ in range(4))
        self.last = 1

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.word.append(-1)
        self.to.append(0)
        self.left.append(0)
        self.right.append(0)
        self.parent.append(link)
        self.colour.append(0)
        return len(self.length) - 1

    def _next(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        found = self.branches.get(state)
        return found.get(word, 0) if found else 0

    def _lead(self, state: int, word: int, to: int) -> None:
        if self.word[state] in (word, -1):
            self.word[state], self.to[state] = word, to
        else:
            self.branches.setdefault(state, {})[word] = to

    def _splay(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        while True:
            p = parent[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = parent[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        left, right, parent = self.left, self.right, self.parent
        p = parent[x]
        g = parent[p]
        if left[p] == x:
            inner = right[x]
            left[p], right[x] = inner, p
        else:
            inner = left[x]
            right[p], left[x] = inner, p
        if inner:
            parent[inner] = p
        parent[p], parent[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        if not g or (left[g] != x and right[g] != x):
            self.colour[x] = self.colour[p]

    def _clone(self, state: int, length: int) -> int:
        """A state for the shorter strings of ``state``, between it and its link, with the same last occurrence."""
        above = self.link[state]
        clone = self._state(length, above)
        self.word[clone], self.to[clone] = self.word[state], self.to[state]
        if state in self.branches:
            self.branches[clone] = dict(self.branches[state])
        self._splay(state)
        upper = self.left[state]
        if upper:  # the path ends above: what is left of it keeps its colour and hangs where it hung
            self.left[state] = 0
            self.parent[upper] = self.parent[state]
            self.colour[upper] = self.colour[state]
        self.colour[clone] = self.colour[state]
        self.parent[state] = clone
        self.link[state] = clone
        return clone

    def append(self, word: int) -> list[tuple[int, int]]:
        """(length, end) of earlier occurrences of the last words, longest first; ends count words."""
        p, end = self.last, self.length[self.last] + 1
        new = self._state(end, 0)
        while p and not (q := self._next(p, word)):
            self._lead(p, word, new)
            p = self.link[p]
        if not p:
            link = 1
        elif self.length[q] == self.length[p] + 1:
            link = q
        else:
            link = self._clone(q, self.length[p] + 1)
            while p and self._next(p, word) == q:
                self._lead(p, word, link)
                p = self.link[p]
        self.link[new] = self.parent[new] = link
        self.last = new
        return self._recolour(new, end)

    def _recolour(self, state: int, end: int) -> list[tuple[int, int]]:
        right, parent, colour, length = self.right, self.parent, self.colour, self.length
        found, below, before = [], 0, 0
        x = state
        while x:
            self._splay(x)
            if deeper := right[x]:
                colour[deeper] = colour[x]
            if (seen := colour[x]) != before and length[x]:
                found.append((length[x], seen))
                before = seen
            right[x] = below
            below, x = x, parent[x]
        colour[below] = end
        return found


def runs_within(words: list[int], repeats: int = REPEATS, shortest: int = SHORTEST) -> list[Run]:
    """All runs of a sequence of word numbers, by the automaton."""
    seen, ends = LastOccurrences(), {}
    for end, word in enumerate(words, 1):
        for length, before in seen.append(word):
            period = end - before
            if length >= (repeats - 1) * period and length + period >= shortest:
                ends[end - length - period, period] = end  # later ends replace earlier ones
    return [(start, end - start, period) for (start, period), end in ends.items()]


def gram_size(repeats: int, shortest: int) -> int:
    """Words that every run holds after its first period, whatever the period."""
    return min(max(shortest, repeats * q) - q for q in range(1, shortest + 1))


def windows(words: np.ndarray, offsets: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(document, start, stop) of stretches that hold all runs of the documents ``words[offsets[i]:offsets[i + 1]]``.

    A group is ``k`` words; a position is marked where the group that ends there occurred before in its document. A run of
    period q marks all of its positions from q + k - 1 on, at least (repeats - 1) * q - k + 1 of them, all with an earlier
    occurrence at most q before. So a position whose distance is too long for the stretch of marks around it is in no run;
    taking such marks away may shorten stretches, until nothing changes.
    """
    k = gram_size(repeats, shortest)
    sizes = np.diff(offsets)
    if not len(words):
        return []
    document = np.repeat(np.arange(len(sizes)), sizes)
    grams = document.astype(np.uint64) + np.uint64(1)
    for back in range(k):
        grams[k - 1 :] = grams[k - 1 :] * _BASE + words[k - 1 - back : len(words) - back].astype(np.uint64) + np.uint64(1)
        grams ^= grams >> np.uint64(29)
    whole = np.flatnonzero(np.arange(len(words)) - offsets[document] >= k - 1)
    order = whole[np.argsort(grams[whole], kind="stable")]
    again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]]) + 1
    places, distances = order[again], order[again] - order[again - 1]
    order = np.argsort(places)
    places, distances = places[order], distances[order]
    while len(places):
        cuts = np.flatnonzero(np.diff(places) != 1) + 1
        lengths = np.diff(np.concatenate([[0], cuts, [len(places)]]))
        longest = (lengths + k - 1) // (repeats - 1)
        near = distances <= np.repeat(longest, lengths)
        if near.all():
            break
        places, distances = places[near], distances[near]
    if not len(places):
        return []
    first = places[np.concatenate([[0], cuts])]
    own = document[first]
    starts = np.maximum(offsets[own], first - (k - 1) - longest)
    found: list[tuple[int, int, int]] = []
    for doc, start, stop in zip(own.tolist(), starts.tolist(), (first + lengths).tolist(), strict=True):
        if found and found[-1][0] == doc and start < found[-1][2]:
            found[-1] = (doc, min(start, found[-1][1]), stop)
        else:
            found.append((doc, start, stop))
    return found


def runs_of(words: np.ndarray, offsets: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> dict[int, list[Run]]:
    """Runs of each document that has some, by start, then period; starts count from the document's first word."""
    found: dict[int, set[Run]] = {}
    for doc, low, high in windows(words, offsets, repeats, shortest):
        begin, end = int(offsets[doc]), int(offsets[doc + 1])
        for start, length, period in runs_within(words[low:high].tolist(), repeats, shortest):
            start, stop = low + start, low + start + length
            while start > begin and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while stop < end and words[stop] == words[stop - period]:
                stop += 1
            found.setdefault(doc, set()).add((start - begin, stop - start, period))
    return {doc: sorted(runs, key=lambda r: (r[0], r[2])) for doc, runs in found.items()}


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of the words of all texts one after the other, where each text begins, and the words by number."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat = split.flatten()
    present = pc.greater(pc.binary_length(flat), 0)
    kept = present.to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = flat.filter(present).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), before[bounds - bounds[0]], coded.dictionary


def _found(repeats: int, shortest: int):
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                words, offsets, known = numbered_words(part.column(1))
                runs = runs_of(words, offsets, repeats, shortest)
                collapsed = []
                for doc in range(part.num_rows):
                    low, high = int(offsets[doc]), int(offsets[doc + 1])
                    own = words[low:high]
                    if doc in runs:
                        inside = np.zeros(high - low + 1, np.int64)
                        for start, length, period in runs[doc]:
                            inside[start + period] += 1
                            inside[start + length] -= 1
                        own = own[np.cumsum(inside[:-1]) == 0]
                    collapsed.append(" ".join(known.take(pa.array(own)).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(offsets)),
                        pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.get(d, [])] for d in range(part.num_rows)], pa.list_(run_type)),
                        pa.array(collapsed, pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return found


def periodic_runs(documents: DataFrame, repeats: int = REPEATS, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then period) and collapsed of every row.

    Words are runs of other than ASCII white space; starts are word numbers from 0. A run is at least ``repeats`` (2 or
    more) times its period and ``shortest`` words long. ``collapsed`` is the words joined by one space, without those that a
    run holds after its first period. A text that is null, empty or only white space has no words, no runs and an empty
    collapsed text. Repeated rows give a row each; a null doc_id stays null; other columns are ignored; an empty table gives
    no rows.

    Every row is worked off by itself, without a shuffle: texts in slices of a megabyte, a longer one alone. Besides the
    text, a task holds some 30 bytes a word, and 64 bytes for each word of the longest stretch that may hold a run.
    """
    if repeats < 2 or shortest < repeats:
        raise ValueError("a run has its period at least twice, and at least as many words")
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_arrow(narrow, _found(repeats, shortest), schema)


def made_periodic(text: Column, doc_id: Column) -> Column:
    """Whole texts, of which those whose crc32 of the decimal doc_id is a multiple of ten end in repetitions.

    With h the checksum, g = h // 10 and n words: from word a = g % n on, the words repeat those from a to a + p - 1, with
    p = 1 + (n - a) // (3 + g % 8). Other texts, texts without words and those of null ids stay as they are.
    """

    @F.arrow_udf("string")
    def repeated(texts: pa.Array, checks: pa.Array) -> pa.Array:
        out = []
        for text, check in zip(texts, checks.to_pylist(), strict=True):
            words = (text.as_py() or "").encode().split() if check is not None and check % 10 == 0 else []
            if words:
                n, g = len(words), check // 10
                a = g % n
                period = words[a : a + 1 + (n - a) // (3 + g % 8)]
                words[a:] = (period * -(-(n - a) // len(period)))[: n - a]
            out.append(b" ".join(words).decode() if words else None)
        return pa.array(out, pa.string())

    return F.coalesce(repeated(text.cast("string"), id_crc(doc_id)), text.cast("string"))


def run_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period), and digests of all runs and of the collapsed text
    of the documents that ``made_periodic`` gives."""
    importable(documents.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    found = periodic_runs(documents.select(doc_id.alias("doc_id"), made_periodic(F.col("text"), doc_id).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return (
        found.withColumn("longest", longest)
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            (-F.col("longest.before")).alias("start"),
            F.col("longest.length").alias("length"),
            (-F.col("longest.less")).alias("period"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
        .withColumn("exponent_milli", F.expr("length * 1000 div period"))
        .select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    )

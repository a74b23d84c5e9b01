"""SentencePiece encoding and decoding by a max-plus scan over the lattice of pieces.

A path through the lattice is a sequence of pieces that spell the text. Its weight is, for a unigram model, the sum of
the pieces' scores. For a BPE model it is 0 if all neighbouring pieces are compatible, that is if merging their joint
text by the model's rules gives just these two, and minus infinity otherwise: a sequence of pieces is what merging the
whole text gives if and only if all its neighbours are compatible, so exactly one path is left. Either way the
best path is the library's encoding. (Of several unigram paths of equal weight, such as "aa" + "a" and "a" + "aa", the
library's is taken within a chunk, and any of them across the chunks of a giant document. A BPE model has no ties.)

A giant document is cut into chunks of equal length, anywhere. A chunk owns the pieces that begin in it, and its boundary states
are the pieces that reach over (or end at) its first position. Each chunk by itself yields the matrix of the
best weights from every state at its beginning to every state at its end. Max-plus products of these, which are
associative, give the state at every boundary on the best path; then each chunk is backtraced by itself between its two.

No piece reaches over the beginning of a word, nor over a character that no longer piece contains. Between such places,
paths do not depend on each other, and those of words that come again are looked up.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import importable, map_arrow
from wattledger.llm.tokens import default_path
from wattledger.plans.storage import scratch_dir, written

MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 15  # characters
_SPACE = "▁"
_UNKNOWN_PENALTY = 10.0  # fixed value of unigram models
_NONE = float("-inf")

State = tuple[int, str]  # position where the piece ends, and the piece ("" where it does not matter)
Matrix = dict[State, dict[State, float]]


class Model:
    """Pieces, scores and rules of one model file."""

    def __init__(self, path: str, limit: int = 300_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            data = file.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.bpe = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        if not self.bpe and proto.trainer_spec.model_type != proto.trainer_spec.UNIGRAM:
            raise ValueError("only BPE and unigram models have a lattice of pieces")
        self.pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.score = {p: proto.pieces[i].score for p, i in self.pieces.items()}
        self.unknown = self.library.unk_id()
        bytes_ = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.byte_ids = [bytes_[f"<0x{b:02X}>"] for b in range(256)] if bytes_ else None
        self.unknown_score = min(self.score.values(), default=0.0) - _UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces), default=1)
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        crossing = any(_SPACE in p.lstrip(_SPACE) for p in self.pieces)
        inner = sorted({c for p in self.pieces if len(p) > 1 for c in p} - {_SPACE})
        letters = "".join(map(re.escape, inner))
        self.words = re.compile(f"{_SPACE}*[{letters}]+|{_SPACE}+|[^{letters}{_SPACE}]" if letters and not crossing else "(?s).+")
        self.limit = limit
        self.memo: dict[str, bytes] = {}
        # every beginning of a piece; true where it is a piece
        self.beginnings = {p[:k]: False for p in self.pieces for k in range(1, len(p))} | dict.fromkeys(self.pieces, True)
        self.followers: dict[str, dict[str, bool]] = {}  # piece -> whether others are compatible behind it
        self.followed = 0
        # text of each id for decoding: bytes, so that byte pieces next to each other make characters
        self.texts = [
            b"" if p.type in (kinds.CONTROL,) else bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else p.piece.replace(_SPACE, " ").encode()
            for p in proto.pieces
        ]
        if 0 <= self.unknown < len(self.texts):
            self.texts[self.unknown] = proto.trainer_spec.unk_surface.encode()

    def normalize(self, text: str) -> str:
        return self.library.normalize(text)

    def merged(self, text: str) -> list[str]:
        """Neighbours merged while a piece has their joint text: the one with the best score first, the leftmost of equals."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = _NONE, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1], _NONE)
                if s > best:
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, before: str, piece: str) -> bool:
        """Whether merging both gives just these two ("" stands for a place that no piece reaches over)."""
        found = self.merged(before + piece) == ([before, piece] if before else [piece])
        if self.followed > 1_000_000:
            self.followers.clear()
            self.followed = 0
        self.followers.setdefault(before, {})[piece] = found
        self.followed += 1
        return found

    def paths(self, text: str, start: int, before: str, stop: int) -> dict[int, tuple[float, str, int]]:
        """Best (weight, last piece, its beginning) of each position that paths from ``start`` reach.

        Pieces begin before ``stop``, and may end behind it. ``before`` is the piece that ends at ``start``. Single
        characters always count as pieces.
        """
        best: dict[int, tuple[float, str, int]] = {start: (0.0, before, -1)}
        n, beginnings, bpe = len(text), self.beginnings, self.bpe
        for begin in range(start, min(n, stop)):
            reached = best.get(begin)
            if reached is None:
                continue
            weight, last, _ = reached
            row = self.followers.get(last, {}) if bpe else None
            end = begin + 1
            piece = text[begin:end]
            kind = beginnings.get(piece)
            allowed = True
            while True:
                if allowed:
                    if not bpe:
                        total = weight + self.score.get(piece, self.unknown_score)
                        if end not in best or total > best[end][0]:
                            best[end] = (total, piece, begin)
                    elif end not in best:  # there is one path to each position
                        fits = row.get(piece)
                        if self._compatible(last, piece) if fits is None else fits:
                            best[end] = (0.0, piece, begin)
                if kind is None or end >= n:
                    break
                end += 1
                piece = text[begin:end]
                kind = beginnings.get(piece)
                if kind is None:
                    break
                allowed = kind
        return best

    def _ends(self, text: str, begin: int) -> list[int]:
        """Ends of all pieces that begin there, ascending."""
        end, n, beginnings = begin + 1, len(text), self.beginnings
        out = [end]
        kind = beginnings.get(text[begin:end])
        while kind is not None and end < n:
            end += 1
            kind = beginnings.get(text[begin:end])
            if kind:
                out.append(end)
        return out

    def only_path(self, word: str) -> list[str]:
        """The path of a whole word in the lattice of a BPE model, which ``paths`` would find as well.

        Where all weights are 0 or minus infinity and each position has one path at most, the first path to the end is the
        best. It is sought longest piece first; a position from which the end cannot be reached is not tried again.
        """
        n, dead = len(word), set()
        stack = [(0, "", self._ends(word, 0))]
        out: list[str] = []
        while True:
            begin, last, ends = stack[-1]
            row = self.followers.get(last, {})
            while ends:
                end = ends.pop()
                if end in dead:
                    continue
                piece = word[begin:end]
                fits = row.get(piece)
                if self._compatible(last, piece) if fits is None else fits:
                    out.append(piece)
                    if end == n:
                        return out
                    stack.append((end, piece, self._ends(word, end)))
                    break
            else:
                dead.add(begin)
                stack.pop()
                out.pop()

    def backtrace(self, best: dict[int, tuple[float, str, int]], end: int, start: int) -> list[str]:
        out = []
        while end > start:
            _, piece, end = best[end]
            out.append(piece)
        return out[::-1]

    def ids_of(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for piece in pieces:
            known = self.pieces.get(piece)
            if known is not None:
                out.append(known)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in piece.encode()]
            elif not out or out[-1] != self.unknown:  # neighbouring unknown characters are one id
                out.append(self.unknown)
        return out

    def word(self, word: str) -> bytes:
        """Ids of one word, 4 bytes each."""
        found = self.memo.get(word)
        if found is None:
            whole = len(word)
            path = self.only_path(word) if self.bpe else self.backtrace(self.paths(word, 0, "", whole), whole, 0)
            found = array("I", self.ids_of(path)).tobytes()
            if len(self.memo) < self.limit and len(word) <= 64:
                self.memo[word] = found
        return found

    def encode(self, normalized: str) -> bytes:
        """Ids of a whole normalized text, 4 bytes each."""
        return b"".join(map(self.word, self.words.findall(normalized)))

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.texts[i] for i in ids.tolist()]).decode(errors="replace")
        return text[1:] if self.prefix and text.startswith(" ") else text

    # chunks

    def states(self, text: str, boundary: int) -> list[State]:
        """All states that paths may have at ``boundary``; only the text near it matters."""
        if boundary == 0:
            return [(0, "")]
        if self._free(text, boundary):
            return [(boundary, "")]
        found = set()
        for begin in range(max(0, boundary - self.longest), boundary):
            for end in range(boundary, min(len(text), begin + self.longest) + 1):
                piece = text[begin:end]
                if piece in self.pieces or end - begin == 1:
                    found.add((end, piece if self.bpe else ""))
        return sorted(found)

    def _free(self, text: str, place: int) -> bool:
        """Whether no piece reaches over ``place``, seen from the two characters around it."""
        around = self.words.findall(text[place - 1 : place + 1])
        return place >= len(text) or len(around) > 1 and text[place - 1] != _SPACE

    def transfer(self, text: str, start: int, stop: int) -> Matrix:
        """Best weights from each state at ``start`` to each state at ``stop``; ``text`` reaches further than a piece on both sides."""
        exits = self.states(text, stop) if stop < len(text) else [(len(text), "")]
        free = [m.start() for m in self.words.finditer(text[start:stop])][1:]  # beginnings of words inside the chunk
        free = [start + f for f in free if self._free(text, start + f)]
        matrix: Matrix = {}
        if free:
            first, last = free[0], free[-1]
            middle = 0.0 if self.bpe else self._score(text[first:last])
            tail = self._exits(self.paths(text, last, "", stop), exits)
            for entry in self.states(text, start):
                reached = self.paths(text, entry[0], entry[1], first).get(first) if entry[0] <= first else None
                if reached:
                    matrix[entry] = {e: reached[0] + middle + w for e, w in tail.items()}
        else:
            for entry in self.states(text, start):
                if entry[0] < stop:
                    matrix[entry] = self._exits(self.paths(text, entry[0], entry[1], stop), exits)
                else:  # the piece reaches over the whole chunk
                    matrix[entry] = {(entry[0], "") if (entry[0], "") in exits else entry: 0.0}
        return matrix

    def _exits(self, best: dict[int, tuple[float, str, int]], exits: list[State]) -> dict[State, float]:
        out = {}
        for end, piece in exits:
            reached = best.get(end)
            if reached and (not piece or reached[1] == piece):
                out[end, piece] = reached[0]
        return out

    def _score(self, text: str) -> float:
        total = 0.0
        for word in self.words.findall(text):
            total += self.paths(word, 0, "", len(word))[len(word)][0]
        return total

    def between(self, text: str, start: int, stop: int, entry: State, exit_: State) -> bytes:
        """Ids of the pieces of one chunk between its two states."""
        if entry[0] >= exit_[0]:
            return b""
        free = [start + m.start() for m in self.words.finditer(text[start:stop])][1:]
        free = [f for f in free if f >= entry[0] and self._free(text, f)]
        if not free:
            pieces = self.backtrace(self.paths(text, entry[0], entry[1], stop), exit_[0], entry[0])
            return array("I", self.ids_of(pieces)).tobytes()
        first, last = free[0], free[-1]
        head = self.backtrace(self.paths(text, entry[0], entry[1], first), first, entry[0])
        tail = self.backtrace(self.paths(text, last, "", stop), exit_[0], last)
        middle = b"".join(map(self.word, self.words.findall(text[first:last])))
        return array("I", self.ids_of(head)).tobytes() + middle + array("I", self.ids_of(tail)).tobytes()


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One per Python worker and file."""
    return Model(path)


def product(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product: weights of the best paths through two chunks that follow each other."""
    out: Matrix = {}
    for entry, row in a.items():
        new: dict[State, float] = {}
        for middle, weight in row.items():
            for exit_, more in b.get(middle, {}).items():
                if weight + more > new.get(exit_, _NONE):
                    new[exit_] = weight + more
        if new:
            out[entry] = new
    return out


def scan(matrices: list[Matrix]) -> list[Matrix]:
    """Products of the first k matrices, for every k; halves are scanned by themselves and then joined."""
    if len(matrices) <= 1:
        return list(matrices)
    half = len(matrices) // 2
    left, right = scan(matrices[:half]), scan(matrices[half:])
    return left + [product(left[-1], m) for m in right]


def boundary_states(matrices: list[Matrix]) -> list[State]:
    """The states on the best path at each boundary, the two ends included."""
    prefixes = scan(matrices)
    start = next(iter(matrices[0]))
    end = max(prefixes[-1][start].items(), key=lambda x: x[1])[0]
    states = [end]
    for k in range(len(matrices) - 1, 0, -1):
        before = prefixes[k - 1][start]
        states.append(max((s for s in before if states[-1] in matrices[k].get(s, {})), key=lambda s: before[s] + matrices[k][s][states[-1]]))
    return [*states, start][::-1]


def _write_matrix(matrix: Matrix, offset: int) -> list[dict]:
    return [
        {"from": entry[0] + offset, "before": entry[1], "to": exit_[0] + offset, "last": exit_[1], "weight": weight}
        for entry, row in matrix.items()
        for exit_, weight in row.items()
    ]


_CHUNKS = "row long, doc_id long, chunk int, offset long, start int, stop int, content string"
_CELLS = "array<struct<from: long, before: string, to: long, last: string, weight: double>>"


def _cut(path: str, size: int):
    """Chunks of the normalized texts, with the characters around them that pieces may reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 33)
        around = model(path).longest + 1
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = model(path).normalize(text)
                row = next(number)
                for first in range(0, max(len(text), 1), 100 * size):
                    rows = []
                    for begin in range(first, min(first + 100 * size, max(len(text), 1)), size):
                        low = max(0, begin - around)
                        stop = min(begin + size, len(text))
                        rows.append((row, doc_id, begin // size, low, begin - low, stop - low, text[low : stop + around]))
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
                    names = [c.split()[0] for c in _CHUNKS.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def encode_giants(documents: DataFrame, path: str, chunk: int) -> DataFrame:
    """doc_id and ids of documents (doc_id, text), all of them cut into chunks that are worked on independently."""
    chunks = written(map_arrow(documents, _cut(path, chunk), _CHUNKS), f"{scratch_dir(documents.sparkSession)}/chunks")

    @F.arrow_udf(_CELLS)
    def transfer(offsets: pa.Array, starts: pa.Array, stops: pa.Array, contents: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (offsets, starts, stops, contents)), strict=True)
        return pa.array([_write_matrix(model(path).transfer(text, start, stop), offset) for offset, start, stop, text in rows], _cell_type())

    @F.arrow_udf("array<struct<chunk: int, from: long, before: string, to: long, last: string>>")
    def states(matrices: pa.Array) -> pa.Array:
        out = []
        for document in matrices.to_pylist():
            parts = []
            for one in sorted(document, key=lambda x: x["chunk"]):
                matrix: Matrix = {}
                for c in one["cells"]:
                    matrix.setdefault((c["from"], c["before"]), {})[c["to"], c["last"]] = c["weight"]
                parts.append(matrix)
            found = boundary_states(parts)
            out.append([{"chunk": k, "from": a[0], "before": a[1], "to": b[0], "last": b[1]} for k, (a, b) in enumerate(zip(found, found[1:], strict=False))])
        return pa.array(out, pa.list_(pa.struct([("chunk", pa.int32()), *_STATE_FIELDS])))

    @F.arrow_udf("binary")
    def backtrace(offsets: pa.Array, starts: pa.Array, stops: pa.Array, contents: pa.Array, ends: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (offsets, starts, stops, contents, ends)), strict=True)
        found = []
        for offset, start, stop, text, s in rows:
            entry, exit_ = (s["from"] - offset, s["before"]), (s["to"] - offset, s["last"])
            found.append(model(path).between(text, start, stop, entry, exit_))
        return pa.array(found, pa.binary())

    spread = chunks.repartition("row", "chunk")  # the chunks of one document go to many tasks
    matrices = spread.select("row", "chunk", transfer("offset", "start", "stop", "content").alias("cells"))
    per_row = matrices.groupBy("row").agg(F.collect_list(F.struct("chunk", "cells")).alias("matrices"))  # a few states a chunk
    path_states = per_row.select("row", F.explode(states("matrices")).alias("s")).select(F.col("row").alias("r"), F.col("s.chunk").alias("c"), "s")
    joined = chunks.join(path_states, (F.col("row") == F.col("r")) & (F.col("chunk") == F.col("c")))
    pieces = joined.select("row", "doc_id", "chunk", backtrace("offset", "start", "stop", "content", "s").alias("ids"))

    @F.arrow_udf("binary")
    def together(parts: pa.Array) -> pa.Array:
        return pa.array([b"".join(p["ids"] for p in sorted(x, key=lambda p: p["chunk"])) for x in parts.to_pylist()], pa.binary())

    whole = pieces.groupBy("row", "doc_id").agg(F.collect_list(F.struct("chunk", "ids")).alias("parts"))
    return whole.select("doc_id", together("parts").alias("ids"))


_STATE_FIELDS = [("from", pa.int64()), ("before", pa.string()), ("to", pa.int64()), ("last", pa.string())]


def _cell_type() -> pa.DataType:
    return pa.list_(pa.struct([*_STATE_FIELDS, ("weight", pa.float64())]))


def encode_documents(documents: DataFrame, model_path: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id and ids (binary, little-endian, 4 bytes each) of every row of ``documents`` (doc_id, text).

    The ids are those of the library without begin and end ids. Texts of up to ``chunk`` characters are encoded where they
    lie; longer ones in chunks of that length, each by itself. A null text is empty and has no ids; a null doc_id
    stays null; repeated rows are encoded one by one; other columns are ignored; an empty table gives no rows.
    """
    path = model_path or default_path(MODEL)
    importable(documents.sparkSession)

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        rows = (t.as_py() for t in texts)
        return pa.array([model(path).encode(model(path).normalize(t)) if t else b"" for t in rows], pa.binary())

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    giant = F.coalesce(F.length("text") > chunk, F.lit(False))
    usual = narrow.where(~giant).select("doc_id", encode("text").alias("ids"))
    return usual.unionByName(encode_giants(narrow.where(giant), path, chunk))


def decoded(ids: Column, model_path: str | None = None) -> Column:
    """Text of a column of ids as ``encode_documents`` gives them; null for null."""
    path = model_path or default_path(MODEL)

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else model(path).decode(np.frombuffer(x, "<u4")) for x in column.to_pylist()], pa.string())

    return decode(ids)


def encoding_digests(documents: DataFrame, model_path: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, and n_chars and text_crc32 of the text that the ids decode to."""
    path = model_path or default_path(MODEL)

    @F.arrow_udf("struct<n_tokens long, ids_crc32 long, n_chars long, text_crc32 long>")
    def digest(column: pa.Array) -> pa.Array:
        found = np.zeros((len(column), 4), np.int64)
        for row, data in enumerate(column):
            data = data.as_py()
            text = model(path).decode(np.frombuffer(data, "<u4"))
            found[row] = len(data) // 4, zlib.crc32(data), len(text), zlib.crc32(text.encode())
        return pa.StructArray.from_arrays([pa.array(c) for c in found.T.copy()], ["n_tokens", "ids_crc32", "n_chars", "text_crc32"])

    digests = encode_documents(documents, path, chunk).select("doc_id", digest("ids").alias("d"))
    return digests.select("doc_id", "d.n_tokens", "d.ids_crc32", "d.n_chars", "d.text_crc32")

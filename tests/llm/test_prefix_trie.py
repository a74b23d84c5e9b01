"""The prefix trie of conversations against a plain trie."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import by_key
from wattledger.llm import prefix_trie
from wattledger.llm.prefix_trie import RESULT, choose_splitters, shared, skeleton

TURNS = "conv_id long, turn long, role string, text string"


def plain_paths(rows, rebuild: bool) -> dict:
    own: dict = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    if not rebuild:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(rows, rebuild=False):
    members: dict = {}
    paths = plain_paths(rows, rebuild)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        d = len(node)
        below = [k for k in members if k[:d] == node]
        children = [k for k in below if len(k) == d + 1]
        leaves = [k for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in ids if len(paths[c]) == d)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), d, parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def awkward_turns():
    rnd = random.Random(4)
    rows = []
    for c in [*range(-105, 12), 100, 150, 199, 200, 2**63 - 1, -(2**63)]:
        for turn in range(rnd.randint(1, 7)):
            rows.append((c, turn, rnd.choice(["user", "assistant", None]), rnd.choice(["hello", "yes", "no", "", None, "\U0001f600 \u00e9"])))
    rows += [(300 + i, t, "user", "the same opening" if t == 0 else f"turn {t}") for i in range(40) for t in range(4)]  # copies
    rows += [(400 + i, t, "user", "the same opening" if t == 0 else f"{i % 7} {t}") for i in range(60) for t in range(1 + i % 5)]
    rows += [(500, None, "user", "no number"), (500, 1, "user", "one"), (500, 1, "assistant", "one"), (500, 1, "user", "one")]
    rows += [(501, t, "user", "x") for t in range(150)] + [(502, t, "user", "x") for t in range(140)]
    rows += [(None, 0, "user", "nobody"), (None, 1, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("shard_turns", [200_000, 40, 1])
def test_nodes_equal_a_plain_trie(spark, rebuild, shard_turns):
    rows = awkward_turns()
    df = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit(n) for n in ("path", "n", "owner", "depth", "ends")})
    found = prefix_trie.prefix_trie(df, rebuild=rebuild, shard_turns=shard_turns)
    assert found.columns == RESULT
    assert by_key(found, *RESULT) == plain_trie(rows, rebuild)


def test_one_opening_of_all_conversations(spark):
    """A hot first turn is met in every shard; its node and those of the skeleton are added up once."""
    rows = [(i, t, "user", "hot" if t < 2 else f"{i % (50 * t)}") for i in range(400) for t in range(4)]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(7), shard_turns=60)
    assert by_key(found, *RESULT) == plain_trie(rows)


def test_empty_tables_and_null_ids(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS), rebuild=True).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TURNS)).collect() == []


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "gone")]
    assert by_key(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS), rebuild=True), *RESULT) == plain_trie(rows, True)
    assert plain_trie(rows, True)[0][:4] == (c, 0, None, 1)


def test_splitters_are_short_and_their_skeleton_is_numbered():
    rnd = random.Random(1)
    turn = [bytes([i]) * 16 for i in range(4)]
    paths = sorted({b"".join(rnd.choice(turn) for _ in range(rnd.randint(0, 9))) for _ in range(600)})
    splitters = choose_splitters(paths, 12)
    assert splitters == sorted(set(splitters)) and len(splitters) == 11
    owners = skeleton(splitters)
    beginnings = {(owners[k][d], d): s[: 16 * d] for k, s in enumerate(splitters) for d in range(len(s) // 16 + 1)}
    assert len(set(beginnings.values())) == len(beginnings) == len({s[: 16 * d] for s in splitters for d in range(len(s) // 16 + 1)})
    for a, b in zip(paths, paths[1:], strict=False):
        same = 0
        while same < min(len(a), len(b)) // 16 and a[: 16 * (same + 1)] == b[: 16 * (same + 1)]:
            same += 1
        assert shared(a, b) == same

"""The conversation trie against a trie built in plain Python."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import pytest

from prepkit.llm import conversation_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, q1 string, first string"


def plain(rows: list[tuple], rebuild: bool = True) -> list[tuple]:
    own = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = own
    if rebuild:
        built = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            built[c] = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(path))))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children[path],
                    leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ours(df, rebuild: bool = True) -> list[tuple]:
    turns = conversation_trie.numbered_turns(df)
    steps = conversation_trie.rebuilt(turns) if rebuild else conversation_trie.as_they_are(turns)
    nodes = conversation_trie.trie(*steps)
    assert nodes.columns == NAMES and [t for _, t in nodes.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(map(tuple, nodes.collect()), key=repr)


def some_rows(seed: int, n: int = 60) -> list[tuple]:
    """Few different turns, so that beginnings are shared; odd ids, nulls, ties and repeated rows."""
    draw = random.Random(seed)
    said = [None, "", "yes", "no", "ß漢\U0001f600", "x" * 90]
    rows = []
    for c in draw.sample(range(-8, 2 * n), n):
        for t in range(draw.choice([1, 2, 3, 4, 8, 12])):
            turn = draw.choice([t, t, t, None, 1])
            rows.append((c, turn, draw.choice([None, "user", "user"]), draw.choice(said[:draw.choice([2, 3, 6])]), 1, "a", "b"))
    rows += rows[:5] + [(None, 1, "user", "nobody's", 1, "a", "b")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("rebuild", [True, False])
def test_trie(spark, seed, rebuild):
    rows = some_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert ours(df, rebuild) == plain(rows, rebuild)


def test_blocks_chunks_and_a_full_sketch(spark, monkeypatch):
    """Conversations over several blocks, ids over several chunks, and cells that prove nearly nothing single."""
    monkeypatch.setattr(conversation_trie, "BLOCK", 3)
    monkeypatch.setattr(conversation_trie, "CHUNK_BYTES", 60)
    monkeypatch.setattr(conversation_trie, "MAX_CELLS", 1 << 6)
    monkeypatch.setattr(conversation_trie, "CELLS_PER_PREFIX", 0)
    rows = some_rows(3, 40)
    rows += [(1000 + c, t, "user", f"step {t}", 1, "a", "b") for c in range(20) for t in range(10)]
    rows += [(5000, t, "user", f"step {t // 2}", 1, "a", "b") for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for rebuild in (True, False):
        assert ours(df, rebuild) == plain(rows, rebuild)


def test_turnless_and_single(spark):
    # 4's checksum leaves nothing of one turn, and conversation 0 does not exist.
    gone = next(c for c in range(1, 5) if zlib.crc32(str(c).encode()) % 9 > 0)
    rows = [(gone, 1, "user", "hello", 1, "a", "b")]
    got = ours(spark.createDataFrame(rows, SCHEMA))
    assert got == plain(rows) and len(got) == 1 and got[0][5] == 1


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    nobody = spark.createDataFrame([(None, 1, "user", "x", 1, "a", "b")], SCHEMA)
    for df in (none, nobody):
        assert ours(df) == [] and ours(df, rebuild=False) == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert sorted(map(tuple, queries.op13_conversation_trie(spark, folder).collect()), key=repr) == plain(rows)

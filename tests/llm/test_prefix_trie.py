import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import rows, same_as_sql, write
from wearline.llm import prefix_trie
from wearline.llm.common import SpanHashes, mix64
from wearline.llm.prefix_trie import RangeMinimum, block_nodes, join_borders

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(sequences, size):
    """Nodes of {sequence: (members, least)}, by looking at all prefixes."""
    members = {}
    for s, x in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(x)
    n = {p: sum(x[0] for x in v) for p, v in members.items()}
    least = {p: min(x[1] for x in v) for p, v in members.items()}
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    out = []
    for p in members:
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((n[q] - 1) * size(q) for q in below)
        out.append((least[p], len(p), least[p[:-1]] if p else None, n[p], children[p], sum(children[q] == 0 for q in below), saved))
    return sorted(out, key=repr)


def test_range_minimum_and_reaches():
    rng = np.random.default_rng(1)
    for _ in range(50):
        v = rng.integers(0, 5, rng.integers(1, 40))
        v[0] = -1
        table = RangeMinimum(v)
        for i in range(len(v)):
            for d in range(6):
                right = i
                while right + 1 < len(v) and v[right + 1] >= d:
                    right += 1
                left = i
                while left >= 0 and v[left] >= d:
                    left -= 1
                assert table.reach_right(np.array([i]), np.array([d]))[0] == right
                assert table.reach_left(np.array([i]), np.array([d]))[0] == left
            assert table.least(np.array([0]), np.array([i]))[0] == v[: i + 1].min()


def _keys(s):
    turn = mix64(np.arange(1, 10, dtype=np.uint64))[np.array(s, int)]
    at = np.arange(len(s))
    return [SpanHashes(at, x).of(np.zeros(len(s), np.int64), at + 1).view(np.int64) for x in (turn, turn * np.uint64(3))]


def test_blocks_and_borders_equal_brute_force():
    rnd = random.Random(1)
    size = lambda p: 3 * (p[-1] + 1) if p else 0
    for _ in range(100):
        sequences = {tuple(rnd.randint(0, 2) for _ in range(rnd.randint(0, 6))): (rnd.randint(1, 4), rnd.randint(0, 1000)) for _ in range(rnd.randint(1, 40))}
        ordered = sorted(sequences, key=lambda s: _keys(s)[0].tolist())
        cuts = sorted({0, len(ordered), *(rnd.randint(0, len(ordered)) for _ in range(rnd.randint(0, 4)))})
        nodes = []
        for x, y in zip(cuts, cuts[1:]):
            block = ordered[x:y]
            keys = [_keys(s) for s in block]
            a, b = (np.concatenate([k[i] for k in keys]) for i in (0, 1))
            first = np.concatenate(([0], np.cumsum([len(s) for s in block]))).astype(np.int64)
            sizes = np.array([size(s[: d + 1]) for s in block for d in range(len(s))], np.int64)
            found = block_nodes(a, b, sizes, first, *(np.array([sequences[s][i] for s in block]) for i in (0, 1)))
            known = ~np.ma.getmaskarray(found["parent"])
            nodes += [{k: int(np.asarray(v)[i]) for k, v in found.items()} | {"known": known[i]} for i in range(len(known))]
        merged = {}
        for d in nodes:
            if d["border"]:
                e = merged.setdefault((d["depth"], d["a"], d["b"]), d | dict.fromkeys(("n", "children", "leaves", "saved"), 0))
                e["conv_id"] = min(e["conv_id"], d["conv_id"])
                for c in ("n", "children", "leaves", "saved"):
                    e[c] += d[c]
        columns = ("depth", "a", "b", "pa", "pb", "conv_id", "n", "children", "leaves", "saved", "bytes")
        joined = join_borders(pa.table({c: pa.array([e[c] for e in merged.values()], pa.int64()) for c in columns})).to_pylist()
        of = {(e["depth"], e["a"], e["b"]): e["conv_id"] for e in joined}
        for d in nodes:
            if not d["known"]:
                d["parent"] = of.get((d["depth"] - 1, d["pa"], d["pb"]))
        got = [tuple(d[c] for c in ("conv_id", "depth", "parent", "n", "children", "leaves", "saved")) for d in [x for x in nodes if not x["border"]] + joined]
        assert sorted(got, key=repr) == brute(sequences, size)


def _turns(seed=5, n=60):
    rnd = random.Random(seed)
    table = []
    for c in range(n):
        conv = rnd.choice([c, c, c, -c, 7 * c])
        for t in range(rnd.randint(1, 11)):
            table.append((conv, rnd.choice([t, t, t, None]), rnd.choice(["user", "assistant", None, ""]), rnd.choice(["hi", "hé", None, "", "a longer turn"])))
    copies = [(1000 + 5 * i, t, "user", f"turn {t}") for i in range(12) for t in range(3)]
    return table + copies + copies[:4] + [(None, 0, "user", "nobody"), (3, None, None, None), (2**62, 1, "user", "hi")]


def test_query_equals_sql_on_special_rows(spark, scratch):
    same_as_sql(spark, write(scratch, conversations=_turns()), prefix_trie, "op12_prefix_trie")


@pytest.mark.parametrize("block, piece, least", [(1, 1, 64), (7, 3, 1), (500_000, 65_536, 1)])
def test_small_blocks_and_pieces_give_the_same_trie(spark, monkeypatch, block, piece, least):
    monkeypatch.setattr("wearline.llm.common.HOT_LEAST", least)
    monkeypatch.setattr("wearline.llm.common.FEW_FACTS", 0 if least == 1 else 200_000)
    df = spark.createDataFrame(_turns(8), "conv_id bigint, turn bigint, role string, text string").repartition(5)
    conversations = prefix_trie.rebuilt(df)
    assert rows(prefix_trie.trie(conversations, block, piece), *COLUMNS) == rows(prefix_trie.trie(conversations), *COLUMNS)


def test_rebuilding_takes_the_first_turns_of_the_family(spark):
    c = next(i for i in range(1, 200) if i % 5 and zlib.crc32(str(i).encode()) % 9 == 3)
    table = [(c - c % 5, t, "r", f"base {t}") for t in range(6)] + [(c, t, "r", f"own {t}") for t in range(5)]
    df = spark.createDataFrame(table, "conv_id bigint, turn bigint, role string, text string")
    sizes = {r.conv_id: r.sizes for r in prefix_trie.rebuilt(df).collect()}
    assert sizes[c] == [6, 6, 6, 5, 5] and sizes[c - c % 5] == [6] * 6


def test_empty_table(spark, scratch):
    assert prefix_trie.op12_prefix_trie(spark, write(scratch, conversations=[])).count() == 0

"""Trie of the turn sequences of conversations, from sorted prefix lists and range minima.

1. A turn is a 128-bit digest of its role and text, a conversation the list of its turns' digests in
   order, a prefix a 128-bit hash of its first turns. Texts go no further than their digest.
2. Equal sequences become one row with a count (combined before the shuffle, so a conversation
   that fills a third of the table is a few rows), range-sorted by their prefix lists.
3. A block of consecutive rows computes the longest common prefix of neighbours and a sparse table
   of its range minima. A node is the first row of its interval and a depth; each such candidate
   binary-searches, down the table's levels and independently of all others, how far its interval
   reaches to the right, and the rows where one branches off search to the left for their parent.
   Nodes in row and depth order are in preorder, so that sums over subtrees are differences of
   running sums, and the smallest member is a range minimum too.
4. Only prefixes of a block's first and last row can go on in another block. Those nodes (two paths
   for ``BLOCK_TURNS`` turns) are merged by key and added up along their paths in one task.
5. The ids of conversations that end at a node are sorted by a range shuffle, joined to pieces of
   text in parallel, and the pieces of a node are hashed in order as they stream by.

Results for special rows: a null conv_id is no conversation; null turns come first; equal turns of a
conversation are ordered by the digest; a null role or text counts as empty; repeated rows are
turns of their own; a conversation without turns is a member of the root; an empty table has no
root and gives no rows; extra columns are ignored. The digests of one conversation (48 bytes a
turn) are one row, so they must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import SpanHashes, hot_bar, land, looked_up, table

#: Turns of a block; a longer conversation is a block of its own.
BLOCK_TURNS = 500_000
#: Ids that are joined to one piece of text.
PIECE_IDS = 65_536
#: Turns that a conversation may take from the first one of its five, and the size of such families.
MOST_SHARED, FAMILY = 8, 5

# ---- numpy side --------------------------------------------------------------------------------


class RangeMinimum:
    """Sparse table: ``levels[j][i]`` is the least of ``values[i : i + 2**j]``."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            half, last = 2 ** (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The least value of each start..stop, both included."""
        level = np.frexp((stop - start + 1).astype(float))[1] - 1
        out = np.empty(len(start), self.levels[0].dtype)
        for j in np.unique(level):
            at = level == j
            out[at] = np.minimum(self.levels[j][start[at]], self.levels[j][stop[at] - 2**j + 1])
        return out

    def reach_right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last row r with values[row + 1 .. r] all at least ``depth``."""
        at = row.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            level = self.levels[j]
            fits = at + 1 < len(level)
            fits[fits] = level[at[fits] + 1] >= depth[fits]
            at[fits] += 2**j
        return at

    def reach_left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first row r with values[r + 1 .. row] all at least ``depth``."""
        at = row.copy()
        for j in range(len(self.levels) - 1, -1, -1):
            level, first = self.levels[j], at - 2**j + 1
            fits = first >= 0
            fits[fits] = level[first[fits]] >= depth[fits]
            at[fits] -= 2**j
        return at


def neighbours_lcp(a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the one before; -1 for the first row."""
    size = np.diff(first)
    shared = np.minimum(size[1:], size[:-1])
    offset = np.concatenate(([0], np.cumsum(shared)))
    step = np.arange(offset[-1]) - np.repeat(offset[:-1], shared)
    here, before = np.repeat(first[1:-1], shared) + step, np.repeat(first[:-2], shared) + step
    # equal prefixes have equal shorter ones: the number of equal prefixes is the length
    same = np.concatenate(([0], np.cumsum((a[here] == a[before]) & (b[here] == b[before]))))
    return np.concatenate(([-1], same[offset[1:]] - same[offset[:-1]]))


_NODE = "depth bigint, a bigint, b bigint, pa bigint, pb bigint, conv_id bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, bytes bigint, border boolean"
_NODE_NAMES = [c.split()[0] for c in _NODE.split(", ")]


def block_nodes(a: np.ndarray, b: np.ndarray, size: np.ndarray, first: np.ndarray, n: np.ndarray, least: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes of a block of distinct, sorted sequences.

    ``a`` and ``b`` are the prefix keys of all rows, one after the other, ``size`` the bytes of their
    last turns, ``first`` the offsets of the rows, ``n`` and ``least`` members and smallest member.
    Border nodes count what is below them, but for what is below another border node.
    """
    lens, lcp = np.diff(first), neighbours_lcp(a, b, first)
    minima = RangeMinimum(lcp)
    new = lens - lcp
    node_of = np.concatenate(([0], np.cumsum(new)))
    row = np.repeat(np.arange(len(lens)), new)
    depth = np.arange(node_of[-1]) - node_of[:-1][row] + lcp[row] + 1
    last = minima.reach_right(row, depth)
    parent = np.arange(len(row)) - 1
    branch = np.flatnonzero((depth == lcp[row] + 1) & (depth > 0))
    up = minima.reach_left(row[branch], depth[branch] - 1)
    parent[branch] = node_of[up] + depth[branch] - 1 - (lcp[up] + 1)

    def at(keys: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The key of each node's row at depth d; the root's is 0."""
        out = np.zeros(len(row), np.int64)
        real = d > 0
        out[real] = keys[first[:-1][row[real]] + d[real] - 1]
        return out

    border = np.zeros(len(row), bool)
    border[: node_of[1]] = True
    ends = np.full(lens[-1] + 1, len(lens) - 1)
    path = np.arange(lens[-1] + 1)
    heads = minima.reach_left(ends, path)
    border[node_of[heads] + path - (lcp[heads] + 1)] = True

    running = np.concatenate(([0], np.cumsum(n)))
    members = running[last + 1] - running[row]
    inner = np.flatnonzero(~border)
    children = np.bincount(parent[inner], minlength=len(row))
    weight = np.where(border, 0, (members - 1) * at(size, depth))
    leaf = ~border & (children == 0)
    after = node_of[last + 1]
    here = np.arange(len(row))
    saved, leaves = (np.concatenate(([0], np.cumsum(x))) for x in (weight, leaf.astype(np.int64)))
    saved, leaves = saved[after] - saved[here], leaves[after] - leaves[here]
    # a border node leaves what is below another one to that one
    low = np.flatnonzero(border & (depth > 0))
    for sums in (saved, leaves):
        np.subtract.at(sums, parent[low], sums[low].copy())
    conv = RangeMinimum(least).least(row, last)
    known = (depth > 0) & ~border & ~border[parent]
    return {
        "depth": depth, "a": at(a, depth), "b": at(b, depth), "pa": at(a, depth - 1), "pb": at(b, depth - 1),
        "conv_id": conv, "parent": np.ma.array(conv[parent], mask=~known), "n": members, "children": children,
        "leaves": leaves, "saved": saved, "bytes": at(size, depth), "border": border,
    }


def join_borders(t: pa.Table) -> pa.Table:
    """Merged border nodes, with their sums added up along the paths; ``hung`` counts children beyond the border."""
    depth, conv, n, hung, leaves, saved, size = (t.column(c).to_numpy().copy() for c in ("depth", "conv_id", "n", "children", "leaves", "saved", "bytes"))
    key = {k: i for i, k in enumerate(zip(*(t.column(c).to_pylist() for c in ("depth", "a", "b")), strict=True))}
    up = np.array([key.get((d - 1, x, y), -1) for d, x, y in zip(depth.tolist(), t.column("pa").to_pylist(), t.column("pb").to_pylist(), strict=True)], np.int64)
    children = hung + np.bincount(up[up >= 0], minlength=len(depth))
    leaves += children == 0
    saved += (n - 1) * size
    for d in range(int(depth.max(initial=0)), 0, -1):
        at = np.flatnonzero(depth == d)
        np.add.at(leaves, up[at], leaves[at])
        np.add.at(saved, up[at], saved[at])
    parent = pa.array(conv[up], mask=up < 0)
    return pa.table([*(t.column(c) for c in ("depth", "a", "b", "conv_id")), parent, t.column("n"), pa.array(children), pa.array(leaves), pa.array(saved), pa.array(hung)], names=_JOINED_NAMES)


_JOINED = "depth bigint, a bigint, b bigint, conv_id bigint, parent bigint, n bigint, children bigint, leaves bigint, saved bigint, hung bigint"
_JOINED_NAMES = [c.split()[0] for c in _JOINED.split(", ")]


# ---- Spark side --------------------------------------------------------------------------------


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, keys, sizes: each conversation's first turns, up to ``MOST_SHARED`` by its id, from the
    first conversation of its family, then its own after as many."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    one = F.struct("turn", F.md5(F.concat(F.md5(role), F.md5(text))).alias("key"), F.octet_length(text).cast("bigint").alias("size"))
    own = turns.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("own"))
    heads = own.select(F.col("conv_id").alias("head_id"), F.slice("own", 1, MOST_SHARED).alias("head"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    own = own.select("*", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("head_id"), shared.cast("int").alias("h"))
    # the turns of a missing first conversation are none
    none = F.slice("own", 1, F.lit(0))
    whole = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own")))
    return own.join(heads, "head_id", "left").select("conv_id", whole.alias("s")).select("conv_id", F.col("s.key").alias("keys"), F.col("s.size").alias("sizes"))


def _offsets(column: pa.Array) -> np.ndarray:
    o = np.asarray(column.offsets).astype(np.int64)
    return o - o[0]


def _values(column: pa.Array) -> pa.Array:
    return column.flatten()


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, len, a, b, sizes: the two hashes of every prefix of every conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2_000):
                block = whole.slice(start, 2_000)
                first = _offsets(block.column(1))
                text = _values(block.column(1)).to_pylist()
                digest = np.frombuffer(bytes.fromhex("".join(text)), np.uint64).reshape(-1, 2)
                row = np.repeat(np.arange(block.num_rows), np.diff(first))
                place = np.arange(len(row))
                a, b = (SpanHashes(place, np.ascontiguousarray(digest[:, i])).of(first[:-1][row], place + 1).view(np.int64) for i in (0, 1))
                sizes = _values(block.column(2)).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [block.column(0), pa.array(np.diff(first)), *(_lists(first, x) for x in (a, b, sizes))], names=["conv_id", "len", "a", "b", "sizes"]
                )

    return conversations.mapInArrow(run, "conv_id bigint, len bigint, a array<bigint>, b array<bigint>, sizes array<bigint>")


def _ended(members: DataFrame, piece_ids: int) -> DataFrame:
    """depth, a, b, ends_sha256 of the nodes where conversations end."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in batches:
            depth, a, b, ids = (block.column(i).to_numpy() for i in range(4))
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (depth[1:] != depth[:-1])
            begin = np.flatnonzero(new)
            cuts = np.union1d(begin, np.arange(0, len(a), piece_ids))
            text = [",".join(map(str, ids[x:y].tolist())) for x, y in zip(cuts, [*cuts[1:], len(a)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x[cuts]) for x in (depth, a, b, ids)] + [pa.array(text, pa.string())], names=["depth", "a", "b", "least", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, hashlib.sha256(), []
        for block in batches:
            columns = [block.column(i) for i in range(5)]
            for r in range(block.num_rows):
                key = tuple(columns[i][r].as_py() for i in range(3))
                if key != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(columns[4][r].as_buffer())
            if len(done) > 10_000:
                yield emit(done)
                done = []
        if now is not None:
            done.append((*now, state.hexdigest()))
        if done:
            yield emit(done)

    def emit(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate(kinds)], names=["depth", "a", "b", "ends_sha256"])

    key = ["a", "b", "depth"]
    rows = members.select("depth", "a", "b", "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    texts = rows.mapInArrow(pieces, "depth bigint, a bigint, b bigint, least bigint, piece string")
    ordered = texts.repartition(*key).sortWithinPartitions(*key, "least")
    return ordered.mapInArrow(digests, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _end(column: str):
    """The last element of a list of keys, 0 for an empty one."""
    return F.coalesce(F.try_element_at(column, F.lit(-1)), F.lit(0).cast("bigint"))


def trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS, piece_ids: int = PIECE_IDS) -> DataFrame:
    """One row a node of the trie of ``conversations`` (conv_id, keys, sizes): its digest columns."""
    known = land(prefixes(conversations), "prefixes")
    kinds = known.groupBy("len", _end("a").alias("za"), _end("b").alias("zb")).agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), *[F.first(c).alias(c) for c in ("a", "b", "sizes")]
    )
    kinds = land(kinds.select("a", "b", "sizes", "n", "least", "len"), "sequences")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            lists = [t.column(i).combine_chunks() for i in range(3)]
            a, b, size = (_values(x).to_numpy() for x in lists)
            out = block_nodes(a, b, size, _offsets(lists[0]), t.column(3).to_numpy(), t.column(4).to_numpy())
            columns = [pa.array(np.asarray(out[c]), mask=np.ma.getmaskarray(out[c])) if c == "parent" else pa.array(out[c]) for c in _NODE_NAMES]
            yield from pa.table(columns, names=_NODE_NAMES).to_batches(100_000)

        for whole in batches:
            start = 0
            reach = np.cumsum(whole.column(5).to_numpy() + 1)
            while start < whole.num_rows:
                base = reach[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(reach, base + block_turns - turns, "right")))
                held.append(whole.slice(start, stop - start))
                turns += int(reach[stop - 1] - base)
                start = stop
                if turns >= block_turns:
                    yield from emit()
                    held, turns = [], 0
        if held:
            yield from emit()

    nodes = land(kinds.repartitionByRange("a").sortWithinPartitions("a").mapInArrow(run, _NODE), "trie-nodes")

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)
        if rows:
            yield from join_borders(pa.Table.from_batches(rows).combine_chunks()).to_batches()

    key = ["depth", "a", "b"]
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    border = nodes.filter("border").groupBy(*key).agg(*[F.first(c).alias(c) for c in ("pa", "pb", "bytes")], F.min("conv_id").alias("conv_id"), *sums)
    # two paths of a block
    border = land(border.repartition(1).mapInArrow(resolve, _JOINED), "trie-borders")

    names = [c for c in _JOINED_NAMES if c != "hung"]
    inner = nodes.filter("NOT border")
    hanging = inner.filter("parent IS NULL").drop("parent")
    above = border.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent"), "hung")
    hanging = looked_up(hanging, above.filter("hung > 0"), ["depth", "pa", "pb"], "hung", hot_bar(nodes.count()))
    every = inner.filter("parent IS NOT NULL").select(*names).unionByName(hanging.select(*names)).unionByName(border.select(*names))
    ended = _ended(known.select(F.col("len").alias("depth"), _end("a").alias("a"), _end("b").alias("b"), "conv_id"), piece_ids)
    return every.join(ended, key, "left").select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt ``conversations``."""
    return trie(rebuilt(table(spark, sf_dir, "conversations")))


QUERIES = {"op12_prefix_trie": op12_prefix_trie}

_CRC = "list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, x: list_reduce(list_concat([xor(c, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))"

ORACLE_SQL = {
    "op12_prefix_trie": f"""
WITH turns AS (
  SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS key, strlen(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(key ORDER BY turn NULLS FIRST, key) AS keys, list(size ORDER BY turn NULLS FIRST, key) AS sizes FROM turns GROUP BY conv_id
), crc AS (
  SELECT *, (xor({_CRC.format('conv_id')}, 4294967295) % 9)::BIGINT AS h FROM own
), whole AS (
  SELECT c.conv_id, list_concat(coalesce(f.keys[1:c.h], []), c.keys[c.h + 1:]) AS keys, list_concat(coalesce(f.sizes[1:c.h], []), c.sizes[c.h + 1:]) AS sizes
  FROM crc c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 5
), prefix AS (
  SELECT conv_id, len(keys) AS n_turns, d AS depth, array_to_string(keys[1:d], ',') AS path, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(0, len(keys) + 1)) AS d FROM whole)
), node AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n_turns = depth), '')) AS ends_sha256
  FROM prefix GROUP BY ALL
), link AS (
  SELECT DISTINCT u.depth, u.path, d.depth AS below, d.path AS below_path FROM prefix u JOIN prefix d ON u.conv_id = d.conv_id AND d.depth >= u.depth
), child AS (
  SELECT depth, path, count(*) AS n_children FROM link WHERE below = depth + 1 GROUP BY ALL
), full_node AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM node n LEFT JOIN child c ON c.depth = n.depth AND c.path = n.path
), sums AS (
  SELECT l.depth, l.path, sum((b.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((b.n_convs - 1) * b.size)::BIGINT AS saved_tokens
  FROM link l JOIN full_node b ON b.depth = l.below AND b.path = l.below_path GROUP BY ALL
), up AS (
  SELECT l.below AS depth, l.below_path AS path, p.conv_id AS parent_conv_id FROM link l JOIN node p ON p.depth = l.depth AND p.path = l.path WHERE l.below = l.depth + 1
)
SELECT n.conv_id, n.depth, up.parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_node n JOIN sums s ON s.depth = n.depth AND s.path = n.path LEFT JOIN up ON up.depth = n.depth AND up.path = n.path
"""
}

"""Exact top-k search by inner product over M-trees.

Inner products become distances: with M the largest norm, a vector y gets one more coordinate
sqrt(M**2 - |y|**2) and a query 0, so that the squared distance is |q|**2 + M**2 - 2 q.y and the
nearest vector has the largest product.

Cells: at most ``CELLS`` pivots, taken from the vectors in the order of a hash, go to every task;
each vector belongs to the cell of its nearest pivot. A cell has a covering radius, and is dealt
out to trees of about ``TREE_ROWS`` rows by a hash. Of equal vectors only as many are kept as
can be among the best k of any query, the smallest ids.

Build: each tree is loaded top down: pivots, every vector to its nearest pivot, until a page holds
at most ``PAGE`` vectors. A node stores its pivot, its covering radius and its distance to the
parent's pivot; a leaf also stores its vectors' distances to its pivot. Nodes are rows of a table
in the shared folder.

Search: a query first searches one tree of its nearest cell; its k-th best score there is a bound.
Then it goes to the other trees of those cells only whose ball can hold something better. In a
tree the search is best first: a node is visited in the order of the least distance its ball
allows; before the distance to a child's pivot (or to a vector) is computed, the triangle
inequality over the stored distance to the parent's pivot must not exclude it already. A tree is
left when the least distance allowed exceeds the bound. Scores are exact integers; ties go to the
smaller id. Queries meet a tree in blocks of about ``QUERY_BLOCK``; a tree that more queries
visit is copied for each block.

Results for special rows: null vectors and vectors with a null or non-finite component take no
part (nor does a null id); shorter vectors are continued with zeros; rows that share the query's
id are not its candidates; repeated rows are candidates of their own; queries that share an id
and a vector are one query; a table without vectors gives no rows; vectors whose squared length
passes 2**62, so that scores could leave 64 bits, raise.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import discard, land, table

SCALE, QUERY_EVERY, K = 256, 50, 5
TREE_ROWS, PAGE, FAN_OUT = 8192, 96, 12
CELLS, QUERY_BLOCK = 512, 4096
#: Relative slack of the bounds, for rounding of distances.
SLACK = 1e-9

_NODES = (
    "tree bigint, node int, parent int, leaf boolean, radius double, to_parent double, pivot array<double>, "
    "ids array<bigint>, distances array<double>, vectors array<bigint>"
)


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of every component, for the vectors that take part."""
    x = F.col("embedding")
    fine = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))
    return vectors.filter(fine & F.col("vec_id").isNotNull()).select(
        "vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("bigint")).alias("v")
    )


# ---- numpy side --------------------------------------------------------------------------------


def lifted(v: np.ndarray, norm2: float) -> np.ndarray:
    """Vectors with the coordinate that turns products into distances."""
    own = (v.astype(float) ** 2).sum(1)
    return np.column_stack((v.astype(float), np.sqrt(np.maximum(0, norm2 - own))))


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(-1))


def load(points: np.ndarray) -> list[dict]:
    """Nodes of one tree, the root first; members are row numbers."""
    nodes: list[dict] = []
    todo = [(np.arange(len(points)), -1, 0)]
    while todo:
        rows, parent, at = todo.pop()
        pivot = points[rows[at]]
        d = _distances(points[rows], pivot)
        node = {"parent": parent, "pivot": pivot, "radius": float(d.max()), "rows": rows, "distances": d, "leaf": len(rows) <= PAGE}
        node["to_parent"] = float(_distances(pivot, nodes[parent]["pivot"])) if parent >= 0 else 0.0
        number = len(nodes)
        nodes.append(node)
        if node["leaf"]:
            continue
        # pivots far from each other: the next is the farthest from those chosen
        fan = min(FAN_OUT, -(-len(rows) // (PAGE // 2)))
        chosen, nearest = [0], np.full(len(rows), np.inf)
        owner = np.zeros(len(rows), int)
        for c in range(fan):
            own = _distances(points[rows], points[rows[chosen[-1]]])
            owner = np.where(own < nearest, c, owner)
            nearest = np.minimum(nearest, own)
            if c + 1 < fan:
                chosen.append(int(nearest.argmax()))
        groups = [np.flatnonzero(owner == c) for c in range(fan)]
        if max(map(len, groups)) == len(rows):
            groups = [np.arange(i, min(i + PAGE, len(rows))) for i in range(0, len(rows), PAGE)]  # all alike
        todo += [(rows[g], number, int(np.flatnonzero(g == chosen[c])[0]) if c < fan and chosen[c] in g else 0) for c, g in enumerate(groups) if len(g)]
    return nodes


class Tree:
    """Nodes of one tree as arrays, ready for queries."""

    def __init__(self, nodes: list[dict]) -> None:
        self.nodes = sorted(nodes, key=lambda n: n["node"])
        self.children: dict[int, np.ndarray] = {}
        for n in self.nodes:
            self.children.setdefault(n["parent"], []).append(n["node"])
        self.children = {k: np.array(v) for k, v in self.children.items()}
        self.pivots = np.array([n["pivot"] for n in self.nodes])
        self.radius = np.array([n["radius"] for n in self.nodes])
        self.to_parent = np.array([n["to_parent"] for n in self.nodes])
        width = self.pivots.shape[1] - 1
        self.leaves = {
            n["node"]: (np.array(n["ids"], np.int64), np.array(n["distances"]), np.array(n["vectors"], np.int64).reshape(-1, width))
            for n in self.nodes
            if n["leaf"]
        }

    def search(self, query_id: int, query: np.ndarray, norm2: float, k: int, least_score: int | None = None) -> tuple[list[tuple[int, int]], int]:
        """(score, id) of the best k, best first, and how many distances were computed; vectors that
        score under ``least_score`` may be left out."""
        q = np.append(query.astype(float), 0.0)
        base = float((query.astype(float) ** 2).sum()) + norm2
        slack = SLACK * math.sqrt(base) + 1e-9
        best: list[tuple[int, int]] = []  # a heap, worst first: (score, -id)
        limit = math.inf if least_score is None else math.sqrt(max(0.0, base - 2 * least_score))

        d_root = float(_distances(self.pivots[0], q))
        heap, computed = [(max(0.0, d_root - self.radius[0]), 0, d_root)], 1
        while heap:
            least, node, d = heapq.heappop(heap)
            if least > limit + slack:
                break
            if node in self.leaves:
                ids, own, vectors = self.leaves[node]
                near = (np.abs(d - own) <= limit + slack) & (ids != query_id)
                computed += int(near.sum())
                scores, ids = vectors[near] @ query, ids[near]
                if len(best) == k:
                    good = scores >= best[0][0]
                    scores, ids = scores[good], ids[good]
                if len(scores) > k:
                    top = np.lexsort((ids, -scores))[:k]
                    scores, ids = scores[top], ids[top]
                for s, i in zip(scores.tolist(), ids.tolist(), strict=True):
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k:
                    limit = min(limit, math.sqrt(max(0.0, base - 2 * best[0][0])))
                continue
            below = self.children[node]
            below = below[np.abs(d - self.to_parent[below]) - self.radius[below] <= limit + slack]
            dist = _distances(self.pivots[below], q)
            computed += len(below)
            for c, x in zip(below.tolist(), dist.tolist(), strict=True):
                bound = max(0.0, x - self.radius[c])
                if bound <= limit + slack:
                    heapq.heappush(heap, (bound, c, x))
        return sorted(((s, -i) for s, i in best), key=lambda t: (-t[0], t[1])), computed


# ---- Spark side --------------------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, continued with zeros."""
    offsets = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    lens = np.diff(offsets)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), lens)
    out[row, np.arange(lens.sum()) - np.repeat(offsets[:-1] - offsets[0], lens)] = values[offsets[0] : offsets[-1]]
    return out


@dataclass(frozen=True)
class Visits:
    """What a search did: queries, trees, and (query, tree) pairs visited, of queries x trees."""

    queries: int
    trees: int
    visited: int


def candidates(vectors: DataFrame, k: int) -> DataFrame:
    """The rows that can be among the best k of some query: of equal vectors those of the k + 1
    smallest ids (one may be the query's), each at most k times."""
    times = vectors.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = times.withColumn("i", first).filter(F.col("i") <= k + 1)
    return kept.select("vec_id", "v", F.explode(F.sequence(F.lit(1), "n")).alias("i")).drop("i")


def pivots_of(vectors: DataFrame, rows: int, width: int, norm2: float) -> np.ndarray:
    """Different vectors, at most ``CELLS``, in the order of a hash."""
    want = min(CELLS, max(1, math.ceil(rows / TREE_ROWS)))
    # a few times ``CELLS`` rows at most
    first = vectors.select("v").orderBy(F.xxhash64("v"), "v").limit(4 * want).toArrow().column("v").combine_chunks()
    return lifted(np.unique(_matrix(first, width), axis=0)[:want], norm2)


def in_cells(vectors: DataFrame, pivots: np.ndarray, width: int, norm2: float) -> DataFrame:
    """vec_id, v, cell, away: each vector's nearest pivot and its distance, written."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                block = whole.slice(start, 2048)
                points = lifted(_matrix(block.column(1), width), norm2)
                cell, away = np.zeros(len(points), np.int32), np.full(len(points), np.inf)
                for c, pivot in enumerate(shared.value):
                    d = _distances(points, pivot)
                    cell, away = np.where(d < away, np.int32(c), cell), np.minimum(d, away)
                yield pa.RecordBatch.from_arrays([*block.columns[:2], pa.array(cell), pa.array(away)], names=["vec_id", "v", "cell", "away"])

    return land(vectors.select("vec_id", "v").mapInArrow(run, "vec_id bigint, v array<bigint>, cell int, away double"), "mtree-cells")


def build(placed: DataFrame, trees: int, width: int, norm2: float) -> DataFrame:
    """The nodes of all trees (rows tree, vec_id, v), written to the shared folder.

    A tree that the hash filled far beyond its share is built in parts of its own number.
    """

    def emit(tree: int, ids: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        nodes = load(lifted(v, norm2))
        leaf_only = lambda f: [f(n) if n["leaf"] else [] for n in nodes]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([tree] * len(nodes), pa.int64()),
                pa.array(range(len(nodes)), pa.int32()),
                pa.array([n["parent"] for n in nodes], pa.int32()),
                pa.array([n["leaf"] for n in nodes]),
                pa.array([n["radius"] for n in nodes]),
                pa.array([n["to_parent"] for n in nodes]),
                pa.array([n["pivot"] for n in nodes], pa.list_(pa.float64())),
                pa.array(leaf_only(lambda n: ids[n["rows"]]), pa.list_(pa.int64())),
                pa.array(leaf_only(lambda n: n["distances"]), pa.list_(pa.float64())),
                pa.array(leaf_only(lambda n: v[n["rows"]].ravel()), pa.list_(pa.int64())),
            ],
            names=[f.split()[0] for f in _NODES.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, held, size = None, 0, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                ids, v = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                yield emit(now | part << 40, ids, v)
                held.clear()

        for batch in batches:
            tree, ids, v = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), width)
            cuts = np.flatnonzero(np.concatenate(([True], tree[1:] != tree[:-1]))) if len(tree) else []
            for start, stop in zip(cuts, [*cuts[1:], len(tree)], strict=True):
                if now != int(tree[start]):
                    yield from close()
                    now, part, size = int(tree[start]), 0, 0
                for at in range(start, stop, TREE_ROWS):
                    end = min(at + TREE_ROWS, stop)
                    if held and size + end - at > 3 * TREE_ROWS:
                        yield from close()
                        part, size = part + 1, 0
                    held.append((ids[at:end], v[at:end]))
                    size += end - at
        yield from close()

    rows = placed.select("tree", "vec_id", "v").repartition(trees, "tree").sortWithinPartitions("tree", "vec_id")
    return land(rows.mapInArrow(run, _NODES), "mtree")


_HITS = "q bigint, query_id bigint, vec_id bigint, score bigint"


def searched(nodes: DataFrame, visits: DataFrame, width: int, norm2: float, k: int) -> DataFrame:
    """The best of each tree for each of its visitors (q, vec_id, v, tree, least), written.

    The visitors of a tree come in blocks, each with a copy of its nodes.
    """
    crowd = visits.groupBy("tree").agg(F.ceil(F.count("*") / F.lit(QUERY_BLOCK)).cast("int").alias("blocks"))
    crowd = land(crowd, "mtree-crowd")
    asked = visits.join(crowd, "tree").withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int"))
    copies = crowd.select(F.col("tree").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("copy"))
    trees = nodes.join(copies, F.col("tree") == F.col("of")).drop("of")

    def run(own: pa.Table, visitors: pa.Table) -> pa.Table:
        out = []
        if own.num_rows and visitors.num_rows:
            tree = Tree(own.to_pylist())
            vectors = _matrix(visitors.column("v").combine_chunks(), width)
            asks = zip(*(visitors.column(c).to_pylist() for c in ("q", "vec_id", "least")), vectors, strict=True)
            for q, query_id, least, v in asks:
                out += [(q, query_id, i, s) for s, i in tree.search(query_id, v, norm2, k, least)[0]]
        return pa.table([pa.array([o[c] for o in out], pa.int64()) for c in range(4)], names=[f.split()[0] for f in _HITS.split(", ")])

    both = trees.groupBy("tree", "copy").cogroup(asked.groupBy("tree", "block"))
    return land(both.applyInArrow(lambda a, b: run(a, b), _HITS), "mtree-hits")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, report: Callable[[Visits], None] | None = None) -> DataFrame:
    """query_id, rank, vec_id, score; both tables have vec_id and v (integers).

    ``report`` is told how many trees were visited.
    """
    # product of a vector with itself, in the type that holds any sum of squares
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(square).alias("norm2")).first()
    spark = vectors.sparkSession
    if not size["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width, norm2 = max(1, size["width"]), size["norm2"]
    if norm2 >= 2.0**62:
        raise ValueError("vectors are too long for scores of 64 bits")
    pivots = pivots_of(vectors, size["n"], width, norm2)
    cells = in_cells(candidates(vectors, k), pivots, width, norm2)
    # one row for each pivot
    facts = {r["cell"]: r for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()}
    parts = [math.ceil(facts[c]["n"] / TREE_ROWS) if c in facts else 0 for c in range(len(pivots))]
    radius = np.array([facts[c]["radius"] if c in facts else -np.inf for c in range(len(pivots))])
    first = np.concatenate(([0], np.cumsum(parts)))
    number = lambda values: F.get(F.array(*[F.lit(int(x)) for x in values]), F.col("cell"))
    placed = cells.withColumn("tree", (number(first[:-1]) + F.pmod(F.xxhash64("vec_id", "v"), number(parts))).cast("bigint"))
    nodes = build(placed, int(first[-1]), width, norm2)
    # a tree built in parts has several numbers
    built = nodes.filter("parent = -1").select("tree", (F.col("tree") % (1 << 40)).alias("base"))
    built = land(built, "mtree-roots")

    asked = land(queries.select("vec_id", "v").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
    shared = spark.sparkContext.broadcast((pivots, radius, first, np.array(parts)))

    def to_cells(batches: Iterator[pa.RecordBatch], again: bool) -> Iterator[pa.RecordBatch]:
        """The trees that each query visits: at first one of its nearest cell, then all others that its bound allows."""
        pivots, radius, first, parts = shared.value
        live = np.flatnonzero(parts)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                block = whole.slice(start, 256)
                v = _matrix(block.column(1), width).astype(float)
                points = np.column_stack((v, np.zeros(len(v))))
                away = np.stack([_distances(points, pivots[c]) for c in live], axis=1)
                near = live[away.argmin(1)]
                one = first[near] + block.column(2).to_numpy() % parts[near]
                if again:
                    least = block.column(3).to_numpy(zero_copy_only=False).astype(float)
                    base = (v**2).sum(1) + norm2
                    limit = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(0, base - 2 * least)))
                    open_ = away - radius[live] <= (limit + SLACK * np.sqrt(base) + 1e-9)[:, None]
                    row, which = np.nonzero(open_)
                    cell = live[which]
                    row, tree = np.repeat(row, parts[cell]), np.concatenate([np.arange(first[c], first[c] + parts[c]) for c in cell] or [np.zeros(0, int)])
                    other = tree != one[row]
                    row, tree = row[other], tree[other]
                else:
                    row, tree = np.arange(len(v)), one
                rows = block.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array(tree.astype(np.int64))], names=["vec_id", "v", "q", "least", "base"])

    visits = "vec_id bigint, v array<bigint>, q bigint, least bigint, base bigint"
    no_bound = asked.select("vec_id", "v", "q", F.lit(None).cast("bigint").alias("least"))
    near = no_bound.mapInArrow(lambda it: to_cells(it, False), visits)
    near = land(near.join(built, "base").drop("base"), "mtree-near")
    start = searched(nodes, near, width, norm2, k)
    ranked = start.withColumn("i", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")))
    bounds = ranked.filter(F.col("i") <= k).groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounds = bounds.filter(F.col("n") == k).select("q", "least")
    bounded = asked.join(bounds, "q", "left").select("vec_id", "v", "q", "least")
    others = bounded.mapInArrow(lambda it: to_cells(it, True), visits)
    others = land(others.join(built, "base").drop("base"), "mtree-others")
    rest = searched(nodes, others, width, norm2, k)
    if report is not None:
        report(Visits(asked.count(), built.count(), near.count() + others.count()))
    discard(cells, nodes, near, others)

    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    found = start.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def op3_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every fiftieth row of ``embeddings``."""
    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(QUERY_EVERY)) == 0))


def _sql() -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {K}"""


QUERIES = {"op3_mtree": op3_mtree}
ORACLE_SQL = {"op3_mtree": _sql()}

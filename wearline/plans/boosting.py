"""Boosted regression trees over binned rows: Spark ML's boosting, with one compact pass a tree level.

The trees are those of ``GBTRegressor`` and ``GBTClassifier`` (all rows and features, variance as
impurity): the same split candidates (up to 31 a feature, from all rows or, beyond 10,000 rows, a
sample of about that size, as there), the same pseudo-residuals, gains and leaves. What differs is how the
rows are held. Each feature is a bin of 5 bits, two of them one 16-bit code, and a row keeps its
current residual beside them, so a row of 6 features takes 14 bytes. Rows are persisted in blocks
(memory, then disk). A level of a tree is one job: numpy counts the rows and adds the residuals of
each (node, bin of one feature, bin of another), which gives two features by one count.

Residuals are whole multiples of a power of two that is so small that their sums are exact, so the
trees do not depend on how the rows are partitioned, but for the sample of the candidates.

The driver gets, from each task, the sums of at most ``NODES_AT_ONCE`` nodes, and at most 10,000 or
so sampled rows. Every ``CHECKPOINT_ROUNDS`` rounds the blocks are written to the shared folder.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.session import checkpoint_dir, shared_path, ship

BINS, BIN_BITS = 32, 5
CELLS = BINS * BINS
#: Rows from which split candidates are taken.
CANDIDATE_ROWS = 10_000
BLOCK_ROWS = 65_536
NODES_AT_ONCE = 64
PARTITION_BYTES, TASK_ROWS = 256_000_000, 50_000
CHECKPOINT_ROUNDS = 10
#: Tasks whose sums the driver adds up itself.
FEW_TASKS = 96
#: Residuals may grow to this many times their first bound before sums might round.
HEADROOM = 8

_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
_ENSEMBLE_ONLY = {"maxIter", "stepSize", "subsamplingRate", "validationTol", "featureSubsetStrategy", "lossType", "rawPredictionCol", "probabilityCol"}


def candidates(values: np.ndarray, expected: float, n_rows: int, bins: int) -> np.ndarray:
    """A feature's thresholds from its sampled values: between all distinct ones, or at even strides of
    rows. Zeros make up what is missing to the ``expected`` number of rows, as in Spark ML."""
    found, counts = np.unique(values[values != 0.0], return_counts=True)
    if not len(found):
        return np.zeros(0)
    counts = counts.astype(float)
    rest = expected - counts.sum()
    if rest > np.finfo(float).eps * n_rows * 100:
        at = int(np.searchsorted(found, 0.0))
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, rest)
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) <= bins - 1:
        return middles
    stride = expected / bins
    out, seen, target = [], counts[0], stride
    for i in range(1, len(found)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(middles[i - 1])
            target += stride
        # a sample larger than expected has more strides; a bin must fit its bits
        if len(out) == bins - 1:
            break
    return np.array(out)


def _blocks(thresholds: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (features, then the label) as blocks: the codes of each pair of features, and the labels."""
    k = len(thresholds)

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(batches)
        codes = np.zeros(((k + 1) // 2, t.num_rows), np.uint16)
        for c in range(k + 1):
            if t.column(c).null_count:
                raise ValueError("a feature or label to fit on is null")
            x = t.column(c).to_numpy()
            if not np.isfinite(x).all():
                raise ValueError("a feature or label to fit on is NaN or infinite")
            if c < k:
                codes[c // 2] |= np.searchsorted(thresholds[c], x).astype(np.uint16) << np.uint16(0 if c % 2 else BIN_BITS)
        columns = [pa.array([t.num_rows], pa.int32()), pa.array([codes.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["n", "codes", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK_ROWS - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == BLOCK_ROWS:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return run


# A level of a tree, for tasks: (place, feature, bin) of its nodes that split; rows in higher bins go right.
Level = list[tuple[int, int, int]]


def _places(codes: np.ndarray, levels: list[Level]) -> np.ndarray:
    """The place of every row in the level below ``levels``; a node that doesn't split has its rows on the left."""
    at = np.zeros(codes.shape[1], np.uint8 if len(levels) <= 8 else np.uint32)
    bins: dict[int, np.ndarray] = {}
    for level in levels:
        right = np.zeros(len(at), bool)
        for place, feature, last in level:
            if feature not in bins:
                pair = codes[feature // 2]
                bins[feature] = (pair & np.uint16(BINS - 1) if feature % 2 else pair >> np.uint16(BIN_BITS)).astype(np.uint8)
            right |= (bins[feature] > last) & (at == place) if place or len(level) > 1 else bins[feature] > last
        at += at
        at += right
    return at


def _first_state(scale: float, logistic: bool) -> Callable:
    """The first target is the label itself, for classes -1 and 1."""

    def of(row) -> tuple:
        codes = np.frombuffer(row.codes, np.uint16).reshape(-1, row.n)
        label = np.frombuffer(row.label)
        if not logistic:
            return codes, np.rint(label * scale), None, None
        if not np.isin(label, (0.0, 1.0)).all():
            raise ValueError("a classifier's labels are 0 and 1")
        label = 2.0 * label - 1.0
        return codes, label * scale, (label, np.zeros(row.n)), None

    return of


def _leaf_squares(codes: np.ndarray, q: np.ndarray, levels: list[Level]) -> tuple[np.ndarray, np.ndarray]:
    at = _places(codes, levels)
    return at, np.bincount(at, q * q, minlength=1 << len(levels))


def _next_state(levels: list[Level], leaves: np.ndarray, weight: float, first: bool, scale: float) -> Callable:
    """Blocks after a tree: the next targets, and the old ones' squares in each of its leaves."""

    def of(block: tuple) -> tuple:
        codes, q, classes, _ = block
        at, squares = _leaf_squares(codes, q, levels)
        if classes is None:
            # twice the error; q is that already but in the first round
            step = np.rint(leaves * (scale if first else 2.0 * weight * scale))
            return codes, (2.0 if first else 1.0) * (q - step[at]), None, squares
        label, margin = classes
        margin = margin + weight * leaves[at]
        return codes, np.rint(scale * 4.0 * label / (1.0 + np.exp(2.0 * label * margin))), (label, margin), squares

    return of


def _sums(levels: list[Level], active: list[int], n_pairs: int) -> Callable:
    """Rows and sums of the targets of each active node, for every pair of features; squares of the tree before."""
    n = len(active)
    slot_of = np.full(1 << len(levels), n, np.int64)
    slot_of[active] = np.arange(n)
    slot_of *= CELLS

    def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
        counts, sums = (np.zeros((n_pairs, n * CELLS), np.int64) for _ in range(2))
        before, index = 0.0, np.zeros(BLOCK_ROWS, np.int64)
        for codes, q, _, squares in blocks:
            before = before + squares if squares is not None else before
            start = slot_of[_places(codes, levels)] if levels else 0
            place = index[: len(q)]
            for p in range(n_pairs):
                np.add(codes[p], start, out=place)
                counts[p] += np.bincount(place, minlength=(n + 1) * CELLS)[: n * CELLS]
                sums[p] += np.bincount(place, q, minlength=(n + 1) * CELLS)[: n * CELLS].astype(np.int64)
        yield [_by_feature(x.reshape(n_pairs, n, BINS, BINS)) for x in (counts, sums)], before

    return run


def _by_feature(pairs: np.ndarray) -> np.ndarray:
    """(node, feature, bin) of (pair, node, bin, bin)."""
    return np.stack([pairs.sum(axis=3), pairs.sum(axis=2)], axis=1).reshape(-1, pairs.shape[1], BINS).transpose(1, 0, 2)


def _added(a: tuple, b: tuple) -> tuple:
    return [x + y for x, y in zip(a[0], b[0], strict=True)], a[1] + b[1]


def _total(parts: RDD) -> tuple:
    if parts.getNumPartitions() > FEW_TASKS:
        return parts.treeReduce(_added)
    found = parts.collect()
    out = found[0]
    for x in found[1:]:
        out = _added(out, x)
    return out


@dataclass
class _Node:
    level: int
    place: int
    rows: int
    total: int
    feature: int = -1
    last: int = -1
    gain: float = -1.0
    children: list[_Node] = field(default_factory=list)
    squares: float = 0.0

    @property
    def mean(self) -> float:
        return self.total / self.rows


def _split(node: _Node, counts: np.ndarray, sums: np.ndarray, n_splits: np.ndarray, unit: float) -> None:
    """Give the node its best split, if one has a gain: the first feature and bin of those with the most."""
    left, total = counts.cumsum(axis=1)[:, :-1], sums.cumsum(axis=1)[:, :-1]
    right = node.rows - left
    valid = (left > 0) & (right > 0) & (np.arange(BINS - 1) < n_splits[:, None])
    if not valid.any():
        return
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = total / left, (node.total - total) / right
        # the parent's variance less the children's, without the difference of large numbers
        gain = np.where(valid, (left / node.rows) * (right / node.rows) * (a - b) ** 2, -1.0)
    f, s = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[f, s] <= 1e-26 * (abs(a[f, s]) + abs(b[f, s])) ** 2:
        return
    node.feature, node.last, node.gain = int(f), int(s), float(gain[f, s]) / unit**2
    rows, part = int(left[f, s]), int(total[f, s])
    for side, n, t in ((0, rows, part), (1, node.rows - rows, node.total - part)):
        node.children.append(_Node(node.level + 1, 2 * node.place + side, n, t))


def _grow(blocks: RDD, n_splits: np.ndarray, depth: int, unit: float) -> tuple[_Node, list[Level], np.ndarray | float]:
    """A tree, level by level; and the squares that the blocks bring of the tree before."""
    n_feats, n_pairs = len(n_splits), (len(n_splits) + 1) // 2
    levels: list[Level] = []
    active = [_Node(0, 0, 0, 0)]
    root, before = active[0], 0.0
    for level in range(depth):
        below: list[_Node] = []
        for start in range(0, len(active), NODES_AT_ONCE):
            some = active[start : start + NODES_AT_ONCE]
            (counts, sums), squares = _total(blocks.mapPartitions(_sums(levels, [x.place for x in some], n_pairs)))
            if not level:
                before, root.rows, root.total = squares, int(counts[0, 0].sum()), int(sums[0, 0].sum())
            for i, node in enumerate(some):
                _split(node, counts[i, :n_feats], sums[i, :n_feats], n_splits, unit)
                below += node.children
        levels.append([(x.place, x.feature, x.last) for x in active if x.children])
        active = below
        if not active:
            levels.pop()
            break
    return root, levels, before


def _leaves(root: _Node, depth: int) -> list[tuple[int, _Node]]:
    """The leaves with their places in the lowest level."""
    if not root.children:
        return [(root.place << (depth - root.level), root)]
    return [x for c in root.children for x in _leaves(c, depth)]


def _leaf_means(root: _Node, depth: int, unit: float) -> np.ndarray:
    out = np.zeros(1 << depth)
    for place, leaf in _leaves(root, depth):
        out[place] = leaf.mean / unit
    return out


def _with_squares(root: _Node, depth: int, squares: np.ndarray) -> None:
    for place, leaf in _leaves(root, depth):
        leaf.squares = float(squares[place])

    def up(node: _Node) -> float:
        if node.children:
            node.squares = sum(up(c) for c in node.children)
        return node.squares

    up(root)


def _node_rows(tree: int, root: _Node, thresholds: list[np.ndarray], unit: float) -> list[tuple]:
    """The nodes as Spark ML saves them, parents first; a split into two equal predictions is none."""

    def pruned(node: _Node) -> None:
        for c in node.children:
            pruned(c)
        if node.children and not any(c.children for c in node.children) and len({c.mean for c in node.children}) == 1:
            node.children, node.gain = [], -1.0

    out: list = []

    def add(node: _Node) -> int:
        own, left, right = len(out), -1, -1
        out.append(None)
        if node.children:
            left, right = (add(c) for c in node.children)
        stats = [float(node.rows), node.total / unit, node.squares / unit**2, float(node.rows)]
        split = (node.feature, [float(thresholds[node.feature][node.last])], -1) if node.children else (-1, [], -1)
        impurity = max(0.0, stats[2] / node.rows - (stats[1] / node.rows) ** 2)
        out[own] = (tree, (own, node.mean / unit, impurity, stats[:3], node.rows, node.gain if node.children else -1.0, left, right, split))
        return own

    pruned(root)
    add(root)
    return out


def _save(spark: SparkSession, estimator, rows: list[tuple], weights: list[float], n_feats: int) -> str:
    """The trees in the format of Spark ML's models."""
    path, now = shared_path(spark, "boosted"), int(time.time() * 1000)
    kind = "classification.GBTClassificationModel" if isinstance(estimator, GBTClassifier) else "regression.GBTRegressionModel"
    own, usual = ({p.name: v for p, v in m.items()} for m in (estimator._paramMap, estimator._defaultParamMap))
    about = {"timestamp": now, "sparkVersion": spark.version}

    def one(frame: DataFrame, name: str) -> None:
        frame.coalesce(1).write.option("compression", "uncompressed").format("text" if name == "metadata" else "parquet").save(f"{path}/{name}")

    def tree() -> str:
        params = [{k: v for k, v in m.items() if k not in _ENSEMBLE_ONLY} for m in (own, usual)]
        name = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
        return json.dumps({"class": name, **about, "uid": f"dtr_{uuid.uuid4().hex[:12]}", "paramMap": params[0], "defaultParamMap": params[1]})

    whole = {"class": f"org.apache.spark.ml.{kind}", **about, "uid": estimator.uid, "paramMap": own, "defaultParamMap": usual}
    one(spark.createDataFrame([(json.dumps(whole | {"numFeatures": n_feats, "numTrees": len(weights)}),)], "value string"), "metadata")
    one(spark.createDataFrame(rows, _NODE), "data")
    one(spark.createDataFrame([(i, tree(), w) for i, w in enumerate(weights)], "_1 int, _2 string, _3 double"), "treesMetadata")
    return path


def _dropped(spark: SparkSession, rdd: RDD) -> None:
    """Free a state that no later job reads, and its checkpoint."""
    file = rdd.getCheckpointFile()
    rdd.unpersist()
    if file:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fit_trees(df: DataFrame, feats: Sequence[str], estimator) -> GBTRegressionModel | GBTClassificationModel:
    """The model that the estimator (all rows, all features, no validation column) stands for."""
    spark, feats, logistic = df.sparkSession, list(feats), isinstance(estimator, GBTClassifier)
    checkpoint_dir(spark)
    ship(spark)
    rounds, depth, step, seed = (estimator.getOrDefault(p) for p in ("maxIter", "maxDepth", "stepSize", "seed"))
    label = F.col(estimator.getLabelCol()).cast("double")
    rows = df.select(*[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(feats)], label.alias("_label"))
    n, least, most = rows.agg(F.count(F.lit(1)), F.min("_label"), F.max("_label")).first()
    if not n:
        raise ValueError("no rows to fit")
    if least is None:
        raise ValueError("a feature or label to fit on is null")

    share = min(1.0, CANDIDATE_ROWS / n)
    sampled = rows.drop("_label") if share == 1.0 else rows.drop("_label").sample(False, share, seed)
    # at most CANDIDATE_ROWS rows, or about as many sampled ones
    values = np.array([tuple(r) for r in sampled.collect()], float).reshape(-1, len(feats))
    thresholds = [candidates(values[:, i], share * n, n, min(BINS, n)) for i in range(len(feats))]
    n_splits = np.array([len(t) for t in thresholds])

    bound = 1.0 if logistic else max(abs(least), abs(most), 2.0 * (most - least))
    bound = max(4.0, bound) if logistic else HEADROOM * bound
    # sums of a block stay below 2**53 and all of them below 2**63
    bits = min(36, 62 - math.ceil(math.log2(n + 1))) - (math.ceil(math.log2(bound)) if 0 < bound < math.inf else 0)
    unit = 2.0**bits
    cut = rows.mapInArrow(_blocks(thresholds), "n int, codes binary, label binary").rdd
    # a task a core, for TASK_ROWS rows at least, but for no more than PARTITION_BYTES: each level pays for its tasks' start
    parts = min(spark.sparkContext.defaultParallelism, math.ceil(n / TASK_ROWS))
    parts = max(parts, math.ceil(n * (len(feats) + 9) / PARTITION_BYTES))
    cut = cut.coalesce(parts) if parts < cut.getNumPartitions() else cut
    blocks = cut.map(_first_state(unit, logistic)).persist(StorageLevel.MEMORY_AND_DISK)

    trees: list[tuple[_Node, list[Level]]] = []
    held: list[RDD] = [blocks]
    try:
        for t in range(rounds):
            if t:
                root, levels = trees[-1]
                change = _next_state(levels, _leaf_means(root, len(levels), unit), 1.0 if t == 1 else step, t == 1, unit)
                blocks = blocks.map(change, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(blocks)
                if t % CHECKPOINT_ROUNDS == 0:
                    blocks.checkpoint()
            root, levels, before = _grow(blocks, n_splits, depth, unit)
            if t:
                _with_squares(trees[-1][0], len(trees[-1][1]), before)
            trees.append((root, levels))
            # all partitions of the newest state are there; a checkpoint still serves lost ones
            written = next((i for i in reversed(range(len(held))) if held[i].getCheckpointFile()), 0)
            for old in held[:written]:
                _dropped(spark, old)
            for old in held[max(written, 1) : -1]:
                if not old.getCheckpointFile():
                    old.unpersist()
            held = held[written:]
        root, levels = trees[-1]
        squares = blocks.map(lambda b: _leaf_squares(b[0], b[1], levels)[1]).fold(0.0, lambda a, b: a + b)
        _with_squares(root, len(levels), squares)
    finally:
        for old in held:
            _dropped(spark, old)
    weights = [1.0] + [step] * (rounds - 1)
    saved = _save(spark, estimator, [r for i, (root, _) in enumerate(trees) for r in _node_rows(i, root, thresholds, unit)], weights, len(feats))
    return (GBTClassificationModel if logistic else GBTRegressionModel).load(saved)

"""Best-fit packing by bin completion.

1. Every text becomes token ids (one pass, Arrow batches); a document longer than a sequence is
   cut into pieces. Only the pieces' lengths and checksums are written, not the ids.
2. The histogram of lengths, at most ``capacity`` rows, is solved on the driver by bin completion:
   around the largest remaining piece the undominated fillings are enumerated by waste, a branch
   whose waste exceeds what would still beat the incumbent is cut, and best-fit solutions are the
   first incumbents. A filling is used as often as its pieces allow, so the solution is a few
   thousand patterns at any number of documents. Where the search's ``Budget`` ends it above the
   lower bound, parts of the solution are searched anew. The ``Plan`` tells the lower bound and
   whether the budget ended it.
3. Pieces of one length are numbered (counts per task and length, then running sums) and take
   the slots of the patterns by their number.

Results for special rows: a null or empty text is a document of the end id alone; repeated rows
and repeated ids are packed once per row; a null id is kept; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import logging
import random
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import blocks, land, table, text_bytes
from wearline.llm.tokens import byte_bpe

CAPACITY = 1024
END_ID = 2
#: Patterns of either kind that one repair takes, at most.
_PART = 60
_LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Budget:
    """Where the search ends if it has not reached the lower bound or tried everything before:
    branches in all, for each branch the fillings around its piece and the steps to list them, and
    how often a part of the solution is searched anew without saving a sequence."""

    nodes: int = 2500
    fillings: int = 6
    steps: int = 4000
    repairs: int = 60


@dataclass(frozen=True)
class Plan:
    """Patterns of a packing; ``ended`` tells why the search did: ``bound`` (as few sequences as the
    lower bound, so no packing has fewer), ``complete`` (all undominated fillings tried) or ``budget``
    (a limit was met, so ``sequences - bound`` is the most that a longer search could save)."""

    patterns: list
    sequences: int
    bound: int
    branches: int
    ended: str


# ---- solver over the histogram of lengths ------------------------------------------------------

Pattern = tuple[int, tuple[int, ...]]  # how often, and the lengths from the front of a sequence


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Total length, and for each threshold the pieces too large to share a sequence."""
    total = sum(k * n for k, n in counts.items())
    best = -(-total // capacity)
    for small in sorted({0, *(k for k in counts if 2 * k <= capacity)}):
        alone = sum(n for k, n in counts.items() if k > capacity - small)
        halves = {k: n for k, n in counts.items() if capacity - small >= k and 2 * k > capacity}
        rest = sum(k * n for k, n in counts.items() if small <= k and 2 * k <= capacity)
        room = sum((capacity - k) * n for k, n in halves.items())
        best = max(best, alone + sum(halves.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def _times(items: tuple[int, ...], counts: dict[int, int]) -> int:
    return min(counts[k] // items.count(k) for k in set(items))


def _take(counts: dict[int, int], items: tuple[int, ...], times: int) -> dict[int, int]:
    left = dict(counts)
    for k in items:
        left[k] -= times
        if not left[k]:
            del left[k]
    return left


def _greedy(counts: dict[int, int], capacity: int) -> tuple[int, ...]:
    items, room = [], capacity
    for k in sorted(counts, reverse=True):
        fit = min(counts[k], room // k)
        items += [k] * fit
        room -= k * fit
    return tuple(items)


def first_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Each sequence takes the largest piece that fits, again and again."""
    left, out = dict(counts), []
    while left:
        items = _greedy(left, capacity)
        times = _times(items, left)
        out.append((times, items))
        left = _take(left, items, times)
    return out


def _dominated(filling: tuple[int, ...], waste: int, lengths: list[int], counts: dict[int, int]) -> bool:
    """A free longer piece could stand for one piece, or for two, without more room."""
    used = {y: filling.count(y) for y in set(filling)}
    pairs = {a + b for a in used for b in used if a < b} | {2 * a for a, n in used.items() if n > 1}
    better = {y + i for y in used for i in range(1, waste + 1)} | {p + i for p in pairs for i in range(waste + 1)}
    return any(x in better and counts[x] > used.get(x, 0) for x in lengths)


def fillings(counts: dict[int, int], room: int, slack: int, budget: Budget = Budget()) -> tuple[list[tuple[int, ...]], bool]:
    """Undominated sets of pieces for ``room`` that waste at most ``slack``, least waste first, and
    whether the budget ended the list."""
    lengths = sorted((k for k in counts if k <= room), reverse=True)
    if not lengths or room <= 0:
        return ([()] if room <= slack else []), False
    # reach[i]: the sums that lengths[i:] can make, as bits
    reach, full = [1] * (len(lengths) + 1), (1 << (room + 1)) - 1
    for i in range(len(lengths) - 1, -1, -1):
        bits, k, n = reach[i + 1], lengths[i], counts[lengths[i]]
        step = 1
        n = min(n, room // k)
        while n:
            take = min(step, n)
            bits |= bits << (k * take) & full
            n -= take
            step *= 2
        reach[i] = bits
    found, steps = [], 0

    def walk(waste: int) -> None:
        """Fillings that waste exactly ``waste``, those of longer pieces first."""
        nonlocal steps
        stack: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(0, room, ())]
        while stack and len(found) < budget.fillings and steps < budget.steps:
            i, left, chosen = stack.pop()
            if left == waste:
                found.append(tuple(k for k, n in chosen for _ in range(n)))
                continue
            steps += 1
            if i == len(lengths) or not reach[i] >> (left - waste) & 1:
                continue
            k = lengths[i]
            for n in range(min(counts[k], (left - waste) // k) + 1):
                stack.append((i + 1, left - k * n, (*chosen, (k, n)) if n else chosen))

    for waste in range(min(slack, room) + 1):
        if reach[0] >> (room - waste) & 1:
            before = len(found)
            walk(waste)
            found[before:] = [f for f in found[before:] if not _dominated(f, waste, lengths, counts)] or found[before : before + 1]
        if len(found) >= budget.fillings or steps >= budget.steps:
            return found[: budget.fillings], True
    return found, False


def _options(counts: dict[int, int], capacity: int, slack: int, budget: Budget) -> tuple[Iterator[tuple[int, ...]], bool]:
    """Sets around the largest piece, best first, and whether the budget left some out: one piece
    that fits exactly dominates all others."""
    largest = max(counts)
    rest = _take(counts, (largest,), 1)
    room = capacity - largest
    if room in rest:
        return iter([(largest, room)]), False
    found, short = fillings(rest, room, slack, budget)
    return iter([(largest, *f) for f in found]), short


def repaired(plan: Plan, capacity: int, budget: Budget) -> Plan:
    """The plan after bin completion of parts of it: some of the most wasteful sequences and of the
    others give up their pieces, which are packed anew; what takes no more sequences stands.

    A depth-first search seldom comes back to its first fillings; this mends what they spoiled.
    """
    rnd, patterns, sequences = random.Random(17), dict[tuple[int, ...], int](), plan.sequences
    for times, items in plan.patterns:
        patterns[items] = patterns.get(items, 0) + times
    inner = replace(budget, nodes=20, steps=min(budget.steps, 1000), repairs=0)
    idle = 0
    while idle < budget.repairs and sequences > plan.bound:
        idle += 1
        by_waste = sorted(patterns, key=lambda items: (sum(items), items))
        wasteful = [i for i in by_waste[:_PART] if sum(i) < capacity]
        if not wasteful:
            break
        others = by_waste[len(wasteful) :]
        chosen = wasteful[: rnd.randint(1, len(wasteful))] + rnd.sample(others, min(len(others), rnd.randint(5, _PART)))
        taken, part = {}, {}
        for items in chosen:
            taken[items] = rnd.randint(1, min(patterns[items], 3))
            for k in items:
                part[k] = part.get(k, 0) + taken[items]
        found = solve(part, capacity, inner)
        if found.sequences > sum(taken.values()):
            continue
        if found.sequences < sum(taken.values()):
            sequences, idle = sequences + found.sequences - sum(taken.values()), 0
        for items, n in taken.items():
            patterns[items] -= n
            if not patterns[items]:
                del patterns[items]
        for n, items in found.patterns:
            patterns[items] = patterns.get(items, 0) + n
    ended = "bound" if sequences == plan.bound else plan.ended
    return replace(plan, patterns=[(n, items) for items, n in patterns.items()], sequences=sequences, ended=ended)


def solve(counts: dict[int, int], capacity: int = CAPACITY, budget: Budget = Budget()) -> Plan:
    """Patterns that hold every piece, in as few sequences as the search finds."""
    counts = {k: n for k, n in counts.items() if n}
    if not counts:
        return Plan([], 0, 0, 0, "bound")
    size = lambda patterns: sum(n for n, _ in patterns)
    total = sum(k * n for k, n in counts.items())
    least = lower_bound(counts, capacity)
    best = first_fit(counts, capacity)
    # incumbent: complete each largest piece with the least waste, whatever it adds up to
    left, least_waste = counts, []
    while left:
        # the enumeration may end, by its steps, before its first filling
        items = next(_options(left, capacity, capacity, budget)[0], None) or _greedy(left, capacity)
        times = _times(items, left)
        least_waste.append((times, items))
        left = _take(left, items, times)
    if size(least_waste) < size(best):
        best = least_waste
    # depth first: (what is left, patterns so far, waste so far, options not yet tried)
    stack, branches, short = [(counts, (), 0, None)], 0, False
    while stack and branches < budget.nodes and size(best) > least:
        left, chain, waste, options = stack.pop()
        slack = (size(best) - 1) * capacity - total - waste
        if slack < 0:
            continue
        if not left:
            found = []
            while chain:
                found.append(chain[0])
                chain = chain[1]
            best = found[::-1]
            continue
        if options is None:
            branches += 1
            options, cut_off = _options(left, capacity, slack, budget)
            short |= cut_off
        items = next(options, None)
        if items is None:
            continue
        stack.append((left, chain, waste, options))
        times = _times(items, left)
        # the waste bound also limits how often a wasteful filling can be used
        lost = (capacity - sum(items)) * times
        # taken as often as its pieces allow: other shares of a filling are not tried
        short |= times > 1
        stack.append((_take(left, items, times), ((times, items), chain), waste + lost, None))
    ended = "bound" if size(best) == least else "budget" if stack or short else "complete"
    plan = Plan(best, size(best), least, branches, ended)
    return repaired(plan, capacity, budget) if ended == "budget" and budget.repairs else plan


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length the numbers of its pieces, as intervals: where they go."""
    rows, used, sequence = [], {}, 0
    for times, items in patterns:
        offset = 0
        for k in items:
            rows.append((k, used.get(k, 0), sequence, offset))
            used[k] = used.get(k, 0) + times
            offset += k
        sequence += times
    rows.sort()
    names = ("length", "first", "sequence", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


# ---- Spark side --------------------------------------------------------------------------------

_PIECES = "doc_id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter."""
    head = total % capacity
    out = [(0, head)] if head else []
    return out + [(s, capacity) for s in range(head, total, capacity)]


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents, numbered per task and length."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        bpe = byte_bpe()
        for block in blocks(batches):
            ids, ends = bpe.encode(*text_bytes(block.column(1)))
            row, piece, start, length, crc, number = [], [], [], [], [], []
            for r in range(block.num_rows):
                own = np.append(ids[ends[r] : ends[r + 1]], np.uint32(end_id)).astype("<u4").tobytes()
                for p, (s, n) in enumerate(cut(len(own) // 4, capacity)):
                    row.append(r)
                    piece.append(p)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(own[4 * s : 4 * (s + n)]))
                    number.append(seen[n])
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array([part] * len(row), pa.int32()),
                    pa.array(number, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _PIECES.format(id=id_type))


def pack(docs: DataFrame, capacity: int = CAPACITY, budget: Budget = Budget(), report: Callable[[Plan], None] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    ``report`` gets the plan: sequences, lower bound and why the search ended, which is logged too.
    """
    pieces = land(pieces_of(docs, capacity), "pieces")
    per_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # one row for each length: at most ``capacity``
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = solve(counts, capacity, budget)
    _LOG.info("%d sequences, lower bound %d, %d branches, ended by %s", plan.sequences, plan.bound, plan.branches, plan.ended)
    if report is not None:
        report(plan)
    where = slots(plan.patterns)
    step = np.int64(1) << np.int64(48)
    keys = where["length"] * step + where["first"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(keys, length * step + number, "right") - 1
            sequence = where["sequence"][at] + number - where["first"][at]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence, pa.int64()), pa.array(where["offset"][at], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = pieces.join(first, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("first")).alias("number")
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(
        place, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


def op10_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op10_bin_completion": op10_bin_completion}
ORACLE_SQL: dict[str, str] = {}

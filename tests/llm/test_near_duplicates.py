import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import docs, rows, same_as_sql, write
from wearline.llm import bagmin, near_duplicates
from wearline.llm.common import text_bytes
from wearline.llm.components import components

WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu") for b in ("l", "m", "n", "r", "s", "t")]


def _text(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def _edit(rnd, text, n):
    w = text.split()
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"edit{rnd.random()}"
    return " ".join(w)


def _family(seed, n=60):
    rnd = random.Random(seed)
    base = _text(rnd, 80)
    return [_edit(rnd, base, rnd.randint(0, 6)) for _ in range(n)] + [_text(rnd, rnd.randint(1, 60)) for _ in range(30)]


TABLE = docs(
    None, "", "  ", "!!!", "!!!", "one two", "ONE two", "one two three four five", "One, two; three four five!", "one two three four six",
    *["ha " * 50, "ha " * 52, "ha " * 80], *_family(1), *_family(2, 25), *_family(1)[:8], "w1 w2 w3 w4 w5 " * 4000, "w1 w2 w3 w4 w5 " * 4010,
)
TABLE = [(r[0] if i % 17 else None, *r[1:]) for i, r in enumerate(TABLE)] + TABLE[5:8]


def test_classes_equal_the_exact_join(spark, scratch):
    same_as_sql(spark, write(scratch, documents=[r for r in TABLE if r[0] is not None]), near_duplicates, "op2_near_duplicates")


def _exact_classes(table):
    """Components over all pairs of different texts."""
    texts = sorted({r[1] or "" for r in table})
    bag = [collections.Counter(zip(*bagmin.shingles(*text_bytes(pa.array([t]))))) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = sum((bag[i] & bag[j]).values())
            if both and both >= 0.8 * (sum(bag[i].values()) + sum(bag[j].values()) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    ids = collections.defaultdict(set)
    for r in table:
        ids[label[texts.index(r[1] or "")]].add(r[0])
    return {t: ids[label[i]] for i, t in enumerate(texts)}


def test_null_ids_and_kept_rows(spark, scratch):
    d = spark.read.parquet(f"{write(scratch, documents=TABLE)}/documents.parquet")
    classes = _exact_classes(TABLE)
    name = lambda ids: min((i for i in ids if i is not None), default=None)
    expected = sorted(((r[0], name(classes[r[1] or ""])) for r in TABLE), key=repr)
    assert sorted((tuple(r) for r in near_duplicates.classes(d).collect()), key=repr) == expected
    kept = near_duplicates.keep_one(d)
    assert kept.columns == d.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(name(c)) for c in {id(v): v for v in classes.values()}.values())


def test_kept_rows_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "i", 7, "x"), (2, "a b c d e f", "j", 8, "y"), (3, "else", "k", 9, "z")], "doc_id int, text string, id string, n int, digest string")
    assert rows(near_duplicates.keep_one(df), *df.columns) == [(1.0, "a b c d e f", "i", 7.0, "x"), (3.0, "else", "k", 9.0, "z")]


def test_small_tiles_find_the_same(spark, scratch):
    d = spark.read.parquet(f"{write(scratch, documents=docs(*_family(3)))}/documents.parquet")
    signed = near_duplicates.signed(d)
    one = near_duplicates.text_components(d, signed)
    cut = near_duplicates.text_components(d, signed, block_bytes=3000)
    assert rows(one, "node", "component") == rows(cut, "node", "component")


def test_empty_table(spark, scratch):
    folder = write(scratch, documents=[])
    assert near_duplicates.op2_near_duplicates(spark, folder).count() == 0
    assert near_duplicates.keep_one(spark.read.parquet(f"{folder}/documents.parquet")).count() == 0


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(40):
        weights = rng.integers(0, 9, (2, 60))
        weights[:, 0] = 1
        row, place = np.nonzero(weights)
        shingle = place.astype(np.uint64) * np.uint64(977) + np.uint64(rng.integers(1 << 40))
        sig = bagmin.signatures(shingle, row, weights[row, place], 2, 512)
        exact = np.minimum(*weights).sum() / np.maximum(*weights).sum()
        errors.append((sig[0] == sig[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.035


def test_signatures_do_not_depend_on_the_block():
    rng = np.random.default_rng(4)
    sizes = [10, 20, 40, 200]
    row = np.repeat(np.arange(len(sizes)), sizes)
    shingle, weight = rng.integers(0, 2**63, len(row)).astype(np.uint64), rng.integers(1, 4, len(row))
    alone = bagmin.signatures(shingle, row, weight, len(sizes))
    for others in (300, 3_000, 40_000):
        more = rng.integers(0, 2**63, others).astype(np.uint64)
        of = len(sizes) + np.arange(others) // 100
        rows_ = int(of[-1]) + 1
        block = bagmin.signatures(np.append(shingle, more), np.append(row, of), np.append(weight, np.ones(others, int)), rows_)
        assert np.array_equal(block[: len(sizes)], alone)


def test_similarity_counts_repeats():
    a, b = text_bytes(pa.array(["a b c d e a b c d e", "x y"])), text_bytes(pa.array(["a b c d e", "x y"]))
    assert bagmin.similarities(*a, *b).tolist() == [pytest.approx(1 / 6), 1.0]


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 500)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(50)]
    label = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: c for n, c in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0

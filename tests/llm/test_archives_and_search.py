import hashlib
import io
import os
import random

import numpy as np
import pytest

from tests.llm.helpers import rows, same_as_sql, write
from wearline.llm import mtree, warc
from wearline.llm.common import ship

BIG = "<html>é" + "payload " * 200 + "</html>"
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/3", None), (4, None, ""), (5, "http://a/5", "small"), (6, "http://a/6", "small"),
    (7, "http://b/ü", "x" * 1000), (8, "http://b/8", "x" * 1000), (9, "http://b/9", "x" * 999), (10, "u", "y" * 300_000 + "\r\n\r\nWARC/1.1"), (11, "u", BIG),
]


def test_round_trip_equals_the_sql(spark, scratch):
    got = same_as_sql(spark, write(scratch, pages=PAGES), warc, "op1_warc")
    assert {r.page_id: r.refers_to for r in got.collect() if r.record_type == "revisit"} == {1: 11, 2: 11, 7: 8}


def test_null_and_repeated_ids(spark, scratch):
    table = [(None, "u", BIG), (None, "v", BIG), (5, "w", BIG), (5, "w", BIG), (None, "x", "z" * 2000), (None, "y", "z" * 2000)]
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.op1_warc(spark, write(scratch, pages=table)).collect()), key=repr)
    assert got == [(5, "response", None)] * 2 + [(None, "response", None)] * 2 + [(None, "revisit", 5)] * 2


def test_empty_table_gives_no_archive(spark, scratch):
    assert warc.op1_warc(spark, write(scratch, pages=[])).count() == 0


def _files(folder):
    return {f: hashlib.sha1(open(f"{folder}/{f}", "rb").read()).hexdigest() for f in os.listdir(folder) if f.endswith(".warc.gz")}


def test_archives_are_deterministic_rolled_and_committed(spark, scratch):
    ship(spark)
    rnd = random.Random(1)
    table = [(rnd.randrange(10**6), f"http://h/{i}", "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(4000)))) for i in range(300)]
    table += [(77, f"http://hot/{i}", "".join(rnd.choice("abcdefgh") for _ in range(3000))) for i in range(60)]
    pages = spark.read.parquet(f"{write(scratch, pages=table)}/pages.parquet")
    found = []
    for name, parts in (("one", 2), ("two", 5)):
        folder = f"{scratch}/{name}"
        manifest = warc.write_archives(pages.repartition(parts), folder, shard_bytes=60_000, roll_bytes=15_000)
        files = _files(folder)
        assert {r.name: r.sha1 for r in manifest.collect()} == files and sum(r.records for r in manifest.collect()) == len(table)
        back = warc.read_archives(manifest, folder)
        assert sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in back.collect()) == sorted(table)
        found.append(files)
    assert found[0] == found[1] and len(found[0]) > 20
    # ids lie in ranges of shards: those of one shard never interleave with another's, but for the split id
    assert max(os.path.getsize(f"{scratch}/one/{f}") for f in found[0]) < 15_000 + 5000


def test_damage_is_noticed():
    record = warc.page_record(1, "u", 5, hashlib.sha1(b"hello").hexdigest(), b"hello", None)
    assert warc.parse(record)[0]["X-Page-Id"] == "1"
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"hello", b"jello"))
    member = warc.gzip_member(record)
    assert list(warc.members(io.BytesIO(member * 3), chunk=7)) == [record] * 3
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(member[:-20])))


def test_search_equals_the_sql_on_ties_and_odd_rows(spark, scratch):
    rng = np.random.default_rng(0)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.05, 4)], 0) for i in range(300)]
    vectors += [(300 + i, [0.5, 0.5, -0.5, 0.25], 0) for i in range(220)]
    vectors += [(1000, None, 0), (1001, [1.0, None, 0.0, 0.0], 0), (1002, [float("nan")] * 4, 0), (1050, [float("inf")] * 4, 0), (None, [1.0] * 4, 0)]
    same_as_sql(spark, write(scratch, embeddings=vectors), mtree, "op3_mtree")


def _brute(vectors, queries, k):
    out = []
    for q, v in queries:
        s = sorted((-int(np.dot(v, w)), i) for i, w in vectors if i != q)[:k]
        out += [(q, r + 1, i, -m) for r, (m, i) in enumerate(s)]
    return sorted((tuple(map(float, r)) for r in out), key=repr)


def test_blocks_of_queries_and_small_trees(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (6, 8))
    vectors = [(i, (centres[i % 6] + rng.integers(-9, 9, 8))) for i in range(600)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors], "vec_id bigint, v array<bigint>")
    monkeypatch.setattr(mtree, "TREE_ROWS", 50)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 3)
    visits = []
    got = mtree.top_k(df, df.filter("vec_id % 20 = 0"), 3, visits.append)
    assert visits[0].queries == 30 and visits[0].trees >= 12 and visits[0].visited < 30 * visits[0].trees / 2
    assert rows(got, "query_id", "rank", "vec_id", "score") == _brute(vectors, [x for x in vectors if x[0] % 20 == 0], 3)


def test_equal_vectors_and_repeated_rows(spark, monkeypatch):
    """A vector that fills most of the table, repeated ids, repeated rows: as without any reduction."""
    rng = np.random.default_rng(5)
    vectors = [(i, np.array([9, 9, 1])) for i in range(200)] + [(7, np.array([9, 9, 1]))] * 9 + [(i, rng.integers(-9, 12, 3)) for i in range(300, 360)] * 2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors], "vec_id bigint, v array<bigint>")
    assert mtree.candidates(df, 3).count() < 200
    monkeypatch.setattr(mtree, "TREE_ROWS", 20)
    queries = [(0, vectors[0][1]), (7, vectors[0][1]), (310, vectors[219][1])]
    q = spark.createDataFrame([(i, v.tolist()) for i, v in queries], "vec_id bigint, v array<bigint>")
    assert rows(mtree.top_k(df, q, 3), "query_id", "rank", "vec_id", "score") == _brute(vectors, queries, 3)


def test_too_long_vectors_raise(spark):
    df = spark.createDataFrame([(1, [2**31, 2**31])], "vec_id bigint, v array<bigint>")
    with pytest.raises(ValueError, match="64 bits"):
        mtree.top_k(df, df)


def test_fewer_candidates_than_k_and_shorter_vectors(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3]), (2, [5, -1])], "vec_id bigint, v array<bigint>")
    got = mtree.top_k(df, df.filter("vec_id = 0"), 5)
    assert rows(got, "query_id", "rank", "vec_id", "score") == [(0.0, 1.0, 1.0, 3.0), (0.0, 2.0, 2.0, 3.0)]
    assert mtree.top_k(df.limit(0), df, 5).count() == 0


def test_bounds_save_distances():
    rng = np.random.default_rng(2)
    v = (rng.integers(-300, 300, (40, 6))[rng.integers(0, 40, 4000)] + rng.integers(-4, 4, (4000, 6))).astype(np.int64)
    norm2 = float((v.astype(float) ** 2).sum(1).max())
    nodes = mtree.load(mtree.lifted(v, norm2))
    for i, n in enumerate(nodes):
        n |= {"node": i, "ids": n["rows"] if n["leaf"] else [], "vectors": v[n["rows"]] if n["leaf"] else []}
        assert (n["distances"] <= n["radius"] + 1e-9).all()
    tree, computed = mtree.Tree(nodes), []
    for q in range(0, 4000, 200):
        got, work = tree.search(q, v[q], norm2, 5)
        s = v @ v[q]
        order = np.lexsort((np.arange(4000), -s))
        assert got == [(int(s[i]), int(i)) for i in order if i != q][:5]
        computed.append(work)
    assert np.mean(computed) < 0.5 * 4000

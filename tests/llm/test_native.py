"""License scan and decontamination against their SQL, on the cases that tables can hold."""

import itertools
import math
import random

import pytest

from tests.llm.helpers import docs, rows, same_as_sql, write
from wearline.llm import decontaminate, licenses

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"


def _swap(text, every):
    return " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(text.split()))


DOCS = docs(
    None, "", "   ", "The MIT License. mit license", "under the GNU General Public License, version 3",
    "This work is licensed under the GNU General Public License, version 3.", "license mit apache", "APACHE LICENSE apache license",
    "Licensed under the Apache License, Version 2.0.", "mit License\nmit\tlicense ÉÀ", "word " * 30_000 + "mit license", "Licensed under CC BY-NC 4.0.",
    f"start {ITEM} end", _swap(ITEM, 4), _swap(ITEM, 3), _swap(ITEM, 2), " ".join(ITEM.split()[:8]), ITEM.upper(), "one two three", "w " * 20_000 + ITEM,
    ids=[0, 1, 1, None, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 17, 19],
)
BENCH = [(1, ITEM), (2, None), (3, ""), (4, "one two three"), (1, ITEM), (5, "ÉCOLE"), (None, "mit license mit")]


def test_license_scan_equals_its_sql(spark, scratch):
    got = same_as_sql(spark, write(scratch, documents=DOCS + DOCS[3:5]), licenses, "op9_license_scan")
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[10].first_word == 30_000 and by_id[5].labels == "gpl,gpl-3.0" and by_id[6].n_base == 0 and by_id[7].n_base == 2


def test_licence_texts_are_found_whole_and_changed(spark, scratch):
    texts = {k: words for k, (words, _) in licenses.TEXTS.items()}
    table = docs(*[f"Copyright 2020 Somebody\n\n{w.upper()}." for w in texts.values()], ids=list(range(len(texts))))
    mit = texts["mit-text"].split()
    table += docs(" ".join("other" if i % 20 == 15 else w for i, w in enumerate(mit)), " ".join(mit[:60]), " ".join(mit[30:]), ids=[50, 51, 52])
    got = {r.doc_id: r for r in same_as_sql(spark, write(scratch, documents=table), licenses, "op9_license_scan").collect()}
    for i, label in enumerate(texts):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    assert "bsd-2-clause-text" in got[list(texts).index("bsd-3-clause-text")].labels and got[list(texts).index("bsd-2-clause-text")].labels == "bsd-2-clause-text"
    assert got[50].labels == "mit-text" and 0.9 < got[50].score < 1.0 and got[51].labels == "mit-text" and got[51].score < 0.5 and got[52].labels == ""


def test_license_scan_of_an_empty_table(spark, scratch):
    assert same_as_sql(spark, write(scratch, documents=[]), licenses, "op9_license_scan").count() == 0


def test_leaks_equal_their_sql(spark, scratch):
    got = same_as_sql(spark, write(scratch, documents=DOCS, benchmark=BENCH), decontaminate, "op8_decontaminate")
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    # substitutions of every fourth and third word are tolerated, of every second not; half an item is no leak
    assert {(12, 1), (13, 1), (14, 1), (17, 1), (19, 1), (17, 4)} <= found and not {(15, 1), (16, 1)} & found


@pytest.mark.parametrize("tables", [{"documents": [], "benchmark": BENCH}, {"documents": DOCS, "benchmark": []}])
def test_leaks_of_empty_tables(spark, scratch, tables):
    assert decontaminate.op8_decontaminate(spark, write(scratch, **tables)).count() == 0


def test_a_benchmark_in_blocks_gives_the_same_links(spark, scratch):
    folder = write(scratch, documents=DOCS, benchmark=BENCH)
    d, b = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    whole, cut = decontaminate.links(d, b), decontaminate.links(d, b, seed_block=5)
    assert rows(whole, *whole.columns) == rows(cut, *cut.columns)


def test_items_of_equal_tokens_are_sought_once_and_long_items_in_words(spark, scratch):
    long = " ".join(f"t{i}" for i in range(150))
    bench = [(i, ITEM) for i in range(50)] + [(None, ITEM.upper()), (90, long), (91, " ".join(long.split()[:64])), (91, ITEM)]
    table = docs(f"start {ITEM} end", f"so {_swap(long, 4)} on", long, " ".join(long.split()[100:]), ids=[1, 2, 3, 4])
    got = same_as_sql(spark, write(scratch, documents=table, benchmark=bench), decontaminate, "op8_decontaminate")
    found = {(r.doc_id, r.item_id): r.matched for r in got.collect()}
    assert len(found) == 52 + 4 and found[2, 90] == 113 and found[3, 90] == 150 and found[2, 91] == 48
    d, b = spark.createDataFrame([(1, ITEM)], "doc_id int, text string"), spark.createDataFrame(bench, "item_id int, text string")
    hits, ids = decontaminate._matches(d, b, 0.6, 10**6)
    # one text in two stretches, whatever the number of its ids
    assert hits.count() == 2 and ids.count() == 54


def test_blocks_of_seeds_are_broadcast_one_after_the_other_and_hits_grouped_without_a_sort(spark):
    d, b = spark.createDataFrame([(1, ITEM)], "doc_id int, text string"), spark.createDataFrame(BENCH, "item_id int, text string")
    plans = [decontaminate._matches(d, b, 0.6, n)[0]._jdf.queryExecution().executedPlan().toString() for n in (5, 10**6)]
    assert "BroadcastExchange" not in plans[0] and "BroadcastExchange" in plans[1] and "SortAggregate" not in plans[1]


@pytest.mark.parametrize("few", [decontaminate.FEW_LEAKS, 0])
def test_clean_documents_stay_with_all_columns(spark, scratch, few):
    # a leaking row without an id goes, a clean row that shares a leaking row's id stays
    table = DOCS + [(None, f"x {ITEM} y", "en", "s", 1), (12, "a clean row", "en", "s", 2)]
    folder = write(scratch, documents=table, benchmark=BENCH[:2])
    d, b = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    kept = decontaminate.keep_clean(d, b, few)
    assert kept.columns == d.columns and kept.dtypes == d.dtypes
    leaking = {f"start {ITEM} end", _swap(ITEM, 4), _swap(ITEM, 3), ITEM.upper(), "w " * 20_000 + ITEM, f"x {ITEM} y"}
    assert sorted((repr(r.doc_id), repr(r.text)) for r in kept.collect()) == sorted((repr(r[0]), repr(r[1])) for r in table if r[1] not in leaking)


def test_removal_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, ITEM, "a", 2), (2, "clean", "b", 3)], "doc_id int, text string, d1 string, salt int")
    items = spark.createDataFrame([(1, ITEM)], "item_id int, text string")
    for few in (10, 0):
        assert [tuple(r) for r in decontaminate.keep_clean(df, items, few).collect()] == [(2, "clean", "b", 3)]


@pytest.mark.parametrize("n", [4, 8, 10, 12, 16, 20, 30, 38])
def test_masks_hit_items_at_the_threshold(n):
    """Ways to change as many of n tokens as a link allows, and the share of them that a mask hits."""
    masks = decontaminate.MASKS if n >= decontaminate.LONG_ITEM else decontaminate.SHORT_MASKS
    picks = [(len(m), [i for i, b in enumerate(m) if b == "1"]) for m in masks]
    changed = n - math.ceil(decontaminate.COVERAGE * n)
    if math.comb(n, changed) < 5000:
        ways = list(itertools.combinations(range(n), changed))
    else:
        ways = [random.Random(i).sample(range(n), changed) for i in range(2000)]
    hit = 0
    for way in ways:
        same = [i not in way for i in range(n)]
        hit += any(all(same[s + i] for i in pick) for size, pick in picks for s in range(n - size + 1))
    assert hit / len(ways) >= 0.9


def test_links_at_the_threshold_are_found(spark):
    """Items with 40 % of their tokens changed, and with a word put in, against a plain alignment."""
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows_, items, expected = [], [], set()
    for i in range(200):
        n = (8, 12, 16, 25, 40)[i % 5]
        item = [word() for _ in range(n)]
        items.append((i, " ".join(item)))
        for j, own in enumerate((set(rnd.sample(range(n), n - math.ceil(0.6 * n))), set(rnd.sample(range(n), n - math.ceil(0.6 * n) + 1)))):
            rows_.append((2 * i + j, " ".join([word(), word()] + [word() if k in own else w for k, w in enumerate(item)] + [word()])))
        expected.add((2 * i, i))
        rows_.append((1000 + i, " ".join(item[: n // 2] + [word()] + item[n // 2 :])))
        expected.add((1000 + i, i))
    found = decontaminate.links(spark.createDataFrame(rows_, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got <= expected and len(got & expected) / len(expected) >= 0.95


def test_chance_hits_far_apart_make_no_link(spark):
    item = " ".join(f"t{i}" for i in range(20))
    parts = [" ".join(f"t{i}" for i in range(a, a + 5)) for a in (0, 5, 10, 15)]
    far = (" " + " ".join(f"x{i}" for i in range(60)) + " ").join(parts)
    df = spark.createDataFrame([(1, far), (2, " ".join(parts))], "doc_id int, text string")
    assert [r.doc_id for r in decontaminate.links(df, spark.createDataFrame([(1, item)], "item_id int, text string")).collect()] == [2]


def test_native_plans_hold_no_python(spark, scratch):
    folder = write(scratch, documents=DOCS, benchmark=BENCH)
    for module, name in ((licenses, "op9_license_scan"), (decontaminate, "op8_decontaminate")):
        plan = module.QUERIES[name](spark, folder)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan

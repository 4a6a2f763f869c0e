import collections
import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import docs, rows, same_as_sql, write
from wearline.llm import cover_anchors

WORDS = ["".join(random.Random(i).choice("abcdé") for _ in range(1 + i % 5)) for i in range(40)]


def brute(table, width):
    texts = [(i, (t or "").encode().split()) for i, t in table]
    count = collections.Counter(tuple(x[j : j + width]) for _, x in texts for j in range(len(x) - width + 1))
    out = []
    for i, x in texts:
        gone = [False] * len(x)
        for j in range(len(x) - width + 1):
            if count[tuple(x[j : j + width])] > 1:
                gone[j : j + width] = [True] * width
        kept = b" ".join(w for w, g in zip(x, gone) if not g)
        runs = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        out.append((i, len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _rows(seed=3):
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    passages = [text(14) for _ in range(4)]
    table = []
    for i in range(150):
        t = text(rnd.randint(0, 25))
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(passages).split()
            t += " \n" + " ".join(p[rnd.randint(0, 7) : rnd.randint(7, 14)]) + "\t" + text(rnd.randint(0, 10))
        table.append((i, t))
    copies = [(300 + i, table[3][1]) for i in range(12)]
    return table + copies + [(7, table[5][1]), (None, table[6][1]), (None, None), (200, " \n "), (201, "a " * 60), (202, "ab ab c " * 30)]


def test_the_cover_takes_every_step():
    assert cover_anchors.is_cover(cover_anchors.PERIOD, cover_anchors.COVER)
    assert not cover_anchors.is_cover(cover_anchors.PERIOD, cover_anchors.COVER[1:])


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(2)
    for _ in range(30):
        match = rng.integers(0, 2**60, 35).astype(np.uint64)
        texts = [np.concatenate([rng.integers(0, 2**60, rng.integers(0, 60)).astype(np.uint64), match, rng.integers(0, 2**60, 40).astype(np.uint64)]) for _ in range(2)]
        found = [cover_anchors.anchors(t, t, np.array([0, len(t)]), 35, cover_anchors.PERIOD, cover_anchors.COVER) for t in texts]
        assert set(found[0]["h"].tolist()) & set(found[1]["h"].tolist())


@pytest.mark.parametrize("least", [64, 1])
def test_spans_equal_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr("wearline.llm.common.HOT_LEAST", least)
    monkeypatch.setattr("wearline.llm.common.FEW_FACTS", 0 if least == 1 else 200_000)
    table = _rows()
    df = spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)
    for width, period, cover in ((6, 3, (0, 1)), (5, 5, (0, 1, 2)), (9, 7, (0, 1, 3))):
        got = cover_anchors.spans(df, width, period, cover)
        assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute(table, width)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    data = np.frombuffer(" ".join(t or "" for _, t in _rows()).encode() + b" " + b"x" * 500 + b" tail", np.uint8)
    whole = cover_anchors.word_hashes(data)
    for size in (7, 100, 1000):
        monkeypatch.setattr(cover_anchors, "PIECE_BYTES", size)
        assert all((a == b).all() for a, b in zip(whole, cover_anchors.word_hashes(data), strict=True))
        first = cover_anchors.block_words(data, np.array([0, 0, 5, len(data)]))[2]
        assert first[1] == 0 and first[-1] >= len(whole[0])


def test_query_equals_sql_on_special_rows(spark, scratch):
    long = " ".join(str(i * i) for i in range(90))
    table = docs(None, "", "short one", "short one", long, "x " + long[20:300] + "\n\n tail", "é " * 80, " \t", ids=[None, 1, 2, 2, 4, 5, 6, 7])
    table += [(9, "lead  " + long[200:400] + "  middle " + long[30:260] + " ", None, None, None), (10, long, "x", "y", 1)]
    same_as_sql(spark, write(scratch, documents=table), cover_anchors, "op11_cover_anchors")


def test_empty_table(spark, scratch):
    assert cover_anchors.op11_cover_anchors(spark, write(scratch, documents=[])).count() == 0


def test_removal_keeps_clashing_columns_and_other_bytes(spark):
    rnd = random.Random(9)
    passage = " ".join(rnd.choice(WORDS) for _ in range(60))
    df = spark.createDataFrame([(1, f"  before\n{passage}", "m", 5), (2, f"{passage}  after ", None, 6), (3, "clean \n text", "x", 7)], "d1 int, text string, marks string, p int")
    out = cover_anchors.remove(df)
    assert out.columns == df.columns
    assert rows(out, "d1", "text", "marks", "p") == [(1.0, "  before\n", "m", 5.0), (2.0, "  after ", None, 6.0), (3.0, "clean \n text", "x", 7.0)]
    whole = cover_anchors.resolved(df).filter("d1 = 1").first()
    assert whole.removed == [passage] and whole.n_removed == 60 and whole.n_spans == 1

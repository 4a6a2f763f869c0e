import collections
import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import docs, write
from wearline.llm import repeats
from wearline.llm.rlbwt import repeated_starts

WORDS = ["".join(random.Random(i).choice("abcdé") for _ in range(1 + i % 5)) for i in range(40)]


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(x[j : j + length] for _, x in texts for j in range(len(x) - length + 1))
    out = []
    for i, x in texts:
        mask = np.zeros(len(x) + 2, bool)
        for j in range(len(x) - length + 1):
            if count[x[j : j + length]] > 1:
                mask[j + 1 : j + 1 + length] = True
        kept = bytes(b for b, m in zip(x, mask[1:-1]) if not m)
        out.append((i, len(x), int(mask.sum()), int((np.diff(mask.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _rows(seed=3):
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    passages = [text(30) for _ in range(4)]
    rows = []
    for i in range(120):
        t = text(rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(passages)
            t += p[rnd.randint(0, 20) : rnd.randint(40, 140)] + text(rnd.randint(0, 10))
        rows.append((i, t))
    return rows + [(7, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (None, None), (200, ""), (201, "a" * 500), (202, "ab" * 300)]


def test_index_finds_repeated_strings():
    rng = np.random.default_rng(1)
    for _ in range(60):
        base = bytes(rng.integers(97, 100, rng.integers(1, 60)).astype(np.uint8))
        segments = []
        for _ in range(rng.integers(1, 12)):
            a, b = sorted(rng.integers(0, len(base) + 1, 2))
            segments.append(base[a:b] + bytes(rng.integers(97, 100, rng.integers(0, 20)).astype(np.uint8)))
        data = np.frombuffer(b"".join(segments), np.uint8)
        at = np.cumsum([0, *map(len, segments)])
        for length in (1, 3, 7, 20):
            count = collections.Counter(s[i : i + length] for s in segments for i in range(len(s) - length + 1))
            expected = [i + length <= len(s) and count[s[i : i + length]] > 1 for s in segments for i in range(len(s))]
            assert repeated_starts(data, at, length).tolist() == expected


@pytest.mark.parametrize("hot, least", [(5000, 64), (2, 64), (5000, 1), (2, 1)])
def test_spans_equal_brute_force(spark, monkeypatch, hot, least):
    monkeypatch.setattr("wearline.llm.common.HOT_LEAST", least)
    monkeypatch.setattr("wearline.llm.common.FEW_FACTS", 0 if least == 1 else 200_000)
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted((tuple(r) for r in repeats.spans(df, 40, 20, hot).collect()), key=repr) == brute(rows, 40)


def test_very_long_texts_are_anchored_in_parts(spark, monkeypatch):
    rows = _rows(5)[:60]
    rows.append((900, " ".join(t for _, t in rows)))
    monkeypatch.setattr(repeats, "PART_BYTES", 700)
    data = np.frombuffer(rows[-1][1].encode(), np.uint8)
    parts = list(repeats.row_anchors(data, np.array([0, len(data)]), 40, 20))
    windows = sorted(w for p in parts for a, b in zip(p["start"], p["stop"]) for w in range(a, b + 1))
    assert len(parts) > 3 and windows == list(range(len(data) - 39))


def test_query_on_special_rows(spark, scratch):
    long = "x".join(str(i * i) for i in range(300))
    table = docs(None, "", "short", "short", long, long[200:700] + "tail", "é" * 400, ids=[None, 1, 2, 2, 4, 5, 6])
    got = repeats.op7_run_length_dedup(spark, write(scratch, documents=table))
    found = got.collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == brute([(r[0], r[1]) for r in table], 400)
    assert {r.doc_id: r.text for r in found}[5] == "tail"


def test_reported_passages(spark):
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    many, wide = " ".join(word(8) for _ in range(55)), " ".join(word(30) for _ in range(20))
    short, few = " ".join(word(3) for _ in range(51)), " ".join(word(3) for _ in range(50))
    rows = [(1, f"one {many} two"), (2, f"{many}"), (3, f"x {wide}"), (4, f"{wide} y"), (5, "alone \n here")]
    rows += [(6, f"A {short} B"), (7, f"C\n{short} D"), (8, f"E {few} F"), (9, f"G {few} H"), (10, f"{short} {wide}")]
    got = {r.doc_id: r for r in repeats.cuts(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert [p.strip() for p in got[1].passages] == [many] and got[2].passages == [many] and got[2].text == ""
    assert got[3].n_spans == 1 and got[3].passages == [] and got[5].text == "alone \n here" and got[5].passages == []
    # shorter than 400 bytes: the contract's columns leave them alone
    assert got[6].n_removed == got[7].n_removed == 0 and got[6].passages == got[7].passages == [short]
    assert got[6].text == "A  B" and got[7].text == "C\n D" and got[8].text == f"E {few} F" and got[8].passages == []
    assert got[10].passages == [short] and got[10].n_spans == 1


def test_empty_table(spark, scratch):
    assert repeats.op7_run_length_dedup(spark, write(scratch, documents=[])).count() == 0


def test_removal_keeps_columns_and_cuts_texts(spark, scratch):
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefgh é") for _ in range(600))
    table = docs("before " + passage, passage + " after", "clean text", None)
    d = spark.read.parquet(f"{write(scratch, documents=table)}/documents.parquet")
    out = repeats.remove(d)
    assert out.columns == d.columns and out.dtypes == d.dtypes
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].text == "before " and got[1].text == " after" and got[2].text == "clean text" and got[0].n_chars == 7 and got[0].h == "x"

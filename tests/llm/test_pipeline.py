"""Each stage against a brute-force version on its own input, and the entry without this folder."""

import collections
import random
import re
import subprocess
import sys

import pytest

import corpus_pipeline
from tests.llm.helpers import docs, write
from tests.llm.test_near_duplicates import _exact_classes
from wearline.llm import toxicity
from wearline.llm.common import land

WORDS = [a + b + c for a in ("ba", "ce", "di", "fo") for b in ("l", "m", "n") for c in ("os", "et", "ir")]
ITEM = "some benchmark question about a particular subject with enough words to matter"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rnd = random.Random(8)
    make = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    passage = make(90)
    texts = []
    for i in range(200):
        t = make(rnd.randint(5, 120))
        if i % 5 == 0:
            t += " nasty vile"
        if i % 11 == 1:
            t += " " + passage
        if i % 13 == 2:
            t += " " + ITEM
        texts.append(t)
    base = make(60)
    texts += [base, base, base.replace(base.split()[7], "changed", 1), None, "", make(1500)]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(200)]
    return write(str(tmp_path_factory.mktemp("pipeline")), documents=docs(*texts), labels=labels, benchmark=[(1, ITEM), (2, None)])


def _repeats(texts, length):
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = set()
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone.update(range(i, i + length))
        out.append(bytes(b for i, b in enumerate(t) if i not in gone).decode(errors="ignore"))
    return out


def test_stages_equal_brute_force(spark, folder):
    d = spark.read.parquet(f"{folder}/documents.parquet")
    names = d.columns
    before = {r.doc_id: r.text for r in d.collect()}

    def step(k, docs_):
        out = land(corpus_pipeline.STAGES[k][1](spark, docs_, folder), "test-stage")
        return out, (out.columns, {r.doc_id: r.text for r in out.collect()}) if k < 4 else out.collect()

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.score(d, labels).collect()}
    d, (columns, after) = step(0, d)
    assert columns == names and set(after) == {i for i, s in scores.items() if s < 0.3}
    assert sum(i % 5 == 0 for i in after if i < 200) <= 4 and len(after) > 150

    classes = _exact_classes([(i, t) for i, t in after.items()])
    d, (columns, kept) = step(1, d)
    assert columns == names and set(kept) == {min(c) for c in classes.values()}

    ids = sorted(kept)
    expected = dict(zip(ids, _repeats([(kept[i] or "").encode() for i in ids], 400), strict=True))
    d, (columns, cut) = step(2, d)
    assert columns == names and {i: t or "" for i, t in cut.items()} == expected and sum(map(len, expected.values())) < sum(len(t or "") for t in kept.values())

    d, (columns, clean) = step(3, d)
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    leaks = {i for i, t in cut.items() if " ".join(words(ITEM)) in " ".join(words(t))}
    assert columns == names and leaks and set(clean) == set(cut) - leaks
    assert all(before[i] is None or clean[i] in (before[i], expected[i]) for i in clean)

    _, pieces = step(4, d)
    assert {r.doc_id for r in pieces} == set(clean)
    full = collections.Counter()
    for r in pieces:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 1024


@pytest.mark.parametrize("size", [1, 5])
def test_passages_of_over_fifty_words_go(spark, scratch, size):
    rnd = random.Random(9)
    word = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    own = lambda mark: " ".join(mark + word(6) + mark for _ in range(70))
    long, short, wide = (" ".join(word(n) for _ in range(k)) for n, k in ((size, 51), (size, 50), (20, 25)))
    texts = [f"{own('K')} {p} {own('L')}" for p in (long, short, wide)] + [f"{own('M')} {p} {own('N')}" for p in (long, short, wide)]
    texts += [long[:-1] + "Q", "x " * 60, "x " * 60]
    table = write(scratch, documents=docs(*texts))
    d = corpus_pipeline.cut_repeats(spark, spark.read.parquet(f"{table}/documents.parquet"), table)
    got = {r.doc_id: r.text for r in d.collect()}
    cut = [texts[i].replace(f" {p} ", "") for i, p in enumerate((long, short, wide) * 2)]
    assert [got[i] for i in (0, 3, 2, 5)] == [cut[i] for i in (0, 3, 2, 5)]
    assert got[1] == texts[1] and got[4] == texts[4] and got[7] == got[8] == ""


def test_run_gives_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100


def test_empty_tables(spark, scratch):
    assert corpus_pipeline.run(spark, write(scratch, documents=[], labels=[], benchmark=[])).count() == 0


def test_every_operator_is_registered_once():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_this_folder():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("wearline.llm"):
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 60 and "pipeline" not in e.queries() and not any(n.startswith("op") for n in e.queries())
assert e.oracle_sql()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])

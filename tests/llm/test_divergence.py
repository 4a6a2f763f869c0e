import collections
import random
import re

import numpy as np
import pyarrow as pa

from tests.llm.helpers import docs, rows, same_as_sql, write
from wearline.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(table, least, top):
    count, in_docs, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for _, text, lang, source, *_ in table:
        key = (lang or "", source or "")
        groups.add(key)
        terms = TERM.findall((text or "").translate(LOWER))
        count[key].update(terms)
        in_docs[key[0]].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]
        whole = collections.Counter()
        for s in sources:
            whole.update(count[lang, s])

        def p(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        q = p(whole)
        for s in sources:
            own = p(count[lang, s])
            pairs = [(o, sum(abs(own[t] - x) for t, x in p(count[lang, o]).items())) for o in sources if o != s]
            terms = [(t, own[t] - q[t]) for t in kept if count[lang, s][t] and own[t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[1], x[0].encode()))[:top])):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, float(v), float(i + 1)) for i, (t, v) in enumerate(found)]
    return sorted(out, key=repr)


def _table(n=240, seed=4):
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "ÉTÉ", "été", "gamma", "Zeta", "it's", "x1y", "ﬀ", "naïve", "Δelta"]
    table = []
    for i in range(n):
        text = rnd.choice([" ", "\n", "-7 "]).join(rnd.choice(words[: 3 + i % 9]) for _ in range(rnd.randint(0, 12)))
        lang, source = rnd.choice(["en", "fr", None, ""]), rnd.choice(["a", "b", "é", None, "Z"])
        table.append((i, text, lang, source, 0))
    return table + [(3, None, "en", "a", 0), (None, "", "xx", "only", 0), (500, "one", "yy", "p", 0), (501, "?!", "yy", "q", 0), (502, "Alpha " * 5000, "en", "b", 0)]


def test_block_counts():
    block = pa.RecordBatch.from_pydict({"text": ["A b a", None, "B"], "lang": ["x", None, "x"], "source": ["s", "t", "s"]})
    got = sorted((tuple(r.values()) for r in divergence.block_counts(block).to_pylist()))
    assert got == [("", "t", "", 0, 0), ("x", "s", "", 0, 0), ("x", "s", "a", 2, 1), ("x", "s", "b", 2, 2)]


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    total = rng.integers(1, 2**53, 2000)
    count = (total * rng.random(2000)).astype(np.int64)
    assert divergence.share(count, total).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(count, total)]


def test_audit_equals_brute_force_in_many_shards(spark, monkeypatch):
    table = _table()
    df = spark.createDataFrame(table, "doc_id bigint, text string, lang string, source string, n bigint").repartition(4)
    columns = ("lang", "source", "part", "item", "value", "rank")
    for cells in (divergence.CELLS, 5):
        monkeypatch.setattr(divergence, "CELLS", cells)
        assert rows(divergence.audit(df, 3, 4), *columns) == brute(table, 3, 4)


def test_query_equals_sql(spark, scratch):
    got = same_as_sql(spark, write(scratch, documents=_table(900)), divergence, "op13_divergence_audit")
    assert {r.part for r in got.collect()} == {"pair", "term"}


def test_empty_table_and_texts_without_words(spark, scratch):
    assert divergence.op13_divergence_audit(spark, write(scratch, documents=[])).count() == 0
    df = spark.createDataFrame([(1, "1 2 3", "en", "a"), (2, None, "en", "b")], "doc_id int, text string, lang string, source string")
    assert rows(divergence.audit(df), "source", "part", "item", "value", "rank") == [("a", "pair", "b", 0.0, 1.0), ("b", "pair", "a", 0.0, 1.0)]


def test_docs_helper_rows(spark, scratch):
    # one source in a language has no pairs
    assert divergence.op13_divergence_audit(spark, write(scratch, documents=docs("one", "two", lang=["en", "en"]))).count() == 0

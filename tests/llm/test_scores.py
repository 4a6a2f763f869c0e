"""Language-model scores, language identification and toxicity."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import docs, write
from wearline.llm import gru, language_id, lm_score, ppm, toxicity
from wearline.llm.common import text_bytes


def _fold(i, mod):
    return None if i is None else zlib.crc32(str(i).encode()) % mod


# ---- PPM ----


def _lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def _slow_ppm(train, text):
    """Probability of every byte by the rules of the trie, with dictionaries."""
    seen = collections.defaultdict(collections.Counter)
    for t in train:
        x = bytes([ppm.PAD] * ppm.ORDER) + t + bytes([ppm.END])
        for i in range(ppm.ORDER, len(x)):
            for m in range(ppm.ORDER + 1):
                seen[x[i - m : i]][x[i]] += 1
    x, total = bytes([ppm.PAD] * ppm.ORDER) + text + bytes([ppm.END]), 0.0
    for i in range(ppm.ORDER, len(x)):
        p, gone = 1.0, set()
        for m in range(ppm.ORDER, -1, -1):
            children = {s: n for s, n in seen[x[i - m : i]].items() if s not in gone}
            size, kinds = sum(children.values()), len(children)
            if x[i] in children:
                p *= children[x[i]] / (size + kinds)
                break
            if kinds:
                p *= kinds / (size + kinds)
            gone |= set(children)
        else:
            p /= 256 - len(gone)
        total += math.log10(p)
    return total


def test_lm_scores_equal_the_rules(spark, scratch):
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["the", "a", "Cat", "é\t", "zz\n"]) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
    table = docs(None, "", *texts, texts[3], "Ünseen words only", "x" * 50_000, ids=[None, *range(1, 42), 4, 999, 1000])
    got = {(r.doc_id, r.n_tokens): r for r in lm_score.op6_ppm_score(spark, write(scratch, documents=table)).collect()}
    train = [r[1] for r in table if _fold(r[0], 7) != 2]
    tokens = lambda s: re.findall(r"[^\x20\x09-\x0D]+", _lower(s)) + [None]
    count = collections.Counter(w for t in train for w in tokens(t))
    n = sum(count.values())
    for i, text, *_ in table:
        own = tokens(text)
        r = got[i, len(own)]
        assert r.held_out == (_fold(i, 7) == 2) and r.train_tokens == n and r.n_known == sum(count[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + len(count) + 1)) for w in own), abs=1e-5)
        if len(text or "") < 1000:
            assert r.score == pytest.approx(_slow_ppm([_lower(t).encode() for t in train], _lower(text).encode()), abs=1e-4)


@pytest.mark.parametrize("bits", [22, 4])
def test_rare_strings_count_in_large_tables(spark, scratch, monkeypatch, bits):
    monkeypatch.setattr(lm_score, "GRAM_BITS", bits, raising=False)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    table = docs("x y " * 300_000, *texts, texts[5] + texts[6], "unseen: ÿ", None, ids=[*range(63), None])
    assert _fold(0, 7) != 2 and any(_fold(i, 7) == 2 for i in range(61))
    own = lambda s: text_bytes(pa.array([_lower(s)]))
    code, times = ppm.count_codes(np.concatenate([ppm.codes(*own(r[1]))[0] for r in table if _fold(r[0], 7) != 2]))
    nodes = []
    for j in range(1, ppm.ORDER + 2):
        kept, at = np.unique(code & np.uint64(256**j - 1), return_inverse=True)
        nodes.append((kept, np.bincount(at, times).astype(np.int64)))
    trie = ppm.Trie(nodes)
    got = {r.doc_id: r.score for r in lm_score.op6_ppm_score(spark, write(scratch, documents=table)).collect()}
    for i, text, *_ in table:
        assert got[i] == pytest.approx(trie.slow(ppm.codes(*own(text))[0]).sum(), abs=1e-5)


def test_byte_probabilities_add_up_to_one():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"abcd ", np.uint8), 4000, p=[0.5, 0.2, 0.1, 0.1, 0.1])
    code, times = ppm.count_codes(ppm.codes(data, np.array([0, 1500, 4000]))[0])
    nodes = []
    for j in range(1, ppm.ORDER + 2):
        kept, at = np.unique(code & np.uint64(256**j - 1), return_inverse=True)
        n = np.bincount(at, times)
        nodes.append((kept[n >= 3], n[n >= 3]))
    trie = ppm.Trie(nodes)
    for context in (b"aaaa", b"abcd", b"zzzz", b"\xfe\xfe\xfea", b"dcba"):
        every = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert (10 ** trie.log10(every)).sum() == pytest.approx(1.0)


@pytest.mark.parametrize("module, name", [(lm_score, "op6_ppm_score"), (language_id, "op5_language_id"), (toxicity, "op4_toxicity")])
def test_empty_tables(spark, scratch, module, name):
    assert module.QUERIES[name](spark, write(scratch, documents=[], labels=[])).count() == 0


# ---- language ----


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 20):
        c = language_id.codewords(n)
        assert min((c[i] != c[j]).sum() for i in range(n) for j in range(i)) >= (1 if n == 2 else 2)
    assert language_id.codewords(1).shape == (1, 0)


def test_a_wrong_bit_is_outvoted():
    model = language_id.Model(["a", "b", "c", "d"], language_id.codewords(4))
    margins = (model.code[2] * 2.0 - 1) * 3
    margins[0] *= -0.3
    best, score, vague = model.decode(margins[None])
    assert best[0] == 2 and score[0] > 0.5 and not vague[0]
    assert model.decode(np.zeros((1, 7)))[2][0]


def _plain_language(model, text):
    """Margins and decoding in plain Python: each n-gram's weight by itself, each codeword's loss bit by bit."""
    letters = [int(language_id._LETTERS[b]) for b in text.encode()]
    margins = [float(b) for b in model.bias]
    for order in language_id.ORDERS:
        count = max(1, len(letters) - order + 1)
        for i in range(len(letters) - order + 1):
            h = order
            for b in letters[i : i + order]:
                h = (h * 0x01000193 ^ b) & 0xFFFFFFFF
            h = (h * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - language_id.BITS)
            margins = [m + float(w) / count for m, w in zip(margins, model.weights[h])]
    loss = [sum(math.log1p(math.exp(-m if bit else m)) for m, bit in zip(margins, word)) for word in model.code.tolist()]
    p = [math.exp(-x) for x in loss]
    return model.languages[loss.index(min(loss))], max(p) / sum(p)


def test_language_predictions_equal_plain_decoding(spark):
    rnd = random.Random(7)
    letters = {"aa": "abcdefg", "bb": "efghijkl", "cc": "klmnopqé"}
    make = lambda k: " ".join("".join(rnd.choice(letters[k]) for _ in range(rnd.randint(1, 8))) for _ in range(12))
    table = [(i, make(k), k) for i in range(90) for k in [("aa", "bb", "cc")[i % 3]]] + [(100, "é", None), (101, "x", None), (102, "a" * 300, None)]
    df = spark.createDataFrame(table, "doc_id bigint, text string, lang string")
    model = language_id.fit(df)
    got = {r.doc_id: r for r in language_id.predict(df, model).collect()}
    for i, text, _ in table:
        name, p = _plain_language(model, text)
        assert got[i].lang_pred == name and got[i].score == pytest.approx(p, abs=2e-6)


def test_language_sample_of_repeated_ids_is_fixed(spark):
    rows = [(1, "b b b", "xx"), (1, "a a a", "xx"), (2, "c c", "yy")]
    a, b = (language_id.training_sample(spark.createDataFrame(r, "doc_id bigint, text string, lang string").repartition(3)) for r in (rows, rows[::-1]))
    assert [(x[0], x[1].tolist(), x[2].tolist()) for x in a] == [(x[0], x[1].tolist(), x[2].tolist()) for x in b]


def test_language_special_rows(spark, scratch):
    rnd = random.Random(5)
    make = lambda letters: " ".join("".join(rnd.choice(letters) for _ in range(5)) for _ in range(20))
    texts = [make("abcde") if i % 2 else make("vwxyz") for i in range(60)]
    lang = ["aa" if i % 2 else "zz" for i in range(60)] + [None] * 6
    table = docs(*texts, None, "", "123 !?", "漢字", "É", "vwx " * 20_000, lang=lang, ids=[*range(60), None, 61, 62, 63, 64, 65])
    got = {r.doc_id: r for r in language_id.op5_language_id(spark, write(scratch, documents=table)).collect()}
    assert all(got[i].lang_pred == lang[i] and got[i].held_out == (_fold(i, 3) == 1) for i in range(60))
    assert [(got[i].lang_pred, got[i].score) for i in (None, 61, 62)] == [("und", 0.0)] * 3
    assert got[63].lang_pred in ("aa", "zz") and got[65].lang_pred == "zz" and not got[None].held_out


def test_language_without_labels_or_with_one(spark, scratch):
    table = docs("some text", "more", lang=[None, None])
    assert {r.lang_pred for r in language_id.op5_language_id(spark, write(scratch, documents=table)).collect()} == {"und"}
    one = docs("some text", "more", "123", lang=["xx", "xx", "xx"])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.op5_language_id(spark, write(scratch, documents=one)).collect()}
    assert got == {0: ("xx", 1.0), 1: ("xx", 1.0), 2: ("und", 0.0)}


def test_language_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = [r for r in language_id.op5_language_id(spark, folder).collect() if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in got]) > 0.97


# ---- toxicity ----


def test_gradients_of_the_network():
    block = gru.read_block(*text_bytes(pa.array(["one bad word here", "", "all good " * 30, "bad"])))
    label, net = np.array([1.0, 0, 0, 1]), gru.BiGRU()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    weight = np.full(4, 0.25)
    _, grads = net.gradients(block, label, weight)
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = net.p[k][at], 1e-5
        net.p[k][at] = keep + step
        up = net.gradients(block, label, weight)[0]
        net.p[k][at] = keep - step
        down = net.gradients(block, label, weight)[0]
        net.p[k][at] = keep
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=2e-3, abs=1e-6)


def _plain_score(net, text):
    """The network in plain Python: word by word, gate by gate, window by window."""
    block = gru.read_block(*text_bytes(pa.array([text])))
    p = {k: v.astype(float).tolist() for k, v in net.p.items() if k not in ("word", "gram")}
    vectors = []
    for j in range(len(block.word)):
        grams = block.gram[block.gram_at[j] : block.gram_at[j + 1]]
        mean = [sum(float(net.p["gram"][g][d]) for g in grams) / math.sqrt(len(grams)) for d in range(gru.GRAM_DIM)]
        vectors.append([float(x) for x in net.p["word"][block.word[j]]] + mean)
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    h = gru.HIDDEN

    def read(inputs, side):
        state, out = [0.0] * h, []
        for x in inputs:
            a = [p["b" + side][k] + sum(x[i] * p["x" + side][i][k] for i in range(len(x))) for k in range(3 * h)]
            g = [sum(state[i] * p["h" + side][i][k] for i in range(h)) for k in range(3 * h)]
            r = [sigmoid(a[k] + g[k]) for k in range(h)]
            z = [sigmoid(a[h + k] + g[h + k]) for k in range(h)]
            new = [math.tanh(a[2 * h + k] + r[k] * g[2 * h + k]) for k in range(h)]
            state = [(1 - z[k]) * new[k] + z[k] * state[k] for k in range(h)]
            out.append(state)
        return out

    best = -math.inf
    for first, length in zip(block.first.tolist(), block.length.tolist()):
        inputs = [vectors[j] for j in block.place[first : first + length]]
        states = [f + b for f, b in zip(read(inputs, "f"), read(inputs[::-1], "b")[::-1])]
        weight = [math.exp(sum(s[i] * p["att"][i] for i in range(2 * h))) for s in states]
        pooled = [sum(w * s[i] for w, s in zip(weight, states)) / sum(weight) if states else 0.0 for i in range(2 * h)]
        best = max(best, p["bias"][0] + sum(pooled[i] * p["out"][i] for i in range(2 * h)))
    return sigmoid(best)


def test_scores_equal_a_plain_network():
    rnd = random.Random(3)
    words = [f"word{i}" for i in range(40)] + ["é", "x", "long" * 9]
    texts = [" ".join(rnd.choice(words) for _ in range(n)) for n in (1, 2, 31, 32, 33, 57, 100)] + ["", "!!", "One"]
    net = gru.BiGRU(seed=5)
    for k in ("att", "out"):
        net.p[k] *= 3
    got = net.score(gru.read_block(*text_bytes(pa.array(texts))))
    assert got.tolist() == pytest.approx([_plain_score(net, t) for t in texts], abs=1e-5)


def test_toxicity_sample_is_bounded_and_fixed(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", (5, 2))
    rows = [(i, f"text {i}") for i in range(40)] + [(1, "another text"), (1, "a text")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 1)) for i in range(40)], "doc_id bigint, quality int, toxic int")
    seen = [
        sorted(tuple(r) for r in toxicity.training_sample(spark.createDataFrame(r, "doc_id bigint, text string").repartition(3), labels).collect())
        for r in (rows, rows[::-1])
    ]
    assert seen[0] == seen[1] and sorted(r[3] for r in seen[0]) == [0] * 5 + [1] * 2


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 200):
        first, length, row_at = gru.windows(np.array([0, n]))
        assert row_at.tolist() == [0, len(first)] and set().union(*[range(a, a + k) for a, k in zip(first, length)]) == set(range(n))


def test_toxic_words_are_found_wherever_they_stand(spark, scratch):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    clean = [" ".join(rnd.choice(words) for _ in range(rnd.randint(5, 120))) for _ in range(240)]
    toxic = [" ".join([*t.split()[:-1], "nasty", *(["vile"] if i % 2 else [])]) for i, t in enumerate(clean[:80])]
    texts = [*toxic, *clean[80:], None, "", "!!! ...", " ".join(words * 200) + " nasty vile", "NASTY"]
    labels = [(i, 1, int(i < 80)) for i in range(240)] + [(3, 1, None), (3, 1, 0), (None, 1, 1), (5000, 1, 1)]
    table = docs(*texts, ids=[*range(241), 241, 242, 243, None]) + docs(toxic[0])
    got = toxicity.op4_toxicity(spark, write(scratch, documents=table, labels=labels)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(table) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.doc_id is not None and r.held_out and r.doc_id < 240]
    assert held and all(r.held_out == (_fold(r.doc_id, 4) == 2) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == int(r.doc_id < 80) for r in held]) > 0.9
    assert by[243].predicted == 1 and by[240].score == by[241].score == by[242].score and not by[None].held_out


def test_toxicity_without_both_classes(spark, scratch):
    folder = write(scratch, documents=docs("a", None), labels=[(0, 1, 0), (1, 1, 0)])
    assert {r.score for r in toxicity.op4_toxicity(spark, folder).collect()} == {0.0}


def test_rejected_documents_go_and_columns_stay(spark, scratch):
    d = spark.read.parquet(f"{write(scratch, documents=docs('a', 'b'))}/documents.parquet").withColumnRenamed("score", toxicity.SCORE)
    assert toxicity.with_score(d, 0.9).filter(f"{toxicity.SCORE} = 0.9").count() == 2
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = toxicity.keep_clean(d, labels)
    assert kept.columns == d.columns and kept.count() == 2 and kept.first()[toxicity.SCORE] == "x"

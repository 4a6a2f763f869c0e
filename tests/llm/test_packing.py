import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tests.llm.helpers import docs, write
from wearline.llm import packing
from wearline.llm.common import text_bytes
from wearline.llm.tokens import byte_bpe


def _reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_tokenizers_library():
    rnd, t = random.Random(1), _reference()
    parts = ["'s", "'re", "'ll", "'", "ve", " ", "  ", "\n", "\t", "a", "é", "ß", "7", "٣", "½", "!", "%%%", "'T", "漢", "😀", "\x85", "\x1c", "<|endoftext|>", "\r\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(3000)] + [None, "", "x" * 5000]
    ids, at = byte_bpe().encode(*text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == t.encode(text or "", add_special_tokens=False).ids


def test_cuts():
    assert packing.cut(5, 10) == [(0, 5)] and packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


def _used(patterns):
    out = {}
    for n, items in patterns:
        for k in items:
            out[k] = out.get(k, 0) + n
    return out


def _fewest(lengths, capacity):
    """Exhaustive search."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for r in {room for room in rooms if room >= lengths[i]}:
            j = rooms.index(r)
            place(i + 1, [*rooms[:j], r - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_solver_packs_every_piece_and_matches_exhaustive_search():
    rnd = random.Random(4)
    for _ in range(60):
        lengths = sorted((rnd.randint(1, 20) for _ in range(rnd.randint(1, 9))), reverse=True)
        counts = {k: lengths.count(k) for k in set(lengths)}
        patterns = packing.solve(counts, 20).patterns
        assert _used(patterns) == counts and all(sum(i) <= 20 for _, i in patterns)
        assert packing.lower_bound(counts, 20) <= sum(n for n, _ in patterns) == _fewest(lengths, 20)


def test_solver_on_many_pieces_is_near_the_bound():
    rng = np.random.default_rng(2)
    k, n = np.unique(rng.integers(1, 1025, 200_000), return_counts=True)
    counts = dict(zip(k.tolist(), n.tolist(), strict=True))
    patterns = packing.solve(counts, budget=packing.Budget(nodes=50)).patterns
    assert _used(patterns) == counts
    assert sum(n for n, _ in patterns) <= 1.002 * packing.lower_bound(counts, 1024)
    assert packing.solve({}).patterns == []


def test_pieces_and_sequences(spark, scratch):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["alpha", "beta", "gamma!", "δ"]) for _ in range(rnd.choice([0, 1, 5, 200, 700, 1500]))) for _ in range(120)]
    table = docs(None, "", *texts, *texts[:5], ids=[None, 1, *range(2, 122), *range(2, 7)])
    got = packing.op10_bin_completion(spark, write(scratch, documents=table)).collect()
    t, expected = _reference(), []
    for doc_id, text, *_ in table:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected += [(doc_id, p, s, n, zlib.crc32(ids[s : s + n].tobytes())) for p, (s, n) in enumerate(packing.cut(len(ids), 1024))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= -(-sum(e[3] for e in expected) // 1024) + 1


def test_empty_table(spark, scratch):
    assert packing.op10_bin_completion(spark, write(scratch, documents=[])).count() == 0


def test_solver_with_thousands_of_tiny_pieces():
    rng = np.random.default_rng(5)
    k, n = np.unique(rng.integers(1, 1025, 3000), return_counts=True)
    for tiny in ({1: 50_000}, {1: 7, 2: 90_000}, {1: 40_000, 2: 1, 3: 700}):
        counts = dict(zip(k.tolist(), n.tolist(), strict=True)) | tiny
        patterns = packing.solve(counts, budget=packing.Budget(nodes=30)).patterns
        assert _used(patterns) == counts and all(sum(i) <= 1024 for _, i in patterns)
        assert sum(n for n, _ in patterns) <= packing.lower_bound(counts, 1024) + 2
    assert sum(n for n, _ in packing.solve({1: 5000}).patterns) == 5


def test_plan_tells_why_the_search_ended():
    whole = packing.solve({600: 3, 424: 3})
    assert (whole.sequences, whole.bound, whole.ended) == (3, 3, "bound")
    # seven pieces of 3 in sequences of 8: two each, one below what the total length allows
    plan = packing.solve({3: 1, 5: 1, 7: 1}, 9)
    assert plan.ended in ("bound", "complete") and plan.sequences == 2
    rnd = random.Random(3)
    counts = collections.Counter(rnd.randint(180, 500) for _ in range(400))
    short = packing.solve(counts, budget=packing.Budget(nodes=1, fillings=1, steps=50))
    assert short.sequences >= short.bound and (short.ended == "budget" or short.sequences == short.bound)
    longer = packing.solve(counts)
    assert longer.sequences <= short.sequences and longer.bound == short.bound


def test_repairs_hold_every_piece_and_save_sequences():
    rnd = random.Random(8)
    for scale in (1, 1000):
        counts = {k: n * scale for k, n in collections.Counter([rnd.randint(150, 700) for _ in range(600)] + [rnd.randint(1, 60) for _ in range(80)]).items()}
        plain = packing.solve(counts, budget=packing.Budget(nodes=200, repairs=0))
        mended = packing.solve(counts, budget=packing.Budget(nodes=200, repairs=20))
        assert mended.bound == plain.bound <= mended.sequences <= plain.sequences
        held = collections.Counter()
        for n, items in mended.patterns:
            assert n > 0 and sum(items) <= 1024
            for k in items:
                held[k] += n
        assert held == counts and sum(n for n, _ in mended.patterns) == mended.sequences
        if scale == 1:
            assert mended.sequences < plain.sequences


def test_pack_reports_its_plan(spark):
    plans = []
    df = spark.createDataFrame([(i, "word " * (40 * i)) for i in range(12)], "doc_id int, text string")
    out = packing.pack(df, report=plans.append).collect()
    assert plans[0].sequences == len({r.sequence_id for r in out}) >= plans[0].bound

"""Mixing and packing against brute force and exact round trips."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
from docs import DOCS, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pactline.llm import bpe_words, mixing, packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall(text or ""))


# ---- mixing ---------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 4)), min_size=1, max_size=6, unique_by=lambda x: x[0]),
       st.integers(0, 60))
def test_nearest_sum_is_optimal(items, budget):
    sums = {0}
    for length, n in items:
        sums = {s + length * k for s in sums for k in range(n + 1)}
    found = mixing.nearest_sum([x for x, _ in items], [n for _, n in items], budget)
    assert all(found.get(x, 0) <= n for x, n in items)
    assert abs(sum(x * n for x, n in found.items()) - budget) == min(abs(s - budget) for s in sums)


def test_targets_fill_up_to_the_caps():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    capped = mixing.targets([10, 100, 100], [5, 2, 1])
    assert capped == [30.0, 120.0, 60.0] and sum(capped) == 210
    assert mixing.targets([0, 0], [5, 2]) == [0.0, 0.0] and mixing.targets([], []) == []
    twice = mixing.targets([1, 2, 300], [5, 2, 1])  # both caps, one after the other
    assert twice == [3.0, 6.0, 294.0]


def test_mix_comes_near_its_targets(spark):
    given_rows, sized = rows(), defaultdict(int)
    for r in given_rows:
        sized[r[3]] += size(r[1])
    order = sorted((s for s in sized if s is not None)) + [None] * (None in sized)
    aims = dict(zip(order, mixing.targets([sized[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])))
    found = mixing.mix_sources(frame(spark))
    got = found.select("doc_id", "size", "source_size", "target", "copies", "taken", "row.source", "row.text").collect()
    assert len(got) == len(given_rows)
    assert all(r.size == size(r.text) and r.source_size == sized[r.source] and r.target == aims[r.source] for r in got)
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in got)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    for s in order:  # as near as sums of whole passes and further copies come
        own = [size(r[1]) for r in given_rows if r[3] == s]
        passes = int(round(aims[s])) // max(1, sum(own))
        sums = 1 << passes * sum(own)
        for x in own * (3 - passes):
            sums |= sums << x
        best = min(abs(i - aims[s]) for i, c in enumerate(reversed(bin(sums))) if c == "1")
        assert abs(taken[s] - aims[s]) <= best + 0.5
    again = mixing.mix_sources(frame(spark, parts=2)).select("doc_id", "size", "taken").collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter(map(tuple, again))
    mixed = mixing.apply_mix(frame(spark))
    assert mixed.columns == frame(spark).columns
    assert Counter(r.text for r in mixed.collect()) == Counter({t: n for t, n in sum(
        (Counter({r.text: r.copies}) for r in got), Counter()).items() if n})


def test_hot_length_is_split(spark):
    same = [(i, "a b c", "en", "hot", 5, None, None, None) for i in range(900)]
    other = [(1000 + i, "x " * (i % 7 + 1), "en", "z", 5, None, None, None) for i in range(100)]
    found = mixing.mix_sources(frame(spark, same + other)).collect()
    taken = Counter()
    for r in found:
        taken[r.row.source] += r.taken
    assert all(abs(taken[r.row.source] - r.target) <= 3 for r in found)


def test_null_and_repeated_ids_spread_and_are_drawn_alike(spark):
    same = [(i, f"a b c{n}", "en", "hot", 5, None, None, None) for i in (None, 7) for n in range(300)]
    same += [(8, "a b c", "en", "hot", 5, None, None, str(n)) for n in range(300)]
    other = [(1000 + i, "x " * 30, "en", "z", 5, None, None, None) for i in range(100)]

    def drawn(some, parts):
        return Counter((r.doc_id, r.row, r.copies) for r in mixing.mix_sources(frame(spark, some, parts)).select(
            "doc_id", "row", "copies").collect())
    found = drawn(same + other, 5)
    assert len({copies for (_, row, copies) in found if row.source == "hot"}) > 1
    assert found == drawn((same + other)[::-1], 2)
    sized = mixing.sized_documents(frame(spark, same), "doc_id", "text", "source", mixing.SEED)
    assert sized.groupBy("_key", "size", "_bucket").count().agg({"count": "max"}).first()[0] < 10


def test_no_documents(spark):
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix_sources(none).count() == 0 and mixing.apply_mix(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    empty = frame(spark, [(1, None, None, None, None, None, None, None), (2, "", "en", "a", 0, None, None, None)])
    assert {(r.size, r.target, r.taken) for r in mixing.mix_sources(empty).collect()} == {(0, 0.0, 0)}


# ---- packing --------------------------------------------------------------------

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "\t", "\xa0", "\u2003", "\x85", "\x1c", "a", "b'", "'s", "é", "1", ".", "!!",
                                 "<|endoftext|>", "  ", "日本", " a", "word"]), max_size=30).map("".join))
def test_word_ids_equal_the_tokenizers(text):
    found = WORDS.encode(pa.array([text, "a b", text]))
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [plain_ids(t)[:-1] for t in (text, "a b", text)]


WORDS = bpe_words.WordIds(public_tokenizers.path("byte_bpe_50k.json"))


def test_forgetting_words_changes_nothing():
    words = bpe_words.WordIds(public_tokenizers.path("byte_bpe_50k.json"), generation=5)
    texts = ["a b c", "d e f g h i", "a b", "c  d", "", "y" * 200 + " " + "z" * 200] * 3
    for _ in range(3):
        for t in texts:
            assert np.frombuffer(words.encode(pa.array([t]))[0], "<u4").tolist() == plain_ids(t)[:-1]
        assert len(words.young) <= 5 + 8 and not any(len(w) > 64 for w in words.young)


def test_slices_cover_all_rows():
    assert bpe_words.slices(np.array([5, 1, 9, 0, 2]), 6) == [(0, 2), (2, 3), (3, 5)]
    assert bpe_words.slices(np.array([], int), 6) == []


def test_a_process_keeps_one_encoder():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert bpe_words.word_ids(path) is bpe_words.word_ids(path)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9000))
def test_pieces_have_class_lengths(n):
    cut = packing.cut_lengths(n)
    assert sum(cut) == n and all(0 < x <= 2048 for x in cut)
    assert all(x == 2048 // (2048 // x) for x in cut[:-1])
    assert cut[-1] < 128 or cut[-1] == 2048 // (2048 // cut[-1])


def check_packing(pieces, texts):
    """Every id of every document in exactly one piece; sequences gapless."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(docs) == set(texts)
    for doc, own in docs.items():
        ids, at = plain_ids(texts[doc]), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes()) == zlib.crc32(bytes(p.ids))
            at += p.length
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / sum(p.length for p in pieces)


def test_packing_round_trip(spark):
    rng = random.Random(2)
    some = {i: r[1] for i, r in enumerate(rows())}
    some |= {1000 + i: "tok " * rng.randint(0, 3000) for i in range(60)}
    df = spark.createDataFrame(list(some.items()), "doc_id long, text string").repartition(3)
    assert check_packing(packing.pack_documents(df).collect(), some) < 0.01


def test_harmonic_sequences_hold_their_class_count(spark):
    df = spark.createDataFrame([(i, "tok " * (40 * i % 900)) for i in range(300)], "doc_id long, text string").coalesce(2)
    sequences = defaultdict(list)
    for p in packing.pack_documents(df).collect():
        sequences[p.sequence_id].append(p)
    for own in sequences.values():
        k = {p["class"] for p in own}
        assert len(k) == 1
        assert k == {0} or len(own) == k.pop()


def test_packing_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b c"), (1, "b c")], "doc_id long, text string").coalesce(1)
    got = packing.pack_documents(df).collect()
    assert sum(p.length for p in got) == len(plain_ids("a")) + 2 * len(plain_ids("b c"))


def test_a_packing_task_holds_little_text_at_a_time(monkeypatch):
    texts = ["a b c " * 30_000, None, ""] + [f"{i} and {i + 1} " * 4000 for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "_text"])
    words, met, freed = bpe_words.word_ids(public_tokenizers.path(packing.VOCABULARY)), [], []

    class Watched:
        def encode(self, part):
            met.append(sum(len(t) for t in part.to_pylist()))
            return words.encode(part)

    monkeypatch.setattr(packing.pa, "default_memory_pool", lambda: type("Pool", (), {
        "release_unused": lambda self: freed.append(1)})())
    found = [r for b in packing.packed(iter([batch]), Watched(), packing.Packer(0)) for r in b.to_pylist()]
    assert max(met) <= 1 << 20 and len(freed) == len(met) > 10
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = defaultdict(bytes)
    for r in sorted(found, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == len(ids[r["doc_id"]]) // 4
        ids[r["doc_id"]] += r["ids"]
    for i in (0, 1, 2, 3, len(texts) - 1):
        own = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        assert ids[i] == np.array(own, "<u4").tobytes()

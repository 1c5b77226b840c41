"""Chunk BPE, fill-in-middle and the filter audit against the tokenizer and brute force."""
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from docs import DOCS, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pactline.llm import bpe_words, chunk_bpe, fill_in_middle, filter_audit, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
PIECES = [" ", "\n", "\t", "\xa0", " ", "\x85", "\x1c", "a", "b'", "'s", "é", "1", ".", "!!", "<|endoftext|>", "  ",
          "日本", " word", " of", " the", " thing,", " naïve", " Привет", " 12", "'ll", "<|endof"]


def plain_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def ends_of(texts):
    return chunk_bpe.chunk_ends(*chunk_bpe._buffer(pa.array(texts)))


# ---- chunk BPE ----------------------------------------------------------------------------

@pytest.fixture
def short_chunks(monkeypatch):
    monkeypatch.setattr(chunk_bpe, "CUT_BITS", 3)
    monkeypatch.setattr(chunk_bpe, "LEAST", 8)
    return chunk_bpe.ChunkEncoder(bpe_words.WordIds(PATH))


def test_repaired_joins_give_the_tokenizers_ids(short_chunks):
    rng, cut = random.Random(1), 0
    for k in range(150):
        own = PIECES if k % 3 else PIECES[17:]
        texts = ["".join(rng.choices(own, k=rng.randint(0, 250))) for _ in range(8)]
        ends = ends_of(texts)
        cut += sum(map(len, ends)) - len(ends)
        found = short_chunks.encode([t.encode() for t in texts], ends)
        assert [numbers(x) for x in found] == [plain_ids(t) for t in texts]
    assert cut > 500


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60).map("".join))
def test_sure_cuts_end_a_token_in_every_context(text):
    data = text.encode()
    for at in chunk_bpe.sure_cuts(np.frombuffer(data, np.uint8)).tolist():
        assert plain_ids(data[:at].decode()) + plain_ids(data[at:].decode()) == plain_ids(text)


def test_chunks_are_found_again_behind_other_text():
    rng = random.Random(3)
    shared = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(3000))
    one, two = ends_of([shared, "some words ahead of it " * 40 + shared])
    raw, longer = shared.encode(), ("some words ahead of it " * 40 + shared).encode()
    own = [{t[x:y] for x, y in zip([0, *e], e)} for t, e in ((raw, one), (longer, two))]
    assert len(one) > 20 and len(own[0] & own[1]) >= len(one) - 3
    assert ends_of(["", "a"]) == [[0], [1]]


def test_the_table_of_token_bytes_is_made_once_a_process():
    words = bpe_words.word_ids(PATH)
    assert chunk_bpe.token_bytes(words) is chunk_bpe.token_bytes(words)


def test_a_chunk_is_encoded_once():
    rng = random.Random(4)
    shared = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(2000))
    texts = [f"number {i} " + shared for i in range(30)]
    encoder, asked = chunk_bpe.ChunkEncoder(bpe_words.WordIds(PATH)), []
    made = encoder._new_chunks
    encoder._new_chunks = lambda t: asked.extend(t) or made(t)
    for part in (texts[:10], texts[10:]):
        found = encoder.encode([t.encode() for t in part], ends_of(part))
        assert [numbers(x) for x in found] == [plain_ids(t) for t in part]
    assert max(Counter(asked).values()) == 1 and sum(map(len, asked)) < 4 * len(shared)


def test_without_agreement_the_window_widens_and_then_the_text_is_encoded_whole(short_chunks):
    text = " ".join(f"w{i} and more" for i in range(200))
    ends, seen = ends_of([text]), []
    right = short_chunks._encode

    def wrong(windows):
        seen.extend(windows)
        return [b"\1\0\0\0" for _ in windows]
    find = short_chunks.windows.find
    short_chunks.windows.find = lambda keys, make: find(keys, wrong if seen is not None else right)
    assert numbers(short_chunks.encode([text.encode()], ends)[0]) == plain_ids(text)
    assert len({len(w) for w in seen}) > 1 and len(ends[0]) > 5


def test_memory_keeps_two_generations():
    memory, made = chunk_bpe.Memory(10), []
    make = lambda keys: made.extend(keys) or [k * 2 for k in keys]
    assert memory.find([b"aaaa", b"bbbb", b"aaaa"], make) == [b"aaaaaaaa", b"bbbbbbbb", b"aaaaaaaa"]
    memory.find([b"cccc"], make)  # now all three are the older generation
    memory.find([b"aaaa"], make)
    assert made == [b"aaaa", b"bbbb", b"cccc"] and memory.young and memory.old
    for i in range(50):
        memory.find([b"%04d" % i], make)
    assert len(memory.young) + len(memory.old) <= 6


def test_short_chunks_count_with_what_they_take(monkeypatch):
    """Beside a short text its ids, cuts and dictionary entry take most of the memory."""
    monkeypatch.setattr(chunk_bpe, "MEMORY_BYTES", 1 << 20)
    encoder = chunk_bpe.ChunkEncoder(bpe_words.word_ids(public_tokenizers.path(chunk_bpe.VOCABULARY)))
    for at in range(0, 20_000, 500):
        texts = [b"short text %d" % i for i in range(at, at + 500)]
        encoder.encode(texts, [[len(t)] for t in texts])
    assert len(encoder.chunks.young) + len(encoder.chunks.old) < 2 * (1 << 20) // chunk_bpe.ENTRY_BYTES + 500


def test_encode_and_decode_documents(spark):
    some = rows() + [(500 + i, t, None, None, None, None, None, None) for i, t in enumerate(
        ["x <|endoftext|> y<|endoftext|>", "日本語" * 3000, "a\xa0b " * 900, " " * 5000, "word " * 20_000])]
    df = frame(spark, some)
    coded = chunk_bpe.decode_ids(chunk_bpe.encode_documents(df)).collect()
    assert Counter((r.id, r.decoded) for r in coded) == Counter((d[0], d[1] or "") for d in some)
    together = chunk_bpe.encode_documents(df, decode=True).collect()
    assert Counter(map(str, together)) == Counter(map(str, coded))
    texts = {r[1] or "": plain_ids(r[1]) for r in some}
    for r in coded:
        assert numbers(bytes(r.ids)) == texts[r.decoded] and r.n_tokens == len(texts[r.decoded])
    assert chunk_bpe.encode_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_decoding_bytes_that_are_no_text(spark):
    ids = [plain_ids("é")[0], *plain_ids("日本")[:-1], 50256, 300]
    df = spark.createDataFrame([(1, bytearray(np.array(x, "<u4").tobytes()), len(x)) for x in (ids, ids[::-1], [])],
                               "id long, ids binary, n_tokens long")
    found = [r.decoded for r in chunk_bpe.decode_ids(df).collect()]
    assert Counter(found) == Counter(TOKENIZER.decode(x, skip_special_tokens=False) for x in (ids, ids[::-1], []))


def test_op11_digests(spark):
    got = {r.doc_id: r for r in queries.op11_chunk_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = plain_ids(d.text), got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_documents_with_shared_chunks_meet(spark):
    plan = chunk_bpe.encode_documents(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan and "hashpartitioning(least_hash" in plan
    same = frame(spark, [r for r in rows() if r[1] == rows()[0][1]])
    assert chunk_bpe.chunk_documents(same).select("least_hash").distinct().count() == 1


# ---- fill in middle -----------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text, unit="word"):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text) if unit == "word" else list(text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["word", "char"])
def test_fill_in_middle(spark, unit):
    rng = random.Random(7)
    some = [(r[0], r[1]) for r in rows()] + [(1000 + i, "".join(rng.choices(PIECES + ["\x0b", "\x0c", "😀", "<P", "S>", "<"],
                                                                          k=rng.randint(0, 40)))) for i in range(300)]
    some += [(2000 + i, x) for i, x in enumerate(["a <P> b", "<M>", "x<S>y", "<P", " ", "\n a \n"] * 8)]
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
    got = fill_in_middle.fill_in_middle(df.selectExpr("*", "text as output", "1 as n", "1 as h1"), unit=unit)
    got = got.withColumn("again", fill_in_middle.restored()).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter(plain_fim(*d, unit) for d in some)
    assert Counter((r.doc_id, r.again) for r in got) == Counter((i, t or "") for i, t in some)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_rates_and_empty_table(spark):
    df = spark.range(300).selectExpr("id as doc_id", "'a b c' as text")
    assert {r.form for r in fill_in_middle.fill_in_middle(df, rate=100, suffix_first=0).collect()} == {"psm"}
    assert {r.form for r in fill_in_middle.fill_in_middle(df, rate=0).collect()} == {"plain"}
    assert fill_in_middle.fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle.cut_bytes(np.zeros(1, np.uint8), np.array([0, 1]), fill_in_middle.MultibyteIndex(
            np.zeros(1, np.uint8)), np.zeros((2, 1), int), "line")


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_multibyte_index(text):
    try:
        raw = text.encode()
    except UnicodeEncodeError:
        return
    index = fill_in_middle.MultibyteIndex(np.frombuffer(raw, np.uint8))
    starts = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert index.bytes(np.arange(len(text) + 1)).tolist() == starts.tolist()
    assert index.chars(starts).tolist() == list(range(len(text) + 1))
    assert len(index.byte_at) == sum(c > "\x7f" for c in text)


# ---- filter audit ---------------------------------------------------------------------------

def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least, cells, out, total = {}, [], [], Counter()
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": i is not None and i > least[text]}
        cells.append((source or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    for part in {c[0] for c in cells}:
        own = [c[1:] for c in cells if c[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step in range(1, 6):
                x, before = order[step - 1], set(order[:step - 1])
                gone = [c for c in own if x in c[0] and not c[0] & before]
                total[part, x] += len(gone)
                out.append((part, order, step, sum(not c[0] & {*before, x} for c in own), len(gone),
                            sum(x in c[0] and bool(c[0] & before) for c in own), sum(c[0] == {x} for c in own),
                            sum(c[1] for c in gone), sum(c[2] for c in gone)))
    return Counter((*r, total[r[0], r[1][r[2] - 1]]) for r in out)


def test_filter_audit(spark):
    rng = random.Random(9)
    pool = [" ".join(rng.choices(["some", "More", "words", "of", "it", "e%", "Ä"] + [f"w{i}" for i in range(v)],
                                 k=rng.choice([5, 150, 260]))) for v in (0, 50, 400) for _ in range(6)]
    docs = [(i, rng.choice(pool), rng.choice(["a", "b", None])) for i in range(150)]
    docs += [(r[0], r[1], r[3]) for r in rows()] + [(3, docs[3][1], "a"), (None, pool[0], "c"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as mask", "'x' as part")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as mask")
    got = filter_audit.filter_audit(df.repartition(4), marks)
    assert dict(got.dtypes)["step"] == "int" and {t for _, t in got.dtypes} == {"string", "int", "bigint"}
    assert Counter(map(tuple, got.collect())) == plain_audit(docs, labels)


def test_filter_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(none, labels).count() == 0
    one = spark.createDataFrame([(None, None, None)], "doc_id long, text string, source string")
    assert Counter(map(tuple, filter_audit.filter_audit(one, labels).collect())) == plain_audit([(None, None, None)], [])


def test_recursion_covers_all_orders(spark):
    steps = filter_audit.enumerate_prefixes(spark).collect()
    by_step = defaultdict(set)
    for r in steps:
        by_step[r.step].add(r.prefix)
        own, before = {k for k, x in enumerate("ABCDE") if r.mask >> k & 1}, {"ABCDE".index(x) for x in r.prefix[:-1]}
        x = "ABCDE".index(r.letter)
        assert (r.removed, r.redundant) == (x in own and not own & before, x in own and bool(own & before))
        assert (r.kept, r.alone) == (not own & {*before, x}, own == {x})
    assert {k: len(v) for k, v in by_step.items()} == {1: 5, 2: 20, 3: 60, 4: 120, 5: 120}
    assert len(steps) == 32 * 325

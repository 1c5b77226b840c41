"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the last WINDOW bytes cuts every text where its upper bits
are zero, so equal passages of different documents fall into equal chunks
wherever they stand.  Documents are brought together by the least hash of
their chunks: copies and near copies share most chunks and so, mostly, that
hash.  Spark's rebalancing splits a hash that very many documents share.  A
task then encodes every distinct chunk once and takes repeated ones from its
memory.

The ids on both sides of a chunk join depend on where the chunk was cut.  A
join is repaired by encoding the text around it anew, with a guard on either
side: a stretch that both the chunk and the new text hold.  If the new ids of
both guards agree with the chunks' own, the new ids replace the old ones
between the guards; if not, the window is widened, and a document without any
agreement is encoded whole.  Guards begin and end at sure cuts, single blanks
between two characters that are no white space, where byte-level BPE with the
usual word pattern always ends a token; so ids that agree there are the whole
text's.  A chunk holds at least two sure cuts, or else is joined to the next;
text without any (no blanks at all) is one chunk.

Decoding joins the bytes of the ids and reads them as UTF-8, with U+FFFD for
what is none.

Cases: a null text counts as empty and has no ids; any length and repeated
rows are encoded as they come, one row out for each row in; null and repeated
ids stay; an empty table gives an empty table; columns besides id and text
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.bpe_words import WordIds, slices, word_ids

VOCABULARY = "byte_bpe_50k.json"
#: Bytes in the rolling hash; a cut where its upper CUT_BITS bits are zero; bytes from one cut to the next, at least.
WINDOW, CUT_BITS, LEAST = 16, 10, 128
#: Bytes of text handled at a time, and in each generation of a worker's memory of chunks (a quarter of it for joins).
BATCH_BYTES, MEMORY_BYTES = 1 << 22, 7 << 23
#: Bytes that an entry of a memory takes beside its texts and ids, and those of a remembered cut.
ENTRY_BYTES, CUT_BYTES = 400, 80
#: Times a window is widened before the document is encoded whole.
WIDEN = 3

CHUNKED = pa.schema([("id", pa.int64()), ("text", pa.string()), ("cuts", pa.binary()), ("least_hash", pa.int64())])
ENCODED = pa.schema([("id", pa.int64()), ("ids", pa.binary()), ("n_tokens", pa.int64())])


# ---- chunks ----------------------------------------------------------------------------

def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the hash of the WINDOW bytes that end there."""
    gear = np.random.default_rng(42).integers(0, 1 << 32, 256, dtype=np.uint32)
    h, step = gear[data], 1
    while step < WINDOW:  # sums over 1, 2, 4 ... bytes; an older byte is shifted further
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint32(step)
        h, step = longer, 2 * step
    return h


def sure_cuts(data: np.ndarray) -> np.ndarray:
    """Positions of single blanks between two characters that are no white
    space.  Beside a character of a block that has white space, none is sure."""
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
    blocks = np.zeros(256, bool)  # lead bytes of white space beyond ASCII
    blocks[[0xC2, 0xE1, 0xE2, 0xE3]] = True
    at = np.flatnonzero(data == 32)
    at = at[(at > 0) & (at < len(data) - 1)]
    ahead, back = data[at + 1], data[at - 1]
    good = ~white[ahead] & ~blocks[ahead] & ~white[back]
    good &= ~((at > 1) & (data[np.maximum(at - 2, 0)] == 0xC2))
    good &= ~((at > 2) & blocks[data[np.maximum(at - 3, 0)]] & (data[np.maximum(at - 3, 0)] != 0xC2))
    return at[good]


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """For each text of ``data`` (``bounds``: where it starts and ends) the
    ends of its chunks, from the text's start."""
    hits = np.flatnonzero(rolling_hash(data) < (1 << (32 - CUT_BITS))) + 1
    hits = hits[hits < len(data)]
    hits = hits[(data[hits] & 0xC0) != 0x80]  # between characters
    sure = sure_cuts(data)
    before = np.searchsorted(sure, hits)  # sure cuts ahead of each hit
    # a sure cut needs the character behind it in its chunk
    before -= (before > 0) & (sure[np.maximum(before - 1, 0)] == hits - 1) if len(sure) else 0
    first, n_sure = np.searchsorted(hits, bounds), np.searchsorted(sure, bounds)
    hits, before, out = hits.tolist(), before.tolist(), []
    for k in range(len(bounds) - 1):
        start, end = int(bounds[k]), int(bounds[k + 1])
        own, last, seen = [], start, int(n_sure[k])
        for i in range(first[k], first[k + 1]):
            if hits[i] - last >= LEAST and before[i] - seen >= 3:
                own.append(hits[i] - start)
                last, seen = hits[i], before[i]
        if own and int(n_sure[k + 1]) - seen < 4:
            own.pop()  # too little behind the last cut
        out.append([*own, end - start])
    return out


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array without nulls, and the bounds of its texts."""
    sizes = pc.binary_length(texts).to_numpy()
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[int(offsets[0]):int(offsets[-1])], bounds


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        every = b.column("text").fill_null("")
        for at, to in slices(pc.binary_length(every).to_numpy(), BATCH_BYTES):
            texts = every[at:to]
            data, bounds = _buffer(texts)
            ends, raw, least = chunk_ends(data, bounds), data.tobytes(), []
            for start, own in zip(bounds.tolist(), ends):
                least.append(min(xxhash.xxh3_64_intdigest(raw[start + x:start + y])
                                 for x, y in zip([0, *own], own)) - (1 << 63))
            yield pa.RecordBatch.from_arrays([b.column("id")[at:to], texts, pa.array(
                [np.array(x, "<i4").tobytes() for x in ends], pa.binary()), pa.array(least, pa.int64())], schema=CHUNKED)


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, cuts, least_hash): ``cuts`` are the ends of the chunks as
    little-endian 32-bit byte positions."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_chunk, "id long, text string, cuts binary, least_hash long")


# ---- encoding --------------------------------------------------------------------------

def held_bytes(key: bytes, value: "bytes | Chunk") -> int:
    """About what a remembered value takes, with its key; short texts are mostly overhead."""
    if isinstance(value, Chunk):
        return ENTRY_BYTES + len(key) + len(value.ids) + CUT_BYTES * len(value.at)
    return ENTRY_BYTES // 2 + len(key) + len(value)


class Memory:
    """Two generations of remembered values, each bounded by the sum of its entries' sizes (of the keys alone, by default)."""

    def __init__(self, most: int, size_of=lambda key, value: len(key)):
        self.most, self.size_of, self.size, self.young, self.old = most, size_of, 0, {}, {}

    def find(self, keys: list[bytes], make) -> list:
        """The value of each key; ``make`` gives those of new keys, once each."""
        held = {k: x for k in keys if (x := self.young.get(k)) is not None}
        more = {k: x for k in keys if k not in held and (x := self.old.get(k)) is not None}
        new = list(dict.fromkeys(k for k in keys if k not in held and k not in more))
        more.update(zip(new, make(new) if new else []))
        self.young.update(more)
        self.size += sum(self.size_of(k, x) for k, x in more.items())
        if self.size > self.most:
            self.young, self.old, self.size = {}, self.young, 0
        held.update(more)
        return [held[k] for k in keys]


class Chunk(NamedTuple):
    """A chunk's ids and its outer sure cuts, as positions of bytes in the text and in the ids."""

    ids: bytes
    at: list[int]
    ids_at: list[int]


def made_chunks(texts: list[bytes], ids: list[bytes], bytes_of: np.ndarray) -> list[Chunk]:
    bounds = np.cumsum([0, *map(len, texts)])
    sure = sure_cuts(np.frombuffer(b"".join(texts), np.uint8))
    own = np.searchsorted(bounds, sure, "right") - 1
    inside = (sure > bounds[own]) & (sure < bounds[own + 1] - 1)
    sure, own = sure[inside], own[inside]
    ends = np.cumsum(bytes_of[np.frombuffer(b"".join(ids), "<u4")])  # of the ids, over all texts
    found = np.minimum(np.searchsorted(ends, sure), max(0, len(ends) - 1))
    good = ends[found] == sure if len(ends) else np.zeros(0, bool)  # a cut counts if an id ends there
    sure, own, found = sure[good], own[good], found[good]
    begins = np.cumsum([0, *map(len, ids)])
    at, ids_at = (sure - bounds[own]).tolist(), (4 * (found + 1) - begins[own]).tolist()
    cuts, edge, out = np.searchsorted(own, np.arange(len(texts) + 1)).tolist(), 1 << WIDEN, []
    for x, i, j in zip(ids, cuts, cuts[1:]):
        if j - i > 2 * edge:  # no window reaches further than so many cuts
            out.append(Chunk(x, at[i:i + edge] + at[j - edge:j], ids_at[i:i + edge] + ids_at[j - edge:j]))
        else:
            out.append(Chunk(x, at[i:j], ids_at[i:j]))
    return out


class ChunkEncoder:
    """Ids of texts from those of their chunks, with repaired joins."""

    def __init__(self, words: WordIds):
        self.words = words
        self.chunks, self.windows = Memory(MEMORY_BYTES, held_bytes), Memory(MEMORY_BYTES >> 2, held_bytes)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        return self.words.encode(pa.array(texts, pa.binary()).cast(pa.string()))

    def _new_chunks(self, texts: list[bytes]) -> list[Chunk]:
        return made_chunks(texts, self._encode(texts), self.words.bytes_of)

    def _repair(self, joins: list[tuple[bytes, Chunk, bytes, Chunk]]) -> list[tuple[int, bytes, int] | None]:
        """For each join: the left chunk's ids that stay (in bytes), the ids
        between, where the right chunk's ids go on; None without agreement."""
        out: list = [None] * len(joins)
        left = list(range(len(joins)))
        for step in range(WIDEN):
            near, far = (1 << step) - 1, (2 << step) - 1  # sure cuts from the edge, counted from 0
            ready = [i for i in left if len(joins[i][1].at) > far and len(joins[i][3].at) > far]
            texts = [joins[i][0][joins[i][1].at[-1 - far]:] + joins[i][2][:joins[i][3].at[far]] for i in ready]
            for i, ids in zip(ready, self.windows.find(texts, self._encode)):
                _, a, _, b = joins[i]
                guard_a = a.ids[a.ids_at[-1 - far]:a.ids_at[-1 - near]]
                guard_b = b.ids[b.ids_at[near]:b.ids_at[far]]
                if len(ids) >= len(guard_a) + len(guard_b) and ids.startswith(guard_a) and ids.endswith(guard_b):
                    out[i] = a.ids_at[-1 - near], ids[len(guard_a):len(ids) - len(guard_b)], b.ids_at[near]
            left = [i for i in left if out[i] is None]
            if not left:
                break
        return out

    def encode(self, texts: list[bytes], ends: list[list[int]]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        pieces = [t[x:y] for t, own in zip(texts, ends) for x, y in zip([0, *own], own)]
        chunks, first, joins = self.chunks.find(pieces, self._new_chunks), [], []
        for own in ends:
            first.append(first[-1] + n if first else 0)
            n = len(own)
            joins += [(pieces[i], chunks[i], pieces[i + 1], chunks[i + 1])
                      for i in range(first[-1], first[-1] + n - 1)]
        repaired, out, whole, j = self._repair(joins), [], [], 0
        for k, (start, own) in enumerate(zip(first, ends)):
            mended = repaired[j:j + len(own) - 1]
            j += len(own) - 1
            parts, at, good = [], 0, True
            for c, m in zip(chunks[start:start + len(own) - 1], mended):
                good = good and m is not None and at <= m[0]
                if good:
                    parts += [c.ids[at:m[0]], m[1]]
                    at = m[2]
            out.append(b"".join([*parts, chunks[start + len(own) - 1].ids[at:]]) if good else None)
            whole += [] if good else [k]
        for k, ids in zip(whole, self._encode([texts[k] for k in whole])):
            out[k] = ids
        return out


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """The Python process's own encoder, whose memory its tasks share."""
    return ChunkEncoder(word_ids(path))


def _encoded(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(vocabulary or public_tokenizers.path(VOCABULARY))
        for b in batches:
            for at, to in slices(pc.binary_length(b.column("text")).to_numpy(), BATCH_BYTES):
                texts = b.column("text")[at:to].cast(pa.binary()).to_pylist()
                ends = [np.frombuffer(x, "<i4").tolist() for x in b.column("cuts")[at:to].to_pylist()]
                ids = encoder.encode(texts, ends)
                yield pa.RecordBatch.from_arrays([b.column("id")[at:to], pa.array(ids, pa.binary()), pa.array(
                    [len(x) >> 2 for x in ids], pa.int64())], schema=ENCODED)
    return run


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                     decode: bool = False) -> DataFrame:
    """(id, ids, n_tokens): ``ids`` are little-endian 32-bit token ids.

    ``vocabulary``: a byte-level BPE tokenizer file, found on the workers by
    this path.  ``decode`` adds ``decoded``, the ids read back as text by the
    same worker.
    """
    encode = _encoded(vocabulary)
    rows = chunk_documents(docs, id_col, text_col).hint("rebalance", "least_hash")
    if not decode:
        return rows.mapInArrow(encode, "id long, ids binary, n_tokens long")
    read = _decoded(vocabulary)
    return rows.mapInArrow(lambda batches: read(encode(batches)), "id long, ids binary, n_tokens long, decoded string")


# ---- decoding --------------------------------------------------------------------------

@lru_cache(maxsize=2)
def token_bytes(words: WordIds) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary, made once in a Python
    process: the whole vocabulary is gone through, which takes longer than a
    small task's rows.

    Its letters stand for bytes: printable ASCII and Latin-1 letters for
    themselves, the other bytes, in order, for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own}
    byte_of.update((chr(256 + i), b) for i, b in enumerate(b for b in range(256) if b not in set(own)))
    out = [b""] * len(words.bytes_of)
    for token, i in words.tokenizer.get_vocab().items():
        out[i] = bytes(byte_of[c] for c in token)
    return out


def _decoded(vocabulary: str | None):
    schema = ENCODED.append(pa.field("decoded", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = token_bytes(word_ids(vocabulary or public_tokenizers.path(VOCABULARY)))
        for b in batches:
            for at, to in slices(pc.binary_length(b.column("ids")).to_numpy(), 4 * BATCH_BYTES):
                part = b.slice(at, to - at)
                texts = [b"".join([bytes_of[i] for i in np.frombuffer(x, "<u4").tolist()]).decode(errors="replace")
                         for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], schema=schema)
    return run


def decode_ids(encoded: DataFrame, ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """(id, ids, n_tokens, decoded) of ``encode_documents``' rows."""
    return encoded.select("id", F.col(ids_col).alias("ids"), "n_tokens").mapInArrow(
        _decoded(vocabulary), "id long, ids binary, n_tokens long, decoded string")

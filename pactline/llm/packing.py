"""Harmonic packing of tokenised documents into sequences.

A document is its token ids and an end id.  It is cut into whole sequences
and a rest; the rest is cut into pieces of the lengths capacity / k for k up
to FINE, longest first, until what remains is shorter than capacity / FINE.
Pieces fall into reciprocal-capacity classes: class k holds lengths in
(capacity / (k + 1), capacity / k], and every sequence of class k takes
exactly k pieces.  Since the cut pieces have their class's full length, a
full sequence wastes almost nothing.  Each partition fills its own sequences;
no rows move.  At its end the unfinished sequences of all classes are strung
together and cut again into whole sequences, and the last of these into
powers of two, which need no padding.

Sequence ids are the partition number in the upper bits and a counter in the
lower ones.  The partitions have to be read from a table, so that a task that
runs again sees the same rows.

Cases: a null or empty text is the end id alone; documents of any length and
repeated rows are packed as they come; a null id stays null; an empty table
gives an empty table; columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.bpe_words import WordIds, slices, word_ids

CAPACITY, END_ID, VOCABULARY = 2048, 1, "byte_bpe_50k.json"
#: Rests are cut to full class lengths up to this class.
FINE = 16
#: Bytes of text encoded, and given out as one batch, at a time.  What Arrow held for them goes back to the system
#: after each, since a worker's memory stays its own between tasks.
BATCH_BYTES = 1 << 20

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
          "class int")
SCHEMA = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}[t])
                    for n, t in (x.split() for x in PIECES.split(", "))])


def cut_lengths(n: int, capacity: int = CAPACITY, fine: int = FINE) -> list[int]:
    """Lengths of a document's pieces, in order."""
    whole, rest = divmod(n, capacity)
    out = [capacity] * whole
    while rest * fine >= capacity:
        k = -(-capacity // rest)
        piece = capacity // k
        out.append(piece)
        rest -= piece
    return out + [rest] * (rest > 0)


class Packer:
    """Sequences of one partition.  A piece is (doc, start, length, ids, total)."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, fine: int = FINE):
        self.next_id, self.capacity, self.fine = first_id, capacity, fine
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, doc: int | None, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        for n in cut_lengths(total, self.capacity, self.fine):
            k = self.capacity // n
            held = self.open.setdefault(k, [])
            held.append((doc, at, n, ids[4 * at:4 * (at + n)], total))
            at += n
            if len(held) == k:
                self._close(held, k)
                self.open[k] = []

    def _close(self, pieces: list[tuple], k: int) -> None:
        offset = 0
        for doc, start, n, ids, total in pieces:
            self.done.append((doc, start, n, ids, total, self.next_id, offset, k))
            offset += n
        self.next_id += 1

    def finish(self) -> None:
        """String the unfinished sequences together and cut them again."""
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        left = sum(p[2] for p in rest)
        self.open, held, room = {}, [], min(left, self.capacity)
        room = self.capacity if left >= self.capacity else 1 << max(0, left.bit_length() - 1)
        for doc, start, n, ids, total in rest:
            while n:
                take = min(n, room)
                held.append((doc, start, take, ids[:4 * take], total))
                start, n, ids, room, left = start + take, n - take, ids[4 * take:], room - take, left - take
                if not room:
                    self._close(held, 0)
                    held = []
                    room = self.capacity if left >= self.capacity else 1 << max(0, left.bit_length() - 1)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.done)) or [[]] * len(SCHEMA)
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def packed(batches: Iterator[pa.RecordBatch], words: WordIds, packer: Packer, end_id: int = END_ID
           ) -> Iterator[pa.RecordBatch]:
    """The pieces of one partition's (id, _text)."""
    end = np.array([end_id], "<u4").tobytes()
    for b in batches:
        texts = b.column("_text")
        for at, to in slices(pc.binary_length(texts).fill_null(0).to_numpy(), BATCH_BYTES):
            for doc, x in zip(b.column("id")[at:to].to_pylist(), words.encode(texts[at:to].fill_null(""))):
                packer.add(doc, x + end)
            yield packer.take()
            pa.default_memory_pool().release_unused()
    packer.finish()
    yield packer.take()


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, vocabulary: str | None = None, fine: int = FINE) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset, class).

    ``ids`` are little-endian 32-bit token ids; ``class`` is 0 for pieces of
    the strung-together rest.  ``vocabulary``: a tokenizer file, found on the
    workers by this path.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary or public_tokenizers.path(VOCABULARY))
        return packed(batches, words, Packer(TaskContext.get().partitionId() << 32, capacity, fine), end_id)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("_text")) \
        .mapInArrow(run, PIECES)

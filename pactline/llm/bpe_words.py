"""Token ids of texts, by the tokenizer's own ids of their words.

Byte-level BPE never merges across a single blank between two characters that
are no white space: the blank goes to the word behind it.  So the ids of a text
are those of its words, and a word met before need not be encoded again.  Arrow
splits a batch of texts and finds its distinct words; only these are looked up,
new ones are encoded many at a time and told apart by the byte lengths of their
ids, and the ids of the whole batch are gathered by index.  Texts with other
white space beside a blank are encoded whole.

The memory of words is bounded: it has two generations, and a word that is met
again moves from the older to the younger one.  It belongs to the Python
process (``word_ids``), so tasks that share a worker share what it learned.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words in a generation of the memory, and the longest word that is kept.
GENERATION, LONGEST_KEPT = 3 << 17, 64
#: New words encoded as one text.
TOGETHER = 256
#: Marks a word that cannot be told apart from its neighbours (never ids: not a multiple of four bytes).
ODD = b"?"


class WordIds:
    def __init__(self, path: str, generation: int = GENERATION):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()  # one character for each byte
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.generation = generation
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids, straight from the tokenizer."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word with a blank before it; a word that begins with a
        blank is one at a text's start and is encoded without that blank."""
        out = {w: ODD for w in words if not w or (w[0] != " " and w[0].isspace()) or (w[-1].isspace() and w[0] != " ")}
        starts = [w for w in words if w[:1] == " "]
        out.update(zip(starts, self.whole([w[1:] for w in starts])))
        words = [w for w in words if w not in out]
        groups = [words[at:at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        for group, flat in zip(groups, self.whole(["".join([" " + w for w in g]) for g in groups])):
            ends = np.cumsum([len(w.encode()) + 1 for w in group])
            cuts = np.searchsorted(np.cumsum(self.bytes_of[np.frombuffer(flat, "<u4")]), ends) + 1
            at = 0
            for w, cut in zip(group, (4 * cuts).tolist()):
                out[w] = flat[at:cut]
                at = cut
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        found = list(map(self.young.get, words))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            again = {words[i]: self.old[words[i]] for i in missing if words[i] in self.old}
            again.update(self._learn([words[i] for i in missing if words[i] not in again]))
            for i in missing:
                found[i] = again[words[i]]
            self.young.update((w, x) for w, x in again.items() if len(w) <= LONGEST_KEPT)
            if len(self.young) > self.generation:
                self.young, self.old = {}, self.young
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text of a string array without nulls."""
        if not len(texts):
            return []
        cut = pc.split_pattern(texts, " ")
        words, sizes = cut.flatten().dictionary_encode(), pc.list_value_length(cut).to_numpy()
        first = np.cumsum(sizes) - sizes
        codes, known = words.indices.to_numpy().astype(np.int32), words.dictionary.to_pylist()
        begins = [" " + known[c] for c in codes[first].tolist()]
        code_of = {w: len(known) + i for i, w in enumerate(dict.fromkeys(begins))}
        codes[first] = [code_of[w] for w in begins]
        ids = self._ids(known + list(code_of))
        sizes_of = np.array([len(x) >> 2 for x in ids], np.int32)
        pool = np.frombuffer(b"".join([x for x in ids if len(x) & 3 == 0]), "<u4")
        at = np.cumsum(sizes_of) - sizes_of
        n = sizes_of[codes]
        ends = np.cumsum(n, dtype=np.int64)
        flat = pool[np.repeat(at[codes] - (ends - n), n) + np.arange(ends[-1])].tobytes()
        odd = np.array([len(x) & 3 != 0 for x in ids])[codes]
        # a first word that ends in white space stands beside a blank too; an empty one has nothing before its blank
        white = np.array([w != " " and w[-1].isspace() for w in code_of])
        odd[first] |= white[codes[first] - len(known)] & (sizes > 1)
        by_hand = np.logical_or.reduceat(odd, first)
        to = (4 * ends[first + sizes - 1]).tolist()
        out = [flat[a:b] for a, b in zip([0, *to], to)]
        again = np.flatnonzero(by_hand).tolist()
        for i, x in zip(again, self.whole([texts[i].as_py() for i in again])):
            out[i] = x
        return out


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The process's own encoder for a tokenizer file."""
    return WordIds(path)


def slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of rows whose sizes sum to about ``most``, at least one row each."""
    ends, out, at = np.cumsum(sizes), [], 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        out.append((at, to))
        at = to
    return out

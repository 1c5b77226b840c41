"""Fill-in-middle transformation with a sparse exception index.

A text is cut twice and its middle part moved to the end, so that a model
reading left to right learns to fill gaps.  Cuts fall between units: words with
the white space before them (white space at the end is a unit of its own), or
single characters.  Texts stay UTF-8 bytes throughout.  For a whole batch of
texts, one index records only the multibyte characters: where each stands and
how many bytes it has beyond one.  A searchsorted in it turns positions in
characters into positions in bytes and back; a text of ASCII has no entries, and
its positions are the same in both.

Which form a document takes and where it is cut follows from SHA-256 of seed and
document id, so reruns and other partitions agree.  A text that holds one of the
marks stays plain; so every mark of another output is the transformation's
own, and ``restored`` finds the exact text again.

Cases: a null text counts as empty, and an empty text stays plain; a null id is
hashed as an empty string; repeated rows give equal rows; texts of any length are
cut as a whole; an empty table gives an empty table; columns besides id and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.llm.bpe_words import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, those that are transformed; of these, those whose suffix comes first.
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
#: Bytes of text handled at a time.
BATCH_BYTES = 1 << 23
OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                 ("middle_chars", pa.int64()), ("output", pa.string())])


class MultibyteIndex:
    """Positions and excess bytes of the multibyte characters of UTF-8 bytes."""

    def __init__(self, data: np.ndarray):
        self.byte_at = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte_at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(excess)])  # of the first k characters
        self.char_at = self.byte_at - self.excess[:-1]

    def chars(self, bytes_: np.ndarray) -> np.ndarray:
        """Characters before each byte position (which must start a character)."""
        return bytes_ - self.excess[np.searchsorted(self.byte_at, bytes_)] if len(self.byte_at) else bytes_

    def bytes(self, chars: np.ndarray) -> np.ndarray:
        """The byte position where each character starts."""
        return chars + self.excess[np.searchsorted(self.char_at, chars)] if len(self.byte_at) else chars


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array without nulls, and the bounds of its texts."""
    bounds = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)])
    begin = np.frombuffer(texts.buffers()[1], np.int32, 1, 4 * texts.offset)[0]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[begin:begin + bounds[-1]], bounds


def word_units(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(units of each text, where each unit ends), the ends over all texts."""
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    space = white[data]
    end = np.zeros(len(data), bool)  # bytes that end a unit: the last of a word, and the last of a text
    end[:-1] = ~space[:-1] & space[1:]
    end[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    ends = np.flatnonzero(end) + 1
    return np.diff(np.searchsorted(ends, bounds, "right")), ends


def char_units(index: MultibyteIndex, bounds: np.ndarray) -> np.ndarray:
    return np.diff(index.chars(bounds))


def cut_bytes(data: np.ndarray, bounds: np.ndarray, index: MultibyteIndex, h: np.ndarray, unit: str
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units, byte where the prefix ends, byte where the middle ends) of each
    text; ``h``: two rows of numbers that pick the cuts."""
    if unit == "word":
        n, ends = word_units(data, bounds)
        ends, first = np.concatenate([ends, [0]]), np.cumsum(n) - n
        at = [np.where(k == 0, bounds[:-1], ends[first + k - 1]) for k in np.sort(h % (n + 1), axis=0)]
    elif unit == "char":
        n = char_units(index, bounds)
        at = [index.bytes(index.chars(bounds[:-1]) + k) for k in np.sort(h % (n + 1), axis=0)]
    else:
        raise ValueError(f"no such unit: {unit}")
    return n, at[0], at[1]


def _transform(rate: int, suffix_first: int, unit: str):
    marks = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every = b.column("text").fill_null("")
            hashes = np.array([b.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4)])
            for at, to in slices(pc.binary_length(every).to_numpy(), BATCH_BYTES):
                texts, h = every[at:to], hashes[:, at:to]
                data, bounds = text_bytes(texts)
                index = MultibyteIndex(data)
                n, p, m = cut_bytes(data, bounds, index, h[:2], unit)
                shown = h[2] % 100 < rate
                sizes = (index.chars(p) - index.chars(bounds[:-1]), index.chars(m) - index.chars(p))
                raw, forms, outputs = data.tobytes(), [], []
                for start, i, j, end, keep, front in zip(*(x.tolist() for x in (
                        bounds[:-1], p, m, bounds[1:], shown, h[3] % 100 < suffix_first))):
                    text = raw[start:end]
                    if not keep or not text or any(x in text for x in marks):
                        forms.append("plain")
                        outputs.append(text)
                    elif front:
                        forms.append("spm")
                        outputs.append(b"".join((marks[1], raw[j:end], marks[0], raw[start:i], marks[2], raw[i:j])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((marks[0], raw[start:i], marks[1], raw[j:end], marks[2], raw[i:j])))
                plain = np.array([x == "plain" for x in forms])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[at:to], pa.array(n, pa.int64()), pa.array(forms),
                     *(pa.array(x, pa.int64(), mask=plain) for x in sizes),
                     pa.array(outputs, pa.binary()).cast(pa.string())], schema=OUT)
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                   suffix_first: int = SUFFIX_FIRST, unit: str = "word") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): one row per document.

    ``rate`` and ``suffix_first`` are percentages; ``unit`` is word or char.
    The two sizes are null for the plain form.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    numbers = [F.conv(F.substring("_d", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    return rows.withColumn("_d", digest).select("doc_id", "text", *numbers).mapInArrow(
        _transform(rate, suffix_first, unit),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, rebuilt from output and form alone."""
    out, kind = F.col(output), F.col(form)
    rest = F.lit(2**31 - 1)
    p, s, m = (F.instr(out, x) for x in (PREFIX, SUFFIX, MIDDLE))
    first = F.when(kind == "psm", s).otherwise(p)  # where the mark between the two outer parts stands
    one = F.substring(out, F.lit(len(PREFIX) + 1), first - len(PREFIX) - 1)
    two = F.substring(out, first + len(PREFIX), m - first - len(PREFIX))
    middle = F.substring(out, m + len(MIDDLE), rest)
    return F.when(kind == "psm", F.concat(one, middle, two)).when(kind == "spm", F.concat(two, middle, one)) \
        .otherwise(out)

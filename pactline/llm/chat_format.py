"""Formats conversation tables with a compiled chat template.

Rows of a conversation are brought together and ordered by a sort inside the
partitions; the template reads them as a stream and the text leaves in parts
of about PART_CHARS code points, so no conversation is held whole, however
many turns it has.

Cases: a null text or role counts as empty; null turns come first; equal
turns are ordered by role and text; rows with a null conversation id form one
conversation; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.chat_template import Template, unescape, unescape_line

START, END = "<|im_start|>", "<|im_end|>\n"

#: Only the texts of assistants are trained on; marks and roles are not.
CHAT = (
    "{% for m in messages %}"
    "<|im_start|>{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "<|im_end|>\n"
    "{% endfor %}"
)

PART_CHARS = 1 << 20
PARTS = "conv_id long, part long, formatted string, loss_spans array<struct<start:long,end:long>>"
READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _messages(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, dict]]:
    for b in batches:
        ids = b["conv_id"].astype("Int64")
        for c, gone, role, text in zip(ids, ids.isna(), b["role"], b["text"]):
            yield (None if gone else int(c)), {"role": role or "", "text": text or ""}


def format_conversations(df: DataFrame, template: str = CHAT, part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted text of every conversation of (conv_id, turn, role, text).

    One row per part: parts of a conversation are numbered from 0 and joined
    give its text; ``loss_spans`` are code point offsets inside the part.
    Parts come in order inside each partition.
    """
    compiled = Template(template)

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for conv, rows in groupby(_messages(batches), key=lambda x: x[0]):
            part, text, spans, at = 0, [], [], 0
            for piece, trained in compiled.stream(m for _, m in rows):
                if trained and piece:
                    spans.append({"start": at, "end": at + len(piece)})
                text.append(piece)
                at += len(piece)
                if at >= part_chars:
                    yield _part(conv, part, text, spans)
                    part, text, spans, at = part + 1, [], [], 0
            if text or not part:
                yield _part(conv, part, text, spans)

    def batched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for row in render(batches):
            held.append(row)
            size += len(row[2])
            if size >= part_chars:
                yield _frame(held)
                held, size = [], 0
        if held:
            yield _frame(held)

    thin = df.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = thin.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInPandas(batched, PARTS)


def _part(conv: int | None, part: int, text: list[str], spans: list[dict]) -> tuple:
    return conv, part, "".join(text), spans


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "part", "formatted", "loss_spans"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


class _Reader:
    """Reads one conversation back from its parts, holding one turn at most."""

    def __init__(self):
        self.turns, self.chars, self.loss_chars, self.rest = 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, spans: list) -> None:
        self.chars += len(text)
        for s in spans:
            own = unescape(text[s["start"]:s["end"]])
            self.loss_chars += len(own)
            self.loss.update(own.encode())
        buffer, at = self.rest + text, 0
        while (end := buffer.find(END, at)) >= 0:
            if not buffer.startswith(START, at):
                raise ValueError("a turn does not begin with its mark")
            role, _, said = buffer[at + len(START):end].partition("\n")
            self.all.update(f"{unescape_line(role)}\n{unescape(said)}\n".encode())
            self.turns += 1
            at = end + len(END)
        self.rest = buffer[at:]

    def row(self, conv: int | None) -> tuple:
        if self.rest:
            raise ValueError("text is left after the last turn")
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(parts: DataFrame) -> DataFrame:
    """Turn count, lengths and digests of conversations, from their text alone.

    Reads the parts in the order ``format_conversations`` leaves them in.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, reader, at = [], None, None
        for b in batches:
            ids = b["conv_id"].astype("Int64")
            for c, gone, text, spans in zip(ids, ids.isna(), b["formatted"], b["loss_spans"]):
                conv = None if gone else int(c)
                if reader is None or conv != at:
                    if reader is not None:
                        rows.append(reader.row(at))
                    reader, at = _Reader(), conv
                reader.add(text, spans)
            if len(rows) >= 4096:
                yield _read_frame(rows)
                rows = []
        if reader is not None:
            rows.append(reader.row(at))
        if rows:
            yield _read_frame(rows)

    return parts.mapInPandas(read, READ)


def _read_frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                      "formatted_chars"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out

"""Exact dedup with minimal perfect hashing over historical digests.

``build_index`` groups a corpus by the SHA-256 of its normalised text (A-Z
lower-cased, null as empty) and cuts the distinct digests into shards by
their first bytes.  Each shard gets a minimal perfect hash: level by level,
digests that alone hash to a bit of a bit array are placed there, the others
go on to the next level; the rank of the bit is the digest's slot.  A slot
holds the full digest, the locator of its winner and the number of copies.

``find_keepers`` looks distinct digests up in the index.  A slot is believed
only if its digest is equal byte for byte: then the text is a repeat of the
historical winner.  Digests that are no members are grouped among themselves.
Only digests travel; one digest, however many copies it has, is one row after
the map-side aggregation.

Cases: null ids sort below all others and are shown as null; of rows equal in
text and id exactly one stays; an empty table gives an empty table; columns
besides id and text are carried by ``drop_repeats`` (and order rows that are
equal in both) and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.llm.common import ascii_lower, block_count, in_row_order, keep_table

#: Digests per shard: one shard is built and read in one task.
SHARD = 1 << 16
#: Bits per digest of a level's bit array.
GAMMA = 2
NO_ID = -(1 << 63)

INDEX = "shard int, n long, seeds array<long>, levels array<binary>, digests binary, locators binary, copies binary"
FOUND = "sha string, keep long, copies long, member boolean"


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the normalised text."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def _shard(sha: Column, n: int) -> Column:
    return F.pmod(F.conv(F.substring(sha, 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sha) of every row, as a written table: texts are read once."""
    return keep_table(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                                  digest(F.col(text_col)).alias("sha")), "digests")


def _grouped(own: DataFrame) -> DataFrame:
    """(sha, keep, copies): one row per distinct text."""
    return own.groupBy("sha").agg(F.max("id").alias("keep"), F.count("*").alias("copies"))


# ---- the hash of one shard ---------------------------------------------------

def _words(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit position of each digest at a level."""
    x = words[:, 1] ^ (words[:, 2] + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x % np.uint64(size)).astype(np.int64)


def build_levels(digests: np.ndarray) -> list[np.ndarray]:
    """Bit arrays (as bytes of 0 and 1) of the distinct (n, 32) digests."""
    left, levels = _words(digests), []
    while len(left):
        size = max(8, GAMMA * len(left))
        at = _place(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def slots(digests: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each (n, 32) digest; -1 where it is surely no member."""
    words = _words(digests)
    out, left, base = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for i, bits in enumerate(levels):
        at = _place(words[left], i, len(bits))
        hit = bits[at]
        rank = np.cumsum(bits)
        out[left[hit]] = base + rank[at[hit]] - 1
        left, base = left[~hit], base + int(rank[-1])
    return out


def _bytes(shas: pd.Series) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(shas)), np.uint8).reshape(-1, 32)


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    digests = _bytes(rows["sha"])
    levels = build_levels(digests)
    at = slots(digests, levels)
    order = np.argsort(at)  # a permutation: every slot is taken once
    return pd.DataFrame([{
        "shard": key[0], "n": len(rows), "seeds": [len(b) for b in levels],
        "levels": [np.packbits(b).tobytes() for b in levels],
        "digests": digests[order].tobytes(),
        "locators": rows["keep"].to_numpy(np.int64)[order].tobytes(),
        "copies": rows["copies"].to_numpy(np.int64)[order].tobytes(),
    }])


def _look_up(rows: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Members get the slot's winner and copies, others keep their own."""
    if rows.empty:
        return pd.DataFrame({"sha": [], "keep": [], "copies": [], "member": []})
    keep, copies = rows["keep"].to_numpy(np.int64).copy(), rows["copies"].to_numpy(np.int64).copy()
    member = np.zeros(len(rows), bool)
    if len(index):
        shard, digests = index.iloc[0], _bytes(rows["sha"])
        levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
                  for b, n in zip(shard["levels"], shard["seeds"])]
        at = slots(digests, levels)
        held = np.frombuffer(shard["digests"], np.uint8).reshape(-1, 32)
        member = (at >= 0) & (held[np.maximum(at, 0)] == digests).all(axis=1)
        keep[member] = np.frombuffer(shard["locators"], np.int64)[at[member]]
        copies[member] = np.frombuffer(shard["copies"], np.int64)[at[member]]
    return pd.DataFrame({"sha": rows["sha"].to_numpy(), "keep": keep, "copies": copies, "member": member})


# ---- the operator --------------------------------------------------------------

def build_index(history: DataFrame, shard: int = SHARD) -> DataFrame:
    """The index of a corpus, given by its ``digests``: one row per shard."""
    groups = keep_table(_grouped(history), "history-digests")
    n = block_count(groups.count(), shard)
    sharded = groups.withColumn("shard", _shard(F.col("sha"), n))
    return keep_table(sharded.groupBy("shard").applyInPandas(_build_shard, INDEX).withColumn("shards", F.lit(n)),
                      "digest-index")


def find_keepers(own: DataFrame, index: DataFrame) -> DataFrame:
    """(sha, keep, copies, member): one row per distinct text of ``digests``.

    Members of the index get the historical winner and its known copies;
    the rest is grouped among itself.
    """
    first = index.select("shards").first()
    n = first["shards"] if first else 1
    groups = _grouped(own).withColumn("shard", _shard(F.col("sha"), n))
    return groups.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up, FOUND)


def _shown_id(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def dedup_report(own: DataFrame, index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256, repeat) for each of ``digests``.

    ``repeat``: the text is in the index.  The join on the digest has one side
    with one row per digest, so a text with many copies can be split.  Of rows
    that equal the winner's id and text one is kept; only these are ranked.
    """
    found = keep_table(find_keepers(own, index), "digest-keepers")
    marked = own.join(found, "sha").withColumn("winner", F.col("id") == F.col("keep"))
    rank = F.row_number().over(Window.partitionBy("sha", "id").orderBy("id"))
    every = marked.where("winner").withColumn("kept", rank == 1).unionByName(
        marked.where("not winner").withColumn("kept", F.lit(False)))
    return every.select(_shown_id("id").alias(id_col), _shown_id("keep").alias("keep_id"),
                        F.col("copies").alias("group_size"), "kept", F.col("sha").alias("text_sha256"),
                        F.col("member").alias("repeat"))


def drop_repeats(docs: DataFrame, own: DataFrame, index: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ``own``: their digests.

    Rows meet their keeper on (digest, id), so copies of one text spread over
    the tasks by their ids.  Of rows alike in both, the first by the columns
    stays (columns with maps are not looked at).
    """
    keepers = find_keepers(own, index).select(F.col("sha").alias("_sha"), F.col("keep").alias("_id"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
                       digest(F.col(text_col)).alias("_sha"), F.struct("*").alias("row"))
    same = Window.partitionBy("_sha", "_id").orderBy(*in_row_order(docs))
    kept = rows.join(keepers, ["_sha", "_id"], "left_semi").withColumn("_n", F.row_number().over(same))
    return kept.where("_n = 1").select("row.*")

"""Shards by minimax contiguous partition.

Documents of equal text form one group, which no cut divides; groups stand in the order of a hash
of their text. The smallest capacity such that the groups, taken in order, fill at most the given
number of shards is found by binary search with a greedy check.

The driver never sees all groups. It holds sums over ranges of hashes, and only ranges through
which a cut can pass are split further, until the bounds of the capacity meet: with every range
taken as one group the search gives an upper bound, with ranges that can be cut anywhere a lower
one. A level splits a few ranges per cut into ``2**LEVEL_BITS`` each.

Null and empty texts have size 1 and are one group. Two texts of one hash share a group, which
keeps every promise. A group larger than all else makes the capacity its own size. Repeated rows
are rows like others; an empty table gives an empty result. Null ids are numbered like others.
Only id and text are read, so further columns do no harm and do not appear in the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

LEVEL_BITS = 12
ROWS_PER_PIECE = 200_000  # rows numbered by one task
LEAST_PIECES = 64         # of each shard


@dataclass(frozen=True)
class Ranges:
    """Sums over consecutive ranges of keys. ``starts`` is each one's first possible key; a
    range is ``whole`` if all its rows have one key; ``bits`` is the depth of its prefix."""

    starts: np.ndarray
    sizes: np.ndarray
    whole: np.ndarray
    bits: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id, ``size`` in bytes plus one, ``text_crc32`` and the ``_key`` of its
    group."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        id_col, (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_key"))


def _sums(rows: DataFrame, bits: int) -> Ranges:
    """The ranges of rows by the first ``bits`` bits of their keys."""
    got = (rows.groupBy(F.shiftright("_key", 64 - bits).alias("p"))
           .agg(F.sum("size").alias("s"), (F.min("_key") == F.max("_key")).alias("w"))
           .toPandas().sort_values("p"))
    return Ranges(got["p"].to_numpy(np.int64) << np.int64(64 - bits), got["s"].to_numpy(np.int64),
                  got["w"].to_numpy(bool), np.full(len(got), bits))


def cuts_at(ends: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """The greedy cuts (indexes into ``ends``) for a capacity; None if it is too small."""
    at, cuts = 0, []
    for _ in range(shards):
        at = int(np.searchsorted(ends, ends[at] + capacity, "right")) - 1
        cuts.append(at)
        if at == len(ends) - 1:
            return cuts
    return None


def _flows(ranges: Ranges, ends: np.ndarray, capacity: int, shards: int) -> bool:
    """Whether the capacity would do if all but the whole ranges could be cut anywhere."""
    x = 0
    for _ in range(shards):
        x += capacity
        if x >= ends[-1]:
            return True
        at = int(np.searchsorted(ends, x, "right")) - 1
        if ranges.whole[at]:
            x = int(ends[at])
    return False


def _smallest(low: int, high: int, good) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if good(middle) else (middle + 1, high)
    return low


def minimax(rows: DataFrame, shards: int) -> tuple[int, Ranges]:
    """The smallest capacity for rows of ``_key`` and ``size``, and ranges fine enough to cut."""
    ranges = _sums(rows, LEVEL_BITS)
    if not len(ranges.sizes):
        return 0, ranges
    while True:
        ends = ranges.ends
        total = int(ends[-1])
        least = max(-(-total // shards), int(ranges.sizes[ranges.whole].max(initial=1)))
        upper = _smallest(least, total, lambda c: cuts_at(ends, c, shards) is not None)
        lower = _smallest(least, upper, lambda c: _flows(ranges, ends, c, shards))
        if lower == upper:
            return upper, ranges
        # Where a cut can be for any capacity between the bounds.
        touched, low, high = np.zeros(len(ranges.sizes), bool), 0, 0
        for _ in range(shards - 1):
            reach = int(np.searchsorted(ends, low + lower, "right")) - 1
            low = max(low, int(ends[min(reach, len(ends) - 1)]))
            high = min(high + upper, total)
            touched |= (ends[:-1] <= high) & (ends[1:] > low)
        touched &= ~ranges.whole
        if not touched.any():
            return upper, ranges
        bits = int(ranges.bits[touched].min())
        touched &= ranges.bits == bits
        prefixes = [int(s) >> (64 - bits) for s in ranges.starts[touched]]
        finer = _sums(rows.where(F.shiftright("_key", 64 - bits).isin(prefixes)),
                      min(64, bits + LEVEL_BITS))
        merged = [np.concatenate([getattr(ranges, n)[~touched], getattr(finer, n)])
                  for n in ("starts", "sizes", "whole", "bits")]
        order = np.argsort(merged[0], kind="stable")
        ranges = Ranges(*(m[order] for m in merged))


def even_cuts(ranges: Ranges, capacity: int, shards: int) -> list[int]:
    """First keys of the shards after the first: none above the capacity, and each as near to an
    equal share of what is left as the capacity allows for the shards that follow."""
    ends = ranges.ends
    total, at, keys = int(ends[-1]), 0, []
    for left in range(shards, 1, -1):
        most = int(np.searchsorted(ends, ends[at] + capacity, "right")) - 1
        # What follows must fit: a binary search, for a later cut leaves less to fit.
        fits = _smallest(at, most, lambda c, n=left: cuts_at(
            ends[c:] - ends[c], capacity, n - 1) is not None)
        share = ends[at] + (total - ends[at]) / left
        near = int(np.searchsorted(ends, share))
        if near > at and (near == len(ends) or share - ends[near - 1] <= ends[near] - share):
            near -= 1
        at = min(max(near, fits), most)
        keys.append(int(ranges.starts[at]) if at < len(ranges.starts) else None)
    return keys


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per document: its id, ``size``, ``text_crc32``, ``shard`` and ``slot``, the number of the
    document within its shard."""
    rows = stored(sized(docs, id_col, text_col), "shard-sizes")
    capacity, ranges = minimax(rows, shards)
    shard = F.lit(0)
    for key in even_cuts(ranges, capacity, shards) if capacity else []:
        if key is not None:
            shard = shard + (F.col("_key") >= F.lit(key)).cast("int")
    # Pieces of a shard are numbered apart: any group of copies is spread over them by id.
    pieces = max(LEAST_PIECES, -(-rows.count() // (shards * ROWS_PER_PIECE)))
    rows = rows.withColumn("shard", shard).withColumn(
        "_piece", F.pmod(F.xxhash64(id_col, "_key"), F.lit(pieces)))
    earlier = Window.partitionBy("shard").orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, -1)
    before = (rows.groupBy("shard", "_piece").count()
              .select("shard", "_piece",
                      F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before")))
    within = Window.partitionBy("shard", "_piece").orderBy("_key", id_col)
    return (rows.withColumn("_number", F.row_number().over(within))
            .join(before, ["shard", "_piece"])
            .select(id_col, "size", "text_crc32", "shard",
                    (F.col("_before") + F.col("_number") - 1).cast("bigint").alias("slot")))


def write_shards(docs: DataFrame, assigned: DataFrame, folder: str,
                 id_col: str = "doc_id") -> None:
    """The documents in one folder per shard. Ids must be unique here."""
    (docs.join(assigned.select(id_col, "shard", "slot"), id_col)
     .write.partitionBy("shard").parquet(folder))


def report(assigned: DataFrame) -> DataFrame:
    """``assigned`` with its law; it has no shard for one more, as cuts move when one is added."""
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))

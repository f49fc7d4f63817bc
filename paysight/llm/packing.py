"""Best-fit packing of token sequences into several permitted lengths.

Documents longer than the longest permitted length are cut into parts of that length; every token is
packed. Parts are dealt by digest into groups of a bounded number, and each group is packed on its
own: longest parts first, each into the fullest open bin that takes it. Where none does, a bin is
opened whose size costs least per token once the parts still to come are filled in greedily, so the
permitted lengths are weighed against each other for every new bin. At the end each bin shrinks to the
cheapest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table

# Permitted lengths and what a bin of each costs: its tokens and a fixed share for starting one.
LENGTHS = (512, 1024, 2048, 4096)
BIN_OVERHEAD = 32
GROUP_PARTS = 20_000  # parts packed together, about
LOOK_AHEAD = 8  # parts that the estimate fills in

# A word: ASCII letters and digits and everything beyond ASCII.
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

OUT = "doc_id string, part int, start long, length int, bin_id string, capacity int, offset int"


def bin_cost(capacity: int) -> int:
    return capacity + BIN_OVERHEAD


def cheapest_size(first: int, lengths: list[int], left: list[int], capacities: tuple[int, ...]) -> int:
    """The capacity of least cost per token for a bin that starts with ``first`` tokens.

    ``lengths`` are the distinct lengths still to come, ascending, of which ``left`` parts remain each.
    """
    best = None
    for capacity in capacities:
        if capacity < first:
            continue
        filled, room, k, steps = first, capacity - first, len(lengths), 0
        while room and steps < LOOK_AHEAD:
            k = bisect_left(lengths, room + 1, 0, k) - 1
            if k < 0:
                break
            take = min(left[k], room // lengths[k]) if lengths[k] else 0
            filled += take * lengths[k]
            room -= take * lengths[k]
            steps += 1
        price = (bin_cost(capacity) / max(1, filled), capacity)
        best = min(best, price) if best else price
    return best[1]


def pack(lengths: list[int], capacities: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin, offset of each length, and the bins' final capacities. Every length must fit the largest."""
    capacities = tuple(sorted(capacities))
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    distinct, counts = (x.tolist() for x in np.unique(np.array(lengths, np.int64), return_counts=True))
    place = {n: k for k, n in enumerate(distinct)}
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    filled: list[int] = []
    opened: list[int] = []
    rooms: list[tuple[int, int]] = []  # (room left, bin) of the open bins, ascending
    for i in order:
        n = lengths[i]
        counts[place[n]] -= 1
        k = bisect_left(rooms, (n, -1))
        if k < len(rooms):
            _, b = rooms.pop(k)
        else:
            b = len(filled)
            filled.append(0)
            opened.append(cheapest_size(n, distinct[: place[n] + 1], counts, capacities))
        bins[i], offsets[i] = b, filled[b]
        filled[b] += n
        if opened[b] > filled[b]:
            insort(rooms, (opened[b] - filled[b], b))
    final = [min((c for c in capacities if c >= n), key=bin_cost) for n in filled]
    return bins, offsets, final


def pack_documents(
    docs: DataFrame,
    length_col: str,
    id_col: str = "doc_id",
    capacities: tuple[int, ...] = LENGTHS,
    group_parts: int = GROUP_PARTS,
) -> DataFrame:
    """(doc_id, part, start, length, bin_id, capacity, offset): one row per part of every row of ``docs``.

    Parts of one row follow each other from token ``start``. A null or negative length counts as 0; such a row
    keeps one part of length 0. Null ids are packed too. Repeated rows are packed as often as they
    come. The bins of a group depend only on its rows, never on their order or on the partitions.
    """
    longest = max(capacities)
    total = F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(0)), F.lit(0))
    last = F.greatest(F.ceil(total / longest) - 1, F.lit(0)).cast("int")
    # ids travel as text: pandas would turn longs into doubles where one is null
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), total.alias("total"), last.alias("last"))
    # the lengths are worked out once, though they are read to size the groups and again to fill them
    rows = Scratch(docs.sparkSession, "packing").write(rows, "lengths")
    n = rows.agg(F.sum(F.col("last") + 1)).first()[0] or 0
    groups = int(n) // group_parts + 1
    parts = rows.select("doc_id", "total", F.explode(F.sequence(F.lit(0), "last")).alias("part"))
    start = F.col("part").cast("long") * longest
    parts = parts.select(
        "doc_id", "part", start.alias("start"), F.least(F.col("total") - start, F.lit(longest)).cast("int").alias("length"),
        F.pmod(F.xxhash64("doc_id", "part", "total"), F.lit(groups)).alias("pack_group"),
    )

    def one_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "part"], ascending=[False, True, True], ignore_index=True)
        bins, offsets, final = pack(pdf["length"].tolist(), capacities)
        pdf["bin_id"] = [f"{key[0]}-{b}" for b in bins]
        pdf["capacity"] = [final[b] for b in bins]
        pdf["offset"] = offsets
        return pdf[["doc_id", "part", "start", "length", "bin_id", "capacity", "offset"]]

    packed = parts.groupBy("pack_group").applyInPandas(one_group, OUT)
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))


def word_lengths(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``: the words of its text and one end mark; 1 for null and empty texts."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD))
    return docs.withColumn("n_words", words + 1)


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(word_lengths(table(spark, sf_dir, "documents").select("doc_id", "text")), "n_words")

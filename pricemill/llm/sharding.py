"""Minimax contiguous partition of documents into shards of near equal bytes.

Documents with equal texts form an atomic group.  Groups are ordered by the SHA-256 of their text, and the ordered
group sizes are cut into contiguous shards so that the largest shard is as small as it can be.  The smallest feasible
capacity is found by binary search with a greedy check.  The groups stay distributed: the driver holds the sizes of
cells (ranges of hashes) only, and splits those cells further in which a cut can fall.  What it holds is bounded by
the number of shards, whatever the number of groups.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from pricemill.llm.common import chunks_for, keep, running_total

FIRST_DIGITS = 3  # 4,096 cells at first
MORE_DIGITS = 2  # a cell is split into 256
HEAVY = 64  # cells above 1/64 of the capacity are split before cuts are looked for


class Cells:
    """Ordered ranges of group keys: total size, largest group and whether a range is a single group."""

    def __init__(self, rows):
        self.rows = sorted(rows)  # (prefix, size, largest group, groups)
        self.ends = list(accumulate(r[1] for r in self.rows))
        self.total = self.ends[-1] if self.ends else 0

    def fluid_end(self, start: int, capacity: int) -> int:
        """Where a greedy shard ends at most: a range of several groups may be cut anywhere."""
        i = bisect_right(self.ends, start + capacity)
        if i == len(self.rows) or self.rows[i][3] > 1:
            return min(start + capacity, self.total)
        return max(start, self.ends[i - 1] if i else 0)

    def whole_end(self, start: int, capacity: int) -> int:
        """Where a greedy shard ends if ranges are never cut."""
        i = bisect_right(self.ends, start + capacity)
        return max(start, self.ends[i - 1] if i else 0)

    def feasible(self, capacity: int, shards: int, end) -> bool:
        at = 0
        for _ in range(shards):
            at = end(at, capacity)
            if at >= self.total:
                return True
        return False

    def smallest(self, shards: int, end) -> int:
        low, high = max([-(-self.total // shards), *(r[2] for r in self.rows)]), self.total
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle, shards, end):
                high = middle
            else:
                low = middle + 1
        return low

    def ends_of(self, capacity: int, shards: int, end) -> list[int]:
        out = [0]
        for _ in range(shards):
            out.append(end(out[-1], capacity))
        return out[1:]


def _open_cells(cells: Cells, shards: int) -> list[str]:
    """Prefixes of the ranges that have to be split before the capacity and its cuts are certain."""
    low, high = cells.smallest(shards, cells.fluid_end), cells.smallest(shards, cells.whole_end)
    heavy = [r[0] for r in cells.rows if r[3] > 1 and r[1] > low / HEAVY]
    if heavy or low == high:
        return heavy if low < high else []
    found = set()
    starts = [0, *cells.ends]
    for first, last in zip(
        cells.ends_of(low, shards, cells.whole_end), cells.ends_of(high, shards, cells.fluid_end), strict=True
    ):
        i = max(0, bisect_right(starts, first) - 1)
        while i < len(cells.rows) and starts[i] <= last:
            if cells.rows[i][3] > 1:
                found.add(cells.rows[i][0])
            i += 1
    return sorted(found)


def _cuts(cells: Cells, shards: int) -> list[str]:
    """First prefix of shards 1, 2, ...: within the smallest capacity, as near to equal sizes as that allows."""
    if not cells.rows:
        return []
    capacity = cells.smallest(shards, cells.whole_end)
    starts = [0, *cells.ends]
    earliest = [cells.total]  # from the right: where the last shards can begin at the earliest
    for _ in range(shards - 1):
        earliest.append(starts[bisect_left(starts, earliest[-1] - capacity)])
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        last = cells.whole_end(at, capacity)
        ideal = at + (cells.total - at) / (left + 1)
        i = bisect_left(starts, ideal)
        near = min(starts[max(0, i - 1) : i + 1], key=lambda x: abs(x - ideal))
        at = min(max(near, at, earliest[left]), last)
        i = bisect_left(starts, at)
        cuts.append(cells.rows[i][0] if i < len(cells.rows) else "g")  # "g" sorts after every hex digit
    return cuts


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[list[str], int]:
    """Cut keys (shard i + 1 begins at cut i) and the smallest capacity for ``groups(key: hex string, weight: long)``."""

    def cells_of(df: DataFrame, digits: int):
        return [tuple(r) for r in df.groupBy(F.substring("key", 1, digits).alias("cell")).agg(
            F.sum("weight"), F.max("weight"), F.count(F.lit(1))).collect()]

    digits = FIRST_DIGITS
    cells = Cells(cells_of(groups, digits))
    while open_cells := _open_cells(cells, shards):
        closed = [r for r in cells.rows if r[0] not in set(open_cells)]
        by_length: dict[int, list[str]] = {}
        for prefix in open_cells:
            by_length.setdefault(len(prefix), []).append(prefix)
        for length, prefixes in by_length.items():
            inside = groups.where(F.substring("key", 1, length).isin(prefixes))
            closed += cells_of(inside, length + MORE_DIGITS)
        cells = Cells(closed)
    return _cuts(cells, shards), cells.smallest(shards, cells.whole_end) if cells.rows else 0


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its shard and its slot in the shard.

    Size is the text's UTF-8 bytes plus 1.  A null text counts as empty: size 1, CRC 0, one group with the empty texts.
    Rows with equal texts, repeated rows included, share a shard; a repeated doc_id is placed like any other row.  An
    empty table gives an empty result; further columns of ``docs`` are ignored.  Slots count 0, 1, ... within a shard.
    """
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(
        F.col("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"), F.sha2(text, 256).alias("key"),
    )
    groups = keep(sized.groupBy("key").agg(F.sum("size").alias("weight")))
    cuts, _ = minimax_cuts(groups, shards)
    shard = sum(((F.col("key") >= cut).cast("int") for cut in cuts), F.lit(0))
    placed = running_total(
        sized.withColumn("shard", shard.cast("int")), F.lit(1), "shard",
        [F.col("doc_id"), F.col("key"), F.col("size")], chunks_for(docs.count()), "doc_id", "slot", "_at",
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

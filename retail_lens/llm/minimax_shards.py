"""Shards of contiguous groups with the smallest possible largest shard.

Equal texts form one atomic group; groups are ordered by the 63-bit hash of their text.
The smallest capacity for which a greedy walk over the ordered group sizes needs no more
shards than given is found by binary search, and the order is cut there.

The walk runs over a summary: sums of group sizes by leading hash bits. Where a summary
segment holds several groups, the true cut may lie inside, so each walk is done once with
known boundaries only (what is certainly feasible) and once with a cut anywhere inside such
a segment (what may be feasible). While the two smallest capacities differ, the segments
in which a cut may fall are split into 64 by one more aggregation over the groups. A few
rounds give the exact minimum; the driver sees segments, some tens of thousands at most
for 40 shards whatever the number of groups, never groups or documents.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.llm.common import running_sum, staging

BITS, FIRST_BITS, MORE_BITS = 63, 12, 6


class Segment(NamedTuple):
    """Groups whose keys agree in all but the last ``shift`` bits."""

    low: int
    shift: int
    size: int
    groups: int

    @property
    def open(self) -> bool:
        return self.groups > 1 and self.shift > 0


def _summary(groups: DataFrame, shift: int) -> list[Segment]:
    rows = groups.groupBy(F.shiftrightunsigned("group", shift).alias("p")).agg(F.sum("size"), F.count(F.lit(1)))
    return [Segment(p << shift, shift, size, n) for p, size, n in rows.collect()]


def _refined(groups: DataFrame, segments: list[Segment], chosen: set[int]) -> list[Segment]:
    """Split the chosen segments; one aggregation per level of fineness among them."""
    out = [s for i, s in enumerate(segments) if i not in chosen]
    for shift in {segments[i].shift for i in chosen}:
        prefixes = [segments[i].low >> shift for i in chosen if segments[i].shift == shift]
        part = groups.filter(F.shiftrightunsigned("group", shift).isin(prefixes))
        out += _summary(part, max(0, shift - MORE_BITS))
    return sorted(out)


def _walk(starts: list[int], segments: list[Segment], capacity: int, shards: int, hopeful: bool) -> list[int]:
    """Positions in bytes after each greedily filled shard. ``starts`` ends with the total."""
    at, path = 0, []
    for _ in range(shards):
        goal = at + capacity
        if goal >= starts[-1]:
            path.append(starts[-1])
            break
        i = bisect_right(starts, goal) - 1
        at = goal if hopeful and segments[i].open else max(at, starts[i])
        path.append(at)
    return path


def _least(low: int, high: int, feasible) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def smallest_capacity(groups: DataFrame, shards: int) -> tuple[int, list[Segment]]:
    """The least feasible capacity and a summary on whose boundaries it is reached.

    ``groups`` has one row per atomic group: group (its key, below 2**63) and size.
    """
    segments = sorted(_summary(groups, BITS - FIRST_BITS))
    largest = groups.agg(F.max("size")).first()[0] or 0
    total = sum(s.size for s in segments)
    bound = max(-(-total // shards), largest)
    while True:
        starts = [0, *accumulate(s.size for s in segments)]
        reaches = lambda c, hope: _walk(starts, segments, c, shards, hope)[-1] == total  # noqa: E731, B023
        sure = _least(bound, bound + max((s.size for s in segments), default=0), lambda c: reaches(c, False))
        hoped = _least(bound, sure, lambda c: reaches(c, True))
        if hoped == sure:
            return sure, segments
        low, high = _walk(starts, segments, hoped, shards, False), _walk(starts, segments, sure, shards, True)
        chosen: set[int] = set()
        for a, b in zip([0, *low], [0, *high], strict=False):
            i, j = (bisect_right(starts, x) - 1 for x in (a + hoped, b + sure))
            chosen.update(k for k in range(i, min(j, len(segments) - 1) + 1) if segments[k].open)
        bound = hoped
        segments = _refined(groups, segments, chosen)


def even_cuts(segments: list[Segment], capacity: int, shards: int) -> list[int]:
    """Keys at which shards 1, 2, ... begin: shards of near equal size, none above ``capacity``.

    Each cut is the boundary nearest to an equal share of what is left, among those that
    leave a rest for which the capacity still suffices.
    """
    starts = [0, *accumulate(s.size for s in segments)]
    needed = [starts[-1]]  # by shards left: the first boundary from which they suffice
    for _ in range(shards - 1):
        needed.append(starts[bisect_left(starts, needed[-1] - capacity)])
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        first = bisect_left(starts, max(at, needed[left]))
        last = bisect_right(starts, at + capacity) - 1
        share = at + (starts[-1] - at) / (left + 1)
        after = min(max(bisect_left(starts, share), first), last)
        before = min(max(after - 1, first), last)
        i = min(before, after, key=lambda k: (abs(starts[k] - share), k))
        at = starts[i]
        if i < len(segments):
            cuts.append(segments[i].low)
    return cuts


def group_key(text: Column) -> Column:
    """63-bit hash by which texts are ordered; all null texts share one key."""
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def shard(docs: DataFrame, shards: int = 40, overhead: int = 16, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard.

    The size is the UTF-8 bytes of the text plus ``overhead``. The law is ``bytes``: no other
    cut of the ordered groups has a smaller largest shard, and below that the shards are as
    even as the groups allow. Equal texts share a shard; a group above an equal share
    stands alone or nearly. A null text has the bytes of an empty one, a null crc, and all
    null texts form a group. ``slot`` numbers the rows of a shard without gaps, in the order of a hash of key
    and text; rows equal in both are interchangeable. An empty table gives no rows; other
    columns are not read.
    """
    stage = staging(docs.sparkSession)
    items = stage(
        docs.select(
            F.col(key).alias("doc"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(F.col(text).cast("binary")).alias("crc"),
            group_key(F.col(text)).alias("group"),
        ),
        "items",
    )
    groups = stage(items.groupBy("group").agg(F.sum("size").alias("size")), "groups")
    cuts = even_cuts(*reversed(smallest_capacity(groups, shards)), shards)
    number = sum(((F.col("group") >= cut).cast("int") for cut in cuts), F.lit(0))
    placed = items.select("*", number.alias("shard"), F.xxhash64("doc", "group").alias("place"), F.lit(1).alias("one"))
    return running_sum(placed, ["shard"], "place", ["doc", "group"], "one", "slot").select(
        F.col("doc").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

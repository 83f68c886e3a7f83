"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is a stream of words: its documents in the order of a seeded hash, repeated
as often as its target asks. The stream is cut into blocks of equal length, so a target
becomes an exact quota of blocks. A tree over the output shards splits the quotas: at each
node the left half of its shards gets its exact number of blocks, drawn from the node's
blocks without replacement (multivariate hypergeometric), the right half gets the rest.
So all shards are equally long, each source's quota is met exactly, and the shards differ in
composition as random draws do. A shard then takes a run of its source's permuted blocks
and lists its blocks in the order of a hash.

The driver holds one row per source and its block counts per shard, no documents.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.llm.common import running_sum, staging, word_count

#: With more blocks than this the blocks are made longer.
MOST_BLOCKS = 100_000_000
#: Up to so many sources (checked) their table is broadcast.
FEW_SOURCES = 10_000


def targets(sizes: Sequence[int], weights: Sequence[float], limit: float) -> list[float]:
    """Shares of all sizes by weight, none above ``limit`` times its own size; the excess is shared anew."""
    out: dict[int, float] = {}
    while len(out) < len(sizes):
        free = [i for i in range(len(sizes)) if i not in out]
        rest, weight = sum(sizes) - sum(out.values()), sum(weights[i] for i in free)
        above = [i for i in free if rest * weights[i] / weight > limit * sizes[i]]
        out |= {i: float(limit * sizes[i]) for i in above}
        if not above:
            out |= {i: rest * weights[i] / weight for i in free}
    return [out[i] for i in range(len(sizes))]


def _draw(counts: list[int], n: int, rng) -> list[int]:
    """``n`` of the counted items without replacement, as counts."""
    out, left = [], sum(counts)
    for count in counts:
        left -= count
        got = int(rng.hypergeometric(count, left, n)) if n and count else 0
        out.append(got)
        n -= got
    return out


def split(quotas: list[int], shards: int, seed: int) -> list[list[int]]:
    """Blocks of each source in each shard. Shards differ by one block at most in total."""
    import numpy as np

    total = sum(quotas)
    upto = [i * total // shards for i in range(shards + 1)]

    def node(counts: list[int], first: int, last: int) -> list[list[int]]:
        if last - first == 1:
            return [counts]
        middle = (first + last) // 2
        left = _draw(counts, upto[middle] - upto[first], np.random.default_rng((seed, first, last)))
        return node(left, first, middle) + node([a - b for a, b in zip(counts, left, strict=True)], middle, last)

    return node(quotas, 0, shards)


class _Plan(NamedTuple):
    source: str | None
    number: int
    source_size: int
    target: float
    words: int
    blocks: int
    factor: int
    shift: int
    upto: list[int]


def plan(
    sizes: list[tuple[str | None, int]], weights: Sequence[float], limit: float, shards: int, block: int, seed: int
) -> list[_Plan]:
    """What each source gives, sources by code point and null last."""
    sizes = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    aims = targets([n for _, n in sizes], [weights[i % len(weights)] for i in range(len(sizes))], limit)
    words = [min(round(aim), int(limit * n)) for aim, (_, n) in zip(aims, sizes, strict=True)]
    quotas = [-(-w // block) for w in words]
    parts = split(quotas, shards, seed)
    out = []
    for i, ((source, n), aim) in enumerate(zip(sizes, aims, strict=True)):
        rng = random.Random(f"{seed}:{i}")
        factor = rng.randrange(1, quotas[i] + 1) if quotas[i] else 1
        while math.gcd(factor, quotas[i] or 1) > 1:
            factor = factor % quotas[i] + 1
        upto = [sum(p[i] for p in parts[: k + 1]) for k in range(shards)]
        out.append(_Plan(source, i, n, aim, words[i], quotas[i], factor, rng.randrange(quotas[i] or 1), upto))
    return out


def _row_key(key: str, text: str, seed: int) -> tuple[Column, Column]:
    """Two hashes that stand for a row's key and text."""
    return F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.xxhash64(F.lit(-seed), F.col(text), F.col(key))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    limit: float = 3,
    shards: int = 16,
    block_words: int = 4096,
    seed: int = 7,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, taken and ``pieces``.

    A document's size is its number of words; a null text has none. Sources, by code point and null last,
    weigh ``weights`` in turn and share the sum of all sizes; a target is at most ``limit``
    times the source's size. ``pieces`` lists where the document's words go: copy, shard,
    place (order within the shard), block, first word and number of words; one document a
    source may be cut at the end of the last block. ``taken`` sums their words, repeats
    counted: over a source it is the target, rounded. Documents without words have no
    pieces. The result depends on the rows and the seed alone; rows equal in key and text are
    interchangeable. An empty table gives no rows; other columns are not read.
    """
    stage = staging(docs.sparkSession)
    one, two = _row_key(key, text, seed)
    read = docs.select(
        F.col(key).alias("doc"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        one.alias("h"),
        two.alias("check"),
    )
    items = stage(read, "items")
    sizes = [tuple(r) for r in items.groupBy("source").agg(F.sum("size")).collect()]
    block = max(block_words, -(-sum(n for _, n in sizes) // MOST_BLOCKS))
    rows = plan(sizes, weights, limit, shards, block, seed)
    schema = (
        "name string, number int, source_size long, target double, words long, blocks long, factor long, shift long,"
        " upto array<long>"
    )
    plans = docs.sparkSession.createDataFrame(rows, schema)
    if len(rows) <= FEW_SOURCES:
        plans = F.broadcast(plans)
    known = items.join(plans, F.col("source").eqNullSafe(F.col("name")))
    numbered = known.select("doc", "size", "h", "check", "number", "source")
    placed = running_sum(numbered, ["number"], "h", ["check", "doc", "size"], "size", "start")
    laid = placed.join(plans.drop("name"), "number")

    begin = lambda copy: copy * F.col("source_size") + F.col("start")
    end = lambda copy: F.least(begin(copy) + F.col("size"), F.col("words"))
    permuted = lambda b: (b * F.col("factor") + F.col("shift")) % F.col("blocks")

    def piece(copy, b):
        first = F.greatest(begin(copy), b * block)
        return F.struct(
            copy.cast("int").alias("copy"),
            F.size(F.filter("upto", lambda u: u <= permuted(b))).alias("shard"),
            F.xxhash64(F.lit(seed), F.col("number"), b).alias("place"),
            b.alias("block"),
            (first - begin(copy)).alias("first_word"),
            (F.least(end(copy), (b + 1) * block) - first).alias("words"),
        )

    def of_copy(copy):
        blocks = F.sequence(F.floor(begin(copy) / block).cast("long"), F.floor((end(copy) - 1) / block).cast("long"))
        return F.transform(blocks, lambda b: piece(copy, b))

    copies = F.filter(
        F.sequence(F.lit(0).cast("long"), F.lit(math.ceil(limit)).cast("long")),
        lambda c: (begin(c) < F.col("words")) & (F.col("size") > 0),
    )
    pieces = F.flatten(F.transform(copies, of_copy))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda acc, p: acc + p["words"])
    return laid.withColumn("pieces", pieces).select(
        F.col("doc").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        "pieces",
        F.col("h").alias("row_hash"),
        F.col("check").alias("row_check"),
    )


def listing(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mixture itself: one row per piece, to be read by shard in the order of place and first_word."""
    return mixed.select(key, F.inline("pieces"))


def repeated(docs: DataFrame, seed: int = 7, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, columns unchanged.

    A document of which the mixture takes a part of a copy is kept for that copy if the
    part is at least half of it.
    """
    mixed = mix(docs, seed=seed, text=text, key=key, **options)
    whole = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    copies = (
        mixed.filter("taken > 0")
        .groupBy(F.col("row_hash").alias("_hash"), F.col("row_check").alias("_check"))
        .agg(F.sum(whole).alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        .filter("_copies > 0")
    )
    copies = staging(docs.sparkSession)(copies, "copies")
    one, two = _row_key(key, text, seed)
    same = Window.partitionBy("_hash", "_check").orderBy("_hash")
    met = docs.withColumns({"_hash": one, "_check": two}).join(copies, ["_hash", "_check"])
    share = F.expr("_copies div _rows + int(_at <= _copies % _rows)").cast("int")
    return (
        met.withColumn("_at", F.row_number().over(same))
        .withColumn("_n", share)
        .filter("_n > 0")
        .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n"))))
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )

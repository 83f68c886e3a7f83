"""Nearest neighbours by cosine over several shifted Hilbert curves.

Vectors are scaled to length 1 and projected to a few dimensions, by a different
projection and shift for each curve (main axes of a bounded sample, mixed at random). Along a curve every vector has a
Hilbert key; Spark range-partitions and ranks the rows by it. A query looks at the window of
ranks around its own on every curve. A window is a run of blocks of ranks; each block is
scored against the queries whose windows meet it, and gives each its nearest; the lists of all
blocks and curves are merged and reranked by the exact cosine.

How wide the window must be depends on the data: if the projection keeps neighbours together a short
one does, with little structure it grows to a good part of all rows. So it is measured: for
some sampled vectors the true neighbours are found by comparing them with all rows, and the window
is the smallest that holds the target share of them on at least one curve.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.llm.common import staging
from retail_lens.llm.vectors import cosines, main_dimension, matrix, sampled, units, usable

DIMENSIONS, BITS = 6, 10
#: Ranks in a block of candidates, and in a run of queries that meets it.
BLOCK, RUN = 2048, 65536
_SLICE = 512


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve for each row of integer coordinates below 2**bits.

    The public transposition method: undo the excess rotations bit plane by bit plane, Gray-encode,
    interleave.
    """
    x = grid.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    top = one << np.uint64(bits - 1)
    q = top
    while q > one:
        low = q - one
        for i in range(n):
            is_set = (x[i] & q) != 0
            swap = np.where(is_set, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap
        q >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > one:
        turn = np.where(x[n - 1] & q, turn ^ (q - one), turn)
        q >>= one
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def _projections(sample: np.ndarray, curves: int, seed: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each curve: matrix, lowest coordinate and scale to the grid, whose upper half leaves room for the shift."""
    rng = np.random.default_rng(seed)
    values, axes = np.linalg.eigh(np.cov(sample.T) if len(sample) > 1 else np.eye(sample.shape[1]))
    axes = axes[:, ::-1] * np.sqrt(np.maximum(values[::-1], 0) + 1e-12)
    out = []
    for _ in range(curves):
        mix, _ = np.linalg.qr(rng.normal(size=(sample.shape[1], min(DIMENSIONS, sample.shape[1]))))
        project = axes @ mix
        spread = sample @ project
        low, high = spread.min(0), spread.max(0)
        width = np.maximum(high - low, 1e-12)
        out.append((project, low - width * rng.uniform(0, 0.5, len(low)), (2**BITS - 1) / (1.5 * width)))
    return out


def _nearest(queries, ids, rows, names, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query its k nearest rows but itself: query ids, row ids, cosines; ties to the smaller id."""
    directions = units(rows).T
    for at in range(0, len(queries), _SLICE):
        part, of = queries[at : at + _SLICE], ids[at : at + _SLICE]
        near = units(part) @ directions
        near[of[:, None] == names] = -np.inf
        last = np.partition(near, -min(k, near.shape[1]), axis=1)[:, -min(k, near.shape[1])]
        i, j = np.nonzero((near >= last[:, None] - 1e-9) & (near > -np.inf))
        score = cosines(part[i], rows[j])
        order = np.lexsort((names[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        yield of[i[place < k]], names[j[place < k]], score[place < k]


_FOUND = "query_id long, vec_id long, score double"


def _batch(found: list[tuple]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, t) for t in (int, int, float)]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def brute_force(rows: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int) -> DataFrame:
    """True neighbours of a bounded number of queries: each task compares its rows with all of them."""
    dimension = queries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names, part = np.asarray(batch.column(0)), matrix(batch.column(1), dimension)
                yield from _batch(list(_nearest(queries, ids, part, names, k))).to_batches()

    return _merged(rows.select("vec_id", "v").mapInArrow(run, _FOUND), k)


def _window(ranked: DataFrame, rows: DataFrame, dimension: int, k: int, target: float, probes: int) -> int:
    """Ranks to either side that hold the target share of the true neighbours of sampled vectors."""
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(probes).collect()
    ids = np.array([r["vec_id"] for r in chosen], np.int64)
    queries = np.array([r["v"] for r in chosen], np.float64).reshape(-1, dimension)
    pairs = [(r["query_id"], r["vec_id"]) for r in brute_force(rows, queries, ids, k).collect()]
    names = sorted({i for pair in pairs for i in pair})  # at most probes * (k + 1)
    if not names:
        return 0
    place = {(r["vec_id"], r["curve"]): r["rank"] for r in ranked.filter(F.col("vec_id").isin(names)).select("vec_id", "curve", "rank").collect()}
    curves = {c for _, c in place}
    apart = sorted(min(abs(place[a, c] - place[b, c]) for c in curves) for a, b in pairs)
    return int(apart[min(len(apart) - 1, int(np.ceil(target * len(apart))) - 1)])


def nearest(
    df: DataFrame,
    queries: Column,
    k: int = 5,
    curves: int = 4,
    target: float = 0.97,
    sample: int = 4096,
    probes: int = 96,
    seed: int = 11,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank from 1, vec_id, score: for each row where ``queries`` holds its k nearest rows found.

    Nearness is the cosine in double precision, ties go to the smaller key. Vectors that are null, zero, hold null or
    non-finite components, have a null key or another dimension than most take no part;
    rows that repeat a key count as one, with the least vector. ``sample`` vectors fit the projections and ``probes`` measure the
    window; both stay on the driver. With fewer than k other rows a query gets all; an empty
    table gives no rows. Columns other than ``key`` and ``vector`` are not read beyond ``queries``.
    """
    stage = staging(df.sparkSession)
    read = df.filter(usable(vector) & F.col(key).isNotNull())
    read = read.groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(vector).alias("v"), F.max(queries).alias("asks"))
    rows = stage(read, "rows")
    dimension = main_dimension(rows, "v")
    rows = rows.filter(F.size("v") == dimension)
    if not dimension:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    plans = _projections(units(sampled(rows, "vec_id", "v", dimension, sample)), curves, seed)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            directions = units(matrix(batch.column(1), dimension)) if batch.num_rows else np.empty((0, dimension))
            for c, (project, low, scale) in enumerate(plans):
                grid = np.clip((directions @ project - low) * scale, 0, 2**BITS - 1)
                columns = [pa.array(np.full(len(grid), c, np.int32)), pa.array(hilbert_keys(grid, BITS)), *batch.columns]
                yield pa.RecordBatch.from_arrays(columns, ["curve", "place", "vec_id", "v", "asks"])

    kind = rows.schema["v"].dataType.simpleString()
    laid = rows.select("vec_id", "v", "asks").mapInArrow(keyed, f"curve int, place long, vec_id long, v {kind}, asks boolean")
    laid = stage(laid.repartitionByRange("curve", "place", "vec_id").withColumn("part", F.spark_partition_id()), "laid")
    counts = laid.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("curve", "part").orderBy("place", "vec_id")
    ranked = laid.join(counts, ["curve", "part"]).withColumn("rank", F.row_number().over(inside) - 1 + F.col("base"))
    ranked = stage(ranked.select("curve", "vec_id", "v", "asks", "rank"), "ranked")
    wide = _window(ranked, rows, dimension, k, target, probes)

    block = F.floor(F.col("rank") / BLOCK)
    ends = (F.greatest(F.lit(0), F.floor((F.col("rank") - wide) / BLOCK)), F.floor((F.col("rank") + wide) / BLOCK))
    asked = ranked.filter("asks").select(
        "curve", F.explode(F.sequence(*ends)).alias("block"), F.floor(F.col("rank") / RUN).alias("run"), "vec_id", "v"
    )
    held = ranked.select("curve", block.alias("block"), "vec_id", "v").join(
        asked.select("curve", "block", "run").distinct(), ["curve", "block"]
    )
    held = held.select("curve", "block", "run", "vec_id", "v")

    def score(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return _batch([])
        ids, names = np.asarray(q["vec_id"]), np.asarray(c["vec_id"])
        return _batch(list(_nearest(matrix(q["v"], dimension), ids, matrix(c["v"], dimension), names, k)))

    held = held.toDF(*held.columns)  # columns of its own, since both sides come from one table
    met = asked.groupBy("curve", "block", "run").cogroup(held.groupBy("curve", "block", "run"))
    return _merged(met.applyInArrow(score, _FOUND), k).select("query_id", "rank", "vec_id", "score")

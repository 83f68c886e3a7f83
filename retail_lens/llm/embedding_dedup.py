"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 and cut in halves; a codebook for each half, fitted on a
bounded sample, makes a product grid of cells. Every vector lies in its home cell and visits
others in the order of a multi-sequence traversal: pairs of codewords by falling
probability that a vector at the threshold distance lies there, until the target
recall is reached. The probability follows from the distances to the planes between the
own codeword and the others, for a difference in a random direction. Visitors are compared with
the home vectors of a cell, and only pairs whose exact cosine reaches the threshold link.

Equal vectors are one row throughout. Cells with many vectors are cut into blocks, and block meets
block; a task returns counts and, per vector, the smallest vector it hangs together with
there, never pairs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lens.llm.common import join_spread, staging
from retail_lens.llm.components import components
from retail_lens.llm.vectors import main_dimension, matrix, sampled, units, usable

#: Vectors a cell should hold on average, rows of a block, and vectors that the codebooks are fitted on.
CELL, BLOCK, SAMPLE = 1000, 2048, 20_000


def codebook(rows: np.ndarray, size: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centres by Lloyd's iterations from a random start."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(size, len(rows)), replace=False)]
    for _ in range(rounds):
        near = (centres**2).sum(1) - 2 * rows @ centres.T
        of = near.argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, rows)
        n = np.bincount(of, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def _chances(half: np.ndarray, centres: np.ndarray, scatter: float) -> tuple[np.ndarray, np.ndarray]:
    """Per row its codeword and, for all codewords, the chance that a near vector has that one."""
    near = ((half[:, None, :] - centres) ** 2).sum(2) if half.size * len(centres) < 5e6 else (
        (half**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * half @ centres.T
    )
    own = near.argmin(1)
    apart = np.sqrt(((centres[own][:, None, :] - centres) ** 2).sum(2))
    margin = (near - near.min(1, keepdims=True)) / (2 * np.maximum(apart, 1e-9))
    tail = np.vectorize(lambda z: 0.5 * math.erfc(z / math.sqrt(2)), otypes=[float])(np.minimum(margin / scatter, 9))
    tail[np.arange(len(own)), own] = 0
    tail[np.arange(len(own)), own] = np.maximum(1 - tail.sum(1), 0.5)
    return own, tail


def visits(first: np.ndarray, second: np.ndarray, target: float) -> list[tuple[int, int]]:
    """Multi-sequence traversal: cells by falling product of the two halves' chances, until their sum reaches the target share."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    goal = target * first.sum() * second.sum()
    out, got = [], 0.0
    queue, seen = [(-first[a[0]] * second[b[0]], 0, 0)], {(0, 0)}
    while queue and got < goal:
        chance, i, j = heapq.heappop(queue)
        got -= chance
        out.append((int(a[i]), int(b[j])))
        for step in ((i + 1, j), (i, j + 1)):
            if step[0] < len(a) and step[1] < len(b) and step not in seen:
                seen.add(step)
                heapq.heappush(queue, (-first[a[step[0]]] * second[b[step[1]]], *step))
    return out


def _compare(visitors: pa.Table, homes: pa.Table, dimension: int, least: float) -> pa.Table:
    """Links within a block: per vector how many others it links with, and the smallest it hangs together with."""
    empty = pa.table({"rep": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    if not visitors.num_rows or not homes.num_rows:
        return empty
    x, y = matrix(visitors["v"], dimension), matrix(homes["v"], dimension)
    a, b = np.asarray(visitors["rep"]), np.asarray(homes["rep"])
    i, j = np.nonzero(units(x) @ units(y).T >= least - 1e-9)
    exact = (x[i] * y[j]).sum(1) / np.sqrt((x[i] ** 2).sum(1) * (y[j] ** 2).sum(1))
    keep = (exact >= least) & (a[i] != b[j])
    i, j = i[keep], j[keep]
    if not len(i):
        return empty
    # Whether the home vector, visiting in turn, meets this visitor: else the link counts for both here.
    lists = homes["visits"].combine_chunks()
    begin, flat = np.asarray(lists.offsets), np.asarray(lists.values)
    owner = np.repeat(np.arange(len(b)), np.diff(begin))
    width = np.int64(flat.max() + 1)
    met = np.unique(owner * width + flat[begin[0] : begin[-1]])
    home = np.asarray(visitors["home"])[i]
    back = (home < width) & np.isin(j * width + np.minimum(home, width - 1), met)
    copies_a, copies_b = np.asarray(visitors["copies"]), np.asarray(homes["copies"])
    names, where = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    u, v = where[: len(i)], where[len(i) :]
    count = np.bincount(u, copies_b[j], len(names)) + np.bincount(v[~back], copies_a[i][~back], len(names))
    root = np.arange(len(names))
    while True:
        least_root = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, least_root)
        np.minimum.at(new, v, least_root)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return pa.table({"rep": names, "n": count.astype(np.int64), "root": names[root]})


def near_duplicates(
    df: DataFrame, least: float = 0.95, target: float = 0.999, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Two vectors link when they are found and their cosine in double precision is ``least``
    or more. ``target`` is the share of links at the very threshold that the traversal is to find; closer
    ones are found more often. ``component_id`` is the smallest key reachable by links, its own included,
    and ``kept`` says that it is its own. Null and zero vectors, those with null or non-finite components
    or another dimension than most link with nothing; rows with a null key too, and their
    component is null. Rows that repeat a key count as vectors of their own. An empty table gives no rows.
    """
    stage = staging(df.sparkSession)
    good = usable(vector)
    name = F.when(good, F.md5(F.concat_ws(",", F.col(vector).cast("array<string>"))))
    read = df.select(F.col(key).cast("long").alias("id"), F.when(F.col(key).isNotNull(), name).alias("name"), F.col(vector).alias("v"))
    rows = stage(read, "rows")
    classes = rows.filter("name is not null").groupBy("name").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")
    )
    classes = stage(classes, "classes")
    dimension = main_dimension(classes, "v")
    different = classes.filter(F.size("v") == dimension)
    named = stage(classes.select("name", "rep", "copies"), "named")
    members = stage(_members(rows, named), "members")
    if dimension < 2:
        links = df.sparkSession.createDataFrame([], "rep long, n long, root long")
    else:
        links = stage(_links(different, dimension, least, target, stage), "links")
    parts = components(links.select("rep", "root"), stage)
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    of_rep = named.select("rep", "copies").join(counts, "rep", "left").join(parts, F.col("rep") == F.col("node"), "left")
    of_rep = of_rep.select(
        "rep",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
        "copies",
    )
    out = join_spread(members, stage(of_rep, "of_rep"), "rep", "copies")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


def _members(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Every vector's id with its class."""
    weighed = named.withColumn("weight", F.col("copies")).select("name", "rep", "weight")
    return join_spread(rows.select("id", "name"), weighed, "name", "weight").select("id", "rep")


def _links(classes: DataFrame, dimension: int, least: float, target: float, stage) -> DataFrame:
    """Per block and vector with links there: rep, n, root."""
    half = dimension // 2
    n = classes.count()
    size = max(2, round(math.sqrt(n / CELL)))
    sample = units(sampled(classes, "rep", "v", dimension, SAMPLE))
    books = codebook(sample[:, :half], size), codebook(sample[:, half:], size)
    across = len(books[1])
    scatter = math.sqrt(2 * (1 - least) / dimension)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rows = units(matrix(part.column(2), dimension))
                own1, first = _chances(rows[:, :half], books[0], scatter)
                own2, second = _chances(rows[:, half:], books[1], scatter)
                cells = [[i * across + j for i, j in visits(f, s, target)] for f, s in zip(first, second, strict=True)]
                homes = (own1 * across + own2).tolist()
                cells = [c if h in c else [*c, h] for c, h in zip(cells, homes, strict=True)]
                columns = [*part.columns, pa.array(homes, pa.int64()), pa.array(cells, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "copies", "v", "home", "visits"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = classes.select("rep", "copies", "v").mapInArrow(
        assign, f"rep long, copies long, v {kind}, home long, visits array<long>"
    )
    placed = stage(placed, "placed")
    calls = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("calls"))
    lives = placed.groupBy(F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("lives"))
    cuts = stage(
        calls.join(lives, "cell").select(
            "cell", *(F.ceil(F.col(c) / BLOCK).cast("int").alias(b) for c, b in (("lives", "h"), ("calls", "g")))
        ),
        "cuts",
    )
    pick = lambda salt, parts: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    homes = placed.withColumn("cell", F.col("home")).join(cuts, "cell")
    homes = homes.withColumn("h", pick(1, "h")).withColumn("g", each("g")).select("cell", "h", "g", "rep", "copies", "v", "visits")
    guests = placed.select("rep", "copies", "v", "home", F.explode("visits").alias("cell")).join(cuts, "cell")
    guests = guests.withColumn("g", pick(2, "g")).withColumn("h", each("h")).select("cell", "h", "g", "rep", "copies", "v", "home")
    homes = homes.toDF(*homes.columns)  # columns of its own, since both sides come from one table
    at = ("cell", "h", "g")
    met = guests.groupBy(*at).cogroup(homes.groupBy(*at))
    return met.applyInArrow(lambda a, b: _compare(a, b, dimension, least), "rep long, n long, root long")

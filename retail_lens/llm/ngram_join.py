"""Exact self-join of documents by Jaccard similarity of their word shingles, with set-relation skipping.

1. One pass over the texts gives every document's set size, a hash of the set, a few min-hash
   keys, a sieve (below) and its *zone*, the first shingles in the order of their hashes. Documents
   with equal sets form a class; from here on only classes count.
2. *Index.* Shingles are ordered by hash, but common ones come last. A set is listed under its first
   shingles in that order, as many as two linked sets must share one of. What is common is found
   from the data: each class first lists its zone, which is longer than that, and shingles in more than
   COMMON lists are common. A class then knows where its list ends, and those that have too few others
   in their zone, near copies above all, are *short*. Linked sets share a number of shingles of their zones
   (``_least_shared``), so a class in fewer lists is linked with none and leaves the index.
3. *Leaders.* Classes with a min-hash key in common are compared with the smallest class of that
   key. A class similar enough to such a leader hangs on it, with its exact distance. This
   finds most links of large groups of near copies with a few comparisons per member.
4. *Crowd.* Short classes and those in enough lists with them are spelled out: all their shingles are listed, the rarest
   of the crowd first. Each is compared with the class that holds the most usual shingles of most of its lists, in a
   group of near copies the text that the others were made from. Those not yet together meet under the first shingles
   that two sets of their very sizes must share one of, which common shingles are only in sets close to that text.
5. *Derived answers.* All others meet in the lists that are not common. Each list
   is cut into blocks by size, and a class looks only into its own block and the next, skipping
   entries whose position leaves too few shingles to be shared. A leader stands in the lists for all classes that hang on it. Leaders
   that meet in a list and do not hang together yet are compared once. Jaccard distance is a metric, so a member of one
   and a member of the other can be linked only if the leaders' distance is within the threshold plus
   both members' distances to their leaders: only such member pairs are compared.

Before any pair is compared, a sieve rules out most that fail: every class carries short codes of a
fixed part of its shingles (those whose hash falls into one of k classes). Even if all others were
shared, two sets with too few codes in common cannot be similar enough. Texts are fetched for what is
left, packed.

The order of shingles changes how long lists are, never which components are found. Every link
that is reported is verified on the sets. The links found span the components and are not all
links; no component is missed unless two different shingles or sets have the same 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.llm.common import join_spread, staging
from retail_lens.llm.components import components
from retail_lens.llm.shingles import mixed, shingle_set
from retail_lens.session import Staging

#: A shingle in more lists than this is common.
COMMON = 16
#: Min-hash keys per class, and parts into which the members of one leader are spread.
KEYS, SPREAD = 6, 64
#: Bands of sizes, from one size to the largest that can be linked with it, in which the crowd meets.
BANDS = 10
#: Bits that say which keys may be wanted, so that the texts of few others are packed and moved.
BITS = 1 << 22

_SIGNED, _TINY = np.int64, np.uint64(0x5851F42D4C957F2D)
_FACTORS = np.array([[2 * j + 0x10001] for j in range(KEYS)], np.uint64)
_STEPS = np.arange(KEYS, dtype=np.uint64)


def _signature(shingles: np.ndarray) -> int:
    """Hash of a set, the same for equal sets."""
    with np.errstate(over="ignore"):
        total = mixed(shingles ^ _TINY).sum(dtype=np.uint64) + np.uint64(len(shingles))
        return int(mixed(np.array([total]))[0].astype(_SIGNED))


def _min_keys(shingles: np.ndarray) -> list[int]:
    with np.errstate(over="ignore"):
        return mixed((shingles * _FACTORS).min(axis=1) + _STEPS).astype(_SIGNED).tolist()


def _sieve_part(percent: int) -> int:
    """One in how many shingles gives a code: twice the share by which linked sets may differ, and some more."""
    return max(2, int((100 + percent) / (2.2 * (100 - percent)))) if percent < 100 else 64


def _bytes(text: pa.Scalar) -> pa.Buffer | bytes:
    """The UTF-8 bytes of a text, none for null."""
    return text.as_buffer() if text.is_valid else b""


def _summaries(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per document: k, n, set, keys, sieve, zone."""
    part = np.uint64(_sieve_part(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", "n", "set", "keys", "sieve", "zone"]
        types = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
        for batch in batches:
            rows: list[tuple] = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shingles = shingle_set(_bytes(text), width)
                n = len(shingles)
                if n:
                    codes = (shingles[shingles % part == 0] >> np.uint64(32)).astype("<u4").tobytes()
                    zone = shingles[: _zone(n, percent)].astype(_SIGNED)
                    rows.append((k, n, _signature(shingles), _min_keys(shingles), codes, zone))
                else:
                    rows.append((k, 0, 0, None, None, None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.mapInArrow(run, "k long, n long, set long, keys array<long>, sieve binary, zone array<long>")


def _prefix(n, percent: int):
    """How many first shingles of a set of n two sets must share one of to be similar; for numbers and columns alike."""
    return n + 1 + (-percent * n) // 100 if isinstance(n, int) else n + 1 - F.ceil(n * percent / 100)


def _zone(n, percent: int):
    """How many first shingles by hash a class lists to find its common ones: its prefix and half of it, or 40, more."""
    prefix = _prefix(n, percent)
    return prefix + max(prefix // 2, 40) if isinstance(n, int) else prefix + F.greatest(F.floor(prefix / 2), F.lit(40))


def _least_shared(n: Column, percent: int) -> Column:
    """How many shingles of its zone a set of n shares with the zone of any set linked with it, at least.

    Take the zone that ends first: a set that is linked lacks fewer than the prefix of its shingles, and
    lists the others of them in its own zone. The smallest set that can be linked promises least.
    """
    smallest = F.ceil(n * percent / 100)
    return F.least(_zone(smallest, percent) - _prefix(smallest, percent) + 1, smallest)


def _index(classes: DataFrame, percent: int, stage: Staging, once: Staging) -> tuple[DataFrame, DataFrame]:
    """The lists (h, set, n, at: place in the order by hash) and the crowd (set).

    Two sets that are similar enough share a list, unless both are in the crowd.
    """
    by_shingle = Window.partitionBy("h")
    listed = classes.select("set", "n", F.posexplode("zone").alias("at", "h"))
    shared = listed.withColumn("lists", F.count(F.lit(1)).over(by_shingle)).filter("lists > 1")
    shared = once(shared.withColumn("common", F.col("lists") > COMMON).drop("lists"), "shared")
    own = Window.partitionBy("set")
    prefix = _prefix(F.col("n"), percent)
    # The j-th common place c (from 0) has c - j others before it: it lies within the list if these are too few.
    before = F.count(F.when(F.col("common"), 1)).over(own.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    known = shared.withColumns({"lists": F.count(F.lit(1)).over(own), "within": F.col("common") & (F.col("at") - before < prefix)})
    known = known.withColumn("end", prefix + F.count(F.when(F.col("within"), 1)).over(own))
    short = F.col("end") > F.least(_zone(F.col("n"), percent), "n")
    known = known.filter(F.col("lists") >= _least_shared(F.col("n"), percent)).withColumn("short", short)
    known = once(known.select("h", "set", "n", "at", "common", "end", "short"), "known")
    index = stage(known.filter("not short and not common and at < end").select("h", "set", "n", "at"), "index")
    near = known.filter("short").groupBy("h").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    beside = known.filter("not short").join(near, "h").filter(_large_enough("n", "low", percent) & _large_enough("high", "n", percent))
    beside = beside.groupBy("set").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("lists"))
    beside = beside.filter(F.col("lists") >= _least_shared(F.col("n"), percent))
    return index, stage(known.filter("short").select("set").distinct().union(beside.select("set")), "crowd")


def _spelled(crowd: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """All shingles of the crowd that several of it hold: h, set, n, at (place in the order by frequency), usual.

    ``usual`` is how many of the crowd hold a shingle of the set, on average.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shingles = shingle_set(unpack(text.as_py()), width)
                if _signature(shingles) == name:  # else another text under the same key
                    rows.append((name, shingles.astype(_SIGNED)))
            columns = list(zip(*rows, strict=True)) or [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.int64()))], ["set", "all"])

    sets = texts.join(crowd, "set", "left_semi").select("set", "text").mapInArrow(run, "set long, all array<long>")
    rows = sets.dropDuplicates(["set"]).select("set", F.size("all").cast("long").alias("n"), F.explode("all").alias("h"))
    rows = rows.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("h"))).filter("held > 1")
    own = Window.partitionBy("set")
    alone = F.col("n") - F.count(F.lit(1)).over(own)
    return rows.select(
        *("h", "set", "n"),
        (alone + F.row_number().over(own.orderBy("held", "h")) - 1).alias("at"),
        ((alone + F.sum("held").over(own)) / F.col("n")).alias("usual"),
    )


def _usual_heads(spelled: DataFrame, percent: int) -> DataFrame:
    """For each of the crowd (b) the class (a) that has the most usual shingles in most of its lists."""
    heads = spelled.groupBy("h").agg(F.max(F.struct("usual", F.col("set").alias("a"), F.col("n").alias("na"))).alias("head"))
    votes = spelled.join(heads.select("h", "head.a", "head.na"), "h").filter("a <> set").groupBy("set", "n", "a", "na").count()
    votes = votes.filter(_fits("na", "n", percent))
    return votes.groupBy(F.col("set").alias("b")).agg(F.max(F.struct("count", "a")).alias("most")).select("most.a", "b")


def _crowd_pairs(spelled: DataFrame, parts: DataFrame, percent: int, stage: Staging) -> DataFrame:
    """Pairs (a, b) of the crowd, in different parts, that may be similar enough by their first shared shingle.

    The first shared shingle, in the order by frequency, lies where either set still has as many
    shingles as the two must share. How many that are follows from both sizes, known to a band.
    """
    width = F.log(F.lit(max(100 / percent, 1.001))) / BANDS
    band = F.floor(F.log(F.col("n").cast("double")) / width + 1e-9)
    rows = spelled.filter(F.col("at") < _prefix(F.col("n"), percent)).join(parts, F.col("set") == F.col("node"), "left")
    rows = stage(rows.select("h", "set", "n", "at", F.coalesce("component", "set").alias("part"), band.alias("band")), "rows")

    def met(other: str, least: Column) -> Column:
        """Whether a partner of a size in the other band, and of ``least`` at least, may meet the set here."""
        least = F.greatest(least, F.exp(F.col(other) * width) - 1e-6)
        return F.col("at") <= F.col("n") - (F.col("n") + least) * percent / (100 + percent) + 1e-6

    key = ["h", "low", "high"]
    reach = F.lit(BANDS + 1)
    small = rows.withColumnRenamed("band", "low").withColumn("high", F.explode(F.sequence("low", F.col("low") + reach)))
    large = rows.withColumnRenamed("band", "high").withColumn("low", F.explode(F.sequence(F.col("high") - reach, "high")))
    small = small.filter(met("high", F.col("n"))).select(*key, *(F.col(c).alias(c + "1") for c in ("set", "n", "at", "part")))
    large = large.filter(met("low", F.col("n") * percent / 100)).select(*key, *(F.col(c).alias(c + "2") for c in ("set", "n", "at", "part")))
    # Most of a list may hang together: these are not paired with one another.
    main = small.groupBy(*key, "part1").count().groupBy(*key).agg(F.max_by("part1", "count").alias("main"))
    main = stage(main, "main")
    small, large = stage(small, "small"), stage(large.join(main, key), "large")
    marked = small.join(main, key)
    apart = F.col("part1") != F.col("main")
    found = marked.filter(apart).drop("main").join(large.drop("main"), key)
    found = found.union(marked.filter(~apart).drop("main").join(large.filter("part2 <> main").drop("main"), key))
    needed = (F.col("n1") + F.col("n2")) * percent / (100 + percent) - 1e-6
    found = found.filter((F.col("part1") != F.col("part2")) & _fits("n1", "n2", percent))
    found = found.filter((F.col("n1") - F.col("at1") >= needed) & (F.col("n2") - F.col("at2") >= needed))
    return found.select(F.least("set1", "set2").alias("a"), F.greatest("set1", "set2").alias("b")).distinct()


def _sieved(pairs: DataFrame, classes: DataFrame, stage: Staging) -> DataFrame:
    """The pairs (a, b, limit) whose distance may be within the limit by their sieves."""
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    wanted = stage(classes.select("set", "n", "sieve").join(wanted, "set", "left_semi"), "sieves")
    side = lambda c: wanted.select(F.col("set").alias(c), F.col("n").alias("n" + c), F.col("sieve").alias("s" + c))
    rows = pairs.select("a", "b", "limit").join(side("a"), "a").join(side("b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for limit, na, sa, nb, sb in zip(*(batch.column(i) for i in range(2, 7)), strict=True):
                a, b = (np.frombuffer(s.as_py(), "<u4") for s in (sa, sb))
                ua, ub = (x[np.diff(x, prepend=np.int64(-1)) != 0] for x in (a, b))
                common = len(np.intersect1d(ua, ub, assume_unique=True)) + len(a) - len(ua) + len(b) - len(ub)
                na, nb = na.as_py(), nb.as_py()
                most = common + min(na - len(a), nb - len(b))
                keep.append(1 - most / (na + nb - most) <= limit.as_py() + 1e-9)
            found = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([found.column(0), found.column(1)], ["a", "b"])

    names = ["a", "b", "limit", "na", "sa", "nb", "sb"]
    return rows.select(*names).mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame, stage: Staging) -> DataFrame:
    """Packed text of each wanted class (column set), from its document of the smallest key."""
    reps = stage(classes.select("set", "rep").join(wanted.distinct(), "set"), "reps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [pack(_bytes(t)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["name", "text"])

    bit = lambda key: F.col(key).bitwiseAND(F.lit(BITS - 1))
    place = lambda key: F.col(key).bitwiseAND(F.lit(63)).cast("int")
    words = reps.groupBy(F.shiftright(bit("rep"), 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place("rep"))).alias("bits"))
    some = docs.join(F.broadcast(words), F.shiftright(bit("k"), 6) == F.col("word")).filter(F.getbit("bits", place("k")) == 1)
    packed = some.select("k", "text").mapInArrow(run, "rep long, text binary").join(reps, "rep")
    # A key may be given with several texts; the class is known by the set, so the right one is found when unpacked.
    return stage(packed.dropDuplicates(["set", "text"]).select("set", "text"), "texts")


def _overlaps(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Exact sizes and intersections for pairs (a, b) of classes: a, b, na, nb, common.

    The members b of one a are spread over SPREAD parts, each of which receives the set of
    a once and then streams its members: no task holds more than two texts.
    """
    part = F.pmod(F.xxhash64("b"), F.lit(SPREAD)).cast("int").alias("part")
    pairs = pairs.select("a", "b", part)
    heads = pairs.select("a", "part").distinct().select("a", "part", F.col("a").alias("set"), F.lit(0).alias("role"))
    tails = pairs.select("a", "part", F.col("b").alias("set"), F.lit(1).alias("role"))
    rows = heads.unionByName(tails).join(texts, "set").select("a", "part", "role", "set", "text")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.empty(0, np.uint64)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for a, role, other, text in zip(*(batch.column(i) for i in (0, 2, 3, 4)), strict=True):
                shingles = shingle_set(unpack(text.as_py()), width)
                if _signature(shingles) != other.as_py():
                    continue  # another text under the same key
                if not role.as_py():
                    head = shingles
                else:
                    common = len(np.intersect1d(head, shingles, assume_unique=True))
                    out.append((a.as_py(), other.as_py(), len(head), len(shingles), common))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "na", "nb", "common"])

    return rows.mapInArrow(run, "a long, b long, na long, nb long, common long")


def _similar(percent: int) -> Column:
    return F.col("common") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("common"))


def _distance() -> Column:
    return 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))


def _large_enough(a: str, b: str, percent: int) -> Column:
    """Whether a set of the size a is not too small to be similar to one of the size b."""
    return F.col(a) * 100 >= percent * F.col(b)


def _fits(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return _large_enough(a, b, percent) & _large_enough(b, a, percent)


def links(
    docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> tuple[DataFrame, DataFrame, Staging]:
    """Documents with their class, links between classes, and the staging both are kept in.

    Documents: k (the key), n (set size), set (class; 0 without words). Links: a, b (classes)
    such that their connected components are those of all links at ``percent`` or more.
    They are a part of all links that spans each component, not the whole join: classes that hang
    together already are not compared, nor are members of one leader or of two similar leaders.
    """
    spark = docs.sparkSession
    stage, once, listing = staging(spark), staging(spark), staging(spark)
    docs = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("text"))
    summaries = once(_summaries(docs, width, percent), "summaries")
    members = stage(summaries.select("k", "n", "set"), "members")
    full = summaries.filter("n > 0 and k is not null")
    firsts = (F.first(c).alias(c) for c in ("n", "keys", "sieve", "zone"))
    classes = listing(full.groupBy("set").agg(F.min("k").alias("rep"), *firsts), "classes")
    once.drop()
    index, crowd = _index(classes, percent, stage, listing)
    classes = stage(classes.drop("zone"), "classes")
    listing.drop()
    limit = 1 - percent / 100

    # Leaders: candidates by min-hash keys, a star around the smallest class of each key.
    keyed = once(classes.select("set", "n", "rep", F.explode("keys").alias("key")), "keyed")
    heads = keyed.groupBy("key").agg(
        F.min(F.struct("rep", F.col("set").alias("a"), F.col("n").alias("na"))).alias("head"), F.count(F.lit(1)).alias("rows")
    )
    heads = once(heads.filter("rows > 1").select("key", "head.a", "head.na", "rows"), "heads")
    star = join_spread(keyed, heads, "key", "rows").filter("a <> set").filter(_fits("na", "n", percent))
    star = once(star.select("a", F.col("set").alias("b")).distinct().withColumn("limit", F.lit(limit)), "star")
    star = stage(_sieved(star, classes, once), "star")
    once.drop()
    texts = _texts(docs, classes, star.select(F.col("a").alias("set")).union(star.select("b")), stage)
    met = stage(_overlaps(star, texts, width).filter(_similar(percent)), "met")

    # The crowd: a star around the most usual class, then the pairs that this leaves.
    texts = texts.unionByName(_texts(docs, classes, crowd.join(texts, "set", "left_anti"), stage))
    spelled = once(_spelled(crowd, texts, width), "spelled")
    usual = stage(_usual_heads(spelled, percent), "star")
    usual = stage(_overlaps(usual, texts, width).filter(_similar(percent)).select("a", "b"), "met")
    parts = stage(components(met.select("a", "b").union(usual), stage), "parts")
    crowded = stage(_crowd_pairs(spelled, parts, percent, once).withColumn("limit", F.lit(limit)), "pairs")
    crowded = stage(_sieved(crowded, classes, once), "pairs")
    once.drop()
    crowded = stage(_overlaps(crowded, texts, width).filter(_similar(percent)).select("a", "b"), "met")

    hung = met.groupBy(F.col("b").alias("set")).agg(F.min(F.struct(F.col("a").alias("lead"), _distance().alias("far"))).alias("h"))
    leads = classes.select("set", "n").join(hung, "set", "left")
    leads = stage(
        leads.select("set", "n", F.coalesce("h.lead", "set").alias("lead"), F.coalesce("h.far", F.lit(0.0)).alias("far"))
        # Classes that hang together already need not be compared again.
        .join(parts, F.col("set") == F.col("node"), "left")
        .select("set", "n", "lead", "far", F.coalesce("component", "set").alias("part")),
        "leads",
    )

    radius = leads.groupBy("lead").agg(F.max("far").alias("radius"))
    pairs = once(_leader_pairs(index, leads, percent, once), "pairs")
    pairs = pairs.join(radius.withColumnsRenamed({"lead": "a", "radius": "ra"}), "a")
    pairs = pairs.join(radius.withColumnsRenamed({"lead": "b", "radius": "rb"}), "b")
    pairs = once(pairs.withColumn("limit", limit + F.col("ra") + F.col("rb")), "pairs")
    pairs = stage(_sieved(pairs, classes, once), "pairs")
    once.drop()
    # Members of a leader have been fetched already; so have leaders with members.
    new = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct().join(texts.select("set"), "set", "left_anti")
    texts = texts.unionByName(_texts(docs, classes, new, stage))
    apart = stage(_overlaps(pairs, texts, width).withColumn("far", _distance()), "apart")
    direct = apart.filter(_similar(percent)).select("a", "b")
    inner = _member_pairs(apart.filter(~_similar(percent)), leads, percent)
    extra = _overlaps(stage(inner, "inner"), texts, width).filter(_similar(percent)).select("a", "b")
    return members, met.select("a", "b").union(usual).union(crowded).union(direct).union(extra), stage


def _leader_pairs(index: DataFrame, leads: DataFrame, percent: int, stage: Staging) -> DataFrame:
    """Leaders that meet in a list within reach of each other's size and position."""
    block = lambda n: F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(max(100 / percent, 1.001))) + 1e-9)
    rest = (F.col("n") - F.col("at")).alias("rest")
    entries = (
        index.join(leads.select("set", "lead", "part"), "set")
        .select("h", "lead", "part", "n", "at", rest)
        .groupBy("h", "lead", "part")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("at").alias("at"), F.max("rest").alias("rest"))
    )
    many = Window.partitionBy("h")
    ends = {"_first": F.min("part").over(many), "_last": F.max("part").over(many)}
    entries = stage(entries.withColumns(ends).filter("_first < _last").drop(*ends), "entries")
    own = entries.withColumn("block", F.explode(F.sequence(block("low"), block("high"))))
    reach = entries.withColumn("block", F.explode(F.sequence(block("low"), block("high") + 1)))
    return _meeting(own, reach, percent)


def _meeting(one: DataFrame, two: DataFrame, percent: int) -> DataFrame:
    """Leaders in one block of one list whose sizes and positions allow enough shared shingles."""
    a, b = (
        x.select("h", "block", *(F.col(c).alias(c + s) for c in ("lead", "part", "low", "high", "at", "rest")))
        for x, s in ((one, "1"), (two, "2"))
    )
    shared = F.least("at1", "at2") + F.least("rest1", "rest2")
    needed = (F.col("low1") + F.col("low2")) * percent / (100 + percent)
    fits = (F.col("high1") * 100 >= F.col("low2") * percent) & (F.col("high2") * 100 >= F.col("low1") * percent)
    met = a.join(b, ["h", "block"]).filter((F.col("part1") != F.col("part2")) & fits & (shared >= needed - 1e-6))
    return met.select(F.least("lead1", "lead2").alias("a"), F.greatest("lead1", "lead2").alias("b")).distinct()


def _member_pairs(apart: DataFrame, leads: DataFrame, percent: int) -> DataFrame:
    """Pairs of members whose distance is not ruled out by their leaders' distance."""
    limit = 1 - percent / 100 + 1e-9
    radius = leads.groupBy("lead").agg(F.max("far").alias("radius"))
    near = (
        apart.join(radius.withColumnsRenamed({"lead": "a", "radius": "ra"}), "a")
        .join(radius.withColumnsRenamed({"lead": "b", "radius": "rb"}), "b")
        .filter(F.col("far") <= limit + F.col("ra") + F.col("rb"))
    )
    names = lambda s: leads.select(*(F.col(c).alias(c + s) for c in ("set", "n", "lead", "far")))
    first = near.join(names("1"), F.col("a") == F.col("lead1")).filter(F.col("far") <= limit + F.col("far1") + F.col("rb"))
    both = first.join(names("2"), F.col("b") == F.col("lead2"))
    both = both.filter(F.col("far") <= limit + F.col("far1") + F.col("far2")).filter(_fits("n1", "n2", percent))
    return both.select(F.least("set1", "set2").alias("a"), F.greatest("set1", "set2").alias("b")).filter("a <> b").distinct()


def ngram_join(
    docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per document: key, n_shingles, component_id.

    A document's set holds its distinct runs of ``width`` words, letters A-Z lower-cased; with
    fewer words the whole sequence is its only member; without words or text it is empty and
    links with nothing. Documents link when 100 * intersection >= ``percent`` * union.
    ``component_id`` is the smallest key reachable by links, its own included. Rows with a
    null key link with nothing and have a null component; repeated keys are taken as one
    document where their sets agree. An empty table gives no rows; other columns are not read.
    """
    members, found, stage = links(docs, width, percent, text, key)
    parts = components(found, stage)
    named = members.filter("n > 0 and k is not null").groupBy("set").agg(F.min("k").alias("least"), F.count(F.lit(1)).alias("rows"))
    named = stage(named.join(parts, F.col("set") == F.col("node"), "left").withColumn("component", F.coalesce("component", "set")), "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("smallest"), F.count(F.lit(1)).alias("classes"))
    ids = join_spread(named.select("set", "component", "rows"), stage(smallest, "smallest"), "component", "classes")
    ids = stage(ids.select("set", F.col("smallest").alias("component_id"), "rows"), "ids")
    out = join_spread(members.withColumn("set", F.expr("if(n > 0 and k is not null, set, null)")), ids, "set", "rows")
    own = F.when(F.col("n") == 0, F.col("k"))
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", own).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of its component, columns unchanged.

    Rows without words or key stay as they are; of rows that share key and text one stays.
    """
    found = ngram_join(docs, width, percent, text, key)
    gone = found.filter(F.col("component_id") != F.col(key)).select(F.col(key).alias("_gone")).distinct()
    stage = staging(docs.sparkSession)
    own = docs.withColumns({"_gone": F.col(key), "_text": F.xxhash64(F.col(key), F.col(text))})
    # Rows that occur again are few, so that only these are gathered; both tables are small files.
    again = own.filter(F.col("_gone").isNotNull()).groupBy("_gone", "_text").count().filter("count > 1")
    again = stage(again.drop("count"), "again")
    left = own.join(stage(gone, "gone"), "_gone", "left_anti")
    once = left.join(again, ["_gone", "_text"], "left_semi").dropDuplicates(["_gone", "_text"])
    rest = left.join(again, ["_gone", "_text"], "left_anti")
    return rest.unionByName(once).select(*(F.col(f"`{c}`") for c in docs.columns))

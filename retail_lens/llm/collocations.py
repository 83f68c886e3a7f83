"""Phrases of two and three words that hang together, by merged stripes.

A stripe is a prefix with a counter of the words after it (the empty word is the end of the piece). Each task counts
its texts into stripes; the stripes of a prefix are dealt together and merged element by element; the merged stripe gives
everything: its sum is the prefix's own count, its elements are the counts of the phrases one word longer, its largest
element is the most frequent phrase that continues the prefix.

Prefixes of one word are merged first, then those of two. A phrase of three words is only frequent if both its pairs
are, so the second round leaves out a pair whose place in a bitmap of the frequent pairs is empty. The bitmap has a
fixed size; where places are shared it lets too much through, never too little.

Stripes of very common prefixes are cut into segments by the next word, so that none has to be merged in one task. Which
prefixes these are is read from a sample of texts (words) or from the first round (pairs); it affects the balance alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_lens.llm.common import staging

#: Texts are counted in lots of so many bytes; a task holds twice as many.
LOT_BYTES = 8 << 20
#: A prefix with more than this share of all words has its stripes cut into so many segments.
HOT_SHARE = 2000
SEGMENTS = 64
#: Texts sampled, on average, to find common words.
SAMPLE = 4000
#: Places of the bitmap of frequent pairs (16 MB).
PLACES = 1 << 27

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to a-z, breaks to line feeds, tabs to spaces.
_PLAIN = bytes(b"\n"[0] if b in _BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_EDGE = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_ENTRIES = "array<struct<word: string, n: bigint>>"


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of a text of about ``size`` bytes, cut where no word is."""
    at = 0
    while len(text) - at > size:
        edge = _EDGE.search(text, at + size)
        if not edge:
            break
        yield text[at : edge.start()]
        at = edge.start()
    yield text[at:]


class _Stream:
    """The words of one language in lots; the last two words of a lot come again before the next."""

    def __init__(self):
        self.parts, self.size, self.carry = [], 0, []

    def take(self, part: bytes) -> None:
        self.parts.append(part)
        self.size += len(part)

    def lot(self, last: bool) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Vocabulary, whose word 0 is empty, and the codes of every word and of the two after it in its piece (0: none)."""
        plain = b"".join(self.parts).translate(_PLAIN).replace(b"\n", b" \n ")
        words = self.carry + [w for w in plain.split(b" ") if w] + [b"\n", b"\n"] * last
        self.parts, self.size, self.carry = [], 0, words[-2:]
        coded = pa.array([b"\n", *words], pa.binary()).dictionary_encode()
        codes = coded.indices.to_numpy()[1:].astype(np.int64)
        vocabulary = pa.concat_arrays([pa.array([b""], pa.binary()), coded.dictionary[1:]]).cast(pa.string())
        a, b, c = (codes[i : len(codes) - 2 + i] if len(codes) > 2 else codes[:0] for i in range(3))
        word = a != 0
        return vocabulary, a[word], b[word], np.where(b == 0, 0, c)[word]


def _lots(batches: Iterator[pa.RecordBatch], lot: int) -> Iterator[tuple]:
    """(language, vocabulary, words, next words, words after these) lot by lot."""
    streams: dict[str, _Stream] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            stream = streams.setdefault(lang, _Stream())
            for part in _slices(text.as_py(), lot):
                stream.take(part)
                held += len(part)
                if held >= lot:
                    fullest = max(streams, key=lambda s: streams[s].size)
                    held -= streams[fullest].size
                    yield (fullest, *streams[fullest].lot(False))
            stream.take(b"\n")
            held += 1
    for lang, stream in streams.items():
        yield (lang, *stream.lot(True))


def _segment(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.as_py().encode()) % SEGMENTS for w in words), np.int32, len(words))


def _stripes(lang: str, vocabulary: pa.Array, prefix: list[np.ndarray], after: np.ndarray, hot: set) -> Iterator[pa.RecordBatch]:
    """The stripes of a lot: language, the prefix's words, segment, next words, their counts."""
    if not len(after):
        return
    size = len(vocabulary)
    ids, firsts, of = np.unique(prefix[0] if len(prefix) == 1 else prefix[0] * size + prefix[1], return_index=True, return_inverse=True)
    keys, counts = np.unique(of * size + after, return_counts=True)
    row, word = keys // size, keys % size
    names = [vocabulary.take(pa.array(p[firsts])) for p in prefix]
    segment = np.full(len(keys), -1, np.int32)
    if hot:
        spoken = zip(*(n.to_pylist() for n in names), strict=True)
        heated = np.fromiter(((lang, *w) in hot for w in spoken), bool, len(ids))[row]
        segment[heated] = _segment(vocabulary.take(pa.array(word[heated])))
        order = np.lexsort((segment, row))
        row, word, counts, segment = row[order], word[order], counts[order], segment[order]
    start = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (segment[1:] != segment[:-1])]))
    offsets = pa.array(np.append(start, len(row)).astype(np.int32))
    columns = [n.take(pa.array(row[start])) for n in names]
    table = pa.table(
        [pa.array([lang] * len(start)), *columns, pa.array(segment[start]),
         pa.ListArray.from_arrays(offsets, vocabulary.take(pa.array(word))), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64)))],
        names=["lang", *(f"w{i}" for i in range(1, len(prefix) + 1)), "segment", "words", "counts"],
    )
    yield from table.to_batches(max_chunksize=20_000)


def _places(lang: str, first: np.ndarray, second: np.ndarray, places: int) -> np.ndarray:
    """Place of a pair in the bitmap, from its words' hashes."""
    return (first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(zlib.crc32(lang.encode()))) >> np.uint64(64 - (places.bit_length() - 1))


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").alias("text")).filter("text is not null")


def _merged(stripes: DataFrame, words: list[str], least: int) -> DataFrame:
    """Merged stripes: key, total, and of their elements those counted ``least`` times, the end of the piece left out.

    The three steps need the same partitioning, by key, and share one shuffle.
    """
    key = ["lang", *words, "segment"]
    dealt = stripes.repartition(*key).select(*key, F.explode(F.arrays_zip("words", "counts")).alias("e"))
    summed = dealt.groupBy(*key, F.col("e.words").alias("word")).agg(F.sum("e.counts").alias("n"))
    kept = F.when((F.col("n") >= least) & (F.col("word") != ""), F.struct("word", "n"))
    return summed.groupBy(*key).agg(F.sum("n").alias("total"), F.collect_list(kept).alias("entries"))


def _first_round(texts: DataFrame, hot: set, lot: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, vocabulary, a, b, _ in _lots(batches, lot):
            yield from _stripes(lang, vocabulary, [a], b, hot)

    return texts.mapInArrow(count, "lang string, w1 string, segment int, words array<string>, counts array<long>")


def _second_round(texts: DataFrame, hot: set, bitmap, places: int, lot: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)

        def frequent(lang, first, second):
            at = _places(lang, first, second, places)
            return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        for lang, vocabulary, a, b, c in _lots(batches, lot):
            code = _hashes(vocabulary)
            three = c != 0
            a, b, c = a[three], b[three], c[three]
            both = frequent(lang, code[a], code[b]) & frequent(lang, code[b], code[c])
            yield from _stripes(lang, vocabulary, [a[both], b[both]], c[both], hot)

    return texts.mapInArrow(count, "lang string, w1 string, w2 string, segment int, words array<string>, counts array<long>")


def _bitmap(pairs: DataFrame, places: int) -> bytes:
    """Bits of the places that pairs have: built in Spark in pieces of 4 KB, ``places`` / 8 bytes in all."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                rows = batch.filter(pa.compute.equal(batch.column(0), lang))
                at = _places(lang, _hashes(rows.column(1)), _hashes(rows.column(2)), places)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + 1)], ["place"])

    placed = pairs.select("lang", "w1", "w2").mapInArrow(place, "place long")
    parts = placed.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    bits = bytearray(max(places // 8, 4096))
    for bucket, part in parts.toLocalIterator():
        bits[(bucket - 1) * 4096 : bucket * 4096] = part
    return bytes(bits)


def _common_words(texts: DataFrame, lot: int) -> set:
    """(language, word) of words with more than a share of the words in a sample of texts; at most HOT_SHARE."""
    fraction = min(1.0, SAMPLE / max(1, texts.count()))
    counted = _first_round(texts.sample(False, fraction, seed=7), set(), lot).select("lang", "w1", F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y).alias("n"))
    sums = counted.groupBy("lang", "w1").agg(F.sum("n").alias("n"))
    return {(r.lang, r.w1) for r in _above(sums, "n").collect()}


def _above(counts: DataFrame, n: str) -> DataFrame:
    """Rows with more than a HOT_SHARE-th of the sum; there are fewer than HOT_SHARE."""
    whole = counts.agg(F.sum(n)).first()[0] or 0
    return counts.filter(F.col(n) * HOT_SHARE > whole)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in decimals of 38 digits, which hold counts up to 10^16."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def collocations(docs: DataFrame, least: int = 10, covered: int = 50, top: int = 2000, places: int = PLACES, lot: int = LOT_BYTES) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    a, l and r count the phrase and the parts of its lowest-scoring cut (of equal ones the first), n all words of the
    language. A phrase counted less than ``least`` times is none; one that a longer phrase contains with ``covered`` percent
    of its count is left out. Ranked by score, then a, then phrase in byte order. A null language is ``und``; null and
    empty texts count nothing; repeated rows count again; no rows give no rows. Only ``lang`` and ``text`` are read.
    """
    spark = docs.sparkSession
    stage = staging(spark)
    texts = _texts(docs)
    ones = stage(_merged(_first_round(texts, _common_words(texts, lot), lot), ["w1"], least), "stripes_1")
    words = stage(ones.groupBy("lang", "w1").agg(F.sum("total").alias("f")), "words")
    pairs = stage(ones.select("lang", "w1", F.explode("entries").alias("e")).select("lang", "w1", F.col("e.word").alias("w2"), F.col("e.n").alias("a")), "pairs")
    hot = {(r.lang, r.w1, r.w2) for r in _above(pairs, "a").collect()}
    bitmap = spark.sparkContext.broadcast(_bitmap(pairs, places))
    twos = _merged(_second_round(texts, hot, bitmap, places, lot), ["w1", "w2"], least).filter(F.size("entries") > 0)
    triples = stage(twos.select("lang", "w1", "w2", F.explode("entries").alias("e")).select("lang", "w1", "w2", F.col("e.word").alias("w3"), F.col("e.n").alias("a")), "triples")

    # Subsumption: the most frequent phrase that continues a pair, or that the pair ends.
    onward = triples.groupBy("lang", "w1", "w2").agg(F.max("a").alias("most"))
    before = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("most"))
    longer = onward.unionByName(before).groupBy("lang", "w1", "w2").agg(F.max("most").alias("most"))

    def named(word: str, into: str) -> DataFrame:
        return words.select("lang", F.col("w1").alias(word), F.col("f").alias(into))

    def paired(first: str, second: str, into: str) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(into))

    a = F.col("a")
    two = pairs.join(longer, ["lang", "w1", "w2"], "left").filter(F.col("most").isNull() | (F.col("most") * 100 < a * covered))
    two = two.join(named("w1", "l"), ["lang", "w1"]).join(named("w2", "r"), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(a, F.col("l"), F.col("r")).alias("score"))
    three = triples.join(named("w1", "l1"), ["lang", "w1"]).join(paired("w2", "w3", "r1"), ["lang", "w2", "w3"])
    three = three.join(paired("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(named("w3", "r2"), ["lang", "w3"])
    cuts = [F.struct(_score(a, F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(*cuts).alias("cut"))
    three = three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

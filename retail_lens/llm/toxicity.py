"""Toxicity grades by a cumulative-link ordinal regression over words and their beginnings.

Grades are ordered: 0 is clean, 1 to 3 are toxic with a growing number of marker words. The
model has one weight per word and one threshold per grade, P(grade >= k) = s(w x - t_k), so all
thresholds share the weights. The expected severity is the sum of these probabilities.

The score is that of windows of WINDOW words, which cover the whole text and overlap by half; the
highest counts. So a text is not more toxic for being longer, and a toxic passage counts in
however long a text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lens.llm.common import staging

GRADES = 3
_WORD = re.compile(r"[^\W\d_]+")
#: Longer words also give their beginning as a feature, marked so that it is no word.
BEGINNING = 4
#: Least log likelihood ratio of a feature, against words that stand in toxic documents by chance.
LEAST_GAIN = 6.0
#: Words of a window. One begins at every half window, the last one ends with the text.
WINDOW = 128


def words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall((text or "").lower())


def features_of(found: list[str]) -> set[str]:
    """The different words of a text and their beginnings."""
    different = set(found)
    return different | {w[:BEGINNING] + "~" for w in different if len(w) > BEGINNING}


def windows(n: int) -> list[tuple[int, int]]:
    """Begin and end of each window of a text of n words; one window if these are few."""
    last = max(0, n - WINDOW)
    return [(b, b + WINDOW) for b in range(0, last, WINDOW // 2)] + [(last, n)]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, text: str | None) -> float:
        """The highest sum of the weights of a window's features."""
        found = words(text)
        known = [(i, own) for i, w in enumerate(found) if (own := self.weights.keys() & features_of([w]))]
        at = [i for i, _ in known]
        best = -math.inf
        for begin, end in windows(len(found)):
            own = set().union(*(f for _, f in known[bisect_left(at, begin) : bisect_left(at, end)]))
            best = max(best, math.fsum(map(self.weights.__getitem__, own)))
        return best

    def probabilities(self, text: str | None) -> list[float]:
        """P(grade >= k) for k from 1."""
        at = self.score(text)
        return [1 / (1 + math.exp(min(700.0, t - at))) for t in self.thresholds]


#: Finds nothing toxic; what is fitted where there are no toxic labels.
NOTHING = Model({}, (50.0,) * GRADES)


def sample(docs: DataFrame, labels: DataFrame, per_class: int, text: str, key: str, label: str) -> DataFrame:
    """At most ``per_class`` labelled documents of either class, by a hash of the key: k, toxic, of (rows of the class), text.

    A key with several labels counts as toxic if one of them does.
    """
    one = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    one = one.groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    one = staging(docs.sparkSession)(one, "labels")
    rows = dict(one.groupBy("toxic").count().collect())
    chosen = [
        one.filter(F.col("toxic") == c).orderBy(F.xxhash64("k"), "k").limit(per_class).withColumn("of", F.lit(rows[c]))
        for c in (0, 1)
        if c in rows
    ]
    if len(chosen) < 2:
        chosen = [one.limit(0).withColumn("of", F.lit(0).cast("long"))] * 2
    few = chosen[0].unionByName(chosen[1])  # two times per_class rows of three numbers
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    return own.join(F.broadcast(few), "k").dropDuplicates(["k"]).dropDuplicates(["text"])


def _word_rows(labelled: DataFrame) -> DataFrame:
    """One row per window (of the document k, with the number at) and feature, and one with an empty word."""
    names, types = ["k", "at", "toxic", "of", "word"], [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for k, text, toxic, of in zip(*(batch.column(i) for i in range(4)), strict=True):
                k, toxic, of, found = k.as_py(), toxic.as_py(), of.as_py(), words(text.as_py())
                for at, (begin, end) in enumerate(windows(len(found))):
                    out += [(k, at, toxic, of, w) for w in ["", *sorted(features_of(found[begin:end]))]]
                    if len(out) >= 50_000:
                        yield rows(out)
                        out = []
            yield rows(out)

    return labelled.select(F.col("k").cast("long"), "text", "toxic", "of").mapInArrow(
        run, "k long, at int, toxic int, of long, word string"
    )


def _telling(rows: DataFrame, clean_n: int, toxic_n: int, features: int) -> tuple[dict[str, int], list[bool]]:
    """The words whose presence depends most on the label, numbered, and whether each is a marker; rows: word, toxic."""
    found = rows.filter("word <> ''").groupBy("word").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")
    )

    def term(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    share = (F.col("a") + F.col("b")) / (clean_n + toxic_n)
    gain = sum(
        (
            term(F.col(c), share * n) + term(n - F.col(c), (1 - share) * n)
            for c, n in (("a", toxic_n), ("b", clean_n))
        ),
        F.lit(0.0),
    )
    top = found.filter("a >= 2").select("word", "a", "b", F.round(gain, 9).alias("gain"))
    top = sorted(top.filter(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "word").limit(features).collect())
    marks = [r["a"] / toxic_n >= 20 * (r["b"] + 0.5) / clean_n and r["word"][-1] != "~" for r in top]
    return {r["word"]: i for i, r in enumerate(top)}, marks


def _known(rows: DataFrame, number: dict[str, int], marks: list[bool]) -> DataFrame:
    """Per window: k, at, toxic, own (sorted numbers of its features) and how many markers it has."""
    numbers = [(w, i, marks[i]) for w, i in number.items()] + [("", None, False)]
    numbers = F.broadcast(rows.sparkSession.createDataFrame(numbers, "word string, i int, mark boolean"))
    return rows.join(numbers, "word").groupBy("k", "at", "toxic").agg(
        F.sort_array(F.collect_list("i")).alias("own"), F.count_if("mark").alias("markers")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 4000,
    features: int = 1024,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
) -> Model:
    """Fit on at most ``per_class`` labelled documents of either class and ``features`` words.

    Features are those whose presence depends most on the label, by likelihood ratio. Markers are
    the words found in toxic texts twenty times as often as in clean ones. Both are first taken from whole
    documents. Of a toxic document the window with the most of these markers teaches, since its others may
    be clean; of a clean one all windows do. From the teaching windows features and markers are taken
    anew, and the terciles of the number of markers in the toxic ones make the grades. Rows are weighted so that
    the classes count as they do among all labels. Without labels of both classes
    nothing is found toxic.
    """
    stage = staging(docs.sparkSession)
    rows = stage(_word_rows(sample(docs, labels, per_class, text, key, label)), "words")
    heads = rows.filter("word = ''").groupBy("toxic").agg(
        F.count(F.lit(1)).alias("windows"), F.countDistinct("k").alias("docs"), F.max("of").alias("of")
    )
    heads = {r["toxic"]: r for r in heads.collect()}
    if len(heads) < 2:
        return NOTHING
    whole = rows.select("k", "word", "toxic").distinct()
    number, marks = _telling(whole, heads[0]["docs"], heads[1]["docs"], features)
    most = _known(rows.filter("toxic = 1"), number, marks).groupBy("k")
    most = stage(most.agg(F.max_by("at", F.struct("markers", -F.col("at"))).alias("at")), "teaching")
    rows = rows.filter("toxic = 0").unionByName(rows.filter("toxic = 1").join(F.broadcast(most), ["k", "at"]))
    number, marks = _telling(rows, heads[0]["windows"], heads[1]["docs"], features)
    if not number:
        return NOTHING
    each = _known(rows, number, marks)
    # One row per sampled toxic document; clean windows with the same features are one row.
    taught = sorted(tuple(r) for r in each.filter("toxic = 1").select("own", "markers").collect())
    clean = sorted(tuple(r) for r in each.filter("toxic = 0").groupBy("own").count().collect())
    owned = [np.array(own, int) for own, _ in taught + clean]
    row, column = np.repeat(np.arange(len(owned)), [len(o) for o in owned]), np.concatenate(owned)
    markers = np.array([m for _, m in taught])
    cuts = np.quantile(markers, [1 / 3, 2 / 3])
    grade = np.concatenate([1 + (markers[:, None] > cuts).sum(1), np.zeros(len(clean), int)])
    per = [heads[c]["of"] / heads[c]["docs"] for c in (0, 1)]
    weight = np.array([per[1]] * len(taught) + [per[0] * n for _, n in clean])
    weights, thresholds = _train(row, column, grade, weight / weight.sum(), len(number))
    return Model({w: float(weights[i]) for w, i in number.items()}, tuple(map(float, thresholds)))


def _train(row, column, grade, weight, features: int, rounds: int = 1000, decay: float = 3e-5, rate: float = 0.3):
    """Minimise the summed log losses of all thresholds with shared weights, by Adam over all rows."""
    n = len(grade)
    above = grade[:, None] >= np.arange(1, GRADES + 1)
    state = np.concatenate([np.zeros(features), np.arange(1, GRADES + 1.0)])
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        score = np.bincount(row, state[column], n)
        with np.errstate(over="ignore"):
            wrong = (1 / (1 + np.exp(state[features:] - score[:, None])) - above) * weight[:, None]
        slope = np.concatenate(
            [np.bincount(column, wrong.sum(1)[row], features) + decay * state[:features], -wrong.sum(0)]
        )
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        pace = rate * (1 - step / (rounds + 1))
        state -= pace * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return state[:features], np.sort(state[features:])


def grade(docs: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """Add a struct: severity (expected grade), grade (the highest as likely as not), p_toxic and toxic (p_toxic >= 0.5).

    Whole texts count, by their window of the highest score; a null or empty text has the score of no words. All rows and columns
    stay, a column named as ``into`` is replaced.
    """

    @F.pandas_udf("severity double, grade int, p_toxic double, toxic boolean")
    def run(texts):
        import pandas as pd

        p = np.array([model.probabilities(t) for t in texts]).reshape(len(texts), GRADES)
        return pd.DataFrame(
            {"severity": p.sum(1), "grade": (p >= 0.5).sum(1).astype("int32"), "p_toxic": p[:, 0], "toxic": p[:, 0] >= 0.5}
        )

    return docs.withColumn(into, run(F.col(text)))

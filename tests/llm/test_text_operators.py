"""Operators on documents against the libraries or brute force."""

from __future__ import annotations

import hashlib
import random
import textwrap
import zlib

import public_tokenizers
import pytest
import sentencepiece
from llm.helpers import LONG, TEXTS, components, documents, empty, shingles, words
from pyspark.sql import functions as F
from retail_lens.llm import bpe_automaton, licences, minimax_shards, mixing, ngram_join, token_counts, toxicity
from retail_lens.llm.common import Leaving, staging
from retail_lens.llm.shingles import shingle_set
from tokenizers import Tokenizer

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


def odd_texts(n=1500):
    rng = random.Random(4)
    letters = "ab cd\n \té1'.,<|>s日▁  \u0085\x1c"
    return TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_token_counts_equal_the_library(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.PieceCounter(PIECES, cache_size=50)
    texts = odd_texts()
    assert counter.counts(texts) == [len(model.encode(t or "")) for t in texts]
    got = token_counts.token_counts(docs, PIECES, limit=100).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].n_tokens == 0 and by_id[0].n_bytes == 0 and by_id[9].over_limit
    assert by_id[8].n_tokens == len(model.encode(TEXTS[8])) and by_id[8].n_bytes == len(TEXTS[8].encode())
    assert token_counts.token_counts(empty(spark), PIECES).count() == 0


def test_automaton_equals_the_library():
    library, machine = Tokenizer.from_file(BYTES), bpe_automaton.Automaton(BYTES, cache_size=40)
    for text in odd_texts():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert machine.encode(text or "") == ids
        assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False) == (text or "")


def test_texts_rendered_together_equal_the_library_and_words_are_kept_once():
    library, machine = Tokenizer.from_file(BYTES), bpe_automaton.Automaton(BYTES, cache_size=40)
    gaps = ["one two  three", " one two", "one two ", "one\ntwo three", "one 'stwo \u2003 x", "a <|endoftext|> b c", "it's 12 ab's"]
    texts = [t or "" for t in odd_texts()] + gaps
    for text, (n, shown, decoded) in zip(texts, machine.render_all(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert (n, shown, decoded) == (len(ids), ",".join(map(str, ids)), text.encode())
    assert machine.render_all([]) == []
    # Stretches and their words share one bounded memory.
    assert not machine.words.new and not machine.words.old and len(machine.shown.new) + len(machine.shown.old) <= 80


def test_round_trip(spark, docs):
    library = Tokenizer.from_file(BYTES)
    got = bpe_automaton.round_trip(docs, BYTES).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None and r.doc_id < len(TEXTS):
            text = TEXTS[r.doc_id] or ""
            ids = library.encode(text, add_special_tokens=False).ids
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    both = bpe_automaton.decode(bpe_automaton.encode(docs, BYTES), BYTES, text="back")
    assert both.filter("not (coalesce(text, '') <=> back)").count() == 0
    assert bpe_automaton.round_trip(empty(spark), BYTES).count() == 0


def _least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > middle:
                used, at = used + 1, 0
            at += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_smallest_capacity_is_exact(spark, shards):
    rng = random.Random(shards)
    sizes = {rng.getrandbits(63): rng.choice([17, 30, 500, 4000]) for _ in range(3000)}
    sizes |= {(5 << 40) + i: 900 for i in range(300)}  # many groups with one beginning
    groups = spark.createDataFrame(list(sizes.items()), "group long, size long")
    capacity, segments = minimax_shards.smallest_capacity(groups, shards)
    assert capacity == _least_capacity([sizes[k] for k in sorted(sizes)], shards)
    cuts = minimax_shards.even_cuts(segments, capacity, shards)
    assert cuts == sorted(cuts) and len(cuts) <= shards - 1
    parts = [0] * shards
    for k, s in sizes.items():
        parts[sum(k >= c for c in cuts)] += s
    assert max(parts) <= capacity


def test_shards(spark, docs):
    got = minimax_shards.shard(docs, shards=5).collect()
    assert len(got) == docs.count()
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r.shard for r in got} <= set(range(5)) and {r.law for r in got} == {"bytes"}
    assert len({r.shard for r in got if r.doc_id in (5, 40)}) == 1
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].size == 16 and by_id[0].text_crc32 is None and by_id[1].text_crc32 == 0
    assert by_id[8].size == len(TEXTS[8].encode()) + 16 and by_id[8].text_crc32 == zlib.crc32(TEXTS[8].encode())
    assert minimax_shards.shard(empty(spark)).count() == 0


def test_targets_stop_at_the_limit():
    assert mixing.targets([10, 10, 1000], [5, 2, 1], 3) == pytest.approx([30, 30, 960])
    assert mixing.targets([0, 0], [1, 2], 3) == [0, 0] and mixing.targets([], [], 3) == []


def test_split_meets_every_quota():
    parts = mixing.split([100, 0, 7, 1000], 12, 3)
    assert [sum(c) for c in zip(*parts, strict=True)] == [100, 0, 7, 1000]
    assert max(map(sum, parts)) - min(map(sum, parts)) <= 1 and min(map(min, parts)) >= 0
    assert parts == mixing.split([100, 0, 7, 1000], 12, 3)


def test_mixing(spark, docs):
    mixed = mixing.mix(docs, block_words=64, shards=4)
    got = mixed.select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(got) == docs.count()
    names = sorted({r.source for r in got if r.source is not None}) + [None]
    sizes = [sum(r.size for r in got if r.source == n) for n in names]
    aims = mixing.targets(sizes, [5, 2, 1, 5][: len(names)], 3)
    for name, size, aim in zip(names, sizes, aims, strict=True):
        own = [r for r in got if r.source == name]
        assert {(r.source_size, round(r.target, 6)) for r in own} == {(size, round(aim, 6))}
        assert sum(r.taken for r in own) == min(round(aim), 3 * size)
    assert all(r.taken <= 3 * r.size for r in got)
    assert all(r.size == len(words(TEXTS[r.doc_id])) for r in got if r.doc_id is not None and r.doc_id < len(TEXTS))
    listed = mixing.listing(mixed).collect()
    assert sum(r.words for r in listed) == sum(r.taken for r in got)
    assert len({(r.doc_id, r["copy"], r.first_word) for r in listed if r.doc_id not in (5, None)}) == sum(
        r.doc_id not in (5, None) for r in listed
    )
    again = mixing.mix(docs.repartition(5), block_words=64, shards=4)
    columns = ["doc_id", "source", "taken", "pieces"]
    assert sorted(map(repr, mixed.select(columns).collect())) == sorted(map(repr, again.select(columns).collect()))
    whole = mixing.repeated(docs)
    assert whole.columns == docs.columns
    assert whole.select("doc_id", "text").distinct().exceptAll(docs.select("doc_id", "text").distinct()).count() == 0
    assert mixing.mix(empty(spark)).count() == 0 and mixing.repeated(empty(spark)).count() == 0


def _family(rng):
    """Near copies, copies of copies, a passage many share, and unrelated texts."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            base = copy if rng.random() < 0.5 else base
    texts += [f"{' '.join(word() for _ in range(rng.randint(5, 90)))} {passage}" for _ in range(25)]
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_ngram_join_equals_brute_force(spark, width, percent):
    rng = random.Random(percent)
    texts = TEXTS + _family(rng)
    texts.insert(20, texts[-1])
    rows = list(enumerate(texts))
    sets = {i: shingles(t, width) for i, t in rows}
    linked = [
        (i, j)
        for i, _ in rows
        for j, _ in rows
        if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    want = components([i for i, _ in rows], linked)
    df = spark.createDataFrame([*rows, (None, texts[5])], "doc_id long, text string").repartition(3)
    got = ngram_join.ngram_join(df, width, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == [
        (i, len(sets[i]), want[i]) for i, _ in rows
    ]
    assert [r.component_id for r in got if r.doc_id is None] == [None]


def test_ngram_join_compares_few_of_many_near_copies(spark, monkeypatch):
    """Copies that lie near the threshold on both sides list the same shingles, but are not compared with one another."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base, rows = [word() for _ in range(400)], []
    for i in range(160):
        copy = list(base)
        for place in rng.sample(range(1, 400), i % 14):
            copy[place] = word()
        rows.append((i, " ".join(copy)))
    sets = {i: shingles(t, 3) for i, t in rows}
    linked = [(i, j) for i, _ in rows for j in range(i) if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    compared = []
    sieved = ngram_join._sieved

    def counted(pairs, *others):
        compared.append(pairs.count())
        return sieved(pairs, *others)

    monkeypatch.setattr(ngram_join, "_sieved", counted)
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in got} == components(list(sets), linked)
    assert sum(compared) < 10 * len(rows)


def test_staged_steps_leave_no_shuffle_files(spark):
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before, setting = tracker.shuffleStatuses().size(), spark.conf.get(Leaving.SETTING, None)
    counts = staging(spark)(spark.range(1000).groupBy((F.col("id") % 7).alias("rest")).count(), "counts")
    assert tracker.shuffleStatuses().size() <= before
    assert counts.count() == 7 and spark.conf.get(Leaving.SETTING, None) == setting


def test_ngram_join_edges(spark, docs):
    kept = ngram_join.one_of_each(docs, width=3, percent=60)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect())
    assert [i for _, i in ids] == [0, 1, 2, 3, 4, 5, 8, 9, 11, None]
    assert ngram_join.ngram_join(empty(spark)).count() == 0


def test_shingles_of_long_texts():
    assert len(shingle_set(LONG.encode(), 3)) == len(shingles(LONG, 3))
    big = ("x" * 3_000_000 + " " + LONG * 8).encode()
    assert len(shingle_set(big, 2)) == len(shingles(big.decode(), 2))


def _labelled(spark, n=400):
    rng = random.Random(9)
    plain = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "grass"]
    bad = ["grobian", "lumpazi", "schuft"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 8) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), "x"))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (3, None), (n + 5, 1), (0, 0)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, toxicity string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_toxicity(spark, docs):
    rows, labels = _labelled(spark)
    model = toxicity.fit(rows, labels.filter("doc_id < 300"))
    assert list(model.thresholds) == sorted(model.thresholds)
    got = toxicity.grade(rows, model).select("doc_id", "toxicity.*").collect()
    held = [r for r in got if r.doc_id >= 300]
    right = sum(r.toxic == (r.doc_id % 5 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.severity <= 3 and r.grade <= 3 for r in got)
    few, many = ("grobian lumpazi", "grobian schuft lumpazi " * 3)
    assert model.score(few) <= model.score(many)
    assert toxicity.fit(rows, labels.filter("doc_id < 300")) == model
    edge = toxicity.grade(docs, model)
    assert edge.count() == docs.count() and edge.filter("toxicity.toxic").count() == 0
    assert toxicity.fit(rows, labels.filter("toxic = 0")) == toxicity.NOTHING
    assert toxicity.fit(empty(spark), labels) == toxicity.NOTHING
    assert toxicity.grade(empty(spark), model).count() == 0


def test_toxicity_does_not_depend_on_length(spark):
    """Clean texts of 100,000 characters and more in each language stay clean; a toxic passage in them counts."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter("doc_id % 3 <> 0"))
    held = docs.join(labels.filter("doc_id % 3 = 0"), "doc_id").filter("text is not null").orderBy("doc_id").collect()
    clean = [r for r in held if not r.toxic]
    assert sum(model.probabilities(r.text)[0] >= 0.5 for r in clean) <= 0.005 * len(clean)
    passage = " ".join(["the trash idiot was a pathetic moron and scum"] * 4)
    for lang in ("en", "fr", "de", "es"):
        long, at = [""], 0
        for text in (r.text for r in clean if r.lang == lang and model.probabilities(r.text)[0] < 0.5):
            if len(long[-1]) >= 100_000 * (1 + at % 3):
                long.append("")
                at += 1
            long[-1] += "\n" + text
        long = [t for t in long if len(t) >= 100_000]
        assert long and [lang for t in long if model.probabilities(t)[0] >= 0.5] == []
        assert all(model.probabilities(t[:50_000] + "\n" + passage + "\n" + t[50_000:])[0] >= 0.5 for t in long)


def test_licences(spark, docs):
    lines = [(i, "plain words here\n" + t + "\nthe software of this file is good", f) for i, (f, t) in enumerate((f, t) for f, ts in licences.TEMPLATES.items() for t in ts)]
    lines.append((500, "this library of public software has general source files in the work", None))
    df = spark.createDataFrame(lines, "doc_id long, text string, family string")
    model = licences.fit(docs)
    got = {(r.doc_id, r.paragraph): r.family for r in licences.scan(df, model).collect()}
    want = {(i, 1): f for i, _, f in lines if f}
    assert got == want
    edge = licences.scan(docs, model).collect()
    assert [(r.doc_id, r.paragraph, r.family) for r in edge] == [(11, 0, "MIT")]
    assert licences.scan(empty(spark), licences.fit(empty(spark))).count() == 0


def test_wrapped_and_short_licences(spark):
    """Hard-wrapped licences give their family, with comment marks too; short ones need no long word."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = licences.fit(docs)
    rows, want = [], set()
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            for width, mark in ((30, ""), (45, "# "), (65, " * ")):
                wrapped = textwrap.wrap(text, width)
                if len(wrapped) > 1:
                    want.add((len(rows), 1, family))
                    rows.append((len(rows), "\n".join(["some plain words", *(mark + t for t in wrapped), "more plain words"])))
    for text, family in (("CC BY 4.0", "CC-BY"), ("CC BY-NC 4.0", "CC-BY-NC")):
        want.add((len(rows), 0, family))
        rows.append((len(rows), text))
    pair = ["Licensed under CC BY 4.0.", *textwrap.wrap(licences.TEMPLATES["Apache"][1], 40)]
    want |= {(len(rows), 0, "CC-BY"), (len(rows), 0, "Apache")}
    rows.append((len(rows), "\n".join(pair)))
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    got = {(r.doc_id, r.paragraph, r.family) for r in got}
    assert {(i, f) for i, _, f in got} == {(i, f) for i, _, f in want}, sorted(got ^ want)


def test_columns_are_read_by_name(docs):
    """Clashing names of other columns change nothing."""
    odd = docs.withColumns({"group": F.lit(1), "shard": F.lit("x"), "n": F.lit(2), "k": F.lit(3), "words": F.lit(1), "h": F.lit(0)})
    assert minimax_shards.shard(odd, shards=3).columns == minimax_shards.shard(docs, shards=3).columns
    assert mixing.repeated(odd).columns == odd.columns

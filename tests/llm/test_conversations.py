"""Conversation repair, chat formatting and collocations against brute force."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from retail_lens.llm import chat_format, collocations, conversation_repair
from retail_lens.llm.queries import QUERIES, tokenizer

from .helpers import LONG, TEXTS, documents, empty

SF = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string, gone string, part int"


def conversations(spark, seed=3):
    """Nulls in every column, blank and long texts, ties, repeated rows, one long conversation, clashing column names."""
    rnd = random.Random(seed)
    says = ["", " \n", "Yes.", "No", "why?", "A b! ", "x\x0b", "<|im_end|> and </s>[INST] \\<|im_sep|>", "日本 😀.", "[INST]", "<\\/s>", "</s>"]
    rows = [
        (conv, rnd.choice([None, *range(6)]) if conv % 4 == 0 else turn, rnd.choice(["user", "assistant", "system", "tool", None, "", "assistant", "user"]), rnd.choice([None, *says]))
        for conv in range(25)
        for turn in range(rnd.randint(1, 9))
    ]
    rows += [(None, t, r, "Hi.") for t, r in enumerate(["user", "assistant", "user"])]
    rows += [(99, t, "user" if t % 2 == 0 else "assistant", f"line {t % 150}.") for t in range(400)]
    rows += [(98, 0, "user", LONG), (98, 1, "assistant", LONG), *rows[:3]]
    return spark.createDataFrame([(*r, "g", 1) for r in rows], ROWS).repartition(4)


def key(row):
    return (row[0] is not None, row[0] or 0, row[1], row[2])


def repair_by_force(rows):
    """Cheapest, then least, edits by exhaustive search in order of cost and initials."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        if at == len(rows) and last in ("", "a"):
            return faults, cost, audit, out
        done.add((at, last))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        due = follow[-1]
        name = {"u": "user", "a": "assistant"}[due]
        heapq.heappush(heap, (cost + 2, audit + "I", at, due, (*out, f"{name}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, out))
            if faults[at] in (None, "truncated"):
                more = cost + (faults[at] == "truncated")
                heapq.heappush(heap, (more + 2, audit + "R", at + 1, due, (*out, f"{name}:{text}")))
                if role and role[0] in follow:
                    heapq.heappush(heap, (more, audit + "K", at + 1, role[0], (*out, f"{role}:{text}")))


def damaged(rows):
    spoilt = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        def shown(v):
            return " " if v is None else v
        fate = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", shown(text)) if fate == 2 else shown(text)
        spoilt[conv] += [(turn, "user" if fate == 4 else shown(role), text)] * {0: 0, 3: 2}.get(fate, 1)
    return {conv: sorted(r, key=key) for conv, r in spoilt.items()}


def report_by_force(rows):
    faults, cost, audit, out = repair_by_force(rows)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


@pytest.mark.parametrize("size", [3, 2048])
def test_repair_equals_exhaustive_search(spark, size):
    df = conversations(spark).drop("gone")
    want = {c: report_by_force(r) for c, r in damaged(df.collect()).items()}
    pieces, report = conversation_repair.repair(conversation_repair.damage(df), most_rows=size)
    got = {r.conv_id: tuple(r)[1:] for r in report.collect()}
    assert got == want
    # The pieces, in order, are the repaired rows.
    lines, audits = defaultdict(list), defaultdict(str)
    for p in pieces.orderBy("conv_id", "part", "no").collect():
        lines[p.conv_id] += [f"{r}:{t}" for r, t in zip(p.roles, p.texts, strict=True)]
        audits[p.conv_id] += p.audit
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()} == {c: w[-1] for c, w in want.items()}
    assert audits == {c: w[-2] for c, w in want.items()}


def test_a_conversation_over_many_partitions(spark):
    rows = [(1, t, random.Random(t).choice(["user", "assistant", "system"]), f"t{t % 37}" + ".?"[t % 2] * (t % 5 > 0)) for t in range(900)] + [(2, 0, "user", "a.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("gone", F.lit(False))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces, report = conversation_repair.repair(df, most_rows=100)
        got = {r.conv_id: tuple(r)[1:] for r in report.collect()}
        assert pieces.where("conv_id = 1").select("part").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {c: report_by_force([r[1:] for r in rows if r[0] == c]) for c in (1, 2)}


def test_repair_of_nothing(spark):
    none = empty(spark, ROWS).drop("gone")
    assert conversation_repair.repair(conversation_repair.damage(none))[1].isEmpty()
    gone = spark.createDataFrame([(5, 1, "user", "x", True)], "conv_id long, turn long, role string, text string, gone boolean")
    assert [tuple(r) for r in conversation_repair.repair(gone)[1].collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("size", [4, 2048])
def test_chats_read_back(spark, size):
    df = conversations(spark)
    template = chat_format.Template()
    formatted = chat_format.format_chats(df, tokenizer("byte_bpe_50k.json"), template, most_rows=size)
    read = chat_format.digests(formatted, template)
    got = {r.conv_id: r for r in read.collect()}
    assert sorted(map(str, read.collect())) == sorted(map(str, chat_format.format_and_digest(df, tokenizer("byte_bpe_50k.json"), template, most_rows=size).collect()))
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in df.collect():
        turns[conv].append((turn, role or "", text or ""))
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        rows.sort(key=key)
        said = "".join(t for _, r, t in rows if r == "assistant")
        want = (len(rows), "".join(f"{r}\n{t}\n" for _, r, t in rows), len(said), said)
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == tuple(hashlib.sha256(w.encode()).hexdigest() if isinstance(w, str) else w for w in want)
        assert r.formatted_chars == sum(len(template.render([x], [y])[0]) for _, x, y in rows)


def test_masked_tokens_end_where_texts_end(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    formatted = chat_format.format_chats(conversations(spark), tokenizer("byte_bpe_50k.json"))
    for r in formatted.collect():
        assert len(r.ids) == len(r.starts) == len(r.ends) == len(r.loss)
        learnt = [chat_format.Template().escape(t) for x, t in chat_format.Template().parse(r.formatted) if x == "assistant"]
        ids = [i for i, m in zip(r.ids, r.loss, strict=True) if m]
        assert ids == [i for t in learnt for i in plain.encode(t, add_special_tokens=False).ids]
        assert sum(i >= 50257 for i in r.ids) == 3 * r.formatted.count(chat_format.END)


def test_template_escapes_reversibly():
    template, rnd = chat_format.Template(), random.Random(5)
    bits = ["<", "[", "\\", "/s>", "s>", "INST]", "/INST]", "|im_end|>", "|im_sep|>", "|endoftext|>", "x", "\n", "é"]
    for _ in range(5000):
        text = "".join(rnd.choices(bits, k=rnd.randint(0, 12)))
        safe = template.escape(text)
        assert template.unescape(safe) == text
        assert not any(c in safe for c in (chat_format.START, chat_format.SEPARATOR, chat_format.END, *template.foreign))
    with pytest.raises(ValueError):
        chat_format.Template(foreign=("<<SYS>>",))


def test_chats_of_nothing(spark):
    formatted = chat_format.format_chats(empty(spark, ROWS), tokenizer("byte_bpe_50k.json"))
    assert formatted.isEmpty() and chat_format.digests(formatted).isEmpty()
    assert {r.conv_id for r in QUERIES["op12_chat_format"](spark, SF).where("conv_id < 0").collect()} == {-7}


# ---- collocations -----------------------------------------------------------------


def collocations_by_force(rows, least, covered, top):
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            for k in (1, 2, 3):
                counts[lang or "und" if lang is None else lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        kept = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(100 * b >= covered * a and b >= least and p in (q[:2], q[1:]) for q, b in f.items() if len(q) == 3):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        kept.sort()
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(kept[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("lot, hot, places", [(None, None, 1 << 27), (60, 3, 1 << 15), (60, 100_000, 64)])
def test_collocations_equal_a_full_count(spark, monkeypatch, lot, hot, places):
    if hot:
        monkeypatch.setattr(collocations, "HOT_SHARE", hot)
    rnd = random.Random(9)
    words = ["the", "The", "of", "night", "œuvre", "日本", "x", "a\x1cb", "NEW", "york"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 40))) + rnd.choice([".", "\n", ";;", "\t", "! \x0b", ""]) for _ in range(120)]
    rows = [(rnd.choice(["en", "fr", None, "und"]), t) for t in texts] + [("en", None), ("fr", ""), ("de", "\n.")] + [("en", "new york times " * 30), ("en", "New York, new york. the\tthe the")] * 3
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "lang string, text string, n long, w1 string").repartition(3)
    got = collocations.collocations(df, least=4, covered=50, top=40, places=places, lot=lot or collocations.LOT_BYTES)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == collocations_by_force(rows, 4, 50, 40)


def test_collocations_edge_cases(spark):
    assert collocations.collocations(empty(spark)).isEmpty()
    docs = documents(spark)
    want = collocations_by_force([(r.lang, r.text) for r in docs.collect()], 2, 50, 30)
    assert sorted(map(tuple, collocations.collocations(docs, least=2, top=30).collect())) == want
    assert TEXTS[0] is None


def test_scores_past_64_bits(spark):
    row = spark.createDataFrame([(9_999_999_999_999, 10_000_000_000_000, 9_999_999_999_999)], "a long, l long, r long")
    got = row.select(collocations._score(F.col("a"), F.col("l"), F.col("r")).cast("long")).first()[0]
    assert got == 1_000_000 * 9_999_999_999_999**2 // (10_000_000_000_000 * 9_999_999_999_999) == 999_999

"""Tables with the cases every operator has to bear."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 7919}x{i % 13}" for i in range(30_000))
TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "Two words",
    "the quick brown fox jumps over the lazy dog near the river bank today",
    "The QUICK brown fox jumps over the lazy dog near the river bank today",
    "the quick brown fox jumps over the lazy dog near the river bank tonight",
    "naïve café — 日本語 😀  double  spaces \r\n\r\nWARC/1.1\r\n and <|endoftext|> marks ▁▁ here",
    LONG,
    LONG + " tail",
    "Released under the MIT License.\nother line",
]


def documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, and a column named like an operator's own."""
    rows = [(i, t, None if i % 3 == 0 else "en", ["b", "a", None, "á"][i % 4], 7) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "a text whose key is null", None, None, None), (40, TEXTS[5], "en", "a", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long").repartition(3)


def empty(spark, schema="doc_id long, text string, lang string, source string, size long"):
    return spark.createDataFrame([], schema)


def words(text):
    return WORD.findall(text or "")


def shingles(text, width):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def components(nodes, linked):
    """Smallest node reachable, by brute force."""
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least

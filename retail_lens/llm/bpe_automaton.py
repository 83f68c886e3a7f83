"""Byte-level BPE by a deterministic tokenization automaton.

The automaton reads a token sequence: a state stands for the last token, an arc for the
next one, and it accepts exactly the sequences that BPE produces. It is built from the
merge list by one gadget per merge. The gadget of ``a b -> c`` adds the state ``c`` with
arcs labelled ``c`` that go around the pair, and cuts the arc ``b`` that leaves ``a`` and
whatever inherited it: a later token that ends in ``a`` (its right spine) followed by one
that begins with ``b`` (its left spine), as long as both parts were still apart when the
merge's turn came. Since the state reached is always the label itself, a row of the
transition table is fully described by which labels are cut, and since rows would be
50,000 wide, an entry is computed from the gadgets at its first use and then kept.

A pre-split word has exactly one accepted path, and so has each of its prefixes. Encoding
follows open arcs from the left, longest label first, and turns back where none is left. A
place it turned back from is never entered again: the one path that leads there was taken.
Decoding writes out the arc labels.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lens.llm.common import Recent

#: Fixed value: the public pre-split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space between two characters that are not white space always begins a new word.
_GAP = re.compile(r"(?<=\S) (?=\S)")
#: A space next to white space or to an end of the text.
_NO_GAP = re.compile(r" (?:(?!\S)|(?<!\S ))")
#: Longer words hardly come back and are not remembered.
LONGEST_KEPT = 64
#: Texts are rendered together up to so many characters.
CHUNK = 4_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Automaton:
    """Transition tables compiled from a tokenizer file; ``cache_size`` bounds each table kept."""

    def __init__(self, file: str, cache_size: int = 200_000):
        import regex

        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        ids: dict[str, int] = model["vocab"]
        self.labels: dict[int, bytes] = {i: bytes(letters[c] for c in s) for s, i in ids.items()}
        #: Strings that stand for one token wherever they occur in a text.
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with conditions are not supported")
        self.labels |= {i: s.encode() for s, i in self.special.items()}
        self.sizes = {i: len(label) for i, label in self.labels.items()}
        self.decimals = {i: str(i) for i in self.labels}
        self.split = regex.compile(PATTERN)
        self.cut_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._start({b: ids[c] for c, b in letters.items()})
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(rank, ids[left], ids[right], ids[left + right])
        #: Label -> the longest other label that it begins with, of those with an arc.
        self.shorter: dict[int, int] = {}
        self._shorten(self.tree, None)
        self.arcs = Recent(cache_size)
        self.words = Recent(cache_size)
        #: Word or stretch -> number of its ids, the ids in decimal, the arc labels joined.
        self.shown = Recent(cache_size)

    def _start(self, of_byte: dict[int, int]) -> None:
        """One arc per byte. ``tree`` holds the labels letter by letter: [next by byte, label that ends here]."""
        self.tree: list = [{b: [{}, i] for b, i in of_byte.items()}, None]
        self.rank = dict.fromkeys(of_byte.values(), -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.fires: dict[tuple[int, int], int] = {}

    def _gadget(self, rank: int, a: int, b: int, c: int) -> None:
        """Cut the arc b after a from this turn on and lead a new arc c around the pair.

        Where earlier gadgets have already parted the two, c has no path and gets no arc.
        """
        if c in self.rank or (a, b) in self.fires:
            raise ValueError("a merge occurs twice")
        met = self._open(a, b, rank)
        self.rank[c], self.parts[c], self.fires[a, b] = rank, (a, b), rank
        if met:
            node = self.tree
            for byte in self.labels[c]:
                node = node[0].setdefault(byte, [{}, None])
            node[1] = c

    def _shorten(self, node: list, above: int | None) -> None:
        if node[1] is not None:
            if above is not None:
                self.shorter[node[1]] = above
            above = node[1]
        for below in node[0].values():
            self._shorten(below, above)

    def _open(self, u: int, v: int, turn: int) -> bool:
        """Whether no gadget before ``turn`` cuts the arc v that leaves state u.

        Goes back in time: whichever of the two border tokens was made last is replaced by
        its part at the border. A merge of the two cuts the arc if its turn came before
        either was absorbed; at one turn the one further left goes first.
        """
        fires, rank, parts = self.fires, self.rank, self.parts
        end_u = end_v = turn
        while True:
            at = fires.get((u, v))
            if at is not None and at < end_u and at <= end_v:
                return False
            of_u, of_v = rank[u], rank[v]
            if of_u > of_v:
                end_u, u = of_u, parts[u][1]
            elif of_v >= 0:
                end_v, v = of_v, parts[v][0]
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        """The labels along the word's accepted path."""
        size, sizes, shorter, arcs = len(word), self.sizes, self.shorter, self.arcs
        path: list[int] = []
        left: set[int] = set()
        at, u, v = 0, None, self._longest(word, 0)
        while True:
            while v is not None:
                end = at + sizes[v]
                if end not in left:
                    if u is None:
                        break
                    arc = u << 32 | v
                    is_open = arcs.new.get(arc)
                    if is_open is None:
                        is_open = arcs.get(arc)
                        if is_open is None:
                            is_open = self._open(u, v, len(self.fires))
                            arcs.put(arc, is_open)
                    if is_open:
                        break
                v = shorter.get(v)
            if v is not None:
                path.append(v)
                if end == size:
                    return path
                at, u, v = end, v, self._longest(word, end)
            else:
                if u is None:
                    raise AssertionError("a word without a path")
                left.add(at)
                at -= sizes[path.pop()]
                u, v = path[-1] if path else None, shorter.get(u)

    def _longest(self, word: bytes, begin: int) -> int | None:
        """The longest label that the word has there."""
        node, found = self.tree, None
        for byte in word[begin:]:
            node = node[0].get(byte)
            if node is None:
                break
            label = node[1]
            if label is not None:
                found = label
        return found

    def _stretch(self, text: str) -> list[int]:
        """Ids of a piece of text that words do not cross the ends of."""
        words, ids = self.words, []
        for word in self.split.findall(text):
            part = words.get(word)
            if part is None:
                part = self.encode_word(word.encode())
                if len(word) <= LONGEST_KEPT:
                    words.put(word, part)
            ids += part
        if len(text) <= LONGEST_KEPT // 2 and text not in words.new:
            words.put(text, ids)
        return ids

    def _plain(self, text: str) -> Iterable[int]:
        """Ids of a text without special strings: each different stretch between gaps is looked up once."""
        stretches = self._stretches(text)
        known = self.words.new
        found = {s: known[s] if s in known else self._stretch(s) for s in set(stretches)}
        return chain.from_iterable(map(found.__getitem__, stretches))

    @staticmethod
    def _stretches(text: str) -> list[str]:
        first, *rest = _GAP.split(text) if _NO_GAP.search(text) else text.split(" ")
        return [first, *[" " + r for r in rest]]

    def _show(self, stretch: str) -> tuple[int, str, bytes]:
        shown = self.shown.get(stretch)
        if shown is None:
            # The most frequent case needs no pattern: letters are one word, with or without a space before them.
            one = stretch.isascii() and stretch.removeprefix(" ").isalpha()
            words = [stretch] if one else self.split.findall(stretch)
            if len(words) > 1:
                counts, decimals, labels = zip(*map(self._show, words), strict=True)
                shown = (sum(counts), ",".join(decimals), b"".join(labels))
            else:
                ids = self.encode_word(stretch.encode()) if stretch else []
                shown = (len(ids), ",".join(map(self.decimals.__getitem__, ids)), b"".join(map(self.labels.__getitem__, ids)))
            if len(stretch) <= LONGEST_KEPT // 2:
                self.shown.put(stretch, shown)
        return shown

    def render(self, text: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids in decimal, joined by commas, and the bytes they decode to.

        The same as from ``encode`` and ``decode``, but each different stretch is written out once and
        its parts are joined, not those of its tokens.
        """
        parts: list[tuple[int, str, bytes]] = []
        begin = 0
        for special in [*self.cut_special.finditer(text), None]:
            end = special.start() if special else len(text)
            if end > begin:
                known = self.shown.new
                parts += [known.get(s) or self._show(s) for s in self._stretches(text[begin:end])]
            if special:
                label = special.group()
                parts.append((1, str(self.special[label]), label.encode()))
                begin = special.end()
        counts, decimals, labels = zip(*parts, strict=True) if parts else ((), (), ())
        return sum(counts), ",".join(filter(None, decimals)), b"".join(labels)

    def render_all(self, texts: Sequence[str]) -> list[tuple[int, str, bytes]]:
        """``render`` of each text; stretches are numbered and their parts joined for all texts at once."""
        import numpy as np
        import pyarrow.compute as pc

        out: list = [None] * len(texts)
        places, firsts, rests = [], [], []
        for i, text in enumerate(texts):
            first, gap, rest = text.partition(" ")
            if gap and len(text) <= CHUNK and not _NO_GAP.search(text) and not self.cut_special.search(text):
                places.append(i)
                firsts.append(first)
                rests.append(rest)
            else:
                out[i] = self.render(text)
        if not places:
            return out
        pieces = pc.split_pattern(pa.array(rests, pa.string()), " ")
        coded = pieces.values.dictionary_encode()
        known = self.shown.new
        shown = [known.get(s) or self._show(s) for s in map(" ".__add__, coded.dictionary.to_pylist())]
        counts, decimals, labels = zip(*shown, strict=True)
        sums = np.add.reduceat(np.array(counts, np.int64)[coded.indices.to_numpy()], pieces.offsets.to_numpy()[:-1])

        def joined(values, kind: pa.DataType, between) -> pa.Array:
            return pc.binary_join(pa.ListArray.from_arrays(pieces.offsets, pa.array(values, kind).take(coded.indices)), between)

        ids, decoded = joined(decimals, pa.string(), ","), joined(labels, pa.binary(), b"")
        for i, first, n, of_ids, of_text in zip(places, firsts, sums.tolist(), ids, decoded, strict=True):
            count, decimal, label = self._show(first)
            out[i] = (count + n, f"{decimal},{of_ids.as_py()}", label + of_text.as_py())
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; strings of special tokens in it become those tokens."""
        out: list[int] = []
        begin = 0
        for special in self.cut_special.finditer(text):
            if special.start() > begin:
                out.extend(self._plain(text[begin : special.start()]))
            out.append(self.special[special.group()])
            begin = special.end()
        if begin < len(text):
            out.extend(self._plain(text[begin:]))
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The arc labels one after the other; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def automaton(file: str) -> Automaton:
    """The compiled automaton, once per process."""
    return Automaton(file)


def encode(docs: DataFrame, file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the token ids of each whole text as an array; a null text counts as empty.

    All rows and columns stay. A column named as ``ids`` is replaced. ``file`` must exist on
    every executor.
    """

    @F.pandas_udf("array<int>")
    def run(texts):
        return texts.map(lambda t: automaton(file).encode(t or ""), na_action=None)

    return docs.withColumn(ids, run(F.col(text)))


def decode(docs: DataFrame, file: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Set ``text`` to what the array of token ids decodes to; null ids give a null text."""

    @F.pandas_udf("string")
    def run(column):
        return column.map(lambda x: None if x is None else automaton(file).decode(x))

    return docs.withColumn(text, run(F.col(ids)))


def _chunks(column: pa.Array) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``CHUNK`` characters; null counts as empty."""
    chunk, size = [], 0
    for value in column:
        chunk.append(value.as_py() or "")
        size += len(chunk[-1])
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def round_trip(docs: DataFrame, file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_tokens, SHA-256 of its ids and of the text they decode to.

    Ids are hashed in decimal, joined by commas. A null text counts as empty, a null key
    stays null, repeated rows each give a row. Ids never leave the task, so the result is
    small however long the texts are. A worker remembers at most twice ``cache_size`` arcs and as many
    stretches, some 100 and 350 bytes each, and holds the parts of ``CHUNK`` characters or of one longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(file)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for count, ids, decoded in chain.from_iterable(map(machine.render_all, _chunks(batch.column(1)))):
                n.append(count)
                of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                of_text.append(hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["k", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    read = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = read.schema["k"].dataType.simpleString()
    found = read.mapInArrow(run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return found.withColumnRenamed("k", key)

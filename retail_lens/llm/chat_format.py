"""Format conversations for training, with a loss mask aligned by character offsets.

A conversation is rendered whole as turns ``<|im_start|>role<|im_sep|>text<|im_end|>`` and encoded once. The marks
are special tokens, so no token reaches over a mark; the span of each assistant text and the spans of the tokens are both
sorted, and binary search gives the tokens of a text. A conversation longer than a block is rendered block by block: as the
marks separate the turns, its tokens are those of the blocks one after the other.

In a text or role, the marks and other templates' control strings get a backslash after their first character, and one more if
there are some already, so that none is left and one less gives the text again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lens.llm import conversations as cv
from retail_lens.llm.common import staging

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of common templates, which a text must not bring in. Only the first character is < or [.
FOREIGN = ("<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>")


@dataclass(frozen=True)
class Template:
    """Control strings to escape, besides the marks, and the role whose texts are learnt."""

    foreign: tuple[str, ...] = FOREIGN
    learnt: str = "assistant"

    def __post_init__(self):
        for control in self.foreign:
            if not re.fullmatch(r"[<\[][^<\[\\]+", control):
                raise ValueError(f"{control!r} must begin with < or [ and have neither these nor a backslash further on")

    @cached_property
    def pattern(self) -> re.Pattern:
        rest = "|".join(sorted((re.escape(c[1:]) for c in {START, SEPARATOR, END, *self.foreign}), key=len, reverse=True))
        return re.compile(rf"([<\[])(\\*)(?={rest})")

    def escape(self, text: str) -> str:
        return self.pattern.sub(r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        return self.pattern.sub(lambda m: m[1] + m[2][1:], text)

    def render(self, roles: Sequence[str], texts: Sequence[str]) -> tuple[str, list[tuple[int, int]]]:
        """The formatted turns and where the learnt texts are in them."""
        parts, spans, at = [], [], 0
        for role, text in zip(roles, texts, strict=True):
            head, body = START + self.escape(role) + SEPARATOR, self.escape(text)
            if role == self.learnt:
                spans.append((at + len(head), at + len(head) + len(body)))
            parts += (head, body, END)
            at += len(head) + len(body) + len(END)
        return "".join(parts), spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn."""
        turns = [t.split(SEPARATOR) for t in formatted.replace(START, "").split(END)[:-1]]
        return [(self.unescape(role), self.unescape(text)) for role, text in turns]


@cache
def _tokenizer(path: str):
    """The tokenizer with the marks as special tokens; one per Python worker."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    tokenizer.add_special_tokens([AddedToken(mark, special=True, normalized=False) for mark in (START, SEPARATOR, END)])
    return tokenizer


def mask(starts: np.ndarray, ends: np.ndarray, spans: Sequence[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span. Several tokens of one character share its offsets."""
    loss = np.zeros(len(starts), bool)
    if spans:
        begin, stop = np.array(spans).T
        first, last = np.searchsorted(ends, begin, "right"), np.searchsorted(starts, stop, "left")
        for i, j in zip(first, last, strict=True):
            loss[i:j] = True
    return loss


def under(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The stretches of the text under the mask, each from its first token to its last."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], loss, [False]]).astype(np.int8)))
    return [formatted[starts[i] : ends[j - 1]] for i, j in zip(edges[::2], edges[1::2], strict=True)]


_OUT = "part int, no int, whole boolean, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_RESULT = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
_SHAPE = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _key(df: DataFrame) -> tuple[str, pa.DataType]:
    conv = df.schema["conv_id"].dataType.simpleString()
    return conv, pa.string() if conv == "string" else pa.int32() if conv == "int" else pa.int64()


def _known(rows: DataFrame) -> DataFrame:
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    return cv.in_order(rows.select("conv_id", "turn", *texts, F.lit(False).alias("gone")))


def _encoder(key: pa.DataType, tokenizer: str, template: Template, most_rows: int, most_chars: int):
    """Function from ordered rows to formatted pieces, batch by batch."""
    ints = pa.list_(pa.int32())
    schema = pa.schema([("conv_id", key), ("part", pa.int32()), ("no", pa.int32()), ("whole", pa.bool_()), ("formatted", pa.string()), ("ids", ints), ("starts", ints), ("ends", ints), ("loss", pa.list_(pa.bool_()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            part, coder = cv.partition(), _tokenizer(tokenizer)
            for b in cv.blocks(batches, most_rows, most_chars):
                formatted, spans = template.render(b.roles, b.texts)
                encoded = coder.encode(formatted, add_special_tokens=False)
                ids = np.array(encoded.ids, np.int32)
                starts, ends = np.fromiter(chain.from_iterable(encoded.offsets), np.int32, 2 * len(ids)).reshape(-1, 2).T
                yield (b.conv, part, b.no, b.whole, formatted, ids, starts, ends, mask(starts, ends, spans))

        yield from cv.in_batches(out(), schema, lambda row: len(row[4]) + 100, most_chars)

    return encode


def format_chats(rows: DataFrame, tokenizer: str, template: Template = Template(), most_rows: int = cv.BLOCK_ROWS, most_chars: int = cv.BLOCK_CHARS) -> DataFrame:
    """Formatted conversations: conv_id, part, no (order of a conversation's pieces), whole (it is the only piece),
    formatted, ids, starts and ends of the tokens in code points, and loss (per token).

    ``rows`` has conv_id, turn, role and text. Null turns come first, rows of equal turn are in the order of role and
    text; null roles and texts are empty; a null conv_id is a conversation of its own; equal rows are all turns. No rows
    give no rows. A piece ends between two turns; a turn is never cut.
    """
    conv, key = _key(rows)
    return _known(rows).mapInArrow(_encoder(key, tokenizer, template, most_rows, most_chars), f"conv_id {conv}, {_OUT}")


class Digest:
    """Digests of one conversation, read back from its formatted pieces in order."""

    def __init__(self):
        self.turns, self.turn_hash = 0, hashlib.sha256()
        self.loss, self.loss_hash, self.chars = 0, hashlib.sha256(), 0

    def add(self, piece: dict) -> None:
        self.turns += piece["n_turns"]
        self.turn_hash.update(piece["turns"])
        self.loss += piece["loss_chars"]
        self.loss_hash.update(piece["learnt"])
        self.chars += piece["formatted_chars"]

    def row(self) -> tuple:
        return self.turns, self.turn_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars


def _reader(key: pa.DataType, template: Template):
    """Function from formatted pieces to what is read back from them: the digests of whole conversations, the parts of others."""
    schema = pa.schema([("conv_id", key), ("part", pa.int32()), ("no", pa.int32()), *_RESULT, ("turns", pa.binary()), ("learnt", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in batches:
                columns = {n: batch.column(n) for n in batch.schema.names}
                for i in range(batch.num_rows):
                    text = columns["formatted"][i].as_py()
                    starts, ends = (columns[n][i].values.to_numpy() for n in ("starts", "ends"))
                    loss = columns["loss"][i].values.to_numpy(zero_copy_only=False)
                    turns = template.parse(text)
                    learnt = "".join(map(template.unescape, under(text, starts, ends, loss)))
                    piece = {"n_turns": len(turns), "turns": "".join(f"{r}\n{t}\n" for r, t in turns).encode(), "loss_chars": len(learnt), "learnt": learnt.encode(), "formatted_chars": len(text)}
                    at = tuple(columns[n][i].as_py() for n in ("conv_id", "part", "no"))
                    if columns["whole"][i].as_py():
                        digest = Digest()
                        digest.add(piece)
                        yield (*at, *digest.row(), None, None)
                    else:
                        yield (*at, piece["n_turns"], None, piece["loss_chars"], None, piece["formatted_chars"], piece["turns"], piece["learnt"])

        yield from cv.in_batches(out(), schema, lambda row: 200 + (len(row[8]) if row[8] else 0), cv.BLOCK_CHARS)

    return read


def _finished(pieces: DataFrame, run, conv: str, key: pa.DataType) -> DataFrame:
    made = pieces.mapInArrow(run, f"conv_id {conv}, part int, no int, {_SHAPE}, turns binary, learnt binary")
    made = staging(pieces.sparkSession)(made, "digests")
    names = ["conv_id", *(n for n, _ in _RESULT)]
    rest = cv.fold(made.filter("turns is not null"), Digest, f"conv_id {conv}, {_SHAPE}", pa.schema([("conv_id", key), *_RESULT]))
    return made.filter("turns is null").select(*names).unionByName(rest.select(*names))


def digests(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, read back from its formatted pieces: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Conversations of one piece are finished where they are; the pieces of the others go on to one task per conversation.
    """
    conv, key = _key(formatted)
    pieces = formatted.select("conv_id", "part", "no", "whole", "formatted", "starts", "ends", "loss")
    return _finished(pieces, _reader(key, template), conv, key)


def format_and_digest(rows: DataFrame, tokenizer: str, template: Template = Template(), most_rows: int = cv.BLOCK_ROWS, most_chars: int = cv.BLOCK_CHARS) -> DataFrame:
    """``digests`` of ``format_chats`` without storing the pieces: each batch of them is read back by the worker that wrote it.

    One Python worker a task holds the tokenizer, not two.
    """
    conv, key = _key(rows)
    encode, read = _encoder(key, tokenizer, template, most_rows, most_chars), _reader(key, template)
    return _finished(_known(rows), lambda batches: read(encode(batches)), conv, key)

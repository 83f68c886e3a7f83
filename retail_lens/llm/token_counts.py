"""Token counts of whole texts for a SentencePiece BPE model, by the whole-token shortcut.

Spaces become the mark U+2581, and no piece of the vocabulary has a mark after another
character, so no merge crosses the place before a run of marks. A text therefore falls
into pre-tokens, each a run of marks and the characters up to the next one, that are
segmented on their own. For every piece it is proved once per process, by encoding it
alone, whether it stays one token; a pre-token that is such a piece counts 1 without any
merging. Only the other distinct pre-tokens are merged, each once per batch at most.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lens.llm.common import Recent

MARK = "▁"
_RUNS = re.compile(" +[^ ]*")


class PieceCounter:
    """Counts the tokens of texts; ``cache_size`` bounds the remembered merged pre-tokens."""

    def __init__(self, model_file: str, cache_size: int = 400_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece spans two words, so texts do not fall into pre-tokens")
        if self.model.encode("a  b ", out_type=str)[-1:] != [MARK]:
            raise ValueError("the model drops spaces")
        #: Pre-token without its first mark (the model puts that one itself) for each proven piece.
        starts = [(i, p[1:].replace(MARK, " ")) for i, p in enumerate(pieces) if p.startswith(MARK)]
        alone = self.model.encode([text for _, text in starts], num_threads=1)
        self.whole = {text: 1 for (i, text), ids in zip(starts, alone, strict=True) if text and ids == [i]}
        self.whole[""] = 1  # a mark alone, before the end of the text
        self.merged = Recent(cache_size)

    @staticmethod
    def pre_tokens(text: str) -> list[str]:
        """The pre-tokens of a text, each without its first mark, the others as spaces."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        parts = text.split(" ")
        if "" in parts:  # runs of spaces, or one at an end
            parts = [run[1:] for run in _RUNS.findall(" " + text)]
        return parts

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text. New pre-tokens of all the texts are merged in one call."""
        split = [self.pre_tokens(text or "") for text in texts]
        whole, merged = self.whole, self.merged
        sizes: dict[str, int] = {}
        new = []
        for part in set().union(*split).difference(whole):
            n = merged.get(part)
            if n is None:
                new.append(part)
            else:
                sizes[part] = n
        for part, ids in zip(new, self.model.encode(new, num_threads=1), strict=True):
            sizes[part] = len(ids)
            merged.put(part, len(ids))
        sizes |= whole
        return [sum(map(sizes.__getitem__, parts)) for parts in split]

    def grouped_counts(self, texts: Iterator[str | None], most: int = 1 << 21) -> Iterator[int]:
        """The same over a stream, taking texts together up to ``most`` characters."""
        group: list[str | None] = []
        held = 0
        for text in texts:
            group.append(text)
            held += len(text or "")
            if held >= most:
                yield from self.counts(group)
                group, held = [], 0
        yield from self.counts(group)


@lru_cache(maxsize=2)
def _counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def token_counts(
    docs: DataFrame, model_file: str, limit: int = 4096, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per document: key, n_bytes, n_tokens and whether n_tokens exceeds ``limit``.

    Texts are counted whole, without begin or end tokens; a null text counts as empty
    (0 bytes, 0 tokens), a null key stays null, repeated rows each give a row, other
    columns are not read. ``model_file`` must exist on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            n = pa.array(counter.grouped_counts(x.as_py() for x in batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["k", "n_bytes", "n_tokens"])

    read = docs.select(
        F.col(key).alias("k"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("t"),
    )
    kind = read.schema["k"].dataType.simpleString()
    found = read.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long")
    return found.select(
        F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )

"""What operators over conversations share: rows in order, in blocks of bounded size, and digests over them.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation of any length lies in
consecutive partitions and no task holds more than its range. A block is part of one conversation in one
partition; ``whole`` marks one that is its entire conversation, which is known within the partition for all
but its first and last conversation. Blocks of the others are brought together by :func:`fold`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: A block is closed at so many rows or characters, whichever comes first; one row is never cut.
BLOCK_ROWS = 2048
BLOCK_CHARS = 1 << 21


@dataclass
class Block:
    conv: object
    no: int
    whole: bool = False
    turns: list = field(default_factory=list)
    roles: list = field(default_factory=list)
    texts: list = field(default_factory=list)


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone in partitions of consecutive rows. Nulls come first; equal turns go by role and text."""
    by = ["conv_id", "turn", "role", "text"]
    return rows.select(*by, "gone").repartitionByRange(*by).sortWithinPartitions(*by)


def blocks(batches: Iterator[pa.RecordBatch], most_rows: int, most_chars: int) -> Iterator[Block]:
    """Blocks of a partition of :func:`in_order`. Rows that are ``gone`` only make their conversation known."""
    block, chars, first = None, 0, True
    for batch in batches:
        for conv, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block is None or conv != block.conv:
                if block is not None:
                    block.whole = block.no == 0 and not first
                    yield block
                    first = False
                block, chars = Block(conv, 0), 0
            elif len(block.roles) >= most_rows or chars >= most_chars:
                yield block
                block, chars = Block(conv, block.no + 1), 0
            if not gone:
                block.turns.append(turn)
                block.roles.append(role)
                block.texts.append(text)
                chars += len(text)
    if block is not None:
        yield block


def partition() -> int:
    return TaskContext.get().partitionId()


def in_batches(rows: Iterator[tuple], schema: pa.Schema, weight: Callable[[tuple], int] = lambda row: 1, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, each of at most ``most`` in weight, or of one row."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += weight(row)
        if total >= most:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def fold(pieces: DataFrame, make: Callable[[], object], result: str, schema: pa.Schema) -> DataFrame:
    """One row per conversation, from its pieces in order.

    ``make()`` gives an object whose ``add(row)`` takes each piece, a dict, and whose ``row()`` gives the
    result after conv_id. A digest of a whole conversation can only be taken in order, so the pieces of one
    conversation stream through one task, which holds one batch of them at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            conv, state = None, None
            for batch in batches:
                for piece in batch.to_pylist():
                    if state is None or piece["conv_id"] != conv:
                        if state is not None:
                            yield (conv, *state.row())
                        conv, state = piece["conv_id"], make()
                    state.add(piece)
            if state is not None:
                yield (conv, *state.row())

        yield from in_batches(rows(), schema)

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no").mapInArrow(run, result)

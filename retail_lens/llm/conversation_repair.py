"""Repair the role structure of conversations by Hirschberg's divide and conquer over a four-state automaton.

States: 0 nothing yet, 1 after a system turn, 2 after a user turn (an assistant is due), 3 after an assistant
turn. A repaired conversation has the role initials ``(s?(ua)+)?``, so it ends in 0 or 3. From each state one
role alone can be inserted or given to a row, so the initials of the edits determine them.

A row's *link* lists the moves from state to state: what is inserted before the row, then what becomes of it,
with the cost and the initials. The initials of a move end in a letter other than I, so those that lead
to different states differ before either ends: their order decides between crossings of equal cost, however the
conversation goes on. A forward vector therefore holds a cost and a place in that order for each state, a
backward one a cost. Both meet in the middle, the least crossing is taken, and either half is solved alike.

The same recursion runs twice: over the blocks of a conversation that spans several (a block's link has its
least costs and their order for each pair of states), then inside each block between two known states. So no
task holds a conversation; only its blocks' links, one for 2,048 rows, pass one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lens.llm import conversations as cv
from retail_lens.llm.common import staging

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
INSERT, REROLE, DELETE, TRUNCATED_COST = 2, 2, 3, 1
#: The one role that can follow each state by insertion, the state it leads to.
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
SYMBOLS = "sua"
#: What the end of the conversation adds in each state: cost, and the roles inserted.
ENDING = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}
BLANKS = " \t\n\x0b\x0c\r"


class Link:
    """Moves from each state: a tuple of (state after, cost, order)."""

    def __init__(self, moves: Sequence[Sequence[tuple]]):
        self.moves = tuple(tuple(m) for m in moves)
        self.between = {(a, b): (cost, order) for a, m in enumerate(self.moves) for b, cost, order in m}


def _row_link(code: int) -> Link:
    symbol, fault = code % 4, code // 4
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    moves = []
    for start in range(4):
        best: dict[int, tuple] = {}
        state, cost, initials = start, 0, ""
        for _ in range(3):  # a third insertion would come back to a state that costs less without it
            options = [(state, cost + DELETE, initials + "D")]
            if fault not in (BLANK, DUPLICATE):
                options.append((NEXT[state][1], cost + REROLE + extra, initials + "R"))
                if symbol == 0 and state == 0:
                    options.append((1, cost + extra, initials + "K"))
                elif 0 < symbol < 3 and NEXT[state][1] == symbol + 1:
                    options.append((symbol + 1, cost + extra, initials + "K"))
            for to, *least in options:
                best[to] = min(best.get(to, tuple(least)), tuple(least))
            state, cost, initials = NEXT[state][1], cost + INSERT, initials + "I"
        moves.append([(to, *least) for to, least in sorted(best.items())])
    return Link(moves)


LINKS = [_row_link(code) for code in range(16)]

Vector = tuple  # per state None, or (cost, place in the order of initials)


def _ahead(vector: Vector, link: Link) -> Vector:
    best: list = [None] * 4
    for state, held in enumerate(vector):
        if held is not None:
            for to, cost, order in link.moves[state]:
                option = (held[0] + cost, held[1], order)
                if best[to] is None or option < best[to]:
                    best[to] = option
    places = {to: place for place, to in enumerate(sorted((s for s in range(4) if best[s]), key=lambda s: best[s][1:]))}
    return tuple(None if b is None else (b[0], places[s]) for s, b in enumerate(best))


def _back(vector: Vector, link: Link) -> Vector:
    """Least cost from each state before the link on; None where the end is out of reach."""
    return tuple(min((cost + vector[to] for to, cost, _ in m if vector[to] is not None), default=None) for m in link.moves)


@lru_cache(1 << 16)
def _ahead_row(vector: Vector, code: int) -> Vector:
    return _ahead(vector, LINKS[code])


@lru_cache(1 << 16)
def _back_row(vector: Vector, code: int) -> Vector:
    return _back(vector, LINKS[code])


def forward(links: Sequence, lo: int, hi: int, vector: Vector) -> Vector:
    base = 0
    for i in range(lo, hi):
        if isinstance(links[i], int):
            vector = _ahead_row(vector, links[i])
            low = min(v[0] for v in vector if v is not None)
            if low:
                base += low
                vector = tuple(v and (v[0] - low, v[1]) for v in vector)
        else:
            vector = _ahead(vector, links[i])
    return tuple(v and (v[0] + base, v[1]) for v in vector)


def backward(links: Sequence, lo: int, hi: int, vector: Vector) -> Vector:
    base = 0
    for i in range(hi - 1, lo - 1, -1):
        if isinstance(links[i], int):
            vector = _back_row(vector, links[i])
            low = min(v for v in vector if v is not None)
            if low:
                base += low
                vector = tuple(None if v is None else v - low for v in vector)
        else:
            vector = _back(vector, links[i])
    return tuple(None if v is None else v + base for v in vector)


def from_state(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


def crossings(links: Sequence, start: int, end: int) -> list[int]:
    """The state after each link on the least way from ``start`` to ``end``. Links are codes of rows or Link objects."""
    states: list[int] = []

    def solve(lo: int, hi: int, start: int, end: int) -> None:
        if hi - lo == 1:
            states.append(end)
            return
        mid = (lo + hi) // 2
        there = forward(links, lo, mid, from_state(start))
        onward = backward(links, mid, hi, tuple(0 if s == end else None for s in range(4)))
        meet = min((f[0] + b, f[1], s) for s, (f, b) in enumerate(zip(there, onward, strict=True)) if f is not None and b is not None)[2]
        solve(lo, mid, start, meet)
        solve(mid, hi, meet, end)

    if links:
        solve(0, len(links), start, end)
    return states


def ending(links: Sequence) -> tuple[int, int]:
    """The state in which the cheapest, then least, repair ends, and its cost with the insertions at the end."""
    there = forward(links, 0, len(links), from_state(0))
    cost, _, state = min((f[0] + ENDING[s][0], f[1], s) for s, f in enumerate(there) if f is not None)
    return state, cost


def block_link(codes: bytes) -> Link:
    """The link of a run of rows: from each state the least cost to each other, and the order among these."""
    ends = [forward(list(codes), 0, len(codes), from_state(s)) for s in range(4)]
    return Link([[(to, *f) for to, f in enumerate(v) if f is not None] for v in ends])


def audit_of(codes: bytes, start: int, end: int) -> str:
    states = crossings(list(codes), start, end)
    return "".join(LINKS[c].between[a, b][1] for c, a, b in zip(codes, [start, *states], states, strict=False))


def repaired(audit: str, roles: Sequence[str], texts: Sequence[str], start: int) -> tuple[list[str], list[str]]:
    """The rows after the edits of ``audit``."""
    state, at, new_roles, new_texts = start, 0, [], []
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = NEXT[state][0], ""
        if edit != "I":
            role, text = (roles[at] if edit == "K" else role), texts[at]
            at += 1
        state = 1 if edit == "K" and role[:1] == "s" else NEXT[state][1]
        new_roles.append(role)
        new_texts.append(text)
    return new_roles, new_texts


def codes_of(roles: Sequence[str], texts: Sequence[str]) -> bytes:
    """Per row its role's initial and its first fault, seen within these rows."""
    seen, codes = set(), bytearray()
    for role, text in zip(roles, texts, strict=True):
        last = text.rstrip(BLANKS)[-1:]
        fault = BLANK if not last else DUPLICATE if (role, text) in seen else TRUNCATED if last not in ".!?" else 0
        seen.add((role, text))
        symbol = SYMBOLS.find(role[:1]) if role else -1
        codes.append((symbol if symbol >= 0 else 3) + 4 * fault)
    return bytes(codes)


def faults_of(codes: bytes) -> list[int]:
    """Numbers of blank, duplicate and truncated rows, and of neighbours whose roles may not follow each other."""
    kinds = [sum(c // 4 == kind for c in codes) for kind in (BLANK, DUPLICATE, TRUNCATED)]
    return [*kinds, sum(not _may_follow(a % 4, b % 4) for a, b in zip(codes, codes[1:], strict=False))]


def _may_follow(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (2, 1), (1, 2))


def _turns(turns: Sequence) -> tuple:
    """First, last and number of different turns, without nulls; they are in order."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


# ---- in Spark ---------------------------------------------------------------------

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_REPORT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_TEXTS = [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows spoilt by the remainder of crc32(``conv_id:turn``) by 20.

    0 is gone, 1 loses its text, 2 its ``[.!?]``, 3 comes twice, 4 becomes the user's. Null is one space in the hash, as a
    role and as a text.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(fate == 4, "user").otherwise(shown("role"))
    copies = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    spoilt = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fate == 0).alias("gone"), F.explode(copies))
    return spoilt.select("conv_id", "turn", "role", "text", "gone")


def repair(rows: DataFrame, most_rows: int = cv.BLOCK_ROWS, most_chars: int = cv.BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """Repair conversations: (pieces, report).

    ``rows`` has conv_id, turn, role, text and gone (true: only names its conversation). Pieces are the repaired rows:
    conv_id, part, no (order of the pieces of a conversation), roles, texts, audit; the report has a row per
    conversation. Null turns come first, rows of equal turn are in the order of role and text; a null conv_id is a
    conversation of its own; a role that is empty or does not begin with s, u or a cannot be kept. No rows give no rows.
    """
    stage = staging(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType.simpleString()
    key = pa.string() if conv == "string" else pa.int32() if conv == "int" else pa.int64()
    first = pa.schema([("conv_id", key), ("part", pa.int32()), ("no", pa.int32()), *_TEXTS, ("codes", pa.binary()), ("first", pa.int64()), ("last", pa.int64()), ("turns", pa.int64()), *_REPORT])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            part = cv.partition()
            for b in cv.blocks(batches, most_rows, most_chars):
                codes, turns = codes_of(b.roles, b.texts), _turns(b.turns)
                if not b.whole:
                    yield (b.conv, part, b.no, b.roles, b.texts, codes, *turns, *[None] * 8)
                    continue
                end, cost = ending(list(codes))
                audit = audit_of(codes, 0, end) + ENDING[end][1]
                roles, texts = repaired(audit, b.roles, b.texts, 0)
                state = Digest()
                state.count(codes, *turns)
                state.take(audit, roles, texts)
                yield (b.conv, part, b.no, roles, texts, codes, *turns, *state.row(cost))

        yield from cv.in_batches(out(), first, lambda row: sum(map(len, row[4])) + 200, cv.BLOCK_CHARS)

    shape = f"conv_id {conv}, part int, no int, roles array<string>, texts array<string>, codes binary, first long, last long, turns long, {REPORT}"
    made = stage(cv.in_order(rows).mapInArrow(cut, shape), "blocks")
    whole = made.filter("cost is not null")
    pieces, report = _span(made.filter("cost is null"), conv, key)
    names = ["conv_id", *(c.split(" ")[0] for c in REPORT.split(", "))]
    columns = ["conv_id", "part", "no", "roles", "texts", "audit"]
    return whole.select(*columns).unionByName(pieces.select(*columns)), whole.select(*names).unionByName(report.select(*names))


def _late(made: DataFrame) -> DataFrame:
    """Rows whose role and text are in an earlier block of their conversation: conv_id, part, no, late (their places in the block)."""
    here = F.struct("part", "no").alias("here")
    same = F.sha2(F.concat(F.octet_length("row.role").cast("string"), F.lit(":"), F.col("row.role"), F.col("row.text")), 256)
    zipped = F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))
    rows = made.select("conv_id", here, F.posexplode(zipped).alias("at", "row")).select("conv_id", "here", "at", same.alias("same"))
    per_block = rows.groupBy("conv_id", "same", "here").agg(F.min("at").alias("at"))
    early = per_block.groupBy("conv_id", "same").agg(F.min("here").alias("least"), F.count("*").alias("times")).filter("times > 1")
    a, b = per_block.alias("a"), early.alias("b")
    met = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.same") == F.col("b.same")) & (F.col("here") != F.col("least")))
    return met.groupBy(F.col("a.conv_id").alias("conv_id"), F.col("here.part").alias("part"), F.col("here.no").alias("no")).agg(F.collect_list("at").alias("late"))


def _same_block(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    a, b = a.alias("a"), b.alias("b")
    on = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.no") == F.col("b.no"))
    more = [F.col(f"b.`{c}`") for c in b.columns if c not in ("conv_id", "part", "no")]
    return a.join(b, on, how).select("a.*", *more)


def _span(made: DataFrame, conv: str, key: pa.DataType) -> tuple[DataFrame, DataFrame]:
    """Pieces and report of conversations that may span several blocks."""
    narrow = made.select("conv_id", "part", "no", "codes", "first", "last", "turns")
    linked = pa.schema([("conv_id", key), ("part", pa.int32()), ("no", pa.int32()), ("codes", pa.binary()), ("first", pa.int64()), ("last", pa.int64()), ("turns", pa.int64()), ("link", pa.list_(pa.int64()))])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in batches:
                for b in batch.to_pylist():
                    codes = bytearray(b["codes"])
                    for at in b["late"] or ():
                        if codes[at] // 4 != BLANK:
                            codes[at] = codes[at] % 4 + 4 * DUPLICATE
                    moves = [x for s, m in enumerate(block_link(bytes(codes)).moves) for move in m for x in (s, *move)]
                    yield (b["conv_id"], b["part"], b["no"], bytes(codes), b["first"], b["last"], b["turns"], moves)

        yield from cv.in_batches(out(), linked)

    links = _same_block(narrow, _late(made), "left").mapInArrow(link, f"conv_id {conv}, part int, no int, codes binary, first long, last long, turns long, link array<long>")
    placed = pa.schema([("conv_id", key), ("part", pa.int32()), ("no", pa.int32()), ("codes", pa.binary()), ("first", pa.int64()), ("last", pa.int64()), ("turns", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("tail", pa.string()), ("cost", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(held):
            chain = []
            for b in held:
                moves = [[], [], [], []]
                for i in range(0, len(b["link"]), 4):
                    moves[b["link"][i]].append(tuple(b["link"][i + 1 : i + 4]))
                chain.append(Link(moves))
            end, cost = ending(chain)
            start = 0
            for n, (b, state) in enumerate(zip(held, crossings(chain, 0, end), strict=True), 1):
                tail = ENDING[end][1] if n == len(held) else ""
                yield (b["conv_id"], b["part"], b["no"], b["codes"], b["first"], b["last"], b["turns"], start, state, tail, cost)
                start = state

        def out():
            held: list[dict] = []
            for batch in batches:
                for b in batch.to_pylist():
                    if held and held[0]["conv_id"] != b["conv_id"]:
                        yield from solved(held)
                        held = []
                    held.append(b)
            if held:
                yield from solved(held)

        yield from cv.in_batches(out(), placed)

    chained = links.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    states = chained.mapInArrow(place, f"conv_id {conv}, part int, no int, codes binary, first long, last long, turns long, start int, end int, tail string, cost long")
    # The recursion inside the blocks is spread by block again, whatever their conversation.
    joined = _same_block(made.select("conv_id", "part", "no", "roles", "texts"), states, "inner")
    finished = pa.schema([("conv_id", key), ("part", pa.int32()), ("no", pa.int32()), *_TEXTS, ("codes", pa.binary()), ("first", pa.int64()), ("last", pa.int64()), ("turns", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in batches:
                for b in batch.to_pylist():
                    audit = audit_of(b["codes"], b["start"], b["end"]) + b["tail"]
                    roles, texts = repaired(audit, b["roles"], b["texts"], b["start"])
                    yield (b["conv_id"], b["part"], b["no"], roles, texts, b["codes"], b["first"], b["last"], b["turns"], b["cost"], audit)

        yield from cv.in_batches(out(), finished, lambda row: sum(map(len, row[4])) + 200, cv.BLOCK_CHARS)

    pieces = joined.mapInArrow(finish, f"conv_id {conv}, part int, no int, roles array<string>, texts array<string>, codes binary, first long, last long, turns long, cost long, audit string")
    return pieces, cv.fold(pieces, Digest, f"conv_id {conv}, {REPORT}", pa.schema([("conv_id", key), *_REPORT]))


class Digest:
    """Report of one conversation, from its blocks in order."""

    def __init__(self):
        self.hash, self.lines, self.audit = hashlib.sha256(), 0, []
        self.faults, self.symbol, self.cost = [0, 0, 0, 0], None, 0
        self.first, self.last, self.turns = None, None, 0

    def add(self, piece: dict) -> None:
        self.cost = piece["cost"]
        self.count(piece["codes"], piece["first"], piece["last"], piece["turns"])
        self.take(piece["audit"], piece["roles"], piece["texts"])

    def count(self, codes: bytes, first, last, turns: int) -> None:
        self.faults = [a + b for a, b in zip(self.faults, faults_of(codes), strict=True)]
        if codes:
            if self.symbol is not None and not _may_follow(self.symbol, codes[0] % 4):
                self.faults[3] += 1
            self.symbol = codes[-1] % 4
        if turns:
            self.turns += turns - (self.last == first)
            self.first, self.last = first if self.first is None else self.first, last

    def take(self, audit: str, roles: Sequence[str], texts: Sequence[str]) -> None:
        self.audit.append(audit)
        for role, text in zip(roles, texts, strict=True):
            self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self, cost: int | None = None) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults, self.cost if cost is None else cost, "".join(self.audit), self.hash.hexdigest())

"""Repair of conversation structure: Wagner-Fischer target alignment.

The roles of a sound conversation spell ``(s?(ua)+)?`` by their initials: there is
one target string of each even length and one of each odd length from 3. A
conversation's turns are aligned to the targets of all feasible lengths by edit
distance: keep, rerole (to user or assistant), delete, insert (an empty user or
assistant turn). All targets end alike, so cell (i, k) of one table, the least cost of
aligning the turns from i on to the last k letters, serves every length. A plain
greedy repair gives the incumbent cost C; no cheaper alignment has more than C / 2
deletions or C / 5 insertions, so only a band of diagonals is filled (Ukkonen).
Audits are traced from the table for each cheapest target and compared; the least in
ASCII order is the result.

Spark deals turns out by conversation and sorts them (spilling), marks duplicates by
a window, and each task reads its turns as a stream: of a conversation it holds a
byte a turn and its texts, which go to a scratch file of the task beyond
``HELD`` bytes. Where the band would exceed ``CELLS`` cells the table is folded: cells
of targets of like parity share their future, four numbers a turn, with the same
result.

Defined cases: a null conversation, turn, role or text is read as one space (a null
conversation is one of its own, null turns come first); equal turns go by role, then
text; repeated rows are duplicates; a conversation that lost all its rows has zeros,
an empty audit and the hash of the empty string; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rxlake.llm.store import ship_code

RETYPE, DELETE, INSERT, RAGGED = 1, 2, 5, 5
#: Bytes of a conversation's text in memory; cells of a band; audits remembered.
HELD, CELLS, REMEMBERED = 32 << 20, 1 << 24, 100_000
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
OTHER = 3
FAR = 1 << 40
#: Adjacent initials that are in order.
LEGAL = {(0, 1), (1, 2), (2, 1)}
NAMES = {"u": "user", "a": "assistant"}


# --- turns ------------------------------------------------------------------------


def filled(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls of the texts as one space."""
    space = F.lit(" ")
    return conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``filled`` turns damaged by the hash of conversation and turn; a dropped one
    stays as a marked row without role and text."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = filled(conversations).withColumn("_h", F.crc32(key.cast("binary")) % 20)
    h = F.col("_h")
    text = F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(h == 4, F.lit("user")).otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", F.when(h != 0, role).alias("role"), F.when(h != 0, text).alias("text"), (h == 0).alias("lost"), "_h")
    one = F.lit(1)
    return rows.withColumn("_i", F.explode(F.when(h == 3, F.array(one, one)).otherwise(F.array(one)))).drop("_h", "_i")


def with_faults(turns: DataFrame) -> DataFrame:
    """Turns (with ``lost``) and each one's first fault, dealt out by conversation
    and in order there."""
    dealt = turns.repartition("conv_id")
    again = Window.partitionBy("conv_id", "lost", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    dealt = dealt.withColumn("_again", F.row_number().over(again) > 1)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(F.col("lost"), FINE).when(blank, BLANK).when(F.col("_again"), DUPLICATE).when(~ended, TRUNCATED).otherwise(FINE)
    dealt = dealt.withColumn("fault", fault.cast("int")).drop("_again")
    return dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


# --- alignment --------------------------------------------------------------------


def _incumbent(initial: list[int], fault: list[int]) -> int:
    """Cost of a greedy repair: turns in place are kept, others reroled."""
    cost, made, system = 0, 0, False
    for x, f in zip(initial, fault, strict=True):
        if f in (BLANK, DUPLICATE):
            cost += DELETE
        elif x == 0 and not made and not system:
            system = True
            cost += RAGGED * (f == TRUNCATED)
        else:
            cost += RETYPE * (x != 1 + made % 2) + RAGGED * (f == TRUNCATED)
            made += 1
    cost += INSERT * (2 if system and not made else made % 2)
    return min(cost, DELETE * len(initial))


def align(codes: bytes, cells: int = CELLS) -> tuple[int, str]:
    """Least cost and audit of turns, each a byte: initial * 4 + fault."""
    n = len(codes)
    code = np.frombuffer(codes, np.uint8)
    initial, fault = code >> 2, code & 3
    c = _incumbent(initial.tolist(), fault.tolist())
    low, high = c // DELETE, c // INSERT
    if (n + 1) * (low + high + 1) > cells:
        return align_folded(codes)
    gone = (fault == BLANK) | (fault == DUPLICATE)
    kept_cost = np.where(gone, FAR, np.where(fault == TRUNCATED, RAGGED, 0)).tolist()
    width = low + high + 1
    diagonal = np.arange(width)
    steps = INSERT * diagonal
    table = np.full((n + 1, width + 1), FAR, np.int64)  # a column of no way on the right
    table[n, low : low + high + 1] = INSERT * np.arange(high + 1)
    for i in range(n - 1, -1, -1):
        k = n - i - low + diagonal
        wanted = np.where(k % 2 == 0, 1, 2)
        same = table[i + 1, :width] + np.where(initial[i] == wanted, 0, RETYPE) + kept_cost[i]
        row = np.minimum(np.where(k >= 1, same, FAR), table[i + 1, 1:] + DELETE)
        row = np.where(k >= 0, row, FAR)
        table[i, :width] = np.minimum.accumulate(row - steps) + steps

    def cost(i: int, k: int) -> int:
        d = k - (n - i) + low
        return int(table[i, d]) if 0 <= d < width and k >= 0 else FAR

    def trace(i: int, k: int) -> str:
        out = []
        while i < n or k:
            here = cost(i, k)
            if i < n and cost(i + 1, k) + DELETE == here:
                out.append("D")
                i += 1
            elif k and cost(i, k - 1) + INSERT == here:
                out.append("I")
                k -= 1
            else:
                out.append("K" if initial[i] == 1 + k % 2 else "R")
                i, k = i + 1, k - 1
        return "".join(out)

    last = n + high
    starts = [(cost(0, m), 0, m) for m in range(0, last + 1, 2)]
    # An odd target begins with a system turn that is kept; those before it go.
    for i in np.flatnonzero((initial == 0) & ~gone).tolist():
        starts += [(DELETE * i + kept_cost[i] + cost(i + 1, m), i + 1, m) for m in range(2, last + 1, 2)]
    least = min(x for x, _, _ in starts)
    audits = (("D" * (i - 1) + "K" if i else "") + trace(i, m) for x, i, m in starts if x == least)
    return least, min(audits)


def align_folded(codes: bytes) -> tuple[int, str]:
    """The same with targets of like parity folded together: of the turns from i on,
    the least cost when nothing, user first, assistant first, or a system turn first is
    still to come."""
    n = len(codes)
    none, user, assistant, system = range(4)
    table = np.full((n + 1, 4), FAR, np.int64)
    table[n, :3] = 0, 2 * INSERT, INSERT

    def turn_cost(i: int, wanted: int) -> int:
        x, f = codes[i] >> 2, codes[i] & 3
        if f in (BLANK, DUPLICATE) or (wanted == 0 and x):
            return FAR
        return RETYPE * (x != wanted) + RAGGED * (f == TRUNCATED)

    for i in range(n - 1, -1, -1):
        z, u, a, s = (int(x) for x in table[i + 1])
        here_u = min(u + DELETE, turn_cost(i, 1) + a)
        here_z = z + DELETE
        here_a = min(a + DELETE, turn_cost(i, 2) + min(z, u), INSERT + here_z, INSERT + here_u)
        table[i] = here_z, min(here_u, INSERT + here_a), here_a, min(s + DELETE, turn_cost(i, 0) + u)
    after = {user: (assistant,), assistant: (none, user), system: (user,), none: ()}
    wanted = {user: 1, assistant: 2, system: 0}
    least = int(table[0, [none, user, system]].min())
    at = {q for q in (none, user, system) if table[0, q] == least}
    out, i, left = [], 0, least
    while i < n or left:
        gone = {q for q in at if i < n and table[i + 1, q] + DELETE == left}
        if gone:
            out.append("D")
            at, i, left = gone, i + 1, left - DELETE
            continue
        put = {p for q in at if q in (user, assistant) for p in after[q] if table[i, p] + INSERT == left}
        if put:
            out.append("I")
            at, left = put, left - INSERT
            continue
        for letter in "KR":
            best = {}
            for q in at - {none}:
                same = codes[i] >> 2 == wanted[q]
                if same == (letter == "K"):
                    price = turn_cost(i, wanted[q])
                    best.update({p: price for p in after[q] if table[i + 1, p] + price == left})
            if best:
                out.append(letter)
                at, i, left = set(best), i + 1, left - next(iter(best.values()))
                break
    return least, "".join(out)


def edited(audit: str) -> Iterator[tuple[str, str | None]]:
    """Each edit, with the role that it gives its turn (none: the turn's own)."""
    length = len(audit) - audit.count("D")
    at = 0
    for x in audit:
        if x == "D":
            yield x, None
            continue
        own = x == "K"
        yield x, None if own else NAMES["ua"[(at - length % 2) % 2]]
        at += 1


# --- a task's stream --------------------------------------------------------------


class Conversation:
    """What is held of a conversation while its turns pass."""

    def __init__(self, key):
        self.key = key
        self.codes = bytearray()
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.texts = tempfile.SpooledTemporaryFile(max_size=HELD)

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        x = INITIALS.find(role[:1]) if role[:1] else OTHER
        x = OTHER if x < 0 else x
        if self.codes and (self.codes[-1] >> 2, x) not in LEGAL:
            self.illegal += 1
        self.codes.append(x * 4 + fault)
        if turn is not None:
            if self.last is None or turn != self.last:
                self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        r, t = role.encode(), text.encode()
        self.texts.write(struct.pack("<II", len(r), len(t)) + r + t)

    def repaired(self, audit: str) -> Iterator[tuple[str, bytes, bytes]]:
        """Edit, role and text of each turn of the repaired conversation."""
        self.texts.seek(0)
        for edit, name in edited(audit):
            role = text = b""
            if edit != "I":
                r, t = struct.unpack("<II", self.texts.read(8))
                role, text = self.texts.read(r), self.texts.read(t)
            if edit != "D":
                yield edit, name.encode() if name else role, text

    def gaps(self) -> int:
        return 0 if self.last is None else self.last - self.first + 1 - self.turns


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    now = None
    for batch in batches:
        for key, turn, role, text, lost, fault in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if now is None or key != now.key:
                if now is not None:
                    yield now
                now = Conversation(key)
            if not lost:
                now.add(turn, role, text, fault)
    if now is not None:
        yield now


def _aligner() -> Callable[[bytes], tuple[int, str]]:
    known: dict[bytes, tuple[int, str]] = {}

    def run(codes: bytes) -> tuple[int, str]:
        if codes not in known:
            if len(known) >= REMEMBERED or len(codes) > 64:
                known.clear()
            known[codes] = align(codes)
        return known[codes]

    return run


def _stream(turns: DataFrame) -> DataFrame:
    ship_code(turns.sparkSession)
    return with_faults(turns).select("conv_id", "turn", "role", "text", "lost", "fault")


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(turns: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, faults by kind, gaps, illegal neighbours, cost,
    audit, hash of the repaired conversation. ``turns`` as ``damaged`` gives them."""
    key = turns.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", key), *StructType.fromDDL(", ".join(f"{c} bigint" for c in NUMBERS) + ", audit string, repaired_sha256 string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve, rows, held, kind = _aligner(), [], 0, None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *[pa.array(c, pa.int64()) for c in cols[1:7]], *[pa.array(c, pa.string()) for c in cols[7:]]], ["conv_id", *NUMBERS, "audit", "repaired_sha256"])

        def seen(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in them:
                kind = b.schema.field(0).type
                yield b

        for c in _conversations(seen(batches)):
            cost, audit = solve(bytes(c.codes))
            digest = hashlib.sha256()
            for i, (_, role, text) in enumerate(c.repaired(audit)):
                digest.update((b"\n" if i else b"") + role + b":" + text)
            faults = [sum(c.codes.count(x * 4 + f) for x in range(4)) for f in (BLANK, DUPLICATE, TRUNCATED)]
            rows.append((c.key, c.gaps(), *faults, c.illegal, cost, audit, digest.hexdigest()))
            held += len(audit) + 200
            c.texts.close()
            if held > 4 << 20:
                yield flush()
                rows, held = [], 0
        if rows:
            yield flush()

    return _stream(turns).mapInArrow(run, schema)


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text, edit."""
    key = turns.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", key), *StructType.fromDDL("place bigint, role string, text string, edit string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve = _aligner()
        for c in _conversations(batches):
            _, audit = solve(bytes(c.codes))
            rows, held = [], 0
            for place, (edit, role, text) in enumerate(c.repaired(audit)):
                rows.append({"conv_id": c.key, "place": place, "role": role.decode(), "text": text.decode(), "edit": edit})
                held += len(text)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, arrow)
                    rows, held = [], 0
            c.texts.close()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return _stream(turns).mapInArrow(run, schema)

"""Conversation structure repair by Four-Russians block tables (operator 13).

A conversation's rows become symbols: initial of the role, and whether the row must go, is truncated, or is sound. The cheapest
edits into `(s?(ua)+)?` are a shortest path over (row, state of that pattern). The costs of the four states, less their
least, take few different values (states that cannot be on a cheapest path any more are struck out), so they are numbered,
and a table gives for each number and each block of BLOCK symbols the next number and the added cost. A conversation is
processed by one lookup per block. Then its blocks are expanded from the last to the first, which marks the states on
cheapest paths; a walk over the marked states takes the least letter at each step, among all states that share the letters
so far, so ties are broken over whole edit strings.

Rows are damaged, judged and numbered by DataFrame functions: one exchange by conversation, then sorted streams through Arrow
functions. A stream keeps one symbol a row, and the texts of a conversation up to HOLD_BYTES; the few conversations beyond it
get their hash from a second sorted stream, which reads the edits first and the texts once. So memory does not grow with a
conversation's texts. The hash is a chain through a conversation by its definition, so its rows pass one task, one by one.

Defined results: null conv_id is a conversation of its own; null turn sorts first and has no part in gaps; null role or text
is one space; rows of one turn are ordered by role and text, so repeated rows lie side by side and all but the first are
duplicates; very long texts and conversations are taken whole; ties between edits by ASCII; an empty table yields no rows;
other columns, whatever their names, are ignored by `repaired` and pass through `damaged`, where a column named `copy` is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hexwatch.llm.common import column, small, stored

BLOCK = 4
HOLD_BYTES = 32 << 20
INF = 1 << 20
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Initials of roles as codes; other roles are code 3. A symbol is 2 * code + truncated, or GONE for rows that must go.
SYSTEM, USER, ASSISTANT, OTHER = 0, 1, 2, 3
GONE, SYMBOLS = 8, 9
#: States: nothing yet; after the system row; after a user row; after an assistant row. Nothing and the last may end.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = 0, 1, 2, 3
TO_USER = ((START, AFTER_USER), (AFTER_SYSTEM, AFTER_USER), (AFTER_ASSISTANT, AFTER_USER))
TO_ASSISTANT = ((AFTER_USER, AFTER_ASSISTANT),)
INSERTS = (*TO_USER, *TO_ASSISTANT)
LETTERS = "DIKR"
LEGAL = ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))

Vector = tuple[int, int, int, int]
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def row_edits(symbol: int) -> list[tuple[str, int, int, int]]:
    """(letter, state before, state after, cost) of everything that can happen to a row."""
    edits = [("D", s, s, DELETE) for s in range(4)]
    if symbol != GONE:
        code, extra = symbol // 2, TRUNCATED * (symbol % 2)
        kept = {SYSTEM: ((START, AFTER_SYSTEM),), USER: TO_USER, ASSISTANT: TO_ASSISTANT, OTHER: ()}[code]
        edits += [("K", a, b, extra) for a, b in kept]
        edits += [("R", a, b, REROLE + extra) for a, b in INSERTS]
    return edits


EDITS = [row_edits(s) for s in range(SYMBOLS)]


def settled(costs: list[int]) -> Vector:
    """Costs after insertions. From the last state one can go on as from the one after the system row, and, for a deletion more,
    as from the start; so these two are struck out where they are dearer than that."""
    f = list(costs)
    for a, b in (*INSERTS, *INSERTS):
        f[b] = min(f[b], f[a] + INSERT)
    if f[START] > f[AFTER_ASSISTANT] + DELETE:
        f[START] = INF
    if f[AFTER_SYSTEM] > f[AFTER_ASSISTANT]:
        f[AFTER_SYSTEM] = INF
    return tuple(min(x, INF) for x in f)


FIRST = settled([0, INF, INF, INF])


def stepped(costs: Vector, symbol: int) -> tuple[Vector, int]:
    """Costs after a row, less their least, and that least."""
    after = [INF] * 4
    for _, a, b, cost in EDITS[symbol]:
        after[b] = min(after[b], costs[a] + cost)
    found = settled(after)
    least = min(found)
    return tuple(x - least if x < INF else INF for x in found), least


class Tables:
    """Numbers of cost vectors, and for every number and run of up to `block` symbols the next number and the added cost."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[Vector] = [FIRST]
        number, rows = {FIRST: 0}, []
        for v in self.vectors:  # grows until no new vector appears
            row = []
            for symbol in range(SYMBOLS):
                after, least = stepped(v, symbol)
                if after not in number:
                    number[after] = len(self.vectors)
                    self.vectors.append(after)
                row.append((number[after], least))
            rows.append(row)
        one = np.array(rows, np.int32)
        self.one = one.tolist()
        nexts, added = [one[:, :, 0]], [one[:, :, 1]]
        for _ in range(block - 1):  # a block longer by one symbol: look up the block, then the symbol
            to = one[nexts[-1]]
            nexts.append(to[..., 0].reshape(len(rows), -1))
            added.append((added[-1][..., None] + to[..., 1]).reshape(len(rows), -1))
        self.next, self.added = [x.tolist() for x in nexts], [x.tolist() for x in added]

    def forward(self, symbols: np.ndarray) -> tuple[list[int], int, int]:
        """The number before each block, the number after the last, and the cost taken out of the vectors."""
        n = len(symbols)
        whole = n - n % self.block
        codes = (symbols[:whole].reshape(-1, self.block).astype(np.int64) @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))).tolist()
        at, cost, before = 0, 0, []
        for code in codes:
            before.append(at)
            cost += self.added[-1][at][code]
            at = self.next[-1][at][code]
        if whole < n:
            code = 0
            for s in symbols[whole:].tolist():
                code = code * SYMBOLS + s
            before.append(at)
            k = n - whole - 1
            at, cost = self.next[k][at][code], cost + self.added[k][at][code]
        return before, at, cost

    def solve(self, symbols: np.ndarray) -> tuple[int, str]:
        """Least cost and the least of the edit strings that have it."""
        before, at, cost = self.forward(symbols)
        last = self.vectors[at]
        ends = [s for s in (START, AFTER_ASSISTANT) if last[s] < INF]
        best = min(last[s] for s in ends)
        n, rows = len(symbols), symbols.tolist()
        numbers, marks = bytearray(n + 1), bytearray(n + 1)
        final = sum(1 << s for s in ends if last[s] == best)
        numbers[n], marks[n] = at, with_inserts(last, final)
        for b in range(len(before) - 1, -1, -1):  # expand a block, then mark it backward
            start, end = b * self.block, min(n, (b + 1) * self.block)
            number = before[b]
            for i in range(start, end):
                numbers[i] = number
                number = self.one[number][rows[i]][0]
            for i in range(end - 1, start - 1, -1):
                marks[i] = marked(self.vectors[numbers[i]], rows[i], marks[i + 1])
        out, here = [], 1 << START
        for i in range(n):
            letters, here = walked(self.vectors[numbers[i]], rows[i], marks[i], marks[i + 1], here)
            out.append(letters)
        while not here & final:
            here = inserted(last, marks[n], here)
            out.append("I")
        return cost + best, "".join(out)


def inserted(costs: Vector, marks: int, here: int) -> int:
    """Marked states that an insertion on a cheapest path reaches from `here`."""
    return sum({1 << b for a, b in INSERTS if here >> a & 1 and marks >> b & 1 and costs[a] + INSERT == costs[b]})


def with_inserts(costs: Vector, marks: int) -> int:
    """The states from which insertions on a cheapest path lead to marked ones, and these."""
    for _ in range(3):
        for a, b in INSERTS:
            if marks >> b & 1 and costs[a] < INF and costs[a] + INSERT == costs[b]:
                marks |= 1 << a
    return marks


@lru_cache(None)
def tight(costs: Vector, symbol: int) -> tuple[tuple[str, int, int], ...]:
    """The row's edits that are on cheapest paths to the state after them."""
    after, least = stepped(costs, symbol)
    return tuple((letter, a, b) for letter, a, b, cost in EDITS[symbol] if costs[a] < INF and after[b] < INF and costs[a] + cost == after[b] + least)


@lru_cache(None)
def marked(costs: Vector, symbol: int, after: int) -> int:
    """The states before a row that lie on a cheapest path, from the marked states after it."""
    return with_inserts(costs, sum({1 << a for _, a, b in tight(costs, symbol) if after >> b & 1}))


@lru_cache(None)
def walked(costs: Vector, symbol: int, marks: int, after: int, here: int) -> tuple[str, int]:
    """The least letters from the states `here` over the row, and the states that have them."""
    out = ""
    while True:
        for letter in LETTERS:
            if letter == "I":
                to = inserted(costs, marks, here)
            else:
                to = sum({1 << b for x, a, b in tight(costs, symbol) if x == letter and here >> a & 1 and after >> b & 1})
            if to:
                break
        out, here = out + letter, to
        if letter != "I":
            return out, here


@lru_cache(None)
def tables(block: int = BLOCK) -> Tables:
    """One set of tables per Python worker."""
    return Tables(block)


class Rewriter:
    """Hash of the repaired rows, fed with the edits first and then the damaged rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2  # then the first row is the system's
        self.hash = hashlib.sha256()

    def put(self, role: str | None, text: str) -> None:
        turn = "user" if (self.place - self.odd) % 2 == 0 else "assistant"
        self.hash.update(f"{chr(10) * (self.place > 0)}{turn if role is None else role}:{text}".encode())
        self.place += 1

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.put(None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.put(role if edit == "K" else None, text)

    def digest(self) -> str:
        self.inserts()
        return self.hash.hexdigest()


class Conversation:
    """What a stream keeps of the conversation it is in."""

    def __init__(self, conv_id: int | None, hold: int):
        self.conv_id, self.hold = conv_id, hold
        self.codes: list[np.ndarray] = []
        self.faults: list[np.ndarray] = []
        self.lines: list[tuple[list[str], list[str]]] | None = []
        self.low = self.high = self.last = None
        self.turns = self.bytes = 0

    def add(self, batch: pa.RecordBatch) -> None:
        _, turn, role, text, code, fault = batch.columns
        self.codes.append(code.to_numpy(zero_copy_only=False))
        self.faults.append(fault.to_numpy(zero_copy_only=False))
        turns = turn.drop_null().to_numpy()
        if len(turns):
            self.turns += int((np.diff(turns) != 0).sum()) + (turns[0] != self.last)
            self.low = int(turns[0]) if self.low is None else self.low
            self.high = self.last = int(turns[-1])
        if self.lines is not None:
            self.bytes += text.nbytes + role.nbytes
            self.lines = None if self.bytes > self.hold else [*self.lines, (role.to_pylist(), text.to_pylist())] if len(batch) else self.lines

    def result(self) -> tuple:
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int64)
        faults = np.concatenate(self.faults) if self.faults else np.zeros(0, np.int64)
        pair = codes[:-1] * 4 + codes[1:]
        illegal = int((~np.isin(pair, [4 * a + b for a, b in LEGAL])).sum())
        symbols = np.where((faults == BLANK) | (faults == DUPLICATE), GONE, 2 * codes + (faults == CUT))
        cost, audit = tables().solve(symbols)
        digest = None
        if self.lines is not None:
            rewriter = Rewriter(audit)
            for roles, texts in self.lines:
                for r, t in zip(roles, texts):
                    rewriter.row(r, t)
            digest = rewriter.digest()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *(int((faults == k).sum()) for k in (BLANK, DUPLICATE, CUT)), illegal, cost, audit, digest)


def runs_of(batch: pa.RecordBatch) -> Iterator[tuple[int | None, pa.RecordBatch]]:
    """The stretches of a batch with equal first columns."""
    key = batch.column(0)
    missing = key.is_null().to_numpy(zero_copy_only=False)
    values = key.fill_null(0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((np.diff(values) != 0) | (np.diff(missing.astype(np.int8)) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
        yield None if missing[a] else int(values[a]), batch.slice(a, b - a)


def or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """All rows with role and text after damage, nulls as one space; `copy` is 1 for the second of repeated rows and null for
    dropped ones, whose role and text are null; they stay so that no conversation is lost."""
    key = F.concat(or_space(column(rows, "conv_id")), F.lit(":"), or_space(column(rows, "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = or_space(column(rows, "role")), or_space(column(rows, "text"))
    new = {
        "role": F.when(kind == 0, None).when(kind == 4, "user").otherwise(role),
        "text": F.when(kind == 0, None).when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text),
    }
    kept = [new[c].alias(c) if c in new else column(rows, c) for c in rows.columns if c.lower() != "copy"]
    copies = F.when(kind == 0, F.array(F.lit(None).cast("int"))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(*kept, F.explode(copies).alias("copy"))


#: Ascending order puts nulls first.
IN_ORDER = ("conv_id", "turn", "role", "text", "copy")


def judged(rows: DataFrame) -> DataFrame:
    """Damaged rows by conversation and in order, with `code` of the role's initial and `fault`, the row's first one."""
    own = rows.select(column(rows, "conv_id").cast("long").alias("conv_id"), column(rows, "turn").cast("long").alias("turn"), "role", "text", "copy")
    dealt = own.repartition("conv_id")
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn", "copy")) > 1
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    marks = dealt.withColumn("earlier", earlier)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("earlier"), DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), CUT).otherwise(SOUND)
    )
    return marks.select("conv_id", "turn", "role", "text", "copy", code.alias("code"), fault.alias("fault")).sortWithinPartitions(*IN_ORDER)


def audited(rows: DataFrame, hold: int = HOLD_BYTES) -> DataFrame:
    """One row per conversation of judged rows; the hash is null where the texts are more than `hold` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RESULT.split(", ")]
        types = [pa.string() if f.endswith("string") else pa.int64() for f in RESULT.split(", ")]
        held: Conversation | None = None
        for batch in batches:
            done = []
            for key, part in runs_of(batch):
                if held is None or held.conv_id != key:
                    if held is not None:
                        done.append(held.result())
                    held = Conversation(key, hold)
                present = part.filter(part.column("copy").is_valid())
                held.add(present.select(["conv_id", "turn", "role", "text", "code", "fault"]))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(held.result(), types)], names=names)

    return rows.mapInArrow(run, RESULT)


def rehashed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) for stored audits, from damaged rows: a conversation's edits lead its sorted stream of rows."""
    named = small(audits.select(F.col("conv_id").alias("own_id")))
    there = rows.where("copy is not null").join(named, F.col("conv_id").eqNullSafe(F.col("own_id")), "left_semi")
    shape = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "copy"]
    lead = audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                         F.lit(None).cast("int").alias("copy"), "audit")
    stream = there.select(*shape, F.lit(None).cast("string").alias("audit")).unionByName(lead)
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *IN_ORDER[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rewriter = None, None
        done: list[tuple[int | None, str]] = []
        for batch in batches:
            for own, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit"))):
                if audit is not None:
                    if rewriter is not None:
                        done.append((key, rewriter.digest()))
                    key, rewriter = own, Rewriter(audit)
                else:
                    rewriter.row(role, text)
        if rewriter is not None:
            done.append((key, rewriter.digest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["own_id", "own_hash"])

    return stream.mapInArrow(run, "own_id long, own_hash string")


def repaired(rows: DataFrame, hold: int = HOLD_BYTES) -> DataFrame:
    """One row per conversation of already damaged rows (see `damaged`): faults, cheapest edits, and the repaired rows' hash."""
    found = stored(audited(judged(rows), hold), "conversation-audits")
    long = found.where("repaired_sha256 is null")
    if long.isEmpty():
        return found
    hashes = small(stored(rehashed(rows, long), "conversation-hashes"))
    joined = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("own_id")) & F.col("repaired_sha256").isNull(), "left")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", "own_hash")).select(*found.columns)

import functools
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hexwatch.llm import conversations as C

SPACE = " \t\n\v\f\r"


def plain_solution(rows):
    """(cost, edits, repaired rows) by recursion over (row, what the pattern has seen); rows are (role, text, fault)."""
    n = len(rows)

    @functools.lru_cache(None)
    def best(i, seen, inserted):
        out = []
        if i == n and seen in ("", "a"):
            out.append((0, "", ()))
        moves = []
        if inserted < 2:
            moves.append(("I", i, inserted + 1, 2, [("user", ""), ("assistant", "")]))
        if i < n:
            role, text, fault = rows[i]
            moves.append(("D", i + 1, 0, 3, [None]))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                moves += [("K", i + 1, 0, extra, [(role, text)]), ("R", i + 1, 0, 2 + extra, [("user", text), ("assistant", text)])]
        for letter, j, k, cost, choices in moves:
            for row in choices:
                if row is None:
                    after = seen
                else:
                    after = row[0][:1]
                    if (seen, after) not in (("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                        continue
                c, edits, rest = best(j, after, k)
                out.append((cost + c, letter + edits, (*([row] if row else []), *rest)))
        return min(out, key=lambda x: x[:2], default=(10**9, "", ()))

    return best(0, "", 0)


def plain_repair(table):
    """Brute force of the whole operator over (conv_id, turn, role, text) rows."""
    by_conv = {}
    for conv, turn, role, text in table:
        own = by_conv.setdefault(conv, [])
        space = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faulted = set(), []
        for _, role, text in rows:
            fault = ""
            if not text.strip(SPACE):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif text.rstrip(SPACE)[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            faulted.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        count = [sum(f == k for _, _, f in faulted) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(faulted))
        cost, edits, repaired = plain_solution(tuple(faulted))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *count, illegal, cost, edits, digest)
    return out


def found(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=14), st.sampled_from([1, 2, 3, 4]))
def test_tables_against_recursion(symbols, block):
    names = ["system", "user", "assistant", "tool"]
    rows = tuple(("user", "x", "blank") if s == 8 else (names[s // 2], "x", "truncated" if s % 2 else "") for s in symbols)
    assert C.tables(block).solve(np.array(symbols, np.int64)) == plain_solution(rows)[:2]


def test_every_short_sequence():
    names = ["system", "user", "assistant", "tool"]
    for n in range(5):
        for symbols in itertools.product((0, 2, 3, 4, 5, 6, 8), repeat=n):
            rows = tuple(("user", "x", "blank") if s == 8 else (names[s // 2], "x", "truncated" if s % 2 else "") for s in symbols)
            assert C.tables().solve(np.array(symbols, np.int64)) == plain_solution(rows)[:2]


def test_tables_are_small():
    t = C.tables()
    assert len(t.vectors) < 100 and all(len(x) == 9**4 for x in t.next[3])


@pytest.mark.parametrize("hold", [C.HOLD_BYTES, 0])
def test_given_conversations(spark, sf, hold):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    expected = plain_repair([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])
    assert found(C.repaired(C.damaged(rows), hold)) == expected


def test_odd_rows(spark):
    kinds = [(i, t, r, x) for i, (t, r, x) in enumerate(itertools.product((None, 0, 7), ("user", "assistant", "system", "tool", "", None), ("a.", "b", "", " \t\n", None, ".", "x?\n", "e　")))]
    rows = [*kinds, *[(None, t, r, x) for _, t, r, x in kinds], *[(10_000 + t % 7, t, r, x) for t, (_, _, r, x) in enumerate(kinds)],
            *[(20_000, 3, "user", "same.")] * 5, *[(20_001, t, "assistant" if t % 2 else "user", "é" * 50_000 + ".") for t in range(40)], (-1, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as copy", "'y' as audit", "1 as `a.b`", "'z' as Fault")
    expected = plain_repair(rows)
    assert found(C.repaired(C.damaged(df.repartition(7)))) == expected
    assert found(C.repaired(C.damaged(df.repartition(3)), 200)) == expected


def test_dropped_conversation_and_empty(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:5".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 5, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert found(C.repaired(C.damaged(df))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert C.repaired(C.damaged(df.limit(0))).count() == 0


def test_one_long_conversation_streams(spark):
    df = spark.range(20_000).selectExpr("7L as conv_id", "id as turn", "case when id % 3 = 0 then 'user' else 'assistant' end as role", "concat('t', id % 5000, case when id % 2 = 0 then '.' else '' end) as text")
    rows = [tuple(r) for r in df.collect()]
    got = found(C.repaired(C.damaged(df), 1000))[7]
    cost, audit = got[5], got[6]
    assert len(audit) - audit.count("I") == 20_000 + sum(zlib.crc32(f"7:{i}".encode()) % 20 == 3 for i in range(20_000)) - sum(zlib.crc32(f"7:{i}".encode()) % 20 == 0 for i in range(20_000))
    assert cost > 0 and found(C.repaired(C.damaged(df)))[7] == got and len(rows) == 20_000


def test_one_exchange(spark, sf):
    df = C.judged(C.damaged(spark.read.parquet(f"{sf}/conversations.parquet")))
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1

import functools
import hashlib
import random
import re
import zlib

import pytest

from corpuslens.llm import dialogue

RULES = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NEXT = {"": ("user", "u"), "s": ("user", "u"), "a": ("user", "u"), "u": ("assistant", "a")}


def brute(rows):
    """Summary of one conversation of (turn, role, text) by trying every edit of every row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    flaws, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        flaws.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    starts = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))

    @functools.cache
    def best(i, state, inserts=0):
        """(cost, audit, repaired) to the end; never more than two inserts in a row."""
        found = []
        if inserts < 2:
            name, new = NEXT[state]
            cost, audit, kept = best(i, new, inserts + 1)
            found.append((cost + 3, "I" + audit, (f"{name}:", *kept)))
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
            return min(found) if found else (10**9, "", ())
        _, role, text = rows[i]
        cost, audit, kept = best(i + 1, state)
        found.append((cost + 4, "D" + audit, kept))
        if flaws[i] not in ("b", "d"):
            extra = 3 if flaws[i] == "t" else 0
            if (state, role[:1]) in RULES:
                cost, audit, kept = best(i + 1, RULES[state, role[:1]])
                found.append((cost + extra, "K" + audit, (f"{role}:{text}", *kept)))
            name, new = NEXT[state]
            cost, audit, kept = best(i + 1, new)
            found.append((cost + extra + 3, "R" + audit, (f"{name}:{text}", *kept)))
        return min(found)

    cost, audit, kept = best(0, "")
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return gaps, flaws.count("b"), flaws.count("d"), flaws.count("t"), illegal, cost, audit, digest


def all_brute(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: brute(own) for conv, own in groups.items()}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def conversations(count=150, seed=2):
    generator = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "uber", "", None, "s"]
    texts = ["Yes.", "No!", "Maybe", "  ", "", None, "é?\n", "A. b", ". \t", "x\x85", "W. "]
    rows = []
    for conv in [None, *range(count)]:
        for _ in range(generator.randrange(1, 14)):
            turn = generator.choice([None, *range(9)])
            rows.append((conv, turn, generator.choice(roles), generator.choice(texts)))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize("limits", [{}, {"short_rows": 0, "block_rows": 5}, {"short_rows": 6, "block_rows": 40}])
def test_matches_brute_force(spark, limits):
    rows = conversations()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(dialogue.report(table, table, **limits)) == all_brute(rows)


def test_damage(spark):
    rows = conversations(80, 7)
    table = spark.createDataFrame(rows, SCHEMA)
    harmed = damage(rows)
    got = [r for r in dialogue.damaged(table).collect() for _ in range(r["copies"])]
    key = lambda r: [(v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in r]
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(harmed, key=key)
    want = dict.fromkeys({r[0] for r in rows}, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
    assert found(dialogue.report(dialogue.damaged(table), table)) == want | all_brute(harmed)


def test_one_long_conversation(spark):
    """Alternating rows with a fault now and then; one row stands thousands of times."""
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"text {n}." if n % 97 else "cut") for n in range(3000)]
    rows += [(1, 3000, "user", "again.")] * 5000 + [(2, 0, "user", "hello.")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    short = found(dialogue.report(table, table, short_rows=100_000))
    assert found(dialogue.report(table, table, short_rows=100, block_rows=250)) == short
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = short[1]
    # the first of the copies is kept and answered by an insert in front of its equals or behind them
    assert (gaps, blank, duplicate) == (0, 0, 4999 + sum(n % 97 == 0 for n in range(3000)) - 2)
    assert audit.count("D") >= 4999 and len(audit) >= 8000
    assert short[2][6] == "KI"


def test_steps_tell_the_repaired_conversation(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "user", "there"), (1, 2, "assistant", "ok.")]
    steps, _ = dialogue.repair(spark.createDataFrame(rows, SCHEMA))
    got = sorted((r["step"], r["edit"], r["role"], r["text"]) for r in steps.collect())
    assert got == [(0, "K", "user", "hi."), (1, "D", "user", "there"), (2, "K", "assistant", "ok.")]


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dialogue.report(empty, empty).count() == 0
    odd = [(None, None, None, None), (None, None, None, None), (1, None, "user", "long " * 100_000 + "."), (1, 5, "assistant", "."), (2, 0, "tool", "a.")]
    table = spark.createDataFrame([(*r, "x", 1, b"") for r in odd], SCHEMA + ", conv string, block long, digest binary")
    assert found(dialogue.report(table, table)) == all_brute(odd)
    assert found(dialogue.report(table, table, short_bytes=1000)) == all_brute(odd)

import math
import random
import re

from corpuslens.llm import license

WORD = re.compile(license.WORD)


def brute(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(low)
    starts, base, more, best = [], set(), set(), 0.0
    for phrase, label in license.PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        starts += here
        base |= {label} if here else set()
    for line in low.split("\n"):
        own = set(WORD.findall(line))
        for label, notice in license.TEMPLATES:
            wanted = set(notice.split())
            part = len(wanted & own) / len(wanted)
            if part >= license.THRESHOLD:
                more.add(label)
                best = max(best, part)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if starts else best


def test_matches_brute_force(spark, odd_docs, no_docs):
    generator = random.Random(6)
    pool = sorted({w for _, t in license.TEMPLATES for w in t.split()}) + ["ü", "filler", "x1"]
    docs = []
    for n in range(150):
        lines = []
        for _ in range(generator.randrange(6)):
            words = generator.choice(license.TEMPLATES)[1].split() if generator.random() < 0.6 else [generator.choice(pool) for _ in range(9)]
            words = [w for w in words if generator.random() > 0.1] + [generator.choice(pool) for _ in range(generator.randrange(3))]
            if generator.random() < 0.3:
                generator.shuffle(words)
            lines.append(", ".join(w.upper() if generator.random() < 0.3 else w for w in words))
        docs.append((n, "\n".join(lines)))
    rows = license.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {n: brute(t) for n, t in docs}
    odd = license.scan(odd_docs).collect()
    want = sorted(repr((r["doc_id"], *brute(r["text"]))) for r in odd_docs.collect())
    assert sorted(repr(tuple(r)) for r in odd) == want
    assert license.scan(no_docs).count() == 0


def test_no_python_in_the_plan(odd_docs):
    plan = license.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def windowed(text):
    """Labels and best share over all windows of consecutive words."""
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    more, best = set(), 0.0
    for label, notice in license.TEMPLATES:
        wanted, size = set(notice.split()), math.ceil(len(notice.split()) / license.THRESHOLD - 1e-9)
        part = max(len(wanted & set(words[i : i + size])) for i in range(max(len(words) - size, 0) + 1)) / len(wanted)
        if part >= license.THRESHOLD:
            more.add(label)
            best = max(best, part)
    base = brute(text)
    return *base[:5], ",".join(sorted(more | set(base[4].split(",")) - {""})), 1.0 if base[1] else best


def test_wrapped_notices_and_long_lines(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0"
    prose = " filler word of no meaning at all ".join("the album was released under mit supervision with license".split())
    docs = [(1, bsd), (2, mpl), (3, prose), (4, prose + "\n" + bsd), (5, " ".join(["free"] * 500)), (6, None)]
    got = {r["doc_id"]: tuple(r[1:]) for r in license.scan_windows(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {n: windowed(t) for n, t in docs}
    assert [got[n][5] for n in (1, 2, 3, 4)] == ["bsd", "mpl-2.0", "", "bsd"]


def test_windows_match_brute_force(spark, odd_docs, no_docs):
    generator = random.Random(9)
    pool = sorted({w for _, t in license.TEMPLATES for w in t.split()}) + ["ü", "filler", "x1"]
    docs = []
    for n in range(150):
        words = []
        for _ in range(generator.randrange(6)):
            words += [generator.choice(pool) for _ in range(generator.randrange(12))]
            words += [w for w in generator.choice(license.TEMPLATES)[1].split() if generator.random() > 0.1]
        docs.append((n, "".join(w + generator.choice((" ", " ", ", ", "\n")) for w in words)))
    rows = license.scan_windows(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {n: windowed(t) for n, t in docs}
    odd = license.scan_windows(odd_docs).collect()
    assert sorted(repr(tuple(r)) for r in odd) == sorted(repr((r["doc_id"], *windowed(r["text"]))) for r in odd_docs.collect())
    assert license.scan_windows(no_docs).count() == 0
    plan = license.scan_windows(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_only_ascii_letters_are_lowered(spark):
    words = ("wor\u212a " + license.TEMPLATES[0][1], "CC BY", "cc b\u0130", "all rights reserved".replace("r", "R"), "wor\u212a")
    docs = [(n, w) for n, w in enumerate(words)] + [(9 + n, notice.replace("k", "\u212a")) for n, (_, notice) in enumerate(license.TEMPLATES)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r[0]: tuple(r[1:]) for r in license.scan(table).collect()} == {n: brute(t) for n, t in docs}
    assert {r[0]: tuple(r[1:]) for r in license.scan_windows(table).collect()} == {n: windowed(t) for n, t in docs}

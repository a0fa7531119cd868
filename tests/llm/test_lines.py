"""op13 against plain lines."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hourly_demand.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, shortest=10, documents=2):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= shortest:
                holders[key_of(line)].add(i)
    out = []
    for i, text in rows:
        whole = (text or "").split("\n")
        kept = []
        for line in whole:
            of = holders.get(key_of(line), ())
            if len(of) < documents or i == min(of, key=lambda d: (d is None, d or 0)):
                kept.append(line)
        out.append((i, text, len(whole), len(whole) - len(kept), "\n".join(kept)))
    return Counter(out)


def got(df, **options):
    return Counter(tuple(r) for r in lines.dedup(df, **options).select("doc_id", "text", "n_lines", "n_dropped", "kept").collect())


ODD = [
    (None, "a line that a null id shares\nonly the null id"), (None, "another row of no id, its own"), (None, "another row of no id, its own"),
    (1, "a line that a null id shares\n\n\n"), (2, None), (3, ""), (4, "\n"), (5, "\n\n  A LINE that a null id SHARES \t\r\nshort\nshort"),
    (6, "ÉCOLE É É É\nÉcole É É É"), (7, "École É É É"), (8, "école É É É"), (9, "123456789\n1234567890"), (10, "123456789\n1234567890\n1234567890"),
    (11, "twice in one document\ntwice in one document"), (12, "nbsp stays here \nnul\x00in a long line"), (13, "nbsp stays here\nnul\x00in a long line"),
    (14, "one id, two texts: first\nthe line of both"), (14, "one id, two texts: second\nthe line of both"), (15, "the line of both"), (16, "x" * 500_000 + "\n" + "y\n" * 2000),
    (17, "x" * 500_000), (-3, "the line of both\r"),
]


def test_lines(make):
    rng = random.Random(1)
    pool = [f"Line number {i} of a pool" for i in range(60)] + ["", "short", " pad "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in range(100, 250)]
    rows += ODD + [(300, "copies of one row\nand line two of it")] * 40 + [(400 + i, "a hot line of many documents\nown line " + str(i) * 9) for i in range(200)]
    df = make(rows, extra="kept").withColumn("n_lines", F.lit("old")).withColumn("_line", F.lit(0))
    out = lines.dedup(df)
    assert got(df) == brute(rows)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_line", "n_lines", "n_dropped", "kept"]


@pytest.mark.parametrize("shortest, documents", [(0, 2), (1, 3), (10, 5), (25, 1)])
def test_thresholds(make, shortest, documents):
    rows = ODD + [(500 + i, f"line of group {i % 7}, longer\ntiny\nline of all documents here") for i in range(30)]
    assert got(make(rows), shortest=shortest, documents=documents) == brute(rows, shortest, documents)


def test_no_rows(make):
    assert lines.dedup(make([])).count() == 0


def test_only_functions_of_the_engine(make):
    plan = lines.dedup(make(ODD))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))

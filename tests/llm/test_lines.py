"""Repeated lines against plain Python."""

import random
from collections import Counter, defaultdict

import pytest

from vectable.llm import lines


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def brute(rows, least_chars=10, least_documents=2):
    """rows: (id, text); an id of None comes after all others."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= least_chars:
                holders[key_of(line)].add(i)
    first = {k: min(h, key=lambda i: (i is None, i)) for k, h in holders.items() if len(h) >= least_documents}
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [line for line in all_lines if key_of(line) not in first or first[key_of(line)] == i]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return Counter(out)


def lined(seed, n=80):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("alpha beta gamma delta Straße ÄÖÜ kilo".split()) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rows = []
    for i in range(n):
        text = "\n".join(rng.choice([" {}", "{}\t", "{}\r", "{}", "\x0b{}\f"]).format(rng.choice([str.upper, str.lower, str])(rng.choice(pool))) for _ in range(rng.randint(0, 12)))
        rows.append((rng.choice([i, i, i, None]), text))
    frequent = "this line stands in every other document"
    rows += [(1000 + i, frequent + "\n" + rows[i][1] + "\n" + frequent.upper()) for i in range(0, n, 2)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (5, "another text\n" + frequent), (None, frequent), (2000, None), (2001, ""), (2002, "\n\n\n"), (2003, "\n".join([frequent] * 3000)), (2004, "  no blank of ours 12345  ")]
    return rows


def found(df, **options):
    return Counter(map(tuple, lines.drop_repeated_lines(df, **options).select("doc_id", "text", "n_lines", "n_dropped").collect()))


@pytest.mark.parametrize("options", [{}, {"least_chars": 0}, {"least_chars": 20, "least_documents": 4}])
def test_matches_brute_force(spark, options):
    rows = lined(len(options))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert found(df, **options) == brute(rows, **options)


def test_many_hashes_are_frequent_or_not(spark):
    """With few different hashes all of them are over the bound of frequent ones; with many none is."""
    rows = [(i, "the same line everywhere\n" + f"only here {i:06d}") for i in range(30)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)
    rows = [(i, "\n".join(f"shared by two of them {(i + k) // 2:06d} {k:03d}" for k in range(20))) for i in range(60)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def test_odd_tables(spark, corpus, clashing, no_rows):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    assert found(corpus) == found(clashing) == brute(rows)
    empty = lines.drop_repeated_lines(no_rows)
    assert empty.columns == ["doc_id", "text", "n_lines", "n_dropped"] and empty.count() == 0
    named = spark.createDataFrame([("b", "a line of some length"), ("a", "A line of some length ")], "h string, key string")
    assert set(map(tuple, lines.drop_repeated_lines(named, "h", "key").collect())) == {("a", "A line of some length ", 1, 0), ("b", "", 1, 1)}
    with pytest.raises(ValueError):
        lines.drop_repeated_lines(corpus, least_documents=1)


def test_no_python_in_the_plan(spark, corpus):
    plan = lines.drop_repeated_lines(corpus)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))

"""The Merkle tree against a plain recursion over the sorted rows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vectable.llm import manifest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def reduced(nodes):
    """The top of a list of nodes, and for each of them what stands left and right on its way up."""
    ways = [[] for _ in nodes]
    level, members = list(nodes), [[k] for k in range(len(nodes))]
    while len(level) > 1:
        up, inside = [], []
        for k in range(0, len(level), 2):
            pair = level[k : k + 2]
            for m in members[k]:
                ways[m].append(("", "".join(pair[1:])))
            if len(pair) == 2:
                for m in members[k + 1]:
                    ways[m].append((pair[0], ""))
            up.append(sha("".join(pair)))
            inside.append(sum(members[k : k + 2], []))
        level, members = up, inside
    return level[0], ways


def brute(rows, tampered):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, inner = [], {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        top, inner[g] = reduced([leaf_of(r) for r in groups[g]])
        subroots.append(top)
    root, outer = reduced(subroots)
    out = Counter()
    for g, subroot, above in zip(order, subroots, outer):
        for r, way in zip(groups[g], inner[g]):
            way = way + above
            node = leaf_of(tampered(r))
            for left, right in way:
                node = sha(left + node + right)
            out[(r[0], leaf_of(r), subroot, root, sha("".join(a + b for a, b in way)), node, node == root)] += 1
    return out


def table_rows(seed, n, langs):
    rng = random.Random(seed)
    rows = [(rng.randint(0, n) if rng.random() < 0.9 else None, rng.choice([None, "a", "wiki:ü"]), rng.choice(langs), rng.choice([None, 0, 12]), rng.choice([None, "", "text", "größe 漢字", "x" * 500])) for _ in range(n)]
    return rows + rows[: n // 3] + [rows[0]] * (n // 4)


def altered(row):
    return (*row[:3], row[3] if row[3] is None or row[0] is None or row[0] % 3 else row[3] + 1, row[4])


def seen():
    return {"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


KIND = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("span", [1, 3, 10])
@pytest.mark.parametrize("n, langs", [(1, ["en"]), (2, ["en"]), (33, [None, "", "de", "en", "Zz", "é"]), (130, ["en", "fr", None])])
def test_matches_brute_force(spark, span, n, langs):
    rows = table_rows(n + span, n, langs)
    df = spark.createDataFrame(rows, KIND).repartition(5)
    got = manifest.manifest(df, COLUMNS, seen=seen(), span=span)
    assert Counter(map(tuple, got.collect())) == brute(rows, altered)


def test_many_groups(spark):
    """More groups than one superblock of the upper tree holds."""
    rows = [(k, None, f"g{k % 41:02d}", k, "t") for k in range(120)]
    got = manifest.manifest(spark.createDataFrame(rows, KIND), COLUMNS, span=2)
    assert Counter(map(tuple, got.collect())) == brute(rows, lambda r: r)


def test_proofs_lead_to_the_root(spark):
    df = spark.createDataFrame(table_rows(4, 90, ["en", "de", None]), KIND)
    for r in manifest.manifest(df, COLUMNS, span=3, proofs=True).collect():
        assert manifest.folded(r.leaf, r.proof) == r.root == r.folded_root and r.verified
        assert sha("".join(s[1:] for s in r.proof)) == r.proof_sha256


def test_odd_tables(spark, corpus, clashing, no_rows):
    rows = [tuple(r) for r in corpus.select(*COLUMNS).collect()]
    for df in (corpus, clashing):
        assert Counter(map(tuple, manifest.manifest(df, COLUMNS).collect())) == brute(rows, lambda r: r)
    assert manifest.manifest(no_rows, COLUMNS).count() == 0
    with pytest.raises(ValueError):
        manifest.manifest(corpus, COLUMNS, span=0)


def test_large_ids_keep_their_digits(spark):
    rows = [(2**62 + 1, "a", "en", 1, "x"), (None, "a", "en", 1, "x"), (2**62 + 3, "a", "en", 1, "x")]
    got = manifest.manifest(spark.createDataFrame(rows, KIND), COLUMNS)
    assert got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert Counter(map(tuple, got.collect())) == brute(rows, lambda r: r)

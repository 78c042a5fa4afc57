import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from llm_texts import prose  # noqa: E402


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with copies, near copies, shared passages, repeats inside a text, repeated rows, NULLs and odd columns."""
    rng = random.Random(3)
    rows = []
    passage = prose(rng, 60)
    for i in range(40):
        rows.append((i, prose(rng, rng.randint(1, 120)), "en", "a", 0))
    for i in range(40, 46):
        rows.append((i, prose(rng, 50) + "\n" + passage + "\n" + prose(rng, 30), "en", "a", 0))
    near = prose(rng, 300).split()
    for i in range(46, 60):
        w = list(near)
        w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w), "en", "a", 0))
    rows += [(i, rows[3][1], "en", "a", 0) for i in range(60, 75)]
    loop = prose(rng, 12)
    rows += [(75, " ".join([loop] * 6), "en", "a", 0), (76, "same " * 80, "en", "a", 0)]
    rows += [(77, "", "en", "a", 0), (78, None, None, None, None), (79, "   \n\t ", "en", "a", 0), (80, "one", "en", "a", 0), (81, "!!! 123 ---", "en", "a", 0)]
    rows += [(None, prose(rng, 60), "en", None, 0), (None, rows[3][1], "en", None, 0), (82, rows[5][1], "en", "a", 0), (82, rows[5][1], "en", "a", 0), (82, rows[5][1], "en", "a", 0)]
    rows += [(83, prose(rng, 30_000), "en", "a", 0), (84, "Ünïcödé Straße   İ K 漢字 " * 20, "de", "b", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)


@pytest.fixture(scope="session")
def clashing(corpus):
    """The same rows with further columns under names that jobs like to use."""
    from pyspark.sql import functions as F

    names = ["id", "fp", "score", "node", "root", "component_id", "count", "part", "shard", "k1", "row", "n", "features", "spans", "bin_id", "kind", "_id", "prediction", "u", "v"]
    return corpus.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])


@pytest.fixture(scope="session")
def no_rows(corpus):
    return corpus.limit(0)

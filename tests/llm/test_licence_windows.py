"""Licence notices inside longer lines."""

import random

from llm_texts import prose

from vectable.llm import licences


def test_notices_inside_lines(spark):
    rng = random.Random(4)
    every = [(licence, x) for licence, v in licences.TEMPLATES.items() for x in v]
    texts = ["// Licensed under the MIT License. See LICENSE in root."] + [f"{prose(rng, 60)} {x} {prose(rng, 60)}" for _, x in every]
    want = ["MIT"] + [licence for licence, _ in every]
    texts += [prose(rng, 9) + "\nsee: " + every[0][1] + " " + prose(rng, 30) + " " + every[7][1] + " " + prose(rng, 9), prose(rng, 200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {}
    for r in licences.find(df, inside_lines=True).collect():
        got.setdefault(r.doc_id, {})[r.licence] = (r.dice, r.first_line, r.n_lines)
    for k, licence in enumerate(want):
        assert got[k][licence] == (1.0, 0, 1), texts[k]
    assert {x: v[1:] for x, v in got[len(want)].items()} == {every[0][0]: (1, 1), every[7][0]: (1, 1)}
    assert len(want) + 1 not in got

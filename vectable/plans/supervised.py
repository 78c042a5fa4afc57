"""Trees, support vector machine, networks and autoencoder."""

from __future__ import annotations

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectable.functions import exprs
from vectable.operators import layout, neighbors as nb, neural as nn, scaling, split as sp, svm, training as tn, trees as tr
from vectable.plans.common import LINEITEM_KEY, Catalog, embeddings, lineitem, rnd, rnd_sql, table

catalog = Catalog()
KEY = ", ".join(LINEITEM_KEY)
DIM = 64


def _weights(seed: int, *shape: int) -> np.ndarray:
    """Fixed model weights with few decimals, so that both engines read the same numbers."""
    return np.round(np.random.default_rng(seed).uniform(-1, 1, shape), 3)


def _list(values: np.ndarray) -> str:
    return "[" + ", ".join(f"{float(v)!r}::DOUBLE" for v in values) + "]"


def _affine_sql(w: np.ndarray, b: np.ndarray, x: str) -> list[str]:
    return [f"list_inner_product({x}, {_list(row)}) + {float(c)!r}" for row, c in zip(w, b)]


E_SQL = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"

# --- labels and margins -----------------------------------------------------------


@catalog.query(
    "WITH m AS (SELECT p_brand, (row_number() OVER (ORDER BY p_brand) - 1)::INT AS class FROM (SELECT DISTINCT p_brand FROM part)) "
    "SELECT p_partkey, p_brand, class, p_brand AS back FROM part JOIN m USING (p_brand)"
)
def svm_label_map(spark: SparkSession, sf: str) -> DataFrame:
    """Arbitrary labels to 0 .. k-1 and back."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    mapping = svm.label_map(part, "p_brand")
    coded = svm.normalise_labels(part, mapping, "p_brand")
    return svm.revert_labels(coded, mapping, output_col="back").select("p_partkey", "p_brand", "class", "back")


W4, B4 = _weights(1, 4, DIM), _weights(2, 4)
_S = _affine_sql(W4, B4, "v")
SCORES = f"WITH {E_SQL}, s AS (SELECT vec_id, " + ", ".join(f"{x} AS s{i}" for i, x in enumerate(_S)) + " FROM e) "
FIRST_MAX = "(list_position([s0, s1, s2, s3], greatest(s0, s1, s2, s3)) - 1)::INT"


@catalog.query(SCORES + "SELECT vec_id, " + ", ".join(f"{rnd_sql(f's{i}')} AS s{i}" for i in range(4)) + f", {FIRST_MAX} AS prediction FROM s")
def svm_scores_given_w(spark: SparkSession, sf: str) -> DataFrame:
    s = svm.svm_scores(embeddings(spark, sf), svm.LinearSvm(W4, B4))
    return s.select("vec_id", *[rnd(F.get("scores", F.lit(i))).alias(f"s{i}") for i in range(4)], "prediction")


@catalog.query(f"SELECT {KEY}, (list_position([l_quantity / 50.0, l_discount * 10.0, l_tax * 12.5], greatest(l_quantity / 50.0, l_discount * 10.0, l_tax * 12.5)) - 1)::INT AS label FROM lineitem")
def argmax_label(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(*LINEITEM_KEY, exprs.argmax(F.array(F.col("l_quantity") / 50.0, F.col("l_discount") * 10.0, F.col("l_tax") * 12.5)).alias("label"))


def _blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as three classes by price band, two features: learnable, and as large as the table."""
    li = table(spark, sf, "lineitem")
    band = F.when(F.col("l_extendedprice") < 35000, 0).when(F.col("l_extendedprice") < 70000, 1).otherwise(2)
    return li.select(F.array(F.col("l_extendedprice") / 50000.0 - 1.0, F.col("l_quantity") / 25.0 - 1.0).alias("features"), band.alias("label"))


def _above(df: DataFrame, floor: float, label_col: str = "label") -> DataFrame:
    scored = tr.accuracy(df, label_col)
    return scored.select("n", (F.col("accuracy") > floor).alias("accurate"))


ACCURATE = "SELECT count(*) AS n, true AS accurate FROM lineitem"


@catalog.query(ACCURATE)
def svm_fit_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = _blobs(spark, sf)
    return _above(svm.svm_scores(df, svm.fit_svm(df, "label", max_iterations=25)), 0.75)


@catalog.query(ACCURATE)
def svm_psgd_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = _blobs(spark, sf)
    return _above(svm.svm_scores(df, svm.fit_svm(df, "label", optimizer="psgd", epochs=4, step_size=0.05, tolerance=1e-4)), 0.7)


DESCENT_RATE, DESCENT_LAM, DESCENT_START = 0.05, 1e-4, np.round(np.random.default_rng(11).uniform(-0.4, 0.4, 9), 3)
RULES = ("sgd", "rmsprop", "adam")


def _gradient_sql(source: str, batch: int) -> str:
    """Mean hinge gradient of the rows of a batch at the parameters t0 .. t8 of each rule of `source`, plus the penalty's."""
    score = ", ".join(f"t{3 * c} * a + t{3 * c + 1} * b + t{3 * c + 2} AS s{c}" for c in range(3))
    hit = ", ".join(f"(y <> {c} AND s{c} - [s0, s1, s2][y + 1] + 1.0 > 0)::INT AS h{c}" for c in range(3))
    ways = ", ".join(f"CASE WHEN y = {c} THEN -(h0 + h1 + h2) ELSE h{c} END AS w{c}" for c in range(3))
    parts = ", ".join(f"avg(w{c} * {z}) + {DESCENT_LAM!r} * any_value(t{3 * c + i}) AS g{3 * c + i}" for c in range(3) for i, z in enumerate(("a", "b", "1.0")))
    return f"SELECT rule, {parts} FROM (SELECT *, {ways} FROM (SELECT *, {hit} FROM (SELECT *, {score} FROM x JOIN {source} ON x.batch = {batch}))) GROUP BY rule"


def _step_sql(source: str, step: int) -> str:
    """The parameters and moments after a step of each rule."""
    columns = []
    for i in range(9):
        g = f"g{i}"
        m, v = f"(0.9 * m{i} + 0.1 * {g})", f"CASE rule WHEN 'adam' THEN 0.999 * v{i} + 0.001 * {g} * {g} ELSE 0.99 * v{i} + 0.01 * {g} * {g} END"
        moved = (
            f"CASE rule WHEN 'sgd' THEN {g} WHEN 'rmsprop' THEN {g} / (sqrt({v}) + 1e-8) "
            f"ELSE {m} / {1 - 0.9**step!r} / (sqrt(({v}) / {1 - 0.999**step!r}) + 1e-8) END"
        )
        columns += [f"t{i} - {DESCENT_RATE!r} * ({moved}) AS t{i}", f"{m} AS m{i}", f"{v} AS v{i}"]
    return f"SELECT rule, {', '.join(columns)} FROM {source} JOIN g{step} USING (rule)"


@catalog.query(
    "WITH x AS (SELECT (l_orderkey % 2)::INT AS batch, l_extendedprice / 50000.0 - 1.0 AS a, l_quantity / 25.0 - 1.0 AS b, "
    "(CASE WHEN l_extendedprice < 35000 THEN 0 WHEN l_extendedprice < 70000 THEN 1 ELSE 2 END)::INT AS y FROM lineitem), "
    f"p0 AS (SELECT unnest({list(RULES)!r}) AS rule, " + ", ".join(f"{float(v)!r}::DOUBLE AS t{i}, 0.0::DOUBLE AS m{i}, 0.0::DOUBLE AS v{i}" for i, v in enumerate(DESCENT_START)) + "), "
    f"g1 AS ({_gradient_sql('p0', 0)}), p1 AS ({_step_sql('p0', 1)}), g2 AS ({_gradient_sql('p1', 1)}), p2 AS ({_step_sql('p1', 2)}) "
    f"SELECT rule, unnest(range(9))::INT AS i, {rnd_sql('unnest([' + ', '.join(f't{i}' for i in range(9)) + '])', 8)} AS value FROM p2"
)
def descent_two_steps(spark: SparkSession, sf: str) -> DataFrame:
    """A support vector machine after two global batches from given parameters, by each update rule."""
    li = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 2).cast("int").alias("batch"), "l_extendedprice", "l_quantity")
    band = F.when(F.col("l_extendedprice") < 35000, 0).when(F.col("l_extendedprice") < 70000, 1).otherwise(2)
    df = li.select("batch", F.array(F.col("l_extendedprice") / 50000.0 - 1.0, F.col("l_quantity") / 25.0 - 1.0).alias("features"), band.alias("class"))
    rows = []
    for rule in RULES:
        theta, _, _ = tn.global_passes(
            df, ["features", "class"], DESCENT_START, svm.row_loss(3, 2, 1.0, True), lambda t: (0.5 * DESCENT_LAM * float(t @ t), DESCENT_LAM * t),
            optimizer=rule, step_size=DESCENT_RATE, batches=2, epochs=1, tolerance=0.0, batch_of=F.col("batch"),
        )
        rows += [(rule, i, float(v)) for i, v in enumerate(theta)]
    return spark.createDataFrame(rows, "rule string, i int, value double").withColumn("value", rnd("value", 8))


# --- trees --------------------------------------------------------------------------


@catalog.query(ACCURATE)
def tree_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = _blobs(spark, sf)
    return _above(tr.tree_predict(df, tr.fit_tree(df, maximum_depth=5)), 0.9)


def _flags(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return li.select(F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("features"), label.alias("label"))


FLAGS = (
    "f AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y, unnest([0, 1, 2, 3])::INT AS feature_idx, "
    "unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value, l_quantity FROM lineitem)"
)


def _gini(a: str, b: str, c: str) -> str:
    n = f"({a} + {b} + {c})"
    return f"(1.0 - ({a} * {a} + {b} * {b} + {c} * {c}) / ({n} * {n}))"


@catalog.query(
    f"WITH {FLAGS}, g AS (SELECT feature_idx, value, " + ", ".join(f"sum((y = {c})::INT)::DOUBLE AS c{c}" for c in range(3)) + " FROM f GROUP BY 1, 2), "
    "r AS (SELECT feature_idx, value, " + ", ".join(f"sum(c{c}) OVER w AS l{c}, sum(c{c}) OVER (PARTITION BY feature_idx) AS t{c}" for c in range(3))
    + " FROM g WINDOW w AS (PARTITION BY feature_idx ORDER BY value)) SELECT feature_idx, value, (l0 + l1 + l2)::BIGINT AS n_left, "
    + rnd_sql(
        f"{_gini('t0', 't1', 't2')} - (l0 + l1 + l2) / (t0 + t1 + t2) * {_gini('l0', 'l1', 'l2')} "
        f"- (t0 + t1 + t2 - l0 - l1 - l2) / (t0 + t1 + t2) * {_gini('(t0 - l0)', '(t1 - l1)', '(t2 - l2)')}", 9)
    + " AS gain FROM r WHERE l0 + l1 + l2 < t0 + t1 + t2"
)
def hoeffding_split_gain(spark: SparkSession, sf: str) -> DataFrame:
    """Gain of every candidate binary split of every feature."""
    return tr.split_gains(_flags(spark, sf), 3).withColumn("gain", rnd("gain", 9))


def _best_sql(src: str) -> str:
    """Best split of the rows (rid, y, feature_idx, value) of a CTE, as one row."""
    counts = ", ".join(f"sum((y = {c})::INT)::DOUBLE AS c{c}" for c in range(3))
    runs = ", ".join(f"sum(c{c}) OVER w AS l{c}, sum(c{c}) OVER (PARTITION BY feature_idx) AS t{c}" for c in range(3))
    gain = (
        f"{_gini('t0', 't1', 't2')} - (l0 + l1 + l2) / (t0 + t1 + t2) * {_gini('l0', 'l1', 'l2')} "
        f"- (t0 + t1 + t2 - l0 - l1 - l2) / (t0 + t1 + t2) * {_gini('(t0 - l0)', '(t1 - l1)', '(t2 - l2)')}"
    )
    return (
        f"(SELECT feature_idx AS feature, value, (t0 + t1 + t2)::BIGINT AS n, {rnd_sql(gain, 9)} AS gain FROM (SELECT feature_idx, value, {runs} FROM "
        f"(SELECT feature_idx, value, {counts} FROM {src} GROUP BY feature_idx, value) WINDOW w AS (PARTITION BY feature_idx ORDER BY value)) "
        "WHERE l0 + l1 + l2 >= 20 AND t0 + t1 + t2 - l0 - l1 - l2 >= 20 ORDER BY gain DESC, feature, value LIMIT 1)"
    )


@catalog.query(
    "WITH f AS MATERIALIZED (SELECT rid, y, unnest([0, 1, 2, 3])::INT AS feature_idx, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM "
    "(SELECT row_number() OVER () AS rid, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y, * FROM lineitem)), "
    f"root AS {_best_sql('f')}, side AS (SELECT rid, f.value <= root.value AS low FROM f JOIN root ON f.feature_idx = root.feature), "
    "a AS (SELECT f.* FROM f JOIN side USING (rid) WHERE low), b AS (SELECT f.* FROM f JOIN side USING (rid) WHERE NOT low) "
    f"SELECT 0 AS node, * FROM root UNION ALL SELECT 1, * FROM {_best_sql('a')} UNION ALL SELECT 2, * FROM {_best_sql('b')}"
)
def tree_top_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The first two levels of a tree that tries all values."""
    _, made = tr.train_exact(_flags(spark, sf), 3, 4, minimum_leaf_size=20, minimum_gain_split=-1.0, maximum_depth=2)
    rows = [(s.node, s.feature, float(s.value), s.n, s.gain) for s in made]
    return spark.createDataFrame(rows, "node int, feature int, value double, n bigint, gain double").withColumn("gain", rnd("gain", 9))


@catalog.query(ACCURATE)
def tree_exact_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Bands of one feature: two exact splits tell them apart without an error."""
    df = _blobs(spark, sf)
    tree, _ = tr.train_exact(df, 3, 2)
    return _above(tr.hoeffding_predict(df, tree), 0.9999)


def _given_tree() -> tr.HoeffdingTree:
    """Quantity below 26 or not, bins over fixed ranges."""
    zero = (0.0, 0.0, 0.0)
    nodes = (tr.Node(zero, 0, (26.0,), (1, 2)), tr.Node(zero), tr.Node(zero))
    lo, hi = np.array([0.0, 0.0, 0.0, 0.0]), np.array([64.0, 131072.0, 0.125, 0.125])
    return tr.HoeffdingTree(tr.HoeffdingParams(bins=8), 3, 4, nodes, {1: lo, 2: lo}, {1: hi, 2: hi})


@catalog.query(
    f"WITH {FLAGS} SELECT (CASE WHEN l_quantity >= 26 THEN 2 ELSE 1 END)::INT AS leaf, feature_idx, "
    "least(greatest(floor(value / [64.0, 131072.0, 0.125, 0.125][feature_idx + 1] * 8), 0), 7)::INT AS bin, y::INT AS class, count(*) AS n FROM f GROUP BY ALL"
)
def hoeffding_leaf_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = tr.leaf_counts(_flags(spark, sf), _given_tree())
    rows = [(leaf, f, b, c, int(t[f, b, c])) for leaf, t in counts.items() for f, b, c in zip(*np.nonzero(t))]
    rows = [(leaf, int(f), int(b), int(c), n) for leaf, f, b, c, n in rows]
    return spark.createDataFrame(rows, "leaf int, feature_idx int, bin int, class int, n bigint")


@catalog.query(ACCURATE)
def hoeffding_batch_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = _blobs(spark, sf)
    tree = tr.train_batch(df, tr.new_hoeffding(3, 2, tr.HoeffdingParams(bins=16)))
    return _above(tr.hoeffding_predict(df, tree), 0.85)


@catalog.query(ACCURATE)
def hoeffding_binary_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = _blobs(spark, sf)
    params = tr.HoeffdingParams(numeric_split="binary", info_gain=True)
    return _above(tr.hoeffding_predict(df, tr.train_batch(df, tr.new_hoeffding(3, 2, params))), 0.95)


def _bits(a: str, b: str, c: str) -> str:
    n = f"({a} + {b} + {c})"
    return "(" + " + ".join(f"CASE WHEN {x} > 0 THEN -({x} / {n}) * log2({x} / {n}) ELSE 0 END" for x in (a, b, c)) + ")"


@catalog.query(
    f"WITH {FLAGS}, q AS (SELECT (CASE WHEN l_quantity >= 26 THEN 2 ELSE 1 END)::INT AS leaf, feature_idx, value, y FROM f), "
    "g AS (SELECT leaf, feature_idx, value, " + ", ".join(f"sum((y = {c})::INT)::DOUBLE AS c{c}" for c in range(3)) + " FROM q GROUP BY ALL), "
    "r AS (SELECT leaf, feature_idx, value, " + ", ".join(f"sum(c{c}) OVER w AS l{c}, sum(c{c}) OVER (PARTITION BY leaf, feature_idx) AS t{c}" for c in range(3))
    + " FROM g WINDOW w AS (PARTITION BY leaf, feature_idx ORDER BY value)), s AS (SELECT leaf, feature_idx, value, (l0 + l1 + l2)::BIGINT AS n_left, "
    + rnd_sql(
        f"{_bits('t0', 't1', 't2')} - (l0 + l1 + l2) / (t0 + t1 + t2) * {_bits('l0', 'l1', 'l2')} "
        f"- (t0 + t1 + t2 - l0 - l1 - l2) / (t0 + t1 + t2) * {_bits('(t0 - l0)', '(t1 - l1)', '(t2 - l2)')}", 9)
    + " AS gain FROM r WHERE l0 + l1 + l2 < t0 + t1 + t2) SELECT leaf, feature_idx, value, n_left, gain FROM s "
    "QUALIFY row_number() OVER (PARTITION BY leaf, feature_idx ORDER BY gain DESC, value) = 1"
)
def hoeffding_binary_split(spark: SparkSession, sf: str) -> DataFrame:
    """The best exact split of every feature of two leaves, from value counts that three batches have added up."""
    given = _given_tree()
    tree = tr.HoeffdingTree(tr.HoeffdingParams(numeric_split="binary", info_gain=True), 3, 4, given.nodes)
    rows = _flags(spark, sf).withColumn("part", F.pmod(F.xxhash64("features"), F.lit(3)))
    for part in range(3):
        tree = tr.observe(rows.filter(F.col("part") == part), tree)
    found = tr.value_splits(tree, tr.leaf_sizes(tree))
    n_left = F.aggregate("left", F.lit(0.0), lambda s, v: s + v).cast("bigint")
    return found.select("leaf", "feature_idx", "value", n_left.alias("n_left"), rnd("gain", 9).alias("gain"))


# --- what is refused ----------------------------------------------------------------

REFUSED = {
    "fitted_length": "embeddings", "label_gap": "lineitem", "label_without_point": "labels", "layout_mode": "embeddings", "missing_label": "documents",
    "scaler_changed": "embeddings", "split_kind": "embeddings", "too_many_neighbours": "embeddings", "tree_depth": "embeddings",
}


@catalog.query(" UNION ALL ".join(f"SELECT '{name}' AS contract, true AS refused, (SELECT count(*) FROM {source}) AS n" for name, source in REFUSED.items()))
def error_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """What operators refuse on whole tables: an error, and no result, for each contract."""
    e = embeddings(spark, sf).withColumnRenamed("vec_id", "row_id")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    points = docs.select(F.col("doc_id").alias("row_id"), F.array(F.col("n_chars").cast("double")).alias("features"))
    toxic = labels.select(F.col("doc_id").alias("row_id"), F.col("toxic").alias("label"))
    slot = scaling.ScalerSlot("standard")
    slot.fit(e)
    slot.set_kind("minmax")
    short = svm.LinearSvm(np.zeros((2, 3)), np.zeros(2))
    tries = {
        "fitted_length": lambda: svm.svm_scores(e, short).select("scores").toArrow(),
        "label_gap": lambda: nn.fit_classifier(lineitem(spark, sf, keep=("l_linenumber",)).withColumnRenamed("l_linenumber", "label"), max_iterations=1),
        "label_without_point": lambda: sp.split_with_labels(points, toxic),
        "layout_mode": lambda: layout.convert(e, "vector", "cube"),
        "missing_label": lambda: tr.fit_tree(points.join(toxic, "row_id", "left")),
        "scaler_changed": lambda: slot.transform(e),
        "split_kind": lambda: tr.new_hoeffding(3, DIM, tr.HoeffdingParams(numeric_split="ternary")),
        "too_many_neighbours": lambda: nb.knn(e, e, e.count() + 1),
        "tree_depth": lambda: tr.fit_tree(e, maximum_depth=31),
    }
    rows = []
    for name, attempt in tries.items():
        try:
            attempt()
            refused = False
        except (ValueError, PySparkException):
            refused = True
        rows.append((name, refused, table(spark, sf, REFUSED[name]).count()))
    return spark.createDataFrame(rows, "contract string, refused boolean, n bigint")


# --- networks -------------------------------------------------------------------------

HID, OUT = 6, 4
NET = nn.Network(
    (DIM, HID, OUT), "tanh",
    np.concatenate([_weights(3, HID, DIM).reshape(-1), _weights(4, HID), _weights(5, OUT, HID).reshape(-1), _weights(6, OUT)]), True,
)


def _mlp_sql() -> str:
    (w1, b1), (w2, b2) = NET.layers()
    hid = "[" + ", ".join(f"tanh({x})" for x in _affine_sql(w1, b1, "v")) + "]"
    z = ", ".join(f"{x} AS z{i}" for i, x in enumerate(_affine_sql(w2, b2, "h")))
    top = "greatest(" + ", ".join(f"z{i}" for i in range(OUT)) + ")"
    lse = f"({top} + ln(" + " + ".join(f"exp(z{i} - {top})" for i in range(OUT)) + "))"
    outs = ", ".join(f"{rnd_sql(f'z{i} - {lse}')} AS o{i}" for i in range(OUT))
    arr = "[" + ", ".join(f"z{i}" for i in range(OUT)) + "]"
    return (
        f"WITH {E_SQL}, h AS (SELECT vec_id, {hid} AS h FROM e), z AS (SELECT vec_id, {z} FROM h) "
        f"SELECT vec_id, {outs}, (list_position({arr}, {top}) - 1)::INT AS prediction FROM z"
    )


@catalog.query(_mlp_sql())
def mlp_forward_given_w(spark: SparkSession, sf: str) -> DataFrame:
    out = nn.apply_network(embeddings(spark, sf), NET)
    return out.select("vec_id", *[rnd(F.get("output", F.lit(i))).alias(f"o{i}") for i in range(OUT)], "prediction")


AE = nn.Autoencoder(_weights(7, 5, DIM), _weights(8, 5), _weights(9, DIM, 5), _weights(10, DIM))


def _sigmoids(w: np.ndarray, b: np.ndarray, x: str) -> list[str]:
    return [f"1.0 / (1.0 + exp(-({s})))" for s in _affine_sql(w, b, x)]


HIDDEN = f"h AS (SELECT vec_id, [{', '.join(_sigmoids(AE.w1, AE.b1, 'v'))}] AS h FROM e)"


@catalog.query(f"WITH {E_SQL}, {HIDDEN} SELECT vec_id, " + ", ".join(f"{rnd_sql(f'h[{i + 1}]')} AS h{i}" for i in range(5)) + " FROM h")
def sae_encode_given_w(spark: SparkSession, sf: str) -> DataFrame:
    h = nn.encode(embeddings(spark, sf), AE)
    return h.select("vec_id", *[rnd(F.get("hidden", F.lit(i))).alias(f"h{i}") for i in range(5)])


@catalog.query(
    f"WITH {E_SQL}, {HIDDEN}, d AS (SELECT vec_id, [{', '.join(_sigmoids(AE.w2, AE.b2, 'h'))}] AS d FROM h) "
    f"SELECT vec_id, {rnd_sql('d[1]')} AS first, {rnd_sql('d[64]')} AS last, {rnd_sql('list_sum(d)')} AS total FROM d"
)
def sae_decode_given_w(spark: SparkSession, sf: str) -> DataFrame:
    d = nn.decode(nn.encode(embeddings(spark, sf), AE), AE)
    return d.select(
        "vec_id", rnd(F.get("decoded", F.lit(0))).alias("first"), rnd(F.get("decoded", F.lit(63))).alias("last"),
        rnd(F.aggregate("decoded", F.lit(0.0), lambda s, v: s + v)).alias("total"),
    )


@catalog.query(
    f"WITH {E_SQL}, {HIDDEN}, d AS (SELECT vec_id, h, [{', '.join(_sigmoids(AE.w2, AE.b2, 'h'))}] AS d FROM h), "
    "s AS (SELECT 0.5 * avg(power(list_distance(d, v), 2)) AS sse FROM d JOIN e USING (vec_id)), "
    "r AS (SELECT sum(0.01 * ln(0.01 / m) + 0.99 * ln(0.99 / (1 - m))) AS kl FROM (SELECT i, avg(x) AS m FROM (SELECT generate_subscripts(h, 1) AS i, unnest(h) AS x FROM h) GROUP BY i)) "
    f"SELECT {rnd_sql(f'sse + 0.00005 * {float((AE.w1**2).sum() + (AE.w2**2).sum())!r} + 3.0 * kl')} AS cost FROM s, r"
)
def sae_cost_given_w(spark: SparkSession, sf: str) -> DataFrame:
    cost, _ = nn.autoencoder_cost(embeddings(spark, sf), AE, lam=1e-4, beta=3.0, rho=0.01)
    return spark.createDataFrame([(cost,)], "cost double").withColumn("cost", rnd("cost"))


@catalog.query(
    "SELECT event_id, " + ", ".join(
        f"{rnd_sql(f)} AS {n}" for n, f in (
            ("sigmoid", "1 / (1 + exp(-x))"), ("gaussian", "exp(-x * x)"), ("relu", "greatest(x, 0)"), ("tanh", "tanh(x)"),
            ("softplus", "ln(1 + exp(x))"), ("identity", "x"),
        )
    ) + " FROM (SELECT event_id, value / 100.0 - 2.0 AS x FROM events)"
)
def activations(spark: SparkSession, sf: str) -> DataFrame:
    x = F.col("value") / 100.0 - 2.0
    return table(spark, sf, "events").select("event_id", *[rnd(f(x)).alias(n) for n, f in exprs.ACTIVATIONS.items()])


@catalog.query(ACCURATE)
def mlp_fit_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = _blobs(spark, sf)
    net = nn.fit_classifier(df, hidden_neurons=6, optimizer="adam", max_iterations=12, activation="tanh", tolerance=2e-2)
    return _above(nn.apply_network(df, net), 0.85)


@catalog.query(ACCURATE)
def mlp_lbfgs_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    df = _blobs(spark, sf)
    net = nn.fit_classifier(df, hidden_neurons=6, optimizer="lbfgs", max_iterations=15, activation="sigmoid")
    return _above(nn.apply_network(df, net), 0.7)


@catalog.query("SELECT count(*) AS n, true AS better_than_mean FROM lineitem")
def mlp_regressor_fit(spark: SparkSession, sf: str) -> DataFrame:
    """A curve of the price, predicted with less than half the error of the mean."""
    x = F.col("l_extendedprice") / 50000.0 - 1.0
    df = table(spark, sf, "lineitem").select(F.array(x).alias("features"), (x * x).alias("target"))
    net = nn.fit_regressor(df, hidden_neurons=8, optimizer="rmsprop", max_iterations=4, activation="tanh", tolerance=1e-3)
    scored = nn.apply_network(df, net).withColumn("err", F.pow(F.get("output", F.lit(0)) - F.col("target"), 2))
    return scored.agg(F.count("*").alias("n"), (F.avg("err") < 0.5 * F.var_pop("target")).alias("better_than_mean"))


@catalog.query("SELECT count(*) AS n, true AS cost_falls FROM embeddings")
def sae_fit_cost(spark: SparkSession, sf: str) -> DataFrame:
    _, df = scaling.fit_scale(embeddings(spark, sf), "min_max", low=0.1, high=0.9)
    first = nn.fit_autoencoder(df, 8, max_iterations=1)
    later = nn.fit_autoencoder(df, 8, max_iterations=12)
    return df.agg(F.count("*").alias("n")).withColumn("cost_falls", F.lit(bool(later.cost < first.cost)))

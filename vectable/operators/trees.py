"""Decision trees: a batch tree by Spark ML, and an incremental tree grown from counted batches."""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.functions.blocks import matrix_udf, sum_over_rows
from vectable.operators.layout import shape
from vectable.operators.order import running_totals
from vectable.session import cut_lineage, reused

MAX_DEPTH = 30  # of the tree builder in Spark ML

# --- batch tree -----------------------------------------------------------------


def fit_tree(
    df: DataFrame,
    label_col: str = "label",
    *,
    minimum_leaf_size: int = 10,
    minimum_gain_split: float = 1e-6,
    maximum_depth: int = MAX_DEPTH,
    bins: int = 32,
    seed: int = 0,
) -> DecisionTreeClassificationModel:
    """Gini tree with numeric splits among ``bins`` ranges of a feature, at most 30 levels deep.

    A deeper or unlimited tree is refused, not cut.
    """
    if not 0 < maximum_depth <= MAX_DEPTH:
        raise ValueError(f"maximum_depth lies in 1..{MAX_DEPTH}")
    if df.filter(F.col(label_col).isNull()).limit(1).count():
        raise ValueError("missing labels")
    _, dim = shape(df)
    if dim == 0:
        raise ValueError("no training data")
    grower = DecisionTreeClassifier(
        featuresCol="_v", labelCol="_y", impurity="gini", minInstancesPerNode=minimum_leaf_size, minInfoGain=minimum_gain_split,
        maxDepth=maximum_depth, maxBins=bins, maxMemoryInMB=512, seed=seed,
    )
    with reused(df, "features", label_col) as kept:
        return grower.fit(kept.select(array_to_vector("features").alias("_v"), F.col(label_col).cast("double").alias("_y")))


def tree_predict(df: DataFrame, model: DecisionTreeClassificationModel) -> DataFrame:
    """Adds ``prediction`` (int) and ``probability`` (array, one per class)."""
    scored = model.setPredictionCol("_p").setProbabilityCol("_q").setRawPredictionCol("_r").transform(
        df.withColumn("_v", array_to_vector("features"))
    )
    return scored.withColumn("prediction", F.col("_p").cast("int")).withColumn("probability", vector_to_array("_q")).drop("_v", "_p", "_q", "_r")


def accuracy(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """One row: rows, correct share."""
    return df.agg(F.count("*").alias("n"), F.avg((F.col(prediction_col) == F.col(label_col)).cast("double")).alias("accuracy"))


# --- split quality ----------------------------------------------------------------


def impurity_expr(counts: list[Column], criterion: str) -> Column:
    """Gini impurity or entropy (bits) of class counts."""
    total = sum(counts[1:], counts[0])
    shares = [F.when(total > 0, c / total).otherwise(0.0) for c in counts]
    if criterion == "gini":
        terms = [p * p for p in shares]
        return F.lit(1.0) - sum(terms[1:], terms[0])
    terms = [F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in shares]
    return sum(terms[1:], terms[0])


def split_gains(df: DataFrame, classes: int, label_col: str = "label", criterion: str = "gini") -> DataFrame:
    """(feature_idx, value, n_left, gain) of every binary split "x <= value", over all distinct values.

    Values are counted per class before they are ordered; the running class counts come
    from a range-partitioned pass, so a feature of any cardinality is spread over tasks.
    """
    cells = df.select(F.col(label_col).alias("y"), F.posexplode("features").alias("feature_idx", "value"))
    per_class = [F.sum(F.when(F.col("y") == c, 1.0).otherwise(0.0)).alias(f"c{c}") for c in range(classes)]
    counted = cells.groupBy("feature_idx", "value").agg(*per_class)
    run = running_totals(counted, ["feature_idx"], ["value"], {f"l{c}": f"c{c}" for c in range(classes)})
    whole = df.groupBy(F.col(label_col).alias("y")).count().collect()
    total = np.zeros(classes)
    for row in whole:
        total[row["y"]] = row["count"]
    n = float(total.sum())
    left = [F.col(f"l{c}") for c in range(classes)]
    right = [F.lit(float(total[c])) - F.col(f"l{c}") for c in range(classes)]
    n_left = sum(left[1:], left[0])
    parent = impurity_expr([F.lit(float(t)) for t in total], criterion)
    gain = parent - n_left / n * impurity_expr(left, criterion) - (F.lit(n) - n_left) / n * impurity_expr(right, criterion)
    return run.select("feature_idx", "value", n_left.cast("bigint").alias("n_left"), gain.alias("gain")).filter(F.col("n_left") < int(n))


def _impurity(counts: np.ndarray, gini: bool) -> np.ndarray:
    """Along the last axis."""
    total = counts.sum(-1, keepdims=True)
    p = counts / np.maximum(total, 1e-300)
    if gini:
        return 1.0 - (p * p).sum(-1)
    return -(p * np.log2(np.maximum(p, 1e-300))).sum(-1)


# --- incremental tree ---------------------------------------------------------------


@dataclass(frozen=True)
class HoeffdingParams:
    confidence: float = 0.95
    max_samples: int = 5000
    check_interval: int = 20
    min_samples: int = 20
    info_gain: bool = False
    numeric_split: str = "domingos"
    bins: int = 10
    observations_before_binning: int = 100


@dataclass(frozen=True)
class Node:
    """A leaf, or a split of one feature at ascending thresholds (values at a threshold go up)."""

    counts: tuple[float, ...]
    feature: int = -1
    thresholds: tuple[float, ...] = ()
    children: tuple[int, ...] = ()


@dataclass(frozen=True)
class HoeffdingTree:
    params: HoeffdingParams
    classes: int
    dim: int
    nodes: tuple[Node, ...]
    lows: dict[int, np.ndarray] = field(default_factory=dict)  # leaf -> per-feature range, once fixed
    highs: dict[int, np.ndarray] = field(default_factory=dict)
    histograms: dict[int, np.ndarray] = field(default_factory=dict)  # leaf -> (dim, bins, classes)
    checked: dict[int, float] = field(default_factory=dict)  # leaf -> rows at its last check
    waiting: tuple[tuple[int, tuple[float, ...]], ...] = ()  # labelled rows of leaves without a range yet
    # Exact splits: the table (leaf, feature_idx, value, c0, c1, ..) of what every leaf has seen, of any size.
    values: DataFrame | None = None

    def leaves(self) -> list[int]:
        return [i for i, n in enumerate(self.nodes) if not n.children]


def new_hoeffding(classes: int, dim: int, params: HoeffdingParams | None = None) -> HoeffdingTree:
    p = params or HoeffdingParams()
    if p.numeric_split not in ("domingos", "binary"):
        raise ValueError("numeric_split is domingos or binary")
    return HoeffdingTree(p, classes, dim, (Node((0.0,) * classes),))


def route(nodes: tuple[Node, ...], x: np.ndarray) -> np.ndarray:
    """Leaf of each row."""
    out = np.zeros(len(x), dtype=np.int64)
    work = [(0, np.arange(len(x)))]
    while work:
        at, rows = work.pop()
        node = nodes[at]
        if not node.children:
            out[rows] = at
            continue
        side = np.searchsorted(np.asarray(node.thresholds), x[rows, node.feature], side="right")
        for c, child in enumerate(node.children):
            pick = rows[side == c]
            if len(pick):
                work.append((child, pick))
    return out


def _ranges(df: DataFrame, tree: HoeffdingTree) -> DataFrame:
    """(leaf, f, n, lo, hi) of the rows in leaves that have no bin ranges yet."""
    nodes = tree.nodes
    leaf = matrix_udf(lambda x: route(nodes, x), "int")(F.col("features"))
    open_leaves = [i for i in tree.leaves() if i not in tree.lows]
    rows = df.select(leaf.alias("leaf"), "features").filter(F.col("leaf").isin(open_leaves))
    cells = rows.select("leaf", F.posexplode("features").alias("f", "v"))
    return cells.groupBy("leaf", "f").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def leaf_counts(df: DataFrame, tree: HoeffdingTree, label_col: str = "label") -> dict[int, np.ndarray]:
    """leaf -> (dim, bins, classes) counts of the rows in leaves with fixed ranges: one scan."""
    fixed = [i for i in tree.leaves() if i in tree.lows]
    if not fixed:
        return {}
    slot = np.full(len(tree.nodes), -1)
    slot[fixed] = np.arange(len(fixed))
    lows, highs = np.stack([tree.lows[i] for i in fixed]), np.stack([tree.highs[i] for i in fixed])
    nodes, bins, d, k = tree.nodes, tree.params.bins, tree.dim, tree.classes
    size = len(fixed) * d * bins * k

    def step(x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        s = slot[route(nodes, x)]
        x, y, s = x[s >= 0], y[s >= 0].astype(np.int64), s[s >= 0]
        width = highs[s] - lows[s]
        at = np.floor((x - lows[s]) / np.where(width > 0, width, 1.0) * bins)
        at = np.clip(at, 0, bins - 1).astype(np.int64)
        key = ((s[:, None] * d + np.arange(d)) * bins + at) * k + y[:, None]
        return {"c": np.bincount(key.reshape(-1), minlength=size).astype(float)}

    out = sum_over_rows(df, ["features", label_col], step)
    if not out:
        return {}
    table = out["c"].reshape(len(fixed), d, bins, k)
    return {leaf: table[i] for i, leaf in enumerate(fixed)}


def _edges(tree: HoeffdingTree, leaf: int, f: int) -> np.ndarray:
    lo, hi = tree.lows[leaf][f], tree.highs[leaf][f]
    return lo + (hi - lo) * np.arange(1, tree.params.bins) / tree.params.bins


def best_splits(tree: HoeffdingTree, leaf: int) -> list[tuple[float, int, tuple[float, ...], np.ndarray]]:
    """(gain, feature, thresholds, counts per child) per feature, best first: one child per bin."""
    p, hist = tree.params, tree.histograms[leaf]
    gini, n = not p.info_gain, hist[0].sum()
    parent = float(_impurity(hist[0].sum(0), gini))
    out = []
    for f in range(tree.dim):
        if tree.highs[leaf][f] <= tree.lows[leaf][f]:
            continue
        share = hist[f].sum(-1) / n
        out.append((parent - float((share * _impurity(hist[f], gini)).sum()), f, tuple(_edges(tree, leaf, f)), hist[f]))
    return sorted(out, key=lambda s: (-s[0], s[1]))


def _names(classes: int, prefix: str = "c") -> list[str]:
    return [f"{prefix}{c}" for c in range(classes)]


def value_counts(cells: DataFrame, classes: int) -> DataFrame:
    """(leaf, feature_idx, value, c0, c1, ..) of cells (leaf, feature_idx, value, y)."""
    per_class = [F.sum(F.when(F.col("y") == c, 1.0).otherwise(0.0)).alias(n) for c, n in enumerate(_names(classes))]
    return cells.groupBy("leaf", "feature_idx", "value").agg(*per_class)


def observe_values(df: DataFrame, tree: HoeffdingTree, label_col: str = "label", *, fresh: bool = False) -> HoeffdingTree:
    """Count one batch into the value table: rows are routed to their leaves, and equal values of a leaf add up."""
    nodes, names = tree.nodes, _names(tree.classes)
    leaf = matrix_udf(lambda x: route(nodes, x), "int")(F.col("features"))
    cells = df.select(leaf.alias("leaf"), F.col(label_col).cast("int").alias("y"), F.posexplode("features").alias("feature_idx", "value"))
    counted = value_counts(cells.filter(F.col("value").isNotNull()), tree.classes)
    if tree.values is not None and not fresh:
        both = counted.unionByName(tree.values)
        counted = both.groupBy("leaf", "feature_idx", "value").agg(*[F.sum(n).alias(n) for n in names])
    return replace(tree, values=cut_lineage(counted))


def leaf_sizes(tree: HoeffdingTree) -> dict[int, np.ndarray]:
    """Class counts of every leaf that has seen rows."""
    names = _names(tree.classes)
    if tree.values is None:
        return {}
    found = tree.values.filter(F.col("feature_idx") == 0).groupBy("leaf").agg(*[F.sum(n).alias(n) for n in names])
    return {r["leaf"]: np.array([r[n] for n in names]) for r in found.collect()}


def value_splits(tree: HoeffdingTree, sizes: dict[int, np.ndarray]) -> DataFrame:
    """(leaf, feature_idx, value, gain, left) of the best split "x <= value" of every feature of the given leaves."""
    spark = tree.values.sparkSession
    of = spark.createDataFrame([(leaf, *map(float, n)) for leaf, n in sizes.items()], "leaf int, " + ", ".join(f"{n} double" for n in _names(tree.classes, "t")))
    seen = tree.values.filter(F.col("leaf").isin(list(sizes)))
    return feature_splits(seen, of, tree.classes, 1, "entropy" if tree.params.info_gain else "gini")


def _ranked_values(tree: HoeffdingTree, sizes: dict[int, np.ndarray]) -> dict[int, list[tuple[float, int, tuple[float, ...], np.ndarray]]]:
    """Per leaf what best_splits has; only the best split of every feature reaches the driver."""
    out: dict[int, list] = {leaf: [] for leaf in sizes}
    for r in value_splits(tree, sizes).collect() if sizes else ():
        left = np.array(r["left"])
        # Values at a threshold go up, so the threshold is the next number above the value.
        above = (float(np.nextafter(r["value"], np.inf)),)
        out[r["leaf"]].append((r["gain"], r["feature_idx"], above, np.stack([left, sizes[r["leaf"]] - left])))
    return {leaf: sorted(found, key=lambda s: (-s[0], s[1])) for leaf, found in out.items()}


def hoeffding_bound(n: float, classes: int, confidence: float, info_gain: bool) -> float:
    span = math.log2(classes) if info_gain else 1.0 - 1.0 / classes
    return math.sqrt(span * span * math.log(1.0 / (1.0 - confidence)) / (2.0 * n))


def grow(tree: HoeffdingTree) -> tuple[HoeffdingTree, int]:
    """Split every leaf whose best feature is ahead of the second by the bound; returns the splits made."""
    p, nodes = tree.params, list(tree.nodes)
    exact = p.numeric_split == "binary"
    sizes = leaf_sizes(tree) if exact else {leaf: h[0].sum(0) for leaf, h in tree.histograms.items()}
    checked, due = dict(tree.checked), {}
    for leaf, counts in sizes.items():
        nodes[leaf] = replace(nodes[leaf], counts=tuple(counts.tolist()))
        n = float(counts.sum())
        if n >= p.min_samples and n - checked.get(leaf, 0.0) >= p.check_interval:
            checked[leaf], due[leaf] = n, counts
    ranked = _ranked_values(tree, due) if exact else {leaf: best_splits(tree, leaf) for leaf in due}
    split: list[int] = []
    for leaf in due:
        found, n = ranked[leaf], checked[leaf]
        if not found or found[0][0] <= 0.0:
            continue
        lead = found[0][0] - (found[1][0] if len(found) > 1 else 0.0)
        sure = lead > hoeffding_bound(n, tree.classes, p.confidence, p.info_gain)
        if not sure and not (p.max_samples and n > p.max_samples):
            continue
        _, feature, thresholds, child_counts = found[0]
        first = len(nodes)
        parent_counts = np.asarray(nodes[leaf].counts)
        for c in child_counts:
            # An empty child answers like its parent until it sees rows.
            nodes.append(Node(tuple(c if c.sum() else parent_counts / max(parent_counts.sum(), 1.0))))
        nodes[leaf] = replace(nodes[leaf], feature=feature, thresholds=thresholds, children=tuple(range(first, len(nodes))))
        split.append(leaf)
    state = [{k: v for k, v in d.items() if k not in split} for d in (tree.lows, tree.highs, tree.histograms, checked)]
    values = tree.values.filter(~F.col("leaf").isin(split)) if exact and split and tree.values is not None else tree.values
    lows, highs, hists, checked = state
    return replace(tree, nodes=tuple(nodes), lows=lows, highs=highs, histograms=hists, checked=checked, values=values), len(split)


def _with_waiting(df: DataFrame, tree: HoeffdingTree, label_col: str) -> DataFrame:
    if not tree.waiting:
        return df
    rows = [(y, list(x)) for y, x in tree.waiting]
    schema = f"{label_col} int, features array<double>"
    return df.unionByName(df.sparkSession.createDataFrame(rows, schema))


def observe(df: DataFrame, tree: HoeffdingTree, label_col: str = "label", *, fresh: bool = False) -> HoeffdingTree:
    """Count one batch into the leaves.

    A leaf fixes its bin ranges once it has seen enough rows; until then its few rows
    (fewer than ``observations_before_binning`` per leaf) wait in the model.  ``fresh``
    replaces the counts instead of adding to them (whole-table passes).  Exact (``binary``)
    splits have no bins: their values are counted in a table.
    """
    if tree.params.numeric_split == "binary":
        return observe_values(df, tree, label_col, fresh=fresh)
    batch = _with_waiting(df.select(F.col(label_col).cast("int").alias(label_col), "features"), tree, label_col)
    lows, highs = dict(tree.lows), dict(tree.highs)
    need = 1 if fresh else tree.params.observations_before_binning
    with reused(batch, label_col, "features") as kept:
        waiting: list[tuple[int, tuple[float, ...]]] = []
        open_leaves = [i for i in tree.leaves() if i not in lows]
        if open_leaves:
            seen: dict[int, int] = {}
            span: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for r in _ranges(kept, tree).collect():
                leaf = r["leaf"]
                seen[leaf] = r["n"]
                lo, hi = span.setdefault(leaf, (np.zeros(tree.dim), np.zeros(tree.dim)))
                lo[r["f"]], hi[r["f"]] = r["lo"], r["hi"]
            for leaf, n in seen.items():
                if n >= need:
                    lows[leaf], highs[leaf] = span[leaf]
            short = [leaf for leaf, n in seen.items() if n < need]
            if short:
                nodes = tree.nodes
                at = matrix_udf(lambda x: route(nodes, x), "int")(F.col("features"))
                rows = kept.withColumn("_leaf", at).filter(F.col("_leaf").isin(short)).collect()
                waiting = [(r[label_col], tuple(r["features"])) for r in rows]
        ready = replace(tree, lows=lows, highs=highs, waiting=tuple(waiting))
        counts = leaf_counts(kept, ready, label_col)
    hists = dict(tree.histograms)
    for leaf, c in counts.items():
        hists[leaf] = c if fresh or leaf not in hists else hists[leaf] + c
    return replace(ready, histograms=hists)


def train_batch(df: DataFrame, tree: HoeffdingTree, label_col: str = "label", max_levels: int | None = None) -> HoeffdingTree:
    """Whole-table training: count, split, and repeat until no leaf splits; ``max_levels`` stops before."""
    with reused(df, label_col, "features") as kept:
        for _ in itertools.count() if max_levels is None else range(max_levels):
            tree = observe(kept, replace(tree, checked={}), label_col, fresh=True)
            tree, made = grow(tree)
            if not made:
                break
    return tree


def train_incremental(batches: list[DataFrame], tree: HoeffdingTree, label_col: str = "label", passes: int = 1) -> HoeffdingTree:
    """Batches in order, each counted into the current leaves and followed by split checks."""
    for _ in range(max(1, passes)):
        for batch in batches:
            tree, _ = grow(observe(batch, tree, label_col))
    return tree


def hoeffding_predict(df: DataFrame, tree: HoeffdingTree) -> DataFrame:
    """Adds ``prediction`` and ``probability`` of the leaf's majority class."""
    nodes = tree.nodes
    table = np.zeros((len(nodes), 2))
    for i, n in enumerate(nodes):
        c = np.asarray(n.counts)
        table[i] = c.argmax(), c.max() / c.sum() if c.sum() else 0.0
    answer = matrix_udf(lambda x: table[route(nodes, x)])(F.col("features"))
    return (
        df.withColumn("_a", answer)
        .withColumn("prediction", F.get("_a", F.lit(0)).cast("int"))
        .withColumn("probability", F.get("_a", F.lit(1)))
        .drop("_a")
    )


# --- batch tree on every threshold ----------------------------------------------------

GAIN_DIGITS = 9


@dataclass(frozen=True)
class Split:
    """A split of a batch tree: rows with feature <= value go to the first child."""

    node: int
    level: int
    feature: int
    value: float
    n: int
    gain: float


def feature_splits(counted: DataFrame, sizes: DataFrame, classes: int, minimum_leaf_size: int, criterion: str = "gini") -> DataFrame:
    """(leaf, feature_idx, value, gain, left) of the best split "x <= value" of each feature of each leaf, over all distinct values.

    ``counted`` is (leaf, feature_idx, value, c0, c1, ..), ``sizes`` (leaf, t0, t1, ..): class counts.
    Gains are compared to nine digits; the lower value wins ties.
    """
    run = running_totals(counted, ["leaf", "feature_idx"], ["value"], {f"l{c}": n for c, n in enumerate(_names(classes))}).join(F.broadcast(sizes), "leaf")
    left = [F.col(f"l{c}") for c in range(classes)]
    whole = [F.col(f"t{c}") for c in range(classes)]
    right = [t - x for t, x in zip(whole, left)]
    n_left, n = sum(left[1:], left[0]), sum(whole[1:], whole[0])
    gain = impurity_expr(whole, criterion) - n_left / n * impurity_expr(left, criterion) - (n - n_left) / n * impurity_expr(right, criterion)
    tried = run.filter((n_left >= minimum_leaf_size) & (n - n_left >= minimum_leaf_size)).withColumn("gain", F.round(gain, GAIN_DIGITS))
    best = F.max_by(F.struct("value", "gain", F.array(*left).alias("left")), F.struct(F.col("gain"), -F.col("value")))
    return tried.groupBy("leaf", "feature_idx").agg(best.alias("b")).select("leaf", "feature_idx", "b.*")


def exact_splits(cells: DataFrame, sizes: DataFrame, classes: int, minimum_leaf_size: int) -> DataFrame:
    """(leaf, feature_idx, value, gain, left) of the best split of each leaf of ``cells`` (leaf, feature_idx, value, y); the lower feature wins ties."""
    found = feature_splits(value_counts(cells, classes), sizes, classes, minimum_leaf_size)
    order = F.struct(F.col("gain"), -F.col("feature_idx"), -F.col("value"))
    return found.groupBy("leaf").agg(F.max_by(F.struct("feature_idx", "value", "gain", "left"), order).alias("b")).select("leaf", "b.*")


def train_exact(
    df: DataFrame, classes: int, dim: int, label_col: str = "label", *, minimum_leaf_size: int = 10, minimum_gain_split: float = 1e-7, maximum_depth: int = 0
) -> tuple[HoeffdingTree, list[Split]]:
    """A Gini tree that tries every distinct value of every feature, level by level; depth 0 means no limit.

    A level is one pass that counts values per leaf, and one ordered pass over the distinct
    values; only the best split of each leaf reaches the driver.
    """
    if minimum_leaf_size < 1 or maximum_depth < 0:
        raise ValueError("minimum_leaf_size is at least 1, maximum_depth at least 0")
    spark = df.sparkSession
    with reused(df, label_col, "features") as kept:
        found = kept.groupBy(F.col(label_col).cast("int").alias("y")).count().collect()
        if not found or any(r["y"] is None or not 0 <= r["y"] < classes for r in found):
            raise ValueError("labels lie in 0 .. classes - 1 and are not missing")
        counts = np.zeros(classes)
        for r in found:
            counts[r["y"]] += r["count"]
        nodes, made = [Node(tuple(counts.tolist()))], []
        open_leaves = {0} if (counts > 0).sum() > 1 else set()
        for level in itertools.count():
            if not open_leaves or (maximum_depth and level >= maximum_depth):
                break
            current, active = tuple(nodes), np.isin(np.arange(len(nodes)), sorted(open_leaves))

            def leaf_of(x: np.ndarray, current: tuple[Node, ...] = current, active: np.ndarray = active) -> np.ndarray:
                at = route(current, x)
                return np.where(active[at], at, -1)

            at = matrix_udf(leaf_of, "int")(F.col("features"))
            cells = kept.select(at.alias("leaf"), F.col(label_col).cast("int").alias("y"), "features").filter("leaf >= 0")
            cells = cells.select("leaf", "y", F.posexplode("features").alias("feature_idx", "value"))
            sizes = spark.createDataFrame([(leaf, *nodes[leaf].counts) for leaf in sorted(open_leaves)], "leaf int, " + ", ".join(f"t{c} double" for c in range(classes)))
            open_leaves = set()
            for r in exact_splits(cells, sizes, classes, minimum_leaf_size).filter(F.col("gain") > minimum_gain_split).orderBy("leaf").collect():
                leaf, left = r["leaf"], np.array(r["left"])
                total = np.array(nodes[leaf].counts)
                # Values at a threshold go up, so the threshold is the next number above the value.
                nodes[leaf] = replace(nodes[leaf], feature=r["feature_idx"], thresholds=(float(np.nextafter(r["value"], np.inf)),), children=(len(nodes), len(nodes) + 1))
                made.append(Split(leaf, level, r["feature_idx"], r["value"], int(total.sum()), r["gain"]))
                for part in (left, total - left):
                    if (part > 0).sum() > 1 and part.sum() >= 2 * minimum_leaf_size:
                        open_leaves.add(len(nodes))
                    nodes.append(Node(tuple(part.tolist())))
    return replace(new_hoeffding(classes, dim), nodes=tuple(nodes)), made

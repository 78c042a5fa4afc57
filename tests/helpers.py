import numpy as np


def points(spark, x, partitions=4, **columns):
    """(row_id, features, ...) from a matrix."""
    names = list(columns)
    rows = [(i, [float(v) for v in p], *[columns[n][i] for n in names]) for i, p in enumerate(x)]
    kinds = ", ".join(f"{n} {'int' if np.issubdtype(np.asarray(columns[n]).dtype, np.integer) else 'double'}" for n in names)
    df = spark.createDataFrame([tuple(v.item() if hasattr(v, "item") else v for v in r) for r in rows], "row_id bigint, features array<double>" + (", " + kinds if kinds else ""))
    return df.repartition(partitions)


def blobs(rng, n=60, centers=((0.0, 0.0), (8.0, 0.0), (0.0, 8.0))):
    x = np.vstack([rng.normal(c, 0.5, (n, len(c))) for c in centers])
    return x, np.repeat(np.arange(len(centers)), n)

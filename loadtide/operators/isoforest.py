"""Isolation forest (Liu, Ting, Zhou 2008) as Spark jobs.

Each tree sees a small random subset of the rows, so trees are built in parallel from
groups of at most ``sample`` rows. The finished nodes are few (``trees * 2 * sample`` at
most) and go to every task that scores rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadtide.operators.quantiles import exact_quantile
from loadtide.session import materialize

# Trees, rows per tree, seed and the share of rows reported.
TREES, SAMPLE, SEED, CONTAMINATION = 300, 256, 42, 0.01
FEATURES = [
    "hits", "bytes_sum", "avg_bytes_per_req", "unique_hosts", "error_rate", "rate_4xx", "rate_5xx", "hour", "dow",
]
NODE_SCHEMA = "tree int, node int, rows int, feature int, cut double, left int, right int, length double"
EULER = 0.5772156649015329


def path_length(n: np.ndarray | float) -> np.ndarray:
    """Average path of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    longer = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, longer, np.where(n == 2, 1.0, 0.0))


def standardize(df: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Columns as ``x0..`` with mean 0 and population deviation 1; absent values count as 0."""
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    stats = df.agg(
        F.struct(
            *[F.avg(v).alias(f"m{i}") for i, v in enumerate(value.values())],
            *[F.stddev_pop(v).alias(f"d{i}") for i, v in enumerate(value.values())],
        )
    )
    scaled = {
        f"x{i}": (v - F.col(f"_z.m{i}")) / F.when(F.col(f"_z.d{i}") == 0, 1.0).otherwise(F.col(f"_z.d{i}"))
        for i, v in enumerate(value.values())
    }
    return df.withColumn("_z", stats.scalar()).withColumns(scaled).drop("_z")


def tree_samples(
    df: DataFrame, id_cols: Sequence[str], n_features: int, trees: int, sample: int, seed: int
) -> DataFrame:
    """For each tree the ``sample`` rows with the smallest hash of (row, tree).

    A row is offered to a tree only if its hash is below a bound that leaves about four
    times the wanted rows, so few candidates are shuffled however large the input is.
    """
    total = df.agg(F.count(F.lit(1)))
    offered = df.select(
        *[F.col(f"x{i}") for i in range(n_features)],
        F.xxhash64(F.lit(seed), *id_cols).alias("_row"),
        F.least(F.lit(1.0), F.lit(4.0 * sample) / F.greatest(total.scalar(), F.lit(1))).alias("_bound"),
    )

    def draw(tree):
        return F.pmod(F.xxhash64(tree, F.col("_row")), F.lit(1 << 40)) / F.lit(float(1 << 40))

    # a row is copied only for the trees that it is offered to
    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < F.col("_bound"))
    near = offered.withColumn("tree", F.explode(chosen)).withColumn("_draw", draw(F.col("tree")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("_draw", "_row"))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= sample).drop("_row", "_bound", "_draw")


def grow_tree(rows: pd.DataFrame, n_features: int, seed: int) -> pd.DataFrame:
    """Nodes of one tree over at most a few hundred rows; leaves carry their path length."""
    tree = int(rows["tree"].iloc[0])
    x = rows.sort_values("_rank")[[f"x{i}" for i in range(n_features)]].to_numpy(dtype=float)
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes: list[list] = [[0, -1, 0.0, -1, -1, 0.0]]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        at, members, depth = todo.pop()
        low, high = x[members].min(axis=0), x[members].max(axis=0)
        open_to = np.flatnonzero(high > low)
        if depth >= limit or len(members) <= 1 or not len(open_to):
            nodes[at] = [len(members), -1, 0.0, -1, -1, depth + float(path_length(len(members)))]
            continue
        feature = int(rng.choice(open_to))
        cut = float(rng.uniform(low[feature], high[feature]))
        left = x[members, feature] <= cut
        kids = len(nodes), len(nodes) + 1
        nodes += [[0, -1, 0.0, -1, -1, 0.0] for _ in kids]
        nodes[at] = [len(members), feature, cut, *kids, 0.0]
        todo += [(kids[0], members[left], depth + 1), (kids[1], members[~left], depth + 1)]
    out = pd.DataFrame(nodes, columns=["rows", "feature", "cut", "left", "right", "length"])
    return out.assign(tree=tree, node=range(len(nodes)))[
        ["tree", "node", "rows", "feature", "cut", "left", "right", "length"]
    ]


def tree_nodes(
    scaled: DataFrame, id_cols: Sequence[str], n_features: int, trees: int, sample: int, seed: int
) -> DataFrame:
    samples = tree_samples(scaled, id_cols, n_features, trees, sample, seed)
    return samples.groupBy("tree").applyInPandas(lambda g: grow_tree(g, n_features, seed), NODE_SCHEMA)


def isolation_scores(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    *,
    id_cols: Sequence[str] = ("bucket_start",),
    keys: Sequence[str] = (),
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """``if_score`` in (0, 1] per row, larger for rows that are easier to isolate."""
    n_features = len(cols)
    scaled = standardize(df, cols)
    id_cols = [*keys, *id_cols]  # rows are drawn by all that tells them apart
    # at most trees * (2 * sample - 1) short rows, a few megabytes by construction
    nodes = tree_nodes(scaled, id_cols, n_features, trees, sample, seed).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    base = nodes.groupby("tree")["node"].transform(lambda s: s.index[0])
    table = {
        "feature": nodes["feature"].to_numpy(),
        "cut": nodes["cut"].to_numpy(),
        "left": (nodes["left"] + base).to_numpy(),
        "right": (nodes["right"] + base).to_numpy(),
        "length": nodes["length"].to_numpy(),
        "roots": np.flatnonzero(nodes["node"].to_numpy() == 0),
    }
    shared = df.sparkSession.sparkContext.broadcast(table)
    names = df.columns
    fields = [f"x{i}" for i in range(n_features)]
    usual = float(path_length(nodes["rows"].max() if len(nodes) else 1))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for rows in batches:
            x = rows[fields].to_numpy(dtype=float)
            total = np.zeros(len(x))
            for root in t["roots"]:
                at = np.full(len(x), root)
                live = np.flatnonzero(t["feature"][at] >= 0)
                while len(live):
                    here = at[live]
                    go_left = x[live, t["feature"][here]] <= t["cut"][here]
                    at[live] = np.where(go_left, t["left"][here], t["right"][here])
                    live = live[t["feature"][at[live]] >= 0]
                total += t["length"][at]
            mean = total / max(len(t["roots"]), 1)
            yield rows[names].assign(if_score=np.power(2.0, -mean / max(usual, 1e-9)))

    fields_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return scaled.mapInPandas(score, f"{fields_schema}, if_score double")


def isolation_anomalies(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    *,
    contamination: float = CONTAMINATION,
    **options,
) -> DataFrame:
    """Scores, and a flag on rows whose score reaches the top share of all scores."""
    scored = materialize(isolation_scores(df, cols, **options), "scores")
    level = exact_quantile(scored, "if_score", 1.0 - contamination).scalar()
    return scored.withColumn("if_is_anomaly", (F.col("if_score") >= level).cast("tinyint"))

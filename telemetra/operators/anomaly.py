"""Anomaly scoring: baseline fallback (S10), isolation forest (M1, M2),
score summary (M3) and evaluation (M4).

Isolation forest after Liu, Ting and Zhou (2008): each tree isolates a
subsample of ``max_samples`` rows with random axis splits up to height
ceil(log2(max_samples)); the score of x is 2^(-E[h(x)] / c(max_samples)).

Distribution:
* at every size a row is drawn for each tree with the same probability, by
  hashes of its identity (key columns, readings and a copy number), so equal
  readings are drawn independently; only drawn rows are repeated, about
  1.3 * trees * max_samples in all;
* trees grow in parallel, one ``applyInPandas`` group per tree (a group
  holds at most ``max_samples`` rows);
* the forest is a table of nodes (trees * 2^(h+1) rows at most, a fixed
  bound), broadcast once and applied with a vectorised ``mapInArrow``.
Exact equality with other implementations is not a goal (different random
streams); rank agreement is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.operators.stats import exact_quantiles, value_running_counts
from telemetra.session import written

NODE_SCHEMA = ("tree_id int, node_id int, feature int, threshold double, left int, right int, "
               "size int")
#: Rows that walk through all trees at once.
SCORED_AT_ONCE = 256


def baseline_anomaly_result(df: DataFrame, baselines: Mapping[str, tuple[float, float]],
                            threshold: float = 0.7, contributor_z: float = 2.5) -> DataFrame:
    """Fallback scorer -- mean baseline |z| over the sensors present,
    score = min(1, mean z / 5), raw = -mean z, contributors with z > 2.5,
    is_anomaly = score > threshold."""
    zs = [F.when(F.col(s).isNotNull(), F.struct(F.lit(s).alias("sensor"),
                                                F.abs((F.col(s) - m) / sd).alias("z")))
          for s, (m, sd) in baselines.items() if sd > 0]
    arr = F.filter(F.array(*zs), lambda x: x.isNotNull())
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x["z"])
    avg = F.when(F.size(arr) > 0, total / F.size(arr)).otherwise(F.lit(0.0))
    out = df.withColumn("_avgz", avg)
    score = F.least(F.lit(1.0), F.col("_avgz") / 5.0)
    return out.withColumns({
        "anomaly_score": score, "raw_score": -F.col("_avgz"),
        "is_anomaly": score > threshold,
        "contributing_sensors": F.transform(F.filter(arr, lambda x: x["z"] > contributor_z),
                                            lambda x: x["sensor"]),
    }).drop("_avgz")


def contributor_shares(df: DataFrame, list_col: str = "contributing_sensors") -> DataFrame:
    """One row per contributor with share max(0.05, 1/(rank+1))."""
    return df.select("*", F.posexplode(list_col).alias("rank", "contributor")).withColumn(
        "share", F.greatest(F.lit(0.05), 1.0 / (F.col("rank") + 1)))


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


@dataclass
class IForestModel:
    features: list[str]
    means: list[float]
    stds: list[float]
    nodes: pd.DataFrame          # NODE_SCHEMA rows, the whole (bounded) forest
    max_samples: int
    offset: float | None = None  # decision threshold on score_samples

    def arrays(self):
        """Forest as flat arrays over global node ids (tree * width + node).

        A leaf is its own child on both sides, so a walk of ``steps`` steps ends
        in every row's leaf; ``path`` is a leaf's depth plus c(size).
        ``child`` holds a node's right child at 2 * id, its left one after it.
        """
        t = self.nodes
        n_trees = int(t["tree_id"].max()) + 1
        width = int(t["node_id"].max()) + 1
        at = (t["tree_id"].to_numpy() * width + t["node_id"].to_numpy()).astype(np.int64)
        inner = t["feature"].to_numpy() >= 0
        feat = np.zeros(n_trees * width, dtype=np.int32)
        thr = np.zeros(n_trees * width)
        child = np.repeat(np.arange(n_trees * width, dtype=np.int32), 2)
        corr = np.zeros(n_trees * width)
        feat[at[inner]] = t["feature"].to_numpy()[inner]
        thr[at] = t["threshold"].to_numpy()
        first = (t["tree_id"].to_numpy() * width)[inner]
        child[2 * at[inner]] = t["right"].to_numpy()[inner] + first
        child[2 * at[inner] + 1] = t["left"].to_numpy()[inner] + first
        corr[at] = [_c(float(n)) for n in t["size"]]  # path-length correction c(size) of every node
        depth = np.zeros(n_trees * width)
        level, steps = (np.arange(n_trees) * width).astype(np.int32), 0
        while len(level := level[child[2 * level] != level]):
            steps += 1
            level = np.concatenate([child[2 * level], child[2 * level + 1]])
            depth[level] = steps
        return feat, thr, child, depth + corr, n_trees, width, steps


def _mean_paths(x: np.ndarray, forest: tuple) -> np.ndarray:
    """Mean path length over the trees of every row of ``x``."""
    feat, thr, child, path, n_trees, width, steps = forest
    n, n_feat = x.shape
    flat = np.ascontiguousarray(x).ravel()
    base = (np.arange(n, dtype=np.int32) * n_feat)[None, :]
    # all trees at once: g[t, i] is row i's current (global) node in tree t
    g = np.repeat((np.arange(n_trees, dtype=np.int32) * width)[:, None], n, axis=1)
    for _ in range(steps):
        g = child.take(2 * g + (flat.take(base + feat.take(g)) < thr.take(g)))
    return path.take(g).mean(axis=0)


def _grow(pdf: pd.DataFrame, n_feat: int, height: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree_id"].iloc[0])
    X = np.column_stack([pdf[f"f{i}"].to_numpy(dtype=float) for i in range(n_feat)])
    rng = np.random.default_rng([seed, tree])
    rows = []
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        nid, idx, depth = stack.pop()
        sub = X[idx]
        if depth >= height or len(idx) <= 1:
            rows.append((tree, nid, -1, 0.0, -1, -1, len(idx)))
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        can = np.flatnonzero(hi > lo)
        if len(can) == 0:
            rows.append((tree, nid, -1, 0.0, -1, -1, len(idx)))
            continue
        f = int(rng.choice(can))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        lid, rid = next_id, next_id + 1
        next_id += 2
        rows.append((tree, nid, f, thr, lid, rid, len(idx)))
        stack.append((lid, idx[go_left], depth + 1))
        stack.append((rid, idx[~go_left], depth + 1))
    return pd.DataFrame(rows, columns=["tree_id", "node_id", "feature", "threshold", "left",
                                       "right", "size"])


def _standardise(df: DataFrame, features: Sequence[str], means, stds) -> DataFrame:
    cols = []
    for i, (c, m, s) in enumerate(zip(features, means, stds)):
        v = F.coalesce(F.col(c).cast("double"), F.lit(m))        # missing -> training mean
        v = F.when(F.abs(v) == F.lit(float("inf")), F.lit(0.0)).otherwise(v)
        cols.append(((v - F.lit(m)) / F.lit(s if s and s > 0 else 1.0)).alias(f"f{i}"))
    return df.select("*", *cols)


def _draws(n: int, n_trees: int, psi: int) -> list[float]:
    """Chances that a row is drawn for at most 0, 1, ... trees, each with chance 1.3 psi / n."""
    p = min(1.0, 1.3 * psi / max(n, 1))
    if p in (0.0, 1.0):
        return [1.0 - p] * n_trees
    out, total = [], 0.0
    for m in range(n_trees):
        total += math.exp(math.lgamma(n_trees + 1) - math.lgamma(m + 1) - math.lgamma(n_trees - m + 1)
                          + m * math.log(p) + (n_trees - m) * math.log1p(-p))
        out.append(total)
    return out


def _samples(df: DataFrame, features: Sequence[str], key_cols: Sequence[str], n: int, n_trees: int,
             psi: int, seed: int) -> DataFrame:
    """``tree_id`` and the features of up to ``psi`` rows for every tree, without replacement.

    The number of trees of a row is a binomial draw; the trees are steps of a
    random walk through all of them, so they differ.  Rows that agree in keys
    and features are told apart by a copy number.
    """
    rows = df.select(F.xxhash64(F.lit(seed), *key_cols, *features).alias("_key"), *features) \
        .groupBy("_key", *features).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))

    def drawn(use):
        return F.xxhash64("_key", "_copy", F.lit(use))

    limits = _draws(n, n_trees, psi)
    steps = [k for k in range(1, n_trees + 1) if math.gcd(k, n_trees) == 1]
    first = F.pmod(drawn("first"), F.lit(n_trees))
    step = F.element_at(F.array(*[F.lit(k) for k in steps]),
                        (F.pmod(drawn("step"), F.lit(len(steps))) + 1).cast("int"))
    picked = rows.withColumn("_u", F.shiftrightunsigned(drawn("trees"), 11) * F.lit(2.0 ** -53)) \
        .filter(F.col("_u") >= limits[0]) \
        .withColumn("_m", F.size(F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: x <= F.col("_u")))) \
        .withColumn("_first", first).withColumn("_step", step) \
        .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_m") - 1))) \
        .withColumn("tree_id", F.pmod(F.col("_first") + F.col("_j") * F.col("_step"), F.lit(n_trees)).cast("int"))
    w = Window.partitionBy("tree_id").orderBy(F.xxhash64("_key", "_copy", "tree_id"), "_key", "_copy")
    return picked.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= psi).select("tree_id", *features)


def train_iforest(df: DataFrame, features: Sequence[str], n_trees: int = 200,
                  max_samples: int = 256, contamination: float | None = 0.05,
                  seed: int = 42, key_cols: Sequence[str] | None = None) -> IForestModel:
    """M1: fit scaler statistics, deal samples to trees, grow trees in parallel.

    ``key_cols`` identify a row for sampling; by default all columns do.
    """
    features = list(features)
    if key_cols is None:
        key_cols = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    stats = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)],
                   F.count(F.lit(1)).alias("n")).first()
    means = [float(stats[f"m{i}"] or 0.0) for i in range(len(features))]
    stds = [float(stats[f"s{i}"] or 1.0) for i in range(len(features))]
    n = int(stats["n"])
    psi = min(max_samples, n)
    height = max(1, math.ceil(math.log2(max(psi, 2))))
    sample = _standardise(_samples(df, features, key_cols, n, n_trees, psi, seed), features, means, stds)
    nf = len(features)
    nodes = sample.groupBy("tree_id").applyInPandas(
        lambda pdf: _grow(pdf, nf, height, seed), NODE_SCHEMA)
    # the forest has at most n_trees * 2^(height+1) nodes: a fixed bound
    forest = nodes.toPandas()
    model = IForestModel(features, means, stds, forest, psi)
    if contamination is not None:
        # written once: the quantile reads the scores digit by digit
        scored = written(score_iforest(df, model, normalise=None).select("score_samples"), "scores")
        q = exact_quantiles(scored, [], "score_samples", [contamination], few_groups=True).first()
        model.offset = float(q["q"])
    return model


def score_iforest(df: DataFrame, model: IForestModel, normalise: str | None = "train",
                  train_range: tuple[float, float] | None = None) -> DataFrame:
    """M2: add ``score_samples`` (-s, higher = more normal), ``raw_score``
    (decision function = score_samples - offset), ``is_anomaly`` and a 0..1
    ``anomaly_score`` (1 = most anomalous).

    normalise: ``batch`` scales by this batch's raw min/max (the source
    behaviour: one row always gives 1.0); ``train`` uses ``train_range``;
    None leaves it out.
    """
    feats = model.features
    x = _standardise(df, feats, model.means, model.stds)
    # scoring is CPU-bound Python: spread it when the input has fewer splits
    # than cores (small files); large inputs already have many splits
    cores = df.sparkSession.sparkContext.defaultParallelism
    if x.rdd.getNumPartitions() < cores:
        x = x.repartition(cores)
    fcols = [f"f{i}" for i in range(len(feats))]
    sc = df.sparkSession.sparkContext
    bc = sc.broadcast(model.arrays())
    cn = _c(model.max_samples)
    kept = [f for f in x.schema.fields if f.name not in fcols]
    out_schema = T.StructType(kept + [T.StructField("score_samples", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        forest = bc.value
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in fcols])
            # few rows at a time: the nodes of all trees stay in the processor's cache
            paths = [_mean_paths(x[i:i + SCORED_AT_ONCE], forest) for i in range(0, len(x), SCORED_AT_ONCE)]
            path = np.concatenate(paths) if paths else np.zeros(0)
            s = np.power(2.0, -path / cn) if cn > 0 else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(-s)],
                                             names=[f.name for f in out_schema])

    scored = x.mapInArrow(run, out_schema)
    offset = model.offset if model.offset is not None else -0.5
    scored = scored.withColumn("raw_score", F.col("score_samples") - F.lit(offset)) \
        .withColumn("is_anomaly", F.col("raw_score") < 0)
    if normalise is None:
        return scored
    if normalise == "batch":
        mm = scored.agg(F.min("raw_score").alias("lo"), F.max("raw_score").alias("hi")).first()
        lo, hi = float(mm["lo"]), float(mm["hi"])
    else:
        if train_range is None:
            raise ValueError("normalise='train' needs train_range (min, max of training raw scores)")
        lo, hi = train_range
    return scored.withColumn("anomaly_score", 1.0 - (F.col("raw_score") - lo) / (hi - lo + 1e-10))


def score_summary(scored: DataFrame, score_col: str = "anomaly_score",
                  flag_col: str = "is_anomaly") -> DataFrame:
    """M3: total, anomalies, max and mean score."""
    return scored.agg(F.count(F.lit(1)).alias("total_records"),
                      F.count_if(F.col(flag_col)).alias("anomalies_detected"),
                      F.max(score_col).alias("max_anomaly_score"),
                      F.avg(score_col).alias("mean_anomaly_score"))


def evaluate_anomaly(df: DataFrame, label_col: str, flag_col: str, score_col: str) -> DataFrame:
    """M4: anomaly rate, score mean/std (population), precision, recall, F1
    (positive = anomaly) and exact ROC-AUC (tie-aware rank statistic; 0.0
    when only one class is present).

    One pass: rows are reduced per distinct score (counts of positives,
    negatives and the confusion cells), running counts in score order give
    the AUC numerator, and a final aggregate gives every metric.
    """
    y, p = F.col(label_col).cast("int"), F.col(flag_col).cast("int")
    s = F.col(score_col).cast("double")
    cells = df.select(s.alias("s"), y.alias("wp"), (1 - y).alias("wn"), (y * p).alias("tp"),
                      ((1 - y) * p).alias("fp"), (y * (1 - p)).alias("fn"), p.alias("pp"),
                      F.lit(1).alias("c"), (s * s).alias("s2"), s.alias("s1"))
    ranked = value_running_counts(cells, [], "s", ["wn"], ["wp", "tp", "fp", "fn", "pp", "c", "s1", "s2"])
    tot = ranked.agg(
        F.sum("c").alias("n"), F.sum("pp").alias("npred"), F.sum("s1").alias("ss"),
        F.sum("s2").alias("ss2"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
        F.sum("fn").alias("fn"), F.sum("wp").alias("pos"), F.sum("wn").alias("neg"),
        # pairs (positive, negative) with the positive scored higher, ties half
        F.sum(F.col("wp") * (F.col("cum_wn") - F.col("wn")) + 0.5 * F.col("wp") * F.col("wn"))
        .alias("u"))
    n = F.col("n")
    mean = F.col("ss") / n
    var = F.greatest(F.col("ss2") / n - mean * mean, F.lit(0.0))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    auc = F.when((F.col("pos") > 0) & (F.col("neg") > 0),
                 F.col("u") / (F.col("pos") * F.col("neg"))).otherwise(0.0)
    return tot.select((F.col("npred") / n).alias("anomaly_rate"), mean.alias("mean_score"),
                      F.sqrt(var).alias("std_score"), prec.alias("precision"),
                      rec.alias("recall"), f1.alias("f1_score"), auc.alias("auc_roc"))

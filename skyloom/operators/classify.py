"""Training sets, classifiers and class rasters."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, NaiveBayes, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands as B
from ..shipping import in_arrow, ship

LAND_COVERS = ("clouds", "desert", "water", "vegetation")


def balance(rows: DataFrame, order: Column, limit: int = 5000, cls: str = "class", first_class_only: bool = False) -> DataFrame:
    """The first n rows of each class by `order` (a random number or a hash), n being the least
    of the limit and the smallest class, or the first class with `first_class_only`."""
    sizes = rows.groupBy(cls).agg(F.count(F.lit(1)).alias("n"))
    one = sizes.agg(F.least(F.lit(limit), F.min_by("n", cls) if first_class_only else F.min("n")).alias("_n"))
    w = Window.partitionBy(cls).orderBy(order)
    ranked = rows.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= limit)  # a literal bound prunes before the shuffle
    return ranked.withColumn("_k", F.lit(1)).join(F.broadcast(one.withColumn("_k", F.lit(1))), "_k").where(F.col("_i") <= F.col("_n")).drop("_i", "_n", "_k")


def missing_bands(scenes: DataFrame, wanted: list[str]) -> DataFrame:
    w = F.array(*map(F.lit, wanted))
    return scenes.select("scene_id", F.array_intersect("bands", w).alias("present"), F.array_except(w, F.col("bands")).alias("missing"))


def features(rows: DataFrame, column: str = "features", ratios: bool = False) -> DataFrame:
    """A vector column for the library's classifiers, of values or of their pairwise ratios."""
    v = F.transform(B.ratios(F.col(column)), lambda x: F.coalesce(x, F.lit(0.0))) if ratios else F.col(column)
    return rows.withColumn("_vector", array_to_vector(v))


class Fitted:
    """A library model and the classes that its labels 0, 1, ... stand for."""

    def __init__(self, model, classes: list[int]):
        self.model, self.classes = model, classes


def fit(training: DataFrame, kind: str = "tree", label: str = "class", ratios: bool = False, max_classes: int = 64):
    """A model on the training set: "bayes", "tree", "linear_svm" or "rbf_svm"."""
    if kind == "rbf_svm":
        return RbfSvm.fit(training, label)
    classes = sorted(r[0] for r in training.select(label).where(F.col(label).isNotNull()).distinct().limit(max_classes + 1).collect())
    if not 1 <= len(classes) <= max_classes:
        raise ValueError(f"between 1 and {max_classes} classes")
    number = F.array_position(F.array(*map(F.lit, classes)), F.col(label)) - 1
    rows = features(training.where(F.col(label).isNotNull()), ratios=ratios).withColumn("_label", number.cast("double"))
    common = {"featuresCol": "_vector", "labelCol": "_label"}
    if kind == "bayes":
        model = NaiveBayes(modelType="gaussian", **common)
    elif kind == "tree":
        model = DecisionTreeClassifier(maxDepth=10, **common)
    elif kind == "linear_svm":
        model = OneVsRest(classifier=LinearSVC(regParam=1e-3, maxIter=50, **common), **common)
    else:
        raise ValueError(f"classifier {kind!r}")
    return Fitted(model.fit(rows), classes)


def predict(pixels: DataFrame, model, column: str = "features", ratios: bool = False) -> DataFrame:
    """Adds `class`."""
    if isinstance(model, RbfSvm):
        return pixels.withColumn("class", model.predict(F.col(column)))
    out = model.model.transform(features(pixels, column, ratios))
    found = F.get(F.array(*map(F.lit, model.classes)), F.col("prediction").cast("int")).cast("int")
    return out.withColumn("class", found).select(*pixels.columns, "class")


# ---- Gaussian naive Bayes in closed form -----------------------------------------------------------


def bayes_table(training: DataFrame, n_features: int, label: str = "class", smoothing: float = 1e-9, sample: bool = False) -> DataFrame:
    """(class, prior, means, variances): one row for each class.  With `sample` variances are those of
    samples, divided by one less."""
    spread = F.var_samp if sample else F.var_pop
    each = [x for i in range(n_features) for x in (F.avg(F.col("features")[i]).alias(f"m{i}"), spread(F.col("features")[i]).alias(f"v{i}"))]
    sums = training.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *each)
    total = training.agg(F.count(F.lit(1)).alias("_t")).withColumn("_k", F.lit(1))
    joined = sums.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")
    arr = lambda p: F.array(*(F.col(f"{p}{i}") for i in range(n_features)))
    return joined.select(label, (F.col("n") / F.col("_t")).alias("prior"), arr("m").alias("means"), F.transform(arr("v"), lambda v: v + smoothing).alias("variances"))


def bayes_scores(rows: DataFrame, table: DataFrame, label: str = "class", max_classes: int = 64) -> DataFrame:
    """Adds `class`, the likeliest.  The table is a bounded list of classes and becomes literals."""
    model = table.limit(max_classes + 1).collect()
    if len(model) > max_classes:
        raise ValueError(f"more than {max_classes} classes")

    def score(m) -> Column:
        total = F.lit(math.log(m["prior"]))
        for i, (mu, var) in enumerate(zip(m["means"], m["variances"], strict=True)):
            d = F.col("features")[i] - mu
            total = total - (math.log(2 * math.pi * var) + d * d / var) / 2
        return F.struct(total.alias("score"), F.lit(-m[label]).alias("minus"))  # ties to the smaller class

    best = F.array_max(F.array(*map(score, model)))
    return rows.withColumn("class", -best["minus"])


def bayes_posteriors(rows: DataFrame, table: DataFrame, label: str = "class", max_classes: int = 64) -> DataFrame:
    """Adds `posteriors`, the classes' probabilities in order of class, and `rounded`: their sum, each
    rounded (halves to even) and times its class's number from 1; 0 where none is above one half.

    Densities are compared in logarithms, less the largest, so that no probability is lost to
    numbers too small to hold."""
    model = table.orderBy(label).limit(max_classes + 1).collect()
    if len(model) > max_classes:
        raise ValueError(f"more than {max_classes} classes")

    def score(m) -> Column:
        total = F.lit(math.log(m["prior"]))
        for i, (mu, var) in enumerate(zip(m["means"], m["variances"], strict=True)):
            d = F.col("features")[i] - mu
            total = total - (math.log(2 * math.pi * var) + d * d / var) / 2
        return total

    scored = rows.withColumn("_s", F.array(*map(score, model)))
    parts = F.transform("_s", lambda s: F.exp(s - F.array_max("_s")))
    scored = scored.withColumn("_e", parts).withColumn("_t", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x))
    scored = scored.withColumn("posteriors", F.transform("_e", lambda e: e / F.col("_t")))
    number = F.aggregate(F.transform("posteriors", lambda p, i: F.rint(p) * (i + 1)), F.lit(0.0), lambda a, x: a + x).cast("int")
    return scored.withColumn("rounded", number).drop("_s", "_e", "_t")


# ---- linear machines, one class against one -----------------------------------------------------------


@dataclass(frozen=True)
class PairMachines:
    """Planes between classes: for each pair (a, b) weights and a bias, positive on a's side."""

    classes: tuple[int, ...]
    planes: tuple[tuple[int, int, tuple[float, ...], float], ...]


def fit_pairs(training: DataFrame, label: str = "class", cost: float = 1000.0, tolerance: float = 1e-9, most: int = 60) -> PairMachines:
    """A linear machine for each pair of classes: least |w|^2 / 2 + cost x the mean square of what rows lack to
    a margin of 1.  Features are put to mean 0 and deviation 1 first.

    Newton's method: a pass over the rows gives, for all pairs at once, the sums of products of those
    rows within their margin, (d + 1)^2 numbers a pair, which name the next planes; it ends when
    these stay the same."""
    rows = training.select(F.col("features").cast("array<double>").alias("x"), F.col(label).cast("int").alias("y")).where("y IS NOT NULL")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # every step goes over them
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).orderBy("y").collect()}
    classes, d = tuple(sizes), rows.agg(F.max(F.size("x"))).first()[0] or 0
    at = [F.col("x")[i] for i in range(d)]
    moments = rows.agg(*(F.avg(c) for c in at), *(F.stddev_pop(c) for c in at)).first() if d else []
    centre, scale = np.array(moments[:d], float), np.array(moments[d:], float)
    scale = np.where(scale > 0, scale, 1.0)
    pairs = [(a, b) for i, a in enumerate(classes) for b in classes[i + 1 :]]
    planes = np.zeros((len(pairs), d + 1))
    for _ in range(most):

        def sums(batches, planes=planes):
            h, g = np.zeros((len(pairs), d + 1, d + 1)), np.zeros((len(pairs), d + 1))
            for b in batches:
                x = (np.array(b.column(0).flatten()).reshape(len(b), -1) - centre) / scale
                x, y = np.c_[x, np.ones(len(x))], np.array(b.column(1))
                for k, (one, other) in enumerate(pairs):
                    side = np.where(y == one, 1.0, np.where(y == other, -1.0, 0.0))
                    on = (side != 0) & (side * (x @ planes[k]) < 1)
                    h[k] += x[on].T @ x[on]
                    g[k] += side[on] @ x[on]
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(pairs)), pa.int32()), "s": pa.array([[*h[k].ravel(), *g[k]] for k in range(len(pairs))], pa.list_(pa.float64()))})

        found = in_arrow(rows.select("x", "y"), sums, "k int, s array<double>")
        total = found.groupBy("k").agg(*(F.sum(F.col("s")[i]).alias(f"s{i}") for i in range((d + 1) * (d + 2)))).orderBy("k").collect()
        new = planes.copy()
        for r in total:  # a row for each pair
            s, n = np.array(r[1:]), sum(sizes[c] for c in pairs[r["k"]])
            h, g = s[: (d + 1) ** 2].reshape(d + 1, d + 1), s[(d + 1) ** 2 :]
            ridge = np.diag([1.0] * d + [1e-12])  # the bias is free
            new[r["k"]] = np.linalg.lstsq(ridge + 2 * cost / n * h, 2 * cost / n * g, rcond=None)[0]
        moved = np.abs(new - planes).max(initial=0)
        planes = new
        if moved <= tolerance * max(1.0, np.abs(planes).max(initial=0)):
            break
    else:
        rows.unpersist()
        raise ArithmeticError(f"planes still move after {most} steps")
    rows.unpersist()
    flat = []
    for (a, b), w in zip(pairs, planes, strict=True):
        own = w[:d] / scale
        flat.append((a, b, tuple(map(float, own)), float(w[d] - own @ centre)))
    return PairMachines(classes, tuple(flat))


def vote(rows: DataFrame, machines: PairMachines, column: str = "features") -> DataFrame:
    """Adds `class`: the one that wins most of its pairs (ties to the smallest), by SQL functions.  A place
    on a plane is won by the pair's second class."""
    wins = []
    for a, b, w, bias in machines.planes:
        score = F.lit(bias)
        for i, v in enumerate(w):
            score = score + F.col(column)[i] * v
        wins.append(F.when(score > 0, a).otherwise(b))
    count = lambda c: sum((w == c).cast("int") for w in wins) if wins else F.lit(0)
    best = F.array_max(F.array(*(F.struct(count(c).alias("n"), F.lit(-c).alias("minus")) for c in machines.classes)))
    return rows.withColumn("class", -best["minus"])


# ---- RBF support vectors ----------------------------------------------------------------------------


class RbfSvm:
    """One-against-one RBF machines, trained by sequential minimal optimisation on a balanced
    training set of at most `limit` rows, a pair of classes in a task, and scored in vectorised batches."""

    def __init__(self, machines: list, gamma: float, centre: np.ndarray, scale: np.ndarray):
        self.gamma, self.centre, self.scale = gamma, centre, scale
        # a row that several machines lean on is held, and compared, once
        self.vectors, at = np.unique(np.concatenate([m[2] for m in machines]), axis=0, return_inverse=True) if machines else (np.zeros((0, len(centre))), np.zeros(0, int))
        self.coefs, ends = np.zeros((len(self.vectors), len(machines))), np.cumsum([0, *(len(m[2]) for m in machines)])
        for k, m in enumerate(machines):
            np.add.at(self.coefs[:, k], at.ravel()[ends[k] : ends[k + 1]], m[3])
        self.planes = [(m[0], m[1], m[4]) for m in machines]

    @classmethod
    def fit(cls, training: DataFrame, label: str = "class", cost: float = 10000.0, gamma: float = 0.001, limit: int = 20000) -> RbfSvm:
        """Each pair of classes is a task of its own: its rows meet there, and its support vectors, part of
        the bounded training set, come back."""
        rows = training.select(F.col("features").cast("array<double>").alias("x"), F.col(label).cast("int").alias("y"))
        seen = rows.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.sort_array(F.collect_set("y")).alias("classes")).first()
        if seen["n"] > limit:
            raise ValueError(f"more than {limit} training rows; balance them first")
        at = [F.col("x")[i] for i in range(seen["d"])]
        moments = rows.agg(*(F.avg(c) for c in at), *(F.stddev_pop(c) for c in at)).first()
        centre, scale = np.array(moments[: seen["d"]]), np.array(moments[seen["d"] :])
        scale = np.where(scale > 0, scale, 1.0)
        pairs = [(a, b) for i, a in enumerate(seen["classes"]) for b in seen["classes"][i + 1 :]]
        both = F.filter(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs)), lambda p: (p["a"] == F.col("y")) | (p["b"] == F.col("y")))

        def machine(table: pa.Table) -> pa.Table:
            a, b = (table.column(c)[0].as_py() for c in ("a", "b"))
            # in a fixed order, so that a task run again finds the same machine
            x = (np.array(table.column("x").combine_chunks().flatten()).reshape(len(table), -1) - centre) / scale
            y = np.where(np.array(table.column("y")) == a, 1.0, -1.0)
            order = np.lexsort((*x.T, y))
            sv, coef, bias = _smo(x[order], y[order], cost, gamma)
            vectors = pa.ListArray.from_arrays(np.arange(0, sv.size + 1, x.shape[1], dtype=np.int32), pa.array(sv.ravel()))
            n = len(sv)
            return pa.table({"a": pa.array([a] * n, pa.int32()), "b": pa.array([b] * n, pa.int32()), "bias": pa.array([bias] * n), "coef": pa.array(coef), "sv": vectors})

        ship(training.sparkSession)
        dealt = rows.withColumn("p", F.explode(both)).select("p.a", "p.b", "x", "y")
        dealt = dealt.repartition(4 * max(len(pairs), 1), "a", "b")  # a fixed number, or small pairs would share a task
        found = dealt.groupBy("a", "b").applyInArrow(machine, "a int, b int, bias double, coef double, sv array<double>").toArrow().to_pandas()
        machines = [(int(a), int(b), np.stack(g["sv"]), g["coef"].to_numpy(), float(g["bias"].iloc[0])) for (a, b), g in found.groupby(["a", "b"])]
        return cls(machines, gamma, centre, scale)

    def classes_of(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.centre) / self.scale
        names = sorted({p[0] for p in self.planes} | {p[1] for p in self.planes})
        votes = np.zeros((len(x), len(names)), int)
        scores = _scores(x, self.vectors, self.coefs, self.gamma)
        for k, (a, b, bias) in enumerate(self.planes):
            side = scores[:, k] + bias > 0
            votes[:, names.index(a)] += side
            votes[:, names.index(b)] += ~side
        return np.array(names)[votes.argmax(1)]

    def predict(self, column: Column) -> Column:
        ship()

        @F.pandas_udf("int")
        def run(v: pd.Series) -> pd.Series:
            return pd.Series(self.classes_of(np.array(v.tolist(), float)).astype(int)) if len(v) else pd.Series([], dtype=int)

        return run(column)


def _rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(d, 0))


#: Rows of a kernel that are held at once.
ROWS = 1024

#: Rows from which a machine starts at an interior point, the most columns of its factor, and what these leave of the kernel.
LARGE, RANK, REST = 2000, 2500, 1e-10


def _scores(a: np.ndarray, b: np.ndarray, coef: np.ndarray, gamma: float) -> np.ndarray:
    """Kernel times coefficients, in blocks of bounded size."""
    return np.concatenate([_rbf(a[i : i + ROWS], b, gamma) @ coef for i in range(0, len(a), ROWS)]) if len(a) else np.zeros((0, *coef.shape[1:]))


def _factor(x: np.ndarray, gamma: float) -> np.ndarray | None:
    """F with F F' equal to the kernel but for REST, by pivoted Cholesky; None where that takes over RANK columns."""
    n = len(x)
    f, left = np.empty((min(RANK, n), n)), np.ones(n)
    for k in range(len(f)):
        p = int(left.argmax())
        if left[p] < REST:
            return f[:k].T
        f[k] = (_rbf(x[p : p + 1], x, gamma)[0] - f[:k, p] @ f[:k]) / math.sqrt(left[p])
        left = np.maximum(left - f[k] ** 2, 0)
        left[p] = 0
    return f.T if left.max() < REST else None


def _interior(x: np.ndarray, y: np.ndarray, cost: float, gamma: float, steps: int = 100) -> np.ndarray | None:
    """Multipliers near the optimum, by a primal-dual interior point method (Mehrotra's) on the kernel's factor:
    a step costs rows x columns^2, whatever the cost.  None where the kernel has no small factor."""
    f = _factor(x, gamma)
    if f is None or not 0 < (y > 0).sum() < len(y):
        return None
    n, f = len(x), (f - f.mean(0)) * y[:, None]  # multipliers are balanced, so a kernel's constant part is free
    a, s, t, beta = np.full(n, cost / 2), np.ones(n), np.ones(n), 0.0
    best, kept = np.inf, a
    for _ in range(steps):
        b = cost - a
        rd, rp, mu = 1 - f @ (f.T @ a) - beta * y + s - t, -(y @ a), (a @ s + b @ t) / (2 * n)
        off = np.abs(rd).max() + abs(rp) / cost + mu
        if off < best:
            best, kept = off, np.where(a < b, np.where(s > a, 0.0, a), np.where(t > b, cost, a))
        if off < 1e-7 or not np.isfinite(off):
            break
        d = 1 / (s / a + t / b)
        try:
            root = np.linalg.cholesky(np.eye(f.shape[1]) + f.T @ (f * d[:, None]))
        except np.linalg.LinAlgError:
            break
        inverse = lambda v: np.linalg.solve(root.T, np.linalg.solve(root, v))  # noqa: B023, E731
        solve = lambda v: d * v - d * (f @ inverse(f.T @ (d * v)))  # noqa: B023, E731
        uy = solve(y)

        def direction(rs, rt):
            uh = solve(rd + rs / a - rt / b)  # noqa: B023
            db = (y @ uh - rp) / (y @ uy)  # noqa: B023
            da = uh - db * uy  # noqa: B023
            return da, (rs - s * da) / a, (rt + t * da) / b, db  # noqa: B023

        def reach(da, ds, dt):
            worst = max((-da / a).max(), (da / b).max(), (-ds / s).max(), (-dt / t).max(), 1e-12)  # noqa: B023
            return min(1.0, 0.995 / worst)

        da, ds, dt, _ = direction(-a * s, -b * t)
        h = reach(da, ds, dt)
        ahead = ((a + h * da) @ (s + h * ds) + (b - h * da) @ (t + h * dt)) / (2 * n)
        aim = mu * (ahead / mu) ** 3
        da, ds, dt, db = direction(aim - a * s - da * ds, aim - b * t + da * dt)
        h = reach(da, ds, dt)
        a, s, t, beta = a + h * da, s + h * ds, t + h * dt, beta + h * db
    free = (kept > 0) & (kept < cost)
    for _ in range(20):  # back to balance
        rest = y @ kept
        if rest == 0 or not free.any():
            break
        kept[free] = np.clip(kept[free] - y[free] * rest / free.sum(), 0, cost)
        free &= (kept > 0) & (kept < cost)
    return kept if abs(y @ kept) < 1e-6 * cost else None


def _smo(x: np.ndarray, y: np.ndarray, cost: float, gamma: float, tolerance: float = 1e-3, most: int = 5_000_000):
    """Support vectors, coefficients and bias: the greatest violation is paired with the row that gains
    the most, until no pair violates the conditions by more than the tolerance; an error if that
    takes too long.  Many rows start from `_interior`, so few steps are left; when it ends is up to the
    kernel itself in either case."""
    n = len(x)
    k = _rbf(x, x, gamma) if n <= 6000 else None
    column = (lambda i: k[i]) if k is not None else (lambda i: _rbf(x[i : i + 1], x, gamma)[0])
    alpha, g = np.zeros(n), -np.ones(n)
    near = _interior(x, y, cost, gamma) if n > LARGE else None
    if near is not None:
        alpha, g = near, y * _scores(x, x, near * y, gamma) - 1
    for _ in range(most):
        up = ((alpha < cost) & (y > 0)) | ((alpha > 0) & (y < 0))
        low = ((alpha < cost) & (y < 0)) | ((alpha > 0) & (y > 0))
        f = -y * g
        i = int(np.where(up, f, -np.inf).argmax())
        if f[i] - np.min(f[low], initial=np.inf) < tolerance:
            break
        ki = column(i)
        gap = f[i] - f
        j = int(np.where(low & (gap > 0), gap * gap / np.maximum(2 - 2 * ki, 1e-12), -np.inf).argmax())
        kj = column(j)
        eta = max(2 - 2 * ki[j], 1e-12)
        step = (f[i] - f[j]) / eta
        top_i = cost - alpha[i] if y[i] > 0 else alpha[i]
        top_j = alpha[j] if y[j] > 0 else cost - alpha[j]
        step = min(step, top_i, top_j)
        alpha[i] += y[i] * step
        alpha[j] -= y[j] * step
        g += y * step * (ki - kj)
    else:
        raise ArithmeticError(f"not converged after {most} steps")
    up = ((alpha < cost) & (y > 0)) | ((alpha > 0) & (y < 0))
    low = ((alpha < cost) & (y < 0)) | ((alpha > 0) & (y > 0))
    f = -y * g
    bias = (np.max(f[up], initial=-np.inf) + np.min(f[low], initial=np.inf)) / 2
    on = alpha > 0
    return x[on], (alpha * y)[on], float(bias) if np.isfinite(bias) else 0.0


# ---- class rasters ------------------------------------------------------------------------------------


def flood_band(cls: Column) -> Column:
    return B.class_intensity(cls)


def predicted_rank(rows: DataFrame, cls: str = "class", group: list[str] | None = None, literals: int = 256) -> DataFrame:
    """Adds `rank` (from 1): the class's place among the classes that were predicted.  Distinct
    classes are few, so they are ranked apart, and the pixels aren't sorted: up to `literals` of them
    are looked up in place, more are joined."""
    if group:
        seen = rows.select(*group, cls).distinct()
        ranked = seen.withColumn("rank", F.dense_rank().over(Window.partitionBy(*group).orderBy(cls)))
        return rows.join(ranked, [*group, cls])
    distinct = rows.select(cls).distinct()
    seen = [r[0] for r in distinct.limit(literals + 1).collect()]
    if len(seen) > literals:
        ranked = distinct.where(F.col(cls).isNotNull()).withColumn("rank", F.dense_rank().over(Window.orderBy(cls)))
        return rows.join(ranked, cls, "left").select(*rows.columns, "rank")
    number = F.array_position(F.array(*map(F.lit, sorted(seen))), F.col(cls)) if seen else F.lit(0)
    return rows.withColumn("rank", number.cast("int"))


def raster_three(rows: DataFrame, fixed_channels: bool = False) -> DataFrame:
    """clouds, land and water: 1 / class times the channel's number in the class's channel; a
    fourth class goes with land.  Channels are ranks among predicted classes, or with
    `fixed_channels` the classes themselves."""
    r = rows.withColumn("rank", F.col("class")) if fixed_channels else predicted_rank(rows)
    on = lambda *ranks: F.col("rank").isin(*ranks)
    value = B.class_intensity(F.col("class"))
    return r.select(
        *rows.columns,
        F.when(on(1), value * 1.0).otherwise(0.0).alias("clouds"),
        F.when(on(2, 4), value * 2.0).otherwise(0.0).alias("land"),
        F.when(on(3), value * 3.0).otherwise(0.0).alias("water"),
    )


def raster_four(rows: DataFrame, fixed_channels: bool = False) -> DataFrame:
    """cloud, land, water and forest: 1 in the class's channel, else 0."""
    r = rows.withColumn("rank", F.col("class")) if fixed_channels else predicted_rank(rows)
    names = ("cloud", "land", "water", "forest")
    return r.select(*rows.columns, *((F.col("rank") == i + 1).cast("int").alias(n) for i, n in enumerate(names)))


def training_rows(pixels: DataFrame, bands: list[int], cls: str = "class") -> DataFrame:
    """(features, class) of calibrated hyperspectral pixels: synthesised and masked."""
    made = B.synthesise(F.col("v"), bands)
    rows = pixels.select(F.array(*made.values()).alias("features"), F.col(cls).alias("class"))
    return rows.where(B.mask_truthy(F.col("features")))

"""Linear models of all folds fitted side by side: one pass over the rows is a step of every fold's model.

A fit by `pyspark.ml` runs a job for each step of each fold, which costs more than the step itself. Here the terms of the rows
are counted once into blocks of numpy arrays that stay persisted (memory, then disk); a pass sends every fold's coefficients out and
adds up every fold's loss and gradient. Weights of terms, scales and the objective are those of `models.term_stages`,
`LogisticRegression` and `LinearSVC`; the steps are L-BFGS with a weak Wolfe search. No task holds more than a block at a time.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Generator, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.session import materialise

PARTS = ("words", "chars")
BLOCK = 2048  # rows of a block at most
PAIRS, LOOK_BACK = 10, 10  # of steps that L-BFGS remembers; values among which the loss has to fall
FLUSH = 500_000  # counts of terms that a task holds


def _numbers_ready(d: DataFrame, numbers: Sequence[str], folds: Sequence[int]) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """The rows with numbers as doubles, gaps null, and for each fold the median, mean and deviation over the other folds' rows."""
    shape = (len(folds), len(numbers))
    if not numbers:
        return d, np.zeros(shape), np.zeros(shape), np.ones(shape)
    d = d.withColumns({c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numbers})
    at = [(f, c) for f in folds for c in numbers]
    row = d.agg(*(F.percentile_approx(F.when(F.col("fold") != f, F.col(c)), 0.5, 10_000).alias(f"m{i}") for i, (f, c) in enumerate(at))).first()
    median = np.array([x if x is not None else 0.0 for x in row])
    full = [F.when(F.col("fold") != f, F.coalesce(F.col(c), F.lit(float(median[i])))) for i, (f, c) in enumerate(at)]
    row = d.agg(*(F.avg(x) for x in full), *(F.stddev_samp(x) for x in full)).first()
    x = np.array([v or 0.0 for v in row]).reshape(2, *shape)
    return d, median.reshape(shape), x[0], x[1]


def _term_counts(folds: Sequence[int]):
    """(part, term, fold, n, rows): occurrences of terms, and rows with them, within a task."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int, str], list[int]] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame([(*k, *v) for k, v in held.items()], columns=["part", "fold", "term", "n", "n_rows"])

        for b in batches:
            for p, c in enumerate(PARTS):
                for f, rows in b.groupby("fold")[c]:
                    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
                    code, terms = pd.factorize(np.concatenate([*rows, np.zeros(0, object)]))
                    n = np.bincount(code, minlength=len(terms))
                    with_it = np.bincount(np.unique(row * max(len(terms), 1) + code) % max(len(terms), 1), minlength=len(terms))
                    for t, i, j in zip(terms, n.tolist(), with_it.tolist(), strict=True):
                        got = held.setdefault((p, int(f), t), [0, 0])
                        got[0] += i
                        got[1] += j
            if len(held) > FLUSH:
                yield out()
                held.clear()
        if held:
            yield out()

    return count


def _vocabularies(d: DataFrame, folds: Sequence[int], size: int, min_df: int) -> tuple[list[dict[str, int]], list[np.ndarray]]:
    """For each part the terms of any fold's vocabulary and their places, and (fold, place) whether the fold's own has it.

    A fold's vocabulary is the `size` most frequent terms of the other folds' rows among those of min_df rows, ties by term.
    """
    counts = d.select("fold", *PARTS).mapInPandas(_term_counts(folds), "part int, fold int, term string, n bigint, n_rows bigint").groupBy("part", "term")
    sums = [F.sum(F.when(F.col("fold") != f, F.col(c))).alias(f"{c}{i}") for i, f in enumerate(folds) for c in ("n", "n_rows")]
    counts = materialise(counts.agg(*sums), "terms")
    places, own = [], []
    for p in range(len(PARTS)):
        lists = [[r.term for r in counts.where((F.col("part") == p) & (F.col(f"n_rows{i}") >= min_df)).orderBy(F.desc(f"n{i}"), "term").limit(size).select("term").collect()] for i in range(len(folds))]
        place = {t: j for j, t in enumerate(sorted(set().union(*lists)))}
        mine = np.zeros((len(folds), len(place)), bool)
        for i, terms in enumerate(lists):
            mine[i, [place[t] for t in terms]] = True
        places.append(place)
        own.append(mine)
    return places, own


def _blocks(key: str, label: str, numbers: Sequence[str], first: int, places=None):
    """Rows of one fold at a time as pickled arrays; `first` is the number of places of the first part."""

    def part(b: pd.DataFrame, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, count) by row."""
        if places is None:
            idx, tf = b[f"{PARTS[p]}_i"].tolist(), b[f"{PARTS[p]}_n"].tolist()
            row = np.repeat(np.arange(len(b)), [len(x) for x in idx])
            return row, np.concatenate(idx).astype(np.int64), np.concatenate(tf)
        terms = b[PARTS[p]].tolist()
        row = np.repeat(np.arange(len(b)), [len(x) for x in terms])
        code, names = pd.factorize(np.concatenate([*terms, np.zeros(0, object)]))
        at = np.array([places.value[p].get(t, -1) for t in names], np.int64)[code] if len(names) else np.zeros(0, np.int64)
        row, at = row[at >= 0], at[at >= 0]
        m = max(len(places.value[p]), 1)
        pair, n = np.unique(row * m + at, return_counts=True)
        return pair // m, pair % m, n

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for f, rows in batch.groupby("fold"):
                for at in range(0, len(rows), BLOCK):
                    b = rows.iloc[at : at + BLOCK]
                    (r0, i0, n0), (r1, i1, n1) = part(b, 0), part(b, 1)
                    seg = np.concatenate([2 * r0, 2 * r1 + 1])
                    order = np.argsort(seg, kind="stable")
                    block = {
                        "fold": int(f), "y": b[label].to_numpy(np.float64), "key": b[key].to_numpy(), "x": b[list(numbers)].to_numpy(np.float64, na_value=np.nan) if numbers else np.zeros((len(b), 0)),
                        "idx": np.concatenate([i0, i1 + first])[order].astype(np.int32), "tf": np.concatenate([n0, n1])[order].astype(np.float32), "n": np.bincount(seg, minlength=2 * len(b)),
                    }
                    yield pd.DataFrame({"block": [pickle.dumps(block)]})

    return pack


def _sums(v: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0.0], np.cumsum(v)))[ends]
    return np.diff(c, prepend=0.0)


class _Rows:
    """A block as one fold's model sees it: z = sum of tf * u[term] / length of its part + numbers @ v + b."""

    def __init__(self, block: dict, setup: dict, f: int):
        self.b, self.ends = block, np.cumsum(block["n"])
        lengths = block.get("lengths")
        self.inv = lengths[f] if lengths is not None else self.scale(setup["idf"][f])
        x = block["x"]
        dev = setup["dev"][f]
        self.x = np.where(dev > 0, (np.where(np.isnan(x), setup["median"][f], x) - setup["mean"][f]) / np.where(dev > 0, dev, 1), 0.0)
        self.y = block["y"]
        self.w = np.where(self.y == 1, *setup["weight"][f][::-1])

    def scale(self, idf: np.ndarray) -> np.ndarray:
        square = np.sqrt(_sums((self.b["tf"] * idf[self.b["idx"]]) ** 2, self.ends))
        return np.where(square > 1e-12, 1 / np.where(square > 1e-12, square, 1), 0.0)

    def margins(self, u: np.ndarray, v: np.ndarray, b: float) -> np.ndarray:
        return (_sums(self.b["tf"] * u[self.b["idx"]], self.ends) * self.inv).reshape(-1, 2).sum(1) + self.x @ v + b

    def gradient(self, g: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, float]:
        t = np.bincount(self.b["idx"], self.b["tf"] * np.repeat(np.repeat(g, 2) * self.inv, self.b["n"]), minlength=size)
        return t, g @ self.x, g.sum()


def _hinge(y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = 2 * y - 1
    m = 1 - s * z
    return np.maximum(m, 0), np.where(m > 0, -s, 0.0)


def _log_loss(y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.logaddexp(0, z) - y * z, 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y


LOSSES: dict[str, Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]] = {"hinge": _hinge, "log": _log_loss}


def minimise(x: np.ndarray, iterations: int, tolerance: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS as a generator: yields points, takes (value, gradient), returns the best point. It ends where the value has fallen by less
    than the tolerance times its first over LOOK_BACK steps, or the gradient vanishes."""
    f, g = yield x
    values, s, y = [f], [], []
    for _ in range(iterations):
        if np.linalg.norm(g) <= max(tolerance * abs(f), 1e-8):
            break
        q, alphas = g.copy(), []
        for a, b in zip(s[::-1], y[::-1], strict=True):
            alphas.append(a @ q / (a @ b))
            q -= alphas[-1] * b
        q *= s[-1] @ y[-1] / (y[-1] @ y[-1]) if s else 1 / max(np.linalg.norm(g), 1)
        for (a, b), alpha in zip(zip(s, y, strict=True), alphas[::-1], strict=True):
            q += a * (alpha - b @ q / (a @ b))
        slope = -(g @ q)
        low, high, t, found = 0.0, np.inf, 1.0, None
        for _ in range(25):  # weak Wolfe by bisection, which also ends at kinks
            to = x - t * q
            f1, g1 = yield to
            if f1 > f + 1e-4 * t * slope:
                high = t
            else:
                found = to, f1, g1
                if -(g1 @ q) >= 0.9 * slope:
                    break
                low = t
            t = (low + high) / 2 if np.isfinite(high) else 2 * t
        if found is None:
            if not s:
                break
            s, y = [], []  # once more along the gradient
            continue
        a, b = found[0] - x, found[2] - g
        x, f, g = found
        if a @ b > 1e-12 * (b @ b):
            s, y = [*s, a][-PAIRS:], [*y, b][-PAIRS:]
        values.append(f)
        if len(values) > LOOK_BACK and values[-1 - LOOK_BACK] - f <= tolerance * values[0]:
            break
    return x


def fit_and_score(d: DataFrame, key: str, label: str, loss: str, penalty: float | Callable[[np.ndarray], np.ndarray], scaled: bool, iterations: int, tolerance: float, numbers: Sequence[str] = (), vocabulary: int | None = None, size: int = 1 << 14, min_df: int = 2) -> DataFrame:
    """(key, y, fold, margin): each row's margin by the model of the rows of all other folds.

    d has fold and the term arrays `words` and `chars`. A model minimises mean(weight * loss) + penalty / 2 * |coefficients|^2 with classes
    weighted alike; a penalty may depend on the summed weight; `scaled` measures the coefficients in deviations of their features. Terms are hashed to `size` places a part, or those of a vocabulary. A model whose
    rows are all of one label gives them infinite margins.
    """
    sc = d.sparkSession.sparkContext
    tally = {(r[0], r[1]): r[2] for r in d.groupBy("fold", label).count().collect()}
    folds = sorted({f for f, _ in tally})
    k = len(folds)
    by_class = np.array([[sum(n for (g, y), n in tally.items() if g != f and y == c) for c in (0, 1)] for f in folds], float)
    total = by_class.sum(1)
    weight = np.where(by_class > 0, total[:, None] / ((by_class > 0).sum(1)[:, None] * np.maximum(by_class, 1)), 0.0)
    d, median, mean, dev = _numbers_ready(d, numbers, folds)
    if vocabulary:
        places, own = _vocabularies(d, folds, vocabulary, min_df)
        first, width = len(places[0]), len(places[0]) + len(places[1])
        source, sent = d.select(key, label, "fold", *numbers, *PARTS), sc.broadcast(places)
        mine = np.concatenate(own, 1)
    else:
        source, sent, first, width = d, None, size, 2 * size
        for c in PARTS:
            source = HashingTF(inputCol=c, outputCol=f"{c}_tf", numFeatures=size).transform(source).withColumn(f"{c}_u", F.unwrap_udt(f"{c}_tf"))
        source = source.select(key, label, "fold", *numbers, *(F.col(f"{c}_u.indices").alias(f"{c}_i") for c in PARTS), *(F.col(f"{c}_u.values").alias(f"{c}_n") for c in PARTS))
        mine = np.ones((k, width), bool)
    blocks = materialise(source.mapInPandas(_blocks(key, label, numbers, first, sent), "block binary"), "blocks")
    tasks = max(1, min(sc.defaultParallelism, -(-int(sum(tally.values())) // BLOCK)))
    spread = blocks.rdd.map(lambda r: bytes(r.block)).repartition(tasks)

    def rows_with(part: Iterator[bytes]) -> Iterator[np.ndarray]:
        out = np.zeros((k, width))
        for raw in part:
            b = pickle.loads(raw)
            out[folds.index(b["fold"])] += np.bincount(b["idx"], minlength=width)
        yield out

    def added(rdd) -> np.ndarray:
        return rdd.treeReduce(np.add) if tasks > 32 else sum(rdd.collect())

    in_fold = added(spread.mapPartitions(rows_with))
    docs = in_fold.sum(0)[None, :] - in_fold
    idf = np.where(mine & (docs >= min_df), np.log((1 + total[:, None]) / (1 + docs)) + 1, 0.0)
    setup = {"idf": idf, "median": median, "mean": mean, "dev": dev, "weight": weight}
    shared = sc.broadcast(setup)

    def with_lengths(raw: bytes) -> bytes:
        b = pickle.loads(raw)
        b["lengths"] = np.stack([_Rows(b, shared.value, f).inv for f in range(k)])
        return pickle.dumps(b)

    held = spread.map(with_lengths).persist(StorageLevel.MEMORY_AND_DISK)
    m = len(numbers)

    def moments(part: Iterator[bytes]) -> Iterator[np.ndarray]:
        """Weighted sums of a feature and of its square."""
        out = np.zeros((k, 2, width + m))
        for raw in part:
            b = pickle.loads(raw)
            for f in range(k):
                if folds[f] != b["fold"]:
                    r = _Rows(b, shared.value, f)
                    w = np.repeat(r.w, 2)
                    x = b["tf"] * np.repeat(r.inv, b["n"])
                    each = np.repeat(w, b["n"])
                    out[f, 0] += np.append(np.bincount(b["idx"], each * x, minlength=width), r.w @ r.x)
                    out[f, 1] += np.append(np.bincount(b["idx"], each * x * x, minlength=width), r.w @ (r.x * r.x))
        yield out

    mass = (by_class * weight).sum(1)
    squares = (by_class * weight**2).sum(1)
    ridge = np.zeros(k) + (penalty(mass) if callable(penalty) else penalty)
    got = added(held.mapPartitions(moments))
    full = np.concatenate([idf, np.ones((k, m))], 1)
    one, two = got[:, 0] * full, got[:, 1] * full**2
    mass_, squares_ = np.maximum(mass, 1e-12)[:, None], squares[:, None]
    if scaled:
        var = np.maximum(two - one**2 / mass_, 0) / np.maximum(mass_ - squares_ / mass_, 1e-12)
        step = np.where(var > 1e-18, 1 / np.sqrt(np.where(var > 1e-18, var, 1)), 0.0)
        cost = np.ones_like(step)
    else:  # the plain coefficients cost; steps are measured by the curvature
        step = 1 / np.sqrt(0.25 * two / mass_ + ridge[:, None])
        cost = step**2

    def model(f: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        u = x[:-1] * step[f] * full[f]
        return u[:width], u[width:], float(x[-1])

    def one_pass(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        sent = sc.broadcast({f: model(f, x) for f, x in points.items()})

        def losses(part: Iterator[bytes]) -> Iterator[np.ndarray]:
            out = np.zeros((len(sent.value), width + m + 2))
            for raw in part:
                b = pickle.loads(raw)
                for at, (f, uvb) in enumerate(sent.value.items()):
                    if folds[f] != b["fold"]:
                        r = _Rows(b, shared.value, f)
                        value, slope = LOSSES[loss](r.y, r.margins(*uvb))
                        t, v, c = r.gradient(r.w * slope, width)
                        out[at, :width] += t
                        out[at, width:] += np.array([*v, c, r.w @ value])
            yield out

        sums = added(held.mapPartitions(losses))
        sent.destroy()
        out = {}
        for at, (f, x) in enumerate(points.items()):
            g = np.append(sums[at, :-2] * full[f] * step[f] / mass[f] + ridge[f] * cost[f] * x[:-1], sums[at, -2] / mass[f])
            out[f] = sums[at, -1] / mass[f] + ridge[f] / 2 * (cost[f] * x[:-1]) @ x[:-1], g
        return out

    runs = {f: minimise(np.zeros(width + m + 1), iterations, tolerance) for f in range(k) if by_class[f].all()}
    points = {f: next(r) for f, r in runs.items()}
    fitted = {f: (np.zeros(width), np.zeros(m), np.inf if by_class[f, 1] else -np.inf) for f in range(k) if f not in runs}
    while points:
        for f, got_ in one_pass(points).items():
            try:
                points[f] = runs[f].send(got_)
            except StopIteration as end:
                fitted[f] = model(f, end.value)
                del points[f]
    held.unpersist()
    final = sc.broadcast(fitted)
    kind = dict(d.dtypes)

    def score(raw: bytes) -> list[tuple]:
        b = pickle.loads(raw)
        f = folds.index(b["fold"])
        z = _Rows(b, shared.value, f).margins(*final.value[f])
        return list(zip(b["key"].tolist(), b["y"].astype(int).tolist(), [b["fold"]] * len(z), z.tolist(), strict=True))

    return d.sparkSession.createDataFrame(blocks.rdd.flatMap(lambda r: score(bytes(r.block))), f"{key} {kind[key]}, y {kind[label]}, fold int, margin double", verifySchema=False)

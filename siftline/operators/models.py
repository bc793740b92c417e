"""Models on pyspark.ml: balanced logistic regression, calibrated linear SVM, boosted trees, folds, reduction and selection."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct, HashingTF, Imputer, MaxAbsScaler, Normalizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftline.operators import lockstep
from siftline.operators.features import char_wb_ngrams, tokens, word_ngrams
from siftline.operators.sampling import fold, lot
from siftline.session import materialise

MAX_SIZE = 4096  # elements of a vector that is reduced: its Gram matrix goes to the driver


def text_columns(df: DataFrame, text: str, words: tuple[int, int] = (1, 2), chars: tuple[int, int] = (2, 4)) -> DataFrame:
    """Adds the term arrays `words` and `chars`."""
    return df.withColumn("words", word_ngrams(tokens(text), *words)).withColumn("chars", char_wb_ngrams(F.col(text), *chars))


class SmoothIDF(Estimator):
    """Weights counts by ln((1 + rows) / (1 + rows with the term)) + 1, terms of fewer than min_df rows by 0."""

    def __init__(self, source: str, target: str, min_df: int):
        super().__init__()
        self.source, self.target, self.min_df = source, target, min_df

    def _fit(self, dataset: DataFrame) -> Transformer:
        m = IDF(inputCol=self.source, outputCol=self.target).fit(dataset)
        weight = np.where(np.array(m.docFreq) >= self.min_df, m.idf.toArray() + 1, 0.0)
        return ElementwiseProduct(scalingVec=Vectors.dense(weight), inputCol=self.source, outputCol=self.target)


def term_stages(size: int = 1 << 14, min_df: int = 2, vocabulary: int | None = None) -> list:
    """Word and character terms to weighted vectors of unit length: hashed, or by a vocabulary whose terms can be named."""
    stages: list = []
    for c in ("words", "chars"):
        count = CountVectorizer(inputCol=c, outputCol=f"{c}_tf", vocabSize=vocabulary, minDF=float(min_df)) if vocabulary else HashingTF(inputCol=c, outputCol=f"{c}_tf", numFeatures=size)
        stages += [count, SmoothIDF(f"{c}_tf", f"{c}_idf", min_df), Normalizer(inputCol=f"{c}_idf", outputCol=f"{c}_vec")]
    return stages


def text_pipeline(model: Estimator | None = None, size: int = 1 << 14, min_df: int = 2, vocabulary: int | None = None) -> Pipeline:
    """Word and character terms side by side (sparse throughout), then the model."""
    return Pipeline(stages=[*term_stages(size, min_df, vocabulary), VectorAssembler(inputCols=["words_vec", "chars_vec"], outputCol="features"), *([model] if model else [])])


def fusion_pipeline(numbers: Sequence[str], model: Estimator | None = None, vocabulary: int = 20_000, min_df: int = 2) -> Pipeline:
    """Word and character terms beside numbers, whose gaps (null or NaN) take the median and which are standardised."""
    filled = [f"{c}_filled" for c in numbers]
    number = [Imputer(inputCols=list(numbers), outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="numbers_raw"), StandardScaler(inputCol="numbers_raw", outputCol="numbers", withMean=True, withStd=True)]
    return Pipeline(stages=[*term_stages(min_df=min_df, vocabulary=vocabulary), *number, VectorAssembler(inputCols=["words_vec", "chars_vec", "numbers"], outputCol="features"), *([model] if model else [])])


def balanced(df: DataFrame, label: str = "y") -> DataFrame:
    """Adds weight = n / (2 * rows of the class)."""
    n = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    total = sum(n.values())
    case = F.lit(1.0)
    for value, c in n.items():
        case = F.when(F.col(label) == value, total / (len(n) * c)).otherwise(case)
    return df.withColumn("weight", case)


def logistic(n_weight: float, c: float = 1.0, iterations: int = 2000, tolerance: float = 1e-6) -> LogisticRegression:
    """L2 with the strength that C stands for over the summed weight, fitted until it converges; features are taken as they are."""
    return LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", regParam=1.0 / (c * max(n_weight, 1.0)), elasticNetParam=0.0, standardization=False, maxIter=iterations, tol=tolerance)


def iterations_used(model: PipelineModel) -> int:
    """Iterations that the fit of the last stage took; at the limit it did not converge."""
    return model.stages[-1].summary.totalIterations


def probability(df: DataFrame, column: str = "probability") -> DataFrame:
    return df.withColumn("score", vector_to_array(column)[1])


def _folded(df: DataFrame, key: str, label: str, folds: int, seed: int = 42, fold_col: str | None = None) -> tuple[DataFrame, int]:
    """The rows with their fold, stored, and their number."""
    sizes = [r[1] for r in df.groupBy(label).count().collect()]
    k = min(folds, min(sizes)) if len(sizes) > 1 else 0
    if k < 2:
        raise ValueError("the smaller class needs two rows")
    return materialise(df.withColumn("fold", F.col(fold_col) if fold_col else fold(key, label, k, seed)), "folds"), sum(sizes)


def out_of_fold(df: DataFrame, key: str, label: str, make: Callable[[DataFrame], Estimator], folds: int = 5, seed: int = 42, fold_col: str | None = None, output: str = "probability") -> DataFrame:
    """(key, y, fold, score): each row scored by a model that has not seen its fold.

    Folds are stratified by label, or given (for groups). There are at most as many as the smaller class has rows;
    ValueError if that is under two. `output` is the model's column whose second element is the score.
    """
    d, n = _folded(df, key, label, folds, seed, fold_col)
    out = None
    for i in sorted(r[0] for r in d.select("fold").distinct().collect()):
        train = balanced(d.where(F.col("fold") != i), label).coalesce(1 + n // 2000)  # an iteration costs a job: no more tasks than rows are worth
        scored = probability(make(train).fit(train).transform(d.where(F.col("fold") == i)), output).select(key, F.col(label).alias("y"), "fold", "score")
        out = scored if out is None else out.union(scored)
    return out


def logistic_pipeline(train: DataFrame) -> Pipeline:
    return text_pipeline(logistic(train.agg(F.sum("weight")).first()[0]))


def log_loss(scores: DataFrame, label: str = "y") -> DataFrame:
    """(n, log_loss) of scores against labels 0 and 1."""
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("score")))
    return scores.agg(F.count("*").alias("n"), F.avg(-F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"))


def group_folds(df: DataFrame, group: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Adds fold; all rows of a group share one. Rows of a null group go to folds of their own group, the null.

    Groups with a twentieth of a fold or more (20 per fold at most) are placed by falling size and majority label, to and fro over
    the folds; the others likewise within 64 parts by hash. No task sees all groups.
    """
    g = df.groupBy(group).agg(F.count("*").alias("_n"), F.avg(F.col(label).cast("double")).alias("_m"))
    total = g.agg(F.sum("_n")).first()[0] or 0
    part = F.when(F.col("_n") * 20 * folds >= total, F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.lit(seed), group), F.lit(64)))
    w = Window.partitionBy("_part", F.coalesce(F.col("_m") >= 0.5, F.lit(False))).orderBy(F.desc("_n"), lot(seed, group))
    placed = g.withColumn("_part", part).withColumn("_r", F.row_number().over(w) - 1 + F.greatest("_part", F.lit(0)))
    place = F.when((F.floor(F.col("_r") / folds) % 2) == 0, F.col("_r") % folds).otherwise(folds - 1 - F.col("_r") % folds)
    other = placed.select(F.col(group).alias("_group"), place.cast("int").alias("fold"))
    return df.join(other, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def svm_pipeline(iterations: int = 200, tolerance: float = 1e-5) -> Pipeline:
    """Max-abs scaled linear SVM; its margin is calibrated by `platt`."""
    return Pipeline(stages=[*text_pipeline().getStages(), MaxAbsScaler(inputCol="features", outputCol="scaled"), LinearSVC(featuresCol="scaled", labelCol="y", weightCol="weight", maxIter=iterations, tol=tolerance, regParam=0.01)])


def platt(margins: DataFrame, margin: str = "m") -> PipelineModel:
    """A sigmoid fitted on out-of-fold margins; transforms tables with that column."""
    a = VectorAssembler(inputCols=[margin], outputCol="margin_vec")
    return Pipeline(stages=[a, LogisticRegression(featuresCol="margin_vec", labelCol="y", maxIter=100)]).fit(margins)


def calibrated_svm(df: DataFrame, key: str, label: str, folds: int = 3, iterations: int = 200) -> DataFrame:
    """(key, y, fold, score): out-of-fold margins of a linear SVM, as `svm_pipeline` states it, as probabilities by a sigmoid over all of them.

    The folds are fitted side by side (`lockstep`), where max-abs scales drop out as features are measured in their deviations.
    """
    d, _ = _folded(df, key, label, folds)
    m = materialise(lockstep.fit_and_score(d, key, label, "hinge", 0.01, True, iterations, 1e-5).withColumnRenamed("margin", "m"), "margins")
    return probability(platt(m).transform(m)).select(key, "y", "fold", "score")


def fusion_scores(df: DataFrame, key: str, label: str, numbers: Sequence[str], folds: int = 5, fold_col: str | None = None, c: float = 1.0, iterations: int = 2000, tolerance: float = 1e-6) -> DataFrame:
    """(key, y, fold, score): out-of-fold scores of `fusion_pipeline` with `logistic`; the folds are fitted side by side (`lockstep`).

    Numbers missing in all rows that a fold trains on count as 0.
    """
    d, _ = _folded(df, key, label, folds, fold_col=fold_col)
    z = lockstep.fit_and_score(d, key, label, "log", lambda n: 1.0 / (c * np.maximum(n, 1.0)), False, iterations, tolerance, numbers, 20_000)
    return z.select(key, "y", "fold", (1 / (1 + F.exp(-F.col("margin")))).alias("score"))


def boosted(features: Sequence[str], trees: int = 50, rate: float = 0.05, depth: int = 5, seed: int = 42) -> Pipeline:
    """Gradient-boosted trees on numeric columns; nulls are kept as NaN, a value of their own."""
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), GBTClassifier(featuresCol="features", labelCol="y", weightCol="weight", maxIter=trees, stepSize=rate, maxDepth=depth, seed=seed)])


def top_terms(model: PipelineModel, spark, k: int = 20) -> DataFrame:
    """(side, rank, term, weight): the k terms of largest and of smallest coefficient of a linear model over vocabularies.

    Terms beyond the vocabularies (numbers) are left out. The coefficients, a few ten thousand, lie on the driver anyway.
    """
    names = [t for s in model.stages if isinstance(s, CountVectorizerModel) for t in s.vocabulary]
    w = model.stages[-1].coefficients.toArray()[: len(names)]
    order = np.argsort(-w, kind="stable")
    rows = [(side, i + 1, names[j], float(w[j])) for side, at in (("positive", order[:k]), ("negative", order[::-1][:k])) for i, j in enumerate(at)]
    return spark.createDataFrame(rows, "side string, rank int, term string, weight double")


def save(model: PipelineModel, path: str) -> None:
    """Writes a fitted pipeline to a folder that all executors can reach, in place of what is there."""
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def components(df: DataFrame, vector: str, k: int, centred: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(components (k, size), mean): the leading right singular vectors of the rows, or of the centred rows (principal components).

    Each task sums up its rows' Gram matrix; the sums, size x size, are added up and solved on the driver. The sign of a component makes its
    largest element positive. Null vectors are left out; vectors of more than MAX_SIZE elements raise ValueError.
    """
    first = df.where(F.col(vector).isNotNull()).select(F.size(vector)).first()
    size = first[0] if first else 0
    if not 0 < k <= size <= MAX_SIZE:
        raise ValueError(f"cannot take {k} components of vectors of {size} elements")

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total, square = 0, np.zeros(size), np.zeros((size, size))
        for b in batches:
            if len(b):
                x = np.stack(b["v"].to_numpy()).astype(np.float64)
                n, total, square = n + len(x), total + x.sum(0), square + x.T @ x
        yield pd.DataFrame({"i": range(-1, size), "row": [np.append(total, n), *(np.append(r, 0.0) for r in square)]})

    parts = df.where(F.col(vector).isNotNull()).select(F.transform(vector, lambda x: x.cast("double")).alias("v")).mapInPandas(gram, "i int, row array<double>")
    sums = parts.groupBy("i").agg(F.array(*(F.sum(F.col("row")[j]) for j in range(size + 1))).alias("row")).collect()  # size + 1 rows
    rows = {r.i: np.array(r.row) for r in sums}
    n, mean = rows[-1][size], rows[-1][:size] / max(rows[-1][size], 1)
    square = np.stack([rows[i][:size] for i in range(size)])
    if centred:
        square = square - n * np.outer(mean, mean)
    _, v = np.linalg.eigh(square)
    top = v[:, ::-1][:, :k].T
    top = top * np.sign(top[np.arange(k), np.abs(top).argmax(1)])[:, None]
    return top, mean if centred else np.zeros(size)


def reduce(df: DataFrame, key: str, vector: str, k: int, centred: bool = False) -> DataFrame:
    """(key, reduced array<double>): every row on the k leading components; null vectors give null."""
    top, mean = components(df, vector, k, centred)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [None if v is None else (top @ (np.asarray(v, np.float64) - mean)) for v in b[vector]]
            yield pd.DataFrame({key: b[key], "reduced": out})

    return df.select(key, vector).mapInPandas(project, f"{key} {dict(df.dtypes)[key]}, reduced array<double>")


def choose_candidate(base_auc: float, mixed_auc: float, base_met: bool, mixed_met: bool) -> str:
    """mixed only if it ranks strictly better and both meet their targets; else base."""
    return "mixed" if mixed_auc > base_auc and base_met and mixed_met else "base"


def go_no_go(metrics: Mapping[str, float], min_auc: float = 0.85, min_keep_precision: float = 0.90, max_overturn: float = 0.08, min_n: int = 50) -> tuple[bool, list[str]]:
    """Whether all gates hold, and the reasons where they do not; keep_met and drop_met, where given, must be true."""
    tests = [
        ("auc", metrics.get("auc", 0.0) >= min_auc), ("keep_n", metrics.get("keep_n", 0) >= min_n), ("keep_precision", metrics.get("keep_precision", 0.0) >= min_keep_precision),
        ("drop_n", metrics.get("drop_n", 0) >= min_n), ("drop_overturn", metrics.get("drop_overturn", 1.0) <= max_overturn), ("keep_met", bool(metrics.get("keep_met", True))), ("drop_met", bool(metrics.get("drop_met", True))),
    ]
    reasons = [name for name, ok in tests if not ok]
    return not reasons, reasons


def gate_reasons(metrics: DataFrame, min_precision: float = 0.95, max_u_rate: float = 0.01) -> DataFrame:
    """Adds reasons and passed to threshold metrics of an independent sample (n_drop, precision, t_hurt, u_rate)."""

    def reason(bad: Column, name: str) -> Column:
        return F.when(bad, name)

    found = F.array_compact(F.array(reason(F.col("precision") < min_precision, "precision"), reason(F.col("t_hurt") > 0, "t_hurt"), reason(F.col("u_rate") > max_u_rate, "u_rate"), reason(F.col("n_drop") == 0, "no_drop")))
    return metrics.withColumn("reasons", found).withColumn("passed", F.size("reasons") == 0)


"""Intent classifier: TF-IDF, multinomial logistic regression, sigmoid calibration.

Training reads the capped weak-label set.  Scoring is a plain DataFrame plan: the coefficients sit
in the vocabulary table, and one aggregate per message sums all margins, so a
message table of any size is scored without Python workers.
"""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.text import clean_for_query, seeded_key, strip_negated
from triagelake.operators.intents import detect, hybrid
from triagelake.operators.vectors import raw_weight, term_counts, vocabulary, weighted
from triagelake.session import cut_lineage


#: Relative improvement of the loss at which a fit ends.
TOLERANCE = 1e-8


@dataclass(frozen=True)
class IntentModel:
    classes: list[str]
    stop_words: list[str]
    sublinear: bool
    terms: DataFrame  # term, idf, coef array<double>: fold-major, then class
    intercepts: list[list[float]]  # fold x class
    sigmoids: list[list[tuple[float, float]]] | None  # fold x class -> (a, b); None: softmax
    c: float = 1.0  # inverse ridge penalty
    seed: int = V.SEED  # of the order that deals rows to folds

    @property
    def folds(self) -> int:
        return len(self.intercepts)

    def empty_posterior(self) -> list[float]:
        """Posterior of a text without a known term: intercepts only."""
        z = np.array(self.intercepts)
        if self.sigmoids is None:
            e = np.exp(z - z.max(axis=1, keepdims=True))
        else:
            ab = np.array(self.sigmoids)
            e = 1.0 / (1.0 + np.exp(ab[:, :, 0] * z + ab[:, :, 1]))
        return (e / e.sum(axis=1, keepdims=True)).mean(axis=0).tolist()

    def _known_terms(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id, term, coef, _w): the terms of each text that the model knows.

        The vocabulary is bounded (its coefficients were fitted on the driver), so it is sent to the terms, which stay with their
        texts.  Met by a shuffle, a message would leave sums of all its products in each partition of the terms.
        """
        counts = term_counts(df, id_col, text_col, self.stop_words)
        return counts.join(F.broadcast(self.terms), "term").withColumn("_w", raw_weight(self.sublinear))

    def _margins(self, hit: DataFrame) -> DataFrame:
        """(id, _norm, _m0, ...): the length of each vector and its products with all coefficients, fold-major."""
        sums = [F.sum(F.col("_w") * F.col("coef")[j]).alias(f"_m{j}") for j in range(self.folds * len(self.classes))]
        return hit.groupBy("id").agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"), *sums)

    def posteriors(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """df with ``posterior`` array<double> in the order of ``classes``."""
        k = len(self.classes)
        margins = self._margins(self._known_terms(df, id_col, text_col))
        per_fold = []
        for f in range(self.folds):
            z = [F.col(f"_m{f * k + c}") / F.col("_norm") + F.lit(float(self.intercepts[f][c])) for c in range(k)]
            if self.sigmoids is None:
                p = F.array(*[F.exp(x) for x in z])
            else:
                p = F.array(
                    *[1 / (1 + F.exp(F.lit(float(a)) * x + F.lit(float(b)))) for x, (a, b) in zip(z, self.sigmoids[f])]
                )
            per_fold.append(p)
        scored = margins.select("id", *[p.alias(f"_p{f}") for f, p in enumerate(per_fold)])
        for f in range(self.folds):
            total = F.aggregate(f"_p{f}", F.lit(0.0), lambda acc, v: acc + v)
            scored = scored.withColumn(f"_s{f}", total)
        mean = F.array(
            *[
                sum((F.col(f"_p{f}")[c] / F.col(f"_s{f}") for f in range(1, self.folds)), F.col("_p0")[c] / F.col("_s0"))
                / self.folds
                for c in range(k)
            ]
        )
        # a posterior is small: dealt out anew, it does not force its many small parts on the texts and all that meets them later
        scored = scored.select(F.col("id").alias(id_col), mean.alias("posterior")).repartition(id_col)
        fallback = F.array(*[F.lit(float(p)) for p in self.empty_posterior()])
        return df.join(scored, id_col, "left").withColumn("posterior", F.coalesce("posterior", fallback))

    def classify(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """Add detected, intent and intent_confidence (rules blended with the posterior)."""
        stripped = df.withColumn("_ml", strip_negated(F.col(text_col)))
        out = self.posteriors(stripped, id_col, "_ml").withColumn("detected", detect(F.col(text_col)))
        out = out.withColumn("_h", hybrid(F.col("detected"), F.col("posterior"), self.classes))
        return (
            out.withColumn("intent", F.col("_h.intent"))
            .withColumn("intent_confidence", F.col("_h.confidence"))
            .drop("_ml", "_h", "posterior")
        )


def with_top_class(df: DataFrame, classes: list[str]) -> DataFrame:
    """Add model_intent and model_confidence from ``posterior``."""
    top = F.array_max("posterior")
    names = F.array(*[F.lit(c) for c in classes])
    return df.withColumn("model_confidence", top).withColumn(
        "model_intent", F.get(names, (F.array_position("posterior", F.col("model_confidence")) - 1).cast("int"))
    )


def fit_sigmoid(margin: np.ndarray, positive: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(a, b) of p = 1 / (1 + exp(a * m + b)) with smoothed targets, by damped Newton steps."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0))
    a, b = 0.0, float(np.log((n0 + 1.0) / (n1 + 1.0)))

    def loss(a_, b_):
        f = a_ * margin + b_
        return float(np.sum(target * f + np.logaddexp(0.0, -f)))

    value = loss(a, b)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(np.clip(a * margin + b, -500, 500)))
        d, w = target - p, p * (1.0 - p)
        g = np.array([np.sum(margin * d), np.sum(d)])
        if np.max(np.abs(g)) < 1e-8:
            break
        h = np.array([[np.sum(margin * margin * w), np.sum(margin * w)], [np.sum(margin * w), np.sum(w)]])
        step = np.linalg.solve(h + 1e-12 * np.eye(2), g)
        scale = 1.0
        while scale > 1e-10:
            new = loss(a - scale * step[0], b - scale * step[1])
            if new <= value:
                break
            scale /= 2
        if scale <= 1e-10:
            break
        a, b, value = a - scale * step[0], b - scale * step[1], new
    return float(a), float(b)


def _vectors(train: DataFrame, terms: DataFrame, counts: DataFrame, sublinear: bool, size: int) -> DataFrame:
    """(id, y, fold, rare, features, e) of the capped training set; e lists the features' entries."""
    w = weighted(counts, terms, sublinear).join(terms.select("term", "idx"), "term")
    listed = w.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("idx", "w"))).alias("_e"))
    to_vector = F.udf(
        lambda e: SparseVector(size, [x["idx"] for x in e] if e else [], [x["w"] for x in e] if e else []), VectorUDT()
    )
    return train.select("id", "y", "fold", "rare").join(listed, "id", "left").select(
        "id", "y", "fold", "rare", to_vector("_e").alias("features"), F.coalesce("_e", F.expr("cast(array() as array<struct<idx:int,w:double>>)")).alias("e")
    )


def _class_weight(counts: dict[int, int]):
    """Balanced weights: every class weighs as much as the others, all rows together as many as there are."""
    weight = F.lit(0.0)
    for y, m in sorted(counts.items()):
        weight = F.when(F.col("y") == y, F.lit(sum(counts.values()) / (len(counts) * m))).otherwise(weight)
    return weight


def _fit(train: DataFrame, c: float, max_iter: int, n_classes: int, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """(class x term coefficients, intercepts); a class that no row has keeps zeros and the lowest intercept."""
    if n_classes < 2:  # nothing to tell apart
        return np.zeros((n_classes, n_terms)), np.zeros(n_classes)
    counts = {int(r["y"]): r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    lr = LogisticRegression(
        featuresCol="features", labelCol="y", weightCol="cw", family="multinomial", maxIter=max_iter, tol=TOLERANCE,
        regParam=1.0 / (c * sum(counts.values())), elasticNetParam=0.0, standardization=False,
    )
    fitted = lr.fit(train.withColumn("cw", _class_weight(counts)))
    found, base = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    coef, intercept = np.zeros((n_classes, found.shape[1])), np.full(n_classes, base.min() - np.log(sum(counts.values()) + 1.0))
    seen = sorted(y for y in counts if y < len(found))
    coef[seen], intercept[seen] = found[seen], base[seen]
    return coef, intercept


def with_folds(weak: DataFrame, classes: list[str], folds: int, seed: int) -> DataFrame:
    """(id, text, label) with y, fold and rare.

    A class deals its rows to the folds in turn, in a seeded order, so every fold holds its share of every class.  A class with
    fewer rows than folds is rare: its rows are trained on in every fold, for each fold's model must know each class.
    """
    y = F.array_position(F.array(*[F.lit(x) for x in classes]), F.col("label")) - 1
    in_class = Window.partitionBy("label")  # weak labels are capped per class
    number = F.row_number().over(in_class.orderBy(seeded_key(seed, F.col("id")), "id")) - 1
    size = F.count(F.lit(1)).over(in_class)
    return weak.select("id", "text", "label", y.cast("int").alias("y"), (number % folds).alias("fold"), (size < folds).alias("rare"))


def trained_on(fold: int):
    """Whether a row is trained on in a fold; the others are held out for its sigmoids."""
    return (F.col("fold") != fold) | F.col("rare")


def optimality(model: IntentModel, weak: DataFrame) -> DataFrame:
    """(fold, label, n_trained, gradient, sigmoid_gradient): how far the model is from the optimum of its training rows.

    The penalized loss is strictly convex, so its gradient is 0 at one place only.  It is computed anew from the rows and the
    stored coefficients: ``gradient`` is its largest entry over a class's terms and intercept, ``sigmoid_gradient`` that over
    the class's (a, b), per held-out row, and 0 for a model without sigmoids.
    """
    k, folds = len(model.classes), model.folds
    calibrated = model.sigmoids is not None
    rows = with_folds(weak, model.classes, folds, model.seed)
    rows = cut_lineage(rows if calibrated else rows.withColumn("rare", F.lit(True)), "fold-rows")
    cells = rows.groupBy("fold", "y", "rare").agg(F.count(F.lit(1)).alias("n")).collect()  # at most folds x classes x 2
    hit = cut_lineage(model._known_terms(rows, "id", "text"), "fold-terms")
    margins = model._margins(hit).select("id", "_norm", F.array(*[F.col(f"_m{j}") / F.col("_norm") for j in range(folds * k)]).alias("z"))
    n_trained = [[sum(r["n"] for r in cells if r["y"] == y and (r["fold"] != f or r["rare"])) for y in range(k)] for f in range(folds)]
    own = np.array([[sum(r["n"] for r in cells if r["fold"] == f and r["y"] == y) for y in range(k)] for f in range(folds)], dtype=float)
    counts = np.array(n_trained, dtype=float)
    n = counts.sum(axis=1)
    weight = np.divide((n / (counts > 0).sum(axis=1))[:, None], counts, out=np.zeros_like(counts), where=counts > 0)  # as in _class_weight
    positive, negative = (own + 1) / (own + 2), 1 / (own.sum(axis=1, keepdims=True) - own + 2)
    base, sigmoids = np.array(model.intercepts), np.array(model.sigmoids) if calibrated else None

    def residuals(batches):
        """Derivatives of each row's losses by the margins (r) and by the sigmoids (h)."""
        for pdf in batches:
            m = len(pdf)
            z = np.array([np.zeros(folds * k) if v is None else v for v in pdf["z"]]).reshape(m, folds, k) + base
            y = np.eye(k)[pdf["y"].to_numpy()][:, None, :]
            p = np.exp(z - z.max(axis=2, keepdims=True))
            p /= p.sum(axis=2, keepdims=True)
            at, rare = pdf["fold"].to_numpy()[:, None] == np.arange(folds), pdf["rare"].to_numpy()[:, None]
            cost = np.where(~at | rare, weight[:, pdf["y"].to_numpy()].T / n, 0.0)
            h = np.zeros((m, 0))
            if sigmoids is not None:
                miss = np.where(y > 0, positive, negative) - 1 / (1 + np.exp(np.clip(sigmoids[:, :, 0] * z + sigmoids[:, :, 1], -500, 500)))
                miss = miss * at[:, :, None]
                h = np.stack([miss, miss * z], axis=3).reshape(m, -1)
            yield pd.DataFrame({"id": pdf["id"], "norm": pdf["_norm"], "r": list((cost[:, :, None] * (p - y)).reshape(m, -1)), "h": list(h)})

    kind = rows.select("id").schema["id"].dataType.simpleString()
    joined = rows.join(margins, "id", "left").select("id", "y", "fold", "rare", "_norm", "z")
    scored = cut_lineage(joined.mapInPandas(residuals, f"id {kind}, norm double, r array<double>, h array<double>"), "residuals")
    pushed = hit.join(scored.select("id", "norm", "r"), "id").groupBy("term").agg(
        F.first("coef").alias("coef"), *[F.sum(F.col("_w") / F.col("norm") * F.col("r")[j]).alias(f"_g{j}") for j in range(folds * k)]
    )
    by_term = pushed.agg(*[F.max(F.abs(F.col(f"_g{j}") + F.col("coef")[j] / F.lit(float(model.c * n[j // k])))).alias(f"g{j}") for j in range(folds * k)]).head()
    sums = scored.agg(*[F.sum(F.col("r")[j]).alias(f"b{j}") for j in range(folds * k)]).head()
    held = scored.agg(*[F.sum(F.get("h", F.lit(j))).alias(f"h{j}") for j in range(2 * folds * k)]).head()
    out = []
    for j in range(folds * k):
        f, c = divmod(j, k)
        sigmoid = max(abs(held[f"h{2 * j}"]), abs(held[f"h{2 * j + 1}"])) / max(1.0, own[f].sum()) if calibrated else 0.0
        out.append((f, model.classes[c], n_trained[f][c], float(max(by_term[f"g{j}"] or 0.0, abs(sums[f"b{j}"]))), float(sigmoid)))
    return weak.sparkSession.createDataFrame(out, "fold int, label string, n_trained long, gradient double, sigmoid_gradient double")


def train(
    weak: DataFrame,
    stop_words: list[str],
    max_terms: int = V.CLASSIFIER_TERMS,
    sublinear: bool = True,
    folds: int = 5,
    c: float = 1.0,
    max_iter: int = 1000,
    seed: int = V.SEED,
    calibrated: bool = True,
) -> IntentModel:
    """Fit on (id, text, label).  Balanced class weights, C as in an unscaled ridge penalty.

    Folds are dealt within each class (`with_folds`).  `optimality` tells how near the result is to the optimum.
    """
    spark = weak.sparkSession
    weak = cut_lineage(weak.select("id", "text", "label"), "weak-labels")
    counts = cut_lineage(term_counts(weak, "id", "text", stop_words), "training-terms")
    n_docs = weak.count()
    vocab = vocabulary(counts, n_docs, max_terms).withColumn("idx", F.row_number().over(Window.orderBy("term")) - 1)
    terms = cut_lineage(vocab, "training-vocabulary")
    size = max(terms.count(), 1)
    classes = sorted(r["label"] for r in weak.select("label").distinct().collect())
    k = len(classes)
    dealt = with_folds(weak, classes, folds if calibrated else 1, seed)
    data = _vectors(dealt, terms, counts, sublinear, size).withColumn("y", F.col("y").cast("double"))
    data = cut_lineage(data, "training-vectors")
    # every optimizer step is one job over this table: few partitions, as long as it is small
    data = data.coalesce(max(1, n_docs // 5000)).persist()

    def fit_one(f: int):
        return _fit(data.where(trained_on(f)) if calibrated else data, c, max_iter, k, size)

    rounds = range(folds if calibrated else 1)
    with ThreadPool(len(rounds)) as pool:  # independent Spark jobs; the session schedules them
        models = pool.map(fit_one, rounds)
    coefs = [m[0] for m in models]
    intercepts = [[float(v) for v in m[1]] for m in models]
    sigmoids = None
    if calibrated:

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b = fit_sigmoid(pdf["margin"].to_numpy(), (pdf["y"] == pdf["cls"]).to_numpy())
            return pd.DataFrame({"fold": [pdf["fold"].iloc[0]], "cls": [pdf["cls"].iloc[0]], "a": [a], "b": [b]})

        shared = spark.sparkContext.broadcast((np.stack(coefs), np.array(intercepts)))  # folds x classes x terms

        def held_out(batches):
            weights, base = shared.value
            for pdf in batches:
                z = np.array([weights[f][:, np.asarray(i, dtype=int)] @ np.asarray(w) + base[f] for f, i, w in zip(pdf["fold"], pdf["at"], pdf["w"])]).reshape(len(pdf), k)
                yield pd.DataFrame({
                    "fold": np.repeat(pdf["fold"].to_numpy(), k), "y": np.repeat(pdf["y"].to_numpy(), k), "cls": np.tile(np.arange(k), len(pdf)), "margin": z.ravel(),
                })

        # each row once, under the model of the fold that holds it out; folds x classes groups of the capped training set
        stacked = data.select("fold", "y", "e.idx", "e.w").toDF("fold", "y", "at", "w").mapInPandas(held_out, "fold int, y double, cls int, margin double")
        fitted = stacked.groupBy("fold", "cls").applyInPandas(one, "fold int, cls int, a double, b double").collect()
        sigmoids = [[(0.0, 0.0)] * k for _ in range(folds)]
        for r in fitted:
            sigmoids[r["fold"]][r["cls"]] = (r["a"], r["b"])
    data.unpersist()

    table = np.concatenate(coefs, axis=0).T  # term x (fold * class)
    width = table.shape[1]
    coef = pa.ListArray.from_arrays(
        pa.array(np.arange(0, size * width + 1, width, dtype="int32")), pa.array(np.ascontiguousarray(table).ravel())
    )
    by_index = spark.createDataFrame(pa.table({"idx": pa.array(np.arange(size, dtype="int32")), "coef": coef}))
    final = cut_lineage(terms.join(by_index, "idx").select("term", "idf", "coef"), "classifier-terms")
    return IntentModel(classes, list(stop_words), sublinear, final, intercepts, sigmoids, c, seed)

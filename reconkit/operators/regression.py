"""Linear regression on Spark ML and logistic regression by Newton steps, with the usual fit statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F, types as T

from reconkit.functions import pvalues
from reconkit.operators.hypothesis import auc, classification_report, confusion_matrix
from reconkit.session import local_rows

MAX_STEPS = 60
FLAT = 1e-8  # curvature, against that at the start, below which there is no top
CLOSE_ENOUGH = 1e-12  # expected gain of a Newton step, against the likelihood


@dataclass
class LinearFit:
    coefficients: DataFrame  # term, estimate, std_error, t, p, ci_low, ci_high
    fit: DataFrame  # one row: n, r2, adj_r2, f, f_p, aic, bic
    rows: DataFrame  # input rows with fitted and residual


def proc_reg(df: DataFrame, model: str, confidence: float = 0.95) -> LinearFit:
    """Ordinary least squares from a formula ``y ~ x1 + x2``.

    Text terms are one-hot coded against their alphabetically first level.
    """
    target = model.split("~")[0].strip()
    data = df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.NumericType)}
    )
    formula = RFormula(
        formula=model, featuresCol="_x", labelCol="_y", stringIndexerOrderType="alphabetDesc", handleInvalid="skip"
    ).fit(data)
    design = formula.transform(data).filter(F.col("_y").isNotNull())
    fitted = LinearRegression(featuresCol="_x", labelCol="_y", predictionCol="fitted", solver="normal").fit(design)
    s = fitted.summary
    n, k = s.numInstances, len(fitted.coefficients)
    dof = n - k - 1
    rss = s.meanSquaredError * n
    tss = rss / (1 - s.r2) if s.r2 < 1 else math.inf
    meta = design.schema["_x"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for kind in meta.values() for a in kind}
    terms = [names.get(i, f"x{i}") for i in range(k)] + ["Intercept"]
    half = pvalues.t_quantile(0.5 + confidence / 2, dof)
    estimates = [*fitted.coefficients, fitted.intercept]
    rows = [
        (term, float(b), float(se), float(t), float(p), float(b - half * se), float(b + half * se))
        for term, b, se, t, p in zip(terms, estimates, s.coefficientStandardErrors, s.tValues, s.pValues)
    ]
    f = ((tss - rss) / k) / (rss / dof) if k and rss else math.inf
    log_likelihood = -n / 2 * (math.log(2 * math.pi * rss / n) + 1) if rss else math.inf
    fit = (
        n, float(s.r2), float(s.r2adj), float(f), pvalues.f_sf(f, k, dof) if math.isfinite(f) else 0.0,
        -2 * log_likelihood + 2 * (k + 1), -2 * log_likelihood + math.log(n) * (k + 1),
    )
    spark = df.sparkSession
    out = fitted.transform(design).withColumn("residual", F.col("_y") - F.col("fitted")).drop("_x", "_y")
    return LinearFit(
        local_rows(
            spark, rows, "term string, estimate double, std_error double, t double, p double, ci_low double, ci_high double"
        ),
        local_rows(spark, [fit], "n bigint, r2 double, adj_r2 double, f double, f_p double, aic double, bic double"),
        out if target in df.columns else out.drop(target),
    )


@dataclass
class LogisticFit:
    coefficients: DataFrame  # term, estimate (Intercept included)
    predictions: DataFrame  # input rows with probability and prediction
    auc: DataFrame
    confusion: DataFrame
    report: DataFrame
    steps: int  # Newton steps
    converged: bool


def _logistic_sums(data: DataFrame, features: Sequence[str], beta: np.ndarray) -> np.ndarray:
    """Log likelihood, gradient and the lower half of the Gram matrix at ``beta``, summed over all rows.

    A task adds up its rows and sends one list as long as the square of the features.
    """
    k = len(features) + 1
    low = np.tril_indices(k)

    def run(batches):
        total = np.zeros(1 + k + len(low[0]))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([np.ones(batch.num_rows), *(batch[f"x{i}"].to_numpy() for i in range(k - 1))])
            y, z = batch["_y"].to_numpy(), x @ beta
            p = np.exp(-np.logaddexp(0, -z))
            total[0] += (y * z - np.logaddexp(0, z)).sum()
            total[1 : 1 + k] += x.T @ (y - p)
            total[1 + k :] += ((x * (p * (1 - p))[:, None]).T @ x)[low]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"])

    parts = data.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(1 + k + len(low[0]))
    for i, v in parts.collect():
        out[i] = v
    return out


def _logistic_newton(data: DataFrame, features: Sequence[str], penalty: float) -> tuple[np.ndarray, int, bool]:
    """Coefficients (intercept first), Newton steps taken, and whether they converged.

    Each step is one aggregate over the rows and one small system on the driver, whose size
    the features bound.  A step that lowers the likelihood is halved.
    """
    k = len(features) + 1
    low, weight = np.tril_indices(k), np.r_[0.0, np.full(k - 1, penalty)]
    beta, step, best, first = np.zeros(k), np.zeros(k), -math.inf, 0.0
    for n in range(MAX_STEPS):
        sums = _logistic_sums(data, features, beta)
        value = sums[0] - (weight * beta * beta).sum() / 2
        if value < best - 1e-9 * abs(best):
            step /= 2
            beta = beta - step
            continue
        gram = np.zeros((k, k))
        gram[low] = sums[1 + k :]
        gram = gram + np.tril(gram, -1).T
        curved, gram = np.trace(gram), gram + np.diag(weight)
        first = first or curved
        slope = sums[1 : 1 + k] - weight * beta
        step, best = np.linalg.lstsq(gram, slope, rcond=None)[0], value
        beta = beta + step
        if slope @ step < CLOSE_ENOUGH * (1 + abs(value)):
            # separated classes without a penalty: the likelihood has no top, it only flattens
            return beta, n + 1, bool(penalty or curved > FLAT * first)
    return beta, MAX_STEPS, False


def proc_logistic(df: DataFrame, target: str, features: Sequence[str], c: float = 1.0) -> LogisticFit:
    """Logistic regression with an L2 penalty of strength 1/c (none for an infinite c), intercept not penalised.

    Rows with a null or NaN in the target or a feature take no part; the target is 0 or 1.
    ``converged`` is false if no finite best fit was found, as for separated classes without a penalty.
    """
    features = list(features)
    rows = df.dropna(subset=[target, *features])
    data = rows.select(F.col(target).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    kinds = data.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("_y").isin(0.0, 1.0)).alias("odd")).first()
    if not kinds["n"]:
        raise ValueError("no complete rows")
    if kinds["odd"]:
        raise ValueError(f"{target} must be 0 or 1")
    beta, steps, converged = _logistic_newton(data, features, 0.0 if math.isinf(c) else 1.0 / c)
    score = F.lit(float(beta[0]))
    for f, b in zip(features, beta[1:]):
        score = score + F.lit(float(b)) * F.col(f).cast("double")
    scored = rows.withColumn("probability", 1 / (1 + F.exp(-score)))
    scored = scored.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    actual = scored.withColumn("_y", F.col(target).cast("int"))
    terms = [("Intercept", float(beta[0]))] + [(f, float(b)) for f, b in zip(features, beta[1:])]
    return LogisticFit(
        local_rows(df.sparkSession, terms, "term string, estimate double"),
        scored,
        auc(actual, "_y", "probability"),
        confusion_matrix(actual, "_y", "prediction").withColumnRenamed("_y", "actual"),
        classification_report(actual, "_y", "prediction"),
        steps,
        converged,
    )

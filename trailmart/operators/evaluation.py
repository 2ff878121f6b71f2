"""Forecast accuracy tables over rows with an actual and a predicted value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.histograms import equal_width_hist
from ..functions.ordering import edges_between, exact_quantiles, exact_quantiles_of, with_position
from ..functions.scalars import bin_by_edges, bin_right_closed, ratio

ACTUAL, PREDICTED = "sales", "forecast"


def wmape_of(actual: str = ACTUAL, predicted: str = PREDICTED) -> Column:
    """Sum of absolute errors over sum of absolute actuals, null when that is zero."""
    return ratio(F.sum(F.abs(F.col(actual) - F.col(predicted))), F.sum(F.abs(actual)))


def wmape(pred: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    return pred.agg(wmape_of(actual, predicted).alias("wmape"))


def forecast_metrics(pred: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    """MAE, RMSE, MAPE (%), R2 and row count over rows that have both values."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    rows = pred.where(y.isNotNull() & F.col(predicted).isNotNull())
    spread = F.var_pop(y) * F.count(y)
    return rows.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e / F.greatest(y, F.lit(1e-6)))) * 100).alias("mape"),
        F.when(spread > 0, 1 - F.sum(e * e) / spread).otherwise(F.lit(0.0)).alias("r2"),
        F.count(F.lit(1)).alias("samples"),
    )


def residuals(pred: DataFrame, actual: str = ACTUAL, predicted: str = PREDICTED) -> DataFrame:
    return pred.withColumn("residual", F.col(actual) - F.col(predicted))


def abs_error_hist(
    pred: DataFrame, bins: int = 40, actual: str = ACTUAL, predicted: str = PREDICTED
) -> DataFrame:
    errors = pred.select(F.abs(F.col(actual) - F.col(predicted)).alias("error"))
    return equal_width_hist(errors, "error", bins)


def log_error_hist(
    pred: DataFrame, bins: int = 59, actual: str = ACTUAL, predicted: str = PREDICTED
) -> DataFrame:
    """Bins even in log10 from 0.001 to the largest error plus one, with the median error."""
    errors = pred.select(F.abs(F.col(actual) - F.col(predicted)).alias("error")).where("error is not null")
    median = exact_quantiles(errors, "error", [0.5])[0]
    top = errors.select(F.log10(F.max("error") + 1)).scalar()
    step = (top + 3) / F.lit(float(bins))
    spot = F.floor((F.log10("error") + 3) / step)
    counts = (
        errors.where(F.col("error") >= 1e-3)
        .groupBy(F.least(spot, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(top).alias("_top"))
    )
    edges = F.transform(edges_between(F.lit(-3.0), F.col("_top"), bins), lambda x: F.pow(F.lit(10.0), x))
    packed = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"), F.max("_top").alias("_top")
    )
    return (
        packed.withColumn("_edges", edges)
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .select(
            F.col("bin").cast("bigint").alias("bin"),
            F.col("_edges")[F.col("bin")].alias("lower"),
            F.col("_edges")[F.col("bin") + 1].alias("upper"),
            F.coalesce(F.try_element_at("_n", F.col("bin").cast("bigint")), F.lit(0)).cast("bigint").alias("n"),
            F.lit(median).alias("median_error"),
        )
    )


def quantile_edges(df: DataFrame, col: str, n: int) -> list[float]:
    return exact_quantiles(df, col, [i / n for i in range(n + 1)])


def quantile_matrix(
    pred: DataFrame,
    n: int,
    edges_from: str = "each",
    closed: str = "right",
    actual: str = ACTUAL,
    predicted: str = PREDICTED,
) -> DataFrame:
    """Cross-tab of actual by predicted quantile bin.

    ``edges_from="each"``: each side by its own quantiles. ``"actual"``: both by
    those of the actual values; left-closed, values above the top edge (and the
    largest actual) land in bin ``n``, values below the lowest in bin -1.
    """
    cuts = [i / n for i in range(n + 1)]
    columns = [actual] if edges_from == "actual" else [actual, predicted]
    edges = exact_quantiles_of(pred, dict.fromkeys(columns, cuts))
    own, other = edges[actual], edges[columns[-1]]
    place = bin_right_closed if closed == "right" else bin_by_edges
    return (
        pred.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(
            place(F.col(actual), own).cast("bigint").alias("actual_bin"),
            place(F.col(predicted), other).cast("bigint").alias("predicted_bin"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def mape_by_quantile(
    pred: DataFrame,
    n: int = 5,
    closed: str = "right",
    actual: str = ACTUAL,
    predicted: str = PREDICTED,
) -> DataFrame:
    """Mean percentage error per quantile bin of the prediction.

    ``closed="right"`` keeps zero actuals (denominator at least 1e-9).
    ``closed="left"`` leaves out zero actuals, bins under two rows and the
    largest prediction, which no left-closed bin holds.
    """
    y, p = F.col(actual), F.col(predicted)
    edges = quantile_edges(pred, predicted, n)
    error = F.abs(y - p)
    rows = pred.where(y.isNotNull() & p.isNotNull())
    if closed == "right":
        share = F.avg(error / F.greatest(y, F.lit(1e-9))) * 100
        return rows.groupBy(bin_right_closed(p, edges).cast("bigint").alias("bin")).agg(
            share.alias("mape"), F.count(F.lit(1)).alias("n")
        )
    share = F.avg(F.when(y != 0, error / F.nullif(y.cast("double"), F.lit(0.0)))) * 100
    return (
        rows.groupBy(bin_by_edges(p, edges).cast("bigint").alias("bin"))
        .agg(share.alias("mape"), F.count(F.lit(1)).alias("n"), F.count_if(y != 0).alias("_nonzero"))
        .where((F.col("bin") < n) & (F.col("n") >= 2) & (F.col("_nonzero") >= 1))
        .drop("_nonzero")
    )


# The rational approximations of a published algorithm (AS 241) for the inverse normal,
# 16 digits; (numerator, denominator) coefficients from the constant term up.
NORMAL_QUANTILE = {
    "middle": (
        (
            3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
            45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727,
        ),
        (
            1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
            21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610,
        ),
    ),
    "near": (
        (
            1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
            1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640,
        ),
        (
            1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
            0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9,
        ),
    ),
    "far": (
        (
            6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
            0.0265321895265761230930, 0.00124266094738807843860, 0.0000271155556874348757815, 2.01033439929228813265e-7,
        ),
        (
            1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
            0.000786869131145613259100, 0.0000184631831751005468180, 1.42151175831644588870e-7, 2.04426310338993978564e-15,
        ),
    ),
}


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution, in column expressions."""

    def ratio(kind: str, r: Column) -> Column:
        def poly(c):
            out = F.lit(c[-1])
            for x in reversed(c[:-1]):
                out = out * r + F.lit(x)
            return out

        top, bottom = NORMAL_QUANTILE[kind]
        return poly(top) / poly(bottom)

    q = p - 0.5
    tail = F.sqrt(-F.log(F.when(q < 0, p).otherwise(1 - p)))
    outer = F.when(tail <= 5, ratio("near", tail - 1.6)).otherwise(ratio("far", tail - 5))
    return F.when(F.abs(q) <= 0.425, q * ratio("middle", 0.180625 - q * q)).otherwise(F.signum(q) * outer)


def qq_points(
    pred: DataFrame,
    actual: str = ACTUAL,
    predicted: str = PREDICTED,
    ties: tuple[str, ...] = ("itemid", "date"),
) -> DataFrame:
    """Ordered residuals against normal quantiles (Filliben medians) with the fitted line.

    ``ties`` are columns that tell rows with equal residuals apart, so that the
    sort can also split a residual that many rows share.
    """
    rows = residuals(pred, actual, predicted).where("residual is not null").select("residual", *ties)
    ranked = with_position(rows, ["residual", *ties], "position")
    n = ranked.select(F.count(F.lit(1))).scalar()
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    median = (
        F.when(F.col("position") == 1, 1 - last)
        .when(F.col("position") == n, last)
        .otherwise((F.col("position") - 0.3175) / (n + F.lit(0.365)))
    )
    points = ranked.select("position", normal_quantile(median).alias("theoretical"), F.col("residual").alias("ordered"))
    line = points.select(
        F.struct(
            F.regr_slope("ordered", "theoretical").alias("slope"),
            F.regr_intercept("ordered", "theoretical").alias("intercept"),
        )
    ).scalar()
    return points.withColumn("fitted", line["intercept"] + line["slope"] * F.col("theoretical"))

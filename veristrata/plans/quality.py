"""The quality pipeline: validate, profile, look for anomalies, and score, as one report table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.functions.columns import as_double, normalize_missing, numeric_columns
from veristrata.operators.anomaly import fit_bounds
from veristrata.operators.profile import summary_figures
from veristrata.operators.validate import statistics, validate, validate_many, validate_with
from veristrata.plans import catalog

ORDER = ("patients", "treatments", "lab_results")


def quick_check(df: DataFrame, dataset_type: str = "patients") -> DataFrame:
    """One table against the suite of its type; an unknown type is checked as patients."""
    return validate(df, catalog.suite_for_dataset(dataset_type))


def suite_statistics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Statistics of the standard suite of each table given."""
    parts = [
        statistics(quick_check(tables[name], name)).select(F.lit(name).alias("dataset"), "*")
        for name in ORDER if tables.get(name) is not None
    ]
    if not parts:
        return statistics(validate_many({})).select(F.lit("").alias("dataset"), "*").limit(0)
    return reduce(DataFrame.unionByName, parts)


def quality_score(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Mean success percent of the suites, and whether all of them passed; without tables 0 and NULL."""
    return suite_statistics(tables).agg(
        F.count(F.lit(1)).alias("suites"),
        F.coalesce(F.avg("success_percent"), F.lit(0.0)).alias("quality_score"),
        F.bool_and("success").alias("passed"),
    )


def quality_report(tables: Mapping[str, DataFrame], threshold: float = 1.5,
                   mode: str = "exact") -> DataFrame:
    """``(section, dataset, metric, value)``: all results of the pipeline in one long table.

    Rules, profile and outliers of a table are counted in one scan; besides, uniqueness is one shuffle of the
    unique columns, and the bounds of the outliers are quantiles.
    """
    parts = [
        _sections(name, tables[name], threshold, mode).select(F.lit(name).alias("dataset"), "*")
        for name in ORDER if tables.get(name) is not None
    ]
    if parts:
        found = reduce(DataFrame.unionByName, parts).groupBy("section", "dataset", "metric").agg(
            F.max("value").alias("value"), F.count("success").alias("evaluated"),
            F.count_if("success").alias("successful"), F.count_if(~F.col("success")).alias("unsuccessful"),
        ).withColumn("success_percent", F.try_divide("successful", "evaluated") * 100)
        names = ("evaluated", "successful", "unsuccessful", "success_percent")
        verdicts = F.array(*(_cell(F.lit(m), F.col(m)) for m in names))
        figure = F.array(_cell(F.col("metric"), F.col("value")))
        detail = found.select(
            "section", "dataset", F.inline(F.when(F.col("section") == "validation", verdicts).otherwise(figure))
        )
    else:
        detail = SparkSession.active().createDataFrame([], "section string, dataset string, metric string, value double")
    # The totals come from the report rows, which all meet in one row for it: a few dozen for each table.
    totals = {
        "quality_score": F.coalesce(
            F.avg(F.when(F.col("metric") == "success_percent", F.col("value"))), F.lit(0.0)),
        "anomaly_count": F.coalesce(
            F.sum(F.when(F.col("section") == "anomaly", F.col("value"))), F.lit(0.0)),
        "records_processed": F.coalesce(
            F.sum(F.when(F.col("metric") == "row_count", F.col("value"))), F.lit(0.0)),
        "passed": F.when(F.max(F.when(F.col("metric") == "unsuccessful", F.col("value"))) == 0, 1.0).otherwise(0.0),
    }
    report = detail.agg(
        F.collect_list(F.struct("section", "dataset", "metric", "value")).alias("report"),
        *(v.alias(k) for k, v in totals.items()),
    )
    overall = F.array(*(
        F.struct(F.lit("overall").alias("section"), F.lit("all").alias("dataset"), *_named(F.lit(m), F.col(m)))
        for m in totals
    ))
    return report.select(F.inline(F.concat("report", overall)))


def _sections(name: str, df: DataFrame, threshold: float, mode: str) -> DataFrame:
    """The verdicts of a table's suite, its profile and, of laboratory results, the outliers by column."""
    df = normalize_missing(df)
    profile = summary_figures(df)
    aggregates = [figure.alias(f"profile_{k}") for k, figure in profile.items()]
    figures = [("profile", k, f"profile_{k}") for k in ("row_count", "columns_with_nulls", "avg_null_rate")]
    figures.append(("profile", "column_count", str(len(df.columns))))
    if name == "lab_results" and numeric_columns(df):
        for i, bounds in enumerate(fit_bounds(df, "iqr", threshold, None, mode)):
            flag = bounds.is_anomaly(as_double(df, bounds.column))
            aggregates.append(F.count_if(flag).alias(f"anomaly_{i}"))
            figures.append(("anomaly", bounds.column, f"anomaly_{i}"))
    return validate_with(df, catalog.suite_for_dataset(name), aggregates, figures)


def _named(metric: Column, value: Column) -> tuple[Column, Column]:
    return metric.alias("metric"), value.cast("double").alias("value")


def _cell(metric: Column, value: Column) -> Column:
    return F.struct(*_named(metric, value))

"""Data-quality checks: one aggregate pass per table, results as rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.labels import CLASSES, lag_status
from marketloom.functions.times import hours_since
from marketloom.operators.match import orphans
from marketloom.operators.profile import missing_columns
from marketloom.session import staged

RESULT_COLUMNS = ["check_name", "layer", "table_name", "status", "metric_value", "threshold", "message"]


@dataclass(frozen=True)
class Check:
    """One check: an aggregate and how its value becomes a status."""

    name: str
    metric: Column
    threshold: float | None
    status: Column | None = None  # over the column "value"; default: passed when it equals the threshold
    label: str = "value"


def _value() -> Column:
    return F.col("value")


def at_least(name: str, metric: Column, minimum: float) -> Check:
    return Check(name, metric, minimum, F.when(_value() >= minimum, "passed").otherwise("failed"), "rows")


def none_of(name: str, metric: Column, label: str, on_fail: str = "failed") -> Check:
    return Check(name, metric, 0.0, F.when(_value() == 0, "passed").otherwise(on_fail), label)


def min_row_count(minimum: int) -> Check:
    return at_least("min_row_count", F.count(F.lit(1)), float(minimum))


def has_rows() -> Check:
    return at_least("has_rows", F.count(F.lit(1)), 1.0)


def freshness(ts: Column, as_of: Column, good_hours: int = 48, late_hours: int = 72) -> Check:
    status = (
        F.when(_value().isNull(), "warning")
        .when(_value() <= good_hours, "passed")
        .when(_value() <= late_hours, "warning")
        .otherwise("failed")
    )
    return Check("data_freshness", hours_since(F.max(ts), as_of), float(good_hours), status, "hours since last load")


def violations(name: str, condition: Column, label: str) -> Check:
    """Rows for which the condition is true; NULL does not count."""
    return none_of(name, F.count_if(F.coalesce(condition, F.lit(False))), label)


def not_null(column: str) -> Check:
    return none_of(f"not_null_{column}", F.count_if(F.col(column).isNull()), f"nulls in {column}")


def unique_pk(column: str) -> Check:
    return none_of(
        f"unique_pk_{column}", F.count(F.lit(1)) - F.count_distinct(column), f"rows beyond distinct {column}"
    )


def no_date_gaps(column: str) -> Check:
    span = F.datediff(F.max(column), F.min(column)) + 1
    return none_of("no_date_gaps", span - F.count(F.lit(1)), "missing dates", "warning")


def run_checks(df: DataFrame, layer: str, table: str, checks: list[Check]) -> DataFrame:
    """All checks of one table from a single aggregate, unpivoted to one row per check."""
    wide = df.agg(*[c.metric.cast("double").alias(f"m{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.lit(c.name).alias("check_name"),
                F.col(f"m{i}").alias("value"),
                F.lit(c.threshold).cast("double").alias("threshold"),
                F.lit(c.label).alias("label"),
            )
            for i, c in enumerate(checks)
        ]
    )
    flat = wide.select(F.explode(rows).alias("r")).select("r.*")
    status = reduce(
        lambda acc, item: F.when(F.col("i") == item[0], item[1].status).otherwise(acc), enumerate(checks), F.lit(None)
    )
    message = F.concat(F.col("label"), F.lit(": "), F.coalesce(F.col("value").cast("bigint").cast("string"), F.lit("none")))
    return flat.select(
        "check_name",
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        status.alias("status"),
        F.col("value").alias("metric_value"),
        "threshold",
        message.alias("message"),
    )


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def no_duplicates(df: DataFrame, layer: str, table: str, keys: list[str]) -> DataFrame:
    check = none_of("no_duplicates", F.count(F.lit(1)), f"duplicate ({', '.join(keys)})")
    return run_checks(duplicate_groups(df, keys), layer, table, [check])


def referential_integrity(
    fact: DataFrame, dim: DataFrame, name: str, fact_key: str, dim_key: str, table: str
) -> DataFrame:
    check = none_of(f"fk_{name}", F.count(F.lit(1)), f"orphan {name}")
    return run_checks(orphans(fact.select(fact_key), dim, fact_key, dim_key), "gold", table, [check])


def metadata_check(
    spark, name: str, layer: str, table: str, passed: bool, message: str, status: str | None = None
) -> DataFrame:
    """A check answered from table metadata on the driver."""
    row = [(name, layer, table, status or ("passed" if passed else "failed"), None, None, message)]
    schema = "check_name string, layer string, table_name string, status string, metric_value double, threshold double, message string"
    return spark.createDataFrame(row, schema)


def table_exists(spark, df: DataFrame | None, layer: str, table: str) -> DataFrame:
    return metadata_check(
        spark, "table_exists", layer, table, df is not None, "table exists" if df is not None else "not found"
    )


def guarded(spark, layer: str, table: str, df: DataFrame | None, checks: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The results of a table's checks; a missing table is a failed row, checks that break an error row.

    The results, a few rows, are computed here, so a value that breaks a check shows up in its own table.
    """
    if df is None:
        return table_exists(spark, None, layer, table)
    try:
        return staged(checks(df), "checks")
    except PySparkException as e:
        return metadata_check(spark, "run_checks", layer, table, False, str(e).splitlines()[0][:200], "error")


def schema_check(spark, df: DataFrame, layer: str, table: str, required: list[str]) -> DataFrame:
    missing = missing_columns(df, required)
    message = f"missing: {missing}" if missing else "all columns present"
    return metadata_check(spark, "schema_check", layer, table, not missing, message)


# Layers ---------------------------------------------------------------------------------

# Minimum rows and required columns of the bronze tables.
BRONZE_RULES = {
    "historical_prices": (50, ["coin_id", "timestamp_ms", "price_usd", "market_cap_usd", "volume_24h_usd", "_ingested_at"], "_ingested_at"),
    "fear_greed_index": (10, ["value", "classification", "timestamp", "_ingested_at"], "_ingested_at"),
    "realtime_prices": (100, ["coin_id", "price_usd", "quantity", "trade_time_ms", "ingested_at"], "ingested_at"),
}


def bronze_checks(spark, tables: dict[str, DataFrame | None], as_of: Column) -> DataFrame:
    parts = []
    for name, (min_rows, required, loaded) in BRONZE_RULES.items():
        df = tables.get(name)
        parts.append(table_exists(spark, df, "bronze", name))
        if df is not None:
            parts.append(schema_check(spark, df, "bronze", name, required))
            checks = [min_row_count(min_rows), freshness(F.to_timestamp(loaded), as_of)]
            parts.append(guarded(spark, "bronze", name, df, lambda x, n=name, c=checks: run_checks(x, "bronze", n, c)))
    return _all(parts)


def silver_price_checks(prices: DataFrame, as_of: Column) -> DataFrame:
    checks = [
        violations("positive_prices", F.col("price_usd") <= 0, "price_usd <= 0"),
        not_null("coin_id"),
        not_null("price_date"),
        not_null("price_usd"),
        violations("no_future_dates", F.col("price_date") > as_of.cast("date"), "future dates"),
    ]
    return no_duplicates(prices, "silver", "daily_prices", ["coin_id", "price_date"]).unionByName(
        run_checks(prices, "silver", "daily_prices", checks)
    )


def silver_sentiment_checks(sentiment: DataFrame) -> DataFrame:
    value = F.col("fear_greed_value")
    checks = [
        violations("value_range_0_100", (value < 0) | (value > 100), "out of [0,100]"),
        violations("valid_classifications", ~F.col("classification").isin(CLASSES), "invalid classifications"),
    ]
    return run_checks(sentiment, "silver", "fear_greed", checks)


def silver_bar_checks(bars: DataFrame) -> DataFrame:
    bad = (F.col("close") <= 0) | (F.col("open") <= 0)
    return run_checks(bars, "silver", "realtime_vwap", [has_rows(), violations("positive_ohlc", bad, "non-positive OHLC")])


def gold_checks(fact: DataFrame, coins: DataFrame, dates: DataFrame) -> DataFrame:
    return _all(
        [
            run_checks(coins, "gold", "dim_coins", [unique_pk("coin_id")]),
            run_checks(dates, "gold", "dim_dates", [no_date_gaps("date_day")]),
            run_checks(fact, "gold", "fact_market_daily", [has_rows()]),
            referential_integrity(fact, coins, "coin_id", "coin_id", "coin_id", "fact_market_daily"),
            referential_integrity(fact, dates, "price_date", "price_date", "date_day", "fact_market_daily"),
        ]
    )


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gaps(times: DataFrame, column: str, unit: str) -> DataFrame:
    """Runs of days or hours that do not occur: ``first_missing``, ``last_missing``, ``missing`` (how many), ``unit``.

    A wrong date far off costs one row. The next one is looked for inside the year, and past its end among
    the first ones of the years, so no task sorts more than the steps of a year or one row a year.
    """
    at, step = F.col(column), F.expr(f"interval 1 {unit}")
    steps = times.filter(at.isNotNull()).select(column).distinct().withColumn("_year", F.year(column))
    firsts = steps.groupBy("_year").agg(F.min(column).alias("_first"))
    later = firsts.select("_year", F.lead("_first").over(Window.orderBy("_year")).alias("_later"))
    following = F.coalesce(F.lead(column).over(Window.partitionBy("_year").orderBy(column)), F.col("_later"))
    found = steps.join(later, "_year").withColumn("_next", following).filter(F.col("_next") > at + step)
    kind = dict(times.dtypes)[column]
    missing = F.timestamp_diff(unit.upper(), at, F.col("_next")) - 1
    return found.select(
        (at + step).cast(kind).alias("first_missing"), (F.col("_next") - step).cast(kind).alias("last_missing"), missing.alias("missing"), F.lit(unit).alias("unit")
    )


def filled(found: DataFrame, column: str) -> DataFrame:
    """Every step of the gaps as a row; a row of a long gap is cut at the years first."""
    year = F.explode(F.sequence(F.year("first_missing"), F.year("last_missing"))).alias("_year")
    kind = dict(found.dtypes)["first_missing"]
    first = F.greatest(F.col("first_missing"), F.make_date("_year", F.lit(1), F.lit(1)).cast(kind))
    past = F.make_date(F.col("_year") + 1, F.lit(1), F.lit(1)).cast(kind)
    step = F.expr("interval 1 day") if kind == "date" else F.expr("interval 1 hour")
    last = F.least(F.col("last_missing"), (past - step).cast(kind))
    return found.select("*", year).select(F.explode(F.sequence(first, last, step)).alias(column))


def missing_dates(dates: DataFrame, column: str = "date_day") -> DataFrame:
    """Calendar days between the first and last date that do not occur."""
    return filled(gaps(dates, column, "day"), column)


def summary(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts per status and the pass rate in percent, one decimal."""
    status = F.col("status")
    total = F.count(F.lit(1))
    return results.groupBy(*(by or ["layer"])).agg(
        total.alias("total"),
        F.count_if(status == "passed").alias("passed"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "warning").alias("warnings"),
        F.count_if(status == "error").alias("errors"),
        F.round(F.try_divide(F.count_if(status == "passed"), total) * 100, 1).alias("pass_rate"),
    )


def table_reports(results: DataFrame) -> DataFrame:
    """One report per table: success rate, number of checks, number passed."""
    passed, total = F.count_if(F.col("status") == "passed"), F.count(F.lit(1))
    return results.groupBy(F.element_at(F.split("table_name", "\\."), -1).alias("table_name")).agg(
        F.round(F.try_divide(passed, total), 3).alias("success_rate"),
        total.alias("total_expectations"),
        passed.alias("successful_expectations"),
    )


def assert_no_failures(results: DataFrame) -> None:
    """Raise when any check failed, naming the checks (a result table, a few rows per table)."""
    failed = [r["check_name"] for r in results.filter(F.col("status") == "failed").collect()]
    if failed:
        raise RuntimeError(f"{len(failed)} checks failed: {failed}")


# Expectation suites ---------------------------------------------------------------------

# The three suites.
SUITES = {
    "bronze_prices_suite": [
        {"type": "exist", "column": "coin_id"},
        {"type": "exist", "column": "price_usd"},
        {"type": "not_null", "column": "coin_id"},
        {"type": "not_null", "column": "price_usd"},
        {"type": "between", "column": "price_usd", "min": 0},
    ],
    "silver_prices_suite": [
        {"type": "exist", "column": "coin_id"},
        {"type": "exist", "column": "price_date"},
        {"type": "not_null", "column": "coin_id"},
        {"type": "not_null", "column": "price_usd"},
        {"type": "unique", "column": "coin_id", "mostly": 0.01},
        {"type": "between", "column": "price_usd", "min": 0},
    ],
    "gold_market_suite": [
        {"type": "not_null", "column": "coin_id"},
        {"type": "not_null", "column": "price_usd"},
        {"type": "between", "column": "price_usd", "min": 0.00000001},
    ],
}
PASS_RATE = 0.8


def run_suite(df: DataFrame, suite: list[dict], table: str) -> DataFrame:
    """One row per expectation with the share of rows that meet it and whether that suffices.

    Row-wise expectations share one aggregate. Uniqueness counts rows in groups of size one,
    from a grouped count. ``mostly`` is a share of the non-NULL rows (of all rows for not_null).
    Expectations on missing columns cannot run: only 'exist' reports them, the others drop out.
    """
    live = [(i, e) for i, e in enumerate(suite) if e["type"] != "exist" and e["column"] in df.columns]
    plain = [(i, e) for i, e in live if e["type"] != "unique"]
    parts = []
    metrics = [F.lit(0).alias("_none")]
    for i, e in plain:
        col = F.col(e["column"])
        if e["type"] == "not_null":
            metrics.append(F.try_divide(F.count_if(col.isNotNull()), F.count(F.lit(1))).alias(f"m{i}"))
        else:
            low, high = e.get("min"), e.get("max")
            ok = F.lit(True)
            ok = ok & (col >= low) if low is not None else ok
            ok = ok & (col <= high) if high is not None else ok
            metrics.append(F.try_divide(F.count_if(ok), F.count(col)).alias(f"m{i}"))
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *metrics[1:])
    static = [(i, e) for i, e in enumerate(suite) if e["type"] == "exist"]
    structs = [_expectation(i, e, F.lit(1.0 if e["column"] in df.columns else 0.0)) for i, e in static]
    structs += [_expectation(i, e, F.coalesce(F.col(f"m{i}"), F.lit(1.0))) for i, e in plain]
    parts.append(wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*"))
    for i, e in live:
        if e["type"] == "unique":
            groups = df.filter(F.col(e["column"]).isNotNull()).groupBy(e["column"]).agg(F.count(F.lit(1)).alias("n"))
            share = groups.agg(F.try_divide(F.coalesce(F.sum(F.when(F.col("n") == 1, 1)), F.lit(0)), F.sum("n")).alias("s"))
            parts.append(share.select(_expectation(i, e, F.coalesce("s", F.lit(1.0))).alias("r")).select("r.*"))
    return _all(parts).withColumn("table_name", F.lit(table))


def _expectation(i: int, e: dict, share: Column) -> Column:
    return F.struct(
        F.lit(i).alias("position"),
        F.lit(e["type"]).alias("expectation"),
        F.lit(e["column"]).alias("column_name"),
        share.cast("double").alias("met_share"),
        (share >= F.lit(float(e.get("mostly", 1.0)))).alias("success"),
    )


def suite_status(results: DataFrame) -> DataFrame:
    met = F.count_if("success") / F.count(F.lit(1))
    return results.groupBy("table_name").agg(
        F.round(met, 3).alias("success_rate"), F.when(met > PASS_RATE, "PASS").otherwise("FAIL").alias("status")
    )


# Offending rows -------------------------------------------------------------------------


def non_positive_prices(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("price_usd") <= 0).select("coin_id", "price_date", "price_usd")


def future_dates(fact: DataFrame, as_of: Column) -> DataFrame:
    return fact.filter(F.col("price_date") > as_of.cast("date")).select("coin_id", "price_date", "price_usd")


def generic_tests(fact: DataFrame, coins: DataFrame, dates: DataFrame) -> DataFrame:
    """not_null and unique tests of the star schema."""
    return _all(
        [
            run_checks(fact, "gold", "fact_market_daily", [not_null(c) for c in ("coin_id", "price_date", "price_usd")]),
            run_checks(coins, "gold", "dim_coins", [unique_pk("coin_id"), not_null("coin_id")]),
            run_checks(dates, "gold", "dim_dates", [unique_pk("date_day"), not_null("date_day")]),
        ]
    )


# Contracts ------------------------------------------------------------------------------


def schema_drift(df: DataFrame, contract: dict) -> list[str]:
    """Declared columns that are missing or have another type (table metadata only)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [
        f"{f.name}: {'missing' if f.name not in have else have[f.name].simpleString()}"
        for f in contract["schema"].fields
        if f.name not in have or have[f.name] != f.dataType
    ]


def contract_checks(df: DataFrame, contract: dict, table: str, ts: Column, as_of: Column) -> DataFrame:
    """All rules of a contract: schema, required, minimum, freshness, uniqueness, records per hour."""
    delay = contract["max_delay_seconds"]
    lag = F.unix_seconds(as_of) - F.unix_seconds(F.max(ts))
    fresh = Check(
        "freshness", lag, float(delay), F.when(_value() <= delay, "passed").otherwise("failed"), "seconds behind"
    )
    checks = [not_null(c) for c in contract["not_null"]]
    checks += [violations(f"minimum_{c}", F.col(c) < m, f"{c} below {m}") for c, m in contract["minimum"].items()]
    out = run_checks(df, "contract", table, [*checks, fresh])
    if "unique" in contract:
        out = out.unionByName(no_duplicates(df, "contract", table, contract["unique"]))
    if "min_records_per_hour" in contract:
        thin = none_of("records_per_hour", F.count(F.lit(1)), f"hours under {contract['min_records_per_hour']} records")
        out = out.unionByName(run_checks(thin_hours(df, contract["min_records_per_hour"]), "contract", table, [thin]))
    drift = schema_drift(df, contract)
    message = f"drift: {drift}" if drift else "as declared"
    return out.unionByName(metadata_check(df.sparkSession, "schema", "contract", table, not drift, message))


def thin_hours(trades: DataFrame, minimum: int) -> DataFrame:
    """Hours with fewer records than the contract demands, hours without any included.

    Empty hours between the first and the last one come from the gaps.
    """
    counts = trades.groupBy(F.date_trunc("hour", F.timestamp_millis("trade_time_ms")).alias("hour")).agg(
        F.count(F.lit(1)).alias("records")
    )
    thin = counts.filter(F.col("hour").isNotNull() & (F.col("records") < minimum))
    empty = filled(gaps(counts, "hour", "hour"), "hour").withColumn("records", F.lit(0).cast("long"))
    return thin.unionByName(empty) if minimum > 0 else thin


def ingestion_lag(tables: dict[str, tuple[DataFrame, Column]], as_of: Column) -> DataFrame:
    """Newest load per layer against ``as_of``: OK under 300 s, else DELAYED, EMPTY without rows."""
    parts = []
    for layer, (df, ts) in tables.items():
        lag = (F.unix_millis(as_of) - F.unix_millis(F.col("latest"))) / F.lit(1000.0)
        parts.append(
            df.agg(F.max(ts).alias("latest")).select(
                F.lit(layer).alias("layer"),
                "latest",
                F.round(lag, 1).alias("lag_seconds"),
                lag_status(lag).alias("status"),
            )
        )
    return _all(parts)

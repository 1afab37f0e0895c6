"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.dates import midnight, shift_to_utc
from barloom.operators import clean, distributions, indicators, select, smoothing
from barloom.operators.append import missing_from_stored, newer_than_latest, newer_than_stored
from barloom.operators.forecast import beside_actual, forecast_additive, forecast_baseline
from barloom.operators.sketches import approx_box_stats
from barloom.plans import flows
from barloom.plans.settings import (
    AS_OF,
    BUDGET_MB,
    EMPTY_ANSWER,
    ENDPOINT,
    GAP_EVERY,
    HISTORY_END,
    LANDINGS,
    LATENESS,
    MORE_ROWS_THAN,
    NEW_TICKER,
    PERIODS,
    RANGE_END,
    RANGE_START,
    WORKERS,
)
from barloom.session import shared_folder
from barloom.sources import listing
from barloom.sources.payloads import flatten_payloads, pack_payloads, rejected_elements, rejected_payloads
from barloom.sources.stored import dataset_megabytes, export_arrays, export_json, read_json
from barloom.sources.tables import order_bars, supplier_bars, table
from barloom.streaming.append import append_batch, append_stream, read_latest, read_sketches, stored_bars
from barloom.streaming.slices import append_on_time, weekly_slices

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def on_grid(df: DataFrame, *columns: str) -> DataFrame:
    """Round to multiples of 1/4096: means of decimal prices hardly ever lie halfway between two of them."""
    return df.withColumns({c: F.round(F.col(c) * 4096) / 4096 for c in columns})


def payload_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_payloads(pack_payloads(order_bars(spark, folder)))


def payload_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Among usable responses: texts that are none, and well-formed answers with a bad status."""
    events = table(spark, folder, "events")
    status = F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status")
    texts = events.select(F.lit(200).alias("status"), F.col("props").alias("payload"))
    answers = events.select(status, F.format_string(EMPTY_ANSWER, "event_type", "event_id").alias("payload"))
    return rejected_payloads(pack_payloads(order_bars(spark, folder)).unionByName(texts).unionByName(answers))


def element_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Answers with one bar each, of which four in five have a bad date, price, volume or none at all."""
    kind, number = F.col("event_id") % 5, F.col("event_id").cast("string")
    day = F.when(kind == 1, F.lit("2023-02-30")).otherwise(F.lit("2023-01-02"))
    price = F.when(kind == 2, F.lit('"x"')).otherwise(number)
    volume = F.when(kind == 3, F.lit("1.5")).otherwise(F.lit("7"))
    bar = F.concat(F.lit('{"open":'), price, F.lit(',"volume":'), volume, F.lit(',"tradingDate":"'), day, F.lit('"}'))
    payload = F.concat(F.lit('{"ticker":"'), "event_type", F.lit('","data":['), F.when(kind == 4, F.lit("null")).otherwise(bar), F.lit("]}"))
    return rejected_elements(table(spark, folder, "events").select(F.lit(200).alias("status"), payload.alias("payload")))


def kth_ticker(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "lineitem").select(F.col("l_suppkey").cast("string").alias("ticker"))
    return listing.kth_ticker(listing.universe(suppliers), 2)


def request_plan(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "lineitem").select(F.col("l_suppkey").cast("string").alias("ticker"))
    start, end = listing.recent_window(F.lit(AS_OF).cast("date"))
    dealt = listing.stripes(listing.universe(suppliers), WORKERS)
    return listing.request_plan(dealt, ENDPOINT, start, end)


def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        F.col("o_orderdate").cast("date").alias("trading_date"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_totalprice").alias("price"),
    )
    return clean.deduplicate(raw, prefer=["order_key"])


def _stored_part(bars: DataFrame) -> DataFrame:
    """What an earlier run is taken to have stored: bars of all tickers but one, up to a day."""
    return bars.where((F.col("trading_date") < F.lit(HISTORY_END).cast("date")) & (F.col("ticker") != NEW_TICKER))


def incremental_append(spark: SparkSession, folder: str) -> DataFrame:
    bars = order_bars(spark, folder)
    return newer_than_stored(bars, _stored_part(bars))


def append_missing(spark: SparkSession, folder: str) -> DataFrame:
    bars = order_bars(spark, folder)
    return missing_from_stored(bars, _stored_part(bars))


def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """Land the stored part, stream it in, land everything, stream again; the result is the whole table."""
    bars = order_bars(spark, folder)
    base = shared_folder(spark, "stream-append")
    for landed in (_stored_part(bars), bars):
        pack_payloads(landed).write.mode("append").json(f"{base}/landing")
        append_stream(spark, f"{base}/landing", f"{base}/store", f"{base}/progress").awaitTermination()
    return stored_bars(spark, f"{base}/store")


def json_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Bars exported as JSON lines by ticker, as arrays to a line and as pretty arrays, read back and summed up."""
    bars, base = order_bars(spark, folder), shared_folder(spark, "json-shapes")
    export_json(bars, f"{base}/lines")
    export_arrays(bars, f"{base}/arrays")
    export_arrays(bars, f"{base}/pretty", pretty=True)
    found = []
    for shape in ("lines", "arrays", "pretty"):
        read = read_json(spark, f"{base}/{shape}", multi_line=shape == "pretty")
        there = dataset_megabytes(spark, f"{base}/{shape}").scalar() > 0
        found.append(
            read.groupBy("ticker")
            .agg(
                F.count(F.lit(1)).alias("n"), F.min("trading_date").alias("first_day"), F.max("trading_date").alias("last_day"),
                F.sum("volume").alias("volume"), F.max("high").alias("high"), F.min("low").alias("low"),
                F.max("open").alias("open"), F.min("close").alias("close"),
            )
            .select(F.lit(shape).alias("shape"), "*", there.alias("has_files"))
        )
    return found[0].unionByName(found[1]).unionByName(found[2])


def size_capped(spark: SparkSession, folder: str) -> DataFrame:
    sizes = table(spark, folder, "documents").select("doc_id", "n_chars")
    return rounded(listing.within_budget(sizes, "doc_id", "n_chars", BUDGET_MB), 6, "running_mb")


def price_range(spark: SparkSession, folder: str) -> DataFrame:
    ranged = select.price_range(order_bars(spark, folder)).select("ticker", "trading_date", "price_diff")
    return rounded(ranged, 6, "price_diff")


def period_slice(spark: SparkSession, folder: str) -> DataFrame:
    labelled = select.period_slice(order_bars(spark, folder), PERIODS)
    return labelled.select("period", "ticker", "trading_date", "open")


def period_table(spark: SparkSession, folder: str) -> DataFrame:
    """Bars labelled by a table of periods: each nation's first to last order of each year, some of them open at one end."""
    orders = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    years = orders.join(customers, "o_custkey").groupBy("nation", F.year("day").alias("year")).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    periods = years.select(
        F.concat_ws("-", "nation", "year").alias("period"),
        F.when(F.col("nation") != 3, F.col("lo")).alias("start"),
        F.when(F.col("nation") != 7, F.col("hi")).alias("end"),
    )
    labelled = select.label_periods(order_bars(spark, folder), periods)
    return labelled.groupBy("period", "ticker").agg(
        F.count(F.lit(1)).alias("n"), F.min("trading_date").alias("first_day"), F.max("trading_date").alias("last_day"), F.max("open").alias("top")
    )


def bars_between(spark: SparkSession, folder: str) -> DataFrame:
    return select.bars_between(order_bars(spark, folder), RANGE_START, RANGE_END)


def date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return clean.bounds(order_bars(spark, folder))


def series_mode(spark: SparkSession, folder: str) -> DataFrame:
    by_year = order_bars(spark, folder).withColumn("year", F.year("trading_date"))
    return clean.mode_of(by_year, "ticker", by=["year"])


def calendar_spine(spark: SparkSession, folder: str) -> DataFrame:
    return clean.calendar_spine(order_bars(spark, folder))


def calendar_fill(spark: SparkSession, folder: str) -> DataFrame:
    return clean.calendar_fill(order_bars(spark, folder))


def interpolate(spark: SparkSession, folder: str) -> DataFrame:
    return on_grid(clean.interpolate(clean.to_long(order_bars(spark, folder))), "y")


def prepare_series(spark: SparkSession, folder: str) -> DataFrame:
    return on_grid(clean.prepare_series(order_bars(spark, folder)), "y")


def attr_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    return clean.to_long(order_bars(spark, folder))


def train_valid_split(spark: SparkSession, folder: str) -> DataFrame:
    filled = clean.calendar_fill(order_bars(spark, folder)).select("ticker", "trading_date", "close")
    return select.train_valid_split(filled)


def split_except(spark: SparkSession, folder: str) -> DataFrame:
    bars = order_bars(spark, folder)
    train = select.train_valid_split(bars).where(F.col("part") == "train").drop("part")
    return select.rows_not_in(bars, train)


def long_enough(spark: SparkSession, folder: str) -> DataFrame:
    return clean.long_enough(supplier_bars(spark, folder), MORE_ROWS_THAN).select("ticker", "trading_date", "close")


def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return select.first_rows(order_bars(spark, folder), 5).select("ticker", "trading_date", "close")


def _returns(bars: DataFrame) -> DataFrame:
    out = indicators.returns(bars).select("ticker", "trading_date", "close", "returns", "cumulative_return")
    return rounded(out, 6, "returns", "cumulative_return")


def _panel(bars: DataFrame) -> DataFrame:
    return rounded(rounded(indicators.indicator_panel(bars), 4, "ma20", "ma150"), 2, "lower_band", "upper_band")


def returns(spark: SparkSession, folder: str) -> DataFrame:
    return _returns(order_bars(spark, folder))


def supplier_returns(spark: SparkSession, folder: str) -> DataFrame:
    return _returns(supplier_bars(spark, folder))


def moving_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = indicators.moving_stats(order_bars(spark, folder))
    stats = stats.select("ticker", "trading_date", "ma20", "std20", "ma150")
    return rounded(rounded(stats, 4, "ma20", "ma150"), 2, "std20")


def bollinger(spark: SparkSession, folder: str) -> DataFrame:
    bands = indicators.bollinger(order_bars(spark, folder))
    bands = bands.select("ticker", "trading_date", "close", "ma20", "lower_band", "upper_band")
    return rounded(rounded(bands, 4, "ma20"), 2, "lower_band", "upper_band")


def indicator_panel(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(order_bars(spark, folder))


def supplier_panel(spark: SparkSession, folder: str) -> DataFrame:
    return _panel(supplier_bars(spark, folder))


def accumulation_distribution(spark: SparkSession, folder: str) -> DataFrame:
    flow = indicators.accumulation_distribution(order_bars(spark, folder))
    flow = flow.select("ticker", "trading_date", "money_flow_volume", "accumulation_distribution")
    return rounded(flow, 6, "money_flow_volume", "accumulation_distribution")


def hist_range(spark: SparkSession, folder: str) -> DataFrame:
    ranged = select.price_range(order_bars(spark, folder))
    bins = distributions.histogram(ranged, "price_diff")
    return rounded(rounded(bins, 4, "left_edge", "right_edge"), 10, "density")


def hist_returns(spark: SparkSession, folder: str) -> DataFrame:
    moves = indicators.returns(order_bars(spark, folder))
    bins = distributions.histogram(moves, "returns", bins=200, view=(-0.10, 0.10))
    return rounded(bins, 6, "left_edge", "right_edge", "density")


def _box(bars: DataFrame) -> DataFrame:
    stats = distributions.box_stats(select.price_range(bars), "price_diff")
    return rounded(stats, 4, "q1", "median", "q3", "whisker_low", "whisker_high")


def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _box(order_bars(spark, folder))


def supplier_box_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _box(supplier_bars(spark, folder))


def store_box_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Box statistics of a store of two batches, from the sketches that each append has left."""
    bars, store = supplier_bars(spark, folder), f"{shared_folder(spark, 'sketched')}/store"
    append_batch(_stored_part(bars), store, "run=q/batch=0")
    append_batch(newer_than_latest(bars, read_latest(spark, store)), store, "run=q/batch=1")
    stats = approx_box_stats(read_sketches(spark, store))
    return rounded(stats, 4, "min", "q1", "median", "q3", "max", "whisker_low", "whisker_high")


def box_outliers(spark: SparkSession, folder: str) -> DataFrame:
    # Line items have long-tailed daily ranges; the order table's ranges have hardly any outlier.
    outliers = distributions.box_outliers(select.price_range(supplier_bars(spark, folder)), "price_diff")
    return rounded(outliers, 4, "price_diff")


def _smoothed(bars: DataFrame) -> DataFrame:
    out = smoothing.savgol(select.price_range(bars)).select("ticker", "trading_date", "price_diff", "smoothed")
    return on_grid(out, "price_diff", "smoothed")


def savgol(spark: SparkSession, folder: str) -> DataFrame:
    return _smoothed(order_bars(spark, folder))


def supplier_savgol(spark: SparkSession, folder: str) -> DataFrame:
    return _smoothed(supplier_bars(spark, folder))


def _decomposed(bars: DataFrame) -> DataFrame:
    return on_grid(smoothing.seasonal_decompose(bars), "trend", "seasonal", "resid")


def seasonal_decompose(spark: SparkSession, folder: str) -> DataFrame:
    return _decomposed(order_bars(spark, folder))


def supplier_seasonal(spark: SparkSession, folder: str) -> DataFrame:
    return _decomposed(supplier_bars(spark, folder))


def seasonal_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Decomposition of closes that are missing on some days."""
    missing = F.unix_date("trading_date") % GAP_EVERY == 0
    return _decomposed(order_bars(spark, folder).withColumn("close", F.when(~missing, F.col("close"))))


def fill_missing(spark: SparkSession, folder: str) -> DataFrame:
    filled = clean.fill_missing(clean.calendar_fill(order_bars(spark, folder)), 0, ["open", "volume"])
    return filled.select("ticker", "trading_date", "open", "close", "volume")


def baseline(spark: SparkSession, folder: str) -> DataFrame:
    out = forecast_baseline(flows.regular_series(order_bars(spark, folder)))
    return rounded(out, 1, "yhat", "yhat_lower", "yhat_upper")


def additive(spark: SparkSession, folder: str) -> DataFrame:
    return forecast_additive(flows.regular_series(order_bars(spark, folder)))


def additive_line(spark: SparkSession, folder: str) -> DataFrame:
    """The additive model without change points and seasons, which is a penalised straight line."""
    regular = flows.regular_series(order_bars(spark, folder))
    out = forecast_additive(regular, change_points=0, weekly=False, yearly=False)
    return rounded(out, 1, "yhat", "yhat_lower", "yhat_upper")


def additive_bend(spark: SparkSession, folder: str) -> DataFrame:
    """The additive model with one change point and no seasons: its change of slope is 0, or shrunk by the penalty. Drawn intervals are left out."""
    regular = flows.regular_series(order_bars(spark, folder))
    out = forecast_additive(regular, ahead=True, change_points=1, weekly=False, yearly=False)
    known = [F.when(~F.col("ahead"), F.col(c)).alias(c) for c in ("yhat_lower", "yhat_upper")]
    return rounded(out.select("ticker", "attr", "ds", "yhat", *known), 1, "yhat", "yhat_lower", "yhat_upper")


def additive_validation(spark: SparkSession, folder: str) -> DataFrame:
    return flows.validate(order_bars(spark, folder), model="additive")


def forecast_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    bars = order_bars(spark, folder)
    out = beside_actual(forecast_baseline(flows.regular_series(bars)), clean.to_long(bars))
    return rounded(out, 1, "yhat", "yhat_lower", "yhat_upper")


def forecast_validation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(flows.validate(order_bars(spark, folder)), 1, "yhat", "yhat_lower", "yhat_upper")


def weekly_slice(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(weekly_slices(table(spark, folder, "events")), 2, "total")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events streamed in three landings: most in the third of the month they belong to, some one or two landings late, some twice."""
    events = table(spark, folder, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int")
    late = F.when(F.col("event_id") % 5 == 0, 1).when(F.col("event_id") % 7 == 0, 2).otherwise(0)
    first = F.least(third + late, F.lit(2))
    arrivals = F.array_distinct(F.array(first, F.when(F.col("event_id") % 3 == 0, F.least(first + 1, F.lit(2))).otherwise(first)))
    placed = events.withColumn("landing", F.explode(arrivals))
    base = shared_folder(spark, "late-rows")
    for i in range(LANDINGS):
        placed.where(F.col("landing") == i).drop("landing").write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/landing")
        append_on_time(stream, ["event_id"], f"{base}/store", f"{base}/progress", lateness=LATENESS).awaitTermination()
    return spark.read.parquet(f"{base}/store").select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


def utc_shift(spark: SparkSession, folder: str) -> DataFrame:
    local = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        "event_id",
        shift_to_utc(local).cast("timestamp_ntz").alias("utc_ts"),
        shift_to_utc(local).cast("date").alias("utc_date"),
        midnight(local).cast("timestamp_ntz").alias("day_start"),
    )


QUERIES: dict[str, Query] = {
    "bars": order_bars,
    "supplier_bars": supplier_bars,
    "payload_flatten": payload_flatten,
    "payload_rejects": payload_rejects,
    "element_rejects": element_rejects,
    "kth_ticker": kth_ticker,
    "request_plan": request_plan,
    "dedup_latest": dedup_latest,
    "incremental_append": incremental_append,
    "append_missing": append_missing,
    "stream_append": stream_append,
    "json_shapes": json_shapes,
    "size_capped": size_capped,
    "price_range": price_range,
    "period_slice": period_slice,
    "period_table": period_table,
    "bars_between": bars_between,
    "date_bounds": date_bounds,
    "series_mode": series_mode,
    "calendar_spine": calendar_spine,
    "calendar_fill": calendar_fill,
    "interpolate": interpolate,
    "prepare_series": prepare_series,
    "attr_unpivot": attr_unpivot,
    "train_valid_split": train_valid_split,
    "split_except": split_except,
    "long_enough": long_enough,
    "first_rows": first_rows,
    "returns": returns,
    "supplier_returns": supplier_returns,
    "moving_stats": moving_stats,
    "bollinger": bollinger,
    "indicator_panel": indicator_panel,
    "supplier_panel": supplier_panel,
    "accumulation_distribution": accumulation_distribution,
    "hist_range": hist_range,
    "hist_returns": hist_returns,
    "box_stats": box_stats,
    "supplier_box_stats": supplier_box_stats,
    "box_outliers": box_outliers,
    "store_box_stats": store_box_stats,
    "savgol": savgol,
    "supplier_savgol": supplier_savgol,
    "seasonal_decompose": seasonal_decompose,
    "supplier_seasonal": supplier_seasonal,
    "seasonal_gaps": seasonal_gaps,
    "fill_missing": fill_missing,
    "forecast_baseline": baseline,
    "forecast_additive": additive,
    "additive_line": additive_line,
    "additive_bend": additive_bend,
    "additive_validation": additive_validation,
    "forecast_vs_actual": forecast_vs_actual,
    "forecast_validation": forecast_validation,
    "weekly_slice": weekly_slice,
    "late_rows": late_rows,
    "utc_shift": utc_shift,
}

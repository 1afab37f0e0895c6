"""Landed API responses: decoding, flattening, rejects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.dates import day_text, trading_day
from barloom.operators.series import SEGMENT, with_segment
from barloom.schema import API_NAMES, BAR_COLUMNS

_API = {ours: theirs for theirs, ours in API_NAMES.items()}


_NUMBERS = [_API[c] for c in BAR_COLUMNS if c not in ("ticker", "trading_date")]


def _usable(landed: DataFrame) -> DataFrame:
    """Add what a response says, parsed once, and whether it is an answer: status 200 (where known), a ticker and a data array.

    A text that is no JSON, or repeats a key of an object, says nothing.
    """
    parsed = landed.withColumn("_said", F.try_parse_json("payload"))
    read = parsed.withColumn("_ticker", F.try_variant_get("_said", "$.ticker", "string")).withColumn(
        "_data", F.try_variant_get("_said", "$.data", "array<variant>")
    )
    ok = F.col("_ticker").isNotNull() & F.col("_data").isNotNull()
    if "status" in landed.columns:
        ok = ok & (F.coalesce(F.col("status"), F.lit(0)) == 200)
    return read.withColumn("_ok", F.coalesce(ok, F.lit(False)))


def _number(name: str) -> tuple[Column, Column]:
    """A field's value as its column takes it, and whether it is given but no such number: text, or a broken count of shares."""
    given = F.try_variant_get("element", f"$.{name}", "variant")
    kind = F.schema_of_variant(given)
    if name == _API["volume"]:
        right = kind == "BIGINT"
        value = F.try_variant_get(given, "$", "long")
    else:
        right = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
        value = F.try_variant_get(given, "$", "double")
    # an absent field and a null one are missing, which is allowed
    return F.when(right, value), F.coalesce(~right & given.isNotNull() & ~F.is_variant_null(given), F.lit(False))


def _elements(landed: DataFrame) -> DataFrame:
    """The array elements of usable responses with their values, and whether each is a bar.

    A bar has a date, and whatever else it gives is a number; a field that is absent or null is missing.
    """
    # an outer explode, for a filter on the answers would be pushed below them and parse each text again
    data = F.posexplode_outer(F.when(F.col("_ok"), F.col("_data"))).alias("_place", "element")
    raw = _usable(landed).select(*landed.columns, F.col("_ticker").alias("_of"), data).where(F.col("_place").isNotNull())
    stamp = F.try_variant_get("element", f"$.{_API['trading_date']}", "string")
    day = trading_day(stamp)
    numbers = {name: _number(name) for name in _NUMBERS}
    wrong = reduce(Column.__or__, [bad for _, bad in numbers.values()])
    read = raw.withColumns({f"_{name}": value for name, (value, _) in numbers.items()})
    return read.withColumn("_day", day).withColumn("_ok", F.coalesce(day.isNotNull() & ~wrong, F.lit(False)))


def flatten_payloads(landed: DataFrame) -> DataFrame:
    """Bars of all usable responses, one row per array element that is a bar."""
    taken = {"ticker": "_of", "trading_date": "_day"}
    return _elements(landed).where("_ok").select(*[F.col(taken.get(c) or f"_{_API[c]}").alias(c) for c in BAR_COLUMNS])


def rejected_payloads(landed: DataFrame) -> DataFrame:
    """Responses that are not usable, as they landed."""
    return _usable(landed).where(~F.col("_ok")).select(*landed.columns)


def rejected_elements(landed: DataFrame) -> DataFrame:
    """Array elements of usable responses that are no bars: ``ticker, element``, its text with keys as they landed, or null.

    Only a response with such an element is read a second time, for its texts.
    """
    bad = _elements(landed).where(~F.col("_ok"))
    texts = F.from_json("payload", "data array<string>")["data"]
    return bad.select(F.col("_of").alias("ticker"), F.get(texts, F.col("_place")).alias("element"))


def write_rejects(landed: DataFrame, folder: str, batch: str = "") -> None:
    """Everything of the landed responses that ``flatten_payloads`` leaves out; of one ``batch``, if there are many in a folder."""
    rejected_payloads(landed).write.mode("overwrite").json(f"{folder}/responses{batch}")
    rejected_elements(landed).write.mode("overwrite").json(f"{folder}/elements{batch}")


def pack_payloads(bars: DataFrame) -> DataFrame:
    """The reverse: responses as the API would give them for one span of days each.

    A span holds a bounded number of bars, so no response grows with its series.
    """
    element = F.struct(
        *[F.col(c).alias(_API[c]) for c in ("open", "high", "low", "close", "volume")],
        F.concat(day_text("trading_date"), F.lit("T00:00:00.000Z")).alias(_API["trading_date"]),
    )
    answers = with_segment(bars, ["ticker"], "trading_date").groupBy("ticker", SEGMENT).agg(F.collect_list(element).alias("data"))
    return answers.select(F.lit(200).alias("status"), F.to_json(F.struct("ticker", "data")).alias("payload"))

import datetime as dt
import json

import pytest
from conftest import DATA
from pyspark.errors import AnalysisException

from barloom.operators.append import latest_stored, missing_from_stored, newer_than_stored
from barloom.plans import flows
from barloom.schema import BAR, LANDED
from barloom.sources import listing, stored
from barloom.sources.payloads import flatten_payloads, pack_payloads, rejected_elements, rejected_payloads
from barloom.sources.tables import order_bars


def bar(day, **more):
    return {"open": 1.5, "high": 2.0, "low": 1.0, "close": 1.75, "volume": 10, "tradingDate": f"{day}T00:00:00.000Z", **more}


@pytest.fixture
def landed(spark):
    good = json.dumps({"ticker": "A", "data": [bar("2022-12-30"), bar("2023-01-02", open=2, volume=3_000_000_000)]})
    rows = [
        (200, good),
        (200, json.dumps({"ticker": "B", "data": None})),
        (200, "not json"),
        (200, json.dumps({"ticker": "C", "data": []})),
        (500, json.dumps({"ticker": "D", "data": [bar("2023-01-02")]})),
        (None, None),
    ]
    return spark.createDataFrame(rows, LANDED)


def test_flatten(landed):
    rows = flatten_payloads(landed).orderBy("trading_date").collect()
    assert [(r.ticker, r.trading_date, r.open, r.volume) for r in rows] == [
        ("A", dt.date(2022, 12, 30), 1.5, 10),
        ("A", dt.date(2023, 1, 2), 2.0, 3_000_000_000),
    ]


def test_rejects(landed):
    rejected = rejected_payloads(landed).collect()
    assert len(rejected) == 4
    assert {r.status for r in rejected} == {200, 500, None}


def test_every_element_is_a_bar_or_a_reject(spark):
    good = [bar("2023-01-02"), {"tradingDate": "2023-01-03"}, bar("2023-01-04", open=None)]
    bad = [bar("2023-02-30"), bar("2023-01-05", open="x"), bar("2023-01-06", volume=1.5), bar("2023-01-07", high="NaN"),
           bar("2023-01-08", low="Infinity"), {"open": 1.0}, None, 5]
    text = json.dumps({"ticker": "A", "data": good + bad})
    whole = spark.createDataFrame([(200, text), (200, '{"ticker":"B","data":[{"open":NaN}]}')], LANDED)
    assert flatten_payloads(whole).count() == len(good)
    rejected = rejected_elements(whole)
    assert rejected.count() == len(bad)
    assert {r.ticker for r in rejected.collect()} == {"A"}
    assert [r.payload[:14] for r in rejected_payloads(whole).collect()] == ['{"ticker":"B",']


def test_kinds_of_values(spark):
    """Numbers are numbers, texts are not; whole shares only; numbers as a ticker, other keys and their order do not matter."""
    texts = [
        '{"zz":[{"a":1}],"data":[{"volume":7,"tradingDate":"2023-01-02","open":1e2,"extra":{"k":[1]}}],"ticker":5}',
        '{"ticker":"A","data":[{"tradingDate":"2023-01-03","volume":"7"},{"tradingDate":"2023-01-04","open":"2"},{"tradingDate":"2023-01-05","open":true},'
        '{"tradingDate":"2023-01-06","volume":99999999999999999999},{"tradingDate":"2023-01-07","open":99999999999999999999},[1],"x"]}',
        '{"ticker":"B","data":[{"tradingDate":"2023-01-08","close":{"v":1}},{"tradingDate":20230109},{"tradingDate":null,"open":1}]}',
        '{"ticker":"C","data":{"tradingDate":"2023-01-02"}}', '{"data":[]}', '{"ticker":null,"data":[]}', "[]", "", '{"ticker":"D"',
    ]
    landed = spark.createDataFrame([(200, t) for t in texts], LANDED)
    got = sorted((r.ticker, str(r.trading_date), r.open, r.volume) for r in flatten_payloads(landed).collect())
    assert got == [("5", "2023-01-02", 100.0, 7), ("A", "2023-01-07", 1e20, None)]
    rejected = sorted((r.ticker, r.element) for r in rejected_elements(landed).collect())
    assert len(rejected) == 9 and ("A", "[1]") in rejected and ("A", '{"tradingDate":"2023-01-03","volume":"7"}') in rejected
    assert rejected_payloads(landed).count() == 6


def test_a_response_is_parsed_once(spark):
    landed = spark.createDataFrame([(200, "{}")], LANDED)
    plan = flatten_payloads(landed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and "from_json" not in plan and "get_json_object" not in plan


def test_stored_numbers_are_finite(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame([("A", dt.date(2023, 1, 2), nan, inf, -inf, 1.0, 5)], BAR)
    stored.append_bars(frame, str(tmp_path / "p"))
    assert tuple(stored.read_parquet(spark, str(tmp_path / "p")).first())[2:] == (None, None, None, 1.0, 5)
    (tmp_path / "j").write_text('{"ticker":"A","tradingDate":"2023-01-02","open":"NaN","close":1.0}')
    row = stored.read_json(spark, str(tmp_path / "j")).first()
    assert row.open is None and row.close is None or row.close == 1.0


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/New_York"])
def test_day_does_not_depend_on_time_zone(spark, landed, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert flatten_payloads(landed).agg({"trading_date": "min"}).first()[0] == dt.date(2022, 12, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_pack_and_flatten(spark):
    bars = order_bars(spark, DATA)
    assert flatten_payloads(pack_payloads(bars)).exceptAll(bars).count() == 0


def test_newer_than_stored(make_bars):
    days = [dt.date(2023, 1, d) for d in (4, 5, 6)]
    new = make_bars([1.0, 2.0, 3.0], days=days).union(make_bars([9.0], ticker="NEW", days=days[:1]))
    old = make_bars([7.0], days=[days[1]])
    assert sorted((r.ticker, r.close) for r in newer_than_stored(new, old).collect()) == [("AAA", 3.0), ("NEW", 9.0)]
    assert newer_than_stored(new, old.union(newer_than_stored(new, old))).count() == 0


def test_newer_than_stored_drops_copies_and_ignores_null_dates(spark, make_bars):
    new = make_bars([1.0, 2.0])
    assert newer_than_stored(new.union(new), spark.createDataFrame([], BAR)).count() == 2
    old = spark.createDataFrame([("AAA", None, 1.0, 1.0, 1.0, 1.0, 1)], BAR)
    assert latest_stored(old).first().latest is None
    assert newer_than_stored(new, old).count() == 2


def test_missing_from_stored_fills_holes(make_bars):
    bars = make_bars([1.0, 2.0, 3.0])
    assert [r.close for r in missing_from_stored(bars, bars.where("close <> 2")).collect()] == [2.0]


def test_json_shapes(spark, tmp_path):
    lines = [
        {"close_price": 1.75, "high_price": 2, "low_price": 1.0, "open_price": 1.5, "ticker_name": "A",
         "trading_date": "2022-12-30T00:00:00.000Z", "volume": 10},
        {"close_price": 2.0, "high_price": 2, "low_price": 1.0, "open_price": 1.5, "ticker_name": "A",
         "trading_date": "2023-01-02T00:00:00.000Z", "volume": 11},
    ]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(x) for x in lines))
    (tmp_path / "array.json").write_text(json.dumps(lines))
    api = [{**bar("2022-12-30"), "ticker": "A"}, {**bar("2023-01-02", close=2.0, volume=11), "ticker": "A"}]
    (tmp_path / "pretty.json").write_text(json.dumps(api, indent=2))
    frames = [
        stored.read_json(spark, str(tmp_path / "lines.json")),
        stored.read_json(spark, str(tmp_path / "array.json")),
        stored.read_json(spark, str(tmp_path / "pretty.json"), multi_line=True),
    ]
    results = [sorted(map(tuple, f.collect())) for f in frames]
    assert results[0] == results[1] == results[2]
    assert results[0][0] == ("A", dt.date(2022, 12, 30), 1.5, 2.0, 1.0, 1.75, 10)


def test_read_or_empty(spark, tmp_path):
    missing = stored.read_or_empty(spark, str(tmp_path / "none"))
    assert missing.count() == 0 and missing.schema == BAR

    def broken(session, path):
        return session.range(1).select("no_such_column")

    with pytest.raises(AnalysisException):
        stored.read_or_empty(spark, str(tmp_path), broken)


def test_append_and_export_round_trip(spark, tmp_path, make_bars):
    bars = make_bars([1.0, 2.0], ticker="0012").union(make_bars([3.0], ticker="B B"))
    stored.append_bars(bars, str(tmp_path / "p"))
    assert stored.read_parquet(spark, str(tmp_path / "p")).exceptAll(bars).count() == 0
    stored.export_json(bars, str(tmp_path / "j"))
    again = stored.read_json(spark, str(tmp_path / "j"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, bars.collect()))
    one = stored.read_json(spark, str(tmp_path / "j")).where("ticker = 'B B'")
    assert one.count() == 1


def test_arrays_of_a_line_and_of_a_file(spark, tmp_path, make_bars):
    bars = make_bars([1.0, 2.5, 3.0], ticker="0 1", start=dt.date(2020, 12, 30)).union(make_bars([4.0], ticker="B/B"))
    for pretty in (False, True):
        stored.export_arrays(bars, str(tmp_path / str(pretty)), pretty)
        again = stored.read_json(spark, str(tmp_path / str(pretty)), multi_line=pretty)
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, bars.collect()))
    assert len(list((tmp_path / "True").rglob("*.txt"))) == 3


def test_small_appends_make_one_file_a_year_and_compact(spark, tmp_path, make_bars):
    for i in range(4):
        whole = make_bars([float(i)] * 40, ticker=f"T{i}", start=dt.date(2020, 12, 20))
        stored.append_bars(whole, str(tmp_path / "p"))
    files = sorted(str(f.parent.name) for f in (tmp_path / "p").rglob("*.parquet"))
    assert files == ["year=2020"] * 4 + ["year=2021"] * 4
    stored.compact_bars(spark, str(tmp_path / "p"), str(tmp_path / "c"))
    assert len(list((tmp_path / "c").rglob("*.parquet"))) == 2
    assert stored.read_parquet(spark, str(tmp_path / "c")).count() == 160


def test_dataset_megabytes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.bin").write_bytes(b"x" * 1024 * 1024)
    (tmp_path / "sub" / "b.bin").write_bytes(b"x" * 512 * 1024)
    assert stored.dataset_megabytes(spark, str(tmp_path)).first().megabytes == 1.5


def test_ingest_flow_appends_once(spark, tmp_path, make_bars):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    first, second = make_bars([1.0, 2.0]), make_bars([1.0, 2.0, 3.0])
    for bars, total in ((first, 2), (first, 2), (second, 3), (second, 3)):
        pack_payloads(bars).write.mode("append").json(landing)
        flows.ingest(spark, landing, store)
        assert stored.read_parquet(spark, store).count() == total


def test_ingest_writes_rejects(spark, tmp_path, make_bars, landed):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    landed.write.json(landing)
    flows.ingest(spark, landing, store)
    responses = spark.read.json(f"{store}_rejects/responses").count()
    assert responses + flatten_payloads(landed).select("ticker").distinct().count() + 1 == landed.count()


@pytest.mark.parametrize("cap_bytes", [0, 1, 50, 5000, 10**9])
def test_within_budget_equals_brute_force(spark, cap_bytes):
    sizes = [(f"f{i:04d}", (i * 37) % 11) for i in range(500)]
    files = spark.createDataFrame(sizes, "path string, bytes bigint").repartition(5)
    expected, total = [], 0
    for path, size in sizes:
        total += size
        expected.append(path)
        if total > cap_bytes:
            break
    out = listing.within_budget(files, "path", "bytes", cap_bytes / 1024 / 1024)
    assert sorted(r.path for r in out.collect()) == expected


def test_running_total_with_few_borders(spark, monkeypatch):
    rows = spark.createDataFrame([(i, 1) for i in range(300)], "id bigint, n bigint")
    from pyspark.sql import functions as F

    monkeypatch.setattr(listing, "SAMPLED", 1)
    out = listing.with_running(rows, "id", F.col("n"), "upto")
    assert [r.upto for r in out.orderBy("id").collect()] == list(range(1, 301))


def test_ranges_follow_the_shuffle_partitions(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    sizes = [r["count"] for r in listing._ranges(rows, "k", 50).groupBy("_range").count().collect()]
    assert 45 <= len(sizes) <= 50 and max(sizes) < 4 * 20_000 / 50


def test_stripes_and_kth(spark):
    tickers = [f"T{i:03d}" for i in range(50)]
    frame = spark.createDataFrame([(t,) for t in tickers[::-1]], "ticker string")
    dealt = {r.ticker: r.stripe for r in listing.stripes(frame, 8).collect()}
    for i in range(8):
        assert sorted(t for t, s in dealt.items() if s == i) == tickers[i::8]
    assert listing.kth_ticker(frame, 2).first().ticker == "T002"
    assert listing.kth_ticker(frame, 50).count() == 0


@pytest.mark.parametrize("k", [0, 1, 1499, 1500, 2998, 2999, 3000, 10**12, -1])
def test_any_place_of_a_listing(spark, monkeypatch, k):
    """Place by place the sorted listing, null first, with few rows ordered at the end."""
    monkeypatch.setattr(listing, "FEW", 50)
    tickers = [None, *sorted(f"T{i * 7919 % 100_003}" for i in range(2999))]
    frame = spark.createDataFrame([(t,) for t in tickers] * 2, "ticker string").repartition(5)
    found = listing.kth_ticker(frame, k)
    assert [r.ticker for r in found.collect()] == (tickers[k : k + 1] if k >= 0 else [])
    ordered = listing.kth_ticker(frame, 1500)._jdf.queryExecution().optimizedPlan().children().head()
    while "Sort" not in ordered.nodeName():
        ordered = ordered.children().head()
    assert "Filter" in ordered.toString()


def test_range_numbers_of_keys(spark):
    import bisect

    borders = [f"b{i:03d}" for i in range(100)]
    keys = ["", "a", "b000", "b0005", "b050", "b099", "c", None]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    for some in ([], borders[:1], borders[:7], borders[:8], borders):
        got = {r.k: r.n for r in frame.select("k", listing._range_of("k", some).alias("n")).collect()}
        assert got == {k: 0 if k is None else bisect.bisect_right(some, k) for k in keys}


def test_request_plan(spark):
    from pyspark.sql import functions as F

    tickers = spark.createDataFrame([("A",)], "ticker string")
    start, end = listing.next_slice(F.lit("2023-02-04").cast("date"))
    row = listing.request_plan(tickers, "https://bars.example/v1", start, end).first()
    assert (row.from_epoch, row.to_epoch) == (1675468800, 1675468800 + 7 * 86400)
    assert row.url == "https://bars.example/v1?ticker=A&type=stock&resolution=D&from=1675468800&to=1676073600"
    early = listing.request_plan(tickers, "x", F.lit("1000-01-01").cast("date"), end).first()
    assert early.from_epoch == int((dt.datetime(1000, 1, 1) - dt.datetime(1970, 1, 1)).total_seconds())

"""The same queries as SQL, for checking."""

from __future__ import annotations

from barloom.plans.settings import (
    AS_OF,
    BUDGET_MB,
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

ORDER_BARS = """bars as (
  select o_orderpriority as ticker, cast(o_orderdate as date) as trading_date,
         arg_min(o_totalprice, o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low,
         arg_max(o_totalprice, o_orderkey) as close, count(*) as volume
  from orders group by 1, 2)"""

SUPPLIER_BARS = """bars as (
  select cast(l_suppkey as varchar) as ticker, cast(l_shipdate as date) as trading_date,
         first(l_extendedprice order by l_orderkey, l_linenumber, l_extendedprice) as open,
         max(l_extendedprice) as high, min(l_extendedprice) as low,
         first(l_extendedprice order by l_orderkey desc, l_linenumber desc, l_extendedprice desc) as close,
         cast(sum(l_quantity) as bigint) as volume
  from lineitem group by 1, 2)"""

GAPPY_BARS = f"""{ORDER_BARS.replace("bars as", "all_bars as", 1)},
bars as (select * replace (case when date_diff('day', date '1970-01-01', trading_date) % {GAP_EVERY} = 0 then null else close end as close)
         from all_bars)"""

LONG = """long as (
  select ticker, 'close' as attr, trading_date as ds, close as y from bars
  union all select ticker, 'high', trading_date, high from bars
  union all select ticker, 'low', trading_date, low from bars
  union all select ticker, 'open', trading_date, open from bars
  union all select ticker, 'volume', trading_date, cast(volume as double) from bars)"""


def _regular(source: str, out: str) -> str:
    """CTEs that give every calendar day of each series in ``source`` a value, as table ``out``."""
    return f"""
{out}_span as (select ticker, attr, min(ds) as lo, max(ds) as hi from {source} group by 1, 2),
{out}_spine as (select ticker, attr, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as ds from {out}_span),
{out}_known as (
  select s.ticker, s.attr, s.ds, l.y, case when l.y is not null then s.ds end as k
  from {out}_spine s left join {source} l on l.ticker = s.ticker and l.attr = s.attr and l.ds = s.ds),
{out}_near as (
  select ticker, attr, ds, y,
         last_value(y ignore nulls) over p as y0, last_value(k ignore nulls) over p as d0,
         first_value(y ignore nulls) over n as y1, first_value(k ignore nulls) over n as d1
  from {out}_known
  window p as (partition by ticker, attr order by ds rows between unbounded preceding and current row),
         n as (partition by ticker, attr order by ds rows between current row and unbounded following)),
{out} as (
  select ticker, attr, ds,
         case when y is not null then y when d0 is null then y1 when d1 is null then y0
              else (y1 - y0) / date_diff('day', d0, d1) * date_diff('day', d0, ds) + y0 end as y
  from {out}_near)"""


def _line(source: str, horizon: str) -> str:
    """CTEs of the baseline forecast of ``source``, as table ``fc``; ``horizon`` gives ticker, attr, horizon."""
    return f"""
num as (select *, cast(date_diff('day', date '1970-01-01', ds) as double) as t from {source}),
line as (select ticker, attr, regr_slope(y, t) as b, regr_intercept(y, t) as a, min(ds) as lo, max(ds) as hi
         from num group by 1, 2),
wk as (select ticker, attr, dayofweek(ds) as dow, avg(y / (a + b * t)) as f
       from num join line using (ticker, attr) group by 1, 2, 3),
sd as (select ticker, attr, stddev_samp(y - (a + b * t) * f) as s
       from (select *, dayofweek(ds) as dow from num) join line using (ticker, attr)
       join wk using (ticker, attr, dow) group by 1, 2),
days as (select ticker, attr, a, b,
                cast(unnest(generate_series(lo, hi + cast(horizon as integer), interval 1 day)) as date) as ds
         from line join {horizon} using (ticker, attr)),
fc as (select d.ticker, d.attr, d.ds,
              (a + b * date_diff('day', date '1970-01-01', d.ds)) * f as yhat, 1.645 * s as half
       from days d join wk on wk.ticker = d.ticker and wk.attr = d.attr and wk.dow = dayofweek(d.ds)
       join sd on sd.ticker = d.ticker and sd.attr = d.attr)"""


FC_COLUMNS = "round(yhat, 1) as yhat, round(yhat - half, 1) as yhat_lower, round(yhat + half, 1) as yhat_upper"

BASELINE = f"with {ORDER_BARS}, {LONG}, {_regular('long', 'reg')}, hz as (select distinct ticker, attr, 56 as horizon from long), {_line('reg', 'hz')}"

PERIOD_ROWS = ", ".join(f"('{name}', date '{lo}', date '{hi}')" for name, lo, hi in PERIODS)

MOVES = """moves as (
  select *, close / lag(close) over w - 1 as r from bars window w as (partition by ticker order by trading_date))"""


def _returns(bars: str) -> str:
    return f"""with {bars}, {MOVES}
select ticker, trading_date, close, round(r, 6) as returns,
       round(case when r is not null then product(1 + r) over (
         partition by ticker order by trading_date rows between unbounded preceding and current row) end, 6) as cumulative_return
from moves"""


STATS = """stats as (
  select *, case when count(close) over s = 20 then avg(close) over s end as ma20,
         case when count(close) over s = 20 then stddev_samp(close) over s end as std20,
         case when count(close) over l = 150 and count(*) over (partition by ticker) > 150 then avg(close) over l end as ma150
  from bars
  window s as (partition by ticker order by trading_date rows between 19 preceding and current row),
         l as (partition by ticker order by trading_date rows between 149 preceding and current row))"""


def _panel(bars: str) -> str:
    return f"""with {bars}, {STATS}
select ticker, trading_date, open, close, volume, round(ma20, 4) as ma20, round(ma150, 4) as ma150,
       round(ma20 - 2 * std20, 2) as lower_band, round(ma20 + 2 * std20, 2) as upper_band from stats"""


def _histogram(values: str, value: str, bins: int) -> str:
    return f"""
lim as (select ticker, min({value}) as lo, max({value}) as hi, count({value}) as n, (max({value}) - min({value})) / {bins} as width
        from {values} group by 1),
hit as (select v.ticker, least(cast(floor(({value} - lo) / (hi - lo) * {bins}) as integer), {bins - 1}) as bin, count(*) as c
        from {values} v join lim on lim.ticker = v.ticker where {value} is not null group by 1, 2),
edge as (select ticker, cast(unnest(range({bins})) as integer) as bin, lo, n, width from lim),
hist as (select edge.ticker, edge.bin, lo + edge.bin * width as left_edge, lo + (edge.bin + 1) * width as right_edge,
                coalesce(c, 0) as count, coalesce(c, 0) / (n * width) as density
         from edge left join hit on hit.ticker = edge.ticker and hit.bin = edge.bin)"""


RANGES = "ranges as (select *, high - low as x from bars)"

FENCES = """quart as (
  select ticker, count(*) as n, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as q2, quantile_cont(x, 0.75) as q3
  from ranges group by 1),
fenced as (
  select r.ticker, r.trading_date, x, n, q1, q2, q3, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi
  from ranges r join quart on quart.ticker = r.ticker)"""


def _box(bars: str) -> str:
    return f"""with {bars}, {RANGES}, {FENCES}
select ticker, any_value(n) as n, round(any_value(q1), 4) as q1, round(any_value(q2), 4) as median, round(any_value(q3), 4) as q3,
       round(least(min(x) filter (where x >= lo), any_value(q1)), 4) as whisker_low,
       round(greatest(max(x) filter (where x <= hi), any_value(q3)), 4) as whisker_high,
       count(*) filter (where x < lo or x > hi) as n_outliers
from fenced group by 1"""


def _smoothed(bars: str) -> str:
    """Window 31, degree 3, from the discrete orthogonal polynomials on -15..15."""
    return f"""with {bars}, {RANGES},
poly as (select x, 1.0::double as p0, x::double as p1, (x * x - 80)::double as p2, x * x * x - 719 * x / 5.0::double as p3
         from (select cast(unnest(range(-15, 16)) as integer) as x)),
norm as (select sum(p0 * p0) as n0, sum(p1 * p1) as n1, sum(p2 * p2) as n2, sum(p3 * p3) as n3 from poly),
hat as (
  select a.x as j, list(a.p0 * b.p0 / n0 + a.p1 * b.p1 / n1 + a.p2 * b.p2 / n2 + a.p3 * b.p3 / n3 order by b.x) as w
  from poly a, poly b, norm group by a.x),
hats as (select list(w order by j) as rows from hat),
seq as (
  select ticker, trading_date, x, row_number() over (partition by ticker order by trading_date) as p,
         count(*) over (partition by ticker) as n,
         list(x) over (partition by ticker order by trading_date rows between 30 preceding and 30 following) as near from ranges),
place as (select *, greatest(1, least(p - 15, n - 30)) as first from seq)
select ticker, trading_date, round(x * 4096) / 4096 as price_diff,
       case when n > 31 then round(list_dot_product(list_slice(near, first - greatest(1, p - 30) + 1, first - greatest(1, p - 30) + 31),
                                                    rows[p - first + 1]) * 4096) / 4096 end as smoothed
from place, hats"""


def _decomposed(bars: str) -> str:
    return f"""with {bars},
seq as (select ticker, trading_date, close, row_number() over (partition by ticker order by trading_date) as p,
               count(*) over (partition by ticker) as n from bars),
tr as (select *, case when n >= 60 and count(close) over (w rows between 14 preceding and 14 following) = 29 then
         (sum(close) over (w rows between 14 preceding and 14 following)
          + 0.5 * (lag(close, 15) over w + lead(close, 15) over w)) / 30 end as trend
       from seq window w as (partition by ticker order by p)),
ph as (select ticker, (p - 1) % 30 as phase, avg(close - trend) as m from tr group by 1, 2),
ce as (select ticker, phase, m - avg(m) over (partition by ticker) as seasonal from ph)
select tr.ticker, tr.trading_date, tr.close, round(trend * 4096) / 4096 as trend, round(seasonal * 4096) / 4096 as seasonal,
       round((close - trend - seasonal) * 4096) / 4096 as resid
from tr join ce on ce.ticker = tr.ticker and ce.phase = (tr.p - 1) % 30"""


ORACLE: dict[str, str] = {
    "bars": f"with {ORDER_BARS} select * from bars",
    "supplier_bars": f"with {SUPPLIER_BARS} select * from bars",
    "payload_flatten": f"with {ORDER_BARS} select * from bars",
    "stream_append": f"with {ORDER_BARS} select * from bars",
    "request_plan": f"""
with t as (select distinct cast(l_suppkey as varchar) as ticker from lineitem),
e as (select ticker, cast((row_number() over (order by ticker) - 1) % {WORKERS} as integer) as stripe,
             cast(epoch(date '{AS_OF}' - 25) as bigint) as from_epoch, cast(epoch(date '{AS_OF}') as bigint) as to_epoch from t)
select ticker, stripe, from_epoch, to_epoch,
       '{ENDPOINT}?ticker=' || ticker || '&type=stock&resolution=D&from=' || from_epoch || '&to=' || to_epoch as url from e""",
    "payload_rejects": """
select 200 as status, props as payload from events
union all
select 500, printf('{"ticker":"%s-%d","data":[]}', event_type, event_id) from events where event_type = 'error'""",
    "element_rejects": """
select event_type as ticker,
       case when event_id % 5 <> 4 then
         '{"open":' || case when event_id % 5 = 2 then '"x"' else cast(event_id as varchar) end
         || ',"volume":' || case when event_id % 5 = 3 then '1.5' else '7' end
         || ',"tradingDate":"' || case when event_id % 5 = 1 then '2023-02-30' else '2023-01-02' end || '"}' end as element
from events where event_id % 5 <> 0""",
    "kth_ticker": "select distinct cast(l_suppkey as varchar) as ticker from lineitem order by ticker limit 1 offset 2",
    "append_missing": f"""
with {ORDER_BARS}, stored as (select * from bars where trading_date < date '{HISTORY_END}' and ticker <> '{NEW_TICKER}')
select * from bars where not exists (
  select 1 from stored s where s.ticker = bars.ticker and s.trading_date = bars.trading_date)""",
    "calendar_spine": f"""
with {ORDER_BARS}, span as (select ticker, min(trading_date) as lo, max(trading_date) as hi from bars group by 1)
select ticker, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as trading_date from span""",
    "dedup_latest": """
select ticker, trading_date, order_key, price from (
  select o_orderpriority as ticker, cast(o_orderdate as date) as trading_date, o_orderkey as order_key, o_totalprice as price,
         row_number() over (partition by o_orderpriority, cast(o_orderdate as date) order by o_orderkey desc) as rn
  from orders) where rn = 1""",
    "incremental_append": f"""
with {ORDER_BARS},
stored as (select * from bars where trading_date < date '{HISTORY_END}' and ticker <> '{NEW_TICKER}'),
latest as (select ticker, max(trading_date) as latest from stored group by 1)
select bars.* from bars left join latest using (ticker) where latest is null or trading_date > latest""",
    "json_shapes": f"""with {ORDER_BARS}
select shape, ticker, count(*) as n, min(trading_date) as first_day, max(trading_date) as last_day, cast(sum(volume) as bigint) as volume,
       max(high) as high, min(low) as low, max(open) as open, min(close) as close, true as has_files
from bars, (values ('lines'), ('arrays'), ('pretty')) as shapes(shape) group by 1, 2""",
    "size_capped": f"""
select doc_id, n_chars, round(upto / 1024 / 1024, 6) as running_mb from (
  select doc_id, n_chars, cast(sum(n_chars) over (order by doc_id rows between unbounded preceding and current row) as double) as upto
  from documents) where upto - n_chars <= {int(BUDGET_MB * 1024 * 1024)}""",
    "price_range": f"with {ORDER_BARS} select ticker, trading_date, round(high - low, 6) as price_diff from bars",
    "period_slice": f"""
with {ORDER_BARS}, per as (select * from (values {PERIOD_ROWS}) v(period, lo, hi))
select period, ticker, trading_date, open from bars join per on trading_date > lo and trading_date < hi""",
    "period_table": f"""with {ORDER_BARS},
years as (select c_nationkey as nation, year(o_orderdate) as year, cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi
          from orders join customer on o_custkey = c_custkey group by 1, 2),
periods as (select nation || '-' || year as period, case when nation <> 3 then lo end as lo, case when nation <> 7 then hi end as hi from years)
select period, ticker, count(*) as n, min(trading_date) as first_day, max(trading_date) as last_day, max(open) as top
from bars join periods on (lo is null or trading_date > lo) and (hi is null or trading_date < hi) group by 1, 2""",
    "bars_between": f"""
with {ORDER_BARS} select * from bars where trading_date >= date '{RANGE_START}' and trading_date < date '{RANGE_END}'""",
    "date_bounds": f"""
with {ORDER_BARS}
select ticker, min(trading_date) as first_date, max(trading_date) as last_date, count(*) as n_bars,
       min(low) as min_price, max(high) as max_price, max(volume) * 3 as volume_axis from bars group by 1""",
    "series_mode": f"""
with {ORDER_BARS}, c as (select cast(year(trading_date) as integer) as year, ticker, count(*) as n from bars group by 1, 2)
select year, ticker, n from (select *, row_number() over (partition by year order by n desc, ticker) as rn from c) where rn = 1""",
    "calendar_fill": f"""
with {ORDER_BARS}, span as (select ticker, min(trading_date) as lo, max(trading_date) as hi from bars group by 1),
spine as (select ticker, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as trading_date from span)
select s.ticker, s.trading_date, open, high, low, close, volume
from spine s left join bars b on b.ticker = s.ticker and b.trading_date = s.trading_date""",
    "interpolate": f"with {ORDER_BARS}, {LONG}, {_regular('long', 'reg')} select ticker, attr, ds, round(y * 4096) / 4096 as y from reg",
    "prepare_series": f"""
with {ORDER_BARS}, one as (select ticker, 'close' as attr, trading_date as ds, close as y from bars), {_regular('one', 'reg')}
select ds, ticker as unique_id, round(y * 4096) / 4096 as y from reg""",
    "attr_unpivot": f"with {ORDER_BARS}, {LONG} select ticker, attr, ds, y from long",
    "train_valid_split": f"""
with {ORDER_BARS}, span as (select ticker, min(trading_date) as lo, max(trading_date) as hi from bars group by 1),
spine as (select ticker, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as trading_date from span),
seq as (select s.ticker, s.trading_date, close, row_number() over (partition by s.ticker order by s.trading_date) as p,
               count(*) over (partition by s.ticker) as n
        from spine s left join bars b on b.ticker = s.ticker and b.trading_date = s.trading_date)
select ticker, trading_date, close, case when p <= n * 4 // 5 then 'train' else 'valid' end as part from seq""",
    "split_except": f"""
with {ORDER_BARS}, seq as (select *, row_number() over (partition by ticker order by trading_date) as p,
                                  count(*) over (partition by ticker) as n from bars)
select * from bars except select * exclude (p, n) from seq where p <= n * 4 // 5""",
    "long_enough": f"""
with {SUPPLIER_BARS} select ticker, trading_date, close from bars
where ticker in (select ticker from bars group by 1 having count(*) > {MORE_ROWS_THAN})""",
    "first_rows": f"""
with {ORDER_BARS} select ticker, trading_date, close from (
  select *, row_number() over (partition by ticker order by trading_date) as p from bars) where p <= 5""",
    "returns": _returns(ORDER_BARS),
    "supplier_returns": _returns(SUPPLIER_BARS),
    "moving_stats": f"""
with {ORDER_BARS}, {STATS}
select ticker, trading_date, round(ma20, 4) as ma20, round(std20, 2) as std20, round(ma150, 4) as ma150 from stats""",
    "bollinger": f"""
with {ORDER_BARS}, {STATS}
select ticker, trading_date, close, round(ma20, 4) as ma20, round(ma20 - 2 * std20, 2) as lower_band,
       round(ma20 + 2 * std20, 2) as upper_band from stats""",
    "indicator_panel": _panel(ORDER_BARS),
    "supplier_panel": _panel(SUPPLIER_BARS),
    "accumulation_distribution": f"""
with {ORDER_BARS}, f as (
  select ticker, trading_date, case when high = low then 0.0 else ((close - low) - (high - close)) / (high - low) * volume end as m from bars)
select ticker, trading_date, round(m, 6) as money_flow_volume,
       round(sum(m) over (partition by ticker order by trading_date rows between unbounded preceding and current row), 6)
         as accumulation_distribution from f""",
    "hist_range": f"""
with {ORDER_BARS}, {RANGES}, {_histogram('ranges', 'x', 10)}
select ticker, bin, round(left_edge, 4) as left_edge, round(right_edge, 4) as right_edge, count, round(density, 10) as density from hist""",
    "hist_returns": f"""
with {ORDER_BARS}, {MOVES}, {_histogram('moves', 'r', 200)}
select ticker, bin, round(left_edge, 6) as left_edge, round(right_edge, 6) as right_edge, count, round(density, 6) as density,
       right_edge >= -0.10 and left_edge <= 0.10 as in_view from hist""",
    "box_stats": _box(ORDER_BARS),
    "supplier_box_stats": _box(SUPPLIER_BARS),
    "box_outliers": f"""
with {SUPPLIER_BARS}, {RANGES}, {FENCES}
select ticker, trading_date, round(x, 4) as price_diff, case when x < lo then 'low' else 'high' end as side
from fenced where x < lo or x > hi""",
    "store_box_stats": f"""with {SUPPLIER_BARS}, {RANGES},
q as (select ticker, count(x) as n, min(x) as lo, max(x) as hi, quantile_disc(x, 0.25) as q1, quantile_disc(x, 0.5) as median,
             quantile_disc(x, 0.75) as q3 from ranges group by 1)
select q.ticker, n, round(lo, 4) as min, round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3, round(hi, 4) as max,
       round(least(min(x) filter (x >= q1 - 1.5 * (q3 - q1)), q1), 4) as whisker_low,
       round(greatest(max(x) filter (x <= q3 + 1.5 * (q3 - q1)), q3), 4) as whisker_high,
       count(*) filter (x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1)) as n_outliers
from q join ranges on ranges.ticker = q.ticker group by q.ticker, n, lo, hi, q1, median, q3""",
    "savgol": _smoothed(ORDER_BARS),
    "supplier_savgol": _smoothed(SUPPLIER_BARS),
    "seasonal_decompose": _decomposed(ORDER_BARS),
    "supplier_seasonal": _decomposed(SUPPLIER_BARS),
    "seasonal_gaps": _decomposed(GAPPY_BARS),
    "fill_missing": f"""
with {ORDER_BARS}, span as (select ticker, min(trading_date) as lo, max(trading_date) as hi from bars group by 1),
spine as (select ticker, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as trading_date from span)
select s.ticker, s.trading_date, coalesce(open, 0) as open, close, coalesce(volume, 0) as volume
from spine s left join bars b on b.ticker = s.ticker and b.trading_date = s.trading_date""",
    "forecast_baseline": f"{BASELINE} select ticker, attr, ds, {FC_COLUMNS} from fc",
    "additive_line": f"""
with {ORDER_BARS}, {LONG}, {_regular('long', 'reg')},
size as (select ticker, attr, min(ds) as lo, max(ds) as hi, greatest(date_diff('day', min(ds), max(ds)), 1) as span,
                case when max(abs(y)) > 0 then max(abs(y)) else 1 end as scale from reg group by 1, 2),
unit as (select ticker, attr, date_diff('day', lo, ds) / span as t, y / scale as z from reg join size using (ticker, attr)),
sums as (select ticker, attr, sum(t) as st, sum(z) as sz, sum(t * z) as stz,
                count(*) + pow(greatest(stddev_pop(z), 1e-6), 2) * 0.05 / 25 as a,
                sum(t * t) + pow(greatest(stddev_pop(z), 1e-6), 2) * 0.05 / 25 as c from unit group by 1, 2),
line as (select ticker, attr, (sz * c - stz * st) / (a * c - st * st) as w0, (a * stz - st * sz) / (a * c - st * st) as w1 from sums),
err as (select ticker, attr, 1.645 * sqrt(avg(pow(z - w0 - w1 * t, 2))) as half from unit join line using (ticker, attr) group by 1, 2),
days as (select *, cast(unnest(generate_series(lo, hi + 56, interval 1 day)) as date) as ds from size),
fc as (select ticker, attr, ds, (w0 + w1 * date_diff('day', lo, ds) / span) * scale as yhat, half * scale as half
       from days join line using (ticker, attr) join err using (ticker, attr))
select ticker, attr, ds, {FC_COLUMNS} from fc""",
    "additive_bend": f"""
with {ORDER_BARS}, {LONG}, {_regular('long', 'reg')},
size as (select ticker, attr, min(ds) as lo, max(ds) as hi, greatest(date_diff('day', min(ds), max(ds)), 1) as span,
                case when max(abs(y)) > 0 then max(abs(y)) else 1 end as scale from reg group by 1, 2),
unit as (select *, greatest(t - 0.8, 0) as h from (
  select ticker, attr, cast(date_diff('day', lo, ds) as double) / span as t, y / scale as z from reg join size using (ticker, attr))),
sums as (select ticker, attr, count(*) + p as a, sum(t) as b, sum(t * t) + p as c, sum(z) as m0, sum(t * z) as m1,
                sum(h) as g0, sum(h * t) as g1, sum(h * h) as hh, sum(h * z) as hz, p * 25 / 0.1 as weight
         from unit join (select ticker, attr, pow(greatest(stddev_pop(z), 1e-6), 2) * 0.05 / 25 as p from unit group by 1, 2) using (ticker, attr)
         group by ticker, attr, p),
alone as (select *, (c * m0 - b * m1) / d as z0, (a * m1 - b * m0) / d as z1, (c * g0 - b * g1) / d as h0, (a * g1 - b * g0) / d as h1
          from (select *, a * c - b * b as d from sums)),
bend as (select *, case when left_over > 1e-9 * hh and abs(pull) > weight then sign(pull) * (abs(pull) - weight) / left_over else 0 end as w2
         from (select *, hh - g0 * h0 - g1 * h1 as left_over, hz - g0 * z0 - g1 * z1 as pull from alone)),
line as (select ticker, attr, z0 - h0 * w2 as w0, z1 - h1 * w2 as w1, w2 from bend),
err as (select ticker, attr, 1.645 * sqrt(avg(pow(z - w0 - w1 * t - w2 * h, 2))) as half
        from unit join line using (ticker, attr) group by 1, 2),
days as (select *, cast(unnest(generate_series(lo, hi + 56, interval 1 day)) as date) as ds from size),
fc as (select ticker, attr, ds, (w0 + w1 * t + w2 * greatest(t - 0.8, 0)) * scale as yhat, case when ds <= hi then half * scale end as half
       from (select *, cast(date_diff('day', lo, ds) as double) / span as t from days) join line using (ticker, attr) join err using (ticker, attr))
select ticker, attr, ds, {FC_COLUMNS} from fc""",
    "forecast_vs_actual": f"""{BASELINE}
select coalesce(fc.ticker, l.ticker) as ticker, coalesce(fc.attr, l.attr) as attr, coalesce(fc.ds, l.ds) as ds,
       y, {FC_COLUMNS}, y between yhat - half and yhat + half as in_interval
from fc full outer join long l on l.ticker = fc.ticker and l.attr = fc.attr and l.ds = fc.ds""",
    "forecast_validation": f"""
with {ORDER_BARS}, {LONG},
span as (select ticker, attr, min(ds) as lo, max(ds) as hi from long group by 1, 2),
spine as (select ticker, attr, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as ds from span),
parts as (select s.ticker, s.attr, s.ds, l.y,
                 case when row_number() over w <= count(*) over (partition by s.ticker, s.attr) * 4 // 5 then 'train' else 'valid' end as part
          from spine s left join long l on l.ticker = s.ticker and l.attr = s.attr and l.ds = s.ds
          window w as (partition by s.ticker, s.attr order by s.ds)),
train as (select * from parts where part = 'train'),
{_regular('train', 'reg')},
hz as (select ticker, attr, count(*) filter (where part = 'valid') as horizon from parts group by 1, 2),
{_line('reg', 'hz')}
select parts.ticker, parts.attr, parts.ds, y, {FC_COLUMNS},
       y between yhat - half and yhat + half as in_interval, part
from parts left join fc on fc.ticker = parts.ticker and fc.attr = parts.attr and fc.ds = parts.ds""",
    "weekly_slice": """
with e as (select *, cast(date '1970-01-03' + 7 * cast(floor(date_diff('day', date '1970-01-03', cast(ts as date)) / 7.0) as integer) as date) as s
           from events)
select s as slice_start, s + 7 as slice_end, event_type, count(*) as n, round(sum(value), 2) as total from e group by s, event_type""",
    "late_rows": f"""with firsts as (
  select event_id, event_type, ts, least(least((day(ts) - 1) // 10, 2)
         + case when event_id % 5 = 0 then 1 when event_id % 7 = 0 then 2 else 0 end, {LANDINGS - 1}) as landing from events),
arrivals as (select * from firsts union select event_id, event_type, ts, least(landing + 1, {LANDINGS - 1}) from firsts where event_id % 3 = 0),
marks as (select landing, max(max(ts)) over (order by landing rows between unbounded preceding and 1 preceding) - interval '{LATENESS}' as mark
          from arrivals group by landing)
select distinct event_id, event_type, ts from arrivals join marks using (landing)
where mark is null or date_trunc('millisecond', ts) > date_trunc('millisecond', mark)""",
    "utc_shift": """
select event_id, ts - interval 7 hours as utc_ts, cast(ts - interval 7 hours as date) as utc_date,
       date_trunc('day', ts) as day_start from events""",
}

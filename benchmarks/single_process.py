"""The same results by pandas in one process, for comparison; prints one JSON line of seconds."""

from __future__ import annotations

import json
import os
import sys
import time

import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.functions.polynomial import smoothing_weights

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def _bars(frame: pd.DataFrame, ticker: str, day: str, order: list[str], price: str) -> pd.DataFrame:
    frame = frame.assign(trading_date=frame[day].dt.normalize()).sort_values(order)
    grouped = frame.groupby([ticker, "trading_date"])[price]
    out = grouped.agg(open="first", high="max", low="min", close="last", volume="count").reset_index()
    return out.rename(columns={ticker: "ticker"})


def order_bars() -> pd.DataFrame:
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate"]
    orders = pd.read_parquet(f"{FOLDER}/orders.parquet", columns=columns)
    return _bars(orders, "o_orderpriority", "o_orderdate", ["o_orderkey"], "o_totalprice")


def supplier_bars() -> pd.DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]
    lines = pd.read_parquet(f"{FOLDER}/lineitem.parquet", columns=columns)
    bars = _bars(lines, "l_suppkey", "l_shipdate", ["l_orderkey", "l_linenumber", "l_extendedprice"], "l_extendedprice")
    volume = lines.groupby(["l_suppkey", lines.l_shipdate.dt.normalize()]).l_quantity.sum()
    return bars.assign(volume=volume.to_numpy().astype("int64"))


def returns(bars: pd.DataFrame) -> pd.DataFrame:
    change = bars.groupby("ticker").close.pct_change(1)
    return bars.assign(returns=change, cumulative_return=(1 + change).groupby(bars.ticker).cumprod())


def panel(bars: pd.DataFrame) -> pd.DataFrame:
    close = bars.groupby("ticker").close
    ma20 = close.transform(lambda s: s.rolling(20).mean())
    std20 = close.transform(lambda s: s.rolling(20).std())
    ma150 = close.transform(lambda s: s.rolling(150).mean())
    return bars.assign(ma20=ma20, ma150=ma150, lower=ma20 - 2 * std20, upper=ma20 + 2 * std20)


def accumulation(bars: pd.DataFrame) -> pd.Series:
    span = bars.high - bars.low
    flow = ((2 * bars.close - bars.low - bars.high) / span.where(span != 0)).fillna(0) * bars.volume
    return flow.groupby(bars.ticker).cumsum()


def savgol(bars: pd.DataFrame) -> list[np.ndarray]:
    hat = smoothing_weights(31, 3)
    out = []
    for _, y in (bars.high - bars.low).groupby(bars.ticker):
        windows = np.lib.stride_tricks.sliding_window_view(y.to_numpy(), 31)
        out.append(np.concatenate([hat[:15] @ windows[0], windows @ hat[15], hat[16:] @ windows[-1]]))
    return out


def _fenced(bars: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    x = (bars.high - bars.low).rename("x")
    quart = x.groupby(bars.ticker).quantile([0.25, 0.5, 0.75]).unstack()
    rows = bars[["ticker", "trading_date"]].assign(x=x).join(quart, on="ticker")
    reach = 1.5 * (rows[0.75] - rows[0.25])
    return rows.assign(low=rows[0.25] - reach, high=rows[0.75] + reach), quart


def box(bars: pd.DataFrame) -> pd.DataFrame:
    rows, quart = _fenced(bars)
    inside = rows[(rows.x >= rows.low) & (rows.x <= rows.high)].groupby("ticker").x
    outside = rows[(rows.x < rows.low) | (rows.x > rows.high)].groupby("ticker").x.count()
    return quart.assign(low=inside.min(), high=inside.max(), n_outliers=outside)


def outliers(bars: pd.DataFrame) -> pd.DataFrame:
    rows, _ = _fenced(bars)
    return rows[(rows.x < rows.low) | (rows.x > rows.high)]


def histogram(bars: pd.DataFrame) -> list:
    moves = bars.groupby("ticker").close.pct_change(1)
    return [np.histogram(x.dropna(), 200) + np.histogram(x.dropna(), 200, density=True) for _, x in moves.groupby(bars.ticker)]


def fill(bars: pd.DataFrame) -> pd.DataFrame:
    return pd.concat([g.set_index("trading_date").asfreq("D") for _, g in bars.groupby("ticker")])


def decompose(bars: pd.DataFrame) -> list[pd.DataFrame]:
    weights = np.r_[0.5, np.ones(29), 0.5] / 30
    out = []
    for _, y in bars.groupby("ticker").close:
        y = y.to_numpy()
        trend = np.full(len(y), np.nan)
        if len(y) >= 60:
            trend[15:-15] = np.convolve(y, weights, "valid")
        means = np.array([np.nanmean((y - trend)[p::30]) if len(y) >= 60 else np.nan for p in range(30)])
        seasonal = np.resize(means - means.mean(), len(y))
        out.append(pd.DataFrame({"trend": trend, "seasonal": seasonal, "resid": y - trend - seasonal}))
    return out


def size_capped() -> pd.DataFrame:
    sizes = pd.read_parquet(f"{FOLDER}/documents.parquet", columns=["doc_id", "n_chars"]).sort_values("doc_id")
    upto = sizes.n_chars.cumsum()
    return sizes[upto - sizes.n_chars <= 1 << 20].assign(running_mb=upto / 2**20)


def weekly() -> pd.DataFrame:
    events = pd.read_parquet(f"{FOLDER}/events.parquet", columns=["ts", "event_type", "value"])
    return events.groupby([pd.Grouper(key="ts", freq="7D", origin="1970-01-03"), "event_type"]).value.agg(["count", "sum"])


def interpolate(bars: pd.DataFrame) -> pd.DataFrame:
    daily = [g.set_index("trading_date")[["open", "high", "low", "close", "volume"]].asfreq("D").interpolate()
             for _, g in bars.groupby("ticker")]
    return pd.concat(daily)


def main() -> None:
    steps = {
        "bars": order_bars,
        "supplier_bars": supplier_bars,
        "interpolate": lambda: interpolate(order_bars()),
        "returns": lambda: returns(order_bars()),
        "supplier_returns": lambda: returns(supplier_bars()),
        "indicator_panel": lambda: panel(order_bars()),
        "supplier_panel": lambda: panel(supplier_bars()),
        "accumulation_distribution": lambda: accumulation(order_bars()),
        "box_stats": lambda: box(order_bars()),
        "supplier_box_stats": lambda: box(supplier_bars()),
        "box_outliers": lambda: outliers(supplier_bars()),
        "hist_returns": lambda: histogram(order_bars()),
        "calendar_fill": lambda: fill(order_bars()),
        "seasonal_decompose": lambda: decompose(order_bars()),
        "supplier_seasonal": lambda: decompose(supplier_bars()),
        "size_capped": size_capped,
        "weekly_slice": weekly,
        "savgol": lambda: savgol(order_bars()),
        "supplier_savgol": lambda: savgol(supplier_bars()),
    }
    times = {}
    for name, step in steps.items():
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            step()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    print(json.dumps({"engine": "pandas", "queries": times, "folder": FOLDER}))


if __name__ == "__main__":
    main()

"""Scores, labels and flags as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Authority of sources by a part of their name, in order; weights of macro tags.
SOURCE_AUTHORITY = {
    "reuters": 1.0,
    "bloomberg": 1.0,
    "wall street journal": 0.95,
    "financial times": 0.95,
    "cnbc": 0.85,
    "associated press": 0.85,
    "marketwatch": 0.75,
    "seeking alpha": 0.55,
}
TAG_WEIGHTS = {"rate_cuts": 1.0, "earnings": 1.0, "ipo": 0.8, "gdp": 0.7, "inflation": 0.7, "funding_round": 0.7, "layoffs": 0.6, "regulation": 0.6}

#: Prominent tickers.
PROMINENT_TICKERS = [
    "AAPL", "MSFT", "NVDA", "AMZN", "GOOGL", "GOOG", "META", "TSLA", "UNH", "XOM", "JNJ", "JPM",
    "V", "PG", "MA", "HD", "CVX", "MRK", "ABBV", "PEP", "KO", "AVGO", "COST", "BAC",
    "WMT", "LLY", "MCD", "CSCO", "ACN", "CRM", "DHR", "TMO", "NEE", "ADBE", "NKE", "DIS",
    "ORCL", "VZ", "INTC", "NFLX", "IBM", "GS", "MS", "C", "WFC", "USB", "AXP", "SCHW",
    "BLK", "GE", "CAT", "DE", "MMM", "BA", "RTX", "LMT", "NOC", "GD", "HON", "SPY",
    "QQQ", "IWM", "DIA",
]

#: Regimes of the stress index, and its thresholds from stress down to slowdown.
REGIMES = ["expansion", "slowdown", "contraction", "recovery", "stress"]
STRESS, MIDDLE, SLOW = 0.65, 0.45, 0.25


def source_authority(source: Column) -> Column:
    """IND14: authority of the first known name that the source contains; 0.5 else."""
    low, out = F.lower(F.coalesce(source, F.lit(""))), None
    for key, value in SOURCE_AUTHORITY.items():
        out = F.when(low.contains(key), value) if out is None else out.when(low.contains(key), value)
    return out.otherwise(0.5)


def ticker_prominence(ticker: Column) -> Column:
    """IND15: 0.2 for blank, 1 for prominent tickers, 0.5 for others."""
    t = F.upper(F.trim(F.coalesce(ticker, F.lit(""))))
    return F.when(t == "", 0.2).when(t.isin(PROMINENT_TICKERS), 1.0).otherwise(0.5)


def tag_weight(tag: Column) -> Column:
    """IND16: weight of a macro tag; 0.4 for others."""
    out = None
    for key, value in TAG_WEIGHTS.items():
        out = F.when(tag == key, value) if out is None else out.when(tag == key, value)
    return out.otherwise(0.4)


def impact(sentiment: Column, source: Column, ticker: Column, tag: Column, spike: Column) -> Column:
    """IND13: weighted sum of sentiment's size, authority, prominence, volume spike and tag, at most 1, unrounded."""
    size = F.least(F.abs(F.coalesce(sentiment, F.lit(0.0))), F.lit(1.0))
    total = 0.25 * size + 0.20 * source_authority(source) + 0.20 * ticker_prominence(ticker) + 0.20 * F.coalesce(spike, F.lit(0.5)) + 0.15 * tag_weight(tag)
    return F.least(total, F.lit(1.0))


def regime(index: Column, three_before: Column) -> Column:
    """IND2: regime of a stress index, given its value three months before."""
    return (
        F.when(index > STRESS, "stress")
        .when((index > MIDDLE) & (index >= three_before), "contraction")
        .when(index > MIDDLE, "recovery")
        .when(index > SLOW, "slowdown")
        .when(index.isNotNull(), "expansion")
    )


def trend_report(last: Column, ahead: Column, series_id: Column, unit: Column) -> Column:
    """IND17: trend of a forecast against the last value, with the thresholds of its series or unit.

    Fixed values: the series' ids, their thresholds in percent or points, and the labels.
    """
    pct = F.try_divide(ahead - last, F.abs(last)) * 100
    step = ahead - last

    def three(change: Column, at: float, down: str) -> Column:
        return F.when(change < -at, down).when(change > at, "↑ Rising").otherwise("→ Stable")

    return (
        F.when(last.isNull() | ahead.isNull() | (last == 0), "→ Stable")
        .when(series_id == "RECPROUSM156N", F.when(ahead > 10, "⚠ Rising").when(pct > 50, "↑ Rising").otherwise("→ Low"))
        .when(series_id == "FSI", three(pct, 2, "↓ Easing"))
        .when(series_id == "VIXCLS", three(pct, 2, "↓ Calming"))
        .when(unit.isin("%", "%pts"), three(step, 0.10, "↓ Declining"))
        .otherwise(three(pct, 2, "↓ Declining"))
    )


def trend_summary(first: Column, last: Column) -> Column:
    """IND18: flat if a forecast's ends differ by less than half a percent, else up or down; a dash without both ends."""
    rel = F.abs(last - first) / (F.abs(first) + 1e-9)
    return F.when(first.isNull() | last.isNull(), "—").when(rel < 0.005, "→").when(last > first, "↑").otherwise("↓")


def direction_word(pct: Column) -> Column:
    """IND22: decline below -2 %, rise above 2 %, else hold steady."""
    return F.when(pct < -2, "decline").when(pct > 2, "rise").when(pct.isNotNull(), "hold steady")


def breach(value: Column, threshold: Column, rule: Column) -> Column:
    """IND23: whether a value is above ('above') or below ('below') its threshold; null without one."""
    return F.when(rule == "above", value > threshold).when(rule == "below", value < threshold)


def signal_flags(slope: Column, recession: Column, rate: Column, rate_before: Column) -> dict[str, Column]:
    """IND11: curve inverted, deeply inverted, recession probability high, rate rising."""
    return {"curve_inverted": slope < 0, "deep_inversion": slope < -0.5, "recession_high": recession > 20, "rate_rising": rate > rate_before}

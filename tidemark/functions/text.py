"""Text, array and JSON column expressions for articles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sectors and macro tags with their keywords, in order of precedence.
SECTOR_KEYWORDS = {
    "crypto": ["bitcoin", "ethereum", "crypto", "defi", "blockchain"],
    "energy": ["oil", "wti", "natural gas", "opec", "crude", "energy"],
    "vc": ["venture capital", "funding round", "series a", "seed round", "startup"],
    "fintech": ["fintech", "payments", "digital banking", "insurtech"],
    "banking": ["federal reserve", "fed", "bank", "interest rate", "mortgage"],
    "real_estate": ["real estate", "housing", "reit", "home price"],
    "equities": ["earnings", "stock", "shares", "ipo", "market cap", "s&p"],
    "macro": ["gdp", "inflation", "cpi", "pce", "unemployment", "recession"],
}
MACRO_TAG_KEYWORDS = {
    "rate_cuts": ["rate cut", "rate hike", "fed funds", "fomc", "basis points"],
    "earnings": ["earnings", "eps", "revenue beat", "quarterly results"],
    "layoffs": ["layoffs", "job cuts", "workforce reduction", "downsizing"],
    "inflation": ["inflation", "cpi", "pce", "price index", "deflation"],
    "gdp": ["gdp", "gross domestic", "economic growth", "recession"],
    "regulation": ["regulation", "sec", "compliance", "lawsuit", "antitrust"],
    "funding_round": ["series a", "series b", "seed round", "raised", "funding"],
    "ipo": ["ipo", "initial public offering", "direct listing", "spac"],
}


def normalize_url(url: Column, ignore_scheme: bool = False) -> Column:
    """STR1: scheme and host in lower case, no parameters, query or fragment, no slash at the end."""
    bare = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    head = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    path = F.regexp_replace(F.regexp_replace(F.substring(bare, F.char_length(head) + 1, F.char_length(bare)), r";[^/]*$", ""), r"/+$", "")
    out = F.concat(F.lower(head), path)
    return F.regexp_replace(out, r"^[a-z][a-z0-9+.-]*://", "") if ignore_scheme else out


def first_keyword(text: Column, keywords: dict[str, list[str]], default: str | None, word_boundary: bool = False) -> Column:
    """The first key one of whose keywords the lower-cased text contains."""

    def chosen(low: Column) -> Column:
        out = None
        for key, words in keywords.items():
            hit = low.rlike(r"\b(" + "|".join(words) + r")\b") if word_boundary else F.lit(False)
            for w in [] if word_boundary else words:
                hit = hit | low.contains(w)
            out = F.when(hit, key) if out is None else out.when(hit, key)
        return out.otherwise(F.lit(default).cast("string"))

    # A lambda's variable is evaluated once: the text is lower-cased once for all keywords.
    return F.transform(F.array(F.lower(text)), chosen)[0]


def classify_sector(headline: Column, ticker: Column, entities: Column, word_boundary: bool = False) -> Column:
    """STR2: sector of headline, ticker and entities together; macro by default."""
    whole = F.concat_ws(" ", F.coalesce(headline, F.lit("")), F.coalesce(ticker, F.lit("")), entities)
    return first_keyword(whole, SECTOR_KEYWORDS, "macro", word_boundary)


def classify_macro_tag(headline: Column, word_boundary: bool = False) -> Column:
    """STR3: macro tag of the headline; null by default."""
    return first_keyword(F.coalesce(headline, F.lit("")), MACRO_TAG_KEYWORDS, None, word_boundary)


def sentiment_label(score: Column, band: float = 0.05) -> Column:
    """STR4: positive above the band, negative below it, else neutral; null stays."""
    return F.when(score > band, "positive").when(score < -band, "negative").when(score.isNotNull(), "neutral")


def by_match(entities: Column) -> Column:
    """Entities by match_score from the highest on (null counts 0), equals in order."""
    keyed = F.transform(entities, lambda e, i: F.struct((-F.coalesce(e["match_score"], F.lit(0.0))).alias("s"), i.alias("i"), e.alias("e")))
    return F.transform(F.array_sort(keyed), lambda k: k["e"])


def primary_entity(entities: Column) -> Column:
    """STR5: symbol of the highest match_score (null counts 0), the first of equals."""
    return F.try_element_at(by_match(entities), F.lit(1))["symbol"]


def entity_symbols(entities: Column) -> Column:
    """STR6: symbols that aren't empty, in order."""
    return F.filter(F.transform(entities, lambda e: e["symbol"]), lambda s: s.isNotNull() & (s != ""))


def weighted_sentiment(entities: Column) -> Column:
    """STR7: mean of sentiment_score weighted by match_score, where null and 0 weigh 1; null if none has a score."""
    scored = F.filter(entities, lambda e: e["sentiment_score"].isNotNull())
    weight = lambda e: F.when(F.coalesce(e["match_score"], F.lit(0.0)) == 0, 1.0).otherwise(e["match_score"])
    top = F.aggregate(scored, F.lit(0.0), lambda acc, e: acc + e["sentiment_score"] * weight(e))
    low = F.aggregate(scored, F.lit(0.0), lambda acc, e: acc + weight(e))
    return F.when(F.size(scored) > 0, F.try_divide(top, low))


def summary(text: Column, most: int = 500) -> Column:
    """STR8: the first `most` characters."""
    return F.substring(text, 1, most)


def label_or_id(label: Column, series_id: Column) -> Column:
    """STR9: the label, else the id with spaces for underscores."""
    return F.coalesce(label, F.replace(series_id, F.lit("_"), F.lit(" ")))


def station_key(city: Column, state: Column) -> Column:
    """SRC22: city without spaces and the state in capitals."""
    return F.concat(F.replace(city, F.lit(" "), F.lit("")), F.upper(state))

"""Review scores, tolerant casts, buckets and range strings as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def non_empty(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def total_reviews(pos: Column, neg: Column) -> Column:
    """Widened first: two ints may overflow under ANSI arithmetic."""
    return pos.cast("bigint") + neg.cast("bigint")


def approval_ratio(pos: Column, neg: Column) -> Column:
    """pos / (pos + neg), null without reviews."""
    return pos / F.nullif(total_reviews(pos, neg), F.lit(0))


def percent_or_zero(part: Column, whole: Column, scale: int = 1) -> Column:
    return F.bround(F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0)), scale)


def approval_pct(pos: Column, neg: Column, scale: int = 1) -> Column:
    return percent_or_zero(pos, total_reviews(pos, neg), scale)


def wilson_lower_bound(pos: Column, neg: Column, z: float = 1.96, scale: int = 4) -> Column:
    """Lower bound of the Wilson score interval (Wilson 1927), 0 without reviews."""
    n = total_reviews(pos, neg).cast("double")
    p = pos / n
    zz = F.lit(z * z)
    centre = p + zz / (n * 2)
    margin = F.lit(z) * F.sqrt((p * (F.lit(1.0) - p) + zz / (n * 4)) / n)
    bound = (centre - margin) / (F.lit(1.0) + zz / n)
    # + 0.0 turns a rounded -0.0 into 0.0
    return F.bround(F.when(n > 0, bound).otherwise(F.lit(0.0)), scale) + F.lit(0.0)


def int_or_zero(text: Column) -> Column:
    """Whole-string integer parse: malformed or out-of-range text is 0, null stays null."""
    parsed = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))
    return F.when(text.isNotNull(), F.coalesce(parsed, F.lit(0)))


def cents_to_currency(cents: Column) -> Column:
    return cents / F.lit(100.0)


def minutes_to_hours(minutes: Column) -> Column:
    return minutes / F.lit(60.0)


def bucketize(col: Column, edges: list[float], labels: list[str], zero: str | None = None) -> Column:
    """labels[i] for the first edge above the value, the last label beyond; `zero` names exact 0."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    out = F.when(col == 0, F.lit(zero)) if zero is not None else F.when(col.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        out = out.when(col < F.lit(edge), F.lit(label))
    return out.when(col.isNotNull(), F.lit(labels[-1]))


# Price bands of the scatter report, in currency units.
PRICE_EDGES = [5.0, 15.0, 30.0]
PRICE_LABELS = ["Under $5", "$5–$15", "$15–$30", "$30+"]
PRICE_FREE = "Free"


def price_bucket(price: Column) -> Column:
    return bucketize(price, PRICE_EDGES, PRICE_LABELS, zero=PRICE_FREE)


def _range_bound(text: Column, index: int) -> Column:
    bound = F.split_part(text, F.lit(" .. "), F.lit(index))
    return F.replace(bound, F.lit(","), F.lit("")).try_cast("bigint")


def range_low(text: Column) -> Column:
    """`"20,000 .. 50,000"` -> 20000; null for text of another form."""
    return _range_bound(text, 1)


def range_high(text: Column) -> Column:
    return _range_bound(text, 2)


def _short_number(n: Column) -> Column:
    def scaled(unit: int, suffix: str) -> Column:
        return F.concat(F.floor(n / F.lit(unit)).cast("string"), F.lit(suffix))

    return (
        F.when(n >= 1_000_000, scaled(1_000_000, "M"))
        .when(n >= 1_000, scaled(1_000, "k"))
        .otherwise(n.cast("string"))
    )


def range_label(text: Column) -> Column:
    """`"20,000 .. 50,000"` -> `20k–50k`."""
    return F.concat(_short_number(range_low(text)), F.lit("–"), _short_number(range_high(text)))

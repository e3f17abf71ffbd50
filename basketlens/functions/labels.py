"""Label columns turned into numbers, and the other way round."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
]
FEEDBACK_SCORES = {"Bad": 1.0, "Average": 2.0, "Good": 3.0, "Excellent": 4.0}
INCOME_SCORES = {"Low": 1, "Medium": 2, "High": 3}


def label_code(label: Column, codes: dict) -> Column:
    """The code of a label; null for a label without one."""
    pairs = list(codes.items())
    first = F.when(label == pairs[0][0], F.lit(pairs[0][1]))
    return reduce(lambda acc, kv: acc.when(label == kv[0], F.lit(kv[1])), pairs[1:], first)


def feedback_rating(feedback: Column) -> Column:
    return label_code(feedback, FEEDBACK_SCORES)


def income_score(income: Column) -> Column:
    return label_code(F.coalesce(income, F.lit("Medium")), INCOME_SCORES)


def month_index(month: Column) -> Column:
    """1..12 from a month name or a number in any form ("1", "1.0", 1); 0 for anything else."""
    text = month.cast("string")
    number = text.try_cast("double")
    in_range = number.isin(*[float(m) for m in range(1, 13)])
    by_name = label_code(text, {name: i for i, name in enumerate(MONTH_NAMES, 1)})
    return F.coalesce(F.when(in_range, number.cast("int")), by_name, F.lit(0))


def month_name(index: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), index)


def age_group(age: Column) -> Column:
    """"30-39"; an empty string where the age is null."""
    low = (F.floor(age / 10) * 10).cast("int")
    return F.concat_ws("-", low, low + 9)


def combined_rating(ratings: Column, feedback: Column, alpha: float = 0.5) -> Column:
    return F.lit(alpha) * ratings + F.lit(1 - alpha) * feedback


# The spending above which a customer is in a tier, and the tier of all others.
SPEND_TIERS = {"VIP": 5000, "Regular": 1000}
LOWEST_TIER = "Low Spender"


def spend_tier(spending: Column) -> Column:
    (top, high), (middle, low) = SPEND_TIERS.items()
    return F.when(spending > high, top).when(spending > low, middle).otherwise(LOWEST_TIER)

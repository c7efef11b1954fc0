"""Labels for ranges: age groups, tenure segments, spend tiers, two-way labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age bounds (inclusive) and their labels.
AGE_BANDS = [(18, 25, "18-25"), (26, 35, "26-35"), (36, 50, "36-50"), (51, 65, "51-65")]
AGE_OTHER = "65+"

# Tenure bins, open on the left and closed on the right.
TENURE_BINS = [
    (0, 12, "New (0-12)"),
    (12, 24, "Growing (12-24)"),
    (24, 48, "Mature (24-48)"),
    (48, 72, "Loyal (48-72)"),
]

# Upper tenure bounds of the mart's segments, and the label above them.
TENURE_STEPS = [(12, "New"), (24, "Developing"), (48, "Established")]
TENURE_TOP = "Loyal"

# Highest decile that still earns each label.
DECILE_TIERS = [(1, "Top 10%"), (2, "Top 20%"), (3, "Top 30%"), (5, "Top 50%")]
DECILE_OTHER = "Bottom 50%"


def first_match(rules: list[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition holds, else ``default``."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(F.lit(default))


def age_band(age: Column) -> Column:
    """Age group. Ages below 18 and unknown ages fall into the last group too."""
    return first_match([(age.between(lo, hi), F.lit(name)) for lo, hi, name in AGE_BANDS], AGE_OTHER)


def tenure_bin(tenure: Column) -> Column:
    """Tenure segment by right-closed bins; tenure 0 and tenure above 72 have none."""
    return first_match([((tenure > lo) & (tenure <= hi), F.lit(name)) for lo, hi, name in TENURE_BINS])


def tenure_step(tenure: Column) -> Column:
    """Tenure segment of the mart: every value has one."""
    return first_match([(tenure <= top, F.lit(name)) for top, name in TENURE_STEPS], TENURE_TOP)


def decile_tier(decile: Column) -> Column:
    return first_match([(decile <= top, F.lit(name)) for top, name in DECILE_TIERS], DECILE_OTHER)


def two_way(column: Column, when_one: str, otherwise: str) -> Column:
    """Label of a 0/1 flag; NULL counts as 0."""
    return F.when(column == 1, when_one).otherwise(otherwise)

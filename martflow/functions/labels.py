"""Predicates and labels on single columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the address pattern. It ends in \z because Java's $ would also
# accept a trailing newline.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"

# Census regions by state name.
US_REGIONS = {
    "Northeast": [
        "Connecticut", "Maine", "Massachusetts", "New Hampshire", "New Jersey", "New York",
        "Pennsylvania", "Rhode Island", "Vermont",
    ],
    "Midwest": [
        "Illinois", "Indiana", "Iowa", "Kansas", "Michigan", "Minnesota", "Missouri", "Nebraska",
        "North Dakota", "Ohio", "South Dakota", "Wisconsin",
    ],
    "South": [
        "Alabama", "Arkansas", "Delaware", "District of Columbia", "Florida", "Georgia",
        "Kentucky", "Louisiana", "Maryland", "Mississippi", "North Carolina", "Oklahoma",
        "South Carolina", "Tennessee", "Texas", "Virginia", "West Virginia",
    ],
    "West": [
        "Alaska", "Arizona", "California", "Colorado", "Hawaii", "Idaho", "Montana", "Nevada",
        "New Mexico", "Oregon", "Utah", "Washington", "Wyoming",
    ],
}


def is_email(col: Column) -> Column:
    return col.rlike(EMAIL)


def split_name(col: Column) -> Column:
    """``first_name``, ``last_name`` and ``valid`` (true when there are exactly two words)."""
    words = F.split(F.trim(col), r"\s+")
    return F.struct(
        F.try_element_at(words, F.lit(1)).alias("first_name"),
        F.try_element_at(words, F.lit(2)).alias("last_name"),
        F.coalesce(F.size(words) == 2, F.lit(False)).alias("valid"),
    )


def banded(col: Column, bands: Iterable[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first upper bound (inclusive) that holds; null takes ``otherwise``."""
    label = F
    for upper, name in bands:
        label = label.when(col <= upper, name)
    return label.otherwise(otherwise)


def basket_size(quantity: Column, small: float = 2, medium: float = 4) -> Column:
    return banded(F.coalesce(quantity, F.lit(0)), [(small, "S"), (medium, "M")], "L")


def age_band(age: Column) -> Column:
    return banded(age, [(30, "<=30"), (40, "31-40"), (50, "41-50"), (60, "51-60")], "61+")


def region_of(col: Column, mapping: Mapping[str, Iterable[str]], otherwise: str = "Other") -> Column:
    """Which group of ``mapping`` lists the value; unknown and null take ``otherwise``."""
    label = F
    for region, members in mapping.items():
        label = label.when(col.isin(*members), region)
    return label.otherwise(otherwise)


def us_region(state: Column) -> Column:
    return region_of(state, US_REGIONS)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])

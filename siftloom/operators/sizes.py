"""Size texts: normalising, classifying into size systems, and per-system columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import first_match, joined_matches, squish

# Fixed value: plus-size markers.
PLUS = r"0XL|1XL|2XL|3XL|4XL|5XL|6XL"


@dataclass(frozen=True)
class SizeRule:
    """``system`` applies when ``pattern`` occurs and ``unless`` does not."""

    system: str
    pattern: str
    unless: str | None = None

    def condition(self, size: Column) -> Column:
        hit = size.rlike(self.pattern)
        return hit & ~size.rlike(self.unless) if self.unless else hit


# Rules in order of precedence; the first that applies names the size system.
SIZE_RULES = (
    SizeRule("one_size", r"^one-size$"),
    SizeRule("missing", r"^$"),
    SizeRule("dimensions", r"\d+\*\d+"),
    SizeRule("shoe_intl", r"CN\d+"),
    SizeRule("shoe_intl", r"EUR\d+", unless=r"\bXS\b|\bS\b|\bM\b"),
    SizeRule("shoe_us", r"^US\d+\.?\d*(,|$)"),
    SizeRule("bra", r"\d{2}[A-H]{1,2}\(\d{2}[A-H]{1,2}\)"),
    SizeRule("kids", r"\dY[,(]|\d{2}Y[,(]|IN\)"),
    SizeRule("jeans", r"W\d+ L\d+"),
    SizeRule("volume_length", r"(?i)\d+\s*(ml|m,|m$| m,| m$)|\d+\s*inch"),
    SizeRule("plus", PLUS),
    SizeRule("us_clothing", r"[A-Z]+\(\d"),
    SizeRule("us_clothing", r"^\d+\s*\([A-Z]"),
    SizeRule("eu_clothing", r"[A-Z]+\(\d{2}\)"),
    SizeRule("standard", r"\bXXS\b|\bXS\b|\bS\b|\bM\b|\bL\b|\bXL\b|\bXXL\b"),
    SizeRule("us_letter", r"^\d"),
)
UNKNOWN = "unknown"
WHOLE_TEXT = None

# Per derived column and size system the pattern whose first group is collected.
DERIVED = {
    "size_labels": {
        "us_clothing": r"([A-Z]+)\(",
        "standard": WHOLE_TEXT,
        "shoe_us": WHOLE_TEXT,
        "plus": r"([0-9]+XL)",
        "eu_clothing": r"([A-Z]+)\(",
        "kids": r"(\d+Y)",
        "us_letter": r"\(([A-Za-z/ ]+)\)",
    },
    "size_us": {
        "us_clothing": r"\(([0-9/]+)\)",
        "plus": r"\(([0-9]+)\)",
        "shoe_intl": r"US([0-9.]+)",
        "us_letter": r"(\d+)\(",
    },
    "size_eu": {
        "shoe_intl": r"(?:EUR|CN)([0-9]+)",
        "eu_clothing": r"\(([0-9]+)\)",
    },
    "dimensions_raw": {"dimensions": WHOLE_TEXT},
}
# Single values taken from jeans sizes.
JEANS = {"waist": r"W(\d+)", "inseam": r"L(\d+)"}
# Systems whose options are not counted.
UNCOUNTED = ("missing", "dimensions", "volume_length")


def normalise_size(c: Column) -> Column:
    """Squished, without blanks before ``(`` or around commas."""
    no_gap = F.regexp_replace(squish(c), r"(?U)\s*\(", "(")
    return F.regexp_replace(no_gap, r"(?U)\s*,\s*", ",")


def size_flags(size: Column) -> dict[str, Column]:
    return {"has_petite": size.rlike("Petite"), "has_tall": size.rlike(r"\bTall\b"), "has_plus": size.rlike(PLUS)}


def size_system(size: Column, rules: tuple[SizeRule, ...] = SIZE_RULES) -> Column:
    """The name of the first rule that applies; NULL sizes are missing."""
    label = F.when(size.isNull(), F.lit("missing"))
    for rule in rules:
        label = label.when(rule.condition(size), F.lit(rule.system))
    return label.otherwise(F.lit(UNKNOWN))


def derived_columns(size: Column, system: Column) -> dict[str, Column]:
    """Per-system columns; NULL outside their systems, ``''`` when nothing matches inside."""
    columns = {}
    for name, patterns in DERIVED.items():
        picked = F.when(F.lit(False), F.lit(None).cast("string"))
        for label, pattern in patterns.items():
            picked = picked.when(system == label, size if pattern is WHOLE_TEXT else joined_matches(size, pattern))
        columns[name] = picked
    for name, pattern in JEANS.items():
        columns[name] = F.when(system == "jeans", first_match(size, pattern))
    return columns


def size_count(size: Column, system: Column) -> Column:
    """Number of comma-separated options; NULL for ranges such as ``S-XL``."""
    return (F.when(system == "one_size", F.lit(1))
            .when(system.isin(*UNCOUNTED), F.lit(None).cast("int"))
            .when(size.contains("-") & ~size.contains("*"), F.lit(None).cast("int"))
            .otherwise(F.size(F.split(size, ","))))


def add_size_columns(df: DataFrame, column: str = "size", rules: tuple[SizeRule, ...] = SIZE_RULES) -> DataFrame:
    """All size columns beside the normalised size, which keeps its name."""
    size = F.col(column)
    with_system = df.withColumn(column, normalise_size(size)).select(
        "*", *[flag.alias(name) for name, flag in size_flags(size).items()], size_system(size, rules).alias("size_system"))
    system = F.col("size_system")
    return with_system.select(
        "*", *[c.alias(name) for name, c in derived_columns(size, system).items()],
        size_count(size, system).alias("size_count"))

"""Feed classifiers as ordered native rules (first match wins, plain substring match)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Substrings of the upper-cased title, first rule that hits wins.
CATASTROPHE_RULES = {
    "TropicalCyclone": ("TC ", "CYCLONE", "HURRICANE"),
    "Earthquake": ("EQ ", "EARTHQUAKE"),
    "Flood": ("FL ", "FLOOD"),
    "Drought": ("DR ", "DROUGHT"),
    "Wildfire": ("WF ", "WILDFIRE"),
    "Volcanic": ("VO ", "VOLCAN"),
}

# Substrings of the lower-cased headline, first rule that hits wins.
NEWS_RULES = {
    "Catastrophe": ("flood", "hurricane", "cyclone", "tornado", "earthquake", "wildfire", "typhoon"),
    "Cyber": ("cyber", "ransomware", "breach"),
    "Health": ("epidemic", "outbreak", "covid"),
    "Conflict": ("conflict", "war", "violence"),
}

# Substrings of the upper-cased title.
COLOUR_RULES = {"high": ("RED",), "moderate": ("ORANGE",)}

HIGH_MAGNITUDE = 6.5


def first_match(text: Column, rules: dict[str, tuple[str, ...]], default: str) -> Column:
    """Label of the first rule with a substring in the text; the default also covers NULL."""
    branches = None
    for label, needles in rules.items():
        hit = text.rlike("|".join(needles))  # the needles hold no regex characters
        branches = F.when(hit, label) if branches is None else branches.when(hit, label)
    return branches.otherwise(default)


def _text(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def catastrophe_type(title: Column | str) -> Column:
    return first_match(F.upper(_text(title)), CATASTROPHE_RULES, "Other")


def alert_colour(title: Column | str) -> Column:
    return first_match(F.upper(_text(title)), COLOUR_RULES, "low")


def news_category(title: Column | str) -> Column:
    return first_match(F.lower(_text(title)), NEWS_RULES, "General")


def earthquake_severity(magnitude: Column | str) -> Column:
    strong = F.coalesce(_text(magnitude), F.lit(0.0)) >= F.lit(HIGH_MAGNITUDE)
    return F.when(strong, "high").otherwise("moderate")

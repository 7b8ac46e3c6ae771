"""Lint flags of a claim's text, each a boolean expression over regexes that other engines share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the flag families.
IMPERIAL = r"(?i)\b\d[\d,.]*\s*(?:miles per hour|mph|miles?|feet|foot|ft|inches?|pounds?|lbs?|Fahrenheit|gallons?|yards?)\b|\bmiles per hour\b"
ABBREV_UNIT = r"\b\d[\d,.]*\s*(?:km/h|kph|km|cm|mm|kg|m/s)\b|\b\d[\d,.]*\s?m\b"
REPORTING_ANCHOR = r"^\s*[A-Z][\w.\-]+(?:\s+[A-Z][\w.\-]+){0,3}\s+(?:stated|said|says|testified|declared|announced|reported|claimed|noted|remarked|asserted|recounted|recalled)\s+that\b"
KNOTS = r"(?i)\bknots?\b"
AMERICAN = (
    r"(?i)\b(?:categoriz\w*|organiz\w*|recogniz\w*|analyz\w*|emphasiz\w*|realiz\w*|minimiz\w*|maximiz\w*|prioritiz\w*|color|colored|behavior\w*|favor\w*|honor\w*|"
    r"traveled|traveling|modeled|modeling|labeled|canceled|meters?|centers?|theaters?|maneuver\w*|aluminum|fiber)\b"
)
VAGUE = (
    r"(?i)\b(?:the video footage|video footage|the footage|the objects|these objects|those objects|the unidentified objects|the same area|the incident|the encounter|"
    r"the event|the program|the report|the document|the meeting)\b"
)
LEADING_DEICTIC = r"^\s*(?:This|These|That|Those|It|They|He|She)\b"
MEASUREMENT = r"(?i)\b\d[\d,.]*\s*(?:metres?|kilometres?|km|m|km/h|G-forces?|G|degrees?|years?|seconds?|metres? per second)\b"
# A claim is compound beyond these.
LONG, ANDS, COMMAS, MEASUREMENTS = 240, 2, 3, 3
# Fixed value: joins that carry a second assertion.
SECOND_ASSERTION = r"(?i),\s+(?:and|but|while|whereas)\s+\w+|;\s|\band also\b|\bas well as\b"

PATTERNS = {
    "imperial": IMPERIAL,
    "abbrev_unit": ABBREV_UNIT,
    "reporting_anchor": REPORTING_ANCHOR,
    "knots": KNOTS,
    "american": AMERICAN,
    "vague": VAGUE,
    "leading_deictic": LEADING_DEICTIC,
}


def compound(text: Column) -> Column:
    """Long with many joins, or with many measurements."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    joins = (count("(?i) and ") >= ANDS) | (count(",") >= COMMAS)
    return ((F.length(text) > LONG) & joins) | (count(MEASUREMENT) + count(IMPERIAL) >= MEASUREMENTS)


def flags(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    found = {name: text.rlike(pattern) for name, pattern in PATTERNS.items()} | {"compound": compound(text)}
    return {name: c.alias(name) for name, c in found.items()}


def two_assertions(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(SECOND_ASSERTION)


def totals(claims, text: str):
    """How many claims raise each flag, their number and mean length."""
    flagged = flags(F.col(text))
    return claims.agg(F.count(F.lit(1)).alias("claims"), F.avg(F.length(F.coalesce(text, F.lit("")))).alias("mean_chars"), *(F.count_if(c).alias(n) for n, c in flagged.items()))

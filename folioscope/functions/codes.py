"""Codecs and derived columns: timecodes, stems, hashes, dates, provenance, freshness, rights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import OPEN_RIGHTS, OTHER_RIGHTS

STEM = "^(.*?)\\.([0-9a-f]{8})(?:\\.(.*))?$"
TIMECODE = "^([0-9]+):([0-5][0-9]):([0-5][0-9](?:\\.[0-9]+)?)$"


def timecode(seconds: Column) -> Column:
    """HH:MM:SS.d; negative seconds are 0, tenths round half to even."""
    tenths = F.bround(F.greatest(seconds.cast("double"), F.lit(0.0)) * 10, 0).cast("long")
    return F.format_string("%02d:%02d:%02d.%d", F.floor(tenths / 36000), F.floor(tenths / 600) % 60, F.floor(tenths / 10) % 60, tenths % 10)


def parse_timecode(c: Column) -> Column:
    """Seconds, or null if the whole string is no timecode."""
    part = lambda i: F.regexp_extract(c, TIMECODE, i)
    return F.when(c.rlike(TIMECODE), part(1).try_cast("double") * 3600 + part(2).try_cast("double") * 60 + part(3).try_cast("double"))


def claim_position(location: Column) -> Column:
    """struct<axis,label,start,end> of a location: seconds, char offsets, or offsets within a labelled chapter."""
    first = F.regexp_extract(location, "^([0-9]+:[0-5][0-9]:[0-5][0-9](?:\\.[0-9]+)?)(?:-.*)?$", 1)
    last = F.regexp_extract(location, "^[0-9:.]+-([0-9]+:[0-5][0-9]:[0-5][0-9](?:\\.[0-9]+)?)$", 1)
    span = "^(char|ch([^:]*)):([0-9]+)-([0-9]+)$"
    get = lambda i: F.regexp_extract(location, span, i)
    timed = F.struct(F.lit("seconds").alias("axis"), F.lit("").alias("label"), parse_timecode(first).alias("start"), parse_timecode(last).alias("end"))
    chars = F.struct(F.when(location.startswith("char:"), "char").otherwise("chapter").alias("axis"), get(2).alias("label"), get(3).try_cast("double").alias("start"), get(4).try_cast("double").alias("end"))
    return F.when(location.rlike(span), chars).when(first != "", timed)


def span_text(start: Column, end: Column, label: Column, chapter_start: Column) -> Column:
    """'chL:s-e' relative to its chapter, or 'char:s-e'."""
    absolute = F.format_string("char:%d-%d", start, end)
    return F.when(label.isNull(), absolute).otherwise(F.concat(F.lit("ch"), label, F.format_string(":%d-%d", start - chapter_start, end - chapter_start)))


def milliseconds(c: Column) -> Column:
    """Exact: null where there is anything beyond a millisecond."""
    exact = c.try_cast("decimal(28,9)")
    return F.when(exact * 1000 == F.floor(exact * 1000), (exact * 1000).cast("bigint"))


def time_bucket(seconds: Column, width: int = 4) -> Column:
    return F.when(seconds.isNull(), F.lit(-1)).otherwise(F.floor(seconds / width) * width).cast("long")


def split_stem(stem: Column) -> Column:
    """struct<record,model_sha8 parts> of a variant's stem; one without an 8-hex segment is all record."""
    hit = stem.rlike(STEM)
    get = lambda i: F.when(hit, F.regexp_extract(stem, STEM, i)).otherwise(F.lit(""))
    return F.struct(F.when(hit, F.regexp_extract(stem, STEM, 1)).otherwise(stem).alias("head"), get(2).alias("prompt_sha8"), get(3).alias("run_label"))


def prompt_sha8(hashes: Column) -> Column:
    return F.left(F.sha2(F.concat_ws("", hashes), 256), F.lit(8))


def de_version(name: Column) -> Column:
    return F.regexp_replace(name, "\\.v[0-9]+$", "")


def iso_date(c: Column) -> Column:
    """Midnight collapses to its day; partial dates pass through."""
    return F.regexp_replace(F.trim(c), "^([0-9]{4}-[0-9]{2}-[0-9]{2})[T ]00:00(?::00(?:\\.0+)?)?(?:Z|[+-]00:?00)?$", "$1")


def attestation(kind: Column, relay: Column, declared: Column) -> Column:
    """How far the origin is from the record: by the number of relays, unattributed chains have none, no chain keeps what was declared."""
    depth = F.coalesce(F.size(relay), F.lit(0))
    return F.when(kind.isNull(), declared).when(kind == "unattributed", F.lit(None)).when((kind == "speaker") & (depth == 0), "first_hand").when(depth <= 1, "second_hand").otherwise("third_hand")


def attribution_mode(kind: Column, in_text: Column, claim_type: Column) -> Column:
    """How a claim may be attributed: never upgraded from what the text does itself."""
    return F.when(kind.isNull(), "unknown").when(in_text, "in_text").when((kind == "anonymous") | (claim_type == "hearsay"), "unknown").otherwise("bare_ok")


def generation_state(value: Column, current: Column) -> Column:
    """current, stale:<distance>, unknown or invalid."""
    number = value.try_cast("int")
    return F.when(value.isNull(), "unknown").when(number.isNull() | (number < 0) | (number > current), "invalid").when(number == current, "current").otherwise(F.concat(F.lit("stale:"), (current - number).cast("string")))


def config_state(value: Column, registered: Column) -> Column:
    return F.when(value.isNull() | (value == ""), "missing").when(~value.rlike("^[0-9a-f]{64}$"), "invalid").when(registered, "resolvable").otherwise("unregistered")


def input_state(expected: Column, actual: Column, prep: Column, current_prep: Column) -> Column:
    """The recomputed hash is compared first: only then does a version tell why it differs."""
    return F.when(actual.isNull(), "unknown").when(~expected.rlike("^[0-9a-f]{64}$"), "invalid").when(expected == actual, "current").when(prep < current_prep, "prep_version").otherwise("record_changed")


def rights(status: Column) -> Column:
    """struct<hosted,reason>."""
    ok = status.isin(*OPEN_RIGHTS)
    reason = F.when(status.isNull() | (status == ""), "absent").when(ok, F.lit(None)).when(~status.isin(*OTHER_RIGHTS), "unrecognised").otherwise(status)
    return F.struct(F.coalesce(ok, F.lit(False)).alias("hosted"), reason.alias("reason"))


def producer(creators: Column) -> Column:
    """The first creator that is neither empty nor a template."""
    return F.try_element_at(F.filter(creators, lambda c: (F.trim(c) != "") & ~c.rlike("^\\{\\{.*\\}\\}$")), F.lit(1))


def active_prompt(passes: Column) -> Column:
    """Some pass, and none overridden; ``passes`` is array<struct<version>>."""
    return (F.size(passes) > 0) & F.forall(passes, lambda p: p["version"] != "override")


def verdict(probabilities: Column, labels: Column) -> Column:
    """struct<label,score>: the first of the largest."""
    top = F.array_max(probabilities)
    return F.struct(F.element_at(labels, F.array_position(probabilities, top).cast("int")).alias("label"), F.bround(top, 3).alias("score"))


def account_id(span_start: Column, index: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(span_start), "[^a-z0-9]+", "-"), "^-|-$", "")
    return F.when(slug == "", F.concat(F.lit("account-"), index.cast("string"))).otherwise(F.concat(F.lit("account-"), slug))

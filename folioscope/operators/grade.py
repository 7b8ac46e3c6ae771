"""Grading a digest against gold, in the coordinates of the record's prepared text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import starmap

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .batches import pieces
from .spans import union_coverage
from .sweep import both_ends, sums_upto

FULL = 0.5
# Line framing that is no text, and what may close a quote.
_STAMP, _COMMENT, _CLOSING = re.compile(r"^\d\d:\d\d:\d\d\.\d+\s?"), re.compile(r"^<!--.*-->\s*$"), ".,;:!?\"' "
# white space other than single spaces within the text, and a header
_UNEVEN = re.compile(r"[^\S ]|  |^ |^#")
_ANNOTATION = re.compile(r"\{\{[^}]*\}\}")
_SPANS = "array<struct<start:bigint,end:bigint>>"


def search_map(text: str) -> tuple[str, Sequence[int]]:
    """Lowered text with collapsed white space, without line timestamps, comment lines and headers, and each character's offset in ``text``."""
    if text.isascii() and not _UNEVEN.search(text) and not _STAMP.match(text) and not _COMMENT.match(text):
        return text.lower(), range(len(text))  # nothing is collapsed or left out
    out: list[str] = []
    at: list[int] = []
    base = 0
    for line in text.splitlines(keepends=True) if "\n" in text else [text]:
        stop = base + len(line)
        if not (_COMMENT.match(line) or line.lstrip().startswith("#")):
            m = _STAMP.match(line)
            for run in re.finditer(r"\s+|\S+", line[m.end() if m else 0 :]):
                place = base + (m.end() if m else 0) + run.start()
                if run[0].isspace():
                    if out and out[-1] != " ":
                        out.append(" ")
                        at.append(place)
                    continue
                low = run[0].lower()
                if len(low) == len(run[0]) and "Σ" not in run[0]:  # a sigma's form depends on its place
                    out.extend(low)
                    at.extend(range(place, place + len(low)))
                    continue
                for k, c in enumerate(run[0]):
                    low = c.lower()
                    out.append(low)
                    at.extend([place + k] * len(low))
        base = stop
    return "".join(out), at


def normal(quote: str | None) -> str:
    return " ".join((quote or "").lower().split())


def find(quote: str, search: str, start: int = 0) -> tuple[int, int]:
    """(place, length) of a normalised quote at or after ``start``, retried without closing punctuation; place -1 if it is not there."""
    for form in (quote, quote.rstrip(_CLOSING)):
        if form and (place := search.find(form, start)) >= 0:
            return place, len(form)
    return -1, 0


def quote_spans(quote: str | None, search: str, at: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """(status, spans): contiguous; elided, its fragments in order; reordered, one of them only before its predecessor; or broken."""
    span = lambda place, n: (at[place], at[place + n - 1] + 1)
    place, n = find(normal(quote), search)
    if place >= 0:
        return "contiguous", [span(place, n)]
    parts = [normal(p) for p in re.split(r"\.\.\.|…", quote or "") if p.strip()]
    if len(parts) < 2:
        return "broken", []
    found, cursor = [], 0
    for p in parts:
        place, n = find(p, search, cursor)
        if place < 0:
            return ("reordered" if find(p, search)[0] >= 0 else "broken"), []
        found.append(span(place, n))
        cursor = place + n
    return "elided", found


def part_spans(parts: list[str], search: str, at: list[int]) -> list[tuple[int, int]]:
    """The spans of a gold unit's parts, in order; none if one of them is not there."""
    found, cursor = [], 0
    for p in parts:
        place, n = find(search_map(p)[0], search, cursor)
        if place < 0:
            return []
        found.append((at[place], at[place + n - 1] + 1))
        cursor = place + n
    return found


def _by_record(rows: DataFrame, records: DataFrame, one) -> DataFrame:
    """``rows`` with ``status`` and ``spans`` by ``one``(row, search, map): a record's text is mapped once and travels once.

    A record's rows are an array beside its text, so a batch holds many records; a task for each record alone would cost more than its search.
    """
    schema = rows.schema
    mine = rows.groupBy("record_key").agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in schema.names])).alias("_rows"))
    texts = records.groupBy(F.col("record_key").alias("_key")).agg(F.first("body").alias("body"))
    both = mine.join(texts, F.col("record_key").eqNullSafe(F.col("_key")), "left").select("body", "_rows")
    places = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (piece for batch in batches for piece in pieces(batch, 0)):
            found = []
            for body, asked in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                search, at = search_map(body or "")
                found += [one(r, search, at) for r in asked]
            status = pa.array([f[0] for f in found], pa.string())
            spans = pa.array([[{"start": s, "end": e} for s, e in f[1]] for f in found], places)
            yield pa.RecordBatch.from_arrays([*b.column(1).flatten().flatten(), status, spans], names=[*schema.names, "status", "spans"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + f", status string, spans {_SPANS}"
    return both.mapInArrow(run, shape)


def located_claims(claims: DataFrame, records: DataFrame) -> DataFrame:
    """Claims with the status and the spans of their ``quote``, in offsets of the record's text."""
    return _by_record(claims, records, lambda r, search, at: quote_spans(r["quote"], search, at))


def raw_claims(claims: DataFrame, records: DataFrame) -> DataFrame:
    """Claims with their spans in raw bodies, whose annotations are blanked to equal length before the search; all of a quote's fragments, or none."""

    def run(batches):
        for df in batches:
            yield df.assign(body=[_ANNOTATION.sub(lambda m: " " * len(m[0]), t or "") for t in df["body"]])

    return located_claims(claims, records.select("record_key", "body").mapInPandas(run, f"record_key {dict(records.dtypes)['record_key']}, body string"))


def located_gold(gold: DataFrame, records: DataFrame) -> DataFrame:
    """Gold units with the spans of their ``parts`` (array of text); a unit of which a part is not there is ``unlocatable``."""

    def one(r: dict, search: str, at: list[int]) -> tuple[str, list[tuple[int, int]]]:
        found = part_spans(list(r["parts"]) if r["parts"] is not None else [], search, at)
        return ("located" if found else "unlocatable"), found

    return _by_record(gold, records, one)


def located(quotes: DataFrame, records: DataFrame, text: str = "quote") -> DataFrame:
    """(…, start, end, status) of each contiguous quote in its record; -1 where it is broken."""
    got = located_claims(quotes.withColumn("_keep", F.col("quote") if "quote" in quotes.columns else F.lit(None).cast("string")).withColumn("quote", F.col(text)), records)
    one = F.when(F.size("spans") > 0, F.struct(F.col("spans")[0]["start"].alias("s"), F.element_at("spans", -1)["end"].alias("e")))
    out = got.withColumn("_x", one).withColumn("start", F.coalesce(F.col("_x.s"), F.lit(-1))).withColumn("end", F.col("_x.e")).withColumn("quote", F.col("_keep")).drop("_x", "_keep", "spans")
    return out if "quote" in quotes.columns else out.drop("quote")


def grade(records: DataFrame, gold: DataFrame, claims: DataFrame, closures: DataFrame | None = None) -> DataFrame:
    """One row per digest: recall, fidelity, off-target and coreference figures. Rates without a denominator are null.

    ``gold`` has (record_key, unit_id, parts), or text for units of one part; ``claims`` (digest_key, record_key, claim_id, quote[, text, refs]);
    ``closures`` (record_key, dependent, ancestor) unit ids. Recall is the mean share of a unit's characters that the union of the digest's
    claims covers; fidelity counts distinct quotes, contiguous or elided in order.
    """
    if "parts" not in gold.columns:
        gold = gold.withColumn("parts", F.array("text"))
    units = located_gold(gold.select("record_key", "unit_id", "parts"), records).persist()
    quotes = located_claims(claims, records).persist()
    digests = claims.select("digest_key", "record_key").distinct()
    parts = units.select("record_key", "unit_id", F.posexplode("spans").alias("part", "x")).select("record_key", "unit_id", F.concat_ws("/", F.col("unit_id"), F.col("part")).alias("part_id"), F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    hits = quotes.select("digest_key", "record_key", "claim_id", F.explode("spans").alias("x")).select("digest_key", "record_key", "claim_id", F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    by_part = union_coverage(parts.drop("unit_id").join(digests, "record_key"), hits.drop("claim_id"), ["digest_key", "record_key"], "part_id")
    by_unit = by_part.join(parts.select("record_key", "unit_id", "part_id"), ["record_key", "part_id"]).groupBy("digest_key", "record_key", "unit_id").agg((F.sum("covered") / F.greatest(F.lit(1), F.sum("length"))).alias("share"))
    recall = by_unit.groupBy("digest_key").agg(F.avg("share").alias("recall"), F.count_if(F.col("share") >= FULL).alias("fully_covered"), F.count(F.lit(1)).alias("units"))
    lost = units.where("status = 'unlocatable'").groupBy("record_key").agg(F.count(F.lit(1)).alias("unlocatable_gold"))
    norm = F.nullif(T.collapsed(F.lower(F.coalesce("quote", F.lit("")))), F.lit(""))
    good = F.col("status").isin("contiguous", "elided")
    state = quotes.groupBy("digest_key").agg(
        F.count(F.lit(1)).alias("claims"), F.countDistinct(norm).alias("distinct_quotes"), F.try_divide(F.countDistinct(F.when(good, norm)).cast("double"), F.countDistinct(norm)).alias("fidelity"),
        *(F.count_if(F.col("status") == s).alias(s) for s in ("contiguous", "elided", "reordered", "broken")),
    )
    gold_spans = parts.select("record_key", F.col("start").alias("g0"), F.col("end").alias("g1"), "unit_id")
    touching = hits.join(gold_spans, "record_key").where("greatest(start, g0) < least(end, g1)").select("digest_key", "record_key", "claim_id", "unit_id").distinct()
    off = quotes.where(good).join(touching.select("digest_key", "claim_id").distinct(), ["digest_key", "claim_id"], "left_anti").groupBy("digest_key").agg(F.count(F.lit(1)).alias("off_target"))
    out = digests.join(recall, "digest_key", "left").join(lost, "record_key", "left").join(state, "digest_key", "left").join(off, "digest_key", "left")
    out = out.na.fill(0, ["fully_covered", "units", "unlocatable_gold", "off_target"])
    out = out.withColumn("off_target_rate", F.try_divide(F.col("off_target").cast("double"), F.col("contiguous") + F.col("elided")))
    if closures is None:
        return out
    resolved = coreference_outcomes(gold, quotes, touching, closures).groupBy("digest_key").agg(
        F.count_if(F.col("outcome") != "untestable").alias("coref_applicable"), F.count_if(F.col("outcome") == "pass").alias("coref_passed"), F.count_if(F.col("outcome") == "untestable").alias("coref_untestable")
    )
    out = out.join(resolved, "digest_key", "left").na.fill(0, ["coref_applicable", "coref_passed", "coref_untestable"])
    return out.withColumn("coref_rate", F.try_divide(F.col("coref_passed").cast("double"), F.col("coref_applicable")))


def _norm(quote: str | None) -> str:
    """As the norm of distinct quotes in ``grade``: lowered, runs of space, tab and line ends collapsed, spaces trimmed."""
    return re.sub("[ \t\r\n]+", " ", (quote or "").lower()).strip(" ")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(x for x in spans if x[1] > x[0]):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def _figures(body: str | None, gold: list[dict], claims: list[dict]) -> tuple:
    """The figures of one digest: its record's units (unit_id, parts) and its claims (claim_id, quote) against the text."""
    search, at = search_map(body or "")
    parts: dict = {}
    lost = 0
    for u in gold:
        found = part_spans(list(u["parts"] or []), search, at)
        lost += not found
        parts.setdefault(u["unit_id"], []).extend(found)
    located = [quote_spans(c["quote"], search, at) for c in claims]
    union = _merged([x for _, spans in located for x in spans])
    covered = lambda s, e: sum(max(0, min(e, y) - max(s, x)) for x, y in union)
    shares = [sum(starmap(covered, p)) / max(1, sum(e - s for s, e in p)) for p in parts.values() if p]
    norms = [_norm(c["quote"]) for c in claims]
    good = [s in ("contiguous", "elided") for s, _ in located]
    distinct = set(norms) - {""}
    every = [x for p in parts.values() for x in p]
    touching = {c["claim_id"] for c, (_, spans) in zip(claims, located, strict=True) if any(max(s, x) < min(e, y) for s, e in spans for x, y in every)}
    off = sum(g and c["claim_id"] not in touching for g, c in zip(good, claims, strict=True))
    n = {s: sum(x == s for x, _ in located) for s in ("contiguous", "elided", "reordered", "broken")}
    fidelity = len({q for q, g in zip(norms, good, strict=True) if g} - {""}) / len(distinct) if distinct else None
    rate = off / sum(good) if any(good) else None
    recall = sum(shares) / len(shares) if shares else None
    return recall, sum(s >= FULL for s in shares), len(shares), lost, len(claims), len(distinct), fidelity, *n.values(), off, rate


def grade_in(digests: DataFrame) -> DataFrame:
    """As ``grade`` without closures, for rows that hold a digest whole: (digest_key, body, gold, claims), arrays of (unit_id, parts) and (claim_id, quote) structs, ids distinct. A narrow map: nothing is shuffled, a text is mapped once.

    Digests without claims have no row, as in ``grade``.
    """
    names = {"recall": "double", "fully_covered": "long", "units": "long", "unlocatable_gold": "long", "claims": "long", "distinct_quotes": "long", "fidelity": "double"}
    names |= dict.fromkeys(("contiguous", "elided", "reordered", "broken", "off_target"), "long") | {"off_target_rate": "double"}
    kinds = [pa.float64() if x == "double" else pa.int64() for x in names.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (piece for batch in batches for piece in pieces(batch, 1)):
            gold, claims = ([x or [] for x in b.column(k).to_pylist()] for k in (2, 3))
            mine = [k for k, x in enumerate(claims) if x]
            bodies = b.column(1).to_pylist()
            rows = [_figures(bodies[k], gold[k], claims[k]) for k in mine]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(mine, pa.int64())), *(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True))], names=["digest_key", *names])

    shape = f"digest_key {dict(digests.dtypes)['digest_key']}, " + ", ".join(f"{c} {kind}" for c, kind in names.items())
    return digests.select("digest_key", "body", "gold", "claims").mapInArrow(run, shape)


def coreference_outcomes(gold: DataFrame, claims: DataFrame, touching: DataFrame, closures: DataFrame) -> DataFrame:
    """(digest_key, unit_id, outcome) of units that lean on others and that some claim covers.

    Untestable if the units it leans on name nobody; passed if a covering claim names one of theirs, in its text or its references, either
    name within the other.
    """
    names = gold.select("record_key", F.col("unit_id").alias("ancestor"), T.proper_nouns(F.array_join("parts", " ")).alias("names"))
    wanted = closures.join(names, ["record_key", "ancestor"], "left").groupBy("record_key", F.col("dependent").alias("unit_id")).agg(F.array_distinct(F.flatten(F.collect_list("names"))).alias("referents"))
    said = T.proper_nouns(F.coalesce("text", F.lit(""))) if "text" in claims.columns else F.array().cast("array<string>")
    refs = F.coalesce(F.transform("refs", lambda r: r["name"]), F.array().cast("array<string>")) if "refs" in claims.columns else F.array().cast("array<string>")
    named = touching.join(claims.select("digest_key", "claim_id", F.concat(said, F.filter(refs, lambda x: x != "")).alias("named")), ["digest_key", "claim_id"])
    both = named.groupBy("digest_key", "record_key", "unit_id").agg(F.array_distinct(F.flatten(F.collect_list("named"))).alias("named")).join(wanted, ["record_key", "unit_id"])
    hit = F.exists("referents", lambda r: F.exists("named", lambda n: F.contains(n, r) | F.contains(r, n)))
    return both.select("digest_key", "unit_id", F.when(F.size("referents") == 0, "untestable").when(hit, "pass").otherwise("fail").alias("outcome"))


def inside_all(spans: Column, start: Column, end: Column) -> Column:
    """Every part within a range; no part, no."""
    return (F.size(spans) > 0) & F.forall(spans, lambda x: (x["start"] >= start) & (x["end"] <= end))


def crosses(spans: Column, start: Column, end: Column) -> Column:
    """Some part meets a range that does not hold them all."""
    return F.exists(spans, lambda x: (x["start"] < end) & (x["end"] > start)) & ~inside_all(spans, start, end)


def unsupported(claims: DataFrame, ranges: DataFrame, accepted: DataFrame) -> DataFrame:
    """Of claims all of whose parts lie in one complete range, those that touch no accepted part; no row without a complete range.

    ``claims`` has (record_key, claim_id, spans), or start and end for claims of one part.
    """
    if "spans" not in claims.columns:
        claims = claims.withColumn("spans", F.array(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))))
    whole = ranges.where("complete").select("record_key", "start", "end")
    outer = claims.where(F.size("spans") > 0).select("record_key", "claim_id", "spans", F.array_min("spans.start").alias("_first"), F.array_max("spans.end").alias("_last"))
    # some range that begins at or before the claim reaches beyond its end
    inside = sums_upto(outer, whole, ["record_key"], "_first", F.lit(True)).where("reach >= _last").select("record_key", "claim_id", "spans").dropDuplicates(["record_key", "claim_id"])
    flat = inside.select("record_key", "claim_id", F.explode("spans").alias("x")).select("record_key", "claim_id", "x.start", "x.end")
    touch = both_ends(flat, accepted.select("record_key", "start", "end"), ["record_key"], ["claim_id"]).where("touched > 0").select("record_key", "claim_id").distinct()
    state = inside.join(touch.withColumn("_ok", F.lit(True)), ["record_key", "claim_id"], "left").groupBy("record_key").agg(F.count("claim_id").alias("bounded"), F.count_if(F.col("_ok").isNull()).alias("unsupported"))
    out = whole.select("record_key").distinct().join(state, "record_key", "left").na.fill(0, ["bounded", "unsupported"])
    return out.withColumn("rate", F.try_divide(F.col("unsupported").cast("double"), F.col("bounded")))

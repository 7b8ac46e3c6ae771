"""Pairs of token sets with a Jaccard similarity of at least some share: exactly by an inverted index with three filters, or nearly by MinHash bands.

Exact: tokens are put in one order, frequent ones last. Two sets that are similar enough share one of each other's first tokens, have sizes
within the share of each other, and at the first token they share enough of both is still to come: the prefix, length and positional filters. Only pairs that
pass all three are compared. Equal sets are compared once. The postings of a token that very many sets hold are dealt to blocks, with the other side copied to each.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import saved

#: Frequent tokens that are told apart, and postings of a token in one block.
FREQUENT, BLOCK = 50_000, 20_000
#: MinHash signature: bands, and rows of each; a pair of similarity s shares a band with a chance of 1 - (1 - s^ROWS)^BANDS.
BANDS, ROWS = 24, 2


def _sets(df: DataFrame, key: str, tokens: str) -> tuple[DataFrame, DataFrame]:
    """(members, forms): (key, form) of each row, and (form, ts, n) of each distinct set; rows without tokens, or with a null among them, are compared without those."""
    clean = df.select(F.col(key), F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t.isNotNull()))).alias("ts")).where(F.size("ts") > 0)
    named = saved(clean.withColumn("form", F.sha2(F.to_json("ts"), 256)))  # read for members, forms and sizes, tokenised once
    return named.select(key, "form"), named.groupBy("form").agg(F.first("ts").alias("ts")).withColumn("n", F.size("ts"))


def _frequent(*forms: DataFrame) -> DataFrame:
    """(t, df) of tokens that more than one in a thousand sets hold, at most ``FREQUENT``; they come last in the common order."""
    every = forms[0].select(F.explode("ts").alias("t"))
    for f in forms[1:]:
        every = every.unionByName(f.select(F.explode("ts").alias("t")))
    counts = every.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    n = sum(f.count() for f in forms)
    return counts.where(F.col("df") > n / 1000).orderBy(F.desc("df"), "t").limit(FREQUENT)


def _prefixes(forms: DataFrame, frequent: DataFrame, least: float) -> DataFrame:
    """(form, t, pos, n): the first n - ceil(least * n) + 1 tokens of each set in the common order, rare ones by a hash and frequent ones by their number.

    Sets are put in order where they lie: a narrow map, to which at most ``FREQUENT`` counts are sent, and no token is shuffled for its place.
    """
    known = forms.sparkSession.sparkContext.broadcast({r["t"]: r["df"] for r in frequent.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = known.value
        for b in (batch.slice(k, 500) for batch in batches for k in range(0, batch.num_rows, 500)):
            firsts = []
            for n, ts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                ordered = sorted(ts, key=lambda t: (df.get(t, 0), zlib.crc32(t.encode()), t))
                firsts.append(ordered[: n - math.ceil(least * n - 1e-9) + 1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(firsts, pa.list_(pa.string()))], names=["form", "n", "ts"])

    return forms.select("form", "n", "ts").mapInArrow(run, "form string, n int, ts array<string>").select("form", "n", F.posexplode("ts").alias("pos", "t"))


def _enough(least: float, a: Column, b: Column) -> Column:
    """Tokens that sets of sizes a and b share at least."""
    return F.ceil(F.lit(least / (1 + least)) * (a + b) - 1e-9)


def _candidates(left: DataFrame, right: DataFrame, least: float, block: int) -> DataFrame:
    """(lf, rf) pairs of forms that pass the filters."""
    frequent = _frequent(left, right)
    a = _prefixes(left, frequent, least).toDF("lf", "ln", "lp", "t")
    b = _prefixes(right, frequent, least).toDF("rf", "rn", "rp", "t")
    # postings of hot tokens are dealt to blocks on the left, and copied to each on the right
    blocks = a.groupBy("t").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1")
    a = a.join(blocks, "t", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("lf"), F.col("blocks")), F.lit(0))).drop("blocks")
    b = b.join(blocks, "t", "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("blocks"), F.lit(1)).cast("long") - 1))).drop("blocks")
    fits = (F.col("rn") >= F.lit(least) * F.col("ln") - 1e-9) & (F.col("ln") >= F.lit(least) * F.col("rn") - 1e-9)
    to_come = F.least(F.col("ln") - F.col("lp"), F.col("rn") - F.col("rp"))  # this token and those after it
    met = a.join(b, ["t", "block"]).where(fits)
    # at the first token that both prefixes share nothing before it is shared, so what is to come bounds the whole
    return met.groupBy("lf", "rf").agg(F.min_by(F.struct((to_come >= _enough(least, F.col("ln"), F.col("rn"))).alias("ok")), F.col("lp")).alias("first")).where("first.ok").select("lf", "rf")


def _compared(pairs: DataFrame, left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    sets = pairs.join(left.select(F.col("form").alias("lf"), F.col("ts").alias("lt")), "lf").join(right.select(F.col("form").alias("rf"), F.col("ts").alias("rt")), "rf")
    common = F.size(F.array_intersect("lt", "rt"))
    similar = sets.withColumn("similarity", common / (F.size("lt") + F.size("rt") - common))
    return similar.where(F.col("similarity") >= least).select("lf", "rf", "similarity")


def _named(found: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    return found.join(a.withColumnRenamed("form", "lf"), "lf").join(b.withColumnRenamed("form", "rf"), "rf").select("a", "b", "similarity")


def _in_reach(forms: DataFrame, other: DataFrame, least: float) -> DataFrame:
    """The sets whose size is near enough to that of some set of the other side, by its least and greatest size."""
    low, high = other.agg(F.min("n"), F.max("n")).first()
    return forms.where(F.lit(False) if low is None else F.col("n").between(least * low - 1e-9, high / least + 1e-9))


def jaccard_matches(left: DataFrame, right: DataFrame, least: float = 0.4, block: int = BLOCK) -> DataFrame:
    """All pairs of (a, ta) and (b, tb) sets of tokens with a Jaccard similarity of ``least`` (above 0) or more; empty sets are similar to nothing."""
    a, lf = _sets(left, "a", "ta")
    b, rf = _sets(right, "b", "tb")
    rf = saved(_in_reach(rf, lf, least))
    lf = saved(_in_reach(lf, rf, least))
    return _named(_compared(_candidates(lf, rf, least, block), lf, rf, least), a, b)


def signature(tokens: Column, bands: int, rows: int) -> Column:
    """An array of one hash for each band: of the least hashes of its rows' permutations of the tokens."""
    low = lambda seed: F.array_min(F.transform(tokens, lambda t: F.xxhash64(F.lit(seed), t)))
    return F.array(*[F.xxhash64(F.lit(k), *[low(k * rows + r) for r in range(rows)]) for k in range(bands)])


def minhash_matches(left: DataFrame, right: DataFrame, least: float = 0.4, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Most pairs of ``jaccard_matches``: those whose signatures agree in a band, compared exactly, so none is wrong and some may be missing."""
    a, lf = _sets(left, "a", "ta")
    b, rf = _sets(right, "b", "tb")
    banded = lambda df, name: df.select(F.col("form").alias(name), F.posexplode(signature(F.col("ts"), bands, rows)).alias("band", "hash"))
    pairs = banded(lf, "lf").join(banded(rf, "rf"), ["band", "hash"]).select("lf", "rf").distinct()
    return _named(_compared(pairs, lf, rf, least), a, b)

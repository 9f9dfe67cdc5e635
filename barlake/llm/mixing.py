"""Mixing sources to target weights by Pareto order sampling, in DataFrame
functions only.

A source's target is its share by weight of all words, at most ``LIMIT`` times
its own size; what is above goes to the other sources by weight, until none
exceeds its limit.  With a target of c whole source sizes and a rest, every
document gets c certain copies, and the rest is sampled: each document draws a
uniform u from its doc_id, documents are ranked by the random odds u / (1 - u)
divided by their inclusion odds p / (1 - p) (p: rest by source size; a
``weight`` column multiplies the odds), and the sample is the head of that
order, of a fixed size counted in words.

So that one long document does not decide a source, a source is sampled in
five strata, from documents of at least an eighth of the rest down to those
below a 4096th.  Each stratum is due its share of the rest and what the
longer ones left over; the running total of its order says where to cut.  The
document whose size comes nearest to what remains after the last stratum is
added if that brings the source nearer to its target; without such a document
the miss is at most half the size of every document left out.

Skew.  Running totals are taken over ranges of rows (``running``), so a source
with most of all rows is spread over as many tasks; joins of rows with
per-source values go by (source, stratum, range) or are salted.  The driver
reads three sums per round of the resharing.

Edge cases: null text and text without words have size 0 and are never taken;
a null source is a source, the last by order; rows without a doc_id, and
repeated rows, draw the same u and are interchangeable, so a rerun takes as
many of them; the order does not depend on the layout of the input; an empty
table gives no rows; other columns are ignored, and kept by
``mixed_documents``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.running import in_ranges, range_totals, upto
from barlake.llm.storage import materialise, spare

WEIGHTS = (1, 2, 3)
LIMIT = 3
#: A document of less than rest / k words is below the k of its stratum.
STRATA = (8, 64, 512, 4096)
SALT = 16
SEED = "barlake-mix"
_BLANK = "\\x20\\x09-\\x0D"


def words(text: Column) -> Column:
    """Number of words of a whole text, without a list of them: each word and
    the blanks before it become one mark, and blanks at the end go."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{_BLANK}]*[^{_BLANK}]++", "x")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from the first 52 bits of a digest of the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source_no, source, source_size, target, copies, rest) per source of
    ``sized`` (source, size); ``source_no`` is its place by code point."""
    sources = materialise(sized.sparkSession, sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    by_name = [F.col("source").asc_nulls_last()]
    ranged = in_ranges(sources, [], by_name, "ranked-sources")
    starts = range_totals(ranged, [], F.lit(1)).select("range_no", F.coalesce("before", F.lit(0)).alias("first"))
    number = F.col("first") + F.count(F.lit(1)).over(upto([], by_name)) - 1
    ranked = ranged.join(starts, "range_no").withColumn("source_no", number)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int"))
    ranked = materialise(sized.sparkSession, ranked.select(
        "source_no", "source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * limit).alias("cap")), "weights")
    total, free = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    held, rate = 0, 0.0
    while free:
        before, rate = rate, (total - held) / free
        if rate == before:
            break
        capped = F.col("cap") <= F.col("weight") * F.lit(rate)
        held, free = ranked.agg(F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)),
                                F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))).first()
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(rate)) if free else F.col("cap").cast("double")
    goal = F.floor(F.col("target") + 0.5).cast("long")
    out = ranked.withColumn("target", target).withColumn("goal", goal)
    whole = F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0)).cast("long")
    return out.withColumn("copies", whole).select(
        "source_no", "source", "source_size", "target", "copies", (F.col("goal") - F.col("copies") * F.col("source_size")).alias("rest"))


def _ordered(sized: DataFrame, sources: DataFrame, seed: str) -> tuple[DataFrame, DataFrame]:
    """Rows in the order of their sampling with ``upto``, the words of their
    stratum up to and including them, and the totals per range."""
    names = sources.select("source_no", F.col("source").alias("name"), "source_size", "rest").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = sized.withColumn("salt_", F.pmod(F.xxhash64("uid"), F.lit(SALT)))
    rows = salted.join(names, F.col("source").eqNullSafe(F.col("name")) & (F.col("salt_") == F.col("salt")))
    stratum = reduce(lambda a, b: a + b, [(F.col("size") * k < F.col("rest")).cast("int") for k in STRATA])
    u, p = uniform(F.col("doc_id"), seed), F.col("rest") / F.col("source_size")
    odds = F.when(F.col("rest") > 0, p / (1 - p) * F.col("weight")).otherwise(F.lit(1.0))
    rows = rows.select("source_no", stratum.alias("stratum"), "uid", "doc_id", "size", (u / (1 - u) / odds).alias("rank"))
    group, order = ["source_no", "stratum"], [F.col("rank").asc(), F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("uid").asc()]
    ranged = in_ranges(rows, group, order, "sampling-order")
    totals = materialise(sized.sparkSession, range_totals(ranged, group, F.col("size")).withColumn(
        "before", F.coalesce("before", F.lit(0))), "range-totals")
    placed = ranged.join(totals.drop("total"), [*group, "range_no"]).withColumn(
        "upto", F.col("before") + F.sum("size").over(upto(group, order))).drop("before", "rank")
    return materialise(sized.sparkSession, placed, "running-totals"), totals


def _cuts(sources: DataFrame, placed: DataFrame, totals: DataFrame) -> DataFrame:
    """``sources`` with ``cut0`` to ``cut4``, the words each stratum gives.

    A stratum may give what is due to it and all longer ones, less what those
    gave.  The range that holds the cut is found among the range totals, and
    the cut among that range's rows."""
    spark, strata = sources.sparkSession, range(len(STRATA) + 1)
    sums = totals.groupBy("source_no").agg(
        *[F.coalesce(F.sum(F.when(F.col("stratum") <= s, F.col("total"))), F.lit(0)).alias(f"size{s}") for s in strata])
    wide = "cast(rest AS decimal(18,0)) * cast({} AS decimal(18,0)) div cast(source_size AS decimal(18,0))"
    due = [F.when(F.col("rest") > 0, F.expr(wide.format(f"size{s}"))).otherwise(F.lit(0)).cast("long").alias(f"due{s}") for s in strata]
    state = materialise(spark, sources.join(sums, "source_no").select(
        "source_no", "rest", F.lit(0).cast("long").alias("given"), *due), "due")
    for s in strata:
        may = state.where("rest > 0").select("source_no", (F.col(f"due{s}") - F.col("given")).alias("may"))
        at = may.join(totals.where(F.col("stratum") == s), "source_no").where("before <= may").groupBy("source_no", "may").agg(
            F.max(F.struct("before", "range_no", "total")).alias("at"))
        at = at.select("source_no", "may", "at.*")
        inside = (placed.where(F.col("stratum") == s).join(at.select("source_no", "range_no", "may"), ["source_no", "range_no"])
                  .where("upto <= may").groupBy("source_no").agg(F.max("upto").alias("most")))
        cut = at.join(inside, "source_no", "left").select("source_no", F.coalesce("most", "before").alias(f"cut{s}"))
        state = state.join(cut, "source_no", "left").withColumn(f"cut{s}", F.coalesce(f"cut{s}", F.lit(0).cast("long")))
        state = materialise(spark, state.withColumn("given", F.col("given") + F.col(f"cut{s}")), f"cut-{s}")
    return state.select("source_no", (F.col("rest") - F.col("given")).alias("left"), *[f"cut{s}" for s in strata])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, weight: str | None = None,
        seed: str = SEED, uid: str | None = None) -> DataFrame:
    """(uid, doc_id, source, size, source_size, target, copies, taken) per row
    of ``docs`` (doc_id, source, text).  ``weight`` names a column of positive
    numbers that multiply a document's inclusion odds; ``uid`` a column with a
    distinct long per row."""
    spark = docs.sparkSession
    mark = F.col(uid) if uid else F.monotonically_increasing_id()
    odds = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    sized = materialise(spark, docs.select(mark.alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "source",
                                           words(F.col("text")).alias("size"), odds.alias("weight")), "sizes")
    sources = materialise(spark, source_targets(sized, weights, limit), "targets")
    placed, totals = _ordered(sized, sources, seed)
    cuts = _cuts(sources, placed, totals)
    cut = F.element_at(F.array(*[f"cut{s}" for s in range(len(STRATA) + 1)]), F.col("stratum") + 1)
    keys = ["source_no", "stratum", "range_no"]
    by_range = totals.select(*keys).join(cuts.select("*"), "source_no").select(*keys, "left", cut.alias("cut"))
    # The one document that brings a source nearest to its target.
    near = (placed.join(by_range, keys).where("left > 0 AND size > 0 AND upto > cut AND size < 2 * left")
            .groupBy("source_no").agg(F.min(F.struct(F.abs(F.col("left") - F.col("size")), F.col("stratum").alias("one_stratum"),
                                                     F.col("upto").alias("one_upto"))).alias("one")))
    near = near.select("source_no", "one.one_stratum", "one.one_upto")
    values = sources.join(near, "source_no", "left")
    by_range = by_range.drop("left").join(values, "source_no")
    sampled = (F.col("upto") <= F.col("cut")) | ((F.col("stratum") == F.col("one_stratum")) & (F.col("upto") == F.col("one_upto")))
    copies = F.when(F.col("size") > 0, F.col("copies") + F.coalesce(sampled, F.lit(False)).cast("long")).otherwise(F.lit(0)).cast("long")
    out = placed.join(by_range, keys).withColumn("copies", copies)
    return out.select("uid", "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    uid = spare(docs.columns, "row_uid")
    stored = materialise(docs.sparkSession, docs.withColumn(uid, F.monotonically_increasing_id()), "documents")
    times = mix(stored, uid=uid, **options).where("copies > 0").select(
        F.col("uid").alias(uid), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias(spare([*docs.columns, uid], "copy")))
    return stored.join(times, uid).select(docs.columns)

"""Mixing sources to target weights by entropy balancing.

The mix takes each document at a rate r, and among all rates that give every
group (a value of a margin column, e.g. a source) its target of words, the one
that is nearest to "every document once" in relative entropy is
``r = min(cap, exp(sum of the document's group multipliers))``.  The
multipliers solve a convex dual.  Its Newton step is diagonal within a margin
(groups of one margin are disjoint), so each iteration is one aggregation of
words by group and a step of all multipliers of that margin; margins take
turns.  Rates only differ between cells (combinations of margin values), so
documents are summed into cells once, map-side first, and the iterations run
on cells.

Copies are the rates rounded within bounded strata of a source (hash strata of
about ``STRATUM`` documents): from long to short documents, the copies are
floor or ceil of the rate, whichever keeps the words taken so far nearest to
the rate's; the error left over is carried to the next document.  A stratum is
one small group, so a hot source is split over as many tasks as it has strata.

Defined results: a null or empty text has size 0 and takes 0 words; a null
margin value is a group of its own (last in order); repeated rows are
documents of their own; an empty table gives an empty mix.  A group without
words has target 0.  Other columns of the input pass through untouched, under
their own names, in the pipeline stage; the query returns the digest alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, shield, table

WORD = r"[^\x20\x09-\x0D]+"
CAP = 3.0
STRATUM = 2048
TOLERANCE = 1e-9
MAX_ITERATIONS = 60


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighted_targets(sizes: DataFrame, group: str, weights: tuple[int, ...] = (1, 2, 3), cap: float = CAP) -> DataFrame:
    """Targets of groups (``group``, source_size): weights repeat over the groups
    in code-point order (null last) and share all words; a group stops at
    ``cap`` times its words, the excess is reshared by weight.

    Water filling in closed form: in order of cap * size / weight, a group is
    full exactly if that level is at most the level the remaining words give
    the remaining groups.  One row per group, so the windows hold group totals
    only, never documents.
    """
    n = len(weights)
    by_name = F.col(group).asc_nulls_last()
    pos = F.row_number().over(Window.orderBy(by_name)) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (pos % n + 1).cast("int"))
    g = sizes.withColumn("w", w).withColumn("level", F.col("source_size") * cap / F.col("w"))
    fill = Window.orderBy("level", by_name)
    whole = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    g = (
        g.withColumn("nth", F.row_number().over(fill))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("rest", F.col("total") - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("rest_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("share", F.col("rest") / F.col("rest_w"))
    )
    full = F.col("level") <= F.col("share")
    # what one unit of weight gets, from the first group that isn't full
    g = g.withColumn("open_share", F.min(F.when(~full, F.struct("nth", "share"))).over(whole)["share"])
    target = F.when(full, F.col("source_size") * cap).otherwise(F.col("w") * F.col("open_share"))
    return g.select(group, "source_size", target.cast("double").alias("target"))


def balance(cells: DataFrame, margins: dict[str, DataFrame], scratch: Scratch, cap: float = CAP, tolerance: float = TOLERANCE) -> DataFrame:
    """Rates of cells (margin columns, ``words``) that meet the margins' targets.

    ``margins`` maps a column to a table (column, target).  Adds ``rate``.  A
    group that can't reach its target under the cap ends at the cap.
    """
    top = float(np.log(cap))
    lam = {m: t.select(m, F.col("target").cast("double"), F.lit(0.0).alias("lam")) for m, t in margins.items()}
    for i in range(MAX_ITERATIONS):
        worst = 0.0
        for m in margins:
            tilt = F.lit(0.0)
            rated = cells
            for k, t in lam.items():
                rated = rated.join(t.select(F.col(k).alias(f"_{k}"), F.col("lam").alias(f"_lam_{k}")), F.col(k).eqNullSafe(F.col(f"_{k}"))).drop(f"_{k}")
                tilt = tilt + F.col(f"_lam_{k}")
            rate = F.least(F.lit(cap), F.exp(tilt))
            free = tilt < top
            sums = rated.groupBy(F.col(m).alias("_g")).agg(
                F.sum(F.col("words") * rate).alias("got"),
                F.sum(F.when(free, F.col("words") * rate).otherwise(0.0)).alias("slope"),
            )
            t = lam[m].join(sums, F.col(m).eqNullSafe(F.col("_g")))
            # damped Newton step of the dual; at the cap the slope is flat, so step back by the excess
            step = F.when(F.col("slope") > 0, (F.col("target") - F.col("got")) / F.col("slope")).when(F.col("got") > F.col("target"), F.log(F.col("target") / F.col("got"))).otherwise(0.0)
            step = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), step))
            new = F.least(F.col("lam") + step, F.lit(top if len(margins) == 1 else top * len(margins)))
            off = F.abs(F.col("got") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0))
            done = scratch.cut(t.select(m, "target", F.when(F.col("got") > 0, new).otherwise(0.0).alias("lam"), F.when((F.col("got") < F.col("target")) & (F.col("slope") <= 0), 0.0).otherwise(off).alias("off")))
            worst = max(worst, done.agg(F.max("off")).first()[0] or 0.0)
            scratch.drop(lam[m])
            lam[m] = done
        if worst < tolerance:
            break
    out, tilt = cells, F.lit(0.0)
    for k, t in lam.items():
        out = out.join(t.select(F.col(k).alias(f"_{k}"), F.col("lam").alias(f"_lam_{k}")), F.col(k).eqNullSafe(F.col(f"_{k}")))
        tilt = tilt + F.col(f"_lam_{k}")
    # rounding hides the last bits, so reruns agree whatever the order of sums
    return out.select(*cells.columns, F.round(F.least(F.lit(cap), F.exp(tilt)), 9).alias("rate"))


def _copies(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of one stratum: rounded rates with the error carried on."""
    rows = rows.sort_values(["_size", "_h"], ascending=[False, True], kind="stable")
    carry, out = 0.0, []
    for size, rate in zip(rows["_size"].to_numpy(), rows["_rate"].to_numpy(), strict=True):
        low = float(np.floor(rate + 1e-9))
        high = low if rate - low < 1e-9 else low + 1
        n = high if abs(carry + (rate - high) * size) <= abs(carry + (rate - low) * size) else low
        carry += (rate - n) * size
        out.append(int(n))
    return rows.assign(_copies=out)


def mix(docs: DataFrame, size: Column, margin: str = "source", weights: tuple[int, ...] = (1, 2, 3), cap: float = CAP, key: str = "doc_id", extra: dict[str, DataFrame] | None = None) -> DataFrame:
    """Copies of every row of ``docs`` (``key``, ``margin`` and margins of ``extra``).

    Returns (key, margin, ``_size``, ``_source_size``, ``_target``, ``_rate``,
    ``_copies``), one row per input row.  ``extra`` adds further margins:
    column -> table (column, target).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    margins = [margin, *(extra or {})]
    rows = scratch.cut(docs.select(key, *margins, size.alias("_size")))
    cells = scratch.cut(rows.groupBy(*margins).agg(F.sum("_size").alias("words"), F.count("*").alias("n")))
    groups = scratch.cut(weighted_targets(cells.groupBy(margin).agg(F.sum("words").alias("source_size"), F.sum("n").alias("n")), margin, weights, cap))
    rates = scratch.cut(balance(cells, {margin: groups.select(margin, "target"), **(extra or {})}, scratch, cap))
    facts = rates.join(groups.withColumnRenamed(margin, "_m"), F.col(margin).eqNullSafe(F.col("_m"))).drop("_m", "words")
    facts = facts.select(*[F.col(m).alias(f"_k_{m}") for m in margins], F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("rate").alias("_rate"), F.greatest(F.lit(1), F.ceil(F.col("n") / STRATUM)).alias("_strata"))
    on = F.lit(True)
    for m in margins:
        on = on & F.col(m).eqNullSafe(F.col(f"_k_{m}"))
    h = F.xxhash64(F.col(key), F.col("_size"))
    joined = rows.join(facts, on).withColumn("_h", h).withColumn("_stratum", F.pmod(F.col("_h"), F.col("_strata")))
    cell = F.xxhash64(*[F.coalesce(F.col(m).cast("string"), F.lit("\0null")) for m in margins])
    schema = joined.drop(*[f"_k_{m}" for m in margins], "_strata").withColumn("_cell", cell)
    out = schema.groupBy("_cell", "_stratum").applyInPandas(_copies, schema=f"{_ddl(schema)}, _copies long")
    return out.select(key, *margins, "_size", "_source_size", "_target", "_rate", "_copies")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 1, 2, 3 of their sources."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    out = mix(docs, n_words(F.col("text")))
    return out.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
        F.col("_copies").alias("copies"),
        F.col("_rate").alias("rate"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it."""
    docs, named = shield(docs, "text", "source")
    key = F.concat(*[F.hex(F.xxhash64(F.lit(salt), *docs.columns)) for salt in (1, 2)])
    keyed = docs.withColumn("_key", key)
    mixed = mix(keyed, n_words(F.col("text")), key="_key").groupBy("_key").agg(F.sum("_copies").cast("int").alias("_copies"))
    # wholly equal rows share a key: one of them stands for all their copies
    out = keyed.join(mixed.where("_copies > 0"), "_key").dropDuplicates(["_key"])
    return named(out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))))

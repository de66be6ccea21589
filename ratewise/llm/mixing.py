"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells (source, language, topic). The cells' token weights are scaled, one
dimension after the other, until the token shares of sources, languages and topics meet their
targets; a document is then kept with probability proportional to its cell's scale. Only
DataFrame operations are used.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import fresh

DIMS = ("source", "lang", "topic")
#: Sweeps over the three dimensions if a number is asked for. Where the targets can all be met the error falls
#: geometrically. They cannot where a value of one dimension only occurs with a value of another whose
#: target differs (one document with a source and a language of its own): there the error stays
#: whatever the sweeps, so it is measured and reported.
SWEEPS = 5
#: Measured sweeps end when no marginal is off its target by more than this share, when a sweep
#: lessens the error by less than a hundredth, or after so many.
CLOSE = 0.005
MOST_SWEEPS = 30
#: The sample holds this share of the tokens (in expectation) where a target size is asked for.
KEEP = 0.5
#: Targets are the present shares to this power, normalised: 1 keeps the mix, 0 makes it flat.
TEMPERATURE = {"source": 0.7, "lang": 0.7, "topic": 0.9}
SEED = "mix-1"
_LOG = logging.getLogger(__name__)
#: ASCII blanks; a token for weighting is a maximal run of other characters.
TOKEN = r"[^ \t\n\r\f]+"


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A topic by form, for corpora without topic labels: ``markup`` (vertical bars or repeated
    signs), ``legal`` (licence words), ``contact`` (an @ sign), ``list`` (many lines), ``prose``."""
    low = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(low, F.lit(" | ")) | F.contains(low, F.lit("%%%")), "markup")
            .when(F.contains(low, F.lit("License")) | F.contains(low, F.lit("All rights reserved")), "legal")
            .when(F.contains(low, F.lit("@")), "contact")
            .when(F.length(low) - F.length(F.translate(low, "\n", "")) >= 12, "list")
            .otherwise("prose"))


def cells(docs: DataFrame) -> DataFrame:
    """(source, lang, topic, base): token weight of each non-empty cell; one partial aggregate."""
    return (docs.where(F.col("tokens") > 0).groupBy(*DIMS)
            .agg(F.sum("tokens").cast("double").alias("base")))


def targets(cell: DataFrame, dim: str, temperature: float, shares: dict | DataFrame | None = None) -> DataFrame:
    """(k, goal): token weight that each value of ``dim`` is to have: by target ``shares`` (value ->
    share, or a table (k, share); they are normalised, and a value without one is to have none), or by
    the present shares to the power ``temperature``."""
    if shares is not None:
        if isinstance(shares, dict):
            shares = cell.sparkSession.createDataFrame([(k, float(x)) for k, x in shares.items()], "k string, share double")
        total = cell.agg(F.sum("base").alias("all")).join(F.broadcast(shares.agg(F.sum("share").alias("shares"))))  # one row
        return shares.join(F.broadcast(total)).select("k", (F.col("share") / F.col("shares") * F.col("all")).alias("goal"))
    now = cell.groupBy(dim).agg(F.sum("base").alias("b"))
    total = now.agg(F.sum("b").alias("all"), F.sum(F.pow("b", F.lit(temperature))).alias("flat"))
    return now.join(F.broadcast(total)).select(
        F.col(dim).alias("k"),
        (F.pow("b", F.lit(temperature)) / F.col("flat") * F.col("all")).alias("goal"))


def residual(fitted: DataFrame, goals: dict[str, DataFrame]) -> dict[str, float]:
    """By dimension, the largest share by which a value's weight is off its goal."""
    off = [fitted.groupBy(F.col(d).alias("__v")).agg(F.sum("weight").alias("__now"))
           .join(goals[d], F.col("__v").eqNullSafe(F.col("k")))
           .agg(F.max(F.abs(F.try_divide("__now", "goal") - 1)).alias("off")).select(F.lit(d).alias("dim"), "off")
           for d in DIMS]
    return {r["dim"]: r["off"] or 0.0 for r in off[0].unionByName(off[1]).unionByName(off[2]).collect()}


def rake(cell: DataFrame, goals: dict[str, DataFrame], sweeps: int | None = SWEEPS) -> DataFrame:
    """``cell`` with ``weight`` raked to ``goals`` (per dimension a table (k, goal)).

    Each step is a partial aggregate per value and a join of the small marginal table; the
    lineage is cut after every sweep. A value without a goal gets weight 0; goals of values
    that no cell has are unreachable and are left out of the total. ``sweeps`` None: until the
    measured residual is under ``CLOSE`` or falls no more; what is left of it is logged.
    """
    fitted = cut_lineage(cell.withColumn("weight", F.col("base")))
    # a goal is needed in every sweep: computed once
    goals = {d: cut_lineage(g) for d, g in goals.items()}
    last = None
    for sweep in range(MOST_SWEEPS if sweeps is None else sweeps):
        for dim in DIMS:
            now = fitted.groupBy(F.col(dim).alias("__v")).agg(F.sum("weight").alias("__now"))
            scale = (now.join(goals[dim], F.col("__v").eqNullSafe(F.col("k")), "left")
                     .select("__v", F.coalesce(F.try_divide("goal", "__now"), F.lit(0.0)).alias("__f")))
            fitted = (fitted.join(scale, F.col(dim).eqNullSafe(F.col("__v")))
                      .select(*DIMS, "base", (F.col("weight") * F.col("__f")).alias("weight")))
        fitted = cut_lineage(fitted)
        if sweeps is None:
            off = residual(fitted, goals)
            worst = max(off.values())
            if worst <= CLOSE or (last is not None and worst > 0.99 * last):
                break
            last = worst
    if sweeps is None:
        level = logging.INFO if worst <= CLOSE else logging.WARNING
        _LOG.log(level, "raking: %d sweeps, largest residual by dimension %s", sweep + 1,
                 {d: round(x, 4) for d, x in off.items()})
    return fitted


def calibrate(fitted: DataFrame, keep: float) -> float | None:
    """The scale c for which ``sum(base * min(1, c * factor))`` is ``keep`` times ``sum(base)``; None
    where every reachable token is needed.

    The sum is concave and piecewise linear in c, so Newton's steps from the left reach the root in
    finitely many; each is one partial aggregate over the cells.
    """
    factor = F.col("weight") / F.col("base")
    all_, reach = fitted.agg(F.sum("base"), F.sum(F.when(F.col("weight") > 0, F.col("base")))).first()
    if not all_ or not reach or keep * all_ >= reach:
        return None
    c = 0.0
    while True:
        whole = F.lit(c) * factor >= 1
        full, slope = fitted.agg(F.sum(F.when(whole, F.col("base")).otherwise(0.0)),
                                 F.sum(F.when(whole, 0.0).otherwise(F.col("weight")))).first()
        if not slope or (after := (keep * all_ - full) / slope) <= c * (1 + 1e-12):
            return c
        c = after


def uniform(key: Column, seed: str = SEED) -> Column:
    """A fixed number in [0, 1) for each key: the first 8 hex digits of an md5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        lang: str = "lang", topic_of: Callable[[Column], Column] | str = topic,
        temperature: dict[str, float] | None = None, sweeps: int | None = SWEEPS,
        seed: str = SEED, keep: float | None = None, goals: dict[str, dict | DataFrame] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``topic``, ``tokens``, ``factor`` (raked weight over token weight
    of its cell), ``p`` (its sampling probability) and ``sampled``.

    ``goals`` names the target weights of a dimension (``source``, ``lang``, ``topic``) as {value: share}
    or a table (k, share); dimensions without goals get theirs by ``temperature`` from the present
    shares. ``topic_of`` makes the topic from the text column, or names the column that holds it.

    With ``keep``, ``p = min(1, c * factor)``, where c is such that the sample holds this share of
    the tokens in expectation: a cell that is too small for its target is kept whole and does not
    thin out the others, whose shares stay in the raked proportions. Without,
    ``p = factor / largest factor``, so that no probability has to be cut at 1 and the expected
    token shares are the raked ones; the sample's size is then set by the rarest cell. A document is sampled if the fixed uniform number of its key
    is below ``p``: repeated rows are kept or dropped together. Null source or language is a value
    of its own. Null, empty or blank text has 0 tokens, no cell, factor and p 0, and is not
    sampled. An empty table gives no rows. Columns with the names of results are replaced.
    """
    temperature = temperature or TEMPERATURE
    added = ("topic", "tokens", "factor", "p", "sampled")
    made = F.col(topic_of) if isinstance(topic_of, str) else topic_of(F.col(text))
    extra = docs.select(*[c for c in docs.columns if c not in added], made.alias("topic"), tokens(F.col(text)).alias("tokens"))
    narrow = extra.select(F.col(source).alias("source"), F.col(lang).alias("lang"), "topic", "tokens")
    cell = cut_lineage(cells(narrow))
    fitted = rake(cell, {d: targets(cell, d, temperature[d], (goals or {}).get(d)) for d in DIMS}, sweeps)
    factor = fitted.withColumn("factor", F.col("weight") / F.col("base"))
    if keep is None:
        top = factor.agg(F.max("factor").alias("top"))
        p = F.try_divide("factor", "top")
        factor = factor.join(F.broadcast(top))
    else:
        c = calibrate(fitted, keep)
        p = (F.col("factor") > 0).cast("double") if c is None else F.least(F.lit(1.0), F.lit(c) * F.col("factor"))
    # one column with a name of its own, so that no column of the documents can clash
    own = fresh(extra, "cell")
    share = factor.select(F.struct(*DIMS, "factor", p.alias("p")).alias(own))
    found = lambda f: F.col(f"{own}.{f}")
    same = (F.col(source).eqNullSafe(found("source")) & F.col(lang).eqNullSafe(found("lang"))
            & F.col("topic").eqNullSafe(found("topic")) & (F.col("tokens") > 0))
    out = extra.join(share, same, "left")
    p = F.coalesce(found("p"), F.lit(0.0))
    return out.select(*extra.columns, F.coalesce(found("factor"), F.lit(0.0)).alias("factor"),
                      p.alias("p"), (uniform(F.col(key), seed) < p).alias("sampled"))


def oracle() -> str:
    """The registered query in DuckDB SQL: sweeps until the residual is small or falls no more, then c
    from the cells in falling order of their factor: the first cell that is not kept whole gives it."""
    low = "coalesce(text, '')"
    goals = ",\n".join(
        f"t_{d} AS MATERIALIZED (SELECT {d} AS k, pow(b, {TEMPERATURE[d]}) / sum(pow(b, {TEMPERATURE[d]})) OVER () * sum(b) OVER () AS goal "
        f"FROM (SELECT {d}, sum(base) AS b FROM c GROUP BY {d}))" for d in DIMS)
    inner = "SELECT r.*, " + ", ".join(f"t_{d}.goal AS g_{d}" for d in DIMS) + " FROM r " + " ".join(
        f"JOIN t_{d} ON r.{d} IS NOT DISTINCT FROM t_{d}.k" for d in DIMS) + " WHERE NOT done"
    for d in DIMS:
        inner = f"SELECT * REPLACE (w * g_{d} / sum(w) OVER (PARTITION BY {d}) AS w) FROM ({inner})"
    off = "greatest(" + ", ".join(f"abs(sum(w) OVER (PARTITION BY {d}) / g_{d} - 1)" for d in DIMS) + ")"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, source, lang,
  CASE WHEN contains({low}, ' | ') OR contains({low}, '%%%') THEN 'markup'
       WHEN contains({low}, 'License') OR contains({low}, 'All rights reserved') THEN 'legal'
       WHEN contains({low}, '@') THEN 'contact'
       WHEN length({low}) - length(replace({low}, chr(10), '')) >= 12 THEN 'list' ELSE 'prose' END AS topic,
  CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')), 0) AS BIGINT) AS tokens FROM documents),
c AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS base FROM d WHERE tokens > 0 GROUP BY ALL),
{goals},
r(sweep, source, lang, topic, base, w, off, done) AS (
  SELECT 0, source, lang, topic, base, base, CAST(NULL AS DOUBLE), false FROM c
  UNION ALL
  SELECT sweep + 1, source, lang, topic, base, w, worst, worst <= {CLOSE} OR coalesce(worst > 0.99 * off, false) OR sweep + 1 >= {MOST_SWEEPS}
  FROM (SELECT *, max(each) OVER () AS worst FROM (SELECT *, {off} AS each FROM ({inner})))),
f AS MATERIALIZED (SELECT source, lang, topic, base, w, w / base AS factor FROM r WHERE sweep = (SELECT max(sweep) FROM r)),
q AS (SELECT factor, {KEEP} * sum(base) OVER () - coalesce(sum(base) OVER (ORDER BY factor DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS need,
             sum(w) OVER (ORDER BY factor DESC RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM f),
k AS (SELECT max_by(need / rest, factor) AS c FROM q WHERE need / rest * factor <= 1)
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(coalesce(f.factor, 0), 6) AS factor,
       round(coalesce(least(1, k.c * f.factor), 0), 6) AS p,
       CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) / 4294967296.0
         < coalesce(least(1, k.c * f.factor), 0) AS sampled
FROM d CROSS JOIN k LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source AND d.lang IS NOT DISTINCT FROM f.lang
  AND d.topic = f.topic AND d.tokens > 0
"""

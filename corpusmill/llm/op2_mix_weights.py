"""Mixing sources to target weights: token weights raked to marginals, documents sampled by calibrated probabilities."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.shared import stored

#: Cells up to which raking runs on the driver and probabilities are broadcast: 200,000 rows of three short strings and a
#: number. Beyond, both are done with DataFrames.
MOST_CELLS = 200_000
# Topics by pattern, the first one that a text matches; none: general.
TOPICS = (("legal", r"(?i)licen[sc]e|rights reserved|copyright"), ("contact", r"[\w.]@[\w.]"), ("code", r"""[{};]|= ?["']|==|\(\)"""))
DIMS = ("source", "lang", "topic")
#: Marginals are met up to this share of all weight.
TOLERANCE = 1e-10
NONE = "\0none"


def with_topic(docs: DataFrame, text_col: str = "text", topics: Sequence[tuple[str, str]] = TOPICS) -> DataFrame:
    """Adds topic. Null text is general."""
    c = F.lit("general")
    for name, pattern in reversed(topics):
        c = F.when(F.regexp_like(F.col(text_col), F.lit(pattern)), name).otherwise(c)
    return docs.withColumn("topic", c)


def tempered(shares: Mapping[str, float], alpha: float) -> dict[str, float]:
    """Shares to the power alpha, made to sum to one."""
    raised = {k: v**alpha for k, v in shares.items() if v > 0}
    total = sum(raised.values())
    return {k: v / total for k, v in raised.items()}


def rake(mass: np.ndarray, groups: Sequence[np.ndarray], targets: Sequence[np.ndarray], rounds: int = 200, tolerance: float = TOLERANCE) -> np.ndarray:
    """Iterative proportional fitting: factors of cells such that mass * factor meets each dimension's target shares.

    groups[d][i] is cell i's value in dimension d; targets[d] sums to one. Values without mass are left out of their
    dimension's targets. Ends at the tolerance, or after `rounds` with a warning if the marginals contradict each other over
    the cells."""
    weight = mass / mass.sum()
    start = weight.copy()
    fitted = []
    for g, t in zip(groups, targets, strict=True):
        t = np.where(np.bincount(g, start, len(t)) > 0, t, 0)
        fitted.append(t / t.sum())
    for _ in range(rounds):
        worst = 0.0
        for g, t in zip(groups, fitted, strict=True):
            have = np.bincount(g, weight, len(t))
            worst = max(worst, float(np.abs(have - t).max()))
            weight = weight * np.divide(t, have, out=np.zeros_like(t), where=have > 0)[g]
        if worst < tolerance:
            break
    else:
        _report(worst if rounds else 0.0)
    return np.divide(weight, start, out=np.zeros_like(weight), where=start > 0)


def calibrate(mass: np.ndarray, factor: np.ndarray, share: float) -> np.ndarray:
    """Probabilities min(1, scale * factor) under which the expected mass is `share` of all, or as near as factors allow."""
    want, lo, hi = share * mass.sum(), 0.0, 1.0
    reach = mass[factor > 0].sum()
    if want >= reach:
        return (factor > 0).astype(float)
    while (mass * np.minimum(1, hi * factor)).sum() < want:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (mass * np.minimum(1, mid * factor)).sum() < want else (lo, mid)
    return np.round(np.minimum(1, hi * factor), DIGITS)


#: Scales that one pass over the cells tries, and digits that a probability is rounded to: both ways to rake agree on them.
SCALES, DIGITS = 64, 9


def _rake_frames(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None, alpha: float, share: float, rounds: int) -> DataFrame:
    """The same by DataFrames, for any number of cells. Cells stay as they are; what a step stores is one factor for each value
    of a dimension, of which a cell's weight is the product."""
    spark, cells = cells.sparkSession, stored(cells, "cells")
    total = cells.agg(F.sum("mass")).first()[0]
    factors, marginals = {}, {}
    for d in DIMS:
        have = cells.groupBy(d).agg((F.sum("mass") / total).alias("h"))
        goal = have.withColumn("t", F.pow("h", F.lit(alpha))) if not targets or d not in targets else have.join(spark.createDataFrame(list(targets[d].items()), f"{d} string, t double"), d, "left").fillna(0.0, ["t"])
        norm = goal.agg(F.sum("t")).first()[0]
        marginals[d] = stored(goal.selectExpr(d, f"t / {norm!r}D as t"), "target")
        factors[d] = marginals[d].selectExpr(d, f"1D as f_{d}")

    def weighted() -> DataFrame:
        out = cells
        for d in DIMS:
            out = out.join(factors[d], d)
        return out.withColumn("factor", F.col("f_source") * F.col("f_lang") * F.col("f_topic"))

    worst = 0.0
    for _ in range(rounds):
        worst = 0.0
        for d in DIMS:
            have = weighted().groupBy(d).agg(F.sum(F.col("mass") / total * F.col("factor")).alias("h"))
            step = have.join(marginals[d], d).join(factors[d], d).selectExpr(d, f"f_{d} * case when h > 0 then t / h else 0 end as f_{d}", "abs(h - t) as off")
            step = stored(step, "factors")
            worst = max(worst, step.agg(F.max("off")).first()[0])
            factors[d] = step.drop("off")
        if worst < TOLERANCE:
            break
    _report(worst)
    cells = stored(weighted().select(*DIMS, "mass", "factor"), "weighted")
    want, lo, hi = share * total, 0.0, 1.0
    reach = cells.where("factor > 0").agg(F.sum("mass")).first()[0] or 0
    if want >= reach:
        return cells.select(*DIMS, "factor", (F.col("factor") > 0).cast("double").alias("prob"))

    def at(*scales: float) -> list[float]:
        return list(cells.agg(*[F.sum(F.col("mass") * F.least(F.lit(1.0), F.col("factor") * x)).alias(f"s{i}") for i, x in enumerate(scales)]).first())

    while at(hi)[0] < want:
        hi *= 2
    for _ in range(9):
        tried = [lo + (hi - lo) * i / SCALES for i in range(1, SCALES)]
        below = sum(x < want for x in at(*tried))
        lo, hi = ([lo] + tried)[below], (tried + [hi])[below]
    return cells.select(*DIMS, "factor", F.round(F.least(F.lit(1.0), F.col("factor") * hi), DIGITS).alias("prob"))


def _report(off: float) -> None:
    if off >= TOLERANCE:
        warnings.warn(f"raking ended with a marginal off by {off:.3g} of all weight: the targets contradict each other over the cells", stacklevel=3)


def mix_weights(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, share: float = 0.5, alpha: float = 0.7, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", rounds: int = 200, most_cells: int = MOST_CELLS, carry: list[str] | None = None) -> DataFrame:
    """(id, source, lang, topic, n_tokens, weight, prob, kept) of each document.

    Cells are the combinations of source, language and topic, with their word counts as mass. Their weights are raked to
    `targets` (a share for each value, by dimension; a dimension not given: its own shares to the power `alpha`, which
    lifts small values). prob is min(1, scale * weight), with the scale at which a `share` of all words is expected to
    stay. kept compares prob with a uniform number made of seed and id, so that a run can be repeated and sharded.
    Values that the targets leave out get weight 0. Targets that contradict each other give a warning with what is left.
    Cells are few as a rule and raked on the driver, up to `most_cells` by count; beyond, by DataFrames to the same result.

    Nulls in source or lang are a value of their own, shown as null; null text has no words and its own cell's probability.
    `docs` needs the columns source and lang; a topic column is used if there is one. A null id draws one number of its
    own. Rows that repeat an id draw the same number. An empty table gives no rows. `carry` names columns of `docs` that come
    along; without it no others do.
    """
    rows = docs if "topic" in docs.columns else with_topic(docs, text_col)
    own = [c for c in docs.columns if c in (carry or ()) and c not in (id_col, *DIMS)]
    rows = rows.select(F.col(id_col), *[F.col(c).alias(f"__c_{c}") for c in own], *[F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(d) for d in DIMS], F.coalesce(F.regexp_count(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long").alias("n_tokens"))
    if not own:
        rows = stored(rows, "words")  # texts are read once: what is left of them is small
    cells = stored(rows.groupBy(*DIMS).agg(F.sum("n_tokens").cast("double").alias("mass")), "cells")
    n = cells.count()
    spark = docs.sparkSession
    kind = ", ".join(f"{d} string" for d in DIMS) + ", weight double, prob double"
    if n <= most_cells:
        found = sorted(tuple(r) for r in cells.collect())
        mass = np.array([r[3] for r in found], float)
        out = []
        if found and mass.sum() > 0:
            groups, goals = [], []
            for d, name in enumerate(DIMS):
                values = sorted({r[d] for r in found})
                at = {v: i for i, v in enumerate(values)}
                g = np.array([at[r[d]] for r in found])
                have = np.bincount(g, mass, len(values)) / mass.sum()
                want = dict(targets[name]) if targets and name in targets else tempered(dict(zip(values, have, strict=True)), alpha)
                groups.append(g)
                goals.append(np.array([want.get(v, 0.0) for v in values]))
            factor = rake(mass, groups, goals, rounds)
            prob = calibrate(mass, factor, share)
            # A cell without words has no mass to rake; its documents stay at the share.
            out = [(*r[:3], float(f), float(p)) if m > 0 else (*r[:3], 1.0, float(share)) for r, f, p, m in zip(found, factor, prob, mass, strict=True)]
        else:
            out = [(*r[:3], 1.0, float(share)) for r in found]
        table = F.broadcast(spark.createDataFrame(out, kind))
    else:
        raked = _rake_frames(cells.where("mass > 0"), targets, alpha, share, rounds).withColumnRenamed("factor", "weight")
        table = stored(cells.join(raked, list(DIMS), "left").selectExpr(*DIMS, "coalesce(weight, 1D) as weight", f"coalesce(prob, {share!r}D) as prob"), "probs")
    uniform = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(NONE))), 256), 1, 13), 16, 10).cast("double") / float(2**52)
    out = rows.join(table, list(DIMS)).withColumn("kept", uniform < F.col("prob"))
    return out.select(id_col, *[F.col(f"__c_{c}").alias(c) for c in own], *[F.nullif(F.col(d), F.lit(NONE)).alias(d) for d in DIMS], "n_tokens", "weight", "prob", "kept")

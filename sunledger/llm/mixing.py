"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Documents fall into cells by source, language and topic. The sample has a budget, a stated share of all tokens, and each of
the three dimensions' targets is a goal of expected tokens within it. Raking finds one factor per value; a cell's probability is the
product of its three factors, and 1 where that is more. Each step solves for a value's factor with what is clipped counted
whole, so the budget and the goals hold together: a rare cell that deserves more than it has is kept whole, and what it
lacks is spread over the others of its value instead of thinning the corpus to its measure. A goal beyond a value's own
tokens cannot be met: the value is kept whole, and the rest of the budget goes to the others in their proportions
(:func:`margins` tells which). All of it is DataFrame work: cells are few beside documents, but nothing asks them to fit
anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import own_names, run_dir, stored

#: A dimension's target shares: by value, or an exponent that tempers the shares the corpus has (1 leaves them).
Target = float | Mapping[str, float]

TEMPER = 0.9
#: Share of all tokens that the sample is expected to have.
KEEP = 0.5
#: Topics by what the lower-cased text contains; the first that fits.
TOPICS: dict[str, tuple[str, ...]] = {
    "legal": ("license", "licence", "copyright"),
    "contact": ("@", "http://", "https://"),
    "table": (" | ",),
}
OTHER_TOPIC = "prose"
TOKEN = r"[^\x20\x09-\x0D]+"
TOLERANCE = 1e-9
MOST_SWEEPS = 60
#: Stands for a null among the values of a dimension; no text value can hold it together with others by chance.
NULL = "\u0000null"
DIMENSIONS = ("mix_source", "mix_lang", "mix_topic")


@dataclass(frozen=True)
class Targets:
    source: Target = TEMPER
    lang: Target = TEMPER
    topic: Target = TEMPER
    topics: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: TOPICS)
    keep: float = KEEP


def topic_of(text: Column, topics: Mapping[str, tuple[str, ...]] = TOPICS) -> Column:
    """The first topic one of whose marks the text contains; a null text is an empty one."""
    low, out = F.lower(F.coalesce(text, F.lit(""))), None
    for topic, marks in topics.items():
        found = F.contains(low, F.lit(marks[0]))
        for mark in marks[1:]:
            found = found | F.contains(low, F.lit(mark))
        out = F.when(found, topic) if out is None else out.when(found, topic)
    return F.lit(OTHER_TOPIC) if out is None else out.otherwise(OTHER_TOPIC)


def with_cells(docs: DataFrame, topics: Mapping[str, tuple[str, ...]] = TOPICS) -> DataFrame:
    """All columns, with the cell's three and ``mix_tokens`` (words; at least 1, so that no document is free)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {
            "mix_source": F.coalesce(F.col("source").cast("string"), F.lit(NULL)),
            "mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NULL)),
            "mix_topic": topic_of(F.col("text"), topics),
            "mix_tokens": F.greatest(F.regexp_count(text, F.lit(TOKEN)), F.lit(1)).cast("bigint"),
        }
    )


def target_shares(cells: DataFrame, dimension: str, target: Target) -> DataFrame:
    """``<dimension>, share``: shares that add up to 1 over the values there are.

    Values that a mapping does not name share what it leaves, by their tokens; one it names but the corpus lacks is
    left out and the rest scaled up.
    """
    sums = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("tokens"))
    if isinstance(target, Mapping):
        pairs = [F.lit(x) for value, share in target.items() for x in (value, float(share))]
        named = F.element_at(F.create_map(*pairs), F.col(dimension)) if pairs else F.lit(None).cast("double")
        sums = sums.withColumn("named", named)
        left = max(0.0, 1.0 - sum(target.values()))
        rest = sums.agg(F.sum(F.when(F.col("named").isNull(), F.col("tokens")))).first()[0] or 1.0
        raw = F.coalesce(F.col("named"), F.col("tokens") * F.lit(left / rest))
    else:
        raw = F.pow("tokens", F.lit(float(target)))
    sums = sums.select(dimension, "tokens", raw.alias("raw"))
    total = sums.agg(F.sum("raw")).first()[0] or 1.0
    return sums.select(dimension, "tokens", (F.col("raw") / F.lit(float(total))).alias("share"))


def with_factor(rows: DataFrame, by: list[str], rate: str, goal: Column) -> DataFrame:
    """``factor``: the number f of each group with ``sum(tokens * min(1, rate * f)) = goal``.

    From the largest rate down, the first rows of a group are whole and the others in proportion; each row gives the f it
    would mean to be the first in proportion, and of those that are under their own limit the largest is right. A goal
    that takes all there is gives the least f that does.
    """
    down = Window.partitionBy(*by).orderBy(F.desc(rate))
    whole = F.coalesce(F.sum("tokens").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.sum(F.col("tokens") * F.col(rate)).over(down.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("tried", F.try_divide(goal - whole, others))
    group = Window.partitionBy(*by)
    least = F.try_divide(F.lit(1.0), F.min(rate).over(group))
    part = F.max(F.when(F.col("tried") * F.col(rate) < 1, F.col("tried"))).over(group)
    return rows.withColumn("factor", F.coalesce(part, least, F.lit(1.0))).drop("tried")


def goals(shares: DataFrame, dimension: str, budget: float) -> DataFrame:
    """``<dimension>, share, goal``: the budget dealt out by the shares, no value given more than its own tokens."""
    rows = shares.withColumn("rate", F.col("share") / F.col("tokens"))
    rows = with_factor(rows, [], "rate", F.lit(budget))
    goal = F.col("tokens") * F.least(F.lit(1.0), F.col("rate") * F.col("factor"))
    return rows.select(dimension, "share", goal.alias("goal"))


def rake(cells: DataFrame, shares: Mapping[str, DataFrame], keep: float, path: str) -> DataFrame:
    """``cells`` with ``probability``: clipped products of one factor per dimension that meet the goals.

    A step solves for one dimension's factors, given the others'; a value's cells are put in order, at most as many as there are
    pairs of values of the other two. Each cell carries its values' goals and factors, so that a sweep over the dimensions
    is one plan without joins; its factors are written, and one number comes back, how far they moved.
    """
    cells = cells.withColumn("tokens", F.col("tokens").cast("double"))
    budget = float(cells.agg(F.sum("tokens")).first()[0] or 0.0) * keep
    held = cells
    for dimension, share in shares.items():
        goal = stored(goals(share, dimension, budget), f"{path}/{dimension}")
        held = held.join(goal.select(dimension, F.col("goal").alias(f"{dimension}_goal")), dimension)
    held = held.withColumns({f"{d}_factor": F.lit(1.0) for d in shares})
    for sweep in range(MOST_SWEEPS):
        for dimension in shares:
            held = held.withColumn("rate", _product(d for d in shares if d != dimension))
            held = with_factor(held, [dimension], "rate", F.col(f"{dimension}_goal"))
            off = F.coalesce(F.abs(F.try_divide("factor", f"{dimension}_factor") - 1), F.lit(0.0))
            held = held.withColumns({f"{dimension}_off": off, f"{dimension}_factor": F.col("factor")}).drop("rate", "factor")
        held = stored(held, f"{path}/sweep-{sweep}")
        moved = held.agg(F.max(F.greatest(*(f"{d}_off" for d in shares)))).first()[0] or 0.0
        held = held.drop(*(f"{d}_off" for d in shares))
        if moved < TOLERANCE:
            break
    return held.select(*cells.columns, F.least(F.lit(1.0), _product(shares)).alias("probability"))


def _product(dimensions: Iterable[str]) -> Column:
    """The product of the factors of a cell's values."""
    return reduce(Column.__mul__, (F.col(f"{d}_factor") for d in dimensions), F.lit(1.0))


def draw(doc_id: str, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id and the seed alone: a retried task draws the same."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def mix(docs: DataFrame, targets: Targets = Targets(), seed: int = 7) -> DataFrame:
    """All rows and columns, with ``mix_source, mix_lang, mix_topic, mix_tokens, mix_weight, mix_probability, mix_kept``. The
    weight is the probability over the share that is kept, so weights times tokens add up to all tokens.

    A null source or language is a value like any other, a null text an empty one. Rows with the same id (also those
    without one) share their draw, so repeated rows stay or go together. An empty table gives an empty result. Columns
    of those names are replaced.
    """
    path = run_dir(docs.sparkSession, "mixing")
    rows = with_cells(docs, targets.topics)
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum("mix_tokens").alias("tokens"))
    cells = stored(cells, f"{path}/cells")
    wanted = dict(zip(DIMENSIONS, (targets.source, targets.lang, targets.topic)))
    shares = {dimension: target_shares(cells, dimension, target) for dimension, target in wanted.items()}
    raked = stored(rake(cells, shares, targets.keep, path), f"{path}/raked")
    weight = (F.col("probability") / F.lit(float(targets.keep))).alias("mix_weight")
    weights = raked.select(*DIMENSIONS, weight, F.col("probability").alias("mix_probability"))
    rows = rows.drop("mix_weight", "mix_probability", "mix_kept").join(weights, list(DIMENSIONS))
    return rows.withColumn("mix_kept", draw("doc_id", seed) < F.col("mix_probability"))


def margins(mixed: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """``dimension, value, tokens, share, expected, wanted`` of what :func:`mix` gave: a value's tokens, its target share,
    the tokens expected in the sample and those the target asks for. Where less is expected than wanted, the target cannot be met."""
    cells = mixed.groupBy(*DIMENSIONS).agg(
        F.sum("mix_tokens").alias("tokens"), F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("expected")
    )
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0.0) * targets.keep
    out = []
    for dimension, target in zip(DIMENSIONS, (targets.source, targets.lang, targets.topic)):
        shares = target_shares(cells, dimension, target).drop("tokens")
        sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"), F.sum("expected").alias("expected"))
        name = F.lit(dimension.removeprefix("mix_")).alias("dimension")
        row = sums.join(shares, dimension).withColumn("wanted", F.col("share") * total)
        out.append(row.select(name, F.col(dimension).alias("value"), "tokens", "share", "expected", "wanted"))
    return reduce(DataFrame.unionByName, out)


def sampled(docs: DataFrame, targets: Targets = Targets(), seed: int = 7) -> DataFrame:
    """The sample, with the input's columns, whatever these are called. Null sources, languages and texts count as
    :func:`mix` says; rows with one id share their draw, repeated ones stay or go together; an empty table stays empty."""
    clash = [c for c in docs.columns if c.lower().startswith("mix_")]
    aside = dict(zip(clash, own_names(docs, *clash)))
    rows = mix(docs.withColumnsRenamed(aside), targets, seed).filter("mix_kept")
    return rows.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))

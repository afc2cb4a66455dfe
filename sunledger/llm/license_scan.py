"""Licence scans: sparse TF-IDF cosine of notices to templates, then inheritance from the nearest directory above.

A file's notices may stand anywhere in it: every line, every paragraph (lines up to an empty one) and the whole text are
compared. Weights are term counts times inverse document frequencies over the templates, kept as whole numbers, so that a
cosine does not depend on the order of its sums; a word no template has weighs like the rarest and only lengthens a text.

A unit can only reach the threshold if it holds some of a template's weightiest terms (those without which the rest of
the template is too short a vector). Files without any such term are not taken apart. That prunes exactly.

Licence files give their licence to their directory. A file without a notice of its own takes that of the nearest
directory above it that has one, found by joining the distinct directories, spelt out with all their ancestors, with the
licensed ones. All of it is DataFrame work.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import run_dir, stored
from sunledger.llm.license_templates import TEMPLATES

THRESHOLD = 0.8
SCALE = 1000
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Names of licence files, in any case.
LICENSE_FILE = r"(?i)^(un)?licen[cs]e([.-].*)?$|^copying([.-].*)?$|^notice([.-].*)?$"
#: Terms that say nothing about licences, which the pruning does not lean on.
COMMON = frozenset("a and any as at by for from in is it not of on or that the this to with you".split())


def terms_of(text: str) -> Counter[str]:
    return Counter(re.findall(TERM, text.lower()))


class Templates:
    """Weights of the templates' terms. The collection is a parameter of bounded size."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD):
        self.names = [name for name, _ in templates]
        self.counts = [terms_of(text) for _, text in templates]
        self.threshold = threshold
        n, df = len(templates), Counter(term for count in self.counts for term in count)
        self.idf = {term: round(SCALE * (log((1 + n) / (1 + k)) + 1)) for term, k in df.items()}
        self.unseen = round(SCALE * (log(1 + n) + 1))

    def mandatory(self) -> list[str]:
        """Terms of which a unit must hold one to reach the threshold with any template: without a template's leading
        terms the rest of its vector is shorter than the threshold."""
        out: set[str] = set()
        for count in self.counts:
            weight = {term: (k * self.idf[term]) ** 2 for term, k in count.items()}
            left, total = sum(weight.values()), sum(weight.values())
            for term in sorted(weight, key=lambda t: (t in COMMON, len(t) < 4, t not in out, -weight[t], t)):
                if left < self.threshold**2 * total * (1 - 1e-9):
                    break
                out.add(term)
                left -= weight[term]
        return sorted(out)

    def postings(self, spark) -> DataFrame:
        """``term, template, template_weight``: one row per term of a template."""
        rows = [(t, i, k * self.idf[t]) for i, count in enumerate(self.counts) for t, k in count.items()]
        return spark.createDataFrame(rows, "term string, template int, template_weight bigint")

    def table(self, spark) -> DataFrame:
        rows = [
            (i, name, sum((k * self.idf[t]) ** 2 for t, k in count.items()))
            for i, (name, count) in enumerate(zip(self.names, self.counts))
        ]
        return spark.createDataFrame(rows, "template int, license string, template_norm bigint")


def directory_of(path: Column) -> Column:
    """Up to the last slash; the empty text is the root."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, r"/[^/]*$", "")).otherwise("")


def units(files: DataFrame, templates: Templates) -> DataFrame:
    """``row, path, unit, text``: lines, paragraphs and whole texts that hold a mandatory term; equal ones of a file
    once."""
    marks = templates.mandatory()
    low = F.lower(F.col("text"))
    # One pass over the text cuts it into terms; looking for each mark by itself would be a pass for each.
    some = files.filter(F.arrays_overlap(F.regexp_extract_all(low, F.lit(TERM), 0), F.lit(marks)))
    some = some.select(F.monotonically_increasing_id().alias("row"), "path", low.alias("text"))
    cut = F.concat(F.split("text", r"\r?\n"), F.split("text", r"\r?\n[\x20\t]*\r?\n"), F.array("text"))
    cut = F.array_distinct(F.filter(cut, lambda u: F.regexp_like(u, F.lit(rf"(?<![a-z0-9])({_either(marks)})(?![a-z0-9])"))))
    return some.select("row", "path", F.posexplode(cut).alias("unit", "text"))


def _either(marks: Sequence[str]) -> str:
    return "|".join(re.escape(mark) for mark in marks) or r"(?!)"


def notices(files: DataFrame, templates: Templates, path: str) -> DataFrame:
    """``path, license, score, share``: the best notice of each file. ``share`` is the part of the file's terms in it.

    Ties go to the template named first. ``files`` has ``path`` and ``text`` without nulls.
    """
    spark = files.sparkSession
    held = stored(units(files, templates), f"{path}/units")
    counted = held.select("row", "unit", F.explode(F.regexp_extract_all("text", F.lit(TERM), 0)).alias("term"))
    counted = counted.groupBy("row", "unit", "term").agg(F.count("*").alias("n"))
    # Both tables are the templates' own, of a size fixed by them.
    idf = spark.createDataFrame(list(templates.idf.items()), "term string, idf bigint")
    weighed = counted.join(F.broadcast(idf), "term", "left")
    weighed = weighed.select(
        "row", "unit", "term", "n", (F.col("n") * F.coalesce("idf", F.lit(templates.unseen))).alias("weight")
    )
    weighed = stored(weighed, f"{path}/weights")
    norms = weighed.groupBy("row", "unit").agg(
        F.sum(F.col("weight") * F.col("weight")).alias("norm"), F.sum("n").alias("terms")
    )
    dots = weighed.join(F.broadcast(templates.postings(spark)), "term").groupBy("row", "unit", "template")
    dots = dots.agg(F.sum(F.col("weight") * F.col("template_weight")).alias("dot"))
    scored = dots.join(norms, ["row", "unit"]).join(F.broadcast(templates.table(spark)), "template")
    length = F.sqrt(F.col("norm").cast("double")) * F.sqrt(F.col("template_norm").cast("double"))
    scored = scored.withColumn("score", F.col("dot").cast("double") / length)
    good = scored.filter(F.col("score") >= templates.threshold)
    best = good.groupBy("row").agg(
        F.max(F.struct("score", (-F.col("template")).alias("place"), "terms", "license")).alias("best")
    )
    whole = held.groupBy("row", "path").agg(F.max(F.size(F.regexp_extract_all("text", F.lit(TERM), 0))).alias("all"))
    # A whole text is one of its own units; where it holds no mandatory term, no unit of it does.
    return best.join(whole, "row").select(
        "path", "best.license", "best.score", F.least(F.lit(1.0), F.col("best.terms") / F.col("all")).alias("share")
    )


def nearest_directories(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """``directory, from_directory, license, score``: for each directory the nearest licensed one at or above it.

    Only distinct directories are spelt out, as many rows as they are deep, so a directory with a third of all files is
    one of them. The root is above all.
    """
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    depth = F.when(F.col("at") == "", 0).otherwise(F.size(F.split("at", "/")))
    spelt = directories.distinct().select("directory", F.explode(F.array_union(F.array(F.lit("")), above)).alias("at"))
    found = spelt.join(licensed.withColumnRenamed("directory", "at"), "at")
    found = found.groupBy("directory").agg(F.max_by(F.struct("at", "license", "score"), depth).alias("near"))
    return found.select("directory", F.col("near.at").alias("from_directory"), "near.license", "near.score")


def license_scan(
    files: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    license_file_share: float | None = None,
) -> DataFrame:
    """One row per path: ``path, license, score, found`` (``notice``, ``inherited`` or null) ``, from_directory``.

    ``files`` has ``path`` (parts divided by ``/``) and ``text``. Rows of one path are one file, and the best notice of
    them counts; a null path is the empty one, a null text an empty one. Licence files are those with such a name, and,
    where ``license_file_share`` is given, those whose notice makes up so much of their terms. Of several in a directory
    the best score counts, then the licence named first by its letters. Other columns are not looked at; an empty table
    gives an empty result.
    """
    spark, work = files.sparkSession, run_dir(files.sparkSession, "licenses")
    known = Templates(templates, threshold)
    clean = files.select(F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    best = notices(clean, known, work).groupBy("path").agg(F.max(F.struct("score", "share", "license")).alias("best"))
    own = stored(best.select("path", "best.license", "best.score", "best.share"), f"{work}/own")

    name = F.regexp_extract("path", r"([^/]*)$", 1)
    is_license_file = F.regexp_like(name, F.lit(LICENSE_FILE))
    if license_file_share is not None:
        is_license_file = is_license_file | (F.col("share") >= license_file_share)
    giving = own.filter(is_license_file).withColumn("directory", directory_of(F.col("path")))
    order = F.struct((-F.col("score")).alias("worse"), "license")
    giving = giving.groupBy("directory").agg(F.min(order).alias("first"))
    giving = giving.select("directory", "first.license", (-F.col("first.worse")).alias("score"))

    paths = clean.select("path").distinct().withColumn("directory", directory_of(F.col("path")))
    near = stored(nearest_directories(paths.select("directory"), giving), f"{work}/near")
    near = near.select("directory", "from_directory", F.col("license").alias("near_license"), F.col("score").alias("near_score"))
    rows = paths.join(own.select("path", "license", "score"), "path", "left").join(near, "directory", "left")
    has = F.col("license").isNotNull()
    return rows.select(
        "path",
        F.coalesce("license", "near_license").alias("license"),
        F.when(has, F.col("score")).otherwise(F.col("near_score")).alias("score"),
        F.when(has, "notice").when(F.col("near_license").isNotNull(), "inherited").alias("found"),
        F.when(~has, F.col("from_directory")).alias("from_directory"),
    )

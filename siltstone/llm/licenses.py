"""Licences of files: TF-IDF cosine of lines and whole files to templates, then inheritance along the path.

Every line and every whole text is compared with the templates. Terms are lower-case ASCII words and digits; idf counts the
documents with the term, over all documents and for all terms. Bounds leave out most of the work and lose nothing: by Cauchy-Schwarz
a line that shares only light terms with a template stays below the threshold, and so does a text whose own template terms are
a small part of its length. There the most common of the other words count exactly, and the rest as if each had the least
idf that any of them has. Only the units that pass are joined, term by term, with the document frequencies.

A file whose whole text matches is a licence file and speaks for its directory. Another file takes the licence of its
best line. What has neither inherits from the nearest directory above it (its own first) with a licence file; directories
are joined with their ancestors once each, not once per file. Only DataFrame functions.

Edge cases: a null or empty text has no words and can only inherit; a null path is in no directory and inherits
nothing; repeated rows give repeated result rows; a null doc_id is kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.frames import computed_once
from .common import remove_folder, shared_folder, written

# Public licence notices: fixed values.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
LINE_LEAST = 0.6
FILE_LEAST = 0.25
COMMON = 100  # words beside the templates' whose idf the bounds know; no result depends on it
BROADCAST_UNITS = 200_000  # texts up to which their keys and lines go to every task; beyond, texts and keys are shuffled
NOT_TERM = "[^a-z0-9]+"


def terms_of(text: str) -> list[str]:
    return [t for t in re.split(NOT_TERM, text.lower()) if t]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_TERM), lambda w: w != "")


def idf_of(n: int, df: int) -> float:
    return math.log((1 + n) / (1 + df)) + 1


def heavy_terms(idf: dict[str, float], templates: tuple[tuple[str, str], ...], least: float) -> list[str]:
    """Terms of which a text needs one to reach the cosine `least` with some template."""
    heavy = set()
    for _, text in templates:
        own = terms_of(text)
        weight = {t: own.count(t) * idf[t] for t in own}
        square, light = sum(w * w for w in weight.values()), 0.0
        for term in sorted(weight, key=lambda t: (weight[t], t)):
            light += weight[term] ** 2
            if math.sqrt(light / square) >= least * (1 - 1e-9):
                heavy.add(term)
    return sorted(heavy)


def _literal(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """The templates' few numbers as a broadcast table."""
    values = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True))) for row in rows))
    return F.broadcast(spark.range(1).select(F.inline(values)))


def _dots(units: DataFrame, keys: list[str], idf: dict[str, float], templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """keys, n, licence, dot (with the unit template), and square and number of the unit's words of known idf.

    A unit has its keys, `n` words, and as `terms` those of its words whose idf is known, with repetitions. One row per
    licence that shares a term; of a licence's templates the nearest counts.
    """
    spark = units.sparkSession
    weights = []
    for number, (licence, text) in enumerate(templates):
        own = terms_of(text)
        each = {t: own.count(t) * idf[t] for t in own}
        length = math.sqrt(sum(w * w for w in each.values()))
        weights += [(t, number, licence, w / length) for t, w in each.items()]
    known = _literal(spark, [(t, float(v)) for t, v in idf.items()], "term", "idf")
    sides = _literal(spark, weights, "term", "template", "licence", "weight")
    counts = units.select(*keys, "n", F.explode("terms").alias("term")).join(known, "term")
    counts = counts.groupBy(*keys, "n", "term", "idf").agg(F.count("*").alias("tf"))
    per_unit = counts.groupBy(*keys, "n").agg(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("square"), F.sum("tf").alias("inside"))
    dots = counts.join(sides, "term").groupBy(*keys, "template", "licence").agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    return dots.groupBy(*keys, "licence").agg(F.max("dot").alias("dot")).join(per_unit, keys)


def _outside(units: DataFrame, keys: list[str], frequencies: DataFrame, n: int, vocabulary: list[str]) -> DataFrame:
    """keys and the squared length of the part of a unit's vector that lies outside the known terms."""
    counts = units.select(*keys, F.explode(F.filter("words", lambda w: ~w.isin(vocabulary))).alias("term"))
    counts = counts.groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    idf = F.log(F.lit(1.0 + n) / (F.lit(1) + F.col("df"))) + 1
    # Terms by terms: a table of all terms is not small.
    joined = counts.join(frequencies.hint("merge"), "term")
    return joined.groupBy(*keys).agg(F.sum(F.pow(F.col("tf") * idf, 2)).alias("outside"))


def _square(terms: Column, idf: dict[str, float]) -> Column:
    """Squared length of the part of a text's vector that lies in the known terms."""
    of = F.create_map(*(F.lit(x) for pair in idf.items() for x in pair))

    def added(total: Column, term: Column) -> Column:
        tf = F.size(terms) - F.size(F.array_remove(terms, term))
        return total + F.pow(tf * F.element_at(of, term), F.lit(2.0))

    return F.aggregate(F.array_distinct(terms), F.lit(0.0), added)


def _best(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("rank = 1").drop("rank")


def directory(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.when(path.isNotNull(), F.lit("")))


def inherited(files: DataFrame, speakers: DataFrame) -> DataFrame:
    """dir, licence, cosine and the distance to the nearest directory with a licence, for every directory of `files`."""
    dirs = files.select("dir").dropna().distinct()
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    above = dirs.select("dir", depth.alias("depth"), F.explode(F.sequence(F.lit(0), depth)).alias("level"))
    ancestor = F.array_join(F.slice(F.split("dir", "/"), 1, F.col("level")), "/")
    found = above.select("dir", (F.col("depth") - F.col("level")).alias("distance"), ancestor.alias("ancestor"))
    found = found.join(speakers.withColumnRenamed("dir", "ancestor"), "ancestor")
    nearest = F.min(F.struct("distance", "licence", "cosine")).alias("nearest")
    return found.groupBy("dir").agg(nearest).select("dir", "nearest.*")


def scan(
    files: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    line_least: float = LINE_LEAST,
    file_least: float = FILE_LEAST,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, path, licence, origin (file, header, inherited or none), cosine and distance (directories up) of every file."""
    spark = files.sparkSession
    folder = shared_folder(spark)
    rows = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    vocabulary = sorted({t for _, text in templates for t in terms_of(text)})

    frequencies = rows.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    frequencies = written(frequencies, folder, "df")
    df = dict(frequencies.filter(F.col("term").isin(vocabulary)).collect())  # at most the templates' terms
    others = frequencies.filter(~F.col("term").isin(vocabulary)).orderBy(F.desc("df"), "term").limit(COMMON + 1).collect()
    n = rows.count()
    own_idf = {t: idf_of(n, df.get(t, 0)) for t in vocabulary}
    idf = own_idf | {r.term: idf_of(n, r.df) for r in others[:COMMON]}
    least_idf = idf_of(n, others[COMMON].df if len(others) > COMMON else 0)
    vocabulary = sorted(idf)
    # A cosine is rounded to six places before it is compared.
    file_bound, line_bound = file_least - 1e-6, line_least - 1e-6
    heavy = heavy_terms(idf, templates, line_bound)

    def known(column: Column) -> Column:
        return F.filter(column, lambda w: w.isin(vocabulary))

    def line_of(content: Column, number: Column) -> Column:
        return F.struct(number.alias("line"), words(content).alias("words"))

    def counted(line: Column) -> Column:
        own = line.getField("words")
        return F.struct(line.getField("line").alias("line"), F.size(own).alias("n"), known(own).alias("terms"))

    # No term runs over a line's end, so the words of the lines are those of the text.
    key = F.xxhash64("doc_id", "path", "text").alias("key")
    near = rows.select(key, "path", F.transform(F.split("text", "\n"), line_of).alias("lines"))
    near = near.select("key", "path", F.transform("lines", counted).alias("lines"))
    total = F.aggregate("lines", F.lit(0), lambda n, x: n + x.getField("n"))
    near = near.select("key", "path", "lines", total.alias("n"), F.flatten(F.col("lines.terms")).alias("terms"))
    has_heavy = F.arrays_overlap("terms", F.array(*map(F.lit, heavy)))
    headed = F.when(has_heavy, F.filter("lines", lambda x: F.exists(x.getField("terms"), lambda t: t.isin(heavy)))).alias("lines")
    # The part of the length in the templates' terms, against the whole length: no cosine is greater.
    inside = F.filter("terms", lambda w: w.isin(sorted(own_idf)))
    squares = [F.when(F.size("terms") > 0, _square(c, by)).alias(name) for name, c, by in (("square", F.col("terms"), idf), ("inside", inside, own_idf))]
    # The filter must not be pushed below all this work, where it would repeat it.
    near = computed_once(near.select("key", "path", "n", "terms", headed, *squares), ["key", "path"])
    whole_bound = F.col("inside") >= file_bound**2 * (F.col("square") + (F.col("n") - F.size("terms")) * least_idf**2)
    near = near.withColumn("whole", F.coalesce(whole_bound, F.lit(False))).filter("whole OR size(lines) > 0")
    near = near.select("key", "path", "n", F.when(F.col("whole"), F.col("terms")).alias("terms"), "lines", "whole")
    near = written(near, folder, "near").dropDuplicates(["key"])

    # Line -1 is the whole text.
    keys, least = ["key", "line"], F.when(F.col("line") < 0, file_least).otherwise(line_least)
    units = near.filter("whole").select("key", F.lit(-1).alias("line"), "n", "terms").union(near.select("key", F.inline("lines")))
    dots = _dots(units, keys, idf, templates)
    longest = F.sqrt(F.col("square") + (F.col("n") - F.col("inside")) * least_idf**2)
    dots = written(dots.filter(F.col("dot") / longest >= least - 1e-6), folder, "dots")
    # The texts of the few units that pass are read again, not kept.
    wanted = written(dots.groupBy("key").agg(F.collect_set("line").alias("wanted")), folder, "wanted")
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_UNITS else wanted
    texts = rows.select(key, "text").join(few, "key").dropDuplicates(["key"])
    content = F.when(F.col("line") < 0, F.col("text")).otherwise(F.element_at(F.split("text", "\n"), F.col("line") + 1))
    texts = texts.select("key", "text", F.explode("wanted").alias("line")).select(*keys, words(content).alias("words"))
    length = F.sqrt(F.col("square") + F.coalesce("outside", F.lit(0.0)))
    cosines = dots.join(_outside(texts, keys, frequencies, n, vocabulary), keys, "left")
    cosines = cosines.select(*keys, "licence", F.round(F.col("dot") / length, 6).alias("cosine"))
    cosines = written(cosines.filter(F.col("cosine") >= least), folder, "cosines")
    whole = _best(cosines.filter("line < 0"), "key", F.desc("cosine"), F.col("licence")).select("key", "licence", "cosine", F.lit("file").alias("origin"))
    headers = cosines.filter("line >= 0")
    headers = _best(headers, "key", F.desc("cosine"), F.col("line"), F.col("licence")).select("key", "licence", "cosine", F.lit("header").alias("origin"))
    own = whole.union(headers.join(whole, "key", "left_anti"))
    own = written(near.select("key", "path").join(own, "key"), folder, "own")

    # Licence files speak for their directory; of several, the nearest to its template.
    speakers = own.filter("origin = 'file'").withColumn("dir", directory(F.col("path"))).dropna(subset=["dir"])
    speakers = _best(speakers, "dir", F.desc("cosine"), F.col("licence")).select("dir", "licence", "cosine")
    keyed = rows.select("doc_id", "path", key, directory(F.col("path")).alias("dir"))
    from_above = inherited(keyed, speakers).toDF("dir", "distance", "above_licence", "above_cosine")
    out = keyed.join(own.drop("path"), "key", "left").join(from_above, "dir", "left")
    has_own = F.col("origin").isNotNull()
    out = written(
        out.select(
            "doc_id",
            "path",
            F.coalesce("licence", "above_licence").alias("licence"),
            F.when(has_own, F.col("origin")).when(F.col("above_licence").isNotNull(), "inherited").otherwise("none").alias("origin"),
            F.when(has_own, F.col("cosine")).otherwise(F.col("above_cosine")).alias("cosine"),
            F.when(~has_own, F.col("distance")).cast("long").alias("distance"),
        )
    )
    remove_folder(spark, folder)
    return out

"""Licence scans by lookup of canonical digests.

Texts are normalised (case, punctuation, white space, copyright lines, equivalent spellings) and their digests joined with
those of known licence texts and notices. A document is looked up as a whole, and so is each of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import tables

# Public licence notices, as (licence id, text).
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("reserved", "All rights reserved."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
]
# Equivalent spellings, after lower-casing and removal of punctuation: (pattern of words, instead).
SPELLINGS = [("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("creative commons", "cc"), ("attribution", "by"),
             ("noncommercial", "nc"), ("v2", "version 2"), ("v3", "version 3")]
COPYRIGHT = r"(?i)^[ \t]*(copyright|\(c\)|©)"


def _lines(text: Column) -> Column:
    """Lines in lower case without copyright lines and empty ones; other than ASCII letters and digits become single spaces."""
    plain = F.transform(
        F.split(text, "\n", -1),
        lambda x: F.when(~x.rlike(COPYRIGHT), F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))),
    )
    return F.filter(plain, lambda x: x.isNotNull() & (x != ""))


def _spelled(text: Column) -> Column:
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(text)


def canonical(text: Column) -> Column:
    return _spelled(F.array_join(_lines(text), " "))


def known_licences(spark: SparkSession) -> DataFrame:
    values = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in row)) for row in KNOWN)
    return spark.sql(f"SELECT * FROM VALUES {values} AS known(licence, text)")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, digest, licence, n_notices, notices`` for each row of ``docs`` (doc_id, text).

    ``digest`` is of the whole canonical text, null for null text; ``licence`` is what it equals, if anything. ``notices``
    are the sorted distinct licences that single lines equal, ``n_notices`` the number of such lines. Texts that are empty once
    normalised equal nothing. Of known texts (licence, text) with one digest the smallest id counts.
    """
    table = known.where("licence IS NOT NULL AND text IS NOT NULL").select("licence", canonical(F.col("text")).alias("_text"))
    table = table.where("_text <> ''").groupBy("_text").agg(F.min("licence").alias("licence"))
    table = tables.settle(table.select(_digest("_text").alias("_digest"), F.length("_text").alias("_length"), "licence"), "known")
    lengths = sorted(x[0] for x in table.select("_length").distinct().collect())
    side = tables.small_side(table.drop("_length"), 256)
    # only texts of a known length can equal a known text
    fits = lambda x: F.length(x).isin(lengths)
    rows = docs.select("doc_id", _lines(F.col("text").cast("string")).alias("_lines")).select(
        "doc_id", _spelled(F.array_join("_lines", " ")).alias("_whole"), F.filter(F.transform("_lines", _spelled), fits).alias("_short")
    )
    rows = tables.settle(rows.select("doc_id", _digest("_whole").alias("digest"), "_short").withColumn("uid", F.monotonically_increasing_id()), "digests")
    lines = rows.select("uid", F.explode("_short").alias("_line")).select("uid", _digest("_line").alias("_digest"))
    found = lines.join(side, "_digest").groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_notices"), F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("notices")
    )
    whole = rows.select("uid", "doc_id", "digest").join(side.withColumnRenamed("_digest", "digest"), "digest", "left")
    return whole.join(found, "uid", "left").select(
        "doc_id", "digest", "licence", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices")
    )


def _digest(column: str) -> Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)

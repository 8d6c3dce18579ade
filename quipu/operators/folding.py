"""Loose text equality resolved once per distinct text.

Comparing under a collation costs far more than comparing bytes, and a sort on such a
key compares again and again. So the distinct texts are matched under the collation, and
the long tables then join and group on plain text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import folded
from ..session import written

PRINTABLE = r"\A[ -~]*\z"


def distinct_texts(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def text_keys(texts: DataFrame, column: str) -> DataFrame:
    """Rows of distinct texts with `_key`, a plain text that texts equal under the collation share.

    Printable ASCII texts are equal under it where their lower case without trailing blanks
    is. Only the others are compared under the collation, whose collator is one lock to all
    tasks of an executor; they take the key of a printable text equal to them or else the least
    of their own. The texts are written with their keys: a minimum over them does not depend on
    repeats, so Catalyst would leave the distinct out and compare all rows.
    """
    text = F.col(column)
    keyed = written(texts.withColumn("_key", F.when(text.rlike(PRINTABLE), F.lower(F.rtrim(text)))), "texts")
    plain, odd = keyed.filter("_key is not null"), keyed.filter("_key is null").drop("_key")
    if odd.isEmpty():
        return plain
    odd = odd.withColumn("_fold", folded(text))
    known = plain.select("_key").distinct().withColumn("_fold", folded(F.col("_key")))
    heads = odd.groupBy("_fold").agg(F.min(column).alias("_head")).join(known, "_fold", "left")
    heads = heads.select("_fold", F.coalesce("_key", "_head").alias("_key"))
    return plain.unionByName(odd.join(heads, "_fold").drop("_fold"))


def canonical_texts(df: DataFrame, column: str, name: str) -> DataFrame:
    """Each distinct text with the least of the texts equal to it under the collation."""
    texts = text_keys(distinct_texts(df, column), column)
    heads = texts.groupBy("_key").agg(F.min(column).alias(name))
    return texts.join(heads, "_key").drop("_key")


def equal_texts(left: DataFrame, column: str, right: DataFrame, other: str) -> DataFrame:
    """Pairs of distinct texts of the two columns that are equal under the collation."""
    sides = [
        distinct_texts(df, c).select(F.col(c).alias("_text"), F.lit(mine).alias("_left"), F.lit(not mine).alias("_right"))
        for df, c, mine in ((left, column, True), (right, other, False))
    ]
    held = sides[0].unionByName(sides[1]).groupBy("_text").agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    keyed = text_keys(held, "_text")
    a = keyed.filter("_left").select("_key", F.col("_text").alias(column))
    b = keyed.filter("_right").select("_key", F.col("_text").alias(other))
    return a.join(b, "_key").drop("_key")

"""Site-relative line dedup: lines that too many pages of a site have are dropped.

Built-in functions only. Counting moves hashes, never texts, and a page's own
repeats are put together before; so a site with a third of all pages leaves
each task as one count for each of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.joins import sized_broadcast
from landfall.session import materialize

RATIO = 0.05
LEAST_PAGES = 5
BLANK = " \t\r"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """Hash of a line without the blanks around it; NULL for an empty one."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least: int = LEAST_PAGES,
) -> DataFrame:
    """(host, keys): the keys of a site's boilerplate lines.

    A line is boilerplate if more than ``ratio`` of the site's pages, and at
    least ``least``, have it. A site's pages hold each of these lines that
    often, so it has at most (mean lines of a page) / ratio of them, however
    many pages it has. NULL is a site like any other.
    """
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col(text)), line_key), lambda k: k.isNotNull()))
    pages = docs.select(F.col(host).alias("host"), F.coalesce(keys, F.array()).alias("keys"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    counts = (
        pages.select("host", F.explode("keys").alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
    )
    site = totals.withColumnRenamed("host", "site")
    often = counts.join(site, F.col("host").eqNullSafe(F.col("site")))
    often = often.where(F.col("n") > ratio * F.col("n_pages"))
    return often.groupBy("host").agg(F.collect_set("key").alias("keys"))


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least: int = LEAST_PAGES,
    counts: bool = True,
) -> DataFrame:
    """All rows and columns, the text without boilerplate lines.

    ``counts`` adds ``n_lines`` and ``n_dropped``, which replace columns of
    these names. Lines left keep their order and blanks.
    NULL text stays NULL with no lines; a text of boilerplate alone becomes
    empty; repeated rows are pages of their own. The sites' keys are broadcast
    if they measure small, else joined by shuffle.
    """
    found = materialize(docs.sparkSession, boilerplate(docs, host, text, ratio, least), "boilerplate")
    found = found.select(F.col("host").alias("__site"), F.col("keys").alias("__keys"))
    joined = docs.join(sized_broadcast(found), docs[host].eqNullSafe(F.col("__site")), "left")
    known = F.coalesce(F.col("__keys"), F.array().cast("array<bigint>"))
    kept = F.filter(
        lines_of(F.col(text)), lambda x: ~F.coalesce(F.array_contains(known, line_key(x)), F.lit(False))
    )
    joined = joined.withColumn("__kept", kept)
    if counts:
        lines = F.coalesce(F.size(lines_of(F.col(text))), F.lit(0)).cast("long")
        joined = joined.withColumn("n_lines", lines)
        joined = joined.withColumn("n_dropped", F.col("n_lines") - F.coalesce(F.size("__kept"), F.lit(0)))
    return joined.withColumn(text, F.array_join("__kept", "\n")).drop("__site", "__keys", "__kept")

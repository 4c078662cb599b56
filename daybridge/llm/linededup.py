"""Boilerplate lines by their frequency within a site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import fresh, joined_by_group, staged

# A line goes if more than this share of its site's pages has it, and at least so many pages.
RATIO, LEAST_PAGES = 0.02, 3

# So many boilerplate lines of all sites together are broadcast; beyond, only those of sites with many pages.
BROADCAST_LINES = 200_000


def drop_site_lines(pages: DataFrame, host: str, text: str, ratio: float = RATIO,
                    least_pages: int = LEAST_PAGES) -> tuple[DataFrame, str]:
    """The rows as they are with one more column, and its name: a struct of what is left of the text.

    ``text`` without boilerplate lines, ``n_lines``, ``n_dropped``. Lines are cut at \\n and compared
    trimmed of spaces; blank ones always stay. A line is boilerplate if more than ``ratio`` of the host's
    rows, and at least ``least_pages`` of them, have it; a row counts once however often it repeats the
    line. Rows with null host form one host; a null text stays null and has no line, but its row counts
    as a page; repeated rows are pages of their own; an empty table gives no rows.

    Lines are known by 64-bit hashes, and only those of boilerplate are kept, so a clean line would have to
    collide with one of its host's few. Counts are pre-aggregated before the shuffle, by host and line, so
    a host with a third of all rows is spread over its lines, and its texts are not shuffled: its boilerplate,
    at most 1 / ``ratio`` times the lines of a page, is broadcast.
    """
    name, site, lines, size = fresh(pages, "cleaned", "site", "boilerplate", "pages")

    def key(line):
        return F.xxhash64(F.trim(line))

    split = F.split(F.col(f"`{text}`"), "\n", -1)
    of = F.coalesce(F.xxhash64(F.col(f"`{host}`"), F.col(f"`{host}`").isNull()), F.lit(0))
    own = pages.select(of.alias("site"), F.explode(F.array_distinct(F.transform(
        F.filter(split, lambda x: F.trim(x) != ""), key))).alias("line"))
    totals = pages.groupBy(of.alias("site")).agg(F.count("*").alias("pages"))
    often = (own.groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
             .join(totals, "site").where(F.col("n") > ratio * F.col("pages")).select("site", "line"))
    dropped = staged(often)
    by_site = dropped.groupBy(F.col("site").alias(site)).agg(F.collect_set("line").alias(lines))
    rows = pages.withColumn(site, of)
    if dropped.count() <= BROADCAST_LINES:
        joined = rows.join(F.broadcast(by_site), site, "left")
    else:
        sized = staged(by_site.join(totals.toDF(site, size), site))
        joined = joined_by_group(rows, sized, [site], size, "left").drop(size)
    kept = F.filter(split, lambda x: (F.trim(x) == "") | ~F.coalesce(F.array_contains(F.col(lines), key(x)), F.lit(False)))
    count = F.coalesce(F.size(split), F.lit(0))
    count = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(count)
    left = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(kept))
    found = F.struct(F.array_join(kept, "\n").alias("text"), count.cast("long").alias("n_lines"),
                     (count - left).cast("long").alias("n_dropped"))
    return joined.withColumn(name, found).drop(site, lines), name

"""Line dedup by the frequency of a line within its site.

For each site the number of its pages that hold a line is divided by the number of its pages; lines that more than
`max_ratio` of at least `min_pages` pages hold are boilerplate of the site and leave all its pages. DataFrame
functions only. Each page counts a line once, counts are combined before the shuffle, and a site has at most
(lines per page) / max_ratio such lines, so they come back as one short list for each site.

Blank lines are neither counted nor dropped. Rows without a site or text stay as they are, and so do rows of which
nothing is left but empty text. Repeated rows are pages of their own. Columns beside the site and text are untouched.

With `copies_once` pages that are copies of one another count as one page together, so that a page's own body is not
boilerplate because of its copies. A page is such a copy when lines that pass the ratio make up more than half of its
characters; copies that share the least hash of those lines are a group, and each of k pages of a group weighs 1 / k, in
a line's count and in the site's total. With the new weights other lines may pass and make more copies, so this is
repeated until there are no more; only lines that could still pass are counted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged


def _lines(text: str) -> Column:
    return F.split(F.col(f"`{text}`"), "\n")


def boilerplate(pages: DataFrame, site: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """One row for each site that has boilerplate: _site and the list _boilerplate."""
    named = pages.filter(F.col(f"`{site}`").isNotNull()).select(F.col(f"`{site}`").alias("_site"), F.col(f"`{text}`").alias("_text"))
    totals = named.groupBy("_site").agg(F.count("*").alias("_pages"))
    lines = named.select("_site", F.explode(F.filter(F.array_distinct(_lines("_text")), lambda x: F.trim(x) != "")).alias("_line"))
    counts = lines.groupBy("_site", "_line").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_pages)
    often = counts.join(totals, "_site").filter(F.col("_n") > max_ratio * F.col("_pages"))
    return often.groupBy("_site").agg(F.collect_set("_line").alias("_boilerplate"))


def _shared(lines: Column, often: Column) -> Column:
    return F.filter(lines, lambda x: F.array_contains(often, x) & (F.trim(x) != ""))


def _group(lists: Column, lines: Column) -> Column:
    """The group of a page by the first list of lines that covers more than half of it; null for a page of its own."""
    size = lambda x: F.aggregate(x, F.lit(0), lambda n, line: n + F.length(F.trim(line)))

    def by(often: Column, round_: Column) -> Column:
        found = _shared(lines, often)
        least = F.array_min(F.transform(found, lambda x: F.xxhash64(x)))
        return F.when(2 * size(found) > size(lines), F.struct(round_.alias("round"), least.alias("least")))

    return F.get(F.array_compact(F.transform(lists, by)), F.lit(0))


def boilerplate_of_copies(pages: DataFrame, site: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """As `boilerplate`, with copies in a site counted as one page."""
    named = pages.filter(F.col(f"`{site}`").isNotNull()).select(F.col(f"`{site}`").alias("_site"), _lines(text).alias("_lines"))
    totals = staged(named.groupBy("_site").agg(F.count("*").alias("_pages")), "site-pages")
    lines = named.select("_site", F.explode(F.filter(F.array_distinct("_lines"), lambda x: F.trim(x) != "")).alias("_line"))
    counts = staged(lines.groupBy("_site", "_line").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_pages), "line-counts")
    weights, units, lists, copies = counts.withColumn("_weight", F.col("_n")), totals.withColumn("_units", F.col("_pages")), None, 0
    while True:
        passing = weights.join(units, "_site").filter((F.col("_weight") >= min_pages) & (F.col("_weight") > max_ratio * F.col("_units")))
        often = staged(passing.groupBy("_site").agg(F.collect_set("_line").alias("_boilerplate")), "boilerplate-of-round")
        one = F.array("_boilerplate")
        if lists is None:
            lists = often.select("_site", one.alias("_lists"))
        else:
            added = F.when(F.col("_boilerplate").isNull(), F.col("_lists")).otherwise(F.concat(F.coalesce("_lists", F.array().cast("array<array<string>>")), one))
            lists = staged(lists.join(often, "_site", "full").select("_site", added.alias("_lists")), "boilerplate-of-rounds")
        grouped = named.join(lists, "_site").withColumn("_group", _group(F.col("_lists"), F.col("_lines")))
        sizes = staged(grouped.filter("_group IS NOT NULL").groupBy("_site", "_group").agg(F.count("*").alias("_size")), "copy-groups")
        found = sizes.agg(F.sum("_size")).first()[0] or 0
        if found == copies:
            return often
        copies = found
        fewer = sizes.groupBy("_site").agg(F.sum("_size").alias("_copies"), F.count("*").alias("_groups"))
        units = totals.join(fewer, "_site", "left").select("_site", (F.col("_pages") - F.coalesce("_copies", F.lit(0)) + F.coalesce("_groups", F.lit(0))).alias("_units"))
        units = staged(units, "site-units")
        maybe = counts.join(units, "_site").filter(F.col("_n") > max_ratio * F.col("_units")).groupBy("_site").agg(F.collect_set("_line").alias("_maybe"))
        held = named.join(staged(maybe, "boilerplate-candidates"), "_site").join(lists, "_site", "left").select(
            "_site", _group(F.col("_lists"), F.col("_lines")).alias("_group"), F.explode(F.array_distinct(_shared(F.col("_lines"), F.col("_maybe")))).alias("_line")
        )
        met = held.groupBy("_site", "_line", "_group").agg(F.count("*").alias("_m"))
        same = (F.col("s._site") == F.col("m._site")) & (F.col("s._group") == F.col("m._group"))
        share = F.col("_m") / F.coalesce("_size", F.lit(1))
        weighed = met.alias("m").join(sizes.alias("s"), same, "left").groupBy("m._site", "_line").agg(F.sum(share).alias("_weight"))
        weights = staged(weighed.withColumn("_weight", F.round("_weight", 6)), "line-weights")


def drop_boilerplate(
    pages: DataFrame, site: str = "source", text: str = "text", max_ratio: float = 0.1, min_pages: int = 5, counts: bool = False, copies_once: bool = False
) -> DataFrame:
    """`pages` with the boilerplate lines of their sites taken out of `text`; with `counts`, n_lines and n_dropped too."""
    find = boilerplate_of_copies if copies_once else boilerplate
    found = staged(find(pages, site, text, max_ratio, min_pages), "boilerplate")
    whole = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("page")  # so that no column clashes with ours
    rows = pages.select(whole, F.col(f"`{site}`").alias("site"), F.col(f"`{text}`").alias("text"))
    joined = rows.join(found, F.col("site") == F.col("_site"), "left")
    often = F.coalesce(F.col("_boilerplate"), F.array().cast("array<string>"))
    kept = F.filter(_lines("text"), lambda x: ~F.array_contains(often, x))
    cleaned = F.when(F.col("_site").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.concat_ws("\n", kept))
    columns = [cleaned.alias(c) if c == text else F.col(f"page.`{c}`").alias(c) for c in pages.columns]
    if counts:
        size = lambda lines: F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
        columns += [size(_lines("text")).alias("n_lines"), (size(_lines("text")) - size(kept)).alias("n_dropped")]
    return joined.select(*columns)


SQL = """
WITH page AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
total AS (SELECT source, count(*) AS pages FROM page WHERE source IS NOT NULL GROUP BY source),
line AS (SELECT source, unnest(list_distinct(lines)) AS line FROM page WHERE source IS NOT NULL),
often AS (
  SELECT source, line FROM line JOIN total USING (source) WHERE trim(line) <> ''
  GROUP BY source, line, pages HAVING count(*) >= 5 AND count(*) > 0.1 * pages),
site AS (SELECT source, list(line) AS lines FROM often GROUP BY source),
done AS (
  SELECT doc_id, page.text, page.lines, site.lines AS bad,
    list_filter(page.lines, lambda x: NOT list_contains(coalesce(site.lines, []), x)) AS kept
  FROM page LEFT JOIN site USING (source))
SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN bad IS NULL THEN text ELSE array_to_string(kept, chr(10)) END AS text,
  CASE WHEN text IS NULL THEN 0 ELSE len(lines) END AS n_lines,
  CASE WHEN text IS NULL THEN 0 ELSE len(lines) - len(kept) END AS n_dropped
FROM done
"""

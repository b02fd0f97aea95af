"""Line deduplication by site: lines that too large a share of a site's pages repeat are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.session import cut_lineage

#: A line is boilerplate when more than this share of its site's pages has it ...
RATIO = 0.1
#: ... and at least so many pages do.
MIN_PAGES = 5

#: Elements that end a line of text.
_BLOCKS = "p|br|div|li|ul|ol|h[1-6]|article|section|nav|header|footer|title|table|tr|td|th|blockquote|pre|hr"
BREAKS = rf"(?i)</?(?:{_BLOCKS})(?:[\s/][^>]*)?>"
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<[^>]*>"
BLANKS = " \t\r"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")]


def html_text(html: str | Column) -> Column:
    """The visible text of a page, one line for each block element."""
    out = F.regexp_replace(html, BREAKS, "\n")
    out = F.regexp_replace(out, HIDDEN, "")
    for name, sign in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(sign))
    return out


def host_of(url: str | Column) -> Column:
    """The host of an address in lower case; null when there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), F.lit(""))


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def boilerplate_lines(docs: DataFrame, text: str, site: str, ratio: float = RATIO, min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """(site, lines): 64-bit hashes of each site's boilerplate lines.

    Without copies, a site's pages of equal text count as one page. Counts are summed before they are shuffled. The shares of a site's lines add up to its
    mean number of lines, so a list has at most that number divided by ratio.
    """
    source = docs.select(F.col(site).alias("site"), F.col(text).alias("text")).filter("site IS NOT NULL")
    hashes = F.array_distinct(F.transform(F.filter(F.transform(F.split("text", "\n", -1), _trimmed), lambda x: x != ""), lambda x: F.xxhash64(x)))
    if copies:
        pages = source
    else:
        hashed = source.select("site", F.xxhash64("text").alias("text_key"), hashes.alias("hashes"))
        pages, hashes = cut_lineage(hashed.dropDuplicates(["site", "text_key"])), F.col("hashes")
    totals = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    counts = pages.select("site", F.explode(hashes).alias("line")).groupBy("site", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    return counts.join(totals, "site").filter(F.col("n") > ratio * F.col("pages")).groupBy("site").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES, max_share: float | None = None, copies: bool = True
) -> DataFrame:
    """docs with boilerplate lines cut from `text`, and n_lines and n_dropped added.

    Lines are the pieces between line feeds; they are equal when they are so after blanks
    at both ends are cut (tabs and carriage returns count as blanks). A line counts once
    for a page. Blank lines are never dropped. With max_share, a text whose boilerplate
    lines hold more than that share of its characters stays whole: it is a copy of other
    texts rather than a page with a frame, and copies are for the near-duplicate operator. Without copies, pages of equal text count as
    one, so a page is no frame for being copied, and what is left of it is cut like any other.

    Null text stays null with no lines. Rows without a site stay whole. Repeated rows are
    pages of their own. Clashing column names are no matter: only n_lines and n_dropped are
    added, in place of columns of that name.
    """
    # Stored first, so that its size is known when the join is planned: few lines go to the texts, not the texts to them.
    marked = cut_lineage(boilerplate_lines(docs, text, site, ratio, min_pages, copies)).select(F.col("site").alias("__site"), F.col("lines").alias("__boilerplate"))
    lines = F.split(F.col(text), "\n", -1)
    names = docs.columns
    out = docs.join(marked, F.col(site) == F.col("__site"), "left")
    parts = F.transform(
        lines, lambda x: F.struct(x.alias("line"), (F.coalesce(F.array_contains("__boilerplate", F.xxhash64(_trimmed(x))), F.lit(False)) & (_trimmed(x) != "")).alias("frame"))
    )
    out = out.withColumn("__parts", parts)
    frame = F.filter("__parts", lambda p: p["frame"])
    drop = F.size(frame)
    if max_share is not None:
        chars = F.aggregate(frame, F.lit(0), lambda acc, p: acc + F.length(p["line"]) + 1)
        drop = F.when(chars <= max_share * (F.length(F.col(text)) + 1), drop).otherwise(F.lit(0))
    out = out.withColumn("__dropped", F.when(F.col("__boilerplate").isNull() | F.col(text).isNull(), F.lit(0)).otherwise(drop))
    rest = F.concat_ws("\n", F.transform(F.filter("__parts", lambda p: ~p["frame"]), lambda p: p["line"]))
    added = {
        text: F.when(F.col("__dropped") > 0, rest).otherwise(F.col(text)),
        "n_lines": F.coalesce(F.size(F.filter("__parts", lambda p: _trimmed(p["line"]) != "")), F.lit(0)).cast("bigint"),
        "n_dropped": F.col("__dropped").cast("bigint"),
    }
    kept = [added.pop(n).alias(n) if n in added else F.col(f"`{n}`") for n in names]
    return out.select(*kept, *(c.alias(n) for n, c in added.items()))

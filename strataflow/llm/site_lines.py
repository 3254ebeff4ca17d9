"""Line dedup by frequency within a site.

A line that stands on more than a given share of a site's pages (and on a least number of them) is boilerplate and is
dropped from all of the site's pages.  Lines are counted once per page, as 128-bit digests, with partial sums before the
shuffle.  A site has at most ``lines per page / share`` such lines, so its list is small however many pages it has; pages
only meet the list of their site.

Plain documents have no finer site than their source, which may hold millions of them.  There, a long line in a fixed number of
different texts is repeated, too, and each repeated line stays in one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: White space cut from both ends of a line before comparing, and the pattern of a line without content.
_EDGES = " \t\n\x0b\x0c\r"
#: Salts that spread the lines of one large site when they meet the site's page total.
SALTS = 64
#: Bits that tell which texts may lose lines: 8 MB handed to all tasks, whatever the number of texts.
MARKS = 1 << 26


def text_lines(text: Column) -> Column:
    """Lines of a plain text; none for null."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def html_lines(html: Column) -> Column:
    """Lines of a page's text: tags end a line, but for those inside running text."""
    running = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), r"(?i)</?(?:a|b|i|u|em|strong|small|span)(?:\s[^>]*)?>", "")
    return F.filter(F.transform(F.split(running, r"<[^>]*>|\n"), lambda x: F.btrim(x, F.lit(_EDGES))), lambda x: x != "")


def url_host(url: Column) -> Column:
    """Lower-cased host of a URL, without user and port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(_EDGES))))


def boilerplate(pages: DataFrame, site: Column, lines: Column, share: float, least_pages: int) -> DataFrame:
    """(site, drop): for every site with any, the digests of its boilerplate lines.

    Pages without a site and lines without content are not counted.
    """
    per_page = pages.select(site.alias("site"), F.array_distinct(F.transform(
        F.filter(lines, lambda x: F.btrim(x, F.lit(_EDGES)) != ""), _digest)).alias("digests")).where("site is not null")
    seen = (per_page.select("site", F.explode("digests").alias("digest")).groupBy("site", "digest")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
            .withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS))))
    totals = (pages.select(site.alias("site")).where("site is not null").groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
              .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
    frequent = seen.join(totals, ["site", "salt"]).where(F.col("n") > F.lit(share) * F.col("pages"))
    return stored(frequent.groupBy("site").agg(F.collect_list("digest").alias("drop")), "boilerplate")


def drop_site_lines(pages: DataFrame, site: Column, lines: Column, share: float = 0.2, least_pages: int = 3) -> DataFrame:
    """Add ``kept_lines`` (array of lines, in order) and ``n_lines`` to every row.

    A row without a site keeps all its lines, as do sites with fewer than ``least_pages`` pages.  Lines without content are
    kept.  Repeated rows count as pages of their own.  Columns named like the added ones are replaced.
    """
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("kept_lines", "n_lines")]
    lists = boilerplate(pages, site, lines, share, least_pages).select(F.col("site").alias("__site"), F.col("drop").alias("__drop"))
    rows = pages.select(*kept, site.alias("__of"), lines.alias("__lines"))
    joined = rows.join(lists, F.col("__of") == F.col("__site"), "left")
    return joined.select(*kept, F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(F.filter(
        "__lines", lambda x: ~F.array_contains("__drop", _digest(x)))).alias("kept_lines"), F.size("__lines").cast("long").alias("n_lines"))


def repeated_lines(docs: DataFrame, share: float, least_pages: int, long_line: int, least_texts: int) -> DataFrame:
    """(site, print, drop): for every text of a source that loses any, the digests of its lines that other texts carry.

    A line is counted once per different text of a source, so exact copies count once.  It is repeated if it stands in at least
    ``least_pages`` texts and more than ``share`` of them, or has ``long_line`` characters and stands in ``least_texts`` texts,
    however large the source.  One text, that with the least digest, keeps it.  A text of which long repeated lines make at
    least eight ninths is a copy as a whole and loses nothing: two such texts are about 0.8 similar.
    """
    text, edges = F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(_EDGES)
    lines = F.array_distinct(F.filter(F.transform(text_lines(text), lambda x: F.btrim(x, edges)), lambda x: x != ""))
    found = docs.where("source is not null").select(F.col("source").alias("site"), F.unhex(F.md5(text)).alias("print"), F.transform(
        lines, lambda x: F.struct(_digest(x).alias("digest"), F.length(x).alias("size"))).alias("lines"))
    texts = stored(found.dropDuplicates(["site", "print"]), "line_texts")
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    each = texts.select("site", "print", F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x["size"]).alias("total"),
                        F.inline("lines"))
    seen = (each.groupBy("site", "digest").agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("carrier"), F.max("size").alias("size"))
            .where(F.col("n") >= min(least_pages, least_texts)).withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS))))
    totals = texts.groupBy("site").agg(F.count(F.lit(1)).alias("texts")).select("site", "texts", salt)
    long = (F.col("size") >= long_line) & (F.col("n") >= least_texts)
    often = (F.col("n") >= least_pages) & (F.col("n") > F.lit(share) * F.col("texts"))
    repeated = stored(seen.join(totals, ["site", "salt"]).where(long | often).select("site", "digest", "carrier", long.alias("long")), "repeated")
    hits = each.withColumn("salt", F.pmod(F.xxhash64("print"), F.lit(SALTS))).join(
        repeated.select("*", salt), ["site", "digest", "salt"])
    lost = hits.groupBy("site", "print").agg(F.collect_list(F.when(F.col("print") != F.col("carrier"), F.col("digest"))).alias("drop"),
                                             F.sum(F.when(F.col("long"), F.col("size")).otherwise(0)).alias("copied"), F.max("total").alias("total"))
    return stored(lost.where((F.size("drop") > 0) & (9 * F.col("copied") < 8 * F.col("total"))).select("site", "print", "drop"), "lost_lines")


def clean_documents(docs: DataFrame, share: float = 0.2, least_pages: int = 3, long_line: int = 40, least_texts: int = 10) -> DataFrame:
    """Documents (text, source, n_chars, ...) without the lines repeated in their source (``repeated_lines``); columns stay as they are.

    Each repeated line stays in one text.  Documents that lose all their lines stay with an empty text; a null text stays null;
    without a source, a document keeps all its lines.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns]
    lost = repeated_lines(docs, share, least_pages, long_line, least_texts).select(
        F.col("site").alias("__site"), F.col("print").alias("__print"), F.col("drop").alias("__drop"))
    rows = docs.select(*kept, F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("__of"))
    marked = rows.withColumn("__mark", _mark("source", "__of")).withColumn("__bucket", F.bitmap_bucket_number("__mark")).join(
        F.broadcast(_marks(lost)), "__bucket", "left").withColumn("__may", F.col("source").isNotNull() & _is_set(F.col("__bits"), F.col("__mark")))
    # Whole texts are shuffled only where they may lose lines, by the same plan for lists of any size.
    joined = marked.where("__may").select(*kept, "__of").join(
        lost.hint("merge"), (F.col("source") == F.col("__site")) & (F.col("__of") == F.col("__print")), "left").select(*kept, "__drop")
    others = marked.where(~F.coalesce("__may", F.lit(False))).select(*kept, F.lit(None).cast(lost.schema["__drop"].dataType).alias("__drop"))
    text = F.when(F.col("__drop").isNull(), F.col("text").cast("string")).otherwise(F.array_join(F.filter(
        text_lines(F.col("text")), lambda x: ~F.array_contains("__drop", _digest(x))), "\n"))
    new = {"text": text, "n_chars": F.when(F.col("text").isNotNull(), F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return joined.union(others).select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def _mark(site: str, print_: str) -> Column:
    """The bit of a text of a site, from 1 on as the bitmap functions count."""
    return F.pmod(F.xxhash64(site, print_), F.lit(MARKS)) + 1


def _marks(lost: DataFrame) -> DataFrame:
    """(__bucket, __bits): bitmaps of the bits of all texts that lose lines, at most ``MARKS`` bits in all."""
    bit = _mark("__site", "__print")
    return (lost.select(F.bitmap_bucket_number(bit).alias("__bucket"), F.bitmap_bit_position(bit).alias("at")).repartition("__bucket")
            .groupBy("__bucket").agg(F.bitmap_construct_agg("at").alias("__bits")))


def _is_set(bits: Column, mark: Column) -> Column:
    """Whether a bitmap holds a bit; null without a bitmap."""
    at = F.bitmap_bit_position(mark)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (at % 8).cast("int")) == 1

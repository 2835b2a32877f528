"""Landed RSS and Atom documents to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from ..functions.text import html_to_text, or_empty
from ..functions.web import dedupe_key, first_image
from ..operators.dedupe import drop_known, keep_first
from ..operators.keywords import with_matches
from ..session import written

_URL = T.ArrayType(T.StructType([T.StructField("_url", T.StringType())]))
# with an attribute an element is a struct whose text is _VALUE
_TEXT = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_type", T.StringType())])

RSS_ITEM = T.StructType([
    T.StructField("title", _TEXT), T.StructField("summary", _TEXT), T.StructField("description", _TEXT),
    T.StructField("link", T.StringType()), T.StructField("media:content", _URL),
    T.StructField("_corrupt_record", T.StringType())])
ATOM_ENTRY = T.StructType([
    T.StructField("title", _TEXT), T.StructField("summary", _TEXT), T.StructField("content", _TEXT),
    T.StructField("link", T.ArrayType(T.StructType([T.StructField("_href", T.StringType()),
                                                    T.StructField("_rel", T.StringType())]))),
    T.StructField("media:content", _URL), T.StructField("_corrupt_record", T.StringType())])


def _raw(reader: DataFrameReader | DataStreamReader, path: str | list[str], tag: str,
         schema: T.StructType) -> DataFrame:
    """Records of all documents with their file; a record that cannot be read keeps its text in _corrupt_record."""
    raw = (reader.format("xml").schema(schema).option("rowTag", tag).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").option("ignoreCorruptFiles", True)
           .load(path))
    return raw.withColumn("feed", F.col("_metadata.file_name"))


def _read(reader: DataFrameReader | DataStreamReader, path: str | list[str], tag: str,
          schema: T.StructType) -> DataFrame:
    """Items of all documents; what cannot be read is skipped, as a failing feed is (``feed_rejects`` tells which)."""
    # the filter also reads the title (always true): Spark refuses to read the corrupt-record column alone, which a
    # count of the items would otherwise ask for
    parsed = F.length(F.coalesce(F.col("title._VALUE"), F.lit(""))) >= 0
    return _raw(reader, path, tag, schema).where(F.col("_corrupt_record").isNull() & parsed)


def items(reader: DataFrameReader | DataStreamReader, path: str | list[str]) -> DataFrame:
    """(feed, title, summary_html, link, media_urls) of RSS items and Atom entries, batch or stream."""
    media = F.col("media:content._url").alias("media_urls")
    rss = _read(reader, path, "item", RSS_ITEM).select(
        "feed", or_empty("title._VALUE").alias("title"),
        summary_choice(F.col("summary._VALUE"), F.col("description._VALUE")).alias("summary_html"),
        or_empty("link").alias("link"), media)
    alternate = F.filter("link", lambda e: F.coalesce(e["_rel"], F.lit("alternate")) == "alternate")
    atom = _read(reader, path, "entry", ATOM_ENTRY).select(
        "feed", or_empty("title._VALUE").alias("title"),
        summary_choice(F.col("summary._VALUE"), F.col("content._VALUE")).alias("summary_html"),
        or_empty(F.try_element_at(alternate, F.lit(1))["_href"]).alias("link"), media)
    return rss.unionByName(atom)


def feed_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(feed, reason, records) of what ``items`` leaves out: per file the records that could not be read
    ('corrupt record', counted in the item and in the entry pass, as both read every file), and files with neither a readable item nor entry ('no items', records 0), which covers files
    that are not XML at all. Files are listed without reading their content. Runs Spark jobs while it is built."""
    # Spark reads the corrupt-record column only beside a parsed one, so the records are written with their title
    records = [written(_raw(spark.read, path, tag, schema).select(
        "feed", "title", F.col("_corrupt_record").isNotNull().alias("bad")))
        for tag, schema in (("item", RSS_ITEM), ("entry", ATOM_ENTRY))]
    per_file = records[0].drop("title").unionByName(records[1].drop("title")).groupBy("feed").agg(
        F.sum(F.col("bad").cast("long")).alias("bad"), F.sum((~F.col("bad")).cast("long")).alias("good"))
    files = (spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("feed"))
             .join(per_file, "feed", "left"))
    corrupt = files.where(F.col("bad") > 0).select("feed", F.lit("corrupt record").alias("reason"),
                                                   F.col("bad").alias("records"))
    empty = files.where(F.coalesce("good", F.lit(0)) == 0).select(
        "feed", F.lit("no items").alias("reason"), F.lit(0).cast("long").alias("records"))
    return corrupt.unionByName(empty)


def numbered(found: DataFrame) -> DataFrame:
    """Add ``item_ord``, which orders the items of one document (a document is read by one task)."""
    return found.withColumn("item_ord", F.monotonically_increasing_id())


def read_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return numbered(items(spark.read, path))


def summary_choice(summary: Column, description: Column) -> Column:
    """The summary, or the description when it is missing or empty, or ''."""
    return F.coalesce(F.nullif(summary, F.lit("")), description, F.lit(""))


def with_feed_order(items: DataFrame, feeds: DataFrame | None = None) -> DataFrame:
    """Add ``feed_ord`` from a feed table (feed, feed_ord), in which feeds that it lacks come last;
    without a table feeds are taken by name."""
    if feeds is None:
        return items.withColumn("feed_ord", F.col("feed"))
    last = F.lit(2 ** 31 - 1)
    return (items.join(feeds.select("feed", "feed_ord"), "feed", "left")
            .withColumn("feed_ord", F.coalesce("feed_ord", last)))


def article_rows(items: DataFrame, seed: DataFrame, ingested_at: Column | None = None,
                 known: DataFrame | None = None) -> DataFrame:
    """Deduplicated articles with matched keywords and image, from items with ``feed_ord``.

    Of items with the same key the first stays, in feed order, then item order. ``known`` is a table
    of keys which earlier runs have stored.
    """
    rows = items.select("feed_ord", "item_ord", "title", html_to_text("summary_html").alias("summary"), "link",
                        first_image("summary_html", "media_urls").alias("image_url"))
    rows = keep_first(rows.withColumn("key", dedupe_key()), ["key"], ["feed_ord", "item_ord"])
    if known is not None:
        rows = drop_known(rows, known, ["key"])
    text = F.lower(F.concat("title", F.lit(" "), "summary"))
    matched = with_matches(rows, text, seed)
    return matched.withColumn("ingested_at", ingested_at if ingested_at is not None else F.current_timestamp()).select(
        "title", "summary", "link", "matched_keywords", "ingested_at", "image_url", "key", "feed_ord", "item_ord")

"""RSS and Atom feeds, from bytes to entries and child sources, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar, text
from ..operators.relational import top_of

_ITEM = "array<struct<title:string,link:string,guid:string,description:string,pubDate:string,`dc:date`:string>>"
#: Items stand within the channel, or beside it in feeds of the RDF kind.
_RSS = f"struct<channel:struct<item:{_ITEM}>,item:{_ITEM}>"
_ATOM = (
    "struct<entry:array<struct<title:string,link:array<struct<_rel:string,_href:string>>,summary:string,content:string,published:string,updated:string>>>"
)


def timestamps(x: Column) -> Column:
    """Times of RFC 822 (with or without a weekday) or ISO 8601; null if neither."""
    plain = F.regexp_replace(text.strip(x), r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(
        F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss xx")),
        F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(plain),
    )


def entries(feeds: DataFrame, content: str = "content", url: str = "feed_url") -> DataFrame:
    """(feed_url, pos, url, title, summary, published_at): one row per entry that has a link.

    feeds: feed_url and the content (bytes or text). Malformed XML gives no entries.
    """
    raw = feeds.withColumn("_x", F.col(content).cast("string")).withColumn("_kind", scalar.sniffed(F.col("_x").cast("binary")))
    rss = F.from_xml(F.when(F.col("_kind") == "rss", F.col("_x")), F.lit(_RSS))
    atom = F.from_xml(F.when(F.col("_kind") == "atom", F.col("_x")), F.lit(_ATOM))
    from_rss = F.transform(
        F.coalesce(F.when(F.size(rss["channel"]["item"]) > 0, rss["channel"]["item"]), rss["item"]),
        lambda i: F.struct(
            F.nullif(text.strip(i["link"]), F.lit("")).alias("url"), text.clean(i["title"]).alias("title"), text.clean(i["description"]).alias("summary"), timestamps(F.coalesce(i["pubDate"], i["dc:date"])).alias("published_at")
        ),
    )
    from_atom = F.transform(
        atom["entry"],
        lambda e: F.struct(
            F.nullif(text.strip(F.get(F.filter(e["link"], lambda k: F.coalesce(F.lower(k["_rel"]), F.lit("alternate")) == "alternate"), F.lit(0))["_href"]), F.lit("")).alias("url"),
            text.clean(e["title"]).alias("title"),
            text.clean(F.coalesce(e["summary"], e["content"])).alias("summary"),
            timestamps(F.coalesce(e["published"], e["updated"])).alias("published_at"),
        ),
    )
    found = raw.select(url, F.posexplode(F.coalesce(from_rss, from_atom)).alias("pos", "e")).select(F.col(url).alias("feed_url"), "pos", "e.*")
    return found.where("url is not null")


def failures(feeds: DataFrame, content: str = "content", url: str = "feed_url") -> DataFrame:
    """(feed_url, error): feeds that are malformed and gave no entry; one that is malformed but gave some is none of them."""
    raw = feeds.select(F.col(url).alias("feed_url"), F.col(content).cast("string").alias("_x"))
    closed = F.regexp_extract(text.strip("_x"), r"</\s*([A-Za-z:]+)\s*>$", 1)
    opened = F.regexp_extract("_x", r"<\s*(rss|feed|rdf:RDF|RDF)\b", 1)
    malformed = F.coalesce((opened == "") | (F.lower(closed) != F.lower(opened)), F.lit(True))
    some = entries(feeds, content, url).select("feed_url").distinct()
    return raw.where(malformed).join(some, "feed_url", "left_anti").select("feed_url", F.lit("malformed feed without entries").alias("error"))


def recent(found: DataFrame, now: Column, since_days: int = 90, most: int = 50) -> DataFrame:
    """Entries not older than ``since_days`` (0: any age; undated ones stay), the first ``most`` of each feed, one at least."""
    kept = found
    if since_days > 0:
        kept = kept.where(F.col("published_at").isNull() | (F.col("published_at") >= now - F.make_interval(days=F.lit(since_days))))
    return top_of(kept, ["feed_url"], max(most, 1), "pos")


def expanded(sources: DataFrame, found: DataFrame) -> DataFrame:
    """Sources to crawl: html ones as they are, each feed replaced by its entries with its policy.

    sources: url, label, task, max_chars, pir_ids, feed_type.
    """
    pages = sources.where(F.coalesce("feed_type", F.lit("html")) == "html").withColumn("feed_type", F.lit("html"))
    feeds = sources.where(F.col("feed_type").isin("rss", "atom")).withColumnRenamed("url", "feed_url")
    children = feeds.join(found.select("feed_url", "url", "title"), "feed_url").select(
        "url",
        F.when(F.col("title").isNotNull(), F.concat_ws(": ", F.nullif("label", F.lit("")), "title")).otherwise(F.col("label")).alias("label"),
        "task",
        "max_chars",
        "pir_ids",
        F.lit("html").alias("feed_type"),
    )
    return pages.unionByName(children)

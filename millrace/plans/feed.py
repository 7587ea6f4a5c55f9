"""Post feed: landed pages -> RAW rows -> typed STAGE rows, incrementally."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import null_tokens
from millrace.functions.timetext import parse_utc
from millrace.operators.keys import after_watermark, dedup_first, watermark_by
from millrace.schemas import COUNT_COLUMNS, FEED_PAGE, POST_RAW_COLUMNS, POST_STAGE


def feed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON pages, one row per page (one JSON document per line)."""
    return spark.read.schema(FEED_PAGE).json(path)


def flatten_feed(
    pages: DataFrame, client: dict[str, str] | None = None, captured: Column | None = None
) -> DataFrame:
    """One row per feed item: the 21 feed columns with real types, and the owner
    of the feed, who differs from the author on a repost.

    The client account travels as four values, so no separator can split a
    display name. A missing embed is null.
    """
    client = client or {}
    item = pages.select("feed_owner_did", F.explode("feed").alias("item")).select("feed_owner_did", "item.post.*")
    link = F.col("record.embed.external")
    fields = {
        "content_id": F.col("cid"),
        "post_uri": F.col("uri"),
        **{c: F.col(c) for c in COUNT_COLUMNS},
        "post_created_timestamp": parse_utc("record.created_at"),
        "text": F.col("record.text"),
        "tags": F.col("record.tags"),
        "embedded_link_title": link["title"],
        "embedded_link_description": link["description"],
        "embedded_link_uri": link["uri"],
        "post_author_did": F.col("author.did"),
        "post_author_username": F.col("author.handle"),
        "post_author_displayname": F.col("author.display_name"),
        "post_author_account_created_timestamp": parse_utc("author.created_at"),
        **{
            f"bluesky_client_account_{k}": F.lit(client.get(k))
            for k in ("did", "username", "displayname")
        },
        "bluesky_client_account_created_timestamp": parse_utc(F.lit(client.get("created_at")).cast("string")),
        "record_captured_timestamp": captured if captured is not None else F.current_timestamp(),
    }
    return item.select(*[c.alias(name) for name, c in fields.items()], "feed_owner_did")


COMPARED = (
    *COUNT_COLUMNS,
    "text",
    "tags",
    "embedded_link_title",
    "embedded_link_description",
    "embedded_link_uri",
    "post_author_username",
    "post_author_displayname",
    "post_author_account_created_timestamp",
)


def newest_first() -> list[Column]:
    """Order in which copies of a post are compared; total but for equal rows."""
    return [
        F.col("post_created_timestamp").desc_nulls_last(),
        F.col("record_captured_timestamp").desc_nulls_last(),
        F.col("feed_owner_did").asc_nulls_last(),
        F.col("post_uri").asc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in COMPARED],
    ]


def watermark_by_author(posts: DataFrame) -> DataFrame:
    return watermark_by(posts, "post_author_did", "post_created_timestamp")


def new_posts(posts: DataFrame, watermark: DataFrame) -> DataFrame:
    """Posts newer than their author's watermark, each content id once per author.

    The watermark comes first, as it drops most rows before they are shuffled; the
    newest copy passes it if any copy does.
    """
    fresh = after_watermark(posts, watermark, "post_author_did", "post_created_timestamp")
    return dedup_first(fresh, ["post_author_did", "content_id"], newest_first())


def to_raw(posts: DataFrame, container: str, path: str, name: str | Column) -> DataFrame:
    """The 24 landed columns, all text: tags as JSON, instants as ISO text in UTC."""
    stamped = posts.withColumns(
        {
            "azure_container_name": F.lit(container),
            "azure_blobpath": F.lit(path),
            "azure_blobname": F.lit(name) if isinstance(name, str) else name,
        }
    )
    out = []
    for column in POST_RAW_COLUMNS:
        kind = stamped.schema[column].dataType.typeName()
        if kind == "timestamp":
            shown = F.date_format(F.to_utc_timestamp(column, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        elif kind == "array":
            shown = F.to_json(column)
        else:
            shown = F.col(column).cast("string")
        out.append(shown.alias(column))
    return stamped.select(*out)


# what people wrote: "null" and "nan" are words there
OWN_WORDS = ("text", "tags", "post_author_username", "post_author_displayname", "embedded_link_title", "embedded_link_description")


def to_stage(raw: DataFrame) -> DataFrame:
    """Typed posts: null spellings folded, counts, instants and tags parsed, and
    the author columns renamed."""
    clean = null_tokens(raw, [f.name for f in raw.schema if f.name not in OWN_WORDS])
    renamed = clean.withColumnsRenamed(
        {c: c.removeprefix("post_") for c in clean.columns if c.startswith("post_author_")}
    )
    cols = []
    for field in POST_STAGE:
        kind = field.dataType.typeName()
        source = F.col(field.name)
        if kind == "timestamp":
            source = parse_utc(source)
        elif kind == "array":
            source = F.from_json(source, "array<string>")
        elif kind == "long":
            source = source.try_cast("bigint")
        cols.append(source.alias(field.name))
    return renamed.select(*cols)

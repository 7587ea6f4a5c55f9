"""Fixed schemas. Columns are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The 24 columns of the landed post table, in order.
POST_RAW_COLUMNS = [
    "content_id",
    "post_uri",
    "like_count",
    "quote_count",
    "reply_count",
    "repost_count",
    "post_created_timestamp",
    "text",
    "tags",
    "embedded_link_title",
    "embedded_link_description",
    "embedded_link_uri",
    "post_author_did",
    "post_author_username",
    "post_author_displayname",
    "post_author_account_created_timestamp",
    "bluesky_client_account_did",
    "bluesky_client_account_username",
    "bluesky_client_account_displayname",
    "bluesky_client_account_created_timestamp",
    "record_captured_timestamp",
    "azure_container_name",
    "azure_blobpath",
    "azure_blobname",
]

POST_RAW = T.StructType([T.StructField(name, T.StringType()) for name in POST_RAW_COLUMNS])

COUNT_COLUMNS = ("like_count", "quote_count", "reply_count", "repost_count")

def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_TEXT, _WHOLE, _TIME = T.StringType(), T.LongType(), T.TimestampType()

POST_STAGE = _struct(
    content_id=_TEXT,
    post_uri=_TEXT,
    like_count=_WHOLE,
    quote_count=_WHOLE,
    reply_count=_WHOLE,
    repost_count=_WHOLE,
    post_created_timestamp=_TIME,
    text=_TEXT,
    tags=T.ArrayType(_TEXT),
    embedded_link_title=_TEXT,
    embedded_link_description=_TEXT,
    embedded_link_uri=_TEXT,
    author_did=_TEXT,
    author_username=_TEXT,
    author_displayname=_TEXT,
    author_account_created_timestamp=_TIME,
    record_captured_timestamp=_TIME,
)

_AUTHOR = _struct(did=_TEXT, handle=_TEXT, display_name=_TEXT, created_at=_TEXT)
_LINK = _struct(title=_TEXT, description=_TEXT, uri=_TEXT)
_RECORD = _struct(created_at=_TEXT, text=_TEXT, tags=T.ArrayType(_TEXT), embed=_struct(external=_LINK))
_POST = _struct(
    cid=_TEXT,
    uri=_TEXT,
    like_count=_WHOLE,
    quote_count=_WHOLE,
    reply_count=_WHOLE,
    repost_count=_WHOLE,
    author=_AUTHOR,
    record=_RECORD,
)

FEED_PAGE = _struct(cursor=_TEXT, feed=T.ArrayType(_struct(post=_POST)), feed_owner_did=_TEXT)

# The 58 columns of the tick table, in order.
TICK_COLUMNS = [
    "DATE", "TIME", "SYM", "PIMCOINTERNALKEY", "MDSID", "FEEDSEQNUM", "FEEDAPP", "VENDORUPDATETIME",
    "MDSRECEIVETIME", "MDSPUBLISHTIME", "TYPE", "GMTOFFSET", "EXCHTIME", "SEQNUM", "PRICE", "VOLUME",
    "ACCVOLUME", "MARKETVWAP", "OPEN", "HIGH", "LOW", "BLOCKTRD", "TICKDIR", "TURNOVER", "BIDPRICE",
    "BIDSIZE", "ASKPRICE", "ASKSIZE", "BUYERID", "NOBUYERS", "SELLERID", "NOSELLERS", "MIDPRICE",
    "BIDTIC", "ASKTONE", "BIDTONE", "TRADETONE", "MKTSTIND", "IRGCOND", "LSTSALCOND", "CRSSALCOND",
    "TRTRDFLAG", "ELIGBLTRD", "PRCQLCD", "LOWTP1", "HIGHTP1", "ACTTP1", "ACTFLAG1", "OFFBKTYPE",
    "GV3TEXT", "GV4TEXT", "ALIAS", "MFDTRANTP", "MMTCLASS", "SPRDCDN", "STRGYCDN", "OFFBKCDN", "PRCQL2",
]

TICK_TIMES = ("TIME", "VENDORUPDATETIME", "MDSRECEIVETIME", "MDSPUBLISHTIME", "EXCHTIME")
TICK_WHOLE = ("FEEDSEQNUM", "VOLUME", "ACCVOLUME", "BIDSIZE", "ASKSIZE", "LSTSALCOND")
TICK_PRICES = ("PRICE", "MARKETVWAP", "OPEN", "HIGH", "LOW", "BIDPRICE", "ASKPRICE", "GMTOFFSET")


def _tick_type(name: str) -> T.DataType:
    if name == "DATE":
        return T.DateType()
    if name in TICK_TIMES:
        return T.TimestampNTZType()
    if name in TICK_WHOLE:
        return T.LongType()
    return T.DoubleType() if name in TICK_PRICES else T.StringType()


TICK = T.StructType([T.StructField(name, _tick_type(name)) for name in TICK_COLUMNS])
TICK_TEXT = T.StructType([T.StructField(name, T.StringType()) for name in TICK_COLUMNS])

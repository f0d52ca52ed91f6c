"""Explicit schemas of the tables and a check against them.

Event times are ``timestamp_ntz`` holding UTC wall-clock time, so no result depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


_INT, _LONG, _SHORT, _BYTE = T.IntegerType(), T.LongType(), T.ShortType(), T.ByteType()
_FLOAT, _STRING, _TIME = T.FloatType(), T.StringType(), T.TimestampNTZType()

RAW_EVENTS = _struct(
    timestamp=_LONG, visitorid=_LONG, event=_STRING, itemid=_LONG, transactionid=_LONG
)
EVENTS = _struct(timestamp=_TIME, visitorid=_INT, event=_STRING, itemid=_INT, transactionid=_INT)
RAW_ITEM_PROPERTIES = _struct(timestamp=_LONG, itemid=_LONG, property=_STRING, value=_STRING)
ITEM_PROPERTIES = _struct(timestamp=_TIME, itemid=_INT, property=_STRING, value=_STRING)
RAW_CATEGORY_TREE = _struct(categoryid=_LONG, parentid=_LONG)
CATEGORY_TREE = _struct(categoryid=_SHORT, parentid=_SHORT)
TOP_POPULAR = _struct(itemid=_INT, score=_LONG, rank=_INT)
PERSONAL_ALS = _struct(visitorid=_INT, itemid=_INT, score=_FLOAT, rank=_SHORT)
SIMILAR = _struct(itemid=_INT, similar_itemid=_INT, score=_FLOAT, rank=_SHORT)
CANDIDATES = _struct(
    user_id=_INT,
    item_id=_INT,
    als_score=_FLOAT,
    als_rank=_SHORT,
    popular_score=_FLOAT,
    popular_rank=_SHORT,
    similarity_score=_FLOAT,
    similarity_rank=_SHORT,
    similarity_sources=_SHORT,
    from_als=_BYTE,
    from_popular=_BYTE,
    from_similar=_BYTE,
    popular_score_log=_FLOAT,
)
RECOMMENDATIONS = _struct(user_id=_INT, item_id=_INT, score=_FLOAT, rank=_SHORT)


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` unchanged if it has every column of ``schema`` with the same type."""
    actual = dict(df.dtypes)
    wrong = [
        f"{field.name}: expected {field.dataType.simpleString()}, got {actual.get(field.name)}"
        for field in schema.fields
        if actual.get(field.name) != field.dataType.simpleString()
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, in its order, cast to its types."""
    return df.select(*[df[field.name].cast(field.dataType) for field in schema.fields])

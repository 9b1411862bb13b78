"""Record layouts shared by sources and operators."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


STRING_MAP = T.MapType(T.StringType(), T.StringType())

CHANGE_RECORD = T.StructType(
    [
        *_strings("database", "table", "type", "ts"),
        T.StructField("data", STRING_MAP),
        T.StructField("old", STRING_MAP),
    ]
)

CONFIG_FIELDS = ("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")

CONFIG_RECORD = T.StructType(
    [
        T.StructField("before", T.StructType(_strings(*CONFIG_FIELDS))),
        T.StructField("after", T.StructType(_strings(*CONFIG_FIELDS))),
        *_strings("op"),
        T.StructField("ts_ms", T.LongType()),
    ]
)

COMMON = T.StructType(_strings("ar", "uid", "os", "ch", "is_new", "md", "mid", "vc", "ba"))

PAGE = T.StructType(
    [
        *_strings("page_id", "item", "item_type", "last_page_id"),
        T.StructField("during_time", T.LongType()),
    ]
)

START = T.StructType(
    [
        *_strings("entry"),
        T.StructField("loading_time", T.LongType()),
        T.StructField("open_ad_id", T.LongType()),
        T.StructField("open_ad_ms", T.LongType()),
        T.StructField("open_ad_skip_ms", T.LongType()),
    ]
)

APP_LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("start", START),
        T.StructField("displays", T.ArrayType(STRING_MAP)),
        T.StructField("actions", T.ArrayType(STRING_MAP)),
        *_strings("err"),
        T.StructField("ts", T.LongType()),
    ]
)

PAGE_MAP = T.StructType(
    [T.StructField("page", STRING_MAP), T.StructField("ts", T.LongType())]
)

DICTIONARY = T.StructType(
    [
        *_strings("dic_code", "dic_name", "parent_code"),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("operate_time", T.TimestampType()),
    ]
)

SENSOR_READING = T.StructType(
    [*_strings("id"), T.StructField("vc", T.DoubleType()), T.StructField("ts", T.LongType())]
)

SENSOR_NAME = T.StructType([*_strings("id", "name"), T.StructField("ts", T.LongType())])

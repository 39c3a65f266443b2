"""Input schemas of the analytics jobs (user actions, users, products, cities)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACTION_COLUMNS = [
    "date", "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
    "pay_category_ids", "pay_product_ids", "city_id",
]

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

# optional 14th column used only to break ties between equal action times
USER_VISIT_ACTION_WITH_ID = T.StructType(USER_VISIT_ACTION.fields + [T.StructField("event_id", T.LongType())])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# the ad log: one line of text per click, parsed by operators.ads
AD_LOG = T.StructType([T.StructField("value", T.StringType())])

_WIDTH = {T.ByteType(): 1, T.ShortType(): 2, T.IntegerType(): 4, T.LongType(): 8}


def _fits(have: T.DataType, want: T.DataType) -> bool:
    return have == want or (want in _WIDTH and _WIDTH.get(have, 9) < _WIDTH[want])


def conform(df: DataFrame, schema: T.StructType, name: str, optional: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """The columns of ``schema`` (and the optional ones there are), or an error that names every wrong column.

    Narrower whole numbers are widened. Only the columns are looked at, so filters and
    column pruning still reach the reader, and other columns are not read.
    """
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"no column {f.name}" if f.name not in have else
             f"column {f.name} is {have[f.name].simpleString()} and not {f.dataType.simpleString()}"
             for f in schema if f.name not in have or not _fits(have[f.name], f.dataType)]
    if wrong:
        raise ValueError(f"{name}: {'; '.join(wrong)}")
    cast = [F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*cast, *[c for c in optional if c in have and c not in schema.fieldNames()])

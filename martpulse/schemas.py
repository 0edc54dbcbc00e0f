"""Record schemas of the topics and tables (reader-declared, fixed).

Every field the wire carries as text is declared STRING, so a JSON number lands as its text and a
missing field as null, as the reference readers behave. Typed columns are derived afterwards.
"""

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names):
    return [T.StructField(n, S) for n in names]


# Raw app log as posted by the client (before the intake stamps ``ts``).
RAW_LOG = T.StructType(_strings("type", "mid", "uid", "os", "appid", "area", "ch", "vs", "evid",
                                "pgid", "npgid", "itemid"))

# Startup topic record; logDate/logHour are derived by the reader.
STARTUP = T.StructType(_strings("area", "uid", "os", "ch", "appid", "mid", "type", "vs")
                       + [T.StructField("ts", T.LongType())])

# Event topic record.
EVENT = T.StructType(_strings("mid", "uid", "appid", "area", "os", "ch", "type", "evid", "pgid",
                              "npgid", "itemid") + [T.StructField("ts", T.LongType())])

# Order row as routed from the change log: all strings on the wire, total_amount coerced later.
ORDER = T.StructType(_strings(
    "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id", "payment_way",
    "delivery_address", "order_comment", "out_trade_no", "trade_body", "create_time",
    "operate_time", "expire_time", "tracking_no", "parent_order_id", "img_url", "province_id"))

DETAIL = T.StructType(_strings("id", "order_id", "sku_name", "sku_id", "order_price", "img_url",
                               "sku_num", "create_time"))

USER = T.StructType(_strings("id", "login_name", "user_level", "birthday", "gender"))
# A user message as relayed: the row and the number of its change-log entry (its version).
USER_MESSAGE = T.StructType([*USER.fields, T.StructField("seq", S)])

# One change-log entry: row after-image as a string map.
CDC = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("db", S),
    T.StructField("tbl", S),
    T.StructField("op", S),
    T.StructField("after", T.MapType(S, S)),
])

# Wide sale row (order x detail x user).
SALE = T.StructType(
    _strings("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
             "user_gender")
    + [T.StructField("user_age", T.IntegerType())]
    + _strings("user_level")
    + [T.StructField("sku_price", T.DoubleType())]
    + _strings("sku_name", "dt"))

ALERT = T.StructType([
    T.StructField("id", S),
    T.StructField("mid", S),
    T.StructField("uids", T.ArrayType(S)),
    T.StructField("item_ids", T.ArrayType(S)),
    T.StructField("events", T.ArrayType(S)),
    T.StructField("ts", T.LongType()),
])

"""Tables of connection strings: ``h=db1,P=3306,D=shop,t=orders,u=app``.

Items are separated by commas outside double quotes; within quotes a backslash keeps a
quote from ending the text.  Each item is a one-letter key and, after the first ``=``,
its value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the known keys
_KEYS = ["A", "b", "D", "F", "h", "L", "p", "P", "s", "S", "t", "u", "v", "x"]
# fixed values: the accepted boolean texts
_TRUE = ["1", "t", "T", "TRUE", "true", "True"]
_FALSE = ["0", "f", "F", "FALSE", "false", "False"]

# One item after its comma.  All loops are possessive, so long values neither backtrack
# nor overflow; the text gets a leading comma so that the first item is no special case.
_ITEM = r',([^,"]*+(?:"[^"]*+(?:(?<=\\)"[^"]*+)*+(?:"|\z)[^,"]*+)*+)'


def split_items(text: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(_ITEM), F.lit(1))


def _items(text: Column) -> Column:
    def item(part: Column) -> Column:
        at = F.locate("=", part)
        return F.struct(
            part.alias("text"),
            F.when(at > 0, F.substring(part, F.lit(1), at - 1)).alias("key"),
            F.when(at > 0, F.substring(part, at + 1, F.length(part))).alias("value"),
        )

    return F.transform(split_items(text), item)


def _item_error(item: Column) -> Column:
    value = item["value"]
    digits = F.regexp_replace(value, "^0+", "")
    port = F.when(digits.rlike(r"^[0-9]{1,5}\z"), digits.cast("int"))
    in_range = F.coalesce(port.between(1, 65535), F.lit(False))
    return (
        F.when(item["key"].isNull(), F.concat(F.lit("missing '=': "), item["text"]))
        .when(~item["key"].isin(_KEYS), F.concat(F.lit("unknown key: "), item["key"]))
        .when(
            (item["key"] == "P") & ~value.rlike(r"^[0-9]*\z"),
            F.concat(F.lit("port is not a number: "), value),
        )
        .when((item["key"] == "P") & ~in_range, F.concat(F.lit("port out of range: "), value))
    )


def _flag_error(item: Column) -> Column:
    return F.when(
        item["key"].isin("b", "s") & ~item["value"].isin(_TRUE + _FALSE),
        F.concat(F.lit("not a boolean: "), item["text"]),
    )


def _first_error(items: Column, check) -> Column:
    found = F.filter(F.transform(items, check), lambda e: e.isNotNull())
    return F.get(found, F.lit(0))


def dsn_audit(df: DataFrame, col: str) -> DataFrame:
    """Replace the text by ``dsn`` (its parts), ``error``, ``uri`` and ``jdbc_url``.

    The first faulty item decides the error, and the parts are NULL then.  Of a repeated
    key the last item counts.  Passwords are masked; the text itself, which may hold one,
    is not part of the result.
    """
    parsed = df.withColumn("_items", _items(F.col(col)))

    def value(key: str) -> Column:
        hits = F.filter("_items", lambda i: i["key"] == key)
        return F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])

    def flag(key: str, default: bool) -> Column:
        return F.coalesce(value(key).isin(_TRUE), F.lit(default))

    error = F.coalesce(
        F.when(F.col(col).isNull(), F.lit("missing")),
        _first_error(F.col("_items"), _item_error),
        _first_error(F.col("_items"), _flag_error),
    )
    parts = F.struct(
        F.coalesce(value("A"), F.lit("utf8mb4")).alias("charset"),
        flag("b", False).alias("skip_binlog"),
        F.coalesce(value("D"), F.lit("")).alias("database"),
        F.coalesce(value("h"), F.lit("")).alias("host"),
        F.coalesce(value("P").cast("int"), F.lit(3306)).alias("port"),
        F.when(F.coalesce(value("p"), F.lit("")) != "", F.lit("***")).otherwise("").alias("password"),
        flag("s", True).alias("ssl"),
        F.coalesce(value("S"), F.lit("")).alias("socket"),
        F.coalesce(value("t"), F.lit("")).alias("table"),
        F.coalesce(value("u"), F.lit("")).alias("user"),
        F.coalesce(value("v"), F.lit("")).alias("setvars"),
        F.coalesce(value("x"), F.lit("parseTime=true")).alias("extra"),
    )
    audited = parsed.withColumn("error", error).withColumn("dsn", F.when(F.col("error").isNull(), parts))
    return audited.withColumn("uri", _uri(F.col("dsn"))).withColumn("jdbc_url", _jdbc(F.col("dsn"))).drop("_items", col)


def _uri(dsn: Column) -> Column:
    """``user:***@tcp(host:port)/db?options`` or ``…@unix(socket)/db?options``."""
    password = F.when(dsn["password"] != "", F.concat(F.lit(":"), dsn["password"])).otherwise("")
    login = F.when(dsn["user"] != "", F.concat(dsn["user"], password)).otherwise("")
    host = F.when(dsn["host"] != "", dsn["host"]).otherwise("localhost")
    place = F.when(
        dsn["socket"] != "", F.concat(F.lit("unix("), dsn["socket"], F.lit(")"))
    ).otherwise(F.concat(F.lit("tcp("), host, F.lit(":"), dsn["port"].cast("string"), F.lit(")")))
    secure = F.when(dsn["ssl"], F.lit("allowFallbackToPlaintext=false,tls=true"))
    options = F.concat_ws(",", secure, F.when(dsn["extra"] != "", dsn["extra"]))
    query = F.when(options != "", F.concat(F.lit("?"), options)).otherwise("")
    return F.concat(login, F.lit("@"), place, F.lit("/"), dsn["database"], query)


def _jdbc(dsn: Column) -> Column:
    """The URL for Spark's JDBC reader; credentials go into its options instead."""
    host = F.when(dsn["host"] != "", dsn["host"]).otherwise("localhost")
    mode = F.when(dsn["ssl"], F.lit("REQUIRED")).otherwise("DISABLED")
    return F.concat(
        F.lit("jdbc:mysql://"), host, F.lit(":"), dsn["port"].cast("string"), F.lit("/"),
        dsn["database"], F.lit("?sslMode="), mode,
    )

"""Choosing, deleting and inserting rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from coldshelf.operators import file_deletes, merge, predicates
from coldshelf.plans.staging import new_path
from suite.common import Suite, table

suite = Suite()

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_LINE_COLS = _LINE.split(", ")
# a date, as a zoned timestamp would keep the condition from the scan
_OLD = "o_orderdate < DATE '1997-01-01'"


def _flagged(spark, sf):
    """lineitem with a nullable flag."""
    return table(spark, sf, "lineitem").select(
        *_LINE_COLS, F.expr("nullif(l_returnflag, 'A')").alias("flag")
    )


_FLAGGED = f"(SELECT {_LINE}, nullif(l_returnflag, 'A') AS flag FROM lineitem)"


def _gaps(spark, sf):
    """lineitem with a key column that is sometimes NULL."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.expr("nullif(l_linenumber, 3)").alias("line_no"), "l_partkey", "l_suppkey"
    )


_GAPS = "(SELECT l_orderkey, nullif(l_linenumber, 3) AS line_no, l_partkey, l_suppkey FROM lineitem)"


@suite.add(
    "archive_select",
    f"SELECT o_totalprice, o_orderdate, o_orderkey FROM orders WHERE {_OLD}",
)
def archive_select(spark, sf):
    orders = table(spark, sf, "orders")
    return predicates.archive_select(
        orders, _OLD, ["o_totalprice", "o_orderdate"], keys=["o_orderkey"], with_keys=True
    )


@suite.add("archive_primary_key_only", f"SELECT o_orderkey FROM orders WHERE {_OLD}")
def archive_primary_key_only(spark, sf):
    return predicates.archive_select(
        table(spark, sf, "orders"), _OLD, primary_key_only=True, keys=["o_orderkey"]
    )


@suite.add("split_archived", f"SELECT * FROM {_FLAGGED} WHERE flag = 'R'")
def split_archived(spark, sf):
    return predicates.archive_split(_flagged(spark, sf), "flag = 'R'")[0]


@suite.add("split_kept", f"SELECT * FROM {_FLAGGED} WHERE (flag = 'R') IS NOT TRUE")
def split_kept(spark, sf):
    return predicates.archive_split(_flagged(spark, sf), "flag = 'R'")[1]


@suite.add("purge_rows", f"SELECT * FROM {_FLAGGED} WHERE (flag <> 'N') IS NOT TRUE")
def purge_rows(spark, sf):
    return predicates.purge(_flagged(spark, sf), "flag <> 'N'")


@suite.add("copy_rows", f"SELECT * FROM {_FLAGGED} WHERE flag <> 'N'")
def copy_rows(spark, sf):
    return predicates.copy_only(_flagged(spark, sf), "flag <> 'N'")


@suite.add(
    "keyset_after",
    f"SELECT {_LINE} FROM lineitem WHERE l_orderkey > 700 OR (l_orderkey = 700 AND l_linenumber > 2)",
)
def keyset_after(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE_COLS)
    return predicates.keyset_filter(rows, ["l_orderkey", "l_linenumber"], (700, 2), ">=", strict=True)


@suite.add(
    "keyset_from_first_key",
    f"SELECT {_LINE} FROM lineitem WHERE l_orderkey >= 700",
)
def keyset_from_first_key(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE_COLS)
    return predicates.keyset_filter(
        rows, ["l_orderkey", "l_linenumber"], (700, 2), ">=", first_n_keys=1
    )


@suite.add(
    "keyset_before_nullable",
    f"""SELECT * FROM {_GAPS}
        WHERE l_orderkey < 900 OR (l_orderkey = 900 AND (line_no <= 4 OR line_no IS NULL))""",
)
def keyset_before_nullable(spark, sf):
    return predicates.keyset_filter(_gaps(spark, sf), ["l_orderkey", "line_no"], (900, 4), "<=")


@suite.add(
    "keyset_after_null",
    f"""SELECT * FROM {_GAPS}
        WHERE line_no IS NOT NULL OR (line_no IS NULL AND l_orderkey > 500)""",
)
def keyset_after_null(spark, sf):
    return predicates.keyset_filter(
        _gaps(spark, sf), ["line_no", "l_orderkey"], {"line_no": None, "l_orderkey": 500}, ">"
    )


# fixed values: an order that differs from the alphabetical one
_STATUS = ["O", "P", "F"]


@suite.add(
    "keyset_enum",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey >= 1000)""",
)
def keyset_enum(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return predicates.keyset_filter(
        rows, ["o_orderstatus", "o_orderkey"], ("P", 1000), ">=", enums={"o_orderstatus": _STATUS}
    )


_SIGNS = "replace(replace(p_name, ' ', '_'), 'e', '%')"


@suite.add(
    "literal_match",
    rf"""SELECT p_partkey, name FROM (SELECT p_partkey, {_SIGNS} AS name FROM part)
         WHERE name LIKE '%\_p%' ESCAPE '\' OR contains(name, '%')""",
)
def literal_match(spark, sf):
    named = table(spark, sf, "part").select("p_partkey", F.expr(_SIGNS).alias("name"))
    return predicates.filter_literal(named, "name", "_p", "contains").union(
        predicates.filter_literal(named, "name", "%", "contains").where("NOT contains(name, '_p')")
    )


_ORPHANS = """SELECT o_orderkey, o_custkey FROM orders
    WHERE {} EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""


@suite.add("orphans_found", _ORPHANS.format("NOT"))
def orphans_found(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return merge.purge_orphans(orders, table(spark, sf, "lineitem"), {"o_orderkey": "l_orderkey"})[0]


@suite.add("orphans_purged", _ORPHANS.format(""))
def orphans_purged(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return merge.purge_orphans(orders, table(spark, sf, "lineitem"), {"o_orderkey": "l_orderkey"})[1]


@suite.add(
    "orphans_null_key",
    """WITH child AS (SELECT doc_id, nullif(doc_id % 3, 1) * doc_id AS ref FROM documents)
       SELECT doc_id, ref FROM child c
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.ref)""",
)
def orphans_null_key(spark, sf):
    child = table(spark, sf, "documents").selectExpr("doc_id", "nullif(doc_id % 3, 1) * doc_id AS ref")
    return merge.purge_orphans(child, table(spark, sf, "labels"), {"ref": "doc_id"})[0]


@suite.add(
    "delete_by_key",
    f"""SELECT * FROM {_GAPS} a WHERE NOT EXISTS (
          SELECT 1 FROM {_GAPS} d WHERE d.l_partkey % 5 = 0
          AND a.l_orderkey IS NOT DISTINCT FROM d.l_orderkey
          AND a.line_no IS NOT DISTINCT FROM d.line_no)""",
)
def delete_by_key(spark, sf):
    rows = _gaps(spark, sf)
    return merge.delete_rows(rows, rows.where("l_partkey % 5 = 0"), ["l_orderkey", "line_no"])


@suite.add(
    "delete_exact_copies",
    """SELECT user_id, event_type FROM events EXCEPT ALL
       SELECT user_id, event_type FROM events WHERE event_id % 3 = 0""",
)
def delete_exact_copies(spark, sf):
    events = table(spark, sf, "events")
    pair = ["user_id", "event_type"]
    return merge.delete_rows_exact(events.select(*pair), events.where("event_id % 3 = 0").select(*pair))


@suite.add(
    "delete_by_key_in_files",
    """SELECT o_orderkey, o_custkey, nullif(o_custkey % 50, 7) AS c FROM orders o
       WHERE NOT (o_orderkey BETWEEN 2000 AND 2600 AND o_orderkey % 3 = 0 OR o_orderkey > 4000
                  AND nullif(o_custkey % 50, 7) IS NULL AND o_orderkey < 4100)""",
)
def delete_by_key_in_files(spark, sf):
    """A table in files of key ranges, of which few are rewritten."""
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey", "nullif(o_custkey % 50, 7) AS c")
    path = new_path(spark, "by-key")
    orders.repartitionByRange(12, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    gone = orders.where(
        "o_orderkey BETWEEN 2000 AND 2600 AND o_orderkey % 3 = 0 OR o_orderkey > 4000 AND o_orderkey < 4100 AND c IS NULL"
    )
    file_deletes.delete_rows_in_files(spark, path, gone, ["o_orderkey", "c"])
    return spark.read.parquet(path)


@suite.add(
    "delete_copies_in_files",
    """SELECT user_id, event_type FROM events EXCEPT ALL
       SELECT user_id, event_type FROM events WHERE event_id % 5 = 0 AND user_id < 40""",
)
def delete_copies_in_files(spark, sf):
    events = table(spark, sf, "events")
    pair = events.select("user_id", "event_type")
    path = new_path(spark, "copies")
    pair.repartitionByRange(8, "user_id").write.parquet(path)
    gone = events.where("event_id % 5 = 0 AND user_id < 40").select("user_id", "event_type")
    file_deletes.delete_copies_in_files(spark, path, gone)
    return spark.read.parquet(path)


_HALVES = """
    d AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders WHERE o_orderkey % 3 <> 0),
    i AS (SELECT nullif(o_orderkey % 2000, 7) AS k, o_custkey AS c, 'X' AS s, o_orderkey AS seq FROM orders
          WHERE o_orderkey % 2 = 0)"""


def _halves(spark, sf):
    orders = table(spark, sf, "orders")
    dest = orders.where("o_orderkey % 3 <> 0").selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "o_orderstatus AS s", "o_orderkey AS seq"
    )
    incoming = orders.where("o_orderkey % 2 = 0").selectExpr(
        "nullif(o_orderkey % 2000, 7) AS k", "o_custkey AS c", "'X' AS s", "o_orderkey AS seq"
    )
    return dest, incoming


@suite.add(
    "insert_ignore",
    f"""WITH {_HALVES},
        r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq) AS n FROM i)
        SELECT k, c, s, k AS seq FROM d
        UNION ALL
        SELECT k, c, s, seq FROM r
        WHERE k IS NULL OR (n = 1 AND NOT EXISTS (SELECT 1 FROM d WHERE d.k = r.k))""",
)
def insert_ignore(spark, sf):
    return merge.insert_ignore(*_halves(spark, sf), ["k"], order_by=["seq"])


@suite.add(
    "replace_into",
    f"""WITH {_HALVES},
        r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS n FROM i)
        SELECT k, c, s, k AS seq FROM d WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.k = d.k)
        UNION ALL
        SELECT k, c, s, seq FROM r WHERE k IS NULL OR n = 1""",
)
def replace_into(spark, sf):
    return merge.replace_into(*_halves(spark, sf), ["k"], order_by=["seq"])


@suite.add(
    "append_common",
    """SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, 'supplier' AS kind FROM supplier
       UNION ALL
       SELECT c_custkey, c_name, c_nationkey, NULL FROM customer""",
)
def append_common(spark, sf):
    dest = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_nationkey AS nation", "'supplier' AS kind"
    )
    src = table(spark, sf, "customer").selectExpr(
        "c_nationkey AS nation", "c_mktsegment AS segment", "c_name AS name", "c_custkey AS id"
    )
    return merge.append_common(dest, src)

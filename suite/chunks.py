"""Walking tables in key order, comparing and measuring them."""

from __future__ import annotations

from pyspark.sql import functions as F

from coldshelf.functions import ddl
from coldshelf.operators import chunks, compare, drilldown, integrity, sketches, stats
from coldshelf.operators.integrity import ForeignKey, foreign_keys_of
from coldshelf.operators.predicates import archive_select
from coldshelf.plans.staging import new_path
from coldshelf.sources.endpoints import SourceSpec, jdbc_predicates, read_source
from suite.common import Suite, table

suite = Suite()

_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@suite.add(
    "archive_manifest",
    """WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders
                  WHERE o_orderdate < TIMESTAMP '1997-01-01 00:00:00')
       SELECT i // 100 AS chunk_id, count(*) AS n_rows, max(i) + 1 AS rows_done,
              min(o_orderkey) AS lo_orderkey, max(o_orderkey) AS hi_orderkey
       FROM n GROUP BY 1""",
)
def archive_manifest(spark, sf):
    """The flagship: old orders, cut into chunks of 100 rows."""
    source = SourceSpec(database="shop", table="orders", path=f"{sf}/orders.parquet")
    old = archive_select(
        read_source(spark, source), "o_orderdate < DATE '1997-01-01'"
    )
    return chunks.chunk_manifest(old, ["o_orderkey"], 100, unique=True).select(
        "chunk_id",
        "n_rows",
        "rows_done",
        F.col("lo.o_orderkey").alias("lo_orderkey"),
        F.col("hi.o_orderkey").alias("hi_orderkey"),
    )


@suite.add(
    "chunk_manifest_ties",
    """WITH n AS (SELECT l_orderkey, l_linenumber,
                         row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS i FROM lineitem)
       SELECT i // 250 AS chunk_id, count(*) AS n_rows, max(i) + 1 AS rows_done,
              arg_min(l_orderkey, i) AS lo_order, arg_min(l_linenumber, i) AS lo_line,
              arg_max(l_orderkey, i) AS hi_order, arg_max(l_linenumber, i) AS hi_line
       FROM n GROUP BY 1""",
)
def chunk_manifest_ties(spark, sf):
    manifest = chunks.chunk_manifest(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 250
    )
    return manifest.selectExpr(
        "chunk_id", "n_rows", "rows_done",
        "lo.l_orderkey AS lo_order", "lo.l_linenumber AS lo_line",
        "hi.l_orderkey AS hi_order", "hi.l_linenumber AS hi_line",
    )


@suite.add(
    "chunk_manifest_hot_key",
    """WITH n AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS i FROM events)
       SELECT i // 300 AS chunk_id, count(*) AS n_rows,
              arg_min(event_type, i) AS lo_type, arg_max(event_type, i) AS hi_type
       FROM n GROUP BY 1""",
)
def chunk_manifest_hot_key(spark, sf):
    return chunks.chunk_manifest(table(spark, sf, "events"), ["event_type"], 300).selectExpr(
        "chunk_id", "n_rows", "lo.event_type AS lo_type", "hi.event_type AS hi_type"
    )


@suite.add(
    "assign_chunks",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_no, (row_no - 1) // 1000 AS chunk_id
       FROM (SELECT *, row_number() OVER (
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_no FROM lineitem)""",
)
def assign_chunks(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE_KEYS)
    return chunks.assign_chunks(rows, _LINE_KEYS, 1000, unique=True)


@suite.add(
    "assign_chunks_ties",
    """SELECT event_type, user_id, row_no, (row_no - 1) // 700 AS chunk_id
       FROM (SELECT event_type, user_id,
                    row_number() OVER (ORDER BY event_type, user_id) AS row_no FROM events)""",
)
def assign_chunks_ties(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type")
    return chunks.assign_chunks(rows, ["event_type"], 700)


@suite.add(
    "first_page",
    """SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders
       ORDER BY o_orderstatus, o_orderkey LIMIT 50""",
)
def first_page(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    return chunks.next_page(rows, ["o_orderstatus", "o_orderkey"], n=50, unique=True)


@suite.add(
    "next_page",
    """SELECT line_no, l_orderkey, l_partkey, l_suppkey FROM (
         SELECT nullif(l_linenumber, 1) AS line_no, l_orderkey, l_partkey, l_suppkey FROM lineitem)
       WHERE line_no IS NOT NULL OR l_orderkey > 800
       ORDER BY line_no NULLS FIRST, l_orderkey, l_partkey, l_suppkey LIMIT 200""",
)
def next_page(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "nullif(l_linenumber, 1) AS line_no", "l_orderkey", "l_partkey", "l_suppkey"
    )
    top = 1 << 62
    return chunks.next_page(rows, ["line_no", "l_orderkey"], (None, 800, top, top), 200)


@suite.add(
    "jdbc_ranges",
    """WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1)
                    // 500 AS chunk FROM lineitem),
            m AS (SELECT *, chunk * 7 // (SELECT count(DISTINCT chunk) FROM n) AS part FROM n)
       SELECT CAST(part AS BIGINT) AS part, count(*) AS n_rows, min(l_orderkey) AS lo, max(l_orderkey) AS hi
       FROM m GROUP BY 1""",
)
def jdbc_ranges(spark, sf):
    """The conditions a database read would use, applied to the same rows here."""
    rows = table(spark, sf, "lineitem").select(*_LINE_KEYS)
    manifest = chunks.chunk_manifest(rows, _LINE_KEYS, 500, unique=True)
    part = None
    for i, condition in enumerate(jdbc_predicates(manifest, _LINE_KEYS, 7)):
        hit = F.expr(condition)
        part = F.when(hit, i) if part is None else part.when(hit, i)
    return rows.groupBy(part.cast("long").alias("part")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("l_orderkey").alias("lo"),
        F.max("l_orderkey").alias("hi"),
    )


_COPY = """
    a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 101 <> 5),
    b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
                 o_orderstatus FROM orders WHERE o_orderkey % 89 <> 3)"""


def _copies(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    changed = F.when(F.col("o_orderkey") % 97 != 1, F.col("o_custkey"))
    return (
        orders.where("o_orderkey % 101 <> 5"),
        orders.where("o_orderkey % 89 <> 3").withColumn("o_custkey", changed),
    )


_UNEQUAL = f"""WITH {_COPY}
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
               CASE WHEN a.o_orderkey IS NULL THEN 0 ELSE 1 END AS rows_a,
               CASE WHEN b.o_orderkey IS NULL THEN 0 ELSE 1 END AS rows_b,
               CASE WHEN a.o_orderkey IS NULL THEN 'missing_in_a'
                    WHEN b.o_orderkey IS NULL THEN 'missing_in_b' ELSE 'changed' END AS verdict
        FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey
        WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
           OR a.o_custkey IS DISTINCT FROM b.o_custkey"""


@suite.add("compare_rows", _UNEQUAL)
def compare_rows(spark, sf):
    return compare.compare_rows(*_copies(spark, sf), ["o_orderkey"])


@suite.add("compare_drilldown", _UNEQUAL)
def compare_drilldown(spark, sf):
    """The same rows, found through a tree of range checksums."""
    return drilldown.drill_down(*_copies(spark, sf), ["o_orderkey"], leaf_rows=300, fanout=8).rows


@suite.add(
    "compare_chunks",
    f"""WITH {_COPY},
        n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM a),
        k AS (SELECT coalesce(n.o_orderkey, b.o_orderkey) AS k, n.i,
                     n.o_orderkey IS NOT NULL AS in_a, b.o_orderkey IS NOT NULL AS in_b,
                     n.o_orderkey IS NULL OR b.o_orderkey IS NULL
                       OR n.o_custkey IS DISTINCT FROM b.o_custkey AS differs
              FROM n FULL OUTER JOIN b ON n.o_orderkey = b.o_orderkey),
        p AS (SELECT *, coalesce(i, (SELECT least(count(*), (SELECT count(*) FROM a) - 1) FROM a
                                     WHERE a.o_orderkey < k.k)) // 500 AS chunk_id FROM k)
        SELECT chunk_id, count(*) FILTER (in_a) AS rows_a, count(*) FILTER (in_b) AS rows_b,
               CASE WHEN bool_or(differs) THEN 'different' ELSE 'same' END AS verdict,
               count(*) FILTER (differs) AS differing_keys
        FROM p GROUP BY 1""",
)
def compare_chunks(spark, sf):
    return compare.compare_chunks(*_copies(spark, sf), ["o_orderkey"], 500).drop(
        "checksum_a", "checksum_b"
    )


@suite.add(
    "table_status",
    """SELECT 'orders' AS name, count(*) AS n_rows,
              CAST(sum(40 + strlen(o_orderstatus) + strlen(o_orderpriority) - 8) AS BIGINT)
                // count(*) AS avg_row_length,
              CAST(sum(40 + strlen(o_orderstatus) + strlen(o_orderpriority) - 8) AS BIGINT) AS data_length,
              max(o_orderkey) + 1 AS auto_increment,
              min(o_orderdate) AS first_update, max(o_orderdate) AS last_update
       FROM orders""",
)
def table_status(spark, sf):
    return stats.table_status(
        table(spark, sf, "orders"), "orders", autoinc_col="o_orderkey", update_col="o_orderdate"
    ).drop("checksum")


_STATS = """SELECT '{0}' AS "column", count(*) AS n_rows, count(*) - count({0}) AS n_nulls,
    count(DISTINCT {0}) AS n_distinct, CAST(min({0}) AS VARCHAR) AS min_value,
    CAST(max({0}) AS VARCHAR) AS max_value FROM l"""
_STATS_COLS = ["l_orderkey", "l_linenumber", "flag", "l_shipdate"]


@suite.add(
    "analyze_columns",
    "WITH l AS (SELECT *, nullif(l_returnflag, 'A') AS flag FROM lineitem) "
    + " UNION ALL ".join(_STATS.format(c) for c in _STATS_COLS),
)
def analyze_columns(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("flag", F.expr("nullif(l_returnflag, 'A')"))
    return stats.analyze_columns(rows.select(*_STATS_COLS))


@suite.add(
    "keep_latest_autoinc",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'
       AND o_orderkey < (SELECT max(o_orderkey) FROM orders)""",
)
def keep_latest_autoinc(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return stats.keep_latest_autoinc(orders, "o_orderkey", orders.where("o_orderstatus <> 'P'"))


@suite.add(
    "counter_deltas",
    """WITH p AS (SELECT event_id, user_id, event_type, ts, value,
                    lag(value) OVER w AS pv, lag(ts) OVER w AS pt
                  FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts))
       SELECT event_id, user_id, event_type, ts, value,
              CASE WHEN value - pv >= 0 THEN value - pv END AS value_delta,
              CASE WHEN value - pv >= 0 THEN
                (value - pv) / ((epoch_us(ts) - epoch_us(pt)) / 1e6::DOUBLE) END AS value_rate
       FROM p""",
)
def counter_deltas(spark, sf):
    samples = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return stats.counter_deltas(samples, ["user_id", "event_type"], "ts", ["value"])


_ODD_TIME = """CASE WHEN event_id % 997 = 0 THEN NULL
    WHEN event_id % 991 = 1 THEN ts - INTERVAL '400' DAY ELSE ts END"""


@suite.add(
    "counter_deltas_hot",
    f"""WITH e AS (SELECT event_id, event_type, {_ODD_TIME} AS ts, event_id * 7 % 1000 AS hits FROM events),
             p AS (SELECT *, lag(hits) OVER w AS ph, lag(ts) OVER w AS pt
                   FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts NULLS FIRST, hits))
       SELECT event_id, event_type, ts, hits, CASE WHEN hits >= ph THEN hits - ph END AS hits_delta,
              CASE WHEN hits >= ph AND ts > pt THEN
                (hits - ph) / ((epoch_us(ts) - epoch_us(pt)) / 1e6::DOUBLE) END AS hits_rate
       FROM p""",
)
def counter_deltas_hot(spark, sf):
    """Few devices with many samples each, cut into spans; some without a time, some long ago."""
    samples = table(spark, sf, "events").selectExpr(
        "event_id", "event_type", f"{_ODD_TIME} AS ts", "event_id * 7 % 1000 AS hits"
    )
    return stats.counter_deltas(samples, ["event_type"], "ts", ["hits"], max_group=300)


_FKS = [
    ForeignKey("customer_nation", "customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("supplier_nation", "supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("nation_region", "nation", ("n_regionkey",), "region", ("r_regionkey",)),
    ForeignKey("orders_customer", "orders", ("o_custkey",), "customer", ("c_custkey",)),
    ForeignKey("lineitem_orders", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    ForeignKey("lineitem_part", "lineitem", ("l_partkey",), "part", ("p_partkey",)),
    ForeignKey("lineitem_supplier", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    ForeignKey("orders_lineitem", "orders", ("o_orderkey",), "lineitem", ("l_orderkey",)),
    ForeignKey("documents_labels", "documents", ("doc_id",), "labels", ("doc_id",)),
    ForeignKey("returns_shipments", "returns", ("part", "supp"), "shipped", ("l_partkey", "l_suppkey")),
]


def _fk_sql(fk: ForeignKey) -> str:
    has_null = " OR ".join(f"c.{c} IS NULL" for c in fk.child_cols)
    match = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(fk.child_cols, fk.parent_cols))
    return f"""SELECT '{fk.name}' AS fk, count(*) AS child_rows,
        count(*) FILTER ({has_null}) AS null_rows,
        count(*) FILTER (NOT ({has_null})
            AND NOT EXISTS (SELECT 1 FROM {fk.parent} p WHERE {match})) AS orphan_rows
        FROM {fk.child} c"""


@suite.add(
    "fk_integrity",
    """WITH returns AS (SELECT nullif(l_partkey % 400, 3) AS part, l_suppkey AS supp FROM lineitem),
            shipped AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F') """
    + " UNION ALL ".join(_fk_sql(fk) for fk in _FKS),
)
def fk_integrity(spark, sf):
    names = {fk.child for fk in _FKS} | {fk.parent for fk in _FKS}
    tables = {n: table(spark, sf, n) for n in names - {"returns", "shipped"}}
    tables["returns"] = tables["lineitem"].selectExpr(
        "nullif(l_partkey % 400, 3) AS part", "l_suppkey AS supp"
    )
    tables["shipped"] = tables["lineitem"].where("l_linestatus = 'F'")
    return integrity.fk_integrity(tables, _FKS)


@suite.add(
    "tables_present",
    """WITH w AS (SELECT p_partkey AS id, p_brand AS db, p_type AS tbl FROM part),
            c AS (SELECT upper(p_brand) AS db, lower(p_type) AS tbl FROM part WHERE p_size < 25)
       SELECT id, db, tbl, EXISTS (SELECT 1 FROM c WHERE lower(c.db) = lower(w.db)
                                   AND lower(c.tbl) = lower(w.tbl)) AS present FROM w""",
)
def tables_present(spark, sf):
    part = table(spark, sf, "part")
    wanted = part.selectExpr("p_partkey AS id", "p_brand AS db", "p_type AS tbl")
    catalog = part.where("p_size < 25").selectExpr("upper(p_brand) AS db", "lower(p_type) AS tbl")
    return integrity.tables_present(wanted, catalog, lower_case_names=True)


_FK_DDL = [
    (
        "lineitem",
        "CONSTRAINT `line_order` FOREIGN KEY (`l_orderkey`) REFERENCES `orders` (`o_orderkey`)",
        "CONSTRAINT `line_shipped` FOREIGN KEY (`l_partkey`,`l_suppkey`) REFERENCES `shipped` (`p`,`s`)",
    ),
    ("orders", "CONSTRAINT `order_line` FOREIGN KEY (`o_orderkey`) REFERENCES `lineitem` (`l_orderkey`)"),
]


@suite.add(
    "fk_integrity_from_ddl",
    """WITH shipped AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS s FROM lineitem WHERE l_linestatus = 'F')
       SELECT 'line_order' AS fk, count(*) AS child_rows, 0 AS null_rows, count(*) FILTER (
         NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) AS orphan_rows FROM lineitem
       UNION ALL SELECT 'line_shipped', count(*), 0, count(*) FILTER (
         NOT EXISTS (SELECT 1 FROM shipped WHERE p = l_partkey AND s = l_suppkey)) FROM lineitem
       UNION ALL SELECT 'order_line', count(*), 0, count(*) FILTER (
         NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) FROM orders""",
)
def fk_integrity_from_ddl(spark, sf):
    """From DDL texts to orphans."""
    texts = [
        (i, f"CREATE TABLE `{name}` (\n  `x` int,\n  " + ",\n  ".join(keys) + "\n) ENGINE=InnoDB DEFAULT CHARSET=utf8")
        for i, (name, *keys) in enumerate(_FK_DDL)
    ]
    ddl_texts = spark.createDataFrame(texts, "src_id bigint, ddl string")
    keys = foreign_keys_of(ddl.ddl_foreign_keys(ddl_texts), ddl.ddl_tables(ddl_texts))
    lines = table(spark, sf, "lineitem")
    shipped = lines.where("l_linestatus = 'F'").selectExpr("l_partkey AS p", "l_suppkey AS s")
    return integrity.fk_integrity({"lineitem": lines, "orders": table(spark, sf, "orders"), "shipped": shipped}, keys)


_RANGES = """SELECT count(*) AS n_rows, min(user_id) AS lo, max(user_id) AS hi, count(*) AS rows_done
    FROM (SELECT nullif(user_id, 3) AS user_id FROM events)"""


@suite.add("range_manifest", _RANGES)
def range_manifest(spark, sf):
    """Exact counts of sketched ranges add up to the table."""
    events = table(spark, sf, "events").selectExpr("nullif(user_id, 3) AS user_id")
    return _ranges_of(sketches.range_manifest(events, "user_id", 500))


@suite.add("range_manifest_extended", _RANGES)
def range_manifest_extended(spark, sf):
    events = table(spark, sf, "events").selectExpr("event_id", "nullif(user_id, 3) AS user_id")
    old = sketches.range_manifest(events.where("event_id % 4 <> 0"), "user_id", 500)
    return _ranges_of(sketches.extend_manifest(old, events.where("event_id % 4 = 0"), "user_id"))


def _ranges_of(manifest):
    return manifest.ranges.agg(
        F.sum("n_rows").alias("n_rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.max("rows_done").alias("rows_done"),
    )


@suite.add(
    "table_statistics",
    "WITH l AS (SELECT *, nullif(l_linenumber, 3) AS line_no FROM lineitem) SELECT * EXCLUDE n_distinct FROM ("
    + " UNION ALL ".join(_STATS.format(c) for c in ("l_orderkey", "line_no", "l_returnflag"))
    + ")",
)
def table_statistics(spark, sf):
    """Stored statistics, brought up to date after an append."""
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey", "nullif(l_linenumber, 3) AS line_no", "l_returnflag")
    path = new_path(spark, "grown")
    lines.where("l_orderkey % 3 > 0").write.parquet(path)
    sketches.refresh_statistics(spark, path, f"{path}-stats")
    lines.where("l_orderkey % 3 = 0").write.mode("append").parquet(path)
    return sketches.table_statistics(spark, path, f"{path}-stats").drop("n_distinct")

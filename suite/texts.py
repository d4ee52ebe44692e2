"""Catalogs, settings, versions, alignment and lists held in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from coldshelf.functions import align, ddl, dsn, lists, names, settings, versions
from coldshelf.operators import integrity
from suite.common import Suite, table

suite = Suite()

# One CREATE TABLE text per part; the pieces vary with the part's key.  Both engines
# build the same text from the same pieces.
_DDL_PIECES = [
    "'CREATE TABLE `tbl_'", "p_partkey", "'` (\\n'",
    "'  `id` int(11) unsigned NOT NULL AUTO_INCREMENT,\\n'",
    "'  `brand``x` varchar('", "p_size + 10", "') DEFAULT NULL COMMENT ''is NOT NULL'',\\n'",
    "'  `kind` enum(''a b'',''c'''''',''d'') NOT NULL,\\n'",
    "CASE WHEN p_partkey % 2 = 0 THEN '  `price` decimal(12,2) NOT NULL DEFAULT ''0.00'',\\n' ELSE '' END",
    "CASE WHEN p_partkey % 3 = 0 THEN '  `note` text,\\n' ELSE '  `spot` point NOT NULL,\\n' END",
    "'  `total` bigint GENERATED ALWAYS AS (`id` * 2) STORED,\\n'",
    "CASE WHEN p_partkey % 7 <> 1 THEN '  PRIMARY KEY (`id`),\\n' ELSE '' END",
    "CASE WHEN p_partkey % 4 = 0 THEN '  UNIQUE KEY `u_kind` (`kind`,`id`) USING BTREE,\\n' ELSE '' END",
    "CASE WHEN p_partkey % 3 <> 0 THEN '  SPATIAL KEY `spot_ix` (`spot`),\\n'"
    " ELSE '  FULLTEXT KEY `note_ix` (`note`),\\n' END",
    "'  KEY `ix_'", "p_size", "'` (`brand``x`('", "p_size", "'),`kind` DESC),\\n'",
    "'  CONSTRAINT `fk_'", "p_partkey", "'` FOREIGN KEY (`id`,`kind`) REFERENCES `parent_'",
    "p_size", "'` (`pid`,`pkind`) ON DELETE CASCADE\\n'",
    "')'",
    "CASE WHEN p_partkey % 11 <> 2 THEN ' ENGINE=' || p_type_word ELSE '' END",
    "CASE WHEN p_partkey % 13 <> 3 THEN ' DEFAULT CHARSET=utf8mb4' ELSE ' ROW_FORMAT=x' END",
]
_DUCK_DDL = "concat(" + ", ".join(_DDL_PIECES).replace("\\n", "' || chr(10) || '") + ")"
_FROM_PART = f"""(SELECT p_partkey AS src_id,
    CASE WHEN p_partkey % 17 = 4 THEN '' WHEN p_partkey % 19 = 5 THEN 'CREATE TABLE plain (a int)'
         ELSE {_DUCK_DDL} END AS ddl
    FROM (SELECT *, string_split(p_type, ' ')[1] AS p_type_word FROM part))"""


def _parts_dealt(spark, sf):
    """The parts, dealt to all cores.

    A part's text is far longer than its row, so that a file of few bytes is much to parse.
    """
    return table(spark, sf, "part").repartition(2 * spark.sparkContext.defaultParallelism, "p_partkey")


def _ddl_texts(spark, sf):
    # a doubled quote inside a literal becomes an escaped one
    pieces = [p.replace("''", "\\'") for p in _DDL_PIECES]
    pieces = ["''" if p == "\\'" else p.replace("ELSE \\' END", "ELSE '' END") for p in pieces]
    text = "concat(" + ", ".join(pieces) + ")"
    return (
        _parts_dealt(spark, sf)
        .withColumn("p_type_word", F.split("p_type", " ")[0])
        .selectExpr(
            "p_partkey AS src_id",
            "CASE WHEN p_partkey % 17 = 4 THEN '' WHEN p_partkey % 19 = 5 THEN "
            f"'CREATE TABLE plain (a int)' ELSE {text} END AS ddl",
        )
    )


@suite.add("ddl_texts", f"SELECT * FROM {_FROM_PART}")
def ddl_texts(spark, sf):
    return _ddl_texts(spark, sf)


@suite.add(
    "ddl_tables",
    f"""WITH x AS (SELECT src_id, ddl,
          regexp_extract(ddl, 'CREATE TABLE `([^`]*)`', 1) AS name,
          regexp_extract(ddl, '\\n\\) ENGINE=([^ ]+)', 1) AS engine,
          regexp_extract(ddl, 'DEFAULT CHARSET=([^ ]+)', 1) AS charset FROM {_FROM_PART})
        SELECT src_id, nullif(name, '') AS name, nullif(engine, '') AS engine,
          nullif(charset, '') AS charset,
          CASE WHEN ddl = '' THEN 'empty' WHEN NOT contains(ddl, 'TABLE `') THEN 'unquoted name'
               WHEN name = '' THEN 'no name' WHEN engine = '' THEN 'no engine'
               WHEN charset = '' THEN 'no charset' END AS error
        FROM x""",
)
def ddl_tables(spark, sf):
    return ddl.ddl_tables(_ddl_texts(spark, sf))


_COLUMN_LINES = f"""(SELECT src_id, row_number() OVER (PARTITION BY src_id ORDER BY i) AS pos, line FROM (
    SELECT src_id, unnest(string_split(ddl, chr(10))) AS line,
           generate_subscripts(string_split(ddl, chr(10)), 1) AS i FROM {_FROM_PART})
    WHERE line LIKE '  `%')"""


@suite.add(
    "ddl_columns",
    f"""WITH c AS (SELECT *, replace(regexp_extract(line, '^  `((?:[^`]|``)*)`', 1), '``', '`') AS name
                   FROM {_COLUMN_LINES})
        SELECT src_id, pos, name,
          CASE name WHEN 'id' THEN 'int(11)'
                    WHEN 'kind' THEN 'enum(''a b'',''c'''''',''d'')'
                    WHEN 'price' THEN 'decimal(12,2)' WHEN 'note' THEN 'text'
                    WHEN 'spot' THEN 'point' WHEN 'total' THEN 'bigint'
                    ELSE regexp_extract(line, 'varchar\\(\\d+\\)') END AS raw_type,
          name IN ('brand`x', 'note', 'total') AS nullable,
          name = 'total' AS generated, name IN ('id', 'price', 'total') AS numeric,
          name = 'id' AS autoinc,
          CASE name WHEN 'id' THEN 'bigint' WHEN 'price' THEN 'decimal(12,2)' WHEN 'total' THEN 'bigint'
                    ELSE 'string' END AS spark_type,
          CASE WHEN name = 'kind' THEN 'a b|c''|d' END AS members
        FROM c""",
)
def ddl_columns(spark, sf):
    # array_join would turn a missing list into an empty text
    return ddl.ddl_columns(_ddl_texts(spark, sf)).withColumn(
        "members", F.when(F.col("members").isNotNull(), F.array_join("members", "|"))
    )


_KEY_ROWS = f"""(
    SELECT src_id, 'PRIMARY' AS key_name, 'BTREE' AS key_type, true AS is_primary, true AS is_unique,
           1 AS pos, 'id' AS col_name, 0 AS prefix_length
    FROM {_FROM_PART} WHERE contains(ddl, 'PRIMARY KEY')
    UNION ALL
    SELECT src_id, 'u_kind', 'BTREE', false, true, unnest([1, 2]), unnest(['kind', 'id']), 0
    FROM {_FROM_PART} WHERE contains(ddl, 'u_kind')
    UNION ALL
    SELECT src_id, 'spot_ix', 'RTREE', false, false, 1, 'spot', 0
    FROM {_FROM_PART} WHERE contains(ddl, 'spot_ix')
    UNION ALL
    SELECT src_id, 'note_ix', 'TEXT', false, false, 1, 'note', 0
    FROM {_FROM_PART} WHERE contains(ddl, 'note_ix')
    UNION ALL
    SELECT src_id, 'ix_' || regexp_extract(ddl, '`ix_(\\d+)`', 1), 'BTREE', false, false,
           unnest([1, 2]), unnest(['brand`x', 'kind']),
           unnest([CAST(regexp_extract(ddl, '`ix_(\\d+)`', 1) AS BIGINT), 0])
    FROM {_FROM_PART} WHERE contains(ddl, '`ix_'))"""


@suite.add("ddl_keys", f"SELECT * FROM {_KEY_ROWS}")
def ddl_keys(spark, sf):
    return ddl.ddl_keys(_ddl_texts(spark, sf)).drop("expression")


# texts whose parentheses nest, one per part
_NESTED_PIECES = [
    "'CREATE TABLE `t_'", "p_partkey", "'` (\\n'",
    "'  `a` int NOT NULL DEFAULT (abs((1) - '", "p_size", "')),\\n'",
    "'  `b` varchar(20) GENERATED ALWAYS AS (concat(`a`, \"(\")) VIRTUAL COMMENT \"not NOT NULL (ever\",\\n'",
    "'  UNIQUE KEY `u` (`a`,(lower(substr(`b`,1,'", "p_size", "'))) DESC),\\n'",
    "'  KEY `p` (`b`('", "p_size % 9 + 1", "'),`a` DESC),\\n'",
    "'  CONSTRAINT `low_'", "p_partkey", "'` CHECK ((`a` > (0 + '", "p_size", "')))\\n'",
    "') ENGINE=InnoDB DEFAULT CHARSET=utf8mb4'",
]


def _nested_texts(spark, sf):
    return _parts_dealt(spark, sf).selectExpr("p_partkey AS src_id", f"concat({', '.join(_NESTED_PIECES)}) AS ddl")


@suite.add(
    "ddl_expressions",
    """SELECT p_partkey AS src_id, e.kind AS kind, e.name AS name, e.pos AS pos, e.expression AS expression FROM (
         SELECT p_partkey, unnest([
           {'kind': 'default', 'name': 'a', 'pos': 1, 'expression': 'abs((1) - ' || p_size || ')'},
           {'kind': 'generated', 'name': 'b', 'pos': 2, 'expression': 'concat(`a`, "(")'},
           {'kind': 'key', 'name': 'u', 'pos': 2, 'expression': 'lower(substr(`b`,1,' || p_size || '))'},
           {'kind': 'check', 'name': 'low_' || p_partkey, 'pos': 1, 'expression': '(`a` > (0 + ' || p_size || '))'}]) AS e
         FROM part)""",
)
def ddl_expressions(spark, sf):
    return ddl.ddl_expressions(_nested_texts(spark, sf))


@suite.add(
    "ddl_expression_keys",
    """SELECT p_partkey AS src_id, k.key_name AS key_name, k.is_unique AS is_unique, k.pos AS pos, k.col_name AS col_name,
              k.prefix_length AS prefix_length, k.expression AS expression FROM (
         SELECT p_partkey, unnest([
           {'key_name': 'u', 'is_unique': true, 'pos': 1, 'col_name': 'a', 'prefix_length': 0, 'expression': NULL},
           {'key_name': 'u', 'is_unique': true, 'pos': 2, 'col_name': NULL, 'prefix_length': 0,
            'expression': 'lower(substr(`b`,1,' || p_size || '))'},
           {'key_name': 'p', 'is_unique': false, 'pos': 1, 'col_name': 'b', 'prefix_length': p_size % 9 + 1, 'expression': NULL},
           {'key_name': 'p', 'is_unique': false, 'pos': 2, 'col_name': 'a', 'prefix_length': 0, 'expression': NULL}]) AS k
         FROM part)""",
)
def ddl_expression_keys(spark, sf):
    return ddl.ddl_keys(_nested_texts(spark, sf)).drop("key_type", "is_primary")


@suite.add(
    "ddl_foreign_keys",
    f"""SELECT src_id, regexp_extract(ddl, 'CONSTRAINT `([^`]*)`', 1) AS fk_name,
               unnest([1, 2]) AS pos, unnest(['id', 'kind']) AS child_col,
               regexp_extract(ddl, 'REFERENCES `([^`]*)`', 1) AS parent_table,
               unnest(['pid', 'pkind']) AS parent_col
        FROM {_FROM_PART} WHERE contains(ddl, 'CONSTRAINT')""",
)
def ddl_foreign_keys(spark, sf):
    return ddl.ddl_foreign_keys(_ddl_texts(spark, sf))


_RANKED = f"""(SELECT *, row_number() OVER (PARTITION BY src_id
        ORDER BY is_primary DESC, is_unique DESC, n_cols DESC, key_name) AS rank
    FROM (SELECT src_id, key_name, is_primary, is_unique, count(*) AS n_cols
          FROM {_KEY_ROWS} WHERE key_type = 'BTREE' GROUP BY 1, 2, 3, 4))"""


@suite.add("rank_indexes", f"SELECT * FROM {_RANKED}")
def rank_indexes(spark, sf):
    return ddl.rank_indexes(ddl.ddl_keys(_ddl_texts(spark, sf)))


@suite.add(
    "best_index",
    f"""SELECT t.src_id, r.key_name, CAST(NULL AS VARCHAR) AS error
        FROM {_FROM_PART} t LEFT JOIN {_RANKED} r ON r.src_id = t.src_id AND r.rank = 1""",
)
def best_index(spark, sf):
    texts = _ddl_texts(spark, sf)
    return ddl.best_index(ddl.ddl_keys(texts), texts)


@suite.add(
    "locator_columns",
    f"""WITH b AS (SELECT src_id, key_name FROM {_RANKED} WHERE rank = 1 AND is_unique)
        SELECT k.src_id, k.pos, k.col_name AS name FROM {_KEY_ROWS} k JOIN b
          ON k.src_id = b.src_id AND k.key_name = b.key_name
        UNION ALL
        SELECT src_id, pos, replace(regexp_extract(line, '^  `((?:[^`]|``)*)`', 1), '``', '`')
        FROM {_COLUMN_LINES} c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.src_id = c.src_id)""",
)
def locator_columns(spark, sf):
    texts = _ddl_texts(spark, sf)
    return ddl.locator_columns(ddl.ddl_keys(texts), ddl.ddl_columns(texts))


@suite.add(
    "best_index_preferred",
    f"""SELECT src_id, CASE WHEN contains(ddl, 'u_kind') THEN 'u_kind' END AS key_name,
               CASE WHEN NOT contains(ddl, 'u_kind') THEN 'key u_kind does not exist' END AS error
        FROM {_FROM_PART}""",
)
def best_index_preferred(spark, sf):
    texts = _ddl_texts(spark, sf)
    return ddl.best_index(ddl.ddl_keys(texts), texts, preferred="u_kind")


@suite.add(
    "check_columns",
    """WITH a AS (SELECT src_id, unnest(['id', 'brand`x', 'kind',
                   CASE WHEN src_id % 2 = 0 THEN 'price' END,
                   CASE WHEN src_id % 3 = 0 THEN 'note' ELSE 'spot' END, 'total']) AS name,
                 unnest(['bigint', 'string', 'string', 'decimal(12,2)', 'string', 'bigint']) AS t
               FROM (SELECT p_partkey AS src_id FROM part) WHERE src_id % 17 <> 4 AND src_id % 19 <> 5),
            pa AS (SELECT src_id, name, t, list_position(['id', 'brand`x', 'kind', 'price', 'note', 'spot', 'total'], name)
                   AS o FROM a WHERE name IS NOT NULL),
            na AS (SELECT src_id, name, t, row_number() OVER (PARTITION BY src_id ORDER BY o) AS p FROM pa),
            b AS (SELECT src_id, unnest(['id', 'kind', 'price', 'total']) AS name,
                         unnest(['bigint', 'string', 'string', 'bigint']) AS t, unnest([1, 2, 3, 4]) AS p
                  FROM (SELECT p_partkey AS src_id FROM part) WHERE src_id % 5 <> 0)
       SELECT * FROM (
         SELECT coalesce(na.src_id, b.src_id) AS src_id, coalesce(na.name, b.name) AS name,
           na.p AS pos_a, na.t AS type_a, b.p AS pos_b, b.t AS type_b,
           CASE WHEN na.p IS NULL THEN 'missing_in_a' WHEN b.p IS NULL THEN 'missing_in_b'
                WHEN na.t <> b.t THEN 'type' WHEN na.p <> b.p THEN 'position' END AS difference
         FROM na FULL JOIN b ON na.src_id = b.src_id AND na.name = b.name)
       WHERE difference IS NOT NULL""",
)
def check_columns(spark, sf):
    a = ddl.ddl_columns(_ddl_texts(spark, sf))
    b = ddl.ddl_columns(
        table(spark, sf, "part").where("p_partkey % 5 <> 0").select(
            F.col("p_partkey").alias("src_id"),
            F.concat(
                F.lit("CREATE TABLE `t"), F.col("p_partkey"),
                F.lit("` (\n  `id` bigint NOT NULL,\n  `kind` varchar(9),\n"
                      "  `price` varchar(20),\n  `total` bigint\n) ENGINE=x DEFAULT CHARSET=y"),
            ).alias("ddl"),
        )
    )
    return integrity.check_columns(a, b, by=["src_id"])


_SETTINGS = """concat('sort_size=', p_size, ',mode="', p_brand, ',', p_type, '",', p_name,
    CASE WHEN p_size % 3 = 0 THEN ',tail="a=b,c"' ELSE '' END)"""


@suite.add(
    "explode_settings",
    f"""WITH s AS (SELECT p_partkey AS id, regexp_extract_all({_SETTINGS}, '(?:[^,"]|"[^"]*")+') AS items FROM part),
             e AS (SELECT id, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM s)
        SELECT id, pos, item,
          CASE WHEN contains(item, '=') THEN regexp_extract(item, '^([^=]*)=', 1) ELSE item END AS name,
          CASE WHEN contains(item, '=') THEN regexp_extract(item, '^[^=]*=(.*)$', 1) END AS value
        FROM e""",
)
def explode_settings(spark, sf):
    texts = table(spark, sf, "part").selectExpr("p_partkey AS id", f"{_SETTINGS} AS v")
    return settings.explode_settings(texts, "v")


_DSN = """concat('h=db', c_custkey % 7, ',P=', c_custkey * 47 % 70000, ',D=', lower(c_mktsegment),
    CASE WHEN c_custkey % 4 = 0 THEN ',u=app,p=x=y' ELSE '' END,
    CASE WHEN c_custkey % 9 = 1 THEN ',s=false' WHEN c_custkey % 9 = 2 THEN ',s=maybe' ELSE '' END,
    CASE WHEN c_custkey % 10 = 3 THEN ',x="a=1,b=2"' ELSE '' END,
    CASE WHEN c_custkey % 21 = 5 THEN ',z=1' WHEN c_custkey % 21 = 6 THEN ',t' ELSE ',t=c' || c_custkey END)"""


@suite.add(
    "dsn_audit",
    """WITH x AS (SELECT c_custkey, c_custkey * 47 % 70000 AS port, c_mktsegment,
            CASE WHEN c_custkey % 4 = 0 THEN 'app' ELSE '' END AS usr FROM customer),
       e AS (SELECT *, CASE WHEN port NOT BETWEEN 1 AND 65535 THEN 'port out of range: ' || port
                WHEN c_custkey % 21 = 5 THEN 'unknown key: z'
                WHEN c_custkey % 21 = 6 THEN 'missing ''='': t'
                WHEN c_custkey % 9 = 2 THEN 'not a boolean: s=maybe' END AS error FROM x)
       SELECT c_custkey, error,
         CASE WHEN error IS NULL THEN port END AS port,
         CASE WHEN error IS NULL THEN c_custkey % 9 <> 1 END AS ssl,
         CASE WHEN error IS NULL THEN usr END AS usr,
         CASE WHEN error IS NULL THEN 'c' || c_custkey END AS tbl,
         CASE WHEN error IS NULL THEN concat(usr, CASE WHEN usr <> '' THEN ':***' ELSE '' END, '@tcp(db',
           c_custkey % 7, ':', port, ')/', lower(c_mktsegment), '?',
           CASE WHEN c_custkey % 9 <> 1 THEN 'allowFallbackToPlaintext=false,tls=true,' ELSE '' END,
           CASE WHEN c_custkey % 10 = 3 THEN '"a=1,b=2"' ELSE 'parseTime=true' END) END AS uri
       FROM e""",
)
def dsn_audit(spark, sf):
    texts = table(spark, sf, "customer").selectExpr("c_custkey", f"{_DSN} AS v")
    return dsn.dsn_audit(texts, "v").selectExpr(
        "c_custkey", "error", "CAST(dsn.port AS BIGINT) AS port", "dsn.ssl AS ssl", "dsn.user AS usr",
        "dsn.table AS tbl", "uri",
    )


_VERSION = """concat(CASE WHEN o_orderkey % 17 = 0 THEN 'v' ELSE '' END, 5 + 3 * (o_custkey % 2), '.',
    o_orderkey % 10, '.', o_orderkey % 130, CASE WHEN o_orderkey % 3 = 0 THEN '-rel' || o_custkey ELSE '' END)"""


@suite.add(
    "version_audit",
    f"""WITH v AS (SELECT o_orderkey, {_VERSION} AS v FROM orders),
        p AS (SELECT *, regexp_full_match(v, '[58]\\.[0-9]\\.[0-9]{{1,2}}(-.*)?') AS valid,
                string_split(string_split(v, '-')[1], '.') AS d FROM v)
        SELECT o_orderkey, v, valid, CASE WHEN valid THEN d[1] END AS major,
          CASE WHEN valid THEN d[2] || '.' || d[3] END AS minor,
          CASE WHEN valid THEN CASE WHEN contains(v, '-') THEN substr(v, strpos(v, '-')) ELSE '-' END END AS release,
          CASE WHEN valid THEN d[1] || lpad(d[2], 2, '0') || lpad(d[3], 2, '0') END AS normalized,
          CASE WHEN valid THEN sign(d[1]::INT * 10000 + d[2]::INT * 100 + d[3]::INT - 80030)::INT END AS vs_floor
        FROM p""",
)
def version_audit(spark, sf):
    texts = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_VERSION} AS v")
    return versions.version_audit(texts, "v", floor="8.0.30-rel")


@suite.add(
    "latest_version",
    f"""WITH v AS (SELECT o_orderpriority, {_VERSION} AS v FROM orders),
        p AS (SELECT *, string_split(string_split(v, '-')[1], '.') AS d FROM v
              WHERE regexp_full_match(v, '[58]\\.[0-9]\\.[0-9]{{1,2}}(-.*)?')),
        n AS (SELECT *, d[1] || lpad(d[2], 2, '0') || lpad(d[3], 2, '0') AS normalized FROM p)
        SELECT o_orderpriority, arg_max(v, normalized || v) AS latest, max(normalized) AS normalized
        FROM n GROUP BY 1""",
)
def latest_version(spark, sf):
    texts = table(spark, sf, "orders").selectExpr("o_orderpriority", f"{_VERSION} AS v")
    return versions.latest_version(texts, "v", ["o_orderpriority"])


_TALK = "(SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)"


def _talk(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.explode(F.split("text", "\n", -1)).alias("line")
    )


_DUCK_WORDS = "list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '')"


@suite.add(
    "align_lines",
    f"""WITH t AS (SELECT *, {_DUCK_WORDS} AS words FROM {_TALK}),
        p AS (SELECT unnest(list_transform(words, lambda w: length(w))) AS n,
                     generate_subscripts(words, 1) AS i FROM t),
        m AS (SELECT list(width ORDER BY i) AS widths FROM (SELECT i, max(n) AS width FROM p GROUP BY i))
        SELECT conv_id, turn, line,
          coalesce(array_to_string(list_transform(words, lambda w, i:
            lpad(w, widths[i]::INT, ' ') || ' '), ''), '') AS aligned
        FROM t, m""",
)
def align_lines(spark, sf):
    return align.align_lines(_talk(spark, sf))


_REPORT = """concat_ws('  ', event_id, event_type, user_id,
    CASE WHEN event_id % 5 = 0 THEN props END, CASE WHEN event_id % 7 = 0 THEN '-3.5e2' END)"""
_REPORT_WORDS = f"""w AS (SELECT event_id, {_DUCK_WORDS.replace('line', 'r')} AS words
        FROM (SELECT event_id, {_REPORT} AS r FROM events)),
    c AS (SELECT len(words) AS n, count(*) AS freq FROM w GROUP BY 1 ORDER BY freq DESC, n DESC LIMIT 1),
    l AS (SELECT w.* FROM w, c WHERE len(words) = n),
    f AS (SELECT words FROM l ORDER BY event_id LIMIT 1 OFFSET 1),
    i AS (SELECT i, max(length(words[i])) AS width FROM l, range(1, (SELECT n + 1 FROM c)) r(i) GROUP BY i),
    k AS (SELECT i AS pos, width, CASE WHEN regexp_full_match((SELECT words FROM f)[i],
          '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 'right' ELSE 'left' END AS align FROM i)"""


def _report(spark, sf):
    return table(spark, sf, "events").selectExpr("event_id", f"{_REPORT} AS line")


@suite.add("infer_columns", f"WITH {_REPORT_WORDS} SELECT * FROM k")
def infer_columns(spark, sf):
    return align.infer_columns(_report(spark, sf), "event_id")


@suite.add(
    "align_table",
    f"""WITH {_REPORT_WORDS},
        a AS (SELECT list(width ORDER BY pos) AS widths, list(align ORDER BY pos) AS aligns FROM k)
        SELECT event_id, array_to_string(list_transform(words, lambda w, i:
          CASE WHEN aligns[i] = 'right' THEN lpad(w, widths[i]::INT, ' ')
               ELSE rpad(w, widths[i]::INT, ' ') END), ' ') AS aligned
        FROM l, a""",
)
def align_table(spark, sf):
    return align.align_table(_report(spark, sf), "event_id").select("event_id", "aligned")


@suite.add(
    "typed_columns",
    f"""WITH {_REPORT_WORDS}
        SELECT event_id, i AS pos, words[i] AS word,
          CASE WHEN regexp_full_match(words[i], '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')
               THEN CAST(words[i] AS DOUBLE) END AS number
        FROM l, range(1, (SELECT n + 1 FROM c)) r(i)
        WHERE event_id > (SELECT min(event_id) FROM l)""",
)
def typed_columns(spark, sf):
    typed = align.typed_columns(_report(spark, sf), "event_id")
    return typed.select("event_id", F.posexplode(F.arrays_zip("words", "numbers")).alias("i", "w")).selectExpr(
        "event_id", "CAST(i + 1 AS BIGINT) AS pos", "w.words AS word", "w.numbers AS number"
    )


_ITEMS = "CASE WHEN turn % 5 = 4 THEN NULL ELSE concat(role, ',\\N\\', text) END"
_ESCAPED = "coalesce(replace(replace(v, '\\', '\\\\'), ',', '\\,'), '\\N')"


def _items(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.expr(_ITEMS.replace("\\", "\\\\")).alias("v")
    )


@suite.add(
    "group_serialize",
    f"""SELECT conv_id, 0 AS part, 1 AS first_pos, count(*) AS n_items, string_agg({_ESCAPED}, ',' ORDER BY turn) AS items
        FROM (SELECT conv_id, turn, {_ITEMS} AS v FROM conversations) GROUP BY conv_id""",
)
def group_serialize(spark, sf):
    return lists.group_serialize(_items(spark, sf), ["conv_id"], "v", ["turn"])


@suite.add(
    "group_serialize_parts",
    """WITH n AS (SELECT event_type, user_id, event_id,
                    row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i FROM events)
       SELECT event_type, i // 1000 AS part, min(i) + 1 AS first_pos, count(*) AS n_items,
              string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY i) AS items
       FROM n GROUP BY 1, 2""",
)
def group_serialize_parts(spark, sf):
    return lists.group_serialize(
        table(spark, sf, "events"), ["event_type"], "user_id", ["event_id"], max_items=1000
    )


@suite.add(
    "explode_serialized",
    f"""SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, {_ITEMS} AS item
        FROM conversations""",
)
def explode_serialized(spark, sf):
    packed = lists.group_serialize(_items(spark, sf), ["conv_id"], "v", ["turn"])
    return lists.explode_serialized(packed.drop("part", "n_items"), "items", first_pos="first_pos")


@suite.add(
    "explode_serialized_parts",
    """SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS pos,
              CAST(user_id AS VARCHAR) AS item
       FROM events""",
)
def explode_serialized_parts(spark, sf):
    """Lists in several parts, cut by items and by bytes."""
    packed = lists.group_serialize(
        table(spark, sf, "events"), ["event_type"], "user_id", ["event_id"], max_items=700, max_bytes=3000
    )
    return lists.explode_serialized(packed.drop("part", "n_items"), "items", first_pos="first_pos")


_QUALIFIED = """CASE s_suppkey % 4 WHEN 0 THEN s_name WHEN 1 THEN concat('db', s_nationkey, '.', s_name)
    WHEN 2 THEN concat('`a.b', s_nationkey, '`.`t``', s_suppkey, '`') ELSE concat('`x.', s_suppkey, '`') END"""


@suite.add(
    "qualify_names",
    f"""SELECT s_suppkey, {_QUALIFIED} AS n,
          CASE s_suppkey % 4 WHEN 1 THEN 'db' || s_nationkey WHEN 2 THEN 'a.b' || s_nationkey ELSE 'main' END AS db,
          CASE s_suppkey % 4 WHEN 2 THEN 't`' || s_suppkey WHEN 3 THEN 'x.' || s_suppkey ELSE s_name END AS tbl
        FROM supplier""",
)
def qualify_names(spark, sf):
    named = table(spark, sf, "supplier").selectExpr("s_suppkey", f"{_QUALIFIED} AS n")
    return names.qualify_names(named, "n", "main")

"""Catalogs from collections of CREATE TABLE texts.

The input has one text per row, ``(src_id, ddl)``, as printed by the server: one column
or key per line, indented by two blanks.  Each catalog is a narrow transformation of
that row, so no shuffle is involved before keys are ranked.

Parentheses nest, so they are not left to patterns: a line is cut into quoted texts,
names, parentheses, commas and what is between, and one pass over these counts the depth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# A backticked name; a backtick inside it is doubled.
_NAME = r"`((?:[^`]++|``)*+)`"
_CREATE = r"(?i)CREATE (?:TEMPORARY )?TABLE (?:IF NOT EXISTS )?"
_LINE = r"(?:\A|\n)"

# type word, then an optional parenthesis that may hold quoted text
_COLUMN = rf"^\s\s{_NAME}\s+([A-Za-z]+(?:\((?:[^')]++|'[^']*+')*+\))?)(.*)"
_KEY_COLUMNS = r"((?:[^()`]++|`(?:[^`]++|``)*+`|\([0-9]+\))*+)"
_KEY = rf"^\s\s(PRIMARY|(?:FULLTEXT |SPATIAL |UNIQUE )?)\s*KEY (?:{_NAME} )?(?=\()"
_KEY_COLUMN = rf"^\s*{_NAME}(?:\(([0-9]+)\))?(?:\s+(?:ASC|DESC))?\s*$"
_CHECK = rf"^\s\s(?:CONSTRAINT {_NAME} )?CHECK\s*(?=\()"
_FOREIGN = (
    rf"^\s\sCONSTRAINT {_NAME} FOREIGN KEY \({_KEY_COLUMNS}\) "
    rf"REFERENCES (?:{_NAME}\.)?{_NAME} \({_KEY_COLUMNS}\)"
)

# a quoted text, a name, a parenthesis, a comma, or a stretch of anything else
_TOKEN = r"""(?s)`(?:[^`]++|``)*+`?|'(?:[^'\\]++|''|\\.)*+'?|"(?:[^"\\]++|""|\\.)*+"?|[(),]|[^`'"(),]++"""
_SCANNED = "struct<at:int,depth:int,open:int,groups:array<struct<open:int,close:int>>,cuts:array<int>>"

# fixed values: the types that count as numbers
_NUMERIC = [
    "tinyint", "smallint", "mediumint", "int", "integer", "bigint",
    "decimal", "numeric", "float", "double", "real", "year",
]


def _unescape(name: Column) -> Column:
    return F.replace(name, F.lit("``"), F.lit("`"))


def _lines(pattern: str) -> Column:
    return F.filter(F.split("ddl", "\r?\n", -1), lambda line: line.rlike(pattern))


def _scan(text: Column, then: Callable[[Column], Column] = lambda seen: seen) -> Column:
    """The outermost parentheses of a text, and the commas in the first pair of them.

    ``groups`` holds the places of each pair, from 1, ``cuts`` those of the commas.  Only
    tokens at depth 0 or 1 add to a list, so the pass is linear in the text.  ``then`` gets
    the pass's outcome; what it looks up there, however often, takes no other pass.
    """
    start = F.from_json(F.lit('{"at":0,"depth":0,"open":0,"groups":[],"cuts":[]}'), _SCANNED)

    def step(seen: Column, token: Column) -> Column:
        here, depth = seen["at"] + 1, seen["depth"]
        opens, closes = token == "(", (token == ")") & (depth > 0)
        pair = F.struct(seen["open"].alias("open"), here.alias("close"))
        cut = (token == ",") & (depth == 1) & (F.size(seen["groups"]) == 0)
        return F.struct(
            (seen["at"] + F.length(token)).alias("at"),
            F.when(opens, depth + 1).when(closes, depth - 1).otherwise(depth).alias("depth"),
            F.when(opens & (depth == 0), here).otherwise(seen["open"]).alias("open"),
            F.when(closes & (depth == 1), F.array_append(seen["groups"], pair)).otherwise(seen["groups"]).alias("groups"),
            F.when(cut, F.array_append(seen["cuts"], here)).otherwise(seen["cuts"]).alias("cuts"),
        )

    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), start, step, then)


def _between(text: Column, after: Column, before: Column) -> Column:
    """What lies between two places of a text, without them."""
    return F.substring(text, after + 1, before - after - 1)


def _parts(text: Column) -> Column:
    """The parts of the first parenthesis, cut at its own commas; none if it never closes."""

    def cut(seen: Column) -> Column:
        first, cuts = F.get(seen["groups"], F.lit(0)), seen["cuts"]

        def part(end: Column, i: Column) -> Column:
            return _between(text, F.when(i > 0, F.get(cuts, i - 1)).otherwise(first["open"]), end)

        return F.when(F.size(seen["groups"]) > 0, F.transform(F.array_append(cuts, first["close"]), part))

    return _scan(text, cut)


def _cut(text: Column, groups: Column) -> Column:
    """Each of some parentheses: the words ``before`` it and what it holds (``inside``)."""

    def cut(group: Column, i: Column) -> Column:
        end = F.when(i > 0, F.get(groups, i - 1)["close"]).otherwise(F.lit(0))
        return F.struct(
            _between(text, end, group["open"]).alias("before"),
            _between(text, group["open"], group["close"]).alias("inside"),
        )

    return F.transform(groups, cut)


def _with_groups(text: Column) -> Column:
    """Each outermost parenthesis: the words ``before`` it and what it holds (``inside``)."""
    return _scan(text, lambda seen: _cut(text, seen["groups"]))


def _outside(text: Column) -> Column:
    """A text without what its parentheses hold."""

    def bare(seen: Column) -> Column:
        groups = seen["groups"]
        last = F.get(groups, F.size(groups) - 1)["close"]
        heads = F.transform(_cut(text, groups), lambda g: F.concat(g["before"], F.lit("()")))
        tail = F.substring(text, last + 1, F.length(text))
        return F.when(F.size(groups) > 0, F.concat(F.array_join(heads, ""), tail)).otherwise(text)

    return _scan(text, bare)


def ddl_tables(df: DataFrame) -> DataFrame:
    """``(src_id, name, engine, charset, error)``, one row per text.

    The first of these decides ``error``: empty text, name not backticked, no name, no
    engine, no default charset.
    """
    ddl = F.col("ddl")
    name = F.regexp_extract(ddl, _CREATE + _NAME, 1)
    engine = F.regexp_extract(ddl, _LINE + r"\)\s*ENGINE\s?=\s?([^\s;]+)", 1)
    charset = F.regexp_extract(ddl, r"DEFAULT CHARSET=([^\s;]+)", 1)
    error = (
        F.when(F.coalesce(ddl, F.lit("")) == "", "empty")
        .when(~ddl.rlike(_CREATE + "`"), "unquoted name")
        .when(name == "", "no name")
        .when(engine == "", "no engine")
        .when(charset == "", "no charset")
    )

    def known(value: Column) -> Column:
        return F.when(value != "", value)

    return df.select(
        "src_id",
        known(_unescape(name)).alias("name"),
        known(engine).alias("engine"),
        known(charset).alias("charset"),
        error.alias("error"),
    )


def _spark_type(base: Column, args: Column, unsigned: Column) -> Column:
    """The Spark type able to hold a column's values.

    A decimal of more than 38 digits, Spark's most, is a string.
    """
    precision = F.when(args == "", F.lit("10,0")).otherwise(
        F.when(F.instr(args, ",") > 0, F.replace(args, F.lit(" "), F.lit(""))).otherwise(F.concat(args, F.lit(",0")))
    )
    return (
        F.when(base == "tinyint", F.when(unsigned, "smallint").otherwise("tinyint"))
        .when(base == "smallint", F.when(unsigned, "int").otherwise("smallint"))
        .when(base == "mediumint", "int")
        .when(base.isin("int", "integer"), F.when(unsigned, "bigint").otherwise("int"))
        .when(base == "bigint", F.when(unsigned, "decimal(20,0)").otherwise("bigint"))
        .when(base.isin("decimal", "numeric") & (F.substring_index(precision, ",", 1).try_cast("int") > 38), "string")
        .when(base.isin("decimal", "numeric"), F.concat(F.lit("decimal("), precision, F.lit(")")))
        .when(base == "float", "float")
        .when(base.isin("double", "real"), "double")
        .when(base.rlike("(binary|blob)$"), "binary")
        .when(base == "set", "array<string>")
        .when(base == "date", "date")
        .when(base == "datetime", "timestamp_ntz")
        .when(base == "timestamp", "timestamp")
        .when(base == "year", "int")
        .otherwise("string")
    )


def ddl_columns(df: DataFrame) -> DataFrame:
    """One row per column: position from 1, name, type, properties and Spark type."""
    lines = df.select("src_id", F.posexplode(_lines(r"^\s\s`")).alias("i", "line"))
    parts = lines.select(
        "src_id",
        "i",
        _unescape(F.regexp_extract("line", _COLUMN, 1)).alias("name"),
        F.regexp_extract("line", _COLUMN, 2).alias("raw_type"),
        F.regexp_extract("line", _COLUMN, 3).alias("rest"),
    )
    # attributes without quoted texts and without what parentheses hold
    bare = F.when(F.col("rest").contains("("), _outside(F.col("rest"))).otherwise(F.col("rest"))
    bare = F.regexp_replace(bare, r"'(?:[^'\\]++|''|\\.)*+'", "''")
    typed = parts.withColumns(
        {
            "attrs": bare,
            "base": F.lower(F.regexp_extract("raw_type", r"^[A-Za-z]+", 0)),
            "args": F.regexp_extract("raw_type", r"\(([0-9, ]+)\)", 1),
        }
    )
    members = F.regexp_extract_all("raw_type", F.lit(r"'([^']*+(?:''[^']*+)*+)'"), F.lit(1))
    return typed.select(
        "src_id",
        (F.col("i") + 1).cast("long").alias("pos"),
        "name",
        "raw_type",
        (~F.col("attrs").rlike(r"(?i)\bNOT NULL\b")).alias("nullable"),
        F.col("attrs").rlike(r"(?i)\bGENERATED ALWAYS AS\b").alias("generated"),
        F.col("base").isin(_NUMERIC).alias("numeric"),
        F.col("attrs").rlike(r"(?i)\bAUTO_INCREMENT\b").alias("autoinc"),
        _spark_type(F.col("base"), F.col("args"), F.col("attrs").rlike(r"(?i)\bunsigned\b")).alias("spark_type"),
        F.when(
            F.col("base").isin("enum", "set"),
            F.transform(members, lambda m: F.replace(m, F.lit("''"), F.lit("'"))),
        ).alias("members"),
    )


def ddl_keys(df: DataFrame) -> DataFrame:
    """One row per key part: key, type, primary, unique, position, column, prefix length,
    expression.

    A part that is an expression has no column; a key whose parenthesis never closes has
    one part with neither.
    """
    lines = df.select("src_id", F.explode(_lines(_KEY)).alias("line"))
    kind = F.trim(F.regexp_extract("line", _KEY, 1))
    heads = lines.select(
        "src_id",
        F.when(kind == "PRIMARY", "PRIMARY").otherwise(_unescape(F.regexp_extract("line", _KEY, 2))).alias("key_name"),
        F.when(kind == "SPATIAL", "RTREE").when(kind == "FULLTEXT", "TEXT").otherwise("BTREE").alias("key_type"),
        (kind == "PRIMARY").alias("is_primary"),
        kind.isin("PRIMARY", "UNIQUE").alias("is_unique"),
        F.regexp_replace("line", _KEY, "").alias("body"),
    )
    parts = F.coalesce(_parts(F.col("body")), F.array(F.lit(None).cast("string")))
    keys = heads.select("*", F.posexplode(parts).alias("i", "part"))
    prefix = F.regexp_extract("part", _KEY_COLUMN, 2)
    column = F.regexp_extract("part", _KEY_COLUMN, 1)
    return keys.select(
        "src_id",
        "key_name",
        "key_type",
        "is_primary",
        "is_unique",
        (F.col("i") + 1).cast("long").alias("pos"),
        F.when(column != "", _unescape(column)).alias("col_name"),
        F.when(prefix != "", prefix.cast("long")).otherwise(0).alias("prefix_length"),
        F.when(column == "", F.regexp_extract("part", r"(?s)^\s*\(?(.*?)\)?(?:\s+(?:ASC|DESC))?\s*$", 1)).alias("expression"),
    )


def ddl_expressions(df: DataFrame) -> DataFrame:
    """Every expression in a text: ``(src_id, kind, name, pos, expression)``.

    ``kind`` is ``generated`` or ``default`` (of a column, with its position), ``check``
    (of a table or column, numbered within a column), or ``key`` (a part of a key).
    """
    lines = df.select("src_id", F.posexplode(_lines(r"^\s\s`")).alias("i", "line"))
    rest = F.regexp_extract("line", _COLUMN, 3)
    columns = lines.select(
        "src_id", "i", _unescape(F.regexp_extract("line", _COLUMN, 1)).alias("name"), rest.alias("rest")
    ).where(F.col("rest").contains("("))
    groups = columns.select("src_id", "i", "name", F.explode(_with_groups(F.col("rest"))).alias("group"))
    word = F.lower(F.regexp_extract("group.before", r"(?i)\b(GENERATED\s+ALWAYS\s+AS|DEFAULT|CHECK)\s*$", 1))
    of_columns = groups.select(
        "src_id",
        F.when(word.startswith("generated"), "generated").when(word != "", word).alias("kind"),
        "name",
        (F.col("i") + 1).cast("long").alias("pos"),
        F.col("group.inside").alias("expression"),
    ).where("kind IS NOT NULL")
    checks = df.select("src_id", F.explode(_lines(_CHECK)).alias("line")).select(
        "src_id",
        F.regexp_extract("line", _CHECK, 1).alias("name"),
        F.regexp_replace("line", _CHECK, "").alias("body"),
    )
    of_tables = checks.select(
        "src_id",
        F.lit("check").alias("kind"),
        F.when(F.col("name") != "", _unescape(F.col("name"))).alias("name"),
        F.lit(1).cast("long").alias("pos"),
        F.get(_with_groups(F.col("body")), F.lit(0))["inside"].alias("expression"),
    )
    of_keys = (
        ddl_keys(df)
        .where("col_name IS NULL")
        .select("src_id", F.lit("key").alias("kind"), F.col("key_name").alias("name"), "pos", "expression")
    )
    return of_columns.unionByName(of_tables).unionByName(of_keys)


def ddl_foreign_keys(df: DataFrame) -> DataFrame:
    """One row per pair of child and parent column of a foreign key."""
    lines = df.select("src_id", F.explode(_lines(_FOREIGN)).alias("line"))

    def names(group: int) -> Column:
        return F.regexp_extract_all(F.regexp_extract("line", _FOREIGN, group), F.lit(_NAME), F.lit(1))

    pairs = lines.select(
        "src_id",
        _unescape(F.regexp_extract("line", _FOREIGN, 1)).alias("fk_name"),
        _unescape(F.regexp_extract("line", _FOREIGN, 4)).alias("parent_table"),
        F.posexplode(F.arrays_zip(names(2).alias("child"), names(5).alias("parent"))).alias("i", "c"),
    )
    return pairs.select(
        "src_id",
        "fk_name",
        (F.col("i") + 1).cast("long").alias("pos"),
        _unescape(F.col("c.child")).alias("child_col"),
        "parent_table",
        _unescape(F.col("c.parent")).alias("parent_col"),
    )


def rank_indexes(key_catalog: DataFrame) -> DataFrame:
    """Every table's BTREE keys from best to worst: ``(src_id, key_name, n_cols, rank)``.

    Primary first, then unique ones, then those with more columns, then by name.  One
    shuffle by table serves both the counting and the ranking.
    """
    keys = (
        key_catalog.where("key_type = 'BTREE'")
        .repartition("src_id")
        .groupBy("src_id", "key_name", "is_primary", "is_unique")
        .agg(F.count(F.lit(1)).alias("n_cols"))
    )
    order = W.partitionBy("src_id").orderBy(
        F.desc("is_primary"), F.desc("is_unique"), F.desc("n_cols"), "key_name"
    )
    return keys.select(
        "src_id", "key_name", "is_primary", "is_unique", "n_cols",
        F.row_number().over(order).cast("long").alias("rank"),
    )


def locator_columns(
    key_catalog: DataFrame, column_catalog: DataFrame, preferred: str | None = None
) -> DataFrame:
    """The columns that name single rows of a table: ``(src_id, pos, name)``.

    Those of the key to use if that key is unique and has no expressions, else all columns.
    """
    best = best_index(key_catalog, preferred=preferred).where("error IS NULL")
    computed = key_catalog.where("col_name IS NULL").select("src_id", "key_name").distinct()
    unique = (
        key_catalog.where("is_unique")
        .join(best.select("src_id", "key_name"), ["src_id", "key_name"])
        .join(computed, ["src_id", "key_name"], "left_anti")
        .select("src_id", "pos", F.col("col_name").alias("name"))
    )
    keyed = unique.select("src_id").distinct()
    others = column_catalog.join(keyed, "src_id", "left_anti").select("src_id", "pos", "name")
    return unique.unionByName(others)


def best_index(
    key_catalog: DataFrame, tables: DataFrame | None = None, preferred: str | None = None
) -> DataFrame:
    """The key to use per table: ``(src_id, key_name, error)``.

    With ``preferred`` that key where it exists, and an error where it does not.  Tables
    of ``tables(src_id)`` without a usable key get a NULL key.
    """
    if preferred is None:
        none = F.lit(None).cast("string").alias("error")
        found = rank_indexes(key_catalog).where("rank = 1").select("src_id", "key_name", none)
    else:
        hit = F.max(F.col("key_name") == preferred)
        found = key_catalog.groupBy("src_id").agg(hit.alias("hit")).select(
            "src_id",
            F.when(F.col("hit"), F.lit(preferred)).alias("key_name"),
            F.when(~F.col("hit"), F.lit(f"key {preferred} does not exist")).alias("error"),
        )
    if tables is None:
        return found
    every = tables.select("src_id").distinct().join(found, "src_id", "left")
    if preferred is None:
        return every
    missing = F.lit(f"key {preferred} does not exist")
    return every.withColumn("error", F.when(F.col("key_name").isNull(), missing))


"""Lines of words set in columns.

Widths are one small aggregate.  Their array is no longer than the longest line's own
array of words, so every task can hold it wherever it can hold that line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.operators.chunks import multiply

_SPACE = r"\p{IsWhite_Space}+"
_NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"


def words_of(line: Column) -> Column:
    return F.filter(F.split(line, _SPACE, -1), lambda w: w != "")


def column_widths(lines: DataFrame, words: str = "_words") -> DataFrame:
    """``(pos, width)``: the widest word at each word position, from 0."""
    sizes = F.transform(F.col(words), lambda w: F.char_length(w))
    return lines.select(F.posexplode(sizes).alias("pos", "n")).groupBy("pos").agg(F.max("n").alias("width"))


def _in_order(frame: DataFrame, value: str) -> Column:
    """The per-position values as one array, a scalar for the lines' plan."""
    pairs = F.sort_array(F.collect_list(F.struct("pos", value)))
    return frame.agg(pairs.alias("p")).select(F.col("p")[value].alias("a")).scalar()


def align_lines(df: DataFrame, line_col: str = "line", out: str = "aligned") -> DataFrame:
    """Right-align every word to its position's width, one blank after each word."""
    lines = df.withColumn("_words", words_of(F.col(line_col)))
    widths = _in_order(column_widths(lines), "width")
    padded = F.transform(
        F.col("_words"), lambda w, i: F.concat(F.lpad(w, F.get("_widths", i), " "), F.lit(" "))
    )
    return lines.withColumn("_widths", widths).withColumn(out, F.array_join(padded, "")).drop(
        "_words", "_widths"
    )


def conforming_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines with the most frequent number of words (the larger number on a tie)."""
    lines = df.withColumn("_words", words_of(F.col(line_col)))
    counts = lines.groupBy(F.size("_words").alias("n")).agg(F.count(F.lit(1)).alias("freq"))
    modal = counts.where("n > 0").agg(F.max(F.struct("freq", "n")).alias("m")).select("m.n").scalar()
    return lines.where(F.size("_words") == modal)


def infer_columns(df: DataFrame, order_col: str, line_col: str = "line") -> DataFrame:
    """``(pos, width, align)`` of a text table, ``pos`` from 1.

    Lines without the usual number of words are left out.  The second of the others is
    the first data line; its numeric words make right-aligned columns.
    """
    lines = conforming_lines(df, line_col)
    first_data = lines.orderBy(order_col).offset(1).limit(1)
    kinds = first_data.select(F.posexplode("_words").alias("pos", "word")).select(
        "pos", F.when(F.col("word").rlike(_NUMBER), "right").otherwise("left").alias("align")
    )
    return (
        column_widths(lines)
        .join(kinds, "pos", "left")
        .select(
            (F.col("pos") + 1).cast("long").alias("pos"),
            F.col("width").cast("long").alias("width"),
            F.coalesce("align", F.lit("left")).alias("align"),
        )
    )


def align_table(df: DataFrame, order_col: str, line_col: str = "line", out: str = "aligned") -> DataFrame:
    """The conforming lines with numeric columns right-aligned and the others left."""
    lines = conforming_lines(df, line_col)
    columns = infer_columns(df, order_col, line_col)
    widths, kinds = _in_order(columns, "width"), _in_order(columns, "align")
    lines = lines.withColumn("_widths", widths).withColumn("_kinds", kinds)

    def pad(word: Column, i: Column) -> Column:
        width = F.get("_widths", i).cast("int")
        return F.when(F.get("_kinds", i) == "right", F.lpad(word, width, " ")).otherwise(
            F.rpad(word, width, " ")
        )

    return lines.withColumn(out, F.array_join(F.transform("_words", pad), " ")).drop(
        "_words", "_widths", "_kinds"
    )


def typed_columns(df: DataFrame, order_col: str, line_col: str = "line") -> DataFrame:
    """Data lines as an array of words and, next to it, of numbers (NULL for text).

    The header is one line: of lines that tie for the first place, the least by its text.
    """
    lines = conforming_lines(df, line_col).select(order_col, F.col(line_col).alias("_line"), "_words")
    place = F.struct(F.col(order_col), F.col("_line"))
    header = lines.agg(F.min(place).alias("m")).scalar()
    number = F.transform("_words", lambda w: F.when(w.rlike(_NUMBER), w.cast("double")))
    # further copies of the header line are data
    copies = lines.where(place == header).groupBy(order_col, "_line", "_words").agg(F.count(F.lit(1)).alias("_n"))
    again = multiply(copies.where("_n > 1"), F.lit(2).cast("long"), F.col("_n"), "_copy")
    data = lines.where(place > header).select(order_col, "_words").unionByName(again.select(order_col, "_words"))
    return data.select(order_col, F.col("_words").alias("words"), number.alias("numbers"))

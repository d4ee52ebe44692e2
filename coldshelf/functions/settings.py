"""Tables of settings lists: commas separate items except inside double quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.functions.columns import bind

_MARK = "\u0001"


def split_settings(text: Column) -> Column:
    """Items of a settings list.

    A comma separates where an even number of quotes follows it.  The text is cut at its
    quotes and commas are replaced in the pieces with that parity, which stays linear in
    the text's length.  One empty item at either end is dropped, inner ones stay.
    """
    safe = F.replace(text, F.lit(_MARK), F.lit(_MARK + "A"))
    cut = bind(F.split(safe, '"', -1), _mark_separators)
    items = F.transform(
        F.split(F.array_join(cut, '"'), _MARK + "B", -1),
        lambda item: F.replace(item, F.lit(_MARK + "A"), F.lit(_MARK)),
    )
    return bind(items, _drop_empty_ends)


def _mark_separators(pieces: Column) -> Column:
    marked = lambda piece: F.replace(piece, F.lit(","), F.lit(_MARK + "B"))
    return F.transform(
        pieces,
        lambda piece, i: F.when((F.size(pieces) - 1 - i) % 2 == 0, marked(piece)).otherwise(piece),
    )


def _drop_empty_ends(items: Column) -> Column:
    first = F.when(F.get(items, F.lit(0)) == "", 2).otherwise(1)
    trailing = (F.size(items) > 1) & (F.element_at(items, -1) == "")
    count = F.size(items) - F.when(trailing, 1).otherwise(0) - first + 1
    return F.slice(items, first, F.greatest(count, F.lit(0)))


def explode_settings(df: DataFrame, col: str, id_col: str = "id") -> DataFrame:
    """``(id, pos, item, name, value)``; name and value are split at the first ``=``."""
    items = df.select(id_col, F.posexplode(split_settings(F.col(col))).alias("pos", "item"))
    at = F.instr("item", "=")
    return items.select(
        id_col,
        (F.col("pos") + 1).cast("long").alias("pos"),
        "item",
        F.when(at > 0, F.substring("item", F.lit(1), at - 1)).otherwise(F.col("item")).alias("name"),
        F.when(at > 0, F.substring("item", at + 1, F.length("item"))).alias("value"),
    )

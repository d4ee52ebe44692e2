"""Rows that every operator must take, and tables made of them."""

LONG = "long words " * 12_000
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# extra columns whose names operators use for their own
CLASHING = "id string, row string, kept int, host string, owner string, line int, digest string, word string, print string, component int"


def docs(spark, rows, extra=False):
    """Rows (doc_id, text) or (doc_id, text, source) as documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    if not extra:
        return spark.createDataFrame(full, SCHEMA)
    more = ("x", "x", 1, "x", "x", 1, "x", "x", "x", 1)
    return spark.createDataFrame([(*r, *more) for r in full], f"{SCHEMA}, {CLASHING}")


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, LONG), (5, "one"), (5, "one"), (None, "no id"), (6, "Straße 日本 🙂 x")]

"""Token counts of the sections or fields of documents that are encoded whole.

A document is encoded once.  The bytes of its tokens give every token an interval, and the
intervals are joined to those of the sections, which tile the document: a section ends
behind its separator.  A token that lies in several sections is allocated by a rule:

* ``first``: to the section of its first byte,
* ``majority``: to the section that has most of its bytes, the first of equal ones,
* ``split``: to each section by the share of its bytes.

By any rule the counts of a document's sections add up to the tokens of the document.

Defined results: a null or empty text has one section without characters or tokens.  Long
texts are encoded whole.  Repeated rows give repeated results, and null ids stay null.
Other columns of the input are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.batches import slices, texts

RULES = ("first", "majority", "split")


class Tokenizer:
    """A byte-level vocabulary and the lengths of its tokens in bytes."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def token_ends(self, whole: list[str]) -> np.ndarray:
        """Where the tokens of the texts end, in bytes of all texts one after the other."""
        # surrogates can't be in a Spark string, and there are no special tokens
        parts = [np.asarray(self.encoding.encode_ordinary(text), dtype=np.int64) for text in whole]
        return np.cumsum(self.lengths[np.concatenate([*parts, np.zeros(0, dtype=np.int64)])])


@cache
def tokenizer(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(path, pattern)


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and how many of its tokens reach into another one."""
    starts = np.concatenate([[0], token_ends[:-1]]) if len(token_ends) else token_ends
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    inner = first == last
    counts = np.bincount(first[inner], minlength=len(section_ends)).astype(np.float64)
    crossing = np.zeros(len(section_ends), dtype=np.int64)
    for token in np.flatnonzero(~inner).tolist():
        start, end = int(starts[token]), int(token_ends[token])
        own = np.arange(first[token], last[token] + 1)
        upper = np.minimum(section_ends[own], end)
        share = upper - np.maximum(np.concatenate([[start], section_ends[own[:-1]]]), start)
        crossing[own[share > 0]] += 1
        if rule == "split":
            counts[own] += share / (end - start)
        else:
            counts[own[0] if rule == "first" else own[int(np.argmax(share))]] += 1
    return counts, crossing


def _attribute(docs: DataFrame, id_col: str, model: str, pattern: str, rule: str, fields: int, separator: bytes) -> DataFrame:
    """Columns id, text and, for fields, sizes (the bytes of each field with its separator)."""
    if rule not in RULES:
        raise ValueError(f"the rule must be one of {', '.join(RULES)}")
    kind = docs.schema["id"].dataType.simpleString()
    names = [id_col, "section", "start_char", "end_char", "n_tokens", "n_crossing"]
    schema = f"`{id_col}` {kind}, section int, start_char bigint, end_char bigint, n_tokens double, n_crossing bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(model, pattern)
        for whole in batches:
            for batch in slices(whole, "text"):
                parts = texts(batch, "text")
                encoded = [text.encode() for text in parts]
                joined = np.frombuffer(b"".join(encoded), dtype=np.uint8)
                doc_ends = np.cumsum([len(e) for e in encoded])
                if fields:
                    sizes = batch.column("sizes").flatten().to_numpy()
                    rows = np.repeat(np.arange(len(parts)), fields)
                    ends = np.cumsum(sizes)
                else:
                    cuts = np.flatnonzero(joined == separator[0]) + 1 if len(separator) == 1 else _cuts(encoded, separator)
                    ends = np.union1d(cuts, doc_ends).astype(np.int64)
                    rows = np.searchsorted(doc_ends, ends - 1, side="right")
                    # an empty text ends where another section does, and has a section of its own
                    rows = np.sort(np.concatenate([rows[ends > 0], np.flatnonzero(np.array([not e for e in encoded]))]))
                    ends = _ends_of(rows, ends[ends > 0], encoded)
                token_ends = own.token_ends(parts)
                filled = np.concatenate([[True], np.diff(ends) > 0]) if len(ends) else np.zeros(0, dtype=bool)
                filled &= ends > 0
                counts, crossing = np.zeros(len(ends)), np.zeros(len(ends), dtype=np.int64)
                counts[filled], crossing[filled] = allocate(token_ends, ends[filled], rule)
                chars = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
                doc_starts = np.concatenate([[0], doc_ends[:-1]])
                begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                base = chars[doc_starts[rows]]
                number = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)),
                        pa.array(number.astype(np.int32)),
                        pa.array(chars[begin] - base),
                        pa.array(chars[ends] - base),
                        pa.array(counts),
                        pa.array(crossing),
                    ],
                    names,
                )

    return docs.mapInArrow(run, schema)


def _cuts(encoded: list[bytes], separator: bytes) -> np.ndarray:
    """Ends of a separator of several bytes, never across two texts."""
    out, base = [], 0
    for text in encoded:
        at = text.find(separator)
        while at >= 0:
            out.append(base + at + len(separator))
            at = text.find(separator, at + len(separator))
        base += len(text)
    return np.array(out, dtype=np.int64)


def _ends_of(rows: np.ndarray, ends: np.ndarray, encoded: list[bytes]) -> np.ndarray:
    """The ends with those of empty texts put in: such a section ends where it starts."""
    empty = np.array([not e for e in encoded])[rows]
    out = np.zeros(len(rows), dtype=np.int64)
    out[~empty] = ends
    return np.maximum.accumulate(out) if len(out) else out


def count_section_tokens(
    docs: DataFrame,
    model: str,
    pattern: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    separator: str = "\n",
    rule: str = "majority",
) -> DataFrame:
    """Tokens of every section of every document.

    Returns the id, ``section`` (from 0), ``start_char``, ``end_char``, ``n_tokens`` and
    ``n_crossing``, the tokens of the section that reach into another one.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _attribute(chosen, id_col, model, pattern, rule, 0, separator.encode())


def count_field_tokens(
    docs: DataFrame,
    model: str,
    pattern: str,
    fields: Sequence[str],
    *,
    id_col: str = "doc_id",
    separator: str = "\n",
    rule: str = "majority",
) -> DataFrame:
    """As above, with columns as sections: the document is the fields joined by the separator.

    A separator counts for the field before it; a null field is empty.
    """
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    parts = [F.concat(p, F.lit(separator)) if i < len(fields) - 1 else p for i, p in enumerate(parts)]
    chosen = docs.select(
        F.col(id_col).alias("id"),
        F.concat(*parts).alias("text"),
        F.array(*(F.octet_length(p).cast("bigint") for p in parts)).alias("sizes"),
    )
    return _attribute(chosen, id_col, model, pattern, rule, len(fields), separator.encode())

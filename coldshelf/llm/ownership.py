"""Secrets in texts, told apart by how many owners share them.

A scan of whole texts gives the spans of secret-like strings.  Their hashes are counted
over the corpus by distinct repositories and owners: a string that many owners hold, or
many repositories of one owner, is a copied example; one that a single owner holds in few
places and that looks random for its length may be live.

Defined results: nulls and empty texts have no spans; long texts are scanned whole.  A null
owner or repository is an owner or repository of its own.  Repeated rows, and null ids,
give results each, but count once per owner and repository.  Where spans of several kinds
overlap all are given, ordered by place and then by kind.  Other columns of the input are
ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.batches import slices, texts
from coldshelf.plans.staging import stage

# base kinds: pattern, group that holds the secret, least length of that group
BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# further kinds, by their issuers' fixed forms
ADDED = {
    "pem": (r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    "hub": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    "hook": (r"https://hooks\.[a-z]+\.com/services/[A-Za-z0-9/]{20,}", 0, 1),
}
KINDS = [*BASE, *ADDED]
# the shortest run that can pass is asked for at once where a match is a whole run anyway
_PATTERNS = {
    "assign": re.compile(BASE["assign"][0], re.ASCII | re.IGNORECASE),
    "access": re.compile(BASE["access"][0]),
    "hex": re.compile(r"[0-9a-f]{24,}"),
    **{kind: re.compile(pattern) for kind, (pattern, _, _) in ADDED.items()},
}


LEAST_MIXED = 0.75  # share of the bits that are possible
_HEX = re.compile("[0-9a-f]+")
_CLASSES = [(re.compile("[0-9]"), 10), (re.compile("[a-z]"), 26), (re.compile("[A-Z]"), 26), (re.compile("[^0-9A-Za-z]"), 8)]


def find_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, secret) of every span, ordered; ends are exclusive."""
    found = []
    for number, kind in enumerate(KINDS):
        _, group, least = BASE.get(kind) or ADDED[kind]
        for match in _PATTERNS[kind].finditer(text):
            if len(match[group]) >= least:
                found.append((match.start(), number, match.end(), match[group]))
    return sorted(found)


def randomness(secret: str) -> float:
    """Bits per character by the secret's own character counts."""
    counts = Counter(secret).values()
    return sum(c / len(secret) * math.log2(len(secret) / c) for c in counts) if secret else 0.0


def looks_random(secret: str) -> bool:
    """Whether a secret's characters are as mixed as its length and alphabet let expect.

    A run of n characters has log2(n) bits each at most, and no more than its alphabet.
    """
    if len(secret) < 2:
        return False
    if _HEX.fullmatch(secret):
        alphabet = 16
    else:
        alphabet = sum(size for pattern, size in _CLASSES if pattern.search(secret)) or 2
    return randomness(secret) >= LEAST_MIXED * math.log2(min(len(secret), alphabet))


def joined(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[number]}:{start}:{end}" for start, number, end, _ in spans)


def scan_secrets(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """One row per input row: digests and counts of its spans, and its candidates' hashes."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, owner string, repository string, n_assign bigint, n_access bigint, n_hex bigint, "
        "base_sha256 string, spans string, candidates array<string>, random array<boolean>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                columns: list[list] = [[] for _ in range(7)]
                for text in texts(batch, "text"):
                    spans = find_spans(text)
                    base = [s for s in spans if s[1] < len(BASE)]
                    for number, column in enumerate(columns[:3]):
                        column.append(sum(s[1] == number for s in base))
                    columns[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                    columns[4].append(joined(spans))
                    columns[5].append([hashlib.sha256(s[3].encode()).hexdigest()[:32] for s in spans])
                    columns[6].append([looks_random(s[3]) for s in spans])
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.list_(pa.string()), pa.list_(pa.bool_())]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                head = [batch.column(c) for c in ("id", "owner", "repository")]
                names = [id_col, "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays(head + arrays, [*names, "candidates", "random"])

    chosen = docs.select(
        F.col(id_col).alias("id"),
        owner.cast("string").alias("owner"),
        repository.cast("string").alias("repository"),
        F.col(text_col).alias("text"),
    )
    return chosen.mapInArrow(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """For each candidate hash the number of repositories and owners that hold it."""
    spans = found.select("owner", "repository", F.explode("candidates").alias("candidate"))
    by_repository = spans.distinct()
    by_owner = by_repository.groupBy("candidate", "owner").agg(F.count("*").alias("r"))
    return by_owner.groupBy("candidate").agg(
        F.sum("r").alias("n_repositories"), F.count("*").alias("n_owners")
    )


_JUDGED = ["n_example", "n_live", "n_unsure", "most_owners", "most_repositories"]


def secret_scan(
    docs: DataFrame,
    *,
    owner: Column,
    repository: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    example_owners: int = 3,
    example_repositories: int = 10,
) -> DataFrame:
    """Secrets of each row and what their spread over the corpus says of them.

    Returns the id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` and,
    out of all its spans, ``n_example`` (held by ``example_owners`` owners or more, or by
    ``example_repositories`` repositories), ``n_live`` (held by one owner in fewer
    repositories, and random for its length) and ``n_unsure`` (the rest); and of its most
    widely held span ``most_owners`` and ``most_repositories``, 0 without spans.
    """
    found = stage(
        scan_secrets(docs, id_col, text_col, owner, repository).withColumn("row", F.monotonically_increasing_id()),
        "secrets",
    )
    counts = stage(ownership(found), "owners")
    example = (F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories)
    spans = found.select("row", F.explode(F.arrays_zip("candidates", "random")).alias("s"))
    judged = (
        spans.select("row", F.col("s.candidates").alias("candidate"), F.col("s.random").alias("random"))
        .join(counts, "candidate")
        .groupBy("row")
        .agg(
            F.count_if(example).alias("n_example"),
            F.count_if(~example & (F.col("n_owners") == 1) & F.col("random")).alias("n_live"),
            F.count("*").alias("n_all"),
            F.max("n_owners").alias("most_owners"),
            F.max("n_repositories").alias("most_repositories"),
        )
    )
    some, none = F.size("candidates") > 0, F.lit(0).cast("bigint")
    base = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    with_spans = (
        found.where(some)
        .join(judged, "row", "left")
        .withColumn("n_unsure", F.col("n_all") - F.col("n_example") - F.col("n_live"))
        .select(*base, *_JUDGED)
    )
    without = found.where(~some).select(*base, *[none.alias(c) for c in _JUDGED])
    return with_spans.unionByName(without)

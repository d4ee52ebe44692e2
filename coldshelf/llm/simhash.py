"""SimHash fingerprints, linked within a few bits by vantage-point trees.

The 64 bits are cut into slices.  Of two fingerprints that differ in ``bits`` bits or fewer,
some slice differs in ``bits // slices`` or fewer; for every slice a vantage-point tree parts
the fingerprints by the Hamming distance of that slice to a vantage, and whatever lies
within that radius of a boundary is also looked up on its other side.  The top of a tree
is fitted on a bounded sample and makes the shards; every fingerprint is put in its shard,
and inside a shard the tree goes on down to small leaves.  The distance of all 64 bits
then decides, so the links are exact whatever the sample.  A leaf that bears no further
parting (many fingerprints with one slice) is compared in blocks, by several tasks.

Defined results: texts without words, and nulls, have fingerprint zero and are linked like
others.  Long texts are hashed whole.  Equal fingerprints meet once, repeated rows each get
their row, and a shingle hash bit set in exactly half of them is not set.  A row without an
id takes part in links but never names a group.  A shard returns a forest of its links, not
all pairs.  Other columns of the input are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.batches import slices as text_slices
from coldshelf.llm.batches import texts
from coldshelf.llm.components import connected_components
from coldshelf.plans.staging import stage

SEED = 42
SHARD_ROWS = 16_384
MAX_SHARDS = 4_096
SAMPLE_PER_SHARD = 16
_LEAF = 256


def fingerprint(text: str, shingle: int = 4) -> int:
    """Majority of the bits of the XXH64 hashes of all runs of ``shingle`` words."""
    words = text.encode().lower().split()  # bytes: only A-Z is lowered, only ASCII white space parts
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    width = min(shingle, len(words))
    last = ends[width - 1 :].tolist()
    first = [0, *(ends[: len(words) - width] + 1).tolist()]
    runs = [joined[a:b] for a, b in zip(first, last, strict=True)]
    digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, runs, repeat(SEED))), dtype=np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(digests), 1 << 16):
        ones += np.unpackbits(digests[start : start + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(digests)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """The id of each row and ``print``, the fingerprint as a signed 64-bit number."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                prints = np.array([fingerprint(t, shingle) for t in texts(batch, "text")], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], [id_col, "print"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, f"`{id_col}` {kind}, print bigint")


# -- vantage-point trees ------------------------------------------------------------


def _distance(values: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ vantage).astype(np.int16)


def _choose(values: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage and a radius that part the values well, None if nothing parts them."""
    best, choice = 0, None
    for vantage in values[np.linspace(0, len(values) - 1, 5).astype(int)]:
        distances = _distance(values, vantage)
        radius = int(np.partition(distances, (len(distances) - 1) // 2)[(len(distances) - 1) // 2])
        for mu in (radius - 1, radius):
            inside = int((distances <= mu).sum())
            if min(inside, len(values) - inside) > best:
                best, choice = min(inside, len(values) - inside), (vantage, mu)
    return choice


def plant(sample: np.ndarray, shards: int) -> list[tuple]:
    """A tree over sampled slice values: nodes (vantage, radius, inner, outer) or (shard,)."""
    nodes: list[tuple] = []
    numbers = iter(range(1 << 30))

    def grow(values: np.ndarray, room: int) -> int:
        at = len(nodes)
        nodes.append(())
        choice = _choose(values) if room > 1 and len(values) > 1 else None
        if choice is None:
            nodes[at] = (next(numbers),)
            return at
        near = _distance(values, choice[0]) <= choice[1]
        inner = grow(values[near], room - room // 2)
        nodes[at] = (*choice, inner, grow(values[~near], room // 2))
        return at

    grow(sample, shards)
    return nodes


def _part(homes: np.ndarray, asks: np.ndarray, home_d: np.ndarray, ask_d: np.ndarray, mu: int, radius: int):
    """Homes and asks (index arrays) of the inner and the outer side.

    An inner home near the boundary also asks outside, which is enough for every pair of
    homes on both sides; those that ask already go wherever the bound allows.
    """
    near = home_d <= mu
    crossing = homes[near & (home_d > mu - radius)]
    return (
        (homes[near], asks[ask_d <= mu + radius]),
        (homes[~near], np.concatenate([asks[ask_d > mu - radius], crossing])),
    )


def route(values: np.ndarray, tree: list[tuple], radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, rows at home there, rows that ask there) for slice values."""
    todo = [(0, np.arange(len(values)), np.zeros(0, dtype=np.int64))]
    while todo:
        node, homes, asks = todo.pop()
        if not len(homes) and not len(asks):
            continue
        if len(tree[node]) == 1:
            yield tree[node][0], homes, asks
            continue
        vantage, mu, inner, outer = tree[node]
        sides = _part(homes, asks, _distance(values[homes], vantage), _distance(values[asks], vantage), mu, radius)
        todo += [(inner, *sides[0]), (outer, *sides[1])]


class _Forest:
    """Labels of rows under union, joined a neighbourhood at a time."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def join(self, i: int, others: np.ndarray) -> None:
        top = self.root(i)
        for other in np.unique(self.parent[others]).tolist():
            root = self.root(other)
            if root != top:
                low, high = min(root, top), max(root, top)
                self.parent[high] = low
                top = low
        self.parent[others] = top
        self.parent[i] = top if i != top else i


def link_shard(prints: np.ndarray, at_home: np.ndarray, mask: int, bits: int, radius: int) -> list[tuple[int, int]]:
    """A forest of the links of at most ``bits`` bits between homes, and asks and homes."""
    values = prints & np.uint64(mask)
    forest = _Forest(len(prints))
    todo = [(np.flatnonzero(at_home), np.flatnonzero(~at_home), False)]
    while todo:
        homes, asks, whole = todo.pop()
        if not len(homes) or len(homes) + len(asks) < 2:
            continue
        choice = None if len(homes) <= _LEAF or whole else _choose(values[homes])
        if choice is not None:
            sides = _part(homes, asks, _distance(values[homes], choice[0]), _distance(values[asks], choice[0]), choice[1], radius)
            todo += [(*side, False) for side in sides]
            continue
        everyone = np.concatenate([homes, asks])
        facing = prints[everyone]
        step = max(1, 4_000_000 // len(everyone))
        for start in range(0, len(homes), step):
            block = homes[start : start + step]
            close = np.bitwise_count(prints[block][:, None] ^ facing[None, :]) <= bits
            for row in np.flatnonzero(close.sum(axis=1) > 1).tolist():
                others = everyone[close[row]]
                if (forest.parent[others] != forest.parent[block[row]]).any():
                    forest.join(int(block[row]), others)
    roots = [forest.root(i) for i in range(len(prints))]
    return [(i, r) for i, r in enumerate(roots) if i != r]


def near_links(prints: DataFrame, bits: int = 4, slices: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links ``a``, ``b`` that join all distinct fingerprints (column ``print``) within ``bits`` bits.

    Their components are those of all such pairs; pairs that follow from others are left out.
    """
    spark = prints.sparkSession
    total = prints.count()
    shards = min(MAX_SHARDS, max(16, -(-total // shard_rows)))
    wanted = shards * SAMPLE_PER_SHARD
    share = min(1.0, 2.0 * wanted / max(1, total))
    sample = prints.where(F.pmod(F.xxhash64("print"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(4 * wanted)
    sampled = np.sort(np.array([r[0] for r in sample.collect()], dtype=np.int64)).view(np.uint64)
    width = 64 // slices
    masks = [((1 << (width if s < slices - 1 else 64 - width * s)) - 1) << (width * s) for s in range(slices)]
    radius = bits // slices
    trees = [plant(sampled & np.uint64(m), shards) if len(sampled) else [(0,)] for m in masks]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for number, (mask, tree) in enumerate(zip(masks, trees, strict=True)):
                for shard, homes, asks in route(fps & np.uint64(mask), tree, radius):
                    rows = np.concatenate([homes, asks])
                    home = np.arange(len(rows)) < len(homes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), number, dtype=np.int32)),
                            pa.array(np.full(len(rows), shard, dtype=np.int32)),
                            pa.array(fps[rows].view(np.int64)),
                            pa.array(home),
                        ],
                        ["slice", "shard", "print", "home"],
                    )

    sent = stage(prints.select("print").mapInArrow(send, "slice int, shard int, print bigint, home boolean"), "shards")
    # homes of a crowded shard are dealt over blocks; those that ask, ask in each block
    crowd = sent.where("home").groupBy("slice", "shard").agg(F.count("*").alias("n")).where(F.col("n") > 4 * shard_rows)
    blocks = {(r["slice"], r["shard"]): -(-r["n"] // (2 * shard_rows)) for r in crowd.collect()}
    placed = sent.withColumn("block", F.lit(0))
    if blocks:
        sizes = spark.createDataFrame([(*k, v) for k, v in blocks.items()], "slice int, shard int, blocks int")
        sent = sent.join(F.broadcast(sizes), ["slice", "shard"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.pmod(F.xxhash64("print", F.lit(7)), "blocks").cast("int")
        asking = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = sent.where("home").withColumn("block", own).unionByName(
            asking.where(~F.col("home") | (F.col("block") != own)).withColumn("home", F.lit(False))
        )

    def link(key: tuple, table: pa.Table) -> pa.Table:
        fps = table.column("print").to_numpy().view(np.uint64)
        pairs = link_shard(fps, table.column("home").to_numpy(zero_copy_only=False), masks[key[0].as_py()], bits, radius)
        ends = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        signed = fps.view(np.int64)
        return pa.table({"a": signed[ends[:, 0]], "b": signed[ends[:, 1]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return placed.groupBy("slice", "shard", "block").applyInArrow(link, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4
) -> DataFrame:
    """Each row's id, ``fingerprint`` (hex) and ``component_id``, the least id it is linked to."""
    found = stage(fingerprints(docs, id_col, text_col, shingle), "prints")
    classes = stage(found.groupBy("print").agg(F.min(id_col).alias("least")), "classes")
    members = connected_components(near_links(classes, bits))
    classes = classes.join(members, classes["print"] == members["node"], "left").select(
        "print", "least", F.coalesce("component", "print").alias("component")
    )
    classes = stage(classes, "members")
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = stage(classes.join(least, "component").select("print", "component_id"), "known")
    return found.join(known, "print").select(
        id_col, F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )

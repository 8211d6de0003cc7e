"""Near-duplicate documents by circulant MinHash.

Words are runs of anything but ASCII blanks, A-Z in lower case; a document's set
holds its distinct shingles of `shingle` words (one shingle of all its words if
it has fewer). Two permutations make the whole signature: sigma scatters the
shingles, and coordinate k is the smallest value of pi after a circular shift
by k. Bands of coordinates are bucket keys; documents that share a bucket are
compared on their full sets, and linked at `100 * intersection >= percent * union`.

At a similarity of 0.8, the defaults (52 bands of 7) miss a pair with a
probability of 5e-6.

How large groups are handled: documents with equal sets are one node. Each node
is first compared with one other node only, the smallest of the buckets that it
shares most often, so a group of near copies gives as many comparisons as it has
members. Linked nodes are then merged, and buckets with several components left
are compared across components: small ones pair by pair, large ones in blocks of
members against blocks. No bucket is cut off.

Every row gives a row. A text without words has n_shingles 0 and is linked with
nothing. `component_id` is the smallest id of the component; rows that share an
id are rows of their own. A null id takes no part in the minimum; a component of
null ids only has a null component_id, and each of its rows is kept.
"""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import begin, cached, slices, written

SMALL = 24        # members of a bucket that are paired as rows
BLOCK = 256       # members of a larger bucket in one block
BROADCAST = 1_000_000   # ids; 8 MB of them
_ONE, _TWO, _ODD = np.uint32(0x7FEB352D), np.uint32(0x846CA68B), np.uint64(0x9E3779B97F4A7C15)
_MEMO = 200_000
_words: dict[bytes, int] = {}
cached("tickline.llm.nearcopies", _words.clear)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and blanks only
    if len(_words) > _MEMO:
        _words.clear()
    for word in {*words}.difference(_words):
        _words[word] = xxhash.xxh3_64_intdigest(word)
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """The document's set, as sorted 64-bit hashes."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size))
    for k in range(size):
        total = _mixed(total * _ODD + words[k:len(words) - size + 1 + k])
    return np.unique(total)


def signature(members: np.ndarray, length: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the minimum of pi(sigma(x) - k mod 2^32).

    sigma folds the mixed hash to 32 bits; pi is a bijection of 32-bit numbers.
    """
    places = (_mixed(members * _ODD) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(length, dtype=np.uint32)[:, None]
    lowest = np.full(length, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(places), 512):
        x = places[None, start:start + 512] - shifts
        x ^= x >> np.uint32(16)
        x *= _ONE
        x ^= x >> np.uint32(15)
        x *= _TWO
        np.minimum(lowest, x.min(axis=1), out=lowest)
    return lowest


def band_keys(members: np.ndarray, bands: int, rows: int) -> np.ndarray:
    coordinates = signature(members, bands * rows).reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mixed(key * _ODD + coordinates[:, k])
    return key.astype(np.int64)


def node_of(members: np.ndarray) -> int:
    """One number for a set: equal sets get equal numbers."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes()))))


def sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Each row's id, set size, node (null without words) and band keys."""
    def run(batches):
        begin("tickline.llm.nearcopies")
        for batch in slices(batches, 1):
            sizes, nodes, keys = [], [], []
            for text in batch.column(1).to_pylist():
                members = shingles(text, shingle)
                sizes.append(len(members))
                nodes.append(node_of(members) if len(members) else None)
                keys.append(band_keys(members, bands, rows) if len(members) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "node", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, node long, keys array<long>")


def node_sets(docs: DataFrame, wanted: DataFrame, base: DataFrame, shingle: int) -> DataFrame:
    """The full sets of the wanted nodes, each read from one of its documents.

    The wanted rows are few beside all documents: their places are broadcast if
    there are at most `BROADCAST`, and joined by shuffle otherwise.
    """
    places = base.where("node is not null").join(wanted, "node", "left_semi") \
        .groupBy("node").agg(F.min("place").alias("place"))
    places = written(places, "near_places")
    if places.count() <= BROADCAST:
        places = F.broadcast(places)

    def run(batches):
        begin("tickline.llm.nearcopies")
        for batch in slices(batches, 1):
            packed = [shingles(t, shingle).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["node", "members"])

    return docs.join(places, "place").select("node", "text").mapInArrow(run, "node long, members binary")


def _shared(a: bytes, b: bytes) -> tuple[int, int]:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return both, len(x) + len(y) - both


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                both, union = _shared(x.as_buffer(), y.as_buffer())
                keep.append(100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("b"), F.col("members").alias("other"))
    both = pairs.join(left, "b").join(sets.select(F.col("node").alias("a"), "members"), "a")
    return both.select("a", "b", "other", "members").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b): its smallest reachable node.

    Each round gives a node the smallest label around it and then that label's
    own label, so the rounds grow with the logarithm of a path's length. Rounds
    are written to the shared folder; only the number of changes reaches the driver.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "near_edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component"))
                     .withColumnRenamed("a", "node"), "near_labels")
    for _ in itertools.count():
        around = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("low"))
        lower = labels.join(around, labels.node == around.a) \
            .select("node", "component", F.least("component", "low").alias("low"))
        ahead = labels.select(F.col("node").alias("low"), F.col("component").alias("jump"))
        after = written(lower.join(ahead, "low", "left")
                        .select("node", F.least("low", F.coalesce("jump", "low")).alias("component"),
                                (F.col("component") > F.least("low", F.coalesce("jump", "low"))).alias("changed")),
                        "near_labels")
        labels = after.drop("changed")
        if after.where("changed").isEmpty():
            return labels


def _comparable(percent: int):
    """Sets whose sizes differ too much can't be similar enough."""
    return (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components within large buckets, blocks of members against blocks.

    Sends each member's set once per block of its bucket; a task holds two
    blocks. It compares only nodes that nothing has joined yet, so it returns
    a spanning forest of the links it finds.
    """
    blocks = members.withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("node", "key"), "blocks").cast("int"))
    pairs = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                "block", "node", "component", "n").distinct().join(sets, "node")

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("n", "node", "component", "block", "members")), strict=True))
        root: dict[int, int] = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        found = []
        for i, (n, node, component, block, members) in enumerate(rows):
            for n2, node2, component2, block2, members2 in rows[i + 1:]:
                if 100 * n < percent * n2:
                    break
                if (same or block != block2) and find(component) != find(component2):
                    both, union = _shared(members, members2)
                    if 100 * both >= percent * union:
                        root[find(component)] = find(component2)
                        found.append((node, node2))
        return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return pairs.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")


def link(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80,
         bands: int = 52, rows: int = 7) -> DataFrame:
    """id, place (the row's own number), group (the component's own number, null
    without words), n_shingles, component_id and kept of every row of `df`.

    Rows are numbered by their place and read more than once, so `df` must be a
    table, or be written first (`common.written`).
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    docs = docs.withColumn("place", F.monotonically_increasing_id())
    base = written(sketches(docs.select(F.struct("id", "place").alias("id"), "text"), shingle, bands, rows)
                   .select("id.id", "id.place", "n", "node", "keys"), "near_base")
    nodes = base.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    entries = nodes.select("node", "n", F.explode("keys").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("count")).where("count > 1")
    members = written(entries.join(buckets, "key"), "near_members")

    # First: each node against the smallest node of the buckets it shares most often.
    sizes = members.select(F.col("node").alias("low"), F.col("n").alias("n2")).distinct()
    stars = (members.where("node <> low").groupBy("node", "low").agg(F.first("n").alias("n"), F.count("*").alias("times"))
             .join(sizes, "low").where(_comparable(percent))
             .groupBy("node").agg(F.max_by("low", F.struct("times", "low")).alias("low"))
             .select(F.col("low").alias("a"), F.col("node").alias("b")))
    stars = written(stars, "near_stars")
    wanted = members.select("node").distinct()
    sets = written(node_sets(docs, wanted, base, shingle), "near_sets")
    first = written(confirmed(stars, sets, percent), "near_links")

    # Then: what still lies in different components of one bucket.
    labels = components(first)
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = written(labelled.join(split.select("key"), "key", "left_semi"), "near_open")
    few = open_.where(F.col("count") <= SMALL)
    second = few.select("key", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("component").alias("component2"))
    pairs = (few.join(second, "key").where("node < node2 and component <> component2").where(_comparable(percent))
             .select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()
             .join(stars, ["a", "b"], "left_anti"))
    links = [first, confirmed(pairs, sets, percent)]
    if not (many := open_.where(F.col("count") > SMALL)).isEmpty():
        links.append(block_links(many, sets, percent))
    final = components(written(reduce(DataFrame.union, links), "near_links"))

    rows_ = base.select("id", "place", "n", "node").join(final, "node", "left") \
        .withColumn("group", F.coalesce(F.col("component"), F.col("node")))
    # Written first: joined straight from its aggregate, a large group could not be split among tasks.
    lowest = written(rows_.where("group is not null").groupBy("group").agg(F.min("id").alias("lowest")), "near_lowest")
    return (rows_.join(lowest, "group", "left")
            .select("id", "place", "group", F.col("n").alias("n_shingles"),
                    F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("lowest")).alias("component_id"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))

"""Merkle manifest of a table: one tree per group, and one over the groups' roots.

A leaf is the hash of a row's fields. In each group the leaves ascend by id, and
while several nodes remain every `FAN` consecutive ones (the last run: fewer,
even one) are hashed to their parent. The groups' roots, ascending by group
(null first), give the table's root in the same way.

Checkpoint and recompute: only every third level is stored (`levels`). The nodes of
a stored level fall into aligned subtrees of FAN ** levels; a task holds one
subtree at a time. Building it gives one node of the next stored level. For
proofs its missing interior nodes are computed again from the stored ones below,
the siblings of every node on its way up are emitted, and the nodes are dropped.
What lies above a subtree comes from the next stored level as one row that goes
before the subtree's own.

Rows of any group and with any ids spread evenly: they are numbered by range, with
a tie-break by leaf and place, so that a group, an id or one repeated row may hold
most of the table. Repeated ids stand in the order of their leaves. Null ids come
first; null fields have a mark of their own in the leaf. An empty table has no
rows and the root None. Columns that clash with those made here do no harm, as
only the named ones are read; `carry` may name no column that is made here.
Long texts are hashed by Spark's own function, one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.common import written

FAN = 16
LEVELS = 3  # from one stored level to the next
PART_ROWS = 1 << 16

_STEP = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])
PATH = T.ArrayType(_STEP)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Hash of the fields in order: `-` for null, else byte count, colon, value."""
    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def _parent(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels_up(nodes: list[str], total: int, most: int) -> list[list[str]]:
    """A subtree's levels from its stored nodes up: `most`, or as far as its tree of `total` nodes goes on."""
    levels = [nodes]
    while total > 1 and len(levels) <= most:
        below = levels[-1]
        levels.append([_parent(below[i:i + FAN]) for i in range(0, len(below), FAN)])
        total = -(-total // FAN)
    return levels


def _numbered(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """`df` with `index`, its place in its group by `order`, and `total`, the group's rows; written."""
    n = max(1, -(-df.count() // PART_ROWS))
    place = F.monotonically_increasing_id()
    spread = df.withColumn("__salt", place).repartitionByRange(n, group, *order, "__salt")
    # After the sort the id counts a part's rows in order; its upper bits are the part.
    sorted_ = written(spread.drop("__salt").sortWithinPartitions(group, *order).withColumn("__place", place)
                      .withColumn("__part", F.shiftright("__place", 33)), name)
    runs = sorted_.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__at")).agg(
        F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n"))
    totals = runs.groupBy(F.col("__group").alias("__of")).agg(F.sum("__n").alias("total"))
    up_to = Window.partitionBy("__group").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    before = (F.sum("__n").over(up_to) - F.col("__n")).alias("__before")
    starts = runs.select("*", before).join(totals, F.col("__group").eqNullSafe(F.col("__of")))
    return (sorted_.join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__at")))
            .withColumn("index", F.col("__place") - F.col("__first") + F.col("__before"))
            .drop("__place", "__part", "__group", "__at", "__first", "__n", "__of", "__before"))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cut sorted rows into one table per (group, block), holding one at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        groups, blocks = batch["group"].to_pylist(), batch["block"].to_pylist()
        start = 0
        for i in range(batch.num_rows):
            if (now := (groups[i], blocks[i])) != key:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, key = [], i, now
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _by_subtree(rows: DataFrame, most: int, *order: str) -> DataFrame:
    """The rows of every aligned subtree side by side and in order."""
    return (rows.withColumn("block", F.expr(f"index div {FAN ** most}"))
            .repartition("group", "block").sortWithinPartitions("group", "block", *order))


def _climb(nodes: DataFrame, most: int) -> DataFrame:
    """(group, index, hash, total) of a stored level to the same of the next one, or of the roots."""
    kind = nodes.schema["group"].dataType

    def run(batches):
        for subtree in _subtrees(batches):
            total = subtree["total"][0].as_py()
            top = _levels_up(subtree["hash"].to_pylist(), total, most)
            height = len(top) - 1
            yield pa.RecordBatch.from_arrays(
                [subtree["group"].combine_chunks()[:1], subtree["block"].combine_chunks()[:1], pa.array(top[-1], pa.string()),
                 pa.array([-(-total // FAN ** height)], pa.int64())], names=["group", "index", "hash", "total"])

    schema = T.StructType([T.StructField("group", kind), T.StructField("index", T.LongType()),
                           T.StructField("hash", T.StringType()), T.StructField("total", T.LongType())])
    return _by_subtree(nodes.select("group", "index", "hash", "total"), most, "index").mapInArrow(run, schema)


@dataclass
class Forest:
    """Stored levels of the trees of all groups, `most` apart, and the roots (group, hash)."""

    levels: list[DataFrame]
    roots: DataFrame
    most: int


@dataclass
class Manifest:
    """The groups' trees, the tree over their roots, and the table's root."""

    groups: Forest
    top: Forest
    root: str | None
    carry: list[str] = field(default_factory=list)


def _grow(leaves: DataFrame, most: int, name: str) -> Forest:
    """Trees above (group, index, hash, total, ...)."""
    levels, done = [leaves], []
    while True:
        above = written(_climb(levels[-1], most), f"{name}_{len(levels)}")
        done.append(above.where("total = 1").select("group", "hash"))
        rest = above.where("total > 1")
        if rest.isEmpty():
            break
        levels.append(rest)
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    return Forest(levels, roots, most)


def build(df: DataFrame, fields: Sequence[str], id_col: str = "doc_id", group_col: str = "source",
          carry: Sequence[Column] = (), levels: int = LEVELS) -> Manifest:
    """The manifest of `df`; `carry` adds named columns that go along with the leaves.

    One in `levels` levels is stored; a task holds FAN ** levels nodes.
    """
    leaves = written(df.select(F.col(f"`{group_col}`").alias("group"), F.col(f"`{id_col}`").alias("id"),
                               leaf_hash([F.col(f"`{f}`") for f in fields]).alias("hash"), *carry), "merkle_leaves")
    names = [c for c in leaves.columns if c not in ("group", "id", "hash")]
    groups = _grow(_numbered(leaves, "group", ["id", "hash"], "merkle_level"), levels, "merkle_level")
    tops = groups.roots.select(F.lit(0).alias("group"), F.col("group").alias("of"), "hash")
    top = _grow(_numbered(tops, "group", ["of"], "merkle_top"), levels, "merkle_top")
    first = top.roots.first()
    return Manifest(groups, top, first.hash if first else None, names)


def _paths(nodes: DataFrame, above: DataFrame, keep: Sequence[str], most: int) -> DataFrame:
    """Every node of a stored level with its path to the root.

    `above` has one row (group, block, subroot, path) for each subtree: the way
    of its topmost node. Result: group, index, hash, `keep`, subroot, path.
    """
    fields = [nodes.schema[c] for c in keep]
    out = T.StructType([nodes.schema["group"], T.StructField("index", T.LongType()),
                        T.StructField("hash", T.StringType()), *fields,
                        T.StructField("subroot", T.StringType()), T.StructField("path", PATH)])
    heads = above.select("group", (F.col("block") * FAN ** most).alias("index"), F.lit(0).alias("__kind"),
                         "subroot", "path")
    rows = (nodes.select("group", "index", F.lit(1).alias("__kind"), "hash", "total", *keep)
            .unionByName(heads, allowMissingColumns=True))

    def run(batches):
        for subtree in _subtrees(batches):
            rest = list(zip(*[[s[side] for s in subtree["path"][0].as_py()] for side in ("left", "right")], strict=True))
            own, subroot = subtree.slice(1), subtree["subroot"][0].as_py()
            if not own.num_rows:  # a smaller group, not stored on this level
                continue
            levels = _levels_up(own["hash"].to_pylist(), own["total"][0].as_py(), most)
            # From the top down: the way of a node is its siblings, then its parent's way.
            ways: list[list[tuple[str, str]]] = [rest] * len(levels[-1])
            for nodes_ in reversed(levels[:-1]):
                found = []
                for i in range(0, len(nodes_), FAN):
                    run_, way = nodes_[i:i + FAN], ways[i // FAN]
                    joined = "".join(run_)
                    found += [[(joined[:64 * k], joined[64 * (k + 1):]), *way] for k in range(len(run_))]
                ways = found
            flat = [step for way in ways for step in way]
            ends = [0]
            for way in ways:
                ends.append(ends[-1] + len(way))
            steps = pa.StructArray.from_arrays(
                [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())], names=["left", "right"])
            paths = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
            columns = [own[c].combine_chunks() for c in ("group", "index", "hash", *keep)]
            made = pa.RecordBatch.from_arrays([*columns, pa.array([subroot] * own.num_rows, pa.string()), paths],
                                              names=["group", "index", "hash", *keep, "subroot", "path"])
            for start in range(0, made.num_rows, 512):
                yield made.slice(start, 512)

    return _by_subtree(rows, most, "__kind", "index").mapInArrow(run, out)


def _all_paths(forest: Forest, roots: DataFrame, keep: Sequence[str], name: str) -> DataFrame:
    """Paths of all leaves; `roots` has (group, subroot, path) from each group's root on."""
    known: DataFrame | None = None
    for k in range(len(forest.levels) - 1, -1, -1):
        nodes = forest.levels[k]
        if known is None:
            above = roots.select("group", F.lit(0).cast("long").alias("block"), "subroot", "path")
        else:
            # Groups that end at this level come from the roots, larger ones from the level above.
            larger = known.select(F.col("group").alias("__group")).distinct()
            ending = roots.join(larger, F.col("group").eqNullSafe(F.col("__group")), "left_anti")
            above = (ending.select("group", F.lit(0).cast("long").alias("block"), "subroot", "path")
                     .unionByName(known.select("group", F.col("index").alias("block"), "subroot", "path")))
        if k:
            known = written(_paths(nodes, above, [], forest.most), f"{name}_{k}")
    return _paths(forest.levels[0], above, keep, forest.most)


def prove(manifest: Manifest) -> DataFrame:
    """A proof for every row: group, id, leaf, carried columns, subroot, root, path.

    `path` has one (left, right) per level up to the table's root: the digests
    of the run's other nodes before and after the own one, joined.
    """
    top = manifest.top.roots.select("group", F.col("hash").alias("subroot"), F.array().cast(PATH).alias("path"))
    tops = written(_all_paths(manifest.top, top, ["of"], "merkle_top_paths"), "merkle_top_proofs")
    roots = tops.select(F.col("of").alias("group"), F.col("hash").alias("subroot"), "path")
    proofs = _all_paths(manifest.groups, roots, ["id", *manifest.carry], "merkle_paths")
    root = F.lit(manifest.root).cast("string").alias("root")
    return proofs.select("group", "id", F.col("hash").alias("leaf"), *manifest.carry, "subroot", root, "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)

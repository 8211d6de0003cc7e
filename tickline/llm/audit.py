"""Audit of how document filters interact, kept up to date by a stream with retractions.

Five filters judge a whole text (null: empty): A few words, B few distinct words,
C many capitals, D code characters, E the same text under a smaller id. A
document's failures are a mask of five bits; all figures of the report follow
from the number of documents (and of good and toxic ones) per part and mask.

`counters` streams the files of a table in available-now micro-batches. A to D
depend on the text alone. For E the state holds, per text, the smallest id so
far and the rows that have it. When a smaller id arrives, the earlier holders'
masks are retracted from their parts' counters and enter again with E; each
micro-batch adds its changes to the counters as one file set named by its id,
so a retry adds nothing twice. State and progress are in the shared folder.

Copies are collapsed before the state, in the map tasks and again by (text,
salt): of a text's rows only those with the smallest id are kept apart, the
others are counted by part. So a text that a third of all rows share costs its
state task a few rows. State keys are buckets of about `bucket_rows` rows,
numbered from the table's row count, as a key costs more than a row.

Rows without an id fail no E and make none fail; rows that repeat id and text
are each counted, and do not fail E through each other. A document is good
(toxic) if any of its label rows says so. A null part is the empty string. An
empty table has no rows. Only the named columns are read, so others may clash.
Very long texts are judged row by row inside Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm.common import shared_dir, written
from tickline.session import ROCKSDB
from tickline.sinks import write_batch_idempotent

FILTERS = "ABCDE"
_SAME = 1 << FILTERS.index("E")
_HELD_ROWS = 1 << 17
_SALTS = 32
_DELTA = "part string, mask int, n long, good long, toxic long"
# State off the heap, and no disk set aside ahead for each of many small stores.
_STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
          "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def text_mask(text: Column) -> Column:
    """Failures of A to D as bits 0 to 3."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [F.size(words) < 50, 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
             100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((fail.cast("int") * (1 << i) for i, fail in enumerate(fails)), F.lit(0))


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fewer rows of the same meaning: a text's rows that a smaller id here beats
    fail E for good, lose their id and are counted by part."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def fewer() -> pa.Table:
        table = pa.Table.from_batches(held)
        keys = table["text"].combine_chunks().dictionary_encode()
        table = table.append_column("key", keys.indices)
        least = table.group_by("key").aggregate([("id", "min")])
        order = pc.sort_indices(least["key"])  # the keys are 0, 1, ..., so a key is its own place
        smallest = least["id_min"].take(order).take(table["key"])
        beaten = pc.fill_null(pc.greater(table["id"], smallest), False)
        masks = pc.if_else(beaten, pc.bit_wise_or(table["mask"], pa.scalar(_SAME, pa.int32())), table["mask"])
        ids = pc.if_else(beaten, pa.scalar(None, table.schema.field("id").type), table["id"])
        names = ["text", "id", "part", "mask", "good", "toxic"]
        marked = table.set_column(table.schema.get_field_index("mask"), "mask", masks) \
            .set_column(table.schema.get_field_index("id"), "id", ids)
        counted = marked.group_by(names).aggregate([("n", "sum")]).rename_columns([*names, "n"])
        return counted.select(held[0].schema.names).cast(held[0].schema)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= _HELD_ROWS:
            table = fewer()
            if table.num_rows > _HELD_ROWS // 2:  # mostly different texts: pass them on
                yield from table.to_batches(max_chunksize=10_000)
                held, rows = [], 0
            else:
                held, rows = table.combine_chunks().to_batches(), table.num_rows
    if held:
        yield from fewer().to_batches(max_chunksize=10_000)


def _bucket_update(number: bool):
    """The state function: rows of one bucket of texts to changes of the counters."""
    value = int if number else str

    def update(key, frames, state):
        known: dict[str, list] = json.loads(state.get[0]) if state.exists else {}
        change: dict[tuple[str, int], list[int]] = {}

        def add(part, mask, n, good, toxic):
            cell = change.setdefault((part, mask), [0, 0, 0])
            cell[0] += n
            cell[1] += n * good
            cell[2] += n * toxic

        for frame in frames:
            for text, id_, part, mask, good, toxic, n in zip(
                    *(frame[c].tolist() for c in ("text", "id", "part", "mask", "good", "toxic", "n")), strict=True):
                if id_ is None:
                    add(part, mask, n, good, toxic)
                    continue
                id_ = value(id_)
                holder = known.get(text)
                if holder is None or id_ < holder[0]:
                    for earlier in holder[1] if holder else ():
                        add(earlier[0], mask, -earlier[3], earlier[1], earlier[2])
                        add(earlier[0], mask | _SAME, earlier[3], earlier[1], earlier[2])
                    known[text] = [id_, [[part, good, toxic, n]]]
                    add(part, mask, n, good, toxic)
                elif id_ == holder[0]:
                    mine = next((h for h in holder[1] if h[:3] == [part, good, toxic]), None)
                    if mine:
                        mine[3] += n
                    else:
                        holder[1].append([part, good, toxic, n])
                    add(part, mask, n, good, toxic)
                else:
                    add(part, mask | _SAME, n, good, toxic)
        state.update((json.dumps(known),))
        rows = [(part, mask, *cell) for (part, mask), cell in change.items() if any(cell)]
        yield pd.DataFrame(rows, columns=["part", "mask", "n", "good", "toxic"])

    return update


def counters(spark: SparkSession, path: str, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id",
             text_col: str = "text", batches: int = 4, bucket_rows: int = 512) -> DataFrame:
    """(part, mask, n, good, toxic) over all files of the Parquet table at `path`.

    `labels` has the id and quality and toxic, 1 if the document is so. The
    files go in `batches` micro-batches of as many files each.
    """
    stored = spark.read.parquet(path)
    names = [f.rsplit("/", 1)[-1] for f in stored.inputFiles()]
    files = max(1, -(-len(names) // batches))
    path = path.rstrip("/")
    if names == [path.rsplit("/", 1)[-1]]:  # a stream takes a single file only as a pattern
        path = f"{path[:-1]}[{path[-1]}]"
    buckets = max(1, stored.count() // bucket_rows)
    number = stored.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")

    said = written(labels.groupBy(F.col(id_col).cast("string").alias("__of")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .where("__of IS NOT NULL").withColumn("__known", F.lit(True)), "audit_labels")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    arrived = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", files).parquet(path)
    judged = arrived.select(
        F.unhex(F.sha2(text, 256)).alias("text"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text_mask(text).alias("mask"))
    # Rows without an id find no label; they are spread over the join by their text.
    keyed = judged.withColumn("__key", F.coalesce(F.col("id").cast("string"), F.hex("text")))
    labelled = keyed.join(said, (F.col("__key") == F.col("__of")) & (F.col("id").isNotNull() == F.col("__known")), "left") \
        .select("text", "id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                F.coalesce("toxic", F.lit(0)).alias("toxic"), F.lit(1).cast("long").alias("n"))
    schema = labelled.schema
    salted = labelled.mapInArrow(collapse, schema).withColumn("__salt", F.spark_partition_id() % _SALTS)
    few = salted.repartition("text", "__salt").drop("__salt").mapInArrow(collapse, schema)
    bucketed = few.select(F.pmod(F.xxhash64("text"), F.lit(buckets)).alias("bucket"), F.hex("text").alias("text"),
                          F.col("id").cast("string").alias("id"), "part", "mask", "good", "toxic", "n")
    changes = bucketed.groupBy("bucket").applyInPandasWithState(
        _bucket_update(number), _DELTA, "known string", "append", "NoTimeout")

    root = shared_dir(spark, "audit")
    none = spark.createDataFrame([], _DELTA)
    write_batch_idempotent(none, f"{root}/counters", -1)

    def add(batch: DataFrame, batch_id: int) -> None:
        totals = batch.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
        write_batch_idempotent(totals, f"{root}/counters", batch_id)

    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        query = (changes.writeStream.foreachBatch(add).outputMode("append")
                 .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return (spark.read.schema(none.schema).parquet(f"{root}/counters").groupBy("part", "mask")
            .agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]))


def _rules() -> list[tuple]:
    """For each order, step and mask, what a document of that mask counts as there."""
    made = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[i] for i in order)
        for step, own in enumerate(order, 1):
            earlier = sum(1 << i for i in order[:step - 1])
            for mask in range(1 << len(FILTERS)):
                fails, gone = mask >> own & 1, bool(mask & earlier)
                # Of the orders, in which all failing filters come first equally often, those that begin with the own one.
                share = 120 // mask.bit_count() if fails else 0
                made.append((mask, name, step, int(not gone and not fails), int(not gone and fails), int(gone and fails),
                             int(mask == 1 << own), share))
    return made


def report(counted: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counters."""
    rules = counted.sparkSession.createDataFrame(
        _rules(), "mask int, filter_order string, step int, __kept int, __removed int, __redundant int, __only int, __share int")
    # The rules are 19,200 rows of fixed size.
    joined = counted.join(F.broadcast(rules), "mask")
    total = lambda weight, of="n": F.sum(F.col(of) * F.col(weight)).alias(weight[2:])
    return joined.groupBy("part", "filter_order", "step").agg(
        total("__kept"), total("__removed"), total("__redundant"), total("__only").alias("unique_fails"),
        total("__removed", "good").alias("good_lost"), total("__removed", "toxic").alias("toxic_lost"),
        total("__share").alias("shapley"))

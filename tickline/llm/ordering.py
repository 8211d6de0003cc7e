"""Training-order materialisation: a keyed permutation of all sequences, as fixed-stride shards.

Each document's ids and an end id are cut into sequences of `length` ids, the
last one filled up with zeros (`used` tells how many are its own). Sequences are numbered 0..n-1, and a keyed
Feistel network permutes the numbers: it permutes the next power of four, and
numbers that land beyond n walk along their cycle until they are back inside.
So a sequence's slot follows from its number and the key alone: no sort, no
table of slots.

Slots are written in ranges: shard s holds the slots from s * shard_slots on, a
record of `stride` bytes for each, so slot and byte position follow from one
another. Reading begins at any slot and runs on sequentially. A shard is
written under a temporary name and then renamed; its content is the same in
every attempt, so repeated tasks do no harm. Shards are written in passes over the table
of ids, each for a range of them, so only a part of the sequences lies in shuffle
files at a time.

Numbers follow the rows' order in the table of ids, which is written first:
the order is settled there, and retries cannot change it.

Null and empty texts are one sequence, of one end id. Repeated rows and null ids
are rows of their own.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.bytepairs import load
from tickline.llm.common import CHUNK_BYTES, map_texts, shared_dir, slices, written
from tickline.llm.warc import file_system

HEAD = np.dtype([("document", "<i8"), ("part", "<i4"), ("used", "<i4")])  # before the ids of each record
_NULL = -(1 << 63)


def _round(half: np.ndarray, key: int, number: int, bits: int) -> np.ndarray:
    x = half + np.uint64((key + 0x9E3779B97F4A7C15 * (number + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64((1 << bits) - 1)


def _bits(n: int) -> int:
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def slot_of(numbers: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The slots of sequence numbers below n."""
    bits = _bits(n)
    slots = np.array(numbers, np.uint64)
    walking = np.arange(len(slots))
    while len(walking):
        left, right = slots[walking] >> np.uint64(bits), slots[walking] & np.uint64((1 << bits) - 1)
        for number in range(rounds):
            left, right = right, left ^ _round(right, key, number, bits)
        slots[walking] = left << np.uint64(bits) | right
        walking = walking[slots[walking] >= n]
    return slots.astype(np.int64)


def number_of(slots: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The sequence numbers at slots below n: the rounds backwards."""
    bits = _bits(n)
    numbers = np.array(slots, np.uint64)
    walking = np.arange(len(numbers))
    while len(walking):
        left, right = numbers[walking] >> np.uint64(bits), numbers[walking] & np.uint64((1 << bits) - 1)
        for number in reversed(range(rounds)):
            left, right = right ^ _round(left, key, number, bits), left
        numbers[walking] = left << np.uint64(bits) | right
        walking = walking[numbers[walking] >= n]
    return numbers.astype(np.int64)


def coded(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, the number of its ids with an end id, and those as packed uint16; a written table."""
    def make():
        vocabulary = load(vocabulary_path)
        end = np.array([vocabulary.end], "<u2").tobytes()

        def code(texts):
            packed = [vocabulary.ids(t or "") + end for t in texts]
            return [len(p) // 2 for p in packed], packed
        return code

    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("document"), F.col(f"`{text_col}`").cast("string").alias("text"))
    results = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("ids", T.BinaryType())])
    made = map_texts(slim, "text", results, make).select("document", "n", "ids")
    path = shared_dir(df.sparkSession, "order_ids")
    made.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path)


def write(ids: DataFrame, key: int, length: int = 256, shard_slots: int = 1 << 15,
          folder: str | None = None, passes: int = 2) -> tuple[str, int]:
    """Write the shards and a manifest; returns the folder and the number of sequences.

    Only one number per input partition reaches the driver (where its sequences
    begin). Sequences move once, in the pass of the shard that their slots are in; those
    of some neighbouring documents that go to one shard travel together, compressed.
    """
    spark = ids.sparkSession
    folder = folder or shared_dir(spark, "shards")
    rows = ids.select("document", "n", "ids", F.monotonically_increasing_id().alias("place"))
    spans, n = {}, 0
    parts = F.sum(F.ceil(F.col("n") / length))
    for partition, count in sorted(rows.groupBy(F.shiftright("place", 33).alias("p")).agg(parts).collect()):
        spans[partition] = n, n + count
        n += count
    where = spark.sparkContext.broadcast(spans)
    entry = np.dtype([("at", "<i4"), *HEAD.descr])

    def cut(first, last):
        def run(batches):
            partition = held = None
            squeeze = zstandard.ZstdCompressor(level=3).compress
            for batch in slices(batches, 2, 2 * CHUNK_BYTES):
                if held is None:
                    partition = batch.column(3)[0].as_py() >> 33
                    held = where.value[partition][0]
                sizes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                counts = -(-sizes // length)
                row = np.repeat(np.arange(len(sizes)), counts)
                part = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                slots = slot_of(np.arange(held, held + len(row)), n, key)
                held += len(row)
                shard = slots // shard_slots
                order = np.argsort(shard, kind="stable")
                order = order[np.searchsorted(shard[order], first):np.searchsorted(shard[order], last)]
                used = np.minimum(length, sizes[row] - part * length)
                matrix = np.zeros((len(row), length), "<u2")
                matrix[np.arange(length) < used[:, None]] = np.frombuffer(b"".join(x.as_buffer() for x in batch.column(2)), "<u2")
                heads = np.zeros(len(row), entry)
                heads["at"], heads["part"], heads["used"] = slots % shard_slots, part, used
                heads["document"] = pa.compute.fill_null(batch.column(0), _NULL).to_numpy(zero_copy_only=False)[row]
                found, starts = np.unique(shard[order], return_index=True)
                groups = np.split(order, starts[1:]) if len(order) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int32()), pa.array([squeeze(heads[g].tobytes()) for g in groups], pa.binary()),
                     pa.array([squeeze(matrix[g].tobytes()) for g in groups], pa.binary())],
                    names=["shard", "heads", "ids"])
            if held is not None and held != where.value[partition][1]:
                raise ValueError(f"partition {partition} of the table of ids is not the one that was counted")
        return run

    record = np.dtype([*HEAD.descr, ("ids", "<u2", (length,))])
    shards = max(1, math.ceil(n / shard_slots))

    def store(batches):
        out, filled = None, 0
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for shard, *packed in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if out is None:
                    number, out = shard, np.zeros(min(shard_slots, n - shard * shard_slots), record)
                heads, tokens = map(unpack, packed)
                heads = np.frombuffer(heads, entry)
                for name in HEAD.names:
                    out[name][heads["at"]] = heads[name]
                out["ids"][heads["at"]] = np.frombuffer(tokens, "<u2").reshape(-1, length)
                filled += len(heads)
        if out is not None:
            if filled != len(out):
                raise ValueError(f"shard {number} has {filled} of {len(out)} sequences")
            filesystem, root = file_system(folder)
            filesystem.create_dir(root, recursive=True)
            name, new = f"{root}/shard-{number:07d}.bin", f"{root}/.{uuid.uuid4().hex}"
            with filesystem.open_output_stream(new) as stream:
                stream.write(out.tobytes())
            filesystem.move(new, name)
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([len(out)], pa.int64())],
                                             names=["shard", "sequences"])

    bounds = sorted({shards * k // passes for k in range(passes + 1)})
    written_shards = written_sequences = 0
    for first, last in itertools.pairwise(bounds):
        moved = rows.mapInArrow(cut(first, last), "shard int, heads binary, ids binary")
        # One task per shard, whatever the default number of partitions.
        dealt = moved.repartitionById(last - first, F.col("shard") - first)
        stored = written(dealt.mapInArrow(store, "shard long, sequences long"), "order_shards", clean=True)
        done = stored.agg(F.count("*"), F.coalesce(F.sum("sequences"), F.lit(0))).first()
        written_shards, written_sequences = written_shards + done[0], written_sequences + done[1]
    if n and (written_shards, written_sequences) != (shards, n):
        raise ValueError(f"{written_sequences} of {n} sequences written")
    filesystem, root = file_system(folder)
    filesystem.create_dir(root, recursive=True)
    with filesystem.open_output_stream(f"{root}/manifest.json") as stream:
        stream.write(json.dumps({"sequences": n, "length": length, "stride": record.itemsize,
                                 "shard_slots": shard_slots, "key": key}).encode())
    return folder, n


def manifest(folder: str) -> dict:
    filesystem, root = file_system(folder)
    with filesystem.open_input_file(f"{root}/manifest.json") as file:
        return json.loads(file.read())


def stream(folder: str, start: int = 0, stop: int | None = None, block: int = 4096):
    """Records by slot, from `start` on: arrays of at most `block` records, read in sequence."""
    info = manifest(folder)
    record = np.dtype([*HEAD.descr, ("ids", "<u2", (info["length"],))])
    filesystem, root = file_system(folder)
    stop = info["sequences"] if stop is None else min(stop, info["sequences"])
    while start < stop:
        shard, at = divmod(start, info["shard_slots"])
        here = min(stop, (shard + 1) * info["shard_slots"])
        with filesystem.open_input_file(f"{root}/shard-{shard:07d}.bin") as file:
            while start < here:
                count = min(block, here - start)
                data = file.read_at(count * info["stride"], at * info["stride"])
                yield start, np.frombuffer(data, record)
                start, at = start + count, at + count


def _by_shard(spark, folder: str, start: int, schema: str, name: str, make) -> DataFrame:
    """slot, document, part, used and one column that `make()` gives a task the function for,
    from records; one task per shard."""
    info = manifest(folder)
    n, slots = info["sequences"], info["shard_slots"]
    first = start // slots
    shards = spark.range(first, max(first, math.ceil(n / slots)), 1, max(1, math.ceil(n / slots) - first))

    def run(batches):
        function = make()
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                for at, records in stream(folder, max(start, shard * slots), min(n, (shard + 1) * slots)):
                    document = np.ascontiguousarray(records["document"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(at, at + len(records))), pa.array(document, mask=document == _NULL),
                         pa.array(np.ascontiguousarray(records["part"])), pa.array(np.ascontiguousarray(records["used"])),
                         function(records)],
                        names=["slot", "document", "part", "used", name])

    return shards.mapInArrow(run, f"slot long, document long, part int, used int, {name} {schema}")


def read(spark, folder: str, start: int = 0) -> DataFrame:
    """slot, document, part, used (ids that are the document's own) and ids of the
    records from slot `start` on; one task per shard."""
    def lists(records):
        width = records["ids"].shape[1]
        values = pa.array(np.ascontiguousarray(records["ids"]).reshape(-1).astype(np.int32))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(records) + 1, dtype=np.int32) * width), values)

    return _by_shard(spark, folder, start, "array<int>", "ids", lambda: lists)


def digests(spark, folder: str, start: int = 0) -> DataFrame:
    """As `read`, with the hex sha256 of a record's own ids, in decimal and joined by a space, for them."""
    def make():
        decimals = np.array([b"%d " % k for k in range(1 << 16)])  # filled up with zero bytes

        def hashed(records):
            rows = zip(decimals[records["ids"]], records["used"].tolist(), strict=True)
            return pa.array([hashlib.sha256(row[:used].tobytes().translate(None, b"\0")[:-1]).hexdigest() for row, used in rows], pa.string())
        return hashed

    return _by_shard(spark, folder, start, "string", "ids_sha256", make)

"""Exact top-k search by inner product over a bit-sliced index.

Components are scaled to integers, floor(scale * x). A block of rows keeps the
components, less the block's minimum and without their `dropped` lowest bits,
as bitmaps: slice b of attribute d has bit b of every row's value. A query's
score of all rows comes from bitmap arithmetic alone. Each weight is written in
signed binary digits, every digit sends the attribute's slices (or their
complements, for a minus) to the columns of their powers of two, and each
column is added up, three bitmaps to two, into one result slice per power. From
the most significant slice downward, rows are counted until the coarse score of
the k-th best is known. Rows whose coarse score is so near it that the dropped
bits could matter are then scored exactly.

Blocks hold at most `block_rows` rows and give k rows per query; the k best of
those are the result. The queries are written once and cut by their place into
passes of at most `pass_queries` (broadcast: a bounded size, also where rows
repeat), each against all blocks. A pass's result is written and its broadcast
dropped before the next pass begins; there is no cross join.

Vectors that are null, or hold null or non-finite components, and rows with a
null id take no part; nor do empty vectors. Only vectors of the query's length
are scored. A query's own id is no candidate. Rows that share an id are rows of
their own, as queries and as candidates; equal scores go to the smaller id.
Scores are computed in 64 bits; values that could exceed them raise an error.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickline.llm.common import written

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def scaled(column: pa.Array, scale: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """The usable vectors of a list column by length: (row numbers, integer matrix)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.array(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    values = column.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    flat[np.array(values.is_null())] = np.nan
    ends = np.cumsum(lengths)
    found = []
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        with np.errstate(over="ignore"):
            matrix = np.floor(scale * flat[(ends[rows] - n)[:, None] + np.arange(n)])
        good = np.isfinite(matrix).all(axis=1)
        rows, matrix = rows[good], matrix[good]
        if len(rows):
            if np.abs(matrix).max() ** 2 * n >= 2.0 ** 62:
                raise ArithmeticError("scores could exceed 64 bits")
            found.append((rows, matrix.astype(np.int64)))
    return found


def signed_digits(weight: int) -> list[tuple[int, bool]]:
    """(power of two, is minus) of a number, no two neighbouring powers: the fewest digits."""
    digits, power, rest = [], 0, abs(weight)
    while rest:
        if rest & 1:
            minus = rest & 3 == 3
            digits.append((power, minus != (weight < 0)))
            rest += 1 if minus else -1
        rest >>= 1
        power += 1
    return digits


class Slices:
    """The index of one block: bitmaps of all attributes, and the rows' exact values."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, dropped: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values, self.dropped = ids[order], values[order], dropped
        self.low = values.min(axis=0)
        coarse = (self.values - self.low) >> dropped
        self.bits = max(1, int(coarse.max()).bit_length())
        self.rows, self.words = len(ids), -(-len(ids) // 64)
        padded = np.zeros((coarse.shape[1], self.words * 64), np.int64)
        padded[:, :self.rows] = coarse.T
        self.slices = np.stack([
            np.packbits((padded >> b & 1).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)
            for b in range(self.bits)], axis=1)
        self.present = np.packbits(np.arange(self.words * 64) < self.rows, bitorder="little").view(np.uint64)

    def coarse_scores(self, query: np.ndarray) -> np.ndarray:
        """Slices, the least significant first, of sum(query * coarse) plus a constant."""
        columns: dict[int, list[tuple[int, int, bool]]] = {}
        for d, weight in enumerate(query.tolist()):
            for power, minus in signed_digits(weight):
                for b in range(self.bits):
                    columns.setdefault(power + b, []).append((d, b, minus))
        result, carried, power = [], [], 0
        last = max(columns, default=-1)
        while power <= last or carried:
            stack = carried
            if power in columns:
                d, b, minus = map(np.array, zip(*columns[power], strict=True))
                stack = [*stack, self.slices[d, b] ^ np.where(minus, _ALL, np.uint64(0))[:, None]]
            now = np.concatenate(stack) if stack else np.zeros((0, self.words), np.uint64)
            carried = []
            while len(now) > 1:  # full adders on a third of the column each, then one half adder
                n = max(1, len(now) // 3)
                if len(now) == 2:
                    carried.append(now[:1] & now[1:])
                    now = now[:1] ^ now[1:]
                    continue
                x, y, z, rest = now[:n], now[n:2 * n], now[2 * n:3 * n], now[3 * n:]
                half = x ^ y
                carried.append(x & y | half & z)
                now = np.concatenate([half ^ z, rest])
            result.append(now[0] if len(now) else np.zeros(self.words, np.uint64))
            power += 1
        return np.array(result).reshape(-1, self.words)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the block's k best rows."""
        scores = self.coarse_scores(query)
        open_ = self.present.copy()
        for row in range(*np.searchsorted(self.ids, [own, own + 1])):
            open_[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        able = open_.copy()
        # The k-th best coarse score, bit by bit from the top.
        need, kth = k, 0
        for power in range(len(scores) - 1, -1, -1):
            ones = open_ & scores[power]
            count = int(np.bitwise_count(ones).sum())
            if count >= need:
                open_, kth = ones, kth | 1 << power
            else:
                need -= count
                open_ &= ~scores[power]
        # A dropped part moves a score by less than 2^dropped - 1 per unit of weight, both ways together.
        slack = int(np.abs(query).sum()) * ((1 << self.dropped) - 1)
        least = max(0, kth - -(-slack // (1 << self.dropped)))
        if int(np.bitwise_count(able).sum()) > k:
            able &= self._at_least(scores, least)
        rows = np.flatnonzero(np.unpackbits(able.view(np.uint8), bitorder="little"))
        exact = self.values[rows] @ query
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows][best], exact[best]

    def _at_least(self, scores: np.ndarray, bound: int) -> np.ndarray:
        if bound >> len(scores):
            return np.zeros(self.words, np.uint64)
        equal, above = np.full(self.words, _ALL), np.zeros(self.words, np.uint64)
        for power in range(len(scores) - 1, -1, -1):
            if bound >> power & 1:
                equal = equal & scores[power]
            else:
                above = above | equal & scores[power]
                equal = equal & ~scores[power]
        return above | equal


def search(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: float = 1024.0, dropped: int = 3, block_rows: int = 1 << 16, pass_queries: int = 1 << 14) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows for each query row."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("vector"), is_query.alias("is_query")).where("id is not null")
    spark = df.sparkSession
    asked = written(rows.where("is_query").select("id", "vector", F.monotonically_increasing_id().alias("place")), "queries")

    def searched(shared: Broadcast) -> DataFrame:
        def block(ids, columns):
            column = pa.chunked_array(columns)
            ids = np.concatenate(ids)
            for at, values in scaled(column, scale):
                index = Slices(ids[at], values, dropped)
                for number, (own, query) in enumerate(shared.value):
                    if len(query) == values.shape[1]:
                        found, score = index.top(query, own, k)
                        n = len(found)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([number] * n, pa.int64()), pa.array([own] * n, pa.int64()), pa.array(found), pa.array(score)],
                            names=["number", "query_id", "vec_id", "score"])

        def run(batches):
            ids, columns, held = [], [], 0
            for batch in batches:
                for at in range(0, batch.num_rows, block_rows):
                    part = batch.slice(at, block_rows)
                    if held and held + part.num_rows > block_rows:
                        yield from block(ids, columns)
                        ids, columns, held = [], [], 0
                    ids.append(part.column(0).to_numpy())
                    columns.append(part.column(1))
                    held += part.num_rows
            if held:
                yield from block(ids, columns)

        return rows.select("id", "vector").mapInArrow(run, "number long, query_id long, vec_id long, score long")

    found = []
    for low, high in _passes(asked, pass_queries):
        mine = asked.where((F.col("place") >= low) & (F.col("place") < high)).select("id", "vector").toArrow()
        shared = spark.sparkContext.broadcast(
            [(mine.column(0)[int(row)].as_py(), vector) for at, values in scaled(mine.column(1), scale)
             for row, vector in zip(at, values, strict=True)])
        ranked = searched(shared).withColumn("rank", F.row_number().over(
            Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")))
        found.append(written(ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "found"))
        shared.destroy()
    return reduce(DataFrame.union, found)


def _passes(asked: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of places with at most `most` queries each. A place is a partition's
    number and a row's number in it, so counts by partition tell where to cut."""
    part = F.shiftrightunsigned("place", 33).alias("part")
    counts = sorted(tuple(r) for r in asked.groupBy(part).count().collect())
    cuts, held = [0], 0
    for number, count in counts:
        at = 0
        while held + count - at > most:
            at += most - held
            cuts.append((number << 33) + at)
            held = 0
        held += count - at
    return list(zip(cuts, [*cuts[1:], 1 << 62], strict=True))

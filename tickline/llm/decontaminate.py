"""Benchmark decontamination on word windows, with DataFrame functions only.

Words are runs of ASCII letters and digits and of all other non-ASCII
characters, A-Z in lower case. Every run of `window` words of a benchmark item
is a window; an item with fewer words is one window. A document's windows are
hashed, looked up in the hash set of benchmark windows and compared word by
word; words in a window that occurs are hit.

Not every window is hashed: each benchmark window names its longest word as
anchor, and a document's windows are looked at only where an anchor stands, at
the offsets that it has in benchmark windows. So most words cost one lookup.

Anchors and windows are broadcast up to `ANCHORS` words and `WINDOW_BYTES`
bytes of words. Beyond the first, all windows are hashed; beyond the second,
the candidate windows are joined by shuffle. Otherwise only hits and one row
per document are shuffled.

Null texts have no words. Rows are handled one by one: rows that share an id
each give a row, null ids too. An item with a null id marks words, but is not
in `items`. An empty benchmark, or one without words, hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHORS = 1_000_000
WINDOW_BYTES = 64 << 20


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NO_WORD), "")


def benchmark_windows(benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id",
                      window: int = 13) -> DataFrame:
    """Distinct windows: length, hash, words, and the sorted ids of their items."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), words_of(F.col(f"`{text_col}`")).alias("w"))
    length = F.least(F.size("w"), F.lit(window))
    runs = items.where(F.size("w") > 0).select(
        "item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - length + 1),
                                      lambda i: F.slice("w", i, length))).alias("run"))
    return runs.groupBy("run").agg(F.array_sort(F.collect_set("item")).alias("items")) \
        .select(F.size("run").alias("length"), F.xxhash64("run").alias("hash"), "run", "items")


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  benchmark_text: str = "text", item_col: str = "item_id", window: int = 13) -> DataFrame:
    """id, place (the row's own number), n_words, n_hit, items (sorted ids of
    items that occur) and contaminated, for every row of `df`.

    contaminated: at least one word and at least a twentieth of all words are hit.
    """
    windows = benchmark_windows(benchmark, benchmark_text, item_col, window)
    size = windows.agg(F.sum(F.length(F.array_join("run", " ")) + 8 * F.size("items")).alias("bytes"),
                       F.collect_set("length").alias("lengths")).first()
    right = windows.select(F.col("hash").alias("b_hash"), F.col("run").alias("b_run"), "items")
    if (size.bytes or 0) <= WINDOW_BYTES:
        right = F.broadcast(right)

    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("place"),
                     words_of(F.col(f"`{text_col}`")).alias("w"))
    # Position 0 has no word; it carries the document itself through the joins.
    words = docs.select("id", "place", "w", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("w")))
                        .alias("at", "word"))
    offset = F.array_max(F.transform("run", lambda w, i: F.struct(F.length(w), -i)))["col2"]
    anchors = windows.select("length", (-offset).alias("offset"), F.xxhash64(F.element_at("run", 1 - offset)).alias("anchor")) \
        .groupBy("anchor").agg(F.collect_set(F.struct("length", "offset")).alias("places"))
    if anchors.count() <= ANCHORS:
        looked = words.join(F.broadcast(anchors), F.xxhash64("word") == F.col("anchor"), "left")
    else:
        every = F.array(*(F.struct(F.lit(n).alias("length"), F.lit(0).alias("offset")) for n in size.lengths))
        looked = words.withColumn("places", every)
    looked = looked.where("at = 0 or places is not null") \
        .select("id", "place", "w", "at", F.explode_outer("places").alias("x")) \
        .select("id", "place", "w", "at", (F.col("at") - F.col("x.offset")).alias("start"), F.col("x.length").alias("length"))
    fits = (F.col("at") > 0) & (F.col("start") >= 1) & (F.col("start") + F.col("length") - 1 <= F.size("w"))
    looked = looked.where((F.col("at") == 0) | fits).select(
        "id", "place", F.when(F.col("at") == 0, F.size("w")).cast("long").alias("n_words"), "start", "length",
        F.when(F.col("at") > 0, F.slice("w", F.greatest("start", F.lit(1)), F.coalesce("length", F.lit(0)))).alias("run"))
    found = looked.withColumn("hash", F.xxhash64("run")).join(
        right, (F.col("hash") == F.col("b_hash")) & (F.col("run") == F.col("b_run")), "left") \
        .where("n_words is not null or b_run is not null") \
        .select("id", "place", "n_words", F.when(F.col("n_words").isNull(), F.col("start").cast("long") * (window + 1)
                                                 + F.col("length")).alias("hit"), "items")
    step = F.lit(window + 1)

    def cover(done: Column, hit: Column) -> Column:
        start = F.floor(hit / step)
        end = start + hit % step
        return F.struct(F.greatest(done["upto"], end).alias("upto"),
                        (done["total"] + F.greatest(F.lit(0), end - F.greatest(start, done["upto"]))).alias("total"))

    none = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("total"))
    return (found.groupBy("place").agg(F.first("id").alias("id"), F.max("n_words").alias("n_words"),
                                       F.array_sort(F.collect_set("hit")).alias("hits"),
                                       F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
            .withColumn("n_hit", F.aggregate("hits", none, cover, lambda x: x["total"]))
            .select("id", "place", "n_words", "n_hit", "items",
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))


def clean(df: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of `df` that `contamination(df, ...)` did not mark. `df` must be a
    table, or be written first: its rows are numbered by their place both times.

    The marked places are broadcast if there are at most 1,000,000 (8 MB).
    """
    marked = found.where("contaminated").select("place")
    if marked.count() <= 1_000_000:
        marked = F.broadcast(marked)
    return df.withColumn("place", F.monotonically_increasing_id()).join(marked, "place", "left_anti").select(*df.columns)

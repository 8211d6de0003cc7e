"""Language identification by the nearest of several centroids per language.

A text's vector counts its character pairs and triples (letters in lower case,
anything else one space) in `DIMS` hashed columns, as log(1 + count) times the
inverse document frequency, at unit length. Document frequencies cover all
labelled rows offered for training, and so do the centroids: a task gathers its
rows of a language into at most `LEADERS` sums of like rows, Spark merges the
sums of the tasks in two levels, and the clusters of what is left (spherical
k-means; clusters of a few odd rows go) are the language's centroids, each the
sum of its rows. Which rows meet in a task sways the sums a little, so the
centroids are the same for the same input in the same partitions. A text gets
the language of the centroid with the largest cosine.

Rejection is by distance: a text is rejected if its cosine is below `slack`
times the `low` quantile of the cosines that all labelled rows of its language
have in its band of text lengths, each row left out of its centroid. The
quantiles come from histograms (language, band, `BINS` steps) that Spark adds
up, so neither a few odd rows nor the size of the input decides. A band with
under `least` rows takes the nearest bands' rows too, and a language with under
`least` rows those of all languages; cosines of longer bands count less by the
root of 2 a band, as a shorter text has fewer grams.

A null text and one without a letter are `und`, rejected, with score 0. So is
every text if there is no labelled row. Rows with a null or empty language are
not learned from. Long texts are read whole. Input rows are handled one by one:
repeated rows and null ids stay.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.common import begin, map_texts, slices

DIMS = 1 << 12
CHUNK = (1 << 19, 256)  # bytes of text and rows that are counted at once
BANDS = 65
BINS = 200  # steps of the cosine in a histogram
LEADERS = 16  # sums of like rows that a task or a merge hands on per language
HELD = 1024  # rows that a task holds before it gathers them
GROUPS = 64  # merges of a language's sums before the last one
UNKNOWN = "und"
_SPACE = 32
_fold: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point: 0 if it is no letter, else its lower case (one code point)."""
    global _fold
    if _fold is None:
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x34000):  # no letters lie beyond
            char = chr(c)
            if char.isalpha():
                low = char.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold = table
    return _fold


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed character pairs and triples (rows x DIMS), and each text's number of letters."""
    n = len(texts)
    joined = "\n".join(["", *((t or "") for t in texts), ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t or "") for t in texts), np.int64, n)
    owner = np.repeat(np.arange(n), lengths + 1)  # a text and the line feed before it
    owner = np.append(owner, n - 1) if n else owner
    folded = _letters()[points]
    letter = folded > 0
    letters = np.bincount(owner[letter], minlength=n)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each run of letters
    keep[:1] = True
    owner, points = owner[keep], np.where(letter, folded, _SPACE)[keep].astype(np.uint64)
    owner, points = np.append(owner, owner[-1:]), np.append(points, np.uint64(_SPACE))
    counts = np.zeros(n * DIMS, np.float32)
    mix = np.uint64(0x9E3779B97F4A7C15)
    pair = points[:-1] << np.uint64(21) | points[1:]
    triple = pair[:-1] << np.uint64(21) | points[2:]
    shift = np.uint64(64 - DIMS.bit_length() + 1)
    first, second = points[:-1] != _SPACE, points[1:] != _SPACE
    # A gram belongs to the text that its letter is in; triples have a letter in the middle.
    for gram, real, of in ((pair, first | second, np.where(first, owner[:-1], owner[1:])),
                           (triple, second[:-1], owner[1:-1])):
        where = of[real] * DIMS + ((gram[real] * mix) >> shift).astype(np.int64)
        counts += np.bincount(where, minlength=n * DIMS).astype(np.float32)
    return counts.reshape(n, DIMS), letters


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    norms = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(norms > 0, norms, 1)


def cluster(sums: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means of sums of rows: centroids and each sum's number of the nearest.
    Begins with far-apart sums, so equal input gives equal centroids."""
    points = _unit(sums)
    chosen = [int(np.argmax(points @ sums.sum(0)))]
    nearest = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, points @ points[chosen[-1]])
    centres = points[chosen]
    best = np.argmax(points @ centres.T, axis=1)
    for _ in range(rounds):
        before = best
        centres = _unit(np.stack([sums[best == c].sum(0) if (best == c).any() else centres[c]
                                  for c in range(len(centres))]))
        best = np.argmax(points @ centres.T, axis=1)
        if (best == before).all():
            break
    return centres, best


def _unit(sums: np.ndarray) -> np.ndarray:
    return sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)


def gathered(sums: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows, and how many rows each has, as at most `LEADERS` of them; no row
    is lost but those without a gram, where others have some."""
    some = sums.any(1)
    if not some.any():
        return sums[:1], rows[:1]
    sums, rows = sums[some], rows[some]
    if len(sums) <= LEADERS:
        return sums, rows
    _, best = cluster(sums, LEADERS, 4)
    used = np.unique(best)
    return np.stack([sums[best == c].sum(0) for c in used]), np.array([rows[best == c].sum() for c in used])


def main_clusters(sums: np.ndarray, rows: np.ndarray, k: int, share: float = 0.02,
                  rounds: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and the lengths of their rows' sums. Clusters of one row or under `share`
    of the rows are odd rows: the others are clustered again without them."""
    while True:
        _, best = cluster(sums, k)
        size = np.bincount(best, rows, min(k, len(sums)))
        keep = size >= max(2, share * rows.sum())
        keep[np.argmax(size)] = True
        rounds -= 1
        if keep.all() or not rounds:
            found = np.stack([sums[best == c].sum(0) for c in np.flatnonzero(keep)])
            return _unit(found), np.linalg.norm(found, axis=1)
        sums, rows = sums[keep[best]], rows[keep[best]]


def band(letters: np.ndarray) -> np.ndarray:
    """Texts of like length share a band: the number of bits of their count of letters."""
    return np.ceil(np.log2(letters + 1.0)).astype(np.int64)


def floors(histogram: np.ndarray, low: float, slack: float, least: int) -> np.ndarray:
    """Smallest cosine accepted (languages x BANDS) from counts of rows (languages x BANDS x BINS)."""
    found = np.zeros(histogram.shape[:2])
    every = histogram.sum(0)
    steps = np.arange(BINS) / BINS  # the lower edge of each bin
    for number, own in enumerate(histogram):
        counts = own if own.sum() >= least else every
        held = np.flatnonzero(counts.sum(1))
        for b in range(BANDS):
            away = np.abs(held - b)
            for width in np.unique(away):
                use = held[away <= width]
                if counts[use].sum() >= least:
                    break
            if len(held):
                values = (steps * np.sqrt(2.0) ** np.minimum(0, b - use)[:, None]).ravel()
                order = np.argsort(values, kind="stable")
                ranks = np.cumsum(counts[use].ravel()[order])
                found[number, b] = slack * values[order][np.searchsorted(ranks, low * ranks[-1], side="right")]
    return found


@dataclass
class LanguageModel:
    languages: list[str]      # of each centroid
    centroids: np.ndarray     # centroids x DIMS
    idf: np.ndarray
    floor: np.ndarray         # smallest cosine accepted, centroids x BANDS

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (cosine) and whether the text is rejected."""
        counts, letters = gram_counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosines = vectors(counts, self.idf) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        score = np.clip(cosines[np.arange(len(texts)), best].astype(np.float64), 0, 1)
        some = letters > 0
        names = [self.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
        return names, np.where(some, score, 0.0), ~some | (score < self.floor[best, band(letters)])


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
        centroids: int = 3, slack: float = 0.7, low: float = 0.01, least: int = 200) -> LanguageModel:
    """Learn from all rows of `df` that have a text and a language.

    One pass counts documents by gram, one gathers the rows into sums, one counts
    cosines. A task hands on at most `LEADERS` sums per language, and a merge reads those of one
    in `GROUPS` tasks; the driver gets `centroids` vectors per language.
    """
    rows = df.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                     F.col(f"`{lang_col}`").cast("string").alias("lang")) \
        .where("text is not null and lang is not null and lang <> ''")

    def frequencies(batches):
        begin("tickline.llm.langid")
        found, total = np.zeros(DIMS, np.int64), 0
        for batch in slices(batches, 0, *CHUNK):
            counts, _ = gram_counts(batch.column(0).to_pylist())
            found += (counts > 0).sum(0)
            total += batch.num_rows
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([*range(DIMS), DIMS]), pa.array([*found, total])],
                                             names=["dim", "n"])

    seen = (rows.select("text").mapInArrow(frequencies, "dim long, n long")
            .groupBy("dim").agg(F.sum("n").alias("n")).collect())
    found = np.zeros(DIMS + 1)
    for dim, n in seen:
        found[dim] = n
    idf = (np.log((1 + found[DIMS]) / (1 + found[:DIMS])) + 1).astype(np.float32)

    kept = "lang string, part int, no int, rows long, total binary"

    def gather(batches):
        begin("tickline.llm.langid")
        part, held, fresh = TaskContext.get().partitionId(), {}, {}

        def fold():
            for lang, new in fresh.items():
                old = held.get(lang, (np.zeros((0, DIMS), np.float32), np.zeros(0, np.int64)))
                held[lang] = gathered(np.concatenate([old[0], *new]),
                                      np.append(old[1], np.ones(sum(map(len, new)), np.int64)))
            fresh.clear()

        def hand_on():
            for lang, (sums, rows) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows)), pa.array([part] * len(rows), pa.int32()),
                     pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.int64()),
                     pa.array([x.astype("<f4").tobytes() for x in sums], pa.binary())],
                    names=["lang", "part", "no", "rows", "total"])
            held.clear()

        waiting = 0
        for batch in slices(batches, 0, *CHUNK):
            points = vectors(gram_counts(batch.column(0).to_pylist())[0], idf)
            of = np.array(batch.column(1).to_pylist(), object)
            for lang in dict.fromkeys(of.tolist()):
                fresh.setdefault(lang, []).append(points[of == lang])
            waiting += len(of)
            if waiting >= HELD:
                fold()
                waiting = 0
                if len(held) * LEADERS > 2 * HELD:  # very many languages
                    yield from hand_on()
        fold()
        yield from hand_on()

    def sums_of(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        # The sums themselves break ties: a task that handed on more than once repeats its numbers.
        group = group.sort_values(["part", "no", "rows", "total"])
        return np.stack([np.frombuffer(x, "<f4") for x in group.total]), group.rows.to_numpy()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        sums, rows = gathered(*sums_of(group))
        return pd.DataFrame({"lang": group.lang.iloc[0], "part": group.part.min(), "no": range(len(rows)), "rows": rows,
                             "total": [x.astype("<f4").tobytes() for x in sums]})

    def centres(group: pd.DataFrame) -> pd.DataFrame:
        found, lengths = main_clusters(*sums_of(group), centroids)
        return pd.DataFrame({"lang": group.lang.iloc[0], "centre": [c.tolist() for c in found], "length": lengths})

    made = sorted(rows.select("text", "lang").mapInArrow(gather, kept)
                  .groupBy("lang", F.col("part") % GROUPS).applyInPandas(merge, kept)
                  .groupBy("lang").applyInPandas(centres, "lang string, centre array<float>, length double").collect())
    model = LanguageModel([r[0] for r in made], np.array([r[1] for r in made], np.float32).reshape(-1, DIMS), idf,
                          np.zeros((len(made), BANDS)))
    if not made:
        return model
    languages, of = np.unique(model.languages, return_inverse=True)
    number = {name: k for k, name in enumerate(languages.tolist())}
    shared = df.sparkSession.sparkContext.broadcast((model, np.array([r[2] for r in made])))

    def cosines(batches):
        begin("tickline.llm.langid")
        model, length = shared.value
        seen: dict[int, int] = {}
        for batch in slices(batches, 0, *CHUNK):
            counts, letters = gram_counts(batch.column(0).to_pylist())
            own = np.array([number.get(x, -1) for x in batch.column(1).to_pylist()])
            # Taken out of the sum of a centroid's rows: out of each, as its own is not noted.
            cosine = vectors(counts, model.idf) @ model.centroids.T
            left = (length * cosine - 1) / np.sqrt(np.maximum(length * length - 2 * length * cosine + 1, 1e-6))
            score = np.clip(np.where(of == own[:, None], left, 0).max(1), 0, 1)
            where = (own * BANDS + band(letters)) * BINS + np.minimum(score * BINS, BINS - 1).astype(np.int64)
            for at, n in zip(*np.unique(where[(own >= 0) & (letters > 0)], return_counts=True), strict=True):
                seen[int(at)] = seen.get(int(at), 0) + int(n)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                             names=["at", "n"])

    histogram = np.zeros(len(languages) * BANDS * BINS, np.int64)
    for at, n in (rows.select("text", "lang").mapInArrow(cosines, "at long, n long")
                  .groupBy("at").agg(F.sum("n")).collect()):
        histogram[at] = n
    model.floor = floors(histogram.reshape(-1, BANDS, BINS), low, slack, least)[of]
    return model


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """`df` with lang_pred, score (0 to 1) and rejected; one pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    results = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                            T.StructField("rejected", T.BooleanType())])
    return map_texts(df, text_col, results, lambda: lambda texts: list(shared.value.predict(texts)),
                     chunk_bytes=CHUNK[0], rows=CHUNK[1])

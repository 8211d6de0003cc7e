"""Language-model scores from a weighted backoff automaton.

Tokens are words (runs of anything but ASCII blanks, A-Z in lower case) and one
end per text. The model is an n-gram model of `order`, interpolated with the next
shorter context:

    p(w | u) = (c(u w) + m p(w | u')) / (c(u) + m)

with u' the context u without its first token, and (c(w) + 1) / (N + V + 1)
under the empty context; it sums to one over the V tokens seen and one unseen.
A context never seen gives way to the next shorter one. The mass m of an order
is the one under which as many training tokens are expected to fail, each left
out of the counts in turn, as would do so, namely those whose n-gram occurs once:

    sum over contexts u of c(u) * m / (c(u) - 1 + m) = n-grams that occur once

(beyond 255 the counts of contexts are taken as the mean of their power of two).
Each block builds an automaton: a state per context seen, sorted arcs (state,
word) that carry log p(w | u), and a failure link from u to u' that weighs
log(m / (c(u) + m)). All texts of a block advance together, one token a step,
each with its state and its score: take the arc of the next token if there is
one, else add the failure's weight and try again from the shorter context.

How it is spread out. Documents are dealt into blocks by a hash. A block needs
the counts of its own n-grams only. It sends their hashes and its own training
counts, sorted and packed, to buckets of the hash space; a bucket adds the
counts up over all blocks and sends each block the totals of what it asked for,
in the order asked. Buckets also tally how many n-grams occur how often, a table
of fixed size, which gives the masses m, N and V; they come to the blocks beside the
totals, before any walk, so a text is tokenised twice in all. No table of n-grams
is held whole anywhere, n-grams come from all training texts, and both blocks and
buckets have a bounded size whatever the corpus: their number grows. A frequent
n-gram is one entry per block, as any other. Rows are dealt by their places, so repeated rows spread over
blocks; let `df` be a written table, whose rows keep their places in a retry. Words have
64-bit hashes, longer n-grams ones of `MARGIN` bits more than the count of tokens
that the texts have room for needs (at most 64), so no more than about one in
2 ** (MARGIN - 1) shares another's count.

Null and empty texts are one end token. Ids are not used but for the fold, so
repeated and null ids are rows like others. Without training rows, N = V = 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 6 << 20       # of text in a block
BUCKET_GRAMS = 1_000_000    # n-grams that a bucket gets, about, over the number of blocks that ask for each
MARGIN = 23                 # the lowest bit tells n-grams that end a text
END, BEGIN = 1, 2
EXACT = 255                 # counts of contexts up to here are tallied one by one
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Word -> 64-bit hash, computed once while it is held."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word) if word else END
        return value


_words = _Words()


class Text:
    """The tokens of a block's texts in one row, and n-grams that end at each place."""

    def __init__(self, texts: list[str | None], order: int):
        words: list[bytes] = []
        ends = []
        for text in texts:
            if text:  # ASCII letters and blanks only
                words += text.encode("utf-8", "surrogatepass").lower().split()
            words.append(b"")
            ends.append(len(words))
        self.token = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
        self.ends = np.array(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        first = np.zeros(len(words), np.int64)
        first[self.starts] = self.starts
        self.inside = np.arange(len(words)) - np.maximum.accumulate(first)  # place within its text
        self.order = order

    def grams(self, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per order from 2 on: the places that have one, and its hash there.
        A text begins with one begin mark."""
        found, longer = [], self.token
        for k in range(2, self.order + 1):
            context = np.concatenate([np.full(1, BEGIN, np.uint64), longer[:-1]])
            context[self.inside == 0] = BEGIN
            longer = _extended(context, self.token)
            at = np.flatnonzero(self.inside >= k - 2)
            hashed = longer[at] >> np.uint64(64 - bits)
            found.append((at, hashed & ~np.uint64(1) | (self.token[at] == END)))
        return found


def _extended(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hash of the n-gram that is `context` followed by `token`."""
    x = (context ^ (context >> np.uint64(31))) * _ODD + token
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Counted:
    """Distinct n-grams of a block by order, sorted, and where each place's one is."""

    def __init__(self, text: Text, bits: int):
        self.text = text
        begins = np.full(len(text.ends), BEGIN, np.uint64)
        self.keys, self.place, self.at = [], [], []
        for k, (at, values) in enumerate([(None, text.token), *text.grams(bits)]):
            joined = np.concatenate([values, begins]) if k == 0 else values
            keys, place = np.unique(joined, return_inverse=True)
            self.keys.append(keys)
            self.place.append(place)
            self.at.append(at)

    def counts(self, training: np.ndarray) -> list[np.ndarray]:
        """Training counts, aligned with the keys; `training` is per text."""
        learn = np.repeat(training, self.text.ends - self.text.starts).astype(float)
        weights = [np.concatenate([learn, training.astype(float)]), *(learn[at] for at in self.at[1:])]
        return [np.bincount(p, weights=w, minlength=len(k)).astype(np.int64)
                for p, w, k in zip(self.place, weights, self.keys, strict=True)]


class Automaton:
    """The part of the model that a block's texts can reach. State 0 is the empty context.

    `totals` are the corpus counts of the block's n-grams, `masses` the m of each
    context length from 1 on, `whole` N + V + 1.
    """

    def __init__(self, counted: Counted, totals: list[np.ndarray], masses: list[float], whole: int):
        self.text, order = counted.text, counted.text.order
        n = len(self.text.token)
        self.word, self.words = counted.place[0][:n], len(counted.keys[0])
        at = [np.arange(n), *counted.at[1:]]
        gram = []  # by length: each place's n-gram
        for where, place in zip(at, counted.place, strict=True):
            gram.append(np.zeros(n, np.int64))
            gram[-1][where] = place[:len(where)]
        state, states = [], 1  # by length: each n-gram's state
        for k in range(order - 1):
            seen = totals[k] > 0
            state.append(np.where(seen, states + np.cumsum(seen) - 1, 0))
            states += int(seen.sum())
        begin = counted.place[0][n] if len(self.text.ends) else 0
        self.first = int(state[0][begin]) if state and len(self.text.ends) else 0
        self.fail = np.zeros(states, np.int64)
        self.give = np.zeros(states)  # what a failure weighs
        for k, numbers in enumerate(state):
            seen = totals[k] > 0
            self.give[numbers[seen]] = np.log10(masses[k] / (totals[k][seen] + masses[k]))

        def context(k: int, example: np.ndarray, values: np.ndarray) -> np.ndarray:
            """Of `values` by n-grams of length k, those of what stands before places."""
            before = values[gram[k - 1][example - 1]]
            return np.where(self.text.inside[example] == 0, values[begin], before) if k == 1 else before

        arcs, targets, labels = [], [], []
        for k, (where, place) in enumerate(zip(at, counted.place, strict=True)):
            example = np.full(len(counted.keys[k]), -1)
            example[place[:len(where)]] = where  # a place that ends this n-gram
            number = np.flatnonzero((totals[k] > 0) & (example >= 0))
            example = example[number]
            source = context(k, example, state[k - 1]) if k else np.zeros(len(number), np.int64)
            if k < order - 1:
                target = state[k][number]
                if k:
                    self.fail[target] = state[k - 1][gram[k - 1][example]]
            else:
                target = state[k - 1][gram[k - 1][example]] if k else source
            p = (totals[0][self.word[example]] + 1) / whole
            for j in range(1, k + 1):
                p = (totals[j][gram[j][example]] + masses[j - 1] * p) / (context(j, example, totals[j - 1]) + masses[j - 1])
            arcs.append(source * self.words + self.word[example])
            targets.append(target)
            labels.append(np.log10(p))
        arcs = np.concatenate(arcs)
        by = np.argsort(arcs)
        # A last arc that no place takes stands for a token never seen.
        self.arc = np.append(arcs[by], np.iinfo(np.int64).max)
        self.target = np.append(np.concatenate(targets)[by], 0)
        self.label = np.append(np.concatenate(labels)[by], -math.log10(whole))

    def walk(self) -> np.ndarray:
        """Each text's log10 probability, added up on one way through it."""
        starts, lengths = self.text.starts, self.text.ends - self.text.starts
        by = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[by], lengths[by]
        state = np.full(len(starts), self.first)
        score = np.zeros(len(starts))
        none = len(self.arc) - 1
        steps = int(lengths.max(initial=0))
        for step, active in enumerate(np.searchsorted(-lengths, -np.arange(steps), side="left").tolist()):
            word, here = self.word[starts[:active] + step], state[:active]
            want = here * self.words + word
            found = np.searchsorted(self.arc, want)
            miss = np.flatnonzero(self.arc[found] != want)
            while len(miss):
                found[miss] = none
                miss = miss[here[miss] > 0]
                score[miss] += self.give[here[miss]]
                here[miss] = self.fail[here[miss]]
                want = here[miss] * self.words + word[miss]
                again = np.searchsorted(self.arc, want)
                found[miss] = again
                miss = miss[self.arc[again] != want]
            state[:active] = self.target[found]
            score[:active] += self.label[found]
        scores = np.zeros(len(starts))
        scores[by] = score
        return scores


def tallied(k: int, keys: np.ndarray, totals: np.ndarray) -> list[tuple[int, bool, int, int, int]]:
    """Of distinct n-grams of length k + 1: that length, whether they end a text, a class
    of their count, and how many they are and how often they occur."""
    keys, totals = keys[totals > 0], totals[totals > 0]
    group = np.where(totals <= EXACT, totals, EXACT + np.frexp(totals.astype(float))[1])
    ended = keys == END if k == 0 else keys & np.uint64(1) == 1
    rows = []
    for last in (False, True):
        times = np.bincount(group[ended == last])
        sums = np.bincount(group[ended == last], weights=totals[ended == last])
        rows += [(k + 1, last, int(g), int(times[g]), int(sums[g])) for g in np.flatnonzero(times)]
    return rows


def masses(tally: list[tuple[int, bool, int, int, int]], order: int) -> list[float]:
    """The mass m of each context length from 1 on; 1 where nothing was learned."""
    found = []
    for k in range(1, order):
        once = sum(times for length, _, group, times, _ in tally if length == k + 1 and group == 1)
        held = [(total, total / times) for length, last, _, times, total in tally if length == k and not last]
        low, high = math.log(1e-6), math.log(1e12)
        for _ in range(100):
            m = math.exp((low + high) / 2)
            if sum(total * m / (mean - 1 + m) for total, mean in held) < once:
                low = math.log(m)
            else:
                high = math.log(m)
        found.append(math.exp((low + high) / 2) if once and held else 1.0)
    return found


def vocabulary(tally: list[tuple[int, bool, int, int, int]]) -> tuple[int, int]:
    """N and V: of single words without begin marks, of which a text has one, as it has one end."""
    single = [(last, times, total) for length, last, _, times, total in tally if length == 1]
    texts = sum(total for last, _, total in single if last)
    return sum(total for *_, total in single) - texts, sum(times for _, times, _ in single) - (texts > 0)


def _split(keys: np.ndarray, bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bucket (equal parts of the hash space) each sorted key is in, as runs."""
    top = keys >> np.uint64(max(0, bits - 32))
    number = top * np.uint64(buckets) >> np.uint64(min(bits, 32))
    found, starts = np.unique(number, return_index=True)
    return found.astype(np.int64), np.append(starts, len(keys))


def _packed(keys: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Each run of sorted keys between `edges`: where many share their high 32 bits,
    the runs of equal high bits and each one's low bits; else their differences, as
    wide as the run's largest. The work is per key: with many buckets runs are short."""
    if not len(keys):
        return []
    starts = edges[:-1]
    steps = np.diff(keys, prepend=keys[:1]).astype("<u8")
    steps[starts] = 0
    tops = np.maximum.reduceat(steps, starts)
    width = 1 + sum((tops >> np.uint64(8 * i) > 0).astype(int) for i in range(1, 8))
    fresh = np.diff(keys >> np.uint64(32), prepend=keys[:1]) > 0
    fresh[starts] = True
    dense = np.add.reduceat(fresh, starts, dtype=np.int64) * 8 < np.diff(edges)
    raw = steps.view(np.uint8).reshape(-1, 8)
    flat = {w: raw[:, :w].tobytes() for w in set(width.tolist())}
    first, head = keys[starts].astype("<u8").tobytes(), np.arange(9, dtype="<u4").tobytes()
    found = []
    for r, (i, j, w, many) in enumerate(zip(starts.tolist(), edges[1:].tolist(), width.tolist(), dense.tolist(), strict=True)):
        if many:
            high, times = np.unique(keys[i:j] >> np.uint64(32), return_counts=True)
            found.append(np.array([0, len(high)], "<u4").tobytes() + high.astype("<u8").tobytes()
                         + times.astype("<u4").tobytes() + keys[i:j].astype("<u4").tobytes())
        else:
            found.append(head[4 * w:4 * w + 4] + first[8 * r:8 * r + 8] + flat[w][(i + 1) * w:j * w])
    return found


def _unpacked(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all packed runs, one run after the other, and the runs' edges."""
    def field(i: int, j: int, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join([x[i:j] for x in data]), kind)

    width, size = field(0, 4, "<u4").astype(np.int64), np.fromiter(map(len, data), np.int64, len(data))
    length = np.where(width > 0, (size - 12) // np.maximum(width, 1) + 1, (size - 8 - 12 * field(4, 8, "<u4").astype(np.int64)) // 4)
    edges = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    starts, steps = edges[:-1], np.zeros(edges[-1], np.uint64)
    for w in set(width[width > 0].tolist()):
        raw = np.frombuffer(b"".join([data[r][12:] for r in np.flatnonzero(width == w).tolist()]), np.uint8).reshape(-1, w)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :w] = raw
        here = np.repeat(width == w, length)
        here[starts] = False
        steps[here] = wide.reshape(-1).view("<u8")
    steps[starts] = field(4, 12, "<u8")
    keys = np.cumsum(steps, dtype=np.uint64)
    keys -= np.repeat(keys[starts] - steps[starts], length)  # each run begins anew; sums may wrap
    for r in np.flatnonzero(width == 0).tolist():
        x, n = data[r], int(np.frombuffer(data[r], "<u4", 1, 4)[0])
        high, times = np.frombuffer(x, "<u8", n, 8), np.frombuffer(x, "<u4", n, 8 + 8 * n)
        low = np.frombuffer(x, "<u4", offset=8 + 12 * n).astype(np.uint64)
        keys[edges[r]:edges[r + 1]] = np.repeat(high, times) << np.uint64(32) | low
    return keys, edges


def _small(values: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Each run of counts, in the narrowest unsigned type."""
    if not len(values):
        return []
    tops = np.maximum.reduceat(values, edges[:-1])
    width = np.select([tops < 1 << 8, tops < 1 << 16, tops < 1 << 32], [1, 2, 4], 8).tolist()
    flat = {w: values.astype(f"<u{w}").tobytes() for w in set(width)}
    return [b"%d" % w + flat[w][i * w:j * w] for i, j, w in zip(edges[:-1].tolist(), edges[1:].tolist(), width, strict=True)]


def _counts(data: list[bytes]) -> np.ndarray:
    """The counts of all runs, one run after the other."""
    width = np.array([x[0] - ord("0") for x in data], np.int64)
    length = (np.fromiter(map(len, data), np.int64, len(data)) - 1) // width
    counts = np.zeros(int(length.sum()), np.int64)
    for w in set(width.tolist()):
        runs = np.flatnonzero(width == w).tolist()
        counts[np.repeat(width == w, length)] = np.frombuffer(b"".join([data[r][1:] for r in runs]), f"<u{w}")
    return counts


def score(df: DataFrame, training: Column, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          order: int = 2) -> DataFrame:
    """`keep`, training, n_tokens, n_known, train_tokens (N), base_score and score of every row."""
    rows = df.select(*(F.col(f"`{c}`") for c in keep), training.alias("training"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))

    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 64)).collect()[0][0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    buckets = max(1, math.ceil(size / 8 * order / BUCKET_GRAMS))
    bits = min(64, (size // 2).bit_length() + MARGIN)  # a token has two bytes, or ends a text
    widths = [64, *[bits] * (order - 1)]

    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))

    def counted_of(table: pa.Table) -> Counted:
        return Counted(Text(table.column("text").to_pylist(), order), bits)

    def ask(table: pa.Table) -> pa.Table:
        counted = counted_of(table)
        counts = counted.counts(np.array(table.column("training").to_pylist(), bool))
        asked = []
        for k, (keys, times) in enumerate(zip(counted.keys, counts, strict=True)):
            number, edges = _split(keys, widths[k], buckets)
            asked += zip([k] * len(number), number.tolist(), _packed(keys, edges), _small(times, edges), strict=True)
        k, bucket, keys, times = zip(*asked, strict=True)
        return pa.table([pa.array(k, pa.int32()), pa.array(bucket, pa.int64()),
                         pa.array([table.column("block")[0].as_py()] * len(asked), pa.int32()),
                         pa.array(keys, pa.binary()), pa.array(times, pa.binary())],
                        names=["k", "bucket", "block", "keys", "counts"])

    def added(table: pa.Table):
        """A bucket's distinct keys and their totals; where each asked key is among them; edges of the rows."""
        keys, edges = _unpacked(table.column("keys").to_pylist())
        distinct, place = np.unique(keys, return_inverse=True)
        counts = _counts(table.column("counts").to_pylist())
        return distinct, np.bincount(place, weights=counts).astype(np.int64), place, edges

    def answer(table: pa.Table) -> pa.Table:
        _, totals, place, edges = added(table)
        return pa.table([table.column("block"), table.column("k"), table.column("bucket"),
                         pa.array(_small(totals[place], edges), pa.binary())],
                        names=["block", "k", "bucket", "totals"])

    counters = ["length", "ended", "class", "times", "total"]

    def tally(table: pa.Table) -> pa.Table:
        keys, totals, _, _ = added(table)
        found = tallied(table.column("k")[0].as_py(), keys, totals)
        kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array([r[i] for r in found], kind) for i, kind in enumerate(kinds)], names=counters)

    def solve(batches):
        table = pa.Table.from_batches(batches, pa.schema([(c, pa.int64()) for c in counters]))
        found = [tuple(r[c] for c in counters) for r in table.to_pylist()]
        n, v = vocabulary(found)
        yield pa.RecordBatch.from_arrays([pa.array([masses(found, order)], pa.list_(pa.float64())),
                                          pa.array([n], pa.int64()), pa.array([v], pa.int64())], names=["masses", "n", "v"])

    kept = [f for f in df.schema if f.name in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "training boolean", "n_tokens long",
                        "n_known long", "train_tokens long", "base_score double", "score double"])

    def place(texts: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by([("k", "ascending"), ("bucket", "ascending")])
        of, parts = answers.column("k").to_pylist(), answers.column("totals").to_pylist()
        totals = [_counts([x for o, x in zip(of, parts, strict=True) if o == k]) for k in range(order)]
        counted = counted_of(texts)
        text, times = counted.text, totals[0][counted.place[0][:len(counted.text.token)]]
        model = answers.column("model")[0].as_py() or {"masses": masses([], order), "n": 0, "v": 0}  # null: no training rows
        n, whole = model["n"], model["n"] + model["v"] + 1
        made = Automaton(counted, totals, model["masses"], whole).walk()
        known, base = (np.add.reduceat(x, text.starts) for x in ((times > 0).astype(np.int64), np.log10((times + 1) / whole)))
        return pa.table([*(texts.column(f.name) for f in kept), texts.column("training"),
                         pa.array(text.ends - text.starts, pa.int64()), pa.array(known, pa.int64()),
                         pa.array([n] * len(made), pa.int64()), pa.array(base, pa.float64()), pa.array(made, pa.float64())],
                        names=[*(f.name for f in kept), "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    asked = dealt.groupBy("block").applyInArrow(ask, "k int, bucket long, block int, keys binary, counts binary")
    buckets_of = asked.groupBy("k", "bucket")
    answered = buckets_of.applyInArrow(answer, "block int, k int, bucket long, totals binary")
    # Both read one exchange; what reaches the one task is a table of fixed size.
    solved = (buckets_of.applyInArrow(tally, "length int, ended boolean, class int, times long, total long")
              .groupBy("length", "ended", "class").agg(F.sum("times").alias("times"), F.sum("total").alias("total"))
              .select(*(F.col(c).cast("long") for c in counters)).repartition(1).mapInArrow(solve, "masses array<double>, n long, v long"))
    answered = answered.withColumn("model", solved.select(F.struct("masses", "n", "v")).scalar())
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(place, schema)

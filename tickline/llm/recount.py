"""Edit-aware token counts: a segment tree of pre-tokens per document.

A document's text is cut into pre-tokens; each leaf of its tree holds a run of
them (length in characters and number of tokens), each inner node the sums of
its two children. An edit (start, removed, inserted), in characters of the
text as edited so far, is looked up by descending the tree. Re-encoding starts
at the first pre-token whose match could have looked at the edited place and
stops at the first new boundary that is an old boundary behind the edit, since
from there on the pattern sees the same text. Only the leaves in between are
replaced, and sums are renewed along their paths to the root.

`plant` encodes every text once and gives its leaves, packed, as a column, to be
written with the text. `recount` takes such a table and encodes what edits touch, nothing
else; it gives the renewed leaves back, so that further edits can follow.

Null texts are empty, an empty text has one empty leaf, and a very long text has
more leaves. An empty table gives an empty one; columns of the input that are
named like a result are replaced. Starts and lengths out of range are moved into the text;
a null edit list, a null edit and a null insertion change nothing; other nulls
in an edit count as 0. Rows are handled one by one, so repeated rows and null
ids stay.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.bytepairs import LOOKAHEAD, BytePairs, load
from tickline.llm.common import map_texts

LEAF = 64  # pre-tokens in a leaf at first

_EDIT = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("removed", T.IntegerType()),
                      T.StructField("inserted", T.StringType())])


class Tree:
    """Sums of characters and tokens over a document's pre-tokens."""

    def __init__(self, text: str, vocabulary: BytePairs, leaves: list[tuple[list[int], list[int]]] | None = None):
        """From the leaves that a former tree of this text had; without them all of it is encoded."""
        self.text, self.vocabulary = text, vocabulary
        if leaves is None:
            pretokens = vocabulary.pattern.findall(text)
            lengths, counts = [*map(len, pretokens)], [*map(vocabulary.count, pretokens)]
            leaves = [(lengths[i:i + LEAF], counts[i:i + LEAF]) for i in range(0, len(pretokens), LEAF)]
        self.leaves = leaves or [([], [])]
        self.pretokens, self.encoded = sum(len(a) for a, _ in self.leaves), 0
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size = size
        level = np.zeros((size, 2), np.int64)
        level[:len(self.leaves)] = [(sum(a), sum(b)) for a, b in self.leaves]
        levels = [level]
        while len(level) > 1:
            level = level[::2] + level[1::2]
            levels.append(level)
        self.nodes = np.concatenate([np.zeros((1, 2), np.int64), *reversed(levels)])  # children of i: 2i, 2i + 1

    def even_leaves(self) -> list[tuple[list[int], list[int]]]:
        """The leaves, cut anew so that none is empty or has outgrown its size."""
        if all(0 < len(a) <= 2 * LEAF for a, _ in self.leaves):
            return self.leaves
        lengths, counts = ([x for leaf in self.leaves for x in leaf[i]] for i in (0, 1))
        return [(lengths[i:i + LEAF], counts[i:i + LEAF]) for i in range(0, len(lengths), LEAF)] or [([], [])]

    @property
    def tokens(self) -> int:
        return int(self.nodes[1, 1])

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf with character `at` (the last one for the end) and where that leaf starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at >= start + self.nodes[node, 0] and self.nodes[node + 1, 0]:
                start += int(self.nodes[node, 0])
                node += 1
        return node - self.size, start

    def _renew(self, leaf: int) -> None:
        node = leaf + self.size
        self.nodes[node] = sum(self.leaves[leaf][0]), sum(self.leaves[leaf][1])
        while node > 1:
            node //= 2
            self.nodes[node] = self.nodes[2 * node] + self.nodes[2 * node + 1]

    def edit(self, start: int, removed: int, inserted: str) -> None:
        old = self.text
        start = min(max(start, 0), len(old))
        removed = min(max(removed, 0), len(old) - start)
        if not removed and not inserted:
            return
        text = self.text = old[:start] + inserted + old[start + removed:]
        shift = len(inserted) - removed
        # The first pre-token that may have looked at the edited place.
        leaf, at = self._find(max(0, start - LOOKAHEAD - 1))
        place = 0
        lengths = self.leaves[leaf][0]
        while place < len(lengths) and at + lengths[place] + LOOKAHEAD <= start:
            at += lengths[place]
            place += 1
        # Old boundaries from there on, and new pre-tokens, until the two meet.
        last, gone, edge = leaf, place, at
        made_lengths: list[int] = []
        made_counts: list[int] = []
        here, done = at, False
        while not done:
            if here >= start + len(inserted):
                while edge + shift < here and last < len(self.leaves):
                    if gone < len(self.leaves[last][0]):
                        edge += self.leaves[last][0][gone]
                        gone += 1
                    elif last + 1 < len(self.leaves):
                        last, gone = last + 1, 0
                    else:
                        break
                done = edge + shift == here and edge >= start + removed
            if not done:
                match = self.vocabulary.pattern.match(text, here)
                if match is None:
                    break
                made_lengths.append(match.end() - here)
                made_counts.append(self.vocabulary.count(match[0]))
                here = match.end()
        self.encoded += len(made_lengths)
        self.pretokens += len(made_lengths)
        head, tail = self.leaves[leaf], self.leaves[last]
        self.pretokens -= (gone - place if last == leaf else len(head[0]) - place + gone
                           + sum(len(self.leaves[i][0]) for i in range(leaf + 1, last)))
        if last == leaf:
            self.leaves[leaf] = ([*head[0][:place], *made_lengths, *head[0][gone:]],
                                 [*head[1][:place], *made_counts, *head[1][gone:]])
        else:
            self.leaves[leaf] = ([*head[0][:place], *made_lengths], [*head[1][:place], *made_counts])
            for i in range(leaf + 1, last):
                self.leaves[i] = ([], [])
            self.leaves[last] = (tail[0][gone:], tail[1][gone:])
        for i in range(leaf, last + 1):
            self._renew(i)


def plant(df: DataFrame, vocabulary_path: str, text_col: str = "text") -> DataFrame:
    """`df` with `tree`, the leaves of every text's tree. One pass, no shuffle."""
    def make():
        vocabulary = load(vocabulary_path)

        def run(texts):
            return [[_stored(Tree(text or "", vocabulary).leaves) for text in texts]]
        return run

    return map_texts(df, text_col, T.StructType([T.StructField("tree", T.BinaryType())]), make)


def _stored(leaves: list[tuple[list[int], list[int]]]) -> bytes:
    """Leaves as bytes: their number and sizes, all lengths, all counts; small numbers pack well."""
    numbers = np.array([len(leaves), *(len(a) for a, _ in leaves),
                        *(x for a, _ in leaves for x in a), *(x for _, b in leaves for x in b)], "<u4")
    return zlib.compress(numbers.tobytes(), 1)


def _leaves(stored: bytes) -> list[tuple[list[int], list[int]]]:
    numbers = np.frombuffer(zlib.decompress(stored), "<u4")
    ends = np.cumsum(numbers[1:1 + numbers[0]])[:-1]
    lengths, counts = np.split(numbers[1 + numbers[0]:], 2)
    return [(a.tolist(), b.tolist()) for a, b in zip(np.split(lengths, ends), np.split(counts, ends), strict=True)]


def recount(df: DataFrame, edits: Column, vocabulary_path: str, text_col: str = "text",
            tree_col: str | None = None) -> DataFrame:
    """`df` with edited (the text after all
    edits), n_before, n_after (tokens), n_pretokens (after), n_encoded (pre-tokens
    encoded anew by the edits) and the renewed tree.

    `edits` is an array of (start, removed, inserted), applied in order. `tree_col`
    names the leaves that `plant`, or a former call, gave for the text; without it
    every text is encoded first. To edit further, take `edited` as the text and
    `tree` as its leaves. One pass, no shuffle.
    """
    results = T.StructType([T.StructField("edited", T.StringType()), T.StructField("n_before", T.LongType()),
                            T.StructField("n_after", T.LongType()), T.StructField("n_pretokens", T.LongType()),
                            T.StructField("n_encoded", T.LongType()), T.StructField("tree", T.BinaryType())])

    def make():
        vocabulary = load(vocabulary_path)

        def run(texts, changes, trees):
            rows = []
            for text, edits, leaves in zip(texts, changes, trees, strict=True):
                tree = Tree(text or "", vocabulary, leaves and _leaves(leaves))
                before = tree.tokens
                for edit in edits or ():
                    if edit is not None:
                        tree.edit(edit["start"] or 0, edit["removed"] or 0, edit["inserted"] or "")
                rows.append((None if text is None and not edits else tree.text, before, tree.tokens, tree.pretokens,
                             tree.encoded, _stored(tree.even_leaves())))
            return [list(x) for x in zip(*rows, strict=True)] or [[]] * 6
        return run

    held = F.lit(None).cast("binary") if tree_col is None else F.col(f"`{tree_col}`")
    return map_texts(df.withColumns({"__edits": edits.cast(T.ArrayType(_EDIT)), "__leaves": held}), text_col, results, make,
                     more=("__edits", "__leaves")).drop("__edits", "__leaves")


def sample_edits(id_col: str = "doc_id", text_col: str = "text", count: int = 3) -> Column:
    """Edits for trials: by hashes of the id, up to 24 characters at a place of the
    text give way to up to 24 characters from another place."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    draw = lambda i, k, limit: F.pmod(F.xxhash64(F.col(id_col), F.lit(i), F.lit(k)), limit).cast("int")
    return F.array(*(F.struct(draw(i, 0, F.length(text) + 1).alias("start"), draw(i, 1, F.lit(25)).alias("removed"),
                              F.substring(text, draw(i, 2, F.length(text) + 1) + 1, draw(i, 3, F.lit(25))).alias("inserted"))
                     for i in range(count)))

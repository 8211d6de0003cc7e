"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

For byte-pair merging, the encoding of a prefix ends in exactly one token. The
table holds that token for every prefix. A token that an automaton finds at the
end of a prefix is the one if the prefix before it ends in a token that may
stand next to it: the two, encoded together, must give the same two again. The
ids are then read backwards. One pass over the text, no merge queue, and time
in proportion to the length, also without spaces.

Merges never join a character with a space mark after it, and never cross a
line feed, as no piece has such a pair inside (checked when the model is read);
nor do they pass from a letter to a sign where no piece does.
So the text falls into words that are encoded one by one, and words met before
are looked up.

Null and empty texts give the end id alone (if asked for) and decode to "".
Texts of any length are encoded whole; characters that the vocabulary lacks
become byte pieces. Rows are handled one by one: repeated rows and rows with
null ids stay. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.common import cached, map_texts

SPACE = "▁"
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalpha())
_BYTES, _OPEN = -1, -2


class _Memo(dict):
    """A dict that computes missing values and forgets all at `limit` entries."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self._compute, self._limit = compute, limit

    def __missing__(self, key):
        value = self._compute(key)
        if len(self) >= self._limit:
            self.clear()
        self[key] = value
        return value


@dataclass
class PieceModel:
    """The pieces of a SentencePiece BPE model with byte fallback and no normalisation."""

    path: str
    memo_words: int = 250_000
    memo_pairs: int = 300_000
    id_of: dict[str, int] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        library = sentencepiece.SentencePieceProcessor(model_file=self.path)
        count = library.get_piece_size()
        self.end = library.eos_id()
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        is_byte = set(self.byte_ids)
        self.output: list[bytes] = [b""] * count
        rank = {}
        for i in range(count):
            piece = library.id_to_piece(i)
            if i in is_byte:
                self.output[i] = bytes([self.byte_ids.index(i)])
            elif library.is_unknown(i):
                self.output[i] = " ⁇ ".encode()
            elif not library.is_control(i) and not library.is_unused(i):
                self.id_of[piece] = i
                rank[i] = -library.get_score(i)
                self.output[i] = piece.replace(SPACE, " ").encode()
        if any(("\n" in p and len(p) > 1) or SPACE in p.lstrip(SPACE)
               or (p.startswith(SPACE * 2) and p.strip(SPACE)) for p in self.id_of):
            raise ValueError("pieces with inner spaces or line feeds are not supported")
        signs = set(_SIGNS)  # with what stands before them in a piece, no piece turns to them from other characters
        while more := {a for p in self.id_of for a, b in zip(p, p[1:], strict=False)
                       if b in signs and a not in signs and a != SPACE}:
            signs |= more
        inside = re.escape("".join(sorted(signs)))
        self._split = re.compile(f"{SPACE}*[{inside}]*[^{SPACE}\n{inside}]+|{SPACE}*[{inside}]+|{SPACE}+|\n").findall
        self.run_ids = {len(p): i for p, i in self.id_of.items() if not p.strip(SPACE)}
        if 1 not in self.run_ids or len({rank[i] for n, i in self.run_ids.items() if n > 1}) > 1:
            raise ValueError("pieces of space marks must share one rank")
        self._rank_pieces(rank)
        self.words = _Memo(self._encode_word, self.memo_words)

    def _rank_pieces(self, rank: dict[int, float]) -> None:
        """Automaton over the pieces, each piece's rank and the pair that it is merged from."""
        pieces = [p for p in self.id_of if p.strip(SPACE) or p == SPACE]
        order = sorted(pieces, key=lambda p: (len(p) > 1, rank[self.id_of[p]], self.id_of[p]))
        self.tokens = [self.id_of[p] for p in order]
        self.texts = order
        self._known = {p for p in order if len(p) == 1}
        self._lengths = [len(p) for p in order]
        self.number = {p: k for k, p in enumerate(order)}
        self.parts: list[tuple[int, int]] = [(k, k) for k in range(len(order))]
        self.compatible = _Memo(self._compatible, self.memo_pairs)
        reachable = set()
        for k, piece in enumerate(order):  # by rank: the parts of a piece rank before it
            if len(piece) == 1:
                reachable.add(k)
                continue
            for cut in range(1, len(piece)):
                a, b = self.number.get(piece[:cut]), self.number.get(piece[cut:])
                if a in reachable and b in reachable and a < k and b < k and self._pair(a, b, k):
                    self.parts[k] = (a, b)
                    reachable.add(k)
                    break
        self.automaton = ahocorasick.Automaton()
        for k in reachable:
            self.automaton.add_word(order[k], k << 8 | len(order[k]))
        self.automaton.make_automaton()

    def _pair(self, a: int, b: int, limit: int) -> bool:
        """Do tokens a and b, side by side, stay apart under all merges that rank before `limit`?

        Undoes the later merge of the two first and looks at the pair at the
        seam: were it mergeable before the merge undone, a and b could not
        have come about. Of equal merges the left one goes first.
        """
        number, texts, parts = self.number, self.texts, self.parts
        while True:
            joint = number.get(texts[a] + texts[b])
            if joint is not None and joint < limit:
                return False
            if a > b:
                limit, a = a, parts[a][1]
                if a == limit:
                    limit, b = b + 1, parts[b][0]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, parts[b][0]
                if b + 1 == limit:
                    limit, a = a, parts[a][1]
                    if a == limit:
                        return True

    def _compatible(self, pair: int) -> bool:
        return self._pair(pair >> 20, pair & 0xFFFFF, len(self.tokens) + 1)

    def prefix_table(self, word: str) -> list[int]:
        """The last token's number of each prefix, the empty one first; -1: none, or bytes."""
        last = [_OPEN] * (len(word) + 1)
        last[0] = _BYTES
        if not self._known.issuperset(word):
            for i, char in enumerate(word, 1):
                if char not in self._known:
                    last[i] = _BYTES
        compatible = self.compatible
        for end, match in self.automaton.iter(word):
            end += 1
            if last[end] == _OPEN:
                before = last[end - (match & 255)]
                if before == _BYTES or compatible[before << 20 | match >> 8]:
                    last[end] = match >> 8
        return last

    def _ids(self, word: str) -> list[int]:
        table, back, at = self.prefix_table(word), [], len(word)
        while at:
            token = table[at]
            if token == _BYTES:
                at -= 1
                back.extend(self.byte_ids[b] for b in reversed(word[at].encode()))
            else:
                back.append(self.tokens[token])
                at -= self._lengths[token]
        return back[::-1]

    def _encode_word(self, word: str) -> bytes:
        """Ids, as packed int32, of space marks and the characters after them.

        Runs of space marks merge after everything else, from the left, so the
        last mark first joins the word where it can.
        """
        rest = word.lstrip(SPACE)
        marks = len(word) - len(rest)
        ids = self._ids(SPACE + rest if marks else rest) if rest else []
        if rest and marks:
            marks -= 1
            if ids[0] == self.run_ids[1]:
                marks, ids = marks + 1, ids[1:]
        return array("i", self._run_of_marks(marks) + ids).tobytes()

    def _run_of_marks(self, marks: int) -> list[int]:
        """All merges of marks rank alike, so the leftmost possible one is always next."""
        done: list[int] = []
        for _ in range(marks):
            done.append(1)
            while len(done) > 1 and done[-2] + done[-1] in self.run_ids:
                done[-2:] = [done[-2] + done[-1]]
        return [self.run_ids[n] for n in done]

    def encode(self, text: str | None, add_end: bool = True) -> np.ndarray:
        parts = []
        if text:
            words = self._split(SPACE + text.replace(" ", SPACE))
            parts = [*map(self.words.__getitem__, words)]
        if add_end:
            parts.append(np.array([self.end], np.int32).tobytes())
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids) -> bytes:
        """The text, as UTF-8. Bytes that form no character become U+FFFD one by one."""
        if isinstance(ids, np.ndarray):
            ids = ids.tolist()
        data = b"".join(map(self.output.__getitem__, ids))
        first = next((i for i in ids if self.output[i]), None)
        if first is not None and first not in self.byte_ids and data[:1] == b" ":
            data = data[1:]
        try:
            data.decode()
        except UnicodeDecodeError:
            data = data.decode("utf-8", "surrogateescape")
            data = re.sub("[\udc80-\udcff]", "�", data).encode()
        return data


_models: dict[str, PieceModel] = {}
cached("tickline.llm.pieces", _models.clear)


def load(path: str) -> PieceModel:
    """The model, read once per process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_decode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids",
                  decoded_col: str = "decoded", add_end: bool = True) -> DataFrame:
    """`df` with each text's ids (array of int) and the text that the ids decode to.

    Pieces are encoded in Arrow batches within the input's partitions. The
    model file must be at `model_path` on every executor.
    """
    results = T.StructType([T.StructField(ids_col, T.ArrayType(T.IntegerType(), True)),
                            T.StructField(decoded_col, T.StringType())])

    def make():
        model = load(model_path)

        def run(texts):
            rows = [model.encode(t, add_end) for t in texts]
            offsets = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(r) for r in rows], out=offsets[1:])
            ids = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))
            return [ids, pa.array([model.decode(r) for r in rows], pa.binary()).cast(pa.string())]
        return run

    return map_texts(df, text_col, results, make)


def digests(df: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Number of ids and SHA-256 of ids and decoded text, in place of the two."""
    return (df.withColumn("n_tokens", F.size(ids_col).cast("long"))
            .withColumn("ids_sha256", F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), " "), 256))
            .withColumn("decoded_sha256", F.sha2(F.col(decoded_col), 256))
            .drop(ids_col, decoded_col))

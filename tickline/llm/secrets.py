"""Secrets: three fixed formats, and strings that a primed compressor finds new.

Base spans are those of the fixed formats (`base_spans`) and always stay. The
method adds spans of kind "novel". Candidates are unbroken runs of `least` or
more key characters of two classes (small, capital, digit) in a sensitive
context: a cue word up to `REACH` characters before in the same line, or a
known prefix; addresses of short names are none. Each is measured by its marginal compressed bytes: the zstandard
size of the code around it with the candidate less that without it. The
compressor is primed with a dictionary of identifiers, so names made of known
words cost little, while random strings cost nearly a byte a character. A
candidate of at least `novelty` bytes a character is reported, or of `short`
bytes where it has under 48 characters, as a short name's few words cost more
a character, and the compressor can't yet profit from a small alphabet.

The dictionary holds common code words and the identifiers found most often
around candidates, counted over all documents, each distinct surrounding once
(`dictionary_words` of them, the only thing the driver collects). Candidates
are never part of it, so a secret copied a thousand times stays new.

Null and empty texts have no spans; an empty table gives no rows. Whole texts
are read, in time linear in their length. Rows are handled one by one: repeated
rows and null ids stay. Ties for the dictionary's last places go to the smaller
word. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.common import map_texts, written

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "novel")
REACH = 48  # code points before a candidate that may hold its cue
BEFORE, AFTER = 160, 80  # code points around a candidate that it is measured against

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}+")
# A match can't begin inside a run of its characters: it would have begun at the run's start.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}+")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.=~-])[A-Za-z0-9+/_.=~-]{12,}+")
_PIECES = re.compile(r"[./]")
_CLASSES = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))

# Words that go before secrets, prefixes of well-known kinds of keys, words of code.
CUES = ("passw", "passphrase", "pwd", "secret", "token", "api_key", "apikey", "api key", "api-key", "access_key", "access key",
        "private_key", "private key", "credential", "bearer", "authorization", "auth_", "client_id", "signature")
PREFIXES = ("ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "sk-", "xoxb-", "xoxp-", "AIza", "eyJ", "npm_", "pypi-")
CODE_WORDS = ("import return const public private static function class config client server user host port name value key "
              "string default true false null none self this url http https www com org net path file data json xml id "
              "example test local version password secret token api access auth bearer header content type application "
              "session cookie database connect open read write get set post put delete request response error")


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed formats, by start and then kind."""
    if not text:
        return []
    low = text.lower()
    found = []
    if any(word in low for word in ("passw", "secret", "token", "key")):
        found += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], BASE.index(x[2])))


def candidates(text: str | None, base: list[tuple[int, int, str]], least: int) -> list[tuple[int, int]]:
    """Key-like runs in a sensitive context that overlap no base span."""
    if not text:
        return []
    low = text.lower()
    if not any(cue in low for cue in CUES) and not any(p in text for p in PREFIXES):
        return []
    taken = sorted((s, e) for s, e, _ in base)
    reach = [e for _, e in taken]  # of spans by start, the furthest end so far
    for i in range(1, len(reach)):
        reach[i] = max(reach[i], reach[i - 1])
    found = []
    for m in _RUN.finditer(text):
        run = m[0].strip(".=~-/")
        start = m.start() + m[0].find(run)
        end = start + len(run)
        if len(run) < least or sum(bool(c.search(run)) for c in _CLASSES) < 2:
            continue
        if "." in run and "/" in run and max(map(len, _PIECES.split(run))) < 12:  # an address of short names
            continue
        i = bisect.bisect_left(taken, (end,))
        if i and reach[i - 1] > start:
            continue
        line = text[max(0, start - REACH):start].rsplit("\n", 1)[-1].lower()
        # A name joined to its value, as in token=value, has its cue inside the run.
        if run.startswith(PREFIXES) or any(cue in line or cue in run[:REACH].lower() for cue in CUES):
            found.append((start, end))
    return found


class Novelty:
    """Marginal compressed bytes of a string in its surroundings."""

    def __init__(self, words: list[str], level: int = 19):
        content = " ".join([*reversed(words), *CODE_WORDS.split()]).encode()  # what is frequent goes last, nearest
        primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self._compress = zstandard.ZstdCompressor(level=level, dict_data=primed, write_checksum=False,
                                                  write_content_size=False, write_dict_id=False).compress

    def bytes_of(self, value: str, before: str, after: str) -> int:
        """A lead-in of known words keeps the compressor from storing short texts as they are."""
        without, whole = (f"{CODE_WORDS} {before}{x}{after}".encode() for x in ("", value))
        return len(self._compress(whole)) - len(self._compress(without))


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType())])
_OPEN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                      T.StructField("value", T.StringType()), T.StructField("before", T.StringType()),
                      T.StructField("after", T.StringType())])


def _scan(df: DataFrame, text_col: str, least: int) -> DataFrame:
    """`df` without its text, with base spans and candidates in their surroundings."""
    results = T.StructType([T.StructField("base_spans", T.ArrayType(_SPAN)), T.StructField("spans", T.ArrayType(_OPEN))])

    def run(texts):
        bases = [base_spans(t) for t in texts]
        opened = []
        for text, base in zip(texts, bases, strict=True):
            opened.append([{"start": s, "end": e, "value": text[s:e], "before": text[max(0, s - BEFORE):s],
                            "after": text[e:e + AFTER]} for s, e in candidates(text, base, least)])
        return [[[{"kind": k, "start": s, "end": e} for s, e, k in base] for base in bases], opened]

    rest = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != text_col.lower()], F.col(f"`{text_col}`").alias("__text_in"))
    return map_texts(rest, "__text_in", T.StructType([*results, T.StructField("__text_in", T.NullType())]),
                     lambda: lambda texts: [*run(texts), [None] * len(texts)]).drop("__text_in")


def identifiers(scanned: DataFrame, words: int) -> list[str]:
    """The identifiers most often around candidates, each distinct surrounding counted once."""
    around = (scanned.select(F.explode("spans").alias("c"))
              .select(F.concat_ws(" ", "c.before", "c.after").alias("around")).distinct())
    key_like = r"[A-Za-z0-9_+/=~.-]"
    word = F.lit(rf"(?<!{key_like})[A-Za-z_]{{4,24}}(?!{key_like})")
    counted = around.select(F.explode(F.regexp_extract_all("around", word, F.lit(0))).alias("word")).groupBy("word").count()
    return [r.word for r in counted.orderBy(F.desc("count"), "word").limit(words).collect()]


def find(df: DataFrame, text_col: str = "text", least: int = 16, novelty: float = 0.65, short: float = 0.8,
         dictionary_words: int = 4096) -> DataFrame:
    """`df` without its text column, with `base_spans` and `spans`: arrays of (kind, start, end) in code points."""
    scanned = written(_scan(df, text_col, least), "secret_candidates")
    words = identifiers(scanned, dictionary_words)
    keep = [f for f in scanned.schema if f.name not in ("base_spans", "spans")]
    out = T.StructType([*keep, T.StructField("base_spans", T.ArrayType(_SPAN)), T.StructField("spans", T.ArrayType(_SPAN))])

    def run(batches):
        measure = Novelty(words)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = []
            for base, opened in zip(batch["base_spans"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                added = [{"kind": "novel", "start": c["start"], "end": c["end"]} for c in opened
                         if measure.bytes_of(c["value"], c["before"], c["after"])
                         >= (novelty if len(c["value"]) >= 48 else short) * len(c["value"])]
                spans.append(sorted([*base, *added], key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            yield pa.RecordBatch.from_arrays([*[batch[f.name] for f in keep], batch["base_spans"], pa.array(spans, kind)],
                                             names=out.names)

    return scanned.select(*[F.col(f"`{f.name}`") for f in keep], "base_spans", "spans").mapInArrow(run, out)


def digests(df: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text, in place of the arrays."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.filter("base_spans", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("base_spans", "spans")]
    return df.select(*rest, *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))

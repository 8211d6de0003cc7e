"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Base spans are those of four fixed formats (`base_spans`) and always stay. The
method adds spans: generators with high recall propose overlapping candidates
(anything shaped like an address, number group, key or token). Gradient-boosted
trees score each from its format and context, and those above a threshold per
kind are added, the highest score first, where they overlap nothing chosen yet.

Training needs no labelled table, and takes in all documents. In them base spans
are positive, and so are copies of them rewritten in another format ("+1 (743)
555-3824" as "743-555-3824", "a.b@c.org" as "a.b [at] c [dot] org"); quoted
keys after words such as "token" are positive secrets. Candidates of no valid
format are negative, as are random numbers put in place of base spans. The
threshold of a kind is the lowest score at which the documents that are kept
back, one in eight by a hash of the id, reach `precision`; a kind without a candidate there has the threshold
that all kinds together reach it at.

A null or empty text has no spans. Whole texts are read, in time linear in the
length. Rows are handled one by one: repeated rows and null ids stay.
"""

from __future__ import annotations

import bisect
import math
import random
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm.common import begin, map_texts, shared_dir, slices, written

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can't begin inside a run of digits: it would have begun at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """Every @ is the end of one local part, so each is tried once."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four base formats, by start and then kind."""
    if not text:
        return []
    found = [(s, e, "email") for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((*m.span(), "phone"))
    return sorted(found, key=lambda x: (x[0], BASE.index(x[2])))


# Candidates: wider than any kind, and overlapping. Fixed values.
_GENERATORS = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]++\x20?(?:@|[\[(]at[\])])\x20?"
                        r"[\w-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[\w-]++)++"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
                     r"|(?<![0-9.])[0-9]{1,3}(?:[.,]\x20?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,2}[0-9]{2,6}){2,5}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\(|00|\+)?[0-9]{2,4}[)\x20./-]{1,3}[0-9]{2,4}(?:[\x20./-]{1,2}[0-9]{2,5}){1,3}(?![0-9])"),
    "secret": re.compile(r"(?<![0-9A-Za-z])[0-9A-Za-z_+/=-]{20,}+(?![0-9A-Za-z])"),
}
_NEEDS = {"email": re.compile(r"@|[\[(]at[\])]"), "card": re.compile(r"[0-9]{4}"), "phone": re.compile(r"[0-9]{2}"),
          "ip": re.compile(r"[0-9][.,:]|[0-9A-Fa-f]:[0-9A-Fa-f]"),
          "secret": re.compile(r"[0-9][A-Za-z_+/=-]*[0-9]")}
_CUES = {  # words that go before a kind; fixed values
    "email": ("mail", "contact", "write", "address"), "ip": ("ip", "host", "server", "address", "ping"),
    "card": ("card", "visa", "account", "iban", "credit"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "secret": ("token", "key", "secret", "password", "passwd", "auth"),
}


def candidates(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), kind) for kind, pattern in _GENERATORS.items() if _NEEDS[kind].search(text)
            for m in pattern.finditer(text)]


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Numbers on a span's format, then on its context."""
    span = text[start:end]
    digits = _digits(span)
    letters = sum(c.isalpha() for c in span)
    counts = [span.count(c) for c in set(span)]
    entropy = -sum(c / len(span) * math.log2(c / len(span)) for c in counts)
    groups = re.findall(r"[0-9]+", span)
    before, after = text[max(0, start - 24):start].lower(), text[end:end + 12].lower()
    return [
        float(KINDS.index(kind)), float(len(span)), float(len(digits)), float(letters),
        float(len(groups)), float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        entropy, float(luhn(digits) and 12 <= len(digits) <= 19),
        float(all(int(g[-4:]) <= 255 and len(g) <= 3 for g in groups) and bool(groups)),
        float(all(c in "0123456789abcdefABCDEF" for c in span)), float(span[:1] == "+"), float("(" in span),
        float("@" in span), float(span.count(".")), float(span.count("-")), float(span.count(" ")),
        float(span.count(":")),
        float(any(c in before for c in _CUES[kind])), float(before[-1:] in "\"'="), float(after[:1] in "\"'"),
        float("=" in before[-6:] or ":" in before[-4:]), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(sum(c.isdigit() for c in before + after)), float(sum(c.isalpha() for c in before + after)),
    ]


N_FEATURES = len(features("0", 0, 1, "card"))


@dataclass
class Trees:
    """Boosted trees as arrays: tree x node; `left` is 0 at leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    cut: dict[str, float]

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(rows))
        at = np.arange(len(rows))
        for t, weight in enumerate(self.weight):
            node = np.zeros(len(rows), np.int64)
            while (inner := self.left[t, node] > 0).any():
                goes = rows[at, self.feature[t, node]] <= self.threshold[t, node]
                node = np.where(inner, np.where(goes, self.left[t, node], self.right[t, node]), node)
            margin += weight * self.value[t, node]
        return 1 / (1 + np.exp(-2 * margin))


def _rewritten(span: str, kind: str, pick: random.Random) -> str:
    """A base span in a format that the base patterns miss."""
    digits = _digits(span)
    if kind == "email":
        local, domain = span.rsplit("@", 1)
        left, right = pick.choice([("[", "]"), ("(", ")")])
        return f"{local} {left}at{right} " + f" {left}dot{right} ".join(domain.split("."))
    if kind == "phone":
        last = digits[-10:]
        return pick.choice([f"({last[:3]}) {last[3:6]}-{last[6:]}", f"{last[:3]}-{last[3:6]}-{last[6:]}",
                            f"{last[:3]}.{last[3:6]}.{last[6:]}", f"00{digits[:2]} {last[:3]} {last[3:6]} {last[6:]}"])
    if kind == "card":
        sep = pick.choice(["/", ".", "_", "  "])
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    parts = span.split(".")
    return pick.choice([", ".join(parts), ":".join(f"{int(p[-4:]):x}" for p in parts * 2)])


def _decoy(kind: str, pick: random.Random) -> str:
    number = "".join(pick.choice("0123456789") for _ in range(pick.randint(8, 20)))
    return pick.choice([
        number, f"{number[:4]}-{number[4:6]}-{number[6:8]} {number[8:10]}:{number[2:4]}:{number[:2]}",
        f"{number[:4]}.{number[4:6]}.{number[6:]}", f"{number[:3]},{number[3:6]},{number[5:8]}.{number[:2]}",
        f"{number[:4]}/{number[4:]}", " ".join(number[i:i + 2] for i in range(0, 8, 2)),
        f"v{number[0]}.{number[1]}.{number[2]}.{number[3:]}", "".join(pick.choice("abehinorst") for _ in range(24))])


def training_rows(text: str, seed: int) -> list[tuple[list[float], float, str]]:
    """(features, label, kind) of a document's candidates, as it is and with rewritten spans."""
    pick, made = random.Random(seed), []
    spans = base_spans(text)
    kept, done, replaced = [], 0, []
    for start, end, kind in spans:
        if start < done:
            continue
        kept.append(text[done:start])
        for new, label in ((_rewritten(text[start:end], kind, pick), 1.0), (_decoy(kind, pick), 0.0)):
            at = sum(map(len, kept))
            kept.append(new + " ")
            replaced.append((at, at + len(new), kind, label))
        done = end
    changed = "".join([*kept, text[done:]])
    for source, known in ((text, [(*s, 1.0) for s in spans]), (changed, replaced)):
        starts = sorted(known)
        for start, end, kind in candidates(source):
            near = [k for k in starts[max(0, bisect.bisect(starts, (start,)) - 2):bisect.bisect(starts, (end,))]
                    if k[0] < end and start < k[1]]
            same = [k for k in near if k[2] == kind]
            if same:
                label = max(k[3] for k in same)
            elif kind == "secret":
                before = source[max(0, start - 24):start].lower()
                label = float(any(c in before for c in _CUES[kind]) and before[-1:] in "\"'= "
                              and any(c.isdigit() for c in source[start:end]))
            else:
                label = 0.0
            made.append((features(source, start, end, kind), label, kind))
    return made


def fit(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
        rounds: int = 20, depth: int = 4, precision: float = 0.99) -> Trees | None:
    """Train on the candidates of all documents with three digits or an @; None if there is no candidate.

    A hash of the id (of the text, if it has none) keeps some back. The candidates' features are
    written once, a few numbers each. The trees are bounded (`rounds` of `depth`), and so is what the
    driver collects: tree nodes and the kept-back scores in 1,000 steps per kind.
    """
    text = F.col(f"`{text_col}`").cast("string")
    key = F.xxhash64(F.coalesce(F.col(f"`{id_col}`").cast("string"), text))
    rows = df.select(text.alias("text"), key.alias("key")).where("text rlike '[0-9]{3}|@'")

    def examples(batches):
        begin("tickline.llm.pii")
        for batch in slices(batches, 0):
            made = [(*row, seed & 7) for t, seed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for row in training_rows(t, seed)]
            if made:
                x, label, kind, part = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.list_(pa.float64())), pa.array(label), pa.array(kind), pa.array(part, pa.int32())],
                    names=["x", "label", "kind", "part"])

    made = written(rows.mapInArrow(examples, "x array<double>, label double, kind string, part int"), "pii_examples")
    made = made.withColumn("features", array_to_vector("x"))
    labels = made.where("part <> 0").agg(F.count("*"), F.min("label"), F.max("label")).first()
    if not labels[0] or labels[1] == labels[2]:
        return None
    gbt = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7, maxBins=32, cacheNodeIds=False)
    model = gbt.fit(made.where("part <> 0"))
    path = shared_dir(df.sparkSession, "pii_trees")
    model.save(path)
    nodes = df.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    shape = (max(n.treeID for n in nodes) + 1, max(n.id for n in nodes) + 1)
    trees = Trees(np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape, np.int64),
                  np.zeros(shape), np.array(model.treeWeights), {})
    for n in nodes:
        trees.value[n.treeID, n.id] = n.prediction
        if n.leftChild >= 0:
            trees.feature[n.treeID, n.id] = n.split.featureIndex
            trees.threshold[n.treeID, n.id] = n.split.leftCategoriesOrThreshold[0]
            trees.left[n.treeID, n.id], trees.right[n.treeID, n.id] = n.leftChild, n.rightChild

    def scored(batches):
        for batch in batches:
            score = trees.score(np.array(batch.column(0).to_pylist(), float).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array((score * 1000).astype(np.int32))],
                                             names=["label", "kind", "step"])

    steps = (made.where("part = 0").select("x", "label", "kind").mapInArrow(scored, "label double, kind string, step int")
             .groupBy("kind", "step").agg(F.sum("label"), F.count("*")).collect())
    for kind in KINDS:
        own = [s for s in steps if s[0] == kind] or steps
        right = total = 0.0
        cut = 2.0  # no score reached the precision
        for step in sorted({s[1] for s in own}, reverse=True):
            right += sum(s[2] for s in own if s[1] == step)
            total += sum(s[3] for s in own if s[1] == step)
            if right >= precision * total and step >= 500:
                cut = step / 1000
        trees.cut[kind] = cut
    return trees


def spans_of(text: str | None, trees: Trees | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans: base and added ones."""
    base = base_spans(text)
    if not text or trees is None:
        return base, base
    taken = sorted((s, e) for s, e, _ in base)
    reach = [e for _, e in taken]  # of spans by start, the furthest end so far
    for i in range(1, len(reach)):
        reach[i] = max(reach[i], reach[i - 1])

    def free(start, end):
        i = bisect.bisect_left(taken, (end,))
        return i == 0 or reach[i - 1] <= start

    open_ = [c for c in candidates(text) if free(c[0], c[1])]
    if not open_:
        return base, base
    scores = trees.score(np.array([features(text, *c) for c in open_]))
    chosen: list[tuple[int, int, str]] = []
    edges: list[tuple[int, int]] = []
    for score, span in sorted(zip(scores.tolist(), open_, strict=True), key=lambda x: (-x[0], x[1])):
        if score < trees.cut[span[2]]:
            continue
        i = bisect.bisect(edges, (span[0], span[1]))
        if (i and edges[i - 1][1] > span[0]) or (i < len(edges) and edges[i][0] < span[1]):
            continue
        edges.insert(i, span[:2])
        chosen.append(span)
    return base, sorted([*base, *chosen], key=lambda x: (x[0], KINDS.index(x[2])))


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType())])


def find(df: DataFrame, trees: Trees | None, text_col: str = "text") -> DataFrame:
    """`df` with `base_spans` and `spans`: arrays of (kind, start, end) in code points."""
    results = T.StructType([T.StructField("base_spans", T.ArrayType(_SPAN)), T.StructField("spans", T.ArrayType(_SPAN))])
    as_rows: Callable = lambda spans: [{"kind": k, "start": s, "end": e} for s, e, k in spans]

    def run(texts):
        both = [spans_of(t, trees) for t in texts]
        return [[as_rows(b) for b, _ in both], [as_rows(a) for _, a in both]]

    return map_texts(df, text_col, results, lambda: run)


def redact(df: DataFrame, trees: Trees | None, text_col: str = "text") -> DataFrame:
    """`df` with every span of the text replaced by its kind in angle brackets; nulls stay."""
    field = next(f for f in df.schema if f.name.lower() == text_col.lower())

    def run(texts):
        made = []
        for text in texts:
            parts, done = [], 0
            for start, end, kind in spans_of(text, trees)[1]:
                if start >= done:
                    parts += [text[done:start], f"<{kind}>"]
                done = max(done, end)
            made.append(text if text is None or not parts else "".join([*parts, text[done:]]))
        return [made]

    out = map_texts(df, text_col, T.StructType([T.StructField(field.name, T.StringType())]), lambda: run)
    return out.select(*df.columns)


def digests(df: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text, in place of the arrays."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.filter("base_spans", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE]
    rest = [c for c in df.columns if c not in ("base_spans", "spans")]
    return df.select(*rest, *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"),
                     joined("spans").alias("spans"))

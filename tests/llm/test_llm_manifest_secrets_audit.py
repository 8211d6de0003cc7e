"""Merkle manifest, secrets and filter audit against brute force, with odd rows."""

import collections
import hashlib
import itertools
import random
import re
import string
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm_edges import DOCS, nothing, odd, prose, table  # noqa: F401

from tickline.llm import audit, merkle, secrets
from tickline.llm.common import shared_dir
from tickline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_path(levels, i):
    steps = []
    for level in levels[:-1]:
        run = level[i - i % 16:i - i % 16 + 16]
        steps.append(("".join(run[:i % 16]), "".join(run[i % 16 + 1:])))
        i //= 16
    return steps


def plain_proofs(rows):
    """(id, leaf, subroot, root, steps) of every row; ties of ids by leaf."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for _, _, leaf, _ in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = plain_tree([trees[s][-1][0] for s in names])
    return [(row["doc_id"], leaf, trees[s][-1][0], top[-1][0], plain_path(trees[s], i) + plain_path(top, k))
            for k, s in enumerate(names) for i, (_, _, leaf, row) in enumerate(sorted(groups[s], key=lambda x: x[:3]))]


def proofs_of(df, **options):
    return [(r.id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path])
            for r in merkle.prove(merkle.build(df, FIELDS, **options)).collect()]


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_proofs_equal_whole_trees(table, levels):  # noqa: F811
    pick = random.Random(levels)
    rows = [(i, f"text {i}", "en", "big", i) for i in range(600)]
    rows += [(i, "x", None, f"s{pick.randint(0, 40)}", None) for i in range(100)]
    rows += [(7, "again", "en", "big", 1)] * 40 + [(None, None, None, None, None)] * 3 + [(None, "t", None, "big", None)]
    pick.shuffle(rows)
    df = table(rows, DOCS)
    expected = plain_proofs([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows])
    assert sorted(proofs_of(df, levels=levels), key=repr) == sorted(expected, key=repr)


def test_proofs_of_odd_rows_and_empty_tables(odd, nothing):  # noqa: F811
    clash = odd.withColumn("group", F.lit(1)).withColumn("path", F.lit("x")).withColumn("index", F.lit(2))
    expected = plain_proofs([r.asDict() for r in odd.collect()])
    assert sorted(proofs_of(clash), key=repr) == sorted(expected, key=repr)
    assert proofs_of(nothing) == []


def test_manifest_query_finds_tampering(spark):
    docs = {r.doc_id: r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    expected = {p[0]: p for p in plain_proofs(docs.values())}
    got = QUERIES["op12_merkle"](spark, SF).collect()
    assert {r.doc_id for r in got} == docs.keys() and len(got) == len(docs)
    for r in got:
        _, leaf, subroot, root, steps = expected[r.doc_id]
        row = docs[r.doc_id]
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"] or "")
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and row["text"] is not None
        folded = plain_leaf({**row, "text": low}) if changed else leaf
        for left, right in steps:
            folded = sha(left + folded + right)
        assert (r.leaf, r.subroot, r.root, r.folded_root) == (leaf, subroot, root, folded)
        assert r.proof_sha256 == sha("".join(a + b for a, b in steps))
        assert r.verified == (not changed or low == row["text"])
    assert any(not r.verified for r in got)


# Secrets

_CASES = "".join
PLAIN = {
    "assign": "(" + "|".join(_CASES(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in
                             ("password", "passwd", "secret", "token")) + """|[aA][pP][iI]_?[kK][eE][yY])"""
              + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            long = {"assign": 12, "access": 18, "hex": 16}[kind]
            if len(m[2] if kind == "assign" else m[0]) >= long:
                found.append((m.start(), order, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(found)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "API_KEY", "passwd", "paſſword", "=", ": ", '"', "'", " ", "AKIA", "AKIAAKIA",
                                 "0123456789abcdef", "abcdef012", "ABCDEFGH1234567", "x", "é😀", "token=password= ", "\n"]), max_size=25))
def test_base_spans_equal_plain_patterns(parts):
    text = "".join(parts)
    assert secrets.base_spans(text) == plain_spans(text)


def random_key(seed, n, letters=string.ascii_letters + string.digits):
    pick = random.Random(seed)
    return "".join(pick.choice(letters) for _ in range(n))


def test_new_strings_in_sensitive_context_are_found_and_names_are_not(table, prose, nothing):  # noqa: F811
    keys = {i: random_key(i, n) for i, n in enumerate([20, 24, 40, 129, 300, 5000])}
    lines = {i: f"{prose(i, 80)}\nauthorization: Bearer {key}\n{prose(i + 50, 30)}" for i, key in keys.items()}
    copied = random_key(99, 32)
    rows = list(lines.items()) + [(100 + i, f"{prose(3, 20)} use pwd {copied} now") for i in range(60)]
    names = ["the session_timeout_2 of this client_id", "pwd reset: read test_password_file2 first",
             "bearer of application_config_version2", "see token docs at example.com/test/path/file2"]
    rows += [(200 + i, t) for i, t in enumerate(names)]
    rows += [(300, f"an ordinary id {random_key(5, 30)} without any cue"), (301, None), (302, ""), (None, "pwd " + keys[0])]
    df = table(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = secrets.find(df).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        novel = [text[s.start:s.end] for s in r.spans if s.kind == "novel"]
        key = keys.get(r.doc_id, copied if 100 <= (r.doc_id or 0) < 200 else keys[0] if r.doc_id is None else None)
        assert novel == ([key] if key else []), (r.doc_id, novel)
    assert secrets.find(nothing).collect() == []


def test_secret_query_keeps_base_spans(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_secrets"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        base = plain_spans(texts[r.doc_id])
        joined = [f"{k}:{s}:{e}" for s, e, k in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for *_, k in base) for x in PLAIN)
        assert r.base_sha256 == sha(",".join(joined))
        assert set(joined) <= set(r.spans.split(",")) | {""}


# Filter audit

def plain_mask(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    fails = [len(words) < 50, 100 * len(set(words)) < 65 * len(words),
             100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text))]
    return sum(1 << i for i, f in enumerate(fails) if f)


def plain_report(rows, labels):
    """rows: (id, text, source); every order and step by running the filters."""
    least, marked = {}, []
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    for i, text, source in rows:
        same = i is not None and least[text or ""] < i
        good, toxic = (any(x[k] == 1 for x in labels.get(i, [])) for k in (0, 1))
        marked.append((source or "", plain_mask(text or "") | 16 * same, good, toxic))
    out, removed_in_all = {}, collections.Counter()
    for order in itertools.permutations("ABCDE"):
        for part in {m[0] for m in marked}:
            left = [m for m in marked if m[0] == part]
            gone = []
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                fails = [m for m in left if m[1] & bit]
                redundant = sum(bool(m[1] & bit) for m in gone)
                left = [m for m in left if not m[1] & bit]
                gone += fails
                only = sum(m[0] == part and m[1] == bit for m in marked)
                removed_in_all[part, letter] += len(fails)
                out[part, "".join(order), step] = (len(left), len(fails), redundant, only,
                                                   sum(m[2] for m in fails), sum(m[3] for m in fails), letter)
    return sorted((*k, *v[:6], removed_in_all[k[0], v[6]]) for k, v in out.items())


def reported(df):
    return sorted(tuple(r) for r in df.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                              "good_lost", "toxic_lost", "shapley").collect())


def test_audit_retracts_when_smaller_ids_arrive_later(spark, prose):  # noqa: F811
    """Each file holds smaller ids than those before it, with texts of earlier files."""
    pick = random.Random(4)
    texts = [prose(i, 60) for i in range(6)] + [prose(9, 10), "A#B " * 60, None, "", prose(11, 3000), "ABC DEF\t" + prose(12, 70)]
    rows = [(1000 - k, pick.choice(texts), pick.choice(["a", "b", None, ""])) for k in range(240)]
    rows += [(500 - k, texts[0], "hot") for k in range(120)] + [(380, texts[1], "a")] * 5 + [(None, texts[0], "b")] * 4
    labels = {i: [(pick.randint(0, 1), pick.randint(0, 1))] for i in range(400, 1000, 3)}
    labels[999] = [(0, 1), (1, 0), (None, None)]
    path = shared_dir(spark, "audit_docs")
    for k in range(0, len(rows), 80):
        spark.createDataFrame(rows[k:k + 80], "doc_id long, text string, source string").withColumn("n", F.lit("clash")) \
            .coalesce(1).write.mode("append").parquet(path)
    said = spark.createDataFrame([(i, *x) for i, xs in labels.items() for x in xs] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    expected = plain_report(rows, labels)
    for batches in (1, 5):
        assert reported(audit.report(audit.counters(spark, path, said, batches=batches, bucket_rows=4))) == expected


def test_audit_of_odd_and_empty_tables(spark, odd, nothing):  # noqa: F811
    said = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (odd, nothing):
        path = shared_dir(spark, "audit_odd")
        df.write.parquet(path)
        got = reported(audit.report(audit.counters(spark, path, said)))
        assert got == plain_report([(r.doc_id, r.text, r.source) for r in df.collect()], {})


def test_collapsed_rows_mean_the_same():
    schema = pa.schema([("text", pa.binary()), ("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()),
                        ("good", pa.int32()), ("toxic", pa.int32()), ("n", pa.int64())])
    rows = [(b"x", i, "p", 1, 0, 0, 1) for i in (5, 3, 9, 3)] + [(b"y", None, "q", 0, 1, 0, 2), (b"y", 4, "q", 0, 0, 0, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    got = [tuple(r.values()) for b in audit.collapse([batch, batch]) for r in b.to_pylist()]
    assert sorted(got, key=repr) == sorted([
        (b"x", 3, "p", 1, 0, 0, 4), (b"x", None, "p", 17, 0, 0, 4), (b"y", None, "q", 0, 1, 0, 4), (b"y", 4, "q", 0, 0, 0, 2)], key=repr)

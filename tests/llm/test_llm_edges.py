"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, per operator."""

import collections
import glob
import io
import math
import os
import random
import zipfile

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tickline.llm import (
    bitslices,
    decontaminate,
    langid,
    nearcopies,
    ngrams,
    ordering,
    pieces,
    pii,
    recount,
    warc,
)
from tickline.llm.bytepairs import PATTERN, load
from tickline.llm.common import written

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", "a", None), (2, None, "en", "a", None),
       (3, " \t\n", "fr", "a", 3), (4, "…—", None, "a", 2), (5, "x", "en", None, 1), (None, "word", "en", "a", 4)]


@pytest.fixture
def prose():
    """prose(seed, n) -> n words of invented text."""
    syllables = ["an", "the", "er", "on", "in", "re", "tion", "ou", "sh", "ble", "ly", "wh"]

    def make(seed, n):
        pick = random.Random(seed)
        return " ".join("".join(pick.choice(syllables) for _ in range(pick.randint(1, 4))) for _ in range(n))
    return make


@pytest.fixture
def table(spark):
    """table(rows, schema) -> a DataFrame that went through Parquet, as real input does."""
    return lambda rows, schema: written(spark.createDataFrame(rows, schema), "test_rows")


@pytest.fixture
def odd(table, prose):
    long = prose(1, 20_000)
    return table([*ODD, (6, long, "en", "a", 1), (6, long, "en", "a", 1), (7, "z" * 200_000, "en", "a", 1)], DOCS)


@pytest.fixture
def nothing(table):
    return table([], DOCS)


# 1. Bit-sliced search

def test_search_with_ties_nulls_and_repeats(table):
    pick = random.Random(5)
    rows = [(i, [pick.choice([-0.5, 0.0, 0.25, 0.75]) for _ in range(5)]) for i in range(300)]
    rows += [(0, rows[0][1]), (100, [0.1] * 5), (301, None), (302, [None] * 5), (303, [float("nan")] * 5),
             (304, [float("inf")] + [0.0] * 4), (None, [1.0] * 5), (305, [9.0, 9.0]), (306, [])]
    rows += [(400 + i, rows[7][1]) for i in range(200)]  # a third of all rows alike
    df = table([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = bitslices.search(df, F.col("vec_id") % 100 == 0, k=10, block_rows=64, pass_queries=3).collect()
    usable = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows
              if i is not None and v and len(v) == 5 and None not in v and np.isfinite(v).all()]
    expected = []
    for own, query in usable:
        if own % 100 == 0:
            best = sorted((-int(v @ query), i) for i, v in usable if i != own)[:10]
            expected += [(own, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(expected)
    assert bitslices.search(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_signed_digits_are_sparse_and_exact():
    for n in range(-700, 700):
        digits = bitslices.signed_digits(n)
        assert sum(-(1 << p) if minus else 1 << p for p, minus in digits) == n
        assert all(b[0] - a[0] > 1 for a, b in zip(digits, digits[1:], strict=False))


# 2. Token counts under edits

@settings(max_examples=150, deadline=None)
@given(st.text("ab '1é.\n\t😀s", max_size=300), st.lists(st.tuples(st.integers(-2, 320), st.integers(0, 40), st.text("a '\n1", max_size=8)), max_size=5))
def test_edited_trees_equal_whole_encoding(text, edits):
    vocabulary = load(RANKS)
    tree = recount.Tree(text, vocabulary)
    for edit in edits:
        tree.edit(*edit)
    assert tree.tokens == len(vocabulary.encoding.encode_ordinary(tree.text))
    assert [x for a, _ in tree.leaves for x in a] == [len(p) for p in vocabulary.pattern.findall(tree.text)]


def test_stored_trees_take_edits_and_encode_nothing_else(spark, tmp_path):
    """Two rounds of edits on written trees; the texts are only encoded when they are planted."""
    calls = []

    class Counting:
        def __init__(self, real):
            self.pattern, self.encoding, self.real = real.pattern, real.encoding, real

        def count(self, pretoken):
            calls.append(pretoken)
            return self.real.count(pretoken)

    vocabulary = Counting(load(RANKS))
    text = "one two  three, four 55 six\n" * 400
    tree = recount.Tree(text, vocabulary)
    assert len(calls) == tree.pretokens > 1000
    for at in (0, 5000, len(text)):
        calls.clear()
        tree = recount.Tree(tree.text, vocabulary, tree.even_leaves())
        tree.edit(at, 3, "new word ")
        assert 0 < len(calls) < 12
        assert tree.tokens == len(vocabulary.encoding.encode_ordinary(tree.text))
    tree.edit(0, 0, "many " * 1000)  # a leaf that grows is cut again
    leaves = tree.even_leaves()
    assert max(len(a) for a, _ in leaves) <= 2 * recount.LEAF
    assert recount.Tree(tree.text, vocabulary, leaves).tokens == tree.tokens

    docs = spark.createDataFrame([(1, text, "clash"), (2, None, "clash"), (3, "", None), (None, "a b", None), (1, text, "clash")],
                                 "doc_id long, text string, tree string")
    path = str(tmp_path / "trees")
    recount.plant(docs, RANKS).write.parquet(path)
    edit = F.array(F.struct(F.lit(1).alias("start"), F.lit(2).alias("removed"), F.lit("xyz ").alias("inserted")))
    first = recount.recount(spark.read.parquet(path), edit, RANKS, tree_col="tree")
    first.select("doc_id", F.col("edited").alias("text"), "tree", "n_after").write.parquet(path + "2")
    again = recount.recount(spark.read.parquet(path + "2").withColumnRenamed("n_after", "n_first"), edit, RANKS, tree_col="tree").collect()
    assert len(again) == 5
    for r in again:
        assert r.n_before == r.n_first and r.n_encoded < 10
        assert r.n_after == len(load(RANKS).encoding.encode_ordinary(r.edited))


def test_recount_edges(odd, nothing):
    edit = F.array(F.struct(F.lit(2).alias("start"), F.lit(1).alias("removed"), F.lit("new ").alias("inserted")))
    got = recount.recount(odd.withColumn("n_after", F.lit("clash")), edit, RANKS)
    rows = got.collect()
    assert len(rows) == odd.count() and len(set(got.columns)) == len(got.columns)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].edited == "new " and by_id[2].n_before == 0
    assert by_id[7].n_encoded < 10 and by_id[7].n_after == len(load(RANKS).encoding.encode_ordinary(by_id[7].edited))
    none = recount.recount(odd, F.lit(None), RANKS).collect()
    assert all(r.n_before == r.n_after and r.edited == r.text for r in none)
    assert recount.recount(nothing, edit, RANKS).collect() == []


# 3. Personal data

@settings(max_examples=300, deadline=None)
@given(st.text("a@.-+1 59(é", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    from test_llm_queries import brute_spans
    assert pii.base_spans(text) == brute_spans(text)


def test_pii_edges(odd, nothing, spark):
    assert pii.fit(nothing) is None
    assert {r.spans == [] for r in pii.find(odd, None).collect()} == {True}
    assert pii.redact(nothing, None).columns == nothing.columns
    assert sorted(map(repr, pii.redact(odd, None).collect())) == sorted(map(repr, odd.collect()))
    for text in ("1" * 100_000, "a" * 100_000, "1." * 50_000, "+1" * 50_000, "a@" * 50_000, "1 " * 50_000):
        assert len(pii.base_spans(text)) <= len(text)  # linear time


def test_trees_add_keys_and_redaction_covers_overlaps(table, prose):
    pick = random.Random(2)
    rows = []
    for i in range(240):
        key = "".join(pick.choice("0123456789abcdef") for _ in range(40))
        rows.append((i, f'{prose(i, 20)} +1 (555) 010-{1000 + i} token = "{key}" {prose(i + 999, 20)} a{i}@b.org {pick.randint(1, 9)}.5', "en", "a", 1))
    docs = table(rows, DOCS)
    trees = pii.fit(docs)
    found = pii.find(docs, trees).collect()
    assert sum(any(s.kind == "secret" for s in r.spans) for r in found) >= 0.9 * len(rows)
    for r in found:
        assert {tuple(s) for s in r.base_spans} <= {tuple(s) for s in r.spans}
    clean = pii.redact(docs, trees).collect()
    assert all("@" not in r.text and "555" not in r.text for r in clean)


# 4. Scores

def test_scores_edges(odd, nothing):
    got = ngrams.score(odd, F.lit(True)).collect()
    assert len(got) == odd.count()
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    alone = ngrams.score(odd, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known) for r in alone} == {(0, 0)}
    assert ngrams.score(nothing, F.lit(True)).collect() == []


@pytest.mark.parametrize("order", [1, 2, 3])
def test_next_token_probabilities_sum_to_one(order):
    """Over the tokens seen and one unseen, after any context, as the walks' scores tell."""
    train = ["a b a b c", "a c", "b b a"]
    for context in ("a", "b", "a b", "c c", "unseen", ""):
        probes = [*(f"{context} {w}" for w in ("a", "b", "c", "unseen")), context]
        texts = [*train, *probes, *(f"{p} after" for p in probes[:4])]
        counted = ngrams.Counted(ngrams.Text(texts, order), 60)
        totals = counted.counts(np.array([True] * 3 + [False] * (len(texts) - 3)))
        assert sum(totals[0][counted.place[0][:13]] > 0) == 13
        automaton = ngrams.Automaton(counted, totals, [0.7, 1.9][:order - 1], 13 + 4 + 1)
        token, inside, steps = counted.text.token, counted.text.inside, []
        at = counted.text.starts[3:8] + len(context.split())
        for place in at:  # the probability of the token at a place: what its step adds
            state, score = automaton.first, 0.0
            for i in range(place - inside[place], place + 1):
                score, word = 0.0, counted.place[0][i]
                while True:
                    arc = np.searchsorted(automaton.arc, state * automaton.words + word)
                    if automaton.arc[arc] == state * automaton.words + word:
                        score, state = score + automaton.label[arc], automaton.target[arc]
                        break
                    if not state:
                        score += automaton.label[-1]
                        break
                    score, state = score + automaton.give[state], automaton.fail[state]
            steps.append(10 ** score)
        assert len(set(token[at])) == 5
        assert sum(steps) == pytest.approx(1.0)


def plain_scores(texts, learn, order):
    """Masses from the counts of all texts, and each text's score: n-grams as tuples, one token after the other."""
    counts = collections.Counter()
    padded = [["<s>", *(t or "").split(), "</s>"] for t in texts]
    for words, use in zip(padded, learn, strict=True):
        if use:
            counts["<s>",] += 1
            counts.update(tuple(words[i - k + 1:i + 1]) for i in range(1, len(words)) for k in range(1, order + 1) if k <= i + 1)
    n = sum(c for g, c in counts.items() if len(g) == 1 and g != ("<s>",))
    whole = n + sum(len(g) == 1 and g != ("<s>",) for g in counts) + 1
    mass = [0.0]
    for k in range(1, order):
        once = sum(len(g) == k + 1 and c == 1 for g, c in counts.items())
        held = [c for g, c in counts.items() if len(g) == k and g[-1] != "</s>"]
        low, high = 1e-6, 1e12
        while high / low > 1 + 1e-13:
            m = (low * high) ** 0.5
            low, high = (m, high) if sum(c * m / (c - 1 + m) for c in held) < once else (low, m)
        mass.append((low * high) ** 0.5 if once and held else 1.0)
    scores = []
    for words in padded:
        total = 0.0
        for i in range(1, len(words)):
            p = (counts[words[i],] + 1) / whole
            for k in range(1, min(order - 1, i) + 1):
                if seen := counts[tuple(words[i - k:i])]:
                    p = (counts[tuple(words[i - k:i + 1])] + mass[k] * p) / (seen + mass[k])
            total += np.log10(p)
        scores.append(total)
    return scores


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_a_plain_model_under_any_batch_size(spark, table, monkeypatch, order):
    pick = random.Random(6)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(pick.choices(words, [1 / (k + 1) for k in range(60)], k=pick.randint(0, 40))) for _ in range(120)]
    expected = plain_scores(texts, [i % 5 != 0 for i in range(120)], order)
    docs = table([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        for records, block in (("10000", 6 << 20), ("7", 5000)):
            spark.conf.set(size, records)
            monkeypatch.setattr(ngrams, "BLOCK_BYTES", block)
            got = dict(ngrams.score(docs, F.col("doc_id") % 5 != 0, order=order).select("doc_id", "score").collect())
            assert [got[i] for i in range(120)] == pytest.approx(expected, rel=1e-9)
    finally:
        spark.conf.set(size, before)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_walks_take_arcs_and_fail_as_plain_lookups_do(order):
    pick = random.Random(order)
    texts = [" ".join(pick.choices("abcdefgh", [8, 7, 6, 5, 4, 3, 2, 1], k=pick.randint(0, 30))) for _ in range(60)] + ["", None, "unseen words"]
    for learn in (0, 30, 60):
        training = np.arange(len(texts)) < learn
        counted = ngrams.Counted(ngrams.Text(texts, order), 60)
        totals = counted.counts(training)
        tally = [row for k in range(order) for row in ngrams.tallied(k, counted.keys[k], totals[k])]
        single = totals[0][(totals[0] > 0) & (counted.keys[0] != ngrams.BEGIN)]
        automaton = ngrams.Automaton(counted, totals, ngrams.masses(tally, order), int(single.sum()) + len(single) + 1)
        assert (np.diff(automaton.arc) > 0).all()
        depth = np.zeros(len(automaton.fail), int)
        for s in range(1, len(depth)):
            at, depth[s] = s, 0
            while at:
                at, depth[s] = automaton.fail[at], depth[s] + 1
        assert depth.max() <= order - 1
        assert automaton.walk() == pytest.approx(plain_scores(texts, training, order), rel=1e-9)


def test_failures_weigh_in_on_the_way():
    """Without the failures' weights a walk over unseen continuations scores too high."""
    counted = ngrams.Counted(ngrams.Text(["a b a c", "b a", "c a b c"], 3), 60)
    automaton = ngrams.Automaton(counted, counted.counts(np.array([True, True, False])), [0.5, 2.0], 7 + 4 + 1)
    scores = automaton.walk()
    assert (automaton.give[1:] < 0).all() and automaton.give[0] == 0
    automaton.give[:] = 0
    free = automaton.walk()
    assert free[:2] == pytest.approx(scores[:2], rel=1e-12) and free[2] > scores[2]


def test_masses_are_bounded_without_and_with_odd_counts():
    assert ngrams.masses([], 3) == [1.0, 1.0] and ngrams.masses([], 1) == []
    tally = ngrams.tallied(0, np.array([ngrams.END, ngrams.BEGIN, 50, 60], np.uint64), np.array([4, 4, 300, 0]))
    assert tally == [(1, False, 4, 1, 4), (1, False, ngrams.EXACT + 9, 1, 300), (1, True, 4, 1, 4)]
    assert ngrams.masses([*tally, (2, False, 1, 304, 304)], 2)[0] > 1e9  # every n-gram occurs once


def test_vocabulary_leaves_out_begin_marks():
    texts = ["a b a c", "b a", "", None, "only here"]
    counted = ngrams.Counted(ngrams.Text(texts, 2), 60)
    for learn, n, v in ((5, 13, 6), (4, 10, 4), (0, 0, 0)):
        totals = counted.counts(np.arange(5) < learn)
        tally = [row for k in range(2) for row in ngrams.tallied(k, counted.keys[k], totals[k])]
        assert ngrams.vocabulary(tally) == (n, v)


def test_runs_of_keys_and_counts_are_packed_together():
    pick = np.random.default_rng(3)
    apart = np.unique(pick.integers(0, 1 << 64, 5000, np.uint64))
    near = np.unique(pick.integers(7 << 32, 9 << 32, 5000, np.uint64))  # many of equal high bits
    ends = np.array([0, 1, 255, 256, (1 << 64) - 1], np.uint64)
    for keys, bits in ((apart, 64), (near, 36), (apart >> np.uint64(14), 50), (ends, 64), (np.unique(np.concatenate([apart, near])), 64)):
        for buckets in (1, 3, 40, 7500):
            _, edges = ngrams._split(keys, bits, buckets)
            packed = ngrams._packed(keys, edges)
            got, runs = ngrams._unpacked(packed)
            assert (got == keys).all() and (runs == edges).all() and len(packed) == len(edges) - 1
            back, runs = ngrams._unpacked(packed[::-1])  # in any order
            assert (np.sort(back) == keys).all() and (np.diff(runs) == np.diff(edges)[::-1]).all()
            counts = pick.choice([0, 3, 255, 256, 65536, 1 << 32, 1 << 40], len(keys), p=[.5, .3, .1, .07, .01, .01, .01])
            assert (ngrams._counts(ngrams._small(counts, edges)) == counts).all()
    nothing = np.zeros(0, np.uint64)
    assert ngrams._packed(nothing, np.array([0])) == ngrams._small(nothing, np.array([0])) == []
    assert len(ngrams._counts([])) == 0


@pytest.mark.parametrize("order", [1, 2])
def test_scores_tokenise_a_text_twice(spark, table, monkeypatch, order):
    """Once for the counts and once for the walk; N and V come from the counts."""
    docs = table([(i, f"w{i % 7} x w{i % 3}", "en", "a", 1) for i in range(40)], DOCS)
    seen, text = spark.sparkContext.accumulator(0), ngrams.Text

    def counting(texts, *more):
        seen.add(len(texts))
        return text(texts, *more)

    monkeypatch.setattr(ngrams, "Text", counting)
    got = ngrams.score(docs, F.col("doc_id") % 5 != 0, order=order).collect()
    assert seen.value == 80
    assert {r.train_tokens for r in got} == {4 * 32}
    words = collections.Counter(w for i in range(40) if i % 5 for w in (f"w{i % 7}", "x", f"w{i % 3}", ""))
    for r in got:
        base = sum(np.log10((words[w] + 1) / (4 * 32 + len(words) + 1)) for w in (f"w{r.doc_id % 7}", "x", f"w{r.doc_id % 3}", ""))
        assert r.base_score == pytest.approx(base, rel=1e-12)


# 5. Near copies

def test_near_copies_edges(odd, nothing, prose, table):
    got = nearcopies.link(odd).collect()
    assert len(got) == odd.count()
    by_id = [(r.id, r.n_shingles, r.component_id, r.kept) for r in got]
    assert (3, 0, 3, True) in by_id and by_id.count((2, 0, 2, True)) == 2 and (5, 1, 5, True) in by_id
    assert len({r.component_id for r in got if r.id == 6}) == 1
    assert nearcopies.link(nothing).collect() == []


def test_large_groups_of_near_copies(table, prose, monkeypatch):
    """Copies, a chain and a group that only blocks resolve, against all pairs."""
    monkeypatch.setattr(nearcopies, "SMALL", 3)
    monkeypatch.setattr(nearcopies, "BLOCK", 8)
    base, pick = prose(3, 120).split(), random.Random(4)
    rows = [(i, " ".join(base), "", "", 0) for i in range(20)]
    for i in range(20, 90):  # some near, some not quite
        words = list(base)
        for _ in range(pick.randint(1, 7)):
            words[pick.randrange(len(words))] = f"w{pick.randrange(10_000)}"
        rows.append((i, " ".join(words), "", "", 0))
    chain = prose(9, 200).split()
    for i in range(90, 110):
        chain[(i * 7) % 200] = f"c{i}"
        rows.append((i, " ".join(chain), "", "", 0))
    pick.shuffle(rows)
    got = {r.id: r.component_id for r in nearcopies.link(table(rows, DOCS), shingle=4).collect()}
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(len(t.split()) - 3)} for i, t, *_ in rows}
    component = {i: i for i in sets}
    for a in sorted(sets):
        for b in sets:
            if a < b and component[a] != component[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((component[a], component[b]))
                component = {i: low if c == high else c for i, c in component.items()}
    assert got == component


def test_circulant_signature_estimates_similarity(prose):
    a = nearcopies.shingles(prose(1, 2000), 4)
    b = np.unique(np.concatenate([a[:1500], nearcopies.shingles(prose(2, 510), 4)]))
    similar = np.mean(nearcopies.signature(a, 1024) == nearcopies.signature(b, 1024))
    both = len(np.intersect1d(a, b))
    assert similar == pytest.approx(both / (len(a) + len(b) - both), abs=0.06)


# 6. Decontamination

def test_contamination_edges(odd, nothing, table, prose):
    items = table([(1, prose(50, 30)), (2, prose(50, 30)), (None, prose(51, 14)), (3, "Tiny item"), (4, ""), (5, None)],
                  "item_id long, text string")
    text = prose(50, 30)
    docs = odd.union(table([(20, f"{prose(70, 40)} {text.upper()}!", "", "", 0), (21, f"{prose(71, 100)} a tiny, ITEM", "", "", 0),
                            (22, " ".join(text.split()[:12]), "", "", 0), (23, prose(51, 14), "", "", 0)], DOCS))
    got = {r.id: r for r in decontaminate.contamination(docs, items).collect()}
    assert (got[20].n_hit, got[20].items, got[20].contaminated) == (30, ["1", "2"], True)
    assert (got[21].n_hit, got[21].items, got[21].contaminated) == (2, ["3"], False)
    assert (got[22].n_hit, got[22].contaminated) == (0, False)
    assert (got[23].n_hit, got[23].items) == (14, [])
    assert (got[2].n_words, got[2].n_hit, got[2].contaminated) == (0, 0, False)
    found = decontaminate.contamination(docs, items)
    assert found.count() == docs.count()
    assert decontaminate.contamination(nothing, items).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}


def test_contamination_without_broadcast_or_anchors(table, prose, monkeypatch):
    items = table([(1, prose(50, 30)), (2, prose(52, 5))], "item_id long, text string")
    docs = table([(i, f"{prose(i, 30)} {prose(50, 30) if i % 2 else prose(52, 5)} {prose(i + 99, 9)}", "", "", 0) for i in range(12)], DOCS)
    expected = sorted(map(repr, decontaminate.contamination(docs, items).drop("place").collect()))
    monkeypatch.setattr(decontaminate, "ANCHORS", 0)
    monkeypatch.setattr(decontaminate, "WINDOW_BYTES", 0)
    assert sorted(map(repr, decontaminate.contamination(docs, items).drop("place").collect())) == expected


def test_contamination_runs_no_python(table, spark, prose):
    docs = table([(1, prose(1, 30), "", "", 0)], DOCS)
    items = table([(1, prose(50, 30))], "item_id long, text string")
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "BroadcastHashJoin" in plan


# 7. SentencePiece

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.sampled_from("aethn  \n\té😀執xA.,-10▁<>='ioń\x00"), max_size=60))
def test_pieces_equal_library(library, text):
    model = pieces.load(PIECES)
    ids = model.encode(text).tolist()
    assert ids == library.encode(text, add_eos=True)
    assert model.decode(ids).decode() == library.decode(ids)


def test_pieces_edges(odd, nothing, library):
    got = pieces.encode_decode(odd.withColumn("ids", F.lit("clash")), PIECES)
    rows = got.collect()
    assert len(rows) == odd.count() and got.columns.count("ids") == 1
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_eos=True) and r.decoded == library.decode(r.ids)
    assert pieces.encode_decode(nothing, PIECES).collect() == []
    model = pieces.load(PIECES)
    for ids in ([3 + 0xFF], [3 + 0xC3, 3 + 0xA9], [0, 5], [2], [1, 28705]):
        assert model.decode(ids) == library.decode(ids).encode() or 0 in ids


# 8. WARC

def test_archives_are_plain_zip_files_and_edges(table, tmp_path, spark):
    html = ["<a>", "", None, "<a>", "é" * 10, "<a>", "line\r\n\r\nWARC/1.1"]
    rows = [(i + 1 if i != 5 else None, f"http://x/{i}\nb" if i else None, h, i) for i, h in enumerate(html)] + [(1, "u", "<a>", 9)]
    pages = table(rows, "page_id long, url string, html string, record_type int")
    archives, folder = warc.write(pages, folder=f"file://{tmp_path}/archives", archive_bytes=400)
    got = warc.read(archives).collect()
    assert len(got) == len(rows)
    kinds = [(r.id, r.record_type, r.refers_to, r.payload_bytes) for r in got]
    assert kinds.count(("1", "response", None, 3)) == 1 and kinds.count(("1", "revisit", "1", 3)) == 1
    assert ("4", "revisit", "1", 3) in kinds and (None, "revisit", "1", 3) in kinds
    assert ("2", "response", None, 0) in kinds and ("3", "revisit", "2", 0) in kinds
    for uri in (r.uri for r in archives.collect()):
        with zipfile.ZipFile(uri.removeprefix("file://")) as file:
            assert file.testzip() is None and sorted(file.namelist()) == ["index.cdx", "records.warc"]
    archives, _ = warc.write(pages, revisit_from=5)
    assert {r.record_type for r in warc.read(archives).collect()} == {"response"}
    heads = []
    for uri in (r.uri for r in archives.collect()):
        with zipfile.ZipFile(uri.removeprefix("file:")) as file:
            heads += [h for h in file.read("records.warc").decode().split("WARC/1.1\r\n") if "WARC-Record-ID" in h]
    assert all(len([x for x in h.split("\r\n") if x.startswith(f"{name}: ")]) == 1 for h in heads
               for name in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "Content-Length"))
    assert len({h.split("WARC-Record-ID: ")[1].split("\r\n")[0] for h in heads}) == len(heads) == len(rows)
    archives, _ = warc.write(pages.limit(0))
    assert warc.read(archives).collect() == []


def test_directory_of_foreign_archives():
    for comment, big in ((b"", False), (b"PK\x05\x06 in a comment", False), (b"", True)):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as file:
            file.comment = comment
            file.writestr("packed.txt", "p" * 100, zipfile.ZIP_DEFLATED)
            with file.open("stored.warc", "w", force_zip64=big) as member:
                member.write(b"some records")
        raw = data.getvalue()
        found = warc.directory(lambda at, n, raw=raw: raw[at:at + n], len(raw))
        assert list(found) == ["stored.warc"]
        at, length, _ = found["stored.warc"]
        assert raw[at:at + length] == b"some records"
    with pytest.raises(ValueError):
        warc.directory(lambda at, n: b"x" * n, 100)


# 9. Training order

@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_slots_are_a_permutation(n):
    slots = ordering.slot_of(np.arange(n), n, key=11)
    assert sorted(slots.tolist()) == list(range(n))
    assert (ordering.number_of(slots, n, key=11) == np.arange(n)).all()
    assert n < 100 or (slots != ordering.slot_of(np.arange(n), n, key=12)).any()


def test_order_edges(odd, nothing, spark):
    folder, n = ordering.write(ordering.coded(odd, RANKS), key=3, length=16, shard_slots=100)
    rows = ordering.read(spark, folder).collect()
    assert sorted(r.slot for r in rows) == list(range(n))
    assert sum(r.document == 2 for r in rows) == 2 and sum(r.document is None for r in rows) == 2
    later = ordering.read(spark, folder, start=n - 130).collect()
    assert sorted(map(repr, later)) == sorted(repr(r) for r in rows if r.slot >= n - 130)
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id == 7}
    parts = sorted((r.part, r.ids[:r.used]) for r in rows if r.document == 7)
    assert [x for _, ids in parts for x in ids] == [*load(RANKS).encoding.encode_ordinary(texts[7]), 50256]
    folder, n = ordering.write(ordering.coded(nothing, RANKS), key=3)
    assert n == 0 and ordering.read(spark, folder).collect() == []


def test_order_in_passes_leaves_no_shuffle_files(odd, spark):
    """Each pass writes its own shards, and what it moved is gone before the next one."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    moved = lambda: {f for top in disk.localDirsString() for f in glob.glob(f"{top}/*/shuffle_*.data")}
    ids = ordering.coded(odd, RANKS)
    whole, n = ordering.write(ids, key=3, length=16, shard_slots=700, passes=1)
    expected = sorted(map(repr, ordering.read(spark, whole).collect()))
    before = moved()
    folder, again = ordering.write(ids, key=3, length=16, shard_slots=700, passes=4)
    assert n == again > 4 * 700
    # The counts by partition, and by pass, stay until the driver collects its garbage; a shard's ids are larger.
    assert not [f for f in moved() - before if os.path.getsize(f) > 1000]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert sorted(map(repr, ordering.read(spark, folder).collect())) == expected


def test_order_digests_are_those_of_the_ids(odd, spark):
    folder, n = ordering.write(ordering.coded(odd, RANKS), key=3, length=16, shard_slots=100)
    own = F.slice("ids", F.lit(1), F.col("used")).cast("array<string>")
    expected = ordering.read(spark, folder, start=50).select("slot", "document", "part", "used", F.sha2(F.array_join(own, " "), 256))
    assert sorted(map(repr, map(tuple, ordering.digests(spark, folder, start=50).collect()))) == sorted(map(repr, map(tuple, expected.collect())))


@settings(deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "|>", "endoftext", " ", "\n", "é", "中", "a", "'s", "12", "\u2028"]), max_size=12))
def test_ids_know_no_special_text(parts):
    """tiktoken finds special texts without a search at every character only if there are some; none is special here."""
    vocabulary = load(RANKS)
    assert vocabulary.encoding.special_tokens_set
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=vocabulary.encoding._mergeable_ranks, special_tokens={})
    text = "".join(parts)
    assert np.frombuffer(vocabulary.ids(text), "<u2").tolist() == plain.encode_ordinary(text)


# 10. Languages

def test_gram_counts_do_not_depend_on_neighbours(prose):
    texts = ["Ab c", "", None, "xyz", "12", "é.", prose(1, 50), "ending in a letter", None]
    whole, letters = langid.gram_counts(texts)
    for k, text in enumerate(texts):
        alone, n = langid.gram_counts([text])
        assert (whole[k] == alone[0]).all() and letters[k] == n[0]
    assert whole[1].sum() == whole[2].sum() == whole[4].sum() == 0


def test_language_edges(odd, nothing, table, prose):
    model = langid.fit(nothing)
    assert {(r.lang_pred, r.score, r.rejected) for r in langid.identify(odd, model).collect()} == {("und", 0.0, True)}
    german = "und der die das nicht ist ein eine mit auf für von".split()
    rows = [(i, prose(i, 40) if i % 2 else " ".join(random.Random(i).choices(german, k=40)), "en" if i % 2 else "de", "", 0) for i in range(80)]
    model = langid.fit(table(rows, DOCS))
    got = langid.identify(odd.withColumn("score", F.lit("clash")), model)
    assert got.count() == odd.count()
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[1].lang_pred == by_id[3].lang_pred == by_id[4].lang_pred == "und" and by_id[4].rejected
    assert by_id[6].lang_pred == "en" and not by_id[6].rejected
    probe = table([(1, "das ist nicht ein mit der", "", "", 0), (2, "Привет " * 20, "", "", 0)], DOCS)
    got = {r.doc_id: r for r in langid.identify(probe, model).collect()}
    assert got[1].lang_pred == "de" and not got[1].rejected
    assert got[2].rejected


def test_languages_reject_by_a_low_quantile(table, prose):
    """One odd labelled row sets no floor, and the model may judge the rows it was fitted on."""
    german = "und der die das nicht ist ein eine mit auf für von".split()
    pick = random.Random(8)
    rows = [(i, prose(i, 150) if i % 2 else " ".join(pick.choices(german, k=150)), "en" if i % 2 else "de", "", 0)
            for i in range(300)]

    def letters(alphabet, n):
        return "".join(pick.choice(alphabet) for _ in range(n))

    latin, greek, han = "abcdefghijklmnopqrstuvwxyz  ", "αβγδεζηθικλμνξοπρστυφχψω   ", [chr(0x4E00 + k) for k in range(2000)]
    strange = [letters(x, n) for x in (latin, greek, han) for n in (60, 700, 20_000)]
    odd_row = (1000, letters(latin, 900), "en", "", 0)
    docs = table([*rows, odd_row, *((2000 + k, t, None, "", 0) for k, t in enumerate(strange))], DOCS)
    got = {r.doc_id: r for r in langid.identify(docs, langid.fit(docs)).collect()}
    assert all(got[2000 + k].rejected for k in range(len(strange)))
    assert got[1000].rejected
    assert not any(got[r[0]].rejected or got[r[0]].lang_pred != r[2] for r in rows)


def test_languages_are_those_of_the_nearest_centroid(table, prose):
    """Against one text and one centroid at a time: grams as strings, weights as sums."""
    def grams(text):
        runs = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        found = collections.Counter()
        for run in runs:
            padded = f" {run} "
            found.update(padded[i:i + 2] for i in range(len(padded) - 1))
            found.update(padded[i:i + 3] for i in range(len(padded) - 2))
        return found

    def dim(gram):
        value = 0
        for c in gram:
            value = value << 21 | ord(c)
        return (value * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - langid.DIMS.bit_length() + 1

    german = "und der die das nicht ist ein eine mit auf von".split()
    pick = random.Random(12)
    mixed = [" ".join([prose(i, i % 30), *pick.choices(german, k=pick.randint(1, 30))]) for i in range(60)]
    rows = [(i, prose(i, 60) if i % 2 else " ".join(pick.choices(german, k=60)), "en" if i % 2 else "de", "", 0) for i in range(120)]
    model = langid.fit(table(rows, DOCS))
    got = {r.doc_id: r for r in langid.identify(table([(i, t, "", "", 0) for i, t in enumerate(mixed)], DOCS), model).collect()}
    for i, text in enumerate(mixed):
        counts = collections.Counter()
        for gram, n in grams(text).items():
            counts[dim(gram)] += n
        weights = {d: math.log1p(n) * float(model.idf[d]) for d, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        cosines = sorted(((sum(w * float(c[d]) for d, w in weights.items()) / norm, name)
                          for c, name in zip(model.centroids, model.languages, strict=True)), reverse=True)
        assert got[i].score == pytest.approx(cosines[0][0], abs=1e-4)
        assert cosines[0][0] - cosines[1][0] < 1e-4 or got[i].lang_pred == cosines[0][1]


def test_language_centroids_are_sums_of_all_rows(table, prose):
    """Rows of two kinds in several tasks, more than a task holds: each counts in its kind's centroid."""
    german = "und der die das nicht ist ein eine mit auf von".split()
    pick = random.Random(5)
    texts = [prose(i, 8) if i % 3 else " ".join(pick.choices(german, k=8)) for i in range(3000)]
    rows = [(i, t, "xx", "", 0) for i, t in enumerate(texts)] + [(-1, "12 34", "xx", "", 0), (-2, "5", "yy", "", 0)]
    docs = table(rows, DOCS).repartition(2)
    for centroids in (1, 2):
        model = langid.fit(docs, centroids=centroids)
        points = langid.vectors(langid.gram_counts(texts)[0], model.idf)
        kinds = [points] if centroids == 1 else [points[0::3], np.concatenate([points[1::3], points[2::3]])]
        expected = [k.sum(0) / np.linalg.norm(k.sum(0)) for k in kinds]
        got = [c for c, name in zip(model.centroids, model.languages, strict=True) if name == "xx"]
        assert len(got) == centroids and "yy" in model.languages
        for e in expected:
            assert max(float(e @ c) for c in got) == pytest.approx(1, abs=1e-6)


# Pipeline

def test_pipeline_stages_on_odd_and_empty_documents(spark, odd, nothing, table, tmp_path):
    table([(1, "some item text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "tokens":
                assert out.columns == docs.columns
                assert out.count() <= docs.count()
            else:
                assert out.count() == docs.count()


def test_long_candidates_are_found_and_redacted(spark, table, prose):
    pick = random.Random(8)
    key = lambda n: "".join(pick.choice("abcdefghABCDEFGH0123456789") for _ in range(n))
    keys = {1000 + n: key(n) for n in (40, 129, 300, 4000)}
    rows = [(i, f'{prose(i, 30)} token = "{key(40)}" {prose(i + 900, 20)} {pick.randint(10**6, 10**9)} ab@c{i}.org') for i in range(400)]
    rows += [(i, f'{prose(i, 30)} token = "{k}" {prose(7, 9)}') for i, k in keys.items()]
    rows += [(2000, f"write to {'a' * 65}[at]{'b' * 70}[dot]" + "[dot]".join("cdefghijkl"))]
    docs = table(rows, "doc_id long, text string")
    for start, end, kind in pii.candidates(rows[-1][1]):
        assert (rows[-1][1][start:end], kind) == (rows[-1][1][9:], "email")
    trees = pii.fit(docs)
    clean = {r.doc_id: r.text for r in pii.redact(docs, trees).collect()}
    assert all(k not in clean[i] and "<secret>" in clean[i] for i, k in keys.items())
    assert trees.cut["secret"] < 2


def test_passes_of_a_search_are_bounded_where_queries_repeat(table):
    df = table([(100, [0.5, 0.25], 1)] * 50 + [(k, [k / 64, 0.5], 1) for k in range(1, 40)], "vec_id long, embedding array<float>, score int")
    asked = df.where("vec_id % 100 = 0").repartition(3).withColumn("place", F.monotonically_increasing_id())
    cuts = bitslices._passes(asked, 8)
    counts = [asked.where((F.col("place") >= low) & (F.col("place") < high)).count() for low, high in cuts]
    assert sum(counts) == 50 and max(counts) <= 8 and len(cuts) == 7
    got = bitslices.search(df, F.col("vec_id") % 100 == 0, k=2, pass_queries=8).collect()
    assert len(got) == 50 * 2 and {(r.query_id, r.rank, r.vec_id) for r in got} == {(100, 1, 39), (100, 2, 38)}


def test_pii_learns_from_every_document(table, monkeypatch):
    rows = [(i, f"call +1 (555) 010-{1000 + i} or 10.0.{i % 256}.9", "en", "a", 1) for i in range(6000)]
    docs, made, written = table(rows, DOCS), [], pii.written
    monkeypatch.setattr(pii, "written", lambda df, name: made.append(written(df, name)) or made[-1])
    assert pii.fit(docs, rounds=1, depth=2) is not None
    keys = docs.selectExpr("text", "xxhash64(cast(doc_id as string)) AS key").collect()
    assert made[0].count() == sum(len(pii.training_rows(r.text, r.key)) for r in keys)

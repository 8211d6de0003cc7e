"""The registered queries: against SQL where there is some, else against brute force, on a whole small table."""

import base64
import collections
import hashlib
import math
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

import corpus_pipeline
from tickline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "embeddings", "labels"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.sql("SELECT doc_id, text FROM documents").fetchall())


def result(spark, name, *columns):
    return [tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect()]


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, db, name):
    answer = db.sql(ORACLES[name])
    assert sorted(result(spark, name, *answer.columns)) == sorted(answer.fetchall())


def test_one_query_for_each_operator():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_search_equals_all_products(spark, db):
    rows = db.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids = np.array([r[0] for r in rows])
    values = np.floor(1024 * np.array([r[1] for r in rows], float)).astype(int)
    expected = []
    for k in np.flatnonzero(ids % 100 == 0):
        scores, other = values @ values[k], ids != ids[k]
        best = np.lexsort((ids[other], -scores[other]))[:10]
        expected += [(ids[k], i + 1, ids[other][b], scores[other][b]) for i, b in enumerate(best)]
    assert sorted(result(spark, "op1_bit_slices", "query_id", "rank", "vec_id", "score")) == sorted(expected)


def test_recount_equals_whole_encoding(spark, texts):
    from tickline.llm import recount
    from tickline.llm.bytepairs import load
    encoding = load(public_tokenizers.path("byte_bpe_50k.tiktoken")).encoding
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edits = recount.sample_edits()
    whole = {r.doc_id: r for r in recount.recount(docs, edits, public_tokenizers.path("byte_bpe_50k.tiktoken"))
             .withColumn("edits", edits).collect()}
    got = {r[0]: r[1:] for r in result(spark, "op2_recount", "doc_id", "n_before", "n_after", "n_encoded")}
    for doc, text in texts.items():
        changed = text
        for edit in whole[doc].edits:
            changed = changed[:edit.start] + edit.inserted + changed[min(len(changed), edit.start) + edit.removed:]
        assert whole[doc].edited == changed
        assert got[doc][:2] == (len(encoding.encode_ordinary(text)), len(encoding.encode_ordinary(changed)))
        assert got[doc][2] < 60  # the places edited, not the document


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * 2 - 9 * (int(d) > 4) if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), order, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(found)]


def test_pii_base_spans_equal_plain_patterns(spark, texts):
    for doc, email, ip, card, phone, sha, spans in result(
            spark, "op3_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"):
        expected = brute_spans(texts[doc])
        count = collections.Counter(k for *_, k in expected)
        joined = [f"{k}:{s}:{e}" for s, e, k in expected]
        assert (email, ip, card, phone) == tuple(count[k] for k in PATTERNS)
        assert sha == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(spans.split(",")) | {""}


def test_scores_equal_plain_counting(spark, texts):
    words = {d: t.encode().lower().split() + [None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = collections.Counter(w for d, ws in words.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    better = []
    for doc, out, tokens, known, total, base, score in result(
            spark, "op4_backoff", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"):
        assert (out, tokens, known, total) == (held[doc], len(words[doc]), sum(counts[w] > 0 for w in words[doc]), n)
        assert base == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words[doc]), rel=1e-9)
        better += [score - base] if out else []
    assert sum(better) > 0


def test_near_copies_equal_all_pairs(spark, texts):
    sets = {}
    for doc, text in texts.items():
        words = text.encode().lower().split()
        size = min(4, len(words))
        sets[doc] = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()
    component = {d: d for d in sets}
    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((component[a], component[b]))
                component = {d: low if c == high else c for d, c in component.items()}
    assert sorted(result(spark, "op5_near_copies", "doc_id", "n_shingles", "component_id", "kept")) == [
        (d, len(sets[d]), component[d], component[d] == d) for d in docs]


def test_pieces_equal_the_library(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for doc, n, ids_sha, text_sha in result(spark, "op7_pieces", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"):
        ids = library.encode(texts[doc], add_eos=True)
        assert n == len(ids)
        assert ids_sha == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert text_sha == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_archives_return_every_page(spark, db):
    pages = db.sql("SELECT page_id, coalesce(html, '') FROM pages").fetchall()
    first = {}
    for page, html in sorted(pages):
        first.setdefault(html, page)
    expected = sorted((p, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(),
                       "response" if first[h] == p else "revisit", None if first[h] == p else first[h]) for p, h in pages)
    assert sorted(result(spark, "op8_warc", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == expected


def test_archives_of_pages_without_ids(spark, tmp_path):
    pages = [(None, "u", "<a>"), (None, "u", "<b>"), (7, "u", "<a>"), (None, None, None), (-3, "u", "<c>"), (None, "u", "<b>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op8_warc"](spark, str(tmp_path)).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        (None, 3, "revisit", 7), (None, 3, "response", None), (None, 3, "revisit", None), (7, 3, "response", None),
        (None, 0, "response", None), (-3, 3, "response", None)], key=repr)


def test_order_is_a_permutation_that_holds_every_sequence(spark, texts):
    got = result(spark, "op9_order", "doc_id", "part", "slot", "n_tokens", "ids_sha256")
    assert sorted(r[2] for r in got) == list(range(len(got)))
    assert [r[2] for r in sorted(got)] != sorted(r[2] for r in got)
    encoding: tiktoken.Encoding = __import__("tickline.llm.bytepairs", fromlist=["load"]).load(
        public_tokenizers.path("byte_bpe_50k.tiktoken")).encoding
    expected = []
    for doc, text in texts.items():
        ids = [*encoding.encode_ordinary(text), 50256]
        expected += [(doc, p // 256, len(ids[p:p + 256]), hashlib.sha256(" ".join(map(str, ids[p:p + 256])).encode()).hexdigest())
                     for p in range(0, len(ids), 256)]
    assert sorted((d, p, n, sha) for d, p, _, n, sha in got) == sorted(expected)


def test_languages_on_held_out_documents(spark, db):
    lang = dict(db.sql("SELECT doc_id, lang FROM documents").fetchall())
    got = [r for r in result(spark, "op10_language", "doc_id", "held_out", "lang_pred", "score") if r[1]]
    assert sum(lang[d] == p for d, _, p, _ in got) >= 0.9 * len(got)
    assert all(0 <= s <= 1 for *_, s in got)


def test_pipeline_keeps_clean_documents_and_applies_every_decision(spark, db, texts):
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
    copies = collections.defaultdict(list)
    for doc, text in texts.items():
        copies[" ".join(text.lower().split())].append(doc)
    assert all(len([d for d in group if d in out]) <= 1 for group in copies.values())
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.values())
    for doc, r in out.items():
        assert not brute_spans(library.decode(r.ids))
        if not brute_spans(texts[doc]) and "token = " not in texts[doc].lower():
            assert library.decode(r.ids) == texts[doc]
    marked = {r[0] for r in result(spark, "op6_decontaminate", "doc_id", "contaminated") if r[1]}
    assert marked and not marked & out.keys()
    assert len(out) > 0.85 * len(copies) - len(marked)

"""One query per operator over the test tables, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm import audit, bitslices, decontaminate, langid, merkle, nearcopies, ngrams, ordering, pieces, pii, recount, secrets, warc
from tickline.llm.common import fold, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digests(pii.find(docs, pii.fit(docs))).drop("text")


@query
def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digests(coded.drop("text"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang") \
        .withColumn("held_out", fold("doc_id", 5) == 0)
    model = langid.fit(docs.where("not held_out"))
    return langid.identify(docs.drop("lang"), model).drop("text")


@query
def op5_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = nearcopies.link(table(spark, sf_dir, "documents"), shingle=4)
    return links.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLES["op6_decontaminate"] = r"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
br AS (SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS run
    FROM (SELECT item, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i
          FROM (SELECT item, w, least(13, len(w)) AS l FROM b WHERE len(w) > 0))),
ls AS (SELECT DISTINCT l FROM br),
d AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dr AS (SELECT place, l, i, array_to_string(w[i:i + l - 1], ' ') AS run
    FROM (SELECT place, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM d, ls WHERE len(w) >= l)),
found AS (SELECT place, l, i, item FROM dr JOIN br USING (l, run)),
covered AS (SELECT place, count(DISTINCT p) AS n_hit
    FROM (SELECT place, unnest(generate_series(i, i + l - 1)) AS p FROM found) GROUP BY place),
its AS (SELECT place, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT place, item FROM found WHERE item IS NOT NULL) GROUP BY place)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (place) LEFT JOIN its USING (place)
"""


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives, _ = warc.write(pages)
    return warc.read(archives).select(
        F.col("id").cast(pages.schema["page_id"].dataType).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast(pages.schema["page_id"].dataType).alias("refers_to"))


@query
def op4_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ngrams.score(docs, fold("doc_id", 7) != 2)
    return scored.withColumn("held_out", ~F.col("training")).drop("training")


@query
def op1_bit_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslices.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op2_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    trees = written(recount.plant(docs, vocabulary), "trees")
    counted = recount.recount(trees, recount.sample_edits(), vocabulary, tree_col="tree")
    return counted.select("doc_id", "n_before", "n_after", "n_pretokens", "n_encoded",
                          F.sha2(F.coalesce("edited", F.lit("")), 256).alias("edited_sha256"))


@query
def op9_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder, _ = ordering.write(ordering.coded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")), key=20240117)
    return ordering.digests(spark, folder).select(
        F.col("document").alias("doc_id"), "part", "slot", F.col("used").cast("long").alias("n_tokens"), "ids_sha256")


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = [F.translate("text", upper, upper.lower()) if f == "text" else F.col(f) for f in fields]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_hash(changed))
    manifest = merkle.build(table(spark, sf_dir, "documents"), fields, carry=[tampered.alias("tampered")])
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return merkle.prove(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return audit.report(audit.counters(spark, f"{sf_dir.rstrip('/')}/documents.parquet", labels))


ORACLES["op13_filter_audit"] = r"""
WITH d AS (SELECT row_number() OVER () AS place, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
least_id AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d JOIN least_id USING (t)),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(words) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INT)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(w.doc_id > least, false) AS INT) AS mask
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x
    AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
bits AS (SELECT x, CAST(1 << (ascii(x) - 65) AS BIGINT) AS bit FROM f),
s AS (SELECT filter_order, step, bit, (SELECT coalesce(sum(e.bit), 0) FROM bits e
      WHERE position(e.x IN filter_order) < step) AS earlier
  FROM o, generate_series(1, 5) AS g(step), bits WHERE x = substr(filter_order, step, 1)),
steps AS (SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (CAST(earlier AS BIGINT) | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & CAST(earlier AS BIGINT) = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & CAST(earlier AS BIGINT) > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & CAST(earlier AS BIGINT) = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & CAST(earlier AS BIGINT) = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit),
shares AS (SELECT part, bit, sum(removed) AS shapley FROM steps GROUP BY part, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM steps JOIN shares USING (part, bit)
"""


ORACLES["op1_bit_slices"] = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, e.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e ON e.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

ORACLES["op5_near_copies"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(list_transform(generate_series(1, len(w) - least(4, len(w)) + 1),
        lambda i: array_to_string(w[i:i + least(4, len(w)) - 1], ' '))) AS members FROM d WHERE len(w) > 0),
classes AS (SELECT min(doc_id) AS head, list_sort(members) AS members FROM sets GROUP BY list_sort(members)),
items AS (SELECT head, len(members) AS n, unnest(members) AS item FROM classes),
shared AS (SELECT a.head AS a, b.head AS b, count(*) AS meet, any_value(a.n) AS n, any_value(b.n) AS m
  FROM items a JOIN items b ON a.item = b.item AND a.head < b.head GROUP BY a.head, b.head),
links AS (SELECT a, b FROM shared WHERE 100 * meet >= 80 * (n + m - meet)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT head AS a, head AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
least_of AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
found AS (SELECT s.doc_id, len(s.members) AS n, least_of.component FROM sets s
  JOIN classes c ON c.members = list_sort(s.members) JOIN least_of ON least_of.a = c.head)
SELECT d.doc_id, CAST(coalesce(f.n, 0) AS BIGINT) AS n_shingles, coalesce(f.component, d.doc_id) AS component_id,
  coalesce(f.component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN found f USING (doc_id)
"""

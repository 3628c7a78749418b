"""Registered queries of the corpus operators, with DuckDB oracles where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table
from strata.llm.hard_negatives import hard_negatives
from strata.llm.knn_blocks import nearest
from strata.llm.language_id import language_id
from strata.llm.main_text import extract_main_text
from strata.llm.minhash import near_duplicates
from strata.llm.mixing import mix_sources, stream_positions
from strata.llm.multi_index import near_vectors
from strata.llm.packing import harmonic_pack
from strata.llm.phrases import mine_phrases
from strata.llm.sharding import shard_rows
from strata.llm.suffix_dedup import remove_repeats
from strata.llm.token_counts import count_tokens
from strata.llm.url_filter import filter_urls

ALLOW = ["com/", "www.example.com/en/"]
BLOCK = ["example.com/en/", "net/es/", "net/fr/"]
#: Weight units of the training mixture; "*" is every other source together.
MIXTURE = {"src0": 20, "src1": 6, "src2": 6, "src3": 4, "src4": 4, "*": 60}


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"), ALLOW, BLOCK)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return stream_positions(mix_sources(docs, MIXTURE).drop("text"), MIXTURE)


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return harmonic_pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096, added_as_text=False)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), share=75)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read_table(spark, sf_dir, "documents"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), width=50)


def op10_shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(read_table(spark, sf_dir, "documents"), shards=8)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(read_table(spark, sf_dir, "documents"), max_words=3, min_count=10, top=2000, share=50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_mix_sources": op2_mix_sources,
        "op3_pack": op3_pack,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_language_id": op5_language_id,
        "op6_near_vectors": op6_near_vectors,
        "op7_token_counts": op7_token_counts,
        "op8_nearest": op8_nearest,
        "op9_remove_repeats": op9_remove_repeats,
        "op10_shard_rows": op10_shard_rows,
        "op11_main_text": op11_main_text,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_phrases": op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_near_duplicates": NEAR_DUPLICATES,
        "op6_near_vectors": NEAR_VECTORS,
        "op8_nearest": NEAREST,
        "op9_remove_repeats": REPEATS,
        "op12_hard_negatives": HARD_NEGATIVES,
        "op13_phrases": PHRASES,
    }


NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 5 THEN [array_to_string(a, ' ')]
    ELSE list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i+4], ' ')) END) AS sh FROM w) u),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id WHERE r.root < l.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(root) AS root FROM r GROUP BY id) c ON c.id = d.doc_id"""

_UNIT_VECTORS = """v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""

NEAR_VECTORS = f"""
WITH RECURSIVE {_UNIT_VECTORS},
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id WHERE r.root < l.b)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, c.root AS component_id, e.vec_id = c.root AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = e.vec_id
JOIN (SELECT id, min(root) AS root FROM r GROUP BY id) c ON c.id = e.vec_id"""

NEAREST = f"""
WITH {_UNIT_VECTORS},
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rk FROM s)
SELECT query_id, CAST(rk AS INT) AS rank, vec_id, score FROM t WHERE rk <= 5"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50) t),
m AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s HAVING min(doc_id) < max(doc_id)),
x AS (SELECT doc_id, i FROM g JOIN m USING (s) WHERE doc_id > least),
e AS (SELECT doc_id, i, i - lag(i) OVER w > 50 OR lag(i) OVER w IS NULL AS fresh FROM x WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS z FROM
      (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e) t GROUP BY doc_id, k),
q AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id),
p AS (SELECT r.doc_id, string_agg(substr(d.h, 2 * lo + 1, 2 * (a - lo)), '' ORDER BY a) AS head, max(z) AS tail
      FROM (SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS lo FROM r) r JOIN d USING (doc_id) GROUP BY r.doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(q.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(q.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN p.doc_id IS NULL THEN d.h ELSE p.head || substr(d.h, 2 * p.tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN q USING (doc_id) LEFT JOIN p USING (doc_id)"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM (SELECT anchor_id, other AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS rk
      FROM s WHERE same) t WHERE rk <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rk
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rk AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rk <= 10"""

PHRASES = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d) t),
g AS (SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) v(k)) t),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
x AS (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut+1:k], ' ') AS tail
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) t),
s AS (SELECT x.lang, x.phrase, x.a, x.cut, l.f AS l, r.f AS r, (1000000::HUGEINT * x.a * x.a) // (l.f::HUGEINT * r.f) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = x.head JOIN f r ON r.lang = x.lang AND r.phrase = x.tail),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS rn FROM s),
o AS (SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
      FROM c WHERE k = 3) t GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
z AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, n.n, b.score FROM b JOIN n USING (lang) LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
      WHERE b.rn = 1 AND NOT coalesce(100 * o.longer >= 50 * b.a, FALSE))
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
  CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM z) t WHERE rank <= 2000"""

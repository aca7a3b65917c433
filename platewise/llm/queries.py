"""The registered queries of this package and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platewise.llm import (
    bpe,
    divergence,
    language,
    line_rules,
    maxscore,
    ngram_join,
    packing,
    pii,
    quality,
    scaled_sketch,
    spelling,
    toxicity,
    warc,
)
from platewise.llm.common import map_text, raw_text, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path() -> str:
    """Where the public vocabulary lies on the driver; executors get it by broadcast."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))


def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"))


def op3_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"))


def op5_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    chunks = warc.read_archives(manifest, payloads=False)
    return chunks.filter("last").select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("digest_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op6_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.identify(documents, language.train(documents))


def op7_bpe_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), bpe.load(vocabulary_path()))


def bpe_digests(documents: DataFrame, vocab: bpe.Vocabulary) -> DataFrame:
    """Encode every text, decode the ids, and return digests of both."""
    shared = documents.sparkSession.sparkContext.broadcast(vocab)

    def work(part: pa.RecordBatch) -> dict[str, object]:
        ids, bounds = bpe.encode(*raw_text(part.column("text")), shared.value)
        content, ends = bpe.decode(ids, bounds, shared.value)
        raw, text = ids.astype("<u4"), content.tobytes()
        return {
            "doc_id": part.column("doc_id"),
            "n_tokens": np.diff(bounds),
            "ids_sha256": [_sha(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
            "decoded_sha256": [
                _sha(text[a:b].decode("utf-8", "replace").encode()) for a, b in zip(ends[:-1], ends[1:], strict=True)
            ],
        }

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_text(documents, ["doc_id"], work, schema, limit=2 << 20)


def _sha(data: object) -> str:
    return hashlib.sha256(data).hexdigest()


def op8_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op9_packing_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe.load(vocabulary_path()))


def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean_lines(table(spark, sf_dir, "documents"), with_text=False)


def op11_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op12_spelling_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_maxscore,
        op3_toxicity_gru,
        op4_ngram_join,
        op5_warc_chunks,
        op6_language_bayes,
        op7_bpe_ranks,
        op8_pii_anchors,
        op9_packing_differencing,
        op10_line_rules,
        op11_scaled_sketch,
        op12_spelling_chunks,
        op13_source_divergence,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_maxscore": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_scaled_sketch": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following
  FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(text) DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
e AS (
  SELECT doc_id, text, following, length(text) AS n,
         substring(text, 1, length(text) - length(text) // 2) || substring(following, 1, length(text) // 2) AS edited
  FROM o
),
w AS (
  SELECT *, [list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') FOR t IN [text, edited, following]] AS words FROM e
),
h AS (
  SELECT *, [CASE WHEN len(v) = 0 THEN [] ELSE
    list_transform(range(1, greatest(len(v) - 4, 1) + 1), lambda k: substring(md5(array_to_string(v[k:k + 4], ' ')), 1, 15)) END FOR v IN words] AS hashes
  FROM w
),
s AS (
  SELECT doc_id, n, edited,
    [list_sort(list_distinct(CASE WHEN len(list_filter(a, lambda x: x < '400000000000000')) > 0
       THEN list_filter(a, lambda x: x < '400000000000000') WHEN len(a) > 0 THEN [list_min(a)] ELSE [] END)) FOR a IN hashes] AS k
  FROM h
),
c AS (
  SELECT *, len(list_intersect(k[1], k[2])) AS i2, len(list_intersect(k[1], k[3])) AS i3 FROM s
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(k[1], '') AS fingerprint, array_to_string(k[2], '') AS edited_fingerprint,
       CASE WHEN len(k[1]) + len(k[2]) = 0 THEN 1.0::DOUBLE ELSE i2::DOUBLE / (len(k[1]) + len(k[2]) - i2) END AS near_edited,
       CASE WHEN len(k[1]) + len(k[3]) = 0 THEN 1.0::DOUBLE ELSE i3::DOUBLE / (len(k[1]) + len(k[3]) - i3) END AS near_next,
       CASE WHEN len(k[1]) + len(k[2]) = 0 THEN 1.0::DOUBLE ELSE coalesce(i2::DOUBLE / nullif(least(len(k[1]), len(k[2])), 0), 0) END AS contained_edited,
       CASE WHEN len(k[1]) + len(k[3]) = 0 THEN 1.0::DOUBLE ELSE coalesce(i3::DOUBLE / nullif(least(len(k[1]), len(k[3])), 0), 0) END AS contained_next
FROM c
""",
    "op12_spelling_chunks": r"""
WITH RECURSIVE table_of AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc
),
t AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
),
r AS (SELECT doc_id, run, count(*) AS times FROM t WHERE length(run) >= 5 GROUP BY doc_id, run),
b AS (
  SELECT run, times, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)) AS bytes
  FROM r
),
h AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
    lambda c, x: xor(table_of.crc[(xor(c, x) & 255) + 1], c >> 8))) AS h
  FROM b, table_of
),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word,
         times
  FROM h
),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
cut AS (
  SELECT DISTINCT word, n, k, substring(word, 1, k - 1) AS head, substring(word, k + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
),
near AS (
  SELECT x.word, y.word AS other, y.n
  FROM cut x JOIN cut y ON x.k = y.k AND x.head = y.head AND x.tail = y.tail AND x.word <> y.word
  UNION
  SELECT c.word, s.word, s.n FROM cut c JOIN words s ON s.word = c.head || c.tail
  UNION
  SELECT s.word, c.word, c.n FROM cut c JOIN words s ON s.word = c.head || c.tail
),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n AS other_n,
         row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place
  FROM near
),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN other_n >= 2 * words.n THEN other END AS form, CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word AND place = 1
),
path AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT path.word, forms.form FROM path JOIN forms ON forms.word = path.root WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, p.root, f.n, f.n_near, f.form_n
FROM forms f JOIN path p USING (word) JOIN forms e ON e.word = p.root WHERE e.form IS NULL
""",
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS runs
  FROM documents
),
t AS (SELECT r, lang, source, translate(unnest(runs), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
total AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, v, lang_total,
         sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
  FROM g JOIN kept USING (lang) JOIN total USING (lang) LEFT JOIN c USING (lang, source, term)
),
p AS (
  SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (total + v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (lang_n + 1)) // (lang_total + v) AS q
  FROM dense
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}

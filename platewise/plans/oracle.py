"""SQL for each query, written apart from the DataFrame code and run by another engine."""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def rnd(value: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(18,8)), {digits}) AS DOUBLE)"


def mean(value: str, digits: int) -> str:
    exact = f"CAST(SUM(CAST({value} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT({value}), 0)"
    return rnd(exact, digits)


def n_if(condition: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT)"


POSITIVE = "sentiment_label IN ('positive', 'very_positive')"
NEGATIVE = "sentiment_label IN ('negative', 'very_negative')"

VIEWS = {
    "b_restaurants": """
SELECT concat('P', p_partkey) AS place_id, p_name AS name, p_brand AS address,
       CAST(33 + (p_partkey % 100) / 100.0 AS DECIMAL(10,7)) AS latitude,
       CAST(-112 + (p_partkey % 70) / 100.0 AS DECIMAL(10,7)) AS longitude,
       CAST(1 + (p_partkey * 37 % 401) / 100.0 AS DECIMAL(3,2)) AS rating,
       p_size * 10 AS total_ratings,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE 1 + p_size % 4 END AS price_level,
       string_split(concat(lower(p_type), ' ', p_name), ' ') AS types
FROM part""",
    "b_copies": """
SELECT concat(l_orderkey, '-', l_linenumber) AS review_id, concat('P', l_partkey) AS place_id,
       concat('S', l_suppkey) AS author_name, 1 + CAST(l_quantity AS INT) % 5 AS rating,
       l_shipdate AS review_date,
       CAST(ROUND(l_discount * 100) AS INT) AS d, CAST(ROUND(l_tax * 100) AS INT) AS t,
       l_extendedprice AS ep, l_quantity AS q
FROM lineitem""",
    "b_reviews": """
SELECT * FROM b_copies QUALIFY row_number() OVER (PARTITION BY review_id
    ORDER BY review_date DESC, place_id, author_name, ep, q, d, t) = 1""",
    "b_scored": """
SELECT *, CAST(1 + 0.4 * d AS DECIMAL(3,2)) AS predicted_score,
       CASE WHEN d <= 1 THEN 'very_negative' WHEN d <= 3 THEN 'negative' WHEN d <= 6 THEN 'neutral'
            WHEN d <= 8 THEN 'positive' ELSE 'very_positive' END AS sentiment_label,
       CAST(0.30 + 0.08 * t AS DECIMAL(5,4)) AS confidence, 'bound-v1' AS model_version,
       date_diff('day', CAST(review_date AS DATE), (SELECT CAST(MAX(l_shipdate) AS DATE) FROM lineitem)) AS age
FROM b_reviews""",
    "b_summary": f"""
SELECT r.place_id, r.name, r.address, CAST(r.rating AS DOUBLE) AS google_rating, r.total_ratings, r.price_level,
       COUNT(p.review_id) AS nlp_review_count, {mean('p.predicted_score', 2)} AS avg_nlp_score,
       {mean('p.confidence', 3)} AS avg_confidence,
       {n_if(POSITIVE)} AS positive_count, {n_if(NEGATIVE)} AS negative_count,
       {n_if("sentiment_label = 'neutral'")} AS neutral_count,
       {rnd(f"CAST({n_if(POSITIVE)} AS DOUBLE) / NULLIF(COUNT(p.review_id), 0)", 3)} AS positive_ratio
FROM b_restaurants r LEFT JOIN b_scored p ON r.place_id = p.place_id
GROUP BY r.place_id, r.name, r.address, r.rating, r.total_ratings, r.price_level""",
    "b_raw": r"""
SELECT concat(l_orderkey, '-', l_linenumber) AS review_id, concat('P', l_partkey) AS place_id,
       concat('Place ', l_partkey) AS restaurant_name, concat('S', l_suppkey) AS author_name,
       CASE WHEN CAST(l_quantity AS INT) % 13 = 0 THEN NULL
            ELSE CAST(CAST(l_quantity AS INT) % 7 AS DOUBLE) END AS rating,
       CASE WHEN l_returnflag = 'A' THEN concat('<p>Great <b>food</b>!</p>  by ', 'S', l_suppkey)
            WHEN l_returnflag = 'N' THEN concat('  Slow', chr(9), ' service<br>from ', 'S', l_suppkey, chr(10))
            WHEN CAST(l_quantity AS INT) % 4 = 0 THEN ' <i>ok</i> '
            ELSE concat('a<b>b</b>c  fine for ', CAST(floor(l_extendedprice) AS INT)) END AS text,
       'en' AS language,
       CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber * 3600 AS time_epoch,
       concat(strftime(l_shipdate, '%Y-%m-%d'), 'T00:00:00+00:00') AS review_time,
       '' AS relative_time, '' AS profile_photo_url,
       strftime(l_shipdate, '%Y-%m-%d') AS ingested_at
FROM lineitem""",
    "b_raw_one": """
SELECT * FROM b_raw QUALIFY row_number() OVER (PARTITION BY review_id
    ORDER BY ingested_at DESC, place_id NULLS FIRST, restaurant_name NULLS FIRST, author_name NULLS FIRST,
             rating NULLS FIRST, text NULLS FIRST, language, time_epoch, review_time) = 1""",
    "b_clean": r"""
SELECT * FROM (
  SELECT * REPLACE (CASE WHEN rating < 1 THEN 1.0 WHEN rating > 5 THEN 5.0 ELSE rating END AS rating),
         regexp_replace(trim(regexp_replace(text, '<[^>]+>', '', 'g')), '\s+', ' ', 'g') AS text_cleaned,
         make_timestamp(time_epoch * 1000000) AS review_date
  FROM b_raw_one) WHERE length(text_cleaned) > 5""",
    "b_clean_job": r"""
SELECT * FROM (
  SELECT *, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text_cleaned,
         make_timestamp(time_epoch * 1000000) AS review_date
  FROM b_raw_one) WHERE length(text_cleaned) > 5""",
    "b_featured": r"""
SELECT *, CAST(length(text_cleaned) AS INT) AS review_length,
       CAST(len(regexp_split_to_array(text_cleaned, '\s+')) AS INT) AS word_count,
       CAST(date_diff('day', CAST(review_date AS DATE), DATE '2002-01-01') AS INT) AS review_age_days
FROM b_clean""",
    "b_texts": """
SELECT doc_id, concat('D', doc_id) AS review_id, source AS place_id, lang AS language,
       CASE doc_id % 5
         WHEN 0 THEN concat('<p>The pizza</p> isn''t bad & the staff''s great! ', text)
         WHEN 1 THEN concat('  see https://ex.example/a?b=1 for the price  ', text)
         WHEN 2 THEN concat('We won''t return, it''s slow<br>service ', text)
         ELSE text END AS text,
       concat('Source ', source) AS restaurant_name, CAST(doc_id % 7 AS DOUBLE) AS rating,
       1600000000 + doc_id * 7200 AS time_epoch, '2024-01-01' AS ingested_at
FROM documents UNION ALL
SELECT -1 - doc_id, concat('E', doc_id), source, lang, '  <i></i> ', concat('Source ', source),
       CAST(doc_id % 7 AS DOUBLE), 1600000000 + doc_id * 7200, '2024-01-01'
FROM documents WHERE doc_id % 5 = 4""",
    "b_ratings": "SELECT doc_id, CAST(3 + 2 * quality - 2 * toxic AS DOUBLE) AS rating FROM labels",
    "b_logits": """
SELECT vec_id AS doc_id, CASE WHEN embedding IS NOT NULL THEN list_transform([0, 1, 2, 3, 4], lambda k:
         list_sum(list_filter(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), lambda x, i: (i - 1) % 5 = k))) END AS logits
FROM embeddings""",
    "b_users": """
SELECT concat('U', c_custkey) AS user_id,
       CASE c_mktsegment WHEN 'MACHINERY' THEN ['gear', 'BOLT'] WHEN 'BUILDING' THEN ['Plate', 'small']
            WHEN 'FURNITURE' THEN CAST([] AS VARCHAR[]) WHEN 'AUTOMOBILE' THEN ['Widget', 'promo'] END AS cuisine_types,
       CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_nationkey % 5 * 0.1 + 2.8 AS DECIMAL(3,2)) AS DOUBLE) END AS min_rating,
       c_nationkey
FROM customer""",
    "b_event_reviews": r"""
SELECT * REPLACE (CASE WHEN rating < 1 THEN 1.0 WHEN rating > 5 THEN 5.0 ELSE rating END AS rating),
       regexp_replace(trim(regexp_replace(text, '<[^>]+>', '', 'g')), '\s+', ' ', 'g') AS text_cleaned
FROM (
  SELECT CAST(event_id AS VARCHAR) AS review_id, event_type AS place_id, concat('U', user_id) AS author_name,
         CAST(CAST(floor(value) AS BIGINT) % 7 AS DOUBLE) AS rating,
         concat('<b>', event_type, '</b>  says ', props) AS text, ts
  FROM events)""",
}


# the letters beyond ASCII in the texts, by their base letter
DECOMPOSED = {
    "A": "Ä",
    "C": "Ç",
    "E": "ÈÉÊ",
    "I": "Í",
    "N": "Ñ",
    "O": "ÓÖ",
    "U": "Ü",
    "a": "äà",
    "c": "ç",
    "e": "èéê",
    "i": "í",
    "n": "ñ",
    "o": "óö",
    "u": "ü",
}


# fixed values, in their order
SHORT_FORMS = [
    ("won't", "will not"),
    ("can't", "cannot"),
    ("n't", " not"),
    ("it's", "it is"),
    ("that's", "that is"),
    ("what's", "what is"),
    ("there's", "there is"),
    ("he's", "he is"),
    ("she's", "she is"),
    ("'re", " are"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
]


def normalized(text: str) -> str:
    """The normalisation as nested SQL calls."""
    out = f"coalesce({text}, '')"
    for base, letters in DECOMPOSED.items():
        for letter in letters:
            # the combining mark ends up as a blank
            out = f"replace({out}, '{letter}', '{base}~')"
    out = f"regexp_replace({out}, '<[^>]+>', ' ', 'g')"
    out = rf"regexp_replace({out}, 'https?://\S+|www\.\S+', ' ', 'g')"
    for short, full in SHORT_FORMS:
        out = "replace({}, '{}', '{}')".format(out, short.replace("'", "''"), full)
    out = rf"regexp_replace({out}, '[^a-zA-Z0-9\s.,!?''-]', ' ', 'g')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def first_words(text: str, n: int) -> str:
    return f"array_to_string(string_split({text}, ' ')[1:{n}], ' ')"


VIEWS["b_normal"] = f"SELECT *, {normalized('text')} AS text_cleaned FROM b_texts"

# fixed values
KEY_WORDS = (
    "food|pizza|burger|sushi|pasta|steak|chicken|fish|salad|soup|dessert|appetizer|cocktail|wine|beer|coffee|tea|"
    "service|staff|waiter|waitress|server|manager|chef|"
    "atmosphere|ambiance|decor|music|view|location|parking|"
    "price|value|portion|quality|taste|flavor|fresh"
)
PHRASES = (
    rf"array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text_cleaned), '\b({KEY_WORDS})\b'))), ',')"
)

VIEWS["b_judged"] = f"""
SELECT doc_id, predicted_score, confidence,
       ['very_negative', 'negative', 'neutral', 'positive', 'very_positive'][place] AS sentiment_label
FROM (
  SELECT doc_id, list_position(logits, list_max(logits)) AS place,
         {rnd("list_sum(list_transform(logits, lambda x, i: exp(x) * i)) / list_sum(list_transform(logits, lambda x: exp(x)))", 3)} AS predicted_score,
         {rnd("list_max(list_transform(logits, lambda x: exp(x))) / list_sum(list_transform(logits, lambda x: exp(x)))", 4)} AS confidence
  FROM b_logits)"""

VIEWS["b_text_scores"] = f"""
SELECT n.review_id,
       CASE WHEN text_cleaned = '' OR j.doc_id IS NULL THEN 3.0 ELSE j.predicted_score END AS predicted_score,
       CASE WHEN text_cleaned = '' OR j.doc_id IS NULL THEN 'neutral' ELSE j.sentiment_label END AS sentiment_label,
       CASE WHEN text_cleaned = '' OR j.doc_id IS NULL THEN 0.0 ELSE j.confidence END AS confidence,
       text_cleaned, 'five-class' AS model_version, '2024-01-01' AS predicted_at, {PHRASES} AS key_phrases,
       n.place_id, n.doc_id
FROM b_normal n LEFT JOIN b_judged j USING (doc_id)"""


def analyses(source: str, min_reviews: int = 20) -> str:
    """Scores per place, before any rounding of the parts."""
    age = "exp(-0.693 * coalesce(age, 30) / 90.0)"
    return f"""
SELECT place_id, n AS review_count, {rnd('s / n', 3)} AS avg_predicted_score, {rnd('c / n', 3)} AS avg_confidence,
       {rnd('bayes', 3)} AS bayesian_score, {rnd('recency', 3)} AS recency_weighted_score,
       {rnd('0.5 * bayes + 0.3 * recency + 0.2 * least(n / 50.0, 1.0) * 5', 3)} AS recommendation_score,
       {rnd('pos / n', 3)} AS positive_ratio
FROM (SELECT *, (10 * 3.0 + s) / (10 + n) AS bayes, ws / greatest(w, 1e-8) AS recency FROM (
  SELECT place_id, COUNT(*) AS n, CAST(SUM(predicted_score) AS DOUBLE) AS s, CAST(SUM(confidence) AS DOUBLE) AS c,
         CAST({n_if(POSITIVE)} AS DOUBLE) AS pos,
         SUM(CAST(predicted_score AS DOUBLE) * {age}) AS ws, SUM({age}) AS w
  FROM {source} GROUP BY place_id))"""


VIEWS["b_label_counts"] = """
SELECT place_id, sentiment_label, COUNT(*) AS n FROM b_scored GROUP BY ALL"""
VIEWS["b_distribution"] = """
SELECT place_id, string_agg(concat(sentiment_label, ':', n), ',' ORDER BY sentiment_label) AS sentiment_distribution
FROM b_label_counts GROUP BY place_id"""
VIEWS["b_analyses"] = analyses("b_scored")


def ranked(top_n: int) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY recommendation_score DESC, place_id) AS INT) AS rank, a.*,
       r.name AS restaurant_name, r.types, r.price_level, r.latitude, r.longitude, s.sentiment_distribution
FROM b_analyses a JOIN b_restaurants r USING (place_id) JOIN b_distribution s USING (place_id)
WHERE review_count >= 20 ORDER BY rank LIMIT {top_n}"""


VIEWS["b_ranked"] = ranked(20)
VIEWS["b_ranked_200"] = ranked(200)
VIEWS["b_live"] = f"""
SELECT place_id, CAST(SUM(predicted_score) AS DOUBLE) / COUNT(*) AS m, COUNT(*) AS n, {n_if(POSITIVE)} AS pos
FROM b_scored GROUP BY place_id"""
VIEWS["b_user_recs"] = """
SELECT DISTINCT u.user_id, k.rank, k.place_id, k.restaurant_name, k.recommendation_score, k.avg_predicted_score,
       k.review_count, k.positive_ratio
FROM b_users u JOIN b_ranked k
  ON (u.min_rating IS NULL OR k.avg_predicted_score >= u.min_rating)
 AND (u.cuisine_types IS NULL
      OR list_has_any(list_transform(u.cuisine_types, lambda x: lower(x)), list_transform(k.types, lambda x: lower(x))))"""

# merges: what is stored, what arrives
VIEWS["m_known"] = """
SELECT * FROM b_copies WHERE review_date < TIMESTAMP '2000-01-01' QUALIFY row_number() OVER (PARTITION BY review_id
    ORDER BY review_date DESC, place_id, author_name, ep, q, d, t) = 1"""
VIEWS["m_batch"] = """
SELECT * FROM b_copies WHERE review_date >= TIMESTAMP '1998-01-01' QUALIFY row_number() OVER (PARTITION BY review_id
    ORDER BY review_date DESC, place_id, author_name, ep, q, d, t) = 1"""
VIEWS["m_docs"] = """
SELECT coalesce(k.review_id, u.review_id) AS review_id, coalesce(u.place_id, k.place_id) AS place_id,
       coalesce(u.author_name, k.author_name) AS author_name, coalesce(u.rating, k.rating) AS rating,
       coalesce(u.text, k.text) AS text, CAST(coalesce(u.review_date, k.review_date) AS DATE) AS review_date,
       CASE WHEN k.review_id IS NULL THEN 'inserted' WHEN u.review_id IS NULL THEN 'kept'
            WHEN (u.place_id, u.author_name, u.rating, coalesce(u.text, k.text), u.review_date)
                 IS DISTINCT FROM (k.place_id, k.author_name, k.rating, k.text, k.review_date) THEN 'modified'
            ELSE 'unchanged' END AS op
FROM (SELECT *, concat('first by ', author_name) AS text FROM m_known) k
FULL JOIN (SELECT * REPLACE (CASE WHEN t % 2 = 0 THEN rating ELSE rating % 5 + 1 END AS rating),
                  CASE WHEN d > 0 THEN concat('again by ', author_name) END AS text FROM m_batch) u
  ON k.review_id = u.review_id"""
VIEWS["m_places"] = """
SELECT * FROM b_restaurants WHERE price_level IS NOT NULL"""
VIEWS["m_new_places"] = """
SELECT * REPLACE (upper(name) AS name, latitude + 1 AS latitude, total_ratings + 1 AS total_ratings,
                  CASE WHEN total_ratings > 200 THEN concat(address, ' new') END AS address)
FROM b_restaurants WHERE rating >= 2.5"""
VIEWS["m_new_predictions"] = """
SELECT review_id, concat(place_id, 'x') AS place_id, CAST(least(predicted_score + 0.25, 5.0) AS DECIMAL(3,2)) AS predicted_score,
       sentiment_label, confidence, 'bound-v2' AS model_version, rating
FROM b_scored WHERE review_date >= TIMESTAMP '1998-01-01'"""
VIEWS["m_predictions"] = "SELECT * FROM b_scored WHERE review_date < TIMESTAMP '2000-01-01'"


def _needed(sql: str) -> list[str]:
    """Views a statement uses, in the order of their definition."""
    import re

    found: set[str] = set()
    todo = [sql]
    while todo:
        for name in set(re.findall(r"\b[bm]_[a-z0-9_]+\b", todo.pop())) & VIEWS.keys() - found:
            found.add(name)
            todo.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def oracle(name: str, sql: str) -> None:
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in sorted(_needed(sql), key=_depth))
    ORACLE[name] = f"WITH {views}\n{sql}" if views else sql


def _depth(view: str) -> int:
    return 1 + max([_depth(v) for v in _needed(VIEWS[view]) if v != view], default=0)


RAW_COLUMNS = (
    "review_id, place_id, restaurant_name, author_name, rating, text, language, time_epoch, review_time, "
    "relative_time, profile_photo_url, ingested_at"
)

# --- sources

oracle("scan_reviews_json", f"SELECT {RAW_COLUMNS} FROM b_raw")
oracle("scan_review_arrays", f"SELECT {RAW_COLUMNS} FROM b_raw")
oracle("batch_reviews", f"SELECT {RAW_COLUMNS} FROM b_raw")
oracle(
    "scan_restaurants_json",
    """
SELECT place_id, name, address, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       CAST(rating AS DOUBLE) AS rating, total_ratings, price_level, array_to_string(types, ',') AS types,
       '2024-01-01' AS extracted_at FROM b_restaurants""",
)
oracle(
    "flatten_place_reviews",
    """
SELECT md5(concat(place_id, '_', author_name, '_', time_epoch)) AS review_id, place_id,
       CASE WHEN rating IS NULL THEN 'Unknown' ELSE restaurant_name END AS restaurant_name, author_name, rating, text,
       'fr' AS language, time_epoch,
       strftime(make_timestamp(time_epoch * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS review_time,
       '' AS relative_time, '' AS profile_photo_url, '2024-01-01' AS ingested_at FROM b_raw
UNION ALL
SELECT md5(concat(place_id, '__')), place_id, CASE WHEN rating IS NULL THEN 'Unknown' ELSE restaurant_name END,
       'Anonymous', 4.5, '', 'en', CAST(NULL AS BIGINT), '1970-01-01T00:00:00+00:00', '', '', '2024-01-01' FROM b_raw""",
)
oracle(
    "flatten_place_metadata",
    """
SELECT place_id, name, CASE WHEN price_level IS NULL THEN '' ELSE address END AS address,
       CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, CAST(rating AS DOUBLE) AS rating,
       CASE WHEN price_level > 1 THEN total_ratings ELSE 0 END AS total_ratings, price_level,
       CASE WHEN rating >= 2 THEN array_to_string(types, ',') ELSE '' END AS types, '2024-01-01' AS extracted_at
FROM b_restaurants""",
)
oracle(
    "read_lake_month",
    """
SELECT review_id, place_id,
       CASE WHEN rating IS NULL THEN 'new_town' ELSE concat('new_', CAST(rating AS INT)) END AS location,
       rating, time_epoch, 1995 AS year, 6 AS month, 1 AS day
FROM b_raw WHERE substr(ingested_at, 1, 7) = '1995-06'""",
)
oracle(
    "read_lake_partition",
    """
SELECT CAST(substr(ingested_at, 1, 4) AS INT) AS year, CAST(substr(ingested_at, 6, 2) AS INT) AS month, 1 AS day,
       CASE WHEN rating IS NULL THEN 'new_town' ELSE concat('new_', CAST(rating AS INT)) END AS location,
       COUNT(*) AS n, SUM(rating) AS rating_sum, CAST(SUM(time_epoch) AS BIGINT) AS epoch_sum,
       CAST(SUM(length(text)) AS BIGINT) AS text_chars
FROM b_raw GROUP BY ALL""",
)
oracle(
    "lake_rerun",
    """
SELECT CAST(substr(ingested_at, 1, 4) AS INT) AS year, 'area_2' AS location, COUNT(*) AS n,
       CAST(SUM(time_epoch) AS BIGINT) AS epoch_sum
FROM b_raw WHERE rating = 2 GROUP BY ALL""",
)
oracle(
    "lake_processed",
    """
SELECT 'raw/reviews' AS area, 'phoenix_downtown' AS location, COUNT(*) AS n, CAST(SUM(length(text)) AS BIGINT) AS chars
FROM b_raw WHERE rating IS NOT NULL
UNION ALL
SELECT 'processed/reviews', 'phoenix_downtown', COUNT(*), CAST(SUM(length(t)) AS BIGINT) FROM (
  SELECT regexp_replace(trim(regexp_replace(text, '<[^>]+>', '', 'g')), '\\s+', ' ', 'g') AS t FROM b_raw
  WHERE rating IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY place_id, author_name, time_epoch ORDER BY rating, text) = 1)
WHERE length(t) > 5""",
)
oracle(
    "lake_files",
    """
SELECT DISTINCT concat('year=', substr(ingested_at, 1, 4), '/month=', substr(ingested_at, 6, 2), '/day=01') AS folder
FROM b_raw""",
)
PREDICTION = (
    "review_id, place_id, CAST(predicted_score AS DOUBLE) AS predicted_score, sentiment_label, "
    "CAST(confidence AS DOUBLE) AS confidence, model_version"
)
oracle(
    "place_reviews",
    f"SELECT {PREDICTION} FROM b_scored WHERE place_id IN (SELECT place_id FROM b_restaurants WHERE price_level = 4)",
)
oracle(
    "lookup_scored_reviews",
    f"""
SELECT {PREDICTION}, 'place' AS asked FROM b_scored WHERE place_id = 'P7'
UNION ALL SELECT {PREDICTION}, 'review' FROM b_scored WHERE review_id = '1-1'""",
)
PLACE = (
    "place_id, name, address, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
    "CAST(rating AS DOUBLE) AS rating, total_ratings, price_level, array_to_string(types, ',') AS types"
)
oracle(
    "restaurant_by_id",
    f"SELECT {PLACE} FROM b_restaurants WHERE place_id IN (SELECT place_id FROM b_copies WHERE rating = 5)",
)
oracle("lookup_restaurant", f"SELECT {PLACE} FROM b_restaurants WHERE place_id = 'P7'")
oracle("all_restaurants", f"SELECT {PLACE} FROM b_restaurants")

# --- sinks and merges

oracle(
    "parquet_roundtrip",
    r"""
SELECT review_id, place_id, restaurant_name, author_name, rating, language, time_epoch, text_cleaned, review_date,
       CAST(length(text_cleaned) AS INT) AS review_length,
       CAST(len(regexp_split_to_array(text_cleaned, '\s+')) AS INT) AS word_count,
       CAST(dayofweek(review_date) + 1 AS INT) AS day_of_week, CAST(year(review_date) AS INT) AS review_year,
       CAST(month(review_date) AS INT) AS review_month,
       CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS rating_category
FROM b_clean_job""",
)
oracle("upsert_reviews", "SELECT * FROM m_docs")
oracle(
    "upsert_review_counts",
    f"""SELECT {n_if("op = 'inserted'")} AS inserted, {n_if("op = 'modified'")} AS modified FROM m_docs""",
)
oracle(
    "upsert_restaurants",
    """
SELECT coalesce(k.place_id, u.place_id) AS place_id, coalesce(u.name, k.name) AS name,
       coalesce(u.address, k.address) AS address, CAST(coalesce(u.latitude, k.latitude) AS DOUBLE) AS latitude,
       CAST(coalesce(u.longitude, k.longitude) AS DOUBLE) AS longitude, CAST(coalesce(u.rating, k.rating) AS DOUBLE) AS rating,
       coalesce(u.total_ratings, k.total_ratings) AS total_ratings, coalesce(u.price_level, k.price_level) AS price_level,
       array_to_string(coalesce(u.types, k.types), ',') AS types,
       CASE WHEN k.place_id IS NULL THEN 'inserted' WHEN u.place_id IS NULL THEN 'kept' ELSE 'modified' END AS op
FROM m_places k FULL JOIN m_new_places u ON k.place_id = u.place_id""",
)
oracle(
    "merge_dim_restaurants",
    """
SELECT coalesce(k.place_id, u.place_id) AS place_id,
       CASE WHEN u.place_id IS NULL THEN k.name ELSE u.name END AS name,
       CASE WHEN u.place_id IS NULL THEN k.address ELSE u.address END AS address,
       CAST(CASE WHEN k.place_id IS NULL THEN u.latitude ELSE k.latitude END AS DOUBLE) AS latitude,
       CAST(coalesce(k.longitude, u.longitude) AS DOUBLE) AS longitude, CAST(coalesce(u.rating, k.rating) AS DOUBLE) AS rating,
       coalesce(u.total_ratings, k.total_ratings) AS total_ratings,
       CASE WHEN u.place_id IS NULL THEN k.price_level ELSE u.price_level END AS price_level,
       array_to_string(coalesce(u.types, k.types), ',') AS types,
       CASE WHEN u.place_id IS NULL THEN '2024-01-01' ELSE '2024-02-01' END AS updated_at
FROM m_places k FULL JOIN m_new_places u ON k.place_id = u.place_id""",
)
oracle(
    "merge_fact_reviews",
    """
SELECT coalesce(k.review_id, u.review_id) AS review_id, coalesce(k.place_id, u.place_id) AS place_id,
       coalesce(k.author_name, u.author_name) AS author_name, CAST(coalesce(u.rating, k.rating) AS DOUBLE) AS rating,
       CASE WHEN u.review_id IS NULL THEN CASE WHEN k.d > 2 THEN concat('t', k.d) END
            WHEN u.d > 2 THEN concat('t', u.d) ELSE '' END AS review_text,
       CAST(coalesce(k.q, u.q) AS INT) AS review_length, coalesce(k.t, u.t) AS word_count,
       CAST(coalesce(k.review_date, u.review_date) AS DATE) AS review_date,
       CAST(date_diff('day', CAST(coalesce(u.review_date, k.review_date) AS DATE), DATE '2002-01-01') AS INT) AS review_age_days,
       CASE WHEN u.review_id IS NULL THEN '2024-01-01' ELSE '2024-02-01' END AS loaded_at
FROM m_known k FULL JOIN m_batch u ON k.review_id = u.review_id""",
)
DATE_PARTS = """CAST(year(full_date) AS INT) AS year, CAST(month(full_date) AS INT) AS month, CAST(day(full_date) AS INT) AS day,
       CAST(quarter(full_date) AS INT) AS quarter, CAST(dayofweek(full_date) + 1 AS INT) AS day_of_week,
       CAST({week} AS INT) AS week_of_year"""
ALL_PARTS = DATE_PARTS.format(week="weekofyear(full_date)")
oracle(
    "merge_dim_time",
    f"""
SELECT full_date, {DATE_PARTS.format(week="0")}
FROM (SELECT DISTINCT CAST(review_date AS DATE) AS full_date FROM m_known)
UNION ALL
SELECT full_date, {ALL_PARTS}
FROM (SELECT DISTINCT CAST(review_date AS DATE) AS full_date FROM b_copies WHERE review_date >= TIMESTAMP '1998-01-01')
WHERE full_date NOT IN (SELECT CAST(review_date AS DATE) FROM m_known)""",
)
MERGED_PREDICTION = """
       CAST(coalesce(u.predicted_score, k.predicted_score) AS DOUBLE) AS predicted_score,
       coalesce(u.sentiment_label, k.sentiment_label) AS sentiment_label,
       CAST(coalesce(u.confidence, k.confidence) AS DOUBLE) AS confidence,
       coalesce(u.model_version, k.model_version) AS model_version"""
oracle(
    "upsert_processed",
    f"""
SELECT coalesce(k.review_id, u.review_id) AS review_id, coalesce(u.place_id, k.place_id) AS place_id, {MERGED_PREDICTION}
FROM m_predictions k FULL JOIN m_new_predictions u ON k.review_id = u.review_id""",
)
oracle(
    "merge_fact_predictions",
    f"""
SELECT coalesce(k.review_id, u.review_id) AS review_id, coalesce(k.place_id, u.place_id) AS place_id, {MERGED_PREDICTION}
FROM m_predictions k FULL JOIN (SELECT * FROM m_new_predictions WHERE rating >= 3) u ON k.review_id = u.review_id""",
)
oracle(
    "merge_small_batch",
    f"""
SELECT coalesce(k.review_id, u.review_id) AS review_id, coalesce(k.place_id, u.place_id) AS place_id, {MERGED_PREDICTION},
       CASE WHEN k.review_id IS NULL THEN 'inserted' WHEN u.review_id IS NULL THEN 'kept' ELSE 'modified' END AS op
FROM m_predictions k FULL JOIN m_new_predictions u ON k.review_id = u.review_id""",
)
oracle("fk_rejects", f"SELECT {PREDICTION} FROM m_new_predictions WHERE rating < 3")
oracle(
    "load_warehouse",
    """
SELECT 'dim_restaurants' AS table_name, COUNT(*) AS n, CAST(SUM(coalesce(u.total_ratings, k.total_ratings)) AS BIGINT) AS total
FROM m_places k FULL JOIN m_new_places u ON k.place_id = u.place_id
UNION ALL
SELECT 'dim_time', COUNT(*), CAST(SUM(dayofweek(full_date) + 1) AS BIGINT) FROM (
  SELECT CAST(review_date AS DATE) AS full_date FROM m_known
  UNION SELECT CAST(review_date AS DATE) FROM m_batch WHERE rating >= 3)
UNION ALL
SELECT 'fact_reviews', COUNT(*), CAST(SUM(100 * coalesce(u.rating, k.rating)) AS BIGINT)
FROM m_known k FULL JOIN (SELECT * FROM m_batch WHERE rating >= 3) u ON k.review_id = u.review_id
UNION ALL
SELECT 'fact_predictions', COUNT(*), CAST(SUM(100 * coalesce(u.predicted_score, k.predicted_score)) AS BIGINT)
FROM (SELECT * FROM m_predictions WHERE review_id IN (SELECT review_id FROM m_known)) k
FULL JOIN (
  SELECT * FROM m_new_predictions
  WHERE review_id IN (SELECT review_id FROM m_known UNION SELECT review_id FROM m_batch WHERE rating >= 3)) u
ON k.review_id = u.review_id""",
)
oracle(
    "upsert_preferences",
    """
SELECT coalesce(k.user_id, u.user_id) AS user_id,
       CASE WHEN u.user_id IS NULL THEN 'old' ELSE array_to_string(u.cuisine_types, ',') END AS cuisine_types,
       CASE WHEN u.user_id IS NULL THEN k.min_rating ELSE u.min_rating END AS min_rating,
       CASE WHEN u.user_id IS NULL THEN '1,4' ELSE array_to_string(u.price_range, ',') END AS price_range,
       CASE WHEN u.user_id IS NULL THEN '2023-12-31T00:00:00' ELSE '2024-01-01T00:00:00' END AS updated_at
FROM (SELECT * FROM b_users WHERE c_nationkey < 15) k
FULL JOIN (
  SELECT * FROM (
    SELECT CASE WHEN c_nationkey < 24 THEN user_id ELSE 'anonymous' END AS user_id,
           coalesce(cuisine_types, CAST([] AS VARCHAR[])) AS cuisine_types, coalesce(min_rating, 3.0) AS min_rating,
           CASE WHEN c_nationkey % 3 = 0 THEN [1, 1 + c_nationkey % 4] END AS price_range
    FROM b_users WHERE c_nationkey >= 10)
  QUALIFY row_number() OVER (
    PARTITION BY user_id ORDER BY min_rating DESC, array_to_string(cuisine_types, ','), price_range[2] NULLS FIRST) = 1) u
ON k.user_id = u.user_id""",
)

# --- warehouse and business queries

oracle(
    "star_dim_time",
    f"SELECT full_date, {ALL_PARTS} FROM (SELECT DISTINCT CAST(review_date AS DATE) AS full_date FROM b_reviews)",
)
oracle("star_dim_restaurants", "SELECT DISTINCT place_id, restaurant_name AS name FROM b_clean")
oracle(
    "star_fact_reviews",
    """
SELECT review_id, place_id, author_name, rating, text_cleaned, review_length, word_count, review_date, review_age_days
FROM b_featured""",
)
oracle(
    "dim_users",
    """
SELECT md5(author_name) AS user_id, author_name, CAST(MIN(review_date) AS DATE) AS first_seen, COUNT(*) AS review_count
FROM b_reviews GROUP BY author_name""",
)
oracle("mv_restaurant_sentiment", "SELECT * FROM b_summary")
oracle("mv_refresh_by_batch", "SELECT * FROM b_summary")
oracle(
    "top_restaurants_by_nlp",
    """
SELECT place_id, name, address, google_rating, avg_nlp_score, nlp_review_count, positive_ratio, price_level,
       CAST(RANK() OVER (ORDER BY avg_nlp_score DESC) AS INT) AS nlp_rank,
       RANK() OVER (ORDER BY google_rating DESC NULLS FIRST) AS google_rank
FROM b_summary WHERE nlp_review_count >= 20 ORDER BY avg_nlp_score DESC, place_id LIMIT 50""",
)
oracle(
    "sentiment_over_time",
    f"""
SELECT CAST(year(review_date) AS INT) AS year, CAST(month(review_date) AS INT) AS month, sentiment_label,
       COUNT(*) AS review_count, {mean('predicted_score', 2)} AS avg_score
FROM b_scored GROUP BY ALL""",
)
oracle(
    "score_vs_rating",
    """
SELECT place_id, name, google_rating, avg_nlp_score, nlp_review_count,
       CAST(abs(CAST(google_rating AS DECIMAL(18,8)) - CAST(avg_nlp_score AS DECIMAL(18,8))) AS DOUBLE) AS score_gap,
       CASE WHEN CAST(avg_nlp_score AS DECIMAL(18,8)) > CAST(google_rating AS DECIMAL(18,8)) + 0.5 THEN 'Underrated by Google'
            WHEN CAST(avg_nlp_score AS DECIMAL(18,8)) < CAST(google_rating AS DECIMAL(18,8)) - 0.5 THEN 'Overrated by Google'
            ELSE 'Aligned' END AS score_alignment
FROM b_summary WHERE nlp_review_count >= 20""",
)
oracle(
    "review_volume_trend",
    f"""
SELECT CAST(review_date AS DATE) AS review_day, COUNT(*) AS daily_reviews, {mean('predicted_score', 2)} AS avg_daily_score,
       {rnd("AVG(COUNT(*)) OVER (ORDER BY CAST(review_date AS DATE) ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 6)} AS rolling_7d_avg
FROM b_scored WHERE age <= 90 GROUP BY CAST(review_date AS DATE)""",
)
oracle(
    "price_vs_sentiment",
    f"""
SELECT price_level, COUNT(DISTINCT place_id) AS restaurant_count, {mean('avg_nlp_score', 2)} AS avg_sentiment_score,
       {mean('positive_ratio', 3)} AS avg_positive_ratio, {mean('google_rating', 2)} AS avg_google_rating
FROM b_summary WHERE price_level IS NOT NULL GROUP BY price_level""",
)
oracle(
    "confidence_tiers",
    f"""
SELECT CASE WHEN confidence >= 0.9 THEN 'High (≥0.9)' WHEN confidence >= 0.7 THEN 'Medium (0.7-0.9)'
            WHEN confidence >= 0.5 THEN 'Low (0.5-0.7)' ELSE 'Very Low (<0.5)' END AS confidence_tier,
       COUNT(*) AS prediction_count, {mean('predicted_score', 2)} AS avg_predicted, {mean('rating', 2)} AS avg_actual,
       {mean('abs(predicted_score - rating)', 2)} AS avg_error
FROM b_scored GROUP BY ALL""",
)
oracle(
    "sentiment_analytics_wh",
    f"""
SELECT r.place_id, COUNT(*) AS prediction_count, {mean('predicted_score', 2)} AS avg_predicted_score,
       {mean('p.rating', 2)} AS avg_actual_rating, {n_if("sentiment_label = 'positive'")} AS positive_count,
       {n_if("sentiment_label = 'negative'")} AS negative_count, {n_if("sentiment_label = 'neutral'")} AS neutral_count,
       r.name AS restaurant_name
FROM b_scored p JOIN b_restaurants r ON p.place_id = r.place_id GROUP BY r.name, r.place_id""",
)


def api_analytics(n: int) -> str:
    return f"""
SELECT r.place_id, COUNT(*) AS prediction_count, {mean('predicted_score', 2)} AS avg_nlp_score,
       {mean('p.rating', 2)} AS avg_actual_rating, {n_if(POSITIVE)} AS positive_count, {n_if(NEGATIVE)} AS negative_count,
       r.name
FROM b_scored p JOIN b_restaurants r ON p.place_id = r.place_id GROUP BY r.name, r.place_id
HAVING COUNT(*) >= 20 ORDER BY avg_nlp_score DESC, r.place_id LIMIT {n}"""


oracle("sentiment_analytics_api", api_analytics(50))
oracle("analytics_strip", api_analytics(12))
oracle(
    "table_counts",
    """
SELECT 'restaurants' AS table_name, COUNT(*) AS row_count FROM b_restaurants
UNION ALL SELECT 'raw_reviews', COUNT(*) FROM b_copies UNION ALL SELECT 'processed_reviews', COUNT(*) FROM b_reviews
UNION ALL SELECT 'user_preferences', COUNT(*) FROM b_users UNION ALL SELECT 'texts', COUNT(*) FROM b_texts""",
)
oracle(
    "geo_grid_quality",
    f"""
SELECT CAST(floor(CAST(latitude AS DOUBLE) / 0.1) AS BIGINT) AS lat_cell,
       CAST(floor(CAST(longitude AS DOUBLE) / 0.1) AS BIGINT) AS lng_cell, COUNT(*) AS place_count,
       CAST(SUM(nlp_review_count) AS BIGINT) AS prediction_count, {mean('avg_nlp_score', 2)} AS avg_score
FROM b_restaurants JOIN (SELECT place_id, avg_nlp_score, nlp_review_count FROM b_summary) USING (place_id) GROUP BY ALL""",
)
oracle(
    "credibility_score",
    f"""
SELECT place_id, {rnd("SUM(CAST(predicted_score AS DOUBLE) * ln(1 + n)) / SUM(ln(1 + n))", 3)} AS credibility_score,
       COUNT(*) AS review_count
FROM b_scored JOIN (SELECT author_name, COUNT(*) AS n FROM b_reviews GROUP BY author_name) USING (author_name)
GROUP BY place_id""",
)
oracle(
    "volume_anomalies",
    f"""
SELECT day, volume, {rnd('m', 6)} AS trailing_mean, {rnd('s', 6)} AS trailing_std, {rnd('(volume - m) / nullif(s, 0)', 6)} AS z_score,
       coalesce(abs((volume - m) / nullif(s, 0)) >= 2, FALSE) AS is_anomaly
FROM (SELECT day, volume, AVG(volume) OVER w AS m, STDDEV_SAMP(volume) OVER w AS s
      FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS volume FROM events GROUP BY 1)
      WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
)

# --- cleaning, features, statistics

oracle("dedup_reviews", f"SELECT {RAW_COLUMNS} FROM b_raw_one")
oracle("clean_reviews", "SELECT review_id, place_id, rating, text_cleaned, review_date FROM b_clean")
oracle("clean_reviews_job", "SELECT review_id, place_id, rating, text_cleaned, review_date FROM b_clean_job")
oracle(
    "clean_counts",
    """
SELECT i AS input_rows, o AS output_rows, i - o AS removed_rows
FROM (SELECT (SELECT COUNT(*) FROM b_raw) AS i, (SELECT COUNT(*) FROM b_clean) AS o)""",
)
oracle(
    "clean_batch_counts",
    f"SELECT COUNT(*) AS input_texts, {n_if(normalized('text') + " <> ''")} AS valid_texts FROM b_texts",
)
oracle(
    "engineer_features",
    r"""
SELECT review_id, place_id, language, restaurant_name, CASE WHEN rating < 1 THEN 1.0 WHEN rating > 5 THEN 5.0 ELSE rating END AS rating,
       time_epoch, ingested_at, made AS review_date, CAST(length(t) AS INT) AS review_length,
       CAST(len(regexp_split_to_array(t, '\s+')) AS INT) AS word_count, CAST(dayofweek(made) + 1 AS INT) AS day_of_week,
       TRUE AS has_text, CAST(date_diff('day', CAST(made AS DATE), DATE '2024-06-01') AS INT) AS review_age_days
FROM (SELECT *, make_timestamp(time_epoch * 1000000) AS made,
             regexp_replace(trim(regexp_replace(text, '<[^>]+>', '', 'g')), '\s+', ' ', 'g') AS t FROM b_texts)
WHERE length(t) > 5""",
)
oracle(
    "restaurant_stats",
    f"""
SELECT place_id, restaurant_name, COUNT(*) AS review_count, {rnd('AVG(rating)', 6)} AS avg_rating,
       {rnd('coalesce(STDDEV_SAMP(rating), 0)', 6)} AS rating_stddev, {rnd('AVG(review_length)', 6)} AS avg_review_length,
       {rnd('AVG(word_count)', 6)} AS avg_word_count, MAX(review_date) AS latest_review_date,
       MIN(review_date) AS earliest_review_date, {n_if('rating = 5')} AS five_star_count, {n_if('rating = 1')} AS one_star_count,
       {rnd(f"CAST({n_if('rating = 5')} AS DOUBLE) / COUNT(*)", 6)} AS positive_ratio
FROM b_featured GROUP BY place_id, restaurant_name""",
)
oracle(
    "restaurant_stats_job",
    f"""
SELECT place_id, restaurant_name, COUNT(*) AS review_count, {rnd('AVG(rating)', 2)} AS avg_rating,
       {rnd('STDDEV_SAMP(rating)', 2)} AS rating_stddev, {rnd('AVG(length(text_cleaned))', 0)} AS avg_review_length,
       MAX(review_date) AS latest_review, {n_if('rating >= 4')} AS positive_reviews, {n_if('rating <= 2')} AS negative_reviews,
       {rnd(f"CAST({n_if('rating >= 4')} AS DOUBLE) / COUNT(*)", 3)} AS positive_ratio
FROM b_clean_job GROUP BY place_id, restaurant_name""",
)
oracle(
    "top_by_avg_rating",
    f"""
SELECT place_id, restaurant_name, COUNT(*) AS review_count, {rnd('AVG(rating)', 6)} AS avg_rating FROM b_clean
GROUP BY place_id, restaurant_name ORDER BY avg_rating DESC NULLS LAST, place_id LIMIT 20""",
)
oracle(
    "rating_category",
    """
SELECT review_id, rating, CASE WHEN rating >= 4 THEN 'positive' WHEN rating <= 2 THEN 'negative' ELSE 'neutral' END AS rating_category
FROM b_raw_one""",
)
oracle("date_parts", f"SELECT o_orderkey, full_date, {ALL_PARTS} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS full_date FROM orders)")

# --- text and scoring

oracle("normalize_text", "SELECT review_id, text_cleaned FROM b_normal")
oracle("truncate_words", f"SELECT review_id, {first_words('text_cleaned', 10)} AS first_words FROM b_normal")
oracle("key_phrases", f"SELECT review_id, {PHRASES} AS key_phrases FROM b_normal")
oracle(
    "display_types",
    """
SELECT p_partkey AS place, CASE WHEN len(shown) = 0 THEN 'Restaurant' ELSE array_to_string(shown, ',') END AS labels
FROM (SELECT p_partkey, list_filter([
        CASE p_type WHEN 'PROMO' THEN 'Takeaway' WHEN 'SMALL' THEN 'Cafe' WHEN 'LARGE' THEN 'Night Club'
                    WHEN 'ECONOMY' THEN NULL WHEN 'MEDIUM' THEN NULL ELSE 'Grocery' END,
        CASE WHEN p_size > 25 THEN array_to_string(list_transform(string_split(p_name, ' '),
                    lambda w: upper(w[1]) || w[2:]), ' ') END], lambda x: x IS NOT NULL) AS shown FROM part)""",
)
oracle(
    "score_class",
    """
SELECT review_id, CASE WHEN s >= 4 THEN 'very-positive' WHEN s >= 3 THEN 'positive' WHEN s >= 2 THEN 'negative'
                       ELSE 'very-negative' END AS score_class
FROM (SELECT review_id, CASE WHEN rating <> 3 THEN predicted_score ELSE rating END AS s FROM b_scored)""",
)
oracle("score_from_logits", "SELECT doc_id, predicted_score, sentiment_label, confidence FROM b_judged")
oracle(
    "score_reviews",
    "SELECT review_id, predicted_score, sentiment_label, confidence, text_cleaned, model_version, predicted_at, key_phrases FROM b_text_scores",
)


def occurrences(word: str) -> str:
    return f"(length(text_cleaned) - length(replace(text_cleaned, '{word}', ''))) / {float(len(word))}"


oracle(
    "score_reviews_batched",
    f"""
SELECT review_id, CASE WHEN text_cleaned = '' THEN 3.0 ELSE {rnd('list_sum(list_transform(e, lambda x, i: x * i)) / list_sum(e)', 3)} END AS predicted_score,
       CASE WHEN text_cleaned = '' THEN 'neutral' ELSE
         ['very_negative', 'negative', 'neutral', 'positive', 'very_positive'][list_position(e, list_max(e))] END AS sentiment_label,
       CASE WHEN text_cleaned = '' THEN 0.0 ELSE {rnd('list_max(e) / list_sum(e)', 4)} END AS confidence,
       'keywords' AS model_version
FROM (SELECT review_id, text_cleaned, list_transform([1.0, 2.0, 3.0, 4.0, 5.0],
               lambda k: exp(CAST(-abs(k - 3.0 - lean) AS DOUBLE))) AS e
      FROM (SELECT *, round({occurrences('great')} - {occurrences('slow')} + {occurrences('pizza')}) AS lean FROM b_normal))""",
)
oracle(
    "ensure_scored",
    """
SELECT s.review_id, coalesce(k.rating, s.predicted_score) AS predicted_score,
       CASE WHEN k.rating >= 4 THEN 'positive' WHEN k.rating < 3 THEN 'negative' WHEN k.rating IS NOT NULL THEN 'neutral'
            ELSE s.sentiment_label END AS sentiment_label,
       CASE WHEN k.rating > 4 THEN 0.75 WHEN k.rating IS NOT NULL THEN 0.0 ELSE s.confidence END AS confidence,
       CASE WHEN k.rating IS NULL THEN s.model_version END AS model_version
FROM b_text_scores s LEFT JOIN b_ratings k USING (doc_id)""",
)
oracle(
    "score_reviews_trained",
    """
SELECT review_id, CASE WHEN text_cleaned = '' THEN 3.0::DOUBLE END AS predicted_score,
       CASE WHEN text_cleaned = '' THEN 'neutral' END AS sentiment_label,
       CASE WHEN text_cleaned = '' THEN 0.0::DOUBLE END AS confidence,
       true AS score_in_range, true AS label_known, true AS confidence_in_range, 'bag-of-words' AS model_version
FROM b_normal""",
)
VIEWS["b_all_scored"] = """
SELECT s.place_id, CAST(coalesce(k.rating, s.predicted_score) AS DECIMAL(18,3)) AS predicted_score,
       CASE WHEN k.rating >= 4 THEN 'positive' WHEN k.rating < 3 THEN 'negative' WHEN k.rating IS NOT NULL THEN 'neutral'
            ELSE s.sentiment_label END AS sentiment_label,
       CAST(CASE WHEN k.rating > 4 THEN 0.75 WHEN k.rating IS NOT NULL THEN 0.0 ELSE s.confidence END AS DECIMAL(18,4)) AS confidence,
       abs(s.doc_id) % 200 AS age
FROM b_text_scores s LEFT JOIN b_ratings k USING (doc_id)"""
VIEWS["b_all_analyses"] = analyses("b_all_scored")
VIEWS["b_all_labels"] = "SELECT place_id, sentiment_label, COUNT(*) AS n FROM b_all_scored GROUP BY ALL"
VIEWS["b_all_distribution"] = """
SELECT place_id, string_agg(concat(sentiment_label, ':', n), ',' ORDER BY sentiment_label) AS sentiment_distribution
FROM b_all_labels GROUP BY place_id"""
oracle(
    "analyze_partly_scored",
    """
SELECT a.*, d.sentiment_distribution, '2024-01-01' AS analyzed_at
FROM b_all_analyses a JOIN b_all_distribution d USING (place_id)""",
)
oracle(
    "score_backlog",
    """
SELECT s.review_id, s.place_id, coalesce(k.rating, s.predicted_score) AS predicted_score,
       CASE WHEN k.rating IS NULL THEN s.sentiment_label ELSE 'known' END AS sentiment_label,
       CASE WHEN k.rating IS NULL THEN s.model_version END AS model_version
FROM b_text_scores s LEFT JOIN b_ratings k USING (doc_id)""",
)
oracle(
    "prediction_rows",
    f"""
SELECT review_id, place_id, {rnd('predicted_score', 2)} AS predicted_score, sentiment_label, confidence, model_version, predicted_at
FROM b_text_scores""",
)
oracle(
    "batch_summary",
    f"""
SELECT COUNT(*) AS review_count, {mean('predicted_score', 2)} AS avg_score, {mean('confidence', 3)} AS avg_confidence
FROM b_text_scores""",
)

# --- analysis, ranking, recommendations

SCORES = [
    "review_count",
    "avg_predicted_score",
    "avg_confidence",
    "bayesian_score",
    "recency_weighted_score",
    "recommendation_score",
    "positive_ratio",
]
VIEWS["b_places_and_empty"] = """
SELECT place_id, name, array_to_string(types, ',') AS types FROM b_restaurants
UNION ALL SELECT concat('N', s_suppkey), 'Unknown', '' FROM supplier"""
oracle(
    "analyze_restaurants",
    f"""
SELECT r.place_id, r.name AS restaurant_name, r.types,
       {", ".join(f"coalesce(a.{c}, 0) AS {c}" for c in SCORES)}, coalesce(s.sentiment_distribution, '') AS sentiment_distribution
FROM b_places_and_empty r LEFT JOIN b_analyses a USING (place_id) LEFT JOIN b_distribution s USING (place_id)""",
)
oracle("sentiment_distribution", "SELECT place_id, sentiment_distribution FROM b_distribution")
oracle("bayesian_score", "SELECT place_id, review_count, bayesian_score FROM b_analyses")
oracle("place_scores_by_batch", "SELECT * FROM b_analyses")
oracle("recency_score", "SELECT place_id, recency_weighted_score FROM b_analyses")
oracle(
    "places_with_reviews",
    """
SELECT place_id, r.name, array_to_string(r.types, ',') AS types, s.review_id, s.rating AS stars,
       CAST(s.predicted_score AS DOUBLE) AS predicted_score, s.sentiment_label
FROM b_restaurants r JOIN b_scored s USING (place_id)""",
)
oracle("rank_restaurants", "SELECT rank, place_id, recommendation_score, review_count FROM b_ranked")
RECOMMENDATION = (
    "rank, place_id, restaurant_name, recommendation_score, avg_predicted_score, review_count, positive_ratio"
)
oracle("global_recommendations", f"SELECT {RECOMMENDATION}, sentiment_distribution AS sentiment_summary FROM b_ranked")
oracle(
    "recommend_for_user",
    f"""
SELECT {RECOMMENDATION}, sentiment_distribution AS sentiment_summary FROM b_ranked
WHERE avg_predicted_score >= 3.0 AND list_has_any(types, ['small', 'gear'])""",
)
oracle("recommend_for_users", f"SELECT user_id, {RECOMMENDATION} FROM b_user_recs")
oracle(
    "als_recommendations",
    """
SELECT user_id, place_id, rank,
       user_id IN (SELECT concat('U', o_custkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
         AND place_id IN (SELECT concat('P', l_partkey) FROM orders JOIN lineitem ON l_orderkey = o_orderkey) AS rated,
       CAST(COUNT(*) OVER (PARTITION BY user_id) AS INT) AS last_position,
       CAST(COUNT(*) OVER (PARTITION BY user_id) AS INT) AS n_positions
FROM b_user_recs""",
)
oracle(
    "als_errors",
    """
WITH rated AS (
  SELECT concat('U', o_custkey) AS u, concat('P', l_partkey) AS p,
         CAST(SUM(1 + CAST(l_quantity AS INT) % 5) AS DOUBLE) / COUNT(*) AS rating
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
split AS (SELECT *, substring(md5(concat(u, '|', p)), 1, 2) < '20' AS held FROM rated),
t AS (SELECT * FROM split WHERE NOT held),
h AS (
  SELECT rating, u IN (SELECT u FROM t) AND p IN (SELECT p FROM t) AS covered FROM split WHERE held)
SELECT COUNT(*) AS held, COUNT(*) FILTER (covered) AS covered,
       round(CAST(sqrt(AVG((rating - (SELECT AVG(rating) FROM t)) ** 2) FILTER (covered)) AS DECIMAL(18,8)), 6)::DOUBLE AS rmse_mean,
       true AS near_mean
FROM h""",
)
oracle(
    "als_new_places",
    """
WITH rated AS (
  SELECT DISTINCT concat('U', o_custkey) AS u, l_partkey AS p FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
n AS (SELECT u, least(10, (SELECT COUNT(DISTINCT p) FROM rated) - COUNT(*)) AS n FROM rated GROUP BY u)
SELECT u AS user_id, n AS n_places, n AS n_distinct, CAST(n AS INT) AS last_position, 0::BIGINT AS n_known FROM n WHERE n > 0""",
)
oracle(
    "recommend_price_location",
    """
SELECT rank, place_id, recommendation_score, price_level FROM (
  SELECT *, radians(CAST(latitude AS DOUBLE) - 33.4255) / 2 AS dlat, radians(CAST(longitude AS DOUBLE) + 111.94) / 2 AS dlng
  FROM b_ranked_200)
WHERE price_level BETWEEN 2 AND 4
  AND 2 * 6371.0 * asin(sqrt(sin(dlat) * sin(dlat) + cos(radians(33.4255)) * cos(radians(CAST(latitude AS DOUBLE))) * sin(dlng) * sin(dlng))) <= 60""",
)
oracle(
    "recommend_nearby",
    """
SELECT * FROM (WITH near AS (
  SELECT user_id, min_rating, 33 + CAST(substr(user_id, 2) AS INT) % 97 / 97.0::DOUBLE AS lat,
         -112 + CAST(substr(user_id, 2) AS INT) % 67 / 97.0::DOUBLE AS lng, CAST(2 + c_nationkey % 10 AS DOUBLE) AS max_km
  FROM b_users WHERE c_nationkey <> 3),
pairs AS (
  SELECT n.*, a.place_id, r.name AS restaurant_name, recommendation_score, avg_predicted_score, review_count,
         radians(CAST(latitude AS DOUBLE) - lat) / 2 AS dlat, radians(CAST(longitude AS DOUBLE) - lng) / 2 AS dlng,
         cos(radians(lat)) * cos(radians(CAST(latitude AS DOUBLE))) AS c
  FROM near n JOIN b_analyses a ON min_rating IS NULL OR avg_predicted_score >= min_rating
  JOIN b_restaurants r ON r.place_id = a.place_id WHERE review_count >= 20)
SELECT user_id, place_id, restaurant_name, recommendation_score, avg_predicted_score, review_count,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY recommendation_score DESC, place_id) AS INT) AS position
FROM pairs WHERE 2 * 6371.0 * asin(sqrt(sin(dlat) * sin(dlat) + c * sin(dlng) * sin(dlng))) <= max_km
QUALIFY position <= 5)""",
)
oracle(
    "recommendation_docs",
    """
SELECT user_id, string_agg(concat(rank, ':', place_id), ',' ORDER BY rank) AS recommendations, '2024-01-01' AS generated_at
FROM b_user_recs GROUP BY user_id""",
)
oracle(
    "upsert_recommendations",
    """
SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.list, o.list) AS recommendations,
       CASE WHEN n.user_id IS NULL THEN '2023-12-31' ELSE '2024-01-01' END AS generated_at
FROM (SELECT user_id, string_agg(concat(rank, ':', place_id), ',' ORDER BY rank) AS list
      FROM b_user_recs WHERE rank <= 10 GROUP BY user_id) o
FULL JOIN (SELECT user_id, string_agg(concat(rank, ':', place_id), ',' ORDER BY rank) AS list
      FROM b_user_recs WHERE recommendation_score >= 2.9 GROUP BY user_id) n ON o.user_id = n.user_id""",
)
oracle(
    "served_recommendations",
    f"""
SELECT {RECOMMENDATION}, array_to_string(types, ',') AS types, '2024-01-01' AS generated_at, 'precomputed' AS source FROM b_ranked_200
WHERE avg_predicted_score >= 2.9 AND len(list_filter(types, lambda t: contains(lower(t), 'mall'))) > 0
ORDER BY rank LIMIT 40""",
)
oracle(
    "live_recommendations",
    f"""
SELECT CAST(row_number() OVER (ORDER BY m DESC, place_id) AS INT) AS rank, place_id, coalesce(name, 'Unknown') AS restaurant_name,
       {rnd('m', 2)} AS avg_predicted_score, {rnd('m', 2)} AS recommendation_score, n AS review_count,
       {rnd('CAST(pos AS DOUBLE) / n', 3)} AS positive_ratio, array_to_string(types, ',') AS types,
       '2024-01-01' AS generated_at, 'live_nlp' AS source
FROM b_live LEFT JOIN (SELECT place_id, name, types FROM b_restaurants) USING (place_id) ORDER BY m DESC, place_id LIMIT 20""",
)
oracle(
    "rating_fallback",
    """
SELECT CAST(row_number() OVER (ORDER BY rating DESC NULLS LAST, place_id) AS INT) AS rank, place_id, name AS restaurant_name,
       CAST(coalesce(rating, 0) AS DOUBLE) AS avg_predicted_score, CAST(coalesce(rating, 0) AS DOUBLE) AS recommendation_score,
       CAST(total_ratings AS BIGINT) AS review_count, CAST(0 AS DOUBLE) AS positive_ratio,
       array_to_string(types, ',') AS types, '2024-01-01' AS generated_at, 'google_rating_fallback' AS source
FROM (SELECT * REPLACE (CASE WHEN rating * 100 % 10 <> 0 THEN rating END AS rating) FROM b_restaurants)
ORDER BY rating DESC NULLS LAST, place_id LIMIT 20""",
)

# --- serving

oracle(
    "search_restaurants",
    f"""
SELECT * FROM (
  SELECT f.*, coalesce({rnd('m', 2)}, 0) AS avg_nlp_score, coalesce({rnd('CAST(pos AS DOUBLE) / n', 3)}, 0) AS positive_ratio,
         coalesce(n, 0) AS nlp_review_count
  FROM (SELECT {PLACE} FROM b_restaurants
        WHERE regexp_matches(lower(name), 'bolt|gear') AND rating >= 2.0
          AND len(list_filter(types, lambda t: contains(lower(t), 'sm'))) > 0
        ORDER BY b_restaurants.rating DESC, place_id LIMIT 100) f
  LEFT JOIN b_live USING (place_id))
WHERE avg_nlp_score >= 2.9""",
)
oracle(
    "search_by_postings",
    f"""
SELECT f.*, coalesce({rnd('m', 2)}, 0) AS avg_nlp_score, coalesce({rnd('CAST(pos AS DOUBLE) / n', 3)}, 0) AS positive_ratio,
       coalesce(n, 0) AS nlp_review_count
FROM (SELECT {PLACE} FROM b_restaurants
      WHERE regexp_matches(lower(name), 'bolt|gear') AND len(list_filter(types, lambda t: contains(lower(t), 'small'))) > 0
      ORDER BY b_restaurants.rating DESC, place_id LIMIT 100) f
LEFT JOIN b_live USING (place_id)""",
)
oracle("list_restaurants", f"SELECT {PLACE} FROM b_restaurants ORDER BY b_restaurants.rating DESC, place_id LIMIT 100")
oracle(
    "unprocessed_reviews",
    """
SELECT review_id, place_id, rating, CAST(review_date AS DATE) AS review_date FROM b_reviews
WHERE review_date >= TIMESTAMP '2000-01-01'""",
)
oracle(
    "unprocessed_batch",
    """
SELECT review_id, place_id, rating FROM b_reviews WHERE review_date >= TIMESTAMP '2000-01-01'
ORDER BY review_id LIMIT 5000""",
)
oracle(
    "place_top_reviews",
    """
SELECT review_id, place_id, author_name, rating, CASE WHEN done THEN CAST(predicted_score AS DOUBLE) END AS predicted_score,
       CASE WHEN done THEN sentiment_label END AS sentiment_label, CASE WHEN done THEN CAST(confidence AS DOUBLE) END AS confidence,
       CASE WHEN done THEN 'processed' ELSE 'raw' END AS source
FROM (SELECT s.*, coalesce(r.rating >= 3, FALSE) AS done
      FROM b_scored s LEFT JOIN (SELECT place_id, rating FROM b_restaurants) r USING (place_id))
QUALIFY row_number() OVER (PARTITION BY place_id
    ORDER BY CASE WHEN done THEN predicted_score ELSE rating END DESC, review_id) <= 10""",
)

# --- streams

oracle(
    "stream_ingest",
    r"""
SELECT review_id, place_id, author_name, rating, text_cleaned, CAST(length(text_cleaned) AS INT) AS review_length,
       CAST(len(regexp_split_to_array(text_cleaned, '\s+')) AS INT) AS word_count,
       CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-06-01') AS INT) AS review_age_days
FROM b_event_reviews WHERE length(text_cleaned) > 5""",
)
oracle(
    "stream_counts",
    "SELECT CAST(ts AS DATE) AS window_day, event_type AS place_id, COUNT(*) AS review_count FROM events GROUP BY ALL",
)

# the same results by way of bucketed tables
ORACLE["merge_bucketed"] = ORACLE["merge_fact_reviews"]
ORACLE["backlog_bucketed"] = ORACLE["unprocessed_reviews"]

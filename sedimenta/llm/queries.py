"""The named queries of the corpus operators, each with its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm import (
    collocations,
    katz,
    mixing,
    near_vectors,
    ngram_join,
    packing,
    pii,
    quality,
    records,
    rules,
    topk,
    toxicity,
    whitening,
)
from sedimenta.llm.shared import read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn, sql: str | None = None):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(read(spark, sf_dir, "documents"))


@query
def op4_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(read(spark, sf_dir, "embeddings"))


@query
def op5_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read(spark, sf_dir, "documents"))


@query
def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.record_digest(read(spark, sf_dir, "documents"))


@query
def op9_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


@query
def op10_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(read(spark, sf_dir, "documents"))


@query
def op11_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_verdicts(read(spark, sf_dir, "documents"))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(read(spark, sf_dir, "documents"))


ORACLES["op6_mix_sources"] = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents),
per AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT source, source_size, 2 * source_size AS cap,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM per),
levels AS (
    SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
            - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
        row_number() OVER w AS place
    FROM weighed WINDOW w AS (ORDER BY cap / weight, source NULLS LAST)),
held AS (
    SELECT arg_min(level, place) AS level FROM levels WHERE weight * level <= cap),
targets AS (
    SELECT source, source_size,
        CASE WHEN held.level IS NULL THEN cap::DOUBLE ELSE least(weight * held.level, cap::DOUBLE) END AS target
    FROM levels, held),
ordered AS (
    SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS times,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
    times * size + least(greatest(floor(target)::BIGINT - times * source_size - (upto - size), 0), size) AS taken
FROM ordered
"""

ORACLES["op4_top_inner_products"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""

ORACLES["op5_near_duplicate_vectors"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (
    SELECT x, y FROM links
    UNION
    SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, y) AS component_id,
    e.vec_id = least(e.vec_id, y) AS kept
FROM embeddings e LEFT JOIN counted c ON c.x = e.vec_id LEFT JOIN least m ON m.x = e.vec_id
"""

ORACLES["op13_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL),
cut AS (
    SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
phrases AS (
    SELECT lang, len, unnest(list_transform(range(1, len(w) - len + 2), lambda i: array_to_string(w[i:i + len - 1], ' '))) AS phrase
    FROM cut, range(1, 6) AS lengths(len) WHERE len(w) >= len),
f AS (SELECT lang, len, phrase, count(*)::BIGINT AS a FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE len >= 2 AND a >= 100),
inside AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS longer
    FROM candidates, range(2, 5) AS shorter(k), range(1, 5) AS starts(i)
    WHERE k < len AND i + k - 1 <= len GROUP BY ALL),
cuts AS (
    SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, n, k,
        (1000::HUGEINT * c.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM candidates c JOIN totals USING (lang), range(1, 5) AS cut_at(k), f l, f r
    WHERE k < c.len AND l.lang = c.lang AND r.lang = c.lang
        AND l.phrase = array_to_string(c.w[:k], ' ') AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (
    SELECT * FROM cuts c WHERE NOT EXISTS (
        FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.longer >= 100 * c.a)
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank,
        phrase, a, l, r, n, score
    FROM weakest)
SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLES["op12_quality_rules"] = r"""
WITH t AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM t),
sized AS (
    SELECT id, doc_id, lang, len(w)::BIGINT AS n_words, length(text)::BIGINT AS chars,
        length(text) - length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS blank,
        length(text) - length(regexp_replace(text, '[a-z]+', '', 'g')) AS low,
        length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g')) AS up,
        length(text) - length(regexp_replace(text, '[0-9]+', '', 'g')) AS digit,
        length(text) - length(regexp_replace(text, '[^\x00-\x7F]+', '', 'g')) AS wide,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
    FROM w),
windows AS (SELECT id, unnest(range(1, len(w) - 1)) AS i, unnest(list_zip(w, w[2:], w[3:])[:len(w) - 2]) AS g FROM w WHERE len(w) > 2),
again AS (SELECT id, i FROM windows QUALIFY count(*) OVER (PARTITION BY id, g) > 1),
repeats AS (SELECT id, count(DISTINCT i + k)::BIGINT AS n FROM again, range(3) AS shifts(k) GROUP BY id),
single AS (SELECT id, lang, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word FROM t),
per_lang AS (SELECT lang, word, count(*) AS n FROM single GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS language_words FROM per_lang GROUP BY lang),
common AS (
    SELECT * FROM per_lang WHERE length(word) <= 4
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 16),
classes AS (
    SELECT id, lang, chars, n_words, unnest(['blank', 'low', 'up', 'digit', 'wide', 'rest']) AS class,
        unnest([blank, low, up, digit, wide, chars - blank - low - up - digit - wide]) AS n
    FROM sized),
class_shares AS (
    SELECT lang, class, sum(n)::DOUBLE / sum(sum(n)) OVER (PARTITION BY lang)::DOUBLE AS q FROM classes GROUP BY lang, class),
word_counts AS (
    SELECT s.id, s.word, count(*) AS n FROM single s JOIN common USING (lang, word) GROUP BY ALL),
word_bins AS (
    SELECT id, coalesce(wc.n, 0)::DOUBLE / n_words AS p, c.n::DOUBLE / language_words::DOUBLE AS q
    FROM sized JOIN totals t USING (lang) JOIN common c USING (lang) LEFT JOIN word_counts wc USING (id, word)
    WHERE n_words >= 50 AND language_words >= 10000
    UNION ALL
    SELECT id, 1 - coalesce((SELECT sum(n) FROM word_counts x WHERE x.id = s.id), 0)::DOUBLE / n_words,
        1 - (SELECT sum(n) FROM common c WHERE c.lang = s.lang)::DOUBLE / language_words::DOUBLE
    FROM sized s JOIN totals USING (lang) WHERE n_words >= 50 AND language_words >= 10000),
class_bins AS (
    SELECT id, n::DOUBLE / chars::DOUBLE AS p, q FROM classes JOIN class_shares USING (lang, class) JOIN totals USING (lang)
    WHERE n_words >= 50 AND chars >= 200 AND language_words >= 10000),
bins AS (SELECT id, 'w' AS kind, p, q FROM word_bins UNION ALL SELECT id, 'c', p, q FROM class_bins),
far AS (
    SELECT id, kind, round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)), 6) AS d
    FROM bins GROUP BY ALL),
judged AS (
    SELECT s.*, coalesce(r.n, 0) AS n_repeat_words, c.d AS character_distance, v.d AS word_distance,
        n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed
    FROM sized s LEFT JOIN repeats r USING (id) LEFT JOIN far c ON c.id = s.id AND c.kind = 'c'
        LEFT JOIN far v ON v.id = s.id AND v.kind = 'w')
SELECT doc_id, n_words, chars - blank AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    character_distance, word_distance,
    NOT base_failed AND coalesce(character_distance, 0) <= 0.35
        AND coalesce(word_distance, 0) <= 0.25 + 1 / sqrt(greatest(n_words, 1)) AS kept
FROM judged
"""

"""The operators of this subpackage as queries over whole tables, beside SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from daygrain.llm import decontaminate, hard_negatives, html_text, language, lexical, licenses, line_runs, ngram_join, packing, pivot_search, pq_dedup, quality, token_counts
from daygrain.llm.tables import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op10_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in every document."""
    return licenses.licenses(table(spark, folder, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document: five-word shingles, similarity of at least 0.8."""
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


OP9_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN reach r ON r.a = d.doc_id
GROUP BY d.doc_id
"""


def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with a cosine of at least 0.9, and the classes they form."""
    return pq_dedup.near_vectors(table(spark, folder, "embeddings"))


OP1_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), component AS (
    SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counted AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON component.a = vec_id LEFT JOIN counted ON counted.a = vec_id
"""


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram tokens of every document under a public vocabulary."""
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; sources are the hosts, and a source's texts in one language a path."""
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", "source", "lang")
    return quality.quality(docs, table(spark, folder, "labels"), F.col("source"), path)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones."""
    docs = table(spark, folder, "documents")
    return language.languages(docs, language.learn(docs))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, word for word or with other numbers, names and units."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_UNITS = ", ".join(f"'{u}'" for u in decontaminate.UNITS)
_MARKS = "('.', '!', '?', chr(10))"
OP7_SQL = rf"""
WITH texts AS (
    SELECT doc_id AS id, true AS is_doc, '' AS variant, text FROM documents WHERE doc_id IS NOT NULL
    UNION ALL SELECT DISTINCT item_id, false, text, text FROM benchmark WHERE item_id IS NOT NULL
), found AS (
    SELECT id, is_doc, variant, regexp_extract_all(
        regexp_replace(replace(text, chr(1), ' '), '([{decontaminate.UNSPACED}])', ' \1 ', 'g'), '[.!?\n]|{decontaminate.NUMBER}|[\p{{L}}\p{{M}}]+') AS t
    FROM texts
), named AS (
    SELECT id, is_doc, variant, list_filter(list_transform(t, lambda x, i: CASE WHEN x NOT IN {_MARKS} THEN
        {{'v': lower(x), 'name': i > 1 AND regexp_matches(x, '^[\p{{Lu}}\p{{Lt}}]') AND t[i - 1] NOT IN {_MARKS}}} END), lambda x: x IS NOT NULL) AS s
    FROM found
), typed AS (
    SELECT id, is_doc, variant, len(s) AS n, list_transform(s, lambda x, i: {{'v': x.v, 'name': x.name, 'plain': CASE
        WHEN x.v[1] BETWEEN '0' AND '9' THEN '#' WHEN i > 1 AND s[i - 1].v[1] BETWEEN '0' AND '9' AND x.v IN ({_UNITS}) THEN '~' ELSE x.v END}}) AS s
    FROM named WHERE len(s) > 0
), sizes AS (
    SELECT DISTINCT least(n, 5) AS size FROM typed WHERE NOT is_doc UNION SELECT 5
), places AS (
    SELECT id, is_doc, variant, s, size, unnest(range(1, n - size + 2)) AS p
    FROM typed JOIN sizes ON n >= size AND (is_doc OR size = least(n, 5))
), slices AS (
    SELECT id, is_doc, variant, size, p, list_transform(s[p:p + size - 1], lambda x: x.v) AS v,
        list_transform(s[p:p + size - 1], lambda x: CASE WHEN x.name THEN '^' ELSE x.plain END) AS kinds,
        list_transform(s[p:p + size - 1], lambda x: x.plain) AS plain
    FROM places
), forms AS (
    SELECT * EXCLUDE (plain, kinds), kinds AS k, true AS typed, len(list_filter(kinds, lambda x: x NOT IN ('#', '^', '~'))) = 0 AS wordless FROM slices
    UNION ALL SELECT * EXCLUDE (plain, kinds), plain, false, len(list_filter(kinds, lambda x: x NOT IN ('#', '^', '~'))) = 0
    FROM slices WHERE size = 5 AND list_contains(kinds, '^')
), windows AS (
    SELECT *, CASE WHEN size = 5 AND len(list_filter(k, lambda x: x NOT IN ('#', '^', '~'))) > 0 THEN 'by template' || chr(31) || array_to_string(k, chr(31))
        ELSE size || 'by value' || chr(31) || array_to_string(v, chr(31)) END AS key
    FROM forms
), rich AS (
    SELECT DISTINCT id, variant FROM windows WHERE NOT is_doc AND typed AND NOT wordless
), wanted AS (
    SELECT w.* FROM windows w LEFT JOIN rich r ON r.id = w.id AND r.variant = w.variant WHERE NOT is_doc AND NOT (wordless AND size = 5 AND r.id IS NOT NULL)
), total AS (
    SELECT id AS item_id, variant, count(*) AS n_windows FROM wanted WHERE typed GROUP BY ALL
), met AS (
    SELECT row_number() OVER () AS r, d.id AS doc_id, i.id AS item_id, i.variant, d.p - i.p AS shift, i.p AS item_pos,
        d.typed AND i.typed AS typed, NOT list_contains(i.k, '^') AS plain, i.k, i.v AS iv, d.v AS dv
    FROM windows d JOIN wanted i ON d.is_doc AND d.key = i.key
), slots AS (
    SELECT r, doc_id, item_id, variant, shift, item_pos, typed, plain, item_pos + j AS pos, k[j] AS kind, iv[j] AS asked, dv[j] AS given
    FROM (SELECT *, unnest(range(1, len(k) + 1)) AS j FROM met) WHERE k[j] IN ('#', '^', '~')
), clashes AS (
    SELECT DISTINCT doc_id, item_id, variant, shift FROM slots WHERE typed
    GROUP BY doc_id, item_id, variant, shift, kind, asked HAVING count(DISTINCT given) > 1
), strict AS (
    SELECT r, doc_id, item_id, variant, item_pos FROM met ANTI JOIN clashes USING (doc_id, item_id, variant, shift) WHERE typed
), votes AS (
    SELECT f.form, doc_id, item_id, variant, shift, kind, asked, given, count(DISTINCT pos) AS n
    FROM slots JOIN (VALUES ('typed'), ('plain')) f(form) ON CASE f.form WHEN 'typed' THEN typed ELSE plain END GROUP BY ALL
), usual AS (
    SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY form, doc_id, item_id, variant, shift, kind, asked ORDER BY n DESC, given = asked DESC, given DESC) = 1
), odd AS (
    SELECT DISTINCT u.form, s.doc_id, s.item_id, s.variant, s.shift, s.item_pos
    FROM slots s JOIN usual u USING (doc_id, item_id, variant, shift, kind, asked)
    WHERE s.given <> u.given AND CASE u.form WHEN 'typed' THEN s.typed ELSE s.plain END
), near AS (
    SELECT f.form, r, doc_id, item_id, variant, item_pos
    FROM (SELECT m.*, f.form FROM met m JOIN (VALUES ('typed'), ('plain')) f(form) ON CASE f.form WHEN 'typed' THEN typed ELSE plain END) f
    ANTI JOIN odd USING (form, doc_id, item_id, variant, shift, item_pos)
), same AS (
    SELECT r, doc_id, item_id, variant, item_pos FROM met WHERE plain AND r NOT IN (SELECT r FROM slots WHERE asked <> given)
), enough AS (
    SELECT 2 AS rank, * FROM strict
    UNION ALL SELECT 1, * FROM (SELECT * FROM strict UNION SELECT * EXCLUDE (form) FROM near WHERE form = 'plain' UNION SELECT * FROM same)
    UNION ALL SELECT 0, * EXCLUDE (form) FROM near WHERE form = 'typed'
), counted AS (
    SELECT rank, doc_id, item_id, variant, count(DISTINCT e.item_pos) AS n_found, count(DISTINCT s.pos) AS n_slots,
        count(DISTINCT s.pos) FILTER (s.asked <> s.given) AS n_changed
    FROM enough e LEFT JOIN (SELECT r, pos, asked, given FROM slots) s USING (r) GROUP BY ALL
)
SELECT doc_id, item_id, n_windows, n_found, n_slots, n_changed, ['majority', 'caseless', 'aligned'][rank + 1] AS form
FROM counted JOIN total USING (item_id, variant) WHERE 100 * n_found >= 80 * n_windows
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY rank DESC, n_found / n_windows DESC) = 1
"""


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of at least 40 characters in at least 5 documents, dropped but in the last document."""
    done = line_runs.line_dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
), repeated AS (
    SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (holder > doc_id) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (holder IS NULL OR holder = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k)
GROUP BY doc_id
"""


def op11_hard_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, from all others; the labels of every seventh are moved on by one."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


_WHOLE = """SELECT {columns}, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
OP11_SQL = f"""
WITH vectors AS (
    {_WHOLE.format(columns="vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")} AND label IS NOT NULL
), met AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, list_inner_product(a.e, b.e)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN met USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five vectors of highest inner product for every fiftieth vector."""
    return pivot_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


OP12_SQL = f"""
WITH vectors AS (
    {_WHOLE.format(columns="vec_id")}
)
SELECT a.vec_id AS query_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.e, b.e) DESC, b.vec_id)::INTEGER AS rank,
    b.vec_id AS vec_id, list_inner_product(a.e, b.e)::BIGINT AS score
FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
QUALIFY rank <= 5
"""


def op13_ranked_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return lexical.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP13_SQL = r"""
WITH words AS (
    SELECT doc_id, row_number() OVER () AS r,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents WHERE doc_id IS NOT NULL
), facts AS (
    SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM words WHERE len(t) > 0
), asked AS (
    SELECT item_id, i, unnest(t) AS term FROM (
        SELECT item_id, row_number() OVER () AS i,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
        FROM benchmark WHERE item_id IS NOT NULL)
), postings AS (
    SELECT doc_id, r, n, term, count(*) AS tf FROM (SELECT doc_id, r, len(t) AS n, unnest(t) AS term FROM words) GROUP BY ALL
), held AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, facts GROUP BY term, docs
), impacts AS (
    SELECT doc_id, r, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))) AS part
    FROM postings JOIN held USING (term), facts
), scored AS (
    SELECT item_id, i, doc_id, r, sum(part)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of corpus_pipeline.py over the documents."""
    return corpus_pipeline.run(spark, folder)


LLM_REGISTRY: dict[str, tuple[Query, str | None]] = {
    "op1_embedding_near_dedup": (op1_embedding_near_dedup, OP1_SQL),
    "op2_token_counts": (op2_token_counts, None),
    "op3_best_fit_packing": (op3_best_fit_packing, None),
    "op4_quality_classifier": (op4_quality_classifier, None),
    "op5_language_id": (op5_language_id, None),
    "op6_html_extraction": (op6_html_extraction, None),
    "op7_benchmark_decontamination": (op7_benchmark_decontamination, OP7_SQL),
    "op8_line_dedup": (op8_line_dedup, OP8_SQL),
    "op9_ngram_jaccard_join": (op9_ngram_jaccard_join, OP9_SQL),
    "op10_license_scans": (op10_license_scans, None),
    "op11_hard_negative_mining": (op11_hard_negative_mining, OP11_SQL),
    "op12_exact_top_k": (op12_exact_top_k, OP12_SQL),
    "op13_ranked_lexical_search": (op13_ranked_lexical_search, OP13_SQL),
    "pipeline": (pipeline, corpus_pipeline.ORACLE_SQL),
}

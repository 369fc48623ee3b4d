"""One query per operator over its whole table, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import conversations, language, licenses, mixing, multiset, packing, pivots, quality, recipes, simhash, spelling, tokens, urls, vocabularies

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(_table(spark, folder, "documents"), vocabularies.path("piece_bpe_32k.model"))


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), *vocabularies.byte_bpe())


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return multiset.edited_fingerprints(_table(spark, folder, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.near_duplicates(_table(spark, folder, "embeddings"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(_table(spark, folder, "pages"))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(_table(spark, folder, "documents"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.prefix_trie(_table(spark, folder, "conversations"))


def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.exact_duplicates(_table(spark, folder, "documents"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_license_scan,
        op2_token_counts,
        op3_simhash_near_dedup,
        op4_language_id,
        op5_packing,
        op6_document_fingerprints,
        op7_embedding_near_dedup,
        op8_url_filter,
        op9_source_mixing,
        op10_quality_classifier,
        op11_prefix_trie,
        op12_exact_dedup,
        op13_spelling_variants,
    )
    return {f.__name__: f for f in found}


MIXING = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS place,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER fuller, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER fuller, 0))::DOUBLE AS level
  FROM w WINDOW fuller AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, weight, least(weight * max(level) OVER (), (3 * source_size)::DOUBLE) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.source, t.weight,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY place, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, CASE WHEN whole < 3 THEN greatest(0, least(size, round(target - whole * source_size)::BIGINT - before)) ELSE 0 END AS part,
         least(1.0::DOUBLE, before / target) AS share, CASE weight WHEN 1 THEN -0.5 WHEN 2 THEN 0.0 ELSE 0.5 END::DOUBLE AS tilt
  FROM p
)
SELECT doc_id, size, source_size, target, (whole * size + part)::BIGINT AS taken, source,
       CASE WHEN target > 0 AND (whole > 0 OR part > 0)
            THEN 2 * share / ((1 - tilt) + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share)) END AS position
FROM q
"""


EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


# The CRC-32 of a text, bit by bit over its UTF-8 bytes: DuckDB has no function for it. ``points`` lists its code
# points, all below U+0100 here.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(flatten(list_transform({points},
    lambda u: CASE WHEN u < 128 THEN [u::BIGINT] WHEN u < 192 THEN [194::BIGINT, u::BIGINT] ELSE [195::BIGINT, (u - 64)::BIGINT] END)),
    lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))))"""

SPELLING = (
    r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), low AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS uses
  FROM runs WHERE length(run) >= 7 GROUP BY ALL
), marked AS (
  SELECT run, uses, """
    + CRC32.format(points="list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: unicode(c))")
    + r""" AS h FROM low
), v AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
         sum(uses)::BIGINT AS n
  FROM marked GROUP BY 1 HAVING length(word) >= 7 AND sum(uses) >= 2
), less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word)::INT + 1))::INT AS i FROM v)
), pairs AS (
  SELECT x.word AS a, v.word AS b FROM less x JOIN v ON x.rest = v.word
  UNION SELECT v.word, x.word FROM less x JOIN v ON x.rest = v.word
  UNION SELECT x.word, y.word FROM less x JOIN less y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
), near AS (
  SELECT a, b, s.n AS n, t.n AS near_n, row_number() OVER (PARTITION BY a ORDER BY t.n DESC, b) AS place,
         count(*) OVER (PARTITION BY a) AS n_near
  FROM pairs JOIN v s ON a = s.word JOIN v t ON b = t.word
), named AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN b END AS form,
         CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN near ON v.word = near.a AND place = 1
), onward AS (
  SELECT word, word AS root, form AS further FROM named
  UNION ALL SELECT o.word, o.further, m.form FROM onward o JOIN named m ON o.further = m.word
)
SELECT named.word, form, root, n, n_near, form_n FROM named JOIN onward ON named.word = onward.word AND further IS NULL
"""
)

PREFIX_TRIE = (
    r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, """
    + CRC32.format(points="list_transform(string_split(conv_id::VARCHAR, ''), lambda c: unicode(c))")
    + r""" % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own)
), lent AS (
  SELECT c.conv_id, o.pos, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.pos < h
), rebuilt AS (
  SELECT * FROM lent
  UNION ALL
  SELECT o.conv_id, o.pos - h + (SELECT count(*) FROM lent l WHERE l.conv_id = o.conv_id), role, text
  FROM own o JOIN convs c ON o.conv_id = c.conv_id AND o.pos >= h
), prefixes AS (
  SELECT conv_id, pos + 1 AS depth, strlen(text) AS n_bytes,
         list({role: role, text: text}) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turns
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, [] FROM convs
), nodes AS (
  SELECT depth, turns, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes FROM prefixes GROUP BY depth, turns
), above AS (
  SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id
  FROM nodes n JOIN nodes p ON p.depth = n.depth - 1 AND p.turns = n.turns[:n.depth - 1]
), counted AS (
  SELECT n.*, (SELECT count(*) FROM above a WHERE a.parent_conv_id = n.conv_id AND a.depth = n.depth + 1) AS n_children FROM nodes n
), sums AS (
  SELECT top.conv_id, top.depth, count(*) FILTER (low.n_children = 0) AS n_leaves, sum((low.n_convs - 1) * low.n_bytes)::BIGINT AS saved_tokens
  FROM nodes top JOIN counted low ON low.depth >= top.depth AND low.turns[:top.depth] = top.turns
  GROUP BY ALL
), ends AS (
  SELECT turns, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM prefixes p WHERE depth = (SELECT max(depth) FROM prefixes q WHERE q.conv_id = p.conv_id) GROUP BY turns
)
SELECT c.conv_id, c.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM counted c JOIN sums USING (conv_id, depth) LEFT JOIN above USING (conv_id, depth) LEFT JOIN ends ON c.turns = ends.turns
"""
)


def statements() -> dict[str, str]:
    """DuckDB SQL of the queries it can express: the others hash, learn or encode."""
    return {"op9_source_mixing": MIXING, "op11_prefix_trie": PREFIX_TRIE, "op12_exact_dedup": EXACT_DEDUP, "op13_spelling_variants": SPELLING}

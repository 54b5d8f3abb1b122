"""Registered queries of the operators, over whole tables, and their SQL counterparts where SQL can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from smeltworks.llm.common import table
from smeltworks.llm.conversation_trie import prefix_trie
from smeltworks.llm.embedding_dedup import embedding_dedup
from smeltworks.llm.exact_dedup import exact_dedup
from smeltworks.llm.html_wrappers import main_text
from smeltworks.llm.language_id import language_id
from smeltworks.llm.line_dedup import drop_boilerplate
from smeltworks.llm.merkle_manifest import merkle_manifest
from smeltworks.llm.packing import packed_digests
from smeltworks.llm.piece_encoding import encoded_digests
from smeltworks.llm.pii import personal_data
from smeltworks.llm.quality import quality
from smeltworks.llm.secrets import scan
from smeltworks.llm.simhash import simhash_dedup


def op1_host_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_dropped")


def op2_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op3_union_free_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op4_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op5_simhash_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op6_prefix_table_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_rotated_code_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op8_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_forest_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op11_ternary_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_pointer_jumping_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


#: DuckDB has no CRC-32: the bits of each byte of the text ``{0}`` are shifted through the polynomial one by one.
CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split({0}, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, 3988292384 * (r & 1)) END))"""


#: A value with its byte count, as the manifest hashes it.
SIZED = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_host_line_frequency,
        op2_ppm_language_id,
        op3_union_free_wrappers,
        op4_boosted_pii,
        op5_simhash_trie_join,
        op6_prefix_table_pieces,
        op7_rotated_code_vectors,
        op8_cuckoo_exact_dedup,
        op9_harmonic_packing,
        op10_forest_secret_scan,
        op11_ternary_conversation_trie,
        op12_positive_unlabelled_quality,
        op13_pointer_jumping_manifest,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_host_line_frequency": r"""
WITH pages AS (
    SELECT DISTINCT source, text FROM documents WHERE source IS NOT NULL AND text IS NOT NULL
), lines AS (
    SELECT DISTINCT source, text, line FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), often AS (
    SELECT source, line FROM lines JOIN (SELECT source, count(*) AS n FROM pages GROUP BY source) USING (source)
    GROUP BY source, line, n HAVING count(*) >= 3 AND count(*) * 100 > n * 10
), lists AS (
    SELECT source, list(line) AS bad FROM often GROUP BY source
), cut AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS before,
        list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(bad, []::VARCHAR[]), x)) AS after
    FROM documents LEFT JOIN lists USING (source)
)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN array_to_string(after, chr(10)) END AS text,
    coalesce(len(before) - len(after), 0) AS n_dropped
FROM cut
""",
        "op8_cuckoo_exact_dedup": r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
""",
        "op11_ternary_conversation_trie": f"""
WITH turns AS (
    SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
        substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest, chars) AS pos FROM turns
), convs AS (
    SELECT conv_id, {CRC32.format('conv_id::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)
), parts AS (
    SELECT c.conv_id, 0 AS part, pos, digest, chars FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 WHERE pos <= h
    UNION ALL
    SELECT c.conv_id, 1, pos, digest, chars FROM convs c JOIN own o ON o.conv_id = c.conv_id WHERE pos > h
), steps AS (
    SELECT conv_id, chars, row_number() OVER so_far AS depth, string_agg(digest, '') OVER so_far AS path
    FROM parts WINDOW so_far AS (PARTITION BY conv_id ORDER BY part, pos)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
    SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM steps GROUP BY depth, path
), full_paths AS (
    SELECT conv_id, max_by(path, depth) AS path FROM steps GROUP BY conv_id
), ends AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM full_paths GROUP BY path
), children AS (
    SELECT substr(path, 1, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
    SELECT substr(path, 1, 32 * up) AS path, sum((c.n IS NULL)::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) LEFT JOIN children c USING (path) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
    b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, 32 * (n.depth - 1))
LEFT JOIN children c ON c.path = n.path JOIN below b ON b.path = n.path LEFT JOIN ends e ON e.path = n.path
""",
        "op13_pointer_jumping_manifest": f"""
WITH RECURSIVE fields AS (
    SELECT doc_id, lang, doc_id IS NOT NULL AND n_chars IS NOT NULL AND {CRC32.format("coalesce(doc_id::VARCHAR, '')")} % 7 = 0 AS drilled,
        {SIZED.format('doc_id')} || {SIZED.format('source')} || {SIZED.format('lang')} AS before,
        {SIZED.format('n_chars')} AS n, {SIZED.format('(n_chars + 1)')} AS forged_n, {SIZED.format('text')} AS after
    FROM documents
), leaves AS (
    SELECT doc_id, lang, sha256(before || n || after) AS leaf,
        CASE WHEN drilled THEN sha256(before || forged_n || after) ELSE sha256(before || n || after) END AS given
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n FROM leaves
), nodes(lang, level, pos, h, n) AS (
    SELECT lang, 0, pos, leaf, n FROM placed
    UNION ALL
    SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n
), subroots AS (
    SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), crown(level, pos, h, n) AS (
    SELECT 0, pos, subroot, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM crown WHERE n > 1 GROUP BY level, pos // 2, n
), roots AS (
    SELECT h AS root, level AS top FROM crown WHERE n = 1
), siblings AS (
    SELECT d.lang, d.pos, step, (d.pos >> step) & 1 AS is_right, s.h
    FROM (SELECT p.lang, p.pos, unnest(range(0, r.height)) AS step FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang) d
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM d.lang AND s.level = step AND s.pos = xor(d.pos >> step, 1)
    UNION ALL
    SELECT d.lang, d.pos, d.height + d.step, (d.at >> d.step) & 1, s.h
    FROM (SELECT p.lang, p.pos, r.height, r.pos AS at, unnest(range(0, top)) AS step
          FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN roots) d
    LEFT JOIN crown s ON s.level = d.step AND s.pos = xor(d.at >> d.step, 1)
), proofs AS (
    SELECT lang, pos, list(CASE WHEN h IS NULL THEN '.' WHEN is_right = 1 THEN '<' || h ELSE '>' || h END ORDER BY step) AS steps,
        string_agg(h, '' ORDER BY step) AS joined
    FROM siblings GROUP BY lang, pos
), folded AS (
    SELECT p.doc_id, p.leaf, r.subroot, top.root, sha256(coalesce(f.joined, '')) AS proof_sha256,
        list_reduce([p.given] || coalesce(f.steps, []::VARCHAR[]), lambda h, s:
            sha256(CASE WHEN s = '.' THEN h WHEN s[1] = '<' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root
    FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN roots top
    LEFT JOIN proofs f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos
)
SELECT *, folded_root = root AS verified FROM folded
""",
    }

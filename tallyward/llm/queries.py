"""The registered queries of this package and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import alignment, attention_lm, byte_bpe, direct_codes, exact_dedup, language, near_dups, packing, prefix_trie, quotes, segmentations, sketches, token_counts
from tallyward.llm.tables import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), WORDS)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORDS)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.scored(table(spark, sf_dir, "documents"), WORDS)


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of all conversations, written as mails that quote each other, are linked again."""
    mails = quotes.replies_with_quotes(table(spark, sf_dir, "conversations"))
    turn = lambda c: F.split(c, ":")[1].cast("long")
    return quotes.conversations(mails).select(
        F.col("thread").cast("long").alias("conv_id"), F.col("sent").alias("turn"), turn("parent").alias("parent_turn"),
        turn("root").alias("root_turn"), "depth", "max_level", F.sha2("text", 256).alias("text_sha256"))


def op7_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations.sample_table(table(spark, sf_dir, "documents"), PIECES)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(table(spark, sf_dir, "documents"))


def op10_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct_codes.round_trip(table(spark, sf_dir, "documents"), WORDS)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), BYTES, PIECES)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), MULTI)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_packing": op2_packing,
    "op3_language": op3_language,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_attention_lm": op5_attention_lm,
    "op6_quotation_linking": op6_quotation_linking,
    "op7_segmentations": op7_segmentations,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_fingerprints": op9_fingerprints,
    "op10_direct_codes": op10_direct_codes,
    "op11_alignment": op11_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_byte_bpe": op13_byte_bpe,
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op4_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, {LOWER} AS norm FROM documents)
        WINDOW same AS (PARTITION BY norm)""",
    "op6_quotation_linking": """
        WITH turns AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn),
        runs AS (
            SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) = turn - 1 AS follows FROM turns),
        chains AS (
            SELECT *, max(CASE WHEN follows THEN NULL ELSE turn END) OVER (
                PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS root_turn FROM runs)
        SELECT conv_id, turn, CASE WHEN follows THEN turn - 1 END AS parent_turn, root_turn,
               turn - root_turn AS depth, least(turn - root_turn, 2) AS max_level,
               sha256(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_sha256
        FROM chains""",
    "op12_prefix_trie": """
        WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
            crcs AS (SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
                    range(1, length(c::VARCHAR) + 1), lambda i: [ascii(substr(c::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) AS crc FROM ids),
            turns AS (
                SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
                       coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
            asked AS (SELECT c, c - c % 5 AS b, crc % 9 AS h FROM crcs),
            given AS (SELECT a.c, a.h, count(t.i) AS got FROM asked a LEFT JOIN turns t ON t.c = a.b AND t.i <= a.h GROUP BY ALL),
            made AS (
                SELECT a.c, t.i AS d, role, text FROM asked a JOIN turns t ON t.c = a.b AND t.i <= a.h
                UNION ALL SELECT g.c, t.i - h + got, role, text FROM given g JOIN turns t ON t.c = g.c AND t.i > g.h),
            hashed AS (SELECT c, d, sha256(to_json([role, text])::VARCHAR) AS e, octet_length(encode(text)) AS size FROM made),
            path AS (
                SELECT c, d, sha256(string_agg(e, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d)) AS p, size FROM hashed
                UNION ALL SELECT c, 0, '', 0 FROM ids),
            lengths AS (SELECT c, max(d) AS n FROM path GROUP BY c),
            nodes AS (
                SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                       sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends
                FROM path JOIN lengths USING (c) GROUP BY d, p),
            kids AS (SELECT DISTINCT x.d, x.p, y.p AS q FROM path x JOIN path y ON x.c = y.c AND y.d = x.d + 1),
            fan AS (SELECT d, p, count(*) AS k FROM kids GROUP BY d, p),
            below AS (SELECT DISTINCT x.d, x.p, y.d AS e, y.p AS q FROM path x JOIN path y ON x.c = y.c AND y.d >= x.d),
            sums AS (
                SELECT b.d, b.p, count(*) FILTER (WHERE k IS NULL) AS leaves, sum((n_convs - 1) * size) AS saved
                FROM below b JOIN nodes m ON m.d = b.e AND m.p = b.q LEFT JOIN fan f ON f.d = b.e AND f.p = b.q GROUP BY b.d, b.p),
            above AS (SELECT k.d + 1 AS d, k.q AS p, m.conv_id AS up FROM kids k JOIN nodes m ON m.d = k.d AND m.p = k.p)
        SELECT m.conv_id, m.d AS depth, a.up AS parent_conv_id, m.n_convs, coalesce(f.k, 0) AS n_children, s.leaves AS n_leaves,
               s.saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
        FROM nodes m JOIN sums s ON s.d = m.d AND s.p = m.p LEFT JOIN fan f ON f.d = m.d AND f.p = m.p LEFT JOIN above a ON a.d = m.d AND a.p = m.p""",
    "op8_near_duplicates": f"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        places AS (
            SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0),
        shingles AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM places),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT p.x, p.y FROM (
                SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s)
                WHERE a.doc_id <> b.doc_id GROUP BY ALL) p
            JOIN sizes m ON m.doc_id = p.x JOIN sizes n ON n.doc_id = p.y WHERE 100 * c >= 75 * (m.n + n.n - c)),
        reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
        least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
               d.doc_id = least(d.doc_id, coalesce(y, d.doc_id)) AS kept
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least_of r ON r.x = d.doc_id""",
}

"""The text operators bound to the test tables, with the results their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytide.llm.common import table
from tallytide.llm.exact_dedup import exact_duplicates
from tallytide.llm.jaccard import similar_components
from tallytide.llm.language import identify_languages
from tallytide.llm.manifest import tamper_check
from tallytide.llm.merkle import edit_likeness
from tallytide.llm.mixing import layout_topic, mix, word_count
from tallytide.llm.packing import pack
from tallytide.llm.secret_scan import scan_secrets, summarize
from tallytide.llm.simhash import near_duplicates
from tallytide.llm.spelling import spelling_variants
from tallytide.llm.token_counts import token_counts
from tallytide.llm.tokens import vocabulary
from tallytide.llm.toxicity import detect_toxicity
from tallytide.llm.warc import archive_round_trip


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), 2048)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 2048)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": layout_topic(F.col("text"))}
    return mix(table(spark, sf_dir, "documents"), dims, word_count(F.col("text"))).select(
        "doc_id", *dims, "n_tokens", "factor", "probability", "sampled"
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents name no owners: their source is taken for one, and source and language for a
    repository."""
    found = scan_secrets(
        table(spark, sf_dir, "documents"),
        repository=F.concat_ws("/", "source", "lang"),
        owner=F.col("source"),
    )
    return summarize(found)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id",
        "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents"), without_id=True)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tamper_check(table(spark, sf_dir, "documents"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"), words=3, percent=90)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_token_counts": op2_token_counts,
    "op3_simhash": op3_simhash,
    "op4_mixing": op4_mixing,
    "op5_secret_scan": op5_secret_scan,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_merkle": op8_merkle,
    "op9_language": op9_language,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling": op11_spelling,
    "op12_manifest": op12_manifest,
    "op13_jaccard": op13_jaccard,
}

ORACLES: dict[str, str] = {
    "op12_manifest": """
        WITH RECURSIVE raw AS (
          SELECT *, row_number() OVER () AS rid, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g,
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
            xor(list_reduce(
              list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
              lambda x, o: CASE WHEN o >= 0 THEN xor(x, o) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384)
                ELSE x // 2 END), 4294967295) AS crc
          FROM documents),
        named AS (
          SELECT *, concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
            coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
            coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head
          FROM raw),
        leaves AS (
          SELECT rid, doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-'))
              ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claimed
          FROM named),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY g) AS n FROM leaves),
        nodes AS (
          SELECT g, 0 AS level, pos, leaf AS h, n FROM placed
          UNION ALL
          SELECT g, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8
          FROM nodes WHERE n > 1 GROUP BY g, level, pos // 8, n),
        subs AS (SELECT g, h AS subroot, level AS height FROM nodes WHERE n = 1),
        tops AS (
          SELECT 0 AS g, 0 AS level, g - 1 AS pos, subroot AS h, (SELECT count(*) FROM subs) AS n FROM subs
          UNION ALL
          SELECT 0, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8
          FROM tops WHERE n > 1 GROUP BY level, pos // 8, n),
        whole AS (SELECT * FROM nodes UNION ALL SELECT * FROM tops),
        steps AS (
          SELECT a.g, a.level, a.pos,
            coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
            coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
          FROM whole a JOIN whole b ON a.g = b.g AND a.level = b.level AND a.pos // 8 = b.pos // 8
          WHERE a.n > 1 GROUP BY a.g, a.level, a.pos),
        folds AS (
          SELECT rid, g, height, 0 AS level, CASE WHEN height = 0 THEN g - 1 ELSE pos END AS pos,
            claimed AS h, '' AS proof FROM placed JOIN subs USING (g)
          UNION ALL
          SELECT rid, f.g, height, f.level + 1, CASE WHEN f.level + 1 = height THEN f.g - 1 ELSE f.pos // 8 END,
            sha256(l || f.h || r), proof || l || r
          FROM folds f JOIN steps s ON s.g = (CASE WHEN f.level < height THEN f.g ELSE 0 END)
            AND s.level = (CASE WHEN f.level < height THEN f.level ELSE f.level - height END) AND s.pos = f.pos),
        ends AS (SELECT rid, arg_max(h, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256
                 FROM folds GROUP BY rid)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
        FROM leaves JOIN subs USING (g) JOIN ends USING (rid), (SELECT h AS root FROM tops WHERE n = 1)
    """,
    "op10_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
}

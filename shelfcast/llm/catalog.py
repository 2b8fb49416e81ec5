"""One query for each text operator, over the whole of its table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    decontaminate,
    embedding_dedup,
    exact_dedup,
    html_main,
    language,
    lexical,
    licenses,
    packing,
    pii,
    simhash,
    token_file,
    toxicity,
    whitening,
)
from shelfcast.llm.common import fold, table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", "spans", "removed")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places where documents hold benchmark items."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(docs, benchmark)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places where documents hold a license notice, each with the license that fits best."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), best=True)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.train(docs, labels, toxicity.training_fold()))
    return found.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted", "spans")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packing.pack(table(spark, sf_dir, "documents")).select(*columns)


def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract_main(table(spark, sf_dir, "pages"))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_file.write_and_read(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train(docs, language.training_fold()))
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that fit each benchmark item best."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_pii,
        op2_decontaminate,
        op3_licenses,
        op4_toxicity,
        op5_simhash_dedup,
        op6_pack,
        op7_html_main,
        op8_token_file,
        op9_exact_dedup,
        op10_language_id,
        op11_whitening,
        op12_lexical_search,
        op13_embedding_dedup,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op9_exact_dedup": """
            WITH t AS (
                SELECT doc_id, length(coalesce(text, '')) AS n,
                    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h
                FROM documents
            )
            SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
                first_value(doc_id) OVER best = doc_id AS kept, h AS text_sha256
            FROM t WINDOW best AS (PARTITION BY h ORDER BY n DESC, doc_id)
        """,
        "op12_lexical_search": r"""
            WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
            t AS (
                SELECT r, doc_id, unnest(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM d
            ),
            q AS (
                SELECT item_id, unnest(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM (SELECT DISTINCT item_id, text FROM benchmark)
            ),
            tf AS (SELECT r, doc_id, term, count(*)::BIGINT AS tf FROM t GROUP BY r, doc_id, term),
            n AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
            s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
            m AS (SELECT r, 75 + (25 * n * docs) // terms AS m FROM n, s),
            w AS (
                SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                FROM tf, s GROUP BY term
            ),
            f AS (
                SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
                FROM (SELECT item_id, term, count(*) AS times FROM q GROUP BY item_id, term)
                JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r)
                GROUP BY item_id, r, doc_id
            ),
            o AS (
                SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS place FROM f
                WHERE score > 0
            )
            SELECT item_id, place::INTEGER AS rank, doc_id, score FROM o WHERE place <= 20
        """,
        "op13_embedding_dedup": """
            WITH RECURSIVE v AS (
                SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
            ),
            u AS (
                SELECT r, e FROM v
                WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0
            ),
            l AS (
                SELECT a.r AS x, b.r AS y FROM u a JOIN u b ON a.r <> b.r AND len(a.e) = len(b.e)
                WHERE list_cosine_similarity(a.e, b.e) >= 0.95
            ),
            reach AS (SELECT r, r AS at FROM v UNION SELECT reach.r, l.y FROM reach JOIN l ON reach.at = l.x),
            c AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.at GROUP BY reach.r),
            n AS (SELECT x AS r, count(*) AS n FROM l GROUP BY x)
            SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
                vec_id IS NOT DISTINCT FROM component_id AS kept
            FROM v JOIN c USING (r) LEFT JOIN n USING (r)
        """,
    }

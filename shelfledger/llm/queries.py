"""The operators' queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.llm import (
    chat, damage, decontamination, exact_dedup, langid, line_dedup, mixing, near_dedup, periodic_runs, quality, site_style, token_files,
    turn_repair, vector_dedup,
)
from shelfledger.llm.common import ship_code
from shelfledger.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col, by: int):
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(id_col.cast("string")) % by


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_quality_classifier(spark, sf_dir):
    found = quality.scored(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn_from=lambda i: remainder(i, 4) != 2
    )
    return found.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op2_line_dedup(spark, sf_dir):
    found = line_dedup.without_boilerplate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "lines_removed", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


@query
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


@query
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(remainder(F.col("doc_id"), 5) != 0))
    return langid.predict(docs, model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score"
    )


@query
def op5_benchmark_decontamination(spark, sf_dir):
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.lit(True))


@query
def op6_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.formatted(rows.union(own)))


@query
def op7_source_mixing(spark, sf_dir):
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


@query
def op8_html_extraction(spark, sf_dir):
    return site_style.extracted(table(spark, sf_dir, "pages"))


@query
def op9_token_output(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer())
    return token_files.read(spark, path)


@query
def op10_minhash_near_dedup(spark, sf_dir):
    return near_dedup.classes(table(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return turn_repair.digests(rows, damage.damaged_turns(rows))


@query
def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.digests(damage.repeated_tails(table(spark, sf_dir, "documents")))


@query
def op13_vector_dedup(spark, sf_dir):
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


#: SQL of those queries that DuckDB can run over whole tables.
SQL: dict[str, str] = {
    "op2_line_dedup": """
        WITH lines AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM documents WHERE text IS NOT NULL),
        common AS (SELECT trim(line, ' ') AS line FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT coalesce('s' || source, 'none')) >= 8),
        marked AS (SELECT l.doc_id, l.text, l.place, l.line, c.line IS NOT NULL AS gone FROM lines l LEFT JOIN common c ON trim(l.line, ' ') = c.line),
        kept AS (SELECT doc_id, count(*) FILTER (gone) AS lines_removed, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text FROM marked GROUP BY doc_id)
        SELECT doc_id, coalesce(lines_removed, 0) AS lines_removed, length(k.text) AS n_chars, md5(k.text) AS text_md5 FROM documents LEFT JOIN kept k USING (doc_id)""",
    "op3_exact_dedup": """
        WITH keyed AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
        grouped AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM keyed GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM keyed JOIN grouped USING (text_sha256)""",
    "op6_chat_formatting": r"""
        WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        written AS (SELECT *, lag(role) OVER o AS last, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped,
            replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS name FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length(escaped) + CASE WHEN last IS NOT DISTINCT FROM role THEN 7 ELSE 22 + length(name) END) AS BIGINT) AS formatted_chars
        FROM written GROUP BY conv_id""",
    "op13_vector_dedup": """
        WITH RECURSIVE sound AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings WHERE label IS NOT NULL),
        links AS (SELECT a.vec_id AS u, b.vec_id AS w FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.98),
        reach AS (SELECT vec_id AS u, vec_id AS w FROM embeddings UNION SELECT r.u, l.w FROM reach r JOIN links l ON r.w = l.u),
        least AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
        counted AS (SELECT u, count(*) AS n FROM links GROUP BY u)
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN least ON vec_id = least.u LEFT JOIN counted ON vec_id = counted.u""",
}

"""One query per operator, over the whole of its table, and the SQL twins."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.llm import (
    alignment,
    ftrl,
    lines,
    ngram_join,
    packing,
    pieces,
    quality_rules,
    quotes,
    resampling,
    secrets,
    suffixes,
    twins,
    url_rules,
    vectors,
)
from crivo.llm.common import table

RULES = (
    url_rules.Rule("allow", "org", "/"),
    url_rules.Rule("block", "example.org", "/es/"),
    url_rules.Rule("block", "example.org", "/en/1"),
    url_rules.Rule("allow", "com", "/fr/"),
    url_rules.Rule("block", "com", "/de/"),
)
PIECE_MODEL, BYTE_BPE = "piece_bpe_32k.model", "byte_bpe_50k.json"


def vocabulary(name: str) -> bytes:
    """A public tokenizer's file, read where the job starts."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return ngram_join.ngram_jaccard_components(
        docs, "doc_id", "text", ngram_join.JoinParams(words=4, percent=85)
    )


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judged_pages(table(spark, folder, "pages"), RULES)


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and whether they lead back to it."""
    model = vocabulary(PIECE_MODEL)
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = pieces.encode_pieces(docs, "text", model, ["doc_id", "text"])
    back = pieces.decode_pieces(coded, "ids", model, ["doc_id", "text", "ids"], "decoded")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        # The mark for a blank cannot be told from a blank.
        (F.col("decoded") == F.translate("text", pieces.BLANK, " ")).alias("round_trip"),
    )


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged, _ = quality_rules.quality_rules(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
    )


def op5_chat_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.linked_messages(table(spark, folder, "conversations"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_groups(table(spark, folder, "documents"), "doc_id", "text")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, "doc_id", "text", vocabulary(BYTE_BPE), with_ids=False)


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.vector_components(table(spark, folder, "embeddings"))


def held_out(doc_id: str = "doc_id"):
    """Rows that no model may learn a label from."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False)
    )


def quality_scores(
    spark: SparkSession, docs: DataFrame, folder: str, keep: list[str], fitted_on: DataFrame, text: str = "text"
) -> DataFrame:
    marks = table(spark, folder, "labels").where(~held_out()).select("doc_id", "quality")
    model = ftrl.fit_quality(fitted_on, marks, "doc_id", "text")
    return ftrl.score_quality(docs, text, model, keep)


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_scores(spark, docs, folder, ["doc_id"], docs).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secrets.secret_scan(docs, "text", ["doc_id"]).drop("clean_text")


def op11_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents"), "doc_id", "text")


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    found = resampling.importance_resample(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), "doc_id", "text", "text"
    )
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return alignment.aligned_tokens(docs, "doc_id", "text", vocabulary(BYTE_BPE), vocabulary(PIECE_MODEL))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_ngram_jaccard_join,
        op2_url_filters,
        op3_sentencepiece,
        op4_quality_rules,
        op5_chat_quotes,
        op6_line_dedup,
        op7_packing,
        op8_embedding_near_dedup,
        op9_quality_classifier,
        op10_secret_scans,
        op11_suffix_dedup,
        op12_importance_resampling,
        op13_tokenizer_alignment,
    ]
    return {f.__name__: f for f in found}


_URL = """
SELECT page_id,
       CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
       CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
FROM pages
"""

#: Pages without links are judged by rules alone; the twin has no aliases.
OP2 = f"""
WITH p AS ({_URL}), r(verdict, host, path) AS (VALUES ('allow', 'org', '/'),
  ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'),
  ('block', 'com', '/de/')),
fits AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.page_id, p.host, p.path)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict,
       CAST(NULL AS VARCHAR) AS alias_of
FROM p JOIN fits f USING (page_id, host, path)
"""


def oracle_sql() -> dict[str, str]:
    """Twins of the queries that SQL can express on whole tables. The others
    are tested against brute force, round trips or held-out labels."""
    return {
        "op2_url_filters": OP2,
        "op11_suffix_dedup": twins.SUFFIX_DEDUP,
        "op12_importance_resampling": twins.RESAMPLING,
    }

"""One query per operator, over its whole table with production parameters, and SQL where SQL can express it."""

from __future__ import annotations

import importlib
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat_format,
    decontaminate,
    lexical_search,
    line_dedup,
    lm_score,
    near_dup,
    quality,
    sharding,
    token_counts,
    toxicity,
    vector_codes,
    warc,
)
from .common import new_folder, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. A session on one machine that names no shared folder, as tests may have, gets a temporary one first."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="patronage-llm-"))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archives(warc.mark_revisits(table(spark, sf_dir, "pages")), path)
    records = warc.read_archives(spark, path, payloads=False).filter("kind = 'record'")
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


OP2_SQL = """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), grouped AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM sized
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
FROM grouped
"""

#: What both turns of conversation -1 say.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = dict(rows.dtypes)
    extra = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    messages = rows.unionByName(extra).select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts"))
    return chat_format.digests(chat_format.format_conversations(messages))


OP3_SQL = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
    UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
), measured AS (
    SELECT *, length(role) + length(text) + length('[INST]' || '[/INST]' || '</s>')
        + len(regexp_extract_all(role, '<\\*(?:s>|/s>|image>|audio>|document>)|\[\\*(?:INST\]|/INST\])'))
        + len(regexp_extract_all(text, '<\\*(?:s>|/s>|image>|audio>|document>)|\[\\*(?:INST\]|/INST\])')) AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) + length('<s>') AS BIGINT) AS formatted_chars
FROM measured GROUP BY conv_id
"""


def vocabulary_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    return importlib.import_module("public_tokenizers").path(name)


BYTE_BPE = "byte_bpe_50k.json"


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = bpe.count_tokens(table(spark, sf_dir, "documents"), vocabulary_file(BYTE_BPE))
    return token_counts.suffix_sums(stored(token_counts.length_histogram(lengths), "lengths"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what the labels call good."""
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return lm_score.score_documents(table(spark, sf_dir, "documents"), good)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, machine).withColumn("held_out", toxicity.fold(F.col("doc_id")) == 0)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_file(BYTE_BPE), decode_too=True)
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT keyed.*, repeated.key IS NOT NULL AND doc_id < holder AS dropped FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH upper AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small
), found AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), big, small), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents, upper
), wanted AS (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), big, small), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark, upper
), total AS (SELECT count(DISTINCT doc_id) AS docs, count(*) AS terms FROM found
), sized AS (SELECT doc_id, 25 + (75 * count(*) * (SELECT docs FROM total)) // (SELECT terms FROM total) AS m FROM found GROUP BY doc_id
), held AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term
), weighed AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT docs FROM total) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held GROUP BY term
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM wanted JOIN held USING (term) JOIN weighed USING (term) JOIN sized USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def _op13_sql(rounds: int = 6) -> str:
    """Every round in its own tables: the distances of all parts to all entries, the nearest entry, the new entries."""

    def nearest(turn: int) -> str:
        return f"""
        distance{turn} AS MATERIALIZED (
            SELECT vec_id, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
            FROM numbers JOIN book{turn} USING (part, place) GROUP BY vec_id, part, entry
        ), nearest{turn} AS MATERIALIZED (
            SELECT vec_id, part, min(d) AS d, arg_min(entry, d * 16 + entry) AS entry FROM distance{turn} GROUP BY vec_id, part
        )"""

    def book(turn: int) -> str:
        return f"""
        sums{turn} AS MATERIALIZED (
            SELECT part, entry, place, sum(x) AS total, count(*) AS held
            FROM numbers JOIN nearest{turn} USING (vec_id, part) GROUP BY part, entry, place
        ), book{turn + 1} AS MATERIALIZED (
            SELECT part, entry, place, CASE WHEN held IS NULL THEN c ELSE CAST((total - ((total % held) + held) % held) // held AS BIGINT) END AS c
            FROM book{turn} LEFT JOIN sums{turn} USING (part, entry, place)
        )"""

    steps = ", ".join(f"{nearest(turn)}, {book(turn)}" for turn in range(rounds))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, embedding, label, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), cells AS (
        SELECT vec_id, n, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos, len(embedding) // 8 AS size FROM kept
    ), numbers AS MATERIALIZED (
        SELECT vec_id, n, pos // size AS part, pos % size AS place, CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM cells
    ), book0 AS MATERIALIZED (SELECT part, n AS entry, place, x AS c FROM numbers WHERE n < 16
    ), {steps}, {nearest(rounds)}, coded AS (
        SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM nearest{rounds} GROUP BY vec_id
    ), books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), books
    """


OP13_SQL = _op13_sql()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_warc": op2_warc,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_token_counts": op4_token_counts,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_decontamination": op8_decontamination,
    "op9_sharding": op9_sharding,
    "op10_quality_rules": op10_quality_rules,
    "op11_line_dedup": op11_line_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op3_chat_formatting": OP3_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}

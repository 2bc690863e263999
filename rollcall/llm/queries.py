"""One query per operator over its whole table, with check SQL where SQL can say it."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import alignment, chat, divergence, exact, langid, licenses, mixing, mixsql, packing, pieces, prepare, rules, sharding, simhash, tokencounts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return build(spark, folder.rstrip("/"))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register


def vocabulary(name: str) -> str:
    """A public vocabulary's file, or one of that name in ROLLCALL_VOCABULARIES if set."""
    folder = os.environ.get("ROLLCALL_VOCABULARIES")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_license_scan")
def op1(spark, folder):
    return licenses.license_matches(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op2_simhash_anchors")
def op2(spark, folder):
    rows = simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, bits=4)
    return rows.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query(
    "op3_exact_dedup",
    """
    WITH squeezed AS (
      SELECT doc_id, length(coalesce(text, '')) AS points,
             sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
      FROM documents
    ), grouped AS (
      SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
      FROM squeezed
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
    """,
)
def op3(spark, folder):
    rows = exact.exact_duplicates(table(spark, folder, "documents"), digest_all=True)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    rows = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))
    return rows.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset"
    )


@query("op4_min_slack_packing")
def op4(spark, folder):
    return packed_pieces(table(spark, folder, "documents"))


@query("op5_lpt_shards")
def op5(spark, folder):
    rows = sharding.shard_groups(table(spark, folder, "documents"), shards=16)
    return rows.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op6_rule_ledger",
    """
    WITH cut AS (
      SELECT doc_id, coalesce(text, '') AS t,
             [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws,
             [x FOR x IN string_split(coalesce(text, ''), chr(10))
                IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS ls
      FROM documents
    ), windows AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM cut WHERE len(ws) > 2)
    ), covered AS (
      SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
      FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id
    ), measured AS (
      SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             length(t) - length(regexp_replace(t, '\\p{Lu}', '', 'g')) AS n_capitals,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM cut LEFT JOIN covered USING (doc_id)
    ), judged AS (
      SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
             + 4 * (5 * n_symbols > word_chars)::BIGINT + 8 * (2 * n_dup_lines > n_lines)::BIGINT
             + 16 * (2 * n_capitals > word_chars)::BIGINT + 32 * (word_chars < 2 * n_words)::BIGINT
             + 64 * (word_chars > 15 * n_words)::BIGINT AS failures
      FROM measured
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals,
           failures & 3 > 0 AS base_failed, failures = 0 AS kept, failures,
           count(*) OVER (PARTITION BY failures) AS pattern_rows,
           CASE WHEN bit_count(failures) = 1 THEN count(*) OVER (PARTITION BY failures) ELSE 0 END AS kept_without
    FROM judged
    """,
)
def op6(spark, folder):
    rows, _ = rules.written(table(spark, folder, "documents"), "2")  # per rule, they are a table as well
    patterns = F.broadcast(rules.by_pattern(rows, "2"))  # at most a row per subset of the rules
    return rows.join(patterns, "failures").select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        "n_capitals", rules.rejected("base").alias("base_failed"), (~rules.rejected("2")).alias("kept"), "failures",
        "pattern_rows", "kept_without",
    )


@query("op7_prefix_token_counts")
def op7(spark, folder):
    rows = tokencounts.token_index(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    points = F.size("counts")
    rows = rows.select(
        F.col("id").alias("doc_id"), "n_bytes",
        tokencounts.tokens_of_prefix(F.col("counts"), points).cast("long").alias("n_tokens"),
        tokencounts.longest_prefix(F.col("counts"), F.lit(512)).alias("points_within_limit"), "counts",
    )
    over = F.col("points_within_limit") < points
    return rows.select("doc_id", "n_bytes", "n_tokens", over.alias("over_limit"), "points_within_limit", "counts")


@query("op8_sentencepiece")
def op8(spark, folder):
    rows = pieces.round_trip(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_pieces", F.col("ids_crc").alias("ids_crc32"),
        F.col("text_crc").alias("decoded_crc32"), F.col("same").alias("round_trip"),
    )


@query("op9_kneser_ney_language")
def op9(spark, folder):
    rows = langid.identify(table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score", "entropy", "rejected")


def _digests(batches):
    """What is read back from formatted conversations."""
    for batch in batches:
        out = []
        for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            turns = chat.read_back(formatted)
            told = "".join(f"{role}\n{text}\n" for role, text, _, _ in turns)
            loss = "".join(chat.unescape(formatted[s["start"] : s["end"]]) for s in spans)
            out.append((len(turns), _sha256(told), len(loss), _sha256(loss), len(formatted)))
        columns = [pa.array(list(c)) for c in zip(*out)] if out else []
        if out:
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], _CHAT_COLUMNS)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_CHAT_COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_ESCAPED = (
    "regexp_replace(replace({0}, '\\', '\\\\'), "
    "'(<)(\\||/?s>|<SYS>>|</SYS>>)|(\\[)(/?INST\\])', '\\1\\3\\\\\\2\\4', 'g')"
)


@query(
    "op10_reply_trees",
    f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ), told AS (
      SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
             coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
             sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 17) AS formatted_chars
      FROM turns GROUP BY conv_id
    )
    SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           CAST(formatted_chars AS BIGINT) AS formatted_chars
    FROM told
    """,
)
def op10(spark, folder):
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    ok = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", ok), (-1, 1, "assistant", ok)], given.schema)
    formatted = chat.format_trees(chat.thread_tree(given.unionByName(probe)))
    return formatted.select("conv", "formatted", "loss").mapInArrow(
        _digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


@query("op11_pareto_mix", mixsql.mix_sql((5, 2, 1), 3, mixing.CLASSES, "mix"))
def op11(spark, folder):
    rows = mixing.mix(table(spark, folder, "documents"), weights=(5, 2, 1), share=1.0, limit=3)
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


@query("op12_tokenizer_alignment")
def op12(spark, folder):
    rows = alignment.align(
        table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )
    return rows.withColumnRenamed("id", "doc_id")


@query(
    "op13_source_divergence",
    """
    WITH words AS (
      SELECT doc, lang, source, unnest(terms) AS term FROM (
        SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents)
    ), kept AS (
      SELECT lang, term, count(*) OVER (PARTITION BY lang) AS v
      FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
    ), sources AS (
      SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
    ), counted AS (
      SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
    ), dense AS (
      SELECT s.lang, s.source, k.term, k.v, coalesce(c.n, 0)::HUGEINT AS n,
             (sum(coalesce(c.n, 0)) OVER (PARTITION BY s.lang, s.source))::HUGEINT AS total,
             (sum(coalesce(c.n, 0)) OVER (PARTITION BY s.lang, k.term))::HUGEINT AS n_lang,
             (sum(coalesce(c.n, 0)) OVER (PARTITION BY s.lang))::HUGEINT AS total_lang
      FROM sources s JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)
    ), shares AS (
      SELECT lang, source, term, n, 1 + 1000000000 * (n + 1) // (total + v) AS p,
             1 + 1000000000 * (n_lang + 1) // (total_lang + v) AS q
      FROM dense
    ), pairs AS (
      SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), parts AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
    ), ranked AS (
      SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM parts
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
)
def op13(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))

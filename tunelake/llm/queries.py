"""The registered queries of the operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake.llm import alignment, bpe, chat, embed_dedup, licenses, packing, quality, repair, sharding, simhash, token_lm, toxicity, warc
from tunelake.llm.common import store, table

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
HOSTILE = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HOSTILE).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_conversations(chat.turn_events(turns)))


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A public vocabulary of the contracts; installed, not part of this repository."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.with_round_trip(docs, tokenizer_path(), "codec").select("doc_id", "codec.*")
    return back.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_groups(table(spark, sf_dir, "embeddings"), 0.95)


def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.archive_pages(table(spark, sf_dir, "pages"), min_bytes=0, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    fixed = [F.col(f"counts.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("doc_id", *fixed, "base_failed", "kept", "anomaly")


def op6_lm_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return token_lm.token_scores(table(spark, sf_dir, "documents"), wanted, tokenizer_path())


def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *[F.col(f"p.{c}").alias(f"p_{c}") for c in toxicity.LINKS],
                      "toxic", (~F.col("toxic")).alias("kept"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op9_spf_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), size=1024, end_id=0)


def op10_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    out = sharding.shard_by_bytes(docs, 24, keep=[F.col("doc_id"), crc.alias("text_crc32")])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenizer_path(PIECES)
    aligned = alignment.align_documents(table(spark, sf_dir, "documents"), tokenizer_path(), pieces)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = store(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.link_scores(aligned, alignment.vocabulary_size(pieces)).drop("row")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.repair_report(repair.damage(turns), ids=turns)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    fields = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return out.select("doc_id", *[F.col(f"found.{c}").alias(c) for c in fields])


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_warc_normaliser": op4_warc_normaliser,
    "op5_quality_forest": op5_quality_forest,
    "op6_lm_difference": op6_lm_difference,
    "op7_toxicity_chain": op7_toxicity_chain,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_spf_packing": op9_spf_packing,
    "op10_histogram_sharding": op10_histogram_sharding,
    "op11_token_alignment": op11_token_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_license_scan": op13_license_scan,
}

ORACLE_SQL = {
    "op1_chat_format": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) t(i)),
written AS (
    SELECT *, replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '##', '#\#') AS body FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(body) + length(role) + 14) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id""",
    "op3_embedding_dedup": """
WITH RECURSIVE sound AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
    vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN degree ON vec_id = degree.a""",
    "op4_warc_normaliser": r"""
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper,
        list_transform(string_split(upper(sha1(coalesce(html, ''))), ''), lambda c: instr('0123456789ABCDEF', c) - 1) AS nibbles
    FROM pages)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
        (((nibbles[1 + (5 * i) // 4] * 16 + coalesce(nibbles[2 + (5 * i) // 4], 0)) >> (3 - (5 * i) % 4)) & 31) AS INTEGER), 1)), '')
        AS payload_digest,
    CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM hashed""",
    "op12_conversation_repair": r"""
WITH RECURSIVE
turns AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hashed AS (
    SELECT *, xor(4294967295, list_reduce(
        list_transform(range(8 * length(name)), lambda i: (ascii(substr(name, i // 8 + 1, 1)) >> CAST(i % 8 AS INTEGER)) & 1),
        lambda crc, bit: xor(crc >> 1, 3988292384 * (xor(crc, bit) & 1)), 4294967295)) % 20 AS hit FROM turns),
copies AS (
    SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
        CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            sha256(length(role) || ':' || role || text), copy) AS pos,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, role[1] AS initial FROM copies),
faulty AS (
    SELECT *, CASE WHEN bare = '' THEN 'b'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
            WHEN bare[-1] NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (illegal) AS illegal FROM faulty GROUP BY conv_id),
-- 0: nothing yet, 1: after the system row, 2: an assistant is due, 3: complete
inserted(a, b, letters, roles) AS (VALUES (0, 0, '', []), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']),
    (1, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:']),
    (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:'])),
renamed(a, b, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
kept(a, b, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
edits AS (
    SELECT conv_id, pos, 'D' AS letter, 2 AS cost, a, a AS b, [] AS said FROM faulty, (VALUES (0), (1), (2), (3)) s(a)
    UNION ALL
    SELECT conv_id, pos, 'R', CASE fault WHEN 't' THEN 6 ELSE 1 END, a, b, [renamed.role || ':' || text]
    FROM faulty, renamed WHERE fault NOT IN ('b', 'd')
    UNION ALL
    SELECT conv_id, pos, 'K', CASE fault WHEN 't' THEN 5 ELSE 0 END, a, b, [role || ':' || text]
    FROM faulty JOIN kept USING (initial) WHERE fault NOT IN ('b', 'd')),
walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, {'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])} AS best FROM counts
    UNION ALL
    SELECT w.conv_id, w.pos + 1, e.b, min({'cost': CAST(w.best.cost + 5 * length(i.letters) + e.cost AS INTEGER),
        'audit': w.best.audit || i.letters || e.letter, 'said': w.best.said || i.roles || e.said})
    FROM walk w JOIN inserted i ON i.a = w.state
        JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.pos = w.pos + 1 AND e.a = i.b
    GROUP BY w.conv_id, w.pos, e.b),
ended AS (
    SELECT w.conv_id, min({'cost': w.best.cost + 5 * length(i.letters), 'audit': w.best.audit || i.letters, 'said': w.best.said || i.roles}) AS best
    FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.pos
        JOIN inserted i ON i.a = w.state AND i.b IN (0, 3) GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_license_scan": licenses.oracle_sql(),
}

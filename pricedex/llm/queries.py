"""The registered queries of the text operators, with production parameters over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm import (chat, decontaminate, exact_dedup, html_extract, langid, line_dedup, packing, pieces, prefix_trie,
                          simhash, toxicity, warc, whitening)
from pricedex.llm.common import read_table

TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a vocabulary file that is installed with the public tokenizers on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winner and group of every document's exact copies; ids below the middle of the range are the history."""
    return exact_dedup.exact_dedup(spark, read_table(spark, sf_dir, "documents")).drop("known")


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint (4-word shingles) and component (at most 4 differing bits) of every document."""
    found = simhash.components(spark, read_table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    found = docs.select("doc_id", langid.held_out().alias("held_out"), "text")
    return langid.predict(spark, found, model).drop("text")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from labelled rows that are not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~langid.held_out()))
    found = docs.select("doc_id", langid.held_out().alias("held_out"), "text")
    return toxicity.score(spark, found, model).drop("text").withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack(spark, read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair with a match: the smallest distance, its first span, number of matches."""
    found = decontaminate.matches(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    best = F.min(F.struct("distance", "start_char", "end_char"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best"), F.count("*").alias("n_matches")).select(
        "doc_id", "item_id", "best.*", "n_matches")


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its recurring lines cut, and how many lines went."""
    docs = read_table(spark, sf_dir, "documents")
    return line_dedup.drop_lines(spark, docs, removed_col="lines_cut").select("doc_id", "text", "lines_cut")


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, from its host's winning container path."""
    found = html_extract.extract_pages(spark, read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op5_warc_roundtrip", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
    SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
           list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
               (CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31
               AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
    FROM f""")
def op5_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back; payloads of any size that repeat are revisits."""
    found = warc.roundtrip(spark, read_table(spark, sf_dir, "pages"), min_bytes=0)
    return found.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        warc.page_of("refers_to").alias("refers_to"))


# The tool that the calls made of conversations use: its arguments and their types.
ANSWER_SCHEMA = [("answer", [("chars", "integer", True), ("question", "string", True), ("turn", "integer", True)])]


def conversations_as_tool_use(conversations: DataFrame) -> DataFrame:
    """Messages with tool calls made of conversations: a user's turn asks for a call of the tool ``answer`` that depends
    on the call two turns before; an assistant's turn is the result of the call one turn before. In every fourth conversation
    the calls lack the question that the tool requires."""
    def call_id(back: int):
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - back).cast("string"))

    arguments = F.struct(F.coalesce(F.length("text"), F.lit(0)).alias("chars"), F.when(F.coalesce(F.col("conv_id") % 4 != 1, F.lit(True)), F.col("text")).alias("question"), "turn")
    ask = F.struct(F.array(F.struct(call_id(0).alias("id"), F.lit("answer").alias("name"), arguments.alias("arguments"),
                                    F.array(call_id(2)).alias("depends_on"))).alias("tool_calls"))
    reply = F.struct(call_id(1).alias("tool_call_id"), F.col("text").alias("content"))
    role = F.col("role")
    return conversations.select(
        "conv_id", "turn", F.when(role == "user", "assistant").when(role == "assistant", "tool").otherwise(role).alias("role"),
        F.when(role == "user", F.to_json(ask)).when(role == "assistant", F.to_json(reply)).otherwise(F.col("text")).alias("text"))


@query("op9_chat_formatting", """
    WITH u AS (SELECT conv_id, turn, text, turn // 2 - row_number() OVER w AS run
               FROM conversations WHERE role = 'user' WINDOW w AS (PARTITION BY conv_id, turn % 2 ORDER BY turn)),
    c AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS INTEGER) AS level,
                 'call_' || conv_id || '_' || turn AS call_id FROM u),
    r AS (SELECT conv_id, turn, text, 'call_' || conv_id || '_' || (turn - 1) AS call_id
          FROM conversations WHERE role = 'assistant'),
    calls AS (SELECT c.*, CASE WHEN EXISTS (FROM r WHERE r.call_id = c.call_id) THEN 'answered' ELSE 'unanswered' END AS status
              FROM c),
    results AS (SELECT r.*, c.level, CASE WHEN c.call_id IS NULL THEN 'orphan' ELSE 'linked' END AS status
                FROM r LEFT JOIN c USING (call_id))
    SELECT conv_id, turn, 'call' AS kind, call_id, level, status, conv_id % 4 <> 1 AS valid,
           '{"arguments":{"chars":' || length(text) || CASE WHEN conv_id % 4 = 1 THEN '' ELSE ',"question":' || to_json(text) END
           || ',"turn":' || turn || '},"id":"'
           || call_id || '","kind":"call","name":"answer","status":"' || status || '"}' AS json FROM calls
    UNION ALL
    SELECT conv_id, turn, 'result', call_id, level, status, NULL, '{"content":' || to_json(text) || ',"id":"' || call_id
           || '","kind":"result","status":"' || status || '"}' FROM results
    UNION ALL
    SELECT conv_id, turn, 'message', NULL, NULL, 'plain', NULL, '{"kind":"message","role":"' || role || '","text":'
           || to_json(text) || '}' FROM conversations WHERE role NOT IN ('user', 'assistant')""")
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation as a tool call, its result or a plain message, in canonical JSON."""
    schemas = spark.createDataFrame(
        ANSWER_SCHEMA, "name string, fields array<struct<field:string,type:string,required:boolean>>")
    messages = conversations_as_tool_use(read_table(spark, sf_dir, "conversations"))
    found = chat.format_chat(spark, messages, schemas)
    return found.select("conv_id", "turn", "kind", "call_id", "level", "status",
                        (F.size("errors") == 0).alias("valid"), "json")


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every usable vector; fitted on the distinct quantised vectors."""
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=4)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


# SQL twin of op12: the CRC-32 of an id bit by bit (a character's code, then eight shifts), turns as (role, text) structs.
PREFIX_TRIE_SQL = r"""
    WITH raw AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
                            strlen(coalesce(role, '')) || ' ' || coalesce(role, '') || coalesce(text, ''))) - 1 AS position
                 FROM conversations WHERE conv_id IS NOT NULL),
    lists AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY position) AS turns FROM raw GROUP BY conv_id),
    crc AS (SELECT conv_id, xor(list_reduce(
                list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                    lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0]))),
                lambda a, op: CASE WHEN op > 0 THEN xor(a, op) ELSE xor(a >> 1, 3988292384 * (a & 1)) END),
                4294967295::BIGINT) % 4 AS h FROM lists),
    rebuilt AS (SELECT conv_id, list_concat(coalesce(b.turns, [])[1:h], l.turns[h + 1:]) AS turns
                FROM lists l JOIN crc USING (conv_id) LEFT JOIN (SELECT conv_id AS base, turns FROM lists) b
                  ON b.base = conv_id - conv_id % 20),
    steps AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
    nodes AS (SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
                     coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
              FROM steps GROUP BY 1, 2),
    words AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(
                  path[-1].text, '[^\x20\x09-\x0D]+')) END AS own FROM nodes),
    family AS (SELECT n.depth, n.conv_id, p.conv_id AS parent_conv_id
               FROM nodes n JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
    children AS (SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS n_children FROM family GROUP BY ALL),
    sized AS (SELECT w.*, coalesce(n_children, 0) AS n_children FROM words w LEFT JOIN children USING (depth, conv_id)),
    above AS (SELECT unnest(range(0, depth + 1)) AS depth, path, own, n_children FROM sized),
    subtrees AS (SELECT depth, path[1:depth] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved
                 FROM above GROUP BY 1, 2)
    SELECT s.conv_id, s.depth::BIGINT AS depth, f.parent_conv_id, s.n_convs, s.n_children, t.n_leaves,
           t.saved::BIGINT AS saved_tokens, sha256(s.ends) AS ends_sha256
    FROM sized s JOIN subtrees t ON t.depth = s.depth AND t.path = s.path
    LEFT JOIN family f ON f.depth = s.depth AND f.conv_id = s.conv_id"""


@query("op12_conversation_prefix_trie", PREFIX_TRIE_SQL)
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, rebuilt to share the openings of every twentieth."""
    turns = prefix_trie.positioned_turns(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.with_shared_openings(turns))


@query("op13_sentencepiece_roundtrip")
def op13_sentencepiece_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document and the text decoded from them; how many of its bytes the pieces' spans cover."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), decoded_col="decoded")
    covered = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda t, w: t + w)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), covered.alias("covered_bytes"))

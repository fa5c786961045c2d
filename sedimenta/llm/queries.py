"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm import (
    bpe,
    chat,
    conversation_trie,
    decontamination,
    exact_dedup,
    language_id,
    licenses,
    mixing,
    quality,
    simhash,
    spelling,
    token_files,
    toxicity,
)
from sedimenta.llm.common import staged
from sedimenta.sources.staging import compact, staging_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = bpe.tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    documents = bpe.fewer_partitions(_table(spark, folder, "documents").select("doc_id", "text"))
    encoded = tokenizer.encode(documents, "text", keep_text=False)
    decoded = tokenizer.decode(encoded)
    return decoded.select(
        "doc_id",
        bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    found = exact_dedup.duplicates(documents, keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    marked = staged(simhash.fingerprints(documents, shingle=3).select("doc_id", "fingerprint"))
    found = simhash.components(marked, "fingerprint", distance=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    found = licenses.scanned(documents, licenses.templates(spark))
    return found.select("doc_id", "license", "containment", "first_word")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")
    categories = ["poor", "toxic"]
    sample = staged(toxicity.sampled(labels, categories))
    chain = toxicity.trained(documents, sample, categories)
    found = toxicity.scored(documents, chain)
    return found.select("doc_id", "p_poor", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mixed(mixing.sized(_table(spark, folder, "documents")))
    return found.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        tokenizer = file.read()
    out = f"{staging_folder(spark)}/tokens-{uuid.uuid4().hex}"
    width = token_files.id_width(tokenizer)
    # in larger partitions a word is encoded fewer times
    ids = token_files.encoded(bpe.fewer_partitions(documents), tokenizer, end_id=1)
    token_files.write(ids, documents.select("doc_id"), out, width)
    found = token_files.read(spark, out)
    return found.select("doc_id", "start", "n_tokens", token_files.crc32("ids", width).alias("ids_crc32"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.trained(documents, mark=~held_out)
    found = language_id.predicted(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(quality.measured(_table(spark, folder, "documents").select("doc_id", "text")))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    marked = found.withColumn("base_failed", base_failed)
    return marked.select("doc_id", *counts, "base_failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "\\### Assistant: </turn> ok"
    rows = rows.union(
        spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    )
    # every row is a message of its own, also where a turn repeats
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    events = rows.withColumn("part", F.row_number().over(same)).withColumns(
        {"seq": F.lit(0), "kind": F.lit("message")}
    )
    messages = chat.folded(events, "conv_id", ["turn", "part"])
    found = chat.formatted(messages, "conv_id", ["turn", "part"])
    read = found.select(
        "conv_id",
        chat.parsed(F.col("formatted")).alias("turns"),
        chat.learned(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents with the words near them, their more frequent form and the root of their forms."""
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    found = spelling.variants(staged(spelling.word_counts(documents, slips=199)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the prefix trie of all conversations, each continued from the first of its twenty."""
    found = conversation_trie.conversations(_table(spark, folder, "conversations"))
    conv = F.col("conv_id")
    shared = F.crc32(conv.cast("string").cast("binary")) % 4
    return conversation_trie.trie(conversation_trie.branched(found, conv - conv % 20, shared, most=3))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its words, how many lie in windows of benchmark items, and which items those are."""
    known = decontamination.windows(_table(spark, folder, "benchmark"))
    found = decontamination.scanned(_table(spark, folder, "documents").select("doc_id", "text"), known)
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


_BUILT = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_token_files": op6_token_files,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_chat": op9_chat,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_decontamination": op13_decontamination,
}


def _query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with a result in a few files per core."""

    @wraps(build)
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return compact(build(spark, folder))

    return query


QUERIES = {name: _query(build) for name, build in _BUILT.items()}
_STOP_WORDS = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
ORACLE_SQL = {
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_quality": rf"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM documents
        ), windows AS (
            SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut)
        ), again AS (
            SELECT doc_id, a, b, c FROM windows GROUP BY ALL HAVING count(*) > 1
        ), covered AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows JOIN again USING (doc_id, a, b, c))
            GROUP BY doc_id
        ), counted AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                   CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                   coalesce(covered.n, 0) AS n_repeat_words,
                   len(list_filter(w, lambda x: lower(x) IN ({_STOP_WORDS}))) AS n_stop_words,
                   greatest(len(l), 1) AS lines, greatest(len(w), 1) AS words,
                   len(list_filter(l, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•'))) AS n_bullet_lines,
                   len(list_filter(l, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_ellipsis_lines
            FROM cut LEFT JOIN covered USING (doc_id)
        ), based AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND n_words BETWEEN 50 AND 1000000 AND word_chars / words BETWEEN 2 AND 15
               AND n_symbols / words <= 0.1 AND n_stop_words >= 2 AND n_dup_lines / lines <= 0.3
               AND n_bullet_lines / lines <= 0.9 AND n_ellipsis_lines / lines <= 0.3
               AND n_repeat_words / words <= 0.5 AS kept
        FROM based
    """,
    "op9_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, n, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v (n, r)
        ), sized AS (
            SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
                      + length(text) - length(replace(text, '<', '')) AS text_chars,
                   length(role) + length(regexp_extract_all(role, '[\\<>\n]')) AS role_chars
            FROM turns
        ), joined AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS everything,
                   coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(6 + role_chars + 2 + text_chars + 8) AS chars
            FROM sized GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(everything) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
               sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
        FROM joined
    """,
    # CRC-32 bit by bit; a path is the digests of its turns on end
    "op12_conversation_trie": r"""
        WITH said AS (
            SELECT conv_id, turn, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
                   sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS d
            FROM conversations WHERE conv_id IS NOT NULL
        ), turns AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos FROM said
        ), convs AS (
            SELECT conv_id AS c, xor(list_reduce(
                list_concat([4294967295::UBIGINT], list_transform(range(length(CAST(conv_id AS VARCHAR))),
                                                                  lambda i: ord(CAST(conv_id AS VARCHAR)[i + 1])::UBIGINT)),
                lambda a, b: list_reduce(list_concat([xor(a, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                    lambda s, z: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))),
                4294967295::UBIGINT) % 4 AS h
            FROM (SELECT DISTINCT conv_id FROM turns)
        ), rebuilt AS (
            SELECT c, pos, d, w FROM convs JOIN turns ON conv_id = c - c % 20 AND pos <= h
            UNION ALL SELECT c, pos, d, w FROM convs JOIN turns ON conv_id = c AND pos > h
        ), paths AS (
            SELECT c, row_number() OVER so_far AS depth, string_agg(d, '') OVER so_far AS path, w FROM rebuilt
            WINDOW so_far AS (PARTITION BY c ORDER BY pos)
            UNION ALL SELECT c, 0, '', 0 FROM convs
        ), nodes AS (
            SELECT path, depth, any_value(w) AS w, min(c) AS conv, count(*) AS n FROM paths GROUP BY path, depth
        ), lasts AS (
            SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (
                SELECT c, max_by(path, depth) AS path FROM paths GROUP BY c
            ) GROUP BY path
        ), hung AS (
            SELECT a.path, a.depth, a.w, a.conv, a.n, b.conv AS up,
                   (SELECT count(*) FROM nodes k WHERE k.depth = a.depth + 1 AND starts_with(k.path, a.path)) AS kids
            FROM nodes a LEFT JOIN nodes b ON b.depth = a.depth - 1 AND b.path = a.path[1 : 64 * (a.depth - 1)]
        )
        SELECT a.conv AS conv_id, CAST(a.depth AS BIGINT) AS depth, a.up AS parent_conv_id, a.n AS n_convs,
               a.kids AS n_children, CAST(count(*) FILTER (b.kids = 0) AS BIGINT) AS n_leaves,
               CAST(sum((b.n - 1) * b.w) AS BIGINT) AS saved_tokens, sha256(coalesce(any_value(ids), '')) AS ends_sha256
        FROM hung a JOIN hung b ON starts_with(b.path, a.path) LEFT JOIN lasts ON lasts.path = a.path
        GROUP BY a.path, a.conv, a.depth, a.up, a.n, a.kids
    """,
    "op13_decontamination": r"""
        WITH items AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n,
                   array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
        ), texts AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), places AS (
            SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, (SELECT DISTINCT n FROM windows)
        ), hits AS (
            SELECT r, i, p.n, item FROM places p JOIN windows v ON v.n = p.n AND v.win = array_to_string(w[i : i + p.n - 1], ' ')
        ), words AS (
            SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r
        ), named AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM texts LEFT JOIN words USING (r) LEFT JOIN named USING (r)
    """,
}

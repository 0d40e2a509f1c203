"""The operators' registered queries: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwater.llm import (
    chat, ctw, decontamination, lexical, licenses, mixing, prefixtrie, quality, repeats,
    sentencepieces, simhash, toxicity, vptree)
from tillwater.llm.common import documents


def op1_context_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every document under a model of the training fold."""
    return ctw.score_held_out(documents(spark, sf_dir))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap."""
    return decontamination.contaminated(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weakly supervised toxicity score of every document."""
    return toxicity.classify(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    ).select("doc_id", "held_out", "score", "predicted")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without long byte strings that occur earlier."""
    return repeats.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken for the target weights."""
    return mixing.mix(documents(spark, sf_dir), mixing.domain_of(F.col("source"))).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "n_copies")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality score of every document."""
    return quality.classify(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every twentieth vector."""
    return vptree.nearest(
        spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, base phrases, labels and usage score of every document."""
    return licenses.scan_licenses(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
        "score", F.array_join("expressions", "; ").alias("expressions"))


# A conversation whose texts hold control strings of chat templates.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    return chat.chat_digest(chat.format_chat(turns.unionByName(planted)))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    convs = prefixtrie.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    conv = F.col("conv_id")
    head = (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")
    return prefixtrie.prefix_trie(prefixtrie.rebuilt(convs, conv - conv % 5, head, 8))


def op12_sentencepiece(
    spark: SparkSession, sf_dir: str, model: str | None = None,
) -> DataFrame:
    """Every document's piece ids and what they decode to, as digests."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.encode(documents(spark, sf_dir), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical.search(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {
    "op1_context_tree_scoring": op1_context_tree_scoring,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_license_scan": op9_license_scan,
    "op10_chat_format": op10_chat_format,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_lexical_search": op13_lexical_search,
}
SQL: dict[str, str] = {
    "op2_benchmark_decontamination": """
        WITH d AS (
            SELECT doc_id, regexp_split_to_array(lower(coalesce(text, '')),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents WHERE doc_id IS NOT NULL
        ), b AS (
            SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
            FROM benchmark WHERE item_id IS NOT NULL
        ), masks(m, o, last) AS (VALUES
            (0, [0, 1, 2, 3, 4, 5], 5), (1, [0, 1, 3, 4, 6, 7], 7), (2, [0, 2, 3, 6, 7, 9], 9)
        ), ds AS (
            SELECT doc_id, m, place, list_transform(o, lambda x: w[place + x]) AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS place FROM d), masks
            WHERE place + last <= len(w)
        ), bs AS (
            SELECT item_id, m, place, list_transform(o, lambda x: w[place + x]) AS s
            FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS place FROM b), masks
            WHERE place + last <= len(w)
        ), hits AS (
            SELECT DISTINCT doc_id, item_id, ds.place - bs.place AS diagonal
            FROM ds JOIN bs USING (m, s)
        ), places AS (
            SELECT doc_id, item_id, diagonal, len(b.w) AS n, place,
                CASE WHEN d.w[place] = b.w[place - diagonal] THEN 1 ELSE -2 END AS v
            FROM (SELECT *, unnest(range(greatest(1, diagonal + 1),
                    least(len(d.w), diagonal + len(b.w)) + 1)) AS place
                FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)) x
                JOIN d USING (doc_id) JOIN b USING (item_id)
        ), sums AS (
            SELECT *, sum(v) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY place) AS s
            FROM places
        ), stretches AS (
            SELECT doc_id, item_id, n, s - least(0, coalesce(min(s) OVER (
                PARTITION BY doc_id, item_id, diagonal ORDER BY place
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS score
            FROM sums
        )
        SELECT doc_id, item_id, max(score)::INTEGER AS score, n::INTEGER AS n_item_words
        FROM stretches GROUP BY doc_id, item_id, n
        HAVING max(score) >= greatest(8, least(12, ceil(n * 0.6)))
    """,
    "op5_source_mixing": """
        WITH docs AS (
            SELECT doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''),
                    '[^ \\x09-\\x0D]+'))::BIGINT AS n_tokens,
                CASE coalesce(try_cast(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '')
                        AS BIGINT), 0) % 3
                    WHEN 1 THEN 'books' WHEN 2 THEN 'forums' ELSE 'web' END AS domain,
                coalesce(lang, '') AS language, coalesce(source, '') AS origin
            FROM documents
        ), leaves AS (
            SELECT domain, language, origin, sum(n_tokens)::BIGINT AS tokens
            FROM docs GROUP BY ALL
        ), d1 AS (
            SELECT domain, sum(tokens * 2.0::DOUBLE) AS cap,
                CASE domain WHEN 'web' THEN 0.5::DOUBLE WHEN 'books' THEN 0.3 ELSE 0.2 END AS w,
                (SELECT sum(tokens) FROM leaves) * 0.5::DOUBLE AS budget
            FROM leaves GROUP BY domain
        ), d2 AS (
            SELECT *, cap * sum(w) OVER (ORDER BY cap / w, domain
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                <= w * (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, domain
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
            FROM d1
        ), d3 AS (
            SELECT domain, CASE WHEN filled THEN cap ELSE greatest(0,
                (budget - coalesce(sum(cap) FILTER (filled) OVER (), 0)) * w
                / sum(w) FILTER (NOT filled) OVER ()) END AS budget FROM d2
        ), l1 AS (
            SELECT domain, language, sum(tokens * 2.0::DOUBLE) AS cap,
                CASE language WHEN 'en' THEN 0.55::DOUBLE WHEN 'de' THEN 0.2 WHEN 'fr' THEN 0.15
                    WHEN 'es' THEN 0.1 ELSE 0.05 END AS w, any_value(d3.budget) AS budget
            FROM leaves JOIN d3 USING (domain) GROUP BY domain, language
        ), l2 AS (
            SELECT *, cap * sum(w) OVER (PARTITION BY domain ORDER BY cap / w, language
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                <= w * (budget - coalesce(sum(cap) OVER (PARTITION BY domain
                    ORDER BY cap / w, language
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
            FROM l1
        ), l3 AS (
            SELECT domain, language, CASE WHEN filled THEN cap ELSE greatest(0,
                (budget - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY domain), 0)) * w
                / sum(w) FILTER (NOT filled) OVER (PARTITION BY domain)) END AS budget
            FROM l2
        ), s1 AS (
            SELECT domain, language, origin, tokens, tokens * 2.0::DOUBLE AS cap,
                1.0::DOUBLE AS w, budget
            FROM leaves JOIN l3 USING (domain, language)
        ), s2 AS (
            SELECT *, cap * sum(w) OVER (PARTITION BY domain, language ORDER BY cap / w, origin
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                <= w * (budget - coalesce(sum(cap) OVER (PARTITION BY domain, language
                    ORDER BY cap / w, origin
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
            FROM s1
        ), s3 AS (
            SELECT domain, language, origin, tokens, floor(round(CASE WHEN filled THEN cap
                ELSE greatest(0, (budget - coalesce(sum(cap) FILTER (filled)
                    OVER (PARTITION BY domain, language), 0)) * w / sum(w) FILTER (NOT filled)
                    OVER (PARTITION BY domain, language)) END, 3))::BIGINT AS budget
            FROM s2
        ), s4 AS (
            SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs FROM s3
        ), ranked AS (
            SELECT docs.*, epochs, budget - epochs * tokens AS rest,
                sum(n_tokens) OVER (PARTITION BY domain, language, origin
                    ORDER BY md5('tillwater|' || epochs || '|'
                        || coalesce(doc_id::VARCHAR, ''))) AS so_far
            FROM docs JOIN s4 USING (domain, language, origin)
        )
        SELECT doc_id, domain, lang, source, n_tokens, (epochs
            + CASE WHEN so_far <= rest AND n_tokens > 0 THEN 1 ELSE 0 END)::BIGINT AS n_copies
        FROM ranked
    """,
    "op10_chat_format": """
        WITH given AS (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'),
                    '[', '&#91;') AS safe
            FROM given
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), ''
                ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(8 + length(role) + 1 + length(safe) + 8)::BIGINT AS formatted_chars,
            0::BIGINT AS n_attachments,
            sum(len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')))::BIGINT AS n_tokens
        FROM turns GROUP BY conv_id
    """,
    "op11_prefix_trie": """
        WITH given AS (
            SELECT conv_id, coalesce(text, '') AS text, turn, sha256(
                octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '')
                || coalesce(text, '')) AS digest
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place,
                digest, octet_length(encode(text)) AS size
            FROM given
        ), heads AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
                list_prepend(4294967295, flatten(list_transform(
                    string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]
                    ::BIGINT[]))),
                lambda s, x: xor(xor(s, x) >> 1,
                    CASE WHEN xor(s, x) & 1 = 1 THEN 3988292384 ELSE 0 END)),
                4294967295) % 9 AS head
            FROM (SELECT DISTINCT conv_id FROM own)
        ), convs AS (
            SELECT h.conv_id, coalesce(list(t ORDER BY part, place) FILTER (t IS NOT NULL), []) AS t
            FROM heads h LEFT JOIN (
                SELECT heads.conv_id, 0 AS part, place, {'d': digest, 's': size} AS t
                FROM heads JOIN own ON own.conv_id = base AND place <= head
                UNION ALL SELECT conv_id, 1, place, {'d': digest, 's': size}
                FROM heads JOIN own USING (conv_id) WHERE place > head) x USING (conv_id)
            GROUP BY h.conv_id
        ), prefixes AS (
            SELECT conv_id, len(t) AS n, unnest(range(0, len(t) + 1)) AS depth, t FROM convs
        ), named AS (
            SELECT conv_id, n, depth, md5(list_transform(t[:depth], lambda x: x.d)::VARCHAR) AS node,
                md5(list_transform(t[:depth - 1], lambda x: x.d)::VARCHAR) AS above,
                coalesce(t[depth].s, 0) AS size, t
            FROM prefixes
        ), nodes AS (
            SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id,
                count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                    FILTER (n = depth), '')) AS ends_sha256, any_value(t) AS t
            FROM named GROUP BY node, depth
        ), children AS (
            SELECT above AS node, depth - 1 AS depth, count(*) AS n_children
            FROM nodes WHERE depth > 0 GROUP BY ALL
        ), subtrees AS (
            SELECT a.up AS depth, md5(list_transform(a.t[:a.up], lambda x: x.d)::VARCHAR) AS node,
                count(*) FILTER (n_children IS NULL) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) a
                LEFT JOIN children c ON c.node = a.node AND c.depth = a.depth
            GROUP BY ALL
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
            coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
            n.ends_sha256
        FROM nodes n JOIN subtrees s ON s.node = n.node AND s.depth = n.depth
            LEFT JOIN children c ON c.node = n.node AND c.depth = n.depth
            LEFT JOIN nodes p ON p.node = n.above AND p.depth = n.depth - 1
    """,
    "op13_lexical_search": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term
                FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL
        ), whole AS (
            SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0
        ), tf AS (
            SELECT r, any_value(doc_id) AS doc_id, any_value(n)::BIGINT AS n, term, count(*)::BIGINT AS tf
            FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
            WHERE term IN (SELECT term FROM b) GROUP BY r, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM tf, whole GROUP BY term, n_docs
        ), scores AS (
            SELECT item_id, r, any_value(doc_id) AS doc_id, sum(times * weight * ((1000000000 * tf)
                // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // length))))::BIGINT AS score
            FROM tf JOIN weights USING (term) JOIN b USING (term), whole GROUP BY item_id, r
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item_id
            ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= 20
    """,
}

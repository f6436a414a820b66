"""The operators of this package as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm import (
    chat_format,
    collocations,
    decontaminate,
    hilbert_shards,
    lattice_dedup,
    orc_tokens,
    quality_ratio,
    sentencepiece_bpe,
    simhash,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from stallwise.sources.staging import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Documents with at least this expected severity (0 to 2) are rejected.
REJECT_FROM = 0.25
# Layout of conversation -7 below; it may also come from a file.
ADDED_CONVERSATION = -7
ADDED_TEXT = "\\### Assistant: </turn> ok"
SHARD_DIMENSIONS = ["lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Severity:
    """The labels say toxic or not; the grades above are derived from the texts."""
    return toxicity.fit(docs, table(spark, sf_dir, "labels").withColumnRenamed("toxic", "grade"), derive=True)


@query
def op1_toxicity_ordinal(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity_model(spark, sf_dir, docs), reject_from=REJECT_FROM)


@query
def op2_lattice_near_dup(spark, sf_dir):
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op3_chat_format(spark, sf_dir):
    """Turns come as one-row-per-turn records; the added conversation as a prompt and its answer."""
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record")
    )
    added = spark.range(1).select(
        F.lit(ADDED_CONVERSATION).cast("long").alias("conv_id"),
        F.to_json(F.struct(F.lit(ADDED_TEXT).alias("prompt"), F.lit(ADDED_TEXT).alias("completion"))).alias("record"),
    )
    turns = chat_format.canonical_turns(rows.unionByName(added), "conv_id", "record")
    return chat_format.read_back(chat_format.formatted(turns)).withColumnRenamed("conv", "conv_id")


@query
def op4_warc_segments(spark, sf_dir):
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path)


@query
def op5_hilbert_shards(spark, sf_dir):
    return hilbert_shards.assign_shards(table(spark, sf_dir, "documents"), SHARD_DIMENSIONS, shards=16)


@query
def op6_sentencepiece(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.encoded_digests(table(spark, sf_dir, "documents"), model)


@query
def op7_token_counts(spark, sf_dir):
    """The cache is new for each call, so that every text is counted; it outlives the call."""
    model = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model, new_path(spark, "token-counts"))


@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_orc_tokens(spark, sf_dir):
    path = new_path(spark, "orc-tokens")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return orc_tokens.read_tokens(spark, path).select(
        "doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), orc_tokens.ids_crc32(F.col("ids")).alias("ids_crc32")
    )


@query
def op11_quality_ratio(spark, sf_dir):
    return quality_ratio.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), top=2000)


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


ORACLE: dict[str, str] = {
    "op2_lattice_near_dup": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 98e-2),
        reach(a, b) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
        SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
               r.root AS component_id, e.vec_id = r.root AS kept
        FROM embeddings e JOIN roots r ON r.a = e.vec_id""",
    "op3_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        sized AS (
            SELECT *, 14 + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\e'), ':', '\c'))
                + length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\e')) AS chars FROM turns)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id""",
    "op4_warc_segments": """
        WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        sized AS (SELECT page_id, body, octet_length(encode(body)) AS n FROM bodies),
        best AS (SELECT body, max(page_id) AS to_page FROM sized WHERE n >= 1000 GROUP BY body)
        SELECT s.page_id, CAST(s.n AS BIGINT) AS payload_bytes, sha1(s.body) AS payload_digest,
            CASE WHEN b.to_page IS NULL OR b.to_page = s.page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN b.to_page <> s.page_id THEN b.to_page END AS refers_to
        FROM sized s LEFT JOIN best b ON s.n >= 1000 AND b.body = s.body""",
    "op8_decontaminate": r"""
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM windows),
        grams AS (
            SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words CROSS JOIN sizes WHERE len(w) >= n)),
        found AS (SELECT g.doc_id, g.i, g.n, w.item_id FROM grams g JOIN windows w ON w.n = g.n AND w.gram = g.gram),
        hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
            sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
        FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN items t USING (doc_id)""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT lang, doc, row_number() OVER () AS piece, regexp_extract_all(body, '[^\x20\x09]+') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, doc, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS body
                  FROM (SELECT row_number() OVER () AS doc, lang, text FROM documents))),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        grams AS (
            SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
            FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) AS sizes(k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
        longer AS (
            SELECT s.lang, s.phrase, max(b.f) AS f
            FROM f s JOIN f b ON s.lang = b.lang AND b.k > s.k AND s.k > 1 AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ')
            GROUP BY ALL),
        cuts AS (
            SELECT c.lang, c.phrase, c.f AS a, c.j, l.f AS l, r.f AS r, t.n,
                   (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
            FROM (SELECT f.*, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS w FROM f WHERE k > 1) c
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.j], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.j + 1 :], ' ')
            JOIN totals t ON t.lang = c.lang),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        ranked AS (
            SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank,
                   c.phrase, c.a, c.l, c.r, c.n, CAST(c.score AS BIGINT) AS score
            FROM lowest c LEFT JOIN longer g ON g.lang = c.lang AND g.phrase = c.phrase WHERE g.f IS NULL OR g.f < c.a)
        SELECT * FROM ranked WHERE rank <= 2000""",
}

"""Registered queries of the training-data operators, and their SQL where SQL has any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .divergence_audit import audit_sources
from .embedding_pairs import near_vectors
from .exact_dedup import judge_duplicates
from .lattice_scores import lattice_scores
from .mixing import mix
from .ngram_join import near_groups
from .packing import pack
from .prefix_trie import prefix_trie, sequences, with_shared_heads
from .quality import judge_quality
from .sentence_spans import WORDS, remove_repeats
from .sharding import assign_shards
from .suffix_dedup import cut_repeats
from .token_store import stored


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_duplicates(read(spark, sf_dir, "documents")).drop("hash")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents"), words=4, percent=85)


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read(spark, sf_dir, "documents"), counts=True, words=WORDS)
    return cut.select("doc_id", "n_sentences", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(read(spark, sf_dir, "documents"))


def op8_embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), draws=True)


def op11_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null id counts as the empty text, so its rows are learned from."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return lattice_scores(read(spark, sf_dir, "documents"), held_out)


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    head = (F.crc32(conv.cast("string").cast("binary")) % 6).cast("int")
    convs = sequences(read(spark, sf_dir, "conversations"))
    return prefix_trie(with_shared_heads(convs, conv - conv % 100, head, most=5))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_ngram_join": op3_ngram_join,
    "op4_hilbert_sharding": op4_hilbert_sharding,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sentence_spans": op6_sentence_spans,
    "op7_token_store": op7_token_store,
    "op8_embedding_pairs": op8_embedding_pairs,
    "op9_quality": op9_quality,
    "op10_mixing": op10_mixing,
    "op11_lattice_scores": op11_lattice_scores,
    "op12_source_audit": op12_source_audit,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op2_exact_dedup": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
""",
    "op12_source_audit": r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
kept AS (SELECT lang, term, count(*) AS in_lang FROM words GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(in_lang) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
        CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 1)) // (g.n + v) AS BIGINT) AS p,
        CAST(1 + (CAST(1000000000 AS HUGEINT) * (in_lang + 1)) // (l.n + v) AS BIGINT) AS q
    FROM totals g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM dense WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
""",
    # crc32 by its definition: eight steps a digit.
    "op13_prefix_trie": """
WITH own AS (
    SELECT conv_id, list({'d': md5(octet_length(encode(coalesce(role, ''))) || ' ' || coalesce(role, '') || coalesce(text, '')), 'n': length(coalesce(text, ''))}
        ORDER BY turn IS NOT NULL, turn, coalesce(role, ''), md5(octet_length(encode(coalesce(role, ''))) || ' ' || coalesce(role, '') || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
        lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 6 AS h
    FROM own),
convs AS (
    SELECT a.conv_id, list_concat(coalesce(b.turns[1:CAST(a.h AS INTEGER)], []), a.turns[CAST(a.h AS INTEGER) + 1:]) AS turns
    FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
members AS (
    SELECT conv_id, depth, list_transform(turns[1:depth], lambda x: x.d) AS path, len(turns) = depth AS here,
        CASE WHEN depth > 0 THEN turns[depth].n ELSE 0 END AS n
    FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM convs)),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE here), '') AS ends
    FROM members GROUP BY path, depth),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (path)),
below AS (
    SELECT path[1:up] AS path, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM full_nodes) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
""",
}

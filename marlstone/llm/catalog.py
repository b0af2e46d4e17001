"""The text operators as queries over the benchmark tables.

A query with SQL can be compared with DuckDB; the others are tested against
brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.archives import archive
from marlstone.llm.bit_slices import search
from marlstone.llm.common import ship, table
from marlstone.llm.credentials import scan
from marlstone.llm.decontaminate import leaks
from marlstone.llm.merkle import manifest, prove
from marlstone.llm.part_enum import groups
from marlstone.llm.set_sketch import sketch_groups
from marlstone.llm.spelling import spelling_variants
from marlstone.llm.templates import main_text
from marlstone.llm.token_files import token_files
from marlstone.llm.toxicity import toxicity
from marlstone.llm.trie_bpe import encode_decode
from marlstone.llm.url_rules import judge

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(spark, folder)

        QUERIES[name] = Query(run, sql)
        return run

    return add


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_token_files")
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(table(spark, folder, "documents"), vocabulary(), end_id=2)


OP2_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id,
        CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op2_bit_slices", OP2_SQL)
def op2_bit_slices(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0), 10)


@query("op3_trie_bpe")
def op3_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(table(spark, folder, "documents"), vocabulary())


@query("op4_linked_secrets")
def op4_linked_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents"))


@query("op5_url_rules")
def op5_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"))


@query("op6_page_templates")
def op6_page_templates(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


@query("op7_part_enum")
def op7_part_enum(spark: SparkSession, folder: str) -> DataFrame:
    found = groups(table(spark, folder, "documents"), n=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op8_spaced_seeds")
def op8_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_warc_revisits")
def op10_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    records = archive(table(spark, folder, "pages"), min_bytes=0)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP11_SQL = """
WITH RECURSIVE runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
), counted AS (
    SELECT id, run, count(*) AS n, xor(list_reduce(list_prepend(4294967295,
            list_transform(range(0, octet_length(encode(id || ':' || run))), lambda i:
                CAST('0x' || substr(hex(encode(id || ':' || run)), 2 * i + 1, 2) AS BIGINT))),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295) AS h
    FROM runs GROUP BY id, run
), damaged AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM counted
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged GROUP BY word HAVING length(word) >= 7 AND sum(n) >= 2
), shorter AS (
    SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
        CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), ways AS (
    SELECT word, word AS root, 0 AS steps FROM forms
    UNION ALL SELECT w.word, f.form, w.steps + 1 FROM ways w JOIN forms f ON f.word = w.root AND f.form IS NOT NULL
), ends AS (
    SELECT word, max_by(root, steps) AS root FROM ways GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


@query("op11_reduced_alphabet", OP11_SQL)
def op11_reduced_alphabet(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"), damage=31)


def _groups_sql(n: int, percent: int, kept: bool) -> str:
    """Groups of similar documents by brute force: all pairs that share an n-gram."""
    gram = " || ' ' || ".join(f"words[i + {k}]" for k in range(n))
    return f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), grams AS (
    SELECT DISTINCT doc_id, {gram} AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {n - 2})) AS i FROM texts WHERE len(words) >= {n})
    UNION ALL
    SELECT doc_id, array_to_string(words, ' ') FROM texts WHERE len(words) BETWEEN 1 AND {n - 1}
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), numbered AS (
    SELECT doc_id, n, dense_rank() OVER (ORDER BY gram) AS gram FROM grams JOIN sizes USING (doc_id)
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS a_n, b.n AS b_n, count(*) AS common
    FROM numbered a JOIN numbered b ON a.gram = b.gram AND a.doc_id <> b.doc_id
        AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n
    GROUP BY 1, 2, 3, 4
), links AS (
    SELECT a, b FROM common WHERE 100 * common >= {percent} * (a_n + b_n - common)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id{", d.doc_id = component_id AS kept" if kept else ""}
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query("op12_set_sketch", _groups_sql(2, 80, kept=True))
def op12_set_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch_groups(table(spark, folder, "documents"), n=2, percent=80)


OP13_SQL = """
WITH RECURSIVE crcs AS (
    SELECT DISTINCT doc_id, xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)), 4294967295) AS crc
    FROM documents WHERE doc_id IS NOT NULL
), rows AS (
    SELECT d.*, CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS tampered
    FROM documents d LEFT JOIN crcs USING (doc_id)
), hashed AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || body) AS leaf,
        sha256(head || coalesce(strlen(CAST(tampered AS VARCHAR)) || ':' || tampered, '-') || body) AS offered
    FROM (
        SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
            || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
            coalesce(strlen(text) || ':' || text, '-') AS body
        FROM rows)
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM hashed
), nodes AS (
    SELECT tree, n, 0 AS level, pos, leaf AS digest FROM leaves
    UNION ALL
    SELECT tree, (n + 1) // 2, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY tree, n, level, pos // 2
), subroots AS (
    SELECT tree, max(level) AS depth, max_by(digest, level) AS subroot FROM nodes GROUP BY tree
), upper AS (
    SELECT (SELECT count(*) FROM subroots) AS n, 0 AS level, tree AS pos, subroot AS digest FROM subroots
    UNION ALL
    SELECT (n + 1) // 2, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
    FROM upper WHERE n > 1 GROUP BY n, level, pos // 2
), ways AS (
    SELECT tree, pos AS leaf_pos, 0 AS level, pos, '' AS siblings, offered AS folded FROM leaves
    UNION ALL
    SELECT w.tree, w.leaf_pos, w.level + 1, w.pos // 2, w.siblings || coalesce(s.digest, ''),
        sha256(CASE WHEN w.pos % 2 = 0 THEN w.folded || coalesce(s.digest, '') ELSE s.digest || w.folded END)
    FROM ways w JOIN subroots r ON w.tree = r.tree AND w.level < r.depth
    LEFT JOIN nodes s ON s.tree = w.tree AND s.level = w.level AND s.pos = xor(w.pos, 1)
), tops AS (
    SELECT max(level) AS height, max_by(digest, level) AS root FROM upper
), ends AS (
    SELECT w.tree, w.leaf_pos, 0 AS level, w.tree AS pos, w.siblings, w.folded
    FROM ways w JOIN subroots r ON w.tree = r.tree AND w.level = r.depth
    UNION ALL
    SELECT w.tree, w.leaf_pos, w.level + 1, w.pos // 2, w.siblings || coalesce(s.digest, ''),
        sha256(CASE WHEN w.pos % 2 = 0 THEN w.folded || coalesce(s.digest, '') ELSE s.digest || w.folded END)
    FROM ends w JOIN tops t ON w.level < t.height
    LEFT JOIN upper s ON s.level = w.level AND s.pos = xor(w.pos, 1)
)
SELECT l.doc_id, l.leaf, r.subroot, t.root, sha256(e.siblings) AS proof_sha256, e.folded AS folded_root,
    e.folded = t.root AS verified
FROM leaves l JOIN subroots r USING (tree) CROSS JOIN tops t
JOIN ends e ON e.tree = l.tree AND e.leaf_pos = l.pos AND e.level = t.height
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(chosen, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, folder, "documents")
    made = manifest(docs, columns, group="lang", key="doc_id", changed={"n_chars": tampered})
    return prove(made).withColumnRenamed("key", "doc_id")

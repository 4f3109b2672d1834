"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, read, ship, words
from .lattice import similar_vectors
from .licenses import scan
from .mixing import mix
from .packing import pack
from .pieces import encode_pieces, piece_digests
from .privacy import find
from .quality import judge
from .runs import find_runs
from .simhash import near_duplicates
from .spelling import variants, word_counts
from .suffixes import remove_repeats
from .token_files import token_digests
from .urls import judge_urls


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).drop("lang", "source")


def op2_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(read(spark, sf_dir, "embeddings"), least=0.9)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), vocabulary(), capacity=4096, end_id=1)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op5_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4)


def op6_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), length=200)


#: Slots of a period per source; all other sources share REST_WEIGHT.
WEIGHTS = {"src0": 6, "src1": 3, "src2": 3, "src3": 3, "src4": 3}
REST_WEIGHT = 12
BLOCK_CHARS = 50_000


def op7_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), WEIGHTS, REST_WEIGHT, BLOCK_CHARS)


def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(read(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents carry no path: a source is taken as a folder with one folder per language."""
    files = read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"),
        "text")
    return scan(files, least=0.8).withColumnRenamed("id", "doc_id")


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op10_url_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), URL_RULES, default="allow")


def pieces_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    ship(spark)
    return piece_digests(encode_pieces(docs, pieces_model()), pieces_model())


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document by crc32 of its doc_id repeats, from some word on, the words found there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def planted(said: Column) -> Column:
        n = F.size(said).cast("long")
        first = F.pmod(g, n)
        period = 1 + F.floor((n - first) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        tail = F.transform(F.sequence(first, n - 1), lambda i: F.get(said, (first + F.pmod(i - first, period)).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(said, 1, first.cast("int")), tail), " "))

    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, let(words(F.col("text")), planted))
                       .otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = find_runs(with_planted_runs(read(spark, sf_dir, "documents")), least=6, times=4)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_spelling_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return variants(word_counts(read(spark, sf_dir, "documents"), shortest=5, least=3, mistyped=97), times=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_robust_outliers, op2_e8_lattice, op3_best_fit_packing, op4_token_files, op5_covering_simhash,
    op6_difference_cover, op7_pfair_mix, op8_disclosure, op9_license_scan, op10_url_trie, op11_offset_pieces,
    op12_periodic_runs, op13_spelling_trees)}

ORACLE: dict[str, str] = {
    "op2_e8_lattice": """
        WITH RECURSIVE sound AS (
          SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
        reach AS (
          SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
        component AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
        degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
        FROM embeddings e JOIN component c ON e.vec_id = c.a LEFT JOIN degree d ON e.vec_id = d.a""",
    "op10_url_trie": r"""
        WITH rules(action, host, path) AS (VALUES
          ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
          ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        rest AS (
          SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
          FROM pages),
        split AS (
          SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        hit AS (
          SELECT s.page_id, max_by(u.host || u.path, length(u.host) * 1000 + length(u.path)) AS rule,
                 max_by(u.action, length(u.host) * 1000 + length(u.path)) AS action
          FROM split s JOIN rules u ON (s.host = u.host OR ends_with(s.host, '.' || u.host))
            AND starts_with(s.path, u.path) GROUP BY s.page_id)
        SELECT s.page_id, s.host, s.path, h.rule, coalesce(h.action, 'allow') AS verdict
        FROM split s LEFT JOIN hit h USING (page_id)""",
}

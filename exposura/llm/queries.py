"""The registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from exposura.llm import alignment, bpe, exact, html, langid, merkle, minhash, mixing, quality, secrets, sharding, transducer, vectors
from exposura.llm.common import UPPER, table
from exposura.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_reshard")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, read back from the shards' files."""
    path = scratch_path(spark, "op1-shards")
    sharding.write_shards(sharding.reshard(table(spark, folder, "documents")), path)
    files = spark.read.schema("doc_id long, text string, size long, old_shard int, slot long, shard int").parquet(path)
    return files.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")


@query("op2_near_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near copies over all documents."""
    return minhash.near_duplicates(table(spark, folder, "documents"), threshold=(85, 100))


@query("op3_language")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = table(spark, folder, "documents")
    profiles = langid.learn_profiles(docs.where(~langid.held_out()))
    found = langid.identify(docs, profiles)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query("op4_html")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages")
    return html.extract(pages, html.learn(pages))


@query("op5_secrets")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Places of secrets in every document, without their values."""
    return secrets.find_secrets(table(spark, folder, "documents")).drop("base_spans")


@query("op6_bpe")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every document."""
    return bpe.digests(table(spark, folder, "documents"))


@query("op7_quality")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from trusted positives and unlabelled text."""
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, folder, "labels")))


@query("op8_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(k) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS k FROM documents)
WINDOW same AS (PARTITION BY k)
""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies over all documents."""
    return exact.exact_groups(table(spark, folder, "documents"))


@query("op9_mix", r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS key FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(2 * sum(size) AS BIGINT) AS lim,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
l AS (
  SELECT *, (1.5 * CAST(sum(source_size) OVER () AS DOUBLE)
             - CAST(coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / CAST(sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w),
t AS (
  SELECT source, source_size,
         CASE WHEN lim / weight > level THEN max(CASE WHEN lim / weight > level THEN level END) OVER () * weight
              ELSE CAST(lim AS DOUBLE) END AS target FROM l),
b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS rounds FROM b),
p AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, r.rounds, r.budget - r.rounds * r.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, CAST(size * rounds + greatest(0, least(size, rest - start)) AS BIGINT) AS taken FROM p
""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes from every document."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op10_vectors")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of near equal embeddings of one label."""
    return vectors.vector_duplicates(table(spark, folder, "embeddings"))


@query("op11_token_counts")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return transducer.count_tokens(table(spark, folder, "documents")).withColumn("over_limit", F.col("n_tokens") > 2048)


def merkle_sql(heights: tuple[int, int] = (12, 6)) -> str:
    """The manifest level by level, for up to 3 ** 12 rows a source and 3 ** 6 sources."""
    def item(x):
        return f"coalesce(CAST(octet_length(encode(CAST({x} AS VARCHAR))) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"

    def leaf(text):
        return "sha256(" + " || ".join(map(item, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    low_bit = (
        "list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),"
        " lambda c, b: list_reduce(list_prepend(xor(c, b), [1, 1, 1, 1, 1, 1, 1, 1]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) & 1")

    def climb(name, group, height):
        """Levels of trees over name_0 (group, idx, n, d); a finished tree's root stays as it is."""
        return [
            f"{name}_{k + 1} AS (SELECT {group}, idx // 3 AS idx, (n + 2) // 3 AS n,"
            f" CASE WHEN n = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY idx)) END AS d, list(d ORDER BY idx) AS run"
            f" FROM {name}_{k} GROUP BY {group}, idx // 3, n)" for k in range(height)]

    def way(name, group, at, height, start, key):
        """Of each row, the digest carried up and what lies beside it."""
        out, last = [], start
        for k in range(height):
            turn = f"p.{at} // {3 ** k} % 3"
            out.append(
                f"{name}_{k + 1} AS (SELECT p.* EXCLUDE (up, beside),"
                f" CASE WHEN len(r.run) = 1 AND c.n = 1 THEN p.up ELSE sha256(array_to_string(list_transform(r.run, lambda x, i: CASE WHEN i = {turn} + 1 THEN p.up ELSE x END), '')) END AS up,"
                f" p.beside || array_to_string(list_filter(r.run, lambda x, i: i <> {turn} + 1), '') AS beside"
                f" FROM {last} p JOIN {key}_{k + 1} r ON p.{group} = r.{group} AND p.{at} // {3 ** (k + 1)} = r.idx"
                f" JOIN {key}_{k} c ON p.{group} = c.{group} AND p.{at} // {3 ** k} = c.idx)")
            last = f"{name}_{k + 1}"
        return out, last

    low, high = heights
    lower, last = way("w", "g", "idx", low, "w_0", "t")
    upper, end = way("v", "z", "g", high, "v_0", "s")
    parts = [
        "names AS (SELECT source AS named, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source FROM documents))",
        f"leaves AS (SELECT d.doc_id, names.g, {leaf('text')} AS leaf, CASE WHEN {low_bit} = 0 THEN {leaf('text')} ELSE {leaf("replace(text, chr(10), '')")} END AS taken"
        " FROM documents d JOIN names ON d.source IS NOT DISTINCT FROM names.named)",
        "t_0 AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n, leaf AS d, doc_id, taken FROM leaves)",
        *climb("t", "g", low),
        f"s_0 AS (SELECT 0 AS z, g AS idx, count(*) OVER () AS n, d FROM t_{low})",
        *climb("s", "z", high),
        "w_0 AS (SELECT doc_id, g, idx, d AS leaf, taken AS up, '' AS beside FROM t_0)",
        *lower,
        f"v_0 AS (SELECT *, 0 AS z FROM {last})",
        *upper,
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, t.d AS subroot, s.d AS root, sha256(beside) AS proof_sha256, up AS folded_root, up = s.d AS verified
FROM {end} e JOIN t_{low} t ON e.g = t.g JOIN s_{high} s ON e.z = s.z"""


@query("op12_merkle", merkle_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document; every other id has its line breaks deleted."""
    docs = table(spark, folder, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(docs, changed={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=even)


@query("op13_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens over every document."""
    return alignment.align(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)

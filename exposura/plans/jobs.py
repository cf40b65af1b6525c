"""The end-to-end jobs, each a composition of operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from exposura import rules
from exposura.functions import files, html, lines, sensitive, text
from exposura.operators import aggregates, dedup, inference, joins


def flag_incremental(
    threads: DataFrame, flagged: DataFrame, keywords: list[str] = rules.KEYWORDS,
    flagged_at: Column | None = None,
) -> DataFrame:
    """Threads with a hash, not flagged before, with at least one keyword.

    The keywords are matched where the texts are read, so that only flagged rows,
    with the columns the caller goes on to use, are shuffled to meet the earlier
    flags. A left join says so where an anti join would be moved below the match
    and shuffle every text.
    """
    hits = dedup.keyword_flagged(
        threads.filter(F.col("dedup_hash").isNotNull()), "title", "content", keywords
    )
    known = flagged.select("dedup_hash").distinct().withColumn("_known", F.lit(True))
    return (
        hits.join(known, "dedup_hash", "left")
        .filter(F.col("_known").isNull())
        .drop("_known")
        .withColumn("flagged_at", flagged_at if flagged_at is not None else F.current_timestamp())
        .withColumn("reviewed", F.lit(False))
    )


def flag_report(threads: DataFrame, order: str, keywords: list[str] = rules.KEYWORDS) -> DataFrame:
    """Per forum: distinct threads, flagged threads and keyword hits.

    The texts are matched where they are read; only hash, order, forum and a
    count travel to the aggregate that keeps the first thread per hash.
    """
    hits = dedup.keyword_flag(threads, "title", "content", keywords).select(
        order, "forum", "dedup_hash", F.size("matched_keywords").alias("n_hits")
    )
    unique = dedup.unique_sparse(hits, "dedup_hash", [order], [order, "forum", "n_hits"])
    return unique.groupBy("forum").agg(
        F.count("*").alias("n_threads"),
        F.count_if(F.col("n_hits") > 0).alias("n_flagged"),
        F.sum("n_hits").alias("n_hits"),
    )


def pii_scan(df: DataFrame, key: str, column: str) -> DataFrame:
    counts = sensitive.pii_counts(F.col(column))
    return df.select(key, *[c.cast("long").alias(n) for n, c in counts.items()])


def redact(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, sensitive.redact(F.col(column)))


def line_clean(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, lines.line_clean(F.col(column)))


def credential_list_quarantine(df: DataFrame, key: str, column: str, threshold: float = 0.7) -> DataFrame:
    """(key, share, quarantined): texts laid out like a credential list; no field leaves them."""
    share = inference.list_share(F.col(column))
    return df.select(key, share.alias("share")).withColumn("quarantined", F.col("share") >= threshold)


def domain_mentions(
    df: DataFrame, keep: list[str], column: str, suffixes: list[str], owned: DataFrame | None = None
) -> DataFrame:
    """(keep.., kind, domain, n): registered domains of the addresses in every text.

    With a table of owned domains only theirs are counted; the others are left
    before anything is shuffled where that table is below the broadcast threshold.
    """
    def mentions(kind: str, found: Column) -> Column:
        return F.transform(
            found,
            lambda x: F.struct(F.lit(kind).alias("kind"), text.registered_domain(x, suffixes).alias("domain")),
        )

    pairs = F.concat(
        mentions("email", sensitive.tokens(F.col(column), rules.EMAIL)),
        mentions("url", sensitive.tokens(F.col(column), r"https?://[A-Za-z0-9.-]+")),
    )
    long = df.select(*keep, F.explode(pairs).alias("m")).select(*keep, "m.kind", "m.domain")
    named = long.filter(F.col("domain") != "")
    if owned is not None:
        named = named.join(owned.select("domain"), "domain", "left_semi")
    return named.groupBy(*keep, "kind", "domain").agg(F.count("*").alias("n"))


def watchlist_exposure(
    df: DataFrame, owned: DataFrame, keep: list[str], column: str, suffixes: list[str]
) -> DataFrame:
    """Counts by owned domain and kind; a domain meets the list before it is counted."""
    return domain_mentions(df, keep, column, suffixes, owned)


def exposure_report(exposure: DataFrame, by: list[str], approximate: bool = False, precision: int = 12) -> DataFrame:
    """Totals and numbers of domains over the rollup of the given columns; NULL stands for "all".

    Each level is an aggregate of the one below it, so no row is copied per level and
    a level costs what the level below has groups. Exact: a level keeps its domains
    apart until they are counted. Approximate: domains become sketches, which merge
    upwards; their standard error is about 1.04 / sqrt(2 ** precision), 1.6 % for 12.
    """
    n = F.sum("n").alias("n")
    if approximate:
        level = exposure.groupBy(*by).agg(n, F.hll_sketch_agg("domain", precision).alias("_domains"))
    else:
        level = exposure.groupBy(*by, F.col("domain").alias("_domain")).agg(n)
    levels = []
    for depth in range(len(by), -1, -1):
        keys = by[:depth]
        if depth < len(by):
            if approximate:
                level = level.groupBy(*keys).agg(n, F.hll_union_agg("_domains").alias("_domains"))
            else:
                level = level.groupBy(*keys, "_domain").agg(n)
        if approximate:
            counted = level.withColumn("n_domains", F.hll_sketch_estimate("_domains")).drop("_domains")
        else:
            counted = level.groupBy(*keys).agg(n, F.count("_domain").alias("n_domains"))
        missing = [F.lit(None).cast(exposure.schema[c].dataType).alias(c) for c in by[depth:]]
        levels.append(counted.select(*keys, *missing, "n", "n_domains"))
    return reduce(DataFrame.unionByName, levels)


def score_hosts(counts: DataFrame, host: str, kind: str, n: str, weights=rules.RISK_WEIGHTS_A) -> DataFrame:
    return aggregates.risk_score(counts, host, kind, n, weights)


def classify_file(
    catalog: DataFrame, path: str, sample: Column | None = None,
    records: list[dict] | None = None, list_threshold: float | None = None,
) -> DataFrame:
    """Adds the parser of every file: by suffix, then by the shape of a text sample.

    Filename records, if given, come first. A sample whose first line has a table's
    header is a table and no list. With a threshold, samples laid out like a
    credential list that far get "credential_list", which is for quarantine.
    """
    family = files.file_family(F.col(path))
    if sample is not None:
        headed = sensitive.table_header(F.get(inference.sample_lines(sample, 1), F.lit(0)))
        shape = F.when(headed, "table").otherwise(inference.csv_vs_list(sample))
        family = F.when(
            (family == "list") & (shape == "table"), "structured_table"
        ).otherwise(family)
    if sample is not None and list_threshold is not None:
        family = F.when(inference.list_share(sample) >= list_threshold, "credential_list").otherwise(family)
    if records:
        family = F.coalesce(inference.filename_record(files.filename(F.col(path)), records)["parser"], family)
    return catalog.withColumn("parser", family)


def ingest(
    files_df: DataFrame, registry: DataFrame, key: str, content: str
) -> DataFrame:
    """New files only, one per content digest: (sha256, key, parser, size)."""
    hashed = files_df.select(
        files.digest(F.col(content)).alias("sha256"), key, F.octet_length(content).alias("size"),
        inference.csv_vs_list(F.col(content)).alias("shape"),
    )
    fresh = joins.new_only(hashed, registry, "sha256")
    from exposura.operators.windows import first_per_key

    return first_per_key(fresh, ["sha256"], [key], [key, "size", "shape"])


def ingest_into(
    files_df: DataFrame, registry_path: str, key: str, content: str, batch: str
) -> DataFrame:
    """Appends the new files of a batch to the registry and returns them, as stored.

    A registry is a folder of batches; a batch that is run again overwrites its own
    part, and files known from other batches are left out, so neither a repeated
    batch nor a repeated file doubles a row. Rows carry the status "processed".
    """
    spark = files_df.sparkSession
    schema = "sha256 string, size long, shape string, status string, batch string"
    path = spark._jvm.org.apache.hadoop.fs.Path(registry_path)
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    known = spark.read.parquet(registry_path).filter(F.col("batch") != batch) if exists else spark.createDataFrame([], schema)
    fresh = ingest(files_df, known, key, content).withColumn("size", F.col("size").cast("long"))
    part = f"{registry_path.rstrip('/')}/batch={batch}"
    fresh.withColumn("status", F.lit("processed")).write.mode("overwrite").parquet(part)
    return spark.read.parquet(part)


def extract_entries(pages: DataFrame, url: str, column: str, layouts: list[tuple[str, dict]]) -> DataFrame:
    """Cards of every page under the first layout whose name is part of the host."""
    host = text.host_of(F.col(url))
    found = text.first_rule([(host.contains(name), html.entries(F.col(column), lay)) for name, lay in layouts])
    return pages.select(url, F.posexplode(found).alias("ordinal", "e")).select(
        url, "ordinal", "e.title", F.col("e.url").alias("entry_url"), "e.body"
    )

"""Projections (survey 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import case_first, q, query, sql_in
from exposura.functions import sensitive
from exposura.operators import projections as p
from exposura.session import DEMO_PEPPER, pepper
from exposura.sources.readers import table

PEPPER = q(DEMO_PEPPER)


def _people(spark, folder):
    """Customers under raw column names, several of them meaning the same."""
    c = table(spark, folder, "customer")
    return c.select(
        F.col("c_custkey").alias("_row"),
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("A"), F.col("c_custkey"), F.lit("@example.com"))).alias("E_Mail"),
        F.concat(F.lit("b"), F.col("c_custkey"), F.lit("@example.org ")).alias("email_address"),
        F.col("c_name").alias("login"),
        F.concat(F.lit("+1 555 01"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("mobile"),
        F.when(F.col("c_custkey") % 2 == 0, F.md5("c_name")).otherwise("invented").alias("pwd"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("country_id"),
    )


@query("remap_columns", f"""
SELECT c_custkey AS "_row",
  sha256({q(DEMO_PEPPER)} || CASE WHEN c_custkey % 3 = 0 THEN 'b' || c_custkey || '@example.org '
                     ELSE 'A' || c_custkey || '@example.com' END) AS email_hash,
  c_name AS username, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS country
FROM customer""")
def remap_columns(spark, folder):
    out = p.remap_columns(_people(spark, folder))
    return out.select(
        "_row", F.sha2(F.concat(F.lit(pepper(spark, DEMO_PEPPER)), "email"), 256).alias("email_hash"), "username", "segment", "country"
    )


@query("merge_aliases", f"""
WITH builtin AS (SELECT 'n_' || n_nationkey AS name, 'city' AS target FROM nation),
learned AS (SELECT 'n_' || (n_nationkey * 2) AS name,
  CASE n_nationkey % 3 WHEN 0 THEN 'region' WHEN 1 THEN 'ignore' ELSE 'unheard' END AS target FROM nation),
valid AS (SELECT * FROM learned WHERE target <> 'unheard')
SELECT name, coalesce(v.target, b.target) AS target FROM builtin b FULL JOIN valid v USING (name)""")
def merge_aliases(spark, folder):
    n = table(spark, folder, "nation")
    builtin = n.select(F.concat(F.lit("n_"), "n_nationkey").alias("name"), F.lit("city").alias("target"))
    k = F.col("n_nationkey") % 3
    learned = n.select(
        F.concat(F.lit("n_"), F.col("n_nationkey") * 2).alias("name"),
        F.when(k == 0, " Region ").when(k == 1, "ignore").otherwise("unheard").alias("target"),
    )
    return p.merge_aliases(builtin, learned)


@query("normalize_identity", f"""
SELECT c_custkey AS "_row",
  sha256({PEPPER} || CASE WHEN c_custkey % 3 = 0 THEN 'b' || c_custkey || '@example.org' ELSE 'a' || c_custkey || '@example.com' END) AS email_hash,
  sha256({PEPPER} || lower(c_name)) AS username_hash,
  sha256({PEPPER} || '+155501' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')) AS phone_hash,
  CASE WHEN c_custkey % 2 = 0 THEN 'md5' ELSE 'plaintext' END AS secret_kind,
  CAST(c_nationkey AS VARCHAR) AS country
FROM customer""")
def normalize_identity(spark, folder):
    out = p.normalize_identity(p.remap_columns(_people(spark, folder)), pepper(spark, DEMO_PEPPER))
    return out.select("_row", "email_hash", "username_hash", "phone_hash", "secret_kind", F.col("extra_data")["country"].alias("country"))


@query("pack_extra", """
SELECT o_orderkey, concat_ws(';', CASE WHEN o_orderpriority <> '5-LOW' THEN 'priority=' || o_orderpriority END,
       'status=' || o_orderstatus) AS extra FROM orders""")
def pack_extra(spark, folder):
    o = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("extra_data.status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.lit("").alias("blank"), F.lit("x").alias("_meta"),
    )
    out = p.pack_extra(o, ["o_orderkey"])
    pairs = F.transform(F.map_entries("extra_data"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.select("o_orderkey", F.array_join(F.sort_array(pairs), ";").alias("extra"))


TX = f"""
WITH {v.TRANSACTIONS}
SELECT o_orderkey, user_id, trim(purchase_reference_id) AS purchase_ref,
       coalesce(revenue_country, nullif(payment_country, 'n/a')) AS country, charge_amount,
       CASE WHEN o_orderkey % 7 <> 0 THEN replace(transaction_time, ' ', 'T') END AS transaction_date
FROM transactions"""


@query("normalize_transaction", TX)
def normalize_transaction(spark, folder):
    return p.normalize_transaction(v.transactions(spark, folder))


@query("require_transaction_field", TX + """
WHERE coalesce(revenue_country, nullif(payment_country, 'n/a')) IS NOT NULL OR o_orderkey % 7 <> 0""")
def require_transaction_field(spark, folder):
    t = p.normalize_transaction(v.transactions(spark, folder))
    return p.require_transaction_field(t, ["country", "transaction_date"])


@query("require_pillar", """
SELECT c_custkey, CAST(CASE WHEN c_custkey % 3 = 0 THEN 'set' WHEN c_custkey % 3 = 1 THEN '' END AS VARCHAR) AS username,
       CASE WHEN c_custkey % 5 = 0 THEN 'https://example.org' END AS url
FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0""")
def require_pillar(spark, folder):
    k = F.col("c_custkey")
    c = table(spark, folder, "customer").select(
        "c_custkey", F.when(k % 3 == 0, "set").when(k % 3 == 1, "").alias("username"),
        F.when(k % 5 == 0, "https://example.org").alias("url"),
    )
    return p.require_pillar(c)


@query("flatten_one_level", """
SELECT event_id, user_id AS "who.user_id", event_type AS "who.event_type", CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""")
def flatten_one_level(spark, folder):
    e = table(spark, folder, "events").select(
        "event_id", F.struct("user_id", "event_type", F.from_json("props", "k long").alias("props")).alias("who")
    )
    return p.flatten_one_level(e).select("event_id", "`who.user_id`", "`who.event_type`", F.col("`who.props`.k").alias("k"))


@query("extract_embedded_json", """
SELECT event_id, CASE WHEN k NOT IN ('0') AND event_type <> 'error' THEN k END AS step FROM (
  SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events)""")
def extract_embedded_json(spark, folder):
    e = table(spark, folder, "events")
    broken = F.when(F.col("event_type") == "error", F.left("props", F.lit(4))).otherwise(F.col("props"))
    raw = e.select("event_id", broken.alias("props"))
    return p.extract_embedded_json(raw, {"props": {"k": "step"}}).select("event_id", "step")


@query("add_provenance", """
SELECT event_id, 'feed' AS source_name, strftime(ts, '%Y-%m-%d') AS indexed_at, true AS stream_mode FROM events""")
def add_provenance(spark, folder):
    e = table(spark, folder, "events").select("event_id", "ts")
    return p.add_provenance(e, "feed", F.date_format("ts", "yyyy-MM-dd"), stream=True).drop("ts")


@query("derive_message_row", f"""
WITH {v.MESSAGES} SELECT message_id, channel, strftime(date, '%Y-%m-%d %H:%M') AS date, username, first_name, last_name,
       md5(message) AS message_hash, media_type, media_path, views FROM messages""")
def derive_message_row(spark, folder):
    m = v.messages(spark, folder)
    return m.select(
        "message_id", "channel", F.date_format("date", "yyyy-MM-dd HH:mm").alias("date"), "username", "first_name",
        "last_name", F.md5("message").alias("message_hash"), "media_type", "media_path", "views",
    )

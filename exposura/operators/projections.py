"""Renaming, packing and normalising columns."""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import Column, DataFrame, functions as F, types as T

from exposura import rules
from exposura.functions import sensitive, text, times, values


def remap_columns(df: DataFrame, aliases: dict[str, str] = rules.COLUMN_ALIASES) -> DataFrame:
    """Columns under their canonical names; on collision the first non-empty value wins.

    Names starting with "_", names without an alias and names aliased to
    "ignore" stay as they are.
    """
    targets: OrderedDict[str, list[str]] = OrderedDict()
    for name in df.columns:
        target = None if name.startswith("_") else aliases.get(name.lower())
        targets.setdefault(target if target and target != "ignore" else name, []).append(name)
    out = []
    for target, names in targets.items():
        if len(names) == 1:
            out.append(F.col(f"`{names[0]}`").alias(target))
        else:
            cols = [F.col(f"`{n}`").cast("string") for n in names]
            out.append(values.first_non_empty(*cols).alias(target))
    return df.select(*out)


def merge_aliases(builtin: DataFrame, learned: DataFrame) -> DataFrame:
    """(name, target): learned entries with a known target override the built-in ones."""
    allowed = rules.VALID_TARGETS + ["ignore"]
    valid = learned.select("name", F.lower(text.strip(F.col("target"))).alias("target")).filter(
        F.col("target").isin(allowed)
    )
    ranked = builtin.select("name", "target", F.lit(1).alias("rank")).unionByName(
        valid.withColumn("rank", F.lit(0))
    )
    return ranked.groupBy("name").agg(F.min_by("target", F.struct("rank", "target")).alias("target"))


def pack_extra(df: DataFrame, core: list[str], into: str = "extra_data") -> DataFrame:
    """Non-core, non-empty columns go into one map; "extra_data." prefixes are dropped."""
    rest = [c for c in df.columns if c not in core and not c.startswith("_")]
    pairs: list[Column] = []
    for name in rest:
        key = name.split(".", 1)[1] if name.startswith("extra_data.") else name
        pairs += [F.lit(key), F.col(f"`{name}`").cast("string")]
    kept = [F.col(f"`{c}`") for c in df.columns if c in core]
    return df.select(*kept, values.map_skip_empty(F.create_map(*pairs)).alias(into))


IDENTITY_PILLARS = ["email", "username", "phone", "facebook_uid", "url"]
PROFILE_FIELDS = [
    "city", "region", "country", "postcode", "gender", "user_id",
    "payment_method", "charge_amount", "currency", "transaction_date", "purchase_ref",
]


def normalize_identity(df: DataFrame, pepper: str) -> DataFrame:
    """Identifiers as keyed hashes, the password as its format name, the profile as a map.

    Expects canonical column names; names, addresses and birth dates are not kept.
    """
    clean = {
        "email": lambda c: text.norm_email(c),
        "username": lambda c: text.strip(c),
        "phone": lambda c: text.norm_phone(c),
        "facebook_uid": lambda c: text.strip(c),
        "url": lambda c: text.strip(c),
    }
    out = []
    for pillar in IDENTITY_PILLARS:
        if pillar in df.columns:
            value = text.blank_to_null(clean[pillar](F.col(pillar).cast("string")))
            out.append(sensitive.keyed_hash(value, pepper).alias(f"{pillar}_hash"))
    if "password" in df.columns:
        out.append(sensitive.secret_kind(F.col("password")).alias("secret_kind"))
    pairs: list[Column] = []
    for field in PROFILE_FIELDS:
        if field in df.columns:
            value = F.col(field).cast("string")
            value = times.sanitize_date(value) if field == "transaction_date" else text.strip(value)
            pairs += [F.lit(field), value]
    if pairs:
        out.append(values.map_skip_empty(F.create_map(*pairs)).alias("extra_data"))
    kept = [F.col(c) for c in df.columns if c.startswith("_")]
    return df.select(*kept, *out)


def require_pillar(df: DataFrame) -> DataFrame:
    """Rows with at least one identifier, plain or hashed."""
    names = IDENTITY_PILLARS + [f"{p}_hash" for p in IDENTITY_PILLARS]
    present = [F.nullif(F.col(c), F.lit("")) for c in names if c in df.columns]
    return df.filter(F.coalesce(*present).isNotNull())


def normalize_transaction(
    df: DataFrame, columns: dict[str, str] = rules.TRANSACTION_COLUMNS
) -> DataFrame:
    """Transaction columns under canonical names; on collision the last non-empty wins."""
    by_target: OrderedDict[str, list[Column]] = OrderedDict()
    lower = {c.lower(): c for c in df.columns}
    for source, target in columns.items():
        if source in lower:
            value = text.null_token(F.col(f"`{lower[source]}`").cast("string"))
            if "date" in target:
                value = times.sanitize_date(value)
            by_target.setdefault(target, []).append(value)
    used = {lower[s] for s in columns if s in lower}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in used]
    out = [values.last_non_empty(*cols).alias(t) for t, cols in by_target.items()]
    return df.select(*kept, *out)


def require_transaction_field(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.filter(F.coalesce(*[F.col(f) for f in fields]).isNotNull())


def flatten_one_level(df: DataFrame) -> DataFrame:
    """Struct fields as "parent.child"; deeper structs stay nested."""
    out = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            for child in field.dataType.fields:
                path = f"`{field.name}`.`{child.name}`"
                out.append(F.col(path).alias(f"{field.name}.{child.name}"))
        else:
            out.append(F.col(f"`{field.name}`"))
    return df.select(*out)


def extract_embedded_json(df: DataFrame, fields: dict[str, dict[str, str]]) -> DataFrame:
    """JSON text columns to named columns; malformed or falsy inner values give NULL."""
    for column, inner in fields.items():
        if column in df.columns:
            for key, target in inner.items():
                value = values.json_get(F.col(f"`{column}`"), key)
                falsy = value.isin("", "0", "0.0", "false", "[]", "{}")
                df = df.withColumn(target, F.when(~falsy, value))
    return df


def add_provenance(df: DataFrame, source: str, indexed_at: Column | None = None, stream: bool = False) -> DataFrame:
    stamped = df.withColumn("source_name", F.lit(source)).withColumn(
        "indexed_at", indexed_at if indexed_at is not None else F.current_timestamp()
    )
    return stamped.withColumn("stream_mode", F.lit(True)) if stream else stamped


MESSAGE_COLUMNS = [
    "message_id", "date", "sender_id", "first_name", "last_name", "username",
    "message", "media_type", "media_path", "reply_to", "post_author", "views",
    "forwards", "reactions",
]


def derive_message_row(df: DataFrame, given: dict[str, Column]) -> DataFrame:
    """The fourteen message columns; those not given are NULL."""
    kinds = {"message_id": "long", "sender_id": "long", "reply_to": "long", "views": "long",
             "forwards": "long", "date": "timestamp_ntz"}
    return df.select(
        *[
            (given[c] if c in given else F.lit(None)).cast(kinds.get(c, "string")).alias(c)
            for c in MESSAGE_COLUMNS
        ],
        *[given[c].alias(c) for c in given if c not in MESSAGE_COLUMNS],
    )

"""Rows, columns and spans that must not be lost."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from exposura.llm import minhash, secrets, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def edited(text, edits, tag=""):
    """The text with single words replaced, as far apart as they can be."""
    words = text.split()
    for k in range(edits):
        words[(2 * k + 1) * len(words) // (2 * edits)] = f"new{tag}x{k}"
    return " ".join(words)


def near_pairs():
    """Texts and their copies with similarities of 0.80 to 0.85."""
    rng = random.Random(11)
    bases = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(10**6)) for _ in range(1000)) for _ in range(6)]
    copies = [edited(b, n, k) for k, (b, n) in enumerate(zip(bases, (17, 18, 19, 20, 21, 22)))]
    assert all(0.8 <= similarity(b, c) < 0.85 for b, c in zip(bases, copies))
    return bases, copies


def test_pipeline_links_from_080_and_op2_from_085(spark):
    bases, copies = near_pairs()
    rows = [(k, t, "en", "a", len(t)) for k, t in enumerate(bases)] + [(100 + k, t, "en", "a", len(t)) for k, t in enumerate(copies)]
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()) == list(range(6))
    assert minhash.near_duplicates(df).where("kept").count() == 12


def test_bands_miss_few_pairs_at_any_threshold():
    assert minhash.banding((85, 100)) == (32, 6) and minhash.banding((80, 100)) == (38, 5)
    for percent in range(10, 100):
        bands, rows = minhash.banding((percent, 100))
        assert bands * rows <= minhash.SKETCH and (1 - (percent / 100) ** rows) ** bands <= minhash.MISSED


def test_dedup_stages_leave_one_row_of_repeats_and_null_ids(spark):
    bases, copies = near_pairs()
    copy, near = "The same short text", (bases[0], copies[0])
    rows = [(5, copy)] * 30 + [(None, copy.upper())] * 20 + [(4, copy), (4, "another text"), (None, "no id"), (None, "no id"), (None, None), (None, "")]
    rows += [(9, near[0])] * 4 + [(8, near[1])] * 3 + [(None, near[0])] * 2
    df = spark.createDataFrame([(i, t, "en", "a", k) for k, (i, t) in enumerate(rows)], DOCS).repartition(3)
    exact_rows = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_copies(spark, df, "").collect()]
    wanted = [(4, "another text"), (5, copy), (8, near[1]), (9, near[0]), (None, "no id")]
    assert sorted(exact_rows, key=str) in [sorted(wanted + [(None, t)], key=str) for t in (None, "")]
    for frame in (df, df.where("text IS NOT NULL AND text <> ''")):
        found = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, frame, "").collect()]
        worded = sorted(((i, (t or "").lower()) for i, t in found if t), key=str)
        assert worded == sorted([(4, copy.lower()), (4, "another text"), (8, near[1]), (None, "no id")], key=str)
    assert corpus_pipeline.drop_near_copies(spark, df, "").columns == df.columns == corpus_pipeline.drop_copies(spark, df, "").columns


def test_every_column_survives_a_rewrite(spark, tmp_path):
    docs = spark.range(300).selectExpr(
        "id AS key", "concat('text ', id, repeat('x', 50)) AS body", "CAST(id % 3 AS string) AS lang", "id * 2 AS size", "array(id) AS `a.b`",
        "CASE WHEN id % 2 = 0 THEN 'even' END AS old", "'r' AS row", "CAST(least(id % 5, 2) AS int) AS shard")
    docs.write.partitionBy("shard").parquet(f"{tmp_path}/old")
    listed = sharding.rewrite_affected(spark, f"{tmp_path}/old", f"{tmp_path}/new", 3, "key", "body").collect()
    assert any(r["rewritten"] for r in listed)
    columns = [c for c in docs.columns if c != "shard"]
    read = []
    for m in listed:
        part = spark.read.parquet(m["path"])
        assert part.columns == columns
        read += part.collect()
    assert sorted(map(tuple, read)) == sorted(map(tuple, docs.drop("shard").collect()))


def test_secrets_beside_a_marker_are_found():
    value = "Xk9v2Lq8Rt5Zw1Nb7Yc4HdJ"
    for text in (f"docs/sample/{value}", f"MY_SAMPLE_ID={value}", f"{value}-placeholder"):
        (span,) = secrets.scan(text)[1]
        assert value in text[span[0]:span[2]]
    rng = random.Random(3)
    long = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWYZabcdefghijkmnopqrstuvwyz23456789") for _ in range(4000))
    spans = secrets.scan(long[:2000] + "xxxx" + long[2000:])[1]
    assert sum(e - s for s, _, e in spans) > 3500
    assert secrets.scan("my_example_key_4f6T9")[1] == []


def test_marked_windows_equal_recount():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["x", "X", "xxxx", "sample", "0123456789", "abcdefgh", "Qw7", "e9R", "k2", "Zt"]) for _ in range(rng.randint(8, 25)))
        wanted = set()
        for s in range(len(text) - 19):
            if secrets.dense_runs(text[s:s + 20], 0, 20, 3.2) and not any(m in text[s:s + 20].lower() for m in ("xxxx", "sample", "0123456789", "abcdefgh")):
                wanted.update(range(s, s + 20))
        places = [m.span(1) for m in secrets.MARKED.finditer(text)]
        assert {k for s, e in secrets.dense_runs(text, 0, len(text), 3.2, marked=places) for k in range(s, e)} == wanted

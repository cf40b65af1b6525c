"""Nulls, empty and long texts, ties, repeats, empty tables and clashing columns for every operator."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from exposura.llm import bpe, exact, html, langid, minhash, mixing, quality, secrets, sharding, vectors

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, `row` int, `copies` int, score string"
LONG = "word " * 60_000 + "end"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "Same text here for all", "en", "a"), (2, "same TEXT here for all", "en", "a"), (3, None, None, None), (4, "", "en", None),
        (5, LONG, "en", "b"), (6, "   \t\n ", None, "b"), (7, "çà et là", "fr", "c"), (7, "çà et là", "fr", "c"), (8, "123 456", None, "a"),
        (None, "Same text here for all", "en", "a"), (None, None, None, None),
    ]
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4, "y") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def model():
    return quality.fit(quality.np.zeros((0, quality.WIDTH)), quality.np.zeros((0, quality.WIDTH)))


def operators(model):
    return {
        "reshard": lambda d: sharding.reshard(d).select("doc_id", "size", "shard", "slot"),
        "near": minhash.near_duplicates,
        "language": lambda d: langid.identify(d, langid.learn_profiles(d)),
        "secrets": secrets.find_secrets,
        "bpe": bpe.digests,
        "quality": lambda d: quality.score(d, model),
        "exact": exact.exact_groups,
        "mix": mixing.mix,
    }


@pytest.mark.parametrize("name", ["reshard", "near", "language", "secrets", "bpe", "quality", "exact", "mix"])
def test_one_row_per_row_and_none_for_none(name, docs, empty, model):
    run = operators(model)[name]
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in run(docs).collect())
    assert ids == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect())
    assert run(empty).collect() == []


def test_exact_groups(docs):
    rows = exact.exact_groups(docs).collect()
    by = {(r["doc_id"], r["group_size"]): r for r in rows}
    assert by[1, 3]["keep_id"] == by[2, 3]["keep_id"] == 2 and by[2, 3]["kept"] and not by[1, 3]["kept"]
    assert by[3, 3]["keep_id"] == 4 and not by[3, 3]["kept"]
    assert sorted(r["keep_id"] for r in rows if r["doc_id"] is None) == [2, 4] and not any(r["kept"] for r in rows if r["doc_id"] is None)
    assert sum(r["doc_id"] == 7 and r["kept"] and r["group_size"] == 2 for r in rows) == 2


def test_exact_groups_compares_texts_where_digests_clash(spark):
    rows = [(k, f"text {k % 40}") for k in range(3000)] + [(k, "hot") for k in range(3000, 6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = ["doc_id"]
    right = exact.exact_groups(df).orderBy(order).collect()
    for length in (0, 1):
        assert exact.exact_groups(df, key=lambda sha: F.substring(sha, 1, length)).orderBy(order).collect() == right
    assert all(r["group_size"] == (3000 if r["doc_id"] >= 3000 else 75) for r in right)
    plan = exact.exact_groups(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_near_edges(docs):
    rows = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert rows[2]["component_id"] == 1 and rows[1]["kept"] and not rows[2]["kept"]
    assert rows[3]["n_shingles"] == rows[4]["n_shingles"] == rows[6]["n_shingles"] == 0 and rows[3]["kept"] and rows[4]["kept"]
    assert rows[7]["n_shingles"] == 1 and rows[5]["n_shingles"] == 2 and rows[None]["component_id"] is None


def test_mix_edges(docs):
    rows = mixing.mix(docs).collect()
    total = sum(r["size"] for r in rows)
    per = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        per.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(target - taken) <= 0.5 for target, taken in per.values())
    assert sum(t for t, _ in per.values()) == pytest.approx(1.5 * total)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixed.count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]


def test_language_edges(docs):
    rows = {r["doc_id"]: r for r in langid.identify(docs, langid.learn_profiles(docs)).collect()}
    assert rows[3]["lang_pred"] == rows[4]["lang_pred"] == rows[8]["lang_pred"] == "und" and rows[7]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_pages_edges(spark):
    page = "<html><body><nav><a href=/>Menu</a></nav><article><h1>A &amp; B</h1><p>one<p>two\n  &eacute;</article><footer>f</footer>"
    rows = [(k, "u", page) for k in range(40)] + [(90, None, None), (91, "u", ""), (None, "u", page), (92, "u", "<p" + " x" * 50_000), (93, "u", "<nav>" + "<p>m " * 3000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, `text` string")
    found = html.extract(df, html.learn(df)).collect()
    by = {r["page_id"]: r for r in found}
    assert by[0]["text"] == by[None]["text"] == "A & B\none\ntwo é" and by[0]["n_chars"] == 15
    assert by[90]["text"] == by[91]["text"] == by[92]["text"] == "" and len(found) == len(rows)
    none = spark.createDataFrame([], df.schema)
    assert html.extract(none, html.learn(none)).collect() == []


def test_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.99, 0.01], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
        (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.0], None), (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1),
        (2, [1.0, 0.0], 1),
    ]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>, label int, n int, size int")
    found = vectors.vector_duplicates(df).collect()
    by = {r["vec_id"]: r for r in found}
    assert len(found) == len(rows)
    assert by[1]["n_links"] == by[2]["n_links"] == by[3]["n_links"] == 3 and by[3]["component_id"] == 1 and by[1]["kept"]
    assert all(by[k]["n_links"] == 0 and by[k]["kept"] and by[k]["component_id"] == k for k in (4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert vectors.vector_duplicates(spark.createDataFrame([], df.schema)).collect() == []


def test_pipeline_stages_on_edges(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (7, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    for name, frame in (("some", docs), ("none", empty)):
        folder = os.path.join(tmp_path, name)
        labels.write.parquet(f"{folder}/labels.parquet")
        rows = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, folder)
            assert out.columns == docs.columns
            path = os.path.join(tmp_path, name, f"out-{_}")
            out.write.parquet(path)
            rows = spark.read.schema(docs.schema).parquet(path)
        assert corpus_pipeline.encode(spark, rows, folder).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if name == "some":
            ids = [r["doc_id"] for r in rows.collect()]
            assert 1 not in ids and 2 in ids

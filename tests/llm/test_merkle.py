"""The manifest against a tree built level by level, versions and their sharing."""

import hashlib
import random
import zlib

from conftest import FOLDER
from exposura.llm import merkle, queries
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx int, G string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def item(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(r, text):
    return h(*map(item, (r[0], r[1], r[2], r[3], text)))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + arity]) for k in range(0, len(out[-1]), arity)])
    return out


def brute(rows, arity=3):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        trees[s] = levels([leaf_of(r, r[4]) for r in by_source[s]], arity)
    top = levels([trees[s][-1][0] for s in names], arity)
    out = []
    for at, s in enumerate(names):
        for k, r in enumerate(by_source[s]):
            leaf, beside = leaf_of(r, r[4]), []
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            up = leaf_of(r, r[4].replace("\n", "")) if even and r[4] is not None else leaf
            for tree, place in ((trees[s], k), (top, at)):
                for level in tree[:-1]:
                    run = level[place // arity * arity:place // arity * arity + arity]
                    beside += run[:place % arity] + run[place % arity + 1:]
                    run[place % arity] = up
                    up, place = h(*run), place // arity
            root = top[-1][0]
            out.append((r[0], leaf, trees[s][-1][0], root, h(*beside), up, up == root))
    return out


def proved(df, **settings):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(df, changed={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=even, **settings)


def rows_of(n, seed=1):
    rng = random.Random(seed)
    sources = [None, "", "a", "b", "é", "z", "Z"]
    rows = [(k, "hot" if rng.random() < 0.5 else rng.choice(sources), rng.choice([None, "en"]), k % 7 or None, rng.choice(["", None, "x\ny", "x", "é\n"]), 1, "g") for k in range(n)]
    return rows + rows[:9] + [(None, "a", None, None, None, 1, "g")] * 3 + [(5, "a", "en", 1, "other\n", 1, "g")]


def same(got, rows, arity=3):
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows, arity), key=repr)


def test_small_blocks_and_many_rounds(spark):
    rows = rows_of(300)
    same(proved(spark.createDataFrame(rows, SCHEMA).repartition(5), levels=1).collect(), rows)
    same(proved(spark.createDataFrame(rows, SCHEMA).repartition(2), levels=2).collect(), rows)


def test_default_blocks_over_one_hot_source(spark):
    rows = [(k, "hot", "en", 1, "x\n" if k % 5 else "x", 1, "g") for k in range(2500)]
    same(proved(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect(), rows)


def test_other_arity_single_rows_and_empty(spark):
    rows = rows_of(40, 3)
    same(proved(spark.createDataFrame(rows, SCHEMA), arity=2, levels=3).collect(), rows, 2)
    one = [(7, "only", "en", 3, "a\nb", 1, "g")]
    same(proved(spark.createDataFrame(one, SCHEMA)).collect(), one)
    each = [(k, f"s{k:03}", "en", 1, "a\n", 1, "g") for k in range(30)]
    same(proved(spark.createDataFrame(each, SCHEMA)).collect(), each)
    assert proved(spark.createDataFrame([], SCHEMA)).count() == 0


def test_versions_share_what_they_do_not_change():
    leaves = [h(str(k)) for k in range(60)]
    tree = merkle.grown(leaves, 4)

    def nodes(node):
        return {id(node): node} | {k: v for kid in node.kids for k, v in nodes(kid).items()}

    old = nodes(tree)
    for k in (0, 26, 27, 59):
        new = merkle.version(tree, k, h("new"), 4)
        fresh = [n for i, n in nodes(new).items() if i not in old]
        assert len(fresh) == 5
        assert new.digest == merkle.grown([*leaves[:k], h("new"), *leaves[k + 1:]], 4).digest
    assert nodes(tree).keys() == old.keys()


def test_registered_query_against_sql(spark, duck):
    got = queries.queries()["op12_merkle"](spark, FOLDER)
    want = duck.execute(queries.oracles()["op12_merkle"])
    assert sorted(got.columns) == sorted(d[0] for d in want.description)
    names = [d[0] for d in want.description]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want.fetchall())
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    same(got.collect(), [tuple(r) for r in docs.collect()])

"""Exact and near duplicates, and near vectors, against all pairs on small tables."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldkit.llm import embedding_dedup, exact_dedup, simhash
from fieldkit.llm.components import component_roots, local_roots

DOCS = "doc_id bigint, text string, key string, row_key int"
RUNS = re.compile(r"[\x20\x09-\x0D]+")


def components(nodes, links):
    """The smallest node that links reach from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def frame(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t, "x", 1) for i, t in enumerate(texts)], DOCS)


TEXTS = [None, "", " ", "\n \t", "a b", "a  b", "a\tb", "a b ", " a b", "A b", "a b", "a\xa0b",
         "é  é", "é\n\né", "x" * 100_000, "x" * 100_000 + " ", *["copy of  a line"] * 300,
         *["copy of\ta line"] * 200]


@pytest.mark.parametrize("bucket_keys,few_keys", [(16_384, 1_000_000), (2, 0)])
def test_exact_groups(spark, bucket_keys, few_keys):
    texts = TEXTS + [f"text {i % 70}" for i in range(200)]
    docs = frame(spark, texts).repartition(5)
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[RUNS.sub(" ", t or "")].append(i)
    got = {r.doc_id: r for r in exact_dedup.exact_groups(
        docs, bucket_keys=bucket_keys, few_keys=few_keys).collect()}
    assert len(got) == len(texts)
    for same in groups.values():
        for i in same:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (
                same[0], len(same), i == same[0])


def test_exact_sql_agrees(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = [tuple(r) for r in exact_dedup.exact_groups(docs).select(columns).collect()]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({exact_dedup.exact_sql()})").fetchall()
    assert sorted(got) == sorted(want)


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("key"))
    skewed = keys.union(spark.range(400).select((F.col("id") + (5 << 55)).alias("key")))
    index = exact_dedup.build_index(skewed, bucket_keys=200)
    held = index.groupBy("depth", "bucket").count().collect()
    deepest = max(r.depth for r in held)
    assert sum(r["count"] for r in held) == 3400 and deepest > min(r.depth for r in held)
    assert all(r["count"] <= 200 for r in held) and deepest > 50
    wrong = index.filter("depth > 0 AND bucket <> shiftrightunsigned(key, 64 - depth)")
    assert wrong.isEmpty()


def test_chains_tell_texts_of_one_key_apart(spark):
    """Texts with forced equal keys are compared byte by byte in their owner's order."""
    texts = ["b", "a", "b", "c", "a", "b"] * 50 + ["alone"]
    rows = spark.createDataFrame([(i, 7 if t != "alone" else 9, t) for i, t in enumerate(texts)],
                                 "doc_id bigint, key bigint, text string").repartition(6)
    index = exact_dedup.build_index(rows)
    got = sorted(tuple(r)[1:] for r in exact_dedup.chains(rows, index).collect())
    want = sorted((hashlib.sha256(t.encode()).hexdigest(), texts.count(t), texts.index(t))
                  for t in "abc")
    assert [(d, n, i) for d, n, i in got] == want
    # The index routes the texts: without it there is no chain.
    assert exact_dedup.chains(rows, index.limit(0)).collect() == []
    cells = exact_dedup.directory(rows.select("key").distinct(), 2, 1)
    assert exact_dedup.in_buckets(rows.select("key").distinct(), cells).count() == 2
    assert exact_dedup.in_buckets(rows.select("key"), cells.limit(0)).collect() == []


def test_exact_survivors_of_repeated_rows(spark):
    rows = [(1, "a"), (1, "a"), (2, "a "), (3, "b"), (3, "c"), (None, "d"), (None, "d"), (4, None)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    got = sorted(map(repr, (tuple(r)[:2] for r in exact_dedup.exact_survivors(docs).collect())))
    assert got == sorted(map(repr, [(1, "a"), (2, "a "), (3, "b"), (3, "c"), (None, "d"),
                                    (4, None)]))
    assert exact_dedup.exact_survivors(docs).columns == docs.columns
    assert exact_dedup.exact_survivors(docs.limit(0)).collect() == []


def brute_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = ([" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
                or [" ".join(words)])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(seed=7):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = [None, "", "\n", "One", "one two", "ONE Two", "é ß Ä", "x " * 40_000]
    for _ in range(60):
        base = rng.choices(words, k=rng.randint(200, 800))
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    base = rng.choices(words, k=400)
    texts += [" ".join([*base[:i], "z", *base[i:]]) for i in range(150)]
    return texts + ["same text in many rows"] * 300


@pytest.mark.parametrize("tile_rows", [2048, 4])
def test_near_groups_equal_all_pairs(spark, tile_rows):
    texts = near_texts()
    prints = [brute_print(t) for t in texts]
    links = [(i, j) for j in range(len(texts)) for i in range(j)
             if (prints[i] ^ prints[j]).bit_count() <= 2]
    want = components(range(len(texts)), links)
    got = simhash.near_groups(frame(spark, texts).repartition(5), tile_rows=tile_rows).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == want[r.doc_id]


def test_near_edges_of_close_numbers(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-2**63, 2**63 - 1, 30)
    close = [int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 63, (9, 2))]
    prints = sorted({int(b) for b in base} | set(close) | {0, -1, 1, -2**63})
    want = components(prints, [
        (a, b) for j, b in enumerate(prints) for a in prints[:j]
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2])
    frame_ = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    for radius_tile in (2048, 3):
        edges = simhash.near_edges(frame_, 2, radius_tile).collect()
        assert components(prints, [(r.a, r.b) for r in edges]) == want


def test_near_survivors_and_empty_tables(spark):
    docs = frame(spark, ["one two three four", "One Two three four", None, "", "five six seven"], 5)
    kept = simhash.near_survivors(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 7, 9]
    empty = docs.limit(0)
    assert simhash.near_groups(empty).collect() == []
    nulls = spark.createDataFrame([(None, "a b c", "x", 1), (3, "a b c", "x", 1)], DOCS)
    assert {r.component_id for r in simhash.near_groups(nulls).collect()} == {3}


def test_one_row_of_each_near_group_stays_whatever_its_id(spark):
    def kept(rows):
        docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
        return sorted((tuple(r)[:2] for r in simhash.near_survivors(docs).collect()), key=repr)

    assert kept([(1, "a b c"), (None, "a b c"), (None, "x y z")]) == [(1, "a b c"), (None, "x y z")]
    assert kept([(3, "p q r"), (4, "p q r"), (4, "k l m"), (5, "k l m")]) == [
        (3, "p q r"), (4, "k l m")]
    assert kept([(None, "a b"), (None, "A b"), (2, "u v"), (2, "u v"), (2, "u  v")])[1:] in (
        [(None, "a b")], [(None, "A b")])
    assert len(kept([(None, "same text here")] * 40 + [(6, "other words")] * 3)) == 2


def test_components_of_paths_stars_and_cliques(spark):
    rng = random.Random(9)
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(300)]
    clique = [(2000 + i, 2000 + j) for j in range(20) for i in range(j)]
    links = path + star + clique + [(5, 5), (7, 6), (6, 7)]
    rng.shuffle(links)
    nodes = {n for link in links for n in link}
    want = components(nodes, links)
    edges = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")
    got = {r.a: r.b for r in component_roots(edges).collect()}
    assert got == {n: r for n, r in want.items() if n != r}
    assert component_roots(edges.limit(0)).collect() == []
    a, b = local_roots(*(np.array(x) for x in zip(*links, strict=True)))
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == got


VECTORS = "vec_id bigint, embedding array<float>, label int, bucket int"


def vector_rows(n=400, d=20, cosine=0.94, seed=10):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.normal(size=d)
        rows.append(x)
        for _ in range(i % 4):
            y = rng.normal(size=d)
            y -= x * (x @ y) / (x @ x)
            y *= np.linalg.norm(x) / np.linalg.norm(y)
            c = rng.uniform(cosine - 0.03, 1.0)
            rows.append((c * x + np.sqrt(1 - c * c) * y) * rng.uniform(0.1, 9))
    rows += [rows[3]] * 200
    rows = np.array(rows, dtype=np.float32)
    labels = [None if i % 97 == 0 else i % 3 // 2 for i in range(len(rows))]
    return [(i, [float(v) for v in x], k, 1) for i, (x, k) in enumerate(zip(rows, labels, strict=True))]


ODD = [(5001, None, 1, 1), (5002, [0.0] * 20, 1, 1), (5003, [1.0, None], 1, 1),
       (5004, [float("nan")] * 20, 1, 1), (5005, [float("inf")] + [1.0] * 19, 1, 1),
       (5006, [], 1, 1), (5007, [1.0] * 20, None, 1), (5008, [1.0] * 20, 1, 1),
       (5009, [2.0] * 20, 1, 1), (5010, [1.0] * 19, 1, 1), (5011, [1e-30] * 20, 1, 1),
       (None, [3.0] * 20, 1, 1), (5008, [1.0] * 20, 1, 1)]


@pytest.mark.parametrize("tile_rows", [2048, 16])
def test_near_vectors_against_all_pairs(spark, tile_rows):
    rows = vector_rows()
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([-1 if r[2] is None else r[2] for r in rows])
    linked = (x @ x.T >= 0.93) & (labels[:, None] == labels[None]) & (labels >= 0)[:, None]
    np.fill_diagonal(linked, False)
    docs = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(docs, tile_rows=tile_rows).collect()}
    assert len(got) == len(rows)
    links = np.array([got[i].n_links for i in range(len(rows))])
    assert (links <= linked.sum(axis=1)).all()
    assert links.sum() >= 0.97 * linked.sum()
    found = defaultdict(set)
    for i, r in got.items():
        found[r.component_id].add(i)
        assert r.kept == (i == r.component_id)
    want = components(range(len(rows)), np.argwhere(np.triu(linked)).tolist())
    for root, members in found.items():
        assert root == min(members) and len({want[m] for m in members}) == 1
    assert len(found) <= 1.02 * len(set(want.values()))


@pytest.mark.parametrize("dim", [16, 64, 256])
@pytest.mark.parametrize("rows", [10_000, 10**7, 10**9])
def test_pairs_at_the_threshold_are_found_at_any_size(dim, rows):
    plan = embedding_dedup.bucket_plan(rows, dim, 0.93)
    rng = np.random.default_rng(12)
    x, z = embedding_dedup.unit(rng.normal(size=(600, dim))), rng.normal(size=(600, dim))
    z = embedding_dedup.unit(z - x * (x * z).sum(axis=1, keepdims=True))
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z
    a, b = (embedding_dedup.signatures(v, *plan, embedding_dedup.SEED) for v in (x, y))
    entries = plan.tables * (plan.hashes + 1)
    assert a.shape == (600, entries) and all(len(set(row)) == entries for row in a.tolist())
    assert np.mean([len(np.intersect1d(i, j)) > 0 for i, j in zip(a, b, strict=True)]) >= 0.95
    # Vectors of no group: those that meet in a bucket grow with the rows, not with their square.
    assert rows * (plan.hashes + 1) / (2 * dim) ** plan.hashes <= embedding_dedup.BUCKET_LOAD


def test_more_hashes_lose_no_more_links(spark):
    rows = [r for r in vector_rows(d=32) if r[2] is not None][:700]
    docs = spark.createDataFrame(rows, VECTORS)
    x = embedding_dedup.unit(np.array([r[1] for r in rows], dtype=np.float32))
    labels = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.93) & (labels[:, None] == labels[None])
    np.fill_diagonal(linked, False)
    assert embedding_dedup.bucket_plan(700, 32, 0.93, load=1).hashes > 1
    for load in (1, 0.01):
        got = {r.vec_id: r.n_links for r in embedding_dedup.near_vectors(
            docs, bucket_load=load).collect()}
        found = np.array([got[r[0]] for r in rows])
        assert (found <= linked.sum(axis=1)).all() and found.sum() >= 0.95 * linked.sum()
    assert embedding_dedup.bucket_plan(700, 32, 0.93, load=0.01).hashes >= 3


def test_odd_vectors_link_with_nothing(spark):
    docs = spark.createDataFrame(ODD, VECTORS)
    rows = embedding_dedup.near_vectors(docs).collect()
    assert len(rows) == len(ODD)
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows}
    for i in (5001, 5002, 5003, 5004, 5005, 5006, 5007, 5010):
        assert got[i] == (0, i)
    for i in (5008, 5009, 5011, None):
        assert got[i] == (4, 5008)
    assert embedding_dedup.near_vectors(docs.limit(0)).collect() == []


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(11).normal(size=(5, 16))
    turned = embedding_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embedding_dedup.hadamard(turned), x)

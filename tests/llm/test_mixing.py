"""Mixing sources by Pareto order sampling, and the audit of filters, against SQL and plain Python."""

import random
from collections import defaultdict
from itertools import permutations
from urllib.parse import urlparse

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldkit.llm import filter_audit, source_mix
from fieldkit.llm.queries import QUERIES
from fieldkit.session import settle
from tests.compare import connect, differences

DOCS = "doc_id bigint, text string, source string, n int, part string, size string, draw string"


def rows_of(spark, rows):
    """Documents with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(*row, 1, "p", "s", "d") for row in rows], DOCS)


def in_duckdb(sql, docs, labels=()):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    for name, rows in (("documents", docs), ("labels", labels)):
        for row in rows:
            con.execute(f"INSERT INTO {name} VALUES (?, ?, ?)", row)
    answer = con.execute(sql)
    return [d[0] for d in answer.description], answer.fetchall()


def odd_documents(seed):
    rng = random.Random(seed)
    words = "a B c1 the of # $x ÉÉ 日本 ABCDE x".split()
    docs = [(i, " ".join(rng.choices(words, k=int(rng.paretovariate(0.7)) % 300)),
             rng.choice(["s1", "s2", "s2", "s2", "", None])) for i in range(120)]
    docs += [(None, "a b", "s1")] * 5 + [(7, "x y z", "s2")] * 30 + [(None, None, None), (8, "", "")]
    docs += [(200, "w " * 4000, "s3"), (201, "", "empty"), (202, None, "empty"), (90, "x y z", "s1")]
    return docs


@pytest.mark.parametrize("name", ["op11_source_mix", "op13_filter_audit"])
def test_query_equals_its_sql(spark, folder, name):
    assert differences(QUERIES[name], spark, folder, connect(folder)) == []


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("few_rows", [0, 1000])
def test_mix_equals_sql_with_nulls_ties_and_copies(spark, seed, few_rows):
    docs = odd_documents(seed)
    names, want = in_duckdb(source_mix.mix_sql(), docs)
    got = source_mix.mix_sources(rows_of(spark, docs), few_rows=few_rows).select(names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_targets_fill_up_to_the_caps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), (None, 0)],
                                  "source string, source_size bigint")
    got = {r.source: r.target for r in source_mix.source_targets(sizes).collect()}
    assert got == {"a": 30.0, "b": 960.0, "c": 30.0, None: 0.0}


def test_taken_words_are_near_the_target_and_reruns_agree(spark):
    rng = random.Random(5)
    docs = rows_of(spark, [(i, "w " * rng.randint(1, 400), f"s{i % 7}") for i in range(2000)])
    mixed = source_mix.mix_sources(docs)
    rows = mixed.collect()
    taken, targets = defaultdict(int), {}
    for row in rows:
        assert 0 <= row.copies <= 3 and row.taken == row.copies * row["size"]
        taken[row.source] += row.taken
        targets[row.source] = row.target
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 20
    again = source_mix.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_long_documents_are_sampled_in_proportion_to_their_size(spark):
    """Over many draws each document's share of samples follows its inclusion chance."""
    times, rows = defaultdict(int), []
    for run in range(60):
        rows += [(run * 100 + i, f"{run} {i} " + "w " * (i % 10 * 8), f"r{run}") for i in range(40)]
    docs = rows_of(spark, rows)
    sizes = docs.groupBy("source").agg(F.sum(source_mix.word_count("text")).alias("source_size"))
    targets = source_mix.source_targets(sizes, weights=(1,))
    assert targets.filter("abs(target - source_size) > 1").isEmpty()
    mixed = source_mix.mix_sources(docs, weights=(2, 3))
    for row in mixed.filter("target < source_size").collect():
        times[row["size"] > 40] += row.copies
    n = mixed.filter("target < source_size").count()
    assert times[True] + times[False] < n
    assert times[True] > 1.2 * times[False]


def test_mix_of_an_empty_table_and_of_empty_texts(spark):
    assert source_mix.mix_sources(rows_of(spark, [])).collect() == []
    got = source_mix.mix_sources(rows_of(spark, [(1, None, None), (2, " \t", "a")])).collect()
    assert sorted((r.doc_id, r["size"], r.target, r.taken) for r in got) == [(1, 0, 0.0, 0),
                                                                          (2, 0, 0.0, 0)]


def plain_audit(docs, labels):
    """Every order by hand, one document after another."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    failed = []
    for doc_id, text, source in docs:
        text = text or ""
        words = text.encode().split()
        failed.append((source or "", doc_id, {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and doc_id > first[text]}))
    found, shapley = {}, defaultdict(int)
    for part in {f[0] for f in failed}:
        for order in permutations("ABCDE"):
            there = [f for f in failed if f[0] == part]
            gone = []
            for step, own in enumerate(order, 1):
                removed = [f for f in there if f[2][own]]
                there = [f for f in there if not f[2][own]]
                redundant = sum(f[2][own] for f in gone)
                gone += removed
                shapley[part, own] += len(removed)
                unique = sum(f[0] == part and f[2][own] and sum(f[2].values()) == 1 for f in failed)
                found[part, "".join(order), step] = (
                    len(there), len(removed), redundant, unique,
                    sum(f[1] in good for f in removed), sum(f[1] in toxic for f in removed))
    return {key: (*value, shapley[key[0], key[1][key[2] - 1]]) for key, value in found.items()}


@pytest.mark.parametrize("sizes", [(1 << 24, 250_000, 1 << 26), (200, 250_000, 500), (1, 1, 50)])
def test_audit_equals_every_order_by_hand(spark, monkeypatch, sizes):
    for name, size in zip(("SHARD_CHARS", "SHARD_WORDS", "BUCKET_BYTES"), sizes, strict=True):
        monkeypatch.setattr(filter_audit, name, size)
    docs = odd_documents(3)
    labels = [(i, i % 2, i % 3) for i in range(60)] + [(5, 1, 1), (5, None, 0), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit_filters(rows_of(spark, docs), frame).collect()
    want = plain_audit(docs, labels)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == want
    names, rows = in_duckdb(filter_audit.audit_sql(), docs, labels)
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(rows)


def test_dictionary_numbers_every_word_once_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_CHARS", 30)
    texts = ["a b c a", "b d", None, "e " * 20, "c a f g", "", "h"]
    docs = spark.createDataFrame([(i, "p", t) for i, t in enumerate(texts)],
                                 "doc_id bigint, part string, text string").fillna({"text": ""})
    shards = filter_audit.local_shards(docs.coalesce(2), 3).cache()
    numbers = {}
    columns = {r.shard: r["columns"] for r in filter_audit.word_numbers(shards).collect()}
    for row in shards.collect():
        words = [w for bucket in row.buckets for w in bucket.words]
        for word, number in zip(words, columns.get(row.shard, []), strict=True):
            assert numbers.setdefault(word, number) == number
    assert sorted(numbers.values()) == list(range(8))
    matrix = filter_audit.term_matrix(shards, filter_audit.word_numbers(shards)).collect()
    held = {}
    for row in matrix:
        for i, doc in enumerate(row["rows"]):
            cut = slice(row.indptr[i], row.indptr[i + 1])
            held[doc.doc_id] = dict(zip(row.indices[cut], row.data[cut], strict=True))
    for i, text in enumerate(texts):
        words = (text or "").split()
        assert held[i] == {numbers[w]: words.count(w) for w in words}
    # The dictionary decides: without it no row has an entry.
    none = filter_audit.term_matrix(shards, filter_audit.word_numbers(shards).limit(0))
    assert {r.different for r in filter_audit.row_sums(none).collect()} == {0}


def test_a_large_shard_comes_in_rows_and_row_groups_of_bounded_size(spark):
    docs = [(i, "p", " ".join(f"w{(i * 37 + j) % 5000}" for j in range(200))) for i in range(3000)]
    docs += [(3000, "p", " ".join(f"x{j}" for j in range(40_000)) + " x1"), (3001, "p", "")]
    frame = spark.createDataFrame(docs, "doc_id bigint, part string, text string").coalesce(1)
    shards = settle(filter_audit.local_shards(frame, 3), "shards", **filter_audit._SMALL_GROUPS)
    rows = shards.collect()
    assert len({r.shard for r in rows}) == 1 and sum(bool(r.buckets) for r in rows) == 1
    assert all(len(r["indices"]) <= filter_audit.STRIP_ENTRIES or len(r["rows"]) == 1 for r in rows)
    assert sum(len(r["indices"]) for r in rows) == 3000 * 200 + 40_000
    files = [pq.ParquetFile(urlparse(f).path) for f in shards.inputFiles()]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert len(groups) > 1 and max(g.total_byte_size for g in groups) < 1 << 22
    numbers = filter_audit.word_numbers(shards)
    assert [len(r["columns"]) for r in numbers.collect()] == [45_000]
    sums = filter_audit.row_sums(filter_audit.term_matrix(shards, numbers)).collect()
    assert {r.row.doc_id: (r.words, r.different) for r in sums} == {
        **{i: (200, 200) for i in range(3000)}, 3000: (40_001, 40_000), 3001: (0, 0)}


def test_arrow_batches_are_small_only_while_the_audit_runs(spark):
    key = filter_audit._ARROW_BYTES
    before = spark.conf.get(key)
    with filter_audit.small_batches(spark):
        assert spark.conf.get(key) == str(filter_audit.BATCH_BYTES)
    assert spark.conf.get(key) == before
    spark.conf.set(key, "1000")
    try:
        with filter_audit.small_batches(spark):
            assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.set(key, before)


def test_audit_of_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit_filters(rows_of(spark, []), labels).collect() == []
    got = filter_audit.audit_filters(rows_of(spark, [(1, "x", None)]), labels)
    assert got.count() == 600 and {r.part for r in got.collect()} == {""}

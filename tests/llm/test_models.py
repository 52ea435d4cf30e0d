"""Quality, language, the pipeline and the registered queries."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldkit.llm import language_id, quality
from fieldkit.llm.queries import QUERIES
from fieldkit.session import new_path
from tests.llm import brute
from tests.llm.test_duplicates import brute_print, components

BIGGER = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.97 * n > 100


def test_language_edges(spark):
    schema = "doc_id bigint, text string, lang string, grams int"
    rows = [(i, t, g, 1) for i, (t, g) in enumerate([
        ("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20)]
    odd = [(100, None, "en", 1), (101, "", "en", 1), (102, "123 !?", None, 1), (None, "the cat", None, 1),
           (None, "the cat", None, 1), (103, "日本語", None, 1), (104, "the " * 20_000, None, 1)]
    got = {r.doc_id: r for r in language_id.identify(
        spark.createDataFrame(rows + odd, schema)).collect()}
    for i in (100, 101, 102):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[104].lang_pred == got[None].lang_pred == "en" and got[None].held_out is False
    assert 0.0 <= got[103].score <= 1.0
    nothing = spark.createDataFrame(odd, schema).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(nothing).collect()} == {"und"}
    assert language_id.identify(spark.createDataFrame([], schema)).collect() == []


def test_nothing_is_learned_from_held_out_documents(spark):
    docs = spark.range(200).select(
        F.col("id").alias("doc_id"), F.when(language_id.held_out("id"), "secretword")
        .otherwise("plain").alias("text"), F.lit("en").alias("lang"))
    grams = {r.gram for r in language_id.gram_counts(docs, "doc_id", "text", "lang").collect()}
    keys = [set(language_id.grams_of([w])[0].view(np.int64).tolist())
            for w in ("plain", "secretword")]
    assert keys[0] == grams and not keys[1] & grams


def plain_grams(word):
    parts = [f" {word[i:i + language_id.MAX_WORD]} " for i in range(0, len(word),
                                                                 language_id.MAX_WORD)]
    return [p[i:i + n] for n in language_id.GRAM_SIZES for p in parts
            for i in range(len(p) - n + 1)]


def test_grams_are_the_windows_of_marked_words():
    words = ["a", "ab", "katze", "日本語", "x" * 95, "é" * 40, "zz"]
    keys, owner = language_id.grams_of(words)
    names = {}
    for i, word in enumerate(words):
        want = plain_grams(word)
        got = keys[owner == i].tolist()
        assert len(got) == len(want)
        # Different n-grams have different keys, and equal ones the same.
        counts = sorted(got.count(k) for k in set(got))
        assert counts == sorted(want.count(g) for g in set(want))
        if len(word) == 1:
            names.update(zip(got, want, strict=True))
    assert len(set(keys.tolist())) == len({g for w in words for g in plain_grams(w)})
    assert [len(a) for a in language_id.grams_of([])] == [0, 0]


def test_false_finds_are_taken_out():
    """A language whose filter is half full by chance, and one whose filter is full."""
    n = 10_000
    totals = np.array([[n, n // 2 + 100, 3 * n // 4, n], [0, 0, 0, 0], [4, 0, 0, 4]])
    names, share = language_id.best(totals, ["aa", "bb", "cc"], np.array([0.5, 0.01, 1.0]))
    assert names[:2] == ["bb", "und"] and share[0] == pytest.approx((0.75 - 0.01) / 0.99)
    assert names[2] == "aa" and share[2] == 0.0  # ties go to the first; a full filter tells nothing
    assert np.isfinite(share).all()


def invented(rng, letters, words):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(words)]


def learned(count, start=0):
    """Ids of documents that may be learned from, and of held-out ones."""
    ids = range(start, start + 8 * count + 80)
    free = [i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2]
    return free[:count], [i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2][:count]


DOCS = "doc_id bigint, text string, lang string"


def test_a_language_of_two_short_documents_is_found(spark):
    rng = random.Random(3)
    big = {lang: invented(rng, letters, 600) for lang, letters in (
        ("en", "etaoinshrdlu"), ("de", "enisratdhulc"))}
    free, _ = learned(802)
    _, held = learned(40, 100_000)
    rows = [(i, " ".join(rng.choices(big[lang], k=60)), lang)
            for i, lang in zip(free, ["en", "de"] * 400, strict=False)]
    rare = ["zuzen etxe kafkak", "goizean zakur txikia"]
    rows += [(i, text, "eu") for i, text in zip(free[800:], rare, strict=True)]
    tests = [(held[0], rare[0], None), (held[1], rare[1], None), (held[2], "etxe txikia", None)]
    tests += [(i, " ".join(rng.choices(big[lang], k=20)), lang) for i, lang in
              zip(held[3:], ["en", "de"] * 10, strict=False)]
    got = {r.doc_id: r for r in language_id.identify(
        spark.createDataFrame(rows + tests, DOCS)).collect()}
    assert all(got[i].held_out for i, _, _ in tests)
    assert [got[i].lang_pred for i in held[:3]] == ["eu"] * 3
    assert [got[i].lang_pred for i in free[800:]] == ["eu"] * 2
    right = [got[i].lang_pred == lang for i, _, lang in rows[:800] + tests[3:]]
    assert sum(right) >= 0.97 * len(right)


@pytest.mark.parametrize("slice_bytes", [1 << 27, 40_000])
def test_many_languages_and_slices(spark, monkeypatch, slice_bytes):
    """91 languages, two words of 64 bits a position; a filter in slices decides the same."""
    monkeypatch.setattr(language_id, "SLICE_BYTES", slice_bytes)
    rng = random.Random(4)
    free, _ = learned(91 * 4)
    rows = [(i, " ".join(invented(rng, [chr(0x4E00 + 12 * (n % 91) + j) for j in range(9)], 12)),
             f"l{n % 91:02}") for n, i in enumerate(free)]
    rows += [(None, rows[5][1], None), (None, None, None), (-1, "?", None), (free[0], rows[0][1], None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    model = language_id.learn(docs)
    assert len(model.languages) == 91 and (model.slices > 1) == (slice_bytes < 1 << 20)
    got = sorted((repr(tuple(r)) for r in language_id.predict(docs, model).collect()))
    assert len(got) == len(rows)
    named = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert all(named[i] == lang for i, _, lang in rows[:364]) and named[-1] == "und"
    monkeypatch.setattr(language_id, "SLICE_BYTES", 1 << 27)
    whole = language_id.learn(docs)
    same = language_id.predict(docs, whole).select("doc_id", "held_out", "lang_pred").collect()
    mine = language_id.predict(docs, model).select("doc_id", "held_out", "lang_pred").collect()
    assert sorted(map(repr, same)) == sorted(map(repr, mine))


def test_masks_hold_all_members_and_few_others(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    counts = defaultdict(lambda: defaultdict(int))
    for row in rows:
        if row.lang and row.text and zlib.crc32(str(row.doc_id).encode()) % 4 != 2:
            for word in language_id.words_of(row.text):
                counts[row.lang][word] += 1
    grams, total = defaultdict(dict), {}
    for lang, words in counts.items():
        own = defaultdict(int)
        for word, n in words.items():
            for gram in plain_grams(word):
                own[gram] += n
        total[lang] = sum(own.values())
        for gram, n in own.items():
            grams[gram][lang] = n
    model = language_id.learn(docs)
    assert model.languages == sorted(counts)
    names, keys = list(grams), []
    for gram in names:  # a key of a gram by itself, through a word that holds it
        key = np.full(1, len(gram), np.uint64)
        for c in gram:
            key = language_id.mixed(key + np.uint64(ord(c)))
        keys.append(key[0])
    decider = language_id.Decider(language_id.filter_slice(model, 0), model.positions, 0, 1,
                                  len(model.languages))
    masks = decider.masks(np.array(keys))[:, 0]
    extra = others = 0
    for gram, mask in zip(names, masks.tolist(), strict=True):
        sure = max(n / (total[lang] + language_id.DOUBT) for lang, n in grams[gram].items())
        for bit, lang in enumerate(model.languages):
            n = grams[gram].get(lang, 0)
            inside = n > 0 and n / total[lang] >= language_id.MIN_SHARE * sure
            held = bool(mask >> bit & 1)
            assert held or not inside
            extra, others = extra + (held and not inside), others + (not inside)
    assert extra <= 1.3 * language_id.FALSE_RATE * others
    assert (model.false_rate <= 1.1 * language_id.FALSE_RATE).all()


def test_quality_of_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id % 2 = 0")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    test = F.xxhash64("doc_id", F.lit("t")) % 3 == 0
    model = quality.learn(docs, labels.filter(~test), max_labelled=1200, max_pool=800)
    got = quality.score_documents(docs, model).join(labels.filter(test), "doc_id")
    kept, good, bad, n = got.agg(
        F.expr("count_if(kept AND quality = 1)"), F.expr("count_if(quality = 1)"),
        F.expr("count_if(NOT kept AND quality = 0)"), F.count("*")).first()
    assert kept >= 0.98 * good and bad >= 0.9 * (n - good) > 30


def test_pseudo_labels_teach_the_other_view():
    rng = np.random.default_rng(12)
    y = (rng.random(3000) < 0.6).astype(float)
    views = [np.column_stack([np.ones(len(y)), y[:, None] * 2 + rng.normal(size=(len(y), 5))])
             for _ in range(2)]
    first = np.arange(len(y)) < 40
    model = quality.co_train([v[first] for v in views], y[first], [v[~first] for v in views],
                             np.arange(40) % 4 == 0)
    p = quality.combined(model, [v[~first] for v in views])
    assert ((p > 0.5) == y[~first]).mean() > 0.95


def test_unlabelled_documents_of_any_hash_teach(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 2 == 0, "sound plain prose of the usual kind " * 4)
        .otherwise("@@## 0x91 %% zz qq ~~ 77 || " * 4).alias("text"))
    labels = docs.filter("doc_id < 400").select("doc_id", (1 - F.col("doc_id") % 2).alias("quality"))
    last = docs.filter("doc_id >= 400 AND doc_id % 2 = 1").orderBy(
        F.xxhash64("doc_id").desc()).limit(100).select("doc_id", F.lit("rare").alias("source"))
    docs = docs.join(F.broadcast(last), "doc_id", "left").fillna("usual", ["source"])
    page = quality.learn(docs, labels).views[1]
    rare, unseen = (page.inside(quality.metadata_features(b"x" * 1000, [name, "en"])[None])
                    @ page.weights[1:] for name in ("rare", "unseen"))
    assert rare < unseen - 0.2


def test_a_round_takes_its_share_of_the_surest(spark):
    counts = np.bincount([5] * 10 + [9] * 4 + [7] * 6, minlength=quality.SURE_BINS)
    assert quality._least(counts, 7) == (7, 0.5) and quality._least(counts, 20) == (0, 1.0)
    assert quality._least(counts, 4) == (9, 1.0) and quality._least(counts * 0, 1) == (0, 1.0)
    rows = [(i / 9, np.full(3, i, "<f2").tobytes(), np.full(2, i, "<f4").tobytes())
            for i in range(9)]
    pool = spark.createDataFrame(rows, "tie double, text binary, page binary")
    assert quality._total_over(pool, (3, 2))(quality._moments).tolist() == [
        9, *[36] * 2, *[204] * 2, 36, 204]
    assert quality._total_over(pool.limit(0), (3, 2))(quality._moments).sum() == 0


def test_quality_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, 0.5), (None, "", "s", "en", 0.5), (2, "a", "s", None, 0.5)] * 2,
        "doc_id bigint, text string, source string, lang string, quality_score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 0), (3, None)],
                                   "doc_id bigint, quality int")
    model = quality.learn(docs, labels)
    assert model.views == () and model.prior == 1.0
    assert [r.kept for r in quality.score_documents(docs, model).collect()] == [True] * 6
    assert quality.good_documents(docs, model).columns == docs.columns
    empty = docs.limit(0)
    assert quality.score_documents(empty, quality.learn(empty, labels.limit(0))).collect() == []


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = spark.read.parquet(f"{BIGGER}/documents.parquet").withColumn("row", F.lit(1)), []
    for _, stage in corpus_pipeline.STAGES:
        path = f"{spark.conf.get('spark.checkpoint.dir', '/tmp')}/stage-{id(docs)}-{len(found)}"
        stage(spark, docs, BIGGER).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs)
    return found


def test_stages_keep_columns_and_follow_plain_versions(spark, stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars", "row"]
    assert all(s.columns == columns for s in stages[:-1])
    good, exact, near, masked = ({r.doc_id: r for r in s.collect()} for s in stages[:-1])
    first = {}
    for i in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", good[i].text), i)
    assert set(exact) == set(first.values())
    prints = {i: brute_print(r.text) for i, r in exact.items()}
    links = [(a, b) for b in prints for a in prints if a < b
             and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert set(near) == set(components(prints, links).values())
    assert set(masked) == set(near)
    for i, r in masked.items():
        if not brute.spans(near[i].text, brute.PII_KINDS):
            assert r.text == near[i].text or "<context>" in r.text
        else:
            assert "<" in r.text and r.n_chars == len(r.text)
    packed = defaultdict(int)
    for r in stages[-1].collect():
        packed[r.sequence_id] += r.length
    assert max(packed.values()) <= corpus_pipeline.SEQUENCE_TOKENS
    assert {r.doc_id for r in stages[-1].select("doc_id").distinct().collect()} == set(masked)


def test_run_gives_the_stages_result(spark, stages):
    got = corpus_pipeline.run(spark, BIGGER).select("doc_id", "piece", "length", "ids_crc32")
    want = stages[-1].select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_odd_documents_pass_all_stages(spark, folder):
    """Nulls, repeated rows and a very long text, beside columns of names the operators use."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, None, None, None, None), (900001, "", "en", "s", 0),
         (900002, "one row twice over", "en", None, 18), (900002, "one row twice over", "en", None, 18),
         (900003, "word and word " * 40000, None, "s", 560000), (None, "text without id", "de", "s", 15)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    both = docs.unionByName(odd.select(*[F.col(c).cast(docs.schema[c].dataType) for c in docs.columns]))
    both = both.withColumns({n: F.lit("x") for n in ("class", "hash", "row_key", "piece", "kept")})
    rows, held = both.count(), both.columns
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        path = new_path(spark, f"odd-{name}")
        stage(spark, both, folder).write.parquet(path)
        both = spark.read.parquet(path)
        assert both.columns == held and 0 < both.count() <= rows
        rows = both.count()
        if name == "exact_dedup":
            assert both.filter("doc_id = 900002").count() == 1
            assert both.filter("coalesce(text, '') = ''").count() <= 1
            assert both.filter("doc_id = 900003").first()["text"] == "word and word " * 40000
    packed = corpus_pipeline.STAGES[-1][1](spark, both, folder)
    assert packed.filter("piece = 0").count() == rows
    scored = corpus_pipeline.STAGES[0][1](spark, odd.withColumn("class", F.lit("x")), folder)
    assert scored.columns == [*odd.columns, "class"] and scored.count() <= odd.count()


def test_empty_documents_pass_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_give_a_row_per_document(spark, folder, name):
    n = QUERIES[name].run(spark, folder).count()
    table, key = (("embeddings", "vec_id") if name.startswith("op6") else ("documents", "doc_id"))
    rows = spark.read.parquet(f"{folder}/{table}.parquet").count()
    assert n == rows or name.startswith("op7") and n > rows


def native(name):
    return name.split("_")[0] in ("op2", "op3", "op4")


@pytest.mark.parametrize("name", [n for n in QUERIES if native(n)])
def test_native_queries_have_no_python(spark, folder, name):
    plan = QUERIES[name].run(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)

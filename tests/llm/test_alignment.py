"""Alignment of two tokenizers against the libraries on whole texts and interval arithmetic."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldkit.llm import alignment
from tests.llm.test_tokens import EDGES, random_texts

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


def plain_alignment(rows):
    """The query's columns from whole texts, token by token."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    signs = alignment.byte_of_sign()
    words = {i: w for w, i in tokenizer.get_vocab().items()}
    found, counts = [], Counter()
    for doc_id, text in rows:
        a = tokenizer.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        a_bytes = [bytes(signs[c] for c in words[i]) for i in a]
        b_bytes = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
                   else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        a_ends, b_ends = (np.cumsum([len(w) for w in side]).tolist() for side in (a_bytes, b_bytes))
        links = []
        for i, (start, end) in enumerate(zip([0, *a_ends], a_ends, strict=False)):
            for j in range(bisect_left(b_ends, start + 1), bisect_left(b_ends, end) + 1):
                links.append((a[i], b[j]))
        common = sorted({*a_ends} & {*b_ends})
        sides = defaultdict(lambda: ([], []))
        for side, (ids, ends) in enumerate(((a, a_ends), (b, b_ends))):
            for token, end in zip(ids, ends, strict=True):
                sides[bisect_left(common, end)][side].append(str(token))
        groups = ";".join("|".join(",".join(s) for s in sides[g]) for g in range(len(common)))
        counts.update(set(links))
        found.append((doc_id, len(a), len(b), len(common), links,
                      hashlib.sha256(groups.encode()).hexdigest()))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return [(doc_id, n_a, n_b, n_groups, len(links),
             sum(counts[link] == top[link[0]] for link in links),
             sum(counts[link] for link in links), digest)
            for doc_id, n_a, n_b, n_groups, links, digest in found]


@pytest.fixture(scope="module")
def rows():
    odd = ["x▁y", "<s> a </s> <unk> <0x41>", "é́ ① ﬁ 日本語 テスト", "\x00 a", "a b", "   ",
           "ends here \n \n  ", "don't  we'll\n\n. , a,b.c", "日" * 3000, "ab12" * 4000]
    texts = EDGES + odd + random_texts(600, 9)
    return [*enumerate(texts), (None, "a b c"), (None, "a b c"), (3, "the the"), (3, "the the")]


@pytest.mark.parametrize("known", [20, 1_000_000])
def test_alignment_equals_whole_texts_by_hand(spark, rows, known):
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows],
                                 "doc_id bigint, text string, pair int, groups string")
    got = alignment.audit_alignment(docs.repartition(3), A, B, known=known).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain_alignment(rows), key=repr)


def test_alignment_of_the_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = alignment.audit_alignment(docs, A, B).collect()
    want = plain_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got)) == sorted(want)


def test_galloping_finds_the_places_of_bisection():
    rng = random.Random(1)
    for _ in range(300):
        ends = sorted(rng.sample(range(200), rng.randint(1, 60)))
        numbers = sorted(rng.sample(range(ends[-1] + 1), rng.randint(1, min(20, ends[-1] + 1))))
        low = [rng.randint(0, bisect_left(ends, n)) for n in numbers]
        got = alignment.gallop(np.array(numbers), np.array(low), np.array(ends))
        assert got.tolist() == [bisect_left(ends, n) for n in numbers]


def test_groups_and_pairs_spell_what_the_counts_say(spark):
    docs = spark.createDataFrame([(1, "unbelievable tokenization"), (2, None)],
                                 "doc_id bigint, text string")
    size = alignment.vocabulary_sizes(A, B)[1]
    one, two = sorted(alignment.align_texts(docs, A, B).collect())
    groups = [g.split("|") for g in one.groups.split(";")]
    assert sum(len(a.split(",")) for a, _ in groups) == one.n_a
    assert sum(len(b.split(",")) for _, b in groups) == one.n_b
    assert len(groups) == one.n_groups and sum(one.times) == one.n_links
    in_groups = {int(x) for a, _ in groups for x in a.split(",")}
    assert {pair // size for pair in one.pairs} == in_groups
    assert (two.n_a, two.groups, two.pairs, two.times) == (0, "", [], [])


def test_alignment_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.audit_alignment(docs, A, B).collect() == []

from __future__ import annotations

import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, with_clashes
from tidewater.llm.token_count import Counter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return Counter(PATH)


def test_random_texts_match_the_library(library, counter):
    rng = random.Random(11)
    parts = [*"abcAZÉéß'tΣσςİ 12٣½\x1c\x1f\x85\xa0 ​\n\t\r.,!?<|>_-—日本한🙂́\x00﻿",
             "<|endoftext|>", "<|endoftext", "'re", "'LL", "aaaa", " the", "   ", "ing ", "tion", "1234"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 18))) for _ in range(6000)]
    for text, got in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert counter.count(text) == len(got.ids), repr(text)


def test_heap_order_is_rank_then_place():
    c = Counter.__new__(Counter)
    dict.__init__(c)
    c.merges = {(97, 97): (0, 256), (256, 97): (1, 257), (97, 98): (2, 258)}
    assert c.merged(b"aaa") == 2          # aa a -> aaa
    assert c.merged(b"aaaa") == 2         # aa aa, which do not join
    assert c.merged(b"aab") == 1          # aa b: the merge of a and b came too late
    assert c.merged(b"") == c.merged(b"a") == c.merged(b"bb") == 0


def test_long_words_cost_n_log_n(library, counter):
    rng = random.Random(5)
    for word in ("a" * 300_000, "".join(rng.choice("etaoin") for _ in range(300_000)), " " * 300_000):
        began = time.time()
        n = counter.count(word)
        assert time.time() - began < 20 and n == len(library.encode(word, add_special_tokens=False).ids)


def test_query_over_nulls_repeats_and_long_texts(spark, library):
    texts = {1: "The cat's <|endoftext|> 123", 2: None, 3: "", 4: "the" * 50_000 + " xé " * 400_000,
             5: " a" * 512, 6: " a" * 513}
    rows = [*texts.items(), (1, texts[1])]
    df = with_clashes(documents(spark, rows), "n_bytes", "n_tokens", "over_limit")
    got = token_counts(df, PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)
    assert token_counts(documents(spark, []), PATH).count() == 0


def test_whole_given_table(spark, library):
    from tests.llm.helpers import SMALL
    from tidewater.llm.queries import op11_token_count
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = op11_token_count(spark, SMALL).collect()
    assert len(got) == len(text)
    for r in got:
        assert r["n_tokens"] == len(library.encode(text[r["doc_id"]], add_special_tokens=False).ids)

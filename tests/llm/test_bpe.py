from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import documents, with_clashes
from tidewater.llm.bpe import Automaton, compile_merges, tokenize
from tidewater.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def automaton():
    return Automaton(tokenizer_path())


def test_gadgets_follow_merge_order():
    right, left, rank = compile_merges([("a", "a"), ("b", "a")])
    a = object.__new__(Automaton)
    a.right, a.left, a.rank, a.arcs = right, left, rank, {}
    assert a.arc("aa", "a") and a.arc("aa", "aa") and not a.arc("a", "a") and not a.arc("a", "aa")
    assert not a.arc("b", "a") and a.arc("b", "aa") and not a.arc("ba", "a") is True


def test_random_texts_match_the_library(library, automaton):
    rng = random.Random(3)
    parts = [*"abcAZÉéß'tΣσςİ 12٣½\x1c\x85\u2003\n\t.,!?<|>_-—日本한🙂\u0301\x00\ufeff", "<|endoftext|>",
             "<|startoftext|>", "'re", "'LL", "aaaa", "the", "A\u030a", "ing ", "tion"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        ids = library.encode(text, add_special_tokens=False).ids
        got = automaton.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert automaton.decode(got).decode() == library.decode(ids, skip_special_tokens=False)


def test_query_over_nulls_repeats_and_long_texts(spark, library):
    texts = {1: "The cat's <|endoftext|> 123", 2: None, 3: "", 4: "the" * 50_000 + " x " * 20_000}
    rows = [*texts.items(), (1, texts[1])]
    df = with_clashes(documents(spark, rows), "ids", "n_tokens")
    got = tokenize(df, tokenizer_path()).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]).decode() == library.decode(ids, skip_special_tokens=False)
    assert tokenize(documents(spark, []), tokenizer_path()).count() == 0

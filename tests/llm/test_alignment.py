from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import SMALL, documents, with_clashes
from tidewater.llm import alignment
from tidewater.llm.alignment import align, count, groups, highest, records, spill
from tidewater.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), alignment.tokenizers(A, B)


def brute(texts, libraries):
    """Row by row, in the words of the contract."""
    lib_a, lib_b, table = libraries
    links, shapes = [], []
    for text in texts:
        a = lib_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = lib_b.encode(text) if text else []
        spelled = [b"".join(table.bytes_a[i] for i in a), b"".join(table.bytes_b[i] for i in b)]
        if not text or spelled != [(" " + text).encode()] * 2:
            links.append([])
            shapes.append((0, 0, 0, ""))
            continue
        spans = []
        for ids, spell in ((a, table.bytes_a), (b, table.bytes_b)):
            at, side = 0, []
            for i in ids:
                side.append((at, at + len(spell[i]), i))
                at += len(spell[i])
            spans.append(side)
        found, k = [], 0
        for s, e, i in spans[0]:
            while spans[1][k][1] <= s:
                k += 1
            m = k
            while m < len(spans[1]) and spans[1][m][0] < e:
                found.append((i, spans[1][m][2]))
                m += 1
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        parts, start, pa, pb = [], 0, 0, 0
        for end in ends:
            ga, gb = [], []
            while pa < len(spans[0]) and spans[0][pa][1] <= end:
                ga.append(str(spans[0][pa][2]))
                pa += 1
            while pb < len(spans[1]) and spans[1][pb][1] <= end:
                gb.append(str(spans[1][pb][2]))
                pb += 1
            parts.append(",".join(ga) + "|" + ",".join(gb))
        links.append(found)
        shapes.append((len(a), len(b), len(ends), hashlib.sha256(";".join(parts).encode()).hexdigest()))
    counts = Counter(p for found in links for p in set(found))
    top: dict = {}
    for (i, _), n in counts.items():
        top[i] = max(n, top.get(i, 0))
    return [(s[0], s[1], s[2], len(f), sum(counts[p] == top[p[0]] for p in f), sum(counts[p] for p in f), s[3])
            for s, f in zip(shapes, links, strict=True)]


def rows_of(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, *[r[c] for c in NAMES]) for r in df.collect())


def want(rows, libraries):
    return sorted((i is not None, i or 0, *b) for (i, _), b in
                  zip(rows, brute([t for _, t in rows], libraries), strict=True))


ODD = ["", None, "a", " ", "  two  spaces ", "日本語 héllo wörld", "▁already", "<|endoftext|> <s> <0x41> <unk>",
       "tab\tnew\nline\r\n", "\x00 nul", "🙂🙂", "é", "'re you'LL 1234567", "x" * 3000, " " * 6000 + "z"]


def texts(n, seed):
    rng = random.Random(seed)
    words = ["the", "cat", "unbelievable", "naïve", "42", "3.14", "it's", "日本", "tokenizers", "\n", "  ", "Ω"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("piece", [None, 64])
def test_matches_brute_force(spark, libraries, piece):
    rows = [*enumerate(ODD + texts(80, 1)), (3, "a"), (3, "a"), (None, "the cat")]
    df = with_clashes(documents(spark, rows, parts=5), "chunk", "radix", "n_a", "payload")
    assert rows_of(align(df, A, B, piece=piece)) == want(rows, libraries)


def test_many_chunks_and_a_hot_id(spark, libraries):
    rows = list(enumerate(["a a a a a b"] * 60 + texts(40, 2)))
    assert rows_of(align(documents(spark, rows, parts=20), A, B, piece=200)) == want(rows, libraries)


def test_long_text_and_empty_table(spark, libraries):
    rows = [(1, " ".join(texts(600, 3)) + "q" * 200_000), (2, "q q"), (3, None)]
    assert rows_of(align(documents(spark, rows), A, B)) == want(rows, libraries)
    assert align(documents(spark, []), A, B).count() == 0
    assert rows_of(align(documents(spark, [(1, None), (2, "")]), A, B)) == want([(1, None), (2, "")], libraries)


def test_runs_keep_their_records():
    rng = np.random.default_rng(5)
    pairs, docs = rng.integers(0, 3000, 20_000), rng.integers(0, 500, 20_000)
    side = (pairs // 7) % 4
    keys = (side.astype(np.uint64) << np.uint64(48)) | (pairs.astype(np.uint64) << np.uint64(16)) | docs.astype(np.uint64)
    got = Counter()
    for _, head, body in spill(keys.copy(), 4):
        p, sizes = groups(head)
        d, links = records(body, sizes)
        assert (np.diff(p) > 0).all()
        for x, y, n in zip(np.repeat(p, sizes).tolist(), d.tolist(), links.tolist(), strict=True):
            got[x, y] += n
    assert got == Counter(zip(pairs.tolist(), docs.tolist(), strict=True))


def test_heap_merge_counts_and_maxima():
    rng = np.random.default_rng(6)
    runs, want_ = [], Counter()
    for _ in range(9):
        p = np.unique(rng.integers(0, 400, 100))
        n = rng.integers(1, 9, len(p))
        runs.append((p, n))
        want_.update(dict(zip(p.tolist(), n.tolist(), strict=True)))
    pairs, counts = count(runs)
    assert dict(zip(pairs.tolist(), counts.tolist(), strict=True)) == want_ and (np.diff(pairs) > 0).all()
    best = highest(pairs, counts, 20)
    for p, c, b in zip(pairs.tolist(), counts.tolist(), best.tolist(), strict=True):
        assert b == (c == max(n for q, n in want_.items() if q // 20 == p // 20))


def test_given_table(spark, libraries):
    from tidewater.llm.queries import op13_alignment
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows_of(op13_alignment(spark, SMALL)) == want(rows, libraries)

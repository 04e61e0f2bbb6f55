from __future__ import annotations

import random
import time

from tests.llm.helpers import decontam_brute, documents, with_clashes, words
from tidewater.llm import decontam
from tidewater.llm.decontam import scan

ITEM = "item_id long, text string"


def check(spark, docs, items, parts=3):
    want = decontam_brute(docs, [x for x in items if x[1] is not None])
    bench = with_clashes(spark.createDataFrame(items, ITEM), "id", "block")
    got = scan(with_clashes(documents(spark, docs, parts=parts), "item_ids", "_covered", "words"), bench).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["item_ids"], r["n_words"]) == want[r["doc_id"]], r
        assert r["contaminated"] == bool(r["item_ids"])
    return want


def test_substitutions_and_positions_match_brute_force(spark):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng.randint(3, 40), k))) for k in range(25)] + [(90, None), (91, ""), (92, "...")]
    docs = []
    for k in range(60):
        w = items[k % 25][1].split()
        for _ in range(k % 6):
            w[rng.randrange(len(w))] = f"sub{rng.random()}"
        part = w[rng.randint(0, 3):] if k % 4 else w
        docs.append((k, " ".join([*words(k % 7 * 5, 100 + k), *part, *words(6, 200 + k)]).title()))
    docs += [(100, None), (101, ""), (102, items[3][1]), (103, (items[3][1] + " ") * 50)]
    want = check(spark, docs, items)
    assert 20 < sum(bool(v[0]) for v in want.values()) < 64


def test_any_two_substitutions_in_a_window_are_found(spark):
    item = [f"w{k}" for k in range(13)]
    docs = [(a * 13 + b, " ".join("x" if k in (a, b) else w for k, w in enumerate(item)))
            for a in range(13) for b in range(a, 13)]
    got = scan(documents(spark, docs), spark.createDataFrame([(1, " ".join(item))], ITEM)).collect()
    assert all(r["contaminated"] for r in got)
    three = [(1, " ".join("x" if k < 3 else w for k, w in enumerate(item)))]
    assert not scan(documents(spark, three), spark.createDataFrame([(1, " ".join(item))], ITEM)).first()["contaminated"]


def test_short_items(spark):
    items = [(1, "the"), (2, "of the"), (3, "a b c"), (4, "one two three four five"), (5, "k l m n o p q r s t u v")]
    docs = [(1, "the of the " * 3), (2, "a b c"), (3, "a x c"), (4, "one two x four five"), (5, "x two y four five"),
            (6, "k x m n o y q r s t u v"), (7, "k x m n o y q z s t u v"), (8, "one two three four x")]
    got = {r["doc_id"]: r["item_ids"] for r in scan(documents(spark, docs), spark.createDataFrame(items, ITEM)).collect()}
    assert got == {1: [], 2: [3], 3: [], 4: [4], 5: [], 6: [5], 7: [], 8: [4]}


def test_common_words_of_short_items_make_no_hits():
    index = decontam.Index.build([1, 2, 3], [b"the", b"the of", b"the cat of"])
    assert not list(index.hits(decontam.words_of(b"the of " * 50_000)))


def test_repeated_items_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 200)
    item = " ".join(words(20, 1))
    bench = spark.createDataFrame([(7, item)] * 300, ITEM)
    assert len(decontam.blocks_of(bench, "item_id", "text")) == 1
    text = " ".join(words(1000, 2)) + " "
    rows = [(1, text * 700 + item), (2, text * 100)]  # 5 MB
    start = time.time()
    got = {r["doc_id"]: r["item_ids"] for r in scan(documents(spark, rows), bench).collect()}
    assert got == {1: [7], 2: []} and time.time() - start < 30


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 200)
    items = [(k, " ".join(words(20, k))) for k in range(12)]
    check(spark, [(k, items[k % 12][1] + " x " + items[(k + 5) % 12][1]) for k in range(30)], items)


def test_empty_tables_and_repeats(spark):
    none = spark.createDataFrame([], ITEM)
    docs = [(1, "a b c"), (1, "a b c")]
    assert [r["contaminated"] for r in scan(documents(spark, docs), none).collect()] == [False, False]
    item = spark.createDataFrame([(7, "a b c")], ITEM)
    assert [r["item_ids"] for r in scan(documents(spark, docs), item).collect()] == [[7], [7]]
    assert scan(documents(spark, []), item).count() == 0

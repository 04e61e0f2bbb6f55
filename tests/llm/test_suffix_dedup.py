from __future__ import annotations

import random

from tests.llm.helpers import documents, suffix_brute, with_clashes, words
from tidewater.llm.suffix_dedup import MANY, dedup


def check(spark, rows, parts=4):
    want = suffix_brute(rows)
    got = dedup(with_clashes(documents(spark, rows, parts=parts), "th", "spans", "kind", "kept")).collect()
    assert len(got) == len(rows)
    for r in got:
        n, removed, runs, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["starts"]), bytes(r["kept"])) == (
            n, removed, runs, kept), r["doc_id"]
    return want


def test_shared_passages_copies_and_edits(spark):
    rng = random.Random(8)
    base = [" ".join(words(120, k)) for k in range(12)]
    rows = []
    for k in range(80):
        parts = [rng.choice(base) for _ in range(3)]
        cut = [p[rng.randint(0, 200):rng.randint(201, 700)] for p in parts]
        text = " ".join([*words(10, 1000 + k), *cut])
        if k % 3 == 0:
            at = rng.randint(0, len(text) - 1)
            text = text[:at] + "#" + text[at + 1:]
        rows.append((rng.randint(0, 10**12), text))
    want = check(spark, rows, parts=7)
    assert sum(v[1] for v in want.values()) > 10_000


def test_one_passage_with_many_tails_takes_the_hot_way(spark):
    passage = " ".join(words(40, 1))
    rows = [(k, passage + "".join(random.Random(k).choice("abcdef") for _ in range(80)))
            for k in range(3 * MANY)]
    rows += [(1000 + k, passage + "".join(random.Random(k).choice("abcdef") for _ in range(60)) + "!")
             for k in range(5)]
    check(spark, rows, parts=2)


def test_short_empty_null_periodic_and_long_texts(spark):
    rows = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 49), (5, "x" * 50), (6, "x" * 5000), (7, "ab" * 3000),
            (8, "é" * 25), (9, "é" * 40), (10, "z" + " ".join(words(60_000, 4))), (11, " ".join(words(60_000, 4))),
            (-5, "ab" * 30)]
    check(spark, rows)


def test_repeated_and_null_ids(spark):
    t = " ".join(words(50, 2))
    other = " ".join(words(50, 3))
    rows = [(1, t), (1, t), (1, other), (2, t), (2, other + "!"), (None, t), (None, t)]
    got = sorted(((r["doc_id"] or -1, r["n_bytes"], len(r["kept"])) for r in dedup(documents(spark, rows)).collect()))
    a, b = len(t.encode()), len(other.encode())
    assert got == sorted([(1, a, a), (1, a, a), (1, b, b), (2, a, 0), (2, b + 1, 1), (-1, a, a), (-1, a, a)])


def test_whole_characters(spark):
    t = "é" * 40
    rows = [(1, "a" + t), (2, "b" + t), (3, "è" + t)]
    got = {r["doc_id"]: bytes(r["kept"]).decode() for r in dedup(documents(spark, rows), characters=True).collect()}
    assert got == {1: "a" + t, 2: "b", 3: ""} or got == {1: "a" + t, 2: "b", 3: "è"}


def test_empty_table(spark):
    assert dedup(documents(spark, [])).count() == 0

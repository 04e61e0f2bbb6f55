from __future__ import annotations

import random

import numpy as np

from tests.llm.helpers import components_brute, documents, with_clashes, words
from tidewater.llm.minhash import (CHUNKS, WIDTH, components, keys_of, near_duplicates, offers, shingles,
                                   symbols_of, word_hashes)


def check(spark, rows, n, parts=4):
    want = components_brute(rows, n)
    df = with_clashes(documents(spark, rows, parts=parts), "id", "keys", "comp", "set")
    got = near_duplicates(df, words=n).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["component_id"] == r["doc_id"])
    return want


def edited(text, k, every):
    rng = random.Random(k)
    w = text.split()
    for at in range(rng.randint(0, every), len(w), every):
        w[at] = f"edit{k}"
    return " ".join(w)


def test_copies_near_copies_and_chains_match_brute_force(spark):
    rows, k = [], 0
    for g in range(8):
        base = " ".join(words(150, g))
        for every in (400, 90, 60, 45, 30, 25, 20):
            rows.append((k * 7 % 1009, edited(base, k, every)))
            k += 1
        chain = base
        for step in range(6):  # neighbours link, the ends do not
            chain = edited(chain, 900 + step, 70)
            rows.append((2000 + k, chain))
            k += 1
        rows += [(3000 + k + j, base) for j in range(4)]
        k += 4
    want = check(spark, rows, 4, parts=6)
    assert 8 <= len({c for _, c in want.values()}) < len(rows) - 30


def test_a_third_of_all_rows_in_one_group(spark):
    base = " ".join(words(60, 1))
    rows = [(k, edited(base, k, 55)) for k in range(150)] + [(200 + k, " ".join(words(40, 50 + k))) for k in range(300)]
    check(spark, rows, 4, parts=3)


def test_nulls_short_texts_ties_and_case(spark):
    check(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "oNE\x0btwo"), (6, "one two three"),
                  (7, "É a b c"), (8, "é a b c"), (9, "a b"), (10, "a b"), (-3, "A b"),
                  (11, "w " * 40_000), (12, "w")], 4)


def test_repeated_and_null_ids(spark):
    a, b = " ".join(words(30, 1)), " ".join(words(30, 2))
    rows = [(1, a), (5, a), (5, b), (9, b), (9, b), (None, a), (None, None)]
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(documents(spark, rows)).collect()}
    assert got == {(1, 1, True), (5, 1, False), (9, 1, False), (None, None, True)}


def test_empty_table_and_no_links(spark):
    assert near_duplicates(documents(spark, [])).count() == 0
    assert [r["kept"] for r in near_duplicates(documents(spark, [(1, "a b c d e f")])).collect()] == [True]


def test_keys_find_signatures_with_one_error_per_chunk():
    s = shingles(" ".join(words(300, 9)).encode(), 4)
    symbols = symbols_of(s)
    keys = keys_of(symbols)
    assert len(np.unique(keys)) == CHUNKS * WIDTH
    for at in range(WIDTH):
        other = symbols.copy()
        other[at::WIDTH] ^= np.uint64(5)  # one symbol of every chunk
        same = (keys_of(other) == keys).reshape(CHUNKS, WIDTH)
        assert same[:, at].all() and same.sum() == CHUNKS


def test_long_words_and_pieces_hash_alike():
    long = b"x" * (3 << 20)
    h = word_hashes(b"a " + long + b" b " + long + b" c")
    assert len(h) == 5 and h[1] == h[3] and len(set(h.tolist())) == 4


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(64)] + [(100, 101)], "a long, b long")
    got = {r["id"]: r["comp"] for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(65)}, 100: 100, 101: 100}


def test_front_places_find_every_pair_at_the_threshold():
    """Random sets around a hub: a pair at 0.8, one of it not linked with the
    hub, meets on a shingle that both offer to the other's step."""
    rng = random.Random(8)
    met = 0
    for _ in range(20_000):
        hub = set(range(rng.randint(5, 300)))
        lost = rng.sample(sorted(hub), rng.randint(0, len(hub) // 4))
        new = range(1000, 1000 + rng.randint(0, len(hub) // 4))
        x, y = [(hub - set(lost) | set(new)) ^ set(rng.sample(sorted(hub), rng.randint(0, len(hub) // 9)))
                ^ set(rng.sample(range(900, 1100), rng.randint(0, 8))) for _ in range(2)]
        linked = [100 * len(a & b) >= 80 * len(a | b) for a, b in ((x, y), (x, hub), (y, hub))]
        if not linked[0] or linked[1] and linked[2] or hub in (x, y):
            continue
        met += 1
        rank = {t: rng.random() for t in x ^ hub | y ^ hub}
        front = []
        for a, b in ((x, y), (y, x)):
            step = offers(len(b), len(b ^ hub), len(hub), 80)[0]
            places = dict(offers(len(a), len(a ^ hub), len(hub), 80)[1])[step]
            front.append(set(sorted(a ^ hub, key=rank.get)[:places]))
        assert front[0] & front[1]
    assert met > 300


def test_own_edits_below_the_threshold_of_the_source_make_few_pairs(spark, monkeypatch):
    """A quarter of a group lies below 0.8 of its source, by edits of its own:
    the rest round makes no pair of these with one another or the group."""
    from tidewater.llm import minhash
    base = " ".join(words(160, 3))
    rows = [(1000, base)] + [(k, edited(base, k, 50 if k % 4 else 14)) for k in range(400)]
    made, rest = [], minhash.rest_pairs

    def counted(*a):
        out = rest(*a)
        made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "rest_pairs", counted)
    check(spark, rows, 4, parts=6)
    assert made and max(made) < 400

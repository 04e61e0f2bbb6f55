from __future__ import annotations

import random
import re
import time

from tests.llm.helpers import LOWER, documents, with_clashes
from tidewater.llm.license_scan import BASE, all_templates, scan


def brute(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    starts, labels, score = [], set(), 0.0
    for label, base, key, context in all_templates():
        at = [p for p in range(-9, len(w)) if all(0 <= p + o < len(w) and w[p + o] == x for x, o in key)]
        starts += at if base else []
        labels |= {label} if at else set()
        for p in at:
            near = sum(0 <= p + o < len(w) and w[p + o] == x for x, o in context)
            score = max(score, (near + len(key)) / (len(key) + len(context)))
    base = {b for _, b in BASE}
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(labels & base)), ",".join(sorted(labels)), score)


TEXTS = [
    None, "", "   ", "All rights RESERVED. all rights reserved", "cc by cc by cc by-nc 4.0",
    "Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3", "general public licence",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "rights all reserved",
    "É all\nrights\treserved\x00x", "word " * 30_000 + "cc by", "\u212a cc by", "reserved", "by cc by"]


def test_matches_brute_force_on_ties_nulls_and_long_texts(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    df = with_clashes(documents(spark, rows), "words", "toks", "score", "w")
    got = scan(df).drop("places").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == brute(TEXTS[r["doc_id"]]), r


def test_random_templates_match_brute_force(spark):
    rng = random.Random(11)
    bag = sorted({w for *_, key, context in all_templates() for w, _ in key + context}) + ["x", "the"]
    phrases = [" ".join(w for w, _ in sorted(key + context, key=lambda x: x[1])) for *_, key, context in all_templates()]
    texts = [" ".join(rng.choice([rng.choice(bag), rng.choice(phrases)]) for _ in range(rng.randint(1, 60)))
             for _ in range(300)]
    for r in scan(documents(spark, list(enumerate(texts)))).drop("places").collect():
        assert tuple(r)[1:] == brute(texts[r["doc_id"]]), r


def test_a_long_text_that_repeats_a_template(spark):
    text = "gnu general public license version " * 60_000  # 2 MB
    began = time.time()
    (r,) = scan(documents(spark, [(1, text)])).drop("places").collect()
    assert time.time() - began < 60 and tuple(r)[1:] == brute(text)


def test_context_raises_the_score_and_places_are_verified(spark):
    rows = [(1, "x licensed under the apache license version 2.0"), (2, "apache license")]
    got = {r["doc_id"]: r for r in scan(documents(spark, rows)).collect()}
    assert got[1]["score"] > got[2]["score"] > 0
    assert [tuple(p) for p in got[2]["places"]] == [("apache-2.0", 0)]


def test_empty_table(spark):
    assert scan(documents(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = scan(documents(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

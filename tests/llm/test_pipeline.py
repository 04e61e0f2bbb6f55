from __future__ import annotations

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.helpers import (DOCS, components_brute, decontam_brute, documents, suffix_brute, with_clashes, words)
from tidewater.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of small tables with cases planted in documents."""
    sf = tmp_path_factory.mktemp("sf")
    texts = [" ".join(words(60, k)) for k in range(60)]
    for k in range(0, 60, 4):
        w = texts[k].split()
        w[10], w[30] = "idiot", "scum"
        texts[k] = " ".join(w)
    item = " ".join(words(25, 777))
    texts[5] += " " + item  # leaked passage
    texts[9] = texts[9] + " " + item.replace(item.split()[7], "other", 1)
    passage = " ".join(words(70, 888))
    texts += [texts[1], texts[1] + " more", texts[2]]  # copies and a near copy
    texts += [" ".join(words(150, 300 + k)) + " " + passage for k in range(3)]
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(texts)]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(60)], "doc_id long, toxic int").write.parquet(
        f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return str(sf), rows, item


def test_every_stage_against_brute_force(spark, tables):
    sf, rows, item = tables
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(P.STAGES) == 5
    for k, (_, stage) in enumerate(P.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = P.pinned(stage(spark, with_clashes(docs, "score", "id", "spans", "ids"), sf))
        after = {r["doc_id"]: r["text"] for r in docs.collect()} if k < 4 else None
        if k < 4:
            assert docs.columns == P.COLUMNS
        if k == 0:
            assert set(before) - set(after) == set(range(0, 60, 4))
        elif k == 1:
            want = components_brute(before.items(), 5)
            assert set(after) == {i for i in before if want[i][1] == i}
        elif k == 2:
            want = suffix_brute(before.items())
            assert {i: t or "" for i, t in after.items()} == {i: want[i][3].decode() for i in before}
            assert any(v[1] for v in want.values())
        elif k == 3:
            want = decontam_brute(before.items(), [(1, item)])
            assert set(after) == {i for i in before if not want[i][0]} and len(after) < len(before)
        else:
            library = Tokenizer.from_file(tokenizer_path())
            for r in docs.collect():
                ids = library.encode(before[r["doc_id"]] or "", add_special_tokens=False).ids
                assert np.frombuffer(r["ids"], "<u4").tolist() == ids
                text = library.decode(ids, skip_special_tokens=False)
                assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_run_equals_its_stages(spark, tables):
    sf, rows, _ = tables
    got = P.run(spark, sf)
    assert got.columns[:2] == ["doc_id", "n_tokens"] and P.ORACLE_SQL is None
    assert {100, 101} <= {r["doc_id"] for r in got.select("doc_id").collect()}


def test_stages_on_empty_and_repeated_rows(spark, tables):
    sf, rows, _ = tables
    empty = documents(spark, [], DOCS)
    twice = documents(spark, [rows[1], rows[1], (None, "x y", None, None, 3)], DOCS)
    for k, (_, stage) in enumerate(P.STAGES):
        assert stage(spark, empty, sf).count() == 0
        assert stage(spark, twice, sf).count() == 3

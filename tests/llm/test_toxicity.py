from __future__ import annotations

import zlib

import numpy as np
import pytest

from tests.llm.helpers import documents, with_clashes, words
from tidewater.llm.toxicity import Model, emissions, fit, fit_model, in_fold, marginals, score


def plain_marginals(model, ev, first):
    e = np.exp(emissions(ev) @ model.emit)
    move = np.exp(model.move)
    out = []
    starts = [*np.flatnonzero(first).tolist(), len(ev)]
    for a, z in zip(starts[:-1], starts[1:], strict=True):
        f = [np.array([1, e[a]])]
        for t in range(a + 1, z):
            f.append((f[-1] @ move) * [1, e[t]])
            f[-1] = f[-1] / f[-1].sum()
        b = [np.ones(2)]
        for t in range(z - 1, a, -1):
            b.append(move @ (b[-1] * [1, e[t]]))
            b[-1] = b[-1] / b[-1].sum()
        out += [(x * y)[1] / (x * y).sum() for x, y in zip(f, b[::-1], strict=True)]
    return np.array(out)


@pytest.mark.parametrize("n", [1, 127, 128, 129, 1000])
def test_marginals_equal_plain_forward_backward(n):
    rng = np.random.default_rng(n)
    model = Model(emit=np.array([-2, 1, 0.5]), move=rng.normal(size=(2, 2)))
    ev, first = rng.random(n) * 3, rng.random(n) < 0.03
    first[0] = True
    assert np.abs(marginals(model, ev, first) - plain_marginals(model, ev, first)).max() < 1e-9


def corpus(n, seed=0):
    rows, labels = [], []
    for k in range(n):
        w = words(40, seed + k)
        toxic = k % 3 == 0
        if toxic:
            w[5], w[20] = ("idiot", "grolx" + w[1]) if k % 2 else ("scum", "idiot")
        rows.append((k, " ".join(w)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_spans(spark):
    rows, labels = corpus(900)
    docs = with_clashes(documents(spark, rows), "score", "predicted", "starts")
    model = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = score(docs, model).collect()
    held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 100
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held) >= 0.95 * len(held)
    text = dict(rows)
    hit = [text[r["doc_id"]][a:z] for r in got for a, z in zip(r["starts"], r["ends"], strict=True)]
    assert hit and sum(h in ("idiot", "scum") or h.startswith("grolx") for h in hit) >= 0.95 * len(hit)


def test_fold_is_crc32_and_never_fits(spark):
    docs = documents(spark, [(k, "x") for k in range(50)])
    assert {r[0]: r[1] for r in docs.select("doc_id", in_fold(docs.doc_id)).collect()} == {
        k: zlib.crc32(str(k).encode()) % 5 == 0 for k in range(50)}
    held = [k for k in range(500) if zlib.crc32(str(k).encode()) % 5 == 0]
    labels = spark.createDataFrame([(k, k % 2) for k in held], "doc_id long, toxic int")
    assert fit(documents(spark, [(k, "x") for k in held]), labels).constant == 0.0


def test_nulls_empty_long_and_repeats(spark):
    rows, labels = corpus(300)
    model = fit_model([t for _, t in rows], [y for _, y in labels])
    more = [(1, None), (2, ""), (3, "a idiot scum " + "the " * 100_000), (3, "İİ idiot scum"), (None, "idiot scum idiot")]
    got = score(documents(spark, more), model, carry=("text",)).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    for r in got:
        assert [(r["text"] or "")[a:z] for a, z in zip(r["starts"], r["ends"], strict=True)] == [
            w for w in (r["text"] or "").split() if w in ("idiot", "scum")]
    assert score(documents(spark, []), model).count() == 0
    one = fit_model(["a"], [1])
    assert [r["score"] for r in score(documents(spark, [(1, "x")]), one).collect()] == [1.0]


def test_labels_of_other_kinds_are_ignored(spark):
    rows, labels = corpus(200)
    odd = [*labels, (3, None), (6, 7), (None, 1), *labels[:10]]
    a = fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    b = fit(documents(spark, rows), spark.createDataFrame(odd, "doc_id long, toxic int"))
    assert a.evidence == b.evidence

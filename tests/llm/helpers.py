"""Fixtures and brute-force versions for the operators of tidewater.llm."""

from __future__ import annotations

import random
import re

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, schema: str = "doc_id long, text string", parts: int = 4):
    return spark.createDataFrame(rows, schema).repartition(parts)


def words(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(("an", "re", "ti", "on", "the", "é", "sh")) for _ in range(rng.randint(1, 4)))
            for _ in range(n)]


def with_clashes(df, *names: str):
    """The frame with more columns, named like those that operators make."""
    from pyspark.sql import functions as F
    for n in names:
        df = df.withColumn(n, F.lit("clash"))
    return df


def suffix_brute(rows) -> dict:
    """doc_id -> (bytes, removed, runs, kept bytes), for distinct ids."""
    first: dict[bytes, int] = {}
    out = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.setdefault(b[k:k + 50], i) < i:
                gone[k:k + 50] = b"\x01" * 50
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


def shingle_set(text, n: int) -> frozenset:
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def components_brute(rows, n: int, percent: int = 80) -> dict:
    """doc_id -> (set size, smallest reachable id), for distinct ids."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def decontam_words(text) -> list[str]:
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))


def decontam_brute(docs, items) -> dict:
    """doc_id -> (item ids, covered words), every diagonal of every pair."""
    out = {}
    for i, t in docs:
        w = decontam_words(t)
        ids, covered = set(), set()
        for item, text in items:
            x = decontam_words(text)
            width = min(13, len(x))
            for d in range(-len(x) + width, len(w) - width + 1) if x else ():
                for j in range(max(0, -d), len(x) - width + 1):
                    if j + d + width <= len(w) and sum(
                            w[j + d + k] == x[j + k] for k in range(width)) >= width - width // 5:
                        ids.add(item)
                        covered.update(range(j + d, j + d + width))
        out[i] = (sorted(ids), len(covered))
    return out

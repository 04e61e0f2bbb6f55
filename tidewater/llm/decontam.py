"""Benchmark decontamination by spaced-seed hashing.

A document is contaminated by a benchmark item if ``WINDOW`` aligned words of
the two (all words of a shorter item, which has ``LEAST`` words or more) differ in
at most a fifth of the places.

1. Seeds are fixed masks over a window: the places whose number modulo 4 is
   one of two residues; the six masks ignore the other places.  Two
   substitutions leave two of the four residues untouched, so one mask always
   hits.  Items of five to nine words may differ in one place: two masks, the even
   and the odd places, suffice for them.  Shorter ones must be equal: one mask has
   all places.  So each mask of each width selects two places or more.
2. The masked hashes of all windows of the test items and of the documents are
   joined: an index of the test hashes goes to the tasks, which look up every
   window of whole texts.
3. Around each hit the words are compared along the hit's diagonal, and every
   window within the allowed substitutions counts.  Only verified windows are
   reported, so windows whose masked hashes collide cannot contaminate; words
   are compared by their 64-bit hashes.

The test index is bounded: distinct items are dealt into blocks of about
``BLOCK_BYTES`` of text, whose sizes are counted first, and the documents are
scanned once per block.  Documents are not shuffled for the scan, so a hot
source or a passage in a third of all documents makes no task larger.

Words are runs of ASCII letters and digits, A-Z lower-cased, and of other
non-ASCII characters.  Defined cases: null and empty texts, and items of
fewer than ``LEAST`` words (such words are in clean texts too), contaminate nothing
and are never contaminated; rows that repeat a
``doc_id`` keep their rows; an empty benchmark leaves every document clean; an
empty table gives no rows.  Columns other than the ids and texts are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import mix, ship, trimmed
from tidewater.llm.minhash import word_hashes

WINDOW, LEAST, BLOCK_BYTES = 13, 3, 8 << 20
#: Substitutions -> the residues modulo 4 that each mask selects.
MASKS = {0: [(0, 1, 2, 3)], 1: [(0, 2), (1, 3)], 2: [(a, b) for a in range(4) for b in range(a + 1, 4)]}
U = np.uint64
SPACES = np.ones(256, dtype=bool)
SPACES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
FACTORS = np.random.default_rng(77).integers(1, 1 << 63, WINDOW, dtype=np.int64).astype(U) | U(1)


def words_of(text: bytes) -> np.ndarray:
    return word_hashes(text, SPACES)


def allowed(width: int) -> int:
    """Substitutions that a window may have."""
    return width // 5


def seeds(words: np.ndarray, width: int) -> list[np.ndarray]:
    """For each mask, the hash of every window of ``width`` words."""
    n = len(words) - width + 1
    part = []
    for residue in range(4):
        h = np.zeros(max(n, 0), dtype=U)
        for k in range(residue, width, 4):
            h += words[k:k + max(n, 0)] * FACTORS[k]
        part.append(h)
    return [mix(sum((part[r] for r in mask), U(k))) for k, mask in enumerate(MASKS[allowed(width)])]


@dataclass
class Index:
    """The test side: items' words, and their masked hashes by width."""
    ids: list[int]
    words: list[np.ndarray]
    #: width -> per mask: (present, sorted hashes, item, place)
    tables: dict[int, list[tuple]]

    @classmethod
    def build(cls, ids: list[int], texts: list[bytes]) -> Index:
        words = [words_of(t) for t in texts]
        by_width: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) >= LEAST:
                by_width.setdefault(min(WINDOW, len(w)), []).append(k)
        tables = {}
        for width, items in by_width.items():
            masks: list[list] = [[] for _ in MASKS[allowed(width)]]
            for k in items:
                for m, h in enumerate(seeds(words[k], width)):
                    masks[m].append((h, np.full(len(h), k), np.arange(len(h))))
            tables[width] = [cls._table(*(np.concatenate(x) for x in zip(*m, strict=True))) for m in masks]
        return cls(ids, words, tables)

    @staticmethod
    def _table(h, item, place):
        bits = max(12, int(len(h)).bit_length() + 5)
        present = np.zeros(1 << bits, dtype=bool)
        present[h >> U(64 - bits)] = True
        order = np.argsort(h, kind="stable")
        return present, U(64 - bits), h[order], item[order], place[order]

    def hits(self, words: np.ndarray):
        """Distinct (width, item, diagonal) where a masked window agrees."""
        for width, masks in self.tables.items():
            found = []
            for h, (present, shift, keys, item, place) in zip(seeds(words, width), masks, strict=True):
                at = np.flatnonzero(present[h >> shift])
                lo, hi = np.searchsorted(keys, h[at]), np.searchsorted(keys, h[at], side="right")
                at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
                row = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                found.append(np.stack([item[row], np.repeat(at, n) - place[row]], axis=1))
            for k, d in np.unique(np.concatenate(found), axis=0).tolist():
                yield width, k, d

    def verified(self, words: np.ndarray, ends: np.ndarray):
        """(document, item, first and last word) of every stretch of windows
        that agree; ``words`` are those of all documents, which end at ``ends``."""
        for width, k, d in self.hits(words):
            item = self.words[k]
            lo, hi = max(0, -d), min(len(item), len(words) - d)
            same = np.cumsum(np.append(0, words[lo + d:hi + d] == item[lo:hi]))
            good = np.flatnonzero(same[width:] - same[:-width] >= width - allowed(width)) + lo + d
            first = np.searchsorted(ends, good, side="right")
            good, first = good[ends[first] >= good + width], first[ends[first] >= good + width]
            for doc in np.unique(first).tolist():
                at = good[first == doc]
                start = ends[doc - 1] if doc else 0
                covered = np.unique((at[:, None] + np.arange(width)).ravel()) - start
                yield doc, k, covered


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark in blocks of about ``BLOCK_BYTES`` of text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"),
                             F.col(text_col).cast("binary").alias("text")).filter(
        F.col("text").isNotNull() & F.col("id").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    return [items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)]


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: the id (and ``carry`` columns), contaminated, item_ids (sorted),
    n_words (words of the text that verified windows cover)."""
    ship(docs.sparkSession)
    out = docs.select(id_col, *(carry or []), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"),
                      F.array().cast("array<long>").alias("item_ids"),
                      F.array().cast("array<long>").alias("_covered"))
    for block in blocks_of(benchmark, item_col, item_text):
        rows = block.orderBy("id", "text").collect()  # one block
        index = docs.sparkSession.sparkContext.broadcast(
            Index.build([r["id"] for r in rows], [bytes(r["text"]) for r in rows]))
        out = _scan_block(out, index)
    return out.select(id_col, *(carry or []), (F.size("item_ids") > 0).alias("contaminated"), "item_ids",
                      F.size("_covered").cast("long").alias("n_words"))


def _scan_block(rows: DataFrame, index) -> DataFrame:
    def run(batches):
        for b in batches:
            words = [words_of(t.as_buffer().to_pybytes()) for t in b.column("_text")]
            found: dict[int, tuple[set, set]] = {}
            ends = np.cumsum([len(w) for w in words])
            flat = np.concatenate([*words, np.zeros(0, U)])
            for doc, k, covered in index.value.verified(flat, ends):
                ids, places = found.setdefault(doc, (set(), set()))
                ids.add(index.value.ids[k])
                places.update(covered.tolist())
            many = pa.list_(pa.int64())
            columns = {f.name: b.column(f.name) for f in b.schema}
            for c, part in (("item_ids", 0), ("_covered", 1)):
                if found:
                    old = b.column(c).to_pylist()
                    for doc, new in found.items():
                        old[doc] = sorted({*old[doc], *new[part]})
                    columns[c] = pa.array(old, many)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return rows.mapInArrow(trimmed(run), rows.schema)

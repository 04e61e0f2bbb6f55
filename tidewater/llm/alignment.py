"""Cross-tokenizer alignment with external spill counting.

Tokenizer A (byte-level BPE, of space + text) and tokenizer B (sentencepiece, of
the text; it adds the space) spell the same bytes.  Places where tokens of both
end cut them into groups; an A token and a B token are linked where their bytes
overlap.  How many documents hold an id pair linked is counted over the corpus:

1. ``chunks``: a task encodes documents, a chunk at a time, and makes one record
   per distinct (pair, document) with its number of links.  Records are sorted
   by (radix of the A id, pair, document) and spilled as one zstd run a radix.
2. ``merge``: the runs of a radix meet in one task.  A heap of run heads merges
   them in side-major order (A id, then B id) and counts each pair; when the
   pairs of an A id have gone by, its highest count is known.  The records are
   read once more and their contributions (links with the highest count, sum of
   counts) go back to their chunk, added up by document.
3. A radix whose runs are larger than a piece is dealt to several tasks, so that
   a hot A id loads none of them.  Pieces count by themselves, Spark adds the
   counts of a pair, and each piece gets the final counts for its second pass.
4. ``settle``: contributions meet the rows of their chunk.

Runs carry places in a chunk, never ids or texts, and are written to the shared
folder once, so a lost executor costs rereading them.  A chunk, a piece and the
counts of one radix bound what a task holds: about 2 MB of text, 16 MB of runs,
and pairs that the vocabularies bound, whatever the size of the corpus.

Defined cases: each row is a document, also where ids repeat or are null; texts
null, empty, or spelled differently by a tokenizer have no tokens: zeros and an
empty digest; control strings are plain text; a very long text is a chunk of its
own and takes about 100 bytes a byte; an empty table gives no rows; columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.bpe import byte_letters
from tidewater.llm.common import mix, pinned, shuffle_partitions, ship
from tidewater.llm.token_count import SPLIT, byte_level_file

#: Text of a chunk, in characters; its documents, whose places take 16 bits.
CHUNK, CHUNK_DOCS = 1 << 21, 1 << 16
#: Radixes at most, and compressed bytes of a piece.
RADIXES, PIECE, SMALL_PIECE = 4096, 16 << 20, 256 << 10
#: White space that the split pattern of a text may backtrack over.
LONG_SPACE = regex.compile(r"\p{White_Space}{5000}")


# ------------------------------------------------------------------ tokenizers
class Tokenizers:
    """Ids of both tokenizers, and the bytes that each id spells."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        spec = byte_level_file(path_a)
        vocab = spec["model"]["vocab"]
        number = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(map(number.__getitem__, t)): i for t, i in vocab.items()}
        order = [vocab[u + v] for u, v in spec["model"]["merges"]]
        if order != sorted(set(order)):
            raise ValueError(f"{path_a}: its ids are not in the order of its merges")
        self.path_a = path_a
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (1 + max(ranks.values()))
        for t, i in ranks.items():
            self.bytes_a[i] = t
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        if len(self.bytes_a) * len(self.bytes_b) >= 1 << 32:
            raise ValueError("a pair of ids takes more than 32 bits")
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.labels = [f"{i}{mark}".encode() for i in range(max(len(self.bytes_a), len(self.bytes_b)))
                       for mark in ",|;"]
        self._slow = None

    def encode_a(self, text: str) -> list[int]:
        if not LONG_SPACE.search(text):
            return self.a.encode_ordinary(text)
        if self._slow is None:  # the fast encoder's pattern cannot go back that far
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_file(self.path_a)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A and by B; None where there are none or they spell other bytes."""
        if not text:
            return None
        ids = self.encode_a(" " + text)
        want = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, ids)) != want:
            return None
        a = np.array(ids, np.uint32)
        ids = self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, ids)) != want:
            return None
        return a, np.array(ids, np.uint32)


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


# ------------------------------------------------------------------ runs
def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length as one zstd frame, byte plane by byte plane."""
    planes = [str(len(arrays[0])).encode(), *[a.dtype.str.encode() for a in arrays]]
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
                    for a in arrays)
    return zstandard.compress(b" ".join(planes) + b"\n" + body, 3)


def unpack(frame: bytes) -> list[np.ndarray]:
    head, _, body = zstandard.decompress(frame).partition(b"\n")
    size, *kinds = head.decode().split(" ")
    out, at, n = [], 0, int(size)
    for kind in map(np.dtype, kinds):
        end = at + n * kind.itemsize
        planes = np.frombuffer(body, np.uint8, end - at, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at = end
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def radix(a: np.ndarray, radixes: int) -> np.ndarray:
    """The radix of each A id."""
    return mix(a.astype(np.uint64) + np.uint64(1)) & np.uint64(radixes - 1)


def spill(keys: np.ndarray, radixes: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, pairs, records) of each run, from the keys of all links."""
    keys.sort()
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    links = np.diff(np.r_[first, len(keys)])
    keys = keys[first]
    bounds = np.searchsorted(keys, np.arange(radixes + 1, dtype=np.uint64) << np.uint64(48))
    pairs = (keys >> np.uint64(16)).astype(np.uint32)
    docs = keys.astype(np.uint16)
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        s, e = bounds[k], bounds[k + 1]
        part = pairs[s:e]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sizes = np.diff(np.r_[starts, len(part)])
        step = np.diff(part[starts], prepend=np.uint32(0))
        gaps = np.diff(docs[s:e], prepend=np.uint16(0))
        gaps[starts] = docs[s:e][starts]
        yield k, pack(narrow(step), narrow(sizes)), pack(narrow(gaps), narrow(links[s:e]))


def groups(pairs: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a run in side-major order, and their numbers of documents."""
    step, sizes = unpack(pairs)
    return np.cumsum(step, dtype=np.int64), sizes.astype(np.int64)


def records(frame: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the documents of a run and their links."""
    gaps, links = unpack(frame)
    total = np.cumsum(gaps, dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    before = np.where(starts > 0, total[starts - 1], 0)
    return total - np.repeat(before, sizes), links.astype(np.int64)


# ------------------------------------------------------------------ chunks
class Chunk:
    """Documents whose alignments are worked out together."""

    def __init__(self):
        self.ids, self.tokens, self.size = [], [], 0

    def add(self, doc, text: str | None, t: Tokenizers) -> None:
        self.ids.append(doc)
        self.tokens.append(t.encode(text))
        self.size += len(text or "")

    def full(self) -> bool:
        return self.size >= CHUNK or len(self.ids) >= CHUNK_DOCS

    def align(self, t: Tokenizers, radixes: int) -> tuple[dict[str, list], np.ndarray]:
        """(columns of the documents, keys of all links)."""
        n = len(self.ids)
        held = [k for k, x in enumerate(self.tokens) if x is not None]
        empty = np.zeros(0, np.uint32)
        a = np.concatenate([self.tokens[k][0] for k in held] or [empty])
        b = np.concatenate([self.tokens[k][1] for k in held] or [empty])
        n_a, n_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k in held:
            n_a[k], n_b[k] = len(self.tokens[k][0]), len(self.tokens[k][1])
        end_a, end_b = np.cumsum(t.length_a[a]), np.cumsum(t.length_b[b])
        # which tokens end at each byte: 1 for A, 2 for B
        ends = np.zeros(int(end_a[-1]) if len(a) else 0, np.uint8)
        ends[end_a - 1] = 1
        ends[end_b - 1] |= 2
        both_a, both_b = ends[end_a - 1] == 3, ends[end_b - 1] == 3
        # between two ends lie the bytes that one A and one B token share
        cut = ends[np.flatnonzero(ends)]
        in_a, in_b = cut & 1, cut >> 1
        at_a = np.cumsum(in_a, dtype=np.int64) - in_a
        at_b = np.cumsum(in_b, dtype=np.int64) - in_b
        doc_a = np.repeat(np.arange(n), n_a)
        doc = doc_a[at_a]
        out = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc_a[both_a], minlength=n),
               "n_links": np.bincount(doc, minlength=n)}
        left = a[at_a]
        keys = (radix(left, radixes) << np.uint64(48)) | (
            (left.astype(np.uint64) * np.uint64(len(t.bytes_b)) + b[at_b]) << np.uint64(16)) | doc.astype(np.uint64)
        # labels of all tokens, group by group, those of A before those of B
        group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        past_a, past_b = np.flatnonzero(both_a) + 1, np.flatnonzero(both_b) + 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.r_[0, past_b][group_a]] = a.astype(np.int64) * 3 + both_a
        order[np.arange(len(b)) + past_a[group_b]] = b.astype(np.int64) * 3 + 2 * both_b
        digests, at = [], 0
        for size in (n_a + n_b).tolist():
            text = b"".join(map(t.labels.__getitem__, order[at:at + size].tolist()))
            digests.append(hashlib.sha256(text[:-1]).hexdigest() if size else "")
            at += size
        return {"id": self.ids, **{c: v.tolist() for c, v in out.items()}, "groups_sha256": digests}, keys


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def chunks(docs: DataFrame, path_a: str, path_b: str, radixes: int) -> DataFrame:
    """Rows of documents (radix -1) and of runs, from a frame (id, text)."""
    kind = docs.schema[0].dataType.simpleString()
    schema = (f"chunk long, radix int, doc int, id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, "
              "groups_sha256 string, pairs binary, records binary")

    def run(batches):
        t = tokenizers(path_a, path_b)
        number, id_type = TaskContext.get().partitionId() << 32, None

        def written(chunk: Chunk):
            columns, keys = chunk.align(t, radixes)
            size = len(chunk.ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, number)), pa.array(np.full(size, -1, np.int32)),
                 pa.array(np.arange(size, dtype=np.int32)), pa.array(columns["id"], id_type),
                 *[pa.array(columns[c], pa.int64()) for c in COUNTS],
                 pa.array(columns["groups_sha256"], pa.string()),
                 pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary())], names=names)
            for k, pairs, found in spill(keys, radixes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([k], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, id_type),
                     *[pa.nulls(1, pa.int64()) for _ in COUNTS], pa.nulls(1, pa.string()),
                     pa.array([pairs], pa.binary()), pa.array([found], pa.binary())], names=names)

        chunk = Chunk()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for k, doc in enumerate(batch.column(0).to_pylist()):
                chunk.add(doc, batch.column(1)[k].as_py(), t)
                if chunk.full():
                    yield from written(chunk)
                    chunk, number = Chunk(), number + 1
        if chunk.ids:
            yield from written(chunk)

    names = [f.split(" ")[0] for f in schema.split(", ")]
    return docs.mapInArrow(run, schema)


# ------------------------------------------------------------------ counting
def count(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in side-major order and their counts, by a merge of the runs."""
    def entries(pairs, sizes):
        for k in range(0, len(pairs), 4096):
            yield from zip(pairs[k:k + 4096].tolist(), sizes[k:k + 4096].tolist(), strict=True)

    keys, totals, last, total = [], [], -1, 0
    for pair, size in heapq.merge(*[entries(*r) for r in runs]):
        if pair != last:
            keys.append(last)
            totals.append(total)
            last, total = pair, 0
        total += size
    return np.array([*keys[1:], last], np.int64), np.array([*totals[1:], total], np.int64)


def highest(pairs: np.ndarray, counts: np.ndarray, other: int) -> np.ndarray:
    """Whether a count is its A id's highest; pairs are in side-major order."""
    side = pairs // other
    starts = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
    top = np.maximum.reduceat(counts, starts)
    return counts == np.repeat(top, np.diff(np.r_[starts, len(pairs)]))


def contribution(pairs: bytes, found: bytes, known: np.ndarray, counts: np.ndarray, best: np.ndarray) -> bytes:
    """(documents, links with the highest count, sums of counts) of one run."""
    own, sizes = groups(pairs)
    docs, links = records(found, sizes)
    at = np.searchsorted(known, own)
    n = int(docs.max()) + 1
    n_best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(n_best, docs, links * np.repeat(best[at], sizes))
    np.add.at(total, docs, links * np.repeat(counts[at], sizes))
    touched = np.flatnonzero(total)
    return pack(narrow(touched), narrow(n_best[touched]), narrow(total[touched]))


def grouped(batches, keys: int) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows that agree in the first columns."""
    held, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row.values())[:keys]
            if key != last and held:
                yield last, held
                held = []
            last = key
            held.append(row)
    if held:
        yield last, held


BACK = "radix int, chunk long, payload binary"


def back(radix_, chunk, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([radix_], pa.int32()), pa.array([chunk], pa.int64()),
                                       pa.array([payload], pa.binary())], names=["radix", "chunk", "payload"])


def merge(other: int) -> Callable:
    """Count the runs of each (radix, piece); columns radix, piece, pieces,
    chunk, pairs, records.  Contributions of a radix in one piece are final;
    otherwise the counts go out (chunk -1)."""
    def run(batches):
        for (k, _, pieces), rows in grouped(batches, 3):
            known, counts = count([groups(r["pairs"]) for r in rows])
            if pieces > 1:
                yield back(k, -1, pack(known, narrow(counts)))
                continue
            best = highest(known, counts, other)
            for r in rows:
                yield back(k, r["chunk"], contribution(r["pairs"], r["records"], known, counts, best))
    return run


def counts_of(frames: DataFrame, other: int, partitions: int) -> DataFrame:
    """Final counts (radix, part, payload) of the radixes in several pieces."""
    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                pairs, counts = unpack(r["payload"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), r["radix"], np.int32)), pa.array(pairs),
                     pa.array(counts.astype(np.int64))], names=["radix", "pair", "n"])

    def packed(batches):
        for (k, part), held in grouped_columns(batches):
            pairs, counts, best = held
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([part], pa.int32()),
                 pa.array([pack(pairs, narrow(counts), best)], pa.binary())], names=["radix", "part", "payload"])

    def grouped_columns(batches):
        held, last = [], None
        for batch in batches:
            k, part, *columns = (np.asarray(c) for c in batch.columns)
            bounds = np.r_[0, np.flatnonzero((np.diff(k) != 0) | (np.diff(part) != 0)) + 1, len(k)]
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if e > s:
                    key = (int(k[s]), int(part[s]))
                    if key != last and held:
                        yield last, [np.concatenate(c) for c in zip(*held, strict=True)]
                        held = []
                    last = key
                    held.append([c[s:e] for c in columns])
        if held:
            yield last, [np.concatenate(c) for c in zip(*held, strict=True)]

    side = F.expr(f"pair div {other}").alias("side")
    counts = pinned(frames.mapInArrow(rows, "radix int, pair long, n long")
                    .groupBy("radix", "pair").agg(F.sum("n").alias("n")))
    # one row per A id: the vocabulary bounds what is broadcast
    top = F.broadcast(counts.groupBy(side).agg(F.max("n").alias("top")))
    return (counts.withColumn("side", F.expr(f"pair div {other}")).join(top, "side")
            .select("radix", F.expr("cast(pmod(pair, 8) as int)").alias("part"), "pair", "n",
                    F.expr("cast(n = top as tinyint)").alias("best"))
            .repartition(partitions, "radix", "part").sortWithinPartitions("radix", "part", "pair")
            .mapInArrow(packed, "radix int, part int, payload binary"))


def second_pass(batches):
    """Contributions of the runs of each (radix, piece), the final counts first:
    columns radix, piece, chunk (-1: counts), payload, pairs, records."""
    held, last, known, counts, best = [], None, None, None, None
    for batch in batches:
        for r in batch.to_pylist():
            key = (r["radix"], r["piece"])
            if key != last:
                held, last, known = [], key, None
            if r["chunk"] < 0:
                held.append(unpack(r["payload"]))
                continue
            if known is None:
                known, counts, best = (np.concatenate(c) for c in zip(*held, strict=True))
                order = np.argsort(known)
                known, counts, best = known[order], counts[order].astype(np.int64), best[order]
                held = []
            yield back(r["radix"], r["chunk"], contribution(r["pairs"], r["records"], known, counts, best))


def settle(kind: str, id_col: str) -> tuple[Callable, str]:
    """Documents of a chunk, after its contributions (doc null)."""
    names = [id_col, *COUNTS, "n_best", "count_sum", "groups_sha256"]
    schema = f"`{id_col}` {kind}, {', '.join(f'{c} long' for c in names[1:-1])}, groups_sha256 string"

    def run(batches):
        chunk, n_best, total = None, None, None
        for batch in batches:
            numbers = np.asarray(batch.column(0))
            docs = batch.column(1)
            for number in np.unique(numbers).tolist():
                rows = np.flatnonzero(numbers == number)
                if number != chunk:
                    chunk = number
                    n_best, total = np.zeros(CHUNK_DOCS, np.int64), np.zeros(CHUNK_DOCS, np.int64)
                part = batch.slice(int(rows[0]), len(rows))
                given = np.asarray(docs.slice(int(rows[0]), len(rows)).is_null())
                for payload in part.column(7).filter(pa.array(given)).to_pylist():
                    at, best, sums = unpack(payload)
                    n_best[at] += best
                    total[at] += sums.astype(np.int64)
                part = part.filter(pa.array(~given))
                if len(part):
                    at = np.asarray(part.column(1))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(2), *part.columns[3:7], pa.array(n_best[at]), pa.array(total[at]),
                         part.column(8)], names=names)

    return run, schema


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          piece: int | None = None) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``piece``: compressed bytes of runs that one task merges (None: by the
    shuffle partitions, at most ``PIECE``); it does not change the result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(id_col, text_col)
    kind = dict(rows.dtypes)[id_col]
    partitions = shuffle_partitions(spark)
    radixes = min(RADIXES, max(16, 1 << (partitions - 1).bit_length()))
    other = _vocabulary(path_b)

    made = pinned(chunks(rows, path_a, path_b, radixes))
    runs = made.filter("radix >= 0").select("chunk", "radix", "pairs", "records")
    # one row per radix reaches the driver
    sizes = {r["radix"]: r["bytes"] for r in runs.groupBy("radix").agg(
        F.sum(F.length("pairs") + F.length("records")).alias("bytes")).collect()}
    target = piece or min(PIECE, max(SMALL_PIECE, sum(sizes.values()) // (2 * partitions)))
    pieces = F.broadcast(spark.createDataFrame([(k, -(-b // target)) for k, b in sizes.items()],
                                               "radix int, pieces int"))
    dealt = (runs.join(pieces, "radix")
             .withColumn("piece", F.expr("cast(pmod(xxhash64(chunk), pieces) as int)")))
    back_ = pinned(dealt.select("radix", "piece", "pieces", "chunk", "pairs", "records")
                   .repartition(partitions, "radix", "piece").sortWithinPartitions("radix", "piece")
                   .mapInArrow(merge(other), BACK))
    given = [back_.filter("chunk >= 0")]
    if any(b > target for b in sizes.values()):
        final = counts_of(back_.filter("chunk < 0"), other, partitions)
        final = (final.join(pieces, "radix")
                 .select("radix", F.explode(F.expr("sequence(0, pieces - 1)")).alias("piece"),
                         F.lit(-1).cast("long").alias("chunk"), "payload",
                         F.lit(None).cast("binary").alias("pairs"), F.lit(None).cast("binary").alias("records")))
        split = (dealt.filter("pieces > 1")
                 .select("radix", "piece", "chunk", F.lit(None).cast("binary").alias("payload"), "pairs", "records"))
        given.append(final.unionByName(split).repartition(partitions, "radix", "piece")
                     .sortWithinPartitions("radix", "piece", "chunk").mapInArrow(second_pass, BACK))
    run, schema = settle(kind, id_col)
    base = made.filter("radix < 0").select("chunk", "doc", "id", *COUNTS, F.lit(None).cast("binary").alias("payload"),
                                           "groups_sha256")
    for g in given:
        base = base.unionByName(g.select(
            "chunk", F.lit(None).cast("int").alias("doc"), F.lit(None).cast(kind).alias("id"),
            *[F.lit(None).cast("long").alias(c) for c in COUNTS], "payload",
            F.lit(None).cast("string").alias("groups_sha256")))
    return (base.repartition(partitions, "chunk")
            .sortWithinPartitions("chunk", F.col("doc").asc_nulls_first()).mapInArrow(run, schema))


def _vocabulary(path: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()

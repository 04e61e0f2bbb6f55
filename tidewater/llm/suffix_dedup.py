"""Suffix-array dedup: remove what a document with a smaller id already says.

A byte goes if a ``SPAN``-byte string that covers it also starts in a document
with a smaller id.  Sorting every suffix of the corpus would shuffle many times
its size, so suffixes are sorted as *contexts*:

* Prefix polynomial hashes give the hash of any substring in O(1).  In each
  ``SPAN``-byte window the smallest ``GRAM``-byte hash (the leftmost of equal
  ones) is its anchor, which depends on the window's bytes alone.  Windows in a
  row with one anchor share a context, the bytes they cover together.
* Round 1 sorts the contexts by (anchor hash, context hash).  Equal contexts
  are one class: all but those of its smallest document are removed whole.
  Two classes of one anchor can share a window only if the ``SIDE`` bytes
  before the anchor agree, or those after it; hashes of both sides tell.
* Round 2 sorts single windows for what is left: the first documents of classes
  that agree on a side, which is about the ends of shared passages.  Their
  contexts travel as bytes, by anchor.  The smallest document of each window
  keeps it.

Sorting works on hashes of a suffix's first bytes, so one comparison is O(1);
where the bytes are at hand (in a task of round 1, in round 2) equal hashes are
verified byte by byte, and elsewhere some 100 bits of independent hashes must
agree.

Skew: a task sorts its own part first, sends one document per class or window
(the smallest), and decides the others itself, so a passage in a third of all
documents costs each task one entry.  An anchor with over ``MANY`` classes in a
task goes to round 2 as hot: there its windows travel as hashes, each with a
key of its own.  It leaves one mark that sends the anchor's other classes the
same way.

Defined cases: null text counts as empty; texts under ``SPAN`` bytes lose
nothing; matches within a document, or between rows that repeat a ``doc_id``,
do not count; a null ``doc_id`` has no order, so such rows stay whole; an empty
table gives no rows.  Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import mix, pinned, ship, shuffle_partitions, trimmed

SPAN, GRAM = 50, 12
#: A window has this many bytes before its anchor, or after it.
SIDE = (SPAN - GRAM + 1) // 2
#: An anchor with more classes than this in one task goes to round 2 at once.
MANY = 64
#: Bytes of text that a task sorts at once, and that are hashed at once.
CHUNK, PIECE = 8 << 20, 1 << 19

U = np.uint64
BASE = 0x9E3779B97F4A7C15
DECIDED, ASKED, HOT, ENTRIES = 0, 1, 2, 3
SHAPE = "bucket int, kind int, doc_id long, th long, payload binary"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


POWER = _powers(BASE, PIECE + 4 * SPAN)
INVERSE = _powers(pow(BASE, -1, 1 << 64), PIECE + 4 * SPAN)


def prefix_hashes(buf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum((buf.astype(U) + U(1)) * POWER[:len(buf)], out=out[1:])
    return out


def substring_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((h[end] - h[start]) * INVERSE[start])


def contexts(pieces: list[bytes]):
    """(piece, first window, windows, anchor hash, context hash, hashes of the
    bytes before and after the anchor) of all pieces."""
    lens = np.array([len(p) for p in pieces], dtype=np.int64)
    buf = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    if len(buf) < SPAN:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),) * 2 + (np.zeros(0, np.uint16),) * 2
    h = prefix_hashes(buf)
    v = mix((h[GRAM:] - h[:-GRAM]) * INVERSE[:len(buf) - GRAM + 1])
    off = np.zeros(len(v), dtype=np.uint8)
    width, reach = SPAN - GRAM + 1, 1
    while reach < width:  # leftmost minimum of ever wider ranges
        step = min(reach, width - reach)
        a, b = v[:-step], v[step:]
        later = b < a
        off = np.where(later, off[step:] + np.uint8(step), off[:-step])
        v = np.minimum(a, b)
        reach += step
    at = np.arange(len(v))
    ends = np.cumsum(lens)
    valid = at + SPAN <= np.repeat(ends, lens)[:len(v)]
    anchor = at + off
    same = np.zeros(len(v), dtype=bool)
    same[1:] = valid[1:] & valid[:-1] & (anchor[1:] == anchor[:-1])
    first = np.flatnonzero(valid & ~same)
    more = np.zeros(len(v), dtype=bool)
    more[:-1] = same[1:]
    last = np.flatnonzero(valid & ~more)
    shape = (last - first).astype(U) * U(64) + (anchor[first] - first).astype(U)
    c = mix(substring_hashes(h, first, last + SPAN) ^ (shape * U(0xD6E8FEB86659FD93)))
    sides = []
    for lo in (anchor[first] - SIDE, anchor[first] + GRAM):
        inside = (lo >= first) & (lo + SIDE <= last + SPAN)
        x = np.zeros(len(lo), dtype=np.uint16)  # 0: no window has this side
        lo = lo[inside]
        x[inside] = (substring_hashes(h, lo, lo + SIDE) % U(65535)).astype(np.uint16) + np.uint16(1)
        sides.append(x)
    piece = np.searchsorted(ends, first, side="right")
    return piece, first - (ends - lens)[piece], last - first + 1, v[first], c, *sides


def windows(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the window at each start (ascending) of the bytes."""
    one, two = np.zeros(len(starts), U), np.zeros(len(starts), U)
    for lo in range(0, len(text), PIECE):
        a, b = np.searchsorted(starts, [lo, lo + PIECE])
        if a == b:
            continue
        buf = text[lo:lo + PIECE + SPAN]
        s = starts[a:b] - lo
        one[a:b] = substring_hashes(prefix_hashes(buf), s, s + SPAN)
        s = len(buf) - s - SPAN  # of the reversed bytes: independent of the first
        two[a:b] = substring_hashes(prefix_hashes(buf[::-1]), s, s + SPAN)
    return one, two


def groups(*keys: np.ndarray) -> np.ndarray:
    """Number of the group of equal keys, of sorted rows."""
    new = np.zeros(len(keys[0]), dtype=bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


class Layout:
    """Columns of a blob with the bytes kept of each; rows go by (did, s), whose
    differences are stored, byte by byte, so that they compress.  A text per
    row (of the length that ``n`` says) may follow."""

    def __init__(self, **widths: int):
        self.widths = widths

    def pack(self, columns: dict[str, np.ndarray], texts: list[bytes] | None = None) -> bytes:
        n = len(columns["did"])
        order = np.lexsort((columns["s"], columns["did"]))
        raw = []
        for name, width in self.widths.items():
            x = columns[name][order].astype(np.int64, casting="unsafe")
            if name in ("did", "th", "s"):
                x = np.diff(x, prepend=np.int64(0))
            raw.append(np.ascontiguousarray(x.view(np.uint8).reshape(n, 8)[:, :width].T).tobytes())
        raw += [texts[k] for k in order.tolist()] if texts else []
        data = b"".join(raw)
        return (n.to_bytes(4, "little") + len(data).to_bytes(4, "little")
                + pa.Codec("zstd", 1).compress(data, asbytes=True))

    def unpack(self, blob: bytes) -> tuple[dict[str, np.ndarray], bytes]:
        n, size = (int.from_bytes(blob[k:k + 4], "little") for k in (0, 4))
        data = pa.Codec("zstd").decompress(blob[8:], size, asbytes=True)
        raw = np.frombuffer(data, dtype=np.uint8)
        out, at = {}, 0
        for name, width in self.widths.items():
            x = np.zeros((n, 8), dtype=np.uint8)
            x[:, :width] = raw[at:at + n * width].reshape(width, n).T
            at += n * width
            x = x.reshape(-1).view(np.int64)
            out[name] = np.cumsum(x) if name in ("did", "th", "s") else x
        return out, data[at:]

    def unpack_all(self, blobs: list[bytes]) -> tuple[dict[str, np.ndarray], list[bytes]]:
        """Columns of all blobs, and their texts, joined per blob."""
        parts = [self.unpack(b) for b in blobs]
        return ({name: np.concatenate([p[name] for p, _ in parts]) for name in self.widths},
                [t for _, t in parts])


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals (sorted by start) as disjoint ones, touching ones joined."""
    top = np.maximum.accumulate(end)
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > top[:-1]
    at = np.flatnonzero(new)
    return start[at], np.append(top[at[1:] - 1], top[-1:])


class Out:
    """Output rows of one batch."""

    def __init__(self):
        self.rows: list[tuple] = []

    def spans(self, kind, bucket_of, did, th, start, n, anchor=None) -> None:
        """A row per document: its window ranges [start, start + n), merged, or
        with ``anchor`` one by one."""
        if not len(did):
            return
        order = np.lexsort((start, th, did))
        did, th, start, n = did[order], th[order], start[order].astype(np.int64), n[order]
        g = groups(did, th)
        cut = np.append(np.flatnonzero(np.diff(g, prepend=-1)), len(g))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            columns = (merged(start[a:b], start[a:b] + n[a:b]) if anchor is None
                       else (start[a:b], n[a:b], anchor[order[a:b]]))
            self.rows.append((bucket_of(int(did[a])), kind, int(did[a]), int(th[a]),
                              np.concatenate(columns).astype("<i8").tobytes()))

    def entries(self, key, buckets: int, layout: Layout, columns: dict, kind: int = ENTRIES,
                texts: list[bytes] | None = None) -> None:
        bucket = (key % U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            rows = order[cut[k]:cut[k + 1]]
            self.rows.append((k, kind, None, None, layout.pack(
                {name: c[rows] for name, c in columns.items()}, texts and [texts[r] for r in rows.tolist()])))

    def batches(self) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        names = ["bucket", "kind", "doc_id", "th", "payload"]
        for lo in range(0, len(self.rows), 4096):
            cols = zip(*self.rows[lo:lo + 4096], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)


def _by_bytes(texts, doc, start, length, pairs) -> np.ndarray:
    """Which of the neighbours that hash alike differ in their bytes."""
    bad = [k for k in pairs.tolist() if texts[doc[k]][start[k]:start[k] + length[k]]
           != texts[doc[k - 1]][start[k - 1]:start[k - 1] + length[k - 1]]]
    return np.array(bad, dtype=np.int64)


#: Anchor and context hashes are cut to 40 bits; the sides' 16 bits each and
#: the bucket are part of what must agree as well.
ENTRY = Layout(m=5, c=5, before=2, after=2, did=8, th=8, s=8, n=1)
CONTEXT = Layout(m=5, did=8, th=8, s=8, n=1)
WINDOW = Layout(one=8, two=5, did=8, th=8, s=8)


def sort_contexts(x: dict[str, np.ndarray]):
    """Order by (anchor, context, document); then, in that order: the number of
    the anchor and of the class, removed (a smaller document of the class is
    here), and first (of its class).  Rows with ``n`` 0 are marks."""
    order = np.lexsort((x["did"], x["after"], x["before"], x["c"], x["m"]))
    m, c, before, after, did = (x[k][order] for k in ("m", "c", "before", "after", "did"))
    anchor, cls = groups(m), groups(m, c, before, after)
    real = x["n"][order] > 0
    head = np.flatnonzero(np.diff(cls, prepend=-1))
    removed = real & (did > did[head][cls])
    return order, anchor, cls, removed, real & ~removed


def _shared(anchor, cls, did, side, first) -> np.ndarray:
    """First rows whose side another class of the anchor, of another document, has."""
    rows = np.flatnonzero(first & (side > 0))
    out = np.zeros(len(anchor), dtype=bool)
    if len(rows):
        order = np.lexsort((side[rows], anchor[rows]))
        rows = rows[order]
        g = groups(anchor[rows], side[rows])
        at = np.flatnonzero(np.diff(g, prepend=-1))
        several = np.minimum.reduceat(cls[rows], at) < np.maximum.reduceat(cls[rows], at)
        several &= np.minimum.reduceat(did[rows], at) < np.maximum.reduceat(did[rows], at)
        out[rows] = several[g]
    return out


def _round_one(buckets: int):
    def local(batches):
        texts: list[bytes] = []
        ids: list[int] = []
        hashes: list[int] = []
        held = 0

        def work():
            out = Out()
            parts, pieces, owner, shift, size = [], [], [], [], 0

            def hash_pieces():
                p, s, *rest = contexts(pieces)
                parts.append((np.array(owner, np.int64)[p], s + np.array(shift, np.int64)[p], *rest))

            for k, t in enumerate(texts):
                for lo in range(0, max(1, len(t) - SPAN + 1), PIECE // 2):
                    piece = t[lo:lo + PIECE // 2 + SPAN - 1]
                    if len(piece) < SPAN:
                        continue
                    if size + len(piece) > PIECE:
                        hash_pieces()
                        pieces, owner, shift, size = [], [], [], 0
                    pieces.append(piece)
                    owner.append(k)
                    shift.append(lo)
                    size += len(piece)
            if pieces:
                hash_pieces()
            if not parts:
                return
            names = ("doc", "s", "n", "m", "c", "before", "after")
            x = {k: np.concatenate(v) for k, v in zip(names, zip(*parts, strict=True), strict=True)}
            x["m"] >>= U(24)  # 40 bits of each are kept, so 40 bits are sorted
            x["c"] >>= U(24)
            doc = x.pop("doc")
            x["did"], x["th"] = np.array(ids, np.int64)[doc], np.array(hashes, np.int64)[doc]
            order, anchor, cls, removed, first = sort_contexts(x)
            x, doc = {k: v[order] for k, v in x.items()}, doc[order]
            asked = first & (np.bincount(anchor[first], minlength=anchor[-1] + 1) > MANY)[anchor]
            twins = np.flatnonzero(cls[1:] == cls[:-1]) + 1
            if len(bad := _by_bytes(texts, doc, x["s"], x["n"] + SPAN - 1, twins)):
                # unequal bytes under equal hashes: windows decide about the anchor
                odd = np.isin(anchor, anchor[bad])
                removed, first, asked = removed & ~odd, first | odd, asked | odd
            for kind, rows in ((DECIDED, removed), (HOT, asked)):
                out.spans(kind, lambda d: d % buckets, *(x[k][rows] for k in ("did", "th", "s", "n")))
            send = first & ~asked
            marks = np.unique(x["m"][asked])
            rows = {k: np.concatenate([v[send], np.zeros(len(marks), v.dtype)]) for k, v in x.items()}
            rows["m"][len(rows["m"]) - len(marks):] = marks
            out.entries(rows["m"], buckets, ENTRY, rows)
            yield from out.batches()

        for b in batches:
            for t, i, h in zip(b.column("text"), b.column("doc_id").to_pylist(),
                               b.column("th").to_pylist(), strict=True):
                texts.append(t.as_buffer().to_pybytes())
                ids.append(i)
                hashes.append(h)
                held += len(texts[-1])
                if held >= CHUNK:
                    yield from work()
                    texts, ids, hashes, held = [], [], [], 0
        if texts:
            yield from work()

    def reduce(batches):
        out = Out()
        blobs = []
        for b in batches:
            for r in _rows_of(b):
                if r[1] == ENTRIES:
                    blobs.append(r[4])
                else:
                    out.rows.append(r)
            yield from out.batches()
            out = Out()
        if blobs:
            x, _ = ENTRY.unpack_all(blobs)
            order, anchor, cls, removed, first = sort_contexts(x)
            x = {k: v[order] for k, v in x.items()}
            marked = np.zeros(anchor[-1] + 1, dtype=bool)
            marked[anchor[x["n"] == 0]] = True
            hot = first & marked[anchor]
            asked = first & ~hot & (_shared(anchor, cls, x["did"], x["before"], first)
                                    | _shared(anchor, cls, x["did"], x["after"], first))
            for kind, rows in ((DECIDED, removed), (HOT, hot)):
                out.spans(kind, lambda d: 0, *(x[k][rows] for k in ("did", "th", "s", "n")))
            out.spans(ASKED, lambda d: 0, *(x[k][asked] for k in ("did", "th", "s", "n", "m")))
            yield from out.batches()

    return local, reduce


def intervals(payloads) -> tuple[np.ndarray, np.ndarray]:
    """Sorted window ranges of all payloads of a document."""
    halves = [np.frombuffer(p, dtype="<i8").reshape(2, -1) for p in payloads]
    lo, hi = (np.concatenate([h[k] for h in halves]) for k in (0, 1))
    order = np.argsort(lo, kind="stable")
    return merged(lo[order], hi[order])


def _sort_windows(one, two, did):
    """Order by (window, document), the first row of each row's window in that
    order, and which rows a smaller document of the window removes."""
    order = np.lexsort((did, two, one))
    g = groups(one[order], two[order])
    head = np.flatnonzero(np.diff(g, prepend=-1))
    lead = head[g]
    return order, lead, did[order] > did[order][lead]


def _sort_contexts_bytes(x: dict[str, np.ndarray], texts: list[bytes]):
    """(row, window, removed) of every window of contexts, on their bytes."""
    span = x["n"] + SPAN - 1
    at = np.concatenate([[0], np.cumsum(span)])
    buf = np.frombuffer(b"".join(texts), dtype=np.uint8)
    row = np.repeat(np.arange(len(span)), x["n"])
    shift = np.arange(len(row)) - np.repeat(np.cumsum(x["n"]) - x["n"], x["n"])
    start = at[row] + shift
    one, two = windows(buf, start)
    order, lead, removed = _sort_windows(one, two, x["did"][row])
    bytes_at = np.arange(SPAN)
    hit = np.flatnonzero(removed)
    for lo in range(0, len(hit), 1 << 16):  # verify what hashes alike
        k = hit[lo:lo + (1 << 16)]
        same = (buf[start[order[k]][:, None] + bytes_at]
                == buf[start[order[lead[k]]][:, None] + bytes_at]).all(axis=1)
        for i in k[~same].tolist():
            mine = buf[start[order[i]]:start[order[i]] + SPAN].tobytes()
            removed[i] = any(  # the window's rows come in order of documents
                buf[start[o]:start[o] + SPAN].tobytes() == mine and x["did"][row[o]] < x["did"][row[order[i]]]
                for o in order[lead[i]:i].tolist())
    order = order[removed]
    return row[order], shift[order]


def _rows_of(b: pa.RecordBatch):
    return zip(*(b.column(c).to_pylist() for c in ("bucket", "kind", "doc_id", "th", "payload")),
               strict=True)


def _round_two(buckets: int):
    def local(batches):
        """Contexts as bytes by anchor; windows of hot anchors by their hashes."""
        hot, contexts_, texts, held = [], [], [], 0

        def work():
            out = Out()
            if hot:
                x = {k: np.concatenate(v) for k, v in zip(
                    ("one", "two", "did", "th", "s"), zip(*hot, strict=True), strict=True)}
                order, _, r = _sort_windows(x["one"], x["two"], x["did"])
                x = {k: v[order] for k, v in x.items()}
                out.spans(DECIDED, lambda d: d % buckets, x["did"][r], x["th"][r], x["s"][r],
                          np.ones(int(r.sum()), np.int64))
                out.entries(x["one"][~r], buckets, WINDOW, {k: v[~r] for k, v in x.items()}, HOT)
            if contexts_:
                x = {k: np.concatenate(v) for k, v in zip(
                    ("m", "did", "th", "s", "n"), zip(*contexts_, strict=True), strict=True)}
                out.entries(x["m"].astype(U), buckets, CONTEXT, x, ASKED, texts)
            yield from out.batches()

        for b in batches:
            for t, i, h, asked, spans in zip(
                    b.column("text"), *(b.column(c).to_pylist() for c in ("doc_id", "th", "asked", "hot")),
                    strict=True):
                t = t.as_buffer().to_pybytes()
                if spans:
                    lo, hi = intervals(spans)
                    at = np.concatenate([np.arange(a, z) for a, z in zip(lo, hi, strict=True)])
                    one, two = windows(np.frombuffer(t, dtype=np.uint8), at)
                    hot.append((one, two >> U(24), np.full(len(at), i), np.full(len(at), h), at))
                    held += 40 * len(at)
                for p in asked or ():
                    s, n, m = np.frombuffer(p, dtype="<i8").reshape(3, -1)
                    contexts_.append((m, np.full(len(s), i), np.full(len(s), h), s, n))
                    texts += [t[a:z] for a, z in zip(s.tolist(), (s + n + SPAN - 1).tolist(), strict=True)]
                    held += 150 * len(s)
                if held >= 4 * CHUNK:
                    yield from work()
                    hot, contexts_, texts, held = [], [], [], 0
        if hot or contexts_:
            yield from work()

    def reduce(batches):
        out = Out()
        blobs: dict[int, list[bytes]] = {ASKED: [], HOT: []}
        for b in batches:
            for r in _rows_of(b):
                if r[1] == DECIDED:
                    out.rows.append(r)
                else:
                    blobs[r[1]].append(r[4])
        if blobs[HOT]:
            x, _ = WINDOW.unpack_all(blobs[HOT])
            order, _, r = _sort_windows(x["one"], x["two"], x["did"])
            did, th, s = (x[k][order][r] for k in ("did", "th", "s"))
            out.spans(DECIDED, lambda d: 0, did, th, s, np.ones(len(s), np.int64))
        if blobs[ASKED]:
            x, texts = CONTEXT.unpack_all(blobs[ASKED])
            row, shift = _sort_contexts_bytes(x, texts)
            out.spans(DECIDED, lambda d: 0, x["did"][row], x["th"][row], x["s"][row] + shift,
                      np.ones(len(row), np.int64))
        yield from out.batches()

    return local, reduce


def _whole(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs, widened to whole characters."""
    def outward(k: int, step: int) -> int:
        while 0 < k < len(text) and text[k] & 0xC0 == 0x80:
            k += step
        return k

    return (np.array([outward(k, -1) for k in lo.tolist()], dtype=np.int64),
            np.array([outward(k, 1) for k in hi.tolist()], dtype=np.int64))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """Per row: doc_id, the ``carry`` columns as they are, n_bytes, kept (the
    remaining bytes), starts and ends (the maximal removed runs, as byte
    offsets).  With ``characters``, a character that loses one of its bytes
    goes whole, so that ``kept`` is UTF-8."""
    spark = docs.sparkSession
    ship(spark)
    parts = shuffle_partitions(spark)
    sorts = 2 * parts  # a sorting task holds its part several times
    buckets = 4 * sorts
    kind = dict(docs.dtypes)[id_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    # rows that repeat an id are told apart by their texts
    repeated = not ids.groupBy("doc_id").count().filter("count > 1").isEmpty()
    keys = ["doc_id", "th"] if repeated else ["doc_id"]
    th = F.col("th") if repeated else F.lit(0).cast("long").alias("th")
    more = [f"_{c}" for c in carry]
    # "| 0": a plain column would be renamed in one use below and not in the
    # other, and then the two uses of the exchange would not be seen as one
    rows = docs.select(F.col(id_col).cast("long").bitwiseOR(F.lit(0)).alias("doc_id"), *[F.xxhash64(text).alias("th")] * repeated,
                       text.cast("binary").alias("text"), *[F.col(c).alias(f"_{c}") for c in carry])
    sortable = F.col("doc_id").isNotNull() & (F.octet_length("text") >= SPAN)
    long_enough = rows.filter(sortable)

    def sorted_by(df: DataFrame, stages) -> DataFrame:
        local, reduce = stages
        return (df.mapInArrow(trimmed(local), SHAPE).repartition(sorts, "bucket")
                .mapInArrow(trimmed(reduce), SHAPE)
                .select("kind", "doc_id", "th", "payload"))

    one = pinned(sorted_by(long_enough.select("text", "doc_id", th), _round_one(buckets)))

    # the texts are shuffled once: both joins read the same columns of one exchange
    placed = long_enough.repartition(parts, *keys)
    by_kind = [F.collect_list(F.when(F.col("kind") == k, F.col("payload"))).alias(name)
               for k, name in ((ASKED, "asked"), (HOT, "hot"))]
    wanted = one.filter(F.col("kind") != DECIDED).groupBy(*keys).agg(*by_kind)
    asked = placed.join(wanted, keys)
    two = sorted_by(asked.select("text", "doc_id", th, "asked", "hot", *more), _round_two(buckets))
    spans = (one.filter(F.col("kind") == DECIDED).unionByName(two)
             .groupBy(*keys).agg(F.collect_list("payload").alias("spans")))
    none = F.lit(None).cast("array<binary>").alias("spans")
    columns = ["doc_id", "text", "spans", *more]
    joined = placed.join(spans, keys, "left").select(columns).unionByName(
        rows.filter(F.coalesce(~sortable, F.lit(True))).select("doc_id", "text", none, *more))

    def cut(batches):
        for b in batches:
            n, kept, starts, ends = [], [], [], []
            for t, payloads in zip(b.column("text"), b.column("spans").to_pylist(), strict=True):
                t = t.as_buffer().to_pybytes()
                lo = hi = np.zeros(0, np.int64)
                if payloads:
                    lo, hi = intervals(payloads)
                    lo, hi = merged(lo, hi + SPAN - 1)  # windows to the bytes they cover
                    if characters:
                        lo, hi = merged(*_whole(t, lo, hi))
                edges = [0, *np.stack([lo, hi], axis=1).ravel().tolist(), len(t)]
                n.append(len(t))
                kept.append(b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
                starts.append(lo)
                ends.append(hi)
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[b.column(f"_{c}") for c in carry], pa.array(n, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(starts, many), pa.array(ends, many)],
                names=["doc_id", *carry, "n_bytes", "kept", "starts", "ends"])

    types = dict(docs.dtypes)
    shape = ", ".join(["doc_id long", *[f"`{c}` {types[c]}" for c in carry], "n_bytes long", "kept binary",
                       "starts array<long>", "ends array<long>"])
    out = joined.mapInArrow(trimmed(cut), shape)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def summary(cut: DataFrame) -> DataFrame:
    """The digest columns of ``dedup``'s rows."""
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

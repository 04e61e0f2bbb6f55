"""MinHash near-dedup by a multi-index Hamming join.

Each distinct shingle set gets a signature of ``CHUNKS * WIDTH`` symbols of
``BITS`` bits (the low bits of that many minima).  Distance is the number of
unequal symbols, and the join finds every pair up to ``RADIUS``:

* Pigeonhole: of ``CHUNKS`` chunks, two signatures at most
  ``RADIUS = 2 * CHUNKS - 1`` apart have one with at most one unequal symbol.
* Allowed errors are enumerated: a chunk gives one key per symbol it may have
  wrong, made of the other symbols.  Signatures share a key exactly if a chunk
  of theirs has at most that error.

At a similarity of 0.8 a symbol differs with probability 0.2, a chunk of six
has at most one unequal with 0.655, so all ten miss a pair with under 3e-5;
the pairs found beyond ``RADIUS`` are kept as well.

Links are then found without pairing a key's rows with one another:

1. Equal sets are one class, named by its smallest id; the rest works on
   classes.
2. Star: each key's classes are compared with the key's smallest one.  A task
   does this for its own part first and passes on one class per key, so a key
   in a third of all rows costs each task one row.
3. Links confirmed on full sets join classes into components.
4. Hubs: in keys whose classes lie in several components, they are compared
   with the key's most crowded class, the one whose keys hold most classes.  Of
   a text and its many copies with edits that is the text itself.
5. Rest: a class outside its hub's component differs from the hub by more than
   a link allows.  It can only link with another class of the key if the two
   differ from the hub in the same shingles: how many they must share follows
   from the sizes of both differences.  An exact prefix filter finds these:
   shingles of differences are ordered by how few of the hub's classes have
   them, and each class offers only as many of the first ones as leave enough
   behind, once per step of the partner's size.  Copies with edits of their own
   spend these places on shingles that nobody else has, and meet nobody.  No
   link between classes that share a key is lost.

Pairs are checked first on sizes and on 4 bits of each symbol, which pairs at
0.8 pass at more than five standard deviations, then on the full sets of 64-bit
shingle hashes.

Components come from rounds of joins (each class points to its smallest
neighbour, pointers are then shortened); every round is checkpointed.

Defined cases: null or blank text has an empty set, which links with nothing;
fewer words than a shingle count as one shingle; a ``doc_id`` in several rows
takes the smallest component and each row stays; rows with a null ``doc_id``
link with nothing and are kept; an empty table gives no rows.  Columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import LOWER_BYTES, mix, pinned, ship, shuffle_partitions, trimmed
from tidewater.operators.joins import broadcast_if_small

CHUNKS, WIDTH, BITS = 10, 6, 16
RADIUS = 2 * CHUNKS - 1
SYMBOLS = CHUNKS * WIDTH
#: The first check sees 4 bits of each symbol, 15 to a long; this many may differ.
SKETCH = ["s1", "s2", "s3", "s4"]
SKETCH_RADIUS = 27
U = np.uint64
PIECE = 1 << 20

BASE = 0xD1342543DE82EF95
_rng = np.random.default_rng(20)
SEEDS = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.int64).astype(U)
FACTORS = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.int64).astype(U) | U(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.multiply.accumulate(out)


POWER = _powers(BASE, PIECE)
INVERSE = _powers(pow(BASE, -1, 1 << 64), PIECE)
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True


def _word_hashes(buf: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lower-cased words of whole words' bytes."""
    if len(buf) > len(POWER):  # one word beyond a piece: hash its parts
        parts = np.concatenate([_word_hashes(buf[k:k + PIECE], spaces) for k in range(0, len(buf), PIECE)])
        return mix(np.array([_fold(parts)], dtype=U))
    low = LOWER_BYTES[buf]
    space = spaces[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    h = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum((low.astype(U) + U(1)) * POWER[:len(buf)], out=h[1:])
    return mix((h[end] - h[start]) * INVERSE[start] + (end - start).astype(U))


def _fold(h: np.ndarray) -> int:
    out = 0
    for x in h.tolist():
        out = (out * BASE + x) % (1 << 64)
    return out


def word_hashes(text: bytes, spaces: np.ndarray = SPACES) -> np.ndarray:
    """Hashes of the words between bytes that ``spaces`` marks, A-Z lower-cased."""
    buf = np.frombuffer(text, dtype=np.uint8)
    if len(buf) <= PIECE:
        return _word_hashes(buf, spaces)
    space = np.flatnonzero(spaces[buf])
    out, at = [], 0
    while at < len(buf):  # cut at a space, or after a word longer than a piece
        k = np.searchsorted(space, at + PIECE)
        cut = len(buf) if at + PIECE >= len(buf) else (
            int(space[k - 1]) + 1 if k and space[k - 1] >= at else
            int(space[k]) + 1 if k < len(space) else len(buf))
        part = buf[at:cut]
        if len(part) > PIECE:
            part = part[~spaces[part]]
        out.append(_word_hashes(part, spaces))
        at = cut
    return np.concatenate(out)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(words, len(w))
    h = np.full(len(w) - n + 1, n, dtype=U)
    for k in range(n):
        h = mix(h * U(BASE) + w[k:len(w) - n + 1 + k])
    return np.unique(h)


def minima(s: np.ndarray, seeds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.empty(len(seeds), dtype=U)
    for k in range(len(seeds)):
        out[k] = ((s ^ seeds[k]) * factors[k]).min()
    return out


def symbols_of(s: np.ndarray) -> np.ndarray:
    return mix(minima(s, SEEDS, FACTORS)) & U((1 << BITS) - 1)


def keys_of(symbols: np.ndarray) -> np.ndarray:
    """One key per chunk and symbol that may differ: a hash of the others."""
    symbols = symbols.reshape(CHUNKS, WIDTH)
    place = (np.arange(SYMBOLS, dtype=U).reshape(CHUNKS, WIDTH) + U(1)) * U(BASE)
    parts = mix(symbols ^ place)
    return mix(parts.sum(axis=1, dtype=U)[:, None] - parts + place).ravel()


def sketch_of(symbols: np.ndarray) -> np.ndarray:
    part = (symbols & U(15)).reshape(len(SKETCH), -1)
    return (part << (U(4) * np.arange(part.shape[1], dtype=U))).sum(axis=1, dtype=U).view(np.int64)


def _signatures(words: int):
    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for t in b.column("text"):
                s = shingles(t.as_buffer().to_pybytes(), words)
                if not len(s):
                    out.append((0,) + (None,) * (3 + len(SKETCH)))
                    continue
                symbols = symbols_of(s)
                out.append((len(s), int(s.sum(dtype=U).astype(np.int64)),
                            int(mix(s ^ U(BASE)).sum(dtype=U).astype(np.int64)),
                            keys_of(symbols).tobytes(), *sketch_of(symbols).tolist()))
            names = ["n_shingles", "k1", "k2", "keys", *SKETCH]
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, pa.binary() if n == "keys" else pa.int64())
                                       for n, c in zip(names, columns, strict=True)]],
                names=["doc_id", *names])
    return run


def _unequal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols of two sketches (rows of longs) differ."""
    x = (a ^ b).view(U)
    x = (x | x >> U(1) | x >> U(2) | x >> U(3)) & U(0x1111111111111111)
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def unequal(left: list[str], right: list[str]) -> Column:
    """The same of columns."""
    total = F.lit(0)
    for a, b in zip(left, right, strict=True):
        x = F.col(a).bitwiseXOR(F.col(b))
        for k in (1, 2):  # x | x >> 1 | x >> 2 | x >> 3
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return total


PAIRS = "a long, b long, near boolean"
STARS = "key long, id long, other long, s1 long, s2 long, s3 long, s4 long, near boolean"


def _sketches(b: pa.RecordBatch) -> np.ndarray:
    return np.stack([np.array(b.column(c)) for c in SKETCH], axis=1)


def _exploded(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of every key of a batch."""
    keys = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in b.column("keys").to_pylist()])
    return keys, np.repeat(np.arange(b.num_rows), SYMBOLS)


def _star_local(batches):
    """Of a task's classes: pairs with the smallest class of each key, and that
    class for the next step (``other`` null)."""
    for b in batches:
        if not b.num_rows:
            continue
        ids, sketch = np.array(b.column("id")), _sketches(b)
        keys, row = _exploded(b)
        order = np.lexsort((ids[row], keys))
        keys, row = keys[order], row[order]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        lead = np.repeat(row[head], np.diff(np.append(head, len(keys))))
        x, y = np.unique(np.stack([lead, row], axis=1)[ids[lead] != ids[row]], axis=0).T
        yield _rows(keys[head], ids[row[head]], None, sketch[row[head]], None)
        yield _rows(mix(ids[x].astype(U) * U(31) + ids[y].astype(U)).view(np.int64), ids[x], ids[y],
                    None, _unequal(sketch[x], sketch[y]) <= SKETCH_RADIUS)


def _rows(key, ids, other, sketch, near) -> pa.RecordBatch:
    i, none = pa.int64(), pa.nulls(len(ids))
    return pa.RecordBatch.from_arrays(
        [pa.array(key, i), pa.array(ids, i), none.cast(i) if other is None else pa.array(other, i),
         *[none.cast(i) if sketch is None else pa.array(sketch[:, k], i) for k in range(len(SKETCH))],
         none.cast(pa.bool_()) if near is None else pa.array(near)],
        names=["key", "id", "other", *SKETCH, "near"])


def _star_merge(batches):
    """The same over the rows that the tasks passed on; a partition holds all
    rows of its keys, sorted by (key, id)."""
    key = lead = of_lead = None
    for b in batches:
        made = np.array(b.column("other").is_valid())
        pairs, single = b.filter(pa.array(made)), b.filter(pa.array(~made))
        parts = [np.stack([np.array(pairs.column(c)) for c in ("id", "other", "near")], axis=1).astype(np.int64)]
        if single.num_rows:
            k, i, sketch = np.array(single.column("key")), np.array(single.column("id")), _sketches(single)
            head = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            size = np.diff(np.append(head, len(k)))
            x, of_x = i[head].copy(), sketch[head].copy()
            if key is not None and k[0] == key:  # goes on from the batch before
                x[0], of_x[0] = lead, of_lead
            key, lead, of_lead = k[-1], x[-1], of_x[-1]
            x, of_x = np.repeat(x, size), np.repeat(of_x, size, axis=0)
            at = np.flatnonzero(x != i)
            parts.append(np.stack([x[at], i[at], _unequal(of_x[at], sketch[at]) <= SKETCH_RADIUS], axis=1))
        found = np.unique(np.concatenate(parts), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(found[:, 2] > 0)], names=["a", "b", "near"])


def star_pairs(classes: DataFrame, parts: int) -> DataFrame:
    """(a, b, near): classes that share a key with the key's smallest one, or
    with the smallest of their task; whether their sketches are close."""
    passed = classes.select("id", "keys", *SKETCH).mapInArrow(trimmed(_star_local), STARS)
    return (passed.repartition(parts, "key").sortWithinPartitions("key", "id")
            .mapInArrow(trimmed(_star_merge), PAIRS).groupBy("a", "b").agg(F.max("near").alias("near")))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, on full sets."""
    one = sets.select(F.col("id").alias("a"), F.col("set").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - both
    # sizes first: a pair that they rule out needs no intersection
    fits = F.least(F.size("x"), F.size("y")) * 100 >= F.greatest(F.size("x"), F.size("y")) * percent
    return (pairs.join(two, "b").join(one, "a").filter(fits).filter(both * 100 >= either * percent)
            .select("a", "b"))


def sets_of(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(id, set) of the classes that occur in pairs; ``texts``: (id, text)."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sets = [shingles(t.as_buffer().to_pybytes(), words).view(np.int64) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "set"])

    ids = pinned(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    # up to the limit of a broadcast the texts stay where they are
    return texts.join(broadcast_if_small(ids), "id", "left_semi").mapInArrow(
        trimmed(run), "id long, set array<long>")


def links_of(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    return confirmed(pairs, pinned(sets_of(pairs, texts, words)), percent)


def components(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest id that links (a, b) reach, for all ids in links.

    Alternates large-star (larger neighbours to the smallest one) and
    small-star (the others to the smallest one) until no link changes.  Each
    step is one aggregate and one join on distinct links.
    """
    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = pinned(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                   .filter("u < v").distinct())
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("m").alias("u"), "v").distinct())
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        other = F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u"))
        small = (large.join(low, "v").select(F.col("m").alias("u"), other.alias("v"))
                 .unionByName(low.select(F.col("m").alias("u"), "v")).distinct())
        edges = pinned(small)
        now = state(edges)
        if now == before:
            root = F.col("u").alias("comp")
            return edges.select(F.col("v").alias("id"), root).unionByName(
                edges.select(F.col("u").alias("id"), root).distinct())
        before = now


def crowded(classes: DataFrame) -> DataFrame:
    """(key, id, n_shingles, sketch, crowd): every key of the classes, and how
    many classes share a key with each."""
    def explode(batches):
        for b in batches:
            if b.num_rows:
                keys, row = _exploded(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), *[b.column(c).take(pa.array(row)) for c in ("id", "n_shingles", *SKETCH)]],
                    names=["key", "id", "n_shingles", *SKETCH])

    rows = classes.select("id", "keys", "n_shingles", *SKETCH).mapInArrow(
        explode, "key long, id long, n_shingles long, s1 long, s2 long, s3 long, s4 long")
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = pinned(rows.join(shared, "key"))
    crowd = rows.groupBy("id").agg(F.sum("n").alias("crowd"))
    return pinned(rows.drop("n").join(crowd, "id"))


def in_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """The rows with the component of each class."""
    return rows.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def mixed(known: DataFrame, pick: Column) -> DataFrame:
    """(key, pick) of the keys that have classes in several components."""
    return (known.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("z"), pick)
            .filter("x < z").drop("x", "z"))


def _may_link(left: list[str], right: list[str], n: str, m: str, percent: int) -> Column:
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (unequal(left, right) <= SKETCH_RADIUS)


OTHER = ["o1", "o2", "o3", "o4"]


def hub_pairs(rows: DataFrame, comps: DataFrame, percent: int, texts: DataFrame, words: int) -> DataFrame:
    """Pairs of each key's most crowded class with those in other components."""
    known = in_components(rows, comps)
    hubs = mixed(known, F.max(F.struct("crowd", -F.col("id"), "id", "comp", "n_shingles", *SKETCH)).alias("hub"))
    hubs = hubs.select("key", F.col("hub.id").alias("h"), F.col("hub.comp").alias("hc"), F.col("hub.n_shingles")
                       .alias("m"), *[F.col(f"hub.{c}").alias(o) for c, o in zip(SKETCH, OTHER, strict=True)])
    return (known.join(hubs, "key").filter((F.col("comp") != F.col("hc"))
                                           & _may_link(SKETCH, OTHER, "n_shingles", "m", percent))
            .select(F.least("h", "id").alias("a"), F.greatest("h", "id").alias("b")).distinct())


def differences(asks: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(id, hub, of_hub, size, diff): the shingles that only one of a class and
    its hub ``h`` has.  ``hub`` names the hub's set."""
    sets = pinned(sets_of(asks.select(F.col("id").alias("a"), F.col("h").alias("b")), texts, words))
    hubs = sets.select(F.col("id").alias("h"), F.col("set").alias("of"), F.xxhash64("id", "set").alias("hub"))
    both = asks.join(sets, "id").join(hubs, "h")
    return both.select("id", "hub", F.size("of").alias("of_hub"), F.size("set").alias("size"),
                       F.concat(F.array_except("set", "of"), F.array_except("of", "set")).alias("diff"))


#: A step of the partner's size is one shingle in this many of the hub's.
FINE = 128


def offers(size: int, diff: int, of_hub: int, percent: int) -> tuple[int, list[tuple[int, int]]]:
    """Own step, and (step of the partner, places at the front that leave
    enough) of a set that differs from the hub in ``diff`` shingles.

    With slack s = more * diff - less * size, two sets at the threshold share
    (s + s') / (2 * more) of their differences at least.
    """
    more, less = 100 + percent, 100 - percent
    step = 2 * more * max(1, of_hub // FINE)
    slack, apart = more * diff - less * size, less * size // percent + 1
    low = more * (diff - apart) - less * size * 100 // percent - 1
    high = more * (diff + apart) - less * size * percent // 100
    out = []
    for k in range(low // step, high // step + 1):
        share = max(1, -(-(slack + max(k * step, low)) // (2 * more)))
        if share <= diff:
            out.append((k, diff - share + 1))
    return slack // step, out


def _offered(percent: int):
    def run(batches):
        names = ["hub", "shingle", "own", "partner", "id", "size", "diff", "place"]
        for b in batches:
            for i, hub, of_hub, size, diff, order in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own, steps = offers(size, diff, of_hub, percent)
                alone = diff - len(order)  # shingles that nobody else has come first
                rows = [(hub, x, own, k, i, size, diff, alone + at) for k, places in steps
                        for at, x in enumerate(order[:max(0, places - alone)])]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
    return run


def front_rows(diffs: DataFrame, percent: int) -> DataFrame:
    """(hub, shingle, own, partner, id, size, diff, place): what each class
    offers to classes of each step."""
    rows = diffs.select("hub", "id", "size", "of_hub", F.size("diff").alias("diff"), F.explode("diff").alias("shingle"))
    shared = rows.groupBy("hub", "shingle").agg(F.count("*").alias("n")).filter("n > 1")
    sets = (rows.join(shared, ["hub", "shingle"]).groupBy("id", "hub", "of_hub", "size", "diff")
            .agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).getField("shingle").alias("ranked")))
    return sets.mapInArrow(trimmed(_offered(percent)), "hub long, shingle long, own long, partner long, "
                                                       "id long, size long, diff long, place long")


def rest_pairs(rows: DataFrame, comps: DataFrame, percent: int, texts: DataFrame, words: int) -> DataFrame:
    """Pairs of classes that share a key and may link, in different components,
    one of them outside the component of the key's hub."""
    known = in_components(rows, comps)
    hubs = mixed(known, F.max(F.struct("crowd", -F.col("id"), "id", "comp")).alias("hub"))
    asks = pinned(known.join(hubs, "key").filter("id != hub.id").select(
        "id", F.col("hub.id").alias("h"), "comp", (F.col("comp") != F.col("hub.comp")).alias("asks"), *SKETCH)
        .distinct())
    classes = asks.groupBy("id", "comp", *SKETCH).agg(F.max("asks").alias("asks"))
    front = pinned(front_rows(pinned(differences(asks.select("id", "h"), texts, words)), percent)
                   .join(classes, "id"))

    left = front.filter("asks").select(
        "hub", "shingle", F.col("own").alias("partner"), F.col("partner").alias("own"), F.col("id").alias("h"),
        F.col("comp").alias("hc"), F.col("size").alias("m"), F.col("diff").alias("d"), F.col("place").alias("at"),
        *[F.col(c).alias(o) for c, o in zip(SKETCH, OTHER, strict=True)])
    share = (100 + percent) * (F.col("diff") + F.col("d")) - (100 - percent) * (F.col("size") + F.col("m"))
    left_over = F.least(F.col("diff") - F.col("place"), F.col("d") - F.col("at"))
    # of two that both ask, the larger id does
    return (left.join(front, ["hub", "shingle", "own", "partner"]).filter(
        (F.col("comp") != F.col("hc")) & (~F.col("asks") | (F.col("id") < F.col("h")))
        & (left_over * 2 * (100 + percent) >= share) & _may_link(SKETCH, OTHER, "size", "m", percent))
        .select(F.least("h", "id").alias("a"), F.greatest("h", "id").alias("b")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Links are pairs of texts with ``100 * intersection >= percent * union`` of
    their sets of ``words``-word shingles.
    """
    ship(docs.sparkSession)
    parts = shuffle_partitions(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    signed = pinned(rows.mapInArrow(
        trimmed(_signatures(words)), "doc_id long, n_shingles long, k1 long, k2 long, keys binary, "
                            "s1 long, s2 long, s3 long, s4 long"))
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    which = ["k1", "k2", "n_shingles"]
    classes = pinned(full.groupBy(*which).agg(
        F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("keys", *SKETCH)]))
    member = (full.select("doc_id", *which).join(classes.select("id", *which), which)
              .select("doc_id", "id").distinct())
    # rows that repeat a doc_id with other texts are one node of the graph
    several = (member.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z")
               .join(member, "doc_id").select("a", F.col("id").alias("b")))

    texts = rows.withColumnRenamed("doc_id", "id")
    pairs = pinned(star_pairs(classes, parts))
    tested = pairs.filter("near").select("a", "b")
    comps = components(links_of(tested, texts, words, percent).unionByName(several))
    in_play = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    shared = crowded(classes.join(in_play, "id", "left_semi"))
    for more_pairs in (hub_pairs, rest_pairs):
        more = pinned(more_pairs(shared, comps, percent, texts, words).join(tested, ["a", "b"], "left_anti"))
        if not more.isEmpty():
            known = comps.select(F.col("comp").alias("a"), F.col("id").alias("b"))
            comps = components(links_of(more, texts, words, percent).unionByName(known))
            tested = tested.unionByName(more)

    found = (member.join(comps, "id", "left").groupBy("doc_id")
             .agg(F.min(F.coalesce("comp", "id")).alias("comp")))
    comp = F.coalesce(F.when(F.col("n_shingles") > 0, F.col("comp")), F.col("doc_id"))
    return (signed.select("doc_id", "n_shingles").join(found, "doc_id", "left")
            .select(F.col("doc_id").cast(kind).alias("doc_id"), "n_shingles",
                    comp.cast(kind).alias("component_id"),
                    F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept")))

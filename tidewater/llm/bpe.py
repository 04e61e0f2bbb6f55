"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens.  It starts with one state and a loop for each
character; each merge ``u v -> uv``, in order of rank, is one gadget on it:

* the state that ``u`` leads to is split, and the copy has no arc for ``v``
  (after ``u``, an unmerged ``v`` can no longer follow);
* the new token ``uv`` gets an arc wherever ``u`` has one, and leads to where
  ``v`` led before the split.

The result is deterministic and accepts exactly the token sequences that the
merges produce.  A token leads to the same state from everywhere, so a state is
named by its token, and the arcs it lacks follow from the gadgets that touched
it: the token's right edge (the tokens it ends in, each with the rank at which
a merge used it up) and the next token's left edge.  ``compile_merges`` keeps
these two edge tables; arcs are looked up in them once and then stored.

A pre-split word is encoded by running the automaton over its letters, longest
arc first.  Exactly one path spells any beginning of a word, so a place from
which no arc leads on is never tried twice, and the time is linear.  Decoding emits the labels of
the arcs, joined as the tokenizer does.

Text work runs in ``mapInArrow`` tasks, one batch of documents at a time; no
shuffle, so no key can be hot.  Words seen before are remembered per task, at
most ``REMEMBERED`` of them, which bounds memory and changes no result.

Defined cases: null or empty text has no tokens and an empty decoded text;
control strings in the text get their special ids, as in the library; repeated
rows keep their rows; an empty table gives no rows.  Columns other than the id
and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewater.llm.common import ship, trimmed

REMEMBERED = 120_000
NEVER = 1 << 30

#: Fixed value: the split pattern of the tokenizer file, checked on loading.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}"))
SPACE = regex.compile(r"\p{White_Space}+")
#: str.split() separates at these, the tokenizer does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The letter of each byte: printable Latin-1 stands for itself, the other
    bytes take the code points from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def compile_merges(merges: list[tuple[str, str]]) -> tuple[dict, dict, dict]:
    """Edge tables after all gadgets: (right edges, left edges, gadget ranks).

    An edge is a tuple of (token, rank): the gadgets of the token that count
    are those before that rank (right) or up to it (left).
    """
    right: dict[str, tuple] = {}
    left: dict[str, tuple] = {}
    rank: dict[tuple[str, str], int] = {}
    for k, (u, v) in enumerate(merges):
        for t in (u, v):  # characters: the loops of the first state
            if t not in right:
                right[t] = left[t] = ((t, NEVER),)
        t = u + v
        rank[u, v] = k
        right[t] = ((t, NEVER), (v, k), *right[v][1:])
        left[t] = ((t, NEVER), (u, k), *left[u][1:])
    return right, left, rank


class Automaton:
    """Words to ids and back, for one tokenizer file."""

    def __init__(self, path: str):
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are written as little-endian 32-bit integers")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        splits = [x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in x]
        if model["type"] != "BPE" or splits != [SPLIT] or spec["decoder"] is not None:
            raise ValueError(f"{path}: not a word-end BPE tokenizer of the expected form")
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.right, self.left, self.rank = compile_merges([tuple(m) for m in model["merges"]])
        self.arcs: dict[tuple[str, str], bool] = {}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_at = regex.compile("|".join(
            regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.longest = max(len(t.removesuffix(self.end)) for t in self.ids)
        self.letters = byte_letters()
        self.seen: dict[str, bytes] = {}
        self.seen_words: dict[str, bytes] = {}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.labels = [b""] * size
        for t, i in [*self.ids.items(), *self.special.items()]:
            self.labels[i] = t.encode()

    def arc(self, state: str, token: str) -> bool:
        """Whether the state after ``state`` has an arc for ``token``."""
        rank, known = self.rank, True
        starts = self.left.get(token, ((token, NEVER),))
        for u, until_u in self.right.get(state, ((state, NEVER),)):
            for v, until_v in starts:
                k = rank.get((u, v))
                if k is not None and k < until_u and k <= until_v:
                    known = False
        if len(self.arcs) > 2 * REMEMBERED:
            self.arcs.clear()
        self.arcs[state, token] = known
        return known

    def word(self, word: str) -> list[int]:
        """Ids of one pre-split word: the longest arc first, back where none
        leads on.  A place that failed once is dead, since only one path
        through the automaton spells the letters before it."""
        letters = word if word.isascii() and word.isalpha() else "".join(
            [self.letters[b] for b in word.encode()])
        n, ids, tail, longest, arcs = len(letters), self.ids, self.end, self.longest, self.arcs
        path: list[str] = []
        dead: set[int] = set()
        at, state, end = 0, None, min(n, longest)
        while at < n:
            while end > at:
                t = letters[at:end] if end < n else letters[at:] + tail
                if t in ids and end not in dead:
                    known = state is None or arcs.get((state, t))
                    if known is None:
                        known = self.arc(state, t)
                    if known:
                        break
                end -= 1
            if end > at:
                path.append(t)
                at, state, end = end, t, min(n, end + longest)
            else:
                dead.add(at)
                last = path.pop()
                end = at - 1
                at -= len(last)
                state = path[-1] if path else None
        return [ids[t] for t in path]

    def piece(self, word: str) -> bytes:
        out = self.seen_words.get(word)
        if out is None:
            out = array("I", self.word(word)).tobytes()
            if len(self.seen_words) >= REMEMBERED:
                self.seen_words.clear()
            if len(word) <= 64:
                self.seen_words[word] = out
        return out

    def chunk(self, chunk: str) -> bytes:
        """Ids of a run of text without white space."""
        if chunk.isascii():
            text = chunk.lower()
            out = self.piece(text) if text.isalpha() else b"".join(
                [self.piece(w) for w in PIECES.findall(text)])
        else:
            text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
            out = b"".join([self.piece(w) for w in PIECES.findall(text)])
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        if len(chunk) <= 64:
            self.seen[chunk] = out
        return out

    def _plain(self, text: str) -> list[bytes]:
        odd = any(c in text for c in NOT_SPACE)
        seen = self.seen.get
        return [seen(w) or self.chunk(w) for w in (SPACE.split(text) if odd else text.split())]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not any(x in text for x in self.special):
            return b"".join(self._plain(text))
        out, at = [], 0
        for m in self.special_at.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append(array("I", [self.special[m[0]]]).tobytes())
            at = m.end()
        return b"".join(out + self._plain(text[at:]))

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text."""
        return b" ".join(map(self.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


COLUMNS = {"n_tokens": "long", "ids": "binary", "decoded": "binary",
           "ids_sha256": "string", "decoded_sha256": "string"}


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """Per row: the id and the ``keep`` columns of ``COLUMNS``.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` is what
    decoding those ids gives, in UTF-8.
    """
    ship(docs.sparkSession)
    rows = docs.select(id_col, text_col)
    kind = dict(rows.dtypes)[id_col]

    def run(batches):
        a = Automaton(path)  # ends with the task: workers outlive it
        for batch in batches:
            out: dict[str, list] = {c: [] for c in keep}
            for text in batch.column(1):
                ids = a.encode(text.as_py() or "")
                value = {"n_tokens": len(ids) // 4, "ids": ids}
                if "decoded" in out or "decoded_sha256" in out:
                    value["decoded"] = a.decode(ids)
                    if "decoded_sha256" in out:
                        value["decoded_sha256"] = hashlib.sha256(value["decoded"]).hexdigest()
                if "ids_sha256" in out:
                    value["ids_sha256"] = hashlib.sha256(ids).hexdigest()
                for c in keep:
                    out[c].append(value[c])
            types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(out[c], types[COLUMNS[c]]) for c in keep]],
                names=[id_col, *keep])

    return rows.mapInArrow(trimmed(run), ", ".join(
        [f"`{id_col}` {kind}", *[f"{c} {COLUMNS[c]}" for c in keep]]))

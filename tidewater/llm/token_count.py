"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at control strings, each of which is one token, and split into
words by the tokenizer's pattern.  A word starts as a linked list of its bytes.
A heap holds every adjacent pair that has a merge, lowest rank first and then
leftmost; popping a pair that is still there joins its two nodes and pushes the
pairs with the new neighbours.  A pair that lost a node since it was pushed no
longer agrees with the list and is passed over.  The count of a word is its
bytes minus its merges: no token identifiers are made.

A word of n bytes costs n log n, whatever its letters.  Counts of words seen
before are remembered per worker, at most ``REMEMBERED`` words of at most
``WORD`` letters, which bounds memory and changes no result.  Work runs in
``mapInArrow`` tasks on whole rows; no shuffle, so no key can be hot, and a lost
executor costs its tasks again.

Defined cases: null and empty texts have 0 bytes and 0 tokens; a very long text
is split word by word, so beyond the text itself only its longest word is held;
repeated rows keep their rows; an empty table gives no rows; columns other than
the id and the text are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewater.llm.bpe import byte_letters
from tidewater.llm.common import ship

#: Words whose counts a worker remembers, and the letters of such a word.
REMEMBERED, WORD = 200_000, 64
#: Characters from which on the words of a text are taken one by one.
LONG = 1 << 20

#: Fixed value: the pattern by which byte-level tokenizers split words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = regex.compile(SPLIT.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def byte_level_file(path: str) -> dict:
    """The tokenizer file, if it is a byte-level BPE that splits by ``SPLIT``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if (model["type"] != "BPE" or spec["normalizer"] or spec["post_processor"] or pre["type"] != "ByteLevel"
            or pre["add_prefix_space"] or not pre["use_regex"] or model["end_of_word_suffix"]
            or model.get("ignore_merges") or any(t["lstrip"] or t["rstrip"] or t["single_word"]
                                                 for t in spec["added_tokens"])):
        raise ValueError(f"{path}: not a byte-level BPE tokenizer of the expected form")
    return spec


class Counter(dict):
    """Word -> number of its tokens, for one tokenizer file."""

    def __init__(self, path: str):
        super().__init__()
        spec = byte_level_file(path)
        number = {c: b for b, c in enumerate(byte_letters())}
        #: (left symbol, right symbol) -> (rank, symbol of the two joined)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (u, v) in enumerate(spec["model"]["merges"]):
            joined = number.setdefault(u + v, len(number))
            self.merges.setdefault((number[u], number[v]), (rank, joined))
        control = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.control = regex.compile("|".join(map(regex.escape, control)) or r"(?!)")

    def __missing__(self, word: str) -> int:
        symbols = word.encode()
        n = len(symbols) - self.merged(symbols)
        if len(word) <= WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n

    def merged(self, word: bytes) -> int:
        """How many merges the word goes through."""
        merges, size = self.merges, len(word)
        node = list(word)                       # symbol at each place, None once joined away
        after = list(range(1, size + 1))        # the linked list
        before = list(range(-1, size - 1))
        heap = []
        for at in range(size - 1):
            found = merges.get((node[at], node[at + 1]))
            if found:
                heap.append((found[0], at, found[1], node[at], node[at + 1]))
        heapq.heapify(heap)
        done = 0
        while heap:
            _, at, joined, left, right = heapq.heappop(heap)
            nxt = after[at]
            if node[at] != left or nxt >= size or node[nxt] != right:
                continue
            done += 1
            node[at], node[nxt] = joined, None
            end = after[at] = after[nxt]
            if end < size:
                before[end] = at
                found = merges.get((joined, node[end]))
                if found:
                    heapq.heappush(heap, (found[0], at, found[1], joined, node[end]))
            start = before[at]
            if start >= 0:
                found = merges.get((node[start], joined))
                if found:
                    heapq.heappush(heap, (found[0], start, found[1], node[start], joined))
        return done

    def plain(self, text: str) -> int:
        words: Iterator[str] | list[str] = (PIECES.findall(text) if len(text) < LONG
                                            else (m[0] for m in PIECES.finditer(text)))
        return sum(map(self.__getitem__, words))

    def count(self, text: str) -> int:
        """Tokens of a text, each control string in it being one."""
        total = at = 0
        for m in self.control.finditer(text):
            total += self.plain(text[at:m.start()]) + 1
            at = m.end()
        return total + self.plain(text[at:] if at else text)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: the id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit)."""
    ship(docs.sparkSession)
    rows = docs.select(id_col, text_col)
    kind = dict(rows.dtypes)[id_col]

    def run(batches):
        count = counter(path).count
        for batch in batches:
            sizes, tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                tokens.append(count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")

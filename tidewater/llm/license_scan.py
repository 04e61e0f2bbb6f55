"""License scans: positional rare-token index over built-in functions.

Templates give words at relative positions.  A template's *key* words are
mandatory, its *context* words only raise the score.

1. Every text is cut into words; of each word that occurs in some template the
   position is kept (its posting).  Only these postings are written out.
2. Document frequencies of the template words are counted over all documents.
   They rank each template's words by IDF; the driver gets one count per
   template word, at most as many as the templates have words.
3. A template is looked up by its two highest-IDF key words: their postings,
   shifted by their relative positions, are intersected, which leaves possible
   starts.  The other key words then verify the mandatory phrase at each.

All of it is array functions within a row: no shuffle of text, no Python, and
no group that a hot source or a repeated text could make large.  The IDF order
changes the cost, never the result.

Defined cases: null text counts as empty; a text without words has zero places,
null first and last word, empty labels and score 0; every place counts, and
repeated rows each get their row; an empty table gives no rows.  Columns other
than the id and the text are ignored.  A very long text costs in proportion to
its length, and n log n in the places of a template that it repeats.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import lower_ascii, pinned

#: What separates words.  A-Z counts as a letter here: it is lower-cased later.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases whose places are counted, with their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Wording of public licences.  "_" stands for any one word;
#: words before and after the bars are context.
TEMPLATES = [
    ("licensed under | apache license | version 2 0", "apache-2.0"),
    ("redistributions | redistribution _ use _ source _ binary forms | with", "bsd"),
    ("licensed under | cc by nc |", "cc-by-nc"),
    ("licensed under | cc by nd |", "cc-by-nd"),
    ("licensed under | cc by sa |", "cc-by-sa"),
    ("| creative commons zero |", "cc0"),
    ("| gnu affero general public license | version", "agpl"),
    ("licensed under _ | gnu general public license | version", "gnu-gpl"),
    ("| permission _ use copy modify _ _ distribute |", "isc"),
    ("| lesser general public license |", "lgpl"),
    ("released under _ | mit license |", "mit"),
    ("| permission _ hereby granted free _ charge |", "mit"),
    ("| mozilla public license | version", "mpl"),
    ("| unencumbered software released into _ public domain |", "unlicense"),
]


def compile_template(template: str) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
    """(key words, context words), each with its offset from the first key word."""
    before, key, after = (part.split() for part in template.split("|"))
    at = lambda words, start: [(w, start + k) for k, w in enumerate(words) if w != "_"]
    return at(key, 0), at(before, -len(before)) + at(after, len(key))


def all_templates() -> list[tuple[str, bool, list, list]]:
    """(label, counts as base, key words, context words)."""
    return ([(label, True, *compile_template(f"| {phrase} |")) for phrase, label in BASE]
            + [(label, False, *compile_template(t)) for t, label in TEMPLATES])


def _postings(word: str, offset: int) -> Column:
    """Starts that an occurrence of ``word`` at ``offset`` would mean."""
    return F.transform(F.filter("toks", lambda t: t["w"] == F.lit(word)),
                       lambda t: t["p"] - F.lit(offset))


def _most(starts: Column, context: list[tuple[str, int]]) -> Column:
    """The largest number of context words that stand around one of the starts.

    Each context word keeps the starts that it stands by; in their sorted union
    the longest run of equal starts is the number: n log n in the postings.
    """
    kept = F.array_sort(F.flatten(F.array(
        *[F.array_intersect(starts, _postings(*x)) for x in context])))

    def step(a: Column, p: Column) -> Column:
        run = F.when(a["at"] == p, a["run"] + F.lit(1)).otherwise(F.lit(1))
        return F.struct(p.alias("at"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    none = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("run"), F.lit(0).alias("best"))
    return F.aggregate(kept, none, step, lambda a: a["best"])


def _meet(parts: list[Column]) -> Column:
    return reduce(F.array_intersect, parts)


def word_postings(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """Per row: id, n_words, toks = (position, word) of each vocabulary word.

    Splitting at the separators reads a text once.  Lower-casing is left to
    the words: ``lower`` finds a superset (it also folds other alphabets), and
    the exact A-Z folding decides on what it lets through.
    """
    words = F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), GAP, -1), "")
    listed = docs.select(id_col, words.alias("words"))
    n = F.size("words")
    places = F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>")), lambda p: F.lower(F.get("words", p)).isin(*vocabulary))
    toks = F.transform(places, lambda p: F.struct(
        p.alias("p"), lower_ascii(F.get("words", p)).alias("w")))
    return listed.select(id_col, n.cast("long").alias("n_words"),
                         F.filter(toks, lambda t: t["w"].isin(*vocabulary)).alias("toks"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, and ``places``: (label, start) of every verified place."""
    templates = all_templates()
    vocabulary = sorted({w for *_, key, context in templates for w, _ in key + context})
    toks = pinned(word_postings(docs, id_col, text_col, vocabulary))
    df = {r["w"]: r["count"] for r in toks.select(F.explode(F.array_distinct(
        F.col("toks.w"))).alias("w")).groupBy("w").count().collect()}

    found = toks
    for k, (_, _, key, _) in enumerate(templates):
        ranked = sorted(key, key=lambda x: (df.get(x[0], 0), x))
        # the two rarest first: what is left of them is all that gets verified
        found = found.withColumn(f"s{k}", _meet([_postings(*x) for x in ranked]))
    starts = [F.col(f"s{k}") for k in range(len(templates))]
    label = [t[0] for t in templates]
    base = [k for k, t in enumerate(templates) if t[1]]
    hit = [F.size(s) > 0 for s in starts]

    def joined(ks) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(
            *[F.when(hit[k], F.lit(label[k])) for k in ks])))), ",")

    def score(k: int) -> Column:
        _, _, key, context = templates[k]
        total = float(len(key) + len(context))
        if not context:
            return F.when(hit[k], F.lit(1.0)).otherwise(F.lit(0.0))
        return F.when(hit[k], (_most(starts[k], context) + F.lit(len(key))) / F.lit(total)).otherwise(F.lit(0.0))

    base_starts = F.flatten(F.array(*[starts[k] for k in base]))
    def placed(k: int) -> Column:
        return F.transform(starts[k], lambda s: F.struct(
            F.lit(label[k]).alias("label"), s.alias("start")))

    places = F.flatten(F.array(*[placed(k) for k in range(len(templates))]))
    return found.select(
        id_col, "n_words", F.size(base_starts).cast("long").alias("n_base"),
        F.array_min(base_starts).cast("long").alias("first_word"),
        F.array_max(base_starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(range(len(templates))).alias("labels"),
        F.greatest(*[score(k) for k in range(len(templates))]).alias("score"),
        places.alias("places"))

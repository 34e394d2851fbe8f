"""Spelling variants of words: pairs one edit apart found by pivotal grams.

* Grams. A word's bigrams are ordered by their frequency among all words
  (rarest first). One edit changes at most two bigrams, so of two *disjoint*
  bigrams one survives, moved by at most one place: the two pivots, chosen by
  dynamic programming as the disjoint pair of least total frequency among the
  word's three rarest bigrams (the prefix).
* Index. Of two words one edit apart, take the one whose prefix ends earlier
  in the order: its surviving pivot is in the other's prefix (with all places
  of the prefix's last bigram). So pivots are joined with prefixes on (bigram,
  place, length): a replaced letter keeps place and length, an inserted or
  deleted one changes the length by one and the place by nothing or the same.
* Verification by edit distance inside the join: only true pairs leave it.

Counts, links, forms and roots are joins and grouped aggregates over distinct
words; texts are only scanned and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import spool

PIVOTS = 2                               # disjoint bigrams: one more than edits
PREFIX = 3                               # bigrams one edit can change, and one more
BUCKETS = 1 << 16                        # of bigram frequencies

# Letters of a run: A-Z, a-z, U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GRAMS = "word string, size int, n bigint, pivot boolean, gram string, place int"


def runs(docs: DataFrame, min_points: int = 6) -> DataFrame:
    """(doc_id, run): every maximal run of letters with at least ``min_points``
    code points in every whole text, A-Z lower-cased. Null text has none."""
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    found = F.regexp_extract_all(lower, F.lit("[%s]{%d,}" % (LETTERS, min_points)), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def count_words(words: DataFrame, min_points: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the words (column ``word``) that are long and frequent
    enough. Null words are none."""
    return (words.where(F.char_length("word") >= min_points).groupBy("word")
            .agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _bucket(gram: str) -> int:
    """Bigrams are at most (code points)^2, buckets a fixed number."""
    a, b = map(ord, gram)
    return (a * 31337 + b) % BUCKETS


def pivots(grams: list[tuple[int, int]], count: int = PIVOTS) -> list[int]:
    """Places of the ``count`` disjoint bigrams of least total cost.

    ``grams``: (place, cost) by place. Dynamic programming over the places:
    the best choice of j bigrams among the first i either leaves the i-th out
    or adds it to the best j - 1 that end two places before it.
    """
    none = (float("inf"), ())
    best = [[(0, ())] + [none] * count]
    for i, (place, cost) in enumerate(grams):
        before = max((j for j in range(i) if grams[j][0] <= place - 2), default=-1) + 1
        row = [(0, ())]
        for j in range(1, count + 1):
            total, places = best[before][j - 1]
            row.append(min(best[i][j], (total + cost, (*places, place))))
        best.append(row)
    return list(best[-1][count][1])


def _index_rows(batches: Iterator[pa.RecordBatch], frequency: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The pivots and prefix bigrams of every word."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for at, word in enumerate(batch.column(0).to_pylist()):
            grams = sorted((int(frequency[_bucket(word[i: i + 2])]), word[i: i + 2], i)
                           for i in range(len(word) - 1))
            last = grams[PREFIX - 1][:2]
            prefix = [g for g in grams if g[:2] <= last]
            chosen = pivots(sorted((i, cost) for cost, _, i in prefix))
            for pivot, places in ((True, chosen), (False, [i for _, _, i in prefix])):
                for i in places:
                    for column, x in zip(out, (at, pivot, word[i: i + 2], i)):
                        column.append(x)
        rows = pa.array(out[0], pa.int32())
        yield pa.record_batch([*(batch.column(i).take(rows) for i in range(3)), pa.array(out[1], pa.bool_()),
                               pa.array(out[2], pa.string()), pa.array(out[3], pa.int32())],
                              names=["word", "size", "n", "pivot", "gram", "place"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb), a < b: the pairs of ``words`` (word, n) that differ by
    exactly one inserted, deleted or replaced code point, each once. Words need
    at least four code points and must be distinct."""
    words = words.select("word", F.char_length("word").cast("int").alias("size"), "n")
    places = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda i: F.substring("word", i, F.lit(2)))
    point = lambda i: F.ascii(F.substring("gram", i, 1)).cast("bigint")
    # the frequency table has BUCKETS rows at most, whatever the alphabet
    counted = (words.select(F.explode(places).alias("gram"))
               .groupBy(((point(1) * 31337 + point(2)) % BUCKETS).alias("bucket")).count())
    frequency = np.zeros(BUCKETS, dtype=np.int64)
    for r in counted.collect():
        frequency[r["bucket"]] = r["count"]
    index = spool(words.mapInArrow(lambda it: _index_rows(it, frequency), _GRAMS), "grams")

    held = index.where("NOT pivot").select("gram", "place", "size", F.col("word").alias("b"), F.col("n").alias("nb"))
    # where a surviving pivot can be in a word that is as long, longer, shorter
    moves = F.array(*(F.struct(F.lit(s).alias("s"), F.lit(p).alias("p"))
                      for s, p in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))))
    asked = (index.where("pivot").withColumn("m", F.explode(moves))
             .select("gram", (F.col("place") + F.col("m.p")).alias("place"), (F.col("size") + F.col("m.s")).alias("size"),
                     F.col("word").alias("a"), F.col("n").alias("na")))
    met = (asked.join(held, ["gram", "place", "size"])
           .where((F.col("a") != F.col("b")) & (F.levenshtein("a", "b", 1) == 1)))
    first = F.col("a") < F.col("b")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    return met.select(pick("a", "b").alias("a"), pick("na", "nb").alias("na"),
                      pick("b", "a").alias("b"), pick("nb", "na").alias("nb")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of each word's chain of forms.

    Pointer doubling: every round doubles the steps of all words; counts grow
    along a chain, so there are no cycles and few rounds."""
    jumps = spool(forms.select("word", F.col("form").alias("root")), "jumps")
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumps = spool(jumps.join(ahead, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")),
                      "jumps")
        if jumps.where("on").limit(1).count() == 0:
            return jumps.select("word", "root")


def variants(words: DataFrame, *, ratio: int = 5) -> DataFrame:
    """The form and root of every word of ``words`` (word, n).

    Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. A word's form is its near word of largest ``n`` (ties:
    smallest in code-point order) if that n is at least ``ratio`` times the
    word's, else null; its root is the end of the chain of forms, itself
    without one. Returns word, form, root, n, n_near (near words), form_n.

    Words are expected once each; repeated rows count as one word with their
    largest n. Rows with a null word or count are left out. Words under four
    code points raise a ValueError when read (they have too few bigrams). An
    empty table gives an empty table. Other columns are not read.
    """
    short = F.when(F.char_length("word") < 4, F.raise_error(F.lit("spelling variants need words of four letters or more"))
                   .cast("boolean")).otherwise(F.lit(True))
    words = spool(words.where("word IS NOT NULL AND n IS NOT NULL").where(short)
                  .groupBy("word").agg(F.max("n").cast("bigint").alias("n")), "words")
    pairs = spool(near_pairs(words), "pairs")
    near = (pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n"))
            .union(pairs.select("b", "a", "na")))
    best = spool(near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")), "best")
    told = (words.join(best, "word", "left")
            .withColumn("form_n", F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")))
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                    F.when(F.col("form_n").isNotNull(), F.col("best.near")).alias("form"), "form_n"))
    told = spool(told, "forms")
    ends = roots(told.where("form IS NOT NULL").select("word", "form"))
    return (told.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))

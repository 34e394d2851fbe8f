"""Quality rules as statistics, judged by an isolation forest.

Each document gets counts over its whole text; fixed base rules reject some at
once. The rest go by isolation forests over ratios of the counts (one per
ratio, one over all): trees of random splits, built on a bounded sample of
labelled rows, in which a document that few splits isolate is an anomaly. Each
forest's threshold on the mean path length is calibrated on the labelled rows.

The model is fitted on at most ``max_labelled`` labelled rows (a documented
parameter) and is a few hundred KB; every document is counted and scored in
one pass over the table, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.common import U64, WORD_BREAK, Block, blocks, mapped, mix, quoted, span_hash, text_hash

# The symbols of the base rules.
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_EXTRA = ["n_lines", "n_upper", "n_same"]

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True


def counts(block: Block, width: int = 5) -> dict[str, np.ndarray]:
    """The statistics of each row of a block."""
    rows, data, at = block.rows, block.data, block.offsets
    starts, ends, first = block.words()
    n = np.diff(first)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[at])

    row, start, end, a, b = block.lines()
    line = text_hash(data, start, end, 0) ^ mix(row.astype(np.uint64) + U64(1))
    worded = b > a
    lines = np.bincount(row[worded], minlength=rows)
    _, kept = np.unique(line[worded], return_index=True)
    distinct = np.bincount(row[worded][kept], minlength=rows)

    words = text_hash(data, starts, ends, 0)
    word_row = np.repeat(np.arange(rows), n)
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words[1:] == words[:-1]) & (word_row[1:] == word_row[:-1])
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words) >= width:
        pos = np.flatnonzero(word_row[width - 1:] == word_row[: len(words) - width + 1])
        h = span_hash(words, pos, pos + width, 2) ^ mix(word_row[pos].astype(np.uint64) + U64(1))
        order = np.argsort(h)
        equal = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(pos), dtype=bool)
        twice[order[1:][equal]] = twice[order[:-1][equal]] = True
        np.add.at(covered, pos[twice], 1)
        np.add.at(covered, pos[twice] + width, -1)
    repeated = np.cumsum(covered[:-1]) > 0
    return {
        "n_words": n,
        "word_chars": per_row(((data & 0xC0) != 0x80) & ~WORD_BREAK[data]),
        "n_symbols": per_row(_SYMBOL[data]),
        "n_dup_lines": lines - distinct,
        "n_repeat_words": np.bincount(word_row[repeated], minlength=rows),
        "n_lines": lines,
        "n_upper": per_row(_UPPER[data]),
        "n_same": np.bincount(word_row[same], minlength=rows),
    }


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios of the counts, so that length alone is no anomaly."""
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack([
        c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
        c["n_repeat_words"] / words, c["n_upper"] / chars, c["n_same"] / words], axis=1)


# --- the forest ----------------------------------------------------------------

@dataclass
class Forest:
    """Trees as heaps: ``feature`` (-1: leaf), ``cut``, ``length`` of a leaf's path."""
    feature: np.ndarray
    cut: np.ndarray
    length: np.ndarray
    scale: float
    threshold: float = np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected one): near 1 is an anomaly."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        depth = int(np.log2(self.feature.shape[1] + 1)) - 1
        for f, cut, length in zip(self.feature, self.cut, self.length):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                which = f[at]
                inner = which >= 0
                right = x[rows, np.maximum(which, 0)] >= cut[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += length[at]
        return 2.0 ** (-total / len(self.feature) / self.scale)


def expected_length(n) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    harmonic = np.log(big - 1) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, trees: int, sample: int, seed: int) -> Forest:
    rng = np.random.Generator(np.random.PCG64(seed))
    sample = min(sample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    size = 2 ** (depth + 1) - 1
    feature = np.full((trees, size), -1)
    cut, length = np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        todo = [(0, 0, x[rng.choice(len(x), sample, replace=False)])]
        while todo:
            node, level, part = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if level == depth or len(part) < 2 or not len(open_):
                length[t, node] = level + expected_length(len(part))
                continue
            f = rng.choice(open_)
            c = rng.uniform(low[f], high[f])
            right = part[:, f] >= c
            if right.all():                # c fell on the lowest value
                c = np.nextafter(low[f], high[f])
                right = part[:, f] >= c
            feature[t, node], cut[t, node] = f, c
            todo += [(2 * node + 1, level + 1, part[~right]), (2 * node + 2, level + 1, part[right])]
    return Forest(feature, cut, length, float(max(expected_length(sample), 1.0)))


@dataclass
class Rules:
    """Forests over subsets of the ratios; one that finds an anomaly rejects."""
    forests: list[tuple[list[int], Forest]]

    def anomalous(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=bool)
        for columns, forest in self.forests:
            out |= forest.score(x[:, columns]) >= forest.threshold
        return out


def fit(x: np.ndarray, good: np.ndarray, *, trees: int = 100, sample: int = 256, share: float = 0.05,
        max_clean_loss: float = 0.0005, seed: int = 11) -> Rules | None:
    """A forest over each ratio and one over all of them.

    Each is grown on the good rows and, as ``share`` of them, rejected ones (an
    anomaly must be rare to be isolated early). Its threshold is calibrated on
    all rows: it rejects as many rejected rows as it can while losing at most
    ``max_clean_loss`` of the good ones.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    clean, bad = np.flatnonzero(good), np.flatnonzero(~good)
    if len(clean) < 2 or not len(bad):
        return None
    few = rng.permutation(bad)[: max(1, int(share * len(clean)))]
    grown = x[np.concatenate([clean, few])]
    forests = []
    for t, columns in enumerate([*([i] for i in range(x.shape[1])), list(range(x.shape[1]))]):
        forest = grow(grown[:, columns], trees, sample, seed + t)
        s = forest.score(x[:, columns])
        allowed = np.sort(s[clean])[::-1][int(max_clean_loss * len(clean))]
        above = s[bad][s[bad] > allowed]
        if len(above):                   # in the middle of the gap above the good rows
            forest.threshold = float((allowed + above.min()) / 2)
            forests.append((columns, forest))
    return Rules(forests)


def _count_rows(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, dict]]:
    for batch in batches:
        parts = [counts(b) for b in blocks(batch.column(text_at))]
        if parts:
            yield batch, {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def labelled_counts(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """Statistics and label of at most ``max_labelled`` labelled rows, drawn by
    a hash of doc_id."""
    drawn = (labels.select(F.col("doc_id").alias("_id"), "quality").where("_id IS NOT NULL AND quality IS NOT NULL")
             .orderBy(F.xxhash64("_id"), "quality").limit(max_labelled))
    names = COUNTS + _EXTRA

    def run(batches):
        for batch, c in _count_rows(batches, 0):
            yield pa.record_batch([batch.column(1), *(pa.array(c[n].astype(np.int64)) for n in names)],
                                  names=["quality", *names])

    # at most max_labelled rows of two numbers: a proven bound for the broadcast
    return (docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
            .select("text", F.col("quality").cast("int"))
            .mapInArrow(run, "quality int, " + ", ".join(f"{n} bigint" for n in names)))


def train(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000, **options) -> Rules | None:
    """Fit on labelled rows that pass the base rules. None if the labels do not
    hold both kinds; then only the base rules decide."""
    rows = labelled_counts(docs, labels, max_labelled).toPandas()
    c = {n: rows[n].to_numpy() for n in COUNTS + _EXTRA}
    passed = ~base_failed(c)
    # rows come in any order: sort for the same model each time
    x, good = features(c)[passed], rows["quality"].to_numpy()[passed] == 1
    order = np.lexsort((*x.T, good))
    return fit(x[order], good[order], **options)


def judge(docs: DataFrame, rules: Rules | None, *, only_kept: bool = False) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document.

    Returns the columns of ``docs`` plus the counts and verdicts, or with
    ``only_kept`` the kept rows with the columns of ``docs`` alone. Null or
    empty text has no words and fails the base rules. Rows are judged one by
    one, so repeats, ties and null ids change nothing; extra columns named
    like the results are replaced. An empty table gives an empty table.
    """
    added = [*COUNTS, "base_failed", "kept"]
    inputs = docs.columns if only_kept else [c for c in docs.columns if c not in added]
    source = docs.select(*quoted(inputs))
    text_at = inputs.index("text")

    def run(batches):
        for batch, c in _count_rows(batches, text_at):
            failed = base_failed(c)
            kept = ~failed
            if rules is not None:
                kept &= ~rules.anomalous(features(c))
            if only_kept:
                yield batch.filter(pa.array(kept))
                continue
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.record_batch(
                [*columns, *(pa.array(c[n].astype(np.int64)) for n in COUNTS), pa.array(failed), pa.array(kept)],
                names=[*inputs, *added])

    schema = list(source.schema.fields)
    if not only_kept:
        schema += [T.StructField(n, T.LongType()) for n in COUNTS]
        schema += [T.StructField(n, T.BooleanType()) for n in ("base_failed", "kept")]
    return mapped(source, run, T.StructType(schema))

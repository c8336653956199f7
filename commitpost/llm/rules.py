"""Quality rules: counts of each text, two fixed limits, and an isolation forest over rates made of the counts.

The forest is grown on the labelled documents of good quality that pass the limits: every tree splits a subsample of its
own, drawn from all of them as the method has it, at random features and places, so odd rows end after few splits. A
document's score is 2 ** (-mean depth / expected depth). The threshold is calibrated on every labelled document, by counts
of scores. Documents with equal counts get equal
verdicts. Without labels (or with one class only) the threshold is ``DEFAULT_THRESHOLD``, and without any labelled
text no document is called odd.

Cases: null text has no words, fails the base limits and is not kept; repeated rows are judged one by one, alike;
other columns are ignored; of several labels of one document the lowest counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from commitpost.plans.stage import stage

from .grams import NOT_SPACE, Texts, slices, span_hashes, BASES

TREES, SUBSAMPLE, DEFAULT_THRESHOLD = 100, 256, 0.62
KEEP_CLEAN = 0.998
"""Share of the good labelled documents that the threshold must keep."""

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_bytes", "n_upper", "n_marks", "n_lines")
STATISTICS = ", ".join(f"{n} bigint" for n in (*COUNTS, *EXTRA))
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50


def _in_table(chars) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


IS_SYMBOL = _in_table(SYMBOLS)
IS_UPPER = _in_table(range(65, 91))
IS_MARK = _in_table(b"!?;:_=~^@+\\/")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _equals(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, whether an earlier one of its text has the same hash, and whether any other one has."""
    order = np.lexsort((hashes, texts))
    t, h = texts[order], hashes[order]
    same = np.zeros(len(t), bool)
    same[1:] = (t[1:] == t[:-1]) & (h[1:] == h[:-1])
    either = same.copy()
    either[:-1] |= same[1:]
    earlier, twice = np.zeros(len(t), bool), np.zeros(len(t), bool)
    earlier[order], twice[order] = same, either
    return earlier, twice


def statistics(column: pa.Array) -> np.ndarray:
    """One row of COUNTS and EXTRA for each text."""
    texts = Texts(column)
    data, offsets = texts.data, texts.offsets
    words = texts.words(NOT_SPACE)
    inside = NOT_SPACE[data]
    characters = (data & 0xC0) != 0x80

    breaks = np.flatnonzero(data == 10)
    # a break at the very end of a text begins an empty line, which has no word and may be left out
    own = np.concatenate([offsets[:-1] < offsets[1:], breaks + 1 < _end_of(breaks, offsets)])
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1])[own])
    text_of_line = np.searchsorted(offsets[1:], line_starts, side="right")
    line_ends = np.minimum(np.concatenate([line_starts[1:], [len(data)]]), offsets[1:][text_of_line]) if len(line_starts) else line_starts
    last_is_break = (line_ends > line_starts) & (data[np.maximum(line_ends - 1, 0)] == 10) if len(line_starts) else np.zeros(0, bool)
    line_ends = line_ends - last_is_break
    has_word = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends, text_of_line = line_starts[has_word], line_ends[has_word], text_of_line[has_word]
    earlier, _ = _equals(text_of_line, span_hashes(data, line_starts, line_ends, BASES[0]))
    n = len(offsets) - 1
    dup_lines = np.bincount(text_of_line[earlier], minlength=n)

    grams = words.gram_starts(3)
    _, twice = _equals(words.doc(grams), words.gram_hashes(grams, 3))
    covered = np.zeros(len(words) + 3, bool)
    for shift in range(3):
        covered[grams[twice] + shift] = True

    return np.stack([
        words.counts, _per_text(inside & characters, offsets), _per_text(IS_SYMBOL[data], offsets), dup_lines,
        _per_text(covered[: len(words)], words.offsets), np.diff(offsets), _per_text(IS_UPPER[data], offsets),
        _per_text(IS_MARK[data], offsets), np.bincount(text_of_line, minlength=n),
    ], axis=1).astype(np.int64)


def _end_of(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """End of the text that each byte place lies in."""
    return offsets[1:][np.searchsorted(offsets[1:], places, side="right")] if len(places) else places


def rates(counts: np.ndarray) -> np.ndarray:
    """What the forest splits on: rates, which do not grow with the text."""
    words, chars, symbols, dup_lines, repeated, _, upper, marks, _ = counts.T.astype(float)
    per_word, per_char = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack([
        symbols / per_word, dup_lines / per_word, (repeated / per_word) ** 2, upper / per_char, marks / per_word,
    ], axis=1)


@dataclass
class Forest:
    """Trees as arrays: feature (-1 at a leaf), split value, children, and the path length at a leaf."""

    feature: np.ndarray
    value: np.ndarray
    child: np.ndarray
    length: np.ndarray
    depth: int
    expected: float
    threshold: float = DEFAULT_THRESHOLD

    def scores(self, rows: np.ndarray) -> np.ndarray:
        unique, back = np.unique(rows, axis=0, return_inverse=True)
        total = np.zeros(len(unique))
        every = np.arange(len(unique))
        for tree in range(len(self.feature)):
            at = np.zeros(len(unique), np.int64)
            for _ in range(self.depth):
                feature = self.feature[tree][at]
                right = unique[every, np.maximum(feature, 0)] > self.value[tree][at]
                at = np.where(feature < 0, at, self.child[tree][at] + right)
            total += self.length[tree][at]
        return (2.0 ** (-total / len(self.feature) / self.expected))[back.reshape(-1)]


def _expected_depth(n: int) -> float:
    """Mean depth of a failed search in a random binary tree of n leaves."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> Forest:
    """A forest on random subsamples of ``rows``."""
    rng = np.random.default_rng(seed)
    subsample = min(subsample, len(rows))
    drawn = (rows[rng.choice(len(rows), subsample, replace=False)] for _ in range(trees))
    return grow_on(drawn, trees, subsample, rows.max(axis=0) - rows.min(axis=0), rng)


def grow_on(drawn: Iterable[np.ndarray], trees: int, subsample: int, spread: np.ndarray, rng: np.random.Generator) -> Forest:
    """Random splits of a subsample for each tree. A split lies between the smallest and largest value of the node, or a
    tenth of the feature's range (``spread``) above, so that rates higher than any known one are cut off too."""
    depth = max(1, int(np.ceil(np.log2(max(2, subsample)))) + 2)
    size = 2 ** (depth + 1)
    forest = Forest(
        np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size), np.int64), np.zeros((trees, size)),
        depth, max(1.0, _expected_depth(subsample)),
    )
    margin = 0.1 * spread + 0.02
    for tree, rows in enumerate(drawn):
        todo, used = [(0, rows, 0)], 1
        while todo:
            node, inside, level = todo.pop()
            if level == depth or len(inside) < 2:
                forest.length[tree][node] = level + _expected_depth(len(inside))
                continue
            feature = int(rng.integers(inside.shape[1]))
            value = rng.uniform(inside[:, feature].min(), inside[:, feature].max() + margin[feature])
            forest.feature[tree][node], forest.value[tree][node], forest.child[tree][node] = feature, value, used
            right = inside[:, feature] > value
            todo += [(used, inside[~right], level + 1), (used + 1, inside[right], level + 1)]
            used += 2
    return forest


def calibrate(scores: np.ndarray, good: np.ndarray) -> float:
    """Keeps KEEP_CLEAN of the good rows at least, and every good row up to the first bad one above those."""
    if not good.any() or good.all():
        return DEFAULT_THRESHOLD
    floor = float(np.quantile(scores[good], KEEP_CLEAN, method="higher"))
    above = scores[~good & (scores > floor)]
    if not len(above):
        return floor
    return float((scores[good & (scores < above.min())].max(initial=floor) + above.min()) / 2)


def counted(documents: DataFrame) -> DataFrame:
    """Counts of each row of ``documents``, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                counts = statistics(batch["text"])
                yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, counts.T)], ["doc_id", *COUNTS, *EXTRA])

    return stage(documents.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, {STATISTICS}"), "counts")


def _counts(table) -> np.ndarray:
    return np.stack([np.asarray(table[n]) for n in (*COUNTS, *EXTRA)], axis=1)


def fit(counts: DataFrame, labels: DataFrame) -> Forest | None:
    """The forest of every labelled row of ``counted``; only counts are shuffled. A tree's rows are those with its smallest
    hashes, so they depend on the ids alone."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    passes = (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEATED_PERCENT * F.col("n_words"))
    labelled = stage(counts.where(passes).join(known, "doc_id"), "labelled")  # the others are rejected anyway
    good = labelled.where("good")
    n = good.count()
    if not n:
        return None
    part = min(1.0, 4 * SUBSAMPLE / n)  # so few hashes are sorted; less than a subsample of them is out of the question
    turns = good.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    turns = turns.withColumn("h", F.pmod(F.xxhash64("doc_id", "tree"), F.lit(1 << 40))).where(F.col("h") < int(part * (1 << 40)))
    turn = F.row_number().over(Window.partitionBy("tree").orderBy("h", "doc_id", *COUNTS, *EXTRA))
    table = turns.withColumn("turn", turn).where(F.col("turn") <= SUBSAMPLE).orderBy("tree", "turn").toPandas()
    rows, trees = rates(_counts(table)), table["tree"].to_numpy()

    symbols, dup_lines, repeated, upper, marks = (F.col(c) for c in ("n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks"))
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    each = (symbols / words, dup_lines / words, (repeated / words) ** 2, upper / chars, marks / words)  # as in ``rates``
    spread = np.array(good.agg(*(F.max(r) - F.min(r) for r in each)).first(), float)
    forest = grow_on((rows[trees == t] for t in range(TREES)), TREES, min(SUBSAMPLE, n), spread, np.random.default_rng(7))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            yield pa.RecordBatch.from_arrays([pa.array(forest.scores(rates(_counts(batch)))), batch["good"]], ["score", "good"])

    scores = labelled.mapInArrow(score, "score double, good boolean")
    forest.threshold = calibrate_all(stage(scores, "scores"))
    return forest


def calibrate_all(scores: DataFrame) -> float:
    """``calibrate`` over a table ``(score, good)`` of any size: the rank is sought in ever finer bins of the score."""
    good = scores.where("good")
    n, total = good.count(), scores.count()
    if not n or n == total:
        return DEFAULT_THRESHOLD
    rank, inside = int(np.ceil(KEEP_CLEAN * (n - 1))), good
    for bits in range(10, 60, 10):
        bins = sorted(map(tuple, inside.groupBy(F.floor(F.col("score") * (1 << bits)).alias("bin")).count().collect()))
        for bin, size in bins:
            if rank < size:
                break
            rank -= size
        inside = inside.where(F.floor(F.col("score") * (1 << bits)) == bin)
        if size == 1:
            break
    floor = inside.agg(F.max("score")).first()[0]
    first_bad = scores.where(~F.col("good") & (F.col("score") > floor)).agg(F.min("score")).first()[0]
    if first_bad is None:
        return floor
    return (good.where(F.col("score") < first_bad).agg(F.max("score")).first()[0] + first_bad) / 2


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEATED_PERCENT * counts[:, 0])


JUDGED = f"doc_id bigint, {STATISTICS}, base_failed boolean, odd double, kept boolean"


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict for each row of ``documents``; texts are read once."""
    counts = counted(documents)
    forest = documents.sparkSession.sparkContext.broadcast(fit(counts, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            verdicts = _verdicts(_counts(batch), forest.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, *verdicts], names)

    names = ["doc_id", *COUNTS, *EXTRA, "base_failed", "odd", "kept"]
    return counts.mapInArrow(run, JUDGED)


def _verdicts(counts: np.ndarray, forest: Forest | None) -> list[pa.Array]:
    odd = forest.scores(rates(counts)) if forest else np.zeros(len(counts))
    failed = base_failed(counts)
    kept = ~failed & (odd <= (forest.threshold if forest else 1.0))
    return [*map(pa.array, (failed, odd, kept))]


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are kept, all columns unchanged. Only texts are sent to Python."""
    forest = documents.sparkSession.sparkContext.broadcast(fit(counted(documents), labels))

    @F.arrow_udf("boolean")
    def kept(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            whole = pa.RecordBatch.from_arrays([column], ["text"])
            parts = [_verdicts(statistics(batch["text"]), forest.value)[-1] for batch in slices(whole)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.bool_())

    return documents.where(kept("text"))


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "odd")

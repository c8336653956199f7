"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded, verified, linked.

A shingle is ``SHINGLE`` consecutive words, lower-cased; its weight is how often the text has it times the mean IDF of
its words. IDF is of words, not of whole shingles: a group of thousands of copies would lower the weight of exactly
what its members share, and its slightly changed members would no longer reach the threshold. Words are counted in
``WORD_BUCKETS`` hashed buckets, over all documents, so the table has one size for any corpus.

``HASHES`` improved consistent weighted samples of a text are cut into bands of ``ROWS``. Texts with a band in common
are candidates; a pair of weighted Jaccard similarity 0.8 escapes all bands once in 5,000 times, one of 0.85 once in
100,000. A link is a pair whose exact weighted Jaccard similarity, from both whole texts, reaches the threshold;
classes are the connected parts.

Texts with the same words are one node. Candidates of a bucket are never all paired. First each node is compared with
the earliest node of its buckets, which settles groups of copies. Buckets that still hold two classes are thinned by a
bound: what no other open text has cannot be shared, so two texts are at most as similar as the lighter of their
shared weights allows. Texts that are alike only in a passage, or changed too much, drop out by themselves; of the
others only pairs within the bound are compared. The bound is exact, so no link between two classes is lost.
Before that, ``rounds`` of centres (none by default) merge classes with few comparisons: every bucket draws a few texts, the larger a class the
likelier of its own, and the bucket's texts of other classes are compared with them. Where many texts are linked to
many, each round settles a share of those still apart, so their number of comparisons grows with the texts.

Cases: null text and text without words is alone in its class; texts of fewer than five words are linked to equal ones
only; rows with a null id are alone, with a null class; rows of one id are one document, of which the text with the
smallest digest is compared; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..plans.stage import stage
from .grams import LETTERS_DIGITS, Texts, Words, mix, signed, slices

SHINGLE, THRESHOLD = 5, 0.8
HASHES, ROWS = 64, 4
WORD_BUCKETS = 1 << 16
THINNINGS = 2
"""How often the bound is taken anew after texts have dropped out; any number gives the same classes."""
DRAWS, PROGRESS = 8, 0.1
"""Centres of a bucket in a round, and the share of the open classes a round must merge for another one. What rounds
leave is compared pair by pair, so any numbers give the same classes."""

SIGNATURES = "doc_id bigint, digest string, weight double, bands array<bigint>"

_draws: list[tuple[np.ndarray, ...]] = []


def draws() -> tuple[np.ndarray, ...]:
    """Tables of r, 1 / r, ln c (both Gamma(2, 1)) and beta; a shingle's draws are picked by 16 bits of its hash each."""
    if not _draws:
        rng = np.random.default_rng(11)
        size = 1 << 16
        r = rng.gamma(2, 1, size).astype(np.float32)
        log_c, beta = np.log(rng.gamma(2, 1, size)).astype(np.float32), rng.random(size, np.float32)
        steps = rng.integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
        _draws.append((r, 1 / r, log_c, beta, steps))
    return _draws[0]


def words_of(column: pa.Array) -> Words:
    return Texts(column).lower().words(LETTERS_DIGITS)


def word_buckets(words: Words) -> np.ndarray:
    return (words.hashes() >> np.uint64(48)).astype(np.int64)


def idf_table(documents: DataFrame) -> np.ndarray:
    """IDF of each bucket of words: ln((1 + documents) / (1 + documents with a word of it)) + 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(WORD_BUCKETS, np.int64), 0
        for whole in batches:
            for batch in slices(whole):
                words = words_of(batch["text"])
                docs = np.repeat(np.arange(batch.num_rows), words.counts)
                counts += np.bincount(np.unique(docs * WORD_BUCKETS + word_buckets(words)) % WORD_BUCKETS, minlength=WORD_BUCKETS)
                rows += batch.num_rows
        found = np.flatnonzero(counts)
        buckets, n = np.append(found, -1), np.append(counts[found], rows)
        yield pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), pa.array(n)], ["bucket", "n"])

    counted = documents.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    df, total = np.zeros(WORD_BUCKETS), 0
    for row in counted.collect():  # WORD_BUCKETS rows and one at most
        if row["bucket"] < 0:
            total = row["n"]
        else:
            df[row["bucket"]] = row["n"]
    return np.log((1 + total) / (1 + df)) + 1


def shingles(words: Words, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, weight) of each different shingle, by text and hash."""
    at = words.gram_starts(SHINGLE)
    hashes, docs = words.gram_hashes(at, SHINGLE), words.doc(at)
    value = idf[word_buckets(words)]
    mean = sum(value[at + i] for i in range(SHINGLE)) / SHINGLE
    order = np.lexsort((hashes, docs))
    docs, hashes, mean = docs[order], hashes[order], mean[order]
    new = np.ones(len(order), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return docs[first], hashes[first], mean[first] * np.diff(np.append(first, len(order)))


def bands(docs: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of band hashes for each text that occurs in ``docs`` (sorted)."""
    r, inverse_r, log_c, beta, steps = draws()
    first = np.flatnonzero(np.diff(docs, prepend=-1))
    log_w = np.log(weights).astype(np.float32)
    place = np.arange(len(docs), dtype=np.uint64)
    out = np.zeros((len(first), HASHES // ROWS), np.uint64)
    for j in range(HASHES):
        picks = (hashes * steps[j]).view(np.uint16).reshape(-1, 4)
        b, rate = beta[picks[:, 2]], picks[:, 3]
        t = np.floor(log_w * inverse_r[rate] + b)
        log_a = log_c[picks[:, 1]] - r[rate] * (t - b + 1)
        bits = log_a.view(np.uint32)
        ordered = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        best = (np.minimum.reduceat((ordered << np.uint64(32)) | place, first) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        sample = mix(hashes[best] + t[best].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, j // ROWS] = mix(out[:, j // ROWS] * np.uint64(0xD6E8FEB86659FD93) + sample + np.uint64(j))
    return out


def signatures(documents: DataFrame, idf) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words = words_of(batch["text"])
                docs, hashes, weights = shingles(words, idf.value)
                found = bands(docs, hashes, weights) if len(docs) else np.zeros((0, HASHES // ROWS), np.uint64)
                lengths = np.zeros(batch.num_rows + 1, np.int32)
                lengths[np.unique(docs) + 1] = HASHES // ROWS
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"], pa.array(words.digests()),
                        pa.array(np.bincount(docs, weights, batch.num_rows).astype(float)),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(signed(found.ravel()))),
                    ],
                    ["doc_id", "digest", "weight", "bands"],
                )

    return documents.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, SIGNATURES)


def similarities(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts."""
    n = len(left)
    docs, hashes, weights = (np.concatenate(x) for x in zip(shingles(words_of(left), idf), shingles(words_of(right), idf)))
    total = np.bincount(docs, weights, n)
    order = np.lexsort((hashes, docs))
    docs, hashes, weights = docs[order], hashes[order], weights[order]
    both = np.flatnonzero((docs[1:] == docs[:-1]) & (hashes[1:] == hashes[:-1]))
    shared = np.bincount(docs[both], np.minimum(weights[both], weights[both + 1]), n)
    return np.divide(shared, total - shared, out=np.zeros(n), where=total > shared)


def verify(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold. ``texts``: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_b", 1 << 20):
                close = similarities(batch["text_a"], batch["text_b"], idf.value) >= threshold - 1e-9
                yield batch.select(["a", "b"]).filter(pa.array(close))

    side = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def roots(parents: DataFrame) -> DataFrame:
    """node, label: the last of each node's chain of parents. ``parents``: node, label, one smaller label a node."""
    labels = stage(parents, "labels")
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = labels.join(jump, "label", "left").select("node", F.coalesce("next", "label").alias("label"), F.col("next").isNotNull().alias("moved"))
        after = stage(after, "labels")
        labels = after.select("node", "label")
        if after.where("moved").isEmpty():
            return labels


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of the connected part, for every node of ``links`` (a, b).

    Every round takes the smallest label among a node and its neighbours, then the label of that label, so that long
    chains take few rounds; each round is written to the shared folder.
    """
    both = stage(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    labels = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label"))
    labels = stage(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").select("node", "label", F.lit(None).cast("bigint").alias("was"))
        own = labels.select("node", "label", F.col("label").alias("was"))
        best = near.union(own).groupBy("node").agg(F.min("label").alias("label"), F.max("was").alias("was"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = stage(best.join(jump, "label").select("node", F.least("label", "next").alias("label"), "was"), "labels")
        labels = after.select("node", "label")
        if after.where("label <> was").isEmpty():
            return labels


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open(rows: DataFrame) -> DataFrame:
    """The rows (bucket, node, ..., label) of buckets with more than one class."""
    buckets = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    part = F.col("bucket").bitwiseAND(F.lit(7)).alias("part")  # a key the aggregate lacks: Spark may split large buckets
    return rows.select("*", part).join(buckets.select("bucket", part), ["bucket", "part"], "left_semi").drop("part")


def _merge(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``labels`` after linking labels (a, b), and the labels that changed (label, final)."""
    merged = components(links).select(F.col("node").alias("label"), F.col("label").alias("final"))
    every = labels.union(merged.select("label", "label")).dropDuplicates(["node"])  # a label without a link yet is its own
    joined = every.join(merged, "label", "left").select("node", F.coalesce("final", "label").alias("label"))
    return stage(joined, "labels"), merged


def _settle(rows: DataFrame, labels: DataFrame, texts: DataFrame, idf, threshold: float, rounds: int) -> tuple[DataFrame, DataFrame]:
    """The open rows and the labels after rounds of centres."""
    for seed in range(rounds):
        text, turns = F.struct("node", "label", "weight", "shared"), range(seed * DRAWS, (seed + 1) * DRAWS)
        drawn = F.array(*(F.min_by(text, F.struct(F.xxhash64("node", F.lit(i)), "node")) for i in turns))
        centres = rows.groupBy("bucket").agg(F.array_distinct(drawn).alias("drawn"))
        near = rows.join(centres, "bucket").withColumn("c", F.explode("drawn"))
        most = F.least("shared", "c.shared")
        close = most >= (threshold - 1e-6) * (F.col("weight") + F.col("c.weight") - most)
        ends = F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b")
        of = F.array_sort(F.array("label", "c.label")).alias("of")
        apart = near.where((F.col("label") != F.col("c.label")) & close)
        pairs = stage(apart.select(*ends, of).dropDuplicates(["a", "b"]), "pairs")
        if pairs.isEmpty():
            break
        classes_left = rows.select("label").distinct().count()
        links = verify(pairs.select("a", "b"), texts, idf, threshold).join(pairs, ["a", "b"])
        links = stage(links.select(F.col("of")[0].alias("a"), F.col("of")[1].alias("b")).distinct(), "links")
        if links.isEmpty():
            break
        labels, merged = _merge(labels, links)
        joined = rows.join(merged, "label", "left").withColumn("label", F.coalesce("final", "label")).drop("final")
        rows = stage(_open(joined), "open")
        if merged.where("label <> final").count() < PROGRESS * classes_left:
            break
    return rows, labels


def _own_weight(texts: DataFrame, idf) -> DataFrame:
    """node, own: the weight of each text's shingles that no other of ``texts`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                docs, hashes, weights = shingles(words_of(batch["text"]), idf.value)
                columns = [batch["node"].take(pa.array(docs)), pa.array(signed(hashes)), pa.array(weights)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingle", "weight"])

    found = texts.select("node", "text").mapInArrow(run, "node bigint, shingle bigint, weight double")
    single = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("weight").alias("weight"))
    return single.where("n = 1").groupBy("node").agg(F.sum("weight").alias("own"))


def classes(documents: DataFrame, threshold: float = THRESHOLD, rounds: int = 0) -> DataFrame:
    """doc_id, class_id (the smallest id of the class) for each different id, and null, null for each null id."""
    spark = documents.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(documents))
    found = stage(signatures(documents, idf), "signatures")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("digest", "weight", "bands"), "digest").alias("s")).select("doc_id", "s.*")
    nodes = one.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("weight").alias("weight"), F.first("bands").alias("bands"))
    nodes = stage(nodes, "nodes")

    rows = nodes.select("node", "weight", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    buckets = stage(rows.join(shared.select("band", "low"), "band"), "buckets")

    candidates = buckets.select("node").distinct().join(nodes.select("node", "digest"), "node")
    texts = stage(_texts_of(documents, candidates), "texts")

    weights = nodes.select(F.col("node").alias("a"), F.col("weight").alias("weight_a"))
    parents = buckets.groupBy("node", "weight").agg(F.min("low").alias("a")).where("a < node")
    parents = parents.select("a", F.col("node").alias("b"), F.col("weight").alias("weight_b")).join(weights, "a")
    even = F.least("weight_a", "weight_b") >= (threshold - 1e-9) * F.greatest("weight_a", "weight_b")
    links = verify(parents.where(even), texts, idf, threshold)
    labels = roots(links.select(F.col("b").alias("node"), F.col("a").alias("label")))

    # Linked texts weigh nearly the same, so they meet in one of their two levels of weight.
    level = F.floor(F.log("weight") / -np.log(threshold)).cast("bigint")
    leveled = buckets.select("node", "weight", "band", F.explode(F.array(level, level + 1)).alias("level"))
    rows = leveled.select("node", "weight", F.xxhash64("band", "level").alias("bucket"))
    rows = stage(_open(_with_labels(rows, labels)), "open")
    for _ in range(THINNINGS):
        own = _own_weight(texts.join(rows.select("node").distinct(), "node"), idf)
        rows = rows.drop("shared").join(own, "node", "left")
        rows = rows.withColumn("shared", F.col("weight") - F.coalesce("own", F.lit(0.0))).drop("own")
        rows = stage(_open(rows.where(F.col("shared") >= (threshold - 1e-6) * F.col("weight"))), "open")
    rows, labels = _settle(rows, labels, texts, idf, threshold, rounds)
    lists = rows.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))  # two for each band at most
    rows = rows.join(lists, "node")
    side = lambda s: rows.select("bucket", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "weight", "label", "shared", "buckets")))
    most = F.least("shared_a", "shared_b")
    close = most >= (threshold - 1e-6) * (F.col("weight_a") + F.col("weight_b") - most)
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b"))
    once = F.col("bucket") == F.array_min(F.array_intersect("buckets_a", "buckets_b"))  # a pair's first common bucket
    pairs = side("a").join(side("b"), "bucket").where(apart & close & once)
    pairs = stage(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "label_a", "label_b"), "pairs")
    links = verify(pairs, texts, idf, threshold).join(pairs, ["a", "b"]).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    labels, _ = _merge(labels, links)

    node_of = one.select("doc_id", "digest").join(nodes.select("digest", "node"), "digest")
    labelled = node_of.join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("class_id"))
    nulls = documents.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return labelled.union(nulls)


def _texts_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text for each node; rows of the same id with other words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                same = [a == b for a, b in zip(words_of(batch["text"]).digests(), batch["digest"].to_pylist())]
                yield batch.select(["node", "text"]).filter(pa.array(same, pa.bool_()))

    joined = documents.select(F.col("doc_id").alias("node"), "text").join(nodes, "node")
    return joined.select("node", "text", "digest").mapInArrow(run, "node bigint, text string").dropDuplicates(["node"])


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` whose id is the smallest of its class, one row for each id (of rows with one id, that
    with the smallest hash of its text, then the smallest text); and all rows with a null id."""
    dropped = classes(documents, threshold).where("doc_id <> class_id").select("doc_id")
    rest = documents.join(dropped, "doc_id", "left_anti").select(documents.columns)
    repeated = documents.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return rest
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns))
    ranked = rest.join(repeated, "doc_id", "left_semi").select(row.alias("row"), place.alias("place")).where("place = 1")
    return rest.join(repeated, "doc_id", "left_anti").select(documents.columns).union(ranked.select("row.*"))

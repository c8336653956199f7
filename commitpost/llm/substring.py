"""Removal of long passages that an earlier document already holds: seed and extend.

A window is ``SPAN`` consecutive words. Every window has an anchor (its smallest run of ``ANCHOR`` words by hash), so
equal windows have equal anchors. Documents are joined on their anchors; each shared anchor is extended to the windows
it belongs to, and windows are joined by two independent hashes of their words (128 bits). A window that also starts
in a document with a smaller id covers its words; overlapping windows make up the maximal repeats.

Copies of a whole text (the same words) are settled first: of each such text only the first document takes part.
Groups of any size are joined against one row per anchor or window, never among themselves.

Cases: null text has no words; a null id neither covers nor is covered; rows with the same id do not cover each other;
documents shorter than a window stay whole; repeated rows are treated alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.stage import stage
from .grams import Texts, Words, signed, slices, winnow

SPAN = 50
ANCHOR = 16

BASE = "doc_id bigint, n_words bigint, whole_sha256 string, anchors array<bigint>"
WINDOWS = "doc_id bigint, whole_sha256 string, text string, windows array<struct<start:int,h1:bigint,h2:bigint>>"
KEPT = "kept_id bigint, kept_whole string, kept_removed bigint, kept_sha256 string"


def _lists(rows: np.ndarray, values: pa.Array, n: int) -> pa.ListArray:
    """values, whose row numbers do not decrease, as one list for each of n rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)), values)


def _base(documents: DataFrame, span: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words = Texts(batch["text"]).words()
                _, anchors, hashes = winnow(words, span, anchor)
                first = np.flatnonzero(np.diff(anchors, prepend=-1))  # anchors never step back
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"], pa.array(words.counts.astype(np.int64)), pa.array(words.digests()),
                        _lists(words.doc(anchors[first]), pa.array(signed(hashes[first])), batch.num_rows),
                    ],
                    ["doc_id", "n_words", "whole_sha256", "anchors"],
                )

    return documents.select("doc_id", "text").mapInArrow(run, BASE)


def _same_words(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, Words]:
    """The rows whose words have the digest that was joined by id: other rows may have the same id."""
    words = Texts(batch["text"]).words()
    same = [a == b for a, b in zip(words.digests(), batch["whole_sha256"].to_pylist())]
    if all(same):
        return batch, words
    batch = batch.filter(pa.array(same, pa.bool_()))
    return batch, Texts(batch["text"]).words()


def _windows(texts: DataFrame, span: int, anchor: int) -> DataFrame:
    """Extends the shared anchors of each text to the windows they belong to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                batch, words = _same_words(batch)
                starts, _, hashes = winnow(words, span, anchor)
                docs = words.doc(starts)
                shared = batch["shared"]
                flat = shared.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(batch.num_rows), np.asarray(shared.value_lengths()))
                both = np.concatenate([flat, signed(hashes)])
                code = np.unique(both, return_inverse=True)[1].astype(np.int64) * batch.num_rows
                own = np.isin(code[len(flat) :] + docs, code[: len(flat)] + row)
                starts, docs = starts[own], docs[own]
                windows = pa.StructArray.from_arrays(
                    [
                        pa.array((starts - words.offsets[docs]).astype(np.int32)),
                        pa.array(signed(words.gram_hashes(starts, span, 0))),
                        pa.array(signed(words.gram_hashes(starts, span, 1))),
                    ],
                    ["start", "h1", "h2"],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["whole_sha256"], batch["text"], _lists(docs, windows, batch.num_rows)],
                    ["doc_id", "whole_sha256", "text", "windows"],
                )

    return texts.select("doc_id", "whole_sha256", "text", "shared").mapInArrow(run, WINDOWS)


def _cut(texts: DataFrame, span: int) -> DataFrame:
    """Takes the covered windows out of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words = Texts(batch["text"]).words()
                covers = batch["starts"]
                row = np.repeat(np.arange(batch.num_rows), np.asarray(covers.value_lengths()))
                starts = covers.flatten().to_numpy(zero_copy_only=False) + words.offsets[row]
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, starts, 1)
                np.add.at(depth, starts + span, -1)
                keep = np.cumsum(depth[:-1]) == 0
                kept = np.concatenate([[0], np.cumsum(keep)])[words.offsets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"], batch["whole_sha256"], pa.array(words.counts - np.diff(kept)),
                        pa.array(words.digests(keep)),
                    ],
                    ["kept_id", "kept_whole", "kept_removed", "kept_sha256"],
                )

    return texts.select("doc_id", "whole_sha256", "text", "starts").mapInArrow(run, KEPT)


def covered(documents: DataFrame, span: int = SPAN, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """(base, covers): all rows with n_words and the digest of their words; and for each first document of a text
    that loses words: doc_id, whole_sha256, text and the starts of its covered windows."""
    base = stage(_base(documents, span, anchor), "texts")
    first = base.where(F.col("doc_id").isNotNull() & (F.size("anchors") > 0)).groupBy("whole_sha256")
    first = first.agg(F.min("doc_id").alias("doc_id"), F.first("anchors").alias("anchors"))
    first = stage(first, "first-texts")
    anchors = first.select("doc_id", "whole_sha256", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = shared.where("low < high").select("anchor")
    # One more key than the aggregate has, so that both sides are dealt for the join alone: only then can Spark split
    # the rows of an anchor, or of a window below, that very many documents hold.
    part = F.col("anchor").bitwiseAND(F.lit(7)).alias("part")
    held = anchors.select("*", part).join(shared.select("anchor", part), ["anchor", "part"])
    lists = held.groupBy("doc_id", "whole_sha256").agg(F.collect_set("anchor").alias("shared"))
    texts = documents.where("doc_id is not null").select("doc_id", "text").join(lists, "doc_id")
    candidates = stage(_windows(texts, span, anchor), "windows")
    candidates = candidates.withColumn("text_key", F.xxhash64("whole_sha256"))
    windows = candidates.select("doc_id", "text_key", F.explode("windows").alias("w")).select("doc_id", "text_key", "w.*")
    owners = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("high"))
    owners = owners.where("owner < high").select("h1", "h2", "owner")
    part = F.col("h1").bitwiseAND(F.lit(7)).alias("part")
    lost = windows.select("*", part).join(owners.select("*", part), ["h1", "h2", "part"]).where("doc_id > owner")
    starts = lost.groupBy("doc_id", "text_key").agg(F.collect_set("start").alias("starts"))
    return base, candidates.select("doc_id", "whole_sha256", "text", "text_key").join(starts, ["doc_id", "text_key"])


def dedup(documents: DataFrame, span: int = SPAN, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words left, joined by one space) for each row of ``documents``."""
    base, covers = covered(documents, span, anchor)
    kept = _cut(covers, span).dropDuplicates(["kept_id", "kept_whole"])  # of repeated rows
    first = base.where(F.col("doc_id").isNotNull() & (F.size("anchors") > 0)).groupBy("whole_sha256")
    first = first.agg(F.min("doc_id").alias("first_id"))
    rows = base.drop("anchors").join(first, "whole_sha256", "left")
    rows = rows.join(kept, (F.col("doc_id") == F.col("kept_id")) & (F.col("whole_sha256") == F.col("kept_whole")), "left")
    copy = F.col("doc_id") > F.col("first_id")
    return rows.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("kept_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )

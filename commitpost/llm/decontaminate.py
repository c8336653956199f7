"""Benchmark decontamination by winnowing.

Every window of ``span`` words (a shorter item is one window) has an anchor: the smallest hash among its runs of
k words. Equal windows have equal anchors, so each window of a document that an item also holds is found from an
anchor both sides kept. Anchors that hit are extended to the windows that contain them, and those are joined with
the items' windows by their words, so nothing rests on hashes alone.

Cases: null text and null item text have no words; windows of an item without an id hit, but no id is reported; repeated rows are judged one by
one, alike; other columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.stage import stage
from .grams import LETTERS_DIGITS, Texts, Words, signed, slices, winnow

SPAN = 10
SIEVE_BITS = 27
"""The sieve that is sent to every task has 2**27 bits (16 MB), however large the benchmark is. A fuller sieve lets
more windows through to the join; it never loses one."""
CHUNK_BITS = 16

ITEM_WINDOWS = "item_id bigint, window string, words int, window_hash bigint, anchor_hash bigint"
DOC_HITS = "doc_id bigint, row_key bigint, n_words bigint, hits array<struct<start:int,words:int,window:string>>"


def anchor_words(span: int) -> int:
    """Runs of half a window: short enough for few anchors, long enough to be rare."""
    return span // 2 + 1


def _words(batch: pa.RecordBatch) -> Words:
    return Texts(batch["text"]).lower().words(LETTERS_DIGITS)


def _window_hashes(words: Words, starts: np.ndarray, span: int) -> np.ndarray:
    return words.gram_hashes(starts, span, 1)


def item_windows(items: DataFrame, span: int = SPAN) -> DataFrame:
    """Each window of each item, with its hash and its anchor's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words = _words(batch)
                out = {n: [] for n in ("item_id", "window", "words", "window_hash", "anchor_hash")}
                short = words.counts < span
                for length in (span, *sorted(set(words.counts[short].tolist()) - {0})):
                    starts, _, anchors = winnow(words, length, anchor_words(length))
                    docs = words.doc(starts)
                    own = ~short[docs] if length == span else words.counts[docs] == length
                    starts, anchors, docs = starts[own], anchors[own], docs[own]
                    out["item_id"].append(docs)
                    out["window"] += [words.text(s, s + length) for s in starts]
                    out["words"].append(np.full(len(starts), length, np.int32))
                    out["window_hash"].append(signed(_window_hashes(words, starts, length)))
                    out["anchor_hash"].append(signed(anchors))
                columns = {n: pa.array(v if n == "window" else np.concatenate(v)) for n, v in out.items()}
                columns["item_id"] = batch["item_id"].take(columns["item_id"])
                yield pa.RecordBatch.from_pydict(columns)

    return items.select("item_id", "text").mapInArrow(run, ITEM_WINDOWS)


def sieve(windows: DataFrame, bits: int = SIEVE_BITS) -> np.ndarray:
    """One bit for every window hash and every anchor hash; built in chunks of 8 KB, 2**(bits - 16) at most."""
    places = windows.select(F.explode(F.array("window_hash", "anchor_hash")).alias("hash"))
    places = places.select(F.shiftrightunsigned("hash", 64 - bits).alias("place")).distinct()

    def pack(key, pdf):
        import pandas as pd

        bitmap = np.zeros(1 << CHUNK_BITS, bool)
        bitmap[pdf["place"].to_numpy() & ((1 << CHUNK_BITS) - 1)] = True
        return pd.DataFrame({"chunk": [key[0]], "bitmap": [np.packbits(bitmap, bitorder="little").tobytes()]})

    chunks = places.withColumn("chunk", F.shiftright("place", CHUNK_BITS)).groupBy("chunk")
    found = np.zeros(1 << (bits - 3), np.uint8)
    for row in chunks.applyInPandas(pack, "chunk bigint, bitmap binary").collect():
        at = row["chunk"] << (CHUNK_BITS - 3)
        found[at : at + (1 << (CHUNK_BITS - 3))] = np.frombuffer(row["bitmap"], np.uint8)
    return found


def document_hits(documents: DataFrame, sieve_bits, lengths: list[int], bits: int = SIEVE_BITS) -> DataFrame:
    """For each document, the windows that may be an item's."""

    def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - bits)
        return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sieve_bits.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("window", pa.string())]))
        for whole in batches:
            for batch in slices(whole):
                words = _words(batch)
                hits: list[list] = [[] for _ in range(batch.num_rows)]
                for length in lengths:
                    starts, _, anchors = winnow(words, length, anchor_words(length))
                    starts = starts[passes(bitmap, anchors)]
                    starts = starts[passes(bitmap, _window_hashes(words, starts, length))]
                    for start, doc in zip(starts.tolist(), words.doc(starts).tolist()):
                        place = start - int(words.offsets[doc])
                        hits[doc].append({"start": place, "words": length, "window": words.text(start, start + length)})
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], batch["row_key"], pa.array(words.counts.astype(np.int64)), pa.array(hits, kind)],
                    ["doc_id", "row_key", "n_words", "hits"],
                )

    keyed = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return keyed.mapInArrow(run, DOC_HITS)


def _exact_hits(documents: DataFrame, items: DataFrame, span: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(every row with n_words, hits that are an item's window by its words)."""
    spark = documents.sparkSession
    windows = stage(item_windows(items, span), "item-windows")
    lengths = sorted(r["words"] for r in windows.select("words").distinct().collect())  # span values at most
    bitmap = spark.sparkContext.broadcast(sieve(windows, bits))
    found = stage(document_hits(documents, bitmap, lengths, bits), "hits")
    of_window = windows.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    hits = found.where(F.size("hits") > 0).select("doc_id", "row_key", F.explode("hits").alias("hit")).distinct()
    return found.select("doc_id", "row_key", "n_words"), hits.join(of_window, F.col("hit.window") == F.col("window"))


def decontaminate(documents: DataFrame, items: DataFrame, span: int = SPAN, bits: int = SIEVE_BITS) -> DataFrame:
    """doc_id, n_words, n_hit and the sorted ids of the items whose windows occur, for each row of ``documents``."""
    found, exact = _exact_hits(documents, items, span, bits)
    merged = exact.groupBy("doc_id", "row_key").agg(
        F.collect_list(F.struct("hit.start", "hit.words")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    merged = merged.select(
        F.col("doc_id").alias("hit_id"), F.col("row_key").alias("hit_key"),
        F.expr("size(array_distinct(flatten(transform(spans, s -> sequence(s.start, s.start + s.words - 1)))))")
        .cast("bigint").alias("n_hit"),
        F.array_sort("items").alias("item_ids"),
    )
    same = found["row_key"].eqNullSafe(merged["hit_key"]) & found["doc_id"].eqNullSafe(merged["hit_id"])
    return found.join(merged, same, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
    )


def clean(documents: DataFrame, items: DataFrame, span: int = SPAN, bits: int = SIEVE_BITS) -> DataFrame:
    """The rows of ``documents`` without any window of an item, all columns unchanged."""
    _, exact = _exact_hits(documents, items, span, bits)
    hit = exact.select(F.col("doc_id").alias("hit_id"), F.col("row_key").alias("hit_key")).distinct()
    key = F.xxhash64(documents["doc_id"], documents["text"])
    same = key.eqNullSafe(hit["hit_key"]) & documents["doc_id"].eqNullSafe(hit["hit_id"])
    return documents.join(hit, same, "left_anti")


def digest(judged: DataFrame) -> DataFrame:
    names = F.array_sort(F.transform("item_ids", lambda x: x.cast("string")))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )

"""Language identification by rank-order profiles.

Texts are lower-cased; every run of characters that are no letters is one gap. A profile is the ``PROFILE`` most
frequent n-grams of one to three letters (gaps at their ends count as letters of longer ones), counted over all training
texts of a language, whatever its script. A document's own most frequent n-grams are compared with each profile: the
distance is the sum of the differences in rank, with ``PROFILE`` for an n-gram the profile lacks.

Cases: null text, or text without a letter, is ``und`` with score 0; equal counts rank by code points, equal distances by
name of the language; without any training text everything is ``und``; repeated rows are judged one by one, alike;
other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .grams import slices

PROFILE = 400
BITS = 21
"""Bits of a code point; a run of three fits a long. Nothing is 0 and a gap is 1, which is no letter."""
GAP = 1
HELD = 1 << 20
"""A task keeps about so many different (language, run) before it passes its counts on."""
PARTS = 64
"""A language's most frequent runs are sought in so many parts of its runs first."""
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """True for each code point that is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(p).isalpha() for p in range(sys.maxunicode + 1)), bool))
    return _letters[0]


def runs(text: str) -> np.ndarray:
    """All n-grams of one to three letters as numbers; gaps only at the ends of one."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.concatenate([[GAP], np.where(letters()[points], points, GAP), [GAP]])
    points = points[np.concatenate([[True], (points[1:] != GAP) | (points[:-1] != GAP)])]
    one = points[points != GAP]
    if not len(one):
        return one
    two = points[:-1] << BITS | points[1:]
    three = (points[:-2] << 2 * BITS | two[1:])[points[1:-1] != GAP]
    return np.concatenate([one, two, three])


class _Counts:
    """Counts of one task by language and run; what is over ``HELD`` of them is passed on."""

    def __init__(self) -> None:
        self.parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, lang: str, codes: np.ndarray) -> None:
        found = np.unique(codes, return_counts=True)
        self.parts.setdefault(lang, []).append(found)
        self.size += len(found[0])

    def merge(self) -> None:
        self.size = 0
        for lang, parts in self.parts.items():
            codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            counts = np.zeros(len(codes), np.int64)
            np.add.at(counts, place, np.concatenate([n for _, n in parts]))
            self.parts[lang] = [(codes, counts)]
            self.size += len(codes)

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for lang, [(codes, counts)] in self.parts.items():
            for at in range(0, len(codes), 1 << 16):
                part = codes[at : at + (1 << 16)]
                names = pa.array([lang] * len(part), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(part), pa.array(counts[at : at + (1 << 16)])], ["lang", "run", "n"])
        self.parts, self.size = {}, 0


def profiles(documents: DataFrame, training: Column) -> dict[str, dict[int, int]]:
    """For each language, its most frequent runs and their ranks from 0.

    Tasks count what they read and pass on sums; these meet by language and run, and the best of each part of a
    language's runs compete for its profile, so that no task holds all runs of a language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for whole in batches:
            for batch in slices(whole):
                found: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                    found.setdefault(lang, []).append(runs(text))
                for lang, codes in found.items():
                    counts.add(lang, np.concatenate(codes))
                if counts.size > 2 * HELD:
                    counts.merge()
                    if counts.size > HELD:
                        yield from counts.rows()
        yield from counts.rows()

    known = documents.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    best = known.mapInArrow(count, "lang string, run bigint, n bigint").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    best = best.withColumn("part", F.pmod(F.xxhash64("run"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("n"), "run")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    ranks: dict[str, dict[int, int]] = {r["lang"]: {} for r in known.select("lang").distinct().collect()}
    for row in best.collect():  # PROFILE rows for each language
        ranks[row["lang"]][row["run"]] = row["rank"] - 1
    return dict(sorted(ranks.items()))


def tables(ranks: dict[str, dict[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, ranks): all runs of the profiles in order, and for each profile the rank of each of them (PROFILE if it
    lacks the run); one column more stands for all other runs."""
    codes = np.unique(np.array([code for table in ranks.values() for code in table], np.int64))
    found = np.full((len(ranks), len(codes) + 1), PROFILE, np.int32)
    for row, table in zip(found, ranks.values()):
        row[np.searchsorted(codes, np.fromiter(table, np.int64, len(table)))] = np.fromiter(table.values(), np.int32, len(table))
    return codes, found


def out_of_place(text: str, codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, int] | None:
    """Distance to each profile, and the largest possible one; None without a letter."""
    own, counts = np.unique(runs(text), return_counts=True)
    if not len(own):
        return None
    best = own[np.lexsort((own, -counts))[:PROFILE]]
    place = np.searchsorted(codes, best)
    known = place < len(codes)
    known[known] = codes[place[known]] == best[known]
    there = table[:, np.where(known, place, len(codes))]
    distance = np.where(there < PROFILE, np.abs(there - np.arange(len(best))), PROFILE)
    return distance.sum(axis=1), PROFILE * len(best)


def identify(documents: DataFrame, training: Column) -> DataFrame:
    """doc_id, lang_pred and score: 1 - nearest distance / (2 * second nearest), so 0.5 is a draw and 1 a perfect fit."""
    ranks = profiles(documents, training)
    names = list(ranks)
    table = documents.sparkSession.sparkContext.broadcast(tables(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                languages, scores = [], []
                for text in batch["text"].to_pylist():
                    found = out_of_place(text, *table.value) if text and names else None
                    if found is None:
                        languages.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    distance, most = found
                    nearest = int(distance.argmin())
                    others = np.delete(distance, nearest)
                    second = int(others.min()) if len(others) else most
                    languages.append(names[nearest])
                    scores.append(float(1 - 0.5 * distance[nearest] / max(second, 1)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")

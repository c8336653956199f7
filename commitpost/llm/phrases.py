"""Collocations: phrases of two and three words that occur together more often than apart, per language.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. Levels are
mined one after the other, each candidate made of parts known to be frequent:

1. Words are counted by Spark; those with ``least`` occurrences get codes, by falling count, and texts become rows of
   codes with 0 for all other words and between pieces. No phrase that counts reaches across a 0.
2. Candidates of two words are the neighbours of frequent words seen often enough; of three words, the two-word phrases
   found frequent with the word after them, if a sieve of all frequent two-word phrases has their last two words.
3. Candidates are dealt into parts of about ``PART``, and each part becomes a double-array trie over the bytes of the
   codes, built in a task. A trie is broadcast (some tens of MB at most, whatever the corpus), numpy moves the states of
   all text positions along level by level, and the accepting states are counted by bincount in each task and summed.

So the driver relays bounded tries and never holds all candidates, and larger corpora take more tries, not larger ones.
The vocabulary is dealt and broadcast in parts in the same way.

Cases: null and empty texts have no words, a null lang is ``und``; repeated rows count as often as they occur; very long
texts are whole; empty tables and languages without candidates give no rows; ties end at the phrase's bytes; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from commitpost.plans.stage import stage

from .grams import Texts, slices

LEAST, TOP, COVERED = 10, 2_000, 50
PART = 1 << 19  # candidates of a trie, and words of a vocabulary part, about
PART_CODES = 1 << 20  # codes of a vocabulary part; parts are dealt by hash, so none is twice the usual size
HELD = 1 << 20  # rows a task keeps before it hands on their counts
HELD_KEYS = 1 << 20
CODE_BYTES = 1 << 21  # codes are worked on in stretches of about this size
SIEVE_BITS = 25
SALTS = 64  # each language's first rows are taken from so many parts of it
ROOT = 0
FIRST_SLOT = 256  # no state lies below, so a step from a leaf leads nowhere
SMALL = 8  # children of nodes that are placed many at a time
WINDOW = 4_096

ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
IN_WORD = ~ENDS_PIECE
IN_WORD[[0x20, 0x09]] = False


# ---- words --------------------------------------------------------------------


class Cut:
    """The words of some texts: which distinct (lang, word) each is, and its place in the rows of codes."""

    def __init__(self, batch: pa.RecordBatch):
        texts = Texts(batch["text"]).lower()
        words = texts.words(IN_WORD)
        lengths = words.ends - words.starts
        data = texts.data[IN_WORD[texts.data]]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        encoded = column.dictionary_encode()
        langs = batch["lang"].dictionary_encode()
        doc = words.doc(np.arange(len(words)))
        mixed = np.asarray(langs.indices, np.int64)[doc] * max(1, len(encoded.dictionary)) + np.asarray(encoded.indices, np.int64)
        self.distinct, self.which, self.counts = np.unique(mixed, return_inverse=True, return_counts=True)
        size = max(1, len(encoded.dictionary))
        self.langs = langs.dictionary.take(pa.array(self.distinct // size))
        self.words = encoded.dictionary.take(pa.array(self.distinct % size)).cast(pa.binary())
        ends = np.concatenate([[0], np.cumsum(ENDS_PIECE[texts.data])])
        new_piece = np.zeros(len(words), np.int64)
        if len(words):
            new_piece[1:] = (ends[words.starts[1:]] > ends[words.ends[:-1]]) & (doc[1:] == doc[:-1])
        pieces = np.cumsum(new_piece)
        self.place = np.arange(len(words)) + pieces + doc
        before = np.concatenate([[0], pieces])[words.offsets]
        self.offsets = words.offsets + before + np.arange(len(words.offsets))  # of each text's codes, one 0 at its end

    def keys(self) -> list[bytes]:
        return [lang.encode() + b"\t" + word for lang, word in zip(self.langs.to_pylist(), self.words.to_pylist())]


def word_counts(texts: DataFrame) -> DataFrame:
    """``(lang, word, f)`` of all words."""
    names = ["lang", "word", "f"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def merged() -> pa.Table:
            summed = pa.concat_tables(held).group_by(names[:2], use_threads=False).aggregate([("f", "sum")])
            return summed.select(["lang", "word", "f_sum"]).rename_columns(names)

        for batch in batches:
            for part in slices(batch):
                cut = Cut(part)
                held.append(pa.Table.from_arrays([cut.langs, cut.words.cast(pa.string()), pa.array(cut.counts)], names))
                rows += len(cut.counts)
                if rows > HELD:
                    held = [merged()]
                    rows = held[0].num_rows
                    if rows > HELD // 2:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from merged().combine_chunks().to_batches()

    return texts.mapInArrow(count, "lang string, word string, f bigint").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def numbered(frequent: DataFrame) -> tuple[DataFrame, int]:
    """Frequent words with codes, 1 and more in each part by falling count; and the number of parts."""
    parts = max(1, -(-frequent.count() // PART))

    def number(table: pa.Table) -> pa.Table:
        order = np.lexsort((np.array(table["word"].to_pylist(), object), np.array(table["lang"].to_pylist(), object), -np.asarray(table["f"])))
        table = table.take(pa.array(order))
        codes = table["part"][0].as_py() * PART_CODES + 1 + np.arange(len(order))
        return table.append_column("code", pa.array(codes))

    dealt = frequent.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(number, "lang string, word string, f bigint, part bigint, code bigint"), parts


def encode(texts: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """Rows of codes, 4 bytes each: 0 for words without a code, between pieces and at the end of each text."""
    spark = texts.sparkSession
    rows = texts.withColumn("codes", F.lit(None).cast("binary"))
    for part in range(parts):
        key = F.encode(F.concat_ws("\t", "lang", "word"), "UTF-8").alias("key")
        mine = words.where(F.col("part") == part).select(key, "code").toArrow()
        known = spark.sparkContext.broadcast(Vocabulary(mine))
        rows = stage(filled(rows, known, part == parts - 1), "phrase-codes")
        known.unpersist()
    return rows


class Vocabulary:
    """The codes of words by ``lang <tab> word``. It travels as columns; a task's process makes its dictionary once."""

    def __init__(self, table: pa.Table):
        self.table, self.codes = table, None

    def __getstate__(self):
        return self.table, None

    def __setstate__(self, state):
        self.table, self.codes = state

    def of(self, keys: list[bytes]) -> np.ndarray:
        if self.codes is None:
            self.codes = dict(zip(self.table["key"].to_pylist(), self.table["code"].to_pylist()))
            self.table = None
        return np.array([self.codes.get(key, 0) for key in keys], np.int32)


def filled(rows: DataFrame, known: Broadcast, last: bool) -> DataFrame:
    kept = [] if last else ["lang", "text"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                cut = Cut(part)
                found = known.value.of(cut.keys())
                codes = np.zeros(cut.offsets[-1], np.int32)
                codes[cut.place] = found[cut.which]
                old = [v for v in part["codes"].to_pylist() if v is not None]
                if old:
                    codes += np.frombuffer(b"".join(old), np.int32)
                offsets = pa.py_buffer((cut.offsets * 4).astype(np.int32))
                column = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, offsets, pa.py_buffer(codes)])
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), column], [*kept, "codes"])

    return rows.mapInArrow(fill, ", ".join([*(f"{c} string" for c in kept), "codes binary"]))


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The codes of some rows at a time, one after the other."""
    for batch in batches:
        for part in slices(batch, "codes", CODE_BYTES):
            yield np.frombuffer(b"".join(part["codes"].to_pylist()), np.int32)


# ---- tries --------------------------------------------------------------------


@dataclass
class Trie:
    """A state is a slot; the step from s by byte b leads to base[s] + b if check there is s."""

    base: np.ndarray
    check: np.ndarray
    accepting: np.ndarray  # the state of each phrase

    def step(self, states: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = self.base[states] + digits
        return to, self.check[to] == states


def digits_of(codes: np.ndarray, count: int) -> np.ndarray:
    """Bytes of codes, the high one first, as a last axis."""
    return (codes[..., None] >> (8 * np.arange(count - 1, -1, -1))) & 255


def build_trie(phrases: np.ndarray, digits: int) -> Trie:
    """A double-array trie of different phrases, rows of codes in ascending order."""
    paths = digits_of(phrases, digits).reshape(len(phrases), -1)
    slots = Slots()
    at = np.full(len(paths), ROOT)
    for level in range(paths.shape[1]):
        digit = paths[:, level]
        new = np.append(True, (at[1:] != at[:-1]) | (digit[1:] != digit[:-1]))
        parent, child = at[new], digit[new]
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        bases = slots.place(child, first)
        counts = np.diff(np.append(first, len(child)))
        to = np.repeat(bases, counts) + child
        slots.base[parent[first]] = bases
        slots.check[to] = parent
        at = to[np.cumsum(new) - 1]
    end = slots.end + FIRST_SLOT
    slots.grow(end)
    return Trie(slots.base[:end].astype(np.int32), slots.check[:end].astype(np.int32), at.astype(np.int32))


class Slots:
    """The arrays of a trie while it grows."""

    def __init__(self):
        self.base, self.check = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used = np.zeros(0, bool)
        self.end = 0
        self.count = 0
        self.random = np.random.default_rng(0)
        self.grow(4 * WINDOW)
        self.used[:FIRST_SLOT] = True
        self.end = FIRST_SLOT

    def grow(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))
            self.used = np.append(self.used, np.zeros(more, bool))

    def take(self, slots: np.ndarray) -> None:
        self.used[slots] = True
        self.count += len(slots)
        self.end = max(self.end, int(slots.max(initial=0)) + 1)

    def place(self, digit: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A base for each node; its children's digits are those from its place in ``first`` to the next."""
        counts = np.diff(np.append(first, len(digit)))
        bases = np.zeros(len(first), np.int64)
        for node in np.argsort(-counts, kind="stable")[: (counts > SMALL).sum()]:
            bases[node] = self.fit(digit[first[node] : first[node] + counts[node]])
        for size in range(SMALL, 1, -1):
            nodes = np.flatnonzero(counts == size)
            if len(nodes):
                bases[nodes] = self.scatter(digit[first[nodes][:, None] + np.arange(size)])
        single = np.flatnonzero(counts == 1)
        if len(single):
            self.grow(self.end + len(single))
            free = np.flatnonzero(~self.used[: self.end + len(single)])[: len(single)]
            bases[single] = free - digit[first[single]]
            self.take(free)
        return bases

    def fit(self, digits: np.ndarray) -> int:
        """The first base among the last slots, or behind them, at which all digits are free."""
        low = max(FIRST_SLOT, self.end - WINDOW)
        self.grow(self.end + 2 * FIRST_SLOT)
        bases = np.arange(low, self.end + 1)
        for digit in digits:
            bases = bases[~self.used[bases + digit]]
        self.take(bases[0] + digits)
        return int(bases[0])

    def scatter(self, digits: np.ndarray) -> np.ndarray:
        """Bases of many small nodes with equally many children: drawn at random, and drawn again where taken."""
        bases = np.zeros(len(digits), np.int64)
        left = np.arange(len(digits))
        while len(left):
            room = max(self.end, 2 * (self.count + len(left) * digits.shape[1]) + 4 * FIRST_SLOT)
            self.grow(room + FIRST_SLOT)
            drawn = self.random.integers(FIRST_SLOT, room, len(left))
            slots = drawn[:, None] + digits[left]
            _, at = np.unique(slots, return_index=True)
            own = np.zeros(slots.size, bool)
            own[at] = True
            good = (own.reshape(slots.shape) & ~self.used[slots]).all(axis=1)
            bases[left[good]] = drawn[good]
            if good.any():
                self.take(slots[good].ravel())
            left = left[~good]
        return bases


def walk(trie: Trie, codes: np.ndarray, words: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``codes`` at which a phrase of the trie begins, and its accepting state."""
    padded = np.append(codes, np.zeros(words, codes.dtype))
    place = np.flatnonzero(codes)
    states = np.full(len(place), ROOT)
    for word in range(words):
        for shift in range(8 * (digits - 1), -1, -8):
            states, there = trie.step(states, (padded[place + word] >> shift) & 255)
            place, states = place[there], states[there]
    return place, states


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first.astype(np.int64) << 32) | second.astype(np.int64)


def sieve_place(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SIEVE_BITS)


def built_tries(candidates: DataFrame, words: int, digits: int) -> tuple[DataFrame, int]:
    """A trie for each part of the candidates ``(a, b)``: a two-word key and, for three words, the last code."""
    parts = max(1, -(-candidates.count() // PART))

    def build(table: pa.Table) -> pa.Table:
        a, b = np.asarray(table["a"], np.int64), np.asarray(table["b"], np.int64)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        trie = build_trie(np.stack([a >> 32, a & 0xFFFFFFFF, b][:words], 1), digits)
        bits = np.zeros(1 << SIEVE_BITS, bool)
        bits[sieve_place(a)] = True
        blobs = [trie.base, trie.check, trie.accepting, a, b, np.packbits(bits)]
        return pa.Table.from_arrays(
            [pa.array([table["part"][0].as_py()]), *(pa.array([x.tobytes()], pa.binary()) for x in blobs)], ["part", *names]
        )

    names = ["base", "check", "accepting", "a", "b", "bits"]
    dealt = candidates.select("a", "b").withColumn("part", F.pmod(F.xxhash64("a", "b"), F.lit(parts)))
    schema = "part bigint, " + ", ".join(f"{n} binary" for n in names)
    return stage(dealt.groupBy("part").applyInArrow(build, schema), "phrase-tries"), parts


@dataclass
class Level:
    """What the tasks of a pass get: a trie, the phrases of its accepting states, and perhaps the sieve."""

    trie: Trie
    a: np.ndarray
    b: np.ndarray
    sieve: np.ndarray | None


def sent_tries(tries: DataFrame, with_sieve: bool) -> Iterator[Level]:
    """The tries one by one; the sieve has the first two words of the candidates of all of them."""
    sieve = None
    if with_sieve:
        sieve = np.zeros((1 << SIEVE_BITS) // 8, np.uint8)
        for row in tries.select("bits").toLocalIterator():
            sieve |= np.frombuffer(row["bits"], np.uint8)
    for (part,) in tries.select("part").orderBy("part").collect():
        row = tries.where(F.col("part") == part).first()
        arrays = [np.frombuffer(row[f.name], np.int32) for f in fields(Trie)]
        yield Level(Trie(*arrays), np.frombuffer(row["a"], np.int64), np.frombuffer(row["b"], np.int64), sieve)


class Keys:
    """Counts of the keys a task has seen; ``out`` once there are many different ones."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, keys: np.ndarray) -> None:
        self.held.append(np.unique(keys, return_counts=True))
        self.rows += len(self.held[-1][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*self.held)) if self.held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        keys, which = np.unique(keys, return_inverse=True)
        counts = np.bincount(which, counts, len(keys)).astype(np.int64)
        self.held, self.rows = [(keys, counts)], len(keys)
        return keys, counts

    def out(self, last: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        if not last and self.rows <= HELD_KEYS:
            return None
        keys, counts = self.merged()
        if not last and len(keys) <= HELD_KEYS // 2:
            return None
        self.held, self.rows = [], 0
        return keys, counts


COUNTED = "a bigint, b int, f bigint"


def counted(a: np.ndarray, b: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b.astype(np.int32)), pa.array(f)], ["a", "b", "f"])


def often(rows: DataFrame, least: int) -> DataFrame:
    return rows.groupBy("a", "b").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def neighbours(codes: DataFrame) -> DataFrame:
    """Pairs of coded words that stand side by side, with partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Keys()
        for found in stretches(batches):
            both = np.flatnonzero((found[:-1] > 0) & (found[1:] > 0))
            seen.add(pair_key(found[both], found[both + 1]))
            if (ready := seen.out()) is not None:
                yield counted(ready[0], np.zeros(len(ready[0])), ready[1])
        keys, counts = seen.out(last=True)
        yield counted(keys, np.zeros(len(keys)), counts)

    return codes.mapInArrow(run, COUNTED)


def count_level(codes: DataFrame, candidates: DataFrame, words: int, digits: int, extend: bool) -> DataFrame:
    """Occurrences of the candidates; with ``extend`` also of the phrases with one more word (b is its code).

    A pass over the codes for each trie."""
    tries, _ = built_tries(candidates, words, digits)
    spark = codes.sparkSession
    done = None
    for level in sent_tries(tries, extend):
        sent = spark.sparkContext.broadcast(level)
        rows = stage(advanced(codes, sent, words, digits).groupBy("a", "b").agg(F.sum("f").alias("f")), "phrase-counts")
        sent.unpersist()
        done = rows if done is None else done.unionByName(rows)
    return spark.createDataFrame([], COUNTED) if done is None else done


def advanced(codes: DataFrame, sent: Broadcast, words: int, digits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level: Level = sent.value
        size = len(level.trie.check)
        total = np.zeros(size, np.int64)
        owner = np.zeros(size, np.int64)
        owner[level.trie.accepting] = np.arange(len(level.a))
        longer = Keys()

        def longer_rows(ready):
            at = owner[ready[0] >> 32]
            return counted(level.a[at], ready[0] & 0xFFFFFFFF, ready[1])

        for found in stretches(batches):
            place, states = walk(level.trie, found, words, digits)
            total += np.bincount(states, minlength=size)
            if level.sieve is not None:
                padded = np.append(found, np.zeros(words, found.dtype))
                after = padded[place + words]
                bit = sieve_place(pair_key(padded[place + words - 1], after))
                known = (level.sieve[bit >> np.uint64(3)] >> (7 - (bit & np.uint64(7)).astype(np.uint8))) & 1
                more = (after > 0) & (known > 0)
                longer.add(pair_key(states[more], after[more]))
                if (ready := longer.out()) is not None:
                    yield longer_rows(ready)
        counts = total[level.trie.accepting]
        there = np.flatnonzero(counts)
        yield counted(level.a[there], level.b[there], counts[there])
        if level.sieve is not None:
            yield longer_rows(longer.out(last=True))

    return codes.mapInArrow(run, COUNTED)


# ---- scores -------------------------------------------------------------------


def score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a^2 / (l r)) in decimals of 38 digits: exact for counts below 10^16."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(l) * wide(r))


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``, see the module's text.

    ``least`` is the smallest count of a candidate, ``top`` the rows of each language; a candidate whose words lie in
    a longer one with ``covered`` percent of its occurrences is dropped."""
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").alias("text")).where("text is not null")
    counts = stage(word_counts(texts), "phrase-words")
    totals = stage(counts.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    words, parts = numbered(counts.where(F.col("f") >= least))
    words = stage(words, "phrase-vocabulary")
    digits = 3 if parts * PART_CODES < 1 << 24 else 4
    codes = encode(texts, words, parts)

    candidates = stage(often(neighbours(codes), least), "phrase-pairs")
    found = stage(count_level(codes, candidates, 2, digits, extend=True), "phrase-level-2")
    pairs = found.where("b = 0").select(F.col("a").alias("key"), "f")
    candidates = stage(often(found.where("b > 0"), least), "phrase-triples")
    triples = stage(count_level(codes, candidates, 3, digits, extend=False), "phrase-level-3")
    return ranked(phrases_of(words, pairs, triples, covered), totals, top)


def phrases_of(words: DataFrame, pairs: DataFrame, triples: DataFrame, covered: int) -> DataFrame:
    """Candidates ``(lang, phrase, a, l, r, score)`` that no longer one covers."""
    word = {k: words.select(F.col("code").alias(f"c{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}")) for k in (1, 2, 3)}
    first = word[1].join(words.select(F.col("code").alias("c1"), "lang"), "c1")
    high, low = F.shiftright("key", 32).alias("c1"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("c2")

    three = triples.select(F.col("a").alias("key"), F.col("b").cast("bigint").alias("c3"), F.col("f").alias("a"))
    three = three.select("*", high, low, F.shiftleft(F.col("key").bitwiseAND(0xFFFFFFFF), 32).bitwiseOR(F.col("c3")).alias("last"))
    longer = three.select("key", "a").unionByName(three.select(F.col("last").alias("key"), "a"))
    longer = longer.groupBy("key").agg(F.max("a").alias("longest"))

    two = pairs.withColumnRenamed("f", "a").join(longer, "key", "left")
    two = two.where(F.coalesce(100 * F.col("longest") < covered * F.col("a"), F.lit(True))).select("key", "a", high, low)
    two = two.join(first, "c1").join(word[2], "c2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    )

    three = three.join(pairs.withColumnRenamed("f", "f12"), "key").join(
        pairs.select(F.col("key").alias("last"), F.col("f").alias("f23")), "last"
    ).join(first, "c1").join(word[2], "c2").join(word[3], "c3")
    cut_1, cut_2 = score(F.col("a"), F.col("f1"), F.col("f23")), score(F.col("a"), F.col("f12"), F.col("f3"))
    three = three.withColumns({"cut_1": cut_1, "cut_2": cut_2})
    by_2 = F.col("cut_2") < F.col("cut_1")
    either = lambda second, first: F.when(by_2, F.col(second)).otherwise(F.col(first))
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", either("f12", "f1").alias("l"),
        either("f3", "f23").alias("r"), either("cut_2", "cut_1").alias("score"),
    )
    return two.unionByName(three)


def ranked(phrases: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first rows of each language, taken from its salted parts first, so no task holds a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = few.where(F.col("place") <= top).drop("place", "salt")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    best = few.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

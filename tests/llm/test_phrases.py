"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import no_documents, odd_documents, prose

from commitpost.llm import phrases


def plain(rows, least, top, covered):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    kept = {}
    for (lang, words), a in candidates.items():
        longer = [c for (other, ws), c in candidates.items() if other == lang and len(ws) == 3 and len(words) == 2 and words in (ws[:2], ws[1:])]
        if any(100 * c >= covered * a for c in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        kept.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, l, r, score))
    out = []
    for lang, found in kept.items():
        for rank, (_, _, phrase, a, l, r, score) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, n[lang], score))
    return sorted(out)


def some_texts(seed, n=60):
    rng = random.Random(seed)
    pool = ["a", "b", "the", "of", "Éa", "x y", "漢字", "new", "york", "city", "San", "Juan", "s"]
    gaps = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "!?", "\x0b", " ; "]
    return [(rng.choice(["en", "fr", None]), "".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randint(0, 90)))) for _ in range(n)]


def found(df, *settings):
    return sorted(map(tuple, phrases.collocations(df, *settings).collect()))


@pytest.mark.parametrize("part", [1 << 19, 7])
def test_equal_to_plain_counts(spark, monkeypatch, part):
    """Also with several tries and vocabulary parts."""
    monkeypatch.setattr(phrases, "PART", part)
    for name in ("HELD", "HELD_KEYS"):
        monkeypatch.setattr(phrases, name, 50)
    rows = some_texts(part)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    settings = (2, 40, 50) if part > 7 else (6, 15, 70)
    assert found(df, *settings) == plain(rows, *settings)


def test_odd_documents(spark):
    df = odd_documents(spark)
    assert found(df, 2, 3000, 50) == plain([(r["lang"], r["text"]) for r in df.collect()], 2, 3000, 50)
    assert found(no_documents(spark)) == []
    assert found(df.withColumn("a", df["text"]).withColumn("word", df["text"]).limit(4)) == []


def test_ties_end_at_the_bytes(spark):
    text = " . ".join(["b c", "a d", "é f", "z g"] * 10)
    assert [r[2] for r in found(spark.createDataFrame([("en", text)], "lang string, text string"))] == ["a d", "b c", "z g", "é f"]


def test_a_very_long_text(spark):
    text = prose(3, 200_000)
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    got = found(df)
    assert got and got[0][6] == 200_000 and sum(1 for _ in got) <= 2000


def test_counts_beyond_64_bits(spark):
    a, l, r = 10**12 - 7, 3 * 10**12, 2 * 10**12 + 1
    df = spark.createDataFrame([(a, l, r)], "a bigint, l bigint, r bigint")
    assert df.select(phrases.score(df["a"], df["l"], df["r"])).first()[0] == 1_000_000 * a * a // (l * r)


@pytest.mark.parametrize("words", [2, 3])
def test_trie_accepts_its_phrases_only(words):
    rng = np.random.default_rng(words)
    codes = np.unique((rng.pareto(0.7, (4000, words)) * 3 + 1).clip(1, 200_000).astype(np.int64), axis=0)
    trie = phrases.build_trie(codes, 3)
    text = np.concatenate([np.append(row, 0) for row in codes[rng.permutation(len(codes))]] + [(rng.pareto(0.7, 5000) * 3 + 1).clip(0, 200_000)]).astype(np.int32)
    place, states = phrases.walk(trie, text, words, 3)
    counts = np.bincount(states, minlength=len(trie.check))[trie.accepting]
    want = Counter(tuple(text[i : i + words].tolist()) for i in range(len(text) - words + 1))
    assert counts.tolist() == [want[tuple(row.tolist())] for row in codes]
    assert len(place) == counts.sum() and len(set(trie.accepting.tolist())) == len(codes)

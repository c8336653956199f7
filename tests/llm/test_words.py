"""Operators on words: decontamination, near-duplicates, substrings, rules, language-model counts."""

import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from commitpost.llm import decontaminate, grams, lm, near_dup, rules, substring
from hypothesis import given, settings, strategies as st
from llm_fixtures import WORDS, letter_words, no_documents, odd_documents, prose, spaced_words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- words and anchors


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab é\n\t漢Z9", max_size=30)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    words = grams.Texts(pa.array(texts, pa.string())).words()
    assert [words.text(a, b) for a, b in zip(words.offsets[:-1], words.offsets[1:])] == [" ".join(spaced_words(t)) for t in texts]
    assert words.digests() == [sha(" ".join(spaced_words(t))) for t in texts]
    lower = grams.Texts(pa.array(texts, pa.string())).lower().words(grams.LETTERS_DIGITS)
    assert [lower.text(a, b) for a, b in zip(lower.offsets[:-1], lower.offsets[1:])] == [" ".join(letter_words(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=60), st.integers(2, 9), st.data())
def test_every_window_has_its_anchor_wherever_it_stands(letters, span, data):
    k = data.draw(st.integers(1, span))
    texts = [" ".join(letters), " ".join(["z", "y", *letters]), " ".join(letters[3:])]
    words = grams.Texts(pa.array(texts)).words()
    starts, anchors, hashes = grams.winnow(words, span, k)
    of_window = collections.defaultdict(set)
    for s, a, h in zip(starts, anchors, hashes):
        of_window[words.text(s, s + span)].add((int(a - s), int(h)))
        assert s <= a <= s + span - k
    assert all(len(v) == 1 for v in of_window.values())
    assert len(starts) == sum(max(0, len(t.split()) - span + 1) for t in texts)


# ---- decontamination


def plain_hits(documents, items, span):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = letter_words(text)
        n = min(len(w), span)
        for s in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[s : s + n])].add(item)
    out = []
    for doc, text in documents:
        w, hit, ids = letter_words(text), set(), set()
        for n in range(1, span + 1):
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    ids |= windows[tuple(w[s : s + n])] - {None}
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [27, 17])  # 17: nearly every window passes the sieve
def test_decontamination_against_brute_force(spark, bits):
    docs = [(i, prose(i, n)) for i, n in enumerate([0, 1, 5, 9, 10, 11, 60, 200])] + [(3, None), (None, prose(6, 60)), (6, prose(6, 60))]
    items = [(i, prose(100 + i, 12)) for i in range(5)]
    items += [(20, " ".join(prose(7, 200).split()[50:80])), (21, "Oak, ELM"), (22, ""), (23, None), (None, prose(6, 60)), (24, prose(5, 11)), (20, "oak elm")]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.decontaminate(d, i, 10, bits).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got], key=repr) == plain_hits(docs, items, 10)
    dirty = {(r[0]) for r in plain_hits(docs, items, 10) if r[2]}
    kept = decontaminate.clean(d, i, 10, bits).collect()
    assert all(not plain_hits([tuple(r)], items, 10)[0][2] for r in kept)
    assert len(kept) == sum(1 for x in docs if not plain_hits([x], items, 10)[0][2]) and dirty


def test_decontamination_of_odd_and_empty_tables(spark):
    docs, items = odd_documents(spark), spark.createDataFrame([(1, prose(1, 80, [f"w{i}" for i in range(500)]))], "item_id bigint, text string")
    digests = decontaminate.digest(decontaminate.decontaminate(docs, items))
    rows = digests.collect()
    assert len(rows) == docs.count() and sum(r.contaminated for r in rows) == 6
    assert decontaminate.clean(docs, items).columns == docs.columns
    assert decontaminate.clean(docs, items).count() == docs.count() - 6
    none = decontaminate.digest(decontaminate.decontaminate(docs, items.where("1 = 0"))).collect()
    assert not any(r.n_hit for r in none) and none[0].items_sha256 == sha("")
    assert decontaminate.decontaminate(no_documents(spark), items).count() == 0


# ---- near-duplicates


def plain_similarity(a, b, idf):
    def weights(words):
        value = [idf[i] for i in near_dup.word_buckets(near_dup.words_of(pa.array([" ".join(words)])))]
        out = collections.Counter()
        for s in range(len(words) - 4):
            out[tuple(words[s : s + 5])] += sum(value[s : s + 5]) / 5
        return out

    x, y = weights(letter_words(a)), weights(letter_words(b))
    both = sum(min(x[k], y[k]) for k in x.keys() & y.keys())
    total = sum(x.values()) + sum(y.values()) - both
    return both / total if total else 0.0


def plain_classes(docs, idf):
    parent = {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: set(zip(*(letter_words(t)[k:] for k in range(5)))) for i, t in docs}
    for n, (a, s) in enumerate(docs):
        for b, t in docs[n + 1 :]:
            same = letter_words(s) == letter_words(t)
            if same or sets[a] & sets[b] and plain_similarity(s, t, idf) >= 0.8 - 1e-9:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i, _ in docs}


def family(seed, size, changes, n=120):
    """A text and copies of it with some words changed."""
    rng, base = random.Random(seed), prose(seed, n, [f"{seed}w{i}" for i in range(400)]).split()
    out = [" ".join(base)]
    for _ in range(size):
        copy = list(base)
        for at in rng.sample(range(n), rng.randint(0, changes)):
            copy[at] = f"new{rng.randint(0, 9**6)}"
        out.append(" ".join(copy))
    return out


def test_near_duplicates_against_brute_force(spark):
    texts = [t for seed in range(12) for t in family(seed, 6, 6)] + family(50, 60, 3) + family(51, 40, 5)
    chain = prose(77, 100, [f"c{i}" for i in range(900)]).split()
    texts += [" ".join(chain[k * 4 :] + [f"z{k}q{j}" for j in range(k * 4)]) for k in range(8)]  # linked only step by step
    docs = list(enumerate(texts))
    random.Random(3).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    idf = near_dup.idf_table(df)
    got = {r.doc_id: r.class_id for r in near_dup.classes(df).collect()}
    assert got == plain_classes(sorted(docs), idf)
    assert len({got[i] for i, _ in docs}) < 0.6 * len(docs)


def test_thinning_loses_no_link(spark):
    """Texts around one passage, most of them unlike each other, a few linked beyond it."""
    passage = prose(5, 60, [f"p{i}" for i in range(300)])
    docs = [f"{passage} {prose(1000 + i, 20, [f'{i}x{j}' for j in range(99)])}" for i in range(120)]
    docs += [f"{docs[i]} tail{i}" for i in range(0, 120, 9)] + [f"head{i} {docs[i]}" for i in range(0, 120, 13)] + family(61, 30, 9)
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near_dup.classes(df).collect()} == plain_classes(docs, near_dup.idf_table(df))


def test_texts_of_shared_paragraphs_are_not_all_paired(spark, monkeypatch):
    """Every shingle is shared and one pair in ten or so is a link; twice the texts take about twice the comparisons."""
    paragraphs = [prose(900 + k, 14, [f"{k}a{j}" for j in range(60)]) for k in range(40)]
    compared = []

    def counting(pairs, *rest, verify=near_dup.verify):
        compared[-1] += pairs.count()
        return verify(pairs, *rest)

    monkeypatch.setattr(near_dup, "verify", counting)
    for n in (80, 160, 320):
        rng = random.Random(n)
        texts = [" ".join(paragraphs[k] for k in range(40) if k not in left_out) for left_out in (rng.sample(range(40), 5) for _ in range(n))]
        compared.append(0)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        got = {r.doc_id: r.class_id for r in near_dup.classes(df, rounds=12).collect()}
        if n == 80:
            idf = near_dup.idf_table(df)
            a, b = np.triu_indices(n, 1)
            column = pa.array(texts)
            linked = near_dup.similarities(column.take(pa.array(a)), column.take(pa.array(b)), idf) >= 0.8 - 1e-9
            root = np.arange(n)
            for x, y in zip(a[linked], b[linked]):
                low, high = sorted((root[x], root[y]))
                root[root == high] = low
            assert got == dict(enumerate(root.tolist()))
    assert compared[2] < 2.5 * compared[1]
    assert compared[2] < 0.6 * 320 * 319 / 2


def test_signatures_estimate_the_similarity():
    idf = np.ones(near_dup.WORD_BUCKETS)
    pairs = [family(i, 1, 8, 300) for i in range(40)]
    column = pa.array([t for p in pairs for t in p])
    docs, hashes, weights = near_dup.shingles(near_dup.words_of(column), idf)
    rows = near_dup.bands(docs, hashes, weights)
    equal = (rows[::2] == rows[1::2]).mean()
    mean = np.mean([plain_similarity(*p, idf) ** near_dup.ROWS for p in pairs])
    assert abs(equal - mean) < 0.08


def test_near_duplicates_of_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    got = {(r.doc_id, r.class_id) for r in near_dup.classes(docs).collect()}
    assert {(6, 6), (7, 6), (8, 6), (12, 6), (1, 1), (9, 9), (13, 13), (None, None)} <= got
    kept = near_dup.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(None) == 3 and ids.count(6) == ids.count(13) == 1 and 7 not in ids
    assert near_dup.classes(no_documents(spark)).count() == near_dup.keep_one(no_documents(spark)).count() == 0


# ---- substrings


def plain_cut(docs, span):
    owner = {}
    for i, text in docs:
        w = spaced_words(text)
        for s in range(len(w) - span + 1):
            if i is not None:
                key = tuple(w[s : s + span])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for i, text in docs:
        w = spaced_words(text)
        gone = {s + k for s in range(len(w) - span + 1) if i is not None and owner[tuple(w[s : s + span])] < i for k in range(span)}
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("span,anchor", [(6, 3), (7, 1), (50, 16)])
def test_substrings_against_brute_force(spark, span, anchor):
    shared = prose(9, span + 20, [f"s{i}" for i in range(90)]).split()
    docs = [(i, prose(i, n, WORDS[:3])) for i, n in enumerate([0, 3, span - 1, span, span + 1, 80, 90, 100])]
    docs += [(100 + i, " ".join([f"p{i}", *shared[i : span + i + 3], f"q{i}", *shared])) for i in range(12)]
    docs += [(200, " ".join(shared)), (50, "\n".join(shared)), (60, None), (None, " ".join(shared)), (104, " ".join(shared)), (200, " ".join(shared))]
    got = substring.dedup(spark.createDataFrame(docs, "doc_id bigint, text string"), span, anchor).collect()
    assert sorted([tuple(r) for r in got], key=repr) == plain_cut(docs, span)


def test_substrings_of_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    want = plain_cut([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 50)
    assert sorted([tuple(r) for r in substring.dedup(docs).collect()], key=repr) == want
    assert substring.dedup(no_documents(spark)).count() == 0


def thue_morse(letters, size):
    return "".join(letters[i.bit_count() % 2] for i in range(size))


@pytest.mark.parametrize("size", [32, 64, 512, 1024, 2048])
def test_words_that_polynomials_confuse(spark, size):
    """Hashes, substrings and line counts tell a Thue-Morse word from its complement."""
    one, two = thue_morse("ab", size), thue_morse("ba", size)
    words = grams.Texts(pa.array([f"{one} {two}"])).words()
    for which in (0, 1):
        a, b = words.hashes(which).tolist()
        assert a != b
    both = grams.Texts(pa.array([" ".join(thue_morse([letters, letters[::-1]], 64)) for letters in ("xy", "yx")])).words()
    assert len({tuple(both.gram_hashes(np.array([at]), 64, which)[0] for which in (0, 1)) for at in both.offsets[:-1]}) == 2
    shared = prose(4, 49, [f"s{i}" for i in range(90)])
    docs = [(1, f"{shared} {one}"), (2, f"{shared} {two}"), (3, f"{shared} {one}")]
    got = substring.dedup(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted(tuple(r) for r in got) == plain_cut(docs, 50)
    text = f"{one}\n{two}\n{one} x y\n{two} x y"
    assert [r[:5].tolist() for r in rules.statistics(pa.array([text]))] == [plain_counts(text)]


# ---- rules


def plain_counts(text):
    text = text or ""
    words, lines, seen, repeated = spaced_words(text), text.split("\n"), set(), set()
    grams3 = collections.Counter(zip(words, words[1:], words[2:]))
    for i in range(len(words) - 2):
        if grams3[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    dup = 0
    for line in lines:
        if spaced_words(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab é\n\r\t#|漢", max_size=40)), max_size=6))
def test_counts_against_brute_force(texts):
    assert [r[:5].tolist() for r in rules.statistics(pa.array(texts, pa.string()))] == [plain_counts(t) for t in texts]


def test_forest_against_plain_walks():
    rng = np.random.default_rng(1)
    rows = rng.random((300, 3))
    forest = rules.grow(rows, trees=20)
    odd = np.vstack([rows[:20], [[5, 0.5, 0.5]], rows[:1]])

    def walk(tree, row):
        at = 0
        while forest.feature[tree][at] >= 0:
            at = forest.child[tree][at] + (row[forest.feature[tree][at]] > forest.value[tree][at])
        return forest.length[tree][at]

    want = [2 ** (-np.mean([walk(t, r) for t in range(20)]) / forest.expected) for r in odd]
    got = forest.scores(odd)
    assert np.allclose(got, want) and got[20] == got.max() and got[0] == got[21]


def test_threshold_keeps_the_good_rows():
    scores, good = np.array([0.3, 0.4, 0.45, 0.6, 0.7]), np.array([True, True, True, False, False])
    assert 0.45 <= rules.calibrate(scores, good) < 0.6
    assert rules.calibrate(scores, np.ones(5, bool)) == rules.DEFAULT_THRESHOLD


def test_every_labelled_document_sets_the_threshold(spark):
    """More labelled rows than any sample of thousands: threshold and kept share are those of all rows."""
    rng = np.random.default_rng(4)
    n = 15_000
    counts = np.full((n, 9), 100)
    counts[:, 2:4], counts[:, 6:8] = rng.integers(0, 40, (n, 2)), rng.integers(0, 60, (n, 2))
    good = rng.random(n) < 0.8
    counts[~good, 2] += 60
    table = spark.createDataFrame([(i, *map(int, row)) for i, row in enumerate(counts)], f"doc_id bigint, {rules.STATISTICS}").repartition(4)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id bigint, quality int")
    counts[:, 4] = 0
    forest = rules.fit(table.withColumn("n_repeat_words", F.lit(0).cast("bigint")), labels)
    scores = forest.scores(rules.rates(counts))
    assert np.isclose(forest.threshold, rules.calibrate(scores, good), rtol=1e-12)
    assert (scores[good] <= forest.threshold).mean() >= rules.KEEP_CLEAN


def test_rules_of_odd_and_empty_tables(spark):
    docs, labels = odd_documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    rows = rules.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    for r, d in zip(sorted(rows, key=str), sorted(docs.select("doc_id", "text").collect(), key=str)):
        pass
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_words == 0 and by_id[1].base_failed and not by_id[1].kept and by_id[11].base_failed
    kept = rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)
    assert rules.judge(docs, labels.where("1 = 0")).where("kept").count() == sum(not r.base_failed for r in rows)
    assert rules.judge(no_documents(spark), labels).count() == 0


def test_rules_part_good_from_bad(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = rules.judge(docs, labels).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    share = {r.quality: r.kept for r in rows.collect()}
    assert share[1] > 0.99 and share.get(0, 0) < 0.1


# ---- language model


def test_gradients():
    rng = np.random.default_rng(0)
    w = {k: v.astype(float) for k, v in lm.start_weights().items()}
    inputs, targets = rng.integers(0, lm.CLASSES + 1, (3, lm.WINDOW)), rng.integers(-1, lm.CLASSES, (3, lm.WINDOW))
    _, g = lm.gradients(w, inputs, targets)
    for name in w:
        for _ in range(3):
            at = tuple(int(rng.integers(0, s)) for s in w[name].shape)
            up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (lm.gradients(up, inputs, targets)[0] - lm.gradients(down, inputs, targets)[0]) / 2e-5
            assert abs(slope - g[name][at]) < 1e-6


def subwords():
    import public_tokenizers

    return lm.Subwords(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_every_id_is_scored_once_with_the_ids_before_it():
    """Scores of windows are those of the model run on each id's context alone."""
    tokens = lm.Tokens(pa.array([prose(1, 40), None, "one", prose(2, 9)]), subwords())
    w = lm.start_weights(3)
    ids, offsets = tokens.ids()
    kinds = tokens.subwords.kinds
    got = lm.model_log10(lm.Scorer(w), tokens, np.zeros(len(kinds)))
    for text in range(4):
        own, total = [int(kinds[i]) for i in ids[offsets[text] : offsets[text + 1]]], 0.0
        assert own[-1] == lm.CLASSES - 1 and own.count(own[-1]) == 1
        for at in range(len(own)):
            first = at // lm.STRIDE * lm.STRIDE - lm.CONTEXT
            before = [own[p - 1] if p > 0 and p - 1 < len(own) else lm.START for p in range(first, first + lm.WINDOW)]
            if first + lm.WINDOW > len(own):
                before = [b if p <= at else lm.START for p, b in zip(range(first, first + lm.WINDOW), before)]  # causal
            h = lm.attend(w, np.array([before]))[-1][0, at - first]
            p = lm._softmax(h @ w["out"] + w["bias"])
            assert abs(p.sum() - 1) < 1e-5
            total += math.log10(p[own[at]])
        assert abs(total - got[text]) < 1e-3


def test_words_encoded_together_are_those_encoded_alone():
    s = subwords()
    texts = ["a b's  x \x85   c", "ÀÉ 漢字 don't $#! 12,5", " ".join(f"w{i}x" for i in range(200))]
    for text in texts:
        tokens = lm.Tokens(pa.array([text]), s)
        want = [i for w in spaced_words(text.lower() if text.isascii() else text.replace("À", "À")) for i in s.encode(" " + w)]
        assert tokens.ids()[0][:-1].tolist() == want


def least_cpu(run, *cases):
    """The least CPU time of ``run`` over cases."""
    import time

    took = []
    for case in cases:
        start = time.process_time()
        run(case)
        took.append(time.process_time() - start)
    return min(took)


def test_a_training_step_costs_few_sorts_of_its_decisions():
    s = subwords()
    tokens = lm.Tokens(pa.array([prose(i, 3000, [f"w{k} the of" for k in range(400)]) for i in range(4)]), s)
    tree = lm.Tree(s.kinds, np.bincount(tokens.ids()[0], minlength=s.end + 1))
    batch = [x[: lm.BATCH] for x in tokens.training_windows()]
    decisions = np.random.default_rng(0).integers(0, 1 << 40, len(tree.ways(batch[3][batch[1] >= 0])[0]))
    trainer = lm.Trainer(lm.start_weights(kinds=s.kinds), tree)
    step = least_cpu(lambda _: trainer.add(*batch), *range(30))
    assert trainer.steps == 30 and step < 6 * least_cpu(lambda _: np.sort(decisions, kind="stable"), *range(30))


def test_new_words_cost_little_more_than_their_encoding():
    s = subwords()
    texts = [" ".join(f"w{i}x{k}" for i in range(8000)) for k in range(10)]
    tokens = least_cpu(lambda text: lm.Tokens(pa.array([text]), s), *texts)
    assert tokens < 3 * least_cpu(lambda text: s.encode(" " + text), *texts)
    some = lm.Tokens(pa.array([texts[3] + " new " + texts[8]]), s)  # kept, new, kept
    assert some.ids()[0][:-1].tolist() == [i for w in (texts[3] + " new " + texts[8]).split() for i in s.encode(" " + w)]


def test_kept_words_start_over(monkeypatch):
    monkeypatch.setattr(lm, "KEPT_WORDS", 50)
    s = subwords()
    for seed in range(5):
        text = " ".join([prose(seed, 30, [f"v{seed}{i}" for i in range(40)]), "ÀÉ 漢字 x\u00a0y \u3000", prose(seed, 20)])
        want = [i for w in spaced_words("".join(c.lower() if c.isascii() else c for c in text)) for i in s.encode(" " + w)]
        assert lm.Tokens(pa.array([text, None, text]), s).ids()[0].tolist() == [*want, s.end, s.end, *want, s.end]
        assert (s.keys[1:] > s.keys[:-1]).all() and len(s.keys) < 120


def test_training_lowers_the_cross_entropy():
    s = subwords()
    texts = pa.array([prose(i, 2000) for i in range(30)])
    trainer = lm.Trainer()
    for _ in range(6):
        trainer.add(*lm.Tokens(texts, s).training_windows())
    trainer.flush()
    held = lm.Tokens(pa.array([prose(99, 500)]), s)
    zero = np.zeros(len(s.kinds))
    assert lm.model_log10(lm.Scorer(trainer.weights), held, zero)[0] > 0.7 * lm.model_log10(lm.Scorer(lm.start_weights()), held, zero)[0]


def taught(seed=4):
    """A model with a tree whose tables are not 0."""
    s, rng = subwords(), np.random.default_rng(seed)
    tree = lm.Tree(s.kinds, rng.integers(0, 1000, s.end + 1) * (rng.random(s.end + 1) < 0.3))
    w = lm.start_weights(kinds=s.kinds)
    return s, w | {k: (rng.normal(size=w[k].shape) * 0.5).astype(np.float32) for k in lm.TABLES}, tree


def test_gradients_of_ids():
    s, w, tree = taught()
    w = {k: v.astype(float) for k, v in w.items()}
    ids, lengths = lm.Tokens(pa.array([prose(1, 40), "one", prose(2, 9)]), s).stretches()[:2]
    windows = lm.laid_out(ids, lengths, s)
    _, g = lm.gradients(w, *windows, tree)
    for name in w:
        rows, values = g[name][:2] if name in lm.TABLES else (range(len(w[name])), g[name])
        for i in range(0, len(values), max(1, len(values) // 4)):
            at = (int(rows[i]),) + (3,) * (w[name].ndim - 1)
            up, down = (w | {name: w[name].copy()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (lm.gradients(up, *windows, tree)[0] - lm.gradients(down, *windows, tree)[0]) / 2e-5
            assert abs(slope - np.asarray(values)[(i,) + at[1:]]) < 1e-5


def test_probabilities_of_all_ids_sum_to_one_and_depend_on_the_ids_before():
    s, w, tree = taught()
    scorer, every = lm.Scorer(w, tree), np.arange(s.end + 1)
    scorer.prepare(s)

    def of_all(context):
        inputs = np.full((1, lm.WINDOW), s.end)
        inputs[0, : len(context)] = context
        targets = np.full((len(every), lm.STRIDE), -1)
        targets[:, len(context) - 1 - lm.CONTEXT] = every
        return np.concatenate([
            scorer.log10(np.repeat(inputs, len(part), axis=0), part, s.kinds).sum(axis=1) for part in np.array_split(targets, 30)
        ])

    one = [s.end] * 5 + s.encode(" the red house")
    other = one[:-1] + [next(i for i in every if i != one[-1] and s.kinds[i] == s.kinds[one[-1]])]  # another id of the class
    a, b = of_all(one), of_all(other)
    assert abs((10**a).sum() - 1) < 1e-4 and abs((10**b).sum() - 1) < 1e-4
    same = s.kinds == s.kinds[one[-1]]
    assert np.ptp((a - b)[same]) > 0.01  # also within a class


def test_training_windows_cover_every_id_once():
    s = subwords()
    texts = [prose(1, 3000), None, "one", prose(2, 9), prose(3, 700)]
    tokens = lm.Tokens(pa.array(texts), s)
    _, targets, before, own = tokens.training_windows()
    ids, offsets = tokens.ids()
    assert own[targets >= 0].tolist() == ids.tolist()
    want = np.concatenate([[s.end], ids[:-1]])
    assert before[targets >= 0].tolist() == want.tolist()  # an end before each text's first id
    assert (targets[targets >= 0] == s.kinds[ids]).all() and len(lm.Tokens(pa.array([], pa.string()), s).training_windows()[0]) == 0


def test_scores_do_not_depend_on_the_layout_and_rise_with_order(spark, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(lm, "PART", 1 << 9)
    rng = random.Random(8)
    follows = {w: rng.sample(WORDS, 2) for w in WORDS}

    def chain(seed, n):
        walk, out = random.Random(seed), ["oak"]
        for _ in range(n):
            out.append(walk.choice(follows[out[-1]]))
        return out

    docs = [(i, " ".join(chain(i, 400))) for i in range(300)]
    for i in range(10):
        words = chain(1000 + i, 300)
        docs.append((1000 + i, " ".join(words)))
        random.Random(i).shuffle(words)
        docs.append((2000 + i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = [
        {r.doc_id: r.score for r in lm.score(df.repartition(n), F.col("doc_id") < 1000, path, public_tokenizers.PATTERN).collect()}
        for n in (1, 200)
    ]
    assert max(abs(got[0][i] - got[1][i]) / abs(got[0][i]) for i in got[0]) < 1e-3
    assert all(got[0][1000 + i] > 0.8 * got[0][2000 + i] for i in range(10))


@pytest.mark.parametrize("head", [lm.HEAD, 5])
def test_base_scores_against_brute_force(spark, head):
    import zlib

    import public_tokenizers
    from commitpost.llm.queries import remainder

    docs = odd_documents(spark).union(odd_documents(spark).limit(0))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    count = collections.Counter()
    lowered = lambda t: [None] + spaced_words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    for i, text in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(lowered(text))
    n, v = sum(count.values()), len(count)
    want = sorted(
        (str(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 4))
        for i, text in rows for w in [lowered(text)]
    )
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = lm.score(docs, remainder(5) != 1, path, public_tokenizers.PATTERN, head).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert lm.score(no_documents(spark), remainder(5) != 1, path, public_tokenizers.PATTERN).count() == 0

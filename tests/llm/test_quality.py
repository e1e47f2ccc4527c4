"""Rule counts against brute force; the forest on planted anomalies."""

import random
import re

import numpy as np
import pytest

from lexweave.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, dup, seen = [x for x in text.split("\n") if WORD.search(x)], 0, set()
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_counts():
    rng = random.Random(2)
    for _ in range(800):
        text = "".join(rng.choice(["a", "b", "é", " ", "\n", "\t", "\x0b", "#", "|", " ", " ", "\x1c", " a b a b a "]) for _ in range(rng.randrange(80)))
        assert quality.statistics(text)[:5] == brute(text), repr(text)
    assert quality.statistics(None)[:5] == brute(None) == (0, 0, 0, 0, 0)


def test_repeats_cover_whole_windows():
    words = "a b c d e x a b c d e".split()
    assert quality.repeated_words(words) == 10
    assert quality.repeated_words(["a"] * 7) == 7
    assert quality.repeated_words(words[:4]) == 0


def test_forest_finds_anomalies():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (2000, 3)), rng.normal(8, 1, (60, 3))
    forest = quality.Forest.fit(np.concatenate([good, bad]))
    (a, _), (b, why) = forest.score(good), forest.score(bad)
    assert b.min() > np.quantile(a, 0.99)
    cut = quality.calibrate(a, b)
    assert (a > cut).mean() < 0.01 and (b > cut).all()
    assert np.array_equal(a, quality.Forest.fit(np.concatenate([good, bad])).score(good)[0])


def walked(forest, row):
    """Mean path length and bits of each feature, a tree and a step at a time."""
    total, why = 0.0, [0.0] * len(row)
    for feature, value, path, bits in zip(forest.feature, forest.value, forest.path, forest.bits, strict=True):
        node = 0
        while feature[node] >= 0:
            f = feature[node]
            node = 2 * node + (1 if row[f] < value[node] else 2)
            why[f] += bits[node]
        total += path[node]
    n = len(forest.feature)
    return 2 ** (-(total / n) / forest.scale), [w / n for w in why]


def test_scores_by_walking_the_trees():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.exponential(1, 400), np.round(rng.normal(0, 1, 400)), np.zeros(400)])
    forest = quality.Forest.fit(x, trees=20, subsample=64)
    score, why = forest.score(x)
    for i in range(0, 400, 7):
        a, b = walked(forest, x[i])
        assert score[i] == pytest.approx(a) and why[i].tolist() == pytest.approx(b)
    # a step's bits are the share of the node's rows that take it, and path lengths are those of the depth
    for t in range(20):
        for node in np.flatnonzero(forest.feature[t] >= 0):
            shares = [2.0 ** -forest.bits[t, c] for c in (2 * node + 1, 2 * node + 2)]
            assert 0.99 < sum(shares) < 1.26


def test_average_path():
    assert quality.average_path(1) == 0 and quality.average_path(2) == 1
    assert quality.average_path(256) == pytest.approx(10.24, abs=0.01)


def test_driver_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judge = quality.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = quality.assess(docs, judge).join(labels, "doc_id", "left").collect()
    for r in got:
        if len(texts[r["doc_id"]]) < 3000:
            assert tuple(r)[1:6] == brute(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    rest = [r for r in got if not r["base_failed"] and r["quality"] is not None]
    assert all(r["kept"] for r in rest if r["quality"] == 1)
    assert sum(r["kept"] for r in rest if r["quality"] == 0) <= 1
    assert quality.keep(docs, judge).count() == sum(r["kept"] for r in got)


def test_verdicts_against_brute_force(spark):
    """Sample, thresholds and kept recomputed from the plain tables, row by row."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judge = quality.fit(docs, labels, bound=150)
    h = {r["doc_id"]: r["h"] for r in docs.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    least = lambda ids: sorted(sorted(ids, key=h.get)[:150])
    rows = [np.array([quality.statistics(texts[i]) for i in ids]) for ids in (least(texts), least(i for i in label if label[i] == 1), least(i for i in label if label[i] == 0))]
    sample, good, bad = (s[~quality.base_failed(s)] for s in rows)
    forest = quality.Forest.fit(quality.features(sample))
    usual = np.median([walked(forest, x)[1] for x in quality.features(sample)], axis=0)
    scored = {}
    for kind, s in (("good", good), ("bad", bad)):
        for x in quality.features(s):
            score, why = walked(forest, x)
            scored.setdefault(int(np.argmax(why - usual)), {"good": [], "bad": []})[kind].append(score)
    for j, cut in enumerate(judge.thresholds):
        own = scored.get(j, {"good": [], "bad": []})
        cost = lambda t, own=own: 10 * sum(a > t for a in own["good"]) / len(good) + sum(b <= t for b in own["bad"]) / len(bad)
        assert cost(cut) == pytest.approx(min(cost(t) for t in [0, *own["good"], *own["bad"], np.inf]))
    for r in quality.assess(docs, judge).collect():
        s = np.array([quality.statistics(texts[r["doc_id"]])])
        score, why = walked(forest, quality.features(s)[0])
        assert r["anomaly"] == pytest.approx(score)
        assert r["kept"] == (not r["base_failed"] and score <= judge.thresholds[int(np.argmax(np.array(why) - usual))])


def test_repeated_ids_give_one_judge(spark):
    text = lambda i: " ".join(f"{('#' * 3 if i % 4 == 0 else '')}w{i * 31 + k}" for k in range(20 + i % 7))
    base = [(i, text(i), "x") for i in range(200)]
    rows = [*base, *((5, text(1000 + i), "x") for i in range(100)), (None, "a b c", "x")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    judges = [quality.fit(spark.createDataFrame(r, "doc_id long, text string, h string"), labels, bound=100) for r in (rows, rows[::-1])]
    assert np.array_equal(judges[0].forest.value, judges[1].forest.value) and np.array_equal(judges[0].thresholds, judges[1].thresholds)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, "k"), (1, None, "k"), (None, "w " * 20, "k"), (2, " ".join(map(str, range(50))), "k")], "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judge = quality.fit(docs, none)
    assert judge.forest is None
    got = sorted(((r["doc_id"], r["base_failed"], r["kept"]) for r in quality.assess(docs, judge).collect()), key=str)
    assert got == sorted([(1, True, False), (1, True, False), (None, True, False), (2, False, True)], key=str)
    assert quality.keep(docs, judge).columns == docs.columns and quality.keep(docs, judge).count() == 1
    assert quality.assess(docs.limit(0), judge).count() == 0
    one = spark.createDataFrame([(2, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, one).forest is None


def test_every_row_is_learned_from(spark):
    """Medians, thresholds and the rows of the trees from all of 9,000 documents, recomputed on the driver."""
    rng = random.Random(5)
    words = lambda i: [("#" * rng.randrange(1, 4) if i % 3 == 0 else "") + f"w{rng.randrange(10 ** rng.randrange(2, 6))}" for _ in range(rng.randrange(8, 40))]
    texts = {i: " ".join(words(i)) + ("." * (i % 5)) for i in range(9_000)}
    # the only bad rows among the greatest hashes, where a sample of the least never looks
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    h = {r["doc_id"]: r["h"] for r in docs.selectExpr("doc_id", "xxhash64(doc_id) as h").collect()}
    late = set(sorted(texts, key=h.get)[-40:])
    texts |= {i: " ".join(f"{k}|<>%{i}" for k in range(20)) for i in late}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    ids = sorted(texts)
    labels = spark.createDataFrame([(i, int(i not in late), 0) for i in ids], "doc_id long, quality int, toxic int")
    judge = quality.fit(docs, labels)
    stats = np.array([quality.statistics(texts[i]) for i in ids])
    passed = ~quality.base_failed(stats)
    x, bad = quality.features(stats[passed]), np.array([i in late for i in ids])[passed]
    forest = quality.Forest.fit(x)
    assert all(np.array_equal(getattr(judge.forest, c), getattr(forest, c)) for c in ("feature", "value", "path", "bits"))
    score, why = forest.score(x)
    assert judge.usual == pytest.approx(np.median(why, axis=0), abs=2**-14)
    main = (why - judge.usual).argmax(1)
    for j, cut in enumerate(judge.thresholds):
        good, odd = np.sort(score[(main == j) & ~bad]), np.sort(score[(main == j) & bad])
        cost = lambda t, good=good, odd=odd: 10 * (good > t).sum() / (~bad).sum() + (odd <= t).sum() / bad.sum()
        assert cost(cut) <= min([cost(t) for t in np.unique(np.concatenate([good, odd]))], default=0) + 1e-9
    assert bad.sum() > 0 and np.isfinite(judge.thresholds).any()


def test_counted_medians_and_thresholds():
    rng = np.random.default_rng(6)
    for size in (1, 2, 3, 50, 51):
        rows = rng.integers(0, 9, size)
        assert quality.median(*np.unique(rows, return_counts=True)) == np.median(rows)
        good, bad = rng.integers(0, 9, size) / 8, rng.integers(3, 12, size + 1) / 8
        (a, n), (b, m) = (np.unique(v, return_counts=True) for v in (good, bad))
        assert quality.calibrate(good, bad) == quality.calibrate(a, b, times=(n, m))

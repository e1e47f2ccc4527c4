"""op9_lm_scoring against counting word bigrams by hand, over more characters than a fixed alphabet holds."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from lexweave.llm import queries, word_lm


def sequence(text):
    return ["", *word_lm.words(text), ""]


def brute(rows, good, alpha=word_lm.ALPHA, mu=word_lm.MU):
    """Per row: n_tokens and both losses, with the row's own counts taken off; plain dictionaries throughout."""
    models = {}
    for kind in ("target", "background"):
        chosen = [t for i, t in rows if kind == "background" or i in good]
        models[kind] = Counter(w for t in chosen for w in sequence(t)[1:]), Counter(p for t in chosen for p in zip(sequence(t), sequence(t)[1:], strict=False))
    size = len(models["background"][0])
    n_target, n_all = (sum(models[k][0].values()) for k in ("target", "background"))
    ratio = {"target": 1.0, "background": n_target / n_all if n_target else 1.0}
    out = []
    for i, t in rows:
        own_words, own_grams, row = Counter(sequence(t)[1:]), Counter(zip(sequence(t), sequence(t)[1:], strict=False)), [i, len(sequence(t)) - 1]
        for kind, total in (("target", n_target), ("background", n_all)):
            alone, grams = models[kind]
            off = kind == "background" or i in good
            bits = 0.0
            for (v, w), n in own_grams.items():
                word = ratio[kind] * (alone[w] - off * own_words[w])
                before = ratio[kind] * (alone[v] - off * own_words[v])
                p = (word + alpha) / (ratio[kind] * total + alpha * size)
                bits -= n * math.log2((ratio[kind] * (grams[v, w] - off * own_grams[v, w]) + mu * p) / (before + mu))
            row.append(bits / row[1])
        out.append(tuple(row))
    return sorted(out, key=str)


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def agree(got, want):
    have = sorted(((r["doc_id"], r["n_tokens"], r["target_bits"], r["background_bits"]) for r in got), key=str)
    assert [x[:2] for x in have] == [x[:2] for x in want]
    for a, b in zip(have, want, strict=True):
        assert a[2:] == pytest.approx(b[2:], abs=2**-13)


def test_words():
    assert word_lm.words("Ein_Haus, 3 Häuser") == ["ein", "_", "haus", ",", "3", "häuser"]
    assert word_lm.words("日本 語") == ["日", "本", "語"] and word_lm.words(None) == []


def test_hashes_agree_with_words():
    rng = random.Random(8)
    kinds, seen = word_lm._Kinds(), {}
    for _ in range(300):
        texts = ["".join(rng.choice("ab_é ,\n\t\u3000語คA1½İß\U0001f600\u0301") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(4))]
        hashes, per = word_lm._token_hashes([t.lower() for t in texts], kinds)
        found = [word_lm.words(t) for t in texts]
        assert per.tolist() == [len(f) for f in found] and len(hashes) == sum(map(len, found))
        for w, h in zip([w for f in found for w in f], hashes.tolist(), strict=True):
            assert seen.setdefault(w, h) == h != 0
    assert len(set(seen.values())) == len(seen)


def test_pack():
    columns = np.array([0, 2**63, 5], np.uint64), np.array([-3, 0, 2**40], np.int64), np.zeros(3, np.uint16), np.zeros(0, np.uint32)
    for a, b in zip(columns, word_lm._unpack(word_lm._pack(*columns)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()


# 400 different characters: a vocabulary of the most frequent 126 sees most of these texts alike
ROWS = [(i, f"the {chr(0x4E00 + i)} w{i % 7} of {chr(0x4E00 + (i + 1) % 400)}") for i in range(400)]
ROWS += [(None, None), (1007, ""), (1007, "the of the"), (1007, "the of the"), (1008, "x " * 900)]
LABELS = [(i, 1, 0) for i in range(0, 400, 2)] + [(2, 0, 0), (4, None, 0), (None, 1, 0)]
GOOD = {i for i in range(0, 400, 2)} - {2, 4}


def test_query_counts_every_word(spark, tmp_path):
    docs, labels = frames(spark, ROWS, LABELS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    agree(queries.op9_lm_scoring(spark, str(tmp_path)).collect(), brute(ROWS, GOOD))


@pytest.mark.parametrize("limits", [{"flush": 50, "bucket": 40, "rarity": 3}, {"flush": 7, "bucket": 1 << 20, "rarity": 6}, {"flush": 200, "bucket": 100, "rarity": 0}])
def test_same_result_whatever_is_frequent_and_however_it_is_dealt(spark, limits):
    docs, labels = frames(spark, ROWS, LABELS)
    agree(word_lm.score(docs.repartition(3), labels, **limits).collect(), brute(ROWS, GOOD))


def test_more_good_rows_than_are_sent(spark, monkeypatch):
    monkeypatch.setattr(word_lm, "SENT", 10)
    docs, labels = frames(spark, ROWS, LABELS)
    agree(word_lm.score(docs, labels).collect(), brute(ROWS, GOOD))


def test_random_words(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    docs, labels = frames(spark, rows, [(i, int(i % 3 == 0), 0) for i in range(100)])
    agree(word_lm.score(docs, labels, flush=300, bucket=200, rarity=4).collect(), brute(rows, {i for i in range(100) if i % 3 == 0}))


def test_no_row_is_scored_by_itself(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "alpha beta gamma delta"), (3, "epsilon zeta eta theta")]
    docs, labels = frames(spark, rows, [(3, 1, 0)])
    got = {r["doc_id"]: r for r in word_lm.score(docs, labels).collect()}
    assert got[1]["background_bits"] == got[2]["background_bits"] < got[3]["background_bits"]


def test_size_of_the_vocabulary():
    assert word_lm.vocabulary_size(np.arange(7, dtype=np.uint64), 10) == 7
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**64, 200_000, dtype=np.uint64))
    assert word_lm.vocabulary_size(hashes[: word_lm.SKETCH]) == pytest.approx(200_000, rel=0.03)


def test_no_good_rows_no_rows_and_other_columns(spark):
    docs, labels = frames(spark, [(1, "a b"), (2, "")], [(1, 0, 0)])
    clashing = docs.selectExpr("*", "1 as row", "'x' as good", "2 as good_id", "3 as n_tokens")
    got = word_lm.score(clashing, labels).collect()
    assert [r["target_bits"] for r in got] == pytest.approx([math.log2(3)] * 2, abs=2**-13)
    assert word_lm.score(docs.limit(0), labels).collect() == []

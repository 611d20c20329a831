import random
import zlib

import numpy as np
from llm.fixtures import empty, odd, table, words
from pyspark.sql import functions as F

from hirefunnel.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
RUDE = ("scumbag", "imbecile", "worthless", "loathsome")


def corpus(n=900):
    pick = random.Random(4)
    texts, labels = [], []
    for k in range(n):
        body = words(40, k, 400).split()
        toxic = int(k % 3 == 0)
        for _ in range(6 * toxic):
            word = list(pick.choice(RUDE))
            if pick.random() < 0.5:  # misspelt, with two letters exchanged
                at = pick.randrange(1, len(word) - 2)
                word[at : at + 2] = word[at + 1], word[at]
            body.insert(pick.randrange(len(body)), "".join(word))
        texts.append(" ".join(body))
        labels.append((k, 1, toxic))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = corpus()
    rows, marks = table(spark, texts, extra=True), spark.createDataFrame(labels, LABELS)
    out = {r.doc_id: r for r in toxicity.scored(rows, marks).collect()}
    unseen = [(out[i].predicted, t) for i, _, t in labels if out[i].held_out]
    assert sum(p == t for p, t in unseen) >= 0.97 * len(unseen)


def test_few_toxic_labels_are_learnt_from():
    texts, labels = corpus()
    clean = [texts[i].encode() for i, _, t in labels if not t]
    rude = [texts[i].encode() for i, _, t in labels if t]
    for n in (5, 8):
        model = toxicity.train(rude[:n] + clean[:400], [1] * n + [0] * 400)
        score = toxicity.Scorer(model).score
        found = [score(t) >= 0.5 for t in rude[n:]]
        assert sum(found) >= 0.5 * len(found), n
        assert sum(score(t) >= 0.5 for t in clean[400:]) <= 0.02 * len(clean[400:])


def test_chance_is_that_of_drawing():
    from math import comb

    for rude, total in ((2, 3), (0, 4), (3, 3), (1, 9)):
        each = [comb(5, k) * comb(20, total - k) / comb(25, total) for k in range(min(total, 5) + 1)]
        want = min(sum(each[rude:]), sum(each[: rude + 1]))
        got = toxicity.by_chance(np.array([rude]), np.array([total]), 5, 20)
        assert abs(got[0] - want) < 1e-9


def test_labels_of_held_out_rows_change_nothing(spark):
    texts, labels = corpus()
    rows, marks = table(spark, texts, extra=True), spark.createDataFrame(labels, LABELS)
    out = {r.doc_id: r for r in toxicity.scored(rows, marks).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.scored(rows, flipped).collect()}
    assert again == {i: r.score for i, r in out.items()}


def test_odd_rows_and_labels(spark):
    rows = odd(spark)
    marks = spark.createDataFrame([(None, 1, 1), (3, 1, None), (7, 1, 1), (7, 1, 0), (9999, 0, 1)], LABELS)
    for labels in (marks, marks.limit(0)):
        out = toxicity.scored(rows, labels).collect()
        assert len(out) == rows.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert toxicity.scored(empty(spark), marks).collect() == []


def test_telling_buckets_by_brute_force():
    texts, labels = corpus(300)
    bodies, marks = [t.encode() for t in texts], [t for _, _, t in labels]
    total, rude = {}, {}
    for body, mark in zip(bodies, marks):
        for g in {g for w in toxicity.words_of(body) for g in toxicity.bag(w)}:
            total[g] = total.get(g, 0) + 1
            rude[g] = rude.get(g, 0) + mark
    bags = toxicity.Bags()
    got = toxicity.counts([bags.text(b) for b in bodies], marks)
    assert [c.tolist() for c in got] == [sorted(total), [total[g] for g in sorted(total)], [rude[g] for g in sorted(total)]]
    n1, some = sum(marks), sum(n > 1 for n in total.values())
    told = got[0][toxicity.telling(got[1], got[2], n1, 300 - n1, some, 10, 5.0)]
    for g in sorted(total):
        n, r = total[g], rude[g]
        p = n / 300
        wide = abs(r / n1 - (n - r) / (300 - n1)) >= 5 * np.sqrt(p * (1 - p) * (1 / n1 + 1 / (300 - n1)))
        chance = n > 1 and toxicity.by_chance(np.array([r]), np.array([n]), n1, 300 - n1)[0] * some <= 1
        assert (g in told) == bool((n >= 10 and wide and n < 300) or chance)


def test_learning_in_tasks_is_learning_at_hand(spark):
    texts, labels = corpus(200)
    rows, marks = table(spark, texts, extra=True), spark.createDataFrame(labels, LABELS)
    chosen = toxicity.sample(rows, marks)
    at_hand = chosen.orderBy("place").collect()
    want = toxicity.train([r.text.encode() for r in at_hand], [r.label for r in at_hand])
    got = toxicity.learnt(chosen)
    assert got.weight.keys() == want.weight.keys() and len(want.weight) > 10
    assert np.allclose([got.weight[g] for g in want.weight], list(want.weight.values()), atol=1e-4)
    assert abs(got.bias - want.bias) < 1e-4


def test_without_labels_nothing_is_toxic(spark):
    rows = odd(spark)
    out = toxicity.scored(rows, spark.createDataFrame([], LABELS)).collect()
    assert {r.predicted for r in out} == {0}

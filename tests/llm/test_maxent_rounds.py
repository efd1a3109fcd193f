"""Rounds of the maximum-entropy model: what each learns from, and the sums of its steps."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from zonescope.llm import maxent


def test_every_round_learns_from_all_training_documents(spark, monkeypatch):
    rows = [(i, f"a b{i} c{i % 5}") for i in range(40)] + [(3, "a b3 c3"), (None, "no id"), (41, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen, learn = [], maxent.train_round
    monkeypatch.setattr(maxent, "train_round", lambda some, *rest: seen.append(sorted(r["text"] or "" for r in some.collect())) or learn(some, *rest))
    out = maxent.score(docs, F.col("doc_id") % 4 == 1)
    held = [i for i, _ in rows if i is not None and i % 4 == 1]
    training = sorted(t or "" for i, t in rows if i is None or i % 4 != 1)
    assert seen == [training] * maxent.ROUNDS and maxent.ROUNDS >= 2
    assert sorted(r["doc_id"] for r in out.where("held_out").collect()) == sorted(held) and out.count() == len(rows)


def test_sums_of_runs_of_every_length():
    rnd = np.random.default_rng(1)
    rows = rnd.normal(size=(700, 4)).astype(np.float32)
    for values in (rnd.integers(0, 300, 700), rnd.zipf(1.5, 700) % 90, np.zeros(700, int), np.arange(700)):
        order = np.argsort(values, kind="stable")
        ordered = values[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        assert np.allclose(maxent.run_sums(rows, order, first), [rows[values == v].sum(axis=0) for v in ordered[first]], atol=1e-4)


def test_codes_of_distinct_tokens():
    rnd = random.Random(2)
    tokens = [rnd.choice([b"the", b"a", b"", b"x%d" % rnd.randrange(50)]) for _ in range(500)]
    words, numbers = maxent.numbered(tokens)
    assert words == list(dict.fromkeys(tokens)) and [words[i] for i in numbers] == tokens
    singles = {b"the": 0, b"": 1}
    codes, keep = maxent.coder(singles), ~(maxent.CLASSES - 1) & (2**64 - 1)
    expected = [xxhash.xxh3_64_intdigest(w) & keep | maxent.class_of(w, singles) for w in words]
    assert maxent.batch_codes(words, codes).tolist() == expected == [codes[w] for w in words]
    assert maxent.batch_codes(words, maxent.coder({})).tolist() == [xxhash.xxh3_64_intdigest(w) & keep | maxent.class_of(w, {}) for w in words]

"""The training-data operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import base64
import collections
import functools
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from zonescope.llm import bpe, chat_format, lang_id, license_scan, maxent, minmax_hash, packing, pivot_index, quality_rules, superkmer
from zonescope.llm.components import components

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, ids string, z int"


def documents(spark, texts, lang="en"):
    """Rows with extra and clashing columns."""
    return spark.createDataFrame([(i, t, lang, "x", 1) for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Texts with shared passages, exact and near copies, repeated rows, null and empty texts."""
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rnd.choices(vocabulary, k=60))
    out = []
    for i in range(60):
        words = rnd.choices(vocabulary, k=rnd.choice([3, 12, 13, 14, 80, 200]))
        text = " ".join(words)
        if i % 3 == 0:
            text += "\n" + passage + "  " + " ".join(rnd.choices(vocabulary, k=20))
        out.append((i, text))
    base = " ".join(rnd.choices(vocabulary, k=150))
    out += [(100 + i, base) for i in range(20)]  # exact copies: a large group
    for i in range(20):  # near copies
        words = base.split()
        words[rnd.randrange(150)] = "other"
        out.append((200 + i, " ".join(words)))
    out += [(300, None), (301, ""), (302, " \n\t "), (303, "one"), (304, "one"), (305, "x y " * 400), (306, "é" * 3000), (None, base)]
    return out


def test_bpe_equals_the_library(spark, corpus):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["a  b", " a", "a ", "a \n b", "a\n \nb", "a\t b   c d", "\x1c x", "it's 'twas 12ab3", "ab" * 5000, "日本語 テキスト", "👩‍👩‍👧 ‍", "!!??.. " * 3, "   "]
    texts = corpus + [(1000 + i, t) for i, t in enumerate(odd)]
    df = documents(spark, texts)
    out = bpe.decode(bpe.encode(df, RANKS, public_tokenizers.PATTERN), RANKS)
    assert {"doc_id", "text", "lang", "z", "n_tokens", "ids", "decoded"} == set(out.columns)
    rows = out.collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = row["text"] or ""
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert ids == library.encode_ordinary(text), text[:40]
        assert row["n_tokens"] == len(ids) and bytes(row["decoded"]).decode() == text
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_rank_queue_merges_like_a_plain_loop():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rnd = random.Random(1)
    for _ in range(300):
        piece = "".join(rnd.choices("aabcdeet hin", k=rnd.randrange(1, 30))).encode()
        assert encoder.merge(piece) == plain(piece)
    assert not encoder.queue.top and not encoder.queue.buckets


def test_pivot_index_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 64))
    near = base[:60] + rng.normal(size=(60, 64)) * 0.35
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near]))]
    rows += [(1000 + i, base[7].tolist()) for i in range(120)]  # a large group of copies
    odd = [(2000, None), (2001, []), (2002, [0.0] * 64), (2003, [float("nan")] * 64), (2004, [1.0, None] * 32), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (0, rows[0][1]), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("n", F.lit(1))
    got = {r["vec_id"]: r for r in pivot_index.near_vectors(df).collect() if r["vec_id"] is not None}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = x @ x.T >= 0.9
    degree = links.sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= degree).all() and found.sum() >= 0.9 * degree.sum()
    assert got[1000]["component_id"] == 7 and not got[1000]["kept"] and got[7]["kept"]
    for i in (2000, 2001, 2002, 2003, 2004):
        assert got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"]
    assert got[2006]["component_id"] == 2005 and got[2005]["n_links"] == 1
    assert pivot_index.near_vectors(df.limit(0)).count() == 0


def brute_components(sets, above=80, below=100):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and below * len(x & y) >= above * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, corpus, width):
    df = documents(spark, [*corpus, (303, "one")])
    rows = minmax_hash.near_duplicates(df, width=width).collect()
    assert len(rows) == len(corpus) + 1
    sets = {i: minmax_hash.shingle_set((t or "").encode(), width) for i, t in corpus if i is not None}
    want = brute_components(sets)
    for row in rows:
        if row["doc_id"] is None:
            assert row["component_id"] is None and row["kept"]
        else:
            assert row["component_id"] == want[row["doc_id"]] and row["n_shingles"] == len(sets[row["doc_id"]])
            assert row["kept"] == (row["component_id"] == row["doc_id"])
    assert minmax_hash.near_duplicates(df.limit(0), width=width).count() == 0


def test_near_duplicates_that_the_smallest_member_does_not_link(spark):
    """Variants of one text whose smallest id is far from some that are near each other."""
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(40):
        words = list(base)
        for _ in range(rnd.choice([2, 6, 10, 14])):
            words[rnd.randrange(200)] = f"v{i % 8}"
        texts.append((i, " ".join(words)))
    sets = {i: minmax_hash.shingle_set(t.encode(), 2) for i, t in texts}
    got = {r["doc_id"]: r["component_id"] for r in minmax_hash.near_duplicates(documents(spark, texts), width=2).collect()}
    assert got == brute_components(sets)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (500, 499)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(60)) and got[500] == got[499] == 499


def test_quality_counts_and_cutoffs(spark, corpus):
    lined = ["a b\nc\na b", " a\nb\na", "a\nb\na ", "a\r\na", "\n\na\n \n\na\na\n", "#1 $2\n|%&\n#1 $2\n", "\x1ca\n\x1ca", " \n \n"]
    texts = corpus + [(400 + i, t) for i, t in enumerate(lined)]
    rows = [r.asDict() for r in quality_rules.features(documents(spark, texts)).collect()]
    assert len(rows) == len(texts)
    for row in rows:
        text = row["text"] or ""
        words = [w.decode() for w in text.encode().split()]
        seen = collections.Counter(zip(words, words[1:], words[2:]))
        covered = {i + j for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for j in range(3)}
        assert (row["n_words"], row["word_chars"], row["n_repeat_words"]) == (len(words), sum(map(len, words)), len(covered))
        lines = [line for line in text.split("\n") if line.encode().split()]
        assert (row["n_lines"], row["n_dup_lines"]) == (len(lines), len(lines) - len(set(lines))), repr(text[:40])
        assert row["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
    tails = spark.createDataFrame([(k, n) for n in (5, 40, 700, 5000) for k in (0, 1, 3, 17) if k < n], "k long, n long")
    for k, n, tail in tails.select("k", "n", quality_rules.binomial_tail("k", "n", "0.01D")).collect():
        exact = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.01) + (n - i) * math.log(0.99)) for i in range(k + 1))
        assert tail == pytest.approx(min(1, exact), rel=1e-8)
    good = spark.range(4000).selectExpr("id as doc_id", "'en' as lang", "100L as n_words", "600L as word_chars", "case when id < 4 then 300L else 0L end as n_symbols", "0L as n_marks", "9L as n_lines", "0L as n_dup_lines", "0L as n_repeat_words")
    labels = spark.range(4000).selectExpr("id as doc_id", "1 as quality")
    cut = quality_rules.fit_cutoffs(good, labels).collect()
    assert len(cut) == 1 and cut[0]["cut_mark_share"] == 1 and cut[0]["cut_symbol_share"] in range(1, 27)
    few = quality_rules.fit_cutoffs(good.where("doc_id < 50"), labels)
    assert few.count() == 0
    judged = quality_rules.judge(good, few)
    assert judged.where("kept").count() == 4000
    assert quality_rules.features(documents(spark, corpus).limit(0)).count() == 0


def test_quality_cutoffs_hold_the_joint_risk(spark):
    """All rules are tested together at the whole risk; few labels fall back to the pooled stratum; a failed test does not."""
    rnd = random.Random(8)
    rows, labels = [], []
    sizes = {"aa": 800, "bb": 100, "cc": 600, None: 40, "none": 0}
    for lang, n in sizes.items():
        for kind in ("good", "bad", "new"):
            for k in range(n if kind == "good" else 60):
                junk = kind == "bad" or (kind == "new" and k < 6)
                symbols = rnd.randrange(60, 200) if junk and k % 2 else 0
                marks = rnd.randrange(60, 200) if junk and not k % 2 else 0
                lines = rnd.randrange(10) if kind != "bad" and not k % 8 else 0  # good documents differ here: no rule for them
                # Good documents of cc look like junk.
                symbols = 150 if lang == "cc" and kind == "good" and k % 10 == 0 else symbols
                rows.append((len(rows), lang, 100, 600, symbols, marks, 20, lines, 0))
                if kind != "new":
                    labels.append((rows[-1][0], int(kind == "good")))
    measured = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_marks long, n_lines long, n_dup_lines long, n_repeat_words long")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    cutoffs = quality_rules.fit_cutoffs(measured, labelled)
    cut = {r["stratum"]: r for r in cutoffs.collect()}
    assert cut["aa"]["cut_symbol_share"] <= 5 and cut["aa"]["cut_mark_share"] <= 5
    # 60 of 600 good documents of cc are no proof, and enough to spoil the pooled stratum's way to the junk.
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(measured, cutoffs).collect()}
    quality = dict(labels)
    wrong = collections.Counter((r[1], quality.get(r[0])) for r in rows if not kept[r[0]])
    assert wrong["aa", 0] == 60 and wrong["aa", 1] < 0.01 * 800
    assert wrong["cc", 1] < 0.01 * 600 and "none" not in cut
    assert sum(n for (_, good), n in wrong.items() if good == 1) < 0.01 * sum(sizes.values())
    # Without cc the pooled stratum is proven, and the strata with few labels use it.
    cutoffs = quality_rules.fit_cutoffs(measured.where("lang is null or lang <> 'cc'"), labelled)
    cut = {r["stratum"]: r for r in cutoffs.collect()}
    assert set(cut) == {"aa", "bb", ""} and cut["bb"][1:] == cut[""][1:]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(measured, cutoffs).collect()}
    assert not any(kept[r[0]] for r in rows if r[1] in ("aa", "bb", None) and quality.get(r[0]) == 0)
    assert all(kept[r[0]] for r in rows if r[1] == "none")


def brute_repeats(texts):
    first = {}
    words = {i: (t or "").encode().split() for i, t in texts if i is not None}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    out = {}
    for i, w in words.items():
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                keep[k : k + 13] = [False] * 13
        out[i] = b" ".join(x for x, y in zip(w, keep, strict=True) if y).decode()
    return out


@pytest.mark.parametrize("all_hot", [False, True])
def test_repeats_equal_brute_force_in_both_ways(spark, corpus, all_hot, monkeypatch):
    if all_hot:
        minis = sorted({int(m) for _, t in corpus for w in [(t or "").encode().split()] if len(w) >= 13 for m in superkmer.runs(w)[0]})
        monkeypatch.setattr(superkmer, "hot_minimisers", lambda docs: (minis, 1000))
    df = documents(spark, corpus)
    rows = superkmer.remove_repeats(df).collect()
    want = brute_repeats(corpus)
    assert len(rows) == len(corpus)
    for row in rows:
        if row["doc_id"] is None:
            assert row["n_removed"] == 0
        else:
            assert row["text"] == want[row["doc_id"]], row["doc_id"]
            assert row["n_words"] - row["n_removed"] == len(want[row["doc_id"]].split())
    assert superkmer.remove_repeats(df.limit(0)).count() == 0


def test_packing_places_every_piece(spark):
    rng = np.random.default_rng(2)
    sizes = [int(x) for x in rng.integers(0, 1025, 3000)] + [1024] * 50 + [1] * 500
    items = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, length long")
    for group in (100, 50_000):  # one level and several
        rows = packing.pack(items, group_items=group, fan_in=3).collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(len(sizes)))
        bins = collections.defaultdict(list)
        for r in rows:
            if r["length"]:
                bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for placed in bins.values():
            at = 0
            for offset, n in sorted(placed):
                assert offset == at
                at += n
            assert at <= 1024
        # groups of 100 items leave little to choose from; production groups hold 50,000
        assert len(bins) <= (1.06 if group == 100 else 1.03) * math.ceil(sum(sizes) / 1024)
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 2000)], "doc_id long, length long"))
    assert packing.pack(items.limit(0)).count() == 0


def test_pieces_of_null_and_long_texts(spark):
    df = documents(spark, [(1, None), (2, "word " * 1500), (3, "")])
    rows = packing.pieces(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    by = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        by[r["doc_id"]].append((r["start"], r["length"], np.frombuffer(r["ids"], "<u4").tolist()))
    assert by[1] == [(0, 1, [2])] and by[3] == [(0, 1, [2])]
    total = sum(n for _, n, _ in by[2])
    assert [n for _, n, _ in by[2]] == [total - 1024, 1024] and by[2][1][0] == total - 1024 and by[2][-1][2][-1] == 2


def test_scoring_base_is_exact_and_model_is_normalised(spark, corpus):
    df = documents(spark, corpus)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = maxent.score(df, held).collect()
    assert len(rows) == len(corpus)
    texts = dict(corpus)
    tokens = lambda t: (t or "").encode().lower().split() + [b""]
    counts = collections.Counter()
    for row in rows:
        if not row["held_out"]:
            counts.update(tokens(texts[row["doc_id"]]))
    total, distinct = sum(counts.values()), len(counts)
    for row in rows:
        mine = tokens(texts[row["doc_id"]])
        assert row["n_tokens"] == len(mine) and row["train_tokens"] == total and row["n_known"] == sum(counts[w] > 0 for w in mine)
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in mine), rel=1e-9)
        assert row["score"] < 0
    weights = np.random.default_rng(0).normal(size=(maxent.FEATURES, maxent.CLASSES)).astype(np.float32)
    logs = maxent.log_softmax(weights, np.zeros(maxent.CLASSES, np.float32), np.array([[1, 2], [3, 4], [5, 6]]))
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-5)
    assert maxent.score(df.limit(0), held).count() == 0


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    texts = [(1, "Released under the MIT License.\nmit license"), (2, mit), (3, "the general public, license"), (4, None), (5, "GNU GENERAL PUBLIC LICENSE version 3 " + "x " * 3000),
             (6, "Licensed under the Apache License, Version 2.0."), (7, "Redistribution and use"), (8, "All rights reserved."), (9, "ünder Mit-License"), (4, None)]
    got = {r["doc_id"]: r for r in license_scan.scan(documents(spark, texts)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"], got[1]["labels"]) == (2, 3, 5, "mit", "mit")
    assert got[2]["base_labels"] == "" and got[2]["labels"] == "mit" and got[2]["score"] > 0.5
    assert got[3]["base_labels"] == "gpl" and got[5]["n_base"] == 1 and got[5]["first_word"] == 1
    assert got[4]["n_words"] == 0 and got[4]["labels"] == "" and got[4]["score"] == 0 and got[4]["first_word"] is None
    assert got[6]["labels"] == "apache" and got[7]["labels"] == "" and got[8]["labels"] == "all-rights-reserved" and got[9]["n_base"] == 1
    assert license_scan.scan(documents(spark, texts).limit(0)).count() == 0


def brute_labels(text):
    """Labels and score with every licence word of every template counted at every relative position."""
    words = re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", (text or "").translate(str.maketrans(license_scan._UPPER, license_scan._LOWER)))
    line = f" {' '.join(words)} "
    found = {label for phrase, label in license_scan.BASE_PHRASES.items() if f" {phrase} " in line}
    best = 1.0 if found else 0.0
    for label, notice, keys in license_scan.TEMPLATES:
        places = [(i, w) for i, w in enumerate(notice.split()) if w not in license_scan.FUNCTION_WORDS]
        support = collections.Counter(k - i for k, w in enumerate(words) for i, v in places if v == w)
        share = max(support.values(), default=0) / len(places)
        if share >= license_scan.COVERAGE and all(f" {key} " in line for key in keys):
            found.add(label)
            best = max(best, share)
    return ",".join(sorted(found)), best


def test_licences_of_files_with_several_notices(spark):
    notices = [n for _, n, _ in license_scan.TEMPLATES]
    rnd = random.Random(4)
    texts = [" ".join(notices), "\n".join(reversed(notices)), "\n".join(notices[i] for i in (2, 7, 12, 1)), "\n".join(notices[i] for i in (1, 6, 5)), "\n".join(notices[i] for i in (1, 5, 12))]
    texts += [" filler ".join(rnd.sample(notices, k)) for k in (2, 3, 4, 5, 8)]
    # A word changed, dropped or moved, so that places differ; key phrases without enough of their notice, more than once.
    for _ in range(20):
        words = " x ".join(rnd.sample(notices, 4)).split()
        for _ in range(6):
            words[rnd.randrange(len(words))] = rnd.choice(["", "software", "other", "license"])
        texts.append(" ".join(words))
    texts += ["permission is hereby granted free of charge", "public license " * 500 + notices[5]]
    rows = list(enumerate(texts)) + [(900, "permission is hereby granted free of charge")] * 3 + [(901, texts[0])] * 2
    out = license_scan.scan(documents(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(i for i, _ in rows)
    want = dict(rows)
    for row in out:
        labels, score = brute_labels(want[row["doc_id"]])
        assert row["labels"] == labels and row["score"] == pytest.approx(score), row["doc_id"]
    assert brute_labels(texts[2])[0] == "all-rights-reserved,apache,mit,mpl"


def test_language_forward_sum_is_over_all_segmentations():
    names = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba"]
    matrix = np.array([[0.2, 0.1], [0.1, 0.2], [0.1, 0.1], [0.2, 0.1], [0.1, 0.2], [0.1, 0.2], [0.2, 0.1]])
    model = lang_id.Model(["x", "y"], names, matrix)
    index = {n: matrix[i] for i, n in enumerate(names)}

    @functools.cache
    def brute(text):
        if not text:
            return np.ones(2)
        total = lang_id.UNCOVERED * brute(text[1:])
        return total + sum((index[text[:n]] * brute(text[n:]) for n in range(1, len(text) + 1) if text[:n] in index), np.zeros(2))

    words = sorted(["ab", "abab", "ba", "a", "bzb", "abbaabbaabbaabbaabba", "ab" * 30], key=len, reverse=True)
    for word, logs in zip(words, model.forward(words), strict=True):
        assert np.allclose(logs, np.log(brute("▁" + word)))


def test_language_id(spark):
    english, german = "the house and the garden of this town are old ", "das haus und der garten in dieser stadt sind alt "
    train = spark.createDataFrame([(i, (english if i % 2 else german) * 3, "en" if i % 2 else "de", "l") for i in range(40)], "doc_id long, text string, lang string, lang_pred string")
    model = lang_id.fit(train, public_tokenizers.path("piece_bpe_32k.model"))
    rows = spark.createDataFrame([(1, english), (2, german), (3, None), (4, "12 34 !!"), (5, ""), (6, "z" * 5000), (1, english), (7, "²")], "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in lang_id.predict(rows, model).collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"]))
    assert [a for a, _ in got[1]] == ["en", "en"] and got[2][0][0] == "de" and got[6][0][0] in ("en", "de")
    assert all(got[i] == [("und", 0.0)] for i in (3, 4, 5, 7))
    empty = lang_id.fit(train.limit(0), public_tokenizers.path("piece_bpe_32k.model"))
    assert {r["lang_pred"] for r in lang_id.predict(rows, empty).collect()} == {"und"}


def test_chat_round_trip_and_parts(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user<|text|>x", "a\\b\\\\<\\|", None, "", "<|" * 50, "\\", "é\n\n"]
    assert all(chat_format.unescape(chat_format.escape(t or "")) == (t or "") and "<|" not in chat_format.escape(t or "") for t in nasty)
    rows = [(c, k, "assistant" if k % 2 else "user", t) for c in (1, 2, None) for k, t in enumerate(nasty)] + [(2, 0, "user", "tie"), (3, None, None, "x")]
    rows += [(9, k, "assistant", f"t{k}") for k in range(300)]  # one long conversation
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("start", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(df)).collect()}
    for conv in (1, 2, 9, None, 3):
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        trained = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[conv]["n_turns"] == len(turns)
        assert got[conv]["loss_chars"] == len(trained) and got[conv]["loss_sha256"] == hashlib.sha256(trained.encode()).hexdigest()
    assert chat_format.format_conversations(df.limit(0)).count() == 0
    parts = spark.sql(f"""select 1L as conv_id, 0L as turn, 'user' as role, from_json('[{{"kind":"text","text":"see <|"}},{{"kind":"image","uri":"i.png","width":56,"height":30}},
        {{"kind":"audio","uri":"a.wav","seconds":2.5}},{{"kind":"document","uri":"d.pdf","pages":3}},{{"kind":"video","uri":"v"}}]', '{chat_format.PART}') as parts""")
    row = chat_format.format_conversations(parts).first()
    content = row["formatted"][len("<|turn|>user<|text|>") :]
    assert [(a["kind"], a["uri"], a["tokens"]) for a in row["attachments"]] == [("image", "i.png", 4), ("audio", "a.wav", 63), ("document", "d.pdf", 1536), ("unknown", "v", 0)]
    assert all(content[a["place"] :].startswith(f"<|{a['kind']}:{i}|>") for i, a in enumerate(row["attachments"]))
    assert row["expanded_tokens"] == 4 + 63 + 1536 and row["loss_length"] == 0


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        before, docs = docs.count(), spark.createDataFrame(out.toPandas(), docs.schema)
        assert 0 < docs.count() <= before
    packed = corpus_pipeline.STAGES[4][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()

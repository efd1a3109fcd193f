"""Reversed search, line runs and periodic runs against brute force, operator and registered query, on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonescope.llm import line_runs, recompression, reversed_search
from zonescope.llm.queries import planted_repeats, spark_queries

DOCS = "doc_id long, text string, lang string, key string, gone string, score int, rank int, runs string, n_docs int, _pile int, batch int, _more int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts):
    """Rows with extra and clashing columns."""
    return spark.createDataFrame([(i, t, "en", "k", "g", 1, 2, "r", 3, 4, 5, 6) for i, t in texts], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(spark, folder, docs, items=()):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    return folder


# ---------------------------------------------------------------- ranked lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(UPPER))


def search_brute(docs, items, top=10):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i].update(terms_of(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own & c.keys())
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, e[3], -e[0]) for r, e in enumerate(sorted(scored, key=lambda e: e[:3])[:top])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def library():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(150)] + ["Été", "naïve", "日本", "x1y", "ÉTÉ"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    texts = [(i, rnd.choice([" ", "-", "\n"]).join(rnd.choices(vocabulary, weights, k=rnd.choice([1, 5, 40, 90])))) for i in range(150)]
    texts += [(200 + i, "W3 w7 w9, w9") for i in range(40)]  # ties: copies
    texts += [(300, None), (301, ""), (302, "!?"), (303, "w1 " * 4000), (None, "w3 w7 w9 w9"), (303, "w120"), (-5, "w3 w7 w9 w9")]
    items = [(i, " ".join(rnd.choices(vocabulary, k=8))) for i in range(12)]
    items += [(50, "w3 W7 w9 w9"), (51, None), (52, ""), (53, "absent"), (54, "w5"), (54, "w6"), (None, "w8 naïve"), (-1, "été")]
    return texts, items


@pytest.mark.parametrize("parts", [1, 7])
def test_search_equals_brute_force(spark, library, parts):
    texts, items = library
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, doc_id string")
    rows = reversed_search.search(documents(spark, texts).repartition(parts), table).collect()
    assert sorted(map(tuple, rows), key=str) == search_brute(texts, items)


def test_search_in_blocks_and_small_steps(spark, library, monkeypatch):
    texts, items = library
    monkeypatch.setattr(reversed_search, "BLOCK_BYTES", 900)
    rows = reversed_search.search(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"), top=3).collect()
    assert sorted(map(tuple, rows), key=str) == search_brute(texts, items, 3)


def test_search_empty_tables(spark):
    docs, items = documents(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert reversed_search.search(docs, items).collect() == []
    assert reversed_search.search(docs, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []
    assert reversed_search.search(documents(spark, [(1, "a")]), items).collect() == []


def test_search_query(spark, library, workdir):
    texts, items = library
    folder = written(spark, workdir, [(i, t, "en", "s", 1) for i, t in texts], items)
    df = spark_queries()["op11_reversed_search"](spark, folder)
    assert df.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, df.collect()), key=str) == search_brute(texts, items)


def test_heaps_keep_the_best():
    heaps = reversed_search._Heaps(1, 2)
    heaps.offer([7, None, 3], np.array([[5], [5], [5]]))
    heaps.offer([1, 9], np.array([[5], [0]]))
    assert sorted(heaps.heaps[0]) == [(5, ~3), (5, ~1)]


# ---------------------------------------------------------------- line dedup

SPACE = " \t\n\x0b\x0c\r"


def lines_brute(docs, min_docs=3, min_chars=20):
    key = lambda line: line.strip(SPACE).translate(UPPER)
    holders = defaultdict(set)
    for doc, text in docs:
        if doc is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= min_chars:
                    holders[key(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders[key(x)]) < min_docs or doc == max(holders[key(x)])]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def paged():
    rnd = random.Random(8)
    common = ["A line that very many pages share  ", "é" * 19, "é" * 20, "x" * 19, "Twice only, this one line", "\x1cnot a space here, not cut"]
    lines = [f"sentence number {i} of some length" for i in range(60)] + common
    texts = [(i, "\n".join(rnd.choices(lines, k=rnd.choice([0, 1, 3, 12])))) for i in range(120)]
    texts += [(500 + i, "  a LINE that very many pages share\t\nown line of document " + str(i)) for i in range(60)]
    texts += [(700, None), (701, ""), (702, "\n\n"), (703, ("a line that very many pages share\n") * 500 + "end"), (704, "twice only, THIS one line"), (705, "Twice only, this one line\r")]
    texts += [(None, "A line that very many pages share"), (3, "sentence number 1 of some length"), (900, "É" * 20), (901, "é" * 20), (902, "É" * 20)]
    return texts


@pytest.mark.parametrize("batches, fan_in", [(1, 2), (6, 3)])
def test_lines_equal_brute_force(spark, paged, batches, fan_in):
    rows = line_runs.drop_repeated_lines(documents(spark, paged), batches=batches, fan_in=fan_in).collect()
    assert sorted(map(tuple, rows), key=str) == lines_brute(paged)


def test_lines_empty_table(spark):
    assert line_runs.drop_repeated_lines(documents(spark, [])).collect() == []


def test_runs_are_levelled_disjoint_and_removed(spark, paged):
    tables = lambda: {t.name for t in spark.catalog.listTables()}
    before = tables()
    lines = line_runs.line_digests(line_runs.id_and_text(documents(spark, paged))).distinct().cache()
    store = line_runs.LineRuns(spark, fan_in=2)
    for number in range(5):
        store.add(lines.where(F.pmod("doc_id", F.lit(5)) == number))
    assert [len(level) for level in store.levels] == [1, 0, 1]  # 5 batches in base 2
    keys = [set(r.key for r in spark.table(run).select("key").collect()) for run in store.runs]
    assert sum(map(len, keys)) == len(set().union(*keys)) == lines.select("key").distinct().count()
    plan = store.spark.table(store.runs[0]).join(spark.table(store.runs[1]).hint("merge"), "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    counts = lines.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("holder")).where("n >= 3")
    assert set(map(tuple, store.settle(3).collect())) == {(r.key, r.holder) for r in counts.collect()}
    store.close()
    assert tables() == before


def test_lines_query(spark, paged, workdir):
    folder = written(spark, workdir, [(i, t, "en", "s", 1) for i, t in paged])
    rows = spark_queries()["op12_line_runs"](spark, folder).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(((d, n, gone, sha(t)) for d, t, n, gone in lines_brute(paged)), key=str)


# ---------------------------------------------------------------- periodic runs


def runs_brute(words, exponent=4, least=6):
    found = {}
    for p in range(1, len(words) // exponent + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i - s + p >= max(least, exponent * p):
                found.setdefault((s, i - s + p), p)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapse_brute(words, runs):
    return [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5), st.sampled_from([3, 4, 5]), st.sampled_from([1, 6]))
def test_runs_equal_brute_force(docs, exponent, least):
    columns = recompression.find_runs(np.array([w for d in docs for w in d], np.int64), np.array([len(d) for d in docs]), exponent, least)
    assert list(zip(*(c.tolist() for c in columns), strict=True)) == [(d, *run) for d, words in enumerate(docs) for run in runs_brute(words, exponent, least)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=2, max_size=120), st.data())
def test_grammar_extensions(words, data):
    n = len(words)
    grammar = recompression.Grammar(np.array([0, *[w + 2 for w in words], 1]), 2)
    i = data.draw(st.integers(0, n - 2))
    j = data.draw(st.integers(i + 1, n - 1))
    ahead = next((k for k in range(n) if j + k >= n or words[i + k] != words[j + k]), n)
    behind = next((k for k in range(n) if i - k < 0 or words[i - k] != words[j - k]), n)
    assert grammar.agreement(np.array([i + 1]), np.array([j + 1])).tolist() == [ahead]
    assert grammar.agreement(np.array([i + 1]), np.array([j + 1]), forward=False).tolist() == [behind]
    below = grammar.symbols[-1]
    assert len(below) == 3  # two separators and one symbol for the document


@pytest.fixture(scope="module")
def repeating():
    rnd = random.Random(2)
    texts = [(i, " ".join(rnd.choices("a b c d e f g".split(), k=rnd.choice([0, 5, 6, 40, 150])))) for i in range(80)]
    texts += [(100 + i, "start " + "one two three " * (i + 1) + "end") for i in range(12)]
    texts += [(200, None), (201, ""), (202, " \t\n"), (203, "z " * 5000), (204, "z z z z z"), (205, "a b " * 3000 + "c d e " * 900), (None, "k " * 8), (3, "q " * 9), (206, "É é " * 9)]
    texts += [(300 + i, " ".join(rnd.choices([f"w{k}" for k in range(400)], k=200))) for i in range(60)]
    return texts


def expected_runs(doc, text, rewrite=False):
    words = [w for w in re.split(f"[{SPACE}]+", text or "") if w]
    if rewrite:
        words = [w.decode() for w in planted_repeats(doc, [w.encode() for w in words])]
    return words, runs_brute(words)


def test_periodic_runs_equal_brute_force(spark, repeating, monkeypatch):
    monkeypatch.setattr(recompression, "GRAMMAR_BYTES", 2000)
    rows = recompression.periodic_runs(documents(spark, repeating)).collect()
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in rows), key=str)
    want = []
    for doc, text in repeating:
        words, runs = expected_runs(doc, text)
        want.append((doc, len(words), runs, " ".join(collapse_brute(words, runs))))
    assert got == sorted(want, key=str)


def test_periodic_runs_empty_table(spark):
    assert recompression.periodic_runs(documents(spark, [])).collect() == []


def test_planting_rule():
    words = [b"%d" % i for i in range(50)]
    planted = 0
    for doc in range(200):
        h = zlib.crc32(str(doc).encode())
        got = planted_repeats(doc, words)
        if h % 10:
            assert got == words
            continue
        planted += 1
        g = h // 10
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        assert got == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
    assert planted > 5 and planted_repeats(None, words) == words and planted_repeats(3, []) == []


def test_periodic_query(spark, repeating, workdir):
    folder = written(spark, workdir, [(i, t, "en", "s", 1) for i, t in repeating])
    df = spark_queries()["op13_recompression"](spark, folder)
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want, planted = [], 0
    for doc, text in repeating:
        words, runs = expected_runs(doc, text, rewrite=True)
        planted += words != expected_runs(doc, text)[0]
        s, n, p = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        want.append((doc, len(runs), s, n, p, 1000 * n // p if runs else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(collapse_brute(words, runs)))))
    assert planted >= 5
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)

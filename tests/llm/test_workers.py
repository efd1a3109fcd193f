"""What workers keep between tasks, and the work of a training step."""

import math
import os
import uuid
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa

from zonescope.llm import bpe, lang_id, maxent, minmax_hash
from zonescope.llm.common import Memo, arrow_map, worker_table


def test_a_worker_keeps_one_table_over_its_tasks(spark):
    name = uuid.uuid4().hex

    def make():
        table = worker_table(("test", name), lambda: uuid.uuid4().hex)
        return lambda batch: pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([table])], names=["pid", "made"])

    rows = arrow_map(spark.range(64).repartition(64), "pid long, made string", make).distinct().collect()
    assert len({r["pid"] for r in rows}) == len(rows)  # 64 tasks, one table per worker


def test_a_task_leaves_no_memos_to_the_next(spark):
    name = uuid.uuid4().hex

    def make():
        memo, looked = worker_table(("memo", name), lambda: Memo(str)), []

        def step(batch):
            looked.append(len(memo))
            for i in batch.column(0).to_pylist():
                memo[i]
            return pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([looked[0]])], names=["pid", "n"])

        return step

    rows = arrow_map(spark.range(0, 64, 1, 64), "pid long, n long", make).collect()
    assert len({r["pid"] for r in rows}) < len(rows) == 64 and {r["n"] for r in rows} == {0}


def test_language_models_forget_words_but_keep_tables():
    model = lang_id.Model(["x", "y"], ["a", lang_id.WORD_START], np.full((2, 2), 0.5))
    first = model.score(["a aa", "aaa"])
    model.forget()
    assert not model.rows and not len(model.logs) and model.score(["a aa", "aaa"]) == first


def test_another_table_takes_the_place_of_the_first():
    first = worker_table(("a",), lambda: [1])
    assert worker_table(("a",), lambda: [2]) is first
    assert worker_table(("b",), lambda: [3]) == [3] and worker_table(("a",), lambda: [4]) == [4]


def test_two_models_of_one_process_do_not_mix(spark, tmp_path):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(i, "the house and the garden", "en") for i in range(4)], "doc_id long, text string, lang string")
    for lang in ("en", "xx", "en"):
        model = lang_id.fit(docs.selectExpr("doc_id", "text", f"'{lang}' as lang"), path)
        assert {r["lang_pred"] for r in lang_id.predict(docs, model).collect()} == {lang}


def test_a_training_step_sorts_its_features_by_radix(monkeypatch):
    seen, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **options: seen.append(a.dtype.itemsize) or sort(a, **options))
    trainer = maxent.Trainer(np.zeros((maxent.FEATURES, maxent.CLASSES), np.float32), np.zeros(maxent.CLASSES, np.float32))
    tokens, starts = maxent.batch_tokens([b"One two one", b"", b"two"])
    assert tokens == [b"one", b"two", b"one", maxent.END, maxent.END, b"two", maxent.END] and starts == [0, 4, 5]
    trainer.learn(maxent.batch_codes(tokens, maxent.coder({})), np.array(starts))
    assert seen == [2, 2, 2] and maxent.FEATURES <= 1 << 16


def test_language_id_works_in_small_slices(spark, monkeypatch):
    docs = spark.range(0, 4000, 1, 1).selectExpr("id as doc_id", "repeat('some words ', 200) as text")
    rows = arrow_map(docs, "n long", lambda: lambda b: pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]), lang_id.SLICE_BYTES).collect()
    assert len(rows) >= 4 and max(r["n"] for r in rows) <= lang_id.SLICE_BYTES * 1.2
    names = ["a", "b", "ab", lang_id.WORD_START + "a"]
    words = {a + b for a in "abc" for b in ("", "ab", "cab" * 8, "b" * 40)}
    whole = lang_id.Model(["x", "y"], names, np.full((4, 2), 0.25))
    whole.learn(words)
    monkeypatch.setattr(lang_id, "SCORED", 3)
    parts, sizes, forward = lang_id.Model(["x", "y"], names, np.full((4, 2), 0.25)), [], lang_id.Model.forward
    monkeypatch.setattr(lang_id.Model, "forward", lambda self, some: sizes.append(len(some)) or forward(self, some))
    parts.learn(words)
    assert max(sizes) == 3 and all((whole.logs[whole.rows[w]] == parts.logs[parts.rows[w]]).all() for w in words)


def test_parts_not_seen_yet_are_cut_together(monkeypatch):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as handle:
        ranks = bpe.read_ranks(handle.read())
    one, each = bpe.Encoder(ranks, public_tokenizers.PATTERN), bpe.Encoder(ranks, public_tokenizers.PATTERN)
    calls, find = [], one.find
    one.find = lambda text: calls.append(text) or find(text)
    text = "it's " + " ".join(f"wörd{i},x\t{i % 7}'re\n!?{chr(97 + i % 26) * i}\n" + "y" for i in range(60))
    assert one.encode(text) == each._cut(text) and len(calls) == 2
    assert one.encode(text + " zz") == each._cut(text + " zz") and calls[-2:] == [" zz", "it's"]
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 40)
    assert one.encode(text + " zzz") == each._cut(text + " zzz") and one.encode(text) == each._cut(text)
    assert not one.queue.buckets and not any(one.queue.low)


def test_pieces_of_several_texts_are_merged_together(monkeypatch):
    """Ranks at random: a merge may bring up a pair of a lower rank, which goes first in its own piece."""
    rnd = np.random.default_rng(5)
    tokens = [bytes([x]) for x in range(256)]
    more = list({bytes(rnd.choice(list(b"abc"), n)) for n in (2, 2, 2, 3, 3, 3, 3, 4, 4, 5) for _ in range(6)})
    ranks = {t: i for i, t in enumerate([*tokens, *(more[i] for i in rnd.permutation(len(more)))])}
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while found := [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in ranks]:
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    pieces = [bytes(rnd.choice(list(b"abc"), rnd.integers(1, 40))) for _ in range(400)] + [b"", b"\0", b"a\0\0a"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.merge_all(pieces)] == [plain(p) for p in pieces]
    assert not encoder.queue.buckets and not any(encoder.queue.low)

    calls, merge_all = [], encoder.merge_all
    encoder.merge_all = lambda some: calls.append(len(some)) or merge_all(some)
    texts = [f"x {''.join(rnd.choice(list('abc'), 12))} {i}" for i in range(50)] + ["", "a  b ", "abcabca"]
    one = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    expected = [np.array([x for piece in one.find(t) for x in plain(piece.encode())], "<u4").tobytes() for t in texts]
    assert encoder.encode_all(texts) == expected and max(calls) >= 50 and len(calls) < 10
    for name, value in (("GROUP_CHARS", 30), ("MERGED_BYTES", 20), ("MEMO_ENTRIES", 5)):
        monkeypatch.setattr(bpe, name, value)
        assert one.encode_all(texts) == expected


def test_scoring_looks_up_a_token_of_a_slice_once(monkeypatch):
    looked = Counter()

    class Codes(dict):
        def __getitem__(self, token):
            looked[token] += 1
            return len(token)

    class Held:
        def __init__(self, value):
            self.value = value

    class Docs:
        def mapInArrow(self, run, schema):
            return run

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 2)

    monkeypatch.setattr(maxent, "coder", lambda singles: Codes())
    monkeypatch.setattr(maxent, "TaskContext", Task)
    texts = ["A b a", None, "c c b zz", "", "a zz zz"]
    weights, bias = np.zeros((maxent.FEATURES, maxent.CLASSES), np.float32), np.zeros(maxent.CLASSES, np.float32)
    head = {b"a": 0.0, b"b": 1.5, maxent.END: 2.0}
    run = maxent._score_rows(Docs(), Held((weights, bias, {}, np.zeros(maxent.CLASSES))), Held(head))
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts), pa.array([False] * 5)], names=["doc_id", "text", "held_out"])
    rows = pa.Table.from_batches(run(iter([batch]))).to_pylist()
    assert set(looked.values()) == {1}
    for i, (row, text) in enumerate(zip(rows, texts, strict=True)):
        words = Counter([*(text or "").lower().encode().split(), maxent.END])
        assert (row["row"], row["doc_id"], row["n_tokens"]) == ((2 << 40) + i, i, words.total())
        assert row["head_known"] == sum(n for w, n in words.items() if w in head)
        assert math.isclose(row["head_sum"], sum(n * head[w] for w, n in words.items() if w in head))
        assert {r["word"]: r["n"] for r in row["rest"]} == {w: n for w, n in words.items() if w not in head}


def test_shared_bands_are_dealt_once(spark):
    rows = [(1, 7), (2, 7), (3, 7), (4, 8), (5, 9), (5, 9), (9, 10), (6, 10), (None, 11)]
    out = minmax_hash.shared_bands(spark.createDataFrame(rows, "doc_id long, band long"))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(out.select("band", "doc_id", "a").collect()) == [(7, 1, 1), (7, 2, 1), (7, 3, 1), (10, 6, 6), (10, 9, 6)]


def test_only_wanted_texts_are_packed_for_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(minmax_hash, "MARKS", 1 << 15)
    rows = [(i, f"text {i}") for i in range(3000)] + [(None, "no id"), (7, "twice"), (9, None), (2**62, "far"), (-5, "below")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame([(i,) for i in (0, 7, 9, 2999, 2**62, -5, 10**6)], "doc_id long")
    marks = np.frombuffer(minmax_hash._marks(wanted), np.uint8)
    assert len(marks) == 1 << 12 and 6 <= np.unpackbits(marks).sum() <= 7
    packed = minmax_hash._packed(docs, wanted)
    unpack = minmax_hash.zstandard.ZstdDecompressor().decompress
    got = sorted((r["doc_id"], unpack(r["z"]).decode()) for r in packed.collect())
    assert got == sorted((i, t or "") for i, t in rows if i in (0, 7, 9, 2999, 2**62, -5))
    assert minmax_hash._packed(docs, wanted.limit(0)).count() == 0
    # All but a few texts are gone before the join deals them by id.
    monkeypatch.setattr(type(docs), "join", lambda self, *_: self)
    assert minmax_hash._packed(docs, wanted).count() < 30

"""Language-model scoring with a hashed maximum-entropy model.

P(token | context) = P(class | context) * P(token | class).  The class factor
is a softmax over ``CLASSES`` classes whose features are the hashed previous
word, the hashed pair of previous words and, as a skip feature, the hashed
word before the previous one.  The most frequent tokens are classes of their
own, other words fall into classes by their ending.  Within a class a token
has its add-one share of the training tokens.

Training goes in rounds: every task of a round starts from the broadcast
weights, makes AdaGrad updates over its share of the training documents, and
sends the change of its weights, which are averaged in two steps by tokens
seen.  Each of the ``ROUNDS`` rounds goes over all training documents.

Counts cover every training token.  The ``HEAD`` most frequent ones are
broadcast; a document's other words are joined to the count table, none of
which is in more than one of ``HEAD`` training tokens, so no key is hot.

Results: a null text is the empty text and has only the end token; rows are
scored one by one, repeated ones alike; without training rows every count is
0; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonescope.llm.common import Memo, arrow_map, byte_texts, ship, slices, stored

#: The end token; no word is empty.
END = b""
CLASSES, SINGLE_CLASSES = 32, 16
FEATURES = 1 << 13
HEAD = 50_000
ROUNDS = 2
RATE, MINIBATCH = 0.5, 8192
CHUNK = 1 << 12
#: Tokens of a minibatch that share a feature: up to so many are summed side by side with those of other features.
SHORT_RUN = 6
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CLASS_BITS = np.uint64(CLASSES - 1)
_START = np.uint64(0x5851F42D4C957F2D)


def class_of(token: bytes, singles: dict[bytes, int]) -> int:
    found = singles.get(token)
    return found if found is not None else SINGLE_CLASSES + xxhash.xxh32_intdigest(token[-2:]) % (CLASSES - SINGLE_CLASSES)


class Coder:
    """Token -> its hash with its class in the low bits."""

    def __init__(self, singles: dict[bytes, int]):
        self.singles, self.classes = pa.array(list(singles), pa.binary()), np.array([*singles.values(), 0], np.uint64)
        self.endings = Memo(lambda ending: class_of(ending, {}))

    def __getitem__(self, token: bytes) -> int:
        return int(self.many([token])[0])

    def many(self, tokens: list[bytes]) -> np.ndarray:
        """Most words of a corpus are rare: they are hashed side by side and none is remembered."""
        codes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens)) & ~_CLASS_BITS
        classes = np.fromiter(map(self.endings.__getitem__, [t[-2:] for t in tokens]), np.uint64, len(tokens))
        single = pc.index_in(pa.array(tokens, pa.binary()), value_set=self.singles).fill_null(-1).to_numpy()
        return codes | np.where(single >= 0, self.classes[single], classes)


def coder(singles: dict[bytes, int]) -> Coder:
    return Coder(singles)


def token_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all rows of (text): summed per batch before the shuffle."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: Counter = Counter()
        data = byte_texts(batch)
        for text in data:
            seen.update(text.lower().split())
        seen[END] = len(data)
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return arrow_map(docs.select("text"), "word binary, n long", lambda: step).groupBy("word").agg(F.sum("n").alias("n"))


def class_totals(counts: DataFrame, singles: dict[bytes, int]) -> np.ndarray:
    """Per class: training tokens and distinct tokens."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        classes = np.fromiter((class_of(w, singles) for w in batch.column("word").to_pylist()), np.int64, batch.num_rows)
        n = np.bincount(classes, batch.column("n").to_numpy(), CLASSES).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(n), pa.array(np.bincount(classes, minlength=CLASSES))], names=["class", "n", "v"])

    rows = arrow_map(counts, "class int, n long, v long", lambda: step).groupBy("class").agg(F.sum("n"), F.sum("v")).collect()
    out = np.zeros((2, CLASSES))
    for number, n, v in rows:
        out[:, number] = n, v
    return out


def batch_tokens(data: list[bytes]) -> tuple[list[bytes], list[int]]:
    """All tokens of a batch of texts, and where each text starts."""
    tokens, starts = [], []
    for text in data:
        starts.append(len(tokens))
        tokens += text.lower().split()
        tokens.append(END)
    return tokens, starts


def numbered(tokens: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct tokens in their first order, and the place of every token among them."""
    numbers = pa.array(tokens, pa.binary()).dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(numbers), prepend=-1))
    return [tokens[i] for i in first.tolist()], numbers


def batch_codes(tokens: list[bytes], codes) -> np.ndarray:
    """The code of every token: of a :class:`Coder`, or looked up one by one."""
    if isinstance(codes, Coder):
        return codes.many(tokens)
    return np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))


def run_sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``rows`` over the runs of ``order`` that start at ``first``: most are short and summed side by side, the others one by one."""
    sizes = np.diff(np.append(first, len(order)))
    out = rows.take(order[first], axis=0)
    short = sizes <= SHORT_RUN
    for k in range(1, SHORT_RUN):
        at = np.flatnonzero(short & (sizes > k))
        out[at] += rows.take(order[first[at] + k], axis=0)
    if not short.all():
        longer = sizes[~short]
        out[~short] = np.add.reduceat(rows.take(order[np.repeat(~short, sizes)], axis=0), np.cumsum(longer) - longer)
    return out


def feature_rows(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The three hashed features of every token, from the two tokens before it in its text."""
    one, two = np.empty_like(codes), np.empty_like(codes)
    one[1:], two[2:] = codes[:-1], codes[:-2]
    one[starts] = two[starts] = _START
    seconds = starts + 1
    two[seconds[seconds < len(codes)]] = _START
    one, two = one >> np.uint64(5), two >> np.uint64(5)
    shift = np.uint64(64 - FEATURES.bit_length() + 1)
    return np.stack([(one + np.uint64(1)) * _MIX >> shift, ((one * _MIX) ^ (two + np.uint64(7))) * _MIX >> shift, (two + np.uint64(0x51ED)) * _MIX * _MIX >> shift]).astype(np.int64)


def _logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of every class, the greatest of a row being zero."""
    logits = weights.take(rows[0], axis=0)
    for part in (weights.take(rows[1], axis=0), weights.take(rows[2], axis=0), bias):
        logits += part
    logits -= logits.max(axis=1, keepdims=True)
    return logits


def softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    shares = _logits(weights, bias, rows)
    np.exp(shares, out=shares)
    shares /= shares.sum(axis=1, keepdims=True)
    return shares


def log_softmax(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, target: np.ndarray | None = None) -> np.ndarray:
    """Of every class, or of each row's ``target`` alone."""
    logits = _logits(weights, bias, rows)
    total = np.log(np.exp(logits).sum(axis=1, keepdims=True))
    if target is not None:
        return logits[np.arange(len(target)), target] - total[:, 0]
    logits -= total
    return logits


class Trainer:
    """AdaGrad on minibatches; the step of a feature follows its own gradients."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.first = weights
        self.weights, self.bias = weights.copy(), bias
        self.squares = np.full(len(weights), 1e-4, np.float32)
        self.tokens = 0

    def learn(self, codes: np.ndarray, starts: np.ndarray) -> None:
        rows, classes = feature_rows(codes, starts), (codes & _CLASS_BITS).astype(np.int64)
        for a in range(0, len(codes), MINIBATCH):
            part, target = rows[:, a : a + MINIBATCH], classes[a : a + MINIBATCH]
            gradient = softmax(self.weights, self.bias, part)
            gradient[np.arange(len(target)), target] -= 1
            for feature in part:
                order = np.argsort(feature.astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
                ordered = feature[order]
                first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                total, at = run_sums(gradient, order, first), ordered[first]
                total /= np.sqrt(np.diff(np.append(first, len(ordered))))[:, None]
                squares = self.squares[at] + np.einsum("ij,ij->i", total, total) / CLASSES
                self.squares[at] = squares
                total *= (RATE / 3 / np.sqrt(squares))[:, None]
                self.weights[at] -= total
        self.tokens += len(codes)

    def change(self) -> bytes:
        return (self.weights - self.first).astype(np.float16).tobytes()


def _average(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    total, tokens = np.zeros(FEATURES * CLASSES, np.float64), 0
    for change, n in zip(frame["change"], frame["tokens"], strict=True):
        total += np.frombuffer(change, np.float16).astype(np.float64) * n
        tokens += n
    return pd.DataFrame({"part": [0], "change": [(total / max(1, tokens)).astype(np.float16).tobytes()], "tokens": [tokens]})


def train_round(docs: DataFrame, weights: np.ndarray, bias: np.ndarray, singles: dict[bytes, int]) -> np.ndarray:
    """One round over (text): new weights."""
    spark = docs.sparkSession
    start = spark.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, codes = Trainer(*start.value), coder(singles)
        for whole in batches:
            for batch in slices(whole, 4 << 20):
                if batch.num_rows:
                    tokens, starts = batch_tokens(byte_texts(batch))
                    words, numbers = numbered(tokens)
                    trainer.learn(batch_codes(words, codes)[numbers], np.array(starts))
        if trainer.tokens:
            part = math.isqrt(TaskContext.get().partitionId())
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([trainer.change()], pa.binary()), pa.array([trainer.tokens], pa.int64())], names=["part", "change", "tokens"])

    schema = "part int, change binary, tokens long"
    changes = docs.select("text").mapInArrow(run, schema)
    merged = changes.groupBy("part").applyInPandas(_average, schema).groupBy("part").applyInPandas(_average, schema).collect()
    for row in merged:
        weights = weights + np.frombuffer(row["change"], np.float16).astype(np.float32).reshape(weights.shape)
    return weights


def _score_rows(docs: DataFrame, model, head) -> DataFrame:
    """Per row: class scores and head counts, and the words that are not in the head.

    Each distinct token of a slice is looked up once; rows count by its number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, singles, class_size = model.value
        codes, common = coder(singles), head.value
        row = TaskContext.get().partitionId() << 40
        names = ["row", "doc_id", "held_out", "n_tokens", "head_known", "head_sum", "class_sum", "rest"]
        for whole in batches:
            for batch in slices(whole, 4 << 20):
                if not batch.num_rows:
                    continue
                data, starts = batch_tokens(byte_texts(batch))
                words, numbers = numbered(data)
                numbers = numbers.astype(np.int64)
                tokens = batch_codes(words, codes)[numbers]
                features, classes = feature_rows(tokens, np.array(starts)), (tokens & _CLASS_BITS).astype(np.int64)
                logs = np.empty(len(tokens))
                for a in range(0, len(tokens), CHUNK):
                    target = classes[a : a + CHUNK]
                    logs[a : a + CHUNK] = log_softmax(weights, bias, features[:, a : a + CHUNK], target)
                logs = np.add.reduceat(logs / math.log(10) - class_size[classes], starts)
                n, counts = len(starts), np.diff(np.append(starts, len(tokens)))
                pairs, times = np.unique(np.repeat(np.arange(n), counts) * len(words) + numbers, return_counts=True)
                text, number = np.divmod(pairs, len(words))
                values = np.fromiter((common.get(word, -1.0) for word in words), np.float64, len(words))[number]
                known, other = values >= 0, values < 0  # log10 of a count and one is not below zero
                head_known = np.bincount(text[known], times[known], n).astype(np.int64)
                head_sum = np.bincount(text[known], times[known] * values[known], n)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text[other], minlength=n))])
                rest = pa.StructArray.from_arrays([pa.array(words, pa.binary()).take(pa.array(number[other])), pa.array(times[other], pa.int64())], ["word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + n), pa.int64()), batch.column("doc_id"), batch.column("held_out"), pa.array(counts, pa.int64()), pa.array(head_known), pa.array(head_sum), pa.array(logs, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)],
                    names=names,
                )
                row += n

    return docs.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_sum double, class_sum double, rest array<struct<word:binary,n:bigint>>")


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = df.sparkSession
    ship(spark)
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = docs.where("not held_out")
    counts = stored(token_counts(training), "lm-counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.col("n").desc(), "word").limit(HEAD).collect()
    singles = {bytes(r["word"]): i for i, r in enumerate(top[:SINGLE_CLASSES])}
    sizes = class_totals(counts, singles)
    bias = np.log((sizes[0] + 1) / (sizes[0].sum() + CLASSES)).astype(np.float32)
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    for _ in range(rounds):
        weights = train_round(training, weights, bias, singles)
    model = spark.sparkContext.broadcast((weights, bias, singles, np.log10(sizes.sum(axis=0) + 1)))
    head = spark.sparkContext.broadcast({bytes(r["word"]): math.log10(r["n"] + 1) for r in top})
    rows = stored(_score_rows(docs, model, head), "lm-rows")
    rest = rows.select("row", F.explode("rest").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    joined = rest.join(counts, "word").groupBy("row").agg(F.sum("times").alias("rest_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest_sum"))
    out = rows.drop("rest").join(joined, "row", "left")
    numerator = F.col("head_sum") + F.coalesce("rest_sum", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (numerator - F.col("n_tokens") * F.lit(math.log10(tokens + distinct + 1))).alias("base_score"),
        (numerator + F.col("class_sum")).alias("score"),
    )

"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary,
counted on all training documents.  A word's probability is the sum over all
its segmentations into pieces (forward algorithm, rescaled at every
character); a text's is the product over its words.  Words are runs of
letters in lower case, whole texts are read.

Results: a null text or one without a letter is ``und`` with score 0; ties go
to the language first in order; rows are judged one by one; an empty training
set makes every text ``und``; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonescope.llm.common import Memo, arrow_map, broadcast_bytes, texts, worker_table

LETTERS = re.compile(r"[^\W\d_]+")
HAS_LETTER = regex.compile(r"\p{L}")
#: Added to every piece's count.
SMOOTHING = 0.1
#: Probability of a character that no piece covers.
UNCOVERED = 1e-7
#: Longest run scored as one word; longer runs are scored in parts of this length.
PART = 64
MAX_LANGUAGES = 500
#: Words (about) a posterior is tempered to, so that the score is not always 0 or 1.
TEMPER_WORDS = 5
WORD_START = "▁"
#: Text that is cut into words at once, and words scored at once: both bound what a worker holds beside its memo.
SLICE_BYTES = 2 << 20
SCORED = 4096
#: Words whose probabilities or pieces are remembered within a task.
REMEMBERED = 100_000


def _words(text: str) -> list[str]:
    words = LETTERS.findall(text.lower())
    if words and len(max(words, key=len)) > PART:
        words = [w[i : i + PART] for w in words for i in range(0, len(w), PART)]
    return words


def _pieces(vocabulary) -> sentencepiece.SentencePieceProcessor:
    return worker_table(("pieces", hash(vocabulary.value)), lambda: sentencepiece.SentencePieceProcessor(model_proto=vocabulary.value))


def piece_counts(df: DataFrame, vocabulary, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, piece, n) over all rows: each task sums what it has read before anything is shuffled."""

    def make():
        pieces = _pieces(vocabulary)
        cut = Memo(lambda word: tuple(pieces.encode(word)), REMEMBERED)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                words.setdefault(lang, Counter()).update(_words(text))
            langs, ids, counts = [], [], []
            for lang, seen in words.items():
                total: Counter = Counter()
                for word, n in seen.items():
                    for piece in cut[word]:
                        total[piece] += n
                langs += [lang] * len(total)
                ids += total.keys()
                counts += total.values()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ids, pa.int32()), pa.array(counts, pa.int64())], names=["lang", "piece", "n"])

        return step

    slim = df.select(df[lang_col].cast("string").alias("lang"), df[text_col].cast("string").alias("text"))
    return arrow_map(slim, "lang string, piece int, n long", make, SLICE_BYTES).groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class PieceTable:
    """Pieces by the 64-bit polynomial hash of their characters, in an open-addressed array that is probed for many hashes at once."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)
    SLOTS_LOG2 = 18

    def __init__(self, names: list[str]):
        keys = np.zeros(len(names), np.uint64)
        for i, name in enumerate(names):
            h = np.zeros(1, np.uint64)
            for c in name:
                h = self.extend(h, np.uint64(ord(c)))
            keys[i] = h[0]
        while len(names) * 4 > 1 << self.SLOTS_LOG2:
            self.SLOTS_LOG2 += 1
        self.keys = np.zeros(1 << self.SLOTS_LOG2, np.uint64)
        self.ids = np.full(1 << self.SLOTS_LOG2, -1, np.int64)
        self.probes = 1
        for i, (key, slot) in enumerate(zip(keys, self._slots(keys).tolist(), strict=True)):
            probes = 1
            while self.ids[slot] >= 0:
                slot = (slot + 1) % len(self.ids)
                probes += 1
            self.keys[slot], self.ids[slot] = key, i
            self.probes = max(self.probes, probes)

    @classmethod
    def extend(cls, hashes: np.ndarray, codes) -> np.ndarray:
        return (hashes + codes + np.uint64(1)) * cls.FACTOR

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(29))) * self.FACTOR >> np.uint64(64 - self.SLOTS_LOG2)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes belong to pieces, and the pieces' numbers."""
        slots = self._slots(hashes)
        ids = np.where(self.keys[slots] == hashes, self.ids[slots], -1)
        open_ = np.flatnonzero((ids < 0) & (self.ids[slots] >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = (slots[open_] + probe) % len(self.ids)
            ids[open_] = np.where(self.keys[at] == hashes[open_], self.ids[at], -1)
            open_ = open_[(ids[open_] < 0) & (self.ids[at] >= 0)]
        where = np.flatnonzero(ids >= 0)
        return where, ids[where]


class Model:
    """Piece probabilities, a row per piece and a column per language, and the words scored so far."""

    def __init__(self, langs: list[str], names: list[str], matrix: np.ndarray):
        self.langs = langs
        self.matrix = matrix
        self.longest = max(map(len, names), default=1)
        self.pieces = PieceTable(names)
        self.rows: dict[str, int] = {}
        self.logs = np.zeros((0, len(langs)))

    def forget(self) -> None:
        self.rows, self.logs = {}, np.zeros((0, len(self.langs)))

    def learn(self, words: set[str]) -> None:
        """Score the words not seen yet, many at a time; the memo is emptied when it is full."""
        new = [w for w in words if w not in self.rows]
        if len(self.rows) + len(new) > REMEMBERED:
            self.forget()
            new = list(words)
        new.sort(key=len, reverse=True)
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        self.logs = np.concatenate([self.logs, *(self.forward(new[i : i + SCORED]) for i in range(0, len(new), SCORED))])

    def forward(self, words: list[str]) -> np.ndarray:
        """ln P per word and language, longest words first: sums over all segmentations; the start mark is the first character."""
        n, width = len(words), len(words[0]) + 1
        lengths = np.fromiter(map(len, words), np.int64, n) + 1
        codes = np.zeros((n, width), np.uint64)
        codes[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(WORD_START + w for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.ascontiguousarray(codes.T)
        sums, hashes = [np.ones((n, len(self.langs)))], []
        lifted, out = np.zeros((n, len(self.langs))), np.zeros((n, len(self.langs)))
        for end in range(1, width + 1):
            live = int(np.searchsorted(-lengths, -end, side="right"))  # the words that reach this far
            total = sums[end - 1][:live] * UNCOVERED
            hashes.append(np.zeros(live, np.uint64))
            for start in range(max(0, end - self.longest), end):
                hashes[start] = PieceTable.extend(hashes[start][:live], codes[end - 1, :live])
                where, ids = self.pieces.find(hashes[start])
                if len(where):
                    total[where] += sums[start][where] * self.matrix[ids]
            sums.append(total)
            done = int(np.searchsorted(-lengths, -end, side="left"))
            out[done:live] = np.log(total[done:]) + lifted[done:live]
            if end % 16 == 0:
                lifted[:live] += np.log(total)
                sums = [s[:live] / total for s in sums]
        return out

    def score(self, batch: list[str]) -> list[tuple[str, float]]:
        if not self.langs:
            return [("und", 0.0)] * len(batch)
        cut = [_words(t) for t in batch]
        self.learn(set().union(*cut))
        return [self.verdict(t, w) for t, w in zip(batch, cut, strict=True)]

    def verdict(self, text: str, words: list[str]) -> tuple[str, float]:
        if not words or not (any(map(str.isalpha, words)) or HAS_LETTER.search(text)):
            return "und", 0.0
        logs = self.logs[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))].sum(axis=0)
        best = int(np.argmax(logs))
        tempered = np.exp((logs - logs[best]) * min(1.0, TEMPER_WORDS / len(words)))
        return self.langs[best], float(1 / tempered.sum())


def fit(df: DataFrame, model_path: str, lang_col: str = "lang", text_col: str = "text"):
    """Broadcast (languages, piece -> probabilities) learned from all rows with a language.

    Bounded by the vocabulary times the languages, of which there may be ``MAX_LANGUAGES``.
    """
    spark = df.sparkSession
    vocabulary = broadcast_bytes(spark, model_path)
    pieces = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rows = piece_counts(df.where(df[lang_col].isNotNull()), vocabulary, lang_col, text_col)
    counts: dict[str, dict[int, int]] = {}
    for row in rows.toLocalIterator():
        counts.setdefault(row["lang"], {})[row["piece"]] = row["n"]
        if len(counts) > MAX_LANGUAGES:
            raise ValueError(f"over {MAX_LANGUAGES} languages")
    langs = sorted(counts)
    size = pieces.get_piece_size()
    matrix = np.full((size, len(langs)), SMOOTHING)
    for j, lang in enumerate(langs):
        for piece, n in counts[lang].items():
            matrix[piece, j] += n
    matrix /= matrix.sum(axis=0, keepdims=True)
    usable = [i for i in range(size) if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))]
    return spark.sparkContext.broadcast((langs, [pieces.id_to_piece(i) for i in usable], matrix[usable]))


def predict(df: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score per row; only the text is an input of the prediction."""

    name = uuid.uuid4().hex

    def make():
        scorer = worker_table(("language model", name), lambda: Model(*model.value))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = scorer.score(texts(batch, text_col))
            kept = [n for n in batch.schema.names if n not in ("lang_pred", "score")]
            return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.float64())], names=[*kept, "lang_pred", "score"])

        return step

    from pyspark.sql import types as T

    schema = T.StructType([f for f in df.schema.fields if f.name not in ("lang_pred", "score")] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return arrow_map(df, schema, make, SLICE_BYTES)

"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of one public byte-level vocabulary. A word's likelihood is the sum over
all its segmentations into pieces, found by a forward pass over its bytes; a text's is the product over its words, times
the language's share of the training texts. No segmentation is chosen and no tokenizer is run.

Training is one step of expectation maximisation from equal piece probabilities: words are counted by language over all
training texts, a forward-backward pass per different word gives the expected uses of its pieces, and their counts are
summed by language. The vocabulary has all single bytes, so any word has a segmentation.

Pieces and words may have any length. A word is a letter with the letters and combining marks that follow it.
"""

from __future__ import annotations

import base64
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
ASCII_LETTERS = re.compile("[a-z]+")
REST_OF_RUN = regex.compile(r"[\p{L}\p{M}]*+")
PORTION = 1 << 20  # characters of a text that are looked at together, and those up to the end of the run of letters
LONG_WORD = 96  # bytes; longer words are passed over one by one in logarithms, others together
CACHED_WORDS = 300_000
CACHED_LETTERS = 1 << 25  # of long words
TOGETHER = 1 << 14  # words in one pass
SMOOTHING = 0.5
UNKNOWN = "und"


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """All pieces of a file of base64 pieces and ranks, and all single bytes, read on the driver."""
    with open(path, "rb") as lines:
        pieces = {base64.b64decode(line.split()[0]) for line in lines if line.strip()}
    return sorted((pieces | {bytes([b]) for b in range(256)}) - {b""})


def words_of(text: str) -> list[str]:
    """Letters with the letters and combining marks that follow them, lower-cased, of any length."""
    text = text.lower()
    return ASCII_LETTERS.findall(text) if text.isascii() else LETTERS.findall(text)


def portions(text: str) -> Iterator[str]:
    """A long text in parts that end where a run of letters does."""
    at = 0
    while at < len(text):
        end = REST_OF_RUN.match(text, min(at + PORTION, len(text))).end()
        yield text[at:end]
        at = end


def is_long(word: str) -> bool:
    return 4 * len(word) > LONG_WORD and len(word.encode()) > LONG_WORD


class PieceTrie:
    """The beginnings of all pieces as numbered nodes, 0 for the empty one; a step is a node and the byte after it.

    Steps are kept in a table with open addressing, so pieces may have any length.
    """

    def __init__(self, pieces: list[bytes]):
        self.size, self.longest = len(pieces), max(map(len, pieces))
        steps: dict[int, int] = {}
        piece_at = {}
        for i, piece in enumerate(pieces):
            node = 0
            for byte in piece:
                node = steps.setdefault(node << 8 | byte, len(steps) + 1)
            piece_at[node] = i
        self.steps = steps
        #: The piece that ends at a node, or the number of pieces if none does.
        self.piece = np.full(len(steps) + 1, self.size, np.int32)
        self.piece[list(piece_at)] = list(piece_at.values())
        self.bits = (2 * len(steps)).bit_length()
        self.keys = np.zeros((1 << self.bits) + len(steps), np.uint64)
        self.nodes = np.zeros(len(self.keys), np.int32)
        keys = np.fromiter(steps, np.uint64, len(steps)) + np.uint64(1)
        nodes = np.fromiter(steps.values(), np.int32, len(steps))
        at, open_ = self._slot(keys), np.arange(len(steps))
        while len(open_):
            free = open_[self.keys[at[open_]] == 0]
            self.keys[at[free]] = keys[free]  # of several for one slot the last is held
            held = self.keys[at[open_]] == keys[open_]
            self.nodes[at[open_[held]]] = nodes[open_[held]]
            open_ = open_[~held]
            at[open_] += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The nodes one byte further, 0 where no piece goes on so."""
        keys = (nodes.astype(np.uint64) << np.uint64(8) | bytes_) + np.uint64(1)
        at = self._slot(keys)
        held = self.keys[at]
        found = np.where(held == keys, self.nodes[at], np.int32(0))
        open_ = np.flatnonzero((held != keys) & (held != 0))
        while len(open_):
            at[open_] += 1
            held = self.keys[at[open_]]
            same = held == keys[open_]
            found[open_[same]] = self.nodes[at[open_[same]]]
            open_ = open_[~same & (held != 0)]
        return found

    def pieces_from(self, raw: bytes, start: int) -> Iterator[tuple[int, int]]:
        """End and number of every piece at one place."""
        node = 0
        for end in range(start, len(raw)):
            node = self.steps.get(node << 8 | raw[end], 0)
            if not node:
                return
            if (piece := self.piece[node]) < self.size:
                yield end + 1, piece


def spaced(word: str) -> bytes:
    return b" " + word.encode()


class Lattice:
    """All pieces at all places of some words, each with a space before it. Words are put in order of falling length."""

    def __init__(self, words: list[str], trie: PieceTrie):
        raw = [spaced(word) for word in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.longest = int(lengths.max())
        #: Words of at least so many bytes: they come first.
        active = [int(np.searchsorted(-self.lengths, -j, "right")) for j in range(self.longest + 1)]
        filled = np.zeros((len(raw), self.longest), np.uint8)
        filled[np.arange(self.longest) < self.lengths[:, None]] = np.frombuffer(b"".join(raw[i] for i in self.order), np.uint8)
        columns = np.ascontiguousarray(filled.T).astype(np.uint64)
        self.arcs: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # start, end, words and the piece of each
        for start in range(self.longest):
            rows, nodes = np.arange(active[start + 1]), np.zeros(active[start + 1], np.int32)
            for end in range(start + 1, self.longest + 1):
                m = np.searchsorted(rows, active[end])
                rows = rows[:m]
                nodes = trie.step(nodes[:m], columns[end - 1][rows])
                going = np.flatnonzero(nodes)
                if not len(going):
                    break
                rows, nodes = rows[going], nodes[going]
                pieces = trie.piece[nodes]
                whole = np.flatnonzero(pieces < trie.size)
                if len(whole):
                    self.arcs.append((start, end, rows[whole], pieces[whole]))

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Per place the sum over segmentations up to it. weights: piece x columns."""
        sums = np.zeros((self.longest + 1, len(self.lengths), weights.shape[1]))
        sums[0] = 1.0
        for start, end, rows, pieces in self.arcs:
            sums[end, rows] += sums[start, rows] * weights[pieces]
        return sums

    def backward(self, weights: np.ndarray) -> np.ndarray:
        sums = np.zeros((self.longest + 1, len(self.lengths), weights.shape[1]))
        sums[self.lengths, np.arange(len(self.lengths))] = 1.0
        for start, end, rows, pieces in reversed(self.arcs):
            sums[start, rows] += sums[end, rows] * weights[pieces]
        return sums

    def ends(self, sums: np.ndarray) -> np.ndarray:
        return sums[self.lengths, np.arange(len(self.lengths))]


def _per_byte(pieces: list[bytes], by: float) -> np.ndarray:
    """Factors that keep sums over words of up to a hundred bytes within a double: ``by`` for every byte of a piece."""
    return np.exp(by * np.array([*map(len, pieces)], float))[:, None]


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high)) if low > -math.inf else high


class UniformUses:
    """Expected uses of pieces in words when every piece has the same chance."""

    def __init__(self, pieces: list[bytes]):
        self.trie = PieceTrie(pieces)
        self.weights = _per_byte(pieces, np.log(len(pieces)) / 3) / len(pieces)

    def add(self, words: list[str], counts: np.ndarray, total: np.ndarray) -> None:
        counts = np.asarray(counts, float)
        long = np.fromiter(map(is_long, words), bool, len(words))
        for i in np.flatnonzero(long):
            self._add_long(spaced(words[i]), counts[i], total)
        short = np.flatnonzero(~long)
        if not len(short):
            return
        lattice = Lattice([words[i] for i in short], self.trie)
        forward, backward = lattice.forward(self.weights)[..., 0], lattice.backward(self.weights)[..., 0]
        share = counts[short][lattice.order] / backward[0]
        found, uses = [], []
        for start, end, rows, pieces in lattice.arcs:
            found.append(pieces)
            uses.append(forward[start, rows] * self.weights[pieces, 0] * backward[end, rows] * share[rows])
        total += np.bincount(np.concatenate(found), np.concatenate(uses), self.trie.size)

    def _add_long(self, raw: bytes, count: float, total: np.ndarray) -> None:
        """The same in logarithms; two numbers a byte are held."""
        chance = -math.log(self.trie.size)
        forward, backward = ([-math.inf] * (len(raw) + 1) for _ in range(2))
        forward[0] = backward[-1] = 0.0
        for start in range(len(raw)):
            for end, _ in self.trie.pieces_from(raw, start):
                forward[end] = _log_sum(forward[end], forward[start] + chance)
        for start in reversed(range(len(raw))):
            for end, piece in self.trie.pieces_from(raw, start):
                through = backward[end] + chance
                backward[start] = _log_sum(backward[start], through)
                total[piece] += count * math.exp(forward[start] + through - forward[-1])


class Scorer:
    """Log-likelihoods of words under every language; short words seen before are kept, up to a bound."""

    SCALE = 5.0

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        self.trie, self.logs = PieceTrie(pieces), logs
        self.weights = np.exp(logs) * _per_byte(pieces, self.SCALE)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, logs.shape[1]))

    def words(self, words: list[str]) -> np.ndarray:
        """words x languages."""
        found = np.empty((len(words), self.logs.shape[1]))
        long = np.fromiter(map(is_long, words), bool, len(words))
        short = np.flatnonzero(~long)
        if len(short):
            lattice = Lattice([words[i] for i in short], self.trie)
            ends = lattice.ends(lattice.forward(self.weights))
            with np.errstate(divide="ignore"):
                found[short[lattice.order]] = np.log(ends) - self.SCALE * lattice.lengths[:, None]
        found[long] = np.nan
        for i in np.flatnonzero(~np.isfinite(found).all(axis=1)):  # long, or too small or too large for a double
            found[i] = self._in_logs(spaced(words[i]))
        return found

    def _in_logs(self, raw: bytes) -> np.ndarray:
        """One word; only the places that a piece can reach are held."""
        around = self.trie.longest + 1
        sums = np.full((around, self.logs.shape[1]), -np.inf)
        sums[0] = 0.0
        for start in range(len(raw)):
            here = sums[start % around].copy()
            sums[start % around] = -np.inf
            for end, piece in self.trie.pieces_from(raw, start):
                at = end % around
                sums[at] = np.logaddexp(sums[at], here + self.logs[piece])
        return sums[len(raw) % around]

    def add(self, words: list[str], at: np.ndarray, total: np.ndarray) -> None:
        """Add each word's logs to the row of ``total`` that ``at`` names."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.rows = {}, self.rows[:0]
        long = [i for i, word in enumerate(words) if 4 * len(word) > LONG_WORD and is_long(word)]
        if long:
            for i, row in zip(long, self.words([words[i] for i in long])):
                total[at[i]] += row
            rest = np.delete(np.arange(len(words)), long)
            words, at = [words[i] for i in rest], at[rest]
        new = sorted((word for word in dict.fromkeys(words) if word not in self.known), key=len)
        parts = [self.words(new[i:i + TOGETHER]) for i in range(0, len(new), TOGETHER)]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.rows = np.concatenate([self.rows, *parts])
        ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        np.add.at(total, at, self.rows[ids])

    def texts(self, texts: list[str | None], prior: np.ndarray) -> list[tuple[int, float] | None]:
        """Each text's best language and its posterior, or nothing if it has no letter."""
        total, seen = np.tile(prior, (len(texts), 1)), np.zeros(len(texts), bool)
        words: list[str] = []
        places: list[np.ndarray] = []

        def score() -> None:
            if words:
                self.add(words, np.concatenate(places), total)
                words.clear()
                places.clear()

        for i, text in enumerate(texts):
            for portion in portions(text or ""):
                own = words_of(portion)
                words += own
                places.append(np.full(len(own), i))
                seen[i] |= bool(own)
                if len(words) > 1 << 18:
                    score()
        score()
        best = total.argmax(axis=1) if total.shape[1] else np.zeros(len(texts), int)
        top = total[np.arange(len(texts)), best] if total.shape[1] else np.zeros(len(texts))
        posterior = 1 / np.exp(total - top[:, None]).sum(axis=1) if total.shape[1] else top
        return [(int(b), float(p)) if ok and total.shape[1] else None for b, p, ok in zip(best, posterior, seen)]


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, n over all rows with a language: counted per task in bounded tables, then summed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}
        letters = 0

        def flush() -> pd.DataFrame:
            rows = [(lang, word, n) for lang, words in held.items() for word, n in words.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                for portion in portions(text):
                    words = words_of(portion)
                    held.setdefault(lang, Counter()).update(words)
                    letters += sum(n for n in map(len, words) if n > LONG_WORD)
                if letters > CACHED_LETTERS or sum(map(len, held.values())) > CACHED_WORDS:
                    yield flush()
                    letters = 0
        yield flush()

    counted = docs.filter("lang is not null and text is not null").select("lang", "text").mapInPandas(
        count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, vocabulary: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, their log priors, and log piece probabilities (piece x language).

    The table that reaches the driver has at most one row per piece and language, whatever the corpus.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(vocabulary))

    def uses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = UniformUses(pickle.loads(shared.value))
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                total = totals.setdefault(lang, np.zeros(model.trie.size))
                words, counts = rows["word"].tolist(), rows["n"].to_numpy()
                for i in range(0, len(words), TOGETHER):
                    model.add(words[i:i + TOGETHER], counts[i:i + TOGETHER], total)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "piece": at.astype(np.int32), "uses": total[at]})

    expected = count_words(docs).mapInPandas(uses, "lang string, piece int, uses double")
    table = expected.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()
    texts = docs.filter("lang is not null and text is not null").groupBy("lang").count().toPandas()
    languages = sorted(texts["lang"])
    counts = np.full((len(vocabulary), len(languages)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(languages)}
    np.add.at(counts, (table["piece"].to_numpy(int), table["lang"].map(place).to_numpy(int)), table["uses"].to_numpy(float))
    shares = texts.set_index("lang")["count"].reindex(languages).to_numpy(float)
    return languages, np.log(shares / max(shares.sum(), 1)), np.log(counts / counts.sum(axis=0))


PREDICTION = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(spark: SparkSession, vocabulary: list[bytes], languages: list[str], prior: np.ndarray, logs: np.ndarray):
    """A function of a text column to its language and posterior. The broadcast has a number per piece and language."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps((vocabulary, languages, prior, logs)))

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces, names, start, table = pickle.loads(shared.value)
        scorer = Scorer(pieces, table)
        for texts in batches:
            found = scorer.texts(texts.tolist(), start)
            yield pd.DataFrame([(UNKNOWN, 0.0) if x is None else (names[x[0]], x[1]) for x in found], columns=["lang", "score"])

    return predict


def held_out(doc_id: Column) -> Column:
    """A third of the ids; a null id has no checksum and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op4_languages(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Trained on the labelled texts that aren't held out; one prediction per row, from its text alone.

    ``und`` with score 0 for a null text, one without letters, or if there is nothing to learn from.
    """
    vocabulary = read_vocabulary(path)
    labelled = docs.filter(~held_out(F.col("doc_id"))).select("lang", "text")
    predict = predictor(docs.sparkSession, vocabulary, *train(labelled, vocabulary))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))

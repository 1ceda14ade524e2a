"""Language identification by segmentation-marginalised unigrams.

For each language every piece of a fixed public vocabulary has a probability.
A word (a run of letters, lower-cased, with the vocabulary's word mark before
it) is worth the sum over all its segmentations into pieces of the product of
their probabilities, which a forward algorithm computes for all languages at
once; pieces don't cross words, so a text is worth the product over its words
and no segmentation of the whole text is left out.  The probabilities are
fitted by expectation maximisation (forward-backward expected piece counts) on
at most ``train_docs`` labelled documents a language, chosen by a hash of the
id; every document is scored over its whole text.

A sign outside of the vocabulary is one unknown piece.  Words of any length
are summed over all their segmentations: those of ``LONGEST`` signs or more
one by one in logarithms, which can't underflow, with time in proportion to
their length and memory for the longest piece only (training keeps a number
for each sign); shorter ones many at a time.  The result doesn't depend on
``LONGEST``.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
documents with a null language or id are not learned from; without any
document to learn from everything is ``und``; repeated rows are scored row by
row.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import Scratch

TRAIN_DOCS, ROUNDS, LONGEST, SMOOTHING = 1500, 3, 32, 0.02
STEP = 4096  # words scored at a time
RUN = re.compile(r"[^\W\d_]+")
MARK = "▁"


class Vocabulary:
    """Numbers of the pieces that have a letter or the word mark; one more for an unknown sign."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k)))
        wanted = sorted({p for p in names if all(c.isalpha() for c in p.removeprefix(MARK)) and p == p.lower()})
        self.number = {p: k for k, p in enumerate(wanted)}
        self.unknown = len(wanted)
        self.size = len(wanted) + 1
        self.prefixes = {p[:k] for p in wanted for k in range(1, len(p) + 1)}
        self.longest = max(map(len, wanted))

    def pieces(self, word: str, i: int) -> list[tuple[int, int]]:
        """(length, number) of the pieces of a word that start at sign ``i``, an unknown one included."""
        found, known = [], False
        for size in range(1, min(self.longest, len(word) - i) + 1):
            part = word[i:i + size]
            if part not in self.prefixes:
                break
            piece = self.number.get(part)
            if piece is not None:
                known = known or size == 1
                found.append((size, piece))
        return found if known else [(1, self.unknown), *found]

    def forward_long(self, word: str, logs: np.ndarray) -> np.ndarray:
        """log of the sum over all segmentations of one word of any length, (languages); ``logs``: (pieces, languages)."""
        ring = self.longest + 1
        alpha = np.full((ring, logs.shape[1]), -np.inf)
        alpha[0] = 0
        for i in range(len(word)):
            here = alpha[i % ring].copy()
            alpha[i % ring] = -np.inf
            for size, piece in self.pieces(word, i):
                at = (i + size) % ring
                alpha[at] = np.logaddexp(alpha[at], here + logs[piece])
        return alpha[len(word) % ring]

    def expected_long(self, word: str, lang: int, times: int, logs: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected piece counts of one word of any length to ``out``."""
        n, log = len(word), logs[:, lang]
        beta = np.full(n + 1, -np.inf)
        beta[n] = 0
        for i in reversed(range(n)):
            for size, piece in self.pieces(word, i):
                beta[i] = np.logaddexp(beta[i], log[piece] + beta[i + size])
        alpha = np.full(n + 1, -np.inf)
        alpha[0] = 0
        for i in range(n):
            for size, piece in self.pieces(word, i):
                path = alpha[i] + log[piece]
                alpha[i + size] = np.logaddexp(alpha[i + size], path)
                out[piece, lang] += times * np.exp(path + beta[i + size] - beta[0])

    def lattice(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """All pieces in all words: (end, length, word numbers, piece numbers), by end; a word occurs once in each."""
        found: dict[tuple[int, int], tuple[list[int], list[int]]] = {}
        number, prefixes = self.number, self.prefixes
        for w, word in enumerate(words):
            n = len(word)
            for i in range(n):
                known = False
                for j in range(i + 1, n + 1):
                    part = word[i:j]
                    if part not in prefixes:
                        break
                    piece = number.get(part)
                    if piece is not None:
                        known = known or j == i + 1
                        at = found.setdefault((j, j - i), ([], []))
                        at[0].append(w)
                        at[1].append(piece)
                if not known:
                    at = found.setdefault((i + 1, 1), ([], []))
                    at[0].append(w)
                    at[1].append(self.unknown)
        return [(end, size, np.array(ws), np.array(ps)) for (end, size), (ws, ps) in sorted(found.items())]

    def forward(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """log of the sum over all segmentations, (words, languages); ``probs``: (pieces, languages)."""
        lengths = np.array([len(w) for w in words])
        alpha = np.zeros((lengths.max() + 1, len(words), probs.shape[1]))
        alpha[0] = 1
        for end, size, ws, ps in self.lattice(words):
            alpha[end, ws] += alpha[end - size, ws] * probs[ps]
        return np.log(alpha[lengths, np.arange(len(words))])

    def expected(self, words: list[str], langs: np.ndarray, times: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """Expected piece counts (pieces, languages) of words that are each of one language."""
        lengths, every = np.array([len(w) for w in words]), np.arange(len(words))
        edges = self.lattice(words)
        alpha = np.zeros((lengths.max() + 1, len(words)))
        beta = np.zeros_like(alpha)
        alpha[0], beta[lengths, every] = 1, 1
        for end, size, ws, ps in edges:
            alpha[end, ws] += alpha[end - size, ws] * probs[ps, langs[ws]]
        for end, size, ws, ps in reversed(edges):
            beta[end - size, ws] += beta[end, ws] * probs[ps, langs[ws]]
        whole = alpha[lengths, every]
        out = np.zeros_like(probs)
        for end, size, ws, ps in edges:
            share = alpha[end - size, ws] * probs[ps, langs[ws]] * beta[end, ws] / whole[ws] * times[ws]
            np.add.at(out, (ps, langs[ws]), share)
        return out


@functools.lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def words_of(text: str | None) -> list[str]:
    """The text's words: its runs of letters, lower-cased."""
    return RUN.findall((text or "").lower())


def _word_counts(docs: DataFrame, n_langs: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[int, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items() if any(map(str.isalpha, w))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "times"])

    return docs.select("lang", "text").mapInArrow(run, "lang int, word string, times long").groupBy("lang", "word").agg(F.sum("times").alias("times"))


def _expected(counts: DataFrame, path: str, probs: np.ndarray) -> np.ndarray:
    held = counts.sparkSession.sparkContext.broadcast(probs)  # pieces x languages: bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(held.value)
        logs = np.log(held.value)
        for batch in batches:
            words, langs, times = (batch.column(c) for c in ("word", "lang", "times"))
            for w, lang, n in zip(words.to_pylist(), langs.to_pylist(), times.to_pylist()):
                if len(w) >= LONGEST:
                    vocabulary(path).expected_long(MARK + w, lang, n, logs, total)
            short = batch.filter(pc.less(pc.utf8_length(words), LONGEST))
            for at in range(0, short.num_rows, STEP):
                part = short.slice(at, STEP)
                total += vocabulary(path).expected([MARK + w for w in part.column("word").to_pylist()], part.column("lang").to_numpy(), part.column("times").to_numpy(), held.value)
        pieces, langs = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pieces), pa.array(langs), pa.array(total[pieces, langs])], names=["piece", "lang", "c"])

    sums = counts.mapInArrow(run, "piece long, lang long, c double").groupBy("piece", "lang").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros_like(probs)
    out[sums["piece"].to_numpy(), sums["lang"].to_numpy()] = sums["c"].to_numpy()
    return out


def train(docs: DataFrame, path: str, *, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, piece probabilities) from rows (doc, lang, text) with a language."""
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}  # a row per language
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros(0), np.zeros((0, 0))
    draw = F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) / float(1 << 30)
    part = F.lit(0.0)
    number = F.lit(0)
    for k, lang in enumerate(langs):
        part = F.when(F.col("lang") == lang, min(1.0, train_docs / sizes[lang])).otherwise(part)
        number = F.when(F.col("lang") == lang, k).otherwise(number)
    sample = docs.where(draw < part).select(number.alias("lang"), "text")
    counts = Scratch(docs.sparkSession, "language").keep(_word_counts(sample, len(langs)), "words")
    size = vocabulary(path).size
    probs = np.full((size, len(langs)), 1.0 / size)
    for _ in range(rounds):
        found = _expected(counts, path, probs) + SMOOTHING
        probs = found / found.sum(axis=0)
    total = sum(sizes.values())
    return langs, np.log([sizes[x] / total for x in langs]), probs


class Scorer:
    """Sums of word scores; the scores of up to ``limit`` words under LONGEST signs are kept."""

    def __init__(self, path: str, probs: np.ndarray, limit: int = 300_000):
        self.vocabulary, self.probs, self.limit = vocabulary(path), probs, limit
        self.logs = np.log(probs)
        self._clear()

    def _clear(self):
        self.number: dict[str, int] = {}
        self.scores = np.zeros((1, self.probs.shape[1]))  # 0: runs without a letter

    def learn(self, words: list[str]) -> None:
        new = [w for w in words if any(map(str.isalpha, w))]
        self.number.update(dict.fromkeys(words, 0))
        for at in range(0, len(new), STEP):
            part = new[at:at + STEP]
            self.number.update(zip(part, range(len(self.scores), len(self.scores) + len(part))))
            self.scores = np.concatenate((self.scores, self.vocabulary.forward([MARK + w for w in part], self.probs)))

    def totals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihoods, has a letter) of each text."""
        words = [words_of(t) for t in texts]
        long = [[w for w in ws if len(w) >= LONGEST] for ws in words]
        words = [[w for w in ws if len(w) < LONGEST] if cut else ws for ws, cut in zip(words, long)]
        new = {w for ws in words for w in ws if w not in self.number}
        if len(self.number) + len(new) > self.limit:
            self._clear()
            new = {w for ws in words for w in ws}
        if new:
            self.learn(sorted(new))
        out, letters = np.zeros((len(texts), self.probs.shape[1])), np.zeros(len(texts), dtype=bool)
        for k, ws in enumerate(words):
            at = np.fromiter(map(self.number.__getitem__, ws), dtype=np.int64, count=len(ws))
            out[k] = self.scores[at].sum(axis=0)
            letters[k] = (at > 0).any()
            for w, n in Counter(w for w in long[k] if any(map(str.isalpha, w))).items():
                out[k] += n * self.vocabulary.forward_long(MARK + w, self.logs)
                letters[k] = True
        return out, letters


def predict(docs: DataFrame, path: str, langs: list[str], priors: np.ndarray, probs: np.ndarray) -> DataFrame:
    """(doc, lang_pred, score) of rows (doc, text)."""
    held = docs.sparkSession.sparkContext.broadcast((langs, priors, probs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, priors, probs = held.value
        scorer = Scorer(path, probs) if langs else None
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, batch.num_rows, 128):
                part = texts.slice(at, 128).to_pylist()
                if scorer is None:
                    names, scores = ["und"] * len(part), np.zeros(len(part))
                else:
                    totals, letters = scorer.totals(part)
                    totals += priors
                    best = totals.argmax(axis=1)
                    weights = np.exp(totals - totals.max(axis=1, keepdims=True))
                    scores = np.where(letters, 1 / weights.sum(axis=1), 0.0)
                    names = [langs[b] if ok else "und" for b, ok in zip(best, letters)]
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(at, 128), pa.array(names, pa.string()), pa.array(scores)], names=["doc", "lang_pred", "score"])

    return docs.select("doc", "text").mapInArrow(run, "doc long, lang_pred string, score double")


def identify(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
             train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> DataFrame:
    """(doc, held_out, lang_pred, score) per row; learns where crc32 of the id, modulo 4, isn't 2."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    held_out = F.pmod(F.crc32(F.col("doc").cast("string").cast("binary")), F.lit(4)) == 2
    learned = rows.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    out = predict(rows, path, *train(learned, path, train_docs=train_docs, rounds=rounds))
    return out.select("doc", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")

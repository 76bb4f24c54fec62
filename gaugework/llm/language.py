"""Language identification by unigram pieces, summed over all segmentations.

The vocabulary is fixed and public: the pieces of a sentencepiece model whose
characters are letters (a word begins with the model's word mark). Training
gives each language a probability for each piece; the probability of a word is
the sum over all of its segmentations into pieces, by a forward recursion, and
that of a text the product over its words. Nothing depends on one best
segmentation, so rare spellings share evidence over all ways to read them.

Training is expectation maximisation on words counted by language, when `train`
is called. It reads a bounded sample: about `per_language` documents of each of
the `max_languages` most frequent labels (those whose id hash falls under
per_language / documents of that label), SAMPLE_CHARS characters of each.
The driver holds the sample's distinct words and their pieces in flat arrays. Prediction reads
every whole text, each word whole, scaled so that no probability underflows; a
word of up to MAX_WORD letters is scored once per worker while it stays cached.

Defined results: a null text, or one without a letter (Unicode category L), is
`und` with score 0; a text, or a word, of any length is scored whole;
where nothing could be learned every text is `und`. Equal scores go to the
language that sorts first. Rows with null lang are never learned from; repeated
rows count as often as they occur. Extra columns pass through.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import fresh_names, held, small_batches

MARK = "▁"
PER_LANGUAGE = 1500
MAX_LANGUAGES = 256
SAMPLE_CHARS = 100_000
#: Words in arrays at a time.
BLOCK = 2_000
ROUNDS = 3
#: Longer words are scored whole, alone and without a cache; training counts them in cuts of this length.
MAX_WORD = 40
#: From this position on, probabilities are scaled at every RESCALE-th one, so that none underflows.
UNSCALED, RESCALE = 16, 4
#: Words that a worker remembers.
CACHE_WORDS = 150_000
#: Weight of one unseen character, beside pieces' counts.
SMOOTH = 0.5
UND = "und"
#: Letters, and numerals that are no decimal digits; words that are not of letters alone are cut at those.
LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(path: str) -> list[str]:
    """Pieces of letters in the model's order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i).lower()
        body = piece.removeprefix(MARK)
        if body and body.isalpha():
            found.setdefault(piece, None)
    found.setdefault(MARK, None)
    return list(found)


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L)."""
    words = LETTERS.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, words)):
        return words
    return [part for word in words for part in ("".join(c if c.isalpha() else " " for c in word).split() if not word.isalpha() else (word,))]


def split_long(word: str) -> list[str]:
    return [word[k : k + MAX_WORD] for k in range(0, len(word), MAX_WORD)]


class Lattice:
    """Pieces of words as arrays: ids[word, start, length - 1], the last id where there is no such piece."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: k for k, p in enumerate(pieces)}
        self.none = len(pieces) + 1
        self.char = len(pieces)  # any one character that is no piece
        self.reach = max(map(len, pieces), default=1)
        #: Ids of pieces, and -1 of what only begins one.
        self.begin = dict.fromkeys((p[:k] for p in pieces for k in range(1, len(p) + 1)), -1) | self.ids

    def build(self, words: list[str]) -> np.ndarray:
        """For words of one length."""
        n = len(words[0]) + 1
        reach = min(self.reach, n)
        out = np.full((len(words), n, reach), self.none, dtype=np.int32)
        out[:, :, 0] = self.char
        places, ids, known = [], [], self.begin.get
        for w, word in enumerate(words):
            word = MARK + word
            for i in range(n):
                at = (w * n + i) * reach - i - 1
                for k in range(i + 1, min(n, i + reach) + 1):
                    found = known(word[i:k])
                    if found is None:
                        break
                    if found >= 0:
                        places.append(at + k)
                        ids.append(found)
        out.reshape(-1)[places] = ids
        return out


def forward(lattice: np.ndarray, prob: np.ndarray, shift: np.ndarray | None = None) -> np.ndarray:
    """alpha[position, word, language]: probability of all segmentations up to there.

    With `shift`, zeros of the same shape, true values are alpha * exp(shift).
    """
    words, n, reach = lattice.shape
    none = len(prob) - 1
    alpha = np.zeros((n + 1, words, prob.shape[1]))
    alpha[0] = 1
    for end in range(1, n + 1):
        alpha[end] = alpha[end - 1] * prob[lattice[:, end - 1, 0]]
        for size in range(2, min(reach, end) + 1):
            ids = lattice[:, end - size, size - 1]
            at = np.flatnonzero(ids != none)
            if len(at):
                alpha[end, at] += alpha[end - size, at] * prob[ids[at]]
        if shift is not None:
            shift[end] = shift[end - 1]
            if end >= UNSCALED and end % RESCALE == 0:
                begin, by = max(0, end - reach + 1), alpha[end].copy()
                alpha[begin : end + 1] /= by
                shift[begin : end + 1] = shift[end] + np.log(by)
    return alpha


def by_length(words: list[str], most: int = BLOCK):
    """Indices of words of equal length, some at a time."""
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    for found in groups.values():
        for k in range(0, len(found), most):
            yield found[k : k + most]


@dataclass
class Model:
    """Languages, pieces and their probabilities; bounded by the vocabulary, whatever it was trained on."""

    languages: list[str]
    pieces: list[str]
    log_prior: np.ndarray
    prob: np.ndarray  # [pieces + 2, languages]; the last rows: one unknown character, no piece

    def word_scores(self, lattice: Lattice, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.empty((len(words), len(self.languages)), dtype=np.float64)
        for at in by_length(words):
            built = lattice.build([words[k] for k in at])
            shift = np.zeros((built.shape[1] + 1, len(at), len(self.languages))) if built.shape[1] >= UNSCALED else None
            found = np.log(forward(built, self.prob, shift)[-1])
            out[at] = found if shift is None else found + shift[-1]
        return out

    def long_score(self, lattice: Lattice, word: str) -> np.ndarray:
        """The same of one word of any length, in memory that does not grow with it."""
        word = MARK + word
        slots, n = lattice.reach + 1, len(word)
        window, shift = np.zeros((slots, len(self.languages))), np.zeros(len(self.languages))
        window[0] = 1
        for i in range(n):
            here = window[i % slots]
            if i and i % RESCALE == 0:
                by = here.copy()
                window /= by
                shift += np.log(by)
            if word[i] not in lattice.ids:
                window[(i + 1) % slots] += here * self.prob[lattice.char]
            for k in range(i + 1, min(n, i + lattice.reach) + 1):
                piece = word[i:k]
                if piece not in lattice.begin:
                    break
                found = lattice.ids.get(piece)
                if found is not None:
                    window[k % slots] += here * self.prob[found]
            here[:] = 0
        return np.log(window[n % slots]) + shift


class Arcs:
    """The lattice of a block of words of one length without its empty places, from which `dense` makes it again."""

    def __init__(self, at: np.ndarray, lattice: np.ndarray, none: int):
        self.at, self.shape, self.none = at, lattice.shape, none
        self.places = np.flatnonzero(lattice.reshape(-1) != none).astype(np.int32)
        self.ids = lattice.reshape(-1)[self.places]

    def dense(self) -> np.ndarray:
        out = np.full(self.shape, self.none, dtype=np.int32)
        out.reshape(-1)[self.places] = self.ids
        return out


def fit(counts: list[tuple[str, str, int]], pieces: list[str], documents: dict[str, int], rounds: int = ROUNDS) -> Model:
    """Expectation maximisation from (language, word, count)."""
    column = {name: k for k, name in enumerate(sorted(documents))}
    words = sorted({w for _, w, _ in counts})
    at = {w: k for k, w in enumerate(words)}
    weight = np.zeros((len(words), len(column)))
    for name, word, n in counts:
        weight[at[word], column[name]] += n
    return fit_words(words, weight, pieces, documents, rounds)


def fit_words(words: list[str], weight: np.ndarray, pieces: list[str], documents: dict[str, int], rounds: int = ROUNDS) -> Model:
    """The same from distinct words and their counts, a column a language in the order of names."""
    languages = sorted(documents)
    lattice = Lattice(pieces)
    size = len(pieces) + 2
    blocks = [Arcs(np.array(k), lattice.build([words[i] for i in k]), lattice.none) for k in by_length(words)]
    lengths = np.array([len(p) for p in pieces] + [1, 1], dtype=np.float64)
    prob = np.repeat((0.02**lengths)[:, None], max(1, len(languages)), axis=1)
    prob[-1] = 0
    for _ in range(rounds if words else 0):
        expected = np.zeros_like(prob)
        for block in blocks:
            k, lat = block.at, block.dense()
            n, reach = lat.shape[1:]
            shift = np.zeros((n + 1, len(k), prob.shape[1])) if n >= UNSCALED else None
            alpha = forward(lat, prob, shift)
            beta = np.zeros_like(alpha)
            beta[n] = weight[k] / alpha[n]
            for start in range(n - 1, -1, -1):
                for step in range(1, min(reach, n - start) + 1):
                    ids = lat[:, start, step - 1]
                    at_ids = np.flatnonzero(ids != size - 1)
                    if not len(at_ids):
                        continue
                    flow = beta[start + step, at_ids] * prob[ids[at_ids]]
                    if shift is not None:
                        flow *= np.exp(shift[start, at_ids] - shift[start + step, at_ids])
                    beta[start, at_ids] += flow
                    flow = flow * alpha[start, at_ids]
                    np.add.at(expected, ids[at_ids], flow)
        expected += SMOOTH
        expected[-1] = 0
        prob = expected / expected.sum(0)
        # One unknown character stands for any of many.
        prob[-2] /= 1000
    total = sum(documents.values())
    log_prior = np.log(np.array([documents[n] / total for n in languages])) if languages else np.zeros(0)
    return Model(languages, pieces, log_prior, prob)


def train(
    docs: DataFrame, vocabulary_path: str, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", per_language: int = PER_LANGUAGE, max_languages: int = MAX_LANGUAGES
) -> Model:
    """Fit on a bounded sample of labelled documents; the corpus sends counts of languages and words of the sample."""
    labelled = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    top = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    documents = {r["lang"]: r["n"] for r in top.collect()}  # max_languages rows at most
    if not documents:
        return fit([], vocabulary(vocabulary_path), {})
    names = sorted(documents)
    share = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(min(1.0, per_language / documents[name])))])
    sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000) * share[F.col("lang")])

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for text, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in words_of(text):
                    for piece in split_long(word):
                        found[name, piece] += 1
        if found:
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array([found[k] for k in keys], pa.int64())], ["lang", "word", "n"])

    counted = sample.select(F.left("text", F.lit(SAMPLE_CHARS)).alias("text"), "lang").mapInArrow(count, "lang string, word string, n long")
    by_language = [F.coalesce(F.sum(F.when(F.col("lang") == name, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, name in enumerate(names)]
    table = counted.groupBy("word").agg(*by_language).toArrow().sort_by("word")  # distinct words of the bounded sample
    weight = np.stack([table.column(f"n{k}").to_numpy().astype(np.float64) for k in range(len(names))], axis=1)
    words = table.column("word").to_pylist()
    del table
    return fit_words(words, weight, vocabulary(vocabulary_path), documents)


class Scorer:
    """A model with the words that it has scored so far."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.empty((1 << 12, len(self.model.languages)))

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.at) > CACHE_WORDS:
            self.forget()
        new = [w for w in dict.fromkeys(words) if w not in self.at]
        if new:
            begin = len(self.at)
            while len(self.scores) < begin + len(new):
                self.scores = np.concatenate([self.scores, np.empty_like(self.scores)])
            self.scores[begin : begin + len(new)] = self.model.word_scores(self.lattice, new)
            self.at.update(zip(new, range(begin, begin + len(new))))
        return self.scores[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))]

    def posteriors(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for k in range(0, len(texts), 500):
            some = [[] if not t else words_of(t) for t in texts[k : k + 500]]
            flat = [w for words in some for w in words if len(w) <= MAX_WORD]
            rows = self.rows(flat) if self.model.languages else None
            begin = 0
            for words in some:
                if not words or rows is None:
                    names.append(UND)
                    scores.append(0.0)
                    continue
                long = [w for w in words if len(w) > MAX_WORD]
                end = begin + len(words) - len(long)
                total = rows[begin:end].sum(0) + self.model.log_prior
                begin = end
                for word in long:
                    total = total + self.model.long_score(self.lattice, word)
                best = int(total.argmax())
                names.append(self.model.languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def predict(docs: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs with the predicted language and its posterior; columns of those names are replaced."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary by languages, some MB at most
    token = uuid.uuid4().hex

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        scorer = held("language", token, lambda: Scorer(model))
        names, scores = scorer.posteriors([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang": names, "score": scores})

    found: Column = run(F.col(text).cast("string"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (lang_out.lower(), score_out.lower())]
    place = fresh_names(docs, "found")[0]
    return docs.select(*keep, found.alias(place)).select(*keep, F.col(f"{place}.lang").alias(lang_out), F.col(f"{place}.score").alias(score_out))

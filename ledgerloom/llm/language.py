"""Language of documents from a linear-chain conditional random field over their words.

A line is a sequence; its words are labelled with languages. A word's features are its affixes, its character
n-grams and itself (the lexicon), hashed into one weight table; the weights of a language after a language are
learned too, from lines of one language and from lines spliced of two. Forward-backward gives every word's
language probabilities; a document's are the means over its words, weighted by their letters.

The probabilities only compare the learned languages with each other. Whether a text is in any of them is judged by
spelling: a word is known if the letter after each two letters, as counted in learning, explains it better than
letters drawn one by one do. A text with most of its letters in unknown words has score 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.chain import Adagrad, Chain, forward_backward, label_changes
from ledgerloom.llm.common import bounded_sample, free_name, held_out, settle, ship

UNKNOWN = "und"
# Documents learned from, for each language, and the characters taken of each; a fit reads no more.
FIT_DOCUMENTS = 600
FIT_CHARACTERS = 600
TABLE = 65_521
EPOCHS = 4
# Words of a line learned together.
LINE_WORDS = 40
BATCH_LINES = 256
# Tokens whose words and scores a task keeps, and characters labelled at a time.
CACHE_TOKENS = 200_000
BLOCK_CHARACTERS = 4_000_000
# Weight of a letter's own frequency where its two letters before were seldom met, and the share of known letters asked for.
BACK_OFF = 4.0
LEAST_KNOWN = 0.5
# Powers of an odd number, to tell the places in a word apart.
POWERS = np.cumprod(np.full(61, 0x9E3779B97F4A7C15, np.uint64))


@dataclass(frozen=True)
class Spelling:
    """Letters (and ends of words), pairs and triples of them met in learning, in order, each with its count."""

    letters: tuple[np.ndarray, np.ndarray]
    pairs: tuple[np.ndarray, np.ndarray]
    triples: tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class LanguageModel:
    labels: tuple[str, ...]
    weights: np.ndarray
    chain: Chain
    spelling: Spelling


def letters_of(token: str) -> str:
    """The letters of a token, in lower case."""
    return token.lower() if token.isalpha() else "".join(filter(str.isalpha, token.lower()))


def words_of(line: str) -> list[str]:
    """The letters of each token between white space that has any."""
    return [w for w in map(letters_of, line.split()) if w]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words, one after another, and how many each word has."""
    padded = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    here = np.arange(len(points))
    left = ends[word] - here  # characters from here to the word's end
    found, owner = [], []
    value = np.zeros(len(points), np.uint64)
    for width in (1, 2, 3):  # n-grams; those that touch < or > are the affixes
        shifted = np.zeros(len(points), np.uint64)
        shifted[: len(points) - width + 1] = points[width - 1 :]
        value = value * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(width)
        inside = left >= width
        found.append(value[inside])
        owner.append(word[inside])
    # The whole word: its characters times powers that depend on their places.
    place = (here - (ends - sizes)[word]) % len(POWERS)
    found.append(np.add.reduceat(points * POWERS[place], ends - sizes))
    owner.append(np.arange(len(words)))
    mixed = np.concatenate(found) * np.uint64(0xC2B2AE3D27D4EB4F)
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(TABLE)).astype(np.int64)[order], np.bincount(owners, minlength=len(words))


def word_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean weight of each word's features for each language, scaled by the root of their number."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    index, counts = features(words)
    sums = np.add.reduceat(weights[index], np.concatenate(([0], np.cumsum(counts)[:-1])), axis=0)
    return sums / np.sqrt(counts)[:, None]


def spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two letters before, the letter and the word of each letter and end of the words."""
    padded = [f"<<{w}>" for w in words]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    at = np.flatnonzero(np.arange(len(points)) - (np.cumsum(sizes) - sizes)[word] >= 2)
    return points[at - 2] << 21 | points[at - 1], points[at], word[at]


def learn_spelling(words: list[str]) -> Spelling:
    pairs, letters, _ = spelled(words)
    return Spelling(*(np.unique(x, return_counts=True) for x in (letters, pairs, pairs << 21 | letters)))


def _counted(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], 0)


def known_words(words: list[str], spelling: Spelling) -> np.ndarray:
    """True for each word that the learned spelling explains better than letters drawn by frequency or evenly.

    One letter says too little: it is known if it was met at all.
    """
    pairs, letters, word = spelled(words)
    met = _counted(letters, spelling.letters)
    kinds = len(spelling.letters[0])
    alone = (met + 0.5) / (spelling.letters[1].sum() + 0.5 * (kinds + 1))
    after = (_counted(pairs << 21 | letters, spelling.triples) + BACK_OFF * alone) / (_counted(pairs, spelling.pairs) + BACK_OFF)
    size = np.bincount(word, minlength=len(words))
    by_spelling, by_letters = np.bincount(word, np.log(after), len(words)), np.bincount(word, np.log(alone), len(words))
    short = (size == 2) & (np.bincount(word, met == 0, len(words)) == 0)
    return short | (by_spelling > np.maximum(by_letters, -np.log(kinds) * size))


def train(texts: list[str], langs: list[str], seed: int = 7) -> LanguageModel:
    """Fit on text pieces, every word of a piece labelled with the piece's language."""
    labels = tuple(sorted(set(langs)))
    rng = np.random.default_rng(seed)
    k = len(labels)
    lines, tags = [], []
    for text, lang in zip(texts, langs):
        for line in text.split("\n"):
            words = words_of(line)
            # Long lines are learned in parts, all of them.
            for at in range(0, len(words), LINE_WORDS):
                part = words[at : at + LINE_WORDS]
                lines.append(part)
                tags.append([labels.index(lang)] * len(part))
    spelling = learn_spelling([w for line in lines for w in line])
    # Code-switched lines: one in eight is continued by part of another.
    for i in rng.permutation(len(lines))[: len(lines) // 8]:
        j = int(rng.integers(len(lines)))
        part = max(1, len(lines[j]) // 2)
        lines.append(lines[i] + lines[j][:part])
        tags.append(tags[i] + tags[j][:part])
    weights, start, step = np.zeros((TABLE, k)), np.zeros(k), np.zeros((k, k))
    moves = [Adagrad(x.shape, rate) for x, rate in ((weights, 0.3), (start, 0.1), (step, 0.1))]
    for _ in range(EPOCHS):
        order = rng.permutation(len(lines))
        for at in range(0, len(order), BATCH_LINES):
            chosen = order[at : at + BATCH_LINES]
            lengths = np.array([len(lines[i]) for i in chosen])
            words = [w for i in chosen for w in lines[i]]
            gold = np.array([x for i in chosen for x in tags[i]])
            index, counts = features(words)
            scale = 1 / np.sqrt(counts)
            scores = np.add.reduceat(weights[index], np.concatenate(([0], np.cumsum(counts)[:-1])), axis=0) * scale[:, None]
            marginals, changes = forward_backward(scores, lengths, Chain(start, step), count=True)
            error = -marginals
            error[np.arange(len(gold)), gold] += 1
            seen = label_changes(gold, lengths, k) - changes
            spread = np.repeat(error * scale[:, None], counts, axis=0)
            gradient = np.stack([np.bincount(index, spread[:, c], TABLE) for c in range(k)], axis=1)
            weights = weights + moves[0].move(gradient / len(chosen))
            start = start + moves[1].move(seen[k] / len(chosen))
            step = step + moves[2].move(seen[:k] / len(chosen))
    return LanguageModel(labels, weights.astype(np.float32), Chain(start, step), spelling)


class Known(dict):
    """Number of the word of each token met, in the order the words are met; -1 for a token without letters."""

    def __init__(self):
        super().__init__()
        self.words: dict[str, int] = {}
        self.new: list[str] = []

    def __missing__(self, token: str) -> int:
        word = letters_of(token)
        number = self.words.get(word, -1) if word else -1
        if word and number < 0:
            number = self.words[word] = len(self.words)
            self.new.append(word)
        self[token] = number
        return number


class Labeller:
    """Labels texts with one model, keeping the scores of a bounded number of words."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known, self.scores, self.letters = Known(), np.zeros((0, len(self.model.labels)), np.float32), np.zeros(0)
        self.spelled = np.zeros(0, bool)

    def _numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self.known) > CACHE_TOKENS:
            self._forget()
        found = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        if new := self.known.new:
            parts = [word_scores(new[i : i + 20_000], self.model.weights) for i in range(0, len(new), 20_000)]
            self.scores = np.concatenate([self.scores, *parts]).astype(np.float32)
            self.letters = np.concatenate([self.letters, np.fromiter(map(len, new), np.float64, len(new))])
            told = [known_words(new[i : i + 20_000], self.model.spelling) for i in range(0, len(new), 20_000)]
            self.spelled = np.concatenate([self.spelled, *told])
            self.known.new = []
        return found

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """Language probabilities of each text; a row of zeros for a text without letters."""
        return self.judged(texts)[0]

    def judged(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language probabilities of each text, and the share of its letters that is in known words."""
        out, known = np.zeros((len(texts), len(self.model.labels))), np.zeros(len(texts))
        for start, stop in blocks(texts):
            tokens, lengths, owners = [], [], []
            for n in range(start, stop):
                for line in (texts[n] or "").split("\n"):
                    found = line.split()
                    tokens += found
                    lengths.append(len(found))
                    owners.append(n - start)
            numbers = self._numbers(tokens)
            line = np.repeat(np.arange(len(lengths)), lengths)[numbers >= 0]
            numbers = numbers[numbers >= 0]
            if not len(numbers):
                continue
            owner = np.array(owners)[line]
            lengths = np.bincount(line)
            marginals, _ = forward_backward(self.scores[numbers], lengths[lengths > 0], self.model.chain)
            letters = self.letters[numbers]
            for c in range(out.shape[1]):
                out[start:stop, c] = np.bincount(owner, marginals[:, c] * letters, stop - start)
            whole = np.bincount(owner, letters, stop - start)
            known[start:stop] = np.bincount(owner, letters * self.spelled[numbers], stop - start) / np.maximum(whole, 1)
        total = out.sum(axis=1, keepdims=True)
        return np.divide(out, total, out=np.zeros_like(out), where=total > 0), known


def blocks(texts: list[str]) -> list[tuple[int, int]]:
    """Runs of texts of about BLOCK_CHARACTERS; a longer text is one run."""
    out, start, size = [], 0, 0
    for n, text in enumerate(texts):
        size += len(text or "")
        if size >= BLOCK_CHARACTERS:
            out.append((start, n + 1))
            start, size = n + 1, 0
    return out + ([(start, len(texts))] if start < len(texts) else [])


def fit(docs: DataFrame) -> LanguageModel | None:
    """A model from a bounded sample of the documents with a language that are not held out; None without any."""
    settle(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id")) & (F.length("text") > 0))
    # A piece of each document, from a place that depends on its id: learning needs no whole texts.
    room = F.greatest(F.length("text") - FIT_CHARACTERS, F.lit(0)) + 1
    piece = F.substring("text", F.pmod(F.xxhash64("doc_id"), room).cast("int") + 1, F.lit(FIT_CHARACTERS))
    chosen = bounded_sample(rows, "doc_id", "lang", FIT_DOCUMENTS)
    sample = chosen.select("doc_id", "lang", piece.alias("piece")).orderBy("doc_id", "piece").collect()
    sample = [r for r in sample if letters_of(r["piece"])]
    return train([r["piece"] for r in sample], [r["lang"] for r in sample]) if sample else None


def predict(text: Column, model: LanguageModel | None, spark) -> Column:
    """Struct of lang_pred and score for a text."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    # Plain arrays: a broadcast is unpickled without the shipped modules.
    spelling = model.spelling
    plain = (model.labels, model.weights, model.chain.start, model.chain.step, (spelling.letters, spelling.pairs, spelling.triples))
    sent, kept = spark.sparkContext.broadcast(plain), {}

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        if "it" not in kept:
            labels, weights, start, step, tables = sent.value
            kept["it"] = Labeller(LanguageModel(labels, weights, Chain(start, step), Spelling(*tables)))
        p, known = kept["it"].judged(list(texts))
        names = np.array([*kept["it"].model.labels, UNKNOWN], dtype=object)
        best = np.where(p.sum(axis=1) > 0, p.argmax(axis=1), len(names) - 1)
        return pd.DataFrame({"lang_pred": names[best], "score": np.where(known >= LEAST_KNOWN, np.clip(p.max(axis=1), 0.0, 1.0), 0.0)})

    return label(text)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, in any order; other columns are ignored.

    A NULL text or one without letters is ``und`` with score 0, and so is every row when no document has both a
    language and letters to learn from. A NULL doc_id is not held out and is never learned from. A text with most of
    its letters in words spelled like no learned language still gets the language that fits best, with score 0.
    Repeated rows are labelled alike.
    """
    model = fit(docs)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text"), model, docs.sparkSession).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, least_score: float = 0.25) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least ``least_score``, all columns kept.

    Rows without letters go, and so do those spelled like no learned language, however many are learned; text in
    several learned languages stays. Without any language to learn from nothing can be judged, and all rows stay.
    """
    model = fit(docs)
    if model is None:
        return docs
    name = free_name(docs.columns, "identified")
    judged = docs.withColumn(name, predict(F.col("text"), model, docs.sparkSession))
    return judged.filter((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least_score)).drop(name)


ship("ledgerloom.llm.chain", __name__)

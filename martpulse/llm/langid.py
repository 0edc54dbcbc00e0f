"""Operator 5: language of whole texts by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is
the sum over all its segmentations into pieces, by the forward algorithm; a text's is the product over
its words. The piece probabilities come from expectation-maximisation over the word counts of a
bounded sample of labelled documents (``sample_per_language``), run as Spark jobs. The sums are kept as
logarithms, for many words and all languages in one numpy step, so no run of letters is cut and none underflows.

Cases: null text, or text without a letter: ``und`` with score 0; null languages and held-out rows are
never learned from; a language with few rows uses all of them; ties go to the first language in
alphabetical order; without any labelled row everything is ``und``; very long texts and runs of letters are
scored whole, a run of more than ``RUN_CHARS`` with sums for its last positions only; repeated rows are scored each; an empty table gives an empty table; extra columns pass through.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martpulse.llm.common import PerWorker, Scratch, add_columns

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
WORD_MARK = "▁"
#: Words longer than this are not remembered.
CACHE_CHARS = 64
CACHE_ENTRIES = 400_000
#: Letters of the words whose lattices are summed in one step, at most; a longer word is summed on its own.
RUN_CHARS = 50_000
#: Characters of the texts whose words are looked up together; the last text of such a group may be longer.
GROUP_CHARS = 500_000
#: Probability of a character that no piece covers.
STRAY = 1e-9


def pieces_of(vocabulary_path: str) -> list[str]:
    """Normal pieces of a public vocabulary in sentencepiece's format, lower-cased, each once."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path)
    return sorted({sp.id_to_piece(i).lower() for i in range(sp.get_piece_size())
                   if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))})


def split_words(text: str | None) -> Counter:
    """Distinct words of a text, marked as the vocabulary marks word beginnings, with their number."""
    if not text:
        return Counter()
    found = Counter(_WORD.findall(text.lower()))
    if not any(c.isalpha() for w in found for c in w):
        return Counter()
    return Counter({WORD_MARK + w: n for w, n in found.items()})


def trie(pieces: list[str]) -> dict:
    """Pieces as nested dictionaries: character -> (number of the piece that ends here or -1, what follows)."""
    root: dict = {}
    for i, piece in enumerate(pieces):
        node = root
        for char in piece[:-1]:
            node = node.setdefault(char, (-1, {}))[1]
        node[piece[-1]] = (i, node[piece[-1]][1] if piece[-1] in node else {})
    return root


def arcs_from(word: str, start: int, root: dict):
    """(end, piece) of every piece that starts here; -1 for a character that is no piece itself."""
    node, end = root, start
    while end < len(word):
        step = node.get(word[end])
        if step is None:
            break
        end += 1
        piece, node = step
        if piece >= 0 or end == start + 1:
            yield end, piece
    if end == start:
        yield start + 1, -1


class Lattice:
    """All pieces of some words: arcs between positions. A word of n characters has n + 1 positions of its own."""

    def __init__(self, words: list[str], root: dict):
        start, end, piece = array("q"), array("q"), array("i")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        base = 0
        for word in words:
            chars = len(word)
            for at in range(chars):
                node, to = root, at
                while to < chars:
                    step = node.get(word[to])
                    if step is None:
                        break
                    to += 1
                    number, node = step
                    if number >= 0 or to == at + 1:
                        start.append(base + at)
                        end.append(base + to)
                        piece.append(number)
                if to == at:
                    start.append(base + at)
                    end.append(base + at + 1)
                    piece.append(-1)
            base += chars + 1
        self.start, self.end, self.piece = (np.frombuffer(x, x.typecode) if len(x) else np.zeros(0, np.int64) for x in (start, end, piece))
        self.first = np.cumsum(sizes + 1) - sizes - 1  # position of each word's beginning
        self.last = self.first + sizes
        self.word = np.repeat(np.arange(len(words)), sizes + 1)  # by position

    def sums(self, cost: np.ndarray, backward: bool = False) -> np.ndarray:
        """Log of the sum over all ways from a word's beginning to each position (``backward``: from there to its end).

        ``cost``: log probabilities by arc and language. One step handles the positions that are as far from that
        end in all words.
        """
        near, far = (self.end, self.start) if backward else (self.start, self.end)
        away = (self.last[self.word[far]] - far) if backward else (far - self.first[self.word[far]])
        order = np.lexsort((far, away))
        near, far, away, cost = near[order], far[order], away[order], cost[order]
        out = np.zeros((len(self.word), cost.shape[1]))
        cuts = np.r_[0, np.flatnonzero(np.diff(away)) + 1, len(away)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            place = far[a:b]
            heads = np.r_[0, np.flatnonzero(np.diff(place)) + 1]
            ways = out[near[a:b]] + cost[a:b]
            top = np.maximum.reduceat(ways, heads)
            ways -= np.repeat(top, np.diff(np.r_[heads, b - a]), axis=0)
            out[place[heads]] = top + np.log(np.add.reduceat(np.exp(ways), heads))
        return out


def logs(probs) -> np.ndarray:
    """Log probabilities by piece and language; the last row is the stray character's."""
    return np.log(np.maximum(np.asarray(probs, np.float64), 1e-300)).T.copy()


def by_size(words: list[str]):
    """Slices of the words of about RUN_CHARS letters."""
    at, letters = 0, 0
    for i, w in enumerate(words):
        if i > at and letters + len(w) > RUN_CHARS:
            yield slice(at, i)
            at, letters = i, 0
        letters += len(w)
    if words:
        yield slice(at, len(words))


def forward_rows(words: list[str], root: dict, cost: np.ndarray) -> np.ndarray:
    """Log probability of words (rows) in every language: the sum over all their segmentations."""
    out = np.zeros((len(words), cost.shape[1]))
    for part in by_size(words):
        if part.stop - part.start == 1 and len(words[part.start]) > RUN_CHARS:
            out[part] = forward_run(words[part.start], root, cost)
        else:
            lattice = Lattice(words[part], root)
            out[part] = lattice.sums(cost[lattice.piece])[lattice.last]
    return out


def forward_run(word: str, root: dict, cost: np.ndarray) -> np.ndarray:
    """As ``forward_rows`` for one very long word: only positions that a piece can still reach are held."""
    waiting: deque[list[np.ndarray]] = deque([[np.zeros(cost.shape[1])]])
    for start in range(len(word)):
        here = np.logaddexp.reduce(waiting.popleft())
        for end, piece in arcs_from(word, start, root):
            while len(waiting) < end - start:
                waiting.append([])
            waiting[end - start - 1].append(here + cost[piece])
    return np.logaddexp.reduce(waiting.popleft())


def forward(word: str, root: dict, probs: list[list[float]]) -> list[float]:
    """Log probability of one word in every language."""
    return forward_rows([word], root, logs(probs))[0].tolist()


def expected_rows(words: list[str], root: dict, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, piece, expected uses of the piece in the word) over each word's segmentations (forward and backward
    sums). ``cost``: log probabilities by piece in one language."""
    lattice = Lattice(words, root)
    arc = cost[lattice.piece][:, None]
    before, after = lattice.sums(arc)[:, 0], lattice.sums(arc, backward=True)[:, 0]
    owner = lattice.word[lattice.start]
    uses = np.exp(before[lattice.start] + arc[:, 0] + after[lattice.end] - before[lattice.last][owner])
    real = lattice.piece >= 0
    return owner[real], lattice.piece[real], uses[real]


def expected(word: str, root: dict, p: list[float]) -> list[tuple[int, float]]:
    """Expected uses of each piece in one word, by arc."""
    _, piece, uses = expected_rows([word], root, logs([p])[:, 0])
    return list(zip(piece.tolist(), uses.tolist(), strict=True))


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    probs: list[list[float]]  # by language, by piece; the last entry is the stray character's
    cache: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.root = trie(self.pieces)
        self.cost = logs(self.probs) if self.languages else np.zeros((0, 0))
        self.rows = np.zeros((1024, len(self.languages)))  # by cache number; grows by doubling

    def word_rows(self, found: list[str]) -> np.ndarray:
        """Log probabilities of distinct words, one row each."""
        if any(len(w) > CACHE_CHARS for w in found):
            out = np.zeros((len(found), len(self.languages)))
            long = np.fromiter((len(w) > CACHE_CHARS for w in found), bool, len(found))
            out[long] = forward_rows([w for w in found if len(w) > CACHE_CHARS], self.root, self.cost)
            out[~long] = self.word_rows([w for w in found if len(w) <= CACHE_CHARS])
            return out
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        cache, first = self.cache, len(self.cache)
        new = [w for w in found if w not in cache]
        if new:
            cache.update(zip(new, range(first, first + len(new)), strict=True))
            while len(self.rows) < len(cache):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[first:len(cache)] = forward_rows(new, self.root, self.cost)
        return self.rows[list(map(cache.__getitem__, found))]

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and its share by text; the new words of about GROUP_CHARS characters of text are summed together."""
        out, group, chars = [], [], 0
        for text in texts:
            group.append(split_words(text) if self.languages else Counter())
            chars += len(text or "")
            if chars > GROUP_CHARS:
                out += self._predict_group(group)
                group, chars = [], 0
        return out + self._predict_group(group)

    def _predict_group(self, group: list[Counter]) -> list[tuple[str, float]]:
        every = list(set().union(*group))
        at = dict(zip(every, range(len(every)), strict=True))
        rows = self.word_rows(every) if every else None
        out = []
        for found in group:
            if not found:
                out.append((UNKNOWN, 0.0))
                continue
            times = np.fromiter(found.values(), float, len(found))
            total = times @ rows[np.fromiter(map(at.__getitem__, found), np.int64, len(found))]
            best = int(total.argmax())
            out.append((self.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def train(spark: SparkSession, df: DataFrame, vocabulary_path: str, text: str = "text", lang: str = "lang",
          key: str = "doc_id", sample_per_language: int = 400, rounds: int = 2, prior: float = 0.02) -> LanguageModel:
    """Learn from the rows of ``df`` with a language, about ``sample_per_language`` whole documents of each.

    The sample is drawn by a hash of the key against each language's share, so it is the same on every
    run. The driver gets one row per language and one per used piece (at most the vocabulary) and language.
    """
    pieces = pieces_of(vocabulary_path)
    rows = df.where(F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], pieces, [])
    rate = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample_per_language / sizes[k]))])
    draw = F.pmod(F.xxhash64(F.lit("language sample"), F.col(key)), F.lit(1_000_000)) / 1e6
    sample = rows.where(draw < rate[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count_words(batches):
        for b in batches:
            seen: Counter = Counter()
            for la, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for w, n in split_words(t).items():
                    seen[la, w] += n
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()),
                                              pa.array([k[1] for k in seen], pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])

    scratch = Scratch(spark, "langid")
    counted, path = scratch.put(sample.mapInArrow(count_words, "lang string, word string, n long")
                                .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    size = len(pieces)
    probs = np.full((len(languages), size + 1), 1.0 / size)
    probs[:, -1] = STRAY
    at = {la: i for i, la in enumerate(languages)}
    for _ in range(rounds):
        given = spark.sparkContext.broadcast((pieces, probs.astype(np.float32)))

        def uses(batches, given=given):
            pieces_, p = given.value
            root_, cost = trie(pieces_), logs(p)
            got = np.zeros((len(languages), len(pieces_)))
            for b in batches:
                of, word, n = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_numpy()
                for la in set(of):
                    rows = [i for i, x in enumerate(of) if x == la]
                    words, times = [word[i] for i in rows], n[rows]
                    for part in by_size(words):
                        owner, piece, e = expected_rows(words[part], root_, cost[:, at[la]])
                        got[at[la]] += np.bincount(piece, e * times[part][owner], len(pieces_))
            row, piece = np.nonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array([languages[i] for i in row.tolist()], pa.string()), pa.array(piece.astype(np.int32)),
                                              pa.array(got[row, piece])], names=["lang", "piece", "e"])

        gathered = (counted.mapInArrow(uses, "lang string, piece int, e double").groupBy("lang", "piece")
                    .agg(F.sum("e").alias("e")).toPandas())
        counts = np.full((len(languages), size + 1), prior)
        np.add.at(counts, (gathered["lang"].map(at).to_numpy(int), gathered["piece"].to_numpy(int)), gathered["e"].to_numpy())
        probs = counts / counts[:, :-1].sum(axis=1, keepdims=True)
        probs[:, -1] = STRAY
        given.destroy()
    scratch.drop(path)
    return LanguageModel(languages, pieces, probs.tolist())


def _rebuild(parts) -> LanguageModel:
    languages, pieces, probs = parts
    return LanguageModel(languages, pieces, probs.astype(float).tolist())


def predict(spark: SparkSession, df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``df`` plus ``lang_pred`` and ``score`` (share of the predicted language among all, 0 to 1)."""
    shared = PerWorker(spark, (model.languages, model.pieces, np.asarray(model.probs, np.float32)), _rebuild)

    def run(texts: pa.Array) -> list[pa.Array]:
        known = shared.get()
        out = known.predict_all(texts.to_pylist())
        return [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())]

    return add_columns(df, text, run, "lang_pred string, score double")

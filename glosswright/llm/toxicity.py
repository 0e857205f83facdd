"""Problem 10: abusive, hateful and sexual content, scored by severity.

Words are freed from disguise (look-alikes, digits for letters, stretched or separated
letters). A window of REACH words has sparse features: its words, their runs of letters,
pairs and triples of words, and the words around it, all hashed, so that any word can count;
one more feature per category is membership in a word list. A cumulative-link regression per
category turns them into an expected severity from 0 (none) over 1 (a word of that kind in
another sense) to 2 (severe). A document's score is that of its worst window.

The regression starts from made sentences (toxic_seeds) and learns from the labelled
documents, at most MAX_LABELS of them. A label is of a whole document, so each document
counts by its worst windows, searched among all of its windows anew in each of ROUNDS rounds
and kept; runs of words that toxic documents hold far oftener than clean ones help the
search. A toxic label without any such sign is doubted and not used, nor are windows of clean
documents with such runs, and labels pull less the less the model believes them.

Defined results: null and empty texts have severity 0 in every category; labels that are
null or contradict each other are not used; whole texts are scanned; without labels the made
sentences alone decide.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glosswright.llm import toxic_seeds
from glosswright.llm.leaks import INVISIBLE, LOOK_ALIKES
from glosswright.llm.ordinal import OrdinalModel, Rows, fit
from glosswright.llm.toxic_seeds import LEXICON, LISTS
from glosswright.runtime import cut, spread

CATEGORIES = ("abuse", "hate", "sexual")
#: Labelled documents of the fit: the least hashes of their ids.
MAX_LABELS = 5_000
SEVERE = 1.0
#: Words of a window, and words before and after it that count as its surroundings.
REACH, AROUND = 10, 7
ROUNDS = 3
STEPS = 40
#: Severity from which a window of a toxic document may be why it was called so.
EVIDENT = 1.0
#: The category of a window is clear if its evidence is so many times that of the next one.
CLEAR = 2.0
#: How far labels are doubted: a row whose grade the model gives less than this pulls less than half.
WRONG_TOXIC, WRONG_CLEAN = 0.02, 0.003
#: Hashed features; the list features come after them.
BITS = 18
SIZE = 1 << BITS
GRAM = 4
LIST_PRIOR, THRESHOLDS = 2.0, (2.0, 4.5)

#: Stands after a word that was put together from separated letters.
REVEALED = "\ue000"
#: Marks a word that was disguised.
HIDDEN = "\ue001"
LEET = str.maketrans("0134578@$€!|+", "oieastbaseilt")
LEET_L = str.maketrans("0134578@$€!|+", "oleastbaselit")
TOKEN = re.compile(r"[@$€]?[^\W_]+(?:[@$€*!|+]+[^\W_]+)*[@$€]?|\*[^\W_]{3,}|[^\W_]{2,}\*+[^\W_]*")
SEPARATED = re.compile(r"(?<![^\W_])(?:[^\W\d_]([ .\-_*·~/]))(?:[^\W\d_]\1){2,}[^\W\d_](?![^\W_])")
_RUN = re.compile(r"(.)\1+")
LONG_WORDS = sorted((w for w in LEXICON | {"fuck", "fucking"} if len(w) >= 4), key=lambda w: (-len(w), w))


def _squeeze(word: str) -> str:
    return _RUN.sub(r"\1", word)


_SQUEEZED = {_squeeze(w): w for w in sorted(LONG_WORDS, key=lambda w: (len(w), w))}
_BY_LENGTH: dict[int, list[str]] = {}
for _w in LONG_WORDS:
    _BY_LENGTH.setdefault(len(_w), []).append(_w)


def _reveal(word: str) -> str:
    """The word of the lists that *word* disguises, marked; else the word, with digits among letters read as letters."""
    if word in LEXICON or word.isdigit():
        return word
    if word.isalpha():
        if _RUN.search(word) and (known := _SQUEEZED.get(_squeeze(word))) and len(word) > len(known):
            return known + HIDDEN
        if "v" in word and (w := word.replace("v", "u")) in LEXICON:
            return w + HIDDEN
        return word
    for table in (LEET, LEET_L):
        w = word.translate(table)
        for x in (w, w.replace("v", "u")):
            if x in LEXICON:
                return x + HIDDEN
            if known := _SQUEEZED.get(_squeeze(x)):
                return known + HIDDEN
            if "*" in x:
                shape = re.compile(re.escape(x).replace(r"\*", "."))
                for size in (len(x), len(x) - 1) if x.count("*") > 1 else (len(x),):
                    for candidate in _BY_LENGTH.get(size, ()):
                        if shape.fullmatch(candidate):
                            return candidate + HIDDEN
    w = word.translate(LEET)
    return w if w.isalpha() and sum(map(str.isalpha, word)) * 2 > len(word) else word


def _join_separated(match: re.Match) -> str:
    joined = re.sub(r"[^\w]|_", "", match.group()).lower()
    plain = "".join(c for c in unicodedata.normalize("NFKD", joined).translate(LOOK_ALIKES) if not unicodedata.combining(c))
    for word in LONG_WORDS:
        if word in plain:
            return f" {plain[: plain.index(word)]} {word}{REVEALED} "
    return match.group()


class _Units(dict):
    """Text without spaces -> its words, freed from disguise."""

    def __missing__(self, unit: str) -> tuple[str, ...]:
        text = unit
        if not text.isascii():
            text = unicodedata.normalize("NFKD", INVISIBLE.sub("", text)).translate(LOOK_ALIKES)
            text = "".join(c for c in text if not unicodedata.combining(c)).replace("ß", "ss")
        words = tuple(map(_reveal, TOKEN.findall(text.lower())))
        if words and REVEALED in unit and not words[-1].endswith(HIDDEN):
            words = (*words[:-1], words[-1] + HIDDEN)
        if len(unit) <= 40 and len(self) < 400_000:
            self[unit] = words
        return words


def words_of(text: str, units: dict) -> list[str]:
    """All words of *text*, freed from disguise; those that were disguised end in HIDDEN."""
    if SEPARATED.search(text):
        text = SEPARATED.sub(_join_separated, text)
    if not text.isascii():
        text = INVISIBLE.sub("", text)
    return list(chain.from_iterable(map(units.__getitem__, text.split())))


def _bucket(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key) >> (64 - BITS)


@lru_cache(maxsize=200_000)
def _word_features(word: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """Features of one word by itself: the word, its runs of letters, list membership, disguise."""
    plain = word.removesuffix(HIDDEN)
    index, value = [_bucket(f"w {plain}")], [1.0]
    marked = f"<{plain}>"
    grams = [marked[k : k + GRAM] for k in range(len(marked) - GRAM + 1)] if len(plain) >= 4 else []
    index += [_bucket(f"c {g}") for g in grams]
    value += [max(1, len(grams)) ** -0.5] * len(grams)
    for k, c in enumerate(CATEGORIES):
        strong, weak = LISTS[c]
        if plain in strong or plain in weak:
            index.append(SIZE + k)
            value.append(1.0 if plain in strong else 0.4)
            if plain != word:
                index.append(SIZE + len(CATEGORIES) + k)
                value.append(1.0)
    return tuple(index), tuple(value)


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _runs(h: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(places before the last word, feature) of word pairs, pairs with a gap and triples; h: hashes of the words."""
    out, shift = [], np.uint64(64 - BITS)
    with np.errstate(over="ignore"):
        if len(h) > 1:
            out.append((1, ((h[:-1] * _MIX[0] + h[1:]) * _MIX[1]) >> shift))
        if len(h) > 2:
            out.append((2, ((h[:-2] * _MIX[1] + h[2:]) * _MIX[2]) >> shift))
            out.append((2, (((h[:-2] * _MIX[2] + h[1:-1]) * _MIX[0] + h[2:]) * _MIX[1]) >> shift))
    return out


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.removesuffix(HIDDEN))


def features(words: list[str], a: int, b: int) -> tuple[list[int], list[float]]:
    """Features of the window words[a:b] with its surroundings."""
    index: list[int] = []
    value: list[float] = []
    for w in words[a:b]:
        i, v = _word_features(w)
        index += i
        value += v
    h = np.array([_hash(w) for w in words[a:b]], dtype=np.uint64)
    for _, found in _runs(h):
        index += found.astype(np.int64).tolist()
        value += [1.0] * len(found)
    near = words[max(0, a - AROUND) : b + AROUND]
    index += [_bucket(f"n {w.removesuffix(HIDDEN)}") for w in near]
    value += [1.0] * len(near)
    return index, value


#: Words of a text that are scored at once; longer texts go in pieces that overlap by a window and its surroundings.
PIECE = 50_000


class Scorer:
    """Etas of all windows of texts by one table of weights; words are looked up once per worker."""

    def __init__(self, model: OrdinalModel):
        self.model, self.units = model, _Units()
        self.table = model.weights[:SIZE]
        self.at: dict[str, int] = {}
        self.own = np.zeros((1024, 2 * len(CATEGORIES)))
        self.hashes = np.zeros(1024, dtype=np.uint64)

    def _number(self, word: str) -> int:
        k = len(self.at)
        if k == len(self.own):
            self.own, self.hashes = np.concatenate([self.own, np.zeros_like(self.own)]), np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        index, value = _word_features(word)
        self.own[k, : len(CATEGORIES)] = np.array(value) @ self.model.weights[list(index)]
        self.own[k, len(CATEGORIES) :] = self.table[_bucket(f"n {word.removesuffix(HIDDEN)}")]
        self.hashes[k] = _hash(word)
        self.at[word] = k
        return k

    def etas(self, words: list[str], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(etas of the window of up to REACH words from each word on, hashes of the words); texts end at *ends*."""
        c, n = len(CATEGORIES), len(words)
        if len(self.at) > 500_000:  # memory stays bounded; results do not change
            self.at.clear()
        get, number = self.at.get, self._number
        found = np.array([k if (k := get(w)) is not None else number(w) for w in words])
        sizes = np.diff(ends, prepend=0)
        first, last = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
        k = np.arange(n)
        end = np.minimum(k + REACH, last)
        sums = np.zeros((n + 1, 2 * c))
        np.cumsum(self.own[found], axis=0, out=sums[1:])
        out = sums[end, :c] - sums[:-1, :c]
        hashes = self.hashes[found]
        for back, run in _runs(hashes):
            weight = self.table[run.astype(np.int64)]
            weight[first[back:] != first[:-back]] = 0.0  # from one text into the next
            total = np.zeros((n + 1, c))
            np.cumsum(weight, axis=0, out=total[back + 1 :])
            out += total[end] - total[np.minimum(k + back, end)]
        out += sums[np.minimum(end + AROUND, last), c:] - sums[np.maximum(k - AROUND, first), c:]
        return out, hashes

    def pieces(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(text numbers, words, ends, etas, hashes, counted) of the texts in pieces of bounded size; only counted windows belong to the piece."""
        margin = REACH + AROUND
        numbers: list[int] = []
        words: list[str] = []
        ends: list[int] = []
        cores: list[tuple[int, int]] = []

        def done():
            counted = np.zeros(len(words), dtype=bool)
            for a, b in cores:
                counted[a:b] = True
            etas, hashes = self.etas(words, np.array(ends))
            return np.array(numbers), words, np.array(ends), etas, hashes, counted

        for number, text in enumerate(texts):
            found = words_of(text, self.units) if text else []
            for start in range(0, len(found), PIECE):
                lead = min(start, AROUND)
                part = found if len(found) <= PIECE else found[start - lead : start + PIECE + margin]
                numbers.append(number)
                cores.append((len(words) + lead, len(words) + lead + min(PIECE, len(found) - start)))
                words += part
                ends.append(len(words))
                if len(words) >= PIECE:
                    yield done()
                    numbers, words, ends, cores = [], [], [], []
        if words:
            yield done()

    def severities(self, texts: list[str | None]) -> np.ndarray:
        """(texts, categories): expected severity of each text's worst window."""
        worst = np.full((len(texts), len(CATEGORIES)), -np.inf)
        for numbers, _, ends, etas, _, counted in self.pieces(texts):
            etas[~counted] = -np.inf
            np.maximum.at(worst, numbers, np.maximum.reduceat(etas, np.concatenate([[0], ends[:-1]]), axis=0))
        out = self.model.severity(worst)
        out[np.isneginf(worst)] = 0.0
        return out


def _rows(examples: list[tuple[list[str], int, int, np.ndarray, np.ndarray, float]]) -> Rows:
    """Design of (words, window start, end, low, high, doubted) examples."""
    index, value, start = [], [], []
    for words, a, b, *_ in examples:
        i, v = features(words, a, b)
        start.append(len(index))
        index += i
        value += v
    low, high, doubted = (np.array([e[k] for e in examples]) for k in (3, 4, 5))
    return Rows(np.array(index, dtype=np.int64), np.array(value), np.array(start, dtype=np.int64), low, high, doubted)


def prior() -> OrdinalModel:
    """Hashed features weigh nothing; being in a category's list weighs LIST_PRIOR for that category."""
    n = len(CATEGORIES)
    weights = np.zeros((SIZE + 2 * n, n))
    weights[SIZE : SIZE + n] = LIST_PRIOR * np.eye(n)
    weights[SIZE + n :] = LIST_PRIOR * np.eye(n)
    return OrdinalModel(weights, np.tile(np.array(THRESHOLDS), (n, 1)))


def _made(without: frozenset[str] = frozenset()) -> list:
    """Examples of the made sentences."""
    units, out, n = _Units(), [], len(CATEGORIES)
    for category, grade, sentence in dict.fromkeys(toxic_seeds.sentences(without)):
        words = words_of(sentence, units)
        low, high = np.zeros(n, dtype=int), np.full(n, 1 if grade else 0)
        if category:
            low[CATEGORIES.index(category)] = high[CATEGORIES.index(category)] = 2
        out += [(words, 0, len(words), low, high, 0.0)] if words else []
    return out


@lru_cache(maxsize=4)
def seed_model(without: frozenset[str] = frozenset()) -> OrdinalModel:
    """The regression after the made sentences alone."""
    return fit(_rows(_made(without)), prior(), steps=2 * STEPS)


#: A run of words is a sign where its odds in toxic documents are beyond chance: likelihood ratio and least log odds.
BEYOND_CHANCE, LOG_ODDS = 13.0, 2.0


def _signs(labelled: DataFrame) -> np.ndarray:
    """Hashed word runs that toxic documents hold far oftener than clean ones (a bounded set: SIZE buckets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _Units()
        for batch in batches:
            buckets, toxic = [], []
            for text, share in zip(batch.column("text").to_pylist(), batch.column("share").to_pylist()):
                h = np.array([_hash(w) for w in words_of(text, units)], dtype=np.uint64)
                found = np.unique(np.concatenate([f for _, f in _runs(h)] or [np.zeros(0, dtype=np.uint64)]))
                buckets.append(found.astype(np.int64))
                toxic.append(np.full(len(found), int(share > 0.5)))
            both = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (buckets, toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in both], names=["run", "toxic"])

    totals = labelled.agg(F.sum((F.col("share") > 0.5).cast("long")).alias("t"), F.count("*").alias("n")).first()
    if not totals.t or totals.t == totals.n:
        return np.zeros(0, dtype=np.int64)
    rate = totals.t / totals.n
    counted = labelled.mapInArrow(run, "run bigint, toxic bigint").groupBy("run").agg(F.sum("toxic").cast("double").alias("t"), F.count("*").cast("double").alias("n")).where("t >= 3")
    share = F.col("t") / F.col("n")
    ratio = F.col("t") * F.log(share / rate) + F.when(share < 1, (F.col("n") - F.col("t")) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    odds = F.log((F.col("t") + 0.5) / (F.col("n") - F.col("t") + 0.5)) - float(np.log(rate / (1 - rate)))
    return np.array(sorted(r.run for r in counted.where((ratio > BEYOND_CHANCE) & (odds > LOG_ODDS)).select("run").collect()), dtype=np.int64)


def _worst_windows(labelled: DataFrame, model: OrdinalModel, signs: np.ndarray, with_toxic: bool) -> list:
    """Examples of labelled documents: all windows of a toxic one with signs of being so, a clean one's worst of each category."""
    schema = "doc_id bigint, category int, toxic boolean, words array<string>, a int, b int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            docs, shares = batch.column("doc_id").to_pylist(), batch.column("share").to_pylist()
            best: dict[tuple[int, int], tuple] = {}
            for numbers, words, ends, etas, hashes, counted in scorer.pieces(batch.column("text").to_pylist()):
                hit = np.zeros(len(words) + 1)
                for back, found in _runs(hashes) if len(signs) else ():
                    hit[back + 1 :] += np.isin(found.astype(np.int64), signs)
                total, begin = hit.cumsum(), 0
                for number, end in zip(numbers.tolist(), ends.tolist()):
                    k = begin + np.flatnonzero(counted[begin:end])
                    signed = total[np.minimum(k + REACH, end)] - total[k]
                    if shares[number] > 0.5:
                        found, rank = [], etas[k].max(1) + 2 * np.minimum(3.0, signed)
                        # severe by the model, or marked by runs of words: else there is no sign that the label is right
                        rank[(scorer.model.severity(etas[k]).max(1) < EVIDENT) & (signed < 2)] = -np.inf
                        while with_toxic and (at := int(rank.argmax())) >= 0 and rank[at] > -np.inf:
                            found.append((("severe", int(k[at])), k[at], int(etas[k[at]].argmax()), rank[at]))
                            rank[max(0, at - REACH - AROUND) : at + REACH + AROUND] = -np.inf
                    else:
                        # runs of words of toxic documents contradict the label of a clean one
                        found = [(c, k[at], c, etas[k[at], c]) for c, at in enumerate(np.where(signed[:, None] >= 2, -np.inf, etas[k]).argmax(0)) if signed[at] < 2]
                    for slot, place, c, rank in found:
                        if (old := best.get((number, slot))) is None or rank > old[0]:
                            a, b = max(begin, place - AROUND), min(end, place + REACH)
                            best[number, slot] = (rank, c, words[a : min(end, b + AROUND)], int(place - a), int(b - a))
                    begin = end
            rows = [(docs[n], c, shares[n] > 0.5, near, a, b) for (n, _), (_, c, near, a, b) in best.items()]
            cols = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.string()), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds)], names=["doc_id", "category", "toxic", "words", "a", "b"])

    # short windows of at most MAX_LABELS documents; in a fixed order, so that fits repeat exactly
    rows = sorted(labelled.mapInArrow(run, schema).collect(), key=lambda r: (r.doc_id, r.category, r.a))
    kinds, out, n = _kinds([list(r.words) for r in rows if r.toxic], model, signs), [], len(CATEGORIES)
    for r in rows:
        low, high = np.zeros(n, dtype=int), np.full(n, 1)
        if r.toxic:
            k = next(kinds)
            if k < 0:
                continue
            low[k] = high[k] = 2
        out.append((list(r.words), r.a, r.b, low, high, WRONG_TOXIC if r.toxic else WRONG_CLEAN))
    return out


def _kinds(windows: list[list[str]], model: OrdinalModel, signs: np.ndarray) -> Iterator[int]:
    """Category of each toxic window by its own severities and those of all windows that share its signs; -1 where that is not clear yet."""
    if not windows:
        return
    scorer, known = Scorer(model), set(signs.tolist())
    words, ends = list(chain.from_iterable(windows)), np.cumsum([len(w) for w in windows])
    etas, _ = scorer.etas(words, ends)
    own = model.severity(np.maximum.reduceat(etas, np.concatenate([[0], ends[:-1]]), axis=0))
    runs = [known.intersection(*[np.concatenate([f for _, f in _runs(np.array([_hash(x) for x in w], dtype=np.uint64))] or [np.zeros(0)]).astype(np.int64).tolist()]) for w in windows]
    votes: dict[int, np.ndarray] = {}
    for found, severity in zip(runs, own):
        for k in found:
            votes[k] = votes.get(k, 0.0) + np.append(severity**2, 1.0)
    for found, severity in zip(runs, own):
        shared = sum((votes[k][:-1] / votes[k][-1] for k in sorted(found)), np.zeros(len(CATEGORIES)))
        total = severity**2 + 2 * shared / max(1, len(found))
        first, second = np.sort(total)[[-1, -2]]
        yield int(total.argmax()) if first >= CLEAR * max(second, 0.1) else -1


def train(documents: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> OrdinalModel:
    """The regression fitted to made sentences and to labelled documents, each by its worst windows."""
    votes = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("toxic").alias("share")).where("share <> 0.5")
    picked = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)  # bounded, so it is broadcast
    labelled = cut(documents.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id"))
    model = seed_model()
    signs = _signs(labelled)
    made, gathered = _made(), {}
    for k in range(ROUNDS):
        # first clean documents alone, so that what ordinary texts say is no sign of a toxic one
        for e in _worst_windows(labelled, model, signs, with_toxic=k > 0):
            gathered[(tuple(e[0]), e[1], tuple(e[3]), tuple(e[4]))] = e
        if not gathered:
            break
        model = fit(_rows(made + list(gathered.values())), prior(), steps=STEPS, begin=model)
    return model


def score(documents: DataFrame, model: OrdinalModel) -> DataFrame:
    """(doc_id, source, abuse, hate, sexual): expected severities of every document."""
    data = spread(documents.select("doc_id", "source", "text"))
    schema = T.StructType([data.schema["doc_id"], data.schema["source"], *[T.StructField(c, T.DoubleType(), False) for c in CATEGORIES]])
    light = OrdinalModel(model.weights.astype(np.float32), model.thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(light)
        for batch in batches:
            found = scorer.severities(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in found.T)], names=schema.names)

    return data.mapInArrow(run, schema)

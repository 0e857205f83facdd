"""Languages of the corpus: canonical codes, function words and a small detector."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Frequent function words, without those that two of the languages share.
FUNCTION_WORDS = {
    "en": "the of and to that was is it for with as his her they at this be from have had not are but were which she he there been their one would all will has if we you my when who what out so said its into them can only other some could these two may then any such our an before after while than over by how nobody without because every until somebody once during again your about a as between somewhere each another more most us me him no".split(),
    "fr": "le la les des du de et est une dans que qui pour sur pas au avec ce cette il elle ils nous vous je se plus mais ou où leur leurs été sont était avait avant près ont fait comme tout tous très sans même aussi aux par puis alors après encore ses chez d'un d'une qu'un qu'une c'est c'était j'ai toujours parce jamais rien quand pourquoi voici voilà donc car a en un y d'une l'on qu'on n'a".split(),
    "de": "der die das und ist nicht ein eine einen einem einer eines den dem des zu mit sich auf für von im als auch es an werden aus er hat dass sie nach wird bei noch wie über nur war wir ich ihr ihre sein seine aber oder zum zur doch schon wenn weil denn warum hier gibt mehr sehr vor durch dann jetzt immer niemand etwa dafür wieder unter ohne gegen dieser diese dieses".split(),
    "es": "el los las una unos unas del que y en con por para es son fue está estaba había pero como más su sus al lo le se ya muy sin sobre este esta estos esto cuando también hasta hay donde quien desde todo todos nos durante uno ni contra otros ese eso ante ellos mi qué cómo nadie antes después mientras porque aunque luego casi cerca además siempre nunca todavía según a de un no me te nada algo tan".split(),
}
#: Canonical codes of the spellings seen in language columns; a region suffix is cut off first.
SPELLINGS = {
    "en": "en eng english anglais englisch inglés ingles".split(),
    "fr": "fr fra fre french français francais französisch francés".split(),
    "de": "de deu ger german deutsch allemand alemán".split(),
    "es": "es spa spanish español espanol espagnol spanisch castellano".split(),
}
#: word -> the languages that list it; OWNER has the words of a single language.
LANGUAGES: dict[str, tuple[str, ...]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in dict.fromkeys(_words):
        LANGUAGES[_w] = (*LANGUAGES.get(_w, ()), _lang)
OWNER = {w: langs[0] for w, langs in LANGUAGES.items() if len(langs) == 1}
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
ORDER = ("en", "fr", "de", "es")


def hits(words: list[str]) -> dict[str, int]:
    """Function-word hits of each language among lower-case words, only words of a single language."""
    out = dict.fromkeys(ORDER, 0)
    for w in words:
        owner = OWNER.get(w)
        if owner:
            out[owner] += 1
        elif "'" in w and (owner := OWNER.get(w.partition("'")[2])):
            out[owner] += 1
    return out


def guess_words(words: list[str], least: int = 2) -> str | None:
    """Language with the most function words; None under *least* hits or on a tie."""
    found = hits(words)
    best = sorted(found.values())
    if best[-1] < least or best[-1] == best[-2]:
        return None
    return max(found, key=found.get)


def guess(text: str, least: int = 2) -> str | None:
    """guess_words for a text."""
    return guess_words(WORD.findall((text or "").lower().replace("’", "'")), least)


def canonical(column: Column) -> Column:
    """Two-letter code of a language column; null for null, blank and unknown spellings."""
    head = F.regexp_extract(F.lower(F.trim(column)), r"^([^\s_-]+)", 1)
    pairs = [F.lit(x) for code, names in SPELLINGS.items() for name in names for x in (name, code)]
    return F.element_at(F.create_map(*pairs), head)


class CharacterModel:
    """Languages told by the runs of three letters in their words; texts unlike all of them are OTHER.

    Fitted on texts whose language function words tell, with the function words themselves as
    a base. Every language counts as equally long, so that one with few texts is not favoured.
    """

    OTHER = "other"
    LENGTH, SMOOTH, KINDS = 20_000.0, 0.5, 20_000
    #: Runs of letters under which nothing is said, margin to the next language, and spreads from the usual at which a text is OTHER.
    LEAST, MARGIN, UNLIKE = 12, 0.2, 4.0

    def __init__(self, texts: list[str]):
        self.fit_runs(self.runs(texts))
        self.fit_usual(self.stretches(texts))

    @classmethod
    def runs(cls, texts: Iterable[str]) -> dict[str, Counter]:
        """How often each run of letters stands in the texts of each language; those of several parts add up."""
        words: dict[str, Counter] = {c: Counter() for c in ORDER}
        for text in texts:
            if owner := guess_words(found := WORD.findall(text.lower().replace("’", "'"))):
                words[owner].update(found)
        out: dict[str, Counter] = {c: Counter() for c in ORDER}
        for c in ORDER:
            for w, n in words[c].items():
                for g in cls.grams(w):
                    out[c][g] += n
        return out

    def fit_runs(self, runs: dict[str, Counter]) -> None:
        """Takes the runs of all texts, beside those of the function words."""
        counts = {c: Counter(g for w in FUNCTION_WORDS[c] for g in self.grams(w)) + runs[c] for c in ORDER}
        total = {c: sum(n.values()) for c, n in counts.items()}
        bottom = self.LENGTH + self.SMOOTH * self.KINDS
        self.unseen = np.full(len(ORDER), np.log(self.SMOOTH / bottom))
        self.seen: dict[str, np.ndarray] = {}
        for k, c in enumerate(ORDER):
            for g, n in counts[c].items():
                self.seen.setdefault(g, self.unseen.copy())[k] = np.log((n * self.LENGTH / total[c] + self.SMOOTH) / bottom)
        self.forget()

    def stretches(self, texts: Iterable[str]) -> np.ndarray:
        """For each language, how many stretches of ten words its texts have, and the sums of their scores and of their squares; those of several parts add up."""
        out = np.zeros((len(ORDER), 3))
        for text in texts:
            words = WORD.findall(text.lower().replace("’", "'"))
            if not (owner := guess_words(words)):
                continue
            k = ORDER.index(owner)
            at = self.numbers(words)  # first, as it may grow the table
            rows = self.table[at]
            sums = np.add.reduceat(rows[:, [0, 1 + k]], np.arange(0, len(rows), 10))
            sums = sums[sums[:, 0] >= self.LEAST]
            means = sums[:, 1] / sums[:, 0]
            out[k] += len(means), means.sum(), (means**2).sum()
        return out

    def fit_usual(self, stretches: np.ndarray) -> None:
        """Takes what stretches of ten words of each language usually score."""
        self.usual = np.full((len(ORDER), 2), np.nan)
        for k, (n, total, squares) in enumerate(stretches):
            if n >= 5:
                self.usual[k] = total / n, max(0.35, max(0.0, squares / n - (total / n) ** 2) ** 0.5)
        if np.isnan(self.usual).all():
            self.usual[:] = -9.0, 0.5
        self.usual = np.where(np.isnan(self.usual), np.nanmean(self.usual, axis=0), self.usual)

    @staticmethod
    def grams(word: str) -> list[str]:
        marked = f"<{word}>"
        return [marked[k : k + 3] for k in range(len(marked) - 2)]

    def numbers(self, words: list[str]) -> np.ndarray:
        """A number under 2**20 for each word, rows of self.table; those of one call fit together."""
        if len(self.cache) + len(words) > 1 << 20 and len(self.cache) > len(words):
            self.forget()  # memory stays bounded
        found = list(map(self.cache.get, words))
        if None in found:
            found = [self._number(w) if k is None else k for k, w in zip(found, words)]
        return np.array(found, dtype=np.int64)

    def _number(self, word: str) -> int:
        k, grams = self.cache.get(word, len(self.cache)), self.grams(word)
        if k >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[k, 0] = len(grams)
        self.table[k, 1:] = sum((self.seen.get(g, self.unseen) for g in grams), np.zeros(len(ORDER)))
        self.cache[word] = k
        return k

    def forget(self) -> None:
        """Drops what was kept of words seen."""
        self.cache, self.table = {}, np.zeros((1024, 1 + len(ORDER)))

    def sums(self, words: list[str]) -> np.ndarray:
        """Runs of letters in *words*, then the sum of their log probabilities in each language."""
        at = self.numbers(words)  # first, as it may grow the table
        return self.table[at].sum(0)

    def unlike(self, sums: np.ndarray) -> np.ndarray:
        """For each language, how many spreads below its usual score the words are."""
        return (self.usual[:, 0] - sums[1:] / max(1.0, sums[0])) / self.usual[:, 1]

    def guesses(self, sums: np.ndarray) -> list[str | None]:
        """For each row of sums the language of its words, OTHER, or None where too little tells."""
        runs, at = np.maximum(1.0, sums[:, 0]), np.arange(len(sums))
        means = sums[:, 1:] / runs[:, None]
        best = means.argmax(1)
        top, (usual, spread) = means[at, best], self.usual[best].T
        # the longer a text, the less its mean strays
        other = (usual - top) / spread > self.UNLIKE * np.clip(np.sqrt(50 / runs), 0.5, 1.0)
        means[at, best] = -np.inf
        told = top - means.max(1) >= self.MARGIN
        names = (*ORDER, self.OTHER, None)
        return [names[k] for k in np.where(sums[:, 0] < self.LEAST, len(ORDER) + 1, np.where(other, len(ORDER), np.where(told, best, len(ORDER) + 1))).tolist()]

    def guess(self, sums: np.ndarray) -> str | None:
        """guesses for one row."""
        return self.guesses(sums[None])[0]

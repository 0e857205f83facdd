"""Problem 1: defective prompt and response pairs.

The response is cut into clauses. A conditional random field tags every clause as answer,
refusal, echo, foreign or unfinished from the clause's hashed words and word pairs, its
overlap with the prompt, its place, how the response ends and how like the expected language
its letters are; the share of the response that each tag covers decides on the pair's defect.
A copy is then checked word by word, and a language by the whole response. The field is
fitted on pairs made from all prompts, whose defects are known because they were put there:
cut off, refused, echoed or swapped for another language. The letters of the languages are
counted over all prompts. The prompts fall by the hash of their id into shards of at most about
SHARD, each shard trains a field on all of its prompts in batches, and the field is the mean
of the shards' weights by their prompts (distributed training of a convex likelihood by
mixture weights). It is a plain value (Field) that can be stored and given to defects() again.

Defined results: null, blank and placeholder responses are empty; without a prompt or with
a language that cannot be told, no language defect is given; null instructions are as
empty ones; repeated rows count once per id; responses of any length are tagged whole.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glosswright.llm import lang, made_pairs
from glosswright.llm.crf import Batch, ChainCRF, Sparse, stretch_sums
from glosswright.runtime import cut, spread

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
DEFECT = {REFUSAL: "refusal", ECHO: "copy", FOREIGN: "language", UNFINISHED: "truncated"}
#: Prompts of a batch and of a shard, about; steps of a shard's fit, at least. Every prompt is in one batch of one shard.
BATCH = 150
SHARD = 1_500
STEPS = 130
#: Tasks among which the shards are divided.
TASKS = 2_000
LEAD_IN_WORDS = 8
#: Characters of the pairs whose features are made at once; their words stay under the numbers that CharacterModel.numbers gives. A longer pair is alone.
BULK = 1_000_000
#: Hashed features of a clause, and clauses of a training chain; longer responses train as several chains.
BITS = 14
CHAIN = 40

WORDS = re.compile(r"\w+(?:['’]\w+)*").findall
DIRECTION = re.compile(r"\[[^\[\]\n]*\]|\([^()\n]*\)|<[^<>\n]*>|[♪♫][^♪♫\n]*[♪♫]")
LABEL = re.compile(r"^[^\S\n]*[A-Z][A-Z .]{2,}:[^\S\n]*", re.M)
MARKER = re.compile(r"<{2,3}[^<>\n]*>{2,3}|```\w*|^[^\S\n]*#+[^\S\n]*$", re.M)
PLACEHOLDERS = {"", "na", "n a", "none", "null", "nil", "nan", "empty", "no output", "no answer", "no response", "no content", "undefined", "tbd", "todo", "blank", "leer", "keine", "vide", "aucun", "aucune", "vacio", "ninguno", "nada", "output", "response", "answer", "text"}
STOPS = ".!?…。！？｡"
QUOTES_BEGIN, QUOTES_END = "\"“«„「『", "\"”»“」』"
BRACKETS = {"]": "[", ")": "(", ">": "<", "）": "（", "】": "【"}
#: A clause ends after closing punctuation before white space, at a line end after a mark, at an empty line, or after a full-width stop.
BREAK = re.compile(r"(?<=[.!?…])[\"'”’»)]*\s+|(?<=[。！？｡])[」』”]*\s*|(?<=[:;\"”»)\]])\s*\n\s*|\n\s*\n\s*")
#: BREAK for texts without full-width stops: it can only begin at these characters, which are found faster than places behind a stop.
HALF_BREAK = re.compile(r"""[\s"'”’»)](?:(?<=[.!?…]\s)\s*|(?<=[.!?…]["'”’»)])["'”’»)]*\s+|(?<=[:;"”»)\]]\n)\s*|(?<=[:;"”»)\]]\s)\s*\n\s*|(?<=\n)\s*\n\s*)""")
FULL_STOP = re.compile("[。！？｡]")
ASKED = [
    (c, re.compile(rf"\b(?:{names})\b"))
    for c, names in (
        ("en", "english|englisch|anglais|ingles"), ("fr", "french|franzosisch|francais|frances"), ("de", "german|deutsch|allemand|aleman"), ("es", "spanish|spanisch|espagnol|espanol|castellano"),
        (lang.CharacterModel.OTHER, "italian|italiano|italienisch|portuguese|portugues|dutch|polish|russian|chinese|japanese|korean|arabic|turkish|swedish"),
    )
]


def plain(text: str) -> str:
    """Lower case without accents, straight apostrophes."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower().replace("’", "'")) if not unicodedata.combining(c))


_WORD = re.compile(r"\w+(?:['’]\w+)*")
SPECIAL = re.compile(r"[\[(<♪♫`#]")
SMALL = re.compile(r"(?<![\w'’])\w*[a-zà-öø-ÿ]\w*")


def is_empty(output: str | None) -> bool:
    """No content: blank, bare markers and directions, or a placeholder."""
    if not output:
        return True
    special = SPECIAL.search(output)
    # three words with small letters before any mark: neither marker, direction nor label can hold them
    if sum(1 for _ in islice(SMALL.finditer(output, 0, special.start() if special else len(output)), 3)) == 3:
        return False
    bare = LABEL.sub("", DIRECTION.sub(" ", MARKER.sub(" ", output)) + "\n")
    words: list[str] = []
    for m in _WORD.finditer(bare):
        words += WORDS(plain(m.group()))
        if len(words) > 2:
            return False  # no placeholder has so many
    return " ".join(words) in PLACEHOLDERS


def _before_direction(text: str) -> str:
    """*text* without the stage direction in brackets that it ends with."""
    opening = BRACKETS.get(text[-1:])
    at = text.rfind(opening, 0, len(text) - 1) if opening else -1
    if at < 0 or text[-1] in text[at + 1 : -1] or "\n" in text[at:]:
        return text
    return text[:at]


def _before_link(text: str) -> str:
    """*text* without the link that it ends with and the one or two words that announce it."""
    last = text.rsplit(None, 1)[-1] if text else ""
    if not re.match(r"https?://.|www\..", last):
        return text
    text = text[: len(text) - len(last)].rstrip()
    for _ in range(2):
        tail = text.rsplit(None, 1)[-1] if text else ""
        m = re.search(r"\w+:?$", tail)
        if not m:
            break
        text = text[: len(text) - len(m.group())].rstrip()
    return text


def ended(output: str) -> bool:
    """Whether the response stops after a whole sentence, directions, links and emoji aside."""
    text = output
    while True:
        before = text
        text = text.rstrip()
        if text[-1:] and text[-1] in STOPS:
            return True
        size = len(text)
        while size and (text[size - 1].isspace() or unicodedata.category(text[size - 1]) in ("So", "Sk", "Cf", "Mn") or text[size - 1] in "♪♫*_~"):
            size -= 1
        text = _before_link(_before_direction(text[:size]))
        if text == before:
            break
    if not text:
        return True
    if text.rstrip("\"'”’»)]*_」』）")[-1:] in tuple(STOPS):
        return True
    if text[-1] in QUOTES_END:
        at = max(text.rfind(q, 0, len(text) - 1) for q in set(QUOTES_BEGIN + QUOTES_END))
        return 0 <= at < len(text) - 2 and text[at] in QUOTES_BEGIN
    return False


def clauses(output: str) -> list[str]:
    """Sentences and lines of the response that hold a word; labels and directions are dropped."""
    text = LABEL.sub("", output) if ":" in output else output
    if any(c in text for c in "<`#"):
        text = MARKER.sub(" ", text)
    if any(c in text for c in "[(<♪♫"):
        text = DIRECTION.sub(" ", text)
    return [c.strip() for c in (BREAK if FULL_STOP.search(text) else HALF_BREAK).split(text) if any(map(str.isalnum, c))]


@lru_cache(maxsize=4_000)
def _words(clause: str) -> list[str]:
    """The words of a clause in lower case; made pairs say a prompt's clauses again and again."""
    return WORDS(clause.lower())


@lru_cache(maxsize=10_000)
def _asked(instruction: str) -> tuple[tuple[str, ...], str | None]:
    """Words of an instruction, and the language it names last."""
    request, words = plain(instruction), WORDS(instruction.lower())
    named = [(m.start(), c) for c, p in ASKED for m in p.finditer(request)]
    return tuple(words), max(named)[1] if named else None


def _bucket(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key) >> (64 - BITS)


@lru_cache(maxsize=400_000)
def _word_bucket(word: str) -> int:
    return _bucket(plain(word))


def _hashed(one: np.ndarray, clause: np.ndarray, clauses: int) -> Sparse:
    """Buckets of each clause's words, pairs and pairs with a gap; *one* has the words' buckets, *clause* numbers their clauses."""
    n, mask = len(one), (1 << BITS) - 1
    index, there = np.zeros((n, 3), dtype=np.int64), np.ones((n, 3), dtype=bool)
    if n:
        index[:, 0] = one
        index[1:, 1] = (one[:-1] * 40_503 + one[1:] * 2_654_435_761 + 1) >> 3 & mask
        index[2:, 2] = (one[:-2] * 48_271 + one[2:] * 2_246_822_519 + 7) >> 4 & mask
        there[:1, 1] = there[:2, 2] = False
        there[1:, 1] = clause[:-1] == clause[1:]
        there[2:, 2] = clause[:-2] == clause[2:]
    counts = np.bincount(clause, weights=there.sum(1), minlength=clauses).astype(np.int64)
    return index[there], np.repeat(2.0 / np.sqrt(np.maximum(counts, 1)), counts), counts


class Pair:
    """One pair, its clauses and their features."""

    def __init__(self, input_text: str | None, instruction: str | None, output: str, letters: lang.CharacterModel):
        self.source, self.request, self.output = input_text or "", instruction or "", output
        _describe([self], letters)

    @classmethod
    def many(cls, rows: Iterable[tuple[str | None, str | None, str]], letters: lang.CharacterModel) -> list[Pair]:
        """A pair for each (input_text, instruction, output); features are made of BULK characters at once."""
        out: list[Pair] = []
        bulk, size = 0, 0
        for source, request, output in rows:
            pair = cls.__new__(cls)
            pair.source, pair.request, pair.output = source or "", request or "", output
            own = len(pair.source) + len(pair.request) + len(output)
            if size + own > BULK and bulk < len(out):
                _describe(out[bulk:], letters)
                bulk, size = len(out), 0
            out.append(pair)
            size += own
        if bulk < len(out):
            _describe(out[bulk:], letters)
        return out

    def cover(self, tags: np.ndarray) -> np.ndarray:
        """Share of the response's words under each tag."""
        sizes = np.maximum(self.sizes, 1)
        return np.bincount(tags, weights=sizes, minlength=len(TAGS)) / sizes.sum()

    def defect(self, tags: np.ndarray) -> str | None:
        """The pair's defect by the share of words each tag covers."""
        if not len(tags):
            return "empty"
        cover = self.cover(tags)
        if cover[REFUSAL] >= 0.5 or tags[0] == REFUSAL and cover[REFUSAL] >= 0.34:
            return DEFECT[REFUSAL]
        if cover[ECHO] >= 0.5:
            return DEFECT[ECHO] if self.is_copy() else None if ended(self.output) else DEFECT[UNFINISHED]
        if cover[FOREIGN] > 0.5 and self.spoken and self.spoken != self.expected:
            return DEFECT[ECHO] if self.is_copy() else DEFECT[FOREIGN]
        return DEFECT[UNFINISHED] if tags[-1] == UNFINISHED else None

    def is_copy(self) -> bool:
        """Exact check: the words are those of input, instruction or both, after a short lead-in."""
        words = WORDS(self.output.lower())
        request = list(self.request_words)
        ways = [self.source_words, request, request + self.source_words, self.source_words + request]
        return any(w and words[len(words) - len(w) :] == w and 0 <= len(words) - len(w) <= LEAD_IN_WORDS for w in ways)


N_FEATURES = 20


def _held(words: np.ndarray, begin: list[int], end: list[int], owner: list[int], of_owner: list[np.ndarray], size: int) -> np.ndarray:
    """Whether each word of a pair, from begin to end, is one of its owner's; words are numbers under *size*."""
    mark, out = np.zeros(size, dtype=bool), np.zeros(len(words), dtype=bool)
    for o, run in groupby(range(len(owner)), owner.__getitem__):
        run = list(run)
        a, b = begin[run[0]], end[run[-1]]
        mark[of_owner[o]] = True
        out[a:b] = mark[words[a:b]]
        mark[of_owner[o]] = False
    return out


def _describe(pairs: list[Pair], letters: lang.CharacterModel) -> None:
    """Gives the pairs their clauses and features; what they hold does not depend on the pairs beside them.

    Clauses, inputs and instructions that stand several times are looked up once.
    """
    kinds, sources, requests = {}, {}, {}
    for p in pairs:
        p.texts = clauses(p.output)
    kind = np.array([kinds.setdefault(c, len(kinds)) for p in pairs for c in p.texts], dtype=np.int64)
    source_of = [sources.setdefault(p.source, len(sources)) for p in pairs]
    request_of = [requests.setdefault(p.request, len(requests)) for p in pairs]
    clause_words = [_words(c) if len(c) < 1_000 else WORDS(c.lower()) for c in kinds]
    source_words = [WORDS(s.lower()) for s in sources]
    asked = [_asked(r) for r in requests]
    listed = [*clause_words, *source_words, *(a[0] for a in asked)]
    length = np.array(list(map(len, listed)))
    edge = np.concatenate([[0], np.cumsum(length)])
    flat = list(chain.from_iterable(listed))
    numbers = letters.numbers(flat)
    looked = stretch_sums(letters.table[numbers].T, length)
    bucket = np.fromiter(map(_word_bucket, flat[: edge[len(kinds)]]), dtype=np.int64, count=edge[len(kinds)])

    n_clauses = np.array([len(p.texts) for p in pairs])
    last = np.cumsum(n_clauses)
    first = last - n_clauses
    sizes = length[kind]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    begin, end = ends[first].tolist(), ends[last].tolist()  # of each pair's words
    at = np.repeat(edge[kind] - ends[:-1], sizes) + np.arange(ends[-1])
    words = numbers[at]

    def grams(x: np.ndarray, a: list[int], b: list[int]) -> Iterator[set[int]]:
        """The stretches of three words from each a to its b, or all words of fewer, as whole numbers."""
        threes = (x[:-2] << 40 | x[1:-1] << 20 | x[2:]).tolist()
        for i, j in zip(a, b):
            yield set(threes[i : j - 2]) if j - i > 2 else {-1 - sum(k << 20 * m for m, k in enumerate(x[i:j].tolist()))} if j > i else set()

    # of each input, then of each instruction
    a, b = edge[len(kinds) : -1].tolist(), edge[len(kinds) + 1 :].tolist()
    own_words, own_grams = [numbers[i:j] for i, j in zip(a, b)], list(grams(numbers, a, b))
    n = len(sources)
    guesses = letters.guesses(looked[:, len(kinds) : len(kinds) + n].T)
    sums = looked[:, kind]
    of_pairs: list[tuple[float, ...]] = []
    own = np.full(len(pairs), -1)  # the expected language, of those known
    for k, (p, s, r, mine, speaks) in enumerate(zip(pairs, source_of, request_of, grams(words, begin, end), letters.guesses(stretch_sums(sums, n_clauses).T))):
        p.source_words, (p.request_words, named) = source_words[s], asked[r]
        both = len(own_grams[s] & mine)
        copied = both / max(1, len(own_grams[s])) * (both / max(1, len(mine)))
        of_request = own_grams[n + r]
        # the language the instruction names, else that of the input
        p.expected, p.spoken = named or guesses[s], speaks
        strange = float(bool(p.expected and speaks and speaks != p.expected))
        of_pairs.append((1.0, float(len(p.texts) == 1), copied, len(of_request & mine) / max(1, len(of_request)), float(copied > 0.9), 3.0 * strange, 3.0 * (strange and speaks == letters.OTHER)))
        if p.expected in lang.ORDER:
            own[k] = lang.ORDER.index(p.expected)
    many = np.maximum(1, sizes)
    in_source, in_request = (stretch_sums(_held(words, begin, end, owner, held, len(letters.table)).astype(float), sizes) / many for owner, held in ((source_of, own_words[:n]), (request_of, own_words[n:])))
    n = len(sizes)
    own = np.repeat(own, n_clauses)
    known = own >= 0
    mean, weight = (sums[1:] / np.maximum(1.0, sums[0])), np.minimum(1.0, sums[0] / 40)
    expected = mean[own, np.arange(n)]
    unlike = np.where(known, weight * np.clip((letters.usual[own, 0] - expected) / letters.usual[own, 1], -2.0, 6.0), 0.0)
    lead = np.where(known, weight * np.minimum(4.0, mean.max(0) - expected), 0.0)
    whole = np.repeat(np.array([ended(p.output) for p in pairs], dtype=float), n_clauses)
    opens, closes = np.zeros(n), np.zeros(n)
    opens[first[n_clauses > 0]] = closes[last[n_clauses > 0] - 1] = 1.0
    told = np.repeat(np.array(of_pairs), n_clauses, axis=0)
    features = np.empty((n, N_FEATURES))
    features[:, : told.shape[1]] = told
    columns = (
        in_source, in_request, 1.0 - in_source, (in_request > 0.9) & (told[:, 3] > 0.9), unlike / 2, lead, lead > 0.5, unlike > 2.5,
        opens, closes, closes * (1.0 - whole) * 4.0, closes * whole, np.minimum(many, 30) / 15,
    )
    for k, column in enumerate(columns, told.shape[1]):
        features[:, k] = column
    # what is taken from the prompt says nothing by its words
    speak = np.repeat(np.maximum(in_source, in_request) < 0.9, sizes)
    index, value, counts = _hashed(bucket[at[speak]], np.repeat(np.arange(n), sizes)[speak], n)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for p, a, b, i, j in zip(pairs, first.tolist(), last.tolist(), ends[first].tolist(), ends[last].tolist()):
        p.sizes, p.features, p.sparse = sizes[a:b], features[a:b], (index[i:j], value[i:j], counts[a:b])


@dataclass
class Field:
    """What defects() needs: the random field and the model of the languages' letters."""

    crf: ChainCRF
    letters: lang.CharacterModel


#: What a space becomes in an echo.
GAPS = [" ", " ", "\n", "  "]


def gaps(rng: random.Random, n: int) -> list[str]:
    """n times rng.choice(GAPS), of the same random bits."""
    out: list[str] = []
    while len(out) < n:
        k = rng.getrandbits(3)
        if k < 4:
            out.append(GAPS[k])
    return out


def training_pairs(prompts: list[tuple[str, str]], letters: lang.CharacterModel, seed: int = 7) -> list[tuple[Pair, list[int]]]:
    """Pairs with known clause tags, made from (input, instruction) prompts."""
    rng = random.Random(seed)
    rows: list[tuple[str, str, str]] = []
    tagged: list[tuple[int, list[int], bool, int]] = []  # of each row: its clauses' tag, the tags of its last ones, whether its words count, how many clauses it must have
    words = [WORDS(source.lower()) for source, _ in prompts]
    spoken = letters.guesses(np.array([letters.sums(w) for w in words]).reshape(len(words), -1))
    parts_of = lru_cache(maxsize=None)(clauses)
    by_language: dict[str, list[str]] = {}
    for (source, _), own in zip(prompts, spoken):
        by_language.setdefault(own or "", []).append(source)

    def add(source: str, request: str, output: str, tag: int, last: int | None = None, with_words: bool = True) -> None:
        rows.append((source, request, output))
        tagged.append((tag, [] if last is None else [last], with_words, 0))

    for (source, request), own in zip(prompts, spoken):
        parts = parts_of(source)
        if not parts:
            continue
        some = [p for p in parts if rng.random() < 0.6] or parts[:1]
        if len(parts) > 1 and len(some) == len(parts):
            some = some[:-1]
        lines = [f"NARRATOR: {p}" for p in some]
        extra = [x for p in some for x in ([p, "For example, " + rng.choice(parts_of(rng.choice(by_language[own or ""])) or [p])] if rng.random() < 0.5 else [p])]
        if len(parts) > 1:
            add(source, request, rng.choice(["", "Briefly: "]) + " ".join(some) + rng.choice(["", " (laughs)", " 🙂", " See https://x.example/a1"]), ANSWER)
            add(source, request, "\n".join([*lines, *rng.choice([[], ["[Pause]"]])]), ANSWER)
        add(source, request, " ".join(extra) + " " + extra[0], ANSWER)
        one = rng.choice(parts)
        add(source, request, rng.choice([one, f"Briefly: {one[0].lower()}{one[1:]}", f"In short, {one[0].lower()}{one[1:]}"]), ANSWER)
        body = rng.choice([" ".join(some), "\n".join(lines), " ".join(extra)])
        words = body.split(" ")
        if len(words) > 6:
            at = rng.randrange(len(words) // 2, len(words) - 1)
            piece = " ".join(words[:at])
            piece = rng.choice([piece.rstrip(".!?…:;\"”»)") + rng.choice(["", ",", " and", " which"]), piece.rstrip(".!?…") + " " + words[at][: max(1, len(words[at]) // 2)].rstrip(".!?…")])
            if not ended(piece):
                add(source, request, piece, ANSWER, UNFINISHED)
        for _ in range(8):
            before, core, after = made_pairs.refusal(rng, rng.choice([*[own if own in made_pairs.REFUSAL else "en", "en"] * 2, *made_pairs.REFUSAL, *lang.ORDER]))
            add(source, request, " ".join(x for x in (before, core, after) if x), REFUSAL)
        # someone in the text declines something: no refusal, as the words are the prompt's
        told = rng.choice(["The baker refused to help and apologised later.", "They could not open the door that day.", "Nobody was allowed to edit the letter.", "She said she was sorry about the request."])
        add(f"{source} {told}", request, " ".join([*some, told]), ANSWER)
        for _ in range(3):
            head, *rest = source.split(" ")
            broken = head + "".join([gap + w for gap, w in zip(gaps(rng, len(rest)), rest)])
            echo = rng.choice([source, source.lower(), source.upper(), broken, re.sub(r"[^\w\s']", "", source), f'"{source}"', f"{request}\n{source}", request or source])
            add(source, request, rng.choice(made_pairs.LEAD_INS) + " " + echo, ECHO)
        others = [c for c in by_language if c in lang.ORDER and c != own]
        for strange in rng.sample(made_pairs.OTHER_LANGUAGES, 2) if own in lang.ORDER else ():
            foreign = parts_of(strange)
            # without their words: those of the next strange language will be new
            add(source, request, " ".join(rng.sample(foreign, rng.randrange(1, len(foreign) + 1))), FOREIGN, with_words=False)
        if own in lang.ORDER and others:
            other = rng.choice(others)
            there = parts_of(rng.choice(by_language[other]))[: rng.randrange(1, 8)]
            add(source, request, rng.choice([" ", "\n"]).join(there), FOREIGN, with_words=rng.random() < 0.5)
            ask = rng.choice(made_pairs.ASKS).format(made_pairs.ENGLISH_NAMES[other])
            asked = f"{request} {ask}"
            add(source, asked, rng.choice([" ", "\n"]).join(there), ANSWER)
            add(source, asked, rng.choice(there), ANSWER)
            # someone in the text declines something: no refusal of the task
            quoted = made_pairs.refusal(rng, other)[1]
            add(source, asked, " ".join([*there, made_pairs.SAID[other].format(quoted.rstrip(".!"))]), ANSWER)
            if len(there) > 1:
                add(source, asked, " ".join(there).rstrip(".!?…")[: -rng.randrange(3, 12)].rstrip(".!?…"), ANSWER, UNFINISHED)
            add(source, asked, rng.choice([" ".join(some), " ".join(extra), "\n".join(lines)]), FOREIGN)
            # a response that begins in one language and goes on in another
            mine, theirs = some[: rng.randrange(1, 3)], there[: rng.randrange(1, 5)]
            rows.append((source, request, " ".join([*mine, *theirs])))
            tagged.append((ANSWER, [FOREIGN] * len(theirs), True, len(mine) + len(theirs)))
    out = []
    for pair, (tag, last, with_words, must) in zip(Pair.many(rows, letters), tagged):
        n = len(pair.texts)
        if not n or must and n != must:
            continue
        if not with_words:
            pair.sparse = (pair.sparse[0][:0], pair.sparse[1][:0], np.zeros_like(pair.sparse[2]))
        out.append((pair, [tag] * (n - len(last)) + last))
    return out


def _batch(prompts: list[tuple[str, str]], letters: lang.CharacterModel, seed: int) -> Batch | None:
    """The pairs made from some prompts, laid out for the fit; None without any."""
    xs, tags, sparse = [], [], []
    for pair, t in training_pairs(prompts, letters, seed):
        if len(t) <= CHAIN:
            xs.append(pair.features)
            tags.append(np.array(t))
            sparse.append(pair.sparse)
            continue
        ends = np.concatenate([[0], np.cumsum(pair.sparse[2])])
        for a in range(0, len(t), CHAIN):
            b = min(len(t), a + CHAIN)
            xs.append(pair.features[a:b])
            tags.append(np.array(t[a:b]))
            sparse.append((pair.sparse[0][ends[a] : ends[b]], pair.sparse[1][ends[a] : ends[b]], pair.sparse[2][a:b]))
    return Batch(xs, tags, len(TAGS), sparse, 1 << BITS) if xs else None


def fit_shard(prompts: list[tuple[str, str]], letters: lang.CharacterModel, shard: int = 0) -> ChainCRF | None:
    """The random field, fitted on pairs made from each of the prompts; None without any."""
    n = max(1, round(len(prompts) / BATCH))
    bounds = [len(prompts) * k // n for k in range(n + 1)]
    made = [_batch(prompts[a:b], letters, 7 + shard * 1_000 + k) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    made = [b for b in made if b is not None]
    return ChainCRF.fit_batches(made, STEPS) if made else None


def train(prompts: list[tuple[str, str]], letters: lang.CharacterModel | None = None) -> Field | None:
    """The field, fitted in this process on pairs made from (input, instruction) prompts; None without any."""
    letters = letters or lang.CharacterModel([source for source, _ in prompts])
    crf = fit_shard(prompts, letters)
    return Field(crf, letters) if crf else None


def fit_letters(prompts: DataFrame) -> lang.CharacterModel:
    """The model of the languages' letters, counted over the input_text of all rows."""
    texts = prompts.select("input_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lang.CharacterModel.runs(t for batch in batches for t in batch.column(0).to_pylist())
        rows = [(c, g, n) for c, grams in found.items() for g, n in grams.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64()))], names=["language", "run", "n"])

    runs: dict[str, Counter] = {c: Counter() for c in lang.ORDER}
    # as many rows as there are runs of three letters in four languages
    for r in texts.mapInArrow(count, "language string, run string, n bigint").groupBy("language", "run").agg(F.sum("n").alias("n")).collect():
        runs[r.language][r.run] = r.n
    letters = lang.CharacterModel([])
    letters.fit_runs(runs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = letters.stretches(t for batch in batches for t in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(lang.ORDER), *(pa.array(c) for c in sums.T)], names=["language", "n", "total", "squares"])

    sums = texts.mapInArrow(score, "language string, n double, total double, squares double").groupBy("language").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).collect()
    by_language = {r.language: (r.n, r.total, r.squares) for r in sums}
    letters.fit_usual(np.array([by_language.get(c, (0.0, 0.0, 0.0)) for c in lang.ORDER]))
    letters.forget()  # workers fill their own
    return letters


def fit(entries: DataFrame) -> Field | None:
    """The field, fitted on pairs made from the prompts of all entries."""
    once = entries.where("input_text is not null").select("entry_id", "input_text", F.coalesce("instruction", F.lit("")).alias("instruction")).dropDuplicates(["entry_id"])
    prompts = cut(once)  # read three times
    n = prompts.count()
    if not n:
        return None
    letters = fit_letters(prompts)
    shards = -(-n // SHARD)
    h = F.xxhash64("entry_id")
    dealt = prompts.select("entry_id", "input_text", "instruction", F.pmod(h, F.lit(shards)).cast("int").alias("s"), h.alias("h"))
    dealt = dealt.repartitionById(min(shards, TASKS), F.pmod("s", F.lit(min(shards, TASKS)))).sortWithinPartitions("s", "h", "entry_id").select("s", "input_text", "instruction")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        total, seen = np.zeros(1), 0
        for s, group in groupby(rows, key=lambda r: r[0]):
            own = [r[1:] for r in group]
            if crf := fit_shard(own, letters, s):
                total, seen = total + len(own) * crf.weights(), seen + len(own)
        if seen:
            # place 0 has the prompts that count
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total) + 1)), pa.array(np.concatenate([[seen], total]))], names=["place", "value"])

    # a fixed number of rows, one for each weight
    sums = dealt.mapInArrow(run, "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").toArrow()
    if not sums.num_rows:
        return None
    value = sums.column("value").to_numpy()
    return Field(ChainCRF.from_weights(value[1:] / value[0], N_FEATURES, len(TAGS)), letters)


def defects(entries: DataFrame, model: Field | None) -> DataFrame:
    """(entry_id, defect, answer, refusal, echo, foreign, unfinished): defect is null for sound pairs."""
    data = spread(entries.select("entry_id", "instruction", "input_text", "output_text"))
    schema = T.StructType([data.schema["entry_id"], T.StructField("defect", T.StringType()), *[T.StructField(t, T.DoubleType()) for t in TAGS]])
    field = model or Field(ChainCRF(np.zeros((N_FEATURES, len(TAGS))), np.zeros((len(TAGS), len(TAGS)))), lang.CharacterModel([]))
    field.letters.forget()  # workers fill their own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                found: list[str | None] = []
                rows, places = [], []
                cover = np.zeros((batch.num_rows, len(TAGS)))
                for k, (request, source, output) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                    if is_empty(output):
                        found.append("empty")
                        continue
                    found.append(None)
                    rows.append((source, request, output))
                    places.append(k)
                pairs = Pair.many(rows, field.letters)
                for k, pair, tags in zip(places, pairs, field.crf.decode([p.features for p in pairs], [p.sparse for p in pairs])):
                    found[k] = pair.defect(tags)
                    if len(tags):
                        cover[k] = pair.cover(tags)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.string()), *(pa.array(c) for c in cover.T)], names=schema.names)

    return data.mapInArrow(run, schema).dropDuplicates(["entry_id"])

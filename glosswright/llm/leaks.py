"""Problem 9: passages of held-out items inside a corpus.

The items, normalised to words, make one generalised suffix automaton. Every document is
streamed through it; where its current longest match ends, a match that is long, or short
but rare among the items, is an anchor. An anchor is extended word by word on both sides
over small slips; items of which MIN_WORDS words in sequence are covered have leaked. The
stretches of the document that hold them can be removed (cleaned): those over a length limit
are cut out, and a document of which they cover more than a limit is dropped.

The automaton grows with the items, not with the corpus: it is built once per Python
worker from the item texts, which must stay under MAX_ITEM_CHARS (else the items are
taken in slices, one pass over the corpus each; what is rare is counted over all items).

Defined results: null and empty texts hold nothing; an item under MIN_WORDS words cannot
leak; repeated items and documents give one row per (doc_id, item_id); texts of any length
are streamed whole.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glosswright.runtime import if_small, spread

MIN_WORDS = 20
#: A run of LONG words is an anchor; so is one of SHORT words that at most RARE places of the items share.
LONG, SHORT, RARE = 8, 5, 8
MAX_ITEM_CHARS = 20_000_000
#: Removal: spans of so many words go; documents of which more than this share leaked go whole.
LONGEST, COVERAGE = 20, 0.5

#: Letters of other scripts that look like Latin ones.
LOOK_ALIKES = str.maketrans("аеорсухіјѕһԁԛԝвкмнтгαορνκιτυχеӏɡɑＯ", "aeopcyxijshdqwbkmhtraopvkituxelgao")
#: A tag of any length; a smaller-than sign before a digit or a space begins none.
TAG = re.compile(r"<[/!?]?[^\W\d_][^<>\n]*>|<!--[^<>]*>")
TIME = re.compile(r"[\[(]?\b\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?\b[\])]?")
HYPHEN = re.compile(r"(?<=[^\W\d_])(?:­\s*|[-‐‑]\s*\n\s*|- +(?=[a-zß-ÿ]))(?=[^\W\d_])")
INVISIBLE = re.compile("[­​-‏⁠﻿]")
WORDS = re.compile(r"[^\W_]+").findall


def _fold(unit: str) -> tuple[str, ...]:
    """Words of a text without spaces: lower case, look-alikes and accents folded."""
    if not unit.isascii():
        unit = unicodedata.normalize("NFKD", unit).lower()
        latin = sum("a" <= c <= "z" for c in unit)
        if latin or all(ord(c) in LOOK_ALIKES or not c.isalpha() for c in unit):
            unit = unit.translate(LOOK_ALIKES)
        unit = "".join(c for c in unit if not unicodedata.combining(c))
    return tuple(WORDS(unit.lower()))


class _Folded(dict):
    def __missing__(self, unit: str) -> tuple[str, ...]:
        value = _fold(unit)
        if len(unit) <= 40 and len(self) < 400_000:
            self[unit] = value
        return value


def _bare(text: str) -> str:
    """*text* without markup, inserted times, hyphenation at line ends and invisible characters."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = TAG.sub(" ", text)
    if ":" in text:
        text = TIME.sub(" ", text)
    if not text.isascii():
        if HYPHEN.search(text):
            text = HYPHEN.sub("", text)
        text = INVISIBLE.sub("", text)
    elif "-" in text:
        text = HYPHEN.sub("", text)
    return text


def normal_words(text: str, cache: dict | None = None) -> list[str]:
    """Words of *text* without markup, inserted times, hyphenation at line ends and invisible characters."""
    fold = cache if cache is not None else _Folded()
    return [w for unit in _bare(text).split() for w in fold[unit]]


def without_spans(text: str, spans: list[tuple[int, int]], cache: dict) -> str:
    """*text*, freed from markup, without the words of *spans* (first, last); the white space that is left stays as it is."""
    text, out, at, n, k = _bare(text), [], 0, 0, 0
    for m in re.finditer(r"\S+", text):
        size = len(cache[m.group()])
        while k < len(spans) and spans[k][1] < n:
            k += 1
        if size and k < len(spans) and spans[k][0] <= n + size - 1:
            out.append(text[at : m.start()])
            at = m.end()
        n += size
    return "".join([*out, text[at:]])


class SuffixAutomaton:
    """Generalised over sequences of word numbers; states know the places where their longest string ends."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.own = [-1], [0], [[]]
        for item, sequence in enumerate(sequences):
            last = 0
            for at, w in enumerate(sequence):
                last = self._extend(last, w)
                self.own[last].append((item, at))
        children: list[list[int]] = [[] for _ in self.link]
        for s, parent in enumerate(self.link):
            if parent >= 0:
                children[parent].append(s)
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.count = [len(o) for o in self.own]
        for s in reversed(order):
            if self.link[s] >= 0:
                self.count[self.link[s]] += self.count[s]
        self.children = children

    def _extend(self, last: int, w: int) -> int:
        following, link, length = self.next, self.link, self.length
        if w in following[last]:
            q = following[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, w, q)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and w not in following[p]:
            following[p][w] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = following[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        self.own.append([])
        return len(self.link) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def places(self, state: int) -> list[tuple[int, int]]:
        """(sequence, end) of every occurrence of the state's strings."""
        out, todo = [], [state]
        while todo:
            s = todo.pop()
            out += self.own[s]
            todo += self.children[s]
        return out


def similar(a: str, b: str) -> bool:
    """Equal but for a slip: one edit or swap, two neighbouring ones in long words."""
    if a == b:
        return True
    if a[0] != b[0] and a[-1] != b[-1]:
        return False  # a single slip leaves one end as it is
    n, m = len(a), len(b)
    if abs(n - m) > 2 or min(n, m) < 3:
        return False
    i = 0
    while i < n and i < m and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and j < m - i and a[n - 1 - j] == b[m - 1 - j]:
        j += 1
    rest = max(n, m) - i - j
    if rest <= 1 or rest == 2 and n == m and a[i] == b[i + 1] and a[i + 1] == b[i]:
        return True
    return rest <= 2 and min(n, m) >= 7


def _garbled(a: str, b: str) -> bool:
    """Whether one word may be the other, badly misspelt: most letters agree, in order, from both ends."""
    if (a[0] != b[0] and a[-1] != b[-1]) or min(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 3:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return (i + j) >= 0.6 * max(len(a), len(b))


def _extend_side(doc: list[str], item: list[str], d: int, i: int, step: int) -> tuple[int, int]:
    """Item words covered beyond (d, i) in direction *step*, and the last document place reached."""
    nd, ni = len(doc), len(item)
    covered, reached, pending, run, errors = 0, d, 0, 99, 0
    while True:
        d += step
        i += step
        if not (0 <= d < nd and 0 <= i < ni):
            break
        x, y = doc[d], item[i]
        if x == y or ((x[0] == y[0] or x[-1] == y[-1]) and similar(x, y)):
            covered += 1 + pending
            pending, reached, run = 0, d, run + 1
            continue
        # slips stand alone: at least two words after the last one, and the words after this one must agree again
        if run < 2 or errors > 1 + (covered + run) // 5:
            break
        best = None
        garbled = (x[0] == y[0] or x[-1] == y[-1]) and _garbled(x, y)
        for skip_d, skip_i in ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2)):
            # (0, 0): one word badly misspelt; else words added to the document or lost from the item.
            # A word in another's place is no slip: texts of one pattern differ in just that way.
            if skip_d == skip_i and not garbled:
                continue
            a, b = (d + step, i + step) if (skip_d, skip_i) == (0, 0) else (d + skip_d * step, i + skip_i * step)
            if not (0 <= a < nd and 0 <= b < ni):
                continue
            x, y = doc[a], item[b]
            if x != y and x[0] != y[0] and x[-1] != y[-1]:
                continue
            agree = 0
            while agree < 3 and 0 <= a < nd and 0 <= b < ni and (doc[a] == item[b] or similar(doc[a], item[b])):
                agree, a, b = agree + 1, a + step, b + step
            at_end = agree >= 2 and not (0 <= a < nd and 0 <= b < ni)
            if agree >= 3 or at_end:
                best = (skip_d, skip_i)
                break
        if best is None:
            break
        errors, run = errors + 1, 0
        if best == (0, 0):
            pending += 1
        else:
            pending += best[1]
            d += (best[0] - 1) * step
            i += (best[1] - 1) * step
    return covered, reached


def _run_hash(words: list[str]) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)


def _common_runs(items: DataFrame, min_words: int) -> frozenset[int]:
    """Hashes of the runs of SHORT to LONG - 1 words that have over RARE places in all items.

    At most (LONG - SHORT) / RARE of the items' words, so no more than their texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                words = normal_words(text or "")
                if len(words) >= min_words:
                    found += [_run_hash(words[k : k + n]) for n in range(SHORT, LONG) for k in range(len(words) - n + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(found, type=pa.int64())], names=["run"])

    counted = items.select("text").mapInArrow(run, "run bigint").groupBy("run").agg(F.count("*").alias("n"))
    return frozenset(r.run for r in counted.where(F.col("n") > RARE).select("run").collect())


class LeakFinder:
    """Finds items in documents; built from (item_id, text)."""

    def __init__(self, items: list[tuple[int, str]], min_words: int = MIN_WORDS, common: frozenset[int] | None = None):
        """*common* has the hashes of short runs with over RARE places, where *items* are only a slice of all; else the automaton counts."""
        self.min_words, self.cache, self.common = min_words, _Folded(), common
        texts = [(i, normal_words(t or "")) for i, t in items]
        self.items = [(i, w) for i, w in texts if len(w) >= min_words]
        self.vocabulary: dict[str, int] = {}
        sequences = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in self.items]
        self.automaton = SuffixAutomaton(sequences)

    def anchors(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(document end, run length, state) of every longest match that ends, if it is an anchor."""
        a, get = self.automaton, self.vocabulary.get
        following, link, length, count, common = a.next, a.link, a.length, a.count, self.common

        def rare(state: int, end: int, size: int) -> bool:
            return count[state] <= RARE if common is None else _run_hash(words[end - size + 1 : end + 1]) not in common

        state = size = 0
        for at, word in enumerate(words):
            w = get(word, -1)
            target = following[state].get(w)
            if target is not None:
                state, size = target, size + 1
                continue
            if size >= SHORT and (size >= LONG or rare(state, at - 1, size)):
                yield at - 1, size, state
            while target is None and state:
                state = link[state]
                size = length[state]
                target = following[state].get(w)
            if target is not None:
                state, size = target, size + 1
            else:
                state = size = 0
        if size >= SHORT and (size >= LONG or rare(state, len(words) - 1, size)):
            yield len(words) - 1, size, state

    def passages(self, words: list[str]) -> dict[int, tuple[int, list[tuple[int, int]]]]:
        """item_id -> (most item words in sequence, spans (first, last) of *words* that hold at least min_words of the item)."""
        out: dict[int, tuple[int, list[tuple[int, int]]]] = {}
        if len(words) < self.min_words - 4:
            return out
        done: dict[tuple[int, int], int] = {}
        for end, size, state in self.anchors(words):
            for k, at in self.automaton.places(state):
                key = (k, end - at)
                if done.get(key, -1) >= end:
                    continue
                item_id, item = self.items[k]
                right, reached = _extend_side(words, item, end, at, 1)
                left, begun = _extend_side(words, item, end - size + 1, at - size + 1, -1)
                done[key] = reached
                total = left + size + right
                if total >= self.min_words:
                    most, spans = out.get(item_id, (0, []))
                    out[item_id] = (max(most, total), [*spans, (begun, reached)])
        return out

    def find(self, text: str | None) -> dict[int, int]:
        """item_id -> most item words in sequence that *text* holds, for those with at least min_words."""
        return {i: most for i, (most, _) in self.passages(normal_words(text, self.cache)).items()} if text else {}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (first, last) in order, those that touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def leaks(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, item_id, words): items of which a document holds at least *min_words* words in sequence."""
    found = spans(documents, items, id_col, text_col, min_words)
    return found.groupBy(id_col, "item_id").agg(F.max("words").alias("words"))


def spans(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, item_id, words, first, last): the leaked stretches of each document, as numbers of its normal words."""
    data = spread(documents.select(F.col(id_col), F.col(text_col).alias("__text")).where("__text is not null"))
    held = items.select("item_id", "text").where("text is not null")
    size = held.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    slices = max(1, -(-size // MAX_ITEM_CHARS))
    common = _common_runs(held, min_words) if slices > 1 else None
    found = []
    for k in range(slices):
        part = [(r.item_id, r.text) for r in held.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == k).collect()]  # at most MAX_ITEM_CHARS or so
        found.append(_search(data, sorted(part, key=lambda p: (p[0] is None, p[0])), min_words, common))
    return reduce(DataFrame.unionByName, found)


def _search(data: DataFrame, items: list[tuple[int, str]], min_words: int, common: frozenset[int] | None = None) -> DataFrame:
    numbers = ["item_id", "words", "first", "last"]
    schema = T.StructType([data.schema[0], *[T.StructField(n, T.LongType()) for n in numbers]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = LeakFinder(items, min_words, common)
        for batch in batches:
            rows = []
            for k, text in enumerate(batch.column(1).to_pylist()):
                for item, (n, found) in finder.passages(normal_words(text, finder.cache)).items() if text else ():
                    rows += [(k, item, n, a, b) for a, b in merged(found)]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0], type=pa.int64())), *(pa.array(c, type=pa.int64()) for c in cols[1:])], names=schema.names)

    return data.mapInArrow(run, schema)


def cleaned(documents: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, leaked_words, share, dropped, text): every document with leaks, without its leaked spans.

    A span of *longest* words or more is removed; where spans cover more than *coverage* of the
    document's words, the whole document is dropped and its text is null.
    """
    by_document = found.groupBy(id_col).agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    data = documents.select(F.col(id_col), F.col(text_col).alias("__text")).where("__text is not null").join(if_small(by_document), id_col)
    schema = T.StructType([data.schema[0], T.StructField("leaked_words", T.LongType()), T.StructField("share", T.DoubleType()), T.StructField("dropped", T.BooleanType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Folded()
        for batch in batches:
            rows = []
            for text, held in zip(batch.column("__text").to_pylist(), batch.column("spans").to_pylist()):
                held = merged([(s["first"], s["last"]) for s in held])
                n, leaked = len(normal_words(text, cache)), sum(b - a + 1 for a, b in held)
                dropped = leaked > coverage * n
                rows.append((leaked, leaked / n, dropped, None if dropped else without_spans(text, [(a, b) for a, b in held if b - a + 1 >= longest], cache)))
            cols = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.int64(), pa.float64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, type=t) for c, t in zip(cols, kinds))], names=schema.names)

    return data.mapInArrow(run, schema)

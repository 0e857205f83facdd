"""Problem 3: transcript segments into clean, ordered speaker turns.

One Aho-Corasick automaton finds every form of every speaker's name and role, hesitations
and sound annotations; what stands around a match decides whether it is a label, a
hesitation or an ordinary word. Labels, times, hesitations and annotations are cut out as
intervals. Segments become fragments, each with the label it begins with, and windows over
fragments carry speakers forward and gather turns.

A video of any length is handled in blocks of BLOCK segment numbers: what a block hands to
the next (its last speaker, its first and last stretch) is one row, and only those rows
meet in a window per video.

Defined results: null and blank texts have no words; speech before the first label has no
speaker and gives no turn; a label that names nobody of the video's channel, or more than
one person, is no label; a label without words is dropped; repeated segments count once;
videos without channel or without labels have no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from glosswright.runtime import cut, if_small, small, spread

BLOCK = 4_096
HOST, GUEST = -1, -2
ROLES = {"host": HOST, "moderator": HOST, "moderatorin": HOST, "gastgeber": HOST, "presenter": HOST, "presentador": HOST, "presentadora": HOST, "anfitrion": HOST, "animateur": HOST, "animatrice": HOST, "interviewer": HOST, "guest": GUEST, "gast": GUEST, "invité": GUEST, "invitée": GUEST, "invitado": GUEST, "invitada": GUEST}
#: Always hesitations.
HESITATIONS = ["bah", "ben", "hein", "uh", "uhh", "um", "umm", "er", "erm", "uhm", "hm", "hmm", "mm", "mmm", "mhm", "äh", "ähm", "öh", "öhm", "euh", "eh", "em"]
#: Hesitations where a comma, dots or the end of the speech follow, or where nothing else is said.
LIKELY = ["you know", "i mean", "sort of", "kind of", "well", "like", "enfin bon", "enfin", "quoi", "ne", "sozusagen", "halt", "also", "o sea", "este", "pues", "bueno"]
SOUNDS = ["music", "music playing", "applause", "laughter", "laughs", "coughs", "sighs", "noise", "silence", "inaudible", "door slams", "background chatter", "upbeat theme", "crosstalk", "clears throat"]

TIME = r"[\[(<]?\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d+)?[\])>]?"
_TIMES = re.compile(rf"(?<![\w:.]){TIME}(?![\w:])")
_BRACKETS = re.compile(r"\[[^\[\]]*\]|\([^()]*\)|\{[^{}]*\}|<[^<>]*>|[♪♫][^♪♫]*[♪♫]|(?<![\w*])\*(?=[^\s*])[^*\n]*(?<=[^\s*])\*(?![\w*])|[♪♫]+")
_AFTER = re.compile(r"\s?:\*{0,2}(?=\s|$)|\*{1,2}:(?=\s|$)|\s+[>–—-](?=\s|$)|\s*>(?=\s|$)")
_CLOSED = {mark: re.compile(rf"\s*:?\s*\{close}\s*:?") for mark, close in (("[", "]"), ("(", ")"))}
_TAG_END = re.compile(r"\s*>")
_DELIMITER = re.compile(r"(?<=[^\W\d_])(?:\s?:\*{0,2}(?=\s|$)|\s[>–—-](?=\s)|\]|\)|>)")
_WORD = re.compile(r"[^\W_]")


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _one_slip(a: str, b: str) -> bool:
    """One letter lost, added, changed or swapped with its neighbour, in words of four letters or more."""
    n, m = len(a), len(b)
    if min(n, m) < 4 or abs(n - m) > 1:
        return False
    i = 0
    while i < min(n, m) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or (n == m and a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])


def _word_start(low: str, end: int) -> int:
    while end and low[end - 1].isalpha():
        end -= 1
    return end


def _look_back(low: str, end: int) -> list[int]:
    """Where a name of three, two or one words that ends at *end* would begin, the longest first."""
    starts, at = [], _word_start(low, end)
    if at == end:
        return []
    starts.append(at)
    for _ in range(2):
        k = at
        # what may stand between the words of a name: "J. Doe", "Doe, Jane", "Doe , Jane"
        for mark in (" ", ",", " ", "."):
            if k and low[k - 1] == mark:
                k -= 1
        begin = _word_start(low, k)
        if k == at or begin == k:
            break
        starts.append(begin)
        at = begin
    return starts[::-1]


def _prefix(low: str, a: int) -> tuple[int, str]:
    """(start, mark) of what opens a label before *a*: quote arrows, a dash, stars, a voice tag or a bracket."""
    i = a
    while i and low[i - 1].isspace():
        i -= 1
    padded = i < a
    if i and low[i - 1] in "[(":
        return i - 1, low[i - 1]
    if low[max(0, i - 2) : i] == ">>":
        return (i - 3 if low[max(0, i - 3) : i] == ">>>" else i - 2), ">>"
    if padded and i and low[i - 1] in "-–—" and (i == 1 or low[i - 2].isspace()):
        return i - 1, "-"
    if padded and low[max(0, i - 2) : i] == "<v":
        return i - 2, "<v"
    if not padded and i and low[i - 1] == "*":
        return (i - 2 if i > 1 and low[i - 2] == "*" else i - 1), "*"
    return a, ""


def _without_a_letter(word: str) -> set[str]:
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


class Labels:
    """All name forms of all speakers in one automaton."""

    def __init__(self, speakers: list[tuple[int, str]]):
        import ahocorasick

        forms: dict[str, set[int]] = {}
        for speaker, name in speakers:
            parts = _lower(" ".join((name or "").split())).split(" ")
            if not parts or not parts[0]:
                continue
            first, last = parts[0], parts[-1]
            for form in {" ".join(parts), first, last, f"{first[0]}. {last}", f"{first[0]} {last}", f"{last}, {first}", f"{last} {first}", f"{first} {last}", f"{first} {last[0]}."}:
                forms.setdefault(form, set()).add(speaker)
        self.exact = {f: sorted(s) for f, s in forms.items()}
        slips: dict[str, set[int]] = {}
        for form, who in forms.items():
            letters = [i for i, c in enumerate(form) if c.isalpha()]
            if len(letters) >= 5:
                for i in letters:
                    slips.setdefault(form[:i] + form[i + 1 :], set()).update(who)
        table: dict[str, list[int]] = {f: sorted(s) for f, s in slips.items()} | self.exact | {r: [c] for r, c in ROLES.items()}
        self.automaton = ahocorasick.Automaton()
        for form, who in table.items():
            self.automaton.add_word(form, ("name", len(form), who))
        for word in [*HESITATIONS, *LIKELY, *SOUNDS]:
            if word not in table:
                self.automaton.add_word(word, ("filler" if word not in SOUNDS else "sound", len(word), word))
        self.automaton.make_automaton()
        self.known: dict[str, list[int] | None] = {}
        #: (the other words, place, the word itself or without one letter) -> forms with that word
        self.by_slip: dict[tuple[tuple[str, ...], int, str], list[str]] = {}
        for f in self.exact:
            parts = f.split(" ")
            for k, part in enumerate(parts):
                if len(part) >= 4:
                    for key in {part} | _without_a_letter(part):
                        self.by_slip.setdefault(((*parts[:k], *parts[k + 1 :]), k, key), []).append(f)

    def near(self, text: str) -> list[int] | None:
        """Speakers with a name form of which one word of four letters or more has one slip in *text*."""
        found = self.known.get(text, 0)
        if found == 0:
            who: set[int] = set()
            parts = text.split(" ")
            for k, part in enumerate(parts):
                rest = (*parts[:k], *parts[k + 1 :])
                for key in {part} | _without_a_letter(part) if len(part) >= 4 else ():
                    for form in self.by_slip.get((rest, k, key), ()):
                        right = form.split(" ")[k]
                        if right != part and _one_slip(part, right):
                            who.update(self.exact[form])
            found = sorted(who) or None
            if len(self.known) < 200_000:
                self.known[text] = found
        return found

    def find(self, low: str) -> tuple[list[tuple[int, int, list[int]]], list[tuple[int, int, str]]]:
        """(labels, filler matches) of a lower-cased segment; labels do not overlap and come in order."""
        names, fillers = [], []
        n = len(low)
        for end, (kind, size, what) in self.automaton.iter(low):
            a, b = end - size + 1, end + 1
            if (a and (low[a - 1].isalnum() or low[a - 1] == "'")) or (b < n and (low[b].isalnum() or low[b] == "'")):
                continue
            if kind == "name":
                names.append((a, b, what))
            else:
                fillers.append((a, b, what))
        labels = [x for a, b, who in names if (x := self._label(low, a, b, who))]
        # the part of a name that has no slip is found first; the other part belongs to the label too
        longer = []
        for a, b, who in names:
            if a and low[a - 1] == " " and any(c <= a and b <= d for c, d, _ in labels):
                for c in _look_back(low, b):
                    if c < a and (c == 0 or not low[c - 1].isalnum()) and (more := self.near(low[c:b])) and (x := self._label(low, c, b, more)):
                        longer.append(x)
                        break
        labels += longer
        taken = [(a, b) for a, b, _ in labels]
        for m in _DELIMITER.finditer(low):
            if any(a <= m.start() < b for a, b in taken):
                continue
            for a in _look_back(low, m.start()):
                if (a == 0 or not low[a - 1].isalnum()) and (who := self.near(low[a : m.start()])) and (x := self._label(low, a, m.start(), who)):
                    labels.append(x)
                    break
        labels.sort(key=lambda x: (x[0] - x[1], x[0]))  # the longest of overlapping ones stands
        kept: list[tuple[int, int, list[int]]] = []
        for a, b, who in labels:
            if all(b <= c or d <= a for c, d, _ in kept):
                kept.append((a, b, who))
        return sorted(kept), fillers

    @staticmethod
    def _label(low: str, a: int, b: int, who: list[int]) -> tuple[int, int, list[int]] | None:
        """Context rules: what must stand before and after a name that is a label."""
        start, mark = _prefix(low, a)
        if mark in _CLOSED:
            tail = _CLOSED[mark].match(low, b)
            return (start, tail.end(), who) if tail else None
        if mark == "<v":
            tail = _TAG_END.match(low, b)
            return (start, tail.end(), who) if tail else None
        tail = _AFTER.match(low, b)
        if not tail:
            return None
        if tail.group().strip() in "–—-" and not mark and " " not in low[a:b]:
            before = _TIMES.sub(" ", _BRACKETS.sub(" ", low[:start])).rstrip()
            if _WORD.search(before) and not re.search(r"[.!?…\])>]$", before):
                return None  # one word, then a dash, in the middle of a sentence
        return start, tail.end(), who


def _clean(text: str, low: str, fillers: list[tuple[int, int, str]], start: int, end: int) -> str:
    """text[start:end] minus times, annotations and hesitations."""
    cut = [(m.start(), m.end()) for m in _TIMES.finditer(text, start, end)] + [(m.start(), m.end()) for m in _BRACKETS.finditer(text, start, end)]
    # a likely hesitation is one where a mark follows, or where no other word is left
    for a, b, word in fillers:
        if start <= a and b <= end and word not in SOUNDS:
            if word in HESITATIONS:
                after = re.match(r"\s?(?:,|\.{2,}|…)+", low[b:end])
                cut.append((a, b + (after.end() if after else 0)))
            elif after := re.match(r"\s?(?:,|\.{2,}|…)+", low[b:end]):
                before = low[start:a].rstrip()
                if word in ("you know", "i mean", "sort of", "kind of", "enfin bon", "o sea", "sozusagen", "ne") or not before or before[-1] in ".,;:!?…":
                    cut.append((a, b + after.end()))
    out = _subtract(text, start, end, cut)
    if not _WORD.search(out):
        return ""
    rest = _subtract(text, start, end, cut + [(a, b) for a, b, w in fillers if w not in SOUNDS])
    return " ".join(out.split()) if _WORD.search(rest) else ""


def _subtract(text: str, start: int, end: int, cut: list[tuple[int, int]]) -> str:
    """The parts of text[start:end] outside the intervals."""
    out, at = [], start
    for a, b in sorted(cut):
        if a > at:
            out.append(text[at:a])
        at = max(at, b)
    out.append(text[at:end])
    return " ".join(out)


def segment_fragments(text: str | None, labels: Labels) -> list[tuple[list[int] | None, str]]:
    """(speakers that the label may name or null, clean speech) for each stretch of a segment."""
    if not text or not _WORD.search(text):
        return []
    low = _lower(unicodedata.normalize("NFC", text)) if not text.isascii() else text.lower()
    if len(low) != len(text):
        text = unicodedata.normalize("NFC", text)
        low = _lower(text)
    found, fillers = labels.find(low)
    # times at the start of a segment must not hide a label after them; they are cut with the speech before it
    bounds = [(0, 0, None), *found]
    out = []
    for k, (_, begin, who) in enumerate(bounds):
        stop = bounds[k + 1][0] if k + 1 < len(bounds) else len(text)
        speech = _clean(text, low, fillers, begin, stop)
        if speech:
            out.append((who, speech))
    return out


@lru_cache(maxsize=2)
def _labels(speakers: tuple[tuple[int, str], ...]) -> Labels:
    return Labels(list(speakers))


#: Speakers in one automaton; more are taken in slices of channels.
MAX_SPEAKERS = 200_000


def fragments(segments: DataFrame, speakers: DataFrame, with_text: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(video_id, segment_index, *keep, f): f is the array of a segment's fragments; one narrow pass over the texts.

    *speakers* are about MAX_SPEAKERS at most (see sliced()); every worker holds their automaton.
    """
    people = tuple(sorted((r.speaker_id, r.full_name or "") for r in speakers.where("speaker_id is not null").select("speaker_id", "full_name").distinct().collect()))
    data = spread(segments.select("video_id", "segment_index", *keep, "text").where("text is not null"))
    piece = [T.StructField("who", T.ArrayType(T.LongType()))] + [T.StructField("speech", T.StringType())] * with_text
    schema = T.StructType([*data.schema.fields[:-1], T.StructField("f", T.ArrayType(T.StructType(piece)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        labels, kind = _labels(people), to_arrow_type(schema["f"].dataType)
        for batch in batches:
            found = [segment_fragments(t, labels) for t in batch.column(batch.num_columns - 1).to_pylist()]
            full = pa.array([bool(f) for f in found])
            rows = [[{"who": w} | ({"speech": s} if with_text else {}) for w, s in f] for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, type=kind)], names=schema.names).filter(full)

    return data.mapInArrow(run, schema)


def channel_people(speakers: DataFrame) -> DataFrame:
    """(channel_id, people, host, guest): host and guest where the channel has exactly one."""
    of = lambda role: F.collect_set(F.when(F.col("speaker_role") == role, F.col("speaker_id")))
    g = speakers.groupBy("channel_id").agg(F.collect_set("speaker_id").alias("people"), of("host").alias("hosts"), of("guest").alias("guests"))
    one = lambda c: F.when(F.size(c) == 1, F.get(F.col(c), F.lit(0)))
    return g.select("channel_id", "people", one("hosts").alias("host"), one("guests").alias("guest"))


def sliced(segments: DataFrame, speakers: DataFrame, video_channel: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """(segments, speakers) to search together: all of them, or slices of channels where the speakers are too many for one automaton."""
    n = -(-speakers.count() // MAX_SPEAKERS)
    if n <= 1:
        return [(segments, speakers)]
    part = F.pmod(F.xxhash64("channel_id"), F.lit(n))
    out = []
    for k in range(n):
        videos = video_channel.where(part == k).select("video_id")
        out.append((segments.join(if_small(videos), "video_id", "left_semi"), speakers.where(part == k)))
    return out


def all_fragments(segments: DataFrame, speakers: DataFrame, video_channel: DataFrame, **kinds) -> DataFrame:
    return reduce(DataFrame.unionByName, [fragments(s, p, **kinds) for s, p in sliced(segments, speakers, video_channel)])


def spoken(found: DataFrame, video_channel: DataFrame, speakers: DataFrame) -> DataFrame:
    """(video_id, b, segment_index, pos, named): fragments of labelled videos, the label settled by channel. Checkpointed.

    A video may hold a tenth of the segments: where the videos are too many to broadcast, they are
    joined by block, so that no task gets a whole video.
    """
    once = found.groupBy("video_id", "segment_index").agg(F.first("f").alias("f")).withColumn("b", F.floor(F.col("segment_index") / BLOCK))
    videos = video_channel.select("video_id", "channel_id").where("channel_id is not null")
    if small(videos):
        rows = once.join(F.broadcast(videos), "video_id")
    else:
        blocks = found.select("video_id", F.floor(F.col("segment_index") / BLOCK).alias("b")).distinct().join(videos, "video_id")
        rows = once.join(blocks, ["video_id", "b"])
    rows = rows.join(if_small(channel_people(speakers)), "channel_id")
    rows = rows.select("video_id", "b", "segment_index", "people", "host", "guest", F.posexplode("f").alias("pos", "x")).select("*", "x.who")
    hits = F.filter("who", lambda w: F.array_contains("people", w))
    named = F.when(F.array_contains("who", F.lit(HOST)), F.col("host")).when(F.array_contains("who", F.lit(GUEST)), F.col("guest")).when(F.size(hits) == 1, F.get(hits, F.lit(0)))
    # read three times below: without the cut every read would run the pass over the texts again
    return cut(rows.select("video_id", "b", "segment_index", "pos", named.alias("named")))


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``speaker`` and ``stretch`` (number of the stretch of one speaker within its block)."""
    inside = Window.partitionBy("video_id", "b").orderBy("segment_index", "pos")
    last_named = F.max_by("named", F.when(F.col("named").isNotNull(), F.struct("segment_index", "pos")))
    every = rows.groupBy("video_id", "b").agg(last_named.alias("left"))
    across = Window.partitionBy("video_id").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("video_id", "b", F.last("left", ignorenulls=True).over(across).alias("carried"))
    own = rows.withColumn("own", F.last("named", ignorenulls=True).over(inside))
    who = own.join(carried, ["video_id", "b"]).withColumn("speaker", F.coalesce("own", "carried")).where("speaker is not null")
    change = F.when(F.lag("speaker").over(inside) == F.col("speaker"), 0).otherwise(1)
    return who.withColumn("change", change).withColumn("stretch", F.sum("change").over(inside)).drop("own", "carried", "change", "named")


def stretches(rows: DataFrame) -> DataFrame:
    """(video_id, b, stretch, speaker, first, last, turn): turn is equal for stretches that blocks cut apart."""
    s = rows.groupBy("video_id", "b", "stretch").agg(F.first("speaker").alias("speaker"), F.min("segment_index").alias("first"), F.max("segment_index").alias("last"))
    s = cut(s.withColumn("n", F.max("stretch").over(Window.partitionBy("video_id", "b"))))
    edge = (F.col("stretch") == 1) | (F.col("stretch") == F.col("n"))
    own = F.struct("b", "stretch")
    order = Window.partitionBy("video_id").orderBy("b", "stretch")
    # the last stretch of a block cannot continue its first one
    joins = (F.lag("speaker").over(order) == F.col("speaker")) & (F.lag("b").over(order) != F.col("b"))
    edges = s.where(edge).withColumn("begins", F.when(F.coalesce(joins, F.lit(False)), F.lit(None)).otherwise(own))
    edges = edges.withColumn("turn", F.last("begins", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("begins")
    return s.where(~edge).withColumn("turn", own).unionByName(edges).drop("n")


def turns(segments: DataFrame, speakers: DataFrame, video_channel: DataFrame) -> DataFrame:
    """(video_id, speaker_id, first_segment_index, last_segment_index): one row per turn."""
    s = stretches(numbered(spoken(all_fragments(segments, speakers, video_channel), video_channel, speakers)))
    t = s.groupBy("video_id", "turn").agg(F.first("speaker").alias("speaker_id"), F.min("first").alias("first_segment_index"), F.max("last").alias("last_segment_index"))
    return t.drop("turn")


def lines(segments: DataFrame, speakers: DataFrame, video_channel: DataFrame) -> DataFrame:
    """(video_id, turn_start, speaker_id, segment_index, pos, start_time, end_time, speech): the clean lines of every turn.

    Lines stay rows, so that a turn of any length is never gathered. Swapped times are set
    right; a missing time stays null. The windows see numbers alone; speech is shuffled once.
    """
    found = cut(all_fragments(segments, speakers, video_channel, with_text=True, keep=("start_time", "end_time")))
    rows = numbered(spoken(found.select("video_id", "segment_index", F.transform("f", lambda x: F.struct(x.who.alias("who"))).alias("f")), video_channel, speakers))
    s = stretches(rows)
    starts = s.groupBy("video_id", "turn").agg(F.min("first").alias("turn_start"))
    where = s.select("video_id", "b", "stretch", "turn").join(starts, ["video_id", "turn"]).drop("turn")
    placed = rows.join(where, ["video_id", "b", "stretch"]).groupBy("video_id", "segment_index").agg(F.collect_list(F.struct("pos", "turn_start", F.col("speaker").alias("speaker_id"))).alias("at"))
    time = (F.min(F.least("start_time", "end_time")), F.max(F.greatest("start_time", "end_time")), F.max(F.isnull("start_time")), F.max(F.isnull("end_time")))
    said = found.groupBy("video_id", "segment_index").agg(F.first("f.speech").alias("speech"), *[c.alias(n) for c, n in zip(time, ("lo", "hi", "no_start", "no_end"))])
    out = said.join(placed, ["video_id", "segment_index"]).select("*", F.inline("at"))
    start, end = F.when(~F.col("no_start"), F.col("lo")).alias("start_time"), F.when(~F.col("no_end"), F.col("hi")).alias("end_time")
    return out.select("video_id", "turn_start", "speaker_id", "segment_index", "pos", start, end, F.get("speech", F.col("pos")).alias("speech"))

from glosswright.llm import turns

PEOPLE = [(10, "c", "Corvel Fennupp", "host"), (11, "c", "Orlind Holloick", "guest"), (12, "c", "Pavric Fennoth", "guest"), (20, "d", "Zaphne Pellavar", "host"), (21, "d", "Zaphne Rundupp", "guest")]
LABELS = turns.Labels([(i, n) for i, _, n, _ in PEOPLE])


def parse(text):
    return turns.segment_fragments(text, LABELS)


def test_label_forms():
    for form in ("Orlind Holloick:", "HOLLOICK:", "orlind :", "O. Holloick:", "Holloick, Orlind:", "[Orlind]", "(ORLIND HOLLOICK)", "<v O. Holloick>", "**holloick:**", ">> Orlind:", ">>> HOLLOICK -", "- Orlind:", "ORLIND >", "Holoick:", "Orilnd Holloick:", "01:50 >>> Orlind:", "[00:10] Orlind -", "  HOLLOICK, ORLIND >"):
        assert parse(f"{form} hello there") == [([11], "hello there")], form
    assert parse("[Host] hello")[0][0] == [turns.HOST]


def test_what_is_no_label():
    assert parse("Here is the strange bit: a dog") == [(None, "Here is the strange bit: a dog")]
    assert parse("Thanks, Orlind. It rained") == [(None, "Thanks, Orlind. It rained")]
    assert parse("we met Orlind - and then left") == [(None, "we met Orlind - and then left")]


def test_cleaning():
    assert parse("[0:12] um, it (coughs) was ♪ la ♪ uh late [Music]") == [(None, "it was late")]
    assert parse("Er, uh.") == [] and parse("Orlind: (applause)") == [] and parse(None) == [] and parse(" \n") == []
    assert parse("so it ended. - Orlind: Yes. >> HOST: No.") == [(None, "so it ended."), ([11], "Yes."), ([turns.HOST], "No.")]


def tables(spark, rows):
    segs = spark.createDataFrame(rows, "video_id string, segment_index bigint, start_time double, end_time double, text string, speaker string")
    people = spark.createDataFrame(PEOPLE, "speaker_id bigint, channel_id string, full_name string, speaker_role string")
    videos = spark.createDataFrame([("v", "c"), ("w", "d"), ("u", "c"), ("n", None)], "video_id string, channel_id string")
    return segs, people, videos


ROWS = [
    ("v", 0, "before anyone speaks"), ("v", 1, "Host: good day"), ("v", 2, "and welcome"), ("v", 3, "Orlind: (coughs)"), ("v", 4, "host: again. [Orlind] thanks"), ("v", 5, None), ("v", 6, "a lot"), ("v", 9, "PAVRIC: hi. >> Orlind: bye"), ("v", 9, "PAVRIC: hi. >> Orlind: bye"),
    ("v", 10, "um"), ("v", 11, "really"), ("v", 13, "Fennoth - end"), ("w", 0, "Zaphne: who"), ("w", 1, "Pellavar: me"), ("w", 2, "Orlind: not of this channel"), ("u", 0, "no labels at all"), ("n", 0, "Orlind: no channel"),
]
WANT = {("v", 10, 1, 4), ("v", 11, 4, 6), ("v", 12, 9, 9), ("v", 11, 9, 11), ("v", 12, 13, 13), ("w", 20, 1, 2)}


def test_turns(spark):
    args = tables(spark, [(v, i, 1.0, 2.0, t, "x") for v, i, t in ROWS])
    got = [tuple(r) for r in turns.turns(*args).select("video_id", "speaker_id", "first_segment_index", "last_segment_index").collect()]
    assert set(got) == WANT and len(got) == len(WANT)
    assert turns.turns(args[0].limit(0), *args[1:]).count() == 0


def test_blocks_change_nothing(spark, monkeypatch):
    args = tables(spark, [(v, i, 1.0, 2.0, t, "x") for v, i, t in ROWS])
    for size in (1, 2, 3):
        monkeypatch.setattr(turns, "BLOCK", size)
        got = [tuple(r) for r in turns.turns(*args).select("video_id", "speaker_id", "first_segment_index", "last_segment_index").collect()]
        assert set(got) == WANT and len(got) == len(WANT), size


def test_lines(spark):
    args = tables(spark, [("v", 0, 5.0, 1.0, "Host: well, good day", "x"), ("v", 1, None, 9.0, "and um welcome", "x")])
    got = [(r.turn_start, r.speaker_id, r.segment_index, r.start_time, r.end_time, r.speech) for r in turns.lines(*args).orderBy("segment_index").collect()]
    assert got == [(0, 10, 0, 1.0, 5.0, "good day"), (0, 10, 1, None, 9.0, "and welcome")]

"""Problem 2: quality statistics of a text and its distance from the prose of its language.

Every text gets a vector of statistics. Mean and covariance of each language's prose are
fitted robustly over the whole corpus (medians and quartile ranges trim, then one
reweighting), and each text gets its squared Mahalanobis distance together with every
statistic's contribution, which sum to it. Outliers are then named by the statistics of
their lines: cells make a table, short items a list, the rest of the unreadable is junk.

Defined results: null texts have no row; empty and blank texts have zero words and are no
outliers; languages with under MIN_ROWS texts, and texts of no known language, are held
against all languages together; repeated keys count once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glosswright.llm import lang
from glosswright.runtime import cut, spread

#: Statistics in order, each with the spread below which differences mean nothing.
STATISTICS = {
    "log_words": 0.3, "mean_word_length": 0.3, "symbol_ratio": 0.01, "digit_ratio": 0.01, "ended_lines": 0.3,
    "common_words": 0.04, "log_words_per_line": 0.2, "log_longest": 0.15, "item_share": 0.05, "cell_share": 0.05,
}
NAMES = tuple(STATISTICS)
FLOORS = np.array(list(STATISTICS.values()))
MIN_ROWS = 50
CUTOFF = 40.0
#: Weight, in words, of the usual rate for rates of short texts.
PRIOR = 6
USUAL_COMMON = 0.35

WORDS = re.compile(r"\b[\w']+\b")
END = re.compile(r"[.!?…:;][\"'”’»)\]]*$")
ITEM = re.compile(r"^\s*(?:[-–—*•·+]|\[[ xX]\]|\(?\d{1,3}[.)]|\(?[a-zA-Z][.)]|\d{1,2}:\d{2}(?::\d{2})?)\s+\S")
CELLS = (re.compile(r"\|"), re.compile(r"\t"), re.compile(r";"), re.compile(r","), re.compile(r" {2,}"))
SHORT_ITEM = 8


def _row_cells(lines: list[str]) -> tuple[int, int]:
    """(lines, words) that are rows of at least three cells, by the one delimiter that most lines share."""
    best = (0, 0)
    for cell in CELLS:
        counts = [len(cell.findall(x.strip())) for x in lines]
        usual = max(set(counts), key=lambda n: (n > 0, counts.count(n)))
        if usual < 1 or counts.count(usual) < max(2, 0.6 * len(lines)):
            continue
        if usual == 1 and cell.pattern == ",":
            continue  # one comma a line is as likely in prose
        rows = [x for x, n in zip(lines, counts) if abs(n - usual) <= 1 and n]
        # the cells of a row are short: prose with commas has long stretches between them
        rows = [x for x in rows if sum(len(c.split()) for c in cell.split(x)) <= 4 * (usual + 1)]
        best = max(best, (len(rows), sum(len(x.split()) for x in rows)))
    return best


def statistics(text: str) -> tuple[str | None, int, list[float]]:
    """Language, words and the vector of STATISTICS of one text."""
    lines = [x for x in text.splitlines() if x.strip()]
    tokens = text.split()
    n, solid = len(tokens), sum(map(len, tokens))
    if not n:
        return None, 0, [math.log(1.0), 5.0, 0.0, 0.0, 1.0, USUAL_COMMON, math.log(10), math.log(10), 0.0, 0.0]
    found, own = dict.fromkeys(lang.ORDER, 0), dict.fromkeys(lang.ORDER, 0)
    for t in tokens:
        owners = _OWNERS.get(t)
        if owners is None:
            owners = lang.LANGUAGES.get(t.strip(".,;:!?…\"'()[]«»“”-").lower(), ())
            if len(_OWNERS) < 300_000:
                _OWNERS[t] = owners
        for owner in owners:
            found[owner] += 1
        if len(owners) == 1:
            own[owners[0]] += 1
    best = max(found, key=lambda c: (found[c] + own[c], found[c]))
    alnum, digits = sum(map(str.isalnum, text)), sum(map(str.isdigit, text))
    ended = sum(1 for x in lines if END.search(x.rstrip()))
    items = item_words = 0
    if len(lines) > 1:
        for x in lines:
            size = len(x.split())
            if size <= SHORT_ITEM + 3 and ITEM.match(x) or size <= SHORT_ITEM and not END.search(x.rstrip()):
                items += 1
                item_words += size
    if items < 3:
        item_words = 0
    cell_words = _row_cells(lines)[1] if len(lines) > 1 else 0
    rate = lambda hits, usual=0.0: (hits + usual * PRIOR) / (n + PRIOR)
    return best if found[best] >= 2 else None, sum(1 for _ in WORDS.finditer(text)), [
        math.log(1 + n), (solid + 5.0 * PRIOR) / (n + PRIOR), (solid - alnum) / solid, digits / solid, ended / len(lines),
        rate(found[best], USUAL_COMMON), math.log(n / len(lines)), math.log(max(map(len, tokens))), item_words / n, cell_words / n,
    ]


_OWNERS: dict[str, tuple[str, ...]] = {}


def measure(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, language, words, statistics): one row per key; the only pass over the texts. Checkpointed."""
    data = spread(texts.select(*keys, F.col(text).alias("__text")).where(F.col(text).isNotNull()))
    schema = T.StructType([*[data.schema[k] for k in keys], T.StructField("language", T.StringType()), T.StructField("words", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in NAMES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in batch.column(len(keys)).to_pylist()]
            vectors = np.array([r[2] for r in rows], dtype=float).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([r[0] for r in rows], type=pa.string()), pa.array([r[1] for r in rows], type=pa.int64()), *(pa.array(v) for v in vectors.T)],
                names=schema.names,
            )

    return cut(data.mapInArrow(run, schema).dropDuplicates(keys))


Model = dict[str, tuple[np.ndarray, np.ndarray]]


def fit(measured: DataFrame) -> Model:
    """Language -> (mean, inverse covariance) of its prose; key "" holds all languages together.

    Three aggregations over the vectors, each with a handful of rows as result.
    """
    both = measured.where("words > 0").select(F.explode(F.array_distinct(F.array(F.coalesce("language", F.lit("")), F.lit("")))).alias("g"), *NAMES)
    quartiles = both.groupBy("g").agg(F.count("*").alias("n"), *[F.percentile_approx(c, [0.25, 0.5, 0.75], 2000).alias(c) for c in NAMES]).collect()
    centre, scale = {}, {}
    for r in quartiles:
        if r.n >= MIN_ROWS or r.g == "":
            q = np.array([r[c] for c in NAMES])
            centre[r.g], scale[r.g] = q[:, 1], np.maximum((q[:, 2] - q[:, 0]) / 1.349, FLOORS)
    if "" not in centre:
        return {}
    near = lambda g: _all_near(centre[g], 4 * scale[g])
    model = _moments(both, {g: near(g) for g in centre})
    return _moments(both, {g: distance(*model[g]) < CUTOFF for g in model}) or model


def _all_near(middle: np.ndarray, reach: np.ndarray) -> Column:
    test = F.lit(True)
    for c, m, r in zip(NAMES, middle, reach):
        test = test & (F.abs(F.col(c) - float(m)) <= float(r))
    return test


def _moments(both: DataFrame, keep: dict[str, Column]) -> Model:
    rows = F.lit(False)
    for g, test in keep.items():
        rows = rows | ((F.col("g") == g) & test)
    pairs = [(i, j) for i in range(len(NAMES)) for j in range(i, len(NAMES))]
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(NAMES)] + [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s{i}_{j}") for i, j in pairs]
    model = {}
    for r in both.where(rows).groupBy("g").agg(F.count("*").alias("n"), *sums).collect():
        mean = np.array([r[f"s{i}"] for i in range(len(NAMES))]) / r.n
        cov = np.zeros((len(NAMES), len(NAMES)))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"s{i}_{j}"] / r.n - mean[i] * mean[j]
        model[r.g] = (mean, np.linalg.inv(cov + np.diag(FLOORS**2)))
    return model


def _contributions(mean: np.ndarray, inverse: np.ndarray) -> list[Column]:
    """Each statistic's part of the squared distance; the parts sum to it."""
    shifted = [F.col(c) - float(m) for c, m in zip(NAMES, mean)]
    out = []
    for i in range(len(NAMES)):
        inner = sum((shifted[j] * float(inverse[i, j]) for j in range(len(NAMES))), F.lit(0.0))
        out.append(shifted[i] * inner)
    return out


def distance(mean: np.ndarray, inverse: np.ndarray) -> Column:
    return sum(_contributions(mean, inverse), F.lit(0.0))


def score(measured: DataFrame, model: Model) -> DataFrame:
    """Adds ``distance`` (squared Mahalanobis) and the struct ``contributions``."""
    schema = T.StructType([*measured.schema, T.StructField("distance", T.DoubleType()), T.StructField("contributions", T.StructType([T.StructField(c, T.DoubleType()) for c in NAMES]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy() for c in NAMES]) if batch.num_rows else np.zeros((0, len(NAMES)))
            part = np.zeros_like(x)
            languages = np.array([g if g in model else "" for g in batch.column("language").to_pylist()], dtype=object)
            for g, (mean, inverse) in model.items():
                rows = languages == g
                d = x[rows] - mean
                part[rows] = d * (d @ inverse)
            part[batch.column("words").to_numpy() == 0] *= batch.column("log_words").to_numpy()[batch.column("words").to_numpy() == 0, None] > 0
            parts = pa.StructArray.from_arrays([pa.array(p) for p in part.T], names=list(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.sum(1)), parts], names=schema.names)

    return measured.mapInArrow(run, schema)


def kind() -> Column:
    """list, table or junk for outliers that are mostly no prose, else null."""
    outlier = F.col("distance") > CUTOFF
    few_common = (F.col("common_words") < 0.12) & (F.col("log_words") > math.log(5))
    runs = (F.col("log_longest") > math.log(60)) & ((F.col("common_words") < 0.2) | (F.col("mean_word_length") > 12))
    code = (F.col("symbol_ratio") > 0.22) & (F.col("digit_ratio") > 0.08)
    case = F.when(outlier & (F.col("cell_share") > 0.5), "table").when(outlier & code, "junk")
    return case.when(outlier & (F.col("item_share") > 0.5), "list").when(outlier & (few_common | runs | (F.col("symbol_ratio") > 0.3)), "junk")

"""Models are given from outside as plain functions (S2, S7, S8, E1, X4, E6): prompt in, answer out.

``complete`` runs such a function over a column in Arrow batches on the workers, with
retries. The default is a deterministic stand-in, so that everything around a model can be
run and tested without one.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Model = Callable[[str, str], object]


def flat_answer(answer: object) -> str:
    """A model's answer as text: a string, a list of parts or nothing."""
    if answer is None:
        return ""
    if isinstance(answer, str):
        return answer
    if isinstance(answer, (list, tuple)):
        return "".join(flat_answer(p.get("text", p.get("content")) if isinstance(p, dict) else p) for p in answer)
    return str(answer)


def stand_in(system: str, user: str) -> str:
    """Repeats the prompt between the marks of an edit."""
    return f"<<<EDIT_OUTPUT_START>>>\n{user}\n<<<EDIT_OUTPUT_END>>>"


def complete(rows: DataFrame, system: str, user: str, model: Callable[[], Model] | None = None, retries: int = 3, wait: float = 1.0) -> DataFrame:
    """Adds ``answer`` and ``error``. *model* builds the function once per worker; failures back off by powers of two."""
    data = rows.withColumn("__system", F.coalesce(F.col(system), F.lit(""))).withColumn("__user", F.coalesce(F.col(user), F.lit("")))
    schema = T.StructType([*rows.schema, T.StructField("answer", T.StringType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = model() if model else stand_in
        for batch in batches:
            answers, errors = [], []
            for s, u in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                answer = error = None
                for attempt in range(retries):
                    try:
                        answer, error = flat_answer(ask(s, u)), None
                        break
                    except Exception as problem:  # a model may fail in any way; the row says how
                        error = type(problem).__name__
                        if attempt + 1 < retries:
                            time.sleep(wait * 2**attempt)
                answers.append(answer)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(answers, type=pa.string()), pa.array(errors, type=pa.string())], names=schema.names)

    return data.mapInArrow(run, schema)


SEGMENTS = "array<struct<start:double,end:double,text:string>>"


def transcribe(rows: DataFrame, media: str, model: Callable[[], Callable[[str], tuple[str | None, list[tuple[float, float, str]]]]]) -> DataFrame:
    """Adds ``language``, ``segments`` and ``error``. *model* loads the recogniser once per worker, when the first file comes."""
    schema = T.StructType([*rows.schema, T.StructField("language", T.StringType()), T.StructField("segments", T._parse_datatype_string(SEGMENTS)), T.StructField("error", T.StringType())])
    place = rows.columns.index(media)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        recognise, kind = None, to_arrow_type(schema["segments"].dataType)
        for batch in batches:
            languages, segments, errors = [], [], []
            for path in batch.column(place).to_pylist():
                language, heard, error = None, None, "no media"
                if path:
                    try:
                        recognise = recognise or model()
                        language, parts = recognise(path)
                        heard, error = [{"start": a, "end": b, "text": t.strip()} for a, b, t in parts if t and t.strip()], None
                    except Exception as problem:  # one bad file must not end the job
                        error = type(problem).__name__
                languages.append(language)
                segments.append(heard)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(languages, type=pa.string()), pa.array(segments, type=kind), pa.array(errors, type=pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def pick_backend(name: str, backends: dict[str, Callable]) -> Callable:
    """S8."""
    if name not in backends:
        raise ValueError(f"no backend {name}; there are {sorted(backends)}")
    return backends[name]


def perplexity(loss: Column) -> Column:
    """Exp of a positive loss, else null."""
    return F.when(loss > 0, F.exp(loss))


def plain_perplexity(loss: float | None) -> float | None:
    return math.exp(loss) if loss is not None and loss > 0 else None

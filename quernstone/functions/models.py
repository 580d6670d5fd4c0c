"""External models on columns: made once a Python worker, fed in padded batches, their failures rows' flags.

A model is what ``make`` returns when it is called without arguments in a task. It is made in the first task of a
Python worker that needs it and serves all later ones there; ``make`` itself is sent to the workers, so it must not
hold the model.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A worker's models by name, the last used last, and how many of them it keeps.
_MADE: dict[str, object] = {}
KEPT = 4


def _model(name: str, make: Callable[[], object]) -> object:
    model = _MADE.pop(name) if name in _MADE else make()
    _MADE[name] = model
    while len(_MADE) > KEPT:
        _MADE.pop(next(iter(_MADE)))
    return model


def batches_by_length(lengths: np.ndarray, most: int, most_padded: int) -> Iterator[np.ndarray]:
    """Places of the items in batches of items of like length: ``most`` of them, and ``most_padded`` in all once padded.

    An item that is longer than that is a batch of its own.
    """
    order = np.argsort(lengths, kind="stable")
    begin = 0
    for k in range(1, len(order) + 1):
        if k == len(order) or k - begin == most or (k - begin + 1) * int(lengths[order[k]]) > most_padded:
            yield order[begin:k]
            begin = k


def _answers(ask: Callable[[list], list], items: list) -> list[tuple[object, str | None]]:
    """(answer, None) or (None, error) for each item; a batch that fails is asked item by item."""
    try:
        found = list(ask(items))
        if len(found) == len(items):
            return [(x, None) for x in found]
        raise ValueError(f"{len(found)} answers to {len(items)} items")
    except Exception as e:
        if len(items) == 1:
            return [(None, f"{type(e).__name__}: {e}"[:200])]
        return [_answers(ask, [x])[0] for x in items]


def slices_of(lengths: Iterable[int], most: int = 1024, most_chars: int = 1 << 20) -> Iterator[slice]:
    """Slices of a batch's rows: ``most`` rows and ``most_chars`` in all at most, or one row that is longer.

    Spark's batches have so many rows whatever their size; what is made of them is held for a slice at a time.
    """
    begin = end = held = 0
    for end, n in enumerate(lengths):
        if end > begin and (end - begin == most or held + n > most_chars):
            yield slice(begin, end)
            begin, held = end, 0
        held += n
    yield slice(begin, end + 1)


def sounds_of(text: Column, make: Callable[[], Callable[[list[str]], list[str]]], batch: int = 64, most_padded: int = 1 << 20) -> Column:
    """A phonemizer on a column: a struct of ``sounds``, ``word_sounds`` and ``error``.

    The model takes a list of texts and gives as many strings. Where a string has another number of words (between
    single spaces) than its text, the words are asked one by one and ``word_sounds`` has their sounds; else it is
    null. ``error`` says what the model raised for this text, or for one of its words; the sounds are null then.
    Null and empty texts are not asked and have empty sounds.
    """
    name = uuid.uuid4().hex

    @F.pandas_udf("sounds string, word_sounds array<string>, error string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(name, make)
        for texts in (part.iloc[s] for part in parts for s in slices_of(len(t) if isinstance(t, str) else 0 for t in part)):
            texts = [None if pd.isna(t) else t for t in texts]
            out: list[tuple] = [("", None, None)] * len(texts)
            asked = np.array([k for k, t in enumerate(texts) if t], np.int64)
            for at in batches_by_length(np.array([len(texts[k]) for k in asked], np.int64), batch, most_padded):
                for k, (sounds, error) in zip(asked[at], _answers(model, [texts[k] for k in asked[at]])):
                    out[k] = (sounds, None, error)
            uneven = {k: texts[k].split(" ") for k in asked if out[k][2] is None and out[k][0].count(" ") != texts[k].count(" ")}
            words = list(dict.fromkeys(w for found in uneven.values() for w in found))
            said = {}
            for at in batches_by_length(np.fromiter(map(len, words), np.int64, len(words)), batch, most_padded):
                said |= zip((words[k] for k in at), _answers(model, [words[k] for k in at]))
            for k, found in uneven.items():
                error = next((said[w][1] for w in found if said[w][1] is not None), None)
                out[k] = (None, None, error) if error else (out[k][0], [said[w][0] for w in found], None)
            yield pd.DataFrame(out, columns=["sounds", "word_sounds", "error"])

    # Else a filter on what the model says would ask it once more.
    return run.asNondeterministic()(text)


def encoded(samples: Column, make: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]], batch: int = 64, most_padded: int = 1 << 25, half: bool = True) -> Column:
    """An encoder on a column of samples: a struct of ``vector`` (of unit length) and ``error``.

    The model takes a matrix of waves, padded with zeros to the longest of the batch, and each one's share of that
    length, and gives a vector a row. Waves of like length are batched. Vectors are brought to unit length and, if
    ``half``, rounded to half precision; one without length, or not finite, is an error. Null and empty waves are
    no error and have no vector.
    """
    name = uuid.uuid4().hex

    @F.pandas_udf("vector array<double>, error string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(name, make)

        def ask(waves: list[np.ndarray]) -> list[np.ndarray]:
            lengths = np.array(list(map(len, waves)), np.float32)
            padded = np.zeros((len(waves), int(lengths.max())), np.float32)
            for row, wave in zip(padded, waves):
                row[: len(wave)] = wave
            return list(np.asarray(model(padded, lengths / lengths.max()), np.float64))

        for waves in (part.iloc[s] for part in parts for s in slices_of(0 if x is None else len(x) for x in part)):
            waves = [None if x is None else np.asarray(x, np.float32) for x in waves]
            out: list[tuple] = [(None, None)] * len(waves)
            asked = np.array([k for k, x in enumerate(waves) if x is not None and len(x)], np.int64)
            for at in batches_by_length(np.array([len(waves[k]) for k in asked], np.int64), batch, most_padded):
                for k, (vector, error) in zip(asked[at], _answers(ask, [waves[k] for k in asked[at]])):
                    length = 0.0 if error else float(np.linalg.norm(vector))
                    if not error and not 0 < length < np.inf:
                        error = "no vector"
                    unit = None if error else (vector / length)
                    out[k] = (unit if unit is None else unit.astype(np.float16).astype(np.float64) if half else unit, error)
            yield pd.DataFrame(out, columns=["vector", "error"])

    return run.asNondeterministic()(samples)

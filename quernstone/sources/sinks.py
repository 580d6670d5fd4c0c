"""Writing what the curation makes: tables and training lists."""

from __future__ import annotations

import contextlib
import io
import os
import re
import shutil
import uuid
import wave
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from quernstone.functions.text import normalize_marks, stem


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def clip_path(speaker: str = "speaker", key: str = "audio_file") -> Column:
    return F.concat_ws("/", F.col(speaker), F.concat(stem(F.col(key)), F.lit(".wav")))


def train_lines(df: DataFrame, min_length: int = 20) -> DataFrame:
    """``line``: clip, phonemes and speaker number, for rows with ``min_length`` phoneme characters at least."""
    rows = df.filter(F.length("phonemes") >= min_length)
    return rows.select(F.concat_ws("|", clip_path(), "phonemes", F.col("speaker_id").cast("string")).alias("line"))


def write_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """One bare line a row, of the frame's only column."""
    df.select(F.col(df.columns[0]).alias("value")).write.mode(mode).text(path)


def write_chunks(df: DataFrame, path: str, mode: str = "error") -> None:
    """``idx``, ``dur``, ``kind`` and ``text``, tab-separated: two digits at least, seconds with two places."""
    cols = (F.lpad(F.col("idx").cast("string"), 2, "0"), F.format_string("%.2fs", "dur"), F.col("kind"), F.col("text"))
    df.select(F.concat_ws("\t", *cols).alias("value")).write.mode(mode).text(path)


def rewrite_marks(df: DataFrame, path: str, column: str = "value") -> None:
    """Lines with their marks in canonical order, at another path than they were read from."""
    df.select(normalize_marks(F.col(column)).alias("value")).write.text(path)


def wav_bytes(x: np.ndarray | None, rate: int) -> bytes | None:
    """16-bit PCM WAV bytes of samples between -1 and 1; None for None."""
    if x is None:
        return None
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.asarray(x, np.float64), -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def encode_wav(samples: Column, rate: int = 24_000) -> Column:
    """``wav_bytes`` on a column: sound as a column rather than files, so that Spark writes it."""

    @F.pandas_udf("binary")
    def run(rows: pd.Series) -> pd.Series:
        return rows.map(lambda x: wav_bytes(x, rate))

    return run(samples)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its attempt's folder and the files in it."""

    folder: str
    files: int


class SoundWriter(DataSourceArrowWriter):
    """Tasks write below a folder of their attempt; the driver's commit moves the files, an abort removes them."""

    def __init__(self, path: str, rate: int, overwrite: bool):
        self.path, self.rate, self.overwrite = path, rate, overwrite
        self.job = os.path.join(path, "_temporary", uuid.uuid4().hex)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, n = os.path.join(self.job, uuid.uuid4().hex), 0
        for batch in iterator:
            for name, samples in zip(batch.column(0), batch.column(1)):
                target = os.path.join(folder, name.as_py())
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(target, "wb") as file:
                    file.write(wav_bytes(np.asarray(samples.values), self.rate))
                n += 1
        return Written(folder, n)

    def commit(self, messages: list[Written | None]) -> None:
        for message in filter(None, messages):
            for folder, _, names in os.walk(message.folder):
                to = os.path.join(self.path, os.path.relpath(folder, message.folder))
                os.makedirs(to, exist_ok=True)
                for name in names:
                    target = os.path.join(to, name)
                    if not self.overwrite and os.path.exists(target):
                        raise FileExistsError(f"{target}: two rows have this name, or it is there from before")
                    os.replace(os.path.join(folder, name), target)
        self._clean()
        open(os.path.join(self.path, "_SUCCESS"), "w").close()

    def abort(self, messages: list[Written | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        shutil.rmtree(self.job, ignore_errors=True)
        with contextlib.suppress(OSError):  # another job is still writing
            os.rmdir(os.path.dirname(self.job))


class SoundFiles(DataSource):
    """The sink ``sound_files``: one WAV file for each row of ``name`` and ``samples``, below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "sound_files"

    def writer(self, schema: StructType, overwrite: bool) -> SoundWriter:
        return SoundWriter(self.options["path"], int(self.options.get("rate", 24_000)), overwrite)


def write_sounds(df: DataFrame, path: str, speaker: str = "speaker", key: str = "audio_file", samples: str = "samples", rate: int = 24_000, mode: str = "append") -> None:
    """One 16-bit PCM WAV file a row, ``<speaker>/<stem of key>.wav`` below ``path``, a folder that all machines see.

    Rows without samples, speaker or key give no file; a slash in a speaker's name is an underscore. No file is seen
    before all are written: a task that fails leaves its files in a folder of its attempt, which nothing publishes,
    and a task that is repeated writes to another one; the commit on the driver moves what the successful attempts
    have written and then writes ``_SUCCESS``. A name that is there already, or that two rows have, is an error
    unless ``mode`` is ``overwrite``, which leaves one of them and other files alone.
    """
    path = re.sub("^file:/*", "/", path)
    if "://" in path:
        raise ValueError(f"{path}: sound files are written to a mounted folder")
    df.sparkSession.dataSource.register(SoundFiles)
    rows = df.filter(F.col(samples).isNotNull() & F.col(speaker).isNotNull() & F.col(key).isNotNull())
    folder = F.regexp_replace(F.col(speaker).cast("string"), "[/\\\\]|^[.]+$", "_")
    name = F.concat_ws("/", folder, F.concat(stem(F.col(key).cast("string")), F.lit(".wav")))
    rows.select(name.alias("name"), F.col(samples).cast("array<float>").alias("samples")).write.format("sound_files").mode(mode).option("path", path).option("rate", str(rate)).save()


def write_aligned(df: DataFrame, path: str, mode: str = "error") -> None:
    """Sentences and categories in one table, told apart by ``idx`` rather than by their lines' places."""
    df.select("idx", "text", "category").write.mode(mode).option("compression", "zstd").parquet(path)

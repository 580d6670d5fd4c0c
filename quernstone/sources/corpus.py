"""Reading a corpus: sharded Parquet with columns that may be missing, line files, lexicons, audio blobs."""

from __future__ import annotations

import io
import re
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernstone.functions.text import undiacritize

#: Columns of a corpus manifest, and of per-clip features.
MANIFEST = "audio_file string, video_id string, speaker string, shard string, start double, end double, duration double, text string, text_tashkeel string, text_tashkeel_raw string, text_cohere string, coverage double, n_words int, n_marked int, cer_yt_vs_cohere double, squim_mos double, snr_db double, music_score double, boundary_clipped boolean"
FEATURES = "audio_file string, speaker string, f0_median double, ecapa array<double>"


def shard_paths(spark: SparkSession, root: str, split: str, limit: int | None = None) -> list[str]:
    """The shards ``{split}-*.parquet`` below ``root`` in order of name, ``limit`` of them at most."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{split}-*.parquet").option("recursiveFileLookup", "true").load(root)
    names = files.select("path").orderBy("path")
    return [r.path for r in (names if limit is None else names.limit(limit)).collect()]


def shards(spark: SparkSession, root: str | list[str], split: str, schema: str | None = MANIFEST, skip_bad: bool = False) -> DataFrame:
    """The shards ``{split}-*.parquet`` below ``root`` (or of a list of paths), projected on ``schema``.

    A column that a shard, or every shard, lacks is null there. With ``skip_bad``, unreadable and vanished files
    are passed over; ``shard_audit`` tells which. Null floats stay null, NaN too: see ``measured``.
    """
    reader = spark.read.option("pathGlobFilter", f"{split}-*.parquet").option("recursiveFileLookup", "true")
    if skip_bad:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    paths = [root] if isinstance(root, str) else root
    return reader.schema(schema).parquet(*paths) if schema else reader.option("mergeSchema", "true").parquet(*paths)


def _footer(path: str) -> tuple[int | None, str | None, str | None]:
    """Rows and columns by a Parquet file's footer, or what is wrong with it; all None if its store can't be opened here."""
    try:
        store, name = pafs.FileSystem.from_uri(path if "://" in path else re.sub("^file:/*", "/", path))
    except (pa.ArrowException, ValueError, OSError):
        return None, None, None
    try:
        with store.open_input_file(name) as file:  # ranged: the length and the footer at its end are all that is read
            found = pq.read_metadata(file)
        return found.num_rows, ", ".join(f"{f.name} {f.type}" for f in found.schema.to_arrow_schema()), None
    except (pa.ArrowException, OSError) as e:
        return None, None, f"{type(e).__name__}: {e}"[:200]


def shard_audit(spark: SparkSession, root: str, split: str, schema: str = MANIFEST, tasks: int | None = None) -> DataFrame:
    """``path``, ``bytes``, ``rows``, ``columns`` and ``error`` of each shard ``{split}-*.parquet`` below ``root``.

    Footers are read in ``tasks`` tasks, by ranged access, so that large shards cost no more than small ones. An
    empty shard has 0 rows and no error; a truncated or foreign file has an error and null rows. Where the tasks
    can't open the store by themselves, rows are what Spark's own reader counts; it passes over bad files, and a
    file of which it gives no row has ``not read`` as its error. Pages are not looked into, and a file of no bytes at
    all, which Spark doesn't list, has no row here.
    """
    there = spark.read.format("binaryFile").option("pathGlobFilter", f"{split}-*.parquet").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"))
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, columns, errors = zip(*map(_footer, batch["path"])) if len(batch) else ((), (), ())
            yield batch.assign(rows=pd.array(rows, "Int64"), columns=pd.array(columns, "string"), error=pd.array(errors, "string"))

    found = there.repartition(tasks, "path").mapInPandas(run, "path string, bytes long, rows long, columns string, error string")
    counted = shards(spark, root, split, schema, skip_bad=True).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("counted"))
    same = F.regexp_replace("path", "^file:/*", "/") == F.regexp_replace("file", "^file:/*", "/")
    closed = F.col("rows").isNull() & F.col("error").isNull()
    error = F.when(closed & F.col("counted").isNull(), "not read").otherwise(F.col("error"))
    return found.join(counted, same, "left").select("path", "bytes", F.coalesce("rows", F.when(closed, F.col("counted"))).alias("rows"), "columns", error.alias("error"))


def project(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def measured(c: Column | str) -> Column:
    """The value, with NaN as null: not measured."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``file``, ``block`` (where its part of the file begins) and ``at``, which grows with the lines of a part."""
    lines = spark.read.option("lineSep", "\n").text(path)
    value = F.regexp_replace("value", r"\r\z", "")
    return lines.select(value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def indexed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``idx`` (from 0, in file order) and ``value`` of a line file; of several files, each file's lines.

    A large file is read in parts by several tasks. The parts' lines are counted first, and a line's number is the
    lines of the parts before and its place in its own; so no task sees more than a part of the file, and the
    numbers are the same however it is split. An empty file has no line.
    """
    lines = _placed_lines(spark, path)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy("file", "block").agg(F.count("*").alias("n")).select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("file", "block").orderBy("at")) - 1
    return lines.withColumn("place", place).join(starts, ["file", "block"]).select((F.col("start") + F.col("place")).cast("int").alias("idx"), "value")


def evaluation_set(spark: SparkSession, path: str) -> DataFrame:
    """``category`` and ``text`` of a tab-separated file: cut at the first tab; comments and other lines are left out."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#") & F.col("value").contains("\t"))
    parts = F.split("value", "\t", 2)
    return lines.select(F.trim(parts[0]).alias("category"), F.trim(parts[1]).alias("text"))


def scored_lines(spark: SparkSession, sentences: str, categories: str | None = None) -> DataFrame:
    """``idx``, ``ref`` and ``category`` of two line files; without the second, and beyond its end, ``all``."""
    refs = indexed_lines(spark, sentences).withColumnRenamed("value", "ref")
    if categories is None:
        return refs.withColumn("category", F.lit("all"))
    named = indexed_lines(spark, categories).withColumnRenamed("value", "category")
    return refs.join(named, "idx", "left").withColumn("category", F.coalesce("category", F.lit("all")))


def default_set(spark: SparkSession, sentences: list[str]) -> DataFrame:
    """``idx``, ``category`` (``all``) and ``text`` of sentences given in code, for want of a file."""
    return spark.createDataFrame([(k, "all", t) for k, t in enumerate(sentences)], "idx int, category string, text string")


def with_hypotheses(refs: DataFrame, hyps: DataFrame) -> DataFrame:
    """References and hypotheses of equal ``idx``; a reference without one is left out."""
    return refs.join(hyps, "idx")


def last_losses(spark: SparkSession, path: str) -> DataFrame:
    """``loss``, ``disc_loss`` and ``gen_loss`` of a log's last step line; no row if there is none."""
    lines = _placed_lines(spark, path).filter(F.col("value").rlike(r"Step \["))
    last = lines.agg(F.max_by("value", F.struct("file", "block", "at")).alias("value")).filter("value is not null")
    number = lambda name: F.regexp_extract("value", rf"{name}: ([0-9.]+)", 1)
    return last.select(*(F.when(x != "", x.cast("double")).alias(n) for n, x in (("loss", number(r"(?<!Disc )(?<!Gen )\bLoss")), ("disc_loss", number("Disc Loss")), ("gen_loss", number("Gen Loss")))))


def lexicon(spark: SparkSession, path: str | None, seed: list[str]) -> DataFrame:
    """Distinct ``word`` skeletons of a seed and of a file with a word a line and comments after ``#``."""
    words = spark.createDataFrame([(w,) for w in seed], "value string")
    if path:
        words = words.unionByName(spark.read.text(path).select(F.trim(F.split("value", "#")[0]).alias("value")))
    return words.filter("value <> ''").select(undiacritize(F.col("value")).alias("word")).distinct()


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"(?U)^\s+|\s+\z", "").alias("text"))


def setting(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The ``value`` of each ``key: value`` line of a configuration file."""
    found = F.regexp_extract("value", rf"^\s*{key}:\s*([^\s#]+)", 1)
    return spark.read.text(path).select(found.alias("value")).filter("value <> ''")


def _samples(blob: bytes | None, rate: int | None, min_samples: int, mono: bool) -> tuple[int, np.ndarray] | None:
    try:
        with wave.open(io.BytesIO(blob)) as w:
            if w.getsampwidth() != 2 or (rate and w.getframerate() != rate) or (not mono and w.getnchannels() != 1):
                return None
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768
            x = x.reshape(-1, w.getnchannels()).mean(axis=1)
            return (w.getframerate(), x) if len(x) >= min_samples else None
    except (wave.Error, EOFError, TypeError):
        return None


def decode_wav(blob: Column, rate: int | None = None, min_samples: int = 0, mix: bool = False) -> Column:
    """``rate`` and ``samples`` of 16-bit PCM WAV bytes.

    Null for bytes that don't decode, another rate than asked for, fewer samples, and several channels, unless
    ``mix`` averages them.
    """

    @F.pandas_udf("rate int, samples array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for blobs in batches:
            rows = [_samples(None if b is None else bytes(b), rate, min_samples, mix) or (None, None) for b in blobs]
            yield pd.DataFrame({"rate": pd.array([r[0] for r in rows], "Int32"), "samples": [r[1] for r in rows]})

    found = run(blob)
    return F.when(found["samples"].isNotNull(), found)


def wav_directory(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``rate`` and ``samples`` of a folder's WAV files, channels averaged."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path)
    return files.select("path", decode_wav(F.col("content"), mix=True).alias("w")).select("path", "w.rate", "w.samples")

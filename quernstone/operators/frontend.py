"""Reports on a text front-end: counters, vocabulary gaps, frequent forms, mark coverage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.checkpoints import cut_lineage
from quernstone.functions.alignment import recover_marks
from quernstone.functions.models import sounds_of
from quernstone.functions.text import KAF, QAF, as_spoken, characters, clean_phonemes, keeps_q, latin_runs, normalize_marks, normalize_text, pausal_ok, strip_final, tokens, undiacritize


def prepared(c: Column, strip: bool = False) -> Column:
    """Text as the phonemizer gets it."""
    # Bound once, since marks are looked at several times.
    text = F.get(F.transform(F.array(normalize_text(c)), normalize_marks), F.lit(0))
    return strip_final(text) if strip else text


def phonemized(rows: DataFrame, lexicon: Column, text: str = "text", sounds: str = "phonemes", word_sounds: str | None = None, dialect: bool = True) -> DataFrame:
    """``spoken``: the external phonemizer's output ``sounds`` for a prepared text, cleaned and made dialect.

    Where words and phonemes differ in number, the column ``word_sounds`` (an array with a phonemization for each
    word) is used instead, and ``misaligned`` is true. Counters come as columns, to be summed by ``counters``.
    """
    clean = clean_phonemes(F.coalesce(F.col(sounds), F.lit("")))
    rows = rows.withColumns({"_words": F.split(F.col(text), " "), "_sounds": F.split(clean, " ")})
    empty = F.coalesce(F.col(text), F.lit("")) == ""
    if not dialect:
        return rows.withColumn("spoken", F.when(empty, "").otherwise(clean)).drop("_words", "_sounds")
    alone = F.transform(F.col(word_sounds), clean_phonemes) if word_sounds else F.lit(None).cast("array<string>")
    fits = F.size("_words") == F.size("_sounds")
    rows = rows.withColumns({"_keep": keeps_q(F.col("_words"), lexicon), "_sounds": F.when(fits, F.col("_sounds")).otherwise(alone), "_fits": fits})
    counted = {
        "spoken": F.when(empty, "").otherwise(F.array_join(F.when(F.size("_words") == F.size("_sounds"), F.zip_with("_keep", "_sounds", as_spoken)), " ")),
        "misaligned": ~empty & ~F.col("_fits"),
        "n_words": F.when(empty, 0).otherwise(F.size("_words")).cast("long"),
        "n_q_words": F.size(F.filter("_words", lambda w: w.contains(QAF))).cast("long"),
        "n_q_kept": F.size(F.filter("_keep", lambda k: k)).cast("long"),
    }
    return rows.withColumns(counted).drop("_words", "_sounds", "_keep", "_fits")


def phonemize(rows: DataFrame, make_model: Callable[[], Callable[[list[str]], list[str]]], lexicon: Column, text: str = "text", dialect: bool = True, strip: bool = False, batch: int = 64) -> DataFrame:
    """``rows`` with the front-end's whole result: ``prepared``, ``spoken``, the counters of ``phonemized`` and ``error``.

    Texts are prepared, spoken by the model (see ``models.sounds_of``: made once a worker, asked in batches of
    texts of like length, word by word where it merges or splits words), cleaned and made dialect. A text that the
    model fails on has empty ``spoken``, its message in ``error``, and counts as no words; it fails no task. Null
    texts are empty. Without ``dialect`` there are no counters but ``error``.
    """
    said = rows.withColumn("prepared", prepared(F.coalesce(text, F.lit("")), strip))
    said = said.withColumn("_said", sounds_of(F.col("prepared"), make_model, batch))
    said = said.withColumns({c: F.col(f"_said.{part}") for c, part in (("_sounds_of_text", "sounds"), ("_sounds_of_words", "word_sounds"), ("error", "error"))})
    out = phonemized(said, lexicon, "prepared", "_sounds_of_text", "_sounds_of_words", dialect)
    failed = F.col("error").isNotNull()
    blank = {"spoken": F.lit(""), "misaligned": F.lit(False), "n_words": F.lit(0).cast("long"), "n_q_words": F.lit(0).cast("long"), "n_q_kept": F.lit(0).cast("long")}
    out = out.withColumns({c: F.when(failed, x).otherwise(F.col(c)) for c, x in blank.items() if c in out.columns})
    return out.drop("_said", "_sounds_of_text", "_sounds_of_words")


def counters(rows: DataFrame, source: str = "text") -> DataFrame:
    """Sums of the counters of ``phonemized`` or ``phonemize``; ``source`` is the text before it was prepared."""
    failed = F.col("error").isNotNull() if "error" in rows.columns else F.lit(False)
    return rows.agg(
        F.count("*").alias("sentences"),
        F.count_if(failed).alias("errors"),
        F.sum("n_words").alias("words"),
        F.sum("n_q_words").alias("q_words"),
        F.sum("n_q_kept").alias("q_kept"),
        F.sum(F.col("n_q_words") - F.col("n_q_kept")).alias("q_rewritten"),
        F.count_if("misaligned").alias("misaligned_sentences"),
        F.sum(latin_runs(F.col(source))).alias("latin_dropped"),
    )


def oov_count(rows: DataFrame, text: str, vocabulary: DataFrame) -> DataFrame:
    """``symbol`` and ``n`` of the characters that ``vocabulary`` (column ``symbol``) lacks, most frequent first."""
    symbols = rows.select(F.explode(F.split(F.col(text), "")).alias("symbol")).filter("symbol <> ''").groupBy("symbol").agg(F.count("*").alias("n"))
    return missing(symbols, vocabulary)


def missing(symbols: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``symbol`` and ``n`` of counted characters that ``vocabulary`` (column ``symbol``) lacks, most frequent first."""
    return symbols.join(vocabulary.select("symbol").distinct(), "symbol", "left_anti").orderBy(F.desc("n"), "symbol")


def tallied(rows: DataFrame, text: str = "spoken") -> DataFrame:
    """``misaligned``, ``symbol`` and ``n``: how often each character is in aligned and in misaligned rows of ``phonemized``.

    The empty symbol counts the rows themselves. It has all that gates ask of the rows, so that these are made and read
    once, and is as small as the alphabet; it is checkpointed.
    """
    symbols = F.concat(F.array(F.lit("")), F.coalesce(characters(F.col(text)), F.array().cast("array<string>")))
    return cut_lineage(rows.select("misaligned", F.explode(symbols).alias("symbol")).groupBy("misaligned", "symbol").agg(F.count("*").alias("n")))


def tallied_gate(tally: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``gate`` of the rows that ``tallied`` has counted."""
    symbols = tally.filter("symbol <> ''").groupBy("symbol").agg(F.sum("n").alias("n"))
    sentences = F.coalesce(F.sum("n"), F.lit(0))
    counted = tally.filter("symbol = ''").agg(F.coalesce(F.sum(F.when(F.col("misaligned"), F.col("n"))), F.lit(0)).alias("misaligned_sentences"), sentences.alias("sentences"))
    return gate(missing(symbols, vocabulary), counted)


def final_forms(rows: DataFrame, text: str, final: str = KAF, top: int = 8) -> DataFrame:
    """The most frequent skeletons of over two letters that end with ``final``."""
    skeletons = rows.select(F.explode(tokens(F.col(text))).alias("w")).select(undiacritize(F.col("w")).alias("skeleton"))
    found = skeletons.filter((F.length("skeleton") > 2) & F.col("skeleton").endswith(final))
    return found.groupBy("skeleton").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "skeleton").limit(top)


def pausal_share(rows: DataFrame, text: str) -> DataFrame:
    """Of all rows, the share with a text that has no marks to strip at its words' ends."""
    good = F.coalesce((F.col(text) != "") & pausal_ok(F.col(text)), F.lit(False))
    return rows.agg(F.count("*").alias("n"), F.count_if(good).alias("unchanged"), F.avg(good.cast("double")).alias("share"))


def coverage_report(rows: DataFrame, text: str = "text", raw: str = "text_tashkeel_raw", existing: str = "text_tashkeel", coverage: str = "coverage") -> DataFrame:
    """Mean coverage before and after recovery, and the shares of words with qaf that carry marks, old and new.

    Rows without text or raw marks don't count; words pair up by place, as far as all three texts go.
    """
    usable = rows.filter((F.coalesce(text, F.lit("")) != "") & (F.coalesce(raw, F.lit("")) != ""))
    new = usable.withColumn("_r", recover_marks(F.col(text), F.col(raw), F.col(existing)))
    words = F.arrays_zip(tokens(F.col(text)).alias("bare"), tokens(F.coalesce(existing, F.lit(""))).alias("old"), tokens(F.col("_r.text")).alias("new"))
    of_q = F.filter(words, lambda w: w["bare"].contains(QAF) & w["old"].isNotNull() & w["new"].isNotNull())
    marked = lambda c: c.rlike(r"\p{Mn}")
    per = new.select(F.coalesce(coverage, F.lit(0.0)).alias("old_cov"), F.col("_r.coverage").alias("new_cov"), of_q.alias("q"))
    per = per.select("old_cov", "new_cov", F.size("q").alias("q"), F.size(F.filter("q", lambda w: marked(w["old"]))).alias("old_q"), F.size(F.filter("q", lambda w: marked(w["new"]))).alias("new_q"))
    total = F.greatest(F.sum("q"), F.lit(1))
    return per.agg(F.count("*").alias("n"), F.avg("old_cov").alias("old_coverage"), F.avg("new_cov").alias("new_coverage"), F.sum("q").alias("q_words"), (F.sum("old_q") / total).alias("old_q_marked"), (F.sum("new_q") / total).alias("new_q_marked"))


def gate(oov: DataFrame, counted: DataFrame) -> DataFrame:
    """``oov``, ``misaligned``, ``sentences`` and ``verdict``, from the rows of ``oov_count`` and of ``counters``.

    FAIL if there is any symbol out of vocabulary, WARN if over 5 % of the sentences are misaligned, else PASS.
    """
    found = oov.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("oov")).join(F.broadcast(counted.select(F.col("misaligned_sentences").alias("misaligned"), "sentences")))
    verdict = F.when(F.col("oov") > 0, "FAIL").when(F.col("misaligned") > 0.05 * F.col("sentences"), "WARN").otherwise("PASS")
    return found.withColumn("verdict", verdict)

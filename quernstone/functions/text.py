"""Text functions on columns: normalisation, diacritics, dialect rules. All of them run in the JVM.

Java's ``\\s`` knows ASCII only, so patterns that mean any white space start with ``(?U)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the orthography.
SHADDA = "\u0651"
SHORT_MARKS = "\u064b\u064c\u064d\u064e\u064f\u0650\u0652\u0670"
TATWEEL = "\u0640"
QAF, JEEM, KAF = "\u0642", "\u062c", "\u0643"
FOLD_FROM = "\u0623\u0625\u0622\u0671\u0629\u0649"
FOLD_TO = "\u0627\u0627\u0627\u0627\u0647\u064a"
WER_PUNCTUATION = "\u060c\u061f!.,?\u061b:\"'()[]{}\u2014\u2026"
PHONEME_NOISE = "\u032a\u02e4[]{}"
PLAIN_Q, DIALECT_G = "q", "\u0261"
SURA_TRIGGERS = ("\u0633\u0648\u0631\u0647", "\u0633\u0648\u0631")


def collapse(c: Column) -> Column:
    """One space for any white space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _uncited(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\[[^\]]*\]", " "), TATWEEL, "")


def normalize_text(c: Column) -> Column:
    """Without citations in brackets, tatweel and runs of ASCII letters, white space collapsed."""
    return collapse(F.regexp_replace(_uncited(c), "[A-Za-z]+", " "))


def latin_runs(c: Column) -> Column:
    """How many runs of ASCII letters ``normalize_text`` takes out."""
    return F.regexp_count(_uncited(c), F.lit("[A-Za-z]+")).cast("long")


def normalize_marks(c: Column) -> Column:
    """Of each run of marks, the shaddas first and then the others in their order; no mark twice in a row."""
    run = f"[{SHORT_MARKS}{SHADDA}]+"
    parts = F.split(F.regexp_replace(c, f"({run})", "\u0000$1\u0000"), "\u0000")
    sorted_run = lambda x: F.concat(F.regexp_replace(x, f"[^{SHADDA}]", ""), F.replace(x, F.lit(SHADDA), F.lit("")))
    moved = F.array_join(F.transform(parts, lambda x: F.when(x.rlike(f"^{run}$"), sorted_run(x)).otherwise(x)), "")
    # Texts without a misplaced shadda, nearly all, need no parts; nor do those with the sign that parts are split by.
    moved = F.when(c.rlike(f"[{SHORT_MARKS}]{SHADDA}"), moved).otherwise(c)
    return F.regexp_replace(moved, f"([{SHORT_MARKS}{SHADDA}])\\1+", "$1")


def count_misordered(c: Column) -> Column:
    """Places where a mark stands before a shadda."""
    return F.regexp_count(c, F.lit(f"[{SHORT_MARKS}{SHADDA}]{SHADDA}")).cast("long")


def strip_final(c: Column) -> Column:
    """Words (between single spaces) without the marks that end them; a shadda there stays."""
    return F.regexp_replace(c, f"[{SHORT_MARKS}](?=[{SHORT_MARKS}{SHADDA}]*(?: |\\z))", "")


def pausal_ok(c: Column) -> Column:
    """Whether ``strip_final`` leaves the text as it is."""
    return strip_final(c) == c


def undiacritize(c: Column) -> Column:
    """The letters alone, with variants of alef, ta marbuta and alef maqsura folded."""
    return F.regexp_replace(F.translate(F.regexp_replace(c, f"[{SHORT_MARKS}{SHADDA}]", ""), FOLD_FROM, FOLD_TO), r"\p{Mn}", "")


def norm_key(c: Column) -> Column:
    """The key words are aligned by: letters alone, folded, qaf as jeem."""
    return F.translate(F.regexp_replace(c, r"\p{Mn}", ""), FOLD_FROM + QAF, FOLD_TO + JEEM)


def wer_norm(c: Column) -> Column:
    """Text as it is scored: no marks, punctuation as space, folded, white space collapsed."""
    bare = F.translate(F.regexp_replace(c, r"\p{Mn}", ""), WER_PUNCTUATION, " " * len(WER_PUNCTUATION))
    return collapse(F.translate(bare, FOLD_FROM, FOLD_TO))


def clean_phonemes(c: Column) -> Column:
    """Phonemes without syllable dots and without the signs that the vocabulary lacks."""
    return F.translate(F.regexp_replace(c, r"(?U)(?<=\S)\.(?=\S)", ""), PHONEME_NOISE, "")


def tokens(c: Column) -> Column:
    """Words between white space; none for an empty text."""
    return F.filter(F.split(collapse(c), " "), lambda x: x != "")


def characters(c: Column) -> Column:
    """Code points; none for an empty text."""
    return F.filter(F.split(c, ""), lambda x: x != "")


def token_count(c: Column, vocabulary: Column) -> Column:
    """Characters that the vocabulary (an array) has."""
    return F.size(F.filter(characters(c), lambda x: F.array_contains(vocabulary, x))).cast("long")


def previous_words(words: Column) -> Column:
    """For each word the one before; null for the first."""
    return F.transform(words, lambda _, i: F.get(words, i - 1))


def keeps_q(words: Column, lexicon: Column) -> Column:
    """For each word whether it keeps its q.

    A word with qaf does if its letters are in ``lexicon`` (an array), or if the word before introduces the name
    of a sura.
    """
    triggers = F.array(*map(F.lit, SURA_TRIGGERS))

    def one(word: Column, i: Column) -> Column:
        before = F.coalesce(F.array_contains(triggers, undiacritize(F.get(words, i - 1))), F.lit(False))
        return F.when(word.contains(QAF), F.array_contains(lexicon, undiacritize(word)) | before).otherwise(False)

    return F.transform(words, one)


def as_spoken(keeps: Column, sound: Column) -> Column:
    """A word's phonemes, with q as the dialect says it unless the word keeps it."""
    return F.when(keeps, sound).otherwise(F.replace(sound, F.lit(PLAIN_Q), F.lit(DIALECT_G)))


def dialect_rewrite(words: Column, phonemes: Column, lexicon: Column) -> Column:
    """Each word's phonemes ``as_spoken``. Null if words and phonemes differ in number."""
    return F.when(F.size(words) == F.size(phonemes), F.zip_with(keeps_q(words, lexicon), phonemes, as_spoken))


def stem(c: Column) -> Column:
    """A path's last part without its last suffix."""
    return F.regexp_extract(c, r"([^/]+?)(\.[^./]*)?$", 1)

"""Lines that many documents share are dropped: explode, hash, count, reassemble, native throughout (operator 13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import cut_lineage, free_name

#: White space that is stripped from both ends of a line.
SPACE = " \t\n\x0b\x0c\r"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The text cut at each line feed; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _folded(text: Column) -> Column:
    """ASCII capitals lowered. ``lower`` does that fast, but to texts of ASCII alone."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def _digest(line: Column) -> Column:
    """128 bits of a line's key."""
    return F.unhex(F.md5(F.btrim(line, F.lit(SPACE))))


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text") -> DataFrame:
    """``digest`` and ``n_docs`` of the keys of ``min_chars`` code points or more that ``min_docs`` rows or more have.

    A row counts once for a key, however often it has it. Keys are hashed and counted before they are shuffled, so
    a line that all documents have costs a row for each task.
    """
    keys = F.array_distinct(F.transform(lines_of(_folded(F.col(text_col))), lambda line: F.btrim(line, F.lit(SPACE))))
    lines = docs.select(F.explode(keys).alias("key")).filter(F.char_length("key") >= min_chars)
    counts = lines.groupBy(F.unhex(F.md5("key")).alias("digest")).agg(F.count("*").alias("n_docs"))
    return counts.filter(F.col("n_docs") >= min_docs)


def _without(lines: Column, places: Column) -> Column:
    """The lines but those at the sorted ``places`` (from 1), joined: what lies between two places is kept."""
    gaps = F.concat(F.array(F.lit(0)), places, F.array(F.size(lines) + 1))

    def kept(pair: Column) -> Column:
        """``pair``: lines and gaps, bound once, since they are used for each gap."""
        between = F.transform(F.sequence(F.lit(1), F.size(pair["gaps"]) - 1), lambda k: F.slice(pair["lines"], F.get(pair["gaps"], k - 1) + 1, F.get(pair["gaps"], k) - F.get(pair["gaps"], k - 1) - 1))
        return F.array_join(F.flatten(between), "\n")

    return F.get(F.transform(F.array(F.struct(lines.alias("lines"), gaps.alias("gaps"))), kept), F.lit(0))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, broadcast_lines: int = 1 << 20, text_col: str = "text") -> DataFrame:
    """All of ``docs``' columns, ``text_col`` without frequent lines, and ``n_lines`` and ``n_dropped`` (longs).

    A text is cut at line feeds. A line's key is the line without ASCII white space at its ends, ASCII capitals
    lowered. Keys of ``min_chars`` code points or more that ``min_docs`` or more documents have lose all their
    lines in every document; the others stay as they are, in order. Each row is a document of its own, equal ones
    and those that share an id or have none too. Null and empty texts have one empty line, which is never frequent
    unless ``min_chars`` is 0; of a text whose lines all go, an empty text is left, and a null stays null if its
    line does. An empty table gives none. Columns that are called ``n_lines`` or ``n_dropped`` are replaced.

    The frequent keys are written first. While they are ``broadcast_lines`` at most, of 16 bytes each, they are
    broadcast to the lines; beyond that, lines and keys are joined by digest, where a hot line is on the side that
    adaptive execution can split. Only places of dropped lines leave that join. They are gathered by the text's
    digest and a hash of the whole row, so that neither copies nor rows without id make a hot group, and meet the
    documents once.
    """
    given = docs.drop("n_lines", "n_dropped")
    names = [free_name(given, c) for c in ("_text", "_row", "_places")]
    text, row, places = names
    hashable = [c for c, kind in given.dtypes if "map<" not in kind and "variant" not in kind]
    tagged = given.withColumns({text: F.md5(F.coalesce(text_col, F.lit(""))), row: F.xxhash64(*hashable)})
    frequent = cut_lineage(frequent_lines(docs, min_docs, min_chars, text_col).select(F.col("digest").alias("frequent")))
    few = frequent.count() <= broadcast_lines
    lines = tagged.select(text, row, F.posexplode(lines_of(_folded(F.col(text_col)))).alias("pos", "line"))
    lines = lines.select(text, row, (F.col("pos") + 1).alias("pos"), _digest(F.col("line")).alias("digest"))
    hit = lines.join(F.broadcast(frequent) if few else frequent, F.col("digest") == F.col("frequent"), "left_semi")
    dropped = hit.groupBy(text, row).agg(F.sort_array(F.collect_set("pos")).alias(places))
    joined = tagged.join(dropped, [text, row], "left").withColumn(places, F.coalesce(places, F.array().cast("array<int>")))
    lines = lines_of(F.col(text_col))
    kept = F.when(F.size(places) == 0, F.col(text_col)).otherwise(_without(lines, F.col(places)))
    return joined.select(*(kept.alias(c) if c == text_col else F.col(c) for c in given.columns), F.size(lines).cast("long").alias("n_lines"), F.size(places).cast("long").alias("n_dropped"))

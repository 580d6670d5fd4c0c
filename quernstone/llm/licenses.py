"""License scan by ordered signature rules (operator 4)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType

from quernstone.llm.license_rules import RULES, Rule

#: Bytes of a word: digits, letters (capitals lowered) and all beyond ASCII; other bytes part words.
FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())
#: Rules by gate word.
GATES: dict[bytes, list[Rule]] = defaultdict(list)
for _r in RULES:
    GATES[_r.gate].append(_r)


class Detection(NamedTuple):
    """Words ``first`` to ``last`` of the text match a rule."""

    label: str
    priority: int
    first: int
    last: int
    base: bool


def detections(text: bytes | None) -> tuple[int, list[Detection]]:
    """The number of words, and what the rules find in the whole text, before any is suppressed."""
    words = (text or b"").translate(FOLD).split()
    gates = GATES.keys() & set(words)
    if not gates:
        return len(words), []
    joined = b" ".join(words)
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])
    found = []
    for gate in sorted(gates):
        for rule in GATES[gate]:
            for m in rule.pattern.finditer(joined):
                first, last = np.searchsorted(starts, (m.start(), m.end()), side="right") - 1
                found.append(Detection(rule.label, rule.priority, int(first), int(last), rule.base))
    return len(words), found


def resolve(found: Iterable[Detection]) -> list[Detection]:
    """Detections that aren't contained in one of a higher priority, or in a longer one of the same; by place.

    Rules for base phrases neither suppress nor are suppressed. Of detections of one place and priority, the
    first label by name stays. Detections that only overlap both stay.
    """
    rest = [d for d in found if not d.base]
    kept: list[Detection] = []
    # By start, and longest first, a container comes before what it contains; so one pass with the furthest end
    # so far, for each priority, tells whether a detection lies in one that is at least as good.
    furthest: dict[int, int] = {}
    for d in sorted(rest, key=lambda d: (d.first, -d.last, -d.priority, d.label)):
        if not any(p >= d.priority and end >= d.last for p, end in furthest.items()):
            kept.append(d)
        furthest[d.priority] = max(furthest.get(d.priority, -1), d.last)
    return sorted([*kept, *(d for d in found if d.base)], key=lambda d: (d.first, d.last, d.label))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All of ``docs``' columns, with what the rules find in the whole text.

    ``n_words``; ``n_base`` places of base phrases, ``first_word`` and ``last_word``, the smallest and largest of
    their first words (null if there are none), and ``base_labels``; ``labels`` of all detections that stand,
    both distinct, sorted and comma-joined; ``score``, 0 without detections and nearer to 1 the more of them and
    the higher their priorities; and ``detections`` with label, priority and first and last word.

    Words are runs of ASCII letters (capitals lowered), digits and characters beyond ASCII. A rule is tried only
    if its gate word is among the words. Null and empty texts have no words. Rows are independent: repeated ones
    have equal results, an empty table none. Columns that are called like a result are replaced.
    """
    results = StructType().add("n_words", "long").add("n_base", "long").add("first_word", "long").add("last_word", "long").add("base_labels", "string").add("labels", "string").add("score", "double")
    results = results.add("detections", ArrayType(StructType().add("label", "string").add("priority", "integer").add("first", "long").add("last", "long")))
    docs = docs.drop(*results.names)

    def row(text: bytes | None) -> tuple:
        n, found = detections(text)
        if not found:
            return n, 0, None, None, "", "", 0.0, []
        kept = resolve(found)
        base = [d for d in kept if d.base]
        doubt = np.prod([1 - d.priority / 10 for d in kept])
        spans = [{"label": d.label, "priority": d.priority, "first": d.first, "last": d.last} for d in kept]
        return n, len(base), base[0].first if base else None, base[-1].first if base else None, ",".join(sorted({d.label for d in base})), ",".join(sorted({d.label for d in kept})), float(1 - doubt), spans

    span = pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first", pa.int64()), ("last", pa.int64())])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            found = list(zip(*(row(t.as_py()) for t in texts))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found, kinds)], names=[*batch.schema.names, *results.names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *results.fields]))

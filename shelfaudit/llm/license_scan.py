"""License scan with ordered signature rules, in DataFrame operations only.

Method: the text is normalised to its words. A document that holds none of a
few stems has no detection; in the others, a rule whose prefilter literal
occurs is matched, and every match becomes a detection from its first to its
last word. Detections are resolved in order (start, then longer first, then
rule priority): one that lies within an earlier one is suppressed, so the
longer signature wins and between equal intervals the rule that stands first.
Detections that merely overlap both stay.

Base phrases are counted at all their places, whatever the rules decide, and
their labels always stay.

Scale: one pass without a shuffle; every row is worked on by itself, the rules
travel as one constant array. Rules are looked at in gated documents only.

Defined results: a null or empty text has no words and no detection; repeated
rows are scanned alike; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfaudit.llm.common import ALNUM_GAP, lower_az
from shelfaudit.llm.license_rules import RULES, STEMS, Rule

#: Phrases whose places are counted, with their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Confidence of a base phrase that no rule confirms.
BASE_CONFIDENCE = 0.8
_RULE = "array<struct<priority:int,confidence:double,label:string,literal:string,pattern:string>>"
_FOUND = "array<struct<start:int,to:int,priority:int,label:string,confidence:double>>"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _matches(padded: Column, rule: Column) -> Column:
    """Detections of one rule: words are marked where a match begins and ends, and counted off."""
    pattern = F.concat(F.lit(" ("), rule["pattern"], F.lit(")(?= )"))
    marked = F.split(F.call_function("regexp_replace", padded, pattern, F.lit(" \x01$1\x02")), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit("\x01")), i - 1)), lambda x: x.isNotNull())
    ends = F.filter(F.transform(marked, lambda w, i: F.when(F.endswith(w, F.lit("\x02")), i)), lambda x: x.isNotNull())
    return F.transform(starts, lambda s, i: F.struct(s.alias("start"), F.get(ends, i).alias("to"), rule["priority"].alias("priority"), rule["label"].alias("label"), rule["confidence"].alias("confidence")))


def _resolved(found: Column) -> Column:
    """Suppress detections contained in one before them in the order (start, longer first, priority)."""
    order = F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["to"]).alias("back"), d["priority"].alias("priority"), d["label"].alias("label"), d["confidence"].alias("confidence"))))
    empty = F.struct(F.lit(0).alias("far"), F.array().cast(_FOUND).alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        one = F.array(F.struct(d["start"].alias("start"), (-d["back"]).alias("to"), d["priority"].alias("priority"), d["label"].alias("label"), d["confidence"].alias("confidence")))
        return F.when(-d["back"] <= acc["far"], acc).otherwise(F.struct((-d["back"]).alias("far"), F.concat(acc["kept"], one).alias("kept")))

    return F.aggregate(order, empty, step, lambda acc: acc["kept"])


def license_scan(docs: DataFrame, rules: list[Rule] = RULES, base: tuple[tuple[str, str], ...] = BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels,
    detections (start, to, priority, label, confidence; words from 0, ``to`` exclusive), labels, score.

    score is the largest confidence of a detection that stays, or of a base phrase; 0 without any.
    """
    constant = json.dumps([{"priority": r.priority, "confidence": r.confidence, "label": r.label, "literal": r.literal, "pattern": r.pattern} for r in rules])
    padded = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower_az(F.col(text_col)), ALNUM_GAP, " ")), F.lit(" "))
    words = docs.select(F.col(id_col).alias("id"), padded.alias("p"))
    words = words.withColumn("n_words", F.when(F.col("p") == "  ", 0).otherwise(_spaces(F.col("p")) - 1).cast("long"))

    # the words before a place: cut where a phrase stands, the gap before it is consumed, the phrase is not
    places = [
        F.when(F.contains("p", F.lit(f" {phrase} ")), F.transform(F.split("p", f" (?={phrase} )"), _spaces)).otherwise(F.array().cast("array<int>")).alias(f"b{k}")
        for k, (phrase, _) in enumerate(base)
    ]
    cut = words.select("id", "p", "n_words", *places)
    n = [F.greatest(F.size(f"b{k}") - 1, F.lit(0)) for k in range(len(base))]
    first = [F.when(F.size(f"b{k}") > 1, F.get(f"b{k}", F.lit(0))) for k in range(len(base))]
    last = [F.when(F.size(f"b{k}") > 1, F.col("n_words") - F.element_at(f"b{k}", -1)) for k in range(len(base))]
    smallest = F.array_min(F.array(*first)) if base else F.lit(None)
    largest = F.array_max(F.array(*last)) if base else F.lit(None)
    named = F.array_distinct(F.array_sort(F.array_compact(F.array(*[F.when(F.size(f"b{k}") > 1, F.lit(label)) for k, (_, label) in enumerate(base)]))))

    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains("p", F.lit(stem))
    hit = F.filter(F.from_json(F.lit(constant), _RULE), lambda r: F.contains(F.col("p"), r["literal"]))
    found = F.flatten(F.transform(hit, lambda r: _matches(F.col("p"), r))).cast(_FOUND)
    detections = F.when(gate, _resolved(found)).otherwise(F.array().cast(_FOUND))
    out = cut.select(
        "id", "n_words", sum(n, F.lit(0)).cast("long").alias("n_base"), smallest.cast("long").alias("first_word"), largest.cast("long").alias("last_word"),
        named.alias("base"), detections.alias("detections"),
    )
    best = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    return out.select(
        "id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base").alias("base_labels"), "detections",
        F.concat_ws(",", F.array_sort(F.array_union("base", F.transform("detections", lambda d: d["label"])))).alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, BASE_CONFIDENCE).otherwise(0.0)).alias("score"),
    )

"""License scan: ordered signature rules over normalised words, in DataFrame functions only.

A text's words (A-Z lowered, punctuation dropped) are written with a space on either side of each.
A cheap test for fragments that every signature needs picks the texts to scan at all; on those, a
rule runs only where its keyword and one of its names stand. Each match becomes an interval of words. Of two intervals
where one contains the other, the better priority stays, then the longer, then the earlier rule:
one pass over the sorted intervals in each direction decides that. Everything is one projection,
with no shuffle; a row's work depends on its own text alone.

Null texts count as empty: no words, no labels, score 0. Repeated rows give repeated results.
Empty input gives no rows. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.llm.license_rules import GATES, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same characters for Spark, as an intersection of classes that Java tests quickly.
GAP = r"[\p{ASCII}&&[^\p{Alnum}]]"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = "struct<start:bigint,stop:bigint,priority:int,rule:int,label:string,score:double,base:boolean>"


def count_words(s: str) -> str:
    """SQL for the number of words in a part of a normalised text."""
    return f"cast((length({s}) - length(replace({s}, ' ', ''))) / 2 as bigint)"


RULE = "array<struct<rule:int,label:string,priority:int,score:double,keyword:string,names:array<string>,pattern:string,base:boolean>>"


def number_of_words(text: Column) -> Column:
    """Words between gaps; a gap at an end leaves an empty part there."""
    ends = sum((F.when(F.rlike(F.substr(text, at, F.lit(1)), F.lit(GAP)), 1).otherwise(0) for at in (F.lit(1), F.length(text))), F.lit(0))
    return F.when(text == "", 0).otherwise(F.greatest(F.size(F.split(text, f"{GAP}+")) - ends, F.lit(0))).cast("long")


def rule_table() -> Column:
    """All rules as one constant."""
    told = [{"rule": r.number, "label": r.label, "priority": r.priority, "score": r.score, "keyword": r.keyword, "names": r.names, "pattern": r.pattern, "base": r.base} for r in rules()]
    return F.from_json(F.lit(json.dumps(told)), RULE)


#: Matches of one rule: the words before each match, and in it, give its place.
MATCHES = f"""
aggregate(
  filter(
    zip_with(split(norm, r.pattern, -1), regexp_extract_all(norm, r.pattern, 0),
             (gap, hit) -> struct({count_words("gap")} as gap, {count_words("hit")} as size)),
    x -> x.size is not null),
  struct(cast(0 as bigint) as at, cast(array() as array<{SPAN}>) as spans),
  (acc, x) -> struct(
    acc.at + x.gap + x.size as at,
    array_append(acc.spans, struct(acc.at + x.gap as start, acc.at + x.gap + x.size as stop, r.priority as priority,
                                   r.rule as rule, r.label as label, r.score as score, r.base as base)) as spans),
  acc -> acc.spans)
"""

#: Spans in order; with equal starts the longer first, then the better priority, then the earlier rule.
ORDERED = "transform(sort_array(transform(filter(found, d -> not d.base), d -> struct(d.start as start, -d.stop as back, d.priority as priority, d.rule as rule, d as span))), x -> x.span)"

#: Drops what lies inside an earlier span of an equal or better priority. ends[p]: the furthest end so far of priorities up to p + 1.
NOT_INSIDE = f"""
aggregate(
  spans,
  struct(array_repeat(cast(-1 as bigint), 4) as ends, cast(array() as array<{SPAN}>) as kept),
  (acc, d) -> struct(
    transform(acc.ends, (e, p) -> if(p + 1 >= d.priority, greatest(e, d.stop), e)) as ends,
    if(element_at(acc.ends, d.priority) >= d.stop, acc.kept, array_append(acc.kept, d)) as kept),
  acc -> acc.kept)
"""

#: Drops what contains a later span of a better priority. Suppressed spans count too; they lost to a better one that lies around them.
NOT_AROUND = f"""
aggregate(
  reverse(spans),
  struct(array_repeat(cast({2**62} as bigint), 4) as ends, cast(array() as array<struct<start:bigint,stop:bigint,rule:int>>) as lost),
  (acc, d) -> struct(
    transform(acc.ends, (e, p) -> if(p + 1 >= d.priority, least(e, d.stop), e)) as ends,
    if(d.priority > 1 and element_at(acc.ends, greatest(d.priority - 1, 1)) <= d.stop,
       array_append(acc.lost, struct(d.start as start, d.stop as stop, d.rule as rule)), acc.lost) as lost),
  acc -> acc.lost)
"""


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, base (spans of the base phrases) and detections (spans that stay, in order)."""
    text = F.coalesce("text", F.lit(""))
    lowered = docs.select("doc_id", text.alias("text"), F.lower(text).alias("lowered"))
    gate = reduce(Column.__or__, [F.contains("lowered", F.lit(g)) for g in GATES])
    words = F.trim(F.regexp_replace(F.translate("text", UPPER, LOWER), f"{GAP}+", "  "))
    normal = lowered.select("doc_id", number_of_words(F.col("text")).alias("n_words"), F.when(gate, words).otherwise("").alias("words"))
    normal = normal.select("doc_id", "n_words", F.when(F.col("words") == "", "").otherwise(F.concat(F.lit(" "), "words", F.lit(" "))).alias("norm"), rule_table().alias("rules"))
    found = normal.select("doc_id", "n_words", F.expr(f"if(norm = '', cast(array() as array<{SPAN}>), flatten(transform(filter(rules, r -> contains(norm, r.keyword) and exists(r.names, name -> contains(norm, name))), r -> {MATCHES})))").alias("found"))
    ordered = found.select("doc_id", "n_words", F.expr("filter(found, d -> d.base)").alias("base"), F.expr(ORDERED).alias("spans"))
    judged = ordered.select("doc_id", "n_words", "base", F.expr(NOT_INSIDE).alias("kept"), F.expr(NOT_AROUND).alias("lost"))
    return judged.select("doc_id", "n_words", "base", F.expr("filter(kept, d -> not array_contains(lost, struct(d.start as start, d.stop as stop, d.rule as rule)))").alias("detections"))


def summary(scanned: DataFrame) -> DataFrame:
    """The digest of a scan: places of the base phrases, labels and a score."""
    labels = "array_join(array_sort(array_distinct(transform({}, d -> d.label))), ',')"
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.expr("array_min(transform(base, d -> d.start))").alias("first_word"),
        F.expr("array_max(transform(base, d -> d.start))").alias("last_word"),
        F.expr(labels.format("base")).alias("base_labels"),
        F.expr(labels.format("concat(base, detections)")).alias("labels"),
        F.expr("coalesce(array_max(transform(concat(base, detections), d -> d.score)), 0D)").alias("score"),
    )

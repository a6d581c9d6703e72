r"""License scans by ordered signature rules, in built-in functions only.

A text that holds a keyword of any rule is put in order: A-Z in lower case, and its words, runs of
letters, digits and anything outside ASCII, each between two blanks. Rules of which a keyword
occurs are matched there. Detections of all rules are sorted by start, longer ones first, then by
priority and rule; one whose interval lies within that of an earlier one of at least
its priority is suppressed, so `lesser general public license` is not also found as
`general public license`, and of equal intervals the first rule wins. Detections that
overlap without containment stay.

Everything happens within a row, so there is no shuffle and no group that could be
skewed. Texts without a keyword, nearly all, are only searched and counted.

Defined results: a NULL text counts as the empty text, which has no words and no labels.
The base phrases are found wherever their words stand in a row, whatever the rules say.
Repeated rows are scanned alike; a very long text is scanned whole, within its row; an empty table
gives no rows. Extra columns are kept by ``scan``, whose own columns replace columns of
the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.license_rules import RULES, Rule
from tallymart.llm.tables import NO_WORD, WORD

# The phrases of the base and their labels. Each holds `license` or `cc`, which are keywords.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PRIORITIES = (1, 2, 3)
# What the best detection of each priority is worth; a base phrase is worth as much as a name.
WORTH = {1: 0.5, 2: 0.8, 3: 1.0}
DETECTION = "struct<first:int,back:int,low:int,rule:int,label:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def spaced(phrase: str) -> str:
    """A phrase as its words stand in an ordered text."""
    return "".join(f" {word} " for word in phrase.split(" "))


def spaced_pattern(pattern: str) -> str:
    """A rule's expression over an ordered text, where two blanks part words."""
    # A blank with a question mark is a word border that may be missing within a name.
    doubled = pattern.replace(" ?", "\0").replace(" ", "  ").replace("\0", "(?:  )?")
    return f" (?:{doubled}) "


def ordered_words(text: Column) -> Column:
    """The words of a text in lower case, each between two blanks."""
    lower = F.translate(text, CAPITALS, SMALL)
    words = F.trim(F.regexp_replace(lower, f"{NO_WORD}+", "  "))
    return F.when(F.length(words) > 0, F.concat(F.lit(" "), words, F.lit(" "))).otherwise("")


def count_words(part: Column) -> Column:
    """Words of a part of an ordered text."""
    return F.floor((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2)


def rule_table(rules: Sequence[Rule]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(number).alias("rule"),
                F.lit(rule.label).alias("label"),
                F.lit(-rule.priority).alias("low"),
                F.array(*map(F.lit, rule.keywords)).alias("keywords"),
                F.lit(spaced_pattern(rule.pattern)).alias("pattern"),
            )
            for number, rule in enumerate(rules)
        )
    )


def rule_detections(words: Column, rule: Column) -> Column:
    """Every match of a rule, as an array of detections.

    The text is split at the matches; the lengths of what lies before a match tell its place.
    """
    found = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    steps = F.arrays_zip(F.split(words, rule["pattern"]).alias("part"), found.alias("match"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{DETECTION}>").alias("found"))

    def add(state: Column, step: Column) -> Column:
        first = state["at"] + F.length(step["part"])
        last = first + F.coalesce(F.length(step["match"]), F.lit(0))
        detection = F.struct(
            first.alias("first"), (-last).alias("back"), rule["low"].alias("low"),
            rule["rule"].alias("rule"), rule["label"].alias("label"),
        )
        more = F.concat(state["found"], F.array(detection))
        return F.struct(
            last.alias("at"), F.when(step["match"].isNotNull(), more).otherwise(state["found"]).alias("found")
        )

    return F.aggregate(steps, start, add, lambda state: state["found"])


def unsuppressed(detections: Column) -> Column:
    """The detections that do not lie within an earlier one of at least their priority.

    They are sorted by start, longest first, then priority and rule; for each priority the
    farthest end so far is kept.
    """
    start = F.struct(
        *(F.lit(-1).alias(f"end{p}") for p in PRIORITIES), F.array().cast(f"array<{DETECTION}>").alias("kept")
    )

    def add(state: Column, d: Column) -> Column:
        farthest = F.when(d["low"] == -1, state["end1"]).when(d["low"] == -2, state["end2"]).otherwise(state["end3"])
        ends = (
            F.when(d["low"] <= -p, F.greatest(state[f"end{p}"], -d["back"])).otherwise(state[f"end{p}"]).alias(f"end{p}")
            for p in PRIORITIES
        )
        kept = F.when(farthest >= -d["back"], state["kept"]).otherwise(F.concat(state["kept"], F.array(d)))
        return F.struct(*ends, kept.alias("kept"))

    return F.aggregate(F.array_sort(detections), start, add, lambda state: state["kept"])


def counted(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """``n``, the number of words, and ``hits``, the keywords of rules and of the base among them.

    Lower case beyond A-Z turns word characters into word characters, so it changes no
    count and hides no keyword.
    """
    keywords = sorted({word for rule in rules for word in rule.keywords} | {"license", "cc"})
    return let(
        F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n"),
            F.array_intersect(words, F.array(*map(F.lit, keywords))).alias("hits"),
        ),
    )


def detected(text: Column, hits: Column, rules: Sequence[Rule] = RULES) -> Column:
    """``words``, the ordered text if there are hits, and the detections that count, in order."""
    nothing = F.struct(F.lit("").alias("words"), F.array().cast(f"array<{DETECTION}>").alias("found"))

    def match(words: Column) -> Column:
        tried = F.filter(rule_table(rules), lambda rule: F.arrays_overlap(hits, rule["keywords"]))
        found = F.flatten(F.transform(tried, lambda rule: rule_detections(words, rule)))
        return F.struct(words.alias("words"), unsuppressed(found).alias("found"))

    return F.when(F.size(hits) > 0, let(ordered_words(text), match)).otherwise(nothing)


def scan(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All rows with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` and ``detections`` (place in the ordered text, priority and label)."""
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.withColumn("_w", counted(whole, rules)).withColumn("_n", F.col("_w.n"))
    rows = rows.withColumn("_d", detected(whole, F.col("_w.hits"), rules))
    # A phrase is found by splitting the ordered text at it.
    bases = F.array(*(F.struct(F.lit(label).alias("label"), F.lit(spaced(p)).alias("phrase"), F.lit(len(p.split(" "))).alias("n")) for p, label in BASE.items()))

    def place(base: Column) -> Column:
        return let(
            F.split(F.col("_d.words"), base["phrase"]),
            lambda parts: F.struct(
                base["label"].alias("label"),
                (F.size(parts) - 1).cast("long").alias("places"),
                count_words(parts[0]).alias("first"),
                (F.col("_n") - count_words(F.element_at(parts, -1)) - base["n"]).alias("last"),
            ),
        )

    found_bases = F.filter(F.transform(bases, place), lambda b: b["places"] > 0)
    rows = rows.withColumn("_b", F.when(F.length("_d.words") > 0, found_bases).otherwise(F.slice(found_bases, 1, 0)))
    base_labels = F.array_sort(F.array_distinct(F.transform("_b", lambda b: b["label"])))
    rule_labels = F.transform("_d.found", lambda d: d["label"])
    labels = F.array_sort(F.array_distinct(F.concat(base_labels, rule_labels)))
    best = F.greatest(F.array_max(F.transform("_d.found", lambda d: -d["low"])), F.when(F.size("_b") > 0, 1))
    score = F.lit(0.0)
    for priority in PRIORITIES:
        score = F.when(best == priority, F.lit(WORTH[priority])).otherwise(score)
    columns = {
        "n_words": F.col("_n"),
        "n_base": F.aggregate("_b", F.lit(0).cast("long"), lambda total, b: total + b["places"]),
        "first_word": F.array_min(F.transform("_b", lambda b: b["first"])),
        "last_word": F.array_max(F.transform("_b", lambda b: b["last"])),
        "base_labels": F.array_join(base_labels, ","),
        "labels": F.array_join(labels, ","),
        "score": score,
        "detections": F.transform(
            "_d.found",
            lambda d: F.struct(
                d["first"].alias("first"), (-d["back"]).alias("last"), (-d["low"]).alias("priority"), d["label"].alias("label")
            ),
        ),
    }
    return rows.select(
        *(name for name in docs.columns if name not in made), *(columns[name].alias(name) for name in made)
    )

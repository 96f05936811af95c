"""Quality rules: word statistics and a learned decision list, in DataFrame expressions only."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakeproof.llm import frames

_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"

# Bins in which thresholds are sought: rates in steps of 1/64, counts in steps of a quarter octave.
RATE_BINS = 64
COUNT_STEPS = 4

RATES = {
    "symbol_rate": ("n_symbols", "n_words"),
    "dup_line_rate": ("n_dup_lines", "n_lines"),
    "repeat_rate": ("n_repeat_words", "n_words"),
    "distinct_rate": ("n_distinct_words", "n_words"),
    "upper_rate": ("n_upper", "word_chars"),
    "exclaim_rate": ("n_exclaim", "n_words"),
    "digit_rate": ("n_digits", "word_chars"),
    "line_rate": ("n_lines", "n_words"),
}
COUNTS = ("n_words", "mean_word_chars")
FEATURES = (*RATES, *COUNTS)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for a row."""
    return F.transform(F.array(value), body)[0]


def _characters(text: Column, others: str) -> Column:
    """Number of characters left when runs of the class ``others`` are taken out."""
    return F.length(F.regexp_replace(text, others, F.lit("")))


def _repeat_words(hashes: Column) -> Column:
    """Words in windows of three that occur twice or more, from the windows' hashes in order.

    Sorting brings equal windows together, so the work is n log n however often
    they repeat; a repeated window covers three words, less those the previous
    repeated window covers already.
    """

    def covered(pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(pairs, a)["h"] == F.get(pairs, b)["h"], F.lit(False))
        places = F.array_sort(
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda k: same(k, k - 1) | same(k, k + 1)),
                lambda k: F.get(pairs, k)["at"],
            )
        )
        gaps = _let(places, lambda p: F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(x - F.get(p, k - 1), F.lit(3)))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    return F.when(repeated, _let(pairs, covered)).otherwise(F.lit(0))


def word_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts over every whole text: one row for each row of ``docs``, null texts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE, -1))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(_SPACES)) != "")

    def of_words(w: Column) -> Column:
        hashes = F.when(
            F.size(w) >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            ),
        ).otherwise(F.array().cast("array<bigint>"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
            _let(hashes, _repeat_words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )

    return source.select(
        "doc_id",
        _let(words, of_words).alias("w"),
        _let(lines, of_lines).alias("l"),
        _characters(text, _SPACE).cast("long").alias("word_chars"),
        _characters(text, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        _characters(text, r"\P{Lu}+").cast("long").alias("n_upper"),
        _characters(text, r"[^!]+").cast("long").alias("n_exclaim"),
        _characters(text, r"[^0-9]+").cast("long").alias("n_digits"),
    ).select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_upper", "n_exclaim", "n_digits")


def binned() -> dict[str, Column]:
    """Each feature as a bin number; a document without words is in bin zero."""
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    step = lambda x: F.floor(F.log2(F.lit(1.0) + x) * COUNT_STEPS)
    out = {n: F.least(F.floor(ratio(a, b) * RATE_BINS), F.lit(4 * RATE_BINS)) for n, (a, b) in RATES.items()}
    out["n_words"] = step(F.col("n_words").cast("double"))
    out["mean_word_chars"] = step(ratio("word_chars", "n_words"))
    return {n: c.cast("int") for n, c in out.items()}


@dataclass(frozen=True)
class Condition:
    """A bin of a feature at or above (``above``) or below a threshold."""

    feature: str
    above: bool
    threshold: int

    def column(self) -> Column:
        c = F.col(f"bin_{self.feature}")
        return c >= self.threshold if self.above else c < self.threshold


Rule = tuple[Condition, ...]


def matches(rule: Sequence[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


@dataclass(frozen=True)
class LearnerSettings:
    """Bounds of the learner; all labelled rows are used, none sampled."""

    max_rules: int = 8
    max_conditions: int = 3
    min_precision: float = 0.9
    min_covered: int = 5


def labelled_bins(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """(bins…, bad, prune, n): labelled documents counted by bins, label and role.

    Two thirds grow rules, one third prunes them, dealt by the hash of the id.
    """
    bins = [c.alias(f"bin_{n}") for n, c in binned().items()]
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality")).where("_quality is not null")
    role = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune")
    rows = statistics.join(known, F.col("doc_id") == F.col("_id")).select(*bins, (F.col("_quality") == 0).alias("bad"), role)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best(counts: Mapping[str, Mapping[int, list[int]]], least: int, banned: set[str]) -> tuple[float, Condition] | None:
    """The condition of highest information gain over counts of (bad, good) by feature and bin."""
    best = None
    for feature in FEATURES:
        if feature in banned:
            continue
        bins = sorted(counts.get(feature, {}).items())
        p0, n0 = sum(v[0] for _, v in bins), sum(v[1] for _, v in bins)
        p = n = 0
        for i, (b, (pos, neg)) in enumerate(bins):
            if i:
                for above, (x, y) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    gain = _gain(x, y, p0, n0)
                    if x >= least and gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, Condition(feature, above, b))
            p, n = p + pos, n + neg
    return best


def learn(bins: DataFrame, settings: LearnerSettings = LearnerSettings()) -> list[Rule]:
    """Sequential covering: grow a conjunction, prune it, take away what it covers, repeat.

    Every step is one aggregation over ``bins``; what comes back has at most one
    row for each feature, bin and label. A rule that is not precise enough on
    the rows kept for pruning is dropped, and no later rule starts with its first
    feature. Rules are for bad documents; what no rule covers is good. No labels, or labels of one kind, give no rules.
    """
    left = bins
    rules: list[Rule] = []
    banned: set[str] = set()
    stacked = F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in FEATURES]))
    while len(rules) < settings.max_rules:
        rule: list[Condition] = []
        while len(rule) < settings.max_conditions:
            counts: dict[str, dict[int, list[int]]] = {}
            found = left.where(~F.col("prune") & matches(rule)).select("bad", "n", stacked)
            for r in found.groupBy("feature", "bin", "bad").agg(F.sum("n").alias("n")).collect():
                counts.setdefault(r.feature, {}).setdefault(r.bin, [0, 0])[0 if r.bad else 1] += r.n
            total = counts.get(FEATURES[0], {}).values()
            if not sum(v[0] for v in total) or not sum(v[1] for v in total):
                break
            best = _best(counts, settings.min_covered, set() if rule else banned)
            if best is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # Prune: the prefix that separates best among the rows kept for it.
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        count = lambda r, bad: F.sum(F.when(matches(r) & (F.col("bad") == bad), F.col("n")).otherwise(0))
        row = left.where("prune").agg(
            *[count(r, b).alias(f"{'p' if b else 'n'}{k}") for k, r in enumerate(prefixes) for b in (True, False)]
        ).collect()[0]
        value = lambda k: ((row[f"p{k}"] or 0) + 1) / ((row[f"p{k}"] or 0) + (row[f"n{k}"] or 0) + 2)
        kept = max(range(len(prefixes)), key=lambda k: (value(k), -k))
        p, n = row[f"p{kept}"] or 0, row[f"n{kept}"] or 0
        if not p or p / (p + n) < settings.min_precision:
            banned.add(rule[0].feature)
            continue
        rules.append(tuple(prefixes[kept]))
        left = left.where(~matches(prefixes[kept]))
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that covers a document, from 1; 0 when none does. One ordered conditional expression."""
    if not rules:
        return F.lit(0)
    out = F.when(matches(rules[0]), F.lit(1))
    for k, rule in enumerate(rules[1:], 2):
        out = out.when(matches(rule), F.lit(k))
    return out.otherwise(F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    settings: LearnerSettings = LearnerSettings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: its statistics, base_failed, rule and kept.

    A decision list is learned from the documents that ``labels`` (doc_id,
    quality) names; ``rule`` is the number of the rule that rejects a document,
    or 0. A null or empty text has no words and fails the base. Labels that are
    null, of unknown documents, or of a null id are ignored; a repeated label or
    row counts each time. With no usable labels nothing but the base rejects.
    An empty table gives an empty result. Columns not named are not read.

    Texts are scanned once; the statistics, a few numbers for each document, are
    written to the shared folder and read for learning and for the verdict.
    """
    statistics = frames.materialise(word_statistics(docs, id_col, text_col), "quality")
    bins = frames.materialise(labelled_bins(statistics, labels), "quality-bins")
    rules = learn(bins, settings)
    return apply_rules(statistics, rules)


def apply_rules(statistics: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    judged = statistics.withColumns({f"bin_{n}": c for n, c in binned().items()})
    judged = judged.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"]
    return judged.select(*columns)


def rules_sql(rules: Sequence[Rule]) -> list[str]:
    """The rules in words, in order."""
    say = lambda c: f"bin_{c.feature} {'>=' if c.above else '<'} {c.threshold}"
    return [" AND ".join(map(say, r)) for r in rules]


def keep_good(docs: DataFrame, labels: DataFrame, settings: LearnerSettings = LearnerSettings()) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns and no others.

    The verdict is a function of the text, so it is computed in the scan of the
    texts, beside them; nothing is joined and no kept text is shuffled. Rules are
    learned from the statistics of the labelled documents alone.
    """
    known = labels.where("quality is not null").select(F.col("doc_id").alias("_id")).distinct()
    labelled = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id"), "left_semi")
    statistics = word_statistics(labelled)
    rules = learn(frames.materialise(labelled_bins(statistics, labels), "quality-bins"), settings)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id")
    whole = docs.select(row, F.col("text"))
    kept = apply_rules(word_statistics(whole), rules).where("kept")
    return kept.select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])

"""Quality rules as learned decision lists (operator 12), in DataFrame functions only.

Statistics of every text are computed once, in one projection, and stored.  The labelled rows
teach an ordered list of rules by sequential covering: a rule grows one threshold condition
at a time (the one of greatest information gain over the rows of the growing part that the
conjunction still holds), is pruned back to the prefix that separates the pruning part best,
and is taken only if both parts bear it out; the rows that it covers are set aside and the
next rule grows from the rest.

What a step of growing needs is one aggregate: the labelled rows' statistics are cut in the
middles between quantiles of both classes, and the counts by statistic, cut and label (a few
hundred numbers, whatever the table's size) give the gain of every possible condition.  The
list becomes one Spark expression, ``CASE WHEN rule 1 THEN .. WHEN rule 2 ..``, over the
stored statistics.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stored

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED = 50              # % of the words
#: Quantiles of each class between which a statistic is cut.
CUTS = 24
MOST_RULES, MOST_CONDITIONS = 16, 4
#: A rule is taken if so many of the rows it rejects are labelled bad, in both parts.
LEAST_PRECISION = 0.98
LEAST_COVERED = 5
#: Every so-many-th row (by hash of its id) prunes, the others grow.
PRUNE_ONE_IN = 3
#: Features that rules may use.
FEATURES = ("n_words", "mean_word", "symbol_share", "mark_share", "upper_share", "digit_share",
            "dup_line_share", "repeat_share", "distinct_share", "line_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of three that the text holds twice or more.  Texts
    whose windows all have different hashes are done with that; in the others the windows
    are sorted, by hash and then by the words themselves, so the count is exact."""

    def count(w: Column, hashes: Column) -> Column:
        rows = F.transform(hashes, lambda h, i: F.struct(
            h.alias("h"), F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"),
            F.get(w, i + 2).alias("c"), i.alias("at")))

        def twice(s: Column) -> Column:
            same = lambda x, y: ((x["h"] == y["h"]) & (x["a"] == y["a"])        # noqa: E731
                                 & (x["b"] == y["b"]) & (x["c"] == y["c"]))
            held = F.filter(s, lambda x, i: F.coalesce(same(x, F.get(s, i + 1)), F.lit(False))
                            | F.coalesce(same(x, F.get(s, F.when(i > 0, i - 1))), F.lit(False)))
            return _let(F.sort_array(F.transform(held, lambda x: x["at"])), covered)

        def covered(at: Column) -> Column:
            steps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p,
                                                                              F.lit(3))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return (F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long"))
                .otherwise(_let(F.sort_array(rows), twice)))

    windows = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3),        # noqa: E731
                                    lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1),
                                                         F.get(w, i + 2)))
    return _let(words, lambda w: F.when(F.size(w) < 3, F.lit(0).cast("long"))
                .otherwise(_let(windows(w), lambda h: count(w, h))))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base counts, features) of every row.  Counts of a null or empty text are 0,
    and so are the features that divide by one of them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    t = F.col("text")
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(t, "\n"), lambda x: _without(x, BLANKS) != "")
    packed = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
        repeated_words(w).alias("n_repeat_words")))
    by_line = _let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    held = lambda chars: (F.length(t) - F.length(_without(t, chars))).cast("long")
    counts = rows.select(
        "doc_id", packed.alias("w"), by_line.alias("l"),
        F.length(_without(t, BLANKS)).cast("long").alias("word_chars"),
        held(SYMBOLS).alias("n_symbols"), held("!?").alias("n_marks"),
        held("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"), held("0123456789").alias("n_digits"))
    counts = counts.select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_marks", "n_upper",
                           "n_digits")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_marks", "word_chars").alias("mark_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_distinct", "n_words").alias("distinct_share"),
        share("n_words", "n_lines").alias("line_words"))


@dataclass(frozen=True)
class Condition:
    """``feature`` is at least (``above``) or less than ``cut``."""

    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        c, t = F.col(self.feature).cast("double"), F.lit(self.cut)
        return c >= t if self.above else c < t

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction; rows that it holds are rejected."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def decide(rules: Sequence[Rule]) -> Column:
    """The first rule of the list that holds a row, as text; null: none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.column(), F.lit(str(rule))).otherwise(out)
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained by narrowing (p0 bad, n0 good) rows to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


class Learner:
    """Sequential covering over labelled statistics (a ``bad`` BOOLEAN beside the features)."""

    def __init__(self, labelled: DataFrame, features: Sequence[str] = FEATURES, cuts: int = CUTS,
                 prune_one_in: int = PRUNE_ONE_IN):
        self.features = tuple(features)
        values = [F.col(f).cast("double") for f in features]
        shares = [k / cuts for k in range(cuts + 1)]
        found = (labelled.groupBy("bad").agg(*[F.percentile_approx(v, shares, 10_000).alias(f)
                                               for f, v in zip(features, values)])).collect()
        seen = {f: sorted({x for row in found for x in (row[f] or ())}) for f in features}
        # between the values seen, so that a gap between the classes is cut in its middle
        self.cuts = {f: [(a + b) / 2 for a, b in zip(x, x[1:])] for f, x in seen.items()}
        cut_at = F.array(*[F.array(*[F.lit(x) for x in self.cuts[f]]).cast("array<double>")
                           for f in features])
        bins = F.transform(F.array(*values), lambda x, f: F.size(F.filter(
            F.get(cut_at, f), lambda t: t <= x)))
        part = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(prune_one_in)),
                          F.lit(1)) == 0
        self.rows = stored(labelled.select("bad", part.alias("prunes"), bins.alias("bins")),
                           "rules-labelled")

    def _bin(self, c: Condition) -> Column:
        """The condition over the stored bins: a value's bin is the number of cuts up to it."""
        bin_, k = F.get(F.col("bins"), F.lit(self.features.index(c.feature))), \
            self.cuts[c.feature].index(c.cut)
        return bin_ > k if c.above else bin_ <= k

    def _counts(self, rows: DataFrame) -> dict:
        """{(prunes, bad): {feature: counts by bin}}: one aggregate over the rows."""
        out = {(p, b): {f: [0] * (len(self.cuts[f]) + 1) for f in self.features}
               for p in (False, True) for b in (False, True)}
        got = (rows.select("prunes", "bad", F.posexplode("bins").alias("f", "bin"))
               .groupBy("prunes", "bad", "f", "bin").count().collect())
        for r in got:
            out[r["prunes"], r["bad"]][self.features[r["f"]]][r["bin"]] = r["count"]
        return out

    def _total(self, counts: dict, prunes: bool) -> tuple[int, int]:
        f = self.features[0]
        return sum(counts[prunes, True][f]), sum(counts[prunes, False][f])

    def _best(self, counts: dict) -> Condition | None:
        p0, n0 = self._total(counts, False)
        best, found = 1e-9, None
        for f in self.features:
            bad, good = counts[False, True][f], counts[False, False][f]
            p = n = 0
            for k, cut in enumerate(self.cuts[f]):
                p, n = p + bad[k], n + good[k]      # rows below this cut
                for above, (x, y) in ((True, (p0 - p, n0 - n)), (False, (p, n))):
                    gain = _gain(x, y, p0, n0)
                    if gain > best:
                        best, found = gain, Condition(f, above, cut)
        return found

    def _grow(self, rows: DataFrame, first: dict, most: int) -> tuple[list, list]:
        """Conditions of a new rule, and (grow p, n, prune p, n) after each of them."""
        conditions, seen, counts = [], [], first
        while len(conditions) < most:
            new = self._best(counts)
            if new is None:
                break
            conditions.append(new)
            rows = rows.filter(self._bin(new))
            counts = self._counts(rows)
            seen.append((*self._total(counts, False), *self._total(counts, True)))
            if seen[-1][1] == 0:
                break
        return conditions, seen

    def learn(self, most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS,
              least_precision: float = LEAST_PRECISION, least_covered: int = LEAST_COVERED
              ) -> list[Rule]:
        rules, rows = [], self.rows
        while len(rules) < most_rules:
            first = self._counts(rows)
            if not all(self._total(first, False)):
                break                       # one class only: nothing to tell apart
            conditions, seen = self._grow(rows, first, most_conditions)
            # pruned to the prefix that tells the pruning part's classes apart best
            worth = [((p - n) / (p + n) if p + n else -1.0, -k) for k, (_, _, p, n) in enumerate(seen)]
            if not worth:
                break
            keep = 1 - max(worth)[1]
            gp, gn, pp, pn = seen[keep - 1]
            if gp + pp < least_covered or gp < least_precision * (gp + gn) \
                    or pp < least_precision * (pp + pn):
                break
            rules.append(Rule(tuple(conditions[:keep])))
            held = self._bin(conditions[0])
            for c in conditions[1:keep]:
                held = held & self._bin(c)
            rows = rows.filter(~held)
        return rules


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
                  **options) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    rule) of every row of ``docs``.

    The rules are learned from the labelled rows (``label_col`` 0: bad, 1: good; null labels
    and null ids teach nothing; a row with several labels counts once for each) that the base
    rules keep.  ``kept`` is false where the base rules fail or a learned rule holds;
    ``rule`` names the first learned rule that holds.  Null and empty texts have counts of 0
    and fail the base rules; rows with null or repeated ids are each judged by their own
    text; without labels of both classes no rule is learned and the base rules decide alone;
    an empty table gives an empty result; other columns are ignored.
    """
    stats = stored(text_statistics(docs, id_col, text_col), "rules-statistics")
    known = labels.select(F.col(label_id).cast("long").alias("_id"),
                          (F.col(label_col) == 0).alias("bad")).filter("bad is not null")
    labelled = (stats.filter(~base_failed()).join(known, F.col("doc_id") == F.col("_id"))
                .select("doc_id", "bad", *FEATURES))
    rules = Learner(stored(labelled, "rules-known")).learn(**options)
    rule = decide(rules)
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", base_failed().alias("base_failed"),
                        (~base_failed() & rule.isNull()).alias("kept"), rule.alias("rule"))

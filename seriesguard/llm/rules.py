"""Quality rules: a learned decision list over document statistics.

Sequential covering: rules that reject are grown one after the other as conjunctions of threshold tests by information
gain on two thirds of the labelled rows that no earlier rule covers, pruned on the other third, and kept while they are
precise there. The list becomes one ordered conditional expression that Spark evaluates on every row.

Statistics cover whole texts; only a bounded sample of labelled rows comes to the driver.

Defined results: null text has no words and fails the base rule; labels that contradict each other count as the lower
quality; without labels of both kinds the list is empty and keeps everything the base rule keeps.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, packed, store, text_of, unpacked

#: Labelled rows that a list is learned from, at most.
FIT_ROWS = 40_000
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, " \
         "n_distinct long, n_digits long, n_upper long, n_stops long, longest_word long"
NAMES = [c.split()[0] for c in COUNTS.split(", ")]
#: What tests compare with thresholds: numerator and denominator.
RATIOS = {
    "n_words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"), "digit_share": ("n_digits", "word_chars"),
    "upper_share": ("n_upper", "word_chars"), "stops_per_word": ("n_stops", "n_words"), "longest_word": ("longest_word", None),
}
_UPPER = re.compile(r"[A-Z]")


def _repeated(ids: np.ndarray) -> int:
    """Words inside windows of eight that occur twice or more. Windows are ranked exactly, by doubling."""
    if len(ids) <= WINDOW:
        return 0
    ranks, width = ids, 1
    while width < WINDOW:
        pairs = ranks[:-width].astype(np.int64) * (int(ranks.max()) + 1) + ranks[width:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    again = np.bincount(ranks)[ranks] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:len(again)] += again
    edges[WINDOW:WINDOW + len(again)] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of COUNTS for a whole text."""
    if not text:
        return (0,) * len(NAMES)
    words = text.encode().split()
    places: dict[bytes, int] = {}
    ids = np.fromiter((places.setdefault(w, len(places)) for w in words), np.int64, len(words))
    seen, doubled, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            doubled += line in seen
            seen.add(line)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), doubled,
            _repeated(ids) if len(places) < len(words) else 0, lines, len(places), sum(map(text.count, "0123456789")),
            len(_UPPER.findall(text)), sum(map(text.count, ".!?")), max(map(len, places), default=0))


def document_statistics(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, counts) of every row."""
    return map_texts(docs.select(F.col(key).alias("key"), text_of(docs, text).alias("text")),
                     lambda texts: list(zip(*map(statistics, texts))), COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def ratios() -> dict[str, Column]:
    return {name: F.col(a).cast("double") if b is None else
            F.coalesce(F.col(a) / F.when(F.col(b) > 0, F.col(b)), F.lit(0.0)) for name, (a, b) in RATIOS.items()}


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, list(RATIOS).index(self.feature)]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = ratios()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Test, ...]


def _covered(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _best_test(x: np.ndarray, bad: np.ndarray) -> tuple[float, Test | None]:
    """The threshold test with the largest information gain for the bad rows."""
    base = np.log2(max(bad.sum(), 1) / max(len(bad), 1))
    best: tuple[float, Test | None] = (1e-9, None)
    for f, name in enumerate(RATIOS):
        order = np.argsort(x[:, f], kind="stable")
        values, marks = x[order, f], bad[order]
        cuts = np.flatnonzero(values[1:] > values[:-1])  # a threshold after each
        if not len(cuts):
            continue
        p, n = np.cumsum(marks)[cuts], cuts + 1
        for above, (ps, ns) in ((False, (p, n)), (True, (marks.sum() - p, len(marks) - n))):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ps > 0, ps * (np.log2(ps / ns) - base), -1.0)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), Test(name, above, float((values[cuts[i]] + values[cuts[i] + 1]) / 2)))
    return best


def learn(x: np.ndarray, bad: np.ndarray, *, most_rules: int = 16, most_tests: int = 4, precision: float = 0.95,
          least: int = 5, seed: int = 7) -> list[Rule]:
    """Ordered rejecting rules by sequential covering with growing and pruning."""
    rules: list[Rule] = []
    draw = np.random.default_rng(seed).random(len(x)) < 2 / 3
    left = np.ones(len(x), bool)
    while len(rules) < most_rules:
        grow, prune = left & draw, left & ~draw
        if bad[grow].sum() < least:
            break
        rule: Rule = ()
        inside = np.flatnonzero(grow)
        while len(rule) < most_tests and not bad[inside].all():
            _, test = _best_test(x[inside], bad[inside])
            if test is None:
                break
            rule += (test,)
            inside = inside[test.holds(x[inside])]

        def worth(r: Rule) -> float:
            c = _covered(r, x[prune])
            p, n = int(bad[prune][c].sum()), int(c.sum())
            return (p + 1) / (n + 2) if p >= precision * n and n else -1.0
        # drop last tests while the shorter rule is no worse on rows it was not grown from
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = _covered(rule, x) & left
        if not rule or worth(rule) < 0 or bad[hit].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Whether the list keeps a row: an ordered conditional expression."""
    if not rules:
        return F.lit(True)
    out: Column | None = None
    for rule in rules:
        test = rule[0].column()
        for more in rule[1:]:
            test = test & more.column()
        out = F.when(test, False) if out is None else out.when(test, False)
    return out.otherwise(True)


def _marks(labels: DataFrame, fit_rows: int) -> DataFrame:
    """(key, quality) of at most ``fit_rows`` labelled keys, the first by a hash."""
    marks = labels.select(F.col("doc_id").alias("key"), F.col("quality").alias("quality")) \
        .where("key is not null and quality is not null").groupBy("key").agg(F.min("quality").alias("quality"))
    return marks.orderBy(F.xxhash64("key"), "key").limit(fit_rows)


def fit(stats: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, **options) -> list[Rule]:
    """Learn the list from at most ``fit_rows`` labelled rows, chosen by a hash of their key."""
    # a bounded table
    rows = stats.where(~base_failed()).join(F.broadcast(_marks(labels, fit_rows)), "key") \
        .select(*[c.alias(k) for k, c in ratios().items()], "quality", "key").orderBy(F.xxhash64("key")) \
        .limit(fit_rows).toPandas()
    x = rows[list(RATIOS)].to_numpy(float)
    return learn(x, rows.quality.to_numpy() == 0, **options) if len(x) else []


def judged(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, counts, base_failed, kept) of every row."""
    stats = store(document_statistics(docs, key=key, text=text), "statistics")
    rules = fit(stats, labels, **options)
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows that the base rule and the list keep."""
    # for learning only labelled texts are counted
    some = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        F.broadcast(_marks(labels, options.get("fit_rows", FIT_ROWS)).select("key")), "key", "left_semi")
    rules = fit(store(document_statistics(some, key="key"), "statistics"), labels, **options)
    whole = packed(docs).withColumn("text", F.col("row").getField(text).cast("string"))
    counted = map_texts(whole, lambda texts: list(zip(*map(statistics, texts))), COUNTS, keep=["row"])
    return unpacked(counted.where(~base_failed() & verdict(rules)), docs.columns, {})

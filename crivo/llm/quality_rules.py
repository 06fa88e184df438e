"""Quality rules learned as a decision list over text statistics.

``text_statistics`` counts, ``learn_rules`` grows and prunes an ordered list of
threshold conjunctions by sequential covering, and ``DecisionList.condition``
writes the list as one conditional Spark expression.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crivo.sources.tables import staged

WINDOW = 5
_SPACES = " \t\n\x0b\f\r"
FEATURES = (
    "mean_word",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "distinct_share",
    "upper_share",
    "log_words",
)


def text_statistics(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and the statistics of each text; null counts as empty.

    Columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    distinct_words and upper_chars (long). Everything stays within the row: no
    shuffle, whatever a text repeats.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    step = docs.select(
        *[F.col(c).alias(c) for c in keep],
        whole.alias("_text"),
        F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    n_windows = F.size("_words") - (WINDOW - 1)
    step = step.withColumn(
        "_windows",
        F.when(
            n_windows > 1,
            F.transform(
                F.sequence(F.lit(1), n_windows),
                lambda i: F.xxhash64(*[F.element_at("_words", i + j) for j in range(WINDOW)]),
            ),
        ),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    # Windows sorted by hash stand beside their equals. Their places, in order,
    # each cover up to WINDOW words, or fewer up to the next place.
    step = step.withColumn(
        "_sorted",
        F.when(
            repeats,
            F.array_sort(
                F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    )

    def same(i: Column, j: Column) -> Column:
        return F.get("_sorted", i)["h"] == F.get("_sorted", j)["h"]

    step = step.withColumn(
        "_places",
        F.array_sort(
            F.transform(
                F.filter(
                    "_sorted",
                    lambda x, i: F.coalesce(same(i, i - 1), F.lit(False))
                    | F.coalesce(same(i, i + 1), F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")
        ),
        lambda a: a["n"],
    )

    def without(characters: str) -> Column:
        return F.length(F.translate("_text", characters, "")).cast("long")

    return step.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        without(_SPACES).alias("word_chars"),
        (F.length("_text") - without("#*$%&|<>")).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("distinct_words"),
        (F.length("_text") - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("upper_chars"),
    )


def features() -> dict[str, Column]:
    """What rules may test, as columns over the statistics."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "distinct_share": F.col("distinct_words") / words,
        "upper_share": F.col("upper_chars") / chars,
        "log_words": F.log2(words.cast("double")),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def holds(self, columns: dict[str, Column]) -> Column:
        c, limit = columns[self.feature], F.lit(self.threshold)
        return c >= limit if self.above else c < limit

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a text that meets all tests of one is rejected."""

    rules: tuple[tuple[Test, ...], ...]

    def condition(self, columns: dict[str, Column]) -> Column:
        """The number of the first rule that fits, from 1; 0 for none."""
        none = F.lit(0)
        if not self.rules:
            return none
        case = F
        for number, rule in enumerate(self.rules, 1):
            case = case.when(_all(rule, columns), F.lit(number))
        return case.otherwise(none)

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, rule)) for rule in self.rules)


def _all(rule: Sequence[Test], columns: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [t.holds(columns) for t in rule], F.lit(True))


@dataclass(frozen=True)
class RuleParams:
    """``steps``: thresholds tried per feature, quantiles of either class.
    A rule is kept while at least ``precision`` of what it rejects, on rows that
    it was not grown on, is labelled 0, and it rejects ``least_rows`` of them."""

    steps: int = 40
    most_rules: int = 8
    most_tests: int = 3
    precision: float = 0.9
    least_rows: int = 2


def learn_rules(
    labelled: DataFrame, key: str, label: str, params: RuleParams = RuleParams()
) -> DecisionList:
    """Sequential covering over rows of statistics with a 0/1 label.

    A third of the rows, by hash of their key, is kept for pruning. Each step of growing is one
    grouped count over (feature, threshold), each pruning one row of counts:
    what reaches the driver depends on the parameters alone.
    """
    own = {f: f"_{f}" for f in FEATURES}
    rows = labelled.where(F.col(label).isin(0, 1)).select(
        (F.col(label) == 0).cast("long").alias("_bad"),
        (F.pmod(F.xxhash64(key), F.lit(3)) == 0).alias("_prune"),
        *[c.alias(own[f]) for f, c in features().items()],
    )
    rows = staged(rows, "rule_rows")
    columns = {f: F.col(own[f]) for f in FEATURES}
    grid = _thresholds(rows, own, params.steps)
    grow, prune = rows.where("NOT _prune"), rows.where("_prune")
    rules: list[tuple[Test, ...]] = []
    while len(rules) < params.most_rules:
        rule = _grown(grow, columns, grid, params)
        if not rule:
            break
        rule, good = _pruned(prune, rule, columns, params)
        if not good:
            break
        rules.append(rule)
        grow, prune = grow.where(~_all(rule, columns)), prune.where(~_all(rule, columns))
    return DecisionList(tuple(rules))


def _thresholds(rows: DataFrame, own: dict[str, str], steps: int) -> dict[str, list[float]]:
    """Quantiles of the rejected and of all rows: the first resolve a rare class."""
    shares = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    found = rows.agg(
        *[F.percentile_approx(c, shares, 10_000).alias(f) for f, c in own.items()],
        *[
            F.percentile_approx(F.when(F.col("_bad") == 1, F.col(c)), shares, 10_000).alias(f"bad_{f}")
            for f, c in own.items()
        ],
    ).first()
    return {f: sorted({*(found[f] or []), *(found[f"bad_{f}"] or [])}) for f in own}


def _gain(bad: int, total: int, bad_before: int, total_before: int) -> float:
    """Information gained on the rejected rows that a test keeps."""
    if not bad:
        return float("-inf")
    return bad * (log2(bad / total) - log2(bad_before / total_before))


def _grown(rows: DataFrame, columns, grid, params: RuleParams) -> tuple[Test, ...]:
    rule: tuple[Test, ...] = ()
    while len(rule) < params.most_tests:
        inside = rows.where(_all(rule, columns))
        # How many thresholds a value reaches: one whole number for each feature.
        cells = F.array(
            *[
                F.struct(
                    F.lit(f).alias("f"),
                    (
                        F.size(F.filter(F.array(*[F.lit(t) for t in grid[f]]), lambda t: t <= c))
                        if grid[f]
                        else F.lit(0)
                    ).alias("at"),
                )
                for f, c in columns.items()
            ]
        )
        counts = (
            inside.select("_bad", F.explode(cells).alias("cell"))
            .groupBy("cell.f", "cell.at")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_bad").alias("bad"))
            .collect()
        )
        best = (0.0, None, 0, 0)
        for f in FEATURES:
            mine = {r["at"]: (r["n"], r["bad"]) for r in counts if r["f"] == f}
            total, bad = (sum(v[i] for v in mine.values()) for i in (0, 1))
            if not bad or bad == total:
                return rule
            for i, threshold in enumerate(grid[f]):
                n = sum(v[0] for at, v in mine.items() if at > i)
                b = sum(v[1] for at, v in mine.items() if at > i)
                for above, (x, y) in ((True, (b, n)), (False, (bad - b, total - n))):
                    gain = _gain(x, y, bad, total)
                    if gain > best[0] + 1e-9:
                        best = (gain, Test(f, above, threshold), x, y)
        if best[1] is None:
            return rule
        rule += (best[1],)
        if best[2] == best[3]:
            return rule
    return rule


def _pruned(rows: DataFrame, rule, columns, params: RuleParams) -> tuple[tuple[Test, ...], bool]:
    """The beginning of the rule with the best (bad - good) / (bad + good) on
    rows it has not seen, and whether that is good enough."""
    starts = [rule[:n] for n in range(1, len(rule) + 1)]
    row = rows.agg(
        *[F.count_if(_all(s, columns)).alias(f"n{i}") for i, s in enumerate(starts)],
        *[
            F.coalesce(F.sum(F.when(_all(s, columns), F.col("_bad"))), F.lit(0)).alias(f"b{i}")
            for i, s in enumerate(starts)
        ],
    ).first()
    worth = [
        ((2 * row[f"b{i}"] - row[f"n{i}"]) / row[f"n{i}"] if row[f"n{i}"] else -1.0, -i)
        for i in range(len(starts))
    ]
    i = -max(worth)[1]
    n, bad = row[f"n{i}"], row[f"b{i}"]
    return starts[i], n >= params.least_rows and bad >= params.precision * n


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    params: RuleParams = RuleParams(),
) -> tuple[DataFrame, DecisionList]:
    """Statistics, ``base_failed``, ``rule`` and ``kept`` of each row, and the list.

    ``base_failed``: under 10 words, or over a fifth of the words repeated.
    ``rule`` is the number of the first learned rule that fits, 0 for none.
    ``kept`` is false for either. The list is learned from rows that pass the
    base, with all labels; a document's labels are averaged, null ones ignored.
    Without labels, or with one class only, the list is empty.
    """
    statistics = staged(text_statistics(docs, text, [doc_id]), "statistics")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    statistics = statistics.withColumn("base_failed", failed)
    marks = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias(doc_id))
        .agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    )
    learned = learn_rules(
        statistics.where("NOT base_failed").join(staged(marks, "marks"), doc_id), doc_id, "_label", params
    )
    rule = learned.condition(features())
    judged = statistics.withColumn("rule", rule).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )
    return judged, learned

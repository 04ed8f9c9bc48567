"""Quality rules with risk-controlled thresholds, as DataFrame expressions.

The rules have a fixed path of settings from mild to severe; a setting gives every
rule its cutoff, and a document is rejected if any rule finds its feature beyond
that cutoff, so settings reject ever more. On the labelled holdout of a stratum a
setting that rejects k of n good documents is certified when the exact binomial
bound P(Bin(n, risk) <= k) is at most delta over the number of strata
(Bonferroni). Settings are tested in their fixed order, each at that whole level,
up to the first that fails: fixed-sequence testing needs no correction over the
settings. Each stratum takes its last certified setting, so that with probability
1 - delta no stratum loses more than ``risk`` of its good documents to the rules
together. It takes 86 good documents of a stratum (risk and delta 0.05, four
strata) to certify a setting that rejects none of them; below, no rule rejects.

Defined results: a NULL or empty text has no words and fails the base rules; a
NULL stratum is a stratum of its own; a doc_id labelled more than once counts
as good if any label says so; a good doc_id is one trial of its stratum however
often its row is repeated, and rejected if any of its rows is; repeated rows are
judged one by one; without labels nothing but the base rules rejects; texts of any
length are counted whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import small_side, staged

SPACE = r"[\x20\x09-\x0D]+"
RISK, DELTA = 0.05, 0.05


@dataclass(frozen=True)
class Rule:
    """``feature`` above (or, if not ``above``, below) a cutoff rejects; the
    cutoffs, one per setting, run from the mildest to the most severe."""

    name: str
    feature: str
    above: bool
    cutoffs: tuple[float, ...]


#: Features are SQL over the base counts.
RULES = (
    Rule("symbols", "n_symbols / n_words", True, (1.0, 0.5, 0.3, 0.2, 0.1, 0.05)),
    Rule("long_words", "word_chars / n_words", True, (15.0, 12.0, 10.0, 9.0, 8.0, 7.5)),
    Rule("short_words", "word_chars / n_words", False, (1.5, 2.0, 2.5, 3.0, 3.5, 3.75)),
    Rule("dup_lines", "100 * n_dup_lines / n_words", True, (10.0, 5.0, 3.0, 2.0, 1.5, 1.0)),
    Rule("repeats", "n_repeat_words / n_words", True, (0.4, 0.35, 0.3, 0.25, 0.2, 0.15)),
)


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that stand twice or more in the list. Windows
    are known by 64-bit hashes, 8 bytes each however long the words."""
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def starts(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(x["w"] == F.get(ordered, j)["w"], F.lit(False))
        return F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))

    def covered(all_windows: Column) -> Column:
        ordered = F.array_sort(F.transform(
            all_windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        at = F.transform(F.get(F.transform(F.array(ordered), starts), F.lit(0)),
                         lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.when(F.size(F.array_distinct(all_windows)) == F.size(all_windows),
                      F.lit(0)).otherwise(F.size(F.array_distinct(F.flatten(at))))

    # bound once, so that the windows are built once per text
    return F.get(F.transform(F.array(windows), covered), F.lit(0)).cast("long")


def with_base_counts(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` (one struct column ``row``) and ``f``, the base counts."""
    rows = rows.select("row", F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines", F.when(F.instr("text", "\n") > 0, lines))
    return rows.select("row", F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0))
        .cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words")).alias("f"))


def _beyond(rule: Rule, cutoff: Column) -> Column:
    """Whether the feature lies beyond the cutoff; NULL for a text without words."""
    value = F.expr(rule.feature.replace("n_words", "nullif(f.n_words, 0)")
                   .replace("n_symbols", "f.n_symbols").replace("n_dup_lines", "f.n_dup_lines")
                   .replace("n_repeat_words", "f.n_repeat_words")
                   .replace("word_chars", "f.word_chars"))
    return value > cutoff if rule.above else value < cutoff


def base_failed() -> Column:
    return (F.col("f.n_words") < 50) | (100 * F.col("f.n_repeat_words") > 50 * F.col("f.n_words"))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k < n * p, else 1 (no certificate is possible)."""
    from math import log, log1p

    step = lambda acc, j: F.struct(
        (acc["t"] + F.log((n - j) / (j + 1.0)) + F.lit(log(p) - log1p(-p))).alias("t"),
        (acc["s"] + F.exp(acc["t"])).alias("s"))
    start = F.struct((n * F.lit(log1p(-p))).alias("t"), F.lit(0.0).alias("s"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, step, lambda acc: acc["s"])
    return F.when(k < n * p, total).otherwise(F.lit(1.0))


def rejected_from(rules: tuple[Rule, ...] = RULES) -> Column:
    """Number (from 1) of the mildest setting that rejects a document, one more
    than there are settings if none does."""
    n = len(rules[0].cutoffs)
    first = [F.coalesce(*[F.when(_beyond(r, F.lit(c)), F.lit(s))
                          for s, c in enumerate(r.cutoffs, 1)], F.lit(n + 1)) for r in rules]
    return F.least(*first) if len(first) > 1 else first[0]


def certified_settings(judged: DataFrame, labels: DataFrame, risk: float = RISK,
                       delta: float = DELTA, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """stratum, n_holdout (its good documents) and setting (number of the last
    certified one, 0: none) of each stratum with good documents. ``judged`` has
    doc_id, stratum, f and rejected_from; ``labels`` doc_id and quality."""
    settings = len(rules[0].cutoffs)
    good = (labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .where("quality = 1").select("doc_id"))
    # one trial per good document and stratum
    trials = judged.where(~base_failed()).join(good, "doc_id") \
        .groupBy("doc_id", "stratum").agg(F.min("rejected_from").alias("level"))
    counts = staged(trials.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("level") <= s).alias(f"k{s}") for s in range(1, settings + 1)]),
        "rule-counts")
    level = delta / max(1, counts.count())
    passed = F.lit(0)
    for s in range(settings, 0, -1):      # a setting counts if all milder ones pass too
        p = binomial_cdf(F.col(f"k{s}"), F.col("n"), risk)
        passed = F.when(p <= level, F.lit(1) + passed).otherwise(F.lit(0))
    return counts.select("stratum", F.col("n").alias("n_holdout"),
                         passed.cast("int").alias("setting"))


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None,
          stratum: str = "lang", risk: float = RISK, delta: float = DELTA,
          rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Columns ``row`` (the chosen columns of ``docs``, all by default), ``f``
    (base counts), ``base_failed`` and ``kept``, one row per document. The
    features are computed once, into a staged table; the labels meet only its
    small columns. All rules have the same number of cutoffs."""
    wanted = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    judged = with_base_counts(docs.select(
        F.struct(F.struct(*wanted).alias("cols"), F.col("doc_id"),
                 F.col(stratum).cast("string").alias("stratum"), F.col("text"))
        .alias("row")), F.col("row.text"))
    judged = staged(judged.select(F.col("row.cols").alias("row"), "row.doc_id", "row.stratum",
                                  "f", rejected_from(rules).alias("rejected_from")),
                    "rule-features")
    settings = staged(certified_settings(
        judged.select("doc_id", "stratum", "f", "rejected_from"),
        labels.select("doc_id", "quality"), risk, delta, rules), "rule-settings")
    settings = small_side(settings.select(F.col("stratum").alias("of"), "setting"), 64)
    rejected = F.col("rejected_from") <= F.coalesce("setting", F.lit(0))
    return (judged.join(settings, F.col("stratum").eqNullSafe(F.col("of")), "left")
            .select("row", "f", base_failed().alias("base_failed"),
                    (~base_failed() & ~rejected).alias("kept")))

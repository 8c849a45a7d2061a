"""Quality by weak supervision, in DataFrame expressions only.

Ten rules, overlapping and each wrong at times, vote for or against a text or
abstain. Expectation-maximisation over the counts of all vote patterns (at most
three to the power of the rules, however many documents) estimates how often each rule is right on good and on bad
texts, and the share of good texts; the posterior probability of a good text
then replaces the demand that every rule be passed. A bounded sample of labelled
documents keeps its classes through all rounds and so fixes which class is the
good one; all other documents weigh as much as those. A rule that is often wrong
on good texts is outvoted by the others.

Defined results. A null or blank text has no words, so it fails the base
rules. Repeated rows are scored alike, each on its own. A null id is kept as
it is. An empty table gives an empty result. Columns of the input with names
used here do not clash: all measures are in one struct column. A document
labelled both ways counts as unlabelled. Where no document of one of the classes
is labelled, class balance and false alarms are bounded by assumption.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import SPACES, Scratch, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ROUNDS = 40
TOLERANCE = 1e-4
#: About so many labelled documents are used at most, chosen by a hash of their ids.
LABELLED = 10_000
#: Without labels: class balance and the most votes against that a rule may cast on good texts, as the likelihood alone
#: may take a kind of junk that breaks few rules for good.
GOOD_SHARE = 0.75
MAX_FALSE_ALARM = 0.005
#: A text is kept from this posterior probability of being good on.
KEEP_FROM = 0.5

_BREAK = r"[\x20\x09-\x0D]+"
MEASURES = "_quality_measures"
#: A line that ends as sentences, headings, quotes and lists do.
ENDED = r'[.!?:;…"”»)][\x20\x09-\x0D]*$'


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, chars, ""))).cast("long")


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the array, the first occurrence included.

    Windows are compared by 64-bit hashes. Only texts with some window twice are sorted.
    """
    def covered(at: Column) -> Column:
        """Length of the union of [p, p + window) over sorted positions."""
        start = F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(at, start, lambda acc, p: F.struct(
            (p + window).alias("until"),
            (acc["n"] + p + window - F.greatest(p, acc["until"])).cast("long").alias("n")), lambda acc: acc["n"])

    def twice(ordered: Column) -> Column:
        """Positions of the windows that equal a neighbour in the sorted array."""
        return F.transform(F.filter(ordered, lambda x, k: (
            F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["at"])

    def count(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                      _let(F.array_sort(pairs), lambda s: covered(F.array_sort(twice(s))))
                      ).otherwise(F.lit(0).cast("long"))

    def windows(word_hashes: Column) -> Column:
        first = F.slice(word_hashes, 1, F.greatest(F.size(word_hashes) - (window - 1), F.lit(0)))
        return F.transform(first, lambda h, i: F.xxhash64(h, *(F.get(word_hashes, i + k) for k in range(1, window))))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _let(windows(hashes), count))


def measures(text: Column) -> Column:
    """What the rules look at, from the whole text (null: as an empty one)."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BREAK))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    long = lambda c: c.cast("long")
    return _let(words, lambda w: _let(lines, lambda rows: F.struct(
        long(F.size(w)).alias("n_words"), long(F.length(F.array_join(w, ""))).alias("word_chars"),
        _count_of(text, r"[#*$%&|<>]").alias("n_symbols"),
        long(F.size(rows) - F.size(F.array_distinct(rows))).alias("n_dup_lines"),
        repeat_words(w).alias("n_repeat_words"), long(F.size(rows)).alias("n_lines"),
        _count_of(text, r"\p{Lu}").alias("n_capitals"), _count_of(text, "[!?]").alias("n_cries"),
        long(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))).alias("n_letter_words"),
        long(F.size(F.filter(w, lambda x: F.length(x) <= 3))).alias("n_short_words"),
        long(F.size(F.filter(w, lambda x, k: x == F.get(w, k - 1)))).alias("n_stutters"),
        long(F.size(F.filter(rows, lambda line: line.rlike(ENDED)))).alias("n_ended_lines"))))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def votes(m: Column) -> dict[str, Column]:
    """1 for the text, -1 against it, 0 to abstain, by rule. All are ratios of the whole text's counts."""
    def vote(against: Column, for_it: Column, asked: Column = F.lit(True)) -> Column:
        return (F.when(~asked, 0).when(against, -1).when(for_it, 1).otherwise(0)).cast("int")

    n, chars = m["n_words"], m["word_chars"]
    some = n >= MIN_WORDS
    loud = 10 * m["n_capitals"] > 3 * chars, 10 * m["n_cries"] > 3 * n
    quiet = (10 * m["n_capitals"] <= chars) & (20 * m["n_cries"] <= n)
    again = 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n, 2 * m["n_dup_lines"] > m["n_lines"]
    return {
        "length": vote(n < MIN_WORDS, n >= 50),
        "symbols": vote(10 * m["n_symbols"] > 3 * n, 20 * m["n_symbols"] <= n, n > 0),
        "shouting": vote(loud[0] | loud[1], quiet, some),
        "repetition": vote(again[0] | again[1], 10 * m["n_repeat_words"] <= n, some),
        "word_length": vote((chars < 2 * n) | (chars > 14 * n), (chars >= 3 * n) & (chars <= 10 * n), some),
        "mean_word": vote((chars < 4 * n) | (chars > 7 * n), (10 * chars >= 45 * n) & (chars <= 6 * n), some),
        "short_words": vote((10 * m["n_short_words"] < n) | (2 * m["n_short_words"] > n),
                            (5 * m["n_short_words"] >= n) & (5 * m["n_short_words"] <= 2 * n), some),
        "letters": vote(10 * m["n_letter_words"] < 8 * n, 20 * m["n_letter_words"] >= 19 * n, some),
        "stutter": vote(20 * m["n_stutters"] > n, 100 * m["n_stutters"] <= n, some),
        "line_ends": vote(10 * m["n_ended_lines"] < 9 * m["n_lines"], m["n_ended_lines"] == m["n_lines"], some),
    }


class Model:
    """Each rule's accuracy on good and on bad texts where it votes, and the share of good texts."""

    def __init__(self, rules: list[str], right: float = 0.8, share: float = GOOD_SHARE):
        self.rules = rules
        self.on_good = dict.fromkeys(rules, right)
        self.on_bad = dict.fromkeys(rules, right)
        self.share = share

    def values(self) -> list[float]:
        return [*self.on_good.values(), *self.on_bad.values(), self.share]

    def posterior(self, vote: dict[str, Column]) -> Column:
        """P(good | votes); an abstention says nothing."""
        odds = F.lit(math.log(self.share / (1 - self.share)))
        for r in self.rules:
            g, b = self.on_good[r], self.on_bad[r]
            odds = odds + (F.when(vote[r] == 1, math.log(g / (1 - b)))
                           .when(vote[r] == -1, math.log((1 - g) / b)).otherwise(0.0))
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, vote: dict[str, Column], n: Column, good: Column) -> Model | None:
    """The model at given counts and probabilities of good texts; None where nothing is counted.

    One aggregate that returns one row. One count is added to each side, so no accuracy reaches 0 or 1.
    """
    weight, bad = n * good, n * (1 - good)
    sums = [F.sum(n).alias("n"), F.sum(weight).alias("good")]
    for r in vote:
        sums += [F.sum(F.when(vote[r] == 1, weight)).alias(f"g1_{r}"), F.sum(F.when(vote[r] != 0, weight)).alias(f"g_{r}"),
                 F.sum(F.when(vote[r] == -1, bad)).alias(f"b1_{r}"), F.sum(F.when(vote[r] != 0, bad)).alias(f"b_{r}")]
    row = patterns.agg(*sums).first()
    if not row["n"]:
        return None
    ratio = lambda part, of: ((part or 0) + 1) / ((of or 0) + 2)
    model = Model(list(vote), share=ratio(row["good"], row["n"]))
    for r in vote:
        model.on_good[r] = ratio(row[f"g1_{r}"], row[f"g_{r}"])
        model.on_bad[r] = ratio(row[f"b1_{r}"], row[f"b_{r}"])
    return model


def fit(patterns: DataFrame, rules: list[str], label: str | None = None, weight: float = 1.0) -> Model:
    """Expectation-maximisation over a table of vote patterns and their counts ``n``, by ``label`` where there is one.

    ``label`` is 1 for good texts, 0 for bad ones and null for the others. Labelled texts keep their class; the first
    guess of the others comes from them alone, and after it another text counts as ``weight`` labelled ones.
    Without labels of both classes the first guess is that a text is most likely bad where any rule votes against it,
    and good elsewhere; the share is GOOD_SHARE, and no rule casts more than MAX_FALSE_ALARM of its votes against good texts.
    """
    vote, n = {r: F.col(r) for r in rules}, F.col("n")
    known = {r["label"]: r["n"] for r in patterns.groupBy(F.col(label).alias("label")).agg(F.sum("n").alias("n")).collect()} if label else {}
    if known.get(0) and known.get(1):
        n = F.when(F.col(label).isNull(), n * weight).otherwise(n)
        given = F.col(label).cast("double")
        model = estimate(patterns.filter(given.isNotNull()), vote, F.col("n"), given)
        good = F.coalesce(given, model.posterior(vote))
    else:
        given = F.lit(None).cast("double")
        model, good = Model(rules), F.when(F.least(*vote.values()) == -1, 0.05).otherwise(0.999)
    for _ in range(ROUNDS):
        before, found = model.values(), estimate(patterns, vote, n, good)
        if found is None:
            break
        model = found
        if not (known.get(0) and known.get(1)):
            model.share = GOOD_SHARE
            model.on_good = {r: max(1 - MAX_FALSE_ALARM, g) for r, g in model.on_good.items()}
        if max(abs(a - b) for a, b in zip(before, model.values(), strict=True)) < TOLERANCE:
            break
        good = F.coalesce(given, model.posterior(vote))
    return model


def sample_of(labels: DataFrame) -> DataFrame:
    """``label_of`` and ``label`` of about LABELLED documents at most."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select(F.col("doc_id").alias("label_of"), "quality")
    n = known.count()
    if n > LABELLED:
        known = known.filter(F.pmod(F.xxhash64("label_of"), F.lit(n)) < LABELLED)
    return (known.groupBy("label_of").agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
            .filter("label = most").drop("most"))


def score(docs: DataFrame, scratch: Scratch, text: str = "text", keep_text: bool = False,
          labels: DataFrame | None = None) -> DataFrame:
    """``docs`` (without ``text`` unless asked for) with the measures, ``base_failed``, ``posterior`` and ``kept``.

    The new values are fields of one struct column, ``MEASURES``. Texts are read once; what is measured is written.
    ``labels`` has ``quality`` (1 good, 0 bad) for some ``doc_id``.
    """
    measured = docs.withColumn(MEASURES, measures(F.col(text)))
    measured = scratch.store(measured if keep_text else measured.drop(text), "measured")
    m = F.col(MEASURES)
    vote = votes(m)
    rules = list(vote)
    label = F.lit(None).cast("int").alias("label")
    asked = measured
    if labels is not None:
        sample = sample_of(labels)
        asked, label = measured.join(F.broadcast(sample), measured["doc_id"] == sample["label_of"], "left"), sample["label"]
    patterns = scratch.store(asked.select(*(c.alias(r) for r, c in vote.items()), label)
                             .groupBy(*rules, "label").agg(F.count("*").alias("n")).coalesce(1), "patterns")
    posterior = fit(patterns, rules, "label").posterior(vote)
    return measured.withColumn(MEASURES, m.withField("base_failed", base_failed(m)).withField("posterior", posterior)
                               .withField("kept", ~base_failed(m) & (posterior >= KEEP_FROM)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, Scratch(spark, "quality"), labels=table(spark, sf_dir, "labels"))
    return scored.select("doc_id", *(F.col(f"{MEASURES}.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are kept."""
    scored = score(docs, Scratch(spark, "quality-stage"), keep_text=True, labels=table(spark, sf_dir, "labels"))
    return scored.filter(F.col(MEASURES)["kept"]).select(*docs.columns)

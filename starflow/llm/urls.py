"""URL filters: rules where they fit, gradient-boosted trees on lexical features elsewhere.

A rule is ``allow`` or ``block`` with a host and the beginning of a path. It fits its host and all
subdomains; of several that fit a url the longest decides. The urls that a rule decides are the labelled
ones: trees are trained on them and judge all others, so the lists are carried on to urls they don't name.

Features of a url: its length and its host's, the depth of the path and the number of host labels, longest
host label, shares of digits, hyphens and vowels, entropy of its characters, numbers of parameters and of
parameter characters, a fragment, an end in a slash, the scheme, and statistics over all urls: how frequent
its host, the last one and two labels of the host, the first segment of the path and the file suffix are,
and how many hosts share those labels. The statistics know nothing of labels.

Scale. Statistics are aggregates with partial sums, written, then joined by key: Spark broadcasts a small
table by its file size, and a hot key of a large one is split by adaptive execution, as both sides of the
join come straight from an exchange. The trees (``pyspark.ml``) are trained on at most about ``SAMPLE``
labelled urls, chosen by the least hashes; the model is a fixed number of trees of bounded depth. Scoring is one pass in
the JVM.

Defined results. A null url or one without ``://`` has an empty host and path, fits no rule and is judged by
the trees on its empty features. Case counts in paths, not in hosts (A-Z). Repeated urls are rows of their
own; long urls are taken whole. Without labelled urls of both kinds there is nothing to learn: all others get the one kind
there is, or ``allow``. An empty table gives an empty result. Other columns go through unchanged; the
operator's own are in one struct (``RESULT``), so that names don't clash; a column of that very name is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import Scratch, table

RESULT = "_url"
#: Labelled urls that the trees are trained on, at most (about: the bound is on the share of hashes taken).
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 4, 17


class Rule(NamedTuple):
    verdict: str   # allow or block
    host: str
    path: str      # from its first slash

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed by the data contract.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where there is no ``://``."""
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (ties: the first given), or nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):   # the last to fit wins
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits a character, from the counts of the distinct ones."""
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                       lambda acc, c: acc - F.when(c == "", 0.0).otherwise(share(c) * F.log2(share(c))))


#: What statistics are kept by, from the columns host and path.
KEYS = {"host": "host", "label1": "substring_index(host, '.', -1)", "label2": "substring_index(host, '.', -2)",
        "segment": "get(split(path, '/'), 1)", "ending": "regexp_extract(path, '[.]([A-Za-z0-9]{1,5})$', 1)"}


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features that a url has by itself."""
    u = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    labels, segments = F.filter(F.split(host, "[.]"), lambda x: x != ""), F.filter(F.split(path, "/"), lambda x: x != "")
    longest = lambda parts: F.coalesce(F.array_max(F.transform(parts, F.length)), F.lit(0))
    return {
        "length": F.length(u), "host_length": F.length(host), "path_length": F.length(path),
        "depth": F.size(segments), "labels": F.size(labels), "longest_label": longest(labels), "longest_segment": longest(segments),
        "digits": _share(u, "[^0-9]"), "path_digits": _share(path, "[^0-9]"), "hyphens": _share(host, "[^-]"),
        "vowels": _share(host, "[^aeiou]"), "entropy": _entropy(u), "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "[&;]"))), "query_length": F.length(query),
        "fragment": F.contains(u, F.lit("#")).cast("int"), "slash": F.endswith(path, F.lit("/")).cast("int"),
        "secure": F.startswith(u, F.lit("https:")).cast("int"), "www": F.startswith(host, F.lit("www.")).cast("int"),
    }


STATISTICS = ("host_share", "label1_share", "label1_hosts", "label2_share", "label2_hosts", "segment_share", "ending_share")


def _statistics(urls: DataFrame, scratch: Scratch) -> dict[str, DataFrame]:
    """For each kind of key a written table: the key, its share of all urls (logarithm), and the hosts under it."""
    hosts = scratch.store(urls.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(1)).cast("double").alias("n")).first()["n"]
    found = {}
    for kind, key in KEYS.items():
        if "path" in key:
            counts = urls.groupBy(F.expr(key).alias("key")).agg(F.count("*").alias("n"), F.lit(0).alias("hosts"))
        else:   # from one row per host
            counts = hosts.groupBy(F.expr(key).alias("key")).agg(F.sum("n").alias("n"), F.count("*").alias("hosts"))
        made = counts.where(F.col("key").isNotNull()).select(
            F.col("key").alias(f"{kind}_key"), F.log2(F.col("n") / total).alias(f"{kind}_share"),
            F.log2(F.col("hosts") + 1.0).alias(f"{kind}_hosts"))
        found[kind] = scratch.store(made, f"by_{kind}")
    return found


def features(df: DataFrame, url: Column, rules: Sequence[Rule], scratch: Scratch) -> tuple[DataFrame, list[str]]:
    """Rows of ``df`` in the struct ``row``, with url, host, path, rule, label and the features; the features' names."""
    host, path = host_and_path(F.col("url"))
    base = df.select(F.struct(*df.columns).alias("row"), url.alias("url")).withColumns({"host": host, "path": path})
    name, verdict = ruled(F.col("host"), F.col("path"), rules)
    own = lexical(F.col("url"), F.col("host"), F.col("path"))
    out = base.withColumns({"rule": name, "label": verdict} | {k: c.cast("double") for k, c in own.items()})
    for kind, stats in _statistics(base.select("host", "path"), scratch).items():
        out = out.join(stats, F.expr(KEYS[kind]) == F.col(f"{kind}_key"), "left")
    known = {c: F.coalesce(F.col(c), F.lit(1.0)) for c in STATISTICS}   # 1 is no share's logarithm: no such key
    return out.withColumns(known), [*own, *STATISTICS]


def labelled_sample(made: DataFrame, names: Sequence[str], scratch: Scratch, size: int = SAMPLE) -> DataFrame | None:
    """Different labelled urls, about ``size / 2`` of each label at most, weighted back to the labels' shares.

    They are those with the least hashes, in one written part in a fixed order, so that equal tables give
    equal trees. None without both labels.
    """
    counts = {r["label"]: r["n"] for r in made.groupBy("label").agg(F.count("*").alias("n")).collect() if r["label"]}
    if len(counts) < 2:
        return None
    share = {v: min(1.0, size / 2 / n) for v, n in counts.items()}
    of = lambda kind: F.when(F.col("label") == "block", kind["block"]).otherwise(kind["allow"])
    taken = made.where(F.col("label").isNotNull() & (F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < of(share) * (1 << 30)))
    chosen = (taken.select("url", "label", *names).dropDuplicates(["url"])
              .withColumn("block", (F.col("label") == "block").cast("double")).withColumn("weight", 1 / of(share)))
    return scratch.store(chosen.repartition(1).sortWithinPartitions(F.xxhash64("url"), "url"), "sample")


def train(sample: DataFrame, names: Sequence[str]) -> GBTClassificationModel:
    """Boosted trees for ``block`` (0 or 1) from the features, weighted by ``weight``."""
    rows = VectorAssembler(inputCols=list(names), outputCol="features").transform(sample)
    return GBTClassifier(labelCol="block", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=SEED,
                         checkpointInterval=-1).fit(rows)


def score(made: DataFrame, names: Sequence[str], model: GBTClassificationModel) -> DataFrame:
    """``made`` with ``p_block``, the trees' probability that a url is one to block."""
    rows = VectorAssembler(inputCols=list(names), outputCol="features").transform(made)
    return model.transform(rows).withColumn("p_block", vector_to_array("probability")[1])


def judge(df: DataFrame, url: Column, rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``df`` with the struct ``RESULT``: host, path, rule, verdict (allow or block), and the trees' p_block (or null)."""
    scratch = Scratch(df.sparkSession, "urls")
    df = df.drop(RESULT)
    made, names = features(df, url, rules, scratch)
    labelled = labelled_sample(made, names, scratch, sample)
    if labelled is None:
        only = made.agg(F.coalesce(F.max("label"), F.lit("allow")).alias("label")).first()["label"]
        judged = made.withColumns({"p_block": F.lit(None).cast("double"), "learned": F.lit(only)})
    else:
        judged = score(made, names, train(labelled, names))
        judged = judged.withColumn("learned", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return judged.select("row.*", F.struct("host", "path", "rule", F.coalesce("label", "learned").alias("verdict"),
                                           "p_block").alias(RESULT))


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, F.col("url")).select("page_id", *(F.col(f"{RESULT}.{c}") for c in ("host", "path", "rule", "verdict")))

"""URL filters: rules for hosts and paths, and a classifier for what no rule decides.

Method: logistic regression on hashed character n-grams of host and path, trained from a small
labelled URL table. Everything is DataFrame functions; the weights are one array of fixed length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lengths of the character n-grams, and the number of hash buckets.
GRAMS = (3, 4)
BUCKETS = 2048
#: Labelled URLs that the classifier is trained on, at most; which ones is decided by a hash.
LABELLED_ROWS = 4000

ALLOW, BLOCK = "allow", "block"

#: Words that the hosts of the labelled URLs are made of.
UNWANTED = (
    "casino poker slots bet bets betting gamble jackpot lottery pills pharma viagra adult porn xxx sex cams escort loan loans payday"
    " torrent warez crack keygen replica cheap spam free win winner prize bonus hack"
).split()
WANTED = (
    "news library school museum science garden history music recipes travel weather health code docs wiki forum books city sports"
    " photo art university journal review study nature family design energy research"
).split()
SYLLABLES = "an be co da en er fi go ha he in jo ka le mo na nd on or pa re sa sh st th ti un va we wh".split()
#: Labelled URLs that ``labelled_urls`` makes of them.
EXAMPLES = 3000


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, then a path that begins with ``/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: list[Rule], host: Column, path: Column) -> Column:
    """The text of the longest rule that fits: its host or a subdomain of it, and the path's start."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        at = (host == rule.host) | host.endswith("." + rule.host)
        fits = F.when(at & path.startswith(rule.path), F.lit(rule.text)).otherwise(fits)
    return fits


def grams(host: Column, path: Column) -> Column:
    """The hash buckets of the distinct n-grams; host and path are hashed apart."""
    def of(text: Column, kind: str) -> list[Column]:
        # Characters as an array that a lambda holds: it is made once a text, and no place in it is counted out.
        held = F.array(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""))

        def of_length(n: int) -> Column:
            def bucket(letters: Column, i: Column) -> Column:
                gram = F.array_join(F.slice(letters, i, F.lit(n)), "")
                return F.pmod(F.xxhash64(F.lit(kind), gram), F.lit(BUCKETS)).cast("int")

            def all_of(letters: Column) -> Column:
                places = F.sequence(F.lit(1), F.greatest(F.size(letters) - (n - 1), F.lit(1)))
                return F.transform(places, lambda i: bucket(letters, i))

            return F.flatten(F.transform(held, all_of))

        return [of_length(n) for n in GRAMS]

    return F.array_distinct(F.flatten(F.array(*of(host, "host"), *of(path, "path"))))


@dataclass
class UrlModel:
    """Weights by bucket; a URL is allowed if their mean over its n-grams and the bias are above 0."""

    weights: list[float]
    bias: float

    def score(self, buckets: Column) -> Column:
        table = F.lit(self.weights)
        total = F.aggregate(buckets, F.lit(0.0), lambda s, i: s + F.get(table, i))
        return total / F.sqrt(F.greatest(F.size(buckets), F.lit(1))) + F.lit(self.bias)


def labelled_urls(spark: SparkSession, first: int = 0, count: int = EXAMPLES) -> DataFrame:
    """``(url, allowed)``: a small labelled table, made by rule from the words above.

    A third of the hosts have an unwanted word among others, a third are of wanted words and a third
    of syllables. Row ``i`` is always the same; ``first`` chooses other rows of the same kind.
    """
    def pick(words: list[str], salt: str) -> Column:
        at = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(words))).cast("int")
        return F.get(F.array(*[F.lit(w) for w in words]), at)

    syllables = F.concat(pick(SYLLABLES, "a"), pick(SYLLABLES, "b"), pick(SYLLABLES, "c"))
    other = F.when(pick(["0", "1", "2"], "o") == "0", pick(UNWANTED, "u2")).when(pick(["0", "1"], "p") == "0", pick(WANTED, "w2")).otherwise(pick([*"xyz"], "x"))
    swapped = pick(["0", "1"], "s") == "0"
    bad = F.when(swapped, F.concat_ws("-", other, pick(UNWANTED, "u"))).otherwise(F.concat_ws("-", pick(UNWANTED, "u"), other))
    good = F.concat(pick(WANTED, "w"), pick(["", "-", "-"], "j"), pick(WANTED, "w3"))
    kind = F.col("id") % 3
    name = F.when(kind == 0, bad).when(kind == 1, good).otherwise(syllables)
    host = F.concat(pick(["", "www.", "m.", "blog."], "h"), name, pick([".example", ""], "e"), pick([".com", ".org", ".net"], "t"))
    path = F.concat(F.lit("/"), pick(["en", "de", "fr", "es", "a"], "l"), F.lit("/"), F.pmod(F.xxhash64("id", F.lit("n")), F.lit(10_000)).cast("string"))
    path = F.concat(path, pick(["", "/", ".html"], "f"))
    return spark.range(first, first + count).select(F.concat(pick(["http://", "https://"], "y"), host, path).alias("url"), (kind != 0).alias("allowed"))


def train(labelled: DataFrame) -> UrlModel:
    """Learn from ``labelled(url, allowed)``; at most ``LABELLED_ROWS`` distinct URLs are used.

    Rows without a URL or label are left out. Labels of one kind only give that verdict for all, and
    no labels at all allow everything.
    """
    rows = (
        labelled.where("url is not null and allowed is not null")
        .groupBy("url")
        .agg(F.max(F.col("allowed").cast("int")).cast("double").alias("label"))
        .orderBy(F.xxhash64("url"), "url")
        .limit(LABELLED_ROWS)
    )
    url = F.col("url")
    buckets = grams(host_of(url), path_of(url))
    ready = rows.select("label", buckets.alias("b")).select(
        "label",
        array_to_vector(
            F.transform(
                F.sequence(F.lit(0), F.lit(BUCKETS - 1)),
                lambda i: F.when(F.array_contains("b", i), 1 / F.sqrt(F.size("b"))).otherwise(0.0),
            )
        ).alias("features"),
    ).persist()
    kinds = [r["label"] for r in ready.select("label").distinct().collect()]
    if len(kinds) < 2:
        ready.unpersist()
        return UrlModel([0.0] * BUCKETS, -1.0 if kinds == [0.0] else 1.0)
    model = LogisticRegression(regParam=1e-5, maxIter=100, standardization=False).fit(ready)
    ready.unpersist()
    return UrlModel([float(x) for x in model.coefficients.toArray()], float(model.intercept))


def judge(pages: DataFrame, rules: list[Rule], model: UrlModel | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (its text or NULL), ``verdict`` and ``score``.

    The longest rule that fits decides, else the classifier. ``model``: by default trained on
    ``labelled_urls``; ``train`` makes one of any labelled table. A NULL url, or one without ``://``, has an empty
    host and path and is judged like any other; whole urls count, however long; repeated rows are judged each; an empty table gives
    an empty one. Columns of those names are replaced, others are kept.
    """
    url = F.col("url").cast("string")
    host, path = host_of(url), path_of(url)
    verdicts = {r.text: r.verdict for r in rules}
    decided = F.create_map(*[F.lit(x) for pair in verdicts.items() for x in pair]) if rules else None
    found = rule_for(rules, host, path)
    model = model or train(labelled_urls(pages.sparkSession))
    score = model.score(grams(host, path))
    judged = F.when(score > 0, F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    by_rule = decided[found] if decided is not None else F.lit(None).cast("string")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    return pages.select(
        *kept, host.alias("host"), path.alias("path"), found.alias("rule"), F.coalesce(by_rule, judged).alias("verdict"), score.alias("score")
    )

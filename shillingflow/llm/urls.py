"""URL filter: host and path rules, and boosted trees on lexical features where no rule fits.

Everything is column expressions and MLlib, so no Python runs on the executors. The trees learn
from the urls that the rules decide; what they see of a url is its shape (length, depth, digits,
entropy, parameters) and how often the urls under its host's last labels were blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_out

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIT_ROWS = 20_000  # labelled urls that the trees are fitted on, about
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digit_ratio", "mark_ratio", "entropy", "host_entropy",
            "n_params", "has_fragment", "last_block", "last_seen", "last2_block", "last2_seen"]


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path``; both are empty for a null url and one without ``://``."""
    rest = F.coalesce(F.regexp_extract("url", r"^(?s:.*?)://((?s:.*))$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def with_rule(parts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule that fits, else nulls.

    A rule fits its host and every subdomain when the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return parts.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    size = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")),
                         lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    bits = F.aggregate(F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda s, p: s - p * F.log2(p))
    return F.when(size > 0, bits).otherwise(0.0)


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _last(n: int) -> Column:
    return F.substring_index("host", ".", -n)


def lexical(parts: DataFrame) -> DataFrame:
    """The url's own features and its host's last one and two labels."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    own = {
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": _without(F.col("path"), "/"), "labels": _without(F.col("host"), "[.]"),
        "digit_ratio": _without(url, "[0-9]") / size, "mark_ratio": _without(url, "[^A-Za-z0-9]") / size,
        "entropy": _entropy(url), "host_entropy": _entropy(F.col("host")),
        "n_params": F.when(query == "", 0).otherwise(_without(query, "&") + 1),
        "has_fragment": F.when(url.contains("#"), 1).otherwise(0),
    }
    return parts.withColumns({k: v.cast("double") for k, v in own.items()} | {"last": _last(1), "last2": _last(2)})


def suffix_statistics(labelled: DataFrame, name: str) -> DataFrame:
    """Blocked share (with one blocked and one allowed url added) and number of labelled urls per suffix."""
    blocked = F.sum(F.when(F.col("rule_verdict") == "block", 1).otherwise(0))
    n = F.count(F.lit(1))
    return labelled.groupBy(name).agg(((blocked + 1) / (n + 2)).alias(f"{name}_block"), F.log1p(n.cast("double")).alias(f"{name}_seen"))


def with_suffix(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Joins the statistics; a busy suffix is one aggregated row, and the join's large side may be split."""
    for name in ("last", "last2"):
        rows = rows.join(suffix_statistics(labelled, name), name, "left").fillna({f"{name}_block": 0.5, f"{name}_seen": 0.0})
    return rows


def draw(labelled: DataFrame, share: float, seed: int) -> DataFrame:
    """``url, rule_verdict, weight``: a share of the rows, equal urls as one row of their number's share.

    The hash of a url only rounds its share up or down, so a url that many rows hold is neither left
    out nor taken whole."""
    slot = F.pmod(F.xxhash64(F.lit(seed), "url"), F.lit(1 << 20)) / F.lit(1 << 20)
    counted = labelled.groupBy("url", "rule_verdict").agg(F.count(F.lit(1)).alias("copies"))
    return counted.select("url", "rule_verdict", F.ceil(F.col("copies") * F.lit(share) - slot).cast("double").alias("weight")).filter("weight > 0")


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, trees: int = 12, depth: int = 4, seed: int = 7):
    """Boosted trees from about ``fit_rows`` of the labelled rows, drawn by hash; null without two classes."""
    counts = {r["rule_verdict"]: r["count"] for r in labelled.groupBy("rule_verdict").count().collect()}
    if len(counts) < 2:
        return None
    share = min(1.0, fit_rows / sum(counts.values()))
    chosen = lexical(with_parts(draw(labelled, share, seed)))
    chosen = with_suffix(chosen, labelled).select(*FEATURES, "weight", F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0).alias("label"))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(write_out(chosen, "url-sample"))
    return GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, seed=seed, weightCol="weight").fit(data.select("features", "label", "weight"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Adds ``host, path, rule, verdict, score`` (the score is the trees' blocked class, 0 or 1; null for ruled urls).

    Null and malformed urls have empty parts and are judged by their shape. Without two classes of
    labelled urls there is nothing to learn and the remaining urls get the only class seen, or ``allow``.
    Repeated rows are judged alike; columns of the added names are replaced, all others stay.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    others = F.struct(*[F.col(c) for c in own]).alias("row")
    kept = with_rule(with_parts(pages.select(others, "url")), rules)
    labelled = lexical(kept.filter("rule_verdict is not null").drop("row"))
    model = fit(labelled, fit_rows)
    shape = ["row.*", "host", "path", "rule", "verdict", "score"]
    nothing = F.lit(None).cast("double")
    if model is None:
        seen = labelled.select("rule_verdict").first()
        return kept.withColumn("verdict", F.coalesce("rule_verdict", F.lit(seen[0] if seen else "allow"))).withColumn("score", nothing).select(*shape)
    open_rows = with_suffix(lexical(kept.filter("rule_verdict is null")), labelled)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(open_rows))
    scored = scored.withColumn("verdict", F.when(F.col("prediction") > 0.5, "block").otherwise("allow")).withColumn("score", F.col("prediction"))
    ruled = kept.filter("rule_verdict is not null").withColumn("verdict", F.col("rule_verdict")).withColumn("score", nothing)
    return ruled.select(*shape).unionByName(scored.select(*shape))


def op7(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")

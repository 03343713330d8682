"""URL filtering by a rule list and by association rules mined from labelled URLs.

Spark's FP-growth finds token combinations that come with a bad label; rules below the support or
confidence are pruned, as are rules that a shorter one already covers. Each rule left is posted
under its rarest token only, and a URL meets the rules of its tokens by a join, so a common token
draws no rules unless it is the rarest of one.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.text import filled, lower_ascii
from riskframe.session import cut_lineage

MIN_SUPPORT = 0.005       # share of the labelled URLs a combination with the label must have
MIN_CONFIDENCE = 0.8      # share of the URLs with the combination that are labelled bad
BAD = "label=bad"         # no token has an equals sign

ListRule = tuple[str, str, str]      # host, path, verdict


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(_after(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; empty without `://`."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: host labels as `label@`, the rest as it stands."""
    host = F.transform(F.split(host_of(url), r"\."), lambda x: F.concat(x, F.lit("@")))
    rest = F.split(lower_ascii(F.substr(_after(url), F.length(host_of(url)) + 1, F.length(url))), r"[/?#&.=]+")
    return F.array_distinct(F.array_remove(F.array_remove(F.concat(host, rest), ""), "@"))


def fits(host: Column, path: Column, rule: ListRule) -> Column:
    """Whether a rule holds for a host, as itself or a subdomain, and a path."""
    return ((host == rule[0]) | F.endswith(host, F.lit("." + rule[0]))) & F.startswith(
        path, F.lit(rule[1]))


def longest_rule(host: Column, path: Column, rules: list[ListRule], what) -> Column:
    """`what(rule)` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        found = F.when(fits(host, path, rule), F.lit(what(rule))).otherwise(found)
    return found


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """rule (sorted tokens), support, confidence from (tokens, bad)."""
    baskets = labelled.filter(F.size("tokens") > 0).select(
        F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    baskets = cut_lineage(baskets)
    if baskets.isEmpty():
        return baskets.sparkSession.createDataFrame(
            [], "rule array<string>, support double, confidence double")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
    return cut_lineage(rules.select(
        F.sort_array("antecedent").alias("rule"), "support", "confidence"))


def index_rules(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """token, rule: each rule under its rarest token among the labelled URLs."""
    counts = labelled.select(F.explode("tokens").alias("token")).groupBy("token").count()
    parts = rules.select("rule", F.explode("rule").alias("token"))
    parts = parts.join(counts, "token").groupBy("rule").agg(
        F.min(F.struct("count", "token")).alias("rarest"))
    return parts.select(F.col("rarest.token").alias("token"), "rule")


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[ListRule],
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, mined (the mined rule that fits, joined).

    `labelled` has url and bad (boolean, null: not labelled). The longest list rule decides; where
    none fits, a page is blocked if a mined rule fits and allowed if not. Of several mined rules
    the first in order is named. A null URL or one without `://` has an empty host and path and no
    tokens. Rows that repeat an id are judged each by itself. An empty table gives no rows.
    """
    known = cut_lineage(labelled.filter("bad IS NOT NULL").select(
        tokens_of(F.col("url")).alias("tokens"), "bad"))
    index = cut_lineage(index_rules(mine_rules(known), known))
    rows = pages.select(F.col(id_col).alias("__id"), filled(F.col(url_col)).alias("__url"))
    urls = rows.select("__url").distinct().select("__url", tokens_of(F.col("__url")).alias("tokens"))
    met = urls.select("__url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    met = met.filter(F.size(F.array_except("rule", "tokens")) == 0)
    mined = met.groupBy("__url").agg(F.min(F.array_join("rule", " ")).alias("mined"))
    rows = rows.join(mined, "__url", "left").select(
        "__id", host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"), "mined")
    host, path = F.col("host"), F.col("path")
    listed = longest_rule(host, path, rules, lambda r: r[2])
    guess = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return rows.select(
        F.col("__id").alias(id_col), "host", "path",
        longest_rule(host, path, rules, lambda r: r[0] + r[1]).alias("rule"),
        F.coalesce(listed, guess).alias("verdict"), "mined")

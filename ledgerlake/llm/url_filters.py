"""URL filters: rules first, gradient-boosted trees on lexical features for the rest (operator 2).

Everything runs as DataFrame and SQL expressions. ``train`` learns from a table of labelled URLs
(``url, label``). Features (length, depth, digit ratio, entropy, parameter counts, suffix statistics and
the like) are cut into at most ``BINS`` bins at the approximate quantiles of the training URLs,
and equal bin vectors are added up once into a written table. Each level of each tree is then one
aggregation of that table: gradient sums by (node, feature, bin), a number of rows that does not
depend on the data. The driver picks the best splits from them; of equal gains the first feature and the
lowest cut win. A tree is a CASE expression over the bins.

A ``FOLDS``-th of the hosts, by their hash, is held out: their URLs enter neither the suffix statistics
nor the quantiles nor the trees, and ``held_out_counts`` says how their labels and the trees' verdicts
agree. Suffix statistics are the smoothed block rate and the frequency of the host's last label
among the training URLs; an unseen suffix has rate 0.5 and frequency 0.

No table labels URLs, so ``op2_url_filters`` trains on ``seeded_labels``: a URL that a rule decides
carries the rule's verdict; of the others, a host with one of ``BLOCK_WORDS`` counts as block, any other as allow.

A null URL or one without ``://`` has empty host and path, fits no rule and is judged by the
trees like any other. Without labelled URLs every score is 0.5 (block). URLs of any length are read whole. Repeated rows each
give a row. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.operators.joins import salted_join

#: (verdict, host, path); fixed values of the contract.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Host words of advertising, gambling, pharmacy and adult sites.
BLOCK_WORDS = ("adult", "bets", "casino", "loan", "pills", "poker", "porn", "spam", "viagra", "xxx")
FOLDS, HELD_OUT = 5, 0
BINS, TREES, DEPTH, RATE, L2, LEAST_ROWS, SMOOTH = 16, 10, 3, 0.5, 1.0, 1.0, 20.0
FEATURES = (
    "url_chars",
    "host_chars",
    "path_chars",
    "host_depth",
    "path_depth",
    "digit_ratio",
    "host_digits",
    "host_hyphens",
    "host_entropy",
    "n_params",
    "query_chars",
    "suffix_block_rate",
    "suffix_log_rows",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    parts = [F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2)]
    return F.translate(parts[0], UPPER, LOWER), parts[1]


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path written together) and its verdict; null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for action, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, F.lit(h + p)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def _chars(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def _entropy(text: Column) -> Column:
    """Bits a character."""
    n = F.length(text)
    letters = F.array_distinct(F.split(text, ""))
    share = F.transform(letters, lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    bits = F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


def lexical(pages: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, ``url, host, path, suffix`` and the lexical features, all doubles."""
    host, path = split_url(F.col("url"))
    rows = pages.select(*keep, "url", host.alias("host"), path.alias("path"))
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    named = {
        "url_chars": F.length(url),
        "host_chars": F.length("host"),
        "path_chars": F.length("path"),
        "host_depth": _chars(F.col("host"), r"[^.]"),
        "path_depth": F.size(F.filter(F.split("path", "/"), lambda s: s != "")),
        "digit_ratio": _chars(url, r"[^0-9]") / F.greatest(F.length(url), F.lit(1)),
        "host_digits": _chars(F.col("host"), r"[^0-9]"),
        "host_hyphens": _chars(F.col("host"), r"[^-]"),
        "host_entropy": _entropy(F.col("host")),
        "n_params": F.when(query != "", _chars(query, r"[^&]") + 1).otherwise(0),
        "query_chars": F.length(query),
    }
    suffix = F.substring_index("host", ".", -1).alias("suffix")
    return rows.select("*", suffix, *(v.cast("double").alias(k) for k, v in named.items()))


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """The smoothed block rate and log frequency of each suffix among labelled rows (``label`` 1: block)."""
    stats = rows.groupBy("suffix").agg(F.count("label").alias("n"), F.sum("label").alias("blocked"))
    return stats.select(
        "suffix",
        ((F.coalesce("blocked", F.lit(0)) + 0.5 * SMOOTH) / (F.col("n") + SMOOTH)).alias("rate"),
        F.log1p(F.col("n").cast("double")).alias("log_rows"),
    )


def with_suffix_statistics(rows: DataFrame, stats: DataFrame) -> DataFrame:
    # One suffix may hold most URLs: its rows are dealt over several reducers.
    rows = salted_join(rows, stats, "suffix")
    known = {"suffix_block_rate": F.coalesce("rate", F.lit(0.5)), "suffix_log_rows": F.coalesce("log_rows", F.lit(0.0))}
    return rows.withColumns(known).drop("rate", "log_rows")


@dataclass(frozen=True)
class Split:
    """``bins[feature] <= cut`` goes to ``low``, else to ``high``; a leaf is a number."""

    feature: int
    cut: int
    low: Split | float
    high: Split | float


def tree_expr(node: Split | float, bins: list[Column]) -> Column:
    if isinstance(node, float):
        return F.lit(node)
    return F.when(bins[node.feature] <= node.cut, tree_expr(node.low, bins)).otherwise(tree_expr(node.high, bins))


def _bin(value: Column, edges: list[float]) -> Column:
    return sum(((value > F.lit(e)).cast("int") for e in edges), F.lit(0))


def _level(table: DataFrame, bins: list[Column], node: Column, margin: Column) -> dict[int, list]:
    """Gradient, hessian and row sums by node, feature and bin: at most 2^depth x features x bins rows."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    graded = table.select(
        node.alias("node"),
        (p * F.col("n") - F.col("y")).alias("g"),
        (p * (1 - p) * F.col("n")).alias("h"),
        F.col("n"),
        F.posexplode(F.array(*bins)).alias("f", "b"),
    )
    sums: dict[int, list] = {}
    for r in graded.groupBy("node", "f", "b").agg(F.sum("g"), F.sum("h"), F.sum("n")).collect():
        sums.setdefault(r[0], [{} for _ in bins])[r[1]][r[2]] = r[3:]
    return sums


def _best(hist: list[dict]) -> tuple[tuple[float, int, int] | None, float]:
    """The best (gain, feature, cut) of a node, if any gains, and the node's own weight."""
    g, h = (math.fsum(s[k] for s in hist[0].values()) for k in (0, 1))
    found = None
    for f, bins in enumerate(hist):
        gl = hl = nl = 0.0
        rows = sum(s[2] for s in bins.values())
        for cut in sorted(bins)[:-1]:
            gl, hl, nl = gl + bins[cut][0], hl + bins[cut][1], nl + bins[cut][2]
            if min(nl, rows - nl) < LEAST_ROWS:
                continue
            gain = gl * gl / (hl + L2) + (g - gl) ** 2 / (h - hl + L2) - g * g / (h + L2)
            if gain > 1e-6 and (found is None or gain > found[0] + 1e-9):
                found = (gain, f, cut)
    return found, -RATE * g / (h + L2)


def boost(table: DataFrame, bins: list[Column], trees: int = TREES, depth: int = DEPTH) -> list[Split | float]:
    """Trees for the logistic loss over ``table`` (bin columns, ``n`` rows, ``y`` of them block)."""
    forest: list[Split | float] = []
    for _ in range(trees):
        margin = sum((tree_expr(t, bins) for t in forest), F.lit(0.0))
        # nodes are numbered as in a heap: node k has the children 2k + 1 and 2k + 2
        splits: dict[int, tuple[int, int]] = {}
        leaves: dict[int, float] = {}
        level = [0]
        for d in range(depth + 1):
            node = _node_expr(0, splits, bins)
            sums = _level(table.where(node.isin(level)), bins, node, margin)
            level = []
            for k, hist in sorted(sums.items()):
                best, leaves[k] = _best(hist)
                if best and d < depth:
                    splits[k] = best[1:]
                    level += [2 * k + 1, 2 * k + 2]
            if not level:
                break
        forest.append(_built(0, splits, leaves))
    return forest


def _node_expr(k: int, splits: dict[int, tuple[int, int]], bins: list[Column]) -> Column:
    if k not in splits:
        return F.lit(k)
    f, cut = splits[k]
    return F.when(bins[f] <= cut, _node_expr(2 * k + 1, splits, bins)).otherwise(_node_expr(2 * k + 2, splits, bins))


def _built(k: int, splits: dict[int, tuple[int, int]], leaves: dict[int, float]) -> Split | float:
    if k not in splits:
        return float(leaves.get(k, 0.0))
    return Split(*splits[k], _built(2 * k + 1, splits, leaves), _built(2 * k + 2, splits, leaves))


@dataclass(frozen=True)
class Model:
    """What ``train`` learned: bin edges by feature, trees, and the suffixes' statistics (a written table)."""

    edges: list[list[float]]
    forest: list[Split | float]
    suffixes: DataFrame

    def binned(self, rows: DataFrame) -> DataFrame:
        """Rows of ``lexical`` with their suffix statistics and the column ``bin_f`` for every feature f."""
        rows = with_suffix_statistics(rows, self.suffixes)
        return rows.select("*", *(_bin(F.col(f), e).alias(f"bin_{f}") for f, e in zip(FEATURES, self.edges)))

    def score(self, rows: DataFrame) -> DataFrame:
        """Add ``block_score``, the trees' probability of block."""
        margin = sum((tree_expr(t, [F.col(f"bin_{f}") for f in FEATURES]) for t in self.forest), F.lit(0.0))
        return self.binned(rows).withColumn("block_score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def _held_out(host: Column) -> Column:
    return F.crc32(host.cast("binary")) % FOLDS == HELD_OUT


def _labelled(labels: DataFrame) -> DataFrame:
    """Features and ``label`` 1 or 0 of labelled URLs; other labels are ignored."""
    rows = lexical(labels.where(F.col("label").isin("block", "allow")), "label")
    return rows.withColumn("label", (F.col("label") == "block").cast("int"))


def seeded_labels(pages: DataFrame, rules=RULES, block_words=BLOCK_WORDS) -> DataFrame:
    """``url, label`` of every page: the rules' verdict, else block for hosts with a listed word."""
    host, path = split_url(F.col("url"))
    rows = pages.select("url", host.alias("host"), path.alias("path"))
    _, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seeded = F.when(F.col("host").rlike("|".join(block_words)), "block").otherwise("allow")
    return rows.select("url", F.coalesce(verdict, seeded).alias("label"))


def train(labels: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Model:
    """Learn from ``url, label`` (block or allow) of the hosts that are not held out."""
    rows = common.saved(_labelled(labels).where(~_held_out(F.col("host"))).drop("url", "path"), "url_labels")
    suffixes = common.saved(suffix_statistics(rows), "url_suffixes")
    rows = with_suffix_statistics(rows, suffixes)
    shares = [k / BINS for k in range(1, BINS)]
    quantiles = rows.agg(*(F.percentile_approx(f, shares, 1000) for f in FEATURES)).first()
    edges = [sorted(set(q or [])) for q in quantiles]
    bins = [F.col(f"bin_{f}") for f in FEATURES]
    binned = rows.select("label", *(_bin(F.col(f), e).alias(f"bin_{f}") for f, e in zip(FEATURES, edges)))
    table = binned.groupBy(*bins).agg(F.count("*").alias("n"), F.sum("label").alias("y"))
    return Model(edges, boost(common.saved(table, "url_bins"), bins, trees, depth), suffixes)


def held_out_counts(labels: DataFrame, model: Model) -> DataFrame:
    """``label, verdict, n`` of the URLs of held-out hosts: at most four rows."""
    rows = model.score(_labelled(labels).where(_held_out(F.col("host"))))
    named = [F.when(c, "block").otherwise("allow").alias(k) for k, c in (("label", F.col("label") == 1), ("verdict", F.col("block_score") >= 0.5))]
    return rows.select(*named).groupBy("label", "verdict").agg(F.count("*").alias("n"))


def judge_urls(pages: DataFrame, rules=RULES, block_words=BLOCK_WORDS, labels: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` for every row of ``pages`` (``page_id, url``).

    The trees are trained on ``labels`` (``url, label``), by default ``seeded_labels`` of the pages.
    ``block_score`` is given for rows with a rule as well.
    """
    model = train(labels if labels is not None else seeded_labels(pages, rules, block_words))
    scored = model.score(lexical(pages, "page_id"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(ruled, F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "block_score")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(common.load(spark, sf_dir, "pages"))

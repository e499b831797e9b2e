"""URL filter: rules first, gradient-boosted trees for the rest.

Everything is built-in expressions and aggregates. Rules are CASE branches,
longest first. URLs that a rule decides are the labelled rows; from a bounded,
id-free sample of them (at most ``SAMPLE`` different URLs in hash order, each
once however often it repeats) the trees are grown by histograms: features are binned at quantiles, equal rows are folded into
weighted cells, and each tree level is one aggregate over (node, feature, bin).
The fitted trees become CASE expressions, so scoring is one map-side pass.

Features: length, path depth, digit ratio, character entropy, number of
parameters, host length, hyphens, and the smoothed block rate of the host's
suffix (last label) and of its last two labels among the sampled rows, for the
``SUFFIXES`` most frequent ones (others take the overall rate).

Defined results: a null or malformed url has an empty host and path, no rule
fits it and the trees judge it; without labelled rows the answer is allow;
repeated rows are judged alike; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripyard.llm._tables import ascii_lower, staged

#: (rule, verdict): host and path, fixed by the contract.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block")]

SAMPLE, SUFFIXES, BINS = 100_000, 500, 16
TREES, DEPTH, RATE, RIDGE, MIN_WEIGHT = 10, 3, 0.4, 1.0, 5.0
FEATURES = ["f_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_host", "f_hyphens", "f_suffix", "f_domain"]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict), null where none fits; the longest rule wins."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, answer in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the last, longest, is asked first
        at, _, way = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + way)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, answer).otherwise(verdict)
    return name, verdict


def with_features(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    rows = pages.select(pages[id_col].alias("page_id"), F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("_url"))
    host, path = split_url(F.col("_url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    n = F.length("_url")
    chars = F.array_distinct(F.split("_url", ""))
    share = lambda c: (n - F.length(F.replace(F.col("_url"), c, F.lit("")))) / n
    entropy = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    count = lambda col, chars: F.length(col) - F.length(F.translate(col, chars, ""))
    safe = F.greatest(n, F.lit(1))
    return rows.withColumns({
        "rule": rule, "ruled": verdict,
        "suffix": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2),
        "f_length": n.cast("double"), "f_depth": count(F.col("path"), "/").cast("double"),
        "f_digits": count(F.col("_url"), "0123456789") / safe, "f_entropy": F.when(n > 0, entropy).otherwise(0.0),
        "f_params": F.when(F.instr("_url", "?") > 0, count(F.substring_index("_url", "?", -1), "&") + 1).otherwise(0).cast("double"),
        "f_host": F.length("host").cast("double"), "f_hyphens": count(F.col("host"), "-").cast("double"),
    })


@dataclass
class UrlModel:
    """Fitted trees: nested (feature, threshold, left, right) or a leaf value."""

    base: float = 0.0
    prior: float = 0.0
    rates: dict[str, dict[str, float]] = field(default_factory=lambda: {"suffix": {}, "domain": {}})
    trees: list = field(default_factory=list)

    def rated(self, rows: DataFrame) -> DataFrame:
        """Adds the suffix statistics (lookups in maps of bounded size)."""
        def rate(kind):
            pairs = [F.lit(x) for item in sorted(self.rates[kind].items()) for x in item]
            return F.coalesce(F.get(F.map_values(F.map_filter(F.create_map(*pairs), lambda k, _: k == F.col(kind))), F.lit(0)), F.lit(self.prior)) if pairs else F.lit(self.prior)
        return rows.withColumns({"f_suffix": rate("suffix"), "f_domain": rate("domain")})

    def margin(self) -> Column:
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + _case(tree, lambda f, t: F.col(f) <= F.lit(t))
        return total


def _case(tree, test) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, threshold, left, right = tree
    return F.when(test(feature, threshold), _case(left, test)).otherwise(_case(right, test))


def _rates(sample: DataFrame, kind: str, prior: float) -> dict[str, float]:
    """Smoothed block rate of the most frequent values (at most SUFFIXES rows)."""
    top = (sample.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))
           .orderBy(F.desc("n"), kind).limit(SUFFIXES))
    return {r[kind]: (r["y"] + 10 * prior) / (r["n"] + 10) for r in top.collect()}


def fit(rows: DataFrame) -> UrlModel:
    """Boosted trees on logistic loss from the rows that a rule decides."""
    picked = rows.where("ruled IS NOT NULL").withColumn("y", (F.col("ruled") == "block").cast("double"))
    held, order = picked.count(), F.xxhash64("_url")
    # hashes are spread evenly: about twice the URLs wanted lie below this one, and only those are gathered
    below = min(2**64 - 1, (2 * SAMPLE + 1000) * 2**64 // max(1, held)) - 2**63
    columns = ["y", "suffix", "domain", *[f for f in FEATURES if f not in ("f_suffix", "f_domain")]]
    sample = staged(picked.where(order <= F.lit(below)).groupBy("_url").agg(*[F.first(c).alias(c) for c in columns])
                    .orderBy(order, "_url").limit(SAMPLE), "url-sample")
    n, blocked = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    model = UrlModel()
    if not n:
        return model
    model.prior = blocked / n
    model.base = log((blocked + 0.5) / (n - blocked + 0.5))
    model.rates = {kind: _rates(sample, kind, model.prior) for kind in ("suffix", "domain")}
    rated = staged(model.rated(sample).select("y", *FEATURES), "url-rated")
    edges = rated.agg(*[F.percentile_approx(f, [i / BINS for i in range(1, BINS)], 1000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(edges[f])) for f in FEATURES}
    bins = [sum(((F.col(f) > F.lit(c)).cast("int") for c in cuts[f]), F.lit(0)).cast("int").alias(f) for f in FEATURES]
    cells = staged(rated.select("y", *bins).groupBy(*FEATURES).agg(
        F.count(F.lit(1)).cast("double").alias("w"), F.sum("y").alias("y")).coalesce(4), "url-cells")
    binned = UrlModel(base=model.base)  # the same trees over bin numbers
    for _ in range(TREES):
        p = 1 / (1 + F.exp(-binned.margin()))
        graded = cells.withColumns({"g": F.col("w") * p - F.col("y"), "h": F.col("w") * p * (1 - p)})
        tree = _grow(graded, cuts)
        if not isinstance(tree, tuple):
            break
        binned.trees.append(tree)
        model.trees.append(_unbinned(tree, cuts))
    return model


def _grow(graded: DataFrame, cuts: dict) -> object:
    """One tree, a level at a time; a level's histogram has at most
    2^depth * features * BINS rows."""
    tree: dict = {1: None}
    leaves, value = [1], {}
    for depth in range(DEPTH):
        node = _node_column(tree)
        long = graded.withColumn("node", node).where(F.col("node").isin(leaves)).select(
            "node", "g", "h", F.posexplode(F.array(*[F.col(f) for f in FEATURES])).alias("feature", "bin"))
        hist: dict = {}
        for r in long.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            hist.setdefault(r["node"], {}).setdefault(r["feature"], {})[r["bin"]] = (r["g"], r["h"])
        grown = []
        for at in leaves:
            found = _best_split(hist.get(at, {}), cuts)
            total = hist.get(at, {}).get(0, {}).values()
            value.setdefault(at, _leaf(sum(x[0] for x in total), sum(x[1] for x in total)))
            if found:
                feature, cut, left, right = found
                tree[at] = (feature, cut)
                value[2 * at], value[2 * at + 1] = _leaf(*left), _leaf(*right)
                grown += [2 * at, 2 * at + 1]
        leaves = grown
        if not leaves:
            break

    def nested(at):
        if tree.get(at):
            return (*tree[at], nested(2 * at), nested(2 * at + 1))
        return value[at]
    return nested(1)


def _leaf(g: float, h: float) -> float:
    return -RATE * g / (h + RIDGE)


def _best_split(hist: dict, cuts: dict):
    best, found = 1e-6, None
    for j, name in enumerate(FEATURES):
        bins = hist.get(j, {})
        tg, th = sum(x[0] for x in bins.values()), sum(x[1] for x in bins.values())
        g = h = 0.0
        for b in range(len(cuts[name])):
            g, h = g + bins.get(b, (0, 0))[0], h + bins.get(b, (0, 0))[1]
            if min(h, th - h) * 4 < MIN_WEIGHT:  # h is at most a quarter of the rows
                continue
            gain = g * g / (h + RIDGE) + (tg - g) ** 2 / (th - h + RIDGE) - tg * tg / (th + RIDGE)
            if gain > best + 1e-9:
                best, found = gain, (name, b, (g, h), (tg - g, th - h))
    return found


def _node_column(tree: dict) -> Column:
    def at(k):
        if tree.get(k):
            feature, cut = tree[k]
            return F.when(F.col(feature) <= cut, at(2 * k)).otherwise(at(2 * k + 1))
        return F.lit(k)
    return at(1)


def _unbinned(tree, cuts):
    if not isinstance(tree, tuple):
        return tree
    feature, b, left, right = tree
    return (feature, float(cuts[feature][b]), _unbinned(left, cuts), _unbinned(right, cuts))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, model: UrlModel | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' block probability)."""
    rows = with_features(pages, id_col, url_col, rules)
    model = model or fit(rows)
    score = 1 / (1 + F.exp(-model.margin()))
    return model.rated(rows).withColumn("score", score).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"),
        "score")

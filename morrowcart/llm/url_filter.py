"""URL filter: a path-template tree per host, judged by smoothed labelled purity.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased;
path: from there up to `?`, `#` or the end. A url that is null or has no `://`
has an empty host and path. A rule `host/path` fits its host and all its
subdomains when the url's path starts with the rule's path; the longest
fitting rule wins and its verdict stands.

Urls without a rule are judged by their template. The tree of a host covers the
whole path; it is built level by level over the first `DEPTH` segments, deeper
ones are generalised by their form only:

1. a segment is generalised by its form: digits to `<n>`, hex of 8 or more to
   `<h>`, other mixes with digits to `<m>` (an extension stays);
2. the literal branches of a branch point are compared by what lies under
   them, labelled or not: a branch's profile is the distribution of its urls over
   the shapes of the path from there on (forms, extensions, depth; any literal is
   `w`). Branches with the same most frequent shape are pooled; one whose profile
   shares at least `ALIKE` of its mass with the pool's is alike, and if it has
   labels, its blocked share must lie within `APART` of the pool's. Alike branches
   merge into one wildcard `*[shape]`; others keep their name;
3. a template's purity is (blocked + 1) / (labelled + 2), over the urls that a
   rule fits; a template is rejected if its purity is at least `REJECT` and
   at least `EVIDENCE` of its urls are labelled: the urls in it without a rule get
   `block`. Where too few are labelled the template abstains: `allow`.

Shares, not counts, decide, so a table of many times the rows gives the same
verdicts but for the smoothing of templates with few labels.
Each level is stored, since the next one reads it twice.
All steps are DataFrame aggregations over (host, template) counts, which are
pre-aggregated by task before any shuffle, so a hot host costs one row per
task and template; the final join back is a shuffle join that adaptive
execution can split. Siblings are never compared in pairs, only with their pool.
Duplicate rows are counted as often as they occur; of equally frequent shapes the
last by code point counts. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
DEPTH = 4
ALIKE = 0.75
APART = 0.2
REJECT = 0.8
EVIDENCE = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null if none does."""
    best, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is applied last
        at, slash, start = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + start)
        best, verdict = F.when(fits, F.lit(rule)).otherwise(best), F.when(fits, F.lit(what)).otherwise(verdict)
    return best, verdict


def _general(segment: Column) -> Column:
    stem = F.regexp_extract(segment, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?$", 1)
    ext = F.regexp_extract(segment, r"(?s)^(.*?)(\.[A-Za-z]{1,5})?$", 2)
    return F.concat(F.when(stem.rlike("^[0-9]+$"), "<n>").when(stem.rlike("^[0-9a-fA-F-]{8,}$"), "<h>")
                    .when(stem.rlike("[0-9]"), "<m>").otherwise(stem), ext)


def _shape(segment: Column) -> Column:
    """A generalised segment without its words."""
    return (F.when((segment == "") | segment.rlike("^<[nhm]>"), segment)
            .otherwise(F.concat(F.lit("w"), F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1))))


def parsed(pages: DataFrame, url: str = "url", depth: int = DEPTH, rules=RULES) -> DataFrame:
    """The table with host, path, rule, rule_verdict and the segments g1..g<depth>,
    and all deeper ones in `tail`."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = out.withColumns({"rule": rule, "rule_verdict": verdict, "_s": F.filter(F.split("path", "/"), lambda s: s != "")})
    segs = {f"g{i}": _general(F.coalesce(F.get("_s", F.lit(i - 1)), F.lit(""))) for i in range(1, depth + 1)}
    segs["tail"] = F.array_join(F.transform(F.expr(f"slice(_s, {depth + 1}, greatest(size(_s) - {depth}, 0))"), _general), "/")
    return out.withColumns(segs).drop("_s")


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on `keys`, whatever the sides have in common."""
    named = right.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in right.columns])
    return left.join(named, [F.col(k) == F.col(f"_{k}") for k in keys]).drop(*[f"_{k}" for k in keys])


def _merged(tree: DataFrame, prefix: list[str], i: int, depth: int) -> DataFrame:
    """(prefix, g<i>, t<i>): the name of each branch of level i after merging."""
    g = f"g{i}"
    rest = [F.nullif(_shape(F.col(f"g{k}")), F.lit("")) for k in range(i, depth + 1)]
    rest.append(F.nullif(F.array_join(F.transform(F.split("tail", "/"), _shape), "/"), F.lit("")))
    literal = ~F.col(g).rlike("^<[nhm]>") & (F.col(g) != "")
    shapes = stored(tree.groupBy(*prefix, g, F.concat_ws("/", *rest).alias("shape")).agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b")), f"url-branches-{i}")
    branch = shapes.where(literal).groupBy(*prefix, g).agg(
        F.sum("n").alias("bn"), F.sum("l").alias("bl"), F.sum("b").alias("bb"), F.max(F.struct("n", "shape"))["shape"].alias("pool"))
    of = stored(_joined(shapes, branch, [*prefix, g]), f"url-profiles-{i}")
    pool = of.groupBy(*prefix, "pool", "shape").agg(F.sum("n").alias("pn"))
    whole = of.groupBy(*prefix, "pool").agg(F.sum("n").alias("pt"), F.sum("l").alias("pl"), F.sum("b").alias("pb"), F.count_distinct(g).alias("branches"))
    shared = F.round(F.sum(F.least(F.col("n") / F.col("bn"), F.col("pn") / F.col("pt"))), 9)
    alike = _joined(_joined(of, pool, [*prefix, "pool", "shape"]), whole, [*prefix, "pool"]).groupBy(*prefix, g, "pool").agg(
        shared.alias("shared"), F.max("branches").alias("branches"), F.max("bl").alias("bl"), F.max(F.abs(F.try_divide("bb", "bl") - F.try_divide("pb", "pl"))).alias("apart"))
    wild = (F.col("branches") > 1) & (F.col("shared") >= ALIKE) & ((F.col("bl") == 0) | (F.col("apart") <= APART))
    name = F.when(wild, F.concat(F.lit("*["), F.col("pool"), F.lit("]"))).otherwise(F.col(g))
    fixed = shapes.where(~literal).select(*prefix, g, F.col(g).alias(f"t{i}")).distinct()
    return alike.select(*prefix, g, name.alias(f"t{i}")).unionByName(fixed)


def templates(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The template tree. `nodes`: host, g1..g<depth>, tail, n, labelled, blocked
    (one row per generalised path). Adds t1..t<depth> (the segments after
    merging), `purity` and `rejected`."""
    tree, prefix = stored(nodes, "url-paths"), ["host"]
    deepest = tree.agg(F.max(F.greatest(F.lit(0), *[F.when(F.col(f"g{i}") != "", i) for i in range(1, depth + 1)]))).first()[0] or 0
    for i in range(1, depth + 1):
        if i > deepest:  # nothing there to merge
            tree = tree.withColumn(f"t{i}", F.lit(""))
            prefix.append(f"t{i}")
            continue
        tree = stored(_joined(tree, _merged(tree, prefix, i, depth), [*prefix, f"g{i}"]), f"url-tree-{i}")
        prefix.append(f"t{i}")
    key = [*prefix, "tail"]
    judged = tree.groupBy(*key).agg(((F.sum("blocked") + 1) / (F.sum("labelled") + 2)).alias("purity"), (F.sum("labelled") >= EVIDENCE * F.sum("n")).alias("_known"))
    judged = judged.withColumn("rejected", (F.col("purity") >= REJECT) & F.col("_known")).drop("_known")
    return _joined(tree, judged, key)


def url_filter(pages: DataFrame, url: str = "url", id_col: str = "page_id", rules=RULES, depth: int = DEPTH) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) for every row."""
    rows = parsed(pages.select(F.col(id_col), F.col(url)), url, depth, rules)
    path_key = [f"g{i}" for i in range(1, depth + 1)] + ["tail"]
    counts = rows.groupBy("host", *path_key).agg(
        F.count("*").alias("n"), F.count("rule").alias("labelled"), F.count_if(F.col("rule_verdict") == "block").alias("blocked"))
    judged = templates(counts, depth).select(
        F.col("host").alias("_host"), *[F.col(k).alias(f"_{k}") for k in path_key], "purity", "rejected",
        F.concat(F.lit("/"), F.concat_ws("/", *[F.nullif(F.col(f"t{i}"), F.lit("")) for i in range(1, depth + 1)], F.nullif(F.col("tail"), F.lit("")))).alias("template"))
    on = [rows["host"] == F.col("_host")] + [rows[k] == F.col(f"_{k}") for k in path_key]
    return rows.join(judged, on).select(
        id_col, "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"), "template", "purity")

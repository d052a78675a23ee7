"""URL filtering by rules, and by a tree of path templates for what no rule fits.

Per host, path segments that vary (numbers, hex names, or places with many different children) become wildcards.
Branches of a host that differ in their last fixed segment alone are merged if their share of bad labels is
statistically alike. A template without labels differs from none of its siblings: it joins the merged branch, and
if that has no labels either, it takes those of its host. A template is rejected if its share of bad labels, smoothed
towards the share among all labels, is high enough. Without any label on its host that share is the overall one,
which tells nothing about the template, so it is allowed.

Pages are first counted by host and plain template; the tree is built from these counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.frames import unused

#: Different children from which a place in the tree is a wildcard, if they are also a tenth of its pages.
FAN, FAN_SHARE = 20, 0.1
#: Standard errors within which two shares count as alike.
ALIKE = 2.0
#: Labels that the overall share weighs as much as, and the smoothed share from which a template is rejected.
SMOOTHING, REJECTED = 4.0, 0.8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Blocks or allows a host with its subdomains, for paths that start with the rule's."""

    verdict: str
    rule: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, start = self.rule.partition("/")
        return ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + start)


def host_of(url: str | Column) -> Column:
    """From after the first :// up to the path, query or fragment, A-Z as a-z; empty without ://."""
    found = F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.rule), r.rule)):
        fits = rule.fits(host, path)
        name, verdict = F.when(fits, rule.rule).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def plain_template(path: Column) -> Column:
    """Segments of the path, numbers and hex names as wildcards that keep their file ending."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, lambda s: F.regexp_replace(s, r"^([0-9]+|[0-9a-f]{8,}|[0-9a-f-]{32,})(?=$|\.[A-Za-z0-9]+$)", "*"))


def templates(counted: DataFrame) -> DataFrame:
    """(host, plain, n, bad, labels) by plain template to (host, plain, template, bad, labels) with the final
    template and the label counts of its merged branch, or of its host if the branch has none."""
    keyed = counted.withColumn("_id", F.array_join("plain", "/"))
    places = keyed.select("host", "_id", "n", F.posexplode("plain").alias("depth", "segment")).join(
        keyed.select("host", "_id", "plain"), ["host", "_id"])
    places = places.withColumn("above", F.array_join(F.slice("plain", 1, F.col("depth")), "/"))
    # A place is a node of the host's tree; its children are counted, not gathered.
    children = places.groupBy("host", "depth", "above", "segment").agg(F.sum("n").alias("n"))
    nodes = children.groupBy("host", "depth", "above").agg(F.count(F.lit(1)).alias("fan"), F.sum("n").alias("pages"))
    variable = nodes.filter((F.col("fan") >= FAN) & (F.col("fan") >= FAN_SHARE * F.col("pages"))).select("host", "depth", "above")
    wild = places.join(variable.withColumn("wild", F.lit(True)), ["host", "depth", "above"], "left")
    # A template has as many rows here as its path has segments.
    final = wild.groupBy("host", "_id").agg(F.array_sort(F.collect_list(F.struct(
        "depth", F.when(F.col("wild"), "*").otherwise(F.col("segment")).alias("segment")))).alias("parts"))
    named = keyed.join(final, ["host", "_id"], "left").withColumn(
        "segments", F.coalesce(F.transform("parts", lambda p: p["segment"]), F.array().cast("array<string>")))
    fixed = F.filter(F.transform("segments", lambda s, i: F.when(~s.startswith("*"), i)), lambda i: i.isNotNull())
    named = named.withColumns({"template": F.array_join("segments", "/"), "_last": F.array_max(fixed)})
    named = named.withColumn("branches", F.array_join(F.transform(
        "segments", lambda s, i: F.when(i == F.col("_last"), "?").otherwise(s)), "/"))

    own = named.groupBy("host", "branches", "template").agg(F.sum("bad").alias("bad"), F.sum("labels").alias("labels"))
    together = own.groupBy("host", "branches").agg(F.sum("bad").alias("all_bad"), F.sum("labels").alias("all_labels"))
    both = own.join(together, ["host", "branches"])
    share, shared = F.col("bad") / F.col("labels"), F.col("all_bad") / F.col("all_labels")
    error = F.sqrt(shared * (1 - shared) / F.col("labels") + 0.25 / (F.col("labels") + 1) / F.col("all_labels"))
    alike = F.when(F.col("labels") > 0, F.abs(share - shared) <= ALIKE * error).otherwise(F.lit(True))
    merged = both.withColumn("alike", alike)
    pool = merged.filter("alike").groupBy("host", "branches").agg(F.sum("bad").alias("pool_bad"), F.sum("labels").alias("pool_labels"))
    hosts = own.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("labels").alias("host_labels"))
    evidence = merged.join(pool, ["host", "branches"], "left").join(hosts, "host").select("host", "template", *[
        F.when(~F.col("alike"), F.col(c)).when(F.col("pool_labels") > 0, F.col(f"pool_{c}")).otherwise(F.col(f"host_{c}")).alias(c)
        for c in ("bad", "labels")])
    return named.select("host", F.col("_id").alias("plain"), "template").join(evidence, ["host", "template"])


def judge(df: DataFrame, rules: tuple[Rule, ...], url: str = "url", labelled: Column | None = None) -> DataFrame:
    """Adds host, path, rule, template, purity (the smoothed share of bad labels) and verdict.

    A rule's verdict holds; else the template's, of which purity is never null. `labelled` gives a row's label, 1 bad and 0 good or null;
    by default the rules label the rows that they fit. A null url, or one without ://, has empty host and
    path and is judged like any other. Repeated rows and other columns stay; columns named like a result
    are replaced. An empty table gives an empty table.
    """
    added = ("host", "path", "rule", "template", "purity", "verdict")
    host, path = host_of(url), path_of(url)
    name, verdict = ruled(host, path, rules)
    label = F.when(verdict == "block", 1).when(verdict == "allow", 0) if labelled is None else labelled
    plain = F.array_join(plain_template(path), "/")
    facts = df.select(host.alias("host"), plain_template(path).alias("plain"), label.alias("label"))
    counted = facts.groupBy("host", "plain").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("label", F.lit(0))).alias("bad"), F.count("label").alias("labels"))
    # One row: the overall share of bad labels.
    overall = counted.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("labels"), F.lit(0)), F.lit(0.0)).alias("share"))
    rest = df.drop(*[c for c in added if c != url])
    own, plain_of, path_of_url, rule_of, ruled_as, host_key, plain_key, known = unused(
        rest, "_h", "_p", "_path", "_rule", "_verdict", "_host", "_plain", "_known")
    tree = templates(counted).withColumn("_share", overall.scalar()).select(
        F.col("host").alias(host_key), F.col("plain").alias(plain_key), F.col("template").alias("template"),
        ((F.col("bad") + SMOOTHING * F.col("_share")) / (F.col("labels") + SMOOTHING)).alias("purity"), (F.col("labels") > 0).alias(known))
    rows = rest.withColumns({own: host, plain_of: plain, path_of_url: path, rule_of: name, ruled_as: verdict})
    joined = rows.join(tree, (F.col(own) == F.col(host_key)) & (F.col(plain_of) == F.col(plain_key)), "left")
    method = F.when(F.col(known) & (F.col("purity") >= REJECTED), "block").otherwise("allow")
    return joined.select(
        *[c for c in df.columns if c not in added], F.col(own).alias("host"), F.col(path_of_url).alias("path"),
        F.col(rule_of).alias("rule"), "template", "purity", F.coalesce(ruled_as, method).alias("verdict"))

"""URL verdicts by rules, and by a tree of path templates per host where no rule fits.

The tree is grown level by level, in DataFrame operations. At each level, among urls of one host
whose paths agree so far as templates:

1. Variable segments become a wildcard: the children of a node are one wildcard branch if there are
   many of them for its urls (``VARIABLE`` distinct segments at least, and fewer than ``REPEATS`` urls each on average).
2. Statistically similar branches merge: of the other children with at least ``LEAST`` labels, those whose labelled share of
   rejected urls is within ``Z`` standard errors of that of the others' labels, ``LEAST`` at least, and whose own children look alike
   (same kind of next segment) become one branch, named after the first of them. A child with fewer labels stays itself.

Segments are first told apart by kind: digits, hexadecimal, dates, other. Paths are followed to their
ends. From ``LEVELS`` segments on, a path alone below its node has nothing to be told apart from: its template is the node, the rest of the path
as it is, and ``/**``. A template's labelled urls give its purity, smoothed
towards the share of the template above it, and so on up to the host and to all urls. On the way down each label counts once: a step takes
those labels of its template that the next step does not have, so a way without forks changes nothing, however long. A template whose smoothed
share of rejected urls is over ``REJECT`` is rejected with all its urls, if it or a template above it, the host aside, has labels
at all. Labels are the rules' own verdicts, or any given table.

Counting is by host and template with partial sums, so a host with a third of all urls is spread over all tasks. Nothing is
collected or broadcast but the rules.

Defined results: a null url and one without ``://`` have empty host and path; an empty path has
the template of its host alone; repeated rows are all returned and all counted; a null label says nothing; an
empty table gives an empty result; further columns are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.llm.common import only, stored, table

#: Segments from which a path alone below its node leaves the tree.
LEVELS = 4
#: Distinct segments from which a position can be variable, and urls a segment from which it is not.
VARIABLE, REPEATS = 20, 20.0
#: Labels on either side that it takes to find branches similar.
LEAST = 5
#: Standard errors within which branches are similar.
Z = 2.0
#: Weight, in labelled urls, of the share of the template above.
PRIOR = 5.0
#: Smoothed share of rejected urls above which a template is rejected.
REJECT = 0.8


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, and for paths that begin so."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        """As it is written."""
        return self.host + self.path


def rule(text: str, verdict: str) -> Rule:
    """A rule from its text, such as ``example.org/es/``."""
    host, slash, path = text.partition("/")
    return Rule(host, slash + path, verdict)


RULES = [
    rule("org/", "allow"),
    rule("example.org/es/", "block"),
    rule("example.org/en/1", "block"),
    rule("com/fr/", "allow"),
    rule("com/de/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty for null and for urls without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), r"^[^?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(at > 0, lowered).otherwise(""), F.when(at > 0, path).otherwise("")


def fitting(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``, or null; of rules of one length the first by text."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    found = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in ordered
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def kind_of(segment: Column) -> Column:
    """What sort of text a segment is."""
    bare = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(segment.isNull(), "end")
        .when(bare.rlike(r"^\d{4}-?\d{2}-?\d{2}$"), "date")
        .when(bare.rlike(r"^\d+$"), "digits")
        .when(bare.rlike(r"^(?=.*\d)[0-9a-fA-F-]{8,}$"), "hex")
        .otherwise("word")
    )


def _grow(urls: DataFrame, level: int) -> DataFrame:
    """Branches of one level: ``host``, ``node``, ``segment``, and the ``branch`` that the segment belongs to.

    ``urls`` are distinct by host, node and path, with ``n`` urls, ``seen`` labelled and ``bad`` rejected.
    """
    segment = F.get("segments", F.lit(level))
    here = urls.filter(segment.isNotNull()).select(
        "host", "node", segment.alias("segment"), kind_of(F.get("segments", F.lit(level + 1))).alias("next"), "n", "seen", "bad"
    )
    # Of what follows a segment, the set of kinds is its shape; at most five kinds.
    children = (
        here.groupBy("host", "node", "segment")
        .agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"), F.sum("bad").alias("bad"), F.array_join(F.sort_array(F.collect_set("next")), "+").alias("shape"))
        .withColumn("kind", kind_of(F.col("segment")))
    )
    siblings = ["host", "node", "kind"]
    spread = children.groupBy(*siblings).agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("all"))
    marked = children.join(spread, siblings).withColumn(
        "variable", (F.col("distinct") >= VARIABLE) & (F.col("all") < REPEATS * F.col("distinct"))
    )
    fixed = marked.filter(~F.col("variable"))
    alike = ["host", "node", "kind", "shape"]
    pooled = fixed.groupBy(*alike).agg(F.sum("seen").alias("_seen"), F.sum("bad").alias("_bad"))
    others, others_bad = F.col("_seen") - F.col("seen"), F.col("_bad") - F.col("bad")
    share = (F.col("_bad") + 0.5) / (F.col("_seen") + 1)
    error = F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), F.col("seen")) + F.try_divide(F.lit(1.0), others)))
    apart = F.abs(F.try_divide(F.col("bad"), F.col("seen")) - F.try_divide(others_bad, others))
    similar = (F.col("seen") >= LEAST) & (others >= LEAST) & (apart <= Z * error)
    compared = fixed.join(pooled, alike).withColumn("similar", F.coalesce(similar, F.lit(False)))
    named = compared.filter("similar").groupBy(*alike).agg(F.min("segment").alias("first"), F.count(F.lit(1)).alias("merged"))
    settled = compared.join(named, alike, "left").select(
        "host", "node", "segment", F.when(F.col("similar") & (F.col("merged") > 1), F.concat("first", F.lit("|~"))).otherwise(F.col("segment")).alias("branch")
    )
    wild = marked.filter("variable").select("host", "node", "segment", F.concat(F.lit("{"), "kind", F.lit("}")).alias("branch"))
    return wild.unionByName(settled)


def templates(urls: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Templates of paths and their labels.

    ``urls`` has ``host``, ``path`` and ``label`` (1 rejected, 0 accepted, null unknown). Returns
    ``(host, path, template, trail)`` with the trail of templates from the host down, and
    ``(template, above, seen, bad)`` by host.
    """
    counted = urls.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("seen"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")
    )
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    current = stored(counted.withColumn("segments", segments).withColumn("node", F.lit("")).withColumn("trail", F.array(F.lit(""))))
    done, level = [], 0
    while True:
        more = F.size("segments") > level
        if level >= levels:
            sizes = current.filter(more).groupBy("host", "node").agg(F.count(F.lit(1)).alias("paths"))
            rest = F.concat("node", F.lit("/"), F.array_join(F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0))), "/"), F.lit("/**"))
            left = stored(current.join(sizes, ["host", "node"], "left").withColumn("alone", more & (F.col("paths") == 1)))
            node = F.when(F.col("alone"), rest).otherwise(F.col("node"))
            trail = F.when(F.col("alone"), F.concat("trail", F.array(node))).otherwise(F.col("trail"))
            done.append(left.filter(F.col("alone") | ~more).select("host", "path", "n", "seen", "bad", "segments", node.alias("node"), trail.alias("trail")))
            current = left.filter(~F.col("alone") & more).drop("paths", "alone")
        if current.filter(more).isEmpty():
            break
        branches = _grow(current, level)
        left = current.withColumn("segment", F.get("segments", F.lit(level)))
        joined = left.join(branches, ["host", "node", "segment"], "left")
        node = F.when(F.col("branch").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), "branch"))
        trail = F.when(F.col("branch").isNull(), F.col("trail")).otherwise(F.concat("trail", F.array(node)))
        current = stored(joined.select("host", "path", "n", "seen", "bad", "segments", node.alias("node"), trail.alias("trail")))
        level += 1
    for part in done:
        current = current.unionByName(part)
    labelled = current.select("host", F.posexplode("trail").alias("depth", "template"), "seen", "bad")
    sums = labelled.groupBy("host", "template", "depth").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"))
    return current.select("host", "path", F.col("node").alias("template"), "trail"), sums


def smoothed_shares(urls: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(host, path, template, rejected_share, labelled)``: each template's share of rejected urls, smoothed by those above it, and whether
    it or a template above it, the host aside, has labels."""
    paths, sums = templates(urls, levels)
    sums = stored(sums)
    everything = sums.filter("depth = 0").agg(F.sum("seen").alias("s"), F.sum("bad").alias("b")).first()
    start = ((everything["b"] or 0) + 1.0) / ((everything["s"] or 0) + 2.0)
    # One row per template and step of its trail, host first; the trail has as many steps as the path has segments, and one more, at most.
    steps = paths.select("host", "template", "trail").distinct().select("host", F.col("template").alias("leaf"), F.posexplode("trail").alias("depth", "template"))
    path_sums = steps.join(sums, ["host", "template", "depth"]).groupBy("host", "leaf").agg(
        F.sort_array(F.collect_list(F.struct("depth", "seen", "bad"))).alias("sums")
    )
    # Each step takes the labels that the next one does not have.
    net = F.transform(
        "sums",
        lambda x, i: F.struct(
            (x["seen"] - F.coalesce(F.get("sums", i + 1)["seen"], F.lit(0))).alias("seen"), (x["bad"] - F.coalesce(F.get("sums", i + 1)["bad"], F.lit(0))).alias("bad")
        ),
    )
    share = F.aggregate(net, F.lit(start).cast("double"), lambda p, x: (x["bad"] + F.lit(PRIOR) * p) / (x["seen"] + F.lit(PRIOR)))
    evidence = F.exists("sums", lambda x: (x["depth"] > 0) & (x["seen"] > 0))
    leaves = path_sums.select("host", F.col("leaf").alias("template"), share.alias("rejected_share"), evidence.alias("labelled"))
    return paths.select("host", "path", "template").join(leaves, ["host", "template"])


def judge(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``rejected_share`` of every url.

    ``labels`` (``host``, ``path``, ``label``) adds to what the rules say.
    """
    host, path = host_and_path(F.col("url"))
    rows = only(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    ruled = rows.withColumn("fit", fitting(rules, F.col("host"), F.col("path")))
    label = F.when(F.col("fit.verdict") == "block", 1).when(F.col("fit.verdict") == "allow", 0)
    urls = ruled.select("host", "path", label.alias("label"))
    if labels is not None:
        urls = urls.unionByName(only(labels, "host", "path", "label"))
    shares = smoothed_shares(urls, levels)
    by_method = F.when(F.col("labelled") & (F.col("rejected_share") > REJECT), "block").otherwise("allow")
    return ruled.join(shares, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_method).alias("verdict"), "template", "rejected_share"
    )


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages"), RULES)

"""URL filters: given rules, and a path-template tree for the URLs that no rule fits.

Rules decide first (the longest that fits).  For the rest the paths of each host form a tree: runs of
digits in a segment are variable, and so are the many rare segments below one node; both become
wildcards, level by level.  Branches whose shares of blocked URLs do not differ statistically from those of
their siblings are merged, at every level.  A template is rejected by its smoothed share of blocked URLs among
those that rules label; the prior is the share of the same template over all hosts, smoothed by the share over
everything.

Only (host, path form) counts are shuffled, aggregated where they are read.

Cases: a null URL, or one without ``://``, has an empty host and path; such URLs, and templates without
any label in reach, follow the share over all labels, and are allowed when there are none; repeated rows
get a row each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressline.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(raw, UPPER, LOWER), F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)


def first_rule(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """The value of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        found = F.when(rule.fits(host, path), value(rule)).otherwise(found)
    return found


def generalised(counts: DataFrame, *, fan_out: int, rare_share: float) -> DataFrame:
    """(host, form, words) from counts of path forms: the segments of each form, variable ones as ``*``.

    The tree is built level by level: what a level has generalised is one node for the next, so that
    branches below a wildcard are counted together.  Levels end where no host has forms enough for a node
    of more than ``fan_out`` branches.
    """
    todo = cut(counts.select("host", "form", "n", F.split("form", "/").alias("segs")).withColumn("words", F.array().cast("array<string>")))
    deep = todo.select("host", F.size("segs").alias("size")).groupBy("host", "size").agg(F.count("*").alias("n"))
    beyond = Window.partitionBy("host").orderBy(F.desc("size"))  # one row for each depth of a host's paths
    levels = deep.withColumn("n", F.sum("n").over(beyond)).where(F.col("n") > fan_out).agg(F.max("size")).first()[0] or 0
    done = todo.where(F.size("segs") <= 0)
    for depth in range(levels):
        ended = todo.where(F.size("segs") <= depth)
        done = done.unionByName(ended)
        here = todo.where(F.size("segs") > depth).withColumn("above", F.array_join("words", "/")).withColumn("seg", F.get("segs", F.lit(depth)))
        per_seg = here.groupBy("host", "above", "seg").agg(F.sum("n").alias("seg_n"))
        # only nodes with many branches have wildcards beside those of digits
        wide = per_seg.groupBy("host", "above").agg(F.sum("seg_n").alias("total"), F.count("*").alias("branches")).where(F.col("branches") > fan_out)
        rare = per_seg.join(wide, ["host", "above"]).where((F.col("seg_n") < rare_share * F.col("total")) & (F.col("seg") != "")).select("host", "above", "seg", F.lit(True).alias("rare"))
        word = F.when(F.col("rare"), F.lit("*")).otherwise(F.translate("seg", "0", "*"))
        todo = cut(here.join(rare, ["host", "above", "seg"], "left").select("host", "form", "n", "segs", F.array_append("words", word).alias("words")))
    rest = F.transform(F.slice("segs", F.size("words") + 1, F.size("segs")), lambda x: F.translate(x, "0", "*"))
    return done.unionByName(todo).select("host", "form", F.concat("words", rest).alias("words"))


def evidence(leaves: DataFrame, merge_z: float) -> DataFrame:
    """(host, template, a, b): the labels that speak for a template of (host, template, words, a, b), after merging.

    A branch whose share of blocked URLs does not differ from that of its siblings together, itself left
    out, is merged with the others of which that holds.  A merged branch stands or falls with its parent:
    the labels of a template are those of the highest pool that it reaches through merged branches only.
    """
    at = F.posexplode(F.transform("words", lambda _, i: F.struct(F.array_join(F.slice("words", F.lit(1), i), "/").alias("parent"), F.array_join(F.slice("words", F.lit(1), i + 1), "/").alias("node")))).alias("depth", "p")
    steps = leaves.select("host", "template", "a", "b", at).select("host", "template", "depth", "p.parent", "p.node", "a", "b")
    nodes = steps.groupBy("host", "depth", "parent", "node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    whole = nodes.groupBy("host", "depth", "parent").agg(F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
    met = nodes.join(whole, ["host", "depth", "parent"])
    n, m = F.col("a") + F.col("b"), F.col("all_a") + F.col("all_b") - F.col("a") - F.col("b")
    share = F.try_divide(F.col("all_b"), F.col("all_a") + F.col("all_b"))
    apart = F.abs(F.try_divide(F.col("b"), n) - F.try_divide(F.col("all_b") - F.col("b"), m))
    z = F.try_divide(apart, F.sqrt(share * (1 - share) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), m))))
    met = met.withColumn("alike", F.coalesce(z < merge_z, F.lit(True)))
    pools = met.where("alike").groupBy("host", "depth", "parent").agg(F.sum("a").alias("pool_a"), F.sum("b").alias("pool_b"))
    met = met.join(pools, ["host", "depth", "parent"], "left").select("host", "depth", "node", "alike", "pool_a", "pool_b")
    path = steps.join(met, ["host", "depth", "node"]).groupBy("host", "template", "a", "b").agg(
        F.coalesce(F.max(F.when(~F.col("alike"), F.col("depth"))), F.lit(-1)).alias("stop"),
        F.array_sort(F.collect_list(F.struct("depth", "pool_a", "pool_b"))).alias("pools"))  # one entry for each segment
    reached = F.get("pools", F.col("stop") + 1)
    return path.select("host", "template", F.coalesce(reached["pool_a"], "a").alias("a"), F.coalesce(reached["pool_b"], "b").alias("b"))


def judge(df: DataFrame, rules: Sequence[Rule], *, id_col: str = "page_id", url_col: str = "url", reject_at: float = 0.5,
          smoothing: float = 10.0, merge_z: float = 1.96, fan_out: int = 64, rare_share: float = 0.01) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, block_share) for every URL."""
    host, path = host_and_path(F.coalesce(F.col(f"`{url_col}`"), F.lit("")))
    urls = df.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    h, p = F.col("host"), F.col("path")
    urls = urls.select("*", first_rule(rules, h, p, lambda r: F.lit(r.text)).alias("rule"), first_rule(rules, h, p, lambda r: F.lit(r.verdict)).alias("by_rule"),
                       F.regexp_replace("path", "[0-9]+", "0").alias("form"))
    counts = urls.groupBy("host", "form").agg(
        F.count("*").alias("n"), F.count_if(F.col("by_rule") == "allow").alias("n_allow"), F.count_if(F.col("by_rule") == "block").alias("n_block"))
    counts = cut(counts)
    forms = generalised(counts, fan_out=fan_out, rare_share=rare_share).join(counts, ["host", "form"])
    forms = cut(forms.withColumn("template", F.array_join("words", "/")))
    leaves = forms.groupBy("host", "template", "words").agg(F.sum("n_allow").alias("a"), F.sum("n_block").alias("b"))
    a, b = F.col("a"), F.col("b")
    overall = leaves.agg(((F.coalesce(F.sum(b), F.lit(0)) + 0.0) / F.greatest(F.coalesce(F.sum(a + b), F.lit(0)), F.lit(1))).alias("share")).first()["share"]
    every = leaves.groupBy("template").agg(((F.sum(b) + smoothing * overall) / (F.sum(a + b) + smoothing)).alias("prior"))
    judged = evidence(leaves, merge_z).join(every, "template").select("host", "template", ((b + smoothing * F.col("prior")) / (a + b + smoothing)).alias("block_share"))
    by_form = forms.select("host", "form", "template").join(judged, ["host", "template"])
    out = urls.join(by_form, ["host", "form"], "left")
    verdict = F.coalesce("by_rule", F.when(F.col("block_share") > reject_at, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "block_share")

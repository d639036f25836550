"""URL filter: rules by host and path, and for the hosts that no rule decides,
trust and distrust spread along the link graph.

Host edges come from the links of the pages (``href`` of any element, absolute
or relative to their page), counted once for each pair of hosts. Trust is a
personalised PageRank over these edges that restarts at hosts by their number
of pages that a rule allows; distrust is the same over reversed edges from
hosts by their number of pages that a rule blocks, so it reaches those that
link to them. A host without edges sends its score back to the restart. A host is
blocked when its distrust is larger than its trust; hosts that neither reaches
are allowed. Scores are summed step by step from what moves on along the edges, and
divided by their sum, which is the same as sending back what does not move. Steps go
on until nothing moves, or what moves is below ``tolerance`` and meets no new host;
what would still follow is then counted as if it moved the same way.

Comments hold no links, and of an element's attributes only ``href`` itself is one.

The tables of a step have one row for each host, whatever the number of its
pages; steps are cut by written tables.

Defined results: a null url, or one without ``://``, has an empty host and path, no
rule, no edges and is allowed; a null html has no links; repeated rows and
repeated page ids are judged each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: str | Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str | Column) -> Column:
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def longest_rule(rules: list[Rule], host: str, path: str) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is tested first
        fits = ((F.col(host) == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): pairs of different hosts with a link, each once; ``pages(host, html)``."""
    seen = F.regexp_replace("html", r"(?s)<!--.*?-->", " ")
    links = F.regexp_extract_all(seen, F.lit(r"""(?i)(?<=[\s"'/])href\s*=\s*["']?\s*([^"'\s>]+)"""), F.lit(1))
    outside = F.filter(F.array_distinct(F.transform(links, _link_host)), lambda h: h != "")
    found = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(outside).alias("dst"))
    return found.where("src <> dst").distinct()


def _link_host(link: Column) -> Column:
    """The host that a link names; '' for a relative one."""
    for sign, written_as in ((":", "#58|#x3a|colon"), ("/", "#47|#x2f|sol"), (".", "#46|#x2e|period")):
        link = F.regexp_replace(link, f"(?i)&(?:{written_as});", sign)
    absolute = F.regexp_extract(link, r"(?i)^(?:https?:)?//([^/?#]+)", 1)
    return F.translate(absolute, UPPER, LOWER)


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, steps: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """(host, kind, score): personalised PageRank of each kind, up to ``tolerance``
    or after ``steps`` if given. ``edges(kind, src, dst)``, ``seeds(kind, host, weight)``."""
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    restart = written(seeds.join(total, "kind").where("weight > 0").select("kind", "host", (F.col("weight") / F.col("total")).alias("start")), "restart")
    out = edges.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("degree"))
    edges = written(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (damping / F.col("degree")).alias("share")), "host-edges")
    moving = restart.withColumnRenamed("start", "score")
    known = [moving]
    for _ in count() if steps is None else range(steps):
        moved = edges.join(moving.withColumnRenamed("host", "src"), ["kind", "src"])
        moved = moved.groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("score") * F.col("share")).alias("score"))
        moving = written(moved, "host-scores")
        left = moving.agg(F.count(F.lit(1)).alias("hosts"), F.sum("score").alias("mass")).first()
        if not left["hosts"]:
            break
        known.append(moving)
        if left["mass"] < tolerance and not moving.join(reduce(DataFrame.unionByName, known[:-1]), ["kind", "host"], "left_anti").limit(1).count():
            break
    rest = moving.withColumn("score", F.col("score") * (damping / (1 - damping)))
    scores = reduce(DataFrame.unionByName, [*known, rest]).groupBy("kind", "host").agg(F.sum("score").alias("score"))
    scores = written(scores, "host-scores")
    sums = scores.groupBy("kind").agg(F.sum("score").alias("total"))  # a row for each kind
    return scores.join(F.broadcast(sums), "kind").select("host", "kind", (F.col("score") / F.col("total")).alias("score"))


def judge(pages: DataFrame, rules: list[Rule], damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages(page_id, url, html)``."""
    pages = pages.select("page_id", url_host("url").alias("host"), url_path("url").alias("path"), "html")
    judged = pages.withColumn("_rule", longest_rule(rules, "host", "path"))
    kinds = F.when(F.col("_rule.verdict") == "allow", "trust").otherwise("distrust")
    seeds = judged.where("_rule is not null and host <> ''").groupBy(kinds.alias("kind"), "host").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    edges = written(host_edges(pages), "links")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")))
    scores = spread(both, seeds, damping, tolerance=tolerance)
    by = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0))
    blocked = written(scores.groupBy("host").agg(by("trust").alias("trust"), by("distrust").alias("distrust")).where("distrust > trust").select("host"), "blocked-hosts")
    out = judged.drop("html").join(blocked.withColumn("_blocked", F.lit(True)), "host", "left")
    method = F.when(F.col("_blocked"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", method).alias("verdict"))

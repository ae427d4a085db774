"""URL filter by a path-template tree (DataFrame functions only).

Method: a url's path becomes a template: segments holding a digit turn into ``*`` at
once, and so do segments at a place of the host's tree that has many different
children for its rows. Templates with the same host and parent are branches. Labelled
branches begin as one group; as long as the block rate of some branch differs significantly
from that of the others in its group, the group is split at its rate.
A template is rejected when its purity, the block share of its group's labelled pages, is
above one half. Purity is smoothed towards the rate of all branches of the parent, that
towards the host's and that towards the corpus', so a template without labelled pages is
judged by its surroundings. Labels are the verdicts of the rules, or a column of the caller's.

Defined results: a null url, or one without ``://``, has empty host and path, no rule
and the verdict of the empty template; equal rows get equal verdicts; an empty table
gives an empty table. A path may have any number of segments: levels of the tree are gone through
as long as enough templates reach them for a place to be variable. Columns named like the result's are
read only through ``id_column`` and ``url_column``, so clashing extra columns do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.store import Scratch

#: A place of the tree is variable with so many different children ...
MIN_CHILDREN = 20
#: ... that make up this share of its pages.
CHILD_SHARE = 0.3
#: Each rate is smoothed by so many pages of the rate above it; a corpus without labels has this rate, which rejects nothing.
PRIOR_PAGES, PRIOR_RATE = 4.0, 0.5
SIMILAR_Z = 1.96
BLOCK_ABOVE = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """verdict for a host with its subdomains, where the path begins with path."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule of a driver-side list, as struct(rule, verdict); else null."""
    ordered = sorted(rules, key=lambda r: -len(r.host + r.path))
    known = F.array(
        *[F.struct(F.lit(r.host).alias("host"), F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")) for r in ordered]
    ).cast("array<struct<host:string,path:string,verdict:string>>")
    dotted = F.concat(F.lit("."), host)
    fits = F.filter(known, lambda r: F.endswith(dotted, F.concat(F.lit("."), r["host"])) & F.startswith(path, r["path"]))
    first = F.get(fits, F.lit(0))
    return F.struct(F.concat(first["host"], first["path"]).alias("rule"), first["verdict"].alias("verdict"))


def lexical_template(path: Column) -> Column:
    """The path's segments, those with a digit as wildcards."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, lambda s: F.when(F.regexp_like(s, F.lit("[0-9]")), F.lit("*")).otherwise(s))


def template_tree(pages: DataFrame) -> DataFrame:
    """(host, lexical, template, n, labelled, blocked) from rows of (host, lexical, label).

    Rows are counted per lexical template first; each level of the tree is written, since
    the next one reads it twice.
    """
    scratch = Scratch(pages.sparkSession)
    nodes = (
        pages.groupBy("host", "lexical")
        .agg(F.count("*").alias("n"), F.count("label").alias("labelled"), F.sum((F.col("label") == "block").cast("long")).alias("blocked"))
        .withColumns({"template": F.col("lexical"), "blocked": F.coalesce("blocked", F.lit(0).cast("long"))})
    )
    nodes = scratch.save(nodes, "nodes")
    level = 0
    while nodes.where(F.size("lexical") > level).limit(MIN_CHILDREN).count() >= MIN_CHILDREN:
        level += 1
        here = F.get("template", F.lit(level - 1))
        placed = nodes.withColumns({"parent": F.slice("template", 1, level - 1), "child": here})
        children = placed.where("child IS NOT NULL AND child <> '*'").groupBy("host", "parent", "child").agg(F.sum("n").alias("n"))
        variable = (
            children.groupBy("host", "parent")
            .agg(F.count("*").alias("children"), F.sum("n").alias("n"))
            .where((F.col("children") >= MIN_CHILDREN) & (F.col("children") >= CHILD_SHARE * F.col("n")))
            .select("host", "parent", F.lit(True).alias("variable"))
        )
        wild = F.concat(F.slice("template", 1, level - 1), F.array(F.lit("*")), F.slice("template", F.lit(level + 1), F.size("template")))
        nodes = (
            placed.join(variable, ["host", "parent"], "left")
            .withColumn("template", F.when(F.col("variable") & F.col("child").isNotNull(), wild).otherwise(F.col("template")))
            .drop("parent", "child", "variable")
        )
        nodes = scratch.save(nodes, f"level{level}")
    return nodes


def branch_groups(branches: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds group to labelled branches (host, parent, template, labelled, blocked).

    A round tests each branch against the others of its group together, so branches that are
    alike only by way of a third do not stay together. Groups are summed, not sorted.
    """
    group = ["host", "parent", "group"]
    rows, turn = branches.withColumn("group", F.lit("")), 0
    while True:
        turn += 1
        totals = rows.groupBy(*group).agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))
        n, others = F.col("labelled"), F.col("all_labelled") - F.col("labelled")
        pooled = F.col("all_blocked") / F.col("all_labelled")
        error = F.sqrt(pooled * (1 - pooled) * (1 / n + F.try_divide(F.lit(1), others)))
        apart = F.col("blocked") / n - F.try_divide(F.col("all_blocked") - F.col("blocked"), others)
        tested = rows.join(totals, group).withColumn("differs", F.coalesce(F.abs(apart) > SIMILAR_Z * error, F.lit(False)))
        tested = scratch.save(tested, f"tested{turn}")
        split = tested.where("differs").select(*group).distinct().withColumn("splits", F.lit(True))
        if split.isEmpty():
            return rows
        side = F.when(F.col("splits"), F.when(F.col("blocked") / n < pooled, f"{turn}<").otherwise(f"{turn}>")).otherwise("")
        rows = tested.join(split, group, "left").withColumn("group", F.concat("group", side))
        rows = scratch.save(rows.drop("all_labelled", "all_blocked", "differs", "splits"), f"groups{turn}")


def _smoothed(above: Column) -> Column:
    return (F.sum("blocked") + PRIOR_PAGES * above) / (F.sum("labelled") + PRIOR_PAGES)


def template_purity(nodes: DataFrame) -> DataFrame:
    """(host, template, purity): block rates of groups of similar branches, smoothed towards parent, host and corpus."""
    scratch = Scratch(nodes.sparkSession)
    branches = nodes.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    parent = F.slice("template", F.lit(1), F.greatest(F.size("template") - 1, F.lit(0)))
    branches = scratch.save(branches.withColumn("parent", parent), "branches")
    corpus = branches.agg(_smoothed(F.lit(PRIOR_RATE))).first()[0]
    corpus = PRIOR_RATE if corpus is None else corpus
    hosts = branches.groupBy("host").agg(_smoothed(F.lit(corpus)).alias("host_rate"))
    places = branches.join(hosts, "host").groupBy("host", "parent", "host_rate").agg(_smoothed(F.col("host_rate")).alias("place_rate"))
    places = scratch.save(places.drop("host_rate"), "places")
    labelled = branch_groups(branches.where("labelled > 0"), scratch)
    grouped = labelled.join(places, ["host", "parent"]).groupBy("host", "parent", "group", "place_rate")
    grouped = grouped.agg(_smoothed(F.col("place_rate")).alias("purity")).drop("place_rate")
    known = labelled.join(grouped, ["host", "parent", "group"]).select("host", "template", "purity")
    other = branches.where("labelled = 0").join(places, ["host", "parent"]).select("host", "template", F.col("place_rate").alias("purity"))
    return known.unionByName(other)


def filter_urls(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: tuple[Rule, ...] = RULES,
    label_column: str | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of pages.

    label_column may hold allow, block or null per page; by default the rules' verdicts
    are the labels. The rules are a short driver-side list, tried on each row.
    """
    host, path = host_and_path(F.col(url_column))
    given = F.col(label_column) if label_column else F.lit(None).cast("string")
    rows = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"), given.alias("given"))
    hit = best_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("hit", hit).select("page_id", "host", "path", "given", "hit.rule", F.col("hit.verdict").alias("ruled"))
    rows = rows.withColumns({"lexical": lexical_template(F.col("path")), "label": F.coalesce("given", "ruled")})
    nodes = template_tree(rows)
    known = nodes.select("host", "lexical", "template").join(template_purity(nodes), ["host", "template"])
    judged = F.when(F.col("purity") > BLOCK_ABOVE, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(known, ["host", "lexical"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", judged).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "purity",
    )

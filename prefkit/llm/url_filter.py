"""URL filter by a tree of path templates.

Rules judge the urls that they fit. They also label them, and from these labels the rest is judged:
for every host the paths form a tree, segment by segment. Frequent and labelled segments are branches,
the long tail of a place is one wildcard. Labelled sibling branches whose share of allowed urls does not
differ statistically are merged; a branch without labels stays alone. What remains are templates; a template is rejected if enough of its urls are
labelled and the smoothed share of allowed ones is too low, also at the upper end of its confidence
interval.

All of it is DataFrame operations on distinct paths; one aggregate, two small tables and one join
per level of the tree. The tree has no fixed depth: it goes on below a place as long as the urls there
differ, some labelled and some not, or some allowed and some blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefkit.llm.common import written

#: Levels of the tree for all paths. Below them it goes on at every place whose labels do not settle it.
DEPTH = 4
#: Urls that such a place needs below it; with fewer there is nothing to tell apart.
OPEN_SUPPORT = 6
#: Urls that a segment needs to be a branch of its own; rarer ones are their place's tail.
LEAST_SUPPORT = 3
#: Urls with which a segment is a branch whatever else occurs at its place.
OWN_SUPPORT = 50
#: With fewer urls a segment is a branch if it is labelled, or if it has this share of its place's urls
#: and the place is not variable: at most TAIL_SHARE of the urls lie below rare segments.
FREQUENT_SHARE = 0.01
TAIL_SHARE = 0.5
#: Two siblings are merged while their shares differ by less than this many standard errors.
SIMILAR = 1.96
#: Urls' worth of prior belief, and the share below which a template is rejected. A template without
#: labels keeps the prior, which is never below one half, so it is not rejected.
PRIOR_WEIGHT = 4.0
LEAST_PURITY = 0.5
#: A template is rejected if the share is too low by this many standard errors, and if at least this
#: share of its urls is labelled.
SURE = 1.96
LEAST_LABELLED = 0.1
#: Segments that the name of a merged branch lists; of further ones it gives the number.
NAMED = 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path
    (then up to ``?``, ``#`` or the end). A null url, or one without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of ``rules`` (``host/path`` -> verdict) that fits, else null. A rule fits its host
    and all subdomains if the path starts with the rule's. Of rules of equal length the first in
    code-point order is taken."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def literal_segments(kids: DataFrame) -> DataFrame:
    """Those of ``kids`` (prefix, seg, n, labelled, and further columns) that are branches of their own.

    Each segment is judged by its own urls and labels and by shares of its place's urls, never by how
    many segments the place has, so that a table that grows does not turn frequent segments into ``*``.
    """
    rare = F.sum(F.when(F.col("n") < LEAST_SUPPORT, F.col("n")).otherwise(0))
    places = kids.groupBy("prefix").agg(F.sum("n").alias("place_n"), rare.alias("rare_n"))
    frequent = (F.col("n") >= FREQUENT_SHARE * F.col("place_n")) & (F.col("rare_n") <= TAIL_SHARE * F.col("place_n"))
    own = (F.col("n") >= OWN_SUPPORT) | (F.col("labelled") > 0) | frequent
    return kids.filter(F.col("n") >= LEAST_SUPPORT).join(places, "prefix").filter(own).drop("place_n", "rare_n")


def merged_siblings(literals: DataFrame, prior: float) -> DataFrame:
    """``literals`` (prefix, seg, good, labelled) with ``branch``: the names of all siblings merged.

    A segment without labels is a branch of its own: nothing says that it is like its siblings. Of the
    others, those mostly blocked and those mostly allowed are kept apart. They stand in the order of
    their smoothed share; a branch ends where the share of the next one differs significantly. Siblings
    with the same labels never differ, so the window is over the distinct pairs of label counts of a
    place.
    """
    alone = literals.filter("labelled = 0").select("prefix", "seg", F.col("seg").alias("branch"))
    literals = literals.filter("labelled > 0")
    share = (F.col("good") + PRIOR_WEIGHT * prior) / (F.col("labelled") + PRIOR_WEIGHT)
    mostly = F.col("good") >= LEAST_PURITY * F.col("labelled")
    order = Window.partitionBy("prefix").orderBy("mostly", "share", "labelled")
    rows = literals.select("prefix", "good", "labelled").distinct().withColumn("share", share).withColumn("mostly", mostly)
    weight = F.col("labelled") + PRIOR_WEIGHT
    before = F.lag(weight).over(order)
    difference = F.col("share") - F.lag("share").over(order)
    pooled = (F.col("share") * weight + F.lag("share").over(order) * before) / (weight + before)
    error = F.sqrt(pooled * (1 - pooled) * (1 / weight + 1 / before))
    apart = (difference > SIMILAR * error) | (F.lag("mostly").over(order) != F.col("mostly"))
    new = F.when(before.isNotNull() & apart, 1).otherwise(0)
    rows = rows.withColumn("new", new).withColumn("nth", F.sum("new").over(order))
    rows = literals.join(rows.select("prefix", "good", "labelled", "nth"), ["prefix", "good", "labelled"])
    rows = rows.select("prefix", "seg", "nth")
    first = F.row_number().over(Window.partitionBy("prefix", "nth").orderBy("seg"))
    names = rows.withColumn("at", first).filter(F.col("at") <= NAMED).groupBy("prefix", "nth")
    names = names.agg(F.array_join(F.array_sort(F.collect_list("seg")), "|").alias("names"))
    more = rows.groupBy("prefix", "nth").agg((F.count("*") - NAMED).alias("more"))
    branch = F.when(F.col("more") > 0, F.concat("names", F.lit("|+"), F.col("more").cast("string"))).otherwise(F.col("names"))
    names = names.join(more, ["prefix", "nth"]).withColumn("branch", branch)
    return rows.join(names, ["prefix", "nth"]).select("prefix", "seg", "branch").unionByName(alone)


def _one_level(tree: DataFrame, level: int, prior: float) -> DataFrame:
    """``tree`` with ``prefix`` longer by one segment, a branch or ``*``, where the path has one."""
    seg = F.when(F.size("segs") > level, F.get("segs", F.lit(level)))
    tree = tree.withColumn("seg", seg)
    kids = tree.filter("seg IS NOT NULL").groupBy("prefix", "seg")
    kids = kids.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("labelled").alias("labelled"))
    kids = written(kids, f"url-level{level}")
    literals = written(literal_segments(kids), f"url-literals{level}")
    branches = written(merged_siblings(literals, prior), f"url-branches{level}")
    names = branches.select(F.col("prefix").alias("_p"), F.col("seg").alias("_s"), "branch")
    tree = tree.join(names, (F.col("prefix") == F.col("_p")) & (F.col("seg") == F.col("_s")), "left")
    deeper = F.concat(F.col("prefix"), F.lit("/"), F.coalesce("branch", F.lit("*")))
    tree = tree.withColumn("prefix", F.when(F.col("seg").isNotNull(), deeper).otherwise(F.col("prefix")))
    return tree.drop("_p", "_s", "branch", "seg")


def open_places(deeper: DataFrame) -> DataFrame:
    """Places (``_o``) below which the urls ``deeper`` differ: some are labelled, and some have another label
    or none."""
    places = deeper.groupBy("prefix").agg(*[F.sum(c).alias(c) for c in ("n", "good", "labelled")])
    mixed = (F.col("labelled") < F.col("n")) | ((F.col("good") > 0) & (F.col("good") < F.col("labelled")))
    unsettled = (F.col("n") >= OPEN_SUPPORT) & (F.col("labelled") > 0) & mixed
    return places.filter(unsettled).select(F.col("prefix").alias("_o"))


def path_templates(paths: DataFrame, prior: float, depth: int = DEPTH) -> DataFrame:
    """``paths`` (host, key, segs, n, good, labelled) with ``template``.

    The first ``depth`` levels are built for all; below them only open places go on, a level at a time,
    until there are none. A closed place's deeper urls are one template, ``**``."""
    tree = paths.withColumn("prefix", F.col("host"))
    for level in range(depth):
        tree = _one_level(tree, level, prior)
    level, done = depth, []
    while True:
        tree = written(tree, "url-tree")
        done.append(tree.filter(F.size("segs") <= level).withColumnRenamed("prefix", "template"))
        deeper = tree.filter(F.size("segs") > level)
        places = written(open_places(deeper), "url-open")
        same = F.col("prefix") == F.col("_o")
        closed = deeper.join(places, same, "left_anti").withColumn("template", F.concat("prefix", F.lit("/**")))
        done.append(closed.drop("prefix"))
        if places.isEmpty():
            break
        tree = _one_level(deeper.join(places, same).drop("_o"), level, prior)
        level += 1
    out = done[0].select(*paths.columns, "template")
    for part in done[1:]:
        out = out.unionByName(part.select(*paths.columns, "template"))
    return out


def judge(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict (allow or block), template,
    purity (the smoothed share of allowed urls of the template). Urls without a rule are blocked if the
    purity is below LEAST_PURITY by SURE standard errors and LEAST_LABELLED of the template's urls are
    labelled.

    Defined cases: a null url or one without ``://`` has empty host and path and belongs to the
    template of the empty host; urls may be of any length; repeated rows are judged alike; without any
    labelled url nothing is rejected; an empty table gives no rows. Only the id and url are read.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    said = F.create_map(*[F.lit(x) for pair in sorted(rules.items()) for x in pair]) if rules else None
    given = F.element_at(said, F.col("rule")) if rules else F.lit(None).cast("string")
    rows = written(rows.withColumn("given", given), "url-rows")
    segs = F.filter(F.split("path", "/"), lambda s: s != "")
    paths = rows.groupBy("host", F.array_join(segs, "/").alias("key")).agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("given") == "allow", 1)).alias("good"),
        F.count("given").alias("labelled"),
    )
    paths = paths.withColumn("segs", F.filter(F.split("key", "/"), lambda s: s != ""))
    paths = written(paths, "url-paths")
    totals = paths.agg(F.sum("good").alias("good"), F.sum("labelled").alias("labelled")).first()
    prior = max(0.5, totals["good"] / totals["labelled"]) if totals["labelled"] else 0.5
    tree = written(path_templates(paths, prior), "url-templates")
    purity = (F.sum("good") + PRIOR_WEIGHT * prior) / (F.sum("labelled") + PRIOR_WEIGHT)
    templates = tree.groupBy("template").agg(purity.alias("purity"), F.sum("labelled").alias("labelled"), F.sum("n").alias("n"))
    error = F.sqrt(F.col("purity") * (1 - F.col("purity")) / (F.col("labelled") + PRIOR_WEIGHT))
    low = F.col("purity") + SURE * error < LEAST_PURITY
    templates = templates.select("template", "purity", (low & (F.col("labelled") >= LEAST_LABELLED * F.col("n"))).alias("rejected"))
    judged = tree.select("host", "key", "template").join(templates, "template")
    rows = rows.withColumn("key", F.array_join(segs, "/"))
    out = rows.join(judged, ["host", "key"])
    learned = F.when(F.col("rejected"), "block").otherwise("allow")
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("given", learned).alias("verdict"), "template", "purity"
    )

"""Audits of a crawl: robots rules, nofollow, depth and redirects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crawlweave.functions import urls
from crawlweave.session import Buckets, written


def robots_audit(visits: DataFrame, robots_rules: DataFrame) -> DataFrame:
    """Visits with the robots rule that governs them and ``disallowed``.

    ``robots_rules``: host, rule (Allow or Disallow), path (prefix, with ``*``
    and a final ``$``). The longest rule wins, Allow on a tie. The rules of a
    host are one file of limited size and travel as one array per host, so a
    visit stays one row through the join.
    """
    ends = F.endswith("path", F.lit("$"))
    pieces = F.split(F.when(ends, F.substr("path", F.lit(1), F.length("path") - 1)).otherwise(F.col("path")), r"\*", -1)
    rules = (
        robots_rules.filter(F.col("path") != "")
        .groupBy(F.lower("host").alias("host"))
        .agg(
            F.collect_set(
                F.struct(
                    F.length("path").alias("len"),
                    (F.lower("rule") == "allow").alias("allow"),
                    F.col("path").alias("path"),
                    pieces.alias("pieces"),
                    ends.alias("ends"),
                )
            ).alias("rules")
        )
    )
    target = F.concat(urls.path(F.col("url")), F.regexp_extract(F.col("url"), r"^[^?#]*(\?[^#]*)", 1))
    located = visits.withColumn("_target", target).withColumn("host", urls.host(F.col("url")))
    joined = located.join(rules, "host", "left")
    url_text = F.col("_target")

    def after(rule: Column) -> Column:
        """Where the match of all pieces of a rule ends, each piece at its first place after the one before; null without one."""
        first = F.when(F.startswith(url_text, rule["pieces"][0]), F.length(rule["pieces"][0]))
        found = lambda piece, at: F.position(piece, url_text, at + 1)
        step = lambda at, piece: F.when(found(piece, at) > 0, found(piece, at) - 1 + F.length(piece))
        return F.aggregate(F.slice(rule["pieces"], 2, F.size(rule["pieces"])), first, step)

    def hit(rule: Column) -> Column:
        last = F.element_at(rule["pieces"], -1)
        # before a closing $ the last piece stands at the very end, and the others end before it
        whole = F.when(F.size(rule["pieces"]) == 1, url_text == last).otherwise(
            F.endswith(url_text, last) & after(rule).isNotNull() & (F.length(url_text) >= after(rule))
        )
        return F.when(rule["ends"], whole).otherwise(after(rule).isNotNull())

    hits = F.filter("rules", lambda r: F.coalesce(hit(r), F.lit(False)))
    return (
        joined.withColumn("_best", F.array_max(hits))
        .withColumn("matched_path", F.col("_best.path"))
        .withColumn("disallowed", F.coalesce(~F.col("_best.allow"), F.lit(False)))
        .drop("_best", "_target", "rules")
    )


def nofollow_flags(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links with the three nofollow marks.

    ``links``: source_url, target_url, rel (nullable). ``pages``: url, meta_robots
    and x_robots_tag (nullable).
    """
    mark = lambda c: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit("nofollow"))
    by_page = pages.groupBy(F.col("url").alias("source_url")).agg(
        F.max(mark("meta_robots")).alias("meta_nofollow"), F.max(mark("x_robots_tag")).alias("header_nofollow")
    )
    return (
        links.withColumn("rel_nofollow", mark("rel"))
        .join(by_page, "source_url", "left")
        .fillna(False, ["meta_nofollow", "header_nofollow"])
    )


def nofollow_audit(flagged: DataFrame, visits: DataFrame) -> DataFrame:
    """Nofollow links whose target was visited though no followable link leads there."""
    any_mark = F.col("rel_nofollow") | F.col("meta_nofollow") | F.col("header_nofollow")
    targets = flagged.groupBy("target_url").agg(
        F.count_if("rel_nofollow").alias("rel_links"),
        F.count_if("meta_nofollow").alias("meta_links"),
        F.count_if("header_nofollow").alias("header_links"),
        F.count_if(~any_mark).alias("open_links"),
    )
    only_marked = targets.filter((F.col("open_links") == 0))
    seen = visits.select(F.col("url").alias("target_url")).distinct()
    return only_marked.join(seen, "target_url", "left_semi").drop("open_links")


def crawl_depth(links: DataFrame, seeds: DataFrame, max_depth: int = 0) -> DataFrame:
    """Least number of links from a seed to each URL, per crawl.

    ``links``: crawler_uuid, source_url, target_url. ``seeds``: crawler_uuid,
    url. ``max_depth`` 0 goes on until a level finds nothing new. Edges and
    reached URLs lie in buckets of (crawl, URL), so that a level shuffles only
    what its frontier links to. One job per level.
    """
    spark = links.sparkSession
    edges, reached = Buckets(spark, "links", ["crawler_uuid", "url"]), Buckets(spark, "reached", ["crawler_uuid", "url"])
    try:
        edges.append(links.select("crawler_uuid", F.col("source_url").alias("url"), F.col("target_url").alias("next_url")).distinct())
        reached.append(seeds.select("crawler_uuid", "url").distinct().withColumn("depth", F.lit(0)))
        depth = 0
        while depth != (max_depth or -1) and not reached.rows().filter(F.col("depth") == depth).isEmpty():
            frontier = reached.rows().filter(F.col("depth") == depth)
            found = frontier.join(edges.rows(), ["crawler_uuid", "url"]).select("crawler_uuid", F.col("next_url").alias("url"))
            depth += 1
            known = reached.rows().select("crawler_uuid", "url")
            reached.append(found.distinct().join(known, ["crawler_uuid", "url"], "left_anti").withColumn("depth", F.lit(depth)))
        return reached.files()
    finally:
        edges.forget()
        reached.forget()


def ends_of(step: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed, open) of steps (url, next) with one row for each URL, by pointer doubling.

    ``closed``: url, end, hops of those that come to a URL without a step. A
    chain of 2**k hops takes k rounds. The URLs of a chain have ends at all
    smaller distances, so a round that closes none leaves only those that never
    end: ``open``: url, end, hops, all of them the same number of hops further.
    """
    state = written(step.select("url", F.col("next").alias("end"), F.lit(1).cast("bigint").alias("hops")), "hops")
    going = state.join(state.select(F.col("url").alias("end")), "end", "left_semi").select("url", "end", "hops")
    closed = written(state.join(state.select(F.col("url").alias("end")), "end", "left_anti").select("url", "end", "hops"), "hops-closed")
    going, new = written(going, "hops-open"), closed
    while not (new.isEmpty() or going.isEmpty()):
        known = closed.withColumn("done", F.lit(True)).unionByName(going.withColumn("done", F.lit(False)))
        further = known.select(F.col("url").alias("end"), F.col("end").alias("_end"), F.col("hops").alias("_hops"), "done")
        moved = going.join(further, "end").select("url", F.col("_end").alias("end"), (F.col("hops") + F.col("_hops")).alias("hops"), "done")
        moved = written(moved, "hops-moved")
        new = moved.filter("done").drop("done")
        going, closed = moved.filter(~F.col("done")).drop("done"), closed.unionByName(new)
    return closed, going


def cycles_of(step: DataFrame, jumps: DataFrame) -> DataFrame:
    """(url, size) of the URLs on cycles, where no chain ends.

    ``jumps`` (url, end): where each URL is after some number of hops. What can
    be reached by twice as many hops shrinks until only cycles are left; then
    each cycle is named by its least URL, again by doubling.
    """
    image = written(jumps.select(F.col("end").alias("url")).distinct(), "images")
    left = image.count()
    while left:
        twice = jumps.select("url", "end").join(jumps.select(F.col("url").alias("end"), F.col("end").alias("_end")), "end")
        jumps = written(twice.select("url", F.col("_end").alias("end")), "jumps")
        image = written(jumps.select(F.col("end").alias("url")).distinct(), "images")
        before, left = left, image.count()
        if left == before:
            break
    # least URL among the first 2**k of each cycle, until no round changes one
    names = written(step.join(image, "url", "left_semi").select("url", F.col("next").alias("end"), F.col("url").alias("least")), "cycles")
    changed = bool(left)
    while changed:
        ahead = names.select(F.col("url").alias("end"), F.col("end").alias("_end"), F.col("least").alias("_least"))
        moved = names.join(ahead, "end").select("url", F.col("_end").alias("end"), F.least("least", "_least").alias("least"), (F.col("_least") < F.col("least")).alias("lower"))
        moved = written(moved, "cycles")
        changed = not moved.filter("lower").isEmpty()
        names = moved.drop("lower")
    sizes = names.groupBy("least").agg(F.count(F.lit(1)).alias("size"))
    return names.join(sizes, "least").select("url", "size")


def redirect_chains(hops: DataFrame, order: str | None = None) -> DataFrame:
    """Where each redirecting URL ends, after how many hops, and whether it loops.

    ``hops``: from_url, to_url. A URL that was seen to redirect to several
    targets keeps the one of its last row by ``order``, without it the smallest.
    A chain that loops ends at the first URL it meets again, its hops include
    the way round. Every URL keeps one row. A chain of n hops takes log2(n) joins.
    """
    target = F.max_by("to_url", order) if order else F.min("to_url")
    step = written(hops.groupBy(F.col("from_url").alias("url")).agg(target.alias("next")).filter(F.col("url").isNotNull()), "redirects")
    closed, endless = ends_of(step)
    out = closed.select(F.col("url").alias("from_url"), F.col("end").alias("end_url"), F.col("hops").cast("int").alias("hops"), F.lit(False).alias("is_loop"))
    if endless.isEmpty():
        return out
    looping = step.join(endless, "url", "left_semi")
    round_trips = written(cycles_of(looping, endless), "cycle-sizes")
    tails, _ = ends_of(looping.join(round_trips, "url", "left_anti"))  # chains that end where a cycle begins
    entry = round_trips.select(F.col("url").alias("end_url"), "size")
    into = tails.select(F.col("url").alias("from_url"), F.col("end").alias("end_url"), "hops").join(entry, "end_url")
    around = entry.select(F.col("end_url").alias("from_url"), "end_url", F.lit(0).cast("bigint").alias("hops"), "size")
    loops = into.unionByName(around).select("from_url", "end_url", (F.col("hops") + F.col("size")).cast("int").alias("hops"), F.lit(True).alias("is_loop"))
    return out.unionByName(loops)

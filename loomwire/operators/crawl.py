"""Crawl order over landed pages: where each chain of next links from a start reaches, and in which step.

A crawler from a start page follows next links and stops at a page without one, at a page that was not landed, or at a
page it has seen (cycles are cut at the first repeat). Here that is list ranking on DataFrames, over numbers of pages:

1. The pages on cycles: after 2^k steps from anywhere only pages with 2^k pages before them are left; when no two of
   them link to the same page and each has a link, they are the cycles. A cycle's name is its smallest page, by minima
   over runs of 2^k pages.
2. The length of the walk from each page: the links to the end or to a cycle, by pointer doubling, and the cycle's size.
3. Each start's walk by doubling rows: (start, page, step) from (start, start, 0); level k adds (start, J_k(page),
   step + 2^k) for the rows of steps below 2^k, as far as the walk's length goes. J_0 is the next link, J_(k+1)(v) =
   J_k(J_k(v)). A level writes its new rows only.

The rows are the walks' own, each listed once; a cycle is not walked again, whatever the number of pages. All tables
grow with the pages, so joins merge them in the tasks. Runs Spark jobs while it is built.

Defined results: pages with a null address are left out; of repeated addresses the smallest next link stays;
a next link to itself or to a page not landed ends the walk; starts that are not landed give no rows; every start is
walked alone, so walks that meet list their shared pages each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..session import in_tasks, written


def _twice(jump: DataFrame) -> DataFrame:
    """Jumps of twice the span."""
    return written(jump.alias("a").join(in_tasks(jump.alias("b")), F.col("a.to") == F.col("b.page")).select(
        F.col("a.page").alias("page"), F.col("b.to").alias("to")))


def _on_cycles(jump: DataFrame) -> DataFrame:
    """The links (page, to) between pages on cycles."""
    ahead = jump
    while True:
        left = written(ahead.select(F.col("to").alias("page")).distinct())
        links = written(jump.join(in_tasks(left), "page", "left_semi"))
        if links.select("to").distinct().count() == left.count():
            return links
        ahead = _twice(ahead)


def _cycle_sizes(links: DataFrame) -> DataFrame:
    """(page, size) from the links between pages on cycles."""
    runs = written(links.select("page", "to", F.least("page", "to").alias("low")))
    while True:
        runs = written(runs.alias("a").join(in_tasks(runs.alias("b")), F.col("a.to") == F.col("b.page")).select(
            F.col("a.page").alias("page"), F.col("b.to").alias("to"), F.least("a.low", "b.low").alias("low"),
            (F.col("a.low") != F.col("b.low")).alias("more")))
        if runs.where("more").isEmpty():
            sizes = runs.groupBy("low").agg(F.count("*").alias("size"))
            return written(runs.join(in_tasks(sizes), "low").select("page", "size"))


def _walk_lengths(jump: DataFrame) -> DataFrame:
    """(page, size): the number of pages of the walk from each page with a link."""
    cycles = _on_cycles(jump)
    sizes = _cycle_sizes(cycles)
    ends = written(jump.join(in_tasks(cycles), "page", "left_anti").select("page", "to", F.lit(1).cast("long").alias("n")))
    while True:
        ends = written(ends.alias("a").join(in_tasks(ends.alias("b")), F.col("a.to") == F.col("b.page"), "left").select(
            F.col("a.page").alias("page"), F.coalesce("b.to", "a.to").alias("to"),
            (F.col("a.n") + F.coalesce("b.n", F.lit(0))).alias("n"), F.col("b.n").isNotNull().alias("more")))
        if ends.where("more").isEmpty():
            break
    rest = in_tasks(sizes.withColumnRenamed("page", "to"))
    tails = ends.join(rest, "to", "left").select("page", (F.col("n") + F.coalesce("size", F.lit(1))).alias("size"))
    return sizes.unionByName(tails)


def crawl_positions(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(start, page, position) from links (page, next) and starts (start)."""
    pages = written(links.where(F.col("page").isNotNull()).groupBy("page").agg(F.min("next").alias("next")).select(
        F.monotonically_increasing_id().alias("id"), "page", "next"))
    jump = written(pages.alias("a").join(in_tasks(pages.alias("b")), F.col("a.next") == F.col("b.page")).where(
        F.col("a.id") != F.col("b.id")).select(F.col("a.id").alias("page"), F.col("b.id").alias("to")))
    names = pages.select("id", "page")
    asked = starts.select(F.col("start")).distinct().join(in_tasks(names.withColumnRenamed("page", "start")), "start")
    sizes = _walk_lengths(jump).withColumnRenamed("page", "id")
    walks = [written(asked.join(in_tasks(sizes), "id", "left").select(
        F.col("id").alias("start"), F.col("id").alias("page"), F.lit(0).cast("long").alias("step"),
        F.coalesce("size", F.lit(1)).alias("size")))]
    span = 1
    while True:
        so_far = reduce(DataFrame.unionByName, walks).where(F.col("step") + span < F.col("size"))
        ahead = written(so_far.join(in_tasks(jump), "page").select(
            "start", F.col("to").alias("page"), (F.col("step") + span).alias("step"), "size"))
        if ahead.isEmpty():
            break
        walks.append(ahead)
        span, jump = span * 2, _twice(jump)
    listed = reduce(DataFrame.unionByName, walks).select(F.col("page").alias("id"), "start", "step")
    found = listed.join(in_tasks(names), "id").select(F.col("start").alias("id"), "page", F.col("step").alias("position"))
    return found.join(in_tasks(names.withColumnRenamed("page", "start")), "id").select("start", "page", "position")

"""The person - company graph: vertices, edges, shared companies, bounded expansion.

Pairs of people are never written out per company: rows of members state them,
``repeated_pairs`` has all that share two or more, with their companies,
``pair_weight`` answers exactly for any pair, and ``top_pairs`` finds the heaviest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieproof.functions.text import strip, text
from tieproof.operators.ordered import with_position
from tieproof.session import written

NOT_NAMED = ("(unspecified)", "unknown")
#: Members of a company up to which all pairs of them are written out; larger companies are met by a prefix filter.
FEW = 32


def is_named(person: Column) -> Column:
    p = strip(text(person))
    return (p != "") & ~F.lower(p).isin(*NOT_NAMED)


def members(edges: DataFrame) -> DataFrame:
    """Distinct (company, person)."""
    return edges.where(is_named(F.col("person"))).select("company", "person").distinct()


def shared_companies(edges: DataFrame) -> DataFrame:
    """``company, person, members``: any two rows of a company are a pair; one form for companies of all sizes."""
    m = members(edges)
    return m.join(m.groupBy("company").agg(F.count("*").alias("members")), "company").where("members > 1")


def pair_weight(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exact number of shared companies of the given (source, target) pairs.

    Of each pair the companies of the person with fewer of them are looked up
    among those of the other, so a person in many companies costs nothing.
    """
    m = members(edges)
    degree = m.groupBy("person").agg(F.count("*").alias("degree"))
    sized = pairs.select("source", "target").distinct()
    for side in ("source", "target"):
        sized = sized.join(degree.select(F.col("person").alias(side), F.col("degree").alias(f"{side}_degree")), side)
    fewer = F.col("source_degree") <= F.col("target_degree")
    sized = sized.select("source", "target", F.when(fewer, F.col("source")).otherwise(F.col("target")).alias("walked"),
                         F.when(fewer, F.col("target")).otherwise(F.col("source")).alias("other"))
    left = sized.join(m.withColumnRenamed("person", "walked"), "walked")
    both = left.join(m.select(F.col("person").alias("other"), "company"), ["other", "company"], "left_semi")
    return (
        pairs.join(both.groupBy("source", "target").agg(F.count("*").alias("weight")), ["source", "target"], "left")
        .withColumn("weight", F.coalesce("weight", F.lit(0)))
    )


def repeated_pairs(edges: DataFrame, few: int = FEW, shared: DataFrame | None = None) -> DataFrame:
    """``source, target, weight, companies`` (sorted, joined by "; ") of every pair that shares two or more companies.

    ``shared`` are the written ``shared_companies``, where a caller has them.
    """
    m = written(shared_companies(edges)) if shared is None else shared
    pairs = _met(m, few, F.collect_list("company").alias("shared"))
    return pairs.select("source", "target", F.size("shared").cast("long").alias("weight"),
                        F.concat_ws("; ", F.sort_array("shared")).alias("companies"))


def _met(m: DataFrame, few: int, found: Column, least: int = 2) -> DataFrame:
    """``source, target`` of the pairs that share ``least`` or more companies (two at least), with ``found`` over these companies.

    ``m`` is written ``shared_companies``. Pairs meet in every company of at most
    ``few`` members, and are counted there at once. For larger ones an exact prefix
    filter holds: of two shared companies one at least is not the commonest large one
    of either person (companies in one order, by members and name), so pairs meet in
    companies that are the commonest large one of none of the two; that one is looked
    up, for pairs with such a person only. Pairs that share a single company are the
    member rows of ``shared_companies``.
    """
    large = m.where(F.col("members") > few)
    if large.isEmpty():
        met = _pairs(m.withColumn("last", F.lit(None).cast("string"))).select("company", "source", "target")
    else:
        last = large.groupBy("person").agg(F.max(F.struct("members", "company"))["company"].alias("last"))
        rare = written(_pairs(m.join(last, "person", "left").where("last IS NULL OR company <> last")))
        asked = rare.where("last_source IS NOT NULL OR last_target IS NOT NULL").select(
            "source", "target", "last_source", "last_target").distinct()
        either = F.array_distinct(F.array_compact(F.array("last_source", "last_target")))
        asked = asked.select(F.explode(either).alias("company"), "source", "target")
        for side in ("source", "target"):
            asked = asked.join(large.select("company", F.col("person").alias(side)), ["company", side], "left_semi")
        met = rare.select("company", "source", "target").union(asked.select("company", "source", "target"))
    pairs = met.groupBy("source", "target").agg(F.count("*").alias("_n"), found)
    return pairs.where(F.col("_n") >= max(least, 2)).drop("_n")


def _pairs(m: DataFrame) -> DataFrame:
    """``company, source, target, last_source, last_target``: the members of a company, two and two."""
    left = m.select("company", F.col("person").alias("source"), F.col("last").alias("last_source"))
    right = m.select("company", F.col("person").alias("target"), F.col("last").alias("last_target"))
    return left.join(right, "company").where("source < target")


def top_pairs(edges: DataFrame, k: int, start: int = 64, few: int = FEW) -> DataFrame:
    """``source, target, weight`` of the ``k`` pairs with most shared companies, ties by name.

    A pair can't share more companies than either person has. The ``k``-th weight
    among the ``start`` people with most companies is a bound: people with fewer
    companies are in no heavier pair, so the exact pairs are those among the rest,
    however many have the same degree. Where fewer than ``k`` pairs share two
    companies, those that share one follow in the order of names. Only the bound
    and a count reach the driver.
    """
    order = [F.desc("weight"), F.col("source"), F.col("target")]
    weight = F.count("*").alias("weight")
    m = written(shared_companies(edges))
    degree = m.groupBy("person").agg(F.count("*").alias("degree"))
    some = m.join(degree.orderBy(F.desc("degree"), "person").limit(start), "person", "left_semi")
    first = _met(some, few, weight).orderBy(*order).limit(k).agg(F.count("*").alias("n"), F.min("weight").alias("weight")).first()
    least = first["weight"] if first["n"] == k else 2
    able = m.join(degree.where(F.col("degree") >= least), "person", "left_semi") if least > 2 else m
    top = written(_met(able, few, weight, least).orderBy(*order).limit(k).select("source", "target", "weight"))
    found = top.count()
    if found == k:
        return top.orderBy(*order)
    single = _first_pairs(m, k + found).join(top, ["source", "target"], "left_anti").withColumn("weight", F.lit(1).cast("long"))
    return top.union(single.select("source", "target", "weight")).orderBy(*order).limit(k)


def _first_pairs(m: DataFrame, n: int) -> DataFrame:
    """The first ``n`` pairs by name of people who share a company.

    Everybody but the last member of a company is the first of some pair, so the
    first ``n`` of those are all that can be needed, whatever their companies hold.
    """
    last = m.groupBy("company").agg(F.max("person").alias("last"))
    sources = m.join(last, "company").where("person <> last").select("person").distinct().orderBy("person").limit(n)
    mine = m.join(sources, "person", "left_semi").select("company", F.col("person").alias("source"))
    pairs = mine.join(m.select("company", F.col("person").alias("target")), "company").where("source < target")
    return pairs.select("source", "target").distinct().orderBy("source", "target").limit(n)


def degrees(edges: DataFrame) -> DataFrame:
    """Distinct companies per person."""
    return members(edges).groupBy("person").agg(F.count("*").alias("degree"))


def repeat_counts(edges: DataFrame) -> DataFrame:
    """People listed with more than one company, repeats included."""
    return (
        edges.where(is_named(F.col("person"))).groupBy("person").agg(F.count("*").alias("n_companies"))
        .where("n_companies > 1")
    )


def people(edges: DataFrame, order: Column) -> DataFrame:
    """One vertex per person with the attributes of its first edge, the graduation year too where edges have it."""
    fields = [c for c in ("school", "role", "grad_year") if c in edges.columns]
    return (
        edges.where(is_named(F.col("person"))).groupBy(strip(F.col("person")).alias("label"))
        .agg(F.min_by(F.struct(*fields), order).alias("_a"))
        .select(F.concat(F.lit("P:"), F.col("label")).alias("id"), "label", F.lit("person").alias("type"), "_a.*")
    )


def companies(records: DataFrame) -> DataFrame:
    """One vertex per company with the attributes of its last record."""
    fields = ["company_name", "validation_tier", "status", "founded_year", "funding_total_usd", "industry",
              "headquarters", "proof_url"]
    return (
        records.groupBy(F.concat(F.lit("C:"), strip(F.col("company_name"))).alias("id"))
        .agg(F.max_by(F.struct(*fields), "rec_seq").alias("_a"))
        .select("id", F.col("_a.company_name").alias("label"), F.lit("company").alias("type"),
                F.col("_a.validation_tier").alias("tier"), "_a.status", "_a.founded_year", "_a.funding_total_usd",
                "_a.industry", "_a.headquarters", F.col("_a.proof_url").alias("url"))
    )


def person_company(edges: DataFrame, order: Column, vertices: DataFrame | None = None) -> DataFrame:
    """Every edge, repeats included, with the school of the person's vertex (``vertices``: the written ``people``, if at hand)."""
    v = (people(edges, order) if vertices is None else vertices).select(F.col("label").alias("person_name"), "school")
    named = edges.where(is_named(F.col("person"))).select(
        strip(F.col("person")).alias("person_name"), F.col("company").alias("company_name")
    )
    return named.join(v, "person_name").select(
        F.concat(F.lit("P:"), "person_name").alias("source"), F.concat(F.lit("C:"), "company_name").alias("target"),
        F.lit("founded_or_role").alias("type"), "person_name", "company_name", "school",
    )


def person_person(edges: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """Edges between people who share two or more companies, with weight and label (the companies, sorted).

    Those who share one are the rows of ``shared_companies``.
    """
    return repeated_pairs(edges, shared=shared).select(
        F.concat(F.lit("P:"), "source").alias("source"), F.concat(F.lit("P:"), "target").alias("target"),
        F.lit("shared_company").alias("type"), "weight", F.col("companies").alias("label"))


def expand(edges: DataFrame, seeds: DataFrame, hops: int = 1, budget: int | None = None) -> DataFrame:
    """People reachable from ``seeds`` over shared companies: ``person, hop, rank, via``.

    Each hop joins the new people to companies not met before, and those to people
    not met before; what a hop found is written, so that its size is known and the
    edges, which are read as they are, need no shuffle where few were found. ``via`` is the first by name of the companies that lead to a
    person, ``rank`` the place among the people of the hop: those that more of the
    new companies lead to come first, then by name. With a ``budget`` only the
    first that many of a hop are visited and lead further; the others may still
    be met in a later hop. Seeds are hop 0, cut by the budget too, by name.
    """
    m = written(edges.where(is_named(F.col("person"))).select("company", "person"))
    start = seeds.where(is_named(F.col("person"))).select("person").distinct()
    start = start.withColumns({"hop": F.lit(0), "links": F.lit(0).cast("long"), "via": F.lit(None).cast("string")})
    frontier, met, seen = written(_ranked(start, budget)), None, None
    for hop in range(hops + 1):
        seen = frontier if seen is None else seen.union(frontier)
        if hop == hops or frontier.isEmpty():
            break
        reached = m.join(frontier, "person", "left_semi").select("company").distinct()
        if met is not None:
            reached = reached.join(met, "company", "left_anti")
        reached = written(reached)
        met = reached if met is None else met.union(reached)
        fresh = m.join(reached, "company", "left_semi").join(seen, "person", "left_anti").distinct().groupBy("person").agg(
            F.count("*").alias("links"), F.min("company").alias("via"))
        frontier = written(_ranked(fresh.withColumn("hop", F.lit(hop + 1)), budget))
    return seen.select("person", "hop", "rank", "via")


def _ranked(people: DataFrame, budget: int | None) -> DataFrame:
    """``person, hop, rank, via``: places by links and name, counted over ranges of the order; the first ``budget`` of them."""
    less = people.withColumn("_less", -F.col("links"))
    if budget is not None:
        less = less.orderBy("_less", "person").limit(budget)
    placed = with_position(less, [], ["_less", "person"])
    return placed.select("person", "hop", (F.col("pos") + 1).alias("rank"), "via")

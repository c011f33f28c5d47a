"""Mixing sources to target weights: exact block quotas, split over output shards by a multivariate-hypergeometric tree.

1. Each source gets a target in words: shares of the total by weight, no target above LIMIT times its source, the excess shared again.
2. A target is q whole passes over its source and a rest. The documents of a source are dealt into blocks by a hash; the rest is a
   number of whole blocks in permuted order, then documents of one more block in permuted order while they
   fit, then the document of that block that comes nearest to what is left. If that misses the rest by as much as a document of the
   block (a very long one stood in the way), documents that do not fit are skipped, and the nearest one more is added to those that do.
3. The drawn blocks of a source are its exact quota. From the root on, a node's quotas are split between two halves of the shards:
   for each source the left half's number is drawn from the hypergeometric distribution, given what is left of the node.
4. A shard's share of a source is the next interval of the source's permuted blocks: shards are disjoint and complete. Within a
   shard, documents are ordered by a hash.

All randomness is md5 of seed and names, so reruns and retries agree. Only sources, blocks and documents' sizes are aggregated; a hot
source is many blocks. Tables of sources and of blocks are small beside the documents (a block has BLOCK_WORDS words); no size is
assumed for joins. A null text has size 0; null sources are one source that comes last; documents of size 0 go along with their
block. Repeated rows are documents of their own; rows equal in id and size are
drawn together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pcmarts.llm.common import WORD, let, saved

LIMIT, BLOCK_WORDS, SHARD_LEVELS, SHARD_WORDS, SEED = 3, 1 << 18, 4, 1 << 25, 7
WEIGHTS = (1, 2, 3)
SPREAD = 12  # standard deviations around the mean in which the hypergeometric distribution has all its mass in double precision


def _hash(*parts: Column) -> Column:
    """md5 of seed and parts; null parts are told from empty ones."""
    return F.md5(F.concat_ws("|", F.lit(str(SEED)), *(F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("")) for p in parts)))


def _number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, size): total words shared by weight, no target above limit * source_size.

    Weights repeat over the sources in code-point order, null last. In the order of cap / weight, the first source that is not cut
    sets the share of a unit of weight.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.isnull("source"), "source")  # over sources, not rows
    found = found.withColumn("turn", (F.row_number().over(by_name) - 1) % len(weights))
    found = found.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1)).withColumn("cap", limit * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.isnull("source"), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    found = found.withColumn("unit", left / F.sum("weight").over(onward))
    enough = F.when(F.col("cap") / F.col("weight") >= F.col("unit"), F.struct(F.col("cap") / F.col("weight"), "unit"))
    found = found.withColumn("share", F.min(enough).over(every)["unit"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("share") * F.col("weight"), F.col("cap").cast("double")))
    return found.select("source", "source_size", target.alias("target"))


RUN = "array<struct<lo:string,hi:string>>"


def _within(key: Column, runs: Column) -> Column:
    return F.exists(runs, lambda r: (key >= r["lo"]) & (key <= r["hi"]))


def _skipping(groups: Column, need: Column) -> Column:
    """(runs of keys, words missed): of (key, w) in order, those that fit into what is left; then the one that comes nearest to the rest."""

    def step(a: Column, g: Column) -> Column:
        fits, runs = g["w"] <= a["left"], a["runs"]
        longer = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(F.get(runs, F.size(runs) - 1)["lo"].alias("lo"), g["key"].alias("hi"))))
        added = F.concat(runs, F.array(F.struct(g["key"].alias("lo"), g["key"].alias("hi"))))
        return F.struct(
            F.when(fits, a["left"] - g["w"]).otherwise(a["left"]).alias("left"),
            F.when(~fits, runs).when(a["open"], longer).otherwise(added).cast(RUN).alias("runs"), fits.alias("open"),
        )

    start = F.struct(need.cast("double").alias("left"), F.array().cast(RUN).alias("runs"), F.lit(False).alias("open"))

    def one_more(a: Column) -> Column:
        off = lambda g: F.abs(g["w"] - a["left"])
        others = F.filter(groups, lambda g: ~_within(g["key"], a["runs"]) & (off(g) < a["left"]))
        nearest = F.array_min(F.transform(others, lambda g: F.struct(off(g).alias("off"), g["key"].alias("key"))))
        last = lambda o: F.when(o.isNull(), a["runs"]).otherwise(F.concat(a["runs"], F.array(F.struct(o["key"].alias("lo"), o["key"].alias("hi"))).cast(RUN)))
        return let(nearest, lambda o: F.struct(last(o).alias("runs"), F.coalesce(o["off"], a["left"]).alias("missed")))

    return let(F.aggregate(groups, start, step), one_more)


def _blocks(sizes: DataFrame, weights: tuple[int, ...], block_words: int, skip: bool) -> DataFrame:
    """A row per block of a source: its words, what is drawn of it in the extra pass, and of a part the last key that fits and one more, or runs of keys."""
    wanted = targets(sizes, weights)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    wanted = wanted.withColumn("passes", passes).withColumn("rest", F.col("target") - passes * F.col("source_size"))
    wanted = wanted.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("bigint"))
    w = wanted.withColumnRenamed("source", "name")
    rows = sizes.withColumn("key", _hash(F.lit("doc"), F.col("doc_id"), F.col("size")))
    rows = rows.join(w, F.col("source").eqNullSafe(F.col("name"))).withColumn("block", _number(F.col("key"), 12) % F.col("blocks"))
    blocks = rows.groupBy("source", "block").agg(F.sum("size").alias("words"), *(F.first(c).alias(c) for c in ("source_size", "target", "passes", "rest")))
    order = Window.partitionBy("source").orderBy(_hash(F.lit("block"), F.col("source"), F.col("block")), "block")
    blocks = blocks.withColumn("ahead", F.sum("words").over(order) - F.col("words")).withColumn("need", F.col("rest") - F.col("ahead"))
    drawn = F.when(F.col("need") >= F.col("words"), "whole").when(F.col("need") > 0, "part").otherwise("none")
    blocks = blocks.withColumn("drawn", F.when(F.col("words") == 0, "none").otherwise(drawn))
    part = blocks.where("drawn = 'part'").select(F.col("source").alias("name"), F.col("block").alias("in_block"), "need")
    inside = rows.select("source", "block", "key", "doc_id", "size").join(part, F.col("source").eqNullSafe(F.col("name")) & (F.col("block") == F.col("in_block")))
    whole = Window.partitionBy("source", "block")
    inside = inside.withColumn("upto", F.sum("size").over(whole.orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)))
    inside = inside.withColumn("fits", F.col("upto") <= F.col("need"))
    inside = inside.withColumn("left", F.col("need") - F.coalesce(F.max(F.when(F.col("fits"), F.col("upto"))).over(whole), F.lit(0)))
    if skip:
        inside = inside.withColumn("w", F.sum("size").over(Window.partitionBy("source", "block", "key")))  # equal keys are drawn together
    off = F.abs(F.col("size") - F.col("left"))
    last = inside.groupBy("source", "block").agg(
        F.max(F.when(F.col("fits"), F.col("key"))).alias("last_key"),
        F.min(F.when(~F.col("fits") & (off < F.col("left")), F.struct(off.alias("off"), "key"))).alias("one"),
        *([F.first("need").alias("need"), F.array_sort(F.collect_set(F.when(F.col("w") > 0, F.struct("key", "w")))).alias("groups")] if skip else []),
    ).withColumn("one_key", F.col("one.key"))
    last = _runs(last) if skip else last.withColumn("runs", F.lit(None).cast(RUN))
    last = last.select(F.col("source").alias("name"), F.col("block").alias("in_block"), "last_key", "one_key", "runs")
    same = F.col("source").eqNullSafe(F.col("name")) & (F.col("block") == F.col("in_block"))
    return blocks.join(last, same, "left").drop("name", "in_block")


def _runs(last: DataFrame) -> DataFrame:
    """last with runs: the keys that are drawn with documents skipped, where that is needed and comes nearer; null elsewhere."""
    fitting = lambda g: F.coalesce(g["key"] <= F.col("last_key"), F.lit(False)) | F.coalesce(g["key"] == F.col("one_key"), F.lit(False))
    missed = F.abs(F.col("need") - F.aggregate("groups", F.lit(0).cast("bigint"), lambda a, g: a + F.when(fitting(g), g["w"]).otherwise(0)))
    last = last.withColumn("missed", missed).withColumn("least", F.array_min(F.transform("groups", lambda g: g["w"])))
    last = last.withColumn("skipping", F.when(F.col("missed") >= F.col("least"), _skipping(F.col("groups"), F.col("need"))))
    return last.withColumn("runs", F.when(F.col("skipping.missed") < F.col("missed"), F.col("skipping.runs")))


def _hypergeometric(total: Column, good: Column, taken: Column, u: Column) -> Column:
    """The number of good ones among `taken` of `total`, by inversion at u in [0, 1): weights around the mean, in logarithms."""
    mean = taken * good / total
    sd = F.sqrt(mean * (1 - good / total) * F.greatest(F.lit(0.0), (total - taken) / F.greatest(total - 1, F.lit(1))))
    least, most = F.greatest(F.lit(0).cast("bigint"), taken - (total - good)), F.least(taken, good)
    lo = F.greatest(least, F.floor(mean - SPREAD * sd - SPREAD).cast("bigint"))
    hi = F.least(most, F.ceil(mean + SPREAD * sd + SPREAD).cast("bigint"))
    step = lambda k: F.log((good - k + 1) * (taken - k + 1) / (k * (total - good - taken + k)))  # noqa: E731  from k - 1 to k

    def draw(low: Column) -> Column:
        ks = F.filter(F.sequence(low, hi), lambda k: k > low)
        peak = F.aggregate(ks, F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("m")), lambda a, k: let(a["w"] + step(k), lambda w: F.struct(w.alias("w"), F.greatest(a["m"], w).alias("m"))))["m"]

        def inverted(m: Column) -> Column:
            mass = F.aggregate(ks, F.struct(F.lit(0.0).alias("w"), F.exp(-m).alias("s")), lambda a, k: let(a["w"] + step(k), lambda w: F.struct(w.alias("w"), (a["s"] + F.exp(w - m)).alias("s"))))["s"]

            def at(s: Column) -> Column:
                start = F.struct(F.lit(0.0).alias("w"), F.exp(-m).alias("s"), low.alias("k"))
                more = lambda a, k: let(a["w"] + step(k), lambda w: F.struct(w.alias("w"), (a["s"] + F.exp(w - m)).alias("s"), F.when(a["s"] <= u * s, k).otherwise(a["k"]).alias("k")))
                return F.aggregate(ks, start, more)["k"]

            return let(mass, at)

        return let(peak, inverted)

    return F.when(lo >= hi, lo).otherwise(let(lo, draw))


ENTRY = "struct<no:int,n:bigint>"


def _deal(level: int):
    """A step over the sources of a node: the next source's blocks that go to the left half."""

    def step(a: Column, x: Column) -> Column:
        u = _number(_hash(F.lit("split"), F.lit(level), F.col("node"), x["no"]), 13) / F.lit(float(16**13))
        got = F.when(a["t"] > 0, _hypergeometric(a["t"], x["n"], a["w"], u)).otherwise(F.lit(0).cast("bigint"))
        add = lambda g: F.concat(a["out"], F.array(F.struct(x["no"].alias("no"), g.alias("n")).cast(ENTRY)))
        return let(got, lambda g: F.struct(add(g).alias("out"), (a["t"] - x["n"]).alias("t"), (a["w"] - g).alias("w")))

    return step


def split_tree(quotas: DataFrame, levels: int = SHARD_LEVELS) -> DataFrame:
    """(source_no, shard, n) from (source_no, quota): how many of a source's blocks go to each of 2 ** levels shards.

    A node is one row with an array of its sources' quotas. Its left half gets half of its blocks; source after source, that half's
    number is drawn given what is left of both, so the numbers follow the multivariate hypergeometric distribution.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col("source_no").cast("int").alias("no"), F.col("quota").cast("bigint").alias("n"))))
    nodes = quotas.agg(ordered.cast(f"array<{ENTRY}>").alias("q")).select(F.lit(0).alias("node"), "q")
    for level in range(levels):
        total = F.aggregate("q", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
        nodes = nodes.withColumn("total", total)
        odd = _number(_hash(F.lit("odd"), F.lit(level), F.col("node")), 1) % 2
        nodes = nodes.withColumn("want", F.floor((F.col("total") + odd) / 2).cast("bigint"))
        start = F.struct(F.array().cast(f"array<{ENTRY}>").alias("out"), F.col("total").alias("t"), F.col("want").alias("w"))

        nodes = nodes.withColumn("left", F.aggregate("q", start, _deal(level))["out"])
        right = F.zip_with("q", "left", lambda x, y: F.struct(x["no"].alias("no"), (x["n"] - y["n"]).alias("n")).cast(ENTRY))
        halves = F.array(F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("q")), F.struct((2 * F.col("node") + 1).alias("node"), right.alias("q")))
        nodes = nodes.select(F.explode(halves).alias("h")).select("h.node", "h.q")
        if level % 6 == 5:
            nodes = nodes.repartition("node")  # the next levels' nodes are worked on side by side
    return nodes.select("node", F.explode("q").alias("c")).select(F.col("c.no").alias("source_no"), F.col("node").alias("shard"), "c.n")


def places(cells: DataFrame) -> DataFrame:
    """(source_no, at, shard): a row per drawn block; a shard has the next interval of a source's permuted blocks."""
    upto = F.sum("n").over(Window.partitionBy("source_no").orderBy("shard"))
    cells = cells.withColumn("upto", upto).where("n > 0")
    return cells.select("source_no", F.explode(F.sequence(F.col("upto") - F.col("n"), F.col("upto") - 1)).alias("at"), "shard")


def shard_levels(words: int) -> int:
    """Levels of the tree for a mix of so many words: shards of about SHARD_WORDS, 2 ** SHARD_LEVELS of them at least."""
    return max(SHARD_LEVELS, math.ceil(math.log2(max(1, words) / SHARD_WORDS)))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, levels: int | None = None, block_words: int = BLOCK_WORDS, text: str = "text", source: str = "source", skip: bool = True) -> DataFrame:
    """docs with size, source_size, target and draws: an array of (pass, shard), a row's place in the mix for each time it is drawn.

    skip: documents that do not fit are skipped as in step 2; without, the cut block ends as the SQL of op8 states.
    """
    sizes = saved(docs.select(F.col("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "sizes")
    blocks = saved(_blocks(sizes, weights, block_words, skip), "blocks")
    quota = F.sum(F.col("passes") + F.when(F.col("drawn") == "none", 0).otherwise(1))
    quotas = blocks.groupBy("source").agg(quota.alias("quota")).withColumn("source_no", F.row_number().over(Window.orderBy(F.isnull("source"), "source")))
    if levels is None:
        levels = shard_levels(sizes.agg(F.sum("size")).first()[0] or 0)
    units = blocks.select("source", "block", F.explode(F.filter(F.sequence(F.lit(0), F.col("passes")), lambda p: (p < F.col("passes")) | (F.col("drawn") != "none"))).alias("pass"))
    order = Window.partitionBy("source").orderBy(_hash(F.lit("unit"), F.col("source"), F.col("block"), F.col("pass")), "block", "pass")
    names = quotas.select(F.col("source").alias("name"), "source_no")
    units = units.withColumn("at", (F.row_number().over(order) - 1).cast("bigint")).join(names, F.col("source").eqNullSafe(F.col("name")))
    units = units.join(places(split_tree(quotas.select("source_no", "quota"), levels)), ["source_no", "at"])
    units = units.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("units"))
    units = units.select(F.col("source").alias("u_source"), F.col("block").alias("u_block"), "units")
    plan = blocks.join(units, F.col("source").eqNullSafe(F.col("u_source")) & (F.col("block") == F.col("u_block")), "left")
    per_source = blocks.groupBy("source").agg(F.max("source_size").alias("_words"))
    counts = per_source.select(F.col("source").alias("_s"), F.greatest(F.lit(1), F.ceil(F.col("_words") / block_words)).cast("bigint").alias("_blocks"))
    plan = plan.select(*(F.col(c).alias(f"_p_{c}") for c in ("source", "block", "source_size", "target", "passes", "drawn", "last_key", "one_key", "runs", "units")))
    rows = docs.withColumn("_size", word_count(F.col(text)))
    rows = rows.withColumn("_key", _hash(F.lit("doc"), F.col("doc_id"), F.col("_size")))
    rows = rows.join(counts, F.col(source).eqNullSafe(F.col("_s"))).withColumn("_block", _number(F.col("_key"), 12) % F.col("_blocks"))
    rows = rows.join(plan, F.col(source).eqNullSafe(F.col("_p_source")) & (F.col("_block") == F.col("_p_block")))
    fitting = F.coalesce(F.col("_key") <= F.col("_p_last_key"), F.lit(False)) | F.coalesce(F.col("_key") == F.col("_p_one_key"), F.lit(False))
    extra = (F.col("_p_drawn") == "whole") | ((F.col("_p_drawn") == "part") & F.coalesce(_within(F.col("_key"), F.col("_p_runs")), fitting))
    draws = F.filter(F.coalesce("_p_units", F.array().cast("array<struct<pass:int,shard:int>>")), lambda x: (x["pass"] < F.col("_p_passes")) | extra)
    kept = [F.col(c) for c in docs.columns if c not in ("size", "source_size", "target", "draws")]
    return rows.select(*kept, F.col("_size").alias("size"), F.col("_p_source_size").alias("source_size"), F.col("_p_target").alias("target"), draws.alias("draws"))


def mixed(docs: DataFrame, shards: bool = True, **options: object) -> DataFrame:
    """The rows of the mix, a row for each time a document is drawn, with the columns of docs; with shards: dealt and ordered by shard."""
    names = [options.get("text", "text"), options.get("source", "source")]
    apart = docs.select("doc_id", *names, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))  # no column of docs meets one of the mix
    rows = mix(apart, **options).select("doc_id", "_row", F.explode("draws").alias("_draw"))
    if shards:
        rows = rows.withColumn("_order", _hash(F.lit("order"), F.col("_draw.pass"), F.col("doc_id")))
        rows = rows.repartition("_draw.shard").sortWithinPartitions("_draw.shard", "_order")
    return rows.select("_row.*")

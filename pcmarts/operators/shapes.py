"""Operators for combining tables without wide joins.

``stack`` puts facts of one grain on top of each other so a single aggregation (one shuffle, with
map-side combine) replaces "aggregate each, then join". ``with_every`` and ``mentions`` combine a
large table with a list of any length by equality joins; no plan depends on a count taken before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIST = 4096  # right rows that travel as one value
GRAM = 3  # characters of the substrings by which names are found
FLAGS = 1 << 14  # flags of the substrings that names have


def stack(*parts: DataFrame) -> DataFrame:
    """UNION ALL by name; a column a part does not have is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_every(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each left row once per right row.

    The right rows are dealt into lists of about ``LIST`` rows; a left row meets every list, by the list's number, and is
    unfolded next to it. The number of lists is part of the query (a scalar subquery), so one plan serves any length.
    """
    lists = right.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(LIST))).cast("int").alias("n"))
    number = F.pmod(F.xxhash64(*right.columns), lists.scalar()).cast("int")
    listed = right.groupBy(number.alias("_list")).agg(F.collect_list(F.struct(*right.columns)).alias("_rows"))
    spread = left.withColumn("_list", F.explode(F.sequence(F.lit(0), lists.scalar() - 1)))
    return spread.join(listed, "_list").select(*left.columns, F.inline("_rows"))


def _grams(text: Column, size: int) -> Column:
    """The text's substrings of `size` characters, in one pass: a position after the other, found by looking ahead."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def _flag(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FLAGS)).cast("int")


def _by_rarest_gram(names: DataFrame, first: str, second: str) -> DataFrame:
    """(first, second, needle, gram): for either string of a name the gram that the fewest names have.

    A string of up to GRAM characters is its own gram, the empty one too.
    """
    needles = F.array(*[F.struct(F.lit(k).alias("needle"), F.col(c).alias("string")) for k, c in enumerate((first, second))])
    each = names.select(first, second).distinct().select(first, second, F.inline(needles)).where(F.col("string").isNotNull())
    grams = F.when(F.length("string") > GRAM, F.array_distinct(_grams(F.col("string"), GRAM))).otherwise(F.array("string"))
    each = each.select(first, second, "needle", F.explode(grams).alias("gram"))
    common = each.groupBy("gram").agg(F.count(F.lit(1)).alias("_names"))
    rarest = F.min(F.struct("_names", "gram"))["gram"]
    return each.join(common, "gram").groupBy(first, second, "needle").agg(rarest.alias("_gram"))


def mentions(left: DataFrame, text: str, names: DataFrame, first: str, second: str) -> DataFrame:
    """Left rows with each name row whose ``first`` or ``second`` string occurs in the text.

    Texts are matched, not rows. A text's distinct substrings of one to GRAM characters (as many as it is long, whatever the
    names) meet the names by their rarest gram, and ``contains`` decides. Before they are unfolded, substrings are held against
    FLAGS flags of the names' grams, so that a long text is not copied for each of its substrings. A stream's rows are
    matched one by one, as they come.
    """
    index = _by_rarest_gram(names, first, second)
    used = index.agg(F.collect_set(_flag(F.col("_gram"))).alias("used"))  # FLAGS numbers at most
    flags = used.select(F.transform(F.sequence(F.lit(0), F.lit(FLAGS - 1)), lambda k: F.array_contains("used", k)).alias("flags")).scalar()
    texts = left if left.isStreaming else left.select(text).distinct()
    of_text = F.array_distinct(F.concat(F.array(F.lit("")), *[_grams(F.col(text), n) for n in range(1, GRAM + 1)]))
    texts = texts.withColumn("_flags", flags)
    met = texts.select(*left.columns if left.isStreaming else [text], F.explode(F.filter(of_text, lambda g: F.get("_flags", _flag(g)))).alias("_piece"))
    has_first, has_second = (F.coalesce(F.col(text).contains(F.col(c)), F.lit(False)) for c in (first, second))
    hits = met.join(index, F.col("_piece") == F.col("_gram")).where(F.when(F.col("needle") == 0, has_first).otherwise(has_second & ~has_first))
    hits = hits.drop("_piece", "_gram", "needle").withColumnsRenamed({first: "_first", second: "_second"})
    same = F.col("_first").eqNullSafe(F.col(first)) & F.col("_second").eqNullSafe(F.col(second))
    hits = hits.join(names, same).drop("_first", "_second")
    return hits if left.isStreaming else left.join(hits, text)

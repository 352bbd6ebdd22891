"""A film-shaped raw catalogue derived from the driver's TPC-H-like tables.

The driver tables hold no nulls and no text dirt, so the dirt a raw CSV
export carries is derived deterministically from row keys (every order is
kept; the key only decides which kind of dirt a row gets):

* title       ' ' + customer name + ' ' + order year + ' '  (repeats); 'None',
              NBSP and tab around it, or over 300 characters for some keys
* release_year order year as text
* director / language / country   customer name / segment / nation name;
              over-long, null tokens, a country of three titles ('Atlantis')
              and two countries with equal totals ('Tie A', 'Tie B')
* duration    line count as text; 'N/A', '#N/A', '95.5' or 'abc' for some keys
* budget      order total as text; 'unknown', '0', '0.01', '1e5' or '$5' for
              some keys (0.01 gives an ROI beyond decimal(10,2))
* box_office  sum of line net prices (decimal) times the nation's number, as
              text; 'unknown' for open ('P') orders with even keys; NULL for
              an order without lines
* genre       comma list of part types in line order, one line in three
              tagged with the typo 'Econmy', one in three with a leading
              blank; every typo of the dictionary, empty pieces, padded,
              wrong-case and over-long tags on some lines; 'NaN' for some keys

Key 1, 2, ... of a rule below means: o_orderkey divisible by that number.
Money is cast to decimal before any arithmetic so the text is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.tags import GENRE_CORRECTIONS
from marquee.sources.tables import read_table

RAW_COLUMNS = ("title", "release_year", "director", "language", "country",
               "duration", "budget", "box_office", "genre")

# Fixed values for the derived catalogue: the injected typo and its fix, and
# tier cut points sized to its money amounts (about 1e5).
CATALOG_CORRECTIONS = {"Econmy": "ECONOMY"}
# Tags of lines whose (order key + line number) % 40 is the place in the list:
# all typos, then an empty piece, a padded, a wrong-case and an over-long tag.
LINE_TAGS = (*GENRE_CORRECTIONS, "", "\u00a0Drama\t", "horor", "g" * 101)
CATALOG_BUDGET_CUTS = (100_000, 200_000, 400_000)
CATALOG_ROI_CUTS = (0, 100, 500)


def order_lines(spark: SparkSession, root: str) -> DataFrame:
    """Per-order line count, net amount and ordered tag list.

    lineitem joins part on the part key (a sort-merge or, when AQE sees part
    small, broadcast join); the lines then shuffle once on l_orderkey. The
    tag list holds one entry per line of one order (a bounded group)."""
    li = read_table(spark, root, "lineitem",
                    ["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount"])
    part = read_table(spark, root, "part", ["p_partkey", "p_type"])
    rem = F.col("l_linenumber") % 3
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % 40
    dirty = F.element_at(F.array(*map(F.lit, LINE_TAGS)), (kind + 1).cast("int"))
    tag = (F.when(kind < len(LINE_TAGS), dirty).when(rem == 0, F.lit("Econmy"))
            .when(rem == 1, F.concat(F.lit(" "), F.col("p_type")))
            .otherwise(F.col("p_type")))
    # price (cents) * (1 - discount) (hundredths) in exact long units of
    # 1e-4: the decimal(12,2) * decimal(3,2) product without a wide decimal
    # sum buffer; turned back into decimal(18,4) after the aggregate.
    cents = (F.col("l_extendedprice").cast("decimal(12,2)") * 100).cast("long")
    keep = (F.lit(100) - (F.col("l_discount").cast("decimal(3,2)") * 100).cast("long"))
    # Shuffle the joined lines on the order key first: the aggregate (and the
    # later join to orders) then use this one exchange, and the collect_list
    # runs after the shuffle in parallel tasks. A map-side combine would not
    # shrink a list of every line's tag; at sf0.1 this is ~40% faster.
    lines = li.join(part, li.l_partkey == part.p_partkey, "inner").repartition("l_orderkey")
    return (lines.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 (F.sum(cents * keep).cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(4,4)"))
                 .alias("net_amount"),
                 F.array_join(F.transform(
                     F.sort_array(F.collect_list(F.struct("l_linenumber", "p_partkey", tag.alias("tag")))),
                     lambda s: s.getField("tag")), ",").alias("genre")))


def raw_catalog(spark: SparkSession, root: str) -> DataFrame:
    """One raw text row per order: ``o_orderkey`` (kept as a tie-break key)
    plus the nine raw catalogue columns, all strings."""
    orders = read_table(spark, root, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, root, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    nation = read_table(spark, root, "nation", ["n_nationkey", "n_name"])
    lines = order_lines(spark, root)

    base = (orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
                  .join(nation, customer.c_nationkey == nation.n_nationkey, "inner")
                  .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    key = F.col("o_orderkey")
    year = F.year("o_orderdate").cast("string")
    name_year = F.concat(F.col("c_name"), F.lit(" "), year)
    net = (F.col("net_amount").cast("decimal(18,4)") * (F.col("n_nationkey") + 1)).cast("decimal(22,4)")

    def every(n: int):
        return key % n == 0

    return base.select(
        key,
        F.when(every(101), F.lit("None"))
         .when(every(103), F.concat(F.lit("\u00a0\t"), name_year, F.lit("\t\u00a0")))
         .when(every(107), F.concat(F.col("c_name"), F.lit("x" * 300)))
         .otherwise(F.concat(F.lit(" "), name_year, F.lit(" "))).alias("title"),
        year.alias("release_year"),
        F.when(every(109), F.lit("d" * 201)).otherwise(F.col("c_name")).alias("director"),
        F.when(every(113), F.lit("l" * 101)).when(every(127), F.lit("n/a"))
         .otherwise(F.col("c_mktsegment")).alias("language"),
        F.when(key.between(1, 3), F.lit("Atlantis")).when(key == 4, F.lit("Tie A")).when(key == 5, F.lit("Tie B"))
         .when(every(131), F.lit("NA")).when(every(137), F.lit("c" * 101))
         .otherwise(F.col("n_name")).alias("country"),
        F.when(every(11), F.lit("N/A")).when(every(139), F.lit("#N/A")).when(every(149), F.lit("95.5"))
         .when(every(151), F.lit("abc"))
         .otherwise(F.col("n_lines").cast("string")).alias("duration"),
        F.when(every(13), F.lit("unknown")).when(every(17), F.lit("0")).when(every(157), F.lit("0.01"))
         .when(every(163), F.lit("1e5")).when(every(167), F.lit("$5"))
         .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("budget"),
        F.when(key.between(1, 3), F.lit("10")).when(key.between(4, 5), F.lit("1000"))
         .when((F.col("o_orderstatus") == "P") & (key % 2 == 0), F.lit("unknown"))
         .otherwise(net.cast("string")).alias("box_office"),
        F.when(every(173), F.lit("NaN")).otherwise(F.col("genre")).alias("genre"),
    )

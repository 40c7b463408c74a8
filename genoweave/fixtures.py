"""Peaks, experiments, chromosomes and sequences derived from the standard tables, in Spark and in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK, BLOCK, BIN, VAL, WINDOW = 4096, 16384, 1024, ("chr6", "chr7"), 4096


class Tables:
    """The derived tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def peaks(self) -> DataFrame:
        start = (F.col("l_partkey") * 104729 + F.col("l_orderkey") * 7919) % 60000
        return self.read("lineitem").select(
            F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("chrom"), start.alias("start"), (start + 50 + F.col("l_quantity").cast("long") * 9).alias("end"),
            F.concat(F.lit("SRX"), F.lpad(F.col("l_partkey").cast("string"), 7, "0")).alias("srx"), (F.floor("l_extendedprice") % 1990 + 10).cast("int").alias("score"),
        )

    def experiments(self) -> DataFrame:
        words = F.split("p_name", " ")
        return self.read("part").filter("p_size % 29 <> 0").select(
            F.concat(F.lit("SRX"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("srx"), F.lit("hg38").alias("org"), F.col("p_type").alias("ag_class"), F.col("p_brand").alias("antigen"),
            words[1].alias("ct_class"), words[0].alias("celltype"), F.col("p_partkey").alias("line_no"),
        )

    def sizes(self) -> DataFrame:
        """A chromosome ends 7,000 positions for each of its number beyond its last peak."""
        return self.peaks().groupBy("chrom").agg((F.max("end") + 7000 * F.max(F.substring("chrom", 4, 1).cast("long"))).alias("len"))

    def n_intervals(self) -> DataFrame:
        """Short stretches, and long ones in one window of four."""
        start = (F.col("s_suppkey") * 1543) % 60000
        length = 100 + (F.col("s_suppkey") * 37) % 150 + F.when((start % 16384).between(8192, 12287), 2500).otherwise(0)
        return self.read("supplier").select(F.concat(F.lit("chr"), (F.col("s_nationkey") % 7 + 1).cast("string")).alias("chrom"), start.alias("start"), (start + length).alias("end"))

    def blacklist(self) -> DataFrame:
        """All error events, in six stretches of each chromosome, so that windows between these stay."""
        start = F.col("event_id") % 6 * 16384 + (F.col("event_id") * 7919) % 3000
        return self.read("events").filter("event_type = 'error'").select(F.concat(F.lit("chr"), (F.col("user_id") % 7 + 1).cast("string")).alias("chrom"), start.alias("start"), (start + 40).alias("end"))

    def mapped(self) -> DataFrame:
        return self.peaks().join(self.experiments().drop("line_no", "org"), "srx")


#: The same tables as SQL; ``stop`` stands for the end, which is a word of SQL.
SQL = {
    "peaks": """SELECT 'chr' || l_linenumber::VARCHAR AS chrom, (l_partkey * 104729 + l_orderkey * 7919) % 60000 AS s,
        (l_partkey * 104729 + l_orderkey * 7919) % 60000 + 50 + l_quantity::BIGINT * 9 AS e, 'SRX' || lpad(l_partkey::VARCHAR, 7, '0') AS srx,
        (floor(l_extendedprice)::BIGINT % 1990 + 10)::INTEGER AS score FROM lineitem""",
    "experiments": """SELECT 'SRX' || lpad(p_partkey::VARCHAR, 7, '0') AS srx, 'hg38' AS org, p_type AS ag_class, p_brand AS antigen,
        split_part(p_name, ' ', 2) AS ct_class, split_part(p_name, ' ', 1) AS celltype, p_partkey AS line_no FROM part WHERE p_size % 29 <> 0""",
    "sizes": "SELECT chrom, max(e) + 7000 * max(substring(chrom, 4, 1)::BIGINT) AS len FROM peaks GROUP BY chrom",
    "n_intervals": """SELECT 'chr' || (s_nationkey % 7 + 1)::VARCHAR AS chrom, (s_suppkey * 1543) % 60000 AS s,
        (s_suppkey * 1543) % 60000 + 100 + (s_suppkey * 37) % 150 + CASE WHEN (s_suppkey * 1543) % 60000 % 16384 BETWEEN 8192 AND 12287 THEN 2500 ELSE 0 END AS e FROM supplier""",
    "blacklist": "SELECT 'chr' || (user_id % 7 + 1)::VARCHAR AS chrom, event_id % 6 * 16384 + (event_id * 7919) % 3000 AS s, event_id % 6 * 16384 + (event_id * 7919) % 3000 + 40 AS e FROM events WHERE event_type = 'error'",
    "mapped": "SELECT p.*, x.ag_class, x.antigen, x.ct_class, x.celltype FROM peaks p JOIN experiments x USING (srx)",
}


def merged_sql(table: str) -> str:
    """SQL for the union of a table's intervals (chrom, s, e)."""
    return f"""SELECT chrom, min(s) AS s, max(e) AS e FROM (
        SELECT *, sum(new) OVER (PARTITION BY chrom ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM {table})) GROUP BY chrom, run"""


def max_runs_sql(table: str, keys: str, value: str = "score", step: int = 1, tile: int = 1024) -> str:
    """SQL for maximum runs of a table (keys, s, e, value) as (keys, s, e, value)."""
    low, high = ("s", "e") if step == 1 else (f"s // {step}", f"greatest((e + {step} - 1) // {step}, s // {step} + 1)")
    using = ", ".join(f"{k}" for k in keys.split(", "))
    return f"""WITH iv AS (SELECT {keys}, {low} AS s, {high} AS e, {value} AS value FROM {table} WHERE {value} > 0),
        parts AS (SELECT {keys}, t, greatest(s, t * {tile}) AS s, least(e, (t + 1) * {tile}) AS e, value FROM (SELECT *, unnest(range(s // {tile}, (e - 1) // {tile} + 1)) AS t FROM iv WHERE e > s)),
        pts AS (SELECT {keys}, t, s AS p FROM parts UNION SELECT {keys}, t, e FROM parts),
        spans AS (SELECT {keys}, t, p AS a, lead(p) OVER (PARTITION BY {keys}, t ORDER BY p) AS b FROM pts),
        held AS (SELECT {keys}, a, b, max(value) AS value FROM spans JOIN parts USING ({using}, t) WHERE s <= a AND e >= b GROUP BY {keys}, a, b),
        marked AS (SELECT *, CASE WHEN lag(b) OVER w = a AND lag(value) OVER w = value THEN 0 ELSE 1 END AS new FROM held WINDOW w AS (PARTITION BY {keys} ORDER BY a)),
        runs AS (SELECT *, sum(new) OVER (PARTITION BY {keys} ORDER BY a ROWS UNBOUNDED PRECEDING) AS run FROM marked)
        SELECT {keys}, min(a) * {step} AS s, max(b) * {step} AS e, min(value) AS value FROM runs GROUP BY {keys}, run"""


def windows_sql(window: int) -> str:
    return f"SELECT chrom, st AS s, least(st + {window}, len) AS e FROM (SELECT DISTINCT chrom, len, greatest(least(x, len - {window}), 0) AS st FROM (SELECT *, unnest(range(0, len, {window})) AS x FROM sizes))"


def overlap_sql(windows: str, runs: str, out: str) -> str:
    """SQL that adds the covered positions to windows (chrom, s, e, ...)."""
    return f"SELECT w.*, coalesce((SELECT sum(greatest(0, least(w.e, r.e) - greatest(w.s, r.s))) FROM {runs} r WHERE r.chrom = w.chrom AND r.s < w.e AND r.e > w.s), 0)::BIGINT AS {out} FROM {windows} w"


BLOCKS_SQL = f"""SELECT chrom, block, CASE WHEN chrom IN {VAL} THEN 'val' WHEN rank <= round_even(n * 0.1, 0) THEN 'test' ELSE 'train' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY chrom IN {VAL} ORDER BY md5('42:' || chrom || ':' || block::VARCHAR)) AS rank, count(*) OVER (PARTITION BY chrom IN {VAL}) AS n
    FROM (SELECT chrom, unnest(range(0, len // {BLOCK} + 1)) AS block FROM sizes))"""

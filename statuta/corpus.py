"""A corpus of paragraphs derived from order lines, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINES = """
  select cast(l_orderkey as string) as uri,
         cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
              l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as int) as para_no,
         cast(l_partkey as string) as part, cast(l_suppkey % 40 + 1 as string) as sec, cast(l_linenumber as string) as line,
         cast(year(l_shipdate) as string) as act_year, cast(year(o_orderdate) as string) as case_year
  from lineitem join orders on l_orderkey = o_orderkey"""

#: Paragraphs (uri, para_no, markup and what it was made from); four kinds in turn.
PARAGRAPHS = f"""
select uri, para_no, part, sec, line, act_year, case_year, para_no % 4 as kind,
  case para_no % 4
    when 0 then concat('<p>As held in [', case_year, '] UKSC ', part, ', section ', sec, '(', line, ') of the <ref href="http://statutes.example/', act_year, '/1" uk:canonical="', act_year, ' c. 1" uk:type="legislation">Finance Act ', act_year, '</ref> applies.</p>')
    when 1 then concat('<p>Under the Act and section ', sec, ' the claim (', case_year, ') EWHC ', part, ' (Ch) failed; the ', act_year, ' Act is not in point.</p>')
    when 2 then concat('<p>The Customs and Excise Duties ("CED") and Companies Act ', act_year, ' ("CA ', act_year, '") were cited in [', case_year, '] 1 W.L.R. ', part, ' and Case C-', part, '/12.</p>')
    else concat('<p>Then section ', sec, ' of it and the Companies Act ', act_year, '.</p>')
  end as markup
from ({_LINES}) x"""

#: Acts with titles, shared by the lookup queries: those of every year and line, and an order for every part, whose title begins its short title.
ACTS = """
select concat('http://statutes.example/', y, '/', n) as ref, cast(y as bigint) as year, concat(y, ' c. ', n) as citation,
       case when n = '1' then concat('Finance Act ', y) when n = '2' then concat('Companies Act ', y) else concat('Customs Order No. ', n) end as title,
       case when n = '1' then concat('Finance Act ', y, ' (short)') when n = '3' then null else concat('Companies Act ', y) end as shorttitle,
       case when n = '2' then concat('CA ', y) else null end as acronymcitation
from (select distinct cast(year(l_shipdate) as string) as y, cast(l_linenumber as string) as n from lineitem) a
union all select concat('http://statutes.example/parts/', p_partkey), cast(1992 + p_partkey % 7 as bigint), concat('P ', p_partkey),
       concat('The Parts Order No. ', p_partkey), concat('The Parts Order No. ', p_partkey, ' and Schedule'), cast(null as string) from part"""


#: Order lines to a task: with these the tasks grow in number, not in size.
TASK_ROWS = 100_000


def views(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    for t in tables or ("lineitem", "orders", "part"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def paragraphs(spark: SparkSession, sf_dir: str, some: DataFrame | None = None) -> DataFrame:
    """Lines are dealt by order before they are joined and numbered, to as many tasks as their number asks for; of some (uri) documents alone, if given: lines of others are read, and dropped before they are dealt."""
    views(spark, sf_dir)
    lines = spark.table("lineitem")
    tasks = max(-(-lines.count() // TASK_ROWS), spark.sparkContext.defaultParallelism)
    asked = lines if some is None else lines.join(some, F.col("l_orderkey").cast("string") == some["uri"], "left_semi")
    asked.repartition(tasks, "l_orderkey").createOrReplaceTempView("lineitem")
    out = spark.sql(PARAGRAPHS)
    lines.createOrReplaceTempView("lineitem")
    return out


def acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir)
    return spark.sql(ACTS)

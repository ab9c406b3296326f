"""Address-shaped views of the driver tables, in SQL that Spark and DuckDB both read.

The tables hold no addresses, so groups of four are planted from the customers: three spellings of
one address within ten metres, and one in another street of the same name some 70 m away. Further
rows have other numbers, missing cities and equal ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLANTED = """
  select id, v, g,
    40.0 + cast(g % 200 as double) * 0.01 + cast(v as double) * 0.00003 as lat,
    -1.5 + cast((g - g % 200) / 200 as double) * 0.01 + case when v = 3 then 0.0009 else cast(v as double) * 0.00004 end as lon,
    cast(g % 90 + 1 as STR) as number,
    case v when 0 then concat('Avenue de l''Étoile ', cast(g % 25 as STR))
           when 1 then concat('av. etoile ', cast(g % 25 as STR))
           when 2 then concat('AVENUE DE L ETOILE ', cast(g % 25 as STR))
           else concat('Route de l''Étoile ', cast(g % 25 as STR)) end as street,
    cast(null as STR) as unit,
    case when v = 2 then null else concat('CITY_', cast(g % 25 as STR)) end as city,
    cast(null as STR) as district, cast(null as STR) as region,
    case when g % 3 = 0 then cast(75000 + g % 25 as STR) else null end as postcode,
    case v when 0 then 'openaddress' when 1 then 'osm' else 'bano' end as source
  from (select c_custkey as id, cast((c_custkey - c_custkey % 4) / 4 as bigint) as g, c_custkey % 4 as v from customer)
"""
RANKED = f"""
  select *, case source when 'openaddress' then cast(1.0 as double) when 'osm' then cast(2.0 as double) else cast(3.0 as double) end
    + cast(4 + case when city is null then 0 else 1 end + case when postcode is null then 0 else 1 end as double) / cast(10.0 as double) as rank
  from ({PLANTED}) p
"""


def spark_sql(text: str) -> str:
    return text.replace("STR", "string")


def duck_sql(text: str) -> str:
    return text.replace("STR", "varchar")


def customers(spark: SparkSession, sf_dir: str) -> None:
    spark.read.parquet(f"{sf_dir}/customer.parquet").createOrReplaceTempView("customer")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, rank, source and the fields, with v (spelling) and g (group)."""
    customers(spark, sf_dir)
    return spark.sql(spark_sql(RANKED))

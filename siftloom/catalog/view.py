"""The sample catalogue: messy products derived row by row from the ``part`` table.

The same text runs in Spark SQL and in DuckDB, so both sides of a comparison
start from the same rows.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession

_TEMPLATE = Template(r"""
WITH rep AS (
  SELECT p_partkey AS pk, p_name, p_brand, p_type, p_size, p_retailprice, 0 AS scrape FROM $part
  UNION ALL SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 1 FROM $part WHERE p_partkey % 10 = 0
  UNION ALL SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 2 FROM $part WHERE p_partkey % 50 = 0
)
SELECT pk * 3 + scrape + 1 AS row_number,
  CASE WHEN pk % 97 = 0 THEN NULL ELSE 'SKU: ' || CAST(pk AS STRING) END AS sku,
  CASE WHEN pk % 30 = 1 THEN '' WHEN pk % 30 = 2 THEN 'www.example.com/p/' || CAST(pk AS STRING)
       ELSE 'https://shop.example.com/p/' || CAST(pk AS STRING) END AS url,
  CASE pk % 11 WHEN 0 THEN ' ' || p_name WHEN 1 THEN p_name || '  x' WHEN 2 THEN p_name || chr(10) || 'y'
       WHEN 3 THEN repeat(p_name || '.', 40) ELSE p_name END AS name,
  CASE pk % 40 WHEN 0 THEN '' WHEN 1 THEN 'undefined' WHEN 2 THEN '$$-5.00' WHEN 3 THEN '$$0.00'
       WHEN 4 THEN '$$12,500.50' WHEN 5 THEN '$$5.00-$$7.00' WHEN 6 THEN NULL
       WHEN 7 THEN '-$$5.00' WHEN 8 THEN '($$6.50)' ELSE '$$' || CAST(p_retailprice AS STRING) END AS price,
  CASE pk % 20 WHEN 0 THEN '150%' WHEN 1 THEN '-10%' WHEN 2 THEN 'n/a' WHEN 3 THEN 'sale'
       ELSE CAST(pk % 60 AS STRING) || '%' END AS discount,
  CASE pk % 7 WHEN 0 THEN p_brand || '?' || p_type WHEN 1 THEN '' WHEN 2 THEN p_brand || '�' || p_type
       WHEN 3 THEN 'Café ' || p_brand WHEN 4 THEN '?x' ELSE p_brand END AS brand,
  CASE pk % 9 WHEN 0 THEN '' WHEN 1 THEN NULL
       WHEN 2 THEN '[{' || chr(39) || 'Material' || chr(39) || ': ' || chr(39) || p_type || chr(39) || '}]'
       WHEN 3 THEN '[{' || chr(39) || 'Color' || chr(39) || ':' || chr(39) || split_part(p_name, ' ', 1) || chr(39) || '}]'
       WHEN 4 THEN '[{' || chr(39) || 'Color' || chr(39) || ': ' || chr(39) || split_part(p_name, ' ', 1)
       ELSE '[{' || chr(39) || 'Color' || chr(39) || ': ' || chr(39) || split_part(p_name, ' ', 1) || chr(39) || '}, {'
            || chr(39) || 'Material' || chr(39) || ': ' || chr(39) || p_type || chr(39) || '}, {'
            || chr(39) || 'Style' || chr(39) || ' :  ' || chr(39) || ' Casual  fit ' || chr(39) || '}]' END AS description,
  CASE pk % 27 WHEN 0 THEN 'one-size' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '135*200, 160*220'
       WHEN 4 THEN 'CN35(US5.5),CN36(US6)' WHEN 5 THEN 'EUR38(US7),EUR39(US8)' WHEN 6 THEN 'US5,US6.5'
       WHEN 7 THEN '34B(75B),36C(80C)' WHEN 8 THEN '4Y,5Y' WHEN 9 THEN '4Y' WHEN 10 THEN 'W28 L30,W30 L32'
       WHEN 11 THEN '100 ml' WHEN 12 THEN '12 inch' WHEN 13 THEN '12(0XL),14(1XL)' WHEN 14 THEN 'XS (2), S (4),M(6),L(8/10)'
       WHEN 15 THEN '2(XS),4(S)' WHEN 16 THEN 'XS(34),S(36)' WHEN 17 THEN 'XS,S,M,L' WHEN 18 THEN 'S-XL'
       WHEN 19 THEN '4,6,8' WHEN 20 THEN 'Queen' WHEN 21 THEN '0(Petite XXS)-8/10(Petite L),12(0XL)'
       WHEN 22 THEN 'Tall M,Tall L' WHEN 23 THEN '2(xs),4(s)' WHEN 24 THEN '12M,18M' WHEN 25 THEN 'one-size,S'
       ELSE 'EUR38,S,M' END AS size,
  CASE pk % 5 WHEN 0 THEN '[' || chr(39) || 'https://img.example.com/a.jpg' || chr(39) || ', ' || chr(39) || 'https://img.example.com/a.jpg' || chr(39) || ']'
       WHEN 1 THEN '[' || chr(39) || 'https://img.example.com/a.jpg' || chr(39) || ', ' || chr(39) || 'https://img.example.com/2024/0' || CAST(pk % 3 + 1 AS STRING) || '/05/' || CAST(pk AS STRING) || '.jpg' || chr(39) || ']'
       WHEN 2 THEN '' WHEN 3 THEN '[' || chr(39) || 'http://img.example.com/b.jpg' || chr(39) || ']' ELSE NULL END AS images,
  CASE WHEN scrape > 0 THEN '2024-03-01 08:00:00' WHEN pk % 6 = 0 THEN '2024-01-05 10:20:30' WHEN pk % 6 = 1 THEN '2024/01/06 10:20'
       WHEN pk % 6 = 2 THEN '01/25/2024' WHEN pk % 6 = 3 THEN '25-01-2024 09:00:00' WHEN pk % 6 = 4 THEN 'yesterday' ELSE '' END AS scraped_at
FROM rep
""")


def catalog_sql(part: str = "part") -> str:
    return _TEMPLATE.substitute(part=part)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    read_table(spark, folder, "part").createOrReplaceTempView("siftloom_part")
    return spark.sql(catalog_sql("siftloom_part"))

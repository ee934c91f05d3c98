"""Views that give the driver's tables the shape of the engine's inputs. The SQL runs on Spark and, as oracle, on DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "calls": """
SELECT concat('S', lpad(CAST(l_suppkey % 10 AS STRING), 2, '0')) AS sample_id,
       concat('chr', CAST(l_partkey % 22 + 1 AS STRING)) AS chrom,
       l_partkey * 150 AS begin_pos, l_partkey * 150 + 1 AS end_pos,
       round(max(l_discount) * 1000, 3) AS mod_score, 'combined' AS type, CAST(max(l_quantity) AS DOUBLE) AS cov
FROM lineitem GROUP BY l_suppkey % 10, l_partkey""",
    "genes": """
SELECT concat('ENSG', lpad(CAST(p_partkey AS STRING), 8, '0')) AS gene_id, p_name AS gene_name,
       concat('chr', CAST(p_partkey % 22 + 1 AS STRING)) AS chrom,
       greatest(1, p_partkey * 150 - p_size * 20) AS start_pos,
       greatest(1, p_partkey * 150 - p_size * 20) + 500 + p_size * 100 AS end_pos,
       CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM part""",
    "gene_parts": """
SELECT gene_id, gene_name, chrom, start_pos + k * 150 AS start_pos, least(end_pos, start_pos + k * 150 + 90) AS end_pos,
       CASE k WHEN 0 THEN 'five_prime_utr' WHEN 1 THEN 'exon' WHEN 2 THEN 'CDS' WHEN 3 THEN '3UTR' WHEN 4 THEN 'UTR' ELSE 'exon' END AS type
FROM (SELECT concat('ENSG', lpad(CAST(p_partkey AS STRING), 8, '0')) AS gene_id, p_name AS gene_name,
       concat('chr', CAST(p_partkey % 22 + 1 AS STRING)) AS chrom, greatest(1, p_partkey * 150 - p_size * 20) AS start_pos,
       greatest(1, p_partkey * 150 - p_size * 20) + 500 + p_size * 100 AS end_pos, explode(sequence(0, 5)) AS k
FROM part)""",
    "islands": """
SELECT concat('chr', CAST(p_partkey % 22 + 1 AS STRING)) AS chrom,
       p_partkey * 150 + (p_size - 1) * 900 - 100 + 1 AS start_pos,
       p_partkey * 150 + (p_size - 1) * 900 + p_size * 10 AS end_pos,
       concat('CpG_', CAST(p_partkey AS STRING)) AS name
FROM part WHERE p_size <= 5 AND p_partkey > 0""",
    "ccres": """
SELECT concat('chr', CAST(p_partkey % 22 + 1 AS STRING)) AS chrom,
       p_partkey * 150 - 400 + 1 AS start_pos, p_partkey * 150 + 4000 AS end_pos,
       concat('E4_', CAST(p_partkey AS STRING)) AS ccre_v4_id, concat('E5_', CAST(p_partkey AS STRING)) AS ccre_v5_id,
       CASE p_size % 4 WHEN 0 THEN 'dELS' WHEN 1 THEN 'pELS' WHEN 2 THEN 'CTCF-only' ELSE 'dELS,CTCF-bound' END AS ccre_type
FROM part WHERE p_size >= 40 AND p_partkey * 150 >= 400""",
    "counts": """
SELECT concat('ENSG', lpad(CAST(l_partkey AS STRING), 8, '0')) AS gene_id,
       concat('S', lpad(CAST(l_suppkey % 10 AS STRING), 2, '0')) AS sample_id,
       CAST(sum(l_quantity) AS BIGINT) % (1 + l_partkey % 20) AS cnt
FROM lineitem GROUP BY l_partkey, l_suppkey % 10""",
    "npx": """
SELECT concat(CASE WHEN l_orderkey % 40 = 39 THEN 'CONTROL_SAMPLE' ELSE 'N' END, CAST(l_orderkey % 40 AS STRING), '_A') AS SampleID,
       concat('PLATE', CAST(CASE WHEN l_orderkey % 40 < 5 THEN l_linenumber % 2 ELSE l_orderkey % 4 END AS STRING)) AS PlateID,
       'assay' AS AssayType, concat('OID', CAST(l_partkey % 30 AS STRING)) AS OlinkID,
       concat('UP', CAST(l_partkey % 30 AS STRING)) AS UniProt, concat('ASSAY', CAST(l_partkey % 30 AS STRING)) AS Assay,
       CASE WHEN l_orderkey % 40 = 7 THEN 'WARN' ELSE 'PASS' END AS SampleQC,
       CASE WHEN l_partkey % 30 = 3 THEN 'WARN' ELSE 'PASS' END AS AssayQC,
       CASE WHEN l_orderkey % 40 = 11 AND l_partkey % 30 = 5 THEN NULL ELSE round(avg(l_extendedprice) / 10000, 6) END AS NPX
FROM lineitem
GROUP BY l_orderkey % 40, CASE WHEN l_orderkey % 40 < 5 THEN l_linenumber % 2 ELSE l_orderkey % 4 END, l_partkey % 30""",
    "covariates": """
SELECT concat('S', lpad(CAST(c_custkey % 10 AS STRING), 2, '0')) AS sample_id,
       round(avg(c_acctbal), 4) AS gpc1, round(max(c_acctbal), 4) AS gpc2
FROM customer GROUP BY c_custkey % 10""",
    "genotypes": """
SELECT concat('chr', CAST(o_custkey % 24 + 1 AS STRING)) AS chrom, o_custkey * 10 AS pos, 'A' AS ref, 'G' AS alt,
       concat('S', lpad(CAST(o_orderkey % 20 AS STRING), 2, '0')) AS sample_id,
       CASE CAST(max(o_orderkey) % 7 AS INT) WHEN 0 THEN '1/1' WHEN 1 THEN '0/1' WHEN 2 THEN '1|0' WHEN 3 THEN './.' ELSE '0/0' END AS gt
FROM orders GROUP BY o_custkey, o_orderkey % 20""",
}
#: The only view that the two engines unnest differently: features by samples, complete.
MATRIX_SPARK = """
SELECT concat('chr', CAST(label % 22 + 1 AS STRING)) AS chrom, vec_id * 100 AS start_pos, vec_id AS feature_id, i + 1 AS sample_idx, CAST(v AS DOUBLE) AS value
FROM {embeddings} LATERAL VIEW posexplode(embedding) e AS i, v"""
MATRIX_SQL = """
SELECT concat('chr', CAST(label % 22 + 1 AS VARCHAR)) AS chrom, vec_id * 100 AS start_pos, vec_id AS feature_id,
       generate_subscripts(embedding, 1) AS sample_idx, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings"""


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = MATRIX_SPARK if name == "matrix" else re.sub(r"FROM (\w+)", r"FROM {\1}", VIEWS[name])
    source = re.search(r"FROM \{(\w+)\}", sql)[1]
    return spark.sql(sql, **{source: spark.read.parquet(f"{sf_dir}/{source}.parquet")})


def view_sql(name: str) -> str:
    return MATRIX_SQL if name == "matrix" else VIEWS[name].replace("explode(sequence(0, 5))", "unnest(range(0, 6))")

"""Splice-junction ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ensembl_id(phenotype_id: Column) -> Column:
    """The first ENSG id in a junction's name, or null."""
    return F.nullif(F.regexp_extract(phenotype_id, "ENSG[0-9]+", 0), F.lit(""))

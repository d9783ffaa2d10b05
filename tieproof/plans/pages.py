"""Organisation fields out of the JSON-LD blocks of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieproof.functions.pages import ORGANIZATION_TYPES, jsonld_nodes


def organisations(pages: DataFrame) -> DataFrame:
    """One row per page with organisation nodes; the first name and url, the last of all other fields."""
    def get(path: str, kind: str = "string"):
        return F.try_variant_get("node", path, kind)

    nodes = pages.select("page_id", F.posexplode(jsonld_nodes(F.col("html"))).alias("pos", "node")).where(
        get("$['@type']").isin(*ORGANIZATION_TYPES)
    )
    first = {"name": "$.name", "url": "$.url"}
    last = {
        "founding_date": ("$.foundingDate", "string"),
        "description": ("$.description", "string"),
        "employees_min": ("$.numberOfEmployees.minValue", "long"),
        "employees_max": ("$.numberOfEmployees.maxValue", "long"),
        "hq_locality": ("$.address.addressLocality", "string"),
        "hq_region": ("$.address.addressRegion", "string"),
        "hq_country": ("$.address.addressCountry", "string"),
    }
    rows = nodes.select(
        "page_id", "pos", *[get(p).alias(n) for n, p in first.items()], *[get(p, k).alias(n) for n, (p, k) in last.items()]
    )
    return rows.groupBy("page_id").agg(
        *[F.min_by(n, F.when(F.col(n).isNotNull(), F.col("pos"))).alias(n) for n in first],
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col("pos"))).alias(n) for n in last],
    )

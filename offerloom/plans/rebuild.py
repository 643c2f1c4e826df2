"""The batch rebuild: raw docs to SKUs and products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.constants import Config
from offerloom.operators import edges, graph, prep, products, reduce
from offerloom.session import cut


def last_rows(raw: DataFrame) -> DataFrame:
    """The last row of each doc by ``ord``."""
    rest = [c for c in raw.columns if c not in ("doc_id", "ord")]
    return raw.where("doc_id is not null").groupBy("doc_id").agg(F.max_by(F.struct(*rest), "ord").alias("r"), F.max("ord").alias("ord")).select("doc_id", "ord", *[F.col(f"r.{c}").alias(c) for c in rest])


def prepared(raw: DataFrame, cfg: Config) -> DataFrame:
    """Keyed, cloned docs with clean names, without product pages."""
    docs = prep.clean_docs(last_rows(raw))
    docs = prep.without_product_links(docs, prep.product_links(docs, cfg.product_market, cfg.variant_marker))
    return cut(prep.with_clean_names(docs))


def grouped(docs: DataFrame, cfg: Config) -> DataFrame:
    """Docs with their component; docs that no stage links are their own."""
    e = cut(edges.staged_edges(docs, cfg.link_key))
    g = graph.components(e, docs.select(F.col("doc_id").alias("node")))
    return cut(docs.join(g.withColumnRenamed("node", "doc_id"), "doc_id"))


def skus(raw: DataFrame, cfg: Config) -> DataFrame:
    """SKU rows of the whole table."""
    return cut(reduce.reduce_docs(grouped(prepared(raw, cfg), cfg), cfg))


def with_products(sku_rows: DataFrame, raw: DataFrame, cfg: Config) -> DataFrame:
    """SKU rows with ``product_id``, null for those in no product."""
    docs = prep.keyed_docs(raw)
    ids = products.group_skus(sku_rows, docs.where(F.size("variants") > 0).select("ord", "variants"), prep.product_links(docs, cfg.product_market, cfg.variant_marker), cfg.variant_marker)
    return sku_rows.join(ids, "sku_id", "left")

"""Crawled result pages -> listing records (BR1-BR5, BR8).

Cards are found by a small HTML reader inside ``mapInPandas`` (Spark has no
HTML expression); everything after that is column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from plazalake.config import SearchSpec
from plazalake.functions import parsing as P
from plazalake.functions import text as T
from plazalake.functions.html_cards import read_cards
from plazalake.schemas import CARD_SCHEMA

def extract_cards(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """BR5: one row per card with the page's other columns, ``_position`` and ``_raw``."""
    kept = [f for f in pages.schema.fields if f.name != html]
    fields = CARD_SCHEMA.fieldNames()
    schema = StructType(
        [*kept, StructField("_position", IntegerType()), StructField("_raw", CARD_SCHEMA)]
    )

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            source, position, cards = [], [], []
            for i, (markup, address) in enumerate(zip(batch[html], batch[url])):
                for n, card in enumerate(read_cards(markup, address or "")):
                    source.append(i)
                    position.append(n)
                    cards.append({f: card[f] for f in fields})
            out = batch.iloc[source].drop(columns=[html]).reset_index(drop=True)
            out["_position"] = pd.array(position, dtype="int32")
            out["_raw"] = pd.Series(cards, dtype="object")
            yield out

    # Pages without a mark have no card; they never leave the JVM.
    marked = pages.where(F.col(html).rlike("(?i)data-qa"))
    return marked.mapInPandas(per_batch, schema)


def card_listings(cards: DataFrame, base_url: str) -> DataFrame:
    """BR1-BR4: raw cards -> listing columns; ``_raw`` and page columns are kept."""
    district, city = T.location_parts(F.col("_raw.location"))
    text = F.col("_raw.features_text")
    renamed = {
        "listing_id": "id",
        "listing_type": "posting_type",
        "price_raw": "price",
        "maintenance_raw": "maintenance",
        "address_raw": "location",
        "street": "street",
        "description": "description",
        "image_url": "image",
        "publisher": "publisher",
    }
    return cards.withColumns(
        {
            **{name: F.col(f"_raw.{field}") for name, field in renamed.items()},
            **{field: P.feature_part(text, field) for field in P.FEATURE_UNITS},
            "url": T.absolute_url(F.col("_raw.url"), base_url),
            "district": district,
            "city": city,
            "features": F.coalesce("_raw.amenities", F.array().cast("array<string>")),
            "_extraction_method": F.lit("dom"),
        }
    )


def stamp_search(
    df: DataFrame, spec: SearchSpec, base_url: str, run_id: Column, page: Column, fetched_at: Column
) -> DataFrame:
    """BR8: page and search metadata of a crawl."""
    return df.withColumns(
        {
            "_ingested_at": fetched_at,
            "_source_url": spec.page_url(base_url, page),
            "_page_num": page.cast("int"),
            "_run_id": run_id,
            "_search_params": F.struct(
                F.lit(spec.operation).alias("operation"),
                F.lit(spec.property_type).alias("property_type"),
                F.lit(spec.location).alias("location"),
                F.lit(spec.bedrooms).alias("bedrooms"),
            ),
        }
    )

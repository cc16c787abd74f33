"""Raw ads to a clean table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.functions import text as tx
from lotline.functions.columns import fill_from
from lotline.operators.impute import FillModel, TrimModel, fit_median, fit_mode, fit_sd_trim
from lotline.operators.rows import first_per_key, latest_per_key
from lotline.staging import stage


def mine_text(ads: DataFrame) -> DataFrame:
    """Surface, type of housing, bathrooms and amenity flags out of title and description.

    Sizes with a unit are read from the text as written, the other patterns from normalised text.
    """
    lacks = F.col("surface_total").isNull()
    ads = ads.withColumns({
        "description_adj": tx.normalize_text("description"),
        "_title": F.lower("title"),
        "_text": F.lower("description"),
        "_context": F.when(lacks, tx.context_window("description")),
    })
    # each candidate is a column of its own: the cascade names it more than once
    ads = ads.withColumns({
        "_label": F.when(lacks, tx.labelled_quantity("description_adj")),
        "_mined": tx.veto(tx.number_with_unit("_context"), "_context"),
        "_area": F.when(lacks, tx.dimension_product("description_adj")),
    })
    surface = fill_from("surface_total", [
        ("_label", None), ("_mined", fv.MIN_MINED_SURFACE), ("_area", fv.MIN_MINED_SURFACE),
    ])
    return ads.withColumns({
        "surface_total": surface,
        "type_housing": tx.classify_by_keywords(["_title", "_text"], fallback="property_type", lowered=True),
        "bathrooms": fill_from("bathrooms", [(tx.digit_or_word_count("description_adj"), None)]),
        **{name: tx.fuzzy_contains("description_adj", words) for name, words in fv.AMENITY_WORDS.items()},
    }).drop("_context", "_title", "_text", "_label", "_mined", "_area")


@dataclass(frozen=True)
class CleaningModel:
    """Constants learned on the training ads."""

    surface: FillModel
    bathrooms: FillModel
    trim: TrimModel | None = None

    def transform(self, ads: DataFrame) -> DataFrame:
        """Clean new ads: no rows are dropped."""
        filled = self.bathrooms.transform(self.surface.transform(mine_text(ads)))
        return filled.select(*[c for c in fv.CLEAN_COLUMNS if c in filled.columns])


FIXED_CONSTANTS = CleaningModel(
    FillModel({"surface_total": fv.IMPUTED_SURFACE}), FillModel({"bathrooms": fv.IMPUTED_BATHROOMS})
)


def drop_exact_copies(ads: DataFrame, key: str = "property_id") -> DataFrame:
    """Of ads that agree in place, size, price and month, the one with the lowest key; nulls count as equal."""
    return first_per_key(ads, fv.EXACT_COPY_KEYS, [key])


def price_per_metre(df: DataFrame) -> DataFrame:
    """Price per square metre, rounded half to even; null for a surface of zero, whose ad the trim then leaves out."""
    return df.withColumn("price_per_m2", F.bround(F.try_divide("price", "surface_total"), 0))


def clean_training_ads(ads: DataFrame, key: str = "property_id") -> tuple[DataFrame, CleaningModel]:
    """Latest ad per home, text mined, nulls filled, price per square metre trimmed at two sd.

    The mined table is staged, so the text is read once although three statistics are fitted on it.
    """
    latest = latest_per_key(ads, fv.REPUBLISHED_KEYS, tie_break=[key])
    mined = stage(mine_text(latest), "mined")
    surface, bathrooms = fit_median(mined, ["surface_total"]), fit_mode(mined, ["bathrooms"])
    filled = price_per_metre(bathrooms.transform(surface.transform(mined)))
    trim = fit_sd_trim(filled, "price_per_m2", fv.TRIM_SDS)
    clean = trim.transform(filled).select(*[c for c in fv.CLEAN_COLUMNS if c in filled.columns])
    return clean, CleaningModel(surface, bathrooms, trim)

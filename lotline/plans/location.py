"""Clean ads to location features."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from lotline import fixed_values as fv
from lotline.functions.columns import drop_null_rows, not_in, within_box
from lotline.functions.geo import MAGNA_BOGOTA
from lotline.operators import spatial as sp
from lotline.staging import stage


@dataclass
class Layers:
    """Layers in the metric plane: points as (x, y), polygons as (edges, attributes)."""

    nearest: Mapping[str, DataFrame] = field(default_factory=dict)
    within: Mapping[str, tuple[DataFrame, float]] = field(default_factory=dict)
    appraisal: tuple[DataFrame, DataFrame, str] | None = None
    stratum: tuple[DataFrame, DataFrame, str] | None = None


def keep_city(
    ads: DataFrame, box: tuple[float, float, float, float], excluded_edges: DataFrame | None = None,
    key: str = "poly_id",
) -> DataFrame:
    """Ads with coordinates inside the box of the city and outside the excluded district."""
    inside = drop_null_rows(ads, ["lat", "lon"]).where(within_box("lon", "lat", box))
    return inside if excluded_edges is None else sp.outside_polygons(inside, excluded_edges, key, "lon", "lat")


def park_centroids(edges: DataFrame, attributes: DataFrame, key: str = "poly_id") -> DataFrame:
    """Centroids of the parks that count, by their type."""
    usable = attributes.where(not_in("TIPOPARQUE", fv.EXCLUDED_PARK_TYPES)).select(key)
    return sp.centroids(edges.join(usable, key, "left_semi"), key)


def location_features(ads: DataFrame, layers: Layers, key: str = "property_id", poly: str = "poly_id") -> DataFrame:
    """Key and one column per feature.

    Point layers are answered together; the table is staged between steps that read it repeatedly.
    """
    x, y = MAGNA_BOGOTA.forward("lon", "lat")
    base = stage(ads.select(key, x.alias("x"), y.alias("y")), "projected")
    out = base
    if layers.nearest or layers.within:
        out = stage(sp.with_point_layers(base, layers.nearest, layers.within), "features")
    if layers.appraisal:
        edges, attributes, column = layers.appraisal
        joined = sp.point_in_polygon_join(out, edges, attributes.select(poly, column), poly).drop(poly)
        out = stage(sp.fill_from_nearest_known(stage(joined, "appraisal"), column, key), "appraisal")
    if layers.stratum:
        edges, attributes, column = layers.stratum
        joined = sp.point_in_polygon_join(out, edges, attributes.select(poly, column), poly).drop(poly)
        out = sp.fill_from_nearest_polygon(
            stage(joined, "stratum"), edges, attributes, column, fv.RADIUS_STRATUM, key=poly
        )
    return out.drop("x", "y")

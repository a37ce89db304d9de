"""Countries: silver cleaning and the enriched gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.clean import main_currency, processing_time, safe_ratio, to_number
from rivulet.operators.dedup import dedup_any, dedup_first
from rivulet.operators.joins import latest_per_key, left_enrich, rate_lookup

# --- fixed values: columns of the enriched gold table, in order, and the input column each one shows.
# Those without one are computed or joined; they are null of the type given where their source is missing.
GOLD_COLUMNS = (("pays", "name"), ("nom_officiel", "official_name"), ("iso2", "iso2"), ("iso3", "iso3"), ("region", "region"),
                ("sous_region", "subregion"), ("capitale", "capital"), ("superficie_km2", "area"), ("population_api_countries", "population"),
                ("population_banque_mondiale", None), ("annee_population", None), ("densite_population", None), ("langues", "languages"),
                ("devises", "currencies"), ("codes_devises", "currency_codes"), ("devise_principale", None), ("taux_change_vs_gbp", None),
                ("processed_at", None))
MISSING = {"population_banque_mondiale": "double", "annee_population": "int", "devise_principale": "string", "taux_change_vs_gbp": "double"}
# ---------------------------------------------------------------------------


def countries_silver(raw: DataFrame, as_of=None, order_by: list[Column | str] | None = None) -> DataFrame:
    """One row per iso3 (null iso3 dropped), numeric population/area, density.

    ``order_by`` makes the kept duplicate deterministic (first in that order).
    """
    df = raw.filter(F.col("iso3").isNotNull())
    df = dedup_first(df, ["iso3"], order_by) if order_by else dedup_any(df, ["iso3"])
    return df.withColumns({
        "population": to_number("population", "long"),
        "area": to_number("area", "double"),
    }).withColumns({
        "population_density": safe_ratio("population", "area"),
        "processed_at": processing_time(as_of),
    })


def latest_population(population: DataFrame, key: str = "country_iso2", year: str = "year",
                      value: str = "population") -> DataFrame:
    """Latest year's value per country; ties (two rows of that year) are all kept."""
    return (latest_per_key(population, key, year)
            .select(F.col(key), F.col(value).alias("population_banque_mondiale"),
                    F.col(year).alias("annee_population")))


def gold_countries_enriched(countries: DataFrame, population: DataFrame | None = None,
                            rates: DataFrame | None = None, as_of=None,
                            population_key: str = "country_iso2") -> DataFrame:
    """Countries + latest population (left join on iso2) + main-currency rate.

    Missing sources give typed null columns.  Density = population / area
    rounded to 2 (null for a zero or null area).
    """
    given = {**{out: F.lit(None).cast(kind) for out, kind in MISSING.items()}, **{c: F.col(c) for c in countries.columns}}
    df = countries
    if population is not None:
        df = left_enrich(df, latest_population(population, population_key), "iso2", population_key)
        given |= {c: F.col(c) for c in ("population_banque_mondiale", "annee_population")}
    if rates is not None and "currency_codes" in countries.columns:
        df = rate_lookup(df.withColumn("devise_principale", main_currency("currency_codes")), "devise_principale", rates, "taux_change_vs_gbp")
        given |= {c: F.col(c) for c in ("devise_principale", "taux_change_vs_gbp")}
    shown = {out: given[source if source in given else out] for out, source in GOLD_COLUMNS if source in given or out in given}
    if {"population_api_countries", "superficie_km2"} <= shown.keys():
        shown["densite_population"] = safe_ratio(shown["population_api_countries"], shown["superficie_km2"], 2)
    shown["processed_at"] = processing_time(as_of)
    return df.select(*[shown[out].alias(out) for out, _ in GOLD_COLUMNS if out in shown])

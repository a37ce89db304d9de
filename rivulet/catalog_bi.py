"""Registered queries of the BI pack: thirteen charts and seven SQL-lab forms."""

from __future__ import annotations

from rivulet.catalog import ORACLE, _rnd, enriched_left_join, gold_category_analytics, gold_details_converted, register
from rivulet.plans import bi as BI

_GOLD = {BI.DETAILS: (gold_details_converted, "gold_details_converted"),
         BI.ANALYTICS: (gold_category_analytics, "gold_category_analytics"),
         BI.ENRICHED: (enriched_left_join, "enriched_left_join")}

# What each chart shows, as SQL over the gold table g.
_CHART_SQL = {
    "books_by_category": "SELECT category, COUNT(*) AS nb FROM g GROUP BY category",
    "top_price_per_title": "SELECT titre, MAX(price_gbp) AS price_gbp FROM g GROUP BY titre ORDER BY price_gbp DESC NULLS FIRST, titre LIMIT 10",
    "revenue_by_category": f"SELECT category, {_rnd('SUM(price_gbp)')} AS revenue FROM g GROUP BY category",
    "stock_total": "SELECT CAST(SUM(stock) AS BIGINT) AS stock_total FROM g",
    "books_total": "SELECT COUNT(*) AS books FROM g",
    "mean_prices_by_category": "SELECT categorie, prix_moyen_gbp, prix_moyen_eur, prix_moyen_usd FROM g",
    "stock_by_category": "SELECT categorie, stock_total FROM g",
    "countries_by_region": "SELECT region, COUNT(*) AS nb_pays FROM g GROUP BY region",
    "top_population_per_country": "SELECT pays, MAX(population_banque_mondiale) AS population FROM g GROUP BY pays "
                                  "ORDER BY population DESC NULLS FIRST, pays LIMIT 20",
    "population_and_area": "SELECT region, superficie_km2, population_api_countries FROM g",
    "rate_by_currency": f"SELECT devise_principale, {_rnd('AVG(taux_change_vs_gbp)', 6)} AS taux FROM g "
                        "WHERE taux_change_vs_gbp IS NOT NULL GROUP BY devise_principale",
    "countries_total": "SELECT COUNT(*) AS nb_pays FROM g",
    "country_table": "SELECT pays, region, capitale, population_banque_mondiale, devise_principale, taux_change_vs_gbp FROM g",
}
_FORM_SQL = {
    "books_by_category": _CHART_SQL["books_by_category"],
    "top_priced_books": "SELECT titre, price_gbp FROM g ORDER BY price_gbp DESC NULLS FIRST, titre LIMIT 10",
    "stock_total": _CHART_SQL["stock_total"],
    "top_populated": "SELECT pays, population_banque_mondiale, region FROM g WHERE population_banque_mondiale IS NOT NULL "
                     "ORDER BY population_banque_mondiale DESC, pays, region LIMIT 20",
    "rate_by_currency": _CHART_SQL["rate_by_currency"],
    "countries_by_region": _CHART_SQL["countries_by_region"],
}


def _register_chart(name: str, chart: BI.Chart) -> None:
    make, gold = _GOLD[chart.table]
    register(f"bi_chart_{name}", f"WITH g AS ({ORACLE[gold]}) {_CHART_SQL[name]}")(lambda spark, sf: chart.frame(make(spark, sf)))


def _register_form(name: str) -> None:
    table = BI.SQL[name].table
    make, gold = _GOLD[table]
    register(f"bi_sql_{name}", f"WITH g AS ({ORACLE[gold]}) {_FORM_SQL[name]}")(
        lambda spark, sf: BI.run_sql(spark, name, {table: make(spark, sf)}))


for _name, _chart in BI.CHARTS.items():
    _register_chart(_name, _chart)
for _name in _FORM_SQL:  # bi_sql_avg_price_by_category stands in catalog.py
    _register_form(_name)

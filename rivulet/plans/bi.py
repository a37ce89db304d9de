"""BI charts of the gold tables: one definition, a DataFrame form and a SQL form.

A chart names its table, its group columns, its measures, a filter, its order
and a row limit.  :meth:`Chart.frame` builds it with the DataFrame API,
:meth:`Chart.sql` as the text for a SQL lab; both give the same rows.  Descending
orders put nulls first, as the database the charts ran on does, and end in the
group columns, so a cut is the same every time.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.clean import round_half_even
from rivulet.operators.aggregates import share_of_total


@dataclass(frozen=True)
class Chart:
    """``measures``: output name -> (function, column); no function: the plain column.  ``digits`` rounds that many places."""
    table: str
    group: tuple[str, ...] = ()
    measures: dict[str, tuple[str, str]] = field(default_factory=dict)
    where: str = ""           # a column that must not be null
    order: str = ""           # the measure or column to sort by, descending
    limit: int = 0
    digits: dict[str, int] = field(default_factory=dict)

    @property
    def aggregates(self) -> bool:
        return any(fn for fn, _ in self.measures.values())

    def frame(self, df: DataFrame) -> DataFrame:
        src = df.filter(F.col(self.where).isNotNull()) if self.where else df
        if self.aggregates:
            made = [(F.count(F.lit(1)) if c == "*" else getattr(F, fn)(c)).alias(out) for out, (fn, c) in self.measures.items()]
            src = src.groupBy(*self.group).agg(*made) if self.group else src.agg(*made)
        else:
            src = src.select(*self.group, *[F.col(c).alias(out) for out, (_, c) in self.measures.items()])
        src = src.withColumns({c: round_half_even(c, n) for c, n in self.digits.items()})
        if self.order:
            src = src.orderBy(F.col(self.order).desc_nulls_first(), *[c for c in self.group if c != self.order])
        return src.limit(self.limit) if self.limit else src

    def sql(self) -> str:
        scale = {c: 10 ** n for c, n in self.digits.items()}

        def shown(out: str, fn: str, c: str) -> str:
            e = f"{fn}({c})" if fn else c
            return f"rint(({e}) * {scale[out]}) / {scale[out]} AS {out}" if out in scale else f"{e} AS {out}"
        text = ["SELECT " + ", ".join([*self.group, *[shown(o, *m) for o, m in self.measures.items()]]), f"FROM {self.table}"]
        if self.where:
            text.append(f"WHERE {self.where} IS NOT NULL")
        if self.aggregates and self.group:
            text.append("GROUP BY " + ", ".join(self.group))
        if self.order:
            text.append("ORDER BY " + ", ".join([f"{self.order} DESC NULLS FIRST", *[c for c in self.group if c != self.order]]))
        if self.limit:
            text.append(f"LIMIT {self.limit}")
        return " ".join(text)


# --- fixed values: table and column names of the gold tables ---------------
DETAILS, ANALYTICS, ENRICHED = "gold_books_details", "gold_books_analytics", "gold_countries_enriched"
_MEAN_PRICES = {c: ("", c) for c in ("prix_moyen_gbp", "prix_moyen_eur", "prix_moyen_usd")}

#: The thirteen charts, in the dashboard's order.
CHARTS = {
    "books_by_category": Chart(DETAILS, ("category",), {"nb": ("count", "*")}, order="nb"),
    "top_price_per_title": Chart(DETAILS, ("titre",), {"price_gbp": ("max", "price_gbp")}, order="price_gbp", limit=10),
    "revenue_by_category": Chart(DETAILS, ("category",), {"revenue": ("sum", "price_gbp")}, order="revenue", digits={"revenue": 2}),
    "stock_total": Chart(DETAILS, (), {"stock_total": ("sum", "stock")}),
    "books_total": Chart(DETAILS, (), {"books": ("count", "*")}),
    "mean_prices_by_category": Chart(ANALYTICS, ("categorie",), _MEAN_PRICES, order="prix_moyen_gbp"),
    "stock_by_category": Chart(ANALYTICS, ("categorie",), {"stock_total": ("", "stock_total")}, order="stock_total"),
    "countries_by_region": Chart(ENRICHED, ("region",), {"nb_pays": ("count", "*")}, order="nb_pays"),
    "top_population_per_country": Chart(ENRICHED, ("pays",), {"population": ("max", "population_banque_mondiale")}, order="population", limit=20),
    "population_and_area": Chart(ENRICHED, ("region", "superficie_km2", "population_api_countries")),
    "rate_by_currency": Chart(ENRICHED, ("devise_principale",), {"taux": ("avg", "taux_change_vs_gbp")}, "taux_change_vs_gbp", "taux",
                              digits={"taux": 6}),
    "countries_total": Chart(ENRICHED, (), {"nb_pays": ("count", "*")}),
    "country_table": Chart(ENRICHED, ("pays", "region", "capitale", "population_banque_mondiale", "devise_principale", "taux_change_vs_gbp")),
}

#: The seven SQL-lab forms; two are row lists, the others charts of above.
SQL = {
    "books_by_category": CHARTS["books_by_category"],
    "top_priced_books": Chart(DETAILS, ("titre", "price_gbp"), order="price_gbp", limit=10),
    "stock_total": CHARTS["stock_total"],
    "avg_price_by_category": CHARTS["mean_prices_by_category"],
    "top_populated": Chart(ENRICHED, ("pays", "population_banque_mondiale", "region"), where="population_banque_mondiale",
                           order="population_banque_mondiale", limit=20),
    "rate_by_currency": CHARTS["rate_by_currency"],
    "countries_by_region": CHARTS["countries_by_region"],
}


def books_by_category(details: DataFrame) -> DataFrame:
    return CHARTS["books_by_category"].frame(details)


def top_priced_books(details: DataFrame, k: int = 10) -> DataFrame:
    return replace(SQL["top_priced_books"], limit=k).frame(details)


def revenue_share(details: DataFrame) -> DataFrame:
    """Chart 3 with each category's share of the whole."""
    return share_of_total(details, "category", "price_gbp", "revenue", "share")


def stock_total(details: DataFrame) -> DataFrame:
    """Charts 4 and 5 in one pass."""
    return details.agg(F.sum("stock").alias("stock_total"), F.count(F.lit(1)).alias("books"))


def top_populated(enriched: DataFrame, k: int = 20) -> DataFrame:
    return replace(SQL["top_populated"], limit=k).frame(enriched)


def rate_by_currency(enriched: DataFrame) -> DataFrame:
    return CHARTS["rate_by_currency"].frame(enriched)


def countries_by_region(enriched: DataFrame) -> DataFrame:
    return CHARTS["countries_by_region"].frame(enriched)


def run_sql(spark: SparkSession, name: str, views: dict[str, DataFrame]) -> DataFrame:
    """A SQL-lab form over temp views of the gold tables."""
    for v, df in views.items():
        df.createOrReplaceTempView(v)
    return spark.sql(SQL[name].sql())

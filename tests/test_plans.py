import datetime as dt

from rivulet.plans.bi import SQL, books_by_category, rate_by_currency, revenue_share, run_sql, top_populated
from rivulet.plans.books import books_quality, books_silver, gold_books_analytics, gold_books_details
from rivulet.plans.countries import countries_silver, gold_countries_enriched
from rivulet.plans.silver import population_silver, rates_silver, wine_silver

AS_OF = dt.datetime(2024, 1, 31, 12, 0, 0)
RAW = "url string, titre string, categorie string, description string, upc string, type_produit string, " \
      "prix_hors_taxe string, prix_ttc string, disponibilite string, nombre_davis string, image_url string"


def books_raw(spark):
    return spark.createDataFrame([
        ("u1", "T1", "Poetry", None, "a", "Books", "£10.00", "£10.00", "In stock (22 available)", "5", None),
        ("u2", "T2", "Poetry", None, "b", "Books", "£20.00", "Â£20.00", "In stock (0 available)", None, None),
        ("u3", None, "Travel", None, "c", "Books", "invalid", "invalid", "Empty", "3", None),
        ("u4", "T4", None, None, "d", "Books", "£5.00", "£5.00", None, "1", None),
    ], RAW)


def rates(spark):
    return spark.createDataFrame([(1.2, 1.3, "GBP", "2024-01-31")], "EUR double, USD double, base string, date string")


def test_books_silver_gold(spark):
    silver = books_silver(books_raw(spark), rates(spark))
    assert {"price_gbp", "stock", "reviews", "category", "price_eur", "price_usd"} <= set(silver.columns)
    r = {x.url: x for x in silver.collect()}
    assert (r["u1"].price_gbp, r["u1"].stock, r["u1"].reviews, r["u1"].price_eur) == (10.0, 22, 5, 12.0)
    assert (r["u2"].price_gbp, r["u2"].reviews, r["u2"].price_usd) == (20.0, 0, 26.0)
    assert (r["u3"].price_gbp, r["u3"].stock) == (None, 0)
    q = books_quality(silver).first()
    assert (q.rows, q.null_titles) == (4, 1)
    details = gold_books_details(silver, rates(spark), AS_OF)
    assert details.filter("url = 'u1'").first().processed_at == AS_OF
    a = {x.categorie: x for x in gold_books_analytics(silver, rates(spark), AS_OF).collect()}
    assert set(a) == {"Poetry", "Travel"}                      # null category dropped
    p = a["Poetry"]
    assert (p.nombre_livres, p.prix_moyen_gbp, p.prix_min_gbp, p.prix_max_gbp, p.stock_total, p.avis_moyen,
            p.prix_moyen_eur, p.prix_moyen_usd) == (2, 15.0, 10.0, 20.0, 22, 2.5, 18.0, 19.5)
    t = a["Travel"]
    assert (t.nombre_livres, t.prix_moyen_gbp, t.stock_total) == (1, None, 0)
    assert gold_books_analytics(silver, None, AS_OF).columns[-1] == "processed_at"


def test_countries_silver_and_gold(spark):
    raw = spark.createDataFrame([
        ("France", "French Republic", "Europe", "Western", 67000000, 550000.0, "Paris", "French", "Euro", "EUR", "FR", "FRA"),
        ("France2", None, "Europe", None, 1, 1.0, None, None, None, "EUR", "FR", "FRA"),
        ("Zero", None, "Nowhere", None, 5, 0.0, None, None, None, None, "ZZ", "ZZZ"),
        ("Kenya", None, "Africa", None, 50, 10.0, None, None, "Kenyan shilling, US dollar", "KES, USD", "KE", "KEN"),
        ("NoIso", None, "Africa", None, 5, 1.0, None, None, None, "", "NI", None),
    ], "name string, official_name string, region string, subregion string, population long, area double, "
       "capital string, languages string, currencies string, currency_codes string, iso2 string, iso3 string")
    silver = countries_silver(raw, AS_OF, order_by=["name"])
    rows = {r.iso3: r for r in silver.collect()}
    assert set(rows) == {"FRA", "ZZZ", "KEN"} and rows["FRA"].name == "France"
    assert rows["FRA"].population_density == 67000000 / 550000 and rows["ZZZ"].population_density is None
    pop = spark.createDataFrame([("FR", 2020, 1.0), ("FR", 2022, 2.0), ("FR", 2022, 3.0), ("KE", 2021, 9.0)],
                                "country_iso2 string, year int, population double")
    r8 = spark.createDataFrame([(1.17, 150.0, "GBP", "x")], "EUR double, KES double, base string, date string")
    gold = gold_countries_enriched(silver, pop, r8, AS_OF)
    assert gold.columns[:4] == ["pays", "nom_officiel", "iso2", "iso3"] and gold.columns[-1] == "processed_at"
    g = sorted(gold.collect(), key=lambda r: (r.pays, r.population_banque_mondiale or 0))
    fr = [r for r in g if r.pays == "France"]
    assert [r.population_banque_mondiale for r in fr] == [2.0, 3.0]            # ties fan out
    assert fr[0].annee_population == 2022 and fr[0].taux_change_vs_gbp == 1.17 and fr[0].densite_population == 121.82
    ke = [r for r in g if r.pays == "Kenya"][0]
    assert (ke.devise_principale, ke.taux_change_vs_gbp) == ("KES", 150.0)
    zz = [r for r in g if r.pays == "Zero"][0]
    assert (zz.population_banque_mondiale, zz.devise_principale, zz.densite_population) == (None, None, None)
    bare = gold_countries_enriched(silver, None, None, AS_OF)
    assert {"population_banque_mondiale", "taux_change_vs_gbp", "devise_principale"} <= set(bare.columns)


def test_population_wine_rates_silver(spark):
    raw = spark.createDataFrame([("P", "FR", "France", 2020, 5.0), ("P", "FR", "France", 2020, 5.0),
                                 ("P", "DE", "Germany", 2020, 0.0), ("P", "IT", "Italy", 2020, float("nan")),
                                 ("P", "ES", "Spain", 2020, -1.0), ("P", "PT", "Portugal", None, 2.0)],
                                "indicator_id string, country_iso2 string, country_name string, year int, population double")
    out = sorted(population_silver(raw, AS_OF).collect(), key=lambda r: r.country_iso2)
    assert [(r.country_iso2, r.year_month) for r in out] == [("FR", "2020-01"), ("PT", None)]
    wine = spark.createDataFrame([("w1", " France ", "Red ", "20", "90"), ("w1", "Italy", "x", "5", "80"),
                                  ("w2", None, "x", "5", "80"), ("w3", "Chile", "x", "n/a", "80"),
                                  ("w4", "Spain", "x", "10", "0")],
                                 "title string, country string, variety string, price string, points string")
    w = {r.title: r for r in wine_silver(wine, AS_OF, order_by=["country"]).collect()}
    assert set(w) == {"w1", "w4"} and (w["w1"].country, w["w1"].variety) == ("France", "Red")
    assert w["w1"].price_per_point == 20 / 90 and w["w4"].price_per_point is None
    assert rates_silver(rates(spark), AS_OF).first().processed_at == AS_OF


def test_bi_pack(spark):
    silver = books_silver(books_raw(spark), rates(spark))
    details = gold_books_details(silver, rates(spark), AS_OF)
    assert [tuple(r) for r in books_by_category(details).collect()][0] == ("Poetry", 2)
    share = {r.category: r.share for r in revenue_share(details).collect()}
    assert abs(share["Poetry"] - 30 / 35) < 1e-12
    sql = {tuple(r) for r in run_sql(spark, "books_by_category", {"gold_books_details": details}).collect()}
    assert sql == {tuple(r) for r in books_by_category(details).collect()}
    enriched = spark.createDataFrame([("A", 5.0, "X", "USD", 1.2), ("B", None, "X", "EUR", None), ("C", 9.0, "Y", "USD", 1.4)],
                                     "pays string, population_banque_mondiale double, region string, "
                                     "devise_principale string, taux_change_vs_gbp double")
    assert [r.pays for r in top_populated(enriched, 20).collect()] == ["C", "A"]
    assert [(r.devise_principale, round(r.taux, 6)) for r in rate_by_currency(enriched).collect()] == [("USD", 1.3)]
    assert set(SQL) >= {"top_populated", "rate_by_currency", "countries_by_region"}

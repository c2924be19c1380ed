import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from plazalake.functions.html_cards import read_cards
from plazalake.operators import serving
from plazalake.operators.cards import extract_cards
from plazalake.sources import exports

PAGE = """<html><body><div data-qa="posting PROPERTY" data-id="7" data-posting-type="PROPERTY"
 data-to-posting="/aviso/7"><p>Av. Uno 110</p><h2 data-qa="POSTING_CARD_LOCATION">R&iacute;mac,
 <b>Lima</b></h2><div data-qa="POSTING_CARD_PRICE">S/ 2,750<br></div>
 <span data-qa="expensas">  </span><i class="a pill-item-feature">Piscina</i>
 <i class="pill-item-feature"> </i><img src="/i.jpg"></div>
 <div data-qa="posting DEVELOPMENT">no id</div></body></html>"""


def test_cards_of_a_page():
    (card,) = read_cards(PAGE, "https://h/list?page=2")
    assert card["id"] == "7" and card["price"] == "S/ 2,750" and card["maintenance"] is None
    assert card["location"] == "Rímac, Lima" and card["street"] == "Av. Uno 110"
    assert card["amenities"] == ["Piscina"] and card["image"] == "https://h/i.jpg"
    assert card["publisher"] is None and card["url"] == "/aviso/7"
    assert read_cards(None, "") == [] and read_cards("<p>x</p>", "") == []


def export(spark):
    day = date(2024, 1, 1)
    rows = [
        ("Rímac", 1, "PEN", 2, 1000.0), ("RIMAC", 1, "pen", 1, 4000.0), ("Ate Vitarte", 2, "PEN", 3, 2000.0),
        ("Barrio", 1, "PEN", 5, 900.0), ("Ate", 4, "PEN", 0, 100.0), ("Ate", 5, "PEN", 1, 1.0),
        ("Ate", 3, "USD", 9, 1.0), ("Ate", 3, "PEN", 4, None),
    ]
    df = spark.createDataFrame(
        rows, "district string, bedrooms int, currency string, listing_count bigint, price double"
    )
    price = F.col("price")
    return df.withColumns(
        {
            "ingest_date": F.lit(day), "avg_price": price, "median_price": price, "min_price": price,
            "max_price": price, "avg_area_m2": F.lit(50.0), "median_price_per_m2": price / 50,
            "new_listing_count": F.lit(1), "removed_listing_count": F.lit(0),
            "price_changed_count": F.lit(0), "offer_change_pct": F.lit(None).cast("double"),
            "calculated_at": F.lit("2024-01-02T00:00:00Z"),
        }
    ).drop("price")


METRICS = ("listing_count", "avg_price", "median_price", "avg_area_m2", "median_price_per_m2")


def test_rollups_and_matrix(spark):
    rows = serving.servable(export(spark), METRICS)
    assert rows.count() == 4
    by_bed = {
        (r["district_key"], r["bedrooms"]): r
        for r in serving.roll_up(rows, ["district_key", "bedrooms"]).collect()
    }
    rimac = by_bed[("RIMAC", 1)]
    assert (rimac["listing_count"], rimac["avg_rent_pen"], rimac["new_listing_count"]) == (3, 2000.0, 2)
    attributes = spark.createDataFrame(
        [("Rímac", "Lima", "X"), ("Ate", "LIMA", "X"), (" ", "Lima", "X"), ("Cusco", "Cusco", "X")],
        "Nombre_Dist string, DEPARTAMENTO string, provincia string",
    )
    districts = serving.official_districts(attributes)
    assert sorted(r[0] for r in districts.collect()) == ["ATE", "RIMAC"]
    matrix = serving.in_official(rows, districts)
    assert serving.value_matrix(matrix).count() == 3  # both spellings stay
    rolled = serving.roll_up(rows, ["district_key"])
    assert [r[0] for r in serving.unmatched_labels(rolled, districts).collect()] == ["Barrio"]
    mapped = serving.in_official(rolled, districts)
    points = serving.midpoints(mapped).first()
    assert (points["supply_median"], points["rent_median"]) == (3.0, 2000.0)
    best = [r["district_key"] for r in serving.opportunities(mapped).collect()]
    assert best == ["ATE", "RIMAC"]
    mix = {r["district_key"]: r for r in serving.bedroom_mix(
        serving.roll_up(rows, ["district_key", "bedrooms"]), serving.top_supply(rolled, 10)).collect()}
    assert (mix["ATE"]["bedrooms_2"], mix["ATE"]["bedrooms_1"], mix["BARRIO"]["bedrooms_1"]) == (3, 0, 5)
    labels = serving.facet_labels(matrix)
    assert sorted((r["bedrooms"], r["district_key"]) for r in labels.collect()) == [(1, "RIMAC"), (2, "ATE")]
    colours = serving.choropleth(districts, rolled).collect()
    assert {r["district_key"]: r["rent_bracket"] for r in colours} == {"ATE": 2, "RIMAC": 2}


def test_column_search():
    assert serving.find_column(["id", "Nómb_Dist"], serving.DISTRICT_COLUMNS) == "Nómb_Dist"
    assert serving.find_column(["id"], serving.DISTRICT_COLUMNS) is None


def test_export_contract(spark, tmp_path):
    good = export(spark)
    exports.write_export(good, str(tmp_path / "csv"))
    text = exports.read_export(spark, str(tmp_path / "csv"))
    assert text.count() == 8 and serving.servable(text, METRICS).count() == 4
    assert serving.single_date(text) == "2024-01-01"
    with pytest.raises(ValueError, match="calculated_at"):
        serving.require_columns(good.drop("calculated_at"))
    other = good.withColumn("ingest_date", F.lit(date(2024, 1, 2)))
    with pytest.raises(ValueError):
        serving.single_date(good.unionByName(other))
    with pytest.raises(ValueError):
        serving.single_date(good.limit(0))
    assert serving.single_date(good.limit(0), allow_none=True) is None


def test_payloads(spark):
    rows = serving.value_matrix(serving.servable(export(spark), METRICS))
    columns = ["district_key", "bedrooms", "listing_count"]
    lines = [json.loads(r[0]) for r in exports.payload_rows(rows, columns).collect()]
    parts = exports.payload_document(rows, columns, ["district", "bedrooms"], "2024-01-01")
    ordered = parts.orderBy("section", "district", "bedrooms").collect()
    document = json.loads("".join(r["value"] for r in ordered))
    none = exports.payload_document(rows.limit(0), columns, ["district", "bedrooms"], "2024-01-01")
    assert json.loads("".join(r["value"] for r in none.orderBy("section").collect()))["rows"] == []
    assert document["scrapeDate"] == "2024-01-01"
    assert sorted(map(str, document["rows"])) == sorted(map(str, lines))
    head = json.loads(exports.dashboard_header([1500, 2000], "2024-01-01", spark).first()[0])
    assert head["binLabels"] == ["Menos de S/ 1,500", "S/ 1,500 – 1,999", "S/ 2,000 o más"]


def test_cards_of_pages_in_capitals(spark):
    page = PAGE.replace("data-qa", "DATA-QA")
    assert read_cards(page, "https://h/list?page=2") == read_cards(PAGE, "https://h/list?page=2")
    pages = spark.createDataFrame([(page, "https://h/list?page=2")], "html string, url string")
    assert extract_cards(pages).count() == 1


def test_dashboard_document_is_json(spark, tmp_path):
    rows = spark.createDataFrame(
        [("ATE", "Ate", 1, 3, 1000.0, 900.0, 50.0, 20.0, 1, 0, 2), ("ATE", "Áte", 2, 1, 2000.0, 1900.0, 80.0, 25.0, 0, 1, 0),
         ("LIMA", "Lima \"x\"", 1, 2, 500.0, 400.0, 30.0, 10.0, None, None, None)],
        "district_key string, district string, bedrooms int, listing_count long, avg_price double, median_price double, "
        "avg_area_m2 double, median_price_per_m2 double, new_listing_count int, removed_listing_count int, price_changed_count int",
    )
    rolled = serving.dashboard_roll_ups(rows)
    exports.write_payload(exports.dashboard_document(rolled, (1500, 2000), "2024-01-01"), f"{tmp_path}/doc")
    text = "".join(r[0] for r in spark.read.text(f"{tmp_path}/doc").collect())
    page = json.loads("".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "doc").glob("part-*"))))
    assert len(text) > 100 and list(page) == ["scrapeDate", "bins", "binLabels", "market", "bedroomMarket"]
    assert page["bins"] == [1500.0, 2000.0] and len(page["binLabels"]) == 3
    assert [(m["district_key"], m["listing_count"], m["avg_rent_pen"]) for m in page["market"]] == [("ATE", 4, 1250.0), ("LIMA", 2, 500.0)]
    assert [(m["bedrooms"], m["new_listing_count"]) for m in page["bedroomMarket"]] == [(1, 1), (2, 0), (1, None)]
    for keys, mine in ((["district_key"], page["market"]), (["district_key", "bedrooms"], page["bedroomMarket"])):
        plain = serving.roll_up(rows, keys).orderBy(*keys).collect()
        assert [round(r["median_price_m2"], 6) for r in plain] == [m["median_price_m2"] for m in mine]

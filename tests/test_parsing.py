import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from plazalake.config import EngineConfig, SearchSpec, strict_date
from plazalake.functions import keys as K
from plazalake.functions import measures as M
from plazalake.functions import parsing as P
from plazalake.functions import text as T
from plazalake.functions.html_cards import read_cards

PRICES = [
    ("S/ 2,750", 2750.0, "PEN", 2750.0, "PEN"),
    ("S/ 2,750.50", 275050.0, "PEN", 2750.5, "PEN"),
    ("S/. 1.200", 1200.0, "PEN", 1.2, "PEN"),
    ("US$ 1,200", 1200.0, "USD", 1200.0, "USD"),
    ("USD 900", 900.0, "USD", 900.0, "PEN"),
    ("Departamentos desde S/ 2,750", 2750.0, "PEN", 2750.0, "PEN"),
    ("Consultar precio", None, None, None, "PEN"),
    ("", None, None, None, "PEN"),
    (None, None, None, None, "PEN"),
    ("S/ 0", 0.0, "PEN", 0.0, "PEN"),
    ("S/ 1,200 · US$ 350", 1200.0, "USD", 1200.0, "USD"),
    ("1200 pen", 1200.0, "PEN", 1200.0, "PEN"),
]
AREAS = [
    ("90", 90, 90, 90, 90),
    ("40 a 69", 40, 69, 40, 69),
    ("45 A 60", 45, 60, 45, 45),
    ("45-60", 45, 60, 45, 45),
    ("45,5 a 60.25", 45.5, 60.25, 455, 60.25),
    ("1,200", 1.2, 1.2, 1200, 1200),
    ("1.200,50", 1.2, 1.2, 1.2005, 1.2005),
    ("desde 45 a 60", None, 60, 45, 60),
    ("60 a 45", 60, 45, 60, 45),
    ("0 a 50", 0, 50, 0, 50),
    ("45 hasta 60", 45, 60, 45, 60),
    ("", None, None, None, None),
    (None, None, None, None, None),
]
FEATURES = [
    ("59 m² tot.2 dorm.1 baño", "59", "2", "1", None),
    ("160 un.1 a 2 dorm.45 a 60 m² tot.", "45 a 60", "1 a 2", None, "160"),
    ("59.5 m² tot. · 2 dorm.", "5", "2", None, None),
    ("1,200 m²", "200", None, None, None),
    ("monoambiente", None, None, None, None),
    (None, None, None, None, None),
]


def test_prices_in_both_profiles(spark):
    df = spark.createDataFrame([(p[0],) for p in PRICES], "raw string")
    none = F.lit(None)
    rows = df.select(
        "raw",
        P.price_amount(none, F.col("raw")),
        P.price_currency(F.col("raw"), none.cast("string")),
        P.grouped_number(F.col("raw")),
        P.refresh_currency(F.col("raw"), none.cast("string")),
    ).collect()
    assert [tuple(r) for r in rows] == PRICES


def test_exposed_price_and_currency_code(spark):
    row = spark.range(1).select(
        P.price_amount(F.lit(12.5), F.lit("S/ 99")),
        P.price_currency(F.lit("a consultar"), F.lit(" usd ")),
        P.price_currency(F.lit("a consultar"), F.lit("eur")),
    ).first()
    assert tuple(row) == (12.5, "USD", None)


def test_areas_in_both_profiles(spark):
    df = spark.createDataFrame([(a[0],) for a in AREAS], "raw string")
    raw = F.col("raw")
    low = P.grouped_number(raw)
    rows = df.select(raw, P.area_min(raw), P.area_max(raw, P.area_min(raw)), low, P.grouped_range_end(raw, low))
    assert [tuple(r) for r in rows.collect()] == AREAS


def test_feature_text(spark):
    df = spark.createDataFrame([(f[0],) for f in FEATURES], "raw string")
    parts = [P.feature_part(F.col("raw"), field) for field in P.FEATURE_UNITS]
    assert [tuple(r) for r in df.select("raw", *parts).collect()] == FEATURES


def test_bedroom_fallbacks(spark):
    low = P.bedrooms_min(F.col("raw"), F.col("searched"), F.col("path"))
    df = spark.createDataFrame(
        [("2 a 3", 1, 1), (None, 4, 1), ("loft", None, 3), (None, None, None)],
        "raw string, searched int, path int",
    )
    rows = df.select(low, P.bedrooms_max(F.col("raw"), low)).collect()
    assert [tuple(r) for r in rows] == [(2, 3), (4, 4), (3, 3), (None, None)]


def test_locations_and_urls(spark):
    cases = {
        "Rímac, Lima": ("Rímac", "Lima"),
        "A, B, C": ("A", "C"),
        "Lima": ("Lima", None),
        ", ,": (None, None),
        None: (None, None),
    }
    df = spark.createDataFrame([(c,) for c in cases], "raw string")
    rows = df.select("raw", *T.location_parts(F.col("raw"))).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == cases
    urls = spark.createDataFrame([("/a",), ("http://x/a",), ("",), (None,)], "u string")
    got = urls.select(T.absolute_url(F.col("u"), "https://h")).collect()
    assert [r[0] for r in got] == ["https://h/a", "http://x/a", None, None]


def test_name_keys(spark):
    df = spark.createDataFrame([("Rímac  Ñaña",), (" ate Vitarte ",), (None,)], "n string")
    rows = df.select(T.name_key(F.col("n")), T.district_key(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [("RIMAC NANA", "RIMAC NANA"), ("ATE VITARTE", "ATE"), ("", "")]


def test_base_letters_of_every_character(spark):
    def plain(text):
        return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn")

    # Marks are the business of the engine's own Unicode tables, whose version may differ.
    letters = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    kinds = {c: unicodedata.category(c) for c in letters}
    letters = [c for c in letters if kinds[c] not in ("Mn", "Cn") and (kinds[c] != "Mc" or unicodedata.decomposition(c))]
    texts = [" ".join(letters[i : i + 300]) for i in range(0, len(letters), 300)] + ["한국 é", "", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, got in df.select("t", T.base_letters(F.col("t"))).collect():
        assert got == plain(text)


def test_place_name_default_only_for_null(spark):
    df = spark.createDataFrame([(" SAN  MIGUEL ",), ("",), (None,)], "n string")
    got = [r[0] for r in df.select(P.place_name(F.col("n"), "Unknown")).collect()]
    assert got == ["San  Miguel", "", "Unknown"]


def test_brackets(spark):
    bounds = [1500, 2000, 2500, 3000, 4000]
    df = spark.createDataFrame([(1499.99,), (1500.0,), (1999.5,), (4000.0,)], "v double")
    assert [r[0] for r in df.select(M.bracket_index(F.col("v"), bounds)).collect()] == [0, 1, 1, 5]
    assert M.bracket_labels(bounds)[:2] == ["Menos de S/ 1,500", "S/ 1,500 – 1,999"]
    assert M.bracket_labels(bounds)[-1] == "S/ 4,000 o más"
    with pytest.raises(ValueError):
        M.bracket_index(F.col("v"), [2, 1])


def test_path_values_and_keys(spark):
    df = spark.createDataFrame(
        [
            ("x/bedrooms=3/ingest_date=2026-07-13/f.jsonl",),
            ("x/bedrooms=x/ingest_date=2026-13-40/f.jsonl",),
            ("f",),
        ],
        "p string",
    )
    rows = df.select(K.path_date(F.col("p")).cast("string"), K.path_bedrooms(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("2026-07-13", 3), (None, None), (None, None)]
    run = spark.range(1).select(K.stable_run_id(F.lit("_a:b+c__"), F.lit(2))).first()[0]
    assert run == "a_b_c_b2"


def test_lower_median(spark):
    df = spark.createDataFrame([(900.0,), (1300.0,), (None,)], "v double")
    assert df.select(M.lower_median(F.col("v"))).first()[0] == 900.0


def test_configuration():
    config = EngineConfig("prod", "/raw", "/ck")
    assert config.raw_path == "/raw/" and config.snapshot == "prod_silver.listings_snapshot"
    assert EngineConfig("cat.", "/r", "/c").market_daily == "cat.gold.market_daily_by_district"
    with pytest.raises(ValueError):
        EngineConfig("  ", "/r", "/c")
    for segment in (1, 2, 3, 4):
        assert SearchSpec(bedrooms=segment).bedrooms == segment
    for segment in (0, 5):
        with pytest.raises(ValueError):
            SearchSpec(bedrooms=segment)
    assert strict_date("2026-07-13").isoformat() == "2026-07-13"
    for text in ("20260713", "2026-7-1", "x"):
        with pytest.raises(ValueError):
            strict_date(text)


def test_unclosed_elements_end_as_in_a_browser():
    page = (
        '<div data-qa="posting PROPERTY" data-id="1"><ul><li>Av. Uno<li data-qa="POSTING_CARD_LOCATION">'
        'Rimac, Lima<li data-qa="POSTING_CARD_PRICE">S/ 10<ul><li>inner</ul></ul>'
        '<p data-qa="POSTING_CARD_DESCRIPTION">first<p>second<div data-qa="expensas">S/ 2</div></div>'
    )
    (card,) = read_cards(page, "http://x/")
    assert (card["street"], card["location"], card["price"]) == ("Av. Uno", "Rimac, Lima", "S/ 10inner")
    assert (card["description"], card["maintenance"]) == ("first", "S/ 2")


def test_nested_cards_are_read_in_one_pass():
    """Each card has the first of each mark below it; cards nest 3,000 deep."""
    one = "<div data-qa='posting' data-id='{}'><b data-qa='POSTING_CARD_PRICE'>S/ {}</b><i class='pill-item-feature'>p{}</i>"
    depth = 3000
    page = "".join(one.format(i, i, i) if i % 100 else one.format(i, i, i).replace("POSTING_CARD_PRICE", "x") for i in range(depth))
    start = time.perf_counter()
    cards = read_cards(page + "<img src='a.png'>", "http://h/")
    assert time.perf_counter() - start < 20
    assert [c["id"] for c in cards] == [str(i) for i in range(depth)]
    # A card without a price of its own shows that of the card in it.
    assert [c["price"] for c in cards[98:102]] == ["S/ 98", "S/ 99", "S/ 101", "S/ 101"]
    assert cards[-2]["amenities"] == ["p2998", "p2999"] and cards[0]["image"] == "http://h/a.png"
    closed = read_cards(one.format(1, 2, 3) + "</div>" + one.format(4, 5, 6).replace("POSTING_CARD_PRICE", "x"), "")
    assert [(c["price"], c["amenities"]) for c in closed] == [("S/ 2", ["p3"]), (None, ["p6"])]

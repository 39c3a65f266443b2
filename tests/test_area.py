from helpers import actions_df
from shoplens.operators import area as A
from shoplens.params import TaskParams

P = TaskParams(start_date="2019-06-01", end_date="2019-06-30", task_id="t", top_products=2)


def test_city_list_and_status(spark):
    cities = spark.createDataFrame([(1, "X", "华北"), (11, "X", "华北"), (2, None, "华北"), (3, "Z", "东北")],
                                   "city_id long, city_name string, area string")
    products = spark.createDataFrame([(7, "p7", '{"product_status": 0}'), (8, "p8", '{"product_status": 1}'),
                                      (9, "p9", '{"x": 1}'), (10, "p10", None)],
                                     "product_id long, product_name string, extend_info string")
    rows = ([dict(city_id=1, click_product_id=7)] * 2 + [dict(city_id=11, click_product_id=7)]
            + [dict(city_id=2, click_product_id=8)] * 3 + [dict(city_id=1, click_product_id=9)] * 3
            + [dict(city_id=3, click_product_id=10)] + [dict(city_id=1, click_product_id=-1)] * 5
            + [dict(city_id=1, click_product_id=7, date="2019-07-01")])
    acts = actions_df(spark, rows)
    counts = {(r.area, r.pid): (r.click_count, r.city_infos)
              for r in A.area_product_click_count(A.product_clicks(acts, P), cities).collect()}
    assert counts[("华北", 7)] == (3, "11:X,1:X")
    assert counts[("华北", 8)] == (3, "")  # NULL city name skipped
    top = A.area_top3_job(acts, cities, products, P).collect()
    got = sorted((r.area, r.areaLevel, r.productid, r.clickCount, r.productStatus) for r in top)
    assert got == sorted([("华北", "A_Level", 7, 3, "Self"), ("华北", "A_Level", 8, 3, "Third Party"),
                          ("东北", "D_Level", 10, 1, "Third Party")])


def test_reference_city_dimension_and_defaults(spark):
    from shoplens.functions import columns as X
    from shoplens.sources.dimensions import reference_cities, reference_params
    cities = reference_cities(spark)
    levels = {r.city_id: r.lvl for r in cities.select("city_id", X.area_level("area").alias("lvl")).collect()}
    assert levels == {0: "A_Level", 1: "A_Level", 2: "A_Level", 3: "B_Level", 4: "B_Level", 5: "B_Level",
                      6: "B_Level", 7: "C_Level", 8: "C_Level", 9: "D_Level"}
    p = reference_params()
    assert (p.start_date, p.end_date, p.start_age, p.end_age) == ("2018-06-01", "2019-06-30", 20, 50)
    assert p.target_page_flow == (1, 2, 3, 4, 5, 6, 7) and not p.professionals and p.sex is None

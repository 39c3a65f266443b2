"""The reference's literal city dimension (S6) and default task parameters.

The jobs accept any city DataFrame (``city_id, city_name, area``); this module
only reproduces the reference's built-in one for users who run its setup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoplens.params import TaskParams
from shoplens.schemas import CITY_INFO

# The reference's city dimension, in its order.
# (city_id, city_name, area)
REFERENCE_CITIES = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)

# The reference's default task parameters.
REFERENCE_DEFAULTS = {
    "startDate": "2018-06-01",
    "endDate": "2019-06-30",
    "startAge": 20,
    "endAge": 50,
    "professionals": "",
    "cities": "",
    "sex": "",
    "keywords": "",
    "categoryIds": "",
    "targetPageFlow": "1,2,3,4,5,6,7",
}


def reference_cities(spark: SparkSession) -> DataFrame:
    """The 10-row city dimension as a DataFrame (small, broadcast by the planner)."""
    return spark.createDataFrame(list(REFERENCE_CITIES), CITY_INFO)


def reference_params(**overrides) -> TaskParams:
    """``TaskParams`` with the reference's defaults."""
    return TaskParams.from_json(REFERENCE_DEFAULTS).with_(**overrides)

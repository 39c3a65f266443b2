"""Parameters of the registered queries.

The date range covers the whole ``events`` table (January 2024), so every
registered query reads all of its input. The age range and the page flow are
the reference's defaults (ages 20 to 50, flow 1..7).
"""

from shoplens.params import TaskParams

QUERY_PARAMS = TaskParams(
    start_date="2024-01-01",
    end_date="2024-12-31",
    start_age=20,
    end_age=50,
    target_page_flow=(1, 2, 3, 4, 5, 6, 7),
    task_id="task",
    sample_seed="shoplens",
    blacklist_threshold=2,
)

# The floor rule draws floor(size / days) sessions a day; over the 30 days of the
# events table this size leaves the busier hours of each day a quota above zero
# (sizes up to 1,000 keep the partial group limit of the draw).
FLOOR_SAMPLE_SIZE = 900

# Filter settings of the single-criterion filter queries.
FILTER_PROFESSIONALS = ("AUTOMOBILE", "MACHINERY")
FILTER_CITIES = ("NATION_1", "NATION_3", "NATION_5", "NATION_7")
FILTER_SEX = "female"
FILTER_KEYWORDS = ("kw1", "kw4")
FILTER_CATEGORIES = (3, 17, 44, 48, 57, 90)

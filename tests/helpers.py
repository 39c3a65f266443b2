"""Builders for hand-written action rows."""

from shoplens.schemas import USER_VISIT_ACTION_WITH_ID, USER_INFO

_DEFAULTS = dict(date="2019-06-10", user_id=1, session_id="s", page_id=1, action_time="2019-06-10 10:00:00",
                 search_keyword=None, click_category_id=-1, click_product_id=-1, order_category_ids=None,
                 order_product_ids=None, pay_category_ids=None, pay_product_ids=None, city_id=0, event_id=0)


def action(**kw):
    row = dict(_DEFAULTS)
    row.update(kw)
    return tuple(row[f.name] for f in USER_VISIT_ACTION_WITH_ID.fields)


def actions_df(spark, rows):
    rows = [action(event_id=i, **r) if "event_id" not in r else action(**r) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, USER_VISIT_ACTION_WITH_ID)


def users_df(spark, rows):
    base = dict(user_id=1, username="u", name="n", age=30, professional="p", city="c", sex="male")
    out = []
    for r in rows:
        d = dict(base)
        d.update(r)
        out.append(tuple(d[f.name] for f in USER_INFO.fields))
    return spark.createDataFrame(out, USER_INFO)


def at(seconds: int, day: str = "2019-06-10") -> str:
    """Action time ``seconds`` after 10:00:00 (hour not zero-padded below 10)."""
    h, rem = divmod(10 * 3600 + seconds, 3600)
    m, s = divmod(rem, 60)
    return f"{day} {h}:{m:02d}:{s:02d}"

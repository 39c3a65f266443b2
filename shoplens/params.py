"""Typed job parameters.

The reference reads a JSON object from a properties file and packs it into a
``key=value|key=value`` string before filtering. Here the parameters are a frozen
dataclass and every set parameter becomes a Column predicate or literal.
An empty value (``None``, ``""`` or an empty list) means "no filter".
"""

from __future__ import annotations

import re
from dataclasses import dataclass, fields, replace
from datetime import date
from typing import Sequence


def _clean_list(values) -> tuple:
    if values is None:
        return ()
    if isinstance(values, str):
        values = [v for v in values.split(",")]
    return tuple(v for v in (x.strip() if isinstance(x, str) else x for x in values) if v not in ("", None))


@dataclass(frozen=True)
class TaskParams:
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: Sequence[str] = ()
    cities: Sequence[str] = ()
    sex: str | None = None
    keywords: Sequence[str] = ()
    category_ids: Sequence[int] = ()
    # Fixed values (the reference's defaults): page flow 1..7, 100 sampled
    # sessions, top 10 categories, top 10 sessions per category, top 3 products
    # per area, floor quota allocation; the top 3 ads follow the result name.
    target_page_flow: Sequence[int] = (1, 2, 3, 4, 5, 6, 7)
    sample_size: int = 100
    top_categories: int = 10
    top_sessions: int = 10
    top_products: int = 3
    top_ads: int = 3
    allocation: str = "floor"  # or "largest_remainder"
    # our own: seed of the reproducible hash order used for sampling, and the
    # number of salt groups a hot group (an hour of the sample, a category of
    # the top sessions) is split into before its final top-k
    sample_seed: str = "shoplens"
    salt_groups: int = 32
    # ad stream (no reference values exist: these are parameters of ours)
    blacklist_threshold: int = 100
    trend_window: str = "1 minute"
    watermark_delay: str = "10 minutes"
    # seconds between looks at the blacklist; statistics restart with it when it has grown
    blacklist_refresh: int = 60
    # partitions of the streaming state store (fixed at the first start of a
    # checkpoint); None keeps spark.sql.shuffle.partitions
    stream_state_partitions: int | None = None
    # files per result table per micro-batch (avoids one file per shuffle partition)
    stream_output_files: int = 4
    # funnel: width in seconds of the time slices that split one session's
    # ordered actions over several tasks (see operators.funnel)
    pair_slice_seconds: int = 600
    task_id: str = "task"

    def __post_init__(self):
        object.__setattr__(self, "professionals", _clean_list(self.professionals))
        object.__setattr__(self, "cities", _clean_list(self.cities))
        object.__setattr__(self, "keywords", _clean_list(self.keywords))
        object.__setattr__(self, "category_ids", tuple(int(c) for c in _clean_list(self.category_ids)))
        object.__setattr__(self, "target_page_flow", tuple(int(p) for p in _clean_list(self.target_page_flow)))
        if self.sex == "":
            object.__setattr__(self, "sex", None)
        for name in ("start_date", "end_date"):
            value = getattr(self, name)
            if value and not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
                raise ValueError(f"{name} must be yyyy-MM-dd, not {value!r}")
            if value:
                date.fromisoformat(value)
        width = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", self.trend_window)
        seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
        if not width or not int(width[1]) or int(width[1]) * seconds[width[2]] % 60:
            raise ValueError(f"trend_window must be whole minutes, not {self.trend_window!r}")
        if self.allocation not in ("floor", "largest_remainder"):
            raise ValueError(f"unknown allocation {self.allocation!r}")

    def with_(self, **kw) -> "TaskParams":
        return replace(self, **kw)

    def require_dates(self) -> tuple[str, str]:
        """Both dates are mandatory for the action scan (a missing date raises)."""
        if not self.start_date or not self.end_date:
            raise ValueError("start_date and end_date are required")
        return self.start_date, self.end_date

    @classmethod
    def from_json(cls, obj: dict) -> "TaskParams":
        """Build from the JSON parameter object: the field names in camelCase; unknown keys are an error."""
        def num(v):
            return None if v in (None, "") else int(v)

        camel = {re.sub(r"_(.)", lambda m: m[1].upper(), f.name): f.name for f in fields(cls)}
        if unknown := sorted(set(obj) - set(camel)):
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")
        read = {"startDate", "endDate", "startAge", "endAge", "professionals", "cities", "sex", "keywords", "categoryIds"}
        extra = {camel[k]: v for k, v in obj.items() if k not in read and v not in (None, "", [])}
        return cls(
            start_date=obj.get("startDate"),
            end_date=obj.get("endDate"),
            start_age=num(obj.get("startAge")),
            end_age=num(obj.get("endAge")),
            professionals=obj.get("professionals") or (),
            cities=obj.get("cities") or (),
            sex=obj.get("sex") or None,
            keywords=obj.get("keywords") or (),
            category_ids=obj.get("categoryIds") or (),
            **extra,
        )

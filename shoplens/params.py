"""Task parameters: the reference's JSON task object as a typed dataclass.

Empty strings and missing keys mean "no filter"; only the date range is
required.  Each parameter turns into a ``Column`` predicate, so the whole
filter is one expression Catalyst can optimise (and push into scans where
it touches scan columns).
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def _csv(value) -> list[str]:
    if value is None:
        return []
    if isinstance(value, (list, tuple)):
        return [str(v).strip() for v in value if str(v).strip() != ""]
    return [part.strip() for part in str(value).split(",") if part.strip() != ""]


def _opt_int(value) -> int | None:
    if value is None or str(value).strip() == "":
        return None
    return int(value)


@dataclass(frozen=True)
class TaskParams:
    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: list[str] = field(default_factory=list)
    cities: list[str] = field(default_factory=list)
    sex: str | None = None
    keywords: list[str] = field(default_factory=list)
    category_ids: list[int] = field(default_factory=list)
    target_page_flow: list[int] = field(default_factory=lambda: [1, 2, 3, 4, 5, 6, 7])

    @classmethod
    def from_dict(cls, obj: dict) -> "TaskParams":
        """Accept the reference's key names (camelCase) or snake_case."""

        def get(*names):
            for name in names:
                if name in obj:
                    return obj[name]
            return None

        start, end = get("startDate", "start_date"), get("endDate", "end_date")
        if not start or not end:
            raise ValueError("startDate and endDate are required")
        sex = get("sex")
        flow = _csv(get("targetPageFlow", "target_page_flow"))
        return cls(
            start_date=str(start),
            end_date=str(end),
            start_age=_opt_int(get("startAge", "start_age")),
            end_age=_opt_int(get("endAge", "end_age")),
            professionals=_csv(get("professionals")),
            cities=_csv(get("cities")),
            sex=str(sex).strip() if sex is not None and str(sex).strip() != "" else None,
            keywords=_csv(get("keywords")),
            category_ids=[int(c) for c in _csv(get("categoryIds", "category_ids"))],
            target_page_flow=[int(p) for p in flow] if flow else [1, 2, 3, 4, 5, 6, 7],
        )

    @classmethod
    def from_json(cls, text: str) -> "TaskParams":
        return cls.from_dict(json.loads(text))

    # ---- predicates -----------------------------------------------------

    def date_predicate(self, date_col: str = "date") -> Column:
        """Inclusive on both ends."""
        return F.col(date_col).between(F.lit(self.start_date), F.lit(self.end_date))

    def session_predicate(self, use_flags: bool = False) -> Column:
        """AND of the optional session filters (P1-P4) over a profiled session.

        Expects columns ``age``, ``professional``, ``city``, ``sex`` and
        either the lists ``search_keywords`` (array<string>) and
        ``click_category_ids`` (array<bigint>) or, with ``use_flags``, the
        booleans ``keyword_match`` / ``category_match`` computed by the
        roll-up.  A null data value fails a filter that is set.
        """
        preds: list[Column] = []
        # The range applies only when both bounds are given.
        if self.start_age is not None and self.end_age is not None:
            preds.append(F.col("age").between(self.start_age, self.end_age))
        if self.professionals:
            preds.append(F.col("professional").isin(self.professionals))
        if self.cities:
            preds.append(F.col("city").isin(self.cities))
        if self.sex is not None:
            preds.append(F.col("sex") == F.lit(self.sex))
        if self.keywords:
            preds.append(
                F.col("keyword_match")
                if use_flags
                else F.arrays_overlap(F.col("search_keywords"), F.array(*[F.lit(k) for k in self.keywords]))
            )
        if self.category_ids:
            preds.append(
                F.col("category_match")
                if use_flags
                else F.arrays_overlap(
                    F.col("click_category_ids"),
                    F.array(*[F.lit(c).cast("bigint") for c in self.category_ids]),
                )
            )
        # Null (unknown user attribute, null array element) counts as no match.
        return functools.reduce(
            lambda a, b: a & b, [F.coalesce(p, F.lit(False)) for p in preds], F.lit(True)
        )

    def page_pairs(self) -> list[tuple[int, int, int]]:
        """(step, from_page, to_page) for consecutive pages of the target flow."""
        flow = self.target_page_flow
        return [(i + 1, a, b) for i, (a, b) in enumerate(zip(flow, flow[1:]))]

"""Ad analytics over a finished log (batch twin of the stream, SURVEY §3.3).

Same functions as the streaming handlers, applied to the whole log at once:
blacklist from per-day counts, stats of the clicks that remain, province
top-3, and the per-minute trend of all clicks (Q12: the trend is not
blacklist-filtered unless asked).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from shoplens.operators import ads as A


@dataclass
class AdBatchResult:
    rejected: DataFrame
    user_click_count: DataFrame
    blacklist: DataFrame
    stat: DataFrame
    province_top3: DataFrame
    click_trend: DataFrame


def build(lines: DataFrame, threshold: int = 100, filter_trend: bool = False,
          known_blacklist: DataFrame | None = None) -> AdBatchResult:
    clicks, rejected = A.split_valid(A.decode_ad_log(lines))
    counts = A.user_ad_counts(clicks)
    black = A.blacklist_users(counts, threshold)
    if known_blacklist is not None:
        black = black.unionByName(known_blacklist.select("userid")).distinct()
    kept = A.exclude_blacklisted(clicks, black)
    stat = A.ad_stat(kept)
    return AdBatchResult(
        rejected=rejected,
        user_click_count=counts,
        blacklist=black,
        stat=stat,
        province_top3=A.province_top3(stat),
        click_trend=A.click_trend(kept if filter_trend else clicks),
    )


def run(lines: DataFrame, sink, threshold: int = 100, **options) -> AdBatchResult:
    r = build(lines, threshold, **options)
    sink.write("ad_user_click_count", r.user_click_count)
    sink.write("ad_blacklist", r.blacklist)
    sink.write("ad_stat", r.stat)
    sink.write("ad_province_top3", r.province_top3)
    sink.write("ad_click_trend", r.click_trend)
    return r

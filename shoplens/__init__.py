"""shoplens: e-commerce behaviour-log analytics on Spark DataFrames.

Four workloads, each a chain of DataFrame transformations:

* session statistics, stratified session sample, top categories and their
  most active sessions (:mod:`shoplens.plans.session_job`);
* page-flow conversion (:mod:`shoplens.plans.page_job`);
* leading products per area (:mod:`shoplens.plans.product_job`);
* ad-click counts, provincial top lists, click trend and an abuse
  blacklist, in batch (:mod:`shoplens.operators.ads`) and streaming
  (:mod:`shoplens.streaming.ad_stream`) form.
"""

from shoplens.params import TaskParams
from shoplens.spark import build_session

__all__ = ["TaskParams", "build_session"]

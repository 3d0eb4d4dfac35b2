"""The command-line jobs over parquet tables in the reference's data model."""

from __future__ import annotations

import json

from shoplens.__main__ import main
from shoplens.sources.adapters import DriverTables
from tests.conftest import SF_SMALL


def test_cli_runs_batch_jobs(spark, tmp_path):
    t = DriverTables(spark, SF_SMALL)
    tables = tmp_path / "tables"
    t.actions().drop("action_ts", "tie").write.parquet(str(tables / "user_visit_action.parquet"))
    t.users().write.parquet(str(tables / "user_info.parquet"))
    t.products().write.parquet(str(tables / "product_info.parquet"))
    t.ad_log().write.text(str(tmp_path / "adlog"))
    task = tmp_path / "task.json"
    task.write_text(json.dumps({"startDate": "2024-01-01", "endDate": "2024-12-31", "startAge": 20, "endAge": 50,
                                "professionals": "", "cities": "", "sex": "", "keywords": "", "categoryIds": "",
                                "targetPageFlow": "1,2,3,4,5,6,7"}))
    out = str(tmp_path / "out")
    for job in ("session", "page", "product"):
        assert main([job, "--tables", str(tables), "--params", str(task), "--out", out, "--task-id", "t1"]) == 0
    assert main(["ad-batch", "--log", str(tmp_path / "adlog"), "--out", out, "--threshold", "1"]) == 0
    stat = spark.read.parquet(out + "/session_aggr_stat").collect()[0]
    assert stat.taskid == "t1" and stat.session_count > 0
    assert spark.read.parquet(out + "/top10_category").count() == 10
    assert spark.read.parquet(out + "/page_split_convert_rate").count() == 1
    assert spark.read.parquet(out + "/area_top3_product").count() > 0
    assert spark.read.parquet(out + "/ad_blacklist").count() > 0


def test_cli_ad_stream_available_now(spark, tmp_path):
    day = 1704067200000
    lines = [f"{day + i * 1000} p c 7 1" for i in range(3)] + ["junk"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "log"))
    out = str(tmp_path / "out")
    args = ["ad-stream", "--log", str(tmp_path / "log"), "--out", out, "--checkpoint", str(tmp_path / "ckpt"),
            "--threshold", "2", "--available-now"]
    assert main(args) == 0
    from shoplens.streaming.ad_stream import AdTables

    tables = AdTables.at(spark, out)
    assert [r.userid for r in tables.blacklist().collect()] == [7]
    assert spark.read.parquet(out + "/ad_rejects").count() == 1

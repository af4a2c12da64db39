"""The report job: lineage cut by a reliable checkpoint, tables equal the registered queries."""

from __future__ import annotations

import tempfile

from conftest import SF01
from trajlake.plans import catalog as cat
from trajlake.plans import derived as dv
from trajlake.plans.reports import action_timeline, write_action_reports
from trajlake.schemas import spec_for_join


def test_write_action_reports(spark):
    out = tempfile.mkdtemp(prefix="trajlake-reports-")
    req = dv.action_requests(spark, SF01)
    obs = dv.request_observations(req)
    paths = write_action_reports(spark, req, spec_for_join(spark), out, observations=obs,
                                 velocity_limit=cat.VELOCITY_LIMIT, chunk_us=cat.ACTION_CHUNK_US)
    assert set(paths) == {"outcomes", "timeline", "robot_summary", "segments", "backlog", "positions"}
    tl = spark.read.parquet(paths["timeline"]).select("request_id", "seq", "robot", "ts_us", "period_us", "g_us",
                                                      "e_us", "overrun")
    want = action_timeline(req, spec_for_join(spark), cat.VELOCITY_LIMIT, cat.ACTION_CHUNK_US).select(*tl.columns)   # the plan as queued
    assert {tuple(r) for r in tl.collect()} == {tuple(r) for r in want.collect()}
    seg = spark.read.parquet(paths["segments"]).select("request_id", "seq", "segment_id", "dropped")
    want_seg = cat.q_execution_with_clears(spark, SF01).select("request_id", "seq", "segment_id", "dropped")
    assert {tuple(r) for r in seg.collect()} == {tuple(r) for r in want_seg.collect()}

"""Run-metric queries over the runs and metrics fixtures."""
from __future__ import annotations

from marquee.operators import metrics as mt
from marquee.operators import quality
from marquee.plans import data
from marquee.plans.catalog import query
from marquee.plans.oracle_views import with_views as W
from marquee.sources import fixtures as fx


@query("runs_filtered", W("fx_runs") + """
select run_id, start_time, experiment, architecture, distillation_type from fx_runs
where experiment = 'view' and architecture = 'TwoTower' order by start_time desc, run_id limit 50""")
def q_runs_filtered(spark, d):
    r = mt.runs_filtered(fx.fx_runs(spark, d), experiment="view", architecture="TwoTower", limit=50)
    return r.select("run_id", "start_time", "experiment", "architecture", "distillation_type")


@query("runs_filtered_distill", W("fx_runs") + """
select run_id, start_time from fx_runs where distillation_type = 'cross' order by start_time desc, run_id limit 7""")
def q_runs_filtered_distill(spark, d):
    return mt.runs_filtered(fx.fx_runs(spark, d), distillation_type="cross", limit=7).select("run_id", "start_time")


@query("metric_history", W("fx_metrics") + """
select run_id, metric, row_number() over (partition by run_id, metric order by step) - 1 as pos, step, value
from fx_metrics""")
def q_metric_history(spark, d):
    return mt.metric_history(fx.fx_metrics(spark, d)).select("run_id", "metric", "pos", "step", "value")


@query("latest_metric", W("fx_runs", "fx_metrics") + """
select r.run_id, round(coalesce(l.v, 0.0e0), 4) as latest from fx_runs r
left join (select run_id, arg_max(value, step) as v from fx_metrics where metric = 'view' group by run_id) l
on r.run_id = l.run_id""")
def q_latest_metric(spark, d):
    return mt.latest_metric(fx.fx_runs(spark, d), fx.fx_metrics(spark, d), name="view")


@query("sweep_trials", W("fx_runs") + """
select run_id, start_time from fx_runs where experiment = 'click' and sweep = 'sweep_trial'
order by start_time desc, run_id limit 500""")
def q_sweep_trials(spark, d):
    return mt.sweep_trials(fx.fx_runs(spark, d), "click").select("run_id", "start_time")


@query("run_summary", W("fx_runs", "rk", "fx_movies") + """
select * from (select 'run' as kind, cast(run_id as varchar) as name, cast(null as bigint) as value from fx_runs
               order by start_time desc, run_id limit 20)
union all select 'table', 'ratings', count(*) from rk
union all select 'table', 'movies', count(*) from fx_movies""")
def q_run_summary(spark, d):
    counts = quality.table_counts({"ratings": data.ratings(spark, d), "movies": data.movies(spark, d)})
    return mt.run_summary(fx.fx_runs(spark, d), counts)

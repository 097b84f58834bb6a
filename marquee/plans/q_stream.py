"""Incremental queries: rows since a watermark, the first table that fires, the daily gate,
trigger-log updates, and the file-landing ingest stream."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from marquee.operators import merge
from marquee.operators import watermark as wmk
from marquee.plans.catalog import query
from marquee.plans.oracle_views import with_views as W
from marquee.plans.q_ingest import (FIRST_LOAD_BEFORE, KEYS, SECOND_FILE_FROM, _MERGE, _first_load,
                                    _second_file)
from marquee.session import scratch_path
from marquee.sources import fixtures as fx

# FIXED VALUES of the watermark scenario
MOVIES_STAMP = datetime(2024, 1, 20)
TAGS_STAMP = datetime(2024, 1, 25)
TAGS_WATERMARK = datetime(2024, 1, 21)


def _tables(spark, d):
    return {"ratings": _first_load(spark, d),
            "movies": merge.stamp_inserted_at(fx.fx_movies(spark, d), MOVIES_STAMP),
            "tags": merge.stamp_inserted_at(fx.fx_tags(spark, d), TAGS_STAMP),
            "links": merge.stamp_inserted_at(fx.fx_links(spark, d), TAGS_STAMP)}


def _watermarks(spark, d):
    t = _tables(spark, d)
    wm = merge.max_inserted_watermark({"ratings": t["ratings"], "movies": t["movies"]})
    tags = spark.range(1).select(F.lit("tags").alias("table_name"),
                                 merge.ntz_literal(TAGS_WATERMARK).alias("last_inserted_at"))
    return wm.unionByName(tags)


_WM = _MERGE + [
    ("counts", f"""
select 0 as ord, 'ratings' as table_name, count(*) as new_rows from tgt where inserted_at > (select max(inserted_at) from tgt)
union all select 1, 'movies', count(*) from fx_movies where TIMESTAMP '{MOVIES_STAMP:%Y-%m-%d %H:%M:%S}' > TIMESTAMP '{MOVIES_STAMP:%Y-%m-%d %H:%M:%S}'
union all select 2, 'tags', count(*) from fx_tags where TIMESTAMP '{TAGS_STAMP:%Y-%m-%d %H:%M:%S}' > TIMESTAMP '{TAGS_WATERMARK:%Y-%m-%d %H:%M:%S}'
union all select 3, 'links', count(*) from fx_links"""),
    ("firstt", "select table_name from counts where new_rows > 0 order by ord limit 1"),
]


@query("new_rows_since", W("fx_ratings", extra=_MERGE) + """
select id, user_id, movie_id from upserted where inserted_at > (select max(inserted_at) from tgt)""")
def q_new_rows_since(spark, d):
    up = merge.merge_upsert(_first_load(spark, d), _second_file(spark, d), KEYS, "id")
    wm = merge.max_inserted_watermark({"ratings": _first_load(spark, d)})
    return wmk.new_rows_since(up, "ratings", wm).select("id", "user_id", "movie_id")


@query("new_rows_no_watermark", W("fx_links") + "select movie_id from fx_links")
def q_new_rows_no_watermark(spark, d):
    """A table without a watermark row: every row counts as new."""
    t = _tables(spark, d)
    return wmk.new_rows_since(t["links"], "links", _watermarks(spark, d)).select("movie_id")


@query("new_row_counts", W("fx_ratings", "fx_movies", "fx_tags", "fx_links", extra=_WM) +
       "select ord, table_name, new_rows from counts")
def q_new_row_counts(spark, d):
    return wmk.new_row_counts(_tables(spark, d), _watermarks(spark, d))


@query("first_changed_table", W("fx_ratings", "fx_movies", "fx_tags", "fx_links", extra=_WM) + """
select (select count(*) from firstt) > 0 as has_new_data, (select table_name from firstt) as table_name""")
def q_first_changed_table(spark, d):
    return wmk.first_changed_table(_tables(spark, d), _watermarks(spark, d))


@query("daily_gate", W("fx_ratings", "fx_movies", "fx_tags", "fx_links", extra=_WM) + """
select 'ingest' as stage, (select count(*) from firstt) > 0 as run
union all select unnest(['validate', 'featurize', 'split', 'train', 'evaluate', 'precompute']), true""")
def q_daily_gate(spark, d):
    return wmk.daily_gate(_tables(spark, d), _watermarks(spark, d))


_STATUS = ("case event_type when 'purchase' then 'success' when 'error' then 'failed' else 'running' end")


@query("trigger_log_update", W("fx_runs", extra=[
    ("log", "select 'trg-' || cast(run_id as varchar) as trigger_id, experiment as trigger_type, 'queued' as status, "
            "start_time as created_at, cast(null as timestamp) as completed_at from fx_runs"),
    ("upd", f"select case when event_type = 'signup' then 'new-' else 'trg-' end || cast(user_id as varchar) "
            f"as trigger_id, {_STATUS} as status, ts as at_ts from events"),
    ("lastu", "select trigger_id, status, at_ts from (select *, row_number() over (partition by trigger_id "
              "order by at_ts desc, status desc) as rn_ from upd) where rn_ = 1")]) + """
select l.trigger_id, l.trigger_type, coalesce(u.status, l.status) as status, l.created_at,
       case when u.status in ('success', 'failed') then u.at_ts else l.completed_at end as completed_at
from log l left join lastu u on l.trigger_id = u.trigger_id""")
def q_trigger_log_update(spark, d):
    runs = fx.fx_runs(spark, d)
    log = runs.select(F.concat(F.lit("trg-"), F.col("run_id").cast("string")).alias("trigger_id"),
                      F.col("experiment").alias("trigger_type"), F.lit("queued").alias("status"),
                      F.col("start_time").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"))
    ev = fx.table(spark, d, "events")
    status = (F.when(F.col("event_type") == "purchase", F.lit("success"))
              .when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit("running")))
    upd = ev.select(F.concat(F.when(F.col("event_type") == "signup", F.lit("new-")).otherwise(F.lit("trg-")),
                             F.col("user_id").cast("string")).alias("trigger_id"),
                    status.alias("status"), F.col("ts").alias("at"))
    return wmk.trigger_log_update(log, upd).select("trigger_id", "trigger_type", "status", "created_at", "completed_at")


# FIXED VALUE: insert stamp of the first streamed delivery; later deliveries add one hour each
STREAM_BASE = datetime(2024, 3, 1)


@query("stream_ingest", W("fx_ratings", extra=[
    ("f1", f"select row_number() over (order by id) - 1 as rid, user_id, movie_id, rating, timestamp "
           f"from fx_ratings where inserted_at < TIMESTAMP '{FIRST_LOAD_BEFORE}'"),
    ("f2", f"select (select count(*) from f1) + row_number() over (order by id) - 1 as rid, user_id, movie_id, rating, timestamp "
           f"from fx_ratings where inserted_at >= TIMESTAMP '{SECOND_FILE_FROM}'"),
    ("t1", "select * from (select *, row_number() over (partition by user_id, movie_id order by rid desc) as rn_ "
           "from f1) where rn_ = 1"),
    ("t2", "select * from (select *, row_number() over (partition by user_id, movie_id order by rid desc) as rn_ "
           "from f2) where rn_ = 1")]) + f"""
select coalesce(t1.rid, t2.rid) as id, user_id, movie_id, case when t2.rid is null then t1.rating else t2.rating end as rating,
       case when t2.rid is null then t1.timestamp else t2.timestamp end as timestamp,
       case when t2.rid is null then TIMESTAMP '{STREAM_BASE:%Y-%m-%d %H:%M:%S}' else TIMESTAMP '{STREAM_BASE:%Y-%m-%d} 01:00:00' end as inserted_at
from t1 full join t2 using (user_id, movie_id)""")
def q_stream_ingest(spark, d):
    """Two deliveries in the download's own layout (no row ids) land one after the other; each availableNow run
    merges what is new."""
    from datetime import timedelta

    from marquee.sources import files as fl
    from marquee.streaming.ingest import current_table, stream_ingest
    base = scratch_path(spark, "stream")
    landing, table, ckpt = f"{base}/landing", f"{base}/table", f"{base}/checkpoint"
    r = fx.fx_ratings(spark, d)
    deliveries = [r.filter(F.col("inserted_at") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")),
                  r.filter(F.col("inserted_at") >= F.lit(SECOND_FILE_FROM).cast("timestamp_ntz"))]
    for n, part in enumerate(deliveries):
        rows = part.repartitionByRange("id").sortWithinPartitions("id")  # file names follow the ids
        fl.write_csv(rows.select(F.col("user_id").alias("userId"), F.col("movie_id").alias("movieId"), "rating", "timestamp"),
                     f"{landing}/delivery={n:04d}")
        q = stream_ingest(spark, f"{landing}/*/", table, ckpt, clock=lambda b: STREAM_BASE + timedelta(hours=b), buckets=8)
        q.awaitTermination()
    return current_table(spark, table).select("id", "user_id", "movie_id", "rating", "timestamp", "inserted_at")


# FIXED VALUES: directory of a new table and rows of a bucket in the growth queries
GROW_FROM, GROW_ROWS = 2, 200


def _grown_table(spark, d):
    """Two deliveries merged into a table whose directory grows with each; the reports of both batches and the table's path."""
    from datetime import timedelta

    from marquee.operators import buckets as bk
    from marquee.sources import files as fl
    base = scratch_path(spark, "buckets")
    path, done = f"{base}/table", []
    r = fx.fx_ratings(spark, d)
    parts = [r.filter(F.col("inserted_at") < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz")),
             r.filter(F.col("inserted_at") >= F.lit(SECOND_FILE_FROM).cast("timestamp_ntz"))]
    for n, part in enumerate(parts):
        rows = part.repartitionByRange("id").sortWithinPartitions("id")
        fl.write_csv(rows.select(F.col("user_id").alias("userId"), F.col("movie_id").alias("movieId"), "rating", "timestamp"), f"{base}/d{n}")
        done.append(bk.merge_rows(spark, fl.read_ratings_csv(spark, f"{base}/d{n}"), KEYS, path, n, stamp=STREAM_BASE + timedelta(hours=n),
                                  table="ratings", buckets=GROW_FROM, bucket_rows=GROW_ROWS))
    return path, done


_GROWN = [
    ("f1", f"select row_number() over (order by id) - 1 as rid, user_id, movie_id from fx_ratings where inserted_at < TIMESTAMP '{FIRST_LOAD_BEFORE}'"),
    ("f2", f"select (select count(*) from f1) + row_number() over (order by id) - 1 as rid, user_id, movie_id from fx_ratings "
           f"where inserted_at >= TIMESTAMP '{SECOND_FILE_FROM}'"),
    ("k1", "select user_id, movie_id, max(rid) as rid from f1 group by all"), ("k2", "select user_id, movie_id, max(rid) as rid from f2 group by all"),
    ("dirs", f"select greatest({GROW_FROM}, cast(ceil((select count(*) from f1) / {GROW_ROWS}.0) as int)) as n1"),
    ("dirs2", f"select n1, greatest(n1, cast(ceil(((select count(*) from k1) + (select count(*) from f2)) / {GROW_ROWS}.0) as int)) as n2 from dirs"),
]


@query("bucket_growth", W("fx_ratings", extra=_GROWN) + f"""
select 0 as batch, n1 as directory, (select count(*) from k1) as rows, (select max(rid) from k1) as max_id,
       TIMESTAMP '{STREAM_BASE:%Y-%m-%d %H:%M:%S}' as last_inserted_at from dirs2
union all select 1, n2, (select count(*) from k1 full join k2 using (user_id, movie_id)),
       (select max(coalesce(k1.rid, k2.rid)) from k1 full join k2 using (user_id, movie_id)), TIMESTAMP '{STREAM_BASE:%Y-%m-%d} 01:00:00' from dirs2""")
def q_bucket_growth(spark, d):
    """The manifests of two batches: the directory after each, and the rows, largest id and watermark that it knows without a scan."""
    from marquee.operators import buckets as bk
    path, _ = _grown_table(spark, d)
    out = None
    for n in range(2):
        m = bk.manifest(spark, path, before=n + 1)
        one = m.agg(F.lit(n).alias("batch"), F.max("directory").alias("directory"), F.sum("rows").alias("rows"), F.max("max_id").alias("max_id"),
                    F.max("max_inserted_at").alias("last_inserted_at"))
        out = one if out is None else out.unionByName(one)
    return out


@query("new_rows_by_manifest", W("fx_ratings", extra=_GROWN) + """
select coalesce(k1.rid, k2.rid) as id, user_id, movie_id from k2 left join k1 using (user_id, movie_id)""")
def q_new_rows_by_manifest(spark, d):
    """Rows after the first batch's watermark, from the files whose insert times reach beyond it."""
    from marquee.operators import buckets as bk
    path, _ = _grown_table(spark, d)
    return bk.rows_since(spark, path, STREAM_BASE).select("id", "user_id", "movie_id")


def _written_tables(spark, d):
    """The watermark scenario's tables as files, with their statistics."""
    base, files = scratch_path(spark, "tables"), None
    for name, df in _tables(spark, d).items():
        df.write.parquet(f"{base}/{name}")
        one = wmk.file_statistics(spark.read.parquet(f"{base}/{name}"), name)
        files = one if files is None else files.unionByName(one)
    files.write.parquet(f"{base}/files")
    return spark.read.schema(wmk.FILES).parquet(f"{base}/files")


@query("new_row_counts_by_files", W("fx_ratings", "fx_movies", "fx_tags", "fx_links", extra=_WM) + """
select table_name, new_rows from counts""")
def q_new_row_counts_by_files(spark, d):
    return wmk.new_row_counts_by_files(spark, _written_tables(spark, d), _watermarks(spark, d))


@query("first_changed_by_files", W("fx_ratings", "fx_movies", "fx_tags", "fx_links", extra=_WM) + """
select (select count(*) from firstt) > 0 as has_new_data, (select table_name from firstt) as table_name""")
def q_first_changed_by_files(spark, d):
    return wmk.first_changed_by_files(_written_tables(spark, d), _watermarks(spark, d))


@query("create_triggers", W("fx_runs", extra=[
    ("log", "select 'trg-' || cast(run_id as varchar) as trigger_id, 'queued' as status, start_time as created_at from fx_runs"),
    ("req", "select case when event_type = 'signup' then 'new-' else 'trg-' end || cast(user_id as varchar) as trigger_id, ts as at_ts, "
            "event_type as requester, case event_type when 'click' then ['all'] when 'view' then null else [event_type, 'mse'] end as losses, "
            "case when user_id % 2 = 0 then ['als'] end as archs from events"),
    ("firstreq", "select trigger_id, arg_min({'a': at_ts, 'r': requester, 'l': losses, 's': archs}, (at_ts, requester)) as f from req "
                 "where trigger_id not in (select trigger_id from log) group by trigger_id")]) + """
select trigger_id, cast(null as varchar) as trigger_type, status, created_at, cast(null as varchar) as losses, cast(null as varchar) as archs,
       cast(null as varchar) as requester from log
union all select trigger_id, 'on_demand', 'pending', f.a, case when f.l <> ['all'] then array_to_string(f.l, ',') end, array_to_string(f.s, ','), f.r
from firstreq""")
def q_create_triggers(spark, d):
    """Requests of events: ids of the log stay as they are, the first request of a new id makes its row."""
    runs = fx.fx_runs(spark, d)
    log = runs.select(F.concat(F.lit("trg-"), F.col("run_id").cast("string")).alias("trigger_id"), F.lit(None).cast("string").alias("trigger_type"),
                      F.lit("queued").alias("status"), F.col("start_time").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"))
    ev, kind = fx.table(spark, d, "events"), F.col("event_type")
    losses = F.when(kind == "click", F.array(F.lit("all"))).when(kind != "view", F.array(kind, F.lit("mse")))
    req = ev.select(F.concat(F.when(kind == "signup", F.lit("new-")).otherwise(F.lit("trg-")), F.col("user_id").cast("string")).alias("trigger_id"),
                    losses.alias("losses"), F.when(F.col("user_id") % 2 == 0, F.array(F.lit("als"))).alias("architectures"),
                    kind.alias("requester"), F.col("ts").alias("at"))
    out = wmk.create_triggers(log, req)
    return out.select("trigger_id", "trigger_type", "status", "created_at", F.array_join("requested_losses", ",").alias("losses"),
                      F.array_join("requested_architectures", ",").alias("archs"), "requester")

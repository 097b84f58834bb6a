"""DuckDB text of the fixture views, inlined into every oracle as a WITH clause.

The driver's oracle has only the raw tables registered, so each oracle carries what it needs.
"""
from __future__ import annotations

from marquee.functions.vocab import vocab_duckdb

VOCAB = vocab_duckdb()

# (name, dependencies, body)
_VIEWS: list[tuple[str, tuple[str, ...], str]] = [
    ("fx_ratings", (), """
select event_id as id, cast(user_id as int) as user_id,
       cast(json_extract_string(props, '$.k') as int) as movie_id,
       0.5e0 * (1 + cast(floor(value) as bigint) % 10) as rating,
       cast(floor(epoch(ts)) as bigint) as timestamp, ts as inserted_at
from events"""),
    ("fx_movies", (), f"""
select cast(p_partkey as int) as movie_id,
       concat(p_name, ' (', cast(1950 + p_size as varchar), ')') as title,
       case when p_partkey % 20 = 19 then '(no genres listed)'
            when p_partkey % 19 = p_size % 19 then list_extract({VOCAB}, cast(p_partkey % 19 as int) + 1)
            else concat(list_extract({VOCAB}, cast(p_partkey % 19 as int) + 1), '|',
                        list_extract({VOCAB}, cast(p_size % 19 as int) + 1)) end as genres
from part"""),
    ("fx_movies_gaps", ("fx_movies",), "select * from fx_movies where movie_id % 10 <> 7"),
    ("fx_dirty_ratings", ("fx_ratings",), """
select r.id, case when event_type <> 'error' then r.user_id end as user_id,
       case when event_type <> 'signup' then r.movie_id end as movie_id,
       case when event_type = 'purchase' then rating + 3.0e0 else rating end as rating, timestamp, inserted_at
from fx_ratings r join events e on e.event_id = r.id"""),
    ("fx_dirty_movies", ("fx_movies",), """
select movie_id, case when genres <> '(no genres listed)' then title end as title, genres from fx_movies"""),
    ("fx_tags", (), """
select cast(doc_id % 150 as int) as user_id, cast(doc_id as int) as movie_id, text as tag, doc_id as timestamp
from documents"""),
    ("fx_links", (), """
select cast(p_partkey as int) as movie_id, lpad(cast(p_partkey as varchar), 7, '0') as imdb_id,
       case when p_partkey % 3 = 0 then null else cast(p_partkey * 7 as varchar) end as tmdb_id from part"""),
    ("fx_dirty_links", ("fx_links",), "select movie_id, imdb_id, coalesce(tmdb_id, 'nan') as tmdb_id from fx_links"),
    ("fx_vec", (), """
select vec_id, label, list_transform(embedding, lambda x: x::double * (1.0e0 + vec_id % 5)) as v from embeddings"""),
    ("fx_pairs", ("fx_vec",), """
select u.vec_id // 2 as k, (u.vec_id // 2) // 16 as batch_id, u.v as uv, i.v as iv,
       0.5e0 + (i.vec_id % 7) / 14.0e0 as weight, 0.5e0 * (1 + (u.vec_id // 2) % 10) as rating
from fx_vec u join fx_vec i on i.vec_id = u.vec_id + 1 where u.vec_id % 2 = 0"""),
    ("fx_metrics", (), """
select user_id as run_id, event_type as metric, event_id as step, value, user_id % 2 as arch from events"""),
    ("fx_runs", (), """
select user_id as run_id, min(ts) as start_time, arg_min(event_type, (ts, event_id)) as experiment,
       case when user_id % 2 = 0 then 'TwoTower' else 'InfoNCEEncoder' end as architecture,
       case when count(*) % 3 = 0 then 'self' when count(*) % 3 = 1 then 'cross' else 'none' end as distillation_type,
       case when count(*) % 2 = 0 then 'sweep_trial' else '' end as sweep
from events group by user_id"""),
    # raw.ratings after ingest: one row per (user, movie), the last arrival wins
    ("rk", ("fx_ratings",), """
select id, user_id, movie_id, rating, timestamp, inserted_at from (
  select *, row_number() over (partition by user_id, movie_id order by id desc) as rn_
  from fx_ratings where user_id is not null and movie_id is not null) where rn_ = 1"""),
    ("bounds", ("rk",), """
select min(timestamp) as t_min, max(timestamp) as t_max, greatest(max(timestamp) - min(timestamp), 1) as t_range
from rk"""),
    ("wrk", ("rk", "bounds"), """
select rk.*, exp(-0.1e0 * (1.0e0 - (rk.timestamp - (b.t_max - b.t_range)) / cast(b.t_range as double))) as weight
from rk, bounds b"""),
    ("mg", ("fx_movies",), """
select movie_id, unnest(string_split(genres, '|')) as genre from fx_movies"""),
    ("mem", ("mg",), f"""
select distinct movie_id, genre from mg where list_contains({VOCAB}, genre)"""),
    ("uvec", ("fx_vec",), """
select cast(vec_id // 2 as int) as user_id, v as u from fx_vec where vec_id % 2 = 0"""),
    ("ivec", ("fx_vec",), f"""
select cast(vec_id // 2 as int) as movie_id, list_extract({VOCAB}, label + 1) as genre, v as i
from fx_vec where vec_id % 2 = 1"""),
]

_BY_NAME = {n: (deps, body) for n, deps, body in _VIEWS}


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """A WITH clause holding the named views and their dependencies, in definition order,
    followed by any extra (name, body) CTEs."""
    need: set[str] = set()

    def add(n):
        if n in need:
            return
        for d in _BY_NAME[n][0]:
            add(d)
        need.add(n)

    for n in names:
        add(n)
    parts = [f"{n} as ({body}\n)" for n, _, body in _VIEWS if n in need]
    parts += [f"{n} as ({body}\n)" for n, body in (extra or [])]
    return "with " + ",\n".join(parts) + "\n" if parts else ""

"""DuckDB SQL oracles, one per query in ``recspark.plans.queries``.

The driver registers only the raw tables, so every statement inlines the
views it needs as CTEs.  Time expressions avoid the session zone; rounded
values use floor(x*1e6 + 0.5)/1e6, the same text as the Spark side.
"""

from __future__ import annotations

from recspark.schema import DEFAULT_GENRES

V_RATINGS = """v_ratings as (
  select cast(o_custkey as int) uid, cast(l_partkey as int) mid,
         cast(ceil(l_quantity/5) as double)/2 score,
         cast(floor(epoch(l_shipdate)) as int) ts
  from lineitem join orders on l_orderkey = o_orderkey)"""

V_MOVIES = """v_movies as (
  select cast(p_partkey as int) mid, p_name name,
         concat_ws('|', p_type, split_part(p_name,' ',1), split_part(p_name,' ',2)) genres
  from part)"""

V_TAGS = """v_tags as (
  select cast(user_id as int) uid, cast(json_extract_string(props,'$.k') as int) mid,
         event_type tag, cast(floor(epoch(ts)) as int) ts
  from events)"""

V_STREAM = """v_stream as (
  select event_id, cast(user_id as int) uid,
         cast(json_extract_string(props,'$.k') as int) mid,
         least(5.0::double, greatest(0.5::double, cast(ceil(value/10) as double)/2)) score,
         cast(floor(epoch(ts)) as int) ts
  from events)"""


def sims_cte(floor: float = 0.1, k: int = 20, name: str = "v_sims") -> str:
    """Top-k cosine neighbours of every embedding above ``floor``."""
    return f"""{name} as (
  select mid, sim_mid, score, rk from (
    select *, row_number() over (partition by mid order by score desc, sim_mid) rk
    from (select cast(a.vec_id as int) mid, cast(b.vec_id as int) sim_mid,
                 floor(1000000*list_cosine_similarity(a.embedding::double[], b.embedding::double[])
                       + 0.5::double)/1000000 score
          from embeddings a join embeddings b on a.vec_id <> b.vec_id)
    where score > {floor}::double) where rk <= {k})"""


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


#: (item damping, user damping) of the closed-form predictor's grid.
DAMPINGS = [(a, b) for a in (1.0, 5.0, 10.0, 25.0, 100.0) for b in (1.0, 5.0, 10.0, 25.0, 100.0)]

GENRE_TEST_LIST = ["Large", "Small", "Red", "Ring", "Foreign", "Rod"]


def _genre_values(genres) -> str:
    return ", ".join(f"('{g}')" for g in genres)


ORACLES: dict[str, str] = {}

ORACLES["item_popularity"] = with_(V_RATINGS) + """
select mid, count(mid) as "count" from v_ratings group by mid"""

ORACLES["item_popularity_by_month"] = with_(V_RATINGS) + """
select mid, count(mid) as "count",
       cast(strftime(to_timestamp(ts) at time zone 'UTC', '%Y%m') as int) yearmonth
from v_ratings group by 1, 3"""

ORACLES["item_average"] = with_(V_RATINGS) + """
select mid, avg(score) as "avg" from v_ratings group by mid"""

ORACLES["genre_top_n"] = with_(V_RATINGS, V_MOVIES) + f"""
select genre, rk, mid, "avg" from (
  select genre, m.mid, a."avg",
         row_number() over (partition by genre order by a."avg" desc, m.mid) rk
  from (values {_genre_values(GENRE_TEST_LIST)}) g(genre)
  join v_movies m on contains(lower(genres), lower(genre))
  join (select mid, avg(score) as "avg" from v_ratings group by mid) a on a.mid = m.mid)
where rk <= 10"""

ORACLES["genre_top_n_token"] = with_(V_RATINGS, V_MOVIES) + f"""
select genre, rk, mid, "avg" from (
  select genre, m.mid, a."avg",
         row_number() over (partition by genre order by a."avg" desc, m.mid) rk
  from (values {_genre_values(GENRE_TEST_LIST)}) g(genre)
  join v_movies m on list_contains(string_split(lower(genres), '|'), lower(genre))
  join (select mid, avg(score) as "avg" from v_ratings group by mid) a on a.mid = m.mid)
where rk <= 10"""

ORACLES["items_with_tags"] = with_(V_MOVIES, V_TAGS) + """
select m.mid, m.name, m.genres, t.tags from v_movies m left join
  (select mid, array_to_string(list_sort(list(distinct tag)), '|') tags
   from v_tags where tag is not null group by mid) t
  on m.mid = t.mid"""

ORACLES["dataset_summary"] = with_(V_RATINGS) + """
select count(*) n_ratings, count(distinct uid) n_users, count(distinct mid) n_items
from v_ratings"""

ORACLES["vector_similar_items"] = with_(sims_cte(0.1, 20)) + """
select mid, sim_mid, score, rk from v_sims"""

ORACLES["similarity_long_form"] = ORACLES["vector_similar_items"]

ORACLES["content_similar_items"] = with_(V_MOVIES).rstrip() + """,
g as (select distinct lower(genres) genres from v_movies),
tok as (select genres, unnest(string_split(genres,'|')) tok from g),
m as (select count(*) m from v_movies),
x as (select genres, tok, count(*) tf from tok group by 1,2),
df as (select tok, count(distinct mid) df from v_movies join x on lower(v_movies.genres) = x.genres group by 1),
w as (select x.genres, x.tok, tf*ln((m.m+1.0)/(df.df+1.0)) w from x join df on x.tok = df.tok cross join m),
n as (select genres, sqrt(sum(w*w)) nrm from w group by 1),
p as (select a.genres ga, b.genres gb, sum(a.w*b.w) dp from w a join w b on a.tok = b.tok group by 1,2),
sim as (select ga, gb, floor(1000000*(dp/(na.nrm*nb.nrm)) + 0.5::double)/1000000 score
        from p join n na on na.genres = ga join n nb on nb.genres = gb where na.nrm > 0 and nb.nrm > 0),
r as (select a.mid, b.mid sim_mid, score,
             row_number() over (partition by a.mid order by score desc, b.mid) rk
      from sim join v_movies a on lower(a.genres) = ga join v_movies b on lower(b.genres) = gb
      where a.mid <> b.mid and score > 0.6::double)
select mid, sim_mid, score, rk from r where rk <= 20"""

ORACLES["hash_split"] = with_(V_STREAM) + """
select event_id, uid, mid, b % 10 as bucket,
       case when b / 268435456.0 < 0.8 then 'train'
            when b / 268435456.0 < 0.9 then 'validation' else 'test' end as split
from (select *, cast('0x'||substr(md5(cast(event_id as varchar)),1,7) as bigint) b
      from v_stream)"""

ORACLES["kfold_split"] = with_(V_STREAM) + """
select event_id, uid, mid,
       cast(floor((row_number() over (order by event_id) - 1)
                  / (select ceil(count(*) / 5.0) from v_stream)) as int) fold
from v_stream"""

ORACLES["leave_n_out_split"] = with_(V_STREAM) + """
select event_id, uid, mid, case when rn between 1 and 10 then 'test' else 'base' end split
from (select *, row_number() over (partition by uid order by event_id) rn from v_stream)"""

ORACLES["leave_n_out_capped"] = with_(V_STREAM) + """
select event_id, uid, mid,
       case when hit and row_number() over (partition by hit order by event_id) <= 1000
            then 'test' else 'base' end split
from (select *, (rn between 11 and 20) hit
      from (select *, row_number() over (partition by uid order by event_id) rn from v_stream))"""

ORACLES["rmse_item_mean"] = with_(V_RATINGS) + """
select floor(1000000*sqrt(sum((r.score-a.p)*(r.score-a.p))/count(*)) + 0.5::double)/1000000 rmse,
       floor(1000000*sqrt(sum((r.score-a.p)*(r.score-a.p))/count(a.p)) + 0.5::double)/1000000 rmse_joined,
       count(*) n_test, count(*) - count(a.p) n_missing
from v_ratings r left join (select mid, avg(score) p from v_ratings group by mid) a on a.mid = r.mid"""

ORACLES["rmse_item_mean_split"] = with_(V_RATINGS).rstrip() + """,
s as (select *, case when cast('0x'||substr(md5(concat_ws('|', cast(uid as varchar),
          cast(mid as varchar), cast(ts as varchar))),1,7) as bigint) / 268435456.0 < 0.8
          then 'train' else 'test' end split from v_ratings),
a as (select mid, avg(score) p from s where split = 'train' group by mid)
select floor(1000000*sqrt(sum((r.score-a.p)*(r.score-a.p))/count(*)) + 0.5::double)/1000000 rmse,
       floor(1000000*sqrt(sum((r.score-a.p)*(r.score-a.p))/count(a.p)) + 0.5::double)/1000000 rmse_joined,
       count(*) n_test, count(*) - count(a.p) n_missing
from s r left join a on a.mid = r.mid where r.split = 'test'"""

ORACLES["rmse_item_mean_price"] = """
with a as (select l_partkey, avg(l_extendedprice::double) p from lineitem group by l_partkey)
select floor(1000*sqrt(avg((l.l_extendedprice::double - a.p)*(l.l_extendedprice::double - a.p)))
             + 0.5::double)/1000 rmse,
       floor(1000*sqrt(avg((l.l_extendedprice::double - a.p)*(l.l_extendedprice::double - a.p)))
             + 0.5::double)/1000 rmse_joined,
       count(*) n_test, 0::bigint n_missing
from lineitem l join a on a.l_partkey = l.l_partkey"""

ORACLES["recent_ratings"] = with_(V_STREAM) + """
select uid, rn, event_id, mid, score, ts from (
  select *, row_number() over (partition by uid order by ts desc, event_id desc) rn
  from v_stream) where rn <= 20"""

ORACLES["stream_candidates"] = with_(V_STREAM, V_RATINGS, sims_cte(0.1, 20)) + """
select event_id, uid, rk, mid, sim from (
  select l.event_id, l.uid, m.sim_mid mid, m.score sim,
         row_number() over (partition by l.event_id order by m.score desc, m.sim_mid) rk
  from v_stream l join v_sims m on m.mid = l.mid
  where not exists (select 1 from v_ratings s where s.uid = l.uid and s.mid = m.sim_mid))
where rk <= 20"""

STREAM_RECS_SQL = with_(V_STREAM, V_RATINGS, sims_cte(0.1, 20)).rstrip() + """,
o as (select *, row_number() over (partition by uid order by ts desc, event_id desc) rn from v_stream),
cand as (select uid, mid from (
    select l.uid, m.sim_mid mid, row_number() over (partition by l.uid order by m.score desc, m.sim_mid) rk
    from o l join v_sims m on m.mid = l.mid
    left join (select distinct uid, mid from v_ratings) s on s.uid = l.uid and s.mid = m.sim_mid
    where l.rn = 1 and s.mid is null) where rk <= 20),
j as (select c.uid, c.mid, cast(floor(m.score*1000000 + 0.5::double) as bigint)*cast(r.score*2 as bigint) x,
             case when r.score > 3 then 1 else 0 end up
      from cand c join o r on r.uid = c.uid and r.rn <= 20
      join v_sims m on m.mid = c.mid and m.sim_mid = r.mid where m.score > 0.2::double)
select uid, mid, floor(1000000*(cast(sum(x) as double)/2000000/count(*)
       + log10(greatest(sum(up), 1)) - log10(greatest(sum(1-up), 1))) + 0.5::double)/1000000 score
from j group by uid, mid"""

ORACLES["stream_recs_batch"] = STREAM_RECS_SQL
ORACLES["stream_recs"] = STREAM_RECS_SQL
ORACLES["stream_recs_2s"] = STREAM_RECS_SQL

ORACLES["parse_movie_text"] = with_(V_MOVIES) + "select mid, name, genres, " + ", ".join(
    f"'{f} of ' || mid as {f}" for f in ("descri", "timelong", "issue", "shoot", "language",
                                         "actors", "directors")) + " from v_movies"
ORACLES["parse_ratings_csv"] = with_(V_RATINGS) + "select uid, mid, score, ts from v_ratings"
ORACLES["parse_tags_csv"] = with_(V_TAGS) + "select uid, mid, tag, ts from v_tags"
ORACLES["parse_tab_ratings"] = with_(V_RATINGS) + "select uid, mid, score from v_ratings"
ORACLES["parse_item_titles"] = with_(V_MOVIES) + "select mid, name from v_movies"
ORACLES["parse_rating_messages"] = with_(V_STREAM) + "select uid, mid, score, ts from v_stream"
ORACLES["sink_overwrite"] = ORACLES["item_popularity"]
ORACLES["sink_keyed_docs"] = ORACLES["items_with_tags"]
ORACLES["sink_upsert"] = STREAM_RECS_SQL

ORACLES["parse_recent_lists"] = with_(V_STREAM) + """
select uid, rn, mid, score from (
  select *, row_number() over (partition by uid order by ts desc, event_id desc) rn
  from v_stream) where rn <= 20"""

ORACLES["seen_filter"] = with_(V_STREAM, V_RATINGS) + """
select event_id, uid, mid from v_stream l
where not exists (select 1 from v_ratings r where r.uid = l.uid and r.mid = l.mid)"""

ORACLES["split_summary"] = with_(V_RATINGS) + """
select split, count(*) n_ratings, count(distinct uid) n_users, count(distinct mid) n_items
from (select *, case when h < 0.8 then 'train' when h < 0.9 then 'validation' else 'test' end split
      from (select *, cast('0x'||substr(md5(concat_ws('|', cast(uid as varchar), cast(mid as varchar),
                 cast(ts as varchar))),1,7) as bigint) / 268435456.0 h from v_ratings))
group by split"""

# Groups of items with the same terms; a group is named by its smallest item id.
V_GROUPS = """gm as (
  select mid, array_to_string(list_sort(list_filter(
           string_split(lower(replace(genres, '|', ' ')), ' '), lambda t: t <> '')), '|') gkey
  from v_movies),
g as (select gkey, min(mid) gid, count(*) gn from gm where gkey <> '' group by 1)"""


def _group_pairs(term: str) -> str:
    """Cosines of all pairs of groups over a term expression of ``tok``."""
    return f"""
tok as (select gid, gn, {term} t from (select gid, gn, unnest(string_split(gkey, '|')) tok from g) s
        {{join}}),
m as (select count(*) m from v_movies),
x as (select gid, gn, t, count(*) tf from tok group by 1, 2, 3),
df as (select t, sum(gn) df from x group by 1),
w as (select x.gid, x.t, tf*ln((m.m+1.0)/(df.df+1.0)) w from x join df on x.t = df.t cross join m),
n as (select gid, sqrt(sum(w*w)) nrm from w group by 1),
p as (select a.gid ga, b.gid gb, sum(a.w*b.w) dp from w a join w b on a.t = b.t group by 1, 2),
sim as (select ga, gb, floor(1000000*(dp/(na.nrm*nb.nrm)) + 0.5::double)/1000000 score
        from p join n na on na.gid = ga join n nb on nb.gid = gb where na.nrm > 0 and nb.nrm > 0)"""


_EXACT = _group_pairs("tok").replace("{join}", "")

ORACLES["content_similar_items_all"] = (with_(V_MOVIES).rstrip() + ",\n" + V_GROUPS + ","
    + _EXACT + "\nselect ga, gb, score from sim where score > 0.6::double")

# The bucket (of 50) that Spark ML's HashingTF gives each term of the
# part table's genre strings.
TERM_BUCKETS = {
    "standard": 17, "medium": 42, "promo": 49, "large": 22, "small": 22, "economy": 17,
    "new": 35, "red": 2, "hot": 43, "cold": 20, "blue": 18, "old": 33, "gear": 45, "anvil": 44,
    "gizmo": 42, "ring": 46, "widget": 19, "plate": 25, "bolt": 40, "rod": 32,
}
_HASHED = _group_pairs("bucket").replace("{join}", "join (values " + ", ".join(
    f"('{t}', {b})" for t, b in TERM_BUCKETS.items()) + ") hb(term, bucket) on hb.term = s.tok")

ORACLES["content_similar_items_hashed"] = (with_(V_MOVIES).rstrip() + ",\n" + V_GROUPS + ","
    + _HASHED + """,
mg as (select mid, gid from gm join g using (gkey)),
r as (select a.mid, b.mid sim_mid, score,
             row_number() over (partition by a.mid order by score desc, b.mid) rk
      from sim join mg a on a.gid = ga join mg b on b.gid = gb
      where a.mid <> b.mid and score > 0.6::double)
select mid, sim_mid, score, rk from r where rk <= 20""")

ORACLES["content_group_members"] = (with_(V_MOVIES).rstrip() + ",\n" + V_GROUPS
    + "\nselect mid, gid as ga from gm join g using (gkey)")

ORACLES["item_popularity_ordered"] = with_(V_RATINGS) + """
select row_number() over (order by c desc, mid) as pos, mid, c as "count"
from (select mid, count(mid) c from v_ratings group by mid)"""

ORACLES["item_popularity_by_month_ordered"] = f"""
select *, row_number() over (partition by yearmonth order by "count" desc, mid) as pos
from ({ORACLES["item_popularity_by_month"]})"""

ORACLES["genre_top_n_defaults"] = with_(V_RATINGS) + f"""
select genre, rk, mid, "avg" from (
  select genre, m.mid, a."avg",
         row_number() over (partition by genre order by a."avg" desc, m.mid) rk
  from (values {_genre_values(DEFAULT_GENRES)}) g(genre)
  join (select cast(p_partkey as int) mid,
               concat_ws('|', gs[p_partkey % 20 + 1], gs[p_partkey * 7 % 20 + 1]) genres
        from part, (select [{", ".join(f"'{g}'" for g in DEFAULT_GENRES)}] gs)) m
    on contains(lower(genres), lower(genre))
  join (select mid, avg(score) as "avg" from v_ratings group by mid) a on a.mid = m.mid)
where rk <= 10"""

ORACLES["kfold_fold_sets"] = f"""
select event_id, uid, mid, part, row_number() over (partition by part, uid order by mid, event_id) pos
from (select *, case when fold = 2 then 'test' else 'base' end part
      from ({ORACLES["kfold_split"]}))"""

ORACLES["last_rating_wins"] = with_(V_STREAM) + """
select event_id, uid, mid, score, ts from (
  select *, row_number() over (partition by uid, mid order by ts desc, event_id desc) r
  from v_stream) where r = 1"""

ORACLES["rmse_joined_predictions"] = with_(V_RATINGS).rstrip() + """,
a as (select mid, avg(score) p from v_ratings group by mid),
j as (select r.score, a.p from v_ratings q join a on a.mid = q.mid
      join v_ratings r on r.uid = q.uid and r.mid = q.mid)
select floor(1000000*sqrt(sum((score-p)*(score-p))/count(*)) + 0.5::double)/1000000 rmse,
       floor(1000000*sqrt(sum((score-p)*(score-p))/count(p)) + 0.5::double)/1000000 rmse_joined,
       count(*) n_test, count(*) - count(p) n_missing from j"""


def _damped(train: str, test: str) -> str:
    """RMSE of every setting on a part, as ``d_<part>``; needs CTE s (split)."""
    values = ", ".join(f"({a}::double, {b}::double)" for a, b in DAMPINGS)
    return f"""
mu as (select avg(score) m from s where split = '{train}'),
di as (select mid, sum(score - m) si, count(*)::double ni from s cross join mu
       where split = '{train}' group by mid),
du as (select uid, sum(score - m) su, count(*)::double nu from s cross join mu
       where split = '{train}' group by uid),
o(a, b) as (values {values}),
d_{test} as (
  select a, b, sqrt(avg(power(score - (m + coalesce(si, 0)/(coalesce(ni, 0) + a)
                                         + coalesce(su, 0)/(coalesce(nu, 0) + b)), 2))) rmse,
         count(*) n
  from s cross join mu cross join o left join di on di.mid = s.mid left join du on du.uid = s.uid
  where split = '{test}' group by a, b)"""


def _split_cte(*bounds: tuple[str, float | None]) -> str:
    cases = " ".join(f"when h < {b} then '{n}'" for n, b in bounds[:-1])
    return f"""s as (select *, case {cases} else '{bounds[-1][0]}' end split from (
  select *, cast('0x'||substr(md5(concat_ws('|', cast(uid as varchar), cast(mid as varchar),
         cast(ts as varchar))),1,7) as bigint) / 268435456.0 h from v_ratings))"""


_S3 = _split_cte(("train", 0.8), ("validation", 0.9), ("test", None))
_S2 = _split_cte(("train", 0.8), ("test", None))
_R6 = "floor(1000000*({}) + 0.5::double)/1000000"

ORACLES["damped_sweep"] = (with_(V_RATINGS).rstrip() + ",\n" + _S3 + ","
    + _damped("train", "validation")
    + f"\nselect a item_damping, b user_damping, {_R6.format('rmse')} rmse, n from d_validation")


def _best(chosen: str, scored: str) -> str:
    return f"""
best as (select * from d_{chosen} order by round(rmse, 9), a, b limit 1)
select best.a item_damping, best.b user_damping, {_R6.format('best.rmse')} valid_rmse,
       {_R6.format('t.rmse')} rmse, t.n from best join d_{scored} t on t.a = best.a and t.b = best.b"""


_TEST = _damped("train", "test")
ORACLES["damped_grid_best"] = (with_(V_RATINGS).rstrip() + ",\n" + _S3 + ","
    + _damped("train", "validation") + "," + _TEST[_TEST.index("d_test as"):] + ","
    + _best("validation", "test"))
ORACLES["damped_two_way"] = (with_(V_RATINGS).rstrip() + ",\n" + _S2 + "," + _TEST + ","
    + _best("test", "test"))

ORACLES["stream_recs_ordered"] = f"""
select *, row_number() over (partition by uid order by score desc, mid) rk
from ({STREAM_RECS_SQL})"""
ORACLES["stream_recs_messages"] = STREAM_RECS_SQL
ORACLES["stream_quarantine"] = with_(V_STREAM) + """
select concat_ws('|', uid, 'no item', score, ts, event_id) line, 'bad number' reason
from v_stream where event_id % 7 = 0"""

ORACLES["als_input"] = with_(V_RATINGS) + "select uid, mid, score from v_ratings"


def _best_products(k: int, where: str = "true") -> str:
    return f"""(
  select a, b, floor(1000000*s + 0.5::double)/1000000 score, rk from (
    select a, b, s, row_number() over (partition by a order by s desc, b) rk from (
      select x.vec_id::int a, y.vec_id::int b,
             list_dot_product(x.embedding::double[], y.embedding::double[]) s
      from embeddings x cross join embeddings y where {where})) where rk <= {k})"""


ORACLES["factor_user_recs"] = f"""
select a uid, rk, b mid, score from {_best_products(20)} where score > 0"""
ORACLES["factor_recs_for_users"] = with_(V_STREAM, V_MOVIES) + f"""
select a uid, rk, b mid, score, name
from {_best_products(10, "x.vec_id in (select uid from v_stream)")} left join v_movies on mid = b"""
ORACLES["factor_recs_for_items"] = with_(V_TAGS, V_MOVIES) + f"""
select a mid, rk, b uid, score, name
from {_best_products(10, "x.vec_id in (select mid from v_tags)")} left join v_movies on mid = a"""
ORACLES["factor_predictions"] = with_(V_STREAM) + """
select event_id, uid, mid, floor(1000000*list_dot_product(x.embedding::double[], y.embedding::double[])
       + 0.5::double)/1000000 prediction
from v_stream left join embeddings x on x.vec_id = uid left join embeddings y on y.vec_id = mid"""

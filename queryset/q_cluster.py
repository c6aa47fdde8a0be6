"""K-Means, DBSCAN, Gower distance and lateral movement by clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.catalog import query
from queryset.q_stats import _CAL, AUTH_NAMES, FLAGS, _profile_sql
from queryset.q_tables import connections, observations, users
from sparkhunt.names import c
from sparkhunt.operators import aggregates as agg
from sparkhunt.operators import dbscan as db
from sparkhunt.operators import filters as fl
from sparkhunt.operators import joins as jn
from sparkhunt.operators import kmeans as km
from sparkhunt.plans import clustering, lateral_movement as lm

# -- K-Means --------------------------------------------------------------------------------

_LINE = "select l_orderkey * 10 + l_linenumber as id, l_quantity as a, l_extendedprice / 2000 as b, l_discount * 100 as c from lineitem"
_COLS = ["a", "b", "c"]
_CENTROIDS = f"select cast(c % 8 as int) as cluster, avg(a) as a, avg(b) as b, avg(c) as c from ({_LINE}) group by c % 8"
_SQL_CENTROIDS = "select cast(k as int) as cluster, a, b, c from (select cast(c as bigint) % 8 as k, avg(a) as a, avg(b) as b, avg(c) as c from ln group by 1)"
_ASSIGN = f"""with ln as ({_LINE}), cen as ({_SQL_CENTROIDS}),
asg as (select ln.*, (select arg_min(cluster, struct_pack(d := (ln.a - cen.a) ** 2 + (ln.b - cen.b) ** 2 + (ln.c - cen.c) ** 2, i := cluster)) from cen) as cluster from ln)
"""


def _lines(t):
    return t.sql(_LINE)


def _centroids(t):
    start = _lines(t).groupBy((F.col("c").cast("bigint") % 8).cast("int").alias("cluster"))
    return start.agg(*[F.avg(n).alias(n) for n in _COLS])


def _moved(n: int) -> str:
    """SQL of the assignments after the centroids moved ``n`` times."""
    out = _ASSIGN.rstrip()
    for i in range(n):
        before = f"asg{i}" if i else "asg"
        out += f""",
cen{i + 1} as (select cluster, avg(a) as a, avg(b) as b, avg(c) as c from {before} group by cluster),
asg{i + 1} as (select ln.*, (select arg_min(cluster, struct_pack(d := (ln.a - z.a) ** 2 + (ln.b - z.b) ** 2 + (ln.c - z.c) ** 2, i := cluster)) from cen{i + 1} z) as cluster from ln)"""
    return out + f" select id, cluster from asg{n}"


@query("kmeans_cluster", _moved(2))
def _(t):
    return km.kmeans_cluster(_lines(t), _COLS, start=_centroids(t), rounds=2).select("id", "cluster")


@query("kmeans_cluster_fit")
def _(t):
    return km.kmeans_cluster(_lines(t), _COLS, 8, 0)


@query("kmeans_assign", _ASSIGN + "select id, cluster from asg")
def _(t):
    return km.kmeans_assign(_lines(t), _COLS, _centroids(t)).select("id", "cluster")


@query("kmeans_update", _ASSIGN + "select cluster, round(avg(a), 6) as a, round(avg(b), 6) as b, round(avg(c), 6) as c from asg group by cluster")
def _(t):
    assigned = km.kmeans_assign(_lines(t), _COLS, _centroids(t))
    return km.kmeans_update(assigned, _COLS).select("cluster", *[F.round(n, 6).alias(n) for n in _COLS])


@query("cluster_auto_kmeans")
def _(t):
    return clustering.cluster_auto(_lines(t).drop("id"), method="kmeans", k=4)


# -- DBSCAN -----------------------------------------------------------------------------------

_COMPONENTS = """
core as (select id from nb where n >= 5),
edge as (select a, b from pair where a in (select id from core) and b in (select id from core)),
walk(i, id, label) as (
  select 0, id, id from core
  union all
  select i + 1, id, min(label) from (
    select w.i, e.b as id, w.label from walk w join edge e on e.a = w.id where w.i < {rounds}
    union all select i, id, label from walk where i < {rounds}) s group by i, id),
comp as (select id, label from walk where i = {rounds}),
num as (select label, cast(dense_rank() over (order by label) - 1 as int) as cluster from (select distinct label from comp)),
lab as (select id, cluster from comp join num using (label)
  union all
  select p.a, min(cluster) from pair p join comp on comp.id = p.b join num using (label) where p.a not in (select id from core) group by p.a)
"""
_EPS = 1.2
_PAIRS = f"""
pt as (select c_custkey as id, x, y from v_points),
pair as (select p.id as a, q.id as b from pt p, pt q where (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= {_EPS} * {_EPS}),
nb as (select a as id, count(*) as n from pair group by a)
"""


@query("eps_neighbor_join", "with " + _PAIRS + "select id as c_custkey, n as n_neighbors, n >= 5 as is_core from nb")
def _(t):
    out = db.eps_neighbor_join(t("v_points"), ["x", "y"], _EPS, "c_custkey", 5)
    return out.select("c_custkey", "n_neighbors", "is_core")


_DB = "with recursive " + _PAIRS + "," + _COMPONENTS.format(rounds=60)


@query("dbscan_numeric", _DB + "select pt.id as c_custkey, coalesce(cluster, -1) as cluster from pt left join lab using (id)")
def _(t):
    return db.dbscan_numeric(t("v_points"), ["x", "y"], _EPS, 5, "c_custkey").select("c_custkey", "cluster")


@query("cluster_auto", _DB + "select pt.id as c_custkey, coalesce(cluster, -1) as cluster from pt left join lab using (id)")
def _(t):
    out = clustering.cluster_auto(t("v_points"), ["x", "y"], method="dbscan", key="c_custkey", eps=_EPS, min_samples=5)
    return out.select("c_custkey", "cluster")


@query(
    "cluster_numbering",
    "with n as (select o_custkey, min(o_orderkey) as first_core from orders group by o_custkey) select o_custkey, first_core, cast(row_number() over (order by first_core) - 1 as int) as cluster from n",
)
def _(t):
    groups = t("orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_core"))
    return db.cluster_numbering(groups)


# -- mixed columns -------------------------------------------------------------------------------

_MIX = ["p_brand", "p_type", "p_size", "p_retailprice"]
_RANGE = """
rg as (select min(p_size) as s0, max(p_size) - min(p_size) as sr, min(p_retailprice) as r0, max(p_retailprice) - min(p_retailprice) as rr from part),
pt as (select p_partkey as id, p_brand, p_type, (p_size - s0) / cast(sr as double) as s, (p_retailprice - r0) / rr as r from part, rg)
"""
_DIST = "(cast(p.p_brand <> q.p_brand as int) + cast(p.p_type <> q.p_type as int) + abs(p.s - q.s) + abs(p.r - q.r)) / 4"
_BOUGHT = "select distinct l_partkey as i, l_suppkey as j from lineitem"


@query(
    "gower_distance",
    f"with {_RANGE}, b as ({_BOUGHT}) select i, j, round({_DIST}, 6) as distance from b join pt p on p.id = b.i join pt q on q.id = b.j",
)
def _(t):
    out = db.gower_distance(t("part"), t.sql(_BOUGHT), _MIX, "p_partkey")
    return out.select("i", "j", F.round("distance", 6).alias("distance"))


_GPAIR = f"""{_RANGE},
pair as (select p.id as a, q.id as b from pt p, pt q where {_DIST} * 4 <= 1.12),
nb as (select a as id, count(*) as n from pair group by a)
"""


@query("gower_pair_join", "with " + _GPAIR + "select id as p_partkey, n as n_neighbors, n >= 5 as is_core from nb")
def _(t):
    out = db.gower_pair_join(t("part"), _MIX, 0.28, "p_partkey", 5)
    return out.select("p_partkey", "n_neighbors", "is_core")


@query(
    "dbscan_mixed",
    "with recursive " + _GPAIR + "," + _COMPONENTS.format(rounds=25)
    + "select pt.id as p_partkey, coalesce(cluster, -1) as cluster from pt left join lab using (id)",
)
def _(t):
    return db.dbscan_mixed(t("part"), _MIX, 0.28, 5, "p_partkey").select("p_partkey", "cluster")


# -- lateral movement by clusters --------------------------------------------------------------------


def _train(t):
    return fl.split_by_status(t("v_auth", **AUTH_NAMES), "benign")


@query("source_clusters_fit")
def _(t):
    return lm.source_clusters(_train(t), 6)


@query("user_clusters_fit")
def _(t):
    return lm.user_clusters(_train(t), 6)


@query("destination_clusters_fit")
def _(t):
    return lm.destination_clusters(_train(t), 6)


# fixed cluster tables: a number per entity, some entities left out so that joins miss
_FIXED = """
src as (select distinct source, cast(cast(substr(source, 2) as int) % 4 as int) as c_src from rq where cast(substr(source, 2) as int) % 13 <> 5),
usr as (select distinct username, cast(cast(substr(username, 2) as int) % 5 as int) as c_usr from rq where cast(substr(username, 2) as int) % 17 <> 3),
dst as (select distinct destination, cast(cast(substr(destination, 2) as int) % 3 as int) as c_dst from rq where cast(substr(destination, 2) as int) % 19 <> 7)
"""
_RQ = "rq as (select id, src_ip as source, dst_ip as destination, user_id as username, status from v_auth)"
_LM = f"""with {_RQ}, {_FIXED},
train as (select rq.*, c_src, c_usr, c_dst from rq join src using (source) join usr using (username) join dst using (destination) where starts_with(status, 'benign')),
test as (select rq.* exclude (status), c_src, c_usr, c_dst from rq left join src using (source) left join usr using (username) left join dst using (destination) where starts_with(status, 'unknown')),
trip as (select distinct c_usr, c_src, c_dst, status from train),
scored as (select test.* replace (coalesce(test.c_usr, -1) as c_usr, coalesce(test.c_src, -1) as c_src, coalesce(test.c_dst, -1) as c_dst), coalesce(status, 'malicious') as status
  from test left join trip on trip.c_usr = test.c_usr and trip.c_src = test.c_src and trip.c_dst = test.c_dst)
"""
_LM_COLUMNS = ["id", "username", "c_usr", "source", "c_src", "destination", "c_dst", "status"]
_LIST = ", ".join(_LM_COLUMNS)


def _fixed(t):
    number = lambda n: F.substring(n, 2, 9).cast("int")
    rq = t("v_auth", **AUTH_NAMES)

    def table(entity, name, mod, skip, rest):
        return (
            rq.select(entity).distinct().where(number(entity) % skip != rest)
            .select(entity, (number(entity) % mod).alias(name))
        )

    return (
        rq,
        table("source", "c_src", 4, 13, 5),
        table("username", "c_usr", 5, 17, 3),
        table("destination", "c_dst", 3, 19, 7),
    )


@query("train_clusters_inner", _LM + f"select {_LIST} from train")
def _(t):
    rq, src, usr, dst = _fixed(t)
    return jn.train_clusters_inner(fl.split_by_status(rq, "benign"), src, usr, dst).select(*_LM_COLUMNS)


@query("attach_train_clusters", _LM + "select id, c_src, c_usr, c_dst from test")
def _(t):
    rq, src, usr, dst = _fixed(t)
    return jn.attach_train_clusters(fl.split_by_status(rq, "unknown"), src, usr, dst).select("id", "c_src", "c_usr", "c_dst")


@query("benign_triplets", _LM + "select * from trip")
def _(t):
    rq, src, usr, dst = _fixed(t)
    return jn.benign_triplets(jn.train_clusters_inner(fl.split_by_status(rq, "benign"), src, usr, dst))


def _placed(t):
    rq, src, usr, dst = _fixed(t)
    train = jn.train_clusters_inner(fl.split_by_status(rq, "benign"), src, usr, dst)
    return jn.attach_train_clusters(fl.split_by_status(rq, "unknown"), src, usr, dst), jn.benign_triplets(train)


@query("triplet_novelty_join", _LM + f"select {_LIST} from scored")
def _(t):
    return jn.triplet_novelty_join(*_placed(t)).select(*_LM_COLUMNS)


@query(
    "fill_unmatched",
    _LM + "select id, coalesce(c_usr, -1) as c_usr, coalesce(c_src, -1) as c_src, coalesce(c_dst, -1) as c_dst, 'malicious' as status from test",
)
def _(t):
    rows = _placed(t)[0].withColumn("status", F.lit(None).cast("string"))
    return jn.fill_unmatched(rows).select("id", "c_usr", "c_src", "c_dst", "status")


@query("union_train_test", _LM + f"select {_LIST} from train union all select {_LIST} from scored")
def _(t):
    rq, src, usr, dst = _fixed(t)
    return lm.score_requests(fl.split_by_status(rq, "benign"), fl.split_by_status(rq, "unknown"), src, usr, dst)


def _profile_ctes(entity, distincts, features, pair, prefix, k) -> str:
    """CTEs with the scaled profile and the nearest of k centroids, the first k entities."""
    prof = _profile_sql(entity, distincts, pair)
    for name in ("base", "mean", "most", "prof"):
        prof = prof.replace(f"{name} as (", f"{prefix}_{name} as (").replace(f"from {name} ", f"from {prefix}_{name} ").replace(f"join {name} ", f"join {prefix}_{name} ")
    cols = [f'"{f}"' for f in features]
    scaled = ", ".join(f"case when max({f}) over () > min({f}) over () then ({f} - min({f}) over ()) / cast(max({f}) over () - min({f}) over () as double) else 0 end as {f}" for f in cols)
    gap = " + ".join(f"(s.{f} - z.{f}) ** 2" for f in cols)
    return f"""{prof},
{prefix}_scaled as (select {entity}, {scaled} from {prefix}_prof),
{prefix}_cen as (select cast(row_number() over (order by {entity}) - 1 as int) as cluster, * from {prefix}_scaled order by {entity} limit {k}),
{prefix}_tab as (select {entity}, (select arg_min(cluster, struct_pack(d := round({gap}, 9), i := cluster)) from {prefix}_cen z) as c_{prefix} from {prefix}_scaled s)"""


_SHARED = ["NoOfRecords", "Mean", "Max", *[f.strip('"') for f in FLAGS]]
_SIDES = {
    "src": ("source", 'count(distinct username) as "F1", count(distinct destination) as destination', ["F1", *_SHARED], "destination"),
    "usr": ("username", 'count(distinct source) as "F1", count(distinct destination) as "F2"', ["F1", "F2", *_SHARED], "destination"),
    "dst": ("destination", 'count(distinct username) as "F1", count(distinct source) as "F2"', ["F1", "F2", *_SHARED], "source"),
}
_FULL = (
    _CAL.replace("cal as (select *,", "every as (select *,")
    + ", cal as (select * from every where starts_with(status, 'benign')), "
    + ",\n".join(_profile_ctes(e, d, f, p, prefix, 3) for prefix, (e, d, f, p) in _SIDES.items())
    + f""",
rq as (select id, source, destination, username, status from every),
train as (select rq.*, c_src, c_usr, c_dst from rq join src_tab using (source) join usr_tab using (username) join dst_tab using (destination) where starts_with(status, 'benign')),
test as (select rq.* exclude (status), c_src, c_usr, c_dst from rq left join src_tab using (source) left join usr_tab using (username) left join dst_tab using (destination) where starts_with(status, 'unknown')),
trip as (select distinct c_usr, c_src, c_dst, status from train),
scored as (select test.* replace (coalesce(test.c_usr, -1) as c_usr, coalesce(test.c_src, -1) as c_src, coalesce(test.c_dst, -1) as c_dst), coalesce(status, 'malicious') as status
  from test left join trip on trip.c_usr = test.c_usr and trip.c_src = test.c_src and trip.c_dst = test.c_dst)
select {_LIST} from train union all select {_LIST} from scored"""
)


def _first_three(profile, entity, distincts):
    scaled, features = lm.scaled_profile(profile, distincts)
    first = scaled.orderBy(entity).limit(3).withColumn("cluster", F.row_number().over(_by(entity)) - 1)
    return first.select("cluster", *[c(f) for f in features])


def _three_centroids(train):
    return (
        _first_three(agg.source_profile(train), "source", ["F1"]),
        _first_three(agg.user_profile(train), "username", ["F1", "F2"]),
        _first_three(agg.destination_profile(train), "destination", ["F1", "F2"]),
    )


_TABLES = _FULL[: _FULL.index("\nrq as (")].rstrip(",")


@query("source_clusters", _TABLES + " select source, c_src from src_tab")
def _(t):
    train = _train(t)
    return lm.source_clusters(train, 3, centroids=_three_centroids(train)[0])


@query("user_clusters", _TABLES + " select username, c_usr from usr_tab")
def _(t):
    train = _train(t)
    return lm.user_clusters(train, 3, centroids=_three_centroids(train)[1])


@query("destination_clusters", _TABLES + " select destination, c_dst from dst_tab")
def _(t):
    train = _train(t)
    return lm.destination_clusters(train, 3, centroids=_three_centroids(train)[2])


@query("lm_cluster_detect", _FULL)
def _(t):
    train = _train(t)
    centroids = _three_centroids(train)
    out = lm.lm_cluster_detect(observations(t), users(t), connections(t), 3, 3, 3, centroids=centroids)
    return out.select(*_LM_COLUMNS)


def _by(entity):
    from pyspark.sql import Window

    return Window.orderBy(entity)  # over three rows


@query("lm_cluster_detect_kmeans")
def _(t):
    return lm.lm_cluster_detect(observations(t), users(t), connections(t), 6, 6, 6)

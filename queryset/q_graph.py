"""Access graph, walks, embeddings, nearest neighbours and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from queryset.catalog import query
from queryset.q_tables import AUTH, connections, observations, users
from sparkhunt.functions.timeparts import epoch_seconds
from sparkhunt.operators import boosting
from sparkhunt.operators import classify as cl
from sparkhunt.operators import graph as gr
from sparkhunt.operators import knn, newton
from sparkhunt.operators.filters import split_by_status
from sparkhunt.operators.joins import assemble_auth_requests
from sparkhunt.plans.lateral_movement import graph_lm_detect
from sparkhunt.session import cut_lineage

_EDGES = """
half as (select src_ip as a, user_id as b from v_auth union select dst_ip, user_id from v_auth),
edges as (select a as src, b as dst from half union select b, a from half)
"""
_ADJ = _EDGES + """,
deg as (select src, count(*) as degree from edges group by src),
adj as (select e.src as node, row_number() over (partition by e.src order by e.dst) - 1 as pos, e.dst as neighbor, d.degree, f.degree as neighbor_degree
  from edges e join deg d on d.src = e.src join deg f on f.src = e.dst)
"""


def _edges(t):
    return gr.graph_edges(t("v_auth", **AUTH))


@query("graph_edges", "with " + _EDGES + "select src, dst from edges")
def _(t):
    return _edges(t)


@query("adjacency", "with " + _ADJ + "select * from adj")
def _(t):
    return gr.adjacency(_edges(t))


_START = _ADJ + """,
w1 as (select node || '#' || cast(k as string) as walk_id, node, degree, [node] as path from (select src as node, degree, unnest([1, 2]) as k from deg))
"""


@query("walk_starts", "with " + _START + "select walk_id, node, degree from w1")
def _(t):
    nodes = gr.adjacency(_edges(t)).where("pos = 0").select("node", "degree")
    return gr.walk_starts(nodes, 2).select("walk_id", "node", "degree")


def _steps(length: int) -> str:
    out = _START
    for i in range(1, length):
        choice = f"cast('0x' || substr(md5('0|' || w.walk_id || '|{i}'), 1, 8) as bigint) % w.degree"
        out += f""",
w{i + 1} as (select w.walk_id, a.neighbor as node, a.neighbor_degree as degree, list_append(w.path, a.neighbor) as path
  from w{i} w join adj a on a.node = w.node and a.pos = {choice})"""
    return out


@query("walk_neighbor_join", "with " + _steps(2) + " select walk_id, node, degree from w2")
def _(t):
    adj = cut_lineage(gr.adjacency(_edges(t)))
    starts = gr.walk_starts(adj.where("pos = 0").select("node", "degree"), 2)
    return gr.walk_neighbor_join(starts, adj).select("walk_id", "node", "degree")


@query("random_walks", "with " + _steps(6) + " select walk_id, array_to_string(path, '>') as path from w6")
def _(t):
    walks = gr.random_walks(gr.adjacency(_edges(t)), 6, 2)
    return walks.select("walk_id", F.array_join("path", ">").alias("path"))


# -- nearest neighbours -----------------------------------------------------------------------------

_KNN = """
tr as (select vec_id, embedding::double[] as e, label from embeddings where vec_id % 5 <> 0),
te as (select vec_id, embedding::double[] as e from embeddings where vec_id % 5 = 0),
d as (select te.vec_id, tr.vec_id as neighbor, label, round(list_distance(te.e, tr.e), 9) as distance from te, tr),
nn as (select *, row_number() over (partition by vec_id order by distance, neighbor) as rank from d)
"""


def _sides(t):
    df = t("embeddings")
    return df.where("vec_id % 5 <> 0"), df.where("vec_id % 5 = 0")


@query(
    "knn_join",
    "with " + _KNN + "select vec_id, cast(rank as int) as rank, neighbor, round(distance, 6) as distance from nn where rank <= 5",
)
def _(t):
    train, test = _sides(t)
    out = knn.knn_join(train, test, "embedding", 5, "vec_id", "vec_id")
    return out.withColumn("distance", F.round("distance", 6))


@query(
    "classify_knn",
    "with " + _KNN + """, v as (select vec_id, label, count(*) as n from nn where rank <= 5 group by 1, 2)
    select vec_id, arg_max(label, struct_pack(n := n, s := -label)) as prediction from v group by vec_id""",
)
def _(t):
    train, test = _sides(t)
    return knn.classify_knn(train, test, 5, "embedding", "label", "vec_id", "vec_id")


# -- embeddings and classifiers -----------------------------------------------------------------------


def _requests(t):
    return assemble_auth_requests(observations(t), users(t), connections(t))


def _vectors(t):
    return gr.node_embeddings(gr.random_walks(gr.adjacency(_edges(t)), 3))


_WALKS = _ADJ + """,
s1 as (select src || '#1' as walk_id, src as node, degree, [src] as path from deg)""" + "".join(
    f""",
s{i + 1} as (select w.walk_id, a.neighbor as node, a.neighbor_degree as degree, list_append(w.path, a.neighbor) as path
  from s{i} w join adj a on a.node = w.node and a.pos = cast('0x' || substr(md5('0|' || w.walk_id || '|{i}'), 1, 8) as bigint) % w.degree)"""
    for i in (1, 2)
)
_VECTORS = _WALKS + """,
stood as (select walk_id, unnest(range(1, len(path) + 1)) as i, path from s3),
seen as (select a.path[a.i] as u, b.path[b.i] as v from stood a join stood b on a.walk_id = b.walk_id and a.i <> b.i and abs(a.i - b.i) <= 5),
pair as (select u, v, count(*) as n from seen group by u, v), tot as (select u, sum(n) as n from pair group by u),
ppmi as (select pair.u, pair.v, greatest(ln(pair.n * (select sum(n) from tot)::double / (a.n::double * b.n::double)), 0) as p from pair join tot a on a.u = pair.u join tot b on b.u = pair.v),
dims as (select u, v, p, unnest(range(128)) as k from ppmi),
vec as (select u as node, k, sum(p * ((cast('0x' || substr(md5('0|0|' || v), 4 * (k // 16)::int + 1, 4) as int) >> (k % 16)::int) % 2 * 2 - 1)) / sqrt(128) as x from dims group by u, k)
"""


@query("node_embeddings", "with " + _VECTORS + "select node, k::int as dim, round(x, 6) as x from vec")
def _(t):
    out = _vectors(t).select("node", F.posexplode("vector").alias("dim", "x"))
    return out.withColumn("x", F.round("x", 6) + 0.0)


@query(
    "auth_features",
    "with " + _VECTORS + """, w as (select node, round(sum(x * (k + 1)), 4) as s from vec group by node)
    select id, s.s as src, d.s as dst, u.s as usr, floor(epoch(cast(first_observed as timestamp)))::double as at
    from v_auth a join w s on s.node = a.src_ip join w d on d.node = a.dst_ip join w u on u.node = a.user_id""",
)
def _(t):
    rows = cl.auth_features(_requests(t), cut_lineage(_vectors(t)))
    part = lambda i: F.round(
        F.aggregate(F.transform(F.slice("features", 128 * i + 1, 128), lambda x, k: x * (k + 1)), F.lit(0.0), lambda s, x: s + x), 4
    )
    return rows.select("id", part(0).alias("src"), part(1).alias("dst"), part(2).alias("usr"), F.element_at("features", -1).alias("at"))


@query(
    "status_code",
    "select id, case when status = 'benign' then 0 else 1 end as code, case when status = 'benign' then 'benign' else 'malicious' end as back from v_auth",
)
def _(t):
    code = cl.status_code(F.col("status"))
    return t("v_auth").select("id", code.alias("code"), cl.status_of_code(code).alias("back"))


def _split(t):
    return _known_unknown(cl.auth_features(cut_lineage(_requests(t)), cut_lineage(_vectors(t))))


def _split_stored(t):
    """:func:`_split` from stored features, for a fit that draws rows by their place."""
    return _known_unknown(cut_lineage(cl.auth_features(_requests(t), cut_lineage(_vectors(t)))))


def _known_unknown(data):
    """Known requests with labels, and unknown ones."""
    known = split_by_status(data, "benign").unionByName(split_by_status(data, "malicious"))
    return known.withColumn("label", cl.status_code(F.col("status"))), split_by_status(data, "unknown")


for _name, _fn in (
    ("classify_logistic", cl.classify_logistic),
    ("classify_boosted", cl.classify_boosted),
    ("classify_svm", cl.classify_svm),
):

    @query(_name)
    def _(t, fn=_fn):
        return fn(*_split(t)).select("id", "prediction")


@query("classify_randomforest")
def _(t):
    return cl.classify_randomforest(*_split_stored(t)).select("id", "prediction")


# features as (event, feature, value), and two rounds of depth two on their bins
_PARTS = _VECTORS + """,
six as (select node, k::int as k, round(x, 6) + 0.0 as x from vec),
req as (select *, starts_with(status, 'unknown') as test, (not starts_with(status, 'benign'))::int as y from v_auth
  where starts_with(status, 'unknown') or starts_with(status, 'benign') or starts_with(status, 'malicious')),
part as (
  select event_id, test, k as f, x from req join six on node = src_ip union all
  select event_id, test, 128 + k, x from req join six on node = dst_ip union all
  select event_id, test, 256 + k, x from req join six on node = user_id union all
  select event_id, test, 384, floor(epoch(cast(first_observed as timestamp)))::double from req),
cnt as (select f, x, count(*) filter (not test) as n from part group by f, x),
edge as (
  select f, min(x) as x from (select f, x, ((sum(n) over (partition by f order by x) - n) * 256) // (select count(*) from req where not test) as share from cnt where n > 0)
  where share > 0 group by f, share),
bins as (select f, x, sum((e.x is not null)::int) over (partition by f order by x) as b from cnt left join edge e using (f, x)),
cell as materialized (select event_id, f, b from part join bins using (f, x)),
s00 as (select event_id, test, y, 0.0::double as margin, 1 as node from req)"""


def _boosted(rounds: int, depth: int) -> str:
    out = _PARTS
    for r in range(rounds):
        for d in range(depth):
            at, new = f"s{r}{d}", f"s{r}{d + 1}"
            out += f""",
g{r}{d} as (select *, round((p - y) * 1073741824)::bigint as g, round(greatest(p * (1 - p), 1e-16) * 1073741824)::bigint as h from (select *, 1 / (1 + exp(-margin)) as p from {at} where not test)),
h{r}{d} as (select node, f, b, sum(g) as g, sum(h) as h from g{r}{d} join cell using (event_id) group by all),
c{r}{d} as (select node, f, b, sum(g) over w / 1073741824 as gl, sum(h) over w / 1073741824 as hl, sum(g) over a / 1073741824 as g, sum(h) over a / 1073741824 as h
  from h{r}{d} window w as (partition by node, f order by b), a as (partition by node, f)),
b{r}{d} as (select * from (select node, f, b, 0.5 * (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) as gain from c{r}{d} where hl >= 1 and h - hl >= 1)
  where gain > 1e-6 qualify row_number() over (partition by node order by gain desc, f, b) = 1),
{new} as materialized (select s.event_id, s.test, s.y, s.margin, case when q.f is null then s.node else 2 * s.node + (cell.b > q.b)::int end as node
  from {at} s left join b{r}{d} q on q.node = s.node left join cell on cell.event_id = s.event_id and cell.f = q.f)"""
        out += f""",
v{r} as (select node, -0.3 * (sum(g) / 1073741824) / (sum(h) / 1073741824 + 1) as v
  from (select node, round((p - y) * 1073741824)::bigint as g, round(greatest(p * (1 - p), 1e-16) * 1073741824)::bigint as h from (select *, 1 / (1 + exp(-margin)) as p from s{r}{depth} where not test)) group by node),
s{r + 1}0 as materialized (select event_id, test, y, margin + v as margin, 1 as node from s{r}{depth} join v{r} using (node))"""
    return f"with {out} select 'obs-' || event_id as id, round(margin, 9) as log_odds, (margin > 0)::int as prediction from s{rounds}0 where test"


@query("classify_boosted_small", _boosted(2, 2))
def _(t):
    vectors = _vectors(t).withColumn("vector", F.transform("vector", lambda x: F.round(x, 6) + 0.0))
    data = cl.auth_features(cut_lineage(_requests(t)), cut_lineage(vectors))
    known = split_by_status(data, "benign").unionByName(split_by_status(data, "malicious"))
    model = boosting.fit(known.withColumn("label", cl.status_code(F.col("status"))), "features", "label", 2, 2)
    scored = split_by_status(data, "unknown").select("id", model.log_odds(F.col("features")).alias("x"))
    return scored.select("id", F.round("x", 9).alias("log_odds"), (F.col("x") > 0).cast("int").alias("prediction"))


# Newton steps on one feature, the seconds since midnight
_LOGISTIC = """
req as (select event_id, starts_with(status, 'unknown') as test, (not starts_with(status, 'benign'))::int as y, floor(epoch(cast(first_observed as timestamp)))::bigint % 86400 as x from v_auth
  where starts_with(status, 'unknown') or starts_with(status, 'benign') or starts_with(status, 'malicious')),
z as materialized (select event_id, test, y, (x - (select avg(x) from req where not test)) / (select stddev_samp(x) from req where not test) as z from req),
w0 as (select 0::double as b, 0::double as w)""" + "".join(
    f""",
p{i} as (select y, z, b, w, 1 / (1 + exp(-(b + w * z))) as p from z, w{i} where not test),
m{i} as (select any_value(b) as b, any_value(w) as w, sum(p - y) as g0, sum((p - y) * z) + any_value(w) as g1, sum(p * (1 - p)) as h0, sum(p * (1 - p) * z) as h1, sum(p * (1 - p) * z * z) + 1 as h2 from p{i}),
w{i + 1} as materialized (select b - (h2 * g0 - h1 * g1) / (h0 * h2 - h1 * h1) as b, w - (h0 * g1 - h1 * g0) / (h0 * h2 - h1 * h1) as w from m{i})"""
    for i in range(10)
)


@query("classify_logistic_small", "with " + _LOGISTIC + "select 'obs-' || event_id as id, round(b + w * z, 6) as log_odds, (b + w * z > 0)::int as prediction from z, w10 where test")
def _(t):
    data = _requests(t).withColumn("features", F.array((epoch_seconds(F.col("first_observed")) % 86400).cast("double")))
    known = split_by_status(data, "benign").unionByName(split_by_status(data, "malicious"))
    train = cut_lineage(known.select("features", cl.status_code(F.col("status")).alias("label")))
    model = newton.fit(train, "features", "label")
    scored = split_by_status(data, "unknown").select("id", model.log_odds(F.col("features")).alias("x"))
    return scored.select("id", F.round("x", 6).alias("log_odds"), (F.col("x") > 0).cast("int").alias("prediction"))


@query("classify_knn_requests")
def _(t):
    return cl.classify_knn(*_split(t)).select("id", "prediction")


@query("label_unknown")
def _(t):
    train, test = _split(t)
    return cl.label_unknown(train.drop("label").unionByName(test), "logisticRegression").select("id", "status")


@query(
    "label_unknown_kept",
    "select id, case when starts_with(status, 'benign') or starts_with(status, 'malicious') then status else 'predicted' end as kept from v_auth where starts_with(status, 'benign') or starts_with(status, 'malicious') or starts_with(status, 'unknown')",
)
def _(t):
    train, test = _split(t)
    out = cl.label_unknown(train.drop("label").unionByName(test), "logisticRegression").select("id", "status")
    known = train.select("id", F.lit(True).alias("known"))
    allowed = F.when(F.col("status").isin("benign", "malicious"), "predicted")
    return out.join(known, "id", "left").select("id", F.when(F.col("known"), F.col("status")).otherwise(allowed).alias("kept"))


@query("graph_lm_detect")
def _(t):
    return graph_lm_detect(observations(t), users(t), connections(t), 3)

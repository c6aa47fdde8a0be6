"""Operators against plain Python on small, awkward tables."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkhunt import apply_analytic
from sparkhunt.operators import aggregates as agg
from sparkhunt.operators import dbscan as db
from sparkhunt.operators import graph as gr
from sparkhunt.operators import knn, lookup, ordering, quantiles
from sparkhunt.operators.components import connected_components
from sparkhunt.operators.geo import ip_geolocate
from sparkhunt.operators.kmeans import kmeans_assign, kmeans_cluster, kmeans_cost
from sparkhunt.operators.plots import plot_kind
from sparkhunt.functions.ipaddr import ip_is_private, traffic_category


def brute_dbscan(points, near, min_samples):
    n = len(points)
    around = [[j for j in range(n) if near(points[i], points[j])] for i in range(n)]
    core = [len(a) >= min_samples for a in around]
    label = [-1] * n
    found = 0
    for i in range(n):
        if not core[i] or label[i] >= 0:
            continue
        stack, label[i] = [i], found
        while stack:
            for j in around[stack.pop()]:
                if core[j] and label[j] < 0:
                    label[j] = found
                    stack.append(j)
        found += 1
    for i in range(n):
        if not core[i]:
            label[i] = min((label[j] for j in around[i] if core[j]), default=-1)
    return label, around


@pytest.mark.parametrize("seed", [1, 2])
def test_dbscan_with_hot_point(spark, seed):
    rng = random.Random(seed)
    points = [(rng.uniform(0, 6), rng.uniform(0, 6)) for _ in range(90)]
    points += [(3.0, 3.0)] * 60 + [(rng.gauss(1, 0.1), rng.gauss(5, 0.1)) for _ in range(30)]
    rng.shuffle(points)
    near = lambda p, q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= 0.25
    want, _ = brute_dbscan(points, near, 5)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double")
    got = {r["id"]: r["cluster"] for r in db.dbscan_numeric(df, ["x", "y"]).collect()}
    assert [got[i] for i in range(len(points))] == want


def test_dbscan_links_two_dense_cells(spark):
    left = [(0.0 + i * 1e-4, 0.0) for i in range(40)]
    right = [(0.43 + i * 1e-4, 0.1 * (i % 2)) for i in range(40)]
    points = left + right + [(9.0, 9.0), (None, 1.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, x double, y double")
    got = {r["id"]: r["cluster"] for r in db.dbscan_numeric(df, ["x", "y"]).collect()}
    assert {got[i] for i in range(80)} == {0} and got[80] == got[81] == -1


def test_dbscan_mixed(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice("xyz"), rng.randint(0, 20)) for _ in range(120)]
    span = max(r[2] for r in rows) - min(r[2] for r in rows)
    gap = lambda p, q: (p[0] != q[0]) + (p[1] != q[1]) + abs(p[2] - q[2]) / span
    for eps in (0.02, 0.34):
        want, around = brute_dbscan(rows, lambda p, q: gap(p, q) <= eps * 3, 5)
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a string, b string, n int")
        got = {r["id"]: r["cluster"] for r in db.dbscan_mixed(df, ["a", "b", "n"], eps).collect()}
        assert [got[i] for i in range(len(rows))] == want
        counts = {r["id"]: r["n_neighbors"] for r in db.gower_pair_join(df, ["a", "b", "n"], eps, "id").collect()}
        assert [counts[i] for i in range(len(rows))] == [len(a) for a in around]


def test_components(spark):
    rng = random.Random(3)
    edges = [(f"n{rng.randint(0, 150):03d}", f"n{rng.randint(0, 150):03d}") for _ in range(110)]
    edges += [("n000", f"n{i:03d}") for i in range(100, 130)]
    nodes = [f"n{i:03d}" for i in range(151)]
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    out = connected_components(
        spark.createDataFrame(edges, "src string, dst string"),
        spark.createDataFrame([(x,) for x in nodes], "node string"),
    )
    assert {r["node"]: r["component"] for r in out.collect()} == {x: root(x) for x in nodes}


def test_salted_join_keeps_every_row(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(3000)] + [(9999, None)]
    big = spark.createDataFrame(rows, "id int, k string")
    side = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(40)], "k string, v int")
    left = lookup.salted_join(big, side, ["k"])
    want = {("hot"): 1, **{f"k{i}": i for i in range(40)}}
    assert {(r["id"], r["v"]) for r in left.collect()} == {(i, want.get(k)) for i, k in rows}
    assert left.count() == len(rows)
    totals = big.groupBy("k").agg(F.sum("id").alias("s"), F.count(F.lit(1)).alias("n"))
    assert lookup.totals_join(big, totals, ["k"], "n", "inner").count() == 3000


def test_row_positions_and_running_sum(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = ordering.row_positions(df, ["k"]).collect()
    assert all(r["k"] == r["pos"] for r in out) and len(out) == 1000
    rows = spark.range(500).select(F.lit("a").alias("g"), F.col("id").alias("line"), (F.col("id") % 3).alias("v"))
    sums = ordering.running_sum(rows, ["g"], "line", F.col("v"), "s", chunk_rows=64).collect()
    expected = {i: sum(j % 3 for j in range(i + 1)) for i in range(500)}
    assert {r["line"]: r["s"] for r in sums} == expected


def test_exact_quantiles(spark, monkeypatch):
    """Ties, signs, huge and tiny numbers; four scans whatever the columns and ranks."""
    scans = []
    count = quantiles._digit_counts
    monkeypatch.setattr(quantiles, "_digit_counts", lambda df, *rest: scans.append(df) or count(df, *rest))
    rng = random.Random(7)
    columns = {
        "x": [rng.choice([1.0, 2.5, rng.random() * 100]) for _ in range(301)],
        "y": [rng.choice([-0.0, 0.0, -5e-324, 1e308, -1e308, -1.5, rng.gauss(0, 1e-9)]) for _ in range(301)],
        "z": [7.0] * 300 + [None],
    }
    df = spark.createDataFrame([*zip(*columns.values()), (None, None, None)], "x double, y double, z double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = quantiles.exact_quantiles(df, list(columns), shares)
    for name, values in columns.items():
        assert got[name] == pytest.approx(list(np.quantile([v for v in values if v is not None], shares)))
    assert len(scans) == 4


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert agg.boxplot_stats(df, ["x"]).first()["n_outliers"] == 0


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    train, test = rng.normal(size=(300, 6)), rng.normal(size=(40, 6))
    train[100:200] = train[0]  # a third of the rows are equal
    to_df = lambda m: spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(m)], "id int, v array<double>")
    for pivots, block in ((1, 1024), (8, 32)):
        knn._MAX_PIVOTS, knn._BLOCK_ROWS = pivots, block
        out = knn.knn_join(to_df(train), to_df(test), "v", 5).collect()
        got = {(r["id"], r["rank"]): r["neighbor"] for r in out}
        for q in range(len(test)):
            d = np.round(np.sqrt(((train - test[q]) ** 2).sum(1)), 9)
            want = sorted(range(len(train)), key=lambda s: (d[s], s))[:5]
            assert [got[q, i + 1] for i in range(5)] == want
    knn._MAX_PIVOTS, knn._BLOCK_ROWS = 256, 1024


def test_geolocate_edges(spark):
    blocks = [(0x01000000, 0x01FFFFFF, 1.0, 1.0), (0x02000000, 0x020000FF, 2.0, 2.0), (0x02000180, 0x020001FF, 3.0, 3.0)]
    bdf = spark.createDataFrame(blocks, "start_ip long, end_ip long, latitude double, longitude double")
    ips = ["1.0.0.0", "1.255.255.255", "2.0.0.255", "2.0.1.0", "2.0.1.128", "2.0.2.0", "::1", "", None, "1.2.3.999"]
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    got = {r["ip"]: r["latitude"] for r in ip_geolocate(df, bdf, "ip").collect()}
    assert got == {"1.0.0.0": 1.0, "1.255.255.255": 1.0, "2.0.0.255": 2.0, "2.0.1.128": 3.0}


def test_address_classes(text_of):
    ips = ["10.1.1.1", "100.64.0.1", "192.0.0.9", "192.0.0.8", "224.0.0.1", "240.0.0.1", "8.8.8.8", "::1", None]
    assert text_of(ip_is_private, ips) == [True, False, False, True, False, True, False, True, None]
    pairs = {
        ("9.59.150.142", "8.8.8.8"): "Sensitive->External",
        ("10.0.0.1", "9.1.1.1"): "Private->IBM",
        ("9.1.1.1", "10.0.0.1"): "IBM->Unknown",
        ("8.8.8.8", "1.1.1.1"): "External->External",
        ("8.8.8.8", "10.0.0.1"): "Unknown-Unknown",
        ("::1", "10.0.0.1"): "Private->Unknown",
        ("2606:4700::1", "fd00::1"): "Unknown-Unknown",
        ("nowhere", "10.0.0.1"): None,
    }
    texts = [f"{a} {b}" for a, b in pairs]
    split = lambda i: lambda t: F.split(t, " ")[i]
    assert text_of(lambda t: traffic_category(split(0)(t), split(1)(t)), texts) == list(pairs.values())


def test_walks_use_edges(spark):
    rows = [(f"h{i % 5}", f"h{i % 7}", f"u{i % 11}") for i in range(60)]
    df = spark.createDataFrame(rows, "s string, d string, u string").withColumnsRenamed(
        {"s": "src_ref.value", "d": "dst_ref.value", "u": "user_id"}
    )
    edges = gr.graph_edges(df)
    pairs = {(r["src"], r["dst"]) for r in edges.collect()}
    walks = [r["path"] for r in gr.random_walks(gr.adjacency(edges), 12, 2, seed=4).collect()]
    assert len(walks) == 2 * len({p[0] for p in pairs}) and all(len(w) == 12 for w in walks)
    assert all((a, b) in pairs for w in walks for a, b in zip(w, w[1:]))


def test_kmeans_is_no_worse_than_one_more_step(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.gauss(i % 3 * 5, 1), rng.gauss(0, 1)) for i in range(200)], "a double, b double")
    out = kmeans_cluster(df, ["a", "b"], 3, 1)
    assert out.count() == 200 and {r[0] for r in out.select("cluster").distinct().collect()} == {0, 1, 2}
    centers = out.groupBy("cluster").agg(F.avg("a").alias("a"), F.avg("b").alias("b"))
    again = kmeans_assign(df, ["a", "b"], centers)
    assert kmeans_cost(again, centers, ["a", "b"]) <= kmeans_cost(out, centers, ["a", "b"]) + 1e-9


def test_scaling_and_outliers(spark):
    df = spark.createDataFrame([(1, 5.0), (3, 5.0), (2, 5.0)], "a int, b double")
    rows = agg.minmax_scale(df, ["a", "b"]).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    one = spark.createDataFrame([(1.0,)], "a double")
    assert agg.outlier_bounds_stddev(one, "a").first()["lower"] is None
    many = spark.createDataFrame([(float(x),) for x in range(9)], "a double")
    low = agg.outlier_bounds_stddev(many, "a").first()["lower"]
    assert low == pytest.approx(4 - 3 * statistics.stdev(range(9)))


def test_months_and_weeks(spark):
    df = spark.createDataFrame([("2024-01-30T10:00:00.000Z", 1), ("2024-04-02T10:00:00.000Z", 2)], "ts string, y int")
    day = lambda d: [r["time"].strftime("%m-%d") for r in d.orderBy("time").collect()]
    assert day(agg.time_sum(df, "ts", "y", "1M")) == ["01-31", "02-29", "03-31", "04-30"]
    assert day(agg.time_count(df, "ts", "y", "1W"))[:2] == ["02-04", "02-11"]


def test_plot_choice():
    assert plot_kind("numerical", "numerical") == "scatter"
    assert plot_kind(["numerical", "numerical"], None) == "dist_x"
    for bad in (("categorical", "categorical"), (None, None), (["numerical", "timestamp"], None)):
        with pytest.raises(ValueError):
            plot_kind(*bad)
    with pytest.raises(ValueError):
        plot_kind("numerical", None, override="os.system")


def test_unknown_analytic(spark):
    with pytest.raises(KeyError):
        apply_analytic("nope", spark.range(1))


def multiline(spark, lines, rules=None):
    from sparkhunt.functions import whois_rules
    from sparkhunt.functions.whois import whois_multiline

    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(lines)], "ip string, line_no int, line string")
    out = whois_multiline(df, rules=rules or whois_rules.LINE_RULES).collect()
    return sorted((r.line_no, r.tag, r.value) for r in out)


def test_unfinished_whois_lines(spark):
    assert multiline(spark, ["Registrant:", "Registrar:", "Creation Date: 2001-01-01"]) == [(2, "created", "2001-01-01")]
    # four in a row: the first takes the second, the third the fourth
    assert multiline(spark, ["Registrant:"] * 4 + ["Creation Date: 2001-01-01"]) == [(4, "created", "2001-01-01")]
    assert multiline(spark, ["Creation Date: 2001-01-01", "Registrar:"]) == [(0, "created", "2001-01-01")]
    rules = [(r"^a.*\+$", "@join", "", ""), (r"^(a.*)$", "owner", "%1", ""), (r"^b=(.*)$", "name", "%1", "")]
    lines = ["a+", "b+", "c", "b=1", "a+", "a+", "b=2", "b=3"]
    assert multiline(spark, lines, rules) == [(0, "owner", "a+b+c"), (3, "name", "1"), (4, "owner", "a+a+b=2"), (7, "name", "3")]


def test_a_flush_left_line_ends_a_strict_server_list_and_is_read(spark):
    # recorded choice: such a line is not swallowed
    got = multiline(spark, ["Name Server ........ NS9", "Creation Date: 2001-01-01", "Name Server ........ NS8"])
    assert (1, "created", "2001-01-01") in got and [v for _, t, v in got if t == "ns"] == ["ns9", "ns8"]


def test_many_append_rules_compile(spark):
    from sparkhunt.functions.rules import score_rules

    rules = [
        {
            "conditions": {"any": [{"name": "command_line", "operator": "contains", "value": f"w{i % 7}"}]},
            "actions": [
                {"name": "append_to_property", "params": {"name": "techniques", "value": f"t{i:03d}"}},
                {"name": "increment_property", "params": {"name": "x_suspicious_score", "value": 1}},
            ],
        }
        for i in range(200)
    ]
    rules.append(
        {
            "conditions": {"all": [{"name": "x_suspicious_score", "operator": "greater_than", "value": 20}]},
            "actions": [{"name": "set_property", "params": {"name": "level", "value": "high"}}],
        }
    )
    df = spark.createDataFrame([("w0",), ("w1 w2",), (None,)], "command_line string")
    out = {r.command_line: r for r in score_rules(df, rules, keep_techniques=True).collect()}
    assert out["w0"].techniques == " ".join(f"t{i:03d}" for i in range(200) if i % 7 == 0)
    assert out["w1 w2"].x_suspicious_score == 58 and out["w1 w2"].level == "high"
    assert out[None].techniques == "" and out[None].level is None


def test_neighbour_counts_are_exact(spark):
    rng = random.Random(9)
    points = [(i, *(rng.choice([0.0, 0.1, 0.5, 1.0, 2.0, 3.0]) for _ in range(5))) for i in range(150)]
    df = spark.createDataFrame(points, "id int, a double, b double, c double, d double, e double")
    out = {r.id: r.n_neighbors for r in db.eps_neighbor_join(df, list("abcde"), 1.5, "id").collect()}
    near = lambda p, q: sum((x - y) ** 2 for x, y in zip(p[1:], q[1:])) <= 1.5**2
    assert out == {p[0]: sum(near(p, q) for q in points) for p in points}


def test_an_indicator_named_twice_does_not_repeat_rows(spark):
    from sparkhunt.operators.joins import intel_ip_enrich

    df = spark.createDataFrame([("1.1.1.1",), ("2.2.2.2",)], "`src_ref.value` string")
    doc = '{"ip": {"attacks": 3, "ascountry": "US", "asname": "N"}}'
    intel = spark.createDataFrame([("1.1.1.1", doc), ("1.1.1.1", doc)], "ip string, doc string")
    assert intel_ip_enrich(df, intel).count() == 2


def test_addresses_agree_with_the_standard_library(text_of):
    import ipaddress

    from sparkhunt.functions.ipaddr import address_key, ip_key

    rng = random.Random(12)
    heads = ["2001:db8", "2001:3", "2001:20", "2001:1", "fe80", "fc00", "2002", "3fff", "64:ff9b:1", "100", "2606:4700", "0", "ff02"]
    texts = [str(ipaddress.IPv6Address((int(ipaddress.IPv6Address(h + "::")) | rng.getrandbits(rng.choice([8, 60, 96]))))) for h in heads * 8]
    texts += ["::", "::1", "::ffff:10.1.2.3", "::ffff:8.8.8.8", "1::", "1:2:3:4:5:6:7::", "2001:1::1", "2001:1::2", "FE80::A%eth0", "192.0.0.9", "172.31.255.255", "0:0:0:0:0:ffff:1.2.3.4"]
    bad = ["1:2:3:4:5:6:7:8:9", "1:::2", ":1::2", "1:2", "12345::", "::g", "1::2::3", "", "::1.2.3.256", "1:2:3:4:5:6:7:8::", "10.0.0", None]
    addresses = [ipaddress.ip_address(x) for x in texts]
    plain = [ipaddress.ip_address(str(a).partition("%")[0]) for a in addresses]
    assert text_of(ip_key, texts) == [address_key(a) for a in plain]
    assert text_of(ip_is_private, texts) == [a.is_private for a in plain]
    assert text_of(ip_key, bad) == [None] * len(bad)


def test_boosted_query_fits_the_operators_model(spark, monkeypatch):
    from queryset import QUERIES, q_graph
    from sparkhunt.operators import boosting

    fitted = []
    known = spark.createDataFrame([(1, [0.0], 0)], "id long, features array<double>, label int")
    monkeypatch.setattr(q_graph, "_split", lambda t: (known, known.drop("label")))
    monkeypatch.setattr(boosting, "fit", lambda df, vec, label, *size: fitted.append(size) or boosting.BoostedTrees([], 6))
    QUERIES["classify_boosted"](spark, "")
    assert fitted == [(100, 6)]


def glue_by_hand(lines, rules):
    """(line, text) after gluing, one line after the other."""
    import re

    def tag(text):
        return next((r[1] for r in rules if re.search(r[0], text)), None)

    out, at = [], 0
    while at < len(lines):
        text, n, wrapped = lines[at], 1, False
        while at + n < len(lines) and (tag(text) == "@join" or tag(text) == "+wrap" and not wrapped):
            wrapped = wrapped or tag(text) == "+wrap"
            text, n = text + (" " if tag(text) == "+wrap" else "") + lines[at + n], n + 1
        out.append((at, text))
        at += n
    return out


def test_long_records_of_unfinished_lines(spark):
    """Chains of heads far longer than a chunk, and joins over many lines, in one record."""
    from sparkhunt.functions import whois

    rules = [(r"^w$", "+wrap", "", ""), (r"^j+$", "@join", "", ""), (r"^(.+)$", "owner", "%1", "")]
    rng = random.Random(4)
    lines = ["w"] * 5000 + ["j"] * 12 + ["x"] + rng.choices(["w", "j", "x"], k=1500) + ["w"]
    got = multiline(spark, lines, rules)
    want = [(at, "owner", text) for at, text in glue_by_hand(lines, rules) if text not in ("w",) and text.strip("j")]
    assert got == want
    spans = spark.createDataFrame([("k", i, 1 + i % 3) for i in range(3000)] + [(None, 5, 2)], "ip string, line_no int, n int")
    heads = {(r.ip, r.line_no) for r in whois._free_heads(spans, "ip").collect() if r.ip}
    at, free = 0, set()
    while at < 3000:
        free.add(("k", at))
        at += 1 + at % 3
    assert heads == free


def test_the_next_place_is_carried_over_chunks(spark):
    from sparkhunt.operators.ordering import next_at_or_after

    rng = random.Random(6)
    rows = {(k, at): at + rng.randrange(60) for k in ("a", "b", None) for at in rng.sample(range(900), 80)}
    df = spark.createDataFrame([(k, at, w) for (k, at), w in rows.items()], "k string, at long, w long")
    got = {(r.k, r.at): r.nxt for r in next_at_or_after(df, "k", "at", "w", "nxt", chunk_rows=7).collect()}
    assert got == {(k, at): min((x for j, x in rows if j == k and x >= w), default=None) for (k, at), w in rows.items()}


def test_several_lookups_sketch_their_keys_in_one_pass(spark, monkeypatch, tmp_path):
    """With broadcast off, the base table is scanned once by the sketch and once by the joins."""
    from sparkhunt.operators import joins

    rows = [(i, "hot" if i % 3 else f"s{i % 40}", f"u{i % 50}", "d" if i % 2 else None) for i in range(2000)]
    spark.createDataFrame(rows, "id int, source string, username string, destination string").write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    table = lambda key, name, values: spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{key} string, {name} int")
    sides = [table("source", "c_src", ["hot", *(f"s{i}" for i in range(30))]), table("username", "c_usr", [f"u{i}" for i in range(45)]), table("destination", "c_dst", ["d", "e"])]
    want = sorted(map(tuple, joins.attach_train_clusters(base, *sides).select("id", "c_src", "c_usr", "c_dst").collect()), key=lambda r: r[0])
    calls = []
    sketch = lookup.hot_key_hashes
    monkeypatch.setattr(lookup, "fits_broadcast", lambda df, limit=0: False)
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, limit=0: False)
    monkeypatch.setattr(lookup, "hot_key_hashes", lambda df, sets, share=500: calls.append((df, sets)) or sketch(df, sets, share))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.attach_train_clusters(base, *sides)
        got = sorted(map(tuple, out.select("id", "c_src", "c_usr", "c_dst").collect()), key=lambda r: r[0])
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want and len(calls) == 1 and calls[0][0] is base
    assert sketch(base, [["source"], ["username"]])[0] and not sketch(base.limit(0), [["source"]])[0]
    scans = [line for line in plan.splitlines() if "Relation" in line]
    assert len(scans) == 4 and sum("id#" in line and "username#" in line for line in scans) == 1


def test_a_kmeans_fit_reruns_alike_on_shuffled_rows(spark):
    from sparkhunt.operators import kmeans

    rng = random.Random(12)
    middles = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0), (30.0, 30.0)]
    rows = [(i, x + rng.gauss(0, 1), y + rng.gauss(0, 1)) for i in range(400) for x, y in [middles[i % 4]]]
    schema = "id int, a double, b double"
    fits = []
    for turn in range(2):
        df = spark.createDataFrame(rows if not turn else rng.sample(rows, len(rows)), schema).repartition(1 + 5 * turn)
        out = kmeans_cluster(df, ["a", "b"], 4, seed=3)
        fits.append({r["id"]: r["cluster"] for r in out.collect()})
    assert fits[0] == fits[1]
    assert len({(i % 4, c) for i, c in fits[0].items()}) == 4
    odd = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 1.0), (3, None, 1.0)], schema)
    assert {r["id"]: r["cluster"] for r in kmeans_cluster(odd, ["a", "b"], 3).collect()} == {1: 0, 2: 0, 3: None}
    assert kmeans_cluster(odd.limit(0), ["a", "b"], 3).collect() == []
    assert kmeans.kmeans_start(odd.limit(0), ["a", "b"], 3) == []


def test_kmeans_distances_are_compiled(spark):
    from sparkhunt.operators import kmeans as km

    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 2.0, 0.0), (3, 1.0, 0.0), (4, None, 1.0), (5, float("nan"), 1.0)], "id int, x double, y double")
    near = lambda centers: df.select("id", km._nearest([F.col("x"), F.col("y")], centers).alias("n"))
    plan = near([(0.0, 0.0), (2.0, 0.0)])._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "transform" not in plan
    # the first of equally near centers, NULL where a number is missing
    got = {r.id: r.n and (r.n.d, r.n.id) for r in near([(0.0, 0.0), (2.0, 0.0)]).collect()}
    assert (got[1], got[2], got[3], got[4]) == ((0.0, 0), (0.0, 1), (1.0, 0), None) and got[5][1] == 0
    assert {r.id: r.n and r.n.id for r in near([(0.0, 0.0)]).collect()} == {1: 0, 2: 0, 3: 0, 4: None, 5: 0}


def test_kmeans_moves_place_rows_as_the_nearest_center_does(spark, monkeypatch):
    from sparkhunt.operators import kmeans as km

    rng = random.Random(4)
    rows = [(float(rng.randint(0, 6)), float(rng.randint(0, 6))) for _ in range(80)] + [(float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    at = [F.col("x"), F.col("y")]
    for n in (1, 2, 5):
        centers = [(float(rng.randint(0, 6)), float(rng.randint(0, 6))) for _ in range(n)]
        centers[-1] = centers[0]  # equal centers: the first counts
        want = sorted(map(str, df.select("x", "y", km._nearest(at, centers)["id"].alias("id")).collect()))
        plan = km._placed(df, at, centers)
        assert sorted(map(str, plan.collect())) == want and "struct" not in plan._jdf.queryExecution().optimizedPlan().toString()
        monkeypatch.setattr(km, "_PLAIN_CENTERS", 0)
        assert sorted(map(str, km._placed(df, at, centers).collect())) == want
        monkeypatch.undo()

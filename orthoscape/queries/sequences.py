"""E, F, G: sequential operators, order and top-k, set operations and dataset algebra."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import algebra as alg
from ..operators import sequential as seq
from .joining import _EDGES, _POINTS, centres, edges
from .registry import query, table


@query("E01_dense_index", "SELECT l_orderkey, dense_rank() OVER (ORDER BY l_orderkey) - 1 AS frame_id FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 40)")
def dense_index(spark, sf):
    kept = table(spark, sf, "lineitem").filter("l_quantity > 40").select("l_orderkey").distinct()
    return seq.dense_index(kept, "l_orderkey", "frame_id")


_DAYS = "(SELECT DISTINCT o_custkey % 20 AS scene, (epoch(o_orderdate)::BIGINT // 86400) AS day FROM orders)"


def days(spark, sf):
    return table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("scene"), F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long").alias("day")).distinct()


@query("E02_capped_islands", f"""WITH a AS (SELECT scene, day, CASE WHEN day - lag(day) OVER (PARTITION BY scene ORDER BY day) > 1 THEN 1 ELSE 0 END AS j FROM {_DAYS}), b AS (SELECT scene, day, sum(j) OVER (PARTITION BY scene ORDER BY day ROWS UNBOUNDED PRECEDING) AS run FROM a),
 c AS (SELECT scene, day, run, (row_number() OVER (PARTITION BY scene, run ORDER BY day) - 1) // 4 AS part FROM b) SELECT scene, day, dense_rank() OVER (PARTITION BY scene ORDER BY run, part) - 1 AS island FROM c""")
def capped_islands(spark, sf):
    return seq.islands(days(spark, sf), "day", ["scene"], 4).select("scene", "day", "island")


@query("E03_greedy_prune", f"""WITH RECURSIVE p AS (SELECT label, vec_id, x, y, (vec_id * 37) % 360 AS a, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM {_POINTS}),
 w AS (SELECT label, i, vec_id, x AS lx, y AS ly, a AS la, true AS kept FROM p WHERE i = 1 UNION ALL
  SELECT p.label, p.i, p.vec_id, CASE WHEN k THEN p.x ELSE lx END, CASE WHEN k THEN p.y ELSE ly END, CASE WHEN k THEN p.a ELSE la END, k FROM (SELECT p.*, w.lx, w.ly, w.la, sqrt((p.x - lx) * (p.x - lx) + (p.y - ly) * (p.y - ly)) > 0.25 OR least(abs(p.a - la) % 360, 360 - abs(p.a - la) % 360) > 120 AS k FROM w JOIN p ON p.label = w.label AND p.i = w.i + 1) p)
 SELECT label, vec_id FROM w WHERE kept""")
def greedy_prune(spark, sf):
    p = centres(spark, sf).withColumn("a", (F.col("vec_id") * 37) % 360)
    return seq.greedy_prune(p, ["label"], "vec_id", ["x", "y"], "a", 0.25, 120.0).select("label", "vec_id")


@query("E04_yaw", f"SELECT vec_id, round(degrees(atan2(coalesce(lead(y) OVER w, y) - y, coalesce(lead(x) OVER w, x) - x)), 6) AS yaw FROM {_POINTS} WINDOW w AS (PARTITION BY label ORDER BY vec_id)")
def yaw(spark, sf):
    w = Window.partitionBy("label").orderBy("vec_id")
    dx, dy = (F.coalesce(F.lead(c).over(w), F.col(c)) - F.col(c) for c in ("x", "y"))
    return centres(spark, sf).select("vec_id", F.round(F.degrees(F.atan2(dy, dx)), 6).alias("yaw"))


@query("E05_snake", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey ELSE -l_orderkey END) - 1 AS step FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem)")
def snake(spark, sf):
    l = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber").distinct()
    return seq.boustrophedon(l, ["l_suppkey"], "l_linenumber", "l_orderkey").select("l_orderkey", "l_linenumber", "step")


@query("E06_interpolate", f"""WITH s AS (SELECT label, vec_id, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny, row_number() OVER w AS i FROM {_POINTS} WINDOW w AS (PARTITION BY label ORDER BY vec_id))
 SELECT label, vec_id, k::INT AS k, round(x + (nx - x) * k / 4, 6) AS px, round(y + (ny - y) * k / 4, 6) AS py FROM s, range(0, 5) t(k) WHERE nx IS NOT NULL AND (i = 1 OR k > 0)""")
def interpolate(spark, sf):
    w = Window.partitionBy("label").orderBy("vec_id")
    s = centres(spark, sf).withColumn("nx", F.lead("x").over(w)).withColumn("ny", F.lead("y").over(w)).withColumn("i", F.row_number().over(w)).filter(F.col("nx").isNotNull())
    k = s.withColumn("k", F.explode(F.sequence(F.when(F.col("i") == 1, 0).otherwise(1), F.lit(4))))
    return k.select("label", "vec_id", "k", F.round(F.col("x") + (F.col("nx") - F.col("x")) * F.col("k") / 4, 6).alias("px"), F.round(F.col("y") + (F.col("ny") - F.col("y")) * F.col("k") / 4, 6).alias("py"))


@query("E07_csr_offsets", f"WITH d AS (SELECT src, count(*) AS n FROM {_EDGES} WHERE w >= 0.28 GROUP BY 1), v AS (SELECT s_suppkey AS src, coalesce(n, 0) AS n FROM supplier LEFT JOIN d ON src = s_suppkey) SELECT src, n, (sum(n) OVER (ORDER BY src ROWS UNBOUNDED PRECEDING))::BIGINT AS indptr FROM v")
def csr_offsets(spark, sf):
    from ..sources.csr import offsets

    nodes = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("src"))
    return offsets(edges(spark, sf).filter("w >= 0.28"), nodes)


@query("E08_moving", "SELECT event_id, round(avg(value) OVER w, 6) AS mean, (SELECT NULL) IS NULL AND max(value) OVER w IS NOT NULL AS ok, max(value) OVER w AS top, quantile_disc(value, 0.5) OVER w AS med FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def moving(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-4, 0)
    values = F.sort_array(F.collect_list("value").over(w))
    low = F.element_at(values, F.ceil(F.size(values) / 2).cast("int"))
    return table(spark, sf, "events").select("event_id", F.round(F.avg("value").over(w), 6).alias("mean"), F.max("value").over(w).isNotNull().alias("ok"), F.max("value").over(w).alias("top"), low.alias("med"))


@query("E10_ping_pong", "SELECT s_suppkey, list_transform(range(0, 9), lambda i: (CASE WHEN n = 1 THEN 0 WHEN i % (2 * n - 2) < n THEN i % (2 * n - 2) ELSE 2 * n - 2 - i % (2 * n - 2) END)::INT) AS idx FROM (SELECT s_suppkey, (1 + s_suppkey % 6) AS n FROM supplier)")
def ping_pong(spark, sf):
    n = (1 + F.col("s_suppkey") % 6).cast("int")
    return table(spark, sf, "supplier").select("s_suppkey", seq.ping_pong(n, F.lit(9)).alias("idx"))


@query("E11_interleave", "SELECT conv_id, text, pos, list_id FROM (SELECT conv_id, turn AS pos, CASE role WHEN 'user' THEN 0 ELSE 1 END AS list_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, CASE role WHEN 'user' THEN 0 ELSE 1 END) r FROM conversations) WHERE r <= 4")
def interleave(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "text", F.col("turn").alias("pos"), F.when(F.col("role") == "user", 0).otherwise(1).alias("list_id"))
    r = F.row_number().over(Window.partitionBy("conv_id").orderBy("pos", "list_id"))
    return c.withColumn("r", r).filter("r <= 4").select("conv_id", "text", "pos", "list_id")


@query("E12_resample", f"WITH p AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM {_POINTS}) SELECT p.label, k, p.vec_id FROM p, range(0, 7) t(k) WHERE p.i = round_even(k * (n - 1) / 6.0::DOUBLE, 0)::BIGINT")
def resample(spark, sf):
    p = centres(spark, sf).withColumn("i", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")).cast("long") - 1).select("label", "vec_id", "i")
    n = p.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(6)))).withColumn("k", F.col("k").cast("long"))
    want = n.withColumn("i", seq.resample_index(F.col("k"), 7, F.col("n"))).select("label", "k", "i")
    return p.join(want, ["label", "i"]).select("label", "k", "vec_id")


@query("F02_topk_in_step", f"SELECT src, dst, rank FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) AS rank FROM {_EDGES}) WHERE rank <= 3")
def topk_in_step(spark, sf):
    from ..plans.covisibility import strongest

    return strongest(edges(spark, sf), 3, 0.0).select("src", "dst", "rank")


@query("F03_stable_sort", "SELECT s_suppkey, row_number() OVER (ORDER BY s_nationkey, s_name) - 1 AS place FROM supplier")
def stable_sort(spark, sf):
    s = table(spark, sf, "supplier").withColumn("k", F.concat(F.lpad(F.col("s_nationkey").cast("string"), 6, "0"), "s_name"))
    return seq.dense_index(s.select("s_suppkey", "k"), "k", "place").select("s_suppkey", "place")


@query("F04_closest_ratio", "SELECT p_partkey, arg_min(r, (abs(p_size / 30.0::DOUBLE - r), r)) AS ratio FROM part, (VALUES (0.5::DOUBLE), (1.0), (1.5)) t(r) GROUP BY 1")
def closest_ratio(spark, sf):
    r = F.array(*map(F.lit, (0.5, 1.0, 1.5)))
    best = F.array_min(F.transform(r, lambda x: F.struct(F.abs(F.col("p_size") / 30.0 - x).alias("d"), x.alias("r"))))
    return table(spark, sf, "part").select("p_partkey", best["r"].alias("ratio"))


@query("F05_limit", "SELECT s_suppkey FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 12")
def limit(spark, sf):
    return table(spark, sf, "supplier").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(12).select("s_suppkey")


@query("F06_shuffle", "SELECT s_suppkey, row_number() OVER (ORDER BY md5('42|' || s_name)) - 1 AS place FROM supplier")
def shuffle(spark, sf):
    from ..functions.rng import shuffle_key

    return seq.dense_index(table(spark, sf, "supplier").withColumn("h", shuffle_key(42, F.col("s_name"))), "h", "place").select("s_suppkey", "place")


def _stems(spark, sf):
    a = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("stem"))
    b = table(spark, sf, "lineitem").filter("l_linenumber = 3").select(F.col("l_orderkey").alias("stem"))
    return a, b


_A, _B = "SELECT o_orderkey AS stem FROM orders WHERE o_orderstatus = 'F'", "SELECT l_orderkey AS stem FROM lineitem WHERE l_linenumber = 3"


@query("G01_intersect", f"{_A} INTERSECT {_B}")
def intersect(spark, sf):
    a, b = _stems(spark, sf)
    return a.intersect(b)


@query("G01_except", f"{_A} EXCEPT {_B}")
def except_(spark, sf):
    a, b = _stems(spark, sf)
    return a.distinct().join(b, "stem", "left_anti")


@query("G01_union", f"{_A} UNION {_B}")
def union(spark, sf):
    a, b = _stems(spark, sf)
    return a.union(b).distinct()


@query("G02_concatenate", "SELECT 'nation' AS dataset, n_nationkey::BIGINT AS local, n_nationkey::BIGINT AS index FROM nation UNION ALL SELECT 'region', r_regionkey::BIGINT, r_regionkey + 25 FROM region")
def concatenate(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("local"))
    r = table(spark, sf, "region").select(F.col("r_regionkey").cast("long").alias("local"))
    return alg.concatenated([("nation", n), ("region", r)]).select("dataset", "local", "index")


@query("G02_locate", "SELECT s_suppkey, CASE WHEN s_suppkey < 25 THEN 'nation' ELSE 'region' END AS dataset, CASE WHEN s_suppkey < 25 THEN s_suppkey ELSE s_suppkey - 25 END AS local FROM supplier WHERE s_suppkey < 30")
def locate(spark, sf):
    sizes = spark.createDataFrame([("nation", 25), ("region", 5)], "dataset string, size long")
    return alg.locate(table(spark, sf, "supplier").select("s_suppkey"), sizes, "s_suppkey")


@query("G03_repeat", "SELECT s_suppkey * 3 + k AS s_suppkey, s_suppkey AS source_index FROM supplier, range(0, 3) t(k)")
def repeat(spark, sf):
    return alg.repeated(table(spark, sf, "supplier").select("s_suppkey"), 3, "s_suppkey")


@query("G04_resize", "WITH r AS (SELECT s_suppkey, row_number() OVER (ORDER BY md5('779|' || s_suppkey)) - 1 AS r, count(*) OVER () AS n FROM supplier) SELECT s_suppkey, k::INT AS repetition, k * n + r AS position FROM r, range(0, 3) t(k) WHERE k * n + r < 2 * n + n // 3")
def resize(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey")
    n = s.count()
    return alg.resized(s, 2 * n + n // 3, 2, "s_suppkey").select("s_suppkey", "repetition", "position")


@query("G05_subset", "SELECT count(*) FILTER (NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.k)) = 0 AS is_subset FROM (SELECT DISTINCT l_orderkey k FROM lineitem) l")
def subset(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    lost = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")).join(o, "k", "left_anti")
    return lost.agg((F.count(F.lit(1)) == 0).alias("is_subset"))


@query("G06_noise_list", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT item_id FROM benchmark)")
def noise_list(spark, sf):
    noise = table(spark, sf, "benchmark").select(F.col("item_id").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey").join(noise, "c_custkey", "left_anti")

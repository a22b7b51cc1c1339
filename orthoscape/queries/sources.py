"""A: sources, sinks and catalogs, over texts and paths made from the tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import names
from ..sources import binary, catalog, csr, text
from .filtering import pixels
from .joining import edges
from .registry import query, table


def camera_texts(spark, sf):
    """Camera files of parts: rotation about z by p_size degrees, centre from the price."""
    a = F.radians(F.col("p_size").cast("double"))
    c, s, z, o = F.round(F.cos(a), 6), F.round(F.sin(a), 6), F.lit(0.0), F.lit(1.0)
    e = F.array(c, -s, z, F.lit(1.0), s, c, z, F.lit(2.0), z, z, o, F.col("p_size").cast("double"), z, z, z, o)
    k = F.array(F.col("p_retailprice"), z, F.lit(320.0), z, F.col("p_retailprice"), F.lit(240.0), z, z, o)
    return table(spark, sf, "part").select("p_partkey", text.format_camera(e, k, F.lit(480), F.lit(640), F.lit(60.0)).alias("value"))


@query("A04_camera_text", "SELECT p_partkey, p_partkey % 9 <> 0 AS ok, CASE WHEN p_partkey % 9 <> 0 THEN round(-(round(cos(radians(p_size)), 6) * 1.0 + round(sin(radians(p_size)), 6) * 2.0), 6) + 0.0 END AS cx, CASE WHEN p_partkey % 9 <> 0 THEN round(p_retailprice, 6) END AS fx, CASE WHEN p_partkey % 9 <> 0 THEN 640 END::INT AS w FROM part")
def camera_text(spark, sf):
    broken = F.when(F.col("p_partkey") % 9 == 0, F.regexp_replace("value", "intrinsic\n[^\n]*\n", "intrinsic\n")).otherwise(F.col("value"))
    c = camera_texts(spark, sf).select("p_partkey", text.camera_file(broken).alias("c"))
    return c.select("p_partkey", "c.ok", (F.round(F.get("c.pose", F.lit(3)), 6) + 0.0).alias("cx"), F.round(F.get("c.k", F.lit(0)), 6).alias("fx"), "c.w")


@query("A05_quick_hfov", "SELECT p_partkey, round_even(degrees(2 * atan(640 / (2 * p_retailprice))), 0)::INT AS hfov FROM part")
def quick_hfov(spark, sf):
    return camera_texts(spark, sf).select("p_partkey", text.quick_hfov(F.col("value")).alias("hfov"))


@query("A06_camera_centre", "SELECT p_partkey, round(-(-round(sin(radians(p_size)), 6) * 1.0 + round(cos(radians(p_size)), 6) * 2.0), 6) + 0.0 AS cy, -p_size::DOUBLE AS cz FROM part")
def camera_centre(spark, sf):
    from ..functions.camera import centre

    c = centre(text.camera_file(F.col("value"))["extrinsic"])
    return camera_texts(spark, sf).select("p_partkey", (F.round(c[1], 6) + 0.0).alias("cy"), c[2].alias("cz"))


@query("A07_camera_sink", "SELECT p_partkey, format('{:.12f} 0.000000000000 320.000000000000', p_retailprice) AS line, '480 640 60.000000000000' AS trailer FROM part")
def camera_sink(spark, sf):
    lines = F.split("value", "\n")
    return camera_texts(spark, sf).select("p_partkey", F.get(lines, F.lit(7)).alias("line"), F.get(lines, F.lit(12)).alias("trailer"))


@query("A08_colmap_images", "SELECT s_suppkey::INT AS image_id, s_acctbal AS tx, s_nationkey::INT AS camera_id, 'view ' || s_name AS name FROM supplier")
def colmap_images(spark, sf):
    head = F.concat_ws(" ", F.col("s_suppkey").cast("string"), F.lit("1 0 0 0"), F.col("s_acctbal").cast("decimal(12,2)").cast("string"), F.lit("0 0"), F.col("s_nationkey").cast("string"), F.concat(F.lit("view "), F.col("s_name")))
    files = table(spark, sf, "supplier").select(F.concat(F.lit("# images\n"), head, F.lit("\n1.0 2.0 -1\n")).alias("value"))
    return text.colmap_images(files, "value").select("image_id", "tx", "camera_id", "name")


@query("A08_colmap_cameras", "SELECT p_partkey::INT AS camera_id, 'PINHOLE' AS model, [p_retailprice, p_size::DOUBLE] AS params FROM part")
def colmap_cameras(spark, sf):
    files = table(spark, sf, "part").select(F.concat(F.lit("# cameras\n"), F.concat_ws(" ", F.col("p_partkey").cast("string"), F.lit("PINHOLE 640 480"), F.col("p_retailprice").cast("string"), F.col("p_size").cast("string"))).alias("value"))
    return text.colmap_cameras(files, "value").select("camera_id", "model", "params")


@query("A09_headed_table", "SELECT 'img' || s_suppkey AS label, s_acctbal AS omega FROM supplier WHERE s_suppkey % 4 <> 0")
def headed_table(spark, sf):
    row = F.concat_ws(" ", F.concat(F.lit("img"), F.col("s_suppkey").cast("string")), F.col("s_acctbal").cast("decimal(12,2)").cast("string"), F.when(F.col("s_suppkey") % 4 == 0, "7 8").otherwise("7"))
    files = table(spark, sf, "supplier").select(F.concat(F.lit("# label omega[deg] c\n"), row).alias("value"))
    return text.headed_table(files, "value").select(F.col("values")["label"].alias("label"), F.col("values")["omega[deg]"].cast("double").alias("omega"))


@query("A10_csv_tasks", "SELECT c_name AS label, c_acctbal AS x FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def csv_tasks(spark, sf):
    line = table(spark, sf, "customer").select("c_custkey", F.concat_ws(",", "c_name", F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("l"))
    rows = line.select("c_custkey", F.from_csv("l", "label string, x double").alias("r")).select("c_custkey", "r.*")
    done = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return rows.join(done, "c_custkey", "left_anti").select("label", "x")


@query("A11_calibration", "SELECT p_name AS name, p_retailprice AS fx, p_size::DOUBLE AS cx FROM part")
def calibration(spark, sf):
    cam = F.struct(F.col("p_name").alias("name"), F.col("p_retailprice").alias("fx"), F.col("p_retailprice").alias("fy"), F.col("p_size").cast("double").alias("cx"), F.lit(0.0).alias("cy"))
    files = table(spark, sf, "part").select(F.to_json(F.array(cam)).alias("value"))
    return text.calibration(files, "value").select("name", "fx", "cx")


@query("A12_column_major", "SELECT p_partkey, [1.0, 4.0, 7.0, 2.0, p_size, 8.0, 3.0, 6.0, 9.0]::DOUBLE[] AS m FROM part")
def column_major(spark, sf):
    line = F.concat_ws(" ", F.lit("1 2 3 4"), F.col("p_size").cast("string"), F.lit("6 7 8 9"))
    flat = names.float_list(line)
    turned = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda j: F.get(flat, j * 3 + i))))
    return table(spark, sf, "part").select("p_partkey", turned.alias("m"))


@query("A13_pfm", "SELECT vec_id, 8 AS h, 8 AS w, round(embedding[64]::DOUBLE, 5) AS last FROM embeddings")
def pfm(spark, sf):
    @F.pandas_udf("binary")
    def encode(v: pd.Series) -> pd.Series:
        return v.map(lambda x: binary.format_pfm(np.asarray(x, "f4").reshape(8, 8)))

    files = table(spark, sf, "embeddings").select("vec_id", encode("embedding").alias("content"))
    return binary.decoded(files, "vec_id", "content", binary.parse_pfm).select("vec_id", "h", "w", F.round(F.element_at("values", 64), 5).alias("last"))


@query("A14_raster_rows", "SELECT vec_id, count(*) AS n, round(sum(v::DOUBLE), 4) AS total FROM (SELECT vec_id, unnest(embedding) AS v FROM embeddings) GROUP BY 1")
def raster_rows(spark, sf):
    r = table(spark, sf, "embeddings").select("vec_id", F.lit(8).alias("w"), F.col("embedding").cast("array<double>").alias("values"))
    return binary.to_pixels(r, ["vec_id"]).groupBy("vec_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("z"), 4).alias("total"))


@query("A14_png_depth", "SELECT vec_id, 8 AS h, 8 AS w, list_transform(range(1, 65), lambda i: floor(abs(embedding[i]::DOUBLE) * 10000) % 65536)::DOUBLE[] AS values FROM embeddings")
def png_depth(spark, sf):
    """Depth in sixteen bits, written as PNG and read again."""

    @F.pandas_udf("binary")
    def encode(v: pd.Series) -> pd.Series:
        return v.map(lambda x: binary.format_png((np.floor(np.abs(np.asarray(x, "f8")) * 10000) % 65536).astype(np.uint16).reshape(8, 8)))

    files = table(spark, sf, "embeddings").select("vec_id", encode(F.col("embedding").cast("array<double>")).alias("content"))
    return binary.decoded(files, "vec_id", "content", binary.parse_png)


@query("A15_colour_labels", "SELECT p_partkey, CASE WHEN p_size % 7 < 5 THEN p_size % 7 + 1 ELSE 0 END AS id FROM part")
def colour_labels(spark, sf):
    pal = table(spark, sf, "region").select((F.col("r_regionkey") * 10).alias("r"), (F.col("r_regionkey") * 20).alias("g"), F.lit(5).alias("b"), (F.col("r_regionkey") + 1).alias("id"))
    n = F.col("p_size") % 7
    px = table(spark, sf, "part").select("p_partkey", (n * 10).alias("r"), (n * 20).alias("g"), F.lit(5).alias("b"))
    return binary.labels_of_colours(px, pal)


@query("A16_csr_round_trip", "WITH s AS (SELECT DISTINCT l_suppkey v, l_partkey p FROM lineitem), n AS (SELECT v, count(*) n FROM s GROUP BY 1) SELECT a.v AS src, b.v AS dst, round((count(*) / any_value(n.n)::DOUBLE)::FLOAT::DOUBLE, 6) AS w FROM s a JOIN s b ON a.p = b.p AND a.v <> b.v JOIN n ON n.v = b.v GROUP BY 1, 2 HAVING count(*) / any_value(n.n)::DOUBLE >= 0.3")
def csr_round_trip(spark, sf):
    e = edges(spark, sf).filter("w >= 0.3").select(F.lit("all").alias("scene"), "src", "dst", "w")
    return csr.from_csr(csr.to_csr(e)).select("src", "dst", F.round("w", 6).alias("w"))


@query("A17_hfov_json", "SELECT 'd' AS dataset, '{' || string_agg('\"' || s || '\":{\"hfovs\":[' || h || ']}', ',' ORDER BY s) || '}' AS json FROM (SELECT 's' || lpad(p_size::VARCHAR, 2, '0') AS s, string_agg(DISTINCT round_even(degrees(2 * atan(1000 / (2 * p_retailprice))), 0)::INT::VARCHAR, ',' ORDER BY round_even(degrees(2 * atan(1000 / (2 * p_retailprice))), 0)::INT::VARCHAR) AS h FROM part GROUP BY 1)")
def hfov_json(spark, sf):
    from ..functions.camera import hfov

    h = F.bround(hfov(F.lit(1000.0), F.col("p_retailprice")), 0).cast("int")
    s = table(spark, sf, "part").groupBy(F.concat(F.lit("s"), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("scene")).agg(F.sort_array(F.collect_set(h)).alias("hfovs"))
    return catalog.hfov_json(s.withColumn("dataset", F.lit("d")))


@query("A18_files_by_stem", "SELECT 'd/img' || k || '.' || CASE WHEN has_png THEN 'png' ELSE 'JPG' END AS path, 'img' || k AS stem FROM (SELECT o_custkey AS k, bool_or(o_orderstatus = 'F') AS has_png, bool_or(o_orderstatus = 'O') AS has_jpg FROM orders GROUP BY 1) WHERE has_png OR has_jpg")
def files_by_stem(spark, sf):
    suffix = F.when(F.col("o_orderstatus") == "F", "png").when(F.col("o_orderstatus") == "O", "JPG").otherwise("gif")
    p = table(spark, sf, "orders").select(F.concat(F.lit("d/img"), F.col("o_custkey").cast("string"), F.lit("."), suffix).alias("path"))
    return catalog.files_by_stem(p, [], "path", [".png", ".jpg"]).select("path", "stem")


@query("A19_complete_scenes", "SELECT c_mktsegment AS dataset, c_nationkey AS scene FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 10 < 3 GROUP BY 1, 2 HAVING count(DISTINCT c_custkey % 10) = 3")
def complete_scenes(spark, sf):
    kind = F.get(F.array(F.lit("images"), F.lit("cams"), F.lit("depth"), F.lit("mask")), (F.col("c_custkey") % 10).cast("int"))
    f = table(spark, sf, "customer").filter("c_custkey % 10 < 4").select(F.col("c_mktsegment").alias("dataset"), F.col("c_nationkey").alias("scene"), kind.alias("kind"))
    return catalog.complete_scenes(f, ["images", "cams", "depth"], ["BUILDING", "MACHINERY"])


@query("A20_process_log", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS state FROM orders")
def process_log(spark, sf):
    doc = F.when(F.col("o_orderkey") % 5 == 0, F.when(F.col("o_orderkey") % 2 == 0, "{broken")).otherwise(F.to_json(F.create_map(F.lit("depth"), F.struct(F.col("o_orderstatus").alias("state")))))
    log = text.process_log(doc)
    return table(spark, sf, "orders").select("o_orderkey", F.element_at(log, "depth")["state"].alias("state"))


@query("A21_manifest", "SELECT s_suppkey, s_name || ',' || format('{:.6f}', s_acctbal) AS line FROM supplier")
def manifest(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", F.concat_ws(",", "s_name", F.format_string("%.6f", "s_acctbal")).alias("line"))


@query("A22_links", "SELECT page_id, link FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS link FROM pages) WHERE regexp_matches(link, '[0-9]')")
def links(spark, sf):
    return catalog.links(table(spark, sf, "pages").select("page_id", "html"), "html", "[0-9]")


@query("A23_scene_frames", "SELECT l_suppkey AS scene, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) - 1 AS frame_idx, l_orderkey FROM lineitem")
def scene_frames(spark, sf):
    f = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("scene"), F.struct("l_orderkey", "l_linenumber").alias("name"), "l_orderkey")
    meta = catalog.scene_metadata(f, ["scene"], "name", ["l_orderkey"])
    return catalog.frames_of(meta, ["scene"]).select("scene", F.col("frame_idx").cast("long").alias("frame_idx"), "l_orderkey")


@query("A24_scene_load", "SELECT vec_id, count(*) FILTER (z > 0) AS n_valid, round(max(z * (x - 1.5) / 3), 5) AS right_most FROM (SELECT vec_id, ((i - 1) // 16) AS y, ((i - 1) % 8) // 2 AS x, embedding[i]::DOUBLE AS z FROM embeddings, range(1, 65) t(i) WHERE ((i - 1) // 8) % 2 = 0 AND ((i - 1) % 8) % 2 = 0) GROUP BY 1")
def scene_load(spark, sf):
    half = pixels(spark, sf).filter("y % 2 = 0 AND x % 2 = 0").select("vec_id", F.floor(F.col("x") / 2).alias("x"), "z")
    return half.groupBy("vec_id").agg(F.count_if(F.col("z") > 0).alias("n_valid"), F.round(F.max(F.col("z") * (F.col("x") - 1.5) / 3), 5).alias("right_most"))


@query("A25_video_frames", "SELECT c_custkey, k::INT AS k, round(c_acctbal + k / 2.0::DOUBLE, 6) AS t FROM customer, range(0, 12) x(k) WHERE k < (c_custkey % 6) * 2")
def video_frames(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("s"), (F.col("c_acctbal") + F.col("c_custkey") % 6).alias("e"), F.lit(2.0).alias("fps"))
    return catalog.video_frames(c, ["c_custkey"], "s", "e", "fps").select("c_custkey", "k", F.round("t", 6).alias("t"))


@query("A26_regroup", "SELECT o_orderkey, 'out/scene' || (o_custkey % 7) || '/img' || (o_orderkey % 400) || '.jpg' AS out_path, count(*) OVER (PARTITION BY o_custkey % 7, o_orderkey % 400) - 1 AS conflicts FROM orders")
def regroup(spark, sf):
    f = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit("in/a/img"), (F.col("o_orderkey") % 400).cast("string"), F.lit(".jpg")).alias("path"))
    return catalog.regrouped(f, F.concat(F.lit("scene"), (F.col("o_custkey") % 7).cast("string")), "out").select("o_orderkey", "out_path", "conflicts")

"""The pipeline against a brute-force version of its stages."""

from __future__ import annotations

import collections

import corpus_pipeline as cp
from pyspark.sql import functions as F
from test_operators import brute_components, corpus


def test_stages(spark, tmp_path):
    docs, labels, _ = corpus(spark, 300)
    rows = docs.collect()
    extra = [(1000 + i, rows[i].text, *rows[i][2:]) for i in range(0, 60, 3)]  # exact copies
    extra += [(2000 + i, rows[i].text + " tail", *rows[i][2:]) for i in range(0, 60, 4)]  # near copies
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    labels.write.parquet(f"{sf}/labels.parquet")

    from orthoscape.llm.quality import quality_scores

    good = {r.doc_id for r in quality_scores(spark, docs, labels).filter("predicted = 1").collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    best = {}
    for i in sorted(good):
        best[text[i]] = i
    kept = sorted(best.values())
    found = brute_components([text[i] for i in kept], cp.WIDTH, cp.PERCENT)
    want = {kept[i] for i, (n, root, _) in found.items() if root == i}

    out = cp.run(spark, sf).collect()
    assert {r.doc_id for r in out} == want
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        end = 0
        for a, n in sorted(own):
            assert a == end
            end += n
        assert end <= 4096


def test_stages_keep_the_columns(spark, tmp_path):
    docs, labels, _ = corpus(spark, 120)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for _, f in cp.STAGES[:-1]:
        docs2 = f(spark, docs, str(tmp_path))
        assert docs2.columns == docs.columns
        assert docs2.count() <= docs.count()


def test_odd_rows(spark, tmp_path):
    """Repeated and null ids, nulls, equal rows and clashing columns: each stage keeps one row of a group, whole."""
    docs, labels, _ = corpus(spark, 60)
    rows = docs.filter("doc_id < 20").collect()
    near = rows[5].text + " tail"
    odd = [tuple(rows[3]), tuple(rows[3]), (None, rows[4].text, *rows[4][2:]), (None, None, *rows[4][2:]), (None, None, *rows[4][2:]), (3, near, *rows[5][2:]), (None, near + " x", *rows[5][2:]), (7, "", *rows[7][2:]), (7, " ", None, None, None, None, None, None, None)]
    docs = spark.createDataFrame([*map(tuple, docs.collect()), *odd], docs.schema).withColumn("_place", F.lit("p")).withColumn("slot", F.col("doc_id")).withColumn("row", F.lit(1))
    docs = docs.withColumnRenamed("_place", "place")
    all_rows = sorted(map(repr, docs.collect()))
    exact = cp.dedup_exact(spark, docs, "").collect()
    by = collections.defaultdict(list)
    for r in docs.collect():
        by[r.text or ""].append(r)
    assert sorted(r.text or "" for r in exact) == sorted(by) and {repr(r) for r in exact} <= set(all_rows)
    for r in exact:
        ids = [x.doc_id for x in by[r.text or ""] if x.doc_id is not None]
        assert r.doc_id == max(ids, default=None)
    kept = spark.createDataFrame(exact, docs.schema)
    groups = collections.defaultdict(list)
    for i, (_, root, _) in brute_components([r.text for r in exact], cp.WIDTH, cp.PERCENT).items():
        groups[root].append(exact[i])
    out = cp.dedup_near(spark, kept, "").collect()
    want = [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0)).doc_id for g in groups.values()]
    assert sorted(repr(r.doc_id) for r in out) == sorted(map(repr, want))
    mixed = cp.mix(spark, kept, "").collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, exact))
    packed = cp.pack_sequences(spark, kept, "").collect()
    assert sorted(repr(r.doc_id) for r in packed) == sorted(repr(r.doc_id) for r in exact)


def test_empty_table(spark, tmp_path):
    docs, labels, _ = corpus(spark, 4)
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_rows_are_judged_by_themselves(spark, tmp_path):
    """A bad row goes though a good one has its id."""
    docs, labels, truth = corpus(spark, 300)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bad = next(t[0] for t in truth if not t[1])
    twin = docs.filter(F.col("doc_id") == bad).withColumn("doc_id", F.lit(next(t[0] for t in truth if t[1])).cast("long"))
    text = twin.first().text
    assert text not in {r.text for r in cp.classify(spark, docs.unionByName(twin), str(tmp_path)).collect()}


def test_mix_takes_effect(spark, tmp_path):
    docs, _, _ = corpus(spark, 100)
    from orthoscape.llm.mixing import mix_sources

    order = [r.doc_id for r in sorted(mix_sources(spark, docs).collect(), key=lambda r: r.mix_position)]
    assert [r.doc_id for r in cp.mix(spark, docs, "").collect()] == order


def test_weights_and_the_mix_reach_the_output(spark, tmp_path, monkeypatch):
    docs, labels, _ = corpus(spark, 400)
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 8 == 0, "rare").otherwise("hot")).withColumn("text", F.repeat("text", 12))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    def sequences(weights, stages):
        monkeypatch.setattr(cp, "WEIGHTS", weights)
        monkeypatch.setattr(cp, "STAGES", stages)
        out = cp.run(spark, str(tmp_path)).collect()
        by = collections.defaultdict(list)
        for r in out:
            by[r.sequence_id].append((r.offset, r.length, r.doc_id, r.piece, r.start, r.ids_crc32))
        assert sorted(by) == list(range(len(by))) and len(by) > 20
        for own in by.values():
            own.sort()
            assert [a for a, *_ in own] == [sum(x[1] for x in own[:i]) for i in range(len(own))] and sum(x[1] for x in own) <= 4096
        return sorted(x[2:] for own in by.values() for x in own), [by[i][0][2:4] for i in range(len(by))], out

    last = cp.STAGES[3:]
    rows, even, out = sequences({"hot": 1.0, "rare": 1.0}, last)
    others, few, _ = sequences({"hot": 20.0, "rare": 1.0}, last)
    unmixed, plain, _ = sequences({"hot": 1.0, "rare": 1.0}, last[1:])
    assert rows == others == unmixed and {x[0] for x in rows} == set(range(400))
    assert even != few and even != plain

    from orthoscape.llm.mixing import mix_sources

    place = {r.doc_id: r.mix_position for r in mix_sources(spark, docs, {"hot": 1.0, "rare": 1.0}).collect()}
    heads = [(place[i], piece) for i, piece in even]
    assert heads == sorted(heads)
    fills = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        if r.offset:
            fills[r.length].append((place[r.doc_id], r.piece))
    assert any(len(x) > 1 for x in fills.values()) and all(x == sorted(x) for x in fills.values())

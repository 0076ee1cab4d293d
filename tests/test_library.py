"""Micro fixtures with known answers: ties, bounds, nulls."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gristlane.functions import policy as P
from gristlane.functions import scalars as S
from gristlane.operators import dedup, graph, joins, metrics, sampling, sessions, similarity
from gristlane.sources import readers


def one(spark, **cols):
    return spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first()


def box(*v):
    return tuple(F.lit(float(x)) for x in v)


def test_boxes(spark):
    r = one(spark, a=S.iou(box(0, 0, 10, 10), box(0, 0, 10, 10)), b=S.iou(box(0, 0, 10, 10), box(20, 20, 30, 30)), c=S.iou(box(0, 0, 0, 0), box(0, 0, 0, 0)), d=S.iou(box(0, 0, 0, 0), box(0, 0, 0, 0), None), e=S.assignment(F.lit(0.5)), f=S.assignment(F.lit(0.1)), g=S.assignment(F.lit(0.3)))
    assert tuple(r) == (1.0, 0.0, 0.0, None, "truth", "background", "ambiguous")
    pts = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 3))])
    (x1, y1, x2, y2), twice = S.polygon_box(pts)
    assert tuple(one(spark, a=x1, b=y1, c=x2, d=y2, e=twice)) == (0, 0, 4, 3, 12)


def test_weight(spark):
    def w(cls, grams, ratio):
        return S.weight_anomaly(F.lit(cls), F.lit(grams), F.lit(ratio).cast("double"))

    r = one(spark, a=w("pet", 30.0, 0.05), b=w("pet", 30.1, 0.05), c=w("pet", 37.0, 0.10), d=w("pet", 60.1, 0.28), e=w("glass", 1000.1, None), f=w("other", 1e9, None), g=w("pet", 301.0, None), h=w("glass", 999.0, 0.5))
    assert tuple(r) == (False, True, False, True, True, False, True, False)


def test_guidance(spark):
    t, f, n = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    every = P.guidance(F.lit("pet"), t, t, t, t, t, f)
    r = one(spark, a=every, b=P.guidance(F.lit("paper"), t, n, t, n, n, n), c=P.guidance(F.lit("can"), n, n, n, n, n, n))
    assert r.a == [c for c in P.GUIDANCE if c != "WEIGHT_ANOMALY"] and r.b == ["WEIGHT_ANOMALY"] and r.c == []


def test_text(spark):
    r = one(spark, a=S.basename(F.lit("C:\\x\\Y.JPG")), b=S.unpad_base64url(F.lit("YS9i_w".replace("_w", ""))), c=S.distinct_list(F.lit("A, b,a ,,B")), d=S.valid_name(F.lit("a b")), e=S.external_class(F.lit(1)), f=S.category(F.lit("xbottle can"), {"can": 1, "bottle": 2}, 3), g=S.category(F.lit("none"), {"can": 1}, 3))
    assert tuple(r) == ("y.jpg", "a/b", ["a", "b"], False, 3, 1, 3)


def test_nearest(spark):
    t = dt.datetime(2026, 1, 1, 12)
    at = lambda s: t + dt.timedelta(seconds=s)
    left = spark.createDataFrame([(1, "u", at(0)), (2, "u", at(1000)), (3, "v", at(0)), (4, "u", at(500))], "l int, k string, lt timestamp")
    right = spark.createDataFrame([(1, "u", at(120)), (2, "u", at(-120)), (3, "u", at(1121)), (4, "u", at(499)), (5, "u", at(501))], "r int, k string, rt timestamp")
    got = {x.l: x.r for x in joins.nearest(left, right, "k", "lt", "rt", 120, "l", "r").collect()}
    assert got == {1: 1, 2: None, 3: None, 4: 4}


def test_sessions(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [(1, "a", t), (2, "a", t + dt.timedelta(seconds=60)), (3, "a", t + dt.timedelta(seconds=121)), (4, "a", None), (5, "a", None)]
    got = sorted(r.n for r in sessions.gap_sessions(spark.createDataFrame(rows, "id int, k string, ts timestamp"), "k", "ts", "id", 60).collect())
    assert got == [1, 1, 1, 2]


@pytest.mark.parametrize("distance", range(8))
def test_hamming(spark, distance):
    rng = random.Random(distance)
    values = [rng.getrandbits(64) for _ in range(60)]
    values += [v ^ sum(1 << b for b in rng.sample([*range(63), 63], rng.randint(0, 8))) for v in values]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame(list(enumerate(signed)), "k long, v long")
    want = {(i, j, (values[i] ^ values[j]).bit_count()) for i in range(120) for j in range(i + 1, 120) if (values[i] ^ values[j]).bit_count() <= distance}
    assert {tuple(r) for r in similarity.hamming_join(df, "k", "v", distance).collect()} == want


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_components(spark, one_task):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 150), (7, 7), (300, 300), (None, 1)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long"), one_task=one_task).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 200: 100, 150: 100, 300: 300}
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_stride_and_quota(spark):
    df = spark.range(103).withColumnRenamed("id", "k").repartition(5)
    for cap in (1, 7, 50, 103, 200):
        want = {int(i * (103 / cap)) for i in range(cap)} if cap < 103 else set(range(103))
        assert {r.k for r in sampling.stride(df, cap, "k").collect()} == want
    assert sampling.cyclic_repeat(df.withColumn("g", F.lit(1)), "g", 250, "s", "k").count() == 250
    assert sampling.oldest_first_budget(df.withColumn("size", F.lit(10)), "k", "size", "k", 55).count() == 5


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("-1", "a"), ("c", None)], "t string, p string")
    s = {r["class"]: r for r in metrics.class_scores(metrics.confusion(df, "t", "p")).collect()}
    assert s["a"].recall == 0.5 and s["b"].precision == 0.5 and s["c"].recall == 0 and s["none"].support == 0
    m = metrics.summary(metrics.class_scores(metrics.confusion(df, "t", "p"))).first()
    assert m.accuracy == 0.5 and abs(m.balanced_accuracy - 0.5) < 1e-12 and m.unsupported == 1
    d = spark.range(50)
    assert metrics.digest(d, "id").first() == metrics.digest(d.repartition(7), "id").first()


def test_precedence(spark):
    df = spark.createDataFrame([(1, "s1", "o1", "train"), (2, "s1", "o2", "val"), (3, "s3", "o2", "train"), (4, "s4", "o1", "train")], "k int, s string, o string, part string")
    got = {r.k: r.dropped_for for r in dedup.partition_precedence(df, ["s", "o"], "part", F.when(F.col("part") == "val", 1).otherwise(0), "k").collect()}
    assert got == {1: "s", 2: None, 3: "o", 4: None}


def test_label_lines(spark):
    texts = ["1.0 0.5 0.5 0.2 0.2", "", None, "1 0.5 0.5 0.2 0.2\n2 0 0 0 0", "x 0 0 1 1", "1 2 3", "9 .5 .5 .1 .1", "1 .5 .5 0 .1", "1 1.5 .5 .1 .1", "1.5 .5 .5 .1 .1", "1 NaN .5 .1 .1", "1 .041 .5 .1 .1", "1 .039 .5 .1 .1"]
    value, reason = readers.label_line(F.col("t"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", value.alias("v"), reason.alias("r")).orderBy("i").collect()
    assert [r.r for r in rows] == [None, None, None, "not_single_object", "non_numeric_label", "invalid_column_count", "invalid_class_id", "invalid_bbox", "invalid_bbox", "invalid_class_id", "non_finite_bbox", None, "bbox_outside_image"]
    assert rows[0].v.class_id == 1 and rows[1].v is None and rows[11].v is not None


def test_box_json(spark):
    """Boxes in three shapes, and the reason against each wrong one."""
    texts = ["[1, 2, 30, 40]", '{"x1": 1, "y1": 2, "x2": 30, "y2": 40}', '{"x": 1, "y": 2, "width": 29, "height": 38}', '{"x": 1}', None, "none", "[1, 2, 3]", '[1, 2, "a", 4]', "[1, 2, 300, 40]", "[5, 2, 5, 40]", "[1, 2, 3, 4]", "[0, 0, 100, 100]"]
    value, reason = S.parse_box(F.col("t"), F.lit(100.0), F.lit(100.0), 0.01, 0.9)
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", value.alias("v"), reason.alias("r")).orderBy("i").collect()
    assert [tuple(r.v) if r.v else r.r for r in got] == [(1, 2, 30, 40)] * 3 + ["bbox_invalid_shape", "bbox_missing", "bbox_missing", "bbox_missing", "bbox_non_numeric", "bbox_out_of_bounds", "bbox_out_of_bounds", "bbox_area_too_small", "bbox_area_too_large"]


def test_views_and_argmax(spark):
    arrays = lambda *v: F.array(*[F.array(*[F.lit(float(x)) for x in a]) for a in v])
    best, tied = S.argmax(F.array(*[F.lit(float(x)) for x in (1, 3, 2)]))
    none, both = S.argmax(F.array(*[F.lit(float(x)) for x in (3, 3, 2)]))
    assert tuple(one(spark, a=S.view_mean(arrays((1, 2), (3, 6))), b=S.view_mean(arrays((1, 2))), c=best, d=tied, e=none, f=both)) == ([2.0, 4.0], [1.0, 2.0], 1, False, None, True)


def test_recheck_without_second_opinion(spark):
    null = F.lit(None).cast("string")
    r = one(spark, a=P.conflict_recheck(F.lit("glass"), F.lit(0.9), null), b=P.conflict_recheck(F.lit("pet"), F.lit(0.9), null), c=P.conflict_recheck(F.lit("pet"), F.lit(0.9), F.lit("glass")), d=P.conflict_recheck(F.lit("glass"), F.lit(0.8), null))
    assert tuple(r) == (True, False, True, False)


@pytest.mark.parametrize("seed", range(3))
def test_greedy_resolution(spark, seed):
    """The rounds give what the sequence gives: a loser's later edges fall away, a winner goes on."""
    rng = random.Random(seed)
    edges = {}
    while len(edges) < 60:
        a, b = sorted(rng.sample(range(25), 2))
        edges[a, b] = (rng.randint(0, 4), rng.choice((a, b)))
    df = spark.createDataFrame([(a, b, d, w) for (a, b), (d, w) in edges.items()], "left long, right long, distance int, winner long")
    gone, want = set(), set()
    for (a, b), (d, w) in sorted(edges.items(), key=lambda e: (e[1][0], e[0])):
        if not {a, b} & gone:
            gone.add(a + b - w)
            want.add((a, b, w, a + b - w))
    got = dedup.greedy_resolution(df, "left", "right", "winner", "distance", "left", "right").collect()
    assert {(r.left, r.right, r.winner, r.loser) for r in got} == want


def test_quota_and_caps(spark):
    """Cutting each tier before the last ranking changes nothing; identities count once."""
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("t"), (F.col("id") % 40).alias("same"))
    assert sampling.quota(df, "g", 15, F.when(F.col("t") == 0, 0).when(F.col("t") < 3, 1).otherwise(2), "s", "k").groupBy("g").count().collect() and sampling.capped(df, "g", [2], 4, "s", "k").count() == 4 + 4 + 66
    got = sampling.distinct_capped(df, "same", ["t"], 3, "k").collect()
    assert sorted(r.k for r in got) == sorted(x for x in range(15))


def test_sources(spark, tmp_path):
    (tmp_path / "2026-01-01").mkdir()
    (tmp_path / "2026-01-01/a.json").write_text('{\n"id": "a"}')
    (tmp_path / "2026-01-01/b.json").write_text("{broken")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType())])
    assert [r.id for r in readers.captures(spark, str(tmp_path), schema, 10).collect()] == ["a"]
    (tmp_path / "log.jsonl").write_text('{"id": "1", "ts": "2026-01-01T00:00:00Z"}\nnot json\n{"id": "2", "ts": "2026-01-01T00:00:00"}\n')
    log = T.StructType([*schema.fields, T.StructField("ts", T.StringType())])
    assert [r.id for r in readers.json_lines(spark, str(tmp_path / "log.jsonl"), log, "ts").collect()] == ["1"]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "log.jsonl"), log, strict=True).collect()
    with pytest.raises(ValueError):
        readers.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_streaming(spark, tmp_path):
    from gristlane.streaming import usage

    t = dt.datetime(2026, 1, 1)
    rows = [(1, "a", 1.0, t), (2, "a", 2.0, t + dt.timedelta(hours=1)), (3, "b", 3.0, t + dt.timedelta(days=3))]
    df = spark.createDataFrame(rows, "id int, kind string, value double, ts timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    s = usage.usage(usage.stream(spark, str(tmp_path / "in"), df.schema), "ts", "kind")
    usage.into(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert [(r.kind, r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", 2, 3.0)]


def test_streaming_cooldown(spark, tmp_path):
    """A failure in one batch cools its provider in the next."""
    from gristlane.streaming import usage

    t = dt.datetime(2026, 1, 1)
    rows = [("a", 0, True), ("a", 200, False), ("a", 301, False), ("b", 5, False), ("a", 400, True), ("a", 500, True), ("a", 790, False), ("b", 600, False), ("a", 801, False)]
    df = spark.createDataFrame([(k, t + dt.timedelta(seconds=s), f) for k, s, f in rows], "kind string, ts timestamp, failed boolean")
    for part, n in ((0, 4), (4, 9)):
        spark.createDataFrame(df.collect()[part:n], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = usage.cooldown(usage.stream(spark, str(tmp_path / "in"), df.schema, files=1), "kind", "ts", "failed")
    usage.into(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = {(r.kind, int((r.ts - t).total_seconds())): r.cooling for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", 0): False, ("a", 200): True, ("a", 301): False, ("b", 5): False, ("a", 400): False, ("a", 500): True, ("a", 790): True, ("b", 600): False, ("a", 801): False}


def test_bbox_every_order(spark):
    """The box matching takes every order."""
    from gristlane.plans import evaluation

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber").toPandas()
    pairs = rows.merge(rows, on="l_orderkey").query("l_linenumber_x < l_linenumber_y")
    got = {r.assigned: r.n for r in evaluation.bbox_iou_match(spark, sf).collect()}
    assert sum(got.values()) == len(pairs) and pairs["l_orderkey"].mod(10).nunique() == 10


def test_leakage_and_lineage_whole(spark):
    """Leakage is looked for in all documents, and the digest covers the orders."""
    from gristlane.plans import curation, evaluation

    sf = "/root/testdata/sf0.001"
    roles = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars", F.sha2("text", 256).alias("sha")).collect():
        for cell in (("sha", r.sha), ("n_chars", str(r.n_chars))):
            roles.setdefault(cell, set()).add(r.doc_id % 5 == 0)
    want = {cell for cell, seen in roles.items() if len(seen) == 2 and cell[1] not in (None, "None")}
    got = [(r.field, r.value) for r in curation.leakage_report(spark, sf).collect()]
    assert sorted(got) == sorted(want)
    print("leaks", len(got), "of texts over 2000", sum(f == "n_chars" and int(v) > 2000 for f, v in got))
    assert evaluation.lineage_digest(spark, sf).first().n == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_fingerprints(spark):
    """Hashes against sums written out, and reasons at their bounds."""
    import math

    import numpy as np

    from gristlane.functions import fingerprints as X

    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (40, 50))
    small = np.zeros((32, 32))
    for i in range(32):
        for j in range(32):
            area = 0.0
            for y in range(40):
                for x in range(50):
                    dy = min((i + 1) * 40 / 32, y + 1) - max(i * 40 / 32, y)
                    dx = min((j + 1) * 50 / 32, x + 1) - max(j * 50 / 32, x)
                    if dx > 0 and dy > 0:
                        small[i, j] += image[y, x] * dx * dy
                        area += dx * dy
            small[i, j] /= area
    assert np.allclose(small, X.shrink(image.astype(float), 32, 32))
    low = [sum(small[i, j] * math.cos(math.pi * (2 * i + 1) * u / 64) * math.cos(math.pi * (2 * j + 1) * v / 64) for i in range(32) for j in range(32)) * (1 if u else 0.5**0.5) * (1 if v else 0.5**0.5) for u in range(8) for v in range(8)]
    median = sorted(low[1:])[31]
    want = 0
    for k, c in enumerate(low):
        want = want << 1 | (k > 0 and c > median)
    rows = [(0, image.ravel().tolist(), 50, 40), (1, [0] * 19200, 160, 120), (2, [255] * 19199 + [9], 160, 120), (3, None, 1, 1), (4, [1, 2], 3, 1), (5, list(range(8)) * 9, 9, 8)]
    d = spark.createDataFrame(rows, "i int, p array<int>, w int, h int")
    got = {r.i: r for r in d.select("i", X.phash(F.col("p"), F.col("w"), F.col("h")).alias("v"), X.dhash(F.col("p"), F.col("w"), F.col("h")).alias("d"), X.signature(F.col("p"), F.col("w"), F.col("h")).alias("s"), X.frame_reasons(F.col("p"), F.col("w"), F.col("h")).alias("r")).collect()}
    assert got[0].v % 2**64 == want and got[0].v in got[0].s and len(got[0].s) == 4 and got[3].v is None and got[4].d is None
    grid = [[rows[5][1][y * 9 + x] for x in range(9)] for y in range(8)]
    assert f"{got[5].d % 2**64:064b}" == "".join(str(int(r[x + 1] > r[x])) for r in grid for x in range(8))
    assert [got[i].r for i in (0, 1, 2, 3, 4)] == [["image_resolution_below_minimum"], ["image_extreme_underexposure"], ["image_extreme_overexposure"], ["image_unreadable"], ["image_unreadable"]]


def test_strict_lines(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType())])
    (tmp_path / "good.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert sorted(r.a for r in readers.strict_lines(spark, str(tmp_path / "good.jsonl"), schema).collect()) == [1, 2]
    for n, line in enumerate(('{"a": 1, "a": 2}', "[1]", "{broken")):
        (tmp_path / f"bad{n}.jsonl").write_text('{"a": 1}\n' + line + "\n")
        with pytest.raises(ValueError):
            readers.strict_lines(spark, str(tmp_path / f"bad{n}.jsonl"), schema)


def test_hours_and_age(spark):
    at = lambda h: F.to_timestamp(F.lit(f"2026-01-01 {h:02d}:30:00"))
    r = one(spark, **{f"h{h}": S.in_hours(at(h), "Asia/Seoul", 8, 19) for h in (22, 23, 7, 8)})
    assert tuple(r) == (False, True, True, False)
    df = spark.range(10).select(F.col("id").alias("k"), F.lit(10).alias("size"))
    assert sorted(x.k for x in sampling.oldest_first_budget(df, "k", "size", "k", 1000, since=7).collect()) == [7, 8, 9]


def test_teacher_replies(spark):
    """Three shapes, and what is wrong with others."""
    import json

    from gristlane.sources import replies as R

    full = {"decision": "both", "has_removable_label": True, "has_true_foreign_material": True, "same_material_accessory_only": False, "is_single_primary_item": True, "confidence": 0.9, "reason": "label"}
    texts = [
        json.dumps(full), "```json\n" + json.dumps(full) + "\n```", '{"d": "label_only", "s": true, "c": 1, "e": "label"}', '{"d": "x", "l": false, "f": true, "a": false, "s": true, "c": 0.5, "e": "contamination"}', '{"d": "exclude", "l": null, "f": null, "a": false, "s": false, "c": 0, "e": "unclear"}',
        '{"d": "both", "l": null, "f": null, "a": false, "s": false, "c": 0, "e": "unclear"}', '{"d": "both", "s": true, "c": 2, "e": "label"}', '{"d": "both", "s": true, "c": "1", "e": "label"}', '{"d": "both", "s": 1, "c": 1, "e": "label"}', '{"d": "both", "s": true, "c": 1, "e": "why"}', '{"d": "maybe", "s": true, "c": 1, "e": "label"}',
        '{"d": "both", "s": true, "c": 1, "e": "same_material_accessory"}', json.dumps(full | {"has_removable_label": False}), "[]", "not json", None, json.dumps(full | {"more": 1}),
    ]
    value, reason = R.teacher_reply(F.col("t"))
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", value.alias("v"), reason.alias("r"))
    got = d.withColumn("s", R.accepted_status(F.col("v"), F.lit("pet"), 0.6)).withColumn("k", R.accepted_status(F.col("v"), F.lit("can"), 0.6)).orderBy("i").collect()
    assert [r.r for r in got] == [None] * 5 + ["decision_flags_mismatch", "confidence_out_of_range", "confidence_not_numeric", "invalid_type", "invalid_evidence", "invalid_decision", "accessory_foreign_conflict", "decision_flags_mismatch", "unexpected_fields", "unexpected_fields", "unexpected_fields", "unexpected_fields"]
    assert got[0].v == got[1].v and got[2].v.label is True and got[3].v.decision == "foreign_only" and got[4].v.label is None
    assert [tuple(r.s) for r in got[:5]] == [(1, 1, 1), (1, 1, 1), (1, 0, 1), (-1, -1, 0), (-1, -1, 0)] and tuple(got[0].k) == (-1, 1, 1)


def test_vision_replies(spark):
    import json

    from gristlane.sources import replies as R

    good = {"material": "pet", "confidence": 0.7} | dict.fromkeys(R.FLAGS, True)
    texts = [good, good | {"material": "empty_scene"}, good | {"material": "gold"}, good | {"confidence": True}, good | {"confidence": 1.1}, good | {"has_straw": 0}, {"material": "pet"}, good | {"x": 1}]
    value, reason = R.vision_reply(F.col("t"), ["pet", "empty_scene"])
    got = spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(texts)], "i int, t string").select("i", value.alias("v"), reason.alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == [None, None, "invalid_material_or_confidence", "invalid_material_or_confidence", "confidence_out_of_range", "invalid_boolean", "contract_mismatch", "contract_mismatch"]
    assert got[0].v.has_straw and not got[1].v.has_straw

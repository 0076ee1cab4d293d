"""Labelling and quality predicates over the driver tables; line items and orders stand for detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import policy as P
from ..functions import scalars as S
from ..operators import joins, sampling
from ..sources.tables import table


def _boxes(spark, sf_dir):
    """Line items as boxes in an image of 100 by 60."""
    l = table(spark, sf_dir, "lineitem")
    x1, y1 = (F.col("l_quantity") * 2 - 2), F.col("l_discount") * 300
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x1.alias("x1"), y1.alias("y1"), (x1 + F.col("l_partkey") % 60).alias("x2"), (y1 + F.col("l_suppkey") % 40 + 1).alias("y2"), (1 - F.col("l_tax") * 5).alias("confidence"))


def _box(s=""):
    return tuple(F.col(c + s) for c in ("x1", "y1", "x2", "y2"))


def box_quality(spark, sf_dir):
    """Boxes by edges touched and suspicion."""
    _, touches, suspicious = S.box_quality(_box(), F.lit(100.0), F.lit(60.0))
    return _boxes(spark, sf_dir).groupBy(touches.alias("touches"), suspicious.alias("suspicious")).agg(F.count("*").alias("n"))


def platform_roi(spark, sf_dir):
    """Boxes on and off the platform."""
    return _boxes(spark, sf_dir).groupBy(S.on_platform(_box(), F.lit(100.0), F.lit(60.0)).alias("on_platform")).agg(F.count("*").alias("n"))


def reason_priority(spark, sf_dir):
    """Canonical quality reason of events' sets of reasons."""
    l = table(spark, sf_dir, "lineitem")
    r = F.array_compact(F.array(F.when(F.col("l_partkey") % 3 == 0, "dark"), F.when(F.col("l_suppkey") % 4 == 0, "small"), F.when(F.col("l_orderkey") % 5 == 0, "blurred"), F.when(F.col("l_linenumber") == 7, "corrupt"), F.when(F.col("l_linenumber") == 6, "odd")))
    return l.groupBy(S.first_reason(r, {"small": "too_small", "dark": "under_exposed", "blurred": "out_of_focus", "corrupt": "corrupt"}, ["corrupt"]).alias("reason")).agg(F.count("*").alias("n"))


def head_labels(spark, sf_dir):
    """Labels of two heads, -1 where they do not apply."""
    l = table(spark, sf_dir, "lineitem")
    accepted = (F.col("l_tax") < 0.06) & (F.col("l_linenumber") < 6)
    return l.groupBy(S.head_label(F.col("l_returnflag").isin("A", "R"), accepted, F.col("l_linestatus") == "O").alias("label"), S.head_label(F.lit(True), accepted, F.col("l_discount") > 0.05).alias("foreign_material")).agg(F.count("*").alias("n"))


def valid_crops(spark, sf_dir):
    """Rows of a manifest of strings by validity."""
    b = _boxes(spark, sf_dir)
    text = lambda c: c.cast("string")
    ok = S.valid_crop(F.when(F.col("l_linenumber") == 7, F.lit("two")).otherwise(F.lit("1")), text(F.col("l_partkey") * 10), text(F.col("x1")), text(F.col("y1")), text(F.col("x2") - F.col("x1")), text(F.col("y2") - F.col("y1")), F.lit("100"), F.lit("60"), 500)
    return b.groupBy(ok.alias("valid")).agg(F.count("*").alias("n"))


def conflict_recheck(spark, sf_dir):
    """Pairs of opinions that are looked at again."""
    cls = lambda c: F.get(F.array(*map(F.lit, S.CLASSES)), (c % 9).cast("int"))
    d = _boxes(spark, sf_dir).select(cls(F.col("l_partkey")).alias("first"), cls(F.col("l_suppkey")).alias("second"), "confidence")
    return d.withColumn("recheck", P.conflict_recheck(F.col("first"), F.col("confidence"), F.col("second"))).where("recheck").groupBy("first", "second").agg(F.count("*").alias("n"))


def _views(spark, sf_dir):
    """Line items as two providers' boxes of an order: a place of the order's own, moved by up to eight pixels."""
    x1, y1 = F.col("l_orderkey") % 40 + F.col("l_quantity") % 8, F.col("l_orderkey") % 20 + F.round(F.col("l_discount") * 100)
    one = joins.latest(table(spark, sf_dir, "lineitem").where("l_linenumber <= 2"), ["l_orderkey", "l_linenumber"], "l_partkey", "l_suppkey", "l_extendedprice")
    return one.select("l_orderkey", "l_linenumber", x1.alias("x1"), y1.alias("y1"), (x1 + 40).alias("x2"), (y1 + 30).alias("y2"))


def provider_consensus(spark, sf_dir):
    """Boxes of two providers for one teacher row, accepted with a mean box from an overlap of three quarters."""
    b = _views(spark, sf_dir)
    one = lambda n, s: b.where(F.col("l_linenumber") == n).select("l_orderkey", *[F.col(c).alias(c + s) for c in ("x1", "y1", "x2", "y2")])
    t = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    j = t.join(one(1, "a"), "l_orderkey", "left").join(one(2, "b"), "l_orderkey", "left")
    over = S.iou(_box("a"), _box("b"))
    status = F.when(F.col("x1a").isNull() | F.col("x1b").isNull(), "missing").when(over >= 0.75, "accepted").otherwise("apart")
    return j.groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.round(F.sum(F.when(over >= 0.75, (F.col("x1a") + F.col("x1b")) / 2)), 3).alias("x1_sum"))


def _candidates(spark, sf_dir):
    """Line items as detections of an order: first ones weak, boxes near the order's place, vinyl for every other part."""
    l = table(spark, sf_dir, "lineitem")
    x1, y1 = F.col("l_orderkey") % 40 + F.col("l_quantity") % 8, F.col("l_orderkey") % 20 + F.round(F.col("l_discount") * 100)
    cls = F.when(F.col("l_linenumber") == 1, F.get(F.array(*[F.lit(c) for c in ("pet", "plastic", "can")]), (F.col("l_partkey") % 3).cast("int"))).otherwise(F.when(F.col("l_partkey") % 2 == 0, "vinyl").otherwise("paper"))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x1.alias("x1"), y1.alias("y1"), (x1 + 40).alias("x2"), (y1 + 30).alias("y2"), cls.alias("cls"), F.round(F.col("l_tax") * 10 + F.when(F.col("l_linenumber") == 1, 0.1).otherwise(0.02), 4).alias("confidence"))


def same_box_candidate(spark, sf_dir):
    """The surest vinyl box on the same object as a weak first pet or plastic one: its number, ties to the lower."""
    b = _candidates(spark, sf_dir)
    one = b.where("l_linenumber = 1").select("l_orderkey", *[F.col(c).alias(c + "a") for c in ("x1", "y1", "x2", "y2", "cls")], F.col("confidence").alias("ca"))
    j = one.join(b.where("l_linenumber > 1"), "l_orderkey").where(P.vinyl_candidate(F.col("clsa"), F.col("ca"), F.col("cls"), F.col("confidence"), S.iou(_box("a"), _box())))
    return joins.latest(j, ["l_orderkey"], F.desc("confidence"), "l_linenumber").select("l_orderkey", "l_linenumber", "confidence")


def rotating_queue(spark, sf_dir):
    """Parts in turn by brand, container types rotating within a brand."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.substring("p_type", 1, 3).alias("kind"))
    return sampling.rotating_round_robin(p, ["p_brand"], "kind", "p_partkey").select("p_partkey", "position")


def partition_proof(spark, sf_dir):
    """Whether late and early orders partition all orders: rows missing and unexpected, by bags."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    both = o.where("o_orderkey % 3 = 0").unionByName(o.where("o_orderkey % 3 = 1")).unionByName(o.where("o_orderkey % 21 = 0"))  # early ones twice
    rows = o.exceptAll(both).withColumn("kind", F.lit("missing")).unionByName(both.exceptAll(o).withColumn("kind", F.lit("unexpected")))
    return rows.groupBy("kind").agg(F.count("*").alias("n"))


def reuse_audit(spark, sf_dir):
    """Texts used by several sources, by the number of languages and rows."""
    d = table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("sha")).agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.min("doc_id").alias("first"))
    return d.where("n > 1")


QUERIES = {f.__name__: f for f in (box_quality, platform_roi, reason_priority, head_labels, valid_crops, conflict_recheck, provider_consensus, same_box_candidate, rotating_queue, partition_proof, reuse_audit)}

_BOXES = """b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 2 - 2 AS x1, l_discount * 300 AS y1, l_quantity * 2 - 2 + l_partkey % 60 AS x2, l_discount * 300 + (l_suppkey % 40 + 1) AS y2, 1 - l_tax * 5 AS confidence FROM lineitem)"""


def _iou(p: str, q: str) -> str:
    both = f"greatest(0, least({p}.x2, {q}.x2) - greatest({p}.x1, {q}.x1)) * greatest(0, least({p}.y2, {q}.y2) - greatest({p}.y1, {q}.y1))"
    size = lambda t: f"greatest(0, {t}.x2 - {t}.x1) * greatest(0, {t}.y2 - {t}.y1)"
    return f"coalesce({both} / nullif({size(p)} + {size(q)} - {both}, 0), 0)"


ORACLE_SQL = {
    "box_quality": f"""WITH {_BOXES}, q AS (SELECT greatest(0, x2 - x1) * greatest(0, y2 - y1) / 6000 AS ratio, (x1 <= 1.0)::INT + (y1 <= 60.0::DOUBLE * 0.01)::INT + (x2 >= 99.0)::INT + (y2 >= 60.0::DOUBLE * 0.99)::INT AS touches FROM b)
        SELECT touches, ratio >= 0.5 OR touches >= 2 AS suspicious, count(*) AS n FROM q GROUP BY ALL""",
    "platform_roi": f"""WITH {_BOXES}, a AS (SELECT *, (x1 + x2) / 2 / 100.0::DOUBLE AS ax, (y1 + (y2 - y1) * 0.85::DOUBLE) / 60.0::DOUBLE AS ay FROM b)
        SELECT coalesce(x2 > x1 AND y2 > y1 AND abs(ax - 0.447::DOUBLE) <= 0.175::DOUBLE * 1.5 AND pow((ax - 0.447::DOUBLE) / (0.175::DOUBLE * 2.0), 2) + pow((ay - 0.590::DOUBLE) / (0.160::DOUBLE * 2.5), 2) <= 1.0, false) AS on_platform, count(*) AS n FROM a GROUP BY 1""",
    "reason_priority": """WITH r AS (SELECT l_partkey % 3 = 0 AS dark, l_suppkey % 4 = 0 AS small, l_orderkey % 5 = 0 AS blurred, l_linenumber = 7 AS corrupt, l_linenumber = 6 AS odd FROM lineitem)
        SELECT CASE WHEN corrupt OR odd THEN NULL WHEN small THEN 'too_small' WHEN dark THEN 'under_exposed' WHEN blurred THEN 'out_of_focus' END AS reason, count(*) AS n FROM r GROUP BY 1""",
    "head_labels": """WITH a AS (SELECT *, l_tax < 0.06 AND l_linenumber < 6 AS ok FROM lineitem)
        SELECT CASE WHEN ok AND l_returnflag IN ('A', 'R') THEN (l_linestatus = 'O')::INT ELSE -1 END AS label, CASE WHEN ok THEN (l_discount > 0.05)::INT ELSE -1 END AS foreign_material, count(*) AS n FROM a GROUP BY ALL""",
    "valid_crops": f"""WITH {_BOXES}, c AS (SELECT *, x2 - x1 AS w, y2 - y1 AS h FROM b)
        SELECT l_linenumber <> 7 AND l_partkey * 10 >= 500 AND least(w, h) > 1 AND least(x1, y1) >= 0 AND x1 + w <= 102 AND y1 + h <= 62 AND w * h / 6000 BETWEEN 0.02 AND 0.95 AS valid, count(*) AS n FROM c GROUP BY 1""",
    "conflict_recheck": f"""WITH {_BOXES}, k AS (SELECT ['can','pet','paper','plastic','styrofoam','vinyl','glass','battery','fluorescent'] AS k),
        d AS (SELECT k[(l_partkey % 9)::INT + 1] AS first, k[(l_suppkey % 9)::INT + 1] AS second, confidence FROM b, k),
        r AS (SELECT *, CASE WHEN confidence < 0.85 THEN false WHEN first = 'plastic' AND second IN ('paper', 'styrofoam') THEN confidence >= 0.95
            WHEN least(first, second) || '/' || greatest(first, second) IN ('can/plastic','paper/plastic','plastic/styrofoam','paper/vinyl','glass/pet','glass/plastic','fluorescent/glass','fluorescent/plastic') THEN true
            WHEN first IN ('glass','battery','fluorescent','styrofoam') THEN second NOT IN ('glass','battery','fluorescent','styrofoam') ELSE false END AS recheck FROM d)
        SELECT first, second, count(*) AS n FROM r WHERE recheck GROUP BY ALL""",
    "provider_consensus": f"""WITH u AS (SELECT * FROM lineitem WHERE l_linenumber <= 2 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1),
        v AS (SELECT l_orderkey, l_linenumber, l_orderkey % 40 + l_quantity % 8 AS x1, l_orderkey % 20 + round(l_discount * 100) AS y1 FROM u), b AS (SELECT *, x1 + 40 AS x2, y1 + 30 AS y2 FROM v),
        j AS (SELECT a.x1 AS ax, c.x1 AS cx, CASE WHEN a.x1 IS NOT NULL AND c.x1 IS NOT NULL THEN {_iou('a', 'c')} END AS o FROM orders LEFT JOIN b a ON a.l_orderkey = o_orderkey AND a.l_linenumber = 1 LEFT JOIN b c ON c.l_orderkey = o_orderkey AND c.l_linenumber = 2)
        SELECT CASE WHEN ax IS NULL OR cx IS NULL THEN 'missing' WHEN o >= 0.75 THEN 'accepted' ELSE 'apart' END AS status, count(*) AS n, round(sum(CASE WHEN o >= 0.75 THEN (ax + cx) / 2 END), 3) AS x1_sum FROM j GROUP BY 1""",
    "same_box_candidate": f"""WITH v AS (SELECT l_orderkey, l_linenumber, l_orderkey % 40 + l_quantity % 8 AS x1, l_orderkey % 20 + round(l_discount * 100) AS y1, round(l_tax * 10 + CASE WHEN l_linenumber = 1 THEN 0.1::DOUBLE ELSE 0.02::DOUBLE END, 4) AS confidence,
            CASE WHEN l_linenumber = 1 THEN list_extract(['pet', 'plastic', 'can'], (l_partkey % 3)::INT + 1) WHEN l_partkey % 2 = 0 THEN 'vinyl' ELSE 'paper' END AS cls FROM lineitem), b AS (SELECT *, x1 + 40 AS x2, y1 + 30 AS y2 FROM v)
        SELECT a.l_orderkey, c.l_linenumber, c.confidence FROM b a JOIN b c ON a.l_orderkey = c.l_orderkey AND a.l_linenumber = 1 AND c.l_linenumber > 1
        WHERE a.cls IN ('pet', 'plastic') AND a.confidence < 0.55 AND c.cls = 'vinyl' AND c.confidence >= 0.10 AND c.confidence >= a.confidence * 0.40::DOUBLE AND {_iou('a', 'c')} >= 0.70 QUALIFY row_number() OVER (PARTITION BY a.l_orderkey ORDER BY c.confidence DESC, c.l_linenumber) = 1""",
    "rotating_queue": """WITH p AS (SELECT p_partkey, p_brand, substr(p_type, 1, 3) AS kind FROM part), i AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM p)),
        j AS (SELECT p_brand, kind, row_number() OVER (PARTITION BY p_brand ORDER BY kind) - 1 AS j, count(*) OVER (PARTITION BY p_brand) AS k FROM (SELECT DISTINCT p_brand, kind FROM p)),
        r AS (SELECT p_partkey, p.p_brand, (j - i % k + k) % k AS turn_at, row_number() OVER (PARTITION BY p.p_brand, p.kind ORDER BY p_partkey) AS r FROM p JOIN i USING (p_brand) JOIN j ON j.p_brand = p.p_brand AND j.kind = p.kind),
        t AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY r, turn_at) AS turn FROM r)
        SELECT p_partkey, row_number() OVER (ORDER BY turn, p_brand) - 1 AS position FROM t""",
    "partition_proof": "SELECT CASE WHEN o_orderkey % 3 = 2 THEN 'missing' ELSE 'unexpected' END AS kind, count(*) AS n FROM orders WHERE o_orderkey % 3 = 2 OR o_orderkey % 21 = 0 GROUP BY 1",
    "reuse_audit": "SELECT sha256(text) AS sha, count(*) AS n, count(DISTINCT source) AS sources, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1",
}

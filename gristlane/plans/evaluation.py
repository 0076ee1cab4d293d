"""Decision policy, labelling and evaluation over the driver tables.

Parts stand for items (brand for the class, price for the weight), labels for truth, and two length
rules for the two classifiers whose policy is evaluated.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import policy as P
from ..functions import scalars as S
from ..operators import consensus, joins, metrics, sessions
from ..session import materialize
from ..sources.tables import table


def _items(spark, sf_dir):
    """Line items as detections: class by part, weight by quantity, size by discount, conditions by small digits."""
    l = table(spark, sf_dir, "lineitem")
    cls = F.get(F.array(*[F.lit(c) for c in S.CLASSES]), (F.col("l_partkey") % 9).cast("int"))
    tri = lambda c, n: F.when(c % n == 0, True).when(c % n == 1, False)
    return l.select(
        "l_orderkey", "l_linenumber", cls.alias("cls"), F.col("l_quantity").alias("grams"), F.when(F.col("l_linenumber") != 7, F.col("l_discount") * 5).alias("ratio"), (1 - F.col("l_tax") * 10).alias("confidence"),
        tri(F.col("l_orderkey"), 5).alias("straw"), tri(F.col("l_suppkey"), 6).alias("holder"), tri(F.col("l_partkey"), 7).alias("foreign"), tri(F.col("l_orderkey") + F.col("l_linenumber"), 4).alias("label"), tri(F.col("l_suppkey") + F.col("l_linenumber"), 3).alias("dented"),
    )


def weight_anomaly(spark, sf_dir):
    """Items and anomalies by class and size."""
    d = _items(spark, sf_dir).withColumn("anomaly", S.weight_anomaly(F.col("cls"), F.col("grams"), F.col("ratio")))
    return d.groupBy("cls", S.size_bucket(F.col("ratio")).alias("size")).agg(F.count("*").alias("n"), F.count_if("anomaly").alias("anomalies"))


def guidance_policy(spark, sf_dir):
    """Status and ordered guidance of items, counted."""
    d = _items(spark, sf_dir).withColumn("anomaly", S.weight_anomaly(F.col("cls"), F.col("grams"), F.col("ratio")))
    d = d.withColumn("codes", P.guidance(F.col("cls"), F.col("anomaly"), F.col("straw"), F.col("holder"), F.col("foreign"), F.col("label"), F.col("dented")))
    return d.groupBy(P.route(F.col("cls"), F.col("confidence"), F.col("codes"), 0.45).alias("status"), F.array_join("codes", ",").alias("codes")).agg(F.count("*").alias("n"))


def props_parse(spark, sf_dir):
    """Events by type and by whether their JSON can be read."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.coalesce(F.try_parse_json("props").isNotNull(), F.lit(False)).alias("valid")).agg(F.count("*").alias("n"))


def usage_window(spark, sf_dir):
    """The last 24 hours before the newest event: counts and sums by type and by user parity, in one pass."""
    e = table(spark, sf_dir, "events")
    end = e.agg(F.max("ts").alias("end"))
    last = e.crossJoin(F.broadcast(end)).where(F.col("ts") >= F.col("end") - F.expr("interval 24 hours"))  # end is one row
    d = last.withColumn("half", F.col("user_id") % 2)
    return d.groupingSets([["event_type"], ["half"], []], "event_type", "half").agg(F.count("*").alias("n"), F.sum(F.when(F.col("value") > 0, 1).otherwise(0)).alias("positive"), F.median("value").alias("median_value"), F.expr("percentile_disc(0.95) within group (order by value)").alias("p95_value"))


def asof_nearest(spark, sf_dir):
    """Each purchase with the error or click of its user nearest in time, within 120 seconds."""
    e = table(spark, sf_dir, "events")
    a = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    b = e.where("event_type <> 'purchase'").select(F.col("event_id").alias("other_id"), "user_id", F.col("ts").alias("other_ts"))
    return joins.nearest(a, b, "user_id", "ts", "other_ts", 120, "event_id", "other_id").select("event_id", "other_id", (F.col("gap") / 1000000.0).alias("gap_s"))


def _sessions(gap):
    def query(spark, sf_dir):
        out = sessions.gap_sessions(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", gap)
        return out.select("user_id", "session_id", "n", S.micros("first").alias("first_us"), S.micros("last").alias("last_us"))

    return query


gap_sessions = _sessions(3600)
gap_sessions_wide = _sessions(18000)


def _judged(spark, sf_dir):
    """Labelled documents with two length rules: truth, baseline and second opinion with confidences."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    n = F.col("n_chars")
    names = F.array(F.lit("can"), F.lit("pet"), F.lit("glass"))
    truth = F.when(F.col("quality") == 1, F.get(names, (F.col("doc_id") % 3).cast("int"))).otherwise("negative")
    first = F.when(F.col("doc_id") % 11 == 0, F.lit(None)).otherwise(F.get(names, ((F.col("doc_id") + F.floor(n / 1000)) % 3).cast("int")))
    second = F.when(F.col("doc_id") % 13 == 0, F.lit(None)).otherwise(F.get(names, ((F.col("doc_id") + F.floor(n / 4000)) % 3).cast("int")))
    return d.select("doc_id", truth.alias("truth"), first.alias("baseline"), F.when(F.col("doc_id") % 17 != 0, F.lit(1)).alias("box"), F.when(F.col("doc_id") % 19 == 0, "background").otherwise(second).alias("internal"), F.when(F.col("doc_id") % 19 != 0, second).alias("external"), ((n % 100) / 100.0).alias("base_conf"), F.when(F.col("doc_id") % 13 != 0, (n % 89) / 89.0).alias("conf"), "n_chars", "lang", "source", "quality")


def _policy(d, least, margin, veto=True):
    d = d.withColumn("reason", P.correction_reason(F.col("baseline"), F.col("box"), F.col("internal"), F.col("external"), F.col("base_conf"), F.col("conf"), least, margin, veto))
    d = d.withColumn("final", F.when(P.applied(F.col("reason")), F.col("external")).otherwise(F.col("baseline")))
    final_conf = F.when(F.col("reason") == "background_veto_applied", F.lit(None)).when(P.applied(F.col("reason")), F.col("conf")).otherwise(F.col("base_conf"))
    allowed = lambda c, p: F.coalesce(c.isin(*P.ALLOWED) & (p >= 0.5), F.lit(False))
    negative = F.col("truth") == "negative"
    promoted = P.applied(F.col("reason")) & negative & allowed(F.col("final"), final_conf) & ~allowed(F.col("baseline"), F.col("base_conf"))
    right = lambda c: F.coalesce(c, F.lit("negative")) == F.col("truth")
    d = d.withColumns({"was_right": right(F.col("baseline")), "is_right": right(F.col("final"))})
    return d.withColumn("effect", P.effect(F.col("reason"), negative, promoted, F.col("was_right"), F.col("is_right")))


def policy_effects(spark, sf_dir):
    """Corrections by reason and effect."""
    return _policy(_judged(spark, sf_dir), F.lit(0.5), F.lit(0.1)).groupBy("reason", "effect").agg(F.count("*").alias("n"))


def policy_sweep(spark, sf_dir):
    """Every cell of a confidence and margin grid, the best marked; chosen on the rows it is scored on (in_sample)."""
    grid = spark.sql("select c / 10.0D as least, m / 10.0D as margin from (select explode(sequence(3, 9)) as c) cross join (select explode(sequence(0, 3)) as m)")
    d = _judged(spark, sf_dir).crossJoin(F.broadcast(grid))  # 28 cells
    cells = _policy(d, F.col("least"), F.col("margin")).groupBy("least", "margin").agg(F.count_if("is_right").alias("right_n"), F.count_if(F.col("effect").startswith("harmful")).alias("harmful"), F.count_if(F.col("effect") == "beneficial").alias("beneficial"))
    best = F.row_number().over(Window.orderBy(F.desc("right_n"), "harmful", F.desc("least"), F.desc("margin"))) == 1
    return cells.withColumn("best", best).withColumn("in_sample", F.lit(True))


def deployment_gate(spark, sf_dir):
    """Eight checks of a policy against its baseline, and whether all hold."""
    d = materialize(_policy(_judged(spark, sf_dir), F.lit(0.5), F.lit(0.1)), "policy")
    row = d.agg(
        F.count_if(F.col("truth") != "negative").alias("positives"), F.count_if(F.col("truth") == "negative").alias("negatives"), F.avg(F.col("is_right").cast("int")).alias("acc"), F.avg(F.col("was_right").cast("int")).alias("base"),
        F.avg(F.when(F.col("truth") == "negative", F.col("is_right").cast("int"))).alias("spec"), F.avg(F.when(F.col("truth") == "negative", F.col("was_right").cast("int"))).alias("base_spec"), F.count_if(F.col("effect").startswith("harmful")).alias("harmful"), F.count_if(F.col("effect") == "harmful_negative_promotion").alias("promotions"),
    )

    def scores(pred):
        return metrics.class_scores(metrics.confusion(d.withColumn("_p", F.coalesce(pred, F.lit("negative"))), "truth", "_p")).where("support > 0 and class <> 'negative'")

    pair = scores("baseline").select("class", F.col("recall").alias("r0"), F.col("f1").alias("f0")).join(scores("final").select("class", "recall", "f1"), "class", "left")
    per = pair.agg(F.min(F.coalesce("recall", F.lit(0.0)) - F.col("r0")).alias("worst"), F.avg("f0").alias("f0"), F.avg(F.coalesce("f1", F.lit(0.0))).alias("f1"))
    tol = 1e-12
    checks = {
        "has_positives": F.col("positives") > 0, "has_negatives": F.col("negatives") > 0, "gain": F.col("acc") - F.col("base") + tol >= 0.05, "macro_f1": F.col("f1") + tol >= F.col("f0"), "recall_drop": F.col("worst") + tol >= -0.01,
        "specificity": F.col("spec") + tol >= F.col("base_spec"), "no_harm": F.col("harmful") == 0, "no_promotion": F.col("promotions") == 0,
    }
    one = row.crossJoin(per).select(*[v.alias(k) for k, v in checks.items()])  # one row each
    return one.withColumn("passed", F.expr(" and ".join(checks)))


def confusion_matrix(spark, sf_dir):
    return metrics.confusion(_judged(spark, sf_dir), "truth", "baseline")


def class_scores(spark, sf_dir):
    return metrics.class_scores(metrics.confusion(_judged(spark, sf_dir), "truth", "baseline"))


def score_summary(spark, sf_dir):
    return metrics.summary(metrics.class_scores(metrics.confusion(_judged(spark, sf_dir), "truth", "baseline")))


def class_weights(spark, sf_dir):
    return metrics.class_weights(table(spark, sf_dir, "embeddings"), "label")


def origin_mass(spark, sf_dir):
    return metrics.mass(table(spark, sf_dir, "documents"), "source", "n_chars")


def detector_outcomes(spark, sf_dir):
    """Six outcomes of a detection at each of four thresholds."""
    d = _judged(spark, sf_dir).withColumn("threshold", F.explode(F.array(*[F.lit(x) for x in (0.2, 0.4, 0.6, 0.8)])))
    seen = F.col("baseline").isNotNull() & (F.col("base_conf") >= F.col("threshold"))
    neg = F.col("truth") == "negative"
    outcome = F.when(neg & ~seen, "true_negative").when(neg, "false_positive").when(~seen, "missed").when(F.col("baseline") != F.col("truth"), "wrong_class").when(F.col("box").isNull(), "wrong_box").otherwise("correct")
    return d.groupBy("threshold", outcome.alias("outcome")).agg(F.count("*").alias("n"))


def price_quantiles(spark, sf_dir):
    return metrics.quantiles(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice")


def replay_drift(spark, sf_dir):
    """Declared and replayed prices of line items by return flag."""
    l = table(spark, sf_dir, "lineitem").withColumns({"declared": F.round("l_extendedprice", 0), "replayed": F.col("l_extendedprice")})
    return metrics.drift(l, "l_returnflag", "declared", "replayed", 20000.0, 0.25)


def transition_counts(spark, sf_dir):
    return metrics.transitions(_policy(_judged(spark, sf_dir), F.lit(0.5), F.lit(0.1)).withColumns({"a": F.coalesce("baseline", F.lit("none")), "b": F.coalesce("final", F.lit("none"))}), "a", "b")


def consensus_vote(spark, sf_dir):
    """Role most frequent in each conversation, with a quorum of two."""
    c = table(spark, sf_dir, "conversations").withColumn("confidence", F.length("text").cast("double"))
    return consensus.mode(c, "conv_id", ["role"], "confidence")


def unanimous_views(spark, sf_dir):
    c = table(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256)).withColumn("confidence", F.col("n_chars").cast("double"))
    return consensus.unanimous(c, "sha", "source", "confidence")


def judge_veto(spark, sf_dir):
    """Conversations with a voice other than the assistant's, and whether each role spoke once."""
    return consensus.veto(table(spark, sf_dir, "conversations").select("conv_id", "role"), "conv_id", "role", "role", "assistant")


def vote_coverage(spark, sf_dir):
    """Missing, unexpected and duplicate votes of every conversation and role."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "role")
    judges = spark.createDataFrame([("user",), ("assistant",), ("auditor",)], "role string")
    return joins.expected_pairs(c, judges, c, "conv_id", "role").groupBy("role", "status").agg(F.count("*").alias("n"))


def label_coverage(spark, sf_dir):
    """Coverage of documents by labels, by status."""
    d, l = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return joins.coverage(d, l, ["doc_id"]).groupBy("status").agg(F.count("*").alias("n"))


def audit_status(spark, sf_dir):
    """Labelled, rejected and ready languages: a head is ready if both values occur in both splits."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("split", F.when(F.col("doc_id") % 5 == 0, "validation").otherwise("training"))
    per = d.groupBy("lang", "split").agg(F.count("*").alias("n"), F.count("quality").alias("labelled"), F.count_if(F.col("quality") == 0).alias("bad"), F.array_join(F.sort_array(F.collect_set("quality")).cast("array<string>"), ",").alias("seen"))
    return per.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), (F.sum("bad") / F.sum("labelled")).alias("bad_rate"), F.bool_and(F.col("seen") == "0,1").alias("ready"))


def softmax_top1(spark, sf_dir):
    """Class of greatest probability, its runner-up and their gap, vectors as logits."""
    two = lambda r: F.struct(F.get(r, F.lit(0)).alias("a"), F.get(r, F.lit(1)).alias("b"))
    e = table(spark, sf_dir, "embeddings").select("vec_id", S.let(S.softmax(F.col("embedding").cast("array<double>")), lambda p: S.let(S.ranked(p), two)).alias("r"))
    return e.select("vec_id", F.col("r.a.index").alias("top"), F.col("r.b.index").alias("second"), F.round(F.col("r.a.value") - F.col("r.b.value"), 9).alias("gap"))


def bbox_iou_match(spark, sf_dir):
    """Within an order, line items as boxes: pairs by assignment, background and ambiguity counted."""
    l = table(spark, sf_dir, "lineitem")
    box = lambda d, s: d.select("l_orderkey", F.col("l_linenumber").alias(f"n{s}"), F.col("l_quantity").alias(f"x{s}"), (F.col("l_discount") * 100).alias(f"y{s}"), (F.col("l_quantity") + 20).alias(f"u{s}"), (F.col("l_discount") * 100 + 10).alias(f"v{s}"))
    j = box(l, "1").join(box(l, "2"), "l_orderkey").where("n1 < n2")
    over = S.iou((F.col("x1"), F.col("y1"), F.col("u1"), F.col("v1")), (F.col("x2"), F.col("y2"), F.col("u2"), F.col("v2")))
    return j.groupBy(S.assignment(over).alias("assigned")).agg(F.count("*").alias("n"))


def lineage_digest(spark, sf_dir):
    """Digest of the order keys and prices, whatever their order."""
    return metrics.digest(table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice")


def runtime_top1(spark, sf_dir):
    """The most expensive line of each order, ties to the lower number."""
    return joins.latest(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey"], F.desc("l_extendedprice"), "l_linenumber")


QUERIES = {
    "weight_anomaly": weight_anomaly, "guidance_policy": guidance_policy, "props_parse": props_parse, "usage_window": usage_window, "asof_nearest": asof_nearest, "gap_sessions": gap_sessions, "gap_sessions_wide": gap_sessions_wide,
    "policy_effects": policy_effects, "policy_sweep": policy_sweep, "deployment_gate": deployment_gate, "confusion_matrix": confusion_matrix, "class_scores": class_scores, "score_summary": score_summary, "class_weights": class_weights,
    "origin_mass": origin_mass, "detector_outcomes": detector_outcomes, "price_quantiles": price_quantiles, "replay_drift": replay_drift, "transition_counts": transition_counts, "consensus_vote": consensus_vote,
    "unanimous_views": unanimous_views, "judge_veto": judge_veto, "vote_coverage": vote_coverage, "label_coverage": label_coverage, "audit_status": audit_status, "softmax_top1": softmax_top1, "bbox_iou_match": bbox_iou_match,
    "lineage_digest": lineage_digest, "runtime_top1": runtime_top1,
}

_CLS = "list_extract(['can','pet','paper','plastic','styrofoam','vinyl','glass','battery','fluorescent'], (l_partkey % 9)::INT + 1)"


def _tri(expr: str, n: int) -> str:
    return f"CASE WHEN ({expr}) % {n} = 0 THEN true WHEN ({expr}) % {n} = 1 THEN false END"


_ITEMS = f"""i0 AS (SELECT {_CLS} AS cls, l_quantity AS grams, CASE WHEN l_linenumber <> 7 THEN l_discount * 5 END AS ratio, 1 - l_tax * 10 AS confidence,
        {_tri('l_orderkey', 5)} AS straw, {_tri('l_suppkey', 6)} AS holder, {_tri('l_partkey', 7)} AS "foreign", {_tri('l_orderkey + l_linenumber', 4)} AS label, {_tri('l_suppkey + l_linenumber', 3)} AS dented FROM lineitem),
    i1 AS (SELECT *, CASE WHEN ratio < 0.10 THEN 'S' WHEN ratio < 0.28 THEN 'M' ELSE 'L' END AS size FROM i0),
    w(wcls, wsize, empty) AS (VALUES ('pet','S',15.0),('pet','M',22.0),('pet','L',45.0),('can','S',14.0),('can','M',20.0),('can','L',40.0),('plastic','S',10.0),('plastic','M',30.0),('plastic','L',80.0),('paper','S',5.0),('paper','M',40.0),('paper','L',200.0)),
    f(fcls, most) AS (VALUES ('pet',300.0),('can',200.0),('plastic',500.0),('paper',2000.0),('styrofoam',500.0),('vinyl',400.0),('glass',1000.0),('battery',200.0),('fluorescent',500.0)),
    items AS (SELECT i1.*, coalesce(CASE WHEN ratio IS NOT NULL AND empty IS NOT NULL THEN grams > empty + 15 ELSE grams > most END, false) AS anomaly FROM i1 LEFT JOIN w ON wcls = cls AND wsize = size LEFT JOIN f ON fcls = cls)"""
_N = "list_extract(['can','pet','glass'], ({0})::INT + 1)"
_JUDGED = f"""j0 AS (SELECT doc_id, n_chars AS n, quality, lang, source FROM documents JOIN labels USING (doc_id)),
    j1 AS (SELECT *, CASE WHEN quality = 1 THEN {_N.format('doc_id % 3')} ELSE 'negative' END AS truth,
        CASE WHEN doc_id % 11 <> 0 THEN {_N.format('(doc_id + n // 1000) % 3')} END AS baseline,
        CASE WHEN doc_id % 13 <> 0 THEN {_N.format('(doc_id + n // 4000) % 3')} END AS second FROM j0),
    judged AS (SELECT *, CASE WHEN doc_id % 17 <> 0 THEN 1 END AS box, CASE WHEN doc_id % 19 = 0 THEN 'background' ELSE second END AS internal, CASE WHEN doc_id % 19 <> 0 THEN second END AS external,
        (n % 100) / 100.0::DOUBLE AS base_conf, CASE WHEN doc_id % 13 <> 0 THEN (n % 89) / 89.0::DOUBLE END AS conf FROM j1)"""


def _effects(least: str, margin: str, source: str = "judged") -> str:
    return f"""p0 AS (SELECT *, CASE WHEN baseline IS NULL THEN 'no_baseline_detection' WHEN box IS NULL THEN 'missing_selected_bbox'
            WHEN internal = 'background' THEN CASE WHEN coalesce(conf < {least}, true) THEN 'background_veto_below_verifier_confidence' WHEN coalesce(conf - base_conf < {margin}, true) THEN 'background_veto_below_verifier_over_yolo_margin' ELSE 'background_veto_applied' END
            WHEN external IS NULL THEN 'no_verifier_prediction' WHEN external = baseline THEN 'external_agreement' WHEN coalesce(conf < {least}, true) THEN 'below_verifier_confidence'
            WHEN coalesce(conf - base_conf < {margin}, true) THEN 'below_verifier_over_yolo_margin' ELSE 'corrected' END AS reason FROM {source}),
        p1 AS (SELECT *, reason IN ('corrected', 'background_veto_applied') AS applied, CASE WHEN reason IN ('corrected', 'background_veto_applied') THEN external ELSE baseline END AS final,
            CASE WHEN reason = 'background_veto_applied' THEN NULL WHEN reason = 'corrected' THEN conf ELSE base_conf END AS final_conf FROM p0),
        p2 AS (SELECT *, coalesce(baseline, 'negative') = truth AS was_right, coalesce(final, 'negative') = truth AS is_right,
            applied AND truth = 'negative' AND coalesce(final IN ('pet','plastic','can','paper') AND final_conf >= 0.5, false) AND NOT coalesce(baseline IN ('pet','plastic','can','paper') AND base_conf >= 0.5, false) AS promoted FROM p1),
        p AS (SELECT *, CASE WHEN NOT applied THEN 'unchanged' WHEN reason = 'background_veto_applied' AND truth <> 'negative' THEN 'harmful_positive_suppression' WHEN promoted THEN 'harmful_negative_promotion'
            WHEN NOT was_right AND is_right THEN 'beneficial' WHEN was_right AND NOT is_right THEN 'harmful' ELSE 'wrong_to_wrong' END AS effect FROM p2)"""


def _scores(pred: str, source: str, name: str) -> str:
    return f"""{name} AS (SELECT class, coalesce(support, 0)::BIGINT AS support, coalesce(predicted, 0)::BIGINT AS predicted, coalesce(hits, 0)::BIGINT AS hits,
            coalesce(hits / nullif(predicted, 0), 0.0)::DOUBLE AS precision, coalesce(hits / nullif(support, 0), 0.0)::DOUBLE AS recall, coalesce(2.0 * coalesce(hits, 0) / nullif(coalesce(support, 0) + coalesce(predicted, 0), 0), 0.0)::DOUBLE AS f1
        FROM (SELECT truth AS class, count(*) AS support, count(*) FILTER (WHERE truth = {pred}) AS hits FROM {source} GROUP BY 1) FULL JOIN (SELECT {pred} AS class, count(*) AS predicted FROM {source} GROUP BY 1) USING (class))"""


_SESSIONS = """WITH g AS (SELECT user_id, event_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER w <= {0} * 1000000::BIGINT THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM g)
        SELECT user_id, 'session_' || substr(sha256(string_agg(event_id::VARCHAR, ',' ORDER BY event_id::VARCHAR)), 1, 16) AS session_id, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM s GROUP BY user_id, s"""
_GATE = f"""WITH {_JUDGED}, {_effects('0.5', '0.1')}, q AS (SELECT *, coalesce(baseline, 'negative') AS b, coalesce(final, 'negative') AS f FROM p), {_scores('b', 'q', 's0')}, {_scores('f', 'q', 's1')},
        pair AS (SELECT min(coalesce(s1.recall, 0) - s0.recall) AS worst, avg(s0.f1) AS f0, avg(coalesce(s1.f1, 0)) AS f1 FROM s0 LEFT JOIN s1 ON s0.class = s1.class AND s1.support > 0 WHERE s0.support > 0 AND s0.class <> 'negative'),
        r AS (SELECT count(*) FILTER (WHERE truth <> 'negative') > 0 AS has_positives, count(*) FILTER (WHERE truth = 'negative') > 0 AS has_negatives, avg(is_right::INT) - avg(was_right::INT) + 1e-12 >= 0.05 AS gain,
            avg(is_right::INT) FILTER (WHERE truth = 'negative') + 1e-12 >= avg(was_right::INT) FILTER (WHERE truth = 'negative') AS specificity, count(*) FILTER (WHERE effect LIKE 'harmful%') = 0 AS no_harm, count(*) FILTER (WHERE effect = 'harmful_negative_promotion') = 0 AS no_promotion FROM p),
        c AS (SELECT has_positives, has_negatives, gain, f1 + 1e-12 >= f0 AS macro_f1, worst + 1e-12 >= -0.01 AS recall_drop, specificity, no_harm, no_promotion FROM r, pair)
        SELECT *, has_positives AND has_negatives AND gain AND macro_f1 AND recall_drop AND specificity AND no_harm AND no_promotion AS passed FROM c"""

ORACLE_SQL = {
    "weight_anomaly": f"WITH {_ITEMS} SELECT cls, size, count(*) AS n, count(*) FILTER (WHERE anomaly) AS anomalies FROM items GROUP BY cls, size",
    "guidance_policy": f"""WITH {_ITEMS}, c AS (SELECT *, list_filter([CASE WHEN anomaly AND cls IN ('pet','plastic','can') THEN 'EMPTY_CONTENTS' END, CASE WHEN anomaly AND cls IN ('paper','vinyl') THEN 'WEIGHT_ANOMALY' END, CASE WHEN straw THEN 'REMOVE_STRAW' END,
            CASE WHEN holder AND cls IN ('pet','plastic') THEN 'REMOVE_CUP_HOLDER' END, CASE WHEN "foreign" THEN 'FOREIGN_MATERIAL' END, CASE WHEN label THEN 'REMOVE_LABEL' END, CASE WHEN dented = false AND cls IN ('pet','plastic','can') THEN 'COMPRESS' END], lambda x: x IS NOT NULL) AS k FROM items)
        SELECT CASE WHEN coalesce(confidence < 0.45, true) THEN 'GENERAL_WASTE' WHEN cls IN ('glass','battery','fluorescent','styrofoam') THEN 'REJECTED' WHEN len(k) > 0 THEN 'REJECTED' ELSE 'ALLOWED' END AS status, coalesce(array_to_string(k, ','), '') AS codes, count(*) AS n FROM c GROUP BY ALL""",
    "props_parse": "SELECT event_type, coalesce(json_valid(props), false) AS valid, count(*) AS n FROM events GROUP BY ALL",
    "usage_window": """WITH d AS (SELECT *, user_id % 2 AS half FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR)
        SELECT event_type, half, count(*) AS n, sum(CASE WHEN value > 0 THEN 1 ELSE 0 END)::BIGINT AS positive, median(value) AS median_value, quantile_disc(value, 0.95) AS p95_value FROM d GROUP BY GROUPING SETS ((event_type), (half), ())""",
    "asof_nearest": """WITH a AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase'), b AS (SELECT event_id AS other_id, user_id, epoch_us(ts) AS o FROM events WHERE event_type <> 'purchase'),
        n AS (SELECT event_id, other_id, abs(t - o) AS gap FROM a JOIN b USING (user_id) WHERE abs(t - o) <= 120000000 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY gap, other_id) = 1)
        SELECT a.event_id, other_id, gap / 1000000.0 AS gap_s FROM a LEFT JOIN n USING (event_id)""",
    "gap_sessions": _SESSIONS.format(3600),
    "gap_sessions_wide": _SESSIONS.format(18000),
    "policy_effects": f"WITH {_JUDGED}, {_effects('0.5', '0.1')} SELECT reason, effect, count(*) AS n FROM p GROUP BY ALL",
    "policy_sweep": f"""WITH {_JUDGED}, grid AS (SELECT c / 10.0::DOUBLE AS least, m / 10.0::DOUBLE AS margin FROM (SELECT unnest(range(3, 10)) AS c), (SELECT unnest(range(0, 4)) AS m)), cells AS (SELECT * FROM judged, grid), {_effects('least', 'margin', 'cells')},
        t AS (SELECT least, margin, count(*) FILTER (WHERE is_right) AS right_n, count(*) FILTER (WHERE effect LIKE 'harmful%') AS harmful, count(*) FILTER (WHERE effect = 'beneficial') AS beneficial FROM p GROUP BY least, margin)
        SELECT *, row_number() OVER (ORDER BY right_n DESC, harmful, least DESC, margin DESC) = 1 AS best, true AS in_sample FROM t""",
    "deployment_gate": _GATE,
    "confusion_matrix": f"WITH {_JUDGED} SELECT truth, coalesce(baseline, 'none') AS predicted, count(*) AS n FROM judged GROUP BY ALL",
    "class_scores": f"WITH {_JUDGED}, q AS (SELECT truth, coalesce(baseline, 'none') AS b FROM judged), {_scores('b', 'q', 's')} SELECT * FROM s",
    "score_summary": f"""WITH {_JUDGED}, q AS (SELECT truth, coalesce(baseline, 'none') AS b FROM judged), {_scores('b', 'q', 's')}
        SELECT sum(support)::BIGINT AS n, sum(hits) / sum(support) AS accuracy, avg(f1) FILTER (WHERE support > 0) AS macro_f1, avg(recall) FILTER (WHERE support > 0) AS balanced_accuracy, count(*) FILTER (WHERE support = 0) AS unsupported FROM s""",
    "class_weights": """WITH n AS (SELECT label AS class, greatest(1, count(label)) AS n FROM embeddings GROUP BY label), r AS (SELECT *, 1.0::DOUBLE / n AS i, (1 - 0.99::DOUBLE) / (1 - pow(0.99::DOUBLE, n)) AS e FROM n)
        SELECT class, n, i / avg(i) OVER () AS inverse, e / avg(e) OVER () AS effective FROM r""",
    "origin_mass": "SELECT source, sum(n_chars)::BIGINT AS mass, sum(n_chars) / sum(sum(n_chars)) OVER () AS share FROM documents GROUP BY source",
    "detector_outcomes": f"""WITH {_JUDGED}, t AS (SELECT *, unnest([0.2::DOUBLE, 0.4::DOUBLE, 0.6::DOUBLE, 0.8::DOUBLE]) AS threshold FROM judged), s AS (SELECT *, baseline IS NOT NULL AND base_conf >= threshold AS seen FROM t)
        SELECT threshold, CASE WHEN truth = 'negative' AND NOT seen THEN 'true_negative' WHEN truth = 'negative' THEN 'false_positive' WHEN NOT seen THEN 'missed' WHEN baseline <> truth THEN 'wrong_class' WHEN box IS NULL THEN 'wrong_box' ELSE 'correct' END AS outcome, count(*) AS n FROM s GROUP BY ALL""",
    "price_quantiles": """SELECT o_orderpriority, count(o_totalprice) AS n, min(o_totalprice) AS least, max(o_totalprice) AS most, quantile_disc(o_totalprice, 0.5) AS p50, quantile_disc(o_totalprice, 0.9) AS p90, quantile_disc(o_totalprice, 0.95) AS p95, quantile_disc(o_totalprice, 0.99) AS p99 FROM orders GROUP BY 1""",
    "replay_drift": """WITH d AS (SELECT l_returnflag, round(l_extendedprice, 0) AS a, l_extendedprice AS b, abs(round(l_extendedprice, 0) - l_extendedprice) AS x FROM lineitem)
        SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE x > 0.25) AS mismatches, count(*) FILTER (WHERE a < 20000 AND b >= 20000) AS crossed_up, count(*) FILTER (WHERE a >= 20000 AND b < 20000) AS crossed_down, quantile_disc(x, 0.5) AS p50, quantile_disc(x, 0.95) AS p95, max(x) AS most FROM d GROUP BY 1""",
    "transition_counts": f"WITH {_JUDGED}, {_effects('0.5', '0.1')} SELECT coalesce(baseline, 'none') || '->' || coalesce(final, 'none') AS transition, count(*) AS n FROM p GROUP BY 1",
    "consensus_vote": """WITH v AS (SELECT conv_id, role, count(*) AS votes, min(length(text))::DOUBLE AS minimum_confidence FROM conversations GROUP BY ALL), t AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY votes DESC, role) = 1)
        SELECT t.*, passes, votes >= 2 AS consensus FROM t JOIN (SELECT conv_id, count(*) AS passes FROM conversations GROUP BY 1) USING (conv_id)""",
    "unanimous_views": "SELECT sha256(text) AS sha, count(*) AS views, min(n_chars)::DOUBLE AS minimum_confidence, CASE WHEN count(DISTINCT source) = 1 THEN min(source) END AS verdict FROM documents GROUP BY 1",
    "judge_veto": """WITH f AS (SELECT count(DISTINCT role) AS k FROM conversations) SELECT conv_id, bool_or(role <> 'assistant') AS vetoed, count(*) AS n, count(DISTINCT role) AS families, count(*) = (SELECT k FROM f) AND count(DISTINCT role) = (SELECT k FROM f) AS complete FROM conversations GROUP BY conv_id""",
    "vote_coverage": """WITH e AS (SELECT conv_id, role FROM (SELECT DISTINCT conv_id FROM conversations), (VALUES ('user'), ('assistant'), ('auditor')) r(role)), v AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY ALL),
        j AS (SELECT role, CASE WHEN v.n IS NULL THEN 'missing' WHEN x IS NULL THEN 'unexpected' WHEN v.n > 1 THEN 'duplicate' ELSE 'both' END AS status FROM (SELECT *, 1 AS x FROM e) e FULL JOIN v USING (conv_id, role))
        SELECT role, status, count(*) AS n FROM j GROUP BY ALL""",
    "label_coverage": """WITH d AS (SELECT doc_id, count(*) AS a FROM documents GROUP BY 1), l AS (SELECT doc_id, count(*) AS b FROM labels GROUP BY 1)
        SELECT CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'unexpected' WHEN greatest(a, b) > 1 THEN 'duplicate' ELSE 'both' END AS status, count(*) AS n FROM d FULL JOIN l USING (doc_id) GROUP BY 1""",
    "audit_status": """WITH d AS (SELECT lang, doc_id % 5 = 0 AS v, count(*) AS n, count(quality) AS labelled, count(*) FILTER (WHERE quality = 0) AS bad, count(DISTINCT quality) AS k FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL)
        SELECT lang, sum(n)::BIGINT AS n, sum(labelled)::BIGINT AS labelled, sum(bad) / nullif(sum(labelled), 0) AS bad_rate, bool_and(k = 2) AS ready FROM d GROUP BY lang""",
    "softmax_top1": """WITH x AS (SELECT vec_id, i - 1 AS idx, embedding[i]::DOUBLE AS v FROM embeddings, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i)), p AS (SELECT *, exp(v - max(v) OVER w) AS e FROM x WINDOW w AS (PARTITION BY vec_id)),
        q AS (SELECT vec_id, idx, e / sum(e) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, idx) AS r FROM p)
        SELECT vec_id, max(idx) FILTER (WHERE r = 1)::INT AS top, max(idx) FILTER (WHERE r = 2)::INT AS second, round(max(p) FILTER (WHERE r = 1) - max(p) FILTER (WHERE r = 2), 9) AS gap FROM q GROUP BY vec_id""",
    "bbox_iou_match": """WITH b AS (SELECT l_orderkey, l_linenumber AS n, l_quantity AS x, l_discount * 100 AS y FROM lineitem),
        j AS (SELECT greatest(0, least(a.x, c.x) + 20 - greatest(a.x, c.x)) * greatest(0, least(a.y + 10, c.y + 10) - greatest(a.y, c.y)) AS i, (a.x + 20 - a.x) * (a.y + 10 - a.y) + (c.x + 20 - c.x) * (c.y + 10 - c.y) AS u FROM b a JOIN b c ON a.l_orderkey = c.l_orderkey AND a.n < c.n)
        SELECT CASE WHEN i / (u - i) >= 0.5 THEN 'truth' WHEN i / (u - i) <= 0.1 THEN 'background' ELSE 'ambiguous' END AS assigned, count(*) AS n FROM j GROUP BY 1""",
    "lineage_digest": """WITH h AS (SELECT sha256(o_orderkey::VARCHAR || '|' || o_totalprice::VARCHAR) AS g FROM orders), a AS (SELECT g, g || ':' || count(*) AS d, count(*) AS n FROM h GROUP BY g),
        b AS (SELECT substr(g, 1, 6) AS g, sha256(string_agg(d, ',' ORDER BY g)) AS d, sum(n) AS n FROM a GROUP BY 1), c AS (SELECT substr(g, 1, 4) AS g, sha256(string_agg(d, ',' ORDER BY g)) AS d, sum(n) AS n FROM b GROUP BY 1),
        e AS (SELECT substr(g, 1, 2) AS g, sha256(string_agg(d, ',' ORDER BY g)) AS d, sum(n) AS n FROM c GROUP BY 1)
        SELECT sum(n)::BIGINT AS n, sha256(string_agg(d, ',' ORDER BY g)) AS digest FROM e""",
    "runtime_top1": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) = 1",
}

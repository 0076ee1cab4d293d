"""Captures, their snapshot and the decision on them over the driver tables.

Line items stand for captures: parts for classes, the boxes of ``labelling`` for detections, price for
latency, ship dates for time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import policy as P
from ..functions import scalars as S
from ..operators import joins, metrics
from ..sources import replies
from ..sources.tables import table
from .evaluation import _CLS, _ITEMS, _items
from .labelling import _BOXES, _box, _boxes


def _name(c):
    return F.get(F.array(*[F.lit(x) for x in S.CLASSES]), (c % 9).cast("int"))


def _captures(spark, sf_dir):
    """Captures: status, class, box (null for every ninth part), latency (null for every tenth order), review and guidance."""
    b = _boxes(spark, sf_dir).withColumns({c: F.when(F.col("l_partkey") % 9 != 0, F.col(c)) for c in ("x1", "y1", "x2", "y2")})
    cls = F.when(F.col("x1").isNotNull(), _name(F.col("l_suppkey")))
    codes = F.array_compact(F.array(F.when(F.col("l_partkey") % 4 == 0, "REMOVE_LABEL"), F.when(F.col("l_suppkey") % 5 == 0, "COMPRESS")))
    codes = F.when(cls.isin(*P.ALLOWED), codes).otherwise(F.array().cast("array<string>"))
    return b.select(
        P.route(cls, F.col("confidence"), codes, P.TRUST).alias("status"), cls.alias("cls"), "x1", "y1", "x2", "y2", codes.alias("codes"),
        F.when(F.col("l_orderkey") % 10 != 0, F.round((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 4000 + 0.5, 1)).alias("process_ms"), F.when(F.col("l_orderkey") % 3 == 0, F.col("l_suppkey") % 5 != 0).alias("is_correct"),
    )


def snapshot_summary(spark, sf_dir):
    """One row: requests, rates of boxes, suspicious boxes, latencies and reviewed accuracy."""
    d = _captures(spark, sf_dir)
    _, _, odd = S.box_quality(_box(), F.lit(100.0), F.lit(60.0))
    share = lambda c: F.round(c / F.count("*") * 100, 1)
    has, bad = F.count_if(F.col("x1").isNotNull()), F.count_if(odd)
    return d.agg(
        F.count("*").alias("total_requests"), share(has).alias("bbox_detection_rate"), F.count_if(F.col("status") == "NOT_DETECTED").alias("not_detected_count"), bad.alias("suspicious_bbox_count"), share(bad).alias("suspicious_bbox_rate"),
        F.count("process_ms").alias("latency_samples"), F.round(F.median("process_ms"), 1).alias("latency_median"), F.expr("round(percentile_disc(0.95) within group (order by process_ms), 1)").alias("latency_p95"),
        F.count("is_correct").alias("reviewed_samples"), F.round(F.avg(F.col("is_correct").cast("int")) * 100, 1).alias("reviewed_percent"),
    )


def snapshot_distributions(spark, sf_dir):
    """Captures by status, class and guidance code."""
    d = _captures(spark, sf_dir)
    cell = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    cells = F.concat(F.array(cell("status", F.col("status")), cell("class", F.col("cls"))), F.transform("codes", lambda c: cell("guidance", c)))
    return d.select(F.explode(cells).alias("x")).select("x.*").where("value is not null").groupBy("kind", "value").agg(F.count("*").alias("n"))


def provider_usage(spark, sf_dir):
    """Attempts of the last day before the newest: results, tokens, cost and latency of all, and by provider, model and kind."""
    l = table(spark, sf_dir, "lineitem").select(
        "l_shipdate", F.get(F.array(*map(F.lit, ("north", "south", "east"))), (F.col("l_suppkey") % 3).cast("int")).alias("provider"), F.when(F.col("l_partkey") % 7 != 0, F.concat(F.lit("m"), F.col("l_partkey") % 4)).alias("model"), F.col("l_returnflag").alias("kind"), (F.col("l_linestatus") == "F").alias("ok"),
        F.col("l_quantity").cast("long").alias("input_tokens"), F.when(F.col("l_linenumber") != 3, F.col("l_linenumber").cast("long")).alias("output_tokens"), F.round(F.col("l_tax") / 100, 6).alias("cost"), F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("ms"),
    )
    end = l.agg(F.max("l_shipdate").alias("end"))
    d = l.crossJoin(F.broadcast(end)).where("l_shipdate >= end - interval 24 hours")  # end is one row
    per = d.groupingSets([["provider"], ["model"], ["kind"], []], "provider", "model", "kind").agg(
        F.grouping_id().alias("g"), F.count("*").alias("attempts"), F.count_if("ok").alias("successful"), F.count_if(~F.col("ok")).alias("fallback"), F.sum("input_tokens").alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"), F.round(F.sum("cost"), 8).alias("cost"),
        F.round(F.median("ms"), 1).alias("median_ms"), F.expr("round(percentile_disc(0.95) within group (order by ms), 1)").alias("p95_ms"),
    )
    by = F.when(F.col("g") == 7, "all").when(F.col("g") == 3, "provider").when(F.col("g") == 5, "model").otherwise("kind")
    value = F.coalesce("provider", "model", "kind")
    return per.withColumns({"dimension": by, "value": value}).where("dimension = 'all' or value is not null").drop("g", "provider", "model", "kind")


def provider_cooldown(spark, sf_dir):
    """Requests by whether their provider failed within the 300 seconds before, from a running frame."""
    e = table(spark, sf_dir, "events").select("user_id", (F.col("event_type") == "error").alias("failed"), S.micros("ts").alias("at"))
    recent = F.expr("max(if(failed, at, null)) over (partition by user_id order by at range between 300000000 preceding and 1 preceding)")
    return e.withColumn("cooling", recent.isNotNull()).groupBy("cooling", "failed").agg(F.count("*").alias("n"))


def decision_cascade(spark, sf_dir):
    """Statuses after vinyl correction, rescue, agreement gate and the second opinion's conditions."""
    d = _items(spark, sf_dir).withColumns({"anomaly": S.weight_anomaly(F.col("cls"), F.col("grams"), F.col("ratio")), "conf": F.round(F.col("confidence"), 4)})
    k = F.col("l_orderkey") + F.col("l_linenumber")
    second, sure = F.when(k % 6 != 0, F.when(k % 6 == 1, F.lit("vinyl")).otherwise(_name(k))), F.when(k % 6 != 0, F.round((k % 11) / 10, 1))
    cls, conf, correction, deferred = P.decide(F.col("cls"), F.col("conf"), k % 4 < 2, second, sure, gate=True)
    d = d.withColumns({"final": cls, "final_conf": conf, "correction": correction, "deferred": deferred})
    label, dented = P.head_conditions(F.col("label"), F.col("dented"), F.when(k % 3 != 0, k % 3 == 1), F.when(k % 5 != 0, k % 5 < 3), (k % 11) / 10)
    codes = P.guidance(F.col("final"), F.col("anomaly"), F.col("straw"), F.col("holder"), F.col("foreign"), label, dented)
    status = F.when(F.col("deferred"), "GENERAL_WASTE").otherwise(P.route(F.col("final"), F.col("final_conf"), codes, P.TRUST))
    return d.groupBy("correction", "deferred", status.alias("status")).agg(F.count("*").alias("n"))


def llm_target(spark, sf_dir):
    """Whether a very light vinyl goes to the specialist, and whether a weak or small box gives way to the platform's region."""
    d = _items(spark, sf_dir)
    special = F.coalesce((F.col("cls") == "vinyl") & (F.col("confidence") >= 0.50) & F.col("grams").between(0, 5), F.lit(False))
    region = F.coalesce((F.col("confidence") < 0.55) | (F.col("ratio") < 0.10), F.lit(True))
    return d.groupBy(special.alias("specialist"), region.alias("region")).agg(F.count("*").alias("n"))


def reviewed_import(spark, sf_dir):
    """Reviewed single objects by the class that the review gives them; others are skipped."""
    d = _captures(spark, sf_dir).withColumns({"single": F.when(F.col("cls") != "pet", True), "expected": F.when(F.col("process_ms") % 3 < 1, F.lit("")).when(F.col("process_ms") % 3 < 2, F.lit("paper"))})
    label = F.when(F.col("single") & F.col("x1").isNotNull(), P.reviewed_label(F.col("expected"), F.col("is_correct"), F.col("cls"), S.CLASSES))
    return d.groupBy(F.coalesce(label, F.lit("skipped")).alias("label")).agg(F.count("*").alias("n"))


def box_ranking(spark, sf_dir):
    """For each order the box by score above the floor, else its deployed one, else none."""
    b = _boxes(spark, sf_dir).withColumn("score", F.round(S.box_score(_box(), F.col("confidence"), F.lit(100.0), F.lit(60.0)), 9))
    top = joins.latest(b.where("score > -0.25 and l_partkey % 2 = 0"), ["l_orderkey"], F.desc("score"), "l_linenumber").select("l_orderkey", "score")
    deployed = b.where("l_linenumber = 1").select("l_orderkey").distinct().withColumn("deployed", F.lit(True))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey")).join(top, "l_orderkey", "left").join(deployed, "l_orderkey", "left")
    how = F.when(F.col("score").isNotNull(), "low_conf_expected_class").when(F.col("deployed"), "deployed_bbox_fallback").otherwise("missing")
    return o.select("l_orderkey", how.alias("source"), F.round("score", 6).alias("score"))


def background_states(spark, sf_dir):
    """Crops by how strictly they are background, each order's first box for the truth."""
    b = _boxes(spark, sf_dir)
    one = joins.latest(b.where("l_linenumber = 1"), ["l_orderkey"], "l_partkey", "l_suppkey").select("l_orderkey", *[F.col(c).alias(c + "t") for c in ("x1", "y1", "x2", "y2")])
    j = b.where("l_linenumber > 1").join(one, "l_orderkey", "left").withColumns({c: F.when(F.col("l_suppkey") % 8 != 0, F.col(c)) for c in ("x1", "y1", "x2", "y2")})
    material = F.when(F.col("l_partkey") % 7 == 0, F.lit(None)).otherwise((F.col("l_partkey") % 3).cast("int"))
    return j.groupBy(S.background_state(material, 0, _box("t"), _box(), F.lit(100.0), F.lit(60.0)).alias("state")).agg(F.count("*").alias("n"))


def box_parsing(spark, sf_dir):
    """Boxes written in three ways and some wrong ones, by the reason against them."""
    b = _boxes(spark, sf_dir)
    text = lambda c: F.round(c, 2).cast("string")
    listed = F.concat(F.lit("["), text(F.col("x1")), F.lit(","), text(F.col("y1")), F.lit(","), text(F.col("x2")), F.lit(","), text(F.col("y2")), F.lit("]"))
    named = F.concat(F.lit('{"x1":'), text(F.col("x1")), F.lit(',"y1":'), text(F.col("y1")), F.lit(',"x2":'), text(F.col("x2")), F.lit(',"y2":'), text(F.col("y2")), F.lit("}"))
    sized = F.concat(F.lit('{"x":'), text(F.col("x1")), F.lit(',"y":'), text(F.col("y1")), F.lit(',"width":30,"height":20}'))
    k = F.col("l_partkey") % 7
    value = F.when(k == 0, listed).when(k == 1, named).when(k == 2, sized).when(k == 3, F.lit('{"x1":1}')).when(k == 4, F.lit("[1,2,3]")).when(k == 5, F.lit('[1,2,"a",4]'))
    _, reason = S.parse_box(value, F.lit(100.0), F.lit(60.0), 0.02, 0.5)
    return b.groupBy(F.coalesce(reason, F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


def eligible_rows(spark, sf_dir):
    """Line items as manifest rows by eligibility."""
    l = table(spark, sf_dir, "lineitem")
    ok = S.eligible(F.when(F.col("l_returnflag") == "A", "Training").otherwise("validation"), _name(F.col("l_partkey")), ["can", "pet", "vinyl"], F.when(F.col("l_linenumber") == 7, "x").otherwise("1"), (F.col("l_partkey") * 10).cast("string"), F.col("l_discount") * 5, 500, 0.02, 0.45, F.col("l_linestatus") == "F")
    return l.groupBy(ok.alias("eligible")).agg(F.count("*").alias("n"))


def nested_fields(spark, sf_dir):
    """Events by the parity of the first field that one of several paths has."""
    e = table(spark, sf_dir, "events").withColumn("k", S.first_path(F.col("props"), "$.missing.k", "$.key", "$.k").try_cast("long"))
    return e.groupBy("event_type", (F.col("k") % 2).alias("parity")).agg(F.count("*").alias("n"))


def view_votes(spark, sf_dir):
    """Class of the greatest mean over the two halves and the reverse of an embedding; ties have none."""
    v = F.col("embedding").cast("array<double>")
    half = lambda at: F.slice(v, at, 32)
    mean = F.transform(S.view_mean(F.array(half(1), half(33), F.reverse(half(1)))), lambda x: F.round(x, 2))
    best, tied = S.argmax(F.col("m"))
    return table(spark, sf_dir, "embeddings").where("size(embedding) = 64").select("vec_id", mean.alias("m")).select("vec_id", best.alias("best"), tied.alias("tied"))


def _heads(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return l.select(
        F.when(F.col("l_partkey") % 4 != 0, (F.col("l_partkey") % 2).cast("int")).otherwise(-1).alias("label"), (F.col("l_suppkey") % 2).cast("int").alias("label_p"), F.when(F.col("l_suppkey") % 5 != 0, (F.col("l_orderkey") % 2).cast("int")).alias("dent"), F.when(F.col("l_linenumber") < 5, F.col("l_orderkey") % 2).otherwise(0).cast("int").alias("dent_p"),
        (F.col("l_partkey") % 9).cast("int").alias("material"), ((F.col("l_partkey") + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)) % 9).cast("int").alias("material_p"), F.col("l_quantity").alias("confidence"),
    )


_TASKS = {"label": ("label", "label_p", "confidence"), "dent": ("dent", "dent_p", "confidence"), "material": ("material", "material_p", "confidence")}


def head_metrics(spark, sf_dir):
    """Accuracy, balanced accuracy and mean confidence of three heads over their own labelled rows."""
    s = metrics.head_scores(metrics.heads(_heads(spark, sf_dir), _TASKS))
    return s.select("task", "n", *[F.round(c, 9).alias(c) for c in ("accuracy", "balanced_accuracy", "mean_confidence")])


def model_selection(spark, sf_dir):
    """Mean balanced accuracy over the heads."""
    return metrics.selection_score(head_metrics(spark, sf_dir)).select("heads", F.round("score", 8).alias("score"))


def detector_gate(spark, sf_dir):
    """Five checks of a candidate's reports against the baseline's."""
    l = table(spark, sf_dir, "lineitem").withColumns({"positive": F.col("l_returnflag") != "N", "base": (F.col("l_partkey") % 10 < 6), "cand": (F.col("l_partkey") % 10 < 7), "sure": F.col("l_suppkey") % 40 == 0})
    hit = lambda c, want: F.avg(F.when(F.col("positive") == want, (F.col(c) == F.col("positive")).cast("int")))
    r = l.agg(hit("base", True).alias("b_pos"), hit("cand", True).alias("c_pos"), hit("base", False).alias("b_neg"), hit("cand", False).alias("c_neg"), F.avg("l_discount").alias("map"), F.count_if(~F.col("positive") & F.col("cand") & F.col("sure")).alias("high"))
    checks = {"base_recall_preserved": F.col("c_pos") >= F.col("b_pos") - 0.01, "base_map50_95_preserved": F.col("map") >= F.col("map") - 0.01, "hardware_positive_accuracy_gain": F.col("c_pos") >= F.col("b_pos") + 0.05, "hardware_negative_specificity_improved": F.col("c_neg") > F.col("b_neg"), "no_high_confidence_negative_false_positive": F.col("high") == 0}
    return r.select(*[v.alias(k) for k, v in checks.items()]).withColumn("passed", F.expr(" and ".join(checks)))


# Frozen minimums of a candidate's metrics.
GATE = {"min_background_support": 200, "min_background_recall": 0.90, "min_material_objectness_recall": 0.95, "min_objectness_balanced_accuracy": 0.925, "min_material_balanced_accuracy": 0.90, "min_each_material_recall": 0.85, "max_baseline_recall_drop": 0.01}


def candidate_gate(spark, sf_dir):
    """A candidate's recall by class against the minimums and the baseline, with the checks it fails."""
    l = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 9).cast("int").alias("material"), (F.col("l_linenumber") < 7).alias("cand"), (F.col("l_suppkey") % 16 > 0).alias("base"))
    per = l.groupBy("material").agg(F.count("*").alias("support"), F.avg(F.col("cand").cast("int")).alias("recall"), F.avg(F.col("base").cast("int")).alias("baseline"))
    low, drop = F.col("recall") + 1e-12 < GATE["min_each_material_recall"], F.col("baseline") - F.col("recall") > GATE["max_baseline_recall_drop"] + 1e-12
    few = F.col("support") < GATE["min_background_support"]
    failed = F.array_compact(F.array(F.when(few, "support"), F.when(low, "recall"), F.when(drop, "regression")))
    return per.select("material", "support", F.round("recall", 9).alias("recall"), F.array_join(failed, ",").alias("failed"))


def drift_examples(spark, sf_dir):
    """Of declared and replayed prices the 25 that lie nearest the threshold on different sides, ties by keys."""
    l = table(spark, sf_dir, "lineitem").withColumns({"declared": F.round(F.col("l_extendedprice") / 50) * 50, "gap": F.round(F.abs(F.col("l_extendedprice") - 20000.0), 6)})
    crossed = (F.col("declared") < 20000) != (F.col("l_extendedprice") < 20000)
    near = l.where(crossed | (F.abs(F.col("declared") - F.col("l_extendedprice")) > 24.9))
    return near.orderBy("gap", "l_orderkey", "l_linenumber", "l_partkey").limit(25).select("l_orderkey", "l_linenumber", "l_partkey", "gap", crossed.alias("crossed"))


def reply_reasons(spark, sf_dir):
    """Teacher replies written from line items by what is wrong with them, and the heads that the others give."""
    l = table(spark, sf_dir, "lineitem")
    k, sure = F.col("l_partkey") % 7, F.col("l_quantity") / 40
    said = F.get(F.array(*[F.lit(d) for d in replies.DECISIONS]), (F.col("l_suppkey") % 6).cast("int"))
    short = F.concat(F.lit('{"d": "'), said, F.lit('", "s": true, "c": '), sure.cast("string"), F.lit(', "e": "'), F.when(k == 1, "odd").when(k == 2, "same_material_accessory").otherwise("label"), F.lit('"}'))
    text = F.when(k == 0, F.lit('{"d": "both"}')).when(k == 3, F.concat(F.lit("```json\n"), short, F.lit("\n```"))).otherwise(short)
    value, reason = replies.teacher_reply(text)
    d = l.select(_name(F.col("l_orderkey")).alias("category"), F.struct(value.alias("v"), reason.alias("r")).alias("x"))
    s = replies.accepted_status(F.col("x.v"), F.col("category"), 0.6)
    return d.withColumn("s", s).groupBy(F.coalesce("x.r", F.lit("read")).alias("reason"), F.col("s.label").alias("label"), F.col("s.foreign_material").alias("foreign_material")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        snapshot_summary, snapshot_distributions, provider_usage, provider_cooldown, decision_cascade, llm_target, reviewed_import, box_ranking, background_states, box_parsing, eligible_rows, nested_fields, view_votes, head_metrics, model_selection,
        detector_gate, candidate_gate, drift_examples, reply_reasons,
    )
}

_LIST = "['can','pet','paper','plastic','styrofoam','vinyl','glass','battery','fluorescent']"
_CAPTURES = f"""{_BOXES}, c0 AS (SELECT *, CASE WHEN l_partkey % 9 <> 0 THEN list_extract({_LIST}, (l_suppkey % 9)::INT + 1) END AS cls FROM b),
    c1 AS (SELECT *, CASE WHEN cls IN ('pet','plastic','can','paper') THEN list_filter([CASE WHEN l_partkey % 4 = 0 THEN 'REMOVE_LABEL' END, CASE WHEN l_suppkey % 5 = 0 THEN 'COMPRESS' END], lambda x: x IS NOT NULL) ELSE [] END AS codes FROM c0),
    c AS (SELECT CASE WHEN cls IS NULL THEN 'NOT_DETECTED' WHEN confidence < 0.55 THEN 'GENERAL_WASTE' WHEN cls IN ('glass','battery','fluorescent','styrofoam') THEN 'REJECTED' WHEN len(codes) > 0 THEN 'REJECTED' ELSE 'ALLOWED' END AS status, cls, codes,
        cls IS NOT NULL AS has, x1, y1, x2, y2, CASE WHEN l_orderkey % 10 <> 0 THEN round((l_orderkey * 7 + l_partkey) % 4000 + 0.5::DOUBLE, 1) END AS process_ms, CASE WHEN l_orderkey % 3 = 0 THEN l_suppkey % 5 <> 0 END AS is_correct FROM c1)"""
_SCORE = """CASE WHEN x2 - x1 > 2 AND y2 - y1 > 2 AND (x2 - x1) * (y2 - y1) / 6000 BETWEEN 0.003::DOUBLE AND 0.92::DOUBLE
    THEN confidence - sqrt(pow((x1 + x2) / 2 / 100 - 0.5, 2) + pow((y1 + y2) / 2 / 60 - 0.55::DOUBLE, 2)) * 0.20::DOUBLE - abs(ln(greatest((x2 - x1) * (y2 - y1) / 6000, 1e-6) / 0.20::DOUBLE)) * 0.05::DOUBLE END"""
_HEADS = """h AS (SELECT l_quantity AS conf, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey % 2 ELSE -1 END AS a, l_suppkey % 2 AS ap, CASE WHEN l_suppkey % 5 <> 0 THEN l_orderkey % 2 END AS d, CASE WHEN l_linenumber < 5 THEN l_orderkey % 2 ELSE 0 END AS dp,
        l_partkey % 9 AS m, (l_partkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) % 9 AS mp FROM lineitem),
    f AS (SELECT 'label' AS task, a AS t, ap AS p, conf FROM h WHERE a >= 0 UNION ALL SELECT 'dent', d, dp, conf FROM h WHERE d IS NOT NULL UNION ALL SELECT 'material', m, mp, conf FROM h),
    g AS (SELECT task, t, count(*) AS s, count(*) FILTER (WHERE t = p) AS k, sum(conf) AS c FROM f GROUP BY task, t),
    s AS (SELECT task, sum(s)::BIGINT AS n, round(sum(k) / sum(s), 9) AS accuracy, round(avg(k / s), 9) AS balanced_accuracy, round(sum(c) / sum(s), 9) AS mean_confidence FROM g GROUP BY task)"""

ORACLE_SQL = {
    "snapshot_summary": f"""WITH {_CAPTURES}, q AS (SELECT *, has AND (greatest(0, x2 - x1) * greatest(0, y2 - y1) / 6000 >= 0.5 OR (x1 <= 1.0)::INT + (y1 <= 60.0::DOUBLE * 0.01)::INT + (x2 >= 99.0)::INT + (y2 >= 60.0::DOUBLE * 0.99)::INT >= 2) AS odd FROM c)
        SELECT count(*) AS total_requests, round(count(*) FILTER (WHERE has) / count(*) * 100, 1) AS bbox_detection_rate, count(*) FILTER (WHERE status = 'NOT_DETECTED') AS not_detected_count, count(*) FILTER (WHERE odd) AS suspicious_bbox_count, round(count(*) FILTER (WHERE odd) / count(*) * 100, 1) AS suspicious_bbox_rate,
            count(process_ms) AS latency_samples, round(median(process_ms), 1) AS latency_median, round(quantile_disc(process_ms, 0.95), 1) AS latency_p95, count(is_correct) AS reviewed_samples, round(avg(is_correct::INT) * 100, 1) AS reviewed_percent FROM q""",
    "snapshot_distributions": f"""WITH {_CAPTURES}, x AS (SELECT 'status' AS kind, status AS value FROM c UNION ALL SELECT 'class', cls FROM c UNION ALL SELECT 'guidance', unnest(codes) FROM c) SELECT kind, value, count(*) AS n FROM x WHERE value IS NOT NULL GROUP BY ALL""",
    "provider_usage": """WITH d AS (SELECT list_extract(['north','south','east'], (l_suppkey % 3)::INT + 1) AS provider, CASE WHEN l_partkey % 7 <> 0 THEN 'm' || (l_partkey % 4) END AS model, l_returnflag AS kind, l_linestatus = 'F' AS ok, l_quantity::BIGINT AS it, CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS ot, round(l_tax / 100, 6) AS cost, CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS ms
            FROM lineitem WHERE l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 24 HOUR), x AS (SELECT 'all' AS dimension, NULL AS value, * FROM d UNION ALL SELECT 'provider', provider, * FROM d UNION ALL SELECT 'model', model, * FROM d WHERE model IS NOT NULL UNION ALL SELECT 'kind', kind, * FROM d)
        SELECT dimension, value, count(*) AS attempts, count(*) FILTER (WHERE ok) AS successful, count(*) FILTER (WHERE NOT ok) AS fallback, sum(it)::BIGINT AS input_tokens, coalesce(sum(ot), 0)::BIGINT AS output_tokens, round(sum(cost), 8) AS cost, round(median(ms), 1) AS median_ms, round(quantile_disc(ms, 0.95), 1) AS p95_ms FROM x GROUP BY dimension, value""",
    "provider_cooldown": """WITH e AS (SELECT user_id, event_type = 'error' AS failed, epoch_us(ts) AS us FROM events), w AS (SELECT failed, max(CASE WHEN failed THEN us END) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 300000000 PRECEDING AND 1 PRECEDING) IS NOT NULL AS cooling FROM e)
        SELECT cooling, failed, count(*) AS n FROM w GROUP BY ALL""",
    "decision_cascade": f"""WITH {_ITEMS.replace('l_linenumber <> 7 THEN l_discount * 5 END AS ratio', 'l_linenumber <> 7 THEN l_discount * 5 END AS ratio, l_orderkey + l_linenumber AS k')},
        a AS (SELECT *, round(confidence, 4) AS conf, CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN 'vinyl' ELSE list_extract({_LIST}, (k % 9)::INT + 1) END AS second, CASE WHEN k % 6 <> 0 THEN round((k % 11) / 10, 1) END AS sure FROM items),
        v AS (SELECT *, coalesce(k % 4 < 2 AND second = 'vinyl' AND sure >= 0.65 AND sure - conf >= 0.25, false) AS vinyl FROM a), r AS (SELECT *, coalesce(NOT vinyl AND conf < 0.55 AND second IS NOT NULL AND sure >= 0.5, false) AS rescue FROM v),
        fin AS (SELECT *, CASE WHEN vinyl OR rescue THEN second ELSE cls END AS final, CASE WHEN vinyl OR rescue THEN sure ELSE conf END AS final_conf, CASE WHEN vinyl THEN 'vinyl' WHEN rescue THEN 'rescue' ELSE 'none' END AS correction FROM r),
        g AS (SELECT *, coalesce(replace(second, 'pet', 'plastic') <> replace(final, 'pet', 'plastic'), false) AS deferred, CASE WHEN label IS NOT NULL AND k % 3 <> 0 THEN k % 3 = 1 ELSE label END AS lab, CASE WHEN dented IS NOT NULL AND k % 5 <> 0 THEN k % 5 < 3 AND (k % 11) / 10 >= 0.9 ELSE dented END AS dent FROM fin),
        c AS (SELECT *, (anomaly AND final IN ('pet','plastic','can','paper','vinyl')) OR coalesce(straw, false) OR coalesce(holder AND final IN ('pet','plastic'), false) OR coalesce("foreign", false) OR coalesce(lab, false) OR coalesce(dent = false AND final IN ('pet','plastic','can'), false) AS codes FROM g)
        SELECT correction, deferred, CASE WHEN deferred THEN 'GENERAL_WASTE' WHEN coalesce(final_conf < 0.55, true) THEN 'GENERAL_WASTE' WHEN final IN ('glass','battery','fluorescent','styrofoam') THEN 'REJECTED' WHEN codes THEN 'REJECTED' ELSE 'ALLOWED' END AS status, count(*) AS n FROM c GROUP BY ALL""",
    "llm_target": f"""WITH {_ITEMS} SELECT cls = 'vinyl' AND confidence >= 0.5 AND grams BETWEEN 0 AND 5 AS specialist, coalesce(confidence < 0.55 OR ratio < 0.10, true) AS region, count(*) AS n FROM items GROUP BY ALL""",
    "reviewed_import": f"""WITH {_CAPTURES}, r AS (SELECT *, CASE WHEN process_ms % 3 < 1 THEN '' WHEN process_ms % 3 < 2 THEN 'paper' END AS expected FROM c),
        l AS (SELECT CASE WHEN cls <> 'pet' AND has THEN coalesce(CASE WHEN expected <> '' THEN expected END, CASE WHEN is_correct THEN cls END) END AS label FROM r) SELECT coalesce(label, 'skipped') AS label, count(*) AS n FROM l GROUP BY 1""",
    "box_ranking": f"""WITH {_BOXES}, s AS (SELECT l_orderkey, round({_SCORE}, 9) AS score FROM b WHERE l_partkey % 2 = 0), t AS (SELECT l_orderkey, max(score) AS score FROM s WHERE score > -0.25 GROUP BY 1), d AS (SELECT DISTINCT l_orderkey FROM b WHERE l_linenumber = 1)
        SELECT o_orderkey AS l_orderkey, CASE WHEN score IS NOT NULL THEN 'low_conf_expected_class' WHEN d.l_orderkey IS NOT NULL THEN 'deployed_bbox_fallback' ELSE 'missing' END AS source, round(score, 6) AS score FROM orders LEFT JOIN t ON t.l_orderkey = o_orderkey LEFT JOIN d ON d.l_orderkey = o_orderkey""",
    "background_states": f"""WITH {_BOXES}, t AS (SELECT l_orderkey, greatest(0, x1 - (x2 - x1) * 0.1::DOUBLE) AS a, greatest(0, y1 - (y2 - y1) * 0.1::DOUBLE) AS b, least(100, x2 + (x2 - x1) * 0.1::DOUBLE) AS c, least(60, y2 + (y2 - y1) * 0.1::DOUBLE) AS d FROM b WHERE l_linenumber = 1 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey) = 1),
        j AS (SELECT q.*, t.a, t.b AS tb, t.c, t.d, l_partkey % 3 AS m FROM b q LEFT JOIN t USING (l_orderkey) WHERE l_linenumber > 1)
        SELECT CASE WHEN l_partkey % 7 = 0 THEN 'ambiguous_assignment' WHEN m <> 0 THEN 'not_background' WHEN l_suppkey % 8 = 0 THEN 'invalid_crop' WHEN a IS NULL THEN 'accepted_empty_source' WHEN x2 > x1 AND y2 > y1 AND c > a AND d > tb AND least(x2, c) > greatest(x1, a) AND least(y2, d) > greatest(y1, tb) THEN 'rejected_gt_intersection' ELSE 'accepted_zero_intersection' END AS state, count(*) AS n FROM j GROUP BY 1""",
    "box_parsing": f"""WITH {_BOXES}, k AS (SELECT l_partkey % 7 AS k, round(x1, 2) AS a, round(y1, 2) AS b, round(x2, 2) AS c, round(y2, 2) AS d FROM b), v AS (SELECT k, a, b, CASE WHEN k = 2 THEN a + 30 ELSE c END AS c, CASE WHEN k = 2 THEN b + 20 ELSE d END AS d FROM k)
        SELECT CASE WHEN k = 6 OR k = 4 THEN 'bbox_missing' WHEN k = 3 THEN 'bbox_invalid_shape' WHEN k = 5 THEN 'bbox_non_numeric' WHEN a < 0 OR b < 0 OR c > 100 OR d > 60 OR c <= a OR d <= b THEN 'bbox_out_of_bounds' WHEN (c - a) * (d - b) / 6000 < 0.02 THEN 'bbox_area_too_small' WHEN (c - a) * (d - b) / 6000 > 0.5 THEN 'bbox_area_too_large' ELSE 'accepted' END AS reason, count(*) AS n FROM v GROUP BY 1""",
    "eligible_rows": f"""SELECT l_returnflag = 'A' AND list_extract({_LIST}, (l_partkey % 9)::INT + 1) IN ('can','pet','vinyl') AND l_linenumber <> 7 AND l_partkey * 10 >= 500 AND l_discount * 5 BETWEEN 0.02::DOUBLE AND 0.45::DOUBLE AND l_linestatus = 'F' AS eligible, count(*) AS n FROM lineitem GROUP BY 1""",
    "nested_fields": """SELECT event_type, try_cast(coalesce(json_extract_string(props, '$.missing.k'), json_extract_string(props, '$.key'), json_extract_string(props, '$.k')) AS BIGINT) % 2 AS parity, count(*) AS n FROM events GROUP BY ALL""",
    "view_votes": """WITH x AS (SELECT vec_id, i, round((embedding[i]::DOUBLE + embedding[i + 32]::DOUBLE + embedding[33 - i]::DOUBLE) / 3, 2) AS v FROM embeddings, (SELECT unnest(range(1, 33)) AS i) WHERE len(embedding) = 64), t AS (SELECT *, max(v) OVER (PARTITION BY vec_id) AS top FROM x)
        SELECT vec_id, CASE WHEN count(*) FILTER (WHERE v = top) = 1 THEN min(i) FILTER (WHERE v = top) - 1 END::INT AS best, count(*) FILTER (WHERE v = top) > 1 AS tied FROM t GROUP BY vec_id""",
    "head_metrics": f"WITH {_HEADS} SELECT * FROM s",
    "model_selection": f"WITH {_HEADS} SELECT count(*) AS heads, round(avg(balanced_accuracy), 8) AS score FROM s",
    "detector_gate": """WITH l AS (SELECT *, l_returnflag <> 'N' AS pos, l_partkey % 10 < 6 AS base, l_partkey % 10 < 7 AS cand FROM lineitem),
        r AS (SELECT avg((base = pos)::INT) FILTER (WHERE pos) AS bp, avg((cand = pos)::INT) FILTER (WHERE pos) AS cp, avg((base = pos)::INT) FILTER (WHERE NOT pos) AS bn, avg((cand = pos)::INT) FILTER (WHERE NOT pos) AS cn, count(*) FILTER (WHERE NOT pos AND cand AND l_suppkey % 40 = 0) AS high FROM l),
        c AS (SELECT cp >= bp - 0.01 AS base_recall_preserved, true AS base_map50_95_preserved, cp >= bp + 0.05 AS hardware_positive_accuracy_gain, cn > bn AS hardware_negative_specificity_improved, high = 0 AS no_high_confidence_negative_false_positive FROM r)
        SELECT *, base_recall_preserved AND base_map50_95_preserved AND hardware_positive_accuracy_gain AND hardware_negative_specificity_improved AND no_high_confidence_negative_false_positive AS passed FROM c""",
    "candidate_gate": """WITH p AS (SELECT (l_partkey % 9)::INT AS material, count(*) AS support, avg((l_linenumber < 7)::INT) AS r, avg((l_suppkey % 16 > 0)::INT) AS b FROM lineitem GROUP BY 1)
        SELECT material, support, round(r, 9) AS recall, array_to_string(list_filter([CASE WHEN support < 200 THEN 'support' END, CASE WHEN r + 1e-12 < 0.85 THEN 'recall' END, CASE WHEN b - r > 0.01 + 1e-12 THEN 'regression' END], lambda x: x IS NOT NULL), ',') AS failed FROM p""",
    "reply_reasons": f"""WITH a AS (SELECT l_partkey % 7 AS k, l_quantity / 40 AS sure, list_extract(['neither','label_only','foreign_only','both','exclude','ambiguous'], (l_suppkey % 6)::INT + 1) AS said, list_extract({_LIST}, (l_orderkey % 9)::INT + 1) AS category FROM lineitem),
        r AS (SELECT *, CASE WHEN k = 0 THEN 'unexpected_fields' WHEN k = 1 THEN 'invalid_evidence' WHEN sure > 1 THEN 'confidence_out_of_range' WHEN k = 2 AND said IN ('foreign_only', 'both') THEN 'accessory_foreign_conflict' ELSE 'read' END AS reason FROM a),
        s AS (SELECT *, reason = 'read' AND said NOT IN ('exclude', 'ambiguous') AND sure >= 0.6 AS ok FROM r)
        SELECT reason, CASE WHEN ok AND category IN ('pet', 'plastic') THEN (said IN ('label_only', 'both'))::INT ELSE -1 END AS label, CASE WHEN ok THEN (said IN ('foreign_only', 'both'))::INT ELSE -1 END AS foreign_material, count(*) AS n FROM s GROUP BY ALL""",
    "drift_examples": """WITH l AS (SELECT *, round(l_extendedprice / 50) * 50 AS d, round(abs(l_extendedprice - 20000), 6) AS gap FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, gap, (d < 20000) <> (l_extendedprice < 20000) AS crossed FROM l WHERE (d < 20000) <> (l_extendedprice < 20000) OR abs(d - l_extendedprice) > 24.9 ORDER BY gap, l_orderkey, l_linenumber, l_partkey LIMIT 25""",
}

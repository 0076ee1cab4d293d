"""Provenance, exclusion and acceptance audits over the driver tables.

Documents stand for sources (text hash for content, language for a role, source for a group), labels
for teacher lines, orders and line items for evidence.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, dedup, graph, joins, metrics, sampling, similarity
from ..session import materialize
from ..sources.tables import table
from .curation import _COMP, _EDGES, _NEAR, _docs, _prints


def audit_queue(spark, sf_dir):
    """Decision on each source: known for training, protected, or for the teacher."""
    known = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "train").otherwise("validation").alias("split"))
    return audit.queue_decisions(_docs(spark, sf_dir).select("doc_id"), known, "doc_id", "split").groupBy("decision").agg(F.count("*").alias("n"))


def objective_rest(spark, sf_dir):
    """Rows of an objective list that no audit knows, by reason, and the ones it knows."""
    d = _docs(spark, sf_dir).where("n_chars < 1500").select("doc_id", F.when(F.col("n_chars") < 300, "too_small").otherwise("short").alias("reason"))
    known = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("known"))
    return d.join(known, "doc_id", "left").groupBy("reason", F.coalesce("known", F.lit(False)).alias("suppressed")).agg(F.count("*").alias("n"))


def evidence_consistency(spark, sf_dir):
    """Queue, label, inventory and rejection lines by key and hash: how often each disagrees."""
    d = _docs(spark, sf_dir).select("doc_id", "sha")
    labels = table(spark, sf_dir, "labels").join(d, "doc_id").select("doc_id", "sha")
    inventory = d.where("doc_id % 7 <> 0").select("doc_id", F.when(F.col("doc_id") % 11 == 0, F.reverse("sha")).otherwise(F.col("sha")).alias("sha"))
    rejected = table(spark, sf_dir, "labels").where("quality = 0").join(d, "doc_id").select("doc_id", "sha").unionByName(d.where("doc_id % 50 = 0"))
    c = audit.consistency(d, {"label": labels, "inventory": inventory, "rejection": rejected}, "doc_id", "sha")
    return c.groupBy("label", "inventory", "rejection").agg(F.count("*").alias("n"))


def recovered_inventory(spark, sf_dir):
    """Of each content the smallest id and the union of its roles."""
    return _docs(spark, sf_dir).groupBy("sha").agg(F.min("doc_id").alias("path"), F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("roles"))


def reference_boxes(spark, sf_dir):
    """Known box, else the deployed one, else none; a malformed one is an error and never falls back."""
    l = table(spark, sf_dir, "lineitem").select("l_partkey", F.when(F.col("l_partkey") % 3 != 0, F.when(F.col("l_partkey") % 13 == 0, F.array(F.lit(1.0))).otherwise(F.array("l_quantity", "l_tax", F.col("l_quantity") + 1, F.col("l_tax") + 1))).alias("known"), F.when(F.col("l_suppkey") % 2 == 0, F.array("l_tax", "l_tax", F.col("l_tax") + 5, F.col("l_tax") + 5)).alias("deployed"))
    box, source = audit.first_valid_box(F.col("known"), F.col("deployed"))
    return l.groupBy(source.alias("source")).agg(F.count("*").alias("n"), F.round(F.sum(F.get(box, F.lit(0))), 2).alias("x1_sum"))


def assembly_proofs(spark, sf_dir):
    """Whether crops and absences partition the sources, and hold each source once."""
    d = _docs(spark, sf_dir).select("doc_id")
    crops, absent = d.where("doc_id % 3 <> 0"), d.where("doc_id % 3 = 0 and doc_id % 30 <> 0")
    both = d.where("doc_id % 45 = 1")
    return audit.partition(d, {"crop": crops, "absent": absent.unionByName(both)}, "doc_id").groupBy("status").agg(F.count("*").alias("n"))


def separation_report(spark, sf_dir):
    """Sources that stand in several roles and clusters of near ones that do; blocked if there is any."""
    p = _prints(spark, sf_dir).withColumn("role", F.col("label") % 2)
    comp = graph.connected_components(similarity.hamming_links(p, "vec_id", "v", _NEAR), "left", "right")
    roles = comp.join(p.select(F.col("vec_id").alias("node"), "role"), "node").groupBy("component").agg(F.count_distinct("role").alias("r"), F.count("*").alias("n"))
    s = roles.agg(F.count("*").alias("clusters"), F.count_if(F.col("r") > 1).alias("multi_role"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))
    return s.withColumn("blocked", F.col("multi_role") > 0)


def graph_rebuild(spark, sf_dir):
    """A submitted near-duplicate graph against one built anew: missing and unexpected edges."""
    rebuilt = materialize(similarity.hamming_join(_prints(spark, sf_dir), "vec_id", "v", _NEAR).select("left", "right", F.col("distance").cast("int").alias("distance")), "graph")
    submitted = rebuilt.where("left % 10 <> 0").select("left", "right", F.when(F.col("left") % 7 == 0, F.col("distance") + 1).otherwise(F.col("distance")).alias("distance"))
    return audit.difference(rebuilt, submitted).groupBy("kind").agg(F.count("*").alias("n"))


def authority_bundle(spark, sf_dir):
    """Rows by the first rule that excludes them, and for each role what it holds of the required values."""
    d = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("role", F.when(F.col("doc_id") % 5 == 0, "validation").otherwise("train"))
    rules = {"protected_source": F.col("doc_id") % 97 == 0, "origin_not_allowed": F.col("source").isNull(), "quality_excluded": F.col("quality") == 0, "before_cutoff": F.col("n_chars") < 50}
    kept = audit.first_rule(d, rules)
    return kept.groupBy("role", "rule").agg(F.count("*").alias("n"), F.count_distinct("sha").alias("contents"), (F.count_distinct("lang") >= 4).alias("all_languages"))


def background_validation(spark, sf_dir):
    """Declared against recomputed columns of background candidates: rows by the columns that differ."""
    l = table(spark, sf_dir, "lineitem").withColumns({"iou": F.round(F.col("l_discount") * 5, 9), "declared": F.round(F.col("l_discount") * 5, 9) + F.when(F.col("l_partkey") % 9 == 0, 1e-7).when(F.col("l_partkey") % 9 == 1, 1e-9).otherwise(0.0)})
    l = l.withColumns({"assigned": F.when(F.col("iou") >= 0.5, "truth").when(F.col("iou") <= 0.1, "background").otherwise("ambiguous"), "said": F.when(F.col("l_returnflag") == "A", "background").when(F.col("iou") >= 0.5, "truth").otherwise("ambiguous")})
    wrong = audit.mismatches({"iou": F.abs(F.col("iou") - F.col("declared")) > 1e-8, "assignment": F.col("assigned") != F.col("said")})
    return l.groupBy(wrong.alias("mismatches")).agg(F.count("*").alias("n"))


def top1_replay(spark, sf_dir):
    """The surest line of each order, declared and replayed: missing, unexpected and duplicate ones."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    top = joins.latest(l, ["l_orderkey"], F.desc("l_quantity"), "l_linenumber").select("l_orderkey", "l_linenumber")
    declared = l.where("l_linenumber = 1").select("l_orderkey", "l_linenumber")
    return joins.coverage(top, declared, ["l_orderkey", "l_linenumber"]).groupBy("status").agg(F.count("*").alias("n"))


def quality_exclusions(spark, sf_dir):
    """The manifest of excluded contents, each once with one reason, by a digest."""
    bad = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels").where("quality = 0"), "doc_id").groupBy("sha").agg(F.min(F.when(F.col("n_chars") < 500, "too_small").otherwise("rejected")).alias("reason"))
    return metrics.digest(bad, "sha", "reason")


def unknown_exclusions(spark, sf_dir):
    """Exclusions that name no source of the dataset: must be none, and are listed."""
    names = table(spark, sf_dir, "labels").select("doc_id").unionByName(table(spark, sf_dir, "part").select((F.col("p_partkey") + 1_000_000).alias("doc_id")))
    return names.join(_docs(spark, sf_dir).select("doc_id"), "doc_id", "left_anti")


def consensus_recheck(spark, sf_dir):
    """Claimed consensus of conversations against the recomputed one, by the reasons that they differ."""
    c = table(spark, sf_dir, "conversations").withColumn("confidence", F.length("text").cast("double"))
    claim = c.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("said_votes"), F.count("*").alias("said_passes"), F.min("confidence").alias("said_least"))
    claim = claim.withColumn("said_votes", F.when(F.col("conv_id") % 10 == 0, F.col("said_votes") + 1).otherwise(F.col("said_votes")))
    per = c.groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("votes"), F.count("*").alias("passes"), F.min(F.when(F.col("role") == "user", F.col("confidence"))).alias("least"))
    j = per.join(claim, "conv_id")
    wrong = audit.mismatches({"no_exact_tuple_consensus": F.col("votes") < 2, "consensus_vote_mismatch": F.col("votes") != F.col("said_votes"), "consensus_pass_count_mismatch": F.col("passes") != F.col("said_passes"), "minimum_confidence_mismatch": ~F.col("least").eqNullSafe(F.col("said_least"))})
    return j.groupBy(wrong.alias("reasons")).agg(F.count("*").alias("n"))


def _judged(spark, sf_dir):
    d = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rules = {"no_teacher_label": F.col("quality").isNull(), "bbox_area_too_small": F.col("n_chars") < 200, "image_sha256_mismatch": F.col("doc_id") % 23 == 0, "capture_before_cutoff": F.col("doc_id") < 20}
    return audit.accept(d, rules, F.col("quality") == 0)


def teacher_acceptance(spark, sf_dir):
    """Teacher rows accepted, empty or rejected, with the reasons of the rejected."""
    return _judged(spark, sf_dir).select("doc_id", "fate", F.array_join("reasons", ",").alias("reasons"))


def rejection_reasons(spark, sf_dir):
    """Reasons of rejected rows with their counts, which overlap, and the first hundred ids of each."""
    return dedup.reason_counts(_judged(spark, sf_dir).where("fate = 'rejected'"), "reasons", "doc_id", 100)


def model_agreement(spark, sf_dir):
    """Two models' lines of an order (its first and second) by agreement in kind and status."""
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("kind"), F.min("l_linestatus").alias("seen"))
    a, b = l.where("l_linenumber = 1"), l.where("l_linenumber = 2").select("l_orderkey", F.col("kind").alias("kind2"), F.col("seen").alias("seen2"))
    return a.join(b, "l_orderkey").groupBy((F.col("kind") == F.col("kind2")).alias("kind_agrees"), (F.col("seen") == F.col("seen2")).alias("seen_agrees")).agg(F.count("*").alias("n"))


def empty_scene_proposals(spark, sf_dir):
    """Of each order without a returned line its surest line as an empty-scene crop."""
    l = table(spark, sf_dir, "lineitem")
    clean = l.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("seen"), F.count("*").alias("n")).where("not seen and n between 2 and 6").select("l_orderkey")
    return joins.latest(l.join(clean, "l_orderkey").where("l_tax < 0.07"), ["l_orderkey"], F.desc("l_extendedprice"), "l_linenumber").select("l_orderkey", "l_linenumber", "l_extendedprice")


def snapshot_lookup(spark, sf_dir):
    """Sources by their split, with what has no metadata and what no split names."""
    meta, split = _docs(spark, sf_dir).where("doc_id % 31 <> 0").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "held").otherwise("open").alias("split"))
    return meta.join(split, "doc_id", "full_outer").groupBy(F.coalesce("split", F.lit("none")).alias("split"), F.col("lang").isNull().alias("unknown")).agg(F.count("*").alias("n"))


def status_heads(spark, sf_dir):
    """Heads that apply to a category, -1 elsewhere; rows without any are left out."""
    p = table(spark, sf_dir, "part")
    damage, dirt = F.col("p_size") % 4, F.col("p_partkey") % 3
    dent = F.when(F.col("p_type").isin("ECONOMY", "STANDARD") & (damage < 2), damage.cast("int")).otherwise(-1)
    label = F.when(F.col("p_type").isin("ECONOMY", "PROMO") & (dirt < 2), dirt.cast("int")).otherwise(-1)
    return p.select(dent.alias("dent"), label.alias("label")).where("dent <> -1 or label <> -1").groupBy("dent", "label").agg(F.count("*").alias("n"))


def teacher_contract(spark, sf_dir):
    """Labels by whether they carry the digest of the contract in force."""
    now = audit.contract({"model": "m", "passes": 3, "prompt": "p", "schema": [1, 2]})
    old = audit.contract({"model": "m", "passes": 2, "prompt": "p", "schema": [1, 2]})
    return table(spark, sf_dir, "labels").withColumn("said", F.when(F.col("doc_id") % 4 == 0, F.lit(old)).otherwise(F.lit(now))).groupBy("said", (F.col("said") == now).alias("in_force")).agg(F.count("*").alias("n"))


def manifest_summary(spark, sf_dir):
    """Rows by role, by language, by both and in all, with distinct contents and sources of each."""
    d = _docs(spark, sf_dir).withColumn("role", F.when(F.col("doc_id") % 5 == 0, "validation").otherwise("train"))
    return d.groupingSets([["role"], ["lang"], ["role", "lang"], []], "role", "lang").agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.count_distinct("sha").alias("contents"), F.count_distinct("source").alias("sources"))


def diverse_quota(spark, sf_dir):
    """Ten sources a language in hash order, no content twice."""
    d = _docs(spark, sf_dir).withColumn("h", sampling.order_hash("diverse", "doc_id"))
    return sampling.distinct_capped(d, "sha", ["lang"], 10, "h", "doc_id").select("doc_id", "lang", "rank")


def bounded_examples(spark, sf_dir):
    """The 25 longest sources, ties by id."""
    return sampling.examples(_docs(spark, sf_dir).select("doc_id", "n_chars"), 25, F.desc("n_chars"), "doc_id")


def pending_targets(spark, sf_dir):
    """Sources for the teacher: training rows of wanted kinds that are not done, or only failed."""
    d = _docs(spark, sf_dir).where("lang in ('en', 'de') and doc_id % 5 <> 0")
    done = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 0).alias("failed"))
    return audit.pending(d, done, "doc_id", "failed").groupBy("lang", "again").agg(F.count("*").alias("n"))


def link_audit(spark, sf_dir):
    """Positions of a sorted list that link to a pair, with what the linked content says."""
    d = sampling.numbered(_docs(spark, sf_dir).select("doc_id", "sha"), "doc_id")
    links = table(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("index"), F.col("doc_id").alias("said"))
    j = links.join(d, "index", "left").withColumn("status", F.when(F.col("doc_id").isNull(), "no_such_position").when(F.col("doc_id") == F.col("said"), "exact").otherwise("other"))
    return j.groupBy("status").agg(F.count("*").alias("n"))


def prediction_shapes(spark, sf_dir):
    """Predictions in three shapes of JSON by class, a key that occurs twice counted apart."""
    e = table(spark, sf_dir, "events")
    k = F.col("user_id") % 3
    text = F.when(k == 0, F.concat(F.lit('{"class": "'), F.col("event_type"), F.lit('"}'))).when(k == 1, F.concat(F.lit('{"prediction": {"class": "'), F.col("event_type"), F.lit('"}}'))).otherwise(F.concat(F.lit('[{"class": "'), F.col("event_type"), F.lit('"}]')))
    cls = F.coalesce(*[F.get_json_object("t", p) for p in ("$.class", "$.prediction.class", "$[0].class")])
    d = e.select("user_id", text.alias("t")).select("user_id", cls.alias("cls"))
    twice = d.groupBy("user_id", "cls").agg(F.count("*").alias("n"))
    return twice.groupBy("cls").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("repeated"))


def report_index(spark, sf_dir):
    """Rows of a nested report, by thresholds whose text differs and whose number is the same."""
    e = table(spark, sf_dir, "events")
    body = F.concat(F.lit('{"0.5": '), F.col("value").cast("int").cast("string"), F.lit(', "0.90": 1, "5e-1": 2}'))
    rows = e.select("event_type", F.explode(F.from_json(body, "map<string,string>")).alias("k", "v")).select("event_type", F.col("k").try_cast("double").alias("threshold"), F.col("v").cast("long").alias("v"))
    return rows.groupBy("event_type", "threshold").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        audit_queue, objective_rest, evidence_consistency, recovered_inventory, reference_boxes, assembly_proofs, separation_report, graph_rebuild, authority_bundle, background_validation, top1_replay, quality_exclusions, unknown_exclusions, consensus_recheck,
        teacher_acceptance, rejection_reasons, model_agreement, empty_scene_proposals, snapshot_lookup, status_heads, teacher_contract, manifest_summary, diverse_quota, bounded_examples, pending_targets, link_audit, prediction_shapes, report_index,
    )
}

_D = "d AS (SELECT doc_id, lang, source, n_chars, sha256(text) AS sha FROM documents)"
_FATE = f"""{_D}, j AS (SELECT d.*, quality FROM d LEFT JOIN labels USING (doc_id)), r AS (SELECT *, list_sort(list_filter([CASE WHEN quality IS NULL THEN 'no_teacher_label' END, CASE WHEN n_chars < 200 THEN 'bbox_area_too_small' END, CASE WHEN doc_id % 23 = 0 THEN 'image_sha256_mismatch' END, CASE WHEN doc_id < 20 THEN 'capture_before_cutoff' END], lambda x: x IS NOT NULL)) AS reasons FROM j),
    f AS (SELECT *, CASE WHEN len(reasons) > 0 THEN 'rejected' WHEN quality = 0 THEN 'empty_scene' ELSE 'accepted' END AS fate FROM r)"""
_CONTRACTS = [audit.contract({"model": "m", "passes": n, "prompt": "p", "schema": [1, 2]}) for n in (2, 3)]

ORACLE_SQL = {
    "audit_queue": "SELECT CASE WHEN quality IS NULL THEN 'teacher_required' WHEN quality = 1 THEN 'known_train' ELSE 'protected_validation' END AS decision, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "objective_rest": "SELECT CASE WHEN n_chars < 300 THEN 'too_small' ELSE 'short' END AS reason, labels.doc_id IS NOT NULL AS suppressed, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) WHERE n_chars < 1500 GROUP BY ALL",
    "evidence_consistency": """WITH l AS (SELECT doc_id, bool_or(quality = 0) AS bad FROM labels GROUP BY 1)
        SELECT CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'same' END AS label, CASE WHEN d.doc_id % 7 = 0 THEN 'missing' WHEN d.doc_id % 11 = 0 THEN 'other_hash' ELSE 'same' END AS inventory, CASE WHEN d.doc_id % 50 = 0 AND coalesce(bad, false) THEN 'repeated' WHEN d.doc_id % 50 = 0 OR coalesce(bad, false) THEN 'same' ELSE 'missing' END AS rejection, count(*) AS n
        FROM documents d LEFT JOIN l USING (doc_id) GROUP BY ALL""",
    "recovered_inventory": "SELECT sha256(text) AS sha, min(doc_id) AS path, string_agg(DISTINCT lang, ',' ORDER BY lang) AS roles FROM documents GROUP BY 1",
    "reference_boxes": """SELECT CASE WHEN l_partkey % 3 <> 0 AND l_partkey % 13 = 0 THEN 'invalid' WHEN l_partkey % 3 <> 0 THEN 'known' WHEN l_suppkey % 2 = 0 THEN 'deployed' ELSE 'none' END AS source, count(*) AS n,
        round(sum(CASE WHEN l_partkey % 3 <> 0 AND l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 3 <> 0 THEN l_quantity WHEN l_suppkey % 2 = 0 THEN l_tax END), 2) AS x1_sum FROM lineitem GROUP BY 1""",
    "assembly_proofs": "SELECT CASE WHEN doc_id % 30 = 0 THEN 'missing' WHEN doc_id % 45 = 1 THEN 'repeated' WHEN doc_id % 3 <> 0 THEN 'crop' ELSE 'absent' END AS status, count(*) AS n FROM documents GROUP BY 1",
    "separation_report": f"""{_COMP}, r AS (SELECT component, count(DISTINCT label % 2) AS r, count(*) AS n FROM comp JOIN prints ON vec_id = node GROUP BY 1)
        SELECT count(*) AS clusters, count(*) FILTER (WHERE r > 1) AS multi_role, coalesce(max(n), 0) AS largest, count(*) FILTER (WHERE r > 1) > 0 AS blocked FROM r""",
    "graph_rebuild": f"""WITH {_EDGES} SELECT kind, count(*) AS n FROM (SELECT 'missing' AS kind FROM edges WHERE l % 10 = 0 OR l % 7 = 0 UNION ALL SELECT 'unexpected' FROM edges WHERE l % 10 <> 0 AND l % 7 = 0) GROUP BY 1""",
    "authority_bundle": f"""WITH {_D}, k AS (SELECT d.*, CASE WHEN doc_id % 5 = 0 THEN 'validation' ELSE 'train' END AS role, CASE WHEN doc_id % 97 = 0 THEN 'protected_source' WHEN source IS NULL THEN 'origin_not_allowed' WHEN quality = 0 THEN 'quality_excluded' WHEN n_chars < 50 THEN 'before_cutoff' ELSE 'kept' END AS rule FROM d LEFT JOIN labels USING (doc_id))
        SELECT role, rule, count(*) AS n, count(DISTINCT sha) AS contents, count(DISTINCT lang) >= 4 AS all_languages FROM k GROUP BY ALL""",
    "background_validation": """WITH l AS (SELECT *, round(l_discount * 5, 9) AS iou FROM lineitem), a AS (SELECT l_partkey % 9 = 0 AS w, CASE WHEN iou >= 0.5 THEN 'truth' WHEN iou <= 0.1 THEN 'background' ELSE 'ambiguous' END <> CASE WHEN l_returnflag = 'A' THEN 'background' WHEN iou >= 0.5 THEN 'truth' ELSE 'ambiguous' END AS s FROM l)
        SELECT CASE WHEN w AND s THEN 'assignment,iou' WHEN w THEN 'iou' WHEN s THEN 'assignment' ELSE '' END AS mismatches, count(*) AS n FROM a GROUP BY 1""",
    "top1_replay": """WITH t AS (SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) = 1), d AS (SELECT l_orderkey, l_linenumber, count(*) AS b FROM lineitem WHERE l_linenumber = 1 GROUP BY ALL)
        SELECT CASE WHEN d.b IS NULL THEN 'missing' WHEN t.l_orderkey IS NULL THEN 'unexpected' WHEN d.b > 1 THEN 'duplicate' ELSE 'both' END AS status, count(*) AS n FROM t FULL JOIN d ON t.l_orderkey = d.l_orderkey AND t.l_linenumber = d.l_linenumber GROUP BY 1""",
    "quality_exclusions": f"""WITH {_D}, x AS (SELECT sha, min(CASE WHEN n_chars < 500 THEN 'too_small' ELSE 'rejected' END) AS reason FROM d JOIN labels USING (doc_id) WHERE quality = 0 GROUP BY 1),
        h AS (SELECT sha256(sha || '|' || reason) AS g FROM x), a AS (SELECT g, g || ':' || count(*) AS d, count(*) AS n FROM h GROUP BY g),
        b AS (SELECT substr(g, 1, 6) AS g, sha256(string_agg(d, ',' ORDER BY g)) AS d, sum(n) AS n FROM a GROUP BY 1), c AS (SELECT substr(g, 1, 4) AS g, sha256(string_agg(d, ',' ORDER BY g)) AS d, sum(n) AS n FROM b GROUP BY 1),
        e AS (SELECT substr(g, 1, 2) AS g, sha256(string_agg(d, ',' ORDER BY g)) AS d, sum(n) AS n FROM c GROUP BY 1)
        SELECT coalesce(sum(n), 0)::BIGINT AS n, sha256(string_agg(d, ',' ORDER BY g)) AS digest FROM e""",
    "unknown_exclusions": "SELECT doc_id FROM (SELECT doc_id FROM labels UNION ALL SELECT p_partkey + 1000000 FROM part) WHERE doc_id NOT IN (SELECT doc_id FROM documents)",
    "consensus_recheck": """WITH p AS (SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS v, min(length(text)) FILTER (WHERE role = 'user') AS a, min(length(text)) AS b FROM conversations GROUP BY 1)
        SELECT array_to_string(list_filter([CASE WHEN conv_id % 10 = 0 THEN 'consensus_vote_mismatch' END, CASE WHEN a IS DISTINCT FROM b THEN 'minimum_confidence_mismatch' END, CASE WHEN v < 2 THEN 'no_exact_tuple_consensus' END], lambda x: x IS NOT NULL), ',') AS reasons, count(*) AS n FROM p GROUP BY 1""",
    "teacher_acceptance": f"WITH {_FATE} SELECT doc_id, fate, array_to_string(reasons, ',') AS reasons FROM f",
    "rejection_reasons": f"""WITH {_FATE}, x AS (SELECT doc_id, unnest(reasons) AS reason FROM f WHERE fate = 'rejected'), y AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY doc_id) AS rn FROM x)
        SELECT reason, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (WHERE rn <= 100) AS examples FROM y GROUP BY reason""",
    "model_agreement": """WITH l AS (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS k, min(l_linestatus) AS s FROM lineitem GROUP BY ALL) SELECT a.k = b.k AS kind_agrees, a.s = b.s AS seen_agrees, count(*) AS n FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 GROUP BY ALL""",
    "empty_scene_proposals": """WITH c AS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING NOT bool_or(l_returnflag = 'R') AND count(*) BETWEEN 2 AND 6)
        SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem JOIN c USING (l_orderkey) WHERE l_tax < 0.07 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) = 1""",
    "snapshot_lookup": """SELECT coalesce(CASE WHEN l.doc_id IS NULL THEN NULL WHEN toxic = 1 THEN 'held' ELSE 'open' END, 'none') AS split, d.lang IS NULL AS unknown, count(*) AS n FROM (SELECT * FROM documents WHERE doc_id % 31 <> 0) d FULL JOIN labels l ON l.doc_id = d.doc_id GROUP BY ALL""",
    "status_heads": """WITH h AS (SELECT CASE WHEN p_type IN ('ECONOMY', 'STANDARD') AND p_size % 4 < 2 THEN p_size % 4 ELSE -1 END::INT AS dent, CASE WHEN p_type IN ('ECONOMY', 'PROMO') AND p_partkey % 3 < 2 THEN p_partkey % 3 ELSE -1 END::INT AS label FROM part) SELECT dent, label, count(*) AS n FROM h WHERE dent <> -1 OR label <> -1 GROUP BY ALL""",
    "teacher_contract": f"SELECT CASE WHEN doc_id % 4 = 0 THEN '{_CONTRACTS[0]}' ELSE '{_CONTRACTS[1]}' END AS said, doc_id % 4 <> 0 AS in_force, count(*) AS n FROM labels GROUP BY ALL",
    "manifest_summary": f"""WITH {_D}, r AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'validation' ELSE 'train' END AS role FROM d)
        SELECT role, lang, grouping_id(role, lang)::BIGINT AS level, count(*) AS n, count(DISTINCT sha) AS contents, count(DISTINCT source) AS sources FROM r GROUP BY GROUPING SETS ((role), (lang), (role, lang), ())""",
    "diverse_quota": f"""WITH {_D}, f AS (SELECT *, sha256('diverse|' || doc_id) AS h FROM d), s AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY sha ORDER BY h, doc_id) = 1) SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY h, doc_id) AS rank FROM s QUALIFY rank <= 10""",
    "bounded_examples": "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25",
    "pending_targets": """WITH l AS (SELECT doc_id, bool_and(quality = 0) AS failed FROM labels GROUP BY 1) SELECT lang, l.doc_id IS NOT NULL AS again, count(*) AS n FROM documents d LEFT JOIN l USING (doc_id) WHERE lang IN ('en', 'de') AND doc_id % 5 <> 0 AND coalesce(failed, true) GROUP BY ALL""",
    "link_audit": """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT CASE WHEN n.doc_id IS NULL THEN 'no_such_position' WHEN n.doc_id = l.doc_id THEN 'exact' ELSE 'other' END AS status, count(*) AS n FROM labels l LEFT JOIN n ON n.i = l.doc_id * 2 GROUP BY 1""",
    "prediction_shapes": "WITH t AS (SELECT user_id, event_type AS cls, count(*) AS n FROM events GROUP BY ALL) SELECT cls, sum(n)::BIGINT AS n, count(*) FILTER (WHERE n > 1) AS repeated FROM t GROUP BY cls",
    "report_index": """WITH r AS (SELECT event_type, 0.5::DOUBLE AS threshold, trunc(value)::BIGINT AS v FROM events UNION ALL SELECT event_type, 0.9::DOUBLE, 1 FROM events UNION ALL SELECT event_type, 0.5::DOUBLE, 2 FROM events) SELECT event_type, threshold, count(*) AS n, sum(v)::BIGINT AS total FROM r GROUP BY ALL""",
}

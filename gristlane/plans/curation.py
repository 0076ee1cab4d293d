"""Curation over the driver tables: sampling, deduplication, leakage, precedence, components.

There are no images in the driver tables, so documents stand for manifest rows (source for a capture
session, lang for a partition) and the signs of an embedding for a perceptual fingerprint.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import dedup, graph, joins, sampling, similarity
from ..sources.tables import table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("sha"))


def hash_top_k(spark, sf_dir):
    """The five documents of each language and source that come first by hash."""
    return sampling.hash_top_k(_docs(spark, sf_dir), ["lang", "source"], 5, "seed", "doc_id").select("doc_id", "lang", "source", "rank")


def class_capped(spark, sf_dir):
    """At most 20 documents a language by hash, all of the rare language."""
    return sampling.capped(_docs(spark, sf_dir), "lang", ["es"], 20, "seed", "doc_id").select("doc_id", "lang")


def stratified_round_robin(spark, sf_dir):
    """100 documents, strata of language and source in turn."""
    return sampling.round_robin(_docs(spark, sf_dir), ["lang", "source"], 100, "seed", "doc_id").select("doc_id", "lang", "source", "turn", "position")


def priority_round_robin(spark, sf_dir):
    """100 documents, long ones first, sources in turn."""
    return sampling.round_robin(_docs(spark, sf_dir), ["source"], 100, "seed", "doc_id", F.when(F.col("n_chars") >= 2000, 0).otherwise(1)).select("doc_id", "source", "turn", "position")


def stride_sample(spark, sf_dir):
    """Every n-th document in order of id, 77 in all."""
    return sampling.stride(_docs(spark, sf_dir).select("doc_id", "lang"), 77, "doc_id").select("doc_id", "lang", "index")


def stride_complement(spark, sf_dir):
    """What the stride sample leaves."""
    docs = _docs(spark, sf_dir).select("doc_id", "lang")
    return sampling.complement(docs, sampling.stride(docs, 77, "doc_id"), ["doc_id"])


def second_pass_sample(spark, sf_dir):
    """Documents whose hash is below a tenth."""
    return sampling.sampled(_docs(spark, sf_dir), "second", "doc_id", 0.1).select("doc_id", "lang")


def hash_shard(spark, sf_dir):
    """Documents and bytes of each of eight shards."""
    return _docs(spark, sf_dir).groupBy(S.shard(F.col("doc_id").cast("string"), 8).alias("shard")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def cyclic_repeat(spark, sf_dir):
    """Documents of each source repeated in hash order up to 60 rows."""
    return sampling.cyclic_repeat(_docs(spark, sf_dir), "source", 60, "seed", "doc_id").groupBy("source", "copy").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


def quota_selection(spark, sf_dir):
    """25 documents a language: anchors, then observed, then the rest."""
    tier = F.when(F.col("n_chars") < 300, 0).when(F.col("n_chars") < 2000, 1).otherwise(2)
    return sampling.quota(_docs(spark, sf_dir), "lang", 25, tier, "seed", "doc_id").select("doc_id", "lang", "tier", "rank")


def quota_shortages(spark, sf_dir):
    """Languages that cannot fill a quota of 150."""
    tier = F.when(F.col("n_chars") < 300, 0).when(F.col("n_chars") < 2000, 1).otherwise(2)
    return sampling.shortages(sampling.quota(_docs(spark, sf_dir), "lang", 150, tier, "seed", "doc_id"), "lang", 150)


def hard_examples(spark, sf_dir):
    """Labelled documents, those a length rule gets wrong first, size bins in turn."""
    d = _docs(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    d = d.withColumns({"wrong": ((F.col("n_chars") >= 500).cast("int") != F.col("quality")).cast("int"), "bin": S.focus_bin(F.col("n_chars") / 5000.0), "_h": sampling.order_hash("hard", "doc_id")})
    d = sampling.ranked(d, ["wrong", "bin"], "_h", "doc_id", column="turn").where("turn <= 40")
    return d.orderBy(F.desc("wrong"), "turn", "bin").limit(40).select("doc_id", "wrong", "bin", "turn")


def retention_budget(spark, sf_dir):
    """The newest documents that fit a byte budget."""
    return sampling.oldest_first_budget(_docs(spark, sf_dir).select("doc_id", "n_chars"), "doc_id", "n_chars", "doc_id", 1_000_000).select("doc_id", "n_chars", "running")


def exact_dedup(spark, sf_dir):
    """One document of each text, with the number of its copies."""
    return _docs(spark, sf_dir).groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def content_duplicates(spark, sf_dir):
    """Fate of each document: copies across languages, copies of another length class, copies, kept."""
    d = _docs(spark, sf_dir).withColumn("truth", F.col("source"))
    return dedup.content_duplicates(d, "sha", "lang", "truth", "doc_id").select("doc_id", "fate")


def identity_conflicts(spark, sf_dir):
    """Texts that stand under several sources."""
    return dedup.conflicts(_docs(spark, sf_dir), "sha", "source")


def leakage_report(spark, sf_dir):
    """Texts and lengths that several partitions share (source parity stands for the role)."""
    d = _docs(spark, sf_dir).withColumn("role", F.when(F.col("doc_id") % 5 == 0, "validation").otherwise("train"))
    return dedup.leakage(d, "role", "sha", "n_chars")


def partition_precedence(spark, sf_dir):
    """Documents dropped for a better partition, field by field."""
    d = _docs(spark, sf_dir).withColumn("part", F.when(F.col("doc_id") % 5 == 0, "validation").otherwise("train")).withColumn("size", F.when(F.col("n_chars") > 3000, F.col("n_chars")))
    out = dedup.partition_precedence(d, ["sha", "size"], "part", F.when(F.col("part") == "validation", 1).otherwise(0), "doc_id")
    return out.where("dropped_for is not null").select("doc_id", "part", "dropped_for")


def latest_per_key(spark, sf_dir):
    """The latest event of each user, ties to the smaller id."""
    return joins.latest(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts"), ["user_id"], F.desc("ts"), "event_id")


def protected_exclusion(spark, sf_dir):
    """Reasons against a document: a copy of another language's text, a protected length, a known label."""
    d = _docs(spark, sf_dir)
    cross = d.groupBy("sha").agg(F.count_distinct("source").alias("n")).where("n > 1")
    return dedup.exclusion_reasons(d, "doc_id", {"cross_source": d.join(cross, "sha"), "short": d.where("n_chars < 100"), "labelled_bad": table(spark, sf_dir, "labels").where("quality = 0")})


#: bits that a copy of a fingerprint differs in, the first so many of them
_FLIPS = [63, 0, 17, 34, 51, 8, 25, 42]
_MASKS = [sum(1 << b for b in _FLIPS[:n]) - ((1 << 64) if n else 0) for n in range(len(_FLIPS) + 1)]
#: distance up to which fingerprints are near
_NEAR = 7


def _prints(spark, sf_dir):
    """Fingerprints of 64 bits, the signs of an embedding's components (0 beyond its length), and two copies with up to 8 other bits under labels of their own."""
    e = table(spark, sf_dir, "embeddings").where("embedding is not null")
    bits = F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, i: a.bitwiseOR(F.when(F.get("embedding", i) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))))
    masks = F.array(*[F.lit(m).cast("long") for m in _MASKS])
    e = e.select("vec_id", "label", bits.alias("v"), F.posexplode(F.array(F.lit(0).cast("long"), F.col("vec_id") % 9, F.floor(F.col("vec_id") / 9) % 9)).alias("copy", "n"))
    return e.select((F.col("vec_id") * 3 + F.col("copy")).alias("vec_id"), (F.col("label") + F.col("copy") % 2).alias("label"), F.col("v").bitwiseXOR(F.get(masks, F.col("n").cast("int"))).alias("v"))


def hamming_join(spark, sf_dir):
    """Fingerprints that differ in at most seven bits."""
    return similarity.hamming_join(_prints(spark, sf_dir), "vec_id", "v", _NEAR)


def near_members(spark, sf_dir):
    """Fingerprints of odd labels near one of an even label."""
    p = _prints(spark, sf_dir)
    return similarity.near_members(p.where("label % 2 = 1"), p.where("label % 2 = 0"), "vec_id", "v", _NEAR)


def near_dup_clusters(spark, sf_dir):
    """Components of the Hamming join, and whether they hold several labels (blocking)."""
    p = _prints(spark, sf_dir)
    comp = graph.connected_components(similarity.hamming_links(p, "vec_id", "v", _NEAR), "left", "right")
    named = comp.join(p.select(F.col("vec_id").alias("node"), "label"), "node")
    return named.groupBy("component").agg(F.count("*").alias("n"), F.count_distinct("label").alias("labels"), S.stable_id("cluster_", 12, F.array_join(F.sort_array(F.collect_list(F.col("node"))).cast("array<string>"), ",")).alias("cluster_id")).withColumn("blocking", F.col("labels") > 1)


def component_winners(spark, sf_dir):
    """One fingerprint of each component: the smallest label, then id."""
    p = _prints(spark, sf_dir)
    comp = graph.connected_components(similarity.hamming_links(p, "vec_id", "v", _NEAR), "left", "right")
    return dedup.component_winners(p, comp, "vec_id", "label", "vec_id").select("component", "vec_id", "label")


def near_dup_resolution(spark, sf_dir):
    """Near fingerprints of two manifests resolved one by one, label conflicts first: who is dropped, for whom and why."""
    p = _prints(spark, sf_dir).select("vec_id", "v", F.col("label").alias("material"), (F.col("vec_id") % 4 == 0).alias("pseudo"), (F.col("vec_id") % 5 == 0).cast("int").alias("validation"), (F.col("vec_id") % 2).alias("manifest"))
    side = lambda s: p.drop("v").select(*[F.col(c).alias(c + s) for c in p.columns if c != "v"])
    e = similarity.hamming_join(p, "vec_id", "v", _NEAR).join(side("_l"), F.col("left") == F.col("vec_id_l")).join(side("_r"), F.col("right") == F.col("vec_id_r"))
    e = e.where("manifest_l <> manifest_r and (validation_l <> validation_r or material_l <> material_r)").withColumn("same", (F.col("material_l") == F.col("material_r")).cast("int"))
    truth = (F.col("same") == 0) & (F.col("pseudo_l") != F.col("pseudo_r"))
    role = F.col("validation_l") != F.col("validation_r")
    reason = F.when(truth, "ground_truth_over_pseudo").when(role, "validation_partition_precedence").otherwise("stable_cross_partition_precedence")
    first = F.when(truth, ~F.col("pseudo_l")).when(role, F.col("validation_l") == 1).when(F.col("pseudo_l") != F.col("pseudo_r"), ~F.col("pseudo_l")).otherwise(True)
    e = e.select("left", "right", "same", "distance", reason.alias("reason"), F.when(first, F.col("left")).otherwise(F.col("right")).alias("winner"))
    return dedup.greedy_resolution(e, "left", "right", "winner", "same", "distance", "left", "right").select("loser", "winner", "reason", "distance")


def manifest_repeats(spark, sf_dir):
    """Training rows of two manifests, the second one three times."""
    d = _docs(spark, sf_dir).select("doc_id", "lang")
    a, b = d.where("lang = 'de'"), d.where("lang = 'fr'").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return a.withColumn("copy", F.lit(1)).unionByName(b).where("doc_id % 5 <> 0").groupBy("lang", "copy").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


def bag_containment(spark, sf_dir):
    """Line items whose part and supplier occur more often among returns than among the rest."""
    l = table(spark, sf_dir, "lineitem")
    a = l.where("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n_returned"))
    b = l.where("l_returnflag <> 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n_other"))
    return a.join(b, ["l_partkey", "l_suppkey"], "left").withColumn("n_other", F.coalesce("n_other", F.lit(0))).where("n_returned > n_other")


def merge_upsert(spark, sf_dir):
    """Documents with the quality of their last label line, where it is positive."""
    base = _docs(spark, sf_dir).select("doc_id", "lang", F.lit(-1).alias("quality"))
    lines = table(spark, sf_dir, "labels").select("doc_id", "quality", F.col("toxic").alias("line"))
    return joins.upsert(base, lines, ["doc_id"], "line", ["quality"], F.col("quality") == 1)


def set_operations(spark, sf_dir):
    """Documents that are short, labelled, or both: union, intersection and difference counts by language."""
    d = _docs(spark, sf_dir)
    short, known = d.where("n_chars < 1000").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    rows = short.union(known).distinct().withColumn("kind", F.lit("union")).unionByName(short.intersect(known).withColumn("kind", F.lit("intersect"))).unionByName(short.exceptAll(known).withColumn("kind", F.lit("except")))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


QUERIES = {
    f.__name__: f
    for f in (
        hash_top_k, class_capped, stratified_round_robin, priority_round_robin, stride_sample, stride_complement, second_pass_sample, hash_shard, cyclic_repeat, quota_selection, quota_shortages, hard_examples, retention_budget, exact_dedup,
        content_duplicates, identity_conflicts, leakage_report, partition_precedence, latest_per_key, protected_exclusion, hamming_join, near_members, near_dup_clusters, component_winners, near_dup_resolution, manifest_repeats, bag_containment, merge_upsert, set_operations,
    )
}

_BITS = f"""signs AS (SELECT vec_id, label, list_sum([CASE WHEN embedding[i] > 0 THEN (1::HUGEINT << (i - 1)) ELSE 0::HUGEINT END FOR i IN range(1, 65)]) AS h FROM embeddings WHERE embedding IS NOT NULL),
    copies AS (SELECT vec_id, label, (CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END)::BIGINT AS h, unnest([0, 1, 2]) AS c FROM signs),
    prints AS (SELECT vec_id * 3 + c AS vec_id, label + c % 2 AS label, xor(h, list_extract({_MASKS}::BIGINT[], (CASE c WHEN 0 THEN 0 WHEN 1 THEN vec_id % 9 ELSE vec_id // 9 % 9 END)::INT + 1)) AS v FROM copies)"""
_EDGES = f"""{_BITS},
    edges AS (SELECT a.vec_id AS l, b.vec_id AS r, bit_count(xor(a.v, b.v))::INT AS d FROM prints a JOIN prints b ON a.vec_id < b.vec_id WHERE bit_count(xor(a.v, b.v)) <= {_NEAR})"""
_COMP = f"""WITH RECURSIVE {_EDGES},
    both_ways AS (SELECT l AS a, r AS b FROM edges UNION SELECT r, l FROM edges),
    reach(node, seen) AS (SELECT a, a FROM both_ways UNION SELECT b, seen FROM reach JOIN both_ways ON node = a),
    comp AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)"""
_DOCS = "d AS (SELECT doc_id, lang, source, n_chars, sha256(text) AS sha FROM documents)"
_STRIDE = """s AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS index, count(*) OVER () AS n FROM documents),
    picks AS (SELECT DISTINCT floor(i * (n / 77.0::DOUBLE))::BIGINT AS pick FROM (SELECT max(n) AS n FROM s), (SELECT unnest(range(77)) AS i)),
    chosen AS (SELECT doc_id, lang, index FROM s WHERE n <= 77 OR index IN (SELECT pick FROM picks))"""
_TIER = "CASE WHEN n_chars < 300 THEN 0 WHEN n_chars < 2000 THEN 1 ELSE 2 END"


def _quota(n: int) -> str:
    return f"""q0 AS (SELECT doc_id, lang, {_TIER} AS tier, sha256('seed|' || doc_id) AS h FROM documents),
        q1 AS (SELECT *, row_number() OVER (PARTITION BY lang, tier ORDER BY h, doc_id) AS r FROM q0),
        q2 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY CASE WHEN tier = 0 AND r <= {max(1, n // 5)} THEN 0 WHEN tier = 0 THEN 3 ELSE tier END, h, doc_id) AS rank FROM q1),
        q AS (SELECT doc_id, lang, tier, rank FROM q2 WHERE rank <= {n})"""


ORACLE_SQL = {
    "hash_top_k": "SELECT doc_id, lang, source, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('seed|' || doc_id), doc_id) AS rank FROM documents) WHERE rank <= 5",
    "class_capped": "SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY sha256('seed|' || doc_id), doc_id) AS rank FROM documents) WHERE rank <= 20 OR lang = 'es'",
    "stratified_round_robin": """WITH t AS (SELECT doc_id, lang, source, sha256('seed|' || lang || '|' || source) AS s, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('seed|' || doc_id), doc_id) AS turn FROM documents)
        SELECT doc_id, lang, source, turn, row_number() OVER (ORDER BY turn, s, doc_id) AS position FROM t QUALIFY position <= 100""",
    "priority_round_robin": """WITH p AS (SELECT *, CASE WHEN n_chars >= 2000 THEN 0 ELSE 1 END AS p FROM documents),
        t AS (SELECT doc_id, source, p, sha256('seed|' || source) AS s, row_number() OVER (PARTITION BY p, source ORDER BY sha256('seed|' || doc_id), doc_id) AS turn FROM p)
        SELECT doc_id, source, turn, row_number() OVER (ORDER BY p, turn, s, doc_id) AS position FROM t QUALIFY position <= 100""",
    "stride_sample": f"WITH {_STRIDE} SELECT doc_id, lang, index FROM chosen",
    "stride_complement": f"WITH {_STRIDE} SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM chosen)",
    "second_pass_sample": "SELECT doc_id, lang FROM documents WHERE ('0x' || substr(sha256('second|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < 0.1",
    "hash_shard": "SELECT (('0x' || substr(sha256(doc_id::VARCHAR), 1, 12))::BIGINT % 8)::INT AS shard, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1",
    "cyclic_repeat": """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('seed|' || doc_id), doc_id) AS rank, count(*) OVER (PARTITION BY source) AS n FROM documents),
        k AS (SELECT *, least(n, 60) AS m FROM r WHERE rank <= 60)
        SELECT source, copy, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM (SELECT source, doc_id, unnest(range((60 - rank) // m + 1))::INT AS copy FROM k) GROUP BY source, copy""",
    "quota_selection": f"WITH {_quota(25)} SELECT doc_id, lang, tier, rank FROM q",
    "quota_shortages": f"WITH {_quota(150)} SELECT lang, count(*) AS got, greatest(0, 150 - count(*)) AS missing FROM q GROUP BY lang",
    "hard_examples": """WITH d AS (SELECT doc_id, (CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END <> quality)::INT AS wrong, CASE WHEN n_chars / 5000.0 < 0.20 THEN 'small' WHEN n_chars / 5000.0 < 0.45 THEN 'medium' ELSE 'large' END AS bin FROM documents JOIN labels USING (doc_id)),
        t AS (SELECT *, row_number() OVER (PARTITION BY wrong, bin ORDER BY sha256('hard|' || doc_id), doc_id) AS turn FROM d)
        SELECT doc_id, wrong, bin, turn FROM t ORDER BY wrong DESC, turn, bin LIMIT 40""",
    "retention_budget": "SELECT * FROM (SELECT doc_id, n_chars, (sum(n_chars) OVER (ORDER BY doc_id DESC ROWS UNBOUNDED PRECEDING))::BIGINT AS running FROM documents) WHERE running <= 1000000",
    "exact_dedup": "SELECT sha256(text) AS sha, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1",
    "content_duplicates": f"""WITH {_DOCS}, g AS (SELECT sha, count(DISTINCT lang) AS s, count(DISTINCT source) AS t, min(doc_id) AS p FROM d GROUP BY sha)
        SELECT doc_id, CASE WHEN s > 1 THEN 'cross_split' WHEN t > 1 THEN 'conflicting_truth' WHEN doc_id > p THEN 'duplicate' ELSE 'kept' END AS fate FROM d JOIN g USING (sha)""",
    "identity_conflicts": f"WITH {_DOCS} SELECT sha, count(DISTINCT source) AS variants, count(*) AS n FROM d GROUP BY sha HAVING variants > 1",
    "leakage_report": f"""WITH {_DOCS}, r AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'validation' ELSE 'train' END AS role FROM d),
        c AS (SELECT role, 'sha' AS field, sha AS value FROM r UNION ALL SELECT role, 'n_chars', n_chars::VARCHAR FROM r)
        SELECT field, value, string_agg(DISTINCT role, ',' ORDER BY role) AS roles, count(*) AS n FROM c GROUP BY field, value HAVING count(DISTINCT role) > 1""",
    "partition_precedence": f"""WITH {_DOCS}, a AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'validation' ELSE 'train' END AS part, CASE WHEN n_chars > 3000 THEN n_chars END AS size FROM d),
        b AS (SELECT *, CASE WHEN part = 'train' AND bool_or(part = 'validation') OVER (PARTITION BY sha) THEN 'sha' END AS one FROM a),
        c AS (SELECT *, CASE WHEN one IS NOT NULL THEN one WHEN size IS NOT NULL AND part = 'train' AND bool_or(part = 'validation' AND one IS NULL) OVER (PARTITION BY size) THEN 'size' END AS dropped_for FROM b)
        SELECT doc_id, part, dropped_for FROM c WHERE dropped_for IS NOT NULL""",
    "latest_per_key": "SELECT event_id, user_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1",
    "protected_exclusion": f"""WITH {_DOCS}, r AS (SELECT doc_id, 'cross_source' AS reason FROM d WHERE sha IN (SELECT sha FROM d GROUP BY sha HAVING count(DISTINCT source) > 1)
        UNION SELECT doc_id, 'short' FROM d WHERE n_chars < 100 UNION SELECT doc_id, 'labelled_bad' FROM labels WHERE quality = 0 AND doc_id IN (SELECT doc_id FROM d))
        SELECT doc_id, string_agg(reason, ',' ORDER BY reason) AS reasons, count(*) AS n FROM r GROUP BY doc_id""",
    "hamming_join": f'WITH {_EDGES} SELECT l AS "left", r AS "right", d AS distance FROM edges',
    "near_members": f"""WITH {_BITS}, n AS (SELECT a.vec_id, b.vec_id AS m, bit_count(xor(a.v, b.v))::INT AS d FROM prints a JOIN prints b ON a.label % 2 = 1 AND b.label % 2 = 0 WHERE bit_count(xor(a.v, b.v)) <= {_NEAR}),
        k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, m) AS rn FROM n)
        SELECT vec_id, min(d) AS nearest, count(*) AS matches, string_agg(m::VARCHAR, ',' ORDER BY rn) FILTER (WHERE rn <= 8) AS listed FROM k GROUP BY vec_id""",
    "near_dup_clusters": f"""{_COMP} SELECT component, count(*) AS n, count(DISTINCT label) AS labels, 'cluster_' || substr(sha256(string_agg(node::VARCHAR, ',' ORDER BY node)), 1, 12) AS cluster_id, count(DISTINCT label) > 1 AS blocking
        FROM comp JOIN prints ON vec_id = node GROUP BY component""",
    "component_winners": f"""{_COMP} SELECT coalesce(component, vec_id) AS component, vec_id, label FROM prints LEFT JOIN comp ON node = vec_id
        QUALIFY row_number() OVER (PARTITION BY coalesce(component, vec_id) ORDER BY label, vec_id) = 1""",
    "near_dup_resolution": f"""WITH RECURSIVE {_EDGES}, p AS (SELECT vec_id AS id, label AS material, vec_id % 4 = 0 AS pseudo, vec_id % 5 = 0 AS val, vec_id % 2 AS manifest FROM prints),
        f AS (SELECT l, r, d, a.material = b.material AS same, a.material <> b.material AND a.pseudo <> b.pseudo AS truth, a.val <> b.val AS role, a.pseudo AS pa, b.pseudo AS pb, a.val AS va FROM edges JOIN p a ON a.id = l JOIN p b ON b.id = r
            WHERE a.manifest <> b.manifest AND (a.val <> b.val OR a.material <> b.material)),
        g AS (SELECT *, CASE WHEN truth THEN 'ground_truth_over_pseudo' WHEN role THEN 'validation_partition_precedence' ELSE 'stable_cross_partition_precedence' END AS reason,
            CASE WHEN truth THEN NOT pa WHEN role THEN va WHEN pa <> pb THEN NOT pa ELSE true END AS first, row_number() OVER (ORDER BY same, d, l, r) AS i FROM f),
        e AS (SELECT i, l, r, d, reason, CASE WHEN first THEN l ELSE r END AS winner, CASE WHEN first THEN r ELSE l END AS loser FROM g),
        walk(i, gone, loser, winner, reason, distance, hit) AS (SELECT 0::BIGINT, []::BIGINT[], NULL::BIGINT, NULL::BIGINT, NULL::VARCHAR, NULL::INT, false
            UNION ALL SELECT e.i, CASE WHEN list_contains(gone, e.l) OR list_contains(gone, e.r) THEN gone ELSE list_append(gone, e.loser) END, e.loser, e.winner, e.reason, e.d, NOT (list_contains(gone, e.l) OR list_contains(gone, e.r)) FROM walk JOIN e ON e.i = walk.i + 1)
        SELECT loser, winner, reason, distance FROM walk WHERE hit""",
    "manifest_repeats": """SELECT lang, copy, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM (SELECT doc_id, lang, 1 AS copy FROM documents WHERE lang = 'de' UNION ALL SELECT doc_id, lang, unnest([1, 2, 3]) FROM documents WHERE lang = 'fr') WHERE doc_id % 5 <> 0 GROUP BY lang, copy""",
    "bag_containment": """WITH a AS (SELECT l_partkey, l_suppkey, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL), b AS (SELECT l_partkey, l_suppkey, count(*) AS n_other FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)
        SELECT l_partkey, l_suppkey, n_returned, coalesce(n_other, 0) AS n_other FROM a LEFT JOIN b USING (l_partkey, l_suppkey) WHERE n_returned > coalesce(n_other, 0)""",
    "merge_upsert": """WITH l AS (SELECT doc_id, quality FROM labels QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY toxic DESC) = 1)
        SELECT doc_id, lang, CASE WHEN l.quality = 1 THEN 1 ELSE -1 END AS quality, coalesce(l.quality = 1, false) AS updated FROM documents LEFT JOIN l USING (doc_id)""",
    "set_operations": """WITH s AS (SELECT doc_id FROM documents WHERE n_chars < 1000), k AS (SELECT doc_id FROM labels)
        SELECT kind, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM (SELECT 'union' AS kind, doc_id FROM (SELECT * FROM s UNION SELECT * FROM k)
        UNION ALL SELECT 'intersect', doc_id FROM (SELECT * FROM s INTERSECT SELECT * FROM k) UNION ALL SELECT 'except', doc_id FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM k)) GROUP BY kind""",
}

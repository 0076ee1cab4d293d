"""The pipeline's stages on small tables, and the registry of queries."""

import re
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.dtypes == docs.dtypes, name
        from gristlane.session import materialize

        docs = materialize(out)
        assert 0 < docs.count() <= n, name
        n = docs.count()
    final = P.STAGES[-1][1](spark, docs, sf)
    assert final.count() == n and {"slot", "position"} <= set(final.columns)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ODD = "doc_id long, text string, source string, n_chars long, _score double, slot string, sid long, rep int, h string, part string"


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n):
    return " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 500, n))


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    """Documents with nulls, empties, repeats, a long text, copies, near copies, shared passages and clashing columns."""
    base = [prose(i, 50 + 5 * i) for i in range(10)]
    near = [" ".join("changed" if n == 20 else w for n, w in enumerate(t.split())) for t in base]
    passage = prose(77, 40)
    texts = [*base, *near, *(f"{prose(100 + i, 30)} {passage} {prose(200 + i, 30)}" for i in range(4)), base[2], base[2], None, None, "", " ", "one", prose(300, 8000), prose(301, 60), "two words", prose(302, 40) + " é" + prose(303, 40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, base[3]), (3, base[3]), (None, base[5]), (None, "null id alone " + prose(304, 30)), (40, base[6]), (40, prose(305, 30))]
    sf = tmp_path_factory.mktemp("sf")
    docs = [(i, t, None if n % 7 == 6 else f"s{n % 3}", len(t) if t is not None else None, 0.5, "x", n, n, "h", "p") for n, (i, t) in enumerate(rows)]
    d = spark.createDataFrame(docs, ODD)
    bench = [(1, " ".join(base[0].split()[5:25])), (2, "two words"), (3, None), (4, ""), (None, "one"), (5, " ".join(prose(300, 8000).split()[100:120]))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return d, str(sf), [(r[0], r[1]) for r in docs], bench


def test_quality_stage(spark, fixture):
    import corpus_pipeline as P

    d, sf, rows, _ = fixture
    out = P.quality_filter(spark, d, sf)
    assert out.columns == d.columns and out.count() == len(rows)  # no label, no rejection


def test_near_duplicate_stage(spark, fixture):
    import corpus_pipeline as P

    d, sf, rows, _ = fixture

    def shingles(t):
        w = SPACED.findall(low(t))
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    distinct = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    sets = [shingles(t) for _, t in distinct]
    group = list(range(len(distinct)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    # of each group the smallest id; those tied in it are settled by hash, so only their number is known
    want = sorted((str(distinct[g][0]) for g in set(group)), key=str)
    out = P.near_duplicates(spark, d, sf)
    assert out.columns == d.columns and sorted((str(r.doc_id) for r in out.collect()), key=str) == want


def test_span_stage(spark, fixture):
    import corpus_pipeline as P

    d, sf, rows, _ = fixture
    rows = [r for n, r in enumerate(rows) if r[0] is not None and r not in rows[:n] and r[0] != 40]
    d = d.where("doc_id is not null and doc_id <> 40").dropDuplicates(["doc_id", "text"])
    seen, want = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        want[i] = None if t is None else bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    out = P.repeated_spans(spark, d, sf)
    got = out.collect()
    assert out.dtypes == d.dtypes and {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_decontamination_stage(spark, fixture):
    import corpus_pipeline as P

    d, sf, rows, bench = fixture
    windows = set()
    for i, t in bench:
        w = WORD.findall(low(t))
        n = min(13, len(w))
        windows |= {tuple(w[p : p + n]) for p in range(len(w) - n + 1)} if n and i is not None else set()

    def clean(t):
        w, hit = WORD.findall(low(t)), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
        return not hit or 20 * len(hit) < len(w)

    out = P.decontaminate(spark, d, sf)
    assert out.columns == d.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted((r for r in rows if clean(r[1])), key=str)


def test_mixing_stage(spark, fixture):
    import corpus_pipeline as P

    d, sf, rows, _ = fixture
    got = P.mix_sources(spark, d, sf).collect()
    assert len(got) == len(rows) and all(r.release <= r.slot < r.due for r in got) and all(r.part == "p" and r._score == 0.5 for r in got)
    assert sorted({r.position for r in got}) == list(range(len({(r.source, r.block_no) for r in got})))


def test_empty_tables(spark, fixture):
    import corpus_pipeline as P

    d, sf, _, _ = fixture
    for _, stage in P.STAGES:
        assert stage(spark, d.limit(0), sf).count() == 0


def test_run(spark):
    """The stages one after the other give what run gives, and intermediate tables go."""
    import corpus_pipeline as P
    from gristlane.session import shared_dir

    before = set(shared_tables(spark, shared_dir(spark)))
    assert P.run(spark, "/root/testdata/sf0.001").count() > 0
    left = set(shared_tables(spark, shared_dir(spark))) - before
    assert not any("scratch" in x for x in left) and sum("quality" in x or "Jaccard" in x or "suffix" in x for x in left) == 0


def shared_tables(spark, folder):
    top = Path(folder.removeprefix("file://")) / "gristlane" / spark.sparkContext.applicationId
    return [p.name for p in top.iterdir()] if top.exists() else []


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{i}_") for q in names) for i in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)

"""Every operator against brute force on small fixtures, with nulls, ties, repeats and empty tables."""

import base64
import hashlib
import re

import numpy as np
import pytest

from gristlane.llm import ann, decontam, html, jaccard, licenses, mixing, quality, quotes, suffixes, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sid long, n int, score double"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None if (i or 0) % 5 == 4 else f"s{(i or 0) % 3 if (i or 0) % 2 else 0}", len(t or ""), 1, 2, 0.5) for i, t in zip(ids, texts)], DOCS)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 400, n))


@pytest.fixture(scope="module")
def corpus():
    base = [prose(i, 40 + 17 * i) for i in range(12)]
    edited = []
    for i, t in enumerate(base):
        w = t.split()
        w[len(w) // 2] = "changed"
        edited.append(" ".join(w))
    passage = prose(99, 60)
    mixed = [prose(50 + i, 30) + " " + passage + " " + prose(70 + i, 30) for i in range(5)]
    return [*base, *edited, *mixed, base[3], base[3], None, "", "one", "two words", "É ünïcode Straße straße", "x " * 3000, "a\tb\nc d", prose(7, 20000), "MIT License and the Apache\nlicense, GNU General Public License mit license"]


def test_jaccard_components(spark, corpus):
    def shingles(text, k):
        w = SPACED.findall(low(text))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])

    got = {r.doc_id: r for r in jaccard.components(docs(spark, corpus)).collect()}
    sets = [shingles(t, 4) for t in corpus]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert {i: (len(s), find(i)) for i, s in enumerate(sets)} == {i: (r.n_shingles, r.component_id) for i, r in got.items()}


def test_jaccard_dominated_groups(spark):
    """A large group of near copies meets through frequent keys and loses no link."""
    rng = np.random.default_rng(3)
    base = prose(1, 120).split()
    texts = []
    for i in range(150):
        w = list(base)
        for p in rng.choice(120, int(rng.integers(0, 7)), replace=False):
            w[p] = f"e{i}x{p}"
        texts.append(" ".join(w))
    got = {r.doc_id: r.component_id for r in jaccard.components(docs(spark, texts)).collect()}
    sets = [frozenset(tuple(t.split()[i : i + 4]) for i in range(117)) for t in texts]
    seen, want = set(), {}
    for i in range(150):
        if i in seen:
            continue
        stack, comp = [i], {i}
        while stack:
            x = stack.pop()
            for y in range(150):
                if y not in comp and 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y]):
                    comp.add(y)
                    stack.append(y)
        seen |= comp
        want.update(dict.fromkeys(comp, min(comp)))
    assert got == want


def short_family(seed):
    """A text of 18 to 22 shingles and 100 near copies at distance 3."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(18, 23))
    base = [f"b{x}" for x in rng.integers(0, 10**6, n + 3)]
    edits = [base + [f"a{seed}x{i}x{j}" for j in range(3)] if i % 2 else [f"a{seed}x{i}"] + base[1:] + [f"z{seed}x{i}"] for i in range(100)]
    return [" ".join(w) for w in [base, *edits]]


def test_jaccard_short_dominated_group(spark):
    """Near copies of a short text meet it though their cold keys fail one by one."""
    texts = short_family(117) + short_family(297)
    got = {r.doc_id: r.component_id for r in jaccard.components(docs(spark, texts)).collect()}
    sets = [frozenset(tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)) for t in texts]
    for lo in (0, 101):
        linked = [i for i in range(lo, lo + 101) if 100 * len(sets[lo] & sets[i]) >= 85 * len(sets[lo] | sets[i])]
        assert len(linked) > 24 and {got[i] for i in linked} == {lo}


def test_jaccard_all_links(spark):
    """Every link between texts of a large family is returned and counted, not only a forest of them."""
    rng = np.random.default_rng(4)
    base = prose(2, 120).split()
    texts = []
    for i in range(120):
        w = list(base)
        for p in rng.choice(120, int(rng.integers(0, 5)), replace=False):
            w[p] = f"e{i}x{p}"
        texts.append(" ".join(w))
    texts += [*short_family(117), texts[0], None, ""]
    sets = [frozenset(tuple((t or "").split()[i : i + 4]) for i in range(len((t or "").split()) - 3)) for t in texts]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = np.bincount(np.array(near).ravel(), minlength=len(sets)).tolist()
    d = docs(spark, texts)
    _, _, links = jaccard.join(d)
    assert links.distinct().count() == len({frozenset((sets[i], sets[j])) for i, j in near if sets[i] != sets[j]})
    assert [r.n_links for r in sorted(jaccard.link_counts(d).collect(), key=lambda r: r.doc_id)] == want


def test_jaccard_survivors(spark, corpus):
    d = docs(spark, [*corpus, corpus[0]], [*range(len(corpus)), 0])  # the first row once more
    left = jaccard.survivors(d)
    assert left.columns == d.columns
    ids = sorted(r.doc_id for r in left.collect())
    assert len(ids) == len(set(ids)) and 0 in ids and not {23, 29, 30} & set(ids)
    assert jaccard.components(d.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [4096, 3, 1])
def test_suffix_dedup(spark, corpus, crowd, monkeypatch):
    """Also where anchors are crowded: their segments are cut by wider anchors, and then to windows."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rng = np.random.default_rng(8)
    passage = prose(99, 25)[:100]
    family = [" ".join(f"e{i}x{p}" if rng.random() < 0.06 else w for p, w in enumerate(prose(4, 90).split())) for i in range(30)]
    texts = [*corpus, "ab" * 300, None, *family, *(f"{prose(400 + i, 9)}{passage}{prose(500 + i, 9)}" for i in range(12))]
    got = {r.doc_id: r for r in suffixes.digests(docs(spark, texts)).collect()}
    seen, want = set(), {}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(b[p : p + 100])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
        want[i] = kept.decode("utf-8", "ignore")
    out = suffixes.remove(docs(spark, texts))
    assert out.columns == docs(spark, texts).columns
    assert {r.doc_id: r.text or "" for r in out.collect()} == want
    assert suffixes.digests(docs(spark, texts).limit(0)).count() == 0


def test_suffix_repeated_row(spark):
    """Rows that repeat both id and text keep their text; a later id or an earlier start still counts."""
    a, b = prose(200, 60), prose(201, 60)
    rows = [(3, a), (3, a), (5, a), (None, b), (None, b), (7, b + " x"), (8, "y " + prose(202, 40) * 2), (8, "y " + prose(202, 40) * 2)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffixes.digests(docs(spark, [t for _, t in rows], [i for i, _ in rows])).collect())
    inner = len(prose(202, 40))
    want = [(i, t, len(t) if n in (2,) else len(b) if n == 5 else inner if n > 5 else 0) for n, (i, t) in enumerate(rows)]
    assert got == sorted((str(i), len(t), n) for i, t, n in want)


def test_suffix_order():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 100, int(rng.integers(0, 15))).astype(np.uint8)) for _ in range(40)]
    for step in (1, 2, 4):
        text, start, size = suffixes.suffix_order(texts, step)
        order = [texts[a][b : b + n] for a, b, n in zip(text, start, size)]
        assert order == sorted(order)
        assert {(a, b) for a, b, n in zip(text, start, size) if n} == {(a, b) for a, t in enumerate(texts) for b in range(len(t) - step + 1)}


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_decontamination(spark, corpus, broadcast, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST", broadcast)
    items = [(1, " ".join(corpus[2].split()[5:40])), (2, "two words"), (3, "License and THE apache license gnu general"), (4, None), (5, ""), (6, "one"), (7, corpus[24]), (None, "one"), (2, "gnu general public")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontam.contamination(docs(spark, corpus), bench).collect()}
    windows = {}
    for i, t in items:
        w = WORD.findall(low(t))
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if n and i is not None else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(i)
    for i, t in enumerate(corpus):
        w, hit, ids = WORD.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[p : p + n]))) is not None:
                    hit.update(range(p, p + n))
                    ids |= found
        want = (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == want
    clean = decontam.clean(docs(spark, corpus), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i in got if not got[i].contaminated}
    assert decontam.contamination(docs(spark, corpus), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.contamination(docs(spark, corpus).limit(0), bench).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "u", "é" * 5000), (None, "n", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (-7, "m", "minus")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(warc.round_trip(pages).collect(), key=repr)
    last = {"<p>x</p>": 2, "": 4}
    want = []
    for i, _, t in rows:
        b = (t or "").encode()
        original = last.get(t or "", i)
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == original else "revisit", None if i == original else original))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    folder = f"file://{tmp_path}/archives"
    files = warc.write(pages, folder).collect()
    raw = open(files[0].path.removeprefix("file://"), "rb").read()
    assert raw[:4] == warc.MAGIC and sum(f.records for f in files) == len(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0


def license_oracle(text, k=4, drift=3, cover=0.6):
    """Labels of the texts' spans, straight from the definition."""
    w = WORD.findall(low(text))
    found = set()
    for label, texts in licenses.TEMPLATES.items():
        for t in texts:
            v = WORD.findall(low(t))
            hits = sorted((p - q, q) for p in range(len(w) - k + 1) for q in range(len(v) - k + 1) if w[p : p + k] == v[q : q + k])
            runs = []
            for d, q in hits:
                if runs and d - runs[-1][-1][0] <= drift and d - runs[-1][0][0] <= max(drift, len(v) // 8):
                    runs[-1].append((d, q))
                else:
                    runs.append([(d, q)])
            for run in runs:
                run = sorted(run, key=lambda h: (h[0] + h[1], -h[1]))
                best, back = [1] * len(run), [-1] * len(run)
                for i in range(len(run)):
                    for j in range(i):
                        if run[j][1] < run[i][1] and best[j] + 1 > best[i]:
                            best[i], back[i] = best[j] + 1, j
                i, chain = max(range(len(run)), key=lambda i: best[i]), []
                while i >= 0:
                    chain.append(run[i])
                    i = back[i]
                mine = {x for _, q in chain for x in range(q, q + k)}
                here = {x for d, q in chain for x in range(d + q, d + q + k)}
                if len(mine) >= cover * len(v) and len(here) >= cover * (max(here) - min(here) + 1):
                    found.add(label)
    return found


def test_licenses(spark, corpus):
    bsd = WORD.findall(low(licenses.TEMPLATES["bsd"][0]))
    broken = " ".join(x for i, w in enumerate(bsd) for x in ([w, "a", "b", "c"] if i % 4 == 3 else [w]))
    dropped = " ".join(w for i, w in enumerate(bsd) if i % 17)
    long_ = "mit license " * 3000 + licenses.TEMPLATES["zlib"][0] * 3
    extra = [*corpus, "noise " + licenses.TEMPLATES["bsd"][0].replace("binary forms", "binary and other forms") + " tail", "apache license apache license", broken, dropped, long_, " ".join(reversed(bsd)), *(t for texts in licenses.TEMPLATES.values() for t in texts)]
    got = {r.doc_id: r for r in licenses.labels(docs(spark, extra)).collect()}
    for i, t in enumerate(extra):
        w = WORD.findall(low(t))
        places = [(p, label) for p in range(len(w)) for phrase, label in licenses.PHRASES.items() if w[p : p + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        if len(w) < 2000:
            assert set(filter(None, r.labels.split(","))) == {x for _, x in places} | license_oracle(t)
        assert 0 <= r.score <= 1
    n = len(corpus)
    assert got[n].labels == "bsd" and got[n + 2].labels == "" and got[n + 3].labels == "bsd" and got[n + 4].labels == "mit,zlib" and got[n + 5].labels == ""
    at = n + 6
    for label, texts in licenses.TEMPLATES.items():
        for _ in texts:
            assert label in got[at].labels.split(",")
            at += 1
    assert licenses.labels(docs(spark, corpus).limit(0)).count() == 0


def edf(weights, slots):
    """(source, block) of each slot, by one pass of earliest deadline first."""
    total, done, out = sum(weights), [0] * len(weights), []
    for t in range(slots):
        i = min((-(-(j + 1) * total // w), i) for i, (j, w) in enumerate(zip(done, weights)) if j * total // w <= t)[1]
        out.append((i, done[i]))
        done[i] += 1
    return out


@pytest.mark.parametrize("span", [1, 8, 256])
def test_mixing(spark, span, monkeypatch):
    """Wherever ranges are cut, each block has the slot that one pass gives it, within its window and at the target weights."""
    monkeypatch.setattr(mixing, "PASS", 50)
    rng = np.random.default_rng(span)
    sizes = {None: 90, "a": 400, "b": 37, "c": 3, "d": 160, "e": 1}
    rows = [(int(i), "t", "en", s, 1, 1, 2, 0.5) for i, s in enumerate(rng.permutation([x for x, n in sizes.items() for _ in range(n)]))]
    for weights in (None, {"a": 0.31, "b": 0.02, "c": 0.0005, "": 0.2, "d": 0.4}, {"a": 4, "b": 2, "c": 1, "": 4, "d": 4, "e": 1}):
        got = mixing.schedule(spark.createDataFrame(rows, DOCS).withColumnRenamed("score", "slot"), weights, power=0.5, block=4, span=span).collect()
        assert len(got) == len(rows) and len({(r.source, r.block_no, r.place) for r in got}) == len(rows)
        order = sorted(sizes, key=lambda s: (s or "", s is None))
        given = [(weights.get(s or "", min(weights.values())) if weights else sizes[s] ** 0.5) for s in order]
        w = [max(1, round(x * 2**30 / sum(given))) for x in given]
        blocks = {(r.source, r.block_no): r for r in got}
        ends = sorted(-(-(-(-sizes[s] // 4)) * sum(w) // w[i]) for i, s in enumerate(order))
        for t, (i, j) in enumerate(edf(w, ends[-2])):
            assert (order[i], j) not in blocks or blocks[order[i], j].slot == t
        for (s, j), r in blocks.items():
            i = order.index(s)
            assert (r.release, r.due) == (j * sum(w) // w[i], -(-(j + 1) * sum(w) // w[i])) and r.release <= r.slot < r.due
        slots = sorted(r.slot for r in blocks.values())
        assert len(set(slots)) == len(slots) and [blocks[b].position for b in sorted(blocks, key=lambda b: blocks[b].slot)] == list(range(len(blocks)))
        for t in range(1, max(slots)):  # off the target by less than a block, as long as a source lasts
            for i, s in enumerate(order):
                mine = sorted(r.slot for (q, _), r in blocks.items() if q == s)
                if t <= mine[-1]:
                    assert abs(sum(x < t for x in mine) - given[i] / sum(given) * t) < 1 + 1e-6
    assert mixing.schedule(spark.createDataFrame(rows, DOCS).limit(0)).count() == 0


def test_mixing_many_sources(spark):
    """At over 256 sources and very uneven weights each is less than one block off its target."""
    rows = [(i, "t", "en", "big" if i % 2 else f"s{i % 600}", 1, 1, 2, 0.5) for i in range(2400)]
    weights = {"big": 0.9} | {f"s{i}": 0.1 / 300 for i in range(0, 600, 2)}
    got = mixing.schedule(spark.createDataFrame(rows, DOCS), weights, block=1).collect()
    slot = {}
    for r in got:
        slot.setdefault(r.source, []).append(r.slot)
    for t in (50, 301, 1000):
        for s, w in weights.items():
            assert abs(sum(x < t for x in slot[s]) - w * t) < 1 + 1e-6
    two = [(i, "t", "en", "small" if i < 20 else "large", 1, 1, 2, 0.5) for i in range(3000)]
    got = mixing.schedule(spark.createDataFrame(two, DOCS), {"small": 0.0005, "large": 0.9995}, block=1).collect()
    assert sum(r.source == "small" and r.slot < 2560 for r in got) in (1, 2)


def test_html():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><a href=/>Menu</a></nav><div class="ad">Buy</div>
    <article><h1>Head &amp; line</h1><p><b>First   part, with commas, of the text<br>goes on<p>Second &#233; part.</p><ul><li>One<li>Two</ul><form><input>Search</form></article>
    <aside>Side</aside><div id="comments"><p>Nice, very nice, I think.</p></div><footer>&copy;</footer></body></html>"""
    assert html.main_text(page) == "Head & line\nFirst part, with commas, of the text goes on\nSecond é part.\nOne\nTwo"
    assert html.main_text(None) == html.main_text("") == "" and html.main_text("just text") == "just text"
    assert html.main_text("<p>" * 3000 + "deep") == "deep" and html.main_text("<div>" * 5000 + "deep") == "deep"
    assert html.main_text("<article><p>open, and never closed") == "open, and never closed"


def test_html_containers():
    """Names of layout, odd attributes and headers neither empty a page nor leak into it."""
    text = "Long text, here, of the page that goes on, and on, for a while."
    for page in (
        f'<div class="content has-sidebar"><p>{text}</p></div>', f'<div class="post no-comments"><p>{text}</p></div>', f"<div data-u=/x/><p>{text}</p></div>", f"<a href=/>x</a><div><p>{text}</p></div>", f"<main><header>Head</header><p>{text}</p></main>",
        f'<form action="/"><p>{text}</p></form>', f'<body class="nav-open"><div id="sidebar-layout"><p>{text}</p></div></body>', f'<div><p>{text}</p></div><div class="sidebar-right"><p>other words</p></div>', f'<div><p>{text}</p></div><div id="comments"><p>{text} {text} {text}</p></div>',
        f"<article><p>{text}</p></article><aside><p>{text} {text}</p></aside>", f"<p title=it's>{text}</p>", f'<div><p>{text}</p></div><div hidden><p>{text} {text}</p></div>',
        f'<article><p>{text}</p></article><div class="sidebar"><p>{text} {text} {text}</p></div>', f'<article><div class="widget-body"><p>{text}</p></div></article>', f"<aside><p>{text}</p></aside>",
    ):
        assert html.main_text(page) == text, page
    assert html.main_text(f"<article><header><h1>T</h1></header><p>{text}</p></article>") == f"T\n{text}"
    assert html.main_text(f'<div class="widget"><h1>T</h1><p>{text}</p></div>') == f"T\n{text}"
    assert html.main_text("a < b <3 c <!-- x --> d <![CDATA[ y ]]> e") == "a < b <3 c d e"


def test_html_hostile_pages_are_linear():
    import time

    for unit in ("<div>x", '<a b="', "</i>", "<svg>", "<!-", "<", "<![CDATA[", "<a x ", "<ul><li>x", "<i>", "<b><div>", "&amp;", "<p>,"):
        took = []
        for size in (1 << 17, 1 << 19):
            page = unit * (size // len(unit))
            began = time.process_time()
            html.main_text(page)
            took.append(time.process_time() - began)
        assert took[1] < 9 * took[0] + 0.3, (unit, took)


def test_html_scores():
    """Points against their definition, node by node, on random trees."""
    rng = np.random.default_rng(11)

    def build(depth):
        tag = str(rng.choice(["div", "section", "article", "p", "ul", "li", "a", "b"] if depth else ["div"]))
        inner = "".join(build(depth + 1) if depth < 4 and rng.random() < 0.6 else " ".join(["word,"] * int(rng.integers(0, 60))) for _ in range(int(rng.integers(1, 4))))
        return f"<{tag}>{inner}</{tag}>"

    for _ in range(60):
        root = html.parse("<body>" + build(0) + build(0) + "</body>")
        html.best(root)
        nodes = []

        def visit(n, linked):
            linked = linked or n.tag == "a"
            nodes.append(n)
            own, of_links, commas = 0, 0, 0
            for k in n.kids:
                if isinstance(k, str):
                    size = len(" ".join(k.split()))
                    own, of_links, commas = own + size, of_links + size * linked, commas + k.count(",")
                else:
                    visit(k, linked)
                    if k.tag not in html.BLOCK:
                        own, of_links, commas = own + inline[id(k)][0], of_links + inline[id(k)][1], commas + inline[id(k)][2]
            inline[id(n)] = (own, of_links, commas)
            kids = [total[id(k)] for k in n.kids if not isinstance(k, str)]
            direct = [len(" ".join(k.split())) for k in n.kids if isinstance(k, str)]
            total[id(n)] = (sum(direct) + sum(a for a, _ in kids), sum(direct) * linked + sum(b for _, b in kids))

        inline, total, points = {}, {}, {}
        visit(root, False)
        for p in nodes:
            own, of_links, commas = inline[id(p)]
            if p.tag in html.BLOCK and own > of_links:
                share = (1 + commas + min(own // 100, 3) + own / 200) * (1 - of_links / own)
                up = p if p.tag in html.CONTAINERS else p.parent
                for part in (1, 2, 4):
                    if up is not None:
                        points[id(up)] = points.get(id(up), 0) + share / part
                        up = up.parent
        for n in nodes:
            size, linked = total[id(n)]
            assert abs(n.points - points.get(id(n), 0) * (1 - linked / max(size, 1))) < 1e-6


def test_html_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (1, "u", "<p>a</p>"), (None, None, "<article><p>b</p></article>")], "page_id long, url string, html string")
    assert sorted(r.text for r in html.extract(pages).collect()) == ["", "a", "b"]
    assert html.extract(pages.limit(0)).count() == 0


def test_quality(spark):
    good, bad = [prose(i, 80) for i in range(200)], ["word! " * 60 + str(i) for i in range(60)]
    d = docs(spark, [*good, *bad, None, "", "x" * 100000])
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i in range(260)] + [(None, 1, 0), (5, None, 0), (7, 9, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.scores(d, labels).collect()}
    assert len(got) == 263 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    out = [i for i in range(260) if got[i].held_out]
    assert np.mean([got[i].predicted == int(i < 200) for i in out]) > 0.95
    again = {r.doc_id: r.score for r in quality.scores(d.repartition(3), labels).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())
    assert quality.scores(d, labels.limit(0)).count() == 263 and quality.scores(d.limit(0), labels).count() == 0


def test_bradley_terry():
    """The fitted ranking is where the pairwise loss has its minimum, found by plain gradient descent."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, quality.FEATURES))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=80) > 0.4).astype(int)
    m = quality.bradley_terry(x, y, l2=0.05, max_pairs=4000)
    z = m.inputs(x)
    pick = np.random.default_rng(7)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    n = int(min(4000, 20 * max(len(good), len(bad))))
    d = z[pick.choice(good, n)] - z[pick.choice(bad, n)]
    w = np.zeros(z.shape[1])
    for _ in range(6000):
        w -= 0.3 * (d.T @ (1 / (1 + np.exp(-(d @ w))) - 1) / n + 0.05 * w)
    assert np.abs(w - m.weight).max() < 1e-3
    s = m.score(x)
    assert abs(np.mean(s < 0.3) - np.mean(y == 0)) < 0.05 and np.mean(s[good][:, None] > s[bad]) > 0.9


def test_quality_repeated_ids(spark):
    """An id that repeats is learned from once, and one that is labelled both ways not at all."""
    good, bad = [prose(i, 60) for i in range(60)], ["word! " * 50 + str(i) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    labels = [(i, int(i < 60), 0) for i in range(120)]
    one = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    many = quality.fit(spark.createDataFrame(rows * 3, "doc_id long, text string"), spark.createDataFrame([*labels * 2, (500, 1, 0), (500, 0, 0)], "doc_id long, quality int, toxic int"))
    assert np.allclose(one.weight, many.weight) and one.cut == many.cut


def test_quality_kept_columns(spark):
    d = docs(spark, [prose(1, 30), None])
    model = quality.bradley_terry(np.zeros((0, quality.FEATURES)), np.zeros(0))
    assert quality.score(d, model, out="score").columns == [*[c for c in d.columns if c != "score"], "score"]


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(900, 16)).astype(np.float32)
    v[100:160] = v[7]  # equal vectors
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [1.0]), (None, [1.0] * 16), (1004, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(vectors, vectors.where("vec_id % 50 = 0"), k=5, sample=256).collect()
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 900, 50):
        s = u @ u[q]
        want = sorted((-round(x, 12), i) for i, x in enumerate(s) if i != q)[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in mine] == [1, 2, 3, 4, 5] and all(abs(s[i] - x) < 1e-12 for _, i, x in mine)
        hit += len({i for _, i in want} & {i for _, i, _ in mine})
    assert hit / (18 * 5) >= 0.9
    ties = [r.vec_id for r in sorted((r for r in got if r.query_id == 100), key=lambda r: r.rank)]
    assert ties == [7, 101, 102, 103, 104]
    few = ann.search(vectors.where("vec_id < 3"), vectors.where("vec_id = 0"), k=5)
    assert few.count() == 2 and ann.search(vectors.limit(0), vectors, k=5).count() == 0


def test_neighbours_routed(spark, monkeypatch):
    """Small tables are searched by the routers' choice too, at the recall that they aim for; so are partitions that are cut again."""
    trees, asked = [], []
    learn, route = ann.learn, ann._route
    monkeypatch.setattr(ann, "learn", lambda *a, **b: trees.append(learn(*a, **b)) or trees[-1])
    monkeypatch.setattr(ann, "_route", lambda tree, probes, whole=False: asked.append((probes, whole)) or route(tree, probes, whole))
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.select("vec_id", "embedding").collect()
    u = ann.unit(np.array([r.embedding for r in rows], float))
    ids = np.array([r.vec_id for r in rows])
    for leaf in (16384, 40):
        trees.clear(), asked.clear()
        got = ann.search(vectors, vectors.where("vec_id % 20 = 0"), k=5, leaf=leaf, block=64).collect()
        assert trees[0].top.probes < trees[0].top.parts and (None, False) in asked
        assert (leaf == 40) == any(trees[0].below) and trees[0].leaves >= 16
        hit = total = 0
        for q in np.flatnonzero(ids % 20 == 0):
            s = u @ u[q]
            want = sorted((-round(x, 12), i) for i, x in zip(ids.tolist(), s) if i != ids[q])[:5]
            hit += len({i for _, i in want} & {r.vec_id for r in got if r.query_id == ids[q]})
            total += len(want)
        print("recall@5", hit / total, "leaves", trees[0].leaves, "probes", trees[0].top.probes, "of", trees[0].top.parts)
        assert hit / total >= 0.9


def quote_tree(rows):
    """Plain Python: parents, roots and reply order of the messages of one conversation (turn, text)."""
    mark, norm = re.compile(r"^[ \t]*((?:>[ \t]?)+)"), lambda x: " ".join(x.lower().split())
    lines = {t: [(m[0].count(">") if (m := mark.match(x)) else 0, mark.sub("", x)) for x in (text or "").split("\n")] for t, text in rows}
    says = {}
    for t in sorted(lines):
        run = []
        for level, x in [*lines[t], (0, "")]:
            if level == 0 and norm(x):
                says.setdefault(norm(x), t)
                run.append(x)
            else:
                says.setdefault(norm(" ".join(run)), t) if run else None
                run = []
    parent = {}
    for t in lines:
        asks = set()
        for i, (level, x) in enumerate(lines[t]):
            if level == 1 and norm(x):
                asks.add(norm(x))
                if i == 0 or lines[t][i - 1][0] != 1 or not norm(lines[t][i - 1][1]):
                    run = []
                    for n, y in lines[t][i:]:
                        if n != 1 or not norm(y):
                            break
                        run.append(y)
                    asks.add(norm(" ".join(run)))
        parent[t] = max((says[a] for a in asks if a in says and says[a] < t), default=None)
    order = {}

    def walk(t, root, depth):
        order[t] = (root, depth, 1 + sum(r == root for r, _, _ in order.values()))
        for child in sorted(c for c, p in parent.items() if p == t):
            walk(child, root, depth + 1)

    for t in sorted(t for t, p in parent.items() if p is None):
        walk(t, t, 0)
    return {t: (parent[t], *order[t]) for t in lines}


def test_quotes_reply_order(spark, monkeypatch):
    """Two replies to one root and a reply to each stand depth first; deep and wide threads too."""
    monkeypatch.setattr(quotes, "RUN", 4)
    rng = np.random.default_rng(6)
    convs = {1: [(0, "root"), (1, "> root\nfirst"), (2, "> root\nsecond"), (3, "> first\nthird"), (4, "> second\nfourth")]}
    for c in range(2, 7):
        said = {}
        for t in range(40):
            back = [] if t == 0 or rng.random() < 0.1 else [t - 1] if c == 2 else [0] if c == 3 else sorted({int(x) for x in rng.integers(0, t, 2)})
            lines = []
            for b in back:
                own = [x for x in said[b] if not x.startswith(">") and x]
                lines += ["On a day X wrote:"] * bool(rng.random() < 0.3) + [f"> {x.upper()}" for x in own] + [">> deeper quote " + str(b)]
            said[t] = [*lines, f"line a{t} of {c}", f"line  b{t}"] + ["", f"para {t}"] * (t % 3 == 0)
        convs[c] = [(t, "\n".join(x)) for t, x in said.items()]
    m = spark.createDataFrame([(c, t, "u" if t % 2 else "a", x) for c, rows in convs.items() for t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth, r.position) for r in quotes.threads(m).collect()}
    assert got == {(c, t): x for c, rows in convs.items() for t, x in quote_tree(rows).items()}
    built = quotes.conversations(m, most=3).collect()
    assert [r.turns for r in sorted(built, key=lambda r: (r.conv_id, r.root_turn, r.part)) if r.conv_id == 1] == [[0, 1, 3], [2, 4]]
    assert all(r.n_messages == len(r.texts) == len(r.roles) <= 3 for r in built) and sum(r.n_messages for r in built) == m.count()
    assert not any(x.startswith(">") for r in built for t in r.texts for x in t.split("\n"))


def test_quotes(spark):
    rows = [
        (1, 0, "u", "Hello there\nhow are you\n\nSecond para"), (1, 1, "a", "On Monday Bob wrote:\n> hello  THERE how\n> are you\n\nFine thanks"), (1, 2, "u", ">> how are you\n> Fine thanks\nGreat"), (1, 3, "a", "No quote"),
        (1, 4, "u", "> never said"), (2, 0, "u", None), (None, 0, "u", "> x"), (2, 1, "a", ""), (2, 0, "b", "> Fine thanks"), (1, 3, "a", "No quote"), (3, None, "u", "text"),
    ]
    m = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, root long")
    out = quotes.threads(m)
    got = {(r.conv_id, r.turn, r.role): r for r in out.collect()}
    assert out.count() == len(rows)
    assert [(got[1, t, x].parent_turn, got[1, t, x].root_turn, got[1, t, x].depth) for t, x in ((0, "u"), (1, "a"), (2, "u"), (3, "a"), (4, "u"))] == [(None, 0, 0), (0, 0, 1), (1, 0, 2), (None, 3, 0), (None, 4, 0)]
    assert got[1, 1, "a"].reply == "Fine thanks" and got[1, 2, "u"].reply == "Great" and got[1, 2, "u"].n_linked == 2
    assert got[2, 0, "b"].parent_turn is None and quotes.threads(m.limit(0)).count() == 0
    built = quotes.conversations(m).collect()
    assert sum(r.n_messages for r in built) == len(rows) and sorted(r.n_messages for r in built if r.conv_id is None or r.root_turn is None) == [1, 1]
    assert [(r.turns, r.texts) for r in built if r.conv_id == 1 and r.root_turn == 0] == [([0, 1, 2], ["Hello there\nhow are you\n\nSecond para", "Fine thanks", "Great"])] and quotes.conversations(m.limit(0)).count() == 0

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import LONG, empty, words
from pyspark.sql import functions as F

import corpus_pipeline
from checks import compare
from seriesprep.llm import html_extract, mixing, pivot_search, suffix_tree_lm, toxicity
from seriesprep.llm.common import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------- mixing
def waterfill(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    goal, free, left = {}, set(order), sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * sizes[s]}
        if not over:
            return goal | {s: share * weight[s] for s in free}
        goal |= {s: 3 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return goal


def test_mix_meets_its_targets(docs):
    rows = mixing.taken(docs).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(words(r["text"]))
    goal = waterfill(sizes)
    took, largest = Counter(), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], goal[r["source"]], abs_tol=1e-6)
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        took[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(rows) == docs.count()
    for s in sizes:  # repeated rows share a hash, so up to three are taken together here
        assert abs(took[s] - goal[s]) <= 1.5 * largest[s] + 1e-6
    again = mixing.taken(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mixed_rows_are_whole(spark, docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words_out = sum(len(words(r["text"])) for r in mixed.collect())
    assert words_out == sum(r["taken"] for r in mixing.taken(docs).collect())
    assert mixing.mix(empty(spark)).count() == 0 and mixing.taken(empty(spark)).count() == 0


def test_rows_without_id_meet_the_target_too(spark):
    rows = [(None if i % 2 else 7, f"w{i} " + "x " * 9, "abc"[i % 3 if i < 60 else 0]) for i in range(460)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.taken(docs).collect()
    took = Counter()
    for r in got:
        took[r["source"]] += r["taken"]
    assert len(got) == 460
    assert all(abs(took[r["source"]] - r["target"]) <= 10 for r in got)
    assert mixing.mix(docs).count() * 10 == sum(took.values())


def test_toxicity_query_defines_every_held_out(spark, tmp_path):
    docs, labels = corpus(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = QUERIES["op2_toxicity"](spark, str(tmp_path)).collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


# ----------------------------------------------------------------- toxicity
def corpus(spark):
    rows = [(i, f"plain words number {i % 7} and {'vile' if i % 3 == 0 else 'kind'} talk {i}") for i in range(240)]
    rows += [(300, None), (301, ""), (302, LONG), (303, LONG + " vile"), (None, "vile"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(240)] + [(1, None, None), (None, 1, 1), (3, 1, 1), (301, 1, 0), (302, 0, 0)]
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_scores(spark):
    docs, labels = corpus(spark)
    model, staged = toxicity.fit(docs, labels)
    got = {(r["doc_id"], r["text"]): r for r in toxicity.score(docs, model).collect()}
    for (_, text), r in got.items():
        assert 0 <= r["score"] <= 1
        assert (r["score"] >= 0.5) == ("vile" in (text or "").split())
    assert staged.count() == docs.count()
    with pytest.raises(ValueError):
        toxicity.score(docs.withColumn("score", F.lit(1)), model)


def test_toxicity_keeps_every_leaning_feature(spark):
    vile = " ".join(f"v{i:03d}" for i in range(700))  # as words and as beginnings of four letters
    rows = [(vile if i % 2 else f"kind talk {i}", i % 2) for i in range(80)]
    assert len(toxicity._select(spark.createDataFrame(rows, "text string, y int"))) == 1400


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = corpus(spark)
    model, _ = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    model, _ = toxicity.fit(docs.limit(0), labels)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(500):
        terms = rng.choice(40, rng.integers(1, 6), replace=False)
        w = rng.random(len(terms)).round(1) + 0.1
        vectors.append(dict(zip(terms.tolist(), (w / np.sqrt((w * w).sum())).tolist())))
    index = toxicity.BlockMaxIndex(vectors, list(range(1000, 1500)), 40)
    for q in vectors[:120]:
        near, at = index.nearest(q, 15)
        dots = sorted(((round(sum(q[t] * v.get(t, 0) for t in q), 12), -i) for i, v in zip(range(1000, 1500), vectors)), reverse=True)
        want = [(s, -i) for s, i in dots if s > 0][:15]
        assert [(round(s, 12), i) for s, i in zip(near, index.ids[at].tolist())] == want


# --------------------------------------------------------------------- html
def page(article, extra=""):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>Home</a></ul></nav>{extra}<article>{article}</article><footer>&copy; us</footer></body></html>"


def test_page_parts():
    text = lambda s: html_extract.Page(s).text()
    assert text(page("<h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four<br>five")) == "A & B\none two three\nfour five"
    assert text(page('<p>x<script>var t="</p>";</script> y</p><form>f</form><div class="user-comments"><p>c</p></div><p>in <span class="ad">ad</span> line')) == "x y\nin line"
    assert text("no tags &lt;at all&gt;") == "no tags <at all>"
    assert text("") == text("<!-- only") == text("<script>x") == ""
    assert text("<div>a</div></p></b><p>b") == "a\nb"


def test_names_of_topics_and_layouts_keep_text():
    text = lambda s: html_extract.Page(s).text()
    for kept in ("<section id='discussion'><p>x</p></section>", "<h2 id='legal'>x</h2>", "<h2 id='related-work' class='nav'>x</h2>", "<div id='search'><p>x</p></div>", "<section id='comments'>x</section>"):
        assert text(page(kept)) == "x"
    for name in ("page with-sidebar", "has-header", "no-ads", "ad-free", "without-footer wide"):
        assert text(f"<body><div class='{name}'><p>x</p></div></body>") == "x"
    for name in ("sidebar", "left-sidebar", "wide sidebar-2", "user_comments", "site-header", "ad", "share-buttons"):
        assert text(f"<body><div class='{name}'><p>x</p></div><p>y</p></body>") == "y"


def test_low_importance_branches_go(spark):
    body = "<html><body><div class='x'><p>Subscribe to us today</p></div><div class='y'><p>story {0} tells {0}</p></div></body></html>"
    rows = [(i, f"http://site.example/{i}", body.format(i), "k") for i in range(30)]
    rows += [(90, None, None, "k"), (91, "http://other.example/", "", "k"), (92, "http://other.example/", page("<p>" + LONG), "k"), (92, "http://other.example/", page("<p>" + LONG), "k")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert all(got[i] == f"story {i} tells {i}" for i in range(30))
    assert got[90] == got[91] == "" and got[92] == LONG
    assert html_extract.extract(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        html_extract.extract(pages, out="host")


def test_copies_of_a_page_weigh_once(spark):
    body = "<html><body><div class='x'><p>Subscribe to us today</p></div><div class='content'><p>story {0} tells {0}</p></div></body></html>"
    rows = [(i, "http://most.example/", body.format(0 if i < 80 else i)) for i in range(100)]  # most pages are copies of one
    rows += [(200 + i, "http://all.example/", body.format(0)) for i in range(30)]
    rows += [(300 + i, None, body.format(i)) for i in (0, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"].split("\n") for r in html_extract.extract(pages).collect()}
    assert all(got[i] == [f"story {0 if i < 80 else i} tells {0 if i < 80 else i}"] for i in range(100))
    assert all("story 0 tells 0" in got[200 + i] for i in range(30))
    counts = html_extract.style_tree(pages).filter("kind = ''").collect()
    assert {r["host"]: r["pages"] for r in counts} == {"most.example": 21, "all.example": 1, "": 2}


# ------------------------------------------------------------------- search
@pytest.mark.parametrize("block", [2048, 16])
def test_search_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(pivot_search, "ANNULUS", 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 6)) * 3
    rows = [(i, (centres[rng.integers(0, 5)] + rng.normal(size=6) * 0.2).round(2).tolist()) for i in range(300)]
    rows += [(i, [1.0] * 6) for i in range(400, 480)]
    rows += [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (550, [0.5] * 4), (600, []), rows[0], (None, [1.0] * 6)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, id string")
    vectors = pivot_search.quantised(table)
    got = pivot_search.search(vectors, vectors.filter("id % 50 = 0"), 5).collect()
    known = {i: np.floor(256 * np.array(v + [0.0] * (6 - len(v)))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    for q in (i for i in known if i % 50 == 0):
        want = sorted((-int(known[q] @ v), i) for i, v in known.items() if i != q)[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [(i, -s) for s, i in want]
    assert pivot_search.search(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_repeated_rows_hide_no_neighbour(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "ANNULUS", 8)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(200)]
    rows += [(i, [9.0 + i / 100] * 6) for i in (300, 301, 303)] * 6  # at the top of every query, six times each
    rows += [rows[50]] * 5 + [(7, [8.0] * 6), (7, [0.0] * 5 + [48.0]), (400, [1.0] * 6)]  # a repeated query, different vectors of one id
    vectors = pivot_search.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = pivot_search.search(vectors, vectors.filter("id % 50 = 0"), 5).collect()
    known = {(i, tuple(np.floor(256 * np.array(v)))) for i, v in rows}
    for q, x in ((q, np.array(x)) for q, x in known if q % 50 == 0):
        want = sorted((-int(x @ np.array(v)), i) for i, v in known if i != q)[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [(i, -s) for s, i in want]


# ----------------------------------------------------------- language model
def brute_scores(rows, held):
    """The model of the docstring, written out."""
    lm = suffix_tree_lm
    texts = [[*words(t), None] for t in rows]
    c = Counter(w for t, h in zip(texts, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    limits = [{w for w in c if w is not None and c[w] >= max(s, lm.LEAST_SHARE) * n} for s in lm.WORD_SHARES]
    pair, count = Counter(), Counter()
    for t, h in zip(texts, held):
        for k in range(len(t) if not h else 0):
            for size in (1, 2, 3):
                if k >= size and all(w in limits[size - 1] for w in t[k - size : k]):
                    pair[tuple(t[k - size : k]), t[k]] += 1
                    count[tuple(t[k - size : k])] += 1
    known = {s for s in count if count[s] >= lm.LEAST_SHARE * n}

    def p(w, s, states):
        if not s:
            return (c[w] + 0.5) / (n + 0.5 * (v + 1))
        below = p(w, s[1:], states)
        return (pair[s, w] + lm.ALPHA * below) / (count[s] + lm.ALPHA) if s in states else below

    gain = Counter()
    for (s, w), k in pair.items():
        if s in known:
            below = p(w, s[1:], known)
            gain[s] += k * math.log((k - 1 + lm.ALPHA * below) / (count[s] - 1 + lm.ALPHA) / below)
    kept = {s for s in known if gain[s] > 0}
    out = []
    for t in texts:
        total = base = 0.0
        for k, w in enumerate(t):
            state = next((tuple(t[k - size : k]) for size in (3, 2, 1) if k >= size and tuple(t[k - size : k]) in kept), ())
            total += math.log10(p(w, state, kept))
            base += math.log10(p(w, (), kept))
        out.append((len(t), sum(c[w] > 0 for w in t), n, base, total))
    return out, kept


def test_scores_equal_the_formula(spark, docs, monkeypatch):
    monkeypatch.setattr(suffix_tree_lm, "WORD_SHARES", (5e-4, 1e-3, 1e-2))
    monkeypatch.setattr(suffix_tree_lm, "LEAST_SHARE", 1e-4)
    monkeypatch.setattr(suffix_tree_lm, "ALPHA", 3.0)
    monkeypatch.setattr(suffix_tree_lm, "CHUNK", 20_000)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] * 2
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in rows]
    table = spark.createDataFrame([(*r, h) for r, h in zip(rows, held)], "doc_id bigint, text string, h boolean")
    got = suffix_tree_lm.score(table, F.col("h")).collect()
    want, kept = brute_scores([t for _, t in rows], held)
    assert kept and any(len(s) > 1 for s in kept)
    key = lambda r: tuple((x is None, x) if not isinstance(x, float) else round(x, 4) for x in r)
    expect = sorted(((i, h, *w) for (i, _), h, w in zip(rows, held, want)), key=key)
    for a, b in zip(sorted(map(tuple, got), key=key), expect):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def every_context(texts, held):
    """Scores by the tree over every context of one to three words, written out; and its states."""
    texts = [[*words(t), None] for t in texts]
    count = Counter(tuple(t[k - size : k + 1]) for t, h in zip(texts, held) if not h for k in range(len(t)) for size in range(min(k, 3) + 1))
    n, v = sum(c for s, c in count.items() if len(s) == 1), sum(len(s) == 1 for s in count)
    of, alpha = Counter(), suffix_tree_lm.ALPHA
    for s, c in count.items():
        of[s[:-1]] += c

    def p(s, w, states):
        if not s:
            return (count[(w,)] + 0.5) / (n + 0.5 * (v + 1))
        below = p(s[1:], w, states)
        return (count[*s, w] + alpha * below) / (of[s] + alpha) if states is None or s in states else below

    gain = Counter()
    for (*s, w), c in count.items():
        if s and of[s := tuple(s)] > 1:
            below = p(s[1:], w, None)
            gain[s] += c * math.log((c - 1 + alpha * below) / (of[s] - 1 + alpha) / below)
    states = {s for s, g in gain.items() if g > 0}
    return [sum(math.log10(p(tuple(t[max(0, k - 3) : k]), w, states)) for k, w in enumerate(t)) for t in texts], states


@pytest.mark.parametrize("chunk, part", [(300, 500), (1_000_000, 2_000_000)])
def test_contexts_of_rare_words_are_states(spark, monkeypatch, chunk, part):
    monkeypatch.setattr(suffix_tree_lm, "CHUNK", chunk)
    monkeypatch.setattr(suffix_tree_lm, "PART", part, raising=False)
    rng = np.random.default_rng(8)
    filler = lambda n: " ".join(f"f{i}" for i in rng.integers(0, 2000, n))
    # four words of a passage make up 0.03% each, far from enough for a long context by the share of a word
    texts = [f"{filler(200)} Once upon a midnight {filler(rng.integers(0, 9))}" if i % 20 == 0 else filler(200) for i in range(150)]
    texts += [None, "", "a a a a a a", "upon a midnight", "once UPON\ta midnight", texts[0], texts[0]]
    held = [i % 7 == 3 for i in range(len(texts))]
    rows = [(i % 100 if i % 11 else None, t, h) for i, (t, h) in enumerate(zip(texts, held))]
    got = suffix_tree_lm.score(spark.createDataFrame(rows, "doc_id bigint, text string, h boolean"), F.col("h")).collect()
    want, states = every_context(texts, held)
    assert {(b"once", b"upon", b"a"), (b"upon", b"a"), (b"once",)} <= states
    key = lambda r: ((r[0] is None, r[0] or 0), r[1], round(r[2], 6))
    got = sorted(((r["doc_id"], r["held_out"], r["score"]) for r in got), key=key)
    for a, b in zip(got, sorted(((i, h, s) for (i, _, h), s in zip(rows, want)), key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9)


def test_scores_of_empty_tables(spark, docs):
    assert suffix_tree_lm.score(empty(spark), F.lit(False)).count() == 0
    assert suffix_tree_lm.score(docs, F.lit(True)).count() == docs.count()


# ----------------------------------------------------------------- pipeline
def test_stages_keep_columns_and_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stage(step(spark, docs, SF), name)
        assert after.dtypes == start.dtypes
        if name == "toxicity":
            gone = docs.join(after, "doc_id", "left_anti").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
            assert gone.filter("toxic = 0").count() <= 2
        if name == "line_dedup":
            assert after.count() == docs.count()
        docs = after
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count() and out.filter("NOT round_trip").count() == 0


def test_near_duplicates_go_by_row(spark):
    long = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, long(1)), (2, long(1) + " tail"), (2, long(2)), (None, long(3)), (None, long(3)), (None, long(4)), (3, long(4)), (4, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()), key=str)
    assert kept == sorted([(1, long(1)), (2, long(2)), (None, long(3)), (3, long(4)), (4, None), (4, "")], key=str)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    ok, message = compare.compare(spark, compare.duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert ok, message


def test_stages_keep_columns_whatever_they_are_called(spark, docs):
    names = ["_place", "score", "evidence", "coded", "ids", "row", "_group", "a.b", "_judged"]
    clashing = docs.select("*", *[F.lit(f"keep {n}").alias(n) for n in names])
    for name, step in (corpus_pipeline.STAGES[0], corpus_pipeline.STAGES[2]):
        out = step(spark, clashing, SF)
        assert out.columns == clashing.columns, name
        rows = out.select(*[F.col(f"`{n}`") for n in names]).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"keep {n}" for n in names)], name
    out = corpus_pipeline.encode(spark, clashing, SF).collect()
    assert len(out) == docs.count() and all(r["round_trip"] for r in out)


def test_pipeline_steps_hold_arrow_batches_of_a_few_mb(spark, docs):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for given, then in (("67108864b", 4_000_000), ("1000000b", 1_000_000)):  # a smaller one of the session stays
            for _, step in corpus_pipeline.STAGES[-2:]:
                spark.conf.set(name, given)
                step(spark, docs, SF)
                assert int(spark.conf.get(name).rstrip("b")) == then
    finally:
        spark.conf.set(name, before)

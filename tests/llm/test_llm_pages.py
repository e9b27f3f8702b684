"""Sharding, pages, toxicity and the pipeline."""

from __future__ import annotations

import random
import time
import zlib

import corpus_pipeline
import llm_brute as brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlens.llm import htmltext, queries, sharding, toxicity
from flowlens.llm.workspace import BATCH_CONF, BATCH_ROWS, new_path, stored

DOCS = "doc_id long, text string"
SMALL = "/root/testdata/sf0.01"


def test_shards_have_near_equal_bytes_and_gapless_slots(spark):
    rng = random.Random(1)
    rows = [(i, "é" * rng.randrange(0, 400)) for i in range(4000)] + [(None, None), (5, "x"), (5, "x"), (5, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("shard", F.lit("clash"))
    got = sharding.shard_documents(df, 7, new_path(spark, "map")).collect()
    assert len(got) == len(rows)
    load = [sum(r["size"] for r in got if r.shard == s) for s in range(7)]
    assert max(load) <= 1.02 * min(load)
    for s in range(7):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == want
    assert sharding.shard_documents(df.where("false"), 3, new_path(spark, "map")).collect() == []


def test_query_of_shards_follows_its_law(spark):
    """Every column of the registered query, for every row."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op2_virtual_slots(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    shards = {}
    for r in got:
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(docs[r.doc_id].encode()) + 16, zlib.crc32(docs[r.doc_id].encode()), "bytes", None)
        shards.setdefault(r.shard, []).append(r)
    assert sorted(shards) == list(range(40))
    loads = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(loads) <= 1.02 * min(loads)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in shards.values())


def test_map_versions_and_rebalancing(spark):
    rng = random.Random(2)
    totals = [(slot, rng.randrange(100, 1000), 3) for slot in range(2000)]
    size = {s: b for s, b, _ in totals}
    first = sharding.build_map(totals, 10)
    grown = sharding.rebalance(first, totals, 11)
    moved = [s for s in first if grown[s] != first[s]]
    assert {grown[s] for s in moved} == {10} and sum(size[s] for s in moved) <= 1.1 * sum(size.values()) / 11
    shrunk = sharding.rebalance(first, totals, 9)
    assert set(shrunk.values()) == set(range(9)) and all(shrunk[s] == first[s] for s in first if first[s] < 9 and shrunk[s] != 9)
    folder = new_path(spark, "map")
    sharding.save_map(sharding.map_table(spark, first, totals, 1), folder)
    sharding.save_map(sharding.map_table(spark, grown, totals, 2), folder)
    assert {r.virtual_slot: r.shard for r in sharding.load_map(spark, folder, 1).collect()} == first
    assert {r.virtual_slot: r.shard for r in sharding.load_map(spark, folder).collect()} == grown


def page(i, body, extra=""):
    return (i, f"https://site.example/{i}", f"<html><head><title>t</title></head><body>{extra}{body}</body></html>")


def test_templates_are_deleted_and_articles_kept(spark):
    block = "<div><span>Best offers</span> of the week</div>"      # no telling tag or class: only recurrence shows it
    rows = [page(i, f"<div><p>Text {i} &amp; more<p>Second\n line {i}</div>{block}", "<nav><a href=x>Home</a></nav>") for i in range(8)]
    rows += [page(20 + i, f"<article><h1>Same</h1><p>Copied story</p></article>{block}") for i in range(9)]
    rows += [(40, None, None), (41, "https://lone.example/", f"<p>Alone{block}"), (42, "x", ""), (43, "https://site.example/a", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert all(got[i] == f"Text {i} & more\n\nSecond line {i}" for i in range(8))
    assert all(got[20 + i] == "Same\n\nCopied story" for i in range(9))
    assert (got[40], got[42], got[43]) == ("", "", "") and got[41] == "Alone\n\nBest offers of the week"
    joined = {r.page_id: r.text for r in htmltext.extract(df, max_broadcast=0).collect()}
    assert joined == got
    assert htmltext.extract(df.where("false")).collect() == []


def test_templates_inside_articles_are_deleted(spark):
    """What most articles of a host hold goes, what copies of one article hold stays."""
    block = "<div>Read this <span>in our app</span> today</div>"     # no telling tag or class
    own = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(30)]
    rows = [page(i, f"<article><p>{own[i]}</p>{block}</article>") for i in range(20)]
    rows += [page(50 + i, f"<main><h1>Copied</h1><p>The same long story on every page</p></main><p>{i}</p>") for i in range(40)]
    rows += [page(100 + i, f"<p>{own[20 + i]}</p>{block}") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert all(got[i] == own[i] for i in range(20))
    assert all(got[50 + i] == "Copied\n\nThe same long story on every page" for i in range(40))
    assert all(got[100 + i] == f"{own[20 + i]}\n\nRead this in our app today" for i in range(2))
    assert {r.page_id: r.text for r in htmltext.extract(df, max_broadcast=0).collect()} == got


def test_text_of_near_copies_and_common_sentences_stay(spark):
    """Pages without article: a story in near copies and a sentence of few pages are no template."""
    story = "".join(f"<p>Paragraph {k} of the story tells {' '.join(f'w{k}x{j}' for j in range(30))}.</p>" for k in range(4))
    rows = [page(i, f"<div>{story}<p>Printed on day {i}.</p></div>", f"<nav><a href=x>Link {i}</a></nav>") for i in range(12)]
    rows += [page(100 + i, f"<p>Own text {' '.join(f'v{i}y{j}' for j in range(20))}.</p>{'<p>No comment.</p>' * (i < 6)}") for i in range(300)]
    small = [(1000 + i, f"https://small.example/{i}", f"<div>{story}<p>Seen {i} times</p></div>") for i in range(6)]
    small += [(1100 + i, f"https://small.example/o{i}", f"<p>Other {' '.join(f'z{i}y{j}' for j in range(20))}</p>") for i in range(4)]
    df = spark.createDataFrame(rows + small, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert all(got[i].count("of the story tells") == 4 for i in [*range(12), *range(1000, 1006)])
    assert all(got[100 + i].endswith("No comment.") for i in range(6))


@pytest.mark.parametrize("source, text", [
    ("<p>a<br>b</p>", "a b"),
    ("<p>a <b>bo</b>ld</p><p>c", "a bold\n\nc"),
    ("<script>var t='</p>'</script><style>p{}</style>x", "x"),
    ("<main>m</main><p>outside</p>", "m"),
    ("<article>a<div class='comments'><p>reader</p></div></article>", "a"),
    ("<article><header><h1>T</h1></header>b<footer>f</footer></article><aside>s</aside>", "T\n\nb"),
    ("<div id='cookie-notice'>c</div><form>q</form><p>&lt;x&gt; &nbsp; &eacute;&#33;", "<x> é!"),
    ("<ul><li>one<li>two</ul><!-- no <p>x</p> -->3 < 4", "one\n\ntwo\n\n3 < 4"),
    ("<p>cut <a href='x", "cut"),
    ("<div class='banner'><article>in</article></div>", "in"),
    ('<article><header class="entry-header"><h1>Title</h1></header><p>Body</p></article>', "Title\n\nBody"),
    ('<div class="content has-sidebar"><p>hello world</p></div>', "hello world"),
    ('<article><p>a</p><section class="social-policy"><p>kept</p></section><p id="notice-period">too</p></article>', "a\n\nkept\n\ntoo"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", "so x=2 holds"),
    ('<article><div class="header"><h1>Head</h1></div><p>long body of the page</p><div class="main-nav">menu</div></article>',
     "Head\n\nlong body of the page"),
    ('<div class="widget"><p>most of the text of the page is in here</p></div><div class="widget">x</div>', "most of the text of the page is in here"),
    ('<article>a long text of the author<div class="post-comments"><p>reader</p></div></article>', "a long text of the author"),
    ('<body><div class="has-comments"><p>the page</p></div></body>', "the page"),
    ('<article>a<div class="comments-area"><p>readers write more than the author ever did</p></div></article>', "a"),
])
def test_page_rules(source, text):
    assert htmltext.Page(source).text(frozenset()) == text


@pytest.mark.parametrize("source, text", [
    ("</div>" * 100_000 + "<p>x", "x"),
    ("<div>" * 20_000 + "x" + "</b>" * 20_000, "x"),
    ("<p>" + "<b>" * 20_000 + "x</p><p>y", "x\n\ny"),
    ("<li>x" * 20_000, "\n\n".join(["x"] * 20_000)),
    ("<article>" * 5_000 + "x", "x"),
])
def test_odd_pages_take_linear_time(source, text):
    began = time.process_time()
    assert htmltext.Page(source).text(frozenset()) == text
    assert time.process_time() - began < 10


def test_pages_of_the_test_data_equal_their_articles(spark):
    import html
    import re

    got = {r.page_id: r.text for r in queries.op4_template_removal(spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", body)]
        assert got[r.page_id] == "\n\n".join(x for x in parts if x)


def distance_to_beginning(word, entry):
    """Least edits between the entry and any beginning of the word."""
    row = list(range(len(entry) + 1))
    best = row[-1]
    for i, c in enumerate(word, 1):
        new = [i]
        for j, e in enumerate(entry, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != e)))
        row = new
        best = min(best, row[-1])
    return best


def test_automaton_equals_edit_distance():
    rng = random.Random(4)
    entries = ["idiot", "pathetic", "scum", "worthless", "idiom", "achlich"]
    automaton = toxicity.LexiconAutomaton(entries)
    for _ in range(4000):
        word = list(rng.choice(entries)) + [rng.choice("abit") for _ in range(rng.randrange(3))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word)) if word else 0
            kind = rng.randrange(3)
            word[at:at + (kind != 1)] = [] if kind == 0 else [rng.choice("abcdeiotx")]
        word = "".join(word)
        near = [(distance_to_beginning(word, e), e) for e in entries]
        allowed = [(d, e) for d, e in near if d <= toxicity.edits_allowed(e)]
        got = automaton.match(word)
        if not word or not allowed:
            assert got is None or not word, word
        else:
            assert got is not None and got[1] == min(d for d, _ in allowed), word
            assert (got[1], entries[got[0]]) in allowed


def test_context_separates_quotation_from_abuse():
    model = toxicity.Model(["moron"], [1.0], [0.5], [-3.0, 2.0, 4.0, 2.0], 0.1)
    scorer = toxicity.Scorer(model)
    plain, abuse = scorer.score("he is such a moron today"), scorer.score("you moron today")
    quoted = scorer.score('the word "moron" is of greek origin')
    assert quoted < plain < abuse and scorer.score("fine words") < 0.1
    assert scorer.score("a morom here") > scorer.score("a word here")
    assert scorer.score(None) == scorer.score("")


def test_toxicity_of_unseen_documents(spark):
    got = queries.op10_toxicity(spark, SMALL).join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = sum(r.predicted == 1 and r.toxic == 1 for r in got)
    assert hits >= 0.6 * sum(r.toxic for r in got)
    assert hits >= 0.9 * sum(r.predicted for r in got)
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a moron"), (None, None), (2, "")], DOCS).withColumn("toxic", F.lit(3))
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == 3 and len({r.toxic_score for r in got}) == 1 and got[0].toxic_score < toxicity.THRESHOLD


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and clashing names through all stages; then no row at all."""
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text), (2, text), (2, text), (None, "alone " + " ".join(f"n{i}" for i in range(30))), (3, None), (4, ""), (5, "short"),
            (6, " ".join(f"b{i}" for i in range(12)))]
    names = ["node", "toxic_score", "sequence", "rest", "paths", "owner", "row", "hit_spans", "number"]
    docs = spark.createDataFrame(rows, DOCS).select("doc_id", "text", *[F.lit(7).alias(n) for n in names])
    spark.createDataFrame([(9, " ".join(f"b{i}" for i in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {1, None, 3, 4, 5} and got[3] == got[4] == 0 < got[5]
    stage = docs
    for _, run in corpus_pipeline.STAGES[:-1]:
        stage = stored(run(spark, stage, str(tmp_path)), "odd")
        assert stage.columns == docs.columns and all(r[n] == 7 for r in stage.collect() for n in names)
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_stages_hand_python_few_rows_at_once(spark):
    """Also in the job that writes a stage's result, whatever the session had set before."""
    def sizes(batches):
        for rows in batches:
            yield pa.RecordBatch.from_arrays([pa.array([rows.num_rows])], ["n"])

    docs = spark.range(3000).selectExpr("id AS doc_id", "cast(id AS string) AS text").coalesce(1)
    old = spark.conf.get(BATCH_CONF)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.set(BATCH_CONF, "10000")
            stage(spark, docs.limit(3), SMALL)
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) <= BATCH_ROWS <= 256, name
    finally:
        spark.conf.set(BATCH_CONF, old)


def test_pipeline_stages_take_effect(spark):
    """Every stage's result equals brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = stored(stage(spark, docs, SMALL), f"test-{name}")
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append((name, before, docs.collect()))
    stages = {name: (before, after) for name, before, after in kept}
    before, after = stages["near_copies"]
    assert sorted(r.doc_id for r in after) == [d for d, _, least in brute.components(before) if d == least]
    before, after = stages["substring_dedup"]
    assert {r.doc_id: " ".join(brute.words(r.text)) for r in after} == {d: t for d, _, _, t in brute.removals(before)}
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(r.doc_id for r in after) == sorted(r[0] for r in brute.contamination(before, items) if not r[5])
    before, after = stages["sentencepiece"]
    assert len(after) == len(before)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    before, after = stages["toxicity"]
    gone = {d for d, _ in before} - {r.doc_id for r in after}
    assert sum(labels.get(d) == 0 for d in gone) <= 2 and sum(labels.get(d) == 1 for d in gone) >= 20

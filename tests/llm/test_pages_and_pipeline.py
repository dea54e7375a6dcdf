"""Page extraction and the corpus pipeline, with brute force and planted cases."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelake.llm import op4_html
from tidelake.llm.html_blocks import blocks_of

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text string, host string"


def text_of(html):
    return op4_html.join_blocks([t for t, main, aside in blocks_of(html) if main and not aside])


@pytest.mark.parametrize("html,want", [
    ("<nav>a</nav><article><h1>T</h1><p>x <b>y<br>z<p>w</article><footer>f</footer>", "T\n\nx y z\n\nw"),
    ("<article><p>a&amp;b &#233;&nbsp;c</p><script>var t='</p>';</script><style>p{}</style><!-- c --></article>", "a&b é c"),
    ("<main><p>x</p><aside>no</aside><div class='ad'>no</div><section id='comments'><p>no</p></section><p>y</p></main>", "x\n\ny"),
    ("<article><p>x<form>no</form><p class='notice'>no<p>y</article><article class='comment'><p>no</p></article>", "x\n\ny"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc\n\nd"),
    ("<article>\n  a\t b\n c  </article>", "a b c"), ("", ""), ("plain", ""), ("<article></article>", ""),
    ("<article><p>x</p><script>never closed <p>no", "x"), ("</p></div><article>x</b>y</article>", "xy"),
    ("<article><p>readable headerless adder</p></article>", "readable headerless adder"),
    ("<article><div class='article-header'><h1>T</h1></div><p class='share-price'>x</p></article>", "T\n\nx"),
    ("<article><p class='share-buttons'>no</p><p class='cookie-notice'>no</p><div class='site-header'>no</div>x</article>", "x"),
    ("<div class='article-header'>no</div><p class='share-price'>no</p><main>x</main>", "x"),
])
def test_markup(html, want):
    assert text_of(html) == want


def test_given_pages(spark):
    got = op4_html.op4_html(spark, SF).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(html)
    for r in got:
        inner = re.search("<article>(.*)</article>", html[r.page_id], re.S)[1]
        want = [re.sub(r"\s+", " ", re.sub("<[^>]*>", " ", x)).strip() for x in re.split(r"</?(?:p|h1)>", inner)]
        import html as h
        assert r.text == "\n\n".join(h.unescape(x) for x in want if x)
        assert r.n_chars == len(r.text)


def plain_coverage(pages, run, least):
    """Positions of each page covered by a run that at least ``least`` different streams hold."""
    grams = [[tuple(p[i:i + run]) for i in range(len(p) - run + 1)] for p in pages]
    seen = Counter(g for p in {tuple(p): g for p, g in zip(pages, grams)}.values() for g in set(p))
    return [{i + k for i, g in enumerate(gs) if seen[g] >= least for k in range(run)} for gs in grams]


def test_suffix_array_removes_repeated_runs(spark):
    menu = "home news sport culture contact imprint search".split()
    foot = "all rights reserved by the publisher of this site".split()
    bodies = [[f"b{i}x{k}" for k in range(30)] for i in range(5)]
    streams = [menu + b + foot for b in bodies] + [bodies[0]]
    rows = [(i, f"http://www.a.example/{i}", f"<div>{' '.join(s)}</div>", "t", "h") for i, s in enumerate(streams)]
    rows += [(10 + i, "http://other.example/x", f"<p>{' '.join(menu + bodies[i])}</p>", "t", "h") for i in (1, 1)]  # copies
    rows += [(20, None, None, "t", "h"), (None, "::bad", "", "t", "h")]
    got = {r.page_id: r.text for r in op4_html.main_text(spark.createDataFrame(rows, PAGES), pages_least=2).collect()}
    cover = plain_coverage(streams, op4_html.RUN, 2)
    for i, s in enumerate(streams):
        assert got[i].split() == [w for k, w in enumerate(s) if k not in cover[i]]
    assert got[1].split() == bodies[1]
    assert got[11].split() == menu + bodies[1]
    assert (got[20], got[None]) == ("", "")
    assert op4_html.main_text(spark.createDataFrame([], PAGES)).count() == 0


def plain_text(pages, least, run, depth):
    """Main texts of one host's open pages (lists of blocks of words), from all substrings of all streams."""
    streams = [[None] + [w for b in p for w in [*b, None]] for p in pages]
    at_least = {}
    for s in {tuple(s) for s in streams}:
        for sub in {s[i:i + k] for i in range(len(s)) for k in range(1, depth + 1) if i + k <= len(s)}:
            at_least[sub] = at_least.get(sub, 0) + 1
    out = []
    for s in streams:
        gone = set()
        for i in range(len(s)):
            for k in range(1, depth + 1):
                sub = tuple(s[i:i + k])
                if i + k <= len(s) and at_least[sub] >= least:
                    whole = sub[0] is None and sub[-1] is None
                    if whole or sum(w is not None for w in sub) >= run:
                        gone |= set(range(i, i + k))
        blocks = " ".join("|" if w is None else w for i, w in enumerate(s) if w is None or i not in gone).split("|")
        out.append("\n\n".join(b.strip() for b in blocks if b.strip()))
    return out


@pytest.mark.parametrize("seed,block", [(1, 10**6), (2, 60), (3, 17)])
def test_suffix_array_equals_all_substrings(spark, seed, block):
    """Random pages over few words, hosts of several sizes, and arrays cut over many tasks."""
    r = random.Random(seed)
    chrome = [[r.choice("abc") for _ in range(r.randint(1, 12))] for _ in range(4)]
    hosts = {f"h{h}": [[r.choice(chrome) if r.random() < .4 else [r.choice("abcdefgh") for _ in range(r.randint(1, 9))]
                        for _ in range(r.randint(0, 6))] for _ in range(n)] for h, n in enumerate((1, 2, 3, 7, 24))}
    rows, want = [], {}
    for h, pages in hosts.items():
        distinct = len({str(p) for p in pages if p})
        texts = plain_text(pages, max(op4_html.PAGES, -(-distinct // 2)), 4, 9)
        for p, text in zip(pages, texts):
            want[len(rows)] = text
            rows.append((len(rows), f"http://{h}/", "".join(f"<div>{' '.join(b)}</div>" for b in p), None, None))
    frame = spark.createDataFrame(rows, PAGES).repartition(5)
    got = {x.page_id: x.text for x in op4_html.main_text(frame, run=4, depth=9, block=block).collect()}
    assert got == want
    assert any(want[i] != text_all(rows[i][2]) for i in want)


def text_all(html):
    return op4_html.join_blocks([t for t, _, _ in blocks_of(html)])


def test_small_hosts_short_menus_and_copies(spark):
    def page(i, host, *blocks):
        return i, f"http://{host}/", "".join(f"<div>{b}</div>" for b in blocks), "t", "h"

    rows = [page(i, "two.example", "the same text on both pages of this host", f"own {i}") for i in (0, 1)]
    rows += [page(10 + i, "four.example", "home news contact", f"text number {i} by hand", "print") for i in range(4)]
    rows += [page(20 + i, "copies.example", "all pages of this host are one page") for i in range(5)]
    got = {r.page_id: r.text for r in op4_html.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[0] == "the same text on both pages of this host\n\nown 0"
    assert [got[10 + i] for i in range(4)] == [f"text number {i} by hand" for i in range(4)]
    assert {got[20 + i] for i in range(5)} == {"all pages of this host are one page"}


def test_passages_that_few_pages_share_and_text_beside_teasers_stay(spark):
    menu = "home news sport culture contact imprint search"
    shared = "these ten words are in the articles of two pages"
    bodies = [" ".join(f"b{i}x{k}" for k in range(30)) for i in range(8)]
    rows = [(i, "http://a.example/", f"<div>{menu}</div><div>{b}</div><div>{shared if i < 2 else f'end{i}'}</div>", "t", "h")
            for i, b in enumerate(bodies)]
    teasers = "".join(f"<article>teaser number {i}</article>" for i in range(3))
    rows.append((20, "http://b.example/", f"<div>{bodies[0]}</div>{teasers}", "t", "h"))
    rows.append((21, "http://b.example/", f"<article>{bodies[1]}</article><div>an advert</div>", "t", "h"))
    got = {r.page_id: r.text for r in op4_html.main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[i] for i in range(8)] == [f"{b}\n\n{shared if i < 2 else f'end{i}'}" for i, b in enumerate(bodies)]
    assert got[20].startswith(bodies[0])
    assert got[21] == bodies[1]


def test_array_takes_whole_pages_and_markup_checks_it(spark):
    """Pages with an article are in the array too: what a host repeats beside articles does not outweigh them."""
    notice = "please read our terms of use before you copy any text"
    menu = " ".join(f"menu{k}" for k in range(60))
    own = [" ".join(f"b{i}x{k}" for k in range(30)) for i in range(8)]
    rows = [(i, "http://a.example/", f"<div>{menu}</div><article><h2>Summary</h2><p>{b}</p><p>{notice}</p></article><div>ad {i}</div>", "t", "h")
            for i, b in enumerate(own)]  # more words in the menu than in the article
    rows += [(10 + i, "http://b.example/", f"<div>{b}</div><article>teaser number {i}</article>", "t", "h") for i, b in enumerate(own)]
    rows += [(20 + i, "http://c.example/", f"<article><p>{b}</p><p>{notice}</p></article>", "t", "h") for i, b in enumerate(own)]
    rows += [(30 + i, "http://c.example/", f"<div>{own[i][::-1]}</div><div>{notice}</div>", "t", "h") for i in range(2)]  # no article
    got = {r.page_id: r.text for r in op4_html.main_text(spark.createDataFrame(rows, PAGES).repartition(5)).collect()}
    for i, b in enumerate(own):
        assert got[i] == f"Summary\n\n{b}\n\n{notice}"
        assert got[10 + i] == f"{b}\n\nteaser number {i}"
        assert got[20 + i] == f"{b}\n\n{notice}"
    assert [got[30 + i] for i in range(2)] == [b[::-1] for b in own[:2]]


@pytest.mark.parametrize("chunk,parts", [(512, 1), (4, 3), (7, 6)])
def test_beginnings_lose_no_repeat(spark, monkeypatch, chunk, parts):
    """Whatever groups the pages fall into, every beginning on enough distinct pages is found."""
    import numpy as np

    monkeypatch.setattr(op4_html, "CHUNK", chunk)
    r = random.Random(chunk)
    pages = [[" ".join(r.choice("aab") for _ in range(r.randint(3, 8))) for _ in range(r.randint(2, 4))] for _ in range(30)]
    pages += [pages[0]] * 9 + [pages[1]] * 4
    distinct = list({tuple(p): p for p in pages}.values())
    least = -(-len(distinct) // 2)
    seen = Counter(g for c in op4_html.streams(distinct) for g in set(np.concatenate([x[y] for x, y in [op4_html.beginnings(c, 3)]]).tolist()))
    want = {g for g, n in seen.items() if n >= least}
    frame = spark.createDataFrame([("h", least / len(pages), b) for b in pages], "host string, need double, blocks array<string>")
    frame = frame.withColumn("digest", F.xxhash64("blocks")).repartition(parts)
    [row] = op4_html.common_beginnings(frame, 3).collect()
    assert want and want <= {g % 2**64 for g in row.grams}


def test_pages_are_hashed_together(monkeypatch):
    """The arrays of many pages are made in a few steps, whatever the number of pages and where these are cut."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(5)
    pages = [[" ".join(r.choice("abcdé") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 5))] for _ in range(400)]
    least = 150
    seen = Counter(g for c in op4_html.streams(pages) for g in set(np.concatenate([x[y] for x, y in [op4_html.beginnings(c, 2)]]).tolist()))
    want = {g for g, n in seen.items() if n >= least}
    names = ["host", "need", "digest", "blocks"]
    batch = pa.RecordBatch.from_arrays([pa.repeat("h", 402), pa.repeat(least / 400, 402), pa.array(range(402)),
                                        pa.array([["cut"], *pages, ["off"]], pa.list_(pa.string()))], names=names).slice(1, 400)
    calls, mix = [], op4_html.mix
    monkeypatch.setattr(op4_html, "mix", lambda x: calls.append(len(x)) or mix(x))

    def found():
        return {g % 2**64 for b in op4_html.grouped(2, False)(iter([batch.slice(0, 0), batch])) for g in b.column(2).to_pylist()}

    assert want and found() == want
    assert len(calls) < 50  # 5 a page before
    monkeypatch.setattr(op4_html, "AT_ONCE", 300)
    assert found() == want and max(calls[-5:]) < 1000


def test_plain_tags_as_the_library_reads_them():
    from html.parser import HTMLParser

    from tidelake.llm import html_blocks

    class Library(html_blocks.Blocks):
        parse_starttag, parse_endtag, updatepos = HTMLParser.parse_starttag, HTMLParser.parse_endtag, HTMLParser.updatepos

    r = random.Random(7)
    tags = sorted(html_blocks.BLOCK | html_blocks.SILENT | html_blocks.VOID | {"a", "b", "span", "xx", "P", "x-y", "Script"})
    other = ["text ", "a&amp;b", "<", "&", "</", "</>", "< p>", "<!-- c -->", "<!x>", "<?pi?>", " \n\x1c", "<p", "</p", "&nbsp;", "</script>"]
    attrs = [" class=ad", " hidden", " role=main", "/", " class", ' id="article-header x"']
    for _ in range(3000):
        html = "".join(r.choice([f"<{r.choice(tags)}{r.choice(attrs) if r.random() < .4 else ''}>", f"</{r.choice(tags)}>", r.choice(other)])
                       for _ in range(r.randint(1, 20)))
        parser = Library()
        parser.feed(html)
        parser.close()
        parser.cut()
        assert blocks_of(html) == parser.found, html


def test_stages_keep_columns_and_run_equals_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, frame, SF), "test")
        assert sorted(after.columns) == sorted(docs.columns), name
        assert after.join(frame, docs.columns, "left_anti").count() == 0  # rows are kept as they were
        frame = after
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, SF)
    order = sorted(map(str, packed.drop("sequence_id", "offset").collect()))
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.drop("sequence_id", "offset").collect())) == order
    assert packed.select("doc_id").distinct().count() == frame.count()


def test_stages_decide(spark):
    base = "the house and the garden of the old town were quiet in the morning when the rain began to fall again".split()
    rows = [(1, " ".join(base), "en"), (2, " ".join(base[:-1]), "en"), (3, " ".join(base), "en"), (4, "123 456 !!", "en"), (5, None, "en"),
            (6, "an other text about the trees and the birds of the wood password=abcdefghijklmnop", "en"),
            (7, "le jardin de la maison et les oiseaux dans la ville avec une belle place pour le marché", "fr"),
            (7, "le jardin de la maison et les oiseaux dans la ville avec une belle place pour le marché", "fr")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language"](spark, docs, SF)
    assert ids(spoken) == [1, 2, 3, 6, 7, 7]
    single = stages["near_duplicates"](spark, spoken, SF)
    assert ids(single) == [1, 6, 7]
    assert ids(stages["secrets"](spark, single, SF)) == [1, 7]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    leak = single.withColumn("text", F.when(F.col("doc_id") == 7, F.concat_ws(" ", "text", F.lit(item))).otherwise(F.col("text")))
    assert ids(stages["decontamination"](spark, leak, SF)) == [1, 6]
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_pipeline_decides_by_row(spark):
    """Clashing columns stay; several texts of one id and rows without id are judged one by one."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    base = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en' and length(text) between 300 and 900").orderBy("doc_id")
    clean = [r["text"] for r in base.limit(6).collect()]
    secret = clean[0] + " password = hunter2hunter2hunter2"
    rows = [(1, clean[1], "a", 1), (1, clean[2], "b", 2), (None, clean[3], "c", 3), (None, secret, "d", 4), (None, clean[4] + " " + bench, "e", 5),
            (5, clean[5], "f", 6), (2, clean[5], "g", 7), (None, clean[5], "h", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _pred string, row int").withColumn("lang", F.lit("en"))
    stages = dict(corpus_pipeline.STAGES)
    keys = lambda df: sorted(r["_pred"] for r in df.collect())
    kept = stages["near_duplicates"](spark, docs, SF)
    assert kept.columns == docs.columns and keys(kept) == ["a", "b", "c", "d", "e", "g"]
    assert keys(stages["secrets"](spark, docs, SF)) == ["a", "b", "c", "e", "f", "g", "h"]
    assert keys(stages["decontamination"](spark, docs, SF)) == ["a", "b", "c", "d", "f", "g", "h"]
    assert set(keys(stages["language"](spark, docs, SF))) <= set("abcdefgh")
    assert stages["language"](spark, docs, SF).columns == docs.columns

"""Operators on web pages."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import time

import pandas as pd
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from recurra.llm import extraction, warc
from recurra.llm.html_tree import parse

PAGES = "page_id bigint, url string, html string, extracted string, host string"


def pages(spark, rows, parts=2):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], PAGES).repartition(parts)


def texts(df):
    return {r["page_id"]: r["extracted"] for r in df.collect()}


@pytest.mark.parametrize("html, text", [
    ("<article><h1>A &amp; B</h1><p>one\n two<br>three <b>four</b>five</article>", "A & B\none two three fourfive"),
    ("<article><p><b>open<br><p>next &lt;p&gt; &#233;</p><div class=ad>no</div>tail</article><p>out", "open\nnext <p> é\ntail"),
    ("<nav>menu</nav><p>x<!-- c --> y</p><script>var t='</p>';</script><form>f</form>", "x y"),
    ("<main><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></main><footer>f", "a\nb\n1\n2"),
    ("<article><p>text</p><section id=comments><article class=comment>hi</article></section></article>", "text"),
    ("<p title=\"a > b\">q</p><p hidden>no</p><p style='display: none'>no</p>", "q"),
    ("plain", "plain"), ("", ""), (None, ""), ("<", "<"), ("<article>", ""), ("a<b", "a<b"), ("<p" * 2000, "<p" * 2000),
    ("<div>" * 3000 + "deep", "deep"), ("</p></div>x", "x"), ("<article><div class=comments>c</div></article>", ""),
    ("<div class='page has-sidebar'><nav>m</nav><p>all</p></div>", "all"), ("<div class=sidebar>s</div><p>x", "x"),
    ("<article><p>a b &nbsp; c</p></article>", "a b c"),
])
def test_text_of_one_page(spark, html, text):
    assert texts(extraction.extract(pages(spark, [(1, "http://h/x", html)]))) == {1: text}


@pytest.mark.parametrize("html, text", [
    ('<article><h2 id="search-trees">A</h2><section id="related-work"><p>B</p></section><div class="ad-hoc-networks">C</div></article>', "A\nB\nC"),
    ('<article><div class="entry-header"><h1 class="title">T</h1></div><p>x</p><div class="share-buttons">no</div><div class="ad">no</div></article>', "T\nx"),
    ('<div class="site-header">no</div><div id="sidebar">no</div><div class="related_posts">no</div><p id="comments-on-life">x</p>', "x"),
    ('<p title="a>one</p>', "one"), ("<p data-x=it's>one</p><p>don't</p>", "one\ndon't"), ("<p a='1' b=\"2\"c=3>t</p><script type=\"a>b\">no</script>u", "t\nu"),
    ("<p a = 'x>y'>t</p><a href=x?a=b&c=\"d\">l</a>", "t\nl"),
])
def test_names_and_quotes(html, text):
    assert extraction.main_text(html, set()) == text


def test_deep_pages_are_read_in_one_pass():
    begun = time.perf_counter()
    parse("<div>" * 100_000 + "x" + "</div>" * 100_000)
    parse("<b>" * 30_000 + "<div></b>" * 30_000)
    parse('<p a="' * 20_000)
    # A walk over all open elements at every tag would take a quarter of an hour.
    assert time.perf_counter() - begun < 30


def test_columns_with_any_name_are_kept(spark):
    schema = "page_id bigint, url string, html string, `page host` string, `site host` string, paths string, `page paths` string, host string, Extracted string"
    docs = spark.createDataFrame([(1, "http://h/", "<p>a", "1", "2", "3", "4", "5", "6")], schema)
    row = extraction.extract(docs).first()
    assert row.asDict() == {"page_id": 1, "url": "http://h/", "html": "<p>a", "page host": "1", "site host": "2", "paths": "3", "page paths": "4", "host": "5", "extracted": "a"}


def plain_importance(rows, damping):
    """The formula on a tree of nested calls."""
    by_path = {r["path"]: r for r in rows}

    def of(path):
        r = by_path[path]
        below = [p for p, other in by_path.items() if other["up"] == path and p != path]
        log_m = math.log(r["m"]) if r["m"] > 1 else 0
        shape = min(1.0, r["shape_entropy"] / log_m) if log_m else 1.0
        parts = [(by_path[p]["m"], of(p)) for p in below]
        if r["texts"]:
            parts.append((r["m"], 1 - r["text_logs"] / r["texts"] / log_m if log_m else 1.0))
        if not parts:
            return shape
        inner = sum(w * v for w, v in parts) / sum(w for w, _ in parts)
        return inner if not below else (1 - damping ** r["shapes"]) * shape + damping ** r["shapes"] * inner

    return {path: of(path) for path in by_path}


def test_branch_importance_is_its_formula():
    random.seed(6)
    for _ in range(20):
        rows = []
        for path in range(1, random.randint(2, 40)):
            m, shapes, texts = random.randint(1, 30), random.randint(1, 5), random.randint(0, 4)
            rows.append({
                "path": path, "up": random.randrange(path), "m": m, "shapes": shapes, "shape_entropy": random.random() * math.log(m) if shapes > 1 else 0.0,
                "texts": texts, "text_logs": sum(math.log(random.randint(1, m)) for _ in range(texts)),
            })
        found = extraction.branch_importance(pd.DataFrame(rows))
        assert found == pytest.approx(plain_importance(rows, extraction.DAMPING))


@pytest.mark.parametrize("html, text", [
    ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', "one two\nthree"),
    ("<article><p>one <math/> two</p><p><math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math></article>", "one two\nx=2"),
    ("<article><p>one <svg><path></p><p>two</p><select><option>no<p>three</article>", "one\ntwo\nthree"),
    ("<article><p>a<iframe></p><p>b</p><div><noscript></div>c<p>d <template><li>no<p>no</template>e</article>", "a\nb\nc\nd e"),
    ("<p>a <noscript><div>no</noscript> b<svg><title>no</title><foreignObject><p>no</foreignObject></svg> c", "a b c"),
    ("<title>no<body><p>x<script>no</p>", "x"),
])
def test_elements_without_text_end_with_their_parent(html, text):
    assert extraction.main_text(html, set()) == text


def small_site(articles, notices=("Cookies are used.",)):
    rows = [
        (i, f"http://small.example/{i}", f"<body><div class=above>{notices[i % len(notices)]}</div><div class=story><p>{a}</p></div><div class=below>Imprint</div></body>")
        for i, a in enumerate(articles)
    ]
    return rows


@pytest.mark.parametrize("articles, notices, texts", [
    # Two pages show a template if they differ elsewhere; what differs between few pages is kept, copies show none.
    (["First story.", "Second story."], ["Cookies are used."], ["First story.", "Second story."]),
    (["First story.", "Second story."], ["Monday", "Tuesday"], ["Monday\nFirst story.", "Tuesday\nSecond story."]),
    (["One story."] * 3, ["Cookies are used."], ["Cookies are used.\nOne story.\nImprint"] * 3),
    (["One story."], ["Cookies are used."], ["Cookies are used.\nOne story.\nImprint"]),
])
def test_templates_of_small_sites(spark, articles, notices, texts):
    pages = spark.createDataFrame(small_site(articles, notices), "page_id bigint, url string, html string")
    found = {r["page_id"]: r["extracted"] for r in extraction.extract(pages).collect()}
    assert found == dict(enumerate(texts))


def test_nodes_of_single_pages_are_only_counted(spark):
    """Names made of titles give every page nodes of its own; the tree that one task gets does not grow with them, and says the same."""
    pages = [("h", f"<body><div class=top>Hello</div><section class='post-{'abcdefghij'[i % 10] * (1 + i // 10)}'><p>Text {i}</p></section></body>") for i in range(40)]
    nodes = extraction.style_nodes(spark.createDataFrame(pages, "host string, data string")).toPandas()
    shared = extraction.shared_nodes(spark.createDataFrame(nodes)).toPandas()
    assert len(nodes) > 80 and len(shared) < 8
    whole, folded = extraction.branch_importance(nodes), extraction.branch_importance(shared)
    assert folded == pytest.approx({p: whole[p] for p in shared["path"]})


def test_template_of_a_site_is_removed(spark):
    def page(i):
        return (
            f"<body><div class=top>Welcome to the site</div><div class=story><p>Story {i} begins.</p><p>It goes on {i * 7}.</p></div>"
            "<div class=bottom>About<br>Contact</div></body>"
        )

    rows = [(i, f"http://site.org/{i}", page(i)) for i in range(20)]
    rows += [(100, "http://other.org/", page(100)), (101, None, page(101)), (102, "nonsense", page(102))]
    found = texts(extraction.extract(pages(spark, rows)))
    assert all(found[i] == f"Story {i} begins.\nIt goes on {i * 7}." for i in range(20))
    # One page alone shows no template.
    assert found[100] == "Welcome to the site\nStory 100 begins.\nIt goes on 700.\nAbout Contact"
    joined = texts(extraction.extract(pages(spark, rows), most_sent=0))
    assert joined == found


def test_repeated_articles_stay(spark):
    html = "<body><article><h1>T</h1><p>Always the same.</p></article></body>"
    rows = [(i, "http://copy.org/", html) for i in range(12)]
    assert set(texts(extraction.extract(pages(spark, rows))).values()) == {"T\nAlways the same."}


def test_extraction_keeps_columns_and_rows(spark):
    rows = [(1, "http://h/", "<p>a"), (1, "http://h/", "<p>a"), (None, None, None)]
    found = extraction.extract(pages(spark, rows))
    assert found.columns == ["page_id", "url", "html", "host", "extracted"] and found.count() == 3
    assert extraction.extract(pages(spark, rows).limit(0)).count() == 0


def test_parser_takes_anything():
    for text in ("<a <a <a", "<!--", "<script>", "<p class='", "<\x00>", "&#xFFFFFFF;", "<p/><br/></br>", "<td><li><dt>"):
        parse(text)


ROWS = [
    (1, "http://a", "same"), (2, "http://b", "same"), (2, "http://b", "same"), (None, None, "same"), (5, None, None), (6, "x\r\ny", ""),
    (1, "http://a", "same"), (9, "é", "other"), (-3, "http://c", "ß" * 3000), (2**60, "http://d", "far"),
]


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, min_bytes):
    first, found = {}, []
    for page_id, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        payload = (html or "").encode()
        if payload in first and len(payload) >= min_bytes:
            found.append((page_id, len(payload), digest(payload), "revisit", first[payload]))
        else:
            first.setdefault(payload, page_id)
            found.append((page_id, len(payload), digest(payload), "response", None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 4, 5])
def test_archives_give_back_what_was_written(spark, tmp_path, min_bytes):
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(pages(spark, ROWS, 3), folder, shard_bytes=8, file_bytes=300, steps=64, min_revisit_bytes=min_bytes)
    found = warc.read_archives(manifest, folder)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == expected(ROWS, min_bytes)
    bodies = {bytes(r["payload"]).decode() for r in found.collect() if r["payload"] is not None}
    assert bodies == {h or "" for _, _, h in ROWS}
    assert not (tmp_path / "w" / "_temporary").exists()
    assert {p.name for p in (tmp_path / "w").glob("*.warc.gz")} == {r["name"] for r in manifest.collect()}


@pytest.mark.parametrize("shards", [2, 5, 64])
def test_one_task_a_shard(spark, tmp_path, shards):
    rows = [(i, f"http://h/{i}", f"page {i:04}") for i in range(shards * 4)]
    manifest = warc.write_archives(pages(spark, rows, 3), f"file://{tmp_path}/w", shard_bytes=36)
    assert len({r["shard"] for r in manifest.collect()}) == shards
    dealt = spark.range(shards).repartitionById(shards, F.col("id").cast("int"))
    assert sorted(map(len, dealt.rdd.glom().collect())) == [1] * shards


def test_ids_far_off_do_not_gather_the_others(spark):
    sizes = [(i, 10) for i in range(1000)] + [(2**60, 10), (-(2**40), 10)] + [(None, 10)] * 50
    shards = warc.shards_of(spark.createDataFrame(sizes, "page_id bigint, n_bytes bigint"), shard_bytes=500, steps=64)
    assert 15 <= shards.count <= 30
    table = spark.createDataFrame([(i, f"d{n}") for n, (i, _) in enumerate(sizes)], "page_id bigint, digest string")
    found = table.select("page_id", shards.of(F.col("page_id"), F.col("digest")).alias("shard")).collect()
    known = sorted((r["page_id"], r["shard"]) for r in found if r["page_id"] is not None)
    assert [s for _, s in known] == sorted(s for _, s in known)
    per_shard = collections.Counter(s for _, s in known)
    assert max(per_shard.values()) <= 120 and set(per_shard) == set(range(shards.count))
    assert len({r["shard"] for r in found if r["page_id"] is None}) > 5


def test_archives_are_the_same_every_time(spark, tmp_path):
    seen = []
    for run, parts in enumerate((1, 5)):
        folder = tmp_path / str(run)
        warc.write_archives(pages(spark, ROWS, parts), f"file://{folder}", shard_bytes=8, file_bytes=300)
        seen.append({p.name: p.read_bytes() for p in folder.glob("*.warc.gz")})
    assert seen[0] == seen[1] and len(seen[0]) > 2


def test_renaming_may_be_repeated_and_damage_is_found(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(pages(spark, ROWS, 2), folder)
    rows = manifest.withColumn("temporary", manifest["name"]).select("shard", "name", "temporary", "records", "bytes", "sha1")
    assert rows.mapInArrow(warc._committed(folder), warc._MANIFEST).count() == manifest.count()
    store, path = fs.FileSystem.from_uri(folder)
    name = f"{path}/{manifest.first()['name']}"
    data = store.open_input_stream(name, compression=None).read()
    with pytest.raises(ValueError):
        for packed in warc.members(store.open_input_stream(name, compression=None)):
            warc.decode(packed.replace(b"same", b"lame").replace(b"other", b"otter"))
    assert data


def test_no_pages_make_no_archive(spark, tmp_path):
    manifest = warc.write_archives(pages(spark, ROWS).limit(0), f"file://{tmp_path}/w")
    assert manifest.count() == 0 and warc.read_archives(manifest, f"file://{tmp_path}/w").count() == 0

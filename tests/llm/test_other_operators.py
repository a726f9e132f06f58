"""Chat, pages, neighbours and the pipeline."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import folded, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegrid.llm import chat, htmltext, neighbours
from tidegrid.session import configure

PIECES = st.lists(st.sampled_from(["\\", "\\e", "\\a", "</s>", "<s>", "[TURN]", "[/TURN]", "[INST]", "\n", "é", "x", "\\\\b", "<", "["]), max_size=8).map("".join)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.sampled_from(["user", "assistant", "system", "a\nb[/TURN]"]), PIECES), max_size=40))
def test_chat_round_trip(spark, rows):
    configure(spark)
    rows = [*rows, (9, 0, None, None), (9, None, "user", "</s>"), (None, 1, "assistant", "x"), (9, 0, None, None)]
    turns = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "conv_id long, turn long, role string, text string, turns string, segments string")
    formatted = chat.format_conversations(turns)
    expected = defaultdict(list)
    for conv, turn, role, text in rows:
        expected[conv].append((turn is not None, turn or 0, role or "", text or ""))
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    assert set(got) == set(expected)
    for conv, own in expected.items():
        own.sort()
        assert [(t.role, t.text) for t in got[conv].turns] == [o[2:] for o in own]
        assert got[conv].loss_text == "".join(o[3] for o in own if o[2] == "assistant")
    for r in formatted.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count("</s>") == r.n_turns and r.formatted.count("<s>") == 1
        assert r.formatted.count("[TURN]") == r.formatted.count("[/TURN]") == r.n_turns


def test_chat_order_and_empty(spark):
    configure(spark)
    orders = {1: "ua", 2: "sua", 3: "a", 4: "uu", 5: "uaua", 6: "u", 7: "us", 8: "uata", 9: "ux"}
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool", "x": None}
    rows = [(c, i, names[x], "t") for c, o in orders.items() for i, x in enumerate(o)]
    schema = "conv_id long, turn long, role string, text string"
    got = {r.conv_id for r in chat.format_conversations(spark.createDataFrame(rows, schema)).filter("valid").collect()}
    assert got == {1, 2, 5, 8}
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(end="\\end").controls()


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("a &amp; b &lt;c&gt;", "a & b <c>"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>one</div><div>two</div>three", "one\ntwo\nthree"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<b>bo</b>ld <i> it</i>al", "bold ital"), ("<ul><li>x<li>y</ul>", "- x\n- y"), ("<ol start=9><li>x<li value=20>y<li>z</ol>", "9. x\n20. y\n21. z"),
    ("<ul><li>x<ol><li>p<li>q</ol><li>y</ul>", "- x\n  1. p\n  2. q\n- y"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<table><tr><td>a<td>bbb<tr><td>cc<td>d</table>", "a   bbb\ncc  d"), ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td colspan=2>wide one<td>x<tr><td>1<td>2<td>3</table>", "wide one  x\n1  2  3"),
    ("<table><caption>cap</caption><tr><td><table><tr><td>in<td>ner</table></table>", "cap\nin ner"),
    ("<p hidden>no</p><p style='color:red; display : none'>no</p><p style='display:nonesuch'>yes", "yes"),
    ("<div style='visibility:hidden'>no <b style='visibility:visible'>yes</b></div>", "yes"),
    ("<script>'<p>no</p>'</script><style>p{}</style><template>no</template><noscript>no</noscript>yes<!-- no -->", "yes"),
    ("<head><title>no</title></head>yes", "yes"), ("<title>no</title>yes", "yes"), ("<details><summary>s</summary>no</details><details open><summary>t</summary>u</details>", "s\nt\nu"),
    ("<pre>\n a\n  b </pre>c", " a\n  b\n\nc"), ("x</p>y", "x\n\ny"), ("<td>loose</td> text", "loose text"), ("<select><option>a<option>b</select>", "a\nb"),
    ("<p>a<table><tr><td>b</table>c", "a\n\nb\n\nc"), ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"), ("<div><p>a</div>b", "a\n\nb"),
    ("<table><tr><td>a</div><td>b</table>", "a  b"), ("<br/>a<hr/>b<p/>c", "\na\n\nb\n\nc"),
])
def test_page_text(html, text):
    assert htmltext.page_text(html) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <table> <tr> <td> </table> <ul> <li> </ul> <div> </div> <b> </b> <pre> </pre> word & &lt; <! <? <br> </br> </td> <![x]]> <select> <option>".split()), max_size=30))
def test_every_word_comes_out(parts):
    """Nothing is hidden here, so every word is in the text, in any markup."""
    text = htmltext.page_text(" ".join(f"{p} w{i} " for i, p in enumerate(parts) if not p.startswith(("<!", "<?"))))
    want = [f"w{i}" for i, p in enumerate(parts) if not p.startswith(("<!", "<?"))]
    assert sorted(w for w in text.split() if w.startswith("w") and w[1:].isdigit()) == sorted(want)
    htmltext.page_text(" ".join(parts))


def test_pages(spark):
    configure(spark)
    deep = "<div>" * 20_000 + "deep" + "<table><tr><td>" * 500 + "in"
    rows = [(1, "<p>a", "c"), (1, "<p>a", "c"), (None, None, "c"), (2, "", "c"), (3, deep, "c"), (4, "<p>" + "word " * 200_000, "c")]
    got = Counter((r.page_id, r.text) for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect())
    assert got == Counter([(1, "a"), (1, "a"), (None, ""), (2, ""), (3, "deep\n\nin"), (4, ("word " * 200_000).strip())])
    assert htmltext.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


def vectors(spark, rows):
    configure(spark)
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, vector string, r int")


def test_multi_index_finds_the_whole_radius():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 1 << 16, (3000, 4), dtype=np.uint16)
    codes[1000:2000] = codes[0] ^ (rng.random((1000, 4)) < 0.5).astype(np.uint16)
    index = neighbours.MultiIndex(codes)
    for radius in (0, 1, 3, 4, 7, 12, 20, 30, 64):
        distance = np.bitwise_count(codes ^ codes[5]).sum(axis=1)
        assert index.within(codes[5], radius).tolist() == np.flatnonzero(distance <= radius).tolist()


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 700)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 30)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 32)).astype(np.float32)
    x[500:600] = x[500]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(4000, None), (4020, [0.0] * 32), (4040, [1.0] * 31 + [None]), (4060, [float("nan")] * 32), (4080, [float("inf")] + [1.0] * 31), (4100, [1.0] * 31), (None, x[0].tolist())]
    got = defaultdict(list)
    for r in neighbours.nearest(vectors(spark, rows + odd)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    wide, hits = x.astype(np.float64), 0
    assert sorted(got) == list(range(0, 2000, 20))
    for q, found in got.items():
        scores = (wide * wide[q]).sum(axis=1)
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        assert all(s == pytest.approx(scores[v], rel=1e-12) for _, v, s in found)
        scores[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(2000), -scores))[:20].tolist()) & {v for _, v, _ in found})
    assert hits >= 0.95 * 2000
    assert [v for _, v, _ in got[520]][:20] == list(range(500, 520))  # ties go to smaller ids


def test_neighbours_small(spark):
    assert neighbours.nearest(vectors(spark, [])).count() == 0
    assert neighbours.nearest(vectors(spark, [(1, [1.0, 2.0]), (3, [1.0, 0.0])])).count() == 0
    got = neighbours.nearest(vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 5.0])])).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, 10.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0)]


def test_neighbours_of_repeated_queries(spark):
    """A query row listed again changes nothing for the query; several vectors of one id give each row once, with its best score."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    once = neighbours.nearest(vectors(spark, rows)).filter("query_id IN (0, 20)").orderBy("query_id", "rank").collect()
    again = neighbours.nearest(vectors(spark, rows + [rows[0]] + [rows[20]] * 2)).filter("query_id IN (0, 20)").orderBy("query_id", "rank").collect()
    by = lambda found, q: [tuple(r) for r in found if r.query_id == q]
    # the repeats of one query's row are candidates of the other query each
    drop = lambda found, other: [r[2] for r in found if r[2] != other]
    for q, other in ((0, 20), (20, 0)):
        a, b = drop(by(once, q), other), drop(by(again, q), other)
        assert len(by(again, q)) == 20 and len(set(b)) == len(b) >= 17 and b == a[: len(b)]
    two = [(0, (-x[0]).tolist())]
    got = [tuple(r) for r in neighbours.nearest(vectors(spark, rows + two)).filter("query_id = 0").orderBy("rank").collect()]
    scores = np.abs(x @ x[0])
    scores[0] = -np.inf
    best = np.argsort(-scores)[:20]
    assert len({r[2] for r in got}) == len(got) == 20
    assert len({r[2] for r in got} & set(best.tolist())) >= 18
    assert all(r[3] == pytest.approx(scores[r[2]]) for r in got if r[2] in set(best.tolist()))


def test_pipeline_against_brute_force(spark, corpus):
    """Every stage's decisions on its own input, from plain definitions."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    import tokenizers
    from test_text_operators import PATH, brute_components

    from tidegrid.llm.scratch import stored

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10_000, None, None, None, 0), (10_001, "12 - 34", "en", "src0", 7), (10_002, "", "en", None, 0)], docs.schema)
    docs = stored(docs.unionByName(odd).withColumn("clash", F.lit(1)), "test-docs")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminated", "mixed", "token_files"]
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
        docs = stored(stage(spark, docs, sf), "test-stage")
        if name != "token_files":
            assert docs.columns == corpus_pipeline.COLUMNS
    final = docs.collect()

    kept = {k: Counter(r[0] for r in v) for k, v in inputs.items()}
    lettered = Counter(r[0] for r in inputs["language"] if any(map(str.isalpha, r[1] or "")))
    assert kept["near_duplicates"] == lettered
    components = brute_components(inputs["near_duplicates"], 5, 80)
    assert kept["decontaminated"] == Counter(i for i, _, c in components.elements() if i == c)
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(t))
    runs = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = split(r.text)
        runs |= {tuple(w[i : i + 10]) for i in range(len(w) - min(10, len(w)) + 1 if w else 0)}
    sizes = {len(x) for x in runs}
    dirty = lambda t: any(tuple(w[i : i + n]) in runs for w in [split(t)] for n in sizes for i in range(len(w) - n + 1))
    assert kept["mixed"] == Counter(r[0] for r in inputs["decontaminated"] if not dirty(r[1]))
    mixed = kept["token_files"]
    assert set(mixed) <= set(kept["mixed"]) and set(mixed.values()) <= {1, 2}
    total = sum(len(words(r[1])) for r in inputs["mixed"])
    assert sum(len(words(r[1])) for r in inputs["token_files"]) == pytest.approx(1.5 * total, rel=0.15)
    library, start = tokenizers.Tokenizer.from_file(PATH), 0
    texts = {r[0]: r[1] for r in inputs["token_files"]}
    assert Counter(r.doc_id for r in final) == mixed
    for r in sorted(final, key=lambda r: r.start):
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pipeline_labels_by_the_model(spark, corpus):
    """Documents without a label get the model's; labels that are there, and the documents, stay."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*corpus_pipeline.COLUMNS)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    bare = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    odd = spark.createDataFrame([(10_000, None, None, None, 0), (10_001, "12", None, "s", 2), (10_002, "", "en", None, 0)], docs.schema)
    got = corpus_pipeline.language(spark, bare.unionByName(odd), "").collect()
    assert sorted(r.doc_id for r in got) == sorted(truth)
    assert all(r.lang == truth[r.doc_id] for r in got if r.doc_id % 3)
    filled = [r.lang == truth[r.doc_id] for r in got if r.doc_id % 3 == 0]
    assert len(filled) > 10 and sum(filled) >= 0.9 * len(filled)
    nothing = docs.filter("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name != "decontaminated":
            assert stage(spark, nothing, "").count() == 0, name


def test_queries_of_the_contract(spark):
    """The thin queries carry the digests that the operators' outputs give."""
    import __spark_entry__ as entry

    sf, queries = "/root/testdata/sf0.001", entry.queries()
    names = [n for n in queries if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries
    chats = {r.conv_id: r for r in queries["op8_chat_format"](spark, sf).collect()}
    said = "</s>[INST] ok [/INST]"
    assert (chats[-7].n_turns, chats[-7].loss_chars) == (2, len(said))
    assert chats[-7].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert chats[-7].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    pages = {r.page_id: r.text for r in queries["op4_html_text"](spark, sf).collect()}
    html = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert pages == {i: htmltext.page_text(h) for i, h in html.items()}


def test_mixed_meets_every_target(corpus):
    """A tiny source, a hot one and long documents: whole documents, but each source's words as the mix wants them."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from tidegrid.llm import mixture

    rng = np.random.default_rng(3)
    rows = [(10_000, "w " * 300, "en", "tiny")]
    for i in range(3000):
        size = int(rng.integers(1500, 4000)) if i % 40 == 0 else int(rng.integers(1, 400))
        rows.append((i, f"d{i} " * size, "en", "hot" if i % 3 == 0 else f"s{i % 4}"))
    rows += [(None, "same words here", "en", "s1")] * 5 + [(20_000, " ", "en", "s2")]
    docs = corpus(rows, extra=False).withColumn("n_chars", F.length("text"))
    target = {r.source: r.target for r in mixture.mix(docs.select("doc_id", "source", "text")).collect()}
    got = corpus_pipeline.mixed(docs.sparkSession, docs, "").collect()
    taken, times, given = defaultdict(int), Counter((r.doc_id, r.text) for r in got), Counter(r[:2] for r in rows)
    for r in got:
        taken[r.source] += len(words(r.text))
    assert all(n <= 2 * given[k] for k, n in times.items()) and times[20_000, " "] == 1
    for source, want in target.items():
        assert taken[source] == pytest.approx(want, rel=0.005), source
    assert Counter(map(tuple, corpus_pipeline.mixed(docs.sparkSession, docs.repartition(7), "").collect())) == Counter(map(tuple, got))


def test_stages_decide_by_row(corpus):
    """A rejected document takes no other one of its id along, null ids included; equal rows of a group leave one."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    rng, names = np.random.default_rng(8), [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    texts = [" ".join(rng.choice(names, 60)) for _ in range(6)]
    near = texts[0] + " more"
    spark = corpus([]).sparkSession
    passage = spark.read.parquet(f"{sf}/benchmark.parquet").filter(F.length("text") > 300).first().text

    def run(stage, rows):
        docs = corpus([(i, t, "en", "a") for i, t in rows], extra=False).withColumn("n_chars", F.length("text"))
        return Counter((r.doc_id, r.text) for r in stage(spark, docs, sf).collect())

    rows = [(None, "12 - 34"), (None, texts[0]), (7, "12"), (7, texts[1])]
    learned = [(i, texts[i % 6]) for i in range(100, 112)]
    assert run(corpus_pipeline.language, rows + learned) == Counter([(None, texts[0]), (7, texts[1]), *learned])
    rows = [(None, passage), (None, texts[0]), (7, passage), (7, texts[1])]
    assert run(corpus_pipeline.decontaminated, rows) == Counter([(None, texts[0]), (7, texts[1])])
    rows = [(None, near), (None, texts[1]), (3, texts[0]), (5, near), (5, texts[2]), (9, texts[3]), (9, texts[3])]
    rows += [(None, texts[4]), (None, texts[4]), (2, texts[5]), (2, texts[5]), (4, texts[5] + " more"), (8, ""), (8, "")]
    assert run(corpus_pipeline.near_duplicates, rows) == Counter(
        [(None, texts[1]), (3, texts[0]), (5, texts[2]), (9, texts[3]), (None, texts[4]), (2, texts[5]), (8, ""), (8, "")])
    rows = [(6, texts[0]), (6, near), (1, texts[1])]
    kept = run(corpus_pipeline.near_duplicates, rows)
    assert len(kept) == 2 and (1, texts[1]) in kept

"""Toxicity, HTML layout, quotation links and the pipeline."""
import re
from collections import defaultdict
from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from benefitlens.llm import html_layout, quotes, toxicity
from benefitlens.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF0001, SF001


# -- toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    return docs, labels


def test_op3_finds_the_labelled(spark, labelled):
    docs, labels = labelled
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity_chain"](spark, SF001).collect()}
    assert set(got) == set(docs)
    assert all(0 <= r["p_toxic"] <= 1 for r in got.values())
    assert min(r["p_toxic"] for r in got.values() if r["toxic"]) > max(r["p_toxic"] for r in got.values() if not r["toxic"])
    toxic = [got[k]["toxic"] for k, r in labels.items() if r["toxic"] and k in got]
    clean = [got[k]["toxic"] for k, r in labels.items() if not r["toxic"] and k in got]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_chain_on_held_out_rows(spark):
    words = [f"plain{i}" for i in range(60)]
    rows = []
    for i in range(600):
        text = " ".join(words[(i * 7 + j * j) % 60] for j in range(30))
        rude, threat = i % 4 == 0, i % 8 == 0
        text += " scoundrel" * rude + " thrashing" * threat
        rows.append((i, text, int(rude), int(threat)))
    table = spark.createDataFrame(rows, "doc_id long, text string, rude int, threat int")
    train, rest = table.filter("doc_id < 400"), table.filter("doc_id >= 400")
    chain = toxicity.fit_chain(train.select("doc_id", "text"), train.select("doc_id", "rude", "threat"), {"rude": "rude", "threat": "threat"})
    assert len(chain.models[1][1]) == len(chain.models[0][1]) + 1  # the second model also reads the first's probability
    for name in ("rude", "threat"):
        hit, false, missed = chain.held_out[name]
        assert hit > 0 and false == missed == 0
    for r in toxicity.score(rest.select("doc_id", "text"), chain).join(rest, "doc_id").collect():
        assert (r["p_rude"] >= chain.thresholds["rude"], r["p_threat"] >= chain.thresholds["threat"]) == (bool(r["rude"]), bool(r["threat"]))


def test_features_are_counted_over_the_whole_sample(spark):
    rows = [(i, f"only zebra{i}" + (" quagga" if i % 10 < 2 else " and rare" if i == 5 or i == 15 else ""), int(i % 10 < 2)) for i in range(40)]
    sample = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "doc_id long, text string, toxic int")
    chosen = toxicity._choose(sample, ["toxic"])
    assert "=quagga" in chosen and "=only" in chosen
    assert "=rare" not in chosen


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "x y", 1), (3, "bad " * 9000, 1), (3, "bad " * 9000, 1)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, 0, None), (2, None, 1), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxic_documents(docs, labels).collect()
    assert len(rows) == 5 and not any(r["toxic"] for r in rows)
    assert toxicity.toxic_documents(docs.limit(0), labels).count() == 0
    one = spark.createDataFrame([(3, 0, 1)], "doc_id long, quality int, toxic int")
    assert all(r["toxic"] for r in toxicity.toxic_documents(docs, one).collect())


# -- HTML


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a<p>b <b>c</b>d<br>e", "a\n\nb cd\ne"),
        ("<div>a</div><div>b</div>c", "a\nb\nc"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=9><li>a<li>b<p>c</ol>", "9. a\n10. b\n\n    c"),
        ("<table><tr><th>name<th>n<tr><td>alpha<td>1<tr><td>b</td><td>22</td></table>", "name   n\nalpha  1\nb      22"),
        ("<table><tr><td colspan=2>wide cell<td>x<tr><td>a<td>b<td>c</table>", "wide cell  x\na  b  c"),
        ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
        ("<head><title>t</title><style>a{}</style></head><body>x<script>var t='</p>';</script>y", "xy"),
        ("a<span hidden>b</span><i style='color:red; Display : none'>c</i><p hidden>d</p>e", "ae"),
        ("<pre>\n a\n\tb</pre>", " a\n        b"),
        ("a &amp; b &lt;i&gt; &copy; &nbsp;c 1 < 2", "a & b <i> © \xa0c 1 < 2"),
        ("<!-- x --><!doctype html>a<!-- b <p> -->c", "ac"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
        ("a<a href='x>y' title=\"b>\">link</a>", "alink"),
        ("<img alt='pic'> <input type=hidden value=v>z", "pic z"),
        ("</div>stray</p>x", "stray\n\nx"),
        ("<td>x</table>y", "xy"),
    ],
)
def test_layout(page, text):
    assert html_layout.visible_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<table><thead><th>Name</th><th>n</th></thead><tbody><tr><td>a</td><td>1</td></tr></table>", "Name  n\na     1"),
        ("<table><tbody><td>a<td>b<tr><td>cc<td>d</table>", "a   b\ncc  d"),
        ("<table><td>a<td>b</table>c", "a  b\n\nc"),
        ("<table><tbody><form><tr><td>a</td><td>b</td></tr><tr><form><td>cc</td><td>d</td></form></tr></form></tbody></table>", "a   b\ncc  d"),
        ("<table><tbody>bare <b>text</b><tr><td>a</td></tr></tbody><tfoot>foot</tfoot></table>", "bare text\nfoot\na"),
        ("<table><tbody><div>x<tr><td>a</table>", "x\na"),
        ("<table><tbody hidden><td>a</tbody><tbody><tr><td><table><tbody><td>b<td>c</table><td>d</table>", "b  c  d"),
        ("<table><template><td>a</template><caption>cap<tr><td>b</table>", "cap\nb"),
    ],
)
def test_table_sections(page, text):
    assert html_layout.visible_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<head><title>t</title>Hello <b>x</b><br>bye", "Hello x\nbye"),
        ("<html><head><meta charset=utf-8>\n<title>t</title>\n<a href=x>link</a> more<p>block", "link more\n\nblock"),
        ("<head><title>t</title><img alt=pic><span>s</span><font>f</font>", "pics" + "f"),
        ("<head><title>t</title><br>a", "a"),
        ("<head><noscript><img alt=no><p>no</noscript><template><div>no</div>no</template><style>no</style> <!-- no --></head>yes", "yes"),
        ("<head><head><title>t</title></head>a", "a"),
        ("<head><noscript><link rel=x><body>a", "a"),
    ],
)
def test_open_heads(page, text):
    assert html_layout.visible_text(page) == text


class Visible(HTMLParser):
    """The words that a plain parser finds outside of what is never shown."""

    def __init__(self):
        super().__init__()
        self.off, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("head", "script", "style")
        self.out.append(" ")

    def handle_endtag(self, tag):
        self.off -= tag in ("head", "script", "style")
        self.out.append(" ")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


def test_op8_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in QUERIES["op8_html_layout"](spark, SF0001).collect()}
    assert set(got) == set(pages)
    for k, page in pages.items():
        parser = Visible()
        parser.feed(page or "")
        shown = re.sub("(?m)^ *- ", "", got[k])
        assert "".join(shown.split()) == "".join("".join(parser.out).split())


def test_html_odd_rows(spark):
    deep = "<ul><li>" * 3000 + "x"
    pages = spark.createDataFrame([(1, None, "u"), (None, "<p>a", "u"), (2, "", "u"), (3, deep, "u"), (3, deep, "u"), (4, "<a href=\"b>" * 5000, "u"), (5, "<table><tr><td>" * 2000 + "y", "u")], "page_id long, html string, text string")
    rows = html_layout.extract(pages).collect()
    assert len(rows) == 7
    assert {r["page_id"]: r["text"] for r in rows if r["page_id"] in (None, 1, 2)} == {None: "a", 1: "", 2: ""}
    assert all(r["text"].strip().endswith(("x", "y")) for r in rows if r["page_id"] in (3, 5))
    assert html_layout.extract(pages.limit(0)).count() == 0


# -- quotations


MESSAGES = [
    (1, 0, "user", "Hello there.\n\nHow  are you?"),
    (1, 1, "assistant", "> hello THERE.\n>\n> How are you?\n\nFine."),
    (1, 2, "user", "On Monday, A wrote:\n> Fine.\n>> How are you?\nGood to hear"),
    (1, 3, "assistant", "no quotation"),
    (1, 4, "user", ">> Fine.\n> Good to hear\nand again"),
    (1, 5, "user", "> nobody said this\nso?"),
    (1, 6, "user", "> and again"),
    (2, 0, "user", "Fine."),
    (2, 1, "user", "> no QUOTATION\n> Fine."),
    (2, 2, "user", None),
    (2, 3, "user", ""),
    (3, 0, "user", "same"),
    (3, 0, "user", "same"),
    (3, 1, "user", " > same\r\n> > deeper\r\n>>> deepest\nx"),
    (3, 2, "user", "> x"),
    (None, 0, "user", "> lost"),
    (4, None, "user", "> lost"),
    (5, 0, "user", ">" * 40 + " very deep\n1 > 0\n" + "line\n" * 3000),
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(*m, 1, "x") for m in MESSAGES], "conv_id long, turn long, role string, text string, level int, hash string")


def run_oracle(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}')")
    r = con.execute(ORACLE_SQL["op10_quotation_links"])
    return [d[0] for d in r.description], r.fetchall()


def test_op10_against_sql(spark):
    columns, rows = run_oracle(f"{SF0001}/conversations.parquet")
    got = QUERIES["op10_quotation_links"](spark, SF0001)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(rows)


def test_quotations_are_linked(messages):
    got = defaultdict(list)
    for r in quotes.link_quotations(messages).collect():
        got[(r["conv_id"], r["turn"])].append(r)
    replies = {k: v[0]["reply_to"] for k, v in got.items() if v[0]["reply_to"] is not None}
    assert replies == {(1, 1): 0, (1, 2): 1, (1, 4): 2, (1, 6): 4, (2, 1): 0, (3, 1): 0, (3, 2): 1}
    assert [(got[(1, t)][0]["thread"], got[(1, t)][0]["depth"]) for t in range(7)] == [(0, 0), (0, 1), (0, 2), (3, 0), (0, 3), (5, 0), (0, 4)]
    texts = {k: v[0]["text"] for k, v in got.items()}
    assert texts[(1, 1)] == "Fine." and texts[(1, 2)] == "Good to hear" and texts[(1, 4)] == "and again" and texts[(1, 6)] == ""
    assert texts[(2, 2)] == texts[(2, 3)] == "" and texts[(3, 1)] == "x"
    assert texts[(1, 0)] == "Hello there.\n\nHow  are you?"
    order = sorted((r["position"], r["conv_id"], r["turn"]) for v in got.values() for r in v if r["conv_id"] == 1)
    assert [t for _, _, t in order] == [0, 1, 2, 4, 6, 3, 5]
    assert sorted(r["position"] for v in got.values() for r in v) == list(range(1, len(MESSAGES) + 1))


def test_planted_quotations_against_sql(spark, messages, tmp_path):
    path = str(tmp_path / "m")
    messages.coalesce(1).write.parquet(path)
    columns, rows = run_oracle(f"{path}/*.parquet")
    got = quotes.link_quotations(messages).select(columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    assert quotes.link_quotations(messages.limit(0)).count() == 0


def test_long_and_deep_quotations(spark, tmp_path):
    long_ = "\n".join(f"line {i}" + ("\n" if i % 97 == 0 else "") for i in range(100_000))
    blanks = "a" + " " * 200_000 + "\n> line 5\nb"
    rows = [
        (1, 0, "user", long_), (1, 1, "bot", "\n".join(f"> {x}" for x in long_.split("\n")) + "\nmine"),
        (1, 2, "user", "> > line 3\n" + ">" * 5000 + " line 4\n" + "> " * 4999 + ">line 5\nend"), (1, 3, "bot", blanks),
        (2, 0, "user", "one\u2028> not a line\x85> nor this"), (2, 1, "bot", "> one\u2028> not a line\x85> nor this"),
    ]
    path = str(tmp_path / "m")
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages.write.parquet(path)
    columns, expected = run_oracle(f"{path}/*.parquet")
    got = sorted(map(tuple, quotes.link_quotations(messages).select(columns).collect()))
    assert got == sorted(expected)
    at = {c: i for i, c in enumerate(columns)}
    assert {(r[at["conv_id"]], r[at["turn"]]): r[at["reply_to"]] for r in got} == {(1, 0): None, (1, 1): 0, (1, 2): 0, (1, 3): 0, (2, 0): None, (2, 1): 0}


def test_quotations_planted_in_conversations(spark, tmp_path):
    """Every message of the table quotes an earlier one, some of them at two levels."""
    table = spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = sorted(map(tuple, table.collect()))
    said = defaultdict(dict)
    planted = []
    for conv, turn, role, text in rows:
        earlier = said[conv]
        quote = ""
        if earlier and (conv + turn) % 5:
            pick = sorted(earlier)[(conv * 7 + turn) % len(earlier)]
            quote = "".join(f"> {x}\n" for x in earlier[pick].split("\n"))
            if (conv + turn) % 3 == 0:
                quote = f"On some day someone wrote:\n>> {earlier[min(earlier)].split(chr(10))[0]}\n" + quote
        said[conv][turn] = text or ""
        planted.append((conv, turn, role, quote + (text or "")))
    path = str(tmp_path / "m")
    messages = spark.createDataFrame(planted, "conv_id long, turn long, role string, text string")
    messages.write.parquet(path)
    columns, expected = run_oracle(f"{path}/*.parquet")
    got = quotes.link_quotations(messages).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert sum(r["reply_to"] is not None for r in got) > len(planted) / 3 and max(r["depth"] for r in got) > 1


# -- pipeline


def test_pipeline_stages(spark):
    from tests.llm.test_dedup import brute_components, brute_copies

    docs = corpus_pipeline.table(spark, SF0001, "documents")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF0001}/labels.parquet").collect()}
    names = docs.columns
    left = corpus_pipeline.written(corpus_pipeline.reject_toxic(spark, docs, SF0001), "t")
    assert left.columns == names
    before, after = ({r["doc_id"] for r in d.collect()} for d in (docs, left))
    assert after < before
    assert not [k for k in before - after if labels.get(k) == 0]

    single = corpus_pipeline.written(corpus_pipeline.drop_exact_copies(spark, left, SF0001), "t")
    assert single.columns == names
    rows = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(k for k, _ in brute_copies(rows).values())

    apart = corpus_pipeline.written(corpus_pipeline.drop_near_copies(spark, single, SF0001), "t")
    assert apart.columns == names
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted(d for d, _, c in brute_components(rows) if d == c)

    packed = corpus_pipeline.pack_sequences(spark, apart, SF0001).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in apart.collect()}


def test_pipeline_decides_rows_not_ids(spark):
    """Null and shared ids: each row stands or falls by itself."""
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    docs = corpus_pipeline.table(spark, SF0001, "documents")
    chain = toxicity.fit_chain(docs, labels, toxicity.CATEGORIES)
    shared = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.lit(7))).withColumn("stay_id", F.lit(1))
    p = {r["text"]: r["p_toxic"] for r in toxicity.score(docs, chain).join(docs, "doc_id").collect()}
    left = [r["text"] for r in toxicity.below(shared, chain, "toxic").collect()]
    assert sorted(map(str, left)) == sorted(str(r["text"]) for r in docs.collect() if p[r["text"]] < chain.thresholds["toxic"])
    assert len(left) < docs.count()

    words = [f"w{i}" for i in range(60)]
    near = " ".join(words)
    rows = [
        (None, "a b", 0), (None, "ab", 1), (None, "c", 2), (7, "c", 3), (7, "d  d", 4), (7, "d d", 5), (7, "d  d", 6), (7, None, 7), (7, "", 8), (7, None, 9),
        (None, near, 10), (None, near + " more", 11), (8, near + " last", 12), (9, "quite another text of more words than five", 13), (9, "and this one is again another than the others", 14),
    ]
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, row long, stay_id double, digest string")
    single = corpus_pipeline.drop_exact_copies(spark, docs, SF0001)
    assert single.columns == docs.columns
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in single.collect())
    assert kept == sorted([(0, "a b"), (7, "c"), (7, "d  d"), (7, ""), (0, near), (0, near + " more"), (8, near + " last"), rows[13][:2], rows[14][:2]])
    apart = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.written(single, "t"), SF0001)
    assert apart.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in apart.collect()) == sorted(k for k in kept if k not in [(0, near), (0, near + " more")])
    again = corpus_pipeline.drop_near_copies(spark, docs, SF0001).filter("row >= 10")
    assert sorted(r["row"] for r in again.collect()) == [12, 13, 14]
    empty = docs.limit(0)
    assert corpus_pipeline.drop_exact_copies(spark, empty, SF0001).count() == corpus_pipeline.drop_near_copies(spark, empty, SF0001).count() == 0


def test_pipeline_runs(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "best-fit packing"]
    assert corpus_pipeline.run(spark, SF0001).count() > 0

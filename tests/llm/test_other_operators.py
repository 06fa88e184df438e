"""Pages, vectors, chats, the registered queries and the pipeline."""

import math
import random
import re
import time

import duckdb
import numpy as np
from pyspark.sql import functions as F

from crivo.llm import queries, quotes, url_rules, vectors
from crivo.llm.common import table


def test_url_rules_and_aliases(spark):
    page = "<html><head><link rel='canonical' href='{}'></head>".format
    jump = '<meta http-equiv="refresh" content="0; url={}">'.format
    rows = [
        (1, "http://A.example.com/de/x", page("https://other.net/x")),
        (2, "https://other.net/x#top", "<p>"),
        (3, "http://far.net/y?a=1", jump("//other.net/x")),
        (4, "http://b.org/z", page("http://other.net/x")),
        (5, "http://plain.net/de/", None),
        (6, None, page("http://other.net/x")),
        (7, "no scheme", "<p>"),
        (8, "http://m.example.org/en/1?q", "<p>"),
        (9, "http://m.example.org/en/2", "<p>"),
        (10, "http://notexample.com/fr/", "<p>"),
        (11, "http://lone.net/a", page("/b")),
        (12, "http://lone.net/b", page("http://x.com/de/")),
        (13, "http://org", "canonical"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judged_pages(pages, queries.RULES).collect()}
    # b.org is allowed by a rule and shares a component with a blocked page:
    # aliases without a rule go with the allow.
    assert got[1] == ("a.example.com", "/de/x", "com/de/", "block")
    assert got[4] == ("b.org", "/z", "org/", "allow")
    assert [got[i][3] for i in (2, 3)] == ["allow", "allow"]
    assert got[5] == ("plain.net", "/de/", None, "allow")
    assert got[6] == got[7] == ("", "", None, "allow")
    assert got[8][2:] == ("example.org/en/1", "block") and got[9][2:] == ("org/", "allow")
    assert got[10][2:] == ("com/fr/", "allow") and got[13] == ("org", "", None, "allow")
    assert [got[i][3] for i in (11, 12)] == ["block", "block"]
    more = spark.createDataFrame([("http://plain.net/de/", "http://c.com/de/")], "source string, target string")
    judged = url_rules.judged_pages(pages, queries.RULES, html=None, redirects=more)
    assert judged.where("page_id = 5").first().verdict == "block"
    assert url_rules.judged_pages(pages.limit(0), queries.RULES).isEmpty()
    assert url_rules.judged_pages(pages, []).where("verdict = 'block'").isEmpty()


def test_relative_links_and_quoted_refresh(spark):
    link = "<link rel=canonical href='{}'>".format
    jump = "<meta http-equiv=refresh content={}>".format
    wanted = {
        ("http://a.b/x/y?q=1", link("index.html")): "a.b/x/index.html",
        ("http://a.b/x/y/", link("../de/x?id=2#top")): "a.b/x/de/x?id=2",
        ("http://a.b/x/y", link("../../../z")): "a.b/z",
        ("http://a.b/x/y?q=1", link("?id=1")): "a.b/x/y?id=1",
        ("http://a.b?q", link("c/./d/..")): "a.b/c/",
        ("http://a.b/x/y", link("/u/../v")): "a.b/v",
        ("http://a.b/x", link("c?to=http://d.e/f")): "a.b/c?to=http://d.e/f",
        ("http://a.b/x", link("mailto:c@d.e")): None,
        ("http://a.b/x/y", link("#top")): "a.b/x/y",
        ("no scheme", link("c")): None,
        ("http://x.y/", jump("\"0;url='http://a.b/c'\"")): "a.b/c",
        ("http://x.y/", jump("'0; URL=\"/c d\"'")): "x.y/c",
        ("http://x.y/e/f", jump("'0; url=g'")): "x.y/e/g",
    }
    given = spark.createDataFrame(list(wanted), "url string, html string")
    found = F.transform(url_rules.page_links(F.col("url"), F.col("html")), url_rules.page_key)
    got = {(r.url, r.html): r.found for r in given.select("*", found.alias("found")).collect()}
    assert got == {k: [v] if v else [] for k, v in wanted.items()}
    rows = [(1, "http://m.com/x/a", link("../de/a")), (2, "http://m.com/x/b", link("a"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.verdict for r in url_rules.judged_pages(pages, queries.RULES).collect()} == {"block"}


def brute(ids, labels, matrix, cosine):
    near = {i: set() for i in ids}
    for i, a in enumerate(matrix):
        for j, b in enumerate(matrix[:i]):
            usable = all(
                v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in (a, b)
            )
            if usable and labels[i] is not None and labels[i] == labels[j] and len(a) == len(b):
                x, y = (np.array(v, float) / np.abs(v).max() for v in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    near[ids[i]].add(ids[j])
                    near[ids[j]].add(ids[i])
    out = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(near[i]), min(seen), i == min(seen))
    return out


def test_vectors(spark):
    chance = np.random.default_rng(1)
    rows, base = [], chance.standard_normal((30, 16))
    for i in range(150):
        noise = chance.standard_normal(16) * (0.05 + 0.1 * (i % 3))
        rows.append((i, (base[i % 30] + noise).tolist(), i % 2))
    hot = chance.standard_normal(16)
    rows += [(200 + i, (hot + chance.standard_normal(16) * 0.02).tolist(), 5) for i in range(120)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [1.0, None] * 8, 1), (404, [float("nan")] * 16, 1)]
    rows += [(405, hot.tolist(), None), (406, [1e300] * 16, 9), (407, [1e-300] * 16, 9), (408, [1.0] * 8, 9)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    params = vectors.VectorParams(block=32, window=8)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.vector_components(given, params=params).collect()}
    ids, matrix, labels = zip(*rows)
    assert got == brute(list(ids), list(labels), list(matrix), 0.98)
    assert vectors.vector_components(given.limit(0)).isEmpty()


def test_vector_recall(spark):
    rows = duckdb.sql("select * from '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    want = {}
    matrix = np.array([r[1] for r in rows], float)
    matrix /= np.sqrt((matrix * matrix).sum(1, keepdims=True))
    labels, near = np.array([r[2] for r in rows]), matrix @ matrix.T >= 0.98
    near &= labels[:, None] == labels[None, :]
    want = {r[0]: int(n) - 1 for r, n in zip(rows, near.sum(1))}
    got = {r.vec_id: r.n_links for r in queries.op8_embedding_near_dedup(spark, "/root/testdata/sf0.1").collect()}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.9 * sum(want.values())


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there.\n\nHow do I sort a list?"),
        (1, 1, "assistant", "> How do  I sort a list?\nUse sorted."),
        (1, 2, "user", "Something else entirely"),
        (1, 3, "user", ">> how do I sort a list\n> Use sorted.\n\nThanks!"),
        (1, 4, "user", "> never said\nMe neither"),
        (1, 5, None, None),
        (2, 0, "user", "> Use sorted.\nfrom another talk"),
        (None, 0, "user", "> x"),
        (1, 2, "user", "Something else entirely"),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.linked_messages(given).collect()
    assert len(got) == len(rows)
    one = {(r.turn, r.text): r for r in got if r.conv_id == 1}
    assert one[(1, "Use sorted.")].reply_to == 0 and one[(1, "Use sorted.")].thread == 0
    thanks = one[(3, "Thanks!")]
    assert (thanks.reply_to, thanks.thread, thanks.depth, thanks.n_quotes, thanks.n_linked) == (1, 0, 2, 2, 2)
    lost = one[(4, "Me neither")]
    assert (lost.reply_to, lost.thread, lost.n_quotes, lost.n_linked) == (None, 4, 1, 0)
    order = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.position)
    assert [r.turn for r in order] == [0, 1, 3, 2, 2, 4, 5] and [r.position for r in order] == list(range(7))
    assert order[0].chat == "<|user|>\nHello there.\n\nHow do I sort a list?"
    assert next(r for r in got if r.conv_id == 2).reply_to is None
    assert quotes.linked_messages(given.limit(0)).isEmpty()


def test_partial_quotes(spark):
    rows = [
        (1, 0, "user", "First we sort the list. Then\nwe search it by halves.\nLast we print what is left."),
        (1, 1, "user", "Print it."),
        (1, 2, "assistant", "> we search it by halves.\nWhy halves?\n> Last we print what is left.\nYes."),
        (1, 3, "assistant", "> First we sort the list. Then\n> we search it by halves.\nFine"),
        (1, 4, "assistant", "> Then we search\n> it by halves.\n> Print it.\nAgreed"),
        (1, 5, "assistant", "> Why halves? Yes.\nIndeed"),
        (1, 6, "assistant", "> Print it\n\nWell"),
        (1, 7, "assistant", "> halves\nNo whole line"),
        (2, 0, "assistant", "> we search it by halves.\nElsewhere"),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to) for r in quotes.linked_messages(given).collect()}
    assert got == {
        (1, 0): (0, 0, None), (1, 1): (0, 0, None), (1, 2): (2, 2, 0), (1, 3): (1, 1, 0), (1, 4): (1, 1, 0),
        (1, 5): (1, 1, 2), (1, 6): (1, 1, 1), (1, 7): (1, 0, None), (2, 0): (1, 0, None),
    }


def test_messages_without_quotes_keep_their_order(spark, small):
    got = queries.op5_chat_quotes(spark, small)
    assert got.count() == table(spark, small, "conversations").count()
    assert got.where("position != turn or text is null or depth != 0").isEmpty()


def test_native_operators_run_no_python(spark, small):
    for query in (queries.op2_url_filters, queries.op5_chat_quotes):
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_twins(spark, small):
    connection = duckdb.connect()
    connection.sql(f"create view pages as select * from '{small}/pages.parquet'")
    for name, sql in queries.oracle_sql().items():
        found = queries.queries()[name](spark, small)
        wanted = connection.sql(sql)
        columns = sorted(found.columns)
        assert columns == sorted(wanted.columns)
        rows = sorted(map(str, found.select(*columns).toPandas().itertuples(index=False, name=None)))
        wanted = sorted(map(str, wanted.df()[columns].itertuples(index=False, name=None)))
        assert rows == wanted


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = table(spark, small, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, small)
        docs = docs.cache()
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and len(left) > 50, name
        if name != "packing":
            assert docs.columns == before.columns, name
            assert docs.where(F.length("text") != F.col("n_chars")).isEmpty(), name
        ids = left
    assert {r.doc_id for r in corpus_pipeline.run(spark, small).select("doc_id").collect()} == ids


def passages_by_hand(text):
    found, last = [], None
    for line in re.split(r"\r\n|\r|\n", text or ""):
        marks = re.match(r"[ \t]*((?:>[ \t]*)*)", line).group(1)
        level, own = marks.count(">"), re.sub(r"^[ \t]*>[ \t>]*", "", line)
        if not own.strip(" "):
            last = None
        elif last == level:
            found[-1][1].append(own)
        else:
            found.append((level, [own]))
            last = level
    return [(level, "\n".join(own)) for level, own in found]


def test_passages_are_those_of_a_plain_loop(spark):
    chance = random.Random(8)
    pieces = ["> a", ">> b", "> > c", "plain", "", " ", ">", "> ", "\t> d", "e > f", ">g", "\t"]
    texts = [chance.choice(["\n", "\r\n", "\r"]).join(chance.choices(pieces, k=chance.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate([None, "", *texts])), "i int, text string")
    got = {r.i: [tuple(p) for p in r.p] for r in df.select("i", quotes.passages(F.col("text")).alias("p")).collect()}
    assert got == {i: passages_by_hand(t) for i, t in enumerate([None, "", *texts])}


def test_passages_of_a_very_long_message(spark):
    text = "\n".join("> " * (i % 3) + f"line {i}" + ("\n" if i % 5 == 0 else "") for i in range(100_000))
    df = spark.createDataFrame([(text, "x " * 10), ("> one\n" * 100_000, "")], "text string, other string")
    start = time.perf_counter()
    rows = df.select(quotes.passages(F.col("text")).alias("p")).collect()
    assert time.perf_counter() - start < 60
    assert [tuple(p) for p in rows[0].p] == passages_by_hand(text)
    assert len(rows[1].p) == 1 and rows[1].p[0].passage.count("\n") == 99_999


def test_quotes_of_generated_chats_link_to_their_originals(spark):
    """Each message quotes some earlier ones as a whole; the lowest level and, of
    equals, the latest message is what it replies to."""
    chance = random.Random(12)
    rows, wanted = [], {}
    for conversation in range(30):
        said = []
        for turn in range(chance.randint(2, 9)):
            own = f"Message {conversation} {turn} says: {chance.randint(0, 10**9)}!"
            named = sorted(chance.sample(range(turn), k=min(turn, chance.randint(0, 2))))
            levels = [chance.randint(1, 2) for _ in named]
            lines = [line for n, k in zip(named, levels) for line in (">" * k + " " + said[n].upper(), "")]
            rows.append((conversation, turn, "user", "\n".join([*lines, own])))
            low = [n for n, k in zip(named, levels) if k == min(levels)]
            wanted[conversation, turn] = (max(low) if low else None, len(named), own)
            said.append(own)
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chats.withColumns({c: F.lit("x") for c in ("id", "level", "said", "reply_to", "thread", "whole")})
    got = {(r.conv_id, r.turn): (r.reply_to, r.n_quotes, r.text) for r in quotes.linked_messages(chats).collect()}
    assert got == wanted

"""Text operators against brute force, on the smallest tables and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crivo.llm import common, ftrl, line_pairs, lines, ngram_join, packing, pieces, quality_rules, queries, secrets
from crivo.llm.common import connected_components, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, key string, n long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ODD = [
    (1, None, "a", 1),
    (2, "", "a", 2),
    (3, " \t\n\x0b ", None, None),
    (4, "one two", "b", 4),
    (5, "One TWO", "b", 5),
    (6, LONG, "c", 6),
    (6, LONG, "c", 6),
    (7, LONG + " end", "c", 7),
    (None, "one two", "d", 8),
    (8, "one two three four five six seven eight nine ten\n" * 3, "e", 9),
]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components(ids, linked):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [ids[find(i)] for i in range(len(ids))]


def jaccard(sets, percent):
    def linked(i, j):
        a, b = sets[i], sets[j]
        both = len(a & b)
        return bool(a) and bool(b) and 100 * both >= percent * (len(a) + len(b) - both)

    return linked


def edited(count=60, words=120, seed=5):
    """One text with 0 to 9 words replaced, many times over, and strangers."""
    chance = random.Random(seed)
    base = [f"b{chance.randrange(900)}" for _ in range(words)]
    texts = []
    for i in range(count):
        own = list(base)
        for at in chance.sample(range(words), i % 10):
            own[at] = f"x{chance.randrange(10**6)}"
        texts.append(" ".join(own))
    return texts + [" ".join(f"s{chance.randrange(10**6)}" for _ in range(words)) for _ in range(9)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (None, 4)]
    edges += [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 260)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    got = {r.node: r.component for r in found.collect()}
    assert all(got[i] == 1 for i in (1, 2, 3, 7, 8, 9)) and got[21] == 20 and 5 not in got
    assert {got[i] for i in range(100, 160)} == {100} and {got[i] for i in range(200, 261)} == {200}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").isEmpty()


@pytest.mark.parametrize("at_once", [1 << 17, 16])
def test_components_of_few_edges_take_no_rounds(spark, monkeypatch, at_once):
    chance, asked = random.Random(6), []
    real = common._star_round
    monkeypatch.setattr(common, "EDGES_AT_ONCE", at_once)
    monkeypatch.setattr(common, "_star_round", lambda links: (asked.append(1), real(links))[1])
    edges = [(chance.randrange(150), chance.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(9), "a", "b")
    linked = {frozenset(e) for e in edges}
    nodes = sorted({n for e in edges if e[0] != e[1] for n in e})
    want = components(nodes, lambda i, j: frozenset((nodes[i], nodes[j])) in linked)
    assert {r.node: r.component for r in found.collect()} == dict(zip(nodes, want))
    assert bool(asked) == (at_once == 16)


@pytest.mark.parametrize("params", [
    ngram_join.JoinParams(words=4, percent=85),
    ngram_join.JoinParams(words=4, percent=85, group_rows=8, fragments=3, order_buckets=8),
])
def test_ngram_join_is_that_of_all_pairs(spark, params):
    texts = edited()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = ngram_join.ngram_jaccard_components(docs, "doc_id", "text", params).collect()
    sets = [shingles(t, 4) for t in texts]
    want = components(list(range(len(texts))), jaccard(sets, 85))
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in enumerate(sets)}
    assert 1 < len(set(want)) < len(texts)


def test_ngram_join_reads_texts_once_for_both_sides_of_its_pairs(spark, monkeypatch):
    texts = [f"one two three four five six seven eight nine t{i // 3}" for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = []

    def noted(name):
        real = getattr(ngram_join, name)
        return lambda *args: (asked.append(name), real(*args))[1]

    for name in ("_linked", "_segments"):
        monkeypatch.setattr(ngram_join, name, noted(name))
    got = ngram_join.ngram_jaccard_components(docs, "doc_id", "text", ngram_join.JoinParams(words=4, percent=75)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, 0) for i in range(12)}
    assert asked.count("_segments") == asked.count("_linked") > 0


def test_ngram_join_knows_a_bound_of_what_fronts_share(spark):
    chance = random.Random(10)
    grams = [chance.randrange(-(1 << 63), 1 << 63) for _ in range(250)]
    sets = [set(chance.sample(grams, 12)) for _ in range(15)]
    sets += [set(chance.sample(sorted(sets[0]), 10)) | {chance.choice(grams)} for _ in range(5)]
    rows = [(key, gram) for key, grams in enumerate(sets) for gram in grams]
    of_set = Window.partitionBy("key")
    fronts = spark.createDataFrame(rows, "key long, gram long").withColumns(
        {"common": F.count("gram").over(of_set), **ngram_join._signs(of_set)}
    )
    fronts = fronts.drop("gram").distinct()
    pairs = fronts.alias("x").crossJoin(fronts.alias("y"))
    found = pairs.select("x.key", F.col("y.key").alias("other"), ngram_join._most_shared("x", "y").alias("most"))
    shared = {(r.key, r.other): (r.most, len(sets[r.key] & sets[r.other])) for r in found.collect()}
    assert len(shared) == 400 and all(most >= n for most, n in shared.values())
    assert np.mean([most <= n + 2 for most, n in shared.values()]) > 0.9


def test_ngram_join_on_odd_rows(spark):
    got = ngram_join.ngram_jaccard_components(odd(spark), "doc_id", "text").collect()
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in got}
    assert len(got) == len(ODD)
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (None, 1, 4)} <= found
    n = len(shingles(LONG, 5))
    assert {(6, n, 6), (7, n + 1, 6)} <= found
    empty = ngram_join.ngram_jaccard_components(odd(spark).limit(0), "doc_id", "text")
    assert empty.columns == ["doc_id", "n_shingles", "component_id"] and empty.isEmpty()


def test_op1_over_the_smallest_table(spark, small):
    rows = table(spark, small, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    sets = [shingles(r.text, 4) for r in rows]
    want = components([r.doc_id for r in rows], jaccard(sets, 85))
    got = {r.doc_id: r.component_id for r in queries.op1_ngram_jaccard_join(spark, small).collect()}
    assert got == {r.doc_id: c for r, c in zip(rows, want)}


def test_edit_distance():
    chance = random.Random(1)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    for _ in range(300):
        a, b = ("".join(chance.choices("abé ", k=chance.randrange(14))) for _ in range(2))
        assert lines.edit_distance(a, b) == plain(a, b)
    assert lines.edit_distance("x" * 50_000 + "a", "x" * 50_000 + "bc") == 2


def test_line_dedup(spark):
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion under the old bridge"
    rows = [
        (1, f"Intro one\n{base}\n\nunique first text here"),
        (2, f"{base.upper()}!\nanother line that nobody else has at all"),
        (3, f"{base}\n{base}"),
        (4, ""),
        (5, None),
        (6, "***\n"),
        (7, "a 1\na 2\nb"),
    ]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, line long")
    kept = {(r.doc_id, r.line): r.kept for r in lines.line_groups(docs, "doc_id", "text").collect()}
    assert kept == {
        (1, 0): True, (1, 1): True, (1, 3): True, (2, 0): False, (2, 1): True, (3, 0): False,
        (3, 1): False, (7, 0): True, (7, 1): True, (7, 2): True,
    }
    out = {r.doc_id: (r.text, r.line) for r in lines.dedup_lines(docs).collect()}
    assert out == {
        1: (rows[0][1], 0), 2: ("another line that nobody else has at all", 1),
        4: ("", 3), 5: (None, 4), 6: ("***\n", 5), 7: ("a 1\na 2\nb", 6),
    }


def test_line_dedup_finds_edited_lines(spark):
    chance = random.Random(2)
    def word():
        return "".join(chance.choices("abcdefghijklmnop", k=6))

    base, rows = [word() for _ in range(60)], []
    for i in range(40):
        own = list(base)
        own[chance.randrange(60)] = word()
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join(word() for _ in range(60))) for i in range(20)]
    found = lines.line_groups(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    dropped = {r.doc_id for r in found if not r.kept}
    assert len(dropped) >= 30 and max(dropped) < 40


def _edited(chance, text, edits, letters):
    text = list(text)
    for _ in range(edits):
        at = chance.randrange(len(text) + 1)
        text[at : at + chance.randrange(2)] = chance.choice([[], [chance.choice(letters)]])
    return "".join(text)


def _edited_lines(seed, sizes):
    """Distinct lines of which some are edited ones of others, up to a quarter of the characters."""
    chance, found = random.Random(seed), set()
    for size in sizes:
        letters = chance.choice(["ab ", "abcdefgh é"])
        text = "".join(chance.choices(letters, k=size))
        cut = size // 10
        found |= {text, text[cut:] + "".join(chance.choices(letters, k=cut))}
        found |= {_edited(chance, text, chance.randrange(size // 4 + 2), letters) for _ in range(4)}
    return sorted({lines.folded(text) for text in found} - {""})


def test_line_dedup_links_all_lines_that_are_similar(spark, monkeypatch):
    texts = _edited_lines(5, [3, 6, 10, 20, 30, 30, 60, 60, 120, 300])
    groups = components(range(len(texts)), lambda i, j: lines.similar(texts[i], texts[j], 80))
    full = [i for i, text in enumerate(texts) if re.search("[a-zé]", text)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rows in (1 << 15, 9):
        monkeypatch.setattr(line_pairs, "BLOCK_LINES", rows)
        found = {r.doc_id: r.first_doc_id for r in lines.line_groups(docs, "doc_id", "text").collect()}
        assert found == {i: groups[i] for i in full}


def test_buckets_go_by_the_characters_of_a_line(spark):
    texts = ["", "a", "éé", "abc", "é" * 9, "x" * 200]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r.bucket for r in line_pairs.with_bucket(rows, 80).collect()]
    assert found == [sum(cut <= len(t) for cut in line_pairs.bounds(80)) for t in texts]


def test_lines_are_copied_for_a_round_of_pairs_at_a_time(spark, monkeypatch):
    """Twenty blocks of one length, so twenty copies of each line, but few at any time."""

    def counted(percent, similar):
        return lambda group: pa.table({"a": [group.num_rows], "b": [0]})

    rounds = []
    monkeypatch.setattr(line_pairs, "_within", counted)
    monkeypatch.setattr(line_pairs, "BLOCK_LINES", 10)
    monkeypatch.setattr(line_pairs, "ROUND_BYTES", 1)
    monkeypatch.setattr(
        line_pairs, "staged_in_turn", lambda frames, name: rounds.extend(f.agg(F.sum("a")).first()[0] or 0 for f in frames)
    )
    every = spark.range(200).select(
        F.col("id").alias("key"), F.col("id").alias("component"), F.repeat(F.lit("x"), 40).alias("text")
    )
    line_pairs.all_links(line_pairs.with_bucket(every, 80), 80, lines.similar)
    assert sum(rounds) == 20 * 200 and max(rounds) < 3 * 200


def test_line_dedup_in_many_rounds(spark, monkeypatch):
    texts = _edited_lines(6, [10, 20, 30, 30, 60])
    groups = components(range(len(texts)), lambda i, j: lines.similar(texts[i], texts[j], 80))
    monkeypatch.setattr(line_pairs, "BLOCK_LINES", 5)
    monkeypatch.setattr(line_pairs, "ROUND_BYTES", 1)
    # Each line twice, so that some texts are met several times.
    docs = spark.createDataFrame([(i + d, t) for d in (0, 1000) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.first_doc_id for r in lines.line_groups(docs.repartition(5), "doc_id", "text").collect()}
    full = [i for i, text in enumerate(texts) if re.search("[a-zé]", text)]
    assert found == {i + d: groups[i] for d in (0, 1000) for i in full}


def test_lines_that_are_similar_are_not_rejected():
    for seed in range(12):
        texts = _edited_lines(seed, [4, 8, 15, 30, 50, 90, 200, 240])
        number, half = np.arange(len(texts)), len(texts) // 2
        wanted = {(j, i) for i in range(len(texts)) for j in range(i) if lines.similar(texts[i], texts[j], 80)}
        whole = line_pairs.Block(number, number, texts)
        parts = [line_pairs.Block(number[p], number[p], texts[p]) for p in (slice(half), slice(half, None))]
        for apart, sides in (False, [(whole, whole, True)]), (True, [(*parts, True), (*parts[::-1], False)]):
            found = set()
            for one, two, equal in sides:
                for i, those in line_pairs.unrejected(one, two, 80, equal):
                    found |= {tuple(sorted((int(one.keys[i]), int(two.keys[j])))) for j in those}
            assert {(i, j) for i, j in wanted if not apart or i < half <= j} <= found


def test_lines_of_a_column_are_folded_alike(spark):
    texts = ["  A\tb\r", "É x  Y\x0bz ", "\xa0 K", "ok"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(lines._folded("text")).collect()
    assert [r[0] for r in rows] == [lines.folded(t) for t in texts]


def test_line_dedup_keeps_other_numbers(spark):
    texts = [
        "12 34 56", "98 70 11", "2019: 45%", "2020: 71%", "1", "2", "a = b * c", "a - b + c = d",
        "10 20 30 40 50 60 70", "91 82 73 64 55 46 37", "The total of March was 12,345.67 euros in all",
        "the total of march was 12,345.68 euros in all!", "555 123 4567", "555 123 4568", "777 987 6543",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stays = {r.text for r in lines.dedup_lines(docs).collect()}
    # Only those that differ in a fifth of their characters or less go.
    assert stays == set(texts) - {texts[11], texts[13]}
    numbers = [(i, f"{i * 7919 % 10000:04} {i * 104729 % 10000:04} {i * 1299709 % 10000:04}") for i in range(200)]
    docs = spark.createDataFrame(numbers, "doc_id long, text string")
    got = [r.kept for r in lines.line_groups(docs, "doc_id", "text").orderBy("doc_id").collect()]
    groups = components(range(200), lambda i, j: lines.similar(numbers[i][1], numbers[j][1], 80))
    assert got == [g == i for i, g in enumerate(groups)]


def test_line_dedup_on_odd_rows(spark):
    docs = odd(spark)
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns
    assert sorted(r.n for r in out.where("n is not null").collect()) == [1, 2, 6, 6, 8, 9]
    assert lines.dedup_lines(docs.limit(0)).isEmpty()


def base_statistics(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= set(range(i, i + 5))
    full = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(full) - len(set(full)), len(covered)


def test_quality_statistics(spark, small):
    given = table(spark, small, "documents").select("doc_id", "text")
    docs = given.union(odd(spark).select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in quality_rules.text_statistics(docs, "text", ["doc_id", "text"]).collect():
        assert tuple(r[n] for n in names) == base_statistics(r.text), r.doc_id


def test_quality_rules_recover_a_threshold(spark):
    rows = [(i, f"{'Loud ' if i % 3 else '%%% '}" * 3 + " ".join(f"t{i}w{j}" for j in range(30))) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 240, 2)], "doc_id long, quality int")
    judged, learned = quality_rules.quality_rules(docs, labels)
    assert learned.rules and {r.doc_id for r in judged.where("kept").collect()} == {i for i in range(240) if i % 3}
    assert str(learned)
    _, none = quality_rules.quality_rules(docs, labels.limit(0))
    assert none.rules == ()


def test_quality_rules_run_no_python(spark, small):
    judged, _ = quality_rules.quality_rules(table(spark, small, "documents"), table(spark, small, "labels"))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert judged.count() == table(spark, small, "documents").count()


def test_classifier(spark, small):
    rows = queries.op9_quality_classifier(spark, small).collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    rows = [r for r in queries.op9_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in marks]
    assert len(rows) > 50 and np.mean([r.predicted == marks[r.doc_id] for r in rows]) > 0.95


def test_classifier_without_labels_and_on_odd_rows(spark):
    marks = spark.createDataFrame([], "doc_id long, quality int")
    model = ftrl.fit_quality(odd(spark), marks, "doc_id", "text")
    scored = ftrl.score_quality(odd(spark), "text", model, ["doc_id", "key"])
    assert scored.columns == ["doc_id", "key", "score"] and {r.score for r in scored.collect()} == {0.5}


def test_pieces_are_those_of_the_library(spark, small):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    model = queries.vocabulary(queries.PIECE_MODEL)
    chance = random.Random(3)
    texts = [r.text for r in table(spark, small, "documents").collect()] + [None, "", " ", "   x", "a ", LONG]
    texts += ["".join(chance.choices("abct  \n▁日é\x00he0.", k=chance.randrange(50))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = pieces.encode_pieces(docs, "text", model, ["doc_id", "text"])
    back = pieces.decode_pieces(coded, "ids", model, ["doc_id", "text", "ids"], "back").collect()
    for r in back:
        assert r.ids == library.encode(r.text or "")
        assert r.back == (r.text or "").replace("▁", " ")


def test_words_searched_together_are_those_searched_apart():
    model = pieces.PieceModel.parse(queries.vocabulary(queries.PIECE_MODEL))
    chance = random.Random(9)
    words = ["▁" + "".join(chance.choices("abcthe0.\n日é\x00", k=chance.randrange(12))) for _ in range(3000)]
    words[5:5] = ["▁", "▁" + "ab" * 2000, "▁", "▁"]
    ids, sizes = pieces.encode_words(model, words)
    apart = [pieces.encode_part(model, w) for w in words]
    assert sizes.tolist() == [len(a) for a in apart]
    assert ids.tolist() == [i for a in apart for i in a]
    assert [len(a) for a in pieces.encode_words(model, [])] == [0, 0]


def test_streaming_search_is_the_whole_search():
    names = [None, "a", "b", "ab", "ba", "aba", "▁", "▁a", "bb"]
    scores = [0.0, -2.0, -2.1, -2.5, -3.9, -4.4, -3.0, -3.1, -3.3]
    model = pieces.PieceModel(names, scores, list(range(100, 356)), 0, False)
    chance = random.Random(4)

    def best(text):
        ways = {0: (0.0, [])}
        for end in range(1, len(text) + 1):
            for start in range(end):
                if (i := model.ids.get(text[start:end])) is not None and start in ways:
                    way = (ways[start][0] + scores[i], ways[start][1] + [i])
                    if end not in ways or way[0] > ways[end][0] + 1e-9:
                        ways[end] = way
        return ways[len(text)]

    for _ in range(100):
        text = "▁" + "".join(chance.choices("ab", k=chance.randrange(1, 200)))
        search, got, at = pieces.Viterbi(model), [], 0
        while at < len(text):
            step = chance.randrange(1, 30)
            got += search.feed(text[at : at + step])
            at += step
        got += search.end()
        assert "".join(names[i] for i in got) == text
        assert sum(scores[i] for i in got) == pytest.approx(best(text)[0])
        assert search.largest <= 8 * model.longest + 30


def packed(spark, docs, **more):
    tokenizer = queries.vocabulary(queries.BYTE_BPE)
    return packing.pack_documents(docs, "doc_id", "text", tokenizer, **more).collect()


def test_packing_holds_every_id_once(spark, small):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(queries.vocabulary(queries.BYTE_BPE).decode())
    library.encode_special_tokens = True
    given = table(spark, small, "documents").select("doc_id", "text")
    docs = given.union(odd(spark).where("doc_id != 6").select(F.col("doc_id") + 10_000, "text"))
    wanted = {
        r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()
    }
    rows = packed(spark, docs)
    parts, sequences = {}, {}
    for r in rows:
        parts.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length > 0
        assert r.doc_tokens == len(wanted[r.doc_id])
    for doc, own in parts.items():
        own.sort(key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == wanted[doc]
    assert parts.keys() == wanted.keys()
    short = 0
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        short += sum(r.length for r in own) < 2048
    assert short <= 8


def test_packing_puts_similar_texts_together(spark):
    topics = [" ".join(f"topic{t}word{i}" for i in range(40)) for t in range(20)]
    rows = [(t * 10 + c, f"{topics[t]} copy{c}") for t in range(20) for c in range(4)]
    rows = packed(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(1))
    together = Counter()
    for r in rows:
        together[(r.sequence_id, r.doc_id // 10)] += 1
    assert np.mean([n >= 3 for n in together.values()]) > 0.6
    assert packed(spark, odd(spark).limit(0)) == []


def test_packing_encodes_distinct_words_once(monkeypatch):
    data, asked = queries.vocabulary(queries.BYTE_BPE), []
    one = packing.byte_bpe_encoder(data)
    monkeypatch.setattr(packing, "byte_bpe_encoder", lambda d: lambda text: (asked.append(text), one(text))[1])
    chance = random.Random(8)
    parts = ["a", "bc", " ", " ", "\n", "é", "日本", "\u3000", "'s", "'", ".", "12", "\t", "\x1c", "\x85", "<|endoftext|>"]
    odd = [None, "", " ", "  ", "a ", " a\n", "a\n b", "x 't don't", *("".join(chance.choices(parts, k=9)) for _ in range(3000))]
    plain = [" ".join(chance.choices(["fox", "Dog\nand", "naïve", "it's", "7", "-"], k=200)) for _ in range(50)]
    for texts in (odd, plain, [], [None]):
        asked.clear()
        ids, starts = packing._with_end(packing._encoder(data + b" " * len(texts)), pa.array(texts, pa.string()), 1)
        assert [ids[i:j].tolist() for i, j in zip(starts, starts[1:])] == [[*one(t or "").tolist(), 1] for t in texts]
        if texts is plain:
            assert sum(map(len, asked)) < 100


def test_packing_asks_for_all_shared_terms():
    # Each text has 20 words of its own, heavier than what it shares with one other.
    common = [" ".join(f"pair{p}word{i}" for i in range(8)) for p in range(30)]
    texts = [f"{common[p]} " + " ".join(f"own{p}x{c}x{i}" for i in range(20)) for c in range(2) for p in range(30)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    params = packing.PackParams(length=40, term_bits=4)
    frequency = np.full(1 << params.term_bits, 1)
    starts = np.arange(len(texts) + 1) * 20
    shard = packing.Shard(data, offsets, None, starts, (frequency, 60, 28.0), params)
    for i in range(60):
        assert np.flatnonzero(shard.scores(i)).tolist() == sorted((i, (i + 30) % 60))
    pairs = [[row for row, _, _ in pieces] for pieces in shard.sequences()]
    assert pairs == [[i, i + 30] for i in range(30)]


def jwt():
    import base64

    part = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    return f"{part(b'{"alg":"HS256"}')}.{part(b'{"sub":"1"}')}.{part(b'0123456789abcdef')}"


def test_structures():
    import base64
    import struct

    inner = bytes([2, 1, 0]) + bytes([2, 33]) + bytes(range(1, 34)) + bytes([0x30, 3, 6, 1, 42])
    der = bytes([0x30, len(inner)]) + inner
    key = base64.b64encode(der).decode()
    ssh = base64.b64encode(b"".join(struct.pack(">I", len(f)) + f for f in (b"ssh-ed25519", bytes(32)))).decode()
    for text, kind in ((jwt(), "token"), (key, "key"), (der.hex(), "key"), (ssh, "ssh")):
        assert secrets.confirmed_spans(f"x {text} y") == [(kind, 2, 2 + len(text))], kind
    assert not secrets.confirmed_spans(key[:-8]) and not secrets.confirmed_spans("eyJhbGciOi.eyJzdWIi.xx")
    assert not secrets.confirmed_spans("M" + "C" * 40) and not secrets.confirmed_spans("AAAA" + "B" * 40)
    assert secrets.redacted("ab cd ef", [("hex", 3, 5), ("assign", 0, 4)]) == "[SECRET] ef"


def test_keys_of_several_lines():
    import base64
    import struct

    def der(tag, data):
        size = len(data)
        return bytes([tag, size] if size < 128 else [tag, 0x82, size >> 8, size & 255]) + data

    def lines_of(data, end):
        text = base64.b64encode(data).decode()
        return end.join(text[i : i + 64] for i in range(0, len(text), 64))

    chance = random.Random(3)
    for size in range(200, 300):
        key = der(0x30, der(0x02, b"\x01") + der(0x04, chance.randbytes(size)))
        for end in ("\n", "\r\n", "\n    ", "\n> ", "\\n", '\\n"\n  "', "\\\\n"):
            body = lines_of(key, end)
            for behind in (f"{end}-----END PRIVATE KEY-----", "\nand then some words", ""):
                text = f"-----BEGIN PRIVATE KEY-----{end}{body}{behind}"
                start = text.index(body)
                assert secrets.confirmed_spans(text) == [("key", start, start + len(body))], (size, end, behind)
    assert not secrets.confirmed_spans(lines_of(key, "\n")[:-9]) and secrets.confirmed_spans(lines_of(key, "")[:-4]) == []

    def fields(*found):
        return b"".join(struct.pack(">I", len(f)) + f for f in found)

    public = fields(b"ssh-rsa", b"\1\0\1", bytes(range(256)) + b"1")
    private = b"openssh-key-v1\0" + fields(b"none", b"none", b"") + b"\0\0\0\1" + fields(public, chance.randbytes(500))
    for data in (public, private):
        for end in ("\n", "\n  ", "\\n"):
            body = lines_of(data, end)
            text = f"x {body}{end}-----END"
            assert secrets.confirmed_spans(text) == [("ssh", 2, 2 + len(body))]


def test_secret_scan(spark, small):
    assign = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    docs = table(spark, small, "documents").select("doc_id", "text").union(odd(spark).select("doc_id", "text"))
    extra = [(-1, f"API_KEY: 'abcdefghijklmnop' password: token = abcdefghijkl é {jwt()}"), (-2, "AKIA" + "Z9" * 8)]
    docs = docs.union(spark.createDataFrame(extra, "doc_id long, text string"))
    for r in secrets.secret_scan(docs, "text", ["doc_id", "text"], redact=True).collect():
        text, found = r.text or "", []
        found += [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
        found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        kinds = ["assign", "access", "hex"]
        found.sort(key=lambda s: (s[1], kinds.index(s[0])))
        digest = hashlib.sha256(",".join("%s:%d:%d" % s for s in found).encode()).hexdigest()
        assert r.base_sha256 == digest
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in found) for k in kinds]
        assert (r.clean_text is None) == (r.text is None)
        if not r.spans:
            assert r.clean_text == r.text
        assert ("token:" in r.spans) == (r.doc_id == -1)


def test_word_hashes_follow_words():
    from crivo.llm.common import ngrams, text_chunks, words_of

    texts = ["a b", "", "A  b\x0b", None, "b a", "ab"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    (_, data, offsets), = text_chunks(iter([batch]), "text")
    words, rows, starts, stops = words_of(data, offsets)
    assert rows.tolist() == [0, 0, 2, 2, 4, 4, 5] and words[0] == words[2] == words[5]
    assert len(set(words.tolist())) == 3
    grams, of = ngrams(words, rows, 2)
    assert grams[0] == grams[1] != grams[2] and of.tolist() == [0, 2, 4, 5]


def test_lines_of_two_texts_under_one_id(spark):
    copy = "this very line stands in another document as well"
    rows = [(1, copy), (5, f"{copy}\nsomething"), (5, "a unique first line that nobody else wrote at all\nmore"),
            (None, copy), (None, "words that only the other nameless text holds")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((str(r.doc_id), r.text) for r in lines.dedup_lines(docs).collect())
    # The null id comes first, so its copy stays.
    assert out == sorted(
        [("5", "something"), ("5", rows[2][1]), ("None", copy), ("None", rows[4][1])]
    )
    repeated = docs.union(docs)
    assert sorted((str(r.doc_id), r.text) for r in lines.dedup_lines(repeated).collect()) == sorted(out + out)


def test_short_lines_link_by_their_similarity_only(spark):
    docs = spark.createDataFrame([(1, "x+1"), (2, "x-1"), (3, "a 1"), (4, "a 2"), (5, "a 2")], "doc_id long, text string")
    assert sorted(r.doc_id for r in lines.dedup_lines(docs).collect()) == [1, 2, 3, 4]


def test_dedup_of_lines_takes_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "same line here", 1), (2, "same line here", 2)], "doc_id long, text string, key long")
    docs = docs.withColumns({c: F.col("key") for c in ("lines", "stays", "text_hash", "_gone", "_stays", "g", "line", "first")})
    out = lines.dedup_lines(docs)
    assert out.columns == docs.columns and [r.stays for r in out.collect()] == [1]


def _der(size):
    body = b"\x02" + (size.to_bytes(1, "big") if size < 128 else b"\x81" + size.to_bytes(1, "big")) + bytes(range(1, 1 + size))
    return b"\x30" + (bytes([len(body)]) if len(body) < 128 else b"\x81" + bytes([len(body)])) + body


def test_secrets_behind_what_only_looks_like_one():
    import base64
    import json
    import time

    def part(text):
        return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")

    claims, signature = part(json.dumps({"sub": "x"})), part("s" * 32)
    for header in ('{ "alg": "HS256" }', '{\n "alg": "HS256"}', '{"alg":"none"}'):
        token = f"{part(header)}.{claims}.{signature}"
        assert secrets.confirmed_spans(f"see example.org.net ({token})") == [("token", 21, 21 + len(token))]
    for text in ("eyJhbGci", "ex.am.ple", f"{part('{ }')}.{claims}.{signature}"):
        assert secrets.confirmed_spans(text) == []
    key = _der(60)
    for lead in ("3030", "30", "30453030"):
        found = secrets.confirmed_spans(f"z {lead}{key.hex()} z")
        assert found == [("key", 2 + len(lead), 2 + len(lead) + 2 * len(key))], lead
    coded = base64.b64encode(key).decode()
    found = secrets.confirmed_spans(f"z MEMC{coded} z")
    assert found == [("key", 6, 6 + len(coded))]
    took = []
    for times in (1, 4):
        blob = ("MEMCMIIB" * 2500 + "30823045" * 2500) * times
        start = time.perf_counter()
        secrets.confirmed_spans(blob)
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0] + 1


def test_stages_take_documents_with_columns_of_their_own_results(spark, small):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    extra = ("spans", "score", "n_hex", "base_sha256", "_text", "clean_text", "lines", "stays", "key", "_column_0")
    docs = docs.withColumns({c: F.lit(c) for c in extra}).unionByName(
        spark.createDataFrame([(None, None, None, None, None), (10**9, "", None, None, None)], docs.schema)
        .withColumns({c: F.lit(c) for c in extra})
    )
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns, name
        assert {r.spans for r in out.collect()} == {"spans"}, name
        assert stage(spark, docs.limit(0), small).isEmpty(), name

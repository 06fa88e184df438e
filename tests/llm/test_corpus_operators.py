"""Repeated byte strings, resampling and tokenizer alignment against brute force."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from crivo.llm import alignment, queries, resampling, suffixes
from tools.compare import database, differences

SMALL_STRINGS = dict(size=40, window=4, reach=24, triggers=(8, 4, 2))


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def repeats_removed(rows, size):
    """Every string of ``size`` bytes counted."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(d[k : k + size] for _, d in texts for k in range(len(d) - size + 1))
    out = []
    for i, d in texts:
        gone = np.zeros(len(d), bool)
        for k in range(len(d) - size + 1):
            gone[k : k + size] |= counts[d[k : k + size]] > 1
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(d) else 0
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return by_id(out)


def repetitive(seed):
    random.seed(seed)

    def text(letters, least, most):
        return "".join(random.choice(letters) for _ in range(random.randint(least, most)))

    passages = [text("ab cdé", 20, 120) for _ in range(12)]
    rows = []
    for i in range(250):
        parts = []
        for _ in range(random.randint(0, 6)):
            kind = random.random()
            if kind < 0.5:
                passage = random.choice(passages)
                begin = random.randint(0, len(passage) // 2)
                parts.append(passage[begin : begin + random.randint(5, 100)])
            elif kind < 0.6:
                parts.append("a" * random.randint(1, 120))
            elif kind < 0.65:
                parts.append("\0" * random.randint(1, 60))
            else:
                parts.append(text("abcdefgh ", 0, 60))
        rows.append((random.randint(0, 220) if i % 7 else None, "".join(parts) if i % 11 else None))
    return rows


@pytest.mark.parametrize("seed, more", [(1, {}), (2, {"order_rows": 2}), (3, {"block": 64}), (4, {"order_rows": 3, "block": 41})])
def test_repeats_are_those_of_brute_force(spark, seed, more):
    rows = repetitive(seed)
    docs = spark.createDataFrame(rows, "id long, text string")
    got = suffixes.remove_repeats(docs, "id", "text", suffixes.SuffixParams(**SMALL_STRINGS, **more))
    assert got.columns == ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert by_id(got.collect()) == repeats_removed(rows, 40)


def test_repeats_in_odd_tables(spark):
    long = "".join(random.Random(9).choices("abcdef \n", k=300_000))
    copied = long[1000:1400]
    rows = [
        (1, long, "x"),
        (2, copied, "x"),
        (3, copied[1:], "x"),
        (4, "é" + copied + "é", None),
        (None, None, "x"),
        (None, "", "x"),
        (5, "z" * 399, "x"),
        (6, "y" * 400, "x"),
        (7, "x" * 401, "x"),
        (8, "same text " * 50, "x"),
        (8, "same text " * 50, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, number string")
    docs = docs.withColumns({c: docs.number for c in ("marks", "id", "inner", "first", "n")})
    got = {r.doc_id: r for r in suffixes.remove_repeats(docs, "doc_id", "text").collect() if r.doc_id}
    assert [(got[i].n_removed, got[i].n_spans) for i in range(1, 9)] == [
        (400, 1), (400, 1), (0, 0), (400, 1), (0, 0), (0, 0), (401, 1), (500, 1),
    ]
    assert got[4].kept_sha256 == hashlib.sha256("éé".encode()).hexdigest()
    assert got[1].kept_sha256 == hashlib.sha256((long[:1000] + long[1400:]).encode()).hexdigest()
    assert suffixes.remove_repeats(docs, "doc_id", "text").count() == len(rows)
    assert suffixes.remove_repeats(docs.limit(0), "doc_id", "text").isEmpty()


def test_anchors_depend_on_the_window_alone():
    params = suffixes.SuffixParams(**SMALL_STRINGS)
    data = np.random.default_rng(3).integers(97, 100, 4000).astype(np.uint8)
    data[500:900] = 97
    whole = suffixes.anchors(data, params)
    for at in range(0, len(whole), 7):
        alone = suffixes.anchors(data[at : at + params.size], params)
        assert alone[0] + at == whole[at] and 0 <= alone[0] < params.reach


# Resampling


def words_and_runs(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def resampled(rows, target, percent=5, least=20):
    def buckets(text):
        return [zlib.crc32(f.encode()) % 10_000 for f in words_and_runs(text)[1]]

    raw, aim = Counter(), Counter()
    for _, text in rows:
        raw.update(buckets(text))
    for text in target:
        aim.update(buckets(text))
    s_all, t_all = sum(raw.values()), sum(aim.values())
    out = []
    for i, text in rows:
        found = buckets(text)
        weight = sum(
            math.floor(1000 * math.log((aim[b] + 1.0) * (s_all + 10_000.0) / ((raw[b] + 1.0) * (t_all + 10_000.0))))
            for b in found
        )
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words_and_runs(text)[0])])
    enough = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(enough[: percent * len(enough) // 100], 1):
        row[4] = rank
    return by_id(r[:5] for r in out)


def test_resampling_is_that_of_brute_force(spark):
    random.seed(4)
    stems = ["Ab", "été", "x1", "日本", "ab", "C_d", "e-f", "g\x85h", "i j"]
    rows = [
        (i, random.choice([" ", "\n", ", ", "\0"]).join(random.choices(stems, k=random.randint(0, 60))))
        for i in range(300)
    ]
    rows += [(None, "ab " * 40), (400, None), (401, ""), (402, "a" * 50), (403, rows[7][1]), (7, rows[7][1])]
    target = ["ab été x1 ab", None, "", "日本 日本 ab x1"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text AS weight", "1 AS rank", "2 AS _at")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    params = resampling.ResampleParams(percent=30)
    got = resampling.importance_resample(docs, aim, "doc_id", "text", "text", params)
    got = by_id(got.select("id", "n_features", "weight", "score", "rank").collect())
    # Of two equal rows either may have the smaller rank.
    assert got == resampled(rows, target, 30)
    empty = resampling.importance_resample(docs.limit(0), aim.limit(0), "doc_id", "text", "text")
    assert empty.isEmpty()
    alone = resampling.importance_resample(docs, aim.limit(0), "doc_id", "text", "text")
    assert alone.count() == len(rows)


@pytest.mark.parametrize("block", [1, 5, 64, 1 << 20])
def test_features_do_not_depend_on_blocks(block):
    text = "One two, three-four " * 20 + "x" * 100 + " \n\n end"
    runs = words_and_runs(text)[1]
    found = [h for grams in resampling.feature_hashes(text.encode(), 3, block) for hashes in grams for h in hashes]
    assert Counter(found) == Counter(zlib.crc32(f.encode()) for f in runs)


def test_twins(spark, small):
    connection = database(small)
    for name, sql in queries.oracle_sql().items():
        assert differences(queries.queries()[name](spark, small).toPandas(), connection.sql(sql).df()) is None, name


# Alignment


@pytest.fixture(scope="module")
def files():
    import public_tokenizers

    return [public_tokenizers.path(n) for n in (queries.BYTE_BPE, queries.PIECE_MODEL)]


def aligned_plainly(rows, files):
    """Whole texts by the tokenizers' own libraries, offsets compared one by one."""
    first = Tokenizer.from_file(files[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=files[1])
    with open(files[0], "rb") as file:
        bytes_a = alignment.byte_level_tokens(file.read())
    with open(files[0]) as file:
        assert sum(map(bool, bytes_a)) >= len(json.load(file)["model"]["vocab"])
    bytes_b = alignment.piece_tokens(second)
    found, counts = [], Counter()
    for i, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(t[x] for x in ids) != raw for t, ids in ((bytes_a, a), (bytes_b, b))):
            found.append((i, [], [], [], []))
            continue
        ends = [np.cumsum([len(t[x]) for x in ids]) for t, ids in ((bytes_a, a), (bytes_b, b))]
        groups, links, at = [], [], [0, 0]
        for end in sorted(set(ends[0].tolist()) & set(ends[1].tolist())):
            upto = [int(np.searchsorted(e, end, "right")) for e in ends]
            sides = [ids[s:e] for ids, s, e in zip((a, b), at, upto)]
            groups.append("|".join(",".join(map(str, s)) for s in sides))
            links.append((sides[0][-1], sides[1][-1]))
            at = upto
        counts.update(links)
        found.append((i, a, b, groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return by_id(
        (
            i, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, a, b, groups, links in found
    )


ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a\n\nb  c ", "x   y", "x   y", "x　 \ty", "\t\ta b",
    "if (x) {\r\n\treturn;\r\n}\r\n", "!\x1c a\x1c !", "▁a ▁ b▁ c", "don't we'll  I'M", "ﬁ Ⅳ é é", "日本語 のテキスト",
    "<|endoftext|> <s> </s> <unk> <0x41>", "\0 a\0", "🙂 👨‍👩‍👧 ok", "a" * 500, "  lots   of    blanks     ", "1234567890 3.14",
]


@pytest.mark.parametrize("more", [{}, {"hot_pairs": 4}, {"block": 3, "remembered": 40, "hot_pairs": 1}])
def test_alignment_is_that_of_whole_texts(spark, small, files, more):
    rows = list(enumerate(ODD_TEXTS))
    rows += [(None, "a b"), (3, "a b"), (3, "a b")]
    random.seed(2)
    marks = [" ", "  ", "\n", "\r\n", " ", "▁", "\x1c", "ab", "Ab", "é", "12", "!", "'s", "語", ";\r"]
    rows += [(1000 + i, "".join(random.choices(marks, k=random.randint(1, 30)))) for i in range(200)]
    rows += [(r.doc_id + 10_000, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").limit(40).collect()]
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("*", "text AS pairs", "1 AS _row", "2 AS n_a")
    data = [queries.vocabulary(n) for n in (queries.BYTE_BPE, queries.PIECE_MODEL)]
    got = alignment.aligned_tokens(docs, "id", "text", *data, alignment.AlignParams(**more))
    assert by_id(got.collect()) == aligned_plainly(rows, files)
    assert alignment.aligned_tokens(docs.limit(0), "id", "text", *data).isEmpty()


def test_identity_map_holds_tokens_of_the_same_bytes():
    found = alignment.Tokenizers(*(queries.vocabulary(n) for n in (queries.BYTE_BPE, queries.PIECE_MODEL)))
    assert found.parted
    mapped = np.flatnonzero(found.same >= 0)
    assert len(mapped) > 5000
    assert all(found.bytes_a[a] == found.bytes_b[found.same[a]] for a in mapped)
    known = set(found.bytes_b)
    assert not any(found.bytes_a[a] in known for a in np.flatnonzero(found.same < 0) if found.bytes_a[a])


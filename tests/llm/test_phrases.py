"""Rank-queue BPE, collocations and hard negatives against brute force."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import collocations, negatives, rank_queue
from terrafold.llm.encoder import default_path

RANKS = default_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "  a", "a  b", "a\n \nb c", "it's we'll I'M", "x\x1cy z", "日本 語　a", "\x85a b", "<|endoftext|> x", "a\r\n b", "՘࢏ x \U00011de0", "😀😀 é é", "aaaaaaa" * 40, " lead", "trail ", "1234 5x ٣", "\U0003fc3f \x00"]


def test_ids_are_the_librarys_and_decode_to_the_text(library):
    enc, rnd = rank_queue.rank_encoder(RANKS), random.Random(1)
    parts = ["the", "Ñu", " ", " ", "\n", ".", "'s", "9", "ö", "'", "\t", "Haus", "!", "日", "中文字", "٣", " ", "\x1d", "😀", "౜"]
    texts = ODD + ["".join(rnd.choices(parts, k=rnd.randint(1, 40))) for _ in range(500)] + ["".join(chr(rnd.choice([rnd.randint(0, 0x24F), rnd.randint(0x250, 0xD7FF), rnd.randint(0x10000, 0x10FFFF)])) for _ in range(30)) for _ in range(200)]
    for text, packed in zip(texts, enc.texts(texts), strict=True):
        ids = np.frombuffer(packed, enc.kind).tolist()
        assert ids == library.encode_ordinary(text), repr(text)
        assert enc.bytes_of(ids) == text.encode()


def test_lowest_rank_first_even_if_a_merge_makes_a_lower_one(tmp_path):
    """Ranks in any order: merges of a rank may make pairs of a lower one."""
    rnd, letters = random.Random(2), b"abc"
    for _ in range(30):
        tokens = [bytes([k]) for k in range(256)] + list({bytes(rnd.choices(letters, k=rnd.randint(2, 4))) for _ in range(25)})
        order = list(range(len(tokens)))
        rnd.shuffle(order)
        path = tmp_path / f"{rnd.random()}.ranks"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in zip(tokens, order, strict=True)))
        enc = rank_queue.RankEncoder(str(path), r"\S+")
        ranks = dict(zip(tokens, order, strict=True))
        pieces = [bytes(rnd.choices(letters, k=rnd.randint(1, 30))) for _ in range(40)]
        pieces = [p for p in pieces if p not in ranks]

        def plain(piece):
            parts = [piece[k : k + 1] for k in range(len(piece))]
            while True:
                pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
                if not pairs:
                    return [ranks[p] for p in parts]
                k = min(pairs)[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]

        assert enc.merged(pieces) == [plain(p) for p in pieces]
        assert not any(enc.low) and not any(enc.mid)


def test_long_pieces_take_time_in_proportion(library):
    enc, rnd = rank_queue.rank_encoder(RANKS), random.Random(3)
    text = "".join(rnd.choices("abcdeinrst", k=20_000))
    assert np.frombuffer(enc.texts([text])[0], enc.kind).tolist() == library.encode_ordinary(text)


def test_encode_and_decode_tables(spark, library):
    rows = [(7, "seven words", "x", [1]), (3, None, None, None), (5, "", "y", []), (None, "no id", "z", [2]), (9, "long word " * 30000, "q", [5]), (7, "seven words", "x", [1]), *[(100 + k, t, "o", [k]) for k, t in enumerate(ODD)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    encoded = rank_queue.encode(docs)
    assert sorted((r["doc_id"] or -1, tuple(r["ids"])) for r in encoded.collect()) == sorted((d or -1, tuple(library.encode_ordinary(t or ""))) for d, t, *_ in rows)
    back = rank_queue.decode(encoded.withColumn("kept", F.lit("k"))).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode(), r["kept"]) for r in back) == sorted((d or -1, t or "", "k") for d, t, *_ in rows)
    bad = spark.createDataFrame([(1, [70000]), (2, [-1]), (3, None), (4, []), (5, [None])], "n int, ids array<int>")
    assert {r["n"]: r["decoded"] for r in rank_queue.decode(bad).collect()} == {1: None, 2: None, 3: None, 4: bytearray(b""), 5: None}
    assert rank_queue.encode(docs.where("false")).count() == 0


def plain_collocations(rows, longest, least, most, absorbed):
    table, ends = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), ".,;:!?\n\x0b\x0c\r"
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, (text or "").translate(table)
        for c in ends:
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    within = Counter()
    for (lang, p), v in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                within[lang, p[i : i + k]] = max(within[lang, p[i : i + k]], v)
    out = []
    for (lang, p), a in cand.items():
        if within[lang, p] and 100 * within[lang, p] >= absorbed * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:most]
        ranked += [(o[0], k + 1, *o[1:]) for k, o in enumerate(own)]
    return sorted(ranked)


@pytest.mark.parametrize("longest,least,absorbed", [(5, 4, 100), (3, 3, 60), (2, 5, 100), (5, 2, 90)])
def test_collocations_equal_brute_force(spark, longest, least, absorbed):
    rnd = random.Random(longest * 100 + least)
    words = ["a", "B", "ñ", "the", "cat", "sat", "\x00", "x_y", "é", "W9", "\x1c"]
    weights = [9, 7, 3, 8, 6, 5, 1, 2, 1, 2, 1]
    rows = [(rnd.choice(["en", "de", None, ""]), " ".join(w + rnd.choice(["", "", "", ".", "\t", "\n", ";"]) for w in rnd.choices(words, weights, k=rnd.randint(0, 60)))) for _ in range(60)]
    rows += [("en", None), ("en", ""), ("de", "the cat sat on the mat again " * 40), *[("en", "one very common passage of words that repeats")] * 30]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "lang string, text string, n int, phrase string")
    got = collocations.collocations(docs, longest, least, 40, absorbed)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, longest, least, 40, absorbed)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, " . ")], "lang string, text string")).count() == 0


def test_compacted_paths_hold_every_edge_once(spark):
    rnd = random.Random(5)
    text = [str(rnd.randint(0, 12)) for _ in range(300)] + [f"w{k}" for k in range(60)]
    edges = Counter(tuple(text[k : k + 3]) for k in range(len(text) - 2))
    df = spark.createDataFrame([("en", " ".join(e), n) for e, n in edges.items()], "lang string, path string, n long")
    paths = collocations.compact(df, 2, rounds=6).collect()
    back = Counter()
    for r in paths:
        w = r["path"].split(" ")
        for k in range(len(w) - 2):
            assert tuple(w[k : k + 3]) not in back
            back[tuple(w[k : k + 3])] = r["n"]
    assert back == edges
    assert len(paths) < len(edges) - 40  # the unary tail is a few rows


def plain_negatives(rows, anchors, positives=5, negatives_=10):
    def whole(rows):
        out = []
        for i, label, v in rows:
            if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
                continue
            out.append((i, label, [int(np.floor(np.float64(x) * 256)) for x in v]))
        return out

    rows, out = whole(rows), []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    first = {}
    for i, label, v in sorted(whole(anchors), key=lambda a: (a[0], a[1], np.array(a[2], "<i8").tobytes())):
        first.setdefault(i, (label, v))
    for i, (label, v) in first.items():
        scored = [(-dot(v, w), j, other) for j, other, w in rows if j != i]
        own = sorted(s for s in scored if s[2] == label)[:positives]
        for s, j, _ in own:
            found = sorted(x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s)[:negatives_]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("seed,copies", [(1, 0), (2, 60)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, copies):
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "CANDIDATES", 64)
    monkeypatch.setattr(negatives, "_PART", 16)
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, 6))
    rows = [(k, int(rng.integers(0, 3)), (middle[k % 5] + rng.normal(size=6) * 0.4).tolist()) for k in range(200)]
    rows += [(500 + k, k % 3, [0.5] * 6) for k in range(copies)]  # one vector of many rows: ties by id
    rows += [(1000, 1, None), (1001, None, [1.0] * 6), (1002, 1, [1.0, None]), (1003, 1, [float("nan")] * 6), (1004, 1, [float("inf")]), (None, 1, [1.0] * 6), (1005, 2, []), (1006, 2, [3.0, 1.0]), (1006, 2, [3.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "id long, label int, vec array<double>, mark string, block int")
    got = negatives.hard_negatives(df, df.where("id % 10 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, [r for r in rows if r[0] is not None and r[0] % 10 == 0])


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "id long, label int, vec array<float>")
    assert negatives.hard_negatives(df, df).count() == 0
    one = spark.createDataFrame([(1, 1, [1.0])], "id long, label int, vec array<float>")
    assert negatives.hard_negatives(one, one).count() == 0


def test_bounds_spare_products_and_lose_nothing():
    rng = np.random.default_rng(3)
    points = (rng.normal(size=(4, 8))[rng.integers(0, 4, 300)] * 200 + rng.normal(size=(300, 8)) * 6).astype("i8")
    anchors = points[:40]
    order, parent, edge = negatives.spanning_tree(anchors)
    place = np.empty(40, int)
    place[order] = np.arange(40)
    group, top = negatives.Group(points, anchors), {}

    def wanted(k, lo, hi):
        exact = points @ anchors[order[k]]
        assert (lo <= exact).all() and (exact <= hi).all()
        return np.flatnonzero(hi >= np.sort(exact)[-5])

    def take(k, rows, scores):
        top[order[k]] = sorted(scores.tolist())[-5:]

    computed = negatives.walk(group, anchors[order], np.where(parent[order] < 0, -1, place[parent[order]]), edge[order], wanted, take)
    assert all(top[k] == sorted((points @ anchors[k]).tolist())[-5:] for k in range(40))
    assert computed < 0.6 * 40 * 300


def test_large_components_are_summed_as_whole_numbers(spark):
    rows = [(0, 1, [2.0**21, 1.0]), (1, 1, [2.0**21, 0.5]), (2, 2, [2.0**20.5, 0.25]), (3, 2, [2.0**20.9, 1 / 256])]
    df = spark.createDataFrame(rows, "id long, label int, vec array<double>")
    got = negatives.hard_negatives(df, df.where("id = 0"))
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, rows[:1])


def test_digests_of_the_query(spark, tmp_path):
    from terrafold.llm import queries

    spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op11_rank_queue_bpe(spark, str(tmp_path)).collect()}
    ids = np.frombuffer(rank_queue.rank_encoder(RANKS).texts(["Hello  world"])[0], "<u2")
    assert got[1]["n_tokens"] == len(ids) and got[1]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[1]["decoded_sha256"] == hashlib.sha256(b"Hello  world").hexdigest()
    assert (got[2]["n_tokens"], got[2]["ids_sha256"]) == (0, hashlib.sha256(b"").hexdigest())

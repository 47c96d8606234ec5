"""SimHash, components, shards and token counts against brute force."""

import random
import zlib

import numpy as np
import pytest

from terrafold.llm import components, kdtree, simhash, token_counts
from terrafold.llm.encoder import default_path


def closure(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, fp string, shard string")


def plain_fingerprint(text):
    import re

    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_masks_cover_every_pair_within_the_radius():
    rnd = random.Random(4)
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    for _ in range(500):
        diff = sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 4)))
        assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("block", [7, 2048])
def test_links_have_the_closure_of_all_pairs(spark, block):
    rnd = random.Random(5)
    fps = {0}
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 3, 60])):
            fps.add(base)
            base ^= sum(1 << k for k in rnd.sample(range(64), rnd.randint(1, 6)))
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    at = {x: i for i, x in enumerate(fps)}
    want = closure(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= 4])
    found = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 4, block).collect()
    assert closure(len(fps), [(at[r["a"]], at[r["b"]]) for r in found]) == want


def test_simhash_rows(spark):
    rnd = random.Random(6)
    base = [" ".join(rnd.choices("Alpha beta GAMMA delta é x zeta".split(" "), k=60)) for _ in range(6)]
    texts = [*base, *base[:3], base[0] + " tail", None, "", " \t ", "one two", "ONE  two\n", "a b c d e", "word " * 20000]
    rows = [(i * 3, t, "s", "en", "x", "y") for i, t in enumerate(texts)] + [(None, base[1], None, None, None, None), (0, base[0], "s", "en", "x", "y")]
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash_groups(frame(spark, rows)).collect()}
    prints = [plain_fingerprint(r[1]) for r in rows]
    label = closure(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = {}
    for r, k in zip(rows, label, strict=True):
        if r[0] is not None:
            least[k] = min(r[0], least.get(k, r[0]))
    assert got == {(r[0], f"{p:016x}", least.get(k)) for r, p, k in zip(rows, prints, label, strict=True)}
    assert simhash.simhash_groups(frame(spark, [])).count() == 0


def test_sizes_that_spark_guesses_send_no_table_whole(spark):
    """An explode makes 31 rows of one; only sides that were counted are broadcast."""
    fps = spark.createDataFrame([(x,) for x in range(64)], "fp long")
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    whole = simhash.simhash_groups(frame(spark, [(1, "a b c", "s", "en", "x", "y"), (2, "a b c", "s", "en", "x", "y")]))
    for df in (simhash.links(fps), whole, components._large(edges, 20_001), components._small(edges, 20_001)):
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)
    assert "Broadcast" in plan(components._large(edges, 40))
    rows = lambda df: sorted(map(tuple, df.collect()))
    for step in (components._large, components._small):
        assert rows(step(edges, 20_001)) == rows(step(edges, 40))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 200)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def test_shards_are_near_equal_and_keep_light_groups(spark):
    rnd = random.Random(7)
    texts = ["t" * rnd.randint(0, 400) for _ in range(1500)] + ["same text " * 20] * 900 + [None, "", None] + [f"copy {i % 40}" * 9 for i in range(400)]
    rows = [(i if i % 50 else None, t, rnd.choice(["hot", "hot", "b", None]), "en", "x", "y") for i, t in enumerate(texts)]
    rows.append(rows[5])
    out = kdtree.kd_shards(frame(spark, rows)).toPandas()
    assert len(out) == len(rows) and sorted(out["shard"].unique()) == list(range(8))
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    by = out.groupby("shard")["size"].sum()
    assert by.max() / by.mean() < 1.05 and by.min() / by.mean() > 0.95
    crc = zlib.crc32(b"copy 7" * 9)
    assert out[out.text_crc32 == crc]["shard"].nunique() == 1
    assert sorted(out["size"]) == sorted(len(t or "") + 1 for t in [r[1] for r in rows])
    assert out["law"].unique().tolist() == ["bytes"] and out["grown_shard"].isna().all()
    assert kdtree.kd_shards(frame(spark, [])).count() == 0
    one = kdtree.kd_shards(frame(spark, [(1, "x", "s", "en", "", "")]), shards=5).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


def test_no_group_of_equal_texts_is_split_where_a_shard_has_room(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = kdtree.kd_shards(docs).toPandas()
    assert (out.groupby(["text_crc32", "size"])["shard"].nunique() == 1).all()
    by = out.groupby("shard")["size"].sum()
    assert by.max() / by.mean() < 1.05 and by.min() / by.mean() > 0.95
    bare = kdtree.kd_shards(docs.select("doc_id", "text")).toPandas()  # no metadata columns
    assert len(bare) == len(out) and (bare.groupby(["text_crc32", "size"])["shard"].nunique() == 1).all()


def test_heavy_groups_are_placed_within_the_target():
    heavy = [{"text_crc32": k, "size": 1, "w": w} for k, w in enumerate([90, 60, 60, 50, 45, 130, 10])]
    placed, split, loads = kdtree.place_heavy(heavy, 100.0, 4)
    assert split == [(5, 1)] and max(loads) <= 100 and sum(loads) == 315 and len(placed) == 6


@pytest.mark.parametrize("rule", ["start", "end", "most"])
def test_token_counts_add_up(spark, rule):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    texts = [None, "", "\n", "a\n\nb", "one line", "été\n日本語 text\n", "x\n" * 3000, "tail \n\n  next"]
    rows = [(i, t, "src", None, "x", "y") for i, t in enumerate(texts)] + [(None, "null id\nb", "s", "en", "x", "y"), (1, "", None, "en", "x", "y")]
    out = token_counts.token_counts(frame(spark, rows), ("source", "text"), True, rule).toPandas()
    for i, t in enumerate(texts):
        if i == 1:
            continue
        own = out[out.doc_id == i].sort_values("char_start", kind="stable")
        whole = "src\n" + (t or "")
        assert own["n_tokens"].sum() == len(plain.encode(whole, add_special_tokens=False).ids)
        assert own["n_chars"].sum() == len(whole)
        assert len(own) == 1 + len((t or "").split("\n")) - ((t or "").endswith("\n"))
    assert token_counts.token_counts(frame(spark, [])).count() == 0


@pytest.mark.parametrize("rule", ["start", "end"])
def test_each_section_is_that_of_loops_over_tokens(spark, rule):
    """Whole texts by another library, token by token and byte by byte."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(14)
    texts = ["".join(rnd.choices(["a", "word ", "\n", "\n\n", "été", "日本", "😀", "  ", ".", "12"], k=rnd.randint(0, 60))) for _ in range(40)] + ["line of words\n" * 4000]
    out = token_counts.token_counts(frame(spark, [(i, t, "s", "en", "x", "y") for i, t in enumerate(texts)]), rule=rule).collect()
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in out if r["n_chars"]}
    for i, text in enumerate(texts):
        line_of = [line for line, part in enumerate(text.splitlines(True) if "\x1c" not in text else [text]) for _ in part.encode()]
        want, at = {}, 0
        for token in plain.encode_ordinary(text):
            size = len(plain.decode_single_token_bytes(token))
            line = line_of[at if rule == "start" else at + size - 1]
            want[i, line] = want.get((i, line), 0) + 1
            at += size
        assert {k: n for k, n in got.items() if k[0] == i and n} == want


def test_allocation_rules():
    first, last, bounds = np.array([0, 2, 5]), np.array([1, 4, 6]), np.array([0, 3])
    assert token_counts.allocate(first, last, bounds, "start")[0].tolist() == [2, 1]
    assert token_counts.allocate(first, last, bounds, "end")[0].tolist() == [1, 2]
    assert token_counts.allocate(first, last, bounds, "most")[0].tolist() == [1, 2]
    assert token_counts.allocate(first, last, bounds, "start")[1].tolist() == [1, 0]

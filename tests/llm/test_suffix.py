"""Repeated byte strings against brute force over all strings."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from terrafold.llm import suffix


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    counts = Counter(r[p : p + length] for r in raw for p in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if counts[r[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(r)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rnd = random.Random(seed)

    def words(n):
        return " ".join("".join(rnd.choices("abcdéü", k=rnd.randint(1, 7))) for _ in range(n))

    shared = [words(rnd.randint(60, 200)) for _ in range(4)]
    texts = [words(rnd.randint(0, 250)) for _ in range(20)]
    for _ in range(30):
        t = rnd.choice(shared)
        a = rnd.randint(0, 120)
        b = a + rnd.choice([380, 398, 399, 400, 401, 402, 500, 700])
        texts.append(words(rnd.randint(0, 60)) + t[a:b] + words(rnd.randint(0, 60)))
    long = words(300)
    for _ in range(12):  # near copies: a letter differs here and there
        t = list(long)
        for k in rnd.sample(range(len(t)), 3):
            t[k] = "#"
        texts.append("".join(t))
    texts += [long, long, None, "", "x" * 399, "x" * 400, "y" * 401, "ab" * 700, "=" * 900 + long[:450], "é" * 300, "é" * 300, long[:250] * 3]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_are_those_of_brute_force(spark, seed):
    texts = corpus(seed)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, texts[3], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, rid int").repartition(3)
    got = suffix.remove_repeats(df).collect()
    want = brute([r[1] for r in rows], 400)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted((r[0] if r[0] is not None else -1, *w) for r, w in zip(rows, want, strict=True))


def test_empty_and_unmatched(spark):
    schema = "doc_id long, text string"
    assert suffix.remove_repeats(spark.createDataFrame([], schema)).count() == 0
    got = suffix.remove_repeats(spark.createDataFrame([(1, None), (2, "short")], schema)).collect()
    assert sorted((r["doc_id"], r["text"], r["n_removed"]) for r in got) == [(1, None, 0), (2, "short", 0)]


def test_segments_give_the_same_strings():
    rnd = np.random.default_rng(5)
    data = rnd.integers(97, 123, 5000).astype("u1")
    whole = [np.concatenate(x) for x in zip(*[g[:3] for g in suffix.gaps(data)], strict=True)]
    parts = [np.concatenate(x) for x in zip(*[g[:3] for g in suffix.gaps(data, segment=700)], strict=True)]
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(parts[1], parts[2], strict=True)])
    assert (covered == np.arange(len(data) - 399)).all()
    base = {p: b for b, lo, hi in zip(*whole, strict=True) for p in range(lo, hi + 1)}
    assert all(base[p] == b for b, lo, hi in zip(*parts, strict=True) for p in range(lo, hi + 1))


def test_names_of_names_are_sorted_until_they_cover_a_string(spark, monkeypatch):
    """Letters of one or two bytes: the recursion goes on, and the rows stay right."""
    levels, named = [], suffix._named
    monkeypatch.setattr(suffix, "_named", lambda rows, keys, stage, name: levels.append(name) or named(rows, keys, stage, name))
    texts = [*corpus(3), "x" * 700, "x" * 650, "abc" * 300]
    got = suffix.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted((k, *w) for k, w in enumerate(brute(texts, 400)))
    assert levels[:2] == ["names-3", "names-9"] and len(levels) >= 4


def test_neighbours_settle_strings_across_partitions(spark, monkeypatch):
    """Copies alone: all that is removed comes from adjacent suffixes, no string is compared."""
    rnd = random.Random(8)
    long = "".join(rnd.choices("abcdefgh ", k=6000))
    texts = [long] * 40 + ["".join(rnd.choices("ijkl", k=900)) for _ in range(5)]
    monkeypatch.setattr(suffix, "strings", lambda *a: (_ for _ in ()).throw(AssertionError("a string was compared")))
    got = suffix.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(k, 6000 if k < 40 else 0) for k in range(45)]


def brute_words(texts, length, words):
    """What is left of each text without strings of bytes and runs of words that repeat."""
    raw = [(t or "").encode() for t in texts]
    at = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", r)] for r in raw]
    runs = [[tuple(r[a:b] for a, b in x[k : k + words]) for k in range(len(x) - words + 1)] for r, x in zip(raw, at, strict=True)]
    strings = Counter(r[p : p + length] for r in raw for p in range(len(r) - length + 1))
    counts = Counter(run for own in runs for run in own)
    out = []
    for r, x, own in zip(raw, at, runs, strict=True):
        gone = bytearray(len(r))
        for a, b in [(p, p + length) for p in range(len(r) - length + 1) if strings[r[p : p + length]] > 1] + [(x[k][0], x[k + words - 1][1]) for k, run in enumerate(own) if counts[run] > 1]:
            gone[a:b] = b"\1" * (b - a)
        out.append(bytes(b for b, g in zip(r, gone, strict=True) if not g).decode(errors="ignore"))
    return out


def test_runs_of_words_are_those_of_brute_force(spark):
    rnd = random.Random(6)

    def words(n):
        return rnd.choice([" ", "\n", "  "]).join("".join(rnd.choices("abcdéü\u00a0", k=rnd.randint(1, 5))) for _ in range(n))

    shared = [words(150).split(" ") for _ in range(4)]
    texts = [words(rnd.randint(0, 200)) for _ in range(20)]
    for _ in range(60):
        a = rnd.randint(0, 60)
        texts.append(" ".join([words(rnd.randint(0, 40)), *rnd.choice(shared)[a : a + rnd.choice([40, 49, 50, 51, 52, 60, 80])], words(rnd.randint(0, 40))]))
    texts += ["a b " * 60, "q " * 51, "q " * 50 + "r", None, "", "z" * 900, "é" * 450, *corpus(7)]
    got = suffix.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), words=51).collect()
    want = brute_words(texts, 400, 51)
    assert [r["text"] or "" for r in sorted(got, key=lambda r: r["doc_id"])] == want


@pytest.mark.parametrize("length", [18, 60])
def test_shorter_strings_are_those_of_brute_force(spark, length):
    texts = corpus(4)
    got = suffix.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), length).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted((k, *w) for k, w in enumerate(brute(texts, length)))


def test_too_short_a_length_is_refused(spark):
    with pytest.raises(ValueError):
        suffix.remove_repeats(spark.createDataFrame([(1, "text")], "doc_id long, text string"), 17)


def test_segments_give_the_same_letters():
    """Each base once and in order, with the letters that follow it over the ends of segments."""
    rnd = np.random.default_rng(6)
    data = rnd.integers(97, 123, 5000).astype("u1")

    def rows(segment):
        out = []
        for at, base, lo, hi, found, checks, spans, fixed in suffix.letters(data, segment=segment):
            out += [(at + k, base[k], lo[k], hi[k], *found[k : k + 3], checks[k], spans[k], fixed[k]) for k in range(len(base))]
        return out

    whole = rows(None)
    assert [r[0] for r in whole] == list(range(len(whole))) and whole[0][1] == 0 and whole[-1][1] == len(data) - 16
    for segment in (1, 256, 300, 700, 4601):
        assert rows(segment) == whole


def test_columns_with_clashing_names_are_kept(spark):
    text = "some words that repeat " * 30
    rows = [(1, text, "a", 5, "r", 7), (2, text + "x", "b", 6, "s", 8), (3, "short", None, 7, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid string, n_bytes int, ranges string, n_chars int")
    got = {r["doc_id"]: r for r in suffix.without_repeats(df, words=51).collect()}
    assert suffix.without_repeats(df).columns == df.columns
    assert [(got[k]["rid"], got[k]["n_bytes"], got[k]["ranges"]) for k in (1, 2, 3)] == [("a", 5, "r"), ("b", 6, "s"), (None, 7, None)]
    assert got[3]["text"] == "short" and got[3]["n_chars"] is None and got[1]["n_chars"] == len(got[1]["text"]) < 30


def test_removed_bytes_with_small_segments(spark, monkeypatch):
    rnd = random.Random(9)
    letters = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    texts = []
    for k in range(60):  # passages that start around the ends of segments in one copy only
        passage = letters(rnd.randint(400, 480))
        texts += [letters(rnd.randint(120, 420)) + passage + letters(400), letters(rnd.randint(0, 40)) + passage + letters(rnd.randint(0, 30))]
    monkeypatch.setattr(suffix, "_SEGMENT", 300)
    got = suffix.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted((k, *w) for k, w in enumerate(brute(texts, 400)))

"""Encoding, packing and token files against the plain tokenizer."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import packing, token_files
from terrafold.llm.encoder import Encoder, default_path

ODD = ["", " ", "  a", "a  b", "a\n\nb c", "it's we'll I'M", "x\x1cy z", "été a", "日本 語", "a b", "tab\tx \n y", "ΣΑΣ Σ", "<|endoftext|> a", "a <|startoftext|>b", "ends. with, marks!! ?", " lead", "trail ", "1234 5x", "İstanbul I", "\x85a b", "ß ẞ ñandú Ñ", "a\r\nb"]


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_cached_ids_are_the_tokenizers_own(name, kind):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_path(name))
    plain.encode_special_tokens = True
    ours, rnd = Encoder(default_path(name), kind), random.Random(1)
    texts = ODD + ["".join(rnd.choices(["the", "Ñu", " ", " ", "\n", ".", "'s", "9", "ö", "'", "é", "\t", "Haus", "!"], k=rnd.randint(1, 40))) for _ in range(400)]
    for text in texts:
        assert list(np.frombuffer(ours.ids(text), "<u2")) == plain.encode(text, add_special_tokens=False).ids, repr(text)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, part int")


def expected(rows, name):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(default_path(name))
    plain.encode_special_tokens = True
    return [(d, [*plain.encode(t or "", add_special_tokens=False).ids, 0]) for d, t, *_ in rows]


def test_token_files_round_trip(spark):
    rows = [(7, "seven words", "x", 1), (3, None, None, 2), (5, "", "y", 3), (None, "no id", "z", 4), (9, "long word " * 3000, "q", 5), (7, "seven words", "x", 1)]
    got = token_files.token_files(frame(spark, rows)).collect()
    want, start = [], 0
    for d, ids in sorted(expected(rows, "byte_bpe_50k.json"), key=lambda x: (x[0] is not None, x[0] or 0)):
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.token_files(frame(spark, [])).count() == 0


def test_fullest_is_the_best_subset_sum():
    rnd = random.Random(2)
    for _ in range(60):
        counts = {rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(4)}
        items = [n for n, c in counts.items() for _ in range(c)]
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= 40 and (not c or max(c) == max(items)))
        chosen = packing.fullest(counts, 40)
        assert sum(n * k for n, k in chosen.items()) == best
        assert all(k <= counts[n] for n, k in chosen.items())


def test_pack_places_every_piece(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(["word"] * rnd.choice([0, 3, 50, 700, 2047, 2048, 5000])), "x", 1) for i in range(120)] + [(None, "no id", "x", 1), (200, None, "x", 1), (3, "again", "x", 1)]
    out = packing.pack(frame(spark, rows)).toPandas()
    want = sum(len(ids) for _, ids in expected(rows, "word_bpe_49k.json"))
    assert out["length"].sum() == want and out["length"].max() <= 2048
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == list(np.cumsum([0, *g["length"]])[:-1]) and g["length"].sum() <= 2048
        assert (g["sequence_fill"] == g["length"].sum()).all()
    assert out["sequence_id"].nunique() <= np.ceil(want / 2048) * 1.05 + 1
    for d, ids in expected(rows[:40], "word_bpe_49k.json"):
        own = out[(out.doc_id == d) & (d != 3)].sort_values("piece")
        for _, p in own.iterrows():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[int(p.start) : int(p.start + p.length)], "<u4").tobytes())
    assert packing.pack(frame(spark, []).where(F.lit(True))).count() == 0


def test_blanks_are_judged_apart_and_units_once():
    """Texts with odd blanks give the library's ids; what follows a space is kept without it, within the bound."""
    path = default_path("byte_bpe_50k.json")
    enc, rnd = Encoder(path, "bytes", 40), random.Random(6)
    for _ in range(400):
        text = "".join(rnd.choice(["ab", "Cd,", "7", " ", " ", "\n", "\t", "\x85", "\x1d", " ", "é"]) for _ in range(rnd.randint(0, 12)))
        want = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert list(memoryview(enc.ids(text)).cast("H")) == want, repr(text)
    assert enc.spaced and len(enc) + len(enc.spaced) <= 40

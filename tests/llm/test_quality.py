"""Rules, decontamination, co-training and the language model on small tables."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import attention_lm, cotraining, decontamination, rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"
LABELS = "doc_id long, quality int, toxic int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x", "y") for d, t in rows], DOCS)


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, k = len(words), len(hit)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), k, n < 50 or 100 * k > 50 * n)


def sample_texts():
    rnd = random.Random(11)
    vocabulary = [f"w{k}" for k in range(300)] + ["é", "日本", "#tag", "a|b"]
    texts = [None, "", " \t\x0b\x0c\r\n", "one", "a b a b a b", "x x x x", "a\na\n\n \na", " lead  tail ", "\x1c\x85 odd space", "long " * 30000]
    for _ in range(40):
        words = rnd.choices(vocabulary, k=rnd.randint(40, 120))
        if rnd.random() < 0.5:
            words[20:20] = words[5:12]
        texts.append("".join(w + rnd.choice([" ", " ", "\n", "\t"]) for w in words))
    return texts


def test_statistics_are_those_of_brute_force(spark):
    texts = sample_texts()
    rows = list(enumerate(texts)) + [(None, texts[12]), (3, texts[3])]
    short = [(d, t) for d, t in rows if len(t or "") < 50_000]
    out = rules.quality_rules(frame(spark, rows), spark.createDataFrame([], LABELS))
    got = [tuple(r)[:7] for r in out.collect()]
    assert len(got) == len(rows)
    want = [(d, *brute_statistics(t)) for d, t in short]
    assert sorted((x for x in got if x[1] < 20_000), key=str) == sorted(want, key=str)
    assert [x[5] for x in got if x[1] == 30000] == [30000]
    assert out.where(F.col("kept") == F.col("base_failed")).count() == 0


def test_rules_find_a_planted_threshold(spark):
    rnd = random.Random(3)
    rows, labels = [], []
    for k in range(600):
        words = [f"v{rnd.randint(0, 5000)}" for _ in range(80)]
        bad = k % 4 == 0
        if bad:
            words = [w + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(not bad), 0))
    labels += [(None, 0, 0), (5, None, None)]
    out = {r["doc_id"]: r["kept"] for r in rules.quality_rules(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    assert sum(out[k] == (k % 4 != 0) for k in out) / len(out) > 0.98
    assert rules.quality_rules(frame(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0


BENCH = [
    (1, "A train leaves Paris at 9 am and travels 300 km before it stops near the old northern station."),
    (2, "The quick brown fox jumps over the lazy dog while seven wizards mix potions in a quiet room."),
    (3, "too short"),
    (4, None),
    (5, "five plain words stand here"),
]


def test_leaks(spark):
    benchmark = spark.createDataFrame(BENCH, "item_id long, text string")
    filler = "Nothing of the kind is said in this text at all. " * 5
    rows = [
        (10, filler + BENCH[0][1] + filler),
        (11, filler + BENCH[0][1].replace("Paris", "Lyon").replace("300", "450").replace("9", "11") + filler),
        (12, BENCH[1][1].upper()),
        (13, filler),
        (14, BENCH[1][1][:40] + filler),
        (15, None),
        (16, "too short"),
        (17, "here five plain words stand here now"),
        (None, BENCH[1][1]),
        (10, filler + BENCH[0][1] + filler),
    ]
    for small in (0, 200_000):
        got = {(r["doc_id"], r["item_id"]): r["exact"] for r in decontamination.leaks(frame(spark, rows), benchmark, small=small).collect()}
        assert got == {(10, 1): True, (11, 1): False, (12, 2): True, (16, 3): True, (17, 5): True, (None, 2): True}
    assert decontamination.leaks(frame(spark, []), benchmark).count() == 0
    assert decontamination.leaks(frame(spark, rows), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_placeholders_are_judged_from_item_to_document(spark):
    item = [(1, "Give 3 apples to Anna and 5 apples to Bert then count what is left over"), (2, "He packs 2 boxes and waits for 2 hours before the train leaves again"), (3, "1 2 3 4 5 6"), (4, "Why Anna"), (5, "...")]
    docs = [
        (1, "Give 7 apples to Clara and 9 apples to Dora then count what is left over"),
        (2, "Give 7 apples to Clara and 7 apples to Clara then count what is left over"),
        (3, "He packs 2 boxes and waits for 3 hours before the train leaves again"),
        (4, "He packs 3 boxes and waits for 4 hours before the train leaves again"),
        (5, "He packs 2 boxes and waits for 2 hours before the train leaves again"),
        (6, "then come 1 2 3 4 5 6 and more"),
        (7, "then come 1 2 3 4 5 7 and more"),
        (8, "why, Anna?"),
        (9, "why Anna left"),
        (10, None),
    ]
    got = decontamination.leaks(frame(spark, docs), spark.createDataFrame(item, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["exact"], r["one_to_one"]) for r in got) == [(1, 1, False, True), (2, 1, False, False), (3, 2, False, False), (4, 2, False, False), (5, 2, True, True), (6, 3, True, True), (8, 4, True, True)]


def test_reparameterised_items_are_recalled(spark):
    """Items with random parameters, copies with others: how many are found, by a plain rule."""
    rnd = random.Random(12)
    plain = [w for w in "the a train boat farmer river house street market basket paper garden window morning evening letter answer kitchen bridge village".split()]
    names = ["Anna", "Bert", "Clara", "Dora", "Emil", "Finn"]
    items, docs = [], []
    for k in range(40):
        words = [rnd.choice(plain) for _ in range(rnd.randint(12, 24))]
        at = rnd.sample(range(1, len(words)), 3)
        fill = lambda: [str(rnd.randint(2, 9)), str(rnd.randint(2, 9)), rnd.choice(names)]  # noqa: E731, B023

        def text(values, words=words, at=at):
            own = list(words)
            for i, v in zip(at, values, strict=True):
                own[i] = v
            return " ".join(own)

        items.append((k, text(fill())))
        docs.append((k, "unrelated words stand before it " + text(fill()) + " and unrelated words stand behind it"))
        docs.append((100 + k, " ".join(rnd.choice(plain) for _ in range(30))))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(k, k) for k in range(40)}


def test_cotraining_on_held_out_labels(spark):
    rnd = random.Random(5)
    rows, labels, truth = [], [], {}
    for k in range(700):
        words = [f"w{rnd.randint(0, 400)}" for _ in range(60)]
        truth[k] = k % 5 == 0
        if truth[k]:
            words[rnd.randrange(60)] = rnd.choice(["vile", "nasty", "horrid"])
        rows.append((k, " ".join(words)))
        if k % 2 == 0 or k % 5 == 0 and k % 3:
            labels.append((k, 1, int(truth[k])))
    rows += [(None, None), (3, rows[3][1])]
    labels += [(None, 1, 1), (2, None, None)]
    out = cotraining.classify(frame(spark, rows), spark.createDataFrame(labels, LABELS), ["doc_id", "text", "kept", "score"]).collect()
    assert len(out) == len(rows)
    known = {k for k, _, _ in labels}
    test = [r for r in out if r["doc_id"] is not None and r["doc_id"] not in known]
    assert np.mean([r["kept"] != truth[r["doc_id"]] for r in test]) > 0.95
    none = cotraining.classify(frame(spark, rows[:5]), spark.createDataFrame([], LABELS)).collect()
    assert all(r["kept"] and r["score"] == 0 for r in none)
    assert cotraining.classify(frame(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0


def test_views_teach_each_other_round_by_round(spark):
    """Two views that are independent given the label, few labels: both views get labels, more
    in every round, and what they learn from each other makes them better."""
    rnd = random.Random(21)
    rows, truth = [], {}
    for k in range(900):
        bad = truth[k] = rnd.random() < 0.3
        words = [f"w{rnd.randint(0, 60) + (30 if bad and rnd.random() < 0.35 else 0)}" for _ in range(25)]
        source = rnd.choice(["s1", "s2", "s3"] if bad == (rnd.random() < 0.85) else ["s4", "s5", "s6"])
        rows.append((k, " ".join(words), rnd.choice(["en", "de"]), source, 100))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, 1, int(truth[k])) for k in range(0, 900, 9)], LABELS)
    seen = cotraining.viewed(docs, ["doc_id"]).cache()
    y = np.array([truth[k] for k in range(900) if k % 9])

    def auc(scores):
        order = np.argsort(np.argsort(scores, kind="stable"))
        return (order[y].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (~y).sum())

    by_round = []
    for rounds in range(4):
        log = []
        model = cotraining.fit(seen, labels, rounds=rounds, log=log)
        got = {r["row"]["doc_id"]: r for r in cotraining.score(seen, model).collect()}
        by_round.append({c: auc(np.array([got[k][c] for k in range(900) if k % 9])) for c in ("text_score", "meta_score", "score")})
        assert len(log) == rounds
        steps = list(zip([{"text": 0, "meta": 0}, *log], log, strict=False))
        assert all(a[k] <= b[k] for a, b in steps for k in ("text", "meta")) and all(sum(a.values()) < sum(b.values()) for a, b in steps)
        assert not log or min(log[0].values()) > 0
    assert by_round[3]["text_score"] > by_round[0]["text_score"], by_round
    assert by_round[3]["score"] > max(by_round[3]["text_score"], by_round[3]["meta_score"]) - 0.02, by_round
    assert by_round[3]["score"] > by_round[0]["score"] + 0.05, by_round


def test_cotraining_reads_long_texts_and_every_unlabelled_row(spark, monkeypatch):
    rnd = random.Random(15)
    rows = [(k, " ".join(rnd.choice(["good", "fine", "plain", "text"]) for _ in range(30)) + (" vile" if k % 4 == 0 else "")) for k in range(200)]
    rows += [(900, "fine text " * 200_000), (901, "fine text " * 200_000 + "vile"), (902, None), (902, "vile"), (None, "vile")]
    labels = [(k, 1, int(k % 4 == 0)) for k in range(100)]
    seen, surest = [], cotraining._surest
    monkeypatch.setattr(cotraining, "_surest", lambda others, *a: seen.append(others.count()) or surest(others, *a))
    out = cotraining.classify(frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows) and seen and set(seen) == {104}
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert kept[900] and not kept[901] and all(kept[k] == (k % 4 != 0) for k in range(100, 200))


def test_leaks_in_long_texts(spark):
    filler = "unrelated words stand here without end " * 40_000
    docs = [(1, filler + BENCH[0][1].replace("300", "512") + " " + filler), (2, filler)]
    got = [(r["doc_id"], r["item_id"], r["exact"]) for r in decontamination.leaks(frame(spark, docs), spark.createDataFrame(BENCH, "item_id long, text string")).collect()]
    assert got == [(1, 1, False)]


def weights_of(rng, n, kind="f8"):
    half, dim, classes = attention_lm._HALF, attention_lm._DIM, attention_lm._CLASSES
    shapes = {"kv1": (n, 2 * dim), "kv2": (n, 2 * dim), "qr": (n, dim + classes), "o": (dim, classes), "b": (2 * half,)}
    return {k: rng.normal(0, 1, s).astype(kind) for k, s in shapes.items()}


def test_gradient_is_that_of_differences():
    rng = np.random.default_rng(1)
    n, half = 12, attention_lm._HALF
    w = weights_of(rng, n)
    g1, g2, lead = rng.integers(0, n, (4, half)), rng.integers(0, n, (4, half)), np.array([0.0, 1.0, 1.0])
    target = rng.integers(-1, attention_lm._CLASSES, (3, half))
    g, loss = attention_lm.gradient(w, g1, g2, lead, target)
    for name in w:
        whole = np.zeros_like(w[name])
        rows, values = g[name]
        whole[rows] = values
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in w[name].shape)
            moved = {k: v.copy() for k, v in w.items()}
            moved[name][at] += 1e-5
            assert abs((attention_lm.gradient(moved, g1, g2, lead, target)[1] - loss) / 1e-5 - whole[at]) < 1e-4, name


def test_scores(spark):
    rnd = random.Random(9)
    rows = [(k, " ".join(rnd.choices(["the", "THE", "red", "house", "on", "hill", "été", "rare%d" % k], k=rnd.randint(0, 90)))) for k in range(60)]
    rows += [(None, "the red"), (100, None), (101, "word " * 5000), (3, rows[3][1])]
    out = attention_lm.score_texts(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    words = lambda t: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in (t or "").split()] + [None]
    held = lambda d: zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2
    counts: dict = {}
    for d, t in rows:
        if not held(d):
            for w in words(t):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(d), held(d), len(words(t)), sum(w in counts for w in words(t)), n, round(sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words(t)), 6)) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert attention_lm.score_texts(frame(spark, [])).count() == 0


class Given:
    """A pack made by hand."""

    def __init__(self, texts, held=None):
        ids = [list(w) for t in texts for w in [*t, [attention_lm._END]]]
        self.size = np.array([len(t) + 1 for t in texts], "<i4").tobytes()
        self.held = np.array(held or [False] * len(texts), "u1").tobytes()
        self.ids, self.lens = np.concatenate(ids).astype("<u2").tobytes(), np.array([len(w) for w in ids], "<u4").tobytes()


def small_model(rng):
    first, inner, top = np.ones(attention_lm._IDS, "i8"), np.ones(attention_lm._IDS, "i8"), np.sort(np.append(np.arange(40), attention_lm._END))
    slot = np.full(attention_lm._IDS, len(top), "i4")
    slot[top] = np.arange(len(top))
    return attention_lm.counts_model(first, inner, rng.integers(0, 9, (len(top) + 1, len(top) + 1)).astype(float), top, slot, slot)


def test_each_word_is_scored_once_by_masked_attention():
    """Against loops over words and over the words before them."""
    rng = np.random.default_rng(2)
    half, dim = attention_lm._HALF, attention_lm._DIM
    texts = [[list(rng.integers(0, 60, rng.integers(1, 4))) for _ in range(k)] for k in (0, 5, 31, 32, 33, 200)]
    tables, _ = small_model(rng)
    w = weights_of(rng, tables["n"] + 1, "f4")
    pack = attention_lm.Pack(Given(texts))
    counts = rng.integers(0, 5, len(pack.first)).astype(float)
    numbers = {"tokens": 1000, "distinct": 90, "docs": 6}
    known, base, score = attention_lm.pack_scores(pack, counts, tables, w, numbers, 0.5)
    at, end = 0, attention_lm._END
    for k, text in enumerate(texts):
        words, total, plain = [*text, [end]], 0.0, 0.0
        given = [(tables["slot"][end], tables["n"])] + [(tables["slot"][x[0]], tables["slot2"][x[-1]]) for x in words[:-1]]
        for t, word in enumerate(words):
            seen = range(max(0, (t // half - 1) * half), t + 1)
            kv = np.array([w["kv1"][given[j][0]] + w["kv2"][given[j][1]] for j in seen])
            row = w["qr"][given[t][0]]
            p = np.exp(np.minimum(kv[:, :dim] @ row[:dim] / math.sqrt(dim) + np.array([w["b"][t - j] for j in seen]), 30))
            logits = row[dim:] + (p / p.sum()) @ kv[:, dim:] @ w["o"]
            logits -= np.log(np.exp(logits).sum())
            slot, c = tables["slot"][word[0]], counts[at]
            inside = tables["within"][given[t][0], slot] if slot < tables["n"] else tables["rest"][word[0]]
            lp = logits[tables["class"][slot]] + inside
            if word[0] != end:
                spelled = math.exp(sum(float(tables["goes_on"][x]) for x in word[1:]) + tables["stop"])
                lp += math.log((c + 2 * spelled) / (tables["first"][word[0]] + 2))
            unigram = (c + 1) / (numbers["tokens"] + numbers["distinct"] + 1)
            total, plain, at = total + math.log10(0.5 * unigram + 0.5 * math.exp(lp)), plain + math.log10(unigram), at + 1
        assert abs(score[k] - total) < 1e-2 and abs(base[k] - plain) < 1e-9


def test_every_window_is_learned_from():
    """A word in the middle of a long text changes the weights, wherever it stands."""
    rng, half = np.random.default_rng(4), attention_lm._HALF
    tables, start = small_model(rng)
    text = rng.integers(0, 30, 40 * half).astype("<u2")

    def trained(ids):
        w = {k: v.copy() for k, v in start.items()}
        assert attention_lm._worked(w, {k: np.full_like(v, 1e-6) for k, v in w.items()}, [ids], [ids], tables, 8) == 40
        return w

    before = trained(text)
    for window in (0, 1, 7, 17, 30, 38):
        other = text.copy()
        other[window * half + 5] = 35  # an id that stands nowhere else
        assert not np.allclose(trained(other)["qr"][35], before["qr"][35]), window


def test_batches_of_packs_are_small(spark, monkeypatch):
    """Rows of packs are large: neither a row group nor a batch for Python holds many, and a
    worker's words go when it serves another step."""
    import pyarrow.parquet as pq

    name, seen, whole = "spark.sql.execution.arrow.maxBytesPerBatch", [], attention_lm.word_counts
    before = spark.conf.get(name)
    monkeypatch.setattr(attention_lm, "_PACK", 2_000)
    monkeypatch.setattr(attention_lm, "_GROUP", 20_000)

    def counted(packed, stage, buckets):
        groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in packed.inputFiles()]
        rows = packed.select("pack").mapInPandas(lambda batches: (pdf for pdf in batches), "pack long")
        per = packed.mapInPandas(lambda batches: (pdf.head(1)[["pack"]].assign(pack=len(pdf)) for pdf in batches), "pack long").agg({"pack": "max"}).first()[0]
        seen.append((spark.conf.get(name), max(g.row_group(k).num_rows for g in groups for k in range(g.num_row_groups)), per, rows.count()))
        return whole(packed, stage, buckets)

    monkeypatch.setattr(attention_lm, "word_counts", counted)
    out = attention_lm.score_texts(frame(spark, [(k, f"word{k} " * 50 + "é" * (900 if k == 7 else 1)) for k in range(4_000)]).coalesce(1))
    assert out.count() == 4_000 and out.where("n_tokens <> 52").count() == 0
    (batch, group, together, packs), = seen
    assert int(batch) == 20_000 and spark.conf.get(name) == before and packs > 50 and together < 10 and group < packs / 2


def test_scores_do_not_depend_on_tasks_or_packs(spark, monkeypatch):
    rnd = random.Random(12)
    words = ["the", "red", "house", "on", "hill", "unbelievable", "thing", "zyxwv"]
    rows = [(k, " ".join(rnd.choices(words, k=rnd.randint(0, 150)))) for k in range(80)]
    scores = []
    for parts, size in ((1, 1_000_000), (5, 1_000_000), (3, 500)):
        monkeypatch.setattr(attention_lm, "_PACK", size)
        monkeypatch.setattr(attention_lm, "_BLOCK", 2_000)
        out = attention_lm.score_texts(frame(spark, rows).repartition(parts)).collect()
        scores.append({r["doc_id"]: (r["n_known"], r["base_score"], r["score"]) for r in out})
    for other in scores[1:]:
        assert all(np.allclose(scores[0][k], other[k], rtol=1e-3) for k in scores[0])


@pytest.mark.parametrize("folder", ["sf0.01"])
def test_held_out_texts_score_above_the_base(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    got = attention_lm.score_texts(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (got["s"] - got["b"]) / got["n"] > 0.1


def test_parts_of_a_step_add_up_to_its_gradient():
    rng, half, n = np.random.default_rng(4), attention_lm._HALF, 12
    dim, classes = attention_lm._DIM, attention_lm._CLASSES
    w = {"kv1": rng.normal(size=(n, 2 * dim)), "kv2": rng.normal(size=(n, 2 * dim)), "qr": rng.normal(size=(n, dim + classes)), "o": rng.normal(size=(dim, classes)), "b": rng.normal(size=2 * half)}
    w = {k: x.astype("f4") for k, x in w.items()}
    g1, g2 = rng.integers(0, n, (8, half)), rng.integers(0, n, (8, half))
    lead, target = np.array([0, 1, 1, 0, 1, 1, 1], "f4"), rng.integers(-1, classes, (7, half))
    whole, loss = attention_lm.gradient(w, g1, g2, lead, target, part=7)
    parts, same = attention_lm.gradient(w, g1, g2, lead, target, part=3)
    assert abs(loss - same) < 1e-6
    for name, (rows, values) in whole.items():
        assert (rows == parts[name][0]).all() and np.allclose(values, parts[name][1], atol=1e-6), name


def test_units_of_words_are_those_of_each_alone():
    path = attention_lm.default_path("byte_bpe_50k.tiktoken")
    texts = [["a", "of", "a", "x y", " ", "\x1c", "äö"], [], ["of", "q\x85", "7"]]
    texts = [[w.encode() for w in t] for t in texts]
    words = attention_lm.Words(path, most=3)
    alone = attention_lm.Words(path, most=0)
    for _ in range(2):  # what is known by then gives the same
        assert words.units(texts) == [[alone[w] for w in t] for t in texts]

"""Scores of whole texts by a small causal self-attention model over subwords.

A text is its words, lower-cased A to Z, as subword ids of a public tokenizer,
then one end. A word's probability has two parts. One attention layer over the 64
words before (each by its first and last subword id) gives the class of the word's
first id, corpus counts give the id within its class after the first id of the
word before, and the counts of all words of the corpus give the word among those
that begin so. Mixed with it is the unigram over words, as in the base score; both
hold every unknown word for the one unknown word.

Word counts cover the whole vocabulary of all training documents and grow with
them: each pack of documents asks for the counts of its distinct words, so a
frequent word is one entry a pack. The size of the attention layer is fixed. It is
trained in numpy on every window of the training documents: these are dealt by
their content and id into blocks of about 2 million words, each block is worked off in a
fixed order from the same start, and the weights are averaged. The model depends
on the documents alone, not on the number of tasks.

Windows overlap by half: of each only the second half is scored, with masked
attention for many windows at once, so each word is scored once with 32 to 64
words of context. Packs hold about a million words and longer texts are cut into
several, so memory is bounded by words, not rows: packs travel between the JVM and
Python a few at a time, and files of packs are read in row groups of that size. The
base score is an add-one unigram model over words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import small_batches
from .common import alone, held_by, new_path
from .encoder import default_path

_HALF, _DIM, _TOP, _CLASSES, _END = 32, 16, 2048, 48, 50256
_IDS = 1 << 16
_PACK, _PIECE, _BLOCK, _BUCKET = 1_000_000, 500_000, 2_000_000, 1_000_000
_GROUP = 8 << 20  # bytes of packs that are read, or sent to Python, at once
_PACKED = "pack long, rid binary, doc binary, missing binary, held binary, size binary, ids binary, lens binary"
_NAMES = ("kv1", "kv2", "qr", "o", "b")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ x >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)


_MIXED = _mixed(np.arange(1, _IDS + 1, dtype="u8") * _ODD)


class Words(dict):
    """word in bytes -> its ids as unsigned 16-bit integers; bounded."""

    def __init__(self, path: str, most: int = 300_000):
        import base64

        import public_tokenizers
        import tiktoken

        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if max(ranks.values()) >= _END:
            raise ValueError("the id of the end is taken")
        self.encoding, self.most = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), most
        self.begins = np.zeros(_IDS, bool)
        self.begins[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True

    def __missing__(self, word: bytes) -> bytes:
        return self.encoding.encode_to_numpy(" " + word.decode()).astype("<u2").tobytes()

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words: those without a blank of any script are encoded together,
        since each of them, and nothing else, begins with a space."""
        found, every = {}, list(words)
        for a in range(0, len(every), 20_000):
            plain = every[a : a + 20_000]
            text = b" ".join(plain).decode()
            if " ".join(text.split()) != text:  # some have blanks of other scripts
                split = {w: w.decode() for w in plain}
                found |= {w: self[w] for w, t in split.items() if t.split() != [t]}
                plain = [w for w in plain if w not in found]
                text = b" ".join(plain).decode()
            if not plain:
                continue
            ids = self.encoding.encode_to_numpy(" " + text).astype("<u2")
            starts = np.flatnonzero(self.begins[ids])
            cuts = (np.append(starts, len(ids)) * 2).tolist()
            raw = ids.tobytes()
            found |= zip(plain, (raw[x:y] for x, y in zip(cuts, cuts[1:], strict=False)), strict=True)
        for w in found.keys() if len(self) < self.most else ():
            self[w] = found[w]
        return found

    def units(self, texts: list[list[bytes]]) -> list[list[bytes]]:
        """Ids of the words of each text. Each word is looked up once; what is not known is learned together."""
        made = [[*map(self.get, words)] for words in texts]
        new = self.learn({w for words, units in zip(texts, made, strict=True) for w, u in zip(words, units, strict=True) if u is None})
        if new:
            made = [[u or new[w] for w, u in zip(words, units, strict=True)] for words, units in zip(texts, made, strict=True)]
        return made


_LOADED: dict[str, Words] = held_by("words", {})


def held_out(doc: int) -> bool:
    return zlib.crc32(str(doc).encode()) % 7 == 2


def packs(docs: DataFrame, path: str) -> DataFrame:
    """Texts as ids, many to a row; texts of over half a million words in pieces."""

    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        alone("words")
        words = _LOADED[path] if path in _LOADED else _LOADED.setdefault(path, Words(path))
        end, first = np.array([_END], "<u2").tobytes(), TaskContext.get().partitionId() << 32
        names, made, n, count = [f.split()[0] for f in _PACKED.split(", ")], [], 0, 0

        def pack():
            rid, doc, missing, held, size, ids, lens = zip(*made, strict=True)
            whole = [np.array(x, t).tobytes() for x, t in ((rid, "<i8"), (doc, "<i8"), (missing, "u1"), (held, "u1"), (size, "<i4"))]
            lens = np.concatenate(lens)  # of a byte each, but where a word has many ids
            return pd.DataFrame([(first + count, *whole, b"".join(ids), lens.astype("<u4" if lens.max() > 255 else "u1").tobytes())], columns=names)

        def texts(pdf):
            rows, n = [], 0
            for rid, doc, missing, text in zip(pdf["rid"], pdf["doc_id"], pdf["missing"], pdf["text"], strict=True):
                rows.append((rid, doc, missing, text.encode().lower().split()))
                n += len(rows[-1][3])
                if n > 100_000:
                    yield rows
                    rows, n = [], 0
            yield rows

        for rows in (rows for pdf in batches for rows in texts(pdf)):
            for (rid, doc, missing, _), units in zip(rows, words.units([r[3] for r in rows]), strict=True):
                units.append(end)
                for a in range(0, len(units), _PIECE):
                    own = units[a : a + _PIECE]
                    sizes = np.fromiter(map(len, own), "<u4", len(own)) // 2
                    made.append((rid, doc, missing, not missing and held_out(doc), len(own), b"".join(own), sizes))
                    n += len(own)
                    if n >= _PACK:
                        yield pack()
                        made, n, count = [], 0, count + 1
        if made:
            yield pack()

    doc = F.col("doc_id").cast("long")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.coalesce(doc, F.lit(0)).alias("doc_id"), doc.isNull().alias("missing"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, _PACKED)


class Pack:
    """A row of packed texts: words by their first and last id and where they stand."""

    def __init__(self, row):
        self.size = np.frombuffer(row.size, "<i4").astype("i8")
        self.held = np.frombuffer(row.held, "?")
        self.ids, self.lens = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.lens, f"<u{len(row.lens) // self.size.sum()}").astype("i8")
        self.starts = np.cumsum(self.lens) - self.lens
        self.first, self.last = self.ids[self.starts], self.ids[self.starts + self.lens - 1]
        self.real = self.first != _END
        self.train = np.repeat(~self.held, self.size)

    def parts(self, most: int = 200_000):
        """The pack in parts of whole texts with about ``most`` words, and their first word."""
        ends, a = np.cumsum(self.size), 0
        while a < len(self.size):
            begin = int(ends[a] - self.size[a])
            b = max(a + 1, int(np.searchsorted(ends, begin + most, "right")))
            own, part = slice(begin, int(ends[b - 1])), object.__new__(Pack)
            first, last = self.starts[begin], self.starts[own.stop - 1] + self.lens[own.stop - 1]
            part.size, part.held, part.ids, part.lens = self.size[a:b], self.held[a:b], self.ids[first:last], self.lens[own]
            part.starts, part.first, part.last, part.real, part.train = self.starts[own] - first, self.first[own], self.last[own], self.real[own], self.train[own]
            yield part, own
            a = b

    def words(self) -> np.ndarray:
        """A 64-bit hash of the ids of each word."""
        place = np.arange(len(self.ids), dtype="i4") - np.repeat(self.starts.astype("i4"), self.lens)
        factors = _mixed(np.arange(1, int(place.max(initial=0)) + 2, dtype="u8") * _ODD) | np.uint64(1)
        return _mixed(np.add.reduceat(_MIXED[self.ids] * factors[place], self.starts))


def _rows(batches):
    alone("packs")
    for pdf in batches:
        yield from pdf.itertuples(index=False)


def word_counts(packed: DataFrame, stage, buckets: int) -> tuple[DataFrame, int]:
    """pack, bucket and the training counts of the pack's distinct words in that
    bucket, in the order of their hashes; and the number of training words that
    differ. A pack asks once for each of its words."""

    def ask(batches):
        import pandas as pd

        for row in _rows(batches):
            pack = Pack(row)
            distinct, of = np.unique(pack.words()[pack.real], return_inverse=True)
            times = np.bincount(of, pack.train[pack.real], len(distinct)).astype("<i8")
            bucket = (distinct % np.uint64(buckets)).astype("i8")
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            words, times = distinct[order], times[order].astype("<u4")
            yield pd.DataFrame([(b, row.pack, words[cuts[b] : cuts[b + 1]].tobytes(), times[cuts[b] : cuts[b + 1]].tobytes()) for b in range(buckets) if cuts[b + 1] > cuts[b]], columns=["bucket", "pack", "words", "times"])

    def add(pdf):
        import pandas as pd

        words, times = np.frombuffer(b"".join(pdf["words"]), "<u8"), np.frombuffer(b"".join(pdf["times"]), "<u4")
        _, of = np.unique(words, return_inverse=True)
        total = np.bincount(of, times).astype("<i8")
        cuts = np.r_[0, np.cumsum(pdf["words"].map(len).to_numpy("i8") // 8)]
        found = total[of]
        rows = [(p, found[a:b].tobytes(), 0) for p, a, b in zip(pdf["pack"], cuts, cuts[1:], strict=False)]
        return pd.DataFrame([*rows, (-1, b"", int((total > 0).sum()))], columns=["pack", "counts", "distinct"]).assign(bucket=int(pdf["bucket"].iloc[0]))

    asked = packed.select("pack", "rid", "doc", "missing", "held", "size", "ids", "lens").mapInPandas(ask, "bucket int, pack long, words binary, times binary")
    found = stage(asked.groupBy("bucket").applyInPandas(add, "pack long, counts binary, distinct long, bucket int"), "counts")
    distinct = found.where("pack = -1").agg(F.sum("distinct")).first()[0] or 0
    return found.where("pack >= 0").groupBy("pack").agg(F.collect_list(F.struct("bucket", "counts")).alias("counts")), distinct


class Windows:
    """Texts of a pack as half windows, each padded to whole ones: what stands
    before each word (slots of its first and last id) and which words are real."""

    def __init__(self, first: np.ndarray, last: np.ndarray, size: np.ndarray, start: int, pad: int):
        padded = -(-size // _HALF) * _HALF
        offset, begin = np.cumsum(padded) - padded, np.cumsum(size) - size
        self.at = np.arange(len(first)) - np.repeat(begin, size) + np.repeat(offset, size)
        self.g1, self.g2 = (np.full(int(padded.sum()), pad, "i4") for _ in range(2))
        self.g1[self.at[1:]], self.g2[self.at[1:]] = first[:-1], last[:-1]
        self.g1[offset], self.g2[offset] = start, pad
        self.g1, self.g2 = self.g1.reshape(-1, _HALF), self.g2.reshape(-1, _HALF)
        self.lead = np.ones(len(self.g1), "f4")
        self.lead[offset // _HALF] = 0  # no context from the text before

    def batch(self, a: int, b: int):
        """Half windows a to b, and before them the one that a looks back at."""
        before = slice(max(0, a - 1), b)
        g1, g2 = self.g1[before], self.g2[before]
        return (np.vstack([g1[:1], g1]), np.vstack([g2[:1], g2]), self.lead[a:b]) if a == 0 else (g1, g2, self.lead[a:b])


_STEP = np.arange(_HALF)[:, None] - np.arange(_HALF)[None, :]
_SCALE = np.float32(1 / math.sqrt(_DIM))


def forward(w: dict, g1: np.ndarray, g2: np.ndarray, lead: np.ndarray):
    """Log probabilities of the classes at each place of the half windows but the
    first, which is context only."""
    kv = w["kv1"][g1] + w["kv2"][g2]
    k, v = kv[..., :_DIM], kv[..., _DIM:]
    qr = w["qr"][g1[1:]]
    q = qr[..., :_DIM] * _SCALE
    back = w["b"][_STEP + _HALF]
    here = np.where(_STEP >= 0, w["b"][np.maximum(_STEP, 0)], np.float32(-1e9))
    p1 = q @ k[:-1].transpose(0, 2, 1)
    p2 = q @ k[1:].transpose(0, 2, 1)
    for p, bias in ((p1, back), (p2, here)):
        p += bias
        np.minimum(p, 30, out=p)
        np.exp(p, out=p)
    p1 *= lead[:, None, None]
    total = (p1.sum(-1) + p2.sum(-1))[..., None]
    mixed = (p1 @ v[:-1] + p2 @ v[1:]) / total
    logits = qr[..., _DIM:] + mixed @ w["o"]
    logits -= logits.max(-1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(-1, keepdims=True))
    return logits, (k, v, q, p1, p2, total, mixed)


def _sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values of equal rows."""
    rows, values = rows.ravel(), values.reshape(-1, values.shape[-1])
    order = np.argsort(rows.astype("u2"), kind="stable")  # slots, 2,048 at most: sorted by radix
    own = rows[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    return own[starts], np.add.reduceat(values[order], starts, axis=0)


def gradient(w: dict, g1: np.ndarray, g2: np.ndarray, lead: np.ndarray, target: np.ndarray, part: int = 32):
    """Gradient of the mean loss over the places with a target (others: -1), as
    (rows, values) of each table, and that loss. Worked off ``part`` half windows
    at a time, whose arrays stay in the processor's cache."""
    n = max(1, int((target >= 0).sum()))
    dkv, dqr = np.zeros((*g1.shape, 2 * _DIM), "f4"), np.empty((*target.shape, _DIM + _CLASSES), "f4")
    o, bias, loss = np.zeros_like(w["o"]), np.zeros(2 * _HALF, "f4"), 0.0
    for a in range(0, len(lead), part):
        own, around = slice(a, a + part), slice(a, a + part + 1)
        loss += _back(w, g1[around], g2[around], lead[own], target[own], n, dkv[around], dqr[own], o, bias)
    whole = lambda x: (np.arange(len(x)), x)
    return {"kv1": _sums(g1, dkv), "kv2": _sums(g2, dkv), "qr": _sums(g1[1:], dqr), "o": whole(o), "b": whole(bias)}, loss


def _back(w, g1, g2, lead, target, n, dkv, dqr, o, bias) -> float:
    """Adds the gradients of some half windows to ``dkv``, ``o`` and ``bias``, puts them
    into ``dqr``, and returns their part of the loss."""
    logp, (k, v, q, p1, p2, total, mixed) = forward(w, g1, g2, lead)
    real = target >= 0
    i, j = np.nonzero(real)
    loss = -float(logp[i, j, target[i, j]].sum()) / n
    d = np.exp(logp, out=logp)
    d[i, j, target[i, j]] -= 1
    d[~real] = 0
    d /= np.float32(n)
    o += mixed.reshape(-1, _DIM).T @ d.reshape(-1, _CLASSES)
    dmixed = d @ w["o"].T
    inner = (dmixed * mixed).sum(-1, keepdims=True)
    dq = np.zeros_like(q)
    for p, side, step in ((p1, slice(0, -1), _STEP + _HALF), (p2, slice(1, None), np.maximum(_STEP, 0))):
        p /= total
        ds = dmixed @ v[side].transpose(0, 2, 1)
        ds -= inner
        ds *= p
        np.add.at(bias, step.ravel(), ds.sum(0).ravel())
        dq += ds @ k[side]
        dkv[side][..., :_DIM] += ds.transpose(0, 2, 1) @ q
        dkv[side][..., _DIM:] += p.transpose(0, 2, 1) @ dmixed
    dqr[..., :_DIM], dqr[..., _DIM:] = dq * _SCALE, d
    return loss


def _adagrad(w: dict, squares: dict, g: dict, rate: float = 0.05) -> None:
    for name, (rows, values) in g.items():
        squares[name][rows] += values**2
        w[name][rows] -= rate * values / np.sqrt(squares[name][rows])


def _classes(pairs: np.ndarray) -> np.ndarray:
    """Classes of the top ids from what stands before and after them."""
    rng = np.random.default_rng(3)
    rows = np.sqrt(np.hstack([(pairs + 1e-9) / (pairs.sum(1, keepdims=True) + 1), (pairs.T + 1e-9) / (pairs.T.sum(1, keepdims=True) + 1)]))
    rows -= rows.mean(0)
    values, vectors = np.linalg.eigh(rows @ rows.T)
    z = vectors[:, -24:] * np.sqrt(np.maximum(values[-24:], 0))
    centres = z[rng.choice(len(z), min(_CLASSES - 1, len(z)), replace=False, p=(pairs.sum(1) + 1) / (pairs.sum(1) + 1).sum())]
    for _ in range(25):
        near = ((z[:, None, :] - centres[None]) ** 2).sum(-1).argmin(1)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = z[near == c].mean(0)
    return near


def counts_model(first: np.ndarray, inner: np.ndarray, pairs: np.ndarray, top: np.ndarray, slot: np.ndarray, slot2: np.ndarray):
    """Tables from counts: class of every first id, log p(id | class, id before)
    for the top ids, log p(id | rest class) for the others, and the start weights.

    ``first``: counts of first ids, ``inner``: of ids that go on a word.
    """
    n, rng = len(top), np.random.default_rng(5)
    of = np.append(_classes(pairs[:n, :n].astype(float)), _CLASSES - 1) if n > 1 else np.array([0] * n + [_CLASSES - 1])
    own = first[top].astype(float) + 0.5
    whole = np.zeros((n, _CLASSES))
    whole[np.arange(n), of[:n]] = 1
    alone = own / (whole @ (whole.T @ own))
    by_class = pairs[:, :n] @ whole
    within = np.log((pairs[:, :n] + 20 * alone) / (by_class[:, of[:n]] + 20)).astype("f4")
    others = first.astype(float) + 1
    others[top] = 0
    rest = np.log(np.maximum(others, 1e-300) / others.sum()).astype("f4")
    seen = np.hstack([by_class[:, : _CLASSES - 1], by_class[:, _CLASSES - 1 :] + pairs[:, n:].sum(1, keepdims=True)])
    overall = (seen.sum(0) + 1) / (seen.sum() + _CLASSES)
    classes = np.log((seen + 5 * overall) / (seen.sum(1, keepdims=True) + 5))
    # how a word goes on after its first id, if it is unknown: ids one by one, then a stop
    stop = first.sum() + 1.0
    goes_on = np.log((inner + 0.5) / (inner.sum() + 0.5 * len(inner) + stop)).astype("f4")
    tables = {"slot": slot, "slot2": slot2, "class": of.astype("i4"), "within": within, "rest": rest, "n": n, "first": first.astype("f8"), "goes_on": goes_on, "stop": math.log(stop / (inner.sum() + 0.5 * len(inner) + stop))}
    weights = {
        "kv1": rng.normal(0, 0.3, (n + 1, 2 * _DIM)).astype("f4"),
        "kv2": rng.normal(0, 0.3, (n + 1, 2 * _DIM)).astype("f4"),
        "qr": np.hstack([rng.normal(0, 0.3, (n + 1, _DIM)), classes]).astype("f4"),
        "o": rng.normal(0, 0.1, (_DIM, _CLASSES)).astype("f4"),
        "b": np.zeros(2 * _HALF, "f4"),
    }
    return tables, weights


def _flat(w: dict) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in _NAMES])


def _shaped(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in _NAMES:
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype("f4")
        at += like[k].size
    return out


def _worked(w: dict, squares: dict, first: list, last: list, tables: dict, size: int = 128) -> int:
    """One pass over texts, ``size`` half windows a step; the number of half windows."""
    sizes = np.array([len(x) for x in first])
    f = np.concatenate(first)
    slots = tables["slot"][f]
    windows = Windows(slots, tables["slot2"][np.concatenate(last)], sizes, int(tables["slot"][_END]), tables["n"])
    target = np.full(windows.g1.size, -1, "i4")
    target[windows.at] = tables["class"][slots]
    target = target.reshape(-1, _HALF)
    for a in range(0, len(target), size):
        b = min(len(target), a + size)
        _adagrad(w, squares, gradient(w, *windows.batch(a, b), target[a:b])[0])
    return len(target)


def _trained(blocks: DataFrame, shared, start: dict) -> dict:
    """The mean of the weights that each block of documents leads to from
    ``start``, weighted by half windows."""
    chunk, given = 4096, blocks.sparkSession.sparkContext.broadcast(start)

    def run(batches):
        import pandas as pd
        from pyspark import TaskContext

        tables, total, used = shared.value, None, 0
        block, w, squares, mine, first, last, held = None, None, None, 0, [], [], 0

        def work():
            nonlocal mine, first, last, held
            if first:
                mine += _worked(w, squares, first, last, tables)
            first, last, held = [], [], 0

        def close():
            nonlocal total, used
            work()
            flat = _flat(w).astype("f8") * mine
            total, used = flat if total is None else total + flat, used + mine

        for row in _rows(batches):
            if row.block != block:
                if block is not None:
                    close()
                block, mine = row.block, 0
                w = {k: v.copy() for k, v in given.value.items()}
                squares = {k: np.full_like(v, 1e-6) for k, v in w.items()}
            first.append(np.frombuffer(row.first, "<u2"))
            last.append(np.frombuffer(row.last, "<u2"))
            held += len(first[-1])
            if held > 200_000:
                work()
        if block is not None:
            close()
            yield pd.DataFrame({"chunk": np.arange(-(-len(total) // chunk)), "part": TaskContext.get().partitionId(), "windows": used, "sums": [total[a : a + chunk] for a in range(0, len(total), chunk)]})

    def add(pdf):
        import pandas as pd

        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "windows": [pdf["windows"].sum()], "sums": [np.sum(np.stack(pdf["sums"].to_numpy()), 0)]})

    kind = "chunk int, windows long, sums array<double>"
    sums = blocks.mapInPandas(run, "chunk int, part int, windows long, sums array<double>")
    # two steps, so that no group holds more than a fraction of the tasks
    some = sums.groupBy("chunk", F.pmod("part", F.lit(256)).alias("few")).applyInPandas(add, kind)
    mean = some.groupBy("chunk").applyInPandas(add, kind).toPandas().sort_values("chunk")
    return _shaped(np.concatenate([np.asarray(s) / n for s, n in zip(mean["sums"], mean["windows"], strict=True)]), start) if len(mean) else start


def pack_scores(pack: Pack, counts: np.ndarray, tables: dict, weights: dict, numbers: dict, mix: float):
    """For each text of a pack: words known, base score and score in log10.

    ``counts``: the training count of each word; ``numbers``: of training words,
    distinct ones and documents.
    """
    slot, slot2, n = tables["slot"][pack.first], tables["slot2"][pack.last], tables["n"]
    windows = Windows(slot, slot2, pack.size, int(tables["slot"][_END]), n)
    before = windows.g1.ravel()[windows.at]
    logp = np.where(slot < n, tables["within"][before, np.minimum(slot, n - 1)], tables["rest"][pack.first]).astype("f8")
    cls = np.zeros(windows.g1.size, "i4")
    cls[windows.at] = tables["class"][slot]
    cls, found = cls.reshape(-1, _HALF), np.zeros(windows.g1.shape, "f4")
    for a in range(0, len(cls), 128):
        b = min(len(cls), a + 128)
        out, _ = forward(weights, *windows.batch(a, b))
        found[a:b] = np.take_along_axis(out, cls[a:b, :, None], 2)[..., 0]
    logp += found.ravel()[windows.at]
    inside = tables["goes_on"][pack.ids].astype("f8")
    inside[pack.starts] = tables["stop"]
    spelled = np.exp(np.maximum(np.add.reduceat(inside, pack.starts), -600))
    word = np.log((counts + 2 * spelled) / (tables["first"][pack.first] + 2))
    logp += np.where(pack.real, word, 0)
    base = np.log((counts + 1) / (numbers["tokens"] + numbers["distinct"] + 1))
    score = np.logaddexp(math.log(mix) + base, math.log(1 - mix) + logp)
    text = np.repeat(np.arange(len(pack.size)), pack.size)
    sums = [np.bincount(text, x, len(pack.size)) for x in (counts > 0, base, score)]
    return sums[0].astype("i8"), sums[1] / math.log(10), sums[2] / math.log(10)


def score_texts(docs: DataFrame, tokenizer_path: str | None = None, turns: int = 1, mix: float = 0.5) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities).

    Documents with crc32(doc_id as text) mod 7 = 2 are held out; a missing id
    counts as an empty text and is trained on. A null text is the end alone.
    Repeated rows count each. Words are told apart by a 64-bit hash of their ids.
    Without training documents all counts are 0. Empty in, empty out. ``mix`` is
    the share of the word unigram in the score, ``turns`` the passes of training.
    """
    spark, path = docs.sparkSession, tokenizer_path or default_path("byte_bpe_50k.tiktoken")
    folder = new_path(spark, "lm")

    def stage(df: DataFrame, name: str) -> DataFrame:
        # a reader takes the rows of a row group at once, and these are large: the writer looks at its size row by row
        groups = {"parquet.block.size": _GROUP, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
        df.write.options(compression="zstd", **groups).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    with small_batches(spark, _GROUP):  # also for the scores, which are a few numbers a text
        return stage(_scores(docs, path, stage, turns, mix), "scores")


def _scores(docs: DataFrame, path: str, stage: Callable[[DataFrame, str], DataFrame], turns: int, mix: float) -> DataFrame:
    """What ``score_texts`` returns, with its last steps yet to run."""
    spark = docs.sparkSession
    packed = stage(packs(docs, path), "packs")

    def unigrams(batches):
        import pandas as pd

        total, numbers = np.zeros((3, _IDS), "i8"), np.zeros(3, "i8")
        for row in _rows(batches):
            pack = Pack(row)
            total[0] += np.bincount(pack.first[pack.train], minlength=_IDS)
            total[1] += np.bincount(pack.last[pack.train], minlength=_IDS)
            total[2] += np.bincount(pack.ids[np.repeat(pack.train, pack.lens)], minlength=_IDS)
            numbers += pack.train.sum(), (pack.train & ~pack.real).sum(), len(pack.first)
        kind, at = np.nonzero(total)
        yield pd.DataFrame({"kind": np.r_[kind, [3, 3, 3]], "id": np.r_[at, 0, 1, 2], "n": np.r_[total[kind, at], numbers]})

    # at most three rows an id of the tokenizer's vocabulary
    got = packed.mapInPandas(unigrams, "kind int, id int, n long").groupBy("kind", "id").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((4, _IDS), "i8")
    table[got["kind"].to_numpy("i8"), got["id"].to_numpy("i8")] = got["n"].to_numpy("i8")
    train_tokens, train_docs, tokens = (int(x) for x in table[3, :3])
    first, last, inner = table[0], table[1], table[2] - table[0]

    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // (8 * _BUCKET)))
    counts, distinct = word_counts(packed, stage, buckets)
    numbers = {"tokens": train_tokens, "distinct": distinct + (1 if train_docs else 0), "docs": train_docs}

    def slots(count: np.ndarray):
        order = np.argsort(-count, kind="stable")[: _TOP - 1]
        top = np.sort(np.unique(np.r_[order[count[order] > 0], _END]))
        slot = np.full(_IDS, len(top), "i4")
        slot[top] = np.arange(len(top))
        return top, slot

    (top, slot), (top2, slot2) = slots(first), slots(last)
    slot2 = np.minimum(slot2, len(top)).astype("i4") if len(top2) > len(top) else np.where(slot2 == len(top2), len(top), slot2).astype("i4")
    width = len(top) + 1

    def bigrams(batches):
        import pandas as pd

        total = np.zeros(width * width, "i8")
        for row in _rows(batches):
            pack = Pack(row)
            own = slot[pack.first].astype("i8")
            prev = np.r_[slot[_END], own[:-1]]
            prev[np.cumsum(pack.size) - pack.size] = slot[_END]
            np.add.at(total, (prev * width + own)[pack.train], 1)
        found = np.flatnonzero(total)
        for a in range(0, len(found), 100_000):
            yield pd.DataFrame({"pair": found[a : a + 100_000], "n": total[found[a : a + 100_000]]})

    # at most 2,049 * 2,049 pairs of the model's ids, whatever the input
    got = packed.mapInPandas(bigrams, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros(width * width)
    pairs[got["pair"].to_numpy("i8")] = got["n"].to_numpy("i8")
    tables, weights = counts_model(first, inner, pairs.reshape(width, width), top, slot, slot2)
    del pairs, got
    shared = spark.sparkContext.broadcast(tables)

    n_blocks = max(1, -(-train_tokens // _BLOCK))

    def dealt(batches):
        import pandas as pd

        for row in _rows(batches):
            pack, out, docs = Pack(row), [], np.frombuffer(row.doc, "<i8")
            ends = np.cumsum(pack.size)
            for k in np.flatnonzero(~pack.held):
                own = slice(ends[k] - pack.size[k], ends[k])
                f, e = pack.first[own].tobytes(), pack.last[own].tobytes()
                key = zlib.crc32(f, int(docs[k]) & 0xFFFFFFFF)  # copies go to many blocks
                out.append((key % n_blocks, key, f, e))
            yield pd.DataFrame(out, columns=["block", "key", "first", "last"])

    texts = packed.mapInPandas(dealt, "block int, key long, first binary, last binary")
    blocks = texts.repartition(n_blocks, "block").sortWithinPartitions("block", "key", "first")
    for _ in range(turns):
        weights = _trained(blocks, shared, weights)
    final = spark.sparkContext.broadcast(weights)

    def run(batches):
        import pandas as pd

        for row in _rows(batches):
            pack, count = Pack(row), None
            words = pack.words()[pack.real]
            distinct_words, of = np.unique(words, return_inverse=True)
            order = np.argsort((distinct_words % np.uint64(buckets)).astype("i8"), kind="stable")
            got = np.zeros(len(order), "i8")
            if row.counts is not None and len(order):
                got[order] = np.frombuffer(b"".join(c["counts"] for c in sorted(row.counts, key=lambda c: c["bucket"])), "<i8")
            count = np.full(len(pack.first), train_docs, "f8")
            count[pack.real] = got[of]
            sums = [pack_scores(part, count[own], shared.value, final.value, numbers, mix) for part, own in pack.parts()]
            known, base, score = (np.concatenate(x) for x in zip(*sums, strict=True))
            doc = pd.Series(np.frombuffer(row.doc, "<i8"), dtype="Int64").mask(np.frombuffer(row.missing, "?"))
            yield pd.DataFrame({"rid": np.frombuffer(row.rid, "<i8"), "doc_id": doc, "held_out": pack.held, "n_tokens": pack.size, "n_known": known, "base_score": base, "score": score})

    scored = packed.join(counts, "pack", "left").mapInPandas(run, "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    whole = scored.groupBy("rid", "doc_id", "held_out").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")

"""Quality classifier by co-training of a text view and a page-metadata view.

Each view has a logistic model. In every round each model scores all documents
that have no label, in a Spark job, and gives the other model those that it is
surest of. Both are then calibrated on labelled documents that neither has learned
from, and a logistic combination of the calibrated views scores every document.

The two views are made once of every whole text and kept as a table, which the
rounds and the final scores read. What is fitted on is bounded by ``most_fitted``
labelled documents (documented limit of the fit: those of the least hashes of
their ids) and, a round, by a tenth as many of the surest others. How sure a view must
be follows from labelled documents that no view has learned from.
"""

from __future__ import annotations

import re
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alone, few_rows, held_by, release, stage

WORD_BITS = 18
_WORDS = 1 << WORD_BITS
_SOURCES, _LANGS = 64, 16
_META = _SOURCES + _LANGS + 2
_STATS, _BINS = 8, 12
_EDGE = re.compile(r"^\W+|\W+$")
_UPPER = str.maketrans("", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_MARKS = str.maketrans("", "", "!?#*$%&|<>\"'()[]{}=_~^")


class Buckets(dict):
    """word -> bucket of its lower-cased core; bounded."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        core = word if word.isalnum() else _EDGE.sub("", word) or word
        k = xxh64_intdigest(core.lower().encode()) & (_WORDS - 1)
        if len(self) < 300_000:
            self[word] = k
        return k


_BUCKETS = held_by("views", Buckets())


def text_view(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words of a whole text, and eight statistics."""
    from .common import words_of

    words = words_of(text)
    distinct = set(words)
    found = np.unique(np.fromiter((_BUCKETS[w] for w in distinct), "i4", len(distinct)))
    n, size = max(1, len(words)), max(1, len(text))
    lines = text.split("\n")
    twice = sum(map(eq, words, words[1:])) / n
    ends = sum(w[-1] in ".!?" for w in distinct) / n
    stats = np.array([np.log1p(len(words)) / 8, len(distinct) / n, twice, ends, (size - len(text.translate(_UPPER))) / size, (size - len(text.translate(_MARKS))) / size, 1 - len(set(lines)) / len(lines), min(size / n, 40) / 20])
    return found, stats


def meta_view(source, lang, n_chars) -> np.ndarray:
    """One-hot source and language (hashed), and the stated length: nothing of the text."""
    from xxhash import xxh64_intdigest

    out = np.zeros(_META)
    out[xxh64_intdigest(str(source or "")) % _SOURCES] = 1
    out[_SOURCES + xxh64_intdigest(str(lang or "")) % _LANGS] = 1
    known = n_chars is not None and n_chars == n_chars
    out[-2:] = np.log1p(max(0, n_chars) if known else 0) / 8, float(known)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Logistic:
    """Logistic model over rows given as (indices, values) in one long list."""

    def __init__(self, size: int, penalty: float):
        self.size, self.penalty, self.weights = size, penalty, np.zeros(size)

    def fit(self, rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, steps: int = 120) -> "Logistic":
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        at, x = np.concatenate(rows), np.concatenate(values)
        used, at = np.unique(at, return_inverse=True)
        w, moment, square = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
        weight = 1 / len(y)
        for t in range(1, steps + 1):
            off = (_sigmoid(np.bincount(row, w[at] * x, len(rows))) - y) * weight
            grad = np.bincount(at, off[row] * x, len(used)) + self.penalty * w
            moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad**2
            w -= 0.1 * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        self.weights = np.zeros(self.size)
        self.weights[used] = w
        return self

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(self.weights[at] @ x)


def platt(margins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic fit of y on the columns of margins and 1, held
    near taking the first column as it is (which decides if there are few rows)."""
    x = np.column_stack([margins, np.ones(len(y))])
    w = start = np.eye(1, x.shape[1])[0]
    for _ in range(50):
        p = _sigmoid(x @ w)
        hess = x.T @ (x * (p * (1 - p))[:, None]) + np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (p - y) + w - start)
        w = w - step * min(1.0, 1.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


class TextModel:
    """Words by their log odds, statistics by their bins; sparse logistic model.

    A word counts only where its log odds are ``certain`` standard errors off
    zero; the others would add up to noise in long texts.
    """

    def __init__(self, certain: float = 3.0):
        self.certain, self.odds, self.cuts = certain, np.zeros(_WORDS), np.zeros((_STATS, _BINS - 1))
        self.model = Logistic(_WORDS + _STATS * _BINS + 1, 1e-5)

    def _row(self, view):
        words, stats = view
        words = words[self.odds[words] != 0]
        bins = (stats[:, None] > self.cuts).sum(1) + np.arange(_STATS) * _BINS
        return np.concatenate([words, _WORDS + bins, [_WORDS + _STATS * _BINS]]), np.concatenate([self.odds[words], np.ones(_STATS + 1)])

    def fit(self, views, y):
        none = [np.zeros(0, "i4")]
        bad = np.bincount(np.concatenate([v[0] for v, t in zip(views, y, strict=True) if t] or none), minlength=_WORDS)
        good = np.bincount(np.concatenate([v[0] for v, t in zip(views, y, strict=True) if not t] or none), minlength=_WORDS)
        n, m = max(1, y.sum()), max(1, len(y) - y.sum())
        odds = np.log((bad + 0.5) / (n + 1)) - np.log((good + 0.5) / (m + 1))
        error = np.sqrt(1 / (bad + 0.5) + 1 / (good + 0.5))
        self.odds = np.where((np.abs(odds) > self.certain * error) | (bad >= 3) & (good == 0) & (odds > 2 * error), odds, 0.0)
        self.cuts = np.quantile(np.array([v[1] for v in views]), np.arange(1, _BINS) / _BINS, axis=0).T
        rows = [self._row(v) for v in views]
        self.model.fit([r[0] for r in rows], [r[1] for r in rows], y)
        return self

    def margin(self, view):
        return self.model.margin(*self._row(view))


class MetaModel:
    def __init__(self):
        self.model = Logistic(_META + 1, 1e-3)

    def fit(self, views, y):
        rows = [np.append(v, 1.0) for v in views]
        self.model.fit([np.arange(_META + 1)] * len(rows), rows, y)
        return self

    def margin(self, view):
        return self.model.margin(np.arange(_META + 1), np.append(view, 1.0))


_VIEWS = ("words", "stats", "meta")
_KINDS = {"text": TextModel, "meta": MetaModel}
_OTHER = {"text": "meta", "meta": "text"}


def _read(words: bytes, stats: bytes, meta: bytes):
    return {"text": (np.frombuffer(words, "i4"), np.frombuffer(stats)), "meta": np.frombuffer(meta)}


def viewed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """For each row: ``row`` (the columns to keep), a number, its id and its views."""
    kinds = dict(docs.dtypes)
    rest = [(F.col(c).cast(t) if c in kinds else F.lit(None).cast(t)).alias(c) for c, t in (("source", "string"), ("lang", "string"), ("n_chars", "double"))]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *rest,
    )
    schema = T.StructType([*rows.schema.fields[:3], *[T.StructField(c, T.BinaryType()) for c in _VIEWS]])

    def run(batches):
        import pyarrow as pa

        alone("views")
        for batch in few_rows(batches):
            text, *meta = [batch.column(c).to_pylist() for c in ("text", "source", "lang", "n_chars")]
            made = [text_view(t) for t in text]
            views = [[w.tobytes() for w, _ in made], [s.tobytes() for _, s in made], [meta_view(*m).tobytes() for m in zip(*meta, strict=True)]]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "rid", "id")], *[pa.array(v, pa.binary()) for v in views]], ["row", "rid", "id", *_VIEWS])

    return rows.mapInArrow(run, schema)


def _fitted(rows: list[dict], y: np.ndarray, held: np.ndarray, given: dict[str, list[tuple[dict, int]]]):
    """Models and calibrations of both views, from labelled rows that are not held
    and from what the other view gave."""
    models, scale, own = {}, {}, np.flatnonzero(~held)
    for k, kind in _KINDS.items():
        views = [rows[i][k] for i in own] + [v[k] for v, _ in given[k]]
        models[k] = kind().fit(views, np.concatenate([y[own], [label for _, label in given[k]]]).astype(float))
        scale[k] = platt(np.array([models[k].margin(rows[i][k]) for i in np.flatnonzero(held)]), y[held])
    return models, scale


def _confidence(models, scale, rows: list[dict], y: np.ndarray) -> dict[tuple[str, int], float]:
    """The probability from which a view may give a label: the least one from which, among
    labelled rows that no view has learned from, it halves the error of always giving that
    label and does better than that for sure (by the lower bound of 95 per cent). Each view
    has its own: one of weak metadata is sure of less. Over 1: never."""
    out = {}
    for k in _KINDS:
        p = _sigmoid(np.array([models[k].margin(r[k]) for r in rows]) * scale[k][0] + scale[k][1])
        for label, by, hit in ((1, p, y == 1), (0, 1 - p, y == 0)):
            order = np.argsort(-by, kind="stable")
            n = np.arange(1, len(y) + 1)
            right = np.cumsum(hit[order]) / n
            z = 1.645  # Wilson's bound
            least = (right + z * z / (2 * n) - z * np.sqrt(right * (1 - right) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            ends = np.append(np.diff(by[order]) != 0, True)  # rows of one probability count together
            good = np.flatnonzero(ends & (right >= 1 - (1 - hit.mean()) / 2) & (least > hit.mean()))
            out[k, label] = float(by[order[good[-1]]]) if len(good) else 2.0
    return out


def _surest(unlabelled: DataFrame, seen: DataFrame, models, scale, sure: dict[tuple[str, int], float], most: dict[int, int], taken: dict) -> list[tuple[str, int, int]]:
    """(view, label, rid) of the ``most`` documents of a label that each view is surest of,
    of all without a label and that the other view has not been given; ties go by rid.

    Every row is scored where it lies; only numbers and probabilities are shuffled."""
    gone = {k: np.array(sorted(taken[_OTHER[k]]), "i8") for k in _KINDS}  # at most what the rounds before gave
    shared = seen.sparkSession.sparkContext.broadcast((models, scale, gone))

    def run(batches):
        import pandas as pd

        alone("scores")  # the views are made
        models, scale, gone = shared.value
        for pdf in batches:
            views = [_read(*r) for r in zip(*(pdf[c] for c in _VIEWS), strict=True)]
            rid, rows = pdf["rid"].to_numpy("i8"), []
            for k in _KINDS:
                p = _sigmoid(np.array([models[k].margin(v[k]) for v in views]) * scale[k][0] + scale[k][1])
                free = ~np.isin(rid, gone[k])
                for label, by in ((1, p), (0, 1 - p)):
                    at = np.flatnonzero(free & (by >= sure[k, label]))
                    rows += [(k, label, r, q) for r, q in zip(rid[at].tolist(), by[at].tolist(), strict=True)]
            if rows:
                yield pd.DataFrame(rows, columns=["view", "label", "rid", "p"])

    scored = seen.select("rid", *_VIEWS).mapInPandas(run, "view string, label int, rid long, p double")
    found = stage(scored.join(unlabelled.select("rid"), "rid", "left_semi"), "surest")
    got = []
    for k in _KINDS:
        for label in (1, 0):
            top = found.where((F.col("view") == k) & (F.col("label") == label)).orderBy(F.desc("p"), "rid").limit(most[label]).select("rid").collect()
            got += [(k, label, r["rid"]) for r in top]
    release(found)
    return got


def fit(seen: DataFrame, labels: DataFrame, most_fitted: int = 8_000, rounds: int = 3, share: float = 0.1, log: list | None = None):
    """Models, calibrations and their combination, from ``viewed`` rows that
    ``labels`` covers (quality 0 or toxic 1: bad) and from all others; None if
    there are no documents of both kinds. ``log`` gets, for each round, how many labels
    each view has been given."""
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    # the least hashes: exact at any size, each id once, and at most this many rows reach the driver
    ids = known.join(seen.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id", F.lit(11)), "id").limit(most_fitted)
    got = seen.select("id", *_VIEWS).join(F.broadcast(ids), "id").dropDuplicates(["id"]).toPandas().sort_values("id", kind="stable")
    y = got["bad"].to_numpy("i8")
    if len(y) < 10 or y.min() == y.max():
        return None
    rows = [_read(*r) for r in zip(*(got[c] for c in _VIEWS), strict=True)]
    held = np.zeros(len(y), bool)
    held[np.random.default_rng(7).permutation(len(y))[: len(y) // 5]] = True
    kept_out = [rows[i] for i in np.flatnonzero(held)]
    others = seen.select("id", "rid").where("id is not null").join(known.select("id"), "id", "left_anti")
    # as many of each label as their shares of the labelled rows, a tenth of the fitted rows together
    most = {label: max(1, int(share * (y == label).sum())) for label in (0, 1)}
    given: dict[str, list] = {"text": [], "meta": []}
    taken: dict[str, set] = {"text": set(), "meta": set()}
    for _ in range(rounds):
        models, scale = _fitted(rows, y, held, given)
        picked = _surest(others, seen, models, scale, _confidence(models, scale, kept_out, y[held]), most, taken)
        if not picked:
            break
        wanted = seen.sparkSession.createDataFrame([(r,) for r in sorted({r for _, _, r in picked})], "rid long")
        views = {r["rid"]: _read(*(r[c] for c in _VIEWS)) for r in seen.select("rid", *_VIEWS).join(F.broadcast(wanted), "rid").collect()}
        for k, label, rid in picked:
            if rid not in taken[_OTHER[k]]:
                taken[_OTHER[k]].add(rid)
                given[_OTHER[k]].append((views[rid], label))
        if log is not None:
            log.append({k: len(given[k]) for k in _KINDS})
    models, scale = _fitted(rows, y, held, given)
    logits = np.array([[models[k].margin(r[k]) * scale[k][0] + scale[k][1] for k in _KINDS] for r in kept_out])
    return models, scale, platt(np.clip(logits, -12, 12), y[held])


def score(seen: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """``row`` and the probabilities of being bad by view and together."""
    schema = T.StructType([seen.schema["row"], *[T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score")], T.StructField("kept", T.BooleanType())])
    shared = seen.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        alone("scores")  # the views are made
        models, scale, mix = shared.value if shared.value else (None, None, None)
        for batch in few_rows(batches):
            if models is None:
                scores = [np.zeros(batch.num_rows)] * 3
            else:
                views = [_read(*r) for r in zip(*(batch.column(c).to_pylist() for c in _VIEWS), strict=True)]
                t, m = (np.array([models[k].margin(v[k]) for v in views]) * scale[k][0] + scale[k][1] for k in _KINDS)
                both = np.clip(np.column_stack([t, m]).reshape(-1, 2), -12, 12)
                scores = [_sigmoid(t), _sigmoid(m), _sigmoid(both @ mix[:2] + mix[2])]
            arrays = [batch.column("row"), *[pa.array(x, pa.float64()) for x in scores], pa.array(scores[2] < threshold, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "text_score", "meta_score", "score", "kept"])

    return seen.select("row", *_VIEWS).mapInArrow(run, schema)


def _scored(docs: DataFrame, labels: DataFrame, keep: list[str], most_fitted: int) -> DataFrame:
    seen = stage(viewed(docs, keep), "views")
    return score(seen, fit(seen, labels, most_fitted))


def classify(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, most_fitted: int = 8_000) -> DataFrame:
    """One row a document: the ``keep`` columns (doc_id by default), text_score,
    meta_score, score (probability of being bad) and kept.

    Null texts are empty, null metadata has a value of its own, repeated rows
    score alike, rows without doc_id are scored but never fitted on, a document
    with contradicting labels is bad. Without labels of both kinds every
    document is kept with score 0. Empty in, empty out. New columns replace any
    of the same name; ``accepted`` has none.
    """
    made = ["text_score", "meta_score", "score", "kept"]
    names = [c for c in keep or ["doc_id"] if c not in made]
    return _scored(docs, labels, names, most_fitted).select(*[F.col(f"row.`{c}`").alias(c) for c in names], *made)


def accepted(docs: DataFrame, labels: DataFrame, most_fitted: int = 8_000) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with exactly their columns."""
    return _scored(docs, labels, docs.columns, most_fitted).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

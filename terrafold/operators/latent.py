"""A latent space of the TF-IDF table: its leading singular vectors, distributed.

Subspace iteration with a block of ``width`` vectors: each step multiplies by the
transpose of the sparse table and by the table. The table lies in tiles, of about
``CHUNK`` documents and a block of terms. A task adds up the vectors of one block's
terms while the vectors of documents pass by, chunk by chunk, keeps the tiles in a file
of its own, and then sends what each chunk gets from the block: it holds the vectors of
at most some ``TERMS`` terms and one chunk, however many documents and postings there
are. A term of one document never travels: it adds its squared weight to that document.
Only the Gram matrix of the block (width x width, whatever the corpus) reaches the
driver. Start vectors are signs from hashes of the terms, so runs repeat. Terms are told
apart by a 64-bit hash.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import sendable, sent, small_batches, written
from .retrieval import by_term

#: Dimensions of the space.
RANK = 96
#: Documents of a chunk, and terms of a block.
CHUNK, TERMS = 2048, 200_000
_BATCH = 8 << 20  # bytes of tiles or vectors that are read, or sent to Python, at once
_TILE = "terms binary, counts binary, docs binary, w binary"


def _signs(terms: np.ndarray, width: int) -> np.ndarray:
    """1 or -1 for each term and dimension: whether Spark's xxhash64(term, k) is even."""
    u = np.uint64
    with np.errstate(over="ignore"):
        h = (terms.view("u8") + u(0x27D4EB2F165667C5) + u(4))[:, None] ^ np.arange(width, dtype="u8") * u(0x9E3779B185EBCA87)
        h = (h << u(23) | h >> u(41)) * u(0xC2B2AE3D27D4EB4F) + u(0x165667B19E3779F9)
        h = (h ^ h >> u(33)) * u(0xC2B2AE3D27D4EB4F)
        h = (h ^ h >> u(29)) * u(0x165667B19E3779F9)
    return 1.0 - 2.0 * ((h ^ h >> u(32)) & u(1))


def _dealt(to: np.ndarray, at: np.ndarray, w: np.ndarray, v: np.ndarray, n: int, size: int = 500) -> np.ndarray:
    """Rows of sums of w * v[at] by ``to``: the first posting of each row, then the second
    of those that have one, and so on, few at once, so that they stay in the processor's cache."""
    out, order = np.zeros((n, v.shape[1])), np.argsort(to, kind="stable")
    if not len(order):
        return out
    to, at, w = to[order], at[order], w[order]
    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
    counts = np.diff(np.r_[starts, len(to)])
    longest = np.argsort(-counts, kind="stable")
    place = np.empty_like(longest)
    place[longest] = np.arange(len(longest))
    turn = np.arange(len(to)) - np.repeat(starts, counts)
    order = np.lexsort((np.repeat(place, counts), turn))
    at, w, cuts = at[order], w[order][:, None], np.r_[0, np.cumsum(np.bincount(turn))].tolist()
    sums, held = np.zeros((len(counts), v.shape[1])), np.empty((size, v.shape[1]))
    for a, b in zip(cuts, cuts[1:], strict=False):
        for x in range(a, b, size):
            y = min(b, x + size)
            own = np.take(v, at[x:y], axis=0, out=held[: y - x], mode="clip")
            own *= w[x:y]
            sums[x - a : y - a] += own
    out[to[starts[longest]]] = sums
    return out


class _Tile:
    """Postings of some documents and terms, by term. Terms that many of the documents have
    are multiplied as rows of a matrix, the others posting by posting."""

    def __init__(self, counts: np.ndarray, docs: np.ndarray, w: np.ndarray, n: int):
        self.n, self.size, of = n, len(counts), np.repeat(np.arange(len(counts)), counts)
        self.common = np.flatnonzero(counts >= max(8, n // 50))
        rank = np.full(len(counts), -1)
        rank[self.common] = np.arange(len(self.common))
        many = rank[of] >= 0
        self.rest, self.many = (of[~many], docs[~many], w[~many]), (rank[of[many]], docs[many], w[many])

    def _rows(self):
        """The common terms' places and their weights as a matrix, few terms at once."""
        rank, docs, w = self.many
        for a in range(0, len(self.common), 512):
            own = slice(*np.searchsorted(rank, (a, a + 512)))
            out = np.zeros((len(self.common[a : a + 512]), self.n))
            np.add.at(out, (rank[own] - a, docs[own]), w[own])
            yield self.common[a : a + 512], out

    def of_terms(self, v: np.ndarray) -> np.ndarray:
        """Sums of w * v over the documents of each term."""
        of, docs, w = self.rest
        out = _dealt(of, docs, w, v, self.size)
        for at, rows in self._rows():
            out[at] = rows @ v
        return out

    def of_docs(self, u: np.ndarray) -> np.ndarray:
        """Sums of w * u over the terms of each document."""
        of, docs, w = self.rest
        out = _dealt(docs, of, w, u, self.n)
        for at, rows in self._rows():
            out += rows.T @ u[at]
        return out


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``written`` in small row groups, as a reader takes a whole one at once."""
    return written(df, name, {"parquet.block.size": _BATCH, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1})


def _chunk(key: str, chunks: int):
    """The chunk of a document; what has no key is a document in a chunk of its own."""
    return F.when(F.col(key).isNull(), chunks).otherwise(F.pmod(F.xxhash64(key), F.lit(chunks))).cast("int")


def _laid(weights: DataFrame, key: str, width: int, chunks: int, blocks: int) -> DataFrame:
    """Tiles (a block and its terms) and, once a chunk, with no block: its keys, the table's
    product with the start vectors, and the squared weights ``g`` of terms of one document.
    These terms make tiles, too, for their own vectors; their block is that of the chunk."""
    kind = dict(weights.dtypes)[key]
    some = "''" if kind == "string" else "0"
    rows = weights.select(_chunk(key, chunks).alias("chunk"), F.coalesce(F.col(key), F.expr(f"cast({some} as {kind})")).alias("id"), F.xxhash64("term").alias("t"), "w", (F.col("df") > 1).alias("shared"))

    def lay(pdf):
        import pandas as pd

        chunk = int(pdf["chunk"].iloc[0])
        ids, doc = np.unique(pdf["id"].to_numpy(), return_inverse=True)
        t, w, shared = (pdf[c].to_numpy() for c in ("t", "w", "shared"))
        block = np.where(shared, (t.view("u8") % np.uint64(blocks)).astype("i8"), blocks + chunk)
        order = np.lexsort((doc, t, block))
        t, w, doc, block, out, y = t[order], w[order], doc[order], block[order], [], np.zeros((len(ids), width))
        cuts = [*np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(block)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            starts = np.flatnonzero(np.r_[True, t[a + 1 : b] != t[a : b - 1]])
            terms, counts = t[a:b][starts], np.diff(np.r_[starts, b - a])
            y += _Tile(counts, doc[a:b], w[a:b], len(ids)).of_docs(_signs(terms, width))
            out.append((chunk, int(block[a]), terms.tobytes(), counts.astype("<u4").tobytes(), doc[a:b].astype("<u2").tobytes(), w[a:b].tobytes(), None, None, None))
        alone = block >= blocks
        g = np.bincount(doc[alone], w[alone] ** 2, len(ids))
        out.append((chunk, None, None, None, None, None, y.tobytes(), g.tobytes(), [None] if chunk == chunks else ids.tolist()))
        return pd.DataFrame(out, columns=["chunk", "block", "terms", "counts", "docs", "w", "v", "g", "keys"])

    return rows.groupBy("chunk").applyInPandas(lay, f"chunk int, block int, {_TILE}, v binary, g binary, keys array<{kind}>")


def _matrix(v: bytes, width: int) -> np.ndarray:
    return np.frombuffer(v).reshape(-1, width)


def _by_block(tiles: DataFrame, y: DataFrame, by: np.ndarray, blocks: int, schema: str, made: Callable[..., Iterator], own: int = 0) -> DataFrame:
    """What ``made`` makes of each block's terms, the sums of w * (y by) for these, and its
    tiles. ``own``: also of so many chunks' own blocks."""
    width, kept = by.shape[1], by  # y has as many columns as ``by`` has rows
    to = F.array(*[F.lit(b) for b in range(blocks)])
    if own:
        to = F.concat(to, F.array(F.col("chunk") + blocks))
    sides = y.select("chunk", F.explode(to).alias("block"), "v").unionByName(tiles.select("chunk", "block", *_names(_TILE)), allowMissingColumns=True)

    def run(batches):
        block, places, sums, spool, held, v = None, {}, None, None, 0, None

        def tiles_of():
            spool.seek(0)
            for _ in range(held):
                chunk, at, counts, docs, w, n = pickle.load(spool)
                yield chunk, at, _Tile(counts, docs, w, n)

        for row in (r for pdf in batches for r in pdf.itertuples(index=False)):
            if row.block != block:
                if block is not None:
                    yield from made(np.fromiter(places, "i8", len(places)), sums[: len(places)], tiles_of())
                    spool.close()
                block, places, sums, spool, held, v = row.block, {}, np.zeros((1024, width)), tempfile.TemporaryFile(), 0, None
            if row.v is not None:
                v = _matrix(row.v, len(kept)) @ kept
                continue
            terms, counts = np.frombuffer(row.terms, "<i8").tolist(), np.frombuffer(row.counts, "<u4").astype("i8")
            at = np.fromiter((places.setdefault(t, len(places)) for t in terms), "i8", len(terms))
            if len(places) > len(sums):
                sums = np.concatenate([sums, np.zeros((len(places) + len(sums) // 4 - len(sums), width))])
            docs, w = np.frombuffer(row.docs, "<u2").astype("i8"), np.frombuffer(row.w)
            sums[at] += _Tile(counts, docs, w, len(v)).of_terms(v)
            pickle.dump((row.chunk, at, counts, docs, w, len(v)), spool, 5)
            held += 1
        if block is not None:
            yield from made(np.fromiter(places, "i8", len(places)), sums[: len(places)], tiles_of())
            spool.close()

    # a chunk's vectors come before its tile
    return sides.repartition("block").sortWithinPartitions("block", "chunk", F.col("v").isNull()).mapInPandas(run, schema)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _turn(tiles: DataFrame, y: DataFrame, by: np.ndarray, blocks: int) -> DataFrame:
    """(chunk, v, g): X X' of y times a small matrix. Each block of terms sends one sum a chunk."""
    import pandas as pd

    width = by.shape[1]

    def made(terms, u, own):
        for chunk, at, tile in own:
            yield pd.DataFrame({"chunk": [chunk], "v": [tile.of_docs(u[at]).tobytes()]})

    def total(batches):
        chunk, out, g = None, None, None
        for row in (r for pdf in batches for r in pdf.itertuples(index=False)):
            if row.chunk != chunk:
                if chunk is not None:
                    yield pd.DataFrame({"chunk": [chunk], "v": [out.tobytes()], "g": [g]})
                chunk, out, g = row.chunk, 0, None
            if row.g is None:
                out = out + _matrix(row.v, width)
            else:
                g, out = row.g, out + np.frombuffer(row.g)[:, None] * (_matrix(row.v, len(by)) @ by)
        if chunk is not None:
            yield pd.DataFrame({"chunk": [chunk], "v": [out.tobytes()], "g": [g]})

    parts = _by_block(tiles, y, by, blocks, "chunk int, v binary", made)
    rows = y.select("chunk", "v", "g").unionByName(parts, allowMissingColumns=True)
    return rows.repartition("chunk").sortWithinPartitions("chunk", F.xxhash64("v")).mapInPandas(total, "chunk int, v binary, g binary")


def _cells(out: np.ndarray):
    import pandas as pd

    return pd.DataFrame({"cell": np.arange(out.size), "x": out.ravel()})


def _summed(cells: DataFrame, width: int) -> np.ndarray:
    """One small matrix a task, summed."""
    rows, out = cells.groupBy("cell").agg(F.sum("x").alias("x")).toPandas(), np.zeros(width * width)
    out[rows["cell"].to_numpy()] = rows["x"].to_numpy()
    return out.reshape(width, width)


def _gram(y: DataFrame, width: int, by: np.ndarray | None = None) -> np.ndarray:
    """V'V of the vectors of documents; with ``by``, of these times a small matrix, each
    document as often as ``g`` says."""

    def run(batches):
        total = np.zeros((width, width))
        for row in (r for pdf in batches for r in pdf.itertuples(index=False)):
            v = _matrix(row.v, width)
            if by is None:
                total += v.T @ v
            else:
                v = v @ by
                total += v.T @ (v * np.frombuffer(row.g)[:, None])
        yield _cells(total)

    return _summed(y.select("v", "g").mapInPandas(run, "cell int, x double"), width)


def _whitened(y: DataFrame, width: int) -> np.ndarray:
    """The matrix that makes the columns of y orthonormal."""
    values, vectors = np.linalg.eigh(_gram(y, width))
    good = values > values.max(initial=0) * 1e-12
    out = np.zeros((width, width))
    out[:, good] = vectors[:, good] / np.sqrt(values[good])
    return out


def _with_df(weights: DataFrame) -> DataFrame:
    if "df" in weights.columns:
        return weights
    weights = written(weights, "weights")
    return by_term(weights, weights.groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def _by_document(y: DataFrame, keys: DataFrame, key: str, by: np.ndarray) -> DataFrame:
    """(key, v): the vectors of documents times a small matrix."""
    kind = dict(keys.select(F.explode("keys").alias("k")).dtypes)["k"]

    def run(batches):
        import pandas as pd

        for row in (r for pdf in batches for r in pdf.itertuples(index=False)):
            yield pd.DataFrame({key: pd.Series(list(row.keys), dtype=object), "v": list(_matrix(row.v, len(by)) @ by)})

    return y.select("chunk", "v").join(keys.select("chunk", "keys").hint("merge"), "chunk").select("v", "keys").mapInPandas(run, f"`{key}` {kind}, v array<double>")


def _through(weights: DataFrame, y: DataFrame, key: str, n: int) -> DataFrame:
    """(key, v): X X'y for vectors (key, v) of the documents of a table with ``n`` postings."""
    width, blocks, chunks = len(y.first()["v"]), 8, max(1, n // (64 * CHUNK))
    laid = _staged(_laid(_with_df(weights), key, width, chunks, blocks), "tiles")
    tiles, keys = laid.where(F.col("block") < blocks), laid.where("block is null")

    def pack(pdf):
        import pandas as pd

        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "v": [np.stack(pdf.sort_values(key)["v"].to_numpy()).tobytes()]})

    packed = y.select(_chunk(key, chunks).alias("chunk"), key, "v").groupBy("chunk").applyInPandas(pack, "chunk int, v binary")
    start = _staged(packed.join(keys.select("chunk", "g"), "chunk"), "subspace")
    return _by_document(_staged(_turn(tiles, start, np.eye(width), blocks), "subspace"), keys, key, np.eye(width))


def latent_space(weights: DataFrame, key: str, k: int = RANK, extra: int = 16, turns: int = 2, size: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame, list[float]]:
    """(term, v) and (key, v) of ``k`` dimensions, and the singular values, for a
    table (term, key, w) of unit rows. Rows of the second are of length 1. A table of
    lower rank has that many dimensions that are not 0. If it is known: ``df``, the postings of
    the term, as a column, and ``size``, about how many documents and terms of several there are."""
    session, width, weights = weights.sparkSession, k + extra, _with_df(weights)
    documents, terms = size or weights.agg(F.approx_count_distinct(key), F.sum(F.when(F.col("df") > 1, 1 / F.col("df")))).first()
    chunks, blocks = max(1, -(-int(documents) // CHUNK)), max(8, -(-int(terms or 0) // TERMS))
    with small_batches(session, _BATCH):
        laid = _staged(_laid(weights, key, width, chunks, blocks), "tiles")
        tiles, keys = laid.where(F.col("block") < blocks), laid.where("block is null")
        y = keys.select("chunk", "v", "g")
        for _ in range(turns):
            y = _staged(_turn(tiles, y, _whitened(y, width), blocks), "subspace")
        q = _whitened(y, width)  # y q has orthonormal columns

        def gram(terms, u, own):
            yield _cells(u.T @ u)

        values, vectors = np.linalg.eigh(_summed(_by_block(tiles, y, q, blocks, "cell int, x double", gram), width) + _gram(y, width, q))
    order = np.argsort(-values)[:k]
    sigma = np.sqrt(np.maximum(values[order], 0))

    def vectors_of(terms, u, own):
        import pandas as pd

        for a in range(0, len(terms), 5_000):
            yield pd.DataFrame({"t": terms[a : a + 5_000], "v": list(u[a : a + 5_000])})

    found = _by_block(laid.where("block is not null"), y, q @ vectors[:, order] / np.maximum(sigma, 1e-12), blocks, "t long, v array<double>", vectors_of, chunks)
    names = weights.select("term").distinct().withColumn("t", F.xxhash64("term"))
    docs = _by_document(y, keys, key, q @ vectors[:, order] * sigma)
    return found.join(names.hint("merge"), "t").select("term", "v"), docs.withColumn("v", unit(F.col("v"))), [float(x) for x in sigma]


def unit(v):
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def folded(queries: DataFrame, terms: DataFrame, width: int = RANK) -> DataFrame:
    """(query_id, v): queries (query_id, term, weight) in the latent space, of length 1."""
    asked = written(queries.select("query_id", "term", "weight"), "asked")
    known = asked.select("term").distinct()
    few = sendable(known)
    own = terms.join(sent(known, few), "term", "left_semi")  # the others' vectors go nowhere
    met = asked.join(sent(own, few), "term")
    sums = met.groupBy("query_id").agg(*[F.sum(F.col("weight") * F.col("v")[k]).alias(f"v{k}") for k in range(width)])
    return sums.select("query_id", unit(F.array(*[F.col(f"v{k}") for k in range(width)])).alias("v"))

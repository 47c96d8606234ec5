"""Flat token-id files with 64-bit document offsets, written and mapped back.

Layout of a folder: ``shard-NNNNN.ids`` (unsigned little-endian integers, 16 or
32 bits by vocabulary size), ``shard-NNNNN.offsets`` (int64: the first id of
each document within the shard, then the shard's length), ``shard-NNNNN.docs``
(int64 document ids, then one byte a document: 1 if the id is null). The index,
one row a shard, carries each shard's base: the exclusive prefix sum of the
shards' lengths. A document's global start is base plus offset.

A task writes to names of its own and renames at the end, so a repeated attempt
leaves whole files only.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path
from .encoder import default_path, encoder

_INDEX = "shard int, docs long, tokens long"
_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _store(folder: str):
    """The filesystem and plain path of a folder that all workers share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str | None = None, kind: str = "bytes", end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order; return the index.

    Null texts are empty, null ids sort first, rows with equal ids are ordered
    by text. Other columns are ignored. An empty table gives an empty index.
    """
    path, spark = tokenizer_path or default_path("byte_bpe_50k.json"), docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    spread = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        store, base = _store(folder)
        enc = encoder(path, kind)
        width = "<u2" if max(enc.size - 1, end_id) < 1 << 16 else "<u4"
        end = np.array([end_id], width).tobytes()
        mark, lengths, ids, nulls = uuid.uuid4().hex, [], [], []
        names = {k: f"{base}/shard-{part:05d}.{k}" for k in ("ids", "offsets", "docs")}
        out = store.open_output_stream(f"{names['ids']}.{mark}")
        try:
            for pdf in batches:
                for text in pdf["text"]:
                    got = enc.ids(text) if width == "<u2" else np.frombuffer(enc.ids(text), "<u2").astype(width).tobytes()
                    out.write(got + end)
                    lengths.append((len(got) + len(end)) // len(end))
                missing = pdf["doc_id"].isna()
                nulls.append(missing.to_numpy("u1"))
                ids.append(pdf["doc_id"].fillna(0).to_numpy("<i8"))
        finally:
            out.close()
        if not lengths:
            store.delete_file(f"{names['ids']}.{mark}")
            return
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
        for k, data in (("offsets", offsets.tobytes()), ("docs", np.concatenate(ids).tobytes() + np.concatenate(nulls).tobytes())):
            with store.open_output_stream(f"{names[k]}.{mark}") as f:
                f.write(data)
        for name in names.values():
            store.move(f"{name}.{mark}", name)
        yield pd.DataFrame({"shard": [part], "docs": [len(lengths)], "tokens": [int(offsets[-1])]})

    _make_folder(spark, folder)
    index_path = f"{folder}/index"
    spread.mapInPandas(write, _INDEX).write.parquet(index_path)
    # one row a shard: the window's single partition holds as many rows as there are files
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    index = spark.read.schema(_INDEX).parquet(index_path)
    return index.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def _make_folder(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def read_token_files(index: DataFrame, folder: str, vocabulary: int = 1 << 16) -> DataFrame:
    """One row a document from the files: doc_id, start, n_tokens, ids_crc32.

    Files on a mounted path are memory-mapped; in another store they are read.
    """
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def mapped(store, name, kind):
        if store.type_name == "local":
            return np.memmap(name, kind, "r")
        return np.frombuffer(store.open_input_file(name).readall(), kind)

    def read(batches):
        import pandas as pd

        store, root = _store(folder)
        for pdf in batches:
            for shard, n, base in zip(pdf["shard"], pdf["docs"], pdf["base"], strict=True):
                name = f"{root}/shard-{shard:05d}"
                ids, offsets = mapped(store, f"{name}.ids", width), mapped(store, f"{name}.offsets", "<i8")
                raw = mapped(store, f"{name}.docs", "u1")
                doc, null = raw[: 8 * n].view("<i8"), raw[8 * n :].astype(bool)
                for a in range(0, n, 4096):
                    b = min(n, a + 4096)
                    crc = [zlib.crc32(ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes()) for i in range(a, b)]
                    yield pd.DataFrame({"doc_id": pd.Series(doc[a:b], dtype="Int64").mask(null[a:b]), "start": base + offsets[a:b], "n_tokens": offsets[a + 1 : b + 1] - offsets[a:b], "ids_crc32": crc})

    spread = index.select("shard", "docs", "base").repartition(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    return spread.mapInPandas(read, _ROWS)


def token_files(docs: DataFrame, tokenizer_path: str | None = None, folder: str | None = None) -> DataFrame:
    """Write the files into ``folder`` (the shared one by default), read them back."""
    folder = folder or new_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer_path), folder)

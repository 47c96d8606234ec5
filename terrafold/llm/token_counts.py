"""Token counts by field or section, from one encoding of the whole document.

Encoding parts on their own gives other tokens than the document has. So the
whole document is encoded once; each token's character span is joined to the
spans of fields and of their lines, and a token that crosses a boundary is
allocated by a rule: ``start`` (where its first character stands, the default),
``end`` (its last character) or ``most`` (the part with most of its characters
among first and last, the first at a tie).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoder import Encoder, default_path, encoder

_ROWS = "doc_id long, field string, section int, char_start long, n_chars long, n_tokens long, n_crossing long"


def byte_lengths(enc: Encoder) -> np.ndarray:
    """How many UTF-8 bytes each id stands for."""
    out = np.zeros(enc.size, "i8")
    for token, i in enc.tokenizer.get_vocab().items():
        out[i] = len(token)  # one letter a byte
    return out


def token_spans(text: str, enc: Encoder, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of each token (tokens may share a character)."""
    ends = np.cumsum(sizes[np.frombuffer(enc.ids(text), "<u2")])
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    if text.isascii():
        return starts, ends - 1
    raw = np.frombuffer(text.encode(), "u1")
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char_of[starts], char_of[ends - 1]


def allocate(first: np.ndarray, last: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of those cross a boundary.

    ``bounds``: first characters of the sections, the first of them 0.
    """
    a = np.searchsorted(bounds, first, "right") - 1
    b = np.searchsorted(bounds, last, "right") - 1
    if rule == "start":
        own = a
    elif rule == "end":
        own = b
    else:
        own = np.where(last + 1 - bounds[b] > bounds[np.minimum(a + 1, len(bounds) - 1)] - first, b, a)
        own = np.where(a == b, a, own)
    n = len(bounds)
    return np.bincount(own, minlength=n), np.bincount(own[a != b], minlength=n)


def token_counts(docs: DataFrame, fields: tuple[str, ...] = ("text",), lines: bool = True, rule: str = "start", tokenizer_path: str | None = None) -> DataFrame:
    """One row for each document, field and section.

    The document is its fields joined by newlines; a field's lines end with
    their newline, which belongs to the line, as does the newline that joins.
    Null fields are empty and still have one section without characters.
    A document's n_tokens add up to the tokens of the whole document. Repeated
    rows each give their sections; other columns are ignored.
    """
    if rule not in ("start", "end", "most"):
        raise ValueError(rule)
    path = tokenizer_path or default_path("byte_bpe_50k.json")

    def run(batches):
        import pandas as pd

        enc = encoder(path, "bytes")
        sizes = byte_lengths(enc)
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                doc, texts = row[0], row[1:]
                whole = "\n".join(texts)
                first, last = token_spans(whole, enc, sizes)
                names, bounds, at = [], [], 0
                for name, text in zip(fields, texts, strict=True):
                    size = len(text) + (name != fields[-1])
                    names.append((name, 0))
                    bounds.append(at)
                    if lines:
                        cuts = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), "<u4")[:-1] == 10) + 1 if text else []
                        names += [(name, k + 1) for k in range(len(cuts))]
                        bounds += [at + int(c) for c in cuts]
                    at += size
                edges = np.array(bounds, "i8")
                ends = np.append(edges[1:], at)
                owned, crossing = allocate(first, last, edges, rule)
                out += [(doc, f, k, int(s), int(e - s), int(n), int(c)) for (f, k), s, e, n, c in zip(names, edges, ends, owned, crossing, strict=True)]
            made = pd.DataFrame(out, columns=["doc_id", "field", "section", "char_start", "n_chars", "n_tokens", "n_crossing"])
            yield made.astype({"doc_id": "Int64"})

    picked = docs.select(F.col("doc_id").cast("long"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}") for i, f in enumerate(fields)])
    return picked.mapInPandas(run, _ROWS)

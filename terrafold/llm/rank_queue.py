"""Byte-level BPE, encoding and decoding, by a queue of merge ranks.

The pairs of adjacent tokens wait in a bucket for each merge rank. A bucket holds
places in a linked list of tokens, and a bitmap of three levels tells which buckets
hold any: the next merge is found by the first set bit of three words, however many
ranks and places there are. A place whose pair has changed since it was queued is
stale and skipped when it is met. So a piece of n bytes takes at most 2 n entries,
and very long pieces (a line without blanks) cost about as much a byte as words.

Texts are split by a pattern before any merge, as the rank file's users do. No
match of it crosses a single blank between two other characters: units between such
blanks are encoded once a worker and kept, at most ``most`` of them.
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import bisect_right
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoder import default_path

_MOST = 600_000  # units kept by a worker, and as many pieces: bounds its memory
_TOGETHER = 150_000  # bytes of pieces that share a queue
_UNITS = 20_000  # units split at once
_TEXT = 2_000_000  # bytes of texts taken at once, or one text
_CUT = re.compile(r"(?<=\S) (?=\S)")
_UNSAFE = re.compile(r"\s\s|\A\s|\s\Z|[\x1c-\x1f\x85]")
_FAR = re.compile("[^\x00-ɏ]")


class RankEncoder(dict):
    """unit -> its ids as packed integers; a unit is what follows a single blank."""

    def __init__(self, path: str, pattern: str, most: int = _MOST):
        import regex

        super().__init__()
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.ranks.values(), default=0) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.kind, self.code = ("<u2", "H") if size <= 1 << 16 else ("<u4", "I")
        self.of_bytes = np.array([self.ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)], "i4")
        words = (size >> 6) + 1
        self.low, self.mid = [0] * words, [0] * ((words >> 6) + 1)
        self.most, self.pattern, self.pieces = most, regex.compile(pattern), {}
        self.stand_ins: dict[str, str] = {}
        self.probes: list | None = None

    def _first_pairs(self, joined: bytes, closed: bytearray) -> tuple[list[int], dict[int, list[int]]]:
        """The rank of each pair of bytes within a piece, and the places of each rank in order."""
        raw = np.frombuffer(joined, "u1").astype("i4")
        pair = np.full(len(raw), -1, "i4")
        pair[:-1] = self.of_bytes[raw[:-1] << 8 | raw[1:]]
        pair[np.frombuffer(closed, "u1")[1:] == 1] = -1
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks, first = np.unique(pair[at], return_index=True)
        return pair.tolist(), {r: p.tolist() for r, p in zip(ranks.tolist(), np.split(at, first[1:]), strict=False)}

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece: within a piece the pair of the least rank merges first, the
        leftmost of equals. All pieces share one queue, as pairs never cross their ends.

        ``low`` has a bit for each rank, ``mid`` one for each word of ``low`` that is
        not 0, ``top`` one for each of ``mid``; all are 0 again at the end.
        """
        get, low, mid, top = self.ranks.get, self.low, self.mid, 0
        joined, ends = b"".join(pieces), list(accumulate(map(len, pieces)))
        n = len(joined)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        closed = bytearray(n + 1)  # 1 where a piece starts
        closed[0] = 1
        for end in ends:
            closed[end] = 1
        pair, buckets = self._first_pairs(joined, closed)  # pair: rank of each token's merge with the next one, -1 for none
        fresh = list(buckets)  # ranks that are not in the bitmap yet
        while True:
            for rank in fresh:
                word = rank >> 6
                if not low[word]:
                    if not mid[word >> 6]:
                        top |= 1 << (word >> 6)
                    mid[word >> 6] |= 1 << (word & 63)
                low[word] |= 1 << (rank & 63)
            if not top:
                break
            over = (top & -top).bit_length() - 1
            word = over << 6 | (mid[over] & -mid[over]).bit_length() - 1
            bit = low[word] & -low[word]
            rank = word << 6 | bit.bit_length() - 1
            low[word] ^= bit
            if not low[word]:
                mid[over] ^= 1 << (word & 63)
                if not mid[over]:
                    top ^= 1 << over
            places, fresh, held, later = buckets.pop(rank), [], 0, []
            if len(places) > 1:
                places.sort()
            for at in places:
                if pair[at] != rank:
                    continue  # stale: one of its two tokens has merged since
                if at < held:  # a lower rank goes first in this piece
                    later.append(at)
                    continue
                gone = after[at]
                end = after[at] = after[gone]
                pair[gone] = -1
                if closed[end]:
                    pair[at] = -1
                else:
                    before[end] = at
                    new = pair[at] = get(joined[at : after[end]], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(at)
                        else:
                            buckets[new] = [at]
                            fresh.append(new)
                        if new < rank:
                            held = ends[bisect_right(ends, at)]
                if not closed[at]:
                    left = before[at]
                    new = pair[left] = get(joined[left:end], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            fresh.append(new)
                        if new < rank:
                            held = ends[bisect_right(ends, at)]
            if later:
                buckets[rank] = later
                fresh.append(rank)
        out, at, ranks = [], 0, self.ranks
        for end in ends:
            own = []
            while at < end:
                own.append(ranks[joined[at : after[at]]])
                at = after[at]
            out.append(own)
        return out

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Packed ids of pieces, each given once; a piece that is a token stays whole."""
        got, open_, size = {}, [], 0

        def close() -> None:
            for (p, _), ids in zip(open_, self.merged([raw for _, raw in open_]), strict=True):
                got[p] = array(self.code, ids).tobytes()

        for p in pieces:
            raw = p.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                got[p] = array(self.code, (whole,)).tobytes()
                continue
            open_.append((p, raw))
            size += len(raw)
            if size >= _TOGETHER:
                close()
                open_, size = [], 0
        close()
        return got

    def _stand_in(self, c: str) -> str:
        """A letter, digit, blank or mark of the same class. Engines differ in the version of
        Unicode that they know: the class is the one that the rank file's own library sees."""
        got = self.stand_ins.get(c)
        if got is None:
            if self.probes is None:
                import tiktoken

                single = {bytes([k]): k for k in range(256)}
                self.probes = [(tiktoken.Encoding("probe", pat_str=p, mergeable_ranks=single, special_tokens={}), s) for p, s in ((r"\p{L}", "é"), (r"\p{N}", "²"), (r"\s", " "))]
            got = next((s for probe, s in self.probes if probe.encode_ordinary(c)), "§")
            self.stand_ins[c] = got
        return got

    def _split(self, text: str) -> list[str]:
        if not _FAR.search(text):
            return self.pattern.findall(text)
        shown = _FAR.sub(lambda m: self._stand_in(m[0]), text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(shown)]

    def _unit(self, unit: str) -> bytes:
        return b"".join([self._piece(p) for p in self._split(unit)])

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece; those met for the first time are merged together."""
        known = self.pieces
        new = self.learn([p for p in dict.fromkeys(pieces) if p not in known])
        out = [known[p] if p in known else new[p] for p in pieces]
        if len(known) + len(new) <= self.most:
            known |= {p: ids for p, ids in new.items() if len(p) <= 64}
        return out

    def texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        split = [_CUT.split(t) if _UNSAFE.search(t) else t.split(" ") for t in texts]
        new: dict[str, bytes] = {}
        unmet = list({w for words in split for w in words[1:] if w not in self})
        for a in range(0, len(unmet), _UNITS):
            part = unmet[a : a + _UNITS]
            # a single blank before another character starts a piece: no piece crosses two units
            pieces = self._split(" " + " ".join(part))
            made: list[list[bytes]] = [[] for _ in part]
            own, left = -1, 0
            for p, packed in zip(pieces, self._ids_of(pieces), strict=True):
                if not left:
                    own += 1
                    left = len(part[own]) + 1
                left -= len(p)
                made[own].append(packed)
            new |= {w: b"".join(x) for w, x in zip(part, made, strict=True)}
        if len(self) + len(new) <= self.most:
            self.update((w, ids) for w, ids in new.items() if len(w) <= 64)
        firsts = [self._split(words[0]) for words in split]
        first_ids = iter(self._ids_of([p for pieces in firsts for p in pieces]))
        get = self.get
        return [b"".join([next(first_ids) for _ in pieces]) + b"".join([get(w) or new[w] for w in words[1:]]) for words, pieces in zip(split, firsts, strict=True)]

    def bytes_of(self, ids) -> bytes | None:
        """What the ids stand for; None if one of them is no id."""
        try:
            return b"".join([self.tokens[k] for k in ids]) if not len(ids) or min(ids) >= 0 else None
        except (IndexError, TypeError):
            return None


_LOADED: dict[tuple, RankEncoder] = {}


def rank_encoder(path: str, pattern: str | None = None) -> RankEncoder:
    """One a worker, which serves many tasks."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = RankEncoder(path, pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, rank_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, without special tokens.

    Null texts are empty and have no ids; rows stay as they are, repeated ones and those
    without an id, too; other columns are ignored; an empty table stays empty.
    """
    path = rank_path or default_path("byte_bpe_multi_50k.tiktoken")

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        enc = rank_encoder(path, pattern)

        def batch(keys, parts):
            packed = [np.frombuffer(p, enc.kind) for p in parts]
            ends = np.cumsum([0, *map(len, packed)]).astype("i4")
            flat = np.concatenate(packed).astype("i4") if packed else np.zeros(0, "i4")
            return pa.record_batch([keys, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

        for b in batches:
            lengths = pc.binary_length(b.column(1)).to_numpy()
            for cut in np.split(np.arange(b.num_rows), np.flatnonzero(np.diff(np.cumsum(lengths, dtype="i8") // _TEXT)) + 1):
                if len(cut):
                    own = b.slice(cut[0], len(cut))
                    yield batch(own.column(0), enc.texts(own.column(1).to_pylist()))

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ids: str = "ids", into: str = "decoded", rank_path: str | None = None) -> DataFrame:
    """The table with the bytes of its ids as ``into`` in place of ``ids``.

    Null ids, and ids that the vocabulary does not have, give null.
    """
    path = rank_path or default_path("byte_bpe_multi_50k.tiktoken")
    kept = [f for f in encoded.schema.fields if f.name != ids]
    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{into}` binary"])

    def run(batches):
        import pyarrow as pa

        enc = rank_encoder(path)
        for b in batches:
            lists, rest = b.column(b.num_columns - 1), list(range(b.num_columns - 1))
            made, held, start = [], 0, 0
            for k in range(b.num_rows):
                own = lists[k].values  # None for a null
                made.append(None if own is None else enc.bytes_of([-1] if own.null_count else own.to_numpy(zero_copy_only=False).tolist()))
                held += len(made[-1] or b"")
                if held > 4 << 20 or k + 1 == b.num_rows:
                    part = b.slice(start, k + 1 - start)
                    yield pa.record_batch([*(part.column(i) for i in rest), pa.array(made, pa.binary())], [*(f.name for f in kept), into])
                    made, held, start = [], 0, k + 1

    return encoded.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{ids}`").cast("array<int>")).mapInArrow(run, kind)

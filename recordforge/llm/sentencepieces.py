"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A vocabulary file gives pieces and their scores; a merge-rank vocabulary (scores that are
negative ranks) gets the log scores of Zipf's law, ``-ln(rank + 1)``. Scores are rounded to
multiples of 1/1024, so their sums are exact and ties fall the same way everywhere.

No piece goes on after a space marker that follows other text (this is checked when a vocabulary is
read), so the best path of a text is made of the best paths of its chunks: a run of markers with the word
behind it. All distinct chunks of a batch walk the trie together, one numpy step for each byte of
the pieces tried, and a worker remembers chunks it has seen. Long chunks are walked alone. Every character without a
piece becomes its UTF-8 bytes' pieces, so decoding gives the whole text back.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import common

MARK = "▁"
#: Chunks of more bytes are walked alone, and not remembered.
LONG = 256
#: Chunks that a worker remembers, and bytes of text that it takes at once (one text at least).
MEMORY, AT_ONCE = 250_000, 1 << 20
#: What a character without a piece costs beyond the worst piece.
PENALTY = 10.0
_CHUNK = re.compile(f"{MARK}+[^{MARK}\n]*|\n+|[^{MARK}\n]+")
#: Cells of the double array that are tried at once.
STEP = 256
#: UTF-8 bytes of a character by its first byte; 0 for bytes that begin none.
_WIDTH = np.zeros(256, np.int64)
_WIDTH[:128], _WIDTH[192:224], _WIDTH[224:240], _WIDTH[240:248] = 1, 2, 3, 4


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie: the child of s by byte b is t = base[s] + b if check[t] == s.

    The root is state 0; value is a word's number or -1. Nodes with many children are placed
    first; those with one take the next free cell.
    """
    kids: list[dict[int, int]] = [{}]
    number = [-1]
    for w, v in words.items():
        at = 0
        for b in w:
            nxt = kids[at].get(b)
            if nxt is None:
                nxt = kids[at][b] = len(kids)
                kids.append({})
                number.append(-1)
            at = nxt
        number[at] = v
    size = 2 * len(kids) + 1024
    taken = np.zeros(size, bool)
    taken[0] = True
    start = [0] * len(kids)
    low = 1
    for node in sorted(range(len(kids)), key=lambda k: -len(kids[k])):
        mine = sorted(kids[node])
        if not mine:
            continue
        if len(mine) == 1:
            low = max(low, mine[0])
            while taken[low]:
                low += 1
            taken[low] = True
            start[node] = low - mine[0]
            if low + 512 > len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            continue
        first = [m - mine[0] for m in mine]
        at = max(low, mine[0])
        while True:
            if at + STEP + 512 > len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken) + STEP, bool)])
            free = ~taken[at : at + STEP]
            for d in first[1:]:
                free &= ~taken[at + d : at + d + STEP]
            if free.any():
                at += int(free.argmax())
                break
            at += STEP
        taken[[at + d for d in first]] = True
        start[node] = at - mine[0]
    base = np.zeros(len(taken) + 256, np.int32)
    check = np.full(len(taken) + 256, -1, np.int32)
    value = np.full(len(taken) + 256, -1, np.int32)
    todo = [(0, 0)]
    while todo:
        node, state = todo.pop()
        base[state], value[state] = start[node], number[node]
        for b, kid in kids[node].items():
            check[start[node] + b] = state
            todo.append((kid, start[node] + b))
    return base, check, value


class Pieces:
    """A vocabulary ready for search: the trie, scores, and the bytes of each piece."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], special: set[int]) -> None:
        usable = {p.encode(): i for i, p in enumerate(pieces) if p and i not in special and i not in byte_ids}
        if any(MARK in p.lstrip(MARK) or ("\n" in p and p.strip("\n")) for p in map(bytes.decode, usable)):
            raise ValueError("a piece crosses the bounds of chunks")
        self.base, self.check, self.value = double_array(usable)
        self.score = np.round(np.array(scores, np.float64) * 1024) / 1024
        self.unknown = float(self.score[list(usable.values())].min()) - PENALTY
        self.byte_ids = np.array(byte_ids, np.int32)
        raw = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.bytes = [b"" if i in special else raw.get(i) or p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]

    def alone(self, chunk: bytes) -> np.ndarray:
        """Best path of one chunk, byte by byte."""
        n = len(chunk)
        best, start, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        base, check, value, score = self.base, self.check, self.value, self.score
        at = 0
        while at < n:
            width, state, k, single = int(_WIDTH[chunk[at]]), 0, at, False
            while k < n:
                nxt = int(base[state]) + chunk[k]
                if check[nxt] != state:
                    break
                state, k = nxt, k + 1
                v = int(value[state])
                if v >= 0:
                    single |= k == at + width
                    s = best[at] + float(score[v])
                    if s > best[k]:
                        best[k], start[k], piece[k] = s, at, v
            if not single and best[at] + self.unknown > best[at + width]:
                best[at + width], start[at + width], piece[at + width] = best[at] + self.unknown, at, -1
            at += width
        out: list[int] = []
        while n:
            out += [piece[n]] if piece[n] >= 0 else self.byte_ids[list(chunk[start[n] : n])][::-1].tolist()
            n = start[n]
        return np.array(out[::-1], np.int32)

    def together(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Best paths of many short chunks: (ids of all, number of ids of each)."""
        n = np.fromiter(map(len, chunks), np.int64, len(chunks))
        width = int(n.max(initial=0))
        x = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in chunks), np.uint8).reshape(len(chunks), width)
        best = np.full((width + 1, len(chunks)), -np.inf)
        start = np.zeros((width + 1, len(chunks)), np.int32)
        piece = np.full((width + 1, len(chunks)), -1, np.int32)
        best[0] = 0
        for at in range(width):
            rows = np.flatnonzero((n > at) & (_WIDTH[x[:, at]] > 0))
            wide = _WIDTH[x[rows, at]]
            single = np.zeros(len(chunks), bool)
            r, w, state = rows, wide, np.zeros(len(rows), np.int32)
            for k in range(at, width):
                if k > at:
                    more = n[r] > k
                    r, w, state = r[more], w[more], state[more]
                nxt = self.base[state] + x[r, k]
                on = self.check[nxt] == state
                r, w, state = r[on], w[on], nxt[on]
                if not len(r):
                    break
                v = self.value[state]
                single[r[(v >= 0) & (k + 1 - at == w)]] = True
                s = best[at, r] + self.score[v]
                win = (v >= 0) & (s > best[k + 1, r])
                hit = r[win]
                best[k + 1, hit], start[k + 1, hit], piece[k + 1, hit] = s[win], at, v[win]
            lone = ~single[rows]
            rows, to = rows[lone], at + wide[lone]
            s = best[at, rows] + self.unknown
            win = s > best[to, rows]
            best[to[win], rows[win]], start[to[win], rows[win]], piece[to[win], rows[win]] = s[win], at, -1
        rows, pos, found = np.flatnonzero(n > 0), n[n > 0], []
        while len(rows):
            found.append((rows, pos, start[pos, rows], piece[pos, rows]))
            pos = start[pos, rows].astype(np.int64)
            rows, pos = rows[pos > 0], pos[pos > 0]
        if not found:
            return np.zeros(0, np.int32), np.zeros(len(chunks), np.int64)
        row, end, begin, ids = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((end, row))
        row, begin, ids, end = row[order], begin[order], ids[order], end[order]
        times = np.where(ids >= 0, 1, end - begin)
        row, begin, ids = (np.repeat(c, times) for c in (row, begin, ids))
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(times) - times, times)
        ids = np.where(ids >= 0, ids, self.byte_ids[x[row, begin + np.where(ids >= 0, 0, inside)]])
        return ids.astype(np.int32), np.bincount(row, minlength=len(chunks))

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids; the space that encoding puts in front goes."""
        out = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


class Encoder:
    """Encodes texts, remembering chunks."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.stops = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if len(self.places) > MEMORY:
            self._forget()
        cut = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        fresh = list(set().union(*cut).difference(self.places))
        long = [c for c in fresh if len(c) > LONG // 4 and len(c.encode()) > LONG]
        short = sorted(set(fresh).difference(long), key=len) if long else sorted(fresh, key=len)
        ids, stops = [self.ids], [self.stops]
        for at in range(0, len(short), 4096):
            got, n = self.pieces.together([c.encode() for c in short[at : at + 4096]])
            ids.append(got)
            stops.append(stops[-1][-1] + np.cumsum(n))
        for c in long:
            ids.append(self.pieces.alone(c.encode()))
            stops.append(stops[-1][-1:] + len(ids[-1]))
        known, known_stops = len(self.places), self.stops
        self.places.update(zip(short + long, range(known, known + len(fresh))))
        all_ids, all_stops = np.concatenate(ids), np.concatenate(stops)
        at = np.fromiter((self.places[c] for d in cut for c in d), np.int64, sum(map(len, cut)))
        n = all_stops[at + 1] - all_stops[at]
        out = all_ids[np.repeat(all_stops[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        doc = np.repeat(np.arange(len(cut)), [len(d) for d in cut])
        for c in long:
            del self.places[c]
        kept = known + len(short)
        self.ids, self.stops = (all_ids, all_stops) if not long else (all_ids[: all_stops[kept]], all_stops[: kept + 1])
        assert len(known_stops) <= len(self.stops)
        return out, np.bincount(doc, weights=n, minlength=len(cut)).astype(np.int64)


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """A vocabulary file of SentencePiece, read on the driver. It must have a piece for each byte."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.vocab_size()
    names, scores = [m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)]
    special = {i for i in range(n) if m.is_control(i) or m.is_unknown(i) or m.is_unused(i)}
    byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(map(m.is_byte, byte_ids)):
        raise ValueError("the vocabulary has no pieces for bytes")
    ranked = all(float(s).is_integer() for s in scores)
    return Pieces(names, [-math.log(1 - s) for s in scores] if ranked else scores, byte_ids, special)


def default_path() -> str:
    """The public vocabulary with byte pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of at most so many bytes, or of one text."""
    stops = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(stops, stops[at] + most, "right")) - 1)
        yield at, stop
        at = stop


def encode(docs: DataFrame, pieces: Pieces, check: bool = False) -> DataFrame:
    """``docs`` (all columns kept) with n_pieces and ids; with ``check`` also round_trip.

    A null or empty text has no ids. round_trip: whether decoding the ids gives the text itself, null as empty. A text
    that holds U+2581, which stands for a space, comes back with a space in its place and has false. Whole texts are encoded. Columns of these names are replaced;
    repeated rows get equal results; an empty table stays empty.
    """
    new = {"n_pieces": T.LongType(), "ids": T.ArrayType(T.IntegerType(), False)} | ({"round_trip": T.BooleanType()} if check else {})
    docs = docs.drop(*new)
    held = docs.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(k, v) for k, v in new.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        for b in batches:
            column = b.column("text")
            for at, stop in slices(column, AT_ONCE):
                texts = column.slice(at, stop - at).to_pylist()  # a batch may hold far more text than is taken at once
                ids, n = encoder.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(n)])
                cols = [*b.slice(at, stop - at).columns, pa.array(n), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))]
                if check:
                    cols.append(pa.array([encoder.pieces.decode(ids[i:j].tolist()) == (t or "") for t, i, j in zip(texts, offsets, offsets[1:])], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return common.map_in_arrow(docs, run, schema)


def decode(coded: DataFrame, pieces: Pieces) -> DataFrame:
    """``coded (ids array<int>, ...)`` with text: the text of the ids; null ids give null."""
    coded = coded.drop("text")
    held = coded.sparkSession.sparkContext.broadcast(pieces)
    schema = T.StructType([*coded.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [None if i is None else held.value.decode(i) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], names=schema.names)

    return common.map_in_arrow(coded, run, schema)


def op9_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents encoded, and whether decoding gives them back."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return encode(docs, load(path or default_path()), check=True).select("doc_id", "n_pieces", "ids", "round_trip")

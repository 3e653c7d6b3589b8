"""SentencePiece encoding and decoding with N-best segmentation.

A text is a lattice whose edges are the model's pieces with their scores; a
character that no piece of one character covers is an unknown edge and is
written as byte pieces. Forward Viterbi gives the best score up to every
position. Those scores are exact heuristics for an A* search that walks back
from the end: paths leave the agenda in order of their whole score, so the
first N that reach the start are the N best.

No piece holds a blank after another character, so a text's lattice falls into
units (blanks and the word after them). The forward and backward scores of all
new units of a group of documents are computed together with numpy; they give
the best path and the loss of the second-best path of each unit. A text's N
best differ from its best only in units of the N - 1 smallest losses; A* runs
on those, and the best sums of their alternatives are merged with a heap.

Blanks stand for the model's blank symbol throughout; that symbol's own
character in a text goes to bytes, so decoding gives every text back.
"""
from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, record_batch, slices

NBEST = 3
#: A unit of more characters is segmented alone, and its N best are not kept.
LONG_UNIT = 48
GROUP_DOCS, GROUP_CHARS = 1000, 4_000_000
#: Units whose N best a worker keeps.
CACHED_NBEST = 20_000
UNKNOWN_PENALTY = 10.0
BLANK_SYMBOL = "▁"

ENCODED_DDL = "doc_id bigint, ids array<int>, nbest_scores array<double>, nbest_changes array<string>"
ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("nbest_scores", pa.list_(pa.float64())),
                     ("nbest_changes", pa.list_(pa.string()))])
DECODED_DDL = "doc_id bigint, n_pieces bigint, ids_crc32 bigint, nbest_scores array<double>, n_chars bigint, text_sha256 string"
DECODED = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()),
                     ("nbest_scores", pa.list_(pa.float64())), ("n_chars", pa.int64()), ("text_sha256", pa.string())])

_UNITS = re.compile(r" *[^ ]+| +")
_P = np.uint64(0x9E3779B97F4A7C15)


class Lexicon:
    """Pieces of a model: text to (id, score), with a hash table for arrays of code points."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")
        self.pieces = {model.id_to_piece(i).replace(BLANK_SYMBOL, " "): (i, model.get_score(i)) for i in range(size)
                       if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        if any(" " in p.lstrip(" ") for p in self.pieces):
            raise ValueError("a piece has a blank after another character")
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces))
        table = [b""] * size
        for p, (i, _) in self.pieces.items():
            table[i] = p.encode()
        for b, i in self.bytes.items():
            table[i] = bytes([b])
        self.raw = pa.array(table, pa.binary())
        self._hash()

    def _hash(self) -> None:
        names = list(self.pieces)
        self.id = np.array([self.pieces[p][0] for p in names] + [-1], np.int32)
        self.score = np.array([self.pieces[p][1] for p in names] + [-np.inf])
        keys = np.zeros(len(names), np.uint64)
        for k, p in enumerate(names):
            h = 0
            for c in p:
                h = (h * int(_P) + ord(c) + 1) & (2**64 - 1)
            keys[k] = h
        if len(set(keys.tolist())) != len(keys):
            raise ValueError("two pieces share a hash")
        # Tables of growing multipliers until every key has a slot of its own in one of them.
        self.tables, left, mult = [], np.arange(len(keys)), 0x2545F4914F6CDD1D
        while len(left):
            mult = np.uint64((int(mult) * 0x5851F42D4C957F2D + 1) & (2**64 - 1) | 1)
            slot = ((keys[left] * mult) >> np.uint64(44)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            key, at = np.zeros(1 << 20, np.uint64), np.full(1 << 20, len(names), np.int32)
            key[slot[first]], at[slot[first]] = keys[left[first]], left[first]
            self.tables.append((mult, key, at))
            left = np.delete(left, first)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index into id and score of the piece with each hash; the last entry where there is none."""
        out = np.full(hashes.shape, len(self.id) - 1, np.int32)
        for mult, key, at in self.tables:
            slot = (hashes * mult) >> np.uint64(44)
            same = key[slot] == hashes
            out[same] = at[slot[same]]
        return out

    def expand(self, text: str, i: int, j: int) -> list[int]:
        found = self.pieces.get(text[i:j])
        return [found[0]] if found else [self.bytes[b] for b in text[i:j].encode("utf-8", "surrogatepass")]

    def edges(self, text: str) -> list[list[tuple[int, float]]]:
        """For each end position the (start, score) of the edges that end there, longest first."""
        out: list[list[tuple[int, float]]] = [[]]
        for j in range(1, len(text) + 1):
            here = [(i, self.pieces[text[i:j]][1]) for i in range(max(0, j - self.longest), j) if text[i:j] in self.pieces]
            if not here or here[-1][0] != j - 1:
                here.append((j - 1, self.unknown))
            out.append(here)
        return out


@cache
def lexicon(path: str) -> Lexicon:
    return Lexicon(path)


def forward(edges: list[list[tuple[int, float]]]) -> list[float]:
    """Viterbi: the best score of a path from the start to each position."""
    best = [0.0]
    for here in edges[1:]:
        best.append(max(best[i] + s for i, s in here))
    return best


class _Step:
    """A path back from the end: its last step and a link to the rest, besides one to a step farther back.

    Steps are ordered as the tuples of their negative piece lengths from the end would be.
    """

    __slots__ = ("at", "score", "size", "parent", "jump", "depth")

    def __init__(self, at: int, score: float, size: int, parent: _Step | None):
        self.at, self.score, self.size, self.parent = at, score, size, parent
        if parent is None:
            self.depth, self.jump = 0, self
        else:
            far = parent.jump
            self.depth = parent.depth + 1
            self.jump = far.jump if parent.depth - far.depth == far.depth - far.jump.depth else parent

    def back(self, depth: int) -> _Step:
        step = self
        while step.depth > depth:
            step = step.jump if step.jump.depth >= depth else step.parent
        return step

    def __lt__(self, other: _Step) -> bool:
        depth = min(self.depth, other.depth)
        a, b = self.back(depth), other.back(depth)
        if a is b:
            return self.depth < other.depth
        while a.parent is not b.parent:
            a, b = (a.parent, b.parent) if a.jump is b.jump else (a.jump, b.jump)
        return a.size > b.size

    def lengths(self) -> tuple[int, ...]:
        """Piece lengths from the start of the text."""
        out, step = [], self
        while step.parent is not None:
            out.append(step.size)
            step = step.parent
        return tuple(out)


def n_best(edges: list[list[tuple[int, float]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best (score, piece lengths from the start) by backward A*; ties to the longer last piece."""
    best, end = forward(edges), len(edges) - 1
    agenda = [(-best[end], _Step(end, 0.0, 0, None))]
    found = []
    while agenda and len(found) < n:
        cost, step = heapq.heappop(agenda)
        if not step.at:
            found.append((-cost, step.lengths()))
            continue
        for i, s in edges[step.at]:
            heapq.heappush(agenda, (-(step.score + s + best[i]), _Step(i, step.score + s, step.at - i, step)))
    return found


def _segment_long(lex: Lexicon, unit: str) -> tuple[bytes, float, float]:
    """One unit from its forward and backward scores."""
    edges, n = lex.edges(unit), len(unit)
    best = forward(edges)
    cuts = [n]
    while (j := cuts[-1]) > 0:
        cuts.append(next(i for i, s in edges[j] if best[i] + s == best[j]))
    cuts.reverse()
    start = dict(zip(cuts[1:], cuts, strict=False))  # of the best path's edge that ends there
    back, second = [-np.inf] * n + [0.0], -np.inf
    for j in range(n, 0, -1):
        own = start.get(j, -1)
        for i, s in edges[j]:
            back[i] = max(back[i], back[j] + s)
            if i != own:
                second = max(second, best[i] + s + back[j])
    ids = [x for i, j in zip(cuts, cuts[1:], strict=False) for x in lex.expand(unit, i, j)]
    return np.array(ids, "<u2").tobytes(), best[n], best[n] - second


def segment_units(lex: Lexicon, units: list[str]) -> list[tuple[bytes, float, float]]:
    """(ids as little-endian uint16, score, loss of the second-best path) of each unit's best path."""
    out: list = [None] * len(units)
    by_length: dict[int, list[int]] = {}
    for k, u in enumerate(units):
        by_length.setdefault(len(u), []).append(k)
    for length, ks in by_length.items():
        if length > LONG_UNIT:
            for k in ks:
                out[k] = _segment_long(lex, units[k])
        else:
            for a in range(0, len(ks), 4096):
                part = ks[a:a + 4096]
                for k, found in zip(part, _segment_equal(lex, [units[k] for k in part], length), strict=True):
                    out[k] = found
    return out


def _segment_equal(lex: Lexicon, units: list[str], n: int) -> list[tuple[bytes, float, float]]:
    """Units of one length n together."""
    w = len(units)
    code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(w, n).T.astype(np.uint64) + np.uint64(1)
    none = len(lex.id) - 1
    # piece[l - 1][j] is the piece of length l that ends at j + 1.
    piece, gain, hashes = [], [], np.zeros((n, w), np.uint64)
    for size in range(1, min(n, lex.longest) + 1):
        hashes = hashes[:n - size + 1] if size == 1 else hashes[:-1]
        hashes = hashes * _P + code[size - 1:]
        found = lex.find(hashes)
        score = lex.score[found]
        if size == 1:
            score = np.where(found == none, lex.unknown, score)
        piece.append(found)
        gain.append(score)
    # hashes[i] covers the piece that starts at i.
    best = np.full((n + 1, w), -np.inf)
    best[0] = 0
    took = np.zeros((n + 1, w), np.int8)
    for j in range(1, n + 1):
        for size in range(min(j, len(gain)), 0, -1):
            cand = best[j - size] + gain[size - 1][j - size]
            better = cand > best[j]
            best[j] = np.where(better, cand, best[j])
            took[j][better] = size
    back = np.full((n + 1, w), -np.inf)
    back[n] = 0
    for i in range(n - 1, -1, -1):
        for size in range(1, min(n - i, len(gain)) + 1):
            np.maximum(back[i], back[i + size] + gain[size - 1][i], out=back[i])
    # The best path, walking back; ends[j] marks the units whose best path has an edge ending at j.
    rows = np.arange(w)
    at = np.full(w, n)
    ends = np.zeros((n + 1, w), bool)
    while (on := at > 0).any():
        ends[at[on], rows[on]] = True
        at = np.where(on, at - took[at, rows], 0)
    second = np.full(w, -np.inf)
    unit, start, ids = [], [], []
    for j in range(1, n + 1):
        for size in range(1, min(j, len(gain)) + 1):
            i = j - size
            mine = ends[j] & (took[j] == size)
            total = best[i] + gain[size - 1][i] + back[j]
            total[mine] = -np.inf
            np.maximum(second, total, out=second)
            own = np.flatnonzero(mine)
            unit.append(own)
            start.append(np.full(len(own), i))
            ids.append(piece[size - 1][i][own])
    unit, start, ids = map(np.concatenate, (unit, start, ids))
    order = np.lexsort((start, unit))
    unit, start, ids = unit[order], start[order], ids[order]
    flat = lex.id[ids].astype("<u2")
    data, bounds = flat.tobytes(), np.searchsorted(unit, np.arange(w + 1)) * 2
    out = [data[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
    for k in np.unique(unit[ids == none]).tolist():  # units with byte pieces
        mine = slice(bounds[k] // 2, bounds[k + 1] // 2)
        cuts = [*start[mine].tolist(), n]
        out[k] = np.array([x for a, b in zip(cuts, cuts[1:], strict=False) for x in lex.expand(units[k], a, b)], "<u2").tobytes()
    return list(zip(out, best[n].tolist(), (best[n] - second).tolist(), strict=True))


class Segmenter:
    """Encodes groups of texts; keeps the N best of units that needed them, up to a bound."""

    _of_process: dict[str, Segmenter] = {}

    def __init__(self, path: str):
        self.lex = lexicon(path)
        self.nbest: dict[tuple[str, int], list] = {}

    @classmethod
    def get(cls, path: str) -> Segmenter:
        if path not in cls._of_process:
            cls._of_process[path] = cls(path)
        return cls._of_process[path]

    def _units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All units in turn, and where each text's begin and end."""
        easy = [not (t.startswith(" ") or "  " in t) for t in texts]
        split = pc.split_pattern(pa.array([t if e else "" for t, e in zip(texts, easy, strict=True)], pa.large_string()), " ")
        words = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), split.flatten(), pa.scalar(" ", pa.large_string()))
        if all(easy) and all(texts):
            return words, split.offsets.to_numpy()
        parts, bounds = [], [0]
        at = split.offsets.to_pylist()
        for k, (t, e) in enumerate(zip(texts, easy, strict=True)):
            part = pa.array(_UNITS.findall(" " + t), pa.large_string()) if not e else words[at[k]:at[k + 1] if t else at[k]]
            parts.append(part)
            bounds.append(bounds[-1] + len(part))
        return pa.concat_arrays(parts), np.array(bounds)

    def _unit_nbest(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        got = self.nbest.get((unit, n))
        if got is None:
            if len(unit) > LONG_UNIT:
                return n_best(self.lex.edges(unit), n)
            if len(self.nbest) >= CACHED_NBEST:
                self.nbest.clear()
            got = self.nbest[unit, n] = n_best(self.lex.edges(unit), n)
        return got

    def encode(self, texts: list[str], n: int = NBEST) -> list[tuple[np.ndarray, list[float], list[str]]]:
        """Of each text: ids of the best segmentation, scores of the n best, and each one's change against the best.

        A change lists unit position and piece lengths, as ``3:2+4``; it is empty for the best.
        """
        if not texts:
            return []
        units, bounds = self._units(texts)
        coded = units.dictionary_encode()
        names = coded.dictionary.to_pylist()
        segmented = segment_units(self.lex, names)
        at = coded.indices.to_numpy()
        ids = pa.array([x[0] for x in segmented], pa.large_binary()).take(coded.indices)
        offsets = np.frombuffer(ids.buffers()[1], np.int64)
        data = np.frombuffer(ids.buffers()[2] or b"", "<u2")
        score = np.array([x[1] for x in segmented])[at] if len(at) else np.zeros(0)
        loss = np.array([x[2] for x in segmented])[at] if len(at) else np.zeros(0)
        out = []
        for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            own = data[offsets[a] // 2:offsets[b] // 2]
            total = float(score[a:b].sum())
            scores, changes = self._text_nbest(loss[a:b], at[a:b], names, total, n) if b > a else ([0.0], [""])
            out.append((own, scores, changes))
        return out

    def _text_nbest(self, loss, at, names, total, n):
        few = np.arange(len(loss))
        if len(loss) > n - 1 > 0:
            least = np.partition(loss, n - 2)[n - 2]
            few = np.concatenate([np.flatnonzero(loss < least), np.flatnonzero(loss == least)])[:n - 1]
        few = sorted(few[np.isfinite(loss[few])].tolist()) if n > 1 else []
        lists = []
        for k in few:
            paths = self._unit_nbest(names[at[k]], n)
            lists.append((k, [(paths[0][0] - s, lengths) for s, lengths in paths]))
        agenda, seen, scores, changes = [(0.0, (0,) * len(lists))], set(), [], []
        while agenda and len(scores) < n:
            cost, pick = heapq.heappop(agenda)
            scores.append(total - cost)
            changes.append(";".join(f"{k}:{'+'.join(map(str, alts[p][1]))}" for p, (k, alts) in zip(pick, lists, strict=True) if p))
            for i, (_, alts) in enumerate(lists):
                if pick[i] + 1 < len(alts):
                    nxt = (*pick[:i], pick[i] + 1, *pick[i + 1:])
                    if nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(agenda, (sum(alts[p][0] for p, (_, alts) in zip(nxt, lists, strict=True)), nxt))
        return scores, changes


def decode(lex: Lexicon, ids: np.ndarray) -> bytes:
    """UTF-8 of the text that ids encode; the blank before the text is taken off."""
    taken = lex.raw.take(pa.array(ids, pa.int32()))
    data, at = taken.buffers()[2], np.frombuffer(taken.buffers()[1], np.int32)
    raw = bytes(memoryview(data)[at[0]:at[len(ids)]]) if data and len(ids) else b""
    return raw[1:] if raw.startswith(b" ") else raw


def _encoded(batches, path, n):
    segmenter = Segmenter.get(path)
    for batch in parts(batches):
        doc_ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        for a, b in slices(texts, GROUP_DOCS, GROUP_CHARS):
            yield doc_ids.slice(a, b - a), segmenter.encode(texts[a:b], n)


def encode_documents(docs: DataFrame, model_path: str, n: int = NBEST) -> DataFrame:
    """doc_id, ids (best segmentation), nbest_scores (up to n, falling) and nbest_changes for every row.

    Null text is empty and has no pieces, one segmentation and score 0. Repeated
    rows are repeated; a null doc_id stays null; an empty table gives no rows.
    Columns other than doc_id and text are not read.
    """
    def encode(batches):
        for doc_ids, found in _encoded(batches, model_path, n):
            lengths = np.fromiter((len(x[0]) for x in found), np.int64, len(found))
            flat = np.concatenate([x[0] for x in found]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat))
            yield record_batch(ENCODED, [doc_ids, ids, [x[1] for x in found], [x[2] for x in found]])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(encode, ENCODED_DDL)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of rows of (doc_id, ids)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def back(batches):
        lex = lexicon(model_path)
        for batch in batches:
            ids = [np.array(x, np.int32) for x in batch.column(1).to_pylist()]
            yield record_batch(schema, [batch.column(0), [decode(lex, x).decode("utf-8", "replace") for x in ids]])
    return encoded.select("doc_id", "ids").mapInArrow(back, "doc_id bigint, text string")


def round_trip(docs: DataFrame, model_path: str, n: int = NBEST) -> DataFrame:
    """Encode every row and decode its ids: doc_id, n_pieces, ids_crc32 (of little-endian unsigned 32-bit ids),
    nbest_scores, n_chars and text_sha256 of the decoded text. Rows as in ``encode_documents``."""
    def both(batches):
        lex = lexicon(model_path)
        for doc_ids, found in _encoded(batches, model_path, n):
            texts = [decode(lex, x[0]) for x in found]
            yield record_batch(DECODED, [
                doc_ids, [len(x[0]) for x in found], [zlib.crc32(x[0].astype("<u4").tobytes()) for x in found],
                [x[1] for x in found], [len(t.decode("utf-8", "replace")) for t in texts],
                [hashlib.sha256(t).hexdigest() for t in texts]])
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(both, DECODED_DDL)

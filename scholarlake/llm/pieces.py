"""Operator 5: SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Encoding follows the agenda of SentencePiece's BPE: adjacent symbols whose concatenation is a piece wait
by score, then place; the best is merged and its new neighbours enter. With dropout a candidate that
leaves the agenda is skipped with the probability RATE. A chunk's skipped candidates come from a keyed hash
of (seed, doc_id, the chunk's place in the text): each hash gives the gap to the next skipped candidate, so
every candidate is skipped independently, every occurrence of a word draws anew, and a task that
repeats gives the same ids. Symbols that are no pieces become bytes.

A text falls into chunks that are encoded alone: runs of letters, digits or other characters with the blanks
before them. Merges never cross such bounds because no piece does; that is checked for every piece when the
model is read, and a model with such pieces gets wider chunks, cut before blanks only.

A chunk's ids follow from which of its candidates are skipped. They are remembered as a tree: a chunk without
skips is a root that knows its number of candidates, and its children are named by the next skipped candidate.
All chunks of a pass walk down together; what the tree lacks is merged in lock step, row by row
of one matrix of symbols. The tree is bounded and begins anew when it is full; memory changes no ids.

Decoding joins the pieces' bytes and drops the first blank. It gives back every text, also with U+2581
in it: that character is written as bytes, where SentencePiece itself would turn it into a blank.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows
have equal ids; a null doc_id is keyed by its text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import KEY_BYTES, CodeTable, KeyTable, Lists, chunk_keys, code_points, first_of_each, text_windows
from .common import mix, ranges

RATE, SEED = 0.1, 17
#: Remembered segmentations of a worker, as a power of two; the table is twice as large.
MEMORY_BITS = 19
#: Rows of symbols that are merged in lock step at once, and the characters of the longest ones.
ROWS, ROW_CHARS = 1 << 15, 64
#: Bytes of text in one pass.
PASS_BYTES = 2 << 20
#: Ways to cut a text: a chunk, the classes of its characters (the last pattern is the blank), bytes that always begin one.
#: Finest first; the first that cuts no piece is taken.
CHUNKS = (
    (re.compile(r" *(?:[^\W\d_²]+|\d+|(?:[^\w ]|[_²])+)| +"), [r"[^\W\d_²]", r"\d", r"[^\w ]|[_²]", " "], b" \n"),
    (re.compile(r" +[^ ]*|[^ ]+"), ["[^ ]", " "], b" "),
)
_MASK = (1 << 64) - 1
_NONE = np.int32(np.iinfo(np.int32).max)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def gaps(keys: np.ndarray, turn: int | np.ndarray, rate: float) -> np.ndarray:
    """Candidates before the next skipped one, for the `turn`-th skip of each key: geometric with the given rate."""
    if rate <= 0:
        return np.full(len(keys), _NONE, np.int32)
    u = ((mix(keys + np.atleast_1d(turn + 1).astype(np.uint64) * _GOLD) >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
    return np.minimum(np.floor(np.log(u) / np.log1p(-min(rate, 1 - 1e-12))), 1 << 30).astype(np.int32)


def chunk_key(document: np.ndarray | int, place: np.ndarray | int) -> np.ndarray:
    """Key of the draws of the chunk at a byte place of the blank and text of a document with this key."""
    return mix((np.atleast_1d(place).astype(np.uint64) + np.uint64(1)) * _GOLD ^ np.asarray(document, np.uint64))


def skips_of(key: np.uint64, rate: float) -> Iterator[int]:
    """Numbers of the skipped candidates of one chunk, in order."""
    at, turn, block = -1, 0, 8
    while True:
        found = at + np.cumsum(gaps(np.full(block, key), np.arange(turn, turn + block), rate).astype(np.int64) + 1)
        yield from found.tolist()
        at, turn, block = int(found[-1]), turn + block, min(2 * block, 1 << 16)


def skip_rows(keys: np.ndarray, bound: np.ndarray, rate: float) -> np.ndarray:
    """The skipped numbers below `bound` of each chunk, in rows that end in _NONE."""
    out, last, turn = [], np.full(len(keys), -1, np.int64), 0
    while len(last) and (last < bound).any():
        last = last + 1 + gaps(keys, turn, rate)
        out.append(np.where(last < bound, last, _NONE).astype(np.int32))
        turn += 1
    return np.stack(out, 1) if out else np.zeros((len(keys), 0), np.int32)


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes.append(b"")
            else:
                text = piece.replace("▁", " ")
                self.id[text], self.score[text] = i, sp.get_score(i)
                self.bytes.append(text.encode())
        for pattern, classes, self.breaks in CHUNKS:
            if all(len(pattern.findall(text)) == 1 for text in self.id):
                break
        else:
            raise ValueError("a piece has a blank behind another character")
        self.blank, self.classes = len(classes) - 1, CodeTable.of_classes(classes)
        # a character that is no piece is a symbol behind all pieces
        self.size = len(self.bytes)
        self.symbols = CodeTable(lambda c: self.id.get(c, self.size + ord(c)), np.int32)
        # every way to join two symbols to a piece; equal scores share a rank
        rank = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs = [(self.id[t[:k]], self.id[t[k:]], i, rank[self.score[t]]) for t, i in self.id.items() for k in range(1, len(t)) if t[:k] in self.id and t[k:] in self.id]
        pairs = np.array(pairs, np.int64).reshape(-1, 4)
        # the last entry stands for no pair
        self.joined, self.rank = np.append(pairs[:, 2], 0).astype(np.int32), np.append(pairs[:, 3], _NONE).astype(np.int32)
        self.pairs = KeyTable(max(4, int(4 * len(pairs)).bit_length()))
        self.pairs.add(self._pair(pairs[:, 0], pairs[:, 1]), np.zeros(len(pairs), np.uint64), np.arange(len(pairs), dtype=np.int32))
        self.piece_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.piece_size = np.array([len(b) for b in self.bytes], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def join(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece of two symbols and its rank, where they make one; else any piece and _NONE."""
        at = self.pairs.find(self._pair(left, right).ravel(), np.zeros(left.size, np.uint64)).reshape(left.shape)
        return self.joined[at], self.rank[at]

    def ids_of(self, symbol: str) -> list[int]:
        i = self.id.get(symbol)
        return [i] if i is not None else [self.byte_id[b] for b in symbol.encode("utf-8", "surrogatepass")]

    def merge(self, chunk: str, skips: Iterator[int] = iter(())) -> list[int]:
        """Ids of one chunk of any characters and length, its candidates of these numbers skipped."""
        n, get = len(chunk), self.score.get
        if n == 1:
            return self.ids_of(chunk)
        end = list(range(1, n + 1))  # end[i]: end of the symbol that starts at i
        before = list(range(-1, n - 1))  # before[i]: start of the symbol before it
        agenda = [(-s, i, i + 1, i + 2) for i in range(n - 1) if (s := get(chunk[i : i + 2])) is not None]
        heapq.heapify(agenda)
        number, skip = -1, next(skips, -1)
        while agenda:
            _, a, b, c = heapq.heappop(agenda)
            if end[a] != b or b >= n or end[b] != c:
                continue  # one of its sides has been merged since
            number += 1
            if number == skip:
                skip = next(skips, -1)
                continue
            end[a], end[b] = c, 0
            if c < n:
                before[c] = a
                if (s := get(chunk[a : end[c]])) is not None:
                    heapq.heappush(agenda, (-s, a, c, end[c]))
            p = before[a]
            if p >= 0 and (s := get(chunk[p:c])) is not None:
                heapq.heappush(agenda, (-s, p, a, c))
        out, at = [], 0
        while at < n:
            out += self.ids_of(chunk[at : end[at]])
            at = end[at]
        return out

    def merge_rows(self, symbols: np.ndarray, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids (concatenated), their number and the candidates of each row of `symbols` (-1 behind a row's end).

        skips: numbers of each row's skipped candidates in order, then _NONE. All rows take their best
        candidate in the same step; rows without candidates leave.
        """
        n, width = symbols.shape
        # sym[r, p]: the symbol that begins at p, -1 where none does; after and before link the symbols of a row
        sym = np.concatenate([symbols, np.full((n, 1), -1, np.int32)], 1)
        after, before = np.tile(np.arange(1, width + 2), (n, 1)), np.tile(np.arange(-1, width), (n, 1))
        rank, new = np.full((n, width), _NONE, np.int32), np.zeros((n, width), np.int32)
        new[:, :-1], rank[:, :-1] = self.join(sym[:, : width - 1], sym[:, 1:width])
        counts, turn, live = np.zeros(n, np.int32), np.zeros(n, np.int64), np.arange(n)
        skips = np.concatenate([skips, np.full((n, 1), _NONE, np.int32)], 1)
        while True:
            best = rank[live].argmin(1)
            going = rank[live, best] < _NONE
            r, p = live[going], best[going]
            live = r
            if not len(r):
                break
            skip = skips[r, turn[r]] == counts[r]
            counts[r] += 1
            turn[r] += skip
            rank[r, p] = _NONE
            r, p = r[~skip], p[~skip]
            q = after[r, p]
            sym[r, p], sym[r, q] = new[r, p], -1
            follow = after[r, q]
            after[r, p] = follow
            rank[r, q] = _NONE
            inner = np.flatnonzero(follow < width)
            before[r[inner], follow[inner]] = p[inner]
            lead = before[r, p]
            has = np.flatnonzero(lead >= 0)
            row, left, right = np.concatenate([r[inner], r[has]]), np.concatenate([p[inner], lead[has]]), np.concatenate([follow[inner], p[has]])
            new[row, left], rank[row, left] = self.join(sym[row, left], sym[row, right])
        kept = sym >= 0
        return sym[kept], kept.sum(1).astype(np.int32), counts

    def with_bytes(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols in lists of these sizes: characters that are no pieces become bytes."""
        other = np.flatnonzero(symbols >= self.size)
        if not len(other):
            return symbols, sizes
        cp = symbols[other] - self.size
        n = 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000)
        times = np.ones(len(symbols), np.int64)
        times[other] = n
        out, at = np.repeat(symbols, times), (np.cumsum(times) - times)[other]
        for k in range(4):
            own = np.flatnonzero(n > k)
            rest = cp[own] >> (6 * (n[own] - 1 - k))
            head = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n[own]] if k == 0 else 0x80
            byte = np.where(n[own] == 1, cp[own], head | (rest if k == 0 else rest & 0x3F))
            out[at[own] + k] = np.array(self.byte_id)[byte]
        return out, np.add.reduceat(times, np.cumsum(sizes) - sizes).astype(np.int32)


class Encoder:
    def __init__(self, model: PieceModel, rate: float = 0.0, seed: int = 0):
        self.model, self.rate, self.seed = model, rate, seed
        self._forget()

    def _forget(self) -> None:
        self.roots, self.children = KeyTable(MEMORY_BITS + 1), KeyTable(MEMORY_BITS + 1)
        self.lists, self.counts = Lists(), np.zeros(1 << 12, np.int32)

    def _store(self, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        new = self.lists.extend(ids, sizes)
        while self.lists.n > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.counts[new] = counts
        return new.astype(np.int32)

    def _merged(self, symbols: np.ndarray, first: np.ndarray, length: np.ndarray, skips: np.ndarray) -> np.ndarray:
        """New nodes of the chunks at symbols[first : first + length] with the given skipped numbers."""
        out = np.empty(len(first), np.int32)
        by = np.argsort(length, kind="stable")  # rows of about one length go together
        at = 0
        while at < len(by):
            own = by[at : at + ROWS]
            own = own[length[own] <= length[own[0]] + 4]
            width = int(length[own[-1]])
            columns = np.arange(width)
            inside = columns < length[own][:, None]
            rows = np.where(inside, symbols[np.minimum(first[own][:, None] + columns, len(symbols) - 1)], -1)
            found, sizes, counts = self.model.merge_rows(rows.astype(np.int32), skips[own])
            out[own] = self._store(*self.model.with_bytes(found, sizes), counts)
            at += len(own)
        return out

    def encode_pass(self, buf: np.ndarray, offs: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a pass's windows, concatenated, and their number in each.

        keys, places: key of each window's document, and the window's place in its text.
        """
        model = self.model
        if max(self.roots.held, self.children.held) > 1 << MEMORY_BITS:
            self._forget()
        at, cp = code_points(buf)
        kind, symbol = model.classes[cp], model.symbols[cp]
        begins = np.zeros(len(at), bool)
        bounds = np.searchsorted(at, offs)
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        begins[1:] |= (kind[:-1] != model.blank) & (kind[1:] != kind[:-1])
        first = np.flatnonzero(begins)
        if not len(first):
            return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
        length = np.diff(first, append=len(at))
        start = at[first]
        size = np.diff(start, append=len(buf))
        window = np.searchsorted(offs, start, "right") - 1
        key = chunk_key(keys[window], start - offs[window] + places[window])
        # very long chunks are merged one by one; long ones in rows, but they have no place in the tree
        odd = length > ROW_CHARS
        node = np.empty(len(first), np.int32)
        plain = np.flatnonzero(~odd & (size <= KEY_BYTES))
        self._walk(node, plain, *chunk_keys(buf, start[plain], size[plain]), symbol, first, length, key)
        long = np.flatnonzero(~odd & (size > KEY_BYTES))
        # a chunk of n characters has less than 3 n candidates
        node[long] = self._merged(symbol, first[long], length[long], skip_rows(key[long], 3 * length[long], self.rate))
        odd = np.flatnonzero(odd)
        if len(odd):
            raw = buf.tobytes()
            found = [model.merge(raw[start[i] : start[i] + size[i]].decode(), skips_of(key[i], self.rate) if self.rate > 0 else iter(())) for i in odd.tolist()]
            sizes = np.array([len(x) for x in found], np.int32)
            node[odd] = self._store(np.concatenate([np.array(x, np.int32) for x in found]), sizes, np.zeros(len(odd), np.int32))
        n_ids = self.lists.size[node].astype(np.int64)
        ids = self.lists.flat[ranges(self.lists.start[node], n_ids)]
        return ids, np.bincount(window, n_ids, len(offs) - 1).astype(np.int64)

    def _walk(self, node: np.ndarray, plain: np.ndarray, k1: np.ndarray, k2: np.ndarray, symbol: np.ndarray, first: np.ndarray, length: np.ndarray, key: np.ndarray) -> None:
        """The tree's node of each plain chunk, by all its skipped candidates; missing nodes are made."""
        here = self._found(self.roots, k1, k2, lambda new: self._merged(symbol, first[plain[new]], length[plain[new]], np.zeros((len(new), 0), np.int32)))
        node[plain] = here
        skips, turn, own = np.zeros((len(plain), 0), np.int32), 0, plain
        last = np.full(len(plain), -1, np.int32)
        while len(own):
            last = last + 1 + gaps(key[own], turn, self.rate)
            on = last < self.counts[here]
            own, here, last = own[on], here[on], last[on]
            skips, turn = np.concatenate([skips[on], last[:, None]], 1), turn + 1
            if len(own):
                here = self._found(self.children, here.astype(np.uint64), last.astype(np.uint64), lambda new: self._merged(symbol, first[own[new]], length[own[new]], skips[new]))
                node[own] = here

    @staticmethod
    def _found(table: KeyTable, k1: np.ndarray, k2: np.ndarray, make) -> np.ndarray:
        out = table.find(k1, k2)
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new, which = first_of_each(k1[missing], k2[missing])
            nodes = make(missing[new])
            out[missing] = nodes[which]
            table.add(k1[missing[new]], k2[missing[new]], nodes)
        return out

    def document_key(self, text: bytes, document: int | None) -> int:
        return xxhash.xxh3_64_intdigest(text if document is None else str(document), self.seed & _MASK)

    def encode_texts(self, texts: pa.Array, documents: list[int | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, ids, their number and whether they decode to the text, for each row), pass after pass."""
        raw = texts.cast(pa.large_binary())
        keys = np.array([self.document_key(raw[i].as_py() or b"" if d is None else b"", d) for i, d in enumerate(documents)], np.uint64)
        held, fine = [], True  # of a text in several windows
        for rows, places, ends, buf, offs in text_windows(texts, b" ", PASS_BYTES, self.model.breaks):
            ids, counts = self.encode_pass(buf, offs, keys[rows], places)
            ok = self._lossless(ids, counts, buf, offs)
            if held or not ends[0]:
                held, fine = [*held, ids], fine and bool(ok[0])
                if not ends[0]:
                    continue
                ids, ok = np.concatenate(held), np.array([fine])
                counts, held, fine = np.array([len(ids)]), [], True
            yield rows, ids, counts, ok

    def _lossless(self, ids: np.ndarray, counts: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        back = self.decoded(ids)
        if len(back) == len(buf) and (back == buf).all():
            cut = np.concatenate([[0], np.cumsum(self.model.piece_size[ids])])[np.concatenate([[0], np.cumsum(counts)])]
            if (cut == offs).all():
                return np.ones(len(counts), bool)
        ends = np.concatenate([[0], np.cumsum(counts)])
        return np.array([self.decoded(ids[a:b]).tobytes() == buf[x:y].tobytes() for a, b, x, y in zip(ends[:-1], ends[1:], offs[:-1], offs[1:])], bool)

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, the first blank included."""
        m = self.model
        return m.piece_bytes[ranges(m.piece_start[ids], m.piece_size[ids])]

    def encode(self, text: str, document: int | None = None) -> list[int]:
        """Ids of one text; `document` keys the dropout, None takes the text itself."""
        return [i for _, ids, _, _ in self.encode_texts(pa.array([text], pa.string()), [document]) for i in ids.tolist()]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        return self.decoded(np.asarray(ids, np.int64)).tobytes()[1:].decode()


def encode_documents(documents: DataFrame, model: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, n_ids, ids, lossless (decoding gave the text back) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(PieceModel(model), rate, seed)
        for batch in batches:
            docs = batch.column("doc_id")
            for rows, ids, counts, ok in encoder.encode_texts(batch.column("text"), docs.to_pylist()):
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([docs.take(pa.array(rows)), pa.array(counts.astype(np.int64)), lists, pa.array(ok)], names=["doc_id", "n_ids", "ids", "lossless"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_ids long, ids array<int>, lossless boolean")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of encoded documents (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(PieceModel(model))
        for batch in batches:
            texts = [encoder.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")

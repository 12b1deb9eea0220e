"""Operator 2: token ids as bit-packed binary files.

A file holds whole documents in ascending doc_id order:

    magic "SLBP", u8 version, u8 bits, u16 zero, u32 block, u64 documents, u64 ids, u64 blocks
    i64 doc_id, u64 end (ids up to and with this document) for each document
    u64 offset of each block in the payload, and the payload's length
    payload: blocks of `block` ids, each id in the fewest bits that hold the vocabulary, byte-aligned

Blocks unpack in one numpy step and any document is reached through its end and the block offsets.
Spark carries the files as rows (part, seq, payload) of a Parquet folder, so they can be in any store
Spark writes to; `seq` counts a part's files, and (part, seq) is the global order.

Tokens come from the tokenizers library. Byte-level BPE treats each piece of its split pattern
alone, so a pass finds the pieces of about a megabyte of text, the library encodes those that are not
in a bounded memory, and the ids of all are gathered at once.

Defined results: null text is empty and gets the end id alone; null doc_ids come first; rows of one doc_id
are in the order of a hash of their text, then the text; repeated rows are written each; an empty table gives no files; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import KEY_BYTES, CodeTable, KeyTable, Lists, chunk_keys, code_points, first_of_each, text_windows
from .common import ranges, shuffles, stored

BLOCK = 4096
FILE_IDS = 1 << 21
END_ID = 0
#: Remembered pieces of a worker, as a power of two.
MEMORY_BITS = 19
#: Classes of characters in the split pattern of byte-level BPE: 's 't 're 've 'm 'll 'd, an optional blank and letters,
#: digits or others, white space but for its last character before another piece, white space.
CLASSES = [r"[^\W\d_]", r"\d", r"\s"]
SPACE, OTHER = 2, 3
#: Texts with other characters than these go to the library whole: classes may differ there (control separators,
#: superscripts and fractions, marks, letters of later Unicode versions).
UNKNOWN = r"[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\x{02af}Ά-ώЀ-ҁ‐-‧₠-₵ぁ-ゖァ-ヺ一-龥가-힣]"
_HEAD = struct.Struct("<4sBBHIQQQ")


def vocabulary_bits(size: int) -> int:
    return max(1, int(size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    on = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(on.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype(np.uint32)
    on = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (on.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def write_file(doc_ids: list[int | None], counts: list[int] | np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    docs = np.array([-(1 << 63) if d is None else d for d in doc_ids], "<i8")
    head = _HEAD.pack(b"SLBP", 1, bits, 0, block, len(docs), len(ids), len(blocks))
    return b"".join([head, docs.tobytes(), np.cumsum(counts).astype("<u8").tobytes(), offsets.tobytes(), *blocks])


class PackedFile:
    """Reader with random access by document and by id range."""

    def __init__(self, raw: bytes):
        magic, version, self.bits, _, self.block, docs, self.n_ids, blocks = _HEAD.unpack_from(raw)
        if magic != b"SLBP" or version != 1:
            raise ValueError("not a packed id file")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        self.ends = np.frombuffer(raw, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1, at + 16 * docs).astype(np.int64)
        self.payload = memoryview(raw)[at + 16 * docs + 8 * (blocks + 1) :]

    def read(self, start: int, end: int) -> np.ndarray:
        if end <= start:
            return np.zeros(0, np.uint32)
        lo, hi = start // self.block, -(-end // self.block)
        if self.bits in (8, 16, 32):  # aligned blocks lie without gaps
            ids = unpack(self.payload[self.offsets[lo] : self.offsets[hi]], min(hi * self.block, self.n_ids) - lo * self.block, self.bits)
        else:
            ids = np.concatenate([unpack(self.payload[self.offsets[b] : self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits) for b in range(lo, hi)])
        return ids[start - lo * self.block : end - lo * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.read(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


class Encoder:
    """The tokenizer of a file; ids equal tokenizer.encode(text, add_special_tokens=False).ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = vocabulary_bits(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.by_piece = isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and not self.tokenizer.pre_tokenizer.add_prefix_space and self.tokenizer.normalizer is None
        # byte-level BPE writes byte b as the b-th of these characters
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = iter(range(256, 512))
        self.alphabet = "".join(chr(b) if b in plain else chr(next(others)) for b in range(256))
        self.by_piece = self.by_piece and set(self.alphabet) == set(ByteLevel.alphabet())
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = CodeTable.of_classes(CLASSES)
        self._forget()

    def _forget(self) -> None:
        self.memory, self.lists = KeyTable(MEMORY_BITS + 1), Lists()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _pieces(self, pieces: list[bytes]) -> np.ndarray:
        """New lists of the pieces' ids, straight from the library's BPE model."""
        found = [[t.id for t in self.tokenizer.model.tokenize(p.decode("latin-1").translate(self.alphabet))] for p in pieces]
        return self.lists.extend(np.fromiter((i for f in found for i in f), np.int32), np.array([len(f) for f in found], np.int32)).astype(np.int32)

    def _begins(self, buf: np.ndarray, at: np.ndarray, cp: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether each character begins a piece of the split pattern; bounds: first character of each window, and the end."""
        kind = self.classes[cp]
        begins, head = np.zeros(len(at), bool), np.zeros(len(at) + 1, bool)
        head[bounds] = True
        head = head[:-1]
        before = np.concatenate([[OTHER], kind[:-1]])
        space = kind == SPACE
        # behind white space only a blank joins what follows
        joined = np.concatenate([[False], cp[:-1] == 0x20])
        begins = np.where(space | (before != SPACE), kind != before, ~joined)
        # the last of several white-space characters stands before the next piece
        follows = np.concatenate([~space[1:] & ~head[1:], [False]])
        begins |= space & (before == SPACE) & follows
        begins |= head
        # 's 't 'm 'd 're 've 'll, where the apostrophe itself begins a piece
        quote = np.flatnonzero(begins & (cp == 0x27))
        if len(quote):
            window_end = bounds[np.searchsorted(bounds, quote, "right")]
            padded = np.concatenate([cp, [0, 0]])
            one, two = np.where(quote + 1 < window_end, padded[quote + 1], 0), np.where(quote + 2 < window_end, padded[quote + 2], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for q, size in ((quote[short], 2), (quote[long], 3)):
                begins[q + 1] = False
                begins[(q + size)[q + size < len(begins)]] = True
        return begins

    def encode_pass(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a pass's windows, concatenated, and their number in each."""
        if self.memory.held > 1 << MEMORY_BITS:
            self._forget()
        at, cp = code_points(buf)
        if not len(at):
            return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
        start = at[self._begins(buf, at, cp, np.searchsorted(at, offs))]
        size = np.diff(start, append=len(buf))
        k1, k2 = chunk_keys(buf, start, size)
        node = self.memory.find(k1, k2)
        long = size > KEY_BYTES
        node[long] = -1
        raw = buf.tobytes()
        piece = lambda i: raw[start[i] : start[i] + size[i]]
        missing = np.flatnonzero((node < 0) & ~long)
        if len(missing):
            new, which = first_of_each(k1[missing], k2[missing])
            new = missing[new]
            found = self._pieces([piece(i) for i in new.tolist()])
            node[missing] = found[which]
            self.memory.add(k1[new], k2[new], found)
        if long.any():
            node[long] = self._pieces([piece(i) for i in np.flatnonzero(long).tolist()])
        n_ids = self.lists.size[node].astype(np.int64)
        window = np.searchsorted(offs, start, "right") - 1
        return self.lists.flat[ranges(self.lists.start[node], n_ids)], np.bincount(window, n_ids, len(offs) - 1).astype(np.int64)

    def encode_texts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, ids, their number for each row), pass after pass."""
        texts = texts.cast(pa.large_string())
        whole = pa.array(np.ones(len(texts), bool))
        if self.by_piece:
            whole = pc.match_substring_regex(texts, UNKNOWN)
            for s in self.special:
                whole = pc.or_(whole, pc.match_substring(texts, s))
        whole = pc.fill_null(whole, False)
        alone = whole.to_numpy(zero_copy_only=False)
        held: list[np.ndarray] = []  # of a text in several windows
        for rows, _, ends, buf, offs in text_windows(pc.if_else(whole, pa.scalar(None, pa.large_string()), texts)):
            ids, counts = self.encode_pass(buf, offs)
            if alone[rows].any():
                parts = np.split(ids, np.cumsum(counts)[:-1])
                parts = [self._whole(texts[r].as_py()) if alone[r] else x for r, x in zip(rows.tolist(), parts)]
                ids, counts = np.concatenate(parts), np.array([len(x) for x in parts])
            if held or not ends[0]:
                held.append(ids)
                if not ends[0]:
                    continue
                ids, held = np.concatenate(held), []
                counts = np.array([len(ids)])
            yield rows, ids, counts

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return np.concatenate([np.zeros(0, np.int32), *(ids for _, ids, _ in self.encode_texts(pa.array([text], pa.string())))])


def write_ids(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode `documents` (doc_id, text) and write the files; returns them: part, seq, n_ids, payload."""
    n = shuffles(documents.sparkSession)
    # equal doc_ids are told apart by a hash of the text, so that one of them can be dealt to several parts
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
    docs = docs.repartitionByRange(n, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq, size = Encoder(tokenizer), 0, 0, 0
        docs, counts, held = [], [], []

        def file() -> pa.RecordBatch:
            n = np.concatenate(counts)
            raw = write_file([d for own in docs for d in own.to_pylist()], n, np.concatenate(held), encoder.bits)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([int(n.sum())], pa.int64()), pa.array([raw], pa.binary())], names=["part", "seq", "n_ids", "payload"])

        for batch in batches:
            for rows, ids, own in encoder.encode_texts(batch.column("text")):
                part = batch.column("part")[0].as_py()
                out = np.full(len(ids) + len(rows), end_id, np.uint32)
                last = np.zeros(len(out), bool)
                last[np.cumsum(own + 1) - 1] = True
                out[~last] = ids
                docs.append(batch.column("doc_id").take(pa.array(rows)))
                counts.append(own + 1)
                held.append(out)
                size += len(out)
                if size >= FILE_IDS:
                    yield file()
                    seq += 1
                    docs, counts, held, size = [], [], [], 0
        if docs:
            yield file()

    return stored(docs.withColumn("part", F.spark_partition_id()).mapInArrow(run, "part int, seq int, n_ids long, payload binary"))


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row for each part is ordered in one task, the files only inside their part
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", earlier(Window.orderBy("part")).alias("base"))
    inside = files.select("part", "seq", earlier(Window.partitionBy("part").orderBy("seq")).alias("first"))
    starts = inside.join(parts, "part").select("part", "seq", (F.col("base") + F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "payload"))):
                f = PackedFile(raw)
                ids = memoryview(f.read(0, f.n_ids).astype("<u4").tobytes())
                begin = np.concatenate([[0], f.ends[:-1]])
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begin.tolist(), f.ends.tolist())]
                docs = pa.array(f.doc_ids, mask=f.doc_ids == -(1 << 63))
                k = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array([part] * k, pa.int32()), pa.array([seq] * k, pa.int32()), docs, pa.array(begin), pa.array(f.ends - begin), pa.array(crc, pa.int64())], names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = files.select("part", "seq", "payload").mapInArrow(run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

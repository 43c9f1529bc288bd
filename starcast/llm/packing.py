"""Sum-of-squares packing of tokenized documents into fixed windows.

Every task packs the documents of its own input partition online: a level
array counts the partially filled windows of each fill level, and a
document goes to the level (or a new window) that gives the smallest sum
of squared counts. Nothing is shuffled: documents of one partition are
enough to keep all but a handful of windows full, and those are closed by
cutting.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 2048
END_ID = 1
OPEN_LIMIT = 4096
CACHE_WORDS = 400_000
OUT_PIECES = 1024

# Fixed values of the vocabulary file's pre-tokenization, restricted to
# printable ASCII and the Latin-1 letters that no normalization changes.
SIMPLE_CHUNK = r"[!-~À-ÖØ-öø-ÿ]+"
SIMPLE_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"


# Fixed values of the vocabulary file: what the short way rests on.
SPLIT_RULES = {
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "added": {"<|startoftext|>", "<|endoftext|>"},
}


def has_split_rules(path: str) -> bool:
    """Does the tokenizer file split texts by ``SPLIT_RULES``?"""
    import json

    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    normal, before, model = (rules.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    steps = before.get("pretokenizers") or [{}]
    return (normal.get("normalizers") == SPLIT_RULES["normalizers"] and model.get("type") == "BPE"
            and [x.get("type") for x in steps] == ["Split", "ByteLevel"] and steps[0].get("behavior") == "Removed"
            and steps[0].get("invert") is True and steps[0].get("pattern") == {"Regex": SPLIT_RULES["pattern"]}
            and steps[1].get("add_prefix_space") is False and steps[1].get("use_regex") is False
            and {x["content"] for x in rules.get("added_tokens") or []} <= SPLIT_RULES["added"])


class TextEncoder:
    """Ids of whole texts by the tokenizer itself, for files of other rules."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)

    def ids(self, text: bytes) -> bytes:
        return np.array(self.full.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype="<u4").tobytes()


def encoder(path: str):
    return WordEncoder(path) if has_split_rules(path) else TextEncoder(path)


class WordEncoder(dict):
    """Ids of white-space separated chunks as little-endian uint32 bytes.

    Neither the vocabulary's pieces nor its added tokens cross white space,
    so a text's ids are its chunks' ids in a row, and a chunk is encoded
    once. Chunks of simple letters go straight to the vocabulary's merge
    model piece by piece; every other chunk takes the full encoder.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        super().__init__()
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.limit = limit
        self.pieces: dict[str, bytes] = {}
        self.simple = re.compile(SIMPLE_CHUNK).fullmatch
        self.split = re.compile(SIMPLE_PIECE).findall
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def piece(self, text: str) -> bytes:
        shown = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
        ids = np.array([x.id for x in self.model.tokenize(shown)], dtype="<u4").tobytes()
        if len(self.pieces) >= self.limit:
            self.pieces.clear()
        self.pieces[text] = ids
        return ids

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.simple(text) and "<|" not in text:
            known = self.pieces.get
            ids = b"".join([known(p) or self.piece(p) for p in self.split(text.lower())])
        else:
            ids = np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) >= self.limit:
            self.clear()
        self[chunk] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


class Packer:
    """Online sum-of-squares packing of one stream of documents.

    ``emit(row)`` receives ``(doc, start, ids, doc_tokens, sequence,
    offset)`` when a window is complete. Open windows keep their ids (at
    most ``open_limit`` windows); beyond that, and at the end, they are
    closed by cutting.
    """

    def __init__(self, emit, first_sequence: int, size: int = SEQUENCE, open_limit: int = OPEN_LIMIT):
        self.emit, self.next, self.size, self.open_limit = emit, first_sequence, size, open_limit
        self.levels = np.zeros(size + 1, dtype=np.int64)  # open windows by fill
        self.windows: list[list] = [[] for _ in range(size)]
        self.open = 0

    def _close(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.emit((doc, start, ids, total, self.next, at))
            at += len(ids) // 4
        self.next += 1

    def level_for(self, n: int) -> int:
        """Fill level whose use gives the least sum of squares (0: a new window); ties to the fullest."""
        size, levels = self.size, self.levels
        best, cost = 0, 2 * levels[n] + 1
        have = np.flatnonzero(levels[1:size - n + 1]) + 1
        if have.size:
            costs = 2 * (levels[have + n] - levels[have]) + 2
            costs[have + n == size] -= 1
            i = costs.size - 1 - int(np.argmin(costs[::-1]))
            if costs[i] <= cost:
                best = int(have[i])
        return best

    def add(self, doc, ids: bytes) -> None:
        size, total = self.size, len(ids) // 4
        start = 0
        while total - start >= size:
            self._close([(doc, start, ids[4 * start:4 * (start + size)], total)])
            start += size
        n = total - start
        if not n:
            return
        level = self.level_for(n)
        pieces = self.windows[level].pop() if level else []
        pieces.append((doc, start, ids[4 * start:], total))
        if level:
            self.levels[level] -= 1
            self.open -= 1
        if level + n == size:
            self._close(pieces)
        else:
            self.levels[level + n] += 1
            self.windows[level + n].append(pieces)
            self.open += 1
            if self.open >= self.open_limit:
                self.close_all(keep_tail=True)

    def close_all(self, keep_tail: bool = False) -> None:
        """Join the open windows' pieces and cut them into full windows; the
        rest becomes windows whose lengths are powers of two, which need no
        padding (or one open window with ``keep_tail``)."""
        queue = [p for level in range(self.size - 1, 0, -1) for w in self.windows[level] for p in w]
        self.windows = [[] for _ in range(self.size)]
        self.levels[:] = 0
        self.open = 0
        left = sum(len(p[2]) // 4 for p in queue)
        room, pieces = 0, []
        queue.reverse()
        while left or pieces:
            if not pieces:
                if keep_tail and left < self.size:
                    self.windows[left].append(queue[::-1])
                    self.levels[left] += 1
                    self.open = 1
                    return
                room = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            doc, start, ids, total = queue.pop()
            n = min(room, len(ids) // 4)
            pieces.append((doc, start, ids[:4 * n], total))
            if 4 * n < len(ids):
                queue.append((doc, start + n, ids[4 * n:], total))
            room -= n
            left -= n
            if not room:
                self._close(pieces)
                pieces = []


def pack(docs: DataFrame, tokenizer_path: str, *, size: int = SEQUENCE, end_id: int = END_ID,
         open_limit: int = OPEN_LIMIT) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into windows of ``size`` ids.

    A document's ids are its text's ids by the vocabulary file, then
    ``end_id``. Returns one row per piece: ``doc_id``, ``start`` (ids of
    the document before it), ``ids`` (little-endian uint32 bytes),
    ``doc_tokens``, ``sequence_id`` and ``offset``. Every id lies in one
    piece, and pieces fill a sequence from 0 without gaps. Sequences hold
    ``size`` ids, or a power of two of them at a partition's end.

    Null or empty text: only the end id. Very long texts: cut into full
    windows, the rest packed. Repeated rows and null ids: each row is a
    document of its own. Empty table: no rows. Other columns are not read.
    Sequence ids start at the partition number times 2^33, so they are
    unique without a global count; the input should be a stable read
    (files or a checkpoint), as a retried task packs its partition anew.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start bigint, ids binary, doc_tokens bigint, "
              "sequence_id bigint, `offset` bigint")
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode = encoder(tokenizer_path)
        out: list[tuple] = []
        packer = Packer(out.append, TaskContext.get().partitionId() << 33, size, open_limit)
        id_type = None

        def flush():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], type=id_type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())],
                names=["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            texts = batch.column(1).cast(pa.binary())
            for doc, text in zip(batch.column(0).to_pylist(), texts):
                packer.add(doc, encode.ids(text.as_py() or b"") + end)
                if len(out) >= OUT_PIECES:
                    yield flush()
        packer.close_all()
        if out:
            yield flush()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """Piece table without ids: lengths and CRC-32 of the id bytes."""
    return pieces.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")



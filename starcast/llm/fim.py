"""Fill-in-the-middle transformation on piece tables.

A document is a list of descriptors ``(buffer, start, stop)`` over immutable
byte buffers: its text and the sentinels. Cutting splits a descriptor in two,
an arrangement is a permutation of descriptors, and hashes and outputs stream
the descriptors' bytes. Nothing is copied before an output is asked for.
Restoring cuts the output at its sentinels and applies the inverse
permutation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SEED = 42
RATE = 50   # percent of documents that are rearranged
SPM = 80    # percent of those that put the suffix first
# The sentinels of the three parts.
SENTINELS = (b"<P>", b"<M>", b"<S>")
PREFIX, MIDDLE, SUFFIX = range(3)
# Parts in the order of the output, by form.
ARRANGEMENTS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
OUTPUT_BYTES = 8 * 2 ** 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


class Pieces:
    """Immutable buffers and a list of descriptors over them."""

    def __init__(self, buffers: tuple[bytes, ...], spans: list[tuple[int, int, int]]):
        self.buffers, self.spans = buffers, spans

    @classmethod
    def of(cls, data: bytes) -> Pieces:
        return cls((data,), [(0, 0, len(data))])

    def cut(self, *places: int) -> Pieces:
        """Split at ascending places, so that each of the len(places) + 1
        parts is one descriptor (empty ones stay). One descriptor only."""
        (buffer, start, stop), = self.spans
        edges = [start, *(start + p for p in places), stop]
        return Pieces(self.buffers, [(buffer, a, b) for a, b in zip(edges, edges[1:])])

    def permute(self, order) -> Pieces:
        return Pieces(self.buffers, [self.spans[i] for i in order])

    def marked(self, marks: list[bytes]) -> Pieces:
        """Every descriptor after a descriptor of its own sentinel."""
        first = len(self.buffers)
        return Pieces((*self.buffers, *marks), [s for i, span in enumerate(self.spans)
                                                for s in ((first + i, 0, len(marks[i])), span)])

    def stream(self):
        for buffer, start, stop in self.spans:
            yield memoryview(self.buffers[buffer])[start:stop]

    def data(self) -> bytes:
        return b"".join(self.stream())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()


def token_ends(data: bytes) -> np.ndarray:
    """Byte offset behind every token: white space and the word after it, or
    white space at the end of the text."""
    space = _SPACE[np.frombuffer(data, dtype=np.uint8)]
    if not len(space):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(space))


def transform(doc_id, data: bytes, *, seed: int = SEED, rate: int = RATE, spm: int = SPM):
    """``(tokens, form, pieces, prefix, middle)`` of one document; the parts
    are byte spans, None when the form is plain."""
    ends = token_ends(data)
    n = len(ends)
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[8 * i:8 * i + 8], 16) for i in range(4)]
    whole = Pieces.of(data)
    if not data or any(s in data for s in SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", whole, None, None
    form = "spm" if h[3] % 100 < spm else "psm"
    a, b = (int(ends[u - 1]) if u else 0 for u in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    order = ARRANGEMENTS[form]
    pieces = whole.cut(a, b).permute(order).marked([SENTINELS[p] for p in order])
    return n, form, pieces, data[:a], data[a:b]


def restore(output: bytes, form: str) -> Pieces:
    """The text that an output of that form was made from."""
    whole = Pieces.of(output)
    if form == "plain":
        return whole
    order = ARRANGEMENTS[form]
    marks = [SENTINELS[p] for p in order]
    starts = [output.index(m) for m in marks]
    places = [x for at, m in zip(starts, marks) for x in (at, at + len(m))]
    parts = whole.cut(*places).permute(range(2, 2 * len(marks) + 1, 2))  # what follows each sentinel
    inverse = np.argsort(order)
    return parts.permute(inverse)


def _chars(data: bytes | None):
    return None if data is None else len(data.decode("utf-8"))


def fill_in_middle(docs: DataFrame, *, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``doc_id, output, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256`` of every row of ``docs(doc_id, text)``.

    Cuts fall between tokens; ``rate`` percent of documents are rearranged,
    ``spm`` percent of these with the suffix first, all drawn from the
    sha256 of seed and id. Empty texts and texts that hold a sentinel stay
    plain. Null text: empty. A null id is drawn as an empty one. Repeated
    rows get equal results; other columns are not read. Long texts are
    handled whole, one text at a time. Empty table: no rows.
    """
    kind = docs.schema["doc_id"].dataType
    schema = (f"doc_id {kind.simpleString()}, output binary, n bigint, form string, prefix_chars bigint, "
              "middle_chars bigint, output_sha256 string, restored_sha256 string")

    def run(batches):
        for batch in batches:
            ids, rows, held = batch.column(0), [], 0
            first = 0

            def send(last):
                columns = list(zip(*rows))
                types = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                return pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), *(pa.array(c, t) for c, t in zip(columns, types))],
                    names=["doc_id", "output", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

            texts = batch.column(1)
            for i in range(batch.num_rows):
                data = texts[i].as_py() or b""
                n, form, pieces, prefix, middle = transform(ids[i].as_py(), data, seed=seed, rate=rate, spm=spm)
                output = pieces.data()
                rows.append((output, n, form, _chars(prefix), _chars(middle), pieces.sha256(), restore(output, form).sha256()))
                held += len(output)
                if held >= OUTPUT_BYTES:
                    yield send(i + 1)
                    first, rows, held = i + 1, [], 0
            if rows:
                yield send(batch.num_rows)

    return docs.selectExpr("doc_id", "cast(cast(text as string) as binary) as text").mapInArrow(run, schema)

"""Vectorised word kernel over blocks of UTF-8 texts.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09``-``\\x0D``; no byte
of a multi-byte code point falls into that set, so bytes and code points agree
on where words are.  Word and line hashes are polynomial prefix hashes modulo
2**64 over a fixed random byte table, mixed at the end; equal words always get
equal hashes, on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are gathered into blocks of about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 18
#: Rows of an Arrow batch that become Python objects at a time.
ROWS = 512

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_TABLE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, b, dtype=np.uint64)))) for b in (_BASE, _INVERSE)]
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser for 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(32))


def blocks(texts: list[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) of consecutive blocks; null is an empty text."""
    first, size, held = 0, 0, []
    for i, t in enumerate(texts):
        t = t or b""
        if held and size + len(t) > BLOCK_BYTES:
            yield first, held
            first, size, held = i, 0, []
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held


class Block:
    """Words of some texts: ``start``/``end`` byte offsets in ``buf`` and ``lo``/``hi`` word ranges of each text."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.offset = np.concatenate(([0], np.cumsum(sizes + 1)))
        space = _SPACE[self.buf]
        self.space = space
        turn = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.start, self.end = turn[0::2], turn[1::2]
        at = np.searchsorted(self.start, self.offset)
        self.lo, self.hi = at[:-1], at[1:]
        self._prefix = None

    def lower(self) -> np.ndarray:
        up = (self.buf >= 65) & (self.buf <= 90)
        return self.buf + (up.view(np.uint8) << 5)

    def hash_spans(self, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
        """Hashes of the byte spans [start, end), A-Z lower-cased if asked for."""
        if self._prefix is None or self._prefix[0] != lower:
            with np.errstate(over="ignore"):
                terms = _TABLE[self.lower() if lower else self.buf]
                terms *= _powers(len(self.buf))[0][: len(terms)]
                total = np.empty(len(terms) + 1, dtype=np.uint64)
                total[0] = 0
                np.cumsum(terms, out=total[1:])
            self._prefix = (lower, total)
        total = self._prefix[1]
        with np.errstate(over="ignore"):
            return mix((total[end] - total[start]) * _powers(len(self.buf))[1][start])

    def doc_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.hi - self.lo)


def windows(hashes: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, lo, hi) of all runs of ``width`` words within each text."""
    n = np.maximum(hi - lo - width + 1, 0)
    to = np.cumsum(n)
    out_lo, out_hi = to - n, to
    index = np.arange(int(to[-1]) if len(to) else 0) - np.repeat(out_lo, n) + np.repeat(lo, n)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(index), dtype=np.uint64)
        for k in range(width):
            acc = (acc ^ hashes[index + k]) * np.uint64(0x9FB21C651E98DF25)
            acc ^= acc >> np.uint64(31)
    return mix(acc), out_lo, out_hi


def map_texts(df, keys: list[str], text: str, kernel, fields: str):
    """``keys`` of ``df`` with the columns ``fields`` that ``kernel`` makes of each text.

    ``kernel`` gets a list of texts as bytes (null: empty) and returns one array
    or list per field.  Only the keys and the text leave the JVM; blocks bound
    the memory of a worker whatever the size of an Arrow batch.
    """
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    held = [f"_k{i}" for i in range(len(keys))]
    inner = df.select(*[F.col(k).alias(h) for k, h in zip(keys, held, strict=True)], F.col(text).cast("binary").alias("_text"))
    out = StructType([inner.schema[h] for h in held] + StructType.fromDDL(fields).fields)
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                some = batch.slice(k, ROWS)
                for first, part in blocks(some.column(len(held)).to_pylist()):
                    got = kernel(part)
                    columns = [some.column(i).slice(first, len(part)) for i in range(len(held))]
                    columns += [pa.array(x, type=f.type) for x, f in zip(got, list(arrow)[len(held) :], strict=True)]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    made = inner.mapInArrow(run, out)
    return made.select(*[F.col(h).alias(k) for k, h in zip(keys, held, strict=True)], *[f"`{f.name}`" for f in out.fields[len(held) :]])

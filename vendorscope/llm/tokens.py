"""Token counts by overlap resynchronisation.

A document of up to ``chunk_chars`` characters is encoded whole. A longer one is
encoded in chunks that overlap; from the character offsets of both encodings
the operator takes a token boundary that both have and that is *proven stable*,
and splices there. When the overlap holds no such boundary, it is doubled
and the chunk encoded again, in the end up to the end of the document.

Proof of stability: BPE only ever merges two neighbouring symbols into a piece
of the vocabulary. If no piece holds the character pair ``ab`` side by side, no
merge can cross a place between ``a`` and ``b``, whatever stands around
it; left and right are then tokenised independently. The pairs of all pieces
are read from the model file.

The model puts a blank before each input. A chunk that starts inside a
document is therefore encoded behind a character that no piece contains
(byte fallback makes one token of it); it shields the chunk from the blank, and the
leading tokens are not counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vendorscope.llm.common import rows

BLANK = "▁"  # the model's sign for a blank


class PieceModel:
    """A sentencepiece model with what splicing needs: lengths of pieces, pairs, a shield."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        plain = [not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i)) for i in range(n)]
        # Characters a token covers: the first byte of a character counts, its other bytes don't.
        self.chars = np.array([
            len(p) if ok else int(not 0x80 <= int(p[3:5], 16) < 0xC0) if self.sp.is_byte(i) else 1
            for i, (p, ok) in enumerate(zip(pieces, plain))], dtype=np.int64)
        self.pairs = {p[k:k + 2] for p, ok in zip(pieces, plain) if ok for k in range(len(p) - 1)}
        used = {c for p, ok in zip(pieces, plain) if ok for c in p}
        free = [c for c in "\n\x01\x02\x03\x04\x05\x06" if c not in used and len(self.sp.encode("a" + c)) == 1 + len(self.sp.encode("a"))]
        self.shield = free[0] if free else None
        # Splicing is proven for BPE without a normaliser that rewrites text.
        probe = "a  ﬁé é① 　b"
        self.spliceable = self.shield is not None and self.sp.decode(self.sp.encode(probe)) == probe

    def stable(self, text: str, at: int) -> bool:
        """No piece spans the place before ``text[at]``."""
        return text[at - 1:at + 1].replace(" ", BLANK) not in self.pairs

    def starts(self, text: str, lo: int, hi: int) -> np.ndarray:
        """Character offsets in ``text`` at which the tokens of ``text[lo:hi]`` start, and ``hi``."""
        if lo == 0:
            ids = np.asarray(self.sp.encode(text[:hi]), dtype=np.int64)
            # The model's own blank stands before the text: offsets are one less than in its input.
            at = np.concatenate([[0], np.cumsum(self.chars[ids])]) - 1
            return np.maximum(at, 0)
        ids = np.asarray(self.sp.encode(self.shield + text[lo:hi]), dtype=np.int64)
        at = np.concatenate([[0], np.cumsum(self.chars[ids])]) - 2 + lo
        return at[np.searchsorted(at, lo):]  # behind the blank and the shield

    def count(self, text: str, chunk: int, overlap: int) -> int:
        """Number of tokens of ``text``."""
        if len(text) <= chunk or not self.spliceable:
            return len(self.sp.encode(text))
        total, begin, end = 0, 0, chunk
        left = self.starts(text, 0, end)
        while end < len(text):
            wide, cut = overlap, None
            while True:
                lo = max(begin + 1, end - wide)
                if lo > begin + 1:
                    hi = min(len(text), lo + chunk + wide)
                    right = self.starts(text, lo, hi)
                    both = np.intersect1d(left[(left > lo) & (left < end)], right)
                    cut = next((int(p) for p in both if self.stable(text, int(p))), None)
                    if cut is not None:
                        break
                    wide *= 2
                else:  # the overlap has reached the last splice: a larger chunk from there
                    end = min(len(text), end + (end - begin))
                    left = self.starts(text, begin, end)
                    if end == len(text):
                        return total + len(left) - 1
                    wide = overlap
            total += int(np.searchsorted(left, cut))
            # The right encoding started at an unproven place; behind the proven cut it is exact.
            left, begin, end = right[np.searchsorted(right, cut):], cut, hi
        return total + len(left) - 1


@lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, chunk_chars: int = 16384,
                 overlap_chars: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (``n_tokens > limit``).

    Whole texts are counted, none cut. Null and empty texts: 0 bytes, 0 tokens.
    Repeated rows give repeated rows; an empty table gives an empty one; other
    columns of ``docs``, whatever their names, are not read. A null id is kept.
    Row-local: no shuffle, one text in memory at a time beside its batch.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in rows(batches):
            texts = b.column(1).to_pylist()
            n = [m.count(t, chunk_chars, overlap_chars) if t else 0 for t in texts]
            size = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        counted, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")

"""Words of texts by Arrow kernels: a batch of texts becomes indices into a dictionary of its words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What parts words once A-Z are lower-cased: ASCII other than digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that are cut into words at a time; a longer text is cut alone.
PART_BYTES = 4 << 20


@dataclass
class Words:
    """Words of `texts` texts in their order: `codes` index `dictionary`, `row` names each word's text."""

    dictionary: list[bytes]
    codes: np.ndarray
    row: np.ndarray
    texts: int

    @property
    def lengths(self) -> np.ndarray:
        """Words per text."""
        return np.bincount(self.row, minlength=self.texts)


def whole_texts(texts: pa.Array) -> pa.Array:
    """The texts as an array of their own, a missing one empty: kernels that map characters misread slices of larger arrays."""
    return pc.fill_null(texts.take(pa.array(np.arange(len(texts)))).cast(pa.large_string()), "")


def words_of(texts: pa.Array, *, lower=pc.ascii_lower, gap: str = GAP) -> Words:
    """The words of every text, a missing one having none."""
    lists = pc.split_pattern_regex(lower(whole_texts(texts)), gap)
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)  # a text that begins or ends with a gap has an empty piece there
    coded = pc.dictionary_encode(flat.filter(real))
    return Words(coded.dictionary.cast(pa.large_binary()).to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                 row.filter(real).to_numpy(zero_copy_only=False).astype(np.int64), len(texts))


def in_parts(batches: Iterable[pa.RecordBatch], text: str = "text", part_bytes: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `part_bytes` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < len(sizes):
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + part_bytes, side="right")))
            yield batch.slice(at, end - at)
            at = end

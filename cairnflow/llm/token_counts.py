"""Token counts per section by offset-mapped attribution.

Each document is encoded once as a whole, so its counts add up to the count of the whole text (encoding
sections apart would cut words differently). Token spans and section spans are joined as intervals. A
token that crosses a boundary belongs to the section that holds its first character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import public_encoder
from .common import require


def line_starts(text: str) -> np.ndarray:
    """First character of each line; a line owns the newline that ends it."""
    starts, at = [0], text.find("\n")
    while at >= 0:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(starts)


def tokens_by_section(docs: DataFrame, sections: Callable[[str], np.ndarray] = line_starts, encoder=public_encoder) -> DataFrame:
    """doc_id, section (from 0), start, end (characters), n_tokens, n_crossing (its tokens that end beyond it).

    docs: doc_id, text; other columns are left aside. ``sections`` gives the first character of each
    section, ascending from 0. A null or empty text has one empty section without tokens; a repeated row
    is counted as often as it occurs. Whole texts are encoded, and nothing is shuffled.
    """
    docs = require(docs, ["doc_id", "text"], "tokens_by_section")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, out = [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    text = text or ""
                    starts = sections(text)
                    ends = np.append(starts[1:], len(text))
                    begins = enc.spans(text)[1]
                    owner = np.searchsorted(starts, begins, "right") - 1
                    last = np.append(begins[1:], len(text))
                    n = np.bincount(owner, minlength=len(starts))
                    crossing = np.bincount(owner[last > ends[owner]], minlength=len(starts))
                    ids += [doc] * len(starts)
                    out.append(np.stack([np.arange(len(starts)), starts, ends, n, crossing]))
                if out:
                    columns = np.concatenate(out, axis=1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, columns)], names)

    names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]
    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names))

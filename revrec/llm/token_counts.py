"""Token counts of sections, from one encoding of the whole document.

Each token has its characters' span in the document; the spans are joined to the sections' intervals.
A token over a boundary goes to one section by a stated rule: "most" (where most of its characters lie,
the earlier one on a tie), "start" or "end" (where its first or last character lies).

Sections are lines by default: from a line's first character through its line end. Given as a column of
(name, start, end), sorted and without overlap, they may leave gaps: tokens there count for section -1.

Rules: a NULL text is an empty one; a document without sections gets the one section of all its text; so
every document has a row. Parts of one character (byte-level tokens) each have that character's span.
Repeated rows give repeated rows; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrec.llm.texts import documents, slices, span_encoder, whole

RULES = ("most", "start", "end")
_COUNTS = "doc_id bigint, section int, name string, start bigint, end bigint, n_tokens bigint, n_crossing bigint"


def line_bounds(text: str) -> np.ndarray:
    """Starts of the lines, and the end of the text."""
    lengths = np.fromiter((len(x) + 1 for x in text.split("\n")), np.int64)
    ends = np.cumsum(lengths)
    ends[-1] -= 1
    return np.concatenate([[0], ends])


def allocate(first: np.ndarray, after: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token (-1: in a gap), and whether it touches more than one."""
    last = np.maximum(after - 1, first)
    left = np.searchsorted(ends, first, "right")  # first section that ends after the token's start
    right = np.searchsorted(starts, last, "right") - 1  # last section that starts at its last character or before
    inside = left <= right
    crossing = left < right
    out = np.where(inside, right if rule == "end" else left, -1)
    if rule == "most":
        for i in np.flatnonzero(crossing).tolist():
            own = np.arange(left[i], right[i] + 1)
            shared = np.minimum(ends[own], after[i]) - np.maximum(starts[own], first[i])
            out[i] = own[np.argmax(shared)]
    return out, crossing


def section_counts(docs: DataFrame, path: str, sections: str | None = None, rule: str = "most") -> DataFrame:
    """One row per document and section with its number of tokens and how many of those cross a boundary."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = span_encoder(path)
        for batch in batches:
            for part in slices(batch):
                yield _counted(part, coder)

    def _counted(part: pa.RecordBatch, coder) -> pa.RecordBatch:
        texts = whole(part.column("text"))
        starts, index, distinct = coder.pieces(texts)
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))[index]
        at = np.concatenate([[0], np.cumsum(sizes)])
        ends, tokens = coder.gather(coder.parts(distinct, index), index)
        tokens = tokens[:, 1:] + np.repeat(at[:-1], np.diff(ends))[:, None]
        given = part.column("sections").to_pylist() if sections else [None] * len(texts)
        out = {k: [] for k in ("doc_id", "section", "name", "start", "end", "n_tokens", "n_crossing")}
        for i, (key, text) in enumerate(zip(part.column("doc_id").to_pylist(), texts.to_pylist())):
            own = tokens[ends[starts[i]]:ends[starts[i + 1]]] - at[starts[i]]
            if given[i]:
                low, high = (np.array([s[k] for s in given[i]], np.int64) for k in ("start", "end"))
                names = [s["name"] for s in given[i]]
            else:
                bounds = np.array([0, len(text)]) if sections else line_bounds(text)
                low, high, names = bounds[:-1], bounds[1:], [None] * (len(bounds) - 1)
            where, crossing = allocate(own[:, 0], own[:, 1], low, high, rule)
            counts = np.bincount(where + 1, minlength=len(low) + 1)
            crossed = np.bincount(where + 1, weights=crossing, minlength=len(low) + 1).astype(np.int64)
            skip = 0 if counts[0] else 1
            out["doc_id"] += [key] * (len(counts) - skip)
            out["section"] += range(skip - 1, len(low))
            out["name"] += [None, *names][skip:]
            out["start"] += [None, *low.tolist()][skip:]
            out["end"] += [None, *high.tolist()][skip:]
            out["n_tokens"] += counts[skip:].tolist()
            out["n_crossing"] += crossed[skip:].tolist()
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")]
    columns += [F.col(sections).alias("sections")] if sections else []
    return docs.select(*columns).mapInArrow(run, _COUNTS)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    import public_tokenizers

    counted = section_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "section", "start", "end", "n_tokens", "n_crossing")

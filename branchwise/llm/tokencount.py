"""Token counts by section from one encoding of each whole document.

Byte-level tokens keep every byte, so their lengths give each token's byte
span and, over the non-continuation bytes, its character span. Spans meet
sections by binary search. A token that crosses a boundary goes by `rule`:
"majority" (largest overlap in characters, ties to the earlier section) or
"start" (the section of its first character).
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from branchwise.llm.common import need, table

TOKENIZERS = "/opt/tokenizers"
OUTSIDE = -1
SCHEMA = "doc_id long, section int, start_char long, end_char long, n_tokens long"


@functools.cache
def encoder(folder: str):
    """The byte-level tokenizer of `folder`, and each token's length in bytes."""
    import runpy

    import tiktoken

    with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, k in ranks.items():
        lengths[k] = len(token)
    pattern = runpy.run_path(f"{folder}/__init__.py")["PATTERN"]
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of each token; of a split character each part's token covers it."""
    encoding, lengths = encoder(folder)
    ends = np.cumsum(lengths[np.asarray(encoding.encode_ordinary(text), np.int64)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    raw = text.encode()
    if len(raw) == len(text):
        return starts, ends
    character = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return character[starts], character[ends - 1] + 1


def line_sections(text: str) -> np.ndarray:
    """Start of each line, with its newline; the end of one is the start of the next."""
    at = [0]
    k = text.find("\n")
    while k >= 0:
        at.append(k + 1)
        k = text.find("\n", k + 1)
    return np.asarray(at, np.int64)


def allocate(starts: np.ndarray, ends: np.ndarray, from_: np.ndarray, to: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token (OUTSIDE: none) among sorted, disjoint sections [from_, to)."""
    first = np.searchsorted(from_, starts, "right") - 1
    last = np.searchsorted(from_, ends - 1, "right") - 1
    held = (first >= 0) & (starts < to[np.maximum(first, 0)])
    out = np.where(held, first, OUTSIDE)
    if rule == "start":
        return out
    for k in np.flatnonzero((first != last) | ~held):
        best, most = OUTSIDE, 0
        for s in range(max(first[k], 0), last[k] + 1):
            both = min(ends[k], to[s]) - max(starts[k], from_[s])
            if both > most:
                best, most = s, both
        out[k] = best
    return out


def count_tokens(docs: DataFrame, rule: str = "majority", tokenizers: str = TOKENIZERS, sections: str | None = None) -> DataFrame:
    """A row per document and section: doc_id, section, start_char, end_char, n_tokens.

    Sections are the text's lines with their newlines or, where `sections` names
    a column (array of struct<start, end>, sorted and disjoint), those; a row
    numbered -1 then holds tokens outside all. A null text is empty; an empty
    text has one empty line. Rows with equal or null ids stay apart, each with
    its own sections. An empty table gives an empty one. Other columns are ignored.
    `tokenizers` is a folder that every worker can read: an input.
    """
    if rule not in ("majority", "start"):
        raise ValueError(rule)
    given = sections is not None

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            parts = []
            for row in frame.itertuples(index=False):
                text = row.text or ""
                if given:
                    spans = [] if row.sections is None else row.sections
                    from_ = np.asarray([s["start"] for s in spans], np.int64)
                    to = np.asarray([s["end"] for s in spans], np.int64)
                    if (from_[1:] < to[:-1]).any() or (to < from_).any():
                        raise ValueError(f"sections of {row.doc_id} overlap or are unsorted")
                else:
                    from_ = line_sections(text)
                    to = np.concatenate([from_[1:], [len(text)]])
                starts, ends = token_spans(text, tokenizers)
                at = allocate(starts, ends, from_, to, rule) if len(from_) else np.full(len(starts), OUTSIDE)
                counts = np.bincount(at + 1, minlength=len(from_) + 1)
                number = np.arange(len(from_))
                if given:
                    number, from_, to = np.concatenate([[OUTSIDE], number]), np.concatenate([[0], from_]), np.concatenate([[len(text)], to])
                else:
                    counts = counts[1:]
                parts.append((row.doc_id, number, from_, to, counts))
            if parts:
                sizes = [len(p[1]) for p in parts]
                ids = pd.array([None if pd.isna(p[0]) else int(p[0]) for p in parts], dtype="Int64")
                yield pd.DataFrame({"doc_id": ids.repeat(sizes)} | {n: np.concatenate([p[k] for p in parts]) for k, n in enumerate(("section", "start_char", "end_char", "n_tokens"), 1)})

    asked = need(docs, "doc_id", "text", *[sections] * given).toDF("doc_id", "text", *["sections"] * given)
    return asked.withColumn("doc_id", F.col("doc_id").cast("long")).mapInPandas(batches, SCHEMA)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))

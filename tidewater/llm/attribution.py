"""Token counts by section: whole documents are encoded once, token spans meet section spans.

The offset map of a byte-level tokenizer is exact: the bytes of its tokens, strung together, are the text, so
the running sum of token byte lengths gives each token's span, and its characters by counting lead bytes. Token
spans and section spans of a batch are two sorted lists; a sorted search joins them. A token that crosses a
section boundary is allocated by ``rule``: ``first`` (the section of its first byte), ``last``, or ``most``
(the section with most of its bytes, the earlier one of equals). Counts of a document's sections add up to the
count of the whole document under each rule.

A document is its fields, joined by newlines; sections are the lines (with their line end) of each field.
Defined results: a NULL or empty field is one empty section without tokens; NULL ids and repeated rows are
kept; an empty table gives no rows; other columns are ignored. No shuffle: a row is counted where it is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches
from tidewater.llm.tokens import encoder, runs

RULES = ("first", "last", "most")
SCHEMA = ("doc_id long, field string, section long, start_char long, n_chars long, n_tokens long, n_crossing long, "
          "doc_tokens long")
_lengths: dict[str, np.ndarray] = {}


def token_lengths(path: str) -> np.ndarray:
    """Bytes of each id's token."""
    if path not in _lengths:
        t = encoder(path).tokenizer
        special = {i: len(x.content.encode()) for i, x in t.get_added_tokens_decoder().items()}
        out = np.zeros(t.get_vocab_size(), np.int64)
        for token, i in t.get_vocab().items():
            out[i] = special.get(i, len(token))  # one character stands for one byte
        _lengths[path] = out
    return _lengths[path]


def allocate(start: np.ndarray, end: np.ndarray, bounds: np.ndarray, rule: str):
    """Section of each token [start, end) for ascending section ends ``bounds``; and each token's last section."""
    first = np.searchsorted(bounds, start, "right")
    last = np.searchsorted(bounds, end - 1, "right")
    if rule == "first":
        return first, first, last
    if rule == "last":
        return last, first, last
    chosen = first.copy()
    cross = np.flatnonzero(last > first)
    if len(cross):
        n = last[cross] - first[cross] + 1
        tok = np.repeat(cross, n)
        sec = np.repeat(first[cross] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        lo = np.maximum(start[tok], np.where(sec > 0, bounds[sec - 1], 0))
        part = np.minimum(end[tok], bounds[sec]) - lo
        order = np.lexsort((sec, -part, tok))
        head = order[np.concatenate([[True], np.diff(tok[order]) > 0])]
        chosen[tok[head]] = sec[head]
    return chosen, first, last


def _count(batches, path: str, rule: str, fields: list[str]):
    enc, lengths = encoder(path), token_lengths(path)
    for batch in batches:
        columns = [batch.column(k + 1).to_pylist() for k in range(len(fields))]
        texts = ["\n".join(x or "" for x in row) for row in zip(*columns, strict=True)]
        for lo, hi in runs([len(t) for t in texts], 1 << 20):
            ids, n_ids = enc.encode(texts[lo:hi])
            end = np.cumsum(lengths[ids])
            start = end - lengths[ids]
            raw = [t.encode() for t in texts[lo:hi]]
            size = np.array([len(t) for t in raw], np.int64)
            doc_end = np.cumsum(size)
            buf = np.frombuffer(b"".join(raw), np.uint8)
            # Section ends: after each newline, and at the document's end (an empty last line only if it is all of a field).
            sec_doc, sec_field, sec_no, bounds = [], [], [], []
            for k, row in enumerate(zip(*(c[lo:hi] for c in columns), strict=True)):
                at = int(doc_end[k] - size[k])
                for f, value in enumerate(row):
                    last = f == len(row) - 1
                    lines = _lines((value or "").encode())
                    for j, line in enumerate(lines):
                        at += len(line)
                        more = int(j == len(lines) - 1 and not last)  # the joining newline belongs to the field before
                        at += more
                        sec_doc.append(k), sec_field.append(f), sec_no.append(j), bounds.append(at)
            bounds = np.array(bounds, np.int64)
            chosen, first, last_ = allocate(start, end, bounds, rule)
            counts = np.bincount(chosen, minlength=len(bounds))
            crossing = np.zeros(len(bounds) + 1, np.int64)
            cross = last_ > first
            np.add.at(crossing, first[cross], 1)
            np.add.at(crossing, last_[cross] + 1, -1)
            lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
            before = np.concatenate([[0], bounds[:-1]])
            doc = np.array(sec_doc, np.int64)
            doc_start = lead[(doc_end - size)[doc]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo).take(pa.array(doc)),
                 pa.array([fields[f] for f in sec_field], pa.string()), pa.array(np.array(sec_no, np.int64)),
                 pa.array(lead[before] - doc_start), pa.array(lead[bounds] - lead[before]), pa.array(counts.astype(np.int64)),
                 pa.array(np.cumsum(crossing)[:-1]), pa.array(n_ids[doc].astype(np.int64))],
                [c.split()[0] for c in SCHEMA.split(", ")])


def _lines(value: bytes) -> list[bytes]:
    """Lines with their newline; an empty value is one empty line."""
    parts = value.split(b"\n")
    out = [p + b"\n" for p in parts[:-1]]
    return out + [parts[-1]] if parts[-1] or not out else out


def section_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", fields: tuple = ("text",),
                   rule: str = "most") -> DataFrame:
    """One row per document, field and line with its tokens (``SCHEMA``)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    bound_batches(docs.sparkSession)
    names = list(fields)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    *[F.col(f).cast("string").alias(f"f{k}") for k, f in enumerate(names)])
    return d.mapInArrow(lambda b: _count(b, tokenizer, rule, names), SCHEMA)

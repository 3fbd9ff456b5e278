"""Token counts of sections, by the character offsets of tokens of the whole document.

A document is encoded once, so its tokens are those of the whole text, not of cut pieces. The
offsets of byte-level tokens follow from their lengths in bytes; a token that holds part of a
character covers that character. Token spans and section spans of a batch are laid end to end
and joined by interval with two binary searches. A token that lies in one section counts
there; one that crosses a border goes by `rule`:

- `most`: to the section that holds most of its characters, the earlier one of equals;
- `first`: to the first section it touches;
- `share`: to each section by its share of the token's characters inside sections.

Where sections overlap, the characters belong to the section that starts earlier (of equals,
the one listed earlier). Tokens that touch no section are counted nowhere.

Cases: a NULL or empty text has one empty line and no tokens; sections reaching beyond the
text, or ending before they begin, hold what is left of them; documents without sections have
no rows; NULL sections count as none; long texts are encoded in ranges; repeated rows give
repeated rows; an empty table gives an empty table; other columns but doc_id are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.bpe import piece_ids, ranks_of
from tallystream.llm.columns import (
    map_arrow,
    plain_text,
    replaced,
    small_batches,
    spread,
    text_buffer,
    with_column,
)

RULES = ("most", "first", "share")
SECTION = "section string, begin int, end int"
SECTIONS = T.ArrayType(T.StructType([
    T.StructField("section", T.StringType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))
COUNTS = f"doc_id long, place int, {SECTION}, n_tokens double"


def line_sections(docs: DataFrame, text: str = "text", out: str = "sections") -> DataFrame:
    """Add the lines of `text` as sections `line`, each with the newline that ends it."""

    def run(batches):
        for batch in small_batches(batches, text):
            data, offsets = text_buffer(batch.column(text))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            breaks = np.flatnonzero(data == 0x0A) + 1
            row = np.searchsorted(offsets, breaks - 1, "right") - 1
            count = np.bincount(row, minlength=batch.num_rows) + 1
            # A row's lines begin at its start and after each newline, and end where the next begins.
            first = np.cumsum(count) - count
            begin, end = np.empty(count.sum(), np.int64), np.empty(count.sum(), np.int64)
            later = np.ones(count.sum(), bool)
            later[first] = False
            begin[first], begin[later] = chars[offsets[:-1]], chars[breaks]
            end[:-1] = begin[1:]
            end[first + count - 1] = chars[offsets[1:]]
            base = np.repeat(chars[offsets[:-1]], count)
            fields = [pa.array(["line"] * len(begin), pa.string()), pa.array((begin - base).astype(np.int32)),
                      pa.array((end - base).astype(np.int32))]
            items = pa.StructArray.from_arrays(fields, names=["section", "begin", "end"])
            ends = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            yield replaced(batch, out, pa.ListArray.from_arrays(ends, items))

    df = plain_text(docs, text)
    return map_arrow(df, run, with_column(df, out, SECTIONS))


def attach_sections(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """Add to docs their rows of a table (doc_id, section, begin, end), in order."""
    items = sections.groupBy(F.col("doc_id").alias("_of")).agg(
        F.array_sort(F.collect_list(F.struct("begin", "end", "section"))).alias("_items"))
    items = items.select("_of", F.transform("_items", lambda s: F.struct(s["section"], s["begin"], s["end"])).alias("sections"))
    df = docs.drop("sections").join(items, docs["doc_id"] == items["_of"], "left")
    return df.drop("_of")


def token_spans(data: np.ndarray, offsets: np.ndarray, ranks_path: str) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token of the batch, and the one after its last."""
    ids, _ = piece_ids(ranks_path).of_rows(data, offsets)
    after = np.cumsum(ranks_of(ranks_path).length[ids])
    before = after - ranks_of(ranks_path).length[ids]
    number = np.cumsum((data & 0xC0) != 0x80) - 1  # of the character that each byte belongs to
    return number[before], number[after - 1] + 1


def allocate(start: np.ndarray, stop: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; all spans in order, sections disjoint."""
    counts = np.zeros(len(begin))
    if not len(begin) or not len(start):
        return counts
    first = np.searchsorted(end, start, "right")
    last = np.searchsorted(begin, stop, "left") - 1
    touched = last - first + 1
    one = first[(touched == 1) | (touched > 1) & (rule == "first")]
    counts += np.bincount(one, minlength=len(begin))
    if rule != "first" and (cross := np.flatnonzero(touched > 1)).size:
        n = touched[cross]
        section, token = spread(first[cross], n), np.repeat(np.arange(len(cross)), n)
        held = np.minimum(stop[cross][token], end[section]) - np.maximum(start[cross][token], begin[section])
        if rule == "share":
            counts += np.bincount(section, held / np.bincount(token, held)[token], len(begin))
        else:
            order = np.lexsort((section, -held, token))
            best = order[np.append(True, np.diff(token[order]) != 0)]
            counts += np.bincount(section[best], minlength=len(begin))
    return counts


def disjoint(begin: np.ndarray, end: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Sections cut to their text and to what no earlier one holds; order: by start. low, high:
    the text's characters of each section."""
    begin, end = np.clip(begin + low, low, high), np.clip(end + low, low, high)
    order = np.lexsort((np.arange(len(row)), begin))
    b, e = begin[order], end[order]
    taken = np.append(0, np.maximum.accumulate(np.maximum(e, b))[:-1]) if len(b) else b
    b = np.maximum(b, taken)
    return order, b, np.maximum(e, b)


def count_tokens(docs: DataFrame, ranks_path: str, rule: str = "most", text: str = "text",
                 sections: str = "sections") -> DataFrame:
    """One row for each section of each document: doc_id, place in the list, the section, and
    its tokens. `sections`: array<struct<section, begin, end>> in characters, end excluded."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def run(batches):
        for batch in small_batches(batches, text):
            data, offsets = text_buffer(batch.column(text))
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
            column = batch.column(sections)
            count = np.diff(column.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), count)
            items = column.flatten()
            begin, end = (items.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("begin", "end"))
            order, b, e = disjoint(begin, end, row, chars[row], chars[row + 1])
            some = e > b
            n_tokens = np.zeros(len(row))
            n_tokens[order[some]] = allocate(*token_spans(data, offsets, ranks_path), b[some], e[some], rule)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(place.astype(np.int32)), items.field("section"),
                 pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(n_tokens)],
                names=["doc_id", "place", "section", "begin", "end", "n_tokens"])

    held = F.filter(F.coalesce(F.col(sections), F.array().cast(SECTIONS)),
                    lambda s: s.isNotNull() & s["begin"].isNotNull() & s["end"].isNotNull())
    df = plain_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, held.alias(sections)), text)
    return map_arrow(df, run, COUNTS)

"""Encoding, decoding, token files and token counts against the libraries."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallystream.llm import bpe, pieces, queries, token_counts, token_files
from tallystream.llm.columns import ranges, text_buffer
from tests.llm.cases import ROWS, documents, nothing

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return token_files.tokenizer_of(public_tokenizers.path("byte_bpe_50k.json"))


def noise(count: int, most: int) -> list[str]:
    draw = random.Random(7)
    signs = "ab'sstrevlmdT  \n\t\r12,.é漢ß🙂 　"
    return ["".join(draw.choice(signs) for _ in range(draw.randint(0, most))) for _ in range(count)]


def test_pieces_are_the_matches_of_the_pattern():
    texts = noise(3000, 25)
    data, offsets = text_buffer(pa.array(texts))
    starts = pieces.starts_of(data, offsets[:-1])
    want, at = [], 0
    for text in texts:
        for match in regex.findall(public_tokenizers.PATTERN, text):
            want.append(at)
            at += len(match.encode())
    assert starts.tolist() == want


def test_ranges_cut_only_where_a_piece_starts(library):
    text = "word " * 3000 + "x" * 9000 + " tail"
    data, offsets = text_buffer(pa.array(["", text, "b"]))
    cut = list(ranges(data, offsets, 1000))
    assert cut[0][0] == 0 and cut[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
    starts = set(pieces.starts_of(data, offsets[:-1]).tolist())
    assert {a for a, _ in cut} <= starts and len(cut) > 10


def test_merges_equal_the_library(library):
    ranks = bpe.ranks_of(RANKS)
    texts = noise(2000, 40) + ["a" * 3000, "abc" * 700, "z" * 65, "z" * 64, " " * 200]
    ids, counts = bpe.piece_ids(RANKS).of_rows(*text_buffer(pa.array(texts)))
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        assert ids[end - n : end].tolist() == library.encode_ordinary(text)
    draw = random.Random(3)
    found = [bytes(draw.choice(b"etainos \n") for _ in range(draw.randint(2, 64))) for _ in range(500)]
    found = [p for p in found if p not in ranks.rank]
    ids, counts = ranks.encode(found)
    assert ids.tolist() == [i for p in found for i in ranks.merge_alone(p)]


def test_piece_memory_starts_afresh(library):
    small = pieces.PieceIds(bpe.ranks_of(RANKS).encode, limit=5)
    texts = noise(50, 30)
    for text in texts:
        ids, _ = small.of_rows(*text_buffer(pa.array([text])))
        assert ids.tolist() == library.encode_ordinary(text)


def test_encode_and_decode_cases(spark, library):
    docs = documents(spark).withColumn("token_ids", F.lit("clash"))
    both = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert both.columns[-2:] == ["token_ids", "decoded"] and both.columns.count("token_ids") == 1
    rows = both.collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        assert row.token_ids == library.encode_ordinary(row.text) and bytes(row.decoded).decode() == row.text
    assert bpe.decode(bpe.encode(nothing(spark), RANKS), RANKS).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, token_ids array<int>")
    assert bytes(bpe.decode(none, RANKS).first().decoded) == b""
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, token_ids array<int>"), RANKS).collect()


def test_op2_equals_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op2_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def checksum(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1_equals_the_library_and_one_stream(spark, tokenizer):
    rows = {r.doc_id: r for r in queries.op1_token_files(spark, SF).collect()}
    start = 0
    for doc in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [2]
        row = rows[doc.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), checksum(ids))
        start += len(ids)
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_token_file_cases(spark, tokenizer, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(spark).withColumn("file", F.lit("clash"))
    index = token_files.write_tokens(docs, str(tmp_path / "t"), path, 2, length=16, per_batch=4)
    assert token_files.load_index(spark, str(tmp_path / "t")).count() == len(ROWS)
    starts = {r.shard: r.before for r in token_files.shard_starts(index).collect()}
    rows = sorted(index.collect(), key=lambda r: (starts[r.shard] + r.offset))
    assert rows[0].doc_id is None
    ids = [r.doc_id for r in rows[1:]]
    assert ids == sorted(ids)
    texts = {r[0]: r[1] or "" for r in ROWS}
    at = 0
    for row in rows:
        want = tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids + [2]
        assert starts[row.shard] + row.offset == at
        assert token_files.TokenFile(row.file).span(row.offset, row.n_tokens).tolist() == want
        at += len(want)
    # Sequences of one file: equal lengths, masked where the last is filled up, not copied.
    name = rows[-1].file
    file, real = token_files.TokenFile(name), sum(r.n_tokens for r in rows if r.file == name)
    flat, held = [], 0
    for i in range(-(-real // 16)):
        tokens, mask = file.sequence(i)
        assert len(tokens) == len(mask) == 16 and not tokens.flags.owndata
        held += sum(mask.to_pylist())
        flat += tokens.tolist()
    assert held == real and flat[:real] == file.span(0, real).tolist()
    assert file.sequence(2)[0].tolist() == flat[32:48]
    empty = token_files.write_tokens(nothing(spark), str(tmp_path / "e"), path, 2)
    assert empty.count() == 0 and token_files.shard_starts(empty).count() == 0


def test_added_tokens_are_those_of_the_whole_text(spark, tmp_path):
    path, mark = public_tokenizers.path("byte_bpe_50k.json"), "<|endoftext|>"
    pieces_ = [mark, mark, "<|endoftext", "|>", "don", "'t", " ", "  ", "\n", "漢", "word", "12", "<|pad|>", "<|pad|>x"]
    draw = random.Random(11)
    texts = ["".join(draw.choice(pieces_) for _ in range(draw.randint(0, 9))) for _ in range(400)]
    texts += [mark, "", f"a {mark} b", f"a  {mark}{mark}  b", "<|endo", "ftext|> over two rows", ("long words " * 90_000 + mark) * 3]
    with open(path) as file:
        spec = json.load(file)
    # An overlapping longer token, one that takes the blanks before it, one for whole words.
    for content, flags in (("<|endoftext|>|>", {}), ("<|pad|>", {"lstrip": True}), ("word", {"single_word": True})):
        spec["added_tokens"].append(dict.fromkeys(("single_word", "lstrip", "rstrip", "normalized"), False)
                                    | {"id": 50254 + len(spec["added_tokens"]) * 3, "content": content, "special": True} | flags)
    (tmp_path / "more.json").write_text(json.dumps(spec))
    for name in (path, str(tmp_path / "more.json")):
        library = Tokenizer.from_file(name)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert any(50256 in ids for ids in want)
        ids, counts = token_files.text_ids(name, *text_buffer(pa.array(texts)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = Tokenizer.from_file(path)
    index = token_files.write_tokens(docs, str(tmp_path / "t"), path, 2)
    rows = index.collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids + [2]
        assert token_files.TokenFile(row.file).span(row.offset, row.n_tokens).tolist() == ids


def counted(text, sections, rule, library):
    """Tokens of each section, one token at a time."""
    raw, at = text.encode(), 0
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    owner = {}
    for k in sorted(range(len(sections)), key=lambda k: (max(sections[k][1], 0), k)):
        for i in range(max(sections[k][1], 0), min(sections[k][2], len(text))):
            owner.setdefault(i, k)
    # An earlier section owns all up to its end.
    counts = [0.0] * len(sections)
    for token in library.encode_ordinary(text):
        n = len(library.decode_single_token_bytes(token))
        inside = [owner[i] for i in range(char_of[at], char_of[at + n - 1] + 1) if i in owner]
        at += n
        if not inside:
            continue
        ranked = sorted(set(inside), key=inside.index)
        if rule == "first":
            counts[ranked[0]] += 1
        elif rule == "share":
            for k in ranked:
                counts[k] += inside.count(k) / len(inside)
        else:
            counts[max(ranked, key=lambda k: (inside.count(k), -ranked.index(k)))] += 1
    assert at == len(raw)
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_by_brute_force(spark, library, rule):
    draw = random.Random(5)
    rows = []
    for i, text in enumerate([r[1] or "" for r in ROWS if r[1] is None or len(r[1]) < 9000] + noise(20, 60)):
        cuts = sorted(draw.randint(-2, len(text) + 3) for _ in range(8))
        rows.append((i, text, [("s", a, b) for a, b in zip(cuts[::2], cuts[1::2])] + [("rest", cuts[2], len(text)), ("back", 3, 1)]))
    rows.append((100, "some words", None))
    rows.append((101, "some words", [None, ("null", None, 4), ("all", 0, 99)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, sections array<struct<section:string,begin:int,end:int>>")
    got: dict = {}
    for row in token_counts.count_tokens(docs, RANKS, rule).collect():
        got.setdefault(row.doc_id, {})[row.place] = (row.section, row.n_tokens)
    assert 100 not in got and list(got[101].values()) == [("all", 2.0)]
    for i, text, sections in rows[:-2]:
        want = counted(text, sections, rule, library)
        assert [got[i][k][1] for k in range(len(sections))] == pytest.approx(want), (text, sections)


def test_line_sections_tile_the_text(spark, library):
    docs = token_counts.line_sections(documents(spark).withColumn("sections", F.lit(1)))
    rows = docs.collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        cut = [row.text[s.begin : s.end] for s in row.sections]
        assert "".join(cut) == row.text and [c.rstrip("\n") for c in cut] == row.text.split("\n")
    totals = token_counts.count_tokens(docs, RANKS).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"))
    for row in totals.collect():
        texts = [r[1] or "" for r in ROWS if r[0] == row.doc_id]
        assert row.n == sum(len(library.encode_ordinary(t)) for t in texts)
    assert token_counts.count_tokens(token_counts.line_sections(nothing(spark)), RANKS).count() == 0


def test_sections_from_a_table(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "delta")], "doc_id long, text string")
    table = spark.createDataFrame([(1, "b", 5, 16), (1, "a", 0, 5)], "doc_id long, section string, begin int, end int")
    counts = token_counts.count_tokens(token_counts.attach_sections(docs, table), RANKS).orderBy("place").collect()
    assert [(r.doc_id, r.section) for r in counts] == [(1, "a"), (1, "b")] and all(r.n_tokens > 0 for r in counts)
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs, RANKS, "last")


def test_op3_adds_up_to_op2(spark):
    lines = queries.op3_token_counts(spark, SF)
    assert lines.columns == ["doc_id", "line", "begin", "end", "n_tokens"]
    got = {r.doc_id: r.n for r in lines.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert got == {r.doc_id: r.n_tokens for r in queries.op2_byte_bpe(spark, SF).collect()}

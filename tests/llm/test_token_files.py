import zlib
from itertools import chain

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from goldpan.llm import token_files
from goldpan.llm.encoding import ChunkIds, Encoder, column_of_chunks, splits_at_spaces
from goldpan.llm.queries import op13_token_files
from tests.llm.conftest import LONG

PATH = public_tokenizers.path("word_bpe_49k.json")


LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def brute_force(rows, library):
    """doc_id, start, n_tokens, crc32 as a bag, starts counted in the order of ids."""
    found, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_whole_table_against_the_library(spark, tiny, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op13_token_files(spark, tiny).collect()) == brute_force(rows, library)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aAhHkK'sSt.,!7 \n\t\x0b\x1c\x85\xa0　İΣſ̱́̇ͅ<|>"), st.characters(exclude_categories=["Cs"]))), max_size=6))
def test_chunks_give_the_ids_of_whole_texts(texts):
    texts += ["<|endoftext|>", "x<|startoftext|>y'S <|ENDOFTEXT|> it's"]
    found = Encoder(PATH)([t.encode() for t in texts])
    assert [x.tolist() for x in found] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert splits_at_spaces(PATH) and not splits_at_spaces(path)
    text = "Two  spaces, and\n\nlines: naïve 日本"
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert Encoder(path)([text.encode()])[0].tolist() == expected


def test_what_is_remembered_is_bounded_and_changes_nothing(library):
    small = Encoder(PATH)
    small.known.most_chunks = 5
    texts = [f"one two{i} three-{i} naïve{i}" for i in range(40)]
    for t in texts:
        assert small([t.encode()])[0].tolist() == library.encode(t, add_special_tokens=False).ids
        assert len(small.known) <= 5 + 4
    small.known.most_chunks = 1_000_000


def test_chunks_of_many_texts_are_looked_up_once():
    """A word costs one look-up for all its occurrences in some texts, whatever marks follow it."""

    class Counted(ChunkIds):
        asked = 0

        def get(self, *a):
            self.asked += 1
            return super().get(*a)

    known = Counted(PATH, 100)
    start, end, counts = known.entries([b"the cat, the Cat. THE cat!", b"", b"  cat%%% the ((the"] * 50)
    assert known.asked == len(known) == 7 and set(known) == {b"the", b"cat", b",", b".", b"!", b"%%%", b"((the"}
    assert counts.tolist() == [9, 0, 4] * 50 and len(start) == len(end) == 650


def test_column_of_chunks_keeps_special_strings_whole():
    texts = ["A b.", "x<|endoftext|>, Y.", "e\u0301. F,", "", "ends, at"]
    column, counts = column_of_chunks([t.encode() for t in texts], [b"<|endoftext|>"])
    chunks = [c.decode() for c in column.to_pylist()]
    assert chunks == ["a", "b", ".", "x<|endoftext|>,", "Y.", "e\u0301.", "F,", "ends", ",", "at"]
    assert counts.tolist() == [3, 2, 2, 0, 3]


def test_chunks_that_the_library_encodes_together():
    words = [f"größe{i}{'!' * (i % 7 == 0)} 日本{i}é!! ¡no" for i in range(700)]
    found = Encoder(PATH)([w.encode() for w in words])
    assert [x.tolist() for x in found] == [LIBRARY.encode(w, add_special_tokens=False).ids for w in words]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.sampled_from([255, 256, 65535, 65536, 2**32 - 1])))))
def test_code_round_trip(docs):
    lengths = np.array([len(d) for d in docs], np.int64)
    flat = np.array(list(chain.from_iterable(docs)), np.uint32)
    control, data = token_files.coded(flat, lengths)
    assert len(control) == sum(-(-len(d) // 4) for d in docs)
    assert len(data) == sum((v > 0) + (v > 255) + 2 * (v > 65535) for v in flat.tolist())
    assert token_files.decoded(control, data, lengths).tolist() == flat.tolist()


def test_frequent_ids_have_small_ranks(spark, documents):
    folder = token_files.write(documents([(1, "the the the cat the", "s"), (2, "cat dog", "s")]), PATH)
    ranks = [r.id for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()]
    the, cat, dog = (Tokenizer.from_file(PATH).encode(w).ids[0] for w in ("the", "cat", "dog"))
    assert ranks == [the, 1, cat, dog]  # ids that come equally often by number
    block = spark.read.parquet(f"{folder}/blocks").collect()
    assert sum(len(b.control) for b in block) == 3 and sum(len(b.data) for b in block) == 5


def test_odd_rows(spark, odd, library):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    found = token_files.read(spark, token_files.write(odd, PATH, block_bytes=500)).collect()
    assert sorted(((r.doc_id or -1, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in found)) == sorted(
        (i or -1, *rest) for i, *rest in brute_force(rows, library)
    )
    assert any(len(t or "") > 300_000 for _, t in rows) and LONG


def test_blocks_follow_each_other_over_many_shards(spark, documents, library):
    rows = [(i * 7919 % 1009, f"text {i} " * (i % 9), "s") for i in range(1009)] + [(500, f"same id {i}", "s") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder = token_files.write(documents(rows).repartition(6), PATH, block_bytes=300)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = sorted((r.start, r.n_tokens, r.doc_id) for r in token_files.read(spark, folder).collect())
    assert len(found) == len(rows)
    assert [s + n for s, n, _ in found[:-1]] == [s for s, _, _ in found[1:]] and found[0][0] == 0
    assert [i for _, _, i in found] == sorted(i for i, _, _ in rows)
    assert spark.read.parquet(f"{folder}/blocks").select("shard").distinct().count() > 1


def test_empty_table(spark, empty):
    assert token_files.read(spark, token_files.write(empty, PATH)).collect() == []

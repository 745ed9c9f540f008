import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pricelens.llm import _tokens, token_counts, token_output
from pricelens.llm._shared import scratch
from pricelens.llm.queries import tokenizer_path

from . import corpus


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def odd_texts():
    r = random.Random(7)
    alphabet = list("ab Z09.,;'’\"-–—_$  \n\t\r\x00\x0b\x1c\x85\xa0éèß×÷ñ…日本語  　\U0001F600") + ["'s", "'re", " '", "don't", "<|endoftext|>", "  ", "\n\n", "é.", ".é", "l'été"]
    return ["".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(4000)] + [None, "", " ", "a" * 5000, " " * 300 + "x"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("as_text", [False, True])
def test_pieces_give_the_ids_of_whole_texts(name, as_text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(name))
    whole.encode_special_tokens = as_text
    texts = odd_texts()
    e = _tokens.Encoder(tokenizer_path(name), as_text)
    assert e.by_piece == (name == "byte_bpe_50k.json")
    got = [np.frombuffer(b, e.dtype).tolist() for b in e.encode(pa.array(texts))]
    for text, ids in zip(texts, got):
        assert ids == whole.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_token_files_round_trip(spark, tokenizer):
    data = corpus.rows() + [corpus.rows()[9]] * 2 + [(None, "without an id", None, None, None)]
    folder = scratch(spark, "test-tokens")
    files = token_output.write(corpus.docs(spark, data).repartition(5), tokenizer_path(), folder, 2, length=64, file_tokens=5000)
    got = token_output.read_documents(files).collect()
    order = sorted(data, key=lambda r: (r[0] is not None, r[0]))
    start = 0
    rows = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [r[0] for r in order]
    for r, row in zip(rows, order):
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    listed = files.orderBy("part", "seq").collect()
    assert sum(r["n_tokens"] for r in listed) == start and sum(r["n_docs"] for r in listed) == len(data)
    for f in listed:  # equal-length sequences; only the last has padding
        masks = [token_output.sequence(f["path"], i)[1] for i in range(f["n_sequences"])]
        assert all(len(m) == 64 for m in masks) and all(m.all() for m in masks[:-1]) and sum(m.sum() for m in masks) == f["n_tokens"]
    ids, mask = token_output.sequence(listed[0]["path"], 1)
    assert not ids.flags.owndata and mask.dtype == bool


def test_token_files_of_an_empty_table(spark):
    files = token_output.write(corpus.docs(spark, []), tokenizer_path(), scratch(spark, "test-tokens"), 2)
    assert files.count() == 0 and token_output.read_documents(files).count() == 0


@pytest.mark.parametrize("block", [7, 1000, 1 << 20])
def test_flat_files_are_counted(spark, tokenizer, block):
    data = corpus.rows() + [corpus.rows()[9], (None, "without an id", None, None, None)]
    placed = token_counts.write_flat(corpus.docs(spark, data), tokenizer_path(), scratch(spark, "test-flat"), 50256, file_bytes=4000)
    found = token_counts.count_tokens(placed.select("path"), 50256, block_tokens=block)
    got = found.join(placed, ["path", "ordinal"]).collect()
    tokenizer.encode_special_tokens = True
    want = sorted((str(r[0]), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids), True) for r in data)
    tokenizer.encode_special_tokens = False
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["terminated"]) for r in got) == want
    by_file = {}
    for r in sorted(got, key=lambda r: (r["path"], r["ordinal"])):
        assert r["start"] == by_file.get(r["path"], 0)
        by_file[r["path"]] = r["start"] + r["n_tokens"] + 1


@pytest.mark.parametrize("ids,want", [([], []), ([9], [(0, 0, True)]), ([1, 2], [(0, 2, False)]), ([9, 9, 1, 9, 5, 5, 5], [(0, 0, True), (1, 0, True), (2, 1, True), (4, 3, False)])])
def test_any_flat_file(spark, tmp_path, ids, want):
    path = tmp_path / "x.bin"
    path.write_bytes(np.array(ids, "<u4").tobytes())
    out = token_counts.count_tokens(spark.createDataFrame([(str(path),), (str(path),)], "path string"), 9, item_bytes=4, block_tokens=2)
    assert sorted((r["start"], r["n_tokens"], r["terminated"]) for r in out.collect()) == want


def test_pieces_are_looked_up_once_when_known():
    from pricelens.llm import _tokens

    known = _tokens._Known()
    assert list(map(known.__getitem__, [b"a", b"b", b"a"])) == [None] * 3 and known.missed == [b"a", b"b", b"a"]
    known.missed.clear()
    known.update({b"a": b"1", b"b": b"2"})
    assert list(map(known.__getitem__, [b"a", b"b"])) == [b"1", b"2"] and not known.missed

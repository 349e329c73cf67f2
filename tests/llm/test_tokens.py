import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm.bpe import Encoder
from llm.bpe import count_tokens as merged
from llm.bpe import ranks, token_counts
from llm.elias_fano import EliasFano
from llm.queries import TOKENIZER
from llm.token_counts import count_tokens
from llm.token_files import TokenFile, read_token_files, write_token_files

PARTS = ["a", "The", " thon", "'s", "'re", "'", " ", "  ", "\n", "\t", "12", "２", "é", "!?", "\xa0", "\x1c", "\x85", "中文", "<|endoftext|>", "'D", "_", "🙂", "ſ", "́", "​", "Ⅷ", "x" * 100]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return [None, "", *("".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(600)), "ab" * 60_000]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_librarys(library, texts):
    assert token_counts(pa.array(texts), TOKENIZER).tolist() == [len(ids_of(library, t)) for t in texts]


def test_merging_long_pieces(library):
    for piece in ("aaaa" * 999, "thethe" * 500, "z"):
        assert merged(piece.encode(), ranks(TOKENIZER)) == len(ids_of(library, piece))


def docs(spark, texts):
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *rows[5:6], *rows[5:6]], "doc_id long, text string, n_tokens string")


def test_count_query(spark, library, texts):
    got = count_tokens(docs(spark, texts), TOKENIZER).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        if row.doc_id is not None:
            text = texts[row.doc_id] or ""
            n = len(ids_of(library, text))
            assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 512)
    assert count_tokens(docs(spark, texts).limit(0), TOKENIZER).collect() == []


@pytest.mark.parametrize("width", [2, 4])
def test_files_round_trip(spark, library, texts, tmp_path, width):
    manifest = write_token_files(docs(spark, texts), str(tmp_path), TOKENIZER, width=width)
    rows = [(i if i % 7 else None, t or "") for i, t in enumerate(texts)]
    rows = sorted([*rows, rows[5], rows[5]], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    got = sorted(read_token_files(spark, manifest).collect(), key=lambda r: r.start)
    at = 0
    for row, (doc_id, text) in zip(got, rows, strict=True):
        ids = [*ids_of(library, text), 0]
        assert tuple(row) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    first = min(manifest.collect(), key=lambda r: r.shard)
    file, k = TokenFile(first.path), 0
    for k in range(file.n_docs):
        assert file.document(k).tolist() == [*ids_of(library, rows[k][1]), 0]


def test_no_rows_no_files(spark, tmp_path):
    empty = docs(spark, ["a"]).limit(0)
    assert read_token_files(spark, write_token_files(empty, str(tmp_path), TOKENIZER)).collect() == []


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [5] * 900, list(range(3000)), [0, 2**62], sorted(random.Random(1).choices(range(10**9), k=5000))])
def test_elias_fano(values):
    code = EliasFano.load(EliasFano.of(np.array(values, dtype=np.uint64)).dump())
    assert code.all().tolist() == values
    assert [code.select(i) for i in range(0, len(values), 37)] == values[::37]


def test_encoding_holds_the_arrays_of_a_small_part_of_a_batch():
    encode = Encoder(TOKENIZER).encode
    texts = pa.array(["a few plain words, 12 of them. " * 40] * 1700)  # 2 MB
    assert sum(len(ids) for _, ids, _ in encode(texts.slice(0, 1)))
    tracemalloc.start()
    try:
        assert sum(len(ids) for _, ids, _ in encode(texts)) == 613_700
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()

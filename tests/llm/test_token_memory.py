"""The encoder of token records: what it holds, what it asks the library, and that ids are the library's."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from feedloom.llm import records
from feedloom.llm.queries import tokenizer_path
from feedloom.llm.tokens import PieceEncoder


def words(n, seed=1):
    draw = np.random.default_rng(seed)
    return ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyzäö"), 9)) for _ in range(n)]


def test_remembered_words_take_few_bytes():
    text, encoder = "a " + " ".join(words(40_000)), PieceEncoder(tokenizer_path())
    encoder.encode(["a b"])
    gc.collect()
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    encoder.encode([text])
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert held < 80 * 40_000


def test_words_of_letters_go_to_the_library_together():
    encoder = PieceEncoder(tokenizer_path())
    given = []

    class Counting:
        def __init__(self, library):
            self.library = library

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.library.encode_batch_fast(texts, **options)

    encoder._letters, encoder._library = Counting(encoder._letters), Counting(encoder._library)
    some = words(5000)
    text = "a " + " ".join(some) + "\n" + "\n".join(some[:500]) + ". " + ", ".join(some)
    encoder.encode([text, text])
    assert len(given) < 10
    given.clear()
    encoder.encode([text])
    assert len(given) <= 1  # its first word


@pytest.mark.parametrize("keep", [0, 50, 100_000])
def test_ids_of_odd_texts_equal_the_library(keep):
    library, encoder = Tokenizer.from_file(tokenizer_path()), PieceEncoder(tokenizer_path(), keep=keep, longest=12)
    draw = np.random.default_rng(7)
    alphabet = [*" \n\t\r\x00\x0b\x1c\x1f\x85\xa0᠎ 　.,'ab5éßªǅɏɐжĠĊ", " the", "\nWord", " Über,", "\n\n", "  ", ".\n", "'ll"]
    alphabet += ["<|endoftext|>", "é", "中文", "🙂", " a" * 20]
    for n in (1, 3, 12, 40):
        texts = ["".join(draw.choice(alphabet, draw.integers(0, n + 1))) for _ in range(1500)]
        ids = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == ids
    for texts in ([], [""], ["", ""], ["\n\n"], ["a"], [" a", ""], ["a b\n\nc", "d e", "", "f\ng"]):
        ids = [library.encode(x, add_special_tokens=False).ids for x in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == ids


def test_slabs_keep_every_row_in_order():
    texts = ["x" * n for n in (0, 5, 700, 0, 90, 40, 1200, 0, 0, 3)] * 9
    table = pa.table({"id": pa.array(range(len(texts)), pa.int64()), "text": texts})
    for rows, budget in ((1, 100), (7, 1000), (90, 300), (90, 10**6)):
        slabs = list(records._slabs(iter(table.to_batches(max_chunksize=rows)), budget))
        assert pa.concat_tables(slabs).to_pydict() == table.to_pydict()
        assert all(s.num_rows == 1 or s["text"].nbytes <= budget + 16 * s.num_rows for s in slabs)
    assert list(records._slabs(iter([]), 100)) == []

import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from estatelake.llm import cutting_stock
from estatelake.llm.cutting_stock import WordIds, assign_slots, inverted, pack, patterns

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_are_the_documents_and_sequences_are_gapless(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    draw = random.Random(8)
    vocabulary = ["the", "Über-größe", "don't", "x1,", "日本語", "<|endoftext|>", "ending.", "Ça!!", "a b"]
    texts = [draw.choice([" ", "\n", " \x1c "]).join(draw.choices(vocabulary, k=draw.choice([0, 1, 5, 60, 300]))) for _ in range(60)]
    texts += [None, "", texts[3], "word " * 2047, "word " * 5000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    rows = pack(docs.repartition(3), VOCABULARY).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    tokens = sum(r.length for r in rows)
    assert len(by_sequence) <= tokens // 2048 + 2


def test_empty_table_and_equal_or_null_ids(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = pack(docs, VOCABULARY).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 2), (1, 3), (1, 3)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_patterns_cover_the_histogram_close_to_the_bound(seed):
    draw = random.Random(seed)
    histogram = {u: draw.randrange(1, 4000) for u in draw.sample(range(1, 65), draw.choice([1, 20, 60]))}
    chosen = patterns(histogram, 64)
    used = defaultdict(int)
    for pattern, times in chosen:
        assert sum(u * n for u, n in pattern.items()) <= 64
        for u, n in pattern.items():
            used[u] += n * times
    assert used == histogram
    single = sum(n for u, n in histogram.items() if u > 32)
    bound = max(single, sum(u * n for u, n in histogram.items()) / 64)
    assert sum(n for _, n in chosen) <= 1.02 * bound + len(histogram) or len(histogram) < 20
    slots = assign_slots(histogram, chosen)
    assert set(slots) == set(histogram)


@pytest.mark.parametrize(("sizes", "most"), [(250, 3), (250, 5000), (120, 2)])
def test_the_linear_program_ends_soon_for_many_sizes(spark, sizes, most):
    draw = random.Random(sizes + most)
    histogram = {u: draw.randrange(1, most + 1) for u in draw.sample(range(1, 256), sizes)}
    began = time.monotonic()
    chosen = patterns(histogram, 256)
    assert time.monotonic() - began < 3
    units = sum(u * n for u, n in histogram.items())
    assert sum(n for _, n in chosen) <= 1.02 * units / 256 + 4


def test_inverse_by_elimination():
    matrix = np.random.default_rng(3).integers(0, 9, (40, 40)) + 20.0 * np.eye(40)
    assert np.abs((matrix[:, :, None] * inverted(matrix)[None]).sum(axis=1) - np.eye(40)).max() < 1e-9


def test_words_of_any_white_space_and_special_tokens():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = ["", "  A\tb\x0b\x0cC \r\n", "x<|endoftext|>Y <|pad|>", "\x1c\x85a B é É", "word " * 3000, "1,2 don't İ"]
    found = WordIds(open(VOCABULARY, encoding="utf-8").read())
    for _ in range(2):
        ids, starts = found.encode(pa.array(texts, pa.large_string()))
        for i, text in enumerate(texts):
            assert ids[starts[i] : starts[i + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_distinct_words_cost_less_than_encoding_them_one_by_one():
    draw = random.Random(6)
    bases = list({"".join(draw.choices("etaonrisß", k=draw.randrange(6, 14))) for _ in range(60000)})
    words = [base + end for base in bases for end in ("", ".")]
    texts = pa.array([" ".join(words[i : i + 100]) for i in range(0, len(words), 100)], pa.large_string())
    description = open(VOCABULARY, encoding="utf-8").read()
    tokenizer = WordIds(description)._tokenizer

    def seconds(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    alone = min(seconds(lambda: tokenizer.encode_batch_fast(bases, add_special_tokens=False)) for _ in range(3))
    assert min(seconds(lambda f=WordIds(description): f.encode(texts)) for _ in range(3)) < alone


@pytest.mark.parametrize("cached", [0, 1 << 20])
def test_letters_and_punctuation_give_the_ids_of_the_whole_text(monkeypatch, cached):
    from tokenizers import Tokenizer

    monkeypatch.setattr(cutting_stock, "CACHED_WORDS", cached)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    draw = random.Random(5)
    letters = "azsßàöøÿ÷×ÉǅſİŁ\u0301\u00a0\u4e2d1'_"
    ends = ["", "", ".", ",", ").", "...", "|", "-", "-x", "<|endoftext|>", "\u2026", "'s", "\u00ad"]
    words = ["".join(draw.choices(letters, k=draw.randrange(1, 7))) + draw.choice(ends) for _ in range(6000)]
    words += ["".join(draw.choices("etaonß", k=draw.randrange(1, 40))) + draw.choice(ends) for _ in range(6000)] + ["...", "a.b", "é" * 500]
    draw.shuffle(words)
    texts = [" ".join(words[i : i + 40]) for i in range(0, len(words), 40)] + ["", " ", "\n"]
    found = WordIds(open(VOCABULARY, encoding="utf-8").read())
    for low in (0, 100, 0):
        ids, starts = found.encode(pa.array(texts[low:], pa.large_string()))
        for i, text in enumerate(texts[low:]):
            assert ids[starts[i] : starts[i + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]

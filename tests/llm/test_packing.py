"""Pieces put together again against the tokenizer on whole texts, and the packer alone."""

import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from haulgrid.llm import packing
from haulgrid.llm.packing import END, LEAST, SIZES, STEP, Packer, Piece, pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
KINDS = "doc_id long, text string, start long, ids string"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


TOKENIZER = Tokenizer.from_file(PATH)


def whole_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, END]


def ids_of(data):
    return [int.from_bytes(data[at:at + 4], "little") for at in range(0, len(data), 4)]


def test_words_by_the_model_alone(model):
    random.seed(2)
    letters = "abcXYZéÀßÿ×÷'._-<|>19 \u0301İ"
    encoder = packing.Encoder(model)
    for _ in range(4000):
        text = "".join(random.choice(letters) for _ in range(random.randint(1, 9)))
        assert ids_of(encoder.encoded(text)) == whole_ids(text)[:-1], text


def check_sequences(rows):
    """Sequences are gapless and short enough; returns the ids that padding takes and all ids."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append(row)
    padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda row: row.offset)
        at = 0
        for row in parts:
            assert row.offset == at and row.length > 0
            at += row.length
        assert at <= SIZES[-1] and {row.size for row in parts} == {at if at & (at - 1) == 0 else SIZES[-1]}
        assert len({row.step for row in parts}) == 1
        padding += parts[0].size - at
    return padding, sum(row.length for row in rows)


def check_documents(rows, wanted):
    """Each document's pieces, put together, are its ids."""
    documents = defaultdict(list)
    for row in rows:
        documents[row.document].append(row)
    found = []
    for parts in documents.values():
        parts.sort(key=lambda row: row.start)
        ids = [i for row in parts for i in ids_of(bytes(row.ids))]
        at = 0
        for row in parts:
            assert row.start == at and row.length * 4 == len(row.ids) and row.doc_tokens == len(ids)
            at += row.length
        found.append((parts[0].doc_id, ids))
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_given_documents_come_back(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pieces(docs, model).collect()
    check_documents(rows, [(row.doc_id, whole_ids(row.text)) for row in docs.collect()])
    padding, total = check_sequences(rows)
    assert padding < 2 * SIZES[-1] + total / 100


def test_odd_texts(spark, model, monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 500)
    monkeypatch.setattr(packing, "POOL", 3000)
    monkeypatch.setattr(packing, "KEPT_WORDS", 20)
    monkeypatch.setattr(packing, "KEPT_PLAIN", 7)
    monkeypatch.setattr(packing, "KEPT_LETTERS", 5)
    random.seed(11)
    strange = ["áb", "́x", "ΟΔΟΣ", "I'll'LL", "<|endoftext|>", "x<|startoftext|>y", " ", " ", "\x1c", "\x85", "123", "🙂🙂",
               "ﬁ", "中文字", "\n", "\t\t", "  ", "don't", "'tis", "('s", "Dogs'", "((Äß!?", "×a÷", "a_b", "_x_", "ÀÉÎ.", "12,5", "É", "\u0338<", "ǅ", "İ", "​", "…!?"]
    rows = [(i, "".join(random.choice(strange) + random.choice(["", " ", "\n"]) for _ in range(random.randint(1, 400)))) for i in range(40)]
    rows += [(None, None), (None, ""), (7, "a" * 9000), (7, "word " * 5000), (7, "word " * 5000), (8, " " * 3000)]
    docs = spark.createDataFrame([(*row, 1, "x") for row in rows], KINDS)
    found = pieces(docs, model).collect()
    check_documents(found, [(doc_id, whole_ids(text)) for doc_id, text in rows])
    check_sequences(found)


def test_no_documents(spark, model):
    assert pieces(spark.createDataFrame([], KINDS), model).count() == 0


def test_query(spark):
    wanted = {row.doc_id: whole_ids(row.text) for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = packing.op11_packing(spark, SF, PATH).collect()
    assert sum(row.length for row in rows) == sum(map(len, wanted.values()))
    for row in rows:
        part = b"".join(i.to_bytes(4, "little") for i in wanted[row.doc_id][row.start:row.start + row.length])
        assert row.ids_crc32 == zlib.crc32(part) and row.doc_tokens == len(wanted[row.doc_id])


@pytest.mark.parametrize("lengths", [
    lambda: random.randint(1, 5000), lambda: random.randint(1025, 2047), lambda: random.randint(1, 40), lambda: 1500, lambda: 2048, lambda: 3,
])
def test_packer_pads_little_and_balances(lengths):
    random.seed(3)
    sizes = [lengths() for _ in range(3000)]
    packer = Packer()
    for number, size in enumerate(sizes):
        packer.add(Piece(number, number, 0, size, bytes(4 * size)))
    left = packer.finish()
    assert sum(map(len, left)) < SIZES[0]
    windows = packer.stepped()
    for _, size, window in windows:
        used = sum(map(len, window))
        assert used == size or (size == SIZES[-1] and size - used < LEAST)
    assert sum(len(p) for _, _, w in windows for p in w) + sum(map(len, left)) == sum(sizes)
    steps = defaultdict(int)
    for step, size, _ in windows:
        steps[step] += size
    assert max(steps.values()) - min(steps.values()) <= SIZES[-1] and min(steps.values()) >= STEP // 2 or len(steps) == 1


def test_letters_are_tokenized_once_for_all_forms_of_a_word(model):
    encoder = packing.Encoder(model)
    seen, tokenize = [], encoder.tokenize
    encoder.tokenize = lambda word: (seen.append(word), tokenize(word))[1]
    text = "Qzword qzword, (QZWORD) qzword. \"Qzword!\" Ärger ärger; 'Qzword don't qzword's"
    assert ids_of(encoder.encoded(text)) == whole_ids(text)[:-1]
    assert seen.count("qzword") == 1 and len(seen) == 2

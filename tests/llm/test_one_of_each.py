"""Which row stands for a component if ids repeat or are missing."""

from haulgrid.llm.simhash import fingerprint, one_of_each

KINDS = "doc_id long, text string, lang string"
WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima".split()
A, B, C, D = (" ".join(f"{word}{number}" for word in WORDS) for number in range(4))


def kept(spark, rows):
    return sorted(map(tuple, one_of_each(spark.createDataFrame(rows, KINDS)).collect()), key=repr)


def test_texts_are_apart():
    prints = [fingerprint(text) for text in (A, B, C, D)]
    assert all(bin(x ^ y).count("1") > 3 for i, x in enumerate(prints) for y in prints[:i])


def test_an_id_that_leads_two_components_keeps_a_row_of_each(spark):
    rows = [(1, A, "en"), (1, B, "en"), (2, A, "en"), (3, B, "en")]
    assert kept(spark, rows) == sorted(rows[:2], key=repr)


def test_many_texts_under_one_id_all_stay(spark):
    rows = [(7, " ".join(f"{word}{number}" for word in WORDS), "en") for number in range(50)]
    texts = {fingerprint(text) for _, text, _ in rows}
    found = kept(spark, rows)
    assert len(found) == len(texts) == 50 and found == sorted(rows, key=repr)


def test_an_id_that_leads_one_component_goes_from_others(spark):
    rows = [(5, A, "en"), (5, B, "en"), (1, B, "en")]
    assert kept(spark, rows) == sorted([(5, A, "en"), (1, B, "en")], key=repr)


def test_copies_without_ids_are_one(spark):
    rows = [(None, A, "en")] * 300 + [(None, B, None), (None, B, "en"), (4, C, "en"), (4, C, "en"), (4, C, "de")]
    found = kept(spark, rows)
    assert sorted(text for _, text, _ in found) == sorted([A, B, C])


def test_a_row_without_an_id_goes_beside_one_with(spark):
    rows = [(None, A, "en"), (None, A, "de"), (9, A, "en"), (None, B, "en"), (None, B, "en")]
    assert kept(spark, rows) == sorted([(9, A, "en"), (None, B, "en")], key=repr)

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.brute import raked as brute
from tests.llm.brute import uniform

from haulgrid.llm.mixing import (
    PLACES, TOGETHER, Places, _added, _counted, _spread, fit_topics, fitted, goals, mixture, raked, with_topics,
)

KINDS = "doc_id long, text_hash long, source string, lang string, topic string, tokens long, weight string"


def rows():
    random = np.random.default_rng(1)
    found = [
        (i, 7 * i, f"s{int(random.integers(5))}" if i % 3 else "s0", [None, "de", "en"][int(random.integers(3))],
         str(int(random.integers(3))), int(random.integers(0, 200)), "x") for i in range(400)
    ]
    return [*found, *found[:5], (None, 1, None, None, "0", 10, "x"), (901, 2, "empty", "de", "0", 0, "x")]


def shares(table, at, power=0.5):
    sums = {}
    for row in table:
        sums[row[at]] = sums.get(row[at], 0) + row[5]
    total = sum(n**power for n in sums.values() if n)
    return {value: n**power / total for value, n in sums.items() if n}


def capped(sums, shares, sample):
    """min(tokens, c share) that add up to the sample."""
    low, high = 0.0, max(n / shares[v] for v, n in sums.items() if shares.get(v))
    for _ in range(200):
        c = (low + high) / 2
        if sum(min(n, c * shares.get(v, 0)) for v, n in sums.items()) < sample:
            low = c
        else:
            high = c
    return {v: min(n, high * shares.get(v, 0)) for v, n in sums.items()}


def sums_of(table, at):
    sums = {}
    for row in table:
        sums[row[at]] = sums.get(row[at], 0) + row[5]
    return {value: n for value, n in sums.items() if n}


def test_both_ways_take_the_same_steps(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 90), (None, "x", 100), (None, "y", 800), (None, "z", 0)],
                                  "source string, lang string, tokens long")
    targets = spark.createDataFrame(
        [("source", "a", 0.5), ("source", None, 0.5), ("lang", "x", 0.3), ("lang", "y", 0.7)], "dimension string, value string, share double"
    )
    wanted = goals(cells, targets, ["source", "lang"]).withColumn("goal", F.col("share") * 300)
    ways = [raked(cells, wanted, ["source", "lang"], most=0.9, rounds=3, here=here) for here in (0, 100)]
    for one, other in zip(ways[0][:2], ways[1][:2]):
        one, other = (sorted([tuple(r) for r in rows.collect()], key=repr) for rows in (one, other))
        assert [[pytest.approx(v) if isinstance(v, float) else v for v in r] for r in one] == [list(r) for r in other]
    for name in ("source", "lang"):
        one, other = ({r.value: r.factor for r in way[2][name].collect()} for way in ways)
        assert one == pytest.approx(other)


@pytest.mark.parametrize("keep", [0.4, 0.9])
def test_weights_probabilities_and_draw(spark, keep):
    table = rows()
    found = mixture(spark.createDataFrame(table, KINDS), keep=keep)
    assert found.columns.count("weight") == 1
    got = found.collect()
    assert len(got) == len(table)
    cells = {}
    for row in table:
        cells[row[2:5]] = cells.get(row[2:5], 0) + row[5]
    total = sum(cells.values())
    wanted = brute(cells, [shares(table, at) for at in (2, 3, 4)])
    for r in got:
        cell = (r.source, r.lang, r.topic)
        if cells[cell]:
            assert abs(r.weight - wanted[cell] * total / cells[cell]) < 1e-3
        assert 0 <= r.probability <= 1
        assert r.kept == (uniform((7, "<i"), (r.doc_id, "<q"), (r.text_hash, "<q")) < r.probability)
    assert abs(sum(r.tokens * r.probability for r in got) / total - keep) < 1e-3
    for at, name in ((2, "source"), (3, "lang"), (4, "topic")):
        goal = capped(sums_of(table, at), shares(table, at), keep * total)
        for value, tokens in goal.items():
            held = sum(r.tokens * r.probability for r in got if r[name] == value)
            assert abs(held - tokens) < 2e-3 * keep * total


def test_full_cells_stay_full_and_others_reach_the_goal(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 90), ("b", "x", 100), ("b", "y", 800)],
                                  "source string, lang string, tokens long")
    targets = spark.createDataFrame(
        [("source", "a", 0.5), ("source", "b", 0.5), ("lang", "x", 0.5), ("lang", "y", 0.5)],
        "dimension string, value string, share double",
    )
    found, met = fitted(cells, targets, 0.2, ["source", "lang"])
    chance = {(r.source, r.lang): r.probability for r in found.collect()}
    # The goals are 100 each; source a has no more, so its cells are full and b's make up the rest.
    assert chance == {("a", "x"): pytest.approx(1.0, abs=0.01), ("a", "y"): pytest.approx(1.0, abs=0.01),
                      ("b", "x"): pytest.approx(0.9, abs=0.02), ("b", "y"): pytest.approx(10 / 800, abs=0.005)}
    assert all(r.goal == pytest.approx(100) and abs(r.got - 100) < 1 for r in met.collect())


def test_goals_that_contradict_each_other_are_told(spark):
    docs = spark.createDataFrame([(1, 1, "a", "x", "1", 50, ""), (2, 2, "b", "y", "1", 50, "")], KINDS)
    targets = spark.createDataFrame(
        [("source", "a", 0.9), ("source", "b", 0.1), ("lang", "x", 0.1), ("lang", "y", 0.9), ("topic", "1", 1.0)],
        "dimension string, value string, share double",
    )
    with pytest.warns(UserWarning, match="tokens of"):
        mixture(docs, targets, 0.1).collect()


def test_targets_that_are_given(spark):
    cells = spark.createDataFrame([("a", 10), ("b", 30), (None, 60)], "source string, tokens long")
    targets = spark.createDataFrame(
        [("source", "a", 0.5), ("source", None, 0.3), ("source", "nowhere", 0.2)], "dimension string, value string, share double"
    )
    wanted = goals(cells, targets, ["source"]).withColumn("goal", F.col("share"))
    found, met, _ = raked(cells, wanted, ["source"])
    assert {r.source: round(r.tokens * r.factor, 6) for r in found.collect()} == {"a": 0.625, "b": 0.0, None: 0.375}
    assert all(abs(r.got - r.goal) < 1e-6 for r in met.collect())


def test_no_rows(spark):
    assert mixture(spark.createDataFrame([], KINDS)).count() == 0


THEMES = {"sea": "ship sail wave harbour anchor tide crew mast", "kitchen": "oven flour butter knife pan recipe salt spoon"}
FRENCH = {"sea": "navire voile vague port ancre maree equipage mat", "kitchen": "four farine beurre couteau poele recette sel cuillere"}


def themed(number):
    random = np.random.default_rng(number)
    out = []
    for i in range(number):
        lang, words = (("en", THEMES), ("fr", FRENCH))[i % 2]
        theme = ("sea", "kitchen")[i // 2 % 2]
        common = ["the", "and", "of"] if lang == "en" else ["le", "et", "de"]
        text = " ".join(random.choice([*words[theme].split(), *common * 2], 40))
        out.append((i, text, lang, theme))
    return out


def test_topics_are_themes_not_languages(spark):
    table = themed(200)
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string")
    topics = fit_topics(docs, topics=4)
    found = {r.doc_id: r.topic for r in with_topics(docs, topics=topics).collect()}
    for lang in ("en", "fr"):
        kinds = {theme: {found[i] for i, _, of, t in table if of == lang and t == theme} for theme in THEMES}
        assert not kinds["sea"] & kinds["kitchen"]
    again = fit_topics(docs.orderBy(F.rand(3)).repartition(5), topics=4)
    assert {r.doc_id: r.topic for r in with_topics(docs, topics=again).collect()} == found


def test_texts_without_words_and_strange_ones(spark):
    rows_ = [(1, None, None, "s"), (2, "", "en", "s"), (3, " 12 ", "en", None), (4, "ship " * 50_000, "xx", "s"), (4, "ship", None, "s")]
    docs = spark.createDataFrame([(*row, "t", 9) for row in rows_], "doc_id long, text string, lang string, source string, topic string, tokens int")
    found = sorted((r.doc_id, r.topic != "0", r.tokens) for r in with_topics(docs).collect())
    assert found == [(1, False, 0), (2, False, 0), (3, False, 1), (4, True, 1), (4, True, 50_000)]
    empty = with_topics(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text_hash", "source", "lang", "topic", "tokens"]


def test_topics_are_fitted_on_all_distinct_texts(spark):
    random = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    table = [(i, " ".join(random.choice(words[40 * (i % 3):][:70], 30)), [None, "de", "en"][i % 7 % 3], "s") for i in range(3500)]
    table += [(9000 + i, table[0][1], table[0][2], "s") for i in range(300)]  # copies count once
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string")
    topics = fit_topics(docs, topics=4)

    texts = sorted({(lang or "", text) for _, text, lang, _ in table})
    vectors = np.zeros((len(texts), PLACES))
    for row, (_, text) in enumerate(texts):
        for word, times in Counter(text.split()).items():
            vectors[row, zlib.crc32(word.encode()) % PLACES] += times
    vectors = np.unique(np.column_stack([np.sqrt(vectors), [["", "de", "en"].index(lang) for lang, _ in texts]]), axis=0)
    vectors, own = vectors[:, :-1], vectors[:, -1].astype(int)
    rare = np.log((1 + len(vectors)) / (1 + (vectors > 0).sum(axis=0))) + 0.1
    assert np.allclose(topics.rare, rare)
    vectors = vectors * rare
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    means = np.stack([vectors[own == at].mean(axis=0) for at in range(3)])
    assert list(topics.number) == [None, "de", "en"] and np.allclose(topics.means, means, atol=1e-6)
    vectors -= means[own]
    sizes = np.linalg.norm(vectors, axis=1)
    vectors /= sizes[:, None]
    chosen = [int(sizes.argmax())]
    while len(chosen) < 4:
        chosen.append(int((vectors @ vectors[chosen].T).max(axis=1).argmin()))
    centres = vectors[chosen]
    for _ in range(20):
        to = (vectors @ centres.T).argmax(axis=1)
        centres = np.stack([vectors[to == at].sum(axis=0) for at in range(4)])
        centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    assert np.allclose(topics.centres, centres, atol=1e-4)
    again = fit_topics(docs.repartition(7), topics=4)
    assert np.array_equal(again.centres, topics.centres)


def test_places_of_words_are_those_of_the_whole_text():
    random = np.random.default_rng(3)
    letters = list("abXYéÉÀßİıΣσςſK9_.'-|+ \t\n\x0b\x0c\xa0\x1c 字́ǅ²½") + ["ab", "don't", " The ", "a-b "]
    texts = ["".join(random.choice(letters, int(random.integers(0, 60)))) for _ in range(3000)]
    places = Places()
    for text in [*texts, "", " ", "x" * 100, "é" * 100, *texts[:100]]:
        wanted = Counter(zlib.crc32(word.encode()) % PLACES for word in re.findall(r"[^\W\d_]+", text.lower()))
        tokens, at, times = places.counted(text)
        assert tokens == len(text.encode().split())
        assert dict(zip(at.tolist(), times.tolist())) == wanted and at.tolist() == sorted(wanted)
    assert max(map(len, places)) <= 40


def test_words_of_texts_taken_together_are_those_of_each():
    random = np.random.default_rng(4)
    strange = [*"abXYéÉÀßİıΣσςſK9_.'-|+ \t\n\x0b\x0c\xa0\x1c\x85 字́ǅ²½×÷ÿŸªµº\x00", "don't", " The ", "y" * 40, "z" * 41, "É" * 20 + " ", "é" * 21]
    latin = [*"aZ09ÀÖØÞßàöøþÿ.,- \n"]
    texts = ["".join(random.choice(strange if i % 2 else latin, int(random.integers(0, 60)))) for i in range(2000)]
    texts += ["", " ", "é", "Straße" * 5, "字 " * TOGETHER, "ab é " * TOGETHER, "x" * 2 * TOGETHER, ""]
    tokens, sizes, at, times = _counted([text.encode() for text in texts], Places())
    assert tokens.tolist() == [len(text.encode().split()) for text in texts]
    ends = np.cumsum(sizes)
    for text, begin, end in zip(texts, ends - sizes, ends):
        wanted = Counter(zlib.crc32(word.encode()) % PLACES for word in re.findall(r"[^\W\d_]+", text.lower()))
        assert dict(zip(at[begin:end].tolist(), times[begin:end].tolist())) == wanted
        assert at[begin:end].tolist() == sorted(wanted)
    assert [one.tolist() for one in _counted([], Places())] == [[]] * 4

    places = Places()  # only what is neither ASCII nor Latin, or is long, is looked up by itself
    _counted([text.encode() for text in texts[:2000:2]], places)
    assert not places


def test_vectors_are_read_where_arrow_holds_them():
    cells = [np.arange(n, n + n, dtype="<u2").tobytes() for n in (3, 0, 1, 4, 2)]
    values = [np.arange(n, dtype="<f4").tobytes() for n in (3, 0, 1, 4, 2)]
    for kind in (pa.binary(), pa.large_binary()):
        at, n = pa.array(cells, kind), pa.array(values, kind)
        for begin, number in ((0, 5), (2, 2), (1, 1), (5, 0)):
            rows, places, numbers = _spread(at.slice(begin, number), n.slice(begin, number))
            sizes = (3, 0, 1, 4, 2)[begin: begin + number]
            assert rows.tolist() == [i for i, size in enumerate(sizes) for _ in range(size)]
            assert places.tolist() == [size + i for size in sizes for i in range(size)]
            assert numbers.tolist() == [i for size in sizes for i in range(size)]


def test_sums_of_whole_numbers_are_exact(spark):
    rows = [("a", 1 << 62), ("a", 1 << 62), ("a", 1 << 62), ("a", 3), ("b", -(1 << 62)), ("b", -(1 << 62) - 5), ("b", -(1 << 62)), ("c", -1)]
    found = _added(spark.createDataFrame(rows, "key string, n long"), "key")
    assert dict(zip(found["key"], found["n"])) == {"a": 3 * (1 << 62) + 3, "b": -3 * (1 << 62) - 5, "c": -1}

"""Spelling variants: words one edit apart, by composing finite-state machines.

The vocabulary is an acceptor, minimised so that equal endings are one state. Composed with a
transducer that makes exactly one edit, and with the acceptor again, it accepts the pairs of words
one edit apart. A state of the composition is a state of the left acceptor, one of the transducer
and one of the right. The transducer reads the longer word, or the smaller of two equally long
ones, and deletes a letter only if the next one differs, so it accepts each pair once and on one path.

No task holds the whole acceptor. The pairs are dealt by the initial state that they start from:
one edit leaves one half of a word as it is, so a pair shares either its first half or its last,
and only words that share it meet. That half is read already in the pair's initial state; the
composition runs over the rest. Where more than ``CELL`` words share a half, the rest is halved in
the same way, again and again, so that hot beginnings are split and nothing is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from haulgrid.llm.common import ASCII_UPPER, lowered, stored, table

#: A run of letters after A to Z were lower-cased.
RUN = "[a-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A word's form occurs at least so many times as often.
RATIO = 5
#: The registered query strikes out a letter where this divides a hash.
STRUCK = 199

#: Words that share a half are composed together up to this number; above it the rest is halved.
CELL = 5000
#: Longer rests are halved as well.
REST = 32
#: Words whose acceptors a task holds at a time, about.
AT_ONCE = 20_000


class State:
    """A state of an acceptor: whether a word may end here, and where each letter leads."""

    __slots__ = ("final", "arcs")

    def __init__(self):
        self.final, self.arcs = False, {}


class Acceptor:
    """A minimised acceptor with an initial state for each set of words that it is given."""

    def __init__(self):
        self.register: dict[tuple, State] = {}

    def _minimal(self, state: State) -> State:
        """The state that accepts the same endings, this one if there is none yet."""
        return self.register.setdefault((state.final, *((c, id(s)) for c, s in state.arcs.items())), state)

    def initial(self, words: list[str]) -> State:
        """The initial state of these words, which are sorted."""
        path, before = [State()], ""

        def close(keep: int) -> None:
            while len(path) > keep + 1:
                state = self._minimal(path.pop())
                path[-1].arcs[before[len(path) - 1]] = state

        for word in words:
            common = shared(before, word)
            close(common)
            path.extend(State() for _ in word[common:])
            path[-1].final, before = True, word
        close(0)
        return self._minimal(path[0])


def shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    for at, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return at
    return min(len(a), len(b))


def spelled(link: tuple | None) -> str:
    """The letters of a path, kept as links from the last to the first."""
    letters = []
    while link:
        link, letter = link
        letters.append(letter)
    return "".join(reversed(letters))


def composed(longer: State, shorter: State, upto: int) -> Iterator[tuple[str, str]]:
    """Pairs of words one edit apart, the edit behind fewer than ``upto`` letters.

    They are pairs of two words from ``shorter``, the smaller one first, and of a word from
    ``longer`` that is a letter longer than the one from ``shorter``. All words of an initial state
    are of one length, so a word that lost a letter can only be the other one's.
    """
    # (left state, right state, letters so far on each side, where nothing was edited yet)
    clean = [(longer, shorter, None, 0, True), (shorter, shorter, None, 0, False)]
    done: list[tuple] = []
    while clean:
        left, right, link, depth, deletes = clean.pop()
        for letter, state in left.arcs.items():
            if depth < upto:
                if deletes:
                    # a:empty, then any letter but a, or the end
                    done.append((state, right, (link, letter), link, letter))
                else:
                    done += [
                        (state, other, (link, letter), (link, changed), None)
                        for changed, other in right.arcs.items() if letter < changed
                    ]
            if depth + 1 < upto and letter in right.arcs:
                clean.append((state, right.arcs[letter], (link, letter), depth + 1, deletes))
        while done:
            p, q, a, b, deleted = done.pop()
            if p.final and q.final:
                yield spelled(a), spelled(b)
            done += [
                (state, q.arcs[letter], (a, letter), (b, letter), None)
                for letter, state in p.arcs.items() if letter != deleted and letter in q.arcs
            ]


def _links(rows: list[dict]) -> list[tuple]:
    """(word, near, near_n) of rows, which are whole groups, in both directions."""
    groups: dict[str, list[dict]] = {}
    for row in rows:
        groups.setdefault(row["key"], []).append(row)
    acceptor, out = Acceptor(), []
    for group in groups.values():
        first = group[0]
        start, trail, shorter = first["start"], first["trail"], first["shorter"]
        n = {row["word"]: row["n"] for row in group}
        before, after = first["word"][:start], first["word"][len(first["word"]) - trail:]
        rests = {True: [], False: []}
        for word in n:
            rests[len(word) > shorter].append(word[start:len(word) - trail])
        longer, same = (acceptor.initial(sorted(rests[kind])) for kind in (True, False))
        for a, b in composed(longer, same, first["limit"] - start):
            a, b = before + a + after, before + b + after
            out += [(a, b, n[b]), (b, a, n[a])]
    return out


LINKS = T.StructType().add("word", T.StringType()).add("near", T.StringType()).add("near_n", T.LongType())


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compose the groups of a task, which come sorted by key, some after the others."""
    held: list[dict] = []

    def linked(rows: list[dict]) -> list[pa.RecordBatch]:
        names = LINKS.names
        found = [dict(zip(names, link)) for link in _links(rows)]
        return pa.Table.from_pylist(found, to_arrow_schema(LINKS)).to_batches()

    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            held += batch.slice(at, AT_ONCE).to_pylist()
            if len(held) >= AT_ONCE:
                last = held[-1]["key"]  # its group may go on
                yield from linked([row for row in held if row["key"] != last])
                held = [row for row in held if row["key"] == last]
    yield from linked(held)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of its rest read, and with the last half.

    A row is a word of which ``start`` letters at its beginning and ``trail`` at its end are those of
    all words it meets; the shorter words that it meets have ``shorter`` letters. An edit in the
    last half lies behind the whole first half. One in the first half lies behind fewer letters,
    which ``limit`` says, so a pair is found in one of the two only.
    """
    rest = F.col("shorter") - F.col("start") - F.col("trail")
    half = F.floor(rest / 2).cast("int")
    kinds = F.array(
        F.struct((F.col("start") + half).alias("start"), F.col("trail"), F.col("limit")),
        F.struct(
            F.col("start"), (F.col("trail") + rest - half).alias("trail"),
            F.least("limit", F.col("start") + half).alias("limit"),
        ),
    )
    return rows.withColumn("kind", F.explode(kinds)).select("word", "n", "shorter", "kind.*")


def _keyed(rows: DataFrame) -> DataFrame:
    """Add ``key``, which says what words must share to meet, and ``met``, how many do."""
    word = F.col("word")
    # Words of the longer kind alone have nothing to meet.
    meets = F.bool_or(F.length(word) == F.col("shorter")) & (F.count("*") > 1)
    key = F.md5(F.concat_ws(
        " ", "shorter", "start", "trail", "limit", F.left(word, F.col("start")), F.right(word, F.col("trail"))
    ).cast("binary"))
    rows = stored(rows.withColumn("key", key), "spelling-dealt")
    met = rows.groupBy("key").agg(F.count("*").alias("met"), meets.alias("meets")).where("meets").drop("meets")
    return stored(rows.join(met, "key"), "spelling-met")


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, near, near_n) of all words one edit apart, in both directions, once each.

    ``words`` has word and n, each word once; n goes along. An edit inserts, deletes or replaces
    one code point. A NULL or empty word is near nothing. Other columns are not read.
    """
    length = F.length("word")
    rows = words.where(length > 0).select(
        "word", "n", F.explode(F.array(length, length - 1)).alias("shorter"),
        F.lit(0).alias("start"), F.lit(0).alias("trail"),
    )
    # An edit lies behind all letters at most.
    rows = rows.where("shorter > 0").withColumn("limit", F.col("shorter") + 1)
    settled = None
    while True:
        rows = _keyed(_halved(rows))
        rest = F.col("shorter") - F.col("start") - F.col("trail")
        # A rest of one letter cannot be halved; such words differ in at most two letters.
        large = (rest > 1) & ((F.col("met") > cell) | (rest > REST))
        done = rows.where(~large)
        settled = done if settled is None else settled.union(done)
        rows = rows.where(large).drop("key", "met")
        if rows.isEmpty():
            break
    dealt = settled.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_composed, LINKS)


def _last_forms(forms: DataFrame) -> DataFrame:
    """(word, last) for words with a form: where following the forms ends.

    Each round goes twice as far. A form occurs more often than its word, so no path is a ring.
    """
    links = stored(forms.where("form is not null").select("word", F.col("form").alias("last")), "spelling-roots")
    while True:
        on = links.select(F.col("word").alias("via"), F.col("last").alias("further"))
        links = stored(links.join(on, F.col("last") == F.col("via"), "left").select(
            "word", F.coalesce("further", "last").alias("last"), F.col("further").isNotNull().alias("moved")
        ), "spelling-roots")
        if links.where("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO, cell: int = CELL) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of ``words`` (word, n).

    form is the word's near word of largest n, the smallest in code-point order if several have it,
    if that is at least ``ratio`` times the word's own n, else NULL; n_near is the number of near
    words; root is where following the forms ends, the word itself if it has none. Words come once
    each; a NULL word has no result, an empty table gives an empty table. Other columns are not read.
    """
    words = stored(words.where("word is not null").select("word", F.col("n").cast("long")), "spelling-words")
    best = near_words(words, cell).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    known = words.join(best, "word", "left")
    holds = -F.col("best.less") >= F.col("n") * ratio
    forms = stored(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(holds, F.col("best.near")).alias("form"), F.when(holds, -F.col("best.less")).alias("form_n"),
    ), "spelling-forms")
    return forms.join(_last_forms(forms), "word", "left").select(*forms.columns, F.coalesce("last", "word").alias("root"))


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): each run of letters of each whole text, A to Z in lower case."""
    found = F.regexp_extract_all(lowered(F.col("text").cast("string")), F.lit(RUN), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run"))


def vocabulary(words: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words (word) that have so many code points and occur so often."""
    counts = words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= count)


def _struck(doc_id: Column, run: Column) -> Column:
    """The run, without a letter where ``STRUCK`` divides the hash of both. A NULL id strikes none."""
    hashed = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (hashed % F.length(run)).cast("int")
    without = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    return F.when(hashed % STRUCK == 0, without).otherwise(run)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents, some misspelt on purpose."""
    found = runs(table(spark, sf_dir, "documents"))
    words = found.select(_struck(F.col("doc_id"), F.col("run")).alias("word"))
    return variants(vocabulary(words)).select("word", "form", "root", "n", "n_near", "form_n")


#: CRC-32 is written out bit by bit: DuckDB has none.
SQL = f"""
WITH RECURSIVE occurring AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '{RUN}')) AS run
  FROM documents
), told AS (
  SELECT run, count(*) AS k, doc_id IS NOT NULL AS named,
    flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, (unicode(c) & 63) | 128] END
      FOR c IN string_split(CAST(doc_id AS VARCHAR) || ':' || run, '')]) AS bytes
  FROM occurring GROUP BY doc_id, run
), hashed AS (
  SELECT run, k, named, xor(list_reduce(list_prepend(4294967295, flatten([[(byte >> b) & 1 FOR b IN range(8)] FOR byte IN bytes])),
    lambda crc, bit: xor(crc >> 1, (xor(crc, bit) & 1) * 3988292384)), 4294967295) AS h
  FROM told
), struck AS (
  SELECT k, CASE WHEN named AND h % {STRUCK} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM struck WHERE length(word) >= {LEAST_LENGTH}
  GROUP BY word HAVING sum(k) >= {LEAST_COUNT}
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM words, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM cut a JOIN words w ON a.less = w.word
  UNION SELECT w.word, a.word, a.n FROM cut a JOIN words w ON a.less = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * n THEN other END AS form,
    CASE WHEN other_n >= {RATIO} * n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word
), chain AS (
  SELECT word, word AS via FROM forms
  UNION ALL
  SELECT chain.word, forms.form FROM chain JOIN forms ON chain.via = forms.word WHERE forms.form IS NOT NULL
)
SELECT f.word, f.form, chain.via AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain ON chain.word = f.word JOIN forms e ON chain.via = e.word AND e.form IS NULL
"""

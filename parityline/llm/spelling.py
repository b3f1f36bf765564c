"""Spelling variants of a corpus's words, by a dictionary of pairs of trie nodes.

The words are put into two tries, one of the words and one of their reversals, and the
nodes of both are numbered. A word that leaves out its i-th letter is a pair of integers,
its prefix's node and its suffix's; so is the gap before each letter and after the last.
Two words differ by one replaced letter exactly if they leave out a letter at the same
pair, and by one inserted letter exactly if one leaves out a letter where the other has a
gap. One grouping on the pairs finds all of them, and no others, without comparing words.

A trie is numbered by tasks that each hold a range of the sorted words. The words that cut
the ranges form a small trie of their own: a prefix that two ranges share is a prefix of
the cut between them, so its number comes from there, and every other node belongs to one
range. A node's number costs one step of its word, however long the word is.

The words that leave out a letter at one pair differ in that letter alone, so a group is
never larger than the alphabet, and one word more that has the gap there. A letter of a run
of equal ones is left out at the run's first place only, so every link is found once.

Defined results: a null text has no words; a null id is the empty text; repeated rows count
each; a tie between forms goes to the word first in code-point order; an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import written

#: Letters of a word, one byte each in Latin-1: A-Z become small, all else separates.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)
#: Distinct words and letters that a task counts before it passes its counts on.
HELD_WORDS, HELD_LETTERS = 100_000, 8 << 20
#: Letters of a range of words, the least and largest number of ranges, and a cut's length.
RANGE_LETTERS, LEAST_RANGES, MOST_RANGES, CUT = 1 << 20, 16, 4096, 256
#: How a word meets a pair of nodes: without a letter equal to the one before it, without
#: another letter, or with a gap there.
SAME, OTHER, GAP = 0, 1, 2

Change = Callable[[str, bytes], bytes]


def drop_letter(modulus: int) -> Change:
    """Leave a letter out of a run if ``modulus`` divides the crc32 of ``<id>:<run>``."""

    def change(key: str, run: bytes) -> bytes:
        name = run if run.isascii() else run.decode("latin-1").encode()
        h = zlib.crc32(name, zlib.crc32(f"{key}:".encode()))
        if h % modulus:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1 :]

    return change


def word_counts(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    change: Change | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, n): the words of whole texts with their occurrences.

    Words are maximal runs of Latin letters, of which only A-Z are made small. ``change``
    may turn each run of a document, in Latin-1, into another.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("key"),
        F.col(f"`{text_col}`").alias("t"),
    ).where("t is not null")

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, letters = Counter(), 0
        for batch in slices(batches):
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                runs = text.encode("latin-1", "replace").translate(_LETTERS).split()
                own = Counter([r for r in runs if len(r) >= least_length])
                for word, n in own.items():
                    if change is not None:
                        word = change(key, word)
                        if len(word) < least_length:
                            continue
                    letters += len(word)
                    counts[word] += n
                if len(counts) > HELD_WORDS or letters > HELD_LETTERS:
                    yield batch_of(counts)
                    counts, letters = Counter(), 0
        yield batch_of(counts)

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def common(a: str, b: str) -> int:
    """Letters that two words begin with alike."""
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


def paths(words: Iterable[str], first: int) -> Iterator[list[int]]:
    """The numbers of the trie nodes along each of the sorted ``words``, from the root, 0, on.

    New nodes are numbered from ``first`` on. The list given out changes with the next word.
    """
    path, before = [0], ""
    for word in words:
        shared = common(before, word)
        del path[shared + 1 :]
        path.extend(range(first, first + len(word) - shared))
        first += len(word) - shared
        before = word
        yield path


class Cuts:
    """Strings that cut the sorted words into ranges, and the numbers of their trie."""

    def __init__(self, cuts: list[str]):
        self.cuts = sorted(set(cuts) - {""})
        self.paths = [list(p) for p in paths(self.cuts, 1)]

    def range_of(self, word: str) -> int:
        return bisect_right(self.cuts, word)

    def shared(self, word: str, part: int) -> list[int]:
        """Numbers of the word's prefixes that another range than its own may have too."""
        found: list[int] = []
        for k in (part - 1, part):
            if 0 <= k < len(self.cuts):
                found = max(found, self.paths[k][: common(word, self.cuts[k]) + 1], key=len)
        return found


def _cuts(words: DataFrame, key: str, ranges: int) -> Cuts:
    """Every 16th of about 16 words a range, which are the first in a hash order."""
    below = -(2**63) + 2**64 * 16 * ranges // max(1, words.count())
    sample = words.where(F.xxhash64(key) < F.lit(min(below, 2**63 - 1)))
    held = sorted(r[0] for r in sample.select(F.left(key, F.lit(CUT))).collect())
    return Cuts(held[15::16] if len(held) > 16 * LEAST_RANGES else held[:: max(1, len(held) // LEAST_RANGES)])


def _in_ranges(words: DataFrame, key: str, cuts: Cuts) -> DataFrame:
    """``words`` with the range of each, a range in one task and in order."""
    held = words.sparkSession.sparkContext.broadcast(cuts)

    names, at = words.columns, words.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            part = [held.value.range_of(w) for w in batch.column(at).to_pylist()]
            columns = [pa.array(part, pa.int32()), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, ["part", *names])

    kinds = ", ".join(["part int", *[f"{name} {kind}" for name, kind in words.dtypes]])
    placed = words.mapInArrow(run, kinds).repartition(len(cuts.cuts) + 1, "part")
    return placed.sortWithinPartitions("part", key)


def _numbered(cuts: Cuts, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(row, its place, its path) of rows (part, word, ...) that come in order."""
    part, at, nodes, own = None, 0, None, None

    def words() -> Iterator[str]:
        while True:
            yield own

    for row in rows:
        own = row[1]
        if row[0] != part:
            part, at = row[0], 0
            nodes = paths(words(), (part + 1) << 40)
        path = list(next(nodes))
        shared = cuts.shared(own, part)
        path[: len(shared)] = shared
        yield row, part << 40 | at, path
        at += 1


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, so that few rows at a time become Python objects."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in slices(batches):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[list], kinds: dict[str, pa.DataType], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` values; each item is a list of rows."""
    held, values = [], 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True) if held else [[]] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(kinds))

    for weight, some in rows:
        held += some
        values += weight
        if values >= size:
            yield batch()
            held, values = [], 0
    yield batch()


def ranked(words: DataFrame, ranges: int) -> DataFrame:
    """(rank, word, n, path): the forward trie; ``rank`` is an id in code-point order."""
    cuts = _cuts(words, "word", ranges)
    held = words.sparkSession.sparkContext.broadcast(cuts)
    kinds = {"rank": pa.int64(), "word": pa.string(), "n": pa.int64(), "path": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = (
            (len(path), [(rank, word, n, path)])
            for (_, word, n), rank, path in _numbered(held.value, _rows(batches))
        )
        return _batches(out, kinds)

    rows = _in_ranges(words, "word", cuts).select("part", "word", "n")
    return rows.mapInArrow(run, "rank long, word string, n long, path array<long>")


def node_pairs(words: DataFrame, ranges: int) -> DataFrame:
    """(prefix, suffix, kind, rank, n): where the ranked words leave out a letter or have a gap."""
    words = words.withColumn("key", F.reverse("word"))
    cuts = _cuts(words, "key", ranges)
    held = words.sparkSession.sparkContext.broadcast(cuts)
    names = ["prefix", "suffix", "kind", "rank", "n"]
    kinds = dict.fromkeys(names, pa.int64()) | {"kind": pa.int8()}

    def pairs(row: tuple, back: list[int]) -> tuple[int, list[tuple]]:
        _, key, rank, n, path = row
        word, length = key[::-1], len(key)
        out = [(path[i], back[length - i], GAP, rank, n) for i in range(length + 1)]
        out += [
            (path[i], back[length - i - 1], SAME if i and word[i] == word[i - 1] else OTHER, rank, n)
            for i in range(length)
        ]
        return len(out), out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = (pairs(row, back) for row, _, back in _numbered(held.value, _rows(batches)))
        return _batches(out, kinds)

    rows = _in_ranges(words, "key", cuts).select("part", "key", "rank", "n", "path")
    return rows.mapInArrow(run, "prefix long, suffix long, kind byte, rank long, n long")


def near_words(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best): near words of each ranked word that has any.

    ``best`` is (minus n, rank) of the most frequent one, ties to the smallest word.
    """
    held = F.collect_list(F.struct((-F.col("n")).alias("m"), "rank", "kind")).alias("held")
    groups = pairs.groupBy("prefix", "suffix").agg(held).where("size(held) > 1")
    # A member's near words of a group: what leaves out another letter, or has the gap.
    near = f"""filter(held, y -> y.rank <> x.rank and (greatest(x.kind, y.kind) < {GAP}
                 or (x.kind = {OTHER} and y.kind = {GAP}) or (x.kind = {GAP} and y.kind = {OTHER})))"""
    one = f"transform(held, x -> struct(x.rank as rank, {near} as near))"
    found = groups.select(F.explode(F.expr(one)).alias("e")).where("size(e.near) > 0")
    found = found.select("e.rank", F.size("e.near").alias("k"), F.array_min("e.near").alias("b"))
    best = F.min(F.struct("b.m", "b.rank")).alias("best")
    return found.groupBy("rank").agg(F.sum("k").alias("n_near"), best)


def _roots(forms: DataFrame) -> DataFrame:
    """(rank, root) by pointer doubling: a form is more frequent than its word, so chains end."""
    jump = forms.select("rank", F.col("form_rank").alias("root"))
    while True:
        further = jump.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        jump = written(jump.join(further, "root", "left"), "jump")
        moved = not jump.where("next is not null").isEmpty()
        jump = jump.select("rank", F.coalesce("next", "root").alias("root"))
        if not moved:
            return jump


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per row of ``words`` (word, n), which are distinct.

    ``n_near`` counts the words within one inserted, deleted or replaced letter; ``form`` is
    the most frequent of them if it is ``ratio`` times as frequent as the word or more, and
    ``root`` the last word of the chain of forms, or the word itself.
    """
    words = written(words.select("word", "n"), "words")
    letters = words.agg(F.coalesce(F.sum(F.length("word")), F.lit(0))).first()[0]
    ranges = min(MOST_RANGES, max(LEAST_RANGES, letters // RANGE_LETTERS))
    words = written(ranked(words, ranges), "ranked")
    near = near_words(node_pairs(words, ranges))
    linked = words.select("rank", "word", "n").join(near, "rank", "left")
    is_form = F.expr(f"-best.m >= {int(ratio)} * n")
    linked = linked.select(
        "rank",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.rank")).alias("form_rank"),
        F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    linked = written(linked, "linked")
    forms = linked.where("form_rank is not null").select("rank", "form_rank")
    roots = _roots(forms)
    name = [
        linked.select(F.col("rank").alias(f"{c}_rank"), F.col("word").alias(c)) for c in ("form", "root")
    ]
    named = forms.join(roots.withColumnRenamed("root", "root_rank"), "rank")
    named = named.join(name[0], "form_rank").join(name[1], "root_rank").select("rank", "form", "root")
    return linked.join(named, "rank", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def oracle(modulus: int = 199, least_length: int = 6, least_count: int = 5, ratio: int = 5) -> str:
    """The same words and links by DuckDB: texts with a wildcard or without a letter are joined."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return rf"""WITH RECURSIVE
        runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
                   '{upper}', '{lower}') AS run FROM documents),
        own AS (SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS h
                FROM runs WHERE length(run) >= {least_length} GROUP BY doc_id, run),
        tab AS (SELECT list_transform(range(256), lambda b:
                  list_reduce(range(8), lambda c, i: {step}, b::BIGINT)) AS t),
        hashed AS (SELECT run, n, xor(4294967295, list_reduce(range(length(h) // 2),
                     lambda c, i: xor(c >> 8, t[xor(c & 255, ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT) + 1]),
                     4294967295::BIGINT)) AS crc FROM own, tab),
        changed AS (SELECT n, CASE WHEN crc % {modulus} = 0
                      THEN concat(left(run, crc % length(run)), substr(run, crc % length(run) + 2))
                      ELSE run END AS word FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= {least_length}
                  GROUP BY word HAVING sum(n) >= {least_count}),
        cut AS (SELECT DISTINCT word, n, i, left(word, i) AS a, substr(word, i + 2) AS b
                FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
        shorter AS (SELECT DISTINCT c.word AS long, c.n AS long_n, w.word AS short, w.n AS short_n
                    FROM cut c JOIN words w ON concat(a, b) = w.word),
        near AS (SELECT x.word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y
                   ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
                 UNION ALL SELECT long, short, short_n FROM shorter
                 UNION ALL SELECT short, long, long_n FROM shorter),
        best AS (SELECT word, count(*)::BIGINT AS n_near,
                   first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
                 FROM near GROUP BY word),
        formed AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
                     CASE WHEN other_n >= {ratio} * n THEN other END AS form,
                     CASE WHEN other_n >= {ratio} * n THEN other_n END AS form_n
                   FROM words w LEFT JOIN best b ON w.word = b.word),
        chain AS (SELECT word, word AS root FROM formed
                  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word
                  WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
        FROM formed f JOIN chain c ON f.word = c.word
        JOIN formed r ON c.root = r.word AND r.form IS NULL"""

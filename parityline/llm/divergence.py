"""How the sources of a language differ in their words, by a tree of the terms' counts.

Each source's share of each kept term is a whole number p, and two shares p and q differ by
floor((p - q)^2 / (p + q)). Summing that over all terms for all pairs of sources would cost
terms times pairs. Most terms are missing from most sources, where the share is a constant of
the source, so a pair's sum starts from what it would be if no source had any term:

    sum(p, q) = V f(p0, q0)
              + sum over terms of the one source   f(p, q0) - f(p0, q0)
              + sum over terms of the other source f(p0, q) - f(p0, q0)
              + sum over terms of both             f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The first line is one number a pair, the next two need each distinct share of a source once.
The last is read off a frequent-pattern tree. A term is a row of its sources, in their order,
with its share in each; equal rows are counted, not repeated; rows that begin alike share a
path. A node is a source with a share, and its multiplicity the number of terms that pass
it, so the correction of a node and one of its ancestors is worked out once for all those.

The tree is never held as such: rows are sorted, and a task takes a batch of them at a time.
A row begins a node at each depth beyond what it shares with the row before it, and the node
ends with the first row that shares no more than its depth. Where a batch ends inside a
shared path, both parts of it are corrected on their own; the sums are the same.

Defined results: null texts, languages and sources count as empty texts; rows are the
documents, so repeated rows count each; a language without kept terms gives pairs of value
0 and no terms; a language of one source has no pairs; an empty table gives an empty result;
further columns are ignored, whatever their names. A term's row is as long as its language
has sources, the square of which is the length of the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityline.llm.common import broadcast_if_small, written

SCALE = 1_000_000_000
#: Bytes of a term: letters of ASCII, A-Z made small, and all bytes of further code points.
_TERM = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: A task's count of a term is one number: its occurrences and, above them, its documents.
_SHIFT = 40
_MOST, _DOCUMENT = (1 << _SHIFT) - 1, 1 << _SHIFT
#: Distinct (group, term) that a task counts before it passes its counts on, and bytes of text.
HELD_TERMS, HELD_BYTES = 300_000, 64 << 20
#: Corrections of pairs that a task gathers before it sums them up.
HELD_PAIRS = 1 << 20
#: Node-ancestor pairs that are corrected in one go.
BLOCK = 1 << 18
#: Terms' rows in one range of the tree.
RANGE_ROWS = 20_000
LEAST_RANGES, MOST_RANGES = 8, 4096


def term_counts(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of every term of whole texts."""
    text = F.col(f"`{text_col}`").cast("string").cast("binary")
    rows = _groups(docs, lang_col, source_col, text.alias("t")).where("t is not null")
    names = ["lang", "source", "term", "n", "df"]

    def passed_on(groups: dict[tuple, dict]) -> Iterator[pa.RecordBatch]:
        """Counts in parts, so that few at a time become rows."""
        for (lang, source), terms in groups.items():
            left = iter(terms.items())
            while part := list(islice(left, 20_000)):
                found, counts = zip(*part, strict=True)
                counts = np.array(counts, np.int64)
                plain = [pa.repeat(pa.scalar(x, pa.string()), len(part)) for x in (lang, source)]
                numbers = [pa.array(counts & _MOST), pa.array(counts >> _SHIFT)]
                yield pa.RecordBatch.from_arrays([*plain, pa.array(found, pa.binary()), *numbers], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, dict] = {}
        held = size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                terms = groups.setdefault((lang, source), {})
                before = len(terms)
                for term, n in Counter(text.translate(_TERM).split()).items():
                    terms[term] = terms.get(term, 0) + n + _DOCUMENT
                held, size = held + len(terms) - before, size + len(text)
                if held > HELD_TERMS or size > HELD_BYTES:
                    yield from passed_on(groups)
                    groups, held, size = {}, 0, 0
        yield from passed_on(groups)

    parts = rows.mapInArrow(run, "lang string, source string, term binary, n long, df long")
    counted = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    return counted.withColumn("term", F.col("term").cast("string"))


def _groups(docs: DataFrame, lang_col: str, source_col: str, *more: Column) -> DataFrame:
    plain = [
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"))
    ]
    return docs.select(*plain, *more)


def _share(count: str, total: str) -> Column:
    """p of a count; exact for counts of any length."""
    return F.expr(
        f"1 + (cast({SCALE} as decimal(38, 0)) * cast({count} + 2 as decimal(20, 0)))"
        f" div cast({total} + 2 * v as decimal(20, 0))"
    )


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f of whole numbers up to 10^9 + 1, whose squares fit."""
    return (p - q) ** 2 // (p + q)


def cells(counts: DataFrame, groups: DataFrame, least_documents: int) -> tuple[DataFrame, DataFrame, int]:
    """The kept terms' shares where they occur, and the groups with their constants.

    Cells are (lang, source, term, p, q, p0), q being the language's share and p0 the
    group's share of a term that it lacks; groups are (lang, source, v, p0) and counted.
    """
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("c"), F.sum("df").alias("d"))
    kept = written(kept.where(F.col("d") >= least_documents).select("lang", "term", "c"), "kept")
    occurring = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    occurring = written(occurring, "occurring")
    totals = occurring.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("c").alias("lang_total"))
    stats = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    stats = stats.withColumn("total", F.expr("coalesce(total, 0L)"))
    stats = stats.withColumn("p0", _share("0L", "total"))
    stats = written(stats, "groups")
    rows = stats.count()
    found = occurring.join(broadcast_if_small(stats, rows), ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "total").alias("p"), _share("c", "lang_total").alias("q"), "p0"
    )
    return written(found, "cells"), stats.select("lang", "source", "v", "p0"), rows


class Rows:
    """Sorted rows of the tree: all their items one after another, and where each row begins.

    ``number`` stands for an item's group, ``n`` counts the terms of a row.
    """

    def __init__(self, number: np.ndarray, p: np.ndarray, p0: np.ndarray, begin: np.ndarray, n: np.ndarray):
        self.number, self.p, self.p0 = number, p, p0
        self.begin, self.length = begin[:-1], np.diff(begin)
        self.before = np.concatenate([[0], np.cumsum(n)])

    def shared(self) -> np.ndarray:
        """Items with which each row begins like the row before it."""
        found = np.zeros(len(self.length), np.int64)
        alike = np.arange(1, len(found))
        depth = 0
        while len(alike):
            alike = alike[np.minimum(self.length[alike], self.length[alike - 1]) > depth]
            a, b = self.begin[alike] + depth, self.begin[alike - 1] + depth
            alike = alike[(self.number[a] == self.number[b]) & (self.p[a] == self.p[b])]
            depth += 1
            found[alike] = depth
        return found

    def nodes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, rows, times): the rows that begin a node, and how many terms pass it."""
        shared = self.shared()
        changes = np.arange(len(shared))
        for depth in range(int(self.length.max(initial=0))):
            begins = changes[shared[changes] <= depth]
            ends = np.append(begins[1:], len(shared))
            held = self.length[begins] > depth
            rows = begins[held]
            yield depth, rows, self.before[ends[held]] - self.before[rows]

    def corrections(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pair, value) of every node with each of its ancestors, in blocks."""
        for depth, rows, times in self.nodes():
            if not depth:
                continue
            step = max(1, BLOCK // depth)
            for low in range(0, len(rows), step):
                row = self.begin[rows[low : low + step], None]
                at, above = row + depth, row + np.arange(depth)
                a, a0, b, b0 = self.p[at], self.p0[at], self.p[above], self.p0[above]
                both = _apart(a, b) - _apart(a, b0) - _apart(a0, b) + _apart(a0, b0)
                pairs = self.number[above] << 32 | self.number[at]
                yield pairs.ravel(), (times[low : low + step, None] * both).ravel()


class Pairs:
    """Corrections of pairs of groups that one task has found."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}
        self.names: list[tuple[str, str]] = []
        self.keys: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.held = 0

    def numbers(self, langs: list[str], sources: list[str]) -> np.ndarray:
        found = []
        for key in zip(langs, sources, strict=True):
            if key not in self.number:
                self.number[key] = len(self.names)
                self.names.append(key)
            found.append(self.number[key])
        return np.array(found, np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Sums are kept a pair each as soon as there are many."""
        self.keys.append(keys)
        self.values.append(values)
        self.held += len(keys)
        if self.held > HELD_PAIRS:
            self._sum()

    def _sum(self) -> None:
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        values = np.concatenate([np.zeros(0, np.int64), *self.values])
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        sums = np.add.reduceat(values, first) if len(first) else values
        self.keys, self.values, self.held = [keys[first]], [sums], len(first)

    def many(self) -> bool:
        """Whether what has just been summed up is still a lot."""
        return len(self.keys) == 1 and self.held > HELD_PAIRS // 2

    def summed(self) -> pa.RecordBatch:
        """One row a pair of what has been added, which goes."""
        self._sum()
        pairs = [(self.names[k >> 32], self.names[k & 0xFFFFFFFF]) for k in self.keys[0].tolist()]
        columns = [[a[0] for a, _ in pairs], [a[1] for a, _ in pairs], [b[1] for _, b in pairs]]
        batch = pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.string()) for c in columns], pa.array(self.values[0], pa.int64())],
            ["lang", "source", "item", "value"],
        )
        self.keys, self.values, self.held = [], [], 0
        return batch


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections (lang, source, item, value) of the node-ancestor pairs of sorted rows."""
    pairs = Pairs()
    for batch in batches:
        items = batch.column(1)
        begin = items.offsets.to_numpy().astype(np.int64)
        flat, langs = items.flatten(), batch.column(0)
        begin = begin - begin[0]
        lang_of = langs.take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(begin))))
        source, p, p0 = (flat.field(i) for i in range(3))
        number = pairs.numbers(lang_of.to_pylist(), source.to_pylist())
        rows = Rows(number, p.to_numpy(), p0.to_numpy(), begin, batch.column(2).to_numpy())
        for keys, values in rows.corrections():
            pairs.add(keys, values)
            if pairs.many():
                yield pairs.summed()
    yield pairs.summed()


def _joint(found: DataFrame) -> DataFrame:
    """(lang, source, item, value), source before item: the terms that both have."""
    items = F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("items")
    rows = found.groupBy("lang", "term").agg(items).where("size(items) > 1")
    rows = written(rows.groupBy("lang", "items").agg(F.count("*").alias("n")), "rows")
    ranges = min(MOST_RANGES, max(LEAST_RANGES, rows.count() // RANGE_ROWS))
    rows = rows.repartitionByRange(ranges, "lang", "items").sortWithinPartitions("lang", "items")
    return rows.mapInArrow(_tree, "lang string, source string, item string, value long")


def pair_values(found: DataFrame, groups: DataFrame, rows: int) -> DataFrame:
    """(lang, source, item, value) for each ordered pair of sources of a language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    other = broadcast_if_small(other, rows)
    apart = F.col("source") != F.col("item")
    value = F.expr(f"coalesce(v * ({_gap('p0', 'q0')}), 0L)").alias("value")
    base = groups.join(other, "lang").where(apart).select("lang", "source", "item", value)
    shares = found.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n"))
    value = F.sum(F.expr(f"n * ({_gap('p', 'q0')} - {_gap('p0', 'q0')})")).alias("value")
    single = shares.join(other, "lang").where(apart).groupBy("lang", "source", "item").agg(value)
    half = single.unionByName(_joint(found))
    turned = half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    parts = base.unionByName(half).unionByName(turned)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame,
    least_documents: int = 10,
    top: int = 10,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): what each source differs in, and from whom.

    Part ``pair`` has each other source of the language with the sum over all kept terms,
    part ``term`` the ``top`` terms that the source uses more than its language does.
    """
    counts = written(term_counts(docs, lang_col, source_col, text_col), "counts")
    groups = _groups(docs, lang_col, source_col).distinct()
    found, stats, rows = cells(counts, groups, least_documents)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    columns = ["lang", "source", "part", "item", "value", rank]
    pairs = pair_values(found, stats, rows).withColumn("part", F.lit("pair"))
    value = F.expr(_gap("p", "q")).alias("value")
    terms = found.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value)
    terms = terms.select(*columns).where(F.col("rank") <= top)
    return pairs.select(*columns).unionByName(terms)


def oracle(least_documents: int = 10, top: int = 10) -> str:
    """The same by DuckDB, term by term and pair by pair."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    gap = "((p - q) * (p - q)) // (p + q)"
    return rf"""WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang,
            coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
        t AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM t GROUP BY lang, term
                 HAVING count(DISTINCT doc) >= {least_documents}),
        langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS total FROM kept GROUP BY lang),
        n AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term)
              GROUP BY lang, source, term),
        groups AS (SELECT DISTINCT lang, source FROM d),
        totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total
                   FROM groups g LEFT JOIN n ON g.lang = n.lang AND g.source = n.source GROUP BY g.lang, g.source),
        shares AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
                     1 + ({SCALE} * (coalesce(n.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
                     1 + ({SCALE} * (k.c + 2)) // (l.total + 2 * l.v) AS lang_p
                   FROM totals g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
                   LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
        sums AS (SELECT lang, a, b, sum({gap}) AS value
                 FROM (SELECT x.lang, x.source AS a, y.source AS b, x.p, y.p AS q
                       FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                         AND x.source <> y.source) GROUP BY lang, a, b),
        pairs AS (SELECT g.lang, g.source, h.source AS item, coalesce(s.value, 0)::BIGINT AS value
                  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
                  LEFT JOIN sums s ON s.lang = g.lang AND s.a = g.source AND s.b = h.source),
        terms AS (SELECT lang, source, term AS item, ({gap})::BIGINT AS value
                  FROM (SELECT lang, source, term, p, lang_p AS q FROM shares WHERE n > 0) WHERE p > q),
        both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
                       UNION ALL SELECT lang, source, 'term', item, value FROM terms),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                     ORDER BY value DESC, item)::INTEGER AS rank FROM both_parts)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= {top}"""
